from measures.functions.ids import measurement_id, utc_text
from measures.functions.parsing import (as_day, batch_instant, bp_overflow, bp_part,
                                        clamp_quality, is_bp_pair, is_low_quality,
                                        null_if_missing, parse_timestamp_utc, strip_ws,
                                        value_num)
from measures.functions.serialize import iso_z, to_api_rows, to_json_lines

__all__ = ["measurement_id", "utc_text", "as_day", "batch_instant", "bp_overflow", "bp_part",
           "clamp_quality", "is_bp_pair", "is_low_quality", "null_if_missing",
           "parse_timestamp_utc", "strip_ws", "value_num", "iso_z", "to_api_rows",
           "to_json_lines"]
