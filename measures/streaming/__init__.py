from measures.streaming.ingest import start_ingest
from measures.streaming.rollup import (start_rollup_stream, stream_facts,
                                       streaming_daily_rollup)

__all__ = ["start_ingest", "start_rollup_stream", "stream_facts", "streaming_daily_rollup"]
