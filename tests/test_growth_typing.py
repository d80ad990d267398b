"""Typing takes each costly step once a row, however often its result is named."""

import re

from conftest import F1_JOB, F1_ROWS, csv_text, write_file
from measures.operators import validate
from measures.sources import landing


def test_hash_and_job_pattern_once_a_row(spark, workdir):
    write_file(f"{workdir}/land", f"{F1_JOB}_a.csv", csv_text(F1_ROWS))
    scan = landing.scan(spark, f"{workdir}/land")
    plan = validate.transform(scan.rows)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"md5\(cast\(concat_ws", plan)) == 1
    assert plan.count(landing.UUID_PATTERN) == 1


def test_ids_of_rows_without_and_with_an_id_column(spark, workdir):
    own = "0F8FAD5B-D9CB-469F-A165-70867728950E"
    for folder, header, first in (("plain", None, ""), ("own", "id", own)):
        rows = F1_ROWS.split("\n")[:1]
        text = csv_text(rows[0]) if not header else csv_text(
            f"{first},{rows[0]}", "id," + csv_text("").split("\n")[0])
        write_file(f"{workdir}/{folder}", f"{F1_JOB}_a.csv", text)
    plain, with_id = (validate.transform(landing.scan(spark, f"{workdir}/{f}").rows).first()
                      for f in ("plain", "own"))
    assert with_id["id"] == own.lower() and not with_id["_bad_id"]
    assert plain["id"] != with_id["id"] and len(plain["id"]) == 36
    assert plain["job_id"] == with_id["job_id"] == F1_JOB
