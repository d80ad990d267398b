"""`python -m measures`: load a folder, ask a question, look up a job."""

import json
import os

from conftest import F1_JOB, F1_ROWS, csv_text, write_file
from measures.__main__ import main


def test_cli_load_query_job(spark, workdir, capsys):
    land, store, out = (os.path.join(workdir, x) for x in ("landing", "store", "q7"))
    write_file(land, f"{F1_JOB}_a.csv", csv_text(F1_ROWS))
    assert main(["load", land, store]) == 0
    job = json.loads(capsys.readouterr().out.strip().splitlines()[0])
    assert job["status"] == "completed" and job["rows"] == 12
    assert main(["query", store, "q7_raw", "--param", "study=STUDY001", "--out", out]) == 0
    assert spark.read.parquet(out).first()[0] == 23.38
    assert main(["job", store, F1_JOB]) == 0
    assert "Job completed successfully" in capsys.readouterr().out
