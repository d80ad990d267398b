import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from measures.session import PERFORMANCE_CONF, SEMANTIC_CONF  # noqa: E402

HEADER = "study_id,participant_id,measurement_type,value,unit,timestamp,site_id,quality_score"
# The three rows behind the ids that the reference prints.
GLUCOSE_ROWS = """STUDY001,P001,glucose,95.5,mg/dL,2024-01-15T09:30:00Z,SITE_A,0.98
STUDY001,P002,glucose,102.1,mg/dL,2024-01-15T10:15:00Z,SITE_A,0.97
STUDY001,P003,glucose,88.2,mg/dL,2024-01-15T11:00:00Z,SITE_A,0.99"""
# End of fixed values.


def _rows(study, site, visits):
    """Rows of one study: {(participant, time): [(type, value, unit, quality)]}."""
    return "\n".join(f"{study},{who},{kind},{value},{unit},{when},{site},{quality}"
                     for (who, when), read in visits.items()
                     for kind, value, unit, quality in read)


F1_ROWS = GLUCOSE_ROWS + "\n" + _rows("STUDY001", "SITE_A", {
    ("P001", "2024-01-15T09:30:00Z"): [("heart_rate", 61, "bpm", 0.96),
                                       ("weight", 81.2, "kg", 0.97), ("height", 182, "cm", 0.99)],
    ("P002", "2024-01-15T10:15:00Z"): [("heart_rate", 74, "bpm", 0.99),
                                       ("weight", 58.4, "kg", 0.98), ("height", 161, "cm", 0.97)],
    ("P003", "2024-01-15T11:00:00Z"): [("heart_rate", 83, "bpm", 0.95),
                                       ("weight", 69.9, "kg", 0.96), ("height", 174, "cm", 0.98)]})
F2_ROWS = _rows("STUDY002", "SITE_B", {
    ("P001", "2024-01-16T09:00:00Z"): [("blood_pressure", "118/76", "mmHg", 0.91),
                                       ("heart_rate", 66, "bpm", 0.97),
                                       ("cholesterol", 171, "mg/dL", 0.96)],
    ("P002", "2024-01-16T12:45:00Z"): [("blood_pressure", "141/92", "mmHg", 0.93),
                                       ("heart_rate", 79, "bpm", 0.95),
                                       ("cholesterol", 204, "mg/dL", 0.98)],
    ("P003", "2024-01-16T14:05:00Z"): [("blood_pressure", "109/70", "mmHg", 0.95),
                                       ("heart_rate", 58, "bpm", 0.99),
                                       ("cholesterol", 188, "mg/dL", 0.97)]})
F1_JOB = "b1a6d6f4-52a1-4f0e-9a5e-0c1d2e3f4a51"
F1B_JOB = "c2b7e7a5-63b2-4a1f-8b6f-1d2e3f4a5b62"
F2_JOB = "a0c8f8b6-74c3-4b20-9c70-2e3f4a5b6c73"


@pytest.fixture(scope="session")
def spark():
    base = tempfile.mkdtemp(prefix="measures-tests-")
    b = (SparkSession.builder.master("local[*]").appName("measures-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.warehouse.dir", os.path.join(base, "warehouse")))
    for k, v in {**PERFORMANCE_CONF, **SEMANTIC_CONF}.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own checkpoint folder (nothing configured here).
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(os.path.join(base, "checkpoints"))
    yield s
    s.stop()


@pytest.fixture
def workdir():
    return tempfile.mkdtemp(prefix="measures-case-")


def write_file(folder: str, name: str, text: str) -> str:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text if text.endswith("\n") else text + "\n")
    return path


def csv_text(rows: str, header: str = HEADER) -> str:
    return header + "\n" + rows + "\n"
