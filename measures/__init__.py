"""measures: clinical-study measurement loads and analytics on Spark.

Sub-packages:
  functions  column expressions (parsing, ids, serialisation)
  sources    landing-file scans, table store, driver-table adapter
  operators  validation, constraints, dimensions, roll-up, ledger
  sinks      table writes (facts, dimensions, enrollments, roll-up, ledger)
  plans      analytic queries (Q1-Q7), readers (R1-R4), the batch load
  streaming  incremental file ingestion and the streaming daily roll-up
"""

from measures.session import build_session, ensure_session, scratch_dir
from measures.sources.store import Store


def run_load(*args, **kwargs):
    """Shortcut for `measures.plans.loading.run_load`."""
    from measures.plans.loading import run_load as _run_load
    return _run_load(*args, **kwargs)


__all__ = ["build_session", "ensure_session", "scratch_dir", "Store", "run_load"]
