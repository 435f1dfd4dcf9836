"""A full assessment: every detector run, findings kept as one table."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from watchloom.config import DEFAULTS, Settings
from watchloom.operators.detectors import DETECTORS
from watchloom.schemas import FINDING
from watchloom.session import scratch_path
from watchloom.sources.tables import SocTables


def assess(t: SocTables, cfg: Settings = DEFAULTS, detectors=None, path: str | None = None,
           concurrent: int = 2) -> DataFrame:
    """Findings of all (or the named) detectors, written to ``path`` and read back.

    Each detector is a job of its own: jobs share the cluster, adaptive execution
    re-plans a small plan instead of one union of twenty, and a lost executor costs a
    retry of its tasks only. The first failing detector fails the assessment. The driver
    plans ``concurrent`` detectors at a time, which is what its memory goes into.
    """
    spark = t.alerts.sparkSession
    path = path or scratch_path(spark, "findings")
    shared = t.with_rollup()

    def run(detector_id: str) -> None:
        DETECTORS[detector_id](shared, cfg).write.parquet(f"{path}/run={detector_id}")

    with ThreadPoolExecutor(concurrent) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(run), d) for d in detectors or DETECTORS]
        for job in jobs:
            job.result()
    return spark.read.schema(FINDING).parquet(path).select(*FINDING.fieldNames())
