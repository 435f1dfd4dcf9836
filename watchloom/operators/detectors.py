"""All twenty detectors by id, and their union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from watchloom.config import DEFAULTS, Settings
from watchloom.operators import execution_gaps as eg, exploratory as ex, negative_space as ns
from watchloom.operators.isolation_forest import ex_01
from watchloom.sources.tables import SocTables

DETECTORS = {
    "EG-01": eg.eg_01, "EG-02": eg.eg_02, "EG-03": eg.eg_03,
    "EG-04": eg.eg_04, "EG-05": eg.eg_05, "EG-06": eg.eg_06,
    "NS-01": ns.ns_01, "NS-02": ns.ns_02, "NS-03": ns.ns_03,
    "NS-04": ns.ns_04, "NS-05": ns.ns_05, "NS-06": ns.ns_06,
    "EX-01": ex_01, "EX-02": ex.ex_02, "EX-03": ex.ex_03, "EX-04": ex.ex_04,
    "EX-05": ex.ex_05, "EX-06": ex.ex_06, "EX-07": ex.ex_07, "EX-08": ex.ex_08,
}


def all_findings(t: SocTables, cfg: Settings = DEFAULTS, detectors=None) -> DataFrame:
    """Findings of all (or the named) detectors.

    Volume detectors read one shared rollup of the alerts instead of scanning them
    again; equal shuffles of the others are reused by Spark within the union.
    """
    shared = t.with_rollup()
    chosen = detectors or DETECTORS
    return reduce(DataFrame.unionByName, [DETECTORS[d](shared, cfg) for d in chosen])
