"""Canonical tables as explicit Spark schemas.

``nullable=False`` marks a required field for the ingest gate. Timestamps are
stored as UTC without a zone (TIMESTAMP_NTZ).
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _B, _D = T.StringType(), T.IntegerType(), T.BooleanType(), T.DoubleType()
_TS = T.TimestampNTZType()


def _table(*fields) -> T.StructType:
    """``(name, type)`` is required, ``(name, type, None)`` is optional."""
    return T.StructType([T.StructField(f[0], f[1], len(f) == 3) for f in fields])


ENTITY = _table(("entity_id", _S), ("sector", _S), ("size_tier", _S), ("region", _S), ("soc_model", _S))

ASSET = _table(
    ("asset_id", _S), ("entity_id", _S), ("type", _S), ("criticality", _S),
    ("environment_zone", _S), ("monitored_flag", _B),
    ("onboarded_date", _TS, None), ("decommissioned_date", _TS, None),
)

ALERT = _table(
    ("alert_id", _S), ("entity_id", _S), ("asset_id", _S, None), ("rule_id", _S, None),
    ("category", _S), ("severity", _I), ("created_ts", _TS),
    ("ack_ts", _TS, None), ("closed_ts", _TS, None), ("status", _S),
    ("disposition", _S, None), ("closure_reason", _S, None),
    ("analyst_id", _S, None), ("shift", _S, None),
)

CASE = _table(
    ("case_id", _S), ("entity_id", _S), ("alert_ids", T.ArrayType(_S)),
    ("opened_ts", _TS), ("closed_ts", _TS, None), ("severity", _I),
    ("owner", _S, None), ("root_cause", _S, None), ("remediation", _S, None),
    ("reopened_flag", _B, None),
)

CASE_EVENT = _table(("case_id", _S), ("entity_id", _S), ("ts", _TS), ("event_type", _S), ("actor", _S))

ESCALATION = _table(
    ("case_id", _S, None), ("alert_id", _S, None), ("entity_id", _S), ("ts", _TS),
    ("from_tier", _S), ("to_tier", _S), ("recipient", _S), ("outcome", _S),
)

NOTE = _table(("case_id", _S), ("entity_id", _S), ("ts", _TS), ("text", _S))

KPI_REPORT = _table(
    ("entity_id", _S), ("period", _S), ("reported_mttr_mins", _D, None),
    ("reported_mtta_mins", _D, None), ("reported_sla_percent", _D, None),
    ("closure_rate", _D, None),
)

TABLES = {
    "entities": ENTITY, "assets": ASSET, "alerts": ALERT, "cases": CASE,
    "events": CASE_EVENT, "escalations": ESCALATION, "notes": NOTE,
}

# Names a column may carry in a submitted Parquet file, next to its own.
FILE_ALIASES = {"environment_zone": "environment/zone"}

# Values taken when an optional column is absent or null.
FIELD_DEFAULTS = {"reopened_flag": False}

FINDING = T.StructType([
    T.StructField("detector_id", _S), T.StructField("entity_id", _S),
    T.StructField("target_id", _S), T.StructField("severity", _I),
    T.StructField("effect_size", _D), T.StructField("confidence", _D),
    T.StructField("rationale", _S), T.StructField("evidence", T.MapType(_S, _D)),
])

TRUTH = T.StructType([
    T.StructField("finding_id", _S), T.StructField("entity_id", _S),
    T.StructField("scope", _S), T.StructField("target_id", _S),
    T.StructField("description", _S),
])

BLOCK = T.StructType([
    T.StructField("index", T.LongType()), T.StructField("timestamp", _S),
    T.StructField("event_type", _S), T.StructField("data", _S),
    T.StructField("prev_hash", _S), T.StructField("hash", _S),
])
