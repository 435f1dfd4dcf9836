"""Small hand-made tables."""

from __future__ import annotations

import datetime as dt

from watchloom import schemas
from watchloom.sources.tables import SocTables

T0 = dt.datetime(2024, 1, 1)


def at(seconds=0.0, days=0, minutes=0):
    return T0 + dt.timedelta(days=days, minutes=minutes, seconds=seconds)


def rows(spark, name, records):
    """Records with some of a table's fields; the rest is null."""
    schema = schemas.TABLES[name]
    loose = type(schema)([type(f)(f.name, f.dataType, True) for f in schema.fields])
    data = [tuple(r.get(f.name) for f in schema.fields) for r in records]
    return spark.createDataFrame(data, loose)


def tables(spark, **records):
    return SocTables(**{n: rows(spark, n, records.get(n, [])) for n in schemas.TABLES})


def alert(i, entity="E1", **kw):
    return {"alert_id": f"A{i}", "entity_id": entity, "category": "Malware", "severity": 3,
            "created_ts": at(), "status": "Closed", **kw}


def case(i, entity="E1", **kw):
    return {"case_id": f"C{i}", "entity_id": entity, "alert_ids": [f"A{i}"], "opened_ts": at(), "severity": 3,
            "reopened_flag": False, **kw}


def entity(e, sector="Power", tier="Tier 1"):
    return {"entity_id": e, "sector": sector, "size_tier": tier, "region": "R", "soc_model": "MSSP"}


def asset(i, entity="E1", **kw):
    return {"asset_id": f"S{i}", "entity_id": entity, "type": "Server", "criticality": "Low",
            "environment_zone": "DMZ", "monitored_flag": True, **kw}


def targets(df):
    return sorted((r["entity_id"], r["target_id"]) for r in df.select("entity_id", "target_id").collect())
