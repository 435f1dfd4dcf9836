"""The seven canonical tables derived from the star schema of the test data.

Only integer arithmetic on keys, so any engine derives the same rows. ``k`` (order
key), ``ck`` (customer key) and ``nk`` (nation key) stay on the frames: the
planted-weakness rules in ``truth`` use them, detectors do not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from watchloom import schemas
from watchloom.session import materialise
from watchloom.sources.tables import SocTables


def _seconds(expr: str) -> str:
    return f"make_dt_interval(0,0,0,cast({expr} as decimal(18,6)))"


def _minutes(expr: str) -> str:
    return f"make_dt_interval(0,0,cast({expr} as int))"


def _entity(key: str) -> str:
    return f"'ENT-' || lpad(cast({key} as string), greatest(2, length(cast({key} as string))), '0')"


class Star:
    """Frames over one scale-factor directory.

    Alerts and cases are written once to the shared folder when first needed, like a
    landing step, since the other tables and all detectors build on them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")
        self._landed: dict[str, DataFrame] = {}

    def land(self, name: str) -> DataFrame:
        """Table ``name`` written out once and read back."""
        if name not in self._landed:
            self._landed[name] = materialise(getattr(self, f"derive_{name}")(), name)
        return self._landed[name]

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def derive_entities(self) -> DataFrame:
        nation = self.raw("nation").join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return nation.selectExpr(
            f"{_entity('n_nationkey')} as entity_id",
            "r_name as sector",
            "case when n_nationkey < 15 then 'Tier 1' else 'Tier 2' end as size_tier",
            "'Region-' || cast(n_regionkey + 1 as string) as region",
            "case n_nationkey % 3 when 0 then 'In-House' when 1 then 'MSSP' else 'Hybrid' end as soc_model",
        )

    def derive_assets(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "'AST-' || cast(c_custkey as string) as asset_id",
            f"{_entity('c_nationkey')} as entity_id",
            "case c_custkey % 6 when 0 then 'Server' when 1 then 'Workstation' when 2 then 'Router'"
            " when 3 then 'Firewall' when 4 then 'Database' else 'IoT' end as type",
            "case c_custkey % 4 when 0 then 'Critical' when 1 then 'High' when 2 then 'Medium' else 'Low' end"
            " as criticality",
            "c_custkey % 20 <> 0 as monitored_flag",
        )

    def alerts_base(self) -> DataFrame:
        """Every order as an alert, before any weakness is planted."""
        customer = self.raw("customer").select("c_custkey", "c_nationkey")
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
        return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
            "o_orderkey as k", "c_custkey as ck", "c_nationkey as nk",
            "'ALT-' || cast(o_orderkey as string) as alert_id",
            f"{_entity('c_nationkey')} as entity_id",
            "'AST-' || cast(c_custkey as string) as asset_id",
            "'RULE-' || lpad(cast((o_orderkey div 7) % 50 as string), 3, '0') as rule_id",
            "case o_orderstatus when 'F' then 'Malware' when 'O' then 'Phishing' else 'Auth Failure' end as category",
            "6 - cast(substr(o_orderpriority, 1, 1) as int) as severity",
            f"timestamp_ntz '2024-01-01 00:00:00' + {_seconds('(o_orderkey * 7919) % 2592000')} as created_ts",
            "'A-' || lpad(cast(c_custkey % 14 as string), 2, '0') as analyst_id",
        )

    def derive_alerts(self) -> DataFrame:
        kept = self.alerts_base().filter(
            "not (ck % 48 = 0) and not (nk = 3 and category = 'Phishing')"
            " and not (nk = 7 and k % 20 <> 0) and not (nk = 9 and k % 100 <> 0)"
            " and not (nk = 11 and ck % 6 = 4)"
            " and not (nk = 13 and created_ts >= timestamp_ntz '2024-01-24 00:00:00')"
            " and not (nk = 15 and created_ts > timestamp_ntz '2024-01-16 00:00:00' and k % 10 <> 0)"
            " and not (nk = 17 and category = 'Malware' and severity = 3)"
        )
        return kept.selectExpr(
            "k", "nk", "alert_id", "entity_id", "asset_id", "rule_id", "category", "severity", "created_ts",
            "case when k % 37 = 0 then null"
            f" when severity >= 4 and k % 50 = 7 then created_ts + {_seconds('20')}"
            f" else created_ts + {_seconds('3600 * (6 - severity) + (k * 31) % 7200')} end as closed_ts",
            "case when k % 37 = 0 then 'Open' else 'Closed' end as status",
            "case when analyst_id = 'A-10' or k % 3 = 0 then 'Benign' when k % 3 = 1 then 'True Positive'"
            " else 'False Positive' end as disposition",
            "analyst_id",
        )

    def derive_cases(self) -> DataFrame:
        with_lines = self.raw("lineitem").select(F.col("l_orderkey").alias("k")).distinct()
        opened = f"created_ts + {_minutes('k % 10 + 1')}"
        return self.land("alerts").join(with_lines, "k", "left_semi").selectExpr(
            "'CAS-' || cast(k as string) as case_id", "entity_id",
            "case when k % 211 = 0 then array(alert_id, 'ALT-X' || cast(k as string)) else array(alert_id) end"
            " as alert_ids",
            f"{opened} as opened_ts",
            f"case when analyst_id = 'A-03' then {opened} + {_seconds('60')}"
            f" when analyst_id = 'A-05' then {opened} + {_seconds('1 + k % 2')}"
            f" when analyst_id = 'A-07' then timestamp_ntz '2024-02-05 12:00:00' + {_seconds('k % 60')}"
            f" when severity >= 3 and k % 41 = 3 then {opened} + {_seconds('10')}"
            " else closed_ts end as closed_ts",
            "severity", "analyst_id as owner",
            "case when nk = 19 then 'Site specific cause' else 'Investigated' end as root_cause",
            "k", "rule_id",
        )

    def derive_events(self) -> DataFrame:
        cases = self.land("cases").filter("rule_id <> 'RULE-007'")
        lines = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus")
        worked = (
            cases.filter("owner <> 'A-09'").join(lines, F.col("l_orderkey") == F.col("k"))
            .selectExpr(
                "case_id", "entity_id", f"opened_ts + {_seconds('(l_partkey * 17) % 3600')} as ts",
                "case l_returnflag || l_linestatus when 'AF' then 'assign' when 'AO' then 'enrich'"
                " when 'NF' then 'pivot' when 'NO' then 'note' when 'RF' then 'evidence' else 'status' end"
                " as event_type",
                "owner as actor",
            )
        )
        scripted = cases.filter("owner = 'A-09'").select(
            "case_id", "entity_id",
            F.explode(F.expr(
                f"array(struct(opened_ts + {_seconds('10')} as ts, 'enrich' as event_type),"
                f" struct(opened_ts + {_seconds('20')} as ts, 'status' as event_type))"
            )).alias("e"), "owner",
        ).selectExpr("case_id", "entity_id", "e.ts as ts", "e.event_type as event_type", "owner as actor")
        return worked.unionByName(scripted)

    def derive_notes(self) -> DataFrame:
        return self.land("cases").selectExpr(
            "case_id", "entity_id", f"opened_ts + {_minutes('5')} as ts",
            "case when owner = 'A-04' then 'Template note: nothing found, closed.'"
            " else 'Analyst ' || owner || ' investigated ' || rule_id || ' in ' || case_id end as text",
        )

    def derive_escalations(self) -> DataFrame:
        return self.land("cases").filter("severity >= 4 and k % 23 <> 1").selectExpr(
            "case_id", "element_at(alert_ids, 1) as alert_id", "entity_id",
            f"opened_ts + {_minutes('5')} as ts", "'Tier 1' as from_tier", "'Tier 2' as to_tier",
            "'Desk-2' as recipient", "'Escalated' as outcome",
        )

    def tables(self) -> SocTables:
        return SocTables(**{name: self.land(name) for name in schemas.TABLES})

    def truth(self) -> DataFrame:
        """Planted weaknesses, one row each: (finding_id, entity_id, scope, target_id)."""
        alerts, cases = self.land("alerts"), self.land("cases")

        def rows(df, finding, scope, entity, target):
            return df.select(
                F.lit(finding).alias("finding_id"), F.expr(entity).alias("entity_id"),
                F.lit(scope).alias("scope"), F.expr(target).alias("target_id"),
            )

        high = alerts.filter("severity >= 4")
        silent = self.raw("customer").filter("c_custkey % 48 = 0")
        lines = self.raw("lineitem").select(F.col("l_orderkey").alias("k")).distinct()
        parts = [
            rows(high.filter("k % 50 = 7 and k % 37 <> 0"), "EG-01", "alert", "entity_id", "alert_id"),
            rows(cases.filter("severity >= 3 and k % 41 = 3 and owner not in ('A-03', 'A-05', 'A-07')"),
                 "EG-02", "case", "entity_id", "case_id"),
            rows(high.filter("k % 23 = 1 and closed_ts is not null").join(lines, "k", "left_semi"),
                 "EG-03", "alert", "entity_id", "alert_id"),
            rows(silent, "NS-01", "asset", _entity("c_nationkey"), "'AST-' || cast(c_custkey as string)"),
            rows(high.join(lines, "k", "left_anti"), "NS-03", "alert", "entity_id", "alert_id"),
        ]
        # One planted weakness each: (finding, scope, entity key or None for GLOBAL, target).
        single = [
            ("EG-04", "analyst", None, "A-04"), ("EG-05", "rule", None, "RULE-007"),
            ("EG-06", "analyst", None, "A-07"), ("NS-02", "category", 3, "Phishing"),
            ("NS-04", "volume", 7, None), ("NS-04", "volume", 9, None),
            ("NS-05", "asset_class", 11, "Database"),
            ("NS-06", "peer_volume", 7, None), ("NS-06", "peer_volume", 9, None),
            ("EX-01", "analyst", None, "A-05"), ("EX-02", "analyst", None, "A-09"),
            ("EX-03", "analyst", None, "A-03"), ("EX-04", "volume", 15, None),
            ("EX-05", "grid", 17, "Malware_Sev3"), ("EX-06", "root_cause", 19, "Site specific cause"),
            ("EX-07", "volume_series", 13, None), ("EX-08", "analyst", None, "A-10"),
        ]
        planted = [
            f"struct('{d}' as finding_id, '{f'ENT-{e:02d}' if e is not None else 'GLOBAL'}' as entity_id,"
            f" '{s}' as scope, '{t or f'ENT-{e:02d}'}' as target_id)"
            for d, s, e, t in single
        ]
        fixed = self.spark.range(1).select(F.expr(f"inline(array({', '.join(planted)}))"))
        return reduce(DataFrame.unionByName, [*parts, fixed])


_stars: dict[tuple[str, str], Star] = {}


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The landed tables of a directory, once per application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _stars:
        _stars[key] = Star(spark, sf_dir)
    return _stars[key]
