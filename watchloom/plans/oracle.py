"""Each query as one DuckDB statement over the star-schema views.

Written independently of the Spark side: plain set SQL without the skew-safe detours.
"""

from __future__ import annotations

import re

FIXTURE = {
    "soc_entities": """
select 'ENT-' || lpad(n_nationkey::varchar, greatest(2, length(n_nationkey::varchar))::int, '0') entity_id, r_name sector,
  case when n_nationkey < 15 then 'Tier 1' else 'Tier 2' end size_tier,
  'Region-' || (n_regionkey + 1)::varchar region,
  case n_nationkey % 3 when 0 then 'In-House' when 1 then 'MSSP' else 'Hybrid' end soc_model
from nation join region on n_regionkey = r_regionkey""",
    "soc_assets": """
select 'AST-' || c_custkey::varchar asset_id, 'ENT-' || lpad(c_nationkey::varchar, greatest(2, length(c_nationkey::varchar))::int, '0') entity_id,
  case c_custkey % 6 when 0 then 'Server' when 1 then 'Workstation' when 2 then 'Router'
    when 3 then 'Firewall' when 4 then 'Database' else 'IoT' end as type,
  case c_custkey % 4 when 0 then 'Critical' when 1 then 'High' when 2 then 'Medium' else 'Low' end criticality,
  c_custkey % 20 <> 0 monitored_flag
from customer""",
    "soc_alerts_base": """
select o_orderkey k, c_custkey ck, c_nationkey nk, 'ALT-' || o_orderkey::varchar alert_id,
  'ENT-' || lpad(c_nationkey::varchar, greatest(2, length(c_nationkey::varchar))::int, '0') entity_id, 'AST-' || c_custkey::varchar asset_id,
  'RULE-' || lpad(((o_orderkey // 7) % 50)::varchar, 3, '0') rule_id,
  case o_orderstatus when 'F' then 'Malware' when 'O' then 'Phishing' else 'Auth Failure' end category,
  6 - substr(o_orderpriority, 1, 1)::int severity,
  timestamp '2024-01-01 00:00:00' + to_seconds((o_orderkey * 7919) % 2592000) created_ts,
  'A-' || lpad((c_custkey % 14)::varchar, 2, '0') analyst_id
from orders join customer on o_custkey = c_custkey""",
    "soc_alerts": """
select k, nk, alert_id, entity_id, asset_id, rule_id, category, severity, created_ts,
  case when k % 37 = 0 then null when severity >= 4 and k % 50 = 7 then created_ts + to_seconds(20)
    else created_ts + to_seconds(3600 * (6 - severity) + (k * 31) % 7200) end closed_ts,
  case when k % 37 = 0 then 'Open' else 'Closed' end status,
  case when analyst_id = 'A-10' or k % 3 = 0 then 'Benign' when k % 3 = 1 then 'True Positive'
    else 'False Positive' end disposition,
  analyst_id
from soc_alerts_base
where not (ck % 48 = 0) and not (nk = 3 and category = 'Phishing') and not (nk = 7 and k % 20 <> 0)
  and not (nk = 9 and k % 100 <> 0) and not (nk = 11 and ck % 6 = 4)
  and not (nk = 13 and created_ts >= timestamp '2024-01-24 00:00:00')
  and not (nk = 15 and created_ts > timestamp '2024-01-16 00:00:00' and k % 10 <> 0)
  and not (nk = 17 and category = 'Malware' and severity = 3)""",
    "soc_cases": """
select 'CAS-' || k::varchar case_id, entity_id,
  case when k % 211 = 0 then [alert_id, 'ALT-X' || k::varchar] else [alert_id] end alert_ids,
  created_ts + to_minutes(k % 10 + 1) opened_ts,
  case when analyst_id = 'A-03' then created_ts + to_minutes(k % 10 + 1) + to_seconds(60)
    when analyst_id = 'A-05' then created_ts + to_minutes(k % 10 + 1) + to_seconds(1 + k % 2)
    when analyst_id = 'A-07' then timestamp '2024-02-05 12:00:00' + to_seconds(k % 60)
    when severity >= 3 and k % 41 = 3 then created_ts + to_minutes(k % 10 + 1) + to_seconds(10)
    else closed_ts end closed_ts,
  severity, analyst_id as owner,
  case when nk = 19 then 'Site specific cause' else 'Investigated' end root_cause, k, rule_id
from soc_alerts where exists (select 1 from lineitem where l_orderkey = k)""",
    "soc_events": """
select case_id, entity_id, opened_ts + to_seconds((l_partkey * 17) % 3600) ts,
  case l_returnflag || l_linestatus when 'AF' then 'assign' when 'AO' then 'enrich' when 'NF' then 'pivot'
    when 'NO' then 'note' when 'RF' then 'evidence' else 'status' end event_type, owner actor
from soc_cases join lineitem on l_orderkey = k where owner <> 'A-09' and rule_id <> 'RULE-007'
union all
select case_id, entity_id, opened_ts + to_seconds(10), 'enrich', owner
from soc_cases where owner = 'A-09' and rule_id <> 'RULE-007'
union all
select case_id, entity_id, opened_ts + to_seconds(20), 'status', owner
from soc_cases where owner = 'A-09' and rule_id <> 'RULE-007'""",
    "soc_notes": """
select case_id, entity_id, opened_ts + to_minutes(5) ts,
  case when owner = 'A-04' then 'Template note: nothing found, closed.'
    else 'Analyst ' || owner || ' investigated ' || rule_id || ' in ' || case_id end as text
from soc_cases""",
    "soc_escalations": """
select case_id, alert_ids[1] alert_id, entity_id, opened_ts + to_minutes(5) ts, 'Tier 1' from_tier,
  'Tier 2' to_tier, 'Desk-2' recipient, 'Escalated' outcome
from soc_cases where severity >= 4 and k % 23 <> 1""",
    "soc_links": "select case_id, entity_id, unnest(alert_ids) alert_id from soc_cases",
}


def _secs(a: str, b: str) -> str:
    return f"(epoch_us({b}) - epoch_us({a})) / 1000000.0::double"


def _hash01(*parts: str) -> str:
    text = " || '|' || ".join(f"({p})::varchar" for p in parts)
    return f"(('0x' || substr(md5({text}), 1, 13))::bigint::double / {16 ** 13}.0::double)"


# Detectors: columns entity_id, target_id, severity, then evidence.
DETECTOR_SQL = {
    "EG-01": f"""
select entity_id, alert_id target_id, severity, round({_secs('created_ts', 'closed_ts')}, 6) close_seconds
from soc_alerts where severity >= 4 and closed_ts is not null and {_secs('created_ts', 'closed_ts')} < 60""",
    "EG-02": f"""
select entity_id, case_id target_id, severity, round({_secs('opened_ts', 'closed_ts')}, 6) close_seconds
from soc_cases where severity >= 3 and {_secs('opened_ts', 'closed_ts')} < 60""",
    "EG-03": """
select entity_id, alert_id target_id, severity from soc_alerts a
where severity >= 4 and closed_ts is not null
  and exists (select 1 from soc_links l where l.alert_id = a.alert_id)
  and not exists (select 1 from soc_escalations e where e.alert_id = a.alert_id)
  and not exists (select 1 from soc_links l join soc_escalations e using (case_id) where l.alert_id = a.alert_id)""",
    "EG-04": """
select 'GLOBAL' entity_id, owner target_id, 3 severity, round(sum(n)::double, 6) notes,
  round(max(n) / sum(n)::double, 6) share
from (select owner, regexp_replace(lower(trim(text)), '\\s+', ' ', 'g') body, count(*) n
      from soc_notes join soc_cases using (case_id) where owner is not null group by 1, 2)
group by owner having sum(n) >= 10 and max(n) / sum(n)::double >= 0.8""",
    "EG-05": """
select 'GLOBAL' entity_id, rule_id target_id, 3 severity, count(distinct case_id)::double cases
from soc_links join (select alert_id, rule_id from soc_alerts) using (alert_id)
  left join (select case_id, count(*) events from soc_events group by 1) using (case_id)
where rule_id is not null
group by rule_id having count(distinct case_id) >= 5 and coalesce(sum(events), 0) = 0""",
    "EG-06": """
select 'GLOBAL' entity_id, owner target_id, 3 severity, max(n)::double peak
from (select owner, count(*) over (partition by owner order by closed_ts
        range between interval 60 seconds preceding and current row) n
      from soc_cases where owner is not null and closed_ts is not null)
group by owner having max(n) >= 10""",
    "NS-01": """
select distinct entity_id, asset_id target_id, null::int severity from soc_assets
where criticality = 'Critical' and asset_id not in (select asset_id from soc_alerts)""",
    "NS-02": """
select e.entity_id, c.category target_id, 3 severity
from soc_entities e cross join (
  select category from soc_alerts group by category
  having count(distinct entity_id) * 1.0 / (select count(distinct entity_id) from soc_entities) >= 0.8) c
where not exists (select 1 from soc_alerts a where a.entity_id = e.entity_id and a.category = c.category)""",
    "NS-03": """
select entity_id, alert_id target_id, severity from soc_alerts
where severity >= 4 and alert_id not in (select alert_id from soc_links)""",
    "NS-04": """
select entity_id, entity_id target_id, 4 severity, n::double alerts, round(expected, 6) expected
from (select a.entity_id, coalesce(n, 0) n, assets * (
        select sum(n)::double / sum(assets)::double
        from (select entity_id, count(*) assets from soc_assets group by 1)
          join (select entity_id, count(*) n from soc_alerts group by 1) using (entity_id)) expected
      from (select entity_id, count(*) assets from soc_assets group by 1) a
        left join (select entity_id, count(*) n from soc_alerts group by 1) b using (entity_id))
where n < expected * 0.2::double""",
    "NS-05": """
select s.entity_id, s.type target_id, 3 severity, count(distinct s.asset_id)::double assets
from soc_assets s left join soc_alerts a on a.asset_id = s.asset_id
group by s.entity_id, s.type having count(a.alert_id) = 0""",
    "NS-06": """
select entity_id, entity_id target_id, 5 severity, n::double alerts, round(z, 6) z
from (select entity_id, n, (n - avg(n) over ()) / nullif(stddev_samp(n) over (), 0) z
      from (select e.entity_id, count(a.alert_id) n from soc_entities e left join soc_alerts a using (entity_id) group by 1))
where z < -1.25""",
    "EX-01": """
select 'GLOBAL' entity_id, analyst target_id, 4 severity, round(score, 6) score from forest_scores
where score > (select quantile_cont(score, 0.9) from forest_scores)""",
    "EX-02": """
select 'GLOBAL' entity_id, owner target_id, 4 severity, count(*)::double cases, max(steps)::double steps
from (select owner, case_id, count(*) steps, string_agg(event_type, '>' order by ts, event_type) path
      from soc_events join (select case_id, owner from soc_cases) using (case_id) where owner is not null group by 1, 2)
group by owner having count(*) >= 5 and count(distinct path) = 1""",
    "EX-03": f"""
select 'GLOBAL' entity_id, owner target_id, 4 severity, count(*)::double cases,
  round(stddev_samp({_secs('opened_ts', 'closed_ts')}), 6) std
from soc_cases where owner is not null and closed_ts is not null
group by owner having count(*) >= 5 and stddev_samp({_secs('opened_ts', 'closed_ts')}) < 2.0""",
    "EX-04": """
select entity_id, entity_id target_id, 3 severity, h1::double h1, h2::double h2
from (select entity_id, count(*) n, count(*) filter (2 * epoch_us(created_ts) <= mid2) h1,
        count(*) filter (2 * epoch_us(created_ts) > mid2) h2
      from soc_alerts join (select entity_id, epoch_us(min(created_ts)) + epoch_us(max(created_ts)) mid2
                            from soc_alerts group by 1) using (entity_id)
      group by entity_id)
where n >= 20 and h1 > 10 and h2 < h1 * 0.2::double""",
    "EX-05": """
select e.entity_id, c.category || '_Sev' || c.severity::varchar target_id, 4 severity
from (select entity_id from soc_alerts group by 1 having count(*) >= 50) e cross join (
  select category, severity from soc_alerts group by 1, 2
  having count(*)::double / (select count(*) from soc_alerts) > 0.05::double) c
where not exists (select 1 from soc_alerts a
  where a.entity_id = e.entity_id and a.category = c.category and a.severity = c.severity)""",
    "EX-06": """
select min(entity_id) entity_id, root_cause target_id, 3 severity, count(*)::double cases
from soc_cases where root_cause is not null
group by root_cause having count(distinct entity_id) = 1 and count(*) >= 5""",
    "EX-07": """
select entity_id, entity_id target_id, 4 severity, round(recent, 6) recent, round(prior, 6) prior
from (select entity_id, avg(n) filter (day > last - 7) recent, avg(n) filter (day <= last - 7) prior
      from (select e.entity_id, d.day::date as day, d.last, coalesce(c.n, 0) n
            from (select distinct entity_id from soc_alerts) e
            cross join (select unnest(generate_series(lo, hi, interval 1 day)) as day, hi::date as last
                        from (select min(created_ts::date) lo, max(created_ts::date) hi from soc_alerts)) d
            left join (select entity_id, created_ts::date as day, count(alert_id) n from soc_alerts group by 1, 2) c
              on c.entity_id = e.entity_id and c.day = d.day::date)
      group by entity_id having count(*) >= 7)
where recent < 0.5 and prior > 2.0""",
    "EX-08": """
select 'GLOBAL' entity_id, analyst_id target_id, 4 severity, count(*)::double alerts
from soc_alerts where analyst_id is not null and disposition is not null
group by analyst_id having count(*) > 20 and count(distinct disposition) = 1""",
}

FEATURES_SQL = f"""
select owner analyst, count(*) total_cases, avg({_secs('opened_ts', 'closed_ts')}) avg_closure_time,
  avg(case when {_secs('opened_ts', 'closed_ts')} < 60 then 1.0::double else 0.0::double end) fast_closure_rate
from soc_cases where owner is not null and closed_ts is not null group by owner"""


def _forest() -> dict[str, str]:
    """Isolation forest by unrolled levels; a tree grows from its 256 rows with the smallest hashes."""
    row = _hash01("'42'", "'row'", "tree", "analyst")
    out = {
        "features": FEATURES_SQL,
        "forest_0": f"""
select tree, analyst, [total_cases::double, avg_closure_time, fast_closure_rate] x, 1 node, null::double h,
  ceil(log2(greatest(least(256, (select count(*) from features)), 2)))::int max_depth,
  row_number() over (partition by tree order by {row}, analyst) <= 256 seen
from features cross join (select unnest(range(100)) tree)""",
    }
    expected = "case when n <= 1 then 0.0 when n = 2 then 1.0 else 2.0 * (ln(n - 1.0::double) + 0.5772156649015329::double) - 2.0 * (n - 1.0) / n end"
    for d in range(9):
        spans = ", ".join(f"min(x[{i}]) filter (seen) over w l{i}, max(x[{i}]) filter (seen) over w h{i}" for i in (1, 2, 3))
        pick = _hash01("'42'", "'feature'", "tree", "node")
        cut = _hash01("'42'", "'cut'", "tree", "node")
        out[f"spans_{d}"] = f"""
select *, list_filter([1, 2, 3], lambda i: [h1, h2, h3][i] > [l1, l2, l3][i]) vary from (
  select *, count(*) filter (seen) over w n, {spans} from forest_{d} window w as (partition by tree, node))"""
        out[f"forest_{d + 1}"] = f"""
select tree, analyst, x,
  case when h is not null or stop then node else 2 * node + case when x[f] > [l1, l2, l3][f] + {cut} *
    ([h1, h2, h3][f] - [l1, l2, l3][f]) then 1 else 0 end end node,
  case when h is null and stop then {d} + {expected} else h end h, max_depth, seen
from (select *, len(vary) = 0 or {d} >= max_depth or n <= 1 stop,
        vary[floor({pick} * len(vary))::int + 1] f from spans_{d})"""
    norm = re.sub(r"\bn\b", "m", expected)
    out["forest_scores"] = f"""
select analyst, round(pow(2.0::double, -avg(h) / (select nullif({norm}, 0) from (
  select least(256, count(*)) m from features))), 9) score
from forest_9 group by analyst"""
    return out


def _detector(detector_id: str) -> str:
    return f"select '{detector_id}' detector_id, * from ({DETECTOR_SQL[detector_id]})"


FINDINGS_SQL = "\nunion all ".join(
    f"select '{d}' detector_id, entity_id, target_id, severity from ({sql})" for d, sql in DETECTOR_SQL.items()
)

WEIGHTS = {
    "Threat Detection": 1.5, "Investigation": 1.2, "Escalation": 1.0, "Incident Response": 1.5,
    "Security Operations": 1.0, "Governance and Oversight": 0.8, "Operational Discipline": 1.0, "Cyber Resilience": 1.2,
}

SCORES_SQL = """
select *, coalesce(severity, 3) / 5.0::double * 0.8::double * 0.9::double score from findings"""

CAPABILITIES_SQL = f"""
select e.entity_id, c.capability, c.weight, 1.0 - product(case when score is null then 1.0::double else 1.0 - greatest(0.0, least(score, 0.99::double)) end) score
from (select distinct entity_id from scored) e
cross join (values {', '.join(f"('{c}', {w}::double)" for c, w in WEIGHTS.items())}) c(capability, weight)
left join (select entity_id, score, unnest(case detector_id when 'EG-01' then ['Investigation', 'Operational Discipline']
    when 'NS-01' then ['Threat Detection', 'Security Operations'] else ['Security Operations'] end) capability
  from scored) f on f.entity_id = e.entity_id and f.capability = c.capability
group by 1, 2, 3"""

RANKING_SQL = """
select entity_id, round(sum(score * weight) / 9.2::double, 4) attention_index from capabilities group by 1"""

PEERS = {
    "peer_feat": f"""
select e.entity_id, e.sector, e.size_tier, count(a.alert_id) alert_volume,
  count(*) filter (a.closed_ts is not null and {_secs('a.created_ts', 'a.closed_ts')} < 60) fast_closures
from soc_entities e left join soc_alerts a using (entity_id) group by 1, 2, 3""",
    "peer_long": """
select entity_id, sector || ' - ' || size_tier peer_group, 'alert_volume' metric, alert_volume::double v from peer_feat
union all select entity_id, sector || ' - ' || size_tier, 'fast_closures', fast_closures::double from peer_feat""",
    "peer_mid": """
select *, median(v) over w med, avg(v) over w mean, stddev_samp(v) over w std, count(*) over w n
from peer_long window w as (partition by peer_group, metric)""",
    "peer_dev": "select *, median(abs(v - med)) over (partition by peer_group, metric) mad from peer_mid",
    "peer_z": """
select entity_id, peer_group, metric, n, case when mad <> 0 then (v - med) / (mad * 1.4826::double)
  when std <> 0 then (v - mean) / std else 0.0 end z from peer_dev""",
    "peer_bench": """
select f.*, sector || ' - ' || size_tier peer_group, round(a.z * a.n / (a.n + 3.0), 6) alert_volume_z,
  round(b.z * b.n / (b.n + 3.0), 6) fast_closure_z
from peer_feat f join peer_z a on a.entity_id = f.entity_id and a.metric = 'alert_volume'
  join peer_z b on b.entity_id = f.entity_id and b.metric = 'fast_closures'""",
}

TRUTH_SQL = """
select 'EG-01' finding_id, alert_id target_id from soc_alerts where severity >= 4 and k % 50 = 7 and k % 37 <> 0
union all select 'EG-02', case_id from soc_cases where severity >= 3 and k % 41 = 3 and owner not in ('A-03', 'A-05', 'A-07')
union all select 'EG-03', alert_id from soc_alerts where severity >= 4 and k % 23 = 1 and closed_ts is not null
  and exists (select 1 from lineitem where l_orderkey = k)
union all select 'NS-01', 'AST-' || c_custkey::varchar from customer where c_custkey % 48 = 0
union all select 'NS-03', alert_id from soc_alerts where severity >= 4
  and not exists (select 1 from lineitem where l_orderkey = k)
union all select * from (values ('EG-04', 'A-04'), ('EG-05', 'RULE-007'), ('EG-06', 'A-07'), ('NS-02', 'Phishing'),
  ('NS-04', 'ENT-07'), ('NS-04', 'ENT-09'), ('NS-05', 'Database'), ('NS-06', 'ENT-07'), ('NS-06', 'ENT-09'),
  ('EX-01', 'A-05'), ('EX-02', 'A-09'), ('EX-03', 'A-03'), ('EX-04', 'ENT-15'), ('EX-05', 'Malware_Sev3'),
  ('EX-06', 'Site specific cause'), ('EX-07', 'ENT-13'), ('EX-08', 'A-10')) t(a, b)"""

TARGETED = "Targeted (High Attention Index & Severity)"
EXPLORATION = "Exploration (Random Baseline)"


def _samples(budget: int, replicates: int = 1, draws: int | None = None) -> dict[str, str]:
    """Weighted draws and review samples for a budget."""
    explore = max(1, int(budget * 0.2))
    targeted = draws if draws is not None else max(0, budget - explore)
    return {
        "weights": """
select entity_id, round(attention_index * 10000)::bigint w,
  ('0x' || substr(md5(entity_id), 1, 3))::int bucket from ranking""",
        "intervals": "select entity_id, sum(w) over (order by bucket, entity_id) hi, w from weights",
        "draws": f"""
select replicate, draw, entity_id from (
  select replicate, draw, floor({_hash01("'42'", "'draw'", "replicate", "draw")} * (select sum(w)::double from weights)) x
  from (select unnest(range({replicates})) replicate) cross join (select unnest(range({targeted})) draw))
join intervals on hi - w <= x and x < hi""",
        "best": """
select entity_id, list({'detector_id': detector_id, 'target_id': target_id, 'severity': severity}
    order by severity desc nulls last, detector_id, target_id) options
from (select *, row_number() over (partition by entity_id, target_id
        order by severity desc nulls last, detector_id) r from findings) where r = 1 group by entity_id""",
        "offers": "select replicate, draw, entity_id, options from draws join best using (entity_id)",
        "picks": f"""
select r replicate, 0 step, []::varchar[] taken, null::varchar entity_id,
  null::struct(detector_id varchar, target_id varchar, severity integer) pick
from (select unnest(range({replicates})) r)
union all
select replicate, step + 1, case when pick is null then taken else list_append(taken, pick.target_id) end, entity_id, pick
from (select p.replicate, p.step, p.taken, o.entity_id,
        list_filter(o.options, lambda c: not list_contains(p.taken, c.target_id))[1] pick
      from picks p join offers o on o.replicate = p.replicate and o.draw = p.step)""",
        "targeted": f"""
select replicate, step - 1 draw, pick.detector_id detector_id, entity_id, pick.target_id target_id,
  pick.severity severity, '{TARGETED}' selection_reason
from picks where pick is not null""",
        "explored": f"""
select replicate, r + {targeted} - 1 draw, detector_id, entity_id, target_id, severity,
  '{EXPLORATION}' selection_reason
from (select *, row_number() over (partition by replicate order by u, detector_id, entity_id, target_id) r
      from (select n.replicate, f.*, {_hash01("'42'", "'explore'", "n.replicate", "detector_id", "entity_id", "target_id")} u
            from findings f cross join (select unnest(range({replicates})) replicate) n
            where not exists (select 1 from targeted t where t.replicate = n.replicate and t.target_id = f.target_id)))
where r <= {explore}""",
        "sample": "select * from targeted union all select * from explored",
    }


_HEAD = """'{"data": ' || props_json || ', "event_type": "' || event_type || '", "index": ' || p::varchar || ', "prev_hash": "'"""
_TAIL = """'", "timestamp": "' || stamp || '"}'"""
AUDIT = {
    "audit_events": f"""
select *, {_HEAD} head, {_TAIL} tail from (
  select user_id % 5 "chain", event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') stamp, event_type, to_json(props)::varchar props_json,
    props, row_number() over (partition by user_id % 5 order by ts, event_id) - 1 p from events)""",
    "chained": f"""
select "chain", 0::bigint idx, '{'0' * 64}' prev_hash, sha256(head || '{'0' * 64}' || tail) hash from audit_events where p = 0
union all
select c."chain", c.idx + 1, c.hash, sha256(head || c.hash || tail)
from chained c join audit_events e on e."chain" = c."chain" and e.p = c.idx + 1""",
    "seal_1": """
select "chain", 1 "level", idx // 256 node, sha256(string_agg(hash, '' order by idx)) digest, count(*) blocks from chained group by "chain", node""",
    "seal_2": """
select "chain", 2 "level", node // 256 node, sha256(string_agg(digest, '' order by s.node)) digest, sum(blocks)::bigint blocks
from seal_1 s group by "chain", s.node // 256""",
}

STAMP_FORMS = {
    "0": "created_ts", "1": "created_ts - interval 2 hours", "2": "date_trunc('minute', created_ts)",
    "3": "created_ts", "4": "date_trunc('day', created_ts)", "5": "date_trunc('minute', created_ts)",
}

RAW_ALERTS_SQL = """
select k, case when k % 29 = 0 then alert_id || '-' else alert_id end alert_id, rule_id,
  case when k % 31 = 0 then null else category end category,
  case k % 5 when 0 then 'High' when 1 then ' critical' when 2 then '2.9' when 3 then 'unknown'
    else severity::varchar end sev_text,
  case k % 5 when 0 then 3 when 1 then 4 when 2 then 2 when 3 then null else severity end sev,
  case when k % 43 = 0 then '31/04/2024 10:00' when k % 2 = 0 then strftime(created_ts, '%Y-%m-%dT%H:%M:%S')
    else strftime(created_ts, '%-d/%-m/%Y %-H:%M:%S') end ts_text,
  case when k % 43 = 0 then null else created_ts end ts, status, disposition, analyst_id
from soc_alerts"""

CHECKED_SQL = """
select *, case when category is null then 'category' when sev is null then 'severity'
  when ts is null then 'created_ts' end field from raw_alerts"""

# Name -> body; a body may use any CTE below by name.
CTES: dict[str, str] = {
    **FIXTURE, **_forest(), "findings": FINDINGS_SQL, "scored": SCORES_SQL, "capabilities": CAPABILITIES_SQL,
    "ranking": RANKING_SQL, **PEERS, "truth": TRUTH_SQL, **AUDIT, "raw_alerts": RAW_ALERTS_SQL,
    "checked": CHECKED_SQL,
}

_SHARES = ["alert_id", "rule_id", "category", "sev", "ts", "status", "disposition", "analyst_id"]
_SHARE_NAMES = {"sev": "severity", "ts": "created_ts"}

SELECTS: dict[str, str] = {
    **{d.lower().replace("-", "_"): _detector(d) for d in DETECTOR_SQL},
    "all_findings": "select * from findings",
    "ex_01_features": """
select analyst, total_cases, round(avg_closure_time, 6) avg_closure_time, round(fast_closure_rate, 6) fast_closure_rate
from features""",
    "finding_scores": "select detector_id, entity_id, target_id, severity, round(score, 6) score from scored",
    "capability_scores": "select entity_id, capability, round(score, 6) score from capabilities",
    "entity_ranking": "select * from ranking order by attention_index desc, entity_id",
    "ranking_top5": """
select row_number() over (order by attention_index desc, entity_id)::int "rank", entity_id, attention_index from ranking
order by attention_index desc, entity_id limit 5""",
    "peer_features": "select * from peer_feat",
    "peer_robust_z": "select entity_id, peer_group, metric, round(z, 6) z from peer_z",
    "peer_benchmarks": "select * from peer_bench",
    "peer_outliers": """
select entity_id, peer_group, alert_volume_z, fast_closure_z from peer_bench
where abs(alert_volume_z) > 2 or abs(fast_closure_z) > 2""",
    "uniform_sample": f"""
select detector_id, entity_id, target_id, severity from findings
order by {_hash01("'42'", "'uniform'", "detector_id", "entity_id", "target_id")}, 1, 2, 3 limit 25""",
    "recall_by_detector": f"""
select d.detector_id, coalesce(truth, 0) truth, coalesce(hits, 0) hits, round(coalesce(hits / truth::double, 1.0), 6) recall
from (select unnest([{', '.join(f"'{d}'" for d in DETECTOR_SQL)}]) detector_id) d left join (
  select finding_id, count(*) truth, count(f.target_id) hits
  from (select distinct * from truth) t
    left join (select distinct detector_id, target_id from findings) f
    on f.detector_id = t.finding_id and f.target_id = t.target_id
  group by 1) c on c.finding_id = d.detector_id""",
    "kpi_summary": """
select (select count(*) from soc_entities) entities, (select count(*) from findings) findings,
  (select count(*) from ranking) ranked, round((select avg(attention_index) from ranking), 6) avg_attention_index""",
    "portfolio_status": """
select case when attention_index = 0 then 'Good'
  when attention_index >= (select quantile_cont(attention_index, 0.8) from ranking) then 'Critical' else 'Warning' end status,
  entity_id, attention_index from ranking""",
    "risk_levels": """
select entity_id, attention_index, case when attention_index > 0.3::double then 'Critical'
  when attention_index > 0.1::double then 'Warning' else 'Good' end risk_level
from ranking order by attention_index desc, entity_id""",
    "top_findings": "select * from findings order by severity desc nulls last, detector_id, entity_id, target_id limit 50",
    "findings_filter": "select * from findings where detector_id = 'EG-02' and entity_id = 'ENT-08'",
    "findings_by_detector": "select detector_id, count(*) findings from findings group by 1",
    "duration_seconds": """
select event_id, (epoch_us(ts) - epoch_us(timestamp '2024-01-01 00:00:00')) / 1000000.0::double "seconds" from events""",
    "daily_series_gapfill": """
select e.entity_id, d.day::date as day, coalesce(c.n, 0) "rows"
from (select distinct entity_id from soc_alerts) e
cross join (select unnest(generate_series(lo, hi, interval 1 day)) as day
            from (select min(created_ts::date) lo, max(created_ts::date) hi from soc_alerts)) d
left join (select entity_id, created_ts::date as day, count(*) n from soc_alerts group by 1, 2) c
  on c.entity_id = e.entity_id and c.day = d.day::date""",
    "global_zscore": """
select user_id, n events, round((n - avg(n) over ()) / nullif(stddev_samp(n) over (), 0), 6) z
from (select user_id, count(*) n from events group by 1)""",
    "category_severity_grid": """
select category, severity, count(*) alerts, round(count(*)::double / (select count(*) from soc_alerts), 6) share
from soc_alerts group by 1, 2""",
    "case_event_paths": """
select case_id, row_number() over (partition by case_id order by ts, event_type) "position", event_type from soc_events""",
    "audit_block_hash": f"""
select event_id "index", sha256('{{"data": ' || props_json || ', "event_type": "' || event_type || '", "index": '
  || event_id::varchar || ', "prev_hash": "{'0' * 64}", "timestamp": "' || stamp || '"}}') hash
from audit_events""",
    "audit_chain_build": 'select "chain", idx "index", prev_hash, hash from chained',
    "audit_verify": """
select "chain", count(*) blocks, not bool_or(hash[1:2] = '00' or ("chain" = 3 and idx = 120)) valid,
  (min(idx) filter (hash[1:2] = '00' or ("chain" = 3 and idx = 120)))::bigint first_broken,
  case when "chain" = 3 then 20 else 0 end::bigint missing, case when "chain" = 3 then 100 end::bigint first_missing
from chained where not ("chain" = 3 and idx between 100 and 119) group by 1""",
    "audit_seal": """
select "chain", "level", node, digest, blocks from seal_1
union all select "chain", "level", node, digest, blocks from seal_2 where (select max(idx) from chained) >= 256""",
    "audit_removed_stretch": """
select "chain", n sealed_blocks, case when "chain" = 1 then n - 20 else 151 end blocks, 0::bigint first_changed, n - 1 last_changed,
  case when "chain" = 1 then 20 else n - 151 end missing, true valid
from (select "chain", count(*) n from audit_events where "chain" in (1, 4) group by 1)""",
    "audit_last_block": """
select "chain", max(idx) "index", arg_max(hash, idx) hash from chained group by 1""",
    "audit_ledger": """
select p "index", "chain", stamp "timestamp", event_type, props "data" from audit_events""",
    "src_union_by_name": """
select alert_id, entity_id, category, severity, created_ts, status,
  case when nk >= 12 then analyst_id end analyst_id, null::varchar shift from soc_alerts""",
    "ingest_map_columns": """
select alert_id, rule_id, category, sev_text severity, ts_text created_ts, status, disposition, analyst_id
from raw_alerts""",
    "ingest_parse_list": """
select k, case k % 12 when 0 then 'A' || k || '~B,' || k when 1 then 'A' || k when 2 then 'A' || k || '~B' || k
    when 3 then 'A' || k || '~B' || k when 4 then 'A' || k || '~B' || k || '~C' when 5 then 'A' || k when 7 then 'A"' || k || '~c'
    when 8 then '[''A'', ''' || k || ''']~c' when 9 then 'A' || k || '~None~True' when 10 then 'A' || k || '~1.5'
    when 11 then 'A' || k || '~B' else '' end items,
  case k % 12 when 0 then 2 when 1 then 1 when 2 then 2 when 3 then 2 when 4 then 3 when 5 then 1 when 6 then -1 when 9 then 3 else 2 end n
from soc_cases""",
    "ingest_numbers": """
select k, case k % 6 when 0 then k + 0.25::double when 1 then -7.0 when 2 then 1000.0 end::double reported_mttr_mins,
  case when k % 4 <> 0 then k % 100 end::double reported_sla_percent from soc_alerts""",
    "finding_rationales": f"""
select detector_id, entity_id, target_id, rationale from (
  select 'NS-01' detector_id, d.entity_id, d.target_id, 'Critical asset of type ''' || a.type || ''' produced no alert in the period.' rationale
  from ({DETECTOR_SQL['NS-01']}) d join soc_assets a on a.asset_id = d.target_id
  union all select 'NS-02', entity_id, target_id, 'Category ''' || target_id || ''' is common among entities but missing here.'
  from ({DETECTOR_SQL['NS-02']})
  union all select 'NS-03', entity_id, target_id, 'Alert of severity ' || severity || ' was raised but no case was opened.'
  from ({DETECTOR_SQL['NS-03']})
  union all select 'NS-05', d.entity_id, d.target_id, (select count(*) from soc_assets a where a.entity_id = d.entity_id and a.type = d.target_id)
    || ' assets of type ''' || d.target_id || ''', none with an alert.' from ({DETECTOR_SQL['NS-05']}) d)""",
    "ingest_severity": """
select k, case k % 11 when 0 then 3 when 1 then 4 when 2 then 1 when 3 then 3 when 4 then 2 when 5 then -1
  when 6 then null when 7 then null when 8 then null when 9 then 99 else severity end severity from soc_alerts""",
    "ingest_timestamp": "select k, case k % 8 "
    + " ".join(f"when {i} then {e}" for i, e in STAMP_FORMS.items()) + " end ts from soc_alerts",
    "ingest_coerce": "select k, alert_id, category, sev severity, ts created_ts, status from raw_alerts",
    "ingest_dedup": """
select asset_id, alert_id from (
  select *, row_number() over (partition by asset_id order by k) r
  from (select k, case when k % 3 = 0 then null else asset_id end asset_id, alert_id from soc_alerts)) where r = 1""",
    "ingest_rejects": """
select k + 2 "row", field, case field when 'category' then 'Field required'
    when 'severity' then 'unparseable value ''' || sev_text || '''' else 'unparseable value ''' || ts_text || '''' end problem,
  alert_id id
from checked where field is not null""",
    "ingest_accepted": """
select alert_id, 'ENT-SUB' entity_id, category, sev severity, ts created_ts, status, disposition, analyst_id,
  null::varchar shift
from checked where field is null""",
    "dq_completeness": "\nunion all ".join(
        f"""select '{_SHARE_NAMES.get(c, c)}' "column", round(avg(case when {c} is not null then 1.0::double else 0.0 end), 3) completeness from raw_alerts"""
        for c in _SHARES),
    "dq_quality_score": f"""
select 'alerts' "table", count(*) rows_in, count(*) filter (field is null) rows_ok, count(field) rows_rejected,
  0::bigint duplicates_dropped,
  round(100 * (0.6::double * count(*) filter (field is null) / count(*) + 0.4::double * ({' + '.join(
      f"round(avg(case when {c} is not null then 1.0::double else 0.0 end), 3)" for c in _SHARES)}) / {len(_SHARES)}), 1)
  quality_score
from checked""",
    "dq_integrity": """
select (select count(distinct case_id) from soc_links where alert_id not in (select alert_id from soc_alerts))
    cases_referencing_unknown_alert,
  (select count(*) from soc_alerts where alert_id not in (select alert_id from soc_links)) alerts_without_case,
  (select count(*) from soc_events where case_id not in (select case_id from soc_cases)) events_referencing_unknown_case,
  (select count(*) from soc_cases where case_id not in (select case_id from soc_events)) cases_without_events""",
    "dq_missing_analyst": """
select count(*) total, count(*) filter (k % 13 = 0) missing,
  round(count(*) filter (k % 13 = 0) * 100.0::double / count(*), 6) missing_percent from soc_alerts""",
    "dq_orphan_alerts": "select count(*) orphans from soc_alerts where k % 17 = 0",
    "upsert_entity": """
select alert_id, entity_id, case when entity_id = 'ENT-08' then 'Reopened' else status end status from soc_alerts""",
    "append_validated": "select alert_id, entity_id, severity, closed_ts from soc_alerts",
    "json_bundle": "\nunion all ".join(
        f"""select '{t}' "table", entity_id, count(*) "rows", count({c}) filled from soc_{t} group by all"""
        for t, c in {"entities": "sector", "assets": "monitored_flag", "alerts": "closed_ts", "cases": "alert_ids", "events": "ts"}.items()),
    "csv_scan": """
select alert_id "Alert ID", k::varchar "Number", case k % 5 when 0 then 'first ' || k || chr(10) || 'second; "' || category || '"'
    when 1 then 'caf' || chr(233) || '; ' || k when 2 then '5" pipe' when 4 then category end "Note", status "State"
from soc_alerts""",
    "csv_rejects": """
select file, "row", 'severity' field, 'unparseable value ''so so''' problem, id from (
  select *, row_number() over (partition by id order by file, "row") n from (
    select k, case when k % 3 = 0 then 1 else 2 end file, row_number() over (partition by k % 3 = 0 order by k) + 1 "row",
      case when k % 7 = 3 then 'ALT-' || (k - 1)::varchar else alert_id end id from soc_alerts))
where n = 1 and k % 5 = 2""",
    "csv_bundle_store": """
select t.* from (select unnest(['007', 'ENT-9']) entity_id) e, lateral (
  select 'entities' "table", e.entity_id, 'Power' item
  union all select 'alerts', e.entity_id, alert_id from soc_alerts
  union all select 'cases', e.entity_id, case_id || '|' || array_to_string(alert_ids, '|') from soc_cases
  union all select 'events', e.entity_id, case_id || '|' || epoch_us(ts) || '|' || event_type from soc_events) t""",
    "csv_bundle": """
select 'alerts' "table", n rows_in, n rows_ok, 0::bigint rows_rejected, 0::bigint duplicates_dropped,
  round(100 * (0.6::double + 0.4::double * (9.0 + round(closed, 3)) / 10), 1) quality_score
from (select count(*) n, count(closed_ts) / count(*)::double closed from soc_alerts)
union all
select 'cases', n, n, 0, 0, round(100 * (0.6::double + 0.4::double * (6.0 + round(closed, 3)) / 7), 1)
from (select count(*) n, count(closed_ts) / count(*)::double closed from soc_cases)
union all
select 'events', count(*), count(*), 0, 0, 100.0 from soc_events""",
    "export_row_counts": "\nunion all ".join(
        f"""select '{t}' "table", count(*) "rows" from soc_{t}"""
        for t in ("entities", "assets", "alerts", "cases", "events", "escalations", "notes")),
}

# The tables as one entity submits them: three of the seven, all rows its own.
SUBMITTED = {
    "soc_entities": "select '007' entity_id, 'Power' sector, 'Tier 1' size_tier, 'Region-1' region, 'MSSP' soc_model",
    "soc_alerts": f"select * replace ('007' as entity_id) from ({FIXTURE['soc_alerts']})",
    **{name: f"select * from ({FIXTURE[name]}) where false" for name in ("soc_assets", "soc_notes", "soc_escalations")},
}

# Queries that sample: name -> (budget, replicates, draws, select).
SAMPLED: dict[str, tuple[dict[str, str], str]] = {
    "weighted_draws": (_samples(250, draws=200), "select draw::int draw, entity_id from draws"),
    "review_sample": (
        _samples(10), "select draw::int draw, detector_id, entity_id, target_id, severity, selection_reason from sample"),
    "sample_composition": (_samples(50), "select selection_reason, count(*) findings from sample group by 1"),
    "export_review_queue": (
        _samples(10),
        "select entity_id, target_id, detector_id, severity::varchar severity, selection_reason from sample"),
    "lift_over_random": (
        {
            **_samples(10, 50),
            "random_sample": f"""
select replicate, target_id from (
  select n.replicate, f.target_id, row_number() over (partition by n.replicate order by
    {_hash01("'42'", "'random'", "n.replicate", "detector_id", "entity_id", "target_id")}, detector_id, entity_id, target_id) r
  from findings f cross join (select unnest(range(50)) replicate) n) where r <= 10""",
            "yields": """
select (select count(*) from (select distinct replicate, target_id from random_sample)
          where target_id in (select target_id from truth)) / 50.0::double rnd,
  (select count(*) from (select distinct replicate, target_id from sample)
          where target_id in (select target_id from truth)) / 50.0::double opt""",
        },
        """
select round(rnd, 2) random_yield, round(opt, 2) optimized_yield,
  round(case when rnd > 0 then opt / rnd else 0.0 end, 2) lift_multiplier from yields""",
    ),
}


def _statement(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` with the CTEs it needs, in dependency order."""
    ctes = {**CTES, **(extra or {})}
    needed: list[str] = []

    def visit(sql: str, skip: str | None = None) -> None:
        for name in ctes:
            if name != skip and name not in needed and re.search(rf"\b{name}\b(?!')", sql) and re.search(
                    rf"(from|join)\s+\(?\s*{name}\b", sql):
                visit(ctes[name], name)
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    recursive = "recursive " if {"chained", "picks"} & set(needed) else ""
    return f"with {recursive}" + ",\n".join(f"{n} as ({ctes[n]})" for n in needed) + body


def oracle_sql() -> dict[str, str]:
    out = {name: _statement("\n" + body) for name, body in SELECTS.items()}
    out.update({name: _statement("\n" + body, extra) for name, (extra, body) in SAMPLED.items()})
    pairs = {"soc_cases": f"select * replace (owner || '/' || rule_id as owner) from ({FIXTURE['soc_cases']})"}
    out["ex_01_desks"] = _statement("\nselect analyst, score from forest_scores", pairs)
    alone = {name: f"select * from ({FIXTURE[name]}) where false" for name in ("soc_entities", "soc_assets", "soc_cases")}
    out["missing_tables"] = _statement("\nselect * from findings", alone)
    out["csv_to_findings"] = _statement("\nselect * from findings", SUBMITTED)
    return out
