import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from watchloom.operators import audit

# Three recorded blocks of a ledger in this format.
RECORDED = [
    {"index": 0, "timestamp": "2026-09-30T16:44:18.303010", "event_type": "CHAIN_INIT", "data": "Genesis Block",
     "prev_hash": "0" * 64, "hash": "0e5a80af545a8b7b8890fe3b630d19312aa6520275c864162c0691e0944837dd"},
    {"index": 1, "timestamp": "2026-09-30T16:44:18.346275", "event_type": "FULL_ASSESSMENT_RUN",
     "data": "Generated 23 findings.", "prev_hash": "0e5a80af545a8b7b8890fe3b630d19312aa6520275c864162c0691e0944837dd",
     "hash": "00471f78c6861e6d4915d60e448c276963f4a449b57f282d1dda2679f73c5fcf"},
    {"index": 2, "timestamp": "2026-09-30T19:06:53.676969", "event_type": "ASSESSMENT_RUN",
     "data": "Generated 23 findings.", "prev_hash": "00471f78c6861e6d4915d60e448c276963f4a449b57f282d1dda2679f73c5fcf",
     "hash": "558640eeb22bd8946c033aaa99eca211c1b11183901590343a0c4e7c3e21c1e1"},
]


def digest(block):
    return hashlib.sha256(json.dumps({k: v for k, v in block.items() if k != "hash"}, sort_keys=True).encode()).hexdigest()


def chain(datas):
    out, prev = [], "0" * 64
    for i, data in enumerate(datas):
        block = {"index": i, "timestamp": f"2024-01-01T00:00:0{i}", "event_type": "T", "data": data, "prev_hash": prev}
        block["hash"] = prev = digest(block)
        out.append(block)
    return out


def write(tmp_path, blocks):
    path = tmp_path / "ledger.jsonl"
    path.write_text("\n\n".join(json.dumps(b) for b in blocks) + "\n")
    return str(path)


def check(spark, path):
    row = audit.verify_chain(audit.read_ledger(spark, path)).first()
    return row["valid"], row["first_broken"]


def test_recorded_blocks(spark, tmp_path):
    path = write(tmp_path, RECORDED)
    assert check(spark, path) == (True, None)
    columns = audit.read_ledger(spark, path)
    assert columns.filter(audit.block_hash() != F.col("hash")).count() == 0
    assert audit.last_block(columns).first()["index"] == 2
    assert [r["index"] for r in audit.ledger(columns).collect()] == [2, 1, 0]


@pytest.mark.parametrize("text", ["plain", 'quo"te \\ back', "tab\tnew\nline\x01", "naïve – 😀", "", "a/b<c>\x7f"])
def test_json_text_matches_the_json_library(spark, text):
    got = spark.createDataFrame([(text,)], "s string").select(audit.json_text("s")).first()[0]
    assert got == json.dumps(text)


def test_any_json_data(spark, tmp_path):
    blocks = chain(["x", {"b": [1, 2.5, None], "a": {"z": "é", "y": True}}, 7, "naïve"])
    assert check(spark, write(tmp_path, blocks)) == (True, None)


@pytest.mark.parametrize("case,broken", [("data", 2), ("prev", 3), ("removed", 3), ("genesis", 1), ("empty", None)])
def test_tampering(spark, tmp_path, case, broken):
    blocks = chain([f"d{i}" for i in range(6)])
    if case == "data":
        blocks[2]["data"] = "other"
    elif case == "prev":
        blocks[3]["prev_hash"] = "f" * 64
        blocks[3]["hash"] = digest(blocks[3])
    elif case == "removed":
        del blocks[2]
    elif case == "genesis":
        del blocks[0]
    else:
        blocks = []
    assert check(spark, write(tmp_path, blocks)) == (broken is None, broken)


def test_append(spark, tmp_path):
    path = str(tmp_path / "log")
    assert tuple(audit.verify_ledger(spark, path).first()) == (0, True, None, 0, None)
    first = audit.append_event(spark, path, "ASSESSMENT_RUN", "Generated 3 findings.", "2024-01-01T00:00:00")
    second = audit.append_event(spark, path, "DATA_IMPORT", "naïve", "2024-01-01T00:00:01")
    assert first != second and check(spark, path) == (True, None)
    assert audit.read_ledger(spark, path).count() == 3
    assert tuple(audit.verify_ledger(spark, path).first()) == (3, True, None, 0, None)


@pytest.fixture(scope="module")
def events(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("u", i, t0 + dt.timedelta(minutes=7 * (i // 2)), "E", f"d{i} é") for i in range(1200)] + [("v", 99, t0, "E", 'q"')] + [
        (None, i, t0, None, None) for i in range(3)]
    return spark.createDataFrame(rows, "key string, id int, ts timestamp_ntz, event_type string, data string").withColumn(
        "timestamp", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))


@pytest.mark.parametrize("size", [100, 500, 100_000])
def test_chains_are_one_sequence_per_key(spark, events, size):
    """Equal to a sequential fold, however the chain is cut into rounds."""
    blocks = audit.build_chains(events.repartition(5), "key", ["ts", "id"], F.to_date("ts"), slice_size=size)
    got = blocks.orderBy(F.col("key").desc_nulls_last(), "index").collect()
    assert [(r["key"], r["index"]) for r in got] == [("v", 0)] + [("u", i) for i in range(1200)]
    prev = None
    for r in got:
        block = {k: r[k] for k in ("index", "timestamp", "event_type", "data", "prev_hash")}
        assert r["prev_hash"] == ("0" * 64 if r["index"] == 0 else prev)
        assert digest(block) == r["hash"]
        prev = r["hash"]
    assert [r["data"] for r in got][1:1201] == [f"d{i} é" for i in range(1200)]


def test_long_chains_take_few_rounds(spark, events):
    """240 slices of 5 blocks are 5 rounds, since each has more blocks than the one before."""
    blocks = audit.build_chains(events, "key", ["ts", "id"], F.to_date("ts"), slice_size=5)
    assert len({f.rsplit("/", 2)[-2] for f in blocks.inputFiles()}) == 5
    assert [tuple(r) for r in audit.verify_chain(blocks.withColumn("computed", audit.block_hash()), ["key"]).orderBy("key").collect()] == [
        ("u", 1200, True, None, 0, None), ("v", 1, True, None, 0, None)]


def test_rounds_stop_growing():
    starts, size = audit._rounds(2000)
    assert size == audit.MOST and starts[:4] == [0, 2000, 10_000, 42_000]
    assert audit._rounds(audit.MOST * 2) == ([0], audit.MOST * 2)


def test_chains_of_no_events(spark, events):
    assert audit.build_chains(events.limit(0), "key", ["ts", "id"], F.to_date("ts")).collect() == []


def test_missing_stretch_is_named(spark, events):
    blocks = audit.build_chains(events.filter("key is not null"), "key", ["ts", "id"], F.to_date("ts"))
    cut = blocks.filter("not (key = 'u' and index between 300 and 349)").withColumn("computed", audit.block_hash())
    got = {r["key"]: tuple(r)[1:] for r in audit.verify_chain(cut, ["key"]).collect()}
    assert got == {"u": (1150, False, 350, 50, 300), "v": (1, True, None, 0, None)}


def test_seal_finds_what_verifies_by_itself(spark, events):
    some = events.filter("key is not null")
    build = lambda e: audit.build_chains(e, "key", ["ts", "id"], F.to_date("ts"))
    blocks = build(some)
    sealed = audit.seal(blocks, ["key"], fan_out=8)
    assert sealed.filter("node = 0 and level = 4").count() == 2 and sealed.agg(F.max("level")).first()[0] == 4
    assert audit.against_seal(blocks, sealed, ["key"], 8).collect() == []
    longer = build(some.unionByName(some.filter("id = 1199").withColumn("ts", F.expr("ts + interval 9 days"))))
    assert longer.count() == 1202 and audit.against_seal(longer, sealed, ["key"], 8).collect() == []
    anew = build(some.filter("id not between 800 and 849"))
    assert audit.verify_chain(anew.withColumn("computed", audit.block_hash()), ["key"]).filter("not valid or missing > 0").count() == 0
    assert [tuple(r) for r in audit.against_seal(anew, sealed, ["key"], 8).collect()] == [("u", 1200, 1150, 800, 1199, 50)]
    swapped = blocks.withColumn("hash", F.when(F.col("index") == 77, F.lit("0" * 64)).otherwise(F.col("hash")))
    assert [tuple(r) for r in audit.against_seal(swapped, sealed, ["key"], 8).collect()] == [("u", 1200, 1200, 72, 79, 0)]
    gone = audit.against_seal(blocks.filter("key = 'u'"), sealed, ["key"], 8).collect()
    assert [tuple(r) for r in gone] == [("v", 1, 0, 0, 0, 1)]
