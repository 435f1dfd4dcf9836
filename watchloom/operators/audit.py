"""Hash-chained audit log: build, append, verify, list.

A block is hashed as its JSON text with sorted keys and without the hash itself, so
changing any field, or dropping a block, shows. A chain is one sequence however long it
is; chains are independent of each other. A seal (a tree of hashes over a chain) kept
elsewhere also shows a stretch that was taken out of a chain linked anew.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from json.encoder import encode_basestring_ascii

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from watchloom.functions.ordering import position_within
from watchloom.schemas import BLOCK
from watchloom.session import materialise, scratch_path

# Fixed value: prev_hash of the first block of a chain.
GENESIS_PREV = "0" * 64


def json_text(col) -> Column:
    """A string as a JSON literal in ASCII: escapes for quotes, controls and all non-ASCII."""
    c = F.col(col) if isinstance(col, str) else col
    quoted = F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)
    escaped = F.concat_ws("", F.transform(F.split(quoted, ""), lambda ch: F.when(
        ch.rlike(r"^[\x00-\x7e]*$"), ch
    ).otherwise(F.regexp_replace(F.lower(F.hex(F.encode(ch, "UTF-16BE"))), "(.{4})", r"\\u$1"))))
    return F.when(quoted.rlike(r"^[\x00-\x7e]*$"), quoted).otherwise(escaped)


def block_body(index: Column, timestamp: Column, event_type: Column, data_json: Column, prev_hash: Column) -> Column:
    """The hashed text of a block; ``data_json`` is the JSON form of its data."""
    return F.concat(
        F.lit('{"data": '), data_json, F.lit(', "event_type": '), json_text(event_type),
        F.lit(', "index": '), index.cast("string"), F.lit(', "prev_hash": "'), prev_hash,
        F.lit('", "timestamp": '), json_text(timestamp), F.lit("}"),
    )


def block_hash(prev_hash=None) -> Column:
    """Hash of blocks with text data, from their columns."""
    return F.sha2(block_body(
        F.col("index"), F.col("timestamp"), F.col("event_type"), json_text("data"),
        prev_hash if prev_hash is not None else F.col("prev_hash")), 256)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """A JSON-lines ledger with ``computed``: the hash its content should have.

    ``data`` may be any JSON value (kept as its JSON text), so a block is re-serialised
    by the JSON library, line by line in Arrow batches.
    """
    out = T.StructType([*BLOCK.fields, T.StructField("computed", T.StringType())])
    names = [f.name for f in BLOCK.fields]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for line in batch["value"]:
                block = json.loads(line)
                reported = block.pop("hash", None)
                body = json.dumps(block, sort_keys=True)
                text = block["data"] if isinstance(block["data"], str) else json.dumps(block["data"], sort_keys=True)
                full = {**block, "data": text, "hash": reported}
                rows.append([*[full.get(n) for n in names], hashlib.sha256(body.encode()).hexdigest()])
            yield pd.DataFrame(rows, columns=[*names, "computed"])

    return spark.read.text(path).filter(F.trim("value") != "").mapInPandas(parse, out)


def verify_blocks(blocks: DataFrame, keys: list[str] | None = None, slot_size: int = 65_536) -> DataFrame:
    """Every block with ``linked``, ``intact``, ``valid`` and ``gap``: how many indexes before it are missing.

    ``blocks`` carries ``computed``; predecessors are found by an equi-join on the
    position in the chain, so a long chain is checked in parallel.
    """
    keys = keys or []
    placed = position_within(
        blocks, keys, F.floor(F.col("index") / slot_size).cast("long"), [F.col("index"), F.col("hash")], "position"
    )
    before = placed.select(*keys, (F.col("position") + 1).alias("position"), F.col("hash").alias("before"), F.col("index").alias("at"))
    joined = placed.join(before, [*keys, "position"], "left")
    linked = F.col("prev_hash").eqNullSafe(F.coalesce("before", F.lit(GENESIS_PREV)))
    return (
        joined.withColumn("linked", linked)
        .withColumn("intact", F.col("hash").eqNullSafe(F.col("computed")))
        .withColumn("valid", F.col("linked") & F.col("intact"))
        .withColumn("gap", F.greatest(F.col("index") - F.coalesce("at", F.lit(-1)) - 1, F.lit(0)))
        .drop("before", "at", "position")
    )


def verify_chain(blocks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, blocks, valid, first_broken, missing, first_missing): valid when no block is broken; an empty log is valid.

    ``missing`` counts the indexes that no block has, up to the last block.
    """
    checked = verify_blocks(blocks, keys)
    return checked.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("blocks"),
        F.coalesce(F.min("valid"), F.lit(True)).alias("valid"),
        F.min(F.when(~F.col("valid"), F.col("index"))).alias("first_broken"),
        F.coalesce(F.sum("gap"), F.lit(0)).alias("missing"),
        F.min(F.when(F.col("gap") > 0, F.col("index") - F.col("gap"))).alias("first_missing"),
    )


def verify_ledger(spark: SparkSession, path: str) -> DataFrame:
    """``verify_chain`` of the ledger at ``path``; a ledger not started yet is valid."""
    if _exists(spark, path):
        blocks = read_ledger(spark, path)
    else:
        blocks = spark.createDataFrame([], BLOCK).withColumn("computed", F.lit(None).cast("string"))
    return verify_chain(blocks)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


#: Blocks of a chain that are linked in its first round; a round has ``GROWTH`` times those of the one before.
SLICE = 65_536
GROWTH = 4
#: Rounds grow up to this, which bounds what a task sorts.
MOST = 1 << 22


def _rounds(slice_size: int) -> tuple[list[int], int]:
    """First indexes of the growing rounds, and how many blocks each round has from the last of them on."""
    starts, size = [0], slice_size
    while size < MOST:
        starts.append(starts[-1] + size)
        size = min(size * GROWTH, MOST)
    return starts, size


def build_chains(events: DataFrame, key: str, order: list[str], slot: Column, slice_size: int = SLICE) -> DataFrame:
    """(key, index, timestamp, event_type, data, prev_hash, hash): one unbroken chain of blocks per key, for events in ``order``.

    A block's hash needs the one before, so a chain is linked in order; what can be in
    parallel is chains. Events get their index in parallel, then chains are linked round by
    round: a round takes the next blocks of every chain that is so long, a task streams its
    blocks with one hash in memory, and the last hash of each chain is handed to the next
    round. The first round has ``slice_size`` blocks of a chain, each later one ``GROWTH`` times
    as many up to ``MOST``, so even long chains take few rounds, and beyond that a chain
    takes more rounds, not more memory or disk of one task. Each round is written, so a lost
    executor costs its tasks of the current round. ``slot`` is a column that does not decrease
    along ``order``. Events without a key belong to no chain.
    """
    spark = events.sparkSession
    placed = position_within(events.filter(F.col(key).isNotNull()), [key], slot, [F.col(c) for c in order], "position").select(
        key, (F.col("position") - 1).cast("long").alias("index"), "timestamp", "event_type", "data")
    entries, linked = scratch_path(spark, "chain-entries"), scratch_path(spark, "chains")
    starts, size = _rounds(slice_size)
    index = F.col("index")
    step = sum(((index >= at).cast("long") for at in starts[1:]), F.floor(F.greatest(index - starts[-1], F.lit(0)) / size))
    placed.withColumn("round", step.cast("long")).write.partitionBy("round").parquet(entries)
    entry = T.StructType([*placed.schema.fields, T.StructField("round", T.LongType())])
    block = T.StructType([*placed.schema.fields, T.StructField("prev_hash", T.StringType()), T.StructField("hash", T.StringType())])
    rows = spark.read.schema(entry).parquet(entries)
    last = rows.agg(F.max("round")).first()[0]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for step in range(0 if last is None else last + 1):
        mine = rows.filter(F.col("round") == step).drop("round").withColumn("hash", F.lit(None).cast("string"))
        if step:
            first = starts[step] if step < len(starts) else starts[-1] + (step - len(starts) + 1) * size
            before = spark.read.schema(block).parquet(f"{linked}/round={step - 1}")
            mine = mine.unionByName(before.filter(F.col("index") == first - 1).drop("prev_hash"))
        ordered = mine.repartitionByRange(tasks, key).sortWithinPartitions(key, "index")  # by range: long chains get tasks of their own
        ordered.mapInArrow(_linker(key, block), block).write.parquet(f"{linked}/round={step}")
    if last is None:
        return spark.createDataFrame([], block)
    return spark.read.schema(T.StructType([*block.fields, T.StructField("round", T.LongType())])).parquet(linked).drop("round")


def _linker(key: str, block: T.StructType):
    """Links blocks that come chain by chain in order; a row with a hash is the block before the first one."""
    names = block.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, prev, sha256 = object(), GENESIS_PREV, hashlib.sha256

        def text(value) -> str:
            return encode_basestring_ascii(value) if isinstance(value, str) else json.dumps(value)

        for batch in batches:
            keep, prevs, hashes = [], [], []
            columns = (batch.column(c).to_pylist() for c in (key, "index", "timestamp", "event_type", "data", "hash"))
            for row, (of, index, timestamp, event_type, data, known) in enumerate(zip(*columns)):
                if of != chain:
                    chain, prev = of, GENESIS_PREV
                if known is not None:
                    prev = known
                    continue
                body = (f'{{"data": {text(data)}, "event_type": {text(event_type)}, "index": {index}, '
                        f'"prev_hash": "{prev}", "timestamp": {text(timestamp)}}}')  # as json.dumps writes it
                keep.append(row)
                prevs.append(prev)
                prev = sha256(body.encode()).hexdigest()
                hashes.append(prev)
            taken = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(taken.column(c) for c in names[:-2]), pa.array(prevs, pa.string()), pa.array(hashes, pa.string())], names)

    return run


#: Children of one node of a seal.
FAN_OUT = 256


def seal(blocks: DataFrame, keys: list[str], fan_out: int = FAN_OUT) -> DataFrame:
    """(keys, level, node, digest, blocks): a tree of hashes over each chain, to be kept apart from the ledger.

    A node hashes the digests of up to ``fan_out`` children, level 1 those of blocks; the top
    node of a chain stands for all its blocks. Every level is one grouped pass over a
    ``fan_out``-th of the one below, so no task holds more than a node.
    """
    rows = blocks.select(*keys, F.col("index").alias("node"), F.col("hash").alias("digest"), F.lit(1).cast("long").alias("blocks"))
    out, level, longest = None, 0, 1
    while longest:
        level += 1
        child = F.struct("node", "digest")
        rows = materialise(rows.groupBy(*keys, F.floor(F.col("node") / fan_out).cast("long").alias("node")).agg(
            F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(child)), lambda c: c["digest"]), ""), 256).alias("digest"),
            F.sum("blocks").alias("blocks")), "seal")  # whoever compares a seal reads it several times, the blocks once
        part = rows.select(*keys, F.lit(level).alias("level"), "node", "digest", "blocks")
        out = part if out is None else out.unionByName(part)
        longest = rows.agg(F.max("node")).first()[0]
    return out


def against_seal(blocks: DataFrame, sealed: DataFrame, keys: list[str], fan_out: int = FAN_OUT) -> DataFrame:
    """(keys, sealed_blocks, blocks, first_changed, last_changed, missing): chains that no longer hold what was sealed.

    Blocks added since do not count. The tops are compared first, then, of the chains whose
    tops differ, the nodes right over the blocks: the changed stretch is known to within one
    such node at either end. A chain that was linked anew after a stretch was taken out
    verifies by itself and is found here.
    """
    sizes = materialise(sealed.filter("level = 1").groupBy(*keys).agg(F.sum("blocks").alias("sealed_blocks")), "sealed-sizes")
    mine = blocks.join(sizes, keys).filter("index < sealed_blocks")
    now = seal(mine.select(*keys, "index", "hash"), keys, fan_out)

    def top(df: DataFrame, name: str) -> DataFrame:
        """The lowest node that stands alone: further levels come from longer chains."""
        alone = df.groupBy(*keys, "level").agg(F.count(F.lit(1)).alias("nodes"), F.first("digest").alias("digest")).filter("nodes = 1")
        return alone.groupBy(*keys).agg(F.min(F.struct("level", "digest")).alias(name))

    changed = top(sealed, "was").join(top(now, "is"), keys, "left").filter("not was <=> is").select(*keys)
    leaves = [df.filter("level = 1").join(changed, keys, "left_semi").select(*keys, "node", F.col("digest").alias(name), F.col("blocks").alias(f"{name}_blocks"))
              for name, df in (("was", sealed), ("is", now))]
    nodes = leaves[0].join(leaves[1], [*keys, "node"], "left").filter("not was <=> is")
    held = mine.join(changed, keys, "left_semi").groupBy(*keys).agg(F.count_distinct("index").alias("blocks"))
    found = nodes.groupBy(*keys).agg(
        (F.min("node") * fan_out).alias("first_changed"),
        F.max(F.col("node") * fan_out + F.col("was_blocks") - 1).alias("last_changed"))
    return found.join(sizes, keys).join(held, keys, "left").select(
        *keys, "sealed_blocks", F.coalesce("blocks", F.lit(0)).alias("blocks"), "first_changed", "last_changed",
        (F.col("sealed_blocks") - F.coalesce("blocks", F.lit(0))).alias("missing"))


def last_block(blocks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The newest block of each chain."""
    names = [f.name for f in BLOCK.fields]
    newest = blocks.groupBy(*(keys or [])).agg(F.max_by(F.struct(*names), F.col("index")).alias("b"))
    return newest.filter(F.col("b").isNotNull()).select(*(keys or []), "b.*")


def append_event(spark: SparkSession, path: str, event_type: str, data: str, timestamp: str) -> str:
    """Append one event to the ledger at ``path`` (started with a genesis block if new); returns its hash."""
    newest = last_block(read_ledger(spark, path)).first() if _exists(spark, path) else None
    blocks = []
    if newest is None:
        blocks.append({"index": 0, "timestamp": timestamp, "event_type": "CHAIN_INIT", "data": "Genesis Block",
                       "prev_hash": GENESIS_PREV})
        blocks[0]["hash"] = hashlib.sha256(json.dumps(blocks[0], sort_keys=True).encode()).hexdigest()
    last = blocks[-1] if blocks else newest.asDict()
    new = {"index": last["index"] + 1, "timestamp": timestamp, "event_type": event_type, "data": data,
           "prev_hash": last["hash"]}
    new["hash"] = hashlib.sha256(json.dumps(new, sort_keys=True).encode()).hexdigest()
    blocks.append(new)
    lines = [(json.dumps(b),) for b in blocks]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(path)
    return new["hash"]


def ledger(blocks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """All blocks, newest first; over several chains by time stamp, then by chain."""
    if not keys:
        return blocks.orderBy(F.desc("index"))
    return blocks.orderBy(F.desc("timestamp"), *keys, F.desc("index"))
