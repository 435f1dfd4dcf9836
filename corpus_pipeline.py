"""The training-corpus pipeline: documents through five stages, each reading what the one before wrote.

All stages take rows as they come: null and empty texts, texts of any length, repeated rows
and ids, and further columns of any name, which pass through untouched (see ``aside``). An
empty table gives an empty table. Each docstring tells what a stage does with these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from watchloom.llm import decontamination, packing, pii, simhash, toxicity
from watchloom.llm.common import materialise, table
from watchloom.session import prepare_session


def aside(docs: DataFrame) -> DataFrame:
    """(doc_id, text, others): all columns but these two as one struct, so that no operator's own names meet them."""
    rest = [F.col(f"`{c}`").alias(c) for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest or [F.lit(0).alias("none")]).alias("others"))


def back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return rows.select(*(F.col(c) if c in ("doc_id", "text") else F.col("others").getField(c).alias(c) for c in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar rejects go; labels only teach it.

    A null or empty text scores like one without any event. Equal rows share their fate.
    """
    prepare_session(spark)
    rows = aside(docs)
    model = toxicity.learn(rows, table(spark, sf_dir, "labels"))
    return back(toxicity.score(rows, model).filter("toxic_flag = 0"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one row stays: that with the smallest doc_id, of equals the first as read.

    Rows are told apart by a number of their own, not by doc_id: rows of one id with different
    texts are in their own classes, and a row without an id stays only if its class has none with
    one. Null and empty texts are one class.
    """
    prepare_session(spark)
    rows = materialise(aside(docs).withColumn("row", F.monotonically_increasing_id()), "pipeline-rows")
    classes = simhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "component_id")
    first = Window.partitionBy("component_id").orderBy(F.col("doc_id").asc_nulls_last(), "row")
    kept = classes.join(rows.select("row", "doc_id"), "row").withColumn("n", F.row_number().over(first)).filter("n = 1").select("row")
    return back(rows.join(kept, "row", "left_semi"), docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat a benchmark item, also with other numbers or names, go.

    Null and empty texts repeat nothing. Equal rows share their fate.
    """
    prepare_session(spark)
    found = decontamination.contaminated(aside(docs), table(spark, sf_dir, "benchmark"))
    return back(found.filter("size(leaked) = 0"), docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data becomes its kind in brackets; ``n_chars``, where there is one, follows the text.

    Every row stays. A null text stays null, and so does its length.
    """
    prepare_session(spark)
    judged = materialise(pii.candidates(aside(docs)), "pipeline-candidates")
    masked = back(pii.mask(judged, pii.fit(judged)), docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the packed sequences.

    A null text is an empty document, its end token alone. Every row is packed, repeated or not.
    """
    prepare_session(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("pii", mask_personal_data),
    ("best_fit_packing", pack_sequences),
]

#: Hashing, learning and tokenising have no SQL form: the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
