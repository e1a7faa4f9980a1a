"""A training corpus from ``documents``: toxic documents go, of near duplicates one stays, benchmark passages are
cut out, personal data is replaced, and what is left is packed. Each stage is written as Parquet in the folder that
all executors share and reread as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.llm import decontamination, jaccard, packing, privacy, toxicity
from tidemark.llm.shared import staged

#: What the near-duplicate stage links, which is more than op6's contract: words of a shingle, similarity in hundredths.
NEAR_WORDS, NEAR_PERCENT = 5, 80
#: Rows of an Arrow batch: whole documents are long, and every running task holds a batch on both sides.
BATCH_ROWS = 2000


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _small_batches(spark: SparkSession) -> None:
    """The session hands BATCH_ROWS rows to Python at once, from here on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def _apart(docs: DataFrame) -> DataFrame:
    """The documents with names that no operator gives to a result: only doc_id and text keep theirs."""
    return docs.select(*(F.col(f"`{c}`").alias(c if c in ("doc_id", "text") else f"_{k}_own") for k, c in enumerate(docs.columns)))


def _together(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` under their own names, with n_chars (where they have it) as long as the new text."""
    named = {c: F.col(c if c in ("doc_id", "text") else f"_{k}_own") for k, c in enumerate(docs.columns)}
    if "n_chars" in named and isinstance(docs.schema["n_chars"].dataType, IntegralType):
        changed_text = ~F.length("text").cast("long").eqNullSafe(named["n_chars"].cast("long"))
        named["n_chars"] = F.when(F.col("text").isNotNull() & changed_text, F.length("text")).otherwise(named["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return changed.select(*(v.alias(c) for c, v in named.items()))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine doesn't reject; it learns from labelled documents of ``docs``.

    Null and empty texts stay, as do all documents where nothing can be learned; each row is judged by its own text.
    """
    _small_batches(spark)
    machine = toxicity.train(docs, _read(spark, sf_dir, "labels"))
    kept = toxicity.score(_apart(docs), machine).where("predicted = 0").drop("score", "predicted")
    return kept.select(*(F.col(k).alias(c) for k, c in zip(_apart(docs).columns, docs.columns)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that with the least doc_id (a null one only where all are null).

    Every row is told by a number of its own, so rows that share a doc_id or have none are judged by their texts:
    of equal rows one stays. Texts without words (null, empty, blank) are no duplicates and all stay.
    """
    _small_batches(spark)
    number = "_row" + "_" * max(map(len, docs.columns))  # longer than any name there
    rows = staged(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = jaccard.near_duplicates(rows.select(number, "text"), key=number, words=NEAR_WORDS, percent=NEAR_PERCENT).select(number, "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", number)
    best = found.join(rows.select(number, "doc_id"), number).groupBy("component_id").agg(F.min(order).alias("m"))
    return rows.join(best.select(F.col(f"m.{number}").alias(number)), number, "left_semi").select(*(f"`{c}`" for c in docs.columns))


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that lie in passages of benchmark items; null and empty texts stay as they are."""
    _small_batches(spark)
    found = decontamination.find_contamination(_apart(docs), _read(spark, sf_dir, "benchmark"))
    return _together(decontamination.remove_spans(found), docs)


def replace_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose personal data, and words that give it away, are replaced or removed; no row goes."""
    _small_batches(spark)
    return _together(privacy.sanitise(privacy.find(_apart(docs))), docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets; a null or empty text is one piece, its end id."""
    _small_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmark),
    ("privacy", replace_personal),
    ("packing", pack_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = _read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs


#: SQL can't express the classifier of the first stage; tests compare the stages with plain versions.
ORACLE_SQL = None
