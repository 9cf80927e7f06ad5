"""The corpus pipeline: raw documents to packed training sequences, each stage on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.llm import mixing, packing, pii, quality, simhash
from tellerlake.llm.common import column
from tellerlake.llm.queries import table, tokenizer_path
from tellerlake.session import scratch_path


def own_name(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have, whatever columns they bring."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines the classifier holds for good; it is trained on the given labels.

    A null text counts as empty and gets a score like any other; equal rows share their fate; columns of any name stay as they are; no rows
    give no rows.
    """
    field, score = quality.train(docs, table(spark, sf_dir, "labels")), own_name(docs, "quality_score")
    return quality.scored(docs, field, score_col=score).filter(column(score) >= 0.7).select(*[column(c) for c in docs.columns])


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates.

    Null and empty texts are one group; of equal ids one row stays; no rows give no rows.
    """
    return simhash.keep_first(docs, width=3, radius=3)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the text. Null texts stay null; other columns stay as they are."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*[column(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those that it does not take go, and with them texts without a word.

    Columns that are named like the operator's own come through unchanged.
    """
    own = {c: own_name(docs, f"own_{i}") for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "source")}
    aside = docs.select("doc_id", "text", "source", *[column(c).alias(name) for c, name in own.items()])
    mixed = mixing.mix(aside, F.array("source"))
    times = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int")
    kept = mixed.filter(times > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), times)))
    return kept.select(*[column(own.get(c, c)).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens; a null text counts as empty and is its end token alone."""
    return packing.pack(docs, tokenizer_path(), length=2048)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("personal_data", redact),
    ("mixing", mix),
    ("packing", pack),
]

# Learned scores, hashes of shingles, and a tokenizer: not expressible in SQL, tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if at == len(STAGES) - 1:
            return out
        path = scratch_path(spark, f"pipeline-{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
