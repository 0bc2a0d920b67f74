"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Each stage works on all that its predecessor kept, and all but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, mixing, near_dup, pii, quality
from quarry.llm.common import cut, table
from quarry.llm.queries import PSEUDONYM_KEY, vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.5 go; without usable labels none does."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    given = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")  # no column can clash
    scored = quality.score(given, labels)
    return scored.filter("predicted = 1").select("row.*")


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays (five-word shingles, similarity 0.8): the smallest doc_id, nulls last.

    Of repeated rows one stays; null and empty texts have no copies and stay.
    """
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                   F.monotonically_increasing_id().alias("at"))
    given = cut(docs.select(F.struct(*docs.columns).alias("row"), row.alias("_row")))  # the row numbers are fixed here
    found = near_dup.near_duplicates(given.select("_row", F.col("row.text").alias("text")), k=5, percent=80, doc_id="_row")
    kept = found.filter("kept").select(F.col("doc_id.at").alias("at"))
    return given.join(kept, F.col("_row.at") == F.col("at"), "left_semi").select("row.*")


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values become pseudonyms; ``n_chars`` follows the text."""
    given = docs.select(F.struct(*docs.columns).alias("row"), "text")
    masked = pii.pseudonymise(given, PSEUDONYM_KEY, counts=False)
    new = {"text": F.col("text"), "n_chars": F.coalesce(F.char_length("text").cast("long"), F.col("row.n_chars"))}
    return masked.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: each row as often as the mix takes it."""
    given = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", "text")
    return mixing.emitted(mixing.mixture(given)).select("row.*")


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``ids`` and ``n_tokens`` of each text, and as ``text`` what the ids decode to (a null text: empty)."""
    ranks, pattern = vocabulary()
    rest = [c for c in docs.columns if c not in ("text", "ids", "n_tokens")]
    made = bpe.encode_decode(docs.select(F.struct(*rest).alias("row"), "text"), ranks, pattern)
    return made.select("row.*", F.col("decoded").alias("text"), "ids", "n_tokens")


STAGES = [("quality", quality_stage), ("near_dup", near_dup_stage), ("pii", pii_stage), ("mixing", mixing_stage),
          ("bpe", bpe_stage)]

#: The stages hold a trained model, keyed permutations and merges, which SQL can't express; tests/llm compares
#: each stage with a brute-force version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
