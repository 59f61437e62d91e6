"""The corpus pipeline: documents to token ids, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; all but the
last return the columns of ``docs``. ``run`` writes each stage to the shared folder and reads
it again, so a lost executor never costs more than one stage.

Every row is judged by itself, by a row number of the stage's stored input: rows that share an id, or have none, do not
share a verdict. Null and empty texts are clean and not toxic by themselves (they score the curve's value there), are
copies of each other for exact dedup, and have no near copies, passages or ids. Without labels of both classes nothing
is rejected as toxic; without a benchmark nothing is contaminated; an empty table gives no rows. Very long texts are taken
whole, and other columns are handed on as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import bpe, decontaminate, exact_dedup, near_dedup, toxicity
from panelcast.llm.common import stored, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches 0.5 go."""
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.where("score < 0.5").select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal documents the one with the largest id stays."""
    return exact_dedup.exact_dedup(docs)


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__row``: partition and place in it, the same in every scan of the stage's stored input."""
    return docs.withColumn("__row", F.monotonically_increasing_id())


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays (of rows that share it, one)."""
    docs = _numbered(docs)
    found = near_dedup.near_duplicates(docs, key="__row").select("__row", "component_id")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")).alias("least")
    kept = (found.join(docs.select("__row", "doc_id"), "__row").groupBy("component_id").agg(least)
            .select(F.col("least.__row").alias("__row")))
    return docs.join(kept, "__row", "left_semi").drop("__row")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    docs = _numbered(docs)
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), key="__row")
    hit = found.where("contaminated").select("__row")
    return docs.join(hit, "__row", "left_anti").drop("__row")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, decoded_sha256``."""
    return bpe.round_trip(docs, *bpe.default_vocabulary(), keep_ids=True)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("tokens", tokenize),
]

# The first stage scores with a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
