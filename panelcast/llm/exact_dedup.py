"""Exact dedup by skew-safe combining (DataFrame operations only).

1. *Local*: the map side of ``groupBy(digest, salt, text)`` leaves one row per text, salt and
   input task; its reduce side merges them, so a hot text is spread over ``salts`` reducers.
2. *Global*: the at most ``salts`` winners of a digest meet in one window that finds the largest
   id and the number of rows of every text.
3. Rows look up their group by (digest, salt): the same spread as in step 1.

Every stage has the whole normalised text among its keys. Only a digest that step 2 has seen with
a single text is looked up by digest alone; digests shared by different texts (none, for SHA-256)
are looked up with the text as well.

Defined cases: a null text is empty; null ids lose to any id; rows that repeat id *and* text are
in one group, ``group_size`` counts each and exactly one of them is ``kept`` (the least by the hash of
the whole row; rows equal in all columns are interchangeable). Very long texts are compared whole. An empty table gives
no rows. Other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.common import fan_out, lower_ascii, salt_of, stored, table


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _groups(docs: DataFrame, key: str, text: str, salts: int,
            digest: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame, bool]:
    """(rows with ``__d, __salt, __norm``, stored winners by digest and salt, any digest shared)."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                       F.col(f"`{key}`").alias("__id"),
                       lower_ascii(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("__norm"))
    rows = rows.withColumns({"__d": digest(F.col("__norm")), "__salt": salt_of(salts, F.col("__id"))})
    salted = (rows.groupBy("__d", "__salt", "__norm")
                  .agg(F.max("__id").alias("__id"), F.count(F.lit(1)).alias("__n")))
    of_digest, of_text = Window.partitionBy("__d"), Window.partitionBy("__d", "__norm")
    winners = (salted
               .withColumn("__shared", F.min("__norm").over(of_digest) != F.max("__norm").over(of_digest))
               .withColumns({"__keep": F.max("__id").over(of_text), "__size": F.sum("__n").over(of_text)})
               .select("__d", "__salt", "__keep", "__size", "__shared",
                       F.when(F.col("__shared"), F.col("__norm")).alias("__text")))
    winners = stored(winners, "dedup-winners")
    return rows, winners, not winners.where("__shared").isEmpty()


def _assigned(rows: DataFrame, winners: DataFrame, shared: bool, carry: list[str]) -> DataFrame:
    own = winners.where(~F.col("__shared")).drop("__shared", "__text")
    out = rows.select("__d", "__salt", "__id", *carry).join(own, ["__d", "__salt"])
    if shared:
        texts = winners.where("__shared").drop("__shared").withColumnRenamed("__text", "__norm")
        out = out.unionByName(rows.join(texts, ["__d", "__salt", "__norm"])
                              .select("__d", "__salt", "__id", *carry, "__keep", "__size"))
    return out


def dedup_report(docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int | None = None,
                 digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per input row: ``key, keep_id, group_size, kept, text_sha256``."""
    docs = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    salts = salts or fan_out(docs.sparkSession)
    rows, winners, shared = _groups(docs, "id", "text", salts, digest)
    out = _assigned(rows, winners, shared, [] if digest is sha256 else ["__norm"])
    wins = F.col("__id").eqNullSafe(F.col("__keep"))
    if not _repeated(out).isEmpty():
        # A repeated winner: its equal rows are counted off within id and group. Salted by chance
        # is not possible here, and not needed: the rows are narrow and the window streams them.
        nth = F.row_number().over(Window.partitionBy("__d", "__keep", "__id").orderBy(F.lit(0)))
        wins = wins & (nth == 1)
    return out.select(F.col("__id").alias(key), F.col("__keep").alias("keep_id"),
                      F.col("__size").alias("group_size"), wins.alias("kept"),
                      (F.col("__d") if digest is sha256 else sha256(F.col("__norm"))).alias("text_sha256"))


def _repeated(assigned: DataFrame) -> DataFrame:
    """Groups whose winning id is on several rows."""
    return (assigned.where(F.col("__id").eqNullSafe(F.col("__keep"))).groupBy("__d", "__keep", "__id")
            .count().where("count > 1"))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int | None = None,
                digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """The kept rows with all their columns. The winners are found on narrow rows; whole rows move once, to a semi-join
    that hashes the winners and sorts nothing."""
    salts = salts or fan_out(docs.sparkSession)
    rows, winners, shared = _groups(docs, key, text, salts, digest)
    repeated = not _repeated(_assigned(rows, winners, shared, [])).isEmpty()
    if shared:
        out = _assigned(rows, winners, shared, ["__row", "__norm"]).where(F.col("__id").eqNullSafe(F.col("__keep")))
    else:
        best = winners.select(F.col("__d").alias("__of"), F.col("__keep").alias("__best")).distinct()
        out = rows.join(best.hint("shuffle_hash"), (F.col("__d") == F.col("__of")) & F.col("__id").eqNullSafe(F.col("__best")),
                        "left_semi")
    if repeated:
        first = Window.partitionBy("__d", "__id", *["__norm"] * shared).orderBy(F.xxhash64("__row"))
        out = out.withColumn("__nth", F.row_number().over(first)).where("__nth = 1")
    return out.select("__row.*")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_report(table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
"""
