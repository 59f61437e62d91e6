"""Helpers shared by the corpus operators: tables, shared storage, words, salted keys."""

from __future__ import annotations

import re
import string
import uuid

from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import checkpoint_dir

# Words are runs of ASCII letters, digits and every non-ASCII character (fixed by the contract).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Byte tables for the two word rules: A-Z to a-z, everything that separates words to a space.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
ALNUM_BYTES = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32
                    for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the lineage is cut and the
    rows survive the loss of any executor."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast of ``value`` with its classes by value, so that workers need not have this package."""
    return spark.sparkContext.broadcast([cloudpickle.dumps(value)])


def shipped(broadcast: Broadcast) -> object:
    """What was shipped; a worker unpacks it once."""
    held = broadcast.value
    if isinstance(held[0], bytes):
        held[0] = cloudpickle.loads(held[0])
    return held[0]


def fan_out(spark: SparkSession) -> int:
    """Into how many salts a key is spread: as many as there are shuffle partitions, so that a
    hot key fills all of them."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


PACKED_ROWS = 50_000         # rows of a task over narrow rows, about


def packed(df: DataFrame, rows: int) -> DataFrame:
    """``df``, known to have about ``rows`` narrow rows, in no more tasks than these are worth. Every map task of a shuffle
    leaves two files, however few its rows; the tasks grow with the rows and are never fewer than the cores."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // PACKED_ROWS)))


def salt_of(n: int, *cols: Column) -> Column:
    """A salt in ``0 .. n-1`` that depends on the row alone, so every scan deals it alike."""
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes the byte-wise ``lower``, the rest ``translate``."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
             .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase)))


def alnum_words(text: str | None) -> list[bytes]:
    """Lower-cased words of :data:`WORD` as UTF-8 (null and empty texts have none)."""
    return text.encode().translate(ALNUM_BYTES).split() if text else []


_SPACE_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def space_words(text: str | None) -> list[bytes]:
    """Lower-cased runs of characters other than ASCII white space, as UTF-8."""
    return _SPACE_WORDS.findall(text.encode().translate(LOWER_BYTES)) if text else []


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers get, in rows and in bytes: long texts would
    otherwise make batches of hundreds of MB."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def salted_least(rows: DataFrame, keys: list[str], value: str, salt: str = "salt") -> DataFrame:
    """``keys, salt, least, n``: the least ``value`` and the number of rows of every key, once per salt
    that the key's rows have. Rows look it up by (keys, salt), so a key that a third of all rows
    share is met by as many tasks as there are salts, both here and in that join."""
    local = rows.groupBy(*keys, salt).agg(F.min(value).alias("least"), F.count(F.lit(1)).alias("n"))
    merged = local.groupBy(*keys).agg(F.min("least").alias("least"), F.sum("n").alias("n"),
                                      F.collect_set(salt).alias("salts"))
    return merged.select(*keys, F.explode("salts").alias(salt), "least", "n")


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b): the least node it is connected with.

    Alternating large and small stars: every round links the larger neighbours of a node, then
    the smaller ones, to its least neighbour. Rounds grow with the logarithm of the longest path;
    each is written to the shared checkpoint folder and only its row count and hash sum reach
    the driver. The row count says into how many tasks the next round is packed.
    """
    def state(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def star(both: DataFrame) -> DataFrame:
        """(node u, neighbour v) -> the same rows with the least of u and its neighbours."""
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return both.join(least, "a")

    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    now = now.checkpoint()
    seen = state(now)
    while seen[0]:
        rows = seen[0]
        now = packed(now, rows)
        both = packed(now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b"))), 2 * rows)
        large = packed(star(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")), rows)
        small = packed(star(large), rows)
        small = (small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(small.select("a", F.col("m").alias("b"))).where("a != b").distinct())
        now = packed(small, rows).checkpoint()
        if (after := state(now)) == seen:
            break
        seen = after
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root")))
