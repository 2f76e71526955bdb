"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of words: space, tab, line feed, vertical tab, form feed, carriage return.
GAP = r"[\x20\x09-\x0D]+"
NOT_GAP = r"[^\x20\x09-\x0D]"
#: Bits of the set that tells rows that a join may find; its words take 16 bytes each, 4 MB in all.
FILTER_BITS = 1 << 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the one that all executors share; a temporary one on a local master only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/llm-{uuid.uuid4().hex}"
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="llm-")


def staged(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once as Parquet in the shared folder and read back."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/t"
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def quoted(names: Iterable[str]) -> list[str]:
    """Column names as Spark reads them, whatever characters they hold."""
    return [f"`{c.replace('`', '``')}`" for c in names]


def words(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def whole_text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def trusted_sample(labels: DataFrame, condition: Column, most: int) -> DataFrame:
    """At most ``most`` labelled ids that meet ``condition``, chosen by a hash of the id."""
    return (
        labels.filter(condition & F.col("doc_id").isNotNull())
        .select("doc_id")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit integers, one to one."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def marked(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, mark: str) -> DataFrame:
    """``df`` with a boolean ``mark``: false only where no row of ``wanted`` has the key (both keys are hashes, longs).

    The wanted keys become a bit set, broadcast as at most 4 MB of words however many they are; with more keys than bits
    most rows are marked, which is still right.
    """
    low = F.lit(FILTER_BITS - 1).cast("bigint")
    word = lambda x: F.shiftright(x.bitwiseAND(low), 6)
    place = lambda x: x.bitwiseAND(F.lit(63).cast("bigint")).cast("int")
    at, bits = fresh(df, "filter_word"), fresh(df, "filter_bits")
    one = F.lit(1).cast("bigint")
    words = wanted.groupBy(word(wanted_key).alias(at)).agg(
        F.bit_or(F.call_function("shiftleft", one, place(wanted_key))).alias(bits)
    )
    found = df.join(F.broadcast(words), word(key) == F.col(at), "left")
    return found.withColumn(mark, F.coalesce(F.bit_get(F.col(bits), place(key)) == 1, F.lit(False))).drop(at, bits)


def batches(columns: dict, step: int = 65536) -> Iterator[pa.RecordBatch]:
    """Arrow batches of bounded length from equally long arrays."""
    whole = pa.table(columns)
    yield from whole.to_batches(max_chunksize=step)


def components(links: DataFrame) -> DataFrame:
    """Connected components of the links (a, b): one row (node, component) per linked node.

    The component is its smallest node. Large-star and small-star steps alternate, so that the number
    of rounds grows with the logarithm of a component's size; each round is written to the shared
    folder. A node's smallest neighbour is an aggregate, so hubs are never gathered in one row.
    """
    edges = staged(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).filter("u <> v")
        large = large.union(least.filter("u <> m").select("u", F.col("m").alias("v"))).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)
