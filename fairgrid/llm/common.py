"""Shared helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
#: The white space of all contracts: space and the five controls from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"

_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (``spark.checkpoint.dir``); a temporary one only for a local master where that is unset."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="fairgrid-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as a table and read from there.

    Later steps read only the columns that they use, know the table's size, so that small ones are broadcast by
    themselves, and survive lost executors. What Parquet cannot hold is checkpointed.
    """
    folder = shared_dir(df.sparkSession)
    if any(isinstance(f.dataType, (T.NullType, T.CalendarIntervalType)) for f in df.schema.fields):
        return df.checkpoint(eager=True)
    path = f"{folder}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col):
    """A-Z become a-z, all else stays. Text of ASCII alone takes Spark's faster ``lower``."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(F.translate(col, ASCII_UPPER, ASCII_LOWER))


def held_out(doc_id):
    """True where crc32 of the id as text leaves no remainder by 5: rows that no model learns from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 5 == 0, F.lit(False))


def sample_of_each(rows: DataFrame, group: str, key: str, limit: int) -> DataFrame:
    """At most ``limit`` rows of ``rows`` for each value of ``group``, those with the least hash of ``key`` (distinct in a group).

    A share of each group, some four times the limit, is let through by its hash before rows are ranked, so that ranking never gathers a large group.
    The groups are classes or languages: their counts, a row each, are broadcast.
    """
    u = F.pmod(F.xxhash64(F.lit(5), F.col(key)), F.lit(1 << 30))
    counts = rows.groupBy(group).agg(F.count("*").alias("__n"))
    few = rows.join(F.broadcast(counts), group).withColumn("__u", u).where(F.col("__u").cast("double") * F.col("__n") < F.lit(float(4 * limit + 100) * (1 << 30)))
    first = Window.partitionBy(group).orderBy("__u", key)
    return few.withColumn("__nth", F.row_number().over(first)).where(F.col("__nth") <= limit).select(*rows.columns)


def plus(schema: T.StructType, **types: str) -> T.StructType:
    """``schema`` with more columns of the named types."""
    made = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "binary": T.BinaryType()}
    return T.StructType([*schema.fields, *(T.StructField(k, made[v]) for k, v in types.items())])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def chain(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for every run of ``n`` consecutive words (none if there are fewer)."""
    k = len(hashes) - n + 1
    if k <= 0:
        return np.empty(0, np.uint64)
    out = mix(hashes[:k] + _GOLDEN)
    for i in range(1, n):
        out = mix(out * _MIX_1 + hashes[i : i + k])
    return out


def utf8(text: str | None) -> bytes:
    """UTF-8 of a text; lone surrogates cannot come from Spark strings."""
    return text.encode("utf-8", "replace") if text else b""


def key_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """Runs of rows that agree in the first ``n_keys`` integer columns, of batches sorted by them, one table each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)])
        starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            key = tuple(keys[a].tolist())
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component_id): the smallest id that each node of ``edges`` (a, b) can reach.

    Every round takes the least label among the neighbours and then follows the
    label's own label, so chains halve; each round is checkpointed. Minima are
    combined before the shuffle, and a node with very many edges is left to
    AQE's skew join. Edge rows with nulls are ignored; an empty table gives an
    empty result.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    both = cut(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label")))
    for _ in range(max_rounds):
        near = both.join(labels.withColumnRenamed("id", "b"), "b").select(F.col("a").alias("id"), "label")
        least = labels.union(near).groupBy("id").agg(F.min("label").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("further"))
        new = cut(least.join(jump, "label", "left").select("id", F.least("label", F.coalesce("further", "label")).alias("label")))
        moved = new.join(labels.withColumnRenamed("label", "old"), "id").where("label <> old").limit(1).count()
        labels = new
        if not moved:
            return labels.select("id", F.col("label").alias("component_id"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
