"""Exact top-k search by inner product: global score histograms locate each query's kth score."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, key_groups

K = 5
SCALE = 256
#: Bins of a histogram, a power of two: each round narrows a score to a 1,024th of its range.
BIN_BITS = 10
BINS = 1 << BIN_BITS
#: Rows of a block of queries and of a chunk of candidates; one task scores blocks against chunks, a slice of a chunk at a time.
BLOCK = 4096
SLICE = 1024
#: No score: that of a query's own row.
_NONE = -(2**63)


def integer_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(place, vec_id, v, dim) of ``rows`` (vec_id, embedding): ``v`` holds floor(scale * x) of each component, x as double.

    Rows with a null id, a null vector or a null or non-finite component are left out. ``place`` is unique for a row. A
    component whose floor passes 62 bits stops the job with an error, for no integer score could hold its products.
    """
    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    scaled = lambda x: F.floor(x.cast("double") * scale)
    fits = lambda x: F.abs(x.cast("double") * scale) < float(2**62)
    v = F.transform("embedding", lambda x: F.when(fits(x), scaled(x)).otherwise(F.raise_error(F.lit("a component passes 62 bits")).cast("long")))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    return kept.select(F.monotonically_increasing_id().alias("place"), "vec_id", v.alias("v"), F.size("embedding").alias("dim"))


def inner_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products, up to 62 bits, of the integer rows of ``q`` and ``c``; in floating point where its digits suffice."""
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), np.int64)
    bound = float(np.abs(q.astype(np.float64)).sum(1).max()) * float(np.abs(c.astype(np.float64)).max())
    if bound < 2**24:
        return (q.astype(np.float32) @ c.T.astype(np.float32)).astype(np.int64)
    if bound < 2**53:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    if bound < 2**62:
        return q @ c.T
    exact = q.astype(object) @ c.T.astype(object)
    if max(abs(x) for x in exact.ravel()) >= 2**62:
        raise OverflowError("an inner product passes 62 bits")
    return exact.astype(np.int64)


def _sides(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict]]:
    """Queries and candidates of equal dimension in each cell, as arrays; candidates by id."""
    for t in key_groups(batches, 2):
        dims = t.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            own = t.filter(pa.array(dims == dim))
            side = own.column("side").to_numpy()
            parts = []
            for k in (0, 1):
                x = own.filter(pa.array(side == k)).combine_chunks()
                v = x.column("v").combine_chunks() if x.num_rows else None
                flat = v.flatten().to_numpy(zero_copy_only=False) if v is not None else np.empty(0, np.int64)
                parts.append({n: x.column(n).to_numpy() for n in ("place", "vec_id", "low", "shift", "bins", "need")} | {"v": flat.astype(np.int64).reshape(x.num_rows, dim)})
            q, c = parts
            if len(q["place"]) and len(c["place"]):
                order = np.argsort(c["vec_id"], kind="stable")
                yield q, {"vec_id": c["vec_id"][order], "v": c["v"][order]}


def _slices(q: dict, c: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, scores) of a slice of the candidates at a time; a query's own id has no score."""
    for k in range(0, len(c["vec_id"]), SLICE):
        ids = c["vec_id"][k : k + SLICE]
        scores = inner_products(q["v"], c["v"][k : k + SLICE])
        own = np.flatnonzero(np.isin(ids, q["vec_id"]))
        i, j = np.nonzero(q["vec_id"][:, None] == ids[own][None, :])
        scores[i, own[j]] = _NONE
        yield ids, scores


def _histograms(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q, c in _sides(batches):
            n = len(q["place"])
            counts = np.zeros(n * BINS, np.int64)
            rows = np.arange(n)[:, None] * BINS
            for _, scores in _slices(q, c):
                bins = (scores - q["low"][:, None]) >> q["shift"][:, None]
                counts += np.bincount((rows + bins)[(scores >= q["low"][:, None]) & (bins < q["bins"][:, None])], minlength=n * BINS)
            counts = counts.reshape(n, BINS)
            higher = counts[:, ::-1].cumsum(1)[:, ::-1] - counts
            i, b = np.nonzero((counts > 0) & (higher < k))  # the cell's kth score is a lower bound of the query's
            yield pa.RecordBatch.from_arrays([pa.array(q["place"][i]), pa.array(b), pa.array(counts[i, b])], names=["place", "bin", "n"])

    return run


def _at_least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores above each query's kth score, and of those equal to it the smallest ids, as many as can be needed."""
    for q, c in _sides(batches):
        left = q["need"].copy()
        for ids, scores in _slices(q, c):
            tie = scores == q["low"][:, None]
            nth = tie.cumsum(1, dtype=np.int32)
            i, j = np.nonzero((scores > q["low"][:, None]) & (scores != _NONE) | tie & (nth <= left[:, None]))
            left = np.maximum(left - nth[:, -1], 0)
            yield pa.RecordBatch.from_arrays([pa.array(q["place"][i]), pa.array(q["vec_id"][i]), pa.array(ids[j]), pa.array(scores[i, j])], names=["place", "query_id", "vec_id", "score"])


def top_k(rows: DataFrame, is_query, k: int = K, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """The ``k`` highest scores of each row of ``rows`` (vec_id, embedding) where ``is_query`` (a condition on vec_id) holds, against all rows: query_id, rank, vec_id, score.

    A score is the inner product of the vectors as integers (``integer_vectors``). Queries lie in blocks, candidates in chunks, and each
    cell of block and chunk is scored whole in one task; rows move, never pairs. First every query's histogram of
    all its scores over its possible range is added up over the chunks; the bin that holds the kth score is divided into
    finer bins and scored again, until bins are one score wide, so the kth score is known exactly. A last
    round keeps scores above it, fewer than k, and for each chunk the smallest ids of those equal to it; ties go to the smaller
    vec_id. A cell sends at most k bins a query and round, however its scores are spread, and k ties at most.

    Rows with a null id, a null vector or a null or non-finite component take no part; so do pairs of unequal dimension. A
    row with the query's vec_id is the query's own, repeated or not; other repeated rows are candidates each, and a
    repeated query row is answered each time. Fewer than k candidates are all returned; vectors without
    components score 0. Very long vectors make blocks of fewer rows. Further columns are left out. An empty table
    gives an empty result.
    """
    vectors = cut(integer_vectors(rows.select("vec_id", "embedding"), scale))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    queries = vectors.where(F.coalesce(is_query, F.lit(False)))
    size = vectors.agg(F.count("*").alias("n"), F.max("dim").alias("dim"), F.max(norm).alias("norm"), F.sum(F.coalesce(is_query, F.lit(False)).cast("long")).alias("queries")).first()
    if not size.queries:
        return vectors.limit(0).select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))
    block = max(16, min(block, (1 << 20) // max(1, size.dim)))
    n_chunks = -(-size.n // block)
    chunks = vectors.select(F.pmod(F.xxhash64("place"), F.lit(n_chunks)).alias("chunk"), "place", "vec_id", "v", "dim")

    most = F.floor(F.least(norm * (size.norm * (1 + 1e-9)) + 1, F.lit(float(2**62))))
    bits = F.ceil(F.log2((2 * most.cast("double") + 1) / BINS + 1e-9)).cast("int")
    active = cut(queries.select("place", "vec_id", "v", "dim", (-most).alias("low"), F.greatest(F.lit(0), bits).alias("shift"), F.lit(BINS).alias("bins"), F.lit(k).cast("long").alias("need")))

    def cells(active: DataFrame) -> DataFrame:
        n_blocks = -(-active.count() // block)
        columns = ("block", "chunk", "side", "dim", "place", "vec_id", "v", "low", "shift", "bins", "need")
        q = active.withColumns({"block": F.pmod(F.xxhash64(F.lit(3), "place"), F.lit(n_blocks)), "chunk": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_chunks - 1).cast("long"))), "side": F.lit(0)})
        c = chunks.withColumns({"block": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))), "side": F.lit(1), "low": F.lit(0).cast("long"), "shift": F.lit(0), "bins": F.lit(0), "need": F.lit(0).cast("long")})
        n_tasks = min(4 * n_blocks * n_chunks, 100_000)
        return q.select(*columns).union(c.select(*columns)).repartition(n_tasks, "block", "chunk").sortWithinPartitions("block", "chunk", "side")

    settled = []
    while active.limit(1).count():
        found = cells(active).mapInArrow(_histograms(k), "place long, bin long, n long").groupBy("place", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("place").orderBy(F.desc("bin"))
        found = found.withColumn("upto", F.sum("n").over(down)).join(active.select("place", "need"), "place")
        at = found.where("upto >= need and upto - n < need").select("place", "bin", (F.col("need") - F.col("upto") + F.col("n")).alias("left"))
        after = active.join(at, "place", "left").select(
            "place",
            "vec_id",
            "v",
            "dim",
            F.when(F.col("bin").isNull(), F.lit(_NONE + 1)).otherwise(F.col("low") + F.expr("shiftleft(bin, shift)")).alias("low"),
            F.when(F.col("bin").isNull() | (F.col("shift") == 0), F.lit(-1)).otherwise(F.greatest(F.lit(0), F.col("shift") - BIN_BITS)).alias("shift"),
            F.expr(f"shiftleft(1, least(shift, {BIN_BITS}))").alias("bins"),
            F.coalesce("left", "need").alias("need"),
        )
        after = cut(after)
        settled.append(after.where("shift < 0"))
        active = after.where("shift >= 0")
    known = settled[0]
    for more in settled[1:]:
        known = known.union(more)
    hits = cells(known.withColumn("shift", F.lit(0))).mapInArrow(_at_least, "place long, query_id long, vec_id long, score long")
    order = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
