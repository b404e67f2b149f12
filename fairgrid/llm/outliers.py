"""Quality rules as robust multivariate outliers of text statistics."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, chain, cut, utf8

MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 50, 50, 3
#: Share of a group's rows that the covariance determinant is made small on, and rows below which a group is pooled.
CORE_SHARE, MIN_GROUP = 0.75, 50
#: Concentration steps of a group end when its log determinant falls by no more than TOLERANCE, about what approximate quantiles can move it, at the latest after MAX_STEPS.
TOLERANCE, MAX_STEPS = 1e-2, 25
#: Groups up to which their shapes, 300 bytes each, are broadcast; beyond that rows meet them in a join that AQE can split.
BROADCAST_GROUPS = 50_000
#: Rows beyond this quantile of the chi-square law are rejected.
CUTOFF = 1 - 1e-7
SYMBOLS = re.compile(r"[#*$%&|<>]")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
DIM = 5
#: Least standard deviation of each transformed statistic, where most rows agree (no symbols, no repeats).
FLOOR = (0.25, 0.05, 0.25, 0.10, 0.10)


def text_counts(text: str | None, hashes: WordHashes) -> tuple[int, ...]:
    """COUNTS of one whole text; null has none."""
    if not text:
        return (0,) * 6
    raw = utf8(text)
    words = raw.split()
    runs = chain(hashes.of(words), REPEAT_WINDOW)
    repeats = 0
    if len(runs):
        _, of, n = np.unique(runs, return_inverse=True, return_counts=True)
        cover = np.zeros(len(words) + 1, np.int64)
        at = np.flatnonzero(n[of] > 1)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + REPEAT_WINDOW, -1)
        repeats = int((np.cumsum(cover)[:-1] > 0).sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(words), sum(len(w.decode()) for w in words) if not text.isascii() else sum(map(len, words)), len(SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeats, len(lines)


def count_texts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, COUNTS and a digest of the text of each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            counts, digests = [], []
            for t in batch.column(3):
                text = t.as_py()
                counts.append(text_counts(text, hashes))
                digests.append(xxhash.xxh3_128_digest(utf8(text or "")))
            counts = np.array(counts, np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(counts[:, i]) for i in range(6)), pa.array(digests, pa.binary())], ["doc_id", "lang", "source", *COUNTS, "digest"])

    return docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS) + ", digest binary")


def chi2_cdf(x: float, df: int) -> float:
    """The chi-square law's distribution function, by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, x = df / 2, x / 2
    term = total = 1 / a
    for k in range(1, 1000):
        term *= x / (a + k)
        total += term
        if term < total * 1e-16:
            break
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def chi2_quantile(p: float, df: int) -> float:
    low, high = 0.0, 500.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, df) < p else (low, mid)
    return (low + high) / 2


def solve(n: np.ndarray, sums: np.ndarray, products: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres, inverse scatters and log determinants from counts, sums and sums of products, corrected for taking only the innermost ``share``."""
    factor = share / chi2_cdf(chi2_quantile(share, DIM), DIM + 2) if share < 1 else 1.0
    centre = sums / n[:, None]
    scatter = factor * (products / n[:, None, None] - centre[:, :, None] * centre[:, None, :])
    spread = np.maximum(np.einsum("kii->ki", scatter), 1e-12)
    scatter = scatter * (1 - 1e-3) + 1e-3 * np.einsum("ki,ij->kij", spread, np.eye(DIM))
    scatter += np.einsum("ki,ij->kij", np.maximum(np.square(FLOOR) - spread, 0), np.eye(DIM))
    return centre, np.linalg.inv(scatter), np.linalg.slogdet(scatter)[1]


_CENTRE, _INVERSE = [f"c{i}" for i in range(DIM)], [f"v{i}{j}" for i in range(DIM) for j in range(DIM)]
_SHAPE = "grp string, start int, size double, old double, " + ", ".join(f"{c} double" for c in [*_CENTRE, *_INVERSE])


def _sums(rows: DataFrame, share: float) -> DataFrame:
    """A shape for each group and start of ``rows`` (grp, start, old, x0..x4): a partial aggregate, then a small solve for each row of sums."""
    sums = [F.expr(f"sum(x{i}) as s{i}") for i in range(DIM)]
    products = [F.expr(f"sum(x{i} * x{j}) as p{i}{j}") for i in range(DIM) for j in range(i, DIM)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            take = lambda names: f[names].to_numpy(float)  # noqa: B023, E731
            products = take([f"p{min(i, j)}{max(i, j)}" for i in range(DIM) for j in range(DIM)]).reshape(-1, DIM, DIM)
            centre, inverse, size = solve(take("n"), take([f"s{i}" for i in range(DIM)]), products, share)
            out = pd.DataFrame(np.column_stack([size, take("old"), centre, inverse.reshape(len(f), -1)]), columns=["size", "old", *_CENTRE, *_INVERSE])
            yield out.assign(grp=f["grp"].tolist(), start=f["start"].tolist())[["grp", "start", *out.columns]]

    return rows.groupBy("grp", "start").agg(F.count("*").cast("double").alias("n"), F.first("old").alias("old"), *sums, *products).mapInPandas(run, _SHAPE)


def _distance():
    """The squared distance of x0..x4 from a shape."""
    return F.expr(" + ".join(f"{1 if i == j else 2} * (x{i} - c{i}) * (x{j} - c{j}) * v{i}{j}" for i in range(DIM) for j in range(i, DIM)))


def robust_shapes(rows: DataFrame) -> tuple[DataFrame, bool]:
    """(grp, start, size, c.., v..): centre and inverse scatter of each ``grp`` of ``rows`` (grp, x0..x4) by a minimum-covariance-determinant
    search, and whether they are few enough to broadcast.

    Two starts for each group: medians with median absolute deviations, and mean with
    scatter of all rows. Both take concentration steps until their determinant falls no more, and then rest while others go on: keep the CORE_SHARE of rows with the least distance,
    estimate anew. The smaller determinant wins, and a last step re-estimates on all rows within its 97.5 %
    ellipsoid. Every step is a scan of ``rows`` with a partial aggregate, both starts together, so a group of
    any size is spread over tasks; only a row of sums for each group moves on. Quantiles are Spark's approximate ones, within 1/2000 of the rank.
    """
    median = F.percentile_approx
    mid = cut(rows.groupBy("grp").agg(*(median(f"x{i}", 0.5, 2000).alias(f"c{i}") for i in range(DIM))))
    few = mid.count() <= BROADCAST_GROUPS
    small = F.broadcast if few else (lambda df: df)
    away = rows.join(small(mid), "grp").groupBy("grp", *_CENTRE).agg(*(median(F.abs(F.col(f"x{i}") - F.col(f"c{i}")), 0.5, 2000).alias(f"m{i}") for i in range(DIM)))
    least = [F.greatest(1.4826 * F.col(f"m{i}"), F.lit(FLOOR[i])) for i in range(DIM)]
    inverse = [(1 / F.pow(least[i], 2) if i == j else F.lit(0.0)).alias(f"v{i}{j}") for i in range(DIM) for j in range(DIM)]
    size = sum((2 * F.log(x) for x in least), F.lit(0.0))
    first = away.select("grp", F.lit(0).alias("start"), size.alias("size"), F.lit(None).cast("double").alias("old"), *_CENTRE, *inverse)
    shapes = cut(first.unionByName(_sums(rows.withColumns({"start": F.lit(1), "old": F.lit(None).cast("double")}), 1.0)))
    settled = []
    for step in range(MAX_STEPS):
        near = rows.join(small(shapes.drop("old").withColumnRenamed("size", "old")), "grp").withColumn("d", _distance())
        bound = near.groupBy("grp", "start").agg(median("d", CORE_SHARE, 2000).alias("bound"))
        shapes = cut(_sums(near.join(small(bound), ["grp", "start"]).where("d <= bound"), CORE_SHARE))
        if step == MAX_STEPS - 1:
            settled.append(shapes)
        elif step:
            falls = F.col("size") < F.col("old") - TOLERANCE
            settled.append(shapes.where(~falls))
            shapes = shapes.where(falls)
            if shapes.isEmpty():
                break
    shapes = reduce(DataFrame.unionByName, settled)
    best = shapes.groupBy("grp").agg(F.min_by(F.struct("start", "size", *_CENTRE, *_INVERSE), F.struct("size", "start")).alias("b")).select("grp", "b.*")
    near = rows.join(small(best.withColumnRenamed("size", "old")), "grp").where(_distance() <= chi2_quantile(0.975, DIM))
    return cut(_sums(near, 0.975)), few


def judge(docs: DataFrame, cutoff: float = CUTOFF, min_group: int = MIN_GROUP) -> DataFrame:
    """COUNTS of each row of ``docs`` (doc_id, text, lang, source) with ``base_failed``, ``distance`` and ``kept``.

    Five transformed statistics (log words, log characters a word, log symbol
    rate, shares of repeated lines and words) are held against the robust shape of the
    row's language and source; rows beyond the chi-square ``cutoff`` go. Groups
    with fewer than ``min_group`` distinct texts are pooled by language, then all
    together; where even those are too few, only the base rules judge. Shapes are learnt from
    the distinct texts of each group that pass the base rules, so that exact copies do not narrow
    them (near copies are texts of their own); all rows get counts and are judged.

    Null text has no words and fails the base rules; very long texts are counted whole; null languages and sources
    are groups of their own; repeated rows are each judged. Other columns are left out, whatever their names. An empty table stays empty.
    """
    rate = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    rows = count_texts(docs).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    rows = rows.withColumns({
        "x0": F.log(F.col("n_words") + F.lit(1.0)), "x1": F.log((F.col("word_chars") + 1.0) / (F.col("n_words") + 1.0)), "x2": F.log(1 + 100 * rate("n_symbols", "word_chars")),
        "x3": rate("n_dup_lines", "n_lines"), "x4": rate("n_repeat_words", "n_words"),
    })
    name = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("-"))
    rows = cut(rows.withColumn("full", F.concat_ws("\x01", name(F.col("lang")), name(F.col("source")))).withColumn("wide", name(F.col("lang"))).drop("lang", "source"))
    xs = [f"x{i}" for i in range(DIM)]
    once = lambda t, *keys: t.groupBy(*keys, "digest").agg(*(F.first(x).alias(x) for x in xs))
    texts = cut(once(rows.where("not base_failed"), "full", "wide"))
    sizes = texts.groupBy("full", "wide").count()
    small = sizes.where(F.col("count") < min_group).select("full")
    pooled = texts.join(small, "full", "left_semi").select("wide", "digest").distinct().groupBy("wide").agg(F.count("*").alias("n"))
    group = sizes.join(pooled, "wide", "left").select("full", F.when(F.col("count") >= min_group, F.concat(F.lit("s"), F.col("full"))).when(F.col("n") >= min_group, F.concat(F.lit("l"), F.col("wide"))).otherwise(F.lit("a")).alias("grp"))
    group = cut(group)
    small = F.broadcast if group.count() <= BROADCAST_GROUPS else (lambda df: df)
    grouped = rows.join(small(group), "full", "left").drop("full", "wide", "digest")
    learn = cut(once(texts.join(small(group), "full"), "grp").drop("digest"))
    enough = cut(learn.groupBy("grp").count().where(F.col("count") >= min_group).select("grp"))
    shapes, few = robust_shapes(learn.join(small(enough), "grp", "left_semi").select("grp", *xs))
    bound = chi2_quantile(cutoff, DIM)
    judged = grouped.join(F.broadcast(shapes) if few else shapes, "grp", "left").withColumn("distance", F.when(F.col("c0").isNotNull(), F.sqrt(F.greatest(_distance(), F.lit(0.0)))))
    return judged.select("doc_id", *COUNTS, "base_failed", "distance", (~F.col("base_failed") & F.coalesce(F.col("distance") <= math.sqrt(bound), F.lit(True))).alias("kept"))
