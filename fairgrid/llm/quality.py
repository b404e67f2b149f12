"""Quality classifier by compression: which of two zstandard dictionaries explains a text better."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, held_out, plus, sample_of_each, utf8

#: Bounds of the training sample: labelled rows of each class, bytes of each dictionary, and the pieces of one text that train a dictionary.
MAX_ROWS_PER_CLASS = 2000
DICT_BYTES = 400_000
TRAIN_PIECE_BYTES, TRAIN_PIECES = 4096, 8
#: Texts are scored in pieces of this size, so that the dictionaries count everywhere in a long text, more than what the text repeats itself.
PIECE_BYTES = 512
#: A text of so many bytes counts half: the difference of a short one says little, and its score stays near the share of good rows, which an empty one has.
HALF_BYTES = 400
LEVEL = 3
THRESHOLD = 0.3


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries; the log-odds of a good row; and the weights that calibrate a size difference: of a text's evidence, and of the difference times it."""

    good: bytes
    bad: bytes
    prior: float
    weights: tuple[float, float]

    def scores(self, measured: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.prior + _terms(measured) @ np.array(self.weights), -40, 40)))


def _terms(measured: np.ndarray) -> np.ndarray:
    """Of rows of (difference, bytes of the text): evidence, which is 0 for an empty text and near 1 for a long one, and the difference times it."""
    d, n = measured.reshape(-1, 2).T
    evidence = n / (n + HALF_BYTES)
    return np.column_stack([evidence, d * evidence])


class SizeDifference:
    """Of a text: by how many bytes the good dictionary compresses it better than the bad one, for each of its bytes; and its bytes.

    The difference is near 0 for what neither dictionary explains, such as a text that repeats itself; an empty text has 0.
    """

    def __init__(self, good: bytes, bad: bytes):
        self.pair = [zstandard.ZstdCompressor(level=LEVEL, dict_data=_loaded(d), write_content_size=False, write_dict_id=False) for d in (good, bad)]

    def __call__(self, text: str | None) -> tuple[float, int]:
        raw = utf8(text)
        if not raw:
            return 0.0, 0
        good, bad = (sum(len(c.compress(raw[i : i + PIECE_BYTES])) for i in range(0, len(raw), PIECE_BYTES)) for c in self.pair)
        return (bad - good) / len(raw), len(raw)


def _loaded(raw: bytes) -> zstandard.ZstdCompressionDict:
    d = zstandard.ZstdCompressionDict(raw)
    d.precompute_compress(level=LEVEL)
    return d


def _dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary of up to DICT_BYTES; the pieces' own bytes where they are too few to train on.

    The rarer class gives a smaller one. Cutting the other down to its size made the difference tell less (README), so sizes are left as they are; the
    weight of the evidence takes up what the size shifts.
    """
    try:
        return zstandard.train_dictionary(DICT_BYTES, pieces).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(t[: max(64, DICT_BYTES // max(1, len(pieces)))] for t in pieces)[:DICT_BYTES] or b" " * 64


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: float, rounds: int = 50) -> np.ndarray:
    """Weights of the columns beside a fixed constant, by Newton steps on scaled columns, with a small ridge for separable samples."""
    scale = np.sqrt(np.square(x).mean(0))
    scale[scale == 0] = 1
    z, w, ridge = x / scale, np.zeros(x.shape[1]), 1e-2
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(prior + z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (weight * p * (1 - p))[:, None]) + ridge * np.eye(len(w)), z.T @ (weight * (y - p)) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w / scale


def _pieces(text: str) -> list[bytes]:
    """At most TRAIN_PIECES pieces, evenly over the whole text."""
    raw = utf8(text)
    n = max(1, -(-len(raw) // TRAIN_PIECE_BYTES))
    taken = range(n) if n <= TRAIN_PIECES else (k * n // TRAIN_PIECES for k in range(TRAIN_PIECES))
    return [raw[k * TRAIN_PIECE_BYTES : (k + 1) * TRAIN_PIECE_BYTES] for k in taken]


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS_PER_CLASS) -> QualityModel:
    """Learn from ``labels`` (doc_id, quality 0/1) and the texts of ``docs``.

    Learns from at most ``max_rows`` rows of each class, taken by a hash of the id,
    never from held-out rows (see ``held_out``). Two thirds build the
    dictionaries, from at most TRAIN_PIECES pieces of a text; one third, measured whole in tasks, calibrates. So what reaches the driver is bounded. Null ids, labels and texts are not
    learnt from; of repeated rows of an id each distinct text counts once, and ids with both labels count in both classes. The share of good labels, over all of them, is where every
    score starts from; evidence moves it. Without both classes the score is that share, or one half without labels.
    """
    usable = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id"))).select("doc_id", "quality").distinct()
    sample = sample_of_each(usable, "quality", "doc_id", max_rows).select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
    rows = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    rows = cut(rows.withColumn("u", F.xxhash64(F.lit(3), "doc_id")).dropDuplicates(["doc_id", "quality", "text"]))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_pieces(t.as_py()) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(parts, pa.list_(pa.binary()))], ["u", "doc_id", "quality", "parts"])

    built = rows.where("u % 3 <> 0").select("u", "doc_id", "quality", "text").mapInArrow(pieces, "u long, doc_id long, quality int, parts array<binary>")
    found = sorted((r.u, r.doc_id, r.quality, tuple(map(bytes, r.parts))) for r in built.collect())
    parts = {q: [p for *_, quality, own in found if quality == q for p in own] for q in (0, 1)}
    share = {q: usable.where(F.col("quality") == q).count() for q in (0, 1)}
    prior = math.log((share[1] + 0.5) / (share[0] + 0.5))
    if not all(parts.values()):
        return QualityModel(b" " * 64, b" " * 64, prior, (0.0, 0.0))
    good, bad = _dictionary(parts[1]), _dictionary(parts[0])
    shared = docs.sparkSession.sparkContext.broadcast((good, bad))

    def differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = SizeDifference(*shared.value)
        for batch in batches:
            d, n = zip(*(measure(t.as_py()) for t in batch.column(1)), strict=True) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(d, pa.float64()), pa.array(n, pa.int64())], ["quality", "d", "n"])

    held = rows.where("u % 3 = 0")
    held = rows if held.isEmpty() else held
    measured = held.select("quality", "text").mapInArrow(differences, "quality int, d double, n long").orderBy("d", "n", "quality").toArrow()
    x = np.column_stack([measured.column(c).to_numpy().astype(float) for c in ("d", "n")])
    y = measured.column("quality").to_numpy().astype(float)
    # each class weighs as much as among all labels, though the sample takes as many rows of either
    weight = np.where(y == 1, share[1] / max(1, y.sum()), share[0] / max(1, len(y) - y.sum()))
    return QualityModel(good, bad, prior, tuple(_logistic(_terms(x), y, weight * len(y) / weight.sum(), prior).tolist()))


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher is better) and ``predicted`` (1 at ``threshold`` or above).

    Whole texts are compressed, piece by piece, however long; null counts as empty; repeated rows are each scored alike. An
    incoming ``score`` or ``predicted`` is replaced, other columns pass through. An empty table stays empty.
    """
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        measure = SizeDifference(m.good, m.bad)
        for batch in batches:
            score = m.scores(np.array([measure(t.as_py()) for t in batch.column(at)], float))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= threshold).astype("int32"))], [*batch.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, plus(docs.schema, score="double", predicted="int"))
