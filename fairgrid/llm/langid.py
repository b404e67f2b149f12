"""Language identification by averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, plus, sample_of_each, utf8

#: Bound of the training sample in rows, shared evenly by the languages, but at least LEAST_ROWS for each; and the model's size.
MAX_ROWS, LEAST_ROWS = 4000, 20
BUCKETS, DIM, SIZES = 8192, 16, (2, 3, 4)
EPOCHS, BATCH, RATE = 12, 64, 0.5
#: Share of right answers that accepted texts must reach on the calibration rows.
PRECISION = 0.995

#: A-Z become a-z, other ASCII that is no letter becomes a space, bytes of longer characters stay.
LETTER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
#: A letter is what Unicode calls one (category L); numerals and signs such as Ⅷ, ½ or ² are none.
HAS_LETTER = regex.compile(r"\p{L}")


def subword_counts(text: str | None) -> np.ndarray:
    """How often each hash bucket of 2 to 4 byte subwords occurs, words set apart by one space."""
    raw = np.frombuffer(b" " + b" ".join(utf8(text).translate(LETTER_BYTES).split()) + b" ", np.uint8).astype(np.uint32)
    out = np.zeros(BUCKETS)
    for n in SIZES:
        if (k := len(raw) - n + 1) > 0:
            h = np.full(k, n, np.uint32)
            for i in range(n):
                h = (h ^ raw[i : i + k]) * np.uint32(0x01000193)
                h ^= h >> np.uint32(15)
            out += np.bincount(h & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    return out


@dataclass(frozen=True)
class LanguageModel:
    """Logits of a bucket, the temperature that calibrates them, and the least score that is not rejected."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    def probabilities(self, text: str | None) -> np.ndarray:
        counts = subword_counts(text)
        return _softmax(((counts / max(1.0, counts.sum())) @ self.table + self.bias) / self.temperature)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _training_rows(docs: DataFrame, max_rows: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, buckets, shares) of the sample in a fixed order. Tasks turn whole texts into counts, so a row is bounded by the model's size."""
    known = docs.where("text is not null and lang is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    ids = known.groupBy("doc_id").agg(F.min("lang").alias("lang"))
    n_langs = max(1, known.agg(F.count_distinct("lang")).first()[0])
    taken = sample_of_each(ids, "lang", "doc_id", max(LEAST_ROWS, max_rows // n_langs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, lang in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                if HAS_LETTER.search(text := text.as_py()):
                    counts = subword_counts(text)
                    at = np.flatnonzero(counts)
                    out.append((doc_id, lang, at.astype("<u2").tobytes(), (counts[at] / counts.sum()).astype("<f4").tobytes()))
            cols = list(zip(*out, strict=True)) or [()] * 4
            types = pa.int64(), pa.string(), pa.binary(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "lang", "at", "share"])

    rows = known.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").join(F.broadcast(taken), ["doc_id", "lang"]).select("doc_id", "text", "lang")
    counted = rows.mapInArrow(run, "doc_id long, lang string, at binary, share binary")
    once = counted.groupBy("doc_id").agg(F.min(F.struct("lang", "at", "share")).alias("r"))
    made = once.orderBy(F.xxhash64("doc_id"), "doc_id").select("r.*").collect()
    return [(r.lang, np.frombuffer(r.at, "<u2"), np.frombuffer(r.share, "<f4")) for r in made]


def fit_language(docs: DataFrame, max_rows: int = MAX_ROWS, seed: int = 11) -> LanguageModel:
    """Learn from text and non-null ``lang`` of ``docs``; never from held-out rows (see ``held_out``).

    Takes at most ``max_rows`` rows in all, as many of each language, by a hash of the id. Four fifths train
    embeddings and softmax by stochastic gradient descent; the rest set the
    temperature and the rejection bound. Null texts and texts without letters are not
    learnt from; very long texts count whole; of repeated rows of one id the least language and one fixed text count. Without any row the model knows no language.
    """
    rows = _training_rows(docs, max_rows)
    langs = sorted({lang for lang, *_ in rows})
    if len(langs) < 2:
        return LanguageModel(langs, np.zeros((BUCKETS, len(langs))), np.zeros(len(langs)), 1.0, 0.0)
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, (_, at, share) in enumerate(rows):
        x[i, at] = share
    y = np.array([langs.index(lang) for lang, *_ in rows])
    own = np.arange(len(rows)) % 5 == 4
    train = np.flatnonzero(~own)
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(train)
        for i in range(0, len(order), BATCH):
            part = order[i : i + BATCH]
            hidden = x[part] @ embed
            error = _softmax(hidden @ out + bias)
            error[np.arange(len(part)), y[part]] -= 1
            error /= len(part)
            back = error @ out.T
            out -= rate * 10 * (hidden.T @ error)
            bias -= rate * error.sum(0)
            embed -= rate * 400 * (x[part].T @ back)
    table = (embed @ out).astype(np.float64)
    held = np.flatnonzero(own) if own.any() else train
    z = x[held] @ table + bias
    temperature = min((np.exp(t) for t in np.linspace(-2, 3, 51)), key=lambda t: -np.log(_softmax(z / t)[np.arange(len(held)), y[held]] + 1e-12).sum())
    p = _softmax(z / temperature)
    right, best = p.argmax(1) == y[held], p.max(1)
    falling = np.argsort(-best)
    good = np.flatnonzero(np.cumsum(right[falling]) >= PRECISION * np.arange(1, len(held) + 1))
    bound = 0.0 if len(good) and good[-1] == len(held) - 1 else float(best[falling[good[-1]]]) if len(good) else 1.0
    return LanguageModel(langs, table, bias.astype(np.float64), float(temperature), bound)


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (calibrated, 0 to 1) and ``rejected``.

    Null texts and texts without a letter are ``und`` with score 0 and rejected; so
    is every text if the model knows no language. Whole texts are read, however long; repeated rows are each judged alike. Incoming columns of
    these names are replaced, others pass through. An empty table stays empty.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(at).to_pylist():
                if not m.langs or not text or not HAS_LETTER.search(text):
                    langs.append("und")
                    scores.append(0.0)
                else:
                    p = m.probabilities(text)
                    langs.append(m.langs[int(p.argmax())])
                    scores.append(float(min(1.0, p.max())))
            rejected = [g == "und" or s < m.reject_below for g, s in zip(langs, scores, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], [*batch.schema.names, "lang_pred", "score", "rejected"])

    return docs.mapInArrow(run, plus(docs.schema, lang_pred="string", score="double", rejected="boolean"))
