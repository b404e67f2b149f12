"""Tokenise documents and pack them into fixed-length sequences by bounded-space best fit."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, plus

MAX_TOKENS = 2048
OPEN_BINS = 8192
PIECES_PER_BUCKET = 16384


#: ASCII punctuation without the apostrophe, which may belong to a contraction.
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
LATIN_LETTERS = re.compile(r"[a-zß-öø-ÿ]+")
#: The usual byte-to-character alphabet of byte-level BPE: printable bytes stand for themselves, the others follow from 256.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_ALPHABET = {b: b for b in _PRINTABLE} | {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}


class CachedTokenizer(dict):
    """Token ids of a text as bytes (unsigned 32-bit, little endian), chunk by chunk.

    The tokenizer's pre-tokenizer never joins what ASCII white space separates,
    so the ids of a text are those of its chunks in order. A chunk of Latin
    letters and then punctuation is cut exactly there, and its two words go to the tokenizer's
    model alone; any other chunk goes through the whole tokenizer. This is a dictionary of the ids of
    chunks met lately, beside one of words. When one holds half its bound it becomes the older
    half and a new one begins; what is met again moves on from the older half, so that frequent words stay.
    """

    CHUNKS, WORDS = 400_000, 400_000
    #: Longer chunks and words are never kept, so that the bounds in entries are bounds in bytes.
    LONGEST = 64

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.words, self.older_words, self.older = self.tokenizer.model, {}, {}, {}

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            found = self.older_words.get(word)
            if found is None:
                coded = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_ALPHABET)
                found = array("I", [t.id for t in self.model.tokenize(coded)]).tobytes() if word else b""
            if len(word) <= self.LONGEST:
                if len(self.words) >= self.WORDS // 2:
                    self.older_words, self.words = self.words, {}
                self.words[word] = found
        return found

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            low = chunk.lower()
            word = low.rstrip(MARKS)
            if word.isalpha() and word.isascii() or not word and low or LATIN_LETTERS.fullmatch(word):
                ids = self._word(word) + self._word(low[len(word) :])
            else:
                ids = np.asarray(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        if len(chunk) <= self.LONGEST:
            if len(self) >= self.CHUNKS // 2:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")))


@lru_cache(maxsize=2)
def tokenizer_of(path: str) -> CachedTokenizer:
    """One tokenizer for each worker process, so that what it has learnt serves later tasks."""
    return CachedTokenizer(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 0, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the ids of each text and ``end_id``, cut only where longer than ``max_tokens``.

    Null text counts as empty: one piece with the end id alone. Very long texts are encoded whole and cut. Null or repeated
    doc_ids are rows like others; other columns are left out. An empty table gives none. The file at ``tokenizer_path`` must be on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, step, end = tokenizer_of(tokenizer_path), 4 * max_tokens, np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = tokens.ids(text or "") + end
                    out += [(doc_id, i // step, i // 4, len(ids[i : i + step]) // 4, zlib.crc32(ids[i : i + step])) for i in range(0, len(ids), step)]
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: list[int], capacity: int, open_bins: int = OPEN_BINS) -> tuple[list[int], list[int]]:
    """(bin, offset) for each length in turn: online best fit over at most ``open_bins`` open bins.

    Open bins stand in a bitset keyed by their free space, so the fullest bin
    that still fits is the lowest set bit at or above the length. When the
    limit is reached the fullest bin closes.
    """
    free_bits, by_free, n_open, n_bins, bins, offsets = 0, {}, 0, 0, [], []
    for length in lengths:
        if rest := free_bits >> length:
            free = length + (rest & -rest).bit_length() - 1
            stack = by_free[free]
            b = stack.pop()
            if not stack:
                free_bits ^= 1 << free
            n_open -= 1
        else:
            b, free = n_bins, capacity
            n_bins += 1
        bins.append(b)
        offsets.append(capacity - free)
        free -= length
        if free:
            if n_open == open_bins:
                fullest = (free_bits & -free_bits).bit_length() - 1
                stack = by_free[fullest]
                stack.pop()
                if not stack:
                    free_bits ^= 1 << fullest
                n_open -= 1
            by_free.setdefault(free, []).append(b)
            free_bits |= 1 << free
            n_open += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = MAX_TOKENS, open_bins: int = OPEN_BINS, per_bucket: int = PIECES_PER_BUCKET) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: best-fit packed into sequences of at most ``capacity``.

    Pieces are dealt evenly over buckets of about ``per_bucket`` rows, whatever
    their ids; each bucket is packed on its own, its pieces arriving by falling
    length, which leaves at most a few part-filled sequences a bucket; the limit of ``open_bins`` then seldom closes one. Ties in length go by place in the scan.
    Lengths must be 1 to ``capacity``. Full-length pieces fill a sequence each. Null and repeated ids are pieces like others. Other columns pass through; incoming
    ``sequence_id`` and ``offset`` are replaced. Empty in, empty out.
    """
    pieces = pieces.drop("sequence_id", "offset")
    pieces = cut(pieces.withColumn("__at", F.monotonically_increasing_id()))
    n_buckets = max(1, -(-pieces.count() // per_bucket))
    schema = plus(pieces.drop("__at").schema, sequence_id="long", offset="long")

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "__at"], ascending=[False, True])
        bins, offsets = best_fit(rows["length"].tolist(), capacity, open_bins)
        return rows.assign(sequence_id=np.asarray(bins, "int64") + (int(key[0]) << 32), offset=np.asarray(offsets, "int64")).drop(columns=["__at", "__bucket"])

    return pieces.withColumn("__bucket", F.pmod(F.xxhash64("__at"), F.lit(n_buckets)).cast("int")).groupBy("__bucket").applyInPandas(_keep_nulls(run), schema)


def _keep_nulls(run: Callable) -> Callable:
    """pandas turns a nullable id column into floats; carry it as objects instead."""

    def wrapped(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = run(key, rows)
        if "doc_id" in out and out["doc_id"].dtype.kind == "f":
            out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return wrapped
