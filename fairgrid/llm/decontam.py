"""Remove benchmark passages from training documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, chain, cut, mix, utf8

WINDOW = 10
#: Characters of benchmark text up to which all its windows are broadcast; beyond that documents and windows meet in a join.
BROADCAST_CHARS = 2_000_000
#: Size of the bit filter that is broadcast before that join, whatever the benchmark's size: 16 MB.
FILTER_BITS = 1 << 27

#: Bytes that are no part of a word become spaces, A-Z become a-z; digits, letters and all beyond ASCII stay.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(WORD_BYTES).split()


def windows_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` words; runs of different lengths have different hashes."""
    return mix(chain(hashes, n) + np.uint64(n))


class WindowIndex:
    """The distinct windows of benchmark items, by length and hash, each with the items that hold it."""

    def __init__(self, items: list[tuple], window: int):
        hashes, holders = WordHashes(), {}
        for item, text in items:
            words = words_of(text)
            n = min(window, len(words))
            if n:
                own, first = np.unique(windows_of(hashes.of(words), n), return_index=True)
                for h, at in zip(own.tolist(), first.tolist(), strict=True):
                    holders.setdefault((n, h), {}).setdefault(tuple(words[at : at + n]), set()).add(item)
        lengths: dict[int, list] = {}
        for n, h in sorted(holders):
            lengths.setdefault(n, []).append(h)
        self.holders = holders
        self.at = {n: np.array(hs, np.uint64) for n, hs in lengths.items()}

    def scan(self, words: list[bytes], hashes: np.ndarray) -> tuple[np.ndarray, set]:
        """(hit flag of each word, items that occur); equal hashes are confirmed on the words. A window's items are taken up once, however often it occurs."""
        hit, met = np.zeros(len(words), bool), set()
        for n, known in self.at.items():
            own = windows_of(hashes, n)
            if not len(own):
                continue
            places = np.flatnonzero(known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own)
            for i, h in zip(places.tolist(), own[places].tolist(), strict=True):
                text = tuple(words[i : i + n])
                if text in self.holders[n, h]:
                    hit[i : i + n] = True
                    met.add((n, h, text))
        return hit, set().union(*(self.holders[n, h][text] for n, h, text in met))


def _small_index(benchmark: DataFrame, window: int, bound: int) -> WindowIndex | None:
    """The index of the whole benchmark if its characters, summed first, are within ``bound``."""
    items = benchmark.where("text is not null").select("item_id", "text")
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    return WindowIndex([tuple(r) for r in items.toLocalIterator()], window) if total <= bound else None


def sorted_ids(found) -> list:
    """Item ids as sorted strings; a null id stands last."""
    return sorted(str(i) for i in found if i is not None) + [None] * (None in found)


# ---- the benchmark as a table ------------------------------------------------------------------------------------


def benchmark_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(h, n, words, item_id): the distinct windows of each item, as a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = words_of(text.as_py())
                if not words:
                    continue
                n = min(window, len(words))
                own, first = np.unique(windows_of(hashes.of(words), n), return_index=True)
                for at in range(0, len(own), 10_000):
                    part = first[at : at + 10_000].tolist()
                    cols = own[at : at + 10_000].view(np.int64), [n] * len(part), [b" ".join(words[i : i + n]) for i in part], [item] * len(part)
                    types = pa.int64(), pa.int32(), pa.binary(), pa.string()
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["h", "n", "words", "item_id"])

    items = benchmark.where("text is not null").select(F.col("item_id").cast("string"), "text")
    return items.mapInArrow(run, "h long, n int, words binary, item_id string")


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return h & np.uint64(FILTER_BITS - 1), (h >> np.uint64(32)) & np.uint64(FILTER_BITS - 1)


def _bit_filter(windows: DataFrame) -> np.ndarray:
    """Two bits of a fixed bitset for each window hash: words of it are combined by tasks, at most FILTER_BITS / 64 rows reach the driver."""
    low, high = F.col("h").bitwiseAND(FILTER_BITS - 1), F.shiftrightunsigned("h", 32).bitwiseAND(FILTER_BITS - 1)
    bit = windows.select(F.explode(F.array(low, high)).alias("bit"))
    rows = bit.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("word")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[rows.column("at").to_numpy()] = rows.column("word").to_numpy().view(np.uint64)
    return out


def _candidates(docs: DataFrame, keys: dict[str, str], windows: DataFrame) -> DataFrame:
    """``keys`` (columns of ``docs`` with their types), n_words, at, n, h, words: a row with null ``at`` for each row of ``docs``, and one for
    each place in it whose window passes the bit filter. ``docs`` has ``text`` after the keys."""
    shared = docs.sparkSession.sparkContext.broadcast((_bit_filter(windows), [r.n for r in windows.select("n").distinct().collect()]))
    names, k = [*keys, "n_words", "at", "n", "h", "words"], len(keys)
    schema = ", ".join(f"{c} {t}" for c, t in keys.items()) + ", n_words long, at int, n int, h long, words binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (known, lengths), hashes = shared.value, WordHashes()
        passes = lambda bit: known[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)
        types = pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()

        def made(batch: pa.RecordBatch, whose: list[int], out: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([*batch.take(pa.array(whose, pa.int64())).columns[:k], *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names)

        for batch in batches:
            whose, out = [], []
            for row in range(batch.num_rows):
                words = words_of(batch.column(k)[row].as_py())
                own, before = hashes.of(words), len(out)
                out.append((len(words), None, None, None, None))
                for n in lengths:
                    h = windows_of(own, n)
                    one, two = _bits(h)
                    at = np.flatnonzero(passes(one) & passes(two))
                    out += [(len(words), i, n, int(h[i].view(np.int64)), b" ".join(words[i : i + n])) for i in at.tolist()]
                whose += [row] * (len(out) - before)
                if len(out) >= 4096:
                    yield made(batch, whose, out)
                    whose, out = [], []
            if out:
                yield made(batch, whose, out)

    return cut(docs.select(*keys, "text").mapInArrow(run, schema))


def _met(candidates: DataFrame, windows: DataFrame) -> DataFrame:
    """Candidates that are windows: equal hashes, confirmed on the words. Windows meet them once each, however many items share one."""
    texts = windows.select("h", "n", F.col("words").alias("their_words")).distinct()
    return candidates.where("at is not null").join(texts, ["h", "n"]).where("words = their_words").drop("their_words")


def _items_of(met: DataFrame, windows: DataFrame) -> DataFrame:
    """(row, item_id), distinct: the items of each row's windows, a window taken once however often the row repeats it."""
    once = met.select("row", "h", "n", "words").distinct()
    theirs = windows.select("h", "n", F.col("words").alias("their_words"), "item_id")
    return once.join(theirs, ["h", "n"]).where("words = their_words").select("row", "item_id").distinct()


def _hits_by_join(rows: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    windows = cut(benchmark_windows(benchmark, window))
    candidates = _candidates(rows, {"row": "long", "doc_id": "long"}, windows)
    met = cut(_met(candidates, windows).select("row", "at", "n", "h", "words"))
    spans = met.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("at", (F.col("at") + F.col("n")).alias("end")))).alias("spans"))
    items = _items_of(met, windows).groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("ids"), F.max(F.col("item_id").isNull()).alias("nameless"))
    every = candidates.where("at is null").select("row", "doc_id", "n_words").join(spans, "row", "left").join(items, "row", "left")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged = []
            for places in batch.column(3).to_pylist():
                out = []
                for p in places or ():
                    if out and p["at"] <= out[-1]["end"]:
                        out[-1]["end"] = max(out[-1]["end"], p["end"])
                    else:
                        out.append({"first": p["at"], "end": p["end"]})
                merged.append(out)
            ids = [(x or []) + [None] * bool(y) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(merged, SPANS), pa.array(ids, pa.list_(pa.string()))], HIT_COLUMNS)

    return every.select("row", "doc_id", "n_words", "spans", "ids", "nameless").mapInArrow(merge, HIT_SCHEMA)


# ---- operators ---------------------------------------------------------------------------------------------------

HIT_COLUMNS = ["row", "doc_id", "n_words", "hit_spans", "item_ids"]
HIT_SCHEMA = "row long, doc_id long, n_words long, hit_spans array<struct<first:long,end:long>>, item_ids array<string>"
SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """(row, doc_id, n_words, hit_spans, item_ids) of each row of ``docs``: where windows of ``benchmark`` occur.

    ``hit_spans`` holds [first, end) word positions of the merged occurrences.
    Windows are ``window`` consecutive words of an item; a shorter item that has
    words is one window. The benchmark's size is summed first: up to
    ``broadcast_chars`` its windows are broadcast, and documents are scanned where they lie. Beyond that the
    windows are a table: documents are scanned once, places that pass a bit filter of fixed size are joined
    with it by hash, confirmed on the words, and put together for each row. Both ways give the same rows.

    Null or empty texts have no words and no hits; very long texts are scanned whole. Items with no words are no windows; an item
    with a null id hits like others and stands as a null in ``item_ids``. Rows of one item_id are one item. Repeated rows of ``docs`` stay rows of their own (``row``
    is their number in the scan). Other columns are left out. Empty tables are fine.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    index = _small_index(benchmark, window, broadcast_chars)
    if index is None:
        return _hits_by_join(rows, benchmark, window)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, hashes = shared.value, WordHashes()
        for batch in batches:
            n, spans, ids = [], [], []
            for text in batch.column(2):
                words = words_of(text.as_py())
                hit, found = windows.scan(words, hashes.of(words))
                edges = np.flatnonzero(np.diff(hit, prepend=False, append=False)) if found else np.empty(0, int)
                n.append(len(words))
                spans.append([{"first": a, "end": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)])
                ids.append(sorted_ids(found))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(n, pa.int64()), pa.array(spans, SPANS), pa.array(ids, pa.list_(pa.string()))], HIT_COLUMNS)

    return rows.mapInArrow(run, HIT_SCHEMA)


def sha256_of_ids(ids):
    """Of the ids that are not null, comma-joined."""
    return F.sha2(F.array_join(ids, ","), 256)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """``docs`` without the rows in which a benchmark window occurs; the others and all columns stay as they are.

    Up to ``broadcast_chars`` of benchmark text rows are judged where they lie, so nothing is
    shuffled. Beyond that the texts that hold a window are found by a join (see ``benchmark_hits``) and their rows go by
    two hashes of the text. Null and empty texts stay. Very long texts, null ids, repeated rows and ties are judged by their text like others. Empty tables are fine.
    """
    index = _small_index(benchmark, window, broadcast_chars)
    if index is None:
        text = F.coalesce(F.col("text"), F.lit(""))
        marked = docs.withColumn("__k1", F.xxhash64(text)).withColumn("__k2", F.xxhash64(F.lit(7), text))
        windows = cut(benchmark_windows(benchmark, window))
        bad = cut(_met(_candidates(marked, {"__k1": "long", "__k2": "long"}, windows), windows).select("__k1", "__k2").distinct())
        return marked.join(bad, ["__k1", "__k2"], "left_anti").select(*docs.columns)
    at, shared = docs.columns.index("text"), docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, hashes = shared.value, WordHashes()
        for batch in batches:
            keep = []
            for text in batch.column(at):
                words = words_of(text.as_py())
                keep.append(not windows.scan(words, hashes.of(words))[1])
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
