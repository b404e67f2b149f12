"""Phrase collocation mining by stripes: each prefix keys a counter of the words that follow it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, chain, cut, mix

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
#: Bytes of text that a task counts together before its stripes leave it, and that are split into words at once.
FLUSH_BYTES, SPLIT_BYTES = 8_000_000, 500_000
#: Size of the filter of frequent phrases that every task holds, in bits: 8 MB whatever the corpus.
FILTER_BITS = 26
_SEGMENT_BITS = 16
#: Buckets in which pairs of words are counted before any is spelled, in bits, and those of one segment, which a task adds up at a time.
BUCKET_BITS, BUCKET_SEGMENT_BITS = 30, 22
_MOST = 65_535

#: Letters A-Z in lower case, the characters that end a piece as line ends, tabs as spaces.
_BREAKS = ".,;:!?\x0b\x0c\r"
_TABLE = bytes.maketrans((ASCII_UPPER + _BREAKS + "\t").encode(), (ASCII_LOWER + "\n" * len(_BREAKS) + " ").encode())
_STRIPES = pa.schema([("lang", pa.string()), ("first", pa.string()), ("nexts", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
_STRIPES_SQL = "lang string, first string, nexts array<string>, counts array<bigint>"


class _Ids(dict):
    """Numbers of words in the order in which they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _lang_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))


def _buckets_of(hashes: np.ndarray, lang: str) -> np.ndarray:
    """Buckets of phrases with these hashes."""
    return (mix(hashes ^ _lang_hash(lang)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _known(hashes: np.ndarray, lang: str, bitmap: np.ndarray) -> np.ndarray:
    """Whether phrases with these hashes are in a filter: a bit for all buckets that share their first FILTER_BITS bits."""
    bits = _buckets_of(hashes, lang) >> (BUCKET_BITS - FILTER_BITS)
    return (bitmap[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1 == 1


def _portions(texts: list[bytes]) -> Iterator[list[bytes]]:
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size >= SPLIT_BYTES:
            yield some
            some, size = [], 0
    yield some


def _numbers(texts: list[bytes], ids: _Ids) -> np.ndarray:
    """The words of ``texts`` as numbers; 0 ends a piece and each text."""
    parts = b"\n".join([*texts, b""]).translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
    return np.fromiter(map(ids.__getitem__, filter(None, parts)), np.int32)


class _Pieces:
    """The words of some texts of one language as numbers (0 ends a piece), their spellings and hashes."""

    def __init__(self, texts: list[bytes]):
        ids = _Ids({b"\n": 0})
        self.at = np.concatenate([_numbers(some, ids) for some in _portions(texts)])
        self.words = list(ids)

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))

    def pairs(self, lang: str, bitmap: np.ndarray) -> np.ndarray:
        """Places at which two neighbours of one piece are both in ``bitmap``."""
        kept = _known(chain(self.hashes(), 1), lang, bitmap)
        kept[0] = False
        return kept[self.at[:-1]] & kept[self.at[1:]]

    def runs(self, lang: str, words: int, bitmap: np.ndarray) -> np.ndarray:
        """Places at which ``words`` neighbours of one piece begin that are, as a phrase, in ``bitmap``."""
        inside = self.at != 0
        n = max(0, len(self.at) - words + 1)
        whole = np.ones(n, bool)
        for k in range(words):
            whole &= inside[k : k + n]
        places = np.flatnonzero(whole)
        whole[places] = _known(chain(self.hashes()[self.at], words)[places], lang, bitmap)
        return whole


def _empty_prefix(lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """The stripe of the empty prefix: how often each word occurs."""
    pieces = _Pieces(texts)
    counts = np.bincount(pieces.at, minlength=len(pieces.words))
    counts[0] = 0
    met = np.flatnonzero(counts)
    if len(met):
        spelled = pa.array(pieces.words, pa.binary()).cast(pa.string()).take(pa.array(met))
        yield _stripes(lang, [""], np.zeros(1, np.int64), spelled, counts[met])


def _stripes(lang: str, first: list[str] | pa.Array, starts: np.ndarray, nexts: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(np.append(starts, len(nexts)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, x) for x in (nexts, pa.array(counts.astype(np.int64)))]
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(first)), pa.array(first, pa.string()), *lists], schema=_STRIPES)


def _count(lang: str, texts: list[bytes], lengths: tuple[int, ...], run: int, bitmap: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The stripes of ``texts`` for prefixes of ``lengths`` words, along phrases whose runs of ``run`` words are all in ``bitmap``.

    Words are numbered inside this call, and a prefix by its place among the distinct pairs of (shorter prefix, next word), so counting is exact. The
    stripes of all prefixes with the same first word leave as one row, each counter's key being what follows that word.
    """
    pieces = _Pieces(texts)
    a, n = pieces.at, len(pieces.words)
    link = pieces.runs(lang, run, bitmap)
    if not link.any():
        return
    before, made = a, []
    for m in range(1, max(lengths) + 1):  # phrases of m + 1 words: runs from each of their first m + 2 - run words
        valid = link.copy()
        for k in range(1, max(1, m + 2 - run)):
            valid = valid[:-1] & link[k:]
        at = np.flatnonzero(valid)
        if not len(at):
            break
        key, first, inverse, counts = np.unique(before[at].astype(np.int64) * n + a[at + m], return_index=True, return_inverse=True, return_counts=True)
        if m in lengths:
            made.append((at[first], m, counts))
        before = np.zeros(len(a), np.int32)
        before[at] = inverse
        del inverse, key
    if not made:
        return
    spelled = pa.array(pieces.words, pa.binary()).cast(pa.string())
    nexts = pa.concat_arrays([pc.binary_join_element_wise(*[spelled.take(pa.array(a[at + k])) for k in range(1, m + 1)], " ") for at, m, _ in made])
    owner, counts = np.concatenate([a[at] for at, *_ in made]), np.concatenate([c for *_, c in made])
    order = np.argsort(owner, kind="stable")
    owner = owner[order]
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    yield _stripes(lang, spelled.take(pa.array(owner[starts])), starts, nexts.take(pa.array(order)), counts[order])


def _bucket_counts(lang: str, texts: list[bytes], bitmap: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counts of the buckets of ``texts``' pairs of frequent words, a row a segment: steps between buckets and counts, 16 bits each."""
    pieces = _Pieces(texts)
    at = np.flatnonzero(pieces.pairs(lang, bitmap))
    buckets, counts = np.unique(_buckets_of(chain(pieces.hashes()[pieces.at], 2)[at], lang), return_counts=True)
    if not len(buckets):
        return
    segments, inside = buckets >> BUCKET_SEGMENT_BITS, buckets & ((1 << BUCKET_SEGMENT_BITS) - 1)
    starts = np.flatnonzero(np.append(True, segments[1:] != segments[:-1]))
    packed = []
    for i, j in zip(starts, [*starts[1:], len(segments)], strict=True):
        step = np.diff(inside[i:j], prepend=-1)
        fill = (step - 1) // _MOST  # steps that pass 16 bits get rows of count 0 in between
        steps, n = np.full(len(step) + int(fill.sum()), _MOST, np.uint16), np.zeros(len(step) + int(fill.sum()), np.uint16)
        last = np.cumsum(fill + 1) - 1
        steps[last], n[last] = step - fill * _MOST, np.minimum(counts[i:j], _MOST)
        packed.append(steps.tobytes() + n.tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(segments[starts], pa.int64()), pa.array(packed, pa.binary())], names=["s", "packed"])


def _by_language(count):
    """``count(lang, texts)`` over some megabytes of text of a language at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                body = text.as_buffer().to_pybytes()
                held.setdefault(lang, []).append(body)
                size[lang] = size.get(lang, 0) + len(body) + 1
                full = [lang] if size[lang] >= FLUSH_BYTES else list(held) if sum(size.values()) >= 2 * FLUSH_BYTES else []
                for x in full:
                    yield from count(x, held.pop(x))
                    del size[x]
        for x, texts in held.items():
            yield from count(x, texts)

    return run


def _bits(bitmap) -> np.ndarray:
    return np.frombuffer(bitmap.value, np.uint8)


def _merged(stripes: DataFrame) -> DataFrame:
    """(lang, phrase, f): stripes added up elementwise. A very frequent prefix is spread by what follows it."""
    entries = stripes.select("lang", "first", F.explode(F.arrays_zip("nexts", "counts")).alias("e"))
    phrase = F.when(F.col("first") == "", F.col("e.nexts")).otherwise(F.concat_ws(" ", "first", "e.nexts"))
    return entries.select("lang", phrase.alias("phrase"), F.col("e.counts").alias("f")).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def stripe_counts(docs: DataFrame, lengths: tuple[int, ...] = (0,), run: int = 1, bitmap=None) -> DataFrame:
    """(lang, phrase, f): how often phrases, prefixes of ``lengths`` words and the next word, occur within a piece of ``docs`` (lang, text).

    A task merges the stripes of some megabytes of text before they leave it; Spark merges them elementwise. With ``bitmap`` only phrases
    count whose runs of ``run`` words are all in it; the empty prefix (lengths = (0,)) counts all words.
    """
    if lengths == (0,):
        return _merged(docs.select("lang", "text").mapInArrow(_by_language(_empty_prefix), _STRIPES_SQL))
    return _merged(docs.select("lang", "text").mapInArrow(_by_language(lambda lang, texts: _count(lang, texts, lengths, run, _bits(bitmap))), _STRIPES_SQL))


def _segments_to_bitmap(spark, segments: DataFrame, bits: int):
    """A broadcast bitmap from (s, packed), each the bits of one of its stretches of 2 ** ``bits``."""
    whole, width = np.zeros(1 << (FILTER_BITS - 3), np.uint8), 1 << (bits - 3)
    for row in segments.toLocalIterator():
        whole[row.s * width : (row.s + 1) * width] |= np.frombuffer(row.packed, np.uint8)
    return spark.sparkContext.broadcast(whole.tobytes())


def pair_filter(docs: DataFrame, words, min_count: int):
    """A broadcast bitmap that has every pair of neighbours found ``min_count`` times or more in ``docs`` (lang, text), both words in the bitmap ``words``.

    Pairs are counted by bucket, so that the many rare ones are never spelled: a task sends the counts of its buckets in some 4 bytes each, and the
    counts of a segment of buckets are added up in one array of fixed size. A bucket is at least as frequent as any pair in it.
    """
    keep = BUCKET_SEGMENT_BITS - (BUCKET_BITS - FILTER_BITS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, counts = min(min_count, _MOST), np.zeros(1 << BUCKET_SEGMENT_BITS, np.int32)

        def bits(s: int) -> pa.RecordBatch:
            often = np.zeros(1 << keep, bool)
            often[np.flatnonzero(counts >= least) >> (BUCKET_BITS - FILTER_BITS)] = True
            return pa.RecordBatch.from_arrays([pa.array([s]), pa.array([np.packbits(often, bitorder="little").tobytes()])], names=["s", "packed"])

        last, added = None, 0
        for batch in batches:
            for s, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if s != last:
                    if last is not None:
                        yield bits(last)
                    counts.fill(0)
                    last, added = s, 0
                steps, n = np.frombuffer(packed, np.uint16).reshape(2, -1)
                counts[np.cumsum(steps, dtype=np.int64) - 1] += n
                added += 1
                if added % 16_384 == 0:  # before 32 bits could be too few
                    np.minimum(counts, 1 << 20, out=counts)
        if last is not None:
            yield bits(last)

    rows = docs.select("lang", "text").mapInArrow(_by_language(lambda lang, texts: _bucket_counts(lang, texts, _bits(words))), "s long, packed binary")
    merged = rows.repartition("s").sortWithinPartitions("s").mapInArrow(add, "s long, packed binary")
    return _segments_to_bitmap(docs.sparkSession, merged, keep)


def phrase_filter(phrases: DataFrame):
    """A broadcast bitmap of the ``phrases`` (lang, phrase): fixed in size; others may be in it by chance, none of these is missing."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = np.fromiter(map(xxhash.xxh3_64_intdigest, phrase.encode().split(b" ")), np.uint64)
                found.append(_buckets_of(chain(words, len(words)), lang)[0] >> (BUCKET_BITS - FILTER_BITS))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(found, np.int64))], names=["bit"])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            places = batch.column(0).to_numpy()
            for s in np.unique(places >> _SEGMENT_BITS).tolist():
                inside = places[places >> _SEGMENT_BITS == s] & ((1 << _SEGMENT_BITS) - 1)
                made.setdefault(s, np.zeros(1 << _SEGMENT_BITS, bool))[inside] = True
        packed = [np.packbits(x, bitorder="little").tobytes() for x in made.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.int64()), pa.array(packed, pa.binary())], names=["s", "packed"])

    bit = phrases.select("lang", "phrase").mapInArrow(bits, "bit long")
    return _segments_to_bitmap(phrases.sparkSession, bit.repartition(F.shiftright("bit", _SEGMENT_BITS)).mapInArrow(segments, "s long, packed binary"), _SEGMENT_BITS)


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, m, f) of all phrases of 1 to ``max_words`` words found ``min_count`` times or more, and (lang, n) of all words.

    Four scans: the stripe of the empty prefix counts words and, in total, n; buckets of pairs of frequent words tell which pairs can be
    frequent; stripes count these and the phrases of three words made of them, then longer ones made of frequent threes. A
    phrase is never more frequent than its parts, so nothing is missed.
    """
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    often, length = F.col("f") >= min_count, F.size(F.split("phrase", " ")).alias("m")
    words = cut(stripe_counts(rows))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    found = words.where(often).select("lang", "phrase", F.lit(1).alias("m"), "f")
    if max_words > 1:
        pairs = pair_filter(rows, phrase_filter(found), min_count)
        short = cut(stripe_counts(rows, tuple(range(1, min(3, max_words))), 2, pairs).where(often).select("lang", "phrase", length, "f"))
        found = found.union(short)
    if max_words > 3:
        longer = stripe_counts(rows, tuple(range(3, max_words)), 3, phrase_filter(short.where("m = 3"))).where(often)
        found = found.union(cut(longer.select("lang", "phrase", length, "f")))
    return found, totals


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP) -> DataFrame:
    """The best phrases of each language of ``docs`` (lang, text): lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and split at ``. , ; : ! ?`` and line ends into pieces, those at spaces and tabs into words. A
    candidate has 2 to ``max_words`` words and occurs a >= ``min_count`` times in its language; each cut into two parts of frequencies l
    and r scores floor(1000 a n / (l r)), and the lowest-scoring cut counts, the first of equal ones. Candidates that occur only inside
    one longer candidate are dropped: the largest count among the extensions by one word, to the right and to the
    left, tells that. The ``top`` by score, then a, then phrase in byte order stay.

    Null language is ``und``, null text empty; rows without words count for nothing; repeated rows count as often as they
    occur; very long texts are counted whole; ties are broken by phrase, which is unique in a language. Further columns are
    left out. An empty table gives an empty result. The arithmetic is decimal, exact to 38 digits.
    """
    found, totals = frequent_phrases(docs, min_count, max_words)
    part = found.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    candidates = found.where("m > 1")

    longer = found.where("m > 2").select("lang", "f", F.explode(F.array(F.expr("substring_index(phrase, ' ', m - 1)"), F.expr("substring_index(phrase, ' ', 1 - m)"))).alias("phrase"))
    within = longer.groupBy("lang", "phrase").agg(F.max("f").alias("extended"))
    free = candidates.join(within, ["lang", "phrase"], "left").where("extended is null or 100 * extended < 100 * f").drop("extended")

    cuts = free.select("*", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - m)")})
    cuts = cuts.join(part.select("lang", F.col("part").alias("left"), F.col("part_f").alias("l")), ["lang", "left"])
    cuts = cuts.join(part.select("lang", F.col("part").alias("right"), F.col("part_f").alias("r")), ["lang", "right"])
    wide = "cast({} as decimal(19, 0))"
    score = F.expr(f"(cast(1000 as decimal(4, 0)) * {wide.format('f')} * {wide.format('n')}) div ({wide.format('l')} * {wide.format('r')})")
    scored = cuts.join(totals, "lang").withColumn("score", score)
    best = scored.groupBy("lang", "phrase", F.col("f").alias("a"), "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("x")).select("lang", "phrase", "a", "n", "x.l", "x.r", "x.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
