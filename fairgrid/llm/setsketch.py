"""Near-duplicate groups by SetSketch registers, banded, estimated jointly by likelihood and verified on full sets."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, chain, connected_components, cut, key_groups, mix, utf8

#: A pair at the threshold shares at least one band but for about 1 in 10^8.
BANDS, ROWS = 60, 6
REGISTERS = BANDS * ROWS
#: Registers are 1 - floor(log_BASE(minimum)), stored whole as 16 bits. Their low bytes alone order two
#: sketches of sets whose sizes differ by less than a factor of 10 or so, which is all that a comparison needs.
BASE = 1.02
LOG_BASE = math.log(BASE)
THRESHOLD_PERCENT = 80
#: Pairs whose estimate is lower than the threshold by this much (six standard deviations) are not verified.
SLACK = 0.13
#: Members of a bucket's lesser parts that one task compares at once with as many others.
BLOCK = 4096
#: Rounds in which each part of a bucket meets the bucket's least part, before members are compared.
STAR_ROUNDS = 3
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, n: int, hashes: WordHashes) -> np.ndarray:
    """The distinct ``n``-word shingles of a text as sorted 64-bit hashes; with fewer words the whole sequence is one."""
    words = utf8(text).lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(chain(hashes.of(words), min(n, len(words))))


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers (rows of int32) of non-empty sets of 64-bit hashes.

    Every element draws the points of a Poisson process over all registers in
    rising order, so each register's minimum is exponential; points beyond a
    set's bound cannot be a minimum and are never drawn. Sets whose bound left
    a register empty are drawn again with a wider one. Sketches merge by maximum.
    """
    sizes = np.array([len(s) for s in sets])
    least = np.full((len(sets), REGISTERS), np.inf)
    slack, todo = math.log(REGISTERS) + 5, np.arange(len(sets))
    while len(todo):
        least[todo] = np.inf
        element, owner = np.concatenate([sets[i] for i in todo]), np.repeat(todo, sizes[todo])
        bound, value, step = slack / sizes, np.zeros(len(element)), 0
        flat = least.reshape(-1)
        while len(element):
            k = int(max(1, min(256, 16384 // len(element))))
            draw = mix(element[:, None] + _STEP * np.arange(step + 1, step + k + 1, dtype=np.uint64))
            points = value[:, None] + np.cumsum(-np.log(((draw >> np.uint64(11)) + np.uint64(1)).astype(float) * 2.0**-53), axis=1) / REGISTERS
            inside = points <= bound[owner][:, None]
            at = (mix(draw ^ _STEP) >> np.uint64(32)) % np.uint64(REGISTERS)
            np.minimum.at(flat, (owner[:, None] * REGISTERS + at.astype(np.int64))[inside], points[inside])
            alive = inside[:, -1]
            element, owner, value, step = element[alive], owner[alive], points[alive, -1], step + k
        todo = todo[np.isinf(least[todo]).any(1)]
        slack *= 2
    return (1 - np.floor(np.log(least) / LOG_BASE)).astype(np.int32)


def stored(regs: np.ndarray) -> list[bytes]:
    """Each row of registers as bytes: first all low bytes, then all high bytes."""
    whole = regs.astype("<i2").view(np.uint8).reshape(-1, REGISTERS, 2)
    return [row.tobytes() for row in np.concatenate([whole[:, :, 0], whole[:, :, 1]], axis=1)]


def loaded(sketches: list[bytes]) -> np.ndarray:
    """The registers (rows of int16) of stored sketches."""
    planes = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, 2, REGISTERS)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i2")[:, :, 0]


def merged(sketches: list[bytes]) -> bytes:
    """The sketch of the union of the sets behind ``sketches``: the greatest value of each register."""
    return stored(loaded(sketches).max(0, keepdims=True))[0]


def _log_likelihood(j: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """Of similarity ``j``, given both sizes and how many registers are greater or less in a than in b."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    p = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / LOG_BASE
    more, less = p(u - v * j), p(v - u * j)
    return up * np.log(more) + down * np.log(less) + (REGISTERS - up - down) * np.log(np.maximum(1 - more - less, 1e-12))


def _order(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    diff = (a - b).view(np.int8)
    return (diff > 0).sum(-1), (diff < 0).sum(-1)


def estimate(n_a: np.ndarray, n_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The Jaccard similarity that makes the registers' order likeliest, sizes being known; ``a`` and ``b`` are rows of register bytes."""
    up, down = _order(a, b)
    j = np.linspace(0, 1, 201)[None, :] * (np.minimum(n_a, n_b) / np.maximum(n_a, n_b))[:, None]
    fit = _log_likelihood(j, n_a[:, None], n_b[:, None], up[:, None], down[:, None])
    return np.take_along_axis(j, fit.argmax(1)[:, None], 1)[:, 0]


def not_ruled_out(n_a: np.ndarray, n_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the estimate reaches the threshold less SLACK: the likelihood is concave, so its slope there tells."""
    up, down = _order(a, b)
    at = THRESHOLD_PERCENT / 100 - SLACK
    return _log_likelihood(at + 0.001, n_a, n_b, up, down) >= _log_likelihood(at - 0.001, n_a, n_b, up, down)


def sketch(docs: DataFrame, shingle_words: int) -> DataFrame:
    """(doc_id, n, same, sketch) of every row: set size, digest of the set and stored registers (both null if it is empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                sets = [shingle_set(t.as_py(), shingle_words, hashes) for t in part.column(1)]
                full = [s for s in sets if len(s)]
                regs = iter(stored(registers(full)) if full else ())
                sizes = pa.array([len(s) for s in sets], pa.int64())
                same = pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary())
                made = pa.array([next(regs) if len(s) else None for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), sizes, same, made], ["doc_id", "n", "same", "sketch"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n long, same binary, sketch binary")


def _likely(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (a, b and their parts p, q) whose sketches do not rule the threshold out."""
    one, two = (
        sketches.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}")) for c in "ab"
    )
    near = f"100 * least(n_a, n_b) >= {THRESHOLD_PERCENT} * greatest(n_a, n_b)"
    met = pairs.join(two, "b").join(one, "a").where(near).select("a", "b", "p", "q", "n_a", "n_b", "s_a", "s_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                n_a, n_b = (part.column(c).to_numpy() for c in ("n_a", "n_b"))
                s_a, s_b = (_rows_of(part.column(c).to_pylist()) for c in ("s_a", "s_b"))
                yield part.select(["a", "b", "p", "q"]).filter(pa.array(not_ruled_out(n_a, n_b, s_a, s_b)))

    return met.mapInArrow(run, "a long, b long, p long, q long")


def _rows_of(low_bytes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(low_bytes), np.uint8).reshape(-1, REGISTERS)


def _sets(ids: DataFrame, docs: DataFrame, shingle_words: int) -> DataFrame:
    """(doc_id, shingles) of the documents in ``ids`` (doc_id, distinct) only, once for each text of an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                sets = [shingle_set(t.as_py(), shingle_words, hashes).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["doc_id", "shingles"])

    wanted = docs.select("doc_id", "text").join(cut(ids), "doc_id", "left_semi")
    return cut(wanted.mapInArrow(run, "doc_id long, shingles binary"))


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= THRESHOLD_PERCENT * (len(x) + len(y) - both)


def _verified(pairs: DataFrame, docs: DataFrame, shingle_words: int) -> DataFrame:
    """The parts (p, q) of ``pairs`` (a, b, p, q) whose full shingle sets reach the threshold."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = ([np.frombuffer(v, np.uint64) for v in batch.column(c).to_pylist()] for c in ("set_a", "set_b"))
            keep = [_linked(*xy) for xy in zip(x, y, strict=True)]
            yield batch.select(["p", "q"]).filter(pa.array(keep, pa.bool_()))

    full = _sets(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), docs, shingle_words)
    one, two = (full.select(F.col("doc_id").alias(c), F.col("shingles").alias(f"set_{c}")) for c in "ab")
    met = pairs.join(two, "b").join(one, "a").select("p", "q", "set_a", "set_b")
    return met.mapInArrow(confirm, "p long, q long")


def _likely_within(rows: pa.Table) -> list[tuple[int, int, int]]:
    """(i, j, equal registers) of the row pairs of one job whose parts differ and whose sketches do not rule the threshold out.

    ``rows``: bucket, low, high, block, doc_id, part, n, sketch. A pair that shares several
    bands counts in the first of them only, so it is met once in all buckets.
    """
    part, n, block = (rows.column(c).to_numpy() for c in ("part", "n", "block"))
    low, high = (rows.column(c)[0].as_py() for c in ("low", "high"))
    band = rows.column("bucket")[0].as_py() & 63
    s = _rows_of(rows.column("sketch").to_pylist())
    bands = np.zeros((len(part), BANDS, 8), np.uint8)
    bands[:, :, :ROWS] = s.reshape(len(part), BANDS, ROWS)
    bands = bands.view(np.uint64)[:, :, 0]
    ours, theirs = np.flatnonzero(block == low), np.flatnonzero(block == high)
    if len(ours) > len(theirs):
        ours, theirs = theirs, ours
    out = []
    for i in ours.tolist():
        j = theirs[theirs > i] if low == high else theirs
        near = 100 * np.minimum(n[j], n[i]) >= THRESHOLD_PERCENT * np.maximum(n[j], n[i])
        j = j[near & (part[j] != part[i])]
        if len(j):
            j = j[(bands[j] == bands[i]).argmax(1) == band]
        if len(j):
            j = j[not_ruled_out(n[i], n[j], s[i], s[j])]
            out += zip([i] * len(j), j.tolist(), (s[i] == s[j]).sum(1).tolist(), strict=True)
    return out


_KEYS = ["bucket", "low", "high"]


def _links_across(member: DataFrame, reps: DataFrame, docs: DataFrame, shingle_words: int) -> DataFrame:
    """Linked parts (p, q) of members that ``member`` (bucket, doc_id, part) has in one bucket and in different parts.

    A bucket's largest part needs no comparison within itself: only the members of its lesser parts
    meet all others. They are cut into blocks of about BLOCK by id hash, the largest part likewise, and
    each lesser block meets each block in a job of its own. So while the lesser parts fit one block, every
    row of the largest part moves once, whatever the bucket's size, and no task holds more than two blocks. First sketches tell which
    members have a likely partner; only those are met with their full sets, in the same jobs, and only links
    that join parts come out. No pair leaves its job unverified.
    """
    sizes = member.groupBy("bucket", "part").agg(F.count("*").alias("size"))
    whole = sizes.groupBy("bucket").agg(F.sum("size").alias("total"), F.max(F.struct("size", "part")).alias("most"))
    blocks = lambda size: F.ceil(size / BLOCK).cast("long")
    layout = cut(
        whole.where("total > most.size").select(
            "bucket", F.col("most.part").alias("main"), blocks(F.col("total") - F.col("most.size")).alias("few"), blocks(F.col("most.size")).alias("many")
        )
    )
    is_main, number = F.col("part") == F.col("main"), F.xxhash64("doc_id")
    dealt = (
        member.join(layout, "bucket")
        .withColumn("block", F.when(is_main, F.col("few") + F.pmod(number, "many")).otherwise(F.pmod(number, "few")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.when(is_main, F.col("few")).otherwise(F.col("few") + F.col("many")) - 1)))
        .select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "doc_id", "part")
    )
    sketches = reps.select("doc_id", "n", "sketch")
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = lambda df: df.repartition(n_parts, *_KEYS).sortWithinPartitions(*_KEYS)

    def involved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_groups(batches, 3):
            found = sorted({k for i, j, _ in _likely_within(rows) for k in (i, j)})
            if found:
                yield from rows.select([*_KEYS, "block", "doc_id", "part"]).take(found).combine_chunks().to_batches()

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_groups(batches, 3):
            joined, out = {}, []
            sets = [np.frombuffer(x.as_py(), np.uint64) for x in rows.column("shingles")]

            def root(p: int, joined: dict = joined) -> int:
                while p in joined:
                    p = joined[p]
                return p

            parts = rows.column("part").to_pylist()
            for i, j, _ in sorted(_likely_within(rows), key=lambda x: -x[2]):
                a, b = root(parts[i]), root(parts[j])
                if a != b and _linked(sets[i], sets[j]):
                    joined[a] = b
                    out.append((parts[i], parts[j]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["p", "q"])

    plain = "bucket long, low long, high long, block long, doc_id long, part long"
    shipped = dealt.join(sketches, "doc_id").select(*_KEYS, "block", "doc_id", "part", "n", "sketch")
    rows = cut(together(shipped).mapInArrow(involved, plain))
    full = _sets(rows.select("doc_id").distinct(), docs, shingle_words)
    met = rows.join(full.join(sketches, "doc_id"), "doc_id").select(*_KEYS, "block", "doc_id", "part", "n", "sketch", "shingles")
    return together(met).mapInArrow(linked, "p long, q long")


def _least_leaders(member: DataFrame) -> DataFrame:
    """(a, b, p, q): for each two parts (p, q) that meet in a bucket of ``member`` whose least part is p, one pair of their members."""
    lead = member.groupBy("bucket", "part").agg(F.min("doc_id").alias("doc"))
    least = lead.groupBy("bucket").agg(F.min(F.struct("part", "doc")).alias("least"))
    met = lead.join(least, "bucket").where("part <> least.part")
    pairs = met.groupBy(F.col("least.part").alias("p"), F.col("part").alias("q")).agg(F.min(F.struct("least.doc", F.col("doc").alias("other"))).alias("x"))
    return pairs.select(F.col("x.doc").alias("a"), F.col("x.other").alias("b"), "p", "q")


def _in_parts(member: DataFrame, parts: DataFrame) -> DataFrame:
    """``member`` (bucket, doc_id, ...) with its ``part`` from ``parts`` (doc_id, part), without the buckets that lie in one part."""
    part = F.coalesce("part", "doc_id").alias("part")
    placed = lambda m: m.select("bucket", "doc_id").join(parts, "doc_id", "left").select("bucket", "doc_id", part)
    mixed = cut(placed(member).groupBy("bucket").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("bucket"))
    return cut(placed(member.join(mixed, "bucket", "left_semi")))


def _merged_parts(parts: DataFrame | None, links: DataFrame) -> DataFrame:
    """``parts`` (doc_id, part) after ``links`` (p, q) between parts; a document without a row is its own part."""
    labels = connected_components(links.select(F.col("p").alias("a"), F.col("q").alias("b")))
    own = labels.select(F.col("id").alias("doc_id"), F.col("component_id").alias("part"))
    if parts is None:
        return own
    moved = parts.join(labels, parts["part"] == labels["id"], "left").select("doc_id", F.coalesce("component_id", "part").alias("part"))
    return cut(moved.union(own.join(parts, "doc_id", "left_anti")))


def near_duplicate_groups(docs: DataFrame, shingle_words: int = 2) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text): groups linked by a Jaccard similarity of 0.8 or more.

    Words are runs without white space, A-Z lower-cased. Equal sets collapse to
    their smallest doc_id first, so copies never meet in a bucket. Registers are
    cut into bands; documents that share a band's values are candidates. First
    every document is paired with one other, the least of the smallest ids of its buckets; those pairs are
    filtered by the joint estimate, verified on full sets, and joined into parts. In the next rounds
    each part of a bucket meets the bucket's least part, one pair for two parts. Then members of buckets that still
    hold several parts are compared across parts (see ``_links_across``). So a large group costs rows for each member and
    band, not the square of its size. All buckets are worked on whole, without caps.

    Null, empty and wordless texts have no shingles and stay alone. Very long texts are read whole. Rows with a
    null doc_id get a null component. Repeated rows of one id count once; if their texts
    differ, the id has the links of each. Ties go to the smaller id. Other columns are left out. An empty table stays empty.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = cut(sketch(docs, shingle_words))
    known = rows.where("same is not null and doc_id is not null")
    least = cut(known.groupBy("same").agg(F.min("doc_id").alias("rep")))
    low_bytes = F.expr(f"substring(sketch, 1, {REGISTERS})").alias("sketch")
    own = known.join(least.withColumnRenamed("rep", "doc_id"), ["doc_id", "same"], "left_semi")
    reps = cut(own.select("doc_id", "same", "n", low_bytes).dropDuplicates(["doc_id", "same"]).drop("same"))

    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    values = F.xxhash64("band", F.expr(f"substring(sketch, band * {ROWS} + 1, {ROWS})"))
    buckets = reps.select("doc_id", "sketch", band).select(F.shiftleft(values, 6).bitwiseOR(F.col("band").cast("long")).alias("bucket"), "doc_id")
    leaders = cut(buckets.groupBy("bucket").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("z")).where("leader <> z").select("bucket", "leader"))
    member = cut(buckets.join(leaders, "bucket").select("bucket", "doc_id", "leader"))
    stars = member.where("doc_id <> leader").groupBy(F.col("doc_id").alias("b")).agg(F.min("leader").alias("a"))
    links = cut(_verified(cut(_likely(stars.select("a", "b", F.col("a").alias("p"), F.col("b").alias("q")), reps)), docs, shingle_words))
    parts = _merged_parts(None, links)
    member = _in_parts(member, parts)
    for _ in range(STAR_ROUNDS):
        links = cut(_verified(cut(_likely(_least_leaders(member), reps)), docs, shingle_words))
        if links.isEmpty():
            break
        parts = _merged_parts(parts, links)
        member = _in_parts(member, parts)
    links = cut(_links_across(member, reps, docs, shingle_words))
    if not links.isEmpty():
        parts = _merged_parts(parts, links)

    same = known.select("doc_id", "same").join(least, "same").select("doc_id", "rep")
    twins = cut(same.groupBy("doc_id").agg(F.min("rep").alias("rep"), F.max("rep").alias("top")))
    if not twins.where("rep <> top").isEmpty():
        # an id with several texts joins the parts of all of them
        of = lambda c: parts.select(F.col("doc_id").alias(c), F.col("part").alias(f"{c}_part"))
        both = same.join(of("rep"), "rep", "left").join(of("doc_id"), "doc_id", "left")
        both = both.select(F.coalesce("doc_id_part", "doc_id").alias("p"), F.coalesce("rep_part", "rep").alias("q"))
        parts = _merged_parts(parts, both.where("p <> q"))
    found = twins.join(parts.withColumnRenamed("doc_id", "rep"), "rep", "left").select("doc_id", F.coalesce("part", "rep").alias("component_id"))
    return rows.join(found, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
