"""Phrases, exact search and the conversation trie on small awkward tables, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fairgrid.llm import conversations, linededup, phrases, queries, topk

# ---- phrases -----------------------------------------------------------------------------------------------------


def brute_phrases(rows, min_count, top=2000, most=5):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, most + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i : i + m])] += 1
    found = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= min_count}

    def covered(lang, p, a):
        return any(k[0] == lang and len(k[1]) > len(p) and v >= a and any(k[1][i : i + len(p)] == p for i in range(len(k[1]))) for k, v in found.items())

    out = {}
    for (lang, p), a in found.items():
        if not covered(lang, p, a):
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    rows = []
    for lang, found in out.items():
        rows += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(rows)


def phrase_rows(seed, n=120):
    r = random.Random(seed)
    vocabulary = ["The", "of", "a", "New", "york", "é", "été", "x1", "#", "big\x00word", "日本"]
    rows = [(r.choice(["en", "de", None, "und"]), "".join(r.choice(vocabulary) + r.choice([" ", " ", " ", "\t", ", ", ".\n", " ; ", "  "]) for _ in range(r.randrange(40)))) for _ in range(n)]
    copy = "alpha beta gamma delta epsilon zeta"
    return [*rows, *[("en", copy)] * 30, ("en", None), (None, ""), ("en", "   \n\t .,;"), ("de", "w" * 50_000), ("en", "one " * 3000), ("", "of of of"), ("en", copy + " eta")]


@pytest.mark.parametrize(("least", "flush"), [(5, 8_000_000), (12, 500), (31, 60_000)])
def test_phrases_equal_brute_force(spark, monkeypatch, least, flush):
    rows = phrase_rows(least)
    monkeypatch.setattr(phrases, "FLUSH_BYTES", flush)
    monkeypatch.setattr(phrases, "SPLIT_BYTES", flush // 5)
    docs = spark.createDataFrame(rows, "lang string, text string").withColumns({"phrase": F.lit("clash"), "f": F.lit(1), "first": F.lit("x")}).repartition(3)
    got = sorted(tuple(r) for r in phrases.collocations(docs, min_count=least).collect())
    assert got == brute_phrases(rows, least) and got


def test_phrases_with_other_limits_and_empty_tables(spark):
    rows = phrase_rows(3)
    docs = spark.createDataFrame(rows, "lang string, text string")
    for most in (2, 3, 4):
        got = sorted(tuple(r) for r in phrases.collocations(docs, min_count=8, max_words=most, top=3).collect())
        assert got == brute_phrases(rows, 8, 3, most)
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(docs.where("text is null"), min_count=1).count() == 0


def test_bucket_counts_keep_wide_steps_and_large_counts(monkeypatch):
    monkeypatch.setattr(phrases, "BUCKET_SEGMENT_BITS", 30)  # one segment, so steps pass 16 bits
    everything = np.full(1 << (phrases.FILTER_BITS - 3), 255, np.uint8)
    texts = [("a b " * 70_000).encode(), (" ".join(f"w{i}" for i in range(40)) + ". alone").encode()]
    (batch,) = phrases._bucket_counts("en", texts, everything)
    steps, n = np.frombuffer(batch.column(1)[0].as_py(), np.uint16).reshape(2, -1)
    got = {int(k): int(v) for k, v in zip(np.cumsum(steps, dtype=np.int64) - 1, n, strict=True) if v}
    pairs = Counter([("a", "b")] * 70_000 + [("b", "a")] * 69_999 + [(f"w{i}", f"w{i + 1}") for i in range(39)])
    want = Counter()
    for pair, count in pairs.items():
        words = np.array([phrases.xxhash.xxh3_64_intdigest(w.encode()) for w in pair], np.uint64)
        want[int(phrases._buckets_of(phrases.chain(words, 2), "en")[0])] += count
    assert got == {k: min(v, 65_535) for k, v in want.items()} and list(phrases._bucket_counts("en", [b"alone", b""], everything)) == []


# ---- exact search ------------------------------------------------------------------------------------------------


def brute_top(rows, k, every):
    whole = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in whole:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q and len(w) == len(v))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize(("scale", "kind"), [(1, "float"), (300, "double"), (1e6, "double")])
def test_top_k_equals_brute_force(spark, monkeypatch, scale, kind):
    monkeypatch.setattr(topk, "SLICE", 32)
    r = np.random.default_rng(int(scale))
    rows = [(i, [float(np.float32(x)) for x in scale * r.normal(size=6)]) for i in range(150)]
    same = rows[7][1]
    rows += [(i, same) for i in range(150, 260)]  # a large group of equal vectors, some of them queries
    rows += [(300, None), (310, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (320, [float("nan")] * 6), (330, [float("inf")] * 6), (None, same), (340, []), (341, []), (350, [1.0, 2.0]), (361, [2.0, 1.0])]
    rows += [rows[3]]  # a repeated row
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumns({"label": F.lit(1), "rank": F.lit("x"), "score": F.lit("y"), "place": F.lit(0)}).repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, block=40)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint"]
    assert sorted(tuple(x) for x in got.collect()) == brute_top(rows, 5, 10)


def test_top_k_on_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [1.0]), (2, [-1.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(x) for x in topk.top_k(df, F.col("vec_id") % 50 == 0).collect()) == [(0, 1, 1, 65536), (0, 2, 2, -65536)]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == topk.top_k(df, F.col("vec_id") > 9).count() == 0
    assert topk.top_k(df.where("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0
    with pytest.raises(Exception, match="62 bits"):
        topk.top_k(spark.createDataFrame([(0, [1e300]), (1, [1.0])], "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()


# ---- the trie ----------------------------------------------------------------------------------------------------


def brute_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(x[2], x[3]) for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out, parents = [], Counter(x[:-1] for x in members if x)
    for k, who in members.items():
        below = [x for x in members if x[: len(k)] == k]
        leaves = sum(x not in parents for x in below)
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        ends = ",".join(map(str, sorted(c for c in who if len(built[c]) == len(k))))
        parent = min(members[k[:-1]]) if k else None
        out.append((min(who), len(k), parent, len(who), parents[k], leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


TRIE = "conv_id long, turn long, role string, text string"


def trie_rows(seed):
    r = random.Random(seed)
    rows = []
    for c in range(0, 60):
        if c % 7 == 3:
            continue
        shared = r.choice([[], ["s"], ["s", "t"], ["s", "t", "u", "v", "w", "x", "y", "z", "a", "b"]])
        turns = shared + [r.choice("pqé") for _ in range(r.choice([0, 0, 1, 3, 9]))]
        rows += [(c, i if r.random() < 0.9 else None, r.choice(["user", None]) if i > 6 else "user", t if r.random() < 0.95 else None) for i, t in enumerate(turns)]
    for c in (101, 102, 107, 108, 112, 8000, 8003, 12_345):  # copies
        rows += [(c, i, "user", "copy") for i in range(16)]
    rows += [(c, i, "user", f"turn {i}") for c in range(200, 230) for i in range(c - 195)]  # each longer than the one before
    rows += [(300, 1, "user", "tie")] * 3 + [(300, 1, "bot", "tie"), (None, 0, "user", "none"), (-4, 0, "user", "s"), (-5, 0, "user", "s"), (-5, 1, None, None), (400, 0, "user", "x" * 100_000)]
    return rows + [(500, i, "user", str(i % 3)) for i in range(130)] + [(501, i, "user", str(i % 3) if i != 120 else "other") for i in range(130)]


@pytest.mark.parametrize(("seed", "block", "together"), [(1, 8, 1024), (2, 3, 2)])
def test_trie_equals_brute_force(spark, monkeypatch, seed, block, together):
    monkeypatch.setattr(conversations, "BLOCKS_TOGETHER", together)
    rows = trie_rows(seed)
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, TRIE).withColumns({"depth": F.lit("clash"), "g": F.lit(1), "part": F.lit("x"), "rank": F.lit(0)}).repartition(3)
    assert sorted((tuple(x) for x in conversations.prefix_trie(df, block).collect()), key=str) == brute_trie([x for x in rows])


def test_trie_of_few_rows(spark):
    df = spark.createDataFrame([(7, None, None, None)], TRIE)
    assert sorted((tuple(x) for x in conversations.prefix_trie(df).collect()), key=str) == brute_trie([(7, None, None, None)])
    assert conversations.prefix_trie(df.limit(0)).count() == 0
    assert conversations.prefix_trie(df.withColumn("conv_id", F.lit(None).cast("long"))).count() == 0


# ---- registered queries ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_phrases", "op12_top_k", "op13_prefix_trie"])
def test_registered_query_equals_its_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES[name](spark, sf)
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name])
    heads = [d[0] for d in want.description]
    assert got.columns == heads
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_lines_lost_are_counted_with_and_without_ansi(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        docs = spark.createDataFrame([(1, "a line of some length\nown"), (2, "a line of some length"), (3, None), (4, "alone")], "doc_id long, text string")
        assert {r.doc_id: (r.n_lines, r.n_dropped) for r in linededup.dedup_lines(docs).collect()} == {1: (2, 0), 2: (1, 1), 3: (1, 0), 4: (1, 0)}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
