"""Packing, quality, language, outliers, decontamination, line de-duplication and sharding on small awkward tables."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairgrid.llm import decontam, langid, linededup, outliers, packing, quality, sharding
from fairgrid.llm.common import WordHashes, connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, langs=None, start=0):
    rows = [(start + i, t, (langs or ["en"] * len(texts))[i], f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def words(n, seed, vocabulary=("alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa")):
    r = random.Random(seed)
    return " ".join(r.choice(vocabulary) + str(r.randrange(50)) for _ in range(n))


AWKWARD = [None, "", "   ", "\n\n", "one", "Same line here again\nSame line here again", "Same line here again", "x" * 50_000, "é" * 100, "a\tb\x0bc"]


# ---- packing -----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_cached_tokens_equal_whole_tokens(tokenizer_path):
    from tokenizers import Tokenizer

    whole, cached = Tokenizer.from_file(tokenizer_path), packing.tokenizer_of(tokenizer_path)
    texts = ["Hello, World! it's 42", "<|endoftext|> x<|startoftext|>", "ÉCOLE naïve… don't", "ΑΣ ΟΔΟΣ", "a\x1cb\x85c d", "###$$$ %%%x", "", "  ", "İstanbul K ½ ﬁ", "tab\tnl\nend", "'s 't '"]
    for t in texts:
        assert np.frombuffer(cached.ids(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, t


def test_full_caches_change_no_ids(tokenizer_path):
    few, many = packing.CachedTokenizer(tokenizer_path), packing.tokenizer_of(tokenizer_path)
    few.CHUNKS = few.WORDS = 8
    texts = [words(60, i, ("Alpha,", "beta", "Gamma's", "é", "42", "the.")) for i in range(5)] + ["x" * 500 + " the the", ""]
    assert [few.ids(t) for t in texts] == [many.ids(t) for t in texts]
    assert len(few) <= 4 and len(few.older) <= 4 and len(few.words) <= 4 and len(few.older_words) <= 4


def test_best_fit_bounds_and_order():
    bins, offsets = packing.best_fit([5, 4, 5, 1, 6, 3], 10)
    assert (bins, offsets) == ([0, 0, 1, 0, 2, 2], [0, 5, 0, 9, 0, 6])
    closed, _ = packing.best_fit([6, 5, 4, 4], 10, open_bins=1)
    assert closed == [0, 1, 1, 2]  # the bin with 6 is the fullest and closes
    r = random.Random(1)
    for k in (1, 3, 100):
        lengths = [r.randint(1, 20) for _ in range(400)]
        bins, offsets = packing.best_fit(lengths, 20, k)
        fill = {}
        for b, o, n in zip(bins, offsets, lengths, strict=True):
            assert fill.get(b, 0) == o
            fill[b] = o + n
        assert max(fill.values()) <= 20


def test_pack_awkward_documents(spark, tokenizer_path):
    texts = [*AWKWARD, words(3000, 1), words(3000, 1), words(10, 2)]
    docs = docs_of(spark, texts).unionByName(spark.createDataFrame([(None, "no id", "en", "s", 5)], SCHEMA)).withColumn("length", F.lit("clash"))
    from tokenizers import Tokenizer

    pieces = packing.token_pieces(docs, tokenizer_path).withColumn("offset", F.lit("clash")).withColumn("sequence_id", F.lit("clash"))
    rows = packing.pack(pieces).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    tokenizer = Tokenizer.from_file(tokenizer_path)
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [p.start for p in pieces] == list(range(0, len(ids) // 4, 2048))
        assert sum(p.length for p in pieces) == len(ids) // 4
        assert [p.ids_crc32 for p in pieces] == [zlib.crc32(ids[k : k + 8192]) for k in range(0, len(ids), 8192)]
    assert len(by_doc[None]) == 1
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-sum(r.length for r in rows) // 2048) + 2
    assert packing.pack(packing.token_pieces(docs.limit(0), tokenizer_path)).count() == 0


# ---- quality -----------------------------------------------------------------------------------------------------


def test_quality_separates_and_handles_awkward_rows(spark):
    good = [words(80, i) for i in range(120)]
    bad = [" ".join(f"{w}%%%" for w in words(80, 1000 + i).split()) for i in range(120)]
    docs = docs_of(spark, [*good, *bad, *AWKWARD]).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i < 120)) for i in range(240)] + [(None, 1), (5, None), (7, 1)], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels)
    out = {r.doc_id: r for r in quality.score_quality(docs, model).collect()}
    assert len(out) == 240 + len(AWKWARD) and all(0 <= r.score <= 1 for r in out.values())
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([out[i].predicted == int(i < 120) for i in held]) > 0.95
    assert {r.predicted for r in out.values()} == {0, 1}
    assert out[240].score == out[241].score  # null counts as empty


def test_scores_equal_the_sizes_by_definition(spark):
    import zstandard

    docs = docs_of(spark, [*[words(80, i) for i in range(60)], *[words(80, i).upper() for i in range(60)], "", "x" * 5000])
    model = quality.fit_quality(docs, spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, quality int"))
    out = {r.doc_id: r for r in quality.score_quality(docs, model).collect()}
    for i, text in enumerate([words(80, 0), words(80, 1)]):
        raw, sizes = text.encode(), []
        for d in (model.good, model.bad):
            c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False)
            sizes.append(sum(len(c.compress(raw[k : k + 512])) for k in range(0, len(raw), 512)))
        w, evidence = model.weights, len(raw) / (len(raw) + quality.HALF_BYTES)
        z = model.prior + w[0] * evidence + w[1] * evidence * (sizes[1] - sizes[0]) / len(raw)
        assert abs(out[i].score - 1 / (1 + np.exp(-z))) < 0.02
    assert abs(out[120].score - 1 / (1 + np.exp(-model.prior))) < 1e-9  # no evidence: the share of good labels
    learnt = [i < 60 for i in range(120) if zlib.crc32(str(i).encode()) % 5]
    assert abs(out[120].score - (sum(learnt) + 0.5) / (len(learnt) + 1)) < 1e-9
    assert all(r.predicted == int(r.score >= 0.3) for r in out.values())
    assert sum(map(len, quality._pieces("y" * 10**6))) <= 8 * 4096 and b"".join(quality._pieces("ab" * 9000)) == b"ab" * 9000


def test_the_base_rate_is_that_of_all_labels(spark):
    docs = docs_of(spark, [*[words(60, i) for i in range(300)], *[words(60, i).upper() for i in range(30)], ""])
    model = quality.fit_quality(docs, spark.createDataFrame([(i, int(i < 300)) for i in range(330)], "doc_id long, quality int"), max_rows=20)
    learnt = [i < 300 for i in range(330) if zlib.crc32(str(i).encode()) % 5]
    score = {r.doc_id: r.score for r in quality.score_quality(docs, model).collect()}
    assert abs(score[330] - (sum(learnt) + 0.5) / (len(learnt) + 1)) < 1e-9
    assert np.mean([score[i] for i in range(300)]) > score[330] > np.mean([score[i] for i in range(300, 330)])


def test_quality_without_labels(spark):
    docs = docs_of(spark, ["a b", None])
    model = quality.fit_quality(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality.score_quality(docs, model).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), model).count() == 0


def test_quality_never_learns_from_held_out_rows(spark):
    docs = docs_of(spark, [words(30, i) for i in range(60)])
    labels = [(i, i % 2) for i in range(60)]
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    one, two = (quality.fit_quality(docs, spark.createDataFrame(x, "doc_id long, quality int")) for x in (labels, flipped))
    assert one == two


# ---- language ----------------------------------------------------------------------------------------------------


def test_language_accuracy_and_und(spark):
    vocab = {"aa": ("the", "and", "thing", "there"), "bb": ("ich", "und", "nicht", "schön"), "cc": ("que", "ñoño", "los", "ción")}
    texts, langs = [], []
    for k in range(90):
        lang = sorted(vocab)[k % 3]
        texts.append(" ".join(random.Random(k).choices(vocab[lang], k=40)))
        langs.append(lang)
    docs = docs_of(spark, [*texts, None, "", "123 !?", "---", "The"], [*langs, "aa", "aa", None, "bb", None]).withColumn("rejected", F.lit(1))
    model = langid.fit_language(docs)
    out = {r.doc_id: r for r in langid.predict_language(docs, model).collect()}
    assert np.mean([out[i].lang_pred == langs[i] for i in range(90)]) > 0.97
    assert [out[i].lang_pred for i in range(90, 94)] == ["und"] * 4 and out[94].lang_pred in vocab
    assert all(0 <= r.score <= 1 for r in out.values()) and out[90].rejected
    for sign in ("½", "²", "①", "Ⅷ", "١٢", "́"):
        assert not langid.HAS_LETTER.search(sign)
    assert all(langid.HAS_LETTER.search(x) for x in ("ß", "あ", "ª", "12 x"))
    none = langid.fit_language(docs.limit(0))
    assert {r.lang_pred for r in langid.predict_language(docs, none).collect()} == {"und"}


def test_a_rare_language_is_learnt_and_scores_equal_brute_force(spark):
    vocab = {"aa": ("the", "and", "thing", "there"), "bb": ("ich", "und", "nicht", "schön")}
    texts = [" ".join(random.Random(k).choices(vocab["bb" if k % 50 == 0 else "aa"], k=40)) for k in range(1000)]
    langs = ["bb" if k % 50 == 0 else "aa" for k in range(1000)]
    docs = docs_of(spark, texts, langs)
    model = langid.fit_language(docs.union(docs.where("doc_id = 1")), max_rows=60)
    out = {r.doc_id: r for r in langid.predict_language(docs, model).collect()}
    assert all(out[i].lang_pred == langs[i] for i in range(1000))

    def plain(text):
        raw = b" " + b" ".join("".join(c if c.isalpha() else " " for c in text.lower()).encode().split()) + b" "
        logits, total = [0.0] * len(model.langs), 0
        for n in langid.SIZES:
            for i in range(len(raw) - n + 1):
                h = n
                for byte in raw[i : i + n]:
                    h = ((h ^ byte) * 0x01000193) % 2**32
                    h ^= h >> 15
                total += 1
                logits = [z + float(w) for z, w in zip(logits, model.table[h % langid.BUCKETS], strict=True)]
        z = [(v / total + float(b)) / model.temperature for v, b in zip(logits, model.bias, strict=True)]
        return max(np.exp(v) for v in z) / sum(np.exp(v) for v in z)

    for i in (0, 1, 50, 77):
        assert abs(out[i].score - plain(texts[i])) < 1e-6


# ---- outliers ----------------------------------------------------------------------------------------------------


def brute_counts(text):
    import re

    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    hit = {k for i, r in enumerate(runs) if runs.count(r) > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_counts_equal_brute_force():
    r = random.Random(3)
    texts = [*[t for t in AWKWARD], *("".join(r.choice("ab #é\n\t|") for _ in range(r.randrange(200))) for _ in range(200))]
    for t in texts:
        assert outliers.text_counts(t, WordHashes())[:5] == brute_counts(t), t


def test_outliers_reject_odd_rows_only(spark):
    clean = [words(random.Random(i).randint(60, 200), i) for i in range(200)]
    odd = [" ".join(f"{w}#$%" for w in words(100, 900 + i).split()) for i in range(5)]
    docs = docs_of(spark, [*clean, *odd, *AWKWARD], ["en"] * 100 + [None] * 115).withColumn("kept", F.lit(0))
    out = {r.doc_id: r for r in outliers.judge(docs).collect()}
    assert len(out) == 215
    assert all(out[i].kept for i in range(200)) and not any(out[i].kept for i in range(200, 205))
    assert all(out[i].base_failed and not out[i].kept for i in range(205, 215))
    few = outliers.judge(docs_of(spark, [words(80, 1), None])).orderBy("doc_id").collect()
    assert [r.kept for r in few] == [True, False] and few[0].distance is None
    assert outliers.judge(docs.limit(0)).count() == 0


def test_shapes_equal_a_plain_search(spark):
    r = np.random.default_rng(12)
    groups = {}
    for k, n in (("a", 400), ("b", 150), ("c", 60)):
        mix = r.normal(size=(5, 5)) + 2 * np.eye(5)
        x = r.normal(size=(n, 5)) @ mix + 5
        x[: n // 10] += 60  # a tenth lies far off
        groups[k] = x
    rows = [(k, *map(float, v)) for k, x in groups.items() for v in x]
    shapes, few = outliers.robust_shapes(spark.createDataFrame(rows, "grp string, x0 double, x1 double, x2 double, x3 double, x4 double"))
    assert few
    got = {s.grp: s for s in shapes.collect()}

    def solve(x, share):
        c, v, size = outliers.solve(np.array([float(len(x))]), x.sum(0)[None], (x.T @ x)[None], share)
        return c[0], v[0], size[0]

    distance = lambda x, c, v: np.einsum("ni,ij,nj->n", x - c, v, x - c)
    for k, x in groups.items():
        best = None
        for trial in range(60):  # many random starts, exact quantiles, until nothing moves
            c, v, size = solve(x[r.choice(len(x), 12, replace=False)], 1.0) if trial else solve(x, 1.0)
            for _ in range(200):
                d = distance(x, c, v)
                c, v, new = solve(x[d <= np.sort(d)[int(np.ceil(0.75 * len(x))) - 1]], 0.75)
                if new >= size - 1e-9:
                    break
                size = new
            best = min(best or (np.inf,), (size, trial, c, v), key=lambda b: b[0])
        d = distance(x, best[2], best[3])
        c, v, _ = solve(x[d <= outliers.chi2_quantile(0.975, 5)], 0.975)
        s = got[k]
        mine = distance(x, np.array([s[f"c{i}"] for i in range(5)]), np.array([[s[f"v{i}{j}"] for j in range(5)] for i in range(5)]))
        plain = distance(x, c, v)
        far = outliers.chi2_quantile(0.999, 5)
        assert (mine[: len(x) // 10] > far).all() and (mine[len(x) // 10 :] < 3 * far).all()
        assert np.corrcoef(np.log(mine), np.log(plain))[0, 1] > 0.98 and np.mean((mine > far) != (plain > far)) < 0.03


def test_copies_of_a_text_do_not_reject_others(spark):
    clean = [words(round(60 * 30 ** (i / 59)), i) for i in range(60)]
    odd = [" ".join(f"{w}#$%" for w in words(100, 900 + i).split()) for i in range(2)]
    few = [words(80, 500 + i) for i in range(3)]
    one, other = (spark.createDataFrame([(start + i, t, lang, "web") for i, t in enumerate(ts)], "doc_id long, text string, lang string, source string") for start, lang, ts in ((0, "en", [*clean, *odd, *[words(90, 7000)] * 248]), (1000, "de", [*[few[0]] * 60, *few])))
    out = {r.doc_id: r for r in outliers.judge(one.unionByName(other)).collect()}
    assert len(out) == 373
    assert all(out[i].kept for i in [*range(60), *range(62, 310)]) and not any(out[i].kept for i in (60, 61))
    assert all(out[1000 + i].kept for i in range(63))
    assert out[1000].distance is None


def test_chi_square():
    assert abs(outliers.chi2_cdf(11.070497693516351, 5) - 0.95) < 1e-9
    assert abs(outliers.chi2_quantile(0.95, 5) - 11.070497693516351) < 1e-6


# ---- decontamination ---------------------------------------------------------------------------------------------


def brute_hits(text, items, window=10):
    ws, hit, found = decontam.words_of(text), set(), set()
    for item, t in items:
        iw = decontam.words_of(t)
        n = min(window, len(iw))
        for i in range(len(iw) - n + 1) if n else ():
            for j in range(len(ws) - n + 1):
                if ws[j : j + n] == iw[i : i + n]:
                    hit |= set(range(j, j + n))
                    found.add(item)
    return len(ws), len(hit), sorted(str(i) for i in found if i is not None) + [None] * (None in found)


@pytest.mark.parametrize("bound", [10**9, 60])
def test_hits_equal_brute_force(spark, bound):
    bench = [(1, words(25, 5)), (2, "Short item-here"), (3, None), (4, "..."), (None, "ghost words here"), (10, words(12, 6)), (2, "twice used id"), (11, words(25, 5))]
    texts = [*AWKWARD, "pre " + words(25, 5).upper() + " post", "a short ITEM, here", words(200, 7) + " " + " ".join(words(25, 5).split()[4:15]), words(12, 6) + "\n" + words(12, 6), "twice used id short item here", "ghost words here and a short item here"]
    docs = docs_of(spark, [*texts, texts[-1]]).withColumn("n_words", F.lit("clash")).withColumn("at", F.lit("clash"))
    bench = spark.createDataFrame(bench, "item_id long, text string")
    out = decontam.benchmark_hits(docs, bench, broadcast_chars=bound).collect()
    known = [(r.item_id, r.text) for r in bench.where("text is not null").collect()]
    assert len(out) == len(texts) + 1
    for r in out:
        t = [*texts, texts[-1]][r.doc_id]
        assert (r.n_words, sum(s.end - s.first for s in r.hit_spans), list(r.item_ids)) == brute_hits(t, known), t
    assert decontam.benchmark_hits(docs.limit(0), bench, broadcast_chars=bound).count() == 0


def test_a_window_that_many_items_share_is_met_once(spark):
    shared = " ".join(f"t{i}" for i in range(10))
    bench = spark.createDataFrame([(i, f"{shared} own{i} word{i}") for i in range(200)], "item_id long, text string")
    docs = docs_of(spark, [f"start {shared} {shared} end {i}" for i in range(30)] + ["nothing here"])
    rows = docs.select(F.col("doc_id").alias("row"), "text")
    windows = decontam.benchmark_windows(bench, 10).cache()
    candidates = decontam._candidates(rows, {"row": "long"}, windows)
    met = decontam._met(candidates, windows)
    assert met.count() == 60  # occurrences, not occurrences times items
    assert decontam._items_of(met, windows).count() == 30 * 200
    for bound in (10**6, 0):
        out = {r.doc_id: r for r in decontam.benchmark_hits(docs, bench, broadcast_chars=bound).collect()}
        assert all(len(out[i].item_ids) == 200 and [(s.first, s.end) for s in out[i].hit_spans] == [(1, 21)] for i in range(30)) and out[30].item_ids == []


def test_drop_contaminated(spark):
    bench = spark.createDataFrame([(1, words(25, 5))], "item_id long, text string")
    docs = docs_of(spark, [words(50, 9), words(25, 5), None, "", words(25, 5) + " more"]).withColumn("h", F.lit("clash"))
    docs = docs.union(docs.where("doc_id in (0, 1)"))
    for chars in (10**9, 10):
        out = decontam.drop_contaminated(docs, bench.union(bench.selectExpr("2", "'no such words'")), broadcast_chars=chars)
        assert sorted(r.doc_id for r in out.collect()) == [0, 0, 2, 3] and out.columns == docs.columns
    assert decontam.drop_contaminated(docs.limit(0), bench.limit(0)).count() == 0


# ---- lines -------------------------------------------------------------------------------------------------------


def test_line_dedup_awkward_rows(spark):
    texts = ["Keep me please one\nshared line 123\n shared LINE 123\t\ntail", "shared line 123\nown long line here", "short\nshort", "short", None, "", "shared line 123", "\n\nshared line 123\n"]
    docs = docs_of(spark, texts, start=1).unionByName(spark.createDataFrame([(None, "shared line 123", "en", "s", 1)], SCHEMA)).withColumn("n_lines", F.lit("clash")).withColumn("h1", F.lit(1))
    out = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in linededup.dedup_lines(docs).collect()}
    assert out[1] == ("Keep me please one\nshared line 123\n shared LINE 123\t\ntail", 4, 0)
    assert out[2] == ("own long line here", 2, 1)
    assert out[3] == ("short\nshort", 2, 0) and out[4] == ("short", 1, 0)
    assert out[5] == ("", 1, 0) and out[6] == ("", 1, 0)
    assert out[7] == ("", 1, 1) and out[8] == ("\n\n", 4, 1)
    assert out[None] == ("shared line 123", 1, 0)
    assert linededup.dedup_lines(docs.limit(0)).count() == 0
    three = {r.doc_id: r.n_dropped for r in linededup.dedup_lines(docs, min_docs=5).collect()}
    assert three[2] == 0


def test_line_dedup_equals_brute_force(spark):
    r = random.Random(9)
    pool = ["shared line %d" % i for i in range(12)] + ["", "short", "\t Shared LINE 3 ", "größere zeile Ä", "GRÖSSERE zeile Ä", "größere ZEILE Ä"]
    texts = [*AWKWARD, *("\n".join(r.choices(pool, k=r.randrange(1, 30))) for _ in range(60))]
    texts += [texts[-1], texts[-1]]
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    split = [(t or "").split("\n") for t in texts]
    held = {}
    for d, lines in enumerate(split):
        for x in lines:
            held.setdefault(x.strip(" \t\n\x0b\x0c\r").translate(lower), set()).add(d)
    for least in (2, 3):
        gone = lambda d, x: len(k := x.strip(" \t\n\x0b\x0c\r").translate(lower)) >= 10 and len(held[k]) >= least and min(held[k]) < d  # noqa: B023, E731
        out = {x.doc_id: (x.text, x.n_lines, x.n_dropped) for x in linededup.dedup_lines(docs_of(spark, texts), min_docs=least).collect()}
        for d, lines in enumerate(split):
            kept = [x for x in lines if not gone(d, x)]
            assert out[d] == ("\n".join(kept), len(lines), len(lines) - len(kept)), d


def test_line_dedup_of_very_many_lines(spark):
    line = "one and the same line"
    rows = [(1, line), (2, "\n".join([line] * 200_000)), (3, "\n".join(f"a line of its own {i}" for i in range(100_000))), (3, "tail\n" + line), (3, "tail\n" + line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(spark.createDataFrame([(4, rows[2][1])], "doc_id long, text string"))
    out = sorted((x.doc_id, x.n_lines, x.n_dropped, len(x.text)) for x in linededup.dedup_lines(docs).collect())
    assert out == [(1, 1, 0, len(line)), (2, 200_000, 200_000, 0), (3, 2, 1, 4), (3, 2, 1, 4), (3, 100_000, 0, len(rows[2][1])), (4, 100_000, 100_000, 0)]


# ---- sharding ----------------------------------------------------------------------------------------------------


def test_shards_are_contiguous_and_balanced(spark):
    r = random.Random(2)
    texts = [*AWKWARD[:7], *["é" * r.randrange(0, 300) for _ in range(500)]]
    docs = docs_of(spark, texts).unionByName(docs_of(spark, ["dup", "dup"], start=5).limit(1)).unionByName(spark.createDataFrame([(None, "x", "en", "s", 1)], SCHEMA)).withColumn("size", F.lit(0)).withColumn("shard", F.lit("clash"))
    out = sharding.shard_by_bytes(docs).collect()
    assert len(out) == len(texts) + 2
    ordered = sorted(out, key=lambda x: (x.shard, x.slot))
    assert [x.doc_id if x.doc_id is not None else -1 for x in ordered] == sorted(x.doc_id if x.doc_id is not None else -1 for x in out)
    sizes = {}
    for x in ordered:
        assert x.slot == len(sizes.setdefault(x.shard, []))
        sizes[x.shard].append(x.size)
        if x.doc_id is not None and x.doc_id != 5:
            raw = (texts[x.doc_id] or "").encode()
            assert (x.size, x.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    total = [sum(v) for v in sizes.values()]
    assert sorted(sizes) == list(range(8)) and max(total) - min(total) <= 2 * max(map(max, sizes.values()))
    assert sharding.shard_by_bytes(docs.limit(0)).count() == 0


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (None, 3)] + [(500, k) for k in range(501, 540)]
    out = {r.id: r.component_id for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {out[i] for i in range(41)} == {0} and {out[i] for i in (100, 101, 102)} == {100} and {out[i] for i in range(500, 540)} == {500}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_kept_text_digest(spark):
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit(""), 256)).first()[0]
