"""Near duplicates, HTML, WARC and the pipeline on small awkward tables."""

import base64
import hashlib
import json
import math
import random
import re
import time
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairgrid.llm import html_extract, setsketch, warc
from fairgrid.llm.common import WordHashes

from .test_text_operators import AWKWARD, SCHEMA, docs_of, words


def brute_components(texts, n):
    def shingles(t):
        w = (t or "").encode().lower().split()
        k = min(n, len(w))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()

    sets, part = [shingles(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = part[i], part[j]
                part = [min(x, y) if p in (x, y) else p for p in part]
    return [len(s) for s in sets], part


@pytest.mark.parametrize("n", [2, 5])
def test_groups_equal_brute_force(spark, n):
    r = random.Random(4)
    texts = list(AWKWARD)
    for g in range(12):
        base = words(r.choice([6, 60, 150]), g).split()
        for _ in range(r.randrange(1, 8)):
            copy = list(base)
            for _ in range(r.randrange(0, max(1, len(base) // 12))):
                copy[r.randrange(len(copy))] = f"new{r.randrange(1000)}"
            texts.append(" ".join(copy))
    shared = words(60, 77)
    texts += [shared + " " + words(30, 300 + k) for k in range(40)]  # one passage in many documents, no near copies
    texts += [texts[12].upper(), texts[12], texts[12]]
    sizes, part = brute_components(texts, n)
    docs = docs_of(spark, texts).unionByName(spark.createDataFrame([(None, texts[12], "en", "s", 1)], SCHEMA)).withColumn("sketch", F.lit(0)).withColumn("bucket", F.lit("clash"))
    out = {x.doc_id: x for x in setsketch.near_duplicate_groups(docs, shingle_words=n).collect()}
    assert [out[i].n_shingles for i in range(len(texts))] == sizes
    assert [out[i].component_id for i in range(len(texts))] == part
    assert out[None].component_id is None
    assert setsketch.near_duplicate_groups(docs.limit(0)).count() == 0


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", 8)
    r, base, texts = random.Random(6), words(100, 1).split(), []
    for _ in range(60):
        copy = list(base)
        for _ in range(r.randrange(2, 16)):
            copy[r.randrange(len(copy))] = f"new{r.randrange(10000)}"
        texts.append(" ".join(copy))
    _, part = brute_components(texts, 2)
    out = {x.doc_id: x.component_id for x in setsketch.near_duplicate_groups(docs_of(spark, texts)).collect()}
    assert [out[i] for i in range(len(texts))] == part


def test_planted_links_pass_bands_and_estimate():
    r = np.random.default_rng(8)
    missed = met = 0
    for size in (20, 90, 400):
        for _ in range(150):
            a = np.unique(r.integers(0, 2**63, size).astype(np.uint64))
            cut = len(a) // 9  # shared 8 of 9, so the similarity is 8 / 10
            b = np.concatenate([a[cut:], r.integers(0, 2**63, cut).astype(np.uint64)])
            low = (setsketch.registers([a, b]) & 255).astype(np.uint8)
            n = np.array([float(len(a))])
            bands = low.reshape(2, setsketch.BANDS, setsketch.ROWS)
            met += 1
            missed += not (bands[0] == bands[1]).all(1).any() or not setsketch.not_ruled_out(n, n, low[:1], low[1:])[0]
    assert met == 450 and missed == 0


def test_ids_with_several_texts_have_the_links_of_each(spark):
    one, two, other = words(60, 1), words(60, 2), words(60, 3)
    rows = [(5, one), (5, two), (5, two), (1, one), (9, two), (9, two), (7, other), (8, None), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("clash")).withColumn("leader", F.lit(0))
    out = {(r.doc_id, r.component_id) for r in setsketch.near_duplicate_groups(docs).collect()}
    assert out == {(5, 1), (1, 1), (9, 1), (7, 7), (8, 8)}


def test_register_laws():
    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 2**63, 3000).astype(np.uint64))
    b = np.concatenate([a[:2000], r.integers(0, 2**63, 1000).astype(np.uint64)])
    ra, rb, both, one = setsketch.registers([a, b, np.unique(np.concatenate([a, b])), a[:1]])
    assert (np.maximum(ra, rb) == both).all() and (np.maximum(ra, one) == ra).all()
    kept = setsketch.stored(np.array([ra, rb, both, one]))
    assert (setsketch.loaded(kept) == np.array([ra, rb, both, one])).all()
    assert setsketch.merged(kept[:2]) == kept[2] and setsketch.merged([kept[3], kept[0]]) == kept[0]
    as_bytes = lambda x: (x & 255).astype(np.uint8)[None, :]
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    n = np.array([3000.0])
    assert abs(setsketch.estimate(n, n, as_bytes(ra), as_bytes(rb))[0] - true) < 0.1
    assert not setsketch.not_ruled_out(n, n, as_bytes(ra), as_bytes(rb))[0] and setsketch.not_ruled_out(n, n, as_bytes(ra), as_bytes(ra))[0]
    assert len(setsketch.shingle_set("A b", 5, WordHashes())) == 1 and len(setsketch.shingle_set(" \t", 5, WordHashes())) == 0


PAGE = """<!doctype html><html><head><title>T</title><script>var t="</p>";</script><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<main><article><h1>Title &amp; more</h1><p>First <b>bold</b>
 text&#33;<p>Second<br>line<ul><li>One<li>Two</ul><aside>Side</aside><form><p>Mail</p></form><div class="ad">Buy</div><!-- gone --><p>Third</p>
<footer>tags</footer></article><section id="comments"><article>Nice and very long comment by a reader, longer than all the rest of the article together, really long</article></section></main>
<aside class="sidebar">Related</aside><footer>&copy; 2020</footer></body></html>"""


def test_extract_one_page():
    assert html_extract.extract(PAGE) == "Title & more\nFirst bold text!\nSecond line\nOne\nTwo\nThird"
    assert html_extract.extract(None) == "" and html_extract.extract("") == ""
    assert html_extract.extract("plain text, no tags") == "plain text, no tags"
    assert html_extract.extract("<div class=sidebar><p>only this</p></div>") == "only this"
    assert html_extract.extract("<p>a < b & c <i>d</i></p><p>e") == "a < b & c d\ne"
    assert html_extract.extract("<div><p>x</p></div>" * 3000).count("\n") == 2999
    assert html_extract.extract("<div>" * 5000 + "deep") == "deep"
    assert html_extract.extract("<table><tr><td>1<td>2<tr><td>3</table>") == "1\n2\n3"
    assert html_extract.extract('<p title="a>b">q</p><script>x</script') == "q"


def test_clean_contract_cases():
    e = html_extract.extract
    assert e("<body><main><h1>Title</h1><article><p>Body text</p></article><p>After</p></main><footer>f</footer></body>") == "Title\nBody text\nAfter"
    assert e("<article><p>One and more</p></article><article><p>Two</p></article>") == "One and more\nTwo"
    assert e("<main><article><p>Text</p></article><article><a href=x>Another story</a></article></main>") == "Text"
    assert e('<main><div class="share-price"><p>It rose</p></div><div class="share-buttons">Tweet</div><p>End</p></main>') == "It rose\nEnd"
    long = " ".join(f"word{i}" for i in range(40))
    assert e(f'<article><section id="legal"><p>{long}</p></section><div class="notice">We changed our terms</div><p>End</p></article>') == f"{long}\nEnd"
    assert e('<article><p>Text</p><div class="post-comments"><article>Nice</article></div><div class="ad-slot-2">Buy</div></article>') == "Text"
    assert e('<body class="layout-with-sidebar"><div id="content"><p>Plain page text</p></div><div class="widget">x</div></body>') == "Plain page text"
    assert e("<p>&lt;b&gt; &#x41;&#66; &nbsp;&nbsp;c&copy</p>") == "<b> AB c©"


@pytest.mark.parametrize("piece", ['<a "', "<p <", "<a '", "<b>", "</i><b>", "<div>", "<div></section>", "<b></i>", '<a ">" ', "<!--", "<p><b>", "<script>", "<li>", "<", "<p ", "<i><div></i>", "<ul><li>", "a=' "])
@pytest.mark.parametrize("tree", [False, True])
def test_broken_pages_take_linear_time(piece, tree):
    began = time.monotonic()
    html_extract.Page(piece * (300_000 // len(piece)), tree=tree)
    assert time.monotonic() - began < 20
    if not tree:
        html_extract.extract("<p " + "a=' " * 100_000 + ">")
        assert time.monotonic() - began < 25


def branch(path):
    at = 0
    for style in path.split("/")[1:]:
        at = html_extract.branch_id(at, style)
    return at


@pytest.mark.parametrize("bound", [10**6, -1])
def test_style_tree_drops_what_a_site_repeats(spark, monkeypatch, bound):
    monkeypatch.setattr(html_extract, "BROADCAST_BRANCHES", bound)
    page = "<html><body><div class=strip>Read our other sites</div><div class=story><p>{}</p></div></body></html>"
    rows = [(i, f"http://Host.example/{i}", page.format(words(20, i))) for i in range(12)]
    rows += [(50, None, None), (51, "bad url", ""), (52, "http://[x", "<p>y</p>"), (53, "http://other.example/", page.format("once only"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("branch", F.lit("clash"))
    out = {r.page_id: r.text for r in html_extract.extract_main_text(pages).collect()}
    assert all(out[i] == words(20, i) for i in range(12))
    assert (out[50], out[51], out[52], out[53]) == ("", "", "y", "Read our other sites\nonce only")
    weak = {r.branch for r in html_extract.style_tree(pages).where("importance < 0.2").collect()}
    assert branch("/html/body/div.strip") in weak and branch("/html/body/div.story") not in weak
    assert html_extract.extract_main_text(pages.limit(0)).count() == 0


def test_importance_equals_plain_entropy(spark):
    r = random.Random(3)
    shown = [(r.choice(["a", "b"]), r.randrange(3), words(5, i // 2)) for i in range(30)]
    html = [f"<html><body><div class=top>{x}</div><div class=list>{'<p>same</p>' * k}</div><div class=story><p>{t}</p></div></body></html>" for x, k, t in shown]
    pages = spark.createDataFrame([(i, "http://h/", x) for i, x in enumerate(html)], "page_id long, url string, html string")
    got = {x.branch: (x.pages, x.seen, x.importance) for x in html_extract.style_tree(pages, 2).collect()}
    distinct = sorted(set(html))
    kept = [shown[html.index(x)] for x in distinct]

    def importance(values):
        n = len(values)
        return sum(-values.count(v) / n * math.log(values.count(v) / n) for v in set(values)) / math.log(n)

    expected = {"/html/body/div.top": [x for x, _, _ in kept], "/html/body/div.list": [k for _, k, _ in kept], "/html/body/div.story": [t for *_, t in kept], "/html/body": kept}
    for path, values in expected.items():
        assert got[branch(path)][0] == len(kept) and abs(got[branch(path)][1] - importance(values)) < 1e-9, path
    with_p = [k for _, k, _ in kept if k]
    pages_of_p, seen, weighed = got[branch("/html/body/div.list/p")]
    assert pages_of_p == len(with_p) and abs(seen - importance(with_p)) < 1e-9
    assert abs(weighed - (seen * pages_of_p + html_extract.PRIOR_PAGES) / (pages_of_p + html_extract.PRIOR_PAGES)) < 1e-9
    assert got[branch("/html/body/div.top")][1] == got[branch("/html/body/div.top")][2]


def test_a_branch_that_few_pages_fill_stays_there(spark):
    page = "<html><body><div class=box><p>Usual words here</p>{}</div><div class=story>{}</div></body></html>"
    rows = [(i, f"http://h/{i}", page.format(f"<div class=extra>{words(9, 900 + i)}</div>" if i % 15 == 0 else "", words(20, i))) for i in range(90)]
    out = [x.text for x in html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]
    assert out == [(words(9, 900 + i) + "\n" if i % 15 == 0 else "") + words(20, i) for i in range(90)]


def test_copies_of_a_page_do_not_erase_its_text(spark):
    page = "<html><body><div class=strip>{}</div><article><h1>{}</h1><h2>{}</h2><p>{}</p><div class=plug>Written for you</div></article></body></html>"
    equal = [("equal", page.format("same", "Title", "Part", "One text"))] * 8
    mixed = [("mixed", page.format("same", "Copied", "Part", "One text"))] * 85 + [("mixed", page.format("same", f"T{i}", f"H{i}", words(20, i))) for i in range(15)]
    menus = [("menus", page.format(f"menu {i}", "Copied", "Part", "One text")) for i in range(40)] + [("menus", page.format("menu", f"T{i}", f"H{i}", words(20, i))) for i in range(4)]
    large = [("large", page.format("same", f"T{i}", f"H{i % 3}", words(20, i))) for i in range(300)]
    rows = [(i, f"http://{host}.example/{i}", html) for i, (host, html) in enumerate([*equal, *mixed, *menus, *large])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    out = [r.text for r in html_extract.extract_main_text(pages).orderBy("page_id").collect()]
    assert set(out[:8]) == {"Title\nPart\nOne text\nWritten for you"}
    assert set(out[8:93]) == {"Copied\nPart\nOne text"}
    assert out[93:108] == [f"T{i}\nH{i}\n{words(20, i)}" for i in range(15)]
    assert set(out[108:148]) == {"Copied\nPart\nOne text"}
    assert out[148:152] == [f"T{i}\nH{i}\n{words(20, i)}" for i in range(4)]
    assert out[152:] == [f"T{i}\nH{i % 3}\n{words(20, i)}" for i in range(300)]
    counted = {(r.host, r.branch): r.pages for r in html_extract.style_tree(pages, 2).collect()}
    assert counted["mixed.example", branch("/html/body")] == 16 and counted["menus.example", branch("/html/body/article/p")] == 5 and ("equal.example", branch("/html/body")) not in counted


@pytest.mark.parametrize("bound", [10**6, -1])
def test_the_tree_alone_finds_the_text_of_given_pages(spark, monkeypatch, bound):
    """All telling elements and names replaced by neutral ones: on sites with enough pages the tree leaves what the elements leave."""
    monkeypatch.setattr(html_extract, "BROADCAST_BRANCHES", bound)
    monkeypatch.setattr(html_extract, "PART_PAGES", 50)
    given = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").withColumn("host", html_extract.host_of(F.col("url")))
    large = given.groupBy("host").count().where("count >= 40").select("host")
    given = given.join(large, "host").select("page_id", "url", "html")
    neutral = F.col("html")
    for tag, name in (("article", "k1"), ("nav", "k2"), ("footer", "k3")):
        neutral = F.regexp_replace(F.regexp_replace(neutral, f"<{tag}>", f'<div class="{name}">'), f"</{tag}>", "</div>")
    hidden = given.withColumn("html", F.regexp_replace(neutral, 'class="ad"', 'class="k4"'))
    want = {r.page_id: html_extract.extract(r.html) for r in given.collect()}
    got = {r.page_id: r.text for r in html_extract.extract_main_text(hidden).collect()}
    assert len(want) > 1000 and got == want
    assert {r.page_id: r.text for r in html_extract.extract_main_text(given).collect()} == want


def test_a_noisy_branch_goes_whole_but_for_what_varies_below_it(spark):
    page = "<html><body><div class=frame><div class=menu><span>Home and more</span><div class=rare{r}>Seldom seen</div></div><div class=story>{t}</div></div><div class=pad><div class=note>One of {k} lines</div><div class=lead>{u}</div></div></body></html>"
    rows = [(i, f"http://h/{i}", page.format(r=i if i % 9 == 0 else "", t=words(20, i), k=i % 3, u=words(9, 500 + i))) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = [x.text for x in html_extract.extract_main_text(pages).orderBy("page_id").collect()]
    # a branch with too few pages of its own follows the menu that it is in
    assert out == [f"{words(20, i)}\n{words(9, 500 + i)}" for i in range(60)]
    told = html_extract.judged_branches(html_extract.style_tree(pages)).first()
    assert branch("/html/body/div.frame/div.menu") in told.noise and branch("/html/body/div.frame") not in told.noise


def test_copies_of_a_story_under_changing_menus_keep_their_text(spark):
    page = "<html><body><div class=strip>menu {}</div><div class=story><h1>{}</h1><p>{}</p></div></body></html>"
    rows = [(i, "http://h/", page.format(i, "Copied", words(60, 1))) for i in range(40)] + [(40 + i, "http://h/", page.format(i % 4, f"T{i}", words(60, 100 + i))) for i in range(20)]
    out = [x.text for x in html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]
    assert out == ["Copied\n" + words(60, 1)] * 40 + [f"T{i}\n{words(60, 100 + i)}" for i in range(20)]


def records_of(raw):
    """(headers, block) of every record of a .warc.gz file, by the format's definition alone."""
    out = []
    while raw:
        member = zlib.decompressobj(31)
        plain, raw = member.decompress(raw), member.unused_data
        version, rest = plain.split(b"\r\n", 1)
        assert version == b"WARC/1.1"
        head, rest = rest.split(b"\r\n\r\n", 1)
        headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n"))
        n = int(headers["Content-Length"])
        assert rest[n:] == b"\r\n\r\n"
        out.append((headers, rest[:n]))
    return out


@pytest.mark.parametrize("bound", [10**6, 0])
def test_warc_round_trip(spark, monkeypatch, bound):
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", bound)
    same, other = "<p>" + "s" * 2000 + "é</p>", "o" * 1500
    rows = [(1, "http://www.a.example/x?q=1", same), (2, "http://a.example/x?q=1", same), (9, "https://b.a.example:8080/", same), (3, None, None), (4, "", ""), (5, "http://[bad", "tiny"), (6, "http://c/", "tiny"), (7, "line\nfeed: x", other), (7, "line\nfeed: x", other), (None, "http://n/", same), (8, "http://long/ü", "long\r\n\r\n" * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit(1)).withColumn("payload", F.lit("clash"))
    archive, keys = warc.write_archive(pages, file_bytes=600)
    folder = Path(archive.folder.removeprefix("file://"))
    manifest = json.loads((folder / "archive.json").read_text())
    assert set(manifest["record_files"]) == {f.name for f in folder.glob("*.warc.gz")} and [tuple(x) for x in manifest["index_files"]] == archive.index_files
    (folder / "part-of-a-lost-task.warc.gz").write_bytes(b"half")
    archive.store(manifest["record_files"])
    assert not (folder / "part-of-a-lost-task.warc.gz").exists()
    assert warc.Archive.open(archive.folder) == archive  # as another session would find it
    out = warc.read_captures(spark, warc.Archive.open(archive.folder), keys).collect()
    assert len(out) == len(rows)
    for r in out:
        html = next(h for p, u, h in rows if p == r.page_id and u == r.url) or ""
        raw = html.encode()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        again = len(raw) >= 1000 and html == same and r.page_id != 9
        assert (r.record_type, r.refers_to) == (("revisit", 9) if again else ("response", None))
        assert r.html == (None if again else html)
    files = [records_of(f.read_bytes()) for f in Path(archive.folder.removeprefix("file://")).glob("*.warc.gz")]
    assert len(files) > 4 and all(f[0][0]["WARC-Type"] == "warcinfo" and len(f) > 1 for f in files)
    every = [r for f in files for r in f[1:]]
    assert len(every) == len(rows)
    by_id = {h["WARC-Record-ID"]: (h, b) for h, b in every}
    for headers, block in every:
        assert re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", headers["WARC-Record-ID"]) and re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", headers["WARC-Date"])
        assert headers["Content-Type"] == "application/http; msgtype=response" and not re.search(r"[\s<>\"]", headers["WARC-Target-URI"])
        http, body = block.split(b"\r\n\r\n", 1)
        assert http.startswith(b"HTTP/1.1 200 OK\r\n")
        digest = lambda x: "sha1:" + base64.b32encode(hashlib.sha1(x).digest()).decode()
        if headers["WARC-Type"] == "revisit":
            theirs, block = by_id[headers["WARC-Refers-To"]]
            assert body == b"" and theirs["WARC-Target-URI"] == headers["WARC-Refers-To-Target-URI"] and theirs["WARC-Date"] == headers["WARC-Refers-To-Date"]
            body = block.split(b"\r\n\r\n", 1)[1]
        assert headers["WARC-Payload-Digest"] == digest(body) and b"Content-Length: %d" % len(body) in http
    reader = warc.IndexReader(archive)
    assert reader.find("zzz") is None and reader.find("") is None
    missing = spark.createDataFrame([("none such",), (None,)], "key string")
    assert warc.read_captures(spark, archive, missing).count() == 0
    empty, none = warc.write_archive(pages.limit(0))
    assert none.count() == 0 and warc.read_captures(spark, empty, keys).count() == 0
    assert warc.reversed_host_key("http://www.News.example.com:80/a/b?c#d") == "com,example,news)/a/b?c"


def test_index_spans_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    pages = spark.range(500).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), (F.col("id") % 5).cast("string"), F.lit(".example/p")).alias("url"), F.repeat(F.col("id").cast("string"), 3).alias("html"))
    archive, keys = warc.write_archive(pages)
    out = warc.read_captures(spark, archive, keys)
    assert out.count() == 500 and out.select("page_id").distinct().count() == 500


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    bench = words(30, 500)
    good = [words(80, i) + "\n" + words(30, 2000 + i) for i in range(60)]
    bad = [" ".join(f"{w}%%%" for w in words(80, 1000 + i).split()) for i in range(60)]
    near = good[0].split(" ")
    near[5] = "changed"
    texts = [*good, *bad, " ".join(near), good[1], good[2] + "\n" + bench, *AWKWARD]
    docs_of(spark, texts).withColumn("doc_id", F.col("doc_id") * 3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3 * i, int(i < 60)) for i in range(120)], "doc_id long, quality int").withColumn("toxic", F.lit(0)).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        left[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left[name] <= before
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    assert {3 * i for i in range(60)} <= left["quality"] and not left["quality"] & {3 * i for i in range(60, 120)}
    assert left["lines"] == left["quality"]
    assert 3 * 122 not in left["decontamination"] and {3 * i for i in range(60)} <= left["packing"]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 60


def test_each_stage_equals_brute_force_on_awkward_rows(spark, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline
    from fairgrid.llm import decontam, quality

    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    bench, r = words(30, 500), random.Random(3)
    base = words(90, 1).split(" ")
    near = [" ".join(base[:40] + [f"new{k}"] + base[41:]) for k in range(4)]
    texts = [*AWKWARD, *near, *(words(80, 20 + i) + "\nshared by many documents\n" + words(9, 60 + i) for i in range(6)), words(20, 7) + " " + bench[20:], near[0], words(4000, 9)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    rows += [rows[12], (3, near[1], "en", "s", 0), (None, near[2], "en", "s", 0), (None, "shared by many documents", None, None, None), (None, None, None, None, None)]
    r.shuffle(rows)
    train = [(1000 + i, words(80, 100 + i) if i < 40 else " ".join(f"{w}%%%" for w in words(80, 100 + i).split()), "en", "s", 0) for i in range(80)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    everything = spark.createDataFrame(rows + train, schema)
    everything.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1000 + i, int(i < 40), 0) for i in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, bench), (2, None), (None, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, schema)
    for c in ("score", "part", "h", "bucket", "sequence_id", "line", "pos"):
        docs = docs.withColumn(c, F.lit("clash"))
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    stages = dict(corpus_pipeline.STAGES)
    run = lambda name: sorted(((x.doc_id, x.text) for x in stages[name](spark, docs, str(tmp_path)).collect()), key=key)
    plain = [(i, t) for i, t, *_ in rows]

    model = quality.fit_quality(everything, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    measure = quality.SizeDifference(model.good, model.bad)
    assert run("quality") == sorted(((i, t) for i, t in plain if model.scores(np.array([measure(t)]))[0] >= 0.3), key=key)

    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    line_key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(lower)
    held = {}
    for i, t in plain:
        for x in (t or "").split("\n"):
            if i is not None and len(line_key(x)) >= 10:
                held.setdefault(line_key(x), set()).add(i)
    gone = lambda i, x: i is not None and len(held.get(line_key(x), ())) > 1 and min(held[line_key(x)]) < i
    assert run("lines") == sorted(((i, "\n".join(x for x in (t or "").split("\n") if not gone(i, x))) for i, t in plain), key=key)

    named = [(i, t) for i, t in plain if i is not None]
    _, part = brute_components([t for _, t in named], 5)
    label = {i: i for i, _ in named}
    for _ in named:  # ids with several texts join their parts
        for (i, _), p in zip(named, part, strict=True):
            label[i] = label[named[p][0]] = min(label[i], label[named[p][0]])
    assert run("near_duplicates") == sorted(((i, t) for i, t in plain if i is None or label[i] == i), key=key)

    benched = decontam.words_of(bench)
    windows = {tuple(benched[i : i + 10]) for i in range(len(benched) - 9)}
    hit = lambda t: any(tuple(w[i : i + 10]) in windows for w in [decontam.words_of(t)] for i in range(len(w) - 9))
    assert run("decontamination") == sorted(((i, t) for i, t in plain if not hit(t)), key=key) and len(run("decontamination")) == len(plain) - 1

    pieces = stages["packing"](spark, docs, str(tmp_path)).collect()
    tokenizer, want = Tokenizer.from_file(path), []
    for i, t in plain:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(i, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes())) for k in range(0, len(ids), 2048)]
    order = lambda x: (x[0] is None, *(v or 0 for v in x))
    assert sorted(((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pieces), key=order) == sorted(want, key=order)
    filled = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert filled.setdefault(p.sequence_id, 0) == p.offset
        filled[p.sequence_id] += p.length
    assert max(filled.values()) <= 2048

    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
