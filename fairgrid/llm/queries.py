"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, table


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_by_bytes

    out = shard_by_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .linededup import dedup_lines

    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import benchmark_hits, sha256_of_ids

    hits = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), sha256_of_ids("item_ids").alias("items_sha256"), (F.size("hit_spans") > 0).alias("contaminated"))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack, token_pieces

    return pack(token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import fit_quality, score_quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import fit_language, predict_language

    docs = table(spark, sf_dir, "documents")
    out = predict_language(docs.select("doc_id", "text"), fit_language(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .outliers import judge

    return judge(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .setsketch import near_duplicate_groups

    return near_duplicate_groups(table(spark, sf_dir, "documents")).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import Archive, read_captures, write_archive

    archive, keys = write_archive(table(spark, sf_dir, "pages"))
    return read_captures(spark, Archive.open(archive.folder), keys).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import extract_main_text

    out = extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrases import collocations

    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import top_k

    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversations import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_quality_classifier, op3_language_id, op4_near_dedup, op5_html_extraction, op6_quality_rules, op7_sharding, op8_decontamination, op9_line_dedup, op10_warc, op11_phrases, op12_top_k, op13_prefix_trie)}

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: Operators 1, 2, 3, 5 and 6 have none: token ids, compressed sizes, trained models and style trees have no SQL form. They are tested against brute-force versions.
ORACLE_SQL = {
    "op4_near_dedup": rf"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x20\x09-\x0D]+') w from documents),
s as (select distinct doc_id, unnest(case when len(w) > 1 then list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) else w end) g from d),
n as (select doc_id, count(*) n from s group by 1),
x as (select a.doc_id a, b.doc_id b, count(*) shared from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
e as (select a, b from x join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * shared >= 80 * (na.n + nb.n - shared)),
near as (select a, b from e union all select b, a from e),
r(id, root) as (select doc_id, doc_id from documents union select r.id, near.b from r join near on r.root = near.a)
select d.doc_id, cast(coalesce(n, 0) as bigint) n_shingles, component_id, d.doc_id = component_id kept
from d left join n using (doc_id) join (select id, min(root) component_id from r group by 1) on id = d.doc_id""",
    "op7_sharding": """
with t as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i::bigint, range(8)), lambda v, k: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end)) crc_table),
s as (select doc_id, strlen(coalesce(text, '')) + 1 size,
 list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: (instr('0123456789ABCDEF', h[1]) - 1) * 16 + instr('0123456789ABCDEF', h[2]) - 1) bytes from documents),
k as (select doc_id, size, xor(list_reduce(list_prepend(4294967295::bigint, bytes), lambda v, b: xor(v >> 8, crc_table[xor(v & 255, b) + 1])), 4294967295) text_crc32 from s, t),
r as (select *, sum(size) over (order by doc_id) run, sum(size) over () total from k),
p as (select *, cast(least(7, ((2 * run - size) * 8) // (2 * total)) as int) shard from r)
select doc_id, size, text_crc32, 'bytes' law, shard, row_number() over (partition by shard order by doc_id) - 1 slot, cast(null as int) grown_shard from p""",
    "op10_warc": """
with p as (select page_id, strlen(coalesce(html, '')) payload_bytes, sha1(coalesce(html, '')) payload_digest from pages),
r as (select payload_digest, payload_bytes, max(page_id) response from p where payload_bytes >= 1000 group by all)
select page_id, payload_bytes, payload_digest, case when page_id < response then 'revisit' else 'response' end record_type,
       case when page_id < response then response end refers_to
from p left join r using (payload_digest, payload_bytes)""",
    "op8_decontamination": r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
bw as (select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') k
       from (select item_id, w, least(10, len(w)) n, unnest(range(1, len(w) - least(10, len(w)) + 2)) i from b where len(w) > 0)),
lens as (select distinct n from bw),
dw as (select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') k from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from d, lens where len(w) >= n)),
hits as (select doc_id, item_id, dw.n, i from dw join bw using (n, k)),
words as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + n)) p from hits) group by doc_id),
items as (select doc_id, count(*) n_items, string_agg(item_id, ',' order by item_id) ids from (select distinct doc_id, cast(item_id as varchar) item_id from hits) group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit, cast(coalesce(n_items, 0) as bigint) n_items,
       sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join words using (doc_id) left join items using (doc_id)""",
    "op9_line_dedup": r"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) p from documents),
k as (select doc_id, p, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') key from l),
r as (select key, min(doc_id) keeper from k where length(key) >= 10 group by key having count(distinct doc_id) >= 2),
f as (select k.doc_id, p, line, coalesce(k.doc_id <> keeper, false) gone from k left join r on k.key = r.key)
select doc_id, count(*) n_lines, cast(sum(cast(gone as bigint)) as bigint) n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by p) filter (where not gone), '')) kept_sha256
from f group by doc_id""",
    "op11_phrases": r"""
with d as (select coalesce(lang, 'und') lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
p as (select lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') w from d),
g as (select lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) phrase from p, range(1, 6) s(m) where len(w) >= m),
f as (select lang, m, phrase, count(*) f from g group by all),
n as (select lang, sum(f) n from f where m = 1 group by lang),
c as (select * from f where m > 1 and f >= 100),
free as (select * from c where not exists (select 1 from c b where b.lang = c.lang and b.m > c.m and 100 * b.f >= 100 * c.f and contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))),
cuts as (select lang, m, phrase, f a, k, array_to_string(string_split(phrase, ' ')[1 : k], ' ') lp, array_to_string(string_split(phrase, ' ')[k + 1 :], ' ') rp from free, range(1, 5) s(k) where k < m),
scored as (select cuts.lang, cuts.phrase, a, l.f l, r.f r, n, k, cast((1000::hugeint * a * n) // (l.f::hugeint * r.f) as bigint) score
 from cuts join f l on l.lang = cuts.lang and l.m = k and l.phrase = lp join f r on r.lang = cuts.lang and r.m = cuts.m - k and r.phrase = rp join n on n.lang = cuts.lang),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as "rank" from best)
select lang, "rank", phrase, cast(a as bigint) a, cast(l as bigint) l, cast(r as bigint) r, cast(n as bigint) n, score from ranked where "rank" <= 2000""",
    "op12_top_k": r"""
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) v from embeddings
 where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, c.vec_id vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) as bigint) score
 from v q join v c on c.vec_id <> q.vec_id and len(c.v) = len(q.v) where q.vec_id % 50 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) "rank", vec_id, score from s qualify "rank" <= 5""",
    "op13_prefix_trie": r"""
with crc as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i::bigint, range(8)), lambda v, k: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end)) crc_table),
t as (select conv_id, coalesce(role, '') "role", coalesce(text, '') text, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) pos from conversations where conv_id is not null),
c as (select conv_id, conv_id - conv_id % 5 base, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, len(conv_id::varchar) + 1), lambda i: ascii(substr(conv_id::varchar, i, 1))::bigint)),
  lambda v, b: xor(v >> 8, crc_table[xor(v & 255, b) + 1])), 4294967295) % 9 h from (select distinct conv_id from t), crc),
r as (select c.conv_id, pos, "role", text from c join t on t.conv_id = base and pos <= h union all select c.conv_id, pos + 9, "role", text from c join t on t.conv_id = c.conv_id and pos > h),
s as (select conv_id, coalesce(list(struct_pack("role", text) order by pos) filter (pos is not null), []) s from c left join r using (conv_id) group by conv_id),
m as (select conv_id, len(s) n, d, s[1 : d] k from s, range(0, (select max(len(s)) + 1 from s)) x(d) where d <= len(s)),
u as (select d, k, min(conv_id) conv_id, count(*) n_convs, string_agg(conv_id::varchar, ',' order by conv_id) filter (n = d) ends from m group by d, k),
p as (select u.*, b.conv_id parent, case when u.d = 0 then 0 else strlen(u.k[u.d].text) end bytes from u left join u b on b.d = u.d - 1 and b.k = u.k[1 : u.d - 1]),
ch as (select parent, d - 1 d, count(*) n_children from p where parent is not null group by all),
v as (select p.*, coalesce(n_children, 0) n_children from p left join ch on ch.parent = p.conv_id and ch.d = p.d),
sub as (select a.conv_id, a.d, count(*) filter (b.n_children = 0) n_leaves, sum((b.n_convs - 1) * b.bytes) saved from v a join v b on b.d >= a.d and b.k[1 : a.d] = a.k group by all)
select conv_id, d depth, parent parent_conv_id, n_convs, n_children, n_leaves, cast(saved as bigint) saved_tokens, sha256(coalesce(ends, '')) ends_sha256
from v join sub using (conv_id, d)""",
}
