"""Line de-duplication across documents, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, cut, lower_ascii

MIN_CHARS = 10
MIN_DOCS = 2


def _trimmed(line):
    return F.btrim(line, F.lit(BLANKS))


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, t, pos, h1, h2): every line of at least ``min_chars`` code points, trimmed, by place and key.

    ``t`` hashes the whole text, so that rows of one doc_id with other texts stay apart. A key has
    128 bits, so that different lines of a very large corpus stay apart. Rows with a null doc_id are left out.
    """
    text = F.coalesce("text", F.lit(""))
    hashed = docs.where("doc_id is not null").select("doc_id", "text", F.xxhash64(text).alias("t"))  # before the lines, so once for a text
    lines = hashed.select("doc_id", "t", F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    key = lower_ascii(_trimmed(F.col("line")))
    long_enough = F.char_length(_trimmed(F.col("line"))) >= min_chars
    return lines.where(long_enough).select("doc_id", "t", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"))


def repeated_lines(keys: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, keeper): keys of ``keys`` found in at least ``min_docs`` documents, with the smallest doc_id that holds each.

    A document counts once for a key however often it holds it. Counts are
    combined before the shuffle, so a line that most documents share is no hot key.
    """
    if min_docs <= 2:
        found = keys.groupBy("h1", "h2").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("most"))
        return found.where("most <> keeper").drop("most") if min_docs == 2 else found.drop("most")
    once = keys.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one")).groupBy("h1", "h2")
    return once.agg(F.min("doc_id").alias("keeper"), F.count("*").alias("n")).where(F.col("n") >= min_docs).drop("n")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` (doc_id, text, more) with repeated lines removed, plus ``n_lines`` and ``n_dropped``.

    A line's key is the line without white space at both ends, A-Z lower-cased.
    Keys of at least ``min_chars`` code points in at least ``min_docs``
    documents stay only in the smallest doc_id that holds them. Lines are exploded and hashed once and
    written; counts and the join with the repeated keys (written too, so that the join is a plain sort-merge join
    that AQE can split where a line is very frequent) read only hashes and places. A document's lost places are gathered,
    and its other lines are put together in their order. Texts move once, in that last join.

    Null or empty text is one empty line. Very long texts, and very many repeated lines in one text, cost time in
    proportion. Rows with a null doc_id keep all lines and are not counted. Repeated rows of one doc_id count as one
    document; each loses its own lines. Other columns pass through; an incoming
    ``n_lines`` or ``n_dropped`` is replaced. An empty table stays empty.
    """
    docs = docs.drop("n_lines", "n_dropped")
    keys = cut(line_keys(docs.select("doc_id", "text"), min_chars))
    repeated = cut(repeated_lines(keys, min_docs))
    gone = keys.join(repeated, ["h1", "h2"]).where("doc_id <> keeper")
    lost = gone.groupBy(F.col("doc_id").alias("__id"), F.col("t").alias("__t")).agg(F.collect_set("pos").alias("__lost"))
    text = F.coalesce("text", F.lit(""))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__lost"))
    return (
        docs.join(lost, (F.col("doc_id") == F.col("__id")) & (F.xxhash64(text) == F.col("__t")), "left")
        .withColumn("__lines", F.split(text, "\n", -1))
        .withColumn("n_lines", F.size("__lines").cast("long"))
        .withColumn("n_dropped", F.when(F.col("__lost").isNull(), 0).otherwise(F.size("__lost")).cast("long"))
        .withColumn("text", F.when(F.col("__lost").isNull(), text).otherwise(F.array_join(F.transform(kept, lambda i: F.get("__lines", i)), "\n")))
        .drop("__id", "__t", "__lost", "__lines")
    )
