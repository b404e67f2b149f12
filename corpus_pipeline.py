"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Unless a contract says otherwise, near duplicates share five-word shingles at a similarity of 0.8 or more.
SHINGLE_WORDS = 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject.

    Every row is scored by its whole text: null counts as empty, null ids and repeated rows are rows like others, equal texts (ties) have equal scores.
    Further columns are left out. An empty table stays empty.
    """
    from fairgrid.llm.quality import fit_quality, score_quality

    labelled = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    everything = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_quality(everything, labelled)
    return score_quality(docs.select(*COLUMNS), model).where("predicted = 1").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document with a smaller id holds; ``n_chars`` follows the new text.

    Null text becomes empty; rows with a null id keep all lines and count for none; repeated rows of one id are one document, each loses its own lines; very
    long texts are split whole. No document goes, even if no line is left. Further columns are left out. An empty table stays empty.
    """
    from fairgrid.llm.linededup import dedup_lines

    return dedup_lines(docs.select(*COLUMNS)).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest doc_id.

    Null, empty and wordless texts are alone in their groups; rows with a null id stay; repeated rows of one id stay or go together, and an id with several
    texts has the links of each. Further columns are left out. An empty table stays empty.
    """
    from fairgrid.llm.setsketch import near_duplicate_groups

    docs = docs.select(*COLUMNS)
    groups = near_duplicate_groups(docs, shingle_words=SHINGLE_WORDS)
    dropped = groups.where("doc_id <> component_id").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs.

    Rows are judged by their whole text alone, so null ids, repeated rows and ties are no special case; null and empty texts stay, and so does all where the benchmark
    is empty. Further columns are left out. An empty table stays empty.
    """
    from fairgrid.llm.decontam import drop_contaminated

    return drop_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents with their sequence and place in it.

    Null and empty texts are one piece with the end id alone; very long texts are cut; null ids and repeated rows are pieces like others; pieces of equal length
    go by place in the scan. An empty table gives no pieces.
    """
    import public_tokenizers

    from fairgrid.llm.packing import pack, token_pieces

    return pack(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("packing", packing)]

#: Compression scores, sketches and token ids have no SQL form; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    from fairgrid.llm.common import shared_dir

    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
