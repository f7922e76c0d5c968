"""Corpus pipeline: documents through the corpus operators, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns the columns of ``documents``
(the last: packed pieces). Rows that share an id and a text count as one document
and stay or go together. Texts emptied by a stage stay as empty documents. Every
stage takes null ids (they sort first), null texts (they count as empty), empty
tables (an empty result with the same columns), texts of any length, and columns
beyond those of ``documents``, which it does not pass on.
"""

from pyspark.sql import functions as F

from tenderlake.llm import jaccard_join, line_dedup, packing, quality, substring_dedup
from tenderlake.llm.storage import discard, materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: The stages include trained and sampled steps, which SQL cannot express.
ORACLE_SQL = None


def _documents(df):
    return df.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_low_quality(spark, docs, sf_dir):
    """Rows scored below the threshold go; the rest is unchanged (a null text stays null).

    A null or empty text is scored like any other. Rows of one text get one score. Without
    labels every score is 0.5 and all rows stay.
    """
    labels = quality.training_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs.select(*COLUMNS), labels)


def drop_repeated_lines(spark, docs, sf_dir):
    """Lines near to an earlier one go; every row stays, null texts as empty ones.

    Of equal lines the first in (doc_id with null first, text, line) stays, so of
    repeated rows one keeps its lines.
    """
    return _documents(line_dedup.dedup_lines(docs, keep=("lang", "source")))


def keep_one_of_near_copies(spark, docs, sf_dir):
    """The smallest id of each component stays, with unchanged text; null sorts first.

    Rows that share the smallest id stay together, repeated ones too. Null and
    empty texts are near to nothing and stay.
    """
    kept = jaccard_join.jaccard_components(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    return docs.alias("d").join(kept.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")), "left_semi").select(*COLUMNS)


def drop_repeated_passages(spark, docs, sf_dir):
    """Words of windows that start earlier elsewhere go; every row stays, null texts as empty ones.

    Texts that lose nothing keep their white space. Of repeated rows the first keeps its words.
    """
    return _documents(substring_dedup.dedup_substrings(docs, keep=("lang", "source"), verbatim=True))


def pack_into_windows(spark, docs, sf_dir):
    """Pieces of all rows in windows of 2048 tokens; a null or empty text is its end mark alone.

    Repeated rows are packed each, under the same doc_id.
    """
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", drop_low_quality),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack_into_windows),
]


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name)
        discard(before)  # the stage that read it is written
    return docs
