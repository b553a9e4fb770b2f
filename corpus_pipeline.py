"""A corpus from raw documents to packed sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.llm.lines import dedup_lines
from wattlake.llm.minhash import near_duplicates
from wattlake.llm.mixing import apply_mix
from wattlake.llm.packing import pack_documents, tokenizer_path
from wattlake.llm.quality import fit, keep_good
from wattlake.llm.shared import free_name, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from ``labels`` and the documents given.

    A null text is scored as an empty one, repeated rows each for itself, so equal ones share their fate.  Without labelled
    rows every document has the same score.  An empty table gives none.
    """
    return keep_good(docs, fit(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Frequent lines go; every row stays, with what is left of it.

    A null text becomes an empty one.  Repeated rows of a doc_id count once and are cleaned alike.  Columns whose names
    the operator uses itself keep their values.  ``n_chars``, if there is such a column, is that of the new text.  An
    empty table gives none.
    """
    clash = {c: free_name(docs.columns, "_" + c) for c in docs.columns if c.lower() in ("n_lines", "n_dropped")}
    back = {new: old for old, new in clash.items()}
    out = dedup_lines(docs.withColumnsRenamed(clash)).drop("n_lines", "n_dropped").withColumnsRenamed(back)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays, of a repeated doc_id one row, that
    with the least text.

    Documents without words belong to no group and stay, one row for each doc_id; rows without a doc_id all stay.  All
    columns come back, whatever their names.  An empty table gives none.
    """
    gone_id, again_id, place = (free_name(docs.columns, n) for n in ("_gone", "_again", "_place"))
    gone = near_duplicates(docs).where("NOT kept AND component_id IS NOT NULL").select(F.col("doc_id").alias(gone_id)).distinct()
    kept = docs.join(gone, F.col("doc_id") == F.col(gone_id), "left_anti")
    again = stored(docs.groupBy(F.col("doc_id").alias(again_id)).agg(F.count(F.lit(1)).alias("n")).where(f"n > 1 AND {again_id} IS NOT NULL").select(again_id), "repeated-ids")
    same = F.col("doc_id") == F.col(again_id)
    first = Window.partitionBy("doc_id").orderBy("text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    one = kept.join(again, same, "left_semi").withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).select(*docs.columns)
    return kept.join(again, same, "left_anti").unionByName(one)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often, and as far, as the mix takes it.

    A null or empty text has no words and is never taken; a null source is a source of its own.  All columns come
    back, whatever their names; ``n_chars`` is that of the text taken.  An empty table gives none.
    """
    return apply_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences, with their token ids.

    A null or empty text is its end id alone; repeated rows and those without a doc_id are packed each for itself.  Other
    columns are not looked at.  An empty table gives no pieces.
    """
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("minhash near-dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: Fitting the classifier and the token ids can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
