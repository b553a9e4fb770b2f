"""Line dedup: lines found in many documents go, by levelled sorted runs of line hashes.

Line hashes with their document counts are kept in runs: tables bucketed and sorted by the hash.
Each batch of documents is merge-anti-joined with the runs, so hashes already known to be frequent
aren't added again, and the rest becomes a run of level 0.  ``fan_out`` runs of a level are merged
into one of the next, so n batches leave about log(n) runs.  Only DataFrame functions are used.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm.shared import UPPER, free_name, new_path, register, stored, table

MIN_DOCS = 10
MIN_CHARS = 1
BATCHES = 4
FAN_OUT = 2
BLANK = " \t\n\x0b\f\r"


def line_key(line) -> Column:
    """The line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, UPPER.lower())


class LineRuns:
    """Levelled sorted runs of (hash, n): the documents each line hash was found in."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fan_out: int = FAN_OUT) -> None:
        self.spark, self.min_docs, self.fan_out = spark, min_docs, fan_out
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, counts: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        (
            counts.repartition(self.buckets, "hash").write.bucketBy(self.buckets, "hash").sortBy("hash")
            .option("path", new_path(self.spark, name)).saveAsTable(name)
        )
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, counts: DataFrame) -> None:
        """Add a batch of (hash, n); every document belongs to one batch."""
        for run in self.runs():
            known = run.where(F.col("n") >= self.min_docs).select("hash")
            counts = counts.join(known.hint("merge"), "hash", "left_anti")
        self._place(self._write(counts), 0)

    def _place(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fan_out:
            merged = self._write(self._sum([self.spark.table(x) for x in self.levels[level]]))
            for old in self.levels[level]:
                self.spark.sql(f"DROP TABLE {old}")
            self.levels[level] = []
            self._place(merged, level + 1)

    @staticmethod
    def _sum(runs: list[DataFrame]) -> DataFrame:
        """Runs merged: a hash occurs once in each, so sums need only joins of sorted buckets.

        (A union of bucketed tables must not be grouped by the bucket column: Spark 4.1 then leaves out
        the exchange, but may read the tables unbucketed.)"""

        def merged(a: DataFrame, b: DataFrame) -> DataFrame:
            both = a.join(b.withColumnRenamed("n", "m").hint("merge"), "hash", "full_outer")
            return both.select("hash", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))

        return reduce(merged, runs)

    def drop(self) -> None:
        """Take all runs out of the catalog."""
        for name in [name for level in self.levels for name in level]:
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = []

    def frequent(self) -> DataFrame:
        """Hashes found in at least ``min_docs`` documents."""
        return self._sum(self.runs()).where(F.col("n") >= self.min_docs).select("hash")


def dedup_lines(
    documents: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES, fan_out: int = FAN_OUT
) -> DataFrame:
    """The rows of ``documents`` with ``text`` without frequent lines, ``n_lines`` (before) and ``n_dropped``.

    A line is frequent if its key (see ``line_key``) has at least ``min_chars`` code points and is
    found in documents with at least ``min_docs`` different doc_ids (null is one of them); all
    its lines go, everywhere.  Null and empty texts are one empty line and come back as empty texts.
    Repeated rows count once and are all cleaned alike.  Columns named ``n_lines`` or ``n_dropped``
    are replaced; all others come back unchanged.  An empty table gives no rows.
    """
    spark = documents.sparkSession
    text = F.coalesce("text", F.lit(""))
    split = F.split(text, "\n", -1)
    keys = F.transform(split, line_key)
    hashes = F.transform(keys, lambda k: F.when(F.char_length(k) >= min_chars, F.unhex(F.md5(k))))
    lines = stored(
        documents.select("doc_id", F.md5(text).alias("version"), F.posexplode(hashes).alias("pos", "hash"))
        .withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches))),
        "lines", "batch",
    )
    runs = LineRuns(spark, min_docs, fan_out)
    for batch in range(batches):
        mine = lines.where((F.col("batch") == batch) & F.col("hash").isNotNull())
        runs.add(mine.select("hash", "doc_id").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("n")))
    # written, so that the join deals out both sides itself and can split a hash that very many lines have
    frequent = stored(runs.frequent(), "frequent-lines").withColumn("dropped", F.lit(True))
    runs.drop()
    names = documents.columns
    of, version, marked = (free_name(names, n) for n in ("_id", "_version", "_marks"))
    marks = (
        lines.join(frequent, "hash", "left")
        .groupBy(F.col("doc_id").alias(of), F.col("version").alias(version))
        .agg(F.sort_array(F.collect_set(F.struct("pos", F.coalesce("dropped", F.lit(False)).alias("dropped")))).alias(marked))
        .where(F.exists(marked, lambda m: m["dropped"]))
    )
    kept = F.array_join(F.filter(split, lambda _, i: ~F.get(marked, i)["dropped"]), "\n")
    others = [c for c in names if c not in ("n_lines", "n_dropped")]
    return (
        documents.select(*others)
        .join(marks, F.col("doc_id").eqNullSafe(F.col(of)) & (F.md5(text) == F.col(version)), "left")
        .withColumn("n_lines", F.size(split).cast("long"))
        .withColumn("n_dropped", F.when(F.col(marked).isNull(), 0).otherwise(F.size(F.filter(marked, lambda m: m["dropped"]))).cast("long"))
        .withColumn("text", F.when(F.col(marked).isNull(), text).otherwise(kept))
        .select(*others, "n_lines", "n_dropped")
    )


SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{UPPER.lower()}') AS key FROM lines),
frequent AS (
  SELECT key FROM keyed WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
marked AS (SELECT *, key IN (SELECT key FROM frequent) AS dropped FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@register("op7_line_dedup", SQL)
def op7_line_dedup(spark, sf_dir):
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
