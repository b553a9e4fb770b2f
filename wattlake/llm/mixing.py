"""Mixing sources to target weights: Sainte-Lague quotas of equal blocks of words, then a seeded choice.

The words to take are cut into blocks of ``block`` words.  Sources get blocks by the highest
quotients target / (2j + 1); the blocks of a source are dealt to its shards (hash slices of its
documents) by the same rule on the shards' sizes.  Within a shard the documents stand in a seeded
order, a stream of blocks; a quota of q words takes whole rounds of the stream and then its first
words.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.shared import WORD, free_name, register, stored, table

BLOCK = 16
WEIGHTS = (1, 2, 3)
#: A document is taken so many times at most.
REPEATS = 3
#: Documents of a shard, about.
SHARD_ROWS = 16384
#: Rows equal in source, doc_id and size that stand in one shard.
SPLIT = 1024
SEED = 17


def word_count(text) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``sources`` (source, source_size, n_docs) with ``weight`` and ``target``.

    Weights repeat in code point order of the sources, null last.  All sizes are shared by weight;
    no target exceeds ``repeats`` times its source's size.  With sources in order of cap / weight,
    f(k) = (total - caps before k) / (weights from k on) rises until the first source below its cap
    and falls from there on, so its maximum is the words a unit of weight gets after all resharing.
    The windows see one row per source.
    """
    n = len(weights)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % n + 1).cast("int")).cast("long")
    ranked = sources.withColumn("rank", rank).withColumn("weight", weight).withColumn("cap", F.col("source_size") * repeats)
    before = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = F.max("unit").over(everything)
    return (
        ranked.withColumn("unit", rest / left)
        .withColumn("target", F.least(F.col("cap").cast("double"), level * F.col("weight")))
        .select("source", "source_size", "n_docs", "rank", "weight", "target")
    )


def sainte_lague(cells: DataFrame, group: list[str], weight: str, seats: str, order: str) -> DataFrame:
    """``cells`` with ``quota``: the ``seats`` of each group dealt to its cells by the highest quotients
    weight / (2j + 1), ties to the smaller ``order``.

    With W = all weights and n = cells of the group, the divisors W / (seats + n/2) and
    W / (seats - n/2) give every cell at least and at most what it gets; only the at most 2n seats
    between them are ranked.
    """
    mine = Window.partitionBy(*group)
    scale = lambda side: F.floor(F.col(weight) * F.greatest(F.col(seats) + side * F.col("_n") / 2, F.lit(0.0)) / F.col("_all") + 0.5)
    bounds = (
        cells.withColumn("_n", F.count(F.lit(1)).over(mine))
        .withColumn("_all", F.sum(weight).over(mine))
        .withColumn("_low", F.when(F.col("_all") > 0, scale(-1)).otherwise(0).cast("long"))
        .withColumn("_high", F.when(F.col("_all") > 0, scale(1)).otherwise(0).cast("long"))
        .withColumn("_left", F.col(seats) - F.sum("_low").over(mine))
    )
    open_seats = bounds.where("_high > _low").select(
        *group, order, "_left", F.col(weight).alias("_w"), F.explode(F.sequence("_low", F.col("_high") - 1)).alias("_j")
    )
    by = Window.partitionBy(*group).orderBy((F.col("_w") / (2 * F.col("_j") + 1)).desc(), order, "_j")
    won = (
        open_seats.withColumn("_r", F.row_number().over(by))
        .where("_r <= _left")
        .groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col(order).alias("_o"))
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    same = F.col(order).eqNullSafe(F.col("_o"))
    for i, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return bounds.join(won, same, "left").withColumn("quota", F.col("_low") + F.coalesce("_won", F.lit(0))).select(*cells.columns, "quota")


def split_repeats(sized: DataFrame, split: int = SPLIT) -> DataFrame:
    """``sized`` (source, doc_id, size, at and more) with ``part``: which ``split`` of the rows equal in source, doc_id and size a row is in.

    ``at`` holds a number from ``monotonically_increasing_id``, whose upper bits name the task that gave it.  Rows that are equal are
    counted by hash first; of the few hashes with more than ``split`` rows, each task's rows are numbered for
    themselves, behind the counts of the tasks before.  So no task sees more of an id than one task of the scan did.
    """
    same = ["source", "doc_id", "size"]
    marked = sized.withColumn("hash", F.xxhash64(*same))
    often = stored(marked.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > split).select("hash"), "repeats")
    rare = marked.join(often, "hash", "left_anti").withColumn("part", F.lit(0).cast("long"))
    repeated = marked.join(often, "hash").withColumn("task", F.shiftright("at", 33))
    counts = repeated.groupBy("hash", *same, "task").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("hash", *same).orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    before = counts.select(F.struct("hash", *same, "task").alias("_of"), F.coalesce(before, F.lit(0)).alias("_before"))
    mine = F.row_number().over(Window.partitionBy("hash", *same, "task").orderBy("at")) - 1
    numbered = repeated.withColumn("_mine", mine).withColumn("_is", F.struct("hash", *same, "task"))
    numbered = numbered.join(before, F.col("_is").eqNullSafe(F.col("_of"))).withColumn("part", F.floor((F.col("_before") + F.col("_mine")) / split))
    return rare.select(*sized.columns, "part").unionByName(numbered.select(*sized.columns, "part"))


def mix_sources(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    block: int = BLOCK,
    shard_rows: int = SHARD_ROWS,
    seed: int = SEED,
    row: str | None = None,
) -> DataFrame:
    """(doc_id, size, source, source_size, target, taken) of every row, and its column ``row`` if that is asked for.

    ``size`` is the number of words (null or empty text: 0), ``taken`` the words the mix takes of this
    row, whole rounds and a first part; it is at most ``repeats`` times ``size``.  A source's taken
    words differ from its target by less than a block, plus a block for each shard whose cap cuts
    its quota.  Null is a source of its own.  Repeated rows are documents of their own; those of one size stand
    next to each other in the seeded order, ``SPLIT`` of them at most, and the next ones elsewhere, so that no doc_id,
    null included, fills a shard.  Other columns of ``documents`` are not looked at.  An empty table gives no rows.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size"), F.col("part")))
    carried = [F.col(row).alias("row")] if row else []
    sized = documents.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("at"), *carried)
    sized = stored(split_repeats(stored(sized, "sizes")).withColumn("key", key).drop("at", "part"), "keyed-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = source_targets(sources, weights, repeats)
    total = F.sum("source_size").over(Window.partitionBy("all"))
    plan = targets.withColumn("all", F.lit(0)).withColumn("seats", F.floor(total / block + 0.5).cast("long"))
    plan = sainte_lague(plan, ["all"], "target", "seats", "rank").select(
        F.col("source").alias("of"), "source_size", "target", F.col("quota").alias("source_quota"),
        F.ceil(F.col("n_docs") / shard_rows).alias("shards"),
    )
    plan = stored(plan, "mix-plan")
    slice_of = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % F.col("shards")
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("of"))).withColumn("shard", slice_of)
    cells = rows.groupBy("of", "shard", "source_quota").agg(F.sum("size").alias("shard_size"))
    cells = sainte_lague(cells, ["of"], "shard_size", "source_quota", "shard").select(
        F.col("of").alias("cell_of"), F.col("shard").alias("cell_shard"), "shard_size",
        F.least(F.col("quota") * block, F.col("shard_size") * repeats).alias("words"),
    )
    stream = Window.partitionBy("of", "shard").orderBy("key", "doc_id", "size", *["row" for _ in carried]).rowsBetween(Window.unboundedPreceding, -1)
    rounds = F.when(F.col("shard_size") > 0, F.floor(F.col("words") / F.col("shard_size"))).otherwise(0)
    part = F.col("words") - F.col("rounds") * F.col("shard_size") - F.col("before")
    return (
        rows.join(cells, F.col("of").eqNullSafe(F.col("cell_of")) & (F.col("shard") == F.col("cell_shard")))
        .withColumn("before", F.coalesce(F.sum("size").over(stream), F.lit(0)))
        .withColumn("rounds", rounds)
        .withColumn("taken", (F.col("rounds") * F.col("size") + F.least(F.greatest(part, F.lit(0)), F.col("size"))).cast("long"))
        .select("doc_id", "size", "source", "source_size", "target", "taken", *["row" for _ in carried])
    )


def apply_mix(documents: DataFrame, **parameters) -> DataFrame:
    """The mix as rows of ``documents``: one row for each whole round a document is taken, and one with
    its first words for the rest; ``n_chars``, if there is such a column, is that of the new text.

    Rows are numbered once they are written, and each follows its own decision, repeated rows and those without a doc_id
    too, so a source has as many words as ``mix_sources`` takes.  A row without words is never taken.  An empty table
    gives no rows.  All other columns come back as they are, whatever their names.
    """
    names = documents.columns
    row, taken, size, copy = (free_name(names, n) for n in ("_row", "_taken", "_size", "_copy"))
    rows = stored(documents.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    mixed = mix_sources(rows, **parameters, row=row).where("taken > 0").select(F.col("row").alias("_mixed"), F.col("taken").alias(taken), F.col("size").alias(size))
    pieces = F.sequence(F.lit(1), F.ceil(F.col(taken) / F.col(size)).cast("int"))
    rest = (F.col(taken) - (F.col(copy) - 1) * F.col(size)).cast("int")
    start = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), rest), "")
    out = rows.join(mixed, rows[row] == mixed["_mixed"]).withColumn(copy, F.explode(pieces))
    out = out.withColumn("text", F.when(rest >= F.col(size), F.col("text")).otherwise(start))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.char_length("text").cast(documents.schema["n_chars"].dataType))
    return out.select(*names)


SQL = f"""
WITH counted AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sized AS (
  SELECT doc_id, source, size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size || ':' || (row_number() OVER (PARTITION BY source, doc_id, size) - 1) // {SPLIT}) AS key
  FROM counted),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs FROM sized GROUP BY source),
ranked AS (
  SELECT *, [1, 2, 3][1 + rank % 3] AS weight, source_size * {REPEATS} AS cap
  FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sources)),
units AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0) AS DOUBLE) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS unit
  FROM ranked WINDOW b AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT *, least(CAST(cap AS DOUBLE), max(unit) OVER () * weight) AS target,
         CAST(floor(sum(source_size) OVER () / {BLOCK}.0 + 0.5) AS BIGINT) AS seats, count(*) OVER () AS n FROM units),
quotients AS (
  SELECT rank, row_number() OVER (ORDER BY target / (2 * j + 1) DESC, rank, j) AS r, seats
  FROM targets, LATERAL (SELECT unnest(range(CAST(target / {BLOCK} AS BIGINT) + n + 2)) AS j) WHERE target > 0),
quotas AS (SELECT rank, count(*) AS quota FROM quotients WHERE r <= seats GROUP BY rank),
plan AS (
  SELECT t.source, source_size, target, CAST(coalesce(quota, 0) AS BIGINT) AS quota,
         CAST(ceil(n_docs / {SHARD_ROWS}.0) AS BIGINT) AS shards
  FROM targets t LEFT JOIN quotas q ON q.rank = t.rank),
dealt AS (
  SELECT s.*, p.* EXCLUDE (source), CAST('0x' || substr(key, 1, 8) AS BIGINT) % shards AS shard
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
cells AS (
  SELECT source, shard, any_value(quota) AS quota, CAST(sum(size) AS BIGINT) AS shard_size FROM dealt GROUP BY source, shard),
cell_quotients AS (
  SELECT source, shard, quota, row_number() OVER (PARTITION BY source ORDER BY shard_size / CAST(2 * j + 1 AS DOUBLE) DESC, shard, j) AS r
  FROM cells, LATERAL (SELECT unnest(range(quota + 1)) AS j) WHERE shard_size > 0),
cell_quotas AS (SELECT source, shard, count(*) AS won FROM cell_quotients WHERE r <= quota GROUP BY source, shard),
words AS (
  SELECT c.source, c.shard, c.shard_size, least(coalesce(won, 0) * {BLOCK}, c.shard_size * {REPEATS}) AS words
  FROM cells c LEFT JOIN cell_quotas q ON q.source IS NOT DISTINCT FROM c.source AND q.shard = c.shard),
streams AS (
  SELECT d.doc_id, d.size, d.source, d.source_size, d.target, w.words, w.shard_size,
         CASE WHEN w.shard_size > 0 THEN w.words // w.shard_size ELSE 0 END AS rounds,
         coalesce(sum(d.size) OVER (PARTITION BY d.source, d.shard ORDER BY d.key, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM dealt d JOIN words w ON d.source IS NOT DISTINCT FROM w.source AND d.shard = w.shard)
SELECT doc_id, size, source_size, target, source,
       CAST(rounds * size + least(greatest(words - rounds * shard_size - before, 0), size) AS BIGINT) AS taken
FROM streams
"""


@register("op6_mixing", SQL)
def op6_mixing(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents"))
