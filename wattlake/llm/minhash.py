"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

A sketch has ``bands * rows`` coordinates.  Round i hashes every shingle of a set into one coordinate,
with a value that is larger than all of earlier rounds; in round t + i all shingles go to
coordinate i.  A coordinate keeps its smallest value, so few rounds fill the sketch and none stays empty.  Equal
sets are one class from the start.  Classes that share a band are candidates; links are confirmed on
the full sets.

Only what connects is verified, never all pairs of a bucket:
1. each class against the smallest of the first classes of its buckets;
2. in buckets whose members aren't all connected by then, each against members of other components
   that are drawn anew for every bucket, ``PIVOTS`` of them, ``TURNS`` times;
3. in those that are still open, members outside the bucket's largest component against all of other
   components, pair by pair.  Every set has ``PARITY`` bits: whether the number of its shingles in a slot is
   odd.  Bits in which two sets differ are a lower bound of the shingles that only one of them has, and
   pairs that this bound proves too different are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.graph import components
from wattlake.llm.shared import register, stored, table
from wattlake.llm.text import Hasher, buffers, lowered, mix, shingles, slices, words

#: Fixed by the definition of a near-duplicate where no other is asked for.
WORDS, PERCENT = 5, 80
#: A pair at a similarity of 0.8 is missed with probability (1 - 0.8^6)^64, about 4e-9.
BANDS, ROWS = 64, 6
#: Only how much is connected before the last step depends on these, never the result.
PIVOTS, TURNS = 8, 2
PARITY = 1024


def sets_of(texts: pa.Array, hasher: Hasher, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts, index of each text's first with one more at the end)."""
    data, offsets = buffers(texts)
    data = lowered(data)
    starts, ends, first = words(data, offsets)
    found, where = shingles(hasher(data, starts, ends), first, n)
    text = np.repeat(np.arange(len(where) - 1), np.diff(where))
    for a, b in zip(where[:-1].tolist(), where[1:].tolist(), strict=True):
        found[a:b].sort()
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    return found[new], np.searchsorted(text[new], np.arange(len(where)))


def fast_sketch(found: np.ndarray, where: np.ndarray, t: int) -> np.ndarray:
    """Sketches of sets given by ``sets_of``, one row of ``t`` values per set; empty sets keep the largest value."""
    sizes = np.diff(where)
    out = np.full(len(sizes) * t, np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    step = 1
    i = 0
    while len(found) and i < 2 * t:
        # sets with few shingles need many rounds; several are made at once when little is left
        step = max(1, min(16, (1 << 16) // max(1, len(found)), (t if i < t else 2 * t) - i))
        rounds = np.arange(i, i + step, dtype=np.uint64)
        value = mix(found[None, :] + (rounds * np.uint64(0x9E3779B97F4A7C15))[:, None])
        if i < t:
            bins = ((value >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)
        else:
            bins = np.repeat(rounds[:, None] - np.uint64(t), len(found), 1)
        value = (rounds << np.uint64(32))[:, None] | (value & np.uint64(0xFFFFFFFF))
        np.minimum.at(out, (bins.astype(np.int64) + (owner * t)[None, :]).ravel(), value.ravel())
        i += step
        full = (out.reshape(-1, t) != np.iinfo(np.uint64).max).all(1)
        left = ~full[owner]
        if not left.all():
            found, owner = found[left], owner[left]
    return out.reshape(-1, t)


def _sketches(documents: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        salt = np.arange(bands, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
        for batch in batches:
            for some in slices(batch, "text", 2 << 20):
                found, where = sets_of(some.column("text"), hasher, n)
                values = fast_sketch(found, where, bands * rows).reshape(-1, bands, rows)
                keys = np.broadcast_to(salt, values.shape[:2]).copy()
                for r in range(rows):
                    keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, :, r])
                sums = []
                for s in (1, 2):  # two sums of mixed hashes tell sets apart
                    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(found + np.uint64(s)), dtype=np.uint64)])
                    sums.append(pa.array((total[where[1:]] - total[where[:-1]]).view(np.int64)))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * bands, pa.int32()), pa.array(keys.ravel().view(np.int64)))
                slot = np.repeat(np.arange(len(keys)), np.diff(where)) * PARITY + (found >> np.uint64(54)).astype(np.int64) % PARITY
                odd = np.packbits((np.bincount(slot, minlength=len(keys) * PARITY) & 1).astype(np.uint8)).view(np.int64)
                parity = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * (PARITY // 64), pa.int32()), pa.array(odd))
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array(np.diff(where)), *sums, lists, parity], ["doc_id", "n", "s1", "s2", "keys", "parity"]
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, s1 long, s2 long, keys array<long>, parity array<long>")


def _verify(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """``pairs`` (u, v) with their Jaccard distance and whether they are linked, from their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for some in slices(batch, "text_u", 2 << 20):
                far, linked = [], []
                sides = [some.column(c).dictionary_encode() for c in ("text_u", "text_v")]
                sets = [sets_of(s.dictionary, hasher, n) for s in sides]
                index = [s.indices.to_numpy().tolist() for s in sides]
                for i, j in zip(*index, strict=True):
                    (a, at), (b, bt) = sets
                    x, y = a[at[i] : at[i + 1]], b[bt[j] : bt[j + 1]]
                    if len(x) > len(y):
                        x, y = y, x
                    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0
                    union = len(x) + len(y) - both
                    far.append(1 - both / union if union else 1.0)
                    linked.append(union > 0 and 100 * both >= percent * union)
                yield pa.RecordBatch.from_arrays([some.column("u"), some.column("v"), pa.array(far, pa.float64()), pa.array(linked, pa.bool_())], ["u", "v", "far", "linked"])

    kind = pairs.schema["u"].dataType.simpleString()
    read = pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("text_u")), "u")
    read = read.join(texts.select(F.col("id").alias("v"), F.col("text").alias("text_v")), "v")
    out = read.select("u", "v", "text_u", "text_v").mapInArrow(run, f"u {kind}, v {kind}, far double, linked boolean")
    return stored(out.groupBy("u", "v").agg(F.min("far").alias("far"), F.max("linked").alias("linked")), "verified")


def near_duplicates(documents: DataFrame, words: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    A text's set: its distinct runs of ``words`` words (see ``text``), A-Z lower-cased; with fewer words
    the whole sequence; null, empty and blank texts have an empty set and are linked with nothing.
    Linked: 100 * intersection >= percent * union.  ``component_id`` is the smallest doc_id reachable
    by links, ``kept`` tells whether it is the row's own.  Rows that repeat a doc_id are one document,
    linked to whatever one of its texts is linked to.  Rows without a doc_id are linked with nothing and
    aren't kept; their component is null.  Columns besides doc_id and text are not looked at.
    """
    named = documents.select("doc_id", "text")
    sketches = stored(_sketches(named, words, bands, rows), "sketches")
    full = sketches.where("n > 0 AND doc_id IS NOT NULL")
    classes = full.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("id"))
    members = stored(sketches.select("doc_id", "n", "s1", "s2").join(classes, ["n", "s1", "s2"], "left").select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("id")).alias("id")), "members")
    entries = full.join(classes, ["n", "s1", "s2"]).where("doc_id = id").dropDuplicates(["n", "s1", "s2"]).select("id", "n", F.explode("keys").alias("key"))
    first = entries.groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("size")).where("size > 1").drop("size")
    shared = stored(entries.join(first, "key").distinct(), "shared-bands")
    wanted = shared.select("id").distinct()
    texts = stored(named.where("text IS NOT NULL").withColumnRenamed("doc_id", "id").join(wanted, "id", "left_semi").distinct(), "candidates")

    stars = shared.where("id <> first").groupBy(F.col("id").alias("u")).agg(F.min("first").alias("v"))
    done = [_verify(stars, texts, words, percent)]
    several = members.where("id IS NOT NULL").groupBy("doc_id").agg(F.min("id").alias("v"), F.max("id").alias("w")).where("v <> w")
    several = members.join(several, "doc_id").where("id <> v").select(F.col("id").alias("u"), "v")

    def connected() -> DataFrame:
        links = reduce(DataFrame.union, [d.where("linked").select("u", "v") for d in done])
        return stored(components(links.union(several)), "components")

    def open_buckets(found: DataFrame) -> DataFrame:
        """Members of buckets with more than one component."""
        own = shared.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
        split = own.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("key")
        return own.join(split, "key")

    found = connected()
    for turn in range(TURNS):
        own = open_buckets(found)
        drawn = own.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "id", F.lit(turn)), F.col("id").alias("v"), F.col("component").alias("c"))).alias("pivot"))
        stars = own.join(drawn, "key").where("component <> pivot.c").select("key", "id", F.col("pivot.v").alias("v"))
        some = stars.withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy(F.xxhash64("key", F.lit(turn))))).where(F.col("r") <= PIVOTS)
        stars = some.select(F.greatest("id", "v").alias("u"), F.least("id", "v").alias("v")).distinct()
        done.append(_verify(stars.join(reduce(DataFrame.union, done), ["u", "v"], "left_anti"), texts, words, percent))
        if not done[-1].where("linked").isEmpty():
            found = connected()
    # what is still open: members outside their bucket's largest component against all of other components
    bits = [F.get("parity", F.lit(k)).alias(f"b{k}") for k in range(PARITY // 64)]
    parity = full.join(classes, ["n", "s1", "s2"]).where("doc_id = id").select("id", "n", *bits).dropDuplicates(["id", "n"])
    own = open_buckets(found)
    largest = own.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m")).groupBy("key").agg(F.max(F.struct("m", "component")).alias("main"))
    own = own.join(largest, "key").withColumn("is_main", F.col("component") == F.col("main.component")).select("key", "id", "n", "component", "is_main")
    own = stored(own.join(parity, ["id", "n"]), "open-buckets")
    a, b = own.where("NOT is_main").alias("a"), own.alias("b")
    total = F.col("a.n") + F.col("b.n")
    apart = sum((F.bit_count(F.col(f"a.b{k}").bitwiseXOR(F.col(f"b.b{k}"))) for k in range(PARITY // 64)), F.lit(0))
    meets = (F.col("a.key") == F.col("b.key")) & (F.col("a.component") != F.col("b.component"))
    meets &= (F.col("b.is_main") | (F.col("a.id") < F.col("b.id"))) & ((100 + percent) * apart <= (100 - percent) * total)
    pairs = a.join(b, meets).select(F.greatest("a.id", "b.id").alias("u"), F.least("a.id", "b.id").alias("v")).distinct()
    done.append(_verify(pairs.join(reduce(DataFrame.union, done), ["u", "v"], "left_anti"), texts, words, percent))
    if not done[-1].where("linked").isEmpty():
        found = connected()
    out = members.join(found, "id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


_SPLIT = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
SQL = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_SPLIT} AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM sets),
counted AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common, any_value(a.n) + any_value(b.n) - count(*) AS either
  FROM shingles a JOIN shingles b ON a.sh = b.sh AND a.doc_id < b.doc_id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80
  GROUP BY a.doc_id, b.doc_id),
links AS (SELECT u, v FROM counted WHERE 100 * common >= 80 * either),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, v FROM reach JOIN both_ways ON reach.r = u)
SELECT s.doc_id, len(s) AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM sets s JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""


@register("op2_minhash", SQL)
def op2_minhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), words=2)
