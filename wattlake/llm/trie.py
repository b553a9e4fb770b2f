"""Prefix trie of conversations: range-sorted shards, and a skeleton of the nodes that several shards share.

A conversation is a path, the digests of its turns one after another.  Paths are dealt out by range, so
all members of a node stand next to each other, and a node spans two shards only if the last path of one
and the first of the next both start with it.  These nodes are the skeleton; it is broadcast, its size bounded by the
number of shards times ``DEPTH``.  Every shard finishes all its other nodes itself and gives partial sums of the
skeleton's nodes, which are added up.

Turns beyond ``DEPTH`` don't go into paths.  Their nodes are grouped by a running digest of the turns, each of their sums
is put down to the node's smallest member, and a shard adds them where that member's path ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.llm.shared import register, stored, table

#: Turns of a conversation that are in its path.
DEPTH = 256
#: Bytes of a turn's digest.
DIGEST = 16
#: Turns in a shard, about.
PER_SHARD = 1 << 20
NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def running(rows: DataFrame, key: str, order: list[Column], parts: int, **values: tuple[str, Column]) -> DataFrame:
    """``rows`` with running values in each key's order: name = ("sum" or "bit_xor", column).

    Rows are dealt out by range, so a key with very many rows is in several tasks; what its earlier tasks have found
    is added from a table with fewer rows than there are parts.
    """
    dealt = stored(rows.repartitionByRange(parts, F.col(key), *order).withColumn("_part", F.spark_partition_id()), "dealt")
    here = Window.partitionBy("_part", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    found = dealt.groupBy(F.col("_part").alias("_p"), F.col(key).alias("_k")).agg(*[getattr(F, f)(x).alias(f"_{n}") for n, (f, x) in values.items()])
    carried = found.select("_p", "_k", F.count(F.lit(1)).over(earlier).alias("_n"), *[getattr(F, f)(f"_{n}").over(earlier).alias(f"_{n}") for n, (f, _) in values.items()])
    out = dealt.select("*", *[getattr(F, f)(x).over(here).alias(n) for n, (f, x) in values.items()])
    out = out.join(F.broadcast(carried.where("_n > 0").drop("_n")), (F.col("_part") == F.col("_p")) & (F.col(key) == F.col("_k")), "left")
    for n, (f, _) in values.items():
        before = F.coalesce(F.col(f"_{n}"), F.lit(0))
        out = out.withColumn(n, F.col(n) + before if f == "sum" else F.col(n).bitwiseXOR(before))
    return out.drop("_part", "_p", "_k", *[f"_{n}" for n in values])


def _parts(spark: SparkSession, rows: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PER_SHARD))


def _deep(turns: DataFrame, lengths: DataFrame, parts: int, depth: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes below ``depth``, ends there in pieces, what each conversation adds at its turn ``depth``).

    A node is known by its depth and a running digest of 128 bits.  Each node's sums are put down to its smallest member;
    a subtree's are the sums of what its members have been given from that depth on.
    """
    long = turns.join(lengths.where(F.col("n_turns") >= depth).select("conv_id"), "conv_id", "left_semi")
    halves = {"h": F.xxhash64("depth", "digest"), "g": F.xxhash64("digest", F.lit(7), "depth")}
    run = running(long, "conv_id", [F.col("depth")], parts, **{n: ("bit_xor", x) for n, x in halves.items()}).where(F.col("depth") >= depth)
    run = stored(run.select("conv_id", "depth", "size", "h", "g", *[F.col(n).bitwiseXOR(x).alias(f"up_{n}") for n, x in halves.items()]), "deep-turns")
    nodes = run.groupBy("depth", "h", "g").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("size").alias("size"), F.max("up_h").alias("up_h"), F.max("up_g").alias("up_g")
    )
    nodes = stored(nodes, "deep-nodes")
    under = nodes.where(F.col("depth") > depth)
    same = lambda a, b, c: (F.col("depth") == F.col(a)) & (F.col("h") == F.col(b)) & (F.col("g") == F.col(c))
    children = under.groupBy((F.col("depth") - 1).alias("d"), F.col("up_h").alias("uh"), F.col("up_g").alias("ug")).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select((F.col("depth") + 1).alias("pd"), F.col("h").alias("ph"), F.col("g").alias("pg"), F.col("conv_id").alias("parent_conv_id"))
    under = under.join(children, same("d", "uh", "ug"), "left").join(above, (F.col("depth") == F.col("pd")) & (F.col("up_h") == F.col("ph")) & (F.col("up_g") == F.col("pg")))
    under = under.select(
        "depth", "h", "g", "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
    )
    under = stored(under, "deep-nodes")
    mine = run.where(F.col("depth") > depth).select("conv_id", "depth", "h", "g")
    mine = mine.join(under.select("conv_id", "depth", "leaf", "saved"), ["conv_id", "depth"], "left").na.fill(0, ["leaf", "saved"])
    sums = running(mine, "conv_id", [F.col("depth").desc()], parts, n_leaves=("sum", F.col("leaf")), saved_tokens=("sum", F.col("saved")))
    sums = sums.groupBy("depth", "h", "g").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    added = under.groupBy("conv_id").agg(F.count_if(F.col("depth") == depth + 1).alias("deep_children"), F.sum("leaf").alias("deep_leaves"), F.sum("saved").alias("deep_saved"))
    last = lengths.withColumnRenamed("n_turns", "depth").where(F.col("depth") > depth)
    ends = run.select("conv_id", "depth", "h", "g").join(last, ["conv_id", "depth"]).withColumnRenamed("conv_id", "member")
    ends = ends.join(under.select("depth", "h", "g", "conv_id"), ["depth", "h", "g"]).groupBy("conv_id", "depth", F.shiftright("member", 12).alias("place"))
    ends = ends.agg(F.array_join(F.sort_array(F.collect_list("member")).cast("array<string>"), ",").alias("ends"))
    finished = under.join(sums, ["depth", "h", "g"]).select(*NODES, F.lit(None).cast("string").alias("ends"))
    return finished, ends, added


def _shared_turns(paths: list[bytes]) -> np.ndarray:
    """How many turns each path shares with the one before it."""
    same = np.zeros(len(paths), np.int64)
    for i in range(1, len(paths)):
        a, b = paths[i - 1], paths[i]
        short = min(len(a), len(b)) // DIGEST
        if a[: short * DIGEST] == b[: short * DIGEST]:
            same[i] = short
        else:
            same[i] = np.argmax(np.frombuffer(a, f"S{DIGEST}", short) != np.frombuffer(b, f"S{DIGEST}", short)) if short else 0
    return same


def _finish(shard: pa.Table, skeleton: dict[bytes, int]) -> pa.Table:
    """Nodes of one shard, from the deepest up.

    A node of the skeleton has its number in ``key`` and partial sums, without what the skeleton's own nodes
    add; other nodes are whole, ``up`` names the parent if that is of the skeleton.
    """
    raw, conv = shard.column("path").to_pylist(), shard.column("conv_id").to_numpy()
    order = np.array(sorted(range(len(raw)), key=lambda i: (raw[i], conv[i])), np.int64)
    raw, conv = [raw[i] for i in order.tolist()], conv[order]
    length = np.array([len(p) // DIGEST for p in raw], np.int64)
    same = _shared_turns(raw)
    sizes = pa.concat_arrays(shard.column("sizes").chunks).take(pa.array(order)).flatten().to_numpy()
    first_size = np.cumsum(length) - length
    deep = {c: shard.column(c).to_numpy()[order] for c in ("deep_children", "deep_leaves", "deep_saved")}
    more = shard.column("more").to_numpy(zero_copy_only=False)[order].astype(bool)
    levels, below = [], None
    for d in range(int(length.max()), -1, -1):
        rows = np.flatnonzero(length >= d)
        # paths between two with the same first d turns have these turns, too
        starts = rows[same[rows] < d] if d else rows[:1]
        if d and rows[0] != (starts[0] if len(starts) else -1):
            starts = np.concatenate([rows[:1], starts])
        at = np.searchsorted(rows, starts)
        count, least = np.diff(np.append(at, len(rows))), np.minimum.reduceat(conv[rows], at)
        size = sizes[first_size[starts] + d - 1] if d else np.zeros(len(starts), np.int64)
        ending = length[rows] == d
        children, leaves, saved = (np.add.reduceat(np.where(ending, deep[c][rows], 0), at) for c in ("deep_children", "deep_leaves", "deep_saved"))
        goes_on = np.logical_or.reduceat(ending & more[rows], at)
        key = np.array([skeleton.get(raw[s][: d * DIGEST], -1) for s in starts.tolist()], np.int64)
        if below is not None:
            mine = np.searchsorted(starts, below["start"], "right") - 1
            for into, what in ((children, below["key"] < 0), (leaves, below["n_leaves"]), (saved, below["saved_tokens"])):
                np.add.at(into, mine, what)
            goes_on[mine] = True
            below["up"] = key[mine]
            below["parent_conv_id"] = least[mine]
        leaves += (key < 0) & ~goes_on
        saved += np.where(key < 0, (count - 1) * size, 0)
        out = ending & ~more[rows]
        listed, ends = np.split(np.where(out, conv[rows], 0), at[1:]), np.split(out, at[1:])
        below = {
            "conv_id": least, "depth": np.full(len(starts), d), "parent_conv_id": np.full(len(starts), -1), "n_convs": count, "n_children": children,
            "n_leaves": leaves, "saved_tokens": saved, "key": key, "up": np.full(len(starts), -1), "size": size, "goes_on": goes_on.astype(np.int64),
            "start": starts, "ends": [",".join(map(str, np.sort(c[e]).tolist())) if e.any() else "" for c, e in zip(listed, ends, strict=True)],
        }
        levels.append(below)
    numbers = [*NODES, "key", "up", "size", "goes_on"]
    table = {c: pa.array(np.concatenate([x[c] for x in levels]).astype(np.int64)) for c in numbers}
    return pa.table({**table, "ends": pa.array([e for x in levels for e in x["ends"]], pa.string()), "shard": pa.array(np.full(len(table["key"]), shard.column("shard")[0].as_py()), pa.int32())})


def _skeleton(shards: DataFrame) -> tuple[dict[bytes, int], list[int]]:
    """(number of each node that spans shards, number of each one's parent); parents have smaller numbers, the root 0."""
    ends = shards.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high")).orderBy("shard").collect()  # two paths a shard
    known, parent = {b"": 0}, [-1]
    for one, two in zip(ends[:-1], ends[1:], strict=True):
        a, b, same, at = bytes(one["high"]), bytes(two["low"]), DIGEST, 0
        while same <= min(len(a), len(b)) and a[:same] == b[:same]:
            if a[:same] not in known:
                known[a[:same]] = len(parent)
                parent.append(at)
            at, same = known[a[:same]], same + DIGEST
    return known, parent


def _reduced(partial: DataFrame, parent: list[int]) -> list[tuple]:
    """The skeleton's nodes as (number, *NODES): the partial sums of all shards, and what the skeleton's own nodes add as
    children, as leaves and in what they save."""
    total = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    sums = partial.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("size").alias("size"), F.max("goes_on").alias("goes_on"), *total)
    of = {r["key"]: r.asDict() for r in sums.collect()}  # as many rows as the skeleton has nodes
    for key in sorted(of, reverse=True):
        node = of[key]
        node["n_leaves"] += not node["goes_on"]
        node["saved_tokens"] += (node["n_convs"] - 1) * node["size"]
        node["own"] = {"n_leaves": int(not node["goes_on"]), "saved_tokens": (node["n_convs"] - 1) * node["size"]}
    for key in sorted(of, reverse=True):
        if key:
            up = of[parent[key]]
            up["n_children"] += 1
            for c, n in of[key]["own"].items():
                up["own"][c] += n
                up[c] += n
    return [(k, n["conv_id"], n["depth"], of[parent[k]]["conv_id"] if k else None, n["n_convs"], n["n_children"], n["n_leaves"], n["saved_tokens"]) for k, n in of.items()]


def prefix_trie(turns: DataFrame, conversations: DataFrame, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends in pieces) of the trie of conversations.

    ``conversations``: (conv_id), each once, also those without turns; ``turns``: (conv_id, depth from 1 without gaps, digest
    of 16 bytes, size).  nodes: a row per distinct sequence of first turns, (conv_id, its smallest member; depth; parent_conv_id, the
    parent's conv_id; n_convs, its members; n_children; n_leaves and saved_tokens of its subtree; ends).  ``ends`` lists
    the members that have no further turn, ascending and joined by commas; where it is null, they are in the pieces
    (conv_id, depth, place, ends), one after another by ``place``.  No conversations give no rows.
    """
    spark = turns.sparkSession
    lengths = stored(conversations.join(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns")), "conv_id", "left").na.fill(0, ["n_turns"]), "lengths")
    deepest, total = lengths.agg(F.max("n_turns"), F.sum("n_turns")).first()
    parts = _parts(spark, total or 0)
    step = F.sort_array(F.collect_list(F.struct("depth", F.hex("digest").alias("x"), "size")))
    paths = turns.where(F.col("depth") <= depth).groupBy("conv_id").agg(step.alias("s"))
    paths = paths.select("conv_id", F.unhex(F.array_join("s.x", "")).alias("path"), F.col("s.size").alias("sizes"))
    paths = lengths.join(paths, "conv_id", "left").select(
        "conv_id", F.coalesce("path", F.lit(b"")).alias("path"), F.coalesce("sizes", F.array().cast("array<bigint>")).alias("sizes"), (F.col("n_turns") > depth).alias("more")
    )
    finished, pieces = None, None
    if (deepest or 0) > depth:
        finished, pieces, added = _deep(turns, lengths, parts, depth)
        paths = paths.join(added, "conv_id", "left").na.fill(0, ["deep_children", "deep_leaves", "deep_saved"])
    else:
        paths = paths.select("*", *[F.lit(0).cast("long").alias(c) for c in ("deep_children", "deep_leaves", "deep_saved")])
    shards = stored(paths.repartitionByRange(parts, "path", "conv_id").withColumn("shard", F.spark_partition_id()), "shards")
    known, parent = _skeleton(shards)
    sent = spark.sparkContext.broadcast(known)  # at most ``depth`` nodes for each border between shards
    numbers = ", ".join(f"{c} long" for c in [*NODES, "key", "up", "size", "goes_on"])
    done = stored(shards.groupBy("shard").applyInArrow(lambda shard: _finish(shard, sent.value), f"{numbers}, ends string, shard int"), "trie-nodes")
    skeleton = spark.createDataFrame(_reduced(done.where("key >= 0"), parent), f"number long, {', '.join(f'{c} long' for c in NODES)}")
    whole = done.where("key < 0").join(F.broadcast(skeleton.select("number", F.col("conv_id").alias("up_conv"))), F.col("up") == F.col("number"), "left")
    whole = whole.withColumn("parent_conv_id", F.coalesce("up_conv", "parent_conv_id")).select(*NODES, "ends")
    nodes = whole.union(skeleton.select(*NODES, F.lit(None).cast("string").alias("ends")))
    parted = done.where("key >= 0 AND ends <> ''").select("key", F.col("shard").cast("long").alias("place"), "ends")
    parted = parted.join(F.broadcast(skeleton.select("number", "conv_id", "depth")), F.col("key") == F.col("number")).select("conv_id", "depth", "place", "ends")
    return (nodes, parted) if finished is None else (nodes.union(finished), parted.union(pieces.select("conv_id", "depth", "place", "ends")))


def digest_ends(pieces: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of lists in pieces (conv_id, depth, place, ends), hashed piece after piece."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, state.hexdigest())], ["conv_id", "depth", "ends_sha256"])

        for batch in batches:
            for conv, depth, ends in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "ends")), strict=True):
                if (conv, depth) != now:
                    if now:
                        yield row()
                    now, state = (conv, depth), hashlib.sha256(ends.encode())
                else:
                    state.update(b"," + ends.encode())
        if now:
            yield row()

    dealt = pieces.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "place")
    return dealt.mapInArrow(digest, "conv_id long, depth long, ends_sha256 string")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) as ``prefix_trie`` takes them, of (conv_id, turn, role, text).

    Turns are ordered by number, null first, then by a digest of role and text; a null role or text is empty, and
    repeated rows are turns each for itself.  Conversation c becomes the first h turns of conversation c - c % 5, then its
    own turns after its first h, h = crc32(c as text) % 9.  Rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    turns = running(turns, "conv_id", [F.col("turn").asc_nulls_first(), F.col("digest")], _parts(rows.sparkSession, turns.count()), place=("sum", F.lit(1)))
    turns = stored(turns.select("conv_id", "place", "digest", "size"), "turns")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    known = stored(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "conversations")
    based = known.select("conv_id", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    based = based.join(known.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left").select(
        "conv_id", "h", "base", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken")
    )
    own = turns.join(based, "conv_id").where("place > h").select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "digest", "size")
    heads = turns.where("place <= 8 AND conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "digest", "size")
    heads = heads.join(based, "base").where("depth <= h").select("conv_id", "depth", "digest", "size")
    return stored(own.union(heads), "rebuilt"), known.select("conv_id")


#: crc32 of a decimal number, bit by bit over its characters.
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
    lambda x: [ord(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))"""


@register("op13_trie", f"""
WITH turns AS (
    SELECT conv_id, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
        strlen(coalesce(text, '')) AS size, turn
    FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT conv_id, digest, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS place FROM turns),
known AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id),
based AS (
    SELECT k.conv_id, k.h, k.conv_id - k.conv_id % 5 AS base, least(k.h, coalesce(b.n, 0)) AS taken
    FROM (SELECT conv_id, {CRC32} % 9 AS h FROM known) k LEFT JOIN known b ON b.conv_id = k.conv_id - k.conv_id % 5),
rebuilt AS (
    SELECT conv_id, place - h + taken AS depth, digest, size FROM placed JOIN based USING (conv_id) WHERE place > h
    UNION ALL SELECT b.conv_id, place AS depth, digest, size FROM placed p JOIN based b ON b.base = p.conv_id WHERE place <= h),
lengths AS (SELECT conv_id, count(depth) AS n FROM known LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id),
members AS (
    SELECT conv_id, depth, size, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM rebuilt
    UNION ALL SELECT conv_id, 0, 0, '' FROM known),
nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size, count_if(n = depth) AS n_ends,
        string_agg(CASE WHEN n = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends
    FROM members JOIN lengths USING (conv_id) GROUP BY path, depth),
linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id, coalesce(c.n_children, 0) AS n_children
    FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, 32 * (n.depth - 1)::INT)
    LEFT JOIN (SELECT left(path, 32 * (depth - 1)::INT) AS up, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1) c ON c.up = n.path),
under AS (
    SELECT m.path, sum(l.leaf) AS n_leaves, sum(l.saved) AS saved_tokens
    FROM members m JOIN (SELECT conv_id, depth, (n_children = 0)::INT AS leaf, (n_convs - 1) * size AS saved FROM linked) l
        ON l.conv_id = m.conv_id AND l.depth >= m.depth GROUP BY m.path)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
    sha256(coalesce(ends, '')) AS ends_sha256
FROM linked JOIN under USING (path)""")
def op13_trie(spark, sf_dir):
    nodes, pieces = prefix_trie(*rebuilt(table(spark, sf_dir, "conversations")))
    parted = digest_ends(pieces).withColumnRenamed("ends_sha256", "parted")
    nodes = nodes.join(parted, ["conv_id", "depth"], "left")
    digest = F.coalesce("parted", F.sha2(F.coalesce("ends", F.lit("")), 256))
    return nodes.select(*NODES, digest.alias("ends_sha256"))
