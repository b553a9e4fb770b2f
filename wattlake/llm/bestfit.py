"""Packing token pieces into few sequences: best-fit decreasing in partitions whose counts are certified.

Dual feasible functions bound from below how many sequences the pieces of a partition need, and all pieces.
While all partitions together use more than the bound over all pieces, they exchange: each gives the
documents of its emptiest sequences to a partition it shares with others, which packs them anew.  Full
sequences, and those a partition keeps, stay as they are.  What a partition gives is bounded, and so is
what a shared one gets, so every round is smaller than the one before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.packing import tokenizer_path
from wattlake.llm.shared import register, stored, table
from wattlake.llm.text import slices
from wattlake.llm.tokens import encoder, released

CAPACITY = 2048
END_ID = 0
#: Pieces that a partition packs at once, about.
PER_PARTITION = 100_000
#: Partitions that give to the same one.
SHARED_BY = 8
#: Multipliers of the rounding functions that the bound tries.
ROUNDINGS = 100


def least_bins(histogram: np.ndarray) -> int:
    """A number of bins that pieces with these counts by length need at least; the capacity is the longest length.

    The largest of three kinds of dual feasible functions, in whole numbers: lengths as they are; lengths above
    ``capacity - e`` as whole bins and those below ``e`` as nothing, for every e; and lengths rounded down to
    multiples of ``capacity / (k + 1)`` but counted in k-ths.
    """
    capacity = len(histogram) - 1
    length = np.arange(capacity + 1)
    count, tokens = np.cumsum(histogram), np.cumsum(histogram * length)
    e = np.arange(capacity // 2 + 1)
    above = count[-1] - count[capacity - e]
    between = tokens[capacity - e] - np.where(e > 0, tokens[np.maximum(e, 1) - 1], 0)
    best = int((above - (-between // capacity)).max())
    for k in range(1, ROUNDINGS + 1):
        value = np.where(length * (k + 1) % capacity == 0, length * k, length * (k + 1) // capacity * capacity)
        best = max(best, -int(-(histogram * value).sum() // (k * capacity)))
    return best


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """(bin of each length, its offset there, free places of each bin): each into the fullest bin that has room."""
    bins, offsets, free = [], [], []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: there are bins with r free places
    for n in lengths:
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            b, room = len(free), capacity
            free.append(capacity)
        bins.append(b)
        offsets.append(capacity - room)
        room -= n
        free[b] = room
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    return bins, offsets, free


def _repacked(pieces: pa.Table, number: int, capacity: int, give: int) -> pa.Table:
    """The pieces of one partition in bins; ``open`` marks those of the emptiest bins, about ``give`` of them."""
    key, length, old, part = (pieces.column(c).to_numpy() for c in ("key", "length", "bin", "part"))
    order = np.lexsort((key, -length))
    key, length, old, offset = key[order], length[order], old[order], pieces.column("offset").to_numpy()[order]
    bins, offsets, free = best_fit(length.tolist(), capacity)
    if number and len(free) >= (offset == 0).sum():
        names, bins = np.unique(old, return_inverse=True)
        free = capacity - np.bincount(bins, length).astype(np.int64)
    else:
        bins, offset, free = np.array(bins, np.int64), np.array(offsets, np.int64), np.array(free, np.int64)
        names = (((int(part[0]) << 20) + np.arange(len(free))) << 6) + number
    held = np.bincount(bins, minlength=len(free))
    emptiest = np.argsort(-free, kind="stable")
    opened = np.zeros(len(free), bool)
    opened[emptiest] = (np.cumsum(held[emptiest]) <= give) & (free[emptiest] > 0)
    bound = least_bins(np.bincount(length, minlength=capacity + 1))
    return pa.table(
        {
            "part": part, "key": key, "length": length, "bin": names[bins], "offset": offset, "open": opened[bins],
            "bound": np.full(len(key), bound),
        }
    )


def _packer(number: int, capacity: int, give: int):
    return lambda pieces: _repacked(pieces, number, capacity, give)


def pack_lengths(
    pieces: DataFrame, capacity: int = CAPACITY, per_partition: int = PER_PARTITION, shared_by: int = SHARED_BY
) -> tuple[DataFrame, DataFrame]:
    """(places, certificates) of pieces (key, length), lengths from 1 to ``capacity``, keys distinct.

    places: (key, bin, offset); the pieces of a bin stand gapless from offset 0.  certificates: (round, part, bins, bound), how
    many bins each partition used and needs at least, and a last row with a null round and part for all pieces.
    """
    spark = pieces.sparkSession
    histogram = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # as many rows as there are lengths
        histogram[row["length"]] = row["count"]
    bound, parts = least_bins(histogram), max(1, -(-int(histogram.sum()) // per_partition))
    left = pieces.select(F.pmod(F.xxhash64("key"), F.lit(parts)).alias("part"), "key", "length", F.lit(-1).cast("long").alias("bin"), F.lit(0).cast("long").alias("offset"))
    places, certificates, settled, number = [], [], 0, 0
    give = max(1, per_partition // shared_by)
    while True:
        packed = left.groupBy("part").applyInArrow(_packer(number, capacity, give), "part long, key long, length long, bin long, offset long, open boolean, bound long")
        packed = stored(packed, "best-fit")
        used = packed.groupBy("part").agg(F.count_if(F.col("offset") == 0).alias("bins"), F.max("bound").alias("bound"))
        certificates.append(used.select(F.lit(number).alias("round"), "part", "bins", "bound"))
        here = packed.where("offset = 0").groupBy("open").count().collect()
        total = settled + sum(r["count"] for r in here)
        if parts == 1 or total <= bound:
            places.append(packed)
            break
        places.append(packed.where("NOT open"))
        settled += sum(r["count"] for r in here if not r["open"])
        left = packed.where("open").withColumn("part", F.floor(F.col("part") / shared_by)).select("part", "key", "length", "bin", "offset")
        parts, number = -(-parts // shared_by), number + 1
    whole = spark.createDataFrame([(None, None, total, bound)], "round int, part long, bins long, bound long")
    for each in certificates:
        whole = whole.union(each)
    out = places[0].select("key", "bin", "offset")
    for each in places[1:]:
        out = out.union(each.select("key", "bin", "offset"))
    return out, whole


def _pieces(documents: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of every row's ids, numbered by task and place."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        code, press, made = encoder(path), zstandard.ZstdCompressor(1), TaskContext.get().partitionId() << 36
        for batch in batches:
            for some in slices(batch, "text", 1 << 20):
                ids, where = code(some.column("text"))
                size = np.diff(where) + 1
                to = np.cumsum(size)
                whole = np.empty(to[-1], np.uint32 if max(end_id, code.model.size) > 1 << 16 else np.uint16)
                last = np.zeros(len(whole), bool)
                last[to - 1] = True
                whole[last], whole[~last] = end_id, ids
                pieces = -(-size // capacity)
                of = np.repeat(np.arange(len(size)), pieces)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(capacity, size[of] - start)
                low = (to - size)[of] + start
                blobs = [press.compress(whole[a:b].tobytes()) for a, b in zip(low.tolist(), (low + length).tolist(), strict=True)]
                keys = made + np.arange(len(of))
                made += len(of)
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id").take(pa.array(of)), pa.array(keys), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(blobs, pa.binary())],
                    ["doc_id", "key", "piece", "start", "length", "blob"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(lambda b: released(cut(b)), f"doc_id {kind}, key long, piece int, start long, length long, blob binary")


def pack_best_fit(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, per_partition: int = PER_PARTITION, shared_by: int = SHARED_BY
) -> tuple[DataFrame, DataFrame]:
    """(pieces, certificates) of all documents in as few sequences as can be found.

    pieces: (doc_id, piece, start, length, ids, sequence_id, offset).  A document is its token ids and ``end_id``; a
    null or empty text is ``end_id`` alone.  Only documents longer than ``capacity`` are cut, into pieces of that
    length and a last one that may be shorter; full pieces are sequences of their own.  ``ids`` are unsigned
    little-endian 32-bit numbers.  Repeated rows and null ids are packed each for itself.  Other columns are not
    looked at.  An empty table gives no rows.  certificates: as of ``pack_lengths``, without the full pieces.
    """
    if capacity < 2:
        raise ValueError("capacity must be 2 at least")
    pieces = stored(_pieces(documents, tokenizer, capacity, end_id), "pieces")
    places, certificates = pack_lengths(pieces.where(F.col("length") < capacity).select("key", "length"), capacity, per_partition, shared_by)
    # places grow with the documents, so they are never sent to every task
    joined = pieces.join(places.withColumnRenamed("key", "_key").hint("merge"), F.col("key") == F.col("_key"), "left")
    sequence = F.when(F.col("bin").isNull(), F.col("key") * 2).otherwise(F.col("bin") * 2 + 1)
    joined = joined.select("doc_id", "piece", "start", "length", "blob", sequence.alias("sequence_id"), F.coalesce("offset", F.lit(0)).alias("offset"))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            raw = [unpress.decompress(b) for b in batch.column("blob").to_pylist()]
            ids = [np.frombuffer(r, np.uint32 if len(r) == 4 * n else np.uint16).astype("<u4").tobytes() for r, n in zip(raw, batch.column("length").to_pylist(), strict=True)]
            yield batch.set_column(batch.schema.get_field_index("blob"), "ids", pa.array(ids, pa.binary()))

    kind = documents.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(unpack, f"doc_id {kind}, piece int, start long, length long, ids binary, sequence_id long, offset long"), certificates


@register("op12_bestfit")
def op12_bestfit(spark, sf_dir):
    pieces, _ = pack_best_fit(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
