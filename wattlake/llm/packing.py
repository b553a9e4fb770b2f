"""Packing token pieces into sequences: shortest pack first over the histogram of piece lengths.

Documents are cut at multiples of the sequence length.  Full pieces are sequences of their own; of
the rests only the histogram (at most ``capacity`` numbers) is packed, on the driver.  A rest then
finds its places by its rank among the rests of its length.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.shared import register, stored, table
from wattlake.llm.text import slices
from wattlake.llm.tokens import encoder, released

CAPACITY = 2048
END_ID = 1
#: Packs are dissolved, their pieces cut to fill the gaps of others, until no more than this share is padding.
MAX_PADDING = 0.01
#: Bytes of the parts' ranks that are sent to every task at most.
BROADCAST = 64 << 20


class _Pack:
    """``count`` equal packs with ``gap`` free places.  ``parts``: of each piece (length of the rest,
    rank of the first pack's rest, start in the rest, length of the part, offset in the pack)."""

    __slots__ = ("count", "gap", "parts")

    def __init__(self, count: int, gap: int, parts: tuple) -> None:
        self.count, self.gap, self.parts = count, gap, parts

    def split(self, k: int) -> tuple[_Pack, _Pack | None]:
        """The first ``k`` packs and the others."""
        if k == self.count:
            return self, None
        later = tuple((rest, rank + k, start, size, at) for rest, rank, start, size, at in self.parts)
        return _Pack(k, self.gap, self.parts), _Pack(self.count - k, self.gap, later)

    def plus(self, rest: int, rank: int, start: int, size: int, capacity: int) -> _Pack:
        return _Pack(self.count, self.gap - size, (*self.parts, (rest, rank, start, size, capacity - self.gap)))


def pack_histogram(counts: dict[int, int], capacity: int = CAPACITY, max_padding: float = MAX_PADDING) -> tuple[np.ndarray, int]:
    """(rows of (rest, first rank, ranks, start, length, first sequence, offset), number of sequences).

    Longest rests first, each into the pack that is shortest so far, a new one if it doesn't fit.
    Equal packs are handled together: a step extends all packs of a kind or places all rests of a length.
    """
    heap: list[tuple[int, int, _Pack]] = []
    made = 0

    def push(pack: _Pack | None) -> None:
        nonlocal made
        if pack is not None:
            heapq.heappush(heap, (-pack.gap, made, pack))
            made += 1

    for rest in sorted(counts, reverse=True):
        rank, left = 0, counts[rest]
        while left:
            if heap and -heap[0][0] >= rest:
                pack, others = (p := heapq.heappop(heap)[2]).split(min(left, p.count))
                push(others)
                push(pack.plus(rest, rank, 0, rest, capacity))
                rank, left = rank + pack.count, left - pack.count
                continue
            for each in (capacity // rest, left % (capacity // rest)):
                n = left // each if each else 0
                if n:
                    pack = _Pack(n, capacity, ())
                    for k in range(each):
                        pack = pack.plus(rest, rank + k * n, 0, rest, capacity)
                    push(pack)
                    rank, left = rank + n * each, left - n * each
    packs = _fill_gaps([p for _, _, p in heap], capacity, max_padding)
    rows, at = [], 0
    for pack in packs:
        rows += [(rest, rank, pack.count, start, size, at, offset) for rest, rank, start, size, offset in pack.parts]
        at += pack.count
    return np.array(sorted(rows), np.int64).reshape(-1, 7), at


def _fill_gaps(packs: list[_Pack], capacity: int, max_padding: float) -> list[_Pack]:
    """Dissolve the emptiest packs into the largest gaps of the others until ``max_padding`` holds."""
    total = sum(p.count * (capacity - p.gap) for p in packs)
    surplus = sum(p.count for p in packs) - max(-(-total // capacity), int(total / (capacity * (1 - max_padding))))
    packs = sorted(packs, key=lambda p: p.gap)
    while surplus > 0 and len(packs):
        donor = packs.pop()
        fill, room = capacity - donor.gap, sum(p.count * p.gap for p in packs)
        # the donors that stay give room, too
        n = min(surplus, donor.count, (room + donor.count * donor.gap) // (fill + donor.gap) if donor.count > 1 else room // fill)
        if n <= 0:
            return [*packs, donor]
        donor, stay = donor.split(n)
        if stay is not None:
            packs.append(stay)
        heap = [(-p.gap, i, p) for i, p in enumerate(packs)]
        heapq.heapify(heap)
        made = len(heap)
        pool = [(n, rest, rank, start, size) for rest, rank, start, size, _ in donor.parts]
        while pool:
            left, rest, rank, start, size = pool.pop()
            into, others = (p := heapq.heappop(heap)[2]).split(min(left, p.count))
            part = min(size, into.gap)
            into = into.plus(rest, rank, start, part, capacity)
            for p in (into, others):
                if p is not None:
                    heapq.heappush(heap, (-p.gap, made, p))
                    made += 1
            if left > into.count:
                pool.append((left - into.count, rest, rank + into.count, start, size))
            if size > part:
                pool.append((into.count, rest, rank, start + part, size - part))
        packs = sorted((p for _, _, p in heap), key=lambda p: p.gap)
        surplus -= n
    return packs


def _tokenized(documents: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """Ids of every row, with its part (task), the length of its rest, the rank of the rest and of its
    first full piece among those of the part."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        part = TaskContext.get().partitionId()
        seen, full = np.zeros(capacity, np.int64), 0
        press = zstandard.ZstdCompressor(1)
        code = encoder(path)
        for batch in batches:
            for some in slices(batch, "text", 1 << 20):
                ids, where = code(some.column("text"))
                size = np.diff(where) + 1
                rest, pieces = size % capacity, size // capacity
                order = np.argsort(rest, kind="stable")
                grouped = rest[order]
                local = np.empty(len(size), np.int64)
                local[order] = seen[grouped] + np.arange(len(size)) - np.searchsorted(grouped, grouped)
                seen += np.bincount(rest, minlength=capacity)
                first = full + np.cumsum(pieces) - pieces
                full += int(pieces.sum())
                to = np.cumsum(size)
                whole = np.empty(to[-1], np.uint32 if end_id >= 1 << 16 else ids.dtype)
                last = np.zeros(len(whole), bool)
                last[to - 1] = True
                whole[last], whole[~last] = end_id, ids
                blobs = [press.compress(whole[a:b].tobytes()) for a, b in zip((to - size).tolist(), to.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array(np.full(len(size), part, np.int32)), pa.array(size), pa.array(rest), pa.array(local), pa.array(pieces), pa.array(first), pa.array(blobs, pa.binary())],
                    ["doc_id", "part", "doc_tokens", "rest", "local", "pieces", "local_full", "blob"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        lambda b: released(encode(b)), f"doc_id {kind}, part int, doc_tokens long, rest long, local long, pieces long, local_full long, blob binary"
    )


def pack_documents(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, max_padding: float = MAX_PADDING
) -> DataFrame:
    """Pieces of all documents: (doc_id, start, length, ids, doc_tokens, sequence_id, offset).

    A document is its token ids and ``end_id``; a null or empty text is ``end_id`` alone.  ``ids`` holds
    the piece's ids as unsigned little-endian 32-bit numbers.  Every id is in one piece; the pieces of a sequence stand
    gapless from offset 0 and are ``capacity`` long together at most.  Repeated rows are packed each
    for itself.  Other columns are not looked at.  An empty table gives no rows.
    """
    if capacity < 2:
        raise ValueError("capacity must be 2 at least")
    tokens = stored(_tokenized(documents, tokenizer, capacity, end_id), "tokens")
    by_part = tokens.groupBy("part", "rest").agg(F.count(F.lit(1)).alias("n"), F.sum("pieces").alias("full"))
    by_part = stored(by_part, "rests")
    counts = {r["rest"]: r["n"] for r in by_part.where("rest > 0").groupBy("rest").agg(F.sum("n").alias("n")).collect()}  # below capacity rows
    layout, packed = pack_histogram(counts, capacity, max_padding)
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    full = by_part.groupBy("part").agg(F.sum("full").alias("full"))
    full = full.select(F.col("part").alias("p"), F.coalesce(F.sum("full").over(before(Window.orderBy("part"))), F.lit(0)).alias("before_full"))
    ranks = by_part.withColumn("before", F.coalesce(F.sum("n").over(before(Window.partitionBy("rest").orderBy("part"))), F.lit(0)))

    def dense(rows: pa.Table) -> pa.Table:
        values = np.zeros(capacity, np.int64)
        values[rows.column("rest").to_numpy()] = rows.column("before").to_numpy()
        return pa.table({"part": rows.column("part")[:1], "before": pa.array([values])})

    # one row a part; sent to every task only while it is small, however many parts there are
    starts = stored(ranks.select("part", "rest", "before").groupBy("part").applyInArrow(dense, "part int, before array<long>"), "starts")
    small = starts.count() * capacity * 8 <= BROADCAST
    starts = starts.join(full, F.col("part") == F.col("p")).select("part", "before", "before_full").hint("broadcast" if small else "merge")
    ranked = tokens.join(starts, "part").select(
        "doc_id", "doc_tokens", "rest", "pieces", (F.col("before")[F.col("rest").cast("int")] + F.col("local")).alias("rank"),
        (F.col("before_full") + F.col("local_full")).alias("first"), "blob",
    )
    bounds = np.searchsorted(layout[:, 0], np.arange(capacity + 1))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            size, rest, pieces, rank, first = (batch.column(c).to_numpy() for c in ("doc_tokens", "rest", "pieces", "rank", "first"))
            of, start, length, sequence, offset = [], [], [], [], []
            row = np.repeat(np.arange(len(size)), pieces)
            k = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            of.append(row), start.append(k * capacity), length.append(np.full(len(row), capacity))
            sequence.append(packed + first[row] + k), offset.append(np.zeros(len(row), np.int64))
            order = np.argsort(rest, kind="stable")
            for value in np.unique(rest[rest > 0]):
                rows = order[np.searchsorted(rest[order], value) : np.searchsorted(rest[order], value, "right")]
                own = layout[bounds[value] : bounds[value + 1]]
                gap = rank[rows][:, None] - own[None, :, 1]
                r, e = np.nonzero((gap >= 0) & (gap < own[None, :, 2]))
                of.append(rows[r]), start.append(pieces[rows[r]] * capacity + own[e, 3]), length.append(own[e, 4])
                sequence.append(own[e, 5] + gap[r, e]), offset.append(own[e, 6])
            of, start, length, sequence, offset = map(np.concatenate, (of, start, length, sequence, offset))
            order = np.argsort(of, kind="stable")
            of, start, length, sequence, offset = of[order], start[order], length[order], sequence[order], offset[order]
            ids: list[bytes] = []
            blobs = batch.column("blob")
            last, now = -1, np.zeros(0, np.uint32)
            for i, s, n in zip(of.tolist(), start.tolist(), length.tolist(), strict=True):
                if i != last:
                    raw = unpress.decompress(blobs[i].as_py())
                    last, now = i, np.frombuffer(raw, np.uint32 if len(raw) == 4 * size[i] else np.uint16).astype("<u4")
                ids.append(now[s : s + n].tobytes())
            docs = batch.column("doc_id").take(pa.array(of))
            yield pa.RecordBatch.from_arrays(
                [docs, pa.array(start), pa.array(length), pa.array(ids, pa.binary()), pa.array(size[of]), pa.array(sequence), pa.array(offset)],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(place, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op10_packing")
def op10_packing(spark, sf_dir):
    pieces = pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
