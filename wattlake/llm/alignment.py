"""Alignment of two tokenizers' tokens over whole texts, by anchors at space-marked tokens.

Both tokenizers read the same bytes, a space and the text.  Where tokens of both end and the next tokens
carry a space mark, a text is split into windows of token ids.  Equal windows align alike wherever they
stand, so each distinct pair of id tuples is aligned once per block of texts, for all its windows at once.
Counts of linked ids over the corpus are sums over blocks; a block gets back only the counts of its own pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.packing import tokenizer_path
from wattlake.llm.shared import register, small_batches, stored, table
from wattlake.llm.text import Hasher, buffers, mix, slices
from wattlake.llm.tokens import encoder, model_of, released

#: Bytes of text in a block, more only where one text has more.
BLOCK = 1 << 19
#: Bits of a B id in a pair's code.
LOW = 24


class _Bytes:
    """The bytes of each token of a tokenizer."""

    def __init__(self, model) -> None:
        each = [model.bytes.get(i, b"") for i in range(model.size)]
        self.length = np.fromiter(map(len, each), np.int64, len(each))
        self.begin = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(each), np.uint8)

    @staticmethod
    def of(path: str) -> _Bytes:
        """Those of the tokenizer that this worker process has loaded."""
        model = model_of(path, False)
        if not hasattr(model, "joining"):
            model.joining = _Bytes(model)
        return model.joining

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.length[ids]
        to = np.cumsum(sizes)
        return self.flat[np.repeat(self.begin[ids] - (to - sizes), sizes) + np.arange(to[-1] if len(to) else 0)]


def with_space(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts, each but the empty ones after a space."""
    some = np.diff(offsets) > 0
    to = np.concatenate([[0], np.cumsum(np.diff(offsets) + some)])
    out = np.empty(to[-1], np.uint8)
    front = np.zeros(len(out), bool)
    front[to[:-1][some]] = True
    out[front], out[~front] = 32, data
    return out, to


def _differing(tokens: _Bytes, ids: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether the joined bytes of a text's tokens differ from the text."""
    ends = np.concatenate([[0], np.cumsum(tokens.length[ids])])
    bad = np.diff(ends[at]) != np.diff(offsets)
    if bad.any():
        ids = ids[np.repeat(~bad, np.diff(at))]
        kept = np.repeat(~bad, np.diff(offsets))
        where = np.flatnonzero(kept)[tokens.joined(ids) != data[kept]]
    else:
        where = np.flatnonzero(tokens.joined(ids) != data)
    bad[np.searchsorted(offsets, where, "right") - 1] = True
    return bad


class Windows:
    """Distinct windows: the ids of window ``w`` are ``a[a_at[w] : a_at[w + 1]]`` and likewise of B."""

    def __init__(self, a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray) -> None:
        self.a, self.a_at, self.b, self.b_at = a, a_at, b, b_at

    def take(self, rows: np.ndarray) -> Windows:
        def part(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            sizes = np.diff(at)[rows]
            to = np.concatenate([[0], np.cumsum(sizes)])
            return ids[np.repeat(at[:-1][rows] - to[:-1], sizes) + np.arange(to[-1])], to

        return Windows(*part(self.a, self.a_at), *part(self.b, self.b_at))

    @staticmethod
    def joined(parts: list[Windows]) -> Windows:
        def at(sizes: list[np.ndarray]) -> np.ndarray:
            return np.concatenate([[0], np.cumsum(np.concatenate(sizes))])

        return Windows(
            np.concatenate([p.a for p in parts]), at([np.diff(p.a_at) for p in parts]),
            np.concatenate([p.b for p in parts]), at([np.diff(p.b_at) for p in parts]),
        )

    def align(self, a_length: np.ndarray, b_length: np.ndarray) -> None:
        """Groups and links of all windows.

        ``ends_a``, ``ends_b``: index after each group's last token; ``group_at``, ``link_at``: each window's first
        group and link; ``code``: the linked ids of each link, A's in the high bits.
        """
        ends_a, ends_b = np.cumsum(a_length[self.a]), np.cumsum(b_length[self.b])
        total = int(ends_a[-1]) if len(ends_a) else 0
        at_a, at_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        at_a[ends_a], at_b[ends_b] = True, True
        self.ends_a, self.ends_b = np.flatnonzero(at_b[ends_a]) + 1, np.flatnonzero(at_a[ends_b]) + 1
        cuts = np.flatnonzero(at_a | at_b)
        of_a, of_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        self.code = (self.a[of_a].astype(np.int64) << LOW) | self.b[of_b].astype(np.int64)
        self.group_at = np.concatenate([[0], np.searchsorted(self.ends_a, self.a_at[1:], "right")])
        self.link_at = np.searchsorted(of_a, self.a_at)

    def texts(self) -> list[str]:
        """Of each window, its groups as ``a1,a2|b1;a3|b2,b3``."""
        a, b = list(map(str, self.a.tolist())), list(map(str, self.b.tolist()))
        out, x, y = [], 0, 0
        for u, v in zip(self.ends_a.tolist(), self.ends_b.tolist(), strict=True):
            out.append(f"{a[x]}|{b[y]}" if u - x == 1 == v - y else ",".join(a[x:u]) + "|" + ",".join(b[y:v]))
            x, y = u, v
        at = self.group_at.tolist()
        return [out[s] if e - s == 1 else ";".join(out[s:e]) for s, e in zip(at[:-1], at[1:], strict=True)]


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on, in as few bytes as the largest needs, all first bytes, then all second ones, compressed."""
    import zstandard

    width = 1 if not numbers.size else max(1, (int(numbers.max()).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(numbers.reshape(-1).astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(3).compress(np.ascontiguousarray(planes).tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : raw[0]] = planes.T
    return out.reshape(-1).view("<i8")


class _Block:
    """Texts that are tokenized and split into windows, until they are written as one row."""

    def __init__(self) -> None:
        self.size, self.docs, self.counts, self.windows, self.keys, self.at = 0, [], [], [], [], []

    def add(self, ids: pa.Array, texts: pa.Array, code_a, code_b, bytes_a: _Bytes, bytes_b: _Bytes, hasher: Hasher) -> None:
        data, offsets = with_space(*buffers(texts))
        (a, a_at), (b, b_at) = code_a.of_bytes(data, offsets), code_b.of_bytes(data, offsets)
        bad = _differing(bytes_a, a, a_at, data, offsets) | _differing(bytes_b, b, b_at, data, offsets)
        if bad.any():
            a, b, data = a[np.repeat(~bad, np.diff(a_at))], b[np.repeat(~bad, np.diff(b_at))], data[np.repeat(~bad, np.diff(offsets))]
        n_a, n_b, size = (np.where(bad, 0, np.diff(x)) for x in (a_at, b_at, offsets))
        ends_a, ends_b = np.cumsum(bytes_a.length[a]), np.cumsum(bytes_b.length[b])
        anchor = np.zeros(len(data) + 1, bool)
        anchor[:-1] = data == 32
        anchor[np.cumsum(size)[size > 0]] = True
        anchor[0] = False
        for ends in (ends_a, ends_b):
            both = np.zeros(len(anchor), bool)
            both[ends] = True
            anchor &= both
        w_a, w_b = np.flatnonzero(anchor[ends_a]) + 1, np.flatnonzero(anchor[ends_b]) + 1
        w_a, w_b = np.concatenate([[0], w_a]), np.concatenate([[0], w_b])

        def hashes(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
            return hasher(tokens.view(np.uint8), at[:-1] * tokens.itemsize, at[1:] * tokens.itemsize)

        keys, first, back = np.unique(mix(hashes(a, w_a) + np.uint64(0x9E3779B97F4A7C15)) ^ hashes(b, w_b), return_index=True, return_inverse=True)
        self.windows.append(Windows(a, w_a, b, w_b).take(first))
        self.keys.append(keys)
        self.at.append(back)
        self.docs.append(ids)
        self.counts.append(np.stack([n_a, n_b, np.diff(np.searchsorted(w_a[1:], np.concatenate([[0], np.cumsum(n_a)]), "right"))]))
        self.size += len(data)

    def row(self, number: int, bytes_a: _Bytes, bytes_b: _Bytes) -> pa.RecordBatch:
        _, first, back = np.unique(np.concatenate(self.keys), return_index=True, return_inverse=True)
        windows = Windows.joined(self.windows).take(first)
        starts = np.cumsum([0, *map(len, self.keys)])
        of = np.concatenate([back[s + x] for s, x in zip(starts[:-1], self.at, strict=True)])
        # frequent windows first: their small numbers compress well
        frequent = np.argsort(-np.bincount(of, minlength=len(first)), kind="stable")
        place = np.empty(len(first), np.int64)
        place[frequent] = np.arange(len(first))
        windows, of = windows.take(frequent), place[of]
        windows.align(bytes_a.length, bytes_b.length)
        code, back = np.unique(windows.code, return_inverse=True)
        times = np.repeat(np.bincount(of, minlength=len(first)), np.diff(windows.link_at))
        n = np.bincount(back, times, len(code)).astype(np.int64)
        counts = np.concatenate(self.counts, axis=1)
        blob = [counts, of, windows.a, np.diff(windows.a_at), windows.b, np.diff(windows.b_at)]
        docs = pa.concat_arrays(self.docs)
        whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()), whole(docs), whole(pa.array(code)), whole(pa.array(n)),
                whole(pa.array(list(map(_packed, blob)), pa.binary())),
            ],
            ["block", "docs", "code", "n", "blob"],
        )


def _blocks(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Blocks of texts: ids, windows, and how often each pair of ids is linked in the block."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code_a, code_b, hasher = encoder(path_a, False), encoder(path_b, False), Hasher()
        bytes_a, bytes_b = _Bytes.of(path_a), _Bytes.of(path_b)
        block, number = _Block(), TaskContext.get().partitionId() << 24
        for batch in batches:
            for some in slices(batch, "text", BLOCK // 2):
                block.add(some.column("doc_id"), some.column("text"), code_a, code_b, bytes_a, bytes_b, hasher)
                if block.size >= BLOCK:
                    yield block.row(number, bytes_a, bytes_b)
                    block, number = _Block(), number + 1
        if block.docs:
            yield block.row(number, bytes_a, bytes_b)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(lambda b: released(split(b)), f"block long, docs array<{kind}>, code array<long>, n array<long>, blob array<binary>")


def align(documents: DataFrame, tokenizer_a: str, tokenizer_b: str) -> tuple[DataFrame, DataFrame]:
    """(documents, links) of two tokenizers' tokens over space + text; A reads bytes, B is a piece model.

    documents: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups), a row per row given.  Groups
    lie between the places where tokens of both end; ``groups`` names their ids.  A link is a pair of tokens that
    share bytes; ``count_sum`` adds up how often each link's pair of ids is linked in the corpus, and ``n_best`` counts the
    links whose pair is the most frequent one of its B id, ties included.
    links: (a, b, count, best) of every pair of ids linked, ``best`` the highest count of that B id.

    Texts that are null or empty, or that the joined bytes of either tokenizer's tokens don't give back (a literal
    U+2581 becomes a space), have no tokens: zeros and an empty ``groups``.  Repeated rows and null ids count each
    for itself.  Special tokens' strings are plain text.  Other columns are not looked at.  An empty table gives no
    rows.  Windows are told apart by a 64-bit hash of their ids.
    """
    with small_batches(documents.sparkSession):
        blocks = stored(_blocks(documents, tokenizer_a, tokenizer_b), "alignment-blocks")
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("code", "n"))).select("block", "pos", "col.code", "col.n")
    counts = stored(pairs.groupBy("code").agg(F.sum("n").alias("count")), "alignment-counts")
    low = F.col("code").bitwiseAND(F.lit((1 << LOW) - 1))
    best = counts.groupBy(low.alias("b")).agg(F.max("count").alias("best"))
    counts = counts.withColumn("b", low).join(best, "b")
    scored = pairs.select("block", "pos", "code").join(counts, "code").select("block", "pos", "count", (F.col("count") == F.col("best")).alias("top"))

    def finish(counted: pa.Table, block: pa.Table) -> pa.Table:
        raw = [_unpacked(x) for x in block.column("blob")[0].as_py()]
        docs = block.column("docs").combine_chunks().flatten()
        (n_a, n_b, n_w), of = raw[0].reshape(3, -1), raw[1]
        windows = Windows(raw[2], np.concatenate([[0], np.cumsum(raw[3])]), raw[4], np.concatenate([[0], np.cumsum(raw[5])]))
        windows.align(_Bytes.of(tokenizer_a).length, _Bytes.of(tokenizer_b).length)
        _, back = np.unique(windows.code, return_inverse=True)
        count, top = np.zeros(counted.num_rows, np.int64), np.zeros(counted.num_rows, np.int64)
        at = counted.column("pos").to_numpy()
        count[at], top[at] = counted.column("count").to_numpy(), counted.column("top").to_numpy(zero_copy_only=False)
        to = np.concatenate([[0], np.cumsum(n_w)])

        def by_doc(per_window: np.ndarray) -> pa.Array:
            sums = np.concatenate([[0], np.cumsum(per_window[of])])
            return pa.array(np.diff(sums[to]), pa.int64())

        def by_window(per_link: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(per_link)])[windows.link_at])

        names, listed, at = windows.texts(), of.tolist(), to.tolist()
        groups = [";".join([names[i] for i in listed[s:e]]) for s, e in zip(at[:-1], at[1:], strict=True)]
        return pa.table(
            {
                "doc_id": docs, "n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": by_doc(np.diff(windows.group_at)),
                "n_links": by_doc(np.diff(windows.link_at)), "n_best": by_doc(by_window(top[back])),
                "count_sum": by_doc(by_window(count[back])), "groups": pa.array(groups, pa.string()),
            }
        )

    kind = documents.schema["doc_id"].dataType.simpleString()
    whole = blocks.select(F.col("block").alias("number"), "docs", "blob")
    rows = scored.groupBy("block").cogroup(whole.groupBy("number")).applyInArrow(
        finish, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    )
    return rows, counts.select(F.shiftright("code", LOW).alias("a"), "b", "count", "best")


@register("op11_alignment")
def op11_alignment(spark, sf_dir):
    rows, _ = align(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))
