"""Packing and token ids: exact cover, order, padding, special tokens."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from wattlake.llm.packing import pack_documents, pack_histogram, tokenizer_path
from wattlake.llm.tokens import encoder as encoder_of

ODD = [
    "", None, "a<|endoftext|>b  c", "  x   y\n\n z\t'S don't it's,ok...?! 12a'3   q", "é éé!　 x", "  a", "a  b ", "it 's 're\r\n\r\n  ",
    "日本 語 テ。 x", "x\x1c y\x85 z   w ", "A'LL we'll 12,3.4 '' 'd", "tab\tTab\x0bvt\x0cff", "!!! ...a .b 1.5.2", "ß. à, ×3 ÷ 4", " " * 50 + "end",
    "ΑΣ ΣΑΣ", "İi", "é < \u0338", "a'b'", "ab,'s", "µ ª ²  x", "<|startoftext|>A", "ABC'S",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_as_by_the_tokenizer(name):
    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    rng = random.Random(3)
    alphabet = " \t\n\x0b.,'!?aAbéÉ日\u00a0\u3000x1<|s²µΣ"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    for most in (24 << 20, 3000):
        encoder = encoder_of(tokenizer_path(name))
        encoder.known.most = most
        ids, where = encoder(pa.array(texts))
        for i, text in enumerate(texts):
            assert ids[where[i] : where[i + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("counts", [{}, {700: 100}, {10: 5000}, {1: 5, 2047: 3}, {1100: 50, 300: 7}, {1025: 9}, {2047: 1}])
def test_layout_covers_every_rest_once(counts):
    rows, packed = pack_histogram(counts)
    cover, fill = collections.defaultdict(list), collections.defaultdict(list)
    for rest, rank, n, start, size, sequence, offset in rows.tolist():
        for k in range(n):
            cover[rest, rank + k].append((start, size))
            fill[sequence + k].append((offset, size))
    assert set(cover) == {(rest, k) for rest, n in counts.items() for k in range(n)} and len(fill) == packed
    for length, parts in [(rest, p) for (rest, _), p in cover.items()] + [(None, p) for p in fill.values()]:
        at = 0
        for start, size in sorted(parts):
            assert start == at and size > 0
            at += size
        assert at == length if length else at <= 2048
    total = sum(rest * n for rest, n in counts.items())
    assert packed <= max(-(-total // 2048), total / (2048 * 0.99)) + 1


def test_documents_come_back_whole(documents, tokenizer):
    rng = random.Random(5)
    texts = [*ODD, "word " * 9000, *(" ".join(f"w{rng.randrange(99)}" for _ in range(rng.randint(1, 900))) for _ in range(40))]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "no id")]
    pieces = pack_documents(documents(rows).repartition(3), tokenizer_path()).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] > 0
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(by_doc) == {i for i, _ in rows}
    for i, text in rows:
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        copies = 2 if i == 3 else 1
        assert all(p["doc_tokens"] == len(want) for p in by_doc[i]) and sum(p["length"] for p in by_doc[i]) == copies * len(want)
        if copies == 1:
            assert np.concatenate([np.frombuffer(p["ids"], "<u4") for p in sorted(by_doc[i], key=lambda p: p["start"])]).tolist() == want
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) <= sum(p["length"] for p in pieces) / (2048 * 0.99) + 1


def test_no_documents(documents):
    assert pack_documents(documents([]), tokenizer_path()).collect() == []
