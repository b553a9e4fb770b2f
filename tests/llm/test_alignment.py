"""Tokens of two tokenizers aligned, against a search over all pairs of tokens."""

import collections
import hashlib
import random

import pytest
import sentencepiece
from tokenizers import Tokenizer

from wattlake.llm import alignment
from wattlake.llm.alignment import align
from wattlake.llm.packing import tokenizer_path

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
SHA = lambda text: hashlib.sha256(text.encode()).hexdigest()


def letters():
    """The byte of each letter of the byte-level vocabulary, by the published rule."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}


@pytest.fixture(scope="module")
def tokens():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letter = letters()

    def piece(i):
        name = b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    def of(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw_a = [bytes(letter[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [piece(i) for i in ids_b]
        if not text or b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            return [], []
        return list(zip(ids_a, raw_a)), list(zip(ids_b, raw_b))

    return of


def plain(rows, tokens):
    """The same by comparing every token of A with every token of B."""
    spans = []
    for _, text in rows:
        both = []
        for found in tokens(text or ""):
            at, out = 0, []
            for i, raw in found:
                out.append((i, at, at + len(raw)))
                at += len(raw)
            both.append(out)
        spans.append(both)
    links = [[(i, j) for i, s, e in a for j, u, v in b if s < v and u < e] for a, b in spans]
    count = collections.Counter(x for per in links for x in per)
    best = collections.defaultdict(int)
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    out = []
    for (doc, _), (a, b), per in zip(rows, spans, links, strict=True):
        shared = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = []
        for low, high in zip([0, *shared[:-1]], shared):
            groups.append(",".join(str(i) for i, s, _ in a if low <= s < high) + "|" + ",".join(str(i) for i, s, _ in b if low <= s < high))
        out.append((doc, len(a), len(b), len(groups), len(per), sum(count[x] == best[x[1]] for x in per), sum(count[x] for x in per), ";".join(groups)))
    return out, count


ODD = [
    None, "", " ", "a", "▁", "a ▁b", "x▁ y", "  two  spaces  ", "<s> </s> <unk> <0x41>", "a<|endoftext|>b", "日本 語", "é é", "tab\tnew\nline\r\n", "a\x00b",
    "naïve café 12345 don't", "\n", "ﬁ ﬂ", "the the the", "🙂 🙃 x", " nbsp", "　wide",
]


def test_against_all_pairs(spark, documents, tokens, monkeypatch):
    rng = random.Random(11)
    rows = list(enumerate(ODD)) + [(100, "the end"), (100, "the end"), (None, "no id here")]
    rows += [(200 + i, "".join(rng.choice("  abcthe,.é\n日▁1'") for _ in range(rng.randint(0, 60)))) for i in range(120)]
    rows += [(900, "more words than one block holds, " * 40)]
    monkeypatch.setattr(alignment, "BLOCK", 700)
    want, count = plain(rows, tokens)
    got, links = align(documents(rows).repartition(3), A, B)
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert order(got.collect()) == order(want)
    assert {(r.a, r.b): r["count"] for r in links.collect()} == dict(count)


def test_empty_table(spark, documents):
    got, links = align(documents([]), A, B)
    assert got.count() == links.count() == 0
    none, _ = align(documents([(1, None), (2, "")]), A, B)
    assert [tuple(r)[1:] for r in none.collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_query(spark, tokens, tmp_path):
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    rows = [(d, (t or "")[:600]) for d, t in zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = {(*row[:-1], SHA(row[-1]) if row[1] else "") for row in plain(rows, tokens)[0]}
    assert {tuple(r) for r in alignment.op11_alignment(spark, str(tmp_path)).collect()} == want


def test_texts_come_to_the_workers_in_small_batches(spark, documents, monkeypatch):
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", {}
    before, stored = spark.conf.get(key), alignment.stored

    def noted(df, name, *by):
        seen[name] = spark.conf.get(key)
        if name == "alignment-blocks":
            largest = documents([(i, "a word " * 40000) for i in range(30)]).coalesce(1).mapInArrow(
                lambda batches: (type(b).from_pydict({"bytes": [b.nbytes]}) for b in batches), "bytes long").agg({"bytes": "max"}).first()[0]
            assert largest < 6 << 20
        return stored(df, name, *by)

    monkeypatch.setattr(alignment, "stored", noted)
    align(documents([(1, "some text")]), A, B)
    assert seen["alignment-blocks"] != before and spark.conf.get(key) == before
