"""Token ids of whole texts by public tokenizers, each distinct stretch of a text encoded once.

A text is cut only where its tokenizer must cut, too.  Equal stretches are found by their 64-bit
hash, and only new ones are encoded.  Three kinds of tokenizers are known:

* byte-level: never joins bytes across the place before a run of ASCII spaces that follows a visible
  ASCII character or a letter of U+00C0 to U+00FF, nor before ASCII punctuation that follows an ASCII
  letter or digit;
* word ends: drops white space and never joins across the second kind of place either;
* pieces: no piece has a space mark after another character, so nothing is joined across the place
  before a space that follows something else.

Merges are ranked by token id; that is checked when a vocabulary is loaded, and a vocabulary of another
kind is left to its own library, whole texts at a time.
"""

from __future__ import annotations

import ctypes
import gc
import json
import re
import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from wattlake.llm.text import Hasher, buffers, spaces

#: The pieces of a text that the byte-level pre-tokenizer makes, a published pattern.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same of the word-end pre-tokenizer.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
#: Follows the last byte of a word; never a byte of UTF-8.
WORD_END = b"\xff"


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: visible ones for themselves, the others
    for U+0100 and on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def _alnum(data: np.ndarray) -> np.ndarray:
    low = data | 32
    return ((low >= 97) & (low <= 122)) | ((data >= 48) & (data <= 57))


def _before_punctuation(data: np.ndarray) -> np.ndarray:
    now = data[1:]
    return (now > 32) & (now < 127) & ~_alnum(now) & _alnum(data[:-1])


#: Printable ASCII, spaces and U+00C0 to U+024F: characters whose classes and cases no version of Unicode changes.
_simple = re.compile("[\\x09-\\x0d\\x20-\\x7e\\xc0-\u024f]*").fullmatch


class _ByteLevel:
    def __init__(self, path: str, spec: dict, special: bool) -> None:
        import tiktoken

        letter = byte_letters()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]} if special else {}
        names = {t["content"] for t in spec["added_tokens"]}
        vocab = {bytes(letter[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in names}
        merged = [bytes(letter[c] for c in "".join(m if isinstance(m, list) else m.split(" "))) for m in spec["model"]["merges"]]
        rank = [vocab[m] for m in merged]
        if rank != sorted(rank):
            raise NotImplementedError("ids don't follow the merges")
        self.size = max(spec["model"]["vocab"].values()) + 1
        self.known = tiktoken.Encoding("bytes", pat_str=BYTE_PATTERN, mergeable_ranks=vocab, special_tokens={})
        self.bytes = {i: b for b, i in vocab.items()}

    def cuts(self, data: np.ndarray) -> np.ndarray:
        before = data[:-1]
        graph = (before > 32) & (before < 127)
        graph[1:] |= (data[:-2] == 0xC3) & (before[1:] >= 0x80)
        return (spaces(data[1:]) & graph) | _before_punctuation(data)

    def encode(self, texts: list[str]) -> list[list[int]]:
        one, whole = self.known._core_bpe.encode_single_piece, self.known.encode_ordinary
        return [one(t.encode()) if _simple(t) and t.removeprefix(" ").isalpha() else whole(t) for t in texts]

    def whole(self, text: str) -> list[int]:
        out = self.known.encode(text, allowed_special=set(), disallowed_special=())
        if not any(a in text for a in self.added):
            return out
        import regex

        out = []
        for part in regex.split("(" + "|".join(map(regex.escape, self.added)) + ")", text):
            out += [self.added[part]] if part in self.added else self.known.encode_ordinary(part)
        return out


class _WordEnd:
    def __init__(self, path: str, spec: dict, special: bool) -> None:
        import regex
        import tiktoken

        self.path, letter = path, byte_letters()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]} if special else {}
        names, end = {t["content"] for t in spec["added_tokens"]}, spec["model"]["end_of_word_suffix"]

        def raw(token: str) -> bytes:
            stem = token.removesuffix(end)
            return bytes(letter[c] for c in stem) + (WORD_END if stem != token else b"")

        vocab = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in names}
        rank = [vocab[raw("".join(m if isinstance(m, list) else m.split(" ")))] for m in spec["model"]["merges"]]
        ends = [vocab[bytes([b]) + WORD_END] for b in range(256)]
        if rank != sorted(rank) or max(ends) > rank[0]:
            raise NotImplementedError("ids don't follow the merges")
        self.size = max(spec["model"]["vocab"].values()) + 1
        self.known = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=vocab, special_tokens={})
        self.pieces, self.library = regex.compile(WORD_PATTERN).findall, None

    def cuts(self, data: np.ndarray) -> np.ndarray:
        return (spaces(data[1:]) & ~spaces(data[:-1])) | _before_punctuation(data)

    def encode(self, texts: list[str]) -> list[list[int]]:
        one, out = self.known._core_bpe.encode_single_piece, []
        for text in texts:
            bare = text.strip(" \t\n\r\x0b\x0c")
            if bare.isascii() and bare.isalpha():
                out.append(one(bare.lower().encode() + WORD_END))
            elif _simple(bare):
                lower = bare.lower()
                out.append(one(lower.encode() + WORD_END) if lower.isalpha() else [i for p in self.pieces(lower) for i in one(p.encode() + WORD_END)])
            else:
                out.append(self.whole(text))
        return out

    def whole(self, text: str) -> list[int]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
            self.library.encode_special_tokens = not self.added
        return self.library.encode(text, add_special_tokens=False).ids


class _Pieces:
    """Of texts that start with a space, which the tokenizer itself puts before a text."""

    added: dict[str, int] = {}

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.known = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.known.get_piece_size()
        names = self.known.id_to_piece(list(range(self.size)))
        if any("▁" in p.lstrip("▁") for p in names):
            raise NotImplementedError("a piece goes on after a space")
        self.bytes = {
            i: bytes([int(p[3:5], 16)]) if self.known.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)
        }

    def cuts(self, data: np.ndarray) -> np.ndarray:
        return (data[1:] == 32) & (data[:-1] != 32)

    def encode(self, texts: list[str]) -> list[list[int]]:
        space = [self.known.piece_to_id("▁")]
        return [ids or space for ids in self.known.encode([t[1:] for t in texts], num_threads=1)]

    def whole(self, text: str) -> list[int]:
        return self.known.encode(text[1:])


class _Whole:
    """Any other vocabulary: no places to cut are known."""

    def __init__(self, path: str, special: bool) -> None:
        from tokenizers import Tokenizer

        self.known = Tokenizer.from_file(path)
        self.known.encode_special_tokens = not special
        self.added, self.size = {}, self.known.get_vocab_size()

    def cuts(self, data: np.ndarray) -> np.ndarray:
        return np.zeros(len(data) - 1, bool)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.whole(t) for t in texts]

    def whole(self, text: str) -> list[int]:
        return self.known.encode(text, add_special_tokens=False).ids


def _model(path: str, special: bool):
    if path.endswith(".model"):
        return _Pieces(path)
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    before, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    try:
        if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not normal:
            return _ByteLevel(path, spec, special)
        steps = [n["type"] for n in (normal or {}).get("normalizers", [])]
        if steps == ["NFC", "Replace", "Lowercase"] and before["pretokenizers"][0]["pattern"] == {"Regex": WORD_PATTERN}:
            return _WordEnd(path, spec, special)
    except (NotImplementedError, KeyError):
        pass
    return _Whole(path, special)


class Table:
    """Rows of numbers by 64-bit key, in flat arrays.  Its bytes are bounded: when it is full, the rows that were
    asked for most often stay, about half of them."""

    def __init__(self, kind: type, most: int) -> None:
        self.kind, self.most = kind, most
        self._keep(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, kind))

    def _keep(self, keys, begin, length, asked, values) -> None:
        self.keys, self.begin, self.length, self.asked, self.values = keys, begin, length, asked, values

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key (ascending), -1 where there is none."""
        at = np.searchsorted(self.keys, keys)
        hit = at < len(self.keys)
        hit[hit] = self.keys[at[hit]] == keys[hit]
        at[~hit] = -1
        self.asked[at[hit]] += 1
        return at

    def add(self, keys: np.ndarray, values: np.ndarray, sizes: np.ndarray) -> None:
        """New rows; ``keys`` ascend."""
        if 24 * (len(self.keys) + len(keys)) + self.values.itemsize * (len(self.values) + len(values)) > self.most:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        begin = len(self.values) + np.cumsum(sizes) - sizes
        put = np.insert
        self._keep(
            put(self.keys, at, keys), put(self.begin, at, begin), put(self.length, at, sizes), put(self.asked, at, 1), np.concatenate([self.values, values])
        )

    def _forget(self) -> None:
        if not len(self.keys):
            return
        stay = np.sort(np.argsort(-self.asked, kind="stable")[: len(self.keys) // 2])
        values = self.take(stay)[0]
        length = self.length[stay]
        self._keep(self.keys[stay], np.cumsum(length) - length, length, self.asked[stay] // 2, values)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the rows one after another, where each begins, with one more at the end)."""
        sizes = self.length[rows]
        to = np.concatenate([[0], np.cumsum(sizes)])
        return self.values[np.repeat(self.begin[rows] - to[:-1], sizes) + np.arange(to[-1])], to


class Encoder:
    #: Bytes of the stretches remembered by one task.
    REMEMBERED = 12 << 20

    def __init__(self, model) -> None:
        self.model = model
        self.added = [a.encode() for a in self.model.added]
        self.kind = np.uint16 if self.model.size <= 1 << 16 else np.uint32
        self.hasher = Hasher()
        self.known = Table(self.kind, self.REMEMBERED)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, index of each text's first id with one more at the end); null is empty."""
        return self.of_bytes(*buffers(texts))

    def of_bytes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of texts in UTF-8, one after another."""
        if not len(data):
            return np.zeros(0, self.kind), np.zeros(len(offsets), np.int64)
        cut = np.zeros(len(data), bool)
        cut[1:] = self.model.cuts(data)
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        keys, where, back = np.unique(self.hasher(data, starts, ends), return_index=True, return_inverse=True)
        rows = self.known.find(keys)
        new = np.flatnonzero(rows < 0)
        raw = data.tobytes()
        if len(new):
            found = self.model.encode([raw[a:b].decode() for a, b in zip(starts[where[new]].tolist(), ends[where[new]].tolist(), strict=True)])
            old = np.flatnonzero(rows >= 0)
            kept, to = self.known.take(rows[old])
            many = np.fromiter(map(len, found), np.int64, len(found))
            fresh = np.fromiter(chain.from_iterable(found), self.kind, int(many.sum()))
            begin, length = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
            begin[old], length[old], begin[new], length[new] = to[:-1], np.diff(to), len(kept) + np.cumsum(many) - many, many
            values = np.concatenate([kept, fresh])
            self.known.add(keys[new], fresh, many)
        else:
            values, to = self.known.take(rows)
            begin, length = to[:-1], np.diff(to)
        sizes = length[back]
        to = np.concatenate([[0], np.cumsum(sizes)])
        ids = values[np.repeat(begin[back] - to[:-1], sizes) + np.arange(to[-1])]
        where = to[np.searchsorted(starts, offsets)]
        if any(a in raw for a in self.added):
            return self._with_added(raw, offsets, ids, where)
        return ids, where

    def _with_added(self, raw: bytes, offsets: np.ndarray, ids: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts that contain an added token, such as the end of text, are encoded whole."""
        parts = [ids[a:b] for a, b in zip(where[:-1], where[1:], strict=True)]
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            if any(raw.find(x, a, b) >= 0 for x in self.added):
                parts[i] = np.array(self.model.whole(raw[a:b].decode()), self.kind)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def model_of(path: str, special: bool = True):
    """The vocabulary; the worker process keeps it with ``sys`` for later tasks."""
    kept = sys.__dict__.setdefault("_wattlake_models", {})
    if (path, special) not in kept:
        kept[path, special] = _model(path, special)
    return kept[path, special]


def encoder(path: str, special: bool = True) -> Encoder:
    """An encoder for one task; the stretches it remembers go with the task."""
    return Encoder(model_of(path, special))


def released(batches: Iterator) -> Iterator:
    """``batches``; after the last one, memory that the task has freed goes back to the system, so that a waiting worker
    holds little."""
    yield from batches
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim:
        gc.collect()
        trim(0)
