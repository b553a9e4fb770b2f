"""URL filters: all wildcard rules at once as one bit-parallel automaton over canonical URLs.

Every rule is a glob.  Its tokens become consecutive bits of one state vector of as many 64-bit
words as all rules need (multiword Shift-And).  A step over one byte moves every partial match of
every rule by shifting, masks with the byte's row, and keeps the bits whose token is a wildcard
that takes the byte.  The URLs of a batch take the step together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.shared import UPPER, register, table
from wattlake.llm.text import buffers


@dataclass(frozen=True)
class UrlRule:
    """``action`` for URLs of ``host`` and its subdomains whose path starts with ``path``.

    ``*`` in a host stands for any bytes but ``/``, in a path for any bytes.
    """

    action: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)
#: What a URL without a rule gets.
DEFAULT = "allow"


class GlobAutomaton:
    """Shift-And over several 64-bit words; ``match`` gives one row of final bits per URL.

    A rule becomes a star over the host (any bytes but ``/``), a dot, its host and its path; it
    matches once its last token is reached, since the rest of the path may be anything.
    """

    def __init__(self, rules: Iterable[UrlRule]) -> None:
        tokens: list[tuple[int | None, bool]] = []  # (byte or None for a star, star takes "/")
        first, last = [], []
        for rule in rules:
            first.append(len(tokens))
            tokens.append((None, False))
            for text, slash in ((f".{rule.host}", False), (rule.path, True)):
                tokens += [(None, slash) if b == 42 else (b, slash) for b in text.encode()]
            last.append(len(tokens) - 1)
        self.words = max(1, -(-len(tokens) // 64))
        self.takes = np.zeros((256, self.words), np.uint64)  # bits whose byte this is
        self.stays = np.zeros((256, self.words), np.uint64)  # stars that take this byte
        self.start = np.zeros(self.words, np.uint64)
        self.skips = np.zeros(self.words, np.uint64)  # stars, which may take nothing
        self.last = last
        for k, (byte, slash) in enumerate(tokens):
            w, bit = k // 64, np.uint64(1 << (k % 64))
            if byte is None:
                self.stays[:, w] |= bit
                if not slash:
                    self.stays[47, w] &= ~bit
                self.skips[w] |= bit
            else:
                self.takes[byte, w] |= bit
        for k in first:
            self.start[k // 64] |= np.uint64(1 << (k % 64))
        self.first = self.start.copy()
        self.start = self._skip(self.start[None, :])[0]

    def _shift(self, state: np.ndarray) -> np.ndarray:
        out = state << np.uint64(1)
        out[:, 1:] |= state[:, :-1] >> np.uint64(63)
        return out & ~self.first

    def _skip(self, state: np.ndarray) -> np.ndarray:
        """Stars right behind a reached token are reached too."""
        while True:
            more = state | (self._shift(state) & self.skips)
            if (more == state).all():
                return state
            state = more

    def match(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One boolean per (text, rule)."""
        length = np.diff(offsets)
        order = np.argsort(-length, kind="stable")
        begin, length = offsets[:-1][order], length[order]
        state = np.repeat(self.start[None, :], len(order), 0)
        done = np.zeros((len(order), self.words), np.uint64)
        final = np.zeros(self.words, np.uint64)
        for k in self.last:
            final[k // 64] |= np.uint64(1 << (k % 64))
        done |= state & final
        for at in range(int(length[0]) if len(length) else 0):
            live = int(np.searchsorted(-length, -at, "left"))
            byte = data[begin[:live] + at]
            now = state[:live]
            now = self._skip((self._shift(now) & self.takes[byte]) | (now & self.stays[byte]))
            state[:live] = now
            done[:live] |= now & final
        out = np.zeros((len(order), len(self.last)), bool)
        for r, k in enumerate(self.last):
            out[order, r] = (done[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1) != 0
        return out


def canonical_parts(url) -> tuple:
    """(host, path) columns: host after the first ``://`` up to ``/ ? #`` with A-Z lower-cased, path
    from there up to ``? #``; both empty for null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, UPPER.lower())
    return host, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def filter_urls(
    pages: DataFrame, rules: Iterable[UrlRule] = RULES, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT
) -> DataFrame:
    """(id, host, path, rule, verdict) of every row; a map-only job.

    The longest fitting rule decides, the earlier one among equally long ones; without one, ``rule``
    is null and ``verdict`` is ``default``.  A null or empty URL has an empty host and path and so no
    rule.  Repeated rows are judged each for itself; other columns of ``pages`` are not looked at.
    An empty table gives no rows.
    """
    rules = sorted(rules, key=lambda r: -len(r.text))
    automaton = GlobAutomaton(rules)
    names = pa.array([r.text for r in rules] + [None], pa.string())
    actions = pa.array([r.action for r in rules] + [default], pa.string())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = automaton.match(*buffers(batch.column(3)))
            best = pa.array(np.where(hits.any(1), hits.argmax(1), len(rules)) if len(rules) else np.zeros(batch.num_rows, np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], names.take(best), actions.take(best)], ["id", "host", "path", "rule", "verdict"])

    host, path = canonical_parts(F.col(url_col))
    kind = pages.schema[id_col].dataType.simpleString()
    parts = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    return parts.withColumn("url", F.concat(F.lit("."), "host", "path")).mapInArrow(
        judge, f"id {kind}, host string, path string, rule string, verdict string"
    ).withColumnRenamed("id", id_col)


_FITS = " ".join(
    f"WHEN ('.' || host) LIKE '%.{r.host}' AND starts_with(path, '{r.path}') THEN '{r.text}'"
    for r in sorted(RULES, key=lambda r: -len(r.text))
)
_SAYS = " ".join(f"WHEN '{r.text}' THEN '{r.action}'" for r in RULES)
SQL = f"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), '{UPPER}', '{UPPER.lower()}') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
judged AS (SELECT *, CASE {_FITS} END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE rule {_SAYS} ELSE '{DEFAULT}' END AS verdict FROM judged
"""


@register("op1_url_filter", SQL)
def op1_url_filter(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages"))
