"""All queries of the subpackage and their SQL twins."""

from __future__ import annotations

from wattlake.llm import alignment, bestfit, embeddings, lines, minhash, mixing, packing, passages, quality, topk, trie, url_filter, warc  # noqa: F401
from wattlake.llm.shared import ORACLE, QUERIES  # noqa: F401
