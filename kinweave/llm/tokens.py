"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import functools
import heapq
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A vocabulary file of ranks in tiktoken's format; a parameter everywhere.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Fixed value: how texts are cut before byte pairs are merged.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pieces above so many bytes are merged with a heap, as the tokenizer's own merging of one piece
#: takes time that grows with the square of its length. The tokens are the same.
LONG = 2048

_LONG_RUN = re.compile(rf"\S{{{LONG},}}|\s{{{LONG},}}")


@functools.lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


@functools.lru_cache(maxsize=1)
def _pieces():
    import regex

    return regex.compile(PATTERN)


def merged(piece: bytes, ranks: dict[bytes, int]) -> int:
    """Tokens of one piece: of all neighbours the pair of the lowest rank is merged, of equal ones
    the first, until no pair has a rank. A heap holds the pairs, so that each merge is cheap."""
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # the parts as a linked list of starts
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive, parts = [True] * n, n
    while heap:
        _, at, end = heapq.heappop(heap)
        middle = after[at] if alive[at] else n
        if middle >= n or after[middle] != end:
            continue  # one of the two has been merged since
        alive[middle], after[at] = False, end
        if end < n:
            before[end] = at
        parts -= 1
        for start, stop in ((before[at], end), (at, after[end] if end < n else -1)):
            if start >= 0 and stop > 0 and (r := ranks.get(piece[start:stop])) is not None:
                heapq.heappush(heap, (r, start, stop))
    return parts


def count(text: str | None, path: str = TOKENIZER) -> int:
    """Tokens of one text; none for null."""
    if not text:
        return 0
    encoding, ranks = _encoding(path)
    if len(text) < LONG or not _LONG_RUN.search(text):
        return len(encoding.encode_ordinary(text))
    total = 0
    for piece in _pieces().finditer(text):
        whole = piece[0].encode("utf-8", "replace")
        total += 1 if whole in ranks else len(encoding.encode_ordinary(piece[0])) if len(whole) < LONG else merged(whole, ranks)
    return total


def token_count(text: Column, path: str = TOKENIZER) -> Column:
    """BIGINT number of tokens of a text column."""

    @F.pandas_udf("bigint")
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series([count(t, path) for t in texts], dtype="int64")

    return counted(text)
