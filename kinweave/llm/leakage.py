"""Evaluation passages that occur in a corpus, in whole or in part.

Texts are read as words. Items are cut into passages of ``WINDOW`` words, the least that counts
as a leak; an item shorter than that can be one passage of its own size. A passage, and every
window of a document of the same size, is embedded by a random walk that copies the current
word and moves on by a random bit of that word, which turns a small edit distance into a small
Hamming distance. Some positions of the embedding are sampled and hashed; windows with an equal
hash are candidates. Walks and samples are repeated until near windows meet with the target
recall; equal windows always meet, so that one repetition does for them. Candidates are compared
word by word: the passage with the stretch of the document that begins there, whatever its end.

The index of the items is a table of hashes. Documents are read once: a bitmap of the index, of
bounded size, tells which windows can have a partner, and only these are joined with the index,
by their hash, hot ones salted. Longer items need no larger windows: a copy of a long item with
an edit in every sixth word still has a passage within two.

Defined results: null and empty texts, and documents that lack more words of a window than
edits are allowed, leak nothing;
repeated rows are reported once; equal items are items of their own; passages of fewer than six
words must be equal, those of fewer than twelve may differ by one edit.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import spread
from kinweave.operators.skew import salted_join
from kinweave.session import checkpointed

#: Words of a window: the least that counts as a leak.
WINDOW = 12
#: Shares of windows that meet in one repetition, at which the recall over all places of the edits is reached for
#: the worst kind of edit (see tests/llm/test_leakage.py): one and two words replaced, inserted or dropped.
MEET = {0: 1.0, 1: 0.28, 2: 0.085}
#: Bits of the bitmap per row of the index, and at most.
BITS_EACH, MOST_BITS = 256, 1 << 27
#: Words that are embedded at a time, and known words kept in a task.
CHUNK_WORDS, KNOWN_WORDS = 50_000, 500_000

_HYPHEN = re.compile(r"(?<=[^\W_])[-‐]\s*\n\s*(?=[^\W_])")
_ROUND, _SQUARE = re.compile(r"\([^()]*\)"), re.compile(r"\[[^\[\]]*\]")
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Folded words of a text: the order of the steps matters and follows the task's rule."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).replace("\u00ad", "")
    if "\n" in text:
        text = _HYPHEN.sub("", text)
    if "(" in text:
        text = _ROUND.sub(" ", text)
    if "[" in text:
        text = _SQUARE.sub(" ", text)
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")
    return _WORD.findall(text.lower().replace("'", "").replace("’", ""))


def allowed(size: int, edits: int) -> int:
    """Edits that a passage of ``size`` words may have: one for every six words at most."""
    return min(edits, size // 6)


def repeats(recall: float, edits: int) -> int:
    """Repetitions so that windows ``edits`` words apart meet with probability ``recall``."""
    if edits not in MEET:
        raise ValueError("meeting rates are measured up to two edits")
    return 1 if not edits else max(1, math.ceil(math.log(1 - recall) / math.log(1 - MEET[edits])))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Walks:
    """The random walks and samples of all repetitions for windows of one size, the same in every task."""

    def __init__(self, count: int, size: int = WINDOW, seed: int = 7) -> None:
        draw = np.random.default_rng([seed, size])
        steps, sampled = round(size * 22 / 12), 5 if size >= 12 else 4 if size >= 9 else min(3, size)
        self.size = size
        self.masks = draw.integers(1, 2**63, count).astype(np.uint64)
        self.samples = [sorted(draw.choice(steps, sampled, replace=False).tolist()) for _ in range(count)]

    def keys(self, hashes: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
        """Per repetition, the sampled hash of the window at each start."""
        with np.errstate(over="ignore"):
            for r, (mask, sample) in enumerate(zip(self.masks, self.samples, strict=True)):
                bits = _mix(hashes ^ mask)
                at, end = starts.copy(), starts + self.size
                key = np.full(len(starts), mask, np.uint64)
                for step in range(sample[-1] + 1):
                    here = np.minimum(at, len(hashes) - 1)
                    inside = at < end if step >= self.size else None
                    if step in sample:
                        symbol = hashes[here]
                        if inside is not None:
                            symbol = np.where(inside, symbol, np.uint64(0))
                        key = (key ^ symbol) * np.uint64(0x9E3779B97F4A7C15)
                        key ^= key >> np.uint64(29)
                    move = ((bits[here] >> np.uint64(step)) & np.uint64(1)).astype(at.dtype)
                    at += move if inside is None else move * inside
                yield _mix(key + np.uint64(r)).view(np.int64)


class Hasher:
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, tokens: list[str]) -> np.ndarray:
        import xxhash

        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        out = np.empty(len(tokens), np.uint64)
        for i, t in enumerate(tokens):
            h = known.get(t)
            if h is None:
                h = known[t] = xxhash.xxh64_intdigest(t)
            out[i] = h
        return out


def _window_starts(lengths: list[int], size: int = WINDOW, beyond: int = 0, gap: int = 0) -> np.ndarray:
    """Starts of all windows that lie within one text, the texts standing end to end with ``gap``
    words between; the last ``beyond`` words of a window may lie in the gap."""
    begin, parts = 0, []
    for n in lengths:
        if n and n + beyond >= size:
            parts.append(np.arange(begin, begin + n + beyond - size + 1, dtype=np.int64))
        begin += n + gap
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def stretch_distance(passage: list[str], stretch: list[str], most: int) -> int:
    """Word edits between the passage and the beginning of the stretch, wherever it may end;
    ``most + 1`` if more than ``most``."""
    if stretch[: len(passage)] == passage:
        return 0
    if not most or len(set(passage) - set(stretch)) > most:
        return most + 1
    far, n = most + 1, len(stretch)
    row = [j if j <= most else far for j in range(n + 1)]
    for i, x in enumerate(passage, 1):  # only cells near the diagonal can be within reach
        above, row = row, [far] * (n + 1)
        if i <= most:
            row[0] = i
        for j in range(max(1, i - most), min(n, i + most) + 1):
            cell = above[j - 1] + (x != stretch[j - 1])
            if above[j] < cell:
                cell = above[j] + 1
            if row[j - 1] < cell:
                cell = row[j - 1] + 1
            row[j] = cell
        if min(row) > most:
            return far
    return min(*row, far)


def passages(items: DataFrame, short: bool) -> DataFrame:
    """(item_id, at, size, passage) of every passage; ``short``: of items below a window too."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, text in zip(batch["item_id"].tolist(), batch["text"].tolist(), strict=True):
                w = words(text)
                size = min(WINDOW, len(w)) if short else WINDOW
                for begin in range(0, len(w) - size + 1, CHUNK_WORDS) if size else ():
                    at = range(begin, min(begin + CHUNK_WORDS, len(w) - size + 1))
                    yield pd.DataFrame({"item_id": item, "at": list(at), "size": size, "passage": [" ".join(w[i : i + size]) for i in at]})

    whole = items.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").distinct()
    return whole.mapInPandas(cut, "item_id bigint, at int, size int, passage string")


def _index(found: DataFrame, walks: dict[int, Walks]) -> DataFrame:
    """(key, size, passage) of every distinct passage and repetition."""

    def embed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for batch in batches:
            for size, part in batch.groupby("size"):
                hashes = hasher([t for p in part["passage"] for t in p.split(" ")])
                for keys in walks[size].keys(hashes, np.arange(len(part), dtype=np.int64) * size):
                    yield pd.DataFrame({"key": keys, "size": size, "passage": part["passage"].to_numpy()})

    return found.select("size", "passage").distinct().mapInPandas(embed, "key bigint, size int, passage string")


def _bitmap(index: DataFrame) -> np.ndarray:
    """The bits that the keys of the index set, made on Spark, at most MOST_BITS of them."""
    count = index.count()
    bits = min(MOST_BITS, 1 << max(15, math.ceil(math.log2(max(1, count) * BITS_EACH))))
    place = F.pmod("key", F.lit(bits)) + 1
    rows = index.groupBy((F.bitmap_bucket_number(place) - 1).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:  # of 4 KB each
        out[r.b * 4096 : (r.b + 1) * 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def _met(corpus: DataFrame, index: DataFrame, walks: dict[int, Walks], edits: int) -> DataFrame:
    """(doc_id, size, stretch, keys) of the windows of documents that can have a partner in the index."""
    shared = corpus.sparkSession.sparkContext.broadcast(_bitmap(index))  # at most 16 MB

    def met(ids: list[int], texts: list[list[str]], hasher: Hasher, bitmap: np.ndarray) -> Iterator[tuple]:
        gap = [""] * edits  # words may be missing where a document ends
        tokens, lengths = [t for text in texts for t in (*text, *gap)], [len(t) for t in texts]
        hashes, ends = hasher(tokens), np.cumsum(np.array(lengths, np.int64) + edits) - edits
        for size, walk in walks.items():
            starts = _window_starts(lengths, size, allowed(size, edits), edits)
            if not len(starts):
                continue
            found: dict[int, list[int]] = {}
            for keys in walk.keys(hashes, starts):
                place = keys & (len(bitmap) * 8 - 1)
                for w in np.flatnonzero((bitmap[place >> 3] >> (place & 7)) & 1).tolist():
                    found.setdefault(w, []).append(int(keys[w]))
            more, seen = allowed(size, edits), {}
            for w, keys in found.items():
                at = int(starts[w])
                doc = int(np.searchsorted(ends + edits, at, "right"))
                stretch = " ".join(tokens[at : min(at + size + more, int(ends[doc]))])
                seen.setdefault((ids[doc], stretch), set()).update(keys)
            for (doc, stretch), keys in seen.items():
                yield doc, size, stretch, list(keys)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, bitmap = Hasher(), shared.value
        for batch in batches:
            ids, texts, held = [], [], 0
            for place, (doc, text) in enumerate(zip(batch["doc_id"].tolist(), batch["text"].tolist(), strict=True), 1):
                ids.append(doc)
                texts.append(words(text))
                held += len(texts[-1])
                if held > CHUNK_WORDS or place == len(batch):
                    rows = list(met(ids, texts, hasher, bitmap))
                    if rows:
                        yield pd.DataFrame(rows, columns=["doc_id", "size", "stretch", "keys"])
                    ids, texts, held = [], [], 0

    return corpus.mapInPandas(scan, "doc_id bigint, size int, stretch string, keys array<bigint>")


def _verified(candidates: DataFrame, edits: int) -> DataFrame:
    """(stretch, passage, distance) of the candidates within the edits that their size allows, each once.

    Pairs that meet often come from many keys. They are judged where they meet, as most candidates
    fail: first by the words that the stretch lacks, then by the distance."""

    @F.pandas_udf("int")
    def distance(passage: pd.Series, stretch: pd.Series) -> pd.Series:
        pairs = ((p.split(" "), s.split(" ")) for p, s in zip(passage, stretch, strict=True))
        return pd.Series([stretch_distance(p, s, allowed(len(p), edits)) for p, s in pairs], dtype="int32")

    if not edits:
        return candidates.where("stretch = passage").select("stretch", "passage", F.lit(0).alias("distance")).distinct()
    most = F.least(F.lit(edits), F.floor(F.col("size") / 6))
    lacking = F.size(F.array_except(F.split("passage", " "), F.split("stretch", " ")))
    # called nondeterministic so that it is computed once, not again for each use of its result
    judged = candidates.where(lacking <= most).withColumn("distance", distance.asNondeterministic()("passage", "stretch"))
    return judged.where(F.col("distance") <= most).select("stretch", "passage", "distance").distinct()


def leaks(documents: DataFrame, items: DataFrame, edits: int = 0, recall: float = 0.9, short: bool = False) -> DataFrame:
    """Documents and the items that leaked into them.

    documents: doc_id, text; items: item_id, text. A pair is reported if the document holds a
    stretch at most ``edits`` word edits from a passage of the item. ``recall`` is the share of
    stretches ``edits`` apart that shall meet; equal ones all do. ``short``: items below a window
    count too, each being one passage.
    Columns: doc_id, item_id, equal_windows and near_windows (different stretches of the document),
    item_windows_met, item_windows."""
    spark = documents.sparkSession
    found = checkpointed(passages(items, short))
    sizes = sorted(r.size for r in found.select("size").distinct().collect())  # at most WINDOW
    if not sizes:
        schema = "doc_id bigint, item_id bigint, equal_windows bigint, near_windows bigint, item_windows_met bigint, item_windows bigint"
        return spark.createDataFrame([], schema)
    walks = {size: Walks(repeats(recall, allowed(size, edits)), size) for size in sizes}
    index = checkpointed(_index(found, walks))
    corpus = spread(documents.where("doc_id IS NOT NULL AND text <> ''").select("doc_id", "text"))
    met = checkpointed(_met(corpus, index, walks, edits))
    asked = met.select("size", "stretch", F.explode("keys").alias("key")).distinct()
    candidates = salted_join(asked, index, ["key", "size"]).select("size", "stretch", "passage")
    near = checkpointed(_verified(candidates, edits))
    held = salted_join(met.select("doc_id", "stretch"), near, ["stretch"])
    rows = held.join(found.select("item_id", "at", "passage"), "passage")
    equal = F.count_distinct(F.when(F.col("distance") == 0, F.col("stretch")))
    pairs = rows.groupBy("doc_id", "item_id").agg(equal.cast("bigint").alias("equal_windows"), (F.count_distinct("stretch") - equal).alias("near_windows"), F.count_distinct("at").alias("item_windows_met"))
    return pairs.join(found.groupBy("item_id").agg(F.count(F.lit(1)).alias("item_windows")), "item_id").select("doc_id", "item_id", "equal_windows", "near_windows", "item_windows_met", "item_windows")
