"""Scores for abusive, hateful and sexual content.

A document is read as units: sentences, and what stands in brackets or between the marks of
an interruption. A unit becomes hashed terms: its words, with the usual disguises of letters
undone, and the four-letter pieces of the longer ones. A factorization machine learns from
labelled documents a weight per term and an inner product per pair of terms, so that an
insult next to a person counts for more than either, and next to words of reporting for less.

A document's label says nothing about which of its units it is due to. So a machine is fitted to
each of two halves of the labelled documents; the machine of one half picks, in each positive
document of the other half, the unit it holds worst. Two machines fitted to these units and all
units of negative documents pick once more. Annotators err, and a few benign sentences learnt as abuse
condemn all that share their words: a document that a single annotator holds positive and the machine of
the other half does not is left out. The final machine learns from what remains.

Labels are the majority of the annotators of a document; ties and null categories are left
out. At most ``MAX_LABELLED`` labelled documents, chosen by the hash of their id, are used for
fitting. Every unit of every document is scored, in one pass over the corpus that shuffles
nothing; a document's score is that of its worst unit. Defined results: empty and null texts, and
those without a letter, score 0; without labels of both kinds, all score 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassificationModel, FMClassifier
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import spread
from kinweave.session import checkpointed

#: Labelled documents used for fitting, at most.
MAX_LABELLED = 10_000
#: Times that each positive unit counts in the last fit; scores are corrected for it.
POSITIVE_WEIGHT = 3
#: Below this probability a machine contradicts a single annotator.
DOUBT = 0.5
#: Hashed terms, factors per term.
TERMS, FACTORS = 1 << 14, 6
#: A document from this score on is one to review.
REVIEW = 0.5
#: Words whose terms a task remembers, and texts that it scores at a time.
KNOWN_WORDS, TEXTS = 200_000, 500

_LETTER = r"[^\W\d_]"
_INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
_BROKEN = re.compile(rf"({_LETTER})-[ \t]*\r?\n[ \t]*({_LETTER})")
_MASKED = re.compile(rf"(?<={_LETTER})\*{{2,}}(?={_LETTER})")
_INSIDE = re.compile(rf"(?<={_LETTER})[*_#|](?={_LETTER})")
_SPELT = re.compile(rf"(?<=\b{_LETTER})[.\-_ ](?={_LETTER}(?:[.\-_ ]{_LETTER}\b|\b[.\-_ ]?(?!{_LETTER})))")
_NUMBER = re.compile(r"(?<![^\W_])\d[\d.,]*(?![^\W_])")
_DISGUISES = tuple(zip("@$0134", "asoiea", strict=True))
_BRACKETED = re.compile(r"[\[(]([^\[\]()]*)[\])]")
_MARKED = re.compile(r"(?<!\S)([*/][^*/\n]{2,}[*/]|— [^—\n]{2,} —)(?=\s|$|[.,;:!?])")
_SENTENCE = re.compile(r"(?<=[.!?])[\"”»’]*\s+|\s*…\s*")
_TERM = re.compile(rf"{_LETTER}+|[“”«»\"]")
_ANY = re.compile(_LETTER)


def plain(text: str) -> str:
    """Text with invisible characters, line breaks within words and letter disguises undone."""
    if not text.isascii():
        for c in _INVISIBLE:
            text = text.replace(c, "")
    if "\n" in text:
        text = _BROKEN.sub(lambda m: m[1] + m[2] if m[2].islower() else m[0], text)
    if "**" in text:
        text = _MASKED.sub(" xmaskedx ", text)
    if "*" in text or "_" in text or "#" in text or "|" in text:
        text = _INSIDE.sub("", text)
    text = _NUMBER.sub("7", _SPELT.sub("", text))
    for c, letter in _DISGUISES:
        text = text.replace(c, letter)
    return text


def units(text: str | None) -> list[str]:
    """The units of a text that hold a letter."""
    if not text:
        return []
    host = plain(text)
    inner = _BRACKETED.findall(host)
    host = _BRACKETED.sub(" ", host)
    inner += _MARKED.findall(host)
    pieces = inner + re.split(r"\n\s*\n", _MARKED.sub(" ", host))
    return [s for p in pieces for s in _SENTENCE.split(" ".join(p.split())) if _ANY.search(s)]


class Terms:
    """Numbers of the hashed terms of units; those of a word are remembered up to a bound."""

    def __init__(self) -> None:
        self.known: dict[str, list[int]] = {}

    def word(self, w: str) -> list[int]:
        import xxhash

        found = self.known.get(w)
        if found is None:
            if len(self.known) > KNOWN_WORDS:
                self.known.clear()
            pieces = {"#" + w[i : i + 4] for i in range(len(w) - 3)} if len(w) >= 5 else ()
            found = self.known[w] = [xxhash.xxh32_intdigest(t) % TERMS for t in (w, *pieces)]
        return found

    def __call__(self, unit: str) -> list[int]:
        """Terms of a unit: its words, quotation marks and four-letter pieces of words of five letters or more."""
        small = unit.lower().replace("'", "").replace("’", "")
        return [t for w in dict.fromkeys(_TERM.findall(small)) for t in self.word(w)]


def unit_terms(documents: DataFrame) -> DataFrame:
    """(doc_id, label, n, terms), a row for each unit, n being its place; terms as text for the vocabulary."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, names = Terms(), [str(t) for t in range(TERMS)]
        types = (pa.int64(), pa.float64(), pa.int32(), pa.list_(pa.string()))
        for batch in batches:
            for begin in range(0, batch.num_rows, TEXTS):
                part = batch.slice(begin, TEXTS)
                own = zip(*(part[c].to_pylist() for c in ("doc_id", "label", "text")), strict=True)
                rows = [(i, label, n, [names[t] for t in sorted(set(hashed(u)))]) for i, label, text in own for n, u in enumerate(units(text))]
                columns = zip(*rows, strict=True) if rows else ([], [], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["doc_id", "label", "n", "terms"])

    return documents.select("doc_id", "label", "text").mapInArrow(read, "doc_id bigint, label double, n int, terms array<string>")


def _counted(labels: DataFrame) -> DataFrame:
    """(doc_id, label, votes) as in ``majority``, with the number of annotators for it."""
    votes = labels.where("doc_id IS NOT NULL AND category IS NOT NULL").select("doc_id", "annotator", (F.lower(F.trim("category")) != "none").cast("double").alias("vote")).distinct()
    shares = votes.groupBy("doc_id").agg(F.avg("vote").alias("share"), F.count("vote").alias("n")).where("share <> 0.5")
    return shares.select("doc_id", (F.col("share") > 0.5).cast("double").alias("label"), F.round(F.col("n") * F.greatest("share", 1 - F.col("share"))).cast("int").alias("votes"))


def majority(labels: DataFrame) -> DataFrame:
    """(doc_id, label) of documents whose annotators agree by majority; repeated rows count once."""
    return _counted(labels).select("doc_id", "label")


def _machine(iterations: int) -> FMClassifier:
    return FMClassifier(featuresCol="features", labelCol="label", factorSize=FACTORS, maxIter=iterations, stepSize=0.05, regParam=1e-6, initStd=0.03, tol=1e-5, solver="adamW", seed=11)


def _weighted(rows: DataFrame, parts: int) -> DataFrame:
    """``rows`` with those of positive documents POSITIVE_WEIGHT times."""
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("label") == 1, POSITIVE_WEIGHT).otherwise(1)))
    return rows.select("*", copies.alias("_copy")).drop("_copy").coalesce(parts)


def _worst_units(rows: DataFrame, fitted: DataFrame, iterations: int) -> DataFrame:
    """(doc_id, n, p) of the worst unit of each positive document, as judged by a machine that is fitted
    to the rows of ``fitted`` in the other half of the documents."""
    judged = []
    for half in (0, 1):
        model = _machine(iterations).fit(fitted.where(F.col("half") != half).select("label", "features"))
        own = model.transform(rows.where((F.col("half") == half) & (F.col("label") == 1)))
        judged.append(own.select("doc_id", "n", vector_to_array("probability")[1].alias("p")))
    worst = judged[0].unionByName(judged[1]).groupBy("doc_id").agg(F.max(F.struct("p", "n")).alias("w"))
    return checkpointed(worst.select("doc_id", "w.n", "w.p"))


def _picked(rows: DataFrame, worst: DataFrame) -> DataFrame:
    """``rows`` with the units of positive documents reduced to those of ``worst``."""
    picked = rows.join(F.broadcast(worst.select("doc_id", "n")), ["doc_id", "n"], "left_semi")  # bounded by MAX_LABELLED
    return rows.where("label = 0").unionByName(picked)


def fit(documents: DataFrame, labels: DataFrame, iterations: int = 60) -> FMClassificationModel | None:
    """The machine, or None where the labels do not have both kinds."""
    spark = documents.sparkSession
    sample = _counted(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    chosen = documents.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "label")  # bounded by MAX_LABELLED
    parts = min(4, spark.sparkContext.defaultParallelism)
    written = checkpointed(unit_terms(chosen))
    vocabulary = CountVectorizerModel.from_vocabulary([str(i) for i in range(TERMS)], "terms", "features")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("half")
    rows = vocabulary.setBinary(True).transform(written.coalesce(parts)).select("doc_id", "n", "label", half, "features")
    if written.groupBy(half).agg(F.count_distinct("label").alias("k")).where("k = 2").count() < 2:  # a half has one kind only
        return _machine(iterations).fit(rows.select("label", "features")) if written.agg(F.count_distinct("label")).first()[0] == 2 else None
    first = _picked(rows, _worst_units(rows, rows, iterations // 2))
    worst = _worst_units(rows, _weighted(first, parts), iterations // 2)
    trusted = worst.join(F.broadcast(sample.where("votes > 1").select("doc_id", "votes")), "doc_id", "left").where((F.col("p") >= DOUBT) | F.col("votes").isNotNull())
    last = worst if trusted.isEmpty() else trusted
    return _machine(iterations).fit(_weighted(_picked(rows, last), parts).select("label", "features"))


def machine_table(model: FMClassificationModel) -> tuple[float, np.ndarray]:
    """(intercept, a row per term): what the term adds on its own, less half the square of its factors;
    and its factors. A unit's value is the sum of the first, plus half the square of the sum of the others."""
    factors = model.factors.toArray()
    return model.intercept, np.column_stack([model.linear.toArray() - 0.5 * (factors * factors).sum(1), factors])


def worst(numbers: list[list[int]], intercept: float, table: np.ndarray) -> np.ndarray:
    """What the machine says of each unit, given as its terms: the probability that it is positive."""
    owner = np.repeat(np.arange(len(numbers)), [len(x) for x in numbers])
    cells = owner * TERMS + np.fromiter((t for x in numbers for t in x), np.int64, len(owner))
    cells = np.unique(cells.astype(np.int32) if len(numbers) < 1 << 17 else cells)  # a term counts once
    owner, term = np.divmod(cells, TERMS)
    sums = np.add.reduceat(table[term], np.flatnonzero(np.diff(owner, prepend=-1)))
    value = intercept + sums[:, 0] + 0.5 * (sums[:, 1:] ** 2).sum(1)
    return 1 / (1 + np.exp(-np.clip(value, -700, 700)))


def scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, source, score) of every document."""
    corpus = documents.select("doc_id", "text", "source")
    model = fit(corpus, labels)
    if model is None:
        return corpus.select("doc_id", "source", F.lit(0.0).alias("score"))
    shared = documents.sparkSession.sparkContext.broadcast(machine_table(model))  # TERMS rows

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, hashed = shared.value, Terms()
        for batch in batches:
            out = np.zeros(batch.num_rows)
            texts = batch["text"].to_pylist()
            for begin in range(0, len(texts), TEXTS):
                found = [(begin + i, terms) for i, text in enumerate(texts[begin : begin + TEXTS]) for u in units(text) if (terms := hashed(u))]
                if found:
                    np.maximum.at(out, [i for i, _ in found], worst([t for _, t in found], *machine))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["source"], pa.array(out / (out + POSITIVE_WEIGHT * (1 - out)))], ["doc_id", "source", "score"])

    return spread(corpus).mapInArrow(judge, "doc_id bigint, source string, score double")


def rates(scored: DataFrame) -> DataFrame:
    """Documents, documents to review and their rate per source."""
    flagged = F.count(F.when(F.col("score") >= REVIEW, 1))
    source = F.coalesce(F.trim("source"), F.lit("(none)"))
    return scored.groupBy(source.alias("source")).agg(F.count(F.lit(1)).alias("documents"), flagged.alias("to_review"), (flagged / F.count(F.lit(1))).alias("rate"), F.avg("score").alias("mean_score"))
