"""One corpus from several sources, each with its target share of the tokens.

Every document has a membership in the sources: all of it where its source is known;
otherwise the posterior of a classifier that is fitted to labelled documents. Documents get
rates between 0 and their source's most repeats. Projected gradient steps bring the expected
tokens per source, the sum of rate x tokens x membership, to the targets in the sense of
least squares; gradients are divided by the tokens of a source that can still move, so that
sources of any size move alike, also near their limits, and no step makes a miss larger. Each step is one small aggregation. The rates are written every few steps; between,
they follow from the residuals of the steps since. The steps end when all sources are met, when
a step changes nothing any more (mixed memberships may leave no exact solution), or after so
many; ``fit_miss`` says how far the source that was met least is from its tokens then.

Documents with the same membership and limit have the same rate, so known ones are one row
per source in these steps. Rates become whole repeats by systematic rounding in order
of size: running sums of the fractions, in blocks with offsets, so that no source is one task.

The size of the mix is the largest at which no source needs more than its repeats allow.
Defined results: sources without documents cannot contribute, and the other shares are scaled
up; sources without a target contribute nothing; names compare without padding; documents
without an id or tokens are left out; if no source has both, the mix is empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.llm.common import spread
from kinweave.llm.tokens import TOKENIZER, token_count
from kinweave.session import checkpointed, shared_dir

#: Labelled documents for the classifier, at most; and its hashed words.
MAX_LABELLED, TERMS = 20_000, 1 << 12
#: Gradient steps at most, those between two writings, and the relative miss that ends them.
STEPS, WRITTEN, CLOSE = 60, 10, 1e-4
#: Fractions of rates are summed as whole numbers of this size.
UNIT = 1_000_000
#: Blocks per source and size class in the systematic rounding.
BLOCKS = 128


@dataclass(frozen=True)
class Target:
    source: str
    share: float
    repeats: int


def _name(col: Column) -> Column:
    bare = F.trim(col, F.lit(" \t\r"))
    return F.when(bare != "", bare)


def read_targets(targets: DataFrame) -> list[Target]:
    """Targets with shares that sum to 1; a row per source, so few. Weights must be positive."""
    rows = targets.select(_name(F.col("source")).alias("s"), "target_weight", "max_repeats").where("s IS NOT NULL AND target_weight > 0").groupBy("s").agg(F.max("target_weight").alias("w"), F.max("max_repeats").alias("r")).collect()
    total = sum(r.w for r in rows)
    return sorted((Target(r.s, r.w / total, max(0, r.r or 0)) for r in rows), key=lambda t: t.source)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\p{L}+"), F.lit(0))


def posteriors(documents: DataFrame, sources: list[str]) -> DataFrame:
    """(doc_id, text, posterior array over ``sources``) of the documents without a source."""
    hashing = HashingTF(inputCol="words", outputCol="features", numFeatures=TERMS)
    features = lambda df: hashing.transform(df.withColumn("words", _words(F.col("text")))).drop("words")
    known = documents.where(F.col("source").isin(sources))
    number = F.array_position(F.array(*map(F.lit, sources)), F.col("source")).cast("double") - 1
    ids = known.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    sample = known.withColumn("label", number).join(F.broadcast(ids), "doc_id", "left_semi")  # bounded by MAX_LABELLED
    unknown = documents.where("source IS NULL")
    if len(sources) == 1:
        return unknown.select("doc_id", "text", F.array(F.lit(1.0)).alias("posterior"))
    model = LogisticRegression(maxIter=25, regParam=0.05, family="multinomial").fit(features(sample).select("label", "features"))
    found = model.transform(features(unknown)).select("doc_id", "text", vector_to_array("probability").alias("_p"))
    # sources late in the list that the sample lacks have no class
    every = F.transform(F.sequence(F.lit(0), F.lit(len(sources) - 1)), lambda i: F.coalesce(F.get("_p", i), F.lit(0.0)))
    return found.select("doc_id", "text", every.alias("posterior"))


def memberships(documents: DataFrame, path: str) -> tuple[DataFrame, list[str]]:
    """(doc_id, source, known, tokens, parts) with a part for every source, written once; the sources in that order."""
    spark = documents.sparkSession
    named = documents.select("doc_id", "text", _name(F.col("source")).alias("source"))
    present = {r.source: r.n for r in named.where("source IS NOT NULL").groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per source
    sources = sorted(present, key=lambda s: (-present[s], s))
    place = F.array_position(F.array(*map(F.lit, sources)), F.col("source")).cast("int") if sources else F.lit(None).cast("int")
    one = F.transform(F.sequence(F.lit(1), F.lit(max(1, len(sources)))), lambda i: (i == place).cast("double"))
    tokens = token_count(F.col("text"), path).alias("tokens")
    out = shared_dir(spark, "memberships")
    spread(named.where("source IS NOT NULL")).select("doc_id", "source", F.lit(True).alias("known"), tokens, one.alias("parts")).write.parquet(out + "/known=1")
    known = spark.read.parquet(out + "/known=1")
    if not sources:
        return known.where("tokens > 0"), sources
    likeliest = F.get(F.array(*map(F.lit, sources)), F.array_position("posterior", F.array_max("posterior")).cast("int") - 1)
    posteriors(named, sources).select("doc_id", likeliest.alias("source"), F.lit(False).alias("known"), tokens, F.col("posterior").alias("parts")).write.parquet(out + "/known=0")
    return known.unionByName(spark.read.parquet(out + "/known=0")).where("tokens > 0"), sources


def _rate(history: list[list[float]]) -> Column:
    """The rate after steps with these residuals per source, from the rate in column ``rate``."""
    if not history:
        return F.col("rate")
    steps = F.array(*[F.array(*map(F.lit, residuals)) for residuals in history])
    move = lambda e: F.aggregate(F.zip_with("parts", e, lambda p, x: p * x), F.lit(0.0), lambda a, x: a + x)
    return F.aggregate(steps, F.col("rate"), lambda r, e: F.least("limit", F.greatest(F.lit(0.0), r - move(e))))


def rates(members: DataFrame, targets: list[Target], sources: list[str]) -> tuple[DataFrame, dict[str, float], float]:
    """(members with limit and rate, target tokens per source, largest miss of the fit)."""
    repeats = {t.source: t.repeats for t in targets}
    limits = F.array(*[F.lit(float(repeats.get(s, 0))) for s in sources])
    # a document without a source may be repeated as often as its likeliest source allows
    place = F.array_position(F.array(*map(F.lit, sources)), F.col("source"))
    members = members.withColumn("limit", F.element_at(limits, place.cast("int")))
    columns = ("source", "parts", "limit")
    known = members.where("known").groupBy(*columns).agg(F.sum("tokens").alias("tokens")).withColumn("doc_id", F.lit(None).cast("bigint"))
    rows = known.unionByName(members.where("NOT known").select("doc_id", *columns, "tokens"))
    state = checkpointed(rows.withColumn("rate", F.lit(0.0)))

    def totals(rate: Column) -> tuple[list[float], list[float], list[float]]:
        """Per source: tokens at these rates, and those of documents that can still go up, or down."""
        at = state.select("tokens", "parts", "limit", rate.alias("rate"))
        part = lambda i: F.col("tokens") * F.get("parts", F.lit(i))
        moved = (F.col("rate"), (F.col("rate") < F.col("limit")).cast("double"), (F.col("rate") > 0).cast("double"))
        row = at.agg(*[F.coalesce(F.sum(part(i) * x), F.lit(0.0)) for x in moved for i in range(len(sources))]).first()
        return tuple([float(x) for x in row[k * len(sources) : (k + 1) * len(sources)]] for k in range(3))

    available, _, _ = totals(F.col("limit"))
    share = {t.source: t.share for t in targets if t.source in sources and t.repeats and available[sources.index(t.source)] > 0}
    scale = sum(share.values())
    if not scale:
        return members.withColumn("rate", F.lit(0.0)), {}, 0.0
    share = {s: x / scale for s, x in share.items()}
    size = min(available[sources.index(s)] / x for s, x in share.items())
    goal = [size * share.get(s, 0.0) for s in sources]
    history: list[list[float]] = []
    last = [0.0] * len(sources)
    for step in range(STEPS + 1):
        now, up, down = totals(_rate(history))
        miss = max(abs(n - g) / size for n, g in zip(now, goal, strict=True))
        still = step and max(abs(n - x) / size for n, x in zip(now, last, strict=True)) < CLOSE / 10
        if miss < CLOSE or still or step == STEPS:
            break
        last = now
        free = [d if n > g else u for n, g, u, d in zip(now, goal, up, down, strict=True)]
        history.append([(n - g) / w if w and g else 0.0 for n, g, w in zip(now, goal, free, strict=True)])
        if len(history) == WRITTEN:
            state, history = checkpointed(state.withColumn("rate", _rate(history)), state), []
    state = checkpointed(state.withColumn("rate", _rate(history)), state)
    per_source = state.where("doc_id IS NULL").select("source", "rate")  # a row per source
    rated = members.where("known").join(F.broadcast(per_source), "source")
    guessed = state.where("doc_id IS NOT NULL").withColumn("known", F.lit(False))
    return rated.unionByName(guessed), dict(zip(sources, goal, strict=True)), miss


def rounded(rated: DataFrame) -> DataFrame:
    """``rated`` with whole ``repeats`` whose sums follow the rates within every range of sizes."""
    whole = F.floor(F.col("rate") + 1e-9)
    part = F.round(F.greatest(F.lit(0.0), F.col("rate") - whole) * UNIT).cast("bigint")
    # size classes in steps of an eighth of a doubling; blocks only spread the work
    block = F.floor(F.log2(F.col("tokens").cast("double")) * 8) * BLOCKS + F.pmod(F.xxhash64("doc_id"), F.lit(BLOCKS))
    rows = rated.where("rate > 0").select("doc_id", "source", "known", "tokens", "limit", whole.alias("_whole"), part.alias("_part"), block.cast("bigint").alias("_block"))
    before = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("source", "_block").agg(F.sum("_part").alias("_sum")).withColumn("_offset", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    within = Window.partitionBy("source", "_block").orderBy("tokens", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    reached = F.col("_offset") + F.sum("_part").over(within)
    placed = rows.join(offsets, ["source", "_block"]).withColumn("_reached", reached)
    shift = UNIT // 2
    crossed = F.floor((F.col("_reached") + shift) / UNIT) - F.floor((F.col("_reached") - F.col("_part") + shift) / UNIT)
    repeats = F.least(F.col("_whole") + crossed, F.col("limit").cast("bigint")).cast("int")
    return placed.select("doc_id", "source", "known", "tokens", repeats.alias("repeats")).where("repeats > 0")


def mix(documents: DataFrame, targets: DataFrame, path: str = TOKENIZER) -> tuple[DataFrame, list[Target], dict[str, float], float]:
    """(chosen documents with repeats, targets, target tokens per source, largest miss of the fit)."""
    wanted = read_targets(targets)
    members, sources = memberships(documents.where("doc_id IS NOT NULL"), path)
    if not sources:
        return members.select("doc_id", "source", "known", "tokens", F.lit(1).alias("repeats")).limit(0), wanted, {}, 0.0
    rated, goal, miss = rates(members, wanted, sources)
    return rounded(rated), wanted, goal, miss


def shares(chosen: DataFrame, targets: list[Target], goal: dict[str, float], miss: float = 0.0) -> DataFrame:
    """Per source: target share, the share that could be aimed at, what was reached, and how far the
    rates before rounding were from the aim, as a part of the mix, for the source met least."""
    spark = chosen.sparkSession
    size = sum(goal.values()) or 1.0
    wanted = spark.createDataFrame([(t.source, t.share, goal.get(t.source, 0.0) / size, t.repeats) for t in targets], "source string, target_share double, feasible_share double, max_repeats int")
    tokens = F.col("tokens") * F.col("repeats")
    reached = chosen.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum(tokens).alias("tokens"), F.max("repeats").alias("most_repeats"))
    every = wanted.join(F.broadcast(reached), "source", "left")  # a row per source on either side
    total = Window.partitionBy()
    return every.select("source", "target_share", "feasible_share", F.coalesce(F.col("tokens") / F.sum("tokens").over(total), F.lit(0.0)).alias("actual_share"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("tokens", F.lit(0)).alias("tokens"), "max_repeats", F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), F.lit(miss).alias("fit_miss"))
