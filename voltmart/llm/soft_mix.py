"""Mixing to target weights with soft domain membership, with DataFrame operations only.

1. A naive Bayes classifier over words is fitted on labelled rows (the FIT_ROWS of smallest id hash, a documented
   bound) and keeps its MODEL_WORDS most telling words; it gives every document a posterior over the domains, its
   evidence tempered to at most EVIDENCE_WORDS telling words.
2. Rates r >= 0 are fitted so that the expected domain tokens sum(r * tokens * posterior) meet the targets: projected
   gradient descent on the squared misfit, r <- max(0, r - posterior . step). The misfit is measured by the inverse of
   the domains' Gram matrix (sums of tokens * posterior * posterior') over the documents that still have a rate, so that
   all domains move alike, however rare or mixed up, and few steps are needed. A step needs only a few sums per domain
   over all documents; every document's rate follows from the step vectors, so no state is kept per document. Steps end
   when every target is met, or when the projected gradient vanishes: targets that no rates can meet are met as closely as
   the misfit allows, with a warning.
3. A document is given out floor(rate + u) times, u from a hash of its id and text.

Defined results: a null or empty text has 0 tokens, the prior as posterior, and a rate like any other; labels that are
null, of unknown documents or repeated are ignored or counted once; a domain without labelled rows has posterior 0 and
its target goes to the others; a null doc_id is carried; rows equal in doc_id and
text are mixed alike, each by itself; extra columns are ignored; with empty tables, or no labelled row, every rate is 1.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import common

DOMAINS = ("clean", "junk", "toxic")
TARGETS = {"clean": 0.94, "junk": 0.03, "toxic": 0.03}
FIT_ROWS = 4000
MODEL_WORDS = 4096
MIN_COUNT = 5
EVIDENCE_WORDS = 12
ABSENT = -1e9  # log prior of a domain without labelled rows
LIMIT = 100  # steps; solve fails when they don't suffice
TOLERANCE = 1e-3  # misfit of a domain over its target (of targets under TOLERANCE of the total: over that)
WHOLE = 1e-6  # weight of all documents beside those that still have a rate
STILL = 1e-5  # likewise, the tokens that a step still moves within a domain


def domain_of(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, "toxic").when(quality == 0, "junk").when(quality == 1, "clean")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\s.,;:!?\"()]+"), "")


class Model:
    """``words``: word and one log weight per domain (at most MODEL_WORDS rows); ``prior``: log prior per domain."""

    def __init__(self, words: DataFrame | None, prior: list[float]):
        self.words, self.prior = words, prior


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, size: int = MODEL_WORDS) -> Model:
    """Weights are log P(word in a document | domain) less their mean over the domains."""
    spark = docs.sparkSession
    named = (labels.select("doc_id", domain_of(F.col("quality"), F.col("toxic")).alias("domain"))
             .where(F.col("domain").isNotNull()).groupBy("doc_id").agg(F.max("domain").alias("domain")))
    # at most ``rows`` labels, so they can be broadcast and the texts stay where they are
    chosen = common.bounded_sample(named, rows, "doc_id")
    sample = common.bounded_sample(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), rows, "doc_id").select("text", "domain")
    path = scratch_path(spark, "mix-model")
    sample.select("domain", F.array_distinct(words_of(F.col("text"))).alias("words")).write.mode("errorifexists").parquet(f"{path}/sample")
    sample = spark.read.parquet(f"{path}/sample")
    counts = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most the domains
    if not counts:
        return Model(None, [0.0] * len(DOMAINS))
    total = sum(counts.values())
    prior = [math.log(counts[d] / total) if d in counts else ABSENT for d in DOMAINS]
    held = sample.select("domain", F.explode("words").alias("word"))
    by_word = held.groupBy("word").agg(*[F.sum((F.col("domain") == d).cast("long")).alias(f"n_{d}") for d in DOMAINS])
    seen = sum((F.col(f"n_{d}") for d in DOMAINS), F.lit(0))
    logs = [F.log((F.col(f"n_{d}") + 0.1) / (counts.get(d, 0) + 0.2)) for d in DOMAINS]
    mean = sum(logs, F.lit(0.0)) / len(DOMAINS)
    spread = F.greatest(*logs) - F.least(*logs)
    telling = (by_word.where(seen >= MIN_COUNT).select("word", *[(x - mean).alias(f"w_{d}") for d, x in zip(DOMAINS, logs, strict=True)],
                                                       (spread * F.sqrt(seen.cast("double"))).alias("worth"), spread.alias("spread"))
               .where("spread > 2").orderBy(F.desc("worth"), "word").limit(size).drop("worth", "spread"))
    telling.write.mode("errorifexists").parquet(f"{path}/words")
    return Model(spark.read.parquet(f"{path}/words"), prior)


def posteriors(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, row (hash of the text), copies (equal input rows), tokens, p (array, by DOMAINS); one row per id and text."""
    n = range(len(DOMAINS))
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), words_of(F.col("text")).alias("words"))
    placed = rows.select("doc_id", "row", F.posexplode_outer("words").alias("at", "word"))
    if model.words is None:
        placed = placed.select("*", *[F.lit(None).cast("double").alias(f"w_{d}") for d in DOMAINS])
    else:  # at most MODEL_WORDS rows
        placed = placed.join(F.broadcast(model.words), "word", "left")
    # pre-aggregated where the text was read, so one row per document is shuffled
    sums = placed.groupBy("doc_id", "row").agg(
        F.sum((F.coalesce("at", F.lit(0)) == 0).cast("long")).alias("copies"), F.count("word").alias("tokens"),
        F.count(f"w_{DOMAINS[0]}").alias("telling"), *[F.coalesce(F.sum(f"w_{d}"), F.lit(0.0)).alias(f"s_{d}") for d in DOMAINS])
    telling = F.col("telling") / F.col("copies")
    temper = F.least(F.lit(1.0), F.lit(float(EVIDENCE_WORDS)) / F.greatest(telling, F.lit(1.0))) / F.col("copies")
    scores = F.array(*[F.round(F.col(f"s_{DOMAINS[i]}"), 6) * temper + model.prior[i] for i in n])  # rounded: sums in any order agree
    raised = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    mass = F.aggregate(raised, F.lit(0.0), lambda a, b: a + b)
    return sums.select("doc_id", "row", "copies", (F.col("tokens") / F.col("copies")).cast("long").alias("tokens"),
                       F.transform(raised, lambda x: x / mass).alias("p"))


def rate_of(steps: list[np.ndarray]) -> Column:
    """A document's rate after the given steps, from r = 1: r <- max(0, r - p . step)."""
    return _walk(steps)["r"] if steps else F.lit(1.0)


def _walk(steps: list[np.ndarray]) -> Column:
    path = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in steps])

    def follow(at: Column, step: Column) -> Column:
        down = sum((F.col("p")[i] * step[i] for i in range(len(DOMAINS))), F.lit(0.0))
        return F.struct(F.greatest(F.lit(0.0), at["r"] - down).alias("r"), at["r"].alias("last"))

    return F.aggregate(path, F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("last")), follow)


def solve(known: DataFrame, targets: dict[str, float] | None = None, total: float | None = None) -> tuple[list[np.ndarray], dict]:
    """Steps of the projected gradient descent, and the targets and the totals it reaches.

    ``total``: tokens wanted in all; by default what the input has, or more where that would thin out the domain of
    the largest weight.
    """
    k = range(len(DOMAINS))
    weight = F.col("tokens") * F.col("copies")
    gram = known.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("all"),
                     *[F.coalesce(F.sum(weight * F.col("p")[i]), F.lit(0.0)).alias(f"e{i}") for i in k],
                     *[F.coalesce(F.sum(weight * F.col("p")[i] * F.col("p")[j]), F.lit(0.0)).alias(f"g{i}_{j}") for i in k for j in k if i <= j]).first()
    expected = np.array([gram[f"e{i}"] for i in k])
    share = np.array([(targets or TARGETS).get(d, 0.0) for d in DOMAINS], dtype=float) * (expected > 0)
    if not gram["all"] or not share.any():
        return [], {"targets": expected, "reached": expected}
    share = share / share.sum()
    top = int(share.argmax())
    total = max(float(gram["all"]), expected[top] / share[top]) if total is None else total
    wanted = share * total
    square = lambda row: np.array([[row[f"g{min(i, j)}_{max(i, j)}"] for j in k] for i in k], dtype=float)
    whole = active = square(gram)
    fixed = np.linalg.pinv(whole, rcond=1e-12, hermitian=True)
    bound = np.maximum(wanted, TOLERANCE * total)
    steps: list[np.ndarray] = []
    reached = expected
    pace, moved, best, since = 1.0, np.inf, np.inf, 0
    while (np.abs(reached - wanted) > TOLERANCE * bound).any():
        if np.max(moved) <= STILL:
            warnings.warn(f"no rates meet the targets {dict(zip(DOMAINS, wanted))}; reached: {dict(zip(DOMAINS, reached))}", stacklevel=2)
            break
        if len(steps) == LIMIT:
            raise RuntimeError(f"mixing: after {LIMIT} steps {dict(zip(DOMAINS, reached))}, wanted {dict(zip(DOMAINS, wanted))}")
        misfit = float((reached - wanted) @ fixed @ (reached - wanted))
        best, since = (misfit, 0) if misfit < best else (best, since + 1)
        if since == 5:  # steps lead to and fro: shorter ones
            pace, since = pace / 2, 0
        measure = np.linalg.pinv((1 - WHOLE) * active + WHOLE * whole, rcond=1e-12, hermitian=True)
        steps.append(pace * (measure @ (reached - wanted)))
        at, p = F.col("at.r"), [F.col("p")[i] for i in k]
        sums = known.select(weight.alias("n"), "p", _walk(steps).alias("at")).agg(
            *[F.sum(F.col("n") * p[i] * at).alias(f"e{i}") for i in k],
            *[F.sum(F.when(at > 0, F.col("n") * p[i] * p[j]).otherwise(0.0)).alias(f"g{i}_{j}") for i in k for j in k if i <= j],
            *[F.sum(F.col("n") * p[i] * F.abs(at - F.col("at.last"))).alias(f"m{i}") for i in k]).first()
        reached, active = np.array([float(sums[f"e{i}"]) for i in k]), square(sums)
        moved = np.array([float(sums[f"m{i}"]) for i in k]) / bound
    return steps, {"targets": wanted, "reached": reached}


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, total: float | None = None) -> DataFrame:
    """doc_id, row, copies (equal input rows), tokens, p, rate, times (how often each of them is given out)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "mix")
    model = fit(docs, labels)
    posteriors(docs, model).write.mode("errorifexists").parquet(path)
    known = spark.read.parquet(path)
    steps = solve(known, targets, total)[0] if model.words is not None else []
    chance = F.pmod(F.xxhash64("doc_id", "row", F.lit(7)), F.lit(1 << 20)) / float(1 << 20)
    return known.withColumn("rate", rate_of(steps)).withColumn("times", F.floor(F.col("rate") + chance).cast("int"))


def op3_soft_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(common.documents(spark, sf_dir), common.table(spark, sf_dir, "labels"))
    each = mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select("doc_id", F.col("tokens").alias("n_tokens"), *[F.round(F.col("p")[i], 9).alias(f"p_{d}") for i, d in enumerate(DOMAINS)],
                       F.round("rate", 6).alias("rate"), "times")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every row as often as its rate gives it out, with its columns as they are."""
    mixed = mix(docs, common.table(spark, sf_dir, "labels"))
    name = "times"
    while any(name in c for c in docs.columns):  # helper columns hold the name
        name += "_"
    mixed = mixed.where(F.col("times") > 0).select(F.col("doc_id").alias(f"{name}_id"), F.col("row").alias(f"{name}_row"), F.col("times").alias(name))
    held = docs.withColumn(f"{name}_text", F.xxhash64(F.coalesce("text", F.lit(""))))
    joined = held.join(mixed, F.col("doc_id").eqNullSafe(F.col(f"{name}_id")) & (F.col(f"{name}_text") == F.col(f"{name}_row")))
    return joined.withColumn(f"{name}_copy", F.explode(F.sequence(F.lit(1), F.col(name)))).select(*docs.columns)
