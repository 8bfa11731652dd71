"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger row stores one failure bit per rule and the measurement behind
it. A policy (name, version, set of rules) is a mask over those bits, so applying another policy version, or an
ablation (what would be kept without rule r), reads the ledger and never the texts.

Defined results: a null or empty text has no words, fails ``min_words`` and gets measurements of 0; a null doc_id is
carried as it is; a very long text is measured whole, in linear time; repeated rows are judged one by one; an empty table gives an empty ledger; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SYMBOLS = re.compile(r"[#*$%&|<>]")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
# a word's first letter and all that follows in the word: one match per word with a letter, in linear time
LETTER_WORDS = re.compile(r"[^\W\d_][^\x20\x09-\x0D]*+")

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words")
MEASURE_NAME = re.compile("|".join(sorted(MEASURES, key=len, reverse=True)))


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL condition over the measurements; rule i owns bit i of fail_bits."""
    name: str
    fails: str


# Fixed order: a rule keeps its bit for ever; new rules are appended.
RULES = (
    Rule("min_words", "n_words < 50"),
    Rule("repeat_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols_per_word", "100 * n_symbols > 10 * n_words"),
    Rule("duplicate_lines", "n_lines > 3 and 100 * n_dup_lines > 40 * n_lines"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 12 * n_words"),
    Rule("letter_words", "100 * n_letter_words < 60 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return mask_of(self.rules)


BASE = Policy("base", 1, ("min_words", "repeat_words"))
POLICIES = (
    BASE,
    Policy("strict", 1, ("min_words", "repeat_words", "symbols_per_word", "duplicate_lines")),
    Policy("strict", 2, tuple(r.name for r in RULES)),
)
DEFAULT_POLICY = POLICIES[-1]


def mask_of(names) -> int:
    bits = {r.name: 1 << i for i, r in enumerate(RULES)}
    return sum(bits[n] for n in set(names))


def measure(text: str) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of MEASURES."""
    words = common.word_hashes(text.encode("utf-8", "surrogatepass"))
    n = len(words)
    repeated = 0
    if n >= 3:
        windows = common.shingles(words, 3)
        _, back, times = np.unique(windows, return_inverse=True, return_counts=True)
        twice = times[back] > 1
        inside = np.zeros(n, dtype=bool)
        for j in range(3):
            inside[j:n - 2 + j] |= twice
        repeated = int(inside.sum())
    spaces = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (n, len(text) - spaces, len(SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated, len(lines),
            len(LETTER_WORDS.findall(text)))


@F.pandas_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def _measured(texts: pd.Series) -> pd.DataFrame:
    rows = np.array([measure(t or "") for t in texts], dtype="int64").reshape(-1, len(MEASURES))
    return pd.DataFrame(rows, columns=list(MEASURES))


# Not to be copied into a pushed-down filter: each text is measured once.
_measured = _measured.asNondeterministic()


def with_ledger(docs: DataFrame, column: str = "ledger") -> DataFrame:
    """The rows with a struct of the measurements and fail_bits (bit i: RULES[i] failed); no shuffle."""
    measured = docs.withColumn(column, _measured(F.col("text")))
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES):
        fails = F.expr(MEASURE_NAME.sub(lambda m: f"{column}.{m[0]}", rule.fails))
        bits = bits.bitwiseOR(F.when(fails, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn(column, F.col(column).withField("fail_bits", bits))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and fail_bits; one row per input row."""
    return with_ledger(docs.select("doc_id", "text")).select("doc_id", "ledger.*")


def passes(policy: Policy, bits: str = "fail_bits"):
    return F.col(bits).bitwiseAND(F.lit(policy.mask)) == 0


def apply_policy(rows: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """The ledger with base_failed and kept (never true where base_failed is)."""
    return (rows.withColumn("base_failed", ~passes(BASE))
            .withColumn("kept", passes(BASE) & passes(policy)))


def ablations(rows: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Per rule of the policy: failures, documents only this rule rejects, and documents kept without it.

    One grouped count over the distinct masked bit patterns (at most 2 ** len(RULES)), then bitwise sums over those.
    """
    patterns = (rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("bits"))
                .agg(F.count(F.lit(1)).alias("n")))
    names = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
                      for i, r in enumerate(RULES) if r.name in policy.rules])
    by_rule = patterns.select("bits", "n", F.inline(names))
    count = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    return by_rule.groupBy("rule").agg(
        count(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count(F.col("bits") == F.col("bit")).alias("n_only_this"),
        count(F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("n_kept_without"))


def op1_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = apply_policy(ledger(common.documents(spark, sf_dir)))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "n_lines", "n_letter_words", "fail_bits")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows whose text passes the base and the default policy, with their columns as they are."""
    common.prepare(spark)
    name = "ledger"
    while name in docs.columns:
        name += "_"
    judged = with_ledger(docs, name)
    return judged.where(passes(BASE, f"{name}.fail_bits") & passes(DEFAULT_POLICY, f"{name}.fail_bits")).select(*docs.columns)
