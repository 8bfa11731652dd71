"""Language identification by fusing evidence in a Bayesian way.

The classes are the languages of a labelled sample and, last, ``und``: a language that the sample doesn't hold. For
every class the fused log score adds
  - the text: byte-trigram log likelihoods (no digits, runs of marks and spaces as one space), counted as at most TEXT_TRIGRAMS independent ones (neighbouring trigrams
    are not independent, so a long text must not drown everything else). ``und`` takes every trigram bucket for equally
    likely, and each language's model gives BACKGROUND of its mass to that too: a text most of whose trigrams a
    language hardly uses fits ``und`` better, whatever the size of the sample;
  - the declared markup language: right with probability DECLARED_TRUST, else any other class alike; a declaration
    that the sample doesn't hold speaks for ``und``;
  - the address suffix (country domains): right with probability SUFFIX_TRUST, likewise;
  - a host prior: text posteriors summed per host by grouped aggregation, smoothed with those of the parent domain,
    which are smoothed with those of the whole corpus; a row's own share is left out at all three levels.

The trigram model is fitted on the FIT_ROWS labelled rows of smallest id hash (a documented bound); everything else
covers all rows. Each text is scored once: the rows are written with their scores to the shared folder and read again,
for the sums and for the answer. Posteriors are summed as whole millionths, so no order of summing changes a result.
The host table is written and read again too, so that Spark knows its size and broadcasts it only below its own
threshold; beyond, it is a sort-merge join whose hot hosts adaptive execution splits.

Defined results: a null or empty text, or one without letters, has language null, confidence 0 and is not kept; one
that fits ``und`` best has language ``und`` and is not kept; equal scores go to the language first by name, ``und``
last; letters without a single trigram (beside digits) leave the answer to the other evidence; null, empty or ``und`` declarations and addresses without a listed suffix give no evidence; rows without a host
share one prior, and a host without dots has no parent but the corpus; very long texts are scored whole, in blocks of
bytes; a null doc_id is carried; repeated rows are judged one by one; clashing extra columns are left alone; an empty
table gives an empty result; without any labelled row nothing is kept. Confidences are rounded to 6 places.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import common

BUCKETS = 1 << 14
FIT_ROWS = 4000
TEXT_TRIGRAMS = 120
DECLARED_TRUST = 0.9
SUFFIX_TRUST = 0.7
HOST_STRENGTH = 20.0
PARENT_STRENGTH = 100.0
MIN_CONFIDENCE = 0.5
BACKGROUND = 0.05
UNKNOWN = "und"
MILLION = 1_000_000

# Country domains whose sites mostly use one language.
SUFFIX_LANGUAGE = {
    "at": "de", "de": "de", "ar": "es", "cl": "es", "co": "es", "es": "es", "mx": "es", "fr": "fr", "au": "en",
    "ie": "en", "nz": "en", "uk": "en", "us": "en", "br": "pt", "pt": "pt", "it": "it", "nl": "nl", "pl": "pl",
}
LETTER = re.compile(r"[^\W\d_]")


# Bytes as the trigrams see them: letters (and all of UTF-8 beyond ASCII) as they are, digits 0, everything else a space.
SEEN = bytes(b if chr(b).isalpha() or b > 127 else 0 if chr(b).isdigit() else 32 for b in range(256))


def trigrams(data: bytes) -> np.ndarray:
    """Bucket numbers of the byte trigrams without digits and without two spaces in a row."""
    a = np.frombuffer(data.translate(SEEN), dtype=np.uint8)
    if len(a) < 3:
        return np.empty(0, dtype=np.uint32)
    gap, digit = a == 32, a == 0
    use = ~(digit[:-2] | digit[1:-1] | digit[2:] | (gap[1:-1] & (gap[:-2] | gap[2:])))
    x, y, z = (part[use].astype(np.uint32) for part in (a[:-2], a[1:-1], a[2:]))
    return ((x << np.uint32(16) | y << np.uint32(8) | z) * np.uint32(2654435761)) >> np.uint32(32 - 14)


def blocks(text: str, size: int = 1 << 20):
    """Trigram buckets of the whole lower-cased text, a block of bytes at a time (blocks overlap by two bytes)."""
    data = f" {text.lower()} ".encode("utf-8", "surrogatepass")
    for at in range(0, len(data) - 2, size):
        yield trigrams(data[at:at + size + 2])


class TrigramModel:
    """Per bucket the log probabilities of the languages; ``und`` has the same one everywhere."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        share = counts / counts.sum(axis=1, keepdims=True) if languages else counts
        self.log = np.ascontiguousarray(np.log((1 - BACKGROUND) * share + BACKGROUND / BUCKETS).T.astype(np.float32)) \
            if languages else np.empty((BUCKETS, 0), np.float32)

    def score(self, text: str) -> list[float] | None:
        """Tempered log likelihood per class; None for a text without letters, zeros for one without trigrams."""
        if not LETTER.search(text):
            return None
        total, n = np.zeros(len(self.languages)), 0
        for found in blocks(text):
            total += self.log[found].sum(axis=0, dtype=np.float64)
            n += len(found)
        return (np.append(total, -n * math.log(BUCKETS)) * (min(n, TEXT_TRIGRAMS) / max(n, 1))).tolist()


def code_of(name: Column) -> Column:
    """A language tag's first part, lower case; null if there is none or it says ``und``."""
    code = F.lower(F.trim(F.substring_index(F.translate(name, "_", "-"), "-", 1)))
    return F.when((code != "") & (code != UNKNOWN), code)


def fit(labelled: DataFrame, rows: int = FIT_ROWS) -> TrigramModel:
    """Trigram counts per language of ``rows`` labelled rows (doc_id, text, lang), chosen by hash."""
    named = labelled.select("doc_id", "text", code_of(F.col("lang")).alias("lang")).where(F.col("lang").isNotNull())
    sample = common.bounded_sample(named, rows, "doc_id", "lang").where(F.col("text").isNotNull()).select("text", "lang")

    def counted(batches):
        for pdf in batches:
            for lang, texts in pdf.groupby("lang")["text"]:
                total = sum((np.bincount(found, minlength=BUCKETS) for t in texts for found in blocks(t)), np.zeros(BUCKETS, np.int64))
                at = np.flatnonzero(total)
                yield pd.DataFrame({"lang": lang, "bucket": at, "n": total[at]})

    found = (sample.mapInPandas(counted, "lang string, bucket int, n long").groupBy("lang", "bucket")
             .agg(F.sum("n").alias("n")).toPandas())  # at most BUCKETS rows per language of a bounded sample
    languages = sorted(found["lang"].unique().tolist())
    counts = np.zeros((len(languages), BUCKETS))
    counts[[languages.index(x) for x in found["lang"]], found["bucket"].to_numpy(int)] = found["n"].to_numpy()
    return TrigramModel(languages, counts)


# --- evidence columns ------------------------------------------------------------------------------------------------

def host_of(address: Column) -> Column:
    """Host of an address, lower case, without port; null if there is none."""
    host = F.regexp_extract(F.lower(address), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def parent_of(host: Column) -> Column:
    """The last two labels of a host; null for a key without dots."""
    return F.when(F.contains(host, F.lit(".")), F.substring_index(host, ".", -2))


def suffix_language(address: Column) -> Column:
    suffix = F.substring_index(host_of(address), ".", -1)
    table = F.create_map(*[F.lit(x) for pair in SUFFIX_LANGUAGE.items() for x in pair])
    return F.try_element_at(table, F.coalesce(suffix, F.lit("")))


def declared_of_markup(html: Column) -> Column:
    """The language an html tag declares."""
    lang = F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1)
    return F.when(lang != "", F.lower(lang))


def _named(languages: list[str], name: Column, trust: float) -> Column:
    """log P(a source names ``name`` | class) per class; zeros where it names nothing."""
    code, other = code_of(name), math.log((1 - trust) / len(languages))
    right = [code == x for x in languages] + [~code.isin(languages)]
    return F.array(*[F.when(r, math.log(trust)).when(code.isNotNull(), other).otherwise(0.0) for r in right])


def posterior(scores: np.ndarray) -> np.ndarray:
    """Softmax of each row of log scores."""
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def millionths(shares: np.ndarray) -> np.ndarray:
    return np.rint(shares * MILLION).astype(np.int64)


# --- operator --------------------------------------------------------------------------------------------------------

SCORED = "scores array<double>, own array<long>"
ANSWER = "language string, confidence double, text_language string, text_confidence double, kept boolean"


def _scorer(model: TrigramModel):
    """Log scores and text posteriors (millionths) per class; nulls for a text without letters."""
    @F.pandas_udf(SCORED)
    def score(texts: pd.Series) -> pd.DataFrame:
        scores = [model.score(t or "") for t in texts]
        own = [None if s is None else millionths(posterior(np.array([s])))[0].tolist() for s in scores]
        return pd.DataFrame({"scores": pd.Series(scores, dtype=object), "own": pd.Series(own, dtype=object)})

    return score.asNondeterministic()  # evaluated once per row, never copied into a filter


def _level(sums: np.ndarray, strength: float, above: np.ndarray) -> np.ndarray:
    """Shares of whole millionths, smoothed with ``strength`` rows spread as the level above."""
    sums = sums / MILLION
    return (sums + strength * above) / (sums.sum(axis=1, keepdims=True) + strength)


def fuse(scores: np.ndarray, told: np.ndarray, own: np.ndarray, host: np.ndarray, parent: np.ndarray, orphan: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Posteriors of rows from all evidence; ``orphan`` rows have no parent host. A row's own share is left out."""
    n = len(whole)
    base = _level(whole - own, n, np.full(own.shape, 1.0 / n))
    above = np.where(orphan[:, None], base, _level(parent - own, PARENT_STRENGTH, base))
    return posterior(scores + told + np.log(_level(host - own, HOST_STRENGTH, above)))


def _answerer(classes: list[str], whole: list[int]):
    @F.pandas_udf(ANSWER)
    def answer(scores: pd.Series, told: pd.Series, own: pd.Series, h: pd.Series, p: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"language": None, "confidence": 0.0, "text_language": None, "text_confidence": 0.0, "kept": False}, index=scores.index)
        lettered = scores.notna().to_numpy()
        if lettered.any():
            orphan = p[lettered].isna().to_numpy()
            mine = np.stack(own[lettered].to_list())
            parent = np.stack([m if x is None else x for m, x in zip(mine, p[lettered], strict=True)])
            text = np.stack(scores[lettered].to_list())
            fused = fuse(text, np.stack(told[lettered].to_list()), mine, np.stack(h[lettered].to_list()), parent, orphan, np.array(whole))
            names = np.array(classes, dtype=object)
            for kind, found in (("", fused), ("text_", posterior(text))):
                out.loc[lettered, f"{kind}language"] = names[found.argmax(axis=1)]
                out.loc[lettered, f"{kind}confidence"] = found.max(axis=1).round(6)
            out["kept"] = lettered & (out["language"] != UNKNOWN) & (out["confidence"] >= MIN_CONFIDENCE)
        return out

    return answer


def host_priors(scored: DataFrame, n: int, path: str) -> tuple[DataFrame, list[int]]:
    """Summed posteriors in millionths: host, h (the host's), p (its parent's, null without one), and the corpus'."""
    spark = scored.sparkSession
    hosts = (scored.where(F.col("own").isNotNull()).groupBy("host").agg(*[F.sum(F.col("own")[i]).alias(f"h{i}") for i in range(n)])
             .withColumn("parent", parent_of(F.col("host"))))
    hosts.write.mode("errorifexists").parquet(f"{path}/hosts")
    hosts = spark.read.parquet(f"{path}/hosts")
    parents = hosts.groupBy("parent").agg(*[F.sum(f"h{i}").alias(f"p{i}") for i in range(n)])
    whole = [x or 0 for x in parents.agg(*[F.sum(f"p{i}") for i in range(n)]).first()]
    sums = parents.where(F.col("parent").isNotNull()).select("parent", F.array(*[f"p{i}" for i in range(n)]).alias("p"))
    (hosts.join(sums, "parent", "left").select("host", F.array(*[f"h{i}" for i in range(n)]).alias("h"), "p")
     .write.mode("errorifexists").parquet(f"{path}/priors"))
    return spark.read.parquet(f"{path}/priors"), whole


def identify(rows: DataFrame, model: TrigramModel, text: Column, declared: Column, address: Column, host: Column,
             column: str = "identified", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all) with a struct: language, confidence, text_language, text_confidence, kept."""
    keep = rows.columns if keep is None else keep
    work = "__" + column
    if not model.languages:
        empty = F.struct(F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"),
                         F.lit(None).cast("string").alias("text_language"), F.lit(0.0).alias("text_confidence"), F.lit(False).alias("kept"))
        return rows.select(*keep).withColumn(column, empty)
    classes = [*model.languages, UNKNOWN]
    path = scratch_path(rows.sparkSession, "languages")
    told = F.zip_with(_named(model.languages, declared, DECLARED_TRUST), _named(model.languages, suffix_language(address), SUFFIX_TRUST), lambda x, y: x + y)
    (rows.select(*keep, F.struct(_scorer(model)(text).alias("text"), F.coalesce(host, F.lit("")).alias("host"), told.alias("told")).alias(work))
     .write.mode("errorifexists").parquet(f"{path}/scored"))
    scored = rows.sparkSession.read.parquet(f"{path}/scored")
    row = F.col(work)
    priors, whole = host_priors(scored.select(row["host"].alias("host"), row["text"]["own"].alias("own")), len(classes), path)
    priors = priors.select(F.col("host").alias(f"{work}_key"), F.struct("h", "p").alias(f"{work}_prior"))
    prior = F.col(f"{work}_prior")
    answer = _answerer(classes, whole)(row["text"]["scores"], row["told"], row["text"]["own"], prior["h"], prior["p"])
    return scored.join(priors, row["host"] == F.col(f"{work}_key"), "left").withColumn(column, answer).select(*keep, column)


def identify_documents(docs: DataFrame, column: str = "identified", model: TrigramModel | None = None, keep: list[str] | None = None) -> DataFrame:
    """documents: declared language ``lang``, host key ``source``; they have no address, so no suffix and no parent."""
    model = fit(docs) if model is None else model
    return identify(docs, model, F.col("text"), F.col("lang"), F.lit(None).cast("string"), F.col("source"), column, keep)


def identify_pages(pages: DataFrame, model: TrigramModel, column: str = "identified", keep: list[str] | None = None) -> DataFrame:
    """pages: declared by the html tag, suffix and host from the address; tags are blanked out of the text."""
    words = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    return identify(pages, model, words, declared_of_markup(F.col("html")), F.col("url"), host_of(F.col("url")), column, keep)


def op8_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    return identify_documents(docs, keep=["doc_id"]).select("doc_id", "identified.*")


def op8_page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four kinds of evidence: every page, by the model fitted on labelled documents."""
    model = fit(common.documents(spark, sf_dir).select("doc_id", "text", "lang"))
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return identify_pages(pages, model, keep=["page_id", "url"]).select("page_id", "url", "identified.*")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows whose language is known, with their columns as they are."""
    common.prepare(spark)
    name = "identified"
    while any(name in c for c in docs.columns):  # helper columns hold the name
        name += "_"
    return identify_documents(docs, name).where(F.col(f"{name}.kept")).select(*docs.columns)
