"""Near-duplicate detection by improved consistent weighted sampling over TF-IDF shingles.

1. Document frequencies of all five-word shingles are counted over all documents into DF_BUCKETS hashed counters (a
   table of fixed size), which gives every shingle its idf. A counter that a rare shingle shares holds about (shingles of
   a document) / DF_BUCKETS of all documents, 0.1% at 300 shingles, however many documents there are: so rare shingles
   have nearly one idf, and those of more than some 0.1% of the documents a lower one. Copies have one vote together: a first pass groups texts by
   plain min-hashes (GROUP_BANDS x GROUP_ROWS), and each row votes with 1 / the rows of its group. So the size of a group
   doesn't push down what its members share.
2. Each text draws HASHES consistent weighted samples (Ioffe's scheme: per shingle and hash two gamma variates and a
   uniform one, looked up in fixed pools by bits of the shingle's hash), banded BANDS x ROWS.
3. Equal texts are one node from the start. Nodes that share a band bucket are candidates. First every member of a
   bucket is compared with the bucket's smallest member; components of the verified links make classes. Then, in
   buckets that still hold several classes, the members outside the largest class are compared with all members, in
   blocks of at most BLOCK rows a side; a pair that several buckets show is compared in the first of them, and only
   links leave the block. So no link that a bucket shows is lost for the classes, a large group of copies costs a star,
   and no pairs are written out.
4. A pair is a link if the weighted Jaccard similarity of the whole texts is at least THRESHOLD.

With BANDS x ROWS = 16 x 3, a pair at the threshold is missed with probability (1 - 0.8 ** 3) ** 16 = 1e-5.

Intermediate tables go to the shared folder, so a lost executor costs only its own tasks.

Defined results: equal texts (null counts as empty) are one class; a text without words has no other partners, one
with fewer than five words is a single shingle; class_id is the smallest doc_id of the class (null only if all are);
repeated rows get a row each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import common

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 3
HASHES = BANDS * ROWS
DF_BUCKETS = 1 << 18
GROUP_BANDS, GROUP_ROWS = 8, 8  # of the first pass: pairs at 0.8 meet with probability 0.77, pairs at 0.3 with 5e-4
VOTE = 1 << 32  # one vote in whole numbers, whose sums are the same in any order
CHUNK = 2048
BLOCK = 512
POOL = 1 << 16


# --- weights ---------------------------------------------------------------------------------------------------------

def shingle_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a whole text (sorted hashes) and how often each stands in it."""
    found = common.shingles(common.word_hashes(text.encode("utf-8", "surrogatepass")), WORDS)
    return np.unique(found, return_counts=True)


def df_bucket(shingle: np.ndarray) -> np.ndarray:
    return (shingle >> np.uint64(64 - 18)).astype(np.int64)  # DF_BUCKETS = 2 ** 18


@functools.cache
def _group_odds() -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(21))
    return rng.integers(0, 1 << 63, GROUP_BANDS * GROUP_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def group_keys(found: np.ndarray) -> np.ndarray:
    """Bucket key of each band of plain min-hashes of a text's shingles; none for a text without words."""
    if not len(found):
        return np.empty(0, dtype=np.int64)
    odd = _group_odds()[:, None]
    low = np.min([(found[None, at:at + CHUNK] * odd).min(axis=1) for at in range(0, len(found), CHUNK)], axis=0)
    return _band_keys(low.reshape(GROUP_BANDS, GROUP_ROWS))


def packed_buckets(found: np.ndarray) -> bytes:
    """Counters of a text's distinct shingles, sorted, as steps of two bytes, or as they are where a step is larger."""
    at = np.sort(df_bucket(found))
    steps = np.diff(at, prepend=0)
    return b"\0" + steps.astype("<u2").tobytes() if not len(at) or steps.max() < 1 << 16 else b"\1" + at.astype("<u4").tobytes()


def unpacked_buckets(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, "<u2", offset=1), dtype=np.int64) if data[:1] == b"\0" else np.frombuffer(data[1:], "<u4").astype(np.int64)


def sketches(docs: DataFrame, path: str) -> DataFrame:
    """One row per distinct text: node, keys of its plain min-hashes, counters of its shingles, n (rows)."""

    def sketched(batches):
        for pdf in batches:
            found = [shingle_counts(t)[0] for t in pdf["text"]]
            yield pd.DataFrame({"node": pdf["node"], "keys": [group_keys(x) for x in found], "buckets": [packed_buckets(x) for x in found]})

    rows = common.text_of(docs).withColumn("node", node_of(F.col("text"))).mapInPandas(sketched, "node binary, keys array<long>, buckets binary")
    return _stored(rows.groupBy("node").agg(F.first(F.struct("keys", "buckets")).alias("s"), F.count(F.lit(1)).alias("n"))
                   .select("node", "s.keys", "s.buckets", "n"), f"{path}/sketches")


def copy_votes(nodes: DataFrame, path: str) -> DataFrame:
    """node and vote (VOTE / rows of its group) of the sketched texts in groups of several rows."""
    buckets = nodes.select("node", F.explode("keys").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("met")).where(F.col("met") > 1)
    edges = buckets.join(shared, "bucket").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    roots = components(edges, f"{path}/groups")
    grouped = nodes.select("node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = grouped.groupBy("root").agg(F.sum("n").alias("rows")).where(F.col("rows") > 1)
    return _stored(grouped.join(sizes, "root").select("node", F.expr(f"{VOTE}L div rows").alias("vote")), f"{path}/votes")


def idf_table(docs: DataFrame, path: str | None = None) -> np.ndarray:
    """log(1 + N / df) per hashed counter, N and df in votes; DF_BUCKETS numbers whatever the input's size.

    Texts are read once, for the sketches; votes meet the sketches' counters, a tenth of the texts' size.
    """

    def counted(batches):
        total, n = np.zeros(DF_BUCKETS, dtype=np.int64), 0
        for pdf in batches:
            n += int(pdf["votes"].sum())
            for data, votes in zip(pdf["buckets"], pdf["votes"], strict=True):
                np.add.at(total, unpacked_buckets(data), votes)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": np.append(at, -1), "n": np.append(total[at], n)})

    path = path or scratch_path(docs.sparkSession, "copy-groups")
    nodes = sketches(docs, path)
    rows = nodes.join(copy_votes(nodes, path), "node", "left").select("buckets", (F.col("n") * F.coalesce("vote", F.lit(VOTE))).alias("votes"))
    counts = rows.mapInPandas(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(DF_BUCKETS)
    known = counts[counts["bucket"] >= 0]
    total[known["bucket"].to_numpy(int)] = known["n"].to_numpy() / VOTE
    n = int(counts.loc[counts["bucket"] < 0, "n"].sum()) / VOTE
    return np.log1p(max(n, 1) / np.maximum(total, 1)).astype(np.float32)


def weights(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingle hashes and their tf * idf."""
    found, times = shingle_counts(text)
    return found, times.astype(np.float32) * idf[df_bucket(found)]


def weighted_jaccard(a, b) -> float:
    """Sum of the smaller weights over sum of the larger ones."""
    (x, v), (y, w) = a, b
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    low = float(np.minimum(v[i], w[j]).sum(dtype=np.float64))
    total = float(v.sum(dtype=np.float64)) + float(w.sum(dtype=np.float64)) - low
    return low / total if total else 0.0


# --- samples ---------------------------------------------------------------------------------------------------------

@functools.cache
def _pools():
    """Gamma(2, 1), the log of another Gamma(2, 1), and Uniform(0, 1) variates, and an odd multiplier per hash."""
    rng = np.random.Generator(np.random.PCG64(20))
    gamma = lambda: (rng.standard_exponential(POOL) + rng.standard_exponential(POOL)).astype(np.float32)
    r, c = np.maximum(gamma(), np.float32(1e-4)), np.maximum(gamma(), np.float32(1e-6))
    odd = rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return r, np.log(c), rng.random(POOL, dtype=np.float32), odd


def samples(shingle: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """One 64-bit sample (of shingle and quantised weight) per hash; equal with the weighted Jaccard's probability."""
    r_pool, c_pool, b_pool, odd = _pools()
    best = np.full(HASHES, np.inf, dtype=np.float32)
    drawn = np.zeros(HASHES, dtype=np.uint64)
    log_weight = np.log(weight)
    for at in range(0, len(shingle), CHUNK):
        some = shingle[at:at + CHUNK]
        bits = (some[None, :] * odd[:, None]).view(np.uint16).reshape(HASHES, len(some), 4)
        r = r_pool[bits[..., 1]]
        b = b_pool[bits[..., 3]]
        t = np.floor(log_weight[None, at:at + CHUNK] / r + b)
        a = c_pool[bits[..., 2]] - r * (t - b + np.float32(1))
        first = a.argmin(axis=1)
        rows = np.arange(HASHES)
        low = a[rows, first]
        better = low < best
        best = np.where(better, low, best)
        drawn = np.where(better, common.mix(some[first] + t[rows, first].astype(np.int64).astype(np.uint64)), drawn)
    return drawn


def bands(text: str, idf: np.ndarray) -> np.ndarray:
    """Bucket key of each band (the band's number is mixed in); none for a text without words."""
    shingle, weight = weights(text, idf)
    if not len(shingle):
        return np.empty(0, dtype=np.int64)
    return _band_keys(samples(shingle, weight).reshape(BANDS, ROWS))


def _band_keys(drawn: np.ndarray) -> np.ndarray:
    key = np.arange(1, len(drawn) + 1, dtype=np.uint64)
    for j in range(drawn.shape[1]):
        key = common.mix(key * np.uint64(0x9E3779B97F4A7C15) + drawn[:, j])
    return key.view(np.int64)


# --- links -----------------------------------------------------------------------------------------------------------

def node_of(text: Column) -> Column:
    """A 128-bit fingerprint of the text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def signatures(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """doc_id, node, bands per row."""

    def signed(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "node": pdf["node"], "bands": [bands(t, idf) for t in pdf["text"]]})

    return (common.text_of(docs, "doc_id").withColumn("node", node_of(F.col("text")))
            .mapInPandas(signed, "doc_id long, node binary, bands array<long>"))


def verified(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) whose texts reach the threshold, with their similarity."""

    def compared(batches):
        last, held = None, None
        for pdf in batches:
            kept = []
            for a, b, x, y in zip(pdf["a"], pdf["b"], pdf["text_a"], pdf["text_b"], strict=True):
                if a != last:  # rows come sorted by a from the join
                    last, held = a, weights(x, idf)
                kept.append(weighted_jaccard(held, weights(y, idf)))
            yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "similarity": pd.Series(kept, dtype="float64")})

    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return joined.mapInPandas(compared, "a binary, b binary, similarity double").where(F.col("similarity") >= threshold)


def _links_of(bucket: int, rows: list[tuple], idf: np.ndarray, threshold: float) -> list[tuple]:
    """Links across classes between the left rows (outsiders) and the right rows of one block; rows are
    (side, node, root, outside, bands, text)."""
    left, right = [r for r in rows if r[0] == 0], [r for r in rows if r[0] == 1]
    if not left or not right:
        return []
    theirs = np.stack([r[4] for r in right])
    nodes, outside = np.array([r[1] for r in right], dtype=object), np.array([r[3] for r in right])
    roots = np.array([r[2] for r in right], dtype=object)
    meetings = []
    for row in left:
        agree = theirs == row[4][None, :]
        first = theirs[np.arange(len(right)), agree.argmax(axis=1)]
        # in the first bucket the two share, and two outsiders, who meet in both orders, in one of them
        wanted = (first == bucket) & agree.any(axis=1) & (roots != row[2]) & (~outside | (nodes > row[1]))
        if wanted.any():
            meetings.append((row, wanted))
    if not meetings:
        return []
    needed = np.flatnonzero(np.any([w for _, w in meetings], axis=0))
    vectors = {r[1]: weights(r[5], idf) for r in [*(right[j] for j in needed), *(row for row, _ in meetings)]}
    names, numbers = np.unique(np.concatenate([vectors[nodes[j]][0] for j in needed]), return_inverse=True)
    weight = np.concatenate([vectors[nodes[j]][1] for j in needed])
    starts = np.cumsum([0, *[len(vectors[nodes[j]][0]) for j in needed[:-1]]])
    totals = np.add.reduceat(weight.astype(np.float64), starts)
    mark = np.zeros(len(names), dtype=np.float32)
    found = []
    for row, wanted in meetings:
        shingle, own = vectors[row[1]]
        at = np.minimum(np.searchsorted(names, shingle), len(names) - 1)
        known = names[at] == shingle
        mark[at[known]] = own[known]
        low = np.add.reduceat(np.minimum(mark[numbers], weight).astype(np.float64), starts)
        mark[at[known]] = 0
        similarity = low / (totals + float(own.sum(dtype=np.float64)) - low)
        for j in np.flatnonzero(wanted[needed] & (similarity >= threshold)):
            found.append((row[1], nodes[needed[j]], float(similarity[j])))
    return found


def block_links(members: DataFrame, texts: DataFrame, idf: np.ndarray, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Links across classes within the buckets of ``members`` (bucket, node, root): a, b, similarity."""
    sizes = members.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("bucket").agg(F.sum("n").alias("n"), F.max("n").alias("top"), F.max(F.struct("n", "root"))["root"].alias("main"))
    sizes = sizes.where(F.col("n") > F.col("top"))
    dealt = (members.join(sizes, "bucket").withColumn("outside", F.col("root") != F.col("main"))
             .withColumn("rows", F.ceil(F.col("n") / block).cast("int")).withColumn("outs", F.ceil((F.col("n") - F.col("top")) / block).cast("int"))
             .withColumn("deal", F.xxhash64("node", F.lit(3))).withColumn("i", F.pmod("deal", "outs").cast("int")).withColumn("j", F.pmod("deal", "rows").cast("int")))
    count = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    place = lambda side, i, j: F.struct(F.lit(side).alias("side"), i.alias("at"), j.alias("to"))
    as_right = F.transform(count("outs"), lambda i: place(1, i, F.col("j")))
    as_left = F.when(F.col("outside"), F.transform(count("rows"), lambda j: place(0, F.col("i"), j))).otherwise(F.array().cast(
        "array<struct<side:int,at:int,to:int>>"))
    placed = dealt.join(texts, "node").select("bucket", "node", "root", "outside", "bands", "text", F.inline(F.concat(as_right, as_left)))

    def linked(batches):
        key, rows = None, []
        for pdf in batches:
            found = []
            for bucket, at, to, *row in zip(*[pdf[c] for c in ("bucket", "at", "to", "side", "node", "root", "outside", "bands", "text")], strict=True):
                if key != (bucket, at, to):
                    found += _links_of(key[0], rows, idf, threshold) if rows else []
                    key, rows = (bucket, at, to), []
                rows.append(row)
            yield pd.DataFrame(found, columns=["a", "b", "similarity"])
        if rows:
            yield pd.DataFrame(_links_of(key[0], rows, idf, threshold), columns=["a", "b", "similarity"])

    # blocks are runs of sorted rows: most are tiny, and a group of their own in Python would cost more than they do
    runs = placed.repartition("bucket", "at", "to").sortWithinPartitions("bucket", "at", "to", "side", "node")
    return runs.mapInPandas(linked, "a binary, b binary, similarity double")


def components(edges: DataFrame, path: str) -> DataFrame:
    """node and root (smallest node of its component) from edges a, b; alternating large and small stars.

    Each round is written, and rounds end when the edges no longer change.
    """
    spark = edges.sparkSession
    now = _stored(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct(), f"{path}/0")
    mark, turn = None, 0
    while True:
        new_mark = now.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("x", "y")), F.lit(0))).first()
        if new_mark == mark or new_mark[0] == 0:
            return now.select(F.col("x").alias("node"), F.col("y").alias("root"))
        mark, turn = new_mark, turn + 1
        both = now.select(F.col("x").alias("u"), F.col("y").alias("v")).unionByName(now.select(F.col("y").alias("u"), F.col("x").alias("v")))
        lowest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(lowest, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("x"), F.col("m").alias("y")).distinct()
        large = _stored(large, f"{path}/{turn}-large")
        lowest = large.groupBy("x").agg(F.min("y").alias("m"))
        met = large.join(lowest, "x")
        small = (met.where(F.col("y") != F.col("m")).select(F.col("y").alias("x"), F.col("m").alias("y"))
                 .unionByName(lowest.select("x", F.col("m").alias("y"))).distinct())
        now = _stored(small, f"{path}/{turn}")


def near_duplicates(docs: DataFrame, path: str | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, node and class_id per row, and the class's representative (rep_id, rep_node: its smallest doc_id)."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "near-duplicates")
    idf = idf_table(docs, f"{path}/copies")
    signed = _stored(signatures(docs, idf), f"{path}/signatures")
    nodes = signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    members = _stored(buckets.join(shared, "bucket").select("bucket", "node", "leader"), f"{path}/members")
    # one row of each text, by its smallest id; joined on both, so many copies of a text don't meet in one task
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    wanted = members.select("node").distinct().join(nodes.select("node", "bands", key.alias("id")), "node")
    texts = (common.text_of(docs, "doc_id").withColumn("node", node_of(F.col("text"))).withColumn("id", key)
             .join(wanted, ["node", "id"]).dropDuplicates(["node", "id"]).select("node", "text", "bands"))
    texts = _stored(texts, f"{path}/texts")
    pairs = _stored(members.where(F.col("node") != F.col("leader")).select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), f"{path}/pairs")
    links = _stored(verified(pairs, texts, idf, threshold), f"{path}/links")
    roots = components(links, f"{path}/components")
    # what is left: members of one bucket in different classes
    placed = members.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    more = _stored(block_links(_stored(placed, f"{path}/placed"), texts, idf, threshold), f"{path}/more")
    roots = components(links.unionByName(more), f"{path}/classes")
    classed = nodes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("node"))
    reps = classed.groupBy("root").agg(F.min(first).alias("rep"))
    by_node = classed.select("node", "root").join(reps, "root").select(
        "node", F.col("rep.doc_id").alias("rep_id"), F.col("rep.node").alias("rep_node"))
    return signed.select("doc_id", "node").join(by_node, "node").select("doc_id", "node", F.col("rep_id").alias("class_id"), "rep_id", "rep_node")


def op4_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.documents(spark, sf_dir)).select("doc_id", "class_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of every class (its smallest doc_id), with its columns as they are."""
    common.prepare(spark)
    name = "node"
    while name in docs.columns:
        name += "_"
    reps = (near_duplicates(docs).where((F.col("node") == F.col("rep_node")) & F.col("doc_id").eqNullSafe(F.col("rep_id")))
            .select(F.col("node").alias(name), F.col("doc_id").alias(f"{name}_id")).distinct())
    held = docs.withColumn(name, node_of(F.col("text")))
    kept = held.join(reps.withColumnRenamed(name, f"{name}_rep"),
                     (F.col(name) == F.col(f"{name}_rep")) & F.col("doc_id").eqNullSafe(F.col(f"{name}_id")), "left_semi")
    return kept.dropDuplicates([name]).select(*docs.columns)
