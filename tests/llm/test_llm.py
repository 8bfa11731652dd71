"""The llm operators against brute force and round trips, and on odd rows: nulls, empty and long texts, ties, repeated
rows, empty tables, and extra columns with clashing names."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from voltmart.llm import (
    attention_scores, common, conversation_trie, language_fusion, license_diagonals, piece_spans, quality_ledger, queries,
    rank_merge, soft_mix, spelling_variants, threshold_topk, token_dac, weighted_minhash, wrapper_induction,
)
from voltmart.session import scratch_path

SF = "/root/testdata/sf0.001"
ODD = ["", "  a  b\n\n c", "<|endoftext|>x <|endoftext|> y", "aaaaaaaaaa aaaa", "ééé 日本語 ▁ x\x00y \n \t z", "don't we'll 　 a\x1c b\xa0 c ",
       "\n\nA", "a \n", "1234 567!!! ...", "a b ", "x\ny\n\nz", "<s> </s> x", " ", "a\nb c\n", "w" * 5000, "long text here " * 4000]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, node string, identified string, ledger string, times int"


@pytest.fixture(scope="module")
def odd(spark):
    common.prepare(spark)
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, len(t), "n", "i", "l", 1) for i, t in enumerate(ODD)]
    rows += [(None, "a null id", None, None, 9, None, None, None, None), (50, None, "", "", None, "n", "i", "l", 2)]
    rows += [(51, "repeated row of a text with words", "en", "s", 1, "n", "i", "l", 3)] * 3
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    common.prepare(spark)
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def by_row(pairs):
    return sorted(pairs, key=str)


# --- op1 -------------------------------------------------------------------------------------------------------------

def plain_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = collections.Counter(windows)
    repeated = {j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


def test_quality_against_plain_counts(docs, odd):
    for df in (docs, odd):
        out = quality_ledger.apply_policy(quality_ledger.ledger(df)).collect()
        want = by_row((i, *plain_quality(t)) for i, t in texts_of(df))
        assert by_row((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out) == want
        for r in out:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.base_failed and r.kept)


def test_ablations_follow_the_ledger(docs):
    rows = quality_ledger.ledger(docs)
    bits = [r.fail_bits for r in rows.collect()]
    for r in quality_ledger.ablations(rows).collect():
        bit = quality_ledger.mask_of([r.rule])
        mask = quality_ledger.DEFAULT_POLICY.mask
        assert r.n_failed == sum(bool(b & bit) for b in bits)
        assert r.n_only_this == sum(b & mask == bit for b in bits)
        assert r.n_kept_without == sum(not b & mask & ~bit for b in bits)


# --- op2, op6, op7 ---------------------------------------------------------------------------------------------------

def test_token_files_round_trip(spark, docs, odd):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for df in (docs, odd):
        path = scratch_path(spark, "dac-test")
        token_dac.write_dac(df, path, shard_tokens=3000)
        out = sorted(token_dac.read_documents(spark, path).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in out] == sorted([i for i, _ in texts_of(df)], key=lambda i: (i is not None, i or 0))
        at = 0
        for r in out:
            assert r.start == at
            at += r.n_tokens
        ids = {t: np.array(whole.encode(t, add_special_tokens=False).ids + [2], "<u4") for _, t in texts_of(df)}
        assert by_row((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == by_row(
            (i, len(ids[t]), zlib.crc32(ids[t].tobytes())) for i, t in texts_of(df))
        first = next(t for i, t in texts_of(df) if i == out[-1].doc_id)
        asked = spark.createDataFrame([(out[-1].start,), (0,), (at,), (0,), (-1,), (None,), *[(i,) for i in range(at - 50, at)]], "position long")
        found = token_dac.read_tokens(spark, path, asked)
        assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
        held = dict(texts_of(df))
        every = np.concatenate([ids[held[r.doc_id]] for r in out]) if len(held) == len(out) else None  # where ids are unique
        rows = [(r.position, r.token) for r in found.collect()]
        assert sorted(p for p, _ in rows) == sorted([out[-1].start, 0, 0, *range(at - 50, at)])
        assert dict(rows)[out[-1].start] == ids[first][0] and (every is None or all(t == every[p] for p, t in rows))


def test_dac_random_access():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 1 << 32, 3000, dtype=np.uint64).astype(np.uint32)
    ids[::3] %= 70000
    ids[::2] %= 300
    shard = token_dac.Shard(token_dac.encode_shard(ids, np.array([3000])))
    assert (shard.tokens() == ids).all() and [shard.token(i) for i in range(3000)] == ids.tolist()
    with pytest.raises(IndexError):
        shard.token(3000)


def test_pieces_against_the_library(docs, odd):
    processor = piece_spans.piece_encoder(P.path("piece_bpe_32k.model")).processor
    for df in (docs, odd):
        want = []
        for i, t in texts_of(df):
            ids = processor.encode(t)
            want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256((processor.decode(ids) if ids else "").encode()).hexdigest()))
        out = piece_spans.with_digests(df).collect()
        assert by_row((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out) == by_row(want)


def test_piece_spans_tile_the_text(odd):
    encoder = piece_spans.piece_encoder(P.path("piece_bpe_32k.model"))
    for text in ODD:
        ids = encoder.encode([text])[0]
        spans = encoder.spans(text, ids)
        data = text.encode()
        assert b"".join(data[a:b] for a, b in spans) == data


def test_compiled_map_against_the_library():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as model_pb2
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    proto = model_pb2.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    own = piece_spans.Normaliser(proto.normalizer_spec)
    for text in ["ＡＢＣ①㍿ ﬁ  x é", "  a  b  ", "ｱﾞﾊﾟ ½", "", "plain", "é 日本"]:
        out, begin, end = own(text.encode())
        assert out.decode() == library.normalize(text)
        assert len(out) == len(begin) == len(end) and (begin <= end).all()


def test_rank_merge_against_the_library(docs, odd):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for df in (docs, odd):
        want = [(i, len(t.encode()), len(whole.encode(t, add_special_tokens=False).ids)) for i, t in texts_of(df)]
        out = rank_merge.token_counts(df).collect()
        assert by_row((r.doc_id, r.n_bytes, r.n_tokens) for r in out) == by_row(want)


def test_rank_merge_on_random_bytes():
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rng = random.Random(5)
    texts = ["".join(rng.choice("aab \n'\tsTé日0!.") for _ in range(rng.randrange(60))) for _ in range(400)]
    assert rank_merge.merger(P.path("byte_bpe_50k.json")).count(texts) == [len(whole.encode(t, add_special_tokens=False).ids) for t in texts]


# --- op3 -------------------------------------------------------------------------------------------------------------

def test_mixing_meets_its_targets(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = soft_mix.fit(docs, labels)
    known = soft_mix.posteriors(docs, model).cache()
    steps, result = soft_mix.solve(known, {"clean": 0.9, "junk": 0.05, "toxic": 0.05})
    assert np.abs(result["reached"] - result["targets"]).max() <= 0.01 * result["targets"].sum()
    rates = [r.rate for r in known.select(soft_mix.rate_of(steps).alias("rate")).collect()]
    assert min(rates) >= 0 and len(rates) == docs.select("doc_id").distinct().count()


@pytest.mark.parametrize("share", [(0.70, 0.2999, 0.0001), (0.9899, 0.01, 0.0001)])
def test_mixing_meets_the_targets_of_rare_domains(spark, share):
    rows = [(round(x * 1e6), 1, [float(i == j) for j in range(3)]) for i, x in enumerate(share)]
    steps, result = soft_mix.solve(spark.createDataFrame(rows, "tokens long, copies long, p array<double>"))
    assert (np.abs(result["reached"] - result["targets"]) <= 0.01 * result["targets"]).all() and len(steps) < 100


def test_mixing_tells_when_no_rates_meet_the_targets(spark):
    rows = [(1000, 1, [0.4, 0.3, 0.3]), (500, 1, [0.5, 0.3, 0.2])]
    with pytest.warns(UserWarning, match="no rates meet"):
        soft_mix.solve(spark.createDataFrame(rows, "tokens long, copies long, p array<double>"))


def test_mixing_classifier_on_held_out_labels(spark):
    big = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    fit, held = labels.where("pmod(xxhash64(doc_id), 4) > 0"), labels.where("pmod(xxhash64(doc_id), 4) = 0")
    p = soft_mix.posteriors(docs, soft_mix.fit(docs, fit)).join(held, "doc_id").select(
        "p", soft_mix.domain_of(F.col("quality"), F.col("toxic")).alias("domain")).collect()
    right = sum(soft_mix.DOMAINS[int(np.argmax(r.p))] == r.domain for r in p)
    assert right >= 0.8 * len(p)


def test_mixing_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (51, 1, 1), (None, 1, 0), (3, None, None), (1, 1, 0)], "doc_id long, quality int, toxic int")
    mixed = soft_mix.mix(odd, labels)
    assert mixed.agg(F.sum("copies")).first()[0] == odd.count()
    none = labels.limit(0)
    assert {r.rate for r in soft_mix.mix(odd, none).collect()} == {1.0}
    assert soft_mix.mix(empty, labels).count() == 0


# --- op4 -------------------------------------------------------------------------------------------------------------

def brute_classes(rows, idf):
    texts = sorted({t for _, t in rows})
    vectors = {t: weighted_minhash.weights(t, idf) for t in texts}
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for a, b in itertools.combinations(texts, 2):
        if weighted_minhash.weighted_jaccard(vectors[a], vectors[b]) >= weighted_minhash.THRESHOLD:
            root[find(a)] = find(b)
    members = collections.defaultdict(list)
    for i, t in rows:
        members[find(t)].append(i)
    return {(i, t): min((x for x in members[find(t)] if x is not None), default=None) for i, t in rows}


def near_corpus(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows, base = [], [word() for _ in range(120)]
    for i in range(40):  # copies of one text, each with edits of its own: many pairs near the threshold
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(120)] = word()
        rows.append((i, " ".join(text)))
    rows += [(100 + i, rows[0][1]) for i in range(5)] + [(200 + i, " ".join(word() for _ in range(60))) for i in range(10)]
    rows += [(300, None), (301, ""), (302, "two words"), (303, "two words"), (303, "two words"), (None, "only null id"), (304, "  ")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_near_duplicates_against_all_pairs(spark, docs):
    for df in (docs, near_corpus(spark)):
        idf = weighted_minhash.idf_table(df)
        want = brute_classes(texts_of(df), idf)
        out = weighted_minhash.near_duplicates(df).select("doc_id", "class_id").collect()
        assert by_row((r.doc_id, r.class_id) for r in out) == by_row((i, want[i, t]) for i, t in texts_of(df))


def test_copies_in_a_large_group_are_linked(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows, base = [], [word() for _ in range(240)]
    for i in range(60):  # a third of the rows
        text = list(base)
        for j in rng.sample(range(240), 2):
            text[j] = word()
        rows.append((i, " ".join(text)))
    rows += [(100 + i, " ".join(word() for _ in range(240))) for i in range(120)]
    out = {r.doc_id: r.class_id for r in weighted_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [set(weighted_minhash.shingle_counts(t)[0].tolist()) for _, t in rows[:60]]
    near = [(a, b) for a, b in itertools.combinations(range(60), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert len(near) > 1000 and all(out[a] == out[b] for a, b in near)
    assert all(out[100 + i] == 100 + i for i in range(120))


def test_samples_estimate_the_weighted_similarity():
    rng = np.random.default_rng(1)
    off = []
    for _ in range(40):
        x = common.mix(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
        y = np.concatenate([x[:240], common.mix(rng.integers(0, 1 << 63, 60, dtype=np.uint64))])
        v = (rng.random(300) * 3 + 0.1).astype(np.float32)
        w = np.concatenate([v[:240], (rng.random(60) * 3 + 0.1).astype(np.float32)])
        o, q = np.argsort(x), np.argsort(y)
        off.append((weighted_minhash.samples(x, v) == weighted_minhash.samples(y, w)).mean()
                   - weighted_minhash.weighted_jaccard((x[o], v[o]), (y[q], w[q])))
    assert abs(np.mean(off)) < 0.03


# --- op5 -------------------------------------------------------------------------------------------------------------

def test_topk_odd_vectors(spark):
    rows = [(0, [1.0, -0.5]), (0, [1.0, -0.5]), (100, [0.0, 0.0]), (1, [2.0, 1.0]), (2, [2.0, 1.0]), (2, [2.0, 1.0]), (3, None), (4, [None, 1.0]),
            (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (None, [1.0, 1.0]), (7, [1.0]), (8, [-3.0, 0.25]), (9, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).withColumn("rank", F.lit("x"))
    v = threshold_topk.quantised(df)
    out = threshold_topk.exact_topk(v.where("vec_id % 100 = 0"), v, k=3, candidate_block=2).orderBy("query_id", "rank").collect()
    held = [(r.vec_id, r.v) for r in v.collect()]
    want = []
    for q, x in sorted({(i, tuple(v)) for i, v in held if i % 100 == 0}):
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in held if i != q and len(y) == len(x))[:3]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert [tuple(r) for r in out] == want


# --- op8 -------------------------------------------------------------------------------------------------------------

def test_language_on_held_out_rows(spark, docs):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_fusion.fit(docs, rows=150)
    held = big.withColumn("truth", F.col("lang")).withColumn("lang", F.lit(None).cast("string"))
    out = language_fusion.identify_documents(held, model=model)
    assert out.where("identified.text_language = truth").count() >= 0.97 * big.count()
    assert out.where("identified.kept").count() == big.count()


def test_language_odd_rows(spark, docs, odd, empty):
    model = language_fusion.fit(docs)
    out = language_fusion.identify_documents(odd, "found", model).collect()
    assert len(out) == odd.count()
    for r in out:
        if not re.search(r"[^\W\d_]", r.text or ""):
            assert r.found.language is None and r.found.confidence == 0 and not r.found.kept
        else:
            assert 0 < r.found.confidence <= 1
    assert language_fusion.identify_documents(empty, "found").count() == 0


def test_pages_have_all_evidence(spark, docs):
    model = language_fusion.fit(docs)
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = language_fusion.identify_pages(pages, model).collect()
    assert len(out) == pages.count() and all(r.identified.kept for r in out)
    hosts = spark.createDataFrame([("http://Www.X.example.DE:80/a?b",), ("x",), (None,)], "u string")
    got = hosts.select(language_fusion.host_of(F.col("u")).alias("h"), language_fusion.suffix_language(F.col("u")).alias("l")).collect()
    assert [tuple(r) for r in got] == [("www.x.example.de", "de"), (None, None), (None, None)]


def plain_trigrams(text):
    """Buckets by one loop over the bytes: digits break a trigram, marks are spaces, two spaces in a row are no trigram."""
    data = [c if c > 127 or chr(c).isalpha() else -1 if chr(c).isdigit() else 32 for c in f" {text.lower()} ".encode()]
    windows = [data[i:i + 3] for i in range(len(data) - 2)]
    return [((a << 16 | b << 8 | c) * 2654435761 % 2 ** 32) >> 18 for a, b, c in windows if -1 not in (a, b, c) and not (b == 32 and 32 in (a, c))]


def plain_softmax(scores):
    raised = [math.exp(x - max(scores)) for x in scores]
    return [x / sum(raised) for x in raised]


def plain_languages(rows, counts):
    """Fusion written out row by row; rows of (text, declared, suffix language, host), counts of buckets per language."""
    names, size = sorted(counts), language_fusion.BUCKETS
    classes = [*names, "und"]
    n = len(classes)

    def text_scores(text):
        found = plain_trigrams(text)
        sums = [sum(math.log(0.95 * counts[x].get(b, 0) / sum(counts[x].values()) + 0.05 / size) for b in found) for x in names]
        return [x * min(len(found), 120) / max(len(found), 1) for x in [*sums, -len(found) * math.log(size)]]

    def told(name, trust):
        code = re.split("[-_]", (name or "").lower())[0]
        at = code if code in names else "und"
        return [0.0] * n if code in ("", "und") else [math.log(trust if x == at else (1 - trust) / (n - 1)) for x in classes]

    lettered = [bool(re.search(r"[^\W\d_]", t or "")) for t, *_ in rows]
    scores = [text_scores(t) if ok else None for (t, *_), ok in zip(rows, lettered, strict=True)]
    own = [plain_softmax(s) if s else [0.0] * n for s in scores]
    parent = lambda host: ".".join(host.split(".")[-2:]) if "." in host else None
    out = []
    for i, (_, declared, suffix, host) in enumerate(rows):
        if not lettered[i]:
            out.append((None, 0.0, False))
            continue
        prior = [1 / n] * n
        for strength, same in ((n, lambda j: True), (100.0, lambda j: parent(host or "") and parent(rows[j][3] or "") == parent(host)),
                               (20.0, lambda j: (rows[j][3] or "") == (host or ""))):
            if strength == 100.0 and not parent(host or ""):
                continue
            others = [own[j] for j in range(len(rows)) if j != i and lettered[j] and same(j)]
            prior = [(sum(o[k] for o in others) + strength * prior[k]) / (len(others) + strength) for k in range(n)]
        fused = plain_softmax([a + b + c + math.log(d) for a, b, c, d in zip(scores[i], told(declared, 0.9), told(suffix, 0.7), prior, strict=True)])
        at = fused.index(max(fused))
        out.append((classes[at], max(fused), classes[at] != "und" and max(fused) >= 0.5))
    return out


def test_languages_against_a_plain_version(spark, docs):
    labelled = docs.where("lang is not null and text is not null").limit(60).select("doc_id", "text", "lang").cache()
    model = language_fusion.fit(labelled)
    counts = collections.defaultdict(collections.Counter)
    for r in labelled.collect():
        counts[r.lang].update(plain_trigrams(r.text))
    words = [t for r in docs.limit(40).collect() for t in [r.text.split()[:3 + r.doc_id % 5]] if t]
    hosts = ["a.example.de", "b.example.de", "example.de", "x.site.fr", "y.site.fr", "plain", None, "c.example.pl", "z.co.uk"]
    tags = ["en", "de-AT", "FR_fr", "xx", "", None, "und", "es"]
    texts = [" ".join(w) for w in words] + ["", None, "1 2 3", "1a2", "日本語", "a", "ok", "Wszyscy ludzie rodzą się wolni"] * 2
    rows = [(i, t, tags[i % len(tags)], f"https://{h}/p{i}" if "." in (h or "") else None, h) for i, t in enumerate(texts) for h in [hosts[i * 5 % len(hosts)]]]
    df = spark.createDataFrame(rows, "n int, t string, d string, u string, h string").repartition(4)
    out = language_fusion.identify(df, model, F.col("t"), F.col("d"), F.col("u"), F.col("h"), keep=["n"]).orderBy("n").collect()
    suffix = lambda u: language_fusion.SUFFIX_LANGUAGE.get(u.split("/")[2].rsplit(".", 1)[-1]) if u else None
    want = plain_languages([(t, d, suffix(u), h) for _, t, d, u, h in rows], counts)
    assert [(r.identified.language, r.identified.kept) for r in out] == [(a, c) for a, _, c in want]
    assert max(abs(r.identified.confidence - b) for r, (_, b, _) in zip(out, want, strict=True)) < 1e-3  # float32 logs, long products


def test_suffix_and_parent_host_decide_where_the_text_does_not(spark, docs):
    model = language_fusion.fit(docs)
    german = [r.text for r in docs.where("lang = 'de'").limit(30).collect()]
    french = [r.text for r in docs.where("lang = 'fr'").limit(30).collect()]
    rows = [(i, t, f"http://a{i}.zeitung.com/") for i, t in enumerate(german)] + [(100 + i, t, f"http://b{i}.journal.com/") for i, t in enumerate(french)]
    spanish = [r.text for r in docs.where("lang = 'es'").limit(10).collect()]
    rows += [(300 + i, t, f"http://sitio{i}.com/") for i, t in enumerate(spanish)]
    # "1a2" has no trigram: it says nothing about its language
    rows += [(200, "1a2", "http://new.zeitung.com/"), (201, "1a2", "http://new.journal.com/"), (202, "1a2", "http://far.off.es/x"), (203, "1a2", "http://far.off.com/x")]
    df = spark.createDataFrame(rows, "n int, t string, u string")
    none = F.lit(None).cast("string")
    out = {r.n: r.f for r in language_fusion.identify(df, model, F.col("t"), none, F.col("u"), language_fusion.host_of(F.col("u")), "f").collect()}
    assert [out[i].language for i in (200, 201)] == ["de", "fr"]  # the parent's other hosts
    assert out[202].language == "es" and out[203].language != "es"  # the suffix
    assert all(out[i].language == "de" for i in range(30))


@pytest.mark.parametrize("text", [
    "Tämä on suomenkielinen lause, jossa kerrotaan säästä ja kalastuksesta järvellä.", "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności.",
    "Všichni lidé rodí se svobodní a sobě rovní co do důstojnosti a práv.", "Все люди рождаются свободными", "今日は天気がいい。",
])
def test_languages_outside_the_sample_are_rejected(spark, docs, text):
    model = language_fusion.fit(docs)
    df = spark.createDataFrame([(1, text, None, None), (2, text * 50, "en", "s")], "doc_id long, text string, lang string, source string")
    out = language_fusion.identify_documents(df.unionByName(docs.select(*df.columns).limit(50)), model=model).where("doc_id in (1, 2) and text like '%s%%'" % text[:12]).collect()
    assert {(r.identified.language, r.identified.kept) for r in out} == {("und", False)}


def test_trigrams_do_not_depend_on_blocks():
    text = "Grüße 12 an alle, die das hier lesen: 7x7 — ok? " * 50
    whole = plain_trigrams(text)
    for size in (3, 7, 64, 1 << 20):
        assert np.concatenate(list(language_fusion.blocks(text, size))).tolist() == whole
    assert list(language_fusion.blocks("")) == [] or not len(np.concatenate(list(language_fusion.blocks(""))))


def test_each_text_is_scored_once(spark, docs, tmp_path):
    model = language_fusion.fit(docs)
    calls = spark.sparkContext.accumulator(0)

    class Counted(language_fusion.TrigramModel):
        def __init__(self):
            self.languages, self.log = model.languages, model.log

        def score(self, text):
            calls.add(1)
            return super().score(text)

    out = language_fusion.identify_documents(docs, model=Counted())
    assert out.count() == out.where("identified.kept or true").count() == docs.count()
    assert calls.value == docs.count()


# --- op9 -------------------------------------------------------------------------------------------------------------

def plain_licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    at, labels = [], set()
    for phrase, label in license_diagonals.PHRASES:
        p = phrase.split()
        hits = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_licenses_against_plain_search(spark, docs, odd):
    more = spark.createDataFrame([(1, "The MIT License. mit license CC-BY cc by gnu General public LICENSE"), (2, "mitK license"), (2, "mit license"),
                                  (2, "mit license"), (3, "mit the license gnu public license"), (4, None)], "doc_id long, text string")
    for df in (docs, odd, more):
        out = license_diagonals.scan(df).collect()
        want = by_row((i, *plain_licenses(t)) for i, t in texts_of(df))
        assert by_row((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out) == want


def test_broken_passages_are_found_on_neighbouring_diagonals(spark):
    words = license_diagonals.PASSAGES[1][0].split()
    bent = " ".join(words[:6] + ["inserted"] + words[6:14] + words[15:])
    text = " ".join(f"w{i}" for i in range(20)) + " " + bent
    out = {r.doc_id: r for r in license_diagonals.scan(spark.createDataFrame([(1, text), (2, " ".join(words[:5]))], "doc_id long, text string")).collect()}
    assert out[1].labels == "bsd-text" and 0.6 <= out[1].score < 1 and out[2].labels == ""


# --- op10 ------------------------------------------------------------------------------------------------------------

def test_pages_against_their_article_element(spark):
    import html as html_lib
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    out = {r.page_id: r.text for r in wrapper_induction.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html_lib.unescape(re.sub(r"</?b>|<br>", " ", b) if "<br>" not in b else re.sub(r"</?b>", "", b).replace("<br>", " "))).strip()
                  for b in re.split(r"</?(?:p|h1)>", article)]
        assert out[r.page_id] == "\n".join(b for b in blocks if b)


def test_template_is_learned_without_an_article_element(spark):
    page = lambda i: (i, f"http://h.example/{i}", f"<body><div class=top><p>Site name</p></div><div><p>Story {i} begins &amp; ends</p><p>More {i * 7}</p></div>"
                                                   f"<div><p>All rights reserved</p></div></body>")  # noqa: E731
    rows = [page(i) for i in range(8)] + [(90, "http://h.example/3", page(3)[2]), (91, None, None), (None, "x", "<p>alone"), (92, "x", "")]
    out = wrapper_induction.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("text", F.lit("t")))
    got = {r.page_id: r.text for r in out.collect()}
    assert all(got[i] == f"Story {i} begins & ends\nMore {i * 7}" for i in range(8)) and got[90] == got[3]
    assert got[91] == "" and got[None] == "alone" and got[92] == ""
    assert wrapper_induction.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_boilerplate_and_broken_markup():
    page = """<html><body><header>Site</header><div class="cookie-notice">We use</div><main><article class="post"><header><h1>T &amp; x</h1>
    </header><p>One<br>two <b>three</b> a < b &lt;tag&gt;<ul><li>x<li>y</ul><table><tr><td>c1<td>c2<tr><td>d</table><aside>no</aside>
    <div class="ad">buy</div><form>f</form><script>var a="</p>";</script></p><!-- c --><div id="comments"><article class="comment">hi</article>
    </div></article></main><footer>f</footer>"""
    assert wrapper_induction.main_text(page) == "T & x\nOne two three a < b <tag>\nx\ny\nc1\nc2\nd"


def test_template_is_learned_inside_articles(spark):
    page = lambda i, ad="": (f"<body>{ad}<article><h1>Story {i}</h1><p>It begins <b>here</b> with {i * 7}</p><p>Share <a>this</a> story</p>"  # noqa: E731
                             f"<p>More {i * 11}</p><div>Subscribe to our letter</div></article>")
    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(8)]
    rows += [(100 + i, f"http://h.example/{i}", page(3, f"<p>top {i}</p>")) for i in range(20)]  # copies of one article
    rows += [(200 + i, f"http://h.example/x{i}", f"<p>Plain {i}</p><p>Foot</p>") for i in range(30)]  # pages without one
    out = wrapper_induction.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {r.page_id: r.text for r in out.collect()}
    assert all(got[i] == f"Story {i}\nIt begins here with {i * 7}\nMore {i * 11}" for i in range(8))
    assert all(got[100 + i] == got[3] for i in range(20)) and all(got[200 + i] == f"Plain {i}" for i in range(30))


@pytest.mark.parametrize("names", ['class="content has-sidebar"', 'class="no-sidebar"', 'class="entry share-enabled"', 'class="page with-comments"',
                                   'id="ad-free"', 'class="sidebar-layout"'])
def test_names_do_not_hide_the_page(names):
    page = f"<body><div {names}><article><p>Story</p></article><div class='share-box'>no</div></div></body>"
    assert wrapper_induction.main_text(page) == "Story"
    if "layout" not in names:
        assert wrapper_induction.main_text(f"<body><div {names}><p>Story</p><div class='comment body'>no</div></div></body>") == "Story"
    beside = "<body><article><p>Story</p></article><div class='related-posts'><article><p>Other</p></article></div></body>"
    assert wrapper_induction.main_text(beside) == "Story"


def test_deep_pages_are_matched():
    pages = [wrapper_induction.skeleton(wrapper_induction.parse("<div>" * 5000 + f"<p>Story {i}</p><p>Foot</p>")) for i in range(2)]
    assert sorted(wrapper_induction.votes(pages).values()) == [2]


def test_long_child_lists_are_aligned_exactly():
    flat = lambda i: "".join(f"<p class=c{k % 50}>Line {k}</p>" + (f"<div>New {i}</div>" if k == 20 * i else "") for k in range(400))
    pages = [wrapper_induction.skeleton(wrapper_induction.parse(flat(i))) for i in range(6)]
    assert sorted(wrapper_induction.votes(pages).values()) == [6] * 400
    shapes = wrapper_induction.Shapes()
    one, two = wrapper_induction.tree(pages[0]), wrapper_induction.tree(pages[5])
    shapes.put(one), shapes.put(two)
    assert shapes.match(one.shape, two.shape) == len(wrapper_induction.skeleton(wrapper_induction.parse(flat(9)))) // 16 - 1


def _extracted(spark, pages):
    rows = [(i, f"http://h.example/{i}", f"<body><nav>Home</nav><article>{p}</article></body>") for i, p in enumerate(pages)]
    return {r.page_id: r.text for r in wrapper_induction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


@pytest.mark.parametrize("copies, others", [(3, 3), (8, 3), (20, 4), (6, 0), (2, 9)])
def test_edited_copies_of_an_article_keep_their_text(spark, copies, others):
    tail = "<p>Share this story</p><div>Subscribe</div>"
    paragraphs = [f"Paragraph {k} of the long article that all the copies have." for k in range(6)]
    body = "<h1>The great flood</h1>" + "".join(f"<p>{x}</p>" for x in paragraphs)
    got = _extracted(spark, [f"{body}<p>Update {i} of the day</p>{tail}" for i in range(copies)]
                     + [f"<h1>Other {i}</h1><p>Something quite unlike number {i * 7} altogether</p>{tail}" for i in range(others)])
    ending = "" if others >= 3 else "\nShare this story\nSubscribe"  # with copies alone, nothing tells template from text
    assert all(got[i] == "\n".join(["The great flood", *paragraphs, f"Update {i} of the day"]) + ending for i in range(copies))
    assert all(got[copies + i] == f"Other {i}\nSomething quite unlike number {i * 7} altogether" + ending for i in range(others))


def test_constant_headings_and_labels_stay_with_the_text_they_lead(spark):
    page = lambda i: (f"<h1>Soup {i}</h1><dl><dt>Serves</dt><dd>{i + 2} of us</dd></dl><h2>Ingredients</h2><h3>Fresh</h3><ul><li>{i} leeks</li></ul>"  # noqa: E731
                      f"<h2>Method</h2><p>Boil them for {i * 3} minutes, then rest.</p><p><b>Note</b></p><p>Keeps {i} days.</p>"
                      f"<h2>Share</h2><p>Tell your friends</p><p><b>Bye</b></p>")
    got = _extracted(spark, [page(i) for i in range(8)])
    for i in range(8):
        assert got[i] == f"Soup {i}\nServes\n{i + 2} of us\nIngredients\nFresh\n{i} leeks\nMethod\nBoil them for {i * 3} minutes, then rest.\nNote\nKeeps {i} days."


def test_template_of_articles_against_a_plain_version(spark):
    """Random articles of paragraphs, shared lines and edited copies: the plain version counts (text) by hand."""
    rng = np.random.default_rng(5)
    for trial in range(3):
        lines = [f"Line {k} of the site" for k in range(3)]
        base = [f"Sentence {k} of the first report in full length" for k in range(8)]
        pages = []
        for i in range(14):
            if i < 5 + trial:
                own = [x if rng.random() < 0.8 else f"{x} as edited {i}" for x in base] + [f"Report {i}"]
            else:
                own = [f"Own sentence {i} {k} of a different page" for k in range(rng.integers(3, 9))]
            pages.append(own + [x for x in lines if rng.random() < 0.8])
        distinct = {tuple(p) for p in pages}
        count = lambda of: {x: sum(x in p for p in of) for p in of for x in p}
        shared = {x for x, n in count(distinct).items() if n >= 3 and n >= 0.5 * len(distinct)}
        voters = [p for p in distinct if sum(len(x) for x in p if x not in shared) >= sum(map(len, p)) / 3]
        template = {x for x, n in count(voters).items() if x in shared and n >= 3 and n >= 0.5 * len(voters)}
        got = _extracted(spark, ["".join(f"<p>{x}</p>" for x in p) for p in pages])
        assert template and all(got[i] == "\n".join(x for x in p if x not in template) for i, p in enumerate(pages))


# --- pipeline --------------------------------------------------------------------------------------------------------

def test_pipeline_stages(spark, docs, odd, empty):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "mixing", "pieces"]
    for df in (docs, odd, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == df.columns, name
            out.count()
    kept = quality_ledger.stage(spark, docs, SF).select("doc_id").collect()
    want = quality_ledger.apply_policy(quality_ledger.ledger(docs)).where("kept").select("doc_id").collect()
    assert by_row(kept) == by_row(want)
    unique = weighted_minhash.stage(spark, odd, SF)
    # texts of the same words have the same shingles, whatever stands between them
    assert unique.count() == len({tuple(common.word_hashes(t.encode()).tolist()) or t for _, t in texts_of(odd)})
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_registered_queries(spark):
    assert sorted({int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES}) == list(range(1, 14))
    for name in ("op1_quality_ledger", "op5_threshold_topk", "op9_license_diagonals"):
        assert isinstance(queries.QUERIES[name](spark, SF).toPandas(), pd.DataFrame)


# --- op11 ------------------------------------------------------------------------------------------------------------

def plain_trie(sequences):
    """Rows of the trie of {conv_id: turns} by its definition."""
    members = collections.defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    own = {p: (len(cs) - 1) * len(p[-1][1]) if p else 0 for p, cs in members.items()}
    leaves, saved = collections.Counter(), collections.Counter()
    for p in members:
        for d in range(len(p) + 1):
            saved[p[:d]] += own[p]
            leaves[p[:d]] += not children[p]
    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if tuple(sequences[c]) == p))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def plain_rebuilt(turns):
    own = collections.defaultdict(list)
    for c, t, role, text in turns:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + mine[h:]
    return out


def trie_rows(df):
    return by_row(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


TURNS = "conv_id long, turn int, role string, text string, lo int, a long, turns string"


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(conversation_trie, "BLOCK", 8)


def test_trie_against_plain_definition(spark, small_blocks):
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 40), *range(100, 160), 200, 7_000_000_000]:
        n = rng.choice([0, 1, 3, 5, 6, 7, 9, 17, 40] if c % 10 else [9])
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "", None, "é日"]), 1, 2, "x") for t in range(n)]
    rows += [(5, None, "user", "null turn first", 0, 0, ""), (5, None, "user", "a tie", 0, 0, ""), (6, 1, "user", "tie", 0, 0, ""), (6, 1, "user", "tie", 0, 0, "")]
    rows += [(None, 0, "user", "no conversation", 0, 0, "")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    got = conversation_trie.prefix_trie(conversation_trie.rebuilt(conversation_trie.sequences(df)))
    assert trie_rows(got) == by_row(plain_trie(plain_rebuilt([r[:4] for r in rows])))


def test_trie_of_copies_and_of_nothing(spark, small_blocks):
    """A third of all conversations are one and the same; their numbers are digested over many tasks and blocks."""
    rows = [(c, t, "user", f"t{t}" if c % 3 else f"t{t} of {c}", 0, 0, "") for c in range(1000, 1300) for t in range(3)]
    df = spark.createDataFrame(rows, TURNS).repartition(7)
    own = conversation_trie.sequences(df)
    got = trie_rows(conversation_trie.prefix_trie(own))
    assert got == by_row(plain_trie({c: [("user", f"t{t}" if c % 3 else f"t{t} of {c}") for t in range(3)] for c in range(1000, 1300)}))
    nothing = conversation_trie.sequences(df.limit(0))
    assert conversation_trie.prefix_trie(conversation_trie.rebuilt(nothing)).count() == 0


def test_end_names_follow_the_cuts(spark):
    rows = [(c, t, "u", f"{c}-{t}", 0, 0, "") for c in range(1, 12) for t in range(c)]
    whole = conversation_trie.sequences(spark.createDataFrame(rows, TURNS))
    tables = conversation_trie.trie(whole, scratch_path(spark, "trie-test"), 16)
    names = {(r.a, r.b) for r in whole.select(conversation_trie.end_name(F.col("turns"), 16).alias("x")).select("x.*").collect()}
    made = {(r.la, r.lb) for r in tables[1].where(F.size("turns") > 0).collect()}
    assert len(names) == 11 and names <= made


# --- op12 ------------------------------------------------------------------------------------------------------------

def near_pairs(words):
    """Pairs one edit apart, from shared rests."""
    out = set()
    rests = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            rests[i, w[:i] + w[i + 1:]].add(w)
            if w[:i] + w[i + 1:] in words:
                out |= {(w, w[:i] + w[i + 1:]), (w[:i] + w[i + 1:], w)}
    for group in rests.values():
        out |= {(a, b) for a in group for b in group if a != b}
    return out


def plain_variants(texts):
    counts = collections.Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 5 and k >= 3}
    near = collections.defaultdict(list)
    for a, b in near_pairs(set(n)):
        near[a].append(b)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return [(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n]


def variant_rows(df):
    return by_row(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_variants_against_plain_definition(docs, odd):
    some = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    assert variant_rows(spelling_variants.variants(some)) == by_row(plain_variants(texts_of(some)))


@pytest.mark.parametrize("cell, room", [(64, 400), (16, 1 << 22)])
def test_variants_in_small_cells_and_blocks(spark, monkeypatch, cell, room):
    """Cells, blocks and many anagrams at one point lose no link."""
    monkeypatch.setattr(spelling_variants, "MANY", 4)
    rng = random.Random(5)
    words = {"".join(rng.choices("abcé", k=rng.choice([5, 6, 7]))) for _ in range(900)} | {"".join(x) for x in itertools.permutations("abcde")}
    rows = [(i, " ".join(rng.choices(sorted(words), k=400))) for i in range(60)] + [(None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit("x")).repartition(4)
    assert variant_rows(spelling_variants.variants(df, cell=cell, room=room)) == by_row(plain_variants([(i, t or "") for i, t in rows]))


def test_words_are_dealt_in_large_frames():
    """Words from many small batches go through the trees together: few frames, and the rows that each word has by itself."""
    S = spelling_variants
    rng = random.Random(8)
    words = sorted({"".join(rng.choices("abcdefgé", k=rng.choice([5, 6, 7]))) for _ in range(3000)})
    rng.shuffle(words)
    pdf = pd.DataFrame({"word": words, "n": np.arange(len(words)) + 3, "length": [len(w) for w in words]})
    trees = {k: S.Tree(S.points_of(*S.codes_of([w for w in words if len(w) == k])), 100) for k in (6, 7)}

    class Table:  # hands out the function that its tasks would run
        select = lambda self, *columns: self
        mapInPandas = lambda self, run, schema: run

    frames = list(S.dealt(Table(), trees)(pdf[at:at + 50] for at in range(0, len(pdf), 50)))
    want = []
    for word, n, length in pdf.itertuples(index=False):
        point = S.points_of(*S.codes_of([word]))
        for side, target, more, less in ((0, length, 0, 0), (1, length, 1, 1), (2, length + 1, 1, 0)):
            want += [(target, leaf, side, word, n) for leaf in ([c for c, _ in trees[target].reach(point, more, less)] if target in trees else [0])]
    assert by_row(r for f in frames for r in f.itertuples(index=False, name=None)) == by_row(want)
    assert len(frames) < 20 < len(pdf) // 50
    assert [len(f) for f in S._gathered((pdf[at:at + 50] for at in range(0, 220, 50)), 100)] == [100, 100, 50]


def test_variants_of_nothing(empty):
    assert spelling_variants.variants(empty).count() == 0


def test_long_texts_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(spelling_variants, "PIECE", 7)
    data = "Éa bcdé-fghij×kl, mnö pq".encode()
    assert b"".join(spelling_variants._pieces(data)) == data
    assert [w for p in spelling_variants._pieces(data) for w in spelling_variants.RUN.findall(p)] == spelling_variants.RUN.findall(data)


# --- op13 ------------------------------------------------------------------------------------------------------------

def plain_base(texts):
    held = {i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0 for i, _ in texts}
    tokens = lambda t: [*t.encode().lower().split(), None]
    counts = collections.Counter(w for i, t in texts if not held[i] for w in tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    return [(i, held[i], len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total,
             sum(np.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in tokens(t))) for i, t in texts]


@pytest.mark.parametrize("heavy", [1 << 20, 4])
def test_base_scores_against_plain_counts(spark, docs, odd, monkeypatch, heavy):
    monkeypatch.setattr(attention_scores, "HEAVY", heavy)  # 4: nearly all words go through the join
    monkeypatch.setattr(attention_scores, "EPOCHS", 1)
    some = docs.select("doc_id", "text").where("doc_id % 5 = 1").unionByName(odd.select("doc_id", "text")).withColumn("ids", F.lit(1)).withColumn("rid", F.lit(0))
    got = attention_scores.scores(some).collect()
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    want = by_row((*x[:5], round(x[5], 3)) for x in plain_base(texts_of(some)))
    found = by_row((*(getattr(r, c) for c in columns), round(r.base_score, 3)) for r in got)
    assert [x[:5] for x in found] == [x[:5] for x in want]
    assert np.allclose([x[5] for x in found], [x[5] for x in want], atol=2e-3)
    assert all(r.score < 0 for r in got)


def test_scores_of_nothing_and_without_training(spark, empty):
    assert attention_scores.scores(empty).count() == 0
    row = attention_scores.scores(spark.createDataFrame([(None, None)], "doc_id long, text string")).first()
    assert (row.doc_id, row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (None, True, 1, 0, 0, 0.0)


def test_attention_beats_single_ids_on_held_out_texts(docs):
    """The trained model gives held-out texts more probability than the frequencies of the ids do."""
    rows = attention_scores._stored(attention_scores.read(docs), scratch_path(docs.sparkSession, "lm-test"))
    counts = np.zeros(attention_scores.VOCABULARY, dtype=np.int64)
    for r in attention_scores.counts_of(rows).where("what = 1").collect():
        counts[r["key"]] = r["n"]
    counts[attention_scores.END] += rows.where("not held_out").count()
    held = [np.frombuffer(r.ids, dtype=attention_scores.IDS).astype(np.int64) for r in rows.where("held_out").collect()]
    steps = sum(len(x) + 1 for x in held)
    single = np.log10((counts + 0.1) / (counts + 0.1).sum())
    alone = sum(single[x].sum() + single[attention_scores.END] for x in held) / steps
    start = attention_scores.Scorer(attention_scores.Model(counts)).score(held).sum() / steps
    model = attention_scores.fit(rows, counts)
    assert attention_scores.Scorer(model).score(held).sum() / steps > max(alone, start) + 0.15


def test_each_id_is_scored_once_with_its_window():
    """Scores in batches equal those of a plain loop over the ids, with the context that the windows give."""
    rng = np.random.default_rng(4)
    A = attention_scores
    model = A.Model(rng.integers(0, 50, A.VOCABULARY))
    model.near = rng.standard_normal(A.WINDOW).astype(np.float32)
    model.embed = rng.standard_normal(model.embed.shape).astype(np.float32) * 0.5
    texts = [rng.integers(0, A.VOCABULARY, n) for n in (0, 1, 15, 16, 17, 31, 32, 70)]

    def plain(ids):
        given, total = [A.END, *ids], 0.0
        for t, wanted in enumerate([*ids, A.END]):
            begin = max(0, (t // A.STRIDE - 1) * A.STRIDE)
            x = model.embed[given[begin:t + 1]].astype(float)
            q = x[-1] @ model.q
            a = np.exp((x @ model.k) @ q / 4 + model.near[t - begin::-1][:len(x)])
            h = x[-1] + (a / a.sum()) @ (x @ model.v)
            p = np.exp(model.out @ h + model.bias)
            total += np.log(p[model.cls[wanted]] / p.sum()) + model.share[wanted]
        return total / np.log(10)

    assert np.allclose(A.Scorer(model).score(texts), [plain(x.tolist()) for x in texts], rtol=1e-4)
    total = sum(np.exp(model.share[model.cls == c]).sum() for c in range(A.CLASSES))
    assert abs(total - A.CLASSES) < 1e-2  # P(id | class) adds up to 1 in each class


def test_every_training_document_is_learned_from(spark):
    """Each document holds an id of its own; the parameters of all those of training documents move, and no others."""
    A = attention_scores
    rng = np.random.default_rng(6)
    texts = [np.concatenate([rng.integers(0, 100, 320), [1000 + i], rng.integers(0, 100, 319)]) for i in range(600)]  # 12600 windows
    made = [(i % 10 == 0, int(rng.integers(-1 << 62, 1 << 62)), bytearray(x.astype(A.IDS).tobytes())) for i, x in enumerate(texts)]
    common.prepare(spark)
    rows = spark.createDataFrame(made, "held_out boolean, place long, ids binary").repartition(5)
    counts = np.bincount(np.concatenate([x for i, x in enumerate(texts) if i % 10]), minlength=A.VOCABULARY)
    counts[A.END] += 540
    moved = (A.fit(rows, counts).embed != A.Model(counts).embed).any(axis=1)
    assert [bool(moved[1000 + i]) for i in range(600)] == [i % 10 != 0 for i in range(600)]
    for windows in (0, 1, A.FIT_WINDOWS, 3 * A.FIT_WINDOWS, 10 ** 6, 10 ** 12):
        cuts = A.rounds_of(windows)
        assert cuts[0][0] == 0 and cuts[-1][1] == A.PLACES and all(x[1] == y[0] for x, y in zip(cuts, cuts[1:], strict=False))


def test_windows_hold_every_id_once():
    A = attention_scores
    for n in (0, 1, 30, 31, 32, 33, 100):
        ids = np.arange(n).astype(A.IDS)
        whole = [A.END, *range(n), A.END]
        windows = [whole[at:at + A.WINDOW + 1] for at in range(0, len(whole) - 1, A.WINDOW)]
        assert A.windows_of(ids).tolist() == [w + [-1] * (A.WINDOW + 1 - len(w)) for w in windows]


def test_training_lowers_the_loss():
    A = attention_scores
    rng = np.random.default_rng(2)
    ids = np.tile(rng.integers(0, 300, 40), 60)  # a repeating text can be learned
    model = A.Model(np.bincount(ids, minlength=A.VOCABULARY))
    windows, trainer = A.windows_of(ids), A.Trainer(model)
    losses = [trainer.step(windows) for _ in range(60)]
    assert losses[-1] < 0.5 * losses[0]


def test_steps_clip_only_far_values(monkeypatch):
    """Values that cannot overflow are not passed over once more; far ones still are, and the loss stays finite."""
    A = attention_scores
    calls, clip = [], np.clip
    monkeypatch.setattr(np, "clip", lambda *args, **kw: calls.append(1) or clip(*args, **kw))
    ids = np.random.default_rng(9).integers(0, 300, 2000)
    trainer = A.Trainer(A.Model(np.bincount(ids, minlength=A.VOCABULARY)))
    assert np.isfinite(trainer.step(A.windows_of(ids))) and not calls
    trainer.model.bias += np.float32(200)
    assert np.isfinite(trainer.step(A.windows_of(ids))) and calls


def test_words_end_before_marks_and_digits_with_the_same_ids():
    """op13 asks for a word once, whatever mark or digit stands behind it; ids are those of the library."""
    import random
    encoder = type(attention_scores.encoder(P.path("byte_bpe_50k.json")))(P.path("byte_bpe_50k.json"))
    asked, compute = [], encoder.table.compute
    encoder.table.compute = lambda units: asked.extend(units) or compute(units)
    encoder.encode([" word, word. word; word5 (word) word's"])
    assert asked.count(" word") == 1 and asked.count(",") == 1 and not any(u.startswith(" word") and u != " word" for u in asked)
    draw = random.Random(3)
    parts = ["a", "s", "t", "ll", "'", "'s", "5", "12", " ", "  ", "\n", "\t", "é", "×", "ñ", "中", "(", ".", "\x00", "$", "_", "<|endoftext|>", "\u0301", "\xa0", "Ж", "½", "\x7f", "re"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(3000)]
    assert [x.tolist() for x in encoder.encode(texts)] == [encoder.whole.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("piece", [1 << 17, 8])
def test_words_of_many_texts_equal_those_of_each(monkeypatch, piece):
    monkeypatch.setattr(attention_scores, "PIECE", piece)
    texts = [b"", b" ", b"b a\tb ", b"", b"\x00 x", b"a" * 5000 + b" c", b"", b"x y x y x", b"\n", b"z"]
    for some in ([], texts[:1], texts[:2], texts):
        found = attention_scores.words_of(some)
        want = [np.unique(common.word_hashes(t).view(np.int64), return_counts=True) for t in some]
        assert [(w.tolist(), n.tolist()) for w, n in found] == [(w.tolist(), n.tolist()) for w, n in want]


def test_units_are_asked_for_once_and_kept():
    """op2 remembers more distinct units than the default table, and adding them moves none."""
    asked = []
    encoder = token_dac.unit_encoder(P.path("byte_bpe_50k.json"))
    table = common.UnitTable(lambda units: asked.append(len(units)) or [np.array([len(u), int(u)]) for u in units], encoder.table.limit)
    texts = [" ".join(map(str, range(at, at + 100_000))) for at in range(0, 1_100_000, 100_000)]
    first, second = table.encode(texts), table.encode(texts)
    assert sum(asked) == 1_100_000
    for at, x, y in zip(range(0, 1_100_000, 100_000), first, second, strict=True):
        assert (x == y).all() and (x[1::2] == np.arange(at, at + 100_000)).all()


# --- long texts ------------------------------------------------------------------------------------------------------

def test_quality_of_long_texts_in_linear_time():
    import time
    began = time.time()
    for text in ("=" * 2_000_000, "=a" * 1_000_000, "same line\n" * 200_000, "word " * 400_000):
        quality_ledger.measure(text)
    assert time.time() - began < 60
    assert quality_ledger.measure("a=b == _1 é1 日 12")[-1] == 3


# --- op9: labels of the method ---------------------------------------------------------------------------------------

def plain_passages(text):
    """Label -> coverage by the definition: over all diagonals that are strongest within MAX_SHIFT."""
    L = license_diagonals
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    places = collections.defaultdict(list)
    for i in range(len(words) - 1):
        places[words[i], words[i + 1]].append(i)
    out = {}
    for passage, label in L.PASSAGES:
        w = passage.split()
        met = collections.defaultdict(set)
        for t in range(len(w) - 1):
            for i in places[w[t], w[t + 1]]:
                met[i - t].add(t)
        for d, own in met.items():
            near = [e for e in range(d - L.MAX_SHIFT, d + L.MAX_SHIFT + 1) if e in met]
            if max(near, key=lambda e: (len(met[e]), -e)) == d:
                share = len(set().union(*(met[e] for e in near))) / (len(w) - 1)
                if share >= L.MIN_COVERAGE:
                    out[label] = max(share, out.get(label, 0))
    return out


def test_license_labels_against_plain_diagonals(spark):
    rng = random.Random(9)
    rows = [(0, "the software " * 9), (1, "free of charge " * 12), (2, "the license the software " * 40)]
    for i in range(3, 60):
        words = []
        for _ in range(rng.randint(1, 3)):
            words += rng.choices(["the", "software", "license", "free", "of", "charge", "x", "mit", "and"], k=rng.randint(0, 30))
            part = rng.choice(license_diagonals.PASSAGES)[0].split()
            words += [w for w in part for _ in range(rng.choice([1, 1, 1, 1, 1, 1, 1, 0, 2]))][:rng.randint(3, 60)]
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    out = {r.doc_id: r for r in license_diagonals.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0].labels == out[1].labels == out[2].labels == ""
    for i, text in rows:
        want = plain_passages(text)
        base = {x for x in out[i].base_labels.split(",") if x}
        assert {x for x in out[i].labels.split(",") if x} == set(want) | base
        assert out[i].score == pytest.approx(max([1.0] * bool(base) + list(want.values()), default=0.0))


def test_equal_rows_are_put_together_before_they_are_dealt(spark):
    rows = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the mit license and the apache license").alias("text"))
    out = license_diagonals.scan(rows)
    assert out.count() == 4000 and out.distinct().count() == 1


# --- op3: rates against a plain fit ----------------------------------------------------------------------------------

def test_rates_against_a_plain_projected_fit(spark):
    """Rates of 200 documents equal those of the same descent written plainly, meet the targets, and are never negative."""
    rng = np.random.default_rng(6)
    p = rng.dirichlet([0.3, 0.2, 0.3], 200)
    n = rng.integers(1, 500, 200)
    rows = [(i, i, 1, int(n[i]), [float(x) for x in p[i]]) for i in range(200)]
    known = spark.createDataFrame(rows, "doc_id long, row long, copies int, tokens long, p array<double>")
    steps, told = soft_mix.solve(known)
    rate = np.array([r.r for r in known.select("doc_id", soft_mix.rate_of(steps).alias("r")).orderBy("doc_id").collect()])
    share = np.array([soft_mix.TARGETS[d] for d in soft_mix.DOMAINS])
    totals = lambda r: (r * n) @ p
    wanted = share * max(n.sum(), totals(np.ones(200))[0] / share[0])
    assert (rate >= 0).all() and np.allclose(totals(rate), wanted, rtol=2e-3) and np.allclose(told["targets"], wanted)
    plain, active, whole = np.ones(200), np.ones(200, dtype=bool), (p * n[:, None]).T @ p
    while (abs(totals(plain) - wanted) > 1e-3 * wanted).any():
        gram = (p * (n * active)[:, None]).T @ p
        plain = np.maximum(0, plain - p @ np.linalg.solve((1 - 1e-6) * gram + 1e-6 * whole, totals(plain) - wanted))
        active = plain > 0
    assert np.allclose(rate, plain, rtol=1e-4, atol=1e-6) and len(steps) < 30
