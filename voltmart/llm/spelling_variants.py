"""Spelling variants by k-d trees over letter-count vectors.

A word is a point: how often each of the LETTERS stands in it. One replaced letter moves the point by +1 in one letter
and -1 in another (L1 distance two), one inserted letter by +1 (distance one). So the words near a word lie in a small
range around its point, and of those points the ones whose words agree in letter order but for one place are near.

1. Words are counted in tasks before the shuffle.
2. Every length with more than CELL words gets a k-d tree from a sample of its points (SAMPLE in all, a documented
   bound; it decides only where cells are cut). Each word is dealt to the cell of its point as data, and as a query, per
   pair of lengths (its own, and one more), to all cells whose box its range meets. A cell with more rows than one task
   should hold is cut into blocks of data and of queries that meet each other once.
3. In a block, the words of equal counts are one point of a k-d tree of its own, searched by all queries at once: a box
   is entered only by queries within reach, each with at most one letter more and one less. Found points are held
   against their words letter by letter. Only sums per word leave the block (near words, and the largest of them).
4. Forms follow from the sums; roots by doubling: each round follows a word's root to that word's root. A form has at
   least twice its word's count, so the rounds needed follow from the largest count.

Words of equal counts are never near each other, so even many of them at one point are one point for the search; two
points with many words each are matched by what is left without the changed letter, not pair by pair.

Intermediate tables go to the shared folder.

Defined results: a null text has no words; a null doc_id is written as the empty string in the hash; words are told
apart in code-point order; repeated rows count again; very long texts are read in pieces that end between words; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import common

MIN_LENGTH, MIN_COUNT = 5, 3
TYPO = 97  # one (document, word) in so many loses a letter
RUN = re.compile(rb"(?:[A-Za-z]|\xC3[\x80-\xBF])+")  # A-Z, a-z and U+00C0..U+00FF in UTF-8
OUTSIDE = re.compile(rb"[^A-Za-z\x80-\xFF]")
LETTERS = 26 + 64
PIECE = 1 << 22
HELD = 400_000  # distinct words that a task counts before it hands them on
CELL = 1 << 15  # words in a cell
SAMPLE = 1 << 15  # points that cells are cut by, over all lengths
ROOM = 1 << 22  # letters in one side of a block
LEAF = 8
PLACED = 1 << 16  # words that are dealt to cells at a time
MANY = 4096  # pairs of words at two points from which they are matched by their rests


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


# --- words -----------------------------------------------------------------------------------------------------------

def _pieces(data: bytes):
    at = 0
    while at < len(data):
        end = at + PIECE
        cut = OUTSIDE.search(data, end) if end < len(data) else None
        end = cut.end() if cut else len(data)
        yield data[at:end]
        at = end


def with_typo(word: bytes, h: int) -> bytes:
    letters = word.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def _count_words(batches):
    counts: Counter = Counter()

    def handed():
        kept = [(w.decode(), n) for w, n in counts.items() if n > 0 and len(w) - w.count(b"\xC3") >= MIN_LENGTH]
        counts.clear()
        return pd.DataFrame(kept, columns=["word", "n"])

    for pdf in batches:
        for doc_id, text in zip(pdf["id"], pdf["text"], strict=True):
            seed = zlib.crc32(f"{doc_id}:".encode())
            for piece in _pieces(text.encode("utf-8", "surrogatepass")):
                found = RUN.findall(piece.lower())
                counts.update(found)
                for word in set(found):
                    h = zlib.crc32(word, seed)
                    if not h % TYPO:
                        n = found.count(word)
                        counts[word] -= n
                        counts[with_typo(word, h)] += n
            if len(counts) > HELD:
                yield handed()
    yield handed()


def words_of(docs: DataFrame) -> DataFrame:
    """word, n (occurrences in all documents), length (code points)."""
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    counted = keyed.mapInPandas(_count_words, "word string, n long")
    return (counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)
            .withColumn("length", F.length("word")))


# --- points ----------------------------------------------------------------------------------------------------------

def codes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter numbers (0 .. LETTERS - 1) of all words in a row, and the words' lengths."""
    code = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    return np.where(code < 0xC0, code - 0x61, code - 0xC0 + 26).astype(np.int16), np.array([len(w) for w in words], dtype=np.int64)


def points_of(code: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    owner = np.repeat(np.arange(len(lengths)), lengths)
    return np.bincount(owner * LETTERS + code, minlength=len(lengths) * LETTERS).reshape(-1, LETTERS).astype(np.int32)


class Tree:
    """k-d tree of points: inner node i splits dim[i] at cut[i] (left: <= cut); leaves hold point numbers."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.dim, self.cut, self.child, self.leaves = [], [], [], []
        stack = [(np.arange(len(points)), None)]
        while stack:
            rows, above = stack.pop()
            mine = points[rows]
            spread = mine.var(axis=0) if len(rows) > leaf else np.zeros(1)
            if spread.max() == 0:
                place = -1 - len(self.leaves)
                self.leaves.append(rows)
            else:
                d = int(spread.argmax())
                values = np.sort(mine[:, d])
                half = values[(len(values) - 1) // 2]
                t = int(half if half < values[-1] else values[values < half][-1])
                place = len(self.dim)
                self.dim.append(d)
                self.cut.append(t)
                self.child.append([0, 0])
                left = mine[:, d] <= t
                stack += [(rows[~left], (place, 1)), (rows[left], (place, 0))]
            if above is not None:
                self.child[above[0]][above[1]] = place
        self.top = 0 if self.dim else -1

    def reach(self, points: np.ndarray, more: int, less: int):
        """(leaf, numbers of the points whose range meets the leaf's box): a range allows one letter up if ``more``,
        and one down if ``less``."""
        n = len(points)
        none = np.full(n, -1, dtype=np.int16)
        stack = [(self.top, np.arange(n), none, none)]
        while stack:
            node, rows, up, down = stack.pop()
            if not len(rows):
                continue
            if node < 0:
                yield -1 - node, rows
                continue
            d, t = self.dim[node], self.cut[node]
            # a letter already moved by an earlier box stays where that box wants it
            at = points[rows, d] + (up == d) - (down == d)
            left = at <= t
            rise = left & (at == t) & (up < 0) if more else np.zeros(len(rows), dtype=bool)
            fall = ~left & (at == t + 1) & (down < 0) if less else np.zeros(len(rows), dtype=bool)
            to_right, to_left = ~left | rise, left | fall
            stack.append((self.child[node][1], rows[to_right], np.where(rise, d, up)[to_right].astype(np.int16), down[to_right]))
            stack.append((self.child[node][0], rows[to_left], up[to_left], np.where(fall, d, down)[to_left].astype(np.int16)))


_WEIGHTS = np.random.Generator(np.random.PCG64(12)).integers(0, 1 << 63, LETTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SIEVE = 22


def _moves(less: bool) -> tuple[np.ndarray, np.ndarray]:
    """Differences of weighted letter sums that one edit makes (sorted), and a sieve over their bits."""
    if less:
        made = (_WEIGHTS[None, :] - _WEIGHTS[:, None])[~np.eye(LETTERS, dtype=bool)]
    else:
        made = _WEIGHTS.copy()
    sieve = np.zeros(1 << _SIEVE, dtype=bool)
    sieve[(made * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SIEVE)] = True
    return np.sort(made), sieve


class Words:
    """Words of one length: letters as a matrix, and their points with the words at each."""

    def __init__(self, words: list[str]):
        self.words = words
        code, lengths = codes_of(words)
        self.letters = code.reshape(len(words), -1)
        points = points_of(code, lengths)
        sums = (points.astype(np.uint64) * _WEIGHTS[None, :]).sum(axis=1, dtype=np.uint64)
        order = np.lexsort((*points.T, sums))
        new = np.ones(len(words), dtype=bool)
        new[1:] = (points[order][1:] != points[order][:-1]).any(axis=1)
        self.order = order
        self.begin = np.flatnonzero(new)
        self.size = np.diff(self.begin, append=len(words))
        self.points, self.sums = points[order[self.begin]], sums[order[self.begin]]


def near_points(tree: Tree, data: Words, asked: Words, less: bool) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the points (asked, data) that differ as one edit makes them."""
    made, sieve = _moves(less)
    kept = []
    for leaf, rows in tree.reach(asked.points, 1, int(less)):
        held = tree.leaves[leaf]
        for some in np.array_split(rows, len(rows) * len(held) // (1 << 22) + 1):
            moved = data.sums[held][None, :] - asked.sums[some][:, None]
            maybe = sieve[(moved * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SIEVE)]
            q, p = np.nonzero(maybe)
            if len(q):
                kept.append((some[q], held[p]))
    if not kept:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    q, p = (np.concatenate(x) for x in zip(*kept, strict=True))
    step = data.points[p] - asked.points[q]
    true = ((step == 1).sum(axis=1) == 1) & ((step == -1).sum(axis=1) == int(less)) & ((step != 0).sum(axis=1) == 1 + int(less))
    return q[true], p[true]


def _agree(data: Words, asked: Words, q: np.ndarray, p: np.ndarray, less: bool) -> np.ndarray:
    """Whether words q and p are alike but for one letter replaced (less) or put in."""
    out = []
    width = max(1, data.letters.shape[1])
    for part in np.array_split(np.arange(len(q)), len(q) * width // (1 << 24) + 1):
        a, b = asked.letters[q[part]], data.letters[p[part]]
        if less:
            out.append((a != b).sum(axis=1) == 1)
        else:
            head = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
            tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
            out.append(head + tail >= a.shape[1])
    return np.concatenate(out) if out else np.empty(0, dtype=bool)


def _by_rests(data: Words, asked: Words, qs: np.ndarray, ps: np.ndarray, step: np.ndarray, less: bool) -> list[tuple[int, int]]:
    """Near words of two points with many words, by what is left without the letter that came, or went."""
    came, went = int(np.flatnonzero(step == 1)[0]), int(np.flatnonzero(step == -1)[0]) if less else None
    rests: dict = {}
    for p in ps.tolist():
        row = data.letters[p]
        for i in np.flatnonzero(row == came).tolist():
            rests.setdefault((i if less else 0, np.delete(row, i).tobytes()), set()).add(p)
    found = set()
    for q in qs.tolist():
        row = asked.letters[q]
        keys = [(i, np.delete(row, i).tobytes()) for i in np.flatnonzero(row == went).tolist()] if less else [(0, row.tobytes())]
        found |= {(q, p) for key in keys for p in rests.get(key, ())}
    return sorted(found)


def near_words(data: Words, asked: Words, less: bool, tree: Tree | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all near words (asked, data), once each: of equal length if ``less``, else data one letter longer."""
    empty = np.empty(0, dtype=np.int64)
    if not len(data.words) or not len(asked.words):
        return empty, empty
    q, p = near_points(tree or Tree(data.points, LEAF), data, asked, less)
    pairs = asked.size[q] * data.size[p]
    few = pairs <= MANY
    found = [(empty, empty)]
    for part in np.array_split(np.flatnonzero(few), int(pairs[few].sum()) // (1 << 22) + 1):
        n = pairs[part]
        owner = np.repeat(part, n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = data.size[p[owner]]
        mine, theirs = asked.order[asked.begin[q[owner]] + at // wide], data.order[data.begin[p[owner]] + at % wide]
        true = _agree(data, asked, mine, theirs, less)
        found.append((mine[true], theirs[true]))
    for i in np.flatnonzero(~few).tolist():
        a, b = q[i], p[i]
        links = _by_rests(data, asked, asked.order[asked.begin[a]:asked.begin[a] + asked.size[a]],
                          data.order[data.begin[b]:data.begin[b] + data.size[b]], data.points[b] - asked.points[a], less)
        if links:
            found.append(tuple(np.array(x, dtype=np.int64) for x in zip(*links, strict=True)))
    mine, theirs = (np.concatenate(x) for x in zip(*found, strict=True))
    return mine, theirs


# --- cells -----------------------------------------------------------------------------------------------------------

def cell_trees(words: DataFrame, counts: dict[int, int], cell: int = CELL) -> dict[int, Tree]:
    """Per length with more than ``cell`` words a tree whose leaves are cells, from at most about SAMPLE points."""
    large = sorted(n for n, k in counts.items() if k > cell)
    if not large:
        return {}
    part = min(1.0, SAMPLE / sum(counts[n] for n in large))

    def pointed(batches):
        for pdf in batches:
            found = points_of(*codes_of(pdf["word"].tolist())).clip(0, 65535).astype(np.uint16)
            yield pd.DataFrame({"length": pdf["length"], "point": [x.tobytes() for x in found]})

    chosen = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(part * (1 << 30))
    held = words.where(F.col("length").isin(large) & chosen).select("word", "length").mapInPandas(pointed, "length int, point binary").toPandas()
    trees = {}
    for length, rows in held.groupby("length"):
        points = np.frombuffer(b"".join(sorted(rows["point"])), dtype=np.uint16).reshape(-1, LETTERS).astype(np.int32)
        cells = math.ceil(counts[length] / cell)
        trees[int(length)] = Tree(points, max(1, math.ceil(len(points) / cells)))
    return trees


def _gathered(batches, size: int):
    """The same rows in frames of at least ``size`` rows (the last one: what is left)."""
    held, n = [], 0
    for pdf in batches:
        held.append(pdf)
        n += len(pdf)
        if n >= size:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if n:
        yield pd.concat(held, ignore_index=True)


def dealt(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """length and cell of the data searched, side (0: data, 1: query of the same length, 2: one letter shorter), word, n."""

    def placed(batches):
        for pdf in _gathered(batches, PLACED):
            for length, rows in pdf.groupby("length"):
                length = int(length)
                whole = np.arange(len(rows))
                word, n = rows["word"].to_numpy(), rows["n"].to_numpy()
                points = None
                for side, target, more, less in ((0, length, 0, 0), (1, length, 1, 1), (2, length + 1, 1, 0)):
                    if target in trees:
                        points = points_of(*codes_of(word.tolist())) if points is None else points
                        cells, held = zip(*trees[target].reach(points, more, less), strict=True)
                    else:
                        cells, held = (0,), (whole,)
                    cell = np.repeat(cells, [len(at) for at in held])
                    at = np.concatenate(held)
                    for begin in range(0, len(at), PLACED):
                        some = at[begin:begin + PLACED]
                        yield pd.DataFrame({"length": target, "cell": cell[begin:begin + PLACED], "side": side, "word": word[some], "n": n[some]})

    return words.select("word", "n", "length").mapInPandas(placed, "length int, cell int, side int, word string, n long")


def _sums(words: list[str], counts: np.ndarray, mine: np.ndarray, theirs: np.ndarray) -> pd.DataFrame:
    """Per word of ``mine``: how many partners, and the largest of them (ties: the first in code-point order)."""
    if not len(mine):
        return pd.DataFrame({"word": [], "k": [], "best_n": [], "best": []}).astype({"word": str, "k": "int64", "best_n": "int64", "best": str})
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[theirs], -counts[theirs], mine))
    mine, theirs = mine[order], theirs[order]
    first = np.flatnonzero(np.diff(mine, prepend=-1))
    best = theirs[first]
    return pd.DataFrame({"word": [words[i] for i in mine[first]], "k": np.diff(first, append=len(mine)), "best_n": counts[best], "best": [words[i] for i in best]})


def _search(pdf: pd.DataFrame) -> pd.DataFrame:
    """One block: sums of the links between its queries and its data, for both ends where only one of them asks."""
    sides = [pdf[pdf["side"] == s] for s in (0, 1, 2)]
    data, same, shorter = (Words(s["word"].tolist()) if len(s) else None for s in sides)
    out = [_sums([], np.empty(0), np.empty(0), np.empty(0))]
    if data is None:
        return out[0]
    tree = Tree(data.points, LEAF)
    for asked, rows, less in ((same, sides[1], True), (shorter, sides[2], False)):
        if asked is None:
            continue
        mine, theirs = near_words(data, asked, less, tree)
        words = asked.words + data.words
        counts = np.concatenate([rows["n"].to_numpy(), sides[0]["n"].to_numpy()])
        theirs = theirs + len(asked.words)
        out.append(_sums(words, counts, mine, theirs))
        if not less:
            out.append(_sums(words, counts, theirs, mine))
    return pd.concat(out, ignore_index=True)


def near_sums(words: DataFrame, path: str, cell: int = CELL, room: int = ROOM) -> DataFrame:
    """word, n_near, best (near word of largest n), best_n; words without near words have no row."""
    counts = {r["length"]: r["n"] for r in words.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per length
    rows = _stored(dealt(words, cell_trees(words, counts, cell)), f"{path}/dealt")
    limit = F.greatest(F.lit(1), F.least(F.lit(2 * cell), F.lit(room) / F.col("length")))
    sizes = rows.groupBy("length", "cell").agg(F.sum((F.col("side") == 0).cast("long")).alias("nd"), F.sum((F.col("side") > 0).cast("long")).alias("nq"))
    sizes = sizes.where("nd > 0 and nq > 0").select("length", "cell", F.ceil(F.col("nd") / limit).cast("int").alias("ds"), F.ceil(F.col("nq") / (limit * 4)).cast("int").alias("qs"))
    own = F.xxhash64("word", F.lit(5))
    data = F.transform(F.sequence(F.lit(0), F.col("qs") - 1), lambda j: F.struct(F.pmod(own, "ds").cast("int").alias("i"), j.alias("j")))
    asks = F.transform(F.sequence(F.lit(0), F.col("ds") - 1), lambda i: F.struct(i.alias("i"), F.pmod(own, "qs").cast("int").alias("j")))
    # a row per cell, a few for 32768 words: a small side, left to the planner
    blocks = (rows.join(sizes, ["length", "cell"])
              .select("length", "cell", "side", "word", "n", F.inline(F.when(F.col("side") == 0, data).otherwise(asks))))
    found = blocks.groupBy("length", "cell", "i", "j").applyInPandas(_search, "word string, k long, best_n long, best string")
    top = F.min(F.struct((-F.col("best_n")).alias("n"), "best"))
    return (found.groupBy("word").agg(F.sum("k").alias("n_near"), top.alias("top"))
            .select("word", "n_near", F.col("top.best").alias("best"), (-F.col("top.n")).alias("best_n")))


def roots_of(forms: DataFrame, most: int, path: str) -> DataFrame:
    """word, root of all words with a form (word, form): the last form of the chain. ``most``: the largest count."""
    hops = max(1, int(math.log2(max(most, MIN_COUNT) / MIN_COUNT)) + 1)
    now = forms.select("word", F.col("form").alias("root"))
    for turn in range(math.ceil(math.log2(hops)) if hops > 1 else 0):
        after = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = _stored(now.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root")), f"{path}/roots-{turn}")
    return now


def variants(docs: DataFrame, path: str | None = None, cell: int = CELL, room: int = ROOM) -> DataFrame:
    """word, form, root, n, n_near, form_n per word; see the module's text."""
    path = path or scratch_path(docs.sparkSession, "spelling-variants")
    words = _stored(words_of(docs), f"{path}/words")
    most = words.agg(F.max("n")).first()[0] or 0
    is_form = F.col("best_n") >= 2 * F.col("n")
    known = _stored(words.join(near_sums(words, path, cell, room), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), f"{path}/forms")
    roots = roots_of(known.where(F.col("form").isNotNull()), most, path)
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(common.documents(spark, sf_dir))


#: DuckDB SQL of the same rows: near words share what is left without one letter.
ORACLE = """
with recursive
bits as (select list_reduce([k] || range(8), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) v, k
         from range(256) t(k)),
crc as (select list(v order by k) tbl from bits),
runs as (select id, run, count(*) n from (
           select coalesce(doc_id::varchar, '') id,
                  unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) run
           from documents where text is not null) group by id, run),
hashed as (select run, n, xor(list_reduce([4294967295] || list_transform(string_split(id || ':', ''), lambda ch: ascii(ch)::bigint)
             || flatten(list_transform(string_split(run, ''), lambda ch: case when unicode(ch) < 128 then [unicode(ch)::bigint]
                                                                           else [195, (unicode(ch) - 64)::bigint] end)),
             lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1])), 4294967295) h from runs, crc),
words as (select word, sum(n)::bigint n from (
            select case when h % 97 = 0 then run[1:h % length(run)] || run[h % length(run) + 2:] else run end word, n from hashed)
          where length(word) >= 5 group by word having sum(n) >= 3),
cut as (select word, n, i, word[1:i] || word[i + 2:] rest from (select word, n, unnest(range(length(word))) i from words)),
near as (select a.word, b.word other, b.n from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
         union select c.word, w.word, w.n from cut c join words w on c.rest = w.word
         union select w.word, c.word, c.n from cut c join words w on c.rest = w.word),
best as (select word, count(*) n_near, first(other order by n desc, other) best, max(n) best_n from near group by word),
forms as (select w.word, w.n, coalesce(b.n_near, 0) n_near, case when b.best_n >= 2 * w.n then b.best end form,
                 case when b.best_n >= 2 * w.n then b.best_n end form_n from words w left join best b using (word)),
chain as (select word, form, 0 hop from forms where form is not null
          union all select c.word, f.form, hop + 1 from chain c join forms f on f.word = c.form where f.form is not null),
roots as (select word, arg_max(form, hop) root from chain group by word)
select word, form, coalesce(root, word) root, n, n_near, form_n from forms left join roots using (word)
"""
