"""Helpers shared by the llm operators: session settings, table reads and vectorised word hashing."""

from __future__ import annotations

import functools
import os
import re
import tempfile
import zipfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# White space that ends a word: space and \x09-\x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_U64 = np.uint64
_STEP = 0x9E3779B97F4A7C15
_BLOCK = 1 << 22


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package (once per application), as a cluster user would with --py-files."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_package", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(root)
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}-package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.join(name, os.path.relpath(path, root)))
    sc.addPyFile(archive)
    sc._llm_package = True


def prepare(spark: SparkSession) -> None:
    """Arrow batches are limited in rows and, where Spark knows the setting, in bytes, so long texts do not pile up."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "33554432")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def text_of(docs: DataFrame, *keys: str) -> DataFrame:
    """Only the key columns and the text (null: empty), so that extra columns never reach Python."""
    return docs.select(*keys, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def bounded_sample(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """At most ``n`` rows, those of smallest key hash; the same ones whatever the partitioning.

    A first cut, drawn from the row count, leaves about 1.2 n rows in all partitions together, so that the ordered
    limit sorts and moves a bounded number of rows however large the input is.
    """
    total = rows.count()
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << 40))
    near = rows if total <= n else rows.where(place < int(min(1.0, 1.2 * n / total + 100.0 / total) * (1 << 40)))
    return near.orderBy(place, *keys).limit(n)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): spreads every input bit over the whole word."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


@functools.cache
def _byte_codes() -> np.ndarray:
    codes = mix((np.arange(256, dtype=_U64) + _U64(1)) * _U64(_STEP))
    codes[SPACE] = 0
    return codes


@functools.cache
def _powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP, dtype=_U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _blocks(data: bytes):
    """Pieces of about 4 MB that end in white space, so that no word is split and memory stays bounded."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + _BLOCK, n)
        while end < n and not SPACE[data[end - 1]]:
            end += 1
        yield data[at:end]
        at = end


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every word [^\\x20\\x09-\\x0D]+ of UTF-8 text, in order."""
    found = []
    for block in _blocks(data):
        a = np.frombuffer(block, dtype=np.uint8)
        word = ~SPACE[a]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        starts = np.flatnonzero(begins)
        if not len(starts):
            continue
        a, word = a[starts[0]:], word[starts[0]:]
        starts = starts - starts[0]
        gaps = np.diff(starts, append=len(a))
        place = np.arange(len(a)) - np.repeat(starts, gaps)
        powers = _powers(1 << max(6, int(gaps.max()).bit_length()))
        found.append(mix(np.add.reduceat(_byte_codes()[a] * powers[place], starts)))
    return np.concatenate(found) if found else np.empty(0, dtype=_U64)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of k words; a text of fewer words is one window, an empty one has none."""
    if not len(words):
        return words
    k = min(k, len(words))
    out = np.zeros(len(words) - k + 1, dtype=_U64)
    for j in range(k):
        out = (out + words[j:len(words) - k + 1 + j]) * _U64(_STEP)
    return mix(out + _U64(k))


#: White space before a cut place: such texts are cut by the slower exact pattern.
DOUBLE_SPACE = re.compile(r"\s[ \n]")
UNIT = re.compile(r"\s*\S+|\s+\Z")


class UnitTable:
    """Numbers (token ids, counts) of texts, put together from those of their units.

    A text is cut before spaces and line feeds that follow a visible character. ``compute`` (a list of units -> an
    array of numbers each) is asked once per distinct unit; what it gave is kept in flat arrays behind an open hash
    table, under a 128-bit hash of the unit's bytes. A full table is emptied; it saves time and changes no result.
    ``cuts`` (bytes as an array -> where else units begin) may cut finer, where that changes no number either.
    """

    def __init__(self, compute, limit: int = 1_000_000, block: int = 1 << 21, cuts=None):
        self.compute, self.limit, self.block, self.cuts = compute, limit, block, cuts
        self._reset()

    def _reset(self) -> None:
        self.slots = np.full(1 << 22, -1, dtype=np.int32)
        self.held = {}  # the arrays with room behind them, so that adding a few entries does not copy all
        self.key = np.empty((0, 2), dtype=_U64)
        self.at, self.length = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        self.values = np.empty(0, dtype=np.uint32)

    def _find(self, key: np.ndarray) -> np.ndarray:
        """Entry number of each key, -1 where there is none."""
        place = (key[:, 0] & _U64(len(self.slots) - 1)).astype(np.int64)
        entry = self.slots[place]
        if not len(self.key):
            return entry
        rest = np.flatnonzero((entry >= 0) & (self.key[entry] != key).any(axis=1))
        while len(rest):
            place[rest] = (place[rest] + 1) % len(self.slots)
            entry[rest] = self.slots[place[rest]]
            found = entry[rest]
            rest = rest[(found >= 0) & (self.key[found] != key[rest]).any(axis=1)]
        return entry

    def _longer(self, name: str, more: np.ndarray) -> np.ndarray:
        """The array of that name with ``more`` behind it."""
        now = getattr(self, name)
        n = len(now) + len(more)
        if name not in self.held or n > len(self.held[name]):
            self.held[name] = np.empty((n + n // 4, *now.shape[1:]), dtype=now.dtype)
            self.held[name][:len(now)] = now
        self.held[name][len(now):n] = more
        return self.held[name][:n]

    def _add(self, key: np.ndarray, numbers: list[np.ndarray]) -> None:
        """Put in new, distinct keys."""
        lengths = np.array([len(x) for x in numbers], dtype=np.int64)
        new = np.arange(len(self.key), len(self.key) + len(key), dtype=np.int32)
        self.at = self._longer("at", len(self.values) + np.cumsum(lengths) - lengths)
        self.key = self._longer("key", key)
        self.length = self._longer("length", lengths)
        self.values = self._longer("values", np.concatenate(numbers).astype(np.uint32, copy=False))
        place = (key[:, 0] & _U64(len(self.slots) - 1)).astype(np.int64)
        while len(new):
            free = self.slots[place] < 0
            self.slots[place[free]] = new[free]
            late = self.slots[place] != new
            new, place = new[late], (place[late] + 1) % len(self.slots)

    def _numbers(self, data: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all units (which begin at ``starts``), and how many each unit has."""
        a = np.frombuffer(data, dtype=np.uint8)
        gaps = np.diff(starts, append=len(a))
        place = np.arange(len(a)) - np.repeat(starts, gaps)
        powers = _powers(1 << max(6, int(gaps.max()).bit_length()))[place]
        codes = _unit_codes()
        key = np.column_stack([mix(np.add.reduceat(codes[i][a] * powers, starts)) for i in (0, 1)])
        if len(self.key) > self.limit:
            self._reset()
        entry = self._find(key)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            _, first, back = np.unique(key[missing, 0], return_index=True, return_inverse=True)
            if (key[missing[first]][back] != key[missing]).any():  # units that differ in the second half only
                _, first, back = np.unique(key[missing], axis=0, return_index=True, return_inverse=True)
            new = missing[first]
            stops = starts[new] + gaps[new]
            units = [data[i:j].decode("utf-8", "surrogatepass") for i, j in zip(starts[new].tolist(), stops.tolist(), strict=True)]
            before = len(self.key)
            self._add(key[new], self.compute(units))
            entry[missing] = before + back
        lengths = self.length[entry]
        take = np.arange(lengths.sum()) + np.repeat(self.at[entry] - (np.cumsum(lengths) - lengths), lengths)
        return self.values[take], lengths

    def _many(self, texts: list[tuple[bytes, np.ndarray | None]]) -> list[np.ndarray]:
        """Numbers per non-empty text; a text comes with the starts of its units, or is cut here."""
        data = b"".join(t for t, _ in texts)
        sizes = np.array([len(t) for t, _ in texts], dtype=np.int64)
        begin = np.cumsum(sizes) - sizes
        a = np.frombuffer(data, dtype=np.uint8)
        cut = (a == 0x20) | (a == 0x0A)
        for (text, own), at in zip(texts, begin.tolist(), strict=True):
            if own is not None:
                cut[at:at + len(text)] = False
                cut[at + own] = True
        if self.cuts is not None:
            cut |= self.cuts(a)
        cut[begin] = True
        starts = np.flatnonzero(cut)
        numbers, lengths = self._numbers(data, starts)
        ends = np.cumsum(lengths)[np.append(np.searchsorted(starts, begin[1:]), len(starts)) - 1]
        return np.split(numbers, ends[:-1])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Numbers of each whole text; long texts go through in pieces, short ones many at a time."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held, owners, size = [], [], 0

        def flush():
            nonlocal held, owners, size
            if held:
                for owner, numbers in zip(owners, self._many(held), strict=True):
                    out[owner].append(numbers)
            held, owners, size = [], [], 0

        for number, text in enumerate(texts):
            data = text.encode("utf-8", "surrogatepass")
            own = None
            if DOUBLE_SPACE.search(text):
                sizes = np.array([len(u.encode("utf-8", "surrogatepass")) for u in UNIT.findall(text)], dtype=np.int64)
                own = np.cumsum(sizes) - sizes
            at = 0
            while at < len(data):
                end = min(at + self.block, len(data))
                if end < len(data):  # a piece ends where a unit begins
                    if own is None:
                        spaces = [x for x in (data.find(b" ", end), data.find(b"\n", end)) if x >= 0]
                        end = min(spaces, default=len(data))
                    else:
                        later = np.searchsorted(own, end)
                        end = int(own[later]) if later < len(own) else len(data)
                held.append((data[at:end], None if own is None else own[(own >= at) & (own < end)] - at))
                owners.append(number)
                size += end - at
                at = end
                if size >= self.block:
                    flush()
        flush()
        empty = np.empty(0, dtype=np.uint32)
        return [x[0] if len(x) == 1 else np.concatenate(x) if x else empty for x in out]


@functools.cache
def _unit_codes() -> tuple[np.ndarray, np.ndarray]:
    n = np.arange(1, 257, dtype=_U64)
    return mix(n * _U64(_STEP)), mix(n * _U64(0xC2B2AE3D27D4EB4F) + _U64(1))
