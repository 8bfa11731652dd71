"""Token counts of byte-level BPE by rank-synchronous merging of ragged numpy arrays.

A batch of pre-tokens is one flat symbol array plus sequence numbers. Each step looks up the merge rank of every
neighbouring pair, takes the lowest rank within each sequence, and merges all places of that pair in all sequences at
once; sequences without a mergeable pair leave the batch. What remains per sequence are its tokens.

Texts are cut into units before a space or line feed that follows a visible character: pre-token patterns of this kind
never reach across such a place, so a unit's count does not depend on its neighbours and can be remembered (see
common.UnitTable).

Defined results: a null or empty text has 0 bytes and 0 tokens; a null doc_id is carried; repeated rows are counted
one by one; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LIMIT = 1024


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabularies: printable Latin-1 bytes stand for themselves, the rest follow 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class RankMerger:
    """Merge table of a byte-level BPE file: symbols are numbered, a pair's key is left * n + right."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        alphabet = byte_alphabet()
        number = {c: alphabet[c] for c in alphabet}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        for left, right in merges:
            number.setdefault(left + right, len(number))
        self.size = len(number)
        keys = np.array([number[a] * self.size + number[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.result = np.array([number[a + b] for a, b in merges], dtype=np.int64)
        self.none = len(merges)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.split_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.seen = common.UnitTable(lambda units: list(np.array(self._count_units(units), dtype=np.uint32)[:, None]))

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def merge(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols that survive per sequence."""
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        counts = lengths.copy()
        symbols = np.frombuffer(b"".join(sequences), dtype=np.uint8).astype(np.int64)
        owner = np.repeat(np.arange(len(sequences)), lengths)
        while len(symbols) > 1:
            rank = np.full(len(symbols), self.none, dtype=np.int64)
            rank[:-1] = np.where(owner[:-1] == owner[1:], self._ranks(symbols[:-1], symbols[1:]), self.none)
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            spans = np.diff(starts, append=len(owner))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), spans)
            hit = (rank == lowest) & (rank < self.none)
            # a pair of equal symbols can overlap itself: of a run of hits, every second place merges, from the left
            begin = hit.copy()
            begin[1:] &= ~hit[:-1]
            place = np.arange(len(hit))
            first = np.maximum.accumulate(np.where(begin, place, 0))
            hit &= (place - first) % 2 == 0
            symbols = np.where(hit, self.result[np.minimum(rank, self.none - 1)], symbols)
            alive = lowest < self.none
            stay = np.ones(len(hit), dtype=bool)
            stay[1:] = ~hit[:-1]
            counts -= np.bincount(owner[hit], minlength=len(counts))
            stay &= alive  # finished sequences leave the arrays
            symbols, owner = symbols[stay], owner[stay]
        return counts

    def _count_units(self, units: list[str]) -> list[int]:
        pieces, owner, extra = [], [], np.zeros(len(units), dtype=np.int64)
        for i, unit in enumerate(units):
            parts = [unit]
            if self.split_special and self.split_special.search(unit):
                parts = self.split_special.split(unit)
                extra[i] = len(parts) - 1
            for part in parts:
                found = self.pattern.findall(part)
                pieces += found
                owner += [i] * len(found)
        if not pieces:
            return extra.tolist()
        names, back = np.unique(np.array(pieces, dtype=object), return_inverse=True)
        counts = self.merge([p.encode("utf-8", "surrogatepass") for p in names])
        return (extra + np.bincount(np.array(owner), weights=counts[back], minlength=len(units)).astype(np.int64)).tolist()

    def count(self, texts: list[str]) -> list[int]:
        return [int(found.sum()) for found in self.seen.encode(texts)]


@functools.cache
def merger(path: str) -> RankMerger:
    return RankMerger(path)


def token_counts(docs: DataFrame, file_name: str = "byte_bpe_50k.json", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row; one pass, no shuffle."""

    def counted(batches):
        rank_merger = merger(public_tokenizers.path(file_name))
        for pdf in batches:
            texts = pdf["text"].tolist()
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_bytes": pdf["n_bytes"], "n_tokens": rank_merger.count(texts)})

    sized = common.text_of(docs, "doc_id").withColumn("n_bytes", F.octet_length("text").cast("long"))
    return (sized.mapInPandas(counted, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))


def op7_rank_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(common.documents(spark, sf_dir))
