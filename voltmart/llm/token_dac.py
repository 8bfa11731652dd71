"""Token ids in files of directly addressable codes (DAC).

A shard holds whole documents. Each id is cut into chunks (low chunk first); level 0 has one chunk per token, and a
continuation bitmap says which tokens go on in the next level, which holds chunks of those tokens only. A rank
directory (set bits before every block of 512) gives a token's place in the next level, so any token is read by one
lookup per level without decoding its neighbours.

Layout of a shard (little-endian): ``DAC1``, u32 tokens, u32 documents, u32 levels; u64 end offset of each document
(in tokens); then per level u32 chunk bytes, u32 chunks, the chunks, the bitmap (least bit first, padded to 64 bytes)
and the u32 directory. Shards travel in Parquet rows (part, shard, part_offset, doc_ids, data): Spark's committer then
makes a lost executor's half-written file invisible, and any store Spark can reach will do. A small second table holds
the tokens before each part.

Defined results: a null or empty text has only the end id; null doc_ids come first and stay null; repeated rows are
documents of their own, next to each other, ordered by the hash of their text; extra columns are ignored; an empty
table gives empty files and an empty result.
"""

from __future__ import annotations

import functools
import os
import struct
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import common

END_ID = 2
SHARD_TOKENS = 1 << 20
UNITS = 3_000_000  # that a task remembers, about 150 MB
CHUNK_BYTES = (1, 1, 2)
BLOCK_BITS = 512
POSITION_BITS = 20  # of a block of positions that shards are looked up by
SHARD_SCHEMA = "part int, shard int, part_offset long, n_docs long, n_tokens long, doc_ids binary, no_id binary, data binary"


# --- codes -----------------------------------------------------------------------------------------------------------

def encode_shard(ids: np.ndarray, doc_ends: np.ndarray) -> bytes:
    out = [b"DAC1", struct.pack("<III", len(ids), len(doc_ends), len(CHUNK_BYTES)), doc_ends.astype("<u8").tobytes()]
    rest = ids.astype(np.uint32)
    for width in CHUNK_BYTES:
        chunk = rest & np.uint32((1 << 8 * width) - 1)
        more = (rest >> np.uint32(8 * width)) if 8 * width < 32 else np.zeros_like(rest)
        bits = more > 0
        blocks = -(-len(bits) // BLOCK_BITS)
        bitmap = np.zeros(blocks * BLOCK_BITS, dtype=np.uint8)
        bitmap[:len(bits)] = bits
        directory = np.concatenate([[0], np.cumsum(bitmap.reshape(blocks, BLOCK_BITS).sum(axis=1, dtype=np.int64))])
        out += [struct.pack("<II", width, len(chunk)), chunk.astype(f"<u{width}").tobytes(),
                np.packbits(bitmap, bitorder="little").tobytes(), directory.astype("<u4").tobytes()]
        rest = more[bits]
    return b"".join(out)


class Shard:
    """Read access to one shard; nothing is decoded until asked for."""

    def __init__(self, data: bytes):
        if data[:4] != b"DAC1":
            raise ValueError("not a DAC shard")
        self.n_tokens, n_docs, n_levels = struct.unpack_from("<III", data, 4)
        at = 16
        self.doc_ends = np.frombuffer(data, "<u8", n_docs, at).astype(np.int64)
        at += 8 * n_docs
        self.levels = []
        for _ in range(n_levels):
            width, n = struct.unpack_from("<II", data, at)
            at += 8
            chunks = np.frombuffer(data, f"<u{width}", n, at)
            at += width * n
            blocks = -(-n // BLOCK_BITS)
            bitmap = np.frombuffer(data, np.uint8, blocks * BLOCK_BITS // 8, at)
            at += len(bitmap)
            directory = np.frombuffer(data, "<u4", blocks + 1, at)
            at += 4 * (blocks + 1)
            self.levels.append((width, chunks, bitmap, directory))

    def token(self, i: int) -> int:
        """The i-th token: one chunk, one bit and one rank per level."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = shift = 0
        for width, chunks, bitmap, directory in self.levels:
            value |= int(chunks[i]) << shift
            shift += 8 * width
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK_BITS
            inside = np.unpackbits(bitmap[block * BLOCK_BITS // 8:(i >> 3) + 1], bitorder="little")
            i = int(directory[block]) + int(inside[:i - block * BLOCK_BITS].sum())
        return value

    def tokens(self) -> np.ndarray:
        values = np.zeros(self.n_tokens, dtype=np.uint32)
        owner, shift = np.arange(self.n_tokens), 0
        for width, chunks, bitmap, _ in self.levels:
            values[owner] |= chunks.astype(np.uint32) << np.uint32(shift)
            shift += 8 * width
            owner = owner[np.unpackbits(bitmap, bitorder="little")[:len(chunks)].astype(bool)]
        return values


# --- tokens ----------------------------------------------------------------------------------------------------------

class UnitEncoder:
    """Ids of whole texts from the tokenizers library, which is asked once per distinct unit (common.UnitTable).

    Units go to it many at a time with zero bytes between them; a first pre-tokenizer sets those apart, so that each
    is one known id, and every unit is pre-tokenized by itself.
    """

    def __init__(self, path: str, limit: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        self.joined = Tokenizer.from_file(path)
        self.joined.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("\x00", "isolated"), self.whole.pre_tokenizer])
        (self.zero,) = self.whole.encode("\x00", add_special_tokens=False).ids
        self.table = common.UnitTable(self._encode_units, limit)

    def _encode_units(self, units: list[str]) -> list[np.ndarray]:
        plain = [u for u in units if "\x00" not in u]
        texts = ["\x00".join(plain[at:at + 500]) for at in range(0, len(plain), 500)]
        out = []
        for code in self.joined.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(code.ids, dtype=np.uint32)
            at = 0
            for end in np.append(np.flatnonzero(ids == self.zero), len(ids)).tolist():
                out.append(ids[at:end])
                at = end + 1
        if len(plain) == len(units):
            return out
        known = iter(out)
        return [next(known) if "\x00" not in u else
                np.array(self.whole.encode(u, add_special_tokens=False).ids, dtype=np.uint32) for u in units]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.table.encode(texts)


@functools.cache
def unit_encoder(path: str) -> UnitEncoder:
    return UnitEncoder(path, UNITS)


# --- files -----------------------------------------------------------------------------------------------------------

def write_dac(docs: DataFrame, path: str, file_name: str = "byte_bpe_50k.json", end_id: int = END_ID,
              shard_tokens: int = SHARD_TOKENS) -> None:
    """Write ``path``/shards and ``path``/parts in ascending doc_id order.

    The texts are range-partitioned (the only shuffle) before they are encoded, so that the range sampling never
    runs the encoder.
    """

    def shards(batches):
        encoder = unit_encoder(public_tokenizers.path(file_name))
        part, number, before = TaskContext.get().partitionId(), 0, 0
        held_ids, held, size = [], [], 0

        def row():
            ends = np.cumsum([len(x) for x in held])
            ids = pd.array(held_ids, dtype="Int64")
            return pd.DataFrame([{
                "part": part, "shard": number, "part_offset": before, "n_docs": len(held), "n_tokens": size,
                "doc_ids": ids.fillna(0).to_numpy("<i8").tobytes(), "no_id": ids.isna().astype("u1").tobytes(),
                "data": encode_shard(np.concatenate(held), ends)}])

        for pdf in batches:
            for doc_id, ids in zip(pdf["doc_id"].astype("Int64"), encoder.encode(pdf["text"].tolist()), strict=True):
                held_ids.append(doc_id)
                held.append(np.append(ids, np.uint32(end_id)))
                size += len(held[-1])
                if size >= shard_tokens:
                    yield row()
                    number, before, held_ids, held, size = number + 1, before + size, [], [], 0
        if held:
            yield row()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    (common.text_of(docs, "doc_id").repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInPandas(shards, SHARD_SCHEMA).write.mode("errorifexists").parquet(f"{path}/shards"))
    totals = docs.sparkSession.read.parquet(f"{path}/shards").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    # one row per written part, so the ordered sum over all of them is small
    base = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    totals.select("part", F.coalesce(base, F.lit(0)).alias("base")).write.mode("errorifexists").parquet(f"{path}/parts")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shard rows with ``start``: tokens of all documents before the shard."""
    parts = spark.read.parquet(f"{path}/parts")
    return (spark.read.parquet(f"{path}/shards").join(parts, "part")
            .withColumn("start", F.col("base") + F.col("part_offset")).drop("base"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files."""

    def rows(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                shard = Shard(r.data)
                ids, ends = shard.tokens().astype("<u4"), shard.doc_ends
                starts = np.concatenate([[0], ends[:-1]])
                doc_ids = pd.array(np.frombuffer(r.doc_ids, "<i8").copy(), dtype="Int64")
                doc_ids[np.frombuffer(r.no_id, "u1").astype(bool)] = pd.NA
                yield pd.DataFrame({"doc_id": doc_ids, "start": starts + r.start, "n_tokens": ends - starts,
                                    "ids_crc32": [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    return read_shards(spark, path).select("doc_ids", "no_id", "data", "start").mapInPandas(
        rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_tokens(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """Random access: position (tokens before it in the whole corpus) -> token; positions outside give no row, repeated ones
    a row each.

    Positions meet their shard by an equi-join on blocks of 2^20 positions, a shard being listed in every block it touches.
    A shard's data is joined once per block of its own positions, with the distinct ones asked for there.
    """
    blocks = F.sequence(F.shiftright("start", POSITION_BITS), F.shiftright(F.col("start") + F.col("n_tokens") - 1, POSITION_BITS))
    ranges = read_shards(spark, path).where("n_tokens > 0").select("part", "shard", "start", "n_tokens", F.explode(blocks).alias("block"))
    asked = positions.select(F.col("position").cast("long").alias("position"))
    placed = asked.distinct().withColumn("block", F.shiftright("position", POSITION_BITS)).join(ranges, "block").where(
        (F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n_tokens")))
    at = F.col("position") - F.col("start")
    wanted = placed.groupBy("part", "shard", F.shiftright(at, POSITION_BITS).alias("piece")).agg(
        F.collect_list("position").alias("positions"), F.collect_list(at).alias("at"))

    def look(batches):
        for pdf in batches:
            for data, where, places in zip(pdf["data"], pdf["positions"], pdf["at"], strict=True):
                shard = Shard(data)
                yield pd.DataFrame({"position": where, "token": [shard.token(int(i)) for i in places]})

    found = (wanted.join(spark.read.parquet(f"{path}/shards").select("part", "shard", "data"), ["part", "shard"])
             .select("positions", "at", "data").mapInPandas(look, "position long, token long"))
    return asked.join(found, "position")


def op2_token_dac(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-dac")
    write_dac(common.documents(spark, sf_dir), path)
    return read_documents(spark, path)
