"""SentencePiece encoding with byte spans in the original text, and decoding.

Normalisation takes, at each place, the longest prefix the model's compiled character map (a double-array trie) knows
and writes its replacement; every normalised byte keeps the source bytes it came from. Pieces tile the normalised
text, so cumulated piece lengths and that alignment give each piece's span in the original bytes.

Segmentation is the sentencepiece library's. For models whose pieces never hold a visible character before the space
mark, texts are cut before single spaces and line feeds and the library is asked once per distinct unit
(common.UnitTable); other texts and models are encoded whole.

Defined results: a null or empty text has no ids and decodes to the empty text; a null doc_id is carried; repeated
rows are encoded one by one; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

MARK = "▁"
MARK_BYTES = MARK.encode()


class CharacterMap:
    """The compiled map: u32 size of the trie in bytes, its units, then replacements ended by zero bytes."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.replacements = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest known prefix of data[at:]."""
        if not self.units:
            return None
        best, node = None, 0
        unit = self.units[0]
        node ^= (unit >> 10) << ((unit & 0x200) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                value = self.units[node] & 0x7FFFFFFF
                best = self.replacements[value:self.replacements.index(0, value)], i + 1 - at
        return best


class Normaliser:
    """Normalised bytes with, for each of them, the first and last + 1 source byte."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        if self.map.units or self.squeeze:
            return self._stepwise(data)
        if not data:
            return b"", np.empty(0, np.int64), np.empty(0, np.int64)
        source = np.arange(len(data))
        begin = np.repeat(source, np.where(np.frombuffer(data, np.uint8) == 0x20, len(MARK_BYTES), 1))
        end = begin + 1
        lead = len(MARK_BYTES) if self.prefix else 0
        out = MARK_BYTES[:lead] + data.replace(b" ", MARK_BYTES)
        return out, np.concatenate([np.zeros(lead, np.int64), begin]), np.concatenate([np.zeros(lead, np.int64), end])

    def _stepwise(self, data: bytes):
        out, begin, end, at = bytearray(), [], [], 0
        steps = []
        while at < len(data):
            found = self.map.longest(data, at)
            if found is None:
                width = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                found = data[at:at + width], width
            steps.append((found[0], at, at + found[1]))
            at += found[1]
        if self.squeeze:
            while steps and steps[0][0].strip(b" ") == b"":
                steps.pop(0)
            while steps and steps[-1][0].strip(b" ") == b"":
                steps.pop()
        if not steps:
            return b"", np.empty(0, np.int64), np.empty(0, np.int64)
        if self.prefix:
            out += MARK_BYTES
            begin += [steps[0][1]] * len(MARK_BYTES)
            end += [steps[0][1]] * len(MARK_BYTES)
        space = self.prefix or self.squeeze
        for text, a, b in steps:
            for c in (bytes([x]) for x in text) if b" " in text else [text]:
                if c == b" ":
                    if self.squeeze and space:
                        continue
                    c = MARK_BYTES
                space = c == MARK_BYTES
                whole = len(c) == b - a and c == data[a:b]
                begin += range(a, b) if whole else [a] * len(c)
                end += range(a + 1, b + 1) if whole else [b] * len(c)
                out += c
        if self.squeeze:
            while out.endswith(MARK_BYTES) and len(out) > len(MARK_BYTES):
                del out[-3:], begin[-3:], end[-3:]
        return bytes(out), np.array(begin, np.int64), np.array(end, np.int64)


class PieceEncoder:
    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model_pb2
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        self.normalise = Normaliser(proto.normalizer_spec)
        self.byte_fallback = proto.trainer_spec.byte_fallback
        self.lengths = np.array([1 if p.type == p.BYTE else len(p.piece.encode()) for p in proto.pieces], dtype=np.int64)
        spec = proto.normalizer_spec
        plain = not spec.precompiled_charsmap and spec.add_dummy_prefix and not spec.remove_extra_whitespaces and spec.escape_whitespaces
        apart = all("\n" not in p.piece and MARK not in p.piece.lstrip(MARK) and p.type != p.USER_DEFINED for p in proto.pieces)
        self.mark = self.processor.piece_to_id(MARK)
        self.by_units = bool(plain and apart and self.byte_fallback and not proto.trainer_spec.treat_whitespace_as_suffix
                             and proto.pieces[self.mark].piece == MARK)
        self.table = common.UnitTable(self._encode_units)

    def _cuttable(self, text: str) -> bool:
        return self.by_units and text != "" and not (text[0].isspace() or text[-1] == " " or MARK in text or "\x00" in text
                                                     or common.DOUBLE_SPACE.search(text))

    def _encode_units(self, units: list[str]) -> list[np.ndarray]:
        """' word' has the ids of 'word' (the dummy prefix is its space); a line feed takes no space mark."""
        out = []
        found = self.processor.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        for unit, ids in zip(units, found, strict=True):
            if unit[0] == "\n":
                if ids[0] != self.mark:
                    raise ValueError("a line feed joined the space mark")
                ids = ids[1:]
            out.append(np.array(ids, dtype=np.uint32))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each whole text."""
        cuttable = [self._cuttable(t) for t in texts]
        found = iter(self.table.encode([t for t, c in zip(texts, cuttable, strict=True) if c]))
        return [next(found) if c else np.array(self.processor.encode(t), dtype=np.uint32) for t, c in zip(texts, cuttable, strict=True)]

    def piece_lengths(self, text: str, ids: np.ndarray) -> np.ndarray:
        """Normalised bytes of each piece."""
        if self.byte_fallback:
            return self.lengths[ids]
        pieces = self.processor.encode(text, out_type=str)
        return np.array([1 if self.processor.is_byte(int(i)) else len(p.encode()) for i, p in zip(ids, pieces, strict=True)], dtype=np.int64)

    def spans(self, text: str, ids: np.ndarray) -> np.ndarray:
        """One (begin, end) row per piece: its bytes in the original text (the dummy prefix has none)."""
        normal, begin, end = self.normalise(text.encode("utf-8", "surrogatepass"))
        stop = np.cumsum(self.piece_lengths(text, ids))
        if len(ids) == 0:
            return np.empty((0, 2), np.int64)
        if stop[-1] != len(normal):
            raise ValueError("the pieces don't tile the normalised text")
        start = np.concatenate([[0], stop[:-1]])
        return np.column_stack([begin[start], end[stop - 1]])


@functools.cache
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


FIELDS = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                       T.StructField("decoded_sha256", T.StringType()), T.StructField("n_covered", T.LongType()),
                       T.StructField("spans_crc32", T.LongType())])


def encoded_pieces(docs: DataFrame, file_name: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, ids (array), begins and ends (byte spans in the original text, one per id) and the decoded text."""

    def rows(batches):
        encoder = piece_encoder(public_tokenizers.path(file_name))
        for pdf in batches:
            texts = pdf["text"].tolist()
            ids = encoder.encode(texts)
            spans = [encoder.spans(t, x) for t, x in zip(texts, ids, strict=True)]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": [x.astype(np.int64) for x in ids],
                                "begins": [s[:, 0] for s in spans], "ends": [s[:, 1] for s in spans],
                                "decoded": [encoder.processor.decode(x.tolist()) if len(x) else "" for x in ids]})

    return common.text_of(docs, "doc_id").mapInPandas(
        rows, "doc_id long, ids array<long>, begins array<long>, ends array<long>, decoded string")


def digests(texts: list[str], encoder: PieceEncoder) -> pd.DataFrame:
    rows = []
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        spans, listed = encoder.spans(text, ids), ids.tolist()
        decoded = encoder.processor.decode(listed) if listed else ""
        decimal = ",".join(map(str, listed)).encode()
        rows.append((len(ids), hashlib.sha256(decimal).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(),
                     int((spans[:, 1] - spans[:, 0]).sum()), zlib.crc32(spans.astype("<i8").tobytes())))
    return pd.DataFrame(rows, columns=FIELDS.names)


def with_digests(docs: DataFrame, file_name: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id and the digests of ids, decoded text and spans; one pass, no shuffle."""

    def rows(batches):
        encoder = piece_encoder(public_tokenizers.path(file_name))
        for pdf in batches:
            yield pd.concat([pdf[["doc_id"]].reset_index(drop=True), digests(pdf["text"].tolist(), encoder)], axis=1)

    schema = T.StructType([T.StructField("doc_id", T.LongType()), *FIELDS.fields])
    return common.text_of(docs, "doc_id").mapInPandas(rows, schema)


def op6_piece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_digests(common.documents(spark, sf_dir))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage (the last): the digests of every document that is left."""
    common.prepare(spark)
    return with_digests(docs)
