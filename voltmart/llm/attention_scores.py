"""Language-model scores by a causal self-attention model, trained in numpy on subword ids.

The model reads the ids of the text (A-Z lowered) after an END mark, one attention layer with a bias per distance, and
predicts the next id as P(class) * P(id | class): the most frequent ids are classes of their own, the others share
classes of about equal weight. P(id | class) comes from the id counts of all training documents, P(class) from the
network.

1. Each text is read once: its subword ids and its words (a 64-bit hash each, with how often) are written.
2. Words and ids are counted over all training documents, in tasks before the shuffle.
3. The network learns from every id of every training document, in rounds that take documents by hash, each in one round:
   the first about FIT_WINDOWS windows (one task, EPOCHS passes, so that the tasks after it start alike), then one document
   in MIDDLE, then all others. In a round every task trains on from the parameters before it with its part of the
   documents, and the parameters are averaged, each row by how often the tasks used it. So only one set of parameters (a
   fixed size) reaches the driver.
4. Scoring cuts every text into windows of WINDOW ids that overlap by half; each window scores its second half (the
   first one all it has), so each id is scored once, with at least STRIDE ids before it where the text has them. Many
   windows go through one masked attention.

The base score needs the count of every word. Words that make up at least 1 / HEAVY of the training tokens, so at most
HEAVY of them (two numbers each), are sent to all tasks; all other words of a document go through a join with the
counts, one row per document and word. With 64 bits a word, 0.03 pairs among a billion distinct words count as one.

Defined results: a null or empty text is its end token alone; a null doc_id is hashed as the empty string, so it is held
out; repeated rows are scored one by one and learned from as often as they stand; without training documents N and V are
0; a very long text is read and scored in pieces, and its ids (2 bytes each) stand in one row; extra columns are ignored;
an empty table gives an empty result. Scores are rounded (base: 6 places, model: 3), so that sums in any order agree.
"""

from __future__ import annotations

import functools
import itertools
import math
import re

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import common
from .rank_merge import byte_alphabet
from .token_dac import UnitEncoder

FOLDS = 10  # documents whose hash this divides are held out
TOKENIZER = "byte_bpe_50k.json"
VOCABULARY = 50257
END = 50256
WIDTH = 16
STRIDE, WINDOW = 16, 32
CLASSES, SINGLE = 64, 48
UNITS, PIECE = 2_000_000, 1 << 17  # that a task remembers, about 100 MB; bytes of texts that go through at a time
PLACES = 1 << 30  # that documents are put at by hash
FIT_WINDOWS, EPOCHS = 8192, 6  # of the first round: about so many windows, passes over them
MIDDLE = 16  # one in so many documents in the first two rounds
LEARNERS = 8  # tasks per core that learn side by side
BATCH = 128
TURN = 64 * BATCH  # windows that are shuffled at a time
RATE = 0.25
HEAVY = 1 << 20
HELD = 1 << 20  # words that a task counts at a time
TOGETHER = 1 << 18  # ids scored at a time (a longer text by itself)
CHUNK = 128  # windows that go through the attention at once


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("errorifexists").option("parquet.block.size", 1 << 24).parquet(path)  # small row groups: arrays are held in memory
    return df.sparkSession.read.parquet(path)


# --- ids and words ---------------------------------------------------------------------------------------------------

def lowered(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower()  # bytes lower A-Z only


def ids_of(texts: list[bytes]) -> list[np.ndarray]:
    """Subword ids of lowered texts; strings of special tokens are ordinary text."""
    return encoder(public_tokenizers.path(TOKENIZER)).encode([t.decode("utf-8", "surrogatepass") for t in texts])


def _ends() -> np.ndarray:
    """Whether the tokenizer's words always end between two bytes: ASCII letters, digits and marks of different kinds, but
    not between an apostrophe and a letter (``'s`` is a word)."""
    kind = np.zeros(256, dtype=np.int64)
    kind[33:127] = 3
    kind[ord("'")] = 4
    for part, number in ((range(48, 58), 2), (range(65, 91), 1), (range(97, 123), 1)):
        kind[part] = number
    apart = np.zeros((5, 5), dtype=bool)
    for one, other in ((1, 2), (1, 3), (1, 4), (2, 1), (2, 3), (2, 4), (3, 1), (3, 2), (4, 2)):
        apart[one, other] = True
    return apart[kind[:, None], kind[None, :]].ravel()


ENDS = _ends()
# units that are one word of the tokenizer
ONE_WORD = re.compile(r" ?(?:[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+|[0-9]+|[!-/:-@\[-`{-~]+)")


def _cuts(data: np.ndarray) -> np.ndarray:
    found = np.zeros(len(data), dtype=bool)
    pairs = data[:-1].astype(np.uint16)
    pairs <<= 8
    pairs |= data[1:]
    ENDS.take(pairs, out=found[1:])
    return found


class WordEncoder(UnitEncoder):
    """Units are cut at every sure end of a word, so there are fewer distinct ones; those that are one word go straight to
    the tokenizer's model. Strings of special tokens are ordinary text."""

    def __init__(self, path: str):
        super().__init__(path, UNITS)
        self.whole.encode_special_tokens = self.joined.encode_special_tokens = True
        self.table = common.UnitTable(self._encode_units, UNITS, PIECE, _cuts)
        self.model = self.whole.model
        self.alphabet = {byte: char for char, byte in byte_alphabet().items()}

    def _encode_units(self, units: list[str]) -> list[np.ndarray]:
        one = [ONE_WORD.fullmatch(u) is not None for u in units]
        ids, ends = [], []
        for unit, word in zip(units, one, strict=True):
            if word:
                spelled = unit if unit.isascii() else unit.encode().decode("latin-1")  # a character for each byte
                ids += [t.id for t in self.model.tokenize(spelled.translate(self.alphabet))]
                ends.append(len(ids))
        flat = np.array(ids, dtype=np.uint32)
        words = iter([flat[i:j] for i, j in zip([0, *ends], ends, strict=False)])
        rest = iter(super()._encode_units([u for u, x in zip(units, one, strict=True) if not x]))
        return [next(words if x else rest) for x in one]


encoder = functools.cache(WordEncoder)


def words_of(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each lowered text the hashes of its distinct words [^\\x20\\x09-\\x0D]+, ascending, and how often each stands in it."""
    part = np.cumsum([len(t) for t in texts]) // PIECE
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    return [found for i, j in itertools.pairwise(cuts) for found in _words_of(texts[i:j])]


def _words_of(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    data = b"\n".join(texts)
    word = ~common.SPACE[np.frombuffer(data, dtype=np.uint8)]
    word[1:] &= ~word[:-1]  # where words begin
    ends = np.cumsum([len(t) + 1 for t in texts])
    ends = np.searchsorted(np.flatnonzero(word), ends)  # in words
    hashes = common.word_hashes(data).view(np.int64)
    first = np.ones(len(hashes), dtype=bool)
    begin = 0
    for end in ends.tolist():
        hashes[begin:end].sort()
        begin = end
    np.not_equal(hashes[1:], hashes[:-1], out=first[1:])
    first[ends[ends < len(hashes)]] = True
    at = np.flatnonzero(first)
    times = np.diff(at, append=len(hashes))
    ends = np.searchsorted(at, ends).tolist()
    hashes = hashes[at]
    return [(hashes[i:j], times[i:j]) for i, j in itertools.pairwise([0, *ends])]


IDS, WORDS, TIMES = np.dtype("<u2"), np.dtype("<i8"), np.dtype("<u4")  # as they are written; VOCABULARY fits in two bytes


def numbers(cells: pd.Series, kind: np.dtype) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=kind) for x in cells]


def read(docs: DataFrame) -> DataFrame:
    """rid (unique within what is written), doc_id (as text), held_out, place (hash of the row), and the numbers of each
    text as bytes: ids, words, times."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("string").alias("doc_id"), (F.crc32(name.cast("binary")) % FOLDS == 0).alias("held_out"),
                        F.xxhash64("doc_id", "text").alias("place"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        number = TaskContext.get().partitionId() << 40
        for pdf in batches:
            texts = [lowered(t) for t in pdf["text"]]
            words = words_of(texts)
            yield pd.DataFrame({"rid": number + np.arange(len(pdf)), "doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "place": pdf["place"],
                                "ids": [x.astype(IDS).tobytes() for x in ids_of(texts)], "words": [w.tobytes() for w, _ in words],
                                "times": [n.astype(TIMES).tobytes() for _, n in words]})
            number += len(pdf)

    return keyed.mapInPandas(run, "rid long, doc_id string, held_out boolean, place long, ids binary, words binary, times binary")


def counts_of(rows: DataFrame) -> DataFrame:
    """what (0: word, 1: subword id, 2: document), key and n over the training documents."""

    def run(batches):
        ids, docs = np.zeros(VOCABULARY, dtype=np.int64), 0
        words, times, size = [], [], 0

        def summed():
            nonlocal words, times, size
            keys, n = np.concatenate(words), np.concatenate(times)
            order = np.argsort(keys)
            keys = keys.take(order)
            first = np.append(0, np.flatnonzero(keys[1:] != keys[:-1]) + 1)
            words, times, size = [], [], 0
            return pd.DataFrame({"what": 0, "key": keys.take(first), "n": np.add.reduceat(n.take(order), first, dtype=np.int64)})

        for pdf in batches:
            docs += len(pdf)
            words.append(np.frombuffer(b"".join(pdf["words"]), dtype=WORDS))
            times.append(np.frombuffer(b"".join(pdf["times"]), dtype=TIMES))
            size += len(words[-1])
            ids += np.bincount(np.frombuffer(b"".join(pdf["ids"]), dtype=IDS), minlength=VOCABULARY)
            if size > HELD:
                yield summed()
        if size:
            yield summed()
        at = np.flatnonzero(ids)
        yield pd.DataFrame({"what": 1, "key": at, "n": ids[at]})
        yield pd.DataFrame({"what": [2], "key": [0], "n": [docs]})

    return (rows.where(~F.col("held_out")).select("ids", "words", "times").mapInPandas(run, "what int, key long, n long")
            .groupBy("what", "key").agg(F.sum("n").alias("n")))


# --- the model -------------------------------------------------------------------------------------------------------

class Model:
    """``embed`` (id x WIDTH), ``q k v`` (WIDTH x WIDTH), ``out`` (class x WIDTH), ``bias`` (class), ``near`` (distance);
    ``cls`` (class of each id) and ``share`` (log P(id | class)) are fixed by the counts."""

    NAMES = ("embed", "q", "k", "v", "out", "bias", "near")

    def __init__(self, counts: np.ndarray):
        rng = np.random.Generator(np.random.PCG64(13))
        weight = counts + 0.1
        order = np.argsort(-weight, kind="stable")
        self.cls = np.empty(VOCABULARY, dtype=np.int64)
        self.cls[order[:SINGLE]] = np.arange(SINGLE)
        rest = weight[order[SINGLE:]]
        part = (np.cumsum(rest) - rest / 2) / rest.sum() * (CLASSES - SINGLE)
        self.cls[order[SINGLE:]] = SINGLE + np.minimum(part.astype(np.int64), CLASSES - SINGLE - 1)
        mass = np.bincount(self.cls, weights=weight, minlength=CLASSES)
        self.share = (np.log(weight) - np.log(mass[self.cls])).astype(np.float32)
        small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        self.embed = small(VOCABULARY, WIDTH)
        self.q, self.k, self.v = small(WIDTH, WIDTH), small(WIDTH, WIDTH), small(WIDTH, WIDTH)
        self.out, self.near = small(CLASSES, WIDTH), np.zeros(WINDOW, dtype=np.float32)
        self.bias = np.log(np.maximum(mass, 1e-9) / mass.sum()).astype(np.float32)

    # all trained parameters as rows of WIDTH numbers
    def rows(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).reshape(-1, WIDTH) for n in self.NAMES])

    def take_rows(self, rows: np.ndarray) -> None:
        at = 0
        for n in self.NAMES:
            old = getattr(self, n)
            size = old.size // WIDTH
            setattr(self, n, np.ascontiguousarray(rows[at:at + size].reshape(old.shape), dtype=np.float32))
            at += size


_BACK = np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :]  # distance from query to key
_SEEN = _BACK >= 0
_DISTANCES, _TAKEN = _BACK[_SEEN], np.maximum(_BACK, 0)
_SCALE = np.float32(1 / math.sqrt(WIDTH))
_ONES, _CLASS_ONES = np.ones((WINDOW, 1), dtype=np.float32), np.ones((CLASSES, 1), dtype=np.float32)


class Trainer:
    """Adagrad over batches of windows; ``used`` counts how often each row of the parameters took part."""

    def __init__(self, model: Model, rate: float = RATE):
        self.model, self.rate = model, rate
        self.squares = {n: np.full_like(getattr(model, n), 1e-3) for n in Model.NAMES}
        self.times = np.zeros(VOCABULARY, dtype=np.int64)
        self.tokens = 0

    def _apply(self, name: str, gradient: np.ndarray, rows: np.ndarray | None = None) -> None:
        held, squares = getattr(self.model, name), self.squares[name]
        if rows is None:
            squares += gradient * gradient
            held -= self.rate * gradient / np.sqrt(squares)
            return
        now = squares.take(rows, axis=0)
        now += gradient * gradient
        squares[rows] = now
        held[rows] = held.take(rows, axis=0) - self.rate * gradient / np.sqrt(now)

    def step(self, ids: np.ndarray) -> float:
        """One step on windows (rows of WINDOW + 1 ids, -1 beyond a text's end); mean loss of the classes, in nats."""
        m = self.model
        given, wanted = np.maximum(ids[:, :-1], 0).ravel(), ids[:, 1:].ravel()
        real = np.flatnonzero(wanted >= 0)
        n, many = max(1, len(real)), len(ids)
        target = m.cls[wanted[real]]
        at = real * CLASSES + target
        x = m.embed.take(given, axis=0)
        mix = np.concatenate([m.q * _SCALE, m.k, m.v], axis=1)
        qkv = (x @ mix).reshape(many, WINDOW, 3 * WIDTH)
        q, k, v = qkv[:, :, :WIDTH], qkv[:, :, WIDTH:2 * WIDTH], qkv[:, :, 2 * WIDTH:]
        a = q @ k.transpose(0, 2, 1)
        a += np.where(_SEEN, m.near[_TAKEN], np.float32(-1e9))
        if a.max() > 80:  # far outside trained values
            np.minimum(a, 80, out=a)
        np.exp(a, out=a)
        a /= np.maximum(a @ _ONES, np.float32(1e-30))
        h = (a @ v).reshape(-1, WIDTH)
        h += x
        p = h @ m.out.T
        p += m.bias
        if max(p.max(), -p.min()) > 80:
            np.clip(p, -80, 80, out=p)
        np.exp(p, out=p)
        weight = np.zeros((len(given), 1), dtype=np.float32)
        total = p @ _CLASS_ONES
        weight[real] = 1 / (total[real] * np.float32(n))
        loss = float(np.log(total[real, 0] / p.ravel().take(at)).mean()) if len(real) else 0.0
        p *= weight
        p.ravel()[at] -= np.float32(1 / n)
        g_out, g_bias = p.T @ h, p.sum(axis=0)
        dh = p @ m.out
        moved = np.empty((many, WINDOW, 3 * WIDTH), dtype=np.float32)
        np.matmul(a.transpose(0, 2, 1), dh.reshape(many, WINDOW, WIDTH), out=moved[:, :, 2 * WIDTH:])
        ds = dh.reshape(many, WINDOW, WIDTH) @ v.transpose(0, 2, 1)
        ds *= a
        a *= ds @ _ONES
        ds -= a
        g_near = np.bincount(_DISTANCES, weights=ds.sum(axis=0)[_SEEN], minlength=WINDOW).astype(np.float32)
        np.matmul(ds, k, out=moved[:, :, :WIDTH])
        np.matmul(ds.transpose(0, 2, 1), q, out=moved[:, :, WIDTH:2 * WIDTH])
        moved = moved.reshape(-1, 3 * WIDTH)
        g_mix = x.T @ moved
        dh += moved @ mix.T
        bits = len(given).bit_length()
        order = np.sort((given << bits) + np.arange(len(given)))  # by id, and by place within an id
        names, order = order >> bits, order & ((1 << bits) - 1)
        begins = np.empty(len(names) + 1, dtype=bool)
        begins[0] = begins[-1] = True
        np.not_equal(names[1:], names[:-1], out=begins[1:-1])
        cuts = np.flatnonzero(begins)
        first, times = cuts[:-1], cuts[1:] - cuts[:-1]
        names = names[first]
        self._apply("embed", np.add.reduceat(dh.take(order, axis=0), first, axis=0), names)
        g_q, g_k, g_v = g_mix[:, :WIDTH], g_mix[:, WIDTH:2 * WIDTH], g_mix[:, 2 * WIDTH:]
        for name, gradient in (("q", g_q * _SCALE), ("k", g_k), ("v", g_v), ("out", g_out), ("bias", g_bias), ("near", g_near)):
            self._apply(name, gradient)
        self.times[names] += times
        self.tokens += len(real)
        return loss


def windows_of(ids: np.ndarray) -> np.ndarray:
    """A text's ids after END and before END, in windows of WINDOW steps; each begins with the last id of the one before."""
    many = -(-(len(ids) + 1) // WINDOW)
    padded = np.full(many * WINDOW + 1, -1, dtype=np.int64)
    padded[1:len(ids) + 1] = ids
    padded[0] = padded[len(ids) + 1] = END
    return np.ndarray((many, WINDOW + 1), np.int64, padded, strides=(WINDOW * padded.itemsize, padded.itemsize))


def rounds_of(windows: int) -> list[tuple[int, int]]:
    """Ranges of the documents' places (0 .. PLACES - 1) that the rounds learn from; together they hold every place once."""
    first = min(PLACES, max(1, PLACES * FIT_WINDOWS // max(1, windows)))
    cuts = sorted({0, first, max(first, PLACES // MIDDLE), PLACES})
    return list(zip(cuts, cuts[1:], strict=False))


def learned(rows: DataFrame, model: Model, rate: float, passes: int = 1) -> Model:
    """Every task trains on with its part of ``rows``, all ids of all texts; the rows that changed are averaged by use."""
    held = rows.sparkSession.sparkContext.broadcast(model)
    old = model.rows()

    def trained(batches):
        mine = Model.__new__(Model)
        mine.__dict__.update({k: v.copy() for k, v in held.value.__dict__.items()})
        trainer = Trainer(mine, rate)
        rng = np.random.Generator(np.random.PCG64(17))
        waiting: list[np.ndarray] = []
        size = 0

        def run():
            nonlocal waiting, size
            cut = np.concatenate(waiting)
            for _ in range(passes):
                order = rng.permutation(len(cut))
                for at in range(0, len(cut), BATCH):
                    trainer.step(cut[order[at:at + BATCH]])
            waiting, size = [], 0

        for pdf in batches:
            for ids in numbers(pdf["ids"], IDS):
                cut = windows_of(ids)
                for at in range(0, len(cut), TURN):
                    waiting.append(cut[at:at + TURN])
                    size += len(waiting[-1])
                    if size >= TURN:
                        run()
        if waiting:
            run()
        if trainer.tokens:
            used = np.full(len(old), trainer.tokens, dtype=np.int64)
            used[:VOCABULARY] = trainer.times
            at = np.flatnonzero(used)
            new = (mine.rows()[at] - old[at]).astype(np.float64)
            yield pd.DataFrame({"row": at, "used": used[at], **{f"v{i}": new[:, i] for i in range(WIDTH)}})

    schema = "row int, used long, " + ", ".join(f"v{i} double" for i in range(WIDTH))
    moved = (rows.select("ids").mapInPandas(trained, schema).groupBy("row")
             .agg(*[(F.sum(F.col("used") * F.col(f"v{i}")) / F.sum("used")).alias(f"v{i}") for i in range(WIDTH)])).toPandas()
    new = old.copy()
    new[moved["row"].to_numpy(int)] += moved[[f"v{i}" for i in range(WIDTH)]].to_numpy(np.float32)
    model.take_rows(new)
    return model


class Scorer:
    """log10 probability of texts from their ids, many windows at a time."""

    def __init__(self, model: Model):
        e = model.embed
        scale = np.float32(1 / math.sqrt(WIDTH))
        q, k, v = e @ model.q * scale, e @ model.k, e @ model.v
        self.table = np.ascontiguousarray(np.concatenate([q, k, v, e], axis=1))
        self.out, self.bias, self.mass = np.ascontiguousarray(model.out.T), model.bias, np.exp(model.bias)
        self.cls, self.share = model.cls, model.share
        back = np.arange(STRIDE)[:, None] + STRIDE - np.arange(WINDOW)[None, :]  # queries stand in the second half
        self.near = np.where(back >= 0, model.near[np.clip(back, 0, WINDOW - 1)], np.float32(-60))  # small, and no denormal number after exp
        self.alone = self.near.copy()
        self.alone[:, :STRIDE] = -60  # a text's first window has nothing before it
        norm = lambda x, axis: float(np.sqrt((x * x).sum(axis=axis)).max())
        # what exp can meet; where these bounds are not small enough, arguments are clipped (far outside trained values)
        self.clip = (norm(q, 1) * norm(k, 1) + float(np.abs(model.near).max()) > 80, (norm(v, 1) + norm(e, 1)) * norm(model.out, 1) > 80)
        self.ones = np.ones((WINDOW, 1), dtype=np.float32)

    def _run(self, given: np.ndarray, target: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Natural log probability of each target; ``given`` has one more block of STRIDE ids, in front."""
        n = len(first)
        rows = self.table.take(given, axis=0)
        length, size = rows.strides
        spans = lambda column: np.ndarray(  # noqa: E731  blocks of WINDOW rows that overlap by half
            (n, WINDOW, WIDTH), rows.dtype, rows, column * size, (STRIDE * length, length, size))
        k, v = spans(WIDTH), spans(2 * WIDTH)
        own = rows[STRIDE:]
        a = own[:, :WIDTH].reshape(n, STRIDE, WIDTH) @ k.transpose(0, 2, 1)
        a += self.near
        a[first] += self.alone - self.near
        if self.clip[0]:
            np.clip(a, -80, 80, out=a)
        np.exp(a, out=a)
        h = a @ v
        h /= a @ self.ones
        h = h.reshape(-1, WIDTH)
        h += own[:, 3 * WIDTH:]
        logits = h @ self.out
        if self.clip[1]:
            np.clip(logits, -80, 80, out=logits)
        cls = self.cls.take(target)
        mine = logits.ravel().take(np.arange(0, logits.size, CLASSES) + cls) + self.bias.take(cls)
        np.exp(logits, out=logits)
        return mine - np.log(logits @ self.mass) + self.share.take(target)

    def score(self, ids: list[np.ndarray]) -> np.ndarray:
        part = np.cumsum([len(x) + 1 for x in ids]) // TOGETHER
        cuts = np.flatnonzero(np.diff(part)) + 1 if len(ids) else []
        return np.concatenate([np.empty(0), *(self._score(ids[i:j]) for i, j in zip([0, *cuts], [*cuts, len(ids)], strict=True) if j > i)])

    def _score(self, ids: list[np.ndarray]) -> np.ndarray:
        steps = np.array([len(x) + 1 for x in ids], dtype=np.int64)
        blocks = -(-steps // STRIDE)
        begin = (np.cumsum(blocks) - blocks) * STRIDE
        size = int(blocks.sum()) * STRIDE
        given = np.full(size + STRIDE, END, dtype=np.int64)  # one block in front
        target = np.full(size, -1, dtype=np.int64)
        for x, at in zip(ids, begin.tolist(), strict=True):
            given[STRIDE + at + 1:STRIDE + at + 1 + len(x)] = x
            target[at:at + len(x)] = x
            target[at + len(x)] = END
        first = np.zeros(size // STRIDE, dtype=bool)
        first[begin // STRIDE] = True
        total = np.empty(size)
        for at in range(0, size, CHUNK * STRIDE):
            end = min(at + CHUNK * STRIDE, size)
            wanted = target[at:end]
            found = self._run(given[at:end + STRIDE], np.maximum(wanted, 0), first[at // STRIDE:end // STRIDE])
            total[at:end] = np.where(wanted >= 0, found, 0)
        return np.add.reduceat(total, begin) / math.log(10)


# --- scores ----------------------------------------------------------------------------------------------------------

def _scored(rows: DataFrame, model: Model, heavy: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Per row: rid, doc_id, held_out, n_tokens, score, n_known and base of the heavy words (sorted hashes and their
    weights), and the other words in ``rest`` with ``times``."""
    shared = rows.sparkSession.sparkContext.broadcast((model, *heavy))

    def run(batches):
        model, names, weight = shared.value
        scorer = Scorer(model)
        for pdf in batches:
            base, known, rest, left, n_tokens = [], [], [], [], []
            words, times = (np.frombuffer(b"".join(pdf[name]), dtype=kind) for name, kind in (("words", WORDS), ("times", TIMES)))
            at = np.minimum(np.searchsorted(names, words), max(0, len(names) - 1))
            hit = names[at] == words if len(names) else np.zeros(len(words), dtype=bool)
            tally = np.append(0, np.cumsum(times, dtype=np.int64))
            heavy, light = np.flatnonzero(hit), np.flatnonzero(~hit)
            heavy_tally = np.append(0, np.cumsum(times[heavy], dtype=np.int64))
            weighed = times[heavy] * weight[at[heavy]]
            words, times = words[light], times[light].astype(np.int32)
            cuts = np.append(0, np.cumsum([len(x) for x in pdf["words"]]) // WORDS.itemsize)
            for n, seen, (a, b), (c, d) in zip(np.diff(tally[cuts]).tolist(), np.diff(heavy_tally[np.searchsorted(heavy, cuts)]).tolist(),
                                               itertools.pairwise(np.searchsorted(heavy, cuts).tolist()),
                                               itertools.pairwise(np.searchsorted(light, cuts).tolist()), strict=True):
                n_tokens.append(n + 1)
                known.append(seen)
                base.append(float(weighed[a:b].sum()))
                rest.append(words[c:d])
                left.append(times[c:d])
            yield pd.DataFrame({"rid": pdf["rid"], "doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "n_tokens": n_tokens, "n_known": known,
                                "base": base, "score": scorer.score(numbers(pdf["ids"], IDS)), "rest": rest, "times": left})

    return rows.select("rid", "doc_id", "held_out", "ids", "words", "times").mapInPandas(
        run, "rid long, doc_id string, held_out boolean, n_tokens long, n_known long, base double, score double, rest array<long>, times array<int>")


def fit(rows: DataFrame, id_counts: np.ndarray) -> Model:
    """The model of documents that were ``read``, given the counts of their subword ids; see the module's text."""
    model = Model(id_counts)
    learners = LEARNERS * rows.sparkSession.sparkContext.defaultParallelism
    place = F.pmod("place", F.lit(PLACES))
    for begin, end in rounds_of(int(id_counts.sum()) // WINDOW):
        part = rows.where(~F.col("held_out") & (place >= begin) & (place < end)).select("place", "ids")
        if begin == 0:  # about FIT_WINDOWS windows, however large the input is
            learned(part.repartition(1).sortWithinPartitions("place", "ids"), model, RATE, EPOCHS)
        else:
            learned(part.coalesce(learners), model, RATE / 4)
    return model


def scores(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row; see the module's text."""
    path = path or scratch_path(documents.sparkSession, "attention-scores")
    rows = _stored(read(documents), f"{path}/read")
    counts = _stored(counts_of(rows), f"{path}/counts")
    ids = np.zeros(VOCABULARY, dtype=np.int64)
    for r in counts.where(F.col("what") == 1).collect():  # at most VOCABULARY
        ids[r["key"]] = r["n"]
    n_docs = counts.where(F.col("what") == 2).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ids[END] += n_docs
    counts = counts.where(F.col("what") == 0).select(F.col("key").alias("word"), "n")
    words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, kinds = words["n"] + n_docs, words["v"] + (n_docs > 0)  # the end is a token, and one of the kinds
    floor = math.log10(total + 0.1 * (kinds + 1))
    # each makes up 1 / HEAVY of all tokens, so there are at most HEAVY
    heavy = counts.where(F.col("n") * HEAVY >= total).orderBy("word").toPandas()
    weights = np.log10(heavy["n"].to_numpy(np.float64) + 0.1) - floor
    scored = _stored(_scored(rows, fit(rows, ids), (heavy["word"].to_numpy(np.int64), weights)), f"{path}/scored")
    weighed = (scored.select("rid", F.inline(F.arrays_zip(F.col("rest").alias("word"), F.col("times").alias("times")))).join(counts, "word", "left")
               .select("rid", "times", F.coalesce("n", F.lit(0)).alias("c"))
               .groupBy("rid").agg(F.sum(F.col("times") * (F.log10(F.col("c") + 0.1) - floor)).alias("more"),
                                   F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known")))
    end = math.log10(n_docs + 0.1) - floor
    return scored.drop("rest", "times").join(weighed, "rid", "left").select(
        F.col("doc_id").cast("long").alias("doc_id"), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0)) + int(n_docs > 0)).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        F.round(F.col("base") + F.coalesce("more", F.lit(0.0)) + end, 6).alias("base_score"), F.round("score", 3).alias("score"))


def op13_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(common.documents(spark, sf_dir))
