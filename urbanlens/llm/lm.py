"""Language-model scores of texts by a log-bilinear model (operator 11).

A text's tokens are its words and one end. The model predicts a token's *unit* from the
units of the two tokens before it: the ``WORD_UNITS`` most frequent tokens are units of
their own, every other word belongs to one of ``SUFFIX_UNITS`` units by its last two
bytes. With context vectors R, context matrices C, unit vectors Q and biases b,

    h = R[u1] C1 + R[u2] C2,   P(u | u1, u2) = softmax(Q h + b)[u].

A word that shares its unit has P(unit) (c+1)/(S+1): c is its training count, S the sum of
c+1 over the unit's training words, and the rest is left to words never seen. So the
probabilities of all words, with one unseen word in each shared unit, add up to 1.

1. Training tokens are counted (combined in each slice, then shuffled).
2. Every partition trains a copy of the same first model on all its training texts by
   noise-contrastive estimation: the noise of a step is one sample of the unit
   frequencies, shared by its tokens, so all scores are matrix products in numpy. The
   copies are averaged, weighted by their tokens, in a tree of groups of ``FAN``; one
   model of fixed size reaches the driver.
3. Texts are scored. The normalisers of a slice's distinct contexts are batched matrix
   products over all units. Counts of words with more than one in ``KNOWN`` of all
   training tokens (fewer than ``KNOWN`` words) are looked up on the spot; all other words
   are joined with the counts, where no key can hold more than that share of the rows.

The base score is exact up to the rounding of sums. The model depends on how the table is
divided, as partitions learn side by side. Held-out texts are read in step 3 only.

Memory per task: one slice of texts, the model and the known words.

Defined cases: a null or empty text has one token, its end; a null id is a training row;
repeated rows are learned from as often as they stand there and get the same results;
without training texts every count is 0, all units are equally likely and both scores
follow from the formulas; an empty table gives an empty result; other columns are ignored.
Texts are read whole.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import shared_table, texts
from urbanlens.llm.words import as_text, numbered, slices, utf8

WORD_UNITS = 768
SUFFIX_UNITS = 256
UNITS = WORD_UNITS + SUFFIX_UNITS
START = UNITS  # the context before a text's first token
DIMENSIONS = 16
CONTEXT = 2
NOISE = 64
STEP = 2048  # tokens of a step
CHUNK = 512  # contexts whose normalisers are one matrix product
RATE = 0.1
KNOWN = 500_000
FAN = 64
LEVELS = 4  # of the tree of averages: up to FAN ** LEVELS partitions
END = b" "  # never a word
SLICE_BYTES = 4 << 20
_SHAPES = {"R": (UNITS + 1, DIMENSIONS), "C": (CONTEXT, DIMENSIONS, DIMENSIONS), "Q": (UNITS, DIMENSIONS), "b": (UNITS,)}


def split_words(texts_: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All tokens of the texts, one text after the other, and the number of each text's tokens."""
    tokens, sizes = [], []
    for t in texts_:
        mine = t.lower().split()
        tokens += mine
        tokens.append(END)
        sizes.append(len(mine) + 1)
    return pa.array(tokens, pa.binary()), np.array(sizes, np.int64)


@dataclass
class Vocabulary:
    """What tasks know of the training tokens; everything in it is of bounded size."""

    units: dict[bytes, int]  # of the most frequent tokens
    counts: dict[bytes, int]  # of those, and of all tokens that are frequent enough
    shared: np.ndarray  # S of each shared unit, by its place behind the words
    frequency: np.ndarray  # training tokens of each unit

    def unit(self, word: bytes) -> int:
        own = self.units.get(word)
        return WORD_UNITS + zlib.crc32(word[-2:]) % SUFFIX_UNITS if own is None else own

    def noise(self) -> np.ndarray:
        return (self.frequency + 1) / (self.frequency + 1).sum()


def contexts(units: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The units before each token, the nearest first."""
    place = np.arange(len(units)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.full((len(units), CONTEXT), START, np.int64)
    for back in range(1, CONTEXT + 1):
        at = np.flatnonzero(place >= back)
        out[at, back - 1] = units[at - back]
    return out


class Model:
    def __init__(self, noise: np.ndarray):
        rng = np.random.default_rng(11)
        self.noise = noise
        self.log_noise = np.log(noise).astype(np.float32)
        self.R = rng.normal(0, 0.1, _SHAPES["R"]).astype(np.float32)
        self.C = np.stack([np.eye(DIMENSIONS, dtype=np.float32)] * CONTEXT)
        self.Q = rng.normal(0, 0.01, _SHAPES["Q"]).astype(np.float32)
        self.b = self.log_noise.copy()

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in _SHAPES])

    def load(self, values: np.ndarray) -> Model:
        at = 0
        for name, shape in _SHAPES.items():
            size = math.prod(shape)
            setattr(self, name, np.asarray(values[at:at + size], np.float32).reshape(shape))
            at += size
        return self

    def hidden(self, ctx: np.ndarray) -> np.ndarray:
        return sum(self.R[ctx[:, j]] @ self.C[j] for j in range(CONTEXT))

    def log_probability(self, ctx: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Natural logarithm of P(unit | context), normalised over all units."""
        codes = ctx @ ((UNITS + 1) ** np.arange(CONTEXT))
        keys, of = _distinct(codes, (UNITS + 1) ** CONTEXT)
        h = self.hidden(np.stack([keys // (UNITS + 1) ** j % (UNITS + 1) for j in range(CONTEXT)], 1))
        total, scores = np.empty(len(keys), np.float32), np.empty((CHUNK, UNITS), np.float32)
        for at in range(0, len(keys), CHUNK):
            part = scores[:len(h[at:at + CHUNK])]
            np.matmul(h[at:at + CHUNK], self.Q.T, out=part)
            part += self.b
            top = part.max(1)
            part -= top[:, None]
            total[at:at + CHUNK] = top + np.log(np.exp(part, out=part).sum(1))
        own = np.empty(len(units), np.float32)
        for at in range(0, len(units), STEP):
            u = units[at:at + STEP]
            own[at:at + STEP] = np.einsum("ij,ij->i", h[of[at:at + STEP]], self.Q[u]) + self.b[u]
        return own.astype(np.float64) - total[of]


def _distinct(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes below ``size``, and each code's place among them."""
    seen = np.zeros(size, bool)
    seen[codes] = True
    keys = np.flatnonzero(seen)
    place = np.empty(size, np.int32)
    place[keys] = np.arange(len(keys), dtype=np.int32)
    return keys, place[codes]


def _by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows with the sums of their values."""
    order = np.argsort(rows.astype(np.int16), kind="stable")  # units fit; sorted by counting
    rows = rows[order]
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    return rows[starts], np.add.reduceat(values[order], starts, axis=0)


class Trainer:
    """Noise-contrastive estimation with a rate for each parameter that falls with its gradients."""

    def __init__(self, model: Model, seed: int):
        self.m, self.rng = model, np.random.default_rng(seed)
        self.seen = {n: np.full(s, 1.0, np.float32) for n, s in _SHAPES.items()}
        self.tokens = 0

    def _add(self, name: str, at, gradient: np.ndarray) -> None:
        seen = self.seen[name]
        seen[at] += gradient * gradient
        getattr(self.m, name)[at] += RATE * gradient / np.sqrt(seen[at])

    def step(self, ctx: np.ndarray, units: np.ndarray) -> None:
        m = self.m
        noise = self.rng.choice(UNITS, NOISE, p=m.noise)
        vectors = [m.R[ctx[:, j]] for j in range(CONTEXT)]
        h = sum(v @ m.C[j] for j, v in enumerate(vectors))
        q = m.Q[units]
        shift = math.log(NOISE)
        true = np.einsum("ij,ij->i", h, q) + m.b[units] - m.log_noise[units] - shift
        false = h @ m.Q[noise].T + (m.b[noise] - m.log_noise[noise] - shift)
        true, false = 1 / (1 + np.exp(np.clip(true, -30, 30))), -1 / (1 + np.exp(np.clip(-false, -30, 30)))
        back = true[:, None] * q + false @ m.Q[noise]
        own = np.empty((len(units) + NOISE, DIMENSIONS + 1), np.float32)
        np.multiply(true[:, None], h, out=own[:len(units), :-1])
        np.matmul(false.T, h, out=own[len(units):, :-1])
        own[:len(units), -1], own[len(units):, -1] = true, false.sum(0)
        rows, own = _by_row(np.concatenate([units, noise]), own)
        self._add("Q", rows, own[:, :-1])
        self._add("b", rows, own[:, -1])
        rows, own = _by_row(ctx.T.ravel(), np.concatenate([back @ m.C[j].T for j in range(CONTEXT)]))
        self._add("R", rows, own)
        self._add("C", slice(None), np.stack([v.T @ back for v in vectors]))

    def learn(self, ctx: np.ndarray, units: np.ndarray) -> None:
        order = self.rng.permutation(len(units))
        for at in range(0, len(order), STEP):
            part = order[at:at + STEP]
            self.step(ctx[part], units[part])
        self.tokens += len(units)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = utf8(batch.column(0))
        for s in slices(values, SLICE_BYTES):
            words, ids = numbered(split_words(values[s])[0], END)
            yield pa.RecordBatch.from_arrays([as_text(words), pa.array(np.bincount(ids, minlength=len(words)))], names=["word", "c"])


def _taught(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, part = None, 0
        for batch in batches:
            values = utf8(batch.column(1))
            if trainer is None and values:
                part = batch.column(0)[0].as_py()
                trainer = Trainer(Model(vocabulary.noise()), part)
            for s in slices(values, SLICE_BYTES):
                tokens, sizes = split_words(values[s])
                words, ids = numbered(tokens, END)
                units = np.array([vocabulary.unit(w) for w in words], np.int64)[ids]
                trainer.learn(contexts(units, sizes), units)
        if trainer is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([trainer.tokens], pa.int64()), pa.array([trainer.m.flat()], pa.list_(pa.float32()))],
                names=["part", "tokens", "model"])
    return run


def _mean(table: pa.Table) -> pa.Table:
    table = table.sort_by("part")
    tokens = table.column("tokens").to_numpy()
    total = np.zeros(sum(map(math.prod, _SHAPES.values())))
    for weight, model in zip(tokens, table.column("model")):
        total += weight * model.values.to_numpy()
    return pa.table({"part": pa.array([table.column("part")[0].as_py() // FAN], pa.int64()), "tokens": pa.array([int(tokens.sum())], pa.int64()),
                     "model": pa.array([(total / tokens.sum()).astype(np.float32)], pa.list_(pa.float32()))})


def train(training: DataFrame, vocabulary: Vocabulary) -> Model:
    """One pass over all training texts, a copy for each partition; their mean."""
    schema = "part long, tokens long, model array<float>"
    copies = training.select(F.spark_partition_id().cast("long").alias("part"), "text").mapInArrow(_taught(vocabulary), schema)
    for _ in range(LEVELS):
        copies = copies.groupBy(F.floor(F.col("part") / FAN).alias("to")).applyInArrow(_mean, schema)
    model = Model(vocabulary.noise())
    rows = copies.collect()
    if rows:
        return model.load(np.array(rows[0]["model"], np.float32))
    model.Q[:] = 0  # nothing learned: the biases alone
    return model


def _bucket(word: str) -> Column:
    last = F.substring(F.encode(F.col(word), "utf-8"), -2, 2)
    return (F.crc32(last) % SUFFIX_UNITS).cast("int")


def vocabulary_of(words: DataFrame, n_tokens: int) -> Vocabulary:
    """From the written counts ``word, c``: at most ``KNOWN`` + ``WORD_UNITS`` words are collected."""
    first = [(r["word"].encode(), r["c"]) for r in words.orderBy(F.desc("c"), "word").limit(WORD_UNITS).collect()]
    units = {w: i for i, (w, _) in enumerate(first)}
    units.setdefault(END, WORD_UNITS - 1)  # without training texts
    known = {r["word"].encode(): r["c"] for r in words.filter(F.col("c") * KNOWN > n_tokens).collect()}
    frequency, shared = np.zeros(UNITS), np.zeros(SUFFIX_UNITS)
    sums = words.groupBy(_bucket("word").alias("u")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
    for r in sums:
        frequency[WORD_UNITS + r["u"]], shared[r["u"]] = r["c"], r["c"] + r["n"]
    for w, c in first:  # they are units of their own
        u = zlib.crc32(w[-2:]) % SUFFIX_UNITS
        frequency[units[w]] = c
        frequency[WORD_UNITS + u] -= c
        shared[u] -= c + 1
    return Vocabulary(units, known | dict(first), shared, frequency)


def _scored(vocabulary: Vocabulary, flat: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(vocabulary.noise()).load(flat)
        log_shared = np.log10(vocabulary.shared + 1)
        for batch in batches:
            values = utf8(batch.column(2))
            for s in slices(values, SLICE_BYTES):
                tokens, sizes = split_words(values[s])
                words, ids = numbered(tokens, END)
                count = np.array([vocabulary.counts.get(w, -1) for w in words], np.int64)
                unit = np.array([vocabulary.unit(w) for w in words], np.int64)
                own = np.array([w in vocabulary.units for w in words], bool)
                log_count = np.log10(np.maximum(count, 0) + 1.0)
                inside = np.where(own, 0.0, log_count - log_shared[np.maximum(unit - WORD_UNITS, 0)])
                units = unit[ids]
                score = model.log_probability(contexts(units, sizes), units) / math.log(10) + inside[ids]
                text_of = np.repeat(np.arange(len(sizes)), sizes)
                rare = count[ids] < 0

                def summed(of: np.ndarray) -> np.ndarray:
                    return np.bincount(text_of, of, len(sizes))

                n_rare = summed(rare).astype(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n_rare)], pa.int32()), as_text(words).take(pa.array(ids[rare])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[s], batch.column(1)[s], pa.array(sizes), pa.array(summed(count[ids] > 0).astype(np.int64)),
                     pa.array(summed(log_count[ids])), pa.array(summed(score)), lists],
                    names=["rid", "doc_id", "n_tokens", "n_known", "log_counts", "score", "rare"])
    return run


def score(docs: DataFrame, in_training: Callable[[Column], Column], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``; the model learns
    from the rows whose id fulfils ``in_training`` (a null id, or a null answer, counts as one)."""
    own = texts(docs, id_col, text_col)
    learned = F.coalesce(in_training(F.col("doc_id")), F.lit(True))
    training = own.filter(learned).select("text")
    words = shared_table(training.mapInArrow(_counted, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))
                         .filter("c > 0"), "counts")
    n_words, n_tokens = words.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    vocabulary = vocabulary_of(words, n_tokens)
    model = train(training, vocabulary)
    scored = shared_table(
        own.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text").mapInArrow(
            _scored(vocabulary, model.flat()),
            "rid long, doc_id long, n_tokens long, n_known long, log_counts double, score double, rare array<string>"), "scores")
    rare = (scored.select("rid", F.explode("rare").alias("word")).join(words.filter(F.col("c") * KNOWN <= n_tokens), "word")
            .groupBy("rid").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("c") + 1)).alias("logs")))
    logs = F.coalesce("logs", F.lit(0.0))
    return scored.drop("rare").join(rare, "rid", "left").select(
        "doc_id", (~learned).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + logs - F.col("n_tokens") * math.log10(n_tokens + n_words + 1)).alias("base_score"),
        (F.col("score") + logs).alias("score"))


def sevenths(doc_id: Column) -> Column:
    """Training rows of the query: every row but those of one remainder of seven."""
    return F.crc32(doc_id.cast("string")) % 7 != 2
