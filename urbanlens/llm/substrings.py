"""Repeated-substring removal by minimizer sampling and window hashes (operator 5).

Every byte covered by a 200-byte string that also starts elsewhere is removed. This
replaces the difference-cover suffix array: no suffix is sorted and nothing is ranked.
Positions are sampled by content, and windows that share a sample are compared by hash.

1. Sample: in each 200-byte window the 64-byte gram of the smallest hash is its sample
   position. Equal windows have the same sample at the same offset, so a window's bucket
   is its sample's gram. Consecutive windows with one sample form a run; about one run for
   60 to 70 bytes.
2. Counts (``ranks`` below): runs are counted by gram. A gram seen once: its windows are
   not repeated. If all runs of a gram are equal as whole strings (by their hash), all are
   repeated.
3. Ties: grams with runs that differ. Runs equal to another as a whole are repeated;
   the others are compared window by window with one run of each kind in the bucket,
   by their hash at the same offset. A task holds one bucket after the other; buckets of
   many different runs go as single windows through an ordinary aggregate instead.
4. Each document's repeated windows give its removed bytes.

The arithmetic cover (positions modulo a period) would have about six times as many
positions, and the offset at which two suffixes share a sample would depend on where they
stand, so that it could not be a shuffle key (figures in the README).

Strings are compared by 64-bit hashes. A document is known by the hash of id and text.

Defined cases: a null or empty text, or one under 200 bytes, loses nothing; repeated
rows are copies of each other; a null id is kept; an empty table gives an empty result;
other columns are ignored. Texts are read whole, in segments of 4 MB.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import row_key, shared_table, texts
from urbanlens.llm.shingles import mix, powers, splitmix

LENGTH, GRAM = 200, 64
SEGMENT = 4 << 20
BIG_BUCKET = 2000  # different runs; beyond, windows are compared one by one
CHUNK_BYTES = 4 << 20

_BYTES = splitmix(256, 21)
_STEP = np.uint64(0xD1342543DE82EF95)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_POSITION = np.uint64((1 << 32) - 1)


class Hasher:
    """Hashes of substrings from prefix sums; keeps the power tables."""

    def __init__(self):
        self.up, self.down = powers(_STEP, 1 << 16), powers(_BACK, 1 << 16)

    def load(self, raw: np.ndarray) -> None:
        if len(raw) >= len(self.up):
            n = 1 << int(len(raw)).bit_length()
            self.up, self.down = powers(_STEP, n), powers(_BACK, n)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[raw] * self.up[:len(raw)], out=self.sums[1:])

    def of(self, start, length) -> np.ndarray:
        return mix((self.sums[start + length] - self.sums[start]) * self.down[start])


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    n = len(x)
    padded = np.full(-(-n // w) * w, ~np.uint64(0))
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def runs(hasher: Hasher, raw: np.ndarray) -> tuple[np.ndarray, ...]:
    """(gram hash, whole hash, start, windows, offset of the sample) of each run."""
    hasher.load(raw)
    grams = hasher.of(np.arange(len(raw) - GRAM + 1), GRAM)
    order = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
    at = (_sliding_min(order, LENGTH - GRAM + 1) & _POSITION).astype(np.int64)
    start = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    windows = np.diff(np.append(start, len(at)))
    sample = at[start]
    offset = sample - start
    whole = mix(hasher.of(start, windows - 1 + LENGTH) + (windows * 1000 + offset).astype(np.uint64))
    return grams[sample], whole, start, windows, offset


def _pack(start, windows, offset):
    return (start << 16) | (windows << 8) | offset


def _unpack(place):
    return place >> 16, (place >> 8) & 255, place & 255


def _all_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, out, held = Hasher(), [], 0

    def batch():
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 4
        return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in cols], names=["gram", "whole", "key", "place"])

    for b in batches:
        for key, text in zip(b.column(0).to_pylist(), b.column(1)):
            raw = np.frombuffer(text.as_py().encode("utf-8", "surrogatepass"), np.uint8)
            for first in range(0, len(raw) - LENGTH + 1, SEGMENT):
                gram, whole, start, windows, offset = runs(hasher, raw[first:first + SEGMENT + LENGTH - 1])
                out.append((gram, whole, np.full(len(gram), key), _pack(start + first, windows, offset)))
                held += len(gram)
                if held >= 100_000:
                    yield batch()
                    out, held = [], 0
    yield batch()


_WANTED = ("kind string, key long, gram long, place long, need boolean, big boolean, data binary, "
           "spans array<struct<a:long,b:long>>, n_removed long, n_spans long, kept_sha256 string")
_WANTED_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary(),
                 pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])), pa.int64(), pa.int64(), pa.string()]
_WANTED_NAMES = [c.split()[0] for c in _WANTED.split(", ")]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _finished(data: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, str]:
    spans, kept, at = _merged(spans), hashlib.sha256(), 0
    for a, b in spans:
        kept.update(data[at:a])
        at = b
    kept.update(data[at:])
    return sum(b - a for a, b in spans), len(spans), kept.hexdigest()


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document with repeated grams: the runs to compare, and either its result or
    the text that waits for the comparison."""
    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _WANTED_TYPES)] if rows else
                                          [pa.array([], t) for t in _WANTED_TYPES], names=_WANTED_NAMES)

    for b in batches:
        rows, held = [], 0
        for key, text, asked in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
            data, spans, waits = text.as_py().encode("utf-8", "surrogatepass"), [], False
            for r in asked.as_py():
                start, windows, _ = _unpack(r["place"])
                end = start + windows - 1 + LENGTH
                if r["repeated"]:
                    spans.append((start, end))
                else:
                    waits = True
                if r["shown"]:
                    rows.append(("run", key, r["gram"], r["place"], not r["repeated"], r["big"], data[start:end], None, None, None, None))
                    held += end - start
            spans = _merged(spans)
            if waits:
                rows.append(("text", key, None, None, None, None, data, [{"a": x, "b": y} for x, y in spans], None, None, None))
                held += len(data)
            else:
                rows.append(("done", key, None, None, None, None, None, None, *_finished(data, spans)))
            if held >= CHUNK_BYTES:
                yield batch(rows)
                rows, held = [], 0
        yield batch(rows)


def _windows(hasher: Hasher, grams: np.ndarray, places: np.ndarray, data: list[bytes]):
    """(row, window number, key by gram, offset and content) of every window of the runs."""
    _, counts, offsets = _unpack(places)
    hasher.load(np.frombuffer(b"".join(data), np.uint8))
    begins = np.concatenate([[0], np.cumsum([len(d) for d in data])])[:-1]
    row = np.repeat(np.arange(len(data)), counts)
    number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    same = mix(grams.view(np.uint64)[row] + (offsets[row] - number).astype(np.uint64))
    return row, number, mix(hasher.of(begins[row] + number, LENGTH) + same)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by gram: the repeated windows of the runs that need it, as spans."""
    hasher = Hasher()

    def solve(rows):
        grams, places = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
        row, number, key = _windows(hasher, grams, places, [r[4] for r in rows])
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        need = np.array([r[3] for r in rows], bool)
        hit = (counts[inverse] > 1) & need[row]
        row, begin = row[hit], (places >> 16)[row[hit]] + number[hit]
        new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (begin[1:] != begin[:-1] + 1)])) if len(row) else []
        last = np.append(new[1:], len(row)) - 1 if len(row) else []
        keys = np.array([r[0] for r in rows], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[row[new]] if len(row) else [], pa.int64()), pa.array(begin[new] if len(row) else [], pa.int64()),
             pa.array(begin[last] + LENGTH if len(row) else [], pa.int64())], names=["key", "a", "b"])

    rows, held = [], 0
    for b in batches:
        for r in zip(*(b.column(i).to_pylist() for i in range(5))):
            if held >= CHUNK_BYTES and r[1] != rows[-1][1]:
                yield solve(rows)
                rows, held = [], 0
            rows.append(r)
            held += len(r[4])
    if rows:
        yield solve(rows)


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for b in batches:
        for at in range(0, b.num_rows, 1000):
            part = b.slice(at, 1000)
            places = part.column(2).to_numpy(zero_copy_only=False)
            row, number, key = _windows(hasher, part.column(1).to_numpy(zero_copy_only=False), places, part.column(4).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(part.column(0).to_numpy(zero_copy_only=False)[row]),
                 pa.array((places >> 16)[row] + number), pa.array(part.column(3).to_numpy(zero_copy_only=False)[row].astype(bool))],
                names=["window", "key", "a", "need"])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = [_finished(d.as_py(), [(s["a"], s["b"]) for s in [*own.as_py(), *(more.as_py() or ())]])
               for d, own, more in zip(b.column(1), b.column(2), b.column(3))]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
             pa.array([o[2] for o in out], pa.string())], names=["key", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, one row per input row."""
    rows = texts(docs, id_col, text_col).withColumn("key", row_key("doc_id", "text"))
    keyed = rows.select("key", "text")
    found = keyed.filter(F.octet_length("text") >= LENGTH).mapInArrow(_all_runs, "gram long, whole long, key long, place long")

    ranks = shared_table(found.groupBy("gram").agg(F.count("*").alias("n"), F.min("whole").alias("low"), F.max("whole").alias("high"))
                         .filter("n > 1").select("gram", (F.col("low") != F.col("high")).alias("mixed")), "repeat-ranks")
    repeated = shared_table(found.join(ranks, "gram"), "repeat-runs")
    mixed = repeated.filter("mixed")
    kinds = mixed.groupBy("gram", "whole").agg(F.count("*").alias("copies"), F.min(F.struct("key", "place")).alias("first"))
    sizes = kinds.groupBy("gram").agg((F.count("*") > BIG_BUCKET).alias("big"))
    kinds = shared_table(kinds.join(sizes, "gram"), "repeat-kinds")
    tied = mixed.join(kinds, ["gram", "whole"]).select(
        "key", "place", "gram", (F.col("copies") > 1).alias("repeated"),
        (F.struct("key", "place") == F.col("first")).alias("shown"), "big")
    plain = repeated.filter("not mixed").select("key", "place", "gram", F.lit(True).alias("repeated"),
                                                F.lit(False).alias("shown"), F.lit(False).alias("big"))
    asked = plain.unionByName(tied).groupBy("key").agg(
        F.collect_set(F.struct("place", "gram", "repeated", "shown", "big")).alias("asked"))  # at most a document's runs
    state = shared_table(keyed.join(asked, "key").dropDuplicates(["key"]).select("key", "text", "asked")
                         .mapInArrow(_wanted, _WANTED), "repeat-state")

    compared = state.filter("kind = 'run'").select("key", "gram", "place", "need", "data", "big")
    small = (compared.filter("not big").drop("big").repartition("gram").sortWithinPartitions("gram")
             .mapInArrow(_compare, "key long, a long, b long"))
    single = shared_table(compared.filter("big").drop("big").mapInArrow(
        _single_windows, "window long, key long, a long, need boolean"), "repeat-windows")
    twice = single.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window")
    large = single.filter("need").join(twice, "window").select("key", "a", (F.col("a") + LENGTH).alias("b"))
    spans = small.unionByName(large).groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("more"))
    ended = (state.filter("kind = 'text'").select("key", "data", "spans").join(spans, "key", "left")
             .mapInArrow(_finish, "key long, n_removed long, n_spans long, kept_sha256 string"))
    results = ended.unionByName(state.filter("kind = 'done'").select("key", "n_removed", "n_spans", "kept_sha256"))

    base = rows.select("key", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("own"))
    return base.join(results, "key", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "own").alias("kept_sha256"))
