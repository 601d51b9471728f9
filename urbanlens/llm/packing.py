"""Sequence packing with a bounded number of open windows (operator 2).

Each partition tokenizes its documents and packs them in one pass: a document's tokens
(and the closing end id) fill whole sequences first; the rest, shorter than a sequence,
goes to the open window whose free space fits it best. At most ``open_windows`` windows
are open; when none fits and no more may be opened, the fullest is emitted. A partition's
windows that are still open at its end are leftovers: their pieces are merged, longest
first, in a second pass over groups of partitions.

Memory per task: one Arrow batch, ``open_windows`` piece lists and a bounded token cache.

Defined cases: a null or empty text is the end id alone; repeated rows are packed each
as a document of its own; a null id stays null; an empty table gives no pieces; columns
other than id and text are ignored; texts are tokenized whole, whatever their length.

Token ids are those of the given byte-level BPE vocabulary. The vocabulary is read as
ranks, which gives the same ids several times faster than the JSON form; a text is cut
before each single space followed by other than white space, where no token can reach
across, so that the ids of repeated words come from a cache. A run of ``LONG_RUN`` or more
white-space characters overflows the stack of that reader's pattern engine, so it is split
off and merged as the one pre-token it is. Tests compare the ids with the ``tokenizers``
library.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import n_partitions, shared_table, texts

MAX_TOKENS = 1024
OPEN_WINDOWS = 128
CACHE_WORDS = 300_000
LEFTOVERS_PER_GROUP = 4096

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "part int, window long, offset long, left_over boolean")

#: Fixed value: the pre-token pattern of the vocabulary.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Fixed value: the vocabulary's one special token and its id.
SPECIAL = ("<|endoftext|>", 50256)
_CUT = re.compile(r" (?=[^\s\x1c-\x1f])")
#: White space of the pattern (Python's has four control characters more) in runs too long for its engine.
LONG_RUN = 10_000
_LONG = re.compile(rf"(?<![^\S\x1c-\x1f])[^\S\x1c-\x1f]{{{LONG_RUN},}}")


def tokenizer(ranks_path: str) -> Callable[[str], bytes]:
    """text -> its ids as little-endian unsigned 32-bit integers."""
    import numpy as np
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    bpe = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks,
                            special_tokens=dict([SPECIAL]))
    cache: dict[str, bytes] = {}
    special = SPECIAL[1].to_bytes(4, "little")

    def of(text: str) -> bytes:
        ids = bpe.encode(text, allowed_special="all") if SPECIAL[0] in text else bpe.encode_ordinary(text)
        return np.asarray(ids, "<u4").tobytes()

    def with_long_runs(text: str) -> bytes:
        """The pattern takes a run whole at the end, else all but its last character, which
        goes with what follows; no token before the run reaches into it."""
        out, at = [], 0
        for run in _LONG.finditer(text):
            end = run.end() - (run.end() < len(text))
            out.append(encode(text[at:run.start()]))
            out.append(np.asarray(bpe._encode_single_piece(text[run.start():end]), "<u4").tobytes())
            at = end
        return b"".join([*out, encode(text[at:])])

    def encode(text: str) -> bytes:
        if not text:
            return b""
        # a long run covers one of these places
        long = len(text) >= LONG_RUN and not text[::LONG_RUN].isalnum() and _LONG.search(text)
        if SPECIAL[0] in text:
            if long:
                return special.join(map(encode, text.split(SPECIAL[0])))
            return of(text)
        if long:
            return with_long_runs(text)
        first, *words = text.split(" ") if "  " not in text and not _odd(text) else _CUT.split(text)
        out = [of(first)] if first else []
        get = cache.get
        for w in words:
            ids = get(w)
            if ids is None:
                if len(cache) >= CACHE_WORDS:
                    cache.clear()
                ids = of(" " + w)
                if len(w) < 64:
                    cache[w] = ids
            out.append(ids)
        return b"".join(out)

    return encode


def _odd(text: str) -> bool:
    """Whether a space stands before other white space or at the end."""
    return text[-1] == " " or _BEFORE_SPACE.search(text) is not None


_BEFORE_SPACE = re.compile(r" [\s\x1c-\x1f]")


class _Windows:
    """At most ``limit`` open windows, ordered by free space."""

    def __init__(self, limit: int, size: int):
        self.limit, self.size, self.free, self.next = limit, size, [], 0  # free: sorted (free, -window)
        self.pieces: dict[int, list] = {}

    def place(self, piece: tuple, cut: Callable | None = None) -> list:
        """Add a piece (doc, start, length, crc, doc tokens); returns the finished rows.

        When it fits in no open window and no more may be opened, the fullest is emitted,
        its free space first filled with the piece's head if ``cut`` can split it."""
        done, length = [], piece[2]
        at = bisect_left(self.free, (length, -1 << 62))
        if at < len(self.free):
            free, key = self.free.pop(at)
        else:
            if len(self.free) >= self.limit:
                free, key = self.free.pop(0)
                done = self.pieces.pop(-key)
                if cut:
                    head, piece = cut(piece, free)
                    done.append((*head, -key, self.size - free))
                    length = piece[2]
            free, key = self.size, -self.next
            self.pieces[self.next] = []
            self.next += 1
        self.pieces[-key].append((*piece, -key, self.size - free))
        if free == length:
            done = done + self.pieces.pop(-key)
        else:
            insort(self.free, (free - length, key))
        return done


def _pack_partition(ranks_path: str, size: int, end_id: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, end, part = tokenizer(ranks_path), end_id.to_bytes(4, "little"), TaskContext.get().partitionId()
        windows, rows = _Windows(limit, size), []
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + end
                n, at = len(ids) // 4, 0
                while n - at >= size:
                    rows.append((doc, at, size, zlib.crc32(ids[4 * at:4 * (at + size)]), n, windows.next, 0, part, False))
                    windows.next += 1
                    at += size
                if at < n:
                    def piece(start, length, doc=doc, ids=ids, n=n):
                        return doc, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), n

                    done = windows.place(piece(at, n - at), lambda p, k, piece=piece: (piece(p[1], k), piece(p[1] + k, p[2] - k)))
                    rows += [(*r, part, False) for r in done]
                if len(rows) >= 20_000:
                    yield _batch(rows)
                    rows = []
        rows += [(*r, part, True) for w in windows.pieces.values() for r in w]
        yield _batch(rows)
    return run


_FIELDS = (("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
           ("doc_tokens", pa.int64()), ("window", pa.int64()), ("offset", pa.int64()), ("part", pa.int32()),
           ("left_over", pa.bool_()))
_ORDER = [f.split()[0] for f in PIECES.split(", ")]


def _batch(rows: list) -> pa.RecordBatch:
    columns = {n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(_FIELDS)}
    return pa.RecordBatch.from_arrays([columns[n] for n in _ORDER], names=_ORDER)


def _merge_group(size: int):
    """Merge the leftover pieces of one group: longest first, best fit."""
    def run(pdf):
        import pandas as pd

        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        pdf = pdf.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        windows, rows = _Windows(len(pdf), size), []
        docs = [None if pd.isna(d) else int(d) for d in pdf["doc_id"]]
        for piece in zip(docs, *(pdf[n].tolist() for n in names[1:])):
            rows += windows.place(piece)
        rows += [r for w in windows.pieces.values() for r in w]
        out = pd.DataFrame(rows, columns=[*names, "window", "offset"]).astype({"doc_id": "Int64"})
        out["part"], out["left_over"] = int(pdf["grp"].iloc[0]), True
        return out[_ORDER]
    return run


def pack(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
         max_tokens: int = MAX_TOKENS, end_id: int = 0, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``sequence_id`` is unique: windows emitted while packing have even high parts (the
    partition), merged ones odd (the group)."""
    spark = docs.sparkSession
    packed = shared_table(
        texts(docs, id_col, text_col).mapInArrow(_pack_partition(ranks_path, max_tokens, end_id, open_windows), PIECES),
        "packed")
    left = packed.filter("left_over")
    # leftovers number at most open_windows for each partition; groups keep their merge bounded
    per_group = max(1, LEFTOVERS_PER_GROUP // open_windows)
    grouped = left.withColumn("grp", F.floor(F.col("part") / per_group).cast("int"))
    merged = grouped.groupBy("grp").applyInPandas(_merge_group(max_tokens), PIECES)

    def out(df: DataFrame, odd: int) -> DataFrame:
        high = F.shiftleft(F.col("part").cast("long") * 2 + odd, 36)
        return df.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                         (high + F.col("window")).alias("sequence_id"), "offset")

    return out(packed.filter(~F.col("left_over")), 0).unionByName(out(merged, 1))
