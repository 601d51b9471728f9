"""Benchmark decontamination by pigeonhole edit matching (operator 6).

A test item of m characters (normalised: lower case, one space for white space) may
appear in a document with up to k = m // 24 edits. Cut into k + 1 pieces, at least one
piece of such an appearance is unchanged; all pieces of a block of items are found in
one pass by an Aho-Corasick automaton. Around each hit the item is compared with the
document by Myers' bit-parallel distance (a best place in the window, not the whole of
it); it counts if the distance is at most k.

The items are read in blocks of at most about ``BLOCK_BYTES`` of text, a bound that does
not depend on their number; each block is one pass over the documents. If there are
several, the texts a block hits are written as digests before the next block is
collected, so that the driver and a worker hold one block at a time, and the documents
are joined with them by digest; a single block needs no shuffle.

Defined cases: a null or empty text or item matches nothing; items shorter than 24
characters match exactly; items with equal texts all match; repeated rows give equal
results; a null id is kept; without items no document is contaminated; an empty table
gives an empty result; other columns are ignored. Texts are searched whole.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import fresh, shared_table, texts

CHARS_PER_EDIT = 24
BLOCK_BYTES = 4 << 20


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces as (offset, piece), of nearly equal length."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str) -> int:
    """The smallest edit distance between ``pattern`` and a substring of ``text``."""
    m = len(pattern)
    places: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        places[c] |= 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best = m
    for c in text:
        eq = places.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | ~(xh | plus) & full, plus & xh
        score += bool(up & last) - bool(down & last)
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | ~(xv | up) & full, up & xv
        best = min(best, score)
    return best


class Matcher:
    """Finds the items of one block."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick

        by_text: dict[str, list[int]] = defaultdict(list)
        for item_id, text in items:
            if t := normalise(text):
                by_text[t].append(item_id)
        self.items = [(t, len(t) // CHARS_PER_EDIT, sorted(ids)) for t, ids in sorted(by_text.items())]
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (t, edits, _) in enumerate(self.items):
            for offset, piece in pieces(t, edits):
                found[piece].append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()

    def matches(self, text: str | None) -> dict[int, int]:
        """item id -> smallest distance, for the items that appear in the text."""
        text = normalise(text)
        if not text or not self.items:
            return {}
        starts: dict[int, list[int]] = defaultdict(list)
        for end, (length, places) in self.automaton.iter(text):
            for n, offset in places:
                starts[n].append(end + 1 - length - offset)
        out = {}
        for n, hits in starts.items():
            item, edits, ids = self.items[n]
            best = self._distance(item, edits, text, hits)
            if best <= edits:
                out |= dict.fromkeys(ids, best)
        return out

    @staticmethod
    def _distance(item: str, edits: int, text: str, hits: list[int]) -> int:
        if any(h >= 0 and text.startswith(item, h) for h in hits):
            return 0
        best, regions = len(item), []
        for h in sorted(hits):
            a, b = max(0, h - edits), h + len(item) + edits
            if regions and a <= regions[-1][1]:
                regions[-1][1] = b
            else:
                regions.append([a, b])
        for a, b in regions:
            best = min(best, myers(item, text[a:b]))
        return best


def blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items, in blocks of about ``block_bytes`` of text."""
    own, n = _items(items, id_col, text_col), n_blocks(items, id_col, text_col, block_bytes)
    for b in range(n):
        part = own.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) if n > 1 else own
        yield [(r["item_id"], r["text"]) for r in part.collect()]


def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return items.select(items[id_col].cast("long").alias("item_id"), items[text_col].cast("string").alias("text"))


def n_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> int:
    total = _items(items, id_col, text_col).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return 1 + int(total) // block_bytes


def _digest(text_col: str) -> Column:
    return F.sha2(F.col(text_col).cast("binary"), 256)


def _hit_texts(docs: DataFrame, items: DataFrame, block_bytes: int) -> DataFrame:
    """``digest, hits`` of the texts of ``docs`` (a column ``text``) that any item matches, one
    row for each; one block of items after the other."""
    found = None
    for block in blocks(items, block_bytes=block_bytes):
        hits = docs.select(F.lit(0).cast("long").alias("doc_id"), "text", _no_hits().alias("hits"))
        hits = hits.mapInArrow(_add_hits(block), hits.schema).filter(F.size("hits") > 0)
        part = shared_table(hits.select(_digest("text").alias("digest"), "hits"), "hits")
        found = part if found is None else found.unionByName(part)
    found = found.groupBy("digest").agg(F.flatten(F.collect_set("hits")).alias("hits"))
    return shared_table(found, "hits")


def _no_hits() -> Column:
    return F.array().cast("array<struct<item_id:long,distance:int>>")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, contaminated, n_items, item_ids, distance``, one row per document:
    the matching items (ids in ascending order) and the smallest distance."""
    out = texts(docs, id_col, text_col)
    if n_blocks(items, text_col="text", block_bytes=block_bytes) > 1:
        found = _hit_texts(out, items, block_bytes)
        out = out.select("doc_id", _digest("text").alias("digest")).join(found, "digest", "left")
        out = out.select("doc_id", F.coalesce("hits", _no_hits()).alias("hits"))
    else:
        out = out.withColumn("hits", _no_hits())
        out = out.mapInArrow(_add_hits(next(blocks(items, block_bytes=block_bytes))), out.schema)
    ids = F.array_distinct(F.transform("hits", lambda h: h["item_id"]))  # texts of one id may be in several blocks
    return out.select("doc_id", (F.size("hits") > 0).alias("contaminated"), F.size(ids).cast("long").alias("n_items"),
                      F.array_join(F.array_sort(ids).cast("array<string>"), ",").alias("item_ids"),
                      F.array_min(F.transform("hits", lambda h: h["distance"])).alias("distance"))


def _add_hits(block: list[tuple[int, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block)
        for batch in batches:
            hits = [[*old, *({"item_id": i, "distance": d} for i, d in matcher.matches(t.as_py()).items())]
                    for t, old in zip(batch.column(1), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hits, batch.schema.field(2).type)],
                                             schema=batch.schema)
    return run


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` in whose text no item appears."""
    if n_blocks(items, block_bytes=block_bytes) > 1:
        found = _hit_texts(docs.select(F.col(text_col).cast("string").alias("text")), items, block_bytes)
        digest = fresh(docs, "digest")
        found = found.select(F.col("digest").alias(digest))
        return docs.withColumn(digest, _digest(text_col)).join(found, digest, "left_anti").select(docs.columns)
    block = next(blocks(items, block_bytes=block_bytes))
    return docs.mapInArrow(_drop_hits(block, docs.columns.index(text_col)), docs.schema)


def _drop_hits(block: list[tuple[int, str]], at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block)
        for batch in batches:
            yield batch.filter(pa.array([not matcher.matches(t.as_py()) for t in batch.column(at)], pa.bool_()))
    return run
