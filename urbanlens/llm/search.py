"""Ranked lexical search by pipelined term partitioning (operator 12).

The index is divided by terms among owners; bundles of items pass from owner to owner,
each of which adds its terms' contributions to the accumulators that travel along.

1. Documents are cut into terms; the postings of terms that some item has are written,
   and, under the empty term, each document's number of terms.
2. Document frequencies give each term its weight, an upper bound of its contributions
   and its owner: rare terms belong to the first owner, frequent ones to the last, so few
   accumulators travel.
3. The documents are dealt to shards of bounded size. An owner's stage is a cogroup, by
   shard and bundle, of the bundles with the owner's postings. Accumulators are sparse:
   (document, integer score) pairs of each item. One that cannot reach the ten best of
   its shard any more, even with the upper bounds of all later owners, is dropped: ten
   documents of that shard are certain to beat it, so the result does not change.
4. After the last owner each shard keeps its best documents of an item, and the best of
   all shards are selected with limits before the shuffle.

Memory per task: one shard's postings for one bundle and one owner (at most
``SHARD_DOCS`` x the bundle's terms), and one dense row of scores. Nothing depends on how
frequent a term is or on how many items there are; items are never collected.

Defined cases: a null text has no terms and is no document; an item without terms, or
whose terms no document has, has no rows; repeated rows are documents (or items) of
their own, repeated terms of an item count each time; equal scores rank by ascending id,
a null id last, rows of one id in any order; empty tables give an empty result; other
columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanlens.llm.common import shared_table
from urbanlens.llm.words import as_text, translation, utf8

SHARD_DOCS = 4096
BUNDLE_ITEMS = 256
# each owner's terms stand in at most this share of the documents
OWNERS = (1 / 64, 1 / 8, 1.0)
LAST = len(OWNERS) - 1

_ALNUM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_TABLE = translation({bytes(b for b in range(128) if b not in _ALNUM): b" "})
_ROWS = 1 << 16

LISTS = ("tids", "weights", "caps", "owners", "docs", "ids", "scores")
STATE = "shard long, bundle long, iid long, " + ", ".join(f"{c} array<long>" for c in LISTS)
NO_ID = (1 << 63) - 1  # stands for a null id, whose rows have a negative ``rid``


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct term of a row's text, and one under the empty term; no row
    where there is none. ``n`` is the number of all terms of the row."""
    def table():
        rows = pa.array(np.repeat(np.array(at, np.int64), sizes))
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(np.repeat(np.array(totals, np.int64), sizes)),
             as_text(terms), pa.array(counts, pa.int64())], names=["rid", "id", "n", "term", "tf"])

    for batch in batches:
        at, totals, terms, counts, sizes = [], [], [], [], []
        for i, text in enumerate(utf8(batch.column(2))):
            words = text.translate(_TABLE).split(b" ")
            found = Counter(words)
            n = len(words) - found.pop(b"", 0)
            if not n:
                continue
            at.append(i)
            totals.append(n)
            sizes.append(len(found) + 1)
            terms.append(b"")
            counts.append(1)
            terms += found.keys()
            counts += found.values()
            if len(terms) >= _ROWS:
                yield table()
                at, totals, terms, counts, sizes = [], [], [], [], []
        if at:
            yield table()


def _term_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rid = F.monotonically_increasing_id()
    own = df.select(F.when(df[id_col].isNull(), -1 - rid).otherwise(rid).alias("rid"),
                    F.coalesce(df[id_col].cast("long"), F.lit(NO_ID)).alias("id"),
                    F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"))
    return own.mapInArrow(_terms, "rid long, id long, n long, term string, tf long")


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column as views of one array."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    values, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
    return np.split(values, (ends - ends[0])[1:-1]) if len(lists) else []


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *values])))


def _stage(owner: int, top: int):
    """One owner's cogroup: its postings are added to the accumulators of every item."""
    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        rid, ids, tid, part = (postings.column(c).to_numpy() for c in ("rid", "id", "tid", "part"))
        tids, weights, caps, owners, had, had_ids, had_scores = (_arrays(bundles.column(c)) for c in LISTS)
        docs, first = np.unique(np.concatenate([rid, *had]), return_index=True)
        doc_ids = np.concatenate([ids, *had_ids])[first]
        order = np.argsort(tid, kind="stable")
        tid, part, place = tid[order], part[order], np.searchsorted(docs, rid)[order]
        hits, scores = [], []
        for i in range(bundles.num_rows):
            score = np.zeros(len(docs), np.int64)
            score[np.searchsorted(docs, had[i])] = had_scores[i]
            mine = owners[i] == owner
            starts, ends = np.searchsorted(tid, tids[i][mine]), np.searchsorted(tid, tids[i][mine], "right")
            for s, e, w in zip(starts.tolist(), ends.tolist(), weights[i][mine].tolist()):
                score[place[s:e]] += w * part[s:e]  # a document stands once in a term's postings
            later = int((weights[i] * caps[i])[owners[i] > owner].sum())
            hit = np.flatnonzero(score)
            if len(hit) > top:
                least = np.partition(score[hit], len(hit) - top)[len(hit) - top]
                hit = hit[score[hit] + later >= least]
            if owner == LAST:
                hit = hit[np.lexsort((docs[hit] < 0, doc_ids[hit], -score[hit]))[:top]]
            hits.append(hit)
            scores.append(score[hit])
        keep = {c: bundles.column(c) for c in ("shard", "bundle", "iid", *LISTS[:4])}
        return pa.table(keep | {"docs": _lists([docs[h] for h in hits]), "ids": _lists([doc_ids[h] for h in hits]),
                                "scores": _lists(scores)})
    return run


def search(docs: DataFrame, items: DataFrame, top: int = 10, shard_docs: int = SHARD_DOCS, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item."""
    asked = shared_table(_term_rows(items, item_col, item_text_col), "asked")
    no_term = docs.sparkSession.range(1).select(F.lit("").alias("term"))
    vocabulary = shared_table(asked.select("term").union(no_term).distinct()
                              .select("term", F.monotonically_increasing_id().alias("tid")), "terms")
    # the rows of the empty term are the documents
    found = shared_table(_term_rows(docs, id_col, text_col).join(vocabulary, "term").drop("term"), "postings")
    empty = F.col("tid") == vocabulary.filter("term = ''").first()["tid"]
    n_docs, n_terms = found.filter(empty).agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_items = asked.filter("term = ''").count()
    n_shards, n_bundles = max(1, math.ceil(n_docs / shard_docs)), max(1, math.ceil(n_items / BUNDLE_ITEMS))

    size = f"(25L + (75L * n * {n_docs}L) div {max(1, n_terms)}L)"
    postings = found.filter(~empty).select(
        "rid", "id", "tid", F.expr(f"(1000000000L * tf) div (1000L * tf + 8L * {size})").alias("part"),
        F.pmod(F.xxhash64("rid"), F.lit(n_shards)).alias("shard"))
    df = F.col("df")
    owner = F.coalesce(*[F.when(df <= share * n_docs, F.lit(i).cast("long")) for i, share in enumerate(OWNERS)])
    weighed = postings.groupBy("tid").agg(F.count("*").alias("df"), F.max("part").alias("cap")).select(
        "tid", F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * df + 1))).alias("w"), "cap", owner.alias("owner"))
    parts = shared_table(
        asked.join(vocabulary.filter("term <> ''"), "term").join(weighed, "tid")
        .select(F.pmod(F.xxhash64("rid"), F.lit(n_bundles)).alias("bundle"), F.col("rid").alias("iid"), F.col("id").alias("item"),
                "tid", (F.col("w") * F.col("tf")).alias("weight"), "cap", "owner"), "items")

    bundles = parts.groupBy("bundle", "iid").agg(F.collect_list(F.struct("tid", "weight", "cap", "owner")).alias("t"))
    none = F.array().cast("array<long>")
    state = bundles.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))).alias("shard"), "bundle", "iid",
                           F.col("t.tid").alias("tids"), F.col("t.weight").alias("weights"), F.col("t.cap").alias("caps"),
                           F.col("t.owner").alias("owners"), none.alias("docs"), none.alias("ids"), none.alias("scores"))
    for stage in range(len(OWNERS)):
        routes = parts.filter(F.col("owner") == stage).select("tid", F.col("bundle").alias("bundle")).distinct()
        mine = postings.join(routes, "tid")
        state = state.groupBy("shard", "bundle").cogroup(mine.groupBy("shard", "bundle")).applyInArrow(_stage(stage, top), STATE)

    best = state.select("iid", F.explode(F.arrays_zip("docs", "ids", "scores")).alias("d")).select("iid", "d.*")
    order = Window.partitionBy("iid").orderBy(F.desc("scores"), "ids", F.col("docs") < 0, "docs")
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    named = parts.select("iid", "item").distinct()
    return best.join(named, "iid").select(
        F.when(F.col("iid") >= 0, F.col("item")).alias("item_id"), "rank",
        F.when(F.col("docs") >= 0, F.col("ids")).alias("doc_id"), F.col("scores").alias("score"))
