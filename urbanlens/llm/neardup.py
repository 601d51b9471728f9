"""Near-duplicate documents by min-max hashing (operator 9).

A document's set is its distinct word shingles. One hash evaluation per shingle and
permutation gives two signature values, the smallest and the largest hash; both agree
between two sets with a probability equal to their Jaccard similarity. The 2 x 256
values are cut into 64 bands of 8: two sets of similarity s share no band with
probability (1 - s^8)^64, 2e-9 at 0.85 and 8e-6 at 0.8.

1. Equal sets are one class, represented by the smallest id; only representatives go on.
2. A band's members are joined to the smallest of them (a star, not all pairs); the
   components of these candidate edges are clusters.
3. Star edges are confirmed on the full sets; confirmed ones form groups.
4. Inside a cluster of several groups every document outside its largest group is
   compared with the whole cluster, in blocks of hashed documents: a task gets two
   blocks with their sets, counts the intersections as a matrix product and emits a
   spanning forest of the links it finds, never the pairs.
5. The components of all confirmed links, joined back through the classes.

Sets are compared as 64-bit shingle hashes.

Defined cases: a document without words (null, empty, white space) has an empty set and
is linked with nothing; one without an id is its own group (component null, kept true);
repeated rows get the same result each; rows that share an id but not a text are one
document; an empty table gives an empty result; columns other than id and text are
ignored; texts are read whole, whatever their length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import fresh, shared_table, texts
from urbanlens.llm.graph import components
from urbanlens.llm.shingles import Shingler, mix, splitmix

PERMUTATIONS = 256
BAND = 8
BLOCK = 256  # documents of one side of a comparison
_CHUNK = 128


def _signer(permutations: int, band: int):
    times, plus = splitmix(permutations, 7) | np.uint64(1), splitmix(permutations, 8)
    weights, salt = splitmix(band, 9) | np.uint64(1), splitmix(2 * permutations // band, 10)

    def bands(shingles: np.ndarray) -> np.ndarray:
        low = np.full(permutations, ~np.uint64(0))
        high = np.zeros(permutations, np.uint64)
        for at in range(0, len(shingles), _CHUNK):
            h = shingles[at:at + _CHUNK, None] * times + plus
            np.minimum(low, h.min(0), out=low)
            np.maximum(high, h.max(0), out=high)
        values = mix(np.concatenate([low, high])).reshape(-1, band)
        return mix((values * weights).sum(1) + salt).view(np.int64)

    return bands


def _signatures(permutations: int, band: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, sign = Shingler(), _signer(permutations, band)
        for batch in batches:
            sizes, digests, signed = [], [], []
            for text in batch.column(1):
                s = shingle(text.as_py())
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                signed.append(sign(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(signed, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "digest", "bands"])
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingle = Shingler()
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([shingle(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())],
            names=["doc_id", "shingles"])


def _similar(common, n, m, percent: int):
    return 100 * common >= percent * (n + m - common)


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                keep.append(bool(_similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent)))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return run


def _incidence(owners: np.ndarray, columns: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    out = np.zeros(shape, np.float32)
    out[owners, columns] = 1
    return out


def _common(left: list[np.ndarray], right: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of the intersections of each left with each right set."""
    def flat(sets):
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])

    (lv, lo), (rv, ro) = flat(left), flat(right)
    shared = np.intersect1d(lv, rv)
    counts = np.zeros((len(left), len(right)), np.float32)
    if not len(shared):
        return counts
    def kept(values, owners):
        at = np.searchsorted(shared, values)
        ok = (at < len(shared)) & (shared[np.minimum(at, len(shared) - 1)] == values)
        return at[ok], owners[ok]

    (lc, lo), (rc, ro) = kept(lv, lo), kept(rv, ro)
    for first in range(0, len(shared), width):
        l, r = (lc >= first) & (lc < first + width), (rc >= first) & (rc < first + width)
        counts += _incidence(lo[l], lc[l] - first, (len(left), width)) @ _incidence(ro[r], rc[r] - first, (len(right), width)).T
    return counts


def _compare(percent: int):
    """Links between one block of rest documents and one block of the cluster."""
    def run(pdf):
        import pandas as pd

        rest, other = pdf[pdf["rest"]], pdf[~pdf["rest"]]
        links = []
        if len(rest) and len(other):
            left = [np.frombuffer(s, np.uint64) for s in rest["shingles"]]
            right = [np.frombuffer(s, np.uint64) for s in other["shingles"]]
            n, m = np.array([len(s) for s in left])[:, None], np.array([len(s) for s in right])[None]
            a, b = rest["doc_id"].to_numpy(), other["doc_id"].to_numpy()
            hits = np.argwhere(_similar(_common(left, right), n, m, percent) & (a[:, None] != b[None]))
            root: dict[int, int] = {}

            def find(x):
                while root.setdefault(x, x) != x:
                    root[x] = x = root[root[x]]
                return x

            for i, j in hits:
                x, y = find(int(a[i])), find(int(b[j]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    links.append((int(a[i]), int(b[j])))
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")
    return run


def _rest_links(sets: DataFrame, clusters: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Links of the documents outside their cluster's largest group (step 4)."""
    joined = clusters.join(groups, clusters["node"] == groups["node"], "left").select(
        clusters["node"], clusters["component"].alias("cluster"),
        F.coalesce(groups["component"], clusters["node"]).alias("grp"))
    joined = shared_table(joined, "near-groups")
    by_group = joined.groupBy("cluster", "grp").agg(F.count("*").alias("n"))
    shape = (by_group.groupBy("cluster").agg(F.max_by("grp", F.struct("n", "grp")).alias("largest"), F.max("n").alias("most"),
                                             F.sum("n").alias("size")).filter("most < size"))
    blocks = shape.select("cluster", "largest", F.ceil((F.col("size") - F.col("most")) / BLOCK).cast("int").alias("rests"),
                          F.ceil(F.col("size") / BLOCK).cast("int").alias("alls"))
    placed = joined.join(blocks, "cluster").withColumn("h", F.xxhash64("node"))
    def side(rest: bool):
        mine, theirs = ("rests", "alls") if rest else ("alls", "rests")
        own, other = F.pmod("h", F.col(mine)).cast("int"), F.explode(F.sequence(F.lit(0), F.col(theirs) - 1))
        rows = placed.filter(F.col("grp") != F.col("largest")) if rest else placed
        x, y = ("i", "j") if rest else ("j", "i")
        return rows.select("cluster", "node", F.lit(rest).alias("rest"), own.alias(x), other.alias(y))

    units = side(True).unionByName(side(False))
    rows = units.join(sets, units["node"] == sets["doc_id"]).select("cluster", "i", "j", "rest", "doc_id", "shingles")
    return rows.groupBy("cluster", "i", "j").applyInPandas(_compare(percent), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                    permutations: int = PERMUTATIONS, band: int = BAND) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per input row. Documents of a
    Jaccard similarity of ``percent`` / 100 or more are linked; ``component_id`` is the
    smallest id that links reach, ``kept`` whether that is the row's own."""
    rows = texts(docs, id_col, text_col)
    signed = shared_table(rows.mapInArrow(_signatures(permutations, band),
                                          "doc_id long, n_shingles long, digest binary, bands array<long>"), "near-signed")
    known = signed.filter("digest is not null and doc_id is not null")
    classes = shared_table(known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")), "near-classes")

    banded = (known.join(classes, ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id", "digest"])
              .select("doc_id", F.explode("bands").alias("bucket")))
    shared = banded.groupBy("bucket").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    star = shared_table(banded.join(shared, "bucket").filter("doc_id != first").select("first", "doc_id").distinct(), "near-star")
    clusters = shared_table(components(star, "first", "doc_id"), "near-clusters")

    wanted = clusters.select(F.col("node").alias("doc_id")).join(
        classes.select("doc_id", "digest"), "doc_id").select("doc_id")
    sets = shared_table(rows.join(wanted, "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, shingles binary"), "near-sets")

    left = sets.select(F.col("doc_id").alias("first"), F.col("shingles").alias("s"))
    pairs = star.join(sets, "doc_id").join(left, "first").select("first", "doc_id", "s", "shingles")
    confirmed = shared_table(pairs.mapInArrow(_confirm(percent), "first long, doc_id long")
                             .select(F.col("first").alias("a"), F.col("doc_id").alias("b")), "near-confirmed")
    groups = shared_table(components(confirmed, "a", "b"), "near-linked")
    more = shared_table(_rest_links(sets, clusters, groups, percent), "near-more")
    found = components(confirmed.unionByName(more), "a", "b")

    of_class = classes.join(found, classes["doc_id"] == found["node"], "left").select(
        "digest", F.coalesce("component", "doc_id").alias("component"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return signed.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left").select(
        "doc_id", "n_shingles", own.alias("component_id"), (F.col("doc_id").isNull() | (own == F.col("doc_id"))).alias("kept"))


def keep_one(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents whose group has a smaller id; of rows that share an
    id one is kept (rows without an id all stay)."""
    found = shared_table(near_duplicates(docs, percent, id_col, text_col), "near-found")
    name, own = fresh(docs, "_dropped"), F.col(id_col).cast("long")
    dropped = shared_table(found.filter(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct(), "near-dropped")
    repeated = shared_table(found.filter("kept and doc_id is not null").groupBy("doc_id").count().filter("count > 1")
                            .select(F.col("doc_id").alias(name)), "near-repeated")
    out = docs.join(dropped, own == F.col(name), "left_anti")
    if repeated.isEmpty():
        return out
    again = out.join(repeated, own == F.col(name), "left_semi").dropDuplicates([id_col])
    return out.join(repeated, own == F.col(name), "left_anti").unionByName(again)
