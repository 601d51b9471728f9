"""Phrase collocations by vertical partitioning of suffixes (operator 13).

Every word of a piece starts a suffix, cut to the length of the longest phrase. Counting
all phrases is building the tree of these suffixes; its leaves' totals give the count of
every node above them. The tree is cut vertically, so that each part fits in memory:

1. The frequency of each first word is counted. A word of more suffixes than the memory
   budget is too frequent for one part and is replaced by its two-word prefixes, and those
   that are still too frequent by their three-word ones (single leaves). A pair can only
   be too frequent if both of its words are: such pairs are counted by a second pass. What
   was replaced takes its count from these passes.
2. Prefixes are dealt to as many groups as the budget asks for, and each slice of texts
   sends a group its distinct suffixes with their numbers, so copies and repeated
   passages are added up before the shuffle.
3. Each group builds the subtrees of its prefixes on its own, from one sorted array of
   suffixes for each language, and emits the nodes that are frequent enough.

All parts of a frequent phrase are frequent, so the emitted nodes hold every count that
a score needs. The list of replaced prefixes is the only thing that passes through the
driver: at most words / budget entries for each of two lengths.

Memory per task: one slice, or one group of about ``budget`` suffixes (a prefix of up to as many, and others).

Defined cases: a null or empty text has no words; a null lang is ``und``; ids are not
read, so repeated rows and rows without an id count once each; ties of a score end at the
smaller cut and then, in the ranking, at the larger count and the smaller phrase in byte
order; an empty table gives an empty result; other columns are ignored. Texts are read
whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlens.llm.common import n_partitions, shared_table
from urbanlens.llm.words import as_text, cut, numbered, slices, translation, utf8

PIECE = b"\n"  # stands for every separator of pieces; never part of a word
_TABLE = translation({b".,;:!?\n\x0b\x0c\r": PIECE, b"\t": b" "})
SLICE_BYTES = 4 << 20
GROUP_SUFFIXES = 500_000  # memory budget of a group: about 300 bytes a suffix

# prefixes replaced by longer ones: lang -> words, lang -> (word, word)
Replaced = tuple[dict[str, set[bytes]], dict[str, set[bytes]]]


def suffixes(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """The words, and for each suffix the numbers of its first three (0: the piece is over)."""
    joined = PIECE.join(t.translate(_TABLE) for t in texts).replace(PIECE, b" \n ")
    tokens = cut(joined, b" ")
    words, ids = numbered(tokens.filter(pc.greater(pc.binary_length(tokens), 0)), PIECE)
    ids = np.concatenate([ids, np.zeros(2, np.int64)])
    a, b = ids[:-2], ids[1:-1]
    c = np.where(b == 0, 0, ids[2:])
    at = a > 0
    return words, a[at], b[at], c[at]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Slices of one language each."""
    for batch in batches:
        texts, langs = utf8(batch.column(1)), batch.column(0).to_pylist()
        for lang in dict.fromkeys(langs):
            mine = [t for t, own in zip(texts, langs) if own == lang]
            for s in slices(mine, SLICE_BYTES):
                yield lang, mine[s]


def _first_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, texts in _slices(batches):
        words, a, _, _ = suffixes(texts)
        n = np.bincount(a, minlength=len(words))[1:]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), as_text(words[1:]), pa.array(n)],
                                         names=["lang", "prefix", "n"])


def _marks(words: list[bytes], of: set[bytes]) -> np.ndarray:
    return np.fromiter((w in of for w in words), bool, len(words))


def _second_words(replaced: dict[str, set[bytes]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _slices(batches):
            words, a, b, _ = suffixes(texts)
            often = _marks(words, replaced.get(lang, set()))
            at = often[a] & often[b]
            pairs, n = np.unique(a[at] * len(words) + b[at], return_counts=True)
            phrases = [words[p // len(words)] + b" " + words[p % len(words)] for p in pairs.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), as_text(phrases), pa.array(n)],
                                             names=["lang", "prefix", "n"])
    return run


def _deal(replaced: Replaced, n_groups: int):
    """The distinct suffixes of each slice as one row for each group: lines of three words
    (empty behind the end of a piece) and how often each occurs."""
    def group(lang: str, prefix: bytes) -> int:
        return xxhash.xxh3_64_intdigest(lang.encode() + b"\t" + prefix) % n_groups

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _slices(batches):
            words, a, b, c = suffixes(texts)
            if not len(a):
                continue
            base = len(words)
            pairs, of_pair = np.unique(a * base + b, return_inverse=True)
            leaves, n = np.unique(of_pair * base + c, return_counts=True)
            pair, third = pairs[leaves // base], leaves % base
            first, second = pair // base, pair % base
            words[0] = b""
            to = np.fromiter((group(lang, w) for w in words), np.int64, base)[first]
            # prefixes of two words where one is too frequent, of three where two are
            one, two = (r.get(lang, set()) for r in replaced)
            for i in np.flatnonzero(_marks(words, one)[first]).tolist():
                prefix = words[first[i]] + b" " + words[second[i]]
                to[i] = group(lang, prefix + b" " + words[third[i]] if prefix in two else prefix)
            order = np.argsort(to, kind="stable")
            groups, starts = np.unique(to[order], return_index=True)
            starts = np.append(starts, len(order))
            own, last = pa.array(words, pa.binary()), pa.array([w + b"\n" for w in words], pa.binary())
            lines = pc.binary_join_element_wise(own.take(pa.array(first[order])), own.take(pa.array(second[order])),
                                                last.take(pa.array(third[order])), b" ")
            ends = np.frombuffer(lines.buffers()[1], np.int32)[starts]  # of the groups, in the lines' bytes
            yield pa.RecordBatch.from_arrays(
                [pa.array(groups), pa.array([lang] * len(groups), pa.string()),
                 pa.Array.from_buffers(pa.binary(), len(groups), [None, pa.py_buffer(ends), lines.buffers()[2]]),
                 pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(n[order], pa.int64()))],
                names=["grp", "lang", "lines", "counts"])
    return run


def _subtrees(replaced: Replaced, min_count: int) -> Callable[[pa.Table], pa.Table]:
    """Nodes of at least ``min_count`` below the prefixes of one group, from the totals of the leaves."""
    def run(table: pa.Table) -> pa.Table:
        langs, blocks = table.column("lang").to_pylist(), table.column("lines").to_pylist()
        counts = table.column("counts").combine_chunks()
        out_lang, phrases, sizes, totals = [], [], [], []
        for lang in dict.fromkeys(langs):
            mine = [i for i, own in enumerate(langs) if own == lang]
            words, ids = numbered(cut(b"".join(blocks[i] for i in mine), b" \n")[:-1], b"")
            n = counts.take(pa.array(mine)).flatten().to_numpy()
            a, b, c = ids.reshape(-1, 3).T
            base = len(words)
            pairs, of_pair = np.unique(a * base + b, return_inverse=True)
            leaves, of_leaf = np.unique(of_pair * base + c, return_inverse=True)

            # totals of the leaves, and from them of the nodes above (sums far below 2^53)
            leaf = np.bincount(of_leaf, n, len(leaves)).astype(np.int64)
            two = np.bincount(leaves // base, leaf, len(pairs)).astype(np.int64)
            one = np.bincount(pairs // base, two, base).astype(np.int64)
            often_one, often_two = (r.get(lang, set()) for r in replaced)
            for i in np.flatnonzero(one >= min_count).tolist():
                if words[i] not in often_one:  # else counted with the prefixes
                    phrases.append(words[i])
                    sizes.append(1)
                    totals.append(one[i])
            for i in np.flatnonzero((two >= min_count) & (pairs % base > 0)).tolist():
                phrase = words[pairs[i] // base] + b" " + words[pairs[i] % base]
                if phrase not in often_two:
                    phrases.append(phrase)
                    sizes.append(2)
                    totals.append(two[i])
            for i in np.flatnonzero((leaf >= min_count) & (leaves % base > 0)).tolist():
                pair = pairs[leaves[i] // base]
                phrases.append(b" ".join((words[pair // base], words[pair % base], words[leaves[i] % base])))
                sizes.append(3)
                totals.append(leaf[i])
            out_lang += [lang] * (len(phrases) - len(out_lang))
        return pa.table([pa.array(out_lang, pa.string()), as_text(phrases), pa.array(sizes, pa.int32()),
                         pa.array(totals, pa.int64())], names=["lang", "phrase", "words", "f"])
    return run


def _too_frequent(counted: DataFrame, limit: int) -> dict[str, set[bytes]]:
    out: dict[str, set[bytes]] = {}
    for r in counted.filter(F.col("n") > limit).collect():
        out.setdefault(r["lang"], set()).add(r["prefix"].encode())
    return out


def _summed(prefixes: DataFrame) -> DataFrame:
    return prefixes.groupBy("lang", "prefix").agg(F.sum("n").alias("n"))


def phrase_counts(docs: DataFrame, min_count: int = 10, budget: int = GROUP_SUFFIXES,
                  text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, f`` of all phrases of up to three words and at least ``min_count``
    occurrences, and ``lang, n`` with the number of all words. Both are written tables."""
    own = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"),
                      F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    schema = "lang string, prefix string, n long"
    first = shared_table(_summed(own.mapInArrow(_first_words, schema)), "prefixes")
    sizes = shared_table(first.groupBy("lang").agg(F.sum("n").alias("n")), "words")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    n_groups = max(1, math.ceil(total / budget))
    one = _too_frequent(first, budget)
    two: dict[str, set[bytes]] = {}
    replaced = []
    if one:
        replaced.append(_marked(first, budget, 1))
        second = shared_table(_summed(own.mapInArrow(_second_words(one), schema)), "prefixes")
        if two := _too_frequent(second, budget):
            replaced.append(_marked(second, budget, 2))
    nodes = (own.mapInArrow(_deal((one, two), n_groups), "grp long, lang string, lines binary, counts array<long>")
             .groupBy("grp").applyInArrow(_subtrees((one, two), min_count), "lang string, phrase string, words int, f long"))
    for counted in replaced:
        nodes = nodes.unionByName(counted.filter(F.col("f") >= min_count))
    return shared_table(nodes, "phrases"), sizes


def _marked(counted: DataFrame, limit: int, words: int) -> DataFrame:
    return counted.filter(F.col("n") > limit).select("lang", F.col("prefix").alias("phrase"),
                                                     F.lit(words).alias("words"), F.col("n").alias("f"))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exactly, for counts below 10^16."""
    wide = [c.cast("decimal(20,0)") for c in (a, left, right)]
    return F.call_function("div", wide[0] * wide[0] * F.lit(1000000).cast("decimal(7,0)"), wide[1] * wide[2])


def scored(phrases: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the phrases of two and three words, each with its
    lowest-scoring cut, without those inside a longer phrase at least half as frequent."""
    split = F.split("phrase", " ")
    longer = phrases.filter("words = 3").select("lang", "f", split.alias("w"))
    inner = (longer.select("lang", "f", F.explode(F.array(F.concat_ws(" ", F.col("w")[0], F.col("w")[1]),
                                                          F.concat_ws(" ", F.col("w")[1], F.col("w")[2]))).alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("f").alias("longest")))
    kept = (phrases.filter("words > 1").join(inner, ["lang", "phrase"], "left")
            .filter(F.col("longest").isNull() | (100 * F.col("longest") < 50 * F.col("f"))))
    cut = F.explode(F.when(F.col("words") == 2, F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(2)))).alias("k")
    cuts = (kept.select("lang", "phrase", "words", F.col("f").alias("a"), split.alias("w"), cut)
            .select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
                    F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest")))
    counts = phrases.select("lang", "phrase", "f")
    cuts = (cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
            .join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]))
    cuts = cuts.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, top: int = 2000, min_count: int = 10, budget: int = GROUP_SUFFIXES,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language."""
    phrases, sizes = phrase_counts(docs, min_count, budget, text_col, lang_col)
    best = scored(phrases)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may hold most phrases: its first ones are found in many parts, in fewer, in one
    parts = n_partitions(docs.sparkSession)
    for n in (parts, math.isqrt(parts)):
        part = F.pmod(F.xxhash64("phrase"), F.lit(n))
        best = (best.withColumn("part", part)
                .withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
                .filter(F.col("place") <= top).drop("place", "part"))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return (best.join(sizes, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
