"""Document fingerprints by winnowing (operator 1), DataFrame functions only.

A text is a sequence of pieces: the four characters at every position of a word (a run
without white space, of any length), a shorter word itself, or single characters of scripts
without spaces. So a piece doesn't depend on where its word begins, and texts that share a
passage inside unbroken runs share its pieces at any offset. The Karp-Rabin hash of every
K = 4 consecutive pieces is built by doubling (pairs, then pairs of pairs), which gives
the values a rolling evaluation gives. Of every window of W = 8 consecutive hashes the
smallest is chosen, the rightmost if there are several; chosen (hash, position) pairs
are kept once. So any run of W + K - 1 = 11 pieces that two texts share puts a common
hash in both fingerprints, and the positions say where.

A fingerprint is array<long>: the hash in the upper 32 bits, the complement of the
position (of the first piece, from 0) in the lower 32, so that the minimum of longs is
the smallest hash with the rightmost position; :func:`shown` gives ``hash:position``.

Defined cases: a null or empty text, or one of white space, has an empty fingerprint; a
text of fewer than K pieces has one hash of all of them; one of fewer than W hashes is
one window. Two empty fingerprints have likeness 1, an empty and another one 0. Texts of
any length are read whole; rows with a null id come last in descending order, those of
one id stand in descending order of a hash of the text, so repeated rows are neighbours;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlens.llm.common import n_partitions, texts

K, W = 4, 8
_SCRIPTS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}"
#: ASCII is decided by a range, before the scripts are looked up (most of the pattern's time).
_ALONE = rf"[\x{{80}}-\x{{10FFFF}}&&[{_SCRIPTS}]]"
_IN_WORD = rf"[!-~[^\s{_SCRIPTS}]]"
#: Group 1 is the piece; the match goes on by one character, or over the last four of a word.
PIECE = rf"(?=({_IN_WORD}{{1,4}}|{_ALONE}))(?:{_IN_WORD}(?={_IN_WORD}{{4}})|{_IN_WORD}{{1,4}}|{_ALONE})"
PRIME = (1 << 31) - 1
BASE = 1_000_003
_LOW = (1 << 32) - 1


def _shifted(name: str, by: int, join) -> Column:
    """``join(a[i], a[i + by])`` for all i; empty if the array is too short."""
    n = F.greatest(F.size(name) - by, F.lit(0))
    return F.zip_with(F.slice(name, F.lit(1), n), F.slice(name, F.lit(1 + by), n), join)


def with_fingerprint(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Add the fingerprint of ``text_col`` as ``out``. One projection for each pass, so
    that no array is computed twice."""
    df = df.withColumn("_c", F.transform(F.regexp_extract_all(text_col, F.lit(PIECE), F.lit(1)),
                                         lambda p: F.pmod(F.xxhash64(p), F.lit(PRIME))))
    power, length = BASE, 1
    df = df.withColumn("_h", F.col("_c"))
    while length < K:
        df = df.withColumn("_h", _shifted("_h", length, _karp(power)))
        power, length = power * power % PRIME, length * 2
    few = F.array(F.aggregate("_c", F.lit(0).cast("long"), lambda a, c: (a * BASE + c) % PRIME))
    df = df.withColumn("_h", F.when(F.size("_h") > 0, F.col("_h")).when(F.size("_c") > 0, few).otherwise(F.col("_c")))
    df = df.withColumn("_w", F.transform("_h", lambda h, i: F.xxhash64(h).bitwiseAND(F.lit(PRIME << 32))
                                         .bitwiseOR(F.lit(_LOW) - i)))
    df = df.withColumn("_all", F.col("_w"))
    length = 1
    while length < W:
        df = df.withColumn("_w", _shifted("_w", length, lambda a, b: F.least(a, b)))
        length *= 2
    least = F.when(F.size("_all") > 0, F.array(F.array_min("_all"))).otherwise(F.col("_all"))
    chosen = F.when(F.size("_w") > 0, F.array_distinct("_w")).otherwise(least)
    return df.withColumn(out, chosen).drop("_c", "_h", "_w", "_all")


def _karp(power: int):
    return lambda a, b: (a * power + b) % PRIME


def _hashes(fingerprint: str) -> Column:
    return F.array_distinct(F.transform(fingerprint, lambda k: F.shiftright(k, 32)))


def shown(fingerprint: str) -> Column:
    """``hash:position`` in hexadecimal and decimal, comma-joined, in order of position."""
    one = F.transform(fingerprint, lambda k: F.concat_ws(
        ":", F.hex(F.shiftright(k, 32)), (F.lit(_LOW) - k.bitwiseAND(F.lit(_LOW))).cast("string")))
    return F.lower(F.array_join(one, ","))


def _likeness(a: str, b: str) -> Column:
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def _longs(values: list[int]) -> Column:
    """An array of fixed values as one literal of the plan, however many they are."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def _ranges(ids: DataFrame, count: int) -> Column:
    """The number of the range a row lies in by (``o``, ``h``), of about ``count`` ranges of
    nearly equally many rows. Cuts are approximate quantiles of ``o``, whose number depends
    on the cluster's partitions, not on the data; an id that several of them fall on is cut
    further, into as many equal parts of its hashes ``h``. Numbers rise with (``o``, ``h``)."""
    steps = F.split(F.lit(",".join(str(i / count) for i in range(1, count))), ",").cast("array<double>")
    found = ids.agg(F.percentile_approx("o", steps, 10 * count)).first()[0] or []
    cuts = sorted(set(found))
    if not cuts:
        return F.lit(0).cast("long")
    times = Counter(found)
    width = max(1, int(len(cuts) ** 0.5))  # a search in two levels
    o = F.col("o")
    block = F.size(F.filter(_longs(cuts[::width]), lambda c: c <= o))
    within = F.filter(F.slice(_longs(cuts), F.greatest(block - 1, F.lit(0)) * width + 1, F.lit(width)), lambda c: c <= o)
    below = F.when(block == 0, F.lit(0)).otherwise((block - 1) * width + F.size(within))  # cuts up to o
    cut = F.get(_longs(cuts), below - 1)
    parts = F.coalesce(F.get(_longs([times[c] for c in cuts]), below - 1), F.lit(1))
    of_hash = F.floor((F.col("h") / F.lit(2.0 ** 64) + 0.5) * parts)
    part = F.when(parts == 1, F.lit(0)).when(o == cut, F.least(of_hash, parts - 1)).otherwise(parts)
    return below.cast("long") * (max(times.values()) + 1) + part.cast("long")


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``next_<c>`` for each column: its value in the next row in descending order of
    ``doc_id`` (after the last: the first), rows of one id by a hash of their text.

    Rows are cut into ranges of ids and hashes, so one exchange and a window inside each
    range do; the first row of each range is also sent, as a phantom, to the range before
    it. Many rows of one id, or of none, fall into many ranges; rows alike in id and text
    share one."""
    rows = rows.withColumn("o", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long"))).withColumn("h", F.xxhash64("text"))
    spark = rows.sparkSession
    number = _ranges(rows.select("o"), 4 * n_partitions(spark))
    rows = rows.withColumn("range", number)
    firsts = rows.groupBy("range").agg(F.max(F.struct("o", "h")).alias("first"))
    order = Window.orderBy(F.col("range").desc())  # over one row for each range
    phantoms = firsts.select("first.o", "first.h", F.coalesce(
        F.lag("range").over(order), F.min("range").over(Window.partitionBy(F.lit(0)))).alias("before"))
    rows = rows.join(F.broadcast(phantoms), ["o", "h"], "left")  # one row for each range: bounded
    places = F.array_compact(F.array(F.struct("range", F.lit(False).alias("phantom")),
                                     F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("range"), F.lit(True).alias("phantom")))))
    rows = rows.withColumn("place", F.explode(places)).select("doc_id", "o", "h", *columns, "place.*")
    within = Window.partitionBy("range").orderBy("phantom", F.col("o").desc(), F.col("h").desc(), "text")
    out = rows.select("doc_id", *columns, "phantom", *[F.lead(c).over(within).alias(f"next_{c}") for c in columns])
    return out.filter(~F.col("phantom")).drop("phantom")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, fingerprint`` (array<long>), one row per document."""
    return with_fingerprint(texts(docs, id_col, text_col), "text", "fingerprint")


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint against that of its edited text (the last half of its
    characters replaced by as many of the next document's first, or all of them) and
    against the next document's. Likeness is the Jaccard similarity of the hash sets."""
    df = with_next(fingerprints(docs, id_col, text_col), ["text", "fingerprint"])
    df = df.withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    df = df.withColumn("edited", F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half),
                                          F.substr("next_text", F.lit(1), half)))
    df = df.select("doc_id", "n_chars", "edited", "fingerprint", "next_fingerprint")
    df = with_fingerprint(df, "edited", "edited_fingerprint")
    for name in ("fingerprint", "edited_fingerprint", "next_fingerprint"):
        df = df.withColumn(f"_{name}", _hashes(name))
    return df.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        shown("fingerprint").alias("fingerprint"), shown("edited_fingerprint").alias("edited_fingerprint"),
        _likeness("_fingerprint", "_edited_fingerprint").alias("near_edited"),
        _likeness("_fingerprint", "_next_fingerprint").alias("near_next"))
