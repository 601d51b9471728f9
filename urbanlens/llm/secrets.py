"""Secret scan with a trigram inverted index (operator 7), DataFrame functions only.

1. From each rule's regular expression a Boolean query over lower-case trigrams is
   derived (:func:`trigram_query`): every match must contain the trigrams it names.
2. :func:`build_index` scans the texts once for the trigrams that any rule names and
   writes the postings (trigram, row key) to the shared folder.
3. Each rule's query is evaluated by intersecting postings per row key; the rows that
   satisfy it are its candidates.
4. Only candidates are read again and verified with the rule's regular expression. A
   rule without a mandatory trigram (the hexadecimal one) scans every text.

Spans are in code points, end exclusive; matches of one rule are leftmost and do not
overlap. A match whose measured group is shorter than the rule's minimum is dropped
(after it has consumed its text).

Defined cases: a null or empty text has no spans; repeated rows each get the same
result; a null id is kept as null; an empty table gives an empty result; columns other
than id and text are ignored; texts are scanned whole, whatever their length.
"""

from __future__ import annotations

import re._constants as C
import re._parser as sre
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import fresh, row_key, shared_table, texts


@dataclass(frozen=True)
class Rule:
    """``pattern`` is valid for both Java and Python; ``group`` is the measured group."""

    kind: str
    pattern: str
    group: int = 0
    min_len: int = 0


#: Fixed values of the contract: kinds, patterns and minimum lengths, in their order.
#: (A run of 32 or more is the same as a run of which shorter ones are dropped.)
BASE_RULES = (
    Rule("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"""
                   r"""[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?"""
                   r"""([A-Za-z0-9+/_.=-]+)""", 1, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
#: Rules added by this library: published prefixes of common credentials.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("url_login", r"[a-z]{2,10}://[A-Za-z0-9._%+-]{1,64}:[A-Za-z0-9._%+-]{3,64}@"),
)
RULES = BASE_RULES + MORE_RULES

KEY_BLOCKS = 256  # parts of a trigram's postings
MAX_STRINGS = 64  # strings kept while literal runs are multiplied out; beyond, the run ends

# --- trigram queries -------------------------------------------------------------------
# A query is True (no restriction), a trigram, or ("and" | "or", [queries]).


def _all(parts: list):
    parts = [p for p in parts if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", parts)


def _any(parts: list):
    return True if not parts or any(p is True for p in parts) else parts[0] if len(parts) == 1 else ("or", parts)


def _run(strings: set[str]):
    """What holds for a text that contains one of these strings."""
    return _any([_all([s[i:i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _chars(items) -> set[str] | None:
    out: set[str] = set()
    for op, arg in items:
        if op is C.LITERAL:
            out.add(chr(arg).lower())
        elif op is C.RANGE and arg[1] - arg[0] < 8:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _analyse(parsed) -> tuple[set[str] | None, object]:
    """(the strings a match can be, if few; the query that a match satisfies)."""
    run, exact, found = {""}, True, []
    for op, arg in parsed:
        strings, query = None, True
        if op is C.LITERAL:
            strings = {chr(arg).lower()}
        elif op is C.IN:
            strings = _chars(arg)
        elif op is C.AT:
            strings = {""}
        elif op is C.SUBPATTERN:
            strings, query = _analyse(arg[3])
        elif op is C.BRANCH:
            parts = [_analyse(p) for p in arg[1]]
            if all(s is not None for s, _ in parts):
                strings = set().union(*(s for s, _ in parts))
            query = _any([q for _, q in parts])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            low, high, sub = arg
            inner, inner_query = _analyse(sub)
            if inner is not None and low == high and low * len(min(inner, key=len)) <= 16 and len(inner) ** low <= MAX_STRINGS:
                strings = {""}
                for _ in range(low):
                    strings = {a + b for a in strings for b in inner}
            elif inner is not None and (low, high) == (0, 1):
                strings = inner | {""}
            query = inner_query if low else True
        if strings is not None and len(run) * len(strings) <= MAX_STRINGS:
            run = {a + b for a in run for b in strings}
        else:
            found += [_run(run), query]
            run, exact = {""}, False
    found.append(_run(run))
    return (run if exact else None), _all(found)


def trigram_query(pattern: str):
    """The Boolean trigram query of a regular expression; True if none is mandatory."""
    return _analyse(sre.parse(pattern))[1]


def trigrams(query) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def _holds(query, present: Column) -> Column:
    if isinstance(query, str):
        return F.array_contains(present, F.lit(query))
    parts = [_holds(q, present) for q in query[1]]
    out = parts[0]
    for p in parts[1:]:
        out = (out & p) if query[0] == "and" else (out | p)
    return out


# --- index and candidates --------------------------------------------------------------


def build_index(keyed: DataFrame, wanted: list[str]) -> DataFrame:
    """Postings (trigram, key) of the wanted trigrams. A trigram's postings are dealt out
    by blocks of keys, so that one in many texts is split, and ordered inside each file,
    so that a rule reads only its own row groups."""
    low = keyed.select("key", F.lower("text").alias("low"))
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted]))
    postings = low.select("key", F.explode(present).alias("trigram"))
    return shared_table(
        postings.repartition("trigram", F.pmod("key", F.lit(KEY_BLOCKS))).sortWithinPartitions("trigram", "key"), "trigrams")


def candidates(index: DataFrame, queries: dict[str, object]) -> DataFrame:
    """(key, kinds): the rows whose postings satisfy the queries of these kinds."""
    present = (index.filter(F.col("trigram").isin(sorted(set().union(*map(trigrams, queries.values())))))
               .groupBy("key").agg(F.collect_set("trigram").alias("present")))
    kinds = F.array_compact(F.array(*[F.when(_holds(q, F.col("present")), F.lit(k)) for k, q in queries.items()]))
    return present.select("key", kinds.alias("kinds")).filter(F.size("kinds") > 0)


# --- verification ----------------------------------------------------------------------

BLOCK = 256
ITEMS = "array<struct<gap:int,len:int,measured:int,step:int>>"


def _items(rule: Rule, wanted: Column) -> Column:
    """(gap before, length, measured length, length with the gap) of each match; the last
    item stands for the text after the last match and has no lengths."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all("text", pattern, F.lit(0))
    pairs = F.zip_with(F.split("text", rule.pattern, -1), found, lambda g, m: F.struct(
        F.char_length(g).alias("gap"), F.char_length(m).alias("len"), F.char_length(m).alias("measured"),
        (F.char_length(g) + F.char_length(m)).alias("step")))
    if rule.group:
        pairs = F.zip_with(pairs, F.regexp_extract_all("text", pattern, F.lit(rule.group)),
                           lambda p, c: p.withField("measured", F.char_length(c)))
    return F.when(wanted & F.rlike("text", pattern), pairs).otherwise(F.array().cast(ITEMS))


def _spans(df: DataFrame, rules: list[tuple[int, Rule]], wanted) -> DataFrame:
    """Add ``spans``: array of (start, end, ord, kind) of the rules' matches in ``text``.

    Starts are prefix sums of the lengths of the gaps and matches before, in blocks, so
    that many matches in one text cost little more than linear time."""
    df = df.withColumn("_r", F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(r.kind).alias("kind"), F.lit(r.min_len).alias("least"),
                                               _items(r, wanted(r)).alias("items")) for i, r in rules]))
    df = df.withColumn("_r", F.filter("_r", lambda r: F.size(r["items"]) > 0))

    def steps(items, first, n):
        return F.aggregate(F.slice(items, first, n), F.lit(0), lambda a, x: a + F.coalesce(x["step"], F.lit(0)))

    df = df.withColumn("_b", F.transform("_r", lambda r: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(r["items"]) - 1) / BLOCK).cast("int")),
        lambda b: steps(r["items"], b * BLOCK + 1, F.lit(BLOCK)))))
    df = df.withColumn("_p", F.transform("_b", lambda bs: F.transform(
        bs, lambda _, i: F.aggregate(F.slice(bs, F.lit(1), i), F.lit(0), lambda a, x: a + x))))

    def span(r, k):
        def one(x, i):
            block = F.floor(i / BLOCK).cast("int")
            start = F.get(F.get("_p", k), block) + steps(r["items"], block * BLOCK + 1, i % BLOCK) + x["gap"]
            return F.struct(start.alias("start"), (start + x["len"]).alias("end"), r["ord"].alias("ord"),
                            r["kind"].alias("kind"), (x["measured"] >= r["least"]).alias("kept"))
        return F.transform(r["items"], one)

    kept = F.filter(F.flatten(F.transform("_r", span)), lambda s: s["kept"])
    return df.withColumn("spans", F.transform(kept, lambda s: s.dropFields("kept"))).drop("_r", "_b", "_p")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``key, doc_id, spans``: one row per input row; spans ordered by start, then rule.

    ``spans`` is array<struct<start, end, ord, kind>>; ``key`` is ``row_key(doc_id, text)``."""
    keyed = texts(docs, id_col, text_col).withColumn("key", row_key("doc_id", "text"))
    numbered = list(enumerate(rules))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q is not True}

    whole = _spans(keyed, [(i, r) for i, r in numbered if r.kind not in indexed], lambda r: F.lit(True)) \
        if len(indexed) < len(rules) else keyed.withColumn("spans", F.lit(None))
    whole = whole.select("key", "doc_id", F.col("spans").alias("_whole"))
    if indexed:
        index = build_index(keyed, sorted(set().union(*map(trigrams, indexed.values()))))
        found = shared_table(candidates(index, indexed), "secret-candidates")
        verified = _spans(keyed.join(found, "key"), [(i, r) for i, r in numbered if r.kind in indexed],
                          lambda r: F.array_contains("kinds", F.lit(r.kind)))
        # equal rows verify equally: one of them is enough
        verified = (verified.filter(F.size("spans") > 0)
                    .select(F.col("key").alias("_key"), F.col("doc_id").alias("_id"), F.col("spans").alias("_indexed"))
                    .dropDuplicates(["_key", "_id"]))
        whole = whole.join(verified, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    else:
        whole = whole.withColumn("_indexed", F.lit(None).cast("array<struct<start:int,end:int,ord:int,kind:string>>"))
    none = F.array().cast("array<struct<start:int,end:int,ord:int,kind:string>>")
    both = F.concat(F.coalesce("_whole", none), F.coalesce("_indexed", none))
    return whole.select("key", "doc_id", F.array_sort(both, lambda a, b: F.when(
        a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["ord"] - b["ord"])).alias("spans"))


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns from :func:`scan_secrets`."""
    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["ord"] < len(BASE_RULES))
    out = scanned.withColumn("_base", base)
    counts = [F.size(F.filter("_base", _of_kind(r.kind))).cast("long").alias(f"n_{r.kind}") for r in BASE_RULES]
    return out.select("doc_id", *counts, F.sha2(listed(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
                      listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by ``mask`` (overlapping spans by
    one); rows without a secret are unchanged, null texts stay null."""
    at_key, at_id, at_spans = fresh(docs, "_key"), fresh(docs, "_span_id"), fresh(docs, "_spans")
    spans = (scan_secrets(docs, id_col, text_col, rules).filter(F.size("spans") > 0)
             .select(F.col("key").alias(at_key), F.col("doc_id").alias(at_id), F.col("spans").alias(at_spans))
             .dropDuplicates([at_key, at_id]))
    spans = shared_table(spans, "secret-spans")
    text = F.col(text_col)
    own = F.col(id_col).cast("long")
    key = F.xxhash64(own, F.coalesce(text.cast("string"), F.lit("")))
    df = docs.join(spans, (key == F.col(at_key)) & own.eqNullSafe(F.col(at_id)), "left")
    # (rebuilt text, end of what has been copied): spans are ordered by start
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc, s):
        gap = F.when(s["start"] >= acc["at"], F.concat(F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)))
        return F.struct(F.concat(acc["out"], F.coalesce(gap, F.lit(""))).alias("out"),
                        F.greatest(acc["at"], s["end"]).alias("at"))

    whole = F.aggregate(at_spans, state, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)))
    return df.withColumn(text_col, F.when(F.col(at_spans).isNull(), text).otherwise(whole)).select(*docs.columns)
