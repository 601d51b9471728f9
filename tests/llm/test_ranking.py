"""Operators 11 to 13 against plain Python, on the given documents and on edge cases."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import LOWER, edge_rows, table

from urbanlens.llm import collocations, lm, search

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# --- 12 ---------------------------------------------------------------------------------------
def ranked(docs, items, top=10):
    """(item, rank, doc, score) by the formulas; rows are (id, text)."""
    counts = [(i, Counter(TERMS.findall((t or "").translate(LOWER)))) for i, t in docs]
    counts = [(i, c, c.total()) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        asked = Counter(TERMS.findall((text or "").translate(LOWER)))
        scores = []
        for i, c, n in counts:
            m = 25 + (75 * n * n_docs) // n_terms
            s = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t, times in asked.items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        for rank, (s, null, i) in enumerate(sorted(scores)[:top], 1):
            out.append((item, rank, None if null else i, -s))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("shard_docs", [17, 4096])
def test_search_equals_formulas(spark, docs, pdocs, shard_docs):
    """Many small shards drop accumulators and several owners pass them on; one shard does not."""
    items = table(spark, "benchmark")
    rows = [(r["item_id"], r["text"]) for r in items.collect()]
    got = found(search.search(docs, items, shard_docs=shard_docs))
    assert got == ranked(list(zip(pdocs["doc_id"], pdocs["text"])), rows)


def test_search_edges(spark, edge_docs, no_docs):
    asked = [(1, "the lazy dog and the quick FOX the the"), (1, "the lazy dog and the quick FOX the the"), (2, None), (3, "-- !"),
             (4, "nowhere-to-be-found-at"), (None, "日本語のテキスト x"), (5, "a b c again")]
    items = spark.createDataFrame([(i, t, "z") for i, t in asked], "item_id long, text string, term string")
    got = found(search.search(edge_docs, items, shard_docs=4))
    assert got == ranked(edge_rows(), asked)
    assert search.search(no_docs, items).collect() == []
    assert search.search(edge_docs, items.limit(0)).collect() == []


def test_search_ties_rank_by_id(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(40, 0, -1)] + [(50, "other")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "words")], "item_id long, text string")
    got = search.search(docs, items, shard_docs=5).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == list(range(1, 11)) and len({r["score"] for r in got}) == 1


# --- 13 ---------------------------------------------------------------------------------------
def phrases_of(rows, min_count=10, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                counts[lang].update(" ".join(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: p.split(" ") for p, n in f.items() if n >= min_count and " " in p}
        longest = Counter()
        for p, w in candidates.items():
            if len(w) == 3:
                for inner in (" ".join(w[:2]), " ".join(w[1:])):
                    longest[inner] = max(longest[inner], f[p])
        best = []
        for p, w in candidates.items():
            if longest[p] and 100 * longest[p] >= 50 * f[p]:
                continue
            score, k = min((10**6 * f[p] ** 2 // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k) for k in range(1, len(w)))
            best.append((-score, -f[p], p.encode(), f[" ".join(w[:k])], f[" ".join(w[k:])]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.mark.parametrize("budget", [150, 5000, 10**9])
def test_collocations_equal_counts(spark, docs, budget):
    """Small budgets replace frequent words, and frequent pairs, by longer prefixes."""
    expected = phrases_of([(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()])
    assert rows_of(collocations.collocations(docs, budget=budget)) == expected


def test_collocations_edges(spark, edge_docs, no_docs, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE_BYTES", 1000)
    rows = [(r["lang"], r["text"]) for r in edge_docs.select("lang", "text").collect()]
    got = rows_of(collocations.collocations(edge_docs, budget=50))
    assert got == phrases_of(rows) and {r[0] for r in got} == {"en", "und"}
    assert rows_of(collocations.collocations(edge_docs, top=3)) == phrases_of(rows, top=3)
    assert collocations.collocations(no_docs).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 3_000_000_019, 3_000_000_021, 5_000_000_029
    df = spark.createDataFrame([("x", "p q", 2, a), ("x", "p", 1, left), ("x", "q", 1, right)], "lang string, phrase string, words int, f long")
    assert collocations.scored(df).first()["score"] == 10**6 * a * a // (left * right)


# --- 11 ---------------------------------------------------------------------------------------
def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def tokens(text):
    return [*WORDS.findall((text or "").translate(LOWER)), " "]


def check_base(rows, out):
    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = c.total(), len(c)
    expected = defaultdict(list)
    for i, t in rows:
        w = tokens(t)
        expected[i].append((len(w), sum(x in c for x in w), sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)))
    got = defaultdict(list)
    for r in out:
        assert r["train_tokens"] == n and r["held_out"] == held(r["doc_id"])
        got[r["doc_id"]].append((r["n_tokens"], r["n_known"], r["base_score"]))
    assert expected.keys() == got.keys()
    for i, mine in expected.items():
        assert len(mine) == len(got[i])
        for x, y in zip(sorted(mine), sorted(got[i])):
            assert x[:2] == y[:2] and y[2] == pytest.approx(x[2], rel=1e-9)


@pytest.mark.parametrize("known", [50, 500_000])
def test_base_scores_and_gain(spark, docs, pdocs, monkeypatch, known):
    """Counts from the join and from the bounded list; the model beats the base on held-out texts."""
    monkeypatch.setattr(lm, "KNOWN", known)
    out = lm.score(docs, lm.sevenths).collect()
    check_base(list(zip(pdocs["doc_id"], pdocs["text"])), out)
    for part in (True, False):
        mine = [r for r in out if r["held_out"] == part]
        assert sum(r["score"] for r in mine) > sum(r["base_score"] for r in mine) + 0.05 * sum(r["n_tokens"] for r in mine)


def test_lm_edges(spark, edge_docs, no_docs):
    out = lm.score(edge_docs, lm.sevenths).collect()
    check_base(edge_rows(), out)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)
    assert len({r for r in out if r["doc_id"] == 17}) == 1 and all(r["n_tokens"] == 1 for r in out if r["doc_id"] in (1, 2, 3))
    assert lm.score(no_docs, lm.sevenths).collect() == []
    untrained = lm.score(edge_docs.filter("doc_id is not null"), lambda i: i > 10**6).filter("doc_id = 4").first()
    assert (untrained["train_tokens"], untrained["n_known"], untrained["base_score"]) == (0, 0, 0.0) and untrained["held_out"]
    assert untrained["score"] == pytest.approx(2 * math.log10(1 / lm.UNITS), rel=1e-4)


def random_vocabulary(rng, n=4000):
    """Counts of random words, and what tasks would know of them."""
    words = sorted({bytes(rng.integers(97, 123, rng.integers(1, 5)).tolist()) for _ in range(n)})
    counts = dict(zip(words, rng.integers(1, 1000, len(words)).tolist())) | {lm.END: 500}
    first = sorted(counts, key=lambda w: (-counts[w], w))[:lm.WORD_UNITS]
    shared, frequency = np.zeros(lm.SUFFIX_UNITS), np.zeros(lm.UNITS)
    units = {w: i for i, w in enumerate(first)}
    vocabulary = lm.Vocabulary(units, counts, shared, frequency)
    for w, c in counts.items():
        frequency[vocabulary.unit(w)] += c
        if w not in units:
            shared[vocabulary.unit(w) - lm.WORD_UNITS] += c + 1
    return vocabulary


def test_probabilities_are_normalised():
    """Over all words, and one unseen word in each shared unit, they add up to 1 in any context."""
    rng = np.random.default_rng(1)
    vocabulary = random_vocabulary(rng)
    trainer = lm.Trainer(lm.Model(vocabulary.noise()), 1)
    units = rng.integers(0, lm.UNITS, 20_000)
    trainer.learn(lm.contexts(units, np.array([5000] * 4)), units)
    for ctx in ([lm.START, lm.START], [3, lm.START], [900, 17]):
        logs = trainer.m.log_probability(np.array([ctx] * lm.UNITS), np.arange(lm.UNITS))
        p = np.exp(logs)
        of_words = sum(p[vocabulary.unit(w)] * (1 if w in vocabulary.units else (c + 1) / (vocabulary.shared[vocabulary.unit(w) - lm.WORD_UNITS] + 1))
                       for w, c in vocabulary.counts.items())
        unseen = sum(p[lm.WORD_UNITS + u] / (vocabulary.shared[u] + 1) for u in range(lm.SUFFIX_UNITS))
        assert of_words + unseen == pytest.approx(1, abs=1e-4)


def test_the_model_learns_a_rule():
    """Unit u is followed by u + 1: estimation by noise finds it, whatever the frequencies."""
    rng = np.random.default_rng(2)
    starts = rng.integers(0, 50, 4000)
    units = ((starts[:, None] + np.arange(10)) % 50).ravel()
    frequency = np.bincount(units, minlength=lm.UNITS)
    model = lm.Model((frequency + 1) / (frequency + 1).sum())
    trainer = lm.Trainer(model, 3)
    for _ in range(3):
        trainer.learn(lm.contexts(units, np.array([10] * 4000)), units)
    ctx = lm.contexts(units, np.array([10] * 4000))
    inner = ctx[:, 0] != lm.START
    assert np.exp(model.log_probability(ctx[inner], units[inner])).mean() > 0.8


def test_gradients_follow_the_estimate():
    """One step's gradient of a bias equals the difference quotient of the estimation objective."""
    rng = np.random.default_rng(4)
    noise = np.full(lm.UNITS, 1 / lm.UNITS)
    units, ctx = rng.integers(0, 40, 64), rng.integers(0, 40, (64, 2))

    def objective(model, sample):
        h, shift = model.hidden(ctx).astype(float), math.log(lm.NOISE)
        true = np.einsum("ij,ij->i", h, model.Q[units]) + model.b[units] - model.log_noise[units] - shift
        false = h @ model.Q[sample].T + model.b[sample] - model.log_noise[sample] - shift
        return -np.logaddexp(0, -true).sum() - np.logaddexp(0, false).sum()

    sample = np.random.default_rng(5).choice(lm.UNITS, lm.NOISE, p=noise)
    found_ = {}
    trainer = lm.Trainer(lm.Model(noise), 5)
    trainer._add = lambda name, at, gradient: found_.setdefault(name, (at, gradient))
    trainer.step(ctx, units)
    for name, at in (("b", (units[0],)), ("Q", (units[1], 3)), ("R", (int(ctx[2, 0]), 5)), ("C", (1, 2, 4))):
        rows, gradient = found_[name]
        mine = gradient[at] if name == "C" else gradient[np.searchsorted(rows, at[0])][at[1:]]
        up, down = lm.Model(noise), lm.Model(noise)
        getattr(up, name)[at] += 0.01
        getattr(down, name)[at] -= 0.01
        assert mine == pytest.approx((objective(up, sample) - objective(down, sample)) / 0.02, rel=0.03, abs=0.01)
