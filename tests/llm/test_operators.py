"""Operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import LOWER, SF, table
from pyspark.sql import functions as F

from urbanlens.llm import (decontam, fingerprints, graph, html, licenses, neardup, packing, quality, secrets, substrings,
                           tokencount)
from urbanlens.llm import queries as Q


# --- 1 winnowing -----------------------------------------------------------------------

def test_winnowing_guarantee_and_positions(spark):
    """Any shared run of W + K - 1 pieces gives a common hash; chosen hashes are the
    rightmost minima of their windows."""
    pick = random.Random(3)
    word = lambda: "".join(pick.choices("abcde", k=pick.randint(1, 4)))  # noqa: E731  one piece each
    shared = [word() for _ in range(fingerprints.W + fingerprints.K - 1)]
    texts = [" ".join([word() for _ in range(pick.randint(0, 30))] + shared + [word() for _ in range(pick.randint(0, 30))])
             for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    prints = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(df).collect()}
    hashes = [{k >> 32 for k in p} for p in prints.values()]
    assert set.intersection(*hashes)

    full = fingerprints.with_fingerprint  # every window's choice, recomputed from all hashes
    old_w, fingerprints.W = fingerprints.W, 1
    try:
        every = {r["doc_id"]: r["f"] for r in full(df, "text", "f").collect()}
    finally:
        fingerprints.W = old_w
    for i, keys in every.items():
        chosen = []
        for s in range(max(1, len(keys) - old_w + 1)):
            least = min(keys[s:s + old_w])  # low bits fall with the position: rightmost on ties
            if least not in chosen:
                chosen.append(least)
        assert prints[i] == chosen


@pytest.mark.parametrize("letters", ["abcdefgh/=.", "កខគឃងចឆជ", "😀😁😂🤣"])
def test_winnowing_guarantee_in_unbroken_runs(spark, letters):
    """A passage of W + K - 1 pieces inside an unbroken run (3 characters more) gives a common
    hash at every offset."""
    pick = random.Random(5)
    some = lambda n: "".join(pick.choices(letters, k=n))
    for length in (fingerprints.W + fingerprints.K - 1 + 3, 2000):
        shared = some(length)
        texts = [some(n) + shared + some(m) for n in range(5) for m in (0, 40)]
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        hashes = [{k >> 32 for k in r["fingerprint"]} for r in fingerprints.fingerprints(df).collect()]
        assert len(set.intersection(*hashes)) >= max(1, length // 50)


@pytest.mark.parametrize("text, pieces", [
    ("abc", ["abc"]), ("abcd", ["abcd"]), ("abcdef gh", ["abcd", "bcde", "cdef", "gh"]), ("日本ab", ["日", "本", "ab"]),
    ("ab日cdefg", ["ab", "日", "cdef", "defg"]), (" \n", []), ("", [])])
def test_winnowing_pieces(spark, text, pieces):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(F.regexp_extract_all("text", F.lit(fingerprints.PIECE), F.lit(1))).first()[0] == pieces


def test_edit_report_against_plain_python(docs, pdocs):
    out = fingerprints.edit_report(docs).toPandas().set_index("doc_id")
    p = pdocs.sort_values("doc_id", ascending=False)
    following = [*p.text[1:], p.text.iloc[0]]
    for i, text, after in zip(p.doc_id, p.text, following):
        h = len(text) // 2
        edited = text[:len(text) - h] + after[:h]
        assert out.edited_sha256[i] == hashlib.sha256(edited.encode()).hexdigest() and out.n_chars[i] == len(text)
    assert out.near_edited.median() > 0.25 and out.near_next.median() < 0.05
    both = out.join(pdocs.set_index("doc_id"))
    assert (both.groupby("text").fingerprint.nunique() == 1).all()


def _pieces(text):
    """Pieces by walking the characters, without the library's pattern."""
    def alone(c):
        return any(lo <= ord(c) <= hi for lo, hi in ((0x3041, 0x3096), (0x30A1, 0x30FA), (0x0E01, 0x0E3A), (0x0E40, 0x0E5B), (0x4E00, 0x9FFF)))

    out, word = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r" or alone(c):
            out += [word[i:i + 4] for i in range(max(1, len(word) - 3))] if word else []
            out += [c] if alone(c) else []
            word = ""
        else:
            word += c
    return out


def _winnowed(text):
    """(hash, position) pairs of a text, in order of position, in plain Python."""
    import xxhash

    signed = lambda x: x - (1 << 64) if x >> 63 else x
    codes = [signed(xxhash.xxh64_intdigest(p.encode(), seed=42)) % fingerprints.PRIME for p in _pieces(text)]
    value = lambda part: sum(c * pow(fingerprints.BASE, len(part) - 1 - i, fingerprints.PRIME)
                             for i, c in enumerate(part)) % fingerprints.PRIME
    grams = [value(codes[i:i + fingerprints.K]) for i in range(len(codes) - fingerprints.K + 1)] or ([value(codes)] if codes else [])
    mixed = [xxhash.xxh64_intdigest(g.to_bytes(8, "little"), seed=42) >> 32 & fingerprints.PRIME for g in grams]
    chosen = []
    for s in range(max(1, len(mixed) - fingerprints.W + 1) if mixed else 0):
        window = mixed[s:s + fingerprints.W]
        at = s + max(i for i, m in enumerate(window) if m == min(window))
        if (mixed[at], at) not in chosen[-fingerprints.W:]:
            chosen.append((mixed[at], at))
    return chosen


def test_edit_report_equals_plain_python(docs, pdocs):
    """Fingerprints of the texts and of the edited texts, and both likenesses, recomputed."""
    odd = [(10_000, ""), (10_001, "one"), (10_002, "日本語 かな ab ไทย 🎉🎉🎉🎉🎉 é"), (10_003, "x" * 300), (10_004, "a b c"), (10_005, " ")]
    spark = docs.sparkSession
    out = fingerprints.edit_report(docs.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))).collect()
    rows = sorted([*zip(pdocs.doc_id, pdocs.text), *odd], reverse=True)
    texts = dict(rows)
    after = {i: rows[(n + 1) % len(rows)][1] for n, (i, _) in enumerate(rows)}
    prints = {t: _winnowed(t) for t in texts.values()}
    shown = lambda pairs: ",".join(f"{h:x}:{at}" for h, at in pairs)

    def likeness(a, b):
        a, b = {h for h, _ in a}, {h for h, _ in b}
        return len(a & b) / len(a | b) if a | b else 1.0

    assert len(out) == len(rows)
    for r in out:
        text, following = texts[r["doc_id"]], after[r["doc_id"]]
        h = len(text) // 2
        own, edited = prints[text], _winnowed(text[:len(text) - h] + following[:h])
        assert (r["fingerprint"], r["edited_fingerprint"]) == (shown(own), shown(edited))
        assert (r["near_edited"], r["near_next"]) == (likeness(own, edited), likeness(own, prints[following]))


def test_rows_of_one_id_are_spread(spark):
    """Half the ids null and a tenth equal: ranges stay even, every row keeps its neighbour."""
    rows = [(None if i % 2 else 7 if i % 10 == 0 else i, f"text {i}") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = df.select(F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("o"), F.xxhash64("text").alias("h"), "text")
    ranges = keyed.select("o", "h", "text", fingerprints._ranges(keyed, 32).alias("range"))
    sizes = ranges.groupBy("range").count().toPandas()["count"]
    assert len(sizes) >= 24 and sizes.max() <= 3 * sizes.median()

    expected = [r["text"] for r in keyed.orderBy(F.desc("o"), F.desc("h")).collect()]
    out = {r["text"]: r["next_text"] for r in fingerprints.with_next(df, ["text"]).collect()}
    assert out == dict(zip(expected, expected[1:] + expected[:1]))


# --- 2 packing -------------------------------------------------------------------------

def test_packing_round_trip(docs, pdocs):
    import public_tokenizers
    from tokenizers import Tokenizer

    out = packing.pack(docs, Q.RANKS).toPandas()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in zip(pdocs.doc_id, pdocs.text):
        ids = np.array(tok.encode(text, add_special_tokens=False).ids + [0], "<u4")
        own = out[out.doc_id == i].sort_values("start")
        assert own.start.tolist() == [0, *own.length.cumsum()[:-1]] and own.length.sum() == len(ids)
        assert all(zlib.crc32(ids[s:s + n].tobytes()) == c for s, n, c in zip(own.start, own.length, own.ids_crc32))
    for _, seq in out.sort_values("offset").groupby("sequence_id"):
        assert seq.offset.tolist() == [0, *seq.length.cumsum()[:-1]] and seq.length.sum() <= 1024
    n = out.sequence_id.nunique()
    assert out.length.sum() > 0.97 * 1024 * (n - 1)


@pytest.mark.parametrize("text", [" a", "a  b", "x\n y", "x \ny", " \t a  ", "trail ", "a　b 　c", " \x1ca", "it's  's 's", "\n\n  x",
                                  " ", "  ", "日本語 テキスト", "a\r\n b", "<|endoftext|> x", "  x y", "a  b", "1 23 !? x"])
def test_cached_ids_equal_the_tokenizer(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert np.frombuffer(packing.tokenizer(Q.RANKS)(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    "a" + " " * 2_000_000, "a" + "\n" * 2_000_000, "a" + " " * 2_000_000 + "b", "a" + "\n" * 2_000_000 + "b", " " * 20_000,
    "a" + " " * 15_000 + "\x1c" + " " * 15_000 + "'s", "a" + "\x85\u3000" * 9_000 + " b" + "\t" * 9_999 + "c",
    " " * 15_000 + "<|endoftext|>" + "\n" * 15_000 + " b <|endoftext|>"])
def test_ids_of_long_white_space_equal_the_tokenizer(text):
    test_cached_ids_equal_the_tokenizer(text)


# --- 3 quality -------------------------------------------------------------------------

def test_quality_on_held_out_rows(spark):
    sf = SF.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = quality.score(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert (out.predicted == out.quality).mean() > 0.98
    good = out[out.quality == 1]
    assert (good.predicted == 1).mean() > 0.99


def test_discriminant_equals_the_density_formula():
    rng = np.random.default_rng(0)
    factors = [np.linalg.cholesky(np.cov(rng.normal(size=(50, 3)).T) + np.eye(3)) for _ in range(2)]
    means = [rng.normal(size=3) for _ in range(2)]
    model = quality.Model(tuple(means), tuple(factors), (0.1, -0.2))
    x = rng.normal(size=(5, 3))
    logs = [c - 0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(f @ f.T), x - m) for m, f, c in zip(means, factors, (0.1, -0.2))]
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(logs[0] - logs[1])))


# --- 4 HTML ----------------------------------------------------------------------------

def test_html_extracts_the_article(spark):
    import html as entities

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = {r["page_id"]: r["text"] for r in html.extract(pages).collect()}
    same = 0
    rows = pages.collect()
    for r in rows:
        inner = r["html"][r["html"].index("<article>"):r["html"].index("</article>")]
        parts = [" ".join(entities.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        same += out[r["page_id"]] == "\n\n".join(b for b in parts if b)
    assert same / len(rows) > 0.98


@pytest.mark.parametrize("source, blocks", [
    ("<head><title>t</title><article><p>The article.", ["The article."]),
    ("<html><head><meta charset=u><title>t</title>The article.<p>More", ["The article.", "More"]),
    ("<head><title>t</title><style>s</style></head><body><p>a", ["a"]),
    ("<title>t</title><p>a", ["a"]),
    ("<head><title>t<body><p>a", ["a"]),
    *[(f"<article><p>a <{tag} class=i/>b</p><p>c</article>", ["a b", "c"]) for tag in ("svg", "iframe", "template")],
    ("<article><iframe src=x/><p>a</article><iframe src=y></iframe>", ["a"]),
    ("<article><svg><g><text>x</text><svg>y</svg>z</g></svg><p>a</article>", ["a"]),
    *[(f"<article><p>a <{tag}>x</p><p>b</p></article><p>c <{tag}>y</{tag}> d", ["a", "b", "c d"])
      for tag in ("button", "select", "textarea", "svg", "iframe", "template")],
    ("<article><button>x<p>a</p><p>b</article>", ["a", "b"]),
    ("<article><button>x<button>y</button> a <p>b</article>", ["a", "b"]),
    ("<article><button><div>x</div></button><p>a <select><option>x<option>y</select>b</article>", ["a b"]),
    ("<p title=it's>a</p><p title='b'>b's", ["a", "b's"]),
    ("<p title=\"a > b\" class = 'x>y'>a<a href=x?q=\"y>b</a> \"c\"", ["ab \"c\""]),
    ("<p>a<noscript> b</noscript></p><noscript><p>c</p></noscript>", ["a b", "c"]),
    ("<select-box>a</select-box><header>b</header>", ["a", "b"]),
])
def test_html_keeps_text_after_open_elements(source, blocks):
    assert [b[1] for b in html.parse(source).blocks] == blocks


def test_html_of_many_unclosed_elements_is_read_in_one_pass():
    page = html.parse("<article>" + "<button>x<select><p>a" * 30_000 + "</article>")
    assert [b[1] for b in page.blocks] == ["a"] * 30_000


def test_hierarchical_decoding_drops_descendants():
    page = html.parse("<div><p>a</p><div><p>b</p></div></div><p>c</p>")
    scores = np.zeros(len(page.tags))
    by_tag = dict(enumerate(page.tags))
    scores[:] = [{"div": -5.0, "p": 1.0}.get(by_tag[i], 0.0) for i in by_tag]
    assert html.decode(page, scores) == "c"  # the good p below rejected divs are rejected too
    scores[1] = 3.0
    assert html.decode(page, scores) == "a\n\nc"


_PARAGRAPH = ("The old harbour of the town was rebuilt after the great storm, and since then the fishing boats have returned "
              "every spring. Nobody knows how long this will go on, but the people are hopeful.")
_BODY = f"<h1>Title here</h1><p>{_PARAGRAPH}</p><p>Second. {_PARAGRAPH}</p>"
_BLOCKS = ["Title here", _PARAGRAPH, f"Second. {_PARAGRAPH}"]


def test_html_text_directly_beside_the_article(spark):
    """Runs of text beside an article go, runs inside it stay, so do its header's title and pages of bare text."""
    cases = [
        (f"<body>Skip to content <a>Login</a> Subscribe now<article>{_BODY}</article>Copyright 2024 Example Corp</body>", _BLOCKS),
        (f"<body><div>Home | News | Sport<div class=content>{_BODY}</div></div></body>", _BLOCKS),
        (f"<body><article><header><h1>Title here</h1></header><p>{_PARAGRAPH}</p></article></body>", _BLOCKS[:2]),
        (f"<header><h1>Site</h1></header><article><header class=entry-header><h1>Title here</h1></header><p>{_PARAGRAPH}</p></article>",
         _BLOCKS[:2]),
        (f"<article>{_PARAGRAPH}<p>b {_PARAGRAPH}</p>c {_PARAGRAPH}</article>", [_PARAGRAPH, f"b {_PARAGRAPH}", f"c {_PARAGRAPH}"]),
        (_PARAGRAPH, [_PARAGRAPH]), (f"<body>{_PARAGRAPH}</body>", [_PARAGRAPH]), (f"<div>{_PARAGRAPH}<br>{_PARAGRAPH}</div>", [f"{_PARAGRAPH} {_PARAGRAPH}"]),
        ("", []), (None, []),
    ]
    given = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    own = spark.createDataFrame([(10**9 + i, "u", source) for i, (source, _) in enumerate(cases)], "page_id long, url string, html string")
    out = {r["page_id"]: r["text"] for r in html.extract(given.union(own)).collect()}
    assert [out[10**9 + i] for i in range(len(cases))] == ["\n\n".join(blocks) for _, blocks in cases]


def test_runs_beside_blocks_are_leaves():
    page = html.parse("<div>a<p>b</p>c</div><p>d<br>e</p>")
    assert page.tags == ["#page", "div", "#text", "p", "#text", "p"] and page.parents == [-1, 0, 1, 1, 1, 0]
    assert [(e, t) for e, t, _ in page.blocks] == [(2, "a"), (3, "b"), (4, "c"), (5, "d e")]
    scores = np.array([0, 1.0, -1, 1, -1, 1])
    assert html.decode(page, scores) == "b\n\nd e"


# --- 5 repeated substrings -------------------------------------------------------------

@pytest.mark.parametrize("big", [2000, 1])
def test_repeats_against_brute_force(spark, docs, monkeypatch, big):
    monkeypatch.setattr(substrings, "BIG_BUCKET", big)
    periodic = [(10_000, "ab" * 300), (10_001, "x" * 199), (10_002, "y" * 200), (10_003, "y" * 200 + "é" * 5)]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(periodic, "doc_id long, text string"))
    data = {r["doc_id"]: r["text"].encode() for r in df.collect()}
    counts = Counter(b[i:i + 200] for b in data.values() for i in range(len(b) - 199))
    for r in substrings.remove_repeats(df).collect():
        b = data[r["doc_id"]]
        mark = bytearray(len(b))
        for i in range(len(b) - 199):
            if counts[b[i:i + 200]] > 1:
                mark[i:i + 200] = b"\1" * 200
        kept = bytes(x for x, m in zip(b, mark) if not m)
        spans = len(re.findall(b"\1+", bytes(mark)))
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (
            len(b), sum(mark), spans, hashlib.sha256(kept).hexdigest())


# --- 6 decontamination -----------------------------------------------------------------

def _edit_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern):
        before, row = row, [i + 1]
        for j, b in enumerate(text):
            row.append(min(before[j] + (a != b), before[j + 1] + 1, row[j] + 1))
    return min(row)


def test_myers_equals_dynamic_programming():
    pick = random.Random(1)
    for _ in range(500):
        p, t = ("".join(pick.choices("ab c", k=pick.randint(a, 14))) for a in (1, 0))
        assert decontam.myers(p, t) == _edit_distance(p, t)


def test_edited_items_are_found(spark):
    pick, items = random.Random(2), table(spark, "benchmark").collect()
    rows, want = [], {}
    for n, item in enumerate(items[:20]):
        text = decontam.normalise(item["text"])
        edits = len(text) // decontam.CHARS_PER_EDIT
        chars = list(text)
        for at in pick.sample(range(len(chars)), edits + (n % 4 == 3) * (edits + 20)):
            chars[at] = "#"
        edited = "before it " + "".join(chars) + " and after"
        rows.append((n, edited.upper() if n % 2 else edited))
        want[n] = _edit_distance(text, decontam.normalise(edited)) <= edits
    out = decontam.contamination(spark.createDataFrame(rows, "doc_id long, text string"), table(spark, "benchmark"), block_bytes=1000)
    got = {r["doc_id"]: str(items[r["doc_id"]]["item_id"]) in (r["item_ids"] or "").split(",") for r in out.collect()}
    assert got == want and set(want.values()) == {True, False}


def test_one_block_of_items_at_a_time(spark, docs, monkeypatch):
    """Each block's hits are written before the next block is collected; the results don't
    depend on the number of blocks."""
    items = table(spark, "benchmark")
    first = items.orderBy("item_id").first()
    extra = [(77_001, "before. " + first["text"] + " after."), (77_001, "before. " + first["text"] + " after."),
             (None, first["text"]), (77_002, None), (77_003, "")]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string")).withColumn("digest", F.lit(1))
    events, write, read = [], decontam.shared_table, decontam.blocks
    monkeypatch.setattr(decontam, "shared_table", lambda *a: events.append("write") or write(*a))
    monkeypatch.setattr(decontam, "blocks", lambda *a, **k: (events.append("block") or b for b in read(*a, **k)))
    whole = [sorted(map(str, f(df, items).collect())) for f in (decontam.contamination, decontam.keep_clean)]
    assert events == ["block", "block"]
    for f, expected in zip((decontam.contamination, decontam.keep_clean), whole):
        events.clear()
        assert sorted(map(str, f(df, items, block_bytes=4000).collect())) == expected
        assert len(events) > 4 and events == ["block", "write"] * (len(events) // 2) + ["write"]



# --- 7 secrets -------------------------------------------------------------------------

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def _base_spans(text):
    spans = [(m.start(), 0, "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return sorted(spans + [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32])


@pytest.fixture(scope="module")
def secret_rows(pdocs):
    pick = random.Random(5)
    parts = ["token=", "secret : ", "Api_Key = '", "PASSWORD:\"", "token=token=", "AKIA", "é🎉 ", "deadbeef" * 4, "A1" * 8, "x\n", "'", "abcdefgh",
             " ", "=", "short", "AKIAAKIA", "f" * 31, "g", "ghp_" + "a1" * 20, "xoxb-1234567890ab"]
    texts = ["".join(pick.choices(parts, k=pick.randint(1, 12))) for _ in range(300)] + [("token=abcdefgh1 " * 1500), ""]
    return [(100_000 + i, t) for i, t in enumerate(texts)] + list(zip(pdocs.doc_id.tolist(), pdocs.text))


def test_secrets_against_python(spark, secret_rows):
    out = secrets.digest(secrets.scan_secrets(spark.createDataFrame(secret_rows, "doc_id long, text string"))).collect()
    by_id = {r["doc_id"]: r for r in out}
    for i, text in secret_rows:
        spans = _base_spans(text)
        want = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans).encode()).hexdigest()
        assert by_id[i]["base_sha256"] == want, text
        assert [by_id[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[2] == k for s in spans) for k in ("assign", "access", "hex")]
        base = {f"{k}:{a}:{b}" for a, _, k, b in spans}
        assert base <= set(by_id[i]["spans"].split(","))


def test_redaction_leaves_no_secret(spark, secret_rows):
    df = spark.createDataFrame(secret_rows, "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    for i, text in secret_rows:
        assert (out[i] == text) == (not _base_spans(text) and not re.search(r"gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10}", text))
        covered = [False] * len(text)
        for a, _, _, b in _base_spans(text):
            covered[a:b] = [True] * (b - a)
        rest = "".join(c for c, x in zip(text, covered) if not x)
        assert len(out[i].replace("[SECRET]", "")) <= len(rest)


def test_trigram_queries():
    assert secrets.trigram_query("[0-9a-f]{32,}") is True
    assert secrets.trigrams(secrets.trigram_query("AKIA[A-Z0-9]+")) == {"aki", "kia"}
    pick = random.Random(7)
    for rule in secrets.RULES:  # every match satisfies its rule's query
        query = secrets.trigram_query(rule.pattern)
        samples = ["token=abcdefgh", "api_key: 'abcdefgh1", "AKIA" + "A" * 12, "ghp_" + "a" * 36, "xoxp-" + "1" * 10, "rk_live_" + "a" * 16,
                   "-----BEGIN RSA PRIVATE KEY-----", "AIza" + "b" * 35, "https://user:pass@host", "eyJ" + "a" * 8 + ".eyJ" + "b" * 8 + "." + "c" * 8]
        for s in pick.sample(samples, len(samples)):
            if (m := re.search(rule.pattern, s)) and query is not True:
                low = m[0].lower()
                holds = lambda q: q in low if isinstance(q, str) else (all if q[0] == "and" else any)(map(holds, q[1]))
                assert holds(query)


# --- 8 licenses ------------------------------------------------------------------------

def test_licenses_against_python(docs, pdocs, spark):
    extra = [(50_000, "cc by cc by CC-BY cc, by. gpl General Public LICENSE all rights; reserved"), (50_001, "by cc"), (50_002, "cc é by")]
    rows = list(zip(pdocs.doc_id.tolist(), pdocs.text)) + extra
    out = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
        places, labels = [], set()
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            here = [k for k in range(len(words)) if words[k:k + len(p)] == p]
            places += here
            labels |= {label} if here else set()
        r = out[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert labels <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_license_labels_against_all_positions():
    """Labels, score and base places equal a scan of every template at every position."""
    pick = random.Random(8)
    spare = sorted({w for t in licenses.TEMPLATES for w in t.text.split()} | {"cc", "by", "all", "rights", "reserved", "x", "y"})
    idf = {w.encode(): pick.choice([0.0, 0.5, 1.0, 1.0, 3.0, 6.0]) for w in spare if w != "x"}  # with ties
    index = licenses.Index(licenses.TEMPLATES, licenses.PHRASES, idf)
    some = lambda: " ".join(pick.choices(spare, k=pick.randint(0, 12)))
    hits = 0
    for _ in range(3000):
        own = pick.choice(licenses.TEMPLATES).text.split()
        own = [w if pick.random() < 0.9 else pick.choice(spare) for w in own][pick.choice((0, 0, 0, 2)):]
        text = " ".join([some(), *own, some(), pick.choice(["", "cc by", "all rights reserved"]), some()])
        found, out = licenses.words(text), index.scan(text)
        shares = [(e, p, e.share(found, p)) for e in index.entries for p in range(-len(e.words), len(found))]
        kept = [(e, p, x) for e, p, x in shares if x >= licenses.MIN_SHARE]
        places = sorted(p for e, p, x in kept if e.phrase)
        assert out["labels"] == ",".join(sorted({e.label for e, _, _ in kept}))
        assert out["score"] == max((x for _, _, x in kept), default=0.0)
        assert (out["n_base"], out["first_word"]) == (len(places), min(places, default=None))
        hits += bool(kept)
    assert hits > 1000


@pytest.mark.parametrize("text, labels", [
    ("GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", "gpl,lgpl"),
    ("GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "gpl,gpl-2"),
    ("Redistributions of source code must retain the above copyright notice, this list", "bsd"),
    ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED", "mit"),
    ("# SPDX-License-Identifier: Apache-2.0", "apache-2.0"), ("SPDX-License-Identifier: MIT", "mit"),
    ("the apache of the license, version of a lesser public", "")])
def test_license_labels(text, labels):
    idf = {w: 1.0 for t in licenses.TEMPLATES for w in licenses.words(t.text)}
    assert licenses.Index(licenses.TEMPLATES, licenses.PHRASES, idf).scan(text)["labels"] == labels


# --- 9 near duplicates -----------------------------------------------------------------

def _sets(rows):
    out = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
        out[i] = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    return out


def _components(sets, percent):
    shared, at = Counter(), defaultdict(list)
    for i, s in sets.items():
        for x in s:
            shared.update((j, i) for j in at[x])
            at[x].append(i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def test_near_duplicates_against_all_pairs(spark, pdocs):
    """With a group of many near copies, of which some are linked with a few others only."""
    pick = random.Random(9)
    base = [f"w{pick.randint(0, 99)}" for _ in range(150)]
    rows = list(zip(pdocs.doc_id.tolist(), pdocs.text))
    for n in range(600):
        copy = list(base)
        for at in pick.sample(range(150), pick.choice([0, 1, 2, 3, 4])):
            copy[at] = f"q{pick.randint(0, 9999)}"
        rows.append((20_000 + n, " ".join(copy)))
    sets = _sets(rows)
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()
    want = _components(sets, 85)
    assert {r["doc_id"]: r["component_id"] for r in out} == want
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) and r["kept"] == (want[r["doc_id"]] == r["doc_id"]) for r in out)


def test_near_duplicates_of_a_chain_without_links(spark):
    """1,200 texts of which each resembles its neighbours below the threshold: one cluster of
    candidates, but only the two copies with a word added are linked."""
    pick = random.Random(4)
    words = [f"w{pick.randint(0, 10**6)}" for _ in range(1200 * 20 + 200)]
    rows = [(n, " ".join(words[20 * n:20 * n + 150])) for n in range(1200)]
    rows += [(5000 + n, rows[n][1] + " tail") for n in (300, 900)]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {n: n - 5000 if n >= 5000 else n for n, _ in rows}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 300)] + [(7, 7)]
    out = graph.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r["node"]: r["component"] for r in out} == {**{i: 1 for i in range(1, 61)}, **{100 + i: 100 for i in range(300)}}


# --- 10 token counts -------------------------------------------------------------------

def test_token_counts_against_viterbi(docs, pdocs):
    scores, byte = tokencount.piece_scores(Q.PIECES)

    def tokens(word):
        s, best = tokencount.MARK + word, [(0.0, 0)]
        for end in range(1, len(s) + 1):
            ways = [(best[a][0] + scores[s[a:end]], -best[a][1] - 1) for a in range(max(0, end - 20), end) if s[a:end] in scores]
            if s[end - 1] not in scores:
                n = len(s[end - 1].encode())
                ways.append((best[end - 1][0] + n * byte, -best[end - 1][1] - n))
            score, n = max(ways)
            best.append((score, -n))
        return best[-1][1]

    out = {r["doc_id"]: r for r in tokencount.token_counts(docs, Q.PIECES).collect()}
    known = {}
    for i, text in zip(pdocs.doc_id, pdocs.text):
        words = text.split()
        assert out[i]["n_pretokens"] == len(words)
        assert out[i]["n_tokens"] == sum(known.setdefault(w, None) or known.update({w: tokens(w)}) or known[w] for w in words)
