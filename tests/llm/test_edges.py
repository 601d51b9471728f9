"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, clashing
columns and empty tables; results are checked against the docstrings' definitions."""

import public_tokenizers
import pytest
from conftest import edge_rows, table

from urbanlens.llm import (decontam, fingerprints, html, licenses, neardup, packing, quality, secrets, substrings,
                           tokencount)
from urbanlens.llm.queries import PIECES, RANKS

OPS = {
    "op1": lambda s, d: fingerprints.edit_report(d),
    "op3": lambda s, d: quality.score(d, table(s, "labels")),
    "op5": lambda s, d: substrings.remove_repeats(d),
    "op6": lambda s, d: decontam.contamination(d, table(s, "benchmark")),
    "op7": lambda s, d: secrets.digest(secrets.scan_secrets(d)),
    "op8": lambda s, d: licenses.scan_licenses(d),
    "op9": lambda s, d: neardup.near_duplicates(d, 85),
    "op10": lambda s, d: tokencount.token_counts(d, PIECES),
}


@pytest.mark.parametrize("op", OPS)
def test_one_row_per_document(spark, edge_docs, op):
    out = OPS[op](spark, edge_docs).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(i) for i, _ in edge_rows())
    # repeated rows give equal results (winnowing and packing depend on the neighbour)
    if op != "op1":
        assert len({r for r in out if r["doc_id"] == 9}) == 1


@pytest.mark.parametrize("op", OPS)
def test_empty_table(spark, no_docs, op):
    assert OPS[op](spark, no_docs).collect() == []


def test_packing_edges(spark, edge_docs, no_docs):
    out = packing.pack(edge_docs, RANKS).collect()
    assert sum(r["length"] for r in out if r["doc_id"] == 2) == 1  # the end id alone
    assert sum(r["length"] for r in out if r["doc_id"] == 9) == 2 * next(r["doc_tokens"] for r in out if r["doc_id"] == 9)
    assert packing.pack(no_docs, RANKS).collect() == []


def test_html_edges(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", None, "z", "z"), (2, None, "", "z", "z"), (None, "u", "<p>loose", "z", "z"), (3, "u", "no markup & all", "z", "z"),
            (4, "u", "<article><p>a<p>b  c</article></div></p>", "z", "z"), (4, "u", "<article><p>a<p>b  c</article></div></p>", "z", "z"),
            (5, "u", "<script>x", "z", "z"), (6, "u", "<" * 2000 + "a href=\"" * 50, "z", "z"),
            (7, "u", "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "z", "z")]
    out = html.extract(spark.createDataFrame(rows, schema)).collect()
    got = {r["page_id"]: r["text"] for r in out}
    assert len(out) == len(rows) and got[1] == got[2] == got[5] == ""
    assert got[4] == "a\n\nb c" and got[7] == "deep"
    assert all(r["n_chars"] == len(r["text"]) for r in out)
    assert html.extract(spark.createDataFrame([], schema)).collect() == []


def test_near_duplicate_definitions(spark, edge_docs):
    out = {}
    for r in neardup.near_duplicates(edge_docs, 85).collect():
        out.setdefault(r["doc_id"], []).append(r)
    assert [out[i][0]["component_id"] for i in (1, 2, 3, 5, 6)] == [1, 2, 3, 5, 5]  # empty sets are not linked
    assert out[1][0]["n_shingles"] == 0 and out[4][0]["n_shingles"] == 1
    assert out[16][0]["component_id"] == 8
    assert all(r["component_id"] is None and r["kept"] for r in out[None])


def test_without_labels_every_score_is_half(spark, edge_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.score(edge_docs, labels).collect()} == {0.5}


def test_without_items_nothing_is_contaminated(spark, edge_docs):
    items = spark.createDataFrame([(1, None), (2, " ")], "item_id long, text string")
    assert not any(r["contaminated"] for r in decontam.contamination(edge_docs, items).collect())


def test_vocabulary_files_are_parameters():
    assert RANKS == public_tokenizers.path("byte_bpe_50k.tiktoken")
