"""The pipeline's stages: columns, decisions, and the whole against a brute-force version."""

import __spark_entry__ as E
import corpus_pipeline as P
import pytest
from conftest import SF, edge_rows, table

from urbanlens.llm import decontam
from urbanlens.llm.common import shared_table


def test_every_operator_and_the_pipeline_are_registered():
    keys = E.queries()
    assert "pipeline" in keys and {k.split("_")[0] for k in keys if k.startswith("op")} >= {f"op{n}" for n in range(1, 11)}
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "decontaminate", "secrets", "pack"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, "documents"), []
    for name, stage in P.STAGES:
        docs = shared_table(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def test_stages_keep_columns_and_take_effect(spark, stages):
    from test_operators import _components, _sets

    start = table(spark, "documents")
    assert all(s.columns == start.columns for s in stages[:-1])
    good, distinct, clean, masked = [s.toPandas().set_index("doc_id").text for s in stages[:-1]]
    labels = table(spark, "labels").toPandas().set_index("doc_id").quality
    known = good.index.intersection(labels.index)
    assert (labels[known] == 1).mean() > 0.98
    groups = _components(_sets(good.items()), 80)
    assert set(distinct.index) == {i for i, g in groups.items() if i == g}
    items = [decontam.normalise(r["text"]) for r in table(spark, "benchmark").collect()]
    assert not any(i in decontam.normalise(t) for t in clean for i in items)
    assert set(masked.index) == set(clean.index) and all(t == clean[i] or "[SECRET]" in t for i, t in masked.items())
    pieces = stages[-1].toPandas()
    assert set(pieces.doc_id) == set(masked.index)
    assert all(g.length.sum() == g.doc_tokens.iloc[0] for _, g in pieces.groupby("doc_id"))


def test_stages_on_edge_rows(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in P.STAGES[:-1]:
            after = shared_table(stage(spark, docs, SF), f"edge-{name}")
            assert after.columns == docs.columns and after.count() <= docs.count()
            docs = after
        P.STAGES[-1][1](spark, docs, SF).collect()


def test_near_duplicate_stage_keeps_one_of_repeated_rows(spark, edge_docs):
    kept = [r["doc_id"] for r in P.distinct(spark, edge_docs, SF).collect()]
    assert kept.count(17) == 1 and 5 in kept and not {6, 9} & set(kept)  # 9 differs by its first words only
    assert kept.count(None) == [i for i, _ in edge_rows()].count(None)
