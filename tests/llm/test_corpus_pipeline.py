"""The pipeline: each stage's decisions take effect, columns stay, empty input passes."""

from __future__ import annotations

import pytest

import corpus_pipeline
from anaquel.llm import queries
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def sf_dir(spark, docs_of, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    shared = "This very line is found in a great many of the documents."
    passage = prose(4242, 40)
    base = prose(77, 200)
    rows, labels = [], []
    for i in range(240):
        text = f"{prose(i, 60)}\n{prose(3000 + i, 30)}"
        if i % 8 == 0:
            text += " nasty vile words"
            labels.append((i, 1, 1))
        elif i % 2:
            labels.append((i, 1, 0))
        if i % 10 == 3:
            text = f"{shared}\n{text}"
        if i % 20 == 5:
            text += f" {passage}"
        rows.append((i, text, f"s{i % 4}"))
    rows += [(500, base, "s0"), (501, base, "s1"), (502, " ".join([*base.split()[:50], "changed", *base.split()[51:]]), "s2")]
    docs_of(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        seen[name] = {r.doc_id: r for r in docs.collect()}
        docs = spark.createDataFrame(list(seen[name].values()), docs.schema)
        if name != "mixing":
            assert docs.columns == columns
    toxic = {i for i in range(240) if i % 8 == 0}
    assert set(seen["toxicity"]) == set(range(240)) - toxic | {500, 501, 502}
    assert set(seen["line_dedup"]) == set(seen["toxicity"])
    holders = [i for i, r in seen["line_dedup"].items() if "great many" in r.text]
    assert holders == [233]
    assert set(seen["line_dedup"]) - set(seen["near_dedup"]) == {501, 502}
    assert set(seen["near_dedup"]) - set(seen["decontamination"]) == {i for i in range(240) if i % 20 == 5} - toxic
    mixed = seen["mixing"]
    assert set(mixed) <= set(seen["decontamination"]) and all(r.taken > 0 for r in mixed.values())


def test_run_is_the_stages_in_a_row(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows and {"doc_id", "text", "taken", "target"} <= set(rows[0].asDict())


def test_empty_documents(spark, sf_dir, docs_of):
    docs = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.collect() == []


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(queries.SQL) <= set(queries.QUERIES)
