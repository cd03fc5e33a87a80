import re

import pytest

import __spark_entry__
import corpus_pipeline
from wordloom.llm import cotraining, packing, rules, secrets, simhash

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that each stage gets, then the last one's, written and read again as Parquet."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_and_their_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "simhash_dedup", "secret_scan", "best_fit_packing"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_each_stage_does_what_its_operator_decides(spark, stages):
    docs, judged, ruled, single, clean, packed = stages
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert ids(judged) == ids(cotraining.classify(docs, labels).where("kept"))
    assert ids(ruled) == ids(rules.judged(judged.select("doc_id", "text"), keep=["doc_id"]).where("kept"))
    assert ids(single) == sorted({r.component_id for r in simhash.near_duplicates(ruled).collect()})
    assert ids(clean) == ids(single)
    found = {r.doc_id: r.secrets for r in secrets.scan(single, keep={"doc_id": "doc_id"}).collect()}
    before = {r.doc_id: r.text for r in single.collect()}
    for r in clean.collect():
        wanted = before[r.doc_id]
        for s in reversed(found[r.doc_id]):
            wanted = wanted[:s.start] + "<SECRET>" + wanted[s.end:]
        assert r.text == wanted and r.n_chars == len(wanted)
    assert sum(map(len, found.values())) > 0 and not any(re.search(r'token = "[0-9a-f]{40}"', r.text) for r in clean.collect())
    assert sorted({r.doc_id for r in packed.collect()}) == ids(clean)
    assert packed.groupBy("bin_id").sum("n_tokens").where("`sum(n_tokens)` > 2048").isEmpty()


def test_labels_are_kept_and_rejected_as_stated(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged, docs = set(ids(stages[1])), set(ids(stages[0]))
    assert all(i in judged for i in docs if labels.get(i) == 1)
    assert not any(i in judged for i in docs if labels.get(i) == 0)


def test_run_gives_the_last_stage(spark, stages):
    result = corpus_pipeline.run(spark, SF)
    assert result.columns == stages[-1].columns
    assert sorted(map(str, result.select("doc_id", "piece", "n_tokens").collect())) == sorted(
        map(str, stages[-1].select("doc_id", "piece", "n_tokens").collect()))


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if re.match(r"op\d", n)} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_take_edge_rows_and_empty_tables(spark, edge_docs, no_docs, stage):
    for docs in (edge_docs, no_docs):
        result = stage(spark, docs, SF)
        assert result.count() <= max(1, 600)
        if stage is not corpus_pipeline.best_fit_packing:
            assert result.columns == docs.columns
