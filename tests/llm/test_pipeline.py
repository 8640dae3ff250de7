"""The pipeline stage by stage against brute force on a whole small table."""

import brute
import pytest

import corpus_pipeline
from floodmark.llm import quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, fn in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        fn(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs))
    return dict(out)


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns(stages):
    names = list(stages)
    assert all(stages[n].columns == stages["documents"].columns for n in names[:-1])
    assert "sequence_id" in stages[names[-1]].columns


def test_quality_stage(stages):
    kept = {i for i, _ in rows(stages["quality_rules"])}
    verdict = {r["doc_id"]: r["kept"] for r in quality.judge(stages["documents"], ["doc_id"]).collect()}
    assert kept == {i for i in verdict if verdict[i]}
    for i, text in rows(stages["documents"]):
        n, _, _, _, repeated = brute.quality(text)
        assert i not in kept or not (n < 20 or 100 * repeated > 30 * n)


def test_duplicate_stages(stages):
    before = rows(stages["quality_rules"])
    exact = brute.exact(before)
    assert {i for i, _ in rows(stages["exact_duplicates"])} == {i for i in exact if exact[i][2]}
    near = brute.near(rows(stages["exact_duplicates"]), 5, 80)
    assert {i for i, _ in rows(stages["near_duplicates"])} == {i for i in near if near[i][1] == i}


def test_secret_stage(stages):
    before, after = dict(rows(stages["near_duplicates"])), dict(rows(stages["secret_scan"]))
    assert set(before) == set(after)
    assert not any(brute.secrets(t) for t in after.values())
    assert all(r["n_chars"] == len(r["text"]) for r in stages["secret_scan"].collect())


def test_packing_stage_and_run(spark, stages):
    packed = stages["pack_sequences"]
    assert {r["doc_id"] for r in packed.collect()} == {i for i, _ in rows(stages["secret_scan"])}
    assert corpus_pipeline.run(spark, SF).count() == packed.count()
