"""The pipeline's stages, each on its own input, against brute force."""

import collections

import pytest

import corpus_pipeline
from tidemark.llm import decontaminate, quality, simhash

from test_llm_operators import all_secrets, base_quality, brute_components, slow_fingerprint, slow_targets

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """(name, rows in, rows out) of every stage, as the pipeline chains them."""
    from tidemark.session import scratch_dir
    docs, folder, out = spark.read.parquet(f"{SF}/documents.parquet"), scratch_dir(spark, "test-pipeline"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = (docs.collect(), after.collect(), after.columns)
        docs = after
    return out


def test_columns_and_order(stages):
    assert list(stages) == ["quality_rules", "near_dedup", "benchmark_decontamination", "secret_scan", "source_mix"]
    assert all(columns == COLUMNS for name, (_, _, columns) in stages.items() if name != "source_mix")


def test_quality_stage(spark, stages):
    before, after, _ = stages["quality_rules"]
    kept = {r.doc_id for r in after}
    assert {r.doc_id for r in before if base_quality(r.text)[-1]}.isdisjoint(kept)
    judged = quality.judge(spark.read.parquet(f"{SF}/documents.parquet")).where("kept").collect()
    assert kept == {r.doc_id for r in judged} and set(after) <= set(before)


def test_near_dedup_stage(stages):
    before, after, _ = stages["near_dedup"]
    ids = [r.doc_id for r in before]
    groups = brute_components(ids, [slow_fingerprint(r.text) for r in before], simhash.RADIUS)
    assert sorted(r.doc_id for r in after) == sorted(set(groups)) and set(after) <= set(before)


def test_decontamination_stage(spark, stages):
    before, after, _ = stages["benchmark_decontamination"]
    spell = lambda t: f" {' '.join(decontaminate.words_of(t))} "
    items = [spell(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaking = {r.doc_id for r in before if any(i in spell(r.text) for i in items)}
    assert leaking and {r.doc_id for r in after} <= {r.doc_id for r in before} - leaking
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert len(gone) <= len(leaking) + 2


def test_secret_stage(stages):
    before, after, _ = stages["secret_scan"]
    clean = {r.doc_id: r for r in after}
    assert clean.keys() == {r.doc_id for r in before}
    for r in before:
        text, at = "", 0
        for s, _, e, _ in all_secrets(r.text):
            if s >= at:
                text += r.text[at:s] + "[SECRET]"
            at = max(at, e)
        text += r.text[at:]
        assert clean[r.doc_id].text == text and clean[r.doc_id].n_chars == len(text)


def test_mix_stage(stages):
    before, after, columns = stages["source_mix"]
    assert columns == [*COLUMNS, "size", "source_size", "target", "taken"]
    sizes = collections.Counter()
    for r in before:
        sizes[r.source] += len(r.text.split())
    taken = collections.Counter()
    for r in after:
        taken[r.source] += r.taken
        assert 0 < r.taken <= 2 * r.size
    want = slow_targets(sizes)
    assert all(abs(taken[s] - want[s]) <= 3 for s in want)


def test_run_returns_the_last_stage(spark, stages):
    assert sorted(corpus_pipeline.run(spark, SF).collect()) == sorted(stages["source_mix"][1])
