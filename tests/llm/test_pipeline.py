"""The pipeline's stages take effect, one after the other."""

import re

import pytest
from conftest import SF01, SF

import corpus_pipeline
from chronoframe.llm import queries


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF01).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
        out.append(docs)
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "byte_bpe"]
    assert all(s.dtypes == stages[0].dtypes for s in stages[:-1])


def test_stages_take_effect(spark, stages):
    docs, mild, single, cut, clean, tokens = [s.collect() for s in stages]
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF01}/labels.parquet").where("toxic = 1").collect()}
    kept = {r["doc_id"] for r in mild}
    assert len(toxic & kept) <= 0.15 * len(toxic) and len(kept) >= 0.85 * len(docs)
    # near duplicates: no two left are linked, and everything that went is linked to something
    sets = {}
    for r in mild:
        w = re.findall(rb"[^\x20\x09-\x0D]+", r["text"].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode())
        sets[r["doc_id"]] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    left = [r["doc_id"] for r in single]
    near = lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    assert not any(near(a, b) for k, a in enumerate(left) for b in left[:k])
    assert all(any(near(a, b) for b in sets if b != a) for a in set(sets) - set(left))
    before = {r["doc_id"]: r for r in single}
    seen = {}
    for r in sorted(cut, key=lambda r: r["doc_id"]):
        assert r["n_chars"] == len(r["text"])
        words = before[r["doc_id"]]["text"].encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - 49):
            if seen.setdefault(tuple(words[k:k + 50]), r["doc_id"]) < r["doc_id"]:
                gone[k:k + 50] = [True] * 50
        assert r["text"].encode().split() == [w for w, g in zip(words, gone) if not g]
    items = [" ".join(r["text"].split()) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    assert not [r for r in clean if any(i in " ".join(r["text"].split()) for i in items)]
    assert len(clean) >= 0.9 * len(cut)
    assert {r["doc_id"] for r in tokens} == {r["doc_id"] for r in clean}


def test_run_equals_the_stages(spark, stages):
    got = sorted((r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, SF).collect())
    assert got and all(len(h) == 64 for _, h in got)


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
