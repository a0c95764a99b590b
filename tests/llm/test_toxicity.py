"""Toxicity: accuracy on rows never learned from, and defined results.

About one toxic label in fifteen of this table is on a text without any toxic word, and only
some 350 toxic texts can be learned from; see the README for larger tables.
"""

import zlib

import pyarrow as pa
import pytest

from mercatura.llm import toxicity
from mercatura.llm.registry import QUERIES

MEDIUM = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    return labels, QUERIES["op8_toxicity"](spark, MEDIUM).collect()


def test_held_out_accuracy(scored):
    labels, rows = scored
    known = [r for r in rows if r.held_out and r.doc_id in labels]
    toxic = [r for r in known if labels[r.doc_id] == 1]
    clean = [r for r in known if labels[r.doc_id] == 0]
    assert sum(r.predicted for r in toxic) >= 0.7 * len(toxic) > 0
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_every_row_has_a_score(scored, spark):
    _, rows = scored
    assert len(rows) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def model():
    rude = [f"plain words number {i} and then grumblefoot said w{i}\nline {i * i}" for i in range(60)]
    fine = [f"plain words number {i} and then nobody said w{i}\nline {i + 7} is fine" for i in range(200)]
    return toxicity.fit(rude, fine)


def test_scores_of_odd_texts_and_extra_columns(spark):
    fitted = model()
    texts = [None, "", " ", "w" * 100_000, "x " * 50_000, "so grumblefoot it is", "so nobody it is"]
    texts += ["z" * 100 + "grumblefoot" + "z" * 100, "GRUMBLEFOOT!"]
    rows = [(i, t, 0.0) for i, t in enumerate(texts)] + [(None, "grumblefoot", 1.0), (5, texts[5], 1.0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, score double")
    got = toxicity.score(table, fitted).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[0] == by_id[1] == by_id[2] == 0
    assert by_id[5] > 0.5 and by_id[5] > by_id[6] and by_id[8] > 0.5
    kept = toxicity.keep_clean(table, fitted)
    assert kept.columns == table.columns and {5, None}.isdisjoint(r.doc_id for r in kept.collect())
    assert toxicity.score(table.limit(0), fitted).count() == 0
    assert toxicity.keep_clean(table.limit(0), fitted).count() == 0


def test_learning_ignores_the_held_out_fold_and_bad_labels(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(toxicity, "fit", lambda toxic, plain: seen.update(toxic=toxic, plain=plain))
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(50)] + [(None, 1), (3, None), (999, 1), (4, 1)]
    toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    allowed = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5]
    toxic = {f"text {i}" for i in allowed if i % 2 or i == 4}
    assert set(seen["toxic"]) == toxic and set(seen["plain"]) == {f"text {i}" for i in allowed} - toxic


def test_one_sided_or_no_labels():
    nothing = pa.array(["any", None])
    assert toxicity.fit([], []).scorer().scores(nothing).tolist() == [0, 0]
    assert toxicity.fit(["rude"], []).scorer().scores(nothing).tolist() == [1, 1]
    assert toxicity.fit([], ["fine"]).scorer().scores(nothing).tolist() == [0, 0]
    few = toxicity.fit(["rude words"], ["fine words"])
    assert all(0 <= s <= 1 for s in few.scorer().scores(nothing))
