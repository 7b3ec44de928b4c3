"""Toxicity and line-quality models: exact search, forward-backward by enumeration, held-out accuracy, edge rows."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest

from silvertide.llm import labelled, line_crf, toxicity

SF = "/root/testdata/sf0.01"


def held(doc_id, folds, out):
    return zlib.crc32(str(doc_id).encode()) % folds == out


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    return (rank[label == 1].mean() - (label.sum() + 1) / 2) / (len(label) - label.sum())


def test_block_max_search_is_exact():
    rng = np.random.default_rng(1)
    for n in (1, 5, 64, 700):
        dense = rng.random((n, 40)) * (rng.random((n, 40)) < 0.15)
        dense[rng.integers(n)] = dense[0]
        dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-12)
        rows, terms = np.nonzero(dense)
        index = toxicity.BlockMaxIndex(rows, terms, dense[rows, terms], n, 40)
        for _ in range(60):
            query = rng.random(40) * (rng.random(40) < 0.2)
            if not query.any():
                continue
            query /= np.linalg.norm(query)
            own = np.flatnonzero(query)
            skip = int(rng.integers(-1, n))
            near, similarity = index.nearest(own, query[own], 10, without=skip)
            want = dense @ query
            if skip >= 0:
                want[skip] = 0
            best = np.sort(want[want > 1e-12])[::-1][:10]
            assert np.allclose(similarity, best) and np.allclose(want[near], similarity)
            assert skip not in near


def test_toxicity_finds_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in toxicity.toxicity_report(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == held(r.doc_id, 4, 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    rows = [(got[r.doc_id].score, r.toxic) for r in labels.collect() if held(r.doc_id, 4, 2)]
    score, label = np.array([s for s, _ in rows]), np.array([t for _, t in rows])
    assert auc(score, label) > 0.9
    assert any(r.evidence for r in got.values())


def test_held_out_labels_are_not_used(spark):
    docs, labels = (spark.read.parquet("/root/testdata/sf0.001/" + t + ".parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    flipped = labels.withColumn("toxic", F.when(labelled.fold(F.col("doc_id"), 4) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    flipped = flipped.withColumn("quality", F.when(labelled.fold(F.col("doc_id"), 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    key = lambda df: sorted((r.doc_id, r.score) for r in df.collect())
    for report in (toxicity.toxicity_report, line_crf.quality_report):
        assert key(report(docs, labels)) == key(report(docs, flipped)) == key(report(docs.repartition(5), labels))


@pytest.mark.parametrize("report", [toxicity.toxicity_report, line_crf.quality_report])
def test_edge_rows(spark, documents, labels, report):
    rng = random.Random(2)
    say = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    good, bad = ["calm", "tree", "river", "stone"], ["vile$$$", "nasty###", "foul***", "grim%%%"]
    rows = [(i, say(bad if i % 3 == 0 else good, 30) + "\n" + say(good, 10)) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "\n \n"), (503, say(good, 40_000)), (None, "calm tree"), (3, rows[3][1]), (504, "\n" * 5000)]
    marks = [(i, int(i % 3 != 0), int(i % 3 == 0)) for i in range(120)] + [(None, 1, 1), (7, None, None), (9999, 0, 1), (5, 0, 1)]
    got = report(documents(rows), labels(marks)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and not math.isnan(r.score) for r in got)
    own = {r.doc_id: r.predicted for r in got}
    toxic_is_one = report is toxicity.toxicity_report
    assert all(own[i] == int((i % 3 == 0) == toxic_is_one) for i in range(10, 120))
    assert report(documents([]), labels(marks)).count() == 0
    assert {r.score for r in report(documents(rows), labels([])).collect()} != {None}
    one_class = report(documents(rows), labels([(i, 1, 1) for i in range(40)])).collect()
    assert len(one_class) == len(rows) and all(r.score > 0.9 for r in one_class)


def test_clashing_columns_are_replaced(spark, documents, labels):
    from pyspark.sql import functions as F

    docs = documents([(1, "a b"), (2, "c d")]).withColumn("toxicity", F.lit("x")).withColumn("score", F.lit(1))
    model = toxicity.fit(docs, labels([(1, 1, 0)]))
    out = toxicity.score(docs, model)
    assert set(out.columns) == set(docs.columns) | {"evidence"} and dict(out.dtypes)["toxicity"] == "double"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    counts = np.array([3, 0, 1, 4, 2])
    chain = line_crf.Chain(rng.normal(size=5), rng.normal(size=(2, 2)), np.zeros(1), np.ones(1))
    inputs = rng.normal(size=(counts.sum(), 5))
    got, pairs = chain.marginals(inputs, counts)
    want, seen, at = [], np.zeros((2, 2)), 0
    for n in counts:
        local = inputs[at : at + n] @ chain.weights
        total, good, own = 0.0, np.zeros(n), np.zeros((2, 2))
        for states in itertools.product((0, 1), repeat=int(n)):
            w = math.exp(sum(x for x, s in zip(local, states, strict=True) if s) + sum(chain.pairs[a, b] for a, b in zip(states, states[1:], strict=False)))
            total += w
            good += w * np.array(states)
            for a, b in zip(states, states[1:], strict=False):
                own[a, b] += w
        want += list(good / total)
        seen += own / total
        at += n
    assert np.allclose(got, want) and np.allclose(pairs, seen)


def test_training_follows_the_gradient():
    """The expected pairs and states of a trained chain come near to those given."""
    rng = np.random.default_rng(5)
    counts = np.full(60, 5)
    label = np.arange(60) % 2
    features = rng.normal(size=(300, 3)) + np.repeat(label, 5)[:, None]
    chain = line_crf.train(features, counts, label)
    good, _ = chain.marginals(chain.inputs(features, counts), counts)
    assert ((good > 0.5) == np.repeat(label, 5)).mean() > 0.93


def test_line_features_count_lines_with_words():
    texts = ["One two\n\n  \nONE two\nOne two\n", "", "a b c a b c", "x$$ y!!"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    features, length, counts = line_crf.line_features(data, offsets)
    assert counts.tolist() == [3, 0, 1, 1] and length.tolist() == [6, 6, 6, 6, 6]
    names = line_crf.FEATURES
    assert features[:, names.index("repeated_line")].tolist() == [1, 0, 1, 0, 0]
    assert features[:, names.index("symbols")].tolist() == [0, 0, 0, 0, 1]
    assert features[:, names.index("capitals")].tolist() == [1 / 6, 3 / 6, 1 / 6, 0, 0]
    assert features[3, names.index("repeats")] == pytest.approx(2 / 6)


def test_line_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in line_crf.quality_report(docs, labels).collect()}
    assert all(r.held_out == held(r.doc_id, 5, 0) and r.predicted == (r.score >= 0.3) for r in got.values())
    rows = [(got[r.doc_id].score, r.quality) for r in labels.collect() if held(r.doc_id, 5, 0)]
    score, label = np.array([s for s, _ in rows]), np.array([t for _, t in rows])
    assert auc(score, label) > 0.97 and ((score >= 0.3) == label).mean() > 0.95


def test_the_toxicity_query_tells_its_evidence(spark, sf_dir):
    from silvertide.llm import queries

    labels = {str(r.doc_id): r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = queries.op6_toxicity(spark, sf_dir).collect()
    told = [[e.split(":") for e in r.evidence.split(",") if e] for r in rows]
    assert any(told) and all(labels[d] == int(t) and 0 <= float(s) <= 1.0001 for own in told for d, s, t in own)
    for own in told:
        assert [float(s) for _, s, _ in own] == sorted((float(s) for _, s, _ in own), reverse=True)
