"""Operator 13: lines, features, the chain against enumeration, gradients, held-out accuracy."""

import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF01
from conftest_llm import docs, empty, texts  # noqa: F401
from pyspark.sql import functions as F

from chronoframe.llm import quality as ql
from chronoframe.llm.arrays import chunks
from chronoframe.llm.queries import QUERIES


def arrays_of(some):
    (_, _, data, offsets), = chunks(pa.array(some, pa.string()))
    return data, offsets


def plain_lines(text):
    return [u.removesuffix("\n") for u in re.findall(r"[^\n]*\n|[^\n]+", text or "")]


ODD = ["", None, "a", "a\n", "\n", "\n\n", "", "a\n\nb", "x y\nz", None, "é ñ\n漢\n", "", "end"]


def test_lines_equal_plain():
    for some in (ODD, ["\n"], ["a\n", "", "b"], ["", "a"], ["a", ""]):
        data, offsets = arrays_of(some)
        starts, ends, bounds = ql.lines_of(data, offsets)
        for d, text in enumerate(some):
            assert [bytes(data[a:b]).decode() for a, b in zip(starts[bounds[d]:bounds[d + 1]], ends[bounds[d]:bounds[d + 1]])] == plain_lines(text)


def plain_features(text):
    lines, out, before, runs = plain_lines(text), [], [], set()
    had = set()
    for line in lines:
        raw = line.encode()
        visible = [c for c in raw if c not in b" \t\n\v\f\r"]
        letters = [c for c in raw if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128]
        words = [w for w in re.split(rb"[ \t\n\v\f\r]+", raw) if w]
        like = old = old_run = 0
        for w in (w.lower() for w in words):
            like += bool(before) and before[-1] == w
            old += w in had
            had.add(w)
            before.append(w)
            if len(before) > 2:
                old_run += tuple(before[-3:]) in runs
                runs.add(tuple(before[-3:]))
        point = [c for c in raw if c in b".,;:!?'\"-()"]
        digit = [c for c in raw if 48 <= c <= 57]
        signs = len([c for c in visible if c not in letters and c not in point and c not in digit])
        last = words[-1][-1] if words else None
        sign_last = last is not None and last not in letters and last not in point and last not in digit
        end = 0 if last is None else 1 if last in b".!?" else 2 if last in b",;:-" else 3 if sign_last else 0
        n, v = max(len(words), 1), max(len(visible), 1)
        out.append([len(raw), len(words), len(visible) / n, sum(65 <= c <= 90 for c in raw) / max(len(letters), 1), signs / v, len(point) / v, len(digit) / v,
                    like / n, old / n, old_run / n, lines.count(line) - 1, bool(words) and (65 <= words[0][0] <= 90 or words[0][0] >= 128), end])
    return [[sum(x >= e for e in edges) for x, edges in zip(row, ql.FEATURES.values())] for row in out]


def test_features_equal_plain():
    some = ["The cat the cat\nthe cat THE CAT sat.\nThe cat the cat\n", "A$$$ b%%% c###\n\n12 34,\nx x x x!", *ODD, "Ünder ünder\n| a | b |", "  \t \n.\n"]
    codes, length, bounds = ql.features(*arrays_of(some))
    for d, text in enumerate(some):
        assert codes[bounds[d]:bounds[d + 1]].tolist() == plain_features(text), text
        assert length[bounds[d]:bounds[d + 1]].tolist() == [len(re.sub(r"[ \t\n\v\f\r]", "", x).encode()) for x in plain_lines(text)]


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    sizes = [1, 0, 4, 7, 2, 0, 9, 1]
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    unary, moves = rng.normal(0, 3, bounds[-1]), rng.normal(0, 2, (2, 2))
    good, pairs, log_z = ql.forward_backward(unary, moves, bounds)
    for d, n in enumerate(sizes):
        u = unary[bounds[d]:bounds[d + 1]]
        if not n:
            assert log_z[d] == 0
            continue
        paths = list(itertools.product((0, 1), repeat=n))
        weight = np.exp([sum(x * y for x, y in zip(u, p)) + sum(moves[a, b] for a, b in zip(p, p[1:])) for p in paths])
        assert np.isclose(log_z[d], np.log(weight.sum()))
        p = weight / weight.sum()
        assert np.allclose(good[bounds[d]:bounds[d + 1]], [sum(q for q, x in zip(p, paths) if x[t]) for t in range(n)])
        for a, b in itertools.product((0, 1), repeat=2):
            assert np.isclose(pairs[d, a, b], sum(q * sum((s, t) == (a, b) for s, t in zip(x, x[1:])) for q, x in zip(p, paths)))


def test_long_chain_stays_finite():
    n = 30_000
    good, pairs, log_z = ql.forward_backward(np.where(np.arange(n) % 7 == 0, -40.0, 25.0), np.array([[3.0, -30], [-30, 3]]), np.array([0, n]))
    assert np.isfinite(good).all() and np.isfinite(log_z).all() and np.isclose(pairs.sum(), n - 1)


@pytest.mark.parametrize("some_line", [False, True])
def test_gradient(some_line):
    rng = np.random.default_rng(1)
    codes, _, bounds = ql.features(*arrays_of(["The cat\nsat.\n$$$ 5", "a a a a\nB B\nC\nd", "x", "", "One two.\nThree"]))
    label, w = np.array([1, 0, 0, 1, 1]), rng.normal(0, 0.5, ql.WEIGHTS + 4)
    _, grad = ql.likelihood(codes, bounds, label, w, some_line)
    for k in [*np.flatnonzero(grad)[::9], *range(ql.WEIGHTS, ql.WEIGHTS + 4)]:
        e = np.zeros(len(w))
        e[k] = 1e-5
        slope = (ql.likelihood(codes, bounds, label, w + e, some_line)[0] - ql.likelihood(codes, bounds, label, w - e, some_line)[0]) / 2e-5
        assert np.isclose(slope, grad[k], atol=1e-5)


def auc(scores, labels):
    one, zero = (np.array([s for s, y in zip(scores, labels) if y == k]) for k in (1, 0))
    return (one[:, None] > zero[None, :]).mean() + 0.5 * (one[:, None] == zero[None, :]).mean()


def test_held_out_accuracy(spark):
    rows = QUERIES["op13_quality"](spark, SF01)
    assert rows.count() == spark.read.parquet(f"{SF01}/documents.parquet").count()
    known = rows.where("held_out").join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").collect()
    y = [r["quality"] for r in known]
    right = np.mean([r["predicted"] == r["quality"] for r in known])
    assert len(y) > 50 and auc([r["score"] for r in known], y) > 0.9 and right > 0.92


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{n}.parquet") for n in ("documents", "labels"))
    return ql.fit(docs, labels.where(~ql.held_out(F.col("doc_id"))), rounds=(6, 6))


def test_lines_are_labelled(spark, model):
    junk = "&&&$$$ la,&&& asbo.### De%%% de%%% rrar*** uegata$$$ y,%%% que&&&"
    clean = "The and attion to thanedble the, anea. Eriner thanea thonhe."
    df = spark.createDataFrame([(1, "\n".join([clean] * 4 + [junk] * 4)), (2, None), (3, "")], "doc_id long, text string")
    good = [r["good"] for r in ql.line_labels(df, model).orderBy("doc_id", "line").collect()]
    assert len(good) == 8 and min(good[:3]) > max(good[5:])


def test_odd_rows(spark, model, docs, texts, empty):
    got = ql.score(docs, model)
    assert got.columns == [c for c in docs.columns if c != "score"] + ["score", "predicted"]
    rows = got.select("doc_id", "text", "score", "predicted").collect()
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert {r["score"] for r in rows if not (r["text"] or "").strip()} == {model.base}
    same = {}
    for r in rows:
        assert same.setdefault(r["text"], r["score"]) == r["score"]
    assert ql.score(empty, model).collect() == []
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert ql.fit(docs, none).base == 0.5 and ql.fit(empty, none).curve is None
    one = ql.fit(docs, spark.createDataFrame([(0, 1), (1, 1), (None, 0), (2, None)], "doc_id long, quality int"))
    assert one.curve is None and one.base == 0.75
    assert {r["score"] for r in ql.score(docs, one).select("score").collect()} == {0.75}
