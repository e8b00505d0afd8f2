"""Operators 11 and 12: brute-force assignment, GNAT ties, library round trips, odd rows."""

import hashlib
import math
import re

import numpy as np
import pytest
from conftest_llm import docs, empty, rows_of, texts  # noqa: F401
from pyspark.sql import functions as F

from chronoframe.llm import fill_in_middle as fim
from chronoframe.llm import vector_codes as vc


def plain_nearest(points, queries):
    square = ((queries[:, None, :].astype(object) - points[None, :, :].astype(object)) ** 2).sum(-1)
    return [min(range(len(points)), key=lambda k: (row[k], k)) for row in square], [min(row) for row in square]


@pytest.mark.parametrize("spread,size,width", [(3, 64, 4), (1, 64, 2), (200, 64, 4), (1 << 26, 64, 4), (40, 200, 3), (10, 5, 4), (10, 1, 1)])
def test_tree_equals_brute_force_with_ties(spread, size, width):
    rng = np.random.default_rng(spread + size)
    points = rng.integers(-spread, spread + 1, (size, width))       # small spreads: repeated points and equal distances
    queries = np.concatenate((rng.integers(-2 * spread, 2 * spread + 1, (300, width)), points))
    queries = np.clip(queries, -vc.LARGEST + 1, vc.LARGEST - 1)
    index, square = vc.Gnat(points).nearest(queries)
    want, least = plain_nearest(points, queries)
    assert index.tolist() == want and square.tolist() == least


def test_tree_rules_out_children():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(c * 1000, 5, (32, 4)) for c in range(16)]).astype(np.int64)
    queries = points[rng.permutation(512)] + 1
    seen = []

    class Counting(vc.Gnat):
        def _compare(self, members, rows, *rest):
            seen.append(len(members) * len(rows))
            return super()._compare(members, rows, *rest)

    index, _ = Counting(points).nearest(queries)
    assert index.tolist() == plain_nearest(points, queries)[0]
    assert sum(seen) < 0.25 * len(points) * len(queries)


def plain_compress(rows, parts, entries, scale, rounds):
    """``{id: (code, error, label_error)}`` and the codebooks, in plain Python."""
    kept = sorted((i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v))
    cut = {}
    for i, v, lab in kept:
        z = [math.floor(scale * x) for x in v]
        w = len(z) // parts
        cut[i] = [tuple(z[p * w:(p + 1) * w]) for p in range(parts)], lab
    ids = sorted(cut)
    books = [[cut[i][0][p] for i in ids[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(books[p]))

    for _ in range(rounds):
        groups = {}
        for i in ids:
            for p in range(parts):
                groups.setdefault((p, nearest(p, cut[i][0][p])[1]), []).append(cut[i][0][p])
        for (p, k), xs in groups.items():
            books[p][k] = tuple(sum(c) // len(xs) for c in zip(*xs))
    out, by_label = {}, {}
    for i in ids:
        found = [nearest(p, cut[i][0][p]) for p in range(parts)]
        out[i] = "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)
        by_label[cut[i][1]] = by_label.get(cut[i][1], 0) + out[i][1]
    digest = hashlib.sha256(",".join(str(x) for p in books for c in p for x in c).encode()).hexdigest()
    return {(i, *out[i], by_label[cut[i][1]], digest) for i in ids}


VEC = "vec_id long, embedding array<float>, label int, code string, n int"


def vectors(seed, n, dim=8, values=(-1.5, -0.7, -0.1, 0.0, 0.26, 0.8, 3.0)):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(np.float32(x)) for x in rng.choice(values, dim) + rng.normal(0, 0.01, dim)], [None, 0, 1, 2][int(rng.integers(0, 4)) if i % 3 else 1])
            for i in rng.permutation(n) * 3]


@pytest.mark.parametrize("entries,rounds", [(64, 2), (16, 1), (7, 3)])
def test_compress_equals_plain(spark, entries, rounds):
    rows = vectors(entries, 260)
    rows += [(900, rows[0][1], 1), (901, rows[0][1], 1)]                                # copies
    odd = [(902, None, 1), (903, [None] * 8, 1), (904, [float("nan")] * 8, 2), (905, [float("inf")] + [0.0] * 7, 2), (906, [0.0] * 7 + [float("-inf")], None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + odd], VEC).repartition(7)
    done = vc.compress(df, parts=4, entries=entries, rounds=rounds)
    assert set(done.columns) == {"vec_id", "label", "n", "code", "error", "label_error", "codebooks_sha256"}
    assert {tuple(r) for r in done.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()} == plain_compress(rows, 4, entries, 256, rounds)


def test_compress_odd_tables(spark):
    none = spark.createDataFrame([], VEC)
    assert vc.compress(none, parts=4).collect() == []
    assert vc.compress(spark.createDataFrame([(1, None, 1, "x", 1)], VEC), parts=4).collect() == []
    df = spark.createDataFrame([(1, [0.5] * 8, 1, "x", 1), (1, [0.5] * 8, 1, "x", 1), (2, [0.25] * 5, 1, "x", 1), (None, [0.75] * 8, None, "x", 1), (3, [], 1, "x", 1)], VEC)
    got = rows_of(vc.compress(df, parts=4), "vec_id", "code", "error", "label_error")
    assert got == sorted([(1, "00000000", 0, 0), (1, "00000000", 0, 0), (2, None, None, 0), (3, None, None, 0), (None, "02020202", 0, 0)], key=repr)
    with pytest.raises(Exception, match="after scaling"):
        vc.compress(spark.createDataFrame([(1, [1e30] * 8, 1, "x", 1)], VEC), parts=4).collect()


def test_decoded_vectors_are_near(spark):
    df = spark.createDataFrame([(*r, "x", 1) for r in vectors(1, 200)], VEC)
    books = vc.fit(df, parts=4)
    rows = vc.decode(vc.encode(df, books), books).select("embedding", "decoded", "error").collect()
    for r in rows:
        assert sum((a - b) ** 2 for a, b in zip(r["embedding"], r["decoded"])) <= (math.sqrt(r["error"]) / 256 + 8 ** 0.5 / 256) ** 2 + 1e-9
    assert len(books.sha256) == 64 and books.dimension == 8


# --- op12 ------------------------------------------------------------------------------------------------------------

def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return n, "plain", None, None, text
    a, b = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 50:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


ODD = ["\n", "\n\n", "a", "a\n", "\na", "<P>", "x <S> y\nz", "<\nP>", "<P", "<\n<\n<S", ">\nP>\nS>M>", "\r\n\r\n", "é\n漢字\n👍🏽\n" * 9, "line\n" * 5000, "\n" * 20000, "x" * 50000]


def test_fim_equals_plain_and_restores(spark, docs, texts):
    rows = [(i, t) for i, t in texts] + [(1000 + k, t) for k, t in enumerate(ODD * 6)]
    df = spark.createDataFrame([(i, t, "en", "s", 1, "d", 1, 2, "x", "r", 0) for i, t in rows], docs.schema).repartition(6)
    done = fim.restore(fim.fill_in_middle(df))
    got = done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, *plain_fim(i, t), t or "") for i, t in rows), key=repr)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert [c for c in done.columns if c in docs.columns] == [c for c in docs.columns if c != "n"] + ["n"]       # clashing name replaced


def test_fim_parameters(spark, docs, empty):
    assert fim.restore(fim.fill_in_middle(empty)).collect() == []
    none = fim.fill_in_middle(docs, fim_percent=0)
    assert {r["form"] for r in none.select("form").collect()} == {"plain"}
    part = fim.fill_in_middle(docs, fim_percent=50, spm_percent=0, unit=r"\S+\s*|\s+", marks=("[1]", "<2>", "{3}"), seed="s")
    got = fim.restore(part, marks=("[1]", "<2>", "{3}")).select("form", "text", "restored").collect()
    assert {r["form"] for r in got} == {"plain", "psm"} and all((r["text"] or "") == r["restored"] for r in got)
    letters = fim.fill_in_middle(spark.createDataFrame([(1, "ab1")], "doc_id long, text string"), unit="[a-z]")       # units that do not tile it
    assert tuple(letters.select("n", "form", "output").first()) == (0, "plain", "ab1")
    for marks in (("<P>", "<P>", "<M>"), ("<<", "a", "b"), ("", "a", "b")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(docs, marks=marks)
    assert docs.select(F.col("text")).count() == none.count()
