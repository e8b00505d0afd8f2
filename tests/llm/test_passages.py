"""Operators 4 and 5 against brute force."""

import hashlib
import re

import numpy as np
import pytest
from conftest_llm import docs, empty, rows_of, texts  # noqa: F401

from chronoframe.llm import substring_dedup, suffix_dedup
from chronoframe.llm.arrays import ranges, sliding_min, word_spans

NONE = 2**63 - 1


def brute_words(texts, width):
    words = [((NONE if i is None else i), re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in texts]
    least = {}
    for i, w in words:
        for k in range(len(w) - width + 1):
            key = tuple(w[k:k + width])
            least[key] = min(least.get(key, NONE), i)
    out = []
    for (i, w), (doc_id, _) in zip(words, texts):
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if least[tuple(w[k:k + width])] < i:
                gone[k:k + width] = [True] * width
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def brute_bytes(texts, width):
    raw = [((NONE if i is None else i), (t or "").encode()) for i, t in texts]
    first = {}
    for i, b in raw:
        for k in range(len(b) - width + 1):
            first[b[k:k + width]] = min(first.get(b[k:k + width], (NONE, NONE)), (i, k))
    out = []
    for (i, b), (doc_id, _) in zip(raw, texts):
        gone = np.zeros(len(b), dtype=bool)
        for k in range(len(b) - width + 1):
            if first[b[k:k + width]] < (i, k):
                gone[k:k + width] = True
        spans = int(np.count_nonzero(np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1))
        out.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [13, 50])
def test_substring_dedup(docs, texts, width):
    got = rows_of(substring_dedup.dedup(docs, width), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == brute_words(texts, width)


def test_substring_dedup_keeps_columns_and_text(docs, texts):
    out = substring_dedup.dedup(docs, 13)
    assert out.columns[:len(docs.columns)] == docs.columns
    original = {i: t for i, t in texts}
    for r in out.collect():
        if r["n_removed"] == 0 and r["doc_id"] is not None:
            assert r["kept_text"] == original[r["doc_id"]]
        assert sum(x["n"] for x in r["removed"]) == r["n_removed"]


@pytest.mark.parametrize("width", [100, 40])
def test_suffix_dedup(docs, texts, width):
    got = rows_of(suffix_dedup.dedup(docs, width), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute_bytes(texts, width)


def test_pieces_of_a_task_do_not_matter(docs, texts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 3000)
    monkeypatch.setattr(substring_dedup, "PIECE", 3000)
    one = docs.coalesce(1)
    data = [x for _, x in texts]
    for module, brute, width in ((suffix_dedup, brute_bytes, 100), (substring_dedup, brute_words, 13)):
        import pyarrow as pa
        import pandas as pd

        batch = pa.RecordBatch.from_pydict({"i": pa.array([i for i, _ in texts], pa.int64()), "t": pa.array(data, pa.string())})
        sent = [r for b in module.split([batch], width, 7) for r in b.to_pylist()]
        found = pd.concat([module.settle(pd.DataFrame([x for x in sent if x["bucket"] == k]), width) for k in sorted({x["bucket"] for x in sent})])
        total = {}
        for d, span, h in found.itertuples(index=False):
            total.setdefault(d, []).append((span >> 32, span & 0xFFFFFFFF, h))
        for i, t in texts:
            own = total.get(NONE if i is None else i)
            raw = (t or "").encode()
            gone = 0
            if own:
                arrays = tuple(np.array(x, dtype=np.int64) for x in zip(*own))
                gone = int((module.covered(raw, arrays, width) if module is substring_dedup else module.covered(np.frombuffer(raw, np.uint8), arrays)).sum())
            expected = {r[0]: r[2] for r in brute(texts, width)}
            if i is not None:
                assert gone == expected[i], i
    assert one is not None


def test_empty_tables(empty):
    assert substring_dedup.dedup(empty).collect() == []
    assert suffix_dedup.dedup(empty).collect() == []


def test_doubled_lines_with_a_shared_tail(spark):
    """The first text holds a line twice, the other once before the same tail: equal windows at different places of their strings."""
    rng = np.random.default_rng(8)
    make = lambda n: "".join(chr(97 + x) for x in rng.integers(0, 26, n))
    pairs = []
    for k in range(120):
        line, tail = make(int(rng.integers(17, 45))), make(int(rng.integers(60, 140)))
        pairs += [(2 * k, line + line + tail), (2 * k + 1, make(int(rng.integers(0, 90))) + line + tail + make(5))]
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(3)
    assert rows_of(suffix_dedup.dedup(df, 100), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(pairs, 100)


def test_suffix_sort_orders_and_merges():
    text = np.frombuffer(b"abcabcabdabcabcabeabcabcabd" * 3, np.uint8)
    s = suffix_dedup.Suffixes(text, 9, 21)
    at = np.arange(len(text) - 9 + 1)
    lost, into = s.merge_sort(np.zeros(len(at), np.int64), at, at)
    first = {}
    for k in at:
        first.setdefault(text[k:k + 9].tobytes(), k)
    kept = set(at.tolist()) - set(lost.tolist())
    assert kept == set(first.values())
    assert all(text[a:a + 9].tobytes() == text[b:b + 9].tobytes() and b < a for a, b in zip(lost, into))


def test_hash_collision_is_noticed():
    data = np.frombuffer(b"abcdefgh", np.uint8)
    with pytest.raises(suffix_dedup.HashCollision):
        suffix_dedup.verify(data, np.array([0]), np.array([4]), np.array([4]))
    suffix_dedup.verify(data, np.array([0, 4]), np.array([0, 4]), np.array([4, 4]), step=4)


def test_array_helpers():
    x = np.random.default_rng(1).integers(0, 50, 300).astype(np.uint64)
    for width in (1, 2, 5, 64):
        assert np.array_equal(sliding_min(x, width), [x[i:i + width].min() for i in range(len(x) - width + 1)])
    assert ranges(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
    raw = b"a b" + b"" + b"c  " + b" d"
    starts, ends, bounds = word_spans(np.frombuffer(raw, np.uint8), np.array([0, 3, 3, 6, 8]))
    assert [raw[a:b] for a, b in zip(starts, ends)] == [b"a", b"b", b"c", b"d"] and bounds.tolist() == [0, 2, 2, 3, 4]


def hot_rows(n, seed=4):
    """A 14-word line in every text, at any place, with different neighbours; some texts twice, one neighbour shared."""
    import random

    rng = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    say = lambda k: " ".join(rng.choice(words) for _ in range(k))
    line, beside = say(14), say(9)
    rows = []
    for i in range(n):
        t = f"{say(rng.randint(0, 30))} {line} {beside if i % 5 == 0 else ''} {say(rng.randint(0, 30))}"
        rows.append((i, rows[-3][1] if i % 11 == 10 else t))
    return rows


def test_a_line_in_every_text(spark):
    rows = hot_rows(400)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert rows_of(substring_dedup.dedup(df, 13), "doc_id", "n_words", "n_removed", "kept_sha256") == brute_words(rows, 13)
    assert rows_of(suffix_dedup.dedup(df, 70), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(rows, 70)


def test_frequent_parts_do_not_fill_one_bucket(spark):
    """With the line's parts ranked last no bucket holds a large share of what travels; with the plain order one does."""
    import pyarrow as pa

    from chronoframe.llm import superkmers

    rows = hot_rows(3000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    for module, width in ((substring_dedup, 13), (suffix_dedup, 70)):
        order, n = superkmers.plan(df.select("text"), lambda data, offsets: module.parts_in(data, offsets, width), module.PIECE)
        assert len(order.frequent) and n == 16
        batch = pa.RecordBatch.from_pydict({"i": pa.array([i for i, _ in rows], pa.int64()), "t": pa.array([t for _, t in rows], pa.string())})
        share = []
        for o in (superkmers.PLAIN, order):
            size = np.zeros(400, dtype=np.int64)
            for b in module.split([batch], width, 400, o):
                for r in b.to_pylist():
                    kind, *x = superkmers.unpack(r["blob"])
                    size[r["bucket"]] += len(x[0]) if kind == superkmers.STRINGS else 0
            share.append(size.max() / size.sum())
        assert share[1] < 0.5 * share[0] and share[1] < 0.03, (module.__name__, share)


def test_word_hashes_hold_few_prefix_sums_at_once():
    """A worker kept 64 MB of powers, as long as its pieces; now they are as long as a block, and the hashes are the same."""
    import numpy as np

    from chronoframe.llm import arrays

    text = b" ".join(f"w{k * 7919 % 50021}".encode() for k in range(60000)) + b" " + b"x" * 200_000 + b" last"
    data = np.frombuffer(text, dtype=np.uint8)
    starts, ends, _ = arrays.word_spans(data, np.array([0, len(data)]))
    kept = dict(arrays.Poly._powers)
    arrays.Poly._powers.clear()
    arrays.poly.cache_clear()
    try:
        words = arrays.word_hashes(data, starts, ends, 10)
        windows = arrays.poly(11).windows_of(words, 50)
        assert len(data) > 4 * arrays.HASHED > 0 and max(len(t) for pair in arrays.Poly._powers.values() for t in pair) <= arrays.HASHED
        p = arrays.Poly(10)
        whole = p.span(p.prefix_bytes(data), starts, ends)
        short = ends - starts <= arrays.LONG_WORD
        assert (words[short] == whole[short]).all() and (~short).sum() == 1
        assert words[~short][0] == arrays.word_hashes(data[starts[-2]:ends[-2]], np.array([0]), np.array([200_000]), 10)[0]
        p = arrays.Poly(11)
        assert len(windows) == len(words) - 49 and (windows == p.windows(p.prefix(words), 50)).all()
        assert len(arrays.poly(11).windows_of(words[:3], 50)) == 0
    finally:
        arrays.Poly._powers.clear()
        arrays.Poly._powers.update(kept)
        arrays.poly.cache_clear()
