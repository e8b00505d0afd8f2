"""Operators 3 and 9 against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import docs, edit, empty, rows_of, sentence, texts, WORDS  # noqa: F401
from pyspark.sql import functions as F

from chronoframe.llm import bitmaps, decontam, ngram_join
from chronoframe.llm.components import connected_components


def brute(texts, n, percent):
    low = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    sets = []
    for i, t in texts:
        w = (t or "").encode().translate(low).split()
        sets.append((i, frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()))
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return sorted(((i, len(x), None if i is None else find(i)) for i, x in sets), key=repr)


@pytest.mark.parametrize("n,percent,hot", [(4, 85, 16), (5, 80, 2), (4, 85, 10**9)])
def test_components_equal_all_pairs(docs, texts, monkeypatch, n, percent, hot):
    monkeypatch.setattr(ngram_join, "HOT_MIN", hot)
    assert rows_of(ngram_join.components(docs, n, percent), "doc_id", "n_shingles", "component_id") == brute(texts, n, percent)


def test_families_of_edits_and_short_texts(spark):
    rng = random.Random(11)
    rows = []
    for family in range(12):
        base = sentence(rng, rng.choice([4, 5, 9, 30, 80]))
        rows += [(len(rows) + k, edit(rng, base, rng.choice([0, 0.01, 0.03, 0.06]))) for k in range(14)]
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for percent in (60, 85, 100):
        assert rows_of(ngram_join.components(df, 4, percent), "doc_id", "n_shingles", "component_id") == brute(rows, 4, percent)


@pytest.mark.parametrize("per_row", [0])
def test_families_that_no_single_leader_links(spark, monkeypatch, per_row):
    """Chains of edits (each near the one before, not near the first), clusters of different variants, and one size and prefix with many tails."""
    monkeypatch.setattr(ngram_join, "PAIRS_PER_ROW", per_row)
    rng = random.Random(19)
    texts = []
    base = sentence(rng, 90).split(" ")
    for k in range(14):                                         # a drifting chain
        base[rng.randrange(len(base))] = rng.choice(WORDS)
        texts.append(" ".join(base))
    middle = sentence(rng, 60)
    for cluster in range(3):                                    # a shared part, different surroundings, copies of each
        own = f"{sentence(rng, 25)} {middle} {sentence(rng, 25)}"
        texts += [edit(rng, own, 0.01) for _ in range(5)]
    texts += [middle + " " + sentence(rng, 12) for _ in range(12)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(ngram_join.components(df, 4, 85), "doc_id", "n_shingles", "component_id") == brute(rows, 4, 85)


def test_stored_signatures_hold_numbers_only(spark, docs, texts, monkeypatch):
    """What is kept of every document during the join is some numbers, not its prefix, bitmap or counts."""
    rng = random.Random(9)
    rows = texts + [(10_000 + k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    stored, original = [], ngram_join.checkpointed

    def seen(df):
        out = original(df)
        stored.append((out.count(), {t for c, t in out.dtypes if c not in ("lead", "gram", "pos")}))
        return out
    monkeypatch.setattr(ngram_join, "checkpointed", seen)
    assert rows_of(ngram_join.components(df, 4, 85), "doc_id", "n_shingles", "component_id") == brute(rows, 4, 85)
    whole = [types for count, types in stored if count >= len(rows)]
    assert whole and all(types <= {"int", "bigint"} for types in whole)


def test_pairs_in_several_turns(spark, monkeypatch):
    rng = random.Random(4)
    rows = []
    for f in range(6):
        first = [f"f{f}x{k}" for k in range(120)]
        for c in range(12):
            words = list(first)
            for k in rng.sample(range(120), c % 5):
                words[k] = f"c{c}y{k}"
            rows.append((100 * f + c, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    compared, original = [], ngram_join._joined

    def seen(pairs, rows, key, value):
        compared.append("grams" in rows.columns and dict(rows.dtypes)["grams"] != "bigint")
        return original(pairs, rows, key, value)
    monkeypatch.setattr(ngram_join, "_joined", seen)
    monkeypatch.setattr(ngram_join, "TURN_SHARE", 40)
    assert rows_of(ngram_join.components(df, 4, 85), "doc_id", "n_shingles", "component_id") == brute(rows, 4, 85)
    assert sum(compared) > 10
    compared.clear()
    monkeypatch.setattr(ngram_join, "TURN_SHARE", 0)
    assert rows_of(ngram_join.components(df, 4, 85), "doc_id", "n_shingles", "component_id") == brute(rows, 4, 85)
    assert 0 < sum(compared) < 10


def test_empty(empty):
    assert ngram_join.components(empty).collect() == []


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(rng.randint(200, 240), rng.randint(200, 240)) for _ in range(25)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(50):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_bitmap_joins(spark, monkeypatch):
    monkeypatch.setattr(bitmaps, "BITS", 128)
    df = spark.createDataFrame([(k, "x") for k in range(300)] + [(None, "y")], "k long, t string")
    ids = spark.createDataFrame([(k,) for k in range(0, 300, 7)] + [(None,)], "i long")
    assert sorted(r["k"] for r in bitmaps.having(df, "k", ids, "i").collect()) == list(range(0, 300, 7))
    left = [r["k"] for r in bitmaps.without(df, "k", ids, "i").collect()]
    assert sorted(x for x in left if x is not None) == [k for k in range(300) if k % 7] and left.count(None) == 1


@pytest.fixture(scope="module")
def leaks(spark):
    rng = random.Random(21)
    items = [(k, sentence(rng, rng.randint(15, 40)).capitalize() + ".") for k in range(25)] + [(90, None), (91, ""), (92, "kan lor"), (93, "solo")]
    rows, truth = [], {}
    for k in range(300):
        text = sentence(rng, rng.randint(5, 150))
        if k % 10 == 0:
            item = rng.randrange(25)
            copy = edit(rng, items[item][1].lower(), 0.1)
            words = copy.split()
            if k % 20 == 0:
                del words[len(words) // 2]
            text = text + " " + " ".join(words) + ", " + sentence(rng, 30)
            truth[k] = item
        rows.append((k, text))
    rows += [(400, None), (401, ""), (None, items[3][1]), (402, items[4][1].upper()), (402, items[4][1].upper()), (403, "x " * 3000), (404, "Kan LOR!")]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, item_id int, share string").repartition(3)
    return docs, spark.createDataFrame(items, "item_id long, text string"), items, rows, truth


def test_planted_leaks_are_found_and_clean_rows_left(leaks):
    docs, benchmark, _, rows, truth = leaks
    got = defaultdict(set)
    for r in decontam.contaminated(docs, benchmark).collect():
        got[r["doc_id"]].add(r["item_id"])
    assert all(item in got[k] for k, item in truth.items())
    assert got[None] == {3} and got[402] == {4} and got[404] == {92}
    assert set(got) - {None, 402, 404} == set(truth)
    left = Counter(r["doc_id"] for r in decontam.decontaminate(docs, benchmark).collect())
    assert left == Counter(i for i, _ in rows if i not in got)


def test_quotes_of_long_items(spark):
    """25 of 59 words, 13 of 250, and 40 of 250 with every eighth replaced are leaks; six words in a row are none."""
    rng = random.Random(33)
    words = [f"w{k}" for k in range(4000)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    items = [say(59), say(250)]
    edited = [w if k % 8 else "other" for k, w in enumerate(items[1][150:190])]
    quotes = [(0, items[0][20:45]), (1, items[1][100:113]), (2, edited), (3, items[0][5:11]), (4, items[1][30:36])]
    docs = spark.createDataFrame([(i, " ".join(say(60) + q + say(60))) for i, q in quotes], "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    assert rows_of(decontam.contaminated(docs, benchmark), "doc_id", "item_id") == [(0, 0), (1, 1), (2, 1)]
    assert [r["doc_id"] for r in decontam.decontaminate(docs, benchmark).orderBy("doc_id").collect()] == [3, 4]


def test_alignment_equals_the_full_recurrence():
    rng = random.Random(3)
    for _ in range(60):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(1, 14))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                s = decontam.MATCH if a[i - 1] == b[j - 1] else decontam.MISMATCH
                best[i][j] = max(0, best[i - 1][j - 1] + s, best[i - 1][j] + decontam.GAP, best[i][j - 1] + decontam.GAP)
        import numpy as np

        score, first, last, matched = decontam.alignment(np.array(a), np.array(b))
        assert score == max(map(max, best)) and 0 <= first <= last <= len(b) and matched <= min(len(a), last - first)


def test_blocks_of_a_large_benchmark(leaks, monkeypatch):
    docs, benchmark, _, _, _ = leaks
    whole = rows_of(decontam.contaminated(docs, benchmark), "doc_id", "item_id")
    monkeypatch.setattr(decontam, "MAX_BROADCAST", 400)
    assert rows_of(decontam.contaminated(docs, benchmark), "doc_id", "item_id") == whole


def test_empty_tables(empty, leaks):
    docs, benchmark, _, _, _ = leaks
    assert decontam.contaminated(empty, benchmark).collect() == []
    assert decontam.contaminated(docs, benchmark.limit(0)).collect() == []
    assert decontam.decontaminate(docs, benchmark.limit(0)).count() == docs.count()
    assert len(WORDS) == 64


@pytest.mark.parametrize("copies", [1, 3, 10, 100])
def test_quotes_in_many_documents(spark, copies):
    """13 words in a row of a 60-word item, and 20 of a 200-word one, in any number of documents, against every document aligned with every item."""
    rng = random.Random(copies)
    words = [f"w{k}" for k in range(900)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    items = [say(60), say(200), say(40)]
    rows = [(k, say(rng.randint(0, 40)) + items[0][20:33] + say(rng.randint(0, 40))) for k in range(copies)]
    rows += [(1000 + k, say(30) + items[1][90:110] + say(20)) for k in range(copies)]
    rows += [(2000 + k, say(60)) for k in range(40)] + [(3000 + k, say(9) + items[2][5:10] + say(9)) for k in range(copies)]
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in rows], "doc_id long, text string").repartition(3)
    got = rows_of(decontam.contaminated(docs, spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")), "doc_id", "item_id")

    def hashes(x):
        raw = np.frombuffer(" ".join(x).encode(), dtype=np.uint8)
        return decontam.words_of(raw, np.array([0, len(raw)]))[0]

    want = []
    for i, x in rows:
        for k, y in enumerate(items):
            a, b = hashes(y), hashes(x)
            score, first, last, _ = decontam.alignment(a, b)
            dense = score >= decontam.MATCH * decontam.QUOTE and score >= 0.5 * decontam.MATCH * (last - first)
            if score >= 0.5 * decontam.MATCH * len(a) or dense or decontam.quoted(a, b):
                want.append((i, k))
    assert got == sorted(want, key=repr) and len(got) == 2 * copies


def test_long_item_in_linear_memory():
    import resource

    rng = np.random.default_rng(0)
    item = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    passage = np.concatenate((rng.integers(0, 2**63, 500).astype(np.uint64), item[100:1500], rng.integers(0, 2**63, 500).astype(np.uint64)))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    score, first, last, matched = decontam.alignment(item, passage)
    assert (score, first, last, matched) == (2 * 1400, 500, 1900, 1400)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300 * 1024


def thue_morse(n):
    """Two different strings of n signs whose polynomial hashes modulo 2**64 agree for every odd base."""
    bits = [bin(k).count("1") & 1 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [64, 1024, 4096])
def test_long_patterned_words_are_told_apart(spark, n):
    from chronoframe.llm import substring_dedup as sd

    t, c = thue_morse(n)
    few = spark.createDataFrame([(0, f"{t} x y z"), (1, f"{c} x y z"), (2, f"{t} x y z")], "doc_id long, text string")
    assert rows_of(ngram_join.components(few, 4, 85), "doc_id", "component_id") == [(0, 0), (1, 1), (2, 0)]
    tail = " ".join(f"w{k}" for k in range(12))
    long = spark.createDataFrame([(0, f"{t} {tail}"), (1, f"{c} {tail}"), (2, f"{t} {tail}")], "doc_id long, text string")
    assert rows_of(sd.dedup(long, 13, outputs=("n_removed",)), "doc_id", "n_removed") == [(0, 0), (1, 0), (2, 13)]
    bench = spark.createDataFrame([(5, f"{t} x")], "item_id long, text string")
    assert rows_of(decontam.contaminated(few.withColumn("text", F.expr("substring_index(text, ' ', 2)")), bench), "doc_id") == [(0,), (2,)]
