"""Operators 8 and 10: held-out accuracy, restored words, brute-force distances."""

import re
from collections import Counter

import numpy as np
import pytest
from conftest import SF01
from conftest_llm import docs, empty, texts  # noqa: F401
from pyspark.sql import functions as F

from chronoframe.llm import language_id as li
from chronoframe.llm import toxicity as tx
from chronoframe.llm.queries import QUERIES


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    docs, labels = tables
    return tx.fit(docs.select("doc_id", "text"), labels.where(~li.held_out(F.col("doc_id"))))


def test_toxicity_held_out(spark, tables, model):
    rows = QUERIES["op8_toxicity"](spark, SF01).where("held_out").join(tables[1], "doc_id").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    assert len(rows) > 50 and right / len(rows) > 0.9
    toxic, clean = ([r["score"] for r in rows if r["toxic"] == y] for y in (1, 0))
    assert np.mean(np.array(toxic)[:, None] >= np.array(clean)[None, :]) > 0.85


@pytest.mark.parametrize("written,word", [("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("i d i o t", "idiot"), ("idiooot", "idiot"), ("p4th3t1c", "pathetic"), ("m0r0n", "moron"),
                                          ("sc_um", "scum"), ("tr@sh", "trash"), ("cl0wnnn", "clown"), ("l0s3r", "loser"), ("st*pid", "stupid")])
def test_deobfuscation(model, written, word):
    assert tx.Restorer(model.logp).decode(written) == word


def test_disguised_texts_score_like_plain_ones(spark, model):
    texts = ["erentth the 1d10t and m0r0n", "erentth the i d i o t here", "the and erentth", None, "", "  \n", "a" * 20000, "the st-u-p-i-d", "tr@sh " * 3, "$$$ %%% !!!", "漢字 ЖУК"]
    df = spark.createDataFrame([(k, t, "x", 0.5) for k, t in enumerate(texts)], "doc_id long, text string, score string, predicted double")
    got = {r["doc_id"]: r for r in tx.score(df, model).collect()}
    assert [got[k]["predicted"] for k in range(len(texts))] == [1, 1, 0, 0, 0, 0, 0, 1, 1, 0, 0]
    assert all(0 <= r["score"] <= 1 for r in got.values())


@pytest.mark.parametrize("written", ["iddiot", "stuupid", "sscum", "losser", "mooron", "trassh", "clownn"])
def test_doubled_letters_score_like_the_plain_word(spark, model, written):
    plain = re.sub(r"(.)\1", r"\1", written)
    df = spark.createDataFrame([(0, f"the {plain} here"), (1, f"the {written} here"), (2, "the letter and all the books")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in tx.score(df, model).collect()}
    assert [got[k]["predicted"] for k in range(3)] == [1, 1, 0] and got[0]["score"] == got[1]["score"]


def test_short_words_unspaced_scripts_and_stems_under_many_common_ones_are_learnt(spark, monkeypatch):
    monkeypatch.setattr(tx, "STEM_COUNTS", 500)                            # counts come in many parts
    monkeypatch.setattr(tx, "CANDIDATES", 50, raising=False)               # the cap that was
    common = [f"{chr(97 + k // 26)}{chr(97 + k % 26)}ordinary" for k in range(200)]
    bad = ["wog", "今日は馬鹿者です", "grumbler", "wog", "あの馬鹿者が", "grumbler", "wog", "馬鹿者め", "grumbler"]
    rows = [(k, " ".join(common[k % 7::2] + [bad[k % 9]]) if k < 90 else " ".join(common[k % 7::2]) + " 今日はです", int(k < 90)) for k in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    learnt = tx.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert {"wog"} <= learnt.rules.keys()
    asked = [(0, "a wog there"), (1, "a wogger there"), (2, "彼は馬鹿者だ"), (3, "今日は"), (4, "the grumbler"), (5, "aaordinary")]
    got = {r["doc_id"]: r["predicted"] for r in tx.score(spark.createDataFrame(asked, "doc_id long, text string"), learnt).collect()}
    assert got == {0: 1, 1: 0, 2: 1, 3: 0, 4: 1, 5: 0}


def test_words_that_no_rule_begins_are_not_restored(monkeypatch):
    """Op 8: the filter before restoring leaves out only tokens without a rule, whatever their doubled letters, accents and signs."""
    rng = np.random.default_rng(4)
    logp = tx.log_probabilities(np.arange(1 << 20), rng.integers(0, 9, 1 << 20))
    restorer = tx.Restorer(logp)
    tokens = [a + b + c for a in ("", "é", "éé", "***", "漢字漢", "ol", "ß", "İ", "the") for b in ("ool", "llee", "éèe", "aab", "ж", "idiot", "iddiiot", "naïïve") for c in ("", "!", "...", "ss", "字字", "rrr")]
    every = sorted({s for t in tokens[::3] for w in restorer.words(t) for s in tx.stems(w)})
    known = dict.fromkeys(every[::2], 0.9)
    plain = tx.ToxicityModel(logp, known)
    quick = tx.KnownStems(restorer, known)
    assert {t: quick[t] for t in tokens} == {t: plain.hits(restorer.words(t)) for t in tokens}
    asked = []
    monkeypatch.setattr(restorer, "words", lambda t: asked.append(t) or [t])
    few = tx.KnownStems(restorer, {"idiot": 0.9})
    assert [few[t] for t in ("letter", "books.", "ciónn", "iddiot")] == [frozenset()] * 4 and asked == ["iddiot"]


def test_toxicity_without_labels_or_rows(spark, tables, empty):
    docs, labels = tables
    none = tx.fit(docs.limit(20).select("doc_id", "text"), labels.limit(0))
    assert none.rules == {} and tx.score(docs.limit(3), none).where("score > 0").count() == 0
    nothing = tx.fit(empty.select("doc_id", "text"), labels)
    assert tx.score(empty, nothing).collect() == []
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0), (2, 1)], "doc_id long, toxic int")
    assert tx.fit(docs.select("doc_id", "text").limit(5), odd).base >= 0


def test_letter_counts_equal_plain_ones():
    texts = ["Abc  d!", "", "é", "zz9zz", "жук"]
    total = np.zeros(1 << 20, dtype=np.int64)
    for _, points, bounds in li.pieces(texts):
        total += tx.four_grams(tx._classes()[points], bounds)
    plain = Counter()
    for t in texts:
        seq = [0, 0, 0]
        for ch in t.lower():
            c = {"é": 5}.get(ch, ord(ch) - 96 if "a" <= ch <= "z" else 27 if ch.isalpha() else 0)
            if c or (seq[-1] and len(seq) > 3):
                seq.append(c)
        plain.update(tuple(seq[i:i + 4]) for i in range(len(seq) - 3))
    own = {(c >> 15, c >> 10 & 31, c >> 5 & 31, c & 31): int(total[c]) for c in np.flatnonzero(total)}
    assert {k: v for k, v in own.items() if k[3] or k[2]} .items() >= {k: v for k, v in plain.items() if 0 not in k}.items()


def test_rules_of_copies_are_not_learnt():
    copy = {"insult", *(f"word{k}" for k in range(40))}
    lists = [set(copy) for _ in range(60)] + [{"insult", f"other{k}"} for k in range(60)] + [{"slur", f"more{k}"} for k in range(60)]
    good = {s: 0.99 for x in lists for s in x}
    assert set(tx.pick_rules(lists, good, 10)) == {"insult", "slur"}


def brute_grams(text):
    w = re.sub(r"[\W\d_]+", " ", text.lower()).strip()
    w = f" {w} " if w else "  "
    out = Counter(c for c in w if c != " ")
    out.update(w[i:i + 2] for i in range(len(w) - 1) if w[i:i + 2] != "  ")
    out.update(w[i:i + 3] for i in range(len(w) - 2) if w[i + 1] != " ")
    return out


def test_grams_and_distances_equal_plain_ones(texts):
    sample = [t or "" for _, t in texts if not t or len(t) < 3000] + ["", "a", " a.", "a b!", "..."]
    number = {}
    for _, points, bounds in li.pieces(sample):
        owner, gram = li.grams(points, bounds)
        for d, t in enumerate(sample):
            assert sorted(Counter(gram[owner == d].tolist()).values()) == sorted(brute_grams(t).values())
        o, g, n = li.counted(owner, gram)
        ro, rg, rank = li.ranked(o, g, n, len(sample))
        for d in range(len(sample)):
            own = sorted(zip((-n[o == d]).tolist(), g[o == d].tolist()))[:li.PROFILE]
            assert [x for _, x in own] == rg[ro == d].tolist() and rank[ro == d].tolist() == list(range(len(own)))
            number[d] = {x: k for k, (_, x) in enumerate(own)}
    known = np.array(sorted(number[0]), dtype=np.uint64)
    ranks = np.array([[number[0][int(x)]] for x in known] + [[-1]])
    cost, size = li.distances(sample, known, ranks)
    for d in range(len(sample)):
        assert cost[d, 0] == sum(abs(number[0][x] - k) if x in number[0] else li.PROFILE for x, k in number[d].items()) and size[d] == len(number[d])


def test_language_held_out(spark, tables):
    rows = QUERIES["op10_language_id"](spark, SF01).where("held_out").join(tables[0].select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(spark, docs, empty):
    learn = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("x", None), ("el perro y el gato", "es")], "text string, lang string")
    profiles = li.fit_profiles(learn)
    assert sorted(profiles) == ["de", "en", "es"]
    got = {r["doc_id"]: r for r in li.identify(docs.drop("score"), profiles).collect()}
    assert got[200]["lang_pred"] == got[201]["lang_pred"] == got[202]["lang_pred"] == "und" and got[200]["score"] == 0
    assert li.identify(empty.drop("score"), profiles).collect() == []
    nothing = li.fit_profiles(learn.limit(0))
    assert {r["lang_pred"] for r in li.identify(docs.drop("score"), nothing).collect()} == {"und"}
