"""Operators 1 and 6 against plain Python."""

import hashlib
import re

import pytest
from conftest_llm import docs, empty, rows_of, texts  # noqa: F401
from pyspark.sql import functions as F

from chronoframe.llm import fingerprints as fp
from chronoframe.llm.queries import op1_rules
from chronoframe.llm.url_filters import Rule, filter_urls

URLS = [
    "http://a.Example.NET/en/x?y", None, "", "no scheme", "http://x.net", "http://x.net/", "https://b.org/fr/1", "http://xorg/fr/", "http://org/fr/", "http://q.com/a-casino/b",
    "http://q.com/casinox/", "HTTP://Q.COM/CASINO", "x://net/\n/?", "://example.com/de/", "http://www.example.com/de", "http://example.com/de/#f", "http://example.com/DE/", "http://notexample.com/de/",
    "http://user@m.example.net:80/en/", "http://m.example.net/en/?q=http://z.org/fr/", "http://h#frag/net/", "http://h?net/", "a://b://c/d", "http://files.com/setup.exe", "http://files.com/setup.exeter",
    "http://é.example.com/de/ü", "http://example.net/en", "http://x.example.net.org/fr/", "x" * 5000 + "://net/",
]
SITES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def judge(url):
    url = url or ""
    low = url.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    rest = url.partition("://")[2]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host):])[0]
    host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    fits = [(len(h + p), h + p, a) for a, h, p in SITES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, action = max(fits)
        return host, path, rule, action
    bad = re.search(r"(?:[^a-z0-9]|^)(?:casino|porn|viagra|malware|phishing|adserver|doubleclick)(?:[^a-z0-9]|$)", low) or re.search(r"\.(?:exe|apk|msi)(?:[^a-z0-9]|$)", low)
    return host, path, None, "block" if bad else "allow"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(k, u, "h", "r", "t") for k, u in enumerate(URLS + URLS[:3])], "page_id long, url string, host string, rule string, t string")


def test_url_rules(pages):
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in filter_urls(pages, op1_rules()).collect()}
    assert got == {k: judge(u) for k, u in enumerate(URLS + URLS[:3])}


def test_many_rules_in_blocks(pages, monkeypatch):
    from chronoframe.llm import url_filters

    monkeypatch.setattr(url_filters, "RULES_PER_BLOCK", 3)
    more = op1_rules() + [Rule("block", f"never{k}.example/", True) for k in range(20)]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in filter_urls(pages, more).collect()}
    assert got == {k: judge(u) for k, u in enumerate(URLS + URLS[:3])}


def test_rules_without_a_whole_token_and_none_at_all(spark, pages):
    rows = filter_urls(pages, [Rule("block", "*asin*", False)]).collect()
    assert {r["verdict"] for r in rows if r["url"] and "asin" in r["url"].lower()} == {"block"}
    assert {r["verdict"] for r in filter_urls(pages, [], default="block").collect()} == {"block"}
    assert filter_urls(pages.limit(0), op1_rules()).collect() == []


def test_index_uses_the_rarest_token():
    assert Rule("block", "example.com/de/").tokens() == ["example", "com", "de"]
    assert Rule("block", "example.com/de").tokens() == ["example", "com"]
    assert Rule("block", "*foo/bar^", False).tokens() == ["bar"]


def shingles(text):
    w = [x for x in re.split(r"[ \t\n\x0b\f\r]+", text) if x]
    many = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    return many if len(w) >= 24 else many | {(x,) for x in w} | {("-", x[:3]) for x in w}


def test_edited_texts_and_likeness(docs, texts):
    got = {}
    for r in fp.compare_with_edited(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    order = sorted([(i, t or "") for i, t in texts if i is not None])
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        n = len(t) // 4
        edited = t[:len(t) - n] + nxt[:n]
        own = got[i]
        assert any(r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and r["n_chars"] == len(t) for r in own)
        a, b = shingles(t), shingles(edited)
        true = len(a & b) / len(a | b) if a | b else 1.0
        best = min(abs(r["near_edited"] - true) for r in own)
        assert best < 0.3 if len(a | b) > fp.SIZE else best < 1e-9
    assert len(got[None]) == 2 and sum(map(len, got.values())) == len(texts)
    assert len({r["fingerprint"] for i in range(100, 106) for r in got[i]}) == 1


def test_neighbours_across_spans(spark, monkeypatch):
    monkeypatch.setattr(fp, "ID_SPAN", 4)
    ids = [-9, -1, 0, 3, 4, 5, 40, 41, 1000]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["next_text"] for r in fp.with_next(df, ["text"]).collect()}
    assert got == {i: f"t{j}" for i, j in zip(ids, ids[1:] + ids[:1])}
    one = spark.createDataFrame([(7, "only")], "doc_id long, text string")
    assert [r["next_text"] for r in fp.with_next(one, ["text"]).collect()] == ["only"]


def test_merging_parts_equals_the_whole(spark):
    words = [f"w{k}" for k in range(400)]
    rows = [("a", " ".join(words[:250])), ("b", " ".join(words[246:]))]
    parts = fp.fingerprint(spark.createDataFrame(rows, "part string, text string"))
    whole = fp.fingerprint(spark.createDataFrame([(" ".join(words),)], "text string")).first()
    got = fp.merge_parts(parts.withColumn("all", F.lit(1)), ["all"]).first()
    assert got["sketch"] == whole["sketch"]
    assert abs(whole["distinct_estimate"] - 396) < 396 * 0.4


def test_texts_on_both_sides_of_short_are_compared_by_the_same_shingles(spark):
    words = [f"word{k}" for k in range(30)]
    pairs = [(24, 23), (23, 22), (28, 23), (23, 23), (4, 3), (24, 3)]
    df = spark.createDataFrame([(k, " ".join(words[:a]), " ".join(words[:b])) for k, (a, b) in enumerate(pairs)], "k int, a string, b string")
    got = {r["k"]: r["like"] for r in df.select("k", fp.likeness(fp.sketches(F.col("a")), fp.sketches(F.col("b"))).alias("like")).collect()}
    own = lambda n: shingles(" ".join(words[:n]))
    both = [len(own(a) & own(b)) / len(own(a) | own(b)) for a, b in pairs]
    assert got == pytest.approx({0: 19 / 20, 1: both[1], 2: 19 / 24, 3: 1.0, 4: both[4], 5: 0.0}, abs=0.12)
    assert got[0] == 19 / 20 and got[2] == 19 / 24
    parts = [("p", " ".join(words[:16])), ("q", " ".join(words[12:30]))]
    merged = fp.merge_parts(fp.fingerprint(spark.createDataFrame(parts, "part string, text string")).withColumn("all", F.lit(1)), ["all"]).first()
    assert merged["sketch"] == fp.fingerprint(spark.createDataFrame([(" ".join(words),)], "text string")).first()["sketch"]


def test_containment_and_counts(spark):
    long, short = " ".join(f"w{k}" for k in range(60)), " ".join(f"w{k}" for k in range(30))
    df = spark.createDataFrame([(long, short)], "a string, b string").select(fp.sketch(F.col("a")).alias("a"), fp.sketch(F.col("b")).alias("b"))
    r = df.select(fp.containment(F.col("b"), F.col("a")).alias("in"), fp.resemblance(F.col("a"), F.col("b")).alias("like"), fp.distinct_shingles(F.col("b")).alias("n")).first()
    assert r["in"] == 1.0 and abs(r["like"] - 26 / 56) < 1e-9 and r["n"] == 26.0


def test_empty(empty):
    assert fp.compare_with_edited(empty).collect() == []
    assert rows_of(fp.fingerprint(empty), "doc_id") == []


def test_no_python_in_the_plans(docs, pages):
    for df in (fp.compare_with_edited(docs), filter_urls(pages, op1_rules())):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)
