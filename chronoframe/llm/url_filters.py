"""Operator 1: URL filters. Pattern rules are indexed by their rarest literal token; a URL's tokens fetch candidate rules,
and only those run regular expressions.

Two kinds of rules: *site* rules (``host/path``: the host and all its
subdomains, path prefix; the longest wins and site rules come before the
others) and *patterns* over the whole lower-cased URL (``*`` any run, ``^`` a
border: anything but a letter or digit, or an end). A rule is stored under
the one of its whole tokens that the fewest URLs have (counted over all URLs;
one small row for each rule token comes to the driver). Rules without a whole
token are tried on every URL.

All of it is one projection of built-in functions: no shuffle of URLs, no
Python in the tasks. The index is a constant of the plan, cut into blocks of
``RULES_PER_BLOCK`` rules, so any number of rules works; each block is hashed
by token, so a look-up does not grow with the rules.

Cases: a null URL, or one without ``://``, has empty host and path and no site
rule, and gets the default verdict (patterns still see the text); an empty
rule list gives the default everywhere; columns named like the new ones are
replaced; repeated rows are judged each.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES_PER_BLOCK = 5_000
TOKEN = re.compile(r"[a-z0-9]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    action: str               # "allow" or "block"
    text: str                 # host/path, or a pattern
    site: bool = True

    @property
    def regex(self) -> str:
        if self.site:
            return r"^([^/?#]*[.])?" + _quote(self.text)
        return "".join({"*": "(?s:.*)", "^": "(?:[^a-z0-9]|^|$)"}.get(c) or _quote(c) for c in self.text)

    def tokens(self) -> list[str]:
        """Tokens that every matching URL has whole (a site's path may go on, so its last token counts only before a border)."""
        text = self.text.translate(str.maketrans(UPPER, LOWER))
        before = lambda m: self.site if m.start() == 0 else text[m.start() - 1] != "*"
        closed = lambda m: before(m) and m.end() < len(text) and text[m.end()] != "*"
        return [m[0] for m in TOKEN.finditer(text) if closed(m)]


def _quote(text: str) -> str:
    """Literal text for both regular expression dialects in use (Java's and RE2)."""
    return "".join(c if c.isalnum() or c in "/_-" else f"[{c}]" if c in ".?*+|(){}$&~#=%:;,@!<>'\" " else "\\" + c for c in text)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #``, A-Z lower-cased; path: from there up to ``? #``."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.when(at > 0, ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)))
    path = F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.split(ascii_lower(F.coalesce(url, F.lit(""))), "[^a-z0-9]+"))


def token_counts(df: DataFrame, url_col: str, tokens: list[str]) -> dict[str, int]:
    """URLs that have each rule token; as many rows as there are rule tokens."""
    have = F.array_intersect(url_tokens(F.col(url_col)), F.array(*[F.lit(t) for t in tokens]))
    rows = df.select(F.explode(have).alias("t")).groupBy("t").count().collect() if tokens else []
    return {r["t"]: r["count"] for r in rows}


def _entry(order: int, rule: Rule) -> Column:
    # site rules before patterns, then the longer, then the earlier
    weight = (len(rule.text) + 1) if rule.site else 0
    return F.struct(F.lit(weight).alias("w"), F.lit(-order).alias("o"), F.lit(rule.text).alias("rule"), F.lit(rule.action).alias("action"),
                    F.lit(rule.regex).alias("re"), F.lit(rule.site).alias("site"))


def _block(rules: list[tuple[int, Rule]], count: dict[str, int], tokens: Column) -> Column:
    """Candidate rules of a URL from one block: a constant table of buckets, hashed by token."""
    size = 1 << max(1, (2 * len(rules) - 1).bit_length())
    buckets: list[list[Column]] = [[] for _ in range(size)]
    always = []
    for order, rule in rules:
        own = rule.tokens()
        if own:
            best = min(own, key=lambda t: (count.get(t, 0), -len(t), t))
            buckets[zlib.crc32(best.encode()) % size].append(F.struct(F.lit(best).alias("t"), _entry(order, rule).alias("e")))
        else:
            always.append(_entry(order, rule))
    none = F.struct(F.lit(" ").alias("t"), _entry(0, Rule("", "", False)).alias("e"))
    table = F.array(*[F.array(*(b or [none])) for b in buckets])
    fetch = lambda t: F.transform(F.filter(F.get(table, (F.crc32(t.cast("binary")) % size).cast("int")), lambda x: x["t"] == t), lambda x: x["e"])
    found = F.flatten(F.transform(tokens, fetch))
    return F.concat(found, F.array(*always)) if always else found


def filter_urls(df: DataFrame, rules: list[Rule], url_col: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (the site rule that decided, else null) and ``verdict``."""
    if any(r.action not in ("allow", "block") for r in rules):
        raise ValueError("a rule's action is allow or block")
    count = token_counts(df, url_col, sorted({t for r in rules for t in r.tokens()}))
    url = F.coalesce(F.col(url_col), F.lit(""))
    host, path = host_and_path(F.col(url_col))
    added = ["host", "path", "rule", "verdict"]
    kept = [c for c in df.columns if c not in added]
    out = df.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"), ascii_lower(url).alias("__url"), url_tokens(url).alias("__tokens"))
    site = F.concat("host", "path")
    best = F.lit(None)
    numbered = list(enumerate(rules))
    for k in range(0, len(numbered), RULES_PER_BLOCK):
        candidates = _block(numbered[k:k + RULES_PER_BLOCK], count, F.col("__tokens"))
        hits = F.filter(candidates, lambda e: F.regexp_like(F.when(e["site"], site).otherwise(F.col("__url")), e["re"]))
        top = F.array_max(hits)
        best = top if k == 0 else F.greatest(best, top)
    if not rules:
        return out.select(*kept, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    out = out.withColumn("__best", best)
    return out.select(*[F.col(f"`{c}`") for c in kept], "host", "path", F.when(F.col("__best.site"), F.col("__best.rule")).alias("rule"), F.coalesce("__best.action", F.lit(default)).alias("verdict"))
