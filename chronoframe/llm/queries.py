"""Registered queries of the operators: each one over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- op1 -------------------------------------------------------------------------------------------------------------

#: What the method itself blocks: words of unwanted sites, and programs for download.
BLOCKED_WORDS = ("casino", "porn", "viagra", "malware", "phishing", "adserver", "doubleclick")
BLOCKED_FILES = ("exe", "apk", "msi")

_REST = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
OP1_SQL = f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(url, ''), {_ASCII}) AS low,
         translate(regexp_extract({_REST}, '^[^/?#]*'), {_ASCII}) AS host,
         regexp_extract({_REST}, '^[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
judged AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN regexp_matches(low, '(?:[^a-z0-9]|^)(?:{'|'.join(BLOCKED_WORDS)})(?:[^a-z0-9]|$)') THEN 'block'
            WHEN regexp_matches(low, '[.](?:{'|'.join(BLOCKED_FILES)})(?:[^a-z0-9]|$)') THEN 'block'
            ELSE 'allow' END AS verdict
FROM judged
"""


def op1_rules() -> list:
    from chronoframe.llm.url_filters import Rule

    sites = [Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/")]
    return sites + [Rule("block", f"^{w}^", site=False) for w in BLOCKED_WORDS] + [Rule("block", f".{w}^", site=False) for w in BLOCKED_FILES]


@query("op1_url_filters", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronoframe.llm.url_filters import filter_urls

    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), op1_rules()).select("page_id", "host", "path", "rule", "verdict")


# --- op2, op7 --------------------------------------------------------------------------------------------------------

@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from chronoframe.llm.byte_bpe import encode

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode(docs, path, public_tokenizers.PATTERN, keep_ids=False).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from chronoframe.llm.token_counts import token_counts

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("word_bpe_49k.json"), limit=2048).select("doc_id", "n_bytes", "n_tokens", "over_limit")


# --- op8, op10 -------------------------------------------------------------------------------------------------------

@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronoframe.llm import toxicity
    from chronoframe.llm.language_id import held_out

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model, threshold=0.3)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronoframe.llm.language_id import fit_profiles, held_out, identify

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = fit_profiles(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    return identify(docs.select("doc_id", "text"), profiles).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


# --- op4, op5 --------------------------------------------------------------------------------------------------------

_SPLIT = "regexp_split_to_array({text}, '[ \\x09-\\x0D]+')"
OP4_SQL = f"""
WITH docs AS (SELECT doc_id, list_filter({_SPLIT.format(text="coalesce(text, '')")}, lambda x: x <> '') AS words FROM documents),
word AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM docs),
win AS (SELECT *, string_agg(word, ' ') OVER w AS s, count(*) OVER w AS n FROM word
        WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
seen AS (SELECT s, min(doc_id) AS first FROM win WHERE n = 13 GROUP BY s),
marked AS (SELECT win.doc_id, i, word, coalesce(first < win.doc_id, false) AS repeats
           FROM win LEFT JOIN seen ON win.n = 13 AND win.s = seen.s),
gone AS (SELECT *, bool_or(repeats) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS out FROM marked),
one AS (SELECT doc_id, count(*) AS n_words, count_if(out) AS n_removed,
               coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT out), '') AS kept FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs d LEFT JOIN one USING (doc_id)
"""


@query("op4_substring_dedup", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronoframe.llm.substring_dedup import dedup

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs, 13, outputs=("n_words", "n_removed", "kept_sha256")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op5_suffix_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronoframe.llm.suffix_dedup import dedup

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs, 100, outputs=("n_bytes", "n_removed", "n_spans", "kept_sha256")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


# --- op3 -------------------------------------------------------------------------------------------------------------

OP3_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter({_SPLIT.format(text=f"translate(coalesce(text, ''), {_ASCII})")}, lambda x: x <> '') AS words FROM documents),
word AS (SELECT doc_id, len(words) AS size, unnest(words) AS word, unnest(range(len(words))) AS i FROM docs),
win AS (SELECT doc_id, size, i, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS s FROM word),
sets AS (SELECT DISTINCT doc_id, s FROM win WHERE i <= size - 4 OR (size < 4 AND i = 0)),
size AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce((SELECT min(b) FROM reach WHERE a = d.doc_id), d.doc_id)) AS component_id
FROM docs d LEFT JOIN size ON size.doc_id = d.doc_id
"""


@query("op3_ngram_jaccard_join", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronoframe.llm.ngram_join import components

    return components(table(spark, sf_dir, "documents").select("doc_id", "text"), 4, 85)


# --- op6 -------------------------------------------------------------------------------------------------------------

@query("op6_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronoframe.llm.fingerprints import compare_with_edited

    return compare_with_edited(table(spark, sf_dir, "documents").select("doc_id", "text"))


# --- op9 -------------------------------------------------------------------------------------------------------------

@query("op9_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronoframe.llm.decontam import contaminated

    return contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


# --- op11 ------------------------------------------------------------------------------------------------------------

def _op11_sql(parts: int = 16, width: int = 4, entries: int = 64, rounds: int = 2) -> str:
    """Assignment and update written out per round: ``bK`` the codebooks after round K, ``aK`` the nearest entries under them."""
    distance = " + ".join(f"(x[{k}] - c[{k}]) * (x[{k}] - c[{k}])" for k in range(1, width + 1))
    below = "CAST((s{0} - ((s{0} % n) + n) % n) // n AS BIGINT)"
    steps = []
    for k in range(rounds + 1):
        if k:
            sums = ", ".join(f"CAST(sum(x[{i}]) AS BIGINT) AS s{i}" for i in range(1, width + 1))
            moved = ", ".join(below.format(i) for i in range(1, width + 1))
            steps.append(f"m{k} AS (SELECT part, entry, count(*) AS n, {sums} FROM part JOIN a{k - 1} USING (r, part) GROUP BY part, entry)")
            steps.append(f"b{k} AS MATERIALIZED (SELECT part, entry, CASE WHEN n IS NULL THEN c ELSE [{moved}] END AS c FROM b{k - 1} LEFT JOIN m{k} USING (part, entry))")
        steps.append(f"a{k} AS MATERIALIZED (SELECT r, part, arg_min(entry, d * 100000 + entry) AS entry, min(d) AS d "
                     f"FROM (SELECT r, part, entry, {distance} AS d FROM part JOIN b{k} USING (part)) GROUP BY r, part)")
    return f"""
WITH vec AS (SELECT *, row_number() OVER (ORDER BY vec_id, embedding) AS r FROM embeddings
             WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
whole AS (SELECT r, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM vec),
part AS MATERIALIZED (SELECT r, p AS part, v[p * {width} + 1:(p + 1) * {width}] AS x FROM whole, range({parts}) t(p)),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS c FROM part WHERE r <= {entries}),
{", ".join(steps)},
coded AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS h FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT h FROM book) AS codebooks_sha256
FROM vec JOIN coded USING (r)
"""


OP11_SQL = _op11_sql()


@query("op11_vector_codes", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronoframe.llm.vector_codes import compress

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return compress(vectors).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


# --- op12 ------------------------------------------------------------------------------------------------------------

OP12_SQL = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
cut AS (SELECT *, regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+') AS units,
               CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
               CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM docs),
formed AS (SELECT *, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
                  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                       WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid, array_to_string(units[b + 1:], '') AS suf FROM formed)
SELECT doc_id, CAST(len(units) AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


@query("op12_fill_in_middle", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronoframe.llm.fill_in_middle import fill_in_middle, restore

    done = restore(fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


# --- op13 ------------------------------------------------------------------------------------------------------------

@query("op13_quality")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronoframe.llm import quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~quality.held_out(F.col("doc_id"))).select("doc_id", "quality")
    scored = quality.score(docs, quality.fit(docs, labels), threshold=0.3)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
