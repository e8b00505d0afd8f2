"""Operator 6: document fingerprints. The ``k`` least distinct hashes of a text's word shingles (a bottom-k sketch).

Sketches merge (the ``k`` least of both), so parts of a text or of a corpus
can be sketched apart, and they estimate resemblance, containment and the
number of distinct shingles. Only built-in functions run; a text is sketched
in its own row, without a shuffle.

A shingle is ``SHINGLE`` consecutive words: the sketch of every text, long or
short. A text of fewer than ``SHORT`` words has a second sketch, of its single
words and their first three characters. Two short texts are compared by both,
all others by the first alone, so like meets like. Words are runs of anything
but space and \\t \\n \\v \\f \\r. Hashes are 48-bit, a fingerprint is the
hexadecimal digits of what a text has (both sketches of a short one, merged),
so equal texts have equal fingerprints.

Cases: null text is empty; a text without words has an empty fingerprint
(likeness to another empty one 1, to any other 0); repeated rows are sketched
each; columns of the input are kept, those named like new ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronoframe.llm import bitmaps

SHINGLE, SIZE, HASH_BITS = 5, 64, 48
#: Texts with fewer words have their words and their heads as shingles too: a few windows alone say little.
SHORT = 24
#: Rows of one window partition when neighbours by id are looked up.
ID_SPAN = 4096


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body has it (also inside lambdas)."""
    return F.get(F.transform(F.array(value), body), 0)


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")


def shingle_hashes(word: Column, width: int = SHINGLE) -> Column:
    """48-bit hash of every shingle of an array of words."""
    top = F.lit((1 << HASH_BITS) - 1)
    n = F.size(word)
    many = F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(word, i + k) for k in range(width)]).bitwiseAND(top))
    return F.when(n >= width, many).otherwise(F.array().cast("array<bigint>"))


def word_hashes(word: Column) -> Column:
    """48-bit hash of every word and of its head, null from ``SHORT`` words on."""
    top = F.lit((1 << HASH_BITS) - 1)
    few = F.transform(word, lambda w: F.xxhash64(w).bitwiseAND(top))
    heads = F.transform(word, lambda w: F.xxhash64(F.substring(w, 1, 3), F.lit("-")).bitwiseAND(top))
    return F.when(F.size(word) < SHORT, F.concat(few, heads))


def least(hashes: Column, k: int = SIZE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = SIZE) -> Column:
    """Bottom-k sketch of a text, as a rising array."""
    return let(words(text), lambda w: least(shingle_hashes(w), k))


def sketches(text: Column, k: int = SIZE) -> Column:
    """``sketch`` of a text and its ``word_sketch``, null if the text is not short."""
    return let(words(text), lambda w: F.struct(least(shingle_hashes(w), k).alias("sketch"), least(word_hashes(w), k).alias("word_sketch")))


def merged(a: Column, b: Column, k: int = SIZE) -> Column:
    """Sketch of the union of two shingle sets."""
    return least(F.concat(a, b), k)


def distinct_shingles(s: Column, k: int = SIZE) -> Column:
    """Estimated number of distinct shingles (exact below ``k``)."""
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) * F.lit(float(1 << HASH_BITS)) / F.element_at(s, -1))


def resemblance(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated Jaccard similarity: the share of the union's ``k`` least hashes that both have."""
    share = lambda union: F.when(F.size(union) == 0, 1.0).otherwise(F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.size(union))
    return let(merged(a, b, k), share).cast("double")


def whole(s: Column, k: int = SIZE) -> Column:
    """One sketch of all that a text has, from its :func:`sketches`."""
    return F.when(s["word_sketch"].isNull(), s["sketch"]).otherwise(merged(s["sketch"], s["word_sketch"], k))


def likeness(a: Column, b: Column, k: int = SIZE) -> Column:
    """Resemblance of two texts from their :func:`sketches`: with the words if both are short, else by the windows alone."""
    short = a["word_sketch"].isNotNull() & b["word_sketch"].isNotNull()
    part = lambda s: F.when(short, whole(s, k)).otherwise(s["sketch"])
    return resemblance(part(a), part(b), k)


def containment(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated share of a's shingles that b has, from the resemblance and the three set sizes."""
    share = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k) / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(share, F.lit(1.0)))


def hexadecimal(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda h: F.lower(F.lpad(F.hex(h), HASH_BITS // 4, "0"))), "")


def fingerprint(df: DataFrame, text_col: str = "text", k: int = SIZE) -> DataFrame:
    """Add ``sketch``, ``word_sketch`` (short texts), ``fingerprint`` and ``distinct_estimate``."""
    kept = [c for c in df.columns if c not in ("sketch", "word_sketch", "fingerprint", "distinct_estimate")]
    out = df.select(*[F.col(f"`{c}`") for c in kept], sketches(F.col(f"`{text_col}`"), k).alias("__s"))
    all_of = whole(F.col("__s"), k)
    return out.select(*[F.col(f"`{c}`") for c in kept], "__s.sketch", "__s.word_sketch", hexadecimal(all_of).alias("fingerprint"), distinct_shingles(all_of, k).alias("distinct_estimate"))


def merge_parts(df: DataFrame, by: list[str], k: int = SIZE, sketch_col: str = "sketch") -> DataFrame:
    """One sketch for each key from the sketches of its parts: hashes are ranked across a key's parts, at most ``k`` kept."""
    one = df.select(*by, F.explode(sketch_col).alias("h")).distinct()
    ranked = one.withColumn("r", F.row_number().over(W.partitionBy(*by).orderBy("h"))).where(F.col("r") <= k)
    return ranked.groupBy(*by).agg(F.sort_array(F.collect_list("h")).alias(sketch_col))


def with_next(df: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text", prepare=None) -> DataFrame:
    """Add ``next_<column>`` of the row with the next id (after the last: the first); rows with null id get nulls.

    Rows go to spans of ``ID_SPAN`` ids. A span's first id is also handed to
    the span before it, so each span finds its neighbours alone: one shuffle,
    and a table of two numbers for each span. ``prepare`` may add columns
    before the shuffle.
    """
    span = F.floor(F.col(id_col) / ID_SPAN)
    real = df.where(F.col(id_col).isNotNull())
    firsts = real.groupBy(span.alias("s")).agg(F.min(F.col(id_col).cast("long")).alias("first"))
    order = W.orderBy("s")
    last = F.last("s").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    chain = firsts.select(F.col("first").alias("__first"), F.coalesce(F.lag("s").over(order), last).alias("__span"))
    guests = bitmaps.having(df, id_col, chain, "__first").join(chain, F.col(id_col) == F.col("__first")).drop("__first")
    # rows without an id have no neighbours: they may go anywhere
    home = F.when(F.col(id_col).isNotNull(), span).otherwise(F.xxhash64(text_col) % 1024)
    rows = df.withColumn("__span", home).withColumn("__guest", F.lit(False)).unionByName(guests.withColumn("__guest", F.lit(True)))
    rows = prepare(rows) if prepare else rows
    by = W.partitionBy("__span", F.col(id_col).isNull()).orderBy("__guest", id_col, text_col)
    seen = rows.select("*", *[F.lead(F.col(c)).over(by).alias(f"next_{c}") for c in columns]).where("not __guest")
    kept = [c for c in rows.columns if c not in ("__span", "__guest")]
    return seen.select(*kept, *[F.when(F.col(id_col).isNotNull(), F.col(f"next_{c}")).alias(f"next_{c}") for c in columns])


def compare_with_edited(df: DataFrame, k: int = SIZE) -> DataFrame:
    """Fingerprints of every text and of its edited copy (the last quarter of its code points from the next document)."""
    docs = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = with_next(docs, ["text", "sketches"], prepare=lambda rows: rows.select("*", sketches(F.col("text"), k).alias("sketches")))
    n = F.char_length("text")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 4) as int))"), F.expr("substring(coalesce(next_text, ''), 1, cast(floor(char_length(text) / 4) as int))"))
    docs = docs.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sketches", "next_sketches")
    docs = docs.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sketches", "next_sketches", sketches(F.col("edited"), k).alias("edited_sketches"))
    own, new = F.col("sketches"), F.col("edited_sketches")
    none = F.array().cast("array<bigint>")
    following = F.coalesce(F.col("next_sketches"), F.struct(none.alias("sketch"), none.alias("word_sketch")))       # without one: like an empty text
    return docs.select("doc_id", "n_chars", "edited_sha256", hexadecimal(whole(own, k)).alias("fingerprint"), hexadecimal(whole(new, k)).alias("edited_fingerprint"),
                       likeness(own, new, k).alias("near_edited"), likeness(own, following, k).alias("near_next"))
