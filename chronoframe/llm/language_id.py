"""Operator 10: language identification by rank-order profiles of character n-grams (1 to 3, words padded with blanks).

*Fit*: n-gram counts of every learning row, summed per language in Spark
(each task sends one row per language and n-gram it met), the
``PROFILE`` most frequent n-grams of each language are its profile.
*Predict*: a document's own ``PROFILE`` most frequent n-grams are compared
with each profile by their out-of-place distance; an n-gram that a profile
lacks costs ``PROFILE`` places. Ties of counts go by the n-gram's hash, ties
of distances by the language's name. N-grams are 44-bit hashes, so one sort
of 64-bit integers groups a batch of documents by document and n-gram.

Profiles are ``PROFILE`` rows per language: a bounded broadcast. Prediction
needs no shuffle.

Cases: null text, or text without a letter, is ``und`` with score 0, also if
nothing was learnt; rows with null language or null id are not learnt from;
columns of the input are kept, those named like new ones are replaced.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoframe.llm.arrays import U64, mix
from chronoframe.llm.storage import document_batches

PROFILE = 300
BLANK = 32
GRAM_BITS = 44
PIECE_CHARS = 2 << 20


def held_out(doc_id: Column) -> Column:
    """Rows kept for measuring: crc32 of the id's text leaves 2 modulo 4 (null ids: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def pieces(texts: list):
    """Runs of rows of about ``PIECE_CHARS`` characters: ``(first_row, code points, bounds)``, lower-cased."""
    row, n = 0, len(texts)
    while row < n:
        parts, size, first = [], 0, row
        while row < n and (not parts or size < PIECE_CHARS) and row - first < 1 << 20:
            raw = (texts[row] or "").lower().encode("utf-32-le", "surrogatepass")
            parts.append(raw)
            size += len(raw) // 4
            row += 1
        bounds = np.concatenate(([0], np.cumsum([len(p) // 4 for p in parts])))
        yield first, np.frombuffer(b"".join(parts), dtype="<u4"), bounds


def grams(points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(document, n-gram hash)`` of every n-gram; each run of other characters is one blank, documents start and end with one."""
    docs = len(bounds) - 1
    letter = _letters()[points]
    before = np.zeros(len(points), dtype=bool)
    before[1:] = letter[:-1]
    starts = bounds[:-1][bounds[:-1] < len(points)]
    before[starts] = False
    keep = letter | before
    owner = np.repeat(np.arange(docs, dtype=np.int64), np.diff(bounds))[keep]
    symbol = np.where(letter, points, BLANK)[keep].astype(U64)
    # a blank before and after every document
    at = np.searchsorted(owner, np.arange(docs))
    owner = np.insert(owner, np.concatenate((at, np.append(at[1:], len(owner)))), np.concatenate((np.arange(docs), np.arange(docs))))
    symbol = np.insert(symbol, np.concatenate((at, np.append(at[1:], len(symbol)))), U64(BLANK))
    order = np.argsort(owner, kind="stable") if np.any(owner[1:] < owner[:-1]) else slice(None)
    owner, symbol = owner[order], symbol[order]
    out_owner, out_gram = [owner[symbol != BLANK]], [symbol[symbol != BLANK]]
    if len(symbol) > 2:
        same = owner[1:] == owner[:-1]
        two = same & ~((symbol[1:] == BLANK) & (symbol[:-1] == BLANK))
        pair = symbol[:-1] << U64(21) | symbol[1:]
        out_owner.append(owner[:-1][two])
        out_gram.append(pair[two])
        three = two[:-1] & two[1:] & (symbol[1:-1] != BLANK)
        out_owner.append(owner[:-2][three])
        out_gram.append((pair[:-1] << U64(21) | symbol[2:])[three])
    return np.concatenate(out_owner), mix(np.concatenate(out_gram)) >> U64(64 - GRAM_BITS)


def counted(owner: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, n-gram and count of each distinct pair, in order."""
    key = np.sort(owner.astype(U64) << U64(GRAM_BITS) | gram)
    if not len(key):
        return np.zeros(0, np.int64), key, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    count = np.diff(np.append(first, len(key)))
    key = key[first]
    return (key >> U64(GRAM_BITS)).astype(np.int64), key & U64((1 << GRAM_BITS) - 1), count


def ranked(owner: np.ndarray, gram: np.ndarray, count: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, n-gram and rank of each document's ``PROFILE`` most frequent n-grams."""
    start = np.searchsorted(owner, np.arange(docs))
    within = np.arange(len(owner)) - start[owner]
    most = (1 << 22) - 1
    key = np.sort(owner.astype(U64) << U64(43) | (most - np.minimum(count, most)).astype(U64) << U64(21) | np.minimum(within, (1 << 21) - 1).astype(U64))
    owner2 = (key >> U64(43)).astype(np.int64)
    rank = np.arange(len(key)) - start[owner2]
    take = rank < PROFILE
    owner2, rank = owner2[take], rank[take]
    return owner2, gram[start[owner2] + (key[take] & U64((1 << 21) - 1)).astype(np.int64)], rank


def fit_profiles(df: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> dict[str, list[int]]:
    """Profile of each language in ``df``: its n-grams by falling count."""
    def count(batches):
        total: dict = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            names = sorted(set(langs))
            number = {x: i for i, x in enumerate(names)}
            for first, points, bounds in pieces(batch.column(0).to_pylist()):
                owner, gram = grams(points, bounds)
                lang = np.array([number[x] for x in langs[first:first + len(bounds) - 1]], dtype=np.int64)
                for_lang, gram, n = counted(lang[owner], gram)
                for i, name in enumerate(names):
                    total.setdefault(name, []).append((gram[for_lang == i], n[for_lang == i]))
                    if len(total[name]) > 16:
                        total[name] = [_summed(total[name])]
        for name, parts in total.items():
            gram, n = _summed(parts)
            for k in range(0, len(gram), 50_000):
                part = slice(k, k + 50_000)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(gram[part])), "gram": pa.array(gram[part].astype(np.int64)), "n": pa.array(n[part].astype(np.int64))})

    rows = document_batches(df).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sums = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = sums.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("r") <= size)
    out: dict[str, list[int]] = {}
    for r in top.orderBy("lang", "r").select("lang", "gram").collect():
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


def _summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
    gram, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(gram)
    gram, n = gram[order], n[order]
    if not len(gram):
        return gram, n
    first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
    return gram[first], np.add.reduceat(n, first)


def distances(texts: list, known: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Out-of-place distance of each text to each profile, and the number of its ranked n-grams."""
    total, size = [], []
    for _, points, bounds in pieces(texts):
        docs = len(bounds) - 1
        owner, gram, rank = ranked(*counted(*grams(points, bounds)), docs)
        at = np.minimum(np.searchsorted(known, gram), max(0, len(known) - 1))
        row = np.where(known[at] == gram, at, len(known)) if len(known) else np.zeros(len(gram), dtype=np.int64)
        places = ranks[row]
        cost = np.where(places < 0, PROFILE, np.abs(places - rank[:, None]))
        total.append(np.stack([np.bincount(owner, cost[:, k], docs) for k in range(ranks.shape[1])], axis=1))
        size.append(np.bincount(owner, minlength=docs))
    return np.concatenate(total), np.concatenate(size)


def identify(df: DataFrame, profiles: dict[str, list[int]], text_col: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (the runner-up's share of the two smallest distances: 0.5 a tie, 1 a perfect match)."""
    names = sorted(profiles)
    known = np.array(sorted({g for p in profiles.values() for g in p}), dtype=U64)
    ranks = np.full((len(known) + 1, max(1, len(names))), -1, dtype=np.int64)
    for k, name in enumerate(names):
        ranks[np.searchsorted(known, np.array(profiles[name], dtype=U64)), k] = np.arange(len(profiles[name]))
    added = ["lang_pred", "score"]
    rest = [c for c in df.columns if c not in added]
    keep_text = text_col in rest
    document_batches(df)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            cost, size = distances(batch.column(batch.schema.get_field_index(text_col)).to_pylist(), known, ranks)
            best = np.argmin(cost, axis=1)
            least = np.sort(cost, axis=1)
            second = least[:, 1] if cost.shape[1] > 1 else size * float(PROFILE)
            sure = np.where(least[:, 0] + second > 0, second / np.maximum(least[:, 0] + second, 1), 0.5)
            found = (size > 0) & bool(names)
            cols = {c: batch.column(batch.schema.get_field_index(c)) for c in rest}
            cols["lang_pred"] = pa.array([names[b] if f else "und" for b, f in zip(best, found)], pa.string())
            cols["score"] = pa.array(np.where(found, sure, 0.0), pa.float64())
            yield pa.RecordBatch.from_pydict(cols)

    assert keep_text
    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest] + ["lang_pred string", "score double"]
    return df.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(run, ", ".join(kinds))
