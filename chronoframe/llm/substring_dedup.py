"""Operator 4: substring dedup by super-k-mer partitioning.

A window is ``width`` consecutive words of one document. Every word covered by
a window whose words also start in a document with a smaller id is removed;
windows are judged on the input. The minimiser of a window is the least hash
of its ``MINIMISER_WORDS``-word parts; consecutive windows of one document
with the same minimiser travel as one packed string (its words once, instead
of once per window) to the minimiser's bucket. Frequent parts rank
last (:func:`chronoframe.llm.superkmers.plan`), so a common phrase does
not draw every text to one bucket. There the windows are sorted by
a 128-bit hash, so equal ones stand together, and each finds its least id.

Before the shuffle a task settles what it can alone: of equal windows in one
piece of its input, all but those of the least id are already known to go, and
only the least one travels on. A passage that a third of all documents share
therefore leaves each piece once, whatever the number of its copies there.

Buckets answer with ranges of windows per document; documents join them by id.
A range carries a hash of its windows, so rows that share an id but not their
text do not take each other's ranges.

Cases: null text has no words; null ids rank after all others and remove
nothing from each other, nor do rows with the same id; texts shorter than the
width keep everything; columns of the input are kept, those named like new
ones are replaced; empty tables give an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoframe.llm.arrays import U64, chunks, ids, owners, poly, runs, sliding_min, word_hashes, word_spans
from chronoframe.llm.memories import release
from chronoframe.llm.superkmers import PLAIN, RANGE_SCHEMA, RANGES, STRINGS, PartOrder, bucket_of, pack, packed_strings, plan, range_arrays, range_rows, record, unpack, with_ranges
from chronoframe.llm.storage import document_batches

MINIMISER_WORDS = 3
#: Seeds of the two hashes of a word.
FIRST, SECOND = 10, 15
PIECE = (2 << 20) - 1


def window_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of every window of words, from two independent hashes of each word (``words`` is the first)."""
    a, b = poly(11), poly(12)
    return a.windows_of(words, width), b.windows_of(word_hashes(data, starts, ends, SECOND), width)


def valid_windows(bounds: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which window starts stay inside their document."""
    ok = np.arange(n) <= np.repeat(bounds[1:] - width, np.diff(bounds))[:n]
    return ok


def not_first(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, part: np.ndarray | None = None) -> np.ndarray:
    """Windows that an equal window of a smaller id comes before; ``doc`` has the id of each window, or of each ``part``."""
    order = np.argsort(h1)
    s1 = h1[order]
    same = np.zeros(len(order), dtype=bool)
    same[1:] = s1[1:] == s1[:-1]
    twin = same.copy()
    twin[:-1] |= same[1:]
    order = order[twin]
    out = np.zeros(len(h1), dtype=bool)
    if not len(order):
        return out
    order = order[np.lexsort((h2[order], h1[order]))]
    s1, s2 = h1[order], h2[order]
    first = np.flatnonzero(np.concatenate(([True], (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1]))))
    own = doc[order if part is None else part[order]]
    least = np.repeat(np.minimum.reduceat(own, first), np.diff(np.append(first, len(order))))
    out[order] = own > least
    return out


def _ranges(flag: np.ndarray, h1: np.ndarray, doc: np.ndarray, position: np.ndarray, part: np.ndarray | None = None):
    """Runs of flagged neighbours as (document, first window, windows, sum of their hashes); a run does not leave its ``part``
    (``doc`` then has the id of each part)."""
    if part is not None:
        cut = np.zeros(len(flag), dtype=bool)
        cut[1:] = part[1:] != part[:-1]
    else:
        cut = np.zeros(len(flag), dtype=bool)
    begin = flag.copy()
    begin[1:] &= ~flag[:-1] | cut[1:]
    end = flag.copy()
    end[:-1] &= ~flag[1:] | cut[1:]
    a, b = np.flatnonzero(begin), np.flatnonzero(end) + 1
    total = np.concatenate((np.zeros(1, U64), np.cumsum(h1)))
    return doc[a if part is None else part[a]], position[a], b - a, (total[b] - total[a]).view(np.int64)


def parts_of(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each part that can be a window's minimiser."""
    return poly(13).windows_of(words, min(MINIMISER_WORDS, width))


def parts_in(data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Every part of every text (and of two neighbours, at their border)."""
    starts, ends, _ = word_spans(data, offsets)
    return parts_of(word_hashes(data, starts, ends, FIRST), width)


def split(batches, width: int, n_buckets: int, order: PartOrder = PLAIN):
    """Map side: settle equal windows of a piece, send the rest as packed strings."""
    release()
    for batch in batches:
        doc_ids, column = ids(batch.column(0)), batch.column(1)
        for first, last, data, offsets in chunks(column, PIECE):
            starts, ends, bounds = word_spans(data, offsets)
            words = word_hashes(data, starts, ends, FIRST)
            n = len(words) - width + 1
            if n <= 0:
                continue
            h1, h2 = window_hashes(data, starts, ends, width, words)
            valid = valid_windows(bounds, width, n)
            own = owners(bounds)[:n]
            doc = doc_ids[first:last][own]
            position = np.arange(n) - bounds[own]
            at = np.flatnonzero(valid)
            settled = np.zeros(n, dtype=bool)
            settled[at] = not_first(h1[at], h2[at], doc[at])
            out = []
            if settled.any():
                found = _ranges(settled, h1, doc, position)
                out.append((int(found[0][0] % n_buckets), pack(RANGES, *found)))
            send = valid & ~settled
            least = sliding_min(order.ranks(parts_of(words, width)), width - min(MINIMISER_WORDS, width) + 1)
            begin = send.copy()
            begin[1:] &= ~send[:-1] | (least[1:] != least[:-1])
            end = send.copy()
            end[:-1] &= ~send[1:] | (least[1:] != least[:-1])
            a, b = np.flatnonzero(begin), np.flatnonzero(end)
            if len(a):
                left = starts[a]
                out += packed_strings(bucket_of(least[a], n_buckets), data, left, ends[b + width - 1] - left, doc[a], position[a].astype(np.int32))
            if out:
                yield record(out)


def settle(pdf: pd.DataFrame, width: int) -> pd.DataFrame:
    """Reduce side: one bucket's windows, sorted. A window is held as two hashes, its string and its position (24 bytes)."""
    found, docs, parts, base = [], [], [], 0
    for blob in pdf["blob"]:
        kind, *x = unpack(blob)
        if kind == RANGES:
            found.append(x)
            continue
        data, lengths, doc, position = x
        offsets = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
        starts, ends, bounds = word_spans(data, offsets)
        h1, h2 = window_hashes(data, starts, ends, width, word_hashes(data, starts, ends, FIRST))
        own = owners(bounds)[:len(h1)]
        ok = valid_windows(bounds, width, len(h1))
        own, at = own[ok], np.flatnonzero(ok)
        docs.append(doc)
        parts.append((h1[ok], h2[ok], (position[own] + (at - bounds[own])).astype(np.int32), (own + base).astype(np.int32)))
        base += len(lengths)
    if parts:
        columns = [list(x) for x in zip(*parts)]
        del parts
        h1, h2, position, part = (np.concatenate(columns.pop(0)) for _ in range(4))      # each column's pieces go as it is made
        doc = np.concatenate(docs)
        found.append(_ranges(not_first(h1, h2, doc, part), h1, doc, position, part))
    return range_rows(found)


def covered(text: bytes, found: tuple, width: int) -> np.ndarray:
    """Words to remove from one text."""
    data = np.frombuffer(text, dtype=np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    h1 = poly(11).windows_of(word_hashes(data, starts, ends, FIRST), width)
    first, n, h = found
    ok = (first >= 0) & (first + n <= len(h1))
    first, n, h = first[ok], n[ok], h[ok]
    total = np.concatenate((np.zeros(1, U64), np.cumsum(h1)))
    ok = (total[first + n] - total[first]).view(np.int64) == h
    step = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(step, first[ok], 1)
    np.add.at(step, (first + n)[ok] + width - 1, -1)
    return np.cumsum(step)[:-1] > 0


def dedup(df: DataFrame, width: int = 13, id_col: str = "doc_id", text_col: str = "text", outputs: tuple = ("kept_text", "removed", "n_words", "n_removed", "kept_sha256")) -> DataFrame:
    """Add the chosen outputs: ``kept_text`` (the text itself if nothing goes, else the kept words joined by one space),
    ``removed`` (runs of word positions as structs), ``n_words``, ``n_removed``, ``kept_sha256`` (of the kept words joined by one space)."""
    texts = document_batches(df).select(F.col(f"`{text_col}`").alias("text"))
    order, n_buckets = plan(texts, lambda data, offsets: parts_in(data, offsets, width), PIECE)
    shared = df.sparkSession.sparkContext.broadcast(order)
    sent = df.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).mapInArrow(lambda it: split(it, width, n_buckets, shared.value), "bucket long, blob binary")
    found = sent.groupBy("bucket").applyInPandas(lambda pdf: settle(pdf, width), RANGE_SCHEMA)
    rest = [c for c in df.columns if c not in outputs]
    joined = with_ranges(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*rest, id_col, text_col])]), found, id_col)

    def finish(batches):
        release()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            marks = batch.column(batch.schema.get_field_index("__ranges"))
            out: dict[str, list] = {k: [] for k in outputs}
            for row in range(batch.num_rows):
                text = texts[row].as_py()
                raw = (text or "").encode("utf-8")
                words = raw.split()
                found = range_arrays(marks, row)
                gone = covered(raw, found, width) if found else None
                kept = words if gone is None else [w for w, g in zip(words, gone) if not g]
                joined = b" ".join(kept)
                if "kept_text" in out:
                    out["kept_text"].append(text if len(kept) == len(words) else joined.decode("utf-8"))
                if "removed" in out:
                    out["removed"].append([] if gone is None else [{"first": int(a), "n": int(b - a)} for a, b in zip(*runs(gone))])
                for k, v in (("n_words", len(words)), ("n_removed", len(words) - len(kept)), ("kept_sha256", None)):
                    if k in out:
                        out[k].append(hashlib.sha256(joined).hexdigest() if v is None else v)
            kinds = {"kept_text": pa.string(), "removed": pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32())])), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string()}
            cols = {c: batch.column(batch.schema.get_field_index(c)) for c in rest}
            yield pa.RecordBatch.from_pydict(cols | {k: pa.array(v, kinds[k]) for k, v in out.items()})

    kinds = {"kept_text": "string", "removed": "array<struct<first:int,n:int>>", "n_words": "long", "n_removed": "long", "kept_sha256": "string"}
    schema = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest] + [f"{k} {kinds[k]}" for k in outputs]
    return joined.mapInArrow(finish, ", ".join(schema))
