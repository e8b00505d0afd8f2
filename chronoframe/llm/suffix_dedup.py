"""Operator 5: suffix-array dedup with a hash-compared suffix sort.

Every byte covered by a ``width``-byte string that also starts earlier
(smaller id, or the same document further left) is removed; strings are judged
on the input and never cross documents.

Only suffixes that can agree on ``width`` bytes need to meet. Each window has
a minimiser (least hash of its ``MINIMISER_BYTES``-byte parts); windows with
equal minimisers go to one bucket, neighbours with the same minimiser as one
packed string; frequent parts rank last, so a common line does
not draw every text to one bucket. In a bucket, strings whose minimiser occurs once are let go.
Of equal strings the earliest stays. The suffixes of those left are sorted per
minimiser by a mergesort whose comparisons take the longest common extension
from prefix polynomial hashes by binary search (at most log2(width) steps);
suffixes found to agree on ``width`` bytes are merged into one, the later
marked. What the hashes call equal is verified byte by byte.

Before the shuffle, equal strings inside one piece of a task's input are
settled there (the earliest travels on). Answers are byte ranges per document,
each with a hash of its bytes, so rows that share an id but not their text do
not take each other's ranges.

Cases: null text is empty; null ids rank after all others (rows that share an
id are taken as one text by position: equal rows keep alike);
texts shorter than the width keep everything; columns of the input are kept,
those named like new ones are replaced; empty tables give an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoframe.llm.arrays import U64, chunks, ids, owners, poly, ranges, runs, sliding_min
from chronoframe.llm.superkmers import PLAIN, RANGE_SCHEMA, RANGES, PartOrder, bucket_of, pack, packed_strings, plan, range_arrays, range_rows, record, unpack, with_ranges
from chronoframe.llm.storage import document_batches

MINIMISER_BYTES = 16
PIECE, SLICE = (2 << 20) - 1, 1 << 20


class HashCollision(Exception):
    """Two different strings had equal hashes."""


def verify(data: np.ndarray, p: np.ndarray, q: np.ndarray, length: np.ndarray, step: int = 1 << 22) -> None:
    """Check that ``data[p:p+length]`` and ``data[q:q+length]`` are the same bytes, some MB at a time."""
    cut = np.searchsorted(np.cumsum(length), np.arange(step, int(length.sum()) + step, step), side="left") + 1
    a = 0
    for b in np.unique(np.minimum(cut, len(p))):
        if b > a and not np.array_equal(data[ranges(p[a:b], length[a:b])], data[ranges(q[a:b], length[a:b])]):
            raise HashCollision
        a = b


class Suffixes:
    """Hash-compared suffixes of one byte array."""

    def __init__(self, data: np.ndarray, width: int, seed: int):
        self.data, self.width, self.poly = data, width, poly(seed)
        self.prefix = self.poly.prefix_bytes(data)
        self.whole = self.poly.windows(self.prefix, width)

    def part(self, p: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (self.prefix[p + n] - self.prefix[p]) * self.poly._down[p]

    def compare(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """-1, 0, 1 for suffix p before, equal to (on ``width`` bytes), after q."""
        out = np.zeros(len(p), dtype=np.int8)
        at = np.flatnonzero(self.whole[p] != self.whole[q])
        if len(at):
            p, q = p[at], q[at]
            low, high = np.zeros(len(p), dtype=np.int64), np.full(len(p), self.width - 1)
            while np.any(low < high):
                mid = (low + high + 1) >> 1
                same = self.part(p, mid) == self.part(q, mid)
                low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
            out[at] = np.where(self.data[p + low] < self.data[q + low], -1, 1)
        return out

    def merge_sort(self, group: np.ndarray, start: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sort suffixes within groups (``group`` rising); equal ones merge into that of least ``rank``.

        Returns the merged ones and, for each, the one it was merged into.
        Blocks double at each level; all blocks of all groups go through a level together.
        """
        lost, into = [], []
        item = np.arange(len(group))
        block = np.arange(len(group)) - np.searchsorted(group, group)      # of one suffix each
        while True:
            last = np.searchsorted(group[item], group[item], side="right") - 1
            open_ = block[last] > 0                                         # groups with more than one block
            item, block = item[open_], block[open_]
            if not len(item):
                break
            g = group[item]
            pair = block >> 1
            right = np.flatnonzero(block & 1)
            # the left sibling block: items of the same group and pair with an even block
            key = g.astype(np.int64) << 32 | block
            low = np.searchsorted(key, key[right] - 1)
            high = np.searchsorted(key, key[right] - 1, side="right")
            end, equal = high.copy(), np.full(len(right), -1)
            busy = np.flatnonzero(low < high)
            while len(busy):
                mid = (low[busy] + high[busy]) >> 1
                c = self.compare(start[item[mid]], start[item[right[busy]]])
                equal[busy[c == 0]] = mid[c == 0]
                low[busy] = np.where(c < 0, mid + 1, low[busy])
                high[busy] = np.where(c > 0, mid, high[busy])
                busy = busy[(c != 0) & (low[busy] < high[busy])]
            met = np.flatnonzero(equal >= 0)
            mine, other = item[right[met]], item[equal[met]]
            swap = rank[mine] < rank[other]
            lost.append(np.where(swap, other, mine))
            into.append(np.where(swap, mine, other))
            item = item.copy()
            item[equal[met[swap]]] = mine[swap]                             # the earlier takes the place of its equal
            gone = np.zeros(len(item), dtype=bool)
            gone[right[met]] = True
            place = np.arange(len(item)) * 2 + 1
            place[right] = low * 2
            order = np.argsort(place, kind="stable")
            order = order[~gone[order]]
            item, block = item[order], pair[order]
        if not lost:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(lost), np.concatenate(into)


def equal_strings(hashes: np.ndarray, lengths: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings equal (by hash and length) to one of less rank, and that one of least rank."""
    order = np.lexsort((rank, lengths, hashes))
    h, n = hashes[order], lengths[order]
    new = np.concatenate((np.ones(min(1, len(h)), dtype=bool), (h[1:] != h[:-1]) | (n[1:] != n[:-1])))
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))]
    return order[~new], first[~new]


def places(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Rank of (document, start)."""
    order = np.lexsort((start, doc))
    out = np.empty(len(doc), dtype=np.int64)
    out[order] = np.arange(len(doc))
    return out


#: Of a rank's upper half, all but the bit that says whether the part is frequent.
_MARK = np.uint32(0x7FFFFFFF)


def parts_in(data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Every part whose hash is in the lower half: of the many parts of a window the least is hardly ever another."""
    part = poly(21).windows(poly(21).prefix_bytes(data), MINIMISER_BYTES) & U64((1 << 63) - 1)
    return part[part < U64(1 << 62)]


def split(batches, width: int, n_buckets: int, order: PartOrder = PLAIN):
    """Map side: windows with one minimiser as packed strings, equal strings of a piece settled."""
    p = poly(21)
    for batch in batches:
        doc_ids, column = ids(batch.column(0)), batch.column(1)
        for first, last, data, offsets in chunks(column, PIECE):
            n = len(data) - width + 1
            if n <= 0:
                continue
            prefix = p.prefix_bytes(data)
            part = order.ranks(p.windows(prefix, MINIMISER_BYTES))
            least = sliding_min(part, width - MINIMISER_BYTES + 1)
            # a string can repeat inside itself only if its minimiser comes in anew while it lasts
            anew = np.zeros(n + 1, dtype=np.int64)
            np.cumsum((least[1:] == least[:-1]) & (part[width - MINIMISER_BYTES + 1:] == least[1:]), out=anew[2:])
            begin = np.ones(n, dtype=bool)
            begin[1:] = least[1:] != least[:-1]
            # windows that would cross a border are none: cut there
            inside = np.zeros(n + 1, dtype=np.int8)
            size = np.diff(offsets) - width + 1
            long = size > 0
            inside[offsets[:-1][long]] = 1
            stop = (offsets[:-1] + size)[long]
            inside[stop] -= 1
            valid = np.cumsum(inside[:-1]).astype(bool)
            begin[offsets[:-1][long]] = True
            begin &= valid
            a = np.flatnonzero(begin)
            if not len(a):
                continue
            nxt = np.append(a[1:], n)
            limit = np.repeat(stop, np.diff(np.append(np.searchsorted(a, offsets[:-1][long]), len(a))))
            windows = np.minimum(nxt, limit) - a
            lengths = windows + width - 1
            own = np.searchsorted(offsets, a, side="right") - 1
            doc, start = doc_ids[first:last][own], (a - offsets[own])
            mark, loops = least[a], anew[a + windows] > anew[a + 1]
            hashes = p.span(prefix, a, a + lengths)
            rows, keep = [], np.ones(len(a), dtype=bool)
            same, kept = equal_strings(hashes, lengths, places(doc, start))
            if len(same):
                earlier = (doc[kept] < doc[same]) | (start[kept] < start[same])
                same, kept = same[earlier], kept[earlier]
                verify(data, a[same], a[kept], lengths[same])
                keep[same] = False
                rows.append((int(doc[same[0]] % n_buckets) if len(same) else 0, pack(RANGES, doc[same], start[same], lengths[same], hashes[same].view(np.int64))))
            a, lengths, doc, start, mark, loops = a[keep], lengths[keep], doc[keep], start[keep], mark[keep], loops[keep]
            rows += packed_strings(bucket_of(mark, n_buckets), data, a, lengths, doc, start.astype(np.int32), (mark >> U64(32)).astype(np.uint32) & _MARK, loops)
            yield record(rows)


def settle(pdf: pd.DataFrame, width: int) -> pd.DataFrame:
    """Reduce side: one bucket."""
    found, texts, metas = [], [], []
    for blob in pdf["blob"]:
        kind, *x = unpack(blob)
        if kind == RANGES:
            found.append(x)
        else:
            texts.append(x[0])
            metas.append(x[1:])
    if metas:
        mark = np.concatenate([m[3] for m in metas])
        order = np.sort(mark)
        twice = order[1:][order[1:] == order[:-1]]
        # only strings whose minimiser occurs again
        at = np.searchsorted(twice, mark)
        again = twice[np.minimum(at, len(twice) - 1)] == mark if len(twice) else np.zeros(len(mark), dtype=bool)
        again |= np.concatenate([m[4] for m in metas])
        if np.any(again):
            parts, base = [], 0
            for text, m in zip(texts, metas):
                own = np.flatnonzero(again[base:base + len(m[0])])
                base += len(m[0])
                left = np.cumsum(m[0], dtype=np.int64) - m[0]
                parts.append((text[ranges(left[own], m[0][own].astype(np.int64))], *[v[own] for v in m]))
            del texts, metas
            data, lengths, doc, start, mark, loops = (np.concatenate(v) for v in zip(*parts))
            del parts
            left = np.cumsum(lengths, dtype=np.int64) - lengths
            order = np.argsort(mark, kind="stable")
            # minimisers do not meet each other: some MB of text at a time, each minimiser's strings together
            new = np.flatnonzero(np.concatenate(([True], mark[order][1:] != mark[order][:-1])))
            size = np.add.reduceat(lengths[order].astype(np.int64), new)
            cut = np.flatnonzero(np.diff(np.cumsum(size) // SLICE, prepend=0))
            for a, b in zip(np.concatenate(([0], new[cut])), np.concatenate((new[cut], [len(order)]))):
                own = order[a:b]
                if len(own):
                    found += _settled(data[ranges(left[own], lengths[own].astype(np.int64))], lengths[own].astype(np.int64), doc[own], start[own].astype(np.int64), mark[own], loops[own], width)
    return range_rows(found)


def _settled(*strings) -> list[tuple]:
    for seed in range(21, 25):
        try:
            return settle_strings(*strings, seed)
        except HashCollision:       # then with another base
            if seed == 24:
                raise


def settle_strings(data, lengths, doc, start, mark, loops, width: int, seed: int) -> list[tuple]:
    out = []
    answer = poly(21)                                       # ranges always carry this hash
    left = np.cumsum(lengths) - lengths
    suffixes = Suffixes(data, width, seed)
    own_hash = suffixes.poly.span(suffixes.prefix, left, left + lengths)
    reply = suffixes.prefix if seed == 21 else answer.prefix_bytes(data)
    rank = places(doc, start)
    same, kept = equal_strings(own_hash, lengths, rank)
    keep = np.ones(len(lengths), dtype=bool)
    if len(same):
        earlier = (doc[kept] < doc[same]) | (start[kept] < start[same])
        same, kept = same[earlier], kept[earlier]
        verify(data, left[same], left[kept], lengths[same])
        keep[same] = False
        out.append((doc[same], start[same], lengths[same], answer.span(reply, left[same], left[same] + lengths[same]).view(np.int64)))
    # suffixes of the strings left whose minimiser still occurs again, grouped by minimiser
    order = np.flatnonzero(keep)
    order = order[np.argsort(mark[order], kind="stable")]
    m = mark[order]
    twin = np.zeros(len(m), dtype=bool)
    twin[1:] = m[1:] == m[:-1]
    twin[:-1] |= twin[1:].copy()
    order = order[twin | loops[order]]
    if not len(order):
        return out
    windows = lengths[order] - width + 1
    at = ranges(left[order], windows)
    string = np.repeat(order, windows)
    group = np.repeat(np.unique(mark[order], return_inverse=True)[1].astype(np.int64), windows)
    # equal windows have their minimiser first at the same place, however often a string holds it
    parts = suffixes.poly.windows(suffixes.prefix, MINIMISER_BYTES) if seed == 21 else answer.windows(reply, MINIMISER_BYTES)
    hit = np.flatnonzero((parts >> U64(32)).astype(np.uint32) & _MARK == np.repeat(mark, lengths)[:len(parts)])
    key = group * width + hit[np.searchsorted(hit, at)] - at
    by = np.argsort(key, kind="stable")
    key = key[by]
    twin = np.zeros(len(key), dtype=bool)
    twin[1:] = key[1:] == key[:-1]
    twin[:-1] |= twin[1:].copy()
    by, key = by[twin], key[twin]
    if not len(by):
        return out
    group, at, string = np.cumsum(np.concatenate(([0], key[1:] != key[:-1]))), at[by], string[by]
    place = rank[string] * int(lengths.max() + 1) + (at - left[string])
    lost, into = suffixes.merge_sort(group, at, place)
    if not len(lost):
        return out
    sl, si = string[lost], string[into]
    earlier = (doc[si] < doc[sl]) | (start[si] + (at[into] - left[si]) < start[sl] + (at[lost] - left[sl]))
    p, q, s = at[lost][earlier], at[into][earlier], sl[earlier]
    order = np.argsort(p)
    p, q, s = p[order], q[order], s[order]
    new = np.concatenate((np.ones(min(1, len(p)), dtype=bool), (p[1:] != p[:-1] + 1) | (q[1:] != q[:-1] + 1) | (s[1:] != s[:-1])))
    a = np.flatnonzero(new)
    n = np.diff(np.append(a, len(p)))
    verify(data, p[a], q[a], n + width - 1)
    out.append((doc[s[a]], start[s[a]] + p[a] - left[s[a]], n + width - 1, answer.span(reply, p[a], p[a] + n + width - 1).view(np.int64)))
    return out


def covered(data: np.ndarray, found: tuple) -> np.ndarray:
    """Bytes to remove from one text."""
    first, n, h = found
    ok = (first >= 0) & (first + n <= len(data))
    first, n, h = first[ok], n[ok], h[ok]
    p = poly(21)
    ok = p.span(p.prefix_bytes(data), first, first + n).view(np.int64) == h
    step = np.zeros(len(data) + 1, dtype=np.int32)
    np.add.at(step, first[ok], 1)
    np.add.at(step, (first + n)[ok], -1)
    return np.cumsum(step)[:-1] > 0


def dedup(df: DataFrame, width: int = 100, id_col: str = "doc_id", text_col: str = "text", outputs: tuple = ("kept_bytes", "spans", "n_bytes", "n_removed", "n_spans", "kept_sha256")) -> DataFrame:
    """Add the chosen outputs: ``kept_bytes`` (binary), ``spans`` (removed runs as structs), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``."""
    if width <= MINIMISER_BYTES:
        raise ValueError(f"width must be over {MINIMISER_BYTES}")
    texts = document_batches(df).select(F.col(f"`{text_col}`").alias("text"))
    order, n_buckets = plan(texts, lambda data, offsets: parts_in(data, offsets, width), PIECE)
    shared = df.sparkSession.sparkContext.broadcast(order)
    sent = df.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).mapInArrow(lambda it: split(it, width, n_buckets, shared.value), "bucket long, blob binary")
    found = sent.groupBy("bucket").applyInPandas(lambda pdf: settle(pdf, width), RANGE_SCHEMA)
    rest = [c for c in df.columns if c not in outputs]
    joined = with_ranges(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*rest, id_col, text_col])]), found, id_col)

    def finish(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            marks = batch.column(batch.schema.get_field_index("__ranges"))
            out: dict[str, list] = {k: [] for k in outputs}
            for row in range(batch.num_rows):
                raw = (texts[row].as_py() or "").encode("utf-8")
                found = range_arrays(marks, row)
                kept, spans = raw, (np.zeros(0, np.int64), np.zeros(0, np.int64))
                if found:
                    data = np.frombuffer(raw, dtype=np.uint8)
                    gone = covered(data, found)
                    kept, spans = data[~gone].tobytes(), runs(gone)
                values = {"kept_bytes": kept, "spans": [{"first": int(a), "n": int(b - a)} for a, b in zip(*spans)] if "spans" in out else None, "n_bytes": len(raw), "n_removed": len(raw) - len(kept), "n_spans": len(spans[0])}
                for k in out:
                    out[k].append(hashlib.sha256(kept).hexdigest() if k == "kept_sha256" else values[k])
            kinds = {"kept_bytes": pa.binary(), "spans": pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32())])), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()}
            cols = {c: batch.column(batch.schema.get_field_index(c)) for c in rest}
            yield pa.RecordBatch.from_pydict(cols | {k: pa.array(v, kinds[k]) for k, v in out.items()})

    kinds = {"kept_bytes": "binary", "spans": "array<struct<first:int,n:int>>", "n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string"}
    schema = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest] + [f"{k} {kinds[k]}" for k in outputs]
    return joined.mapInArrow(finish, ", ".join(schema))
