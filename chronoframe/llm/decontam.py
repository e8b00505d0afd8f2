"""Operator 9: benchmark decontamination. Rare n-gram seeds bring passages and test items together, Smith-Waterman alignment scores them.

1. *Seeds.* Word n-grams (``SEED_WORDS`` words; lower-cased, punctuation at
   word ends off) of the items are counted over all documents in one pass; a
   task sends one row per n-gram that it met. An item's seeds are its
   n-grams that at most ``RARE`` times as many documents have as its median
   n-gram, and the rarest of every ``STRETCH`` words in a row: frequent phrases
   bring few candidates, and whatever quotes ``STRETCH`` words has a seed,
   however many documents quote them.
2. *Candidates.* A document's seed hits with one item, close together, give a
   passage: the hits' span, widened by what the item still lacks on both sides.
   Hits of a document are found where the document is read; only passages move.
3. *Alignment.* Passage and item are aligned word by word (local alignment:
   match ``MATCH``, mismatch and gap costs), so substituted, dropped and added
   words cost a little instead of breaking the match. The score is the
   alignment's share of the item's best possible one. A document matches from
   a share of ``MIN_SHARE`` on, or by a quote: ``QUOTE`` words of the item in a
   row, or an alignment that scores as much as they do and has the least share
   of what the part that it covers could score.

The items are broadcast if there are at most ``MAX_BROADCAST`` of their
n-grams; a larger benchmark is taken in blocks of that many, each with a pass
over the documents.

Cases: null text has no words; items without words, or null items, match
nothing; items shorter than a seed use their whole sequence; rows with null
id are judged, their id stays null; repeated rows come out each; an empty
benchmark gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoframe.llm.arrays import LOWER, U64, chunks, poly, sliding_min, word_hashes, word_spans
from chronoframe.llm.storage import document_batches

SEED_WORDS, RARE = 3, 8
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SHARE = 0.5
#: Words in a row that are a quote, however long the item is; as many matches' score, dense enough, are one too.
QUOTE = 13
#: Of so many words of an item in a row the rarest n-gram is always a seed.
STRETCH = 7
MAX_BROADCAST = 2_000_000
PIECE = (1 << 20) - 1
HIT_SCHEMA = "doc_id long, item_id long, share double, first int, last int, matched int"

_EDGE = np.zeros(256, dtype=bool)
_EDGE[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, bounds)`` of the words, lower-cased (A-Z and Latin-1) and without ASCII punctuation at their ends (words of punctuation only: as they are)."""
    data = LOWER[data]
    accented = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    data[accented] += 32                                      # capitals of Latin-1
    starts, ends, bounds = word_spans(data, offsets)
    a, b = starts.copy(), ends.copy()
    for _ in range(3):
        a += (b - a > 1) & _EDGE[data[a]] if len(a) else 0
        b -= (b - a > 1) & _EDGE[data[b - 1]] if len(b) else 0
    return word_hashes(data, a, b, 41), bounds


def seed_hashes(words: np.ndarray) -> np.ndarray:
    p = poly(42)
    return p.windows(p.prefix(words), SEED_WORDS)


#: Bits of a packed cell for the first word and for the matched words; the score stands above them.
_WORD_BITS = 21
_ONE = 1 << 2 * _WORD_BITS


def alignment(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment: (score, first, last word of the passage in it, matched words).

    Two rows of the table are held, whatever the lengths: each cell packs its
    score with where its alignment began and how many words it matched.
    """
    n, m = len(item), len(passage)
    if max(n, m) >= 1 << _WORD_BITS:
        raise ValueError(f"a passage or item has over {(1 << _WORD_BITS) - 1} words")
    place = np.arange(m + 1, dtype=np.int64)
    fresh = place << _WORD_BITS
    steps = place * (GAP * _ONE)
    above, best, last = fresh.copy(), 0, 0
    for word in item:
        row = np.maximum(above + GAP * _ONE, fresh)
        diagonal = above[:-1] + np.where(passage == word, MATCH * _ONE + 1, MISMATCH * _ONE)
        np.maximum(row[1:], diagonal, out=row[1:])
        # gaps along the row: running maximum of (value - cost up to there)
        above = np.maximum.accumulate(row - steps) + steps
        j = int(above.argmax())
        if above[j] >> 2 * _WORD_BITS > best >> 2 * _WORD_BITS:
            best, last = int(above[j]), j
    score = best >> 2 * _WORD_BITS
    return score, (best >> _WORD_BITS & (1 << _WORD_BITS) - 1) if score else last, last, best & (1 << _WORD_BITS) - 1 if score else 0


def quoted(item: np.ndarray, passage: np.ndarray) -> bool:
    """``QUOTE`` words of the item in a row in the passage, whatever the best alignment is."""
    if min(len(item), len(passage)) < QUOTE:
        return False
    p = poly(42)
    return bool(np.isin(p.windows(p.prefix(item), QUOTE), p.windows(p.prefix(passage), QUOTE)).any())


class Items:
    """Benchmark items as word hashes, and the seeds that lead to them."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.words: dict[int, np.ndarray] = {}
        self.ids = [item for item, _ in rows]                 # items are numbered here: an id may come more than once
        for item, (_, text) in enumerate(rows):
            raw = np.frombuffer((text or "").encode("utf-8"), dtype=np.uint8)
            w, _ = words_of(raw, np.array([0, len(raw)]))
            if len(w):
                self.words[item] = w
        self.seeds, self.owner, self.place = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._index({i: np.arange(max(1, len(w) - SEED_WORDS + 1)) for i, w in self.words.items()})

    def _grams(self, item: int) -> np.ndarray:
        w = self.words[item]
        return seed_hashes(w) if len(w) >= SEED_WORDS else poly(42).span(poly(42).prefix(w), np.array([0]), np.array([len(w)]))

    def _index(self, chosen: dict[int, np.ndarray]) -> None:
        if not chosen:
            return
        h = np.concatenate([self._grams(i)[k] for i, k in chosen.items()])
        owner = np.concatenate([np.full(len(k), i, dtype=np.int64) for i, k in chosen.items()])
        place = np.concatenate(list(chosen.values()))
        order = np.argsort(h, kind="stable")
        self.seeds, self.owner, self.place = h[order], owner[order], place[order]
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.seeds >> U64(44)).astype(np.int64)] = True
        self.short = {len(w) for w in self.words.values() if len(w) < SEED_WORDS}

    def keep_rare(self, documents: dict[int, int]) -> None:
        """Seeds that few documents have, by the item's own median, and the rarest of every stretch."""
        chosen = {}
        for i in self.words:
            n = np.array([documents.get(int(h), 0) for h in self._grams(i).view(np.int64)])
            keep = n <= max(2, RARE * np.median(n))
            # the least (count, place) of each run of n-grams that a stretch has
            key = n.astype(np.int64) << 32 | np.arange(len(n))
            keep[sliding_min(key, min(STRETCH - SEED_WORDS + 1, len(n))) & 0xFFFFFFFF] = True
            chosen[i] = np.flatnonzero(keep)
        self._index(chosen)

    def hits(self, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of seeds in a run of documents, and their hashes; n-grams do not cross documents."""
        p = poly(42)
        prefix = p.prefix(words)
        found_at, found = [], []
        for width in {SEED_WORDS, *self.short}:
            h = p.windows(prefix, width)
            at = np.flatnonzero(self.maybe[(h >> U64(44)).astype(np.int64)])
            k = np.searchsorted(self.seeds, h[at])
            at = at[self.seeds[np.minimum(k, len(self.seeds) - 1)] == h[at]]
            doc = np.searchsorted(bounds, at, side="right") - 1
            inside = at + width <= bounds[doc + 1]
            if width < SEED_WORDS:                                       # an item of a word or two only as a whole text
                inside &= bounds[doc + 1] - bounds[doc] == width
            found_at.append(at[inside])
            found.append(h[at[inside]])
        return np.concatenate(found_at), np.concatenate(found)


def _count(batches, items: Items):
    """Documents that have each seed."""
    total: dict[int, int] = defaultdict(int)
    for batch in batches:
        for _, _, data, offsets in chunks(batch.column(0), PIECE):
            words, bounds = words_of(data, offsets)
            at, h = items.hits(words, bounds)
            if len(at):
                doc = np.searchsorted(bounds, at, side="right") - 1
                order = np.lexsort((h, doc))
                new = np.ones(len(order), dtype=bool)
                new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
                for x in h[order][new].view(np.int64).tolist():
                    total[x] += 1
    yield pa.RecordBatch.from_pydict({"h": pa.array(list(total), pa.int64()), "n": pa.array(list(total.values()), pa.int64())})


def passages(items: Items, at: np.ndarray, h: np.ndarray, size: int):
    """``(item, first, last)`` word spans of a document to align, from its seed hits."""
    low = np.searchsorted(items.seeds, h)
    high = np.searchsorted(items.seeds, h, side="right")
    starts: dict[int, list[int]] = defaultdict(list)
    for a, x, y in zip(at.tolist(), low.tolist(), high.tolist()):
        for k in range(x, y):
            starts[int(items.owner[k])].append(a - int(items.place[k]))       # where the item would begin
    for item, begins in starts.items():
        n = len(items.words[item])
        slack = n // 2 + SEED_WORDS
        begins.sort()
        a = b = begins[0]
        for x in begins[1:] + [None]:
            if x is not None and x - b <= slack:
                b = x
                continue
            yield item, max(0, a - slack), min(size, b + n + slack)
            a = b = x


def _matches(batch, items: Items, least: float, id_at: int, text_at: int):
    """``(row, item id, share, first, last, matched)`` of a batch's contaminated rows, each item's best passage."""
    for first, _, data, offsets in chunks(batch.column(text_at), PIECE):
        words, bounds = words_of(data, offsets)
        at, h = items.hits(words, bounds)
        doc = np.searchsorted(bounds, at, side="right") - 1
        for d in np.unique(doc):
            own = doc == d
            base, size = int(bounds[d]), int(bounds[d + 1] - bounds[d])
            best: dict[int, tuple] = {}
            for item, a, b in passages(items, at[own] - base, h[own], size):
                w = items.words[item]
                score, x, y, matched = alignment(w, words[base + a:base + b])
                share, key = score / (MATCH * len(w)), items.ids[item]
                dense = score >= MATCH * QUOTE and score >= least * MATCH * (y - x)
                if (share >= least or dense or quoted(w, words[base + a:base + b])) and (key not in best or share > best[key][0]):
                    best[key] = (share, a + x, a + y, matched)
            for key, v in sorted(best.items()):
                yield first + int(d), key, *v


def _align(batches, items: Items, least: float):
    kinds = (("doc_id", pa.int64()), ("item_id", pa.int64()), ("share", pa.float64()), ("first", pa.int32()), ("last", pa.int32()), ("matched", pa.int32()))
    for batch in batches:
        doc_ids = batch.column(0).to_pylist()
        rows = [(doc_ids[r], *v) for r, *v in _matches(batch, items, least, 0, 1)]
        yield pa.RecordBatch.from_pydict({k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate(kinds)})


def _clean(batches, items: Items, least: float, text_col: str):
    for batch in batches:
        keep = np.ones(batch.num_rows, dtype=bool)
        keep[[m[0] for m in _matches(batch, items, least, 0, batch.schema.get_field_index(text_col))]] = False
        yield batch.filter(pa.array(keep))


def _seeded(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text: str):
    """Broadcast items with their seeds, block by block."""
    for block in _blocks(benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).alias("text")).where("item is not null and text is not null")):
        items = Items(block)
        if not items.words:
            continue
        share = document_batches(docs).sparkSession.sparkContext.broadcast
        first = share(items)
        counts = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(lambda it, b=first: _count(it, b.value), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
        items.keep_rare({r["h"]: r["n"] for r in counts.collect()})            # at most one row for each n-gram of the block
        yield share(items)


def contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", least: float = MIN_SHARE) -> DataFrame:
    """One row per document and item whose alignment reaches ``least`` or that the document quotes: id, item, share, word span, matched words."""
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    out = None
    for seeds in _seeded(docs, benchmark, "text", item_col, item_text):
        part = docs.mapInArrow(lambda it, b=seeds: _align(it, b.value, least), HIT_SCHEMA)
        out = part if out is None else out.unionByName(part)
    return df.sparkSession.createDataFrame([], HIT_SCHEMA) if out is None else out


def decontaminate(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", least: float = MIN_SHARE) -> DataFrame:
    """``df`` without its contaminated rows, judged where they are read: no shuffle, no join."""
    out = df
    for seeds in _seeded(df, benchmark, text_col, item_col, item_text):
        out = out.mapInArrow(lambda it, b=seeds: _clean(it, b.value, least, text_col), df.schema)
    return out


def _blocks(benchmark: DataFrame):
    """The items in blocks of at most ``MAX_BROADCAST`` words, each fetched alone."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // 2
    n = size // MAX_BROADCAST + 1
    for k in range(n):
        part = benchmark if n == 1 else benchmark.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k)
        yield [(r["item"], r["text"]) for r in part.orderBy("item").collect()]
