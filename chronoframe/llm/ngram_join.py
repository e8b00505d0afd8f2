"""Operator 3: n-gram Jaccard join by a grouped prefix join.

A document's set is its distinct word n-grams (A-Z lower-cased). Two documents
link when ``100 * intersection >= percent * union``.

1. *Order.* Frequent n-grams go last: each task counts its own rows' n-grams
   exactly and reports those met ``LOCAL_MIN`` times in a block; the sums make
   one global order (any fixed order is right, this one keeps prefixes rare).
   At most ``HOT_NGRAMS`` of them are broadcast.
2. *Prefixes.* Linked sets share one of their first ``n - ceil(percent*n/100)
   + 1`` n-grams. Documents with equal size and prefix form one group, members
   with equal sets one class; only groups are indexed.
3. *Group pairs.* n-grams that several groups have in their prefixes give
   candidates, filtered by size and position. First every class meets one
   leader (the group with the fewest rarer n-grams before the shared one: in a
   family of copies the original). Classes of one component need not meet
   again, so a family of thousands of near copies takes as many checks, not its
   square. Further rounds draw other leaders until nothing merges or few pairs
   are left (:func:`_linked_homes`); then all of those meet.
4. *Verification* expands groups to classes, rules pairs out by counts of their
   n-grams in parts of the hash range (an upper bound of the intersection), and
   compares the whole sets of the rest, in turns that bound what is shuffled at
   once.

What is stored of every document is five numbers; prefixes, bitmaps and counts
are made again from the texts where and for the documents that need them.

Result: per document its set size and component (least id reachable by links).

Cases: null text, or text without words, has an empty set and links with
nothing (its component is itself); fewer words than ``n`` give one n-gram, the
whole sequence; rows with null id are counted but not linked (component null);
rows that share an id are one document for linking; repeated rows come out
each; empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronoframe.llm.arrays import LOWER, U64, chunks, mix, poly, word_hashes, word_spans
from chronoframe.llm.bitmaps import having, marked
from chronoframe.llm.components import connected_components
from chronoframe.llm.memories import release
from chronoframe.llm.storage import checkpointed, document_batches

LOCAL_MIN, BLOCK, HOT_NGRAMS, HOT_MIN = 3, 2_000_000, 200_000, 16
#: Parts of the hash range in which a set's n-grams are counted: two sets share no more than the sum of the smaller counts.
BIN_BITS = 8
BINS = 1 << BIN_BITS
PIECE = (1 << 20) - 1
#: Bits of the bitmap of a set's n-grams that pairs of a key with at least ``MANY`` classes are compared by while they are joined.
MARK_BITS, MANY = 2048, 8
#: Pairs are compared in turns that carry at most one part in so many of all documents' n-grams.
TURN_SHARE = 4
#: Pairs left per row of the index at which leaders give way to all pairs.
PAIRS_PER_ROW = 8


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, bounds)``: each document's distinct n-gram hashes, rising."""
    data = LOWER[data]
    starts, ends, bounds = word_spans(data, offsets)
    words = word_hashes(data, starts, ends, 31)
    p = poly(32)
    prefix = p.prefix(words)
    size = np.diff(bounds)
    count = np.where(size >= n, size - n + 1, np.minimum(size, 1))
    out_bounds = np.concatenate(([0], np.cumsum(count)))
    first = np.arange(out_bounds[-1]) - np.repeat(out_bounds[:-1] - bounds[:-1], count)
    hashes = p.span(prefix, first, first + np.repeat(np.minimum(size, n), count))
    for a, b in zip(out_bounds[:-1], out_bounds[1:]):
        if b - a > 1:
            hashes[a:b].sort()
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[out_bounds[:-1][count > 0]] = True
    return hashes[new], np.concatenate(([0], np.cumsum(new)))[out_bounds]


def _frequent(batches, n: int):
    """Map side of the order: n-grams met ``LOCAL_MIN`` times in a block of rows."""
    def flush(parts):
        h = np.concatenate(parts)
        parts.clear()
        h.sort()
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        count = np.diff(np.append(first, len(h)))
        often = count >= LOCAL_MIN
        return pa.RecordBatch.from_pydict({"h": pa.array(h[first[often]].view(np.int64)), "c": pa.array(count[often].astype(np.int64))})

    release()
    parts, size = [], 0
    for batch in batches:
        for _, _, data, offsets in chunks(batch.column(0), PIECE):
            h, _ = shingle_sets(data, offsets, n)
            if len(h):
                parts.append(h)
                size += len(h)
            if size >= BLOCK:
                yield flush(parts)
                parts, size = [], 0
    if parts:
        yield flush(parts)


class Order:
    """Global order of n-grams: those not frequent by hash, then the frequent ones by (count, hash)."""

    def __init__(self, h: np.ndarray, count: np.ndarray):
        order = np.argsort(h)
        self.h, self.count = h[order], count[order]
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.h >> U64(44)).astype(np.int64)] = True

    def count_of(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), dtype=np.int64)
        at = np.flatnonzero(self.maybe[(h >> U64(44)).astype(np.int64)])
        if len(at) and len(self.h):
            k = np.minimum(np.searchsorted(self.h, h[at]), len(self.h) - 1)
            out[at] = np.where(self.h[k] == h[at], self.count[k], 0)
        return out


def _signatures(batches, n: int, percent: int, order: Order):
    """Per row: id, set size, two set hashes, prefix hash and the prefix in the global order."""
    for batch in batches:
        id_col, column = batch.column(0), batch.column(1)
        for first, last, data, offsets in chunks(column, PIECE):
            h, bounds = shingle_sets(data, offsets, n)
            frequent = order.count_of(h)
            total = np.concatenate(([0], np.cumsum(frequent > 0)))
            size = np.diff(bounds)
            keep = np.where(size > 0, size + (-percent * size // 100) + 1, 0)
            prefixes = []
            for d in np.flatnonzero(size):
                a, b = bounds[d], bounds[d + 1]
                own = h[a:b]
                if total[a] != total[b]:
                    f = frequent[a:b]
                    cold = f == 0
                    if cold.sum() >= keep[d]:
                        own = own[cold]
                    else:
                        hot = np.flatnonzero(~cold)
                        own = np.concatenate((own[cold], own[hot[np.lexsort((own[hot], f[hot]))]]))
                prefixes.append(own[:keep[d]])
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, U64)
            at = np.concatenate(([0], np.cumsum(keep)))
            sums = [np.concatenate((np.zeros(1, U64), np.cumsum(mix(h ^ U64(salt)))))[bounds] for salt in (0x5BD1E995, 0x9E3779B1)]
            p = poly(33)
            pk = p.span(p.prefix(flat), at[:-1], at[1:])
            yield pa.RecordBatch.from_pydict({
                "doc_id": id_col[first:last].cast(pa.int64()), "n": pa.array(size.astype(np.int32)),
                **{k: pa.array((s[1:] - s[:-1]).view(np.int64)) for k, s in zip(("h1", "h2"), sums)},
                "pk": pa.array(pk.view(np.int64)),
                "prefix": pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat.view(np.int64))),
            })


def _profiles(batches, n: int):
    """Per row: id, bitmap of its n-grams, n-grams beyond the bitmap's bits, and their counts by parts of the hash range."""
    for batch in batches:
        cid, column = batch.column(0), batch.column(1)
        for first, last, data, offsets in chunks(column, PIECE):
            h, bounds = shingle_sets(data, offsets, n)
            size = np.diff(bounds)
            row = np.repeat(np.arange(len(size)), size)
            bins = np.bincount(row * BINS + (h >> U64(64 - BIN_BITS)).astype(np.int64), minlength=len(size) * BINS).reshape(-1, BINS)
            marks = np.zeros((len(size), MARK_BITS), dtype=bool)
            marks[row, (h >> U64(64 - MARK_BITS.bit_length() + 1)).astype(np.int64)] = True
            words = np.packbits(marks, axis=1).view(np.int64)
            yield pa.RecordBatch.from_pydict({
                "cid": cid[first:last],
                "marks": pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * words.shape[1]), pa.array(words.reshape(-1))),
                "more": pa.array((size - marks.sum(1)).astype(np.int32)),
                "bins": pa.array([b.astype(np.uint8 if b.max() < 256 else np.uint32).tobytes() for b in bins], pa.binary()),
            })


def _sets(batches, n: int):
    for batch in batches:
        cid, column = batch.column(0), batch.column(1)
        for first, last, data, offsets in chunks(column, PIECE):
            h, bounds = shingle_sets(data, offsets, n)
            yield pa.RecordBatch.from_pydict({"cid": cid[first:last], "grams": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(h.view(np.int64)))})


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.uint8 if len(raw) == BINS else np.uint32).astype(np.int64)


def _prune(batches, percent: int):
    """Keep the pairs whose counts by parts of the hash range leave enough room."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = _unpacked(x), _unpacked(y)
            most = int(np.minimum(x, y).sum())
            keep.append(100 * most >= percent * (int(x.sum()) + int(y.sum()) - most))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_pydict({"a": batch.column(0).filter(keep), "b": batch.column(1).filter(keep)})


def _check(batches, percent: int):
    """Keep the pairs whose sets are similar enough."""
    for batch in batches:
        a, b = batch.column(2), batch.column(3)
        av, bv = (x.flatten().to_numpy(zero_copy_only=False).view(U64) for x in (a, b))
        ao, bo = (np.concatenate(([0], np.cumsum(x.value_lengths().to_numpy(zero_copy_only=False)))) for x in (a, b))
        keep = np.zeros(batch.num_rows, dtype=bool)
        for r in range(batch.num_rows):
            x, y = av[ao[r]:ao[r + 1]], bv[bo[r]:bo[r + 1]]
            both = np.concatenate((x, y))
            both.sort()
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            keep[r] = 100 * common >= percent * (len(x) + len(y) - common)
        yield pa.RecordBatch.from_pydict({"a": batch.column(0).filter(pa.array(keep)), "b": batch.column(1).filter(pa.array(keep))})


def _possible(n1, p1, n2, p2, percent: int):
    """Size and position filter for a shared n-gram at 0-based positions p1, p2 (exact at a pair's first shared one)."""
    need = F.ceil((F.lit(percent) * (n1 + n2)) / F.lit(100 + percent))
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & (1 + F.least(n1 - 1 - p1, n2 - 1 - p2) >= need)


def _enough_marks(percent: int):
    """Upper bound of the intersection from two bitmaps: bits that both have, and n-grams of the smaller surplus that share a bit with another."""
    both = sum((F.bit_count(F.get("marks", F.lit(k)).bitwiseAND(F.get("marks2", F.lit(k)))) for k in range(MARK_BITS // 64)), F.lit(0))
    return both + F.least("more", "more2") >= F.ceil((F.lit(percent) * (F.col("n") + F.col("n2"))) / F.lit(100 + percent))


def link_documents(df: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(signatures, links)``: per row ``doc_id, n, cid`` (least id with the same set), and enough links between classes for the components."""
    spark = document_batches(df).sparkSession
    text = F.col(f"`{text_col}`")
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    often = docs.select("text").mapInArrow(lambda it: _frequent(it, n), "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= HOT_MIN)
    rows = often.orderBy(F.desc("c"), "h").limit(HOT_NGRAMS).toPandas()
    order = spark.sparkContext.broadcast(Order(rows["h"].to_numpy(dtype=np.int64).view(U64), rows["c"].to_numpy(dtype=np.int64)))

    def signed(rows: DataFrame) -> DataFrame:
        return rows.mapInArrow(lambda it: _signatures(it, n, percent, order.value), "doc_id long, n int, h1 long, h2 long, pk long, prefix array<long>")

    # prefixes are as large as the texts: they are made again for the index, not stored
    sig = checkpointed(signed(docs).drop("prefix"))
    linked = sig.where("n > 0 and doc_id is not null")
    key = ["n", "pk", "h1", "h2"]
    classes = linked.groupBy(*key).agg(F.min("doc_id").alias("cid"))
    groups = linked.groupBy("n", "pk").agg(F.min("doc_id").alias("gid"), F.count("*").alias("k"))
    index = _prefixes(docs, signed, linked, groups).select("gid", "n", F.posexplode("prefix").alias("pos", "gram"))
    by_gram = W.partitionBy("gram").orderBy("pos", "n", "gid")
    lead = F.first(F.struct("gid", "n", "pos")).over(by_gram)
    met = index.select("gram", "pos", "n", "gid", lead.alias("lead"), F.lag("gid").over(by_gram).alias("before"), F.lead("gid").over(by_gram).alias("after"))
    met = met.where("before is not null or after is not null")
    leads = (F.col("lead.gid") != F.col("gid")) & _possible(F.col("n"), F.col("pos"), F.col("lead.n"), F.col("lead.pos"), percent)
    met = checkpointed(met.select("gram", "pos", "n", "gid", F.when(leads, F.col("lead.gid")).alias("lead")))

    # one leader for each group, and its own first class for each further class of a group
    best = met.where("lead is not null").groupBy("gid", "lead").agg(F.count("*").alias("k")).groupBy("gid").agg(F.max(F.struct("k", F.negative("lead").alias("m"))).alias("x")).select("gid", F.negative("x.m").alias("lead"))
    members = checkpointed(classes.join(groups.select("n", "pk", "gid"), ["n", "pk"]).select("cid", "gid"))
    first = checkpointed(members.join(best, "gid", "left").select("cid", F.when(F.col("cid") != F.col("gid"), F.col("gid")).otherwise(F.col("lead")).alias("b")).where("b is not null").select(F.col("cid").alias("a"), "b"))
    star = checkpointed(_verified(docs, sig, first, n, percent))

    # n-grams that several groups have, and groups of several classes, as keys under which pairs meet
    several = members.groupBy("gid").agg(F.count("*").alias("k")).where("k > 1")
    own = groups.join(several, "gid").select(F.lit(1).alias("kind"), F.col("gid").alias("key"), F.lit(0).alias("pos"), "n", "gid")
    keys = met.select(F.lit(0).alias("kind"), F.col("gram").alias("key"), "pos", "n", "gid").unionByName(checkpointed(own))
    links = _linked_homes(docs, sig, keys, members, first, star, n, percent)
    signatures = sig.select("doc_id", *key).join(classes, key, "left").select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("cid")).alias("cid"))
    return signatures, links


def _prefixes(docs: DataFrame, signed, linked: DataFrame, groups: DataFrame) -> DataFrame:
    """``(gid, n, prefix)`` of each group. Only documents that may share theirs are shuffled with their prefixes, the others are groups by themselves."""
    shared = checkpointed(marked(linked, "pk", groups.where("k > 1"), "pk").where("__maybe").select(F.col("doc_id").alias("id")).distinct())
    rows = marked(docs.where("doc_id is not null"), "doc_id", shared, "id")
    alone = signed(rows.where("not __maybe").select("doc_id", "text")).where("n > 0").select(F.col("doc_id").alias("gid"), "n", "prefix")
    several = signed(rows.where("__maybe").select("doc_id", "text")).where("n > 0").groupBy("n", "pk").agg(F.min("doc_id").alias("gid"), F.first("prefix").alias("prefix"))
    return alone.unionByName(several.select("gid", "n", "prefix"))


def _linked_homes(docs: DataFrame, sig: DataFrame, keys: DataFrame, members: DataFrame, tried: DataFrame, links: DataFrame, n: int, percent: int) -> DataFrame:
    """All links that join components (``homes``), from the star of first leaders on.

    Of keys that the same classes have (a shared passage gives many) only the
    first in the global order stays: a pair that shares any of them shares that
    one, at the least positions. While the pairs left outnumber the rows they
    come from, one class of every key, of a home drawn by a hash of the round,
    leads: each class of another home meets the leader that most of its keys
    name, is verified, and homes merge. When a round does not halve the pairs, or few
    are left, all pairs of different homes meet. Pairs that were verified before
    are not taken again.
    """
    tried = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # a class has one leader, which may have one too: the leader's leader is its home
    lead_of = links.groupBy(F.col("a").alias("cid")).agg(F.min("b").alias("home"))
    home = members.join(lead_of, "cid", "left").join(lead_of.select(F.col("cid").alias("home"), F.col("home").alias("far")), "home", "left")
    home = home.select("cid", "gid", F.coalesce("far", "home", "cid").alias("home"))
    before, turn = None, 0
    while True:
        home = checkpointed(home)
        wide = keys.join(home, "gid").select("kind", "key", "pos", "n", "cid", "home")
        open_ = wide.groupBy("kind", "key").agg(F.min("home").alias("x"), F.max("home").alias("y")).where("x < y").select("kind", "key")
        wide = checkpointed(wide.join(open_, ["kind", "key"], "left_semi"))
        held = wide.groupBy("kind", "key").agg(*[F.bit_xor(F.xxhash64("cid", F.lit(k))).alias(f"x{k}") for k in (1, 2)], F.count("*").alias("c"), F.min("pos").alias("p"))
        one = held.groupBy("x1", "x2", "c").agg(F.min(F.struct("p", "kind", "key")).alias("m")).select("m.kind", "m.key")
        wide = checkpointed(wide.join(one, ["kind", "key"], "left_semi"))
        band = F.floor(F.log("n") / float(np.log(100 / percent))) if percent < 100 else F.col("n")
        load = wide.groupBy("kind", "key", band.alias("band"), "home").agg(F.count("*").alias("k")).groupBy("kind", "key", "band").agg(F.sum("k").alias("s"), F.sum(F.col("k") * F.col("k")).alias("q"))
        rows, pairs = load.agg(F.sum("s"), F.sum((F.col("s") * F.col("s") - F.col("q")) / 2)).first()
        if not rows or pairs <= rows * PAIRS_PER_ROW or before is not None and 2 * pairs > before:
            break
        before = pairs
        lead = wide.groupBy("kind", "key").agg(F.min(F.struct(F.xxhash64("home", F.lit(turn)).alias("draw"), "pos", "n", "cid", "home")).alias("lead"))
        meet = wide.join(lead, ["kind", "key"]).where((F.col("home") != F.col("lead.home")) & _possible(F.col("n"), F.col("pos"), F.col("lead.n"), F.col("lead.pos"), percent))
        meet = meet.groupBy("cid", F.col("lead.cid").alias("b")).agg(F.count("*").alias("k"))
        meet = meet.withColumn("x", F.least("cid", "b")).withColumn("y", F.greatest("cid", "b")).join(tried.withColumnsRenamed({"a": "x", "b": "y"}), ["x", "y"], "left_anti")
        chosen = checkpointed(meet.groupBy("cid").agg(F.max(F.struct("k", F.negative("b").alias("m"))).alias("m")).select(F.col("cid").alias("a"), F.negative("m.m").alias("b")))
        found = checkpointed(_verified(docs, sig, chosen, n, percent))
        tried = checkpointed(tried.unionByName(chosen.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))))
        links = checkpointed(links.unionByName(found))
        # each home joins the linked home of the least draw, if that is less than its own; twice along the chain
        side = home.select("cid", F.col("home").alias("h"))
        ends = found.join(side, F.col("a") == F.col("cid")).select("b", F.col("h").alias("x")).join(side, F.col("b") == F.col("cid")).select("x", F.col("h").alias("y")).where("x <> y")
        both = ends.unionByName(ends.select(F.col("y").alias("x"), F.col("x").alias("y")))
        draw = lambda c: F.xxhash64(c, F.lit(turn))  # noqa: B023, E731
        step = checkpointed(both.where(draw("y") < draw("x")).groupBy("x").agg(F.min(F.struct(draw("y").alias("d"), "y")).alias("m")).select("x", F.col("m.y").alias("y")))
        far = step.join(step.select(F.col("x").alias("y"), F.col("y").alias("z")), "y", "left").select("x", F.coalesce("z", "y").alias("to"))
        home = home.join(far, F.col("home") == F.col("x"), "left").select("cid", "gid", F.coalesce("to", "home").alias("home"))
        turn += 1
    if not rows:
        return links
    many = wide.groupBy("kind", "key").agg(F.count("*").alias("c")).where(F.col("c") >= MANY).select("kind", "key")
    dense = wide.join(many, ["kind", "key"], "left_semi")
    marks = _profiled(docs, checkpointed(dense.select("cid").distinct()), n).groupBy("cid").agg(F.first("marks").alias("marks"), F.first("more").alias("more"))
    wide = wide.join(many, ["kind", "key"], "left_anti").withColumns({"marks": F.lit(None).cast("array<long>"), "more": F.lit(None).cast("int")}).unionByName(dense.join(marks, "cid", "left"))
    wide = checkpointed(wide)
    right = wide.select("kind", "key", *[F.col(c).alias(f"{c}2") for c in ("pos", "n", "cid", "home", "marks", "more")])
    left = wide.join(right, ["kind", "key"]).where((F.col("cid") < F.col("cid2")) & (F.col("home") != F.col("home2")) & _possible(F.col("n"), F.col("pos"), F.col("n2"), F.col("pos2"), percent)
                                                   & F.coalesce(_enough_marks(percent), F.lit(True)))
    rest = checkpointed(left.select(F.col("cid").alias("a"), F.col("cid2").alias("b")).distinct().join(tried, ["a", "b"], "left_anti"))
    return checkpointed(links.unionByName(_verified(docs, sig, rest, n, percent)))


def _joined(pairs: DataFrame, rows: DataFrame, key: str, value: str) -> DataFrame:
    """``(a, b, value of a, value of b)``."""
    left = rows.select(F.col(key).alias("a"), F.col(value).alias("va"))
    right = rows.select(F.col(key).alias("b"), F.col(value).alias("vb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb")


def _ids(pairs: DataFrame) -> DataFrame:
    return checkpointed(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct())


def _profiled(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """``(cid, marks, more, bins)`` of the documents with one of the ids, made where their texts are."""
    some = marked(docs.where("doc_id is not null"), "doc_id", ids, "cid").where("__maybe").select("doc_id", "text")
    return some.mapInArrow(lambda it: _profiles(it, n), "cid long, marks array<long>, more int, bins binary").join(ids, "cid", "left_semi")


def _verified(docs: DataFrame, sig: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough.

    Counts by parts of the hash range (some hundred bytes a document) rule out
    most false pairs; only the documents of the others are read again. A pair
    carries both sets, so pairs are compared in as many turns as keep what a
    turn carries under a share of all documents' sets, however many they are.
    """
    bins = checkpointed(_profiled(docs, _ids(pairs), n).select("cid", "bins"))
    pairs = checkpointed(_joined(pairs, bins, "cid", "bins").mapInArrow(lambda it: _prune(it, percent), "a long, b long").distinct())
    sets = checkpointed(having(docs.where("doc_id is not null"), "doc_id", _ids(pairs), "cid").mapInArrow(lambda it: _sets(it, n), "cid long, grams array<long>"))
    sizes = sets.select("cid", F.size("grams").cast("long").alias("grams"))
    carried = _joined(pairs, sizes, "cid", "grams").agg(F.sum(F.col("va") + F.col("vb"))).first()[0] or 0
    turns = -(-carried * TURN_SHARE // max(1, sig.agg(F.sum("n")).first()[0] or 0)) or 1
    out = None
    for turn in range(turns):
        own = pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(turns)) == turn) if turns > 1 else pairs
        found = _joined(own, sets, "cid", "grams").mapInArrow(lambda it: _check(it, percent), "a long, b long").distinct()
        found = checkpointed(found) if turns > 1 else found
        out = found if out is None else out.unionByName(found)
    return out


def components(df: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id``."""
    signatures, links = link_documents(df, n, percent, id_col, text_col)
    root = connected_components(links, "a", "b")
    out = signatures.join(root, F.col("cid") == F.col("node"), "left")
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "cid", "doc_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), found.alias("component_id"))
