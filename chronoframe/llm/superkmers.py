"""Shared by the two passage operators: packed strings of neighbouring windows, and the way back from ranges to texts."""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoframe.llm import bitmaps
from chronoframe.llm.arrays import NO_ID, U64, chunks, gather, mix
from chronoframe.llm.memories import release
from chronoframe.llm.storage import checkpointed

RANGES, STRINGS = 0, 1
#: Text of one bucket, in bytes: its strings take a few times as much.
BUCKET_BYTES = 16 << 20
#: A part that a task meets ``LOCAL_MIN`` times in a block of ``BLOCK`` parts is reported; from ``HOT_MIN`` in all it is
#: frequent; the ``HOT_PARTS`` most frequent are broadcast. Any fixed order gives the same result; this one keeps buckets even.
LOCAL_MIN, BLOCK, HOT_MIN, HOT_PARTS = 4, 1 << 20, 64, 200_000
_TOP = U64(1 << 63)


class PartOrder:
    """Order in which the least part of a window is its minimiser: by hash, the frequent parts after all others.

    A phrase that a large share of all texts has would be the minimiser of
    every window that holds it, and its bucket would grow with the documents.
    Ranked last it is the minimiser only of windows that hold nothing else;
    those are alike, and settle where they are read.
    """

    def __init__(self, frequent: np.ndarray):
        self.frequent = np.sort(frequent)
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.frequent >> U64(43) & U64((1 << 20) - 1)).astype(np.int64)] = True

    def ranks(self, parts: np.ndarray) -> np.ndarray:
        """The parts' hashes without their top bit, which says whether the part is frequent."""
        out = parts & ~_TOP
        if len(self.frequent):
            at = np.flatnonzero(self.maybe[(out >> U64(43)).astype(np.int64)])
            k = np.minimum(np.searchsorted(self.frequent, out[at]), len(self.frequent) - 1)
            out[at[self.frequent[k] == out[at]]] |= _TOP
        return out


#: The order by hash alone.
PLAIN = PartOrder(np.zeros(0, U64))


def bucket_of(rank: np.ndarray, n_buckets: int) -> np.ndarray:
    return (mix(rank) % U64(n_buckets)).astype(np.int64)


def plan(texts: DataFrame, parts_in, piece: int) -> tuple[PartOrder, int]:
    """``(order, buckets)`` from one scan of the texts (a column ``text``).

    ``parts_in(data, offsets)`` gives the hashes of all parts that may come to
    be minimisers. Tasks report what they meet often and
    the bytes they read; the sums choose the parts that go last and the number
    of buckets (at least twice the shuffle partitions).
    """
    def count(batches):
        release()
        parts, size, read = [], 0, 0

        def flush():
            h = np.concatenate(parts) if parts else np.zeros(0, U64)
            parts.clear()
            h.sort()
            first = np.flatnonzero(np.concatenate((np.ones(min(1, len(h)), dtype=bool), h[1:] != h[:-1])))
            n = np.diff(np.append(first, len(h)))
            often = n >= LOCAL_MIN
            return pa.RecordBatch.from_pydict({"h": pa.array(np.append(h[first[often]].view(np.int64), -1)), "n": pa.array(np.append(n[often], read))})

        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0), piece):
                read += len(data)
                parts.append(parts_in(data, offsets) & ~_TOP)
                size += len(parts[-1])
                if size >= BLOCK:
                    yield flush()
                    parts, size, read = [], 0, 0
        yield flush()

    counts = texts.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where((F.col("h") == -1) | (F.col("n") >= HOT_MIN))
    rows = counts.orderBy((F.col("h") != -1), F.desc("n"), "h").limit(HOT_PARTS + 1).toPandas()
    total = int(rows.loc[rows["h"] == -1, "n"].sum())
    hot = rows.loc[rows["h"] != -1, "h"].to_numpy(dtype=np.int64).view(U64)
    return PartOrder(hot), max(2 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))


def pack(kind: int, *parts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps((kind, *parts), protocol=5))


def unpack(blob: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def packed_strings(bucket: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, *marks: np.ndarray):
    """``(bucket, blob)`` for each bucket met: its strings end to end, their lengths and what marks them."""
    order = np.argsort(bucket.astype(np.uint16) if len(bucket) and bucket.max() < 1 << 16 else bucket, kind="stable")
    sorted_bucket = bucket[order]
    cut = np.flatnonzero(np.concatenate((np.ones(min(1, len(order)), dtype=bool), sorted_bucket[1:] != sorted_bucket[:-1])))
    for a, b in zip(cut, np.append(cut[1:], len(order))):
        own = order[a:b]
        yield int(sorted_bucket[a]), pack(STRINGS, gather(data, starts[own], lengths[own]), lengths[own].astype(np.int32), *[m[own] for m in marks])


def record(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"bucket": pa.array([r[0] for r in rows], pa.int64()), "blob": pa.array([r[1] for r in rows], pa.binary())})


RANGE_SCHEMA = "doc long, span long, h long"


def range_rows(found: list) -> pd.DataFrame:
    """Rows of ranges ``(document, first, length, hash)``; first and length share one long."""
    doc, first, n, h = (np.concatenate([np.asarray(f[k], dtype=np.int64) for f in found]) if found else np.zeros(0, np.int64) for k in range(4))
    return pd.DataFrame({"doc": doc, "span": first << 32 | n, "h": h})


def with_ranges(df: DataFrame, ranges: DataFrame, id_col: str) -> DataFrame:
    """``df`` with each row's ranges (spans and hashes by turns, null if none) as ``__ranges``; null ids go by :data:`NO_ID`.

    Only texts that may have a range are shuffled for the join.
    """
    own = checkpointed(ranges.groupBy(F.col("doc").alias("__doc")).agg(F.flatten(F.collect_list(F.array("span", "h"))).alias("__ranges")))
    keyed = df.withColumn("__key", F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(int(NO_ID))))
    few = bitmaps.marked(keyed, "__key", own, "__doc")
    none = few.where("not __maybe").withColumn("__ranges", F.lit(None).cast("array<long>"))
    some = few.where("__maybe").join(own, F.col("__key") == F.col("__doc"), "left").drop("__doc")
    return none.unionByName(some).drop("__key", "__maybe")


def range_arrays(column: pa.Array, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """First, length and hash of each range of a row."""
    one = column[row]
    if not one.is_valid:
        return None
    v = one.values.to_numpy(zero_copy_only=False)
    return v[::2] >> 32, v[::2] & 0xFFFFFFFF, v[1::2]
