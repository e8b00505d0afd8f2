"""Operator 11: vector code compression (product quantisation) with exact nearest entries from a GNAT.

Components become integers ``floor(scale * x)``; vectors are cut into equal
parts, each part position has a codebook. *Fit*: the first codebooks are the
parts of the vectors with the smallest ids; each round assigns every part of
every row to its nearest entry and moves entries to ``floor(sum / count)`` of
their parts. *Nearest entry*: a geometric near-neighbour access tree over the
entries. Split points store the range of their distances to each child's
entries; a query's distances to the split points and its best distance so far
rule out whole children by the triangle inequality. Ranges and distances are
rounded so that a child is only ruled out when all of it is strictly farther;
what remains is compared by integer squared distances, ties to the lower index.

On Spark: a round is one scan; each task sends at most one row per entry and
component, which are summed by key. The driver holds the codebooks alone (their
size is a parameter). Codes are a checkpoint, read for the sums per label and
for the result.

Cases: rows whose vector is null, or holds a null or non-finite component, are
dropped. The dimension is that of the row with the least id whose length is a
positive multiple of ``parts``; rows of another length stay, with null code and
error. Null ids come after all others; rows with equal ids by their vectors;
with fewer rows than ``entries`` the codebooks are as small; equal rows get
equal codes. An empty table gives an empty result. Integers are exact for
|scale * x| < 2**27; beyond, an error says so. Columns of the input are kept,
those named like new ones are replaced.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from chronoframe.llm.storage import checkpointed
from chronoframe.operators.scalars import join_null_safe

#: Components up to here have squared distances, and sums of them, inside 64 bits.
LARGEST = 1 << 27
#: Rows that a task works on at a time.
ROWS = 4096
#: Relative width that distances are rounded outwards by: far more than their floating-point error.
MARGIN = 1e-12


class Gnat:
    """Geometric near-neighbour access tree over integer points; ``nearest`` answers a block of queries."""

    def __init__(self, points: np.ndarray, degree: int = 8, leaf: int = 8):
        self.points, self.degree, self.leaf = points.astype(np.int64), degree, leaf
        self.root = self._build(np.arange(len(points)))

    def _squares(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((a[:, None, :] - b[None, :, :]) ** 2).sum(-1)

    def _build(self, members: np.ndarray):
        """A leaf's members; or split points, their children, and the least and largest distance of each split point to each child."""
        if len(members) <= max(self.leaf, self.degree):
            return members
        square = self._squares(self.points[members], self.points[members])
        picked = [0]
        near = square[0].copy()
        while len(picked) < self.degree:            # each split point is the one farthest from those before
            near[picked] = -1
            k = int(near.argmax())
            picked.append(k)
            near = np.minimum(near, square[k])
        splits = np.array(sorted(picked))
        rest = np.setdiff1d(np.arange(len(members)), splits)
        owner = square[rest][:, splits].argmin(1)
        low = np.full((self.degree, self.degree), np.inf)
        high = np.full((self.degree, self.degree), -np.inf)
        children = []
        for j in range(self.degree):
            own = rest[owner == j]
            if len(own):
                d = np.sqrt(square[splits][:, own].astype(np.float64))
                low[:, j], high[:, j] = d.min(1) * (1 - MARGIN), d.max(1) * (1 + MARGIN)
            children.append(self._build(members[own]))
        return members[splits], children, low, high

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each query's nearest point (ties: the lower one) and the squared distance."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        index = np.full(len(queries), len(self.points))
        self._visit(self.root, np.arange(len(queries)), queries.astype(np.int64), best, index)
        return index, best

    def _compare(self, members, rows, queries, best, index) -> np.ndarray:
        """Integer comparison with some points; their squared distances."""
        square = self._squares(queries[rows], self.points[members])
        k = square.argmin(1)
        least, who = square[np.arange(len(rows)), k], members[k]
        better = (least < best[rows]) | (least == best[rows]) & (who < index[rows])
        best[rows[better]], index[rows[better]] = least[better], who[better]
        return square

    def _visit(self, node, rows, queries, best, index) -> None:
        if not isinstance(node, tuple):
            if len(node) and len(rows):
                self._compare(node, rows, queries, best, index)
            return
        splits, children, low, high = node
        square = self._compare(splits, rows, queries, best, index)
        away = np.sqrt(square.astype(np.float64))
        first = away.argmin(1)
        for j, child in enumerate(children):        # the likeliest child first: it sets the bound for the others
            self._visit(child, rows[first == j], queries, best, index)
        bound = np.sqrt(best[rows].astype(np.float64)) * (1 + MARGIN)
        down, up = away * (1 - MARGIN), away * (1 + MARGIN)
        for j, child in enumerate(children):
            if len(child):
                out = ((low[None, :, j] - up > bound[:, None]) | (down - high[None, :, j] > bound[:, None])).any(1)
                self._visit(child, rows[~out & (first != j)], queries, best, index)


@dataclass
class Codebooks:
    """Integer entries by part, index and position within the part."""

    entries: np.ndarray
    scale: float

    @property
    def parts(self) -> int:
        return self.entries.shape[0]

    @property
    def dimension(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()

    def trees(self) -> list[Gnat]:
        return [Gnat(e) for e in self.entries]


def kept(df: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector is there and finite throughout."""
    bad = F.exists(F.col(f"`{vec_col}`"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return df.where(F.col(f"`{vec_col}`").isNotNull() & ~bad)


def _vector(vec_col: str, dimension: int) -> Column:
    """The vector as doubles; null if it has another length."""
    v = F.col(f"`{vec_col}`")
    return F.when(F.size(v) == dimension, v.cast("array<double>"))


def integers(column: pa.Array, dimension: int, scale: float) -> np.ndarray:
    """Rows by components, ``floor(scale * x)``; null vectors are left out."""
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension) * scale)
    if len(x) and np.abs(x).max() >= LARGEST:
        raise OverflowError(f"a component reaches {LARGEST} after scaling: codes would not be exact")
    return x.astype(np.int64)


def _first(vectors: DataFrame, id_col: str, vec_col: str, parts: int, entries: int, scale: float) -> np.ndarray:
    """The first codebooks: ``entries`` rows, least ids first."""
    v = F.col(f"`{vec_col}`")
    usable = vectors.where((F.size(v) > 0) & (F.size(v) % parts == 0)).select(F.col(f"`{id_col}`").alias("__id"), v.cast("array<double>").alias("__v"))
    order = [F.col("__id").asc_nulls_last(), "__v"]
    least = [r["__v"] for r in usable.orderBy(*order).limit(entries).collect()]
    if any(len(x) != len(least[0]) for x in least):
        least = [r["__v"] for r in usable.where(F.size("__v") == len(least[0])).orderBy(*order).limit(entries).collect()]
    dimension = len(least[0]) if least else 0
    x = integers(pa.array(least, pa.list_(pa.float64())), dimension, scale) if least else np.zeros((0, 0), np.int64)
    return x.reshape(len(least), parts, dimension // parts).transpose(1, 0, 2).copy()


def fit(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", parts: int = 16, entries: int = 64, scale: float = 256, rounds: int = 2) -> Codebooks:
    """Codebooks from every usable row of ``df``, after ``rounds`` of assignment and update."""
    vectors = kept(df, vec_col)
    books = Codebooks(_first(vectors, id_col, vec_col, parts, entries, scale), scale)
    if not books.dimension:
        return books
    column = vectors.select(_vector(vec_col, books.dimension).alias("v"))
    for _ in range(rounds):
        sums = column.mapInArrow(_sums(books), "part int, entry int, pos int, n long, s long")
        total = sums.groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        moved = books.entries.copy()
        for r in total.collect():                   # a row for each component of each entry at most
            moved[r["part"], r["entry"], r["pos"]] = int(r["s"]) // r["n"]
        books = Codebooks(moved, scale)
    return books


def _sums(books: Codebooks):
    """Per task: how many parts each entry has, and the sums of their components."""
    def run(batches):
        parts, size, width = books.entries.shape
        trees, count, total = books.trees(), np.zeros((parts, size), np.int64), np.zeros((parts, size, width), np.int64)
        for batch in batches:
            x = integers(batch.column(0), books.dimension, books.scale)
            for at in range(0, len(x), ROWS):
                block = x[at:at + ROWS].reshape(-1, parts, width)
                for p, tree in enumerate(trees):
                    entry, _ = tree.nearest(block[:, p])
                    count[p] += np.bincount(entry, minlength=size)
                    np.add.at(total[p], entry, block[:, p])
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(np.repeat(part, width).astype(np.int32)), "entry": pa.array(np.repeat(entry, width).astype(np.int32)),
            "pos": pa.array(np.tile(np.arange(width, dtype=np.int32), len(part))), "n": pa.array(np.repeat(count[part, entry], width)),
            "s": pa.array(total[part, entry].reshape(-1))})
    return run


def encode(df: DataFrame, books: Codebooks, vec_col: str = "embedding") -> DataFrame:
    """Usable rows of ``df`` with ``code`` (hex digits of the entries, by part) and ``error`` (squared distance in scaled units)."""
    new = ["code", "error"]
    rest = [c for c in df.columns if c not in new]
    schema = StructType([df.schema[c] for c in rest] + [StructField("code", StringType()), StructField("error", LongType())])
    rows = kept(df, vec_col)
    if not books.dimension:
        return rows.select(*[F.col(f"`{c}`") for c in rest], F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    digits = max(2, len(f"{books.entries.shape[1] - 1:x}"))

    def run(batches):
        parts, size, width = books.entries.shape
        trees, names = books.trees(), np.array([f"{k:0{digits}x}" for k in range(size)], dtype=f"S{digits}")
        for batch in batches:
            there = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            x = integers(batch.column(0), books.dimension, books.scale)
            index, error = np.zeros((len(x), parts), np.int64), np.zeros(len(x), np.int64)
            for at in range(0, len(x), ROWS):
                block = x[at:at + ROWS].reshape(-1, parts, width)
                for p, tree in enumerate(trees):
                    index[at:at + ROWS, p], square = tree.nearest(block[:, p])
                    error[at:at + ROWS] += square
            codes, errors = np.full(len(there), None, dtype=object), np.full(len(there), None, dtype=object)
            codes[there] = np.ascontiguousarray(names[index]).view(f"S{digits * parts}").reshape(-1).astype(str) if len(x) else []
            errors[there] = error
            yield pa.RecordBatch.from_arrays(batch.columns[1:] + [pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=rest + new)

    return rows.select(_vector(vec_col, books.dimension).alias("__v"), *[F.col(f"`{c}`") for c in rest]).mapInArrow(run, schema)


def decode(df: DataFrame, books: Codebooks, code_col: str = "code", out_col: str = "decoded") -> DataFrame:
    """``df`` with the vectors that the codes stand for: the middle of each entry's components (null code: null)."""
    digits = max(2, len(f"{books.entries.shape[1] - 1:x}")) if books.dimension else 2
    rest = [c for c in df.columns if c != out_col]
    values = (books.entries + 0.5) / books.scale

    def run(batches):
        for batch in batches:
            out = []
            for code in batch.column(0).to_pylist():
                out.append(None if code is None else np.concatenate([values[p, int(code[p * digits:(p + 1) * digits], 16)] for p in range(books.parts)]).tolist())
            yield pa.RecordBatch.from_arrays(batch.columns[1:] + [pa.array(out, pa.list_(pa.float64()))], names=rest + [out_col])

    from pyspark.sql.types import ArrayType
    return df.select(F.col(f"`{code_col}`").alias("__code"), *[F.col(f"`{c}`") for c in rest]).mapInArrow(run, StructType([df.schema[c] for c in rest] + [StructField(out_col, ArrayType(DoubleType()))]))


def compress(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64, scale: float = 256, rounds: int = 2) -> DataFrame:
    """Fit, encode, and sum the errors over equal labels (nulls together): adds ``code``, ``error``, ``label_error`` and ``codebooks_sha256``."""
    books = fit(df, id_col, vec_col, parts, entries, scale, rounds)
    added = ("code", "error", "label_error", "codebooks_sha256")
    keep = [c for c in df.columns if c != vec_col and (c not in added or c in (id_col, label_col))]
    coded = checkpointed(encode(df, books, vec_col).select(*[F.col(f"`{c}`") for c in keep], "code", "error"))
    by_label = coded.groupBy(label_col).agg(F.sum("error").alias("label_error"))
    return join_null_safe(coded, by_label, [label_col]).withColumn("codebooks_sha256", F.lit(books.sha256))
