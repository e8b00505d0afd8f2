"""Boosted binary trees grown on binned rows (L3, L5): the fit of MLlib's ``GBTClassifier`` for many rows.

MLlib keeps each row as objects of some hundred bytes and reads them again for
every level of every tree of every model; once they exceed the executors'
memory each reading comes from disk. Here a row is a few bytes: the features'
bins, several features to one 16-bit code. Models of one table (classes,
configurations) grow side by side: one reading of the blocks gives the
histograms of the next level of all of them.

The method is MLlib's: at most ``max_bins`` bins with its choice of borders,
labels of -1 and 1, log-loss residuals, least squares trees, rows sampled for
each tree, and a stop when the loss on the rows held out stops falling. The
result is MLlib's own model class.
"""

from __future__ import annotations

import pickle
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoframe.session import ensure_checkpoint_dir

#: Deepest trees: the leaves of one are the bits of a 64-bit number.
MOST_DEPTH = 6
#: Points that stand for the values of a feature in one task, and cells of one code.
POINTS, CELLS = 512, 2048
#: Rows that are computed at a time: their numbers stay in a processor's cache.
SLICE = 32_768
#: Trees after which the blocks are stored again with their rows' margins.
REFRESH = 5
_DEBRUIJN = np.uint64(0x03F79D71B4CB0A89)
_BIT = np.zeros(64, np.int16)
_BIT[[(0x03F79D71B4CB0A89 << i & 0xFFFFFFFFFFFFFFFF) >> 58 for i in range(64)]] = np.arange(64)


@dataclass
class Tree:
    """Nodes by number: feature and bin (rows of at most that bin go left), children (-1: a leaf), prediction, weight, gain, impurity."""

    feature: list = field(default_factory=list)
    bin: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)
    weight: list = field(default_factory=list)
    gain: list = field(default_factory=list)
    impurity: list = field(default_factory=list)

    def add(self, value: float, weight: float) -> int:
        for name, x in (("feature", -1), ("bin", -1), ("left", -1), ("right", -1), ("value", value), ("weight", weight), ("gain", 0.0), ("impurity", 0.0)):
            getattr(self, name).append(x)
        return len(self.value) - 1

    def leaves(self, node: int = 0) -> list[int]:
        if self.left[node] < 0:
            return [node]
        return self.leaves(self.left[node]) + self.leaves(self.right[node])


@dataclass
class Model:
    """One model to grow: rows of class ``target`` against the rest."""

    target: int
    max_iter: int = 50
    max_depth: int = 5
    step: float = 0.1
    subsample: float = 0.8
    min_instances: int = 1
    seed: int = 42
    tol: float = 0.01
    trees: list = field(default_factory=list)
    open: list = field(default_factory=list)        # nodes of the last tree that the next reading may split
    depth: int = 0
    best: float | None = None
    kept: int = 0
    done: bool = False
    finished: float = 0.0

    def weights(self) -> list[float]:
        return [1.0] + [self.step] * (len(self.trees) - 1)


@dataclass
class Blocks:
    """Binned rows: ``frame`` has a block of rows in each row."""

    frame: DataFrame
    rows: int
    borders: list[np.ndarray]
    packs: list[list[int]]

    @property
    def bins(self) -> list[int]:
        return [len(b) + 1 for b in self.borders]


# ----------------------------------------------------------------------------- bins

def _merged(values, counts, more_values, more_counts):
    v, at = np.unique(np.concatenate([values, more_values]), return_inverse=True)
    return v, np.bincount(at, np.concatenate([counts, more_counts]), len(v))


def _thinned(values, counts, points: int):
    """At most ``points`` of the values, each with the rows up to it."""
    if len(values) <= points:
        return values, counts
    upto = np.cumsum(counts)
    at = np.unique(np.append(np.searchsorted(upto, np.arange(1, points) * (upto[-1] / points)), len(values) - 1))
    return values[at], np.diff(upto[at], prepend=0.0)


def borders_of(values, counts, max_bins: int = 32) -> np.ndarray:
    """MLlib's choice: between all values if they are few, else where the rows up to a value come nearest to equal shares."""
    if len(values) <= max_bins:
        cut = np.arange(1, len(values))
    else:
        upto, cut, stride = np.cumsum(counts), [], counts.sum() / max_bins
        target = stride
        for i in range(1, len(values)):
            if abs(upto[i - 1] - target) < abs(upto[i] - target):
                cut.append(i)
                target += stride
        cut = np.array(cut[:max_bins - 1], int)
    mid = values[cut - 1] + (values[cut] - values[cut - 1]) / 2
    return np.unique(np.where(np.isfinite(mid), mid, values[cut - 1]))


def _summaries(rows: DataFrame, features: Sequence[str]) -> list:
    """``(values, counts)`` of each feature; all rows are read, tasks thin out what has many values."""
    k = len(features)

    def run(batches):
        own = [(np.zeros(0), np.zeros(0))] * k
        for batch in batches:
            for i in range(k):
                v, c = np.unique(batch.column(i).to_numpy(zero_copy_only=False).astype(float), return_counts=True)
                v, c = _merged(*own[i], v, c)
                own[i] = _thinned(v, c, 4 * POINTS) if len(v) > 32 * POINTS else (v, c)
        own = [_thinned(*x, POINTS) for x in own]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k, dtype=np.int32), [len(v) for v, _ in own])), pa.array(np.concatenate([v for v, _ in own])),
                                          pa.array(np.concatenate([c for _, c in own]))], names=["f", "v", "c"])

    found = rows.select(*features).mapInArrow(run, "f int, v double, c double").groupBy("f", "v").agg(F.sum("c").alias("c")).toArrow()
    f, v, c = (found.column(x).to_numpy() for x in ("f", "v", "c"))
    out = []
    for i in range(k):
        order = np.argsort(v[f == i])
        out.append((v[f == i][order], c[f == i][order]))
    return out


def _packs(bins: Sequence[int]) -> list[list[int]]:
    """Features that share a code: the first group with room for a feature takes it, those of many bins first."""
    out = []
    for f in sorted(range(len(bins)), key=lambda i: -bins[i]):
        for p in out:
            if np.prod([bins[i] for i in p]) * bins[f] <= CELLS:
                p.append(f)
                break
        else:
            out.append([f])
    return out


def binned(rows: DataFrame, features: Sequence[str], target: Column, weight: str | None, val: str | None, block_rows: int, max_bins: int = 32) -> Blocks:
    """The rows (whole ones: see ``ml.training_rows``) as blocks of at most ``block_rows``, stored once; ``target`` is the class number."""
    ensure_checkpoint_dir(rows.sparkSession)
    rows = rows.where(F.col(val).isNotNull()) if val else rows
    rows = rows.select(*[F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)], target.cast("int").alias("_y"),
                       (F.col(weight).cast("double") if weight else F.lit(None).cast("double")).alias("_w"),
                       (F.col(val) if val else F.lit(False)).alias("_val"), F.spark_partition_id().alias("_part"))
    names = [f"_f{i}" for i in range(len(features))]
    found = _summaries(rows, names)
    n = int(round(found[0][1].sum()))
    if not n:
        raise ValueError("no rows to fit on")
    borders = [borders_of(v, c, max_bins) for v, c in found]
    packs = _packs([len(b) + 1 for b in borders])
    k, weighted = len(features), weight is not None

    def run(batches):
        held, number = {False: [], True: []}, 0

        def block(val, parts):
            nonlocal number
            number += 1
            codes = np.concatenate([p[0] for p in parts], axis=1)
            return [part, number, val, codes.shape[1], codes.tobytes(), np.concatenate([p[1] for p in parts]).tobytes(), np.concatenate([p[2] for p in parts]).tobytes() if weighted else b"", b""]

        def batch_of(blocks):
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*blocks), (pa.int32(), pa.int32(), pa.bool_(), pa.int32(), *[pa.binary()] * 4))], names=_BLOCK)

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(k + 3)[0].as_py()
            bins = [np.searchsorted(b, batch.column(i).to_numpy(zero_copy_only=False)) for i, b in enumerate(borders)]
            codes = np.zeros((len(packs), batch.num_rows), np.uint16)
            for p, pack in enumerate(packs):
                for f in pack:
                    codes[p] = codes[p] * (len(borders[f]) + 1) + bins[f]
            y = batch.column(k).to_numpy(zero_copy_only=False).astype(np.uint8)
            w = batch.column(k + 1).fill_null(0.0).to_numpy(zero_copy_only=False) if weighted else None
            is_val = batch.column(k + 2).to_numpy(zero_copy_only=False).astype(bool)
            for val in (False, True):
                at = np.flatnonzero(is_val == val)
                while len(at):
                    room = block_rows - sum(len(p[1]) for p in held[val])
                    now, at = at[:room], at[room:]
                    held[val].append((codes[:, now], y[now], w[now] if weighted else None))
                    if len(now) == room:
                        yield batch_of([block(val, held[val])])
                        held[val] = []
        rest = [block(val, parts) for val, parts in held.items() if parts]
        if rest:
            yield batch_of(rest)

    frame = rows.mapInArrow(run, "part int, number int, val boolean, n int, codes binary, y binary, w binary, margins binary")
    frame = frame.repartition(-(-n // block_rows)) if n > block_rows else frame
    return Blocks(frame.checkpoint(), n, borders, packs)


_BLOCK = ["part", "number", "val", "n", "codes", "y", "w", "margins"]


# ----------------------------------------------------------------------------- reading the blocks

class _Reader:
    """Where the rows of a block fall in a model's trees."""

    def __init__(self, bins, packs):
        self.packs, self.dims = packs, [[bins[f] for f in p] for p in packs]
        self.place = {f: (p, i) for p, pack in enumerate(packs) for i, f in enumerate(pack)}

    def tables(self, tree: Tree) -> list:
        """For each code the leaves (as bits) that its features leave possible; codes without a split are ``None``."""
        leaves = tree.leaves()
        bit = {leaf: 1 << i for i, leaf in enumerate(leaves)}
        out = [None] * len(self.packs)
        every = sum(bit.values())

        def below(node):
            if tree.left[node] < 0:
                return bit[node]
            a, b = below(tree.left[node]), below(tree.right[node])
            p, axis = self.place[tree.feature[node]]
            if out[p] is None:
                out[p] = np.full(self.dims[p], every, np.uint64)
            low = tuple([slice(None)] * axis + [slice(0, tree.bin[node] + 1)])
            high = tuple([slice(None)] * axis + [slice(tree.bin[node] + 1, None)])
            out[p][low] &= np.uint64(every & ~b)
            out[p][high] &= np.uint64(every & ~a)
            return a | b

        below(0)
        return [None if t is None else t.ravel() for t in out]

    def leaf(self, tables, codes) -> np.ndarray | None:
        """The number of every row's leaf (``None``: there is one leaf)."""
        mask = None
        for t, c in zip(tables, codes):
            if t is not None:
                mask = t[c] if mask is None else mask & t[c]
        return None if mask is None else _BIT[(mask * _DEBRUIJN) >> np.uint64(58)]

    def margin(self, trees, codes) -> np.ndarray | float:
        total = 0.0
        for tables, values in trees:
            at = self.leaf(tables, codes)
            total = total + (values[0] if at is None else values[at])
        return total

    def ready(self, model: Model, first: int, last: int) -> list:
        return [(self.tables(t), np.array([t.value[x] for x in t.leaves()]) * w) for t, w in list(zip(model.trees, model.weights()))[first:last]]


def _block(batch, i, packs, models):
    n = batch.column(3)[i].as_py()
    get = lambda c, kind: np.frombuffer(batch.column(c)[i].as_buffer(), kind)
    w, m = get(6, np.float64), get(7, np.float32)
    return n, get(4, np.uint16).reshape(packs, n), get(5, np.uint8), w if len(w) else None, m.reshape(models, n) if len(m) else None


def _slices(block):
    """``(first row, rows)`` of a block, :data:`SLICE` rows at a time."""
    n, codes, y, w, margins = block
    for a in range(0, n, SLICE):
        b = min(n, a + SLICE)
        yield a, (b - a, codes[:, a:b], y[a:b], None if w is None else w[a:b], None if margins is None else margins[:, a:b])


def _counts(reader: _Reader, model: Model, state, rows, place, sampled, key) -> list:
    """Histograms of some rows for the open nodes of a model's last tree: weight, weighted residual (and rows), and the nodes' squares.

    ``place`` is the model's among the margins. Models that draw alike share the rows they draw (``sampled``).
    """
    done, tables, slots = state
    draw = (model.seed + len(model.trees) - 1, model.subsample)
    if draw not in sampled:
        n, codes, y, w, margins = rows
        at = np.flatnonzero(np.random.default_rng([draw[0], *key]).random(n, np.float32) < model.subsample) if model.subsample < 1.0 else slice(None)
        sampled[draw] = np.ascontiguousarray(codes[:, at]), y[at], None if w is None else w[at], at
    codes, y, w, at = sampled[draw]
    margins = None if rows[4] is None else rows[4][place][at]
    sign = np.where(y == model.target, 1.0, -1.0)
    if len(model.trees) == 1:
        residual = sign
    else:
        f = reader.margin(done, codes) + (0.0 if margins is None else margins)
        residual = 4.0 * sign / (1.0 + np.exp(np.minimum(2.0 * sign * f, 700.0)))
    at = reader.leaf(tables, codes)
    nodes = len(model.open)
    node = None if at is None else slots[at]            # leaves that are not open share a slot behind them
    own = residual if w is None else residual * w
    out = []
    for dims, code in zip(reader.dims, codes):
        cells = int(np.prod(dims))
        index = code if node is None else node * np.int32(cells) + code
        out += [np.bincount(index, x, (nodes + 1) * cells) for x in ([None, own] if w is None else [w, own, None])]
    slot = np.zeros(len(own), np.int64) if node is None else node
    return out + [np.bincount(slot, own * residual, nodes + 1)]


def _by_feature(reader: _Reader, nodes: int, found: list) -> list:
    """The histograms of codes as those of their features, and the nodes' squares."""
    out, each = [], (len(found) - 1) // len(reader.dims)
    for p, dims in enumerate(reader.dims):
        some = [h[:nodes * int(np.prod(dims))].reshape(nodes, *dims) for h in found[p * each:(p + 1) * each]]
        out += [np.stack([h.sum(axis=tuple(j + 1 for j in range(len(dims)) if j != i)) for h in some]).astype(float) for i in range(len(dims))]
    return out + [found[-1][:nodes]]


def _read(blocks: Blocks, models: list[Model], base: list[int]) -> tuple[list, list]:
    """One reading: the histograms of each model's open nodes, and ``(loss, weight)`` on the rows held out where a tree has just been finished."""
    bins, packs = blocks.bins, blocks.packs

    def run(batches):
        reader = _Reader(bins, packs)
        states = []
        for m, b in zip(models, base):
            growing = bool(m.open) and not m.done
            before = m.trees[:-1] if m.open else m.trees
            leaves = m.trees[-1].leaves() if growing else []
            slots = np.array([m.open.index(x) if x in m.open else len(m.open) for x in leaves], np.int32)
            states.append((reader.ready(m, b, len(before)), reader.tables(m.trees[-1]) if growing else None, slots) if not m.done else None)
        sums, losses = [None] * len(models), np.zeros((len(models), 2))
        looks = [not m.done and m.depth == 0 and (len(m.trees) > 1 or not m.open) for m in models]
        for batch in batches:
            for i in range(batch.num_rows):
                val, part, number = (batch.column(c)[i].as_py() for c in (2, 0, 1))
                if val and not any(looks):
                    continue
                for first, rows in _slices(_block(batch, i, len(packs), len(models))):
                    n, codes, y, w, margins = rows
                    sampled = {}
                    for j, m in enumerate(models):
                        if val and looks[j]:
                            f = reader.margin(states[j][0], codes) + (0.0 if margins is None else margins[j])
                            loss = np.broadcast_to(2.0 * np.logaddexp(0.0, np.where(y == m.target, -2.0, 2.0) * f), (n,))
                            losses[j] += (loss.sum(), n) if w is None else ((loss * w).sum(), w.sum())
                        elif not val and m.open and not m.done:
                            found = _counts(reader, m, states[j], rows, j, sampled, (part, number, first))
                            sums[j] = found if sums[j] is None else [a + b for a, b in zip(sums[j], found)]
        sums = [None if x is None else _by_feature(reader, len(m.open), x) for x, m in zip(sums, models)]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((sums, losses))], pa.binary())], names=["found"])

    few = max(1, 2 * blocks.frame.sparkSession.sparkContext.defaultParallelism)
    frame = blocks.frame
    if frame.rdd.getNumPartitions() > few:
        frame = frame.coalesce(few)
    sums, losses = [None] * len(models), np.zeros((len(models), 2))
    for row in frame.mapInArrow(run, "found binary").collect():
        s, l = pickle.loads(row["found"])
        losses += l
        sums = [b if a is None else a if b is None else [x + y for x, y in zip(a, b)] for a, b in zip(sums, s)]
    return sums, losses


def _with_margins(blocks: Blocks, models: list[Model], base: list[int]) -> Blocks:
    """The blocks with the margins of all finished trees, stored again."""
    bins, packs = blocks.bins, blocks.packs

    def run(batches):
        reader = _Reader(bins, packs)
        trees = [reader.ready(m, b, len(m.trees)) for m, b in zip(models, base)]
        for batch in batches:
            for i in range(batch.num_rows):
                n, codes, _, _, margins = _block(batch, i, len(packs), len(models))
                new = np.zeros((len(models), n), np.float32) if margins is None else margins.copy()
                for a in range(0, n, SLICE):
                    for j, t in enumerate(trees):
                        if t:
                            new[j, a:a + SLICE] += reader.margin(t, codes[:, a:a + SLICE])
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([*one.columns[:7], pa.array([new.tobytes()], pa.binary())], names=_BLOCK)

    frame = blocks.frame.mapInArrow(run, blocks.frame.schema).checkpoint()
    return Blocks(frame, blocks.rows, blocks.borders, blocks.packs)


# ----------------------------------------------------------------------------- growing

def _split(model: Model, found: list, features: list[int]) -> None:
    """Splits the open nodes of the last tree; ``found`` has the histograms in the order of ``features``, then the squares."""
    tree, nxt = model.trees[-1], []
    for i, node in enumerate(model.open):
        best = (1e-12, None)
        for f in sorted(range(len(features)), key=lambda x: features[x]):
            h = found[f][:, i]
            whole, left = h.sum(axis=1), np.cumsum(h, axis=1)[:, :-1]
            right = whole[:, None] - left
            few = np.minimum(left[-1 if len(h) == 3 else 0], right[-1 if len(h) == 3 else 0])
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = (left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - whole[1] ** 2 / whole[0]) / whole[0]
            gain = np.where((few >= max(model.min_instances, 0.5)) & (left[0] > 0) & (right[0] > 0), gain, -np.inf)
            if f == min(range(len(features)), key=lambda x: features[x]):
                if whole[0] > 0:
                    tree.value[node], tree.weight[node] = whole[1] / whole[0], whole[0]
                    tree.impurity[node] = max(found[-1][i] / whole[0] - tree.value[node] ** 2, 0.0)
            if len(gain) and gain.max() > best[0]:
                b = int(gain.argmax())
                best = (float(gain[b]), (features[f], b, left[:, b], right[:, b]))
        if best[1] is None:
            continue
        f, b, left, right = best[1]
        tree.feature[node], tree.bin[node], tree.gain[node] = f, b, best[0]
        tree.left[node], tree.right[node] = tree.add(left[1] / left[0], left[0]), tree.add(right[1] / right[0], right[0])
        nxt += [tree.left[node], tree.right[node]]
    model.depth += 1
    model.open = nxt if model.depth < model.max_depth else []


def _plant(model: Model) -> None:
    model.trees.append(Tree())
    model.open, model.depth = [model.trees[-1].add(0.0, 0.0)], 0


def grow(blocks: Blocks, models: list[Model], validated: bool) -> list[Model]:
    """Grows all models side by side."""
    features = [f for p in blocks.packs for f in p]
    base, stored = [0] * len(models), blocks
    for m in models:
        _plant(m)
        m.done = m.max_iter < 1
    while not all(m.done for m in models):
        sums, losses = _read(stored, models, base)
        for m, found, (loss, weight) in zip(models, sums, losses):
            if m.done:
                continue
            finished = len(m.trees) - 1 if m.open else len(m.trees)
            if m.depth == 0 and finished and validated and weight > 0:
                loss = loss / weight
                if m.best is not None and m.best - loss < m.tol * max(loss, 0.01):
                    m.done = True
                elif m.best is None or loss < m.best:
                    m.best, m.kept = loss, finished
            if not m.open:
                m.done = True
            if m.done:
                m.trees, m.open, m.finished = m.trees[:m.kept] if m.best is not None else m.trees[:finished], [], time.time()
                continue
            if found is None:
                m.open = []
            else:
                _split(m, found, features)
            if not m.open:
                m.depth = 0
                if len(m.trees) < m.max_iter:
                    _plant(m)
                elif not validated:
                    m.done, m.finished = True, time.time()
        behind = [0 if m.done else len(m.trees) - (1 if m.open else 0) - b for m, b in zip(models, base)]
        if max(behind) >= REFRESH:
            whole = [replace(m, trees=m.trees[:b]) if m.done else replace(m, trees=m.trees[:-1]) if m.open else m for m, b in zip(models, base)]
            stored = _with_margins(stored, whole, base)
            base = [len(m.trees) for m in whole]
    return models


# ----------------------------------------------------------------------------- MLlib's model

def as_model(spark: SparkSession, model: Model, borders: list[np.ndarray]) -> GBTClassificationModel:
    """The trees as an MLlib model, which scores, saves and ranks features as one that MLlib has fitted."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    ml, double = jvm.org.apache.spark.ml, jvm.double
    leaf, inner, split, kind = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, ml.regression.DecisionTreeRegressionModel
    variance = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator

    def doubles(xs):
        out = gateway.new_array(double, len(xs))
        for i, x in enumerate(xs):
            out[i] = float(x)
        return out

    def node(t: Tree, i: int):
        w, v, impurity = float(t.weight[i]), float(t.value[i]), float(t.impurity[i])
        stats = variance(doubles([w, w * v, w * (impurity + v * v)]), int(w))
        if t.left[i] < 0:
            return leaf(v, impurity, stats)
        at = split(t.feature[i], float(borders[t.feature[i]][t.bin[i]]))
        return inner(v, impurity, float(t.gain[i]), node(t, t.left[i]), node(t, t.right[i]), at, stats)

    trees = gateway.new_array(kind, len(model.trees))
    for i, t in enumerate(model.trees):
        trees[i] = kind(f"dtr_{i}", node(t, 0), len(borders))
    java = ml.classification.GBTClassificationModel(f"GBTClassifier_{uuid.uuid4().hex[:12]}", trees, doubles(model.weights()), len(borders), 2)
    java.setFeaturesCol("features")
    out = GBTClassificationModel(java)
    out._transfer_params_from_java()
    return out
