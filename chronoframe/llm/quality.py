"""Operator 13: document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are binned numbers of the line itself
and of both neighbours (length, capitals, signs, digits, words that repeat the
word before, words and three-word runs that the document has already had,
repeated lines, ends), each with a weight; neighbouring labels have weights too.
Forward-backward gives each line's probability of being good; their mean,
weighted by length, is the document's raw value, which a logistic curve turns
into the probability of label 1.

*Learning* has document labels only: all lines of a good document are good, of
a bad one at least one line is bad. A first phase takes every line of a bad
document as bad (the usual likelihood), the second asks for one bad line only.
Both are maximised by L-BFGS; each value and gradient is a Spark job over the
packed features of the learning rows, which returns one row for each task.
Learning rows are a bounded sample (``LABELLED_ROWS``, least hash of the id),
whose ids are broadcast; the calibration reads a histogram of their raw values.
Scoring is one scan without a shuffle.

Lines end at ``\\n``; words are runs of bytes other than ASCII blanks. Whole
texts are used.

Cases: null text is empty; a text without any line that has a character scores
the rate of label 1 among the learning rows (Laplace; 0.5 without any); rows
with null id or null label teach nothing; an id with several labels counts as
the lowest; repeated rows are scored each; with one kind of label only, scores
are that rate's; columns of the input are kept, those named like new ones are
replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from chronoframe.llm.arrays import LOWER, SEPARATOR, chunks, mix, owners, poly, word_hashes, word_spans
from chronoframe.llm.memories import release
from chronoframe.llm.storage import checkpointed, document_batches

LABELLED_ROWS = 40_000
#: Edges of the bins of each feature; a value's bin is the number of edges that it reaches.
SHARES = (0.001, 0.02, 0.05, 0.1, 0.2, 0.35, 0.6, 0.9)
SIZES = (1, 4, 12, 30, 60, 120, 250, 600)
FEATURES = {
    "bytes": SIZES, "words": (1, 2, 4, 8, 16, 32, 64, 128), "word_length": (1, 2.5, 4, 5, 6, 7, 9, 14),
    "capitals": SHARES, "signs": SHARES, "points": SHARES, "digits": SHARES, "like_last_word": SHARES, "old_words": SHARES, "old_runs": SHARES,
    "same_line": (1, 2, 3, 5, 9, 20, 50, 200), "first_capital": (1,), "end": (1, 2, 3),
}
BINS = 1 + max(map(len, FEATURES.values()))
#: Neighbours whose features count, and the bin of a neighbour that is not there.
OFFSETS = (0, -1, 1)
WEIGHTS = len(OFFSETS) * len(FEATURES) * (BINS + 1)

_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_LETTER = _CAPITAL.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_POINT = np.zeros(256, bool)
_POINT[[ord(c) for c in ".,;:!?'\"-()"]] = True
_SIGN = ~(_LETTER | _DIGIT | _POINT | SEPARATOR)
_ENDS = np.zeros(256, np.int8)
_ENDS[[ord(c) for c in ".!?"]] = 1
_ENDS[[ord(c) for c in ",;:-"]] = 2
_ENDS[_SIGN] = 3
_SEED = 11


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, bounds)``: byte spans of the lines without their ends; document ``d`` has lines ``bounds[d]:bounds[d+1]`` (an empty text none)."""
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate((offsets[:-1][offsets[1:] > offsets[:-1]], breaks + 1)))
    starts = starts[starts < len(data)]
    doc = np.searchsorted(offsets, starts, side="right") - 1
    ends = np.minimum(np.append(breaks, len(data))[np.searchsorted(breaks, starts)], offsets[doc + 1])
    return starts, ends, np.searchsorted(starts, offsets)


def _seen(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether the same owner had the same value at an earlier place."""
    key = mix(value ^ mix(owner.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    return again


def _times(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """How often the owner has the value in all."""
    _, back, n = np.unique(mix(value ^ mix(owner.astype(np.uint64))), return_inverse=True, return_counts=True)
    return n[back]


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(codes, lengths, bounds)``: each line's bins, its bytes other than blanks, and the lines of each document."""
    starts, ends, bounds = lines_of(data, offsets)
    n = len(starts)
    if not n:
        return np.zeros((0, len(FEATURES)), np.uint8), np.zeros(0, np.int64), bounds

    def within(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[ends] - total[starts]

    visible = within(~SEPARATOR[data])
    letters = within(_LETTER[data])
    w_start, w_end, w_bounds = word_spans(data, offsets)
    line = np.searchsorted(starts, w_start, side="right") - 1
    words = np.bincount(line, minlength=n)
    doc = owners(w_bounds)
    lower = LOWER[data]
    h = word_hashes(lower, w_start, w_end, _SEED)
    like_last, old_run = np.zeros(len(h), bool), np.zeros(len(h), bool)
    if len(h) > 1:
        like_last[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    if len(h) > 2:
        run = h[2:] + mix(h[1:-1] + mix(h[:-2]))
        whole = doc[2:] == doc[:-2]
        at = np.flatnonzero(whole) + 2
        old_run[at] = _seen(doc[at], run[whole])
    old_word = _seen(doc, h)

    def per_word(mask: np.ndarray) -> np.ndarray:
        return np.bincount(line[mask], minlength=n) / np.maximum(words, 1)

    text = poly(_SEED).span(poly(_SEED).prefix_bytes(data), starts, ends)
    first, last = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    has = words > 0
    first_word = np.searchsorted(w_start, starts)[has]
    first[has] = data[w_start[first_word]]
    last[has] = data[w_end[np.searchsorted(w_start, ends)[has] - 1] - 1]
    values = {
        "bytes": ends - starts, "words": words, "word_length": visible / np.maximum(words, 1),
        "capitals": within(_CAPITAL[data]) / np.maximum(letters, 1), "signs": within(_SIGN[data]) / np.maximum(visible, 1),
        "points": within(_POINT[data]) / np.maximum(visible, 1), "digits": within(_DIGIT[data]) / np.maximum(visible, 1),
        "like_last_word": per_word(like_last), "old_words": per_word(old_word), "old_runs": per_word(old_run),
        "same_line": _times(owners(bounds), text) - 1, "first_capital": _CAPITAL[first] | (first >= 128), "end": np.where(has, _ENDS[last], 0),
    }
    codes = np.stack([np.searchsorted(np.asarray(edges), values[name], side="right") for name, edges in FEATURES.items()], axis=1)
    return codes.astype(np.uint8), visible, bounds


# --- the chain -------------------------------------------------------------------------------------------------------

def slots(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Index of the weight of each feature of each line and of its neighbours."""
    n, k = codes.shape
    parts = []
    for o, step in enumerate(OFFSETS):
        near = np.full((n, k), BINS, np.int64)
        if step == 0:
            near[:] = codes
        else:
            doc = owners(bounds)
            to = np.arange(n) + step
            ok = (to >= 0) & (to < n)
            ok[ok] = doc[to[ok]] == doc[ok]
            near[ok] = codes[to[ok]]
        parts.append(near + (o * k + np.arange(k)) * (BINS + 1))
    return np.concatenate(parts, axis=1)


def _running(m: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Products of 2 x 2 matrices from each run's first line to every line, by doubling; ``(normalised product, log of its scale)``."""
    p, scale = m.copy(), np.zeros(len(m))
    step = 1
    at = np.flatnonzero(place >= step)
    while len(at):
        new = np.matmul(p[at - step], p[at])
        most = new.max((1, 2))
        grown = scale[at - step] + scale[at] + np.log(most)
        p[at], scale[at] = new / most[:, None, None], grown
        step *= 2
        at = at[place[at] >= step]
    return p, scale


def forward_backward(unary: np.ndarray, moves: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(good, pairs, log_z)``: each line's probability of being good, the expected moves of each document, and its log partition sum.

    ``unary`` is the weight of good over bad, ``moves[a, b]`` that of label b after label a.
    """
    n, docs = len(unary), len(bounds) - 1
    doc = owners(bounds)
    place = np.arange(n) - bounds[doc]
    up = np.maximum(unary, 0)
    node = np.exp(np.stack((-up, unary - up), axis=1))
    step = np.exp(moves)
    m = step[None] * node[:, None, :]
    m[place == 0] = node[place == 0][:, None, :]
    forward, f_scale = _running(m, place)
    behind = np.zeros(n, np.int64)
    size = np.diff(bounds)[doc]
    behind[:] = size - 1 - place
    # backward: the product of what follows, taken from the end
    turned = np.ones((n, 2, 2))
    inner = np.flatnonzero(behind > 0)
    turned[inner] = m[inner + 1].transpose(0, 2, 1)
    back = turned[::-1]
    back[behind[::-1] == 0] = np.eye(2)
    backward, b_scale = _running(np.ascontiguousarray(back), behind[::-1])
    beta = backward[::-1].sum(1)
    alpha = forward[:, 0, :]
    both = alpha * beta
    total = both.sum(1)
    good = both[:, 1] / total
    pairs = np.zeros((docs, 2, 2))
    later = np.flatnonzero(place > 0)
    joint = alpha[later - 1][:, :, None] * m[later] * beta[later][:, None, :]
    joint /= joint.sum((1, 2), keepdims=True)
    np.add.at(pairs, doc[later], joint)
    lifted = np.bincount(doc, weights=up, minlength=docs)
    log_z = np.zeros(docs)
    has = np.diff(bounds) > 0
    final = bounds[1:][has] - 1
    log_z[has] = np.log(alpha[final].sum(1)) + f_scale[final] + lifted[has]
    return good, pairs, log_z


def likelihood(codes: np.ndarray, bounds: np.ndarray, label: np.ndarray, w: np.ndarray, some_line: bool) -> tuple[float, np.ndarray]:
    """Log likelihood of the document labels and its gradient.

    ``some_line`` false: every line has its document's label. True: a good
    document has good lines only, a bad one at least one bad line.
    """
    at, moves = slots(codes, bounds), w[WEIGHTS:].reshape(2, 2)
    unary = w[:WEIGHTS][at].sum(1)
    good, pairs, log_z = forward_backward(unary, moves, bounds)
    doc = owners(bounds)
    size = np.diff(bounds)
    has = size > 0
    steps = np.maximum(size - 1, 0)
    own = np.where(some_line, 1, label)                                 # the labelling whose probability is asked for
    path = np.where(own == 1, np.bincount(doc, weights=unary, minlength=len(size)) + steps * moves[1, 1], steps * moves[0, 0])
    log_p = np.minimum(path - log_z, 0.0)
    factor = np.ones(len(size))
    value = log_p
    if some_line:
        low = np.minimum(log_p, -1e-9)
        bad = label == 0
        value = np.where(bad, np.log(-np.expm1(low)), log_p)
        factor = np.where(bad, -np.exp(low) / -np.expm1(low), 1.0)
    factor = np.where(has, factor, 0.0)
    grad = np.zeros(WEIGHTS + 4)
    off = factor[doc] * (own[doc] - good)
    np.add.at(grad, at.reshape(-1), np.repeat(off, at.shape[1]))
    per_doc = -pairs
    per_doc[:, 1, 1] += np.where(own == 1, steps, 0)
    per_doc[:, 0, 0] += np.where(own == 0, steps, 0)
    grad[WEIGHTS:] = (per_doc * factor[:, None, None]).sum(0).reshape(-1)
    return float(value[has].sum()), grad


# --- the model -------------------------------------------------------------------------------------------------------

@dataclass
class QualityModel:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(WEIGHTS + 4))
    base: float = 0.5
    curve: tuple[float, float] | None = None        # slope and shift of the logistic curve; None: the base rate for all

    def line_values(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each line's probability of being good, its length, and the lines of each document."""
        codes, length, bounds = features(data, offsets)
        unary = self.weights[:WEIGHTS][slots(codes, bounds)].sum(1)
        good, _, _ = forward_backward(unary, self.weights[WEIGHTS:].reshape(2, 2), bounds)
        return good, length, bounds

    def raw(self, column: pa.Array) -> np.ndarray:
        """Length-weighted mean of the lines' probabilities; NaN without a visible character."""
        out = np.full(len(column), np.nan)
        for first, last, data, offsets in chunks(column):
            good, length, bounds = self.line_values(data, offsets)
            doc = owners(bounds)
            weight = np.bincount(doc, weights=length, minlength=last - first)
            total = np.bincount(doc, weights=length * good, minlength=last - first)
            with np.errstate(invalid="ignore", divide="ignore"):
                out[first:last] = np.where(weight > 0, total / weight, np.nan)
        return out

    def scores(self, raw: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(raw), self.base)
        slope, shift = self.curve
        return np.where(np.isnan(raw), self.base, 1 / (1 + np.exp(-(slope * logit(np.nan_to_num(raw, nan=0.5)) + shift))))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def lbfgs(value_and_gradient, w: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """Minimises by L-BFGS with a backtracking search; ``rounds`` bounds the evaluations."""
    f, g = value_and_gradient(w)
    past, used = [], 1
    while used < rounds and np.abs(g).max() > 1e-3:
        q, a = g.copy(), []
        for s, y in reversed(past):
            a.append(s @ q / (s @ y))
            q -= a[-1] * y
        if past:
            s, y = past[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.linalg.norm(g))
        for (s, y), x in zip(past, reversed(a)):
            q += (x - y @ q / (s @ y)) * s
        step = 1.0
        while True:
            new = w - step * q
            f2, g2 = value_and_gradient(new)
            used += 1
            if f2 <= f - 1e-4 * step * (g @ q) or used >= rounds:
                break
            step /= 2
        if f2 >= f:
            break
        s, y = new - w, g2 - g
        if s @ y > 1e-10:
            past = (past + [(s, y)])[-memory:]
        w, f, g = new, f2, g2
    return w


def _sample(labels: DataFrame, id_col: str, label_col: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids by least hash: the stated bound of what is learnt from, and broadcast."""
    one = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    one = one.groupBy(F.col(id_col).cast("long").alias("__id")).agg(F.min((F.col(label_col) > 0).cast("int")).alias("__y"))
    return one.orderBy(F.xxhash64("__id"), "__id").limit(rows)


def _packed(known: DataFrame) -> DataFrame:
    """``(y, n, codes)``: label, lines and packed bins of each learning row."""
    def run(batches):
        release()
        for batch in batches:
            out = [None] * batch.num_rows
            for first, last, data, offsets in chunks(batch.column(0)):
                codes, _, bounds = features(data, offsets)
                for d in range(last - first):
                    out[first + d] = codes[bounds[d]:bounds[d + 1]].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([len(x) // len(FEATURES) for x in out], pa.int32()), pa.array(out, pa.binary())], names=["y", "n", "codes"])

    return known.select("text", "__y").mapInArrow(run, "y int, n int, codes binary")


#: Lines that one evaluation works on at a time.
LINES = 200_000


def _evaluated(rows: DataFrame, w: np.ndarray, some_line: bool) -> tuple[float, np.ndarray]:
    """Log likelihood and gradient over all learning rows: one row comes back from each task."""
    def run(batches):
        value, grad = 0.0, np.zeros(len(w))
        for batch in batches:
            y, n = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)
            ends = np.cumsum(n)
            first = 0
            while first < len(n):
                last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + LINES, side="right")))
                codes = np.frombuffer(b"".join(batch.column(2)[first:last].to_pylist()), np.uint8).reshape(-1, len(FEATURES))
                v, g = likelihood(codes, np.concatenate(([0], np.cumsum(n[first:last]))), y[first:last], w, some_line)
                value, grad, first = value + v, grad + g, last
        yield pa.RecordBatch.from_pydict({"value": pa.array([value]), "grad": pa.array([grad.tolist()], pa.list_(pa.float64()))})

    parts = rows.mapInArrow(run, "value double, grad array<double>").collect()
    return sum(p["value"] for p in parts), np.sum([p["grad"] for p in parts], axis=0) if parts else np.zeros(len(w))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        rows: int = LABELLED_ROWS, penalty: float = 1.0, rounds: tuple[int, int] = (12, 18), tasks: int = 8) -> QualityModel:
    """Learn from at most ``rows`` labelled rows; ``rounds`` are the evaluations of both phases, ``tasks`` the tasks of one."""
    document_batches(docs)
    sample = F.broadcast(_sample(labels, id_col, label_col, rows))
    known = docs.select(F.col(f"`{id_col}`").cast("long").alias("__id"), F.col(f"`{text_col}`").alias("text")).join(sample, "__id")
    packed = checkpointed(_packed(known)).coalesce(tasks)
    seen = {r["y"]: r["k"] for r in packed.groupBy("y").agg(F.count("*").alias("k")).collect()}
    model = QualityModel(base=(seen.get(1, 0) + 1) / (sum(seen.values()) + 2))
    if len(seen) < 2:
        return model
    w = model.weights
    for some_line, most in zip((False, True), rounds):
        def lost(w, some_line=some_line):
            value, grad = _evaluated(packed, w, some_line)
            return -value + penalty / 2 * w @ w, -grad + penalty * w

        w = lbfgs(lost, w, most)
    model.weights = w
    model.curve = _curve(known, model)
    return model


def _curve(known: DataFrame, model: QualityModel) -> tuple[float, float]:
    """Logistic curve from raw value to label, by Newton's method on a histogram of 1,001 raw values."""
    shared = known.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            raw = shared.value.raw(batch.column(0))
            ok = ~np.isnan(raw)
            yield pa.RecordBatch.from_pydict({"bin": pa.array(np.round(raw[ok] * 1000).astype(np.int32)), "y": batch.column(1).filter(pa.array(ok))})

    rows = known.select("text", "__y").mapInArrow(run, "bin int, y int").groupBy("bin", "y").agg(F.count("*").alias("k")).collect()
    x = logit(np.array([r["bin"] for r in rows]) / 1000)
    y, k = np.array([r["y"] for r in rows], float), np.array([r["k"] for r in rows], float)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        g = np.array([(k * (y - p) * x).sum() - (a - 1), (k * (y - p)).sum() - 0.01 * b])
        v = k * p * (1 - p)
        hess = np.array([[(v * x * x).sum() + 1, (v * x).sum()], [(v * x).sum(), v.sum() + 0.01]])
        move = np.clip(np.linalg.solve(hess, g), -2, 2)
        a, b = a + move[0], b + move[1]
    return max(float(a), 1e-3), float(b)


def score(df: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Add ``score`` and ``predicted`` (1 from ``threshold`` on)."""
    new = ["score", "predicted"]
    rest = [c for c in df.columns if c not in new]
    shared = document_batches(df).sparkSession.sparkContext.broadcast(model)

    def run(batches):
        release()
        for batch in batches:
            values = shared.value.scores(shared.value.raw(batch.column(0)))
            yield pa.RecordBatch.from_arrays(batch.columns[1:] + [pa.array(values, pa.float64()), pa.array((values >= threshold).astype(np.int32))], names=rest + new)

    schema = StructType([df.schema[c] for c in rest] + [StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return df.select(F.col(f"`{text_col}`").alias("__text"), *[F.col(f"`{c}`") for c in rest]).mapInArrow(run, schema)


def line_labels(df: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, line, good)``: the probability of being good of every line (numbered from 0)."""
    shared = document_batches(df).sparkSession.sparkContext.broadcast(model)

    def run(batches):
        release()
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column(1)):
                good, _, bounds = shared.value.line_values(data, offsets)
                doc = owners(bounds)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc + first)), pa.array(np.arange(len(doc)) - bounds[doc]), pa.array(good)], names=[id_col, "line", "good"])

    from pyspark.sql.types import LongType
    schema = StructType([df.schema[id_col], StructField("line", LongType()), StructField("good", DoubleType())])
    return df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows kept for measuring: crc32 of the id's text divides by 5 (null ids: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
