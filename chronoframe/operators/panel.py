"""Panel window operators (W2–W6, W8–W10, W14) keyed by (entity, order).

Two physical layouts compute the same result:

``layout="entity"``
    one window stage partitioned by entity — one shuffle; one task per entity.
``layout="chunked"``
    for entities that hold a large share of all rows. Rows get a dense
    per-entity position (sampled range partitions with offsets, one reliable
    checkpoint), are cut into fixed chunks of ``chunk_rows`` positions and each
    chunk is given a *halo* of the ``halo`` preceding rows, so positional lags
    and rolling frames are exact. Forward/backward fill gets carry-in values
    from the neighbouring chunks through a small per-chunk summary. The largest
    window task holds ``chunk_rows + halo`` rows whatever the entity skew.
    With ``rolling="blocks"`` the chunks are cut where the sorted range
    partitions stand (:func:`_features_ranged`): the rows are dealt once and
    not stored, only the rows and values that cross a partition's border are.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import DoubleType, StructField, StructType

from chronoframe.config import FeatureSpec, PanelSpec
from chronoframe.operators.ordered import global_row_index, pinned
from chronoframe.operators.scalars import join_null_safe

__all__ = [
    "feature_names", "lag_rolling_columns", "panel_positions", "panel_features",
    "next_value_target", "latest_per_entity", "last_n_per_entity", "first_n_per_entity",
]

_POS, _CHUNK, _HALO, _PART = "_cf_pos", "_cf_chunk", "_cf_halo", "_cf_part"


def feature_names(fs: FeatureSpec) -> list[str]:
    names = []
    for v in fs.variables:
        names += [f"{v}_lag_{k}{fs.lag_suffix}" for k in fs.lags]
    for v in fs.variables:
        for wn in fs.windows:
            names += [f"{v}_roll_{wn}_mean", f"{v}_roll_{wn}_std"]
    return names


def lag_rolling_columns(w, fs: FeatureSpec, src: dict[str, Column] | None = None) -> dict[str, Column]:
    """W3–W5 over one window spec: lags, rolling mean and sample std (min_periods=1)."""
    src = src or {}
    cols: dict[str, Column] = {}
    for v in fs.variables:
        c = src.get(v, F.col(v))
        for k in fs.lags:
            cols[f"{v}_lag_{k}{fs.lag_suffix}"] = F.lag(c, k).over(w)
    for v in fs.variables:
        c = src.get(v, F.col(v))
        for wn, n in fs.windows.items():
            frame = w.rowsBetween(-(n - 1), 0)
            cols[f"{v}_roll_{wn}_mean"] = F.avg(c).over(frame)
            cols[f"{v}_roll_{wn}_std"] = F.stddev_samp(c).over(frame)
    return cols


def with_lag_rolling(df: DataFrame, w, fs: FeatureSpec, method: str = "frame") -> DataFrame:
    """W3–W5 over one window spec, appended to ``df``.

    ``method='frame'`` (default) evaluates each rolling frame directly — exact,
    but Spark re-aggregates a sliding ROWS frame for every row: O(n·w).
    ``method='blocks'`` merges windows from smaller blocks in Arrow batches
    (:func:`_lag_rolling_blocks`).
    """
    if method == "frame":
        return df.withColumns(lag_rolling_columns(w, fs))
    if method == "blocks":
        return _lag_rolling_blocks(df, w, fs)
    raise ValueError(method)


#: Types whose windows :func:`_lag_rolling_blocks` takes in Arrow batches; other types use frames.
_BATCHED = ("double", "float", "bigint", "int", "smallint", "tinyint")
_AT = "_cf_at_row"


def _lag_rolling_blocks(df: DataFrame, w, fs: FeatureSpec) -> DataFrame:
    """W3-W5 over the sorted rows of ``w`` in Arrow batches.

    The window numbers the rows and leaves them clustered and in order; each
    batch is computed whole, with the largest lag or window of rows carried over
    from the batch before, so this step holds one batch whatever the size of an
    entity. A window is merged from blocks of rows (count, mean, M2) with the
    parallel-variance formula (Chan et al.); nothing is differenced.
    """
    kind = dict(df.dtypes)
    if any(kind[v] not in _BATCHED for v in fs.variables):
        return df.withColumns(lag_rolling_columns(w, fs))
    rows = df.withColumn(_AT, F.row_number().over(w))
    names = df.columns
    places = [names.index(v) for v in fs.variables]
    lags, windows, halo = tuple(fs.lags), tuple(fs.windows.values()), fs.halo
    fields = list(df.schema.fields)
    fields += [StructField(f"{v}_lag_{k}{fs.lag_suffix}", df.schema[v].dataType) for v in fs.variables for k in fs.lags]
    fields += [StructField(f"{v}_roll_{wn}_{s}", DoubleType()) for v in fs.variables for wn in fs.windows for s in ("mean", "std")]
    out_names = [f.name for f in fields]

    def run(batches):
        tail, tail_at = None, np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            new_at = batch.column(len(names)).to_numpy().astype(np.int64)
            cols = [batch.column(i) for i in places]
            if tail is not None:
                cols = [pa.concat_arrays([t, c]) for t, c in zip(tail, cols)]
            at = np.concatenate([tail_at, new_at])
            if not ((at[1:] == at[:-1] + 1) | (at[1:] == 1)).all():
                raise ValueError("rows are not in the order of their window")
            out = list(batch.columns[:len(names)]) + _lagged_and_rolled(cols, at, len(tail_at), lags, windows)
            yield pa.RecordBatch.from_arrays(out, names=out_names)
            keep = min(halo, len(at))
            tail, tail_at = [c.slice(len(at) - keep) for c in cols], at[len(at) - keep:]

    return rows.mapInArrow(run, StructType(fields))


def _lagged_and_rolled(cols, at, old, lags, windows) -> list:
    """Lags and window statistics of the rows after the first ``old`` ones, which are only looked back at."""
    out, new_at, here = [], at[old:], np.arange(old, len(at))
    for c in cols:
        for k in lags:
            out.append(c.take(pa.array(np.maximum(here - k, 0), mask=new_at <= k)))
    rolled = rolling_stats(cols, at, windows)
    for v in range(len(cols)):
        for n, mean, std in rolled:
            count = n[v, old:]
            out += [pa.array(mean[v, old:], mask=count < 1), pa.array(std[v, old:], mask=count < 2)]
    return out


def rolling_stats(cols, at, windows) -> list[tuple]:
    """``(count, mean, sample std)`` of each trailing window for the columns of one batch; ``at`` is a row's number in its entity, from 1.

    A window of n rows is merged from the blocks of its largest divisor, down to
    single rows. Means are taken from the differences to the row's own value (a
    constant run has no variance), squares around the mean.
    """
    size = len(at)
    present = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in cols])
    x = np.stack([c.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False) for c in cols])
    finite = np.isfinite(x).all()
    own = x if finite else np.where(np.isfinite(x), x, 0.0)
    blocks = {1: (present.astype(float), x, np.zeros(x.shape))}

    def block(n):
        if n in blocks:
            return blocks[n]
        b = next(n // p for p in range(2, n + 1) if n % p == 0)
        count, mean, squares = block(b)
        parts = []
        for off in range(0, min(n, size), b):
            ok, end = at[off:] > off, size - off
            c, m, q = count[:, :end] * ok, mean[:, :end], squares[:, :end]
            if finite:
                q = q * ok
            else:           # a zero weight does not cancel what is not finite
                m, q = np.where(c > 0, m, own[:, off:]), np.where(c > 0, q, 0.0)
            parts.append((off, c, m, q))
        whole, total, spread = np.zeros(x.shape), np.zeros(x.shape), np.zeros(x.shape)
        for off, c, m, _ in parts:
            whole[:, off:] += c
            total[:, off:] += c * (m - own[:, off:])
        centre = own + total / np.maximum(whole, 1)
        for off, c, m, q in parts:
            d = m - centre[:, off:] if finite else np.where(c > 0, m - centre[:, off:], 0.0)
            spread[:, off:] += q + c * d * d
        blocks[n] = whole, centre, spread
        return blocks[n]

    with np.errstate(invalid="ignore", over="ignore"):
        stats = [block(n) for n in windows]
        return [(count, mean, np.sqrt(squares / np.maximum(count - 1, 1))) for count, mean, squares in stats]


def panel_positions(df: DataFrame, spec: PanelSpec, dedup_ordinal: str | None = None) -> DataFrame:
    """Dense 0-based position of each row within its entity, in (order, tiebreak) order.

    Rows are numbered by sampled range partitions on (entity, order, tiebreak)
    with the row counts of earlier slices as offsets, so no entity, day or key
    has to fit in one task; a NULL entity is an entity, rows with NULL time
    come first. With ``dedup_ordinal`` only the first row (lowest ordinal) of
    each ``(entity, order)`` is kept (W1); rows with NULL time are all kept.
    """
    return global_row_index(_first_rows(df, spec, dedup_ordinal), spec.order_cols, [spec.entity], out=_POS)


def _first_rows(df: DataFrame, spec: PanelSpec, dedup_ordinal: str | None) -> DataFrame:
    if not dedup_ordinal:
        return df
    first = W.partitionBy(spec.entity, spec.order).orderBy(dedup_ordinal)
    return df.withColumn("_cf_first", F.row_number().over(first)) \
             .where((F.col("_cf_first") == 1) | F.col(spec.order).isNull()).drop("_cf_first")


def panel_features(df: DataFrame, spec: PanelSpec, fs: FeatureSpec | None = None,
                   fill_cols: Sequence[str] = (), dedup_ordinal: str | None = None,
                   layout: str = "entity", chunk_rows: int = 1_000_000, leads: dict[str, tuple[str, int]] | None = None,
                   windows: dict[str, tuple[str, int]] | None = None, rolling: str = "frame") -> DataFrame:
    """Clean + positional features in as few shuffles as possible.

    * ``dedup_ordinal``: keep the first row per (entity, order) by this ordinal (W1);
    * ``fill_cols``: forward- then backward-fill per entity (W2);
    * ``fs``: lags and rolling mean/std over the filled values (W3–W5);
    * ``leads``: ``{out: (col, k)}`` value k rows ahead (W6);
    * ``windows``: ``{out: (col, n)}`` extra trailing n-row means (moving-average predictors).
    ``layout``: ``'entity'`` or ``'chunked'`` — the caller's choice, one answer;
    ``rolling``: ``'frame'`` (exact frames, O(n·w)) or ``'blocks'`` (windows merged from smaller
    window blocks) — see :func:`with_lag_rolling`.
    Rows keep their input columns; feature columns are appended.
    """
    leads, windows = dict(leads or {}), dict(windows or {})
    if layout == "entity":
        return _features_entity(df, spec, fs, fill_cols, dedup_ordinal, leads, windows, rolling)
    if layout == "chunked":
        return _features_chunked(df, spec, fs, fill_cols, dedup_ordinal, chunk_rows, leads, windows, rolling)
    raise ValueError(f"unknown layout {layout!r}")


def _extra_columns(w, leads, windows) -> dict[str, Column]:
    cols = {n: F.lead(c, k).over(w) for n, (c, k) in leads.items()}
    cols.update({n: F.avg(c).over(w.rowsBetween(-(k - 1), 0)) for n, (c, k) in windows.items()})
    return cols


def _ffill_bfill(c: str, w, carry_fwd: str | None = None, carry_back: str | None = None) -> Column:
    """Forward fill, then backward fill of what is left.

    After the forward fill only the rows *before the first non-NULL* are still
    NULL, and their backward-filled value is that first non-NULL — the first
    non-NULL of the whole frame. A whole-partition frame is evaluated once per
    partition (O(n)); a ``CURRENT ROW .. UNBOUNDED FOLLOWING`` frame would be
    re-aggregated for every row (O(n²)).
    """
    ff = F.last(c, True).over(w.rowsBetween(W.unboundedPreceding, 0))
    first_nn = F.first(c, True).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    parts = [ff] + ([F.col(carry_fwd)] if carry_fwd else []) + [first_nn] + ([F.col(carry_back)] if carry_back else [])
    return F.coalesce(*parts)


def _features_entity(df, spec, fs, fill_cols, dedup_ordinal, leads, windows, rolling="frame"):
    o, t = spec.entity, spec.order
    ordcols = spec.order_cols
    if dedup_ordinal:
        wd = W.partitionBy(o).orderBy(t, dedup_ordinal)
        df = df.withColumn("_cf_prev_t", F.lag(t, 1).over(wd)) \
               .where(F.col("_cf_prev_t").isNull() | (F.col("_cf_prev_t") != F.col(t))).drop("_cf_prev_t")
    w = W.partitionBy(o).orderBy(*ordcols)
    if fill_cols:
        df = df.withColumns({c: _ffill_bfill(c, w) for c in fill_cols})
    if fs is not None:
        df = with_lag_rolling(df, w, fs, rolling)
    if leads or windows:
        df = df.withColumns(_extra_columns(w, leads, windows))
    return df


def _features_chunked(df, spec, fs, fill_cols, dedup_ordinal, chunk_rows, leads, windows, rolling="frame"):
    o = spec.entity
    halo = max([fs.halo if fs is not None else 0] + [k - 1 for _, k in windows.values()])
    fwd = max([0] + [k for _, k in leads.values()])
    if halo > chunk_rows or fwd > chunk_rows:
        raise ValueError("chunk_rows must be at least the halo (largest lag / lead / window - 1)")
    kind = dict(df.dtypes)
    if rolling == "blocks" and fs is not None and not leads and not windows and kind[o] in _COMPARED and all(kind[v] in _BATCHED for v in fs.variables):
        return _features_ranged(df, spec, fs, fill_cols, dedup_ordinal, chunk_rows)
    cols = df.columns
    p = panel_positions(df, spec, dedup_ordinal).withColumn(
        _CHUNK, F.floor(F.col(_POS) / chunk_rows).cast("long"))

    carry_cols = {}
    if fill_cols:
        # per chunk: last non-NULL overall, last non-NULL before the halo tail, first non-NULL
        pre_end = (F.col(_CHUNK) + 1) * chunk_rows - halo
        aggs = []
        for c in fill_cols:
            nn = F.col(c).isNotNull()
            aggs += [F.max_by(F.col(c), F.when(nn, F.col(_POS))).alias(f"_la_{c}"),
                     F.max_by(F.col(c), F.when(nn & (F.col(_POS) < pre_end), F.col(_POS))).alias(f"_lp_{c}"),
                     F.min_by(F.col(c), F.when(nn, F.col(_POS))).alias(f"_fa_{c}")]
        summ = p.groupBy(o, _CHUNK).agg(*aggs)
        wc = W.partitionBy(o).orderBy(_CHUNK)
        prev = wc.rowsBetween(W.unboundedPreceding, -1)
        nxt = wc.rowsBetween(1, W.unboundedFollowing)
        s1 = summ.select(o, _CHUNK, *[c for f in fill_cols for c in (
            F.col(f"_lp_{f}"), F.last(f"_la_{f}", True).over(prev).alias(f"_pa_{f}"),
            F.first(f"_fa_{f}", True).over(nxt).alias(f"_cb_{f}"))])
        # carry into the window of chunk k (which starts at the halo of chunk k-1)
        s2 = s1.select(o, _CHUNK, *[c for f in fill_cols for c in (
            F.coalesce(F.lag(f"_lp_{f}", 1).over(wc), F.lag(f"_pa_{f}", 1).over(wc)).alias(f"_cf_{f}"),
            F.col(f"_cb_{f}"))])
        carry_cols = {f: (f"_cf_{f}", f"_cb_{f}") for f in fill_cols}
    else:
        s2 = None

    # a row is also sent to the next chunk (backward halo) and / or the previous one (forward halo)
    in_halo = (F.col(_POS) % chunk_rows) >= (chunk_rows - halo) if halo > 0 else F.lit(False)
    in_fwd = ((F.col(_POS) % chunk_rows) < fwd) & (F.col(_CHUNK) > 0) if fwd > 0 else F.lit(False)
    targets = F.array_compact(F.array(F.col(_CHUNK), F.when(in_halo, F.col(_CHUNK) + 1),
                                      F.when(in_fwd, F.col(_CHUNK) - 1)))
    x = p.withColumn("_cf_target", F.explode(targets)) \
         .withColumn(_HALO, F.col("_cf_target") != F.col(_CHUNK)) \
         .drop(_CHUNK).withColumnRenamed("_cf_target", _CHUNK)
    if s2 is not None:
        x = join_null_safe(x, s2, [o, _CHUNK], "left")
    w = W.partitionBy(o, _CHUNK).orderBy(_POS)
    if fill_cols:
        x = x.withColumns({c: _ffill_bfill(c, w, *carry_cols[c]) for c in fill_cols})
    if fs is not None:
        x = with_lag_rolling(x, w, fs, rolling)
    if leads or windows:
        x = x.withColumns(_extra_columns(w, leads, windows))
    feat = (feature_names(fs) if fs is not None else []) + list(leads) + list(windows)
    return x.where(~F.col(_HALO)).select(*cols, *feat)


#: Entity types that :func:`_features_ranged` compares in Arrow; others take positions and windows.
_COMPARED = ("bigint", "int", "smallint", "tinyint", "string", "date", "boolean", "timestamp", "timestamp_ntz")
#: Rows that one step of :func:`_features_ranged` computes at most, whatever ``chunk_rows``.
_STEP_ROWS = 10_000


def _features_ranged(df, spec, fs, fill_cols, dedup_ordinal, chunk_rows) -> DataFrame:
    """Fill, lags and rolling windows of the chunked layout on sorted range partitions.

    One shuffle deals the rows by ``(entity, order, tiebreak)``, so a hot entity
    spans many partitions; it is made once and read twice (:func:`ordered.pinned`).
    The first reading keeps what crosses a partition's border: the last ``halo``
    rows, the fill values known at its end, and those that leading NULLs wait
    for. The driver joins these up from partition to partition (``halo`` rows
    each), and the second reading computes every partition in chunks of
    ``chunk_rows`` rows with the ``halo`` rows before them.
    """
    cols, o = df.columns, spec.entity
    keys = [F.col(c).asc_nulls_first() for c in (o, *spec.order_cols)]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pinned(_first_rows(df, spec, dedup_ordinal).repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn(_PART, F.spark_partition_id()))
    step, halo, fills, variables = min(chunk_rows, max(_STEP_ROWS, fs.halo)), fs.halo, list(dict.fromkeys(fill_cols)), list(fs.variables)
    kept = list(dict.fromkeys([*fills, *variables]))
    lags, rolled = tuple(fs.lags), tuple(fs.windows.values())

    def borders(batches):
        seen = None
        for chunk in _chunks(batches, step):
            part = chunk.column(_PART)[0].as_py()
            seen = seen or _Border(part, fills, kept, halo)
            seen.add(chunk.column(o), {c: chunk.column(c) for c in kept})
        if seen is not None:
            yield pa.RecordBatch.from_arrays([pa.array([seen.part], pa.int32()), pa.array([pickle.dumps(seen)], pa.binary())], names=["part", "border"])

    found = rows.select(*dict.fromkeys([_PART, o, *kept])).mapInArrow(borders, "part int, border binary").collect()
    starts = _joined_up([pickle.loads(r["border"]) for r in sorted(found, key=lambda r: r["part"])])
    fields = [df.schema[c] for c in cols]
    fields += [StructField(f"{v}_lag_{k}{fs.lag_suffix}", df.schema[v].dataType) for v in variables for k in lags]
    fields += [StructField(f"{v}_roll_{wn}_{s}", DoubleType()) for v in variables for wn in fs.windows for s in ("mean", "std")]
    names = [f.name for f in fields]

    def run(batches):
        state = None
        for chunk in _chunks(batches, step):
            if state is None:
                state = starts[chunk.column(_PART)[0].as_py()]
            at, own = state.advance(chunk.column(o), {c: chunk.column(c) for c in kept})
            tail, k = state.tail, len(state.tail_at)
            ready = [pa.concat_arrays([tail[v], own[v]]) if k else own[v] for v in variables]
            at = np.concatenate([state.tail_at, at])
            yield pa.RecordBatch.from_arrays([own.get(c, chunk.column(c)) for c in cols] + _lagged_and_rolled(ready, at, k, lags, rolled), names=names)
            keep = min(halo, len(at))
            state.tail, state.tail_at = {v: c.slice(len(at) - keep) for v, c in zip(variables, ready)}, at[len(at) - keep:]

    return rows.mapInArrow(run, StructType(fields))


def _chunks(batches, size: int):
    """The rows of all batches as tables of ``size`` rows (the last one may have fewer), one piece for each column."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < size:
            continue
        table, at = pa.Table.from_batches(held), 0
        while n - at >= size:
            yield _one_piece(table.slice(at, size))
            at += size
        held, n = table.slice(at).to_batches() if n > at else [], n - at
    if n:
        yield _one_piece(pa.Table.from_batches(held))


def _one_piece(table: pa.Table) -> pa.RecordBatch:
    return table.combine_chunks().to_batches(max_chunksize=table.num_rows)[0]


def _starts(entity, before) -> np.ndarray:
    """True where a row has another entity than the row before it (``before``: the entity before the first one, an array of one, or ``None``)."""
    if len(entity) > 1 or before is not None:
        whole = pa.concat_arrays([before, entity]) if before is not None else entity
        a, b = whole.slice(1), whole.slice(0, len(whole) - 1)
        same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(a.is_null(), b.is_null())).to_numpy(zero_copy_only=False)
        return ~same if before is not None else np.concatenate([[True], ~same])
    return np.ones(len(entity), bool)


def _filled_forward(values, begin, end, carry, ahead):
    """``values`` filled forward, then backward, inside runs of rows that begin and end where stated (``begin`` -1: before these rows).

    ``carry`` is the last value before these rows of the run they continue,
    ``ahead`` the first one after them of the run they leave open (arrays of one, or ``None``).
    """
    if not values.null_count:
        return values
    size = len(values)
    here, there = np.arange(size), values.is_valid().to_numpy(zero_copy_only=False)
    last = np.maximum.accumulate(np.where(there, here, -1))
    following = np.minimum.accumulate(np.where(there, here, size)[::-1])[::-1]
    nothing = pa.nulls(1, values.type)
    source = pa.concat_arrays([values, nothing if carry is None else carry, nothing if ahead is None else ahead, nothing])
    at = np.where(following < end, following, np.where(end == size, size + 1, size + 2))
    if carry is not None:
        at = np.where(begin < 0, size, at)
    at = np.where((last >= begin) & (last >= 0), last, at)
    return source.take(pa.array(at))


class _Border:
    """What one partition's rows mean to the next ones: its first and last entity, the last rows, and the values that fills look for."""

    def __init__(self, part: int, fills: list, kept: list, halo: int):
        self.part, self.fills, self.kept, self.halo = part, fills, kept, halo
        self.first = self.last = None           # entities, as arrays of one
        self.run, self.rows = -1, 0             # number of the last run of rows, and its rows
        self.opening = {}                       # first values of the first run
        self.found = {}                         # first and last values of the last run
        self.newest = {}
        self.waiting = set()                    # columns without a value when a chunk ended inside the last run
        self.ahead = {}                         # (run, column) -> the value that came later
        self.tail = {c: None for c in kept}
        self.before = {}                        # last values before the tail

    def add(self, entity, values: dict) -> None:
        new = _starts(entity, self.last)
        self.first = entity.slice(0, 1) if self.first is None else self.first
        at = np.flatnonzero(new)
        begin = int(at[-1]) if len(at) else 0
        for c in self.fills:                    # the run that these rows continue
            part = values[c].slice(0, int(at[0]) if len(at) else len(entity))
            self._look(c, part)
        if len(at):
            if self.run < 0 and len(at) > 1:    # the first run begins and ends here
                for c in self.fills:
                    part = values[c].slice(0, int(at[1]))
                    if part.null_count < len(part):
                        self.opening[c] = part.drop_null().slice(0, 1)
            self.run += len(at)
            self.rows, self.found, self.newest, self.waiting, self.before = 0, {}, {}, set(), {}
            self.tail = {c: None for c in self.kept}
            for c in self.fills:
                self._look(c, values[c].slice(begin))
        self.rows += len(entity) - begin
        for c in self.kept:
            both = values[c].slice(begin) if self.tail[c] is None else pa.concat_arrays([self.tail[c], values[c].slice(begin)])
            cut = max(len(both) - self.halo, 0)
            if c in self.fills:
                gone = both.slice(0, cut).drop_null()
                if len(gone):
                    self.before[c] = gone.slice(len(gone) - 1)
            self.tail[c] = pa.concat_arrays([both.slice(cut)])
        self.last = pa.concat_arrays([entity.slice(len(entity) - 1)])
        self.waiting |= {c for c in self.fills if c not in self.found}

    def _look(self, c, part) -> None:
        if part.null_count == len(part):
            return
        there = part.drop_null()
        self.newest[c] = there.slice(len(there) - 1)
        if c not in self.found:
            self.found[c] = there.slice(0, 1)
            if c in self.waiting:
                self.ahead[self.run, c] = self.found[c]
            if self.run == 0:
                self.opening[c] = self.found[c]

    def __getstate__(self):                     # slices would carry the arrays they are cut from
        def own(x):
            return pa.concat_arrays([x, x.slice(0, 0)]) if isinstance(x, pa.Array) else {k: own(v) for k, v in x.items()} if isinstance(x, dict) else x
        return {k: own(v) for k, v in self.__dict__.items()}


class _Start:
    """What is known where a partition begins, and then from chunk to chunk."""

    def __init__(self, fills, ahead):
        self.fills, self.ahead = fills, ahead
        self.entity, self.rows, self.newest = None, 0, {}
        self.tail, self.tail_at = {}, np.zeros(0, np.int64)
        self.run = -1

    def advance(self, entity, values: dict) -> tuple[np.ndarray, dict]:
        """The rows' numbers in their entities, from 1, and the columns with their gaps filled."""
        size = len(entity)
        new = _starts(entity, self.entity)
        if self.run < 0 and not new[0]:
            self.run = 0
        here, at = np.arange(size), np.flatnonzero(new)
        begin = np.maximum.accumulate(np.where(new, here, -1))
        end = np.concatenate([at, [size]])[np.searchsorted(at, here, side="right")]
        number = np.where(begin >= 0, here - begin + 1, here + 1 + self.rows)
        self.run += len(at)
        out = dict(values)
        for c in self.fills:
            v = values[c]
            out[c] = _filled_forward(v, begin, end, self.newest.get(c), self.ahead.get((self.run, c)))
            there = v.slice(max(int(begin[-1]), 0)).drop_null()
            if len(there):
                self.newest[c] = there.slice(len(there) - 1)
            elif begin[-1] >= 0:
                self.newest.pop(c, None)
        self.entity, self.rows = entity.slice(size - 1), int(number[-1])
        return number, out


def _joined_up(borders: list[_Border]) -> dict[int, _Start]:
    """The partitions' borders, in their order, as what each partition starts from."""
    def equal(a, b):
        return not _starts(b, a)[0]

    later, after = {}, None                     # for each partition: the first values that its last run finds in later ones
    for b in reversed(borders):
        later[b.part] = {}
        if after is not None and equal(b.last, after.first):
            more = later[after.part] if after.run == 0 else {}
            later[b.part] = {c: after.opening.get(c, more.get(c)) for c in b.fills}
        after = b
    out, before = {}, None
    for b in borders:
        s = _Start(b.fills, dict(b.ahead))
        more = later[b.part]
        s.ahead.update({(b.run, c): more[c] for c in b.fills if c not in b.found and more.get(c) is not None})
        if before is not None and equal(before.entity, b.first):
            s.entity, s.rows, s.newest, s.tail, s.tail_at = before.entity, before.rows, dict(before.newest), before.tail, before.tail_at
        out[b.part] = s
        follows = s.entity is not None and b.run == 0
        n = len(next(iter(b.tail.values())))
        end = _Start(b.fills, {})
        end.entity, end.rows = b.last, b.rows + (s.rows if follows else 0)
        end.newest = {**(s.newest if follows else {}), **b.newest}
        tail, run = {}, (np.full(n, -1), np.full(n, n))
        for c, x in b.tail.items():
            if c in b.fills:
                carry = b.before.get(c, s.newest.get(c) if follows else None)
                x = _filled_forward(x, *run, carry, more.get(c))
            if follows and len(s.tail_at):
                x = pa.concat_arrays([s.tail[c], x])
                x = x.slice(max(len(x) - b.halo, 0))
            tail[c] = x
        k = len(next(iter(tail.values())))
        end.tail, end.tail_at = tail, np.arange(end.rows - k + 1, end.rows + 1)
        before = end
    return out


def next_value_target(df: DataFrame, spec: PanelSpec, value: str, out: str,
                      extra_partition: Sequence[str] = (), offset: int = 1, layout: str = "entity",
                      chunk_rows: int = 1_000_000) -> DataFrame:
    """Value of the next row of the same entity (and split, for parity).

    ``layout='chunked'`` uses the forward halo of :func:`panel_features`, so a
    hot entity is spread over many tasks.
    """
    if layout == "chunked":
        ent = spec.entity
        if extra_partition:
            df = df.withColumn("_cf_ent", F.struct(spec.entity, *extra_partition))
            ent = "_cf_ent"
        s = PanelSpec(ent, spec.order, spec.tiebreak)
        r = panel_features(df, s, layout=layout, chunk_rows=chunk_rows, leads={out: (value, offset)})
        return r.drop("_cf_ent") if extra_partition else r
    w = W.partitionBy(spec.entity, *extra_partition).orderBy(*spec.order_cols)
    return df.withColumn(out, F.lead(value, offset).over(w))


def latest_per_entity(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """The latest row of every entity as an aggregate (partial per map task)."""
    payload = [c for c in df.columns if c != spec.entity]
    best = F.max_by(F.struct(*payload), F.struct(*[F.col(c) for c in spec.order_cols]))
    return df.groupBy(spec.entity).agg(best.alias("_r")).select(spec.entity, "_r.*")


def last_n_per_entity(df: DataFrame, spec: PanelSpec, n: int) -> DataFrame:
    """The last ``n`` rows of each entity, returned in time order with ``rn`` 1..n (newest = n).

    ``n`` is the feature (a bounded display window), so a per-entity top-n
    window is fine: Spark keeps only n rows per key in the sort (rank limit).
    """
    w = W.partitionBy(spec.entity).orderBy(*[F.col(c).desc() for c in spec.order_cols])
    r = df.withColumn("_cf_rd", F.row_number().over(w)).where(F.col("_cf_rd") <= n)
    return r.withColumn("rn", (F.lit(n + 1) - F.col("_cf_rd")).cast("int")).drop("_cf_rd")


def first_n_per_entity(df: DataFrame, spec: PanelSpec, n: int) -> DataFrame:
    """The first ``n`` rows of each entity with ``rn`` 1..n."""
    w = W.partitionBy(spec.entity).orderBy(*spec.order_cols)
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
