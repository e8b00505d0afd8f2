"""Distributed ordered primitives.

``Window.orderBy`` without ``partitionBy`` — or a window partitioned by a key
that holds a third of all rows — runs in one task. Everything ordered in this
engine (running sums, ranks, exact quantiles, global row positions) goes
through :func:`running_sum`, which

1. range-partitions the rows on ``(group, order)`` (Spark samples the bounds,
   so a hot group is spread over many partitions),
2. tags each row with its partition id and writes a *reliable* checkpoint
   (pins bounds and membership; survives executor loss; no local checkpoint),
3. sums each ``(partition, group)`` slice — a table whose size is bounded by
   ``#partitions + #groups`` — and turns it into carry-ins with a window
   partitioned by group (a group spans at most ``#partitions`` rows there),
4. adds the carry-in to a window partitioned by ``(partition, group)``;
   the join on ``(partition, group)`` shares that window's exchange.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronoframe.operators.scalars import join_null_safe, with_scalars
from chronoframe.session import ensure_checkpoint_dir

__all__ = ["running_sum", "exact_quantiles", "ranked_ties", "global_row_index", "pinned"]

_PID = "_cf_pid"
#: Cells of one narrowing step of :func:`exact_quantiles`.
CELLS = 1000
#: Group tables of at most so many rows are broadcast.
MANY_GROUPS = 10_000


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return int(n)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def pinned(df: DataFrame) -> DataFrame:
    """``df`` as it is planned now: several jobs may read it, and the shuffles below it are made once.

    Nothing is stored beyond the shuffles' own files, which Spark keeps as long
    as the frame is in use (and makes again, with the same range bounds, for a
    lost executor).
    """
    jdf, spark = df._jdf, df.sparkSession
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(jdf.queryExecution().toRdd(), jdf.schema(), False), spark)


def _null_safe_on(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else (cond & e)
    return cond


def running_sum(df: DataFrame, order_cols: Sequence[str], sum_cols: Sequence[str],
                group_cols: Sequence[str] = (), prefix: str = "cum_",
                num_partitions: int | None = None, checkpoint: bool = True,
                totals: bool = False) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in ``order_cols`` order within each group.

    Rows with equal keys are summed in an arbitrary but fixed order; callers
    that need tie groups collapse them first (one row per distinct key).
    With ``totals`` each row also gets ``tot_<col>``, the group total, read off
    the small slice table (no extra pass over the rows).
    Materialises one reliable checkpoint of the (usually pre-aggregated) input.
    """
    group_cols, order_cols, sum_cols = list(group_cols), list(order_cols), list(sum_cols)
    n = _num_partitions(df, num_partitions)
    keys = group_cols + order_cols
    ranged = df.repartitionByRange(n, *[F.col(k).asc_nulls_first() for k in keys]) \
               .withColumn(_PID, F.spark_partition_id())
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        ranged = ranged.checkpoint(eager=True)

    with_totals = totals
    slice_keys = [_PID] + group_cols
    slices = ranged.groupBy(*slice_keys).agg(*[F.sum(c).alias(f"_cf_t_{c}") for c in sum_cols])
    wc = (W.partitionBy(*group_cols) if group_cols else W.partitionBy()) \
        .orderBy(_PID).rowsBetween(W.unboundedPreceding, -1)
    wg = W.partitionBy(*group_cols) if group_cols else W.partitionBy()
    extra = [F.sum(f"_cf_t_{c}").over(wg).alias(f"tot_{c}") for c in sum_cols] if with_totals else []
    carry = slices.select(*slice_keys, *[
        F.coalesce(F.sum(f"_cf_t_{c}").over(wc), F.lit(0)).alias(f"_cf_c_{c}") for c in sum_cols], *extra)

    joined = ranged.join(carry, on=_null_safe_on(ranged, carry, slice_keys), how="inner") \
                   .select(ranged["*"], *[carry[f"_cf_c_{c}"] for c in sum_cols],
                           *[carry[f"tot_{c}"] for c in sum_cols if with_totals])
    wl = W.partitionBy(*slice_keys).orderBy(*order_cols).rowsBetween(W.unboundedPreceding, 0)
    out = joined
    for c in sum_cols:
        out = out.withColumn(f"{prefix}{c}", F.sum(c).over(wl) + F.col(f"_cf_c_{c}"))
    return out.drop(_PID, *[f"_cf_c_{c}" for c in sum_cols])


def ranked_ties(df: DataFrame, value_col: str, weight_cols: Sequence[str] = (),
                group_cols: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """Collapse to distinct ``(group, value)`` and attach tie-aware ranks.

    Output columns: group cols, ``value_col``, ``n`` (rows with that value),
    the summed ``weight_cols``, ``rank_lo`` (rows strictly below, 0-based),
    ``avg_rank`` (1-based average rank of the tie group, as scipy ``rankdata``)
    and ``n_total`` (non-NULL rows of the group).
    """
    group_cols = list(group_cols)
    aggs = [F.count(F.lit(1)).alias("n")] + [F.sum(w).alias(w) for w in weight_cols]
    collapsed = df.where(F.col(value_col).isNotNull()).groupBy(*group_cols, value_col).agg(*aggs)
    r = running_sum(collapsed, [value_col], ["n"], group_cols, num_partitions=num_partitions, totals=True)
    return (r.withColumn("rank_lo", F.col("cum_n") - F.col("n"))
             .withColumn("avg_rank", F.col("rank_lo") + (F.col("n") + F.lit(1)) / F.lit(2.0))
             .withColumnRenamed("tot_n", "n_total")
             .drop("cum_n"))


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), names: Sequence[str] | None = None,
                    accuracy: int = 10_000, max_bracket: int = 1_000_000, extra_aggs=None) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy ``linear`` / SQL ``quantile_cont``) per group.

    Bracket and refine — scans with partial aggregation; no group is sorted or
    buffered whole:

    1. one aggregation counts each group and estimates its distinct values; the whole group
       is the first bracket of every probability;
    2. where brackets hold too many distinct values (one more than ``max_bracket``, or few
       groups so many together) they are narrowed: one sketch over all groups' values gives
       :data:`CELLS` cells, one scan counts each group's rows by cell, and the cells around
       the target ranks are the new bracket. Counts are exact, so the sketch only decides
       how small a cell is, and no task holds a sketch per group. Small tables of one row
       per group are checkpointed between levels; brackets that stop shrinking are an error;
    3. the values inside a bracket are collapsed to distinct ``(group, value)`` counts
       (partial aggregation) and ranked by a window partitioned
       by (group, bracket) — about ``max_bracket`` rows per window partition — and the two order statistics around ``(n − 1)·p`` are
       interpolated.

    NULL and NaN values are ignored; an all-NULL group is absent. ``extra_aggs``
    (a callable ``value column -> {name: aggregate}``) adds aggregates computed
    in the same counting pass (e.g. mean / std / min / max for ``describe``).
    """
    g = list(group_cols)
    probs = [float(p) for p in probs]
    names = list(names) if names else [f"q{int(round(p * 100)):02d}" for p in probs]
    k = len(probs)
    base = df.select(*g, F.col(value_col).cast("double").alias("_v")) \
             .where(F.col("_v").isNotNull() & ~F.isnan(F.col("_v")))

    def _agg(frame, aggs):
        return frame.groupBy(*g).agg(*aggs) if g else frame.agg(*aggs)

    def _attach(frame, table):
        return join_null_safe(frame, table, g) if g else with_scalars(frame, table)

    ensure_checkpoint_dir(df.sparkSession)
    extras = dict(extra_aggs(F.col("_v"))) if extra_aggs else {}
    counts = _agg(base, [F.count(F.lit(1)).alias("_n"), F.approx_count_distinct("_v").alias("_d")] + [a.alias(f"_x_{nm}") for nm, a in extras.items()]).checkpoint(eager=True)  # one row per group
    total = counts.agg(F.max("_n"), F.sum("_n"), F.count(F.lit(1)), F.max("_d"), F.sum("_d")).first()
    groups = total[2]
    few = groups <= MANY_GROUPS
    small = (total[0] or 0) <= max_bracket and (not few or (total[1] or 0) <= max_bracket)
    if small:
        counts = counts.withColumn("_d", F.col("_n"))
    cols = [F.col(c) for c in g] + [F.col("_n")] + [F.col(f"_x_{nm}") for nm in extras]
    for i, p in enumerate(probs):
        h = (F.col("_n") - 1) * F.lit(p)
        cols += [F.floor(h).cast("long").alias(f"_klo{i}"), F.ceil(h).cast("long").alias(f"_khi{i}"),
                 (h - F.floor(h)).alias(f"_fr{i}"), F.lit(None).cast("double").alias(f"_lo{i}"),
                 F.lit(None).cast("double").alias(f"_hi{i}"), F.lit(0).cast("long").alias(f"_below{i}"),
                 F.col("_n").alias(f"_size{i}"), F.col("_d").alias(f"_dist{i}")]
    bounds = counts.select(*cols)

    if few:
        def _attach(frame, table):      # a table of few rows: no shuffle of the values, whatever their number
            return join_null_safe(frame, F.broadcast(table), g) if g else with_scalars(frame, table)

    # the groups' distinct values together bound what the last step collapses
    narrow = not small and ((total[3] or 0) > max_bracket or (few and (total[4] or 0) > max_bracket))
    before = None
    while narrow:
        limit = max_bracket if before is not None or not few else 0     # at first every group is narrowed
        bounds = _narrow(base, bounds, g, k, _attach, limit, accuracy).checkpoint(eager=True)
        worst = bounds.agg(*[f(f"_dist{i}") for i in range(k) for f in (F.max, F.sum)]).first()
        if max([x for x in worst[::2] if x is not None], default=0) <= max_bracket:
            before = 0
            break
        # what is still large by its rows may be small by its distinct values
        j = _attach(base, bounds.select(*g, *[f"{c}{i}" for i in range(k) for c in ("_lo", "_hi", "_dist")]))
        stats = _agg(j, [F.approx_count_distinct(F.when(_inside(i) & (F.col(f"_dist{i}") > max_bracket), F.col("_v"))).alias(f"_e{i}") for i in range(k)])
        bounds = _attach(bounds, stats).withColumns({f"_dist{i}": F.when(F.col(f"_dist{i}") > max_bracket, F.least(f"_dist{i}", f"_e{i}"))
                                                     .otherwise(F.col(f"_dist{i}")) for i in range(k)}).drop(*[f"_e{i}" for i in range(k)]).checkpoint(eager=True)
        worst = bounds.agg(*[f(f"_dist{i}") for i in range(k) for f in (F.max, F.sum)]).first()
        left = sum(x or 0 for x in worst[1::2])
        narrow = max(x or 0 for x in worst[::2]) > max_bracket
        if narrow and before is not None and left >= before:
            raise RuntimeError("quantile brackets do not narrow any more")
        before = left

    # collapse to distinct values once; rank each distinct bracket once (probabilities whose
    # brackets coincide — e.g. the whole group — share one ranking); a window partition holds
    # at most max_bracket rows
    inf = float("inf")

    def _edge(i, side):
        c = F.col(f"_{side}{i}")
        return F.coalesce(c, F.lit(-inf if side == "lo" else inf))

    if before is None:      # never narrowed: every bracket is its whole group, rows collapse where they are read
        coll = base.groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c")).withColumns({"_blo": F.lit(-inf), "_bhi": F.lit(inf)})
    else:
        bounded = bounds.select(*g, *[c for i in range(k) for c in (f"_lo{i}", f"_hi{i}")])
        # only values inside some bracket are grouped: the bracket test stands below the aggregate
        near = _attach(base, bounded).where(reduce(or_, [_inside(i) for i in range(k)]))
        distinct = near.groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c"))
        j = _attach(distinct, bounded)
        brackets = F.array_compact(F.array_distinct(F.array(*[
            F.when(_inside(i), F.struct(_edge(i, "lo").alias("_blo"), _edge(i, "hi").alias("_bhi"))) for i in range(k)])))
        coll = j.select(*g, "_v", "_c", F.explode(brackets).alias("_b")).select(*g, "_v", "_c", "_b.*")
    w = W.partitionBy(*g, "_blo", "_bhi").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    coll = coll.withColumn("_cum", F.sum("_c").over(w))
    tgt = bounds.select(*g, F.explode(F.array(*[F.struct(
        F.lit(i).alias("_i"), _edge(i, "lo").alias("_blo"), _edge(i, "hi").alias("_bhi"),
        (F.col(f"_klo{i}") - F.col(f"_below{i}")).alias("_rlo"),
        (F.col(f"_khi{i}") - F.col(f"_below{i}")).alias("_rhi"), F.col(f"_fr{i}").alias("_fr"))
        for i in range(k)])).alias("_t")).select(*g, "_t.*")
    m = join_null_safe(coll, tgt, g + ["_blo", "_bhi"])
    prev = F.col("_cum") - F.col("_c")
    picked = m.groupBy(*g, "_i").agg(
        F.max(F.when((prev <= F.col("_rlo")) & (F.col("_rlo") < F.col("_cum")), F.col("_v"))).alias("_vlo"),
        F.max(F.when((prev <= F.col("_rhi")) & (F.col("_rhi") < F.col("_cum")), F.col("_v"))).alias("_vhi"),
        F.max("_fr").alias("_fr"))
    val = F.when(F.col("_vlo").isNull() | F.col("_vhi").isNull(), F.raise_error(F.lit("a target rank lies outside its bracket"))) \
        .otherwise(F.col("_vlo") + F.col("_fr") * (F.col("_vhi") - F.col("_vlo")))
    outs = [F.max(F.when(F.col("_i") == i, val)).alias(nm) for i, nm in enumerate(names)]
    res = picked.groupBy(*g).agg(*outs) if g else picked.agg(*outs)
    if not extras:
        return res
    ex = bounds.select(*g, *[F.col(f"_x_{nm}").alias(nm) for nm in extras])  # one row per group
    return _attach(res, ex)


def _inside(i):
    lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
    return (lo.isNull() | (F.col("_v") >= lo)) & (hi.isNull() | (F.col("_v") < hi))


def _narrow(base: DataFrame, bounds: DataFrame, g: list, k: int, attach, limit: int, accuracy: int) -> DataFrame:
    """Each bracket of more than ``limit`` distinct values becomes the cells around its target ranks.

    One sketch of all values in such brackets, of whatever group, gives the
    cell borders; one scan counts each bracket's rows by cell. The counts are
    exact, so the new bracket needs no margin: it runs from the cell of the
    lower rank to that of the upper one.
    """
    wide = [F.when(_inside(i) & (F.col(f"_dist{i}") > limit), F.lit(i)) for i in range(k)]
    j = attach(base, bounds.select(*g, *[f"{c}{i}" for i in range(k) for c in ("_lo", "_hi", "_dist")]))
    if limit:
        rows = j.select(*g, "_v", F.explode(F.array_compact(F.array(*wide))).alias("_i"))
    else:       # whole groups: one count serves every probability
        rows = base.withColumn("_i", F.lit(0))
    points = rows.agg(F.percentile_approx("_v", [c / CELLS for c in range(1, CELLS)], accuracy).alias("p")).first()["p"]
    borders = sorted({float(x) for x in points if abs(x) != math.inf}) or [0.0]      # fewer numbers than CELLS
    cells = Bucketizer(splits=[-math.inf, *borders, math.inf], inputCol="_v", outputCol="_cell").transform(rows.withColumn("_v", F.col("_v") + 0.0)) \
        .groupBy(*g, "_i", "_cell").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    w = W.partitionBy(*g, "_i").orderBy("_cell").rowsBetween(W.unboundedPreceding, 0)
    cells = cells.withColumn("_cum", F.sum("_c").over(w))
    if not limit:
        cells = cells.drop("_i").withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    targets = bounds.select(*g, F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), *[F.col(f"{c}{i}").alias(c) for c in ("_klo", "_khi", "_below")])
                                                    for i in range(k)])).alias("_t")).select(*g, "_t.*")
    m = join_null_safe(cells, targets, [*g, "_i"])
    upto = F.col("_below") + F.col("_cum")
    # the cells that hold the ranks from the lower to the upper one
    held = m.where((upto > F.col("_klo")) & (upto - F.col("_c") <= F.col("_khi")))
    edges = F.array(*[F.lit(None).cast("double"), *map(F.lit, borders), F.lit(None).cast("double")])
    first, last = F.min("_cell").cast("int"), F.max("_cell").cast("int")
    new = held.groupBy(*g, "_i").agg(F.get(edges, first).alias("lo"), F.get(edges, last + 1).alias("hi"), F.min(upto - F.col("_c")).alias("below"),
                                     F.sum("_c").alias("size"), F.when(F.min("_min") == F.max("_max"), 1).otherwise(F.sum("_c")).alias("dist"))
    piv = new.groupBy(*g) if g else new.groupBy()
    piv = piv.agg(*[F.max(F.when(F.col("_i") == i, F.struct("lo", "hi", "below", "size", "dist"))).alias(f"_w{i}") for i in range(k)])
    out = join_null_safe(bounds, piv, g, "left") if g else with_scalars(bounds, piv)
    upd = {}
    for i in range(k):
        got = F.col(f"_w{i}").isNotNull()
        # an open side of the cells is the old bracket's side
        upd[f"_lo{i}"] = F.when(got, F.coalesce(f"_w{i}.lo", f"_lo{i}")).otherwise(F.col(f"_lo{i}"))
        upd[f"_hi{i}"] = F.when(got, F.coalesce(f"_w{i}.hi", f"_hi{i}")).otherwise(F.col(f"_hi{i}"))
        for c in ("below", "size", "dist"):
            upd[f"_{c}{i}"] = F.when(got, F.col(f"_w{i}.{c}")).otherwise(F.col(f"_{c}{i}")).cast("long")
    return out.withColumns(upd).drop(*[f"_w{i}" for i in range(k)])


def global_row_index(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
                     out: str = "row_idx", num_partitions: int | None = None) -> DataFrame:
    """0-based position of every row in ``order_cols`` order (per group), without a single-task window.

    ``order_cols`` must identify rows uniquely within a group for a
    deterministic result.
    """
    one = df.withColumn("_cf_one", F.lit(1))
    r = running_sum(one, order_cols, ["_cf_one"], group_cols, num_partitions=num_partitions)
    return r.withColumn(out, (F.col("cum__cf_one") - 1).cast("long")).drop("_cf_one", "cum__cf_one")
