"""Running totals and row numbers over a GLOBAL order, without one-task windows.

``Window.orderBy(...)`` with no partition puts every row in one task. The
helpers here instead:

1. range-partition the rows on the order keys (``repartitionByRange``: the
   boundaries come from a sample, so partitions are balanced even when one
   value holds many rows, because the order keys are made unique),
2. tag each row with its partition id and cut the lineage with a reliable
   ``checkpoint()`` (to ``spark.checkpoint.dir``), so a lost executor cannot
   re-sample different boundaries and disagree with already computed offsets,
3. total each partition (one row per partition), turn the totals into
   exclusive offsets with a window over that tiny table, and
4. add the broadcast offset of its partition to each row's position inside
   its partition. Row numbers read that position from the sorted stage
   itself (no further shuffle); general running sums use a window within
   each range partition.

With ``group_cols`` the totals restart per group (e.g. per column in the KS
test): the global order is (group, keys) and each group's own offset is
subtracted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import with_scalars
from ..functions.sizing import bounded_broadcast
from ..session import ensure_checkpoint_dir


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _join_small(big: DataFrame, small: DataFrame, keys: list[str], grouped: bool) -> DataFrame:
    """``big`` joined with a per-partition / per-group table on ``keys``,
    null-safe (a null group is a group like any other), keys kept once.

    Without groups the small table has one row per partition and is
    broadcast. With groups it has at most (groups + partitions) rows, since
    each group covers a contiguous run of range partitions; it is broadcast
    after its size is measured (``bounded_broadcast``), else shuffle-joined.
    """
    if not keys:
        return with_scalars(big, small)        # one row: a scalar subquery
    renamed = small.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                           *[c for c in small.columns if c not in keys])
    # derived from the checkpointed rows: measured without another checkpoint
    renamed = bounded_broadcast(renamed, checkpoint=False) if grouped else F.broadcast(renamed)
    cond = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return big.join(renamed, cond).drop(*[f"_k_{k}" for k in keys])


def prefix_sums_with_totals(df: DataFrame, order_cols: list[str], sum_cols: list[str],
                            group_cols: list[str] | None = None, num_partitions: int | None = None,
                            prefix: str = "cum_", max_cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Running sums (and maxima) as in ``prefix_sums`` plus the per-group totals.

    The totals (``*group_cols, tot_<c>``) come from the per-partition totals
    of the checkpointed rows, a table of (partitions x groups) rows, so
    callers never re-aggregate ``df`` (which would recompute its lineage).
    """
    group_cols = list(group_cols or [])
    keys = group_cols + list(order_cols)
    n = _num_partitions(df, num_partitions)
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                .withColumn("_pid", F.spark_partition_id()))
    ranged = ranged.checkpoint(eager=True)

    # per (partition, group) totals -> exclusive offsets (tiny tables)
    tot_keys = ["_pid"] + group_cols
    max_cols = list(max_cols or [])
    totals = ranged.groupBy(*tot_keys).agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols], *[F.max(c).alias(f"_t_{c}") for c in max_cols])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    if group_cols:
        before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*tot_keys, *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0))
                                         .alias(f"_o_{c}") for c in sum_cols],
                             *[F.max(f"_t_{c}").over(before).alias(f"_o_{c}") for c in max_cols])
    tot_aggs = [F.sum(f"_t_{c}").alias(f"tot_{c}") for c in sum_cols]
    group_totals = totals.groupBy(*group_cols).agg(*tot_aggs) if group_cols else totals.agg(*tot_aggs)

    # the local running sum restarts per partition and, with groups, per group
    # (rows of another group earlier in the same partition must not count)
    local = (Window.partitionBy("_pid", *group_cols).orderBy(*keys)
                   .rowsBetween(Window.unboundedPreceding, 0))
    out = ranged.select("*", *[F.sum(c).over(local).alias(f"_l_{c}") for c in sum_cols], *[F.max(c).over(local).alias(f"_l_{c}") for c in max_cols])
    out = _join_small(out, offsets, tot_keys, bool(group_cols))
    cum = out.select(*[F.col(c) for c in df.columns],
                     *[(F.col(f"_l_{c}") + F.col(f"_o_{c}")).alias(f"{prefix}{c}") for c in sum_cols],
                     *[F.greatest(f"_l_{c}", f"_o_{c}").alias(f"{prefix}{c}") for c in max_cols])  # nulls don't count
    return cum, group_totals


def prefix_sums(df: DataFrame, order_cols: list[str], sum_cols: list[str],
                group_cols: list[str] | None = None, num_partitions: int | None = None,
                prefix: str = "cum_", max_cols: list[str] | None = None) -> DataFrame:
    """Add ``cum_<c>`` = inclusive running sum (``max_cols``: maximum, without nulls) of ``c`` in (group, order) order.

    The order keys (with the group keys) must be unique per row.
    """
    return prefix_sums_with_totals(df, order_cols, sum_cols, group_cols, num_partitions, prefix, max_cols)[0]


# low 33 bits of monotonically_increasing_id(): the row's index in its partition
_LOCAL_INDEX_MASK = (1 << 33) - 1


def global_row_number(df: DataFrame, order_cols: list[str], alias: str = "rn",
                      group_cols: list[str] | None = None,
                      num_partitions: int | None = None, total_alias: str | None = None) -> DataFrame:
    """1-based row number over (group, order); order keys must be unique.

    Rows are range-partitioned and sorted on (group, order) once; in that
    sorted stage ``monotonically_increasing_id`` numbers the rows of each
    partition 0, 1, 2, ... in order, so no window (and no second shuffle)
    is needed: row number = local index - local index of the group's first
    row in the partition + rows of the group in earlier partitions + 1. The
    numbered rows are checkpointed, so a retried task reads the same numbers
    (the order keys are unique, so a recomputed sort gives them again).
    With ``total_alias`` every row also gets its group's row count.
    """
    g = list(group_cols or [])
    keys = g + list(order_cols)
    n = _num_partitions(df, num_partitions)
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_li", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_INDEX_MASK))))
    ranged = ranged.checkpoint(eager=True)

    # per (partition, group): row count and first local index (tiny table)
    stats = ranged.groupBy("_pid", *g).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_li").alias("_first"))
    before = (Window.partitionBy(*g) if g else Window).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select("_pid", *g, "_first", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    rn = (F.col("_li") - F.col("_first") + F.col("_off") + 1).alias(alias)
    out = _join_small(ranged, offsets, ["_pid", *g], bool(g)).select(*[F.col(c) for c in df.columns], rn)
    if total_alias is None:
        return out
    tot = F.sum("_cnt").alias(total_alias)
    totals = stats.groupBy(*g).agg(tot) if g else stats.agg(tot)
    # one row per group (few groups by design of the callers)
    return _join_small(out, totals, g, bool(g))


def exact_quantiles(df: DataFrame, col: str, probs: list[float],
                    group_cols: list[str] | None = None,
                    num_partitions: int | None = None, weight: str | None = None) -> DataFrame:
    """Linear-interpolated quantiles (numpy's default) of ``col``, exactly.

    Work is linear: values are counted per distinct value (per group), the
    counts get running totals, and each requested rank is found by joining
    the probe table (groups x probs rows) against the value ranges. Without
    groups one aggregate picks the values at the ranks; with groups the probe
    table's size depends on the data, so it is broadcast only after its rows
    and bytes are measured (``bounded_broadcast``), else equi-joined on the
    group keys. Either way no group's values are ever gathered in one task:
    a hot group only adds rows to the range-partitioned running totals.
    ``weight`` names a column that says how often a row counts. Returns rows
    (*groups, p, quantile).
    """
    g = list(group_cols or [])
    counts = (df.where(F.col(col).isNotNull())
                .groupBy(*g, F.col(col).cast("double").alias("v"))
                .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("c")))
    cum, totals = prefix_sums_with_totals(counts, ["v"], ["c"], group_cols=g, num_partitions=num_partitions)
    ranges = cum.select(*g, "v", (F.col("cum_c") - F.col("c")).alias("lo"), F.col("cum_c").alias("hi"))
    if not g:
        return _quantiles_of_all(ranges, totals, probs)
    probe_p = F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p")
    probes = (totals.where(F.col("tot_c") > 0).select(*g, "tot_c", probe_p)
                    .select(*g, "p", (F.col("p") * (F.col("tot_c") - 1)).alias("h"))
                    .select(*g, "p", "h", F.floor("h").cast("long").alias("j"))
                    .select(*g, "p", "h", "j", (F.col("j") + 1).alias("j1")))
    pa = bounded_broadcast(probes, checkpoint=False).alias("pa")

    # ONE pass over the value ranges: a range holding rank j gives the lower
    # value a, the one holding rank j + 1 the upper value b (b is missing
    # when j is the last rank).
    in_j = (F.col("pa.j") >= F.col("r.lo")) & (F.col("pa.j") < F.col("r.hi"))
    in_j1 = (F.col("pa.j1") >= F.col("r.lo")) & (F.col("pa.j1") < F.col("r.hi"))
    cond = in_j | in_j1
    for k in g:
        cond = cond & F.col(f"pa.{k}").eqNullSafe(F.col(f"r.{k}"))
    hits = ranges.alias("r").join(pa, cond).select(
        *[F.col(f"pa.{k}").alias(k) for k in g], F.col("pa.p").alias("p"), F.col("pa.h").alias("h"),
        F.col("pa.j").alias("j"), F.when(in_j, F.col("r.v")).alias("_a"), F.when(in_j1, F.col("r.v")).alias("_b"))
    picked = hits.groupBy(*g, "p").agg(F.max("h").alias("h"), F.max("j").alias("j"),
                                       F.max("_a").alias("a"), F.max("_b").alias("b"))
    return picked.select(*g, "p", _between("a", "b", F.col("h") - F.col("j")).alias("quantile"))


def _between(low: str, high: str, t: Column) -> Column:
    """The point t of the way from ``low`` to ``high`` (a missing ``high``: the last value)."""
    diff = F.col(high) - F.col(low)
    lerp = F.when(t >= 0.5, F.col(high) - diff * (F.lit(1.0) - t)).otherwise(F.col(low) + diff * t)
    return F.when(F.col(high).isNull(), F.col(low)).otherwise(lerp)


def _quantiles_of_all(ranges: DataFrame, totals: DataFrame, probs: list[float]) -> DataFrame:
    """(p, quantile) without groups: the values at the wanted ranks by one aggregate over the value ranges, no join."""
    last = F.coalesce(totals.select("tot_c").scalar(), F.lit(0)) - 1

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("lo") <= rank) & (rank < F.col("hi")), F.col("v")))

    picked = []
    for p in probs:
        h = F.lit(float(p)) * last
        j = F.floor(h).cast("long")
        picked.append(F.struct(F.lit(float(p)).alias("p"), h.alias("h"), j.alias("j"), at(j).alias("a"), at(j + 1).alias("b")))
    rows = ranges.agg(F.array(*picked).alias("q"), F.max("hi").alias("n")).where("n IS NOT NULL").select(F.explode("q").alias("q")).select("q.*")
    return rows.select("p", _between("a", "b", F.col("h") - F.col("j")).alias("quantile"))
