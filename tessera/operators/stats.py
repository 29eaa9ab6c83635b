"""Aggregations, exact quantiles, describe, sort / top-k.

Scale notes
-----------
* Sums, means, counts, min/max are algebraic: Spark runs a partial aggregate
  before the shuffle, so a key holding a third of all rows is reduced map-side.
* Spark's exact ``percentile`` merges a value->count map of *all* distinct
  values of a group in one task. :func:`exact_quantiles` instead selects by
  radix: it counts the values' leading bits, then the next bits of only those
  values that share a wanted rank's leading bits. What is counted is bounded
  by the digit's width, a hot value is one cell, and the source is scanned
  three times with no shuffle of values.
* ``approx=True`` uses ``percentile_approx`` (bounded-size sketches).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.operators.util import cols_of
from tessera.session import ensure_checkpoint_dir


# --- simple aggregates (G1-G6, G9-G11) ----------------------------------------

def sum_expr(value: str, exact_scale: int | None = None) -> Column:
    """Sum of a double column. ``exact_scale`` sums in DECIMAL(38, s) and casts
    back: the result is then independent of partitioning and summation order
    (a float sum is not), which keeps money totals reproducible at any scale."""
    if exact_scale is None:
        return F.sum(value)
    return F.sum(F.col(value).cast(f"decimal(38,{exact_scale})")).cast("double")


def mean_expr(value: str, exact_scale: int | None = None) -> Column:
    """Mean ignoring nulls; with ``exact_scale``: exact decimal sum / count."""
    if exact_scale is None:
        return F.avg(value)
    return sum_expr(value, exact_scale) / F.count(value).cast("double")


def _drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def group_sum(df: DataFrame, key, value: str, alias: str = "total",
              drop_null_keys: bool = True, exact_scale: int | None = None) -> DataFrame:
    """G1: sum per group; an all-null group sums to 0, null keys are dropped
    (pandas ``groupby().sum()``)."""
    keys = cols_of(key)
    src = _drop_null_keys(df, keys) if drop_null_keys else df
    return src.groupBy(*keys).agg(
        F.coalesce(sum_expr(value, exact_scale), F.lit(0.0)).alias(alias))


def mean_of(df: DataFrame, value: str, alias: str = "mean",
            exact_scale: int | None = None) -> DataFrame:
    """Overall mean (nulls ignored)."""
    return df.agg(mean_expr(value, exact_scale).alias(alias))


def group_mean(df: DataFrame, key, value: str, alias: str = "mean",
               drop_null_keys: bool = True, exact_scale: int | None = None) -> DataFrame:
    """Mean per group."""
    keys = cols_of(key)
    src = _drop_null_keys(df, keys) if drop_null_keys else df
    return src.groupBy(*keys).agg(mean_expr(value, exact_scale).alias(alias))


def group_means(df: DataFrame, key: Column, key_alias: str, values: dict[str, str],
                exact_scale: int | None = None) -> DataFrame:
    """Several means per derived key (e.g. week); null keys kept (SQL)."""
    return df.groupBy(key.alias(key_alias)).agg(
        *[mean_expr(src, exact_scale).alias(alias) for alias, src in values.items()])


def group_count(df: DataFrame, key, alias: str = "n") -> DataFrame:
    """Row count per group (SQL semantics: the null group is kept)."""
    return df.groupBy(*cols_of(key)).agg(F.count(F.lit(1)).alias(alias))


def distinct_values(df: DataFrame, col: str, fill=None) -> DataFrame:
    """Distinct values of a column, missing replaced by ``fill`` first."""
    c = F.coalesce(F.col(col), F.lit(fill)) if fill is not None else F.col(col)
    return df.select(c.alias(col)).distinct()


def distinct_lists(df: DataFrame, cols: Sequence[str], fills: dict | None = None, name: str = "dim",
                   value: str = "value") -> DataFrame:
    """G10 for several columns: one row per column and distinct value (as text; missing replaced
    by ``fills[column]`` where given). One scan and one aggregate for all columns."""
    fills = fills or {}
    text = [(F.coalesce(F.col(c), F.lit(fills[c])) if c in fills else F.col(c)).cast("string").alias(c) for c in cols]
    return df.select(*text).unpivot([], list(cols), name, value).distinct()


def row_count(df: DataFrame, alias: str = "n_rows") -> DataFrame:
    """Number of rows, as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(alias))


# --- exact quantiles (G7, G8, P17) ----------------------------------------------

def ordered_bits(v: Column) -> Column:
    """The order-preserving whole number of a double: the 64 bits of its size (11 of the
    exponent, 52 of the fraction), negative for negative values; both zeros are 0, NaN and
    null give null. Powers of two are exact, so is every step."""
    a, one = F.abs(v), F.lit(float(1 << 52))
    e = F.floor(F.log2(a))
    m = a / F.pow(F.lit(2.0), e)  # the logarithm may be one off beside a power of two
    e = e + F.when(m >= 2, 1).when(m < 1, -1).otherwise(0)
    normal = (e + 1023) * (1 << 52) + ((a / F.pow(F.lit(2.0), e) - 1) * one).cast("long")
    bits = (F.when(a == F.lit(float("inf")), F.lit(2047 << 52)).when(a < F.lit(2.0 ** -1022), (a / F.lit(5e-324)).cast("long"))
            .otherwise(normal))
    return F.when(~F.isnan(v), F.when(v < 0, -bits).otherwise(bits))


def from_ordered_bits(k: Column) -> Column:
    """The double of an ``ordered_bits`` number."""
    b = F.abs(k)
    e, fraction = F.shiftright(b, 52), b.bitwiseAND(F.lit((1 << 52) - 1))
    a = (F.when(e == 2047, F.lit(float("inf"))).when(e == 0, b.cast("double") * F.lit(5e-324))
         .otherwise((F.lit(1.0) + fraction / F.lit(float(1 << 52))) * F.pow(F.lit(2.0), e - 1023)))
    return F.when(k < 0, -a).otherwise(a)


#: Low bits left out at each step of the selection: digits of 22, 21 and 21 bits.
DIGIT_SHIFTS = (42, 21, 0)


def exact_quantiles(df: DataFrame, value, probs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None, ranges: int | None = None,
                    approx: bool = False, accuracy: int = 10000,
                    few_groups: bool | None = None) -> DataFrame:
    """Exact, linearly interpolated quantiles per group (pandas / ``quantile_cont``).

    Returns one row per group: the ``by`` columns plus one double column per
    probability (``names`` or ``q0, q1, ...``). Nulls and NaN are ignored; with
    ``by`` a group without values gets no row, without ``by`` the single
    result row holds nulls (SQL aggregate semantics).

    For position ``h = (n-1)p`` with ``k = floor(h)``, ``d = h - k`` the result is
    ``x[k]*(1-d) + x[k+1]*d``. For the median (d = 0.5) both products are exact,
    so the value is the correctly rounded midpoint.

    Radix selection: the first digit of all values is counted, then the next digit of the
    values that share a wanted rank's digits so far, then the last. Each step is one scan
    of the column and one aggregate of at most 2**22 cells a wanted rank, whatever the
    number of different values; nothing is sampled, sorted or written. The last step
    gives the value itself.

    ``few_groups`` (default: true when ``by`` is empty) says the number of
    groups has a fixed bound (e.g. column names); the wanted ranks, ``groups x 2 x
    len(probs)`` rows, are then broadcast. Otherwise joins are keyed by group and digit and
    AQE picks the strategy from measured sizes. ``ranges`` has no effect any more.
    """
    by = list(by)
    few_groups = (not by) if few_groups is None else few_groups
    names = list(names) if names else [f"q{i}" for i in range(len(probs))]
    v = F.col(value) if isinstance(value, str) else value
    if approx:
        vals = df.select(*by, v.cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        return vals.groupBy(*by).agg(*[
            F.percentile_approx("_v", float(p), accuracy).alias(n) for p, n in zip(probs, names)])

    vals = df.select(*by, v.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    vals = vals.select(*by, ordered_bits(F.col("_v")).alias("_bits")).where(F.col("_bits").isNotNull())
    picks = _first_digits(vals, by, probs)
    for shift in DIGIT_SHIFTS[1:]:
        picks = _next_digits(vals, by, picks, shift, few_groups)
    found = picks.select(*by, "_i", "_side", "_d", from_ordered_bits(F.col("_digits")).alias("_v"))
    per_prob = found.groupBy(*by, "_i").agg(
        F.max(F.when(F.col("_side") == 0, F.col("_v"))).alias("_x0"),
        F.max(F.when(F.col("_side") == 1, F.col("_v"))).alias("_x1"),
        F.max("_d").alias("_d"))
    per_prob = per_prob.withColumn(
        "_q", F.col("_x0") * (F.lit(1.0) - F.col("_d")) + F.col("_x1") * F.col("_d"))
    return per_prob.groupBy(*by).agg(*[
        F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(n) for i, n in enumerate(names)])


def _first_digits(vals: DataFrame, by: list[str], probs: Sequence[float]) -> DataFrame:
    """``(by, _i, _side, _d, _digits, _rest)``: of the ranks k (side 0) and k + 1 (side 1, at most
    the last) of each probability, the first digit and the rank among the values that
    share it."""
    cells = vals.groupBy(*by, F.shiftright("_bits", DIGIT_SHIFTS[0]).alias("_digits")).agg(F.count(F.lit(1)).alias("_c"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    upto = group.orderBy("_digits").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumns({"_end": F.sum("_c").over(upto), "_n": F.sum("_c").over(group)})
    wanted = F.inline(F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(side).alias("_side"), F.lit(float(p)).alias("_p"))
                                for i, p in enumerate(probs) for side in (0, 1)]))
    h = (F.col("_n") - 1).cast("double") * F.col("_p")
    rank = F.least(F.floor(h) + F.col("_side"), F.col("_n") - 1)
    return (cells.select("*", wanted)
            .select(*by, "_i", "_side", (h - F.floor(h).cast("double")).alias("_d"), "_digits",
                    (rank - F.col("_end") + F.col("_c")).alias("_rest"), "_c")
            .where("_rest >= 0 and _rest < _c").drop("_c"))


def _next_digits(vals: DataFrame, by: list[str], picks: DataFrame, shift: int, few_groups: bool) -> DataFrame:
    """The picks with one digit more, counted among the values that share their digits."""
    before = DIGIT_SHIFTS[DIGIT_SHIFTS.index(shift) - 1]
    p = picks.select(*[F.col(b).alias(f"_p_{b}") for b in by], "_i", "_side", "_d", "_digits", "_rest")
    cond = _and([F.col(b).eqNullSafe(F.col(f"_p_{b}")) for b in by]  # a null group is a group
                + [F.shiftright("_bits", before) == F.col("_digits")])
    pick = [*by, "_i", "_side"]
    cells = (vals.join(F.broadcast(p) if few_groups else p, cond)
             .groupBy(*pick, "_d", "_rest", F.shiftright("_bits", shift).alias("_next")).agg(F.count(F.lit(1)).alias("_c")))
    upto = Window.partitionBy(*pick).orderBy("_next").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (cells.withColumn("_rest", F.col("_rest") - F.sum("_c").over(upto) + F.col("_c"))
            .where("_rest >= 0 and _rest < _c")
            .select(*pick, "_d", F.col("_next").alias("_digits"), "_rest"))


def _and(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def median_of(df: DataFrame, col: str, alias: str = "median", approx: bool = False) -> DataFrame:
    """Median (one row)."""
    return exact_quantiles(df, col, [0.5], names=[alias], approx=approx)


def _as_double(df: DataFrame, c: str) -> Column:
    dtype = dict(df.dtypes)[c]
    if dtype.startswith("timestamp") or dtype == "date":
        # epoch seconds, independent of the session time zone
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        micros = F.timestamp_diff("MICROSECOND", epoch, F.col(c).cast("timestamp_ntz"))
        return micros.cast("double") / F.lit(1e6)
    return F.col(c).cast("double")


def describe_exact(df: DataFrame, cols: Sequence[str], approx: bool = False,
                   exact_scale: int | None = None) -> DataFrame:
    """Pandas ``describe()``: one row per column with count, mean, std,
    min, 25%, 50%, 75%, max (all double; datetime columns as epoch seconds,
    std null for them). Quartiles are exact unless ``approx``.

    The moments come from one aggregate pass whose single result row is then
    unpivoted with ``stack`` (no per-row explosion); quartiles come from
    :func:`exact_quantiles` grouped by column name.
    """
    cols = list(cols)
    dtypes = dict(df.dtypes)
    is_time = {c: dtypes[c].startswith("timestamp") or dtypes[c] == "date" for c in cols}
    proj = df.select(*[_as_double(df, c).alias(c) for c in cols])
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).cast("double").alias(f"n{i}"), mean_expr(c, exact_scale).alias(f"m{i}"),
                 (F.lit(None).cast("double") if is_time[c] else F.stddev_samp(c)).alias(f"s{i}"),
                 F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    one = proj.agg(*aggs)
    stack = "stack({n}, {body}) as (column, count, mean, std, min, max)".format(
        n=len(cols), body=", ".join(
            f"'{c}', n{i}, m{i}, s{i}, lo{i}, hi{i}" for i, c in enumerate(cols)))
    moments = one.selectExpr(stack)
    long = proj.unpivot([], cols, "column", "v")  # rows meet the cell counts in the same stage
    qs = exact_quantiles(long, "v", [0.25, 0.5, 0.75], by=["column"],
                         names=["q25", "q50", "q75"], approx=approx, few_groups=True)
    return (moments.join(qs, "column", "left")
            .select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"))


# --- ordering, top-k (O1-O4) ------------------------------------------------------

def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """O2: first ``n`` rows by a total order (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def top_group(df: DataFrame, key: str, value: str, alias: str = "total", n: int = 1,
              exact_scale: int | None = None) -> DataFrame:
    """O3: best group(s) by the sum of ``value``; ties broken by key."""
    g = group_sum(df, key, value, alias, exact_scale=exact_scale)
    return g.orderBy(F.col(alias).desc(), F.col(key).asc()).limit(n)


__all__ = [
    "group_sum", "mean_of", "group_mean", "group_means", "group_count",
    "distinct_values", "distinct_lists", "row_count", "exact_quantiles", "median_of",
    "describe_exact", "top_n", "top_group", "dense_index",
]


def dense_index(df: DataFrame, cols: Sequence[str], alias: str = "idx",
                ranges: int | None = None, by: Sequence[str] = (),
                few_groups: bool | None = None) -> DataFrame:
    """Number the distinct rows of ``df[cols]`` 0..k-1 in ascending order
    (separately within each group of ``by``).

    Distributed: distinct rows are range-partitioned and ranked inside their
    range; that result is materialised once with a reliable ``checkpoint()``
    (in the shared ``spark.checkpoint.dir``), so the per-range counts and the
    ranks come from the same files even if a task is retried. Range offsets
    are running sums over at most ``groups x ranges`` rows, joined back on
    (group, range id); that table is broadcast only when the group count has a
    fixed bound (``few_groups``, default: no ``by``), otherwise AQE decides from
    its measured size. No window runs without a partition key over an
    unbounded set, and no value is compared with every range.
    """
    cols, by = list(cols), list(by)
    few_groups = (not by) if few_groups is None else few_groups
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*[F.col(c) for c in cols])
    d = df.select(*by, *cols).distinct().withColumn("_key", key)
    ranked = (d.repartitionByRange(n_ranges, *by, "_key").withColumn("_pid", F.spark_partition_id())
               .withColumn("_rn", F.row_number().over(
                   Window.partitionBy(*by, "_pid").orderBy("_key")))
               .checkpoint(eager=True))
    counts = ranked.groupBy(*by, "_pid").agg(F.count(F.lit(1)).alias("_rc"))
    w_grp = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("_pid")
    offsets = counts.select(*by, "_pid", (F.sum("_rc").over(w_grp.rowsBetween(
        Window.unboundedPreceding, Window.currentRow)) - F.col("_rc")).alias("_off"))
    offsets = offsets.select(*[F.col(b).alias(f"_o_{b}") for b in by], F.col("_pid").alias("_o_pid"),
                             "_off")
    offsets = F.broadcast(offsets) if few_groups else offsets
    cond = _and([F.col(b).eqNullSafe(F.col(f"_o_{b}")) for b in by]  # a null group is a group
                + [F.col("_pid") == F.col("_o_pid")])
    return (ranked.join(offsets, cond)
                  .select(*by, *cols, (F.col("_off") + F.col("_rn") - 1).alias(alias)))
