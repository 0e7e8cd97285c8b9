"""Exact interpolated percentiles in two reads, without gathering a group's values in one task.

The built-in exact ``percentile``/``median`` keep every distinct value of a group in one
aggregation buffer. Here the first read makes one mergeable quantile sketch per group and column, together with
any sums a caller wants. A sketch brackets every wanted rank between two values. The second read counts
what lies below a bracket and keeps the values inside it, combined into (value, count) before they move; the counts tell
the exact values at the ranks, and whether a bracket held them at all.

Should a bracket miss its rank, or still hold very many values, everything is found by bins and slices instead: counts per
order-preserving bin tell which bin holds each wanted rank, the values of only those bins are taken, and equal
slices of a bin are narrowed down in the same way.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremill.session import cut_lineage

#: Size of a sketch, and the share of ranks by which a bracket is widened: three times the sketch's stated error.
SKETCH = 4096
MARGIN = 0.003
#: Distinct values of a bracket that one task puts in order; beyond, bins and slices are used.
BRACKET_VALUES = 2_000_000

# Bins per unit of ln(1 + |value|): fares, miles, minutes and errors fall into some ten thousand bins.
_BINS_PER_LOG = 4096
# Equal slices a bin is cut into.
_SLICES = 65_536


def _bin(value: Column) -> Column:
    # log1p never decreases as its input grows, so a lower bin never holds a higher value.
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * _BINS_PER_LOG).cast("bigint")


def long_values(df: DataFrame, columns: Sequence[str] | Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """One row per (row, column): ``by``, ``column``, ``value`` as double; NULL and NaN left out."""
    if not isinstance(columns, Mapping):
        columns = {name: F.col(name) for name in columns}
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("column"), expr.cast("double").alias("value"))
            for name, expr in columns.items()
        ]
    )
    return (
        df.select(*by, F.inline(pairs))
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        # 0.0 and -0.0 are one value
        .withColumn("value", F.when(F.col("value") == 0, F.lit(0.0)).otherwise(F.col("value")))
    )


def value_counts(df: DataFrame, columns: Sequence[str] | Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    return long_values(df, columns, by).groupBy(*by, "column", "value").agg(F.count("*").alias("n"))


def _holding(cells: DataFrame, scope: Sequence[str], cell: str, wanted: Column, start: Column) -> DataFrame:
    """Cells that hold a wanted rank, with the rows before them and the ranks to find inside."""
    order = Window.partitionBy(*scope).orderBy(cell)
    upto = start + F.sum("n").over(order)
    ranked = cells.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n"))
    # A rank r (from 0) lies in the cell with before <= r < upto.
    hits = F.filter(wanted, lambda w: (w["high"] >= F.col("before")) & (w["low"] < F.col("upto")))
    return ranked.withColumn("hits", hits).filter(F.size("hits") > 0)


def _percentiles(values: DataFrame, probabilities: Sequence[float], by: Sequence[str]) -> DataFrame:
    keys = [*by, "column"]
    binned = values.withColumn("bin", _bin(F.col("value")))
    bins = binned.groupBy(*keys, "bin").agg(
        F.sum("n").alias("n"), F.min("value").alias("floor"), F.max("value").alias("top")
    )
    bins = bins.withColumn("last", F.sum("n").over(Window.partitionBy(*keys)) - 1)
    wanted = F.array(
        *[
            F.struct(
                F.lit(i).alias("place"),
                F.floor(F.lit(float(p)) * F.col("last")).alias("low"),
                F.ceil(F.lit(float(p)) * F.col("last")).alias("high"),
                (F.lit(float(p)) * F.col("last")).alias("at"),
            )
            for i, p in enumerate(probabilities)
        ]
    )
    picked = _holding(bins, keys, "bin", wanted, F.lit(0)).select(*keys, "bin", "floor", "top", "before", "hits")

    in_bin = [*keys, "bin"]
    width = F.col("top") - F.col("floor")
    part = F.when(width > 0, F.floor((F.col("value") - F.col("floor")) / width * _SLICES)).otherwise(F.lit(0))
    inside = (
        binned.join(picked.select(*in_bin), in_bin, "left_semi")
        .groupBy(*in_bin, "value")
        .agg(F.sum("n").alias("n"))
        .join(picked, in_bin)
        .withColumn("slice", part)
    )
    slices = inside.groupBy(*in_bin, "slice").agg(
        F.sum("n").alias("n"), F.any_value("before").alias("start"), F.any_value("hits").alias("wanted")
    )
    final = _holding(slices, in_bin, "slice", F.col("wanted"), F.col("start"))
    in_slice = [*in_bin, "slice"]
    in_order = Window.partitionBy(*in_slice).orderBy("value")
    found = (
        inside.drop("before", "hits")
        .join(final.select(*in_slice, "before", "hits"), in_slice)
        .withColumn("last", F.col("before") + F.sum("n").over(in_order) - 1)
        .withColumn("first", F.col("last") - F.col("n") + 1)
    )
    ends = (
        found.select(*keys, "value", "first", "last", F.inline("hits"))
        .filter((F.col("high") >= F.col("first")) & (F.col("low") <= F.col("last")))
        .groupBy(*keys, "place")
        .agg(
            F.min("value").alias("below"),
            F.max("value").alias("above"),
            F.min(F.col("at") - F.col("low")).alias("part"),
        )
    )
    value = F.col("below") + (F.col("above") - F.col("below")) * F.col("part")
    return (
        ends.groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("place", value.alias("value")))).alias("places"))
        .select(*keys, F.col("places.value").alias("quantiles"))
    )


def _by_bins(df: DataFrame, columns: Mapping[str, Column], probabilities: Sequence[float], by: Sequence[str]) -> DataFrame:
    return _percentiles(value_counts(df, columns, by), probabilities, by)


def _value(column: Column) -> Column:
    """A double with NaN as NULL and one zero."""
    double = column.cast("double")
    return F.when(double == 0, F.lit(0.0)).when(~F.isnan(double), double)


def _cell(nth: int, name: str, probabilities: Sequence[float], sums: Sequence[str]) -> Column:
    """What the first read finds of one column: its size, sums, and a bracket for every probability."""
    n, sketch = F.col(f"_n{nth}"), F.col(f"_s{nth}")
    ends = [0.0, 1.0, *(max(p - MARGIN, 0.0) for p in probabilities), *(min(p + MARGIN, 1.0) for p in probabilities)]
    found = F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(end)) for end in ends]))
    few = n <= 2 * SKETCH  # all values
    brackets = []
    for place, p in enumerate(probabilities):
        at = F.lit(float(p)) * (n - 1)
        parts = {
            "place": F.lit(place),
            "low": F.floor(at).cast("bigint"),
            "high": F.ceil(at).cast("bigint"),
            "part": at - F.floor(at),
            "least": F.when(few, found[0]).otherwise(found[2 + place]),
            "most": F.when(few, found[1]).otherwise(found[2 + len(probabilities) + place]),
        }
        brackets.append(F.struct(*[column.alias(key) for key, column in parts.items()]))
    given = [F.col(f"_a{nth}_{key}").alias(key) for key in sums]
    return F.struct(F.lit(nth).alias("nth"), F.lit(name).alias("column"), n.alias("n"), *given, F.when(n > 0, F.array(*brackets)).alias("brackets"))


def _found(rows: DataFrame, read: DataFrame, width: int, by: Sequence[str]) -> DataFrame | None:
    """(by, nth, quantiles) by a second read; nothing if a bracket misses its rank or is too large for one task."""
    pairs = F.transform("cells", lambda c: F.transform(c["brackets"], lambda b: F.struct(c["nth"].alias("nth"), b.alias("b"))))
    wanted = read.select(*[F.col(name).alias(f"_g{i}") for i, name in enumerate(by)], F.flatten(F.filter(pairs, lambda c: c.isNotNull())).alias("_wanted"))
    if by:
        same = [F.col(name).eqNullSafe(F.col(f"_g{i}")) for i, name in enumerate(by)]
        joined = rows.join(wanted, same)
    else:
        only = wanted.first()["_wanted"]
        kind = wanted.schema["_wanted"].dataType.simpleString()
        joined = rows.withColumn("_wanted", F.from_json(F.lit(_as_json(only)), kind))
    values = F.array(*[F.col(f"_v{i}") for i in range(width)])

    def hit(w: Column) -> Column:
        value, b = F.get(values, w["nth"]), w["b"]
        inside = F.when(value >= b["least"], value)
        return F.struct(w["nth"].alias("nth"), b["place"].alias("place"), b["low"].alias("low"), b["high"].alias("high"), b["part"].alias("part"), inside.alias("value"), (value <= b["most"]).alias("kept"))

    hits = F.filter(F.transform("_wanted", hit), lambda h: h["kept"])
    keys = [*by, "nth", "place", "low", "high", "part"]
    counted = cut_lineage(joined.select(*by, F.inline(hits)).drop("kept").groupBy(*keys, "value").agg(F.count("*").alias("n")))
    sizes = counted.groupBy(*by, "nth").agg(F.count("*").alias("size")).agg(F.max("size")).first()[0]
    if (sizes or 0) > BRACKET_VALUES:
        return None
    # dealt once, by what the last step groups by
    order = Window.partitionBy(*by, "nth", "place").orderBy(F.col("value").asc_nulls_first())
    ranked = counted.repartition(*by, "nth").withColumn("last", F.sum("n").over(order) - 1).withColumn("first", F.col("last") - F.col("n") + 1)
    picked = ranked.filter(F.col("value").isNotNull() & (F.col("high") >= F.col("first")) & (F.col("low") <= F.col("last")))
    ends = picked.groupBy(*keys).agg(F.min("value").alias("below"), F.max("value").alias("above"), F.min("first").alias("first"), F.max("last").alias("last"))
    exact = (F.col("first") <= F.col("low")) & (F.col("last") >= F.col("high"))
    value = F.when(exact, F.col("below") + (F.col("above") - F.col("below")) * F.col("part"))
    places = ends.groupBy(*by, "nth").agg(F.array_sort(F.collect_list(F.struct("place", value.alias("value")))).alias("places"))
    return cut_lineage(places.select(*by, "nth", F.col("places.value").alias("quantiles")))


def _as_json(wanted: list | None) -> str:
    return json.dumps([{"nth": w["nth"], "b": w["b"].asDict()} for w in wanted or []])


def summaries(
    df: DataFrame,
    columns: Sequence[str] | Mapping[str, Column],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    per_column: Callable[[Column], dict[str, Column]] | None = None,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per group and column: ``by``, ``column``, ``n`` (values), ``quantiles``, and further aggregates.

    ``per_column`` gives aggregates of a column's values (NULL for NULL and NaN), ``extra`` aggregates of a group's rows. A column
    without values has n 0 and NULL quantiles. The input is read twice, whatever is asked for.
    """
    if not isinstance(columns, Mapping):
        columns = {name: F.col(name) for name in columns}
    made = per_column or (lambda value: {})
    names, extra = list(columns), dict(extra or {})
    rows = df.withColumns({f"_v{i}": _value(column) for i, column in enumerate(columns.values())})
    aggregates = [column.alias(f"_e_{key}") for key, column in extra.items()]
    sums: list[str] = []
    for i in range(len(names)):
        value = F.col(f"_v{i}")
        own = made(value)
        sums = list(own)
        aggregates += [F.kll_sketch_agg_double(value, F.lit(SKETCH)).alias(f"_s{i}"), F.count(value).alias(f"_n{i}")]
        aggregates += [column.alias(f"_a{i}_{key}") for key, column in own.items()]
    cells = F.array(*[_cell(i, name, probabilities, sums) for i, name in enumerate(names)])
    read = cut_lineage(rows.groupBy(*by).agg(*aggregates).select(*by, *[F.col(f"_e_{key}").alias(key) for key in extra], cells.alias("cells")))
    found = _found(rows.select(*by, *[f"_v{i}" for i in range(len(names))]), read, len(names), by)
    if found is None or not found.filter(F.exists("quantiles", lambda q: q.isNull()) | (F.size("quantiles") < len(probabilities))).isEmpty():
        nth = F.array_position(F.array(*[F.lit(name) for name in names]), F.col("column")).cast("int") - 1
        found = _by_bins(df, columns, probabilities, by).select(*by, nth.alias("nth"), "quantiles")
    long = read.select(*by, *extra, F.inline("cells")).drop("brackets")
    right = found.select(*[F.col(name).alias(f"_g{i}") for i, name in enumerate(by)], F.col("nth").alias("_nth"), "quantiles")
    same = [F.col("nth") == F.col("_nth"), *(F.col(name).eqNullSafe(F.col(f"_g{i}")) for i, name in enumerate(by))]
    return long.join(right, same, "left").select(*by, "column", "n", "quantiles", *sums, *extra)


def exact_percentiles(
    df: DataFrame,
    columns: Sequence[str] | Mapping[str, Column],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Percentiles as ``by``, ``column``, ``quantiles`` (array in the order of ``probabilities``); columns without values are left out."""
    return summaries(df, columns, probabilities, by).filter("n > 0").select(*by, "column", "quantiles")


def medians(df: DataFrame, columns: Sequence[str] | Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    out = exact_percentiles(df, columns, [0.5], by)
    return out.select(*by, "column", F.col("quantiles")[0].alias("median"))
