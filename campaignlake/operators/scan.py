"""Ordered running sums without a single-partition window, and what follows from them.

A window without PARTITION BY sends every row to one task, and a window per key sends a hot key to
one task. Here rows are range-partitioned by (group, order), so a group may span many partitions.
Each partition runs its own window; what it takes over from the partitions before is a table of
at most two rows per partition, which is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from campaignlake.session import broadcast_checked, materialize

_PART = "_part"


def ordered_scan(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    sums: Sequence[str] = (),
    lags: Sequence[str] = (),
    totals: bool = False,
    few_groups: bool = False,
) -> DataFrame:
    """Add `cum_<c>` (running sum up to and with the row) and `prev_<c>` (value one row before).

    Rows run ascending by `order` inside each group of `by`; (by, order) must be unique and `by`
    must hold no nulls. Running sums of integers are exact and do not depend on the partitioning.
    With `totals`, `total_<c>` gives the sum over the whole group. The group totals are broadcast
    when they are few, which is checked by a count unless `few_groups` says it is known.
    """
    by, order, sums, lags = list(by), list(order), list(sums), list(lags)
    ranged = materialize(
        df.repartitionByRange(*by, *order).withColumn(_PART, F.spark_partition_id()), "scan"
    )
    group = F.struct(F.lit(0).alias("_all"), *by)

    inside = Window.partitionBy(_PART, *by).orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select(
        "*",
        *[F.sum(c).over(running).alias(f"cum_{c}") for c in sums],
        *([F.lag(F.struct(*lags)).over(inside).alias("_before")] if lags else []),
    )

    # One row per partition: its first and last group, and the state at the end of the last group.
    state = F.struct(
        *[F.col(c).alias(f"_sum_{c}") for c in sums],
        *([F.col("_last")] if lags else [F.lit(0).alias("_last")]),
    )
    ends = (
        ranged.groupBy(_PART, *by)
        .agg(
            *[F.sum(c).alias(c) for c in sums],
            F.max_by(F.struct(*lags), F.struct(*order)).alias("_last") if lags else F.lit(0).alias("_last"),
        )
        .select(_PART, group.alias("_group"), state.alias("_state"))
        .groupBy(_PART)
        .agg(
            F.min("_group").alias("_first_group"),
            F.max("_group").alias("_last_group"),
            F.max_by("_state", "_group").alias("_state"),
        )
    )
    nothing = F.lit(None).cast(ends.schema["_state"].dataType)
    edges = ends.select(
        _PART,
        F.explode(
            F.array_compact(
                F.array(
                    F.struct(F.col("_last_group").alias("g"), F.col("_state").alias("s")),
                    F.when(
                        F.col("_first_group") != F.col("_last_group"),
                        F.struct(F.col("_first_group").alias("g"), nothing.alias("s")),
                    ),
                )
            )
        ).alias("_edge"),
    ).select(_PART, F.col("_edge.g").alias("_group"), F.col("_edge.s").alias("_state"))
    before = Window.partitionBy("_group").orderBy(_PART)
    carried = edges.select(
        F.col(_PART).alias("_carry_part"),
        F.col("_group").alias("_carry_group"),
        *[
            F.sum(f"_state._sum_{c}").over(before.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_carry_{c}")
            for c in sums
        ],
        *([F.lag("_state._last").over(before).alias("_carry_last")] if lags else []),
    )

    joined = local.withColumn("_row_group", group).join(
        F.broadcast(carried),
        (F.col(_PART) == F.col("_carry_part")) & (F.col("_row_group") == F.col("_carry_group")),
        "left",
    )
    previous = F.coalesce(F.col("_before"), F.col("_carry_last")) if lags else None
    added = []
    if totals and by:
        whole = ranged.groupBy(group.alias("_whole_group")).agg(*[F.sum(c).alias(f"total_{c}") for c in sums])
        small = F.broadcast(whole) if few_groups else broadcast_checked(whole)
        joined = joined.join(small, F.col("_row_group") == F.col("_whole_group"))
        added = [F.col(f"total_{c}") for c in sums]
    elif totals:
        whole = ranged.agg(F.struct(*[F.sum(c).alias(c) for c in sums])).scalar()
        added = [whole[c].alias(f"total_{c}") for c in sums]
    return joined.select(
        *df.columns,
        *added,
        *[(F.col(f"cum_{c}") + F.coalesce(F.col(f"_carry_{c}"), F.lit(0))).alias(f"cum_{c}") for c in sums],
        *[previous[c].alias(f"prev_{c}") for c in lags],
    )


@dataclass(frozen=True)
class Monoid:
    """An associative operation: over rows as an aggregate, and between two results, of which one may be null."""

    aggregate: Callable[[Column], Column]
    combine: Callable[[Column, Column], Column]


MINIMUM, MAXIMUM = Monoid(F.min, F.least), Monoid(F.max, F.greatest)
TOTAL = Monoid(F.sum, lambda a, b: F.coalesce(a + b, a, b))
EVERY = Monoid(F.bool_and, lambda a, b: F.coalesce(a & b, a, b))


def ordered_fold(
    df: DataFrame, order: Sequence[str], by: Sequence[str], folds: Mapping[str, tuple[str, Monoid]], descending: bool = False,
) -> DataFrame:
    """Add running results of associative operations: `folds` maps an output to (column, operation).

    Rows run by `order`, upwards or downwards, inside each group of `by`, and each gets the result up to and
    with itself. A group of any size spans partitions; what a partition takes over is one state per group
    that began before it, of which there is one at most. Nulls in `by` are a group. Of rows with equal order
    the result depends on which comes first.
    """
    by, towards = list(by), F.desc if descending else F.asc
    keys = [*by, *[towards(c) for c in order]]
    ranged = materialize(df.repartitionByRange(*keys).withColumn(_PART, F.spark_partition_id()), "fold")
    group = F.struct(F.lit(0).alias("_all"), *by)
    inside = Window.partitionBy(_PART, *by).orderBy(*[towards(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", group.alias("_group"), *[m.aggregate(F.col(c)).over(inside).alias(f"_run_{out}") for out, (c, m) in folds.items()])
    # Per partition its first and last group, and the state at the end of the last one.
    state = F.struct(F.lit(0).alias("_none"), *[F.col(f"_end_{out}") for out in folds])
    ends = ranged.groupBy(_PART, group.alias("_group")).agg(*[m.aggregate(F.col(c)).alias(f"_end_{out}") for out, (c, m) in folds.items()])
    ends = ends.groupBy(_PART).agg(
        F.min("_group").alias("_first"), F.max("_group").alias("_last"), F.max_by(state, F.col("_group")).alias("_state"))
    nothing = F.lit(None).cast(ends.schema["_state"].dataType)
    edges = ends.select(_PART, F.explode(F.array_compact(F.array(
        F.struct(F.col("_last").alias("g"), F.col("_state").alias("s")),
        F.when(~F.col("_first").eqNullSafe(F.col("_last")), F.struct(F.col("_first").alias("g"), nothing.alias("s"))),
    ))).alias("e")).select(_PART, F.col("e.g").alias("_group"), F.col("e.s").alias("_state"))
    before = Window.partitionBy("_group").orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        F.col(_PART).alias("_carry_part"), F.col("_group").alias("_carry_group"),
        *[m.aggregate(F.col(f"_state._end_{out}")).over(before).alias(f"_carry_{out}") for out, (_, m) in folds.items()])
    # At most two rows per partition.
    joined = local.join(
        F.broadcast(carried), (F.col(_PART) == F.col("_carry_part")) & F.col("_group").eqNullSafe(F.col("_carry_group")), "left")
    results = [m.combine(F.col(f"_carry_{out}"), F.col(f"_run_{out}")).alias(out) for out, (_, m) in folds.items()]
    return joined.select(*[c for c in df.columns if c not in folds], *results)


def value_histogram(
    df: DataFrame, values: Mapping[str, Column] | Sequence[str], target: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Rows per distinct value of several numeric columns, in one pass over the table.

    Gives (by…, feature, value, n) and, with a 0/1 target, `positives` and `negatives`. Nulls drop
    out. Counting happens before the shuffle, so a value held by most rows stays one row per task.
    """
    if not isinstance(values, Mapping):
        values = {name: F.col(name) for name in values}
    names = [f"_v{i}" for i in range(len(values))]
    wide = df.select(
        *by,
        *([F.col(target).cast("long").alias("_y")] if target else []),
        *[column.cast("double").alias(name) for name, column in zip(names, values.values())],
    )
    ids = [*by, *(["_y"] if target else [])]
    long = wide.unpivot(ids, names, "_name", "value").where(F.col("value").isNotNull())
    aggregates = [F.count(F.lit(1)).alias("n")]
    if target:
        aggregates.append(F.sum("_y").alias("positives"))
    counted = long.groupBy(*by, "_name", "value").agg(*aggregates)
    names_map = F.create_map(*[F.lit(x) for pair in zip(names, values) for x in pair])
    out = counted.select(
        *by, names_map[F.col("_name")].alias("feature"), "value", *[c for c in ("n", "positives") if c in counted.columns]
    )
    return out.withColumn("negatives", F.col("n") - F.col("positives")) if target else out


def ranked_histogram(
    df: DataFrame, values: Mapping[str, Column] | Sequence[str], target: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """`value_histogram` with running and total counts per feature in value order."""
    histogram = value_histogram(df, values, target, by)
    weights = ["n", "positives", "negatives"] if target else ["n"]
    return ordered_scan(histogram, ["value"], [*by, "feature"], sums=weights, totals=True, few_groups=not by)


def mid_rank(ranked: DataFrame, weight: str = "n") -> DataFrame:
    """Average rank of the rows that share a value: `rank_first + (n - 1) / 2`, counted from 1."""
    before = F.col(f"cum_{weight}") - F.col(weight)
    return ranked.withColumn("mid_rank", before + (F.col(weight) + 1) / F.lit(2.0))


def quantiles(
    ranked: DataFrame, specs: Mapping[str, tuple[str, float]], by: Sequence[str] = ("feature",)
) -> DataFrame:
    """Exact interpolated quantiles from running counts; one output column per spec.

    `specs` maps an output name to (weight column, probability). The position is `p * (N - 1)`, and
    values between two rows are interpolated linearly. `total_<weight>` is kept.
    """
    weights = sorted({weight for weight, _ in specs.values()})

    def position(weight: str, probability: float) -> Column:
        return F.lit(float(probability)) * (F.col(f"total_{weight}") - 1)

    def value_at(weight: str, index: Column) -> Column:
        end = F.col(f"cum_{weight}")
        return F.max(F.when((end - F.col(weight) <= index) & (index < end), F.col("value")))

    picked = []
    for name, (weight, probability) in specs.items():
        spot = position(weight, probability)
        picked.append(value_at(weight, F.floor(spot)).alias(f"_low_{name}"))
        picked.append(value_at(weight, F.ceil(spot)).alias(f"_high_{name}"))
    found = ranked.groupBy(*by, *[f"total_{w}" for w in weights]).agg(*picked)
    out = []
    for name, (weight, probability) in specs.items():
        share = position(weight, probability) - F.floor(position(weight, probability))
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        out.append((low + (high - low) * share).alias(name))
    return found.select(*by, *[f"total_{w}" for w in weights], *out)


def bracketed_quantiles(
    df: DataFrame, values: Mapping[str, Column] | Sequence[str], probabilities: Mapping[str, float], accuracy: int = 10_000,
) -> DataFrame:
    """Exact interpolated quantiles per column: feature, total_n, and one column per name of `probabilities`.

    A mergeable sketch per column, made in one pass, brackets each rank between two values; a second pass
    counts what lies below each bracket, and only rows within brackets, a few per `accuracy`, are counted by
    value and ordered. A bracket that misses its rank, as may happen in small tables, gives way to the whole
    column. Nulls drop out, and so do columns without values. The driver holds two numbers per column and
    probability.
    """
    if not isinstance(values, Mapping):
        values = {name: F.col(name) for name in values}
    names, points = list(values), list(probabilities.items())
    wide = df.select(*[values[n].cast("double").alias(f"_v{i}") for i, n in enumerate(names)])
    margin = 3.0 / accuracy

    def near(column: str, shift: float) -> Column:
        at = [min(1.0, max(0.0, p + shift)) for _, p in points]
        return F.percentile_approx(column, F.array(*[F.lit(x) for x in at]), F.lit(accuracy))

    sketched = wide.agg(*[x for i in range(len(names)) for x in (
        F.count(f"_v{i}").alias(f"n{i}"), F.min(f"_v{i}").alias(f"min{i}"), F.max(f"_v{i}").alias(f"max{i}"),
        near(f"_v{i}", -margin).alias(f"low{i}"), near(f"_v{i}", margin).alias(f"high{i}"))]).first()
    held = [i for i in range(len(names)) if sketched[f"n{i}"]]
    brackets = {(i, j): (sketched[f"low{i}"][j], sketched[f"high{i}"][j]) for i in held for j in range(len(points))}
    if not held:
        shape = ", ".join(["feature string, total_n long", *[f"`{n}` double" for n, _ in points]])
        return df.sparkSession.createDataFrame([], shape)
    counted = wide.agg(*[x for (i, j), (low, high) in brackets.items() for x in (
        F.count_if(F.col(f"_v{i}") < low).alias(f"below{i}_{j}"), F.count_if(F.col(f"_v{i}") <= high).alias(f"upto{i}_{j}"))]).first()
    ranks = []
    for (i, j), (low, high) in list(brackets.items()):
        spot = points[j][1] * (sketched[f"n{i}"] - 1)
        below = counted[f"below{i}_{j}"]
        if not (below <= math.floor(spot) and math.ceil(spot) < counted[f"upto{i}_{j}"]):
            brackets[i, j], below = (sketched[f"min{i}"], sketched[f"max{i}"]), 0
        ranks.append((i, j, sketched[f"n{i}"], math.floor(spot) - below, math.ceil(spot) - below, spot - math.floor(spot)))
    inside = [F.when(F.col(f"_v{i}").between(low, high), F.struct(
        F.lit(i).alias("column"), F.lit(j).alias("point"), F.col(f"_v{i}").alias("value"))) for (i, j), (low, high) in brackets.items()]
    found = wide.select(F.explode(F.array_compact(F.array(*inside))).alias("x")).select("x.*")
    counts = found.groupBy("column", "point", "value").agg(F.count(F.lit(1)).alias("n"))
    placed = ordered_scan(counts, ["value"], ["column", "point"], sums=["n"])
    # One row per column and probability.
    wanted = F.broadcast(df.sparkSession.createDataFrame(
        ranks, "column int, point int, total_n long, first long, second long, share double"))

    def at(index: str) -> Column:
        return F.max(F.when((F.col("cum_n") - F.col("n") <= F.col(index)) & (F.col(index) < F.col("cum_n")), F.col("value")))

    picked = placed.join(wanted, ["column", "point"]).groupBy("column", "point", "total_n", "share").agg(
        at("first").alias("low"), at("second").alias("high"))
    picked = picked.withColumn("quantile", F.col("low") + (F.col("high") - F.col("low")) * F.col("share"))
    wide_again = picked.groupBy("column", "total_n").agg(
        *[F.max(F.when(F.col("point") == j, F.col("quantile"))).alias(n) for j, (n, _) in enumerate(points)])
    feature = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("column") + 1)
    return wide_again.select(feature.alias("feature"), "total_n", *[n for n, _ in points])


def hash_key(column: Column, seed: int) -> Column:
    """60-bit key for a seeded shuffle order: the first 15 hex digits of md5('<id>:<seed>')."""
    digest = F.md5(F.concat(column.cast("string"), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


_KEY_BITS = 60
_STEP_BITS = 12


def hash_cuts(
    df: DataFrame,
    id_col: str,
    group_col: str,
    ranks: Mapping[object, Sequence[int]],
    seed: int,
    small: int = 100_000,
) -> dict[tuple[object, int], tuple[int, object]]:
    """(hash key, id) of the row at each wanted rank of the seeded order, per group.

    No sort of the table: each round counts rows per 12 more bits of the key inside the prefixes
    that hold a wanted rank, until such a prefix holds at most `small` rows; only those are ranked.
    The driver sees at most 4,096 counts per wanted rank and round.
    """
    keyed = df.select(
        F.col(group_col).alias("_g"), F.col(id_col).alias("_id"), hash_key(F.col(id_col), seed).alias("_k")
    )
    # Each wanted rank: the prefix it lies in and its rank inside that prefix.
    state = {(g, r): (0, r) for g, wanted in ranks.items() for r in wanted}
    if not state:
        return {}
    bits, largest = 0, math.inf
    while largest > small and bits < _KEY_BITS:
        shift = _KEY_BITS - bits
        inside = _any_prefix(state, shift)
        counts: dict[tuple[object, int], list[tuple[int, int]]] = {}
        found = (
            keyed.where(inside)
            .groupBy("_g", F.shiftright("_k", shift - _STEP_BITS).alias("_p"))
            .count()
            .collect()
        )
        for row in sorted(found, key=lambda r: r["_p"]):
            counts.setdefault((row["_g"], row["_p"] >> _STEP_BITS), []).append((row["_p"], row["count"]))
        largest = 0
        for (g, r), (prefix, rest) in state.items():
            for child, n in counts.get((g, prefix), []):
                if rest <= n:
                    state[(g, r)] = (child, rest)
                    largest = max(largest, n)
                    break
                rest -= n
            else:
                raise ValueError(f"rank {r} is beyond the rows of group {g!r}")
        bits += _STEP_BITS
    if largest > small:
        raise ValueError(f"{id_col} is not unique: many rows share one key")
    shift = _KEY_BITS - bits
    prefix = F.shiftright("_k", shift)
    ranked = (
        keyed.where(_any_prefix(state, shift))
        .withColumn("_p", prefix)
        .withColumn("_r", F.row_number().over(Window.partitionBy("_g", "_p").orderBy("_k", "_id")))
    )
    wanted_rows = [
        (F.col("_g") == F.lit(g)) & (F.col("_p") == F.lit(p)) & (F.col("_r") == F.lit(rest))
        for (g, _), (p, rest) in state.items()
    ]
    condition = wanted_rows[0]
    for extra in wanted_rows[1:]:
        condition = condition | extra
    at = {(row["_g"], row["_p"], row["_r"]): (row["_k"], row["_id"]) for row in ranked.where(condition).collect()}
    return {key: at[(key[0], p, rest)] for key, (p, rest) in state.items()}


def _any_prefix(state: Mapping, shift: int) -> Column:
    condition = F.lit(False)
    for group, prefix in sorted({(g, p) for (g, _), (p, _) in state.items()}, key=str):
        condition = condition | (
            (F.col("_g") == F.lit(group)) & (F.shiftright("_k", shift) == F.lit(prefix))
        )
    return condition


def at_or_before(key: Column, id_col: str, cut: tuple[int, object]) -> Column:
    """True for rows up to and with the cut row of the seeded order; `key` holds their hash key."""
    last_key, last_id = cut
    return (key < F.lit(last_key)) | ((key == F.lit(last_key)) & (F.col(id_col) <= F.lit(last_id)))
