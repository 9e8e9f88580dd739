"""Exact order statistics of many columns by closing intervals, without a sort of the values.

A sketch of each column proposes a few values around every wanted place. One pass with map-side combine then counts
the rows at and between the proposed values, which tells for sure where each place lies: on a proposed value, which
decides it, or strictly between two of them. A gap with few rows is grouped by value and ranked; of a wider one the
rows inside are sketched again, and each round closes it some three hundred times. The sketches only propose, the
counts decide. The driver keeps a few numbers for each place wanted.
"""

from __future__ import annotations

import math
import sys
from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmood.functions.scalars import to_double

Rational = tuple[int, int]

#: Steps of the sketched grid, and the sketch's accuracy (a tenth of a step).
GRID = 1_000
ACCURACY = 10 * GRID
#: Rows of a gap that are ranked as they are.
FEW = 20_000
LARGEST = sys.float_info.max


def grid_of(column: str) -> Column:
    """A sketch of the column: the values at all steps of the grid, nearly."""
    return F.percentile_approx(column, [i / GRID for i in range(GRID + 1)], ACCURACY)


def _grid() -> Column:
    return grid_of("value").alias("grid")


def _proposed(place: int, count: int, grid: list[float]) -> set[float]:
    """The grid's values a step and more around a place among ``count`` values."""
    step = place * GRID // count
    return {grid[max(0, step - 1)], grid[min(GRID, step + 2)]}


def proposed_values(places: set[int], count: int, grid: list[float]) -> set[float]:
    """What a column's sketch proposes for all its places."""
    return set().union(*[_proposed(place, count, grid) for place in places])


def numbers_of(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles that a search can compare: one zero, and the largest numbers for the infinities."""
    held = {c: F.least(F.greatest(to_double(c), F.lit(-LARGEST)), F.lit(LARGEST)) + F.lit(0.0) for c in columns}
    return frame.select(*[F.when(to_double(c).isNotNull(), x).alias(c) for c, x in held.items()])


def reached(frame: DataFrame, edges: dict[str, Sequence[float]]) -> DataFrame:
    """(feature, position, reached, value) per value: how many of its column's edges lie at or below it.

    A binary search per value (``Bucketizer``); the edges of a column are distinct and in order.
    """
    names = [c for c, own in edges.items() if len(own)]
    counted = frame
    if names:
        splits = [[float("-inf"), *edges[c], float("inf")] for c in names]
        counted = Bucketizer(
            splitsArray=splits, inputCols=names, outputCols=[f"reached {c}" for c in names], handleInvalid="keep"
        ).transform(frame)
    entries = [
        F.struct(
            F.lit(c).alias("feature"), F.lit(i + 1).alias("position"),
            (F.col(f"reached {c}").cast("int") if c in names else F.lit(0)).alias("reached"), F.col(c).alias("value"),
        )
        for i, c in enumerate(edges)
    ]
    return counted.select(F.inline(F.array(*entries))).where(F.col("value").isNotNull())


def _cells(frame: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """(feature, cell, value) per value: cell 2i + 1 is edge i itself, cell 2i lies below it and above the one before."""
    all_edges = F.array(*[F.array(*map(F.lit, own)) for own in edges.values()])
    edge = F.get(F.element_at(all_edges, F.col("position")), F.col("reached") - 1)
    on_edge = F.coalesce(F.col("value") == edge, F.lit(False)).cast("int")
    return reached(frame, edges).select("feature", (2 * F.col("reached") - on_edge).alias("cell"), "value")


def _among(names: dict[str, set[int]]) -> Column:
    chosen = F.lit(False)
    for name, cells in names.items():
        chosen = chosen | (F.col("feature") == name) & F.col("cell").isin(*cells)
    return chosen


def values_at(
    frame: DataFrame, places: dict[str, set[int]], proposed: dict[str, set[float]]
) -> dict[tuple[str, int], float]:
    """The value at each place (from 0) in the order of each column's values; any proposed values do, good ones sooner."""
    found: dict[tuple[str, int], float] = {}
    while places:
        edges = {c: sorted(proposed[c]) for c in places}
        counts = _cells(frame, edges).groupBy("feature", "cell").agg(F.count(F.lit(1)).alias("n")).collect()
        few: dict[str, set[int]] = {}
        wide: dict[str, set[int]] = {}
        inside: dict[tuple[str, int], list[tuple[int, int]]] = {}
        size: dict[tuple[str, int], int] = {}
        for name, own in edges.items():
            cells = sorted((r.cell, r.n) for r in counts if r.feature == name)
            upto = list(accumulate(n for _, n in cells))
            for place in places[name]:
                i = bisect_right(upto, place)
                cell, n = cells[i]
                if cell % 2:
                    found[name, place] = own[cell // 2]
                else:
                    (few if n <= FEW else wide).setdefault(name, set()).add(cell)
                    inside.setdefault((name, cell), []).append((place, place - (upto[i] - n)))
                    size[name, cell] = n
        if few:
            # at most FEW rows of each gap
            upto = F.sum("n").over(Window.partitionBy("feature", "cell").orderBy("value"))
            values = _cells(frame, edges).where(_among(few)).groupBy("feature", "cell", "value").agg(F.count(F.lit(1)).alias("n"))
            want = F.array(
                *[
                    F.struct(F.lit(c).alias("feature"), F.lit(k).alias("cell"), F.lit(p).alias("place"), F.lit(at).alias("at"))
                    for c, cells in few.items() for k in cells for p, at in inside[c, k]
                ]
            )
            held = F.filter(
                want,
                lambda w: (w["feature"] == F.col("feature")) & (w["cell"] == F.col("cell"))
                & (w["at"] < F.col("upto")) & (w["at"] >= F.col("upto") - F.col("n")),
            )
            ranked = values.withColumn("upto", upto).select("value", F.explode(held).alias("w"))
            for r in ranked.collect():
                found[r.w.feature, r.w.place] = r.value
        places = {}
        if wide:
            sketched = _cells(frame, edges).where(_among(wide)).groupBy("feature", "cell").agg(_grid()).collect()
            proposed = {c: set() for c in wide}
            for r in sketched:
                for place, at in inside[r.feature, r.cell]:
                    places.setdefault(r.feature, set()).add(place)
                    proposed[r.feature] |= _proposed(at, size[r.feature, r.cell], r.grid)
    return found


def column_quantiles(frame: DataFrame, columns: Sequence[str], quantiles: Sequence[Rational]) -> list[tuple[str, int, list[float]]]:
    """(column, rows, interpolated quantiles) for each column that has a value.

    Place q * (n - 1) is taken in whole numbers: a quantile that falls on a row is exactly that row's value. Nulls are
    left out, and so are columns without a value.
    """
    if not columns:
        return []
    numbers = numbers_of(frame, columns)
    sketched = (
        numbers.unpivot([], list(columns), "feature", "value").where(F.col("value").isNotNull())
        .groupBy("feature").agg(F.count(F.lit(1)).alias("n"), _grid())
    ).collect()
    rows = {r.feature: r.n for r in sketched}
    places: dict[str, set[int]] = {}
    proposed: dict[str, set[float]] = {}
    for r in sketched:
        lows = {num * (r.n - 1) // den for num, den in quantiles}
        places[r.feature] = lows | {min(at + 1, r.n - 1) for at in lows}
        proposed[r.feature] = proposed_values(places[r.feature], r.n, r.grid)
    value = values_at(numbers, places, proposed)
    value = {at: math.copysign(math.inf, v) if abs(v) == LARGEST else v for at, v in value.items()}
    out = []
    for c in columns:
        if c not in rows:
            continue
        found = []
        for num, den in quantiles:
            at, part = divmod(num * (rows[c] - 1), den)
            low, high = value[c, at], value[c, min(at + 1, rows[c] - 1)]
            found.append(low + (high - low) * (part / den))
        out.append((c, rows[c], found))
    return out
