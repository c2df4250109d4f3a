"""Mixing documents to target weights by iterative proportional fitting."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import column, small, stored

_WORD = r"[^\x20\x09-\x0D]+"

# Raking ends when every share is this close to its goal, in parts of the goal.
TOLERANCE = 1e-9
MOST_SWEEPS = 20_000
_SWEEPS_A_LOOK = 4
# Factors for up to so many cells are worked out on the driver.
CELLS_ON_DRIVER = 200_000


def token_count(text: Column) -> Column:
    """Words between ASCII white space; a NULL text has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_WORD)).cast("bigint")


def topic_of(text: Column) -> Column:
    """A coarse topic by the first rule that holds: licensed, table, records or prose."""
    return (
        F.when(F.contains(text, F.lit("icensed under")) | F.contains(text, F.lit("MIT License")), F.lit("licensed"))
        .when(F.contains(text, F.lit(" | ")), F.lit("table"))
        .when(F.regexp_like(text, F.lit("[0-9]{4}")), F.lit("records"))
        .otherwise(F.lit("prose"))
    )


def tempered_targets(cells: DataFrame, margin: str, exponent: float) -> DataFrame:
    """Rows (margin, share): observed token shares, raised to a power that evens them out."""
    totals = cells.groupBy(margin).agg(F.sum("mass").alias("m")).filter("m > 0")
    raised = totals.select(margin, F.pow("m", F.lit(exponent)).alias("share"))
    return _shares(raised, "share")


def _shares(df: DataFrame, name: str) -> DataFrame:
    """Scale a column to sum 1; the sum is one number on the driver."""
    total = df.agg(F.sum(name).alias("n")).first().n
    return df.withColumn(name, F.col(name) / F.lit(total)) if total else df.filter(F.lit(False))


def _null_safe(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    met = F.lit(True)
    for name in names:
        met = met & left[name].eqNullSafe(right[name])
    return met


def rake(
    cells: DataFrame,
    targets: Mapping[str, DataFrame],
    sweeps: int | None = None,
    tolerance: float | None = None,
    on_driver: int = CELLS_ON_DRIVER,
) -> DataFrame:
    """Add ``weight`` to the cells: their tokens, raked until every margin has its share.

    ``cells`` are rows (margins..., mass); ``targets`` gives for each margin its rows
    (value, share), a NULL value being a value like others. A sweep scales the cells to one
    margin after the other; the error falls by a factor each time, which is large where
    the margins are nearly independent and close to 1 where each source is mostly of one
    language. Sweeps are made until no share is off by more than ``tolerance`` of its goal;
    if that does not come about in ``MOST_SWEEPS``, or the error no longer falls, as
    where the targets contradict each other, a warning tells by how much. With ``sweeps`` as many
    are made, fewer only if a ``tolerance`` is given too. Values without a
    target get weight 0, targets without tokens are left out, and the shares of the others
    are scaled up. Weights add up to 1.

    A weight is the mass of a cell times one factor for each of its values. What an
    iteration changes are the factors of one margin. Of up to ``on_driver`` cells (counted)
    the driver works the factors out. Of more, the cells meet the other margins'
    factors, are summed by value (partly before the shuffle), and goal over sum is written
    to the shared folder; a step reads the cells once, however many there have been.
    """
    cells = stored(cells, "cells")
    goals = {}
    for margin, shares in targets.items():
        seen = cells.filter("mass > 0").select(F.col(margin).alias("v")).distinct()
        known = shares.join(seen, shares[margin].eqNullSafe(seen["v"]), "left_semi")
        value = F.col(margin).cast(cells.schema[margin].dataType)
        goals[margin] = stored(_shares(known.select(value.alias("v"), F.col("share").alias("goal")), "goal"), "goals")
    steps = _DriverSteps if cells.count() <= on_driver else _TableSteps
    raking = steps(cells, goals)
    most = MOST_SWEEPS if sweeps is None else sweeps
    bound = TOLERANCE if sweeps is None and tolerance is None else tolerance
    _sweep(raking.sweep, raking.gap, most, bound)
    return _weighted(cells, raking.factors())


def _sweep(sweep: Callable[[], None], gap: Callable[[], float], most: int, tolerance: float | None) -> None:
    """Make sweeps until the gap is within the tolerance; warn if it is not in the end."""
    before = np.inf
    for n in range(1, most + 1):
        sweep()
        if tolerance is None or (n % _SWEEPS_A_LOOK and n < most):
            continue
        now = gap()
        if now <= tolerance:
            return
        if n == most or now > before * (1 - 1e-7):
            warnings.warn(f"after {n} sweeps a share is still off by {now:.3g} of its goal", stacklevel=3)
            return
        before = now


class _DriverSteps:
    """Sweeps over cells in arrays."""

    def __init__(self, cells: DataFrame, goals: Mapping[str, DataFrame]) -> None:
        rows = cells.select(*[F.col(m) for m in goals], F.col("mass").cast("double").alias("mass")).collect()
        self.session = cells.sparkSession
        self.mass = np.array([r[-1] or 0.0 for r in rows], np.float64)
        self.schemas = [goal.select("v").schema.add("factor", "double") for goal in goals.values()]
        self.margins = list(goals)
        self.values, self.goals, self.codes, self.scales = [], [], [], []
        for i, goal in enumerate(goals.values()):
            found = goal.collect()
            places = {repr(r.v): j for j, r in enumerate(found)}
            # The last place is for values without a target.
            self.codes.append(np.array([places.get(repr(r[i]), len(found)) for r in rows], np.int64))
            self.values.append([r.v for r in found])
            self.goals.append(np.array([*(r.goal for r in found), 0.0], np.float64))
            self.scales.append(np.array([1.0] * len(found) + [0.0]))

    def _totals(self, axis: int, but: int | None = None) -> np.ndarray:
        weights = self.mass.copy()
        for i, (code, scale) in enumerate(zip(self.codes, self.scales)):
            if i != but:
                weights *= scale[code]
        return np.bincount(self.codes[axis], weights, len(self.goals[axis]))

    def sweep(self) -> None:
        for axis, goal in enumerate(self.goals):
            totals = self._totals(axis, axis)
            self.scales[axis] = np.divide(goal, totals, out=np.zeros_like(goal), where=totals > 0)

    def gap(self) -> float:
        gaps = [np.abs(self._totals(i)[g > 0] / g[g > 0] - 1) for i, g in enumerate(self.goals)]
        return max((float(g.max()) for g in gaps if len(g)), default=0.0)

    def factors(self) -> dict[str, DataFrame]:
        return {
            m: self.session.createDataFrame([(v, float(f)) for v, f in zip(values, scale)], schema)
            for m, values, scale, schema in zip(self.margins, self.values, self.scales, self.schemas)
        }


class _TableSteps:
    """Sweeps over cells in a stored table."""

    def __init__(self, cells: DataFrame, goals: Mapping[str, DataFrame]) -> None:
        self.cells, self.goals = cells, goals
        self.current = {m: goal.select("v", F.lit(1.0).alias("factor")) for m, goal in goals.items()}

    def sweep(self) -> None:
        for margin, goal in self.goals.items():
            others = {m: f for m, f in self.current.items() if m != margin}
            totals = _weighted(self.cells, others).groupBy(F.col(margin).alias("t")).agg(F.sum("weight").alias("total"))
            scaled = goal.join(totals, goal["v"].eqNullSafe(totals["t"]), "left")
            self.current[margin] = stored(
                scaled.select("v", F.coalesce(F.try_divide("goal", "total"), F.lit(0.0)).alias("factor")), "factors"
            )

    def gap(self) -> float:
        return _largest_gap(_weighted(self.cells, self.current), self.goals)

    def factors(self) -> dict[str, DataFrame]:
        return self.current


def _weighted(cells: DataFrame, factors: Mapping[str, DataFrame]) -> DataFrame:
    """Cells with ``weight``, their mass times the factors of their values (0 where there is none)."""
    current = cells.withColumn("weight", F.col("mass").cast("double"))
    for margin, factor in factors.items():
        named = factor.select(F.col("v").alias("__v"), F.col("factor").alias("__factor"))
        scaled = F.col("weight") * F.coalesce("__factor", F.lit(0.0))
        current = current.join(named, F.col(margin).eqNullSafe(F.col("__v")), "left").select(
            *cells.columns, scaled.alias("weight")
        )
    return current


def _largest_gap(cells: DataFrame, goals: Mapping[str, DataFrame]) -> float:
    """How far the share of any value is from its goal, in parts of the goal."""
    gaps = []
    for margin, goal in goals.items():
        totals = cells.groupBy(F.col(margin).alias("t")).agg(F.sum("weight").alias("total"))
        met = goal.join(totals, totals["t"].eqNullSafe(goal["v"]), "left")
        off = F.try_divide(F.abs(F.coalesce("total", F.lit(0.0)) - F.col("goal")), "goal")
        gaps.append(met.agg(F.max(off).alias("gap")))
    return reduce(DataFrame.unionByName, gaps).agg(F.max("gap").alias("gap")).first().gap or 0.0


def mix(
    documents: DataFrame,
    margins: list[str],
    targets: Mapping[str, DataFrame] | None = None,
    key: str = "doc_id",
    text: str = "text",
    tokens: str = "n_tokens",
    exponent: float = 0.85,
    sweeps: int | None = None,
) -> DataFrame:
    """Add ``weight``, ``probability`` and ``sampled`` to documents with margins and tokens.

    Tokens are summed by cell (a combination of margin values), cells are raked to the
    targets (without any: observed shares to the power ``exponent``), and ``weight`` is
    what a token of the cell then counts against an average one. ``probability`` is the
    weight over the largest one, so that a sample has the target mix in expectation;
    ``sampled`` compares it with a fixed hash of the key (of the text, for a NULL key), so
    that every run picks the same rows. A document without tokens has weight NULL in a
    cell without tokens, and is not sampled. Columns of these three names are replaced. Rows are scanned twice and never shuffled, as
    long as the cells are few enough to be broadcast.
    """
    documents = documents.drop("weight", "probability", "sampled")
    cells = documents.groupBy(*margins).agg(F.coalesce(F.sum(tokens), F.lit(0)).alias("mass"))
    cells = stored(cells, "cells")
    if targets is None:
        targets = {m: tempered_targets(cells, m, exponent) for m in margins}
    raked = stored(rake(cells, targets, sweeps), "raked")
    share = F.try_divide("weight", "mass")
    sums = raked.agg(F.sum("mass").alias("all"), F.max(share).alias("top")).first()
    rates = raked.select(
        *margins,
        (share * F.lit(float(sums["all"] or 0))).alias("weight"),
        F.coalesce(F.try_divide(share, F.lit(sums["top"] or 0.0)), F.lit(0.0)).alias("probability"),
    )
    rates = small(rates, "rates")
    joined = documents.join(rates, _null_safe(documents, rates, margins), "left").drop(*[rates[m] for m in margins])
    seed = F.concat(F.lit("mix:"), F.coalesce(column(documents, key).cast("string"), column(documents, text), F.lit("")))
    chance = F.conv(F.substring(F.md5(seed), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
    return joined.withColumn("sampled", chance < F.col("probability"))


def with_margins(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add ``topic`` and ``n_tokens``, replacing columns of these names."""
    value = column(documents, text)
    return documents.withColumns({"topic": F.coalesce(topic_of(value), F.lit("prose")), "n_tokens": token_count(value)})
