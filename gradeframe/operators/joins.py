"""Pairing tables by key, also when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _exact(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def align(
    preds: DataFrame, refs: DataFrame, on: str | Sequence[str] = "id", how: str = "strict"
) -> DataFrame:
    """Pair predictions with references.

    A table has no positions, so ``on`` names the key that says which row belongs
    to which; it must be unique on both sides. ``strict`` fails if a row has no partner,
    ``matched`` drops such rows. A key with a NULL names no row, so its row has no partner.

    Both sides are read once, shuffled once and grouped by key, and the check is part of
    that plan: nothing runs when this is called, and the query fails at the first key that
    is wrong. Rows of a key are counted before the shuffle, so a key that is repeated
    however often fails the query rather than filling a task.
    """
    if how not in ("strict", "matched"):
        raise ValueError(f"unknown alignment {how!r}")
    keys = [on] if isinstance(on, str) else list(on)
    sides = {"__p": preds, "__r": refs}
    values = {side: [c for c in df.columns if c not in keys] for side, df in sides.items()}
    tagged = [
        df.select(
            *[_exact(k) for k in keys],
            F.struct(F.lit(True).alias("__here"), *[_exact(c) for c in values[side]]).alias(side),
        )
        for side, df in sides.items()
    ]
    met = (
        tagged[0]
        .unionByName(tagged[1], allowMissingColumns=True)
        .groupBy(*[_exact(k) for k in keys])
        .agg(
            *[F.count(side).alias(f"{side}_n") for side in sides],
            *[F.first(side, ignorenulls=True).alias(side) for side in sides],
        )
    )
    whole = reduce(Column.__and__, [_exact(k).isNotNull() for k in keys])
    name = F.concat_ws(", ", *[F.coalesce(_exact(k).cast("string"), F.lit("NULL")) for k in keys])

    def failed(text: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{text}: "), name)).cast("boolean")

    n_preds, n_refs = F.col("__p_n"), F.col("__r_n")
    alone = failed("predictions and references differ, unmatched key") if how == "strict" else F.lit(False)
    paired = (
        F.when(~whole, failed("a row has a NULL key") if how == "strict" else F.lit(False))
        .when((n_preds > 1) | (n_refs > 1), failed("a key occurs more than once on a side"))
        .when((n_preds == 0) | (n_refs == 0), alone)
        .otherwise(F.lit(True))
    )
    fields = [F.col(side)[c].alias(c) for side, names in values.items() for c in names]
    return met.filter(paired).select(*[_exact(k) for k in keys], *fields)


def left_lookup(df: DataFrame, lookup: DataFrame, on: str = "id", salts: int = 16) -> DataFrame:
    """Left join to a table with at most one row per key; several fail the query.

    Hashing by key alone would send all rows of a hot key to one task. So a row also gets
    one of ``salts`` salts, in turn by its place in its partition, a lookup row is repeated
    for each, and both are joined on key and salt: a key is split whatever its share of the
    rows, and however alike they are, by the same plan at any size. It costs ``salts``
    copies of the lookup table in its shuffle. Places are those in the order of two hashes of
    the row, so that a task which is run again deals out the same salts.
    """
    hashed = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.NumericType, T.BooleanType))
    ]
    rows = [_exact(c) for c in hashed]
    placed = df.sortWithinPartitions(F.xxhash64(*rows), F.hash(*rows)) if rows else df
    salted = placed.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    values = [c for c in lookup.columns if c != on]
    single = F.when(F.col("__n") == 1, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"the lookup table holds several rows for a value of {on!r}")).cast("boolean")
    )
    once = (
        lookup.filter(F.col(on).isNotNull())
        .groupBy(on)
        .agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(*values)).alias("__v"))
        .filter(single)
        .select(on, "__v.*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt"))
    )
    return salted.join(once, [on, "__salt"], "left").drop("__salt").select(*df.columns, *values)
