"""One row per key, and keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import comparable, named

_RANK = "__rank"
_AGE = "__age"


def total_order(field: T.StructField) -> Column:
    """A column to sort by; of a type without an order, its JSON text."""
    column = named(field.name)
    if comparable(field.dataType):
        return column
    return F.to_json(F.struct(column))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key by ``order``; NULL keys count as one key.

    With a total order the survivor does not depend on the layout. Spark plans
    ``row_number() = 1`` as a group limit before and after the shuffle, so each
    task ships at most one row per key: a key holding a third of all rows costs
    one row per input task.
    """
    spec = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(spec)).filter(F.col(_RANK) == 1).drop(_RANK)


def keep_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An arbitrary row of every key: cheaper to state, but depends on layout."""
    return df.dropDuplicates(list(keys))


def upsert_by_key(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]
) -> DataFrame:
    """A keyed table after updates: the newest row of every key.

    Where ``newest_first`` ties, an update replaces the target row, and of tied
    updates the largest in the other columns stays, whatever the layout. Only rows
    whose key is updated are compared. The other target rows pass through an
    anti-join on the update keys, each of which occurs once; when these are few,
    Spark broadcasts them and the target is not shuffled at all.
    """
    names = updates.select(*keys).distinct().alias("named")
    same = reduce(
        lambda a, b: a & b, [F.col(f"target.{k}").eqNullSafe(F.col(f"named.{k}")) for k in keys]
    )
    held = target.alias("target")
    untouched = held.join(names, same, "left_anti")
    touched = held.join(names, same, "left_semi").withColumn(_AGE, F.lit(1))
    ties = [total_order(f).desc() for f in target.schema.fields if f.name not in keys]
    newest = keep_first(
        touched.unionByName(updates.withColumn(_AGE, F.lit(0))), keys, [*newest_first, F.col(_AGE), *ties]
    )
    return untouched.unionByName(newest.drop(_AGE))
