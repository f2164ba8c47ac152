"""Joins of rows with what is known of their group, where one group may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A group with over one in ``HOT`` of all rows is broadcast; there are fewer than ``HOT`` of them.
HOT = 10_000


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """``rows`` left-joined with ``groups`` (one row a key, at least one more column besides ``size``).

    ``size`` is how many rows a group has and ``total`` how many there are in all, so that no more than ``HOT`` groups
    are broadcast to their rows; the rows of all others are shuffled by key, at most one in ``HOT`` of them to one key.
    ``size`` is not in the result. Keys and ``size`` are never null.
    """
    least = F.lit(total / HOT)
    told = [c for c in groups.columns if c not in (*keys, size)]
    hot = groups.where(F.col(size) > least).select(*keys, *told, F.lit(True).alias("__hot"))
    marked = rows.join(F.broadcast(hot), keys, "left")
    rest = marked.where("__hot IS NULL").select(*rows.columns).join(groups.where(F.col(size) <= least).drop(size), keys, "left")
    return marked.where("__hot").select(*rows.columns, *told).unionByName(rest.select(*rows.columns, *told))
