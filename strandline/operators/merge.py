"""Update-or-insert by key, as a join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def merge_rows(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with whole rows replaced or added from ``updates``.

    ``updates`` holds one row per key. A null in a key matches nothing: such target rows stay
    and such update rows are added. Nothing is deleted and row times are not compared, so
    the batch merged last wins.
    """
    kept = target.join(updates.select(*keys), on=list(keys), how="left_anti")
    return kept.select(*target.columns).unionByName(updates.select(*target.columns))
