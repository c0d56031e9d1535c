"""One row per key: the newest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.contracts import INGESTED


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    newest: str | Sequence[str] = INGESTED,
    ties: Sequence[str] = (),
    within: Sequence[str] = (),
) -> DataFrame:
    """The row with the greatest ``newest`` per key, ``ties`` ascending settling draws.

    ``newest`` may be several columns, the first counting most. Rows can agree in them, so
    ``ties`` has to make the order total for the result to be repeatable. The rank is compared with 1 right away: Spark then
    cuts each key to one row per map task before the shuffle, which keeps a key that owns
    a large share of the rows from landing in one task. ``within`` names columns that the keys
    determine and by which the rows are dealt out already: they are then not dealt out again.
    """
    newest = [newest] if isinstance(newest, str) else newest
    order = [F.col(n).desc_nulls_last() for n in newest] + [F.col(t).asc_nulls_first() for t in ties]
    rank = F.row_number().over(Window.partitionBy(*within, *keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
