"""Join helpers whose semantics need care at scale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def anti_join_not_in(left: DataFrame, right: DataFrame, left_key: str, right_key: str, null_aware: bool = True) -> DataFrame:
    """``left WHERE left_key NOT IN (SELECT right_key FROM right)``.

    Planned as a shuffled (or AQE-broadcast) left anti join on the key, not
    as Spark's null-aware anti join, which must broadcast the whole right
    side. ``null_aware=True`` keeps SQL's NOT IN rules on top: any null on
    the right empties the result, and a null left key survives only when
    the right side is empty. Both facts come from one scalar aggregate of
    the right side. With ``null_aware=False`` it is a plain NOT EXISTS.
    """
    keys = right.select(F.col(right_key).alias("_rk")).where(F.col("_rk").isNotNull()).distinct()
    out = left.join(keys, left[left_key] == keys["_rk"], "left_anti")
    if not null_aware:
        return out
    stats = right.agg(
        F.count_if(F.col(right_key).isNull()).alias("_nulls"), F.count(F.lit(1)).alias("_rows")
    )
    nulls = stats.select("_nulls").scalar()
    rows = stats.select("_rows").scalar()
    return out.where((nulls == 0) & (F.col(left_key).isNotNull() | (rows == 0)))
