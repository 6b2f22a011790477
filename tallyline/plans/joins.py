"""Join shapes that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def split_outer_join(base: DataFrame, facts: DataFrame, base_key: str, fact_key: str) -> DataFrame:
    """``base LEFT JOIN facts`` for a small side with unique keys kept and a large side looked up.

    A skewed key on the looked-up side of an outer join cannot be split at run time. The
    inner join can, and the rows without a match only need the distinct fact keys, which
    are combined before they are shuffled. Both frames must have disjoint column names.
    """
    matched = facts.join(base, F.col(fact_key) == F.col(base_key))
    keys = facts.where(F.col(fact_key).isNotNull()).select(F.col(fact_key).alias("_fact_key")).distinct()
    unmatched = base.join(keys, F.col(base_key) == F.col("_fact_key"), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
