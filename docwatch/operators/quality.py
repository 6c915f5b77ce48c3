"""Constraint checks: one row per rule with the number of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row_rules(table: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """All per-row rules in one pass."""
    bad = table.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    names = ", ".join(f"'{n}', `{n}`" for n in rules)
    return bad.selectExpr(f"stack({len(rules)}, {names}) AS (rule, violations)")


def _duplicates(table: DataFrame, column: str, rule: str) -> DataFrame:
    """Number of values that occur more than once."""
    repeated = (
        table.filter(F.col(column).isNotNull()).groupBy(column).count().filter(F.col("count") > 1)
    )
    return repeated.agg(F.count("*").alias("violations")).select(F.lit(rule).alias("rule"), "violations")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def check_items(items: DataFrame) -> DataFrame:
    """``rule, violations`` for the items table."""
    rules = {
        f"{c} is null": F.col(c).isNull()
        for c in ("id", "src", "ts", "entities", "topics", "keywords")
    }
    rules["lang_conf outside 0..1"] = ~F.col("lang_conf").between(0, 1)
    return _union(
        [
            _row_rules(items, rules),
            _duplicates(items, "id", "id repeated"),
            _duplicates(items, "url", "url repeated"),
        ]
    )


def check_clusters(clusters: DataFrame) -> DataFrame:
    """``rule, violations`` for the clusters table."""
    rules = {
        f"{c} is null": F.col(c).isNull()
        for c in ("cluster_id", "start_ts", "size", "score", "rep_item_ids")
    }
    return _union(
        [
            _row_rules(clusters, rules),
            _duplicates(clusters, "cluster_id", "cluster_id repeated"),
        ]
    )
