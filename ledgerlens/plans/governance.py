"""Questions about the tables themselves."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerlens.operators.columns import tagged
from ledgerlens.operators.filters import with_prefix


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named table; a count of stored files reads no column."""
    counts = [
        tagged(df.agg(F.count(F.lit(1)).alias("rows")), name).select("tbl", "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def latest_lineage(edges: DataFrame, prefix: str, k: int = 20) -> DataFrame:
    """Most recent lineage edges into tables whose full name starts with ``prefix``."""
    return (
        with_prefix(edges, "target_table_full_name", prefix)
        .select("source_table_full_name", "target_table_full_name", "created_at")
        .orderBy(F.desc("created_at"), "target_table_full_name", "source_table_full_name")
        .limit(k)
    )


def visible_counts(views: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Rows and columns each role sees, from ``{role: {table: view}}``."""
    parts = [
        tagged(table_counts({name: view}), role, "role").select(
            "role", "tbl", "rows", F.lit(len(view.columns)).alias("columns")
        )
        for role, tables in views.items()
        for name, view in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts)
