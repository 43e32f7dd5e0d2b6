"""Every registered query of the engine and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandline.plans import interval_queries, kernel_queries, record_queries, relational_queries, scalar_queries, source_queries, summary_queries, workflow_queries  # noqa: F401  they register themselves
from strandline.plans.registry import QUERIES, SQL

FLAGSHIP = "I02_recurrent_loci"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
