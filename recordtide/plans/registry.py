"""Registry of the check queries: a Spark plan and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under an operator's name."""

    def register(plan: Plan) -> Plan:
        PLANS[name] = plan
        if sql:
            SQL[name] = sql
        return plan

    return register
