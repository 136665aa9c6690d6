"""Data-quality checks as (check, violations) rows, and the gate over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from omnibus.operators.access import RELATIONSHIPS
from omnibus.operators.dedupe import repeated_keys


class QualityGateFailed(RuntimeError):
    """``violations`` has the number of rows that break each check."""

    def __init__(self, violations: dict[str, int]):
        super().__init__(", ".join(f"{check}: {n}" for check, n in violations.items()))
        self.violations = violations


class Watch:
    """Row-level checks counted by whatever job reads ``rows``, without a scan of their own."""

    def __init__(self, df: DataFrame, rules: dict[str, Column] | None):
        self._names, self._seen, self.rows = list(rules or ()), None, df
        if rules:
            self._seen = Observation()
            self.rows = df.observe(self._seen, *[F.count_if(bad).alias(f"c{i}") for i, bad in enumerate(rules.values())])

    def counts(self) -> dict[str, int]:
        """Violating rows of each check, once a job has read the rows."""
        return {name: self._seen.get[f"c{i}"] for i, name in enumerate(self._names)}

    def check(self) -> None:
        """Stop what would follow the job if any check found violations."""
        if found := {name: n for name, n in self.counts().items() if n}:
            raise QualityGateFailed(found)


def count_rows(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Violating rows of several row-level checks in one scan, one output row per check."""
    counted = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, bad in enumerate(checks.values())])
    rows = [
        F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("violations"))
        for i, name in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def _total(name: str, bad: DataFrame) -> DataFrame:
    return bad.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")


def unique_key(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of keys that occur more than once; NULL keys are the not-null check's."""
    known = df.dropna(subset=keys)
    return _total(name, repeated_keys(known, keys))


def orphans(name: str, facts: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Facts with a value that the one side does not hold.

    Values are counted before the join, so a hot one is a single row.
    """
    values = facts.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(
        F.count("*").alias("_n")
    )
    missing = values.join(dim.select(F.col(key).alias("_v")), "_v", "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")).select(
        F.lit(name).alias("check"), "violations"
    )


def relationship_orphans(model: dict[str, DataFrame], tables: set[str]) -> list[DataFrame]:
    """One check per relationship between the given tables."""
    return [
        orphans(f"orphan {many}.{column}", model[many], column, model[one], key)
        for many, column, one, key in RELATIONSHIPS
        if many in tables and one in tables
    ]


def together(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def gate(results: DataFrame, warn_only: str = "orphan") -> None:
    """Fail the run if any check found violations; orphan checks only warn."""
    failed = results.where((F.col("violations") > 0) & ~F.startswith("check", F.lit(warn_only)))
    found = failed.collect()  # one row per check
    if found:
        raise QualityGateFailed({r["check"]: r["violations"] for r in found})
