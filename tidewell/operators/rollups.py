"""Rollups kept up to date by delta rules, on stored partial states.

A state row holds a group's number of rows and, for each measure, the number of its values and their sum. A
row that a table gained adds to its group, a row it lost is subtracted from the group it was in; a changed row
is one of each, so a key that moves between groups leaves one and enters the other. Groups without rows
go. A refresh reads the changes since the last one and the states, never the table.

Sums are decimals, so that subtracting restores them: values count to nine decimal places and up to 10^20.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .buckets import MergeTable
from .files import Versions

_EXACT = "decimal(38,9)"


@dataclass(frozen=True)
class Rollup:
    """Groups, measures to sum (name -> column), and the view's columns from a state."""

    groups: list[str]
    measures: dict[str, str] = field(default_factory=dict)
    view: Callable[[DataFrame], DataFrame] = lambda state: state

    def delta(self, changes: DataFrame) -> DataFrame:
        """State of rows with a ``_sign``; combined before the shuffle."""
        sign = F.col("_sign").cast("long")
        states: list[Column] = [F.sum(sign).alias("rows")]
        for name, column in self.measures.items():
            value = F.col(f"`{column}`")
            states.append(F.sum(F.when(value.isNotNull(), sign)).alias(f"n_{name}"))
            states.append(F.sum(value.cast("decimal(29,9)") * F.col("_sign")).cast(_EXACT).alias(f"s_{name}"))
        return changes.groupBy(*self.groups).agg(*states)

    def merged(self, states: DataFrame) -> DataFrame:
        sums = [F.sum("rows").alias("rows")]
        for name in self.measures:
            sums += [F.sum(F.coalesce(f"n_{name}", F.lit(0))).alias(f"n_{name}"), F.sum(f"s_{name}").cast(_EXACT).alias(f"s_{name}")]
        return states.groupBy(*self.groups).agg(*sums).where(F.col("rows") > 0)

    def total(self, name: str) -> Column:
        """Sum of a measure; null without values, as in SQL."""
        return F.when(F.col(f"n_{name}") > 0, F.col(f"s_{name}").cast("double"))

    def mean(self, name: str) -> Column:
        return F.when(F.col(f"n_{name}") > 0, F.col(f"s_{name}").cast("double") / F.col(f"n_{name}"))


class MaintainedRollup:
    """A rollup's states as versions below ``path``, numbered by the generation of the table they are of."""

    def __init__(self, spark: SparkSession, path: str, rollup: Rollup):
        self.rollup, self.states = rollup, Versions(spark, path)
        self.spark = spark

    def state(self) -> DataFrame | None:
        newest = self.states.newest()
        return None if newest is None else self.spark.read.parquet(self.states.path(newest))

    def refresh(self, table: MergeTable) -> None:
        """Bring the states to the table's last merge; from the whole table if changes since were vacuumed."""
        through, known = table.merged_through(), self.states.newest()
        if known == through or not through:
            return
        changes = table.changes(known or 0)
        if changes is None:
            known, changes = None, table.read().withColumn("_sign", F.lit(1))
        states = self.rollup.delta(changes)
        if known:
            states = self.spark.read.parquet(self.states.path(known)).unionByName(states)
        self.states.write(self.rollup.merged(states).hint("rebalance"), through)

    def read(self) -> DataFrame:
        """The view as of the last refresh."""
        state = self.state()
        if state is None:
            raise ValueError("the rollup has not been refreshed yet")
        return self.rollup.view(state)
