"""The views that can be kept up to date: rollups by signed changes, activity by increments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import epoch_key, epoch_text
from ..operators.distinct import DistinctCounts
from ..operators.files import Versions
from ..operators.joins import join_on
from ..operators.rollups import Rollup


def _counted(groups: list[str], name: str) -> Rollup:
    return Rollup(groups, view=lambda state: state.select(*groups, F.col("rows").alias(name)))


def _stages() -> Rollup:
    rollup = Rollup(["StageName"], {"amount": "Amount", "probability": "Probability"}, lambda state: state.select(
        "StageName", F.col("rows").alias("deal_count"), rollup.total("amount").alias("total_amount"),
        rollup.mean("amount").alias("avg_amount"), rollup.mean("probability").alias("avg_probability"),
    ))
    return rollup


#: The published rollups by table, as delta rules.
ROLLUPS: dict[str, Rollup] = {
    "Opportunity": _stages(),
    "Lead": _counted(["Status", "LeadSource", "Rating"], "lead_count"),
    "Case": _counted(["Status", "Priority", "Origin", "Type"], "case_count"),
    "engagements": _counted(["hs_engagement_type", "hs_engagement_source"], "engagement_count"),
    "tickets": _counted(["hs_ticket_priority", "hs_ticket_category", "hs_pipeline_stage"], "ticket_count"),
}


class Activity:
    """Channel or user activity over increments of messages, which are only ever added.

    Counts, sums and extremes are a row per group; distinct users or channels are bitmaps. Both are
    versions by increment, and the smaller of their numbers is what a read shows.
    """

    def __init__(self, spark: SparkSession, path: str, groups: list[str], value: str, unique: str, sums: dict[str, str] | None = None):
        self.spark, self.groups, self.unique, self.sums = spark, groups, unique, sums or {}
        self.distinct = DistinctCounts(spark, f"{path}/distinct", groups, value)
        self.states = Versions(spark, f"{path}/states")

    def _merged(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy(*self.groups).agg(
            F.sum("n").alias("n"), F.max("latest").alias("latest"), F.min("earliest").alias("earliest"), *[F.sum(s).alias(s) for s in self.sums]
        )

    def add(self, messages: DataFrame) -> int:
        """Count an increment in; repeating one that died replaces what it left."""
        known = self.states.newest()
        number = 1 if known is None else known + 1
        if (self.distinct.states.newest() or 0) < number:
            self.distinct.add(messages)
        stamp = epoch_key(F.col("message_ts"))
        parts = messages.groupBy(*self.groups).agg(
            F.count(F.lit(1)).alias("n"), F.max(stamp).alias("latest"), F.min(stamp).alias("earliest"), *[F.sum(c).alias(s) for s, c in self.sums.items()]
        )
        if known is not None:
            parts = self.spark.read.parquet(self.states.path(known)).unionByName(parts)
        self.states.write(self._merged(parts), number)
        return number

    def read(self) -> DataFrame:
        newest = self.states.newest()
        if newest is None:
            raise ValueError("nothing has been counted yet")
        state = self.spark.read.parquet(self.states.path(newest))
        blank = [F.coalesce(F.col(g).cast("string"), F.lit("")) for g in self.groups]
        null = [F.col(g).isNull() for g in self.groups]
        # null groups are groups too, so the join is on text that tells them apart
        keyed = [x.withColumn("_group", F.to_json(F.array(*blank))).withColumn("_nulls", F.to_json(F.array(*null))) for x in (state, self.distinct.counts(self.unique))]
        joined = join_on(keyed[0], keyed[1].select("_group", "_nulls", self.unique), ["_group", "_nulls"], "left")
        return joined.select(
            *self.groups, F.col("n").alias("message_count"), F.coalesce(self.unique, F.lit(0)).alias(self.unique),
            epoch_text(F.col("latest")).alias("latest_message_ts"), epoch_text(F.col("earliest")).alias("earliest_message_ts"), *self.sums,
        )


def channel_activity(spark: SparkSession, path: str) -> Activity:
    return Activity(spark, path, ["channel_name", "channel_id"], "user_id", "unique_users", {"total_replies": "reply_count", "total_files": "file_count"})


def user_activity(spark: SparkSession, path: str) -> Activity:
    return Activity(spark, path, ["user_id"], "channel_id", "channels_active")
