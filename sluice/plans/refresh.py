"""Marts kept up to date by what a load added, instead of a full rebuild.

*User activity.*  A row of the mart is a function of the sessions of one day, so that the
sessions table and the mart are both partitioned by day: a load adds its sessions, and
only the days it touched are read again and replaced in the mart.

*Support efficiency.*  Its figures come from counters that add up (tickets, open tickets,
hours and tickets with hours by issue type and status): a load adds the counters of its
tickets to the stored ones, without reading any ticket again.  The counters are a
versioned table, so that a load is added once or not at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from sluice.operators.loads import new_rows_if_absent, read_or_empty, written_once
from sluice.operators.versioned import VersionedTable
from sluice.plans.support import user_activity_mart
from sluice.schemas import USER_ACTIVITY_MART, USER_SESSIONS_RAW

SESSIONS_BY_DAY = StructType([*USER_SESSIONS_RAW.fields, StructField("day", DateType())])
COUNTERS = "issue_type string, status string, tickets long, timed long, hours double"


def _write_days(df: DataFrame, path: str, by: str, mode: str) -> None:
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def _of_days(df: DataFrame, days: DataFrame, column: str) -> DataFrame:
    """Rows of the given days: pruned by the least and largest, exact by a null-safe semi
    join (sessions without a start have the NULL day)."""
    low, high, null = (days.select(f).scalar() for f in (F.min("day"), F.max("day"), F.max(F.col("day").isNull())))
    c = F.col(column)
    other = days.select(F.col("day").alias("_day"))
    return df.where((c >= low) & (c <= high) | c.isNull() & null).join(other, c.eqNullSafe(F.col("_day")), "left_semi")


def add_sessions(spark: SparkSession, batch: DataFrame, sessions_path: str, mart_path: str) -> int:
    """Adds the sessions the table does not hold (by ``session_id``) and refreshes the
    mart of the days they fall on.  Returns how many days that were."""
    batch = batch.select(*USER_SESSIONS_RAW.names).withColumn("day", F.to_date("start_time"))
    held = read_or_empty(spark, sessions_path, SESSIONS_BY_DAY)
    with written_once(spark, new_rows_if_absent(held, batch, ["session_id"], ["start_time"]).select(*SESSIONS_BY_DAY.names), "sessions-new") as new:
        with written_once(spark, new.select("day").distinct(), "days") as days:
            touched = days.count()
            if not touched:
                return 0
            _write_days(new, sessions_path, "day", "append")
            refresh_days(spark, days, sessions_path, mart_path)
            return touched


def refresh_days(spark: SparkSession, days: DataFrame, sessions_path: str, mart_path: str) -> None:
    """Replaces the given days (column ``day``) of the mart.  It may be run again after a
    load that died between its two writes."""
    sessions = _of_days(read_or_empty(spark, sessions_path, SESSIONS_BY_DAY), days, "day").drop("day")
    _write_days(user_activity_mart(sessions), mart_path, "activity_date", "overwrite")


def read_activity(spark: SparkSession, mart_path: str) -> DataFrame:
    return read_or_empty(spark, mart_path, USER_ACTIVITY_MART).select(*USER_ACTIVITY_MART.names)


def _counters(tickets: DataFrame) -> DataFrame:
    hours = F.col("resolution_time_hours")
    # a NULL group gets the empty text, as a key holds no NULL
    return tickets.groupBy(F.coalesce("issue_type", F.lit("")).alias("issue_type"), F.coalesce("status", F.lit("")).alias("status")).agg(
        F.count(F.lit(1)).alias("tickets"), F.count(hours).alias("timed"), F.coalesce(F.sum(hours), F.lit(0.0)).alias("hours")
    )


def counters_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, StructType.fromDDL(COUNTERS), ["issue_type", "status"])


def add_tickets(spark: SparkSession, new_tickets: DataFrame, counters_path: str) -> int:
    """Adds the counters of tickets that were not counted before; the new version."""
    t = counters_table(spark, counters_path)
    both = t.read().unionByName(_counters(new_tickets))
    return t.replace(both.groupBy("issue_type", "status").agg(*[F.sum(c).alias(c) for c in ("tickets", "timed", "hours")]))


def read_efficiency(spark: SparkSession, counters_path: str) -> DataFrame:
    """The support efficiency mart from its counters."""
    c = counters_table(spark, counters_path).read()
    return c.select(
        F.nullif("issue_type", F.lit("")).alias("issue_type"), F.nullif("status", F.lit("")).alias("status"),
        F.col("tickets").alias("ticket_count"),
        F.when(F.col("timed") > 0, F.col("hours") / F.col("timed")).alias("avg_resolution_hours"),
        F.when(F.col("status") == "open", F.col("tickets")).otherwise(F.lit(0).cast("long")).alias("open_tickets"),
    )
