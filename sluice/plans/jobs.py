"""End-to-end jobs: the reference pipelines from source files to sinks.

Each job is a thin composition of the sources, plan functions and load modes;
the heavy lifting stays in the lazy DataFrame plans.  Paths may be any Hadoop
URI (HDFS, object store); nothing is staged on a machine-local folder.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.loads import (
    append_load,
    counted,
    insert_if_absent_to_path,
    read_or_empty,
    replace_load,
    upsert_to_path,
    write_csv,
    write_messages,
    written_once,
)
from sluice.plans.documents import nutrition_flat, pet_rows
from sluice.plans.loans import loan_details, loan_region_stats, read_loans
from sluice.plans.messages import decode_messages, encode_messages
from sluice.plans.readings import incremental_batch, prepare_readings, temp_daily_full, temp_extremes
from sluice.plans.support import replicate_sessions, replicate_tickets, support_efficiency_mart, user_activity_mart, user_ids
from sluice.schemas import (
    FOOD_XML,
    PETS_DOCUMENT,
    SUPPORT_TICKET_DOC,
    SUPPORT_TICKETS,
    TEMP_DAILY,
    TEMP_DAILY_BY_MONTH,
    TEMP_READINGS,
    USER_SESSION_DOC,
    USER_SESSIONS_RAW,
    USERS,
)
from sluice.sources.files import read_csv, read_table, with_read_order
from sluice.sources.json_records import read_json_records
from sluice.sources.xml_records import read_root_records
from sluice.streaming.messages import decode_stream, run_available_now


# X1, X2 — documents appended to flat tables (K1: a rerun appends again)
def load_pets(spark: SparkSession, json_path: str, table_path: str) -> int:
    records = read_json_records(spark, json_path, "pets", PETS_DOCUMENT["pets"].dataType.elementType)
    rows, n = counted(pet_rows(records))
    append_load(rows, table_path)
    return n()


def load_nutrition(spark: SparkSession, xml_path: str, table_path: str) -> int:
    rows, n = counted(nutrition_flat(read_root_records(spark, xml_path, "food", FOOD_XML)))
    append_load(rows, table_path)
    return n()


# X3, X4 — readings CSV -> extremes / full daily table (K2 replace)
def _readings(spark: SparkSession, csv_path: str) -> DataFrame:
    return prepare_readings(read_csv(spark, csv_path, TEMP_READINGS))


def load_temp_extremes(spark: SparkSession, csv_path: str, table_path: str) -> None:
    replace_load(temp_extremes(_readings(spark, csv_path)), table_path)


def load_temp_daily_full(spark: SparkSession, csv_path: str, table_path: str) -> None:
    daily = temp_daily_full(_readings(spark, csv_path)).withColumn("month", F.date_format("date", "yyyy-MM"))
    replace_load(daily, table_path, partition_by=["month"])


# X5 — incremental upsert into the keyed daily table, month partitions
def load_temp_daily_incremental(
    spark: SparkSession, csv_path: str, table_path: str, days_back: int = 7, as_of: str | None = None
) -> int:
    """Only the months the new days fall into are rewritten; an empty slice
    (nothing newer than the cutoff, or everything trimmed) writes nothing."""
    as_of = as_of or _dt.date.today().isoformat()
    schema = TEMP_DAILY_BY_MONTH
    target = read_or_empty(spark, table_path, schema)
    batch = incremental_batch(target.select(*TEMP_DAILY.names), _readings(spark, csv_path), as_of, days_back)
    batch = batch.withColumn("month", F.date_format("date", "yyyy-MM"))
    with written_once(spark, batch, "daily-batch") as batch:
        return 0 if batch.isEmpty() else upsert_to_path(spark, batch, table_path, ["date"], ["month"], schema)


# X6, X7 — document collections -> relational tables (K4), users first
def replicate_sessions_job(spark: SparkSession, source: str, users_path: str, sessions_path: str, fmt: str = "json") -> int:
    """Empty source: stop, write nothing.  Users are loaded before sessions
    (parent before child), both insert-if-absent."""
    docs = read_table(spark, fmt, source, USER_SESSION_DOC)
    if docs.isEmpty():
        return 0
    with written_once(spark, replicate_sessions(with_read_order(docs)), "sessions") as sessions:
        _add_users(spark, users_path, sessions)
        return insert_if_absent_to_path(spark, sessions, sessions_path, ["session_id"], USER_SESSIONS_RAW, unique=True)


def _add_users(spark: SparkSession, users_path: str, *feeds: DataFrame) -> int:
    """U2 + K4: users of all feeds that the table does not hold yet."""
    return insert_if_absent_to_path(spark, user_ids(*feeds), users_path, ["user_id"], USERS, unique=True)


def replicate_tickets_job(spark: SparkSession, source: str, users_path: str, tickets_path: str, fmt: str = "json") -> int:
    docs = read_table(spark, fmt, source, SUPPORT_TICKET_DOC)
    if docs.isEmpty():
        return 0
    with written_once(spark, replicate_tickets(with_read_order(docs)), "tickets") as tickets:
        _add_users(spark, users_path, tickets)
        return insert_if_absent_to_path(spark, tickets, tickets_path, ["ticket_id"], SUPPORT_TICKETS, unique=True)


# X8, X9 — mart rebuilds (K5)
def rebuild_marts(spark: SparkSession, sessions_path: str, tickets_path: str, activity_path: str, efficiency_path: str) -> None:
    sessions = read_or_empty(spark, sessions_path, USER_SESSIONS_RAW)
    tickets = read_or_empty(spark, tickets_path, SUPPORT_TICKETS)
    replace_load(user_activity_mart(sessions), activity_path)
    replace_load(support_efficiency_mart(tickets), efficiency_path)


# X10, X11 — loans CSV -> details + region stats CSV (K6)
def loans_job(spark: SparkSession, input_path: str, output_path: str, as_of: str | None = None) -> int:
    """Two scans of the input, one per output: the details are a projection, so that
    keeping a full copy of them would cost more than reading the file again."""
    out = output_path.rstrip("/")
    details = loan_details(read_loans(spark, input_path), as_of)
    observed, n = counted(details)
    write_csv(observed, f"{out}/details")
    write_csv(loan_region_stats(details), f"{out}/region_stats")
    return n()


# X12 — rows -> JSON messages on a bus (K7)
def publish_messages(df: DataFrame, options: dict[str, str], fmt: str = "kafka") -> None:
    write_messages(encode_messages(df), options, fmt)


# X13 — batch decode -> CSV
def decode_batch_job(envelope: DataFrame, output_path: str) -> None:
    write_csv(decode_messages(envelope), output_path)


# X14 — stream decode, run once, then the result table -> CSV
def decode_stream_job(stream: DataFrame, sink_path: str, checkpoint_path: str, csv_path: str) -> None:
    spark = stream.sparkSession
    run_available_now(decode_stream(stream), sink_path, checkpoint_path)
    write_csv(spark.read.parquet(sink_path), csv_path)
