"""Registered queries over the driver tables and their DuckDB oracle SQL.

Each query reads whole tables (no id subsets, prefixes or row caps) and
returns a lazy DataFrame; ``ORACLE_SQL[name]`` is an independent SQL
formulation with identical column names.  Averages that the reference leaves
unrounded are rounded to 6 digits on both sides so that summation order
cannot change the compared value.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluice.operators.contracts import (
    closed_set_rule,
    enforcing_load,
    foreign_key_violations,
    length_rule,
    not_null_rule,
    primary_key_violations,
    rule_counts,
    violation_counts,
)
from sluice.operators.dedupe import distinct_keys
from sluice.operators.loads import (
    append_load,
    insert_if_absent,
    insert_if_absent_to_path,
    read_or_empty,
    read_snapshot,
    replace_load,
    strict_insert,
    strict_insert_to_path,
    upsert,
    upsert_to_path,
    write_csv,
    write_json_documents,
    write_json_lines,
    written_once,
)
from sluice.operators.versioned import VersionedTable
from sluice.plans import derived as D
from sluice.plans.calls import snapshot_roundtrip, strict_insert_calls
from sluice.plans.documents import (
    nutrition_flat,
    order_headers,
    order_item_totals,
    order_items,
    order_status_steps,
    pets_flat,
)
from sluice.plans.jobs import decode_stream_job, publish_messages
from sluice.plans.loans import loan_details, loan_region_stats, read_loans
from sluice.plans.messages import decode_messages, encode_messages
from sluice.plans.readings import prepare_readings, temp_daily_full, temp_daily_incremental, temp_extremes
from sluice.plans.refresh import add_sessions, add_tickets, read_activity, read_efficiency
from sluice.plans.support import (
    load_users,
    replicate_sessions,
    replicate_tickets,
    support_efficiency_mart,
    user_activity_mart,
    user_ids,
)
from sluice.schemas import (
    DELIVERY_ORDER_DOC,
    FOOD_XML,
    LOAN_MESSAGE,
    MESSAGE_ENVELOPE,
    PETS_DOCUMENT,
    TEMP_DAILY,
    TEMP_READINGS,
    USERS,
    USER_SESSION_DOC,
)
from sluice.session import scratch_path
from sluice.sources.document_dump import read_document_dump, write_document_dump
from sluice.sources.files import (
    read_csv,
    read_json_documents,
    read_message_stream,
    read_messages,
    read_table,
    read_xml_records,
    with_read_order,
)
from sluice.sources.json_records import read_json_records
from sluice.sources.xml_records import read_root_records
from sluice.streaming.messages import decode_stream, run_available_now

# Fixed parameters of the registered queries.
LOANS_AS_OF = "2002-01-01"
READINGS_TARGET_END = "2024-01-20"
READINGS_AS_OF = "2024-01-31"
USERS_SPLIT = "1998-01-01"
TICKETS_SNAPSHOT_END = "1999-01-01"
DAILY_TARGET_END = "2000-01-01"
DAILY_BATCH_START = "1999-07-01"
STREAM_SPLIT = "2024-01-15"
NULL_TEXT = "\\N"  # how the CSV writer spells NULL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# =================================================================== loans
def q_loan_details(spark, d):
    loans = D.loans_from_orders(table(spark, d, "orders"), table(spark, d, "customer"), table(spark, d, "nation"))
    return loan_details(loans, LOANS_AS_OF)


def q_loan_region_stats(spark, d):
    return loan_region_stats(q_loan_details(spark, d))


def q_loan_region_order(spark, d):
    """O3: the place of every region in the sorted result, as rows carry it."""
    rows = loan_region_stats(q_loan_details(spark, d)).coalesce(1)  # one row per region, in order
    return rows.select("region", "total_amount", (F.monotonically_increasing_id() + 1).alias("place"))


def q_loans_csv(spark, d):
    """Loans written as CSV with other columns between and in another order."""
    loans = D.loans_from_orders(table(spark, d, "orders"), table(spark, d, "customer"), table(spark, d, "nation"))
    path = scratch_path(spark, "loans-csv")
    write_csv(loans.select("status", "region", F.lit("x").alias("remark"), "issue_date", "interest_rate", "loan_amount",
                           "loan_term_months", "borrower_name", "loan_id"), path)
    return loan_details(read_loans(spark, path, missing=(NULL_TEXT,)), LOANS_AS_OF)


def q_documents_csv(spark, d):
    """S3, K6: free text with quotes, commas and line breaks, written as CSV and read by
    several tasks a file."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = scratch_path(spark, "documents-csv")
    write_csv(docs, path)
    return read_csv(spark, path, docs.schema, missing=(NULL_TEXT,), quoted_breaks=True)


def q_documents_json(spark, d):
    """Free text in JSON documents of one array each, read by several tasks a file."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = scratch_path(spark, "documents-json")
    write_json_documents(docs, path, "documents")
    return read_json_records(spark, path, "documents", docs.schema, mode="FAILFAST")


# =================================================================== readings
def _prepared(spark, d):
    return prepare_readings(D.readings_from_events(table(spark, d, "events")), flag_value="view")


def q_temp_daily_full(spark, d):
    return temp_daily_full(_prepared(spark, d))


def q_readings_csv(spark, d):
    """Readings written as CSV, columns shuffled, times as text, missing values
    as the reader's tokens."""
    path = scratch_path(spark, "readings-csv")
    r = D.readings_from_events(table(spark, d, "events"))
    token = F.when(F.minute("noted_date") % 2 == 0, F.lit("NA")).otherwise(F.lit("NaN"))
    write_csv(r.select(
        F.coalesce(F.col("temp").cast("string"), token).alias("temp"), F.lit(7).alias("room_id/id"),
        F.date_format("noted_date", "dd-MM-yyyy HH:mm").alias("noted_date"), F.concat(F.lit(" "), F.initcap("out/in")).alias("out/in"),
    ), path)
    return temp_daily_full(prepare_readings(read_csv(spark, path, TEMP_READINGS), flag_value="view"))


def q_temp_extremes(spark, d):
    return temp_extremes(_prepared(spark, d))


def _incremental(days_back):
    def q(spark, d):
        prepared = _prepared(spark, d)
        # The target plays the stored table: it is written first (K2), as the
        # incremental load finds it.
        path = scratch_path(spark, "daily-target")
        replace_load(temp_daily_full(prepared.where(F.col("date") <= F.lit(READINGS_TARGET_END).cast("date"))), path)
        return temp_daily_incremental(read_or_empty(spark, path, TEMP_DAILY), prepared, READINGS_AS_OF, days_back)

    return q


# =================================================================== marts
def _sessions(spark, d):
    return replicate_sessions(D.session_documents_from_events(table(spark, d, "events")))


def q_user_activity(spark, d):
    mart = user_activity_mart(_sessions(spark, d))
    return mart.withColumn("avg_session_min", F.round("avg_session_min", 6))


def q_user_activity_refreshed(spark, d):
    """X8, K5 by delta: sessions arrive in three loads, of which the last repeats rows."""
    paths = scratch_path(spark, "sessions"), scratch_path(spark, "activity")
    parts = (F.col("start_time") < "2024-01-12", F.col("start_time") >= "2024-01-11", F.col("start_time") >= "2024-01-20")
    with written_once(spark, _sessions(spark, d), "sessions-feed") as sessions:  # deduplicated once for all loads
        for part in parts:
            add_sessions(spark, sessions.where(part), *paths)
    return read_activity(spark, paths[1]).withColumn("avg_session_min", F.round("avg_session_min", 6))


def q_user_activity_unpadded(spark, d):
    mart = user_activity_mart(_sessions(spark, d), ignore_padding=True)
    return mart.withColumn("avg_session_min", F.round("avg_session_min", 6))


def _tickets(spark, d):
    return replicate_tickets(D.ticket_documents_from_orders(table(spark, d, "orders"), table(spark, d, "lineitem")))


def q_support_efficiency(spark, d):
    mart = support_efficiency_mart(_tickets(spark, d))
    return mart.withColumn("avg_resolution_hours", F.round("avg_resolution_hours", 6))


def q_support_efficiency_refreshed(spark, d):
    """X9, K5 by counters: tickets arrive in two loads."""
    tickets, path = _tickets(spark, d), scratch_path(spark, "efficiency")
    for part in (F.col("created_at") < DAILY_TARGET_END, F.col("created_at") >= DAILY_TARGET_END):
        add_tickets(spark, tickets.where(part), path)
    return read_efficiency(spark, path).withColumn("avg_resolution_hours", F.round("avg_resolution_hours", 6))


def q_sessions_dedupe(spark, d):
    docs = D.session_documents_from_lines(table(spark, d, "lineitem"))
    s = replicate_sessions(docs, order_by=["start_time", "end_time", "user_id", "device", "pages_visited", "actions"])
    return s.select("session_id", "user_id", "start_time", "end_time", "device", "duration")


def q_sessions_collection(spark, d):
    """A collection of documents with technical ids, in files whose order
    says which of equal keys was read first."""
    path = scratch_path(spark, "sessions-collection")
    docs = D.session_documents_from_lines(table(spark, d, "lineitem"))
    ordered = docs.orderBy("start_time", "end_time", "user_id", "device", "pages_visited", "actions")
    write_json_lines(ordered.withColumn("_id", F.md5("session_id")), path)
    schema = StructType([*USER_SESSION_DOC.fields, StructField("_id", StringType())])
    s = replicate_sessions(with_read_order(read_table(spark, "json", path, schema)))
    return s.select("session_id", "user_id", "start_time", "end_time", "device", "duration")


def q_sessions_dump(spark, d):
    """The same collection as binary dumps, read by several tasks a file; places
    of documents tell which of equal keys was read first."""
    path = scratch_path(spark, "sessions-dump")
    docs = D.session_documents_from_lines(table(spark, d, "lineitem"))
    ordered = docs.orderBy("start_time", "end_time", "user_id", "device", "pages_visited", "actions")
    write_document_dump(ordered.withColumn("_id", F.left(F.md5("session_id"), F.lit(24))), path, object_ids=["_id"])
    schema = StructType([*USER_SESSION_DOC.fields, StructField("_id", StringType())])
    s = replicate_sessions(read_document_dump(spark, path, schema, mode="FAILFAST", position="_position", split_bytes=16 << 20))
    return s.select("session_id", "user_id", "start_time", "end_time", "device", "duration")


def q_documents_dump(spark, d):
    """Free text, numbers and NULLs through binary dumps; of each document only the
    wanted fields are decoded."""
    path = scratch_path(spark, "documents-dump")
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    write_document_dump(docs, path)
    return read_document_dump(spark, path, docs.select("doc_id", "text", "n_chars").schema, mode="FAILFAST", split_bytes=16 << 20)


def q_tickets_dedupe(spark, d):
    docs = D.ticket_documents_from_lines(table(spark, d, "lineitem"), table(spark, d, "orders"))
    return replicate_tickets(docs, order_by=["created_at", "updated_at", "status", "issue_type", "user_id"])


def q_users_insert_absent(spark, d):
    orders = table(spark, d, "orders")
    uid = F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("user_id")
    existing = distinct_keys(orders.where(F.col("o_orderdate") < F.lit(USERS_SPLIT)).select(uid), ["user_id"])
    feed = orders.where(F.col("o_orderdate") >= F.lit(USERS_SPLIT)).select(uid)
    return load_users(existing, feed)


def q_tickets_insert_absent(spark, d):
    orders = table(spark, d, "orders")
    old = D.ticket_rows_from_orders(orders.where(F.col("o_orderdate") < F.lit(TICKETS_SNAPSHOT_END)), "open")
    new = D.ticket_rows_from_orders(orders.where(F.col("o_orderdate") >= F.lit(USERS_SPLIT)))
    return insert_if_absent(old, new, ["ticket_id"], order_by=["created_at"])


# =================================================================== load modes
def _daily_orders(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.round(F.sum("o_totalprice"), 2).alias("revenue"),
    )


def q_upsert_daily(spark, d):
    orders = table(spark, d, "orders")
    target = _daily_orders(orders.where(F.col("o_orderdate") < F.lit(DAILY_TARGET_END)))
    batch = _daily_orders(orders.where(F.col("o_orderdate") >= F.lit(DAILY_BATCH_START)))
    return upsert(target, batch, ["date"])


def q_strict_insert(spark, d):
    orders = table(spark, d, "orders")
    target = _daily_orders(orders.where(F.col("o_orderdate") < F.lit(DAILY_TARGET_END)))
    batch = _daily_orders(orders.where(F.col("o_orderdate") >= F.lit(DAILY_TARGET_END)))
    return strict_insert(target, batch, ["date"])


def q_upsert_daily_path(spark, d):
    """K3 on files, month partitions: two loads and the table read back."""
    orders = table(spark, d, "orders")
    path = scratch_path(spark, "daily-upsert")
    for part in (F.col("o_orderdate") < F.lit(DAILY_TARGET_END), F.col("o_orderdate") >= F.lit(DAILY_BATCH_START)):
        batch = _daily_orders(orders.where(part)).withColumn("month", F.date_format("date", "yyyy-MM"))
        upsert_to_path(spark, batch, path, ["date"], ["month"], batch.schema)
    return spark.read.parquet(path).drop("month")


def q_strict_insert_path(spark, d):
    orders = table(spark, d, "orders")
    path = scratch_path(spark, "daily-strict")
    for part in (F.col("o_orderdate") < F.lit(DAILY_TARGET_END), F.col("o_orderdate") >= F.lit(DAILY_TARGET_END)):
        batch = _daily_orders(orders.where(part))
        strict_insert_to_path(spark, batch, path, ["date"], batch.schema)
    return spark.read.parquet(path)


def _versioned_daily(spark, d, name):
    schema = _daily_orders(table(spark, d, "orders")).schema
    return VersionedTable(spark, scratch_path(spark, name), schema, ["date"])


def q_upsert_daily_versioned(spark, d):
    """K3 on a versioned table: two loads, of which the second rewrites only the files
    that hold its keys."""
    orders, t = table(spark, d, "orders"), _versioned_daily(spark, d, "daily-versioned")
    for part in (F.col("o_orderdate") < F.lit(DAILY_TARGET_END), F.col("o_orderdate") >= F.lit(DAILY_BATCH_START)):
        t.upsert(_daily_orders(orders.where(part)))
    return t.read()


def q_strict_insert_indexed(spark, d):
    """K9, C1 by the key index of a versioned table."""
    orders, t = table(spark, d, "orders"), _versioned_daily(spark, d, "daily-indexed")
    for part in (F.col("o_orderdate") < F.lit(DAILY_TARGET_END), F.col("o_orderdate") >= F.lit(DAILY_TARGET_END)):
        t.strict_insert(_daily_orders(orders.where(part)))
    return t.read()


def q_users_two_feeds_indexed(spark, d):
    """U2, K4, J2 by the key index: users of tickets, then users of sessions."""
    uid = lambda c: F.concat(F.lit("user_"), F.col(c).cast("string")).alias("user_id")
    feeds = table(spark, d, "orders").select(uid("o_custkey")), table(spark, d, "events").select(uid("user_id"))
    t = VersionedTable(spark, scratch_path(spark, "users-indexed"), USERS, ["user_id"])
    for feed in feeds:
        t.insert_if_absent(distinct_keys(feed.where("user_id IS NOT NULL"), ["user_id"]))
    return t.read()


def q_high_water_mark(spark, d):
    """S6 from a versioned table's manifest, before and after each load."""
    orders, t = table(spark, d, "orders"), _versioned_daily(spark, d, "daily-marks")
    marks = [t.high_water_mark("date").withColumn("version", F.lit(0))]
    for part in (F.col("o_orderdate") < F.lit(DAILY_TARGET_END), F.col("o_orderdate") >= F.lit(DAILY_BATCH_START)):
        t.upsert(_daily_orders(orders.where(part)))
        marks.append(t.high_water_mark("date").withColumn("version", F.lit(t.version())))
    return reduce(DataFrame.unionByName, marks)


def q_table_versions(spark, d):
    """Every version of a table after an append, an upsert and a replacement."""
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    t = VersionedTable(spark, scratch_path(spark, "versions"), rows.schema, ["c_custkey"])
    t.append(rows.where("c_nationkey < 10"))
    t.upsert(rows.where("c_nationkey >= 5").withColumn("c_name", F.lower("c_name")))
    t.replace(t.read().where("c_nationkey < 20"))
    every = [t.read(v).withColumn("version", F.lit(v)) for v in t.versions()]
    return reduce(DataFrame.unionByName, every).groupBy("version", "c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("c_name").alias("first_name"), F.max("c_name").alias("last_name")
    )


def q_users_two_feeds_path(spark, d):
    """U2 + K4 on files: users of tickets and of sessions, loaded twice."""
    uid = lambda c: F.concat(F.lit("user_"), F.col(c).cast("string")).alias("user_id")
    feeds = table(spark, d, "orders").select(uid("o_custkey")), table(spark, d, "events").select(uid("user_id"))
    path = scratch_path(spark, "users")
    for k in (1, 2):
        insert_if_absent_to_path(spark, user_ids(*feeds[:k]), path, ["user_id"], USERS, unique=True)
    return spark.read.parquet(path)


def q_append_twice(spark, d):
    """K1: an append that runs again adds its rows again."""
    path = scratch_path(spark, "appended")
    for _ in range(2):
        append_load(table(spark, d, "customer").select("c_custkey", "c_name"), path)
    return spark.read.parquet(path).groupBy("c_custkey", "c_name").agg(F.count(F.lit(1)).alias("copies"))


def q_replace_round_trip(spark, d):
    """An absent table reads as empty; replacing drops what was there."""
    path = scratch_path(spark, "replaced")
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    before = read_or_empty(spark, path, rows.schema)
    replace_load(before.unionByName(rows.where("c_custkey % 2 = 0")), path)
    replace_load(rows, path)
    return read_or_empty(spark, path, rows.schema)


# =================================================================== call log
def q_synthetic_calls(spark, d):
    return D.calls_from_orders(table(spark, d, "orders"))


def q_calls_strict_insert(spark, d):
    orders = table(spark, d, "orders")
    old = D.calls_from_orders(orders.where(F.col("o_orderdate") < F.lit(DAILY_TARGET_END)))
    new = D.calls_from_orders(orders.where(F.col("o_orderdate") >= F.lit(DAILY_TARGET_END)))
    return strict_insert_calls(old, new)


def q_snapshot_copy(spark, d):
    calls = D.calls_from_orders(table(spark, d, "orders"))
    return snapshot_roundtrip(spark, calls, scratch_path(spark, "snapshot-calls"))


def q_snapshot_documents(spark, d):
    """K10 on free text: blanks, quotes and line breaks survive."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "source")
    return snapshot_roundtrip(spark, docs, scratch_path(spark, "snapshot-documents"))


# =================================================================== messages
def q_message_encode(spark, d):
    """Rows as JSON messages."""
    return encode_messages(table(spark, d, "customer").select("c_custkey", "c_nationkey")).select(F.col("value").cast("string"))


def q_message_publish(spark, d):
    """Rows published as messages (to files here) and decoded again."""
    path = scratch_path(spark, "published")
    c = table(spark, d, "customer")
    loans = c.select(F.col("c_custkey").cast("int").alias("loan_id"), F.col("c_name").alias("borrower"),
                     F.floor("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("status"))
    publish_messages(loans, {"path": path}, "parquet")
    env = read_messages(spark, {}, "parquet", path, StructType([MESSAGE_ENVELOPE["value"]]))
    return decode_messages(env.withColumn("timestamp", F.lit(READINGS_AS_OF).cast("timestamp")), LOAN_MESSAGE).drop("timestamp")


def q_message_decode(spark, d):
    env = D.message_envelopes_from_events(table(spark, d, "events"))
    src = scratch_path(spark, "messages-batch")
    env.write.parquet(src)
    return decode_messages(read_messages(spark, {}, "parquet", src, env.schema), LOAN_MESSAGE)


def q_stream_csv_restart(spark, d):
    """A run, more messages, a restart on the same checkpoint, the result
    table to CSV and back."""
    env = D.message_envelopes_from_events(table(spark, d, "events"))
    src, out, ckpt, csv = (scratch_path(spark, f"stream-{n}") for n in ("in", "out", "ckpt", "csv"))
    for part in (F.col("timestamp") < F.lit(STREAM_SPLIT), F.col("timestamp") >= F.lit(STREAM_SPLIT)):
        env.where(part).write.mode("append").parquet(src)
        decode_stream_job(read_message_stream(spark, {}, "parquet", src, env.schema), out, ckpt, csv)
    return read_snapshot(spark, csv, spark.read.parquet(out).schema)


def q_message_decode_stream(spark, d):
    env = D.message_envelopes_from_events(table(spark, d, "events"))
    src = scratch_path(spark, "messages-in")
    env.write.mode("overwrite").parquet(src)
    stream = read_message_stream(spark, {}, "parquet", src, env.schema)
    out = scratch_path(spark, "messages-out")
    run_available_now(decode_stream(stream, LOAN_MESSAGE), out, scratch_path(spark, "messages-ckpt"))
    return spark.read.parquet(out)


# =================================================================== documents
def q_pets_flat(spark, d):
    docs = D.pet_documents_from_parts(table(spark, d, "part"))
    return pets_flat(docs.select(F.from_json("doc", PETS_DOCUMENT).alias("doc")), doc_col="doc")


def q_nutrition_flat(spark, d):
    xml = D.food_xml_from_parts(table(spark, d, "part"))
    return nutrition_flat(xml.select(F.from_xml("xml", FOOD_XML).alias("food")), food_col="food")


def q_pets_json_files(spark, d):
    """The documents as JSON files, one object a line."""
    path = scratch_path(spark, "pets-json")
    D.pet_documents_from_parts(table(spark, d, "part")).select(F.col("doc").alias("value")).write.text(path)
    return pets_flat(read_json_documents(spark, path, PETS_DOCUMENT, multi_line=False))


def q_nutrition_xml_files(spark, d):
    """The records as XML files."""
    path = scratch_path(spark, "food-xml")
    foods = D.food_xml_from_parts(table(spark, d, "part")).select(F.from_xml("xml", FOOD_XML).alias("f")).select("f.*")
    foods.write.format("xml").option("rootTag", "nutrition").option("rowTag", "food").save(path)
    return nutrition_flat(read_xml_records(spark, path, "food", FOOD_XML))


def q_nutrition_xml_document(spark, d):
    """Children of each document's root only, read by several tasks a file."""
    path = scratch_path(spark, "food-document")
    foods = D.food_xml_from_parts(table(spark, d, "part")).select(F.from_xml("xml", FOOD_XML).alias("f")).select("f.*")
    foods.write.format("xml").option("rootTag", "nutrition").option("rowTag", "food").save(path)
    return nutrition_flat(read_root_records(spark, path, "food", FOOD_XML))


def _orders_docs(spark, d, items=True):
    return D.delivery_documents_from_orders(table(spark, d, "orders"), table(spark, d, "lineitem"), items)


def q_order_headers(spark, d):
    return order_headers(_orders_docs(spark, d, items=False))


def q_orders_json_files(spark, d):
    """Order documents as JSON files; only the header's sections are parsed."""
    path = scratch_path(spark, "orders-json")
    write_json_lines(_orders_docs(spark, d).select("doc.*"), path)
    return order_headers(read_json_documents(spark, path, DELIVERY_ORDER_DOC, multi_line=False), doc_col=None)


def q_synthetic_sessions(spark, d):
    docs = D.session_documents_from_events(table(spark, d, "events"))
    return docs.select(
        "session_id", "user_id", "start_time", "end_time", "device",
        F.array_join("pages_visited", ",").alias("pages_visited"),
        F.array_join("actions", ",").alias("actions"),
    )


def q_synthetic_tickets(spark, d):
    docs = D.ticket_documents_from_orders(table(spark, d, "orders"), table(spark, d, "lineitem"))
    return docs.select(
        "ticket_id", "user_id", "status", "issue_type", "created_at", "updated_at",
        F.size("messages").alias("n_messages"),
        F.col("messages")[0]["message"].alias("first_message"),
    )


def q_order_items(spark, d):
    return order_items(_orders_docs(spark, d))


def q_order_item_totals(spark, d):
    t = order_item_totals(_orders_docs(spark, d))
    return t.withColumn("items_subtotal", F.round("items_subtotal", 4))


def q_order_status_steps(spark, d):
    return order_status_steps(_orders_docs(spark, d, items=False))


# =================================================================== contracts
def q_contract_violations(spark, d):
    orders, lineitem, customer = table(spark, d, "orders"), table(spark, d, "lineitem"), table(spark, d, "customer")
    events, part = table(spark, d, "events"), table(spark, d, "part")
    keyed = violation_counts({
        "lineitem_pk": primary_key_violations(lineitem, ["l_orderkey", "l_linenumber"]),
        "orders_pk": primary_key_violations(orders, ["o_orderkey"]),
        "orders_fk_customer": foreign_key_violations(orders, customer, ["o_custkey"], ["c_custkey"]),
        "lineitem_fk_orders": foreign_key_violations(lineitem, orders, ["l_orderkey"], ["o_orderkey"]),
    })
    # row-level rules: one scan per table
    rows = (
        rule_counts(orders, {
            "orders_not_null": not_null_rule(["o_orderkey", "o_custkey", "o_orderdate"]),
            "orders_status_set": closed_set_rule("o_orderstatus", ["O", "F", "P"]),
        })
        .unionByName(rule_counts(events, {
            "events_type_set": closed_set_rule("event_type", ["view", "click", "purchase", "signup", "error"]),
        }))
        .unionByName(rule_counts(customer, {"customer_name_len": length_rule("c_name", 25)}))
        .unionByName(rule_counts(part, {"part_name_len": length_rule("p_name", 10)}))
    )
    return keyed.unionByName(rows)


def q_enforced_lines(spark, d):
    """Order lines loaded where they hold all rules, else quarantined with
    the reasons."""
    good, bad = scratch_path(spark, "lines"), scratch_path(spark, "lines-quarantine")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", F.concat(F.lit("P"), "l_partkey").alias("code"))
    parts = table(spark, d, "part").where("p_size > 5")
    n = enforcing_load(spark, lines, good, bad, {
        "flag": closed_set_rule("l_returnflag", ["A", "N"]), "code": length_rule("code", 4),
    }, keys=["l_orderkey", "l_linenumber"], parents={"part": (["l_partkey"], parts, ["p_partkey"])})
    loaded, held = spark.read.schema(lines.schema).parquet(good), spark.read.parquet(bad)
    rows = loaded.withColumn("reasons", F.lit("")).unionByName(held.withColumn("reasons", F.array_join("reasons", ",")))
    return rows.groupBy("l_orderkey", "l_linenumber", "reasons").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "n_loaded", F.lit(n["loaded"])
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "loan_details": q_loan_details,
    "loan_region_stats": q_loan_region_stats,
    "loan_region_order": q_loan_region_order,
    "loans_csv": q_loans_csv,
    "documents_csv": q_documents_csv,
    "documents_json": q_documents_json,
    "readings_csv": q_readings_csv,
    "temp_daily_full": q_temp_daily_full,
    "temp_extremes": q_temp_extremes,
    "temp_daily_incremental_7": _incremental(7),
    "temp_daily_incremental_15": _incremental(15),
    "user_activity": q_user_activity,
    "user_activity_refreshed": q_user_activity_refreshed,
    "user_activity_unpadded": q_user_activity_unpadded,
    "support_efficiency": q_support_efficiency,
    "support_efficiency_refreshed": q_support_efficiency_refreshed,
    "sessions_dedupe": q_sessions_dedupe,
    "sessions_collection": q_sessions_collection,
    "sessions_dump": q_sessions_dump,
    "documents_dump": q_documents_dump,
    "tickets_dedupe": q_tickets_dedupe,
    "users_insert_absent": q_users_insert_absent,
    "tickets_insert_absent": q_tickets_insert_absent,
    "upsert_daily": q_upsert_daily,
    "strict_insert": q_strict_insert,
    "upsert_daily_path": q_upsert_daily_path,
    "strict_insert_path": q_strict_insert_path,
    "users_two_feeds_path": q_users_two_feeds_path,
    "upsert_daily_versioned": q_upsert_daily_versioned,
    "strict_insert_indexed": q_strict_insert_indexed,
    "users_two_feeds_indexed": q_users_two_feeds_indexed,
    "table_versions": q_table_versions,
    "high_water_mark": q_high_water_mark,
    "append_twice": q_append_twice,
    "replace_round_trip": q_replace_round_trip,
    "synthetic_calls": q_synthetic_calls,
    "synthetic_sessions": q_synthetic_sessions,
    "synthetic_tickets": q_synthetic_tickets,
    "calls_strict_insert": q_calls_strict_insert,
    "snapshot_copy": q_snapshot_copy,
    "snapshot_documents": q_snapshot_documents,
    "message_encode": q_message_encode,
    "stream_csv_restart": q_stream_csv_restart,
    "message_publish": q_message_publish,
    "message_decode": q_message_decode,
    "message_decode_stream": q_message_decode_stream,
    "pets_flat": q_pets_flat,
    "pets_json_files": q_pets_json_files,
    "nutrition_xml_files": q_nutrition_xml_files,
    "nutrition_xml_document": q_nutrition_xml_document,
    "nutrition_flat": q_nutrition_flat,
    "order_headers": q_order_headers,
    "orders_json_files": q_orders_json_files,
    "order_items": q_order_items,
    "order_item_totals": q_order_item_totals,
    "order_status_steps": q_order_status_steps,
    "contract_violations": q_contract_violations,
    "enforced_lines": q_enforced_lines,
}
