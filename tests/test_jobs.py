import json
import os

from pyspark.sql import functions as F

from sluice.operators.loads import read_or_empty
from sluice.plans import jobs
from sluice.schemas import LOAN_MESSAGE, TEMP_DAILY, TEMP_DAILY_BY_MONTH, USER_SESSIONS_RAW, USERS

from .conftest import FIXTURES


def _write_readings(path, days):
    # columns as the reference reads them: out/in, noted_date (d-m-Y H:M), temp
    with open(path, "w") as f:
        f.write("out/in,noted_date,temp\n")
        for d in days:
            for k in range(3):
                f.write(f"In,{d}-01-2024 {k}:15,{20 + k}\n")
            f.write(f"Out,{d}-01-2024 9:00,99\n")


def test_readings_jobs(spark, tmp_dir):
    csv = os.path.join(tmp_dir, "r.csv")
    _write_readings(csv, range(1, 11))
    table = os.path.join(tmp_dir, "daily")
    jobs.load_temp_daily_full(spark, csv, table)
    assert spark.read.parquet(table).count() == 10
    ext = os.path.join(tmp_dir, "ext")
    jobs.load_temp_extremes(spark, csv, ext)
    assert spark.read.parquet(ext).count() == 10  # 5 hottest + 5 coldest
    # incremental: newer readings arrive; only days after the cutoff are loaded
    _write_readings(csv, range(1, 16))
    inc = os.path.join(tmp_dir, "inc")
    assert jobs.load_temp_daily_incremental(spark, csv, inc, days_back=7, as_of="2024-01-16") == 6  # 10..15
    # rerun: the high-water mark is now 15 -> nothing new, nothing written
    assert jobs.load_temp_daily_incremental(spark, csv, inc, days_back=7, as_of="2024-01-16") == 0
    got = read_or_empty(spark, inc, TEMP_DAILY_BY_MONTH)
    assert TEMP_DAILY.names == ["date", "avg_temp", "min_temp", "max_temp", "reading_count"]
    assert sorted(r["date"].day for r in got.collect()) == list(range(10, 16))


def test_replication_and_marts(spark, tmp_dir):
    src = os.path.join(tmp_dir, "sessions.json")
    docs = [
        {"_id": "x1", "session_id": "s1", "user_id": "u1", "start_time": "2024-03-01T10:00:00Z",
         "end_time": "2024-03-01T10:30:00Z", "pages_visited": ["/a"], "device": "mobile", "actions": ["login"]},
        {"_id": "x2", "session_id": "s1", "user_id": "u1", "start_time": "2024-03-01T10:00:00Z",
         "end_time": "2024-03-01T10:40:00Z", "pages_visited": ["/b"], "device": "mobile", "actions": []},
        {"_id": "x3", "session_id": "s2", "user_id": "u2", "start_time": "2024-03-02T10:00:00Z",
         "end_time": None, "pages_visited": [], "device": "desktop", "actions": None},
    ]
    with open(src, "w") as f:
        f.write("\n".join(json.dumps(d) for d in docs))
    users, sessions = os.path.join(tmp_dir, "users"), os.path.join(tmp_dir, "sessions")
    assert jobs.replicate_sessions_job(spark, src, users, sessions) == 2
    assert jobs.replicate_sessions_job(spark, src, users, sessions) == 0  # existing rows win, nothing new
    assert sorted(r[0] for r in read_or_empty(spark, users, USERS).collect()) == ["u1", "u2"]
    assert read_or_empty(spark, sessions, USER_SESSIONS_RAW).count() == 2
    empty = os.path.join(tmp_dir, "empty.json")
    open(empty, "w").close()
    assert jobs.replicate_sessions_job(spark, empty, users, sessions) == 0
    act, eff = os.path.join(tmp_dir, "act"), os.path.join(tmp_dir, "eff")
    jobs.rebuild_marts(spark, sessions, os.path.join(tmp_dir, "no_tickets"), act, eff)
    assert spark.read.parquet(act).count() == 2


def test_loans_job(spark, tmp_dir):
    out = os.path.join(tmp_dir, "loans_out")
    assert jobs.loans_job(spark, os.path.join(FIXTURES, "loans_sample.csv"), out, "2025-01-01") == 40
    stats = spark.read.option("header", "true").csv(f"{out}/region_stats")
    assert stats.count() == 7
    assert spark.read.option("header", "true").csv(f"{out}/details").count() == 40


def test_decode_jobs(spark, tmp_dir):
    env = spark.createDataFrame([(bytearray(b'{"loan_id":1,"status":"a"}'),), (bytearray(b"bad"),)], "value binary")
    env = env.withColumn("timestamp", F.current_timestamp())
    out = os.path.join(tmp_dir, "decoded")
    jobs.decode_batch_job(env, out)
    assert spark.read.option("header", "true").csv(out).count() == 1
    src = os.path.join(tmp_dir, "env")
    env.write.parquet(src)
    stream = spark.readStream.schema(env.schema).parquet(src)
    csv = os.path.join(tmp_dir, "stream_csv")
    jobs.decode_stream_job(stream, os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ck"), csv)
    assert spark.read.option("header", "true").csv(csv).count() == 1
    assert LOAN_MESSAGE.names[0] == "loan_id"


def test_document_appends_double_on_rerun(spark, tmp_dir):
    from .test_documents import XML

    pets = os.path.join(tmp_dir, "pets.json")
    with open(pets, "w") as f:
        json.dump({"pets": [{"name": "Rex", "species": "dog", "favFoods": ["a"]}]}, f)
    table = os.path.join(tmp_dir, "pets_table")
    assert jobs.load_pets(spark, pets, table) == 1
    assert jobs.load_pets(spark, pets, table) == 1
    assert spark.read.parquet(table).count() == 2  # append is not idempotent (as the original job)
    xml = os.path.join(tmp_dir, "n.xml")
    with open(xml, "w") as f:
        f.write(XML)
    assert jobs.load_nutrition(spark, xml, os.path.join(tmp_dir, "foods")) == 2


def test_replicate_tickets_and_publish(spark, tmp_dir):
    src = os.path.join(tmp_dir, "tickets.json")
    docs = [
        {"ticket_id": "t1", "user_id": "u1", "status": "open", "issue_type": "payment",
         "messages": [{"sender": "u", "message": "hi", "timestamp": "2024-03-01T10:00:00Z"}],
         "created_at": "2024-03-01T10:00:00Z", "updated_at": "2024-03-01T13:30:00Z"},
        {"ticket_id": "t1", "user_id": "u1", "status": "closed", "issue_type": "payment",
         "created_at": "2024-03-01T10:00:00Z", "updated_at": "2024-03-02T10:00:00Z"},
    ]
    with open(src, "w") as f:
        f.write("\n".join(json.dumps(d) for d in docs))
    users, tickets = os.path.join(tmp_dir, "users"), os.path.join(tmp_dir, "tickets")
    assert jobs.replicate_tickets_job(spark, src, users, tickets) == 1
    from sluice.schemas import SUPPORT_TICKETS

    row = read_or_empty(spark, tickets, SUPPORT_TICKETS).first()
    assert row["status"] == "open"  # the first read
    assert row["resolution_time_hours"] == 3.5
    # publish: encoded rows go to the sink as a single `value` column
    rows = spark.createDataFrame([(1, "Ann", 5, "active")], "loan_id int, borrower string, amount bigint, status string")
    jobs.publish_messages(rows, {}, fmt="noop")
