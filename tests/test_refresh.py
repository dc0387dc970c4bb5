"""Marts refreshed by loads against a full rebuild."""

import random

from sluice.plans.refresh import add_sessions, add_tickets, read_activity, read_efficiency, refresh_days
from sluice.plans.support import support_efficiency_mart, user_activity_mart
from sluice.schemas import SUPPORT_TICKETS, USER_SESSIONS_RAW

T = "timestamp_ntz"


def sessions(spark, rows):
    return spark.createDataFrame(rows, "id int, u string, s string, e string, p array<string>, a array<string>").selectExpr(
        "concat('s', id) session_id", "u user_id", f"cast(s as {T}) start_time", f"cast(e as {T}) end_time", "p pages_visited",
        "'web' device", "a actions", f"timestampdiff(MICROSECOND, cast(s as {T}), cast(e as {T})) / 6e7D duration",
    )


def content(df):
    return sorted(((*r[:2], round(r[2], 9) if isinstance(r[2], float) else r[2], *r[3:]) for r in map(tuple, df.collect())), key=repr)


def test_activity_equals_a_rebuild_after_random_loads(spark, tmp_dir):
    r, every, seen = random.Random(2), [], set()
    paths = f"{tmp_dir}/sessions", f"{tmp_dir}/mart"
    for load in range(4):
        rows = []
        for _ in range(25):
            i, day = r.randrange(70), r.choice(["2024-01-01", "2024-01-02", "2024-02-03", None])
            start = day and f"{day} {i % 24:02d}:00:00"
            items = lambda: r.choice([None, [], ["a", "b", "a"], ["c", None]])
            rows.append((i, r.choice(["u1", "u2", None]), start, r.choice([None, start and f"{day} 23:59:00"]), items(), items()))
        fresh = {}
        for x in rows:  # one row a session: the first by start, here equal rows of a key are dropped
            if x[0] not in seen and x[0] not in fresh:
                fresh[x[0]] = x
        seen |= set(fresh)
        every += fresh.values()
        again = r.sample(every, min(5, len(every)))  # sessions that come again add nothing
        batch = list({x[0]: x for x in [*again, *fresh.values()]}.values())
        add_sessions(spark, sessions(spark, batch), *paths)
        want = user_activity_mart(sessions(spark, every))
        assert content(read_activity(spark, paths[1]).select(*want.columns)) == content(want)
    refresh_days(spark, spark.sql("SELECT date '2024-01-01' day"), *paths)  # harmless
    assert content(read_activity(spark, paths[1]).select(*want.columns)) == content(want)
    assert add_sessions(spark, sessions(spark, every[:3]), *paths) == 0


def test_refresh_reads_the_touched_days_only(spark, tmp_dir):
    from sluice.operators.loads import read_or_empty
    from sluice.plans.refresh import SESSIONS_BY_DAY, _of_days

    rows = [(i, "u", f"2024-01-{1 + i % 20:02d} 10:00:00", None, ["p"], []) for i in range(40)]
    add_sessions(spark, sessions(spark, rows), f"{tmp_dir}/s", f"{tmp_dir}/m")
    days = spark.sql("SELECT date '2024-01-05' day UNION SELECT date '2024-01-06'")
    some = _of_days(read_or_empty(spark, f"{tmp_dir}/s", SESSIONS_BY_DAY), days, "day")
    assert some.count() == 4
    assert "PartitionFilters: [" in some._jdf.queryExecution().executedPlan().toString()


def test_efficiency_equals_a_rebuild(spark, tmp_dir):
    rows = [("t%d" % i, "u", s, k, None, None, h) for i, (s, k, h) in enumerate(
        [("open", "a", None), ("open", "a", 2.5), ("closed", None, 1.0), (None, "b", None), ("closed", "a", 4.0), ("open", "b", 0.5)])]
    df = spark.createDataFrame(rows, SUPPORT_TICKETS)
    for part in ("ticket_id < 't2'", "ticket_id >= 't2' AND ticket_id < 't5'", "ticket_id >= 't5'"):
        add_tickets(spark, df.where(part), f"{tmp_dir}/c")
    want = support_efficiency_mart(df)
    got = read_efficiency(spark, f"{tmp_dir}/c").select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert USER_SESSIONS_RAW.names[0] == "session_id"
