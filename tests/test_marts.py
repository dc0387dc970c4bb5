import datetime as dt

from sluice.operators.nested import lockstep_unnest
from sluice.plans.support import load_users, replicate_sessions, replicate_tickets, support_efficiency_mart, user_activity_mart
from sluice.schemas import SUPPORT_TICKET_DOC, USER_SESSION_DOC, USERS

T0 = "2024-03-01T10:00:00Z"


def test_lockstep_pads_both_ways_and_skips_empty(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b", "c"], ["x"]), (2, ["a"], ["x", "y"]), (3, None, ["z"]), (4, [], None), (5, None, None)],
        "id int, p array<string>, q array<string>",
    )
    got = sorted((tuple(r) for r in lockstep_unnest(df, ["id"], {"page": "p", "action": "q"}).collect()), key=repr)
    assert got == sorted([
        (1, "a", "x"), (1, "b", None), (1, "c", None),
        (2, "a", "x"), (2, None, "y"),
        (3, None, "z"),
    ], key=repr)
    sep = lockstep_unnest(df, ["id"], {"page": "p", "action": "q"}, ignore_padding=True).collect()
    assert len(sep) == (3 + 1) + (1 + 2) + (0 + 1)


def _sessions(spark):
    rows = [
        # same user/day: two sessions with the same start count once
        ("s1", "u1", T0, "2024-03-01T10:30:00Z", ["/a", "/b", "/a"], "mobile", ["login"]),
        ("s2", "u1", T0, "2024-03-01T10:10:00Z", ["/b"], "mobile", ["login", "logout", "purchase"]),
        ("s3", "u1", "2024-03-01T15:00:00Z", None, [], "desktop", None),
        ("s1", "u1", T0, "2024-03-01T11:00:00Z", ["/z"], "mobile", []),  # duplicate id, later by end_time
        ("s4", "u2", "2024-03-02T08:00:00Z", "2024-03-02T08:01:30Z", None, "desktop", ["view_product"]),
    ]
    return spark.createDataFrame(rows, USER_SESSION_DOC)


def test_replicate_sessions_dedupes_and_computes_duration(spark):
    s = {r["session_id"]: r for r in replicate_sessions(_sessions(spark)).collect()}
    assert len(s) == 4
    assert s["s1"]["duration"] == 30.0  # first by (user, start, end, ...) keeps the 10:30 end
    assert s["s4"]["duration"] == 1.5
    assert s["s3"]["duration"] is None
    assert s["s1"]["start_time"] == dt.datetime(2024, 3, 1, 10, 0)


def test_user_activity_mart(spark):
    mart = {(r["user_id"], r["activity_date"]): r for r in user_activity_mart(replicate_sessions(_sessions(spark))).collect()}
    u1 = mart[("u1", dt.date(2024, 3, 1))]
    assert u1["session_count"] == 2  # distinct starts 10:00 and 15:00
    assert u1["avg_session_min"] == (30.0 + 10.0) / 2  # s3 has NULL duration
    # pages: /a x2, /b x2, NULL x2 (s2 pads 2) -> "/a" by value order;
    # actions: login x2, NULL x2 (s1 pads 2) -> tie, NULLS LAST -> "login"
    assert u1["most_popular_page"] == "/a"
    assert u1["most_popular_action"] == "login"
    u2 = mart[("u2", dt.date(2024, 3, 2))]
    assert u2["most_popular_page"] is None and u2["most_popular_action"] == "view_product"


def test_support_efficiency_and_users(spark):
    docs = spark.createDataFrame([
        ("t1", "u1", "open", "payment", [("u", "m", T0)], T0, "2024-03-01T12:00:00Z"),
        ("t2", "u2", "closed", "payment", None, T0, "2024-03-02T10:00:00Z"),
        ("t3", "u9", "closed", "payment", None, T0, None),
        ("t1", "u1", "closed", "payment", None, T0, "2024-03-01T11:00:00Z"),
    ], SUPPORT_TICKET_DOC)
    tickets = replicate_tickets(docs)
    assert tickets.count() == 3
    mart = {(r["issue_type"], r["status"]): r for r in support_efficiency_mart(tickets).collect()}
    assert set(mart) == {("payment", "closed"), ("payment", "open")} or set(mart) == {("payment", "closed")}
    closed = mart[("payment", "closed")]
    assert closed["open_tickets"] == 0
    users = spark.createDataFrame([("u1",)], USERS)
    assert sorted(r[0] for r in load_users(users, tickets).collect()) == ["u1", "u2", "u9"]


def test_null_start_and_all_ticket_statuses(spark):
    rows = [
        ("s9", "u7", None, "2024-03-01T10:30:00Z", ["/a"], "mobile", ["login"]),
        ("s8", "u7", "2024-03-01T09:00:00Z", "2024-03-01T09:06:00Z", ["/a"], "mobile", ["login"]),
    ]
    mart = user_activity_mart(replicate_sessions(spark.createDataFrame(rows, USER_SESSION_DOC))).collect()
    by_day = {r["activity_date"]: r for r in mart}
    # a NULL start has no day and no distinct start, but keeps its (user, NULL day) row
    assert by_day[None]["session_count"] == 0 and by_day[None]["avg_session_min"] is None
    assert by_day[None]["most_popular_page"] is None  # NULL day never matches the leader join
    assert by_day[dt.date(2024, 3, 1)]["most_popular_page"] == "/a"
    nulluser = [("s1", None, T0, None, ["/a"], "mobile", ["login"])]
    m = user_activity_mart(replicate_sessions(spark.createDataFrame(nulluser, USER_SESSION_DOC))).first()
    assert m["user_id"] is None and m["session_count"] == 1 and m["most_popular_page"] is None
    assert by_day[dt.date(2024, 3, 1)]["session_count"] == 1 and by_day[dt.date(2024, 3, 1)]["avg_session_min"] == 6.0
    docs = spark.createDataFrame([
        (f"t{i}", "u1", st, "delivery", None, T0, "2024-03-01T11:00:00Z")
        for i, st in enumerate(["open", "closed", "in_progress", "in_progress"])
    ], SUPPORT_TICKET_DOC)
    mart2 = {r["status"]: r for r in support_efficiency_mart(replicate_tickets(docs)).collect()}
    assert {k: (v["ticket_count"], v["open_tickets"]) for k, v in mart2.items()} == {
        "open": (1, 1), "closed": (1, 0), "in_progress": (2, 0)
    }
    assert mart2["in_progress"]["avg_resolution_hours"] == 1.0
