"""Property tests (hypothesis): load-mode laws and brute-force equivalences."""

import duckdb
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sluice.operators.dedupe import dedupe_first
from sluice.operators.loads import insert_if_absent, upsert
from sluice.operators.nested import lockstep_unnest
from sluice.operators.quantiles import exact_quantiles

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
SCHEMA = "k int, v string"

rows = st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["a", "b", "c", None])), max_size=12)


def _unique(rs):
    seen, out = set(), []
    for k, v in rs:
        if k not in seen:
            seen.add(k)
            out.append((k, v))
    return out


def _frame(spark, rs):
    return spark.createDataFrame(rs, SCHEMA)


def _set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@SETTINGS
@given(target=rows, batch=rows)
def test_upsert_idempotent_and_batch_wins(spark, target, batch):
    t, b = _frame(spark, _unique(target)), _frame(spark, _unique(batch))
    once = upsert(t, b, ["k"])
    assert _set(upsert(once, b, ["k"])) == _set(once)
    expected = dict(_unique(target))
    expected.update(dict(_unique(batch)))
    assert _set(once) == sorted(expected.items(), key=repr)


@SETTINGS
@given(target=rows, batch=rows)
def test_insert_if_absent_never_changes_existing(spark, target, batch):
    t = _frame(spark, _unique(target))
    out = {r["k"]: r["v"] for r in insert_if_absent(t, _frame(spark, batch), ["k"], order_by=["v"]).collect()}
    for k, v in _unique(target):
        assert out[k] == v
    assert set(out) == {k for k, _ in target} | {k for k, _ in batch}


@SETTINGS
@given(data=rows)
def test_dedupe_first_equals_sql_row_number(spark, data):
    got = _set(dedupe_first(_frame(spark, data), ["k"], ["v"]))
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k INTEGER, v VARCHAR)")
    if data:
        con.executemany("INSERT INTO t VALUES (?, ?)", data)
    exp = con.execute(
        "SELECT k, v FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY v NULLS FIRST) rn FROM t) WHERE rn = 1"
    ).fetchall()
    assert got == sorted(exp, key=repr)


arrays = st.one_of(st.none(), st.lists(st.sampled_from(["x", "y", None]), max_size=4))


@SETTINGS
@given(data=st.lists(st.tuples(arrays, arrays), max_size=6))
def test_lockstep_unnest_equals_duckdb(spark, data):
    rs = [(i, p, q) for i, (p, q) in enumerate(data)]
    df = spark.createDataFrame(rs, "id int, p array<string>, q array<string>")
    got = _set(lockstep_unnest(df, ["id"], {"page": "p", "action": "q"}))
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id INTEGER, p VARCHAR[], q VARCHAR[])")
    if rs:
        con.executemany("INSERT INTO t VALUES (?, ?, ?)", rs)
    exp = con.execute("SELECT id, unnest(p), unnest(q) FROM t").fetchall()
    assert got == sorted(exp, key=repr)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e6, 1e6)), max_size=60),
       p=st.floats(0.0, 1.0))
def test_exact_quantiles_equal_numpy(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, "x", [p], k=8).first()[0]
    clean = [v for v in values if v is not None]
    if not clean:
        assert got is None
    else:
        assert got == pytest.approx(float(np.quantile(np.array(clean), p)), rel=1e-9, abs=1e-9)


def _mart_by_hand(rows):
    """The activity mart worked out user by user and day by day."""
    groups = {}
    for _, user, start, _, pages, _, actions, minutes in rows:
        groups.setdefault((user, start.date() if start else None), []).append((start, pages or [], actions or [], minutes))
    out = []
    for (user, day), sessions in groups.items():
        hits = {"page": {}, "action": {}}
        for _, pages, actions, _ in sessions:
            for k in range(max(len(pages), len(actions))):
                for kind, items in (("page", pages), ("action", actions)):
                    item = items[k] if k < len(items) else None
                    hits[kind][item] = hits[kind].get(item, 0) + 1
        best = {
            kind: min(found, key=lambda x: (-found[x], x is None, x or "")) if found and user is not None and day is not None else None
            for kind, found in hits.items()
        }
        known = [m for *_, m in sessions if m is not None]
        starts = {s for s, *_ in sessions if s is not None}
        out.append((user, len(starts), sum(known) / len(known) if known else None, day, best["page"], best["action"]))
    return out


session_rows = st.lists(
    st.tuples(
        st.sampled_from(["u1", "u2", None]),
        st.sampled_from([None, "2024-03-01 10:00:00", "2024-03-01 18:00:00", "2024-03-02 09:00:00"]),
        st.sampled_from([None, 1.5, 3.0, 10.0]),
        st.one_of(st.none(), st.lists(st.sampled_from(["/a", "/b", None]), max_size=3)),
        st.one_of(st.none(), st.lists(st.sampled_from(["login", "buy", None]), max_size=3)),
    ),
    min_size=1,
    max_size=8,
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=session_rows)
def test_user_activity_mart_by_hand(spark, data):
    import datetime as dt

    from sluice.plans.support import user_activity_mart

    rows = [
        (f"s{i}", u, None if s is None else dt.datetime.fromisoformat(s), None, p, "d", a, d)
        for i, (u, s, d, p, a) in enumerate(data)
    ]
    schema = ("session_id string, user_id string, start_time timestamp_ntz, end_time timestamp_ntz, "
              "pages_visited array<string>, device string, actions array<string>, duration double")
    got = user_activity_mart(spark.createDataFrame(rows, schema)).collect()
    exp = _mart_by_hand(rows)

    def norm(r):
        return tuple(round(v, 9) if isinstance(v, float) else v for v in r)

    assert sorted((norm(tuple(r)) for r in got), key=repr) == sorted((norm(r) for r in exp), key=repr)
