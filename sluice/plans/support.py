"""Document store -> relational replication (X6, X7) and the two marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.time import hours_between, minutes_between, parse_iso
from sluice.operators.dedupe import dedupe_first, first_read
from sluice.operators.loads import insert_if_absent
from sluice.sources.files import drop_technical_id

POSITION = "_position"
SESSION_COLUMNS = ["session_id", "user_id", "start_time", "end_time", "pages_visited", "device", "actions", "duration"]
TICKET_COLUMNS = ["ticket_id", "user_id", "status", "issue_type", "created_at", "updated_at", "resolution_time_hours"]


def _as_ts(df: DataFrame, c: str):
    """ISO text -> timestamp without zone (UTC wall clock, as the relational
    target stores it); timestamps pass through."""
    if dict(df.dtypes)[c] == "string":
        return parse_iso(F.col(c))
    return F.col(c)


def _first(docs: DataFrame, key: str, order_by: Sequence[str] | None) -> DataFrame:
    if order_by is None and POSITION in docs.columns:
        return first_read(docs, [key], POSITION)
    return dedupe_first(docs.drop(POSITION), [key], order_by or [c for c in docs.columns if c not in (key, POSITION)])


def replicate_sessions(docs: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """X6 body: P3 -> A14 -> F6 -> P18 -> P2 (document rows -> T11 rows).

    ``order_by`` defines which duplicate is "first"; by default the read order, if the
    documents carry it (``sources.with_read_order``), else all columns.
    """
    unique = _first(drop_technical_id(docs), "session_id", order_by)
    start, end = _as_ts(unique, "start_time"), _as_ts(unique, "end_time")
    return unique.select(
        "session_id", "user_id",
        start.alias("start_time"), end.alias("end_time"),
        "pages_visited", "device", "actions",
        minutes_between(start, end).alias("duration"),
    )


def replicate_tickets(docs: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """X7 body: P3 -> A14 -> F6 -> P19 -> P2 (``messages`` is dropped)."""
    unique = _first(drop_technical_id(docs).drop("messages"), "ticket_id", order_by)
    created, updated = _as_ts(unique, "created_at"), _as_ts(unique, "updated_at")
    return unique.select(
        "ticket_id", "user_id", "status", "issue_type",
        created.alias("created_at"), updated.alias("updated_at"),
        hours_between(created, updated).alias("resolution_time_hours"),
    )


def load_users(users: DataFrame, *feeds: DataFrame) -> DataFrame:
    """U2 + K4 on the users dimension: distinct ``user_id`` of all feeds not
    yet present (NULL ids are not keys and are skipped)."""
    return insert_if_absent(users, user_ids(*feeds), ["user_id"])


def user_ids(*feeds: DataFrame) -> DataFrame:
    """The distinct, non-NULL user ids of all feeds together."""
    incoming = None
    for f in feeds:
        ids = f.select("user_id").where(F.col("user_id").isNotNull())
        incoming = ids if incoming is None else incoming.unionByName(ids)
    return incoming.distinct()


def user_activity_mart(sessions: DataFrame, ignore_padding: bool = False) -> DataFrame:
    """Per (user, day) — distinct session starts, mean duration, most
    visited page and most frequent action.

    One chain, no join, read once:

    1. one generator per session emits a session row (kind ``_s``, item = its
       start, with its duration) and the page/action rows — pages and actions
       unnested in lockstep with NULL padding (F13), or separately with
       ``ignore_padding``;
    2. one aggregation per (user, day, kind, item): hits, and duration sums
       for session rows (partial aggregation before the shuffle);
    3. one final aggregation per (user, day): distinct starts, mean duration,
       and the leader per kind as ``min(struct(-hits, item IS NULL, item))`` —
       "hits desc, item asc NULLS LAST" without a window (W1–W3 as an
       aggregate, partial before the shuffle).  A hot user-day is pre-reduced
       in every task.
    """
    start_txt = F.col("start_time").cast("string")
    base = sessions.select(
        "user_id", "start_time", "duration",
        F.coalesce("pages_visited", F.array().cast("array<string>")).alias("_p"),
        F.coalesce("actions", F.array().cast("array<string>")).alias("_a"),
        F.to_date("start_time").alias("activity_date"),
    )

    def row(kind: str, item, dur=None):
        return F.struct(
            F.lit(kind).alias("kind"),
            item.alias("item"),
            (dur if dur is not None else F.lit(None).cast("double")).alias("dur"),
        )

    session_row = F.array(row("_s", start_txt, F.col("duration")))
    if ignore_padding:
        pages = F.transform("_p", lambda x: row("page", x))
        acts = F.transform("_a", lambda x: row("action", x))
    else:
        # lockstep: arrays_zip pads the shorter array with NULL
        zipped = F.arrays_zip(F.col("_p").alias("page"), F.col("_a").alias("action"))
        pages = F.transform(zipped, lambda z: row("page", z["page"]))
        acts = F.transform(zipped, lambda z: row("action", z["action"]))
    rows = base.select("user_id", "activity_date", F.inline(F.concat(session_row, pages, acts)))

    counts = rows.groupBy("user_id", "activity_date", "kind", "item").agg(
        F.count(F.lit(1)).alias("hits"),
        F.sum("dur").alias("dsum"),
        F.count("dur").alias("dcnt"),
    )
    is_session = F.col("kind") == "_s"

    def leader(kind: str):
        # top-1 by hits desc, item asc NULLS LAST as a plain aggregate:
        # the minimum of (-hits, item IS NULL, item) — no window, no sort.
        ranked = F.struct((-F.col("hits")).alias("h"), F.col("item").isNull().alias("n"), F.col("item").alias("item"))
        # The reference attaches leaders with an equi-join on (user, day):
        # a NULL user or day never matches, so its leaders stay NULL.
        keyed = F.col("user_id").isNotNull() & F.col("activity_date").isNotNull()
        return F.when(keyed, F.min(F.when(F.col("kind") == kind, ranked))["item"])

    return counts.groupBy("user_id", "activity_date").agg(
        F.count_if(is_session & F.col("item").isNotNull()).alias("session_count"),
        (
            F.sum(F.when(is_session, F.col("dsum")))
            / F.nullif(F.sum(F.when(is_session, F.col("dcnt"))), F.lit(0)).cast("double")
        ).alias("avg_session_min"),
        leader("page").alias("most_popular_page"),
        leader("action").alias("most_popular_action"),
    ).select("user_id", "session_count", "avg_session_min", "activity_date", "most_popular_page", "most_popular_action")


def support_efficiency_mart(tickets: DataFrame) -> DataFrame:
    """Per (issue_type, status) — count, mean resolution hours, open count."""
    return tickets.groupBy("issue_type", "status").agg(
        F.count(F.lit(1)).alias("ticket_count"),
        F.avg("resolution_time_hours").alias("avg_resolution_hours"),
        F.count_if(F.col("status") == "open").alias("open_tickets"),
    )
