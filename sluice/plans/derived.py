"""Reference-shaped inputs derived from the driver tables.

The reference's generators (call log, sessions, tickets) and sample documents
are re-aimed as deterministic transformations of the given tables, so every
input grows with them and DuckDB can compute the same rows.  Every array built
here comes from a single source row (bounded by construction) — no
``collect_list`` over a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import xml_escape
from sluice.schemas import DELIVERY_ORDER_DOC, PETS_DOCUMENT

# Closed value sets of the reference's generators.
REGIONS = ["DE-HE", "DE-BY", "DE-BW", "DE-NW", "DE-HH"]
CAMPAIGNS = ["credit_card_offer", "mortgage_offer", "cash_loan", "insurance_offer"]
CALL_STATUSES = ["answered", "missed", "dropped"]
CLIENT_RESPONSES = ["interested", "not_interested", "callback_later", "no_answer"]
ACTIONS = ["login", "view_product", "add_to_cart", "logout", "purchase"]
DEVICES = ["mobile", "desktop"]
TICKET_STATUS_BY_CODE = {"O": "open", "F": "closed", "P": "in_progress"}
LOAN_STATUS_BY_CODE = {"O": "active", "F": "paid", "P": "overdue"}

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _pick(values: list[str], idx: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[idx.cast("int")]


def _code_map(col: str, mapping: dict[str, str]) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(F.col(col) == k, F.lit(v)) if out is None else out.when(F.col(col) == k, F.lit(v))
    return out


def iso(ts: Column, fmt: str = ISO_MICROS) -> Column:
    return F.date_format(ts, fmt)


# ------------------------------------------------------------------ readings
def readings_from_events(events: DataFrame) -> DataFrame:
    """T5 shape: ``event_type`` as the in/out flag, ``ts`` as noted time,
    ``value`` as temperature."""
    return events.select(
        F.col("event_type").alias("out/in"), F.col("ts").alias("noted_date"), F.col("value").alias("temp")
    )


# ------------------------------------------------------------------ sessions
def session_documents_from_events(events: DataFrame) -> DataFrame:
    """T8 documents, one per event: 1–4 pages, 0–5 actions (NULL list for
    signups, empty list for small values), NULL end for errors."""
    eid, uid, v = F.col("event_id"), F.col("user_id"), F.col("value")
    n_pages = (F.lit(1) + eid % 4).cast("int")
    pages = F.transform(
        F.sequence(F.lit(0), n_pages - 1),
        lambda i: F.concat(F.lit("/p/"), ((eid + i * uid) % 5).cast("string")),
    )
    n_actions = (F.lit(1) + uid % 5).cast("int")
    acts = F.transform(F.sequence(F.lit(0), n_actions - 1), lambda j: _pick(ACTIONS, (eid + j) % 5))
    actions = (
        F.when(F.col("event_type") == "signup", F.lit(None).cast("array<string>"))
        .when(v < 20, F.array().cast("array<string>"))
        .otherwise(acts)
    )
    end_ts = F.timestamp_add("MICROSECOND", F.round(v * 6_000_000).cast("long"), F.col("ts"))
    # Arrays first, renames second: a lambda body must not see the string
    # ``user_id`` alias of the same projection.
    with_arrays = events.select(
        "event_id", "user_id", "ts", "event_type",
        pages.alias("_pages"), actions.alias("_actions"), end_ts.alias("_end"),
    )
    return with_arrays.select(
        F.concat(F.lit("s"), eid.cast("string")).alias("session_id"),
        F.concat(F.lit("user_"), uid.cast("string")).alias("user_id"),
        iso(F.col("ts")).alias("start_time"),
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(iso(F.col("_end"))).alias("end_time"),
        F.col("_pages").alias("pages_visited"),
        _pick(DEVICES, uid % 2).alias("device"),
        F.col("_actions").alias("actions"),
    )


def session_documents_from_lines(lineitem: DataFrame) -> DataFrame:
    """T8 documents keyed by (order, line) — that key repeats in ``lineitem``,
    which makes it the dedupe (A14) input."""
    start = F.col("l_shipdate")
    end = F.timestamp_add("SECOND", (F.col("l_quantity") * 90).cast("long"), start)
    return lineitem.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("session_id"),
        F.concat(F.lit("user_"), F.col("l_suppkey").cast("string")).alias("user_id"),
        iso(start, ISO_SECONDS).alias("start_time"),
        iso(end, ISO_SECONDS).alias("end_time"),
        F.array(F.concat(F.lit("/part/"), F.col("l_partkey").cast("string"))).alias("pages_visited"),
        F.col("l_returnflag").alias("device"),
        F.array(F.col("l_linestatus")).alias("actions"),
    )


# ------------------------------------------------------------------ tickets
def ticket_documents_from_orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """T9 documents, one per order: updated = last ship date of its lines
    (NULL when it has none), two messages each."""
    last_ship = lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("_last_ship"))
    t = orders.join(last_ship, orders["o_orderkey"] == last_ship["l_orderkey"], "left")
    created = iso(F.col("o_orderdate"), ISO_SECONDS)
    messages = F.array(
        F.struct(
            F.lit("customer").alias("sender"),
            F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("message"),
            created.alias("timestamp"),
        ),
        F.struct(F.lit("support").alias("sender"), F.lit("received").alias("message"), created.alias("timestamp")),
    )
    return t.select(
        F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("ticket_id"),
        F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("user_id"),
        _code_map("o_orderstatus", TICKET_STATUS_BY_CODE).alias("status"),
        F.col("o_orderpriority").alias("issue_type"),
        messages.alias("messages"),
        created.alias("created_at"),
        iso(F.col("_last_ship"), ISO_SECONDS).alias("updated_at"),
    )


def ticket_documents_from_lines(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """T9 documents keyed by (order, line) — repeated keys for the dedupe."""
    j = lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"])
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("ticket_id"),
        F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("user_id"),
        _code_map("l_linestatus", TICKET_STATUS_BY_CODE).alias("status"),
        F.col("o_orderpriority").alias("issue_type"),
        F.lit(None).cast("array<struct<sender:string,message:string,timestamp:string>>").alias("messages"),
        iso(F.col("o_orderdate"), ISO_SECONDS).alias("created_at"),
        iso(F.col("l_shipdate"), ISO_SECONDS).alias("updated_at"),
    )


def ticket_rows_from_orders(orders: DataFrame, snapshot_status: str | None = None) -> DataFrame:
    """T12 rows straight from orders (updated = created + orderkey % 72 hours);
    ``snapshot_status`` freezes the status, as an older copy of the table."""
    created = F.col("o_orderdate").cast("timestamp_ntz")
    updated = F.timestamp_add("HOUR", F.col("o_orderkey") % 72, created)
    status = F.lit(snapshot_status) if snapshot_status else _code_map("o_orderstatus", TICKET_STATUS_BY_CODE)
    return orders.select(
        F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("ticket_id"),
        F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("user_id"),
        status.alias("status"),
        F.col("o_orderpriority").alias("issue_type"),
        created.alias("created_at"),
        updated.alias("updated_at"),
        ((F.col("o_orderkey") % 72).cast("double")).alias("resolution_time_hours"),
    )


# ------------------------------------------------------------------ loans
def loans_from_orders(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """T15 rows: one loan per order; region = borrower's nation name.

    ``nation`` is a fixed 25-row dimension; the join strategy is left to the
    optimizer's size check (``autoBroadcastJoinThreshold`` / AQE runtime stats).
    """
    oc = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
    ocn = oc.join(nation, oc["c_nationkey"] == nation["n_nationkey"], "left")
    return ocn.select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("c_name").alias("borrower_name"),
        (F.col("o_totalprice") * 2).alias("loan_amount"),
        (F.lit(5) + (F.col("c_custkey") % 20) / F.lit(2.0)).cast("double").alias("interest_rate"),
        (F.lit(12) * (F.lit(1) + F.col("o_orderkey") % 10)).cast("int").alias("loan_term_months"),
        F.to_date("o_orderdate").alias("issue_date"),
        _code_map("o_orderstatus", LOAN_STATUS_BY_CODE).alias("status"),
        F.col("n_name").alias("region"),
    )


# ------------------------------------------------------------------ call log (G1)
CALL_DAY_START = "2025-03-03 08:00:00"


def calls_from_orders(orders: DataFrame) -> DataFrame:
    """T20 rows, one call per order; every field is integer arithmetic on the
    order key, so the output does not depend on partitioning."""
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    start = F.to_timestamp_ntz(F.lit(CALL_DAY_START))
    return orders.select(
        F.format_string("c-%09d", ok).alias("call_id"),
        F.timestamp_add("SECOND", (ok * 7919) % 80000, start).alias("call_time"),
        F.concat(F.lit("client_"), (F.lit(20000) + (ck * 31) % 70000).cast("string")).alias("client_id"),
        _pick(REGIONS, ok % 5).alias("region_code"),
        _pick(CAMPAIGNS, ck % 4).alias("campaign_type"),
        _pick(CALL_STATUSES, F.floor(ok / 7) % 3).alias("call_status"),
        _pick(CLIENT_RESPONSES, (ok + ck) % 4).alias("client_response"),
        ((ok * 13) % 900).cast("int").alias("duration_sec"),
        (((ok + ck) % 2) == 0).alias("follow_up_required"),
    )


# ------------------------------------------------------------------ messages
def message_envelopes_from_events(events: DataFrame) -> DataFrame:
    """T19 envelopes: each event encoded as a loan message; some event kinds
    carry a payload the decoder must reject (other JSON, ``null``, arrays,
    string keys, NULL) or partially accept (non-integer amount, extra field)."""
    et, v, eid, uid = F.col("event_type"), F.col("value"), F.col("event_id"), F.col("user_id")
    good = F.to_json(
        F.struct(
            eid.alias("loan_id"),
            F.concat(F.lit("user_"), uid.cast("string")).alias("borrower"),
            F.round(v * 100).cast("long").alias("amount"),
            et.alias("status"),
        )
    )
    payload = (
        F.when(et == "error", F.col("props"))
        .when((et == "signup") & (v < 50), F.lit("null"))
        .when((et == "signup") & (v >= 480), F.lit(None).cast("string"))
        .when((et == "click") & (v > 400), F.concat(F.lit("["), eid.cast("string"), F.lit("]")))
        .when((et == "purchase") & (v > 450), F.concat(F.lit('{"loan_id":"'), eid.cast("string"), F.lit('"}')))
        .when(
            (et == "view") & (v > 450),
            F.concat(
                F.lit('{"loan_id":'), eid.cast("string"),
                F.lit(',"borrower":"user_'), uid.cast("string"),
                F.lit('","amount":'), v.cast("string"),
                F.lit(',"status":"view","extra":true}'),
            ),
        )
        .otherwise(good)
    )
    return events.select(payload.cast("binary").alias("value"), F.col("ts").alias("timestamp"))


# ------------------------------------------------------------------ documents
def pet_documents_from_parts(part: DataFrame) -> DataFrame:
    """T1 JSON text, one document per part: a pet per part (favourite foods =
    words of the name; missing key / empty list / missing birth year by size
    rule), a second pet for large sizes, an empty ``pets`` list for size 13."""
    size = F.col("p_size")
    fav = (
        F.when(size % 7 == 0, F.lit(None).cast("array<string>"))
        .when(size % 7 == 1, F.array().cast("array<string>"))
        .otherwise(F.split(F.col("p_name"), " "))
    )
    pet_a = F.struct(
        F.col("p_name").alias("name"),
        F.col("p_type").alias("species"),
        F.when(size % 10 != 0, F.lit(1990) + size).alias("birthYear"),
        fav.alias("favFoods"),
        F.concat(F.lit("img/"), F.col("p_brand"), F.lit(".jpg")).alias("photo"),
    )
    pet_b = F.struct(
        F.concat(F.col("p_name"), F.lit(" junior")).alias("name"),
        F.col("p_type").alias("species"),
        F.lit(2020).alias("birthYear"),
        F.array(F.lit("kibble")).alias("favFoods"),
        F.lit(None).cast("string").alias("photo"),
    )
    pets = (
        F.when(size == 13, F.array().cast(PETS_DOCUMENT["pets"].dataType))
        .when(size > 40, F.array(pet_a, pet_b))
        .otherwise(F.array(pet_a))
    )
    return part.select(F.to_json(F.struct(pets.alias("pets"))).alias("doc"))


def food_xml_from_parts(part: DataFrame) -> DataFrame:
    """T3 ``<food>`` XML text, one record per part, with absent elements, empty
    elements, empty attributes and zeros chosen by size rules."""
    size, price, key = F.col("p_size"), F.col("p_retailprice"), F.col("p_partkey")

    def el(tag: str, text: Column) -> Column:
        return F.concat(F.lit(f"<{tag}>"), text, F.lit(f"</{tag}>"))

    def s(c: Column) -> Column:
        return c.cast("string")

    serving = F.concat(
        F.lit("<serving"),
        F.when(size % 5 != 0, F.lit(' units="g"')).otherwise(F.lit("")),
        F.when(size % 9 == 0, F.lit("/>")).otherwise(F.concat(F.lit(">"), s(size), F.lit("</serving>"))),
    )
    calories = F.concat(
        F.lit('<calories total="'), s(price), F.lit('" fat="'),
        F.when(size % 4 == 0, F.lit("")).otherwise(s(size)), F.lit('"/>'),
    )
    parts = [
        F.lit("<food>"),
        el("name", xml_escape(F.col("p_name"))),
        F.when(size % 8 != 0, el("mfr", xml_escape(F.col("p_brand")))).otherwise(F.lit("")),
        serving,
        calories,
        el("total-fat", F.when(size % 3 == 0, F.lit("0")).otherwise(s(size / 4.0))),
        F.when(size % 2 == 0, F.lit("<saturated-fat></saturated-fat>")).otherwise(el("saturated-fat", s(size / 8.0))),
        el("cholesterol", s(key % 300)),
        el("sodium", s(price * 2)),
        el("carb", s(size + 10)),
        F.when(size % 7 != 0, el("fiber", F.lit("1.5"))).otherwise(F.lit("")),
        el("protein", s(size / 2.0)),
        F.when(
            size % 11 != 0,
            F.concat(F.lit("<vitamins>"), el("a", s(size)), el("c", F.lit("0")), F.lit("</vitamins>")),
        ).otherwise(F.lit("")),
        F.concat(F.lit("<minerals>"), el("ca", s(price / 100)), el("fe", s(size % 10)), F.lit("</minerals>")),
        F.lit("</food>"),
    ]
    return part.select(F.concat(*parts).alias("xml"))


def delivery_documents_from_orders(orders: DataFrame, lineitem: DataFrame, items: bool = True) -> DataFrame:
    """T21 documents (a ``doc`` struct typed as ``DELIVERY_ORDER_DOC``), one per
    order: its lines are the items in line order (add-ons by discount band), an
    order with a returned line adds one bag item, and the status steps are
    created, shipped (first ship date) and delivered (last ship date).  An order
    without lines keeps its header, no items and the first step.

    The lines nested in a document are those of its own order, a bounded list; the
    two sides meet in one shuffle on the order key.  ``items=False`` leaves the items
    NULL: for readers of the other sections the lines are then only aggregated."""
    disc, tax = F.col("l_discount"), F.col("l_tax")
    addon_t = "array<struct<name:string,price:double>>"
    addons = (
        F.when(disc > 0.05, F.array(
            F.struct(F.lit("Discount").alias("name"), disc.alias("price")),
            F.struct(F.lit("Tax").alias("name"), tax.alias("price")),
        ))
        .when(disc > 0.02, F.array(F.struct(F.lit("Tax").alias("name"), tax.alias("price"))))
        .otherwise(F.array().cast(addon_t))
    )
    line = F.struct(
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").cast("string").alias("dish_id"),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("name"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("x")).alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        addons.alias("addons"),
    )
    lines = [F.sort_array(F.collect_list(line)).alias("lines")] if items else []
    per_order = lineitem.groupBy("l_orderkey").agg(
        *lines,
        F.max(F.col("l_returnflag") == "R").alias("returned"),
        F.min("l_shipdate").alias("shipped"),
        F.max("l_shipdate").alias("delivered"),
        F.min("l_suppkey").alias("supplier"),
        F.max("l_tax").alias("fee"),
    )
    j = orders.join(per_order, orders["o_orderkey"] == per_order["l_orderkey"], "left")
    item_t = DELIVERY_ORDER_DOC["data"].dataType["items"].dataType
    if items:
        none_yet = F.array().cast(per_order.schema["lines"].dataType)
        plain = F.transform(F.coalesce("lines", none_yet), lambda x: x.dropFields("line"))
    bag = F.array(F.struct(
        F.lit("bag").alias("dish_id"), F.lit("Delivery bag").alias("name"), F.lit("1x").alias("quantity"),
        F.lit(0.5).alias("price"), F.array().cast(addon_t).alias("addons"),
    )).cast(item_t)
    nested = F.when(F.col("returned"), F.concat(plain, bag)).otherwise(plain) if items else F.lit(None).cast(item_t)

    def step(status: str, time: Column) -> Column:
        return F.struct(F.lit(status).alias("status"), iso(time, ISO_SECONDS).alias("time"))

    created = step("created", F.col("o_orderdate"))
    delivered = F.timestamp_add("MINUTE", F.lit(15), F.col("delivered"))
    history = F.when(
        F.col("shipped").isNotNull(), F.array(created, step("shipped", F.col("shipped")), step("delivered", delivered))
    ).otherwise(F.array(created))
    address_t = "struct<street:string,city:string,state:string,zip:string>"
    none = F.lit(None).cast("string")
    address = F.struct(
        none.alias("street"), F.concat(F.lit("City"), (F.col("o_custkey") % 10).cast("string")).alias("city"),
        none.alias("state"), none.alias("zip"),
    )
    supplier = F.col("supplier").cast("string")
    data = F.struct(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd").alias("date"),
        F.struct(
            F.col("o_custkey").cast("string").alias("id"),
            F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("name"),
            none.alias("phone"),
            address.alias("address"),
        ).alias("customer"),
        F.struct(
            supplier.alias("id"),
            F.concat(F.lit("Supplier "), supplier).alias("name"),
            F.lit(None).cast(address_t).alias("address"),
        ).alias("restaurant"),
        F.struct(
            F.lit("courier").alias("type"),
            none.alias("courier_name"),
            none.alias("courier_phone"),
            iso(F.timestamp_add("MINUTE", F.lit(30), F.col("shipped")), ISO_SECONDS).alias("eta"),
            (F.col("fee") * 100).alias("fee"),
            none.alias("instructions"),
        ).alias("delivery"),
        F.struct(
            F.when(F.col("o_orderpriority").startswith("1"), F.lit("card")).otherwise(F.lit("cash")).alias("method"),
            F.col("o_totalprice").alias("total"),
            F.lit("USD").alias("currency"),
        ).alias("payment"),
        nested.alias("items"),
        history.alias("status_history"),
    )
    return j.select(F.struct(F.lit("success").alias("status"), data.alias("data")).alias("doc"))
