"""Nested documents: pets JSON (X1), nutrition XML (X2), delivery orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import join_list, text_to_double
from sluice.functions.time import minutes_between, parse_iso
from sluice.operators.nested import explode_records, quantity_to_int


def pets_flat(documents: DataFrame, doc_col: str | None = None) -> DataFrame:
    """S1 -> P1 -> F3 -> P2.  ``documents`` holds a ``pets`` array column
    (from ``read_json_documents``) or, with ``doc_col``, a parsed struct."""
    src = documents.select(F.col(f"{doc_col}.pets").alias("pets")) if doc_col else documents.select("pets")
    return pet_rows(explode_records(src, "pets"))


def pet_rows(records: DataFrame) -> DataFrame:
    """The flat rows of single records (from ``read_json_records``)."""
    return records.select(
        "name",
        "species",
        F.col("birthYear").alias("birth_year"),
        join_list("favFoods").alias("fav_foods"),
        "photo",
    )


def nutrition_flat(foods: DataFrame, food_col: str | None = None, lenient: bool = False) -> DataFrame:
    """``<food>`` records -> 17 typed columns.

    Leaves arrive as text (see ``schemas.FOOD_XML``); absent or empty values
    become NULL, ``"0"`` stays 0.0, junk raises unless ``lenient``.
    """
    r = (lambda c: F.col(f"{food_col}.`{c}`")) if food_col else (lambda c: F.col(f"`{c}`"))

    def num(c: Column) -> Column:
        return text_to_double(c, lenient)

    return foods.select(
        r("name").alias("name"),
        r("mfr").alias("mfr"),
        num(r("serving")["_VALUE"]).alias("serving"),
        r("serving")["_units"].alias("serving_units"),
        num(r("calories")["_total"]).alias("calories_total"),
        num(r("calories")["_fat"]).alias("calories_fat"),
        num(r("total-fat")).alias("total_fat"),
        num(r("saturated-fat")).alias("saturated_fat"),
        num(r("cholesterol")).alias("cholesterol"),
        num(r("sodium")).alias("sodium"),
        num(r("carb")).alias("carb"),
        num(r("fiber")).alias("fiber"),
        num(r("protein")).alias("protein"),
        num(r("vitamins")["a"]).alias("vit_a"),
        num(r("vitamins")["c"]).alias("vit_c"),
        num(r("minerals")["ca"]).alias("min_ca"),
        num(r("minerals")["fe"]).alias("min_fe"),
    )


def _doc(doc_col: str | None, field: str) -> Column:
    """A top-level document field; ``doc_col=None`` means the document's fields
    are the frame's columns (as ``read_json_documents`` returns them)."""
    return F.col(f"{doc_col}.{field}") if doc_col else F.col(field)


def order_headers(orders: DataFrame, doc_col: str | None = "doc") -> DataFrame:
    """One row per order document, nested header fields flattened."""
    d = _doc(doc_col, "data")
    return orders.select(
        d["order_id"].alias("order_id"),
        F.to_date(d["date"]).alias("order_date"),
        _doc(doc_col, "status").alias("response_status"),
        d["customer"]["id"].alias("customer_id"),
        d["customer"]["name"].alias("customer_name"),
        d["customer"]["address"]["city"].alias("customer_city"),
        d["restaurant"]["id"].alias("restaurant_id"),
        d["restaurant"]["name"].alias("restaurant_name"),
        d["delivery"]["type"].alias("delivery_type"),
        parse_iso(d["delivery"]["eta"]).alias("delivery_eta"),
        d["delivery"]["fee"].alias("delivery_fee"),
        d["payment"]["method"].alias("payment_method"),
        d["payment"]["total"].alias("payment_total"),
        d["payment"]["currency"].alias("currency"),
    )


def order_items(orders: DataFrame, doc_col: str | None = "doc") -> DataFrame:
    """N2 + N3: one row per (item, add-on); an item without add-ons keeps one
    row with NULL add-on (outer explode).  ``"2x"`` -> 2."""
    d = _doc(doc_col, "data")
    items = orders.select(d["order_id"].alias("order_id"), F.posexplode(d["items"]).alias("item_pos", "item"))
    with_addons = items.select(
        "order_id", "item_pos",
        F.col("item.dish_id").alias("dish_id"),
        F.col("item.name").alias("dish_name"),
        quantity_to_int(F.col("item.quantity")).alias("quantity"),
        F.col("item.price").alias("price"),
        F.explode_outer("item.addons").alias("addon"),
    )
    return with_addons.select(
        "order_id", "item_pos", "dish_id", "dish_name", "quantity", "price",
        F.col("addon.name").alias("addon_name"),
        F.col("addon.price").alias("addon_price"),
    )


def order_item_totals(orders: DataFrame, doc_col: str | None = "doc") -> DataFrame:
    """Per order, items subtotal = sum(quantity * (price + add-on prices)),
    computed per document with higher-order functions (no explode/shuffle)."""
    d = _doc(doc_col, "data")
    per_item = F.transform(
        d["items"],
        lambda it: quantity_to_int(it["quantity"]) * (
            it["price"] + F.aggregate(it["addons"], F.lit(0.0), lambda acc, a: acc + F.coalesce(a["price"], F.lit(0.0)))
        ),
    )
    return orders.select(
        d["order_id"].alias("order_id"),
        F.size(d["items"]).alias("n_items"),
        F.aggregate(per_item, F.lit(0.0), lambda acc, v: acc + F.coalesce(v, F.lit(0.0))).alias("items_subtotal"),
    )


def order_status_steps(orders: DataFrame, doc_col: str | None = "doc") -> DataFrame:
    """One row per status step with minutes since the previous step.

    The previous step is the previous array element of the same document, so
    this is a per-row ``posexplode`` — no window, no shuffle."""
    d = _doc(doc_col, "data")
    hist = d["status_history"]
    steps = orders.select(
        d["order_id"].alias("order_id"),
        hist.alias("_h"),
        F.posexplode(hist).alias("step", "cur"),
    )
    prev = F.when(F.col("step") > 0, F.col("_h")[F.col("step") - 1])
    return steps.select(
        "order_id",
        "step",
        F.col("cur.status").alias("status"),
        parse_iso(F.col("cur.time")).alias("status_time"),
        prev["status"].alias("prev_status"),
        minutes_between(parse_iso(prev["time"]), parse_iso(F.col("cur.time"))).alias("minutes_since_prev"),
    )
