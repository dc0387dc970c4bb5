"""Explicit schemas for every dataset the library reads or writes.

Sources are always read with one of these (no inference); sinks are checked
against them by ``sluice.operators.contracts``.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _s(*fields: StructField) -> StructType:
    return StructType(list(fields))


def _f(name, dtype, nullable=True) -> StructField:
    return StructField(name, dtype, nullable)


# T1 — pets document: {"pets": [{name, species, birthYear, favFoods[], photo}]}
PET = _s(
    _f("name", StringType()),
    _f("species", StringType()),
    _f("birthYear", IntegerType()),
    _f("favFoods", ArrayType(StringType())),
    _f("photo", StringType()),
)
PETS_DOCUMENT = _s(_f("pets", ArrayType(PET)))

# T2 — flattened pets
PETS_FLAT = _s(
    _f("name", StringType()),
    _f("species", StringType()),
    _f("birth_year", IntegerType()),
    _f("fav_foods", StringType()),
    _f("photo", StringType()),
)

# T3 — one <food> record.  Leaves are read as text and typed afterwards so that
# an empty element/attribute gives NULL for that field only (a typed XML schema
# drops the rest of the record after the first unparsable value).
FOOD_XML = _s(
    _f("name", StringType()),
    _f("mfr", StringType()),
    _f("serving", _s(_f("_VALUE", StringType()), _f("_units", StringType()))),
    _f("calories", _s(_f("_total", StringType()), _f("_fat", StringType()))),
    _f("total-fat", StringType()),
    _f("saturated-fat", StringType()),
    _f("cholesterol", StringType()),
    _f("sodium", StringType()),
    _f("carb", StringType()),
    _f("fiber", StringType()),
    _f("protein", StringType()),
    _f("vitamins", _s(_f("a", StringType()), _f("c", StringType()))),
    _f("minerals", _s(_f("ca", StringType()), _f("fe", StringType()))),
)

# T4 — flattened nutrition rows (17 columns)
NUTRITION_NUMERIC = [
    "calories_total", "calories_fat", "total_fat", "saturated_fat", "cholesterol", "sodium",
    "carb", "fiber", "protein", "vit_a", "vit_c", "min_ca", "min_fe",
]
NUTRITION_FLAT = _s(
    _f("name", StringType()),
    _f("mfr", StringType()),
    _f("serving", DoubleType()),
    _f("serving_units", StringType()),
    *[_f(c, DoubleType()) for c in NUTRITION_NUMERIC],
)

# T5 — temperature readings CSV
TEMP_READINGS = _s(
    _f("out/in", StringType()),
    _f("noted_date", StringType()),
    _f("temp", DoubleType()),
)

# T7 — daily aggregate (key: date);  T6 adds ``type``
TEMP_DAILY = _s(
    _f("date", DateType()),
    _f("avg_temp", DoubleType()),
    _f("min_temp", DoubleType()),
    _f("max_temp", DoubleType()),
    _f("reading_count", LongType()),
)
TEMP_EXTREMES = _s(*TEMP_DAILY.fields, _f("type", StringType()))
# T7 as stored by the incremental load: partitioned by month ("yyyy-MM")
TEMP_DAILY_BY_MONTH = _s(*TEMP_DAILY.fields, _f("month", StringType()))

# T8 — session documents
USER_SESSION_DOC = _s(
    _f("session_id", StringType()),
    _f("user_id", StringType()),
    _f("start_time", StringType()),
    _f("end_time", StringType()),
    _f("pages_visited", ArrayType(StringType())),
    _f("device", StringType()),
    _f("actions", ArrayType(StringType())),
)

# T9 — ticket documents
TICKET_MESSAGE = _s(_f("sender", StringType()), _f("message", StringType()), _f("timestamp", StringType()))
SUPPORT_TICKET_DOC = _s(
    _f("ticket_id", StringType()),
    _f("user_id", StringType()),
    _f("status", StringType()),
    _f("issue_type", StringType()),
    _f("messages", ArrayType(TICKET_MESSAGE)),
    _f("created_at", StringType()),
    _f("updated_at", StringType()),
)

# T10–T12 — relational side
USERS = _s(_f("user_id", StringType(), False))
USER_SESSIONS_RAW = _s(
    _f("session_id", StringType(), False),
    _f("user_id", StringType()),
    _f("start_time", TimestampNTZType(), False),
    _f("end_time", TimestampNTZType()),
    _f("pages_visited", ArrayType(StringType())),
    _f("device", StringType()),
    _f("actions", ArrayType(StringType())),
    _f("duration", DoubleType()),
)
SUPPORT_TICKETS = _s(
    _f("ticket_id", StringType(), False),
    _f("user_id", StringType()),
    _f("status", StringType()),
    _f("issue_type", StringType()),
    _f("created_at", TimestampNTZType()),
    _f("updated_at", TimestampNTZType()),
    _f("resolution_time_hours", DoubleType()),
)

# T13, T14 — marts
USER_ACTIVITY_MART = _s(
    _f("user_id", StringType()),
    _f("session_count", LongType()),
    _f("avg_session_min", DoubleType()),
    _f("activity_date", DateType()),
    _f("most_popular_page", StringType()),
    _f("most_popular_action", StringType()),
)
SUPPORT_EFFICIENCY_MART = _s(
    _f("issue_type", StringType()),
    _f("status", StringType()),
    _f("ticket_count", LongType()),
    _f("avg_resolution_hours", DoubleType()),
    _f("open_tickets", LongType()),
)

# T15 — loans input (CSV)
LOANS_INPUT = _s(
    _f("loan_id", LongType()),
    _f("borrower_name", StringType()),
    _f("loan_amount", DoubleType()),
    _f("interest_rate", DoubleType()),
    _f("loan_term_months", IntegerType()),
    _f("issue_date", DateType()),
    _f("status", StringType()),
    _f("region", StringType()),
)
# Raw text form, typed by ``sluice.plans.loans.type_loans`` (strict or lenient).
LOANS_INPUT_TEXT = _s(*[_f(f.name, StringType()) for f in LOANS_INPUT.fields])

# T18 — loan message value; T19 — message envelope
LOAN_MESSAGE = _s(
    _f("loan_id", LongType()),
    _f("borrower", StringType()),
    _f("amount", LongType()),
    _f("status", StringType()),
)
MESSAGE_ENVELOPE = _s(_f("value", BinaryType()), _f("timestamp", TimestampType()))

# T20 — call log
CALL_LOG = _s(
    _f("call_id", StringType(), False),
    _f("call_time", TimestampType()),
    _f("client_id", StringType()),
    _f("region_code", StringType()),
    _f("campaign_type", StringType()),
    _f("call_status", StringType()),
    _f("client_response", StringType()),
    _f("duration_sec", IntegerType()),
    _f("follow_up_required", BooleanType()),
)

# T21 — delivery order document
ADDRESS = _s(_f("street", StringType()), _f("city", StringType()), _f("state", StringType()), _f("zip", StringType()))
ORDER_ADDON = _s(_f("name", StringType()), _f("price", DoubleType()))
ORDER_ITEM = _s(
    _f("dish_id", StringType()),
    _f("name", StringType()),
    _f("quantity", StringType()),
    _f("price", DoubleType()),
    _f("addons", ArrayType(ORDER_ADDON)),
)
ORDER_STATUS_STEP = _s(_f("status", StringType()), _f("time", StringType()))
DELIVERY_ORDER_DOC = _s(
    _f("status", StringType()),
    _f(
        "data",
        _s(
            _f("order_id", StringType()),
            _f("date", StringType()),
            _f("customer", _s(_f("id", StringType()), _f("name", StringType()), _f("phone", StringType()), _f("address", ADDRESS))),
            _f("restaurant", _s(_f("id", StringType()), _f("name", StringType()), _f("address", ADDRESS))),
            _f(
                "delivery",
                _s(
                    _f("type", StringType()),
                    _f("courier_name", StringType()),
                    _f("courier_phone", StringType()),
                    _f("eta", StringType()),
                    _f("fee", DoubleType()),
                    _f("instructions", StringType()),
                ),
            ),
            _f("payment", _s(_f("method", StringType()), _f("total", DoubleType()), _f("currency", StringType()))),
            _f("items", ArrayType(ORDER_ITEM)),
            _f("status_history", ArrayType(ORDER_STATUS_STEP)),
        ),
    ),
)
