"""DuckDB SQL oracles for ``catalog.QUERIES`` (same column names).

Written independently of the Spark code, straight from the operator
semantics.  Rounding notes: Spark ``round`` is HALF_UP on the decimal text of
a double, reproduced with a cast through VARCHAR/DECIMAL; numpy rounding is
``round_even(x * 100, 0) / 100``; DuckDB ``sum(int)`` is HUGEINT, so counts
are cast to BIGINT where Spark yields bigint.
"""

from __future__ import annotations

from sluice.plans import catalog as C
from sluice.plans.derived import ACTIONS, CALL_STATUSES, CAMPAIGNS, CLIENT_RESPONSES, REGIONS


def _r(x: str, d: int) -> str:
    """Spark ``round(x, d)`` (HALF_UP on the shortest decimal text)."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,16)), {d}) AS DOUBLE)"


def _np(x: str) -> str:
    """numpy ``round(x, 2)``."""
    return f"(round_even(({x}) * 100, 0) / 100)"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _daily(src: str, name: str) -> str:
    return f"""
{name}_b AS (SELECT quantile_cont(temp, 0.05) AS lo, quantile_cont(temp, 0.95) AS hi FROM {src} WHERE temp IS NOT NULL),
{name}_t AS (SELECT s.date, s.temp FROM {src} s, {name}_b b WHERE s.temp >= b.lo AND s.temp <= b.hi),
{name} AS (
  SELECT date, {_np('avg(temp)')} AS avg_temp, {_np('min(temp)')} AS min_temp, {_np('max(temp)')} AS max_temp,
         count(temp) AS reading_count
  FROM {name}_t WHERE date IS NOT NULL GROUP BY date)"""


_READINGS = "r AS (SELECT CAST(ts AS DATE) AS date, value AS temp FROM events WHERE lower(trim(event_type)) = 'view')"

_LOANS = """l AS (
  SELECT o_orderkey AS loan_id, c_name AS borrower_name, o_totalprice * 2 AS loan_amount,
         CAST(5 + CAST(c_custkey % 20 AS DOUBLE) / 2.0 AS DOUBLE) AS interest_rate,
         CAST(12 * (1 + o_orderkey % 10) AS INTEGER) AS loan_term_months,
         CAST(o_orderdate AS DATE) AS issue_date,
         CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'paid' WHEN 'P' THEN 'overdue' END AS status,
         n_name AS region
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)"""

_SESSIONS = f"""s AS (
  SELECT 's' || event_id AS session_id, 'user_' || user_id AS user_id, ts AS start_time,
         CASE WHEN event_type = 'error' THEN NULL
              ELSE ts + to_microseconds(CAST(round(value * 6000000) AS BIGINT)) END AS end_time,
         list_transform(range(1 + event_id % 4), lambda i: '/p/' || ((event_id + i * user_id) % 5)) AS pages_visited,
         CASE WHEN event_type = 'signup' THEN NULL
              WHEN value < 20 THEN []::VARCHAR[]
              ELSE list_transform(range(1 + user_id % 5), lambda j: ({_list(ACTIONS)})[((event_id + j) % 5) + 1]) END AS actions
  FROM events),
days AS (
  SELECT user_id, CAST(start_time AS DATE) AS activity_date, start_time, pages_visited, actions,
         (epoch_us(end_time) - epoch_us(start_time)) / CAST(60000000.0 AS DOUBLE) AS minutes
  FROM s)"""


def _favourite(lists: str, out: str) -> str:
    """Per user and day the item with most hits in ``lists`` (user_id, activity_date,
    item): the least of (-hits, item is missing, item)."""
    return f"""{out} AS (
  SELECT user_id, activity_date, min({{'h': -hits, 'missing': item IS NULL, 'item': item}}).item AS item FROM (
    SELECT user_id, activity_date, item, count(*) AS hits FROM {lists} GROUP BY ALL) GROUP BY ALL)"""


def _activity(pages: str, actions: str) -> str:
    """The activity mart from rows of viewed pages and of actions."""
    return f"""WITH {_SESSIONS},
pages AS ({pages}),
acts AS ({actions}),
{_favourite('pages', 'page_of')},
{_favourite('acts', 'action_of')}
SELECT user_id, activity_date, count(DISTINCT start_time) AS session_count, {_r('avg(minutes)', 6)} AS avg_session_min,
       (SELECT item FROM page_of p WHERE p.user_id = d.user_id AND p.activity_date = d.activity_date) AS most_popular_page,
       (SELECT item FROM action_of a WHERE a.user_id = d.user_id AND a.activity_date = d.activity_date) AS most_popular_action
FROM days d GROUP BY user_id, activity_date"""


def _padded(own: str, other: str) -> str:
    """Items of one list; as the other list runs along with it, missing ones up to its length."""
    return f"""SELECT user_id, activity_date, unnest(list_resize(coalesce({own}, []),
    greatest(len(coalesce({own}, [])), len(coalesce({other}, []))))) AS item FROM days"""


def _bare(own: str) -> str:
    return f"SELECT user_id, activity_date, unnest({own}) AS item FROM days"


_ISO_S = "'%Y-%m-%dT%H:%M:%SZ'"


def _daily_orders(where: str) -> str:
    return f"""SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS order_count, {_r('sum(o_totalprice)', 2)} AS revenue
  FROM orders WHERE {where} GROUP BY CAST(o_orderdate AS DATE)"""


def _calls(where: str = "TRUE") -> str:
    return f"""SELECT printf('c-%09d', o_orderkey) AS call_id,
       TIMESTAMP '{C.D.CALL_DAY_START}' + to_seconds((o_orderkey * 7919) % 80000) AS call_time,
       'client_' || (20000 + (o_custkey * 31) % 70000) AS client_id,
       ({_list(REGIONS)})[(o_orderkey % 5) + 1] AS region_code,
       ({_list(CAMPAIGNS)})[(o_custkey % 4) + 1] AS campaign_type,
       ({_list(CALL_STATUSES)})[((o_orderkey // 7) % 3) + 1] AS call_status,
       ({_list(CLIENT_RESPONSES)})[((o_orderkey + o_custkey) % 4) + 1] AS client_response,
       CAST((o_orderkey * 13) % 900 AS INTEGER) AS duration_sec,
       ((o_orderkey + o_custkey) % 2) = 0 AS follow_up_required
FROM orders WHERE {where}"""


_MESSAGES = """SELECT event_id AS loan_id, 'user_' || user_id AS borrower,
       CASE WHEN event_type = 'view' AND value > 450 THEN NULL ELSE CAST(round(value * 100) AS BIGINT) END AS amount,
       event_type AS status, ts AS timestamp
FROM events
WHERE NOT (event_type = 'error'
           OR (event_type = 'signup' AND (value < 50 OR value >= 480))
           OR (event_type = 'click' AND value > 400)
           OR (event_type = 'purchase' AND value > 450))"""

_TICKET_ROWS = """SELECT 't' || o_orderkey AS ticket_id, 'user_' || o_custkey AS user_id, {status} AS status,
         o_orderpriority AS issue_type, o_orderdate AS created_at,
         o_orderdate + to_hours(o_orderkey % 72) AS updated_at,
         CAST(o_orderkey % 72 AS DOUBLE) AS resolution_time_hours
  FROM orders WHERE {where}"""

_TICKET_STATUS = "CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'closed' WHEN 'P' THEN 'in_progress' END"

_LINE_DOCS = "j AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
_ORDER_ID = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"


ORACLE_SQL: dict[str, str] = {
    "loan_details": f"""WITH {_LOANS}
SELECT *, {_r('loan_amount * (1 + interest_rate / 100 * loan_term_months / 12)', 2)} AS total_payment,
       CASE WHEN loan_amount < 300000 THEN 'small' WHEN loan_amount < 700000 THEN 'medium' ELSE 'large' END AS loan_category,
       {_r("CAST(date_diff('day', issue_date, DATE '" + C.LOANS_AS_OF + "') AS DOUBLE) / CAST(365.0 AS DOUBLE)", 1)} AS years_since_issue,
       coalesce(status = 'overdue', false) AS is_problem
FROM l""",
    "loan_region_stats": f"""WITH {_LOANS}
SELECT region, count(*) AS total_loans, {_r('sum(loan_amount)', 2)} AS total_amount,
       {_r('avg(loan_amount)', 2)} AS avg_amount, {_r('avg(interest_rate)', 2)} AS avg_rate,
       CAST(sum(CASE WHEN status = 'overdue' THEN 1 ELSE 0 END) AS BIGINT) AS problem_loans
FROM l GROUP BY region""",
    "loan_region_order": f"""WITH {_LOANS}
SELECT region, {_r('sum(loan_amount)', 2)} AS total_amount,
       row_number() OVER (ORDER BY {_r('sum(loan_amount)', 2)} DESC, region ASC NULLS LAST) AS place
FROM l GROUP BY region""",
    "temp_daily_full": f"WITH {_READINGS}, {_daily('r', 'daily')}\nSELECT * FROM daily",
    "temp_extremes": f"""WITH {_READINGS}, {_daily('r', 'daily')}
(SELECT *, 'hottest' AS type FROM daily ORDER BY avg_temp DESC, date ASC LIMIT 5)
UNION ALL
(SELECT *, 'coldest' AS type FROM daily ORDER BY avg_temp ASC, date ASC LIMIT 5)""",
    "user_activity": _activity(_padded("pages_visited", "actions"), _padded("actions", "pages_visited")),
    "user_activity_unpadded": _activity(_bare("pages_visited"), _bare("actions")),
    "support_efficiency": f"""WITH ls AS (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey),
t AS (
  SELECT o_orderpriority AS issue_type, {_TICKET_STATUS} AS status,
         CAST(epoch_us(ls.last_ship) - epoch_us(o_orderdate) AS DOUBLE) / 3600000000.0 AS hours
  FROM orders LEFT JOIN ls ON o_orderkey = ls.l_orderkey)
SELECT issue_type, status, count(*) AS ticket_count, {_r('avg(hours)', 6)} AS avg_resolution_hours,
       count(*) FILTER (WHERE status = 'open') AS open_tickets
FROM t GROUP BY issue_type, status""",
    "sessions_dedupe": f"""WITH docs AS (
  SELECT {_ORDER_ID} AS session_id, 'user_' || l_suppkey AS user_id,
         strftime(l_shipdate, {_ISO_S}) AS start_s,
         strftime(l_shipdate + to_seconds(CAST(l_quantity * 90 AS BIGINT)), {_ISO_S}) AS end_s,
         ['/part/' || l_partkey] AS pages_visited, l_returnflag AS device, [l_linestatus] AS actions,
         l_shipdate AS start_time, l_shipdate + to_seconds(CAST(l_quantity * 90 AS BIGINT)) AS end_time
  FROM lineitem),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY start_s NULLS FIRST, end_s NULLS FIRST,
         user_id NULLS FIRST, device NULLS FIRST, pages_visited NULLS FIRST, actions NULLS FIRST) AS rn
  FROM docs)
SELECT session_id, user_id, start_time, end_time, device,
       CAST(epoch_us(end_time) - epoch_us(start_time) AS DOUBLE) / 60000000.0 AS duration
FROM ranked WHERE rn = 1""",
    "tickets_dedupe": f"""WITH {_LINE_DOCS},
docs AS (
  SELECT {_ORDER_ID} AS ticket_id, 'user_' || o_custkey AS user_id,
         CASE l_linestatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'closed' WHEN 'P' THEN 'in_progress' END AS status,
         o_orderpriority AS issue_type,
         strftime(o_orderdate, {_ISO_S}) AS created_s, strftime(l_shipdate, {_ISO_S}) AS updated_s,
         o_orderdate AS created_at, l_shipdate AS updated_at
  FROM j),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY ticket_id ORDER BY created_s NULLS FIRST, updated_s NULLS FIRST,
         status NULLS FIRST, issue_type NULLS FIRST, user_id NULLS FIRST) AS rn
  FROM docs)
SELECT ticket_id, user_id, status, issue_type, created_at, updated_at,
       CAST(epoch_us(updated_at) - epoch_us(created_at) AS DOUBLE) / 3600000000.0 AS resolution_time_hours
FROM ranked WHERE rn = 1""",
    "users_insert_absent": "SELECT DISTINCT 'user_' || o_custkey AS user_id FROM orders",
    "tickets_insert_absent": f"""WITH old AS ({_TICKET_ROWS.format(status="'open'", where="o_orderdate < TIMESTAMP '" + C.TICKETS_SNAPSHOT_END + "'")}),
new AS ({_TICKET_ROWS.format(status=_TICKET_STATUS, where="o_orderdate >= TIMESTAMP '" + C.USERS_SPLIT + "'")})
SELECT * FROM old
UNION ALL
SELECT * FROM new WHERE ticket_id NOT IN (SELECT ticket_id FROM old)""",
    "upsert_daily": f"""WITH tgt AS ({_daily_orders("o_orderdate < TIMESTAMP '" + C.DAILY_TARGET_END + "'")}),
bat AS ({_daily_orders("o_orderdate >= TIMESTAMP '" + C.DAILY_BATCH_START + "'")})
SELECT * FROM tgt WHERE date NOT IN (SELECT date FROM bat)
UNION ALL
SELECT * FROM bat""",
    "strict_insert": f"""{_daily_orders("o_orderdate < TIMESTAMP '" + C.DAILY_TARGET_END + "'")}
UNION ALL
{_daily_orders("o_orderdate >= TIMESTAMP '" + C.DAILY_TARGET_END + "'")}""",
    "synthetic_calls": _calls(),
    "calls_strict_insert": f"""{_calls("o_orderdate < TIMESTAMP '" + C.DAILY_TARGET_END + "'")}
UNION ALL
{_calls("o_orderdate >= TIMESTAMP '" + C.DAILY_TARGET_END + "'")}""",
    "snapshot_copy": _calls(),
    "message_decode": _MESSAGES,
    "message_decode_stream": _MESSAGES,
    "pets_flat": """SELECT p_name AS name, p_type AS species,
       CASE WHEN p_size % 10 = 0 THEN NULL ELSE 1990 + p_size END AS birth_year,
       CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 7 = 1 THEN ''
            ELSE array_to_string(string_split(p_name, ' '), ', ') END AS fav_foods,
       'img/' || p_brand || '.jpg' AS photo
FROM part WHERE p_size <> 13
UNION ALL
SELECT p_name || ' junior', p_type, 2020, 'kibble', NULL FROM part WHERE p_size > 40""",
    "nutrition_flat": """SELECT p_name AS name,
       CASE WHEN p_size % 8 <> 0 THEN p_brand END AS mfr,
       CASE WHEN p_size % 9 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS serving,
       CASE WHEN p_size % 5 <> 0 THEN 'g' END AS serving_units,
       p_retailprice AS calories_total,
       CASE WHEN p_size % 4 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS calories_fat,
       CASE WHEN p_size % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) / CAST(4 AS DOUBLE) END AS total_fat,
       CASE WHEN p_size % 2 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / CAST(8 AS DOUBLE) END AS saturated_fat,
       CAST(p_partkey % 300 AS DOUBLE) AS cholesterol,
       p_retailprice * 2 AS sodium,
       CAST(p_size + 10 AS DOUBLE) AS carb,
       CASE WHEN p_size % 7 <> 0 THEN CAST(1.5 AS DOUBLE) END AS fiber,
       CAST(p_size AS DOUBLE) / CAST(2 AS DOUBLE) AS protein,
       CASE WHEN p_size % 11 <> 0 THEN CAST(p_size AS DOUBLE) END AS vit_a,
       CASE WHEN p_size % 11 <> 0 THEN CAST(0 AS DOUBLE) END AS vit_c,
       p_retailprice / 100 AS min_ca,
       CAST(p_size % 10 AS DOUBLE) AS min_fe
FROM part""",
    "contract_violations": """SELECT 'lineitem_pk' AS check_name, count(*) AS n_violations FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber
  HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL)
UNION ALL SELECT 'orders_pk', count(*) FROM (
  SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1 OR o_orderkey IS NULL)
UNION ALL SELECT 'orders_not_null', count(*) FROM orders WHERE o_orderkey IS NULL OR o_custkey IS NULL OR o_orderdate IS NULL
UNION ALL SELECT 'orders_fk_customer', count(*) FROM orders
  WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
UNION ALL SELECT 'lineitem_fk_orders', count(*) FROM lineitem
  WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
UNION ALL SELECT 'orders_status_set', count(*) FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('O', 'F', 'P')
UNION ALL SELECT 'events_type_set', count(*) FROM events
  WHERE event_type IS NOT NULL AND event_type NOT IN ('view', 'click', 'purchase', 'signup', 'error')
UNION ALL SELECT 'customer_name_len', count(*) FROM customer WHERE length(c_name) > 25
UNION ALL SELECT 'part_name_len', count(*) FROM part WHERE length(p_name) > 10""",
}


_ISO_US = "'%Y-%m-%dT%H:%M:%S.%fZ'"

_LINES = """l AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,
           CAST(l_partkey AS VARCHAR), CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) || 'x', l_extendedprice) - 1 AS item_pos,
         CAST(l_partkey AS VARCHAR) AS dish_id, 'Part ' || l_partkey AS dish_name, CAST(trunc(l_quantity) AS INTEGER) AS quantity,
         l_extendedprice AS price, l_discount, l_tax, l_returnflag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
bags AS (SELECT order_id, count(*) AS item_pos FROM l GROUP BY order_id HAVING bool_or(l_returnflag = 'R')),
ships AS (SELECT l_orderkey AS k, min(l_shipdate) AS shipped, max(l_shipdate) AS delivered, min(l_suppkey) AS supplier,
            max(l_tax) AS fee FROM lineitem GROUP BY 1)"""

ORACLE_SQL["order_headers"] = f"""WITH {_LINES}
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS order_date, 'success' AS response_status,
       CAST(o_custkey AS VARCHAR) AS customer_id, 'Customer ' || o_custkey AS customer_name,
       'City' || (o_custkey % 10) AS customer_city,
       CAST(supplier AS VARCHAR) AS restaurant_id, 'Supplier ' || supplier AS restaurant_name,
       'courier' AS delivery_type, shipped + INTERVAL 30 MINUTE AS delivery_eta, fee * 100 AS delivery_fee,
       CASE WHEN starts_with(o_orderpriority, '1') THEN 'card' ELSE 'cash' END AS payment_method,
       o_totalprice AS payment_total, 'USD' AS currency
FROM orders LEFT JOIN ships ON k = o_orderkey"""

ORACLE_SQL["order_items"] = f"""WITH {_LINES}
SELECT order_id, CAST(item_pos AS INTEGER) AS item_pos, dish_id, dish_name, quantity, price,
       CASE WHEN a IS NULL THEN NULL WHEN a = 'd' THEN 'Discount' ELSE 'Tax' END AS addon_name,
       CASE WHEN a = 'd' THEN l_discount WHEN a = 't' THEN l_tax END AS addon_price
FROM (SELECT *, unnest(CASE WHEN l_discount > 0.05 THEN ['d', 't'] WHEN l_discount > 0.02 THEN ['t'] ELSE [NULL] END) AS a FROM l)
UNION ALL
SELECT order_id, CAST(item_pos AS INTEGER), 'bag', 'Delivery bag', 1, 0.5, NULL, NULL FROM bags"""

ORACLE_SQL["order_item_totals"] = f"""WITH {_LINES}
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       CAST(count(l.order_id) + count(DISTINCT bags.order_id) AS INTEGER) AS n_items,
       {_r("coalesce(sum(quantity * (price + CASE WHEN l_discount > 0.05 THEN l_discount + l_tax WHEN l_discount > 0.02 THEN l_tax ELSE 0 END)), 0) + 0.5 * count(DISTINCT bags.order_id)", 4)} AS items_subtotal
FROM orders LEFT JOIN l ON l.order_id = CAST(o_orderkey AS VARCHAR) LEFT JOIN bags ON bags.order_id = l.order_id
GROUP BY o_orderkey"""

ORACLE_SQL["order_status_steps"] = """WITH t AS (
  SELECT o_orderkey, o_orderdate, min(l_shipdate) AS shipped, max(l_shipdate) + INTERVAL 15 MINUTE AS delivered
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 0 AS step, 'created' AS status, o_orderdate AS status_time,
       CAST(NULL AS VARCHAR) AS prev_status, CAST(NULL AS DOUBLE) AS minutes_since_prev FROM t
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), 1, 'shipped', shipped, 'created',
       (epoch_us(shipped) - epoch_us(o_orderdate)) / CAST(60000000.0 AS DOUBLE) FROM t WHERE shipped IS NOT NULL
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), 2, 'delivered', delivered, 'shipped',
       (epoch_us(delivered) - epoch_us(shipped)) / CAST(60000000.0 AS DOUBLE) FROM t WHERE shipped IS NOT NULL"""

ORACLE_SQL["synthetic_sessions"] = f"""SELECT 's' || event_id AS session_id, 'user_' || user_id AS user_id,
       strftime(ts, {_ISO_US}) AS start_time,
       CASE WHEN event_type = 'error' THEN NULL
            ELSE strftime(ts + to_microseconds(CAST(round(value * 6000000) AS BIGINT)), {_ISO_US}) END AS end_time,
       ({_list(["mobile", "desktop"])})[(user_id % 2) + 1] AS device,
       array_to_string(list_transform(range(1 + event_id % 4), lambda i: '/p/' || ((event_id + i * user_id) % 5)), ',') AS pages_visited,
       CASE WHEN event_type = 'signup' THEN NULL
            WHEN value < 20 THEN ''
            ELSE array_to_string(list_transform(range(1 + user_id % 5),
                 lambda j: ({_list(ACTIONS)})[((event_id + j) % 5) + 1]), ',') END AS actions
FROM events"""

ORACLE_SQL["synthetic_tickets"] = f"""WITH ls AS (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey)
SELECT 't' || o_orderkey AS ticket_id, 'user_' || o_custkey AS user_id, {_TICKET_STATUS} AS status,
       o_orderpriority AS issue_type, strftime(o_orderdate, {_ISO_S}) AS created_at,
       strftime(ls.last_ship, {_ISO_S}) AS updated_at, 2 AS n_messages, 'order ' || o_orderkey AS first_message
FROM orders LEFT JOIN ls ON o_orderkey = ls.l_orderkey"""


def _incremental_sql(days_back: int) -> str:
    return f"""WITH {_READINGS},
r1 AS (SELECT * FROM r WHERE date <= DATE '{C.READINGS_TARGET_END}'),
{_daily('r1', 'tgt')},
cut AS (SELECT greatest(max(date), DATE '{C.READINGS_AS_OF}' - {days_back}) AS c FROM tgt),
r2 AS (SELECT r.* FROM r, cut WHERE r.date > cut.c),
{_daily('r2', 'bat')}
SELECT * FROM tgt WHERE date NOT IN (SELECT date FROM bat)
UNION ALL
SELECT * FROM bat"""


ORACLE_SQL["temp_daily_incremental_7"] = _incremental_sql(7)
ORACLE_SQL["temp_daily_incremental_15"] = _incremental_sql(15)
ORACLE_SQL["readings_csv"] = ORACLE_SQL["temp_daily_full"]
ORACLE_SQL["loans_csv"] = ORACLE_SQL["loan_details"]
ORACLE_SQL["upsert_daily_path"] = ORACLE_SQL["upsert_daily"]
ORACLE_SQL["strict_insert_path"] = ORACLE_SQL["strict_insert"]
ORACLE_SQL["users_two_feeds_path"] = """SELECT 'user_' || o_custkey AS user_id FROM orders
UNION SELECT 'user_' || user_id FROM events WHERE user_id IS NOT NULL"""
ORACLE_SQL["snapshot_documents"] = "SELECT doc_id, text, lang, source FROM documents"
ORACLE_SQL["append_twice"] = """SELECT c_custkey, c_name, count(*) AS copies FROM (
  SELECT * FROM customer UNION ALL SELECT * FROM customer) GROUP BY ALL"""
ORACLE_SQL["replace_round_trip"] = "SELECT c_custkey, c_name, c_nationkey FROM customer"
ORACLE_SQL["message_encode"] = """SELECT '{"c_custkey":' || c_custkey || ',"c_nationkey":' || c_nationkey || '}' AS value FROM customer"""
ORACLE_SQL["stream_csv_restart"] = _MESSAGES
ORACLE_SQL["pets_json_files"] = ORACLE_SQL["pets_flat"]
ORACLE_SQL["nutrition_xml_files"] = ORACLE_SQL["nutrition_flat"]
ORACLE_SQL["nutrition_xml_document"] = ORACLE_SQL["nutrition_flat"]
ORACLE_SQL["upsert_daily_versioned"] = ORACLE_SQL["upsert_daily"]
ORACLE_SQL["strict_insert_indexed"] = ORACLE_SQL["strict_insert"]
ORACLE_SQL["users_two_feeds_indexed"] = ORACLE_SQL["users_two_feeds_path"]
ORACLE_SQL["table_versions"] = """
WITH first AS (SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey < 10),
second AS (
  SELECT * FROM first WHERE c_nationkey < 5
  UNION ALL SELECT c_custkey, lower(c_name), c_nationkey FROM customer WHERE c_nationkey >= 5
), every AS (
  SELECT 1 AS version, * FROM first UNION ALL SELECT 2, * FROM second
  UNION ALL SELECT 3, * FROM second WHERE c_nationkey < 20
)
SELECT version, c_nationkey, count(*) AS n, min(c_name) AS first_name, max(c_name) AS last_name FROM every GROUP BY ALL
"""
ORACLE_SQL["documents_csv"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"
ORACLE_SQL["documents_json"] = ORACLE_SQL["documents_csv"]
ORACLE_SQL["sessions_collection"] = ORACLE_SQL["sessions_dedupe"]
ORACLE_SQL["sessions_dump"] = ORACLE_SQL["sessions_dedupe"]
ORACLE_SQL["documents_dump"] = "SELECT doc_id, text, n_chars FROM documents"
ORACLE_SQL["orders_json_files"] = ORACLE_SQL["order_headers"]
ORACLE_SQL["message_publish"] = """SELECT CAST(c_custkey AS INTEGER) AS loan_id, c_name AS borrower,
  CAST(floor(c_acctbal) AS BIGINT) AS amount, c_mktsegment AS status FROM customer"""
ORACLE_SQL["high_water_mark"] = """
SELECT 0 AS version, CAST(NULL AS DATE) AS mark
UNION ALL SELECT 1, CAST(max(o_orderdate) AS DATE) FROM orders WHERE o_orderdate < '2000-01-01'
UNION ALL SELECT 2, CAST(max(o_orderdate) AS DATE) FROM orders"""
ORACLE_SQL["enforced_lines"] = """
WITH judged AS (
  SELECT l_orderkey, l_linenumber, concat_ws(',',
    CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'flag' END,
    CASE WHEN length('P' || l_partkey) > 4 THEN 'code' END,
    CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
      THEN 'primary_key' END,
    CASE WHEN l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) THEN 'part' END) AS reasons
  FROM lineitem
)
SELECT l_orderkey, l_linenumber, reasons, count(*) AS n,
  (SELECT count(*) FROM judged WHERE reasons = '') AS n_loaded
FROM judged GROUP BY ALL
"""
ORACLE_SQL["user_activity_refreshed"] = ORACLE_SQL["user_activity"]
ORACLE_SQL["support_efficiency_refreshed"] = ORACLE_SQL["support_efficiency"]
