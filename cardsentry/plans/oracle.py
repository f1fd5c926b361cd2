"""DuckDB SQL that computes, from the driver's tables, what each query of the
catalog must return.  Input mappings and message layouts are taken from the
same constants as the Spark side; the computations are written independently
as plain SQL over the base tables."""

from __future__ import annotations

from cardsentry.operators import notify as N
from cardsentry.functions.text import DEFAULT_RISK_COLOR, MISSING, RISK_COLORS
from cardsentry.sources import driver_tables as D

TX_FIELDS = [n for n, _ in D.TRANSACTION_COLUMNS]


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _cols(columns) -> str:
    return ",\n    ".join(f"{D.render(expr, 'duckdb')} AS {name}" for name, expr in columns)


def tx_cte() -> str:
    return f"""tx AS (
  SELECT e.event_id,
    {_cols(D.TRANSACTION_COLUMNS)}
  FROM events e JOIN nation n ON n.n_nationkey = e.event_id % 25),
good AS (
  SELECT * FROM tx WHERE NOT ({D.TRUNCATED_EVENT.replace('e.', '')}) AND customer_id IS NOT NULL)"""


def cu_cte() -> str:
    return f"""cu_raw AS (
  SELECT {_cols(D.CUSTOMER_COLUMNS)}
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
cu AS (
  SELECT * REPLACE (CAST(try_strptime(account_open_date, '%Y-%m-%d') AS DATE) AS account_open_date)
  FROM cu_raw)"""


def wl_cte() -> str:
    extra_name, extra_value, extra_when = D.WATCHLIST_EXTRA_FIELD
    fields = ", ".join(f"CASE WHEN cut THEN NULL ELSE {f} END AS {f}" for f in D.WATCHLIST_FIELDS)
    return f"""wl_src AS (
  SELECT c.c_custkey,
    {_cols(D.WATCHLIST_COLUMNS)},
    {extra_when} AS has_extra,
    {D.WATCHLIST_TRUNCATED} AS cut,
    {D.WATCHLIST_DROP_TEXT['duckdb'].format(t=D.render('{EFF}', 'duckdb'))} AS effective_month
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE {D.WATCHLIST_MEMBER}),
bwl AS (
  SELECT {fields},
    CASE WHEN cut THEN substring('{{"watchlist_id":"' || watchlist_id, 1, {D.WATCHLIST_TRUNCATED_LENGTH})
         WHEN has_extra THEN '{{"{extra_name}":"' || {extra_value} || '"}}' END AS _rescued_data,
    effective_month, c_custkey, cut
  FROM wl_src),
swl AS (
  SELECT upper(watchlist_id) AS watchlist_id, watch_type, upper(entity_id) AS entity_id,
    upper(risk_level) AS risk_level, upper(action) AS action, reason_code, reason_description,
    status, try_strptime(effective_from, '%d-%b-%Y %H:%M:%S') AS effective_from,
    reported_by, reported_source, country, city
  FROM bwl)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def envelope_json() -> str:
    """Spark's ``to_json`` text of the payload: fields in schema order,
    NULL fields left out."""
    frags = []
    for name in TX_FIELDS:
        if name == "amount":
            val = "CAST(amount AS VARCHAR)"
        elif name == "transaction_timestamp":
            val = "'\"' || strftime(transaction_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '\"'"
        elif name == "is_international":
            val = "CASE WHEN is_international THEN 'true' WHEN NOT is_international THEN 'false' END"
        else:
            val = f"'\"' || {name} || '\"'"
        frags.append(f"'\"{name}\":' || {val}")
    return "('{' || concat_ws(',', " + ", ".join(frags) + ") || '}')"


def envelope_select() -> str:
    return f"""SELECT CAST(NULL AS VARCHAR) AS key,
  CASE WHEN event_id % 97 = 0 THEN substring({envelope_json()}, 1, {D.TRUNCATED_LENGTH})
       ELSE {envelope_json()} END AS value,
  '{D.KAFKA_TOPIC}' AS topic, CAST(event_id % {D.KAFKA_PARTITIONS} AS INTEGER) AS partition,
  event_id AS "offset", transaction_timestamp AS timestamp, 0 AS timestampType
FROM tx"""


# --- message rendering ----------------------------------------------------

def _esc(x: str) -> str:
    return f"replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


def _na(x: str, default: str = MISSING) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), {lit(default)})"


def _money(x: str) -> str:
    cents = f"CAST(floor({x} * 100 + 0.5) AS BIGINT)"
    return (f"(CASE WHEN {cents} < 0 THEN '-' ELSE '' END || CAST(abs({cents}) // 100 AS VARCHAR) || '.' "
            f"|| lpad(CAST(abs({cents}) % 100 AS VARCHAR), 2, '0'))")


def _time(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def _card(x: str) -> str:
    return f"('**** ' || right({x}, 4))"


def cell(kind: str, cols) -> str:
    if kind == "money":
        text = _na(_money(cols[0]))
    elif kind == "money_currency":
        text = f"({_na(_money(cols[0]))} || ' ' || coalesce({cols[1]}, ''))"
    elif kind == "time":
        text = _na(_time(cols[0]))
    elif kind == "card":
        text = _na(_card(cols[0]))
    elif kind == "location":
        text = f"({_na(cols[0])} || ', ' || {_na(cols[1])})"
    else:
        text = _na(cols[0])
    return _esc(text)


def html_rows(rows) -> str:
    parts = [lit(N.TABLE_OPEN)]
    for label, kind, cols in rows:
        parts += [lit(N.ROW_OPEN + label + N.ROW_MIDDLE), cell(kind, cols), lit(N.ROW_CLOSE)]
    parts.append(lit(N.TABLE_CLOSE))
    return " || ".join(parts)


def _colored(template: str, color: str) -> str:
    head, tail = template.split("{color}")
    return f"{lit(head)} || {color} || {lit(tail)}"


def risk_color(level: str) -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in RISK_COLORS.items())
    return f"(CASE {level} {whens} ELSE {lit(DEFAULT_RISK_COLOR)} END)"


def high_value_render() -> str:
    color = lit(N.HIGH_VALUE_COLOR)
    body = " || ".join([
        lit(N.PAGE_OPEN), _colored(N.BOX_OPEN, color),
        lit(f"<h2>{N.HIGH_VALUE_TITLE}</h2><p>{N.HIGH_VALUE_INTRO}</p>"),
        html_rows(N.HIGH_VALUE_ROWS),
        lit(N.FOOTER), _esc(_na("alert_id")), lit("</p>"), lit(N.BOX_CLOSE + N.PAGE_CLOSE),
    ])
    subject = f"{lit(N.HIGH_VALUE_SUBJECT)} || {_na(_money('transaction_amount'))}"
    return f"alert_id, alert_type, customer_email AS recipient, {subject} AS subject, {body} AS body_html"


def fraud_subject() -> str:
    return (f"{lit(N.FRAUD_SUBJECT[0])} || {_na('risk_level', 'UNKNOWN')} || "
            f"{lit(N.FRAUD_SUBJECT[1])} || {_na(_card('card_number'))}")


def fraud_render() -> str:
    color = risk_color("risk_level")
    body = " || ".join([
        lit(N.PAGE_OPEN), _colored(N.BOX_OPEN, color),
        _colored('<h2 style="color: {color};">', color), lit(N.FRAUD_TITLE + "</h2>"),
        lit("<h3>Alert Summary</h3>"), html_rows(N.FRAUD_SUMMARY_ROWS),
        lit("<h3>Transaction Details</h3>"), html_rows(N.FRAUD_TRANSACTION_ROWS),
        lit("<h3>Fraud Watchlist Match</h3>"), html_rows(N.FRAUD_WATCHLIST_ROWS),
        lit(N.FOOTER), _esc(_na("alert_type")), lit("</p>"), lit(N.BOX_CLOSE + N.PAGE_CLOSE),
    ])
    return f"alert_id, alert_type, customer_email AS recipient, {fraud_subject()} AS subject, {body} AS body_html"


# --- the queries -------------------------------------------------------------

WL13 = ", ".join(D.WATCHLIST_FIELDS)
PAYLOAD = ", ".join(TX_FIELDS)


def hv_cte(now: str = "NULL") -> str:
    return f"""hv AS (
  SELECT concat_ws('-', 'ALERT', t.transaction_id) AS alert_id, 'HIGH_VALUE_TRANSACTION' AS alert_type,
    t.transaction_id, t.customer_id, t.amount AS transaction_amount, cu.transaction_limit,
    cu.email AS customer_email, concat_ws(' ', cu.first_name, cu.last_name) AS customer_name,
    t.currency, t.merchant_name, t.merchant_category, t.transaction_type, t.payment_channel,
    t.city, t.country, t.is_international, t.transaction_timestamp, t.status, {now} AS alert_ts
  FROM good t LEFT JOIN cu ON t.customer_id = cu.customer_id
  WHERE t.amount > cu.transaction_limit)"""


def fca_cte(now: str = "NULL", bound: str | None = None) -> str:
    cond = ""
    if bound:
        cond = (f" AND t.transaction_timestamp >= w.effective_from"
                f" AND t.transaction_timestamp <= w.effective_from + INTERVAL {bound}")
    return f"""fca AS (
  SELECT concat_ws('-', 'FRAUD', t.transaction_id, w.watchlist_id) AS alert_id,
    'FRAUD_WATCHLIST_MATCH' AS alert_type, {now} AS alert_timestamp,
    t.transaction_id, t.customer_id, cu.email AS customer_email,
    concat_ws(' ', cu.first_name, cu.last_name) AS customer_name, t.card_number, t.amount, t.currency,
    t.merchant_id, t.merchant_name, t.merchant_category, t.transaction_type, t.payment_channel,
    t.device_id, t.city AS transaction_city, t.country AS transaction_country, t.transaction_timestamp,
    t.is_international, t.status AS transaction_status, w.watchlist_id, w.watch_type, w.risk_level,
    w.action, w.reason_code, w.reason_description, w.effective_from AS watchlist_effective_from,
    w.reported_by, w.reported_source, w.city AS watchlist_city, w.country AS watchlist_country
  FROM good t JOIN swl w ON upper(t.card_number) = w.entity_id{cond}
  LEFT JOIN cu ON t.customer_id = cu.customer_id)"""


def tumbling_cte() -> str:
    return """tumbling AS (
  SELECT w AS window_start, w + INTERVAL 1 MINUTE AS window_end, n AS transactions_count
  FROM (SELECT date_trunc('minute', transaction_timestamp) AS w, count(*) AS n FROM good GROUP BY 1)
  WHERE w + INTERVAL 1 MINUTE <= (SELECT max(transaction_timestamp) - INTERVAL 10 MINUTE FROM good))"""


def sliding_cte() -> str:
    return """sliding AS (
  SELECT w AS window_start, w + INTERVAL 5 MINUTE AS window_end, n AS transactions_count
  FROM (SELECT date_trunc('minute', transaction_timestamp) - to_minutes(CAST(k AS INTEGER)) AS w, count(*) AS n
        FROM good, range(5) r(k) GROUP BY 1)
  WHERE w + INTERVAL 5 MINUTE <= (SELECT max(transaction_timestamp) - INTERVAL 10 MINUTE FROM good))"""


# Fixed values of the scenarios, as in the catalog.
TOPIC_START, LATE_PARTITIONS, OUTBOX_DROPS, LATE_SPLIT = 100, 4, 4, "2024-01-15 00:00:00"
HOT_SHARE = 0.0075
FIXED_NOW_SQL = "TIMESTAMP '2024-02-01 00:00:00'"


def ALL() -> str:  # noqa: N802 - the three input views
    return with_ctes(tx_cte(), cu_cte(), wl_cte())


def _dq_counts() -> str:
    return with_ctes(tx_cte(), """flags AS (
  SELECT event_id % 97 = 0 AS cut, customer_id IS NULL AS nocust, amount, transaction_timestamp AS ts
  FROM tx)""") + """
SELECT 'valid_transaction_id' AS expectation, 'drop' AS action,
  count(*) FILTER (WHERE NOT cut) AS passed_records, count(*) FILTER (WHERE cut) AS failed_records FROM flags
UNION ALL SELECT 'valid_customer_id', 'drop', count(*) FILTER (WHERE NOT cut AND NOT nocust),
  count(*) FILTER (WHERE cut OR nocust) FROM flags
UNION ALL SELECT 'valid_card_number', 'drop', count(*) FILTER (WHERE NOT cut),
  count(*) FILTER (WHERE cut) FROM flags
UNION ALL SELECT 'valid_amount', 'warn', count(*) FILTER (WHERE NOT cut AND coalesce(amount > 0, false)),
  count(*) FILTER (WHERE cut OR NOT coalesce(amount > 0, false)) FROM flags
UNION ALL SELECT 'valid_event_time', 'warn', count(*) FILTER (WHERE NOT cut AND ts IS NOT NULL),
  count(*) FILTER (WHERE cut OR ts IS NULL) FROM flags"""


def _matches(bound=None, extra="") -> str:
    cond = ""
    if bound:
        cond = (f" AND t.transaction_timestamp >= w.effective_from"
                f" AND t.transaction_timestamp <= w.effective_from + INTERVAL {bound}")
    return ALL() + f"""SELECT t.transaction_id, w.watchlist_id, t.card_number, t.amount, t.transaction_timestamp,
  w.effective_from, w.risk_level{extra}
FROM good t JOIN swl w ON upper(t.card_number) = w.entity_id{cond}"""


# Values of the roundtrip's tables that are compared: plain columns, and times as text.
ROUNDTRIP_TEXT = {
    "bronze_transactions": ["value", "topic", "partition", '"offset"', "@timestamp"],
    "silver_transactions": ["transaction_id", "customer_id", "card_number", "merchant_name", "country",
                            "@transaction_timestamp", "event_id"],
    "silver_customers": ["customer_id", "last_name", "country", "account_open_date", "email"],
    "bronze_watchlist": ["watchlist_id", "entity_id", "risk_level", "effective_from", "_rescued_data"],
    "silver_watchlist": ["watchlist_id", "entity_id", "risk_level", "action", "@effective_from", "city"],
    "high_value_transaction_alert": ["alert_id", "customer_id", "customer_email", "customer_name", "@transaction_timestamp"],
    "fraud_card_alert": ["alert_id", "customer_id", "customer_email", "risk_level", "@watchlist_effective_from"],
    "transactions_count_by_min": ["@window_start", "@window_end", "transactions_count"],
    "transactions_count_by_min_sliding_window": ["@window_start", "@window_end", "transactions_count"],
}


def _text(column: str) -> str:
    text = f"strftime({column[1:]}, '%Y-%m-%d %H:%M:%S')" if column[0] == "@" else f"CAST({column} AS VARCHAR)"
    return f"coalesce({text}, '~')"


def _versions() -> str:
    """Alerts against two versions of every customer (the older with half the limit)."""
    rows = """SELECT 'all' AS rule, cu.* FROM cu
  UNION ALL SELECT 'all', cu.* REPLACE (cu.transaction_limit / 2 AS transaction_limit) FROM cu
  UNION ALL SELECT 'latest', cu.* FROM cu"""
    return with_ctes(tx_cte(), cu_cte()) + f"""SELECT v.rule, l.layout, concat_ws('-', 'ALERT', t.transaction_id) AS alert_id,
  v.transaction_limit
FROM good t JOIN ({rows}) v ON t.customer_id = v.customer_id
  CROSS JOIN (SELECT unnest(['broadcast', 'shuffled']) AS layout) l
WHERE t.amount > v.transaction_limit"""


def _typed_rescue() -> str:
    """reason_code is text that does not read as a number: rescued, with any extra field."""
    return ALL() + """SELECT watchlist_id, entity_id, CAST(NULL AS BIGINT) AS reason_code,
  CASE WHEN cut THEN _rescued_data ELSE '{"reason_code":"' || reason_code || '"' ||
    CASE WHEN _rescued_data IS NULL THEN '' ELSE ',' || substr(_rescued_data, 2, length(_rescued_data) - 2) END || '}'
  END AS _rescued_data
FROM bwl"""


def _inferred() -> str:
    """The extra field is a column of the inferred schema; cut lines are rescued whole."""
    return ALL() + f"""SELECT {WL13}, CASE WHEN NOT cut THEN json_extract_string(_rescued_data, '$.note') END AS note,
  CASE WHEN cut THEN _rescued_data END AS _rescued_data
FROM bwl"""


def _roundtrip() -> str:
    parts = [("bronze_transactions", "btx"), ("silver_transactions", "good"), ("silver_customers", "cu"),
             ("bronze_watchlist", "bwl"), ("silver_watchlist", "swl"),
             ("high_value_transaction_alert", "hv"), ("fraud_card_alert", "fca"),
             ("transactions_count_by_min", "tumbling"),
             ("transactions_count_by_min_sliding_window", "sliding")]
    body = "\nUNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS records, "
        f"CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {', '.join(_text(c) for c in ROUNDTRIP_TEXT[n])})), 1, 8) AS BIGINT)) "
        f"AS BIGINT) AS checksum FROM {t}" for n, t in parts)
    return with_ctes(f"btx AS ({with_ctes(tx_cte())}{envelope_select()})", tx_cte(), cu_cte(), wl_cte(), hv_cte(), fca_cte(), tumbling_cte(), sliding_cte()) + body


def _late_rows(split: str = "2024-01-15 00:00:00") -> str:
    return with_ctes(tx_cte(), f"""d1 AS (SELECT * FROM tx WHERE event_id % 97 <> 0 AND customer_id IS NOT NULL
    AND transaction_timestamp >= TIMESTAMP '{split}'),
w AS (SELECT date_trunc('minute', transaction_timestamp) AS ws, count(*) AS n FROM d1 GROUP BY 1)""") + """
SELECT count(*) AS windows_emitted, CAST(sum(n) AS BIGINT) AS transactions_counted,
  (SELECT count(*) FROM events) AS input_rows, true AS late_rows_dropped
FROM w WHERE ws + INTERVAL 1 MINUTE <= (SELECT max(transaction_timestamp) - INTERVAL 10 MINUTE FROM d1)"""


def _hwm(before: str = "2024-02") -> str:
    return ALL() + f""", num AS (
  SELECT *, CASE WHEN watchlist_id LIKE 'WL%' THEN try_cast(substring(watchlist_id, 3) AS BIGINT) END AS n
  FROM bwl)
SELECT {WL13} FROM num
WHERE n > (SELECT coalesce(max(n), 0) FROM num WHERE effective_month < '{before}')"""


def _status() -> str:
    return "CASE WHEN coalesce(customer_email, '') <> '' THEN 'ready' ELSE 'no_recipient' END"


def oracles() -> dict[str, str]:
    envelope = with_ctes(tx_cte()) + envelope_select()
    silver = with_ctes(tx_cte()) + f"""SELECT {PAYLOAD}, 'transactions' AS kafka_topic,
  CAST(event_id % 4 AS INTEGER) AS kafka_partition, event_id AS kafka_offset,
  transaction_timestamp AS kafka_timestamp FROM good"""
    fraud = with_ctes(tx_cte(), cu_cte(), wl_cte(), fca_cte())
    fraud_now = with_ctes(tx_cte(), cu_cte(), wl_cte(), fca_cte(FIXED_NOW_SQL))
    return {
        "kafka_envelope_batch": envelope,
        "message_count": "SELECT count(*) AS messages FROM events e JOIN nation n ON n.n_nationkey = e.event_id % 25",
        "bronze_transactions": envelope,
        "batch_overwrite": envelope,
        "table_scan": with_ctes(cu_cte()) + "SELECT * FROM cu",
        "bronze_watchlist": ALL() + f"SELECT {WL13}, _rescued_data FROM bwl",
        "rescued_data": ALL() + "SELECT watchlist_id, _rescued_data FROM bwl WHERE _rescued_data IS NOT NULL",
        "file_lineage": ALL() + "SELECT effective_month, count(*) AS records "
                                "FROM bwl GROUP BY 1",
        "high_water_mark_slice": _hwm(),
        "high_water_mark_empty": ALL() + f"SELECT {WL13}, _rescued_data FROM bwl",
        "inferred_schema_stream": _inferred(),
        "rescued_data_typed": _typed_rescue(),
        "stream_table_roundtrip": _roundtrip(),
        "silver_transactions": silver,
        "dq_drop": with_ctes(tx_cte()) + "SELECT event_id AS kafka_offset, transaction_id, customer_id, "
                                         "card_number, amount FROM good",
        "dq_warn_counts": _dq_counts(),
        "dq_report": _dq_counts(),
        "dq_report_many_batches": _dq_counts(),
        "customer_versions": _versions(),
        "silver_customers": with_ctes(cu_cte()) + "SELECT * FROM cu",
        "silver_watchlist": ALL() + "SELECT * FROM swl",
        "high_value_alert": with_ctes(tx_cte(), cu_cte(), hv_cte()) + "SELECT * EXCLUDE (alert_ts) FROM hv",
        "high_value_alert_skew_split": with_ctes(tx_cte(), cu_cte(), hv_cte())
            + "SELECT * EXCLUDE (alert_ts) FROM hv",
        "heavy_customers": with_ctes(tx_cte()) + f"""SELECT customer_id, count(*) AS transactions FROM good GROUP BY customer_id
HAVING count(*) >= {HOT_SHARE} * (SELECT count(*) FROM good)""",
        "watchlist_match": _matches(),
        "watchlist_match_bounded": _matches("7 DAY"),
        "watchlist_match_ttl": _matches("7 DAY"),
        "watchlist_match_salted": _matches(),
        "watchlist_match_incremental": _matches(),
        "watchlist_match_compacted": _matches(),
        "kafka_offsets_resume": with_ctes(tx_cte()) + f"""SELECT partition, "offset", CAST(1 AS BIGINT) AS copies, value,
  timestamp FROM ({envelope_select()}) WHERE NOT (partition = 0 AND "offset" < {TOPIC_START})""",
        "schema_evolution_stream": with_ctes(wl_cte()) + f"""SELECT {", ".join(D.WATCHLIST_FIELDS)},
  CASE WHEN has_extra AND NOT cut THEN {D.WATCHLIST_EXTRA_FIELD[1]} END AS {D.WATCHLIST_EXTRA_FIELD[0]},
  CASE WHEN cut THEN _rescued_data END AS _rescued_data
FROM bwl JOIN (SELECT c_custkey AS k, has_extra FROM wl_src) ON k = c_custkey""",
        "late_rows_kept": with_ctes(tx_cte()) + f""", w AS (
  SELECT date_trunc('millisecond', max(transaction_timestamp)) - INTERVAL 10 MINUTE AS late_watermark FROM good
  WHERE transaction_timestamp >= TIMESTAMP '{LATE_SPLIT}')
SELECT transaction_id, CAST(event_id % {D.KAFKA_PARTITIONS} + {LATE_PARTITIONS} AS INTEGER) AS kafka_partition,
  event_id AS kafka_offset, transaction_timestamp, late_watermark
FROM good, w WHERE transaction_timestamp < TIMESTAMP '{LATE_SPLIT}'
  AND date_trunc('minute', transaction_timestamp) + INTERVAL 1 MINUTE <= late_watermark""",
        "join_state_rows": ALL() + """SELECT 'left' AS side, upper(card_number) AS card_number, count(*) AS state_rows
FROM good WHERE card_number IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'right', entity_id, count(*) FROM swl WHERE entity_id IS NOT NULL GROUP BY ALL""",
        "watchlist_match_filtered": f"SELECT w.way, m.* EXCLUDE (status) FROM ({_matches(extra=', w.status')}) m "
            "CROSS JOIN (SELECT unnest(['state', 'tables']) AS way) w WHERE m.status = 'ACTIVE'",
        "fraud_card_alert": fraud + "SELECT * EXCLUDE (alert_timestamp) FROM fca",
        "fraud_card_alert_state": fraud + "SELECT * EXCLUDE (alert_timestamp) FROM fca",
        "tumbling_counts": with_ctes(tx_cte(), tumbling_cte()) + "SELECT * FROM tumbling",
        "sliding_counts": with_ctes(tx_cte(), sliding_cte()) + "SELECT * FROM sliding",
        "late_rows_dropped": _late_rows(),
        "render_high_value_notification": with_ctes(tx_cte(), cu_cte(), hv_cte(FIXED_NOW_SQL))
            + f"SELECT {high_value_render()} FROM hv",
        "render_fraud_notification": fraud_now + f"SELECT {fraud_render()} FROM fca",
        "notification_undeliverable": fraud_now + "SELECT alert_id, alert_type, 'no_recipient' AS status "
                                                  "FROM fca WHERE coalesce(customer_email, '') = ''",
        "notification_outbox": fraud_now + f"SELECT alert_id, alert_type, customer_email AS recipient, "
                                           f"{_status()} AS status, {fraud_subject()} AS subject FROM fca",
        "notification_outbox_repeated": fraud_now + f"""SELECT alert_id, customer_email AS recipient, {_status()} AS status,
  CAST('0x' || substr(md5(alert_id), 1, 4) AS BIGINT) % {OUTBOX_DROPS} AS drop FROM fca""",
        "notification_outbox_high_value": with_ctes(tx_cte(), cu_cte(), hv_cte(FIXED_NOW_SQL))
            + f"SELECT alert_id, alert_type, recipient, CASE WHEN coalesce(recipient, '') <> '' THEN 'ready' "
              f"ELSE 'no_recipient' END AS status, subject FROM (SELECT {high_value_render()} FROM hv)",
        "notification_table_flow": fraud_now
            + f"SELECT r.alert_id, r.alert_type, r.recipient, CASE WHEN coalesce(r.recipient, '') <> '' THEN 'ready' "
              f"ELSE 'no_recipient' END AS status, r.subject, r.body_html FROM (SELECT {fraud_render()} FROM fca) r",
        "notification_batch_summary": fraud_now + """SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS alerts,
  count(*) FILTER (WHERE coalesce(customer_email, '') <> '') AS ready,
  count(*) FILTER (WHERE coalesce(customer_email, '') = '') AS no_recipient FROM fca""",
    }
