"""DuckDB SQL for the registered queries, written independently of the operators.

Each text starts from the same derived records as the Spark side and then
takes the plain route: windows, joins and correlated checks.
"""

from __future__ import annotations

from ledgerline.contract import CATEGORIES, CURRENCIES, STATUSES, TRANSACTION_TYPES
from ledgerline.plans.fixture import DEFECT, DELIVERY, PAYLOAD, SECOND_COPY, TXN_COLUMNS


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


_TXN_SELECT = ",\n  ".join(f"{sql} AS {name}" for name, sql in TXN_COLUMNS.items())

_TXN = f"""
e AS (
  SELECT event_id, {DEFECT} AS d, '' AS pfx, ts, user_id, event_type, value FROM events
  UNION ALL
  SELECT event_id, {DEFECT} AS d, 'D' AS pfx, ts, user_id, event_type, value FROM events
  WHERE {SECOND_COPY}
),
txn AS (SELECT event_id, {_TXN_SELECT} FROM e)"""

_FIELDS = tuple(TXN_COLUMNS)
# The countries the derived records use that are assigned.
_COUNTRIES = ("US", "GB", "DE", "JP", "AU", "FR", "NL", "ES", "CA")


def _got(column: str) -> str:
    return f"(got ''' || {column} || ''')'"


_CASES = {
    "v_txn_id": (
        "transaction_id",
        "NOT regexp_full_match(transaction_id, 'TXN-[A-Za-z0-9]+')",
        "'transaction_id: invalid_format (expected TXN-NNNN, got ''' || transaction_id || ''')'",
    ),
    "v_account_id": (
        "account_id",
        "NOT regexp_full_match(account_id, 'ACC-[0-9]{4}')",
        "'account_id: invalid_format (expected ACC-NNNN, got ''' || account_id || ''')'",
    ),
    "v_ts_format": (
        "transaction_date",
        "NOT regexp_full_match(transaction_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z')",
        "'transaction_date: invalid_iso8601_utc_format " + _got("transaction_date"),
    ),
    "v_ts_calendar": (
        "transaction_date",
        "transaction_date LIKE '____-__-__T__:__:__Z'"
        " AND try_strptime(transaction_date, '%Y-%m-%dT%H:%M:%SZ') IS NULL",
        "'transaction_date: not_a_real_calendar_date " + _got("transaction_date"),
    ),
    "v_ts_window": (
        "transaction_date",
        "try_strptime(transaction_date, '%Y-%m-%dT%H:%M:%SZ')"
        " NOT BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-03-31 23:59:59'",
        "'transaction_date: outside_expected_window_2024Q1 " + _got("transaction_date"),
    ),
    "v_amount_numeric": (
        "amount",
        "amount IS NOT NULL AND try_cast(amount AS DECIMAL(38,10)) IS NULL",
        "'amount: not_numeric " + _got("amount"),
    ),
    "v_amount_positive": (
        "amount",
        "try_cast(amount AS DECIMAL(38,10)) <= 0",
        "'amount: not_strictly_positive " + _got("amount"),
    ),
    "v_amount_scale": (
        "amount",
        "try_cast(amount AS DECIMAL(38,10)) > 0 AND length(split_part(amount, '.', 2)) > 2",
        "'amount: more_than_two_decimal_places " + _got("amount"),
    ),
    "v_currency": (
        "currency",
        f"currency NOT IN ({_listed(CURRENCIES)})",
        "'currency: invalid_currency_code " + _got("currency"),
    ),
    "v_type": (
        "transaction_type",
        f"transaction_type NOT IN ({_listed(TRANSACTION_TYPES)})",
        "'transaction_type: invalid_transaction_type " + _got("transaction_type"),
    ),
    "v_category": (
        "merchant_category",
        f"merchant_category NOT IN ({_listed(CATEGORIES)})",
        "'merchant_category: invalid_merchant_category " + _got("merchant_category"),
    ),
    "v_status": (
        "status",
        f"status NOT IN ({_listed(STATUSES)})",
        "'status: invalid_status " + _got("status"),
    ),
    "v_merchant": (
        "merchant_name",
        "trim(merchant_name) = ''",
        "'merchant_name: empty_or_whitespace_only " + _got("merchant_name"),
    ),
    "v_country_format": (
        "country_code",
        "length(country_code) <> 2 OR upper(country_code) <> country_code"
        " OR lower(country_code) = country_code",
        "'country_code: invalid_format " + _got("country_code"),
    ),
    "v_country_assigned": (
        "country_code",
        "length(country_code) = 2 AND upper(country_code) = country_code"
        " AND lower(country_code) <> country_code"
        f" AND country_code NOT IN ({_listed(_COUNTRIES)})",
        "'country_code: not_an_assigned_iso3166_code " + _got("country_code"),
    ),
}

_MISSING = [
    f"CASE WHEN {f} IS NULL THEN '{f}: missing_required_field' END" for f in _FIELDS
]
_FOUND = [f"CASE WHEN {test} THEN {text} END" for _, test, text in _CASES.values()]

_CHECKED = f"""
checked AS (
  SELECT *, list_filter([{", ".join(_MISSING + _FOUND)}], lambda x: x IS NOT NULL) AS found,
    '{{' || substr(concat({", ".join(
        f"CASE WHEN {f} IS NULL THEN '' ELSE ',\"{f}\":\"' || {f} || '\"' END"
        for f in sorted(_FIELDS))}), 2) || '}}' AS payload
  FROM txn)"""

_KEY = "concat(" + ", '|', ".join(
    f"'{f}=' || coalesce("
    + (
        "CAST(try_cast(amount AS DECIMAL(18,2)) AS VARCHAR), amount"
        if f == "amount"
        else f
    )
    + ", 'None')"
    for f in _FIELDS
    if f != "transaction_id"
) + ")"
# Scale 3 rounds half even to 2.
_KEY = _KEY.replace(
    "try_cast(amount AS DECIMAL(18,2))",
    "CAST(round_even(try_cast(amount AS DECIMAL(18,3)), 2) AS DECIMAL(18,2))",
)

_BRONZE = f"""
bronze AS (
  SELECT transaction_id, account_id,
    strptime(transaction_date, '%Y-%m-%dT%H:%M:%SZ') AS transaction_date,
    transaction_date AS transaction_date_raw, CAST(amount AS DECIMAL(18,2)) AS amount, currency,
    transaction_type, merchant_name, merchant_category, status, country_code,
    sha256({_KEY}) AS natural_key_hash, payload
  FROM checked WHERE len(found) = 0)"""

_FLAGGED = """
flagged AS (
  SELECT * EXCLUDE (rn, first_id), rn > 1 AS is_duplicate,
    CASE WHEN rn > 1 THEN first_id END AS duplicate_of_transaction_id
  FROM (
    SELECT *, row_number() OVER w AS rn, first_value(transaction_id) OVER w AS first_id
    FROM bronze
    WINDOW w AS (PARTITION BY natural_key_hash ORDER BY transaction_date, transaction_id)))"""

_STG = """
stg AS (
  SELECT transaction_id, account_id, transaction_date AS transaction_timestamp,
    CAST(transaction_date AS DATE) AS transaction_date, amount, currency, transaction_type,
    merchant_name, merchant_category, status, country_code, natural_key_hash,
    'run-1' AS ingestion_run_id, TIMESTAMP '2024-04-01' AS ingestion_timestamp
  FROM flagged WHERE NOT is_duplicate),
done AS (SELECT * FROM stg WHERE status = 'completed')"""

_MART = """
spend AS (
  SELECT account_id, transaction_date, merchant_category,
    CAST(sum(amount) AS DECIMAL(18,2)) AS category_amount
  FROM done GROUP BY ALL),
top AS (
  SELECT account_id, transaction_date,
    arg_min(merchant_category, {'less': -category_amount, 'name': merchant_category}) AS top_category
  FROM spend GROUP BY ALL),
totals AS (
  SELECT account_id, transaction_date,
    CAST(coalesce(sum(amount) FILTER (transaction_type = 'debit'), 0) AS DECIMAL(18,2)) AS total_debit_amount,
    CAST(coalesce(sum(amount) FILTER (transaction_type = 'credit'), 0) AS DECIMAL(18,2)) AS total_credit_amount,
    count(*) AS transaction_count, count(DISTINCT merchant_name) AS distinct_merchants,
    string_agg(DISTINCT currency, ',' ORDER BY currency) AS currencies
  FROM done GROUP BY ALL),
mart AS (
  SELECT account_id, transaction_date, total_debit_amount, total_credit_amount,
    CAST(total_credit_amount - total_debit_amount AS DECIMAL(18,2)) AS net_amount,
    transaction_count, distinct_merchants, top_category, currencies
  FROM totals LEFT JOIN top USING (account_id, transaction_date))"""

_MARK = """
mark AS (
  SELECT max(transaction_date) AS mark FROM bronze WHERE transaction_date_raw < '2024-01-21')"""

_START = "(SELECT strftime(mark - INTERVAL 2 DAY, '%Y-%m-%dT%H:%M:%SZ') FROM mark)"

_QUARANTINE = """
quarantine AS (
  SELECT sha256(payload) AS quarantine_key, transaction_id,
    array_to_string(found, '; ') AS error_reason, CAST(len(found) AS INTEGER) AS error_count,
    payload AS raw_payload, transaction_date AS raw_date
  FROM checked WHERE len(found) > 0)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_USUAL_DAYS = (
    """found AS (
        SELECT CAST(try_strptime(transaction_date, '%Y-%m-%dT%H:%M:%SZ') AS DATE) AS day FROM txn)""",
    """middle AS (
        SELECT quantile_disc(day, 0.25) AS q1, quantile_disc(day, 0.75) AS q3,
          CAST(ceil(greatest(q3 - q1, 1) * 1.5) AS INTEGER) AS reach
        FROM found WHERE day IS NOT NULL)""",
    "usual AS (SELECT q1 - reach AS first_day, q3 + reach AS last_day FROM middle)",
)
_TO_BRONZE = (_TXN, _CHECKED, _BRONZE)
_TO_FLAGGED = (*_TO_BRONZE, _FLAGGED)
_TO_STG = (*_TO_FLAGGED, _STG)
_TO_MART = (*_TO_STG, _MART)

_BUSINESS = """transaction_id, account_id, transaction_date, transaction_date_raw, amount,
  currency, transaction_type, merchant_name, merchant_category, status, country_code,
  natural_key_hash, is_duplicate, duplicate_of_transaction_id"""
_STAMPED = """'landing.transactions' AS source_system, payload AS source_payload,
  'run-1' AS ingestion_run_id, TIMESTAMP '2024-04-01' AS ingestion_timestamp"""
_TXN_ROW = ", ".join(_FIELDS)
_RAW_PAYLOAD = f"""
raw AS (
  SELECT {PAYLOAD} AS payload, {DELIVERY} AS delivery
  FROM (SELECT *, event_id % 89 AS k FROM txn)),
objects AS (
  SELECT payload, delivery, CASE WHEN json_valid(payload) THEN
      CASE WHEN json_type(payload) = 'OBJECT' THEN payload END END AS p FROM raw)"""


def _json_text(f: str) -> str:
    return f"json_extract_string(p, '$.{f}')"


def _json_shown(f: str) -> str:
    text = _json_text(f)
    return (
        f"CASE json_type(p, '$.{f}') WHEN 'BOOLEAN' THEN 'True' "
        f"WHEN 'VARCHAR' THEN CASE WHEN contains({text}, '''') THEN '\"' || {text} || '\"' "
        f"ELSE '''' || {text} || '''' END "
        # One nested value is in the records; it is written out.
        "WHEN 'OBJECT' THEN '{''z'': [''x'', 1, None, 2.5], ''a'': {''b'': True}}' "
        f"ELSE {text} END"
    )


def _json_printed(field: str, text: str) -> str:
    head = text[: text.index("got '''") + 4] + "'"
    return f"{head} || {_json_shown(field)} || ')'"


def _json_found() -> str:
    """The checks again, on values taken from JSON, printed by their JSON type."""
    parts = []
    for field, test, text in _CASES.values():
        if field == "merchant_name":
            test = (
                "merchant_name IS NOT NULL AND (trim(merchant_name) = ''"
                " OR json_type(p, '$.merchant_name') <> 'VARCHAR')"
            )
        parts.append(f"CASE WHEN {test} THEN {_json_printed(field, text)} END")
    return ", ".join(parts)


_KNOWN = _listed((*_FIELDS, "id", "created_at", "inserted_at", "updated_at"))
_CHECKED_JSON = f"""
fields AS (
  SELECT *, {", ".join(f"{_json_text(f)} AS {f}" for f in _FIELDS)},
    list_sort(list_filter(json_keys(p), lambda x: x NOT IN ({_KNOWN}))) AS extra
  FROM objects),
checked_json AS (
  SELECT *, CASE WHEN p IS NULL THEN ['payload: not_an_object'] ELSE
    list_filter([{", ".join(_MISSING)}], lambda x: x IS NOT NULL)
    || list_transform(extra, lambda x: x || ': unexpected_field')
    || list_filter([{_json_found()}], lambda x: x IS NOT NULL) END AS found,
    CASE WHEN json_valid(payload) THEN
      CASE WHEN p IS NULL THEN replace(payload, ' ', '') ELSE
        '{{' || array_to_string(list_transform(list_sort(json_keys(p)),
          lambda x: '"' || x || '":' || CASE json_type(p, '$.' || x)
            WHEN 'DOUBLE' THEN CAST(CAST(json_extract(p, '$.' || x) AS DOUBLE) AS VARCHAR)
            WHEN 'OBJECT' THEN '{{"a":{{"b":true}},"z":["x",1,null,2.5]}}'
            ELSE CAST(json_extract(p, '$.' || x) AS VARCHAR) END), ',') || '}}' END
      ELSE payload END AS canonical
  FROM fields)"""

_TO_JSON = (_TXN, _RAW_PAYLOAD, _CHECKED_JSON)

_DAILY = """
per_day AS (
  SELECT try_cast(substr(transaction_date, 1, 10) AS DATE) AS day, count(*) AS fetched,
    count(*) FILTER (len(found) = 0) AS valid, count(*) FILTER (len(found) > 0) AS bad,
    max(try_strptime(transaction_date, '%Y-%m-%dT%H:%M:%SZ')) FILTER (len(found) = 0) AS mark
  FROM checked GROUP BY 1 HAVING day IS NOT NULL),
dups AS (
  SELECT CAST(transaction_date AS DATE) AS day, count(*) FILTER (is_duplicate) AS dup
  FROM flagged GROUP BY 1),
runs AS (
  SELECT strftime(day, '%Y%m%d') AS run_id, CAST(day AS TIMESTAMP) AS started_at, fetched, valid,
    bad, coalesce(dup, 0) AS dup, mark, day FROM per_day LEFT JOIN dups USING (day))"""
_TO_RUNS = (*_TO_FLAGGED, _DAILY)
_WEEK = """WINDOW w AS (ORDER BY started_at
  RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 SECOND PRECEDING)"""


def _rate_query(rate: str, alert: str) -> str:
    return (
        _with(*_TO_RUNS)
        + f"""SELECT run_id, round(rate, 9) AS rate, round(baseline, 9) AS baseline,
        coalesce({alert}, false) AS alert
      FROM (SELECT run_id, rate, avg(rate) OVER w AS baseline
            FROM (SELECT run_id, started_at, {rate} AS rate FROM runs) {_WEEK})"""
    )


_CHECKSUM_TEXT = "concat_ws('|', " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '')"
    for c in (
        "account_id",
        "transaction_date",
        "total_debit_amount",
        "total_credit_amount",
        "net_amount",
        "transaction_count",
        "distinct_merchants",
        "top_category",
        "currencies",
    )
) + ")"


def _suite() -> str:
    tests = {
        "stg_transactions.transaction_id.not_null": "SELECT 1 FROM stg WHERE transaction_id IS NULL",
        "stg_transactions.transaction_id.unique": "SELECT 1 FROM stg WHERE transaction_id IS NOT NULL GROUP BY transaction_id HAVING count(*) > 1",
        "stg_transactions.account_id.not_null": "SELECT 1 FROM stg WHERE account_id IS NULL",
        "stg_transactions.status.accepted_values": f"SELECT 1 FROM stg WHERE status NOT IN ({_listed(STATUSES)})",
        "stg_transactions.transaction_type.accepted_values": f"SELECT 1 FROM stg WHERE transaction_type NOT IN ({_listed(TRANSACTION_TYPES)})",
        "stg_transactions.amount.positive_value": "SELECT 1 FROM stg WHERE amount <= 0",
        "daily_account_summary.unique_combination(account_id, transaction_date)": "SELECT 1 FROM mart GROUP BY account_id, transaction_date HAVING count(*) > 1",
        "daily_account_summary.top_category.accepted_values": f"SELECT 1 FROM mart WHERE top_category NOT IN ({_listed(CATEGORIES)})",
        "daily_account_summary.updated_at.not_null": "SELECT 1 FROM mart WHERE false",
        "data_test.net_amount_is_consistent": "SELECT 1 FROM mart WHERE abs(net_amount - (total_credit_amount - total_debit_amount)) > 0.005",
        "data_test.summary_totals_match_source": "SELECT 1 WHERE (SELECT count(*) FROM done) <> (SELECT sum(transaction_count) FROM mart)",
    }
    for column in (
        "account_id",
        "transaction_date",
        "total_debit_amount",
        "total_credit_amount",
        "net_amount",
        "transaction_count",
        "distinct_merchants",
        "currencies",
    ):
        tests[f"daily_account_summary.{column}.not_null"] = (
            f"SELECT 1 FROM mart WHERE {column} IS NULL"
        )
    for column in ("total_debit_amount", "total_credit_amount"):
        tests[f"daily_account_summary.{column}.non_negative"] = (
            f"SELECT 1 FROM mart WHERE {column} < 0"
        )
    for column in ("transaction_count", "distinct_merchants"):
        tests[f"daily_account_summary.{column}.positive_value"] = (
            f"SELECT 1 FROM mart WHERE {column} <= 0"
        )
    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS test, (SELECT count(*) FROM ({sql})) AS failures"
        for name, sql in tests.items()
    )
    return _with(*_TO_MART) + f"SELECT test, failures = 0 AS passed, failures FROM ({counts})"


_MERGED = f"""
merged AS (
  SELECT *, CASE WHEN transaction_date_raw >= {_START} THEN 'load-2' ELSE 'load-1' END AS load
  FROM flagged)"""
_TO_LOADS = (*_TO_FLAGGED, _MARK, _MERGED)

_ALL_ROWS = _with(*_TO_FLAGGED) + f"SELECT {_BUSINESS} FROM flagged"
_ALL_SUMMARY = _with(*_TO_MART) + "SELECT * FROM mart"

_LOADS = f"""
load_counts AS (
  SELECT 'load-1' AS run_id, NULL AS start, count(*) AS fetched,
    count(*) FILTER (len(found) = 0) AS valid, count(*) FILTER (len(found) > 0) AS bad,
    0 AS late
  FROM checked WHERE transaction_date < '2024-01-21'
  UNION ALL
  SELECT 'load-2', any_value({_START}), count(*), count(*) FILTER (len(found) = 0),
    count(*) FILTER (len(found) > 0),
    (SELECT count(*) FROM checked WHERE transaction_date < {_START})
  FROM checked WHERE transaction_date >= {_START}),
dup_counts AS (
  SELECT 'load-1' AS run_id, count(*) FILTER (is_duplicate) AS dup,
    count(*) FILTER (is_duplicate) AS batch_dup, count(*) AS fresh
  FROM flagged WHERE transaction_date_raw < '2024-01-21'
  UNION ALL
  SELECT 'load-2', count(*) FILTER (is_duplicate),
    count(*) FILTER (is_duplicate AND transaction_date_raw >= {_START}),
    count(*) FILTER (transaction_date_raw >= '2024-01-21')
  FROM flagged),
loads AS (
  SELECT run_id, 'incremental' AS run_mode, 'landing.transactions' AS source_name,
    CAST(start AS VARCHAR) AS start, fetched, valid, bad, late, dup, batch_dup, fresh,
    CASE WHEN run_id = 'load-2' THEN (SELECT mark FROM mark) END AS previous,
    CASE WHEN run_id = 'load-1' THEN (SELECT mark FROM mark)
         ELSE (SELECT max(transaction_date) FROM bronze) END AS newest,
    CASE WHEN run_id = 'load-1' THEN TIMESTAMP '2024-04-01 01:00:00'
         ELSE TIMESTAMP '2024-04-01 02:00:00' END AS stamp
  FROM load_counts JOIN dup_counts USING (run_id))"""
_TO_REPORT = (*_TO_FLAGGED, _MARK, _LOADS)
_ISO = "'%Y-%m-%dT%H:%M:%S'"

_MONDAYS = """
rates AS (
  SELECT currency, transaction_date, CAST(count(*) AS DECIMAL(10,4)) AS rate
  FROM done WHERE isodow(transaction_date) = 1 GROUP BY ALL),
carried AS (
  SELECT done.*, rates.rate FROM done ASOF LEFT JOIN rates
    ON done.currency = rates.currency AND done.transaction_date >= rates.transaction_date)"""

ORACLES: dict[str, str] = {
    "landing_scan": _with(_TXN) + f"SELECT {_TXN_ROW} FROM txn",
    "incremental_scan": _with(*_TO_BRONZE, _MARK)
    + f"SELECT {_TXN_ROW} FROM txn WHERE transaction_date >= {_START}",
    "stable_page": _with(_TXN)
    + f"SELECT {_TXN_ROW} FROM txn ORDER BY transaction_date, transaction_id LIMIT 200 OFFSET 400",
    "keyset_next_page": _with(_TXN)
    + f"""SELECT {_TXN_ROW} FROM txn WHERE transaction_date >= '2024-01-15T12:00:00Z'
      ORDER BY transaction_date, transaction_id LIMIT 200""",
    **{
        name: _with(_TXN)
        + f"SELECT transaction_id, {field} AS value, {text} AS violation FROM txn WHERE {test}"
        for name, (field, test, text) in _CASES.items()
    },
    # Two defects only the JSON records have.
    **{
        name: _with(*_TO_JSON)
        + f"SELECT transaction_id, {field} AS value, {_json_printed(field, text)} AS violation"
        f" FROM checked_json WHERE {test}"
        for name, (field, test, text) in _CASES.items()
        if name in ("v_account_id", "v_country_format")
    },
    "v_missing": _with(_TXN)
    + " UNION ALL ".join(
        f"SELECT transaction_id, '{f}' AS field FROM txn WHERE {f} IS NULL" for f in _FIELDS
    ),
    "v_unexpected": _with(*_TO_JSON)
    + """SELECT transaction_id,
        array_to_string(list_transform(extra, lambda x: x || ': unexpected_field'), '; ') AS violation
      FROM checked_json WHERE len(extra) > 0""",
    "validate_all": _with(_TXN, _CHECKED)
    + f"""SELECT {_TXN_ROW}, coalesce(array_to_string(found, '; '), '') AS error_reason,
        CAST(len(found) AS INTEGER) AS error_count FROM checked""",
    "validate_payloads": _with(*_TO_JSON)
    + """SELECT transaction_id, coalesce(array_to_string(found, '; '), '') AS error_reason,
        CAST(len(found) AS INTEGER) AS error_count FROM checked_json""",
    "route_valid": _with(*_TO_BRONZE)
    + f"""SELECT * EXCLUDE (payload), false AS is_duplicate,
        CAST(NULL AS VARCHAR) AS duplicate_of_transaction_id, {_STAMPED} FROM bronze""",
    "route_quarantine": _with(_TXN, _CHECKED, _QUARANTINE)
    + """SELECT * EXCLUDE (raw_date), 'landing.transactions' AS source_system,
        'run-1' AS ingestion_run_id, TIMESTAMP '2024-04-01' AS ingestion_timestamp
      FROM quarantine""",
    "quarantine_reasons": _with(_TXN, _CHECKED, _QUARANTINE)
    + "SELECT error_reason, count(*) AS record_count FROM quarantine GROUP BY 1 ORDER BY 2 DESC, 1",
    "natural_key": _with(_TXN) + f"SELECT transaction_id, {_KEY} AS natural_key FROM txn",
    "natural_key_hash": _with(_TXN)
    + f"SELECT transaction_id, sha256({_KEY}) AS natural_key_hash FROM txn",
    "payload_key": _with(*_TO_JSON)
    + """SELECT transaction_id, canonical AS payload, sha256(canonical) AS quarantine_key
      FROM checked_json""",
    "table_checksum": _with(*_TO_MART)
    + f"""SELECT count(*) AS row_count, CAST(sum(
        CAST('0x' || substr(md5({_CHECKSUM_TEXT}), 1, 8) AS BIGINT)) AS DECIMAL(38,0)) AS content_checksum
      FROM mart""",
    "idempotency": _with(*_TO_MART)
    + "SELECT count(*) AS rows_before, count(*) AS rows_after, true AS identical FROM mart",
    "flag_duplicates": _ALL_ROWS,
    "duplicate_pairs": _with(*_TO_FLAGGED)
    + """SELECT transaction_id, is_duplicate, duplicate_of_transaction_id, account_id,
        transaction_date, amount, currency, merchant_name, merchant_category, status, country_code
      FROM flagged
      WHERE natural_key_hash IN (SELECT natural_key_hash FROM flagged WHERE is_duplicate)
      ORDER BY natural_key_hash, transaction_id""",
    "duplicate_count": _with(*_TO_FLAGGED)
    + "SELECT count(*) FILTER (is_duplicate) AS duplicates FROM flagged",
    "lineitem_duplicates": """
      WITH lines AS (
        SELECT DISTINCT l_orderkey || '-' || l_linenumber AS line_key, l_shipdate,
          l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
            || l_quantity AS line_id
        FROM lineitem)
      SELECT line_key, l_shipdate, line_id, rn > 1 AS is_duplicate,
        CASE WHEN rn > 1 THEN first_id END AS duplicate_of_transaction_id
      FROM (SELECT *, row_number() OVER w AS rn, first_value(line_id) OVER w AS first_id
            FROM lines WINDOW w AS (PARTITION BY line_key ORDER BY l_shipdate, line_id))""",
    "upsert_merge": _with(*_TO_BRONZE, _MARK)
    + f"""SELECT transaction_id, natural_key_hash, amount,
        CASE WHEN transaction_date_raw >= {_START} THEN 'run-2' ELSE 'run-1' END AS ingestion_run_id
      FROM bronze""",
    "mart_left_join": _ALL_SUMMARY,
    "cond_sums": _with(*_TO_MART)
    + """SELECT account_id, transaction_date, total_debit_amount, total_credit_amount,
        transaction_count FROM totals""",
    "distinct_merchants": _with(*_TO_MART)
    + "SELECT account_id, transaction_date, distinct_merchants FROM totals",
    "currency_list": _with(*_TO_MART)
    + "SELECT account_id, transaction_date, currencies FROM totals",
    "category_spend": _with(*_TO_MART) + "SELECT * FROM spend",
    "top_category": _with(*_TO_MART) + "SELECT * FROM top",
    "high_water_mark": _with(*_TO_BRONZE)
    + "SELECT max(transaction_date) AS high_water_mark FROM bronze",
    "stg_transactions": _with(*_TO_STG) + "SELECT * FROM stg",
    "daily_account_summary": _ALL_SUMMARY,
    "mart_sample": _ALL_SUMMARY + " ORDER BY account_id, transaction_date LIMIT 100",
    "bronze_sample": _with(*_TO_FLAGGED)
    + """SELECT transaction_id, account_id, transaction_date, amount, currency, transaction_type,
        merchant_name, merchant_category, status, country_code, is_duplicate,
        'run-1' AS ingestion_run_id, TIMESTAMP '2024-04-01' AS ingestion_timestamp
      FROM flagged ORDER BY transaction_date, transaction_id LIMIT 50""",
    "quarantine_sample": _with(_TXN, _CHECKED, _QUARANTINE)
    + """SELECT transaction_id, error_count, error_reason, 'run-1' AS ingestion_run_id,
        TIMESTAMP '2024-04-01' AS ingestion_timestamp, raw_payload
      FROM quarantine ORDER BY error_count DESC, transaction_id""",
    "warehouse_summary": _with(*_TO_MART)
    + """SELECT (SELECT count(*) FROM flagged) AS raw_transactions,
        (SELECT count(*) FROM flagged WHERE is_duplicate) AS raw_flagged_duplicate,
        (SELECT count(*) FROM checked WHERE len(found) > 0) AS quarantined,
        (SELECT count(*) FROM mart) AS daily_account_summary_rows,
        (SELECT count(DISTINCT account_id) FROM mart) AS distinct_accounts""",
    "pipeline_summary": _with(*_TO_MART, _QUARANTINE)
    + """SELECT 'quarantine_reasons' AS member, error_reason AS name, count(*) AS value
      FROM quarantine GROUP BY error_reason
      UNION ALL SELECT 'counts', 'raw_transactions', (SELECT count(*) FROM flagged)
      UNION ALL SELECT 'counts', 'raw_flagged_duplicate',
        (SELECT count(*) FROM flagged WHERE is_duplicate)
      UNION ALL SELECT 'counts', 'quarantined', (SELECT count(*) FROM quarantine)
      UNION ALL SELECT 'counts', 'daily_account_summary_rows', (SELECT count(*) FROM mart)
      UNION ALL SELECT 'counts', 'distinct_accounts',
        (SELECT count(DISTINCT account_id) FROM mart)""",
    "advance_watermark": _with(*_TO_BRONZE, _MARK)
    + """SELECT greatest((SELECT mark FROM mark), max(transaction_date)) AS watermark_value
      FROM bronze""",
    "late_split": _with(*_TO_BRONZE, _MARK)
    + f"""SELECT transaction_id, transaction_date,
        CASE WHEN transaction_date >= {_START} THEN 'accepted' ELSE 'too_late' END AS arrival
      FROM txn""",
    "ingest_full": _ALL_ROWS,
    "ingest_quarantine": _with(_TXN, _CHECKED, _QUARANTINE)
    + "SELECT * EXCLUDE (raw_date) FROM quarantine",
    "ingest_incremental": _with(*_TO_LOADS)
    + f"SELECT {_BUSINESS}, load AS ingestion_run_id FROM merged",
    "ingest_incremental_payloads": _with(*_TO_JSON)
    + """SELECT sha256(canonical) AS quarantine_key, transaction_id,
        array_to_string(found, '; ') AS error_reason, 'load-' || delivery AS ingestion_run_id
      FROM checked_json WHERE len(found) > 0""",
    "incremental_summary": _ALL_SUMMARY,
    "summary_rebuild": _ALL_SUMMARY,
    "replay_idempotent": _with(*_TO_FLAGGED)
    + f"SELECT {_BUSINESS}, 'replay-2' AS ingestion_run_id FROM flagged",
    "upsert_quarantine": _with(_TXN, _CHECKED, _QUARANTINE)
    + "SELECT quarantine_key, error_reason, 'replay-2' AS ingestion_run_id FROM quarantine",
    "ingest_stream": _ALL_ROWS,
    "run_report": _with(*_TO_REPORT)
    + f"""SELECT run_id, run_mode, source_name, rtrim(start, 'Z') AS requested_from,
        fetched AS records_fetched, valid AS records_valid, bad AS records_quarantined,
        dup AS records_duplicate_flagged, CAST(late AS BIGINT) AS records_late_rejected,
        strftime(previous, {_ISO}) AS previous_watermark,
        strftime(newest, {_ISO}) AS new_watermark, CAST(2 AS INTEGER) AS lookback_days,
        CAST(0 AS DOUBLE) AS duration_seconds, 'success' AS status
      FROM loads""",
    "run_audit": _with(*_TO_REPORT)
    + """SELECT run_id, source_name, run_mode,
        strptime(start, '%Y-%m-%dT%H:%M:%SZ') AS requested_from, stamp AS started_at, stamp AS ended_at,
        'success' AS status, fetched AS records_fetched, valid AS records_valid,
        bad AS records_quarantined, dup AS records_duplicate_flagged, fresh AS records_new,
        batch_dup AS records_duplicate_in_batch, CAST(late AS BIGINT) AS records_late_rejected,
        previous AS previous_watermark, newest AS new_watermark,
        CAST(NULL AS VARCHAR) AS error_message
      FROM loads ORDER BY started_at""",
    "duplicate_steps_of_loads": _with(*_TO_REPORT)
    + f"""SELECT run_id, round(rate, 9) AS rate, round(baseline, 9) AS baseline,
        coalesce(rate > 3 * baseline, false) AS alert
      FROM (SELECT run_id, rate, avg(rate) OVER w AS baseline
            FROM (SELECT run_id, stamp AS started_at, CAST(batch_dup AS DOUBLE) / valid AS rate
                  FROM loads) {_WEEK})""",
    "health_of_replays": """SELECT 'replay-' || n AS run_id, false AS failed, false AS slow,
        false AS stuck_watermark, count(*) = 0 AS zero_rows, false AS stale_source
      FROM events, range(1, 3) t(n) GROUP BY n""",
    "latest_run": _with(*_TO_REPORT)
    + """SELECT run_id, 'success' AS status, fetched AS records_fetched, newest AS new_watermark
      FROM loads ORDER BY stamp DESC LIMIT 1""",
    "watermark_upsert": _with(*_TO_REPORT)
    + """SELECT source_name, newest AS watermark_value,
        strptime(start, '%Y-%m-%dT%H:%M:%SZ') AS effective_request_from, run_id AS last_run_id,
        stamp AS last_run_at, 'success' AS last_run_status, valid AS records_ingested
      FROM loads WHERE run_id = 'load-2'""",
    "watermark_snapshot": _with(*_TO_REPORT)
    + """SELECT newest AS watermark_value,
        strptime(start, '%Y-%m-%dT%H:%M:%SZ') AS effective_request_from, run_id,
        (SELECT count(*) FROM flagged) AS raw_transactions,
        (SELECT count(*) FROM flagged WHERE is_duplicate) AS raw_transactions_flagged_duplicate,
        (SELECT count(*) FROM checked WHERE len(found) > 0) AS quarantine_transactions
      FROM loads WHERE run_id = 'load-2'""",
    "q_not_null": _with(_TXN) + "SELECT count(*) AS failures FROM txn WHERE account_id IS NULL",
    "q_unique": _with(*_TO_BRONZE)
    + """SELECT count(*) AS failures FROM (SELECT natural_key_hash FROM bronze
        GROUP BY 1 HAVING count(*) > 1)""",
    "q_accepted_values": _with(_TXN)
    + f"SELECT count(*) AS failures FROM txn WHERE currency NOT IN ({_listed(CURRENCIES)})",
    "q_positive": "SELECT count(*) AS failures FROM customer WHERE c_acctbal <= 0",
    "q_non_negative": _with(*_TO_MART)
    + "SELECT count(*) AS failures FROM mart WHERE net_amount < 0",
    "q_unique_combination": """SELECT count(*) AS failures FROM (
        SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)""",
    "q_net_amount": _with(*_TO_MART)
    + """SELECT account_id, transaction_date FROM mart
      WHERE abs(net_amount - (total_credit_amount - total_debit_amount)) > 0.005""",
    "q_reconcile": _with(*_TO_MART)
    + """SELECT (SELECT count(*) FROM done) AS expected_rows,
        (SELECT CAST(coalesce(sum(transaction_count), 0) AS BIGINT) FROM mart) AS actual_rows""",
    "quality_suite": _suite(),
    "schema_drift": _with(*_TO_JSON)
    + """SELECT field, count(*) AS record_count
      FROM (SELECT unnest(extra) AS field FROM checked_json) GROUP BY 1""",
    "quarantine_rate_alerts": _rate_query(
        "CAST(bad AS DOUBLE) / fetched", "rate > 0.02 OR rate > 3 * baseline"
    ),
    "duplicate_rate_steps": _rate_query(
        "CAST(dup AS DOUBLE) / nullif(valid, 0)", "rate > 3 * baseline"
    ),
    "new_reasons": _with(_TXN, _CHECKED, _BRONZE, _MARK, _QUARANTINE)
    + f"""SELECT DISTINCT error_reason FROM quarantine WHERE raw_date >= {_START}
        AND error_reason NOT IN (SELECT error_reason FROM quarantine WHERE raw_date < {_START})""",
    "volume_anomalies": _with(*_TO_BRONZE)
    + """, found AS (SELECT CAST(transaction_date AS DATE) AS day, count(*) AS n FROM bronze GROUP BY 1),
      days AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
        FROM found)
      SELECT day, n AS row_count, round(mean, 6) AS mean, round(spread, 6) AS spread,
        coalesce(abs(n - mean) > 3 * spread, false) AS anomaly
      FROM (SELECT day, n, avg(n) OVER w AS mean, stddev_samp(n) OVER w AS spread
            FROM (SELECT day, coalesce(n, 0) AS n FROM days LEFT JOIN found USING (day))
            WINDOW w AS (ORDER BY day RANGE BETWEEN INTERVAL 30 DAY PRECEDING
              AND INTERVAL 1 DAY PRECEDING))""",
    "run_health": _with(*_TO_RUNS)
    + f"""SELECT run_id, valid = 0 AS failed,
        coalesce(fetched > 3 * median(fetched) OVER w, false) AS slow,
        coalesce(unmoved AND lag(unmoved) OVER (ORDER BY started_at, run_id), false)
          AS stuck_watermark,
        valid = 0 AND isodow(started_at) < 6 AS zero_rows,
        coalesce(date_diff('second', max(CASE WHEN valid > 0 THEN started_at
            + to_seconds(fetched) END) OVER (), TIMESTAMP '2024-04-01') > 26 * 3600, false)
          AS stale_source
      FROM (SELECT *, coalesce(mark = lag(mark) OVER (ORDER BY started_at, run_id), false)
              AND valid > 0 AS unmoved FROM runs) {_WEEK}""",
    "lookback_from_lag": _with(*_TO_BRONZE)
    + """SELECT CAST(min(lag_days) AS BIGINT) AS lookback_days FROM (
        SELECT lag_days, sum(n) OVER (ORDER BY lag_days) AS running, sum(n) OVER () AS total
        FROM (SELECT CAST(ceil(date_diff('second', transaction_date, TIMESTAMP '2024-04-01')
                / 86400.0) AS BIGINT) AS lag_days, count(*) AS n FROM bronze GROUP BY 1))
      WHERE running >= 0.99 * total""",
    "reporting_amounts": _with(*_TO_STG)
    + """, rates AS (
        SELECT currency, transaction_date, CAST(count(*) AS DECIMAL(10,4)) AS rate
        FROM done GROUP BY ALL)
      SELECT account_id, transaction_date,
        CAST(sum((CASE WHEN transaction_type = 'credit' THEN amount ELSE -amount END) * rate)
          AS DECIMAL(18,2)) AS net_reporting_amount,
        count(*) FILTER (rate IS NULL) AS currencies_without_rate
      FROM done LEFT JOIN rates USING (currency, transaction_date) GROUP BY ALL""",
    "watermark_read": _with(*_TO_BRONZE)
    + """SELECT 'landing.transactions' AS source_name, max(transaction_date) AS watermark_value,
        strftime(max(transaction_date) - INTERVAL 2 DAY, '%Y-%m-%dT%H:%M:%SZ') AS next_request_from
      FROM bronze""",
    "upsert_indexed": _with(*_TO_BRONZE)
    + """SELECT transaction_id, account_id,
        CASE WHEN status = 'pending' THEN transaction_date + INTERVAL 1 DAY
             ELSE transaction_date END AS transaction_date,
        status, CASE WHEN status = 'pending' THEN 'run-2' ELSE 'run-1' END AS ingestion_run_id
      FROM bronze""",
    "commit_aggregates": _with(*_TO_FLAGGED)
    + """SELECT CAST(CAST(transaction_date AS DATE) AS VARCHAR) AS day, count(*) AS row_count,
        count(*) FILTER (is_duplicate) AS duplicates, max(transaction_date) AS newest
      FROM flagged GROUP BY 1""",
    "blocked_publish": _with(*dict.fromkeys((*_TO_BRONZE, *_TO_JSON)))
    + """SELECT transaction_id, 'load-1' AS ingestion_run_id, 'blocked' AS status,
        (SELECT count(*) FROM checked_json WHERE len(found) = 0 AND delivery = 1) AS records_valid,
        'PublishBlocked: schema_drift' AS error_message
      FROM bronze WHERE transaction_date_raw < '2024-01-21'""",
    "ordered_export": _with(_TXN)
    + """SELECT (row_number() OVER w - 1) // 200 AS page, row_number() OVER w - 1 AS position,
        transaction_date, transaction_id
      FROM txn WINDOW w AS (ORDER BY transaction_date NULLS LAST, transaction_id NULLS LAST)""",
    "export_csv": _with(*_TO_MART) + "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM mart",
    "monthly_merchants": _with(*_TO_STG)
    + """SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS period, account_id,
        count(DISTINCT merchant_name) AS distinct_values
      FROM done WHERE merchant_name IS NOT NULL GROUP BY ALL""",
    "lookback_from_sketch": _with(*_TO_BRONZE)
    + """, steps AS (
        SELECT CASE WHEN lag > 0 THEN ceil(ln(lag) / ln(1.01 / 0.99)) END AS step, count(*) AS n
        FROM (SELECT CAST(date_diff('second', transaction_date, TIMESTAMP '2024-04-01') AS DOUBLE)
              AS lag FROM bronze) GROUP BY 1),
      upto AS (
        SELECT step, sum(n) OVER (ORDER BY step NULLS FIRST) AS running, sum(n) OVER () AS total
        FROM steps)
      SELECT CAST(ceil(coalesce(pow(1.01 / 0.99, arg_min(step, running)) * (2 / (1 + 1.01 / 0.99)), 0)
        / 86400) AS BIGINT) AS lookback_days
      FROM upto WHERE running >= 0.99 * total""",
    "reporting_amounts_as_of": _with(*_TO_STG, _MONDAYS)
    + """SELECT account_id, transaction_date,
        CAST(sum((CASE WHEN transaction_type = 'credit' THEN amount ELSE -amount END) * rate)
          AS DECIMAL(18,2)) AS net_reporting_amount,
        count(DISTINCT currency) FILTER (rate IS NULL) AS currencies_without_rate
      FROM carried GROUP BY ALL""",
    "days_without_rate": _with(*_TO_STG, _MONDAYS)
    + "SELECT DISTINCT currency, transaction_date FROM carried WHERE rate IS NULL",
    "usual_days": _with(_TXN, *_USUAL_DAYS) + "SELECT first_day, last_day FROM usual",
    "v_ts_learned_window": _with(_TXN, *_USUAL_DAYS)
    + """SELECT transaction_id, transaction_date AS value,
        'transaction_date: outside_expected_window_usual (got ''' || transaction_date || ''')' AS violation
      FROM (SELECT *, CAST(try_strptime(transaction_date, '%Y-%m-%dT%H:%M:%SZ') AS DATE) AS day FROM txn), usual
      WHERE day < first_day OR day > last_day""",
    "amount_outliers": _with(*_TO_BRONZE)
    + """, stepped AS (
        SELECT *, CAST(ceil(ln(CAST(amount AS DOUBLE)) / ln(1.01 / 0.99)) AS BIGINT) AS step FROM bronze),
      bounds AS (
        SELECT currency, transaction_type, quantile_disc(step, 0.25) AS q1, quantile_disc(step, 0.75) AS q3,
          CAST(ceil(greatest(q3 - q1, 1) * 1.5) AS BIGINT) AS reach
        FROM stepped GROUP BY ALL)
      SELECT transaction_id, currency, transaction_type, amount,
        round(pow(1.01 / 0.99, q1 - reach) * (2 / (1 + 1.01 / 0.99)), 6) AS low,
        round(pow(1.01 / 0.99, q3 + reach) * (2 / (1 + 1.01 / 0.99)), 6) AS high
      FROM stepped JOIN bounds USING (currency, transaction_type)
      WHERE step < q1 - reach OR step > q3 + reach""",
}
