"""Expected results of the registered queries, as DuckDB SQL over the given tables.

Each text states the semantics directly: NULL-propagating concatenation is
``||`` (DuckDB's ``concat`` skips NULLs), quality counts are
``count(*) FILTER (...)``, and the strftime rule is Python's own regular
expression for the mask plus a calendar check.
"""

from __future__ import annotations

from .queries import DQ_CUSTOMER_SQL, DQ_LINEITEM_SQL, DQ_ORDER_DAYS_SQL, NAME_REGEX


def _q(text: str | None) -> str:
    if text is None:
        return "CAST(NULL AS VARCHAR)"
    return "'" + text.replace("'", "''") + "'"


def _row(order: int, column: str | None, name: str, expectation: str, element: str,
         unexpected: str | None, success: str | None = None, source: str = "src") -> str:
    unexpected_sql = "CAST(NULL AS BIGINT)" if unexpected is None else f"CAST({unexpected} AS BIGINT)"
    success = success or f"(({unexpected}) = 0)"
    frm = f" FROM {source}" if source else ""
    return (f"SELECT {order} AS check_order, {_q(column or 'Test on dataset')} AS column_name, "
            f"{_q(name)} AS check_name, {_q(expectation)} AS expectation, "
            f"CAST({element} AS BIGINT) AS element_count, {unexpected_sql} AS unexpected_count, "
            f"{success} AS success, CASE WHEN {success} THEN 'Success' ELSE 'Failed' END AS status"
            f"{frm}")


def _not_null(order, col):
    return _row(order, col, "not_null", "Not Null values", "count(*)",
                f"count(*) FILTER (WHERE {col} IS NULL)")


def _length(order, col, lo, hi):
    return _row(order, col, "value_lenght_btw", f"Size of values between {lo} and {hi}",
                f"count({col})",
                f"count(*) FILTER (WHERE length({col}) NOT BETWEEN {lo} AND {hi})")


def _values(order, col, lo, hi):
    return _row(order, col, "values_btw", f"Values between {lo} and {hi}", f"count({col})",
                f"count(*) FILTER (WHERE {col} NOT BETWEEN {lo} AND {hi})")


def _regex(order, col, rx):
    return _row(order, col, "value_match_regex", f"Column value {col} match with {rx}",
                f"count({col})",
                f"count(*) FILTER (WHERE NOT regexp_matches({col}, {_q(rx)}))")


def _count(order, lo, hi):
    return _row(order, None, "df_count_btw", f"Count between {lo} and {hi}", "count(*)", None,
                success=f"(count(*) BETWEEN {lo} AND {hi})")


def _unique(order, col):
    dup = (f"(SELECT coalesce(sum(n), 0) FROM (SELECT {col}, count(*) AS n FROM src "
           f"WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1))")
    return _row(order, col, "unique_vals", "Unique values", f"(SELECT count({col}) FROM src)",
                dup, source="")


# Python's strptime expressions for the two masks (standard library values).
_RX_DASHED = r"^(\d\d\d\d)-(1[0-2]|0[1-9]|[1-9])-(3[0-1]|[1-2]\d|0[1-9]|[1-9]| [1-9])"
_RX_COMPACT = r"^(\d\d\d\d)(1[0-2]|0[1-9]|[1-9])(3[0-1]|[1-2]\d|0[1-9]|[1-9]| [1-9])"


def _parses(col: str, rx: str) -> str:
    """strptime accepts: the first match covers the text and is a real date."""
    y = f"regexp_extract({col}, {_q(rx)}, 1)"
    m = f"regexp_extract({col}, {_q(rx)}, 2)"
    d = f"trim(regexp_extract({col}, {_q(rx)}, 3))"
    date = f"TRY_CAST({y} || '-' || lpad({m}, 2, '0') || '-' || lpad({d}, 2, '0') AS DATE)"
    return (f"coalesce(regexp_matches({col}, {_q(rx)}) "
            f"AND length(regexp_extract({col}, {_q(rx)}, 0)) = length({col}) "
            f"AND TRY_CAST({y} AS INTEGER) >= 1 AND {date} IS NOT NULL, false)")


def _mask(order, col, mask, rx):
    return _row(order, col, "date_mask_equal", f"Date mask with mask {mask}", f"count({col})",
                f"count(*) FILTER (WHERE {col} IS NOT NULL AND NOT {_parses(col, rx)})")


def _union(*rows: str) -> str:
    return "\nUNION ALL\n".join(rows)


_CUSTOMER_SRC = f"WITH src AS ({DQ_CUSTOMER_SQL})\n"
_ORDER_DAYS_SRC = f"WITH src AS ({DQ_ORDER_DAYS_SQL})\n"

_SUITE_ROWS = [
    _not_null(0, "c_custkey"), _not_null(1, "c_name"), _not_null(2, "c_mktsegment"),
    _unique(3, "c_custkey"), _unique(4, "c_code"), _unique(5, "c_acctbal"),
    _length(6, "c_name", 5, 18), _length(7, "c_mktsegment", 1, 10),
    _values(8, "c_acctbal", -500, 9000), _values(9, "c_nationkey", 0, 20),
    _regex(10, "c_name", NAME_REGEX),
    _count(11, 1, 1000000),
]

_LINEITEM_SRC = f"WITH src AS ({DQ_LINEITEM_SQL})\n"
_LINEITEM_ROWS = [
    _not_null(0, "l_orderkey"), _not_null(1, "l_partkey"), _not_null(2, "ship_day"),
    _unique(3, "l_orderkey"), _unique(4, "l_partkey"),
    _values(5, "l_discount", 0, 0.08), _values(6, "l_quantity", 1, 45),
    _length(7, "l_returnflag", 1, 1),
    _regex(8, "l_linestatus", "^[OF]$"),
    _mask(9, "ship_day", "%Y-%m-%d", _RX_DASHED),
    _count(10, 1, 1000000000),
]

_INT_FRACTION = r"\.[0-9]*\s*$"


ORACLES: dict[str, str] = {
    "bronze_csv_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "ingest_json_landing":
        "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "bronze_latest_day": """
        SELECT event_id, ts, user_id, event_type, value, props FROM events
        WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
    "bronze_backfill_days": """
        SELECT event_id, ts, user_id, event_type, value, props,
               strftime(ts, '%Y%m%d') AS ingest_date
        FROM events""",
    "silver_schema_cast": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
               TRY_CAST(regexp_replace(o_orderpriority, {_q(_INT_FRACTION)}, '') AS INTEGER)
                 AS o_orderpriority,
               TRY_CAST(regexp_replace(substr(o_orderpriority, 1, 1) || '.0',
                                       {_q(_INT_FRACTION)}, '') AS INTEGER) AS o_priority_rank
        FROM orders""",
    "silver_cast_loss": _union(
        "SELECT 'o_orderkey' AS column_name, 'BIGINT' AS declared_type, "
        "count(o_orderkey) AS present, CAST(0 AS BIGINT) AS lost FROM orders",
        "SELECT 'o_custkey', 'BIGINT', count(o_custkey), CAST(0 AS BIGINT) FROM orders",
        "SELECT 'o_orderstatus', 'STRING', count(o_orderstatus), CAST(0 AS BIGINT) FROM orders",
        "SELECT 'o_totalprice', 'DOUBLE', count(o_totalprice), CAST(0 AS BIGINT) FROM orders",
        "SELECT 'o_orderdate', 'TIMESTAMP_NTZ', count(o_orderdate), CAST(0 AS BIGINT) FROM orders",
        f"SELECT 'o_orderpriority', 'INT', count(o_orderpriority), count(*) FILTER (WHERE "
        f"TRY_CAST(regexp_replace(o_orderpriority, {_q(_INT_FRACTION)}, '') AS INTEGER) IS NULL) "
        f"FROM orders",
        f"SELECT 'o_priority_rank', 'INT', count(o_orderpriority), count(*) FILTER (WHERE "
        f"TRY_CAST(regexp_replace(substr(o_orderpriority, 1, 1) || '.0', {_q(_INT_FRACTION)}, '') "
        f"AS INTEGER) IS NULL) FROM orders"),
    "silver_missing_columns": """
        SELECT s_suppkey, s_name, s_nationkey, CAST(NULL AS VARCHAR) AS s_phone FROM supplier""",
    "silver_partition_last": """
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus
        FROM orders""",
    "silver_partition_overwrite": """
        SELECT o_orderkey, o_custkey,
               CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END
                 AS o_totalprice,
               o_orderdate, o_orderpriority, o_orderstatus
        FROM orders""",
    "silver_append": """
        SELECT p_partkey, p_name, p_type, p_size, p_retailprice, p_brand FROM part
        WHERE p_size <= 25
        UNION ALL
        SELECT p_partkey, p_name, p_type, p_size, p_retailprice, p_brand FROM part
        WHERE p_size > 25""",
    "silver_lineitem_by_flag": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               l_discount, l_tax, l_linestatus, l_shipdate, l_returnflag
        FROM lineitem""",
    "dq_lineitem_suite": _LINEITEM_SRC + _union(*_LINEITEM_ROWS),
    "gold_filtered_projection": """
        SELECT p_partkey % 100 AS shelf, p_partkey AS item,
               'size ' || CAST(p_size AS VARCHAR) || ': ' || upper(p_type) AS kind,
               CASE WHEN p_partkey % 11 <> 0 AND p_partkey % 5 <> 0
                    THEN CAST(p_retailprice AS VARCHAR) || ' for ' || p_name END AS offer,
               p_brand
        FROM part
        WHERE p_partkey % 7 <> 0 AND p_size BETWEEN 5 AND 30
          AND (p_partkey % 11 = 0 OR p_retailprice > 950)""",
    "gold_alias_shadowing": """
        SELECT c_custkey AS customer_id, c_name AS c_mktsegment, c_mktsegment AS segment
        FROM customer
        WHERE c_mktsegment = 'BUILDING'""",
    "gold_partition_pruned": """
        SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
        WHERE c_mktsegment = 'BUILDING'""",
    "gold_joined_dataset": """
        SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, n.n_name AS nation,
               r.r_name AS region, c.c_acctbal AS balance, c.c_mktsegment AS segment
        FROM customer c
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey
        WHERE r.r_name = 'AMERICA'""",
    "gold_write_readback": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
               o_totalprice AS total_price, o_orderstatus AS status
        FROM orders""",
    "dq_not_null": _CUSTOMER_SRC + _union(
        _not_null(0, "c_custkey"), _not_null(1, "c_name"), _not_null(2, "c_mktsegment"),
        _not_null(3, "c_acctbal")),
    "dq_unique": "WITH src AS (SELECT * FROM orders)\n" + _union(
        _unique(0, "o_orderkey"), _unique(1, "o_custkey")),
    "dq_date_mask": _ORDER_DAYS_SRC + _union(
        _mask(0, "order_day", "%Y-%m-%d", _RX_DASHED),
        _mask(1, "order_day_compact", "%Y%m%d", _RX_COMPACT)),
    "dq_value_length_between": _CUSTOMER_SRC + _union(
        _length(0, "c_name", 5, 18), _length(1, "c_mktsegment", 1, 10),
        _length(2, "c_code", 1, 2)),
    "dq_values_between": _CUSTOMER_SRC + _union(
        _values(0, "c_acctbal", -500, 9000), _values(1, "c_nationkey", 0, 20),
        _values(2, "c_custkey", 10, 1000)),
    "dq_match_regex": _CUSTOMER_SRC + _regex(0, "c_name", NAME_REGEX),
    "dq_row_count_between": "WITH src AS (SELECT * FROM lineitem)\n" + _union(
        _count(0, 1, 100000), _count(1, 70000, 80000)),
    "dq_suite_report": _CUSTOMER_SRC + _union(*_SUITE_ROWS),
    "dq_gate": _CUSTOMER_SRC + ", report AS (" + _union(*_SUITE_ROWS) + """)
        SELECT count(*) AS checks, count(*) FILTER (WHERE NOT success) AS failed_checks,
               coalesce(bool_and(success), true) AS passed
        FROM report""",
    "run_ledger": """
        SELECT 'capture_api' AS job_name, 'success' AS status, 'orders' AS table_name,
               'tpch' AS source, '' AS error, '' AS error_desc, count(*) AS rows_written,
               'load_csv' AS step_names, true AS dated_by_start, true AS ends_after_start,
               2 AS info_lines
        FROM orders
        UNION ALL
        SELECT 'bronze_to_silver', 'success', 'orders', 'tpch', '', '', count(*),
               'read_csv,cast_df,create_table,write_table', true, true, 5 FROM orders
        UNION ALL
        SELECT 'bronze_to_silver', 'failed', 'orders', 'tpch',
               'Error while trying to execute the step cast_df',
               'silver_tpch.orders_untyped: no ''schema'' in the parameters; it is needed to '
               || 'create the table',
               CAST(NULL AS BIGINT), 'read_csv', true, true, 2""",
    "run_ledger_steps": """
        SELECT 'events' AS job_name, event_type AS step, count(*) AS runs,
               round(sum(value), 6) AS total_seconds, round(avg(value), 6) AS avg_seconds,
               round(max(value), 6) AS max_seconds
        FROM events GROUP BY event_type""",
    "table_catalog": """
        SELECT 'silver' AS layer, 'customer' AS table_name, 5 AS n_columns,
               'c_mktsegment' AS partition_column, count(*) AS row_count FROM customer
        UNION ALL
        SELECT 'silver', 'orders', 6, 'o_orderstatus', count(*) FROM orders
        UNION ALL
        SELECT 'silver', 'nation', 3, CAST(NULL AS VARCHAR), count(*) FROM nation""",
    "layers_end_to_end": """
        SELECT c_nationkey AS nation_key, count(*) AS customers,
               CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS balance,
               max(c_name || ' / ' || c_mktsegment) AS last_customer
        FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE') GROUP BY c_nationkey""",
}
