"""The same questions in DuckDB SQL, over the tables themselves."""

from __future__ import annotations

from tillroll.fixtures import EARLY_LINES
from tillroll.plans.queries import FIRST_ID, LAST_ID, LOOKUP, REPORT_SINCE, REPORT_UNTIL
from tillroll.schema import ORDER_ID, PRODUCT

_LINE = """
  SELECT CASE WHEN pk % 89 = 0 OR pk % 97 = 0 THEN NULL ELSE k END AS "Order ID",
         CASE WHEN pk % 89 = 0 THEN 'Product' ELSE product END AS "Product",
         CASE WHEN pk % 89 = 0 THEN NULL ELSE qty END AS "Quantity Ordered",
         CASE WHEN pk % 89 = 0 THEN NULL ELSE price END AS "Price Each",
         CASE WHEN pk % 89 = 0 THEN 'Order Date' WHEN pk % 101 = 0 THEN 'unknown'
              ELSE strftime(moment, '%m/%d/%y %H:%M') END AS "Order Date",
         CASE WHEN pk % 89 = 0 THEN 'Purchase Address' ELSE addr END AS "Purchase Address",
         line, pk, pk % 89 = 0 AS header_again
  FROM base"""

# The dirty source rows: every line once, some of those with a key a second time.
_SALES = f"""
WITH base AS (
  SELECT l_orderkey AS k, p_name AS product, CAST(l_quantity AS INTEGER) AS qty,
         l_extendedprice AS price,
         o_orderdate + INTERVAL 24 YEAR + to_minutes(CAST(l_partkey % 1440 AS INTEGER)) AS moment,
         c_name || ', ' || c_mktsegment AS addr, l_partkey AS pk, l_linenumber AS line
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey),
lines AS ({_LINE}
  UNION ALL{_LINE}
  WHERE pk % 50 = 0 AND pk % 89 <> 0 AND pk % 97 <> 0),
sales AS (SELECT * EXCLUDE (line, pk, header_again) FROM lines)"""

_ORDER = """"Quantity Ordered" DESC NULLS LAST,
    try_strptime("Order Date", '%m/%d/%y %H:%M') DESC NULLS LAST,
    "Price Each" DESC NULLS LAST, "Purchase Address" ASC NULLS LAST,
    "Order Date" DESC NULLS LAST"""


def _survivors(rows: str) -> str:
    """Full-row distinct, then the first row per key."""
    return f"""(SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY "Order ID", "Product" ORDER BY {_ORDER}) AS rn
  FROM (SELECT DISTINCT * FROM {rows})) WHERE rn = 1)"""


def _cleansed(rows: str) -> str:
    return f"""(SELECT "Order ID" AS "Order_ID", "Product", "Quantity Ordered" AS "Quantity_Ordered",
  "Price Each" AS "Price_Each", d AS "Order_Date", "Purchase Address" AS "Purchase_Address",
  CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month
  FROM (SELECT *, try_strptime("Order Date", '%m/%d/%y %H:%M') AS d FROM {_survivors(rows)}))"""


_KEYED = '(SELECT * FROM sales WHERE "Order ID" IS NOT NULL)'


def _keyed_lines(condition: str) -> str:
    return f"""(SELECT * EXCLUDE (line, pk, header_again) FROM lines
  WHERE "Order ID" IS NOT NULL AND {condition})"""


_EARLY = _keyed_lines(f"line <= {EARLY_LINES}")
_LATE = _keyed_lines(f"line > {EARLY_LINES}")
_ALL_CLEAN = f"{_SALES} SELECT * FROM {_cleansed(_KEYED)}"
_EARLY_THEN_LATE = (
    f"{_SALES} SELECT * FROM {_cleansed(_EARLY)} UNION ALL SELECT * FROM {_cleansed(_LATE)}"
)
# Prices of the tables have two places: whole cents add up exactly.
_TOTALS = """count(*) AS n_lines, CAST(sum("Quantity_Ordered") AS BIGINT) AS units,
  CAST(CAST(sum(CAST(round("Price_Each" * 100) AS BIGINT) * "Quantity_Ordered") AS DECIMAL(34,0))
    * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(38,2)) AS revenue"""

# Lines of files of their own that hold values of wrong types, and which of these do.
_THIRD = f"line > {EARLY_LINES} AND pk % 3 = 0"
_WRONG = f"({_THIRD} AND pk % 2 = 0 AND NOT header_again)"

_COLUMNS = (
    ("Order ID", "bigint", True),
    ("Product", "string", False),
    ("Quantity Ordered", "int", True),
    ("Price Each", "double", True),
    ("Order Date", "string", False),
    ("Purchase Address", "string", False),
)


def _nulls(rows: str) -> str:
    counts = ", ".join(
        f'count(*) FILTER (WHERE "{c}" IS NULL) AS "{c}"' for c, _, _ in _COLUMNS
    )
    return f"{_SALES} SELECT {counts} FROM {rows}"


def _describe() -> str:
    parts = []
    for c, kind, number in _COLUMNS:
        is_whole = kind in ("int", "bigint")
        whole = [
            f"""CAST({f}("{c}") AS DECIMAL(38,0))""" if is_whole else "CAST(NULL AS DECIMAL(38,0))"
            for f in ("min", "max")
        ]
        value = f'CAST("{c}" AS DOUBLE)' if number else f'TRY_CAST("{c}" AS DOUBLE)'
        extremes = [f"{f}({value})" if number else "CAST(NULL AS DOUBLE)" for f in ("min", "max")]
        texts = ["CAST(NULL AS VARCHAR)" if number else f'{f}("{c}")' for f in ("min", "max")]
        parts.append(
            f"""SELECT '{c}' AS column_name, count("{c}") AS n, round(avg({value}), 4) AS mean,
  round(stddev({value}), 4) AS sd, {extremes[0]} AS min_number, {extremes[1]} AS max_number,
  {whole[0]} AS min_whole, {whole[1]} AS max_whole,
  {texts[0]} AS min_text, {texts[1]} AS max_text FROM sales"""
        )
    return f"{_SALES} " + " UNION ALL ".join(parts)


def _kept_profile() -> str:
    nulls = " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE "{c}" IS NULL) AS BIGINT) AS n_null,
  CAST(count(*) FILTER (WHERE "{c}" IS NULL AND "Order ID" IS NOT NULL) AS BIGINT) AS n_null_with_key
  FROM sales"""
        for c, _, _ in _COLUMNS
    )
    described = _describe().removeprefix(f"{_SALES} ")
    return f"{_SALES} SELECT * FROM ({described}) JOIN ({nulls}) USING (column_name)"


def _file_schemas() -> str:
    kinds = {"Order ID": "pk % 5 = 0", "Quantity Ordered": "pk % 5 = 1", "Price Each": "pk % 5 > 1"}
    parts = []
    for i, (c, t, _) in enumerate(_COLUMNS, start=1):
        wrong = f"{_WRONG} AND {kinds[c]}" if c in kinds else "false"
        parts.append(
            f"""SELECT {len(_COLUMNS)} AS n_columns, {i} AS position, '{c}' AS column_name,
  '{t}' AS data_type, count(*) AS n_rows,
  count(*) FILTER (WHERE "{c}" IS NULL AND NOT ({wrong})) AS n_null,
  count(*) FILTER (WHERE {wrong}) AS n_misfit FROM lines WHERE NOT header_again"""
        )
    return f"{_SALES} " + " UNION ALL ".join(parts)


def _profile() -> str:
    counts = {
        "nulls": ("IS NULL", "sales"),
        "nulls with key": ("IS NULL", _KEYED),
        "values": ("IS NOT NULL", "sales"),
    }
    parts = [
        f"""SELECT '{section}' AS section, '{c}' AS item,
  count(*) FILTER (WHERE "{c}" {test}) AS n FROM {rows}"""
        for section, (test, rows) in counts.items()
        for c, _, _ in _COLUMNS
    ]
    levels = {
        "n_rows": f"SELECT * FROM {_KEYED}",
        "n_distinct_rows": f"SELECT DISTINCT * FROM {_KEYED}",
        "n_distinct_keys": f"""SELECT DISTINCT "Order ID", "Product" FROM {_KEYED}""",
    }
    parts += [f"SELECT 'levels', '{k}', count(*) FROM ({q})" for k, q in levels.items()]
    parts.append(
        f"""SELECT * FROM (SELECT 'top keys', CAST("Order ID" AS VARCHAR) || '|' || "Product", count(*) AS c
  FROM {_KEYED} GROUP BY "Order ID", "Product"
  ORDER BY c DESC, "Order ID" NULLS FIRST, "Product" NULLS FIRST LIMIT 20)"""
    )
    return f"{_SALES} " + " UNION ALL ".join(parts)


_ROWS = f"{_SALES} SELECT * FROM sales"
_KEY_COUNTS = f"""SELECT "Order ID", "Product", count(*) AS cnt FROM {_KEYED} GROUP BY ALL"""

# Early lines with whole prices and no channel, late ones with both.
_EARLY_V1 = f"""(SELECT * EXCLUDE (line, pk, header_again)
  REPLACE (CAST(floor("Price Each") AS DOUBLE) AS "Price Each"), CAST(NULL AS VARCHAR) AS "Channel"
  FROM lines WHERE "Order ID" IS NOT NULL AND line <= {EARLY_LINES})"""
_LATE_V2 = f"""(SELECT * EXCLUDE (line, pk, header_again),
  CASE WHEN pk % 2 = 0 THEN 'web' ELSE 'shop' END AS "Channel" FROM lines
  WHERE "Order ID" IS NOT NULL AND line > {EARLY_LINES})"""


def _evolved(rows: str) -> str:
    order = _ORDER.replace('"Order Date" DESC NULLS LAST', '"Channel" ASC NULLS LAST, "Order Date" DESC NULLS LAST')
    return f"""SELECT "Order ID" AS "Order_ID", "Product", "Quantity Ordered" AS "Quantity_Ordered",
  "Price Each" AS "Price_Each", d AS "Order_Date", "Purchase Address" AS "Purchase_Address", "Channel",
  CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month FROM (
  SELECT *, try_strptime("Order Date", '%m/%d/%y %H:%M') AS d, row_number() OVER (
    PARTITION BY "Order ID", "Product" ORDER BY {order}) AS rn
  FROM (SELECT DISTINCT * FROM {rows})) WHERE rn = 1"""


ORACLES: dict[str, str] = {
    "remove_nulls": f"{_SALES} SELECT * FROM {_KEYED}",
    "rejected_rows": f"""{_SALES} SELECT "Product", count(*) AS cnt FROM sales
  WHERE "Order ID" IS NULL GROUP BY ALL""",
    "key_lookup": f"""{_ROWS} WHERE "Order ID" = {LOOKUP[ORDER_ID]}
  AND "Product" = '{LOOKUP[PRODUCT]}'""",
    "exact_distinct": f"{_SALES} SELECT DISTINCT * FROM {_KEYED}",
    "keep_max": f"{_SALES} SELECT * FROM {_survivors('sales')}",
    "remove_duplicates": f"""{_SALES} SELECT *,
  CAST(year(try_strptime("Order Date", '%m/%d/%y %H:%M')) AS INTEGER) AS year,
  CAST(month(try_strptime("Order Date", '%m/%d/%y %H:%M')) AS INTEGER) AS month
  FROM {_survivors(_KEYED)}""",
    "parse_order_date": """SELECT event_id, d AS "Order Date", CAST(year(d) AS INTEGER) AS year,
  CAST(month(d) AS INTEGER) AS month
  FROM (SELECT event_id, CASE WHEN event_id % 101 = 0 THEN NULL
          ELSE CAST(date_trunc('minute', ts) AS TIMESTAMP) END AS d FROM events)""",
    "rename_columns": f"""{_SALES} SELECT "Order ID" AS "Order_ID", "Product",
  "Quantity Ordered" AS "Quantity_Ordered", "Price Each" AS "Price_Each",
  "Order Date" AS "Order_Date", "Purchase Address" AS "Purchase_Address" FROM sales""",
    "cleanse": _ALL_CLEAN,
    "null_profile": _nulls("sales"),
    "null_profile_with_key": _nulls(_KEYED),
    "required_violations": f"""{_ALL_CLEAN} WHERE "Order_ID" IS NULL OR "Product" IS NULL
  OR "Quantity_Ordered" IS NULL OR "Order_Date" IS NULL""",
    "describe_profile": _describe(),
    "count_levels": f"""{_SALES} SELECT (SELECT count(*) FROM {_KEYED}) AS n_rows,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM {_KEYED})) AS n_distinct_rows,
  (SELECT count(*) FROM (SELECT DISTINCT "Order ID", "Product" FROM {_KEYED})) AS n_distinct_keys""",
    "dup_key_counts": f"{_SALES} {_KEY_COUNTS} HAVING count(*) > 1",
    "top_dup_keys": f"""{_SALES} {_KEY_COUNTS}
  ORDER BY cnt DESC, "Order ID" NULLS FIRST, "Product" NULLS FIRST LIMIT 20""",
    "top_keys_after_dedup": f"""{_SALES} SELECT "Order ID", "Product", count(*) AS cnt
  FROM {_survivors(_KEYED)} GROUP BY ALL
  ORDER BY cnt DESC, "Order ID" NULLS FIRST, "Product" NULLS FIRST LIMIT 5""",
    "profile": _profile(),
    "kept_profile": _kept_profile(),
    "top_dup_keys_bounded": f"""{_SALES} {_KEY_COUNTS}
  ORDER BY cnt DESC, "Order ID" NULLS FIRST, "Product" NULLS FIRST LIMIT 20""",
    "list_files": f"""{_SALES} SELECT CASE WHEN line <= {EARLY_LINES} THEN 'early' ELSE 'late' END
  AS came, count(*) AS n_lines FROM lines GROUP BY ALL""",
    "csv_scan": _ROWS,
    "csv_scan_inferred": _ROWS,
    "csv_scan_multi": _ROWS,
    "file_schema_profile": _file_schemas(),
    "union_gated": f"""{_SALES} SELECT * EXCLUDE (line, pk, header_again) FROM lines
  WHERE line <= {EARLY_LINES}""",
    "rejected_files": f"""{_SALES} SELECT 'header differs' AS reason, count(*) AS n_lines
  FROM lines WHERE line > {EARLY_LINES}""",
    "new_files_only": f"""{_SALES} SELECT * EXCLUDE (line, pk, header_again) FROM lines
  WHERE line > {EARLY_LINES}""",
    "partitioned_write_read": _ALL_CLEAN,
    "append_gated": _EARLY_THEN_LATE,
    "batch_job": _ALL_CLEAN,
    "batch_job_header": f"{_SALES} SELECT * FROM {_cleansed(_keyed_lines(f'NOT {_WRONG}'))}",
    "batch_job_strict": f"{_SALES} SELECT * FROM {_cleansed(_keyed_lines(f'NOT ({_THIRD})'))}",
    "batch_job_fail": _ALL_CLEAN,
    "rejected_lines": f"""{_SALES} SELECT CASE WHEN {_WRONG} THEN 'wrong value type'
  ELSE 'no order id' END AS reason, count(*) AS n_lines
  FROM lines WHERE {_WRONG} OR "Order ID" IS NULL GROUP BY ALL""",
    "incremental_append": _EARLY_THEN_LATE,
    "incremental_upsert": _ALL_CLEAN,
    "stream_incremental": _ALL_CLEAN,
    "order_months": f"""{_SALES}, early AS (SELECT * FROM {_cleansed(_EARLY)}),
  late AS (SELECT DISTINCT "Order ID" AS i FROM {_LATE})
  SELECT year, month, (min(i) // 64) * 64 AS low, (max(i) // 64) * 64 + 63 AS high
  FROM early JOIN late ON "Order_ID" = i GROUP BY year, month""",
    "clustered_lookup": f"{_ALL_CLEAN} WHERE \"Order_ID\" BETWEEN {FIRST_ID} AND {LAST_ID}",
    "corrected_file": _ALL_CLEAN,
    "evolved_merge": f"{_SALES} {_evolved(f'(SELECT * FROM {_EARLY_V1} UNION ALL SELECT * FROM {_LATE_V2})')}",
    "evolved_append": f"{_SALES} {_evolved(_EARLY_V1)} UNION ALL {_evolved(_LATE_V2)}",
    "kept_report": f"{_SALES} SELECT year, month, {_TOTALS} FROM {_cleansed(_KEYED)} GROUP BY ALL",
    "packed_appends": _EARLY_THEN_LATE,
    "estimated_orders": f"""{_SALES} SELECT year, count(DISTINCT "Order_ID") AS orders, true AS near
  FROM {_cleansed(_KEYED)} GROUP BY year""",
    "monthly_report": f"{_SALES} SELECT year, month, {_TOTALS} FROM {_cleansed(_KEYED)} GROUP BY ALL",
    "yearly_report": f"{_SALES} SELECT year, {_TOTALS} FROM {_cleansed(_KEYED)} GROUP BY ALL",
    "monthly_report_pruned": f"""{_SALES} SELECT year, month, {_TOTALS} FROM {_cleansed(_KEYED)}
  WHERE year * 100 + month BETWEEN {REPORT_SINCE[0] * 100 + REPORT_SINCE[1]}
    AND {REPORT_UNTIL[0] * 100 + REPORT_UNTIL[1]} GROUP BY ALL""",
}
