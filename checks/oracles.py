"""The same results in plain SQL, for an independent engine over the same tables."""

from __future__ import annotations

# Written out here, not taken from the library, so that a wrong rule there cannot hide.
REFRESH_DAY = "1999-01-01"
BASE_YEAR = 2015

BATCH_TEXT_COLUMNS = (
    "order_id", "ship_mode", "customer_id", "customer_name", "segment", "country", "city", "state",
    "region", "product_id", "category", "sub_category", "product_name",
)
STREAM_TEXT_COLUMNS = BATCH_TEXT_COLUMNS + ("postal_code",)
ORDER_LINE_COLUMNS = (
    "row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "customer_name",
    "segment", "country", "city", "state", "postal_code", "region", "product_id", "category",
    "sub_category", "product_name", "sales", "quantity", "discount", "profit",
)

# A rule's name, and what a row must fulfil to stay, in the order of testing.
Rules = dict[str, str]
V1: Rules = {
    "null_order": "order_id IS NOT NULL",
    "null_customer": "customer_id IS NOT NULL",
    "null_product": "product_id IS NOT NULL",
    "null_sales": "sales IS NOT NULL",
}
V2: Rules = {
    "null_order": "order_id IS NOT NULL",
    "null_customer": "customer_id IS NOT NULL",
    "null_product": "product_id IS NOT NULL",
    "blank_key": "order_id <> '' AND customer_id <> '' AND product_id <> ''",
    "null_sales": "sales IS NOT NULL",
    "bad_date": "order_date IS NOT NULL",
    "negative_sales": "NOT sales < 0",
}
STREAM: Rules = {
    "null_order": "order_id IS NOT NULL",
    "null_customer": "customer_id IS NOT NULL",
    "blank_key": "order_id <> '' AND customer_id <> ''",
    "null_sales": "sales IS NOT NULL",
    "bad_date": "order_date IS NOT NULL",
    "sales_not_positive": "sales > 0",
    "quantity_not_positive": "quantity > 0",
    "discount_out_of_range": "discount >= 0 AND discount <= 1",
}


def fault(quantity: int) -> str:
    return f"(l_quantity = {quantity} AND l_tax < 0.035)"


def padded(value: str) -> str:
    return f"CASE WHEN l_linenumber = 1 THEN '  ' || {value} || ' ' ELSE {value} END"


SALES = "CAST(l_extendedprice AS DECIMAL(18,2))"

BRONZE = f"""
bronze AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS row_id,
    CASE WHEN NOT {fault(31)} THEN {padded("CAST(l_orderkey AS VARCHAR)")} END AS order_id,
    CASE WHEN {fault(17)} THEN strftime(o_orderdate, '%d-%m-%Y')
      ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
    strftime(l_shipdate, '%Y-%m-%d') AS ship_date,
    {padded("o_orderpriority")} AS ship_mode,
    CASE WHEN {fault(37)} THEN '   ' WHEN NOT {fault(11)} THEN CAST(c_custkey AS VARCHAR) END AS customer_id,
    {padded("(c_name || CASE WHEN o_orderstatus = 'P' THEN ' & Co' ELSE '' END)")} AS customer_name,
    {padded("c_mktsegment")} AS segment,
    'United States' AS country,
    n_name || '-' || CAST(c_custkey % 4 AS VARCHAR) AS city,
    n_name AS state,
    lpad(CAST(c_custkey % 100 AS VARCHAR), 5, '0') AS postal_code,
    r_name AS region,
    CASE WHEN NOT {fault(41)} THEN {padded("CAST(l_partkey AS VARCHAR)")} END AS product_id,
    p_type AS category,
    p_brand AS sub_category,
    p_name || CASE WHEN l_returnflag = 'R' THEN ' II' ELSE '' END AS product_name,
    CASE WHEN {fault(29)} THEN 'n/a' WHEN {fault(23)} THEN CAST(-{SALES} AS VARCHAR)
      ELSE CAST({SALES} AS VARCHAR) END AS sales,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity,
    CASE WHEN {fault(43)} THEN '1.50' ELSE CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) END AS discount,
    CAST(CAST({SALES} * (CAST(0.30 AS DECIMAL(3,2)) - 4 * CAST(l_discount AS DECIMAL(4,2)))
      AS DECIMAL(18,4)) AS VARCHAR) AS profit
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN part ON l_partkey = p_partkey
)"""

CASTS = {
    "row_id": "TRY_CAST(row_id AS BIGINT)",
    "order_date": "CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE)",
    "ship_date": "CAST(try_strptime(ship_date, '%Y-%m-%d') AS DATE)",
    "sales": "TRY_CAST(sales AS DECIMAL(24,6))",
    "quantity": "TRY_CAST(quantity AS INTEGER)",
    "discount": "TRY_CAST(discount AS DECIMAL(12,6))",
    "profit": "TRY_CAST(profit AS DECIMAL(24,6))",
}


def lines(trim_columns: tuple[str, ...] = (), cast: bool = True) -> str:
    """Select list of all 21 columns, cast and trimmed."""
    parts = []
    for column in ORDER_LINE_COLUMNS:
        value = CASTS.get(column, column) if cast else column
        parts.append(f"{f'trim({value})' if column in trim_columns else value} AS {column}")
    return ", ".join(parts)


def kept(rules: Rules) -> str:
    return " AND ".join(f"({keep})" for keep in rules.values())


def broken(keep: str) -> str:
    return f"NOT coalesce({keep}, false)"


def reason(rules: Rules) -> str:
    whens = " ".join(f"WHEN {broken(keep)} THEN '{name}'" for name, keep in rules.items())
    return f"CASE {whens} END"


def first_rows(source: str, keys: str, order: str, columns: tuple[str, ...]) -> str:
    tie_break = ", ".join(f"{c} ASC NULLS FIRST" for c in columns)
    return f"""SELECT {", ".join(columns)} FROM (
      SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}, {tie_break}) AS place
      FROM {source}) AS numbered WHERE place = 1"""


def unique_lines(source: str) -> str:
    return first_rows(source, "order_id, product_id", "row_id ASC NULLS LAST", ORDER_LINE_COLUMNS)


def key_of(*parts: str) -> str:
    text = " || ".join(f"coalesce(length({p}) || ':' || {p}, 'null;')" for p in parts)
    number = f"CAST('0x' || substr(md5({text}), 1, 16) AS UBIGINT)"
    return (
        f"CASE WHEN {number} >= 9223372036854775808"
        f" THEN CAST(CAST({number} AS HUGEINT) - 18446744073709551616 AS BIGINT)"
        f" ELSE CAST({number} AS BIGINT) END"
    )


def newest(source: str, key: str, attributes: str) -> str:
    names = tuple(a.strip() for a in attributes.split(","))
    picked = (key,) + names
    return first_rows(
        f"(SELECT * FROM {source} WHERE {key} IS NOT NULL)",
        key,
        "order_date DESC NULLS LAST, row_id ASC NULLS LAST",
        picked,
    )


DATE_KEY = "CAST(year(order_date) * 10000 + month(order_date) * 100 + day(order_date) AS INTEGER)"

STAR = f"""
dim_date AS (
  SELECT order_date, {DATE_KEY} AS date_key, year(order_date) AS year, month(order_date) AS month,
    quarter(order_date) AS quarter, day(order_date) AS day, strftime(order_date, '%B') AS month_name
  FROM (SELECT DISTINCT order_date FROM silver WHERE order_date IS NOT NULL) AS days
),
dim_customer AS (
  SELECT *, {key_of("customer_id")} AS customer_key
  FROM ({newest("silver", "customer_id", "customer_name, segment")}) AS c
),
dim_product AS (
  SELECT *, {key_of("product_id")} AS product_key
  FROM ({newest("silver", "product_id", "product_name, category, sub_category")}) AS p
),
dim_region AS (
  SELECT *, {key_of("region", "state", "city")} AS region_key
  FROM (SELECT DISTINCT region, state, city FROM silver) AS r
),
fact_orders AS (
  SELECT order_id, ship_mode, date_key, customer_key, product_key, region_key,
    sales, quantity, discount, profit
  FROM silver
  LEFT JOIN dim_date USING (order_date)
  LEFT JOIN (SELECT customer_id, customer_key FROM dim_customer) AS c USING (customer_id)
  LEFT JOIN (SELECT product_id, product_key FROM dim_product) AS p USING (product_id)
  LEFT JOIN dim_region USING (region, state, city)
)"""

TOTALS = """
live AS (
  SELECT category, region,
    CAST(round(sum(sales), 2) AS DOUBLE) AS total_sales,
    count(order_id) AS total_orders,
    CAST(round(sum(profit), 2) AS DOUBLE) AS total_profit,
    CAST(round(CAST(avg(discount) AS DECIMAL(20,12)), 4) AS DOUBLE) AS avg_discount
  FROM arrivals GROUP BY category, region
)"""

MONTH_SUMS = f"""
    CAST(round(sum(sales), 2) AS DOUBLE) AS total_sales,
    CAST(round(sum(profit), 2) AS DOUBLE) AS total_profit,
    count(order_id) AS total_orders,
    CAST((year - {BASE_YEAR}) * 12 + month AS BIGINT) AS month_index"""

TREND = f"""
dated AS (SELECT * FROM fact_orders JOIN dim_date USING (date_key)),
monthly AS (SELECT year, month, {MONTH_SUMS} FROM dated GROUP BY year, month),
monthly_category AS (
  SELECT category, year, month, {MONTH_SUMS}
  FROM dated LEFT JOIN dim_product USING (product_key) GROUP BY category, year, month
),
monthly_region AS (
  SELECT region, year, month, {MONTH_SUMS}
  FROM dated LEFT JOIN dim_region USING (region_key) GROUP BY region, year, month
),
monthly_arrivals AS (
  SELECT year, month, {MONTH_SUMS}
  FROM (SELECT *, year(order_date) AS year, month(order_date) AS month FROM arrivals) AS a
  GROUP BY year, month
),
monthly_both AS (
  SELECT year, month, month_index,
    round(sum(total_sales), 2) AS total_sales,
    round(sum(total_profit), 2) AS total_profit,
    CAST(sum(total_orders) AS BIGINT) AS total_orders
  FROM (SELECT * FROM monthly UNION ALL SELECT * FROM monthly_arrivals) AS u
  GROUP BY year, month, month_index
)"""


def fit(source: str, group: str = "") -> str:
    columns = ", ".join(
        f"regr_slope({y}, month_index) AS {name}_slope,"
        f" regr_intercept({y}, month_index) AS {name}_intercept,"
        f" regr_r2({y}, month_index) AS {name}_r2"
        for y, name in (("total_sales", "sales"), ("total_profit", "profit"), ("total_orders", "orders"))
    )
    head = f"{group}, " if group else ""
    tail = f"GROUP BY {group} " if group else ""
    return (
        f"SELECT {head}{columns}, count(*) AS months, max(month_index) AS last_index"
        f" FROM {source} {tail}HAVING min(month_index) < max(month_index)"
    )


def fit_table(source: str, group: str = "") -> str:
    columns = ", ".join(
        f"round({n}_slope, 4) AS {n}_slope, round({n}_intercept, 2) AS {n}_intercept"
        for n in ("sales", "profit", "orders")
    )
    head = f"{group}, " if group else ""
    return f"SELECT {head}{columns}, months FROM ({fit(source, group)}) AS m"


INDEX_YEAR = f"CAST(floor((month_index - 1) / 12.0) AS INTEGER) + {BASE_YEAR}"
INDEX_MONTH = "CAST(((month_index - 1) % 12 + 12) % 12 AS INTEGER) + 1"
LABEL = f"strftime(make_date({INDEX_YEAR}, {INDEX_MONTH}, 1), '%b %Y')"


def ahead(source: str) -> str:
    return (
        f"(SELECT m.last + i AS month_index FROM (SELECT max(month_index) AS last FROM {source}) AS m,"
        f" (VALUES (1), (2), (3)) AS h(i)) AS f"
    )


def overall(source: str) -> str:
    return f"""SELECT month_index,
      round(sales_intercept + sales_slope * month_index, 2) AS predicted_sales,
      round(profit_intercept + profit_slope * month_index, 2) AS predicted_profit,
      CAST(round(orders_intercept + orders_slope * month_index, 0) AS INTEGER) AS predicted_orders,
      {INDEX_YEAR} AS year, {INDEX_MONTH} AS month, {LABEL} AS month_name, 'Forecast' AS data_type
    FROM ({fit(source)}) AS m, {ahead(source)}"""


def grouped_forecast(source: str, group: str, data_type: str, measure: str = "sales") -> str:
    return f"""SELECT month_index,
      round({measure}_intercept + {measure}_slope * month_index, 2) AS predicted_{measure},
      {group}, {LABEL} AS month_name, '{data_type}' AS data_type
    FROM ({fit(source, group)}) AS m, {ahead(source)}"""


PREFIX = "WITH " + ",\n".join([
    BRONZE,
    f"prepared AS (SELECT {lines(BATCH_TEXT_COLUMNS)} FROM bronze)",
    f"good AS (SELECT * FROM prepared WHERE {kept(V2)})",
    f"silver AS ({unique_lines('good')})",
    f"silver_one AS ({unique_lines(f'(SELECT * FROM prepared WHERE {kept(V1)})')})",
    f"stream_prepared AS (SELECT {lines(STREAM_TEXT_COLUMNS)} FROM bronze)",
    f"arrivals AS (SELECT * FROM stream_prepared WHERE {kept(STREAM)})",
    STAR,
    TOTALS,
    TREND,
])

DOUBLES = {"sales", "discount", "profit"}


def as_shown(columns: tuple[str, ...] = ORDER_LINE_COLUMNS) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in DOUBLES else c for c in columns)


FACT_COLUMNS = (
    "order_id", "ship_mode", "date_key", "customer_key", "product_key", "region_key",
    "sales", "quantity", "discount", "profit",
)


def rule_report(source: str) -> str:
    rules = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {broken(keep)}) AS violations FROM {source}"
        for name, keep in V2.items()
    )
    duplicates = f"""SELECT 'duplicate_key' AS rule, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS violations
      FROM (SELECT count(*) AS n FROM {source} WHERE order_id IS NOT NULL AND product_id IS NOT NULL
            GROUP BY order_id, product_id) AS k"""
    return f"SELECT rule, violations, violations = 0 AS passed FROM ({rules} UNION ALL {duplicates}) AS r"


# What a raw line loses when it is typed, in the order of its columns.
FLAWS = {}
for _column, _cast in CASTS.items():
    FLAWS[f"unreadable_{_column}"] = f"trim({_column}) <> '' AND {_cast} IS NULL"
    if _column in ("sales", "discount", "profit"):
        FLAWS[f"not_exact_{_column}"] = f"TRY_CAST({_column} AS DECIMAL(38,18)) <> {_cast}"


def flaw_list() -> str:
    parts = ", ".join(f"CASE WHEN {lost} THEN '{name}' END" for name, lost in FLAWS.items())
    return f"concat_ws(',', {parts})"


def flaw_report() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {lost}) AS violations,"
        f" count(*) FILTER (WHERE {lost}) = 0 AS passed FROM bronze"
        for name, lost in FLAWS.items()
    )


def quarantine(trim_columns: tuple[str, ...], rules: Rules) -> str:
    return f"""SELECT {as_shown()}, flaws, reject_reason FROM (
        SELECT *, {reason(rules)} AS reject_reason
        FROM (SELECT {lines(trim_columns)}, {flaw_list()} AS flaws FROM bronze) AS t) AS q
      WHERE reject_reason IS NOT NULL OR flaws <> ''"""


def step_counts() -> str:
    names = list(V2)
    removed = " UNION ALL ".join(
        f"SELECT {i} AS step_number, '{n}' AS step,"
        f" (SELECT count(*) FROM prepared WHERE {reason(V2)} = '{n}') AS rows_removed"
        for i, n in enumerate(names, start=1)
    )
    last = (
        f" UNION ALL SELECT {len(names) + 1}, 'duplicate_key',"
        " (SELECT count(*) FROM good) - (SELECT count(*) FROM silver)"
    )
    return f"""SELECT step_number, step, rows_after + rows_removed AS rows_before, rows_removed, rows_after
      FROM (SELECT *, CAST((SELECT count(*) FROM bronze)
              - sum(rows_removed) OVER (ORDER BY step_number) AS BIGINT) AS rows_after
            FROM ({removed}{last}) AS s) AS t"""


def chart(measure: str, dimension: str, *attributes: str) -> str:
    key = dimension.removeprefix("dim_") + "_key"
    names = ", ".join(attributes)
    return (
        f"SELECT {names}, CAST(sum({measure}) AS DOUBLE) AS total_{measure}"
        f" FROM fact_orders LEFT JOIN {dimension} USING ({key}) GROUP BY {names}"
    )


def share(amounts: str, measure: str) -> str:
    return (
        f"SELECT *, round({measure} * 100 / (SELECT sum({measure}) FROM ({amounts}) AS w), 4) AS share_pct"
        f" FROM ({amounts}) AS a"
    )


def leading(amounts: str, measure: str, tie_break: str, n: int, way: str = "DESC") -> str:
    return f"SELECT * FROM ({amounts}) AS a ORDER BY {measure} {way} NULLS LAST, {tie_break} LIMIT {n}"


def top_members(dimension: str, key: str, attributes: str, n: int) -> str:
    return f"""SELECT {attributes}, total_sales FROM (
        SELECT {key}, {attributes}, CAST(sum(sales) AS DOUBLE) AS total_sales
        FROM fact_orders LEFT JOIN {dimension} USING ({key}) WHERE {key} IS NOT NULL GROUP BY {key}, {attributes}
      ) AS m ORDER BY total_sales DESC, {key} LIMIT {n}"""


def row_counts(*layers: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS layer, count(*) AS row_count FROM {n}" for n in layers
    )


STREAM_LINES = f"SELECT {as_shown()}, 'streaming' AS data_source FROM arrivals"
SUBCATEGORY_PROFIT = chart("profit", "dim_product", "sub_category")
ENRICHED = """fact_orders LEFT JOIN dim_date USING (date_key) LEFT JOIN dim_customer USING (customer_key)
  LEFT JOIN dim_product USING (product_key) LEFT JOIN dim_region USING (region_key)"""
ENRICHED_COLUMNS = FACT_COLUMNS + (
    "order_date", "year", "month", "quarter", "day", "month_name", "customer_id", "customer_name",
    "segment", "product_id", "product_name", "category", "sub_category", "region", "state", "city",
)

# Lines of a source with types of its own, and what silver's types lose of each.
TYPED_LINES = """
  SELECT row_id, TRY_CAST(sales AS DOUBLE) / CASE WHEN quantity = '13' THEN 7 ELSE 1 END AS sales,
    CASE quantity WHEN '19' THEN 19.5 WHEN '21' THEN 3e9 ELSE CAST(quantity AS DOUBLE) END AS quantity,
    CASE WHEN quantity <> '5' THEN TRY_CAST(discount AS DOUBLE) END AS discount,
    CASE WHEN quantity <> '7' THEN TRY_CAST(profit AS DOUBLE) END AS profit,
    CAST(ship_date AS DATE) AS ship_date, quantity AS pieces
  FROM bronze"""
TYPED_FLAWS = {
    "unreadable_row_id": None,
    "unreadable_ship_date": None,
    "not_exact_ship_date": "pieces = '3'",
    "unreadable_sales": None,
    "not_exact_sales": "sales <> CAST(CAST(sales AS DECIMAL(24,6)) AS DOUBLE)",
    "unreadable_quantity": "pieces = '21'",
    "not_exact_quantity": "pieces = '19'",
    "unreadable_discount": "pieces = '5'",
    "not_exact_discount": None,
    "unreadable_profit": "pieces = '7'",
    "not_exact_profit": None,
}


def typed_flaws() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {lost or 'false'}) AS violations,"
        f" count(*) FILTER (WHERE {lost or 'false'}) = 0 AS passed FROM ({TYPED_LINES}) AS t"
        for name, lost in TYPED_FLAWS.items()
        if name != "unreadable_row_id"
    )


def typed_quarantine() -> str:
    parts = ", ".join(f"CASE WHEN {lost} THEN '{name}' END" for name, lost in TYPED_FLAWS.items() if lost)
    return f"""SELECT CAST(row_id AS BIGINT) AS row_id, CAST(CAST(sales AS DECIMAL(24,6)) AS DOUBLE) AS sales,
        CASE WHEN pieces <> '21' THEN CAST(floor(quantity) AS INTEGER) END AS quantity, discount, profit, ship_date, flaws
      FROM (SELECT *, concat_ws(',', {parts}) AS flaws FROM ({TYPED_LINES}) AS t) AS q WHERE flaws <> ''"""


# Records of a CSV file: those of three pieces are cut off after the sales, the product of those
# of seven has a comma without quotes, and of those of nine a line feed within quotes.
CSV_RECORD = (
    "concat_ws(',', "
    + ", ".join(f"coalesce({c}, '')" for c in ORDER_LINE_COLUMNS[: ORDER_LINE_COLUMNS.index("product_name")])
    + ", coalesce(product_name, '') || CASE WHEN quantity = '7' THEN ', blue' ELSE '' END, coalesce(sales, '')"
    + ")"
)
CSV_BROKEN = f"""SELECT {CSV_RECORD} || CASE WHEN quantity = '7' THEN
      concat(',', quantity, ',', discount, ',', profit) ELSE '' END AS broken_record,
    'broken_record' AS reject_reason, CAST(NULL AS BIGINT) AS row_id
  FROM bronze WHERE quantity IN ('3', '7')"""
CSV_WHOLE = """SELECT * REPLACE (
    CASE WHEN quantity = '9' THEN product_name || chr(10) || '(new)' ELSE product_name END AS product_name)
  FROM bronze WHERE quantity NOT IN ('3', '7')"""


BODIES = {
    "scan_order_lines": "SELECT * FROM bronze",
    "bronze_rename": "SELECT * FROM bronze",
    "try_parse_date": "SELECT row_id, order_date AS order_date_text,"
    f" {CASTS['order_date']} AS order_date FROM bronze",
    "csv_whole_lines": CSV_WHOLE,
    "csv_broken_lines": CSV_BROKEN,
    "silver_typed": f"SELECT {as_shown()} FROM (SELECT {lines()} FROM bronze) AS t",
    "silver_trim": f"SELECT {lines(BATCH_TEXT_COLUMNS, cast=False)} FROM bronze",
    "silver_not_null": f"SELECT {as_shown()} FROM prepared WHERE order_id IS NOT NULL"
    " AND customer_id IS NOT NULL AND product_id IS NOT NULL AND sales IS NOT NULL",
    "silver_dedup": f"SELECT {as_shown()} FROM ({unique_lines('prepared')}) AS u",
    "silver_v1": f"SELECT {as_shown()} FROM silver_one",
    "silver_v2": f"SELECT {as_shown()} FROM silver",
    "dq_report": f"{rule_report('prepared')} UNION ALL {flaw_report()}",
    "dq_validation_v1": rule_report("silver_one"),
    "dq_validation_v2": rule_report("silver"),
    "dq_checks_passed_v1": "SELECT count(*) FILTER (WHERE passed) AS checks_passed,"
    f" count(*) AS checks_made FROM ({rule_report('silver_one')}) AS r",
    "dq_step_counts": step_counts(),
    "dq_quarantine": quarantine(BATCH_TEXT_COLUMNS, V2),
    "dq_quarantine_stream": quarantine(STREAM_TEXT_COLUMNS, STREAM),
    "dq_typed_flaws": typed_flaws(),
    "dq_typed_quarantine": typed_quarantine(),
    "dq_duplicate_keys": "SELECT order_id, product_id, count(*) AS copies FROM good"
    " GROUP BY order_id, product_id HAVING count(*) > 1",
    "stream_rules": STREAM_LINES,
    "layer_row_counts": row_counts(
        "bronze", "silver", "dim_date", "dim_customer", "dim_product", "dim_region", "fact_orders"
    ),
    "dim_date": "SELECT * FROM dim_date",
    "dim_customer": "SELECT * FROM dim_customer",
    "dim_product": "SELECT * FROM dim_product",
    "dim_region": "SELECT * FROM dim_region",
    "fact_orders": f"SELECT {as_shown(FACT_COLUMNS)} FROM fact_orders",
    "fact_orders_joined": f"SELECT {as_shown(FACT_COLUMNS)} FROM fact_orders",
    "fact_enriched": f"SELECT {as_shown(ENRICHED_COLUMNS)} FROM {ENRICHED}",
    "scd1_customer": f"""SELECT coalesce(b.customer_id, a.customer_id) AS customer_id,
      CASE WHEN a.customer_id IS NULL THEN b.customer_name ELSE a.customer_name END AS customer_name,
      CASE WHEN a.customer_id IS NULL THEN b.segment ELSE a.segment END AS segment,
      {key_of("coalesce(b.customer_id, a.customer_id)")} AS customer_key
    FROM ({newest(f"(SELECT * FROM silver WHERE order_date < DATE '{REFRESH_DAY}') AS s",
                  "customer_id", "customer_name, segment")}) AS b
    FULL JOIN ({newest(f"(SELECT * FROM silver WHERE order_date >= DATE '{REFRESH_DAY}') AS s",
                       "customer_id", "customer_name, segment")}) AS a
      ON a.customer_id = b.customer_id""",
    "kpi_summary": """SELECT total_sales, total_profit, total_orders,
      round(coalesce(total_profit * 100 / nullif(total_sales, 0), 0), 4) AS profit_margin_pct,
      round(coalesce(total_sales / nullif(total_orders, 0), 0), 4) AS avg_order_value,
      total_quantity,
      round(coalesce(discounts * 100 / nullif(n, 0), 0), 4) AS avg_discount_pct
    FROM (SELECT CAST(sum(sales) AS DOUBLE) AS total_sales, CAST(sum(profit) AS DOUBLE) AS total_profit,
        count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_quantity,
        CAST(sum(discount) AS DOUBLE) AS discounts, count(discount) AS n FROM fact_orders) AS k""",
    "kpi_profit": """SELECT CAST(sum(profit) AS DOUBLE) AS total_profit,
      CAST(sum(profit) FILTER (WHERE profit < 0) AS DOUBLE) AS total_loss,
      count(*) FILTER (WHERE profit > 0) AS profitable_orders,
      count(*) FILTER (WHERE profit < 0) AS loss_orders FROM fact_orders""",
    "kpi_customer": """SELECT count(*) AS total_customers,
      count(*) FILTER (WHERE orders > 1) AS repeat_customers,
      round(CAST(sum(sales) AS DOUBLE) / count(*), 4) AS avg_sales_per_customer
    FROM (SELECT customer_key, count(DISTINCT order_id) AS orders, sum(sales) AS sales
          FROM fact_orders GROUP BY customer_key) AS c""",
    "kpi_product": "SELECT count(DISTINCT product_id) AS total_products FROM dim_product",
    "repeat_customers": """SELECT customer_id, customer_name, count(DISTINCT order_id) AS distinct_orders
      FROM fact_orders JOIN dim_customer USING (customer_key)
      GROUP BY customer_id, customer_name HAVING count(DISTINCT order_id) > 1""",
    "sales_by_region": chart("sales", "dim_region", "region"),
    "category_share": share(chart("sales", "dim_product", "category"), "total_sales"),
    "sales_by_month": chart("sales", "dim_date", "month", "month_name"),
    "sales_by_subcategory": chart("sales", "dim_product", "sub_category"),
    "ship_mode_share": share(
        "SELECT ship_mode, CAST(sum(sales) AS DOUBLE) AS total_sales FROM fact_orders GROUP BY ship_mode",
        "total_sales",
    ),
    "sales_by_year": f"""SELECT y.year, y.total_sales,
      round((y.total_sales - b.total_sales) * 100 / nullif(b.total_sales, 0), 4) AS growth_pct
      FROM ({chart("sales", "dim_date", "year")}) AS y
      LEFT JOIN ({chart("sales", "dim_date", "year")}) AS b ON b.year + 1 = y.year""",
    "top_states": leading(chart("sales", "dim_region", "region", "state"), "total_sales", "state", 5),
    "profit_by_subcategory": SUBCATEGORY_PROFIT,
    "most_profitable_subcategories": leading(SUBCATEGORY_PROFIT, "total_profit", "sub_category", 5),
    "least_profitable_subcategories": leading(SUBCATEGORY_PROFIT, "total_profit", "sub_category", 5, "ASC"),
    "profit_by_region": chart("profit", "dim_region", "region"),
    "profit_by_year": chart("profit", "dim_date", "year"),
    "profit_by_category": chart("profit", "dim_product", "category"),
    "sales_by_segment": chart("sales", "dim_customer", "segment"),
    "top_customers": top_members("dim_customer", "customer_key", "customer_id, customer_name", 5),
    "orders_by_year": "SELECT year, count(DISTINCT order_id) AS total_orders"
    " FROM fact_orders LEFT JOIN dim_date USING (date_key) GROUP BY year",
    "segment_profit_share": share(chart("profit", "dim_customer", "segment"), "total_profit"),
    "top_products": top_members("dim_product", "product_key", "product_id, product_name", 5),
    "quantity_by_subcategory": "SELECT sub_category, CAST(sum(quantity) AS BIGINT) AS total_quantity"
    " FROM fact_orders LEFT JOIN dim_product USING (product_key) GROUP BY sub_category",
    "stream_silver": STREAM_LINES,
    "stream_gold": "SELECT * FROM live",
    "gold_category_region": "SELECT * FROM live",
    "distinct_orders_category_region": "SELECT category, region, count(DISTINCT order_id) AS distinct_orders"
    " FROM arrivals GROUP BY category, region",
    "live_totals": "SELECT round(sum(total_sales), 2) AS total_sales,"
    " CAST(sum(total_orders) AS BIGINT) AS total_orders, round(sum(total_profit), 2) AS total_profit FROM live",
    "live_last_updated": "SELECT strftime(CAST(max(order_date) AS TIMESTAMP) + INTERVAL 330 MINUTE,"
    " '%d-%m-%Y %H:%M:%S') AS last_updated_ist FROM arrivals",
    "live_by_category": "SELECT category, round(sum(total_sales), 2) AS total_sales FROM live GROUP BY category",
    "live_by_region_category": "SELECT region, category, round(sum(total_sales), 2) AS total_sales"
    " FROM live GROUP BY region, category",
    "monthly_sales": "SELECT * FROM monthly",
    "monthly_sales_by_category": "SELECT * FROM monthly_category",
    "monthly_sales_by_region": "SELECT * FROM monthly_region",
    "stream_month_total": "SELECT round(sum(total_sales), 2) AS total_sales,"
    " CAST(sum(total_orders) AS BIGINT) AS total_orders, round(sum(total_profit), 2) AS total_profit"
    " FROM monthly_arrivals",
    "monthly_stream": "SELECT * FROM monthly_arrivals",
    "monthly_with_stream": "SELECT * FROM monthly_both",
    "trend_model": fit_table("monthly"),
    "trend_model_by_category": fit_table("monthly_category", "category"),
    "trend_model_by_region": fit_table("monthly_region", "region"),
    "future_months": f"SELECT month_index, {INDEX_YEAR} AS year, {INDEX_MONTH} AS month,"
    f" {LABEL} AS month_name FROM {ahead('monthly')}",
    "forecast_overall": overall("monthly"),
    "forecast_with_stream": overall("monthly_both"),
    "forecast_category": grouped_forecast("monthly_category", "category", "Category Forecast"),
    "forecast_category_profit": grouped_forecast(
        "monthly_category", "category", "Category Forecast", "profit"
    ),
    "forecast_region": grouped_forecast("monthly_region", "region", "Region Forecast"),
    "model_r2": " UNION ALL ".join(
        [
            f"SELECT 'overall' AS kind, 'all' AS name, '{m}' AS measure, round({m}_r2, 6) AS r2, months"
            f" FROM ({fit('monthly')}) AS m"
            for m in ("sales", "profit", "orders")
        ]
        + [
            f"SELECT '{g}', {g}, 'sales', round(sales_r2, 6), months FROM ({fit(f'monthly_{g}', g)}) AS m"
            for g in ("category", "region")
        ]
    ),
    "forecast_rank": " UNION ALL ".join(
        f"SELECT '{g}' AS kind, {g} AS name, month_index, predicted_sales,"
        f" row_number() OVER (PARTITION BY month_index ORDER BY predicted_sales DESC, {g}) AS sales_rank"
        f" FROM ({grouped_forecast(f'monthly_{g}', g, '')}) AS f"
        for g in ("category", "region")
    ),
}

# Every key of the fact, over a customer dimension whose known keys come from elsewhere.
BODIES["fact_keys_resolved"] = """SELECT * FROM (VALUES ('dim_date', CAST(0 AS BIGINT)),
    ('dim_customer', CAST(0 AS BIGINT)), ('dim_product', CAST(0 AS BIGINT)), ('dim_region', CAST(0 AS BIGINT)))
    AS t(dimension, unresolved_lines)"""

ORACLES = {name: f"{PREFIX}\n{body}" for name, body in BODIES.items()}
ORACLES["last_event_ist"] = (
    "SELECT strftime(max(ts) + INTERVAL 330 MINUTE, '%d-%m-%Y %H:%M:%S') AS last_updated_ist FROM events"
)
