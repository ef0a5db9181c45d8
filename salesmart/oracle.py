"""The registered queries as SQL for an independent engine (DuckDB).

Written from the models' definitions, not from the Spark code: percentages and averages
are worked out in whole cents with integer division, which has no rounding to differ in.
"""

from salesmart.operators.calendar import CALENDAR_END, CALENDAR_START, HOLIDAYS
from salesmart.operators.quality import DECLARED
from salesmart.functions.keys import NULL_MARKER
from salesmart import registry
from salesmart.sources import synth


def pct(part: str, whole: str) -> str:
    """part / whole * 100 at two places, half up; whole > 0. Both are whole numbers."""
    return (
        f"(sign({part}) * ((20000 * abs({part}) + ({whole})) // (2 * ({whole}))))"
        "::DOUBLE / 100.0"
    )


def cents(amount: str) -> str:
    return f"CAST(({amount}) * 100 AS HUGEINT)"


def avg6(total: str, rows: str) -> str:
    """total / rows at six places, half up; total > 0, in units of a cent."""
    return (
        f"((2 * {cents(total)} * 10000 + ({rows})) // (2 * ({rows})))::DOUBLE / 1000000.0"
    )


def key(*columns: str) -> str:
    parts = " || '-' || ".join(
        f"coalesce(CAST({c} AS VARCHAR), '{NULL_MARKER}')" for c in columns
    )
    return f"md5({parts})"


HOLIDAY_LIST = ", ".join(f"DATE '{d}'" for d in HOLIDAYS)
PRICE = """CAST(CAST(p_retailprice AS DECIMAL(10,2))
    * CAST(CASE p_size % 3 WHEN 0 THEN 0.1 WHEN 1 THEN 1.0 ELSE 2.0 END AS DECIMAL(2,1))
    AS DECIMAL(10,2))"""
STAMP = "TIMESTAMP '2001-01-01 00:00:00'"
AS_OF = f"DATE '{registry.AS_OF}'"


def calendar(days: str) -> str:
    """Calendar columns over a relation ``days(d)``."""
    return f"""
  SELECT {key('d')} AS date_key, d AS full_date,
    CAST(extract(year FROM d) AS INTEGER) AS "year",
    CAST(extract(quarter FROM d) AS INTEGER) AS quarter,
    CAST(extract(month FROM d) AS INTEGER) AS "month",
    CAST(extract(day FROM d) AS INTEGER) AS "day",
    CAST(extract(dow FROM d) + 1 AS INTEGER) AS day_of_week,
    CAST(extract(week FROM d) AS INTEGER) AS week_of_year,
    strftime(d, '%a') AS day_name, strftime(d, '%b') AS month_name,
    extract(dow FROM d) IN (0, 6) AS is_weekend,
    d IN ({HOLIDAY_LIST}) AS is_holiday,
    'Q' || extract(quarter FROM d) || ' ' || extract(year FROM d) AS quarter_name,
    strftime(d, '%b') || ' ' || extract(year FROM d) AS month_year
  FROM ({days})"""


def day_range(first: str, end: str) -> str:
    return f"SELECT CAST(unnest(range({first}, {end}, INTERVAL 1 DAY)) AS DATE) AS d"


def literal_days(end) -> str:
    return day_range(f"TIMESTAMP '{CALENDAR_START}'", f"TIMESTAMP '{end}'")


def monthly(period: str, where: str = "true") -> str:
    return f"""
  SELECT {period}, count(DISTINCT order_id) AS total_orders,
    count(DISTINCT customer_key) AS unique_customers, sum(total_amount) AS total_revenue,
    sum(profit_amount) AS total_profit, count(total_amount) AS n,
    CAST(sum(quantity) AS BIGINT) AS total_quantity_sold
  FROM fact_orders JOIN dim_dates USING (date_key) WHERE {where} GROUP BY {period}"""


def report(totals: str, period: str, order: str) -> str:
    """Margin and growth over a relation of monthly() columns."""
    revenue, profit = cents("total_revenue"), cents("total_profit")
    return f"""
  SELECT {period}, total_orders, unique_customers,
    CAST(total_revenue AS DOUBLE) AS total_revenue,
    CAST(total_profit AS DOUBLE) AS total_profit,
    {pct(profit, revenue)} AS profit_margin_pct,
    {avg6('total_revenue', 'n')} AS avg_order_value, total_quantity_sold,
    CASE WHEN before > 0 THEN {pct(cents('total_revenue - before'), cents('before'))}
      END AS revenue_growth_pct,
    CASE WHEN orders_before > 0
      THEN {pct('CAST(total_orders - orders_before AS HUGEINT)', 'orders_before')}
      END AS order_growth_pct
  FROM (SELECT *, lag(total_revenue) OVER (ORDER BY {order}) AS before,
          lag(total_orders) OVER (ORDER BY {order}) AS orders_before FROM {totals})"""


# Named relations; each may use those before it.
RELATIONS = {
    "customers": f"""
  SELECT c_custkey AS customer_id, ' customer ' AS first_name,
    ' n' || substr(c_name, 10) || ' ' AS last_name,
    ' ' || replace(c_name, '#', '.') || '@Example.COM ' AS email,
    CAST(c_custkey AS VARCHAR) AS phone, CAST(c_custkey AS VARCHAR) AS address_line_1,
    CAST(NULL AS VARCHAR) AS address_line_2, n_name AS city, r_name AS state,
    n_name AS country, CAST(c_custkey AS VARCHAR) AS postal_code,
    DATE '1995-01-01' + CAST((c_custkey * 37) % 2400 AS INTEGER) AS registration_date,
    CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS customer_segment,
    c_acctbal >= 0 AS is_active, {STAMP} AS created_at, {STAMP} AS updated_at
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey""",
    "products": f"""
  SELECT product_id, product_name, category, subcategory, brand, supplier, unit_price,
    CAST(unit_price * CAST(CASE size % 4 WHEN 0 THEN 0.4 WHEN 1 THEN 0.6 WHEN 2 THEN 0.7
      ELSE 0.8 END AS DECIMAL(2,1)) AS DECIMAL(10,2)) AS cost_price,
    description, is_active, {STAMP} AS created_at, {STAMP} AS updated_at
  FROM (SELECT p_partkey AS product_id, ' ' || p_name || ' ' AS product_name,
      ' ' || lower(p_type) || ' ' AS category, CAST(p_size AS VARCHAR) AS subcategory,
      ' ' || lower(p_brand) || ' ' AS brand, ' Supplier' || (p_partkey % 4) AS supplier,
      {PRICE} AS unit_price, p_size AS size, p_name AS description,
      p_size % 10 <> 0 AS is_active FROM part)""",
    "orders_": f"""
  SELECT order_id, customer_id, product_id, order_date, quantity, unit_price,
    nullif(discount, 0) AS discount_amount, nullif(tax, 0) AS tax_amount,
    CAST(quantity * unit_price - discount + tax AS DECIMAL(10,2)) AS total_amount,
    order_status, payment_method, shipping_address, stamp AS created_at,
    stamp AS updated_at
  FROM (SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
      CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate END AS order_date,
      CAST(l_quantity AS INTEGER) AS quantity, unit_price,
      CAST(CAST(l_discount AS DECIMAL(4,2)) * CAST(l_quantity AS DECIMAL(6,0)) * unit_price
        AS DECIMAL(10,2)) AS discount,
      CAST(CAST(l_tax AS DECIMAL(4,2)) * CAST(l_quantity AS DECIMAL(6,0)) * unit_price
        AS DECIMAL(10,2)) AS tax,
      CASE o_orderstatus WHEN 'F' THEN 'DELIVERED'
        WHEN 'O' THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'COMPLETED' ELSE 'SHIPPED' END
        WHEN 'P' THEN CASE o_orderpriority WHEN '5-LOW' THEN 'CANCELLED' ELSE 'PENDING' END
        END AS order_status,
      CASE l_linenumber % 4 WHEN 0 THEN 'CREDIT_CARD' WHEN 1 THEN 'DEBIT_CARD'
        WHEN 2 THEN 'PAYPAL' ELSE 'BANK_TRANSFER' END AS payment_method,
      CAST(o_custkey AS VARCHAR) AS shipping_address, o_orderdate AS stamp
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN (SELECT p_partkey, {PRICE} AS unit_price FROM part) ON l_partkey = p_partkey)""",
    "stg_customers": f"""
  SELECT {key('customer_id')} AS customer_key, * EXCLUDE (is_active)
    REPLACE (upper(trim(first_name)) AS first_name, upper(trim(last_name)) AS last_name,
      lower(trim(email)) AS email, coalesce(customer_segment, 'UNKNOWN') AS customer_segment)
  FROM customers WHERE is_active""",
    "stg_products": f"""
  SELECT {key('product_id')} AS product_key, * EXCLUDE (is_active)
    REPLACE (trim(product_name) AS product_name, upper(trim(category)) AS category,
      upper(trim(subcategory)) AS subcategory, upper(trim(brand)) AS brand,
      trim(supplier) AS supplier),
    {pct(cents('unit_price - cost_price'), cents('unit_price'))} AS profit_margin_pct
  FROM products WHERE is_active""",
    "stg_orders": f"""
  SELECT {key('order_id', 'product_id')} AS order_key, *
    REPLACE (CAST(order_date AS DATE) AS order_date,
      coalesce(discount_amount, 0) AS discount_amount, coalesce(tax_amount, 0) AS tax_amount)
  FROM orders_ WHERE order_status IN ('COMPLETED', 'SHIPPED', 'DELIVERED')""",
    "dim_customers": f"""
  SELECT *, first_name || ' ' || last_name AS full_name,
    CASE WHEN date_diff('day', registration_date, {AS_OF}) <= 90 THEN 'NEW'
      WHEN date_diff('day', registration_date, {AS_OF}) <= 365 THEN 'RECENT'
      ELSE 'ESTABLISHED' END AS customer_tenure
  FROM stg_customers""",
    "dim_products": """
  SELECT *, CASE WHEN profit_margin_pct >= 50 THEN 'HIGH' WHEN profit_margin_pct >= 25
      THEN 'MEDIUM' ELSE 'LOW' END AS profit_margin_tier,
    CASE WHEN unit_price >= 1000 THEN 'PREMIUM' WHEN unit_price >= 100 THEN 'MID-RANGE'
      ELSE 'BUDGET' END AS price_tier
  FROM stg_products""",
    "dim_dates": calendar(literal_days(CALENDAR_END)),
    "fact_orders": f"""
  SELECT order_key, customer_key, product_key, order_id, quantity, unit_price,
    discount_amount, tax_amount, total_amount, gross AS gross_amount,
    gross - discount_amount AS net_amount, cost AS total_cost,
    total_amount - cost AS profit_amount,
    CASE WHEN cost > 0 THEN {pct(cents('total_amount - cost'), cents('cost'))} ELSE 0.0 END
      AS profit_margin_pct,
    order_status, payment_method, created_at,
    coalesce(matched, (SELECT date_key FROM dim_dates WHERE full_date = DATE '1900-01-01'))
      AS date_key,
    CASE WHEN matched IS NULL THEN 1 ELSE 0 END AS missing_date_flag
  FROM (SELECT o.*, c.customer_key, p.product_key, d.date_key AS matched,
      CAST(o.quantity * o.unit_price AS DECIMAL(18,2)) AS gross,
      CAST(o.quantity * coalesce(p.cost_price, 0) AS DECIMAL(18,2)) AS cost
    FROM stg_orders o LEFT JOIN dim_customers c ON o.customer_id = c.customer_id
      LEFT JOIN dim_products p ON o.product_id = p.product_id
      LEFT JOIN dim_dates d ON o.order_date = d.full_date)""",
    "by_month": monthly('"year", "month", month_name'),
    "revenue_analysis": report("by_month", '"year", "month", month_name', '"year", "month"'),
    "customer_value": """
  SELECT customer_key, full_name, customer_segment, customer_tenure, lifetime_revenue,
    lifetime_profit, orders
  FROM dim_customers JOIN (SELECT customer_key, sum(total_amount) AS lifetime_revenue,
      sum(profit_amount) AS lifetime_profit, count(DISTINCT order_id) AS orders
    FROM fact_orders GROUP BY customer_key) USING (customer_key)""",
    "named_orders": """
  SELECT order_id, product_id, first_name, last_name, customer_segment, product_name,
    category, total_amount, order_date
  FROM orders_ JOIN customers USING (customer_id) JOIN products USING (product_id)""",
    "changes": f"""
  SELECT * REPLACE (true AS is_active) FROM customers WHERE NOT is_active
  UNION ALL BY NAME
  SELECT s_suppkey + {registry.NEW_CUSTOMER_BASE} AS customer_id, s_name AS first_name,
    'supplier' AS last_name, s_name || '@example.com' AS email, 'USA' AS country,
    {AS_OF} AS registration_date, 'REGULAR' AS customer_segment, true AS is_active,
    CAST({AS_OF} AS TIMESTAMP) AS created_at, CAST({AS_OF} AS TIMESTAMP) AS updated_at
  FROM supplier""",
}

_BASES = {
    "customers": (), "products": (), "orders_": (), "stg_customers": ("customers",),
    "stg_products": ("products",), "stg_orders": ("orders_",),
    "dim_customers": ("stg_customers",), "dim_products": ("stg_products",), "dim_dates": (),
    "fact_orders": ("stg_orders", "dim_customers", "dim_products", "dim_dates"),
    "by_month": ("fact_orders", "dim_dates"), "revenue_analysis": ("by_month",),
    "customer_value": ("fact_orders", "dim_customers"),
    "named_orders": ("orders_", "customers", "products"), "changes": ("customers",),
}


def over(bases: str, select: str) -> str:
    """``select`` with the named relations it reads, and those they read, before it."""
    needed, todo = set(), bases.split()
    while todo:
        name = todo.pop()
        needed.add(name)
        todo.extend(_BASES[name])
    ctes = ",\n".join(f"{n} AS ({body})" for n, body in RELATIONS.items() if n in needed)
    return f"WITH {ctes}\n{select}"


_MONEY = (
    "unit_price", "cost_price", "discount_amount", "tax_amount", "total_amount",
    "gross_amount", "net_amount", "total_cost", "profit_amount", "lifetime_revenue",
    "lifetime_profit", "total_revenue", "total_profit", "profit_margin_pct", "prev_revenue",
)
_TEXT = (
    "order_date", "registration_date", "created_at", "updated_at", "full_date", "first_day",
    "last_day", "max_loaded_at", "snapshotted_at", "date_day",
)


def plain(columns: str) -> str:
    """The columns, amounts as doubles and dates and times as text."""
    def item(c: str) -> str:
        if c in _MONEY:
            return f"CAST({c} AS DOUBLE) AS {c}"
        if c in _TEXT:
            return f"CAST({c} AS VARCHAR) AS {c}"
        return f'"{c}"'

    return ", ".join(item(c) for c in columns.split())


CUSTOMER = (
    "customer_id first_name last_name email phone address_line_1 address_line_2 city state "
    "country postal_code registration_date customer_segment"
)
STAMPS = "created_at updated_at"
PRODUCT = "product_id product_name category subcategory brand supplier unit_price cost_price"
ORDER = (
    "order_id customer_id product_id order_date quantity unit_price discount_amount "
    "tax_amount total_amount order_status payment_method shipping_address"
)
FACT = (
    "order_key customer_key product_key date_key order_id quantity unit_price "
    "discount_amount tax_amount total_amount gross_amount net_amount total_cost "
    "profit_amount profit_margin_pct order_status payment_method created_at "
    "missing_date_flag"
)
DATES = (
    "date_key full_date year quarter month day day_of_week week_of_year day_name month_name "
    "is_weekend is_holiday quarter_name month_year"
)
SAMPLE = (
    "first_name last_name customer_segment product_name category total_amount order_date"
)


def everything(relation: str, columns: str) -> str:
    return over(relation, f"SELECT {plain(columns)} FROM {relation}")


# Checks --------------------------------------------------------------------------------

_SOURCE_NAMES = {"orders": "orders_"}


def _relation(table: str) -> str:
    return _SOURCE_NAMES.get(table, table)


def _failures(check) -> str:
    table, column = _relation(check.table), check.column
    if check.kind == "not_null":
        return f"(SELECT count(*) FROM {table} WHERE {column} IS NULL)"
    if check.kind == "unique":
        return (
            f"(SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
            f"GROUP BY {column} HAVING count(*) > 1))"
        )
    return (
        f"(SELECT count(*) FROM {table} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {_relation(check.parent)} p WHERE p.{check.parent_key} = c.{column}))"
    )


def suite() -> str:
    rows = "\nUNION ALL ".join(
        f"SELECT '{c.name}' AS check_name, '{c.kind}' AS kind, '{c.table}' AS table_name, "
        f"'{c.column}' AS column_name, {_failures(c)} AS failures"
        for c in DECLARED
    )
    bases = " ".join(dict.fromkeys(_relation(c.table) for c in DECLARED))
    return over(bases, f"SELECT *, failures = 0 AS passed FROM ({rows})")


def counts() -> str:
    layers = {
        "source": ("customers", "products", "orders"),
        "staging": ("stg_customers", "stg_products", "stg_orders"),
        "core": ("dim_customers", "dim_products", "dim_dates", "fact_orders"),
        "finance": ("revenue_analysis",),
    }
    names = [(layer, n) for layer, tables in layers.items() for n in tables]
    rows = "\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{n}' AS table_name, count(*) AS row_count "
        f"FROM {_relation(n)}"
        for layer, n in names
    )
    bases = " ".join(_relation(n) for _, n in names)
    return over(bases, f"SELECT *, row_count = 0 AS is_empty FROM ({rows})")


def repeated(column: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, CAST({column} AS VARCHAR) AS value, "
        f"count(*) AS occurrences FROM stg_orders WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1"
    )


def age(table: str) -> str:
    now = f"TIMESTAMP '{registry.AS_OF_TIME}'"
    seconds = f"date_diff('second', max(updated_at), {now})"
    return (
        f"SELECT '{table}' AS table_name, CAST(max(updated_at) AS VARCHAR) AS max_loaded_at, "
        f"CAST({now} AS VARCHAR) AS snapshotted_at, {seconds} AS age_seconds, "
        f"CASE WHEN {seconds} <= 86400 THEN 'pass' WHEN {seconds} <= 2592000 THEN 'warn' "
        f"ELSE 'error' END AS status FROM {_relation(table)}"
    )


def orphans(child: str, parent: str, column: str) -> str:
    return over(f"{child} {parent}", f"""
SELECT c.{column}, count(*) AS fact_records,
  CAST(max(CASE WHEN p.{column} IS NULL THEN 1 ELSE 0 END) AS INTEGER) AS missing_dim
FROM {child} c LEFT JOIN {parent} p ON c.{column} = p.{column}
GROUP BY c.{column} HAVING max(CASE WHEN p.{column} IS NULL THEN 1 ELSE 0 END) = 1""")


def null_counts(relation: str, columns: str) -> str:
    return over(relation, "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS failures "
        f"FROM {relation}" for c in columns.split()
    ))


# Generated data ------------------------------------------------------------------------


def draw(column: str, number: int, bound: str | int) -> str:
    block, part = divmod(number, 4)
    digest = f"md5({column} || '-{registry.SEED}-{block}')"
    return f"(CAST('0x' || substr({digest}, {1 + 8 * part}, 8) AS BIGINT) % ({bound}))"


def pick(column: str, number: int, values) -> str:
    choices = ", ".join(f"'{v}'" for v in values)
    return f"([{choices}])[{draw(column, number, len(values))} + 1]"


def generated_customers() -> str:
    first = pick("id", 0, synth.FIRST_NAMES)
    last = pick("id", 1, synth.LAST_NAMES)
    back = draw("id", 8, synth.HISTORY_DAYS + 1)
    return f"""
SELECT id AS customer_id, {first} AS first_name, {last} AS last_name,
  lower({first}) || '.' || lower({last}) || '.' || id || '@example.com' AS email,
  '555-' || lpad(CAST({draw("id", 2, 10_000_000)} AS VARCHAR), 7, '0') AS phone,
  ({draw("id", 3, 9999)} + 1) || ' ' || {pick("id", 4, synth.STREETS)} AS address_line_1,
  CAST(NULL AS VARCHAR) AS address_line_2, {pick("id", 5, synth.CITIES)} AS city,
  {pick("id", 6, synth.STATES)} AS state, 'USA' AS country,
  lpad(CAST({draw("id", 7, 100_000)} AS VARCHAR), 5, '0') AS postal_code,
  CAST({AS_OF} - CAST({back} AS INTEGER) AS VARCHAR) AS registration_date,
  {pick("id", 9, synth.SEGMENTS)} AS customer_segment, true AS is_active
FROM (SELECT c_custkey AS id FROM customer)"""


def generated_products() -> str:
    categories = tuple(synth.CATEGORIES)
    cases = " ".join(
        f"WHEN '{c}' THEN {pick('id', 1, subs)}" for c, subs in synth.CATEGORIES.items()
    )
    name = f"{pick('id', 6, synth.ADJECTIVES)} || ' ' || {pick('id', 7, synth.NOUNS)}"
    return f"""
SELECT id AS product_id, product_name, category, CASE category {cases} END AS subcategory,
  brand, supplier,
  ((cost * markup + 500) // 1000)::DOUBLE / 100.0 AS unit_price,
  cost::DOUBLE / 100.0 AS cost_price,
  'A ' || lower(product_name) || ' for every day.' AS description, true AS is_active
FROM (SELECT id, {name} AS product_name, {pick("id", 0, categories)} AS category,
    {pick("id", 4, synth.BRANDS)} AS brand, {pick("id", 5, synth.SUPPLIERS)} AS supplier,
    {draw("id", 2, synth.MAX_COST_CENTS - synth.MIN_COST_CENTS + 1)}
      + {synth.MIN_COST_CENTS} AS cost,
    {draw("id", 3, synth.MAX_MARKUP_MILLI - synth.MIN_MARKUP_MILLI + 1)}
      + {synth.MIN_MARKUP_MILLI} AS markup
  FROM (SELECT p_partkey AS id FROM part))"""


def generated_orders() -> str:
    people, goods = "(SELECT count(*) FROM customers)", "(SELECT count(*) FROM products)"
    seconds = draw("id", 3, synth.HISTORY_DAYS * 86_400)
    return over("customers products", f"""
SELECT id AS order_id, customer_id, product_id,
  CAST(CAST({AS_OF} AS TIMESTAMP) - to_seconds({seconds}) AS VARCHAR) AS order_date,
  CAST(quantity AS INTEGER) AS quantity, price::DOUBLE / 100.0 AS unit_price,
  discount::DOUBLE / 100.0 AS discount_amount, tax::DOUBLE / 100.0 AS tax_amount,
  (gross - discount + tax)::DOUBLE / 100.0 AS total_amount,
  {pick("id", 5, synth.STATUSES)} AS order_status,
  {pick("id", 6, synth.PAYMENTS)} AS payment_method,
  ({draw("id", 7, 9999)} + 1) || ' ' || {pick("id", 8, synth.STREETS)} AS shipping_address
FROM (SELECT *, (gross * rate + 5000) // 10000 AS discount, (gross * 8 + 50) // 100 AS tax
  FROM (SELECT id, customer_id, product_id, price, {draw("id", 2, 5)} + 1 AS quantity,
      price * ({draw("id", 2, 5)} + 1) AS gross, {draw("id", 4, 2001)} AS rate
    FROM (SELECT o_orderkey AS id FROM orders)
      JOIN (SELECT customer_id, row_number() OVER (ORDER BY customer_id) - 1 AS place
            FROM customers) w ON w.place = {draw("id", 0, people)}
      JOIN (SELECT product_id, {cents('unit_price')} AS price,
              row_number() OVER (ORDER BY product_id) - 1 AS place
            FROM products) p ON p.place = {draw("id", 1, goods)}))""")


def oracle_sql() -> dict[str, str]:
    months = '"year", "month"'
    quarterly = over("fact_orders", report(
        f"({monthly(chr(34) + 'year' + chr(34) + ', quarter, quarter_name')})",
        '"year", quarter, quarter_name', '"year", quarter'))
    return {
        "stg_customers": everything("stg_customers", f"customer_key {CUSTOMER} {STAMPS}"),
        "stg_products": everything(
            "stg_products", f"product_key {PRODUCT} profit_margin_pct description {STAMPS}"),
        "stg_orders": everything("stg_orders", f"order_key {ORDER} {STAMPS}"),
        "dim_customers": everything(
            "dim_customers",
            f"customer_key {CUSTOMER} full_name customer_tenure {STAMPS}"),
        "dim_products": everything(
            "dim_products",
            f"product_key {PRODUCT} profit_margin_pct profit_margin_tier price_tier "
            f"description {STAMPS}"),
        "fact_orders": everything("fact_orders", FACT),
        # The batch of changed orders, in the definition of the orders themselves.
        "incremental_fact": everything("fact_orders", FACT)
        .replace("ELSE 'SHIPPED' END", "ELSE 'CANCELLED' END")
        .replace("ELSE 'PENDING' END", "ELSE 'COMPLETED' END"),
        # The copy lacks ids of 101, has those of 103 once more and wrong totals in those of 97.
        "reconciliation": over("orders_", """
SELECT order_id, count(*) AS source_rows,
  sum(CASE WHEN order_id % 101 = 0 THEN 0 ELSE 1 END
    + CASE WHEN order_id % 103 = 0 THEN 1 ELSE 0 END)::BIGINT AS target_rows,
  CASE WHEN order_id % 103 = 0 AND order_id % 101 <> 0
      OR order_id % 101 = 0 AND order_id % 103 <> 0 THEN 'customer_id,order_date,quantity,total_amount'
    ELSE 'total_amount' END AS differs_in
FROM orders_
WHERE order_id % 101 = 0 AND order_id % 103 <> 0 OR order_id % 101 <> 0 AND order_id % 103 = 0
   OR order_id % 101 <> 0 AND order_id % 97 = 0
GROUP BY order_id"""),
        # What states of ranges merge to is what the fact itself gives.
        "rollup_months": over("revenue_analysis", "SELECT * FROM revenue_analysis"),
        "rollup_quarters": quarterly,
        "load_counts": over("customers products orders_", " UNION ALL ".join(
            f"SELECT 'landing' AS layer, '{n}' AS table_name, count(*) AS row_count, "
            f"count(*) = 0 AS is_empty FROM {n if n != 'orders' else 'orders_'}"
            for n in ("customers", "products", "orders"))),
        "revenue_analysis": over("revenue_analysis", "SELECT * FROM revenue_analysis"),
        "date_spine": "SELECT CAST(d AS VARCHAR) AS date_day FROM (" + day_range(
            "min(CAST(o_orderdate AS DATE))::TIMESTAMP",
            "max(CAST(o_orderdate AS DATE))::TIMESTAMP + INTERVAL 1 DAY") + " FROM orders)",
        "dim_dates": f"SELECT {plain(DATES)} FROM (" + calendar(day_range(
            f"least(TIMESTAMP '{CALENDAR_START}', min(date_trunc('day', o_orderdate)))",
            f"greatest(TIMESTAMP '{CALENDAR_END}', "
            "max(date_trunc('day', o_orderdate)) + INTERVAL 1 DAY)") + " FROM orders") + ")",
        "monthly_distinct": over(
            "by_month",
            f"SELECT {months}, total_orders, unique_customers FROM by_month"),
        "monthly_sums": over("by_month", f"""
SELECT {months}, CAST(total_revenue AS DOUBLE) AS total_revenue,
  CAST(total_profit AS DOUBLE) AS total_profit,
  {avg6('total_revenue', 'n')} AS avg_order_value, total_quantity_sold FROM by_month"""),
        "month_lag": over("by_month", f"""
SELECT {months}, CAST(total_revenue AS DOUBLE) AS total_revenue, total_orders,
  CAST(lag(total_revenue) OVER (ORDER BY {months}) AS DOUBLE) AS prev_revenue,
  lag(total_orders) OVER (ORDER BY {months}) AS prev_orders FROM by_month"""),
        "revenue_without_fallback": over("fact_orders", report(
            f"({monthly(months + ', month_name', 'missing_date_flag = 0')})",
            months + ", month_name", months)),
        "quarterly_revenue": quarterly,
        "order_volume": over("revenue_analysis", f"""
SELECT {months}, total_orders, avg_order_value, order_growth_pct FROM revenue_analysis"""),
        "customer_value": everything(
            "customer_value",
            "customer_key full_name customer_segment customer_tenure lifetime_revenue "
            "lifetime_profit orders"),
        "segment_value": over("customer_value", f"""
SELECT customer_segment, customer_tenure, count(*) AS customers,
  CAST(sum(lifetime_revenue) AS DOUBLE) AS lifetime_revenue,
  CAST(sum(lifetime_profit) AS DOUBLE) AS lifetime_profit,
  CAST(sum(orders) AS BIGINT) AS orders,
  {avg6('sum(lifetime_revenue)', 'count(*)')} AS revenue_per_customer
FROM customer_value GROUP BY customer_segment, customer_tenure"""),
        "margin_by_tier": over("fact_orders dim_products", f"""
SELECT price_tier, profit_margin_tier, count(DISTINCT f.product_key) AS products,
  count(*) AS order_rows, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
  CAST(sum(profit_amount) AS DOUBLE) AS total_profit,
  {pct(cents('sum(profit_amount)'), cents('sum(total_amount)'))} AS profit_margin_pct
FROM fact_orders f JOIN dim_products p ON f.product_key = p.product_key
GROUP BY price_tier, profit_margin_tier"""),
        "star_sample_full": over("named_orders", "SELECT " + ", ".join(
            f"CAST({c} AS VARCHAR) AS {c}" for c in SAMPLE.split()) + " FROM named_orders"),
        "recent_orders": over("named_orders", """
SELECT first_name || ' ' || last_name AS customer_name, product_name,
  CAST(total_amount AS DOUBLE) AS total_amount,
  CAST(CAST(order_date AS DATE) AS VARCHAR) AS order_date
FROM named_orders ORDER BY named_orders.order_date DESC NULLS FIRST, order_id DESC,
  product_id DESC, named_orders.total_amount DESC LIMIT 5"""),
        "sample_orders": over("named_orders", f"""
SELECT {plain(SAMPLE)} FROM (SELECT * FROM named_orders ORDER BY order_id, product_id,
  total_amount, order_date NULLS FIRST LIMIT 5)"""),
        "sample_facts": over("fact_orders", """
SELECT order_key, customer_key, product_key, quantity, CAST(total_amount AS DOUBLE)
  AS total_amount
FROM fact_orders ORDER BY order_key, customer_key NULLS FIRST, product_key NULLS FIRST,
  quantity, fact_orders.total_amount LIMIT 5"""),
        "latest_months": over("revenue_analysis", f"""
SELECT {months}, month_name, total_revenue, total_orders, avg_order_value
FROM revenue_analysis ORDER BY "year" DESC, "month" DESC LIMIT 5"""),
        "latest_year": over("revenue_analysis", f"""
SELECT {months}, month_name, total_revenue, total_orders, avg_order_value
FROM revenue_analysis ORDER BY "year" DESC, "month" DESC LIMIT 12"""),
        "missing_dates": over("stg_orders", f"""
SELECT DISTINCT CAST(order_date AS VARCHAR) AS order_date FROM stg_orders
WHERE order_date NOT IN ({literal_days(registry.SHORT_CALENDAR_END)})"""),
        "date_coverage": over("orders_ dim_dates", """
SELECT 'orders' AS table_name, CAST(min(CAST(order_date AS DATE)) AS VARCHAR) AS first_day,
  CAST(max(CAST(order_date AS DATE)) AS VARCHAR) AS last_day FROM orders_
UNION ALL SELECT 'dim_dates', CAST(min(full_date) AS VARCHAR),
  CAST(max(full_date) AS VARCHAR) FROM dim_dates"""),
        "orphan_keys": orphans("stg_orders", "dim_customers", "customer_id"),
        "orphan_fact_keys": orphans("fact_orders", "dim_customers", "customer_key"),
        "duplicate_keys": over("orders_", """
SELECT order_id, product_id, count(*) AS occurrences FROM orders_
GROUP BY order_id, product_id HAVING count(*) > 1"""),
        "row_counts": counts(),
        "check_unique": over("stg_orders", "\nUNION ALL ".join(
            repeated(c) for c in ("order_key", "order_id", "customer_id"))),
        "check_not_null": null_counts("orders_", f"{ORDER} {STAMPS}"),
        "check_relationship": over("orders_ dim_products", """
SELECT product_id AS value, count(*) AS failures FROM orders_
WHERE product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM dim_products)
GROUP BY product_id"""),
        "check_suite": suite(),
        "freshness": over("orders_ customers", age("orders") + "\nUNION ALL " + age("customers")),
        "landing_read": """
SELECT o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY", o_orderstatus AS "O_ORDERSTATUS",
  o_totalprice AS "O_TOTALPRICE", CAST(o_orderdate AS VARCHAR) AS "O_ORDERDATE",
  o_orderpriority AS "O_ORDERPRIORITY" FROM orders""",
        "conform": everything("orders_", f"{ORDER} {STAMPS}"),
        "fill_defaults": over("orders_", f"""
SELECT {plain(f"{ORDER} {STAMPS}")} FROM (SELECT * REPLACE (1 AS quantity,
  0.00 AS discount_amount, 'PENDING' AS order_status, 'CREDIT_CARD' AS payment_method)
  FROM orders_)"""),
        "truncate_to": over("products", f"""
SELECT {plain(f"{PRODUCT} description is_active {STAMPS}")} FROM (SELECT * REPLACE (
  substr(product_name, 1, 8) AS product_name, substr(category, 1, 5) AS category,
  substr(description, 1, 6) AS description) FROM products)"""),
        "upsert": over("changes", f"""
SELECT {plain(f"{CUSTOMER} is_active {STAMPS}")} FROM (SELECT * FROM changes
UNION ALL BY NAME SELECT * FROM customers c
WHERE NOT EXISTS (SELECT 1 FROM changes x WHERE x.customer_id = c.customer_id))"""),
        "touch_updated_at": over("changes", f"""
SELECT {plain(f"{CUSTOMER} is_active {STAMPS}")} FROM (SELECT * REPLACE (
  CASE WHEN customer_id IN (SELECT customer_id FROM customers)
    THEN TIMESTAMP '{registry.TOUCHED}' ELSE updated_at END AS updated_at) FROM changes)"""),
        "latest_changes": over("orders_", f"""
SELECT {plain(f"{ORDER} {STAMPS}")} FROM (SELECT *, row_number() OVER (
    PARTITION BY order_id, product_id ORDER BY updated_at DESC, customer_id DESC,
    order_date DESC NULLS LAST, quantity DESC, unit_price DESC,
    discount_amount DESC NULLS LAST, tax_amount DESC NULLS LAST, total_amount DESC,
    order_status DESC, payment_method DESC) AS place FROM orders_) WHERE place = 1"""),
        # Later, earlier and deleting changes of three sets of customers.
        "ordered_merge": over("orders_", f"""
SELECT {plain(f"{ORDER} {STAMPS}")} FROM (SELECT *, row_number() OVER (
    PARTITION BY order_id, product_id ORDER BY updated_at DESC, is_deleted DESC, customer_id DESC,
    order_date DESC NULLS LAST, quantity DESC, unit_price DESC,
    discount_amount DESC NULLS LAST, tax_amount DESC NULLS LAST, total_amount DESC,
    order_status DESC, payment_method DESC) AS place FROM (
  SELECT *, false AS is_deleted FROM orders_
  UNION ALL SELECT * REPLACE (updated_at + INTERVAL 10 DAY AS updated_at, 'COMPLETED' AS order_status),
    false FROM orders_ WHERE customer_id % 5 = 0
  UNION ALL SELECT * REPLACE (updated_at + INTERVAL 7 DAY AS updated_at), true
    FROM orders_ WHERE customer_id % 7 = 0
  UNION ALL SELECT * REPLACE (updated_at + INTERVAL 5 DAY AS updated_at, 'CANCELLED' AS order_status),
    false FROM orders_ WHERE customer_id % 3 = 0)) WHERE place = 1 AND NOT is_deleted"""),
        "synth_customers": generated_customers(),
        "synth_products": generated_products(),
        "synth_orders": generated_orders(),
    }
