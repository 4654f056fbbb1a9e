"""SQL views of the star over the given tables, shared by the checking queries."""

AS_OF = "DATE '2001-07-31'"

_CALENDAR = """dim_date AS (
  SELECT *,
    holiday_name IS NOT NULL AS is_holiday,
    NOT is_weekend AND holiday_name IS NULL AS is_business_day,
    full_date = DATE '2001-07-31' AS is_current_day,
    week_of_year = 31 AND year_number = 2001 AS is_current_week,
    month_number = 7 AND year_number = 2001 AS is_current_month,
    quarter_number = 3 AND year_number = 2001 AS is_current_quarter,
    year_number = 2001 AS is_current_year
  FROM (SELECT
    CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
    d AS full_date,
    CAST(dayofweek(d) AS INTEGER) AS day_of_week,
    strftime(d, '%a') AS day_name,
    strftime(d, '%a') AS day_short_name,
    CAST(day(d) AS INTEGER) AS day_of_month,
    CAST(dayofyear(d) AS INTEGER) AS day_of_year,
    CAST(weekofyear(d) AS INTEGER) AS week_of_year,
    CAST(d - CAST((dayofweek(d) + 6) % 7 AS INTEGER) AS DATE) AS week_start_date,
    CAST(d - CAST((dayofweek(d) + 6) % 7 AS INTEGER) + 6 AS DATE) AS week_end_date,
    CAST(month(d) AS INTEGER) AS month_number,
    strftime(d, '%b') AS month_name,
    strftime(d, '%b') AS month_short_name,
    make_date(year(d), month(d), 1) AS month_start_date,
    last_day(d) AS month_end_date,
    CAST(quarter(d) AS INTEGER) AS quarter_number,
    'Q' || quarter(d) AS quarter_name,
    CAST(year(d) AS INTEGER) AS year_number,
    CAST(CASE WHEN month(d) >= 7 THEN year(d) + 1 ELSE year(d) END AS INTEGER) AS fiscal_year,
    CAST(CASE quarter(d) WHEN 3 THEN 1 WHEN 4 THEN 2 WHEN 1 THEN 3 ELSE 4 END AS INTEGER) AS fiscal_quarter,
    'FQ' || CASE quarter(d) WHEN 3 THEN 1 WHEN 4 THEN 2 WHEN 1 THEN 3 ELSE 4 END AS fiscal_quarter_name,
    dayofweek(d) IN (0, 6) AS is_weekend,
    CASE
      WHEN month(d) = 1 AND day(d) = 1 THEN 'New Year''s Day'
      WHEN month(d) = 7 AND day(d) = 4 THEN 'Independence Day'
      WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas Day'
      WHEN month(d) = 11 AND dayofweek(d) = 4 AND day(d) BETWEEN 22 AND 28 THEN 'Thanksgiving'
      WHEN month(d) = 5 AND dayofweek(d) = 1 AND day(d) >= 25 THEN 'Memorial Day'
      WHEN month(d) = 9 AND dayofweek(d) = 1 AND day(d) <= 7 THEN 'Labor Day'
    END AS holiday_name
  FROM (SELECT CAST(DATE '1995-01-01' + CAST(i AS INTEGER) AS DATE) AS d FROM range(2557) t(i)))
)"""

_PLACES = """places AS (
  SELECT n_nationkey, n_name AS place, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_LINES = """fact_lines AS (
  SELECT *, CAST(gross_amount - discount_amount AS DECIMAL(12,2)) AS net_amount
  FROM (SELECT
    l_orderkey AS order_id, l_linenumber AS order_line_id, l_partkey AS product_key, l_suppkey AS store_key,
    CAST(l_quantity AS INTEGER) AS quantity,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS gross_amount,
    CAST(CAST(l_discount + 0.0 AS DECIMAL(5,2)) * 100 AS DECIMAL(5,2)) AS discount_percent,
    CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount + 0.0 AS DECIMAL(5,2)), 2) AS DECIMAL(12,2))
      AS discount_amount,
    l_shipdate AS load_timestamp
  FROM lineitem)
)"""

_SALES = """fact_sales AS (
  SELECT f.*, o_custkey AS customer_key, o_orderdate AS transaction_timestamp,
    CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
    o_orderpriority AS payment_method, o_orderstatus AS order_status,
    CAST((CAST(gross_amount * 100 AS BIGINT) * 2 + quantity) // NULLIF(2 * quantity, 0) AS DECIMAL(12,0))
      * CAST(0.01 AS DECIMAL(3,2)) AS unit_price
  FROM fact_lines f LEFT JOIN orders ON order_id = o_orderkey
)"""

_STORE = """dim_store AS (
  SELECT s_suppkey AS store_key, 'STORE-' || s_suppkey AS store_id, s_name AS store_name,
    CASE WHEN s_acctbal >= 5000 THEN 'WAREHOUSE' WHEN s_acctbal >= 0 THEN 'RETAIL' ELSE 'OUTLET' END AS store_type,
    place AS city, place AS state, region,
    CAST(FLOOR(ABS(s_acctbal)) AS INTEGER) AS square_footage,
    CAST(DATE '1990-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS DATE) AS open_date,
    s_acctbal > -500 AS is_active
  FROM supplier JOIN places ON s_nationkey = n_nationkey
)"""

_PRODUCT = """dim_product AS (
  SELECT *, CASE WHEN unit_price > 0
      THEN CAST(ROUND((unit_price - unit_cost) / unit_price * 100, 2) AS DECIMAL(5,2)) ELSE 0 END AS profit_margin
  FROM (SELECT p_partkey AS product_key, 'PROD-' || p_partkey AS product_id, p_name AS product_name,
    p_type AS category, 'SIZE-' || CAST(FLOOR(p_size / 10) AS INTEGER) AS subcategory, p_brand AS brand,
    CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
    CAST(ROUND(CAST(p_retailprice AS DECIMAL(10,2)) * CAST((50 + (p_size % 10) * 6) / 100.0 AS DECIMAL(5,2)), 2)
      AS DECIMAL(10,2)) AS unit_cost,
    p_size <= 45 AS is_active
  FROM part)
)"""

_CUSTOMER = """dim_customer AS (
  SELECT *, CASE WHEN loyalty_points >= 40000 THEN 'PLATINUM' WHEN loyalty_points >= 20000 THEN 'GOLD'
      WHEN loyalty_points >= 10000 THEN 'SILVER' ELSE 'BRONZE' END AS loyalty_tier
  FROM (SELECT c_custkey AS customer_key, 'CUST-' || c_custkey AS customer_id, c_name AS full_name,
    CASE WHEN c_custkey % 50 = 0 THEN NULL
      WHEN c_custkey % 37 = 0 THEN lower(replace(c_name, '#', '.'))
      ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
    '555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
    CAST(DATE '1940-01-01' + CAST((c_custkey * 37) % 20000 AS INTEGER) AS DATE) AS date_of_birth,
    CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS registration_date,
    c_mktsegment AS customer_segment,
    CAST(FLOOR(c_acctbal * 5) AS INTEGER) AS loyalty_points,
    place AS city, place AS state, region,
    DATE '1994-01-01' AS effective_date, CAST(NULL AS DATE) AS end_date, TRUE AS is_current
  FROM customer JOIN places ON c_nationkey = n_nationkey)
)"""

_VERSIONS = """customer_old AS (
  SELECT 'CUST-' || c_custkey AS customer_id, c_custkey, c_name, c_nationkey,
    CAST(c_acctbal AS DECIMAL(12,2)) AS balance, c_mktsegment AS segment
  FROM customer
), customer_new AS (
  SELECT customer_id, c_custkey, c_name, c_nationkey, balance,
    CASE WHEN c_custkey % 10 = 0 THEN segment || '_PLUS' ELSE segment END AS segment
  FROM customer_old WHERE c_custkey % 97 <> 0
  UNION ALL
  SELECT 'CUST-' || (c_custkey + 1000000000), c_custkey + 1000000000, c_name, c_nationkey, balance, segment
  FROM customer_old WHERE c_custkey % 40 = 0
)"""

STAR = "WITH " + ",\n".join(
    (_CALENDAR, _PLACES, _LINES, _SALES, _STORE, _PRODUCT, _CUSTOMER, _VERSIONS)
) + "\n"


def star(body: str) -> str:
    """``body`` over the star views; a body that starts with a comma adds views first."""
    text = body.strip()
    return STAR + (", " + text[1:].strip() if text.startswith(",") else text)


def mean(value: str, scale: int = 2, divisor: str | None = None) -> str:
    """Half-up mean of a non-negative decimal, in whole numbers: AVG is a double here and breaks ties downwards."""
    unit, count = 10 ** scale, divisor or f"COUNT({value})"
    return (f"CAST((CAST(SUM({value}) * {unit} AS HUGEINT) * 2 + {count}) // NULLIF(2 * {count}, 0) AS DOUBLE)"
            f" / {unit}")
