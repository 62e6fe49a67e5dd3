"""DuckDB SQL for every registered query: an independent statement of
the same semantics over the driver's tables (pre-registered views).

Each layer is a named CTE; ``compose`` pulls in the CTEs a query needs in
dependency order.  Parameters mirror ``starloom.plans.context``.
"""

from __future__ import annotations

from starloom.plans.context import (
    BATCH_CUT, DUPLICATE_EVERY, FIXTURE_DATE_END, FIXTURE_DATE_START,
    FORECAST_BEFORE_YEAR, FORECAST_FACTOR, RETAIL_PRICE_EVERY,
)

_PUNCT = "'[,;?()]'"


def _clean(c: str) -> str:
    t = f"trim(regexp_replace({c}, {_PUNCT}, ' ', 'g'))"
    return f"CASE WHEN {c} IS NULL OR {t} = '' THEN 'Not Provided' ELSE {t} END"


RAW_BASE = f"""
SELECT
  CAST(p.p_partkey AS VARCHAR) AS PRODUCTKEY,
  p.p_name AS PRODUCT_NAME,
  p.p_brand AS BRAND,
  split_part(p.p_name, ' ', 1) AS COLOR,
  p.p_type AS SUBCATEGORY,
  CASE WHEN p.p_size <= 16 THEN 'Small' WHEN p.p_size <= 33 THEN 'Medium' ELSE 'Large' END AS CATEGORY,
  CAST(c.c_custkey AS VARCHAR) AS CUSTOMERKEY,
  c.c_name AS CUSTOMER_CODE,
  concat(' ', c.c_name, ', (', c.c_mktsegment, ');') AS NAME,
  CASE WHEN c.c_custkey % 7 = 0 THEN '  ' WHEN c.c_custkey % 11 = 0 THEN NULL ELSE c.c_mktsegment END AS EDUCATION,
  CASE WHEN c.c_acctbal < 0 THEN NULL WHEN c.c_acctbal < 5000 THEN 'Manual?' ELSE 'Professional' END AS OCCUPATION,
  r.r_name AS CONTINENT,
  concat(n.n_name, '_C', CAST(c.c_custkey % 10 AS VARCHAR)) AS CITY,
  concat(n.n_name, '_S', CAST(c.c_custkey % 5 AS VARCHAR)) AS STATE,
  n.n_name AS COUNTRYREGION,
  strftime(o.o_orderdate, '%Y-%m-%d') AS ORDERDATE,
  CAST(l.l_quantity AS VARCHAR) AS QUANTITY,
  CASE WHEN p.p_partkey % {RETAIL_PRICE_EVERY} = 0 THEN p.p_retailprice
       ELSE l.l_extendedprice / l.l_quantity END AS NET_PRICE_D,
  l.l_orderkey
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey
"""

# raw rows with the price still as a double (text form differs by engine)
RAW = f"""
SELECT * EXCLUDE (l_orderkey) FROM raw_base
UNION ALL
SELECT * EXCLUDE (l_orderkey) FROM raw_base WHERE l_orderkey % {DUPLICATE_EVERY} = 0
"""

DEDUP = "SELECT DISTINCT * FROM raw"

SILVER = f"""
SELECT
  TRY_CAST(trim(PRODUCTKEY) AS BIGINT) AS PRODUCTKEY,
  {_clean('PRODUCT_NAME')} AS PRODUCT_NAME,
  {_clean('BRAND')} AS BRAND,
  {_clean('COLOR')} AS COLOR,
  {_clean('SUBCATEGORY')} AS SUBCATEGORY,
  {_clean('CATEGORY')} AS CATEGORY,
  TRY_CAST(trim(CUSTOMERKEY) AS BIGINT) AS CUSTOMER_KEY,
  {_clean('CUSTOMER_CODE')} AS CUSTOMER_CODE,
  {_clean('NAME')} AS NAME,
  {_clean('EDUCATION')} AS EDUCATION,
  {_clean('OCCUPATION')} AS OCCUPATION,
  {_clean('CONTINENT')} AS CONTINENT,
  {_clean('CITY')} AS CITY,
  {_clean('STATE')} AS STATE,
  {_clean('COUNTRYREGION')} AS COUNTRY_REGION,
  try_strptime(trim(regexp_replace(ORDERDATE, {_PUNCT}, ' ', 'g')),
               ['%Y-%m-%d', '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S']) AS ORDER_DATE,
  CAST(TRY_CAST(trim(QUANTITY) AS DOUBLE) AS BIGINT) AS QUANTITY,
  CAST(round_even(NET_PRICE_D, 0) AS BIGINT) AS NET_PRICE
FROM dedup
"""


def _date_dim(start_sql: str, end_sql: str) -> str:
    return f"""
SELECT
  CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
  d AS date,
  strftime(d, '%A, %d %B %Y') AS full_date_description,
  CAST(day(d) AS INTEGER) AS day,
  CAST(month(d) AS INTEGER) AS month,
  CAST(year(d) AS INTEGER) AS year,
  CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(weekofyear(d) AS INTEGER) AS week_number,
  0 AS is_holiday,
  CASE WHEN isodow(d) <= 5 THEN 1 ELSE 0 END AS is_weekday
FROM (SELECT CAST(unnest(generate_series({start_sql}, {end_sql}, INTERVAL 1 DAY)) AS DATE) AS d)
"""


DDIM = _date_dim(f"DATE '{FIXTURE_DATE_START}'", f"DATE '{FIXTURE_DATE_END}'")
CAL = _date_dim("(SELECT CAST(min(o_orderdate) AS DATE) FROM orders)",
                "(SELECT CAST(max(o_orderdate) AS DATE) FROM orders)")

LOC = """
SELECT CAST(row_number() OVER (ORDER BY CONTINENT, COUNTRY_REGION, CITY, STATE) AS BIGINT) AS location_key,
       CONTINENT AS continent, COUNTRY_REGION AS country_region, STATE AS state, CITY AS city
FROM (SELECT DISTINCT CONTINENT, COUNTRY_REGION, CITY, STATE FROM silver)
UNION ALL SELECT -1, 'Unknown', 'Unknown', 'Unknown', 'Unknown'
"""

CUST = """
SELECT CAST(row_number() OVER (ORDER BY CUSTOMER_KEY NULLS FIRST, CUSTOMER_CODE, NAME, EDUCATION, OCCUPATION) AS BIGINT) AS customer_key,
       CUSTOMER_KEY AS customer_number, CUSTOMER_CODE AS customer_code, NAME AS name,
       EDUCATION AS education, OCCUPATION AS occupation
FROM (SELECT DISTINCT CUSTOMER_KEY, CUSTOMER_CODE, NAME, EDUCATION, OCCUPATION FROM silver)
UNION ALL SELECT -1, NULL, NULL, 'Unknown', 'Unknown', 'Unknown'
"""

_PORDER = ("product_number, product_description, color, brand, subcategory, category, "
           "unit_price NULLS FIRST")


def _versions(src: str) -> str:
    return f"""
SELECT PRODUCTKEY AS product_number, PRODUCT_NAME AS product_description, COLOR AS color,
       BRAND AS brand, SUBCATEGORY AS subcategory, CATEGORY AS category,
       CAST(max(NET_PRICE) AS DOUBLE) AS unit_price, max(ORDER_DATE) AS last_order_date
FROM {src} WHERE PRODUCTKEY IS NOT NULL
GROUP BY PRODUCTKEY, PRODUCT_NAME, COLOR, BRAND, SUBCATEGORY, CATEGORY
"""


def _first_day(src: str) -> str:
    return f"(SELECT coalesce(min(CAST(ORDER_DATE AS DATE)), DATE '1900-01-01') FROM {src})"


def _product_initial(src: str) -> str:
    return f"""
SELECT CAST(row_number() OVER (ORDER BY {_PORDER}) AS BIGINT) AS product_key,
       product_number, product_description, color, brand, subcategory, category, unit_price,
       {_first_day(src)} AS change_begin_date, DATE '9999-12-31' AS change_end_date, 1 AS is_current
FROM ({_versions(src)})
UNION ALL SELECT -1, NULL, 'Unknown', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 1
"""


PROD = _product_initial("silver")

FACT = f"""
SELECT CAST(row_number() OVER (ORDER BY ORDER_DATE NULLS FIRST, product_key, customer_key,
         location_key, quantity NULLS FIRST, net_price NULLS FIRST) AS BIGINT) AS transaction_key,
       product_key, customer_key, location_key, date_key, quantity, net_price, total_amount
FROM (
  SELECT s.ORDER_DATE,
         coalesce(p.product_key, -1) AS product_key,
         coalesce(c.customer_key, -1) AS customer_key,
         coalesce(l.location_key, -1) AS location_key,
         CAST(coalesce(d.date_key, -1) AS INTEGER) AS date_key,
         s.QUANTITY AS quantity,
         CAST(s.NET_PRICE AS DOUBLE) AS net_price,
         CAST(s.QUANTITY AS DOUBLE) * CAST(s.NET_PRICE AS DOUBLE) AS total_amount
  FROM silver s
  LEFT JOIN prod p ON s.PRODUCTKEY = p.product_number
       AND s.ORDER_DATE >= p.change_begin_date AND s.ORDER_DATE < p.change_end_date
  LEFT JOIN cust c ON s.CUSTOMER_CODE = c.customer_code
  LEFT JOIN loc l ON s.CONTINENT = l.continent AND s.COUNTRY_REGION = l.country_region
       AND s.CITY = l.city AND s.STATE = l.state
  LEFT JOIN ddim d ON CAST(d.date AS TIMESTAMP) = s.ORDER_DATE
)
"""

AGG = """
SELECT l.country_region, p.brand, d.year, sum(f.total_amount) AS total_actual_sales
FROM fact f
LEFT JOIN prod p ON f.product_key = p.product_key
LEFT JOIN loc l ON f.location_key = l.location_key
LEFT JOIN ddim d ON f.date_key = d.date_key
GROUP BY l.country_region, p.brand, d.year
"""

SILVER_B1 = f"SELECT * FROM silver WHERE ORDER_DATE < TIMESTAMP '{BATCH_CUT}' OR ORDER_DATE IS NULL"
SILVER_B2 = f"SELECT * FROM silver WHERE ORDER_DATE >= TIMESTAMP '{BATCH_CUT}'"
PROD_B1 = _product_initial("silver_b1")

SRC_B2 = f"""
SELECT product_number, product_description, color, brand, subcategory, category, unit_price
FROM (
  SELECT *, row_number() OVER (PARTITION BY product_number ORDER BY last_order_date DESC NULLS LAST,
         product_description DESC, color DESC, brand DESC, subcategory DESC, category DESC,
         unit_price DESC NULLS LAST) AS rn
  FROM ({_versions('silver_b2')})
) WHERE rn = 1
"""

_EQ = " AND ".join(f"c.{x} IS NOT DISTINCT FROM s.{x}" for x in
                   ["product_description", "color", "brand", "subcategory", "category", "unit_price"])

MERGE_JOIN = f"""
SELECT c.*, s.product_number AS s_product_number, s.product_description AS s_product_description,
       s.color AS s_color, s.brand AS s_brand, s.subcategory AS s_subcategory,
       s.category AS s_category, s.unit_price AS s_unit_price,
       c.product_key IS NOT NULL AS has_cur, s.product_number IS NOT NULL AS has_src,
       coalesce(c.product_key IS NOT NULL AND {_EQ}, false) AS eq
FROM (SELECT * FROM prod_b1 WHERE is_current = 1 AND product_key <> -1 AND product_number IS NOT NULL) c
FULL OUTER JOIN src_b2 s ON c.product_number = s.product_number
"""

PROD_MERGED = f"""
WITH j AS (
  SELECT *, max(CAST(eq AS INTEGER)) OVER (PARTITION BY coalesce(product_number, s_product_number)) = 1 AS any_eq
  FROM merge_join
)
SELECT * FROM prod_b1
WHERE NOT coalesce(is_current = 1 AND product_key <> -1 AND product_number IS NOT NULL, false)
UNION ALL
SELECT product_key, product_number, product_description, color, brand, subcategory, category,
       unit_price, change_begin_date,
       CASE WHEN has_src AND NOT any_eq THEN DATE '{BATCH_CUT}' ELSE change_end_date END,
       CASE WHEN has_src AND NOT any_eq THEN 0 ELSE is_current END
FROM j WHERE has_cur
UNION ALL
SELECT CAST((SELECT greatest(coalesce(max(product_key), 0), 0) FROM prod_b1)
            + row_number() OVER (ORDER BY {_PORDER}) AS BIGINT),
       product_number, product_description, color, brand, subcategory, category, unit_price,
       CASE WHEN has_cur THEN DATE '{BATCH_CUT}' ELSE {_first_day('silver_b2')} END,
       DATE '9999-12-31', 1
FROM (SELECT DISTINCT s_product_number AS product_number, s_product_description AS product_description,
             s_color AS color, s_brand AS brand, s_subcategory AS subcategory,
             s_category AS category, s_unit_price AS unit_price, has_cur
      FROM j WHERE has_src AND NOT any_eq)
"""

FORECAST = f"""
SELECT country_region, brand, total_actual_sales * CAST({FORECAST_FACTOR} AS DOUBLE) AS forecast, year
FROM agg WHERE year < {FORECAST_BEFORE_YEAR}
"""

CTES: dict[str, tuple[list[str], str]] = {
    "raw_base": ([], RAW_BASE),
    "raw": (["raw_base"], RAW),
    "dedup": (["raw"], DEDUP),
    "silver": (["dedup"], SILVER),
    "ddim": ([], DDIM),
    "cal": ([], CAL),
    "loc": (["silver"], LOC),
    "cust": (["silver"], CUST),
    "prod": (["silver"], PROD),
    "fact": (["silver", "prod", "cust", "loc", "ddim"], FACT),
    "agg": (["fact", "prod", "loc", "ddim"], AGG),
    "silver_b1": (["silver"], SILVER_B1),
    "silver_b2": (["silver"], SILVER_B2),
    "prod_b1": (["silver_b1"], PROD_B1),
    "src_b2": (["silver_b2"], SRC_B2),
    "merge_join": (["prod_b1", "src_b2"], MERGE_JOIN),
    "prod_merged": (["merge_join", "prod_b1", "silver_b2"], PROD_MERGED),
    "forecast": (["agg"], FORECAST),
}


def compose(final_sql: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final_sql.strip()
    body = ",\n".join(f"{n} AS (\n{CTES[n][1].strip()}\n)" for n in order)
    return f"WITH {body}\n{final_sql.strip()}"
