"""Explicit schemas of the three layers (bronze, silver, gold).

Business keys are ``LongType`` everywhere; validity dates are ``DateType``;
order dates are ``TimestampNTZType`` (wall-clock, no zone).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
TS, NTZ, DT = T.TimestampType(), T.TimestampNTZType(), T.DateType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw business columns after name normalisation, in source order.
BRONZE_BUSINESS_COLUMNS = [
    "PRODUCTKEY", "PRODUCT_NAME", "BRAND", "COLOR", "SUBCATEGORY", "CATEGORY",
    "CUSTOMERKEY", "CUSTOMER_CODE", "NAME", "EDUCATION", "OCCUPATION",
    "CONTINENT", "CITY", "STATE", "COUNTRYREGION", "ORDERDATE", "QUANTITY",
    "NET_PRICE",
]

# Free-text attributes that get the punctuation / strip / "Not Provided" treatment.
BRONZE_TEXT_COLUMNS = [
    "PRODUCT_NAME", "BRAND", "COLOR", "SUBCATEGORY", "CATEGORY", "CUSTOMER_CODE",
    "NAME", "EDUCATION", "OCCUPATION", "CONTINENT", "CITY", "STATE",
    "COUNTRYREGION",
]

# Bronze keeps every scalar as its text; typing happens in silver.
BRONZE = _struct(*[(c, S) for c in BRONZE_BUSINESS_COLUMNS], ("INGESTION_DATE", TS))

SILVER_RENAMES = {
    "CUSTOMERKEY": "CUSTOMER_KEY",
    "ORDERDATE": "ORDER_DATE",
    "COUNTRYREGION": "COUNTRY_REGION",
}

SILVER = _struct(
    ("PRODUCTKEY", L), ("PRODUCT_NAME", S), ("BRAND", S), ("COLOR", S),
    ("SUBCATEGORY", S), ("CATEGORY", S), ("CUSTOMER_KEY", L), ("CUSTOMER_CODE", S),
    ("NAME", S), ("EDUCATION", S), ("OCCUPATION", S), ("CONTINENT", S), ("CITY", S),
    ("STATE", S), ("COUNTRY_REGION", S), ("ORDER_DATE", NTZ), ("QUANTITY", L),
    ("NET_PRICE", L), ("INGESTION_DATE", TS), ("TRANSFORMED_DATE", TS),
)

DIM_PRODUCT = _struct(
    ("product_key", L), ("product_number", L), ("product_description", S),
    ("color", S), ("brand", S), ("subcategory", S), ("category", S),
    ("unit_price", D), ("change_begin_date", DT), ("change_end_date", DT),
    ("is_current", I),
)

DIM_CUSTOMER = _struct(
    ("customer_key", L), ("customer_number", L), ("customer_code", S),
    ("name", S), ("education", S), ("occupation", S),
)

DIM_LOCATION = _struct(
    ("location_key", L), ("continent", S), ("country_region", S), ("state", S),
    ("city", S),
)

DIM_DATE = _struct(
    ("date_key", I), ("date", DT), ("full_date_description", S), ("day", I),
    ("month", I), ("year", I), ("quarter", I), ("week_number", I),
    ("is_holiday", I), ("is_weekday", I),
)

DIM_YEAR = T.StructType([
    T.StructField("YEAR_KEY", I, True),
    T.StructField("YEAR", I, False),
])

FACT_SALES = _struct(
    ("transaction_key", L), ("product_key", L), ("customer_key", L),
    ("location_key", L), ("date_key", I), ("quantity", L), ("net_price", D),
    ("total_amount", D),
)

FACT_FORECAST = _struct(
    ("country_region", S), ("brand", S), ("forecast", D), ("year", I),
)

FACT_ACTUAL_AGG = _struct(
    ("country_region", S), ("brand", S), ("year", I), ("total_actual_sales", D),
)

# Raw forecast records as they arrive (camelCase keys).
FORECAST_SOURCE = _struct(
    ("countryRegion", S), ("brand", S), ("year", I), ("forecast", D),
)

# Table name -> schema, in the order the layers are created.
LAYERS = {
    "bronze": {"bronze_sales": BRONZE},
    "silver": {"silver_sales": SILVER},
    "gold": {
        "gold_dim_product": DIM_PRODUCT,
        "gold_dim_customer": DIM_CUSTOMER,
        "gold_dim_location": DIM_LOCATION,
        "gold_dim_date": DIM_DATE,
        "gold_dim_year": DIM_YEAR,
        "gold_fact_sales": FACT_SALES,
        "gold_forecast": FACT_FORECAST,
        "gold_actual_sales_agg_fact": FACT_ACTUAL_AGG,
    },
}

# Primary keys that the gold tables declare (checked, not enforced by storage).
PRIMARY_KEYS = {
    "gold_dim_product": ["product_key"],
    "gold_dim_customer": ["customer_key"],
    "gold_dim_location": ["location_key"],
    "gold_dim_date": ["date_key"],
    "gold_dim_year": ["YEAR_KEY"],
    "gold_fact_sales": ["transaction_key"],
    "gold_forecast": ["country_region", "brand", "year"],
    "gold_actual_sales_agg_fact": ["country_region", "brand", "year"],
}
