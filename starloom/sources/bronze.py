"""Landing raw sales into bronze.

Every scalar is read as its text (``primitivesAsString``) so a malformed
cell never poisons its neighbours; typing happens in silver.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException, SparkRuntimeException as SparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.schemas import BRONZE_BUSINESS_COLUMNS


# Text must survive a CSV round trip unchanged.  Edge whitespace is kept, and
# line breaks and the empty string are written in a percent form, so a record
# is one line (files still split) and NULL alone is an empty field.
_CSV_OPTIONS = {"header": True, "ignoreLeadingWhiteSpace": False,
                "ignoreTrailingWhiteSpace": False, "escape": '"'}
# Percent forms, in the order in which they are written; they are read in reverse.
_CSV_ESCAPES = [("%", "%25"), ("\n", "%0A"), ("\r", "%0D")]
_CSV_EMPTY = "%00"

REJECT_MALFORMED = "malformed_line"
REJECT_UNKNOWN_FIELD = "unknown_field"


def _to_csv(c: Column) -> Column:
    for plain, code in _CSV_ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return F.when(c == "", _CSV_EMPTY).otherwise(c)


def _from_csv(c: Column) -> Column:
    c = F.when(c == _CSV_EMPTY, "").otherwise(c)
    for plain, code in reversed(_CSV_ESCAPES):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def _decoded(df: DataFrame) -> DataFrame:
    return df.select(*[_from_csv(F.col(c)).alias(c) for c in df.columns])


def normalize_name(name: str) -> str:
    """S2, a fixed rule: strip, space -> _, - -> _, upper."""
    return name.strip().replace(" ", "_").replace("-", "_").upper()


def normalize_columns(df: DataFrame) -> DataFrame:
    """S2 on every column; two source names that normalise alike are an error."""
    new = [normalize_name(c) for c in df.columns]
    seen = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both normalise to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def read_sales_json(spark: SparkSession, path: str, lines: bool = True,
                    names: list[str] | None = None) -> DataFrame:
    """A JSON array file (``lines=False``, read whole per file) or a
    JSON-lines folder (``lines=True``, split across tasks).

    Without ``names`` the field names are inferred from all records (one
    extra pass) and nested values are rejected: bronze holds flat records
    only.  With ``names`` (the source field names) there is no inference pass;
    every field is read as text, and a nested value then arrives as its JSON
    text.  A malformed record fails the read; ``split_sales_lines`` sets such
    lines apart instead."""
    reader = (spark.read.option("primitivesAsString", True)
              .option("multiLine", not lines)
              .option("mode", "FAILFAST"))
    if names is not None:
        reader = reader.schema(T.StructType([T.StructField(n, T.StringType(), True)
                                             for n in names]))
    try:
        df = reader.json(path)
    except (AnalysisException, SparkException) as e:  # e.g. keys equal up to case, a malformed record
        raise ValueError(f"unreadable sales records: {e}") from e
    nested = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.StringType)]
    if nested:
        raise ValueError(f"nested values are not accepted in sales records: {nested}")
    return conform_to_bronze(normalize_columns(df))


def split_lines(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """JSON lines as (records of ``schema``, rejects).  A line that is no JSON
    object, has a field outside ``schema`` or a value that isn't of its type
    is rejected with the reason, and never becomes a row of NULLs.  Blank
    lines are skipped, as the JSON reader does."""
    corrupt = "_malformed"
    parsed = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType(), True)])
    lines = spark.read.text(path).filter(F.trim("value") != "").select(
        "value", F.from_json("value", parsed, {"columnNameOfCorruptRecord": corrupt, "mode": "PERMISSIVE",
                                               "primitivesAsString": "true"}).alias("r"),
        F.json_object_keys("value").alias("keys"))
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    reason = F.when(F.col("keys").isNull() | F.col(f"r.{corrupt}").isNotNull(), REJECT_MALFORMED) \
        .when(F.size(F.array_except("keys", known)) > 0, REJECT_UNKNOWN_FIELD)
    flagged = lines.withColumn("reject_reason", reason)
    good = flagged.filter(F.col("reject_reason").isNull()).select(*[F.col(f"r.`{f.name}`").alias(f.name) for f in schema.fields])
    return good, flagged.filter(F.col("reject_reason").isNotNull()).select(F.col("value").alias("line"), "reject_reason")


def split_sales_lines(spark: SparkSession, path: str, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """S1 with a dead letter: (bronze records, rejected lines with reason)."""
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    good, rejects = split_lines(spark, path, schema)
    return conform_to_bronze(normalize_columns(good)), rejects


def read_sales_csv(spark: SparkSession, path: str) -> DataFrame:
    """S11 read side: bronze written as CSV, all columns as text."""
    df = spark.read.options(**_CSV_OPTIONS).option("inferSchema", False).csv(path)
    return conform_to_bronze(normalize_columns(_decoded(df)))


def conform_to_bronze(df: DataFrame) -> DataFrame:
    """Unknown column -> error, missing column -> NULL text, bronze order."""
    present = set(df.columns)
    unknown = present - set(BRONZE_BUSINESS_COLUMNS) - {"INGESTION_DATE"}
    if unknown:
        raise ValueError(f"unknown sales columns: {sorted(unknown)}")
    cols = [F.col(c).cast("string").alias(c) if c in present
            else F.lit(None).cast("string").alias(c) for c in BRONZE_BUSINESS_COLUMNS]
    if "INGESTION_DATE" in present:
        cols.append(F.col("INGESTION_DATE").cast("timestamp").alias("INGESTION_DATE"))
    return df.select(*cols)


def stamp_ingestion(df: DataFrame) -> DataFrame:
    """S3: the ingestion stamp that the bronze table defaults to."""
    return conform_to_bronze(df.drop("INGESTION_DATE")).withColumn(
        "INGESTION_DATE", F.current_timestamp())


def append_bronze(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append one batch to bronze (Parquet, or CSV with header)."""
    out = stamp_ingestion(df)
    if fmt == "csv":
        coded = out.select(*[_to_csv(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in out.dtypes])
        coded.write.mode("append").options(**_CSV_OPTIONS).csv(path)
    else:
        out.write.mode("append").parquet(path)


def read_bronze(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "csv":
        df = spark.read.options(**_CSV_OPTIONS).csv(path)
        return conform_to_bronze(_decoded(df))
    return spark.read.parquet(path)
