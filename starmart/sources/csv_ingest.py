"""CSV ingestion and cleaning: the raw sales file to the staging table (T-1).

Columns are taken by header name as text (only the header is read ahead, no
inference pass), quotes are doubled as in RFC 4180, and values are parsed
with ``try_`` functions: what does not parse becomes NULL in staging and one
row of the rejects table, never a silent loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.params import Params

# The reference CSV's header, in file order, and our snake-case names.
CSV_COLUMNS = (
    ("Row ID", "row_id", T.LongType()),
    ("Order ID", "order_id", T.StringType()),
    ("Order Date", "order_date", T.StringType()),
    ("Ship Date", "ship_date", T.StringType()),
    ("Ship Mode", "ship_mode", T.StringType()),
    ("Customer ID", "customer_id", T.StringType()),
    ("Customer Name", "customer_name", T.StringType()),
    ("Segment", "segment", T.StringType()),
    ("Country/Region", "country", T.StringType()),
    ("City", "city", T.StringType()),
    ("State", "state", T.StringType()),
    ("Postal Code", "postal_code", T.StringType()),
    ("Region", "region", T.StringType()),
    ("Product ID", "product_id", T.StringType()),
    ("Category", "category", T.StringType()),
    ("Sub-Category", "sub_category", T.StringType()),
    ("Product Name", "product_name", T.StringType()),
    ("Sales", "sales", T.DecimalType(18, 4)),
    ("Quantity", "quantity", T.IntegerType()),
    ("Discount", "discount", T.DecimalType(4, 2)),
    ("Profit", "profit", T.DecimalType(18, 4)),
)

RAW_COLUMNS_ORDER = tuple(dst for _, dst, _ in CSV_COLUMNS)

CSV_NAMES = tuple(src for src, _, _ in CSV_COLUMNS)
CORRUPT = "_corrupt_record"  # a line with too few or too many fields
DATE_COLUMNS = ("order_date", "ship_date")

# columns the reference profiles and casts to a categorical type
CATEGORICAL_COLUMNS = ("region", "category", "sub_category", "segment", "ship_mode",
                       "country", "state", "city")

DATE_FORMAT = "d/M/yyyy"  # accepts one- and two-digit days and months


def text_schema(spark: SparkSession, path: str) -> T.StructType:
    """Text columns in the order of the file's own header, and the column for
    corrupt lines.  A missing column is an error, an extra one is read over."""
    names = csv_options(spark.read).csv(path).columns
    missing = [c for c in CSV_NAMES if c not in names]
    if missing:
        raise ValueError(f"the file has no column {', '.join(missing)}")
    return T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])


def csv_options(reader, multi_line: bool = False):
    """RFC 4180: header, doubled quotes; ``multi_line`` for quoted newlines
    (then a file is one task)."""
    return (reader.option("header", True).option("escape", '"').option("multiLine", multi_line)
            .option("mode", "PERMISSIVE").option("columnPruning", False))  # counts a line's fields


def by_name(text: DataFrame) -> DataFrame:
    """PF-1: the reference's columns, by name, in snake case, still text."""
    return text.select(*[F.col(f"`{src}`").alias(dst) for src, dst, _ in CSV_COLUMNS], CORRUPT)


def read_sales_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """IO-1: the raw texts of the file(s).  Every file must have the header
    of the first one; another order raises instead of shifting columns."""
    reader = csv_options(spark.read.schema(text_schema(spark, path)), multi_line)
    return by_name(reader.option("enforceSchema", False)
                   .option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def _parsed(dst: str, typ: T.DataType):
    c = F.trim(F.col(dst))
    if dst in DATE_COLUMNS:
        return F.try_to_date(c, DATE_FORMAT)
    return F.col(dst) if isinstance(typ, T.StringType) else c.try_cast(typ)


def typed(text: DataFrame) -> DataFrame:
    """IO-2: ``dd/mm/yyyy`` dates and numbers; what does not parse is NULL."""
    return text.select(*[_parsed(dst, typ).alias(dst) for _, dst, typ in CSV_COLUMNS])


def rejects(text: DataFrame) -> DataFrame:
    """One row per value that does not parse, and per corrupt line:
    row_id (text), column_name, value."""
    bad = [F.when((F.trim(F.col(dst)) != "") & _parsed(dst, typ).isNull(),
                  F.struct(F.lit(dst).alias("column_name"), F.col(dst).alias("value")))
           for _, dst, typ in CSV_COLUMNS if dst in DATE_COLUMNS or not isinstance(typ, T.StringType)]
    bad.append(F.when(F.col(CORRUPT).isNotNull(),
                      F.struct(F.lit("*").alias("column_name"), F.col(CORRUPT).alias("value"))))
    return (text.select("row_id", F.explode(F.filter(F.array(*bad), lambda x: x.isNotNull())).alias("r"))
            .select("row_id", "r.column_name", "r.value"))


def reject_counts(text: DataFrame) -> DataFrame:
    """Rejected values per column, beside the row count check of the load."""
    return rejects(text).groupBy("column_name").agg(F.count(F.lit(1)).alias("rejects"))


def drop_bad_rows(df: DataFrame, bad_row_ids) -> DataFrame:
    """PF-3 (pandas ``!=``): drop listed row ids; a NULL row id is kept."""
    if not bad_row_ids:
        return df
    return df.where(F.col("row_id").isNull() | ~F.col("row_id").isin(list(bad_row_ids)))


def cast_categoricals(df: DataFrame, cols=CATEGORICAL_COLUMNS) -> DataFrame:
    """PF-13: categorical columns as strings (parquet dictionary-encodes them)."""
    return df.withColumns({c: F.col(c).cast("string") for c in cols if c in df.columns})


def fill_postal_code(df: DataFrame, fill: str) -> DataFrame:
    """PF-8: missing postal codes get the fixed value."""
    return df.withColumn("postal_code", F.coalesce(F.col("postal_code"), F.lit(fill)))


def clean(raw: DataFrame, params: Params) -> DataFrame:
    """T-1: typed raw lines to staging: bad rows out, categoricals, postal fill."""
    df = drop_bad_rows(raw, params.bad_row_ids)
    df = cast_categoricals(df)
    return fill_postal_code(df, params.postal_fill)


def stage_csv(spark: SparkSession, path: str, params: Params) -> DataFrame:
    """CSV file(s) to the staging frame."""
    return clean(typed(read_sales_text(spark, path)), params)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """U-4: the distinct values of one column (profiling)."""
    return df.select(col).distinct()


def export_csv(raw: DataFrame, path: str) -> None:
    """Write raw lines in the reference's CSV layout (its header, ``dd/mm/yyyy``
    dates), packed by gzip: the input format of :func:`stage_csv`."""
    out = []
    for src, dst, typ in CSV_COLUMNS:
        c = F.col(dst)
        if dst in ("order_date", "ship_date"):
            c = F.date_format(c, "dd/MM/yyyy")
        out.append(c.cast("string").alias(src))
    (raw.select(*out).write.mode("overwrite").option("header", True).option("escape", '"')
     .option("compression", "gzip").csv(path))


def export_seeded(raw: DataFrame, path: str) -> str:
    """The lines as CSV with values that a load must reject or carry, every
    so many row ids: a bad date, a bad number, a name with quotes and commas,
    the junk ship mode.  Returns ``path``."""
    out = []
    for src, dst, _ in CSV_COLUMNS:
        c = F.date_format(dst, "dd/MM/yyyy") if dst in DATE_COLUMNS else F.col(dst).cast("string")
        every = {"order_date": (97, "31/2/2018"), "sales": (101, "N/A"), "ship_mode": (83, "sas")}.get(dst)
        if every:
            c = F.when(F.col("row_id") % every[0] == 0, every[1]).otherwise(c)
        if dst == "product_name":
            c = F.when(F.col("row_id") % 89 == 0, F.concat(F.lit('A ", " '), c)).otherwise(c)
        out.append(c.alias(src))
    raw.select(*out).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path
