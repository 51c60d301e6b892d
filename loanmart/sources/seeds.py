"""Typed lookup inputs ("seeds").

The two catalogues are short fixed lists taken as-is from the reference. The
holiday calendar is not copied: it is generated by rule (fixed-date holidays
plus Easter-relative ones) for whatever years a calendar spans, so it is
derived by Spark from the calendar's own date range.

Seeds may also be read from CSV files with an explicit schema
(:func:`read_seed_csv`); header, CRLF line ends and UTF-8 are handled by the
CSV reader. It fails on a wrong row; :func:`split_seed_csv` sets wrong rows
aside with the reason instead.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.functions.calendar import easter_sunday

BUCKET_SCHEMA = T.StructType([
    T.StructField("bucket_code", T.StringType(), False),
    T.StructField("bucket_name", T.StringType(), False),
    T.StructField("dpd_min", T.LongType(), False),
    T.StructField("dpd_max", T.LongType(), False),
    T.StructField("is_delinquent", T.StringType(), False),
    T.StructField("severity_order", T.LongType(), False),
])

PRODUCT_SCHEMA = T.StructType([
    T.StructField("product_code", T.StringType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("product_type", T.StringType(), False),
    T.StructField("risk_tier", T.StringType(), False),
    T.StructField("min_amount_ars", T.DecimalType(18, 2), False),
    T.StructField("max_amount_ars", T.DecimalType(18, 2), False),
    T.StructField("max_term_months", T.LongType(), False),
])

HOLIDAY_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("holiday_name", T.StringType(), False),
    T.StructField("holiday_type", T.StringType(), False),
    T.StructField("is_bank_holiday", T.BooleanType(), False),
])

# --- fixed values (must equal the reference's for equal results) -----------
# Delinquency buckets: code, name, inclusive days-past-due range, delinquent
# flag, severity.
DELINQUENCY_BUCKETS = [
    ("CURRENT", "Al dia", 0, 0, "N", 1),
    ("B1_29", "1-29 dias", 1, 29, "Y", 2),
    ("B30_59", "30-59 dias", 30, 59, "Y", 3),
    ("B60_89", "60-89 dias", 60, 89, "Y", 4),
    ("B90_PLUS", "90+ dias", 90, 179, "Y", 5),
    ("DEFAULT", "Default (WO)", 180, 9999, "Y", 6),
]

# Product catalogue: code, name, type, risk tier, amount limits, max term.
PRODUCTS = [
    ("CREDIT_CARD", "Tarjeta de Credito", "revolving", "medium", 50000, 3000000, 0),
    ("PERSONAL_LOAN", "Prestamo Personal", "installment", "low", 100000, 5000000, 60),
    ("CREDIT_LINE", "Linea de Credito", "revolving", "high", 30000, 1500000, 0),
]

# Holiday rules. Fixed-date national holidays: (month, day, name).
FIXED_HOLIDAYS = [
    (1, 1, "Año Nuevo"),
    (3, 24, "Día Nacional de la Memoria por la Verdad y la Justicia"),
    (4, 2, "Día del Veterano y de los Caídos en la Guerra de Malvinas"),
    (5, 1, "Día del Trabajador"),
    (5, 25, "Día de la Revolución de Mayo"),
    (6, 20, "Día Paso a la Inmortalidad del Gral Belgrano"),
    (7, 9, "Día de la Independencia"),
    (12, 8, "Inmaculada Concepción de María"),
    (12, 25, "Navidad"),
]
# Easter-relative days: (offset from Easter Sunday, name, type, bank holiday).
EASTER_HOLIDAYS = [
    (-48, "Carnaval", "national", True),
    (-47, "Carnaval", "national", True),
    (-3, "Semana Santa (jueves)", "observance", False),
    (-2, "Viernes Santo", "national", True),
]
# National holidays that move to a Monday: from Tuesday or Wednesday to the one before,
# from Thursday or Friday to the one after.
MOVED_HOLIDAYS = [
    (6, 17, "Día Paso a la Inmortalidad del Gral Güemes"),
    (8, 17, "Día Paso a la Inmortalidad del Gral San Martín"),
    (10, 12, "Día del Respeto a la Diversidad Cultural"),
    (11, 20, "Día de la Soberanía Nacional"),
]
# ---------------------------------------------------------------------------

# Lookups are created on the driver from the lists above, so their size is
# known before planning and they can be broadcast without a size probe.
SEED_ROWS = {"buckets": len(DELINQUENCY_BUCKETS), "products": len(PRODUCTS)}


def delinquency_buckets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DELINQUENCY_BUCKETS, BUCKET_SCHEMA)


def products(spark: SparkSession) -> DataFrame:
    rows = [(c, n, t, r, Decimal(lo), Decimal(hi), m) for c, n, t, r, lo, hi, m in PRODUCTS]
    return spark.createDataFrame(rows, PRODUCT_SCHEMA)


def read_seed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a seed CSV with a declared schema (no inference)."""
    return (spark.read.schema(schema)
            .option("header", True).option("encoding", "UTF-8").option("mode", "FAILFAST")
            .csv(path))


SEED_FILES = {"buckets": ("delinquency_buckets", BUCKET_SCHEMA), "products": ("products", PRODUCT_SCHEMA),
              "holidays": ("holidays", HOLIDAY_SCHEMA)}


def read_seed(spark: SparkSession, seed_dir: str, name: str) -> DataFrame:
    """The seed ``name`` of SEED_FILES from its CSV file or folder under ``seed_dir``."""
    file, schema = SEED_FILES[name]
    return read_seed_csv(spark, f"{seed_dir.rstrip('/')}/{file}.csv", schema)


# A condition on the rows of a seed, and the column that identifies them.
SEED_RULES = {"buckets": "dpd_min <= dpd_max", "products": "min_amount_ars <= max_amount_ars", "holidays": None}
SEED_KEYS = {"buckets": "bucket_code", "products": "product_code", "holidays": None}


def split_seed_csv(spark: SparkSession, path: str, schema: T.StructType, rule: str | None = None,
                   key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejects) of a seed CSV read permissively.

    Rejects hold the columns as they stand in the file and a ``reason``: a wrong number of
    columns; or, per column in order, a value that is not of its type or a missing one (empty
    or blank) where the schema wants one; or a broken ``rule``; or a ``key`` that an accepted
    row has already (the least row of a key is accepted). Several reasons are joined by "; ".
    """
    raw = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema.fields], T.StructField("_line", T.StringType())])
    read = (spark.read.schema(raw).option("header", True).option("encoding", "UTF-8")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").csv(path))
    typed, problems = [], []
    for f in schema.fields:
        text = F.trim(F.col(f"raw.{f.name}"))
        value = F.when(text != "", text).try_cast(f.dataType)
        typed.append(value.alias(f.name))
        found = F.when((text != "") & value.isNull(), f"{f.name}: not a {f.dataType.simpleString()}")
        problems.append(found if f.nullable else found.when(F.coalesce(text, F.lit("")) == "", f"{f.name}: missing"))
    line = F.when(F.col("raw._line").isNotNull(), F.array(F.lit("wrong number of columns")))
    rows = read.select(F.struct("*").alias("raw")).select("raw", *typed, line.otherwise(F.array_compact(F.array(*problems))).alias("problems"))
    good = F.size("problems") == 0
    if rule:
        rows = rows.withColumn("problems", F.when(good & ~F.expr(rule), F.array(F.lit(f"not {rule}"))).otherwise(F.col("problems")))
    if key:
        # seeds are short lists; only rows that share a key meet
        names = schema.fieldNames()
        place = F.row_number().over(Window.partitionBy(key, good).orderBy(*names))
        rows = rows.withColumn("_place", place).withColumn("problems", F.when(good & (F.col("_place") > 1), F.array(F.lit(f"{key}: repeated"))).otherwise(F.col("problems")))
    accepted = rows.where(good).select(*schema.fieldNames())
    rejects = rows.where(~good).select(*[F.col(f"raw.{f.name}").alias(f.name) for f in schema.fields], F.array_join("problems", "; ").alias("reason"))
    return accepted, rejects


def split_seed(spark: SparkSession, seed_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejects) of the seed ``name`` of SEED_FILES under ``seed_dir``."""
    file, schema = SEED_FILES[name]
    return split_seed_csv(spark, f"{seed_dir.rstrip('/')}/{file}.csv", schema, SEED_RULES[name], SEED_KEYS[name])


def holidays_for_years(years: DataFrame, year_col: str = "year") -> DataFrame:
    """Holiday rows for each year in ``years`` (one row per holiday per year).

    Includes one observance (not a bank holiday) per year and, in years where
    Good Friday falls on April 2, two holidays on one date. Bridge days and
    single decrees follow no rule: a holiday table or CSV takes the rule's place
    where they matter.
    """
    y = F.col(year_col).cast("int")
    fixed = [F.struct(F.make_date(y, F.lit(m), F.lit(d)).alias("date"),
                      F.lit(name).alias("holiday_name"),
                      F.lit("national").alias("holiday_type"),
                      F.lit(True).alias("is_bank_holiday"))
             for m, d, name in FIXED_HOLIDAYS]
    for m, d, name in MOVED_HOLIDAYS:
        day = F.make_date(y, F.lit(m), F.lit(d))
        shift = F.element_at(F.array(*map(F.lit, (0, 0, -1, -2, 4, 3, 0))), F.dayofweek(day))  # Sunday first
        fixed.append(F.struct(F.date_add(day, shift).alias("date"), F.lit(name).alias("holiday_name"),
                              F.lit("national").alias("holiday_type"), F.lit(True).alias("is_bank_holiday")))
    easter = easter_sunday(y)
    moving = [F.struct(F.date_add(easter, off).alias("date"),
                       F.lit(name).alias("holiday_name"),
                       F.lit(kind).alias("holiday_type"),
                       F.lit(bank).alias("is_bank_holiday"))
              for off, name, kind, bank in EASTER_HOLIDAYS]
    return years.select(F.inline(F.array(*fixed, *moving)))


def holidays_between(spine_bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    """Holidays for every year touched by [start, end) computed from a bounds row."""
    years = spine_bounds.select(
        F.explode(F.sequence(F.year(start), F.year(F.date_sub(end, 1)))).alias("year"))
    return holidays_for_years(years)
