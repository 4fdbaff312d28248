"""File and table readers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from claimspan.functions.measures import is_blank
from claimspan.sources.schemas import INBOUND_CLAIMS, REGISTRY_PAYLOAD


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system its scheme names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a Parquet path if the name has a slash."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_claims_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with header. Without a schema Spark reads the file twice to infer one."""
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.schema(schema).csv(path, header=True)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Newline-delimited JSON."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw JSON lines with their 0-based record index inside the file; blank lines do not count."""
    lines = (
        spark.read.text(path)
        .select(
            F.col("value").alias("json"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        )
        .filter(~is_blank("json"))
    )
    numbered = number_in_file(lines, "line", "record_index")
    return numbered.withColumn("record_index", F.col("record_index") - 1).drop("block", "line")


def index_in_folder(records: DataFrame) -> DataFrame:
    """The record index of ``read_json_lines`` counted on through the files of a folder, in the order of their names.

    Only one row per file is ordered; its records are shifted by the count of all earlier files.
    """
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    counts = records.groupBy("file").agg(F.count("*").alias("_n"))
    offsets = counts.select("file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    return (
        records.join(F.broadcast(offsets), "file")
        .withColumn("record_index", F.col("_offset") + F.col("record_index"))
        .select(*records.columns)
    )


def number_in_file(df: DataFrame, row: str, name: str) -> DataFrame:
    """Number rows 1..n per ``file`` in file order.

    ``block`` is the byte offset of the file split a row was read from and ``row`` rises inside a
    split. Splits are numbered on their own, then shifted by the count of all earlier splits, so
    one huge file is worked on by as many tasks as it has splits.
    """
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy("file", "block")
        .agg(F.count("*").alias("_n"))
        .select("file", "block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("file", "block").orderBy(row)
    return (
        df.withColumn("_local", F.row_number().over(inside))
        .join(offsets, ["file", "block"])
        .withColumn(name, F.col("_offset") + F.col("_local"))
        .drop("_offset", "_local")
    )


#: Reader options of the inbound claims file. Code page 1252 differs from Latin-1 in the bytes
#: 0x80-0x9F only, and Spark's readers take Latin-1 but not 1252, see ``from_code_page_1252``.
INBOUND_OPTIONS = {"header": "true", "quote": "", "encoding": "iso-8859-1"}


def from_code_page_1252(df: DataFrame) -> DataFrame:
    """Correct text columns that hold code page 1252 but were decoded as Latin-1."""
    latin, real = "", ""
    for byte in range(0x80, 0xA0):
        char = bytes([byte]).decode("cp1252", errors="ignore")
        if char:
            latin, real = latin + chr(byte), real + char
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: F.translate(F.col(name), latin, real) for name in texts})


def read_inbound_claims(spark: SparkSession, path: str) -> DataFrame:
    """The 13-column inbound claims file: all text, no quote character, code page 1252, empty is NULL."""
    return from_code_page_1252(spark.read.schema(INBOUND_CLAIMS).options(**INBOUND_OPTIONS).csv(path))


def enrich_registry(providers: DataFrame, registry: DataFrame, json_col: str = "payload") -> DataFrame:
    """Providers with five columns from landed registry answers (npi, JSON text), NULL when absent."""
    parsed = registry.select("npi", F.from_json(json_col, REGISTRY_PAYLOAD).alias("p")).select(
        "npi", F.get("p.results", F.lit(0)).alias("r")
    )
    location = F.get(F.filter("r.addresses", lambda a: a["address_purpose"] == "LOCATION"), F.lit(0))
    fields = parsed.select(
        "npi",
        F.struct(
            F.col("r.basic.credential").alias("npi_credential"),
            F.col("r.basic.status").alias("npi_status"),
            location["city"].alias("npi_city"),
            location["state"].alias("npi_state"),
            F.get("r.taxonomies", F.lit(0))["desc"].alias("npi_specialty"),
        ).alias("answer"),
    )
    one_each = fields.groupBy("npi").agg(F.max("answer").alias("answer")).select("npi", "answer.*")
    return providers.join(one_each, "npi", "left")


def dim_date(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per calendar day from ``start`` to ``end``."""
    bounds = spark.range(1).select(F.lit(start).alias("first_day"), F.lit(end).alias("last_day"))
    return calendar(bounds)


def dim_date_for(df: DataFrame, date_col: str) -> DataFrame:
    """The date dimension that covers a date column."""
    return calendar(df.agg(F.min(date_col).alias("first_day"), F.max(date_col).alias("last_day")))


def calendar(bounds: DataFrame) -> DataFrame:
    day = F.col("full_date")
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date")).select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        "full_date",
        F.year(day).alias("calendar_year"),
        F.month(day).alias("calendar_month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("calendar_quarter"),
        F.date_format(day, "EEEE").alias("day_of_week"),
    )
