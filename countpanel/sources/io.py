"""Readers and writers.

Every reader takes an explicit schema (no inference job); every filter is
expressed on raw columns so the Parquet reader can push it down.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Column layouts of the raw files the library reads.
COUNTS_DDL = "site_id INT, direction STRING, type STRING, start_time STRING, end_time STRING, cnt INT"
SITES_DDL = ("site_id STRING, site_nr INT, lon DOUBLE, lat DOUBLE, site_name STRING, domain STRING, "
             "road STRING, district STRING, municipality STRING, interval_min INT, date_from STRING")
WEATHER_COLS = ["temperature_2m", "apparent_temperature", "relative_humidity_2m", "precipitation", "rain",
                "snowfall", "wind_speed_10m", "shortwave_radiation", "direct_normal_irradiance",
                "sunshine_duration"]


def finite(df: DataFrame) -> DataFrame:
    """NaN and infinities of float columns become null, so that one of them
    cannot poison every mean, sum and maximum downstream."""
    bad = lambda c: F.isnan(c) | (F.abs(F.col(c)) == float("inf"))
    return df.withColumns({c: F.when(~bad(c), F.col(c)) for c, t in df.dtypes if t in ("float", "double")})


# S1 / S2 ----------------------------------------------------------------
def read_counts_csv(spark: SparkSession, paths: str | Sequence[str], ddl: str = COUNTS_DDL,
                    ts_format: str | None = None, corrupt: str | None = None) -> DataFrame:
    """Headerless count files with fixed names; timestamps parsed leniently
    (a bad value becomes null rather than failing the job).  With ``corrupt``,
    a column of that name holds each malformed line as it was read."""
    reader = spark.read.schema(f"{ddl}, {corrupt} STRING" if corrupt else ddl).option("header", False).option(
        "mode", "PERMISSIVE")
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    df = finite(reader.csv(list(paths) if not isinstance(paths, str) else paths))
    conv = (lambda c: F.try_to_timestamp(F.col(c), F.lit(ts_format))) if ts_format else \
        (lambda c: F.try_to_timestamp(F.col(c)))
    return df.withColumns({"start_time": conv("start_time").cast("timestamp_ntz"),
                           "end_time": conv("end_time").cast("timestamp_ntz")})


def read_monthly(spark: SparkSession, root: str, months: Sequence[str], pattern: str = "{root}/{month}.csv",
                 ddl: str = COUNTS_DDL) -> DataFrame:
    """Monthly file set as one table; months without a file are skipped.
    One read over the list (one scan, parallel over files), the source
    file kept as a column."""
    paths = [pattern.format(root=root, month=m) for m in months]
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    existing = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(conf).exists(path):
            existing.append(p)
    if not existing:
        return spark.createDataFrame([], ddl + ", source_file STRING")
    return read_counts_csv(spark, existing, ddl).withColumn("source_file", F.input_file_name())


# S3 / S4 ----------------------------------------------------------------
def read_csv_typed(spark: SparkSession, path: str, ddl: str, header: bool = True) -> DataFrame:
    return finite(spark.read.schema(ddl).option("header", header).csv(path))


def read_sites(spark: SparkSession, path: str, ddl: str = SITES_DDL) -> DataFrame:
    """Headerless site dimension; ids that are not integers are dropped."""
    df = spark.read.schema(ddl).option("header", False).csv(path)
    return (df.withColumn("site_id", F.col("site_id").try_cast("int"))
            .filter(F.col("site_id").isNotNull())
            .withColumn("date_from", F.try_to_timestamp(F.col("date_from")).cast("date")))


# S5 / S6 ----------------------------------------------------------------
def scan_parquet(spark: SparkSession, path: str, cols: Sequence[str] | None = None,
                 where: Column | str | None = None) -> DataFrame:
    """Parquet scan with the column list and row filter declared up front;
    Catalyst turns them into ReadSchema and PushedFilters."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    if cols:
        df = df.select(*cols)
    return df


# S7 ---------------------------------------------------------------------
def read_weather(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Observed or forecast weather with a parsed hourly time column."""
    if fmt == "csv":
        ddl = "time STRING, site_id INT, " + ", ".join(f"{c} DOUBLE" for c in WEATHER_COLS)
        df = spark.read.schema(ddl).option("header", True).csv(path)
    else:
        df = spark.read.parquet(path)
    return finite(df.withColumn("time", F.try_to_timestamp(F.col("time").cast("string")).cast("timestamp_ntz")))


# S9 ---------------------------------------------------------------------
def explode_hourly_json(df: DataFrame, col: str, fields: Sequence[str], id_cols: Sequence[str] = ()) -> DataFrame:
    """A JSON document whose ``hourly`` object holds parallel arrays
    (time plus one array per variable) -> one row per hour.  Metadata
    fields of the document stay as columns."""
    schema = ("struct<latitude:double,longitude:double,utc_offset_seconds:int,hourly:struct<time:array<string>,"
              + ",".join(f"{f}:array<double>" for f in fields) + ">>")
    j = df.select(*id_cols, F.from_json(F.col(col), schema).alias("_j"))
    zipped = F.arrays_zip(F.col("_j.hourly.time").alias("time"),
                          *[F.col(f"_j.hourly.{f}").alias(f) for f in fields])
    return (j.select(*id_cols, F.col("_j.latitude").alias("latitude"), F.col("_j.longitude").alias("longitude"),
                     F.col("_j.utc_offset_seconds").alias("utc_offset_seconds"), F.inline(zipped))
            .withColumn("time", F.to_timestamp_ntz(F.col("time"))))


# S10 --------------------------------------------------------------------
def explode_time_axis(df: DataFrame, start: str, end: str, step_s: str, offset_s: str,
                      arrays: Sequence[str]) -> DataFrame:
    """Rebuild the time axis of a response from (start, end, step) in epoch
    seconds plus a UTC offset, and attach the i-th value of every array."""
    t = F.sequence(F.col(start), F.col(end) - F.col(step_s), F.col(step_s))
    d = df.select("*", F.posexplode(t).alias("_i", "_epoch"))
    local = F.timestamp_seconds(F.col("_epoch") + F.col(offset_s)).cast("timestamp_ntz")
    return (d.select(*[c for c in df.columns if c not in arrays and c not in (start, end, step_s)],
                     local.alias("time"), *[F.element_at(F.col(a), F.col("_i") + 1).alias(a) for a in arrays]))


# S11 / S12 --------------------------------------------------------------
def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).csv(path)


def compact_years(dfs: Sequence[DataFrame], path: str, ts: str = "time", max_records: int = 5_000_000) -> None:
    """Union of yearly tables written once, partitioned by year so later
    scans prune whole years.  Every task writes its own rows of each year
    (no shuffle onto one task per year); ``maxRecordsPerFile`` bounds the
    file size."""
    from functools import reduce

    u = reduce(lambda a, b: a.unionByName(b), dfs).withColumn("year", F.year(F.col(ts)))
    (u.write.mode("overwrite").option("maxRecordsPerFile", max_records)
     .partitionBy("year").parquet(path))


# S13 --------------------------------------------------------------------
def save_encodings(tables: dict[str, DataFrame], root: str) -> None:
    for name, t in tables.items():
        t.write.mode("overwrite").parquet(f"{root}/{name}")


def load_encodings(spark: SparkSession, root: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{root}/{n}") for n in names}


# S14 --------------------------------------------------------------------
def compare_schema(a: DataFrame, b: DataFrame) -> DataFrame:
    """Column-by-column comparison of two schemas (name, position, type);
    built from ``df.schema`` only, no job on the data."""
    spark = a.sparkSession
    fa = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(a.schema.fields)}
    fb = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(b.schema.fields)}
    rows = []
    for name in list(fa) + [n for n in fb if n not in fa]:
        pa, ta = fa.get(name, (None, None))
        pb, tb = fb.get(name, (None, None))
        rows.append((name, pa, pb, ta, tb, pa is not None and pa == pb, ta is not None and ta == tb))
    return spark.createDataFrame(rows, "column string, pos_a int, pos_b int, type_a string, type_b string, "
                                       "same_pos boolean, same_type boolean")


def save_model(model, path: str) -> None:
    """Persist a fitted ML model or pipeline (MLWriter, overwrite)."""
    model.write().overwrite().save(path)


def load_model(cls, path: str):
    """Reload a model saved with :func:`save_model` (``cls`` is its class)."""
    return cls.load(path)
