"""Readers and writers with a declared schema and a separate channel for bad records."""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.staging import stage


class NoSuchFile(Exception):
    """The path to read does not exist."""


_INTEGER = re.compile(r"[+-]?[0-9]+")
_NUMBER = re.compile(r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|NaN|[+-]?Inf(?:inity)?")


class BadCsvFormat(Exception):
    """The sampled head of a CSV file has no consistent shape or types."""


# The columns of the station table.
STATION_SCHEMA = T.StructType(
    [
        T.StructField("station", T.StringType()),
        T.StructField("dist_coast", T.FloatType()),
        T.StructField("latitude", T.FloatType()),
        T.StructField("longitude", T.FloatType()),
        T.StructField("elevation", T.FloatType()),
        T.StructField("state", T.StringType()),
        T.StructField("name", T.StringType()),
    ]
)
MISSING_ELEVATION = -999.9

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("created_at", T.StringType()),
        T.StructField("id_str", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("user", T.StructType([T.StructField("id_str", T.StringType())])),
    ]
)


@dataclass
class Parsed:
    """Two channels of one parse."""

    good: DataFrame
    bad: DataFrame


# ------------------------------------------------------------------ raw series


def parse_series_lines(lines: DataFrame, days: int = 365, raw: str = "value") -> DataFrame:
    """Comma-separated lines → ``ok, station, measurement, year, values, raw``.

    A line is good when it has exactly ``days + 3`` fields, an integer year in
    the third one, and no non-empty value that fails to parse as a number.
    Empty values and NaN are missing.  Nothing is dropped: bad lines keep their
    text in ``raw``.
    """
    fields = lines.select(F.col(raw).alias("raw"), F.split(raw, ",", -1).alias("f"))
    texts = F.slice("f", 4, days)
    parsed = fields.select(
        "raw",
        "f",
        F.get("f", F.lit(2)).try_cast("int").alias("year"),
        F.transform(texts, lambda t: t.try_cast("double")).alias("numbers"),
        F.size(F.filter(texts, lambda t: (t != "") & t.try_cast("double").isNull())).alias("unparsable"),
    )
    ok = (F.size("f") == days + 3) & F.col("year").isNotNull() & (F.col("unparsable") == 0)
    numbers = F.transform(
        "numbers", lambda v: F.when(F.isnan(v), F.lit(None)).otherwise(v)
    )
    return parsed.select(
        ok.alias("ok"),
        F.when(ok, F.get("f", F.lit(0))).alias("station"),
        F.when(ok, F.get("f", F.lit(1))).alias("measurement"),
        F.when(ok, F.col("year")).alias("year"),
        F.when(ok, numbers).alias("values"),
        F.when(~ok, F.col("raw")).alias("raw"),
    )


def split_series_lines(lines: DataFrame, days: int = 365, raw: str = "value") -> Parsed:
    """Parse once, write both outcomes in one job, and return the two channels."""
    parsed = stage(parse_series_lines(lines, days, raw), "parsed-series")
    return Parsed(
        good=parsed.where("ok").select("station", "measurement", "year", "values"),
        bad=parsed.where("NOT ok").select("raw"),
    )


def _good_lines(spark: SparkSession, path: str, days: int) -> DataFrame:
    """Good rows of every text file below ``path``; a few files that cannot be split, as with gzip, are parsed by all cores."""
    parsed = parse_series_lines(spread(spark.read.text(path)), days)
    return parsed.where("ok").select("station", "measurement", "year", "values")


def ingest_series(spark: SparkSession, path: str, days: int = 365) -> DataFrame:
    """Every text file below ``path`` in one job: header and misshapen rows dropped, by year."""
    return _good_lines(spark, path, days).orderBy("year", "station", "measurement")


def ingest_table(spark: SparkSession, path: str, target: str, name: str, days: int = 365, buckets: int = 8) -> DataFrame:
    """The good rows as a table laid out for later reads: partitions by year, in these buckets by station, sorted by station.

    Filters on the year read only its files, and joins or groupings on the station with a table in as many buckets need no exchange.
    Rows are dealt by year and bucket, so every pair of them is one file, and a station that holds much of the rows
    spreads over its years.  ``target`` is the folder, ``name`` the name in the catalog.
    """
    rows = _good_lines(spark, path, days)
    bucket = F.pmod(F.hash("station"), F.lit(buckets))
    dealt = rows.repartition("year", bucket).sortWithinPartitions("year", "station", "measurement")
    dealt.write.partitionBy("year").bucketBy(buckets, "station").sortBy("station").option("path", target).saveAsTable(name)
    return spark.table(name)


def station_table(stations: DataFrame, target: str, name: str, buckets: int = 8) -> DataFrame:
    """A table of stations in buckets that match ``ingest_table``."""
    stations.write.bucketBy(buckets, "station").sortBy("station").option("path", target).saveAsTable(name)
    return stations.sparkSession.table(name)


# ------------------------------------------------------------------------ CSV


def _kind(texts: list[str]) -> T.DataType:
    """Long, double or string, by the numbers that Spark's reader accepts; integers beyond 64 bits are doubles."""
    if all(_INTEGER.fullmatch(text) and -(1 << 63) <= int(text) < 1 << 63 for text in texts):
        return T.LongType()
    return T.DoubleType() if all(_NUMBER.fullmatch(text) for text in texts) else T.StringType()


def infer_csv_schema(spark: SparkSession, path: str, head: int = 10) -> T.StructType:
    """Column names from the header, types from the first ``head`` lines (header included) of the first file by name.

    Columns are long, double or string.  A column whose sampled values mix numbers
    with text, or a line with another number of fields, raises ``BadCsvFormat``.
    """
    try:
        files = sorted(spark.read.text(path).inputFiles())
        lines = [row[0] for row in spark.read.text(files[0]).limit(head).collect()] if files else []
    except AnalysisException as error:
        raise NoSuchFile(path) from error
    if not lines:
        raise BadCsvFormat("the file is empty")
    header, *rows = csv.reader(lines)
    if any(len(row) != len(header) for row in rows):
        raise BadCsvFormat("lines have different numbers of fields")
    fields = []
    for position, name in enumerate(header):
        column = [row[position] for row in rows]
        kind = _kind(column)
        numeric = [isinstance(_kind([text]), (T.LongType, T.DoubleType)) for text in column]
        if isinstance(kind, T.StringType) and any(numeric):
            raise BadCsvFormat(f"column {name} mixes numbers and text")
        fields.append(T.StructField(name, kind, True))
    return T.StructType(fields)


def read_csv_with_bad_lines(spark: SparkSession, path: str, schema: T.StructType | None = None) -> Parsed:
    """Typed rows, and separately the lines that do not fit the schema."""
    schema = schema or infer_csv_schema(spark, path)
    marked = T.StructType([*schema.fields, T.StructField("bad_line", T.StringType())])
    rows = spark.read.csv(
        path, schema=marked, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="bad_line"
    )
    rows = stage(rows, "parsed-csv")
    return Parsed(
        good=rows.where("bad_line IS NULL").drop("bad_line"),
        bad=rows.where("bad_line IS NOT NULL").select(F.col("bad_line").alias("raw")),
    )


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated station table (gz or plain); −999.9 metres means unknown."""
    stations = spark.read.csv(path, sep="\t", header=True, schema=STATION_SCHEMA)
    unknown = F.col("elevation") == F.lit(MISSING_ELEVATION).cast("float")
    return stations.withColumn("elevation", F.when(~unknown, F.col("elevation")))


# ----------------------------------------------------------------------- JSON


def parse_messages(lines: DataFrame, raw: str = "value", schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
    """JSON-per-line → ``user_id, text``; broken lines and records without ``created_at`` go."""
    record = F.from_json(F.col(raw), schema)
    return (
        lines.select(record.alias("r"))
        .where(F.col("r.created_at").isNotNull())
        .select(F.col("r.user.id_str").alias("user_id"), F.col("r.text").alias("text"))
    )


# ------------------------------------------------------------------ partitions


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that yields fewer partitions than there are cores.

    One gzip file or one small row group is a single split; expensive row work
    on it would run on one core.  Large scans pass through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
