"""Reading and writing: every source is written from the given tables to a fresh path and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from seriesloom.functions.halfprec import pack_half, unpack_half
from seriesloom.plans.profile import near
from seriesloom.plans.registry import query
from seriesloom.plans.views import DAYS, SERIES_LONG_SQL, r6, series, table
from seriesloom.sources import readers
from seriesloom.staging import scratch_path

_PRIORITIES = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)]


@query(
    "src_inline",
    "SELECT p.code, count(*) AS n FROM orders JOIN (VALUES "
    + ", ".join(f"('{name}', {code})" for name, code in _PRIORITIES)
    + ") AS p(name, code) ON o_orderpriority = p.name GROUP BY 1",
)
def src_inline(spark, folder):
    codes = spark.createDataFrame(_PRIORITIES, "name string, code int")
    counts = table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(codes, "name").select("code", "n")


@query(
    "src_text",
    """SELECT kind, count(*) AS lines, min(c_name) AS first_line, sum(length(c_name))::BIGINT AS chars
       FROM customer, (VALUES ('plain'), ('gzip')) AS k(kind) GROUP BY 1""",
)
def src_text(spark, folder):
    names = table(spark, folder, "customer").select("c_name")
    read = None
    for kind, codec in (("plain", "none"), ("gzip", "gzip")):
        path = scratch_path(spark, f"text-{kind}")
        names.write.option("compression", codec).text(path)
        facts = spark.read.text(path).agg(
            F.count(F.lit(1)).alias("lines"),
            F.min("value").alias("first_line"),
            F.sum(F.length("value").cast("long")).alias("chars"),
        )
        facts = facts.select(F.lit(kind).alias("kind"), "*")
        read = facts if read is None else read.unionByName(facts)
    return read


SHORT, ODD_YEAR = 0.2, -0.2  # first readings beyond these mark lines to be spoiled


def _series_lines(spark, folder):
    """Raw lines of the series; some are a field short, some have a year that is no number."""
    first = F.get("values", F.lit(0))
    texts = F.transform("values", lambda v: F.coalesce(v.cast("string"), F.lit("")))
    fields = F.when(first > SHORT, F.slice(texts, 1, DAYS - 1)).otherwise(texts)
    year = F.when(first < ODD_YEAR, F.lit("199x")).otherwise(F.col("year").cast("string"))
    head = F.concat_ws(",", F.col("station").cast("string"), "measurement", year)
    return series(spark, folder).select(F.concat_ws(",", head, F.array_join(fields, ",")).alias("value"))


_LINES_SQL = f"""WITH {SERIES_LONG_SQL}, rows AS (
  SELECT station, measurement, year, count(v)::INTEGER AS present, round(sum(v), 6) + 0.0 AS total,
         coalesce(max(v) FILTER (day = 0) > {SHORT}, false) AS short, coalesce(max(v) FILTER (day = 0) < {ODD_YEAR}, false) AS odd
  FROM series_long GROUP BY 1, 2, 3)"""


@query(
    "ingest_series",
    f"{_LINES_SQL} SELECT station::VARCHAR AS station, measurement, year, present, total FROM rows WHERE NOT short AND NOT odd",
)
def ingest_series(spark, folder):
    path = scratch_path(spark, "raw-series")
    header = "station,measurement,year," + ",".join(str(day) for day in range(1, DAYS + 1))
    _series_lines(spark, folder).write.text(path)
    spark.range(1).select(F.lit(header).alias("value")).write.mode("append").text(path)
    good = readers.ingest_series(spark, path, DAYS)
    present = F.filter("values", lambda v: v.isNotNull())
    total = F.aggregate(present, F.lit(0.0), lambda acc, v: acc + v)
    return good.select("station", "measurement", "year", F.size(present).alias("present"), r6(total).alias("total"))


@query(
    "ingest_table",
    f"""{_LINES_SQL}, stations AS (SELECT DISTINCT station, station % 7 AS region FROM rows)
        SELECT year, region, count(*) AS series, sum(present)::BIGINT AS present, round(sum(total), 6) + 0.0 AS total
        FROM rows JOIN stations USING (station) WHERE NOT short AND NOT odd AND year >= 2010 GROUP BY 1, 2""",
)
def ingest_table(spark, folder):
    """Raw lines, some of them in one gzip file, as a laid-out table that is joined with stations for the years from 2010 on."""
    path, names = scratch_path(spark, "raw-series"), [f"{kind}_{uuid.uuid4().hex}" for kind in ("series", "stations")]
    lines = _series_lines(spark, folder)
    old = F.split("value", ",")[2] < "2000"
    lines.where(~old).write.text(path)
    lines.where(old).coalesce(1).write.mode("append").option("compression", "gzip").text(path)
    laid_out = readers.ingest_table(spark, path, scratch_path(spark, "series"), names[0], DAYS)
    stations = series(spark, folder).select(F.col("station").cast("string").alias("station"), (F.col("station") % 7).alias("region")).distinct()
    beside = readers.station_table(stations, scratch_path(spark, "stations"), names[1])
    return laid_out_regions(laid_out, beside)


def laid_out_regions(laid_out, stations):
    """Per year from 2010 on and region: series, values present and their sum."""
    present = F.filter("values", lambda v: v.isNotNull())
    total = F.aggregate(present, F.lit(0.0), lambda acc, v: acc + v)
    rows = laid_out.where(F.col("year") >= 2010).select("station", "year", F.size(present).alias("present"), r6(total).alias("total"))
    return rows.join(stations, "station").groupBy("year", "region").agg(
        F.count(F.lit(1)).alias("series"), F.sum("present").alias("present"), r6(F.sum("total")).alias("total")
    )


@query(
    "parse_good_bad",
    f"""{_LINES_SQL} SELECT CASE WHEN short OR odd THEN 'bad' ELSE 'good' END AS channel, station::VARCHAR AS station,
        {DAYS + 3} - short::INTEGER AS fields FROM rows""",
)
def parse_good_bad(spark, folder):
    parsed = readers.split_series_lines(_series_lines(spark, folder), DAYS)
    good = parsed.good.select(F.lit("good").alias("channel"), "station", (F.size("values") + 3).alias("fields"))
    parts = F.split("raw", ",", -1)
    bad = parsed.bad.select(F.lit("bad").alias("channel"), F.get(parts, F.lit(0)).alias("station"), F.size(parts).alias("fields"))
    return good.unionByName(bad)


@query(
    "csv_bad_lines",
    """SELECT CASE WHEN o_totalprice > 450000 THEN 'bad' ELSE 'good' END AS channel, count(*) AS n,
       sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY 1""",
)
def csv_bad_lines(spark, folder):
    price = F.when(F.col("o_totalprice") > 450000, F.lit("unknown")).otherwise(F.col("o_totalprice").cast("string"))
    path = scratch_path(spark, "csv")
    orders = table(spark, folder, "orders").orderBy("o_totalprice")  # the head of the file is sound
    orders = orders.select("o_orderkey", price.alias("price"), "o_orderstatus")
    orders.write.option("header", True).csv(path)
    parsed = readers.read_csv_with_bad_lines(spark, path)
    good = parsed.good.select(F.lit("good").alias("channel"), F.col("o_orderkey").cast("long").alias("k"))
    bad = parsed.bad.select(F.lit("bad").alias("channel"), F.get(F.split("raw", ","), F.lit(0)).cast("long").alias("k"))
    return good.unionByName(bad).groupBy("channel").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("keys"))


@query(
    "src_json",
    "SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 1500 THEN c_acctbal END AS c_acctbal FROM customer",
)
def src_json(spark, folder):
    rich = F.when(F.col("c_acctbal") >= 1500, F.col("c_acctbal")).alias("c_acctbal")
    path = scratch_path(spark, "json")
    table(spark, folder, "customer").select("c_custkey", "c_name", rich).write.json(path)  # absent fields are left out
    return spark.read.json(path).select("c_custkey", "c_name", "c_acctbal")


@query(
    "json_valid_records",
    """SELECT event_id::VARCHAR AS user_id, 'k=' || (props->>'$.k') AS text FROM events
       WHERE value <= 150 AND event_type <> 'error'""",
)
def json_valid_records(spark, folder):
    # Errors stand for notices without a creation time; some other records are cut off.
    record = F.struct(
        F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd")).alias("created_at"),
        F.concat(F.lit("k="), F.get_json_object("props", "$.k")).alias("text"),
        F.struct(F.col("event_id").cast("string").alias("id_str")).alias("user"),
    )
    whole = F.to_json(record)
    broken = F.expr("substring(whole, 1, length(whole) - 3)")
    lines = table(spark, folder, "events").select("value", whole.alias("whole"))
    lines = lines.select(F.when(F.col("value") > 150, broken).otherwise(F.col("whole")).alias("value"))
    return readers.parse_messages(lines)


@query(
    "src_tsv",
    """SELECT s_suppkey::VARCHAR AS station, s_nationkey::FLOAT AS dist_coast,
       CASE WHEN s_acctbal >= 1000 THEN s_nationkey::FLOAT END AS elevation, s_name AS name FROM supplier""",
)
def src_tsv(spark, folder):
    path = scratch_path(spark, "tsv")
    unknown = F.col("s_acctbal") < 1000
    stations = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("station"),
        F.col("s_nationkey").alias("dist_coast"),
        F.lit(45.5).alias("latitude"),
        F.lit(-73.25).alias("longitude"),
        F.when(unknown, readers.MISSING_ELEVATION).otherwise(F.col("s_nationkey").cast("double")).alias("elevation"),
        F.lit("NY").alias("state"),
        F.col("s_name").alias("name"),
    )
    stations.write.option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)
    return readers.read_stations(spark, path).select("station", "dist_coast", "elevation", "name")


@query(
    "src_parquet",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_discount > 0.05",
)
def src_parquet(spark, folder):
    rows = table(spark, folder, "lineitem").where(F.col("l_discount") > 0.05)
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "sql_on_parquet",
    """SELECT l_returnflag AS mode, count(*) AS n FROM lineitem
       WHERE l_linestatus = 'O' GROUP BY 1""",
)
def sql_on_parquet(spark, folder):
    return spark.sql(
        f"""SELECT l_returnflag AS mode, count(*) AS n FROM parquet.`{folder}/lineitem.parquet`
            WHERE l_linestatus = 'O' GROUP BY l_returnflag"""
    )


@query("parquet_roundtrip", "SELECT event_type, count(*) AS n, round(sum(value), 4) + 0.0 AS total FROM events GROUP BY 1")
def parquet_roundtrip(spark, folder):
    path = scratch_path(spark, "parquet")
    events = table(spark, folder, "events")
    events.write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("sample_write", "SELECT count(*) AS total, 0 AS strangers, true AS within FROM lineitem")
def sample_write(spark, folder):
    path = scratch_path(spark, "sample")
    rows = table(spark, folder, "lineitem")
    rows.sample(withReplacement=False, fraction=0.001, seed=7).write.mode("overwrite").parquet(path)
    written = spark.read.parquet(path)
    strangers = written.join(rows, ["l_orderkey", "l_linenumber", "l_extendedprice"], "left_anti").agg(F.count(F.lit(1)))
    found = rows.agg(F.count(F.lit(1)).alias("total")).select(
        "total", strangers.scalar().alias("strangers"), written.agg(F.count(F.lit(1))).scalar().alias("n")
    )
    within = near(F.col("n"), F.col("total") * 0.001, F.sqrt(F.col("total") * (0.001 * 0.999)))
    return found.select("total", "strangers", within.alias("within"))


@query(
    "unpack_f16",
    f"""WITH {SERIES_LONG_SQL}, scaled AS (SELECT *, power(2, floor(log2(abs(v::FLOAT::DOUBLE))) - 10) AS unit FROM series_long)
        SELECT station, day, round_even(v::FLOAT::DOUBLE / unit, 0) * unit AS v, 0 AS overflowed FROM scaled""",
)
def unpack_f16(spark, folder):
    """Half floats keep eleven bits, rounded to the nearest and to even."""
    packed = series(spark, folder).select("station", pack_half(F.col("values").cast("array<float>")).alias("packed"))
    opened = packed.select("station", unpack_half(F.col("packed")).alias("u"))
    return opened.select("station", F.posexplode("u.values").alias("day", "v"), "u.overflowed").withColumn("v", F.col("v").cast("double"))
