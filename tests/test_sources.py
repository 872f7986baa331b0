import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.functions.halfprec import pack_half, unpack_half
from seriesloom.sources import readers


def test_series_lines_have_two_channels(spark):
    good = ["s1,SNWD,1950," + ",".join(["1.5", "", "nan"]), "s2,PRCP,1949,0,-1000,97892"]
    bad = ["station,measurement,year,1,2,3", "s1,SNWD,1950,1,2", "s1,SNWD,1950,1,2,3,4", "s1,SNWD,1950,1,x,3", ""]
    lines = spark.createDataFrame([(t,) for t in good + bad], "value string")
    parsed = readers.split_series_lines(lines, days=3)
    assert sorted(r["raw"] for r in parsed.bad.collect()) == sorted(bad)
    rows = {r["station"]: (r["year"], r["values"]) for r in parsed.good.collect()}
    assert rows == {"s1": (1950, [1.5, None, None]), "s2": (1949, [0.0, -1000.0, 97892.0])}


def test_a_folder_is_read_in_one_job_and_sorted(spark, tmp_path):
    for name, year in (("a.csv", 1990), ("b.csv", 1980)):
        (tmp_path / name).write_text(f"station,measurement,year,1,2\ns,M,{year},1,2\nshort,line\n")
    rows = readers.ingest_series(spark, str(tmp_path), days=2).collect()
    assert [r["year"] for r in rows] == [1980, 1990]


def test_csv_types_are_inferred_from_the_head(spark, tmp_path):
    path = tmp_path / "t.csv"
    rows = [f"{i},{i / 2},n{i}" for i in range(12)] + ['oops,1.0,x', '7,2.5,"a,b"', "1,2"]
    path.write_text("\n".join(["k,v,name", *rows]) + "\n")
    schema = readers.infer_csv_schema(spark, str(path))
    assert [f.dataType for f in schema] == [T.LongType(), T.DoubleType(), T.StringType()]
    parsed = readers.read_csv_with_bad_lines(spark, str(path))
    assert sorted(r["raw"] for r in parsed.bad.collect()) == ["1,2", "oops,1.0,x"]
    assert parsed.good.count() == 13
    assert parsed.good.where("name = 'a,b'").count() == 1


@pytest.mark.parametrize("body", ["a,b\n1,2\n3\n", "a,b\n1,2\nx,3\n", ""])
def test_bad_heads_are_refused(spark, tmp_path, body):
    path = tmp_path / "bad.csv"
    path.write_text(body)
    with pytest.raises(readers.BadCsvFormat):
        readers.infer_csv_schema(spark, str(path))


def test_missing_file(spark, tmp_path):
    with pytest.raises(readers.NoSuchFile):
        readers.infer_csv_schema(spark, str(tmp_path / "absent.csv"))


def test_stations_from_a_gzipped_table(spark, tmp_path):
    path = tmp_path / "stations.tsv.gz"
    head = "\t".join(readers.STATION_SCHEMA.fieldNames())
    path.write_bytes(gzip.compress(f"{head}\nX1\t361.8\t17.1\t-61.7\t-999.9\tNaN\tST JOHNS\nX2\t1\t2\t3\t19.2\tNY\tY\n".encode()))
    rows = {r["station"]: r["elevation"] for r in readers.read_stations(spark, str(path)).collect()}
    assert rows["X1"] is None and rows["X2"] == pytest.approx(19.2, abs=1e-5)


def test_json_fields_that_are_absent_are_null(spark, tmp_path):
    path = tmp_path / "people.json"
    path.write_text('{"name":"Michael"}\n{"name":"Andy", "age":30}\n{"name":"Justin", "age":19}\n')
    spark.read.json(str(path)).createOrReplaceTempView("folk")
    assert [r[0] for r in spark.sql("SELECT name FROM folk WHERE age >= 13 AND age <= 19").collect()] == ["Justin"]


def test_half_floats(spark):
    rows = [(0, [1.5, None, -1000.0]), (1, [97892.0, 65504.0]), (2, []), (3, None), (4, [float("nan")])]
    df = spark.createDataFrame(rows, "i int, v array<float>").repartition(1)
    packed = df.select("i", pack_half(F.col("v")).alias("p"))
    got = {r["i"]: r["u"] for r in packed.select("i", unpack_half(F.col("p")).alias("u")).collect()}
    assert got[0]["values"] == [1.5, None, -1000.0] and got[0]["overflowed"] == 0
    assert got[1]["values"] == [None, 65504.0] and got[1]["overflowed"] == 1
    assert got[2]["values"] == [] and got[4]["values"] == [None]
    assert got[3]["values"] is None
    raw = {r["i"]: r["p"] for r in packed.collect()}
    assert bytes(raw[1]) == np.array([97892, 65504], dtype="<f2").tobytes()


def test_packed_bytes_come_in_pairs(spark):
    df = spark.createDataFrame([(bytearray(b"abc"),)], "p binary")
    with pytest.raises(Exception, match="even number"):
        df.select(unpack_half(F.col("p"))).collect()


def test_small_scans_are_spread_and_large_ones_left_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    one, many = spark.range(0, 100, 1, 1), spark.range(0, 100, 1, cores + 3)
    assert readers.spread(one).rdd.getNumPartitions() == cores
    assert readers.spread(many).rdd.getNumPartitions() == cores + 3


def _raw_lines(spark, path):
    """Two plain files and one gzip file of series of four days."""
    rows = [(f"s{i % 23}", "PRCP", 1990 + i % 30, [float(i), None, 2.0, 3.0]) for i in range(600)]
    text = [(",".join([s, m, str(y), *("" if v is None else str(v) for v in values)]),) for s, m, y, values in rows]
    lines = spark.createDataFrame([*text, ("station,measurement,year,1,2,3,4",), ("s1,PRCP,199x,1,2,3,4",)], "value string")
    lines.where("length(value) % 2 = 0").repartition(2).write.text(path)
    lines.where("length(value) % 2 = 1").coalesce(1).write.mode("append").option("compression", "gzip").text(path)
    return rows


@pytest.fixture(scope="module")
def laid_out(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("laid-out")
    rows = _raw_lines(spark, f"{folder}/raw")
    series = readers.ingest_table(spark, f"{folder}/raw", f"{folder}/series", "laid_out_series", 4, buckets=5)
    stations = spark.createDataFrame([(f"s{i}", i % 3) for i in range(23)], "station string, region int")
    stations = readers.station_table(stations, f"{folder}/stations", "laid_out_stations", buckets=5)
    yield rows, series, stations
    for name in ("laid_out_series", "laid_out_stations"):
        spark.sql(f"DROP TABLE {name}")


def test_laid_out_table_holds_the_good_rows(laid_out):
    rows, series, _ = laid_out
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r)) for r in series.select("station", "measurement", "year", "values").collect())


def test_year_filters_prune_files(laid_out):
    _, series, _ = laid_out
    recent = series.where("year >= 2015")
    text = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text and len(recent.inputFiles()) < len(series.inputFiles()) / 4
    assert len(series.inputFiles()) <= 30 * 5  # one file per year and bucket


def test_station_joins_need_no_exchange(spark, laid_out):
    _, series, stations = laid_out
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    try:
        for key in keys:
            spark.conf.set(key, "-1")
        joined = series.join(stations, "station")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 600
    finally:
        for key in keys:
            spark.conf.unset(key)
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_a_single_gzip_file_is_parsed_by_all_cores(spark, tmp_path):
    lines = spark.range(50).select(F.concat_ws(",", F.lit("s"), F.lit("m"), F.lit("2000"), "id", "id").alias("value"))
    lines.coalesce(1).write.option("compression", "gzip").text(f"{tmp_path}/one")
    assert spark.read.text(f"{tmp_path}/one").rdd.getNumPartitions() == 1
    text = readers.ingest_series(spark, f"{tmp_path}/one", 2)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" in text
    assert readers.ingest_series(spark, f"{tmp_path}/one", 2).count() == 50
