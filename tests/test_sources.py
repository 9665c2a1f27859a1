from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meshfeed.session import shared_folder
from meshfeed.sources import dated
from meshfeed.sources.tables import read_csv, read_whole_files
from meshfeed.sources.topics import folder_topic, read_topic, tls_topic

NAME = "{target}_tickets_{day}.csv"


def test_days():
    assert dated.day_before("2024-03-01", 1) == "2024-02-29"
    assert dated.day_before(datetime(2024, 1, 8, 3), 7) == "2024-01-01"
    assert dated.window_days(date(2024, 1, 2), 3) == [
        "2023-12-30",
        "2023-12-31",
        "2024-01-01",
        "2024-01-02",
    ]
    assert dated.dated_path("/data/", "2024-01-08", 7, "Report_{day}") == "/data/Report_2024-01-01"


def test_dated_directory(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        spark.range(1).withColumn("d", F.lit(day)).write.parquet(str(tmp_path / day))
    assert dated.read_dated_parquet(spark, str(tmp_path), "2024-01-03").first().d == "2024-01-02"


def window_files(tmp_path, days):
    for day in days:
        (tmp_path / NAME.format(target="2024-01-04", day=day)).write_text(f"day,n\n{day},1\n")
    (tmp_path / NAME.format(target="2024-01-09", day="2024-01-04")).write_text("day,n\nother,1\n")


def days_read(df):
    return sorted(r.day for r in df.collect())


def test_csv_window_has_both_ends(spark, tmp_path):
    window_files(tmp_path, [f"2024-01-0{n}" for n in range(1, 6)])
    df = dated.read_csv_window(spark, str(tmp_path), "2024-01-04", name=NAME)
    assert days_read(df) == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]


def test_csv_window_with_a_missing_day(spark, tmp_path):
    window_files(tmp_path, ["2024-01-01", "2024-01-04"])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        dated.read_csv_window(spark, str(tmp_path), "2024-01-04", name=NAME)
    df = dated.read_csv_window(spark, str(tmp_path), "2024-01-04", name=NAME, allow_missing=True)
    assert days_read(df) == ["2024-01-01", "2024-01-04"]


def test_csv_window_of_day_folders(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-04", "2024-01-05"):
        (tmp_path / f"day={day}").mkdir()
        (tmp_path / f"day={day}" / "part.csv").write_text(f"text,n\n{day},1\n")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        dated.read_csv_window(spark, str(tmp_path), "2024-01-04", name="day={day}")
    df = dated.read_csv_window(
        spark, str(tmp_path), "2024-01-04", name="day={day}", allow_missing=True
    )
    assert sorted(r.text for r in df.collect()) == ["2024-01-01", "2024-01-04"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        dated.read_csv_window(
            spark, str(tmp_path), "2023-01-04", name="day={day}", allow_missing=True
        )


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "string"])
def test_window_and_day_by_column_type(spark, kind):
    days = [f"2024-01-0{n}" for n in range(1, 8)]
    df = spark.createDataFrame([(d,) for d in days], "text string")
    df = df.withColumn("at", F.col("text").cast(kind))
    inside = dated.in_window(df, "at", "2024-01-05", 3)
    assert sorted(r.text for r in inside.collect()) == days[1:5]
    assert [r.text for r in dated.on_day(df, "at", "2024-01-05", 1).collect()] == ["2024-01-04"]


def test_window_includes_last_moment_of_the_day(spark):
    df = spark.sql("select timestamp_ntz'2024-01-05 23:59:59.999999' as at")
    assert dated.in_window(df, "at", "2024-01-05").count() == 1
    assert dated.in_window(df, "at", "2024-01-04").count() == 0


def test_window_prunes_partitions(spark, tmp_path):
    days = spark.createDataFrame([(f"2024-01-0{n}", n) for n in range(1, 8)], "day string, n int")
    days.withColumn("day", F.to_date("day")).write.partitionBy("day").parquet(str(tmp_path / "t"))
    df = dated.in_window(spark.read.parquet(str(tmp_path / "t")), "day", "2024-01-05")
    assert len(df.inputFiles()) >= 4 and df.count() == 4
    assert "PartitionFilters: [isnotnull(day" in df._jdf.queryExecution().toString()


def test_whole_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n{"n": 1}\n]\n')
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.txt").write_text("no")
    df = read_whole_files(spark, str(tmp_path), glob="*.json")
    assert sorted(r.value for r in df.collect()) == ["[\n{\"n\": 1}\n]\n", "[]"]


def test_csv_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("n,s\n1,a\n,b\n")
    assert read_csv(spark, str(tmp_path), infer=True).dtypes == [("n", "int"), ("s", "string")]
    assert read_csv(spark, str(tmp_path)).dtypes == [("n", "string"), ("s", "string")]
    given = read_csv(spark, str(tmp_path), schema=spark.createDataFrame([], "n long, s string").schema)
    assert [r.n for r in given.orderBy("s").collect()] == [1, None]


def test_topics():
    target = tls_topic("ssl://host:1", "t", "c.pem", "k.pem", "ca.pem")
    assert target.format == "pulsar" and target.options["topic"] == "t"
    assert "minPartitions" not in target.options
    source = tls_topic(
        "ssl://host:1", "t", "c.pem", "k.pem", "ca.pem", "https://host:2", True, "sub"
    )
    assert source.options["topics"] == "t" and source.options["minPartitions"] == "20"
    assert source.options["predefinedSubscription"] == "sub"
    assert target.with_options(queue="1").options["queue"] == "1"


def test_folder_topic_reads_text(spark, tmp_path):
    (tmp_path / "m.txt").write_text("a\nb\n")
    assert read_topic(spark, folder_topic(str(tmp_path))).count() == 2


def test_shared_folder_is_under_the_checkpoint_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one.startswith(f"{root}/x-") and one != two
