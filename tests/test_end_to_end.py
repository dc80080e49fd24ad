"""From messages to reports."""

from pyspark.sql import functions as F

from sensorflow.plans import end_to_end
from sensorflow.session import work_path
from sensorflow.sources.tables import Tables, messages, readings
from sensorflow.streaming import jobs


def test_messages_to_reports(spark, small):
    root = work_path(spark, "end-to-end")
    stream = messages(readings(Tables(spark, small).stream("events")))
    for query in end_to_end.live(stream, root, every=None):
        jobs.to_end(query)
    total = Tables(spark, small).table("events").count()
    raw, bad = spark.read.parquet(f"{root}/layers/raw"), spark.read.parquet(f"{root}/quarantine")
    assert raw.count() + bad.count() == total and bad.count() == 28

    end_to_end.batch(spark, f"{root}/layers/raw", f"{root}/reports")
    hourly = spark.read.parquet(f"{root}/reports/hourly")
    known = raw.filter("DeviceId is not null").count()
    assert hourly.agg(F.sum("record_count")).first()[0] == known
    assert spark.read.parquet(f"{root}/reports/anomalies").count() == known
    assert spark.read.json(f"{root}/reports/report").first().total_records == raw.count()

    end_to_end.batch(spark, f"{root}/layers/raw", f"{root}/one-day", F.col("day") == 3, F.col("DeviceId") == 2)
    part = spark.read.parquet(f"{root}/one-day/cleaned")
    assert {(r.DeviceId, r.day) for r in part.select("DeviceId", "day").distinct().collect()} == {(2, 3)}
