"""The generated series of messages that an ingest test sends, with what must become of them."""

from pyspark.sql import functions as F

from sensorflow.functions.quality import passes_gate, record_quality
from sensorflow.operators import clean, quality, records, stats
from sensorflow.sources import topics
from sensorflow.streaming import jobs


def series(spark, n, first, rises, motors, fail_every, extra=()):
    """`n` messages; a value rises with the number of the message, modulo its period."""
    i = F.col("id")
    names = [f"sensor{k}" for k in (1, 2, 3)] + [f"motor{k}" for k in (1, 2, 3)]
    rising = lambda start, period: start + (i % period if period else i * 10)
    values = [rising(*x).alias(c) for c, x in zip(names, [*zip(first, rises), *motors])]
    text = F.to_json(F.struct(
        F.concat(F.lit("2024-01-15T14:"), F.lpad(i.cast("string"), 2, "0"), F.lit(":00")).alias("time"),
        (i % 5 + 1).alias("DeviceId"), *values, (i % fail_every == 0).alias("isFail"), *extra))
    return spark.range(n).select(
        i.cast("string").alias("key"), text.alias("value"), F.timestamp_seconds(i).alias("timestamp"))


def test_batch_of_a_thousand(spark):
    messages = series(spark, 1000, (80, 50, 100), (20, 30, 50), [(1100, 100), (700, 80), (900, 90)], 10)
    decoded = topics.well_formed(topics.decode(topics.envelope(messages)))
    cleaned = clean.clean(decoded)
    # The minute is the number of the message: readable up to 59, and from 100 on the text is cut to two digits.
    readable = sum(1 for i in range(1000) if int(str(i)[:2].rjust(2, "0")) < 60)
    assert cleaned.filter("event_time is not null").count() == readable
    assert decoded.filter(passes_gate()).count() == 20
    assert decoded.filter(record_quality()["quality_score"] == 1.0).count() == 1000
    assert quality.validity_summary(decoded).first().validity_rate == 1.0
    assert stats.failure_share(decoded).agg(F.sum("failures")).first()[0] == 100


def test_ten_messages_with_extra_fields(spark):
    extra = (F.lit("t-1").alias("test_id"), F.lit("integrity").alias("test_type"))
    messages = series(spark, 10, (80, 50, 100), (100, 100, 100), [(1100, None), (700, None), (900, None)], 3, extra)
    decoded = topics.decode(topics.envelope(messages))
    assert "test_id" not in decoded.columns and topics.malformed(decoded).count() == 0
    done = records.transform(topics.well_formed(decoded))
    assert done.count() == 10 and done.filter("isFail").count() == 4
    assert {r.DeviceId for r in done.select("DeviceId").collect()} == {1, 2, 3, 4, 5}


def test_five_hundred_messages_per_second(spark):
    messages = series(spark, 500, (75, 45, 95), (20, 30, 50), [(1050, 100), (650, 80), (850, 90)], 15)
    rates = stats.rate_per_window(messages, 100, "timestamp")
    assert [r.messages for r in rates.collect()] == [100] * 5
    assert {r.messages_per_second for r in rates.collect()} == {1.0}


def test_unknown_device_is_rejected(spark):
    rows = spark.createDataFrame([("k", '{"time":"2024-01-15T14:00:00","DeviceId":999}', None)],
                                 "key string, value string, timestamp timestamp")
    assert clean.only_known_devices(topics.decode(rows)).count() == 0


def test_keyword_messages(spark):
    texts = ["hello", "please filter this", "filter", "nothing here", "a filtered message"]
    rows = spark.createDataFrame([(str(n), t, None) for n, t in enumerate(texts)],
                                 "key string, value string, timestamp timestamp")
    assert sorted(r.key for r in jobs.keyword_messages(rows, "filter").collect()) == ["1", "2", "4"]
    assert [r.word_count for r in jobs.message_view(rows).collect()] == [1, 3, 1, 2, 3]
