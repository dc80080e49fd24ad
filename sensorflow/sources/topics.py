"""Topic messages: scan, envelope, payload."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorflow.functions.basic import any_of, computed_once
from sensorflow.functions.cleaning import sentinel_to_null
from sensorflow.schema import MOTORS, READING

CORRUPT = "_corrupt"


def topic_stream(spark: SparkSession, servers: str, topic: str, start: str = "latest", per_trigger: int | None = None,
                 **options) -> DataFrame:
    """A topic as a stream. Progress is kept by the checkpoint of the query that reads it, not by a group id."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", topic).option("startingOffsets", start)
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.options(**options).load()


def topic_batch(spark: SparkSession, servers: str, topic: str, start: str = "earliest", end: str = "latest") -> DataFrame:
    """A bounded part of a topic; `start` and `end` may be JSON offsets per partition."""
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.option("startingOffsets", start).option("endingOffsets", end).load()


def file_stream(spark: SparkSession, path: str, schema: StructType, kind: str = "json",
                files_per_trigger: int | None = None, **options) -> DataFrame:
    """Landing files as a stream, with a bounded number of files per micro-batch."""
    reader = spark.readStream.format(kind).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.options(**options).load(path)


def envelope(df: DataFrame, keep=()) -> DataFrame:
    return df.select(*keep, F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")


def decode(df: DataFrame, schema: StructType = READING, keep=()) -> DataFrame:
    """JSON payloads to columns. Unknown fields are dropped; a field of the wrong type, or a motor speed that is no
    whole number of 32 bits, is NULL and the rest of the record stands. What is no JSON object at all (other text, other
    JSON, an empty or missing payload) is kept as text in `_corrupt`, a missing one as empty text."""
    parsed = computed_once(df, {"_text": F.col("value").cast("string"), "_record": F.from_json(F.col("value").cast("string"), schema)}, keep)
    fields = {f: F.col("_record")[f] for f in schema.names}
    # Only a record without any field is looked at again: it may be an object all the same. NaN is no strict JSON, but the
    # fields beside it can be read.
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json("_text")).startswith("OBJECT"), F.lit(False))
    bad = F.when(any_of(f.isNotNull() for f in fields.values()), None).when(~is_object, F.coalesce("_text", F.lit("")))
    kept = parsed.columns[:-2]
    flat = parsed.select(*(F.col(f"`{c}`") for c in kept), *(f.alias(n) for n, f in fields.items()), bad.alias(CORRUPT))
    return flat.withColumns({m: F.round(m).try_cast("int") for m in MOTORS if m in schema.names})


def well_formed(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def malformed(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(CORRUPT).isNotNull())


def without_sentinels(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: sentinel_to_null(c) for c in columns})


def to_messages(df: DataFrame, key: str = "DeviceId", fields=None) -> DataFrame:
    """Key and JSON value of a topic sink."""
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*(fields or df.columns))).alias("value"))
