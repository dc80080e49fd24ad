"""Layers with snapshots: a batch is seen in all layers or in none.

    root/data/{layer}/commit={id}/...      files, written once and never changed
    root/manifests/{id}                    the files of all layers after a commit: layer, part, file, bytes, rows
    root/commits/{version}.json            names the manifest; moved into place last

What no commit names is not seen, so a writer that dies between two layers leaves only unused files. A keyed layer is merged
part by part: parts the batch doesn't touch keep their files, and reading never ranks history. There is one writer at a time
for a root; readers need no lock and can go back to any version that was not expired.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorflow.operators.records import alerts, process, quality_metrics
from sensorflow.schema import CODEC_BY_LAYER
from sensorflow.sinks.layers import DAY_PARTS, with_date_parts

FILES = "layer string, part string, file string, bytes bigint, rows bigint"
PART = "part_"  # folders are named by copies of the columns, so the files keep columns and types as they were
TARGET_BYTES = 128 << 20


@dataclass(frozen=True)
class Layer:
    """A layer is appended to, or with `keys` holds the newest row of each key by `order`. The part of a row must follow from
    its key: `partition_by` are key columns then, and `buckets` deals the keys of a large part."""

    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    buckets: int = 0
    kind: str = "parquet"
    codec: str | None = None

    def __post_init__(self):
        if self.keys and not set(self.partition_by) <= set(self.keys):
            raise ValueError("parts of a keyed layer are made of key columns")

    @property
    def parts(self) -> list[str]:
        return [PART + c for c in self.partition_by] + ([PART + "bucket"] if self.buckets else [])

    def placed(self, df: DataFrame) -> DataFrame:
        made = {PART + c: F.col(c).cast("string") for c in self.partition_by}
        if self.buckets:
            made[PART + "bucket"] = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("string")
        return df.withColumns(made) if made else df

    def part(self) -> Column:
        return F.to_json(F.array(*(F.col(p) for p in self.parts))) if self.parts else F.lit("[]")

    def parts_of(self, placed: DataFrame) -> DataFrame:
        """The parts that occur, named once each and not once a row."""
        if not self.parts:
            return placed.select(self.part().alias("part")).distinct()
        return placed.select(*self.parts).distinct().select(self.part().alias("part"))

    def newest(self, df: DataFrame) -> DataFrame:
        """The rank limit is applied before the shuffle: copies of one key shrink to one per task."""
        by = Window.partitionBy(*self.keys).orderBy(*(F.desc(c) for c in self.order))
        return df.withColumn("_rank", F.row_number().over(by)).filter("_rank = 1").drop("_rank")


@dataclass(frozen=True)
class Snapshots:
    spark: SparkSession
    root: str
    layers: dict[str, Layer] = field(default_factory=dict)

    # --- writing

    def write(self, tables: dict[str, DataFrame], run: str, batch: int) -> int:
        """Adds a batch to its layers and returns the version that shows it. A batch of a run that is committed already is
        not written again, so it may be replayed after any failure."""
        head = self.head()
        if head["runs"].get(run, -1) >= batch:
            return head["version"]
        before = self.manifest(head["version"])
        schemas, gone, added = dict(head["schemas"]), {}, []
        for name, table in tables.items():
            layer = self.layers[name]
            files, touched = self._write_layer(name, layer, table, before if name in schemas else None)
            added.append(files)
            if touched is not None:
                gone[name] = touched
            schemas[name] = table.schema.jsonValue()
        replaced = [t.select(F.lit(name).alias("layer"), "part") for name, t in gone.items()]
        kept = before.join(_all(replaced), ["layer", "part"], "left_anti") if replaced else before
        version = self._commit(head, kept.unionByName(_all(added)), head["runs"] | {run: batch}, schemas)
        for table in gone.values():
            table.unpersist()
        return version

    def _write_layer(self, name: str, layer: Layer, table: DataFrame,
                     before: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
        """The files written, and of a keyed layer the parts they replace. `before` is None for a layer that has no files yet.

        The part follows from the key, so the parts are those of the rows as they come; rows of the batch and rows that are
        held are ranked together, once."""
        touched = None
        table = layer.placed(table)
        if layer.keys:
            if before is not None:
                touched = layer.parts_of(table).persist()
                held = self._read(before.filter(F.col("layer") == name).join(touched, "part", "left_semi"), name, StructType(
                    [f for f in table.schema.fields if f.name not in layer.parts]))
                if held is not None:
                    table = table.unionByName(layer.placed(held), allowMissingColumns=True)
            table = layer.newest(table)
        return self._write_files(name, layer, table), touched

    def _write_files(self, name: str, layer: Layer, placed: DataFrame) -> DataFrame:
        base = f"{self.root}/data/{name}"
        path = f"{base}/commit={uuid.uuid4().hex}"
        if layer.parts:
            placed = placed.hint("rebalance", *layer.parts)
        writer = placed.write.format(layer.kind).partitionBy(*layer.parts)
        (writer.option("compression", layer.codec) if layer.codec else writer).save(path)
        # Rows of JSON are lines: they are counted without being parsed.
        lines = layer.kind == "json"
        kinds = StructType().add("value", "string") if lines else StructType(placed.drop(*layer.parts).schema.fields)
        for p in layer.parts:
            kinds = kinds.add(p, "string")
        back = self.spark.read.format("text" if lines else layer.kind).schema(kinds).option("basePath", path).load(path)
        files = back.groupBy(*layer.parts, F.col("_metadata.file_path").alias("file")).agg(
            F.max("_metadata.file_size").alias("bytes"), F.count("*").alias("rows"))
        return files.select(F.lit(name).alias("layer"), layer.part().alias("part"), "file", "bytes", "rows")

    def _commit(self, head: dict, manifest: DataFrame, runs: dict, schemas: dict) -> int:
        version, name = head["version"] + 1, uuid.uuid4().hex
        manifest.coalesce(max(1, 1 + head.get("files", 0) // 100_000)).write.parquet(f"{self.root}/manifests/{name}")
        files = self.spark.read.schema(FILES).parquet(f"{self.root}/manifests/{name}").count()
        text = json.dumps({"version": version, "manifest": name, "files": files, "runs": runs, "schemas": schemas})
        system, place = self._store()
        system.create_dir(f"{place}/commits", recursive=True)
        waiting = f"{place}/commits/_{name}"
        with system.open_output_stream(waiting) as out:
            out.write(text.encode())
        system.move(waiting, f"{place}/commits/{version:012d}.json")
        return version

    # --- reading

    def versions(self) -> list[int]:
        system, place = self._store()
        found = system.get_file_info(fs.FileSelector(f"{place}/commits", allow_not_found=True))
        return sorted(int(f.base_name.removesuffix(".json")) for f in found if f.base_name.endswith(".json"))

    def head(self, version: int | None = None) -> dict:
        known = self.versions()
        if version is None and not known:
            return {"version": 0, "manifest": None, "files": 0, "runs": {}, "schemas": {}}
        system, place = self._store()
        with system.open_input_stream(f"{place}/commits/{version or known[-1]:012d}.json") as file:
            return json.loads(file.read())

    def manifest(self, version: int | None = None) -> DataFrame:
        if version == 0 or not self.versions():
            return self.spark.createDataFrame([], FILES)
        return self.spark.read.schema(FILES).parquet(f"{self.root}/manifests/{self.head(version)['manifest']}")

    def read(self, name: str, version: int | None = None, **parts) -> DataFrame:
        """A layer as of a version, the newest unless one is named. With `parts` (column = value) only files of those parts
        are opened. Costs what the files of the snapshot cost, however many batches made them."""
        head = self.head(version)
        schema = StructType.fromJson(head["schemas"][name])
        files = self.manifest(head["version"]).filter(F.col("layer") == name)
        for column, value in parts.items():
            at = self.layers[name].parts.index(PART + column)
            files = files.filter(F.from_json("part", "array<string>")[at].eqNullSafe(F.lit(value).cast("string")))
        found = self._read(files, name, schema)
        return self.spark.createDataFrame([], schema) if found is None else found

    def _read(self, files: DataFrame, name: str, schema: StructType) -> DataFrame | None:
        """Only names of files come to the driver, as with any listing."""
        paths = [r.file for r in files.select("file").toLocalIterator()]
        if not paths:
            return None
        layer = self.layers[name]
        return self.spark.read.format(layer.kind).schema(schema).load(paths)

    # --- upkeep

    def compact(self, name: str, target_bytes: int = TARGET_BYTES) -> dict:
        """Rewrites the small files (below half of the target) of parts that have several; larger files stay. Returns numbers
        of files and bytes that were rewritten. One commit; readers of older versions are not disturbed."""
        head, layer = self.head(), self.layers[name]
        manifest = self.manifest()
        small = manifest.filter((F.col("layer") == name) & (F.col("bytes") < target_bytes // 2))
        several = small.groupBy("layer", "part").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
        chosen = small.join(several, ["layer", "part"], "left_semi").persist()
        size = chosen.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
        if size.files:
            rows = layer.placed(self._read(chosen, name, StructType.fromJson(head["schemas"][name])))
            added = self._write_files(name, layer, rows if layer.parts else rows.hint("rebalance"))
            kept = manifest.join(chosen.select("file"), "file", "left_anti").select(*added.columns)
            self._commit(head, kept.unionByName(added), head["runs"], head["schemas"])
        chosen.unpersist()
        return size.asDict()

    def expire(self, keep: int = 10) -> int:
        """Forgets all but the newest versions and deletes, in tasks, the files only they had."""
        old = self.versions()[:-keep] if keep else []
        if not old:
            return 0
        kept = _all([self.manifest(v).select("file") for v in self.versions()[-keep:]])
        gone = _all([self.manifest(v).select("file") for v in old]).distinct().join(kept.distinct(), "file", "left_anti")
        gone.foreachPartition(_delete)
        system, place = self._store()
        for version in old:
            name = self.head(version)["manifest"]
            system.delete_file(f"{place}/commits/{version:012d}.json")
            system.delete_dir(f"{place}/manifests/{name}")
        return len(old)

    def _store(self) -> tuple[fs.FileSystem, str]:
        return store(self.root)


def store(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), posixpath.abspath(path))


def _delete(rows) -> None:
    for row in rows:
        system, place = store(row.file)
        if system.get_file_info(place).type == fs.FileType.File:
            system.delete_file(place)


def _all(tables: list[DataFrame]) -> DataFrame:
    made = tables[0]
    for table in tables[1:]:
        made = made.unionByName(table)
    return made


@dataclass(frozen=True)
class SnapshotFanOut:
    """A micro-batch to raw, processed, alert and quality layers, in one commit. A handler for `jobs.each_batch`."""

    root: str
    keys: tuple[str, ...]
    order: tuple[str, ...]
    time: str = "event_time"
    buckets: int = 16

    def snapshots(self, spark: SparkSession) -> Snapshots:
        codec = CODEC_BY_LAYER.get
        return Snapshots(spark, self.root, {
            "raw": Layer(partition_by=DAY_PARTS, codec=codec("raw")),
            "processed": Layer(self.keys, self.order, tuple(k for k in self.keys if k == "DeviceId"), self.buckets, codec=codec("processed")),
            "alerts": Layer(kind="json", codec=codec("alerts")),
            "quality": Layer(codec=codec("quality")),
        })

    def __call__(self, batch: DataFrame, batch_id: int, run: str) -> None:
        batch = batch.persist()
        try:
            processed = process(batch, time=self.time)
            tables = {"raw": with_date_parts(batch, self.time), "processed": processed, "alerts": alerts(processed),
                      "quality": quality_metrics(processed)}
            self.snapshots(batch.sparkSession).write(tables, run, batch_id)
        finally:
            batch.unpersist()
