"""Near-duplicate documents by SetSketch registers, exact on the full shingle sets.

1. One pass over the texts gives each document the hash of its shingle set, the size of the set and one key for each band
   of registers. Documents with equal sets form a class; its smallest doc_id stands for it.
2. Classes that share a band key are in a bucket. Each class is first compared with the bucket minimum it meets most
   often, so a group of many near copies is joined by one link per member, not by all pairs.
3. What is left are classes in one bucket but in different components. All of these pairs are tried, block by block inside
   tasks: equal registers, the joint likelihood of the two sketches, then the full sets.
With 60 bands of 5 registers a pair at the threshold of 0.75 shares no bucket once in ten million; above it, less often.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorflow.llm import setsketch, shingles, tasks
from sensorflow.llm.components import components

PERCENT = 75
SIGNATURE = "doc_id long, set_hash string, n_shingles long, bands array<long>"


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links lead to) and kept, one row per row of `docs`.

    Null and blank texts have no shingles and are linked with nothing. Rows with equal texts are linked. Rows that share a
    doc_id are one document with several texts: what one is linked with, all are. Rows without a doc_id are linked with
    nothing and kept. Extra columns are ignored; no rows give no rows.
    """
    # A copied text is hashed as often as it occurs; only its hash, size and keys are written.
    rows = tasks.written(tasks.map_rows(docs, ["doc_id", "text"], SIGNATURE, lambda: _signatures), "signatures")
    light = tasks.salted(rows.select("doc_id", "set_hash", "n_shingles"), "doc_id")
    sets = light.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = tasks.written(tasks.group_totals(sets, ["set_hash"], class_id=(F.min, F.min, "doc_id")), "classes")
    first = classes.select("set_hash", F.col("class_id").alias("doc_id")).distinct()
    bands = rows.join(first, ["set_hash", "doc_id"], "left_semi").dropDuplicates(["doc_id", "set_hash"])

    members = _members(bands)
    content = _contents(docs, members)
    links = tasks.written(_confirmed(_first_pairs(members), content, percent), "links")
    parts = tasks.written(components(links), "components")
    more = tasks.written(_cross_links(members, parts, content, percent), "links")
    if not more.isEmpty():
        parts = components(links.unionByName(more))

    found = classes.join(parts.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "set_hash", "salt", F.coalesce("component", "class_id").alias("component"))
    joined = light.join(found, ["set_hash", "salt"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).select(
        "*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _signatures(doc_ids, texts):
    for doc_id, text in zip(doc_ids, texts, strict=True):
        elements = shingles.shingle_set(text)
        keys = setsketch.band_keys(setsketch.registers(elements)).tolist() if len(elements) else []
        yield doc_id, hashlib.blake2b(elements.tobytes(), digest_size=16).hexdigest(), len(elements), keys


def _members(bands: DataFrame) -> DataFrame:
    """class_id, band, key and first (the smallest class) for every bucket with several classes."""
    rows = bands.select(F.col("doc_id").alias("class_id"), F.posexplode("bands").alias("band", "key"))
    shared = tasks.written(rows.groupBy("key").agg(F.count("*").alias("size"), F.min("class_id").alias("first"))
                           .filter("size > 1").drop("size"), "buckets")
    return tasks.written(rows.join(shared, "key"), "members")


def _contents(docs: DataFrame, members: DataFrame) -> DataFrame:
    """class_id, text and registers of the classes that share a bucket: the only texts that travel."""
    wanted = members.select("class_id").distinct()
    texts = docs.select(F.col("doc_id").alias("class_id"), "text").join(wanted, "class_id", "left_semi")

    def sketch(class_ids, found):
        for class_id, text in zip(class_ids, found, strict=True):
            yield class_id, text, setsketch.registers(shingles.shingle_set(text)).tobytes()

    return tasks.written(tasks.map_rows(texts, ["class_id", "text"], "class_id long, text string, registers binary", lambda: sketch), "contents")


def _first_pairs(members: DataFrame) -> DataFrame:
    """Each class with the bucket minimum that it shares most buckets with."""
    met = members.filter("first < class_id").groupBy("class_id", "first").count()
    order = Window.partitionBy("class_id").orderBy(F.desc("count"), "first")
    return met.withColumn("at", F.row_number().over(order)).filter("at = 1").select(
        F.col("first").alias("a"), F.col("class_id").alias("b"))


BLOCK_ROWS = 1024


def _cross_links(members: DataFrame, parts: DataFrame, content: DataFrame, percent: int) -> DataFrame:
    """Links between classes in one bucket but in different components.

    Every such pair is tried inside the task that has the bucket, in the first of the buckets that the two share: sizes, equal
    registers, joint likelihood, then the full sets. Only links leave the task, and only one between any two components of a
    bucket, since more say nothing new. A bucket of more than BLOCK_ROWS classes is cut into blocks, and each pair of blocks
    is a task's worth of its own, so no task holds a bucket.
    """
    found = members.join(parts.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "key", "band", "class_id", F.coalesce("component", "class_id").alias("component"))
    sizes = found.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
    open_keys = tasks.written(sizes.filter("low < high").select(
        "key", (F.floor((F.col("size") - 1) / BLOCK_ROWS) + 1).cast("int").alias("blocks")), "open")
    rows = tasks.written(found.join(open_keys, "key"), "open")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("class_id"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    units = rows.select("key", "band", "class_id", "component", "block", other).withColumns(
        {"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")
    columns = ["key", "i", "j", "band", "block", "class_id", "component", "registers", "text"]
    dealt = units.join(content, "class_id").select(*columns).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "block")
    return dealt.mapInArrow(lambda batches: _units(batches, percent), "a long, b long").distinct()


def _units(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    kinds = tasks.arrow_schema("a long, b long")
    held, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:3] != held:
                yield tasks.record_batch(list(_unit_links(held, rows, percent)), kinds)
                held, rows = row[:3], []
            rows.append(row[3:])
    yield tasks.record_batch(list(_unit_links(held, rows, percent)), kinds)


def _unit_links(unit: tuple, rows: list[tuple], percent: int) -> Iterator[tuple[int, int]]:
    """Links that join components, of one block of a bucket or between two; rows are (band, block, class, component, registers, text)."""
    if len(rows) < 2:
        return
    registers = np.frombuffer(b"".join(r[4] for r in rows), np.uint16).reshape(len(rows), -1)
    block, ids, root = (np.array([r[k] for r in rows]) for k in (1, 2, 3))
    band, sets = rows[0][0], [shingles.shingle_set(r[5]) for r in rows]
    sizes = np.array([len(s) for s in sets])
    fewest = setsketch.fewest_equal(percent / 100)
    for at in np.flatnonzero(block == unit[1]).tolist():
        fits = (root != root[at]) & (np.minimum(sizes, sizes[at]) * 100 >= np.maximum(sizes, sizes[at]) * percent)
        fits &= (block == unit[2]) if unit[1] != unit[2] else (np.arange(len(rows)) > at)
        others = np.flatnonzero(fits)
        if not len(others):
            continue
        equal = registers[others] == registers[at]
        near = equal.sum(axis=1) >= fewest
        near &= equal.reshape(len(others), setsketch.BANDS, setsketch.ROWS).all(axis=2).argmax(axis=1) == band
        others = others[near]
        if len(others):
            mine = np.broadcast_to(registers[at], (len(others), registers.shape[1]))
            good = setsketch.plausible(mine, registers[others], np.full(len(others), float(sizes[at])), sizes[others].astype(float), percent / 100)
            for b in others[good].tolist():
                if root[b] != root[at] and _linked(sets[at], sets[b], percent):
                    root[root == root[b]] = root[at]
                    yield min(ids[at], ids[b]).item(), max(ids[at], ids[b]).item()


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = shingles.common(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirmed(pairs: DataFrame, content: DataFrame, percent: int) -> DataFrame:
    """Pairs with percent / 100 of the union of their full shingle sets in common."""
    def check():
        held: dict[str, np.ndarray] = {}

        def elements(text: str) -> np.ndarray:
            if text not in held:
                if len(held) >= 16:
                    held.clear()
                held[text] = shingles.shingle_set(text)
            return held[text]

        def step(a, b, text_a, text_b):
            for i in range(len(a)):
                if _linked(elements(text_a[i]), shingles.shingle_set(text_b[i]), percent):
                    yield a[i], b[i]

        return step

    left, right = (content.select(F.col("class_id").alias(s), F.col("text").alias(f"text_{s}")) for s in "ab")
    joined = tasks.written(pairs, "pairs").join(right, "b").join(left, "a")
    return tasks.map_rows(joined, ["a", "b", "text_a", "text_b"], "a long, b long", check)
