"""Nearest neighbours by cosine with a permutation index.

A vector is represented by its permutation: the places of the pivots when they are ordered by nearness to it, places from
`prefix` on counting as `prefix`. It is posted, with its permutation, in the inverted file of each of its first `posts`
pivots. A query probes the files of its first `probes` pivots and ranks what they hold by footrule, the sum of the differences
of places. What lies within the query's bound is compared by the cosine of the original vectors.

The bound is a footrule distance, not a number of rows: the one within which `share` of a sample of the table lies. Near copies
have nearly equal permutations and lie within it together, however many they are. Pivots are picked apart from each other, so
that a group of copies doesn't take many of them and shift the places of the others.

Files are split into parts of about PART_ROWS postings and queries of a file into blocks of about QUERY_ROWS, so a task holds
one block of queries and a batch of postings. A pair that meets in several files is ranked in the one whose pivot is nearest
to the query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorflow.llm.tasks import arrow_schema, record_batch, written

PART_ROWS = 4096
QUERY_ROWS = 2048
SAMPLE = 2048  # vectors of each length on the driver: pivots and the bounds of queries come from them
APART = (0.7, 0.9, 0.99, 2.0)  # largest cosine between two pivots, tried in turn until there are enough


@dataclass(frozen=True)
class Settings:
    """`pivots` bounds what is broadcast; `least` rows at least are within the bound of a query, if the table has them."""

    neighbours: int = 5
    every: int = 50
    pivots: int = 256
    prefix: int = 128
    posts: int = 8
    probes: int = 32
    share: float = 0.1
    least: int = 1000


class Index(NamedTuple):
    """Of one length of vectors: pivots, and the permutations of the sample."""

    centres: np.ndarray
    sample: np.ndarray
    share: float


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (doubles) and class: rows whose vector is not null, empty or zero and has finite components only.

    Where lengths differ, each length is searched on its own.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).filter("vec_id IS NOT NULL AND vector IS NOT NULL")
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.filter(good)
    return rows.withColumn("class", F.sha2(F.to_json(F.struct("vector")), 256))


def search(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id, score, compared: the nearest other rows of every row whose vec_id is divisible by `every`, and
    the number of different vectors the query was compared with by cosine.

    Scores are cosines in double precision; ties go to the smaller vec_id. Equal vectors are searched once, with their
    smallest ids (as many as can be asked for) standing for all of them, which loses nothing. A vec_id that occurs with
    several vectors is a row for each of them, and never a neighbour of itself. With fewer candidates, all are returned.
    Rows without a vec_id take no part; extra columns are ignored.
    """
    k = settings.neighbours
    rows = written(usable(vectors), "vectors")
    order = Window.partitionBy("class").orderBy("vec_id")
    # One more than asked for, since a query is not its own neighbour. Cut before the shuffle by the group limit.
    first = rows.select("class", "vec_id").distinct().withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    first = written(first, "first")
    heads = first.filter("place = 1").select("class", "vec_id")
    distinct = written(rows.join(heads, ["class", "vec_id"], "left_semi").dropDuplicates(["class"]), "classes")
    queries = rows.filter(F.col("vec_id") % settings.every == 0).select("class", F.col("vec_id").alias("query_id")).distinct()
    asked = distinct.join(queries.select("class").distinct(), "class", "left_semi")

    near = written(_near_classes(distinct, asked, settings), "near")  # at most k + 1 classes for each
    compared = near.groupBy("class").agg(F.max("compared").alias("compared"))
    found = near.join(first.select(F.col("class").alias("other"), "vec_id"), "other").select("class", "vec_id", "score")
    best = Window.partitionBy("class").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("at", F.row_number().over(best)).filter(F.col("at") <= k + 1).drop("at")
    joined = queries.join(found, "class").filter("vec_id <> query_id")
    joined = joined.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = joined.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    ranked = ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    totals = queries.join(compared, "class").groupBy("query_id").agg(F.sum("compared").alias("compared"))
    return ranked.join(totals, "query_id", "left")


def pivot_count(rows: int, most: int) -> int:
    """Fewer for small tables, of which every query then probes every file."""
    return max(1, min(most, rows // 8))


def indexes(distinct: DataFrame, settings: Settings) -> dict[int, Index]:
    """By length: pivots and bounds from vectors picked by a hash, SAMPLE of each length at most and one at least."""
    slots = 1 << 30
    rows = distinct.select(F.size("vector").alias("size"), "class", "vector")
    totals = {r.size: r["count"] for r in rows.groupBy("size").count().collect()}  # one row for each length
    if not totals:
        return {}
    bounds = rows.sparkSession.createDataFrame([(size, min(slots, slots * SAMPLE // total + 1)) for size, total in totals.items()], "size int, bound long")
    picked = rows.join(F.broadcast(bounds), "size").filter(F.pmod(F.xxhash64(F.lit("pivot"), "class"), F.lit(slots)) < F.col("bound"))
    at = F.row_number().over(Window.partitionBy("size").orderBy(F.xxhash64("class"), "class"))
    found: dict[int, list] = {}
    for r in picked.withColumn("at", at).filter(F.col("at") <= SAMPLE).orderBy("size", "at").collect():
        found.setdefault(r.size, []).append(r.vector)
    missing = [size for size in totals if size not in found]
    if missing:
        firsts = rows.join(F.broadcast(bounds.filter(F.col("size").isin(missing))), "size", "left_semi")
        for r in firsts.groupBy("size").agg(F.min_by("vector", "class").alias("vector")).collect():
            found[r.size] = [r.vector]
    made = {}
    for size, vectors in found.items():
        sample = np.array(vectors, float)
        centres = pivots(normal(sample), pivot_count(totals[size], settings.pivots))
        share = max(settings.share, settings.least / totals[size])
        made[size] = Index(centres, places(sample, centres, settings.prefix), share)
    return made


def pivots(units: np.ndarray, count: int) -> np.ndarray:
    """The first `count` vectors that lie apart from those before them; closer ones if these are too few."""
    chosen: list[int] = []
    nearest = np.full(len(units), -np.inf)
    for most in APART:
        for i in range(len(units)):
            if len(chosen) < count and nearest[i] < most and i not in chosen:
                chosen.append(i)
                nearest = np.maximum(nearest, units @ units[i])
    return units[chosen]


def normal(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled first, so that squares neither overflow nor vanish."""
    small = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return small / np.linalg.norm(small, axis=1, keepdims=True)


def places(vectors: np.ndarray, centres: np.ndarray, prefix: int) -> np.ndarray:
    """Place of each pivot in the order of nearness to each vector, `prefix` at most; ties by number."""
    order = np.argsort(-(normal(vectors) @ centres.T), axis=1, kind="stable")
    found = np.empty(order.shape, np.uint8 if prefix < 256 else np.uint16)
    np.put_along_axis(found, order, np.minimum(np.arange(len(centres)), prefix).astype(found.dtype)[None, :], 1)
    return found


def footrule(some: np.ndarray, one: np.ndarray) -> np.ndarray:
    return (np.maximum(some, one) - np.minimum(some, one)).sum(axis=1, dtype=np.int64)


def _near_classes(distinct: DataFrame, asked: DataFrame, settings: Settings) -> DataFrame:
    """class, other, score, compared: the nearest classes of each asked class, itself among them.

    A query that found fewer than there are, which takes a table where nothing near shares a pivot, is compared with all.
    """
    found = written(_probed(distinct, asked, settings), "probed")
    most = settings.neighbours + 1
    enough = distinct.groupBy(F.size("vector").alias("size")).agg(F.least(F.count("*"), F.lit(most)).alias("enough"))
    got = found.groupBy("class").agg(F.count("*").alias("got"))
    short = asked.join(got, "class", "left").withColumn("size", F.size("vector")).join(F.broadcast(enough), "size")
    short = short.filter(F.coalesce("got", F.lit(0)) < F.col("enough")).select(*asked.columns)
    short = written(short, "short")
    if short.isEmpty():
        return found
    rest = _probed(distinct, short, replace(settings, probes=settings.pivots, share=1.0))
    return found.join(short, "class", "left_anti").unionByName(rest)


def _probed(distinct: DataFrame, asked: DataFrame, settings: Settings) -> DataFrame:
    spark = distinct.sparkSession
    made = indexes(distinct, settings)
    if not made:
        return distinct.select("class", F.col("class").alias("other"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("compared"))
    known = spark.sparkContext.broadcast(made)
    file = ["size", "file"]
    posted = written(_posted(distinct, known, settings, settings.posts), "postings")
    probing = written(_posted(asked, known, settings, settings.probes), "probing")
    # Parts and blocks of each file that is probed, from counts: at most one row for each pivot of each length.
    whole = lambda n, rows: (F.floor((F.count("*") - 1) / rows) + 1).cast("int").alias(n)
    sizes = F.broadcast(posted.groupBy(*file).agg(whole("parts", PART_ROWS)).join(probing.groupBy(*file).agg(whole("blocks", QUERY_ROWS)), file))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    by_hash = lambda n: F.pmod(F.xxhash64("class"), n).cast("int")
    entries = posted.join(sizes, file).withColumn("part", by_hash("parts")).withColumn("block", each("blocks")).withColumn("kind", F.lit(1))
    questions = probing.join(sizes, file).withColumn("block", by_hash("blocks")).withColumn("part", each("parts")).withColumn("kind", F.lit(0))
    key = [*file, "part", "block"]
    dealt = entries.unionByName(questions).repartition(*key).sortWithinPartitions(*key, "kind")
    schema = "class string, other string, vec_id long, score double, compared long"
    found = dealt.select(*key, "kind", "class", "vec_id", "vector", "places", "bound").mapInArrow(
        lambda batches: _searched(batches, settings, schema), schema)
    found = written(found, "compared")  # read twice
    of_class = Window.partitionBy("class")
    total = found.filter("other IS NULL").groupBy("class").agg(F.sum("compared").alias("compared"))
    best = found.filter("other IS NOT NULL").withColumn("at", F.row_number().over(of_class.orderBy(F.desc("score"), "vec_id")))
    return best.filter(F.col("at") <= settings.neighbours + 1).select("class", "other", "score").join(total, "class")


def _posted(rows: DataFrame, known: Broadcast, settings: Settings, files: int) -> DataFrame:
    """A row for each of the first `files` pivots of a vector, with its permutation and the bound it has as a query."""
    schema = "class string, vec_id long, vector binary, size int, file int, places binary, bound long"
    kinds = arrow_schema(schema)

    def bound(one: np.ndarray, index: Index) -> int:
        away = np.sort(footrule(index.sample, one))
        return int(away[min(len(away) - 1, int(index.share * len(away)))]) if index.share < 1 else 1 << 62

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(2).value_lengths()
            for size in sorted(set(lengths.to_pylist())):
                same = batch.filter(pc.equal(lengths, size))
                index = known.value[size]
                vectors = same.column(2).flatten().to_numpy(zero_copy_only=False).reshape(same.num_rows, size)
                at = places(vectors, index.centres, settings.prefix)
                firsts = np.argsort(at, axis=1, kind="stable")[:, :files].tolist()
                bounds = [bound(one, index) for one in at] if files == settings.probes else [0] * len(at)
                yield record_batch([
                    (name, vec_id, v.tobytes(), size, file, one.tobytes(), most) for name, vec_id, v, first, one, most in zip(
                        same.column(0).to_pylist(), same.column(1).to_pylist(), vectors, firsts, at, bounds, strict=True)
                    for file in first], kinds)

    return rows.select("class", "vec_id", "vector").mapInArrow(post, schema)


def _searched(batches: Iterator[pa.RecordBatch], settings: Settings, schema: str) -> Iterator[pa.RecordBatch]:
    """Rows come part by part, queries first. Holds the queries of a block with their best so far, and one batch of postings."""
    kinds = arrow_schema(schema)
    most = settings.neighbours + 1
    kind = np.uint8 if settings.prefix < 256 else np.uint16
    part, queries = None, []

    def answers() -> Iterator[pa.RecordBatch]:
        out = []
        for q in queries:
            out.append((q.name, None, None, None, q.compared))
            out += [(q.name, c, int(i), float(s), None) for s, i, c in zip(*q.best, strict=True)]
            if len(out) >= 1000:
                yield record_batch(out, kinds)
                out = []
        if out:
            yield record_batch(out, kinds)
        queries.clear()

    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy() for i in range(5)])
        edges = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
        for a, b in zip([0, *edges], [*edges, keys.shape[1]], strict=True):
            if a == b:
                continue
            if (now := tuple(keys[:4, a].tolist())) != part:
                yield from answers()
                part = now
            piece = batch.slice(a, b - a)
            names, ids = piece.column(5).to_pylist(), piece.column(6).to_numpy()
            vectors = np.frombuffer(b"".join(piece.column(7).to_pylist()), "<f8").reshape(len(piece), -1)
            at = np.frombuffer(b"".join(piece.column(8).to_pylist()), kind).reshape(len(piece), -1)
            if keys[4, a] == 0:
                queries += [_Query(n, v, p, int(m), most) for n, v, p, m in zip(names, vectors, at, piece.column(9).to_pylist(), strict=True)]
                continue
            names = np.array(names, object)
            firsts = np.argsort(at, axis=1, kind="stable")[:, :settings.posts]
            for q in queries:
                q.look(part[1], names, ids, vectors, at, firsts)
    yield from answers()


class _Query:
    def __init__(self, name: str, vector: np.ndarray, at: np.ndarray, bound: int, most: int):
        self.name, self.vector, self.at, self.bound, self.most = name, vector, at, bound, most
        self.order = np.argsort(np.argsort(at, kind="stable"), kind="stable")  # places without ties
        self.best: tuple[np.ndarray, ...] = (np.empty(0), np.empty(0, np.int64), np.empty(0, object))
        self.compared = 0

    def look(self, file: int, names: np.ndarray, ids: np.ndarray, vectors: np.ndarray, at: np.ndarray, firsts: np.ndarray) -> None:
        """Ranks the postings that this file is the nearest for, and compares those within the bound."""
        here = np.flatnonzero(self.order[firsts].min(axis=1) == self.order[file])
        near = here[footrule(at[here], self.at) <= self.bound]
        if not len(near):
            return
        self.compared += len(near)
        new = cosines(self.vector, vectors[near]), ids[near], names[near]
        scores, ids, names = (np.concatenate(x) for x in zip(self.best, new, strict=True))
        keep = np.lexsort((ids, -scores))[:self.most]
        self.best = scores[keep], ids[keep], names[keep]


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """In double precision; equal to the plain formula wherever that does not overflow or vanish."""
    def length(rows: np.ndarray) -> np.ndarray:
        return np.sqrt((rows * rows).sum(axis=-1))

    with np.errstate(all="ignore"):
        plain = (vectors * query).sum(axis=1) / (length(vectors) * length(query))
    odd = ~np.isfinite(plain)
    if odd.any():
        plain[odd] = normal(vectors[odd]) @ normal(query[None, :])[0]
    return plain
