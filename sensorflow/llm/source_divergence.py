"""How far the sources of a language differ in their words, term by term and pair by pair, in exact arithmetic.

A token carries its language, so document frequencies and the vocabulary are those of each language by itself. The frequencies
are one aggregate over the distinct tokens of each document; the tokens kept are dealt to blocks by hash, and a `CountVectorizer`
without a limit is fitted to each block, so that no vocabulary, on the driver or broadcast, is larger than a block. Its models
make sparse counts of every document, which are summed by group, and pairs of groups are evaluated from the sparse sums.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorflow.llm import tasks
from sensorflow.session import work_path

MIN_DOCUMENTS = 10
TERMS_IN_BLOCK = 1 << 19  # about: bounds a vocabulary
GROUPS_IN_BLOCK = 256  # sources of a language compared at once in a task
TERMS_AT_ONCE = 1 << 12  # rows of terms a task sums in one step
HELD = 1 << 22  # entries of vectors a task adds up before they leave
TOP = 10
UNIT = 1_000_000_000


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP, terms_in_block: int = TERMS_IN_BLOCK,
          groups_in_block: int = GROUPS_IN_BLOCK, terms_at_once: int = TERMS_AT_ONCE) -> DataFrame:
    """lang, source, part, item, value and rank for a table with text, lang and source.

    Part `pair` has each other source of the language with the divergence summed over all kept terms; part `term` the `top`
    terms a source has more of than its language. Null text, lang and source count as ''. Texts are taken whole; an empty
    text, or one without a kept term, still makes its group occur. Every row counts as a document, repeated rows too. Ties
    are ordered by the bytes of the item. Extra columns are left out; an empty table gives no rows.
    """
    spark = docs.sparkSession
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    counts, terms = group_counts(plain, min_documents, terms_in_block)
    of_group = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    whole = tasks.written(counts.groupBy("lang", "term_id").agg(F.sum("count").alias("whole")), "whole")
    of_lang = whole.groupBy("lang").agg(F.sum("whole").alias("all_n"), F.count("*").alias("v"))
    groups = (plain.groupBy("lang", "source").agg(F.lit(1).alias("one")).drop("one")
              .join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").na.fill(0)
              .withColumn("slot", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1))
    groups = tasks.written(groups.withColumn("p0", _share(F.lit(0), F.col("n"), F.col("v"))), "groups")
    shares = counts.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("count"), F.col("n"), F.col("v")))
    shares = tasks.written(shares.select("lang", "source", "slot", "term_id", "p", "all_n", "v"), "shares")
    return pairs(spark, shares, groups, groups_in_block, terms_at_once).unionByName(leading(shares, whole, terms, top))


def _share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(UNIT * (count + 2) / (n + 2 v)), 0 without kept terms; by decimals where the product can leave 64 bits."""
    over = n.cast("long") + 2 * v
    small = F.call_function("div", (count.cast("long") + 2) * UNIT, over)
    large = F.call_function("div", (count.cast("decimal(20,0)") + 2) * UNIT, over.cast("decimal(20,0)"))
    return F.when(over == 0, F.lit(0).cast("long")).when(count < 1 << 32, 1 + small).otherwise(1 + large)


def _distance(p: str, q: str) -> Column:
    return F.expr(f"CASE WHEN {p} + {q} = 0 THEN 0L ELSE ({p} - {q}) * ({p} - {q}) div ({p} + {q}) END")


# --- sparse vectors and their sums ------------------------------------------------------------------------------------

def group_counts(docs: DataFrame, min_documents: int, terms_in_block: int) -> tuple[DataFrame, DataFrame]:
    """(lang, source, term_id, count) of kept terms, and the terms by term_id: both written tables."""
    spark = docs.sparkSession
    tokens = tasks.written(tokenized(docs), "tokens")
    kept = tokens.select(F.explode("terms").alias("token")).groupBy("token").count().filter(F.col("count") >= min_documents)
    kept = tasks.written(kept.select("token"), "kept")
    blocks = 1 + kept.count() // terms_in_block
    of_token = F.pmod(F.crc32(F.col("token").cast("binary")), F.lit(blocks))
    tokens = tokens.select("lang", "source", F.concat("terms", "more").alias("tokens"), F.lit(0).alias("block"))
    if blocks > 1:
        path = work_path(spark, "blocks")
        dealt(tokens, blocks).write.partitionBy("block").parquet(path)
        tokens = spark.read.schema("lang string, source string, tokens array<string>, block int").parquet(path)
    sums, names = work_path(spark, "counts"), work_path(spark, "terms")
    for block in range(blocks):
        vocabulary = kept.filter(of_token == block).select(F.array("token").alias("tokens"))
        _count(tokens.filter(F.col("block") == block), vocabulary, block, sums, names)
    read = spark.read
    return read.schema("lang string, source string, term_id long, count long").parquet(sums), read.schema("term_id long, term string").parquet(names)


def tokenized(docs: DataFrame) -> DataFrame:
    """lang, source, the distinct tokens of every document (terms) and their further occurrences (more).

    A token is term, NUL, lang. Whole Arrow batches are cut at once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                texts, langs, sources = batch.columns
                yield pa.record_batch([langs, sources, *first_and_more(tokens_of(texts, langs))], schema=kinds)

    schema = "lang string, source string, terms array<string>, more array<string>"
    kinds = tasks.arrow_schema(schema)
    return docs.select("text", "lang", "source").mapInArrow(run, schema)


def tokens_of(texts: pa.Array, langs: pa.Array) -> pa.Array:
    """Terms are runs of bytes other than 0x00-0x40, 0x5B-0x60 and 0x7B-0x7F: those become blanks, of which texts are cut."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    plain = (bytes(memoryview(data)[ends[0]:ends[-1]]) if data else b"").translate(_BYTES)
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer((ends - ends[0]).tobytes()), pa.py_buffer(plain))
    cut = pc.ascii_split_whitespace(plain)
    terms = cut.flatten()
    real = pc.greater(pc.binary_length(terms), 0).to_numpy(zero_copy_only=False)  # blanks at either end leave empty ones
    before = np.concatenate([[0], np.cumsum(real)])[np.asarray(cut.offsets) - cut.offsets[0].as_py()]
    own = langs.take(pa.array(np.repeat(np.arange(len(texts)), np.diff(before))))
    tokens = pc.binary_join_element_wise(terms.filter(pa.array(real)).cast(pa.string()), own.cast(pa.string()), "\0")
    return pa.ListArray.from_arrays(pa.array(before, pa.int32()), tokens)


def first_and_more(tokens: pa.ListArray) -> tuple[pa.Array, pa.Array]:
    """Of each list the first of equal tokens, and all others."""
    flat, ends = tokens.flatten(), np.asarray(tokens.offsets)
    coded = flat.dictionary_encode()
    row = np.repeat(np.arange(len(tokens)), np.diff(ends))
    again = pd.Series(row * np.int64(max(len(coded.dictionary), 1)) + coded.indices.to_numpy()).duplicated().to_numpy()

    def those(chosen: np.ndarray) -> pa.Array:
        cut = np.concatenate([[0], np.cumsum(chosen)])[ends]
        return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), flat.filter(pa.array(chosen)))

    return those(~again), those(again)


_BYTES = bytes(32 if b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if b < 0x5B else b for b in range(256))


def dealt(tokens: DataFrame, blocks: int) -> DataFrame:
    """One row for each document and block it has tokens of."""
    def make():
        place = _Places(blocks)

        def step(langs, sources, documents):
            for lang, source, document in zip(langs, sources, documents, strict=True):
                parts: dict[int, list[str]] = {}
                for token in document:
                    parts.setdefault(place[token], []).append(token)
                for block, own in parts.items():
                    yield lang, source, own, block
        return step

    return tasks.map_rows(tokens, ["lang", "source", "tokens"], "lang string, source string, tokens array<string>, block int", make)


class _Places(dict):
    """token -> block; bounded, so a worker's memory does not grow with its input."""

    def __init__(self, blocks: int):
        super().__init__()
        self.blocks = blocks

    def __missing__(self, token: str) -> int:
        made = zlib.crc32(token.encode()) % self.blocks
        if len(token) <= 64:
            if len(self) >= 200_000:
                self.clear()
            self[token] = made
        return made


def _count(tokens: DataFrame, vocabulary: DataFrame, block: int, sums: str, names: str) -> None:
    """Adds a block's group sums and its terms to two tables."""
    spark = tokens.sparkSession
    terms: list[str] = []
    if not vocabulary.isEmpty():
        model = CountVectorizer(inputCol="tokens", outputCol="counts", vocabSize=(1 << 31) - 1).fit(vocabulary)
        terms = model.vocabulary
        summed = group_sums(model.transform(tokens).select("lang", "source", "counts"))
        summed = summed.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"))
    else:
        summed = tokens.filter("false").selectExpr("lang", "source", "0L AS term", "0L AS count")
    summed.select("lang", "source", (F.lit(block << 32) + F.col("term")).alias("term_id"), "count").write.mode("append").parquet(sums)
    kept = pa.table({"term_id": pa.array(range(block << 32, (block << 32) + len(terms)), pa.int64()),
                     "term": pa.array([t.split("\0", 1)[0] for t in terms], pa.string())})
    spark.createDataFrame(kept).write.mode("append").parquet(names)


def group_sums(vectors: DataFrame) -> DataFrame:
    """Sums of sparse vectors by (lang, source), added up in a task before they leave: lang, source, term, count."""
    schema = "lang string, source string, term long, count long"
    kinds = tasks.arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []
        room = HELD

        def summed() -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            counts = np.zeros(len(keys), np.int64)
            np.add.at(counts, at, np.concatenate([c for _, c in held]))
            return keys, counts

        def leave(keys, counts):
            named = [pa.array([g[i] for g in groups], pa.string()) for i in (0, 1)]
            for a in range(0, len(keys), 1 << 16):
                group, term = np.divmod(keys[a:a + (1 << 16)], 1 << 32)
                yield pa.record_batch([*(n.take(pa.array(group)) for n in named), pa.array(term), pa.array(counts[a:a + (1 << 16)])], schema=kinds)

        for batch in batches:
            langs, sources, counts = batch.columns
            number = np.array([groups.setdefault(g, len(groups)) for g in zip(langs.to_pylist(), sources.to_pylist(), strict=True)], np.int64)
            terms, values = counts.field("indices"), counts.field("values")
            sizes = np.diff(np.asarray(terms.offsets))
            key = np.repeat(number << 32, sizes) + terms.flatten().to_numpy()
            held.append((key, values.flatten().to_numpy().astype(np.int64)))
            room -= len(key)
            if room < 0:
                held = [summed()]
                room = HELD - len(held[0][0])
                if room < HELD // 2:
                    yield from leave(*held.pop())
                    room, groups = HELD, {}
        if held:
            yield from leave(*summed())

    return vectors.mapInArrow(run, schema)


# --- pairs of sources -------------------------------------------------------------------------------------------------

def pairs(spark: SparkSession, shares: DataFrame, groups: DataFrame, width: int, at_once: int) -> DataFrame:
    """Part `pair`: sums over all kept terms of the language, from the terms that occur in either source and the rest.

    Sources of a language are compared by blocks. Rows of a term meet in one task with the shares of sources that lack it,
    which come as rows without a term; a task streams over terms and keeps one sum a pair.
    """
    found = _partial(_sides(spark, shares, groups, width), width, at_once).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    side = lambda n: groups.select("lang", F.col("slot").alias(n), F.col("source").alias(f"{n}_source"), F.col("p0").alias(f"{n}_p0"), F.col("v").alias(f"{n}_v"))
    found = found.join(side("a"), ["lang", "a"]).join(side("b"), ["lang", "b"])
    value = F.col("value") + (F.col("a_v") - F.col("seen")) * _distance("a_p0", "b_p0")
    found = found.select("lang", F.explode(F.array(F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("item")),
                                                   F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("item")))).alias("e"), value.alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    found = found.select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    return found.withColumn("rank", F.row_number().over(order).cast("int"))


def _sides(spark: SparkSession, shares: DataFrame, groups: DataFrame, width: int) -> DataFrame:
    """Rows for every pair of source blocks (i <= j) of a language: side 0 for block i, side 1 for block j."""
    buckets = tasks.salts(spark)
    here = (F.col("slot") / width).cast("int")
    blocks = groups.groupBy(F.col("lang").alias("of")).agg((F.max("slot") / width).cast("int").alias("last"))

    def sided(rows: DataFrame) -> DataFrame:
        rows = rows.join(blocks, F.col("lang") == F.col("of"))
        other = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other")
        rows = rows.select("lang", "bucket", "term_id", "slot", "p", here.alias("own"), other)
        return rows.select("lang", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "bucket", "term_id",
                           (F.col("own") > F.col("other")).cast("int").alias("side"), (F.col("slot") % width).alias("slot"), "p")

    terms = sided(shares.withColumn("bucket", F.pmod(F.xxhash64("term_id"), F.lit(buckets)).cast("int")))
    heads = sided(groups.select("lang", "slot", F.col("p0").alias("p"), F.lit(-1).cast("long").alias("term_id"),
                                F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket")))
    key = ["lang", "i", "j", "bucket"]
    return terms.unionByName(heads).repartition(*key).sortWithinPartitions(*key, "term_id", "side", "slot")


def _partial(rows: DataFrame, width: int, at_once: int) -> DataFrame:
    schema = "lang string, a int, b int, value long, seen long"
    kinds = tasks.arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = None
        for key, numbers in _runs(batches):
            if pair is None or pair.key != key:
                if pair:
                    yield pa.record_batch(pair.result(kinds), schema=kinds)
                pair = _BlockPair(key, width, at_once)
            pair.add(numbers)
        if pair:
            yield pa.record_batch(pair.result(kinds), schema=kinds)

    return rows.mapInArrow(run, schema)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray]]:
    """Consecutive rows of one key; columns term_id, side, slot, p."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        langs = batch.column(0).dictionary_encode()
        keys = np.stack([langs.indices.to_numpy(), *(batch.column(c).to_numpy() for c in (1, 2, 3))])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), n]
        numbers = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in (4, 5, 6, 7)])
        for a, b in zip(cuts, cuts[1:], strict=False):
            lang, i, j, bucket = keys[:, a].tolist()
            yield (langs.dictionary[lang].as_py(), i, j, bucket), numbers[:, a:b]


class _BlockPair:
    """Sums of two blocks of sources over the terms of a bucket, which arrive in order behind the shares of absent terms."""

    def __init__(self, key: tuple, width: int, at_once: int):
        self.key, self.width, self.at_once = key, width, at_once
        self.heads: list[np.ndarray] = []
        self.held: list[np.ndarray] = []
        self.absent: list[np.ndarray] | None = None
        self.seen = 0

    def add(self, numbers: np.ndarray) -> None:
        term = numbers[0]
        self.heads.append(numbers[:, term < 0])
        if (later := numbers[:, term >= 0]).size:
            self.begin()
            self.held.append(later)
            if sum(h.shape[1] for h in self.held) >= self.at_once:
                rows = np.concatenate(self.held, axis=1)
                whole = rows[0] < rows[0, -1]  # the last term may go on
                self.held = [rows[:, ~whole]]
                self.sum(rows[:, whole])

    def begin(self) -> None:
        if self.absent is None:
            heads = np.concatenate(self.heads, axis=1)
            sides = (0, 1) if self.key[1] < self.key[2] else (0,)
            self.absent = [heads[3, heads[1] == s] for s in sides]
            self.sums = np.zeros((len(self.absent[0]), len(self.absent[-1])), np.int64)

    def sum(self, rows: np.ndarray) -> None:
        if not rows.size:
            return
        terms, at = np.unique(rows[0], return_inverse=True)
        self.seen += len(terms)
        shares = [np.tile(a, (len(terms), 1)) for a in self.absent]
        for side, share in enumerate(shares):
            own = rows[1] == side
            share[at[own], rows[2, own]] = rows[3, own]
        right = shares[-1]
        for a in range(shares[0].shape[1]):
            p = shares[0][:, a:a + 1]
            self.sums[a] += ((p - right) ** 2 // (p + right)).sum(0)

    def result(self, kinds: pa.Schema) -> list[pa.Array]:
        self.begin()
        if self.held:
            self.sum(np.concatenate(self.held, axis=1))
        lang, i, j, _ = self.key
        a, b = np.indices(self.sums.shape).reshape(2, -1)
        if i == j:
            a, b = a[(later := a < b)], b[later]
        columns = [[lang] * len(a), a + i * self.width, b + j * self.width, self.sums[a, b], np.full(len(a), self.seen)]
        return [pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)]


# --- terms of a source ------------------------------------------------------------------------------------------------

def leading(shares: DataFrame, whole: DataFrame, terms: DataFrame, top: int) -> DataFrame:
    """Part `term`: the terms with the largest divergence among those a source has a larger share of than its language."""
    rows = shares.join(whole, ["lang", "term_id"]).withColumn("q", _share(F.col("whole"), F.col("all_n"), F.col("v")))
    rows = rows.filter("p > q").select("lang", "source", "term_id", _distance("p", "q").alias("value"))
    by = Window.partitionBy("lang", "source")
    rows = rows.withColumn("at", F.rank().over(by.orderBy(F.desc("value")))).filter(F.col("at") <= top)  # ties go on: names decide
    rows = rows.join(terms, "term_id").withColumn("rank", F.row_number().over(by.orderBy(F.desc("value"), "term")).cast("int"))
    return rows.filter(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
