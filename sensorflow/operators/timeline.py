"""Ordered work per device without putting a device into one task.

A window partitioned by device alone would sort and walk each device in a single task, and one device may hold a
third of all rows. Here the order of a device is cut into *chunks*, windows run inside a chunk, and what a chunk
needs from earlier ones (last value, running total, last n rows) is folded level by level:

    rows --partial aggregate--> chunks --aggregate--> groups of chunks --window per device--> what lies before a group
    rows <--join on the chunk-- what lies before a chunk <--join on the group-- window per group

No task holds the chunks of a device: a group has those of 256 cells, and a device one row per group. Rows are shuffled once, by
chunk: the join with the carry and the window want the same partitioning.

A cell is a fixed span of the order (an hour, say). Cells with many rows are cut further at the keys of a sample, every
64th of about 64 per `max_rows` rows, so the number of chunks grows with the rows and neither a hot span nor many copies of
one instant end up in one task. The sample is picked by hash, so a plan that looks twice finds the same cuts; where they fall
only affects balance, and every result is exact for any choice of chunks. Nothing runs before the result is asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from math import ceil

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorflow.functions.basic import micros

CHUNK = ("_cell", "_part")
SAMPLES_PER_SPLIT = 64
HOUR = 3_600_000_000
FAN = 8  # bits: 256 cells in a group


@dataclass(frozen=True)
class Fold:
    """How summaries of consecutive chunks become one. `total` folds a group (an aggregate that is given the column and its
    order), `before` folds the neighbours in front (over a window), `both` joins a fold with the one behind it."""

    total: Callable[[Column, Column], Column]
    before: Callable[[Column, WindowSpec], Column]
    both: Callable[[Column, Column], Column]


SUM = Fold(
    total=lambda c, order: F.sum(c),
    before=lambda c, w: F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)),
    both=lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
LAST = Fold(
    total=lambda c, order: F.max_by(c, F.when(c.isNotNull(), order)),
    before=lambda c, w: F.last(c, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1)),
    both=lambda a, b: F.coalesce(b, a))


def last_rows(n: int) -> Fold:
    """The last n of lists of rows, of which none is empty."""
    def newest(lists: Column) -> Column:
        rows = F.flatten(lists)
        return F.slice(rows, F.greatest(F.size(rows) - n + 1, F.lit(1)), n)

    return Fold(
        total=lambda c, order: newest(F.transform(F.sort_array(F.collect_list(F.struct(order.alias("at"), c.alias("rows")))), lambda x: x["rows"])),
        before=lambda c, w: newest(F.collect_list(c).over(w.rowsBetween(-n, -1))),
        both=lambda a, b: newest(F.filter(F.array(a, b), lambda x: x.isNotNull())))


def scan(per_chunk: DataFrame, key: str, folds: dict[str, Fold]) -> DataFrame:
    """Key, cell, part and, for every summary, the fold of all chunks of the key before this one."""
    grouped = per_chunk.withColumn("_group", F.shiftright("_cell", FAN))
    order = F.struct(*CHUNK)
    groups = grouped.groupBy(key, "_group").agg(*(f.total(F.col(n), order).alias(n) for n, f in folds.items()))
    device, group = W.partitionBy(key).orderBy("_group"), W.partitionBy(key, "_group").orderBy(*CHUNK)
    ahead = groups.select(key, "_group", *(f.before(F.col(n), device).alias(f"_ahead{n}") for n, f in folds.items()))
    inside = grouped.select(key, "_group", *CHUNK, *(f.before(F.col(n), group).alias(n) for n, f in folds.items()))
    both = {n: f.both(F.col(f"_ahead{n}"), F.col(n)) for n, f in folds.items()}
    return inside.join(ahead, [key, "_group"]).withColumns(both).drop("_group", *(f"_ahead{n}" for n in folds))


@dataclass(frozen=True)
class Chunks:
    """Rows with `_pos` (place in the order), `_cell` and `_part` (the chunk)."""

    df: DataFrame
    key: str
    tie: str | None

    @property
    def columns(self) -> list[str]:
        return [self.key, *CHUNK]

    @property
    def order(self) -> list[str]:
        return ["_pos"] + ([self.tie] if self.tie else [])

    def window(self) -> WindowSpec:
        return W.partitionBy(*self.columns).orderBy(*self.order)

    def sort_key(self) -> Column:
        """A plain number where no tie is needed, which keeps the aggregates over it in hash tables."""
        return F.struct(*self.order) if self.tie else F.col("_pos")

    def carry(self, summaries: dict[str, tuple[Column, Fold]]) -> Chunks:
        """Adds, to every row, each summary of its chunk's predecessors, folded."""
        per_chunk = self.df.groupBy(*self.columns).agg(*(c.alias(n) for n, (c, _) in summaries.items()))
        carried = scan(per_chunk, self.key, {n: f for n, (_, f) in summaries.items()})
        return replace(self, df=self.df.join(carried, self.columns, "left"))

    def result(self, *helpers: str) -> DataFrame:
        return self.df.drop("_pos", *CHUNK, *helpers)


def chunked(df: DataFrame, time: str = "event_time", key: str = "DeviceId", tie: str | None = "event_id",
            span: int = HOUR, max_rows: int | None = 5_000_000, position: Column | None = None) -> Chunks:
    """Cuts the order of every `key` into chunks. The order is `time` (span in microseconds) or `position`, any
    whole-number expression (span in its unit); `tie` orders rows of equal position. Rows without key or position
    have no place in an order and are left out. `max_rows` None leaves cells whole."""
    placed = df.withColumn("_pos", micros(time) if position is None else position)
    placed = placed.filter(F.col(key).isNotNull() & F.col("_pos").isNotNull())
    # Never NULL, and known to be: no inferred filter then makes two readings of the chunks differ, which are done as one.
    placed = placed.withColumn("_cell", F.coalesce(F.floor(F.col("_pos") / F.lit(span)), F.lit(0)))
    chunks = Chunks(placed.withColumn("_part", F.lit(0)), key, tie)
    return replace(chunks, df=_split(placed, chunks, max_rows)) if max_rows else chunks


def _split(placed: DataFrame, chunks: Chunks, max_rows: int) -> DataFrame:
    """Cuts each cell at every 64th key of a sample that holds about 64 keys per `max_rows` rows; most cells have none.

    The cuts are broadcast: about one key per `max_rows` rows, 5 MB for 10^12 rows.
    """
    key, order = chunks.key, chunks.order
    chance = min(1.0, SAMPLES_PER_SPLIT / max_rows)
    in_sample = F.pmod(F.xxhash64(*order), F.lit(1 << 30)) < F.lit(ceil(chance * (1 << 30)))
    # Distinct keys only: a split between equal keys would order nothing.
    sample = placed.filter(in_sample).select(key, "_cell", *order).distinct()
    ranked = sample.withColumn("_rank", F.row_number().over(W.partitionBy(key, "_cell").orderBy(*order)))
    splits = ranked.filter(F.col("_rank") % SAMPLES_PER_SPLIT == 0)
    per_cell = splits.groupBy(key, "_cell").agg(F.sort_array(F.collect_list(chunks.sort_key())).alias("_splits"))
    # Two levels (blocks of about the root of their number) keep the search short for a cell with many splits.
    per_cell = per_cell.withColumn("_width", F.ceil(F.sqrt(F.size("_splits"))).cast("int"))
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_splits") - 1) / F.col("_width")).cast("int")),
        lambda i: F.slice("_splits", i * F.col("_width") + 1, F.col("_width")),
    )
    per_cell = per_cell.select(key, "_cell", "_width", blocks.alias("_blocks")).withColumn(
        "_heads", F.transform("_blocks", lambda b: b[0]))
    searched = placed.join(F.broadcast(per_cell), [key, "_cell"], "left")
    here = chunks.sort_key()
    block = F.size(F.filter("_heads", lambda h: h <= here))
    inside = F.size(F.filter(F.get("_blocks", block - 1), lambda s: s <= here))
    part = F.when(block > 0, (block - 1) * F.col("_width") + inside).otherwise(0)
    part = F.when(F.col("_heads").isNull(), 0).otherwise(part)
    return searched.withColumn("_part", F.coalesce(part.cast("int"), F.lit(0))).drop("_blocks", "_heads", "_width")


def previous(chunks: Chunks, columns: dict[str, str]) -> Chunks:
    """Value of each column in the row before, across chunks: {new name: column}."""
    # In a struct: the last row of a chunk counts even where its value is NULL.
    chunks = chunks.carry({f"_last_{n}": (F.max_by(F.struct(F.col(c).alias("v")), chunks.sort_key()), LAST) for n, c in columns.items()})
    first = F.row_number().over(chunks.window()) == 1
    before = {
        n: F.when(first, F.col(f"_last_{n}.v")).otherwise(F.lag(c).over(chunks.window())) for n, c in columns.items()
    }
    return replace(chunks, df=chunks.df.withColumns(before).drop(*(f"_last_{n}" for n in columns)))


def fill_forward(chunks: Chunks, columns: Iterable[str]) -> Chunks:
    """Replaces NULL by the last value before it, across chunks."""
    columns = list(columns)
    summaries = {
        f"_last_{c}": (F.max_by(F.col(c), F.when(F.col(c).isNotNull(), chunks.sort_key())), LAST) for c in columns
    }
    chunks = chunks.carry(summaries)
    upto = chunks.window().rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = {
        c: F.coalesce(F.last(c, ignorenulls=True).over(upto), F.col(f"_last_{c}")) for c in columns
    }
    return replace(chunks, df=chunks.df.withColumns(filled).drop(*summaries))


def running_total(chunks: Chunks, amounts: dict[str, Column]) -> Chunks:
    """Running sum of each amount up to and including the row, across chunks."""
    named = {f"_amount_{n}": a for n, a in amounts.items()}
    chunks = replace(chunks, df=chunks.df.withColumns(named))
    chunks = chunks.carry({f"_sofar_{n}": (F.sum(f"_amount_{n}"), SUM) for n in amounts})
    spec = chunks.window().rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = {
        n: F.coalesce(F.col(f"_sofar_{n}"), F.lit(0)) + F.coalesce(F.sum(f"_amount_{n}").over(spec), F.lit(0))
        for n in amounts
    }
    df = chunks.df.withColumns(totals).drop(*named, *(f"_sofar_{n}" for n in amounts))
    return replace(chunks, df=df)


def with_last_rows(chunks: Chunks, columns: list[str], n: int) -> Chunks:
    """Puts the `n` rows before each chunk into it, marked by `_context`, so that a frame reaching n rows back is whole."""
    names = [*chunks.order, *(c for c in columns if c not in chunks.order)]
    newest = W.partitionBy(*chunks.columns).orderBy(*(F.col(c).desc() for c in chunks.order))
    tails = (
        chunks.df.select(*chunks.columns, *names)
        .withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= n)
        .groupBy(*chunks.columns).agg(F.sort_array(F.collect_list(F.struct(*names))).alias("_tail"))
    )
    before = scan(tails, chunks.key, {"_tail": last_rows(n)})
    context = before.select(*chunks.columns, F.inline("_tail")).withColumn("_context", F.lit(True))
    rows = chunks.df.withColumn("_context", F.lit(False))
    return replace(chunks, df=rows.unionByName(context, allowMissingColumns=True))
