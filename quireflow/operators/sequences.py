"""Operators on ordered rows: islands, ledgers, tiles, ranges, nearest rows, packing."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from ..storage import Scratch


def islands(df: DataFrame, by: list[str], order: list[str], gap: Column) -> DataFrame:
    """``df`` with ``island``, from 1: a row begins a new one where ``gap`` holds, an expression that may use ``_prev`` (the last row as a struct)."""
    w = Window.partitionBy(*by).orderBy(*order)
    new = df.withColumn("_prev", F.lag(F.struct(*df.columns)).over(w)).withColumn("_new", F.coalesce(gap, F.lit(True)).cast("int"))
    return new.withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_prev", "_new")


def integer_ranges(df: DataFrame, by: list[str], number: str) -> DataFrame:
    """(by, range_start, range_end): the maximal runs of consecutive distinct numbers."""
    w = Window.partitionBy(*by).orderBy(number)
    runs = df.select(*by, number).dropna().distinct().withColumn("_run", F.col(number) - F.row_number().over(w))
    return runs.groupBy(*by, "_run").agg(F.min(number).alias("range_start"), F.max(number).alias("range_end")).drop("_run")


def missing_numbers(df: DataFrame, by: list[str], number: str) -> DataFrame:
    """(by, missing): the numbers between least and greatest that do not occur; made from the gaps between neighbours."""
    w = Window.partitionBy(*by).orderBy(number)
    gaps = df.select(*by, number).dropna().distinct().withColumn("_next", F.lead(number).over(w)).filter(F.col("_next") > F.col(number) + 1)
    return gaps.select(*by, F.explode(F.sequence(F.col(number) + 1, F.col("_next") - 1)).alias("missing"))


def ledger_errors(df: DataFrame, by: list[str], order: list[str], number: str) -> DataFrame:
    """(by, at, expected, actual): rows whose number is not one more than the last; the first row of a context never fails."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_at", F.row_number().over(w)).withColumn("expected", F.lag(number).over(w) + 1).filter(F.col("expected") != F.col(number)).select(*by, F.col("_at").alias("at"), "expected", F.col(number).alias("actual"))


def tiling_errors(df: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """(by, at, kind): where ranges do not tile their context: gap, overlap or reversed."""
    w = Window.partitionBy(*by).orderBy(start, end)
    seen = df.withColumn("_reach", F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    kind = F.when(F.col(end) < F.col(start), "reversed").when(F.col(start) > F.col("_reach") + 1, "gap").when(F.col(start) <= F.col("_reach"), "overlap")
    return seen.select(*by, F.col(start).alias("at"), kind.alias("kind")).filter("kind is not null")


def uncovered_ranges(df: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """(by, range_start, range_end): maximal ranges that no range covers, between the least start and the greatest end."""
    w = Window.partitionBy(*by).orderBy(start, end)
    seen = df.dropna(subset=[start, end]).filter(F.col(end) >= F.col(start)).withColumn("_reach", F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    return seen.filter(F.col(start) > F.col("_reach") + 1).select(*by, (F.col("_reach") + 1).alias("range_start"), (F.col(start) - 1).alias("range_end"))


def level_ranges(df: DataFrame, by: list[str], order: str, level: str, last: Column, levels: range = range(1, 7)) -> DataFrame:
    """``df`` with ``range_end``: up to the row before the next one of the same or a higher level, else ``last``.

    The next row of each level is looked up by one window for all levels together, so
    no row is joined with those behind it.
    """
    # from the end, so that the least of the rows behind is a running minimum and no frame is read again
    w = Window.partitionBy(*by).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    nexts = {k: F.min(F.when(F.col(level) == k, F.col(order))).over(w) for k in levels}
    end = F.lit(None).cast("long")
    for k in levels:
        end = F.when(F.col(level) == k, F.least(*[nexts[j] for j in levels if j <= k], F.lit(None)) if k > levels[0] else nexts[k]).otherwise(end)
    return df.withColumn("range_end", F.coalesce(end - 1, last))


def last_before(df: DataFrame, by: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """``df`` with the last non-null ``value`` of an earlier row of its context: a join with the nearest prior row, in one sort."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def occurrence(df: DataFrame, by: list[str], order: list[str], name: str = "occurrence") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(rank) <= k)


def pack(df: DataFrame, by: list[str], order: str, size: str, most: int, schema: str) -> DataFrame:
    """Greedy packing of consecutive rows into packets of at most ``most``; a larger row is a packet of its own.

    The fold is sequential within a context; contexts run in parallel. Sorted rows pass in
    Arrow batches whatever contexts they belong to, and only the last packet is held, so neither
    many small contexts nor a huge one cost more than their rows. Rows alike in ``order`` follow
    each other by their other columns. ``schema`` is that of ``df`` with ``packet int`` at the end.
    """
    fields = StructType.fromDDL(schema).fields[:-1]
    ties = [F.col(c).asc_nulls_last() for c in (order, size, *(f.name for f in fields if f.name not in (*by, order, size) and not isinstance(f.dataType, MapType)))]
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in fields])
    # sorted by contexts, which a window tells apart (nulls and NaN included); what follows keeps the order
    begun = rows.withColumn("_first", F.row_number().over(Window.partitionBy(*by).orderBy(*ties)) == 1)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packet, held = 0, 0
        for batch in batches:
            sizes = batch.column(size).to_pandas().fillna(0).tolist()
            packets = []
            for first, n in zip(batch.column("_first").to_pylist(), sizes):
                if first:
                    packet, held = 1, n
                elif held + n > most:
                    packet, held = packet + 1, n
                else:
                    held += n
                packets.append(packet)
            kept = [f.name for f in fields]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(packets, pa.int32())], [*kept, "packet"])

    return begun.mapInArrow(fold, schema)


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with the rank, from 1, in one order over all rows, and no task that takes them all.

    Rows are split by ranges of the order and written; each range is numbered by itself
    and starts behind the rows of the ranges before it.
    """
    scratch = Scratch(df.sparkSession, "rank")
    split = scratch.put(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "split")
    sizes = split.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # as many rows as there are partitions
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    return split.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.row_number().over(Window.partitionBy("_part").orderBy(*order))).drop("_part", "_start")


def balance_lanes(df: DataFrame, key: str, size: str, lanes: int) -> DataFrame:
    """(key, lane): rows dealt in order of size in turns that go back and forth, so that lanes differ by little."""
    at = F.col("_rank") - 1
    turn, place = F.floor(at / lanes), at % lanes
    return global_rank(df.select(key, size), [F.desc(size), F.col(key)], "_rank").select(key, F.when(turn % 2 == 0, place).otherwise(lanes - 1 - place).cast("int").alias("lane"))


def int_percentile(values: Column, p: float) -> Column:
    """The value at the whole part of (n - 1) * p of the sorted array."""
    s = F.array_sort(values)
    return F.element_at(s, (F.floor((F.size(s) - 1) * F.lit(p)) + 1).cast("int"))
