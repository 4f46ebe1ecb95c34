"""Exact medians and median absolute deviations of a sliding time window, for every event of every series.

Time is cut into blocks of the window's length.  The window of an event at ``t`` is then the rest of the block before, from
``t`` less the length on, and the beginning of its own block up to ``t``.  A block's beginnings are the versions of one
persistent counted tree over its values, the rests of the block before those of another; both stand over the same values, so
one descent through the two at once finds the value of any rank in a window.  The median takes two ranks; the values nearest
to it are a run of ranks, whose start is searched by halving, and whose ends are the middle deviations.

A unit is a block with the block before it.  Units of up to ``UNIT`` events are spread over tasks, which read them one after
another.  A larger unit, however hot, is cut into runs of time by ranges; equal values of one time become one entry with a
count.  What lies between a run and the ends of its window, whole runs only, comes as counts of distinct values: sums over
dyadic groups of runs, each run taking one group per binary digit of its number.  These counts are inserted before the run's
own events, so the same trees answer it.  A task then holds a run and the distinct values of an hour, never its events.

Defined results: an id counts once; of rows that repeat an id and differ, the one with the smallest time, then kind, then
value, nulls first.  Rows without a time are dropped; a null id is an id like any other; a null kind is a kind.  A value that
is null, not finite or beyond 2**57 hundredths has no cents, but its event gets a row.  Events of one time are in each other's
windows.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm.store import Table, integral, shuffle_partitions

#: Events of a block and the one before it that one task takes whole; beyond, and for each run of time then.
UNIT = 200_000
#: Events whose trees a task holds at once, about; a unit is never cut here.
HELD = 24_000
_MOST = 2**57


class Trees:
    """Persistent counted trees of many units, level by level in arrays.

    Version ``i`` of level ``l`` is the node on the path of entry ``i``, as it is after that entry came.  A node is named by twice its
    place: there ``children`` has the names of its left and its right child on the next level, side by side, and ``below`` what lies in the left one;
    ``total`` is what lies in a root.  The last place of each array stands for an empty tree.
    """

    def __init__(self, unit: np.ndarray, key: np.ndarray, weight: np.ndarray, levels: int):
        """Entries in order of unit and of insertion."""
        n = len(unit)
        self.children, self.below = [], []
        at = np.arange(n)
        order, group = at, unit
        for level in range(levels):
            first = np.r_[True, group[1:] != group[:-1]] if n else np.zeros(0, bool)
            start = np.maximum.accumulate(np.where(first, at, 0)) if n else at
            here = weight[order]
            if level == 0:
                sums = np.cumsum(here)
                self.total = np.zeros(n + 1, np.int64)
                self.total[order] = sums - (sums - here)[start] if n else sums
            one = ((key[order] >> (levels - 1 - level)) & 1).astype(bool)
            children = np.full((n + 1, 2), 2 * n)
            for side, goes in enumerate((~one, one)):
                last = np.maximum.accumulate(np.where(goes, at, -1)) if n else at
                children[order, side] = 2 * np.where(last >= start, order[np.maximum(last, 0)], n) if n else at
            self.children.append(children.ravel())
            light = np.where(one, 0, here)
            sums = np.cumsum(light)
            below = np.zeros((n + 1, 2), np.int64)
            below[order, 0] = sums - (sums - light)[start] if n else sums
            self.below.append(below.ravel())
            zeros = np.cumsum(~one)
            zeros_in = zeros - (zeros - ~one)[start] if n else zeros  # in the group, this one included
            begins = np.flatnonzero(first)
            all_zeros = np.repeat(zeros_in[np.r_[begins[1:], n] - 1], np.diff(np.r_[begins, n])) if n else at
            to = np.where(one, start + all_zeros + (at - start) - zeros_in, start + zeros_in - 1)
            moved, below_group = np.empty_like(order), np.empty_like(group)
            moved[to], below_group[to] = order, 2 * group + one
            order, group = moved, below_group
        self.empty = n


def select(one: Trees, other: Trees, p: np.ndarray, s: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The key of each rank (from 0) in the union of a version of one tree and one of the other, by one descent through both."""
    p, s = 2 * p, 2 * s
    key = np.zeros(len(rank), np.int64)
    for level in range(len(one.children)):
        below = one.below[level].take(p)
        below += other.below[level].take(s)
        right = rank >= below
        below *= right
        rank = rank - below
        p += right
        s += right
        p, s = one.children[level].take(p), other.children[level].take(s)
        key += key
        key += right
    return key


def window_medians(unit: np.ndarray, own: np.ndarray, time: np.ndarray, cents: np.ndarray, valued: np.ndarray, weight: np.ndarray, length: int, q_unit: np.ndarray, q_time: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``n``, ``median2`` and ``mad4`` of windows: entries of ``own`` up to the time asked for, the others from ``length`` before it on."""
    unit, own, time, cents, weight = (x[valued] for x in (unit, own, time, cents, weight))
    order = np.lexsort((cents, unit))
    u, c = unit[order], cents[order]
    new = np.r_[True, (u[1:] != u[:-1]) | (c[1:] != c[:-1])] if len(u) else np.zeros(0, bool)
    values, dense = c[new], np.cumsum(new) - 1
    units = int(max(unit.max(initial=-1), q_unit.max(initial=-1))) + 1
    offset = np.searchsorted(u[new], np.arange(units + 1))
    key = np.empty(len(u), np.int64)
    key[order] = dense - offset[u]
    levels = max(1, int(np.diff(offset).max(initial=0) - 1).bit_length())

    def side(mine: np.ndarray, back: bool) -> tuple[Trees, np.ndarray]:
        at = np.flatnonzero(mine)
        at = at[np.lexsort((-time[at] if back else time[at], unit[at]))]
        tree = Trees(unit[at], key[at], weight[at], levels)
        t, asked = (-time[at], length - q_time) if back else (time[at], q_time)
        # The last entry of the unit that is inside the window: merge entries and questions by unit and time.
        both = np.lexsort((np.r_[np.zeros(len(at), np.int8), np.ones(len(asked), np.int8)], np.r_[t, asked], np.r_[unit[at], q_unit]))
        seen = np.cumsum(both < len(at))
        last = np.empty(len(asked), np.int64)
        is_question = both >= len(at)
        last[both[is_question] - len(at)] = seen[is_question] - 1
        inside = (last >= 0) & (unit[at][np.maximum(last, 0)] == q_unit) if len(at) else np.zeros(len(asked), bool)
        return tree, np.where(inside, last, tree.empty)

    (one, p), (other, s) = side(own, False), side(~own, True)
    n = one.total[p] + other.total[s]
    median2, mad4 = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    some = np.flatnonzero(n >= 2)
    if not len(some):
        return n, median2, mad4
    p, s, m, base = p[some], s[some], n[some], offset[q_unit[some]]

    def value(rank: np.ndarray, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        return values[base[at] + select(one, other, p[at], s[at], rank)]

    middle = value((m - 1) // 2) + value(m // 2)
    run = m // 2 + 1  # so many values are nearest to the median
    low, high = np.zeros(len(m), np.int64), m - run
    while len(open_ := np.flatnonzero(low < high)):
        half = (low[open_] + high[open_]) // 2
        far = middle[open_] > value(half, open_) + value(half + run[open_], open_)
        low[open_] = np.where(far, half + 1, low[open_])
        high[open_] = np.where(far, high[open_], half)
    end = low + run - 1
    left, right = np.abs(2 * value(low) - middle), np.abs(2 * value(end) - middle)
    inner = np.where(left >= right, np.minimum(low + 1, end), np.maximum(end - 1, low))
    next_ = np.maximum(np.minimum(left, right), np.abs(2 * value(inner) - middle))
    most = np.maximum(left, right)
    median2[some], mad4[some] = middle, np.where(m % 2 == 1, 2 * most, most + next_)
    return n, median2, mad4


def _numbers(column: pa.Array) -> np.ndarray:
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _answers(length: int, event: bool):
    """Rows come sorted by unit (columns ``series`` and ``block``, and ``run`` of cut ones); a unit is answered when it is whole.

    ``event``: an answer for each own event, with its id and kind; else one for each time of own events.
    """
    keys = ["series", "block"] if event else ["series", "block", "run"]

    def answer(rows: pa.Table) -> pa.RecordBatch:
        unit = np.cumsum(_changes(rows, keys)) - 1
        own, asks = rows["own"].to_numpy(), rows["asks"].to_numpy()
        time, cents, valued = _numbers(rows["us"].combine_chunks()), _numbers(rows["cents"].combine_chunks()), rows["cents"].combine_chunks().is_valid().to_numpy(zero_copy_only=False)
        weight = _numbers(rows["weight"].combine_chunks())
        at = np.flatnonzero(asks)
        at = at[np.lexsort((time[at], unit[at]))]
        first = np.r_[True, (unit[at][1:] != unit[at][:-1]) | (time[at][1:] != time[at][:-1])] if len(at) else np.zeros(0, bool)
        n, median2, mad4 = window_medians(unit, own, time, cents, valued, weight, length, unit[at][first], time[at][first])
        if event:
            each = np.cumsum(first) - 1
            n, median2, mad4 = n[each], median2[each], mad4[each]
            few = n < 2
            far = 2 * np.abs(2 * cents[at] - median2) > 3 * mad4
            last = [pa.array(far, pa.bool_(), mask=few | ~valued[at])]
            mine = rows.select(["click_id", "kind"]).take(pa.array(at))
        else:
            few, last, mine = n < 2, [], rows.select(["series", "us"]).take(pa.array(at[first]))
        found = [pa.array(n), pa.array(median2, mask=few), pa.array(mad4, mask=few), *last]
        names = [*mine.column_names, "n", "median2", "mad4", *(["far"] if event else [])]
        return pa.RecordBatch.from_arrays([c.combine_chunks() for c in mine.columns] + found, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        due = HELD
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if (n := sum(b.num_rows for b in held)) < due:
                continue
            rows = pa.Table.from_batches(held)
            cut = int(np.flatnonzero(_changes(rows, keys))[-1])  # the last unit may go on
            if cut:
                yield answer(rows.slice(0, cut))
                held = [b for b in rows.slice(cut).combine_chunks().to_batches() if b.num_rows]
            due = HELD if cut else 2 * n
        if held:
            yield answer(pa.Table.from_batches(held))

    return run


def _changes(rows: pa.Table, keys: list[str]) -> np.ndarray:
    out = np.zeros(rows.num_rows, bool)
    for name in keys:
        column = rows[name].combine_chunks()
        codes = _numbers(column.dictionary_encode().indices) if pa.types.is_string(column.type) else _numbers(column)
        out[1:] |= codes[1:] != codes[:-1]
    out[:1] = True
    return out


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds of a time; of one without a zone, as it stands, whatever zone the session has."""
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.unix_micros(c)
    day = F.unix_date(c.cast("date")).cast("long") * 86_400
    return (day + F.hour(c) * 3_600 + F.minute(c) * 60) * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def _units(events: DataFrame) -> DataFrame:
    """Each event in its own block's unit, and if it has cents in the next one's."""
    places = F.array(F.struct(F.col("block").alias("to"), F.lit(True).alias("own")), F.struct((F.col("block") + 1).alias("to"), F.lit(False).alias("own")))
    return events.withColumn("place", F.explode(places)).filter("place.own or cents is not null").select("series", F.col("place.to").alias("block"), F.col("place.own").alias("own"), "us", "cents", *[F.when(F.col("place.own"), F.col(c)).alias(c) for c in ("click_id", "kind")])


def rolling_medians(clicks: DataFrame, minutes: int = 60, id_col: str = "click_id", time_col: str = "ts", kind_col: str = "kind", value_col: str = "value") -> DataFrame:
    """``click_id``, ``kind``, ``n``, ``median2``, ``mad4``, ``far`` of each event; the table is read once."""
    length = minutes * 60_000_000
    hundredths = 100 * F.col(f"`{value_col}`").cast("double") + 0.5
    cents = F.when(F.abs(hundredths) < float(_MOST), F.floor(hundredths))  # NaN is larger than any bound
    rows = clicks.select(integral(clicks, id_col).alias("click_id"), micros(clicks, time_col).alias("us"), F.col(f"`{kind_col}`").cast("string").alias("kind"), cents.alias("cents")).filter("us is not null")
    once = rows.groupBy("click_id").agg(F.min(F.struct("us", "kind", "cents")).alias("it")).select("click_id", "it.*")
    series = F.when(F.col("kind").isNull(), "").otherwise(F.concat(F.lit("="), "kind"))
    block = F.floor(F.col("us") / length)  # a quotient of doubles, made whole below
    block = block - F.when(block * length > F.col("us"), 1).otherwise(0) + F.when((block + 1) * length <= F.col("us"), 1).otherwise(0)
    events = Table(once.withColumn("series", series).withColumn("block", block), "events").df
    sizes = events.groupBy("series", "block").agg(F.count("*").alias("events"))
    sums = sizes.unionByName(sizes.withColumn("block", F.col("block") + 1)).groupBy("series", "block").agg(F.sum("events").alias("events"))
    hot = Table(sums.filter(F.col("events") > UNIT).select("series", "block"), "hot_units")
    units = _units(events)
    schema = "click_id long, kind string, n long, median2 long, mad4 long, far boolean"
    any_hot = not hot.df.isEmpty()
    cold = units.join(hot.side(), ["series", "block"], "left_anti") if any_hot else units
    cold = cold.withColumns({"asks": F.col("own"), "weight": F.lit(1).cast("long")})
    dealt = cold.repartition(shuffle_partitions(clicks.sparkSession), "series", "block").sortWithinPartitions("series", "block")
    found = dealt.mapInArrow(_answers(length, True), schema)
    return found.unionByName(_of_hot(events, units, hot, length).select(found.columns)) if any_hot else found


def _of_hot(events: DataFrame, units: DataFrame, hot: Table, length: int) -> DataFrame:
    """The events of units that are too large for one task."""
    entries = units.join(hot.side(), ["series", "block"]).groupBy("series", "block", "own", "us", "cents").agg(F.count("*").alias("weight"))
    entries = entries.withColumn("place", F.when(F.col("own"), F.col("us")).otherwise(F.col("us") + length))
    entries = Table(entries, "hot_entries")
    runs = -(-entries.df.count() // UNIT) + 1
    ranged = entries.df.repartitionByRange(runs, "series", "block", "place")
    cut = Table(ranged.withColumn("run", F.spark_partition_id()), "hot_runs").df
    runs = (cut.agg(F.max("run")).first()[0] or 0) + 1
    # Distinct values of dyadic groups of runs, counted from the side that a window comes from.
    digits = max(1, int(runs).bit_length())
    number = F.when(F.col("own"), F.col("run")).otherwise(F.lit(runs - 1) - F.col("run"))
    held = cut.filter("cents is not null").groupBy("series", "block", "own", "run", "cents").agg(F.sum("weight").alias("weight"))
    held = held.withColumn("number", number).withColumn("digit", F.explode(F.sequence(F.lit(0), F.lit(digits - 1)))).withColumn("group", F.expr("shiftright(number, digit)"))
    groups = held.filter("`group` % 2 = 0").groupBy("series", "block", "own", "digit", "group", "cents").agg(F.sum("weight").alias("weight"))
    asked = cut.filter("own").select("series", "block", "run").distinct()
    asked = asked.withColumn("own", F.explode(F.array(F.lit(True), F.lit(False)))).withColumn("number", number)
    asked = asked.withColumn("digit", F.explode(F.sequence(F.lit(0), F.lit(digits - 1)))).withColumn("group", F.expr("shiftright(number, digit) - 1")).filter("`group` % 2 = 0 and `group` >= 0")
    core = asked.join(groups, ["series", "block", "own", "digit", "group"]).select("series", "block", "run", "own", F.when(F.col("own"), F.lit(-(2**61))).otherwise(F.lit(2**61)).cast("long").alias("us"), "cents", "weight", F.lit(False).alias("asks"))
    whole = cut.select("series", "block", "run", "own", "us", "cents", "weight", F.col("own").alias("asks")).unionByName(core)
    # Groups of a run that only other units have hold nothing for it, and a run without own events asks for nothing.
    dealt = whole.repartition(max(shuffle_partitions(events.sparkSession), runs), "series", "block", "run").sortWithinPartitions("series", "block", "run")
    found = dealt.mapInArrow(_answers(length, False), "series string, us long, n long, median2 long, mad4 long")
    mine = events.join(hot.side(), ["series", "block"]).select("click_id", "kind", "series", "us", "cents")
    far = F.when(F.col("n") >= 2, 2 * F.abs(2 * F.col("cents") - F.col("median2")) > 3 * F.col("mad4"))
    return mine.join(found, ["series", "us"]).withColumn("far", far)
