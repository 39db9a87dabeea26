"""Rank, quartile, running sum and exact quantile over all rows, without a single-task window.

``Window.orderBy`` without a partition moves every row to one task. Here a bounded sample of the sort
keys, the same at every evaluation, gives range bounds; they stand in the plan as literals, and each row
finds its range by binary search. Rows go to the task of their range in one exchange and are numbered
there; a table of one row per range, counted before the exchange, supplies what lies before it. Bounds
decide balance only, and a range is a function of the row alone, so nothing need be written down: a second
evaluation, or that of a lost task, gives each row the same range.

The sort keys must end in a unique key. That makes the order total, and lets a tie that holds
most rows be split between ranges. They are plain columns, ascending or descending.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLOT, POSITION = "_slot", "_position"
#: The sample has at most this many rows for each range; keys are drawn by their hash, one in ``ONE_IN``.
SAMPLE_PER_RANGE, ONE_IN = 64, 16

_KEY = re.compile(r"Column<'(?P<name>.+?)(?: (?P<way>ASC|DESC)(?: NULLS (?P<nulls>FIRST|LAST))?)?'>", re.DOTALL)


@dataclass(frozen=True)
class Key:
    """A sort key: a column's name and its direction."""

    name: str
    descending: bool
    nulls_last: bool

    @staticmethod
    def of(column: Column, columns: Sequence[str]) -> "Key":
        found = _KEY.fullmatch(str(column))
        if found is None or found["name"] not in columns:
            raise ValueError(f"a sort key must be a plain column of the rows: {column}")
        descending = found["way"] == "DESC"
        return Key(found["name"], descending, (found["nulls"] or ("LAST" if descending else "FIRST")) == "LAST")

    def behind(self, bound: Column, value: Column) -> Column:
        """Whether ``value`` comes strictly behind ``bound``."""
        inside = value < bound if self.descending else value > bound
        nulls = value.isNull() & bound.isNotNull() if self.nulls_last else value.isNotNull() & bound.isNull()
        return nulls | F.coalesce(inside, F.lit(False))


def behind(keys: Sequence[Key], bound: Column) -> Column:
    """Whether a row comes strictly behind the keys in the struct ``bound``."""
    out = F.lit(False)
    for place, key in reversed(list(enumerate(keys))):
        mark, value = bound[f"k{place}"], F.col(key.name)
        out = key.behind(mark, value) | (mark.eqNullSafe(value) & out)
    return out


def _sample(df: DataFrame, names: Sequence[str], unique: str, ranges: int) -> list[Row]:
    """A bounded sample of the named columns, drawn by the hash of the unique key: the same rows at each call.

    As that key is as a rule one that the rows were grouped by, the filter reaches below the grouping.
    """
    hashed = F.xxhash64(unique)
    drawn = df.select(*names).where(F.pmod(hashed, F.lit(ONE_IN)) == 0).orderBy(hashed).limit(SAMPLE_PER_RANGE * ranges)
    return [row for row in drawn.collect() if all(value == value for value in row)]  # a NaN is no bound


def _bounds(sample: Sequence[Row], keys: Sequence[Key], ranges: int) -> list[Row]:
    """At most ``ranges`` - 1 rows that cut the sample into equal parts in the given order."""
    found = list(sample)
    for key in reversed(keys):
        empty = [row for row in found if row[key.name] is None]
        others = sorted((row for row in found if row[key.name] is not None), key=lambda row: row[key.name], reverse=key.descending)
        found = others + empty if key.nulls_last else empty + others
    cuts = [found[k * len(found) // ranges] for k in range(1, ranges)] if found else []
    return [cut for at, cut in enumerate(cuts) if not at or [cut[k.name] for k in keys] != [cuts[at - 1][k.name] for k in keys]]


def _struct(row: Row, keys: Sequence[Key], df: DataFrame) -> Column:
    return F.struct(*[F.lit(row[key.name]).cast(df.schema[key.name].dataType).alias(f"k{place}") for place, key in enumerate(keys)])


def _range_of(bounds: Sequence[Column], keys: Sequence[Key]) -> Column:
    """How many bounds lie before a row, by binary search in the array of bounds."""
    if not bounds:
        return F.lit(0)
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    table, last = F.array(*bounds), F.lit(len(bounds))
    # the bound at hand is named by a function of its own, so that the table stands in the plan once
    beyond = lambda at: F.exists(F.slice(table, F.least(at, last), F.lit(1)), lambda bound: behind(keys, bound))
    step = lambda low, by: F.when((low + by <= last) & beyond(low + by), low + by).otherwise(low)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


@dataclass(frozen=True)
class Ordered:
    """Rows tagged with their range in a total order."""

    tagged: DataFrame
    order: tuple[Column, ...]
    ranges: int
    cuts: tuple[Row, ...] = ()

    @property
    def rows(self) -> DataFrame:
        """Rows with their range and their 0-based place in it: the one exchange of rows."""
        inside = W.partitionBy(SLOT).orderBy(*self.order)
        return self._placed().withColumn(POSITION, F.row_number().over(inside) - 1)

    def _placed(self) -> DataFrame:
        return self.tagged.repartitionById(self.ranges, SLOT)

    def slots(self, **sums: Column) -> DataFrame:
        """One row per range: its rows and sums, what lies before it, and the totals of all ranges.

        Counted map-side on the tagged rows. The windows below see one row per range, never data rows.
        """
        before = W.orderBy(SLOT).rowsBetween(W.unboundedPreceding, -1)
        everything = W.partitionBy()
        per_slot = self.tagged.groupBy(SLOT).agg(
            F.count(F.lit(1)).alias("_rows"), *[F.sum(value).alias(f"_sum_{name}") for name, value in sums.items()]
        )
        return per_slot.select(
            SLOT,
            "_rows",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
            F.sum("_rows").over(everything).alias("_rows_total"),
            *[F.col(f"_sum_{name}") for name in sums],
            *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in sums],
            *[F.sum(f"_sum_{n}").over(everything).alias(f"_total_{n}") for n in sums],
        )

    def ranked(self, into: str = "rank", total: str | None = None, **sums: Column) -> DataFrame:
        """Every row with its 1-based rank, and on request the number of rows and total sums."""
        slots = self.slots(**sums)
        kept = [F.col(name) for name in self.tagged.columns if name != SLOT]
        extra = [F.col("_rows_total").alias(total)] if total else []
        return self.rows.join(F.broadcast(slots), SLOT, "left").select(  # one row per range
            *kept,
            (F.col("_rows_before") + F.col(POSITION) + 1).alias(into),
            *extra,
            *[F.col(f"_total_{n}").alias(f"{n}_total") for n in sums],
        )

    def running(self, into: str = "rank", **sums: Column) -> DataFrame:
        """Every row with its rank, the number of rows, and per name the sum up to and including
        the row (``name``) and over all rows (``name_total``)."""
        return self.running_in(self.slots(**sums), into, **sums).drop(SLOT)

    def running_in(self, slots: DataFrame, into: str = "rank", **sums: Column) -> DataFrame:
        """:meth:`running` for the ranges listed in ``slots``; keeps the range tag."""
        inside = W.partitionBy(SLOT).orderBy(*self.order)
        upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
        kept = [F.col(name) for name in self.tagged.columns if name != SLOT]
        within = self._placed().select(
            SLOT,
            *kept,
            (F.row_number().over(inside) - 1).alias(POSITION),
            *[F.sum(value).over(upto).alias(f"_inside_{n}") for n, value in sums.items()],
        )
        return within.join(F.broadcast(slots), SLOT, "left").select(  # one row per range
            SLOT,
            *kept,
            (F.col("_rows_before") + F.col(POSITION) + 1).alias(into),
            F.col("_rows_total").alias("rows_total"),
            *[(F.col(f"_before_{n}") + F.col(f"_inside_{n}")).alias(n) for n in sums],
            *[F.col(f"_total_{n}").alias(f"{n}_total") for n in sums],
        )

    def restricted(self, slots: DataFrame) -> "Ordered":
        """Only the rows of the listed ranges; their tags and places stay."""
        wanted = F.broadcast(slots.select(SLOT).distinct())  # at most one row per range
        return Ordered(self.tagged.join(wanted, SLOT, "left_semi"), self.order, self.ranges, self.cuts)


def ordered(df: DataFrame, keys: Sequence[Column], sample: Sequence[Row] | None = None) -> Ordered:
    """Tag each row with its range: as many ranges as the session has shuffle partitions.

    Only the sample is evaluated here (unless one is given). Rows are numbered, and moved once, when the result is.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = [Key.of(key, df.columns) for key in keys]
    names = list(dict.fromkeys(key.name for key in known))
    cuts = []
    if ranges > 1:
        cuts = _bounds(sample if sample is not None else _sample(df, names, names[-1], ranges), known, ranges)
    slot = _range_of([_struct(cut, known, df) for cut in cuts], known)
    return Ordered(df.withColumn(SLOT, slot), tuple(keys), ranges, tuple(cuts))


def global_rank(df: DataFrame, keys: Sequence[Column], into: str = "rank") -> DataFrame:
    return ordered(df, keys).ranked(into)


def rank_within(df: DataFrame, group: str, keys: Sequence[Column], into: str = "rn") -> DataFrame:
    """ROW_NUMBER per group for every row, also where one group holds a large part of all rows.

    A plain ``row_number().over(partitionBy(group))`` gives each group to one task. Here a large
    group is cut over several ranges; a row then needs to know how many rows of its group lie in earlier
    ranges. A group is only cut where a bound lies in it, so these counts are needed for the groups of
    the bounds alone: fewer groups than ranges, counted map-side. (To pick only the first few rows per group, a
    plain window with a filter is enough: Spark then limits each group before the shuffle.)
    """
    placed = ordered(df, [F.col(group).asc(), *keys])
    inside = W.partitionBy(SLOT, group).orderBy(*keys)
    numbered = placed._placed().withColumn("_inside", F.row_number().over(inside))
    cut = {row[group] for row in placed.cuts}
    if not cut:
        return numbered.withColumn(into, F.col("_inside")).drop(SLOT, "_inside")
    belongs = F.col(group).isin([value for value in cut if value is not None])
    belongs = F.coalesce(belongs, F.lit(False)) | F.col(group).isNull() if None in cut else belongs
    before = W.partitionBy("_carried_group").orderBy("_carried_slot").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        placed.tagged.where(belongs)
        .groupBy(F.col(SLOT).alias("_carried_slot"), F.col(group).alias("_carried_group"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_carried_slot", "_carried_group", F.sum("_n").over(before).alias("_earlier"))
    )
    # null-safe, so that a group of NULL goes on where it is cut, too
    same = (F.col(SLOT) == F.col("_carried_slot")) & F.col(group).eqNullSafe(F.col("_carried_group"))
    return (
        numbered.join(F.broadcast(carried), same, "left")  # at most two rows per range
        .withColumn(into, F.col("_inside") + F.coalesce(F.col("_earlier"), F.lit(0)))
        .drop(SLOT, "_inside", "_earlier", "_carried_slot", "_carried_group")
    )


def tiles_by_selection(df: DataFrame, orders: dict[str, Sequence[Column]], tiles: int) -> DataFrame:
    """``df`` with NTILE over each named order, without sorting the rows.

    The last row of each tile is selected: ranges are counted map-side, and only the rows of the ranges in which
    a tile ends are moved and numbered. A row's tile is then one comparison with each of these ``tiles`` - 1
    rows, which come as a scalar subquery. Each order ends in a unique key.
    """
    out = df
    every = list(dict.fromkeys(Key.of(key, df.columns).name for order in orders.values() for key in order))
    unique = Key.of(next(iter(orders.values()))[-1], df.columns).name
    sample = _sample(df, every, unique, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    for name, order in orders.items():
        placed = ordered(df, order, sample)
        keys = [Key.of(key, df.columns) for key in order]
        small, extra = F.call_function("div", F.col("_rows_total"), F.lit(tiles)), F.col("_rows_total") % tiles
        ends = F.array(*[F.struct(F.lit(k).alias("tile"), (small * k + F.least(F.lit(k), extra)).alias("last")) for k in range(1, tiles)])
        # one row for each end of a tile: the range it lies in, and the place there
        ending = placed.slots().withColumn("end", F.explode(ends)).where((F.col("end.last") > F.col("_rows_before")) & (F.col("end.last") <= F.col("_rows_before") + F.col("_rows")))
        ending = ending.select(F.col(SLOT).alias("_end_slot"), "end.tile", (F.col("end.last") - F.col("_rows_before") - 1).alias("_place"))
        rows = placed.restricted(ending.select(F.col("_end_slot").alias(SLOT))).rows
        last = rows.join(F.broadcast(ending), (F.col(SLOT) == F.col("_end_slot")) & (F.col(POSITION) == F.col("_place")))
        bound = F.struct(*[F.col(key.name).alias(f"k{place}") for place, key in enumerate(keys)])
        cuts = last.agg(F.map_from_entries(F.collect_list(F.struct("tile", bound)))).scalar()
        over = [F.when(behind(keys, F.element_at(F.col("_cuts"), F.lit(k))), 1).otherwise(0) for k in range(1, tiles)]
        tile = reduce(Column.__add__, over, F.lit(1))
        out = out.withColumn("_cuts", cuts).withColumn(name, tile.cast("int")).drop("_cuts")
    return out


def ntile(rank: Column, rows: Column, tiles: int) -> Column:
    """NTILE from a 1-based rank and the row count: the first ``rows % tiles`` tiles hold one more."""
    small = F.call_function("div", rows, F.lit(tiles))
    extra = rows % tiles
    in_large = extra * (small + 1)
    return (
        F.when(rank <= in_large, _div_up(rank, small + 1))
        .otherwise(extra + _div_up(rank - in_large, F.nullif(small, F.lit(0).cast("bigint"))))
        .cast("int")
    )


def _div_up(a: Column, b: Column) -> Column:
    return F.call_function("div", a + b - 1, b)


def value_histogram(long: DataFrame, group: str, value: str, sample: Sequence[Row] | None = None) -> DataFrame:
    """Distinct values per group with their count and the count up to each value, within the group.

    Equal values are counted first, so a value that fills a third of the rows is one row. From
    this table come exact quantiles without the built-in ``percentile``, which holds all distinct
    values of a group in one task. A ``sample`` of rows (group, value), where one is known, saves drawing one.
    """
    counted = long.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    through = ordered(counted, [F.col(group), F.col(value)], sample).running(into="_rank", _upto=F.col("n"))
    # one row per group, that is, per profiled column
    bounds = through.groupBy(group).agg(F.sum("n").alias("n_total"), F.min(F.col("_upto") - F.col("n")).alias("_base"))
    return through.join(F.broadcast(bounds), group).select(
        group, value, "n", (F.col("_upto") - F.col("_base")).alias("upto"), "n_total"
    )


def quantile_parts(value: str, p: float) -> tuple[Column, Column, Column]:
    """Aggregates over a group of :func:`value_histogram`: the two values around quantile ``p``
    and the weight of the upper one."""
    point = (F.col("n_total") - 1) * F.lit(float(p))
    low = F.min(F.when(F.col("upto") > F.floor(point), F.col(value))).cast("double")
    high = F.min(F.when(F.col("upto") > F.ceil(point), F.col(value))).cast("double")
    return low, high, F.max(point - F.floor(point))


def exact_quantile(value: str, p: float) -> Column:
    """Quantile with linear interpolation, as an aggregate over a group of :func:`value_histogram`."""
    low, high, weight = quantile_parts(value, p)
    return low + (high - low) * weight
