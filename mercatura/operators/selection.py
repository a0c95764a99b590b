"""Equal shares of a table by selection: the rows that shares begin with are found, no row is sorted.

A table in four shares has three rows where a share begins. Each is found by narrowing an interval of
keys around its place: a sample of the interval's rows gives two keys that are likely to lie on either side
of the place, one scan counts the rows before, between and after them, and the part that holds the place is
the next interval. Counts decide, so a sample that misses costs a round and never a wrong row. A round
shrinks an interval about thirty-fold; what is left at ``FETCHED`` rows is read in order. With the rows
known, every row's share follows from comparing it with them: as many literals as there are shares.

The scans read the value and the id of a table staged once. What reaches the driver are counts, about
``SAMPLED`` keys per interval and round, and at most ``FETCHED`` keys per interval at the end.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from mercatura.session import stage

SAMPLED = 4_000
FETCHED = 10_000
DEVIATIONS = 4.0
"""How many standard deviations of a sample's rank the two keys are away from the place."""


@dataclass(frozen=True)
class Shares:
    """``count`` equal shares in ascending order of the column ``value``, nulls last."""

    value: str
    count: int


@dataclass(frozen=True)
class Key:
    """What rows are ordered by: the value, nulls last, then the id."""

    value: object
    id: object


@dataclass(frozen=True)
class _Order:
    """Comparisons of rows with keys, for one value column."""

    value: str
    id: str
    value_type: DataType
    id_type: DataType

    def of_row(self) -> Column:
        value = F.col(self.value)
        return F.struct(value.isNull(), value, F.col(self.id))

    def literal(self, key: Key) -> Column:
        value = F.lit(key.value).cast(self.value_type)
        return F.struct(F.lit(key.value is None), value, F.lit(key.id).cast(self.id_type))

    def before(self, key: Key) -> Column:
        return self.of_row() < self.literal(key)

    def after(self, key: Key) -> Column:
        return self.of_row() > self.literal(key)


@dataclass(frozen=True)
class _Interval:
    """The rows between two keys, among which the one at ``place`` (from 0) is looked for."""

    order: _Order
    place: int
    rows: int
    above: Key | None = None
    below: Key | None = None

    def holds(self) -> Column:
        tests = [F.lit(True)]
        if self.above is not None:
            tests.append(self.order.after(self.above))
        if self.below is not None:
            tests.append(self.order.before(self.below))
        return reduce(lambda a, b: a & b, tests)


def with_shares(df: DataFrame, id_column: str, shares: Mapping[str, Shares]) -> DataFrame:
    """Add one column per entry: the share of the row, from 1, as ``ntile`` numbers them.

    Equal values are ordered by the id. Ids are unique; rows that share value and id also share
    their share. The rows of ``df`` are staged once and neither shuffled nor sorted.
    """
    rows = stage(df, "shared")
    total = rows.count()
    result = rows
    for name, spec in shares.items():
        order = _Order(spec.value, id_column, rows.schema[spec.value].dataType, rows.schema[id_column].dataType)
        first = [order.literal(key) for key in keys_at(rows, order, first_places(total, spec.count), total)]
        begun = [F.when(order.of_row() >= key, 1).otherwise(0) for key in first]
        result = result.withColumn(name, reduce(lambda a, b: a + b, begun, F.lit(1)).cast("int"))
    return result


def first_places(total: int, count: int) -> list[int]:
    """The places (from 0) where the second and later shares begin; the first ``total % count``
    shares are one larger."""
    small, larger = divmod(total, count)
    places = [share * small + min(share, larger) for share in range(1, count)]
    return [place for place in places if place < total]


def keys_at(rows: DataFrame, order: _Order, places: list[int], total: int) -> list[Key]:
    """The keys of the rows at ``places``. All intervals are narrowed by the same scans."""
    narrow = rows.select(order.value, order.id) if order.value != order.id else rows.select(order.id)
    open_ = {place: _Interval(order, place, total) for place in places}
    found: dict[int, Key] = {}
    round_ = 0
    while len(found) < len(places):
        ready = {p: i for p, i in open_.items() if p not in found and i.rows <= FETCHED}
        found |= _fetched(narrow, ready)
        wide = {p: i for p, i in open_.items() if p not in found}
        if wide:
            open_ = _narrowed(narrow, wide, found, round_)
            round_ += 1
    return [found[place] for place in places]


def _keys(rows: DataFrame, order: _Order, intervals: list[_Interval]) -> list[list[Key]]:
    """The keys of ``rows`` in each interval, in order."""
    kept = rows.where(reduce(lambda a, b: a | b, [i.holds() for i in intervals]))
    flags = [i.holds().alias(f"in_{n}") for n, i in enumerate(intervals)]
    named = [F.col(order.value).alias("value"), F.col(order.id).alias("id")]
    listed = kept.orderBy(order.of_row()).select(*named, *flags).collect()
    return [[Key(r["value"], r["id"]) for r in listed if r[f"in_{n}"]] for n in range(len(intervals))]


def _fetched(rows: DataFrame, ready: Mapping[int, _Interval]) -> dict[int, Key]:
    if not ready:
        return {}
    intervals = list(ready.values())
    listed = _keys(rows, intervals[0].order, intervals)
    return {p: keys[i.place] for (p, i), keys in zip(ready.items(), listed)}


def _narrowed(
    rows: DataFrame, wide: Mapping[int, _Interval], found: dict[int, Key], round_: int
) -> dict[int, _Interval]:
    """The intervals after one round; keys that turn out to be all of an interval go to ``found``."""
    order = next(iter(wide.values())).order
    chance = F.pmod(F.xxhash64(F.lit(round_), F.col(order.id)), F.lit(1 << 40)) / (1 << 40)
    drawn = [i.holds() & (chance < SAMPLED / i.rows) for i in wide.values()]
    sampled = _keys(rows.where(reduce(lambda a, b: a | b, drawn)), order, list(wide.values()))
    pivots = {}
    for (place, interval), keys in zip(wide.items(), sampled):
        if keys:
            pivots[place] = _around(keys, interval.place / interval.rows)
    counted = [F.lit(0).alias("none")]
    for place, (low, high) in pivots.items():
        inside = wide[place].holds()
        counted.append(F.count_if(inside & order.before(low)).alias(f"low_{place}"))
        counted.append(F.count_if(inside & order.after(high)).alias(f"high_{place}"))
        counted.append(F.count_if(inside & (order.of_row() == order.literal(low))).alias(f"at_low_{place}"))
        counted.append(F.count_if(inside & (order.of_row() == order.literal(high))).alias(f"at_high_{place}"))
    counts = rows.agg(*counted).first()
    narrowed = {}
    for place, interval in wide.items():
        if place not in pivots:  # an empty sample: another one is drawn in the next round
            narrowed[place] = interval
            continue
        low, high = pivots[place]
        below, at_low = counts[f"low_{place}"], counts[f"at_low_{place}"]
        at_high, over = counts[f"at_high_{place}"], counts[f"high_{place}"]
        at, last = interval.place, interval.rows - over
        if at < below:
            narrowed[place] = _Interval(order, at, below, interval.above, low)
        elif at < below + at_low:
            found[place] = low
        elif at >= last:
            narrowed[place] = _Interval(order, at - last, over, high, interval.below)
        elif at >= last - at_high:
            found[place] = high
        else:
            between = last - at_high - below - at_low
            narrowed[place] = _Interval(order, at - below - at_low, between, low, high)
    return narrowed


def _around(keys: list[Key], share: float) -> tuple[Key, Key]:
    """Two sampled keys on either side of where ``share`` of the rows are passed."""
    most = len(keys) - 1
    away = ceil(DEVIATIONS * sqrt(len(keys) * share * (1 - share))) + 1
    at = int(share * len(keys))
    return keys[min(max(at - away, 0), most)], keys[min(at + away, most)]
