"""Cube metadata and the aggregate queries it describes, as plain DataFrame plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Sketches of distinct values have 2 ** 12 registers, whose relative standard error is this.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


@dataclass(frozen=True)
class Level:
    name: str
    column: str


@dataclass(frozen=True)
class Hierarchy:
    name: str
    levels: tuple[Level, ...]
    all_member: str = "All"

    def path(self, level: str) -> list[str]:
        """Columns from the top level down to ``level``: a member is its whole path."""
        names = [known.name for known in self.levels]
        if level not in names:
            raise KeyError(f"{self.name} has no level {level}")
        return [known.column for known in self.levels[: names.index(level) + 1]]


@dataclass(frozen=True)
class Measure:
    name: str
    column: str
    aggregator: str

    def aggregate(self, condition: Column | None = None) -> Column:
        """The aggregate, over the rows meeting ``condition`` only where one is given."""
        value = F.col(self.column) if condition is None else F.when(condition, F.col(self.column))
        return {
            "sum": F.sum,
            "avg": F.avg,
            "distinct-count": F.count_distinct,
            "approx-distinct-count": F.approx_count_distinct,
        }[self.aggregator](value)


@dataclass(frozen=True)
class NamedSet:
    """The last ``count`` members of a level that occur in the data."""

    name: str
    hierarchy: str
    level: str
    count: int = 1


@dataclass(frozen=True)
class Axis:
    """Known members of a one-column level laid out as columns: member value -> column suffix."""

    hierarchy: str
    level: str
    members: Mapping[Any, str]


@dataclass(frozen=True)
class Cube:
    name: str
    hierarchies: tuple[Hierarchy, ...]
    measures: tuple[Measure, ...]
    named_sets: tuple[NamedSet, ...] = field(default=())

    def hierarchy(self, name: str) -> Hierarchy:
        return _named(self.hierarchies, name)

    def measure(self, name: str) -> Measure:
        return _named(self.measures, name)

    def named_set(self, name: str) -> NamedSet:
        return _named(self.named_sets, name)

    def path(self, hierarchy: str, level: str) -> list[str]:
        return self.hierarchy(hierarchy).path(level)

    # members

    def members(self, table: DataFrame, hierarchy: str, level: str) -> DataFrame:
        """Distinct members of a level, parents first."""
        path = self.path(hierarchy, level)
        return table.select(*path).distinct().orderBy(*path)

    def last_members(self, table: DataFrame, hierarchy: str, level: str, count: int = 1) -> DataFrame:
        """The last ``count`` members of a level in hierarchy order."""
        path = self.path(hierarchy, level)
        if count == 1:
            last = table.agg(F.max(F.struct(*path)).alias("_last"))
            return last.where(F.col("_last").isNotNull()).select("_last.*")
        return table.select(*path).distinct().orderBy(*(F.desc(c) for c in path)).limit(count)

    # slicers

    def at_member(self, table: DataFrame, hierarchy: str, level: str, member: Sequence[Any]) -> DataFrame:
        """Rows below one member, given as its path from the top: values or scalar columns."""
        path = self.path(hierarchy, level)
        if len(member) != len(path):
            raise ValueError(f"a member of {level} has {len(path)} parts")
        return table.where(reduce(and_, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(path, member))))

    def at_last(self, table: DataFrame, hierarchy: str, level: str, within: DataFrame | None = None) -> DataFrame:
        """Rows of the last member of a level, "last" being decided by ``within`` (by default the
        table itself). One scalar per path column, so that on a table partitioned by those columns
        only the last member's partitions are read."""
        path = self.path(hierarchy, level)
        last = self.last_members(table if within is None else within, hierarchy, level)
        # A null level is a member too; without any member nothing is last.
        at = reduce(and_, (F.col(c).eqNullSafe(last.select(c).scalar()) for c in path))
        return table.where(at & last.select(F.lit(True)).scalar())

    def in_members(self, table: DataFrame, members: DataFrame) -> DataFrame:
        """Rows below any of the given members (a frame of path columns)."""
        alike = reduce(and_, (table[c].eqNullSafe(members[c]) for c in members.columns))
        return table.join(members, alike, "left_semi")

    def in_set(
        self, table: DataFrame, name: str | NamedSet, within: DataFrame | None = None
    ) -> DataFrame:
        """Rows of a named set, either one of the cube's or one given for this query."""
        named = self.named_set(name) if isinstance(name, str) else name
        if named.count == 1:
            return self.at_last(table, named.hierarchy, named.level, within)
        last = self.last_members(table if within is None else within, named.hierarchy, named.level, named.count)
        return self.in_members(table, last)

    # queries

    def query(
        self,
        table: DataFrame,
        rows: Sequence[tuple[str, str]],
        measures: Sequence[str],
        columns: Axis | None = None,
        order: Sequence[tuple[str, str]] = (),
        paths: bool = True,
        limit: int | None = None,
    ) -> DataFrame:
        """Measures of the row members, in one aggregation.

        ``rows`` are (hierarchy, level) pairs. With ``columns`` each measure is also laid out per
        member of the axis as ``<measure>_<suffix>``, and the plain measure is the total over all
        of them. ``order`` lists (measure, "asc" | "desc"), the first being the primary one; the
        row members settle ties. Without ``paths`` only the level columns themselves are grouped.
        Members without any value are left out.
        """
        keys = self._keys(rows, paths)
        chosen = [self.measure(m) for m in measures]
        aggregates = [m.aggregate().alias(m.name) for m in chosen]
        if columns is not None:
            member = F.col(self.path(columns.hierarchy, columns.level)[-1])
            aggregates += [
                m.aggregate(member == value).alias(f"{m.name}_{suffix}")
                for m in chosen
                for value, suffix in columns.members.items()
            ]
        result = self._non_empty(table.groupBy(*keys).agg(*aggregates), chosen)
        sides = {"asc": F.asc, "desc": F.desc}
        result = result.orderBy(*(sides[way](name) for name, way in order), *keys)
        return result if limit is None else result.limit(limit)

    def rollup(self, table: DataFrame, hierarchy: str, level: str, measures: Sequence[str]) -> DataFrame:
        """Measures of the members of a level and of all their ancestors up to "all", parents
        first. ``depth`` is the number of path columns that are set: 0 is the all member."""
        path = self.path(hierarchy, level)
        return self._grouped(table, DataFrame.rollup, path, measures, parents_first=True)

    def sketches(self, table: DataFrame, hierarchy: str, level: str, measure: str) -> DataFrame:
        """A mergeable sketch of the values that a distinct-count measure counts, for each member of a level. A stored
        one takes a few kilobytes a member, and adds up over other tables and days, unlike the counts themselves."""
        sketch = F.hll_sketch_agg(F.col(self.measure(measure).column), SKETCH_BITS)
        return table.groupBy(*self.path(hierarchy, level)).agg(sketch.alias("sketch"))

    def rollup_sketches(self, sketches: DataFrame, hierarchy: str, level: str, measure: str) -> DataFrame:
        """A distinct-count measure of a level and all its ancestors from sketches alone, as ``rollup`` gives it but for
        the error of the sketches."""
        path = self.path(hierarchy, level)
        flags = [F.grouping(k).cast("int") for k in path]
        depth = (F.lit(len(path)) - reduce(lambda a, b: a + b, flags)).alias("depth")
        merged = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(measure)
        return sketches.rollup(*path).agg(depth, merged).select(*path, "depth", measure)

    def combinations(self, table: DataFrame, levels: Sequence[tuple[str, str]], measures: Sequence[str]) -> DataFrame:
        """Measures of every combination of the given levels, each one also taken as "all"."""
        keys = self._keys(levels, paths=False)
        return self._grouped(table, DataFrame.cube, keys, measures, parents_first=False)

    def _grouped(self, table: DataFrame, group, keys: list[str], measures: Sequence[str], parents_first: bool) -> DataFrame:
        chosen = [self.measure(m) for m in measures]
        finest, aggregates = _pre_aggregated(table, keys, chosen)
        flags = [F.grouping(k).cast("int") for k in keys]
        depth = (F.lit(len(keys)) - reduce(lambda a, b: a + b, flags)).alias("depth")
        flagged = [f.alias(f"_all_{k}") for f, k in zip(flags, keys)]
        result = group(finest, *keys).agg(depth, *flagged, *aggregates)
        hierarchize = [side for k in keys for side in (F.desc(f"_all_{k}"), F.asc(k))]
        ordered = result.orderBy(*(hierarchize if parents_first else ["depth", *hierarchize]))
        return ordered.select(*keys, "depth", *(m.name for m in chosen))

    def _keys(self, rows: Sequence[tuple[str, str]], paths: bool) -> list[str]:
        keys: list[str] = []
        for hierarchy, level in rows:
            path = self.path(hierarchy, level)
            keys += [c for c in (path if paths else path[-1:]) if c not in keys]
        return keys

    @staticmethod
    def _non_empty(result: DataFrame, measures: Sequence[Measure]) -> DataFrame:
        return result.where(F.coalesce(*(F.col(m.name) for m in measures)).isNotNull())


def _pre_aggregated(table: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> tuple[DataFrame, list[Column]]:
    """``table`` with one row per finest member (and per value to be counted once), and the measures over those rows.

    A roll-up repeats every row for each of its levels, so it gets few: sums and counts instead of facts.
    """
    parts: dict[str, Column] = {}
    counted: dict[str, Column] = {}
    over: list[Column] = []
    for m in measures:
        value = F.col(m.column)
        if m.aggregator in ("sum", "avg"):
            parts[f"_sum_{m.column}"], parts[f"_count_{m.column}"] = F.sum(value), F.count(value)
            kind = table.select(m.aggregate().alias("x")).schema["x"].dataType
            total = F.sum(f"_sum_{m.column}")
            if m.aggregator == "avg":
                total = total / F.nullif(F.sum(f"_count_{m.column}"), F.lit(0))
            over.append(total.cast(kind).alias(m.name))
        else:
            counted[f"_value_{m.column}"] = value
            over.append(replace(m, column=f"_value_{m.column}").aggregate().alias(m.name))
    grouped = table.groupBy(*keys, *(value.alias(name) for name, value in counted.items()))
    return grouped.agg(*(part.alias(name) for name, part in (parts or {"_rows": F.count("*")}).items())), over


def _named(items, name: str):
    for item in items:
        if item.name == name:
            return item
    raise KeyError(name)
