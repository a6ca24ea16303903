"""Ordered series: rows grouped by key columns and sorted inside each group.

Plain case: every operator is a window function over one shared window, so a
chain of them costs one shuffle and one sort.

Hot groups: a group with more rows than one task should take (for instance one
lap holding a third of the table) is cut by a range shuffle on (keys, order)
into segments of bounded size.  The same window functions then run inside
(keys, segment), with two additions that make the result equal to the
unsegmented one:

* neighbour access (lag, lead, short frames) sees a *halo*: copies of the
  closest `reach` rows on either side of the segment, removed at the end;
* running aggregates receive the aggregate of all earlier segments, computed
  from one small row per segment.

Whether hot groups exist is checked on row counts before the plan is built.  What was
found is noted on the DataFrame and handed down to those made of its rows, so a chain
over the same keys counts once; stored tables bring counts of their own.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property, reduce
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, Observation, Window, WindowSpec
from pyspark.sql import functions as F

from pitlane.settings import (
    BROADCAST_ROWS,
    BROADCAST_ROWS_DEFAULT,
    HOT_GROUP_ROWS,
    HOT_GROUP_ROWS_DEFAULT,
    materialize,
    setting,
)

SEGMENT = "_segment"
CORE = "_core"


def hot_limit(df: DataFrame) -> int:
    return setting(df.sparkSession, HOT_GROUP_ROWS, HOT_GROUP_ROWS_DEFAULT)


@dataclass(frozen=True)
class Sizes:
    """No group of `keys` has more than `most` rows.

    `hot` lists the groups above `limit` (and their sizes) where they were looked for.
    """

    keys: tuple[str, ...]
    most: int
    limit: int | None = None
    hot: DataFrame | None = None


# What is known of a DataFrame.  It belongs to that very object: a table that is read
# again starts with nothing, so an answer never outlives the rows it was found on.
_SIZES: WeakKeyDictionary[DataFrame, tuple[Sizes, ...]] = WeakKeyDictionary()


# Counts of earlier plans of this session, for the same rows under another DataFrame.
_COUNTED: WeakKeyDictionary = WeakKeyDictionary()
_REMEMBERED = 100


def _snapshot(df: DataFrame) -> tuple:
    """The optimized plan and which listings of files it reads.

    A table that is read again has a listing of its own, so files written in between
    are never answered for by an older count.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    system = df.sparkSession._jvm.java.lang.System
    listings = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName().startswith(("LogicalRelation", "Relation")):
            relation = leaf.relation()
            listings.append(system.identityHashCode(relation.location() if "HadoopFsRelation" in relation.getClass().getName() else relation))
    return plan, listings


def _counted_before(keyed: DataFrame, snapshot: tuple) -> tuple[Sizes, ...] | None:
    plan, listings = snapshot
    for old, old_listings, columns, sizes in _COUNTED.get(keyed.sparkSession, []):
        if columns == keyed.columns and old_listings == listings and plan.sameResult(old):
            return sizes
    return None


def know(df: DataFrame, *sizes: Sizes) -> DataFrame:
    """Note that `sizes` hold for `df`."""
    _SIZES[df] = (*_SIZES.get(df, ()), *sizes)
    return df


def known_sizes(df: DataFrame) -> tuple[Sizes, ...]:
    return _SIZES.get(df, ())


def hand_down(new: DataFrame, *old: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Note on `new` what is known of the tables its rows come from; returns `new`.

    To be used where each row of `old` gives at most one row of `new` with the same keys.
    `names` translates keys that another column determines one to one.  Rows of several
    tables add up.
    """
    swap = names or {}
    found: dict[tuple[str, ...], list[Sizes]] = {}
    for df in old:
        for s in known_sizes(df):
            found.setdefault(tuple(swap.get(k, k) for k in s.keys), []).append(s)
    for keys, sizes in found.items():
        if len(old) == 1:
            for s in sizes:
                know(new, replace(s, keys=keys, hot=None if swap else s.hot, limit=None if swap else s.limit))
        else:
            each = [min((s.most for s in known_sizes(df) if set(s.keys) <= set(keys)), default=None) for df in old]
            if None not in each:
                know(new, Sizes(keys, sum(each)))
    return new


def most_rows(df: DataFrame, keys: list[str]) -> int | None:
    """The least known bound on the groups of `keys`; groups by fewer keys are larger, so theirs count too."""
    return min((s.most for s in known_sizes(df) if set(s.keys) <= set(keys)), default=None)


def measured(df: DataFrame, keys: list[str]) -> DataFrame:
    """`df` with the size of its largest group known, counted if need be."""
    hot_groups(df, keys, exact=False)
    return df


def hot_groups(df: DataFrame, keys: list[str], limit: int | None = None, exact: bool = True) -> DataFrame | None:
    """Keys and sizes of the groups too large for one task, or None if there are none.

    A hot group has more than `limit` rows (default: `hot_limit`), so there are
    at most ``rows / limit`` of them.  Without `exact` groups may be listed that were
    hot in the table the rows come from.
    """
    limit = limit or hot_limit(df)
    if not exact and (most_rows(df, keys) or 0) > limit:
        for s in known_sizes(df):
            if s.keys == tuple(keys) and s.limit == limit and s.hot is not None:
                return s.hot
    return hot_groups_of([(df, keys)], limit)[0]


def hot_groups_of(
    tables: list[tuple[DataFrame, list[str]]], limit: int
) -> list[DataFrame | None]:
    """`hot_groups` of several tables; one job looks for the largest group of each.

    Rows are counted, whatever their size in files, unless a known bound answers.
    """
    found: list[DataFrame | None] = [None] * len(tables)
    counts, totals, snapshots = {}, {}, {}
    for i, (df, keys) in enumerate(tables):
        bound = most_rows(df, keys)
        if bound is None or bound > limit:
            keyed = df.select(*keys)
            snapshots[i] = _snapshot(keyed)
            earlier = _counted_before(keyed, snapshots[i])
            if earlier:
                know(df, *earlier)
                answer = [s for s in earlier if s.keys == tuple(keys) and (s.most <= limit or s.limit == limit)]
                if answer:
                    found[i] = answer[0].hot if answer[0].most > limit else None
                    continue
            counts[i] = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
            totals[i] = Observation()
    if not counts:
        return found
    # The largest groups of a task first: no second shuffle.
    tops = [
        c.select("_rows", F.lit(i).alias("i")).observe(totals[i], F.sum("_rows").alias("rows")).orderBy(F.desc("_rows")).limit(1)
        for i, c in counts.items()
    ]
    top = {row.i: row["_rows"] for row in reduce(DataFrame.unionByName, tops).collect()}
    for i, count in counts.items():
        if top.get(i, 0) > limit:
            found[i] = materialize(count.where(F.col("_rows") > limit))
        whole = Sizes((), totals[i].get["rows"] or 0)
        sizes = (Sizes(tuple(tables[i][1]), top.get(i, 0), limit, found[i]), whole)
        know(tables[i][0], *sizes)
        memory = _COUNTED.setdefault(tables[i][0].sparkSession, [])
        memory.append((*snapshots[i], tables[i][0].select(*tables[i][1]).columns, sizes))
        del memory[:-_REMEMBERED]
    return found


def checked_broadcast(df: DataFrame, rows: int | None = None) -> DataFrame:
    """`df` with a broadcast hint if it has few rows, else as it is.

    `rows` is a proven bound; without one the rows are counted up to the limit.
    """
    most = setting(df.sparkSession, BROADCAST_ROWS, BROADCAST_ROWS_DEFAULT)
    if rows is None:
        rows = df.limit(most + 1).count()
    return F.broadcast(df) if rows <= most else df


def mark_hot(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Add `_rows`: the size of a row's group if that group is hot, else NULL.

    The keys of a hot group may be NULL, so the join is null-safe.
    """
    if not keys:
        return df.withColumn("_rows", F.lit(1))
    names = {k: f"_hot_{k}" for k in keys}
    small = checked_broadcast(hot).withColumnsRenamed(names)
    match = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(names[k])) for k in keys], F.lit(True)
    )
    return df.join(small, match, "left").drop(*names.values())


class Series:
    """Window functions over (keys, order) that stay exact for hot groups.

    `order` must identify a row inside its group.  `reach` is how many rows
    before and after a row the chain of neighbour functions looks at in total.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], reach: int = 0):
        self.keys = list(keys)
        self.order = list(order)
        self.reach = reach
        self.source = df
        self.changed: set[str] = set()
        self.hot = hot_groups(df, self.keys, exact=False)
        self.parts = self.keys if self.hot is None else [*self.keys, SEGMENT]
        self.df = df if self.hot is None else self._cut(df)

    # -- windows -----------------------------------------------------------

    @cached_property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.parts).orderBy(*self.order)

    @cached_property
    def backwards(self) -> WindowSpec:
        return Window.partitionBy(*self.parts).orderBy(*[F.col(c).desc() for c in self.order])

    def lag(self, column: str | Column, n: int = 1) -> Column:
        return F.lag(column, n).over(self.window)

    def lead(self, column: str | Column, n: int = 1) -> Column:
        return F.lead(column, n).over(self.window)

    def is_first(self) -> Column:
        return self.lag(F.lit(1)).isNull()

    def is_last(self) -> Column:
        return self.lead(F.lit(1)).isNull()

    # -- building ----------------------------------------------------------

    def with_columns(self, columns: dict[str, Column]) -> Series:
        self.changed |= set(columns)
        self.df = self.df.withColumns(columns)
        return self

    def with_neighbours(self, columns: list[str], distance: int = 1) -> Series:
        """Add ``<column>_b<n>`` and ``<column>_a<n>``: the values n rows before and after.

        Also adds `_is_first` and `_is_last`.
        """
        made = {"_is_first": self.is_first(), "_is_last": self.is_last()}
        for c in columns:
            for n in range(1, distance + 1):
                made[f"{c}_b{n}"], made[f"{c}_a{n}"] = self.lag(c, n), self.lead(c, n)
        return self.with_columns(made)

    def running(self, columns: dict[str, tuple[str, Column]], backwards: bool = False) -> Series:
        """Running aggregates from the group's start up to the current row.

        Each value is (kind, input) with kind sum, count, max or last; `last`
        is the most recent non-NULL input.  With `backwards` the aggregate
        runs from the group's end down to the current row.  Halo rows do not
        get a running value, so take neighbours of the input, not of the result.
        """
        spec = self.backwards if backwards else self.window
        frame = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if self.hot is None:
            made = {n: _aggregate(k, c).over(frame) for n, (k, c) in columns.items()}
            return self.with_columns(made)

        self.changed |= set(columns)
        own = {n: (k, F.when(F.col(CORE), c)) for n, (k, c) in columns.items()}
        inputs = self.df.withColumns({f"_in_{n}": c for n, (_, c) in own.items()})
        carried = self._carry(inputs, {n: k for n, (k, _) in own.items()}, backwards)
        local = inputs.withColumns(
            {n: _aggregate(k, F.col(f"_in_{n}")).over(frame) for n, (k, _) in own.items()}
        )
        joined = attach_small(local, carried, self.parts, self.summaries)
        self.df = joined.withColumns(
            {n: _combine(k, F.col(f"_carry_{n}"), F.col(n)) for n, (k, _) in own.items()}
        ).drop(*[f"_in_{n}" for n in own], *[f"_carry_{n}" for n in own])
        return self

    def position(self, name: str) -> Series:
        """1-based row number inside the group."""
        if self.hot is None:
            return self.with_columns({name: F.row_number().over(self.window).cast("long")})
        return self.running({name: ("count", F.lit(1))})

    def rows(self) -> DataFrame:
        """The result: every input row once, without the helper columns."""
        out = self.df if self.hot is None else self.df.where(CORE).drop(SEGMENT, CORE)
        kept = [s for s in known_sizes(self.source) if not self.changed & set(s.keys)]
        return out if out is self.source else know(out, *kept)

    # -- hot groups --------------------------------------------------------

    def _cut(self, df: DataFrame) -> DataFrame:
        limit = hot_limit(df)
        size = self.hot.agg(F.sum("_rows").alias("rows"), F.count(F.lit(1)).alias("groups")).first()
        pieces = max(2, -(-size.rows // limit) * 2)
        # Each piece has one row for each group that it touches.
        self.summaries = pieces + size.groups
        marked = mark_hot(df, self.hot, self.keys)
        cold = marked.where(F.col("_rows").isNull()).drop("_rows").withColumn(SEGMENT, F.lit(-1))
        # The partition number is only stable once written, hence the checkpoint.
        ranged = (
            marked.where(F.col("_rows").isNotNull())
            .drop("_rows")
            .repartitionByRange(pieces, *self.keys, *self.order)
            .withColumn(SEGMENT, F.spark_partition_id())
        )
        large = materialize(ranged)
        parts = [cold.withColumn(CORE, F.lit(True)), large.withColumn(CORE, F.lit(True))]
        if self.reach:
            parts.append(self._halo(large).withColumn(CORE, F.lit(False)))
        return reduce(DataFrame.unionByName, parts)

    def _halo(self, large: DataFrame) -> DataFrame:
        """The `reach` rows before and after each segment, tagged with it."""
        reach = self.reach
        group = Window.partitionBy(*self.keys)
        sizes = large.groupBy(*self.parts).agg(F.count(F.lit(1)).alias("_size"))
        spans = sizes.withColumn("_end", F.sum("_size").over(group.orderBy(SEGMENT)))
        spans = materialize(spans.withColumn("_start", F.col("_end") - F.col("_size")))

        # Spark keeps the few edge rows per segment before it shuffles.
        def outer(spec: WindowSpec) -> DataFrame:
            ranked = large.withColumn("_n", F.row_number().over(spec)).where(F.col("_n") <= reach)
            return attach_small(ranked, spans, self.parts, self.summaries)

        first = outer(self.window).withColumn("_at", F.col("_start") + F.col("_n"))
        last = outer(self.backwards).withColumn("_at", F.col("_end") - F.col("_n") + 1)
        # A short segment's rows are edges of both kinds, but wanted once.
        last = last.where(F.col("_at") > F.col("_start") + reach)
        edges = (
            first.unionByName(last)
            .withColumn("_bucket", F.floor(F.col("_at") / reach))
            .drop("_n", "_size", "_start", "_end", SEGMENT)
        )
        # Positions wanted by a segment: (start - reach, start] and (end, end + reach].
        wanted = spans.select(
            *self.parts,
            F.explode(
                F.array(
                    F.struct((F.col("_start") - reach + 1).alias("lo"), F.col("_start").alias("hi")),
                    F.struct((F.col("_end") + 1).alias("lo"), (F.col("_end") + reach).alias("hi")),
                )
            ).alias("_span"),
        ).withColumn(
            "_bucket",
            F.explode(
                F.sequence(F.floor(F.col("_span.lo") / reach), F.floor(F.col("_span.hi") / reach))
            ),
        )
        names = {k: f"_want_{k}" for k in self.keys}
        match = reduce(
            lambda a, b: a & b,
            [F.col(k).eqNullSafe(F.col(v)) for k, v in names.items()],
            edges["_bucket"] == F.col("_want_bucket"),
        )
        wanted = wanted.withColumnsRenamed({**names, "_bucket": "_want_bucket"})
        inside = F.col("_at").between(F.col("_span.lo"), F.col("_span.hi"))
        copies = edges.join(wanted, match & inside)
        return materialize(
            copies.drop(*names.values(), "_want_bucket", "_span", "_bucket", "_at")
        )

    def _carry(self, inputs: DataFrame, kinds: dict[str, str], backwards: bool) -> DataFrame:
        """One row per segment: the aggregate of all segments before it."""
        large = inputs.where(F.col(SEGMENT) >= 0)
        own = []
        for name, kind in kinds.items():
            value = F.col(f"_in_{name}")
            if kind == "last":
                pick = F.min_by if backwards else F.max_by
                known = F.when(value.isNotNull(), F.struct(*self.order))
                own.append(pick(value, known).alias(name))
            else:
                own.append(_aggregate(kind, value).alias(name))
        sums = large.groupBy(*self.parts).agg(*own)
        by = F.col(SEGMENT).desc() if backwards else F.col(SEGMENT)
        earlier = (
            Window.partitionBy(*self.keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        )
        rolled = {"count": "sum"}
        carried = [
            _aggregate(rolled.get(k, k), F.col(n)).over(earlier).alias(f"_carry_{n}")
            for n, k in kinds.items()
        ]
        return sums.select(*self.parts, *carried)


def _aggregate(kind: str, column: Column) -> Column:
    if kind == "last":
        return F.last(column, ignorenulls=True)
    return {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}[kind](column)


def _combine(kind: str, carried: Column, local: Column) -> Column:
    if kind == "last":
        return F.coalesce(local, carried)
    if kind == "max":
        return F.greatest(carried, local)
    if kind == "count":
        return F.coalesce(carried, F.lit(0)) + local
    return F.when(local.isNull(), carried).otherwise(F.coalesce(carried + local, local))


def attach_small(df: DataFrame, small: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Join per-segment or per-hot-group rows, of which there are at most `rows`."""
    names = {k: f"_of_{k}" for k in keys}
    match = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(v)) for k, v in names.items()], F.lit(True)
    )
    other = checked_broadcast(small.withColumnsRenamed(names), rows)
    return df.join(other, match, "left").drop(*names.values())


def attach_totals(df: DataFrame, keys: list[str], columns: dict[str, Column]) -> DataFrame:
    """Group aggregates on every row of the group, safe for hot groups."""
    hot = hot_groups(df, keys, exact=False)
    whole = Window.partitionBy(*keys)
    if hot is None:
        return hand_down(df.withColumns({n: c.over(whole) for n, c in columns.items()}), df)
    marked = mark_hot(df, hot, keys)
    cold = marked.where(F.col("_rows").isNull()).drop("_rows")
    large = marked.where(F.col("_rows").isNotNull()).drop("_rows")
    sums = large.groupBy(*keys).agg(*[c.alias(n) for n, c in columns.items()])
    small = cold.withColumns({n: c.over(whole) for n, c in columns.items()})
    return hand_down(small.unionByName(attach_small(large, sums, keys, hot.count())), df)
