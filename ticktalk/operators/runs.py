"""Order-dependent operators over tables of any size.

A window ordered over a whole table puts every row into one task. Here the table is cut instead into *runs*: disjoint
ranges of the full order key, found from small hash samples of the keys, so that a run holds a bounded share of the
rows even when one timestamp or one group holds a third of them. Cuts form a tree of two levels: up to ``FAN`` coarse
ranges, whose cut points the plan holds, and any number of finer cuts in each, which are rows of a table. So the
number of runs has no bound, and follows from the size of rows. Windows then work inside each run, and what a run
needs from the runs before it comes in one of two forms:

* *halo*: the last k rows before the run are copied into it (lag, moving frames);
* *carry*: one value per run, for instance its last non-null price, is passed on (fills, running totals, as-of
  matches): first among the runs of a coarse range, then among the coarse ranges.

The samples only place the cuts. Any cuts give the same results. Order keys have to be unique for results to be
reproducible, so every operator takes tie-break columns in ``order``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from ticktalk.session import settle

RUN_BYTES = 32 << 20  # rows of a run, as JSON text; sorted in memory, twice for an as-of join, they take several times that
FAN = 1024  # coarse ranges; steps over coarse ranges meet no more rows than that
SAMPLE_PER_RUN = 16
MEASURED_ROWS = 1000

RUN = "__run"  # coarse range in the upper 32 bits, place within it in the lower ones
HALO = "__halo"
_FINE_BITS = 32

_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}


def _passed(points: Column, key: Column, most: int) -> Column:
    """How many of the ascending ``points``, at most ``most``, are not above the key, by halving."""
    depth = most.bit_length()
    strides = F.array(*[F.lit(2**level) for level in reversed(range(depth))])
    # Places beyond the end are null, and so is the comparison.
    return F.aggregate(
        strides,
        F.lit(0),
        lambda low, stride: F.when(F.get(points, low + stride - 1) <= key, low + stride).otherwise(low),
    )


@dataclass(frozen=True)
class Cuts:
    """Ascending cut points of an order key. Coarse range ``i`` holds the keys from point ``i`` on, below point ``i + 1``;
    ``fine`` has a row with the finer points of each coarse range, or is None where coarse ranges are runs."""

    keys: tuple[str, ...]
    schema: T.StructType
    points: tuple[str, ...]  # JSON text of each key, the first range has none
    fine: DataFrame | None = None
    most_fine: int = 0

    @property
    def whole(self) -> bool:
        """Whether there is one run only."""
        return not self.points and self.fine is None

    def coarse_of(self) -> Column:
        if not self.points:
            return F.lit(0)
        points = F.from_json(F.lit("[" + ",".join(self.points) + "]"), T.ArrayType(self.schema), _JSON)
        return _passed(points, _key(self.keys), len(self.points))


def _key(names: Sequence[str]) -> Column:
    return F.struct(*[F.col(name).alias(f"k{i}") for i, name in enumerate(names)])


def _fixed_width(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_fixed_width(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType))


def rows_and_width(df: DataFrame) -> tuple[int, float]:
    """Number of rows, and bytes of a row as JSON text: as its type says, or estimated on a few rows if it holds text or lists."""
    if _fixed_width(df.schema):
        return df.count(), 30.0 * len(df.columns)
    width = df.limit(MEASURED_ROWS).agg(F.avg(F.octet_length(F.to_json(F.struct("*"))))).scalar()
    counted = df.agg(F.count("*").alias("rows")).select("rows", width.alias("width")).first()
    return counted["rows"], counted["width"] or 1.0


def find_cuts(
    df: DataFrame,
    keys: Sequence[str],
    rows_per_run: int | None = None,
    fan: int | None = None,
    least_runs: int = 1,
) -> Cuts:
    """Choose cut points for ``df`` ordered by ``keys``: one count, and for larger tables one or two passes over the keys.

    Runs hold about ``rows_per_run`` rows, by default as many as fill ``RUN_BYTES``; ``least_runs`` asks for more runs.
    """
    fan = fan or FAN
    keyed = df.select(_key(keys).alias("key"))
    schema = keyed.schema["key"].dataType
    if rows_per_run:
        rows = df.count()
    else:
        rows, width = rows_and_width(df)
        rows_per_run = max(1, int(RUN_BYTES / width))
    runs = max(-(-rows // rows_per_run), min(least_runs, rows))
    if runs <= 1:
        return Cuts(tuple(keys), schema, ())
    ranges = min(fan, runs)

    def sample(parts: int) -> DataFrame:
        # Equal keys share a hash: distinct keeps a hot key from filling the sample.
        every = max(1, rows // (parts * SAMPLE_PER_RUN))
        return keyed.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).distinct()

    found = [row.text for row in sample(ranges).orderBy("key").select(F.to_json("key", _JSON).alias("text")).collect()]
    places = {(i * len(found)) // ranges for i in range(1, ranges)} if found else set()
    coarse = Cuts(tuple(keys), schema, tuple(found[i] for i in sorted(places)))
    if runs <= fan:
        return coarse
    # A coarse range gets as many finer cuts as its share of the larger sample asks for.
    in_ranges = sample(runs).select(*[F.col("key")[f"k{i}"].alias(name) for i, name in enumerate(keys)])
    in_ranges = in_ranges.select(_key(keys).alias("key"), F.explode(F.array(coarse.coarse_of())).alias("__coarse"))
    lists = in_ranges.groupBy("__coarse").agg(F.array_sort(F.collect_list("key")).alias("found"))
    parts = F.greatest(F.ceil(F.size("found") / F.lit(SAMPLE_PER_RUN)), F.lit(1)).cast("int")
    numbers = F.when(parts > 1, F.sequence(F.lit(1), parts - 1)).otherwise(F.array().cast("array<int>"))
    cut_at = F.transform(numbers, lambda i: F.get("found", F.floor(i * F.size("found") / parts).cast("int")))
    fine = settle(lists.select("__coarse", F.array_distinct(cut_at).alias("__points")), "cuts")
    most = fine.agg(F.max(F.size("__points"))).first()[0] or 0
    return Cuts(tuple(keys), schema, coarse.points, fine, most)


def _numbered(df: DataFrame, cuts: Cuts) -> DataFrame:
    if cuts.whole:
        return df.withColumn(RUN, F.lit(0).cast("long"))
    # Exploding a one-element array keeps the optimizer from seeing through the column: it would derive filters for the
    # other side of a join on it that search the cuts with columns of this side.
    if cuts.fine is None:
        number = F.shiftleft(cuts.coarse_of().cast("long"), _FINE_BITS)
        return df.select(*df.columns, F.explode(F.array(number)).alias(RUN))
    placed = df.select(*df.columns, F.explode(F.array(cuts.coarse_of())).alias("__coarse"))
    # One row per coarse range: a table of some megabytes goes to every task, a larger one is met by a shuffle.
    placed = placed.join(cuts.fine, "__coarse", "left")
    within = _passed(F.col("__points"), _key(cuts.keys), max(cuts.most_fine, 1))
    number = F.shiftleft(F.col("__coarse").cast("long"), _FINE_BITS) + within
    return placed.select(*df.columns, F.explode(F.array(number)).alias(RUN))


class Runs:
    """A table cut into runs along ``by + order``. Frames restart where a ``by`` column changes."""

    def __init__(
        self,
        df: DataFrame,
        order: Sequence[str],
        by: Sequence[str] = (),
        cuts: Cuts | None = None,
        rows_per_run: int | None = None,
        fan: int | None = None,
        least_runs: int = 1,
    ):
        self.order, self.by = list(order), list(by)
        self.keys = self.by + self.order
        self.cuts = cuts if cuts is not None else find_cuts(df, self.keys, rows_per_run, fan, least_runs)
        self.df = _numbered(df, self.cuts)

    def on(self, df: DataFrame) -> Runs:
        """Another table (say, a filtered one) along the same cuts."""
        return Runs(df.drop(RUN), self.order, self.by, cuts=self.cuts)

    def window(self, *order: Column) -> WindowSpec:
        return Window.partitionBy(RUN, *self.by).orderBy(*(order or self.order))

    def spread(self) -> DataFrame:
        """The table shuffled by run. Windows, joins and totals per run then need no further shuffle."""
        return self.df.repartition(RUN)

    def per_run(self, *aggregates: Column, df: DataFrame | None = None) -> DataFrame:
        """One row for every run that has rows."""
        return (self.df if df is None else df).groupBy(RUN).agg(*aggregates)

    def scan(
        self,
        summary: DataFrame,
        last_before: Sequence[str] = (),
        first_after: Sequence[str] = (),
        sum_before: Sequence[str] = (),
        sum_after: Sequence[str] = (),
    ) -> DataFrame:
        """For every run of ``summary`` (one row per run) what the other runs pass on: in each column of ``last_before`` the
        last non-null value of the runs before it, of ``first_after`` the first one of the runs after it, of ``sum_before``
        and ``sum_after`` their sum.

        Windows meet the runs of one coarse range, or one row for each coarse range.
        """
        wanted = [(c, "last", False) for c in last_before] + [(c, "last", True) for c in first_after]
        wanted += [(c, "sum", False) for c in sum_before] + [(c, "sum", True) for c in sum_after]

        def scanned(kind: str, column: str, back: bool, place: str, *within: str) -> Column:
            frame = Window.partitionBy(*(within or [F.lit(0)])).orderBy(F.desc(place) if back else F.asc(place))
            frame = frame.rowsBetween(Window.unboundedPreceding, -1)
            return F.last(column, ignorenulls=True).over(frame) if kind == "last" else F.coalesce(F.sum(column).over(frame), F.lit(0))

        if self.cuts.fine is None:
            return summary.select(RUN, *[scanned(kind, c, back, RUN).alias(c) for c, kind, back in wanted])
        # Both levels read the summary.
        summary = settle(summary, "run-summary").withColumn("__coarse", F.shiftright(RUN, _FINE_BITS))
        inner = summary.select(RUN, "__coarse", *[scanned(kind, c, back, RUN, "__coarse").alias(c) for c, kind, back in wanted])

        def total(kind: str, column: str, back: bool) -> Column:
            if kind == "sum":
                return F.sum(column)
            pick = F.min_by if back else F.max_by
            return pick(F.col(column), F.when(F.col(column).isNotNull(), F.col(RUN)))

        ranges = summary.groupBy("__coarse").agg(*[total(kind, c, back).alias(c) for c, kind, back in wanted])
        outer = ranges.select("__coarse", *[scanned(kind, c, back, "__coarse").alias(f"__o{i}") for i, (c, kind, back) in enumerate(wanted)])
        joined = inner.join(outer, "__coarse")
        both = {c: F.coalesce(F.col(c), F.col(f"__o{i}")) if kind == "last" else F.col(c) + F.col(f"__o{i}") for i, (c, kind, _) in enumerate(wanted)}
        return joined.select(RUN, *[value.alias(c) for c, value in both.items()])

    def rows_after(self) -> DataFrame:
        """For every run its last group, and how many rows of that group the later runs hold.

        A group goes on into later runs only from the end of its run, so the first groups of the runs are added up: the sizes
        are chained by running totals over all runs, less the total at which the group ended.
        """
        sizes = settle(self.df.groupBy(RUN, self.group().alias("g")).agg(F.count("*").alias("rows")), "run-groups")
        ends = sizes.groupBy(RUN).agg(F.min("g").alias("first"), F.max("g").alias("__last"))
        heads = sizes.join(ends, RUN).where(F.col("g").eqNullSafe(F.col("first")))
        coarse = F.shiftright(RUN, _FINE_BITS)
        heads = heads.select(RUN, "g", "rows", coarse.alias("__coarse"))
        later = (Window.unboundedPreceding, -1)
        # Among the runs of a coarse range, then among the ranges: a group that fills many runs is not met row by row.
        inner = heads.withColumn("near", F.coalesce(F.sum("rows").over(Window.partitionBy("__coarse", "g").orderBy(F.desc(RUN)).rowsBetween(*later)), F.lit(0)) + F.col("rows"))
        ranges = heads.groupBy("__coarse", "g").agg(F.sum("rows").alias("rows"))
        outer = ranges.select("__coarse", "g", F.coalesce(F.sum("rows").over(Window.partitionBy("g").orderBy(F.desc("__coarse")).rowsBetween(*later)), F.lit(0)).alias("far"))
        beyond = outer.select(F.col("__coarse").alias("__range"), F.col("g").alias("__g"), "far")
        held = inner.join(beyond, (F.col("__coarse") == F.col("__range")) & F.col("g").eqNullSafe(F.col("__g"))).select(RUN, "g", (F.col("near") + F.col("far")).alias("held"))
        # A run whose last group is not its first has all later rows of it in the runs that begin with it; else its own rows count too.
        starts = held.groupBy("g").agg(F.max("held").alias("all"))
        last = sizes.join(ends, RUN).where(F.col("g").eqNullSafe(F.col("__last")))
        last = last.select(RUN, "__last", "first", F.col("rows").alias("own"))
        own = held.select(F.col(RUN).alias("__r"), F.col("g").alias("__h"), "held")
        joined = last.join(own, (F.col(RUN) == F.col("__r")) & F.col("__last").eqNullSafe(F.col("__h")), "left")
        joined = joined.join(starts.withColumnRenamed("g", "__s"), F.col("__last").eqNullSafe(F.col("__s")), "left")
        inside = F.col("first").eqNullSafe(F.col("__last"))
        after = F.when(inside, F.col("held") - F.col("own")).otherwise(F.coalesce(F.col("all"), F.lit(0)))
        return joined.select(RUN, "__last", after.alias("__after"))

    def with_halo(self, rows: int, needs: Sequence[str]) -> DataFrame:
        """The table plus, in every run, the ``rows`` rows that come right before it, flagged in ``__halo``.

        Copied rows hold the keys and the columns in ``needs``; the rest is NULL.
        """
        own = self.df.withColumn(HALO, F.lit(False))
        if self.cuts.whole:
            return own
        narrow = list(dict.fromkeys([*self.keys, *needs]))
        newest = Window.partitionBy(RUN).orderBy(*[F.desc_nulls_last(k) for k in self.keys])
        # The last rows of every run are numbered through; a run needs the numbers right below its first one. These lie in at
        # most two blocks of ``rows`` numbers, so both sides meet by block.
        ranked = self.df.select(RUN, *narrow).withColumn("__n", F.row_number().over(newest))
        tails = settle(ranked.where(F.col("__n") <= rows), "tails")
        held = tails.groupBy(RUN).agg(F.count("*").alias("__held"))
        before = self.scan(held, sum_before=["__held"]).withColumnRenamed("__held", "__before")
        sizes = held.join(before, RUN)
        number = F.col("__before") + F.col("__held") - F.col("__n")
        given = tails.join(sizes, RUN).withColumn("__number", number).withColumn("__block", F.floor(number / F.lit(rows)))
        given = given.select("__number", "__block", *narrow)
        blocks = F.array_distinct(F.array(F.floor((F.col("__before") - 1) / F.lit(rows)), F.floor((F.col("__before") - rows) / F.lit(rows))))
        takers = before.select(RUN, "__before", F.explode(blocks).alias("__block"))
        near = (F.col("__number") < F.col("__before")) & (F.col("__number") >= F.col("__before") - rows)
        copies = takers.join(given, "__block").where(near).select(RUN, *narrow, F.lit(True).alias(HALO))
        return own.unionByName(copies, allowMissingColumns=True)

    def framed(self, rows: int, needs: Sequence[str], columns: dict[str, Callable[[WindowSpec], Column]]) -> DataFrame:
        """Add window columns over ``needs`` whose frames reach at most ``rows`` rows back.

        Each is made from the ordered window.
        """
        window = self.window()
        out = self.with_halo(rows, needs).withColumns({name: make(window) for name, make in columns.items()})
        return out.where(~F.col(HALO)).drop(HALO, RUN)

    def same_group(self, tag: Column) -> Column:
        """Whether the group in ``tag`` is the row's own; always true without groups."""
        own = F.struct(*[F.col(name) for name in self.by]) if self.by else None
        return F.lit(True) if own is None else tag.eqNullSafe(own)

    def group(self) -> Column:
        return F.struct(*[F.col(name) for name in self.by]) if self.by else F.lit(0)


def previous(df: DataFrame, columns: dict[str, str], order: Sequence[str], by: Sequence[str] = (), **size) -> DataFrame:
    """Add ``{new: old}`` columns holding ``old`` of the row before; NULL on the first row (of a group)."""
    return Runs(df, order, by, **size).framed(1, list(columns.values()), {new: (lambda w, old=old: F.lag(old).over(w)) for new, old in columns.items()})


def moving_mean_before(
    df: DataFrame, value: str, out: str, order: Sequence[str], rows: int = 4, by: Sequence[str] = (), cuts: Cuts | None = None, **size
) -> DataFrame:
    """Mean of the ``rows`` rows before each row, NULL unless all of them are there and non-null."""

    def mean(window: WindowSpec) -> Column:
        frame = window.rowsBetween(-rows, -1)
        return F.when(F.count(value).over(frame) == rows, F.avg(value).over(frame))

    return Runs(df, order, by, cuts=cuts, **size).framed(rows, [value], {out: mean})


def drop_repeats(df: DataFrame, value: str, order: Sequence[str], by: Sequence[str] = (), **size) -> DataFrame:
    """Drop rows that repeat the value of the row before them; nulls repeat nulls."""
    marked = Runs(df, order, by, **size).framed(
        1,
        [value],
        {
            "__repeats": lambda w: F.lag(F.lit(True)).over(w).isNotNull() & F.col(value).eqNullSafe(F.lag(value).over(w)),
        },
    )
    return marked.where(~F.col("__repeats")).drop("__repeats")


def fill_forward(
    df: DataFrame, order: Sequence[str], columns: Sequence[str] | None = None, by: Sequence[str] = (), **size
) -> DataFrame:
    """Replace nulls by the last value before them; leading nulls stay. All non-key columns by default."""
    runs = Runs(df, order, by, **size)
    columns = [c for c in df.columns if c not in runs.keys] if columns is None else list(columns)
    in_run = runs.window().rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.last(c, ignorenulls=True).over(in_run) for c in columns}
    if runs.cuts.whole:
        return runs.df.withColumns(filled).select(*df.columns)
    key = _key(runs.keys)
    lasts = runs.per_run(
        *[
            F.max_by(F.struct(runs.group().alias("g"), F.col(c).alias("v")), F.when(F.col(c).isNotNull(), key)).alias(f"__c{i}")
            for i, c in enumerate(columns)
        ]
    )
    carry = runs.scan(lasts, last_before=[f"__c{i}" for i in range(len(columns))])
    joined = runs.spread().join(carry, RUN, "left").withColumns(filled)
    return joined.withColumns(
        {
            c: F.coalesce(F.col(c), F.when(runs.same_group(F.col(f"__c{i}.g")), F.col(f"__c{i}.v")))
            for i, c in enumerate(columns)
        }
    ).select(*df.columns)


def gap_changes(
    df: DataFrame,
    order: Sequence[str],
    ts: str = "timestamp",
    price: str = "price",
    longest_gap: int = 3600,
    **size,
) -> DataFrame:
    """Add ``gap_s`` (seconds since the row before, 0 at the start) and ``price_change``.

    The change is NULL on the first row of a date and 0 after a gap longer than ``longest_gap`` seconds.
    ``order`` has to start with ``ts``, so that the row before is in the same date or in an earlier one.
    """
    if order[0] != ts:
        raise ValueError(f"order has to start with {ts!r}")
    runs = Runs(df, order, **size)
    looked = runs.framed(1, [ts, price], {"__ts": lambda w: F.lag(ts).over(w), "__price": lambda w: F.lag(price).over(w)})
    gap = F.coalesce(F.timestamp_diff("MICROSECOND", F.col("__ts"), F.col(ts)) / F.lit(1e6), F.lit(0.0))
    same_day = F.to_date(ts) == F.to_date("__ts")
    change = F.when(gap > longest_gap, F.lit(0.0)).when(same_day, F.col(price) - F.col("__price"))
    return looked.withColumns({"gap_s": gap, "price_change": change}).drop("__ts", "__price")


def last_of_groups(df: DataFrame, group: str, order: Sequence[str], n: int, **size) -> DataFrame:
    """The last ``n`` rows of each group, however large: rows are ranked from the end inside their run, and a run is told how many rows of
    its last group come in later runs."""
    runs = Runs(df, order, [group], **size)
    from_end = Window.partitionBy(RUN, group).orderBy(*[F.desc_nulls_last(c) for c in order])
    ranked = runs.spread().withColumn("__n", F.row_number().over(from_end))
    if not runs.cuts.whole:
        after = runs.rows_after()
        ranked = ranked.join(after, RUN).withColumn("__n", F.col("__n") + F.when(runs.group().eqNullSafe(F.col("__last")), F.col("__after")).otherwise(0))
    return ranked.where(F.col("__n") <= n).select(*df.columns)
