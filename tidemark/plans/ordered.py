"""Running values and neighbours of keyed, ordered rows, safe for hot keys.

A window function over ``PARTITION BY key ORDER BY ts`` puts a whole key in one task. That is
right for almost every key and hopeless for one that holds a third of the table. ``Ordered``
keeps the plain window plan for ordinary keys and cuts each hot key in pieces along its order:

1. count rows up to ``hot_rows``, a job of a few numbers. At most that many have no hot key, and the plain
   plan is all there is. Beyond that, count rows per key (partial aggregation, narrow columns) and write the keys above
   ``hot_rows``, of which there are at most rows / ``hot_rows``;
2. write the rows of hot keys, sort them over all tasks by key and order columns, number them within each
   task, and write them again. ``piece_rows`` numbers in a row are a piece, so a piece is a run of the order and
   never longer, whatever the values are: a stray time, a burst and a NULL key are all cut by rows;
3. compute running values inside (key, piece);
4. reduce each piece to one row, run over the pieces of the key, and add what earlier pieces
   left to every row. The pieces of a key are ordered rows again, so step 4 is this same class on a table
   that is ``piece_rows`` times smaller, cut again where a key has too many pieces: no task meets
   more than ``2 * piece_rows`` of them.

When pieces are cut, they are cut once for any number of steps. Cut rows and the pieces' results are
written tables, so ties and recomputed tasks give the same pieces.

NULL is a key like any other, and a value of an order column like any other. Order columns should be
unique within a key, or the order of ties is left open, as it is in any window.

Sums of doubles are exact until the last step (``plans.exact``), so they are the same in
every bit however a key is cut, and whether it is cut at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.exact import Limbs, measure
from tidemark.session import written

PIECE = "_piece"
ALL = "_all"
PLACE = "_place"

#: Bits of ``monotonically_increasing_id`` that count the rows of a partition.
ROW_BITS = 33

#: Pieces' worth of rows that one task sorts, about.
SORTED_PIECES = 4


@dataclass(frozen=True)
class HotKeys:
    """When a key is too large for one task, and how large its pieces should be."""

    hot_rows: int = 1_000_000
    piece_rows: int = 250_000

    def of_pieces(self) -> HotKeys:
        """The same for the pieces of a key; a piece of few rows would not make the table of them smaller."""
        rows = max(self.piece_rows, 16)
        return HotKeys(2 * rows, rows)


@dataclass(frozen=True)
class Running:
    """One running value: what to compute, on what, and which side of the row to look at."""

    kind: str
    value: Column
    inclusive: bool = True
    backward: bool = False


def running_sum(value: Column, inclusive: bool = True) -> Running:
    """Sum of ``value`` from the first row of the key to this one."""
    return Running("sum", value, inclusive)


def running_count(inclusive: bool = True) -> Running:
    """Number of rows up to this one."""
    return Running("sum", F.lit(1).cast("bigint"), inclusive)


def running_min(value: Column, inclusive: bool = True) -> Running:
    """Smallest value up to this row."""
    return Running("min", value, inclusive)


def running_max(value: Column, inclusive: bool = True) -> Running:
    """Largest value up to this row."""
    return Running("max", value, inclusive)


def first_row(value: Column) -> Running:
    """The value at the first row of the key, NULL or not."""
    return Running("first", value)


def latest(value: Column, inclusive: bool = True) -> Running:
    """The last non-NULL value up to this row."""
    return Running("latest", value, inclusive)


def upcoming(value: Column, inclusive: bool = True) -> Running:
    """The first non-NULL value from this row on."""
    return Running("latest", value, inclusive, backward=True)


def previous_row(value: Column) -> Running:
    """The value at the row just before, NULL for the first."""
    return Running("previous", value)


def next_row(value: Column) -> Running:
    """The value at the row just after, NULL for the last."""
    return Running("previous", value, backward=True)


class Ordered:
    """Rows of ``df`` per key, ordered; an empty key list means one order over all rows.

    Building it runs the counting jobs. Sizes are counted on ``sizes_from`` if given: a frame that is cheaper
    to compute and has at least the same rows; keys are counted there too if it has them.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        hot: HotKeys | None = None,
        sizes_from: DataFrame | None = None,
    ):
        self.hot = hot or HotKeys()
        self.keys = list(keys) or [ALL]
        self.order = list(order)
        if not keys:
            # The same for all rows, but not a literal: windows stay hash partitioned.
            df = df.withColumn(ALL, F.hash(self.order[0]).bitwiseAND(F.lit(0)))
        sizes = df if sizes_from is None else sizes_from
        # With keys it only matters whether there are more than hot_rows, so no task counts on beyond that.
        rows = sizes.limit(self.hot.hot_rows + 1).count() if keys else sizes.count()
        self.cut, self.df = False, df
        if rows > self.hot.hot_rows:
            self._cut(df, sizes if keys and set(keys) <= set(sizes.columns) else df, rows if not keys else None)

    def _cut(self, df: DataFrame, sizes: DataFrame, rows: int | None) -> None:
        """Write the rows of hot keys with the pieces they fall in; the others have no piece."""
        cold, hot = None, df
        if rows is None:
            counts = sizes.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > self.hot.hot_rows)
            found = written(counts.select(*[F.col(k).alias(f"_hot_{k}") for k in self.keys], "_n"), "hot-keys")
            rows = found.agg(F.sum("_n").alias("n")).first()["n"]
            if not rows:
                return
            cond = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in self.keys]
            cold, hot = (df.join(found, cond, how) for how in ("left_anti", "left_semi"))
            # Sorting over all tasks reads its input twice, first for a sample of it: not from the whole of df.
            hot = written(hot, "hot-unsorted")
        by = [*self.keys, *self.order]
        tasks = -(-rows // (SORTED_PIECES * self.hot.piece_rows))
        spot = F.col("_spot")
        in_task = spot.bitwiseAND(F.lit(2**ROW_BITS - 1).cast("bigint"))
        piece = F.shiftleft(F.shiftright(spot, ROW_BITS), ROW_BITS) + F.floor(in_task / self.hot.piece_rows)
        cut = (
            hot.repartitionByRange(tasks, *by)
            .sortWithinPartitions(*by)
            .withColumn("_spot", F.monotonically_increasing_id())
            .withColumn(PIECE, piece.cast("bigint"))
            .drop("_spot")
        )
        self.cut, cut = True, written(cut, "hot-rows")
        self.df = cut if cold is None else cold.withColumn(PIECE, F.lit(None).cast("bigint")).unionByName(cut)

    def _replace(self, df: DataFrame) -> Ordered:
        new = object.__new__(Ordered)
        new.keys, new.order, new.hot, new.cut, new.df = self.keys, self.order, self.hot, self.cut, df
        return new

    @property
    def _by(self) -> list[str]:
        return [*self.keys, PIECE] if self.cut else self.keys

    def with_columns(self, columns: dict[str, Column]) -> Ordered:
        """Add row-wise columns between steps."""
        return self._replace(self.df.withColumns(columns))

    def running(self, **specs: Running) -> Ordered:
        """Add one column per running value, all in one pass over the sorted pieces."""
        doubles = {n: s.value for n, s in specs.items() if s.kind == "sum" and self._is_double(s.value)}
        if doubles:
            return self._exactly(specs, measure(self.df, doubles))
        df = self.df.withColumns({f"_in_{n}": s.value for n, s in specs.items()})
        done = df.withColumns({f"_own_{n}": self._local(n, s) for n, s in specs.items()})
        if self.cut:
            spot = F.struct(*self.order)
            parts = {f"_part_{n}": _reduce(n, s, spot) for n, s in specs.items()}
            carries = {f"_carry_{n}": _carry(n, s) for n, s in specs.items()}
            done = self._with_pieces(done, self._pieces(df, parts).running(**carries).df, list(carries))
        done = done.withColumns({n: _combine(n, s, self.cut) for n, s in specs.items()})
        scratch = [f"_{part}_{n}" for n in specs for part in ("in", "own", "carry")]
        return self._replace(done.drop(*scratch))

    def _is_double(self, value: Column) -> bool:
        return isinstance(self.df.select(value).schema[0].dataType, T.FloatType | T.DoubleType)

    def _exactly(self, specs: dict[str, Running], limbs: dict[str, Limbs]) -> Ordered:
        """The same with sums of doubles as sums of their limbs."""
        names, apart = {}, {}
        for name, spec in specs.items():
            if name not in limbs:
                apart[name] = spec
                continue
            parts = limbs[name].parts(spec.value)
            names[name] = [f"_limb_{i}_{name}" for i in range(len(parts))]
            apart |= {n: running_sum(p, spec.inclusive) for n, p in zip(names[name], parts)}
        done = self.running(**apart).with_columns({n: limbs[n].total([F.col(c) for c in cs]) for n, cs in names.items()})
        return self._replace(done.df.drop(*[c for cs in names.values() for c in cs]))

    def _pieces(self, df: DataFrame, parts: dict[str, Column]) -> Ordered:
        """One row per piece, in order."""
        rows = df.filter(F.col(PIECE).isNotNull()).groupBy(*self._by).agg(*[c.alias(n) for n, c in parts.items()])
        return Ordered(written(rows.withColumnRenamed(PIECE, PLACE), "pieces"), self.keys, [PLACE], self.hot.of_pieces())

    def _with_pieces(self, df: DataFrame, pieces: DataFrame, columns: list[str]) -> DataFrame:
        """Every row with columns of its piece."""
        of = {k: f"_of_{k}" for k in [*self.keys, PLACE]}
        renamed = pieces.select(*[F.col(k).alias(n) for k, n in of.items()], *columns)
        cond = [F.col(k).eqNullSafe(F.col(of[k])) for k in self.keys] + [F.col(PIECE) == F.col(of[PLACE])]
        return df.join(renamed, cond, "left").drop(*of.values())

    def ahead(self, value: Column, n: int) -> Ordered:
        """Add ``_1`` to ``_n``: ``value`` one to ``n`` rows further on, NULL beyond the key's last row.

        One pass for any ``n``: a piece takes over the first ``n`` rows of the pieces after it.
        """
        df = self.df.withColumn("_v", F.struct(value.alias("v")))
        own = self._window(self.order, False)
        steps = range(1, n + 1)
        done = df.withColumns({f"_own_{i}": F.lead("_v", i).over(own) for i in steps})
        if not self.cut:
            done = done.withColumns({f"_{i}": F.col(f"_own_{i}")["v"] for i in steps})
            return self._replace(done.drop("_v", *[f"_own_{i}" for i in steps]))
        firsts = df.withColumn("_at", F.row_number().over(own)).filter(F.col("_at") <= n)
        heads = {"_heads": F.sort_array(F.collect_list(F.struct("_at", "_v")))}
        # No piece is empty, so the next n pieces hold the next n rows.
        later = self._pieces(firsts, heads).ahead(F.col("_heads"), n).df
        carry = F.slice(F.flatten(F.array_compact(F.array(*[F.col(f"_{i}") for i in steps]))), 1, n)
        done = self._with_pieces(done, later.withColumn("_carry", carry), ["_carry"])
        inside = sum((F.col(f"_own_{i}").isNotNull().cast("int") for i in steps), F.lit(0))
        done = done.withColumn("_inside", inside)
        for i in steps:
            taken = F.get("_carry", F.greatest(F.lit(0), F.lit(i - 1) - F.col("_inside")))["_v"]
            done = done.withColumn(f"_{i}", F.coalesce(f"_own_{i}", taken)["v"])
        return self._replace(done.drop("_v", "_carry", "_inside", *[f"_own_{i}" for i in steps]))

    def rows(self) -> DataFrame:
        """The rows with the added columns, without the helper columns."""
        return self.df.drop(PIECE, ALL)

    def _window(self, order: Sequence[str], backward: bool):
        spots = [F.col(c).desc() if backward else F.col(c).asc() for c in order]
        return Window.partitionBy(*self._by).orderBy(*spots)

    def _local(self, name: str, spec: Running) -> Column:
        value = F.col(f"_in_{name}")
        if spec.kind == "previous":
            shift = F.lead if spec.backward else F.lag
            return shift(F.struct(value.alias("v"))).over(self._window(self.order, False))
        frame = self._window(self.order, spec.backward).rowsBetween(
            Window.unboundedPreceding, 0 if spec.inclusive else -1
        )
        return _fold(spec.kind, value).over(frame)


def _fold(kind: str, value: Column) -> Column:
    """The running aggregate, over rows or over pieces."""
    match kind:
        case "sum":
            return F.sum(value)
        case "min":
            return F.min(value)
        case "max":
            return F.max(value)
        case "latest":
            return F.last(value, ignorenulls=True)
        case "first":
            return F.first(F.struct(value.alias("v")))
    raise ValueError(kind)


def _reduce(name: str, spec: Running, spot: Column) -> Column:
    """What one piece hands to the pieces after (or, backward, before) it."""
    value = F.col(f"_in_{name}")
    nearest, farthest = (F.min_by, F.max_by) if spec.backward else (F.max_by, F.min_by)
    match spec.kind:
        case "latest":
            return nearest(value, F.when(value.isNotNull(), spot))
        case "previous":
            return nearest(F.struct(value.alias("v")), spot)
        case "first":
            return farthest(F.struct(value.alias("v")), spot)
    return _fold(spec.kind, value)


def _carry(name: str, spec: Running) -> Running:
    """What the pieces before (or, backward, after) leave to a piece, as a running value over pieces."""
    part = F.col(f"_part_{name}")
    if spec.kind in ("previous", "first"):
        return Running(spec.kind, part, backward=spec.backward)
    return Running(spec.kind, part, inclusive=False, backward=spec.backward)


def _combine(name: str, spec: Running, cut: bool) -> Column:
    """This piece's value with what the other pieces left."""
    own = F.col(f"_own_{name}")
    if not cut:
        return own["v"] if spec.kind in ("previous", "first") else own
    carry = F.col(f"_carry_{name}")
    match spec.kind:
        case "sum":
            return F.coalesce(carry + own, own, carry)
        case "min":
            return F.least(carry, own)
        case "max":
            return F.greatest(carry, own)
        case "latest":
            return F.coalesce(own, carry)
        case "previous":
            return F.coalesce(own, carry)["v"]
        case "first":
            return F.coalesce(carry, own)["v"]
    raise ValueError(spec.kind)
