"""First come, first served against limited stock, settled in parallel rounds (H5, H7, E5).

The rule is sequential: units (carts, or single lines) are taken in order, each
one whole or not at all, against what the units accepted before it have left.
Two kinds of rounds settle it without walking through the units.

*Bounds.* With the running sums of each resource, an open line surely fits if
even all open lines before it leave enough, and surely does not fit if the
accepted ones alone leave too little. A unit all of whose lines surely fit is
accepted, one with a line that surely does not is refused. The first open unit
is always settled.

*Halving.* A chain of lines that each wait for the one before would take a
bounds round for every link. Where one resource alone decides its open units
(their other lines surely fit), the sequence of that resource's lines is settled
exactly. With ``left`` in stock, lines over ``left`` are refused; of the rest,
call a line small up to ``left / 2`` and large above. As long as the small
lines' running sum stays within ``left / 2``, every small line fits, and a large
one fits only if that sum leaves enough for it. So up to the first place where
the sum passes ``left / 2``, or where a large line fits, all small lines are
granted and all large ones refused; there, the line itself is granted and
``left`` has fallen below its half. Log2(stock) such rounds settle any number of lines, all
resources at once.

Bounds rounds come first: usual contention needs a few. When one settles less
than half of the open lines, halving takes over where it can. Carts that wait
for each other across several contested resources keep needing bounds rounds.

Scale: only lines of contested resources (demand over stock) take part, only
open lines are written again, and no line is sorted into ranges twice. A
resource with a third of all lines lies in a third of the ranges; lines meet
the state of their resource by (resource, range), never by the resource alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.functions.windows import by_ranges, ranged_sums


def _stored(df: DataFrame) -> DataFrame:
    from emporia.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, "emporia-accept")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _units_join(lines: DataFrame, units: DataFrame, unit: list[str], how: str) -> DataFrame:
    """Null-safe join on the unit's columns; a unit with a null column is a unit like any other."""
    u = units.withColumnsRenamed({c: f"_u{i}" for i, c in enumerate(unit)})
    same = reduce(lambda a, b: a & b, [lines[c].eqNullSafe(u[f"_u{i}"]) for i, c in enumerate(unit)])
    return lines.join(u, same, how).drop(*[f"_u{i}" for i in range(len(unit))])


def _spots(ranged: DataFrame, resource: str) -> DataFrame:
    """(resource, _range) pairs, written: one row for a resource and a range it lies in."""
    return _stored(ranged.select(resource, "_range").distinct())


def halve(lines: DataFrame, resource: str, order: list[str], trace: list | None = None, spots: DataFrame | None = None) -> DataFrame:
    """The granted ones of single lines (resource, order, quantity, stock, _range, any more), taken in order.

    ``lines`` come from ``by_ranges(..., [resource], order)``; ``order`` is unique within a resource.
    """
    keep = lines.columns
    place = F.struct(*order)
    spots = _spots(lines, resource) if spots is None else spots
    state = lines.groupBy(resource).agg(F.max("stock").cast("long").alias("_left"))
    state = state.withColumn("_after", F.lit(None).cast(lines.select(place.alias("o")).schema["o"].dataType))
    granted, rest = [], lines
    while True:
        here = spots.join(state, resource)
        rest = (rest.select(*keep).join(here, [resource, "_range"])
                .filter((F.col("quantity") <= F.col("_left")) & (F.col("_after").isNull() | (place > F.col("_after"))))
                .withColumn("_small", F.col("quantity") * 2 <= F.col("_left")))
        rest = _stored(ranged_sums(rest, [resource], order, {
            "_sum": F.when(F.col("_small"), F.col("quantity")).otherwise(F.lit(0))}))
        turn = F.when(F.col("_small"), F.col("_sum") * 2 > F.col("_left")).otherwise(F.col("quantity") + F.col("_sum") <= F.col("_left"))
        used = F.col("_sum") + F.when(F.col("_small"), F.lit(0)).otherwise(F.col("quantity"))
        pivots = _stored(rest.filter(turn).groupBy(resource).agg(
            F.min(F.struct(place.alias("_after"), (F.col("_left") - used).cast("long").alias("_left"))).alias("p"))
            .select(resource, "p._left", "p._after"))
        until = spots.join(pivots.select(resource, F.col("_after").alias("_turn")), resource, "left")
        granted.append(rest.drop("_after").join(until, [resource, "_range"])
                       .filter((F.col("_small") & (F.col("_turn").isNull() | (place <= F.col("_turn")))) | (place == F.col("_turn")))
                       .select(*keep))
        if trace is not None:
            trace.append(("halving", rest.count()))
        if pivots.isEmpty():
            return reduce(DataFrame.unionByName, granted)
        state = pivots


def accept_in_order(lines: DataFrame, unit: list[str], resource: str, order: list[str], trace: list | None = None) -> DataFrame:
    """``lines`` plus ``accepted``: first come, first served with all-or-nothing units.

    ``lines`` has the unit's columns, ``resource``, ``quantity`` (not negative),
    ``stock`` (of the resource at the start; null: no such resource) and the
    ``order`` columns; ties in the order go by the unit's columns. A unit has one
    line for a resource at most. A refused unit uses nothing. ``trace`` gets
    (kind, open lines) of each round.
    """
    lines = _stored(lines)
    order = list(dict.fromkeys([*order, *unit]))
    bad = lines.filter(F.col("stock").isNull() | (F.col("quantity") > F.col("stock"))).select(*unit).distinct()
    refused = [bad]
    tries = _units_join(lines, bad, unit, "left_anti")
    contested = (tries.groupBy(resource).agg(F.sum("quantity").alias("_demand"), F.max("stock").alias("_have"))
                 .filter("_demand > _have").select(resource))
    needed = list(dict.fromkeys([*unit, resource, *order, "quantity", "stock"]))
    ranged = by_ranges(tries.join(contested, resource, "left_semi").select(*needed), [resource], order)
    spots = _spots(ranged, resource)
    state = ranged.withColumns({"_taken": F.lit(0).cast("long"), "_in": F.lit(False)})

    def open_lines(of: DataFrame) -> int:
        return of.filter("NOT _in").count()

    n = open_lines(state)
    while n:
        if trace is not None:
            trace.append(("bounds", n))
        sums = ranged_sums(state, [resource], order, {
            "_all": F.when(F.col("_in"), F.lit(0)).otherwise(F.col("quantity")),
            "_new": F.when(F.col("_in"), F.col("quantity")).otherwise(F.lit(0))})
        taken = (F.col("_taken") + F.col("_new")).cast("long")
        seen = (sums.filter("NOT _in").withColumn("_taken", taken)
                .withColumns({"_no": F.col("_taken") + F.col("quantity") > F.col("stock"),
                              "_unsure": (F.col("_taken") + F.col("_all") > F.col("stock")).cast("int")}).drop("_all", "_new", "_in"))
        by_unit = seen.groupBy(*unit).agg(F.max("_no").alias("_any_no"), F.sum("_unsure").alias("_n_unsure"))
        said = F.when(F.col("_any_no"), F.lit(False)).when(F.col("_n_unsure") == 0, F.lit(True))
        seen = _stored(_units_join(seen, by_unit, unit, "inner").withColumn("_said", said).drop("_no", "_any_no"))
        refused.append(seen.filter("NOT _said").select(*unit))
        left = seen.filter("_said IS NULL").count()
        state = seen.filter("_said IS NULL OR _said").withColumn("_in", F.coalesce("_said", F.lit(False)))
        if left * 2 > n:
            alone = (seen.filter("_said IS NULL").groupBy(resource).agg(F.max(F.col("_n_unsure") - F.col("_unsure")).alias("_others"))
                     .filter("_others = 0").select(resource))
            alone = _stored(spots.join(alone, resource, "left_semi"))
            if not alone.isEmpty():
                gone = reduce(DataFrame.unionByName, refused).distinct()
                whole = _units_join(ranged.join(alone, [resource, "_range"], "left_semi"), gone, unit, "left_anti")
                granted = halve(_stored(whole), resource, order, trace, alone).select(*unit).distinct().withColumn("_yes", F.lit(True))
                asked = seen.filter("_said IS NULL").join(alone, [resource, "_range"], "left_semi").select(*unit).distinct()
                verdict = _stored(_units_join(asked, granted, unit, "left").select(*unit, F.coalesce("_yes", F.lit(False)).alias("_yes")))
                refused.append(verdict.filter("NOT _yes").select(*unit))
                state = _stored(_units_join(state, verdict, unit, "left").filter("_yes IS NULL OR _yes")
                                .withColumn("_in", F.col("_in") | F.coalesce("_yes", F.lit(False))).drop("_yes"))
                left = open_lines(state)
        state = state.drop("_unsure", "_n_unsure", "_said")
        n = left
    gone = reduce(DataFrame.unionByName, refused).distinct().withColumn("_gone", F.lit(True))
    return _units_join(lines, gone, unit, "left").withColumn("accepted", F.col("_gone").isNull()).drop("_gone")
