"""Mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size says how many copies of each of its
documents the mix wants: a whole part, and a fraction that has to be rounded.
Rounding is dependent: two documents with fractions trade words, a random one
of the two gaining what the other loses, until one of them is at no copy or at
a full copy. Each trade keeps the sum of words and each document's expected
copies as they were, so that a source ends within one document of its target.

The trades run as a reduction tree. Leaves are groups of about ``FANOUT``
documents of one source; each leaf trades on its own, larger documents first
so that what is left tends to be small, and passes on the one document that is
still fractional; these are grouped anew
until one is left for each source, which is rounded at random. Only groups of
bounded size are ever gathered, however many rows a source has. All random
draws are hashes of what is traded, so that reruns agree.

Identical rows are one unit with that many copies at stake. Words are counted
in units of 1/``GRAIN`` so that sums are exact.

Defined cases: a null text or one without words has size 0 and is never taken;
a null source comes after all others; null and repeated ids are kept; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitlens.llm.common import WORD_PATTERN, stored

#: The cycle of weights, in the order of the sources' names.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
FANOUT = 128
GRAIN = 1 << 16


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST, weights=WEIGHTS) -> DataFrame:
    """``source``, ``source_size``, ``target`` from a table of (source, size) sums.

    Sources are ranked by the code points of their names (UTF-8 order is code
    point order). A source whose share passes ``most`` times its size stops
    there, and what is over goes to the others by weight until none is above.
    Stated in closed form: with sources sorted by size / weight, the ones that
    stop are those whose ratio is below what is left for the rest. Sources
    without words have target 0. The table has one row for each source.
    """
    total = Window.partitionBy(F.lit(0))
    order = total.orderBy(F.col("source").isNull(), F.hex(F.col("source")))
    weighted = sizes.withColumn("weight", F.element_at(
        F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1))
    # By ratio of cap to weight: those before a source that stops have stopped as well.
    ratio = total.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.hex(F.col("source")))
    ranked = weighted.withColumn("cap", most * F.col("source_size")).withColumns({
        "rank": F.row_number().over(ratio),
        "caps_before": F.coalesce(F.sum("cap").over(ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "weights_left": F.sum("weight").over(ratio.rowsBetween(0, Window.unboundedFollowing)),
        "wanted": F.sum("source_size").over(total) * F.lit(float(share)),
    })
    left = F.col("wanted") - F.col("caps_before")
    stops = left * F.col("weight") >= F.col("cap") * F.col("weights_left")
    level = F.min(F.when(~stops, F.col("rank"))).over(total)
    leveled = ranked.withColumn("first_free", level)
    free = F.col("first_free").isNotNull() & (F.col("rank") >= F.col("first_free"))
    pour = F.max(F.when(F.col("rank") == F.col("first_free"), left / F.col("weights_left"))).over(total)
    return leveled.withColumn("pour", pour).select(
        "source", "source_size",
        F.when(free, F.col("pour") * F.col("weight")).otherwise(F.col("cap")).cast("double").alias("target"))


def _draw(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 53)) / F.lit(float(1 << 53))


def _trade(group: Column, seed: int) -> Column:
    """Sequential trades in an array of (unit, size, mass): struct(left, done).

    ``mass`` is the part of ``size`` (both in grains) that is still to be
    rounded. ``done`` has (unit, up) of every unit that became whole; ``left``
    is the one still fractional, or null.
    """
    unit = "struct<unit:struct<a:bigint,b:bigint>,size:bigint,mass:bigint>"
    none = F.lit(None).cast(unit)
    empty = F.array().cast("array<struct<unit:struct<a:bigint,b:bigint>,up:int>>")

    def step(state: Column, x: Column) -> Column:
        y = state.left
        # What y can give x, and x can give y.
        to_x = F.least(x.size - x.mass, y.mass)
        to_y = F.least(y.size - y.mass, x.mass)
        x_gains = _draw(x.unit, y.unit, x.mass, y.mass, F.lit(seed)) * (to_x + to_y) < to_y
        moved = F.when(x_gains, to_x).otherwise(-to_y)
        new_x = F.struct(x.unit.alias("unit"), x.size.alias("size"), (x.mass + moved).alias("mass"))
        new_y = F.struct(y.unit.alias("unit"), y.size.alias("size"), (y.mass - moved).alias("mass"))
        whole = lambda z: (z.mass == 0) | (z.mass == z.size)
        out = lambda z: F.array(F.struct(z.unit.alias("unit"), (z.mass == z.size).cast("int").alias("up")))
        pair = F.struct(new_x.alias("x"), new_y.alias("y"))

        def settle(p: Column) -> Column:
            both = whole(p.x) & whole(p.y)
            return F.struct(
                F.when(both, none).when(whole(p.x), p.y).otherwise(p.x).alias("left"),
                F.concat(state.done, F.when(both, F.concat(out(p.x), out(p.y)))
                         .when(whole(p.x), out(p.x)).otherwise(out(p.y))).alias("done"))

        first = F.struct(x.alias("left"), state.done.alias("done"))
        # transform over one element names the pair, so that it is computed once.
        return F.when(y.isNull(), first).otherwise(F.element_at(F.transform(F.array(pair), settle), 1))

    return F.aggregate(group, F.struct(none.alias("left"), empty.alias("done")), step)


def rounded_units(units: DataFrame, name: str, seed: int = 10) -> DataFrame:
    """(unit, up) for a table of (source, unit, size, mass) with 0 < mass < size."""
    left = stored(units, f"{name}-units")
    done, level = None, 0
    while True:
        count = left.groupBy("source").agg(F.count("*").alias("n"))
        if level and count.filter("n > 1").isEmpty():
            break
        # About FANOUT units in each leaf: a hash of the unit says which.
        leaves = count.select(F.col("source").alias("_s"), F.ceil(F.col("n") / FANOUT).alias("leaves"))
        spread = left.join(leaves, F.col("source").eqNullSafe(F.col("_s"))).withColumn(
            "leaf", F.pmod(F.xxhash64("unit", F.lit(seed + level)), F.col("leaves")))
        out = _gather(spread, ["source", "leaf"], f"{name}-level", seed + level)
        step = out.select(F.inline("traded.done"))
        done = step if done is None else done.unionByName(step)
        left = out.filter("traded.left IS NOT NULL").select("source", "traded.left.*")
        level += 1
    last = left.select("unit", (_draw(F.col("unit"), F.col("mass"), F.lit(seed)) * F.col("size") < F.col("mass"))
                       .cast("int").alias("up"))
    return done.unionByName(last)


def _gather(units: DataFrame, keys: list[str], name: str, seed: int) -> DataFrame:
    group = F.sort_array(F.collect_list(F.struct("size", "unit", "mass")), asc=False)
    group = F.transform(group, lambda x: F.struct(x.unit.alias("unit"), x["size"].alias("size"), x.mass.alias("mass")))
    return stored(units.groupBy(*keys).agg(group.alias("g")).select(*keys, _trade(F.col("g"), seed).alias("traded")), name)


def mix_units(docs: DataFrame, name: str = "mix", id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source") -> DataFrame:
    """One row for each distinct (doc_id, source, text) with what the mix takes of it.

    Columns: doc_id, source, ``unit`` (two hashes of the text, the id and the
    source), ``rows`` (how often it occurs), size, source_size, target and
    ``copies``, the copies of all its rows together.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                        unit_of(F.col(id_col), F.col(source_col), F.col(text_col)).alias("unit"),
                        words(F.col(text_col)).alias("size"))
    units = stored(plain.groupBy("doc_id", "source", "unit", "size").agg(F.count("*").alias("rows")), f"{name}-sizes")
    sums = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    wanted = stored(targets(sums), f"{name}-targets").withColumnRenamed("source", "_s")
    units = units.join(wanted, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.least(rate * F.col("rows"), F.lit(float(MOST)) * F.col("rows"))
    units = units.withColumn("whole", F.floor(copies)).withColumn(
        "mass", F.round((copies - F.col("whole")) * F.col("size") * GRAIN).cast("long"))
    grains = F.col("size") * GRAIN
    units = units.withColumn("whole", F.when((F.col("mass") >= grains) & (grains > 0), F.col("whole") + 1)
                             .otherwise(F.col("whole")))
    open_units = units.filter((F.col("mass") > 0) & (F.col("mass") < grains)).select(
        "source", "unit", grains.alias("size"), "mass")
    up = rounded_units(open_units, name).withColumnRenamed("unit", "_u")
    taken = units.join(up, units["unit"] == F.col("_u"), "left").drop("_u")
    copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce("up", F.lit(0))).otherwise(0).cast("long")
    return taken.select("doc_id", "source", "unit", "rows", "size", "source_size", "target", copies.alias("copies"))


def unit_of(doc_id: Column, source: Column, text: Column) -> Column:
    parts = [F.coalesce(x.cast("string"), F.lit("")) for x in (doc_id, source, text)]
    nulls = [x.isNull() for x in (doc_id, source, text)]
    return F.struct(F.xxhash64(*parts, *nulls).alias("a"), F.xxhash64(*nulls, *parts[::-1], F.lit(1)).alias("b"))


def _share(copies: Column, rows: Column, row: Column) -> Column:
    """Copies of the row-th (from 0) of a unit's identical rows."""
    return (F.floor(copies / rows) + F.when(row < copies % rows, 1).otherwise(0)).cast("long")


def mix(docs: DataFrame, **columns: str) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken, one row for each row of ``docs``."""
    units = mix_units(docs, **columns)
    # Two short sequences instead of one as long as the unit's rows.
    part = F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(FANOUT * FANOUT).cast("long"))
    rows = units.withColumn("part", F.explode(part)).withColumn("row", F.explode(
        F.sequence(F.col("part"), F.least(F.col("part") + FANOUT * FANOUT, F.col("rows")) - 1)))
    copies = _share(F.col("copies"), F.col("rows"), F.col("row"))
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                       (copies * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, with all their columns."""
    columns = docs.columns
    units = mix_units(docs, "mixed", id_col, text_col, source_col)
    units = stored(units.filter("copies > 0").select(F.col("unit").alias("_unit"), F.col("rows").alias("_rows"),
                                                     F.col("copies").alias("_copies")), "mixed-copies")
    unit = unit_of(F.col(id_col), F.col(source_col), F.col(text_col))
    joined = docs.withColumn("_unit", unit).join(units, "_unit")
    single = joined.filter("_rows = 1").withColumn("_take", F.col("_copies"))
    order = Window.partitionBy("_unit").orderBy(*[F.lit(0)])
    if units.filter("_rows > 1").isEmpty():  # else the join would be planned twice for nothing
        return _copied(single, columns)
    several = joined.filter("_rows > 1").withColumn("_row", F.row_number().over(order) - 1).withColumn(
        "_take", _share(F.col("_copies"), F.col("_rows"), F.col("_row"))).drop("_row")
    return _copied(single.unionByName(several), columns)


def _copied(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.filter("_take > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_take")))).select(*columns)
