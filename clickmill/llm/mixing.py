"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a share of all words; a document's expected number of copies is its source's share
over its source's size. The fractional parts are rounded in pairs: mass, measured in words, moves
from one document to the other until one of the two is integral, in a random direction whose
expectation is zero. So a source's words stay what they were up to one short document. Pairs are taken
within blocks, whose one fractional document each goes up a tree of blocks until one is left.
All of it is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.llm.common import BROADCAST_ROWS, WORD_PATTERN, kept

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK = 128  # documents rounded one after the other
TIERS = (4.0, 0.5)  # lengths, against the mean of the source, above which documents go first
EXPAND = 4096  # repeated rows unfolded at once
RANGES = 512  # of sources, in each of which running sums are taken
RANGE_ROWS = 10_000  # sources in a range, as long as there are fewer ranges
SEED = 20240501
UNIT = "struct<doc_id: bigint, size: bigint, copy: bigint, mass: double, luck: double>"


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size``; the size of a text is its number of words, 0 for null."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD_PATTERN)).cast("bigint")
    return docs.select("doc_id", "source", words.alias("size"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = CAP, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``source, source_size, documents, target`` for every source, null included and sorted last.

    Targets are ``min(cap * source_size, level * weight)``. The level at which they add up to all
    words is where sharing out the excess over the caps again and again ends. It is found from
    running sums over the sources in the order in which they reach their caps. No task holds all
    sources: places and sums are taken within ranges of the order, ``RANGES`` at most, of some
    ``range_rows`` sources or more, and a row per range adds what lies before it.
    """
    sources = kept(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("documents")),
        "mix-sources")
    ranges = min(RANGES, 1 + sources.count() // range_rows)
    by_name = [F.col("source").asc_nulls_last()]
    placed = _running(sources, ranges, by_name, {"place": F.lit(1.0)}, "mix-places")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = placed.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(cap)).drop("place")
    total = weighed.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    filled = _running(
        weighed.withColumn("full", F.col("most") / F.col("weight")), ranges, [F.col("full").asc(), *by_name],
        {"most_before": F.col("most"), "weight_before": F.col("weight")}, "mix-levels")
    level = (F.lit(float(total["words"] or 0)) - F.col("most_before")) / (F.lit(total["weight"] or 0.0) - F.col("weight_before"))
    leveled = filled.withColumn("level", level).withColumn("capped", F.col("most") <= F.col("level") * F.col("weight"))
    # Beyond the first source below its cap the running levels only fall.
    final = leveled.where(~F.col("capped")).agg(F.max("level")).first()[0]
    return leveled.select(
        "source", "source_size", "documents",
        F.when(F.col("capped"), F.col("most")).otherwise(F.col("weight") * F.lit(final)).alias("target"))


def _running(rows: DataFrame, ranges: int, order: list[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """``rows`` with the sum, as a double, of each of ``sums`` over all rows before it in ``order``, which has no ties."""
    parted = kept(rows.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), name)
    totals = parted.groupBy("range").agg(*(F.sum(c.cast("double")).alias(s) for s, c in sums.items()))
    listed = totals.agg(F.collect_list(F.struct("range", *sums)).alias("all"))
    before = listed.select(F.explode(F.transform("all", lambda one: F.struct(
        one["range"].alias("range"), *(_before(one, s).alias(f"{s}_ranges") for s in sums)))).alias("r")).select("r.*")
    within = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = parted.select("*", *(F.coalesce(F.sum(c.cast("double")).over(within), F.lit(0.0)).alias(s) for s, c in sums.items()))
    # A row per range: at most RANGES of them.
    return summed.join(F.broadcast(before), "range").select(
        *rows.columns, *((F.col(s) + F.col(f"{s}_ranges")).alias(s) for s in sums))


def _before(one: Column, name: str) -> Column:
    """The sum of ``name`` over the ranges before ``one``."""
    return F.aggregate(
        F.filter("all", lambda other: other["range"] < one["range"]), F.lit(0.0), lambda total, other: total + other[name])


def _luck(seed: int, *by: Column) -> Column:
    """A number in [0, 1) that depends only on what it is given."""
    return F.pmod(F.xxhash64(F.lit(seed), *by), F.lit(1 << 52)) / float(1 << 52)


def _unit(one: Column, mass: Column) -> Column:
    return F.struct(one["doc_id"].alias("doc_id"), one["size"].alias("size"), one["copy"].alias("copy"),
                    mass.alias("mass"), one["luck"].alias("luck"))


def _meet(state: Column, other: Column) -> Column:
    """One pair: the open document and the next. One of them is decided, the other stays open.

    Up moves words from the next to the open one, down the other way, each as far as it goes; the
    chance of each is the reach of the other, so that nobody's expectation changes.
    """
    one = state["open"]
    a, b = one["size"].cast("double"), other["size"].cast("double")
    up = F.least((1 - one["mass"]) * a, other["mass"] * b)
    down = F.least(one["mass"] * a, (1 - other["mass"]) * b)
    goes_up = other["luck"] * (up + down) < down
    moved = F.when(goes_up, up).otherwise(-down)
    one_ends = F.when(goes_up, (1 - one["mass"]) * a <= other["mass"] * b).otherwise(
        one["mass"] * a <= (1 - other["mass"]) * b)
    # The decided one is 1 if it was filled, that is the open one going up or the next going down.
    ended = F.when(one_ends == goes_up, F.lit(1.0)).otherwise(F.lit(0.0))
    done = _unit(F.when(one_ends, one).otherwise(other), ended)
    left = F.when(one_ends, _unit(other, F.greatest(F.lit(0.0), F.least(F.lit(1.0), other["mass"] - moved / b)))).otherwise(
        _unit(one, F.greatest(F.lit(0.0), F.least(F.lit(1.0), one["mass"] + moved / a))))
    return F.struct(left.alias("open"), F.array_append(state["done"], done).alias("done"))


def _fold(units: Column) -> Column:
    start = F.struct(F.element_at(units, 1).alias("open"), F.array().cast(f"array<{UNIT}>").alias("done"))
    rest = F.slice(units, F.lit(2), F.greatest(F.size(units) - 1, F.lit(0)))
    return F.aggregate(rest, start, _meet)


def round_up(units: DataFrame, most: int, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """``source, doc_id, size, copy, up`` (0 or 1) for ``source, doc_id, size, copy, mass, units``.

    Masses lie between 0 and 1, sizes above 0, and no two units agree in everything. ``units`` is
    at least the number of the source's units, ``most`` the largest such number. Block after
    block and level after level; a source with a third of all rows is as many blocks as it needs.
    """
    key = ("source", "doc_id", "size", "copy")
    level_rows = units.select(*key, "mass", F.ceil(F.col("units") / block).cast("bigint").alias("blocks"))
    results, level = [], 0
    while True:
        rows = level_rows.withColumn("luck", _luck(seed + level, *(F.col(k) for k in key))).withColumn(
            "block", F.pmod(F.xxhash64(F.lit(seed - 1 - level), *(F.col(k) for k in key)), F.col("blocks")))
        unit = F.struct("doc_id", "size", "copy", "mass", "luck")
        # Long documents first: the one left open at the end is then mostly a short one. The order
        # among equals is drawn, and the same in every run.
        group = F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("at"), "luck", unit.alias("unit"))))
        folded = kept(
            rows.groupBy("source", "blocks", "block").agg(group.alias("units"))
            .select("source", "blocks", _fold(F.transform("units", lambda u: u["unit"].cast(UNIT))).alias("state")),
            "mix-level")
        done = folded.select("source", F.explode("state.done").alias("u"))
        results.append(done.select("source", "u.doc_id", "u.size", "u.copy", F.col("u.mass").cast("int").alias("up")))
        most = -(-most // block)
        level += 1
        open_rows = folded.select("source", F.ceil(F.col("blocks") / block).cast("bigint").alias("blocks"), "state.open.*")
        if most <= 1:
            last = _luck(seed + level, *(F.col(k) for k in key)) < F.col("mass")
            results.append(open_rows.select(*key, last.cast("int").alias("up")))
            break
        level_rows = open_rows.select(*key, "mass", "blocks")
    out = results[0]
    for more in results[1:]:
        out = out.union(more)
    return out


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = CAP,
        block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``
    (``doc_id, text, source``).

    ``taken`` is the size times the copies taken, at most ``cap`` of them. Null texts have size 0
    and are never taken; a null source is a source of its own; rows that agree in id, source and
    size are rounded as separate units, null ids included. A very long text is one unit of its size,
    settled before shorter ones. No rows give no rows. Other columns are not read. Reruns agree: chance comes from hashes of the rows.
    """
    sizes = kept(sized(docs), "mix-sizes")
    goals = kept(targets(sizes, weights, cap), "mix-targets")
    # Equal rows are counted first, then numbered, so that each is a unit of its own.
    alike = sizes.groupBy("source", "doc_id", "size").agg(F.count("*").alias("n"))
    hundreds = alike.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {EXPAND}"))).alias("part"))
    upto = F.least(F.col("n") - F.col("part") * EXPAND, F.lit(EXPAND).cast("bigint")) - 1
    units = hundreds.select(
        "source", "doc_id", "size",
        F.explode(F.sequence(F.col("part") * EXPAND, F.col("part") * EXPAND + upto)).alias("copy"))
    side = F.broadcast if goals.count() <= BROADCAST_ROWS else lambda df: df
    settled = _settle(units, side(goals), side, block, seed)
    whole, _ = _parts()
    copies = F.when(F.col("size") > 0, whole + F.col("up")).otherwise(F.lit(0))
    return _with_goal(settled, side(goals)).select(
        "doc_id", "size", "source_size", "target", (copies.cast("bigint") * F.col("size")).alias("taken"))


def _with_goal(rows: DataFrame, goals: DataFrame) -> DataFrame:
    return rows.alias("u").join(goals.alias("g"), F.col("u.source").eqNullSafe(F.col("g.source"))).select(
        "u.*", *(f"g.{c}" for c in goals.columns if c != "source"))


def _parts() -> tuple[Column, Column]:
    """Whole and fractional part of the copies expected of a document.

    Exact thirds and wholes come out a rounding error off; those count as whole.
    """
    expected = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    near = F.round(expected)
    whole = F.when(F.abs(expected - near) < 1e-9, near).otherwise(F.floor(expected))
    return whole, F.greatest(F.lit(0.0), expected - whole)


def _settle(units: DataFrame, goals: DataFrame, side: Callable, block: int, seed: int) -> DataFrame:
    """``source, doc_id, size, copy, up`` for every unit, long documents before short ones.

    A long document is still open when all the words it could trade with are used up, and rounding
    it then would miss the target by its length. So the documents of a source are settled in tiers
    by length; what one tier misses is spread evenly, as mass, over the shorter ones. ``side`` marks
    tables of a row per source for broadcast if there are few enough.
    """
    _, part = _parts()
    parts = _with_goal(units, goals).withColumn("part", part)
    lengths = F.col("source_size") / F.greatest(F.col("documents"), F.lit(1))
    tier = F.when(F.col("size") > TIERS[0] * lengths, 0)
    for number, factor in enumerate(TIERS[1:], 1):
        tier = tier.when(F.col("size") > factor * lengths, number)
    open_units = (F.col("size") > 0) & (F.col("part") > 1e-9)
    rows = kept(parts.select(
        "source", "doc_id", "size", "copy", "part",
        F.when(open_units, tier.otherwise(len(TIERS))).alias("tier")), "mix-units")
    out = rows.where("tier IS NULL").select("source", "doc_id", "size", "copy", F.lit(0).alias("up"))
    words = kept(rows.where("tier IS NOT NULL").groupBy("source", "tier").agg(
        F.sum("size").alias("words"), (F.max("part") * F.sum("size")).alias("goal"), F.count("*").alias("units")), "mix-words")
    most = {r["tier"]: r["most"] for r in words.groupBy("tier").agg(F.max("units").alias("most")).collect()}
    left = words.groupBy("source").agg(F.sum("goal").alias("goal"))
    taken = words.where("false").select("source", "tier", "words")
    for number in range(len(TIERS) + 1):
        if number not in most:
            continue
        have = words.where(F.col("tier") >= number).groupBy("source").agg(
            F.sum("words").alias("room"), F.sum(F.when(F.col("tier") == number, F.col("units"))).alias("units"))
        used = taken.groupBy("source").agg(F.sum("words").alias("used"))
        same = lambda x, y: F.col(f"{x}.source").eqNullSafe(F.col(f"{y}.source"))
        masses = left.alias("l").join(have.alias("h"), same("l", "h")).join(used.alias("s"), same("l", "s"), "left").select(
            "l.source", "units", F.greatest(F.lit(0.0), F.least(F.lit(1.0), (
                F.col("goal") - F.coalesce(F.col("used"), F.lit(0))) / F.col("room"))).alias("mass"))
        mine = _with_goal(rows.where(F.col("tier") == number).select("source", "doc_id", "size", "copy"), side(masses))
        between = (F.col("mass") > 1e-9) & (F.col("mass") < 1 - 1e-9)
        plain = mine.where(~between).withColumn("up", F.round("mass").cast("int")).drop("mass", "units")
        drawn = kept(plain.union(round_up(mine.where(between), most[number], block, seed + 100 * number)), "mix-tier")
        taken = taken.union(drawn.where("up = 1").groupBy("source").agg(F.sum("size").alias("words")).select(
            "source", F.lit(number).alias("tier"), "words"))
        out = out.union(drawn)
    return out
