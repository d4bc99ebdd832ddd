"""Mixing of sources to target weights: pivotal dependent rounding of fractional copies, in built-in functions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewell.llm.common import placed, saved

#: A word of a text.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents of one source and size class that one group rounds, on average, and residuals that a class may
#: bring to the end, so that the sums of its source can be met closely.
GROUP, LEFT = 64, 8
#: Size classes of an octave.
FINE = 2
#: Copies of one row that a task writes at a time.
COPIES = 10_000


def sizes_of(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size)``: the words of each whole text; null text has none. One read of the texts."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size")
    return saved(docs.select("doc_id", "source", size), "mixing-sizes")


def targets_of(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """``(source, source_size, target)``: ``share`` of all words dealt to the sources by weight; none gets more than
    ``most`` times its size, and what is over is dealt to the others by weight, until none is above.

    Sources take the weights in turns, by code point, null last. The shares after all rounds are
    ``min(level * weight, most * size)`` with one level for all; a round finds the level at which what
    is not stopped yet takes the rest, and one row per round reaches the driver.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("none", F.col("source").isNull())
    turn = (F.col("place") - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), turn.cast("int") + 1).cast("double")
    sources = saved(placed(sources, ["none", "source"]).withColumn("weight", weight), "mixing-sources")
    cap = F.col("source_size") * most
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    level, stopped = 0.0, -1
    while True:
        full = cap <= F.col("weight") * level if stopped >= 0 else F.lit(False)
        row = sources.agg(
            F.count_if(full).alias("stopped"),
            F.sum(F.when(full, cap).otherwise(0.0)).alias("given"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if row.stopped == stopped or not row.weight:
            break
        level, stopped = (total - row.given) / row.weight, row.stopped
    target = F.least(F.col("weight") * level, cap) if stopped >= 0 else F.lit(0.0)
    return sources.select("source", "source_size", target.cast("double").alias("target"))


def uniform(*parts) -> Column:
    """A number in [0, 1) that depends on the parts only."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / float(1 << 53)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def pivot(rows: Column, seed: int | Column) -> Column:
    """Rounds an array of ``(size, x, doc_id)`` pair by pair: all elements in ``done`` have ``x`` 0 or 1, one may not.

    Of two documents one gives words to the other until one is integral; the direction is drawn so
    that each fraction keeps its expectation, and the words of both keep their sum. The other
    document goes on to the next pair.
    """

    def unit(e: Column, x: Column) -> Column:
        return F.struct(e["size"].alias("size"), x.cast("double").alias("x"), e["doc_id"].alias("doc_id"))

    def merge(state: Column, e: Column) -> Column:
        s = state["open"]
        sw, sx, ew, ex = s["size"], s["x"], e["size"], e["x"]

        def moved(m: Column) -> Column:
            up = m["u"] * (m["up"] + m["down"]) < m["down"]
            settled = F.when(up, sw * (1 - sx) <= ew * ex).otherwise(sw * sx <= ew * (1 - ex))
            rest = F.when(settled, F.when(up, ex - m["up"] / ew).otherwise(ex + m["down"] / ew))
            rest = rest.otherwise(F.when(up, sx + m["up"] / sw).otherwise(sx - m["down"] / sw))
            whole = F.when(up == settled, 1.0).otherwise(0.0)
            rest = F.greatest(F.lit(0.0), F.least(F.lit(1.0), rest))
            return F.struct(
                F.when(settled, unit(e, rest)).otherwise(unit(s, rest)).alias("open"),
                F.concat(state["done"], F.array(F.when(settled, unit(s, whole)).otherwise(unit(e, whole)))).alias("done"),
            )

        amounts = F.struct(
            F.least(sw * (1 - sx), ew * ex).alias("up"),
            F.least(sw * sx, ew * (1 - ex)).alias("down"),
            uniform(F.lit(seed), s["doc_id"], sw, e["doc_id"], ew).alias("u"),
        )
        return let(amounts, moved)

    start = F.struct(rows[0].alias("open"), F.slice(rows, F.lit(1), F.lit(0)).alias("done"))
    return F.aggregate(F.slice(rows, F.lit(2), F.size(rows) - 1), start, merge)


def settle(rows: Column, seed: int | Column) -> Column:
    """Rounds what is left of a source, largest first: what one document takes too much or too little the next
    ones make up for, so that at the end about the smallest document's words are amiss."""

    def merge(state: Column, e: Column) -> Column:
        chance = e["x"] + state["owed"] / e["size"]
        x = F.when(uniform(F.lit(seed), e["doc_id"], e["size"]) < chance, 1.0).otherwise(0.0)
        return let(
            F.struct(x.alias("x")),
            lambda t: F.struct(
                (state["owed"] + e["size"] * (e["x"] - t["x"])).alias("owed"),
                F.concat(
                    state["done"],
                    F.array(F.struct(e["size"].alias("size"), t["x"].alias("x"), e["doc_id"].alias("doc_id"))),
                ).alias("done"),
            ),
        )

    start = F.struct(F.lit(0.0).alias("owed"), F.slice(rows, F.lit(1), F.lit(0)).alias("done"))
    return F.aggregate(rows, start, merge)["done"]


def rounded(units: DataFrame, seed: int = 12) -> DataFrame:
    """``units (source, size, x, doc_id)``, ``x`` between 0 and 1, with ``x`` made 0 or 1; written.

    Documents of a source and about one size meet in groups of about ``GROUP`` by a hash of their ids, a
    group's one residual goes up to the next level, and so on like a tree, until at most about ``LEFT``
    residuals of each size class are left; those of a source, a bounded number, are settled together.
    The number of groups of a level is the same for all sources, so that a source of any share is cut
    into even groups without being counted.
    """
    levels, groups, done = [], max(1, math.ceil(units.count() / GROUP)), []
    while groups > LEFT:
        levels.append(groups)
        groups = math.ceil(groups / GROUP)
    unit = F.struct("size", "x", "doc_id")
    # A residual that came out whole is done as well.
    whole = (F.col("x") <= 0) | (F.col("x") >= 1)
    left = units.where(~whole)
    done.append(units.where(whole).select("source", "size", "x", "doc_id"))
    octave = F.floor(F.log2("size") * FINE).cast("int").alias("octave")
    for level, groups in enumerate([*levels, LEFT]):
        group = F.pmod(F.xxhash64(F.lit(level), "doc_id", "size"), F.lit(groups)).alias("group")
        met = left.select("source", octave, group, unit.alias("unit")).groupBy("source", "octave", "group")
        met = met.agg(F.array_sort(F.collect_list("unit")).alias("units"))
        result = met.select("source", pivot(F.col("units"), seed + level).alias("r"))
        result = result.select("source", F.explode(F.concat(F.col("r.done"), F.array("r.open"))).alias("u")).select("source", "u.*")
        result = saved(result, "mixing-level")
        done.append(result.where(whole).select("source", "size", "x", "doc_id"))
        left = result.where(~whole)
    last = left.groupBy("source").agg(F.reverse(F.array_sort(F.collect_list(unit))).alias("units"))
    last = last.select("source", F.explode(settle(F.col("units"), seed + 999)).alias("u")).select("source", "u.*")
    done.append(last.select("source", "size", "x", "doc_id"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return saved(out, "mixing-rounded")


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for every row: how many words the mix takes of each
    document, its copies times its size.

    A document of a source with target t and size s is wanted t / s times; the whole part it gets for
    certain, the fraction is rounded by ``rounded``. All randomness comes from hashes of ids and sizes,
    so that reruns agree whatever the partitions. Rows that are equal in id, source and size are one
    unit: of m such rows with fraction x the whole part of m * x get one more copy, and the rest is
    one fraction. Null texts and texts without words have size 0 and take nothing; a null source is a
    source; null and repeated ids are kept; an empty table gives none; other columns are ignored.
    """
    sizes = sizes_of(docs)
    targets = saved(targets_of(sizes, weights, share, most), "mixing-targets")
    units = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("m"))
    # Null sources join by a key that no other source has.
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    known = targets.select(key.alias("key"), "source_size", "target")
    units = units.withColumn("key", key).join(known, "key").drop("source")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    units = units.withColumn("sure", F.floor(rate)).withColumn("wanted", F.col("m") * (rate - F.col("sure")))
    units = units.withColumn("more", F.floor("wanted")).withColumn("x", F.col("wanted") - F.col("more"))
    units = saved(units.drop("wanted"), "mixing-units")
    drawn = rounded(units.where(F.col("size") > 0).select(F.col("key").alias("source"), "size", "x", "doc_id"))
    drawn = drawn.where(F.col("x") == 1).select(
        F.col("source").alias("key"), F.col("size").alias("u_size"), F.col("doc_id").alias("u_id"), F.lit(1).alias("drawn")
    )
    same = (F.col("size") == F.col("u_size")) & F.col("doc_id").eqNullSafe(F.col("u_id"))
    units = units.join(drawn.withColumnRenamed("key", "u_key"), same & (F.col("key") == F.col("u_key")), "left")
    units = units.withColumn("more", F.col("more") + F.coalesce("drawn", F.lit(0)))
    columns = ["doc_id", "size", "source_size", "target"]
    once = units.where(F.col("m") == 1).select(*columns, ((F.col("sure") + F.col("more")) * F.col("size")).alias("taken"))
    # Equal rows are told apart by a number, dealt out in stretches.
    stretch = F.explode(F.sequence(F.lit(0), F.floor((F.col("m") - 1) / COPIES))).alias("stretch")
    again = units.where(F.col("m") > 1).select(*columns, "m", "sure", "more", stretch).repartition("doc_id", "size", "stretch")
    first = F.col("stretch") * COPIES
    number = F.explode(F.sequence(first, F.least(first + COPIES, F.col("m")) - 1)).alias("number")
    again = again.select(*columns, "sure", "more", number)
    copies = F.col("sure") + F.when(F.col("number") < F.col("more"), 1).otherwise(0)
    rows = once.unionByName(again.select(*columns, (copies * F.col("size")).alias("taken")))
    return rows.withColumn("taken", F.col("taken").cast("bigint"))
