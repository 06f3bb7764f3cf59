"""Mixing sources to target weights with Pareto order sampling.

1. **Targets.** Sources share ``share`` times all words by weight; a target stops at ``cap`` times its source's words, and
   the excess is shared again by weight until none is above.
2. **Certain copies.** A document's expected copies grow with a power of its size (sizes are classed in quarter octaves,
   so a source has at most a few hundred classes), up to ``cap``, and are scaled so that they meet the target. Whole
   copies are certain; the fraction that is left is the probability of one more.
3. **Pareto order.** Each document has a random number from its own content. Its odds, divided by the odds of its
   inclusion, rank the documents of a source; the lowest ranks are taken while they fit the words that the certain copies
   leave open, and one more document, the one nearest to what is left. The sample's size in words is fixed, and each
   inclusion close to its probability.

No source is gathered or sorted: the rank at which a source is full is found by two sums over 4,096 intervals of the rank
and, in the one interval of 2^24 that is left, rank by rank. Sources' own rows (one each) meet in one task for the targets.
Texts are read for their sizes, and by `mixed` once more for the mix itself. They are shuffled only where rows of one rank
are taken in part.

Defined cases: a null text has no words; null sources are one source, last in order; a document without words follows the
same ranks and adds none; a source without words has target 0; rows alike in id, source and text share one rank, and where
that rank is the one at which the source is full, as many of them are taken as fit; which of them is open, and only other
columns could tell; a text of any length is one row and read once for its size; an empty table gives an empty table; names
may differ from others in case only; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.frames import WORD, packed, staged, unpacked

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
POWER = 0.5
SEED = 20_17
_SIDE = 4096


@dataclass(frozen=True)
class Mix:
    """``rates``: expected copies by source and size class. ``cuts``: the rank at which each source is full.

    ``split``: whether rows of one rank are taken in part anywhere, which only rows alike can be.
    """

    rates: DataFrame
    cuts: DataFrame
    seed: int
    split: bool


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``__row``, the source's key, the size in words, its class and the random number."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = F.col("source").cast("string")
    size = F.regexp_count(text, F.lit(WORD)).cast("long")
    random = F.xxhash64(F.lit(seed), "doc_id", source, text)
    return packed(docs, "doc_id", "source", "text").select(
        "__row",
        F.coalesce(F.concat(F.lit("="), source), F.lit("-")).alias("key"),
        size.alias("size"),
        ((F.shiftrightunsigned(random, 12) + 0.5) * 2.0**-52).alias("u"),
    ).withColumn("class", F.floor(4 * F.log2(F.greatest("size", F.lit(1)))).cast("int"))


def plan(
    rows: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    power: float = POWER,
    seed: int = SEED,
) -> Mix:
    """Find rates and cuts for ``sized`` rows. ``weights`` repeat over the sources in code point order."""
    classes = rows.groupBy("key", "class").agg(F.sum("size").alias("words"))
    classes = staged(classes, "mix-classes")
    rates = staged(_rates(classes, targets(classes, weights, share, cap), cap, power), "mix-rates")
    need = rates.groupBy("key").agg(
        F.first("target").alias("target"), F.sum(F.col("words") * F.col("base")).alias("certain")
    )
    need = need.select("key", (F.col("target") - F.col("certain")).alias("need"))
    cuts = staged(_cuts(ranked(rows.select("key", "size", "class", "u"), rates), need), "mix-cuts")
    split = not cuts.where("part_rows < part_of OR last_of > 1").isEmpty()
    return Mix(rates, cuts, seed, split)


def targets(classes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """``(key, source_size, target)``: shares by weight, none above ``cap`` times its source's words."""
    each = classes.groupBy("key").agg(F.sum("words").alias("source_size"))
    order = Window.orderBy(F.col("key") == "-", "key")
    given = F.array(*map(F.lit, map(float, weights)))
    each = each.withColumn("weight", F.get(given, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))))
    # Sources in the order in which a rising level fills them; the level is right where it first fills no further one.
    full_at = F.col("source_size") * cap / F.col("weight")
    rising = Window.orderBy(full_at, "key")
    before = F.coalesce(F.sum(F.col("source_size") * cap).over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy()) * share
    each = each.withColumn("level", (total - before) / rest).withColumn("full_at", full_at)
    fits = F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))
    level = F.min(fits).over(Window.partitionBy()).getField("level")
    target = F.least(F.col("source_size") * cap, F.coalesce(level, F.col("full_at")) * F.col("weight"))
    return each.select("key", "source_size", target.alias("target"))


def _rates(classes: DataFrame, target: DataFrame, cap: float, power: float) -> DataFrame:
    """Copies in proportion to a power of the class's size, scaled to the target with none above ``cap``."""
    rows = classes.join(target, "key").withColumn("pull", F.pow(F.lit(2.0 ** (power / 4)), F.col("class")))
    falling = Window.partitionBy("key").orderBy(F.desc("class"))
    before = F.coalesce(F.sum("words").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * cap
    rest = F.sum(F.col("pull") * F.col("words")).over(falling.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    scale = F.when(rest > 0, (F.col("target") - before) / F.when(rest > 0, rest))
    rows = rows.withColumn("scale", scale)
    fits = F.when(F.col("scale") * F.col("pull") <= cap, F.struct((-F.col("class")).alias("at"), "scale"))
    best = F.min(fits).over(Window.partitionBy("key")).getField("scale")
    wanted = F.least(F.lit(cap), F.coalesce(best * F.col("pull"), F.lit(cap)))
    rows = rows.withColumn("rate", F.when(F.col("source_size") > 0, F.greatest(wanted, F.lit(0.0))).otherwise(0.0))
    base = F.floor(F.col("rate") + 1e-9)
    chance = F.greatest(F.col("rate") - base, F.lit(0.0))
    return rows.select("key", "class", "words", "source_size", "target", base.alias("base"), chance.alias("chance"))


def ranked(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """With their rates and ``rank``: q / (1 + q), q being the random odds over the odds of inclusion. 1 without chance."""
    joined = rows.join(rates.drop("words"), ["key", "class"])
    u, chance = F.col("u"), F.col("chance")
    q = u / (1 - u) * (1 - chance) / F.when(chance > 0, chance)
    joined = joined.withColumn("rank", F.coalesce(q / (1 + q), F.lit(1.0)))
    cell = F.least(F.floor(F.col("rank") * _SIDE * _SIDE), F.lit(_SIDE * _SIDE - 1))
    return joined.withColumn("cell", cell.cast("long"))


def _cuts(rows: DataFrame, need: DataFrame) -> DataFrame:
    """``(key, cut_cell, cut, part, part_rows, part_of, last, last_of)``, one row a source that has open places.

    Taken are cells below ``cut_cell``, in it ranks up to ``cut``, of the ``part_of`` rows of rank ``part`` so many as
    ``part_rows`` says, and of the ``last_of`` rows of rank ``last`` one.
    """
    open_rows = rows.where("chance > 0").select("key", "size", "rank", "cell")
    outer = F.floor(F.col("cell") / _SIDE).cast("long")
    coarse = _crossing(open_rows.groupBy("key", outer.alias("at")).agg(F.sum("size").alias("words")), need)
    # One row a source each; written, so that their size is known and documents are not shuffled to meet them.
    coarse = staged(coarse.withColumnRenamed("at", "outer"), "mix-coarse")
    inside = open_rows.join(coarse, "key").where(outer == F.col("outer"))
    fine = _crossing(
        inside.groupBy("key", F.col("cell").alias("at")).agg(F.sum("size").alias("words")), coarse.select("key", "need")
    )
    fine = staged(fine, "mix-fine")
    # A row a rank, so that a window never meets all rows alike.
    alike = open_rows.join(fine, "key").where("cell = at").groupBy("key", "at", "need", "rank")
    alike = alike.agg(F.max("size").alias("size"), F.sum("size").alias("words"))
    filled = F.sum("words").over(Window.partitionBy("key").orderBy("rank"))
    fits = F.col("filled") <= F.col("need")
    ends = alike.withColumn("filled", filled).groupBy("key", "at", "need").agg(
        F.max(F.when(fits, F.struct("rank", "filled"))).alias("end"),
        F.min(F.when(~fits, F.struct("rank", "size"))).alias("next"),
    )
    left = F.col("need") - F.coalesce("end.filled", F.lit(0))
    part_rows = F.coalesce(F.floor(left / F.col("next.size")), F.lit(0)).cast("long")
    cuts = ends.select(
        "key",
        F.col("at").alias("cut_cell"),
        F.coalesce("end.rank", F.lit(-1.0)).alias("cut"),
        F.col("next.rank").alias("part"),
        part_rows.alias("part_rows"),
        (left - part_rows * F.coalesce("next.size", F.lit(0))).alias("left"),
    )
    cuts = staged(cuts, "mix-ends")
    # The last place of a source goes to the document beyond the cut that fills the words left open best.
    beyond = open_rows.join(cuts, "key").where(~_below_cut())
    off = F.abs(F.col("left") - F.col("size"))
    nearest = beyond.where(off < F.col("left")).groupBy("key").agg(F.min(F.struct(off.alias("off"), "rank")).alias("x"))
    cuts = staged(cuts.join(nearest.select("key", F.col("x.rank").alias("last")), "key", "left"), "mix-places")
    same = F.coalesce(F.col("last") == F.col("part"), F.lit(False))
    places = cuts.select(
        "key",
        "cut_cell",
        "cut",
        "part",
        (F.col("part_rows") + same.cast("long")).alias("part_rows"),
        F.when(~same, F.col("last")).alias("last"),
    )
    at_part, at_last = F.col("rank") == F.col("part"), F.col("rank") == F.col("last")
    held = open_rows.join(places, "key").where(at_part | at_last).groupBy("key")
    held = held.agg(F.count_if(at_part).alias("part_of"), F.count_if(at_last).alias("last_of"))
    return places.join(held, "key", "left").select(places["*"], "part_of", "last_of")


def _below_cut() -> Column:
    same = F.col("cell") == F.col("cut_cell")
    return (F.col("cell") < F.col("cut_cell")) | (same & (F.col("rank") <= F.col("cut")))


def _crossing(sums: DataFrame, need: DataFrame) -> DataFrame:
    """The interval in which each source's words reach its need, and the need that is left there."""
    rising = Window.partitionBy("key").orderBy("at")
    before = F.coalesce(F.sum("words").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = sums.withColumn("before", before).join(need, "key").where("need > before")
    found = rows.groupBy("key").agg(F.max(F.struct("at", (F.col("need") - F.col("before")).alias("need"))).alias("x"))
    return found.select("key", "x.at", "x.need")


def with_copies(rows: DataFrame, mix: Mix) -> DataFrame:
    """``sized`` rows with ``source_size``, ``target`` and ``copies``."""
    joined = ranked(rows, mix.rates).join(mix.cuts, "key", "left")
    is_open = F.col("chance") > 0
    at_part, at_last = (is_open & F.coalesce(F.col("rank") == F.col(x), F.lit(False)) for x in ("part", "last"))
    in_part = at_part & (F.col("part_rows") < F.col("part_of")) | at_last & (F.col("last_of") > 1)
    whole = is_open & F.coalesce(_below_cut(), F.lit(False)) | at_part & (F.col("part_rows") > 0) | at_last

    def counted(some: DataFrame, extra: Column) -> DataFrame:
        return some.withColumn("copies", (F.col("base") + extra.cast("int")).cast("int"))

    if not mix.split:
        return counted(joined, whole)
    numbered = _numbered(joined.where(in_part), ["key", "rank"])
    places = F.when(at_part, F.col("part_rows")).otherwise(F.lit(1))
    shared = counted(numbered, F.col("number") < places).drop("number")
    return counted(joined.where(~in_part), whole).unionByName(shared)


def _numbered(rows: DataFrame, by: list[str]) -> DataFrame:
    """The rows with their ``number``, from 0, among those alike in ``by``.

    Rows are numbered within the part of the input that they came in, after those of earlier parts, so that no task meets
    more of them than one task read.
    """
    dealt = staged(rows.withColumn("dealt", F.spark_partition_id()), "mix-alike")
    counts = dealt.groupBy(*by, "dealt").agg(F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy(*by).orderBy("dealt")) - F.col("n")
    own = F.row_number().over(Window.partitionBy(*by, "dealt").orderBy("size"))
    found = dealt.withColumn("own", own).join(counts.select(*by, "dealt", earlier.alias("earlier")), [*by, "dealt"])
    return found.withColumn("number", F.col("earlier") + F.col("own") - 1).drop("dealt", "own", "earlier")


def mixed(docs: DataFrame, mix: Mix) -> DataFrame:
    """The mix itself: each document as often as it is taken, all columns as given."""
    taken: Column = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return with_copies(sized(docs, mix.seed), mix).select("__row", taken.alias("__copy")).select(*unpacked(docs.columns))
