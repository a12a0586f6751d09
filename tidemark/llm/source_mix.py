"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target of words: its weight's share of the mix, stopped at a
multiple of what the source holds, the excess shared again by weight. A document
of a source is then wanted ``target / source size`` times: the whole part is
taken surely, the fraction is a probability. Pivotal rounding makes the
probabilities integral: two documents meet, words of probability move from one
to the other, in a random direction whose odds keep both expectations, until one
of them is 0 or 1; the other goes on. Moved words are conserved, so the sum of
taken words stays where it was.

The documents meet in a reduction tree: hashed into chunks of a bounded size
that are folded in parallel, each leaving at most one fractional document, and
the residuals are dealt into chunks again, until every (source, size class) has
four. A size class holds sizes within a factor of two, of which there are 63. These last
residuals of a source, largest first, are set to whichever of 0 and 1 brings its
running sum of taken words nearer to the target, so that it misses by about the smallest
classes' sizes rather than the largest's.

All draws and chunks are hashes of the rows' values, so reruns agree wherever
the rows lie. Built-in functions only; a level's result is written to the shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, running

#: Fixed value: a word is a run of anything but the six ASCII spaces.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents folded together by one step of a chunk's fold (on average).
CHUNK = 64
#: Fractional documents that the tree leaves of a source's size class at most.
LEFT = 4
#: Identical rows written out by one task at a time.
COPIES = 10_000
#: Fractions nearer than this to 0 or 1 are integral.
TINY = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) of (source, source_size): ``weights`` repeat over the sources by
    code point, null last; the targets sum to ``share`` of all sizes, none is above ``most``
    times its source's size.

    Sources are filled in the order of their limit per weight: the level at
    which the first source isn't stopped is that of all after it.
    """
    by_name = [F.col("source").isNull(), F.col("source").cast("binary")]
    ranked = running(sources, by_name, {"__nth": F.lit(1)})
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("__nth") % len(weights) + 1).cast("int"))
    ranked = ranked.select("source", "source_size", w.alias("__w"), (F.col("source_size") * F.lit(float(most))).alias("__cap"))
    by_level = [F.col("__cap") / F.col("__w"), *by_name]
    filled = materialise(running(ranked, by_level, {"__full": F.col("__cap"), "__gone": F.col("__w")}), "targets")
    total = filled.agg(F.sum("source_size").alias("words"), F.sum("__w").alias("w")).first()
    words, whole = total["words"] or 0, total["w"] or 1.0
    level = (F.lit(share * words) - F.col("__full")) / F.greatest(F.lit(whole) - F.col("__gone"), F.col("__w"))
    first = (filled.withColumn("__level", level).where(F.col("__cap") / F.col("__w") >= F.col("__level"))
             .agg(F.min_by("__level", F.struct(*by_level))).first()[0])
    return filled.select("source", "source_size",
                         (F.least("__cap", F.col("__w") * F.lit(float(first))) if first is not None else F.col("__cap")).alias("target"))


def _draw(*parts: Column) -> Column:
    """A uniform number in [0, 1) that depends on the values alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(2**53))


def _meet(held: Column, new: Column, seed: Column) -> tuple[Column, Column]:
    """What becomes of the fractions of two documents: (held's, new's), one of them integral."""
    a, x, b, y = held["size"].cast("double"), held["x"], new["size"].cast("double"), new["x"]
    up, down = F.least(a * (1 - x), b * y), F.least(a * x, b * (1 - y))  # words that held can win or lose
    moved = F.when(_draw(held["key"], new["key"], seed) * (up + down) < down, up).otherwise(-down)
    return x + moved / a, y - moved / b


def _integral(x: Column) -> Column:
    return (x < TINY) | (x > 1 - TINY)


def _fold(rows: Column, seed: Column) -> Column:
    """struct(held, done): the fractional document left (or null) and the settled ones of ``rows``."""
    def step(state, new):
        held = state["held"]
        x, y = _meet(held, new, seed)
        old, fresh = held.withField("x", x), new.withField("x", y)
        settled = F.filter(F.array(old, fresh), lambda d: _integral(d["x"]))
        open_ = F.filter(F.array(old, fresh), lambda d: ~_integral(d["x"]))
        met = F.struct(F.get(open_, F.lit(0)).alias("held"), F.concat(state["done"], settled).alias("done"))
        return F.when(held.isNull(), F.struct(new.alias("held"), state["done"].alias("done"))).otherwise(met)
    none = F.filter(rows, lambda d: F.lit(False))
    start = F.struct(F.get(none, F.lit(0)).alias("held"), none.alias("done"))
    return F.aggregate(rows, start, step)


def _chunk(df: DataFrame, per_chunk: int, level: int) -> DataFrame:
    """Rows with the number of their chunk in their (source, class): a hash, into as many
    chunks as the group's size needs."""
    sizes = df.groupBy("source", "class").agg(F.count("*").alias("__n"))
    parts = F.greatest(F.ceil(F.col("__n") / per_chunk), F.lit(LEFT))
    same = df["source"].eqNullSafe(sizes["source"]) & (df["class"] == sizes["class"])
    return df.join(sizes, same).select(df["*"], F.pmod(F.xxhash64("key", F.lit(level)), parts).alias("chunk"), (F.col("__n") > LEFT).alias("many"))


def mix(docs: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0, seed: int = 0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", per_chunk: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies (times the mix takes it), taken (words).

    ``weights`` repeat over the sources by code point, null last (a source of its own);
    together the sources share ``share`` times all words, none more than
    ``most`` times its own. A document is taken floor or ceil of target / source size times.

    Null and empty texts have size 0 and are taken 0 times. Rows equal in id, source and size
    can't be told apart: so many of them as the rounding gives are taken once
    more. Null ids are ids of their own kind, told apart by size and
    source. Ties of hashes go by the rows' values. Very long texts are rows like any
    other. Columns beside the three are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       word_count(F.col(text_col)).alias("size"))
    # rows that nothing tells apart are one unit of several copies
    units = materialise(rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies")), "mix-units")
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    targets = materialise(source_targets(sources, weights, share, most), "mix-targets")
    same = units["source"].eqNullSafe(targets["source"])
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    own = units.join(targets, same).select(units["*"], wanted.alias("r"))
    # a unit of m equal copies settles within itself: all but one fraction of a copy
    frac = F.col("r") - F.floor("r")
    sure = F.floor(F.col("copies") * frac + TINY)
    own = own.select("doc_id", "source", "size", "copies", F.floor("r").alias("base"), sure.alias("sure"),
                     F.greatest(F.col("copies") * frac - sure, F.lit(0.0)).alias("x"),
                     F.xxhash64(F.col("doc_id"), "source", "size", F.lit(seed)).alias("key"),
                     F.floor(F.log2(F.greatest("size", F.lit(1)))).cast("int").alias("class"))
    own = materialise(own, "mix-own")
    whole = _integral(F.col("x")) | (F.col("size") == 0)
    doc = F.struct("key", "size", "x", "doc_id", "copies", "base", "sure")
    settled = [own.where(whole).select("source", F.when(F.col("size") > 0, F.round("x")).otherwise(0).cast("long").alias("up"), doc.alias("d"))]
    dealt = materialise(_chunk(own.where(~whole).select("source", "class", "key", doc.alias("d")), per_chunk, 0), "mix-level0")
    last, level = [dealt.where(~F.col("many"))], 0
    while dealt.where("many").take(1):
        rows = dealt.where("many").groupBy("source", "class", "chunk").agg(F.array_sort(F.collect_list("d")).alias("rows"))
        folded = rows.select("source", "class", _fold(F.col("rows"), F.lit(seed + level)).alias("f"))
        folded = materialise(folded.select("source", "class", "f.held", "f.done"), "mix-folded")
        done = folded.select("source", F.explode("done").alias("d"))
        settled.append(done.select("source", F.round("d.x").cast("long").alias("up"), "d"))
        level += 1
        open_ = folded.where("held IS NOT NULL").select("source", "class", F.col("held.key").alias("key"), F.col("held").alias("d"))
        dealt = materialise(_chunk(open_, per_chunk, level), f"mix-level{level}")
        last.append(dealt.where(~F.col("many")))
    settled.append(_last(reduce(DataFrame.unionByName, last)))
    return _rows(reduce(DataFrame.unionByName, settled), targets)


def _last(open_: DataFrame) -> DataFrame:
    """The few fractions that are left of a source's size classes: the largest first, each to the side that
    brings the sum of what was gained and lost nearer to nothing."""
    one = open_.groupBy("source").agg(F.sort_array(F.collect_list(F.struct(F.col("d.size").alias("by"), "d")), asc=False).alias("rows"))

    def step(state, new):
        gain, loss = new["d"]["size"] * (1 - new["d"]["x"]), new["d"]["size"] * new["d"]["x"]
        up = F.abs(state["off"] + gain) < F.abs(state["off"] - loss)
        off = F.when(up, state["off"] + gain).otherwise(state["off"] - loss)
        return F.struct(off.alias("off"), F.concat(state["ups"], F.array(up.cast("long"))).alias("ups"))
    start = F.struct(F.lit(0.0).alias("off"), F.array().cast("array<bigint>").alias("ups"))
    ups = F.aggregate("rows", start, step)["ups"]
    both = one.select("source", F.explode(F.arrays_zip(ups.alias("up"), F.col("rows.d").alias("d"))).alias("z"))
    return both.select("source", "z.up", "z.d")


def _rows(settled: DataFrame, targets: DataFrame) -> DataFrame:
    """Units back to rows: of a unit's copies, so many as were settled are taken once more."""
    unit = settled.select("source", "d.doc_id", "d.size", "d.copies", "d.base", (F.col("d.sure") + F.col("up")).alias("more"))
    packs = F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES).cast("long"))
    spread = unit.where(F.col("copies") > COPIES).withColumn("pack", F.explode(packs))
    spread = spread.repartition("doc_id", "source", "size", "pack")
    dealt = unit.where(F.col("copies") <= COPIES).withColumn("pack", F.lit(0).cast("long")).unionByName(spread)
    first, end = F.col("pack") * COPIES, F.least((F.col("pack") + 1) * COPIES, F.col("copies")) - 1
    each = dealt.withColumn("nth", F.explode(F.sequence(first, end)))
    times = F.col("base") + (F.col("nth") < F.col("more")).cast("long")
    got = each.select("doc_id", "source", "size", times.alias("copies"), (times * F.col("size")).alias("taken"))
    t = targets.select(F.col("source").alias("__s"), "source_size", "target")
    return (got.join(t, got["source"].eqNullSafe(t["__s"]))
            .select("doc_id", "source", "size", "source_size", "target", "copies", "taken"))
