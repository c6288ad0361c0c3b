"""Mixing sources to target weights by Pareto order sampling.

Sources get targets: weights by rank share the wanted total, a target stops at ``cap`` times its source, and the excess is
shared again by weight until none is above. Within a source every document has an expected number of copies, in proportion to
its preference and at most ``cap``, so that expected words equal the target. The whole part is certain. The rest is an
inclusion probability p: documents are ranked by random odds u/(1-u) over inclusion odds p/(1-p), and the source takes its
documents in that order up to its remaining words: a sample of fixed size in words. It misses the target by half of one
document at most.

The random number is a hash of the seed and doc_id (or text, see below), so reruns agree. Nothing sorts a whole source in one task: ranks are
binned, bins are summed, and only the bin in which the target falls is sorted.

Preferences are positive integers with few distinct values; the default is the number of binary digits of the size.

Defined cases: size is the number of words, 0 for null and empty texts, which are never needed to reach a target. A null
source is a source of its own, the last one. Rows that share a doc_id are drawn alike; rows without one are drawn by their text, so
that only equal texts without id come in or stay out together.
Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from folioforge.llm.common import staged, words
from folioforge.operators.warehouse import dense_keys
from folioforge.session import broadcast_if_small

WEIGHTS, PERCENT, CAP, SEED, BINS = (5, 2, 1), 150, 2, "mix", 1 << 14


def size_of(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def binary_digits(size: Column) -> Column:
    return F.length(F.bin(size)).cast("long")


def source_targets(sources: DataFrame, weights=WEIGHTS, percent: int = PERCENT, cap: int = CAP) -> DataFrame:
    """(source, source_size) → and target, a double; each is at most cap * source_size."""
    if percent > 100 * cap:
        raise ValueError("sources cannot give more than cap times their size")
    named = sources.filter("source IS NOT NULL").select("source", "source_size")
    ranked = dense_keys(named, "rank", ["source"]).select("source", "source_size", "rank").unionByName(
        sources.filter("source IS NULL").select("source", "source_size").crossJoin(
            F.broadcast(named.agg((F.count(F.lit(1)) + 1).alias("rank")))
        )
    )
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = staged(ranked.select("source", "source_size", weight.cast("long").alias("weight")), "ranked-sources")
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = None
    while True:  # each pass caps at least one more source or ends
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) > F.col("source_size") * cap
        held, left = ranked.agg(
            F.coalesce(F.sum(F.when(full, F.col("source_size") * cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        following = (total * percent / 100 - held) / left if left else None
        if following is None or following == level:
            break
        level = following
    target = F.least(F.col("weight") * F.lit(level or 0.0), (F.col("source_size") * cap).cast("double"))
    return ranked.select("source", "source_size", target.alias("target"))


def _copies(preference: Column) -> Column:
    return F.when(preference > F.col("free"), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("scale") * preference))


def draw_key(doc_id: Column, text: Column) -> Column:
    """What a row's random number is drawn from: its id, or its text where it has none."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text, F.lit("")))))


def _odds(key: Column, p: Column, seed: str) -> Column:
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
    return (u / (1 - u)) / (p / (1 - p))


def _drawn(rows: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """Rows (doc_id, draw, source, size, preference) with ``whole`` copies, ``rest`` probability and ``odds`` ratio."""
    plan = plan.withColumnRenamed("source", "__source")
    rows = rows.join(broadcast_if_small(plan), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    rows = rows.withColumn("expected", _copies(F.col("preference")))
    rows = rows.withColumn("whole", F.floor("expected").cast("int")).withColumn("rest", F.col("expected") - F.col("whole"))
    return rows.withColumn("odds", F.when(F.col("rest") > 0, _odds(F.col("draw"), F.col("rest"), seed)))


def mix_plan(sized: DataFrame, weights=WEIGHTS, percent: int = PERCENT, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """``sized`` (doc_id, draw, source, size, preference) → one row per source with its target and its cut in the ranking."""
    levels = staged(
        sized.groupBy("source", "preference").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs")), "levels"
    )
    targets = staged(source_targets(levels.groupBy("source").agg(F.sum("words").alias("source_size")), weights, percent, cap), "targets")

    # Scale of the preferences: levels from the highest down are full until the rest can share what is left.
    ranked = levels.alias("l").join(targets.alias("t"), F.col("l.source").eqNullSafe(F.col("t.source"))).select(
        "t.*", "l.preference", "l.words"
    )
    down = Window.partitionBy("source").orderBy(F.desc("preference"))
    above = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    below = F.sum(F.col("words") * F.col("preference")).over(down.rowsBetween(0, Window.unboundedFollowing))
    scale = F.when(below > 0, (F.col("target") - cap * above) / below).otherwise(F.lit(0.0))
    fits = ranked.withColumn("scale", scale).filter(F.col("scale") * F.col("preference") <= cap)
    free = fits.groupBy("source").agg(F.max(F.struct("preference", "scale")).alias("f"))
    plan = targets.alias("t").join(free.alias("f"), F.col("t.source").eqNullSafe(F.col("f.source")), "left").select(
        "t.*",
        F.coalesce("f.f.preference", F.lit(0).cast("long")).alias("free"),
        F.coalesce("f.f.scale", F.lit(0.0)).alias("scale"),
        F.lit(float(cap)).alias("cap"),
    )
    plan = staged(plan, "mix-scales")

    drawn = _drawn(sized, plan, seed).withColumn("bin", F.floor(F.col("odds") / (1 + F.col("odds")) * BINS).cast("int"))
    binned = drawn.groupBy("source", "bin").agg(
        F.sum("size").alias("words"), F.sum(F.col("size") * F.col("whole")).alias("certain"), F.first("target").alias("target")
    )
    everything = Window.partitionBy("source")
    along = everything.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    binned = binned.withColumn("room", F.col("target") - F.sum("certain").over(everything)).filter("bin IS NOT NULL")
    binned = binned.withColumn("reached", F.sum("words").over(along)).withColumn("before", F.col("reached") - F.col("words"))
    # The first bin that the room does not hold whole; a source without one takes all it ranks.
    cut = staged(
        binned.filter("reached > room").groupBy("source").agg(F.min(F.struct("bin", "before", "room")).alias("cut")), "mix-bins"
    )
    inside = drawn.alias("d").join(broadcast_if_small(cut).alias("c"), F.col("d.source").eqNullSafe(F.col("c.source"))).filter("d.bin = c.cut.bin")
    order = Window.partitionBy("d.source").orderBy("odds", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("mid", F.col("cut.before") + F.sum("size").over(order) - F.col("size") / 2)
    last = inside.filter(F.col("mid") <= F.col("cut.room")).groupBy(F.col("d.source").alias("source"))
    last = last.agg(F.max(F.struct("odds", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"))).alias("last"))
    joined = plan.alias("p").join(cut.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left")
    joined = joined.join(last.alias("l"), F.col("p.source").eqNullSafe(F.col("l.source")), "left")
    return staged(joined.select("p.*", F.col("c.cut.bin").alias("cut_bin"), F.col("l.last").alias("last")), "mix-plan")


def copies(sized: DataFrame, plan: DataFrame, seed: str = SEED) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` to rows with doc_id, draw, source, size and preference."""
    drawn = _drawn(sized, plan, seed)
    here = F.floor(F.col("odds") / (1 + F.col("odds")) * BINS).cast("int")
    upto = F.struct("odds", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id")) <= F.col("last")
    chosen = F.isnotnull("odds") & (F.isnull("cut_bin") | (here < F.col("cut_bin")) | ((here == F.col("cut_bin")) & F.coalesce(upto, F.lit(False))))
    kept = [c for c in sized.columns] + ["source_size", "target"]
    return drawn.select(*kept, (F.col("whole") + chosen.cast("int")).alias("copies"))


def sized(docs: DataFrame) -> DataFrame:
    size = docs.select("doc_id", draw_key(F.col("doc_id"), F.col("text")).alias("draw"), "source", size_of(F.col("text")).alias("size"))
    return size.withColumn("preference", binary_digits(F.col("size")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    plan = mix_plan(staged(sized(docs), "sizes"), **options)
    row = F.struct(*docs.columns)
    draw = draw_key(F.col("doc_id"), F.col("text")).alias("draw")
    rows = docs.select(row.alias("__row"), "doc_id", draw, "source", size_of(F.col("text")).alias("size"))
    rows = rows.select("__row", "doc_id", "draw", "source", "size", binary_digits(F.col("size")).alias("preference"))
    taken = copies(rows, plan, options.get("seed", SEED))
    # One range per row instead of an array of copies, so that long texts are not held several times.
    taken = taken.filter("copies > 0").select("__row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy"))
    return taken.select("__row.*")
