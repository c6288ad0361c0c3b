"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact weighted verification.

1. A window's shared weight is at most the number of its places whose shingle stands in an item of its size. The benchmark's
   shingles (measured, broadcast below a bound, else joined by shuffle) mark those places, and every window with as many
   marked places as the similarity needs is taken, at any offset. All other windows are below the similarity.
2. Equal windows are fingerprinted once: 64-bit SimHash over the shingles, numbered by occurrence, so that a repeated shingle
   does not outvote the others and the distance follows the weighted similarity that is verified.
3. Multi-index search: fingerprints are cut into blocks. With fewer than two differing bits in one block at least, every pair
   within the radius meets in a block that is equal or one bit off; item blocks are listed with those neighbours. No pair
   within the radius is missed. The Hamming distance is checked next.
4. Survivors are verified exactly: shared weight of the shingles over their united weight.

The default radius of 24 of 64 bits is four deviations above what a pair of weighted similarity 0.75 is expected to have.

Words are compared with A-Z in lower case. Items shorter than a shingle are one shingle of their length. Defined cases: null,
empty and blank texts and items match nothing. A text shorter than an item is one window. Rows that share a doc_id, or
have none, are told apart by text. Ties and repeated rows give one result row per (doc_id, text, item_id).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from folioforge.llm.common import ascii_lower, let, staged, words
from folioforge.session import broadcast_if_small

WIDTH, PERCENT, RADIUS, BITS = 5, 75, 24, 64


def shingles(tokens: Column, width: int) -> Column:
    """Word shingles in order, repeats included; shorter sequences are one shingle."""
    size = F.least(F.size(tokens), F.lit(width))
    return F.transform(
        F.sequence(F.lit(1), F.size(tokens) - size + 1), lambda i: F.array_join(F.slice(tokens, i, size), " ")
    )


def weighted(parts: Column) -> Column:
    """Each shingle with its running number, so that set operations count weights."""
    return F.transform(
        parts, lambda x, i: F.concat_ws("\n", x, F.size(F.filter(F.slice(parts, 1, i), lambda y: y == x)).cast("string"))
    )


def simhash(parts: Column) -> Column:
    """Bit b is set if the shingles with bit b outweigh those without; each occurrence votes with a hash of its own."""

    def fold(hashed: Column) -> Column:
        vote = lambda b: F.aggregate(hashed, F.lit(0), lambda s, h: s + F.getbit(h, b).cast("int") * 2 - 1)
        bit = lambda b: F.when(vote(b) > 0, F.call_function("shiftleft", F.lit(1).cast("long"), b))
        places = F.sequence(F.lit(0), F.lit(BITS - 1))
        return F.aggregate(
            F.transform(places, lambda b: F.coalesce(bit(b), F.lit(0).cast("long"))),
            F.lit(0).cast("long"),
            lambda s, x: s.bitwiseOR(x),
        )

    number = lambda hashed: F.transform(hashed, lambda x, i: F.xxhash64(x, i - F.array_position(hashed, x)))
    return let(F.sort_array(F.transform(parts, lambda x: F.xxhash64(x))), lambda hashed: let(number(hashed), fold))


def block_bounds(radius: int, bits: int = BITS) -> list[tuple[int, int]]:
    """(shift, width) of blocks so many that within ``radius`` some block differs in one bit at most."""
    count = min(bits, radius // 2 + 1)
    cuts = [bits * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def blocks(fingerprint: Column, radius: int, neighbours: bool) -> Column:
    """Array of (block, value), with all values one bit off if asked."""
    out = []
    for number, (shift, width) in enumerate(block_bounds(radius)):
        value = F.shiftrightunsigned(fingerprint, shift).bitwiseAND(F.lit((1 << width) - 1))
        flips = [0, *(1 << b for b in range(width))] if neighbours else [0]
        out += [F.struct(F.lit(number).alias("block"), value.bitwiseXOR(F.lit(f)).alias("value")) for f in flips]
    return F.array(*out)


def _with_words(rows: DataFrame) -> DataFrame:
    return rows.withColumn("w", words(ascii_lower(F.col("text")))).filter(F.size("w") > 0)


def _starts() -> Column:
    """Starts of the windows of ``n`` shingles that hold at least ``need`` of the sorted places ``at``.

    Such a window is found by the first place it holds: it starts behind the place before and reaches ``need - 1`` places on.
    """
    last_start = F.greatest(F.lit(0), F.col("size") - F.col("len"))

    def starts(j: Column) -> Column:
        before = F.when(j > 0, F.get("at", j - 1) + 1).otherwise(0)
        first = F.greatest(before, F.get("at", j + F.col("need") - 1) - F.col("n") + 1)
        last = F.least(F.get("at", j), last_start)
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size("at") - F.col("need")), starts))


def leaks(docs: DataFrame, items: DataFrame, width: int = WIDTH, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """``docs`` (doc_id, text), ``items`` (item_id, text) → doc_id, row (hash of the text), item_id, start, shared, united.

    ``start`` is the word position of the best window; ``shared`` and ``united`` are its weights.
    """
    items = _with_words(items.select("item_id", "text"))
    items = items.select("item_id", "w", F.size("w").alias("len"), shingles(F.col("w"), width).alias("parts"))
    items = staged(items.withColumn("print", simhash(F.col("parts"))), "items")
    widths = [r[0] for r in items.select(F.least("len", F.lit(width))).distinct().collect()]  # ``width`` values at most

    source = _with_words(docs.select("doc_id", "text")).select("doc_id", F.xxhash64("text").alias("row"), "w")

    def places(k: int) -> DataFrame:
        own = items.filter(F.least("len", F.lit(width)) == k)
        own = own.select("len", F.explode(F.transform("parts", lambda x: F.xxhash64(F.split(x, " ")))).alias("h"))
        own = broadcast_if_small(own.distinct())
        spots = source.filter(F.size("w") >= k).select("doc_id", "row", "w", F.explode(F.sequence(F.lit(0), F.size("w") - k)).alias("i"))
        spots = spots.withColumn("h", F.xxhash64(F.array(*[F.get("w", F.col("i") + j) for j in range(k)])))
        return spots.join(own, "h").select("doc_id", "row", "len", F.size("w").alias("size"), F.lit(k).alias("k"), "i")

    schema = "doc_id long, row long, len int, size int, k int, i int"
    found = [places(k) for k in widths] or [docs.sparkSession.createDataFrame([], schema)]
    marked = reduce(DataFrame.union, found).groupBy("doc_id", "row", "len", "size", "k")
    marked = marked.agg(F.sort_array(F.collect_set("i")).alias("at"))
    marked = marked.withColumn("n", F.least("size", "len") - F.col("k") + 1)
    weights = F.col("n") + F.col("len") - F.col("k") + 1
    need = F.greatest(F.lit(1), F.ceil(weights * percent / (100 + percent) - 1e-9).cast("int"))
    marked = marked.withColumn("need", need).filter(F.size("at") >= F.col("need"))
    marked = marked.select("doc_id", "row", "len", _starts().alias("starts")).filter(F.size("starts") > 0)
    marked = broadcast_if_small(marked.withColumnsRenamed({"doc_id": "__id", "row": "__row"}))

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("row"))
    rows = rows.join(marked, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__row")))
    rows = _with_words(rows).select("doc_id", "row", "len", "w", F.explode("starts").alias("start"))
    windows = rows.select("doc_id", "row", "len", "start", F.slice("w", F.col("start") + 1, F.col("len")).alias("w"))
    windows = staged(windows.distinct(), "windows")

    unlike = windows.select("len", "w").distinct().withColumn("parts", shingles(F.col("w"), width))
    unlike = staged(unlike.withColumn("print", simhash(F.col("parts"))), "fingerprints")
    left = unlike.select("len", "w", "print", F.inline(blocks(F.col("print"), radius, False)))
    right = items.select("len", "item_id", F.col("print").alias("item_print"), F.inline(blocks(F.col("print"), radius, True)))
    near = (
        left.join(right, ["len", "block", "value"])
        .filter(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
        .select("len", "w", "item_id")
        .distinct()
    )
    pairs = near.join(unlike.select("len", "w", "parts"), ["len", "w"]).join(
        items.select("item_id", "len", F.col("parts").alias("item_parts")), ["item_id", "len"]
    )
    shared = F.size(F.array_intersect(weighted(F.col("parts")), weighted(F.col("item_parts"))))
    pairs = pairs.withColumn("shared", shared).withColumn("united", F.size("parts") + F.size("item_parts") - F.col("shared"))
    pairs = pairs.filter(F.col("shared") * 100 >= F.col("united") * percent).select("len", "w", "item_id", "shared", "united")
    best = F.max(F.struct((F.col("shared") / F.col("united")).alias("s"), -F.col("start"), "shared", "united", "start"))
    rows = windows.join(pairs, ["len", "w"]).groupBy("doc_id", "row", "item_id").agg(best.alias("best"))
    return rows.select("doc_id", "row", "item_id", *[F.col(f"best.{c}").alias(c) for c in ("start", "shared", "united")])


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no item; their columns may have any names."""
    gone = leaks(docs, items, **options).select("doc_id", "row").distinct()
    gone = broadcast_if_small(gone.select(F.struct("doc_id", "row").alias("leak")))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("kept"))
    own = F.struct(F.col("kept.doc_id").alias("doc_id"), F.xxhash64("kept.text").alias("row"))
    return rows.join(gone, own.eqNullSafe(F.col("leak")), "left_anti").select("kept.*")
