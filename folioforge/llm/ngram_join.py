"""Exact n-gram Jaccard join: rare-first prefix filter with length, positional and suffix filters, each pair verified once.

1. Every text becomes its set of distinct word shingles. Texts with equal sets form one class (grouped by a 128-bit
   signature), so exact copies never meet pairwise.
2. A counting pass over all documents adds up words and shingles in a fixed number of hash cells. A shingle's token is its
   frequency class followed by its hash: the expected frequency of its words, or, for shingles whose cell shows a large
   excess, the counted one above all expected ones. Sorted tokens run from rare to frequent, alike in every document.
3. Two sets with enough overlap share a token of their prefixes, so only prefixes are indexed: (token, document, size,
   position). Tokens whose cell shows a large excess are salted. Tokens held by one document are dropped.
4. First round: each holder of a token meets the token's smallest document only, so a large group of near copies costs one
   pair per holder. Second round: the pairs of a token's holders that the first round did not bring into one component, all
   of them. A pair passes the length filter and the positional filter at the join: its first common token leaves enough
   tokens on both sides. The suffix filter (overlap bound from the set sizes between fixed pivots of the hash order) is
   next, and what is left is verified on the whole sets, once: pairs that the first round compared do not come again.
5. Components of the verified links by star contraction; the second round's links join contracted components only.

No cap on holders, partners or candidates. What a skipped pair would link is already in one component.

Defined cases: null, empty and blank texts have no shingles and no links. Texts shorter than a shingle have one, the whole
word sequence. Rows that share a doc_id are one document with several texts; a row keeps its own count. Rows without doc_id
are documents told apart by text, after all others: they link like any, and their component is the smallest id they reach,
null if there is none. Inside the join they are numbered from RESERVED up, which real ids must stay below.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from folioforge.llm.common import in_arrow, staged
from folioforge.llm.components import components
from folioforge.llm.words import cells, hashes, mixed, parts, shingle_sets, split_words
from folioforge.session import broadcast_if_small

CELL_BITS, WORD_BITS = 18, 16  # fixed numbers of counters for shingles and words, about 3 MB
HEAVY = 64  # excess of a cell from which its count, not its words, decides the class
PIVOTS = 256  # suffix filter: ranges of the hash order
SALT_ROWS = 100_000  # estimated holders of a token per salt
PAIR_ROWS = 2_000  # holders of a token per salt where they meet pairwise
RESERVED = 1 << 62  # first number for rows without doc_id


def _signatures(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in parts(batch):
            value, starts, ends = shingle_sets(part["text"], width)
            size = ends - starts
            cell = (value >> np.uint64(56)).astype(np.int64)
            rows = np.repeat(np.arange(len(size)), size)
            between = np.bincount(rows * PIVOTS + cell, minlength=len(size) * PIVOTS)
            kept = np.minimum(between, 32767).astype(np.int16)
            sums = []
            for spread in (value, mixed(value ^ np.uint64(0xA5A5A5A5A5A5A5A5))):
                running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread)])
                sums.append(running[ends] - running[starts])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * PIVOTS), pa.array(kept))
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(size), *[pa.array(s.view(np.int64)) for s in sums], lists],
                names=["doc_id", "n", "sig1", "sig2", "pivots"],
            )


class _Rarity:
    """Turns shingle hashes into tokens by the counted cells."""

    def __init__(self, shingles: np.ndarray, words: np.ndarray, width: int):
        self.width = width
        self.excess = np.maximum(0, shingles - int(np.median(shingles)))
        heavy = np.where(self.excess >= HEAVY, 32 + np.minimum(31, np.log2(1 + self.excess)), 0)
        self.heavy = heavy.astype(np.uint64)
        self.common = np.round(64 * np.log2(1 + words)).astype(np.int64)
        self.most = int(self.common.max(initial=1)) or 1

    def word(self, h: np.ndarray) -> np.ndarray:
        return self.common[cells(h, WORD_BITS)]

    def __call__(self, value: np.ndarray, words: np.ndarray) -> np.ndarray:
        expected = np.minimum(31, 32 * words // (self.width * self.most)).astype(np.uint64)
        heavy = self.heavy[cells(value, CELL_BITS)]
        return (np.where(heavy > 0, heavy, expected) << np.uint64(57)) | (value >> np.uint64(7))

    def salts(self, tokens: np.ndarray) -> np.ndarray:
        return 1 + self.excess[cells(tokens << np.uint64(7), CELL_BITS)] // SALT_ROWS


def _counts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    shingles, words = np.zeros(1 << CELL_BITS, np.int64), np.zeros(1 << WORD_BITS, np.int64)
    for batch in batches:
        for part in parts(batch):
            value, _, _ = shingle_sets(part["text"], width)
            shingles += np.bincount(cells(value, CELL_BITS), minlength=len(shingles))
            _, codes, vocab = split_words(pc.ascii_lower(part["text"].fill_null("")))
            found = np.bincount(codes, minlength=len(vocab))
            words += np.bincount(cells(hashes(vocab), WORD_BITS), weights=found, minlength=len(words)).astype(np.int64)
    total = np.concatenate([shingles, words])
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["cell", "holders"])


def _prefixes(batches: Iterator[pa.RecordBatch], width: int, percent: int, rarity: _Rarity) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in parts(batch):
            token, starts, ends = shingle_sets(part["text"], width, rarity)
            size = ends - starts
            take = np.where(size > 0, size - -(-percent * size // 100) + 1, 0)
            rows = np.repeat(np.arange(len(size)), take)
            position = np.arange(len(rows)) - np.repeat(np.cumsum(take) - take, take)
            tokens = token[starts[rows] + position]
            ids = part["doc_id"].to_numpy(zero_copy_only=False)[rows]
            salts = rarity.salts(tokens)
            salt = np.where(salts > 1, 1 + mixed(ids.astype(np.uint64)).astype(np.int64) % salts, 0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tokens.view(np.int64)),
                    pa.array(ids),
                    pa.array(size[rows].astype(np.int32)),
                    pa.array(position.astype(np.int32)),
                    pa.array(salt.astype(np.int32)),
                ],
                names=["token", "doc_id", "n", "pos", "salt"],
            )


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in parts(batch):
            value, starts, ends = shingle_sets(part["text"], width)
            offsets = pa.array(np.concatenate([starts, ends[-1:]]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(value.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part["doc_id"], lists], names=["doc_id", "shingles"])


def _enough(overlap: Column, percent: int) -> Column:
    """100 * overlap >= percent * union, with union = n_a + n_b - overlap."""
    return overlap * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b")).cast("long")


def _near_sizes(a: Column, b: Column, percent: int) -> Column:
    return (F.least(a, b) * 100).cast("long") >= F.greatest(a, b).cast("long") * percent


def _passes(a: str, b: str, percent: int) -> str:
    """SQL of the length and positional filters on two holders of a token.

    Sets that reach the similarity overlap in at least percent / (100 + percent) of their summed sizes, and all of that lies
    from their first common token on. For that token both positions leave as much, so pairs without such a token go.
    """
    enough = f"{percent}L * ({a}n + {b}n)"
    return (
        f"({a}doc_id <> {b}doc_id AND 100L * least({a}n, {b}n) >= {percent}L * greatest({a}n, {b}n)"
        f" AND {100 + percent}L * ({a}n - {a}pos) >= {enough} AND {100 + percent}L * ({b}n - {b}pos) >= {enough})"
    )


def _verified(pairs: DataFrame, docs: DataFrame, info: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Distinct candidate pairs (a, b) → (those that were compared on their whole sets, those that link)."""
    side = {s: info.select(F.col("doc_id").alias(s), F.col("n").alias(f"n_{s}"), F.col("pivots").alias(f"p_{s}")) for s in "ab"}
    between = F.aggregate(F.zip_with("p_a", "p_b", lambda x, y: F.least(x, y).cast("int")), F.lit(0), lambda s, x: s + x)
    # A count that reached the largest short says nothing; such pairs go on to the verification.
    full = F.greatest(F.array_max("p_a"), F.array_max("p_b")) >= 32767
    pairs = pairs.join(side["a"], "a").join(side["b"], "b")
    pairs = pairs.filter(_near_sizes(F.col("n_a"), F.col("n_b"), percent) & (full | _enough(between.cast("long"), percent)))
    pairs = staged(pairs.select("a", "b").distinct(), "pairs")
    needed = broadcast_if_small(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    sets = in_arrow(docs.join(needed, "doc_id", "left_semi"), lambda x: _sets(x, width), "doc_id long, shingles array<long>")
    sets = staged(sets, "sets")
    both = (
        pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("s_a")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("s_b")), "b")
        .withColumn("n_a", F.size("s_a"))
        .withColumn("n_b", F.size("s_b"))
    )
    alike = _enough(F.size(F.array_intersect("s_a", "s_b")).cast("long"), percent)
    return pairs, staged(both.filter(alike).select("a", "b"), "links")


def _across(marked: DataFrame, percent: int) -> DataFrame:
    """Pairs (a > b) of a token's holders from unlike components that pass the filters.

    A token with many such holders is dealt over salts on one side and copied to them on the other.
    """
    apart = marked.groupBy("token").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("held")
    )
    salts = F.ceil(F.col("held") / PAIR_ROWS).cast("int")
    open_ = marked.join(apart.filter("lo < hi").select("token", salts.alias("salts")), "token")
    x = open_.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int")).alias("x")
    y = open_.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).alias("y")
    met = F.expr(f"x.token = y.token AND x.salt = y.salt AND x.component < y.component AND {_passes('x.', 'y.', percent)}")
    both = F.col("x.doc_id"), F.col("y.doc_id")
    return x.join(y, met).select(F.greatest(*both).alias("a"), F.least(*both).alias("b")).distinct()


def node_id(doc_id: Column, text: Column) -> Column:
    """The doc_id, or a number of the text's own from RESERVED up."""
    own = F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit(RESERVED - 1)) + F.lit(RESERVED)
    return F.coalesce(doc_id, own)


def jaccard_join(docs: DataFrame, width: int = 5, percent: int = 75, real_ids: bool = True) -> tuple[DataFrame, DataFrame]:
    """``docs`` (doc_id, text) → (rows, links).

    rows: doc_id, n_shingles, component_id for every row; ``real_ids=False`` shows the numbers of rows without doc_id.
    links: verified pairs (a, b) of documents with unlike sets that, together with the classes of equal sets, span every
    component.
    """
    docs = docs.select(node_id(F.col("doc_id"), F.col("text")).alias("doc_id"), "text")
    schema = "doc_id long, n long, sig1 long, sig2 long, pivots array<smallint>"
    info = staged(in_arrow(docs, lambda x: _signatures(x, width), schema), "sets-info")

    filled = info.filter("n > 0").select("doc_id", "sig1", "sig2", "n")
    least = filled.groupBy("sig1", "sig2", "n").agg(F.min("doc_id").alias("rep"))
    classes = staged(filled.join(least, ["sig1", "sig2", "n"]).select("doc_id", "rep").distinct(), "classes")

    # Documents all of whose sets have another representative are linked already; the others are indexed.
    copies = classes.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("rep")).alias("own")).filter("NOT own").select("doc_id")
    once = docs.join(broadcast_if_small(copies), "doc_id", "left_anti")

    counted = in_arrow(once, lambda x: _counts(x, width), "cell int, holders long").groupBy("cell").agg(F.sum("holders").alias("n"))
    holders = np.zeros((1 << CELL_BITS) + (1 << WORD_BITS), np.int64)
    found = counted.toArrow()  # as many rows as cells at most, as two columns of numbers
    holders[found["cell"].to_numpy()] = found["n"].to_numpy()
    rarity = _Rarity(holders[: 1 << CELL_BITS], holders[1 << CELL_BITS :], width)

    index = in_arrow(once, lambda x: _prefixes(x, width, percent, rarity), "token long, doc_id long, n int, pos int, salt int")
    together = Window.partitionBy("token", "salt")
    met = index.withColumn("c", F.count(F.lit(1)).over(together)).withColumn("hub", F.min(F.struct("doc_id", "n", "pos")).over(together))
    # Two holders are one pair, which passes here or never; the holders of other tokens may meet again later.
    met = met.filter(f"c > 2 OR salt > 0 OR (c = 2 AND {_passes('', 'hub.', percent)})")
    met = staged(met.select("token", "doc_id", "n", "pos", "hub", (F.col("salt") > 0).alias("salted"), (F.expr("c > 2 OR salt > 0")).alias("more")), "met-tokens")

    shared = met.filter("more").select("token", "doc_id", "n", "pos")
    tops = met.filter("salted").groupBy("token").agg(F.min("hub").alias("hub"))
    local = met.filter(_passes("", "hub.", percent)).select("doc_id", "hub")
    across = met.filter("salted").drop("hub").join(tops, "token").filter(_passes("", "hub.", percent)).select("doc_id", "hub")
    first = local.union(across).select(F.col("doc_id").alias("a"), F.col("hub.doc_id").alias("b")).distinct()
    compared, links = _verified(first, docs, info, width, percent)
    equal = classes.filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    label = staged(components(equal.union(links)), "labels")

    marked = shared.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    marked = staged(marked.withColumn("component", F.coalesce("component", "doc_id")), "marked-tokens")
    # The first round's pairs are (holder, smaller hub); those that were compared there did not link.
    second = _across(marked, percent).join(compared, ["a", "b"], "left_anti")
    _, more = _verified(second, docs, info, width, percent)
    links = links.union(more)

    # Only components that the new links join change: they are contracted to nodes of their own.
    of = lambda side: label.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
    joined = more.join(of("a"), "a", "left").join(of("b"), "b", "left")
    joined = components(joined.select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b")))
    joined = broadcast_if_small(joined.select(F.col("node").alias("component"), F.col("component").alias("whole")))
    rows = info.select("doc_id", F.col("n").alias("n_shingles")).join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    rows = rows.withColumn("component", F.coalesce("component", "doc_id")).join(joined, "component", "left")
    rows = rows.withColumn("component", F.coalesce("whole", "component"))
    real = lambda c: F.when(F.col(c) < RESERVED, F.col(c)) if real_ids else F.col(c)
    rows = rows.select(
        real("doc_id").alias("doc_id"), "n_shingles", real("component").alias("component_id")
    )
    return rows, links
