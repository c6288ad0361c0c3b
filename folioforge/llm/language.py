"""Language identification: word-first backoff over per-language log frequencies.

A known word scores its log frequency in each language. An unseen word falls back to character n-grams of its form with
edges: at each place the longest known n-gram, from the highest order down to single characters, and a floor at last.
A text's language has the highest sum over its words, whatever their number; the score is the share of that language after
the sums are turned into probabilities.

The model is fitted with Spark on all labelled rows, whole texts. Tables are bounded: WORDS words and GRAMS n-grams of each
order and language, the most frequent ones. Prediction sees the text alone and runs once per distinct word of a batch.

Words are runs of letters in lower case. Defined cases: null texts and texts without a letter are ``und`` with score 0; so
is everything if nothing could be learned. Ties go to the first language by name. Rows without doc_id or language are not
learned from. Rows are judged one by one. Other columns pass through, except those named like a result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from folioforge.llm.common import in_arrow, staged
from folioforge.llm.words import letter_words, parts, spans
from folioforge.session import broadcast_if_small

WORDS, GRAMS, ORDER = 20_000, 8_000, 4
HELD = 500_000  # counts a worker holds before it hands them on


def sample_ids(labelled: DataFrame, label: str, per_class: int) -> DataFrame:
    """doc_id of up to ``per_class`` rows of each class, those of smallest hash.

    The classes are counted first, and rows whose hash lies beyond what twice that many rows of their class would take are
    left out before anything is shuffled, so the most frequent class brings no more rows to its task than the others.
    """
    rows = labelled.select("doc_id", F.col(label).alias("__label"), F.xxhash64(F.lit("sample"), F.col("doc_id")).alias("__hash"))
    sizes = broadcast_if_small(rows.groupBy(F.col("__label").alias("__of")).agg(F.count(F.lit(1)).alias("__size")))
    place = F.col("__hash").cast("double") / 2.0**64 + 0.5  # evenly spread over 0 to 1, in the order of the hash
    near = rows.join(sizes, F.col("__label") == F.col("__of")).filter(place * F.col("__size") <= 2 * per_class + 64)
    order = Window.partitionBy("__label").orderBy("__hash", "doc_id")
    first = near.withColumn("__n", F.row_number().over(order)).filter(f"__n <= {per_class}")
    return first.select("doc_id", F.col("__label").alias(label))


def grams(word: str, order: int):
    """(place, n-gram) of the word with edges, all places of one order."""
    shown = f"<{word}>"
    return (shown[i : i + order] for i in range(len(shown) - order + 1))


class Backoff:
    """Log frequencies of words and of n-grams by order: for each item the languages that have it, and their values.

    ``words`` and ``levels`` map an item to (numbers of languages, log frequencies); a language that lacks a known item
    has the value in ``rare`` of that table, and the floor is that of the single characters. Items are numbered over all
    tables, and the entries of an item lie side by side, as what they add to the value in ``rare``.
    """

    def __init__(self, languages: list[str], words: dict, levels: list[dict], rare: list[np.ndarray]):
        self.languages, self.rare = languages, np.array(rare)
        items = [(level, item, found) for level, table in enumerate([words, *levels]) for item, found in table.items()]
        self.words = {item: n for n, (level, item, _) in enumerate(items) if level == 0}
        self.grams = {item: n for n, (level, item, _) in enumerate(items) if level > 0}  # of each length one order only
        self.order = len(levels)
        self.level = np.array([level for level, _, _ in items] + [1], np.int8)  # the last item is the floor, in no language
        self.ends = np.cumsum([len(found[0]) for _, _, found in items] + [0])
        self.entry = np.concatenate([f[0] for _, _, f in items] + [np.zeros(0, np.int32)]).astype(np.int64)
        self.gain = np.concatenate([f[1] - self.rare[level][f[0]] for level, _, f in items] + [np.zeros(0)])

    def places(self, word: str) -> list[int]:
        """Numbers of the longest known n-grams at each place of a word with edges; -1 for the floor."""
        shown, grams, out = f"<{word}>", self.grams, []
        for at in range(len(shown)):
            for order in range(self.order, 0, -1):
                found = grams.get(shown[at : at + order])
                if found is not None:
                    out.append(found)
                    break
            else:
                out.append(-1)
        return out

    def table(self, vocab: list[str]) -> np.ndarray:
        """Value of each word in each language."""
        count, width = len(vocab), len(self.languages)
        whole = np.fromiter(map(self.words.get, vocab, repeat(-1)), np.int64, count)
        rest = np.flatnonzero(whole < 0)
        cut = [self.places(vocab[i]) for i in rest.tolist()]
        size = np.ones(count, np.int64)
        size[rest] = [len(c) for c in cut]
        items = np.empty(size.sum(), np.int64)
        word = np.repeat(np.arange(count), size)
        unseen = np.repeat(whole < 0, size)
        items[~unseen] = whole[whole >= 0]
        items[unseen] = np.fromiter(chain.from_iterable(cut), np.int64, int(unseen.sum()))
        items[items < 0] = len(self.level) - 1
        levels = np.bincount(word * len(self.rare) + self.level[items], minlength=count * len(self.rare)).reshape(count, -1)
        # Sums in the order of the places, so that a word has the same value in every batch.
        out = sum((levels[:, k, None] * rare for k, rare in enumerate(self.rare)), np.zeros((count, width)))
        starts = np.where(items > 0, self.ends[items - 1], 0)
        n = self.ends[items] - starts
        at = np.arange(n.sum()) + np.repeat(starts - (np.cumsum(n) - n), n)
        out += np.bincount(np.repeat(word, n) * width + self.entry[at], weights=self.gain[at], minlength=count * width).reshape(count, width)
        return out / size[:, None]

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        return self.predict_words(*letter_words(texts), len(texts))

    def predict_words(self, row: np.ndarray, codes: np.ndarray, vocab: list[str], n_rows: int) -> tuple[list[str], np.ndarray]:
        if not self.languages or not len(row):
            return ["und"] * n_rows, np.zeros(n_rows)
        table = self.table(vocab)
        starts, ends = spans(row, n_rows)
        has = ends > starts
        sums = np.zeros((n_rows, table.shape[1]))
        # A sum of its own for each text, so that its neighbours in the batch do not touch its last digits.
        sums[has] = np.add.reduceat(table[codes], starts[has], axis=0)
        best = sums.argmax(axis=1)
        share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.languages[b] if h else "und" for b, h in zip(best.tolist(), has.tolist())], np.where(has, share, 0.0)


def most_frequent(counts: DataFrame) -> DataFrame:
    """The WORDS or GRAMS items of largest n of each language and level; equal ones by hash.

    Items are counted by their n first, and those that cannot be among them are left out before a language's items meet.
    """
    room = F.when(F.col("level") == 0, WORDS).otherwise(GRAMS)
    higher = Window.partitionBy("lang", "level").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = counts.groupBy("lang", "level", "n").agg(F.count(F.lit(1)).alias("__size"))
    sizes = sizes.withColumn("__above", F.coalesce(F.sum("__size").over(higher), F.lit(0))).filter(F.col("__above") < room)
    place = F.xxhash64("item").cast("double") / 2.0**64 + 0.5
    near = counts.join(broadcast_if_small(sizes), ["lang", "level", "n"]).filter(place * F.col("__size") <= 2 * (room - F.col("__above")) + 64)
    top = Window.partitionBy("lang", "level").orderBy(F.desc("n"), F.xxhash64("item"), "item")
    return near.withColumn("__n", F.row_number().over(top)).filter(F.col("__n") <= room).select(*counts.columns)


def fit(docs: DataFrame) -> Backoff:
    """``docs`` (doc_id, text, lang): the rows to learn from."""
    docs = docs.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND doc_id IS NOT NULL")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                row, codes, vocab = letter_words(part["text"])
                langs = part["lang"].dictionary_encode()
                which = langs.indices.to_numpy()
                pair, n = np.unique(which[row] * max(1, len(vocab)) + codes, return_counts=True)
                lang = langs.dictionary.take(pa.array(pair // max(1, len(vocab))))
                item = pa.array(vocab, pa.string()).take(pa.array(pair % max(1, len(vocab))))
                yield pa.RecordBatch.from_arrays([lang, item, pa.array(n, pa.int64())], names=["lang", "item", "n"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, int], dict[str, int]] = defaultdict(lambda: defaultdict(int))

        def flushed() -> Iterator[pa.RecordBatch]:
            for (lang, order), table in total.items():
                columns = [pa.array([lang] * len(table)), pa.array([order] * len(table), pa.int32())]
                columns += [pa.array(table.keys(), pa.string()), pa.array(table.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "level", "item", "n"])
            total.clear()

        for batch in batches:
            for lang, word, n in zip(*[batch[c].to_pylist() for c in ("lang", "item", "n")]):
                for order in range(1, ORDER + 1):
                    table = total[lang, order]
                    for gram in grams(word, order):
                        table[gram] += n
            if sum(map(len, total.values())) > HELD:
                yield from flushed()
        yield from flushed()

    words = in_arrow(docs.select("text", "lang"), counted, "lang string, item string, n long").groupBy("lang", "item").agg(F.sum("n").alias("n"))
    words = staged(words, "language-words")
    pieces = in_arrow(words, cut, "lang string, level int, item string, n long").groupBy("lang", "level", "item").agg(F.sum("n").alias("n"))
    both = words.select("lang", F.lit(0).alias("level"), "item", "n").union(pieces)
    both = staged(both, "language-counts")
    totals = {(r["lang"], r["level"]): r["t"] for r in both.groupBy("lang", "level").agg(F.sum("n").alias("t")).collect()}
    languages = sorted({lang for lang, _ in totals})
    kept = most_frequent(both.filter("level > 0 OR n > 1"))
    place = {lang: i for i, lang in enumerate(languages)}
    tables: list[dict] = [{} for _ in range(ORDER + 1)]
    rare = [np.array([math.log(0.5 / (totals.get((lang, level), 0) + 1)) for lang in languages]) for level in range(ORDER + 1)]
    found = kept.select("lang", "level", "item", "n").orderBy("lang", "level", "item").toArrow()
    for batch in found.to_batches(10_000):  # WORDS and GRAMS entries for each language at most
        for lang, level, item, n in zip(*[c.to_pylist() for c in batch.columns]):
            tables[level].setdefault(item, []).append((place[lang], math.log(n / totals[lang, level])))
    packed = [{item: (np.array([i for i, _ in e], np.int32), np.array([v for _, v in e])) for item, e in t.items()} for t in tables]
    return Backoff(languages, packed[0], packed[1:], rare)


def predict(docs: DataFrame, model: Backoff) -> DataFrame:
    """Every row with ``lang_pred`` and ``score``; the text itself does not come back."""
    rest = [c for c in docs.columns if c.lower() not in ("text", "lang_pred", "score")]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema.fields]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded tables

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in parts(batch):
                lang, score = known.predict(part["text"])
                yield pa.RecordBatch.from_arrays([*[part[c] for c in rest], pa.array(lang), pa.array(score)], names=[*rest, "lang_pred", "score"])

    return in_arrow(docs.select(*rest, "text"), work, ", ".join([*fields, "lang_pred string", "score double"]))
