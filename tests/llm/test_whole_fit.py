"""Learning from all labelled rows: counts, thresholds, long texts, parts that are averaged; words in their byte form."""

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from made_texts import prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folioforge.llm import language, toxicity
from folioforge.llm.encoders import Encoder
from folioforge.llm.words import hashes


def test_language_counts_cover_every_row(spark):
    rows = spark.range(0, 2300, 1, 4).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("haus "), F.when(F.col("id") % 23 == 0, "hund").otherwise("und")).alias("text"), F.lit("cc").alias("lang")
    )
    model = language.fit(rows)
    assert model.table(["haus", "hund", "und"])[:, 0] == pytest.approx([math.log(n / 4600) for n in (2300, 100, 2200)])


def test_most_frequent_items(spark, monkeypatch):
    monkeypatch.setattr(language, "WORDS", 30)
    monkeypatch.setattr(language, "GRAMS", 5)
    rows = [("aa", level, f"{level}-{i}", 2 + (i < 20) * i) for level in (0, 1) for i in range(400)] + [("bb", 0, "x", 2)]
    kept = [tuple(r) for r in language.most_frequent(spark.createDataFrame(rows, "lang string, level int, item string, n long")).collect()]
    assert Counter((r[0], r[1]) for r in kept) == {("aa", 0): 30, ("aa", 1): 5, ("bb", 0): 1} and set(kept) <= set(rows)
    for level, size in ((0, 30), (1, 5)):
        want = sorted((r[3] for r in rows if r[:2] == ("aa", level)), reverse=True)[:size]
        assert sorted((r[3] for r in kept if r[:2] == ("aa", level)), reverse=True) == want


def test_word_counts_cover_every_row(spark):
    words = "one two three four five".split()
    rng, rows = random.Random(1), []
    for i in range(3000):
        rows.append((i, i % 3 % 2, [rng.choice(words) for _ in range(rng.randint(0, 4))]))
    code = dict(zip(words, hashes(words).view(np.int64).tolist()))
    df = spark.createDataFrame([(i, label, [code[w] for w in text]) for i, label, text in rows], "key long, toxic int, words array<long>")
    want = Counter((code[w], label) for _, label, text in rows for w in set(text))
    got = {r["word"]: (r["clean"], r["toxic"]) for r in toxicity.word_counts(df.repartition(5)).collect()}
    assert got == {c: (want[c, 0], want[c, 1]) for c in code.values()}


def test_best_cut_by_hand():
    rng = np.random.default_rng(5)
    for _ in range(30):
        cells = np.unique(rng.integers(-50, 50, 12))
        clean, toxic = rng.integers(0, 9, len(cells)), rng.integers(0, 9, len(cells))
        cut = toxicity.best_cut(cells, clean, toxic) * toxicity.CELLS
        f1 = lambda above: 2 * toxic[above].sum() / ((clean + toxic)[above].sum() + max(1, toxic.sum()))
        assert f1(cells >= cut) == pytest.approx(max(f1(cells >= c) for c in cells))


def test_long_texts_are_learned_from(spark):
    rows = [(i, "vile " * 40_001 if i % 4 == 0 else prose(i, 60), i % 4 == 0) for i in range(80)]
    known = spark.createDataFrame(rows, "doc_id long, text string, label boolean").select("doc_id", "text", F.col("label").cast("int").alias("toxic"))
    network = toxicity.fit(known, language.fit(known.limit(0).withColumn("lang", F.lit("x"))))
    new = spark.createDataFrame([(1, prose(500, 30) + " vile vile"), (2, prose(501, 40))], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(new, network).collect()}
    assert got[1] > got[2]


def test_parts_are_averaged_alike_in_any_order(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PART_DOCS", 150)
    rows = [(i, prose(i, 30) + (" vile" if i % 4 == 0 else " calm"), int(i % 4 == 0)) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    blank = language.fit(df.limit(0).withColumn("lang", F.lit("x")))
    one, two = toxicity.fit(df.coalesce(1), blank), toxicity.fit(df.orderBy(F.rand(3)).repartition(7), blank)
    assert all((a == b).all() for a, b in zip([*one.products, *one.bias, one.out], [*two.products, *two.bias, two.out]))
    assert one.cuts == two.cuts
    assert all(r["toxic"] == r["predicted"] for r in toxicity.score(df, one).collect())


def test_words_are_cut_as_the_library_does():
    path = public_tokenizers.path("word_bpe_49k.json")
    coder, library = Encoder(path), Tokenizer.from_file(path)
    marks = [chr(c) for c in range(33, 0x180) if not chr(c).isspace()]
    rng = random.Random(8)
    for word in [*marks, *("".join(rng.choice(marks) for _ in range(rng.randint(2, 9))) for _ in range(3000)), "été", "ÉTÉ", "don't", "İx", "x" * 400]:
        assert list(coder._word(word)) == library.encode(word, add_special_tokens=False).ids, word


def test_kept_words_and_pieces_are_bounded_together():
    path = public_tokenizers.path("word_bpe_49k.json")
    coder, library, rng = Encoder(path), Tokenizer.from_file(path), random.Random(9)
    coder.words.room = 400
    for _ in range(12):
        made = ["".join(rng.choice("aeiounrst") for _ in range(rng.randint(1, 5))) for _ in range(150)]
        text = " ".join(rng.choice([w, w.title(), w.upper() + ",", f"'{w}'s", f"{w}-12.", f"<|{w}", f"é{w}", "中" + w]) for w in made * 2)
        flat, sizes = coder.encode(pa.array([text, None, "", text[:99]]), 2)
        want = [[*library.encode(t, add_special_tokens=False).ids, 2] for t in (text, "", "", text[:99])]
        assert sizes.tolist() == [len(ids) for ids in want] and flat.tolist() == sum(want, [])
        kept = [x for x in vars(coder).values() if isinstance(x, dict) and x is not coder.shown]
        assert sum(map(len, kept)) <= 400 and len(coder.words.starts) <= 401
    assert len(coder.words) == 400 and "rules" not in vars(coder)
