"""Scores against plain Python: backoff, likelihood ratio; pairs compared once; samples of hot classes; odd pipeline rows."""

import math
import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
import regex
import xxhash
from made_texts import edited, prose
from pyspark.sql import functions as F

import corpus_pipeline
from folioforge.llm import language, ngram_join, quality_rules, token_files
from folioforge.llm.decontam import decontaminate
from folioforge.llm.mixing import copies, mix_plan, sized
from folioforge.llm.ngram_join import jaccard_join


# Language


@pytest.fixture(scope="module")
def speakers(spark):
    rng, words = random.Random(2), {"aa": "le la maison et chien", "bb": "the house and dog cat", "cc": "das haus und hund"}
    rows = []
    for i in range(90):
        lang = ("aa", "bb", "cc")[i % 3]
        rows.append((i, " ".join(rng.choice(words[lang].split()) for _ in range(rng.randint(1, 12))), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


def backoff(rows, text):
    """Scores by language, restated."""
    words, levels = defaultdict(Counter), [defaultdict(Counter) for _ in range(4)]
    for _, t, lang in rows:
        for w in regex.findall(r"\p{L}+", t.lower()):
            words[lang][w] += 1
    for lang, counts in words.items():
        for w, n in counts.items():
            shown = f"<{w}>"
            for order in range(1, 5):
                for i in range(len(shown) - order + 1):
                    levels[order - 1][lang][shown[i : i + order]] += n
    out = {}
    for lang in words:
        total = 0.0
        tables = [{k: v for k, v in words[lang].items() if v > 1}, *[t[lang] for t in levels]]
        known_words = {k for t in words.values() for k, v in t.items() if v > 1}
        sums = [sum(words[lang].values()), *[sum(t[lang].values()) for t in levels]]
        value = lambda level, item: math.log(tables[level][item] / sums[level] if item in tables[level] else 0.5 / (sums[level] + 1))
        for w in regex.findall(r"\p{L}+", text.lower()):
            if w in known_words:
                total += value(0, w)
                continue
            shown, places = f"<{w}>", 0.0
            for i in range(len(shown)):
                order = next((k for k in range(4, 0, -1) if i + k <= len(shown) and any(shown[i : i + k] in t for t in levels[k - 1].values())), 1)
                places += value(order, shown[i : i + order])
            total += places / len(shown)
        out[lang] = total
    return out


def test_backoff_by_hand(speakers):
    df, rows = speakers
    model = language.fit(df)
    for text in ("la maison", "the dogs", "hunde", "xyz qq", "Le CHIEN and das", "zz"):
        want = backoff(rows, text)
        best = max(sorted(want), key=want.get)
        langs, scores = model.predict(pa.array([text]))
        assert langs == [best]
        assert scores[0] == pytest.approx(1 / sum(math.exp(v - want[best]) for v in want.values()))


def test_scores_do_not_depend_on_neighbours(speakers):
    df, _ = speakers
    model, rng = language.fit(df), random.Random(4)
    texts = [prose(i, rng.randint(0, 60)) for i in range(60)] + ["la maison the house", "", None, "das"]
    alone = {t: [x[0] for x in model.predict(pa.array([t], pa.string()))] for t in texts}
    for _ in range(10):
        rng.shuffle(texts)
        for t, lang, score in zip(texts, *model.predict(pa.array(texts, pa.string()))):
            assert [lang, score] == alone[t]


def test_ties_go_to_the_first_name(spark):
    rows = [(i, "same words same", lang) for i, lang in enumerate(("b", "a", "b", "a"))]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.predict(pa.array(["same words", "unseen"]))[0] == ["a", "a"]


def test_very_long_text(speakers):
    model = language.fit(speakers[0])
    langs, scores = model.predict(pa.array(["the house " * 300_000, "la"]))
    assert langs == ["bb", "aa"] and np.isfinite(scores).all()


def test_sample_of_a_hot_class(spark):
    rows = spark.range(0, 20_000, 1, 8).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("c"))
    got = language.sample_ids(rows, "c", 1500)
    assert {(r["c"], r["n"]) for r in got.groupBy("c").agg(F.count("doc_id").alias("n")).collect()} == {("rare", 1500), ("hot", 1500)}
    first = rows.filter("c = 'hot'").orderBy(F.xxhash64(F.lit("sample"), "doc_id")).limit(1500)
    assert got.filter("c = 'hot'").select("doc_id").exceptAll(first.select("doc_id")).isEmpty()


# Likelihood ratio


def test_ratio_by_hand(spark, docs, corpus):
    trusted = set(range(0, 58))
    cells = 512
    cut = lambda t: regex.findall(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]+", (t or "").lower())

    def places(p):
        signed = lambda h: h - (1 << 64) if h >> 63 else h
        one = [xxhash.xxh64_intdigest(x.encode(), 42) for x in p]
        two = [xxhash.xxh64_intdigest(y.encode(), h) for h, y in zip(one, p[1:])]
        return [signed(h) % cells for h in one] + [signed(h) % cells + cells for h in two]

    raw, target = Counter(), Counter()
    for r in corpus:
        raw.update(places(cut(r[1])))
        target.update(places(cut(r[1])) if r[0] in trusted else ())
    weights = {}
    for part in (range(cells), range(cells, 2 * cells)):
        share = sum(target[c] for c in part) / sum(raw[c] for c in part)
        weights |= {c: math.log((target[c] + 1) / (raw[c] * share + 1)) for c in part}
    ids = spark.createDataFrame([(i,) for i in trusted], "doc_id long")
    for r in quality_rules.quality_rules(docs, ids, cells=cells).collect():
        own = places(cut(dict((x[0], x[1]) for x in corpus)[r["doc_id"]]))
        want = sum(weights[c] for c in own) / len(own) if own else 0.0
        assert r["llr"] == pytest.approx(want, abs=1e-9)
        assert r["kept"] == (not r["base_failed"] and r["llr"] >= quality_rules.THRESHOLD)


def test_base_rules_with_any_column_names(docs):
    named = docs.withColumn("__counts", F.lit("own"))
    assert {r["__counts"] for r in quality_rules.with_base_rules(named).collect()} == {"own"}


# Jaccard join


def test_pairs_are_compared_once(spark, monkeypatch):
    base = [prose(i, 120) for i in range(4)]
    rows = [(100 * k + i, edited(b, 31 * k + i, 0.012 if i % 2 else 0.06)) for k, b in enumerate(base) for i in range(30)]
    seen, plain = [], ngram_join._verified

    def verified(*args):
        compared, links = plain(*args)
        seen.append({(r["a"], r["b"]) for r in compared.collect()})
        return compared, links

    monkeypatch.setattr(ngram_join, "_verified", verified)
    out, _ = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r[0]: (r[1], r[2]) for r in out.collect()} == brute.components(rows)
    assert len(seen) == 2 and seen[1] and not seen[0] & seen[1]
    assert all(a > b for pairs in seen for a, b in pairs)


def test_salted_pairs_link_the_same(spark, docs, corpus, monkeypatch):
    monkeypatch.setattr(ngram_join, "PAIR_ROWS", 1)
    rows, _ = jaccard_join(docs)
    assert {r[0]: (r[1], r[2]) for r in rows.collect()} == brute.components([r[:2] for r in corpus])


# Mixing, token files, decontamination


def test_rows_without_id_are_drawn_one_by_one(spark):
    rows = [(None, f"{i} " + "word " * 19, "s") for i in range(400)] + [(1, "x " * 4000, "t")]
    sizes = sized(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    taken = copies(sizes, mix_plan(sizes, percent=60)).filter("source = 's'")
    row = taken.agg(F.sum(F.col("size") * F.col("copies")).alias("n"), F.first("target").alias("target")).first()
    assert abs(row["n"] - row["target"]) <= 20


def test_pieces_of_long_id_arrays():
    ids = np.arange(50_000)
    pieces = token_files.spaced(ids)
    assert [len(p) for p in pieces] == [token_files.PIECE_IDS] * token_files.SAMPLE_PIECES
    assert pieces[0][0] == 0 and pieces[-1][-1] == 49_999
    assert token_files.spaced(ids[:10])[0].tolist() == list(range(10))


def test_decontamination_with_any_column_names(spark, docs, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    named = docs.withColumns({"__id": F.lit(1), "__row": F.lit("x"), "kept": F.lit(0), "leak": F.lit(2), "row": F.lit(3)})
    out = decontaminate(named, benchmark)
    assert out.columns == named.columns
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in decontaminate(docs, benchmark).collect()}


# Pipeline


def test_pipeline_of_odd_rows(spark, odd, docs, corpus, items, tmp_path):
    clash = odd.withColumnsRenamed({"n_words": "__node", "kept": "__text", "size": "__n"})
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    clash.write.parquet(str(tmp_path / "documents.parquet"))
    stages, kept = corpus_pipeline.STAGES, clash
    for name, stage in stages[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == clash.columns, name
    rows = kept.collect()
    assert len({(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, clash, "").collect()}) == corpus_pipeline.drop_near_copies(spark, clash, "").count()
    assert all(r["text"] for r in rows)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(rows)


def test_repeated_rows_leave_the_same_row(spark):
    texts = [(1, prose(1, 80), s) for s in ("b", "a", "c", "a")] + [(2, prose(2, 80), "z")]
    rows = spark.createDataFrame(texts, "doc_id long, text string, source string")
    for df in (rows, rows.repartition(4, "source"), rows.orderBy(F.desc("source"))):
        assert sorted((r["doc_id"], r["source"]) for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()) == [(1, "a"), (2, "z")]


def test_pipeline_of_nothing(spark, docs, tmp_path):
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()
