"""The operators against brute force, on a small corpus and on odd and empty tables."""

import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from made_texts import edited, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folioforge.llm import language, rule_quality, toxicity
from folioforge.llm.components import components
from folioforge.llm.decontam import block_bounds, decontaminate, leaks
from folioforge.llm.line_dedup import dedup_lines
from folioforge.llm.mixing import copies, mix, mix_plan, sized, source_targets
from folioforge.llm.ngram_join import jaccard_join
from folioforge.llm.quality_rules import quality_rules, with_base_rules
from folioforge.llm.token_counts import Counter, token_counts, whole_tokens
from folioforge.llm.token_files import ShardReader, qualified, read_tokens, token_folder, write_tokens

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def benchmark(spark, items):
    return spark.createDataFrame([*items, (8, None), (9, "")], "item_id long, text string")


def same_rows(a, b):
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(a) == key(b.select(a.columns))


# Line dedup


def test_lines(docs, corpus):
    out = dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect()
    assert {r[0]: tuple(r[1:]) for r in out} == brute.line_dedup([r[:2] for r in corpus])
    assert sum(r[2] for r in out) >= 6


def test_lines_of_shared_and_missing_ids(spark):
    line = "a line of more than twenty signs"
    rows = [(1, line), (1, f"{line}\nx"), (2, line)]
    assert {r["n_dropped"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {0}
    rows += [(None, line), (None, f"{line}\ny")]
    out = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_dropped"]) for r in out) == [(0, 1), (0, 1), (1, 1), (1, 1), (2, 0)]
    alone = spark.createDataFrame([(None, line)] * 3, "doc_id long, text string")
    assert {r["text"] for r in dedup_lines(alone).collect()} == {line}


# Quality rules


def test_base_rules(docs, corpus):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in with_base_rules(docs).collect()}
    assert got == {r[0]: brute.base_counts(r[1]) for r in corpus}


def test_ratio_rejects_what_trusted_texts_lack(spark, docs, corpus):
    trusted = spark.createDataFrame([(i,) for i in range(30)], "doc_id long")
    out = {r["doc_id"]: r for r in quality_rules(docs, trusted).collect()}
    noisy = [r[0] for r in corpus if r[1] and "***" in r[1]]
    assert len(noisy) == 5 and not any(out[i]["kept"] for i in noisy)
    assert all(out[i]["kept"] for i in range(58))


def test_ratio_without_trusted_texts(spark, docs):
    none = spark.createDataFrame([], "doc_id long")
    assert quality_rules(docs, none).filter("kept = base_failed OR llr <> 0").isEmpty()


# N-gram Jaccard join


def test_components(docs, corpus):
    rows, links = jaccard_join(docs)
    assert {r[0]: (r[1], r[2]) for r in rows.collect()} == brute.components([r[:2] for r in corpus])
    assert links.count() >= 10


def test_hot_groups_link_whole(spark):
    base = prose(9, 120)
    rows = [(i, base) for i in range(60)] + [(100 + i, edited(base, i, 0.012)) for i in range(60)]
    rows += [(300 + i, prose(700 + i, 100)) for i in range(20)]
    out, links = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r[0]: (r[1], r[2]) for r in out.collect()} == brute.components(rows)
    assert links.count() < 60 * 59 / 2


def test_salted_tokens_link_the_same(spark, docs, corpus, monkeypatch):
    monkeypatch.setattr("folioforge.llm.ngram_join.SALT_ROWS", 2)
    rows, _ = jaccard_join(docs)
    assert {r[0]: (r[1], r[2]) for r in rows.collect()} == brute.components([r[:2] for r in corpus])


def test_join_of_odd_rows(odd, corpus):
    rows = jaccard_join(odd)[0].collect()
    assert len(rows) == odd.count()
    # Text 7 stands under id 6 and twice under none; text 8 and the null text stand alone without id.
    found = sorted(((r["doc_id"], r["component_id"]) for r in rows), key=repr)
    assert found == sorted([(0, 0)] * 3 + [(1, 1), (2, 2), (5, 5), (6, 6), (None, 6), (None, 6), (None, None), (None, None)], key=repr)


def test_long_chain_of_edges(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 95), (95, 99), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 99: 90}


# Benchmark decontamination


def test_leaks(docs, corpus, benchmark, items):
    found = leaks(docs, benchmark)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == brute.leaks([r[:2] for r in corpus], items)
    kept = {r["doc_id"] for r in decontaminate(docs, benchmark).collect()}
    assert kept == {r[0] for r in corpus} - {d for d, _ in brute.leaks([r[:2] for r in corpus], items)}


def test_changed_passages(spark, items):
    rows = []
    for seed in range(60):
        item = items[seed % 5][1]
        text = edited(item, seed, 0.03).upper() if seed % 2 else edited(item, seed, 0.03)
        rows.append((seed, f"{prose(seed, 25)} {text} {prose(seed + 1, 25)}"))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = leaks(table, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == brute.leaks(rows, items)


def test_passages_in_another_order(spark):
    """The best window stands at another offset than the parts do in the item."""

    passages = [(n, prose(2000 + n, n).split()) for n in (40, 60, 100, 200)]
    rows = []
    for n, w in passages:
        for cut in (n // 2, n // 3):
            swapped = " ".join(w[cut:] + w[:cut])
            rows += [(len(rows) + j, t) for j, t in enumerate((f"{prose(n, 150)} {swapped} {prose(n + 1, 150)}", f"{swapped} {prose(n, 9)}", swapped))]
    rows += [(None, rows[0][1]), (None, rows[0][1]), (0, rows[4][1])]
    passages = [(n, " ".join(w)) for n, w in passages]
    got = leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(passages, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute.leaks(rows, passages)
    assert len(brute.leaks(rows, passages)) == 25
    # The window over the whole swapped passage lacks the width - 1 shingles that cross the cut.
    assert all(r["shared"] == r["item_id"] - 8 and r["united"] == r["item_id"] for r in got)


def test_repeated_filler_does_not_outvote(spark):
    """The last tenth of a long passage gave way to one repeated word; weighted similarity 0.82."""

    passages = [(i, prose(3000 + i, 304)) for i in range(12)]
    rows = [(i, " ".join([*t.split()[:274], *["_"] * 60])) for i, t in passages]
    got = leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(passages, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == brute.leaks(rows, passages) == {(i, i) for i in range(12)}


def test_blocks_cover_the_radius():
    for radius in (0, 3, 24):
        bounds = block_bounds(radius)
        assert sum(w for _, w in bounds) == 64 and 2 * len(bounds) > radius


# Mixing


def test_mix_hits_its_targets(spark, docs):
    sizes = sized(docs)
    rows = copies(sizes, mix_plan(sizes)).collect()
    again = copies(sizes.repartition(3), mix_plan(sizes.repartition(5))).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    largest = 0
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        taken = sum(r["size"] * r["copies"] for r in own)
        largest = max(r["size"] for r in own)
        assert abs(taken - own[0]["target"]) <= largest / 2 and own[0]["target"] <= 2 * own[0]["source_size"]
        assert {r["copies"] for r in own} <= {0, 1, 2}
    total = sum(r["size"] for r in rows)
    assert sum({r["source"]: r["target"] for r in rows}.values()) == pytest.approx(1.5 * total)


def test_targets_share_the_excess(spark):
    table = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), (None, 50)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(table).collect()}
    # 1740 words by 5:2:1:5; a, b and the null source stop at twice their size, c takes the rest.
    assert got == {"a": 20.0, "b": 200.0, None: 100.0, "c": 1420.0}


def test_mix_returns_whole_rows(odd):
    out = mix(odd)
    assert out.columns == odd.columns
    assert out.subtract(odd).isEmpty()


# Tokens


def test_token_files(spark, docs, corpus):
    folder = token_folder(spark)
    shards = write_tokens(docs, folder, WORD, 2)
    got = [tuple(r) for r in read_tokens(shards, folder).orderBy("doc_id").collect()]
    tokenizer, want, start = Tokenizer.from_file(WORD), [], 0
    for doc_id, text, *_ in corpus:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    name = shards.first()["name"]
    reader = ShardReader(qualified(spark, folder), name)
    middle = int(reader.index["doc_id"][len(reader.index) // 2])
    assert reader.find(middle).tolist() == [*tokenizer.encode(corpus[middle][1] or "", add_special_tokens=False).ids, 2]
    assert reader.find(10**9) is None


def test_token_files_without_word_pattern(spark, docs, corpus):
    folder = token_folder(spark)
    got = {r["doc_id"]: r["n_tokens"] for r in read_tokens(write_tokens(docs, folder, BYTE, 2), folder).collect()}
    tokenizer = Tokenizer.from_file(BYTE)
    assert got == {r[0]: len(tokenizer.encode(r[1] or "").ids) + 1 for r in corpus}


def test_token_counts(docs, corpus):
    tokenizer = Tokenizer.from_file(BYTE)
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts(docs, BYTE).collect()}
    want = {r[0]: (len((r[1] or "").encode()), len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in corpus}
    assert got == {d: (b, n, n > 512) for d, (b, n) in want.items()}


def test_proven_tokens_and_odd_strings():
    tokenizer, proven = Tokenizer.from_file(BYTE), whole_tokens(BYTE)
    assert len(proven) > 40_000 and all(len(tokenizer.encode(t).ids) == 1 for t in proven[::97])
    counter = Counter(BYTE, proven)
    for text in ("a  b\n\n c\t", " it's we'll 'tis", "<|endoftext|>x", "東京 1२３", "éa    x", "x" * 5000, "\x00\x1f", "ﬁ ½ ²"):
        assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), text


# Learned operators: held-out accuracy


def labelled(spark):

    rows = []
    for i in range(240):
        toxic, good = i % 4 == 0, i % 3 != 0
        text = prose(2000 + i, 40 + i % 50)
        text = text.replace("an", "ñe").replace("ta", "oß") if i % 2 else text
        text = text.replace(" ", " vile " if toxic else " calm ", 2)
        text = text if good else text.upper().replace(" ", "!! ")
        rows.append((i, text, "b" if i % 2 else "a", int(toxic), int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int, quality int")


def test_language(spark):
    rows = labelled(spark)
    model = language.fit(rows.filter("doc_id < 160"))
    out = language.predict(rows.filter("doc_id >= 160").select("doc_id", "text", "lang"), model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) == len(out) and all(0 <= r["score"] <= 1 for r in out)
    blank = spark.createDataFrame([(1, None), (2, ""), (3, "12 ;;"), (4, "zzqx")], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(blank, model).collect()}
    assert [got[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3 and got[4][0] in "ab"


def test_toxicity(spark):
    rows = labelled(spark)
    known = rows.filter("doc_id < 160")
    network = toxicity.fit(known, language.fit(known))
    out = toxicity.score(rows.filter("doc_id >= 160").select("doc_id", "text", "toxic"), network).collect()
    assert sum(r["toxic"] == r["predicted"] for r in out) >= 0.95 * len(out)
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "12"), (4, "vile " * 9000)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(odd, network).collect()}
    assert got[1] == got[2] == got[None] < 0.7 <= got[4]


def test_toxicity_does_not_depend_on_neighbours(spark):
    rows = labelled(spark)
    network = toxicity.fit(rows, language.fit(rows))
    whole = {r["doc_id"]: r["score"] for r in toxicity.score(rows.coalesce(1), network).collect()}
    apart = {r["doc_id"]: r["score"] for r in toxicity.score(rows.repartition(7), network).collect()}
    assert whole == pytest.approx(apart, abs=1e-6)


def test_rule_quality(spark):
    rows = rule_quality.with_features(labelled(spark))
    model = rule_quality.fit(rows.filter("doc_id < 160"), rows)
    assert model.rules
    out = rows.filter("doc_id >= 160").select("quality", "features.*", model.column().alias("score")).collect()
    assert all((r["score"] >= 0.5) == bool(r["quality"]) for r in out)
    x = np.array([[r[n] for n in rule_quality.NAMES] for r in out])
    assert np.allclose(model.score(x), [r["score"] for r in out])


# Empty tables and columns named like results


def test_empty_tables(spark, docs, benchmark):
    none, labels = docs.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert dedup_lines(none).isEmpty() and quality_rules(none, labels).isEmpty()
    assert jaccard_join(none)[0].isEmpty() and mix(none).isEmpty() and token_counts(none, BYTE).isEmpty()
    assert leaks(none, benchmark).isEmpty() and leaks(docs, benchmark.limit(0)).isEmpty()
    folder = token_folder(spark)
    assert read_tokens(write_tokens(none, folder, WORD, 2), folder).isEmpty()
    blank = language.fit(none)
    assert {r["lang_pred"] for r in language.predict(docs, blank).collect()} == {"und"}
    network = toxicity.fit(docs.join(labels.drop("quality"), "doc_id"), blank)
    assert {r["score"] for r in toxicity.score(docs, network).collect()} == {0.0}
    featured = rule_quality.with_features(docs)
    column = rule_quality.fit(featured, labels).column()
    assert {r[0] for r in featured.select(column).collect()} == {0.5}


def test_odd_rows_pass_everywhere(spark, odd, benchmark):
    n = odd.count()
    labels = spark.createDataFrame([(0, 1, 1), (1, 0, 0), (None, None, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    for out in (
        dedup_lines(odd),
        quality_rules(odd, labels.filter("quality = 1")),
        token_counts(odd, BYTE),
        language.predict(odd, language.fit(odd)),
        toxicity.score(odd, toxicity.fit(odd.join(labels.drop("quality"), "doc_id"), language.fit(odd))),
        rule_quality.with_features(odd),
        decontaminate(odd, benchmark),
    ):
        assert out.count() == n
    same = dedup_lines(odd)
    assert same.filter("doc_id = 0").distinct().count() == 1
    folder = token_folder(spark)
    ids = [r["doc_id"] for r in read_tokens(write_tokens(odd, folder, WORD, 2), folder).orderBy("start").collect()]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i) and len(ids) == n
