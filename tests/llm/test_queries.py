"""Registered corpus queries: against their SQL, and the pipeline against a brute-force version."""

import hashlib
import os
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from oracle_check import connect, differences
from tokenizers import Tokenizer

import corpus_pipeline
from folioforge.llm.byte_bpe import read_ranks
from folioforge.llm.oracles import ORACLES
from folioforge.llm.quality_rules import quality_rules
from folioforge.llm.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
if not os.path.isdir(SF_DIR):
    pytest.skip("no test tables", allow_module_level=True)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert differences(spark, connect(SF_DIR), QUERIES[name], ORACLES[name], SF_DIR) == []


def rows(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def test_every_operator_is_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


def test_leaks_of_the_tables(spark):
    docs = [(r["doc_id"], r["text"]) for r in rows(spark, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in rows(spark, "benchmark").collect()]
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op4_benchmark_leaks"](spark, SF_DIR).collect()}
    assert got == brute.leaks(docs, items)


@pytest.mark.parametrize("name, label, fold, folds", [("op5_language", "lang", 1, 3), ("op6_toxicity", "toxic", 1, 3), ("op9_rule_quality", "quality", 0, 5)])
def test_learned_queries_cover_every_row(spark, name, label, fold, folds):
    out = {r["doc_id"]: r for r in QUERIES[name](spark, SF_DIR).collect()}
    assert len(out) == rows(spark, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % folds == fold) and 0 <= r["score"] <= 1 for i, r in out.items())
    if label == "lang":
        known = rows(spark, "documents").filter("lang IS NOT NULL").collect()
        assert np.mean([out[r["doc_id"]]["lang_pred"] == r["lang"] for r in known]) > 0.95


def test_pipeline(spark):
    out = [tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).orderBy("start").collect()]
    docs = rows(spark, "documents")
    # The verdict of the learned ratio is taken from the operator; all that follows is done again by brute force.
    trusted = rows(spark, "labels").filter("quality = 1")
    kept = {r["doc_id"] for r in quality_rules(docs, trusted).filter("kept").collect()}
    assert kept <= {r["doc_id"] for r in docs.collect() if not brute.base_counts(r["text"])[-1]}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in kept}
    groups = brute.components(list(texts.items()))
    texts = {d: t for d, t in texts.items() if groups[d][1] == d}
    items = [(r["item_id"], r["text"]) for r in rows(spark, "benchmark").collect()]
    leaked = {d for d, _ in brute.leaks(list(texts.items()), items)}
    texts = {d: t for d, t in texts.items() if d not in leaked}
    sources = {r["doc_id"]: r["source"] for r in docs.collect()}
    con = connect(SF_DIR)
    con.execute("DROP VIEW documents")
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(d, t, sources[d]) for d, t in texts.items()])
    taken = {r[0]: r[4] // r[1] for r in con.execute(ORACLES["op1_pareto_mix"]).fetchall()}
    tokenizer, want, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), [], 0
    for d in sorted(texts):
        ids = [*tokenizer.encode(texts[d], add_special_tokens=False).ids, 2]
        for _ in range(taken[d]):
            want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    assert out == want


def test_byte_bpe_of_the_table(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    want = {}
    for r in rows(spark, "documents").collect():
        ids, text = library.encode_ordinary(r["text"] or ""), (r["text"] or "").encode()
        want[r["doc_id"]] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text).hexdigest())
    assert {r[0]: tuple(r[1:]) for r in QUERIES["op13_byte_bpe"](spark, SF_DIR).collect()} == want
