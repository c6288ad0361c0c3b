"""Filter audit, vector codes and byte-level BPE against brute force, on a small corpus and on odd and empty tables."""

import hashlib
import itertools
import math
import random

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from made_texts import prose
from pyspark.sql import functions as F

from folioforge.llm import byte_bpe, vector_codes
from folioforge.llm.filter_audit import audit_documents, filter_audit

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# Filter audit


def failures(rows):
    """{row number: set of failed filters} by the definitions."""
    least = {}
    for _, doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    out = {}
    for n, doc_id, text, _ in rows:
        text = text or ""
        w, first = brute.words(text), least.get(text)
        failed = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w)}
        failed["C"] = 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text)
        failed["D"] = any(c in "#$%&*|" for c in text)
        failed["E"] = first is not None and (doc_id is None or doc_id > first)
        out[n] = {k for k, v in failed.items() if v}
    return out


def audited(rows, good, toxic):
    failed, out = failures(rows), {}
    for part in {r[3] or "" for r in rows}:
        own = [(n, doc_id) for n, doc_id, _, source in rows if (source or "") == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in failed[r[0]]]
                left = [r for r in left if f not in failed[r[0]]]
                fails = sum(f in failed[n] for n, _ in own)
                alone = sum(failed[n] == {f} for n, _ in own)
                lost = [sum(d in labelled for _, d in gone) for labelled in (good, toxic)]
                out[part, order, step] = [len(left), len(gone), fails - len(gone), alone, *lost]
                removed_by[f] += len(gone)
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


NAMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def collected(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in NAMES) for r in df.collect()}


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 2 == 0), int(i % 5 == 0)) for i in range(0, 80, 1)] + [(3, 1, None), (None, 1, 1), (4, None, None), (9999, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_audit(docs, corpus, labels):
    rows = [(n, r[0], r[1], r[3]) for n, r in enumerate(corpus)]
    good = {i for i in range(80) if i % 2 == 0} | {3}
    assert collected(audit_documents(docs, labels)) == audited(rows, good, {i for i in range(0, 80, 5)})


def test_audit_of_odd_rows(odd, labels):
    rows = [(n, r["doc_id"], r["text"], r["source"]) for n, r in enumerate(odd.collect())]
    good = {i for i in range(80) if i % 2 == 0} | {3}
    want = audited(rows, good, {i for i in range(0, 80, 5)})
    assert collected(audit_documents(odd, labels)) == want
    assert sum(v[0] + v[1] for (_, order, step), v in want.items() if order == "ABCDE" and step == 1) == odd.count()


def test_audit_of_nothing(spark, docs, labels):
    assert audit_documents(docs.limit(0), labels).isEmpty()
    assert not audit_documents(docs.limit(1), labels.limit(0)).filter("good_lost = 0 AND toxic_lost = 0").isEmpty()


def test_any_filters_can_be_audited(spark):
    rows = spark.createDataFrame([("x", i, b"p", 2) for i in range(6)], "part string, doc_id long, print binary, copies long")
    ids = lambda *n: rows.filter(F.col("doc_id").isin(*n)).select("doc_id", "print")
    out = filter_audit(rows, {"L": ids(0, 1), "S": ids(1, 2, 3)}, {"gold": ids(1).select("doc_id")}).collect()
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["gold_lost"], r["shapley"]) for r in out}
    assert got == {("LS", 1): (8, 4, 0, 2, 6), ("LS", 2): (4, 4, 2, 0, 10), ("SL", 1): (6, 6, 0, 2, 10), ("SL", 2): (4, 2, 2, 0, 6)}


# Vector codes


def coded(rows):
    """{row number: (code, error)} and the codebooks' digest by the definitions."""
    usable = [(n, i, v) for n, i, v, _ in rows if v and all(x is not None and math.isfinite(x) for x in v) and len(v) % 16 == 0]
    cut = lambda v: [max(-(1 << 24), min(1 << 24, math.floor(256 * x))) for x in v]
    usable = sorted(((n, i, cut(v)) for n, i, v in usable), key=lambda r: (r[1] is None, r[1] or 0, r[2]))
    usable = [r for r in usable if len(r[2]) == len(usable[0][2])]
    p = len(usable[0][2]) // 16
    pieces = {r[0]: [r[2][k * p : k * p + p] for k in range(16)] for r in usable}
    books = [[pieces[r[0]][k] for r in usable[:64]] for k in range(16)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda k, x: min((far(x, y), e) for e, y in enumerate(books[k]))
    for _ in range(2):
        own = [[[] for _ in books[k]] for k in range(16)]
        for cutted in pieces.values():
            for k, x in enumerate(cutted):
                own[k][nearest(k, x)[1]].append(x)
        books = [[[sum(c) // len(xs) for c in zip(*xs)] if xs else books[k][e] for e, xs in enumerate(own[k])] for k in range(16)]
    out = {}
    for n, cutted in pieces.items():
        found = [nearest(k, x) for k, x in enumerate(cutted)]
        out[n] = ("".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found))
    numbers = [x for book in books for entry in book for x in entry]
    return out, hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def vectors(n, size, seed, ties=False):
    rng = random.Random(seed)
    value = (lambda: rng.choice((-0.5, 0.0, 0.25))) if ties else (lambda: rng.gauss(0, 0.2))
    return [(i, i, [value() for _ in range(size)], rng.choice((None, 1, 2, 3))) for i in range(n)]


def check_codes(spark, rows):
    df = spark.createDataFrame([r[1:] for r in rows], "vec_id long, embedding array<double>, label int")
    want, digest = coded(rows)
    got = vector_codes.vector_codes(df).collect()
    key = lambda r: repr(r)
    assert sorted(((r["vec_id"], r["code"], r["error"]) for r in got), key=key) == sorted(((rows[n][1], *want[n]) for n in want), key=key)
    assert {r["codebooks_sha256"] for r in got} == {digest}
    total = {}
    for n, (_, error) in want.items():
        total[rows[n][3]] = total.get(rows[n][3], 0) + error
    labelled = sorted(((rows[n][1], total[rows[n][3]]) for n in want), key=key)
    assert sorted(((r["vec_id"], r["label_error"]) for r in got), key=key) == labelled


@pytest.mark.parametrize("n, size, ties", [(300, 64, False), (200, 32, True), (20, 48, True), (1, 16, False)])
def test_codes(spark, n, size, ties):
    check_codes(spark, vectors(n, size, n + size, ties))


def test_codes_of_odd_rows(spark):
    rows = vectors(90, 32, 5)
    odd = [None, [], [None] * 32, [float("nan")] * 32, [float("inf")] + [0.0] * 31, [0.1] * 31, [0.1] * 16, [1e30, -1e30] * 16]
    rows += [(90 + i, 200 + i, v, None) for i, v in enumerate(odd)]
    rows += [(98, None, [0.3] * 32, 1), (99, 7, [0.2] * 32, None), (100, 7, [0.2] * 32, None), (101, None, [-0.3] * 32, 1)]
    check_codes(spark, rows)


def test_codes_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_codes.vector_codes(none).isEmpty()
    assert vector_codes.vector_codes(spark.createDataFrame([(1, None, 2)], none.schema)).isEmpty()


def test_cells_leave_out_only_dominated_entries():
    rng = np.random.default_rng(3)
    books = rng.integers(-100, 100, (16, 64, 4))
    cells, x = vector_codes.Cells(books), rng.integers(-130, 130, (5000, 4))
    entry, distance, evaluated = cells.nearest(2, x)
    every = ((x[:, None, :] - books[2][None]) ** 2).sum(axis=2)
    assert (entry == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert evaluated < every.size / 2
    before = len(cells.known[2])
    cells.nearest(2, x)
    assert len(cells.known[2]) == before
    assert vector_codes.decode("00" * 16, books).tolist() == (books[:, 0].ravel() / 256).tolist()


def test_cells_beyond_the_room_are_made_again(monkeypatch):
    monkeypatch.setattr(vector_codes, "CELLS", 3)
    rng = np.random.default_rng(4)
    books, x = rng.integers(-100, 100, (16, 30, 2)), rng.integers(-200, 200, (400, 2))
    cells = vector_codes.Cells(books)
    for part in (0, 1, 0):
        every = ((x[:, None, :] - books[part][None]) ** 2).sum(axis=2)
        assert (cells.nearest(part, x)[0] == every.argmin(axis=1)).all()
    assert sum(map(len, cells.known)) == 3


# Byte-level BPE


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


ALPHABETS = ["aeiou ", "aa  a\n\t", "a", "=-_*", "0123456789", "äöüéßñ", "日本語漢字かな", "🎉👍🏽", "՘₏ x'sre", "\x1c\x1f\x85\xa0 a", "sStTrReEvVmMlLdD' ", "Ⅷ٣½²a ", "\U000323b0࢏\U00011de0 b"]


def test_transducer_against_the_library(ranks, library):
    encoder, rng = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN), random.Random(1)
    texts = ["", "<|endoftext|>", prose(1, 400), "a" * 5000, " " * 3000, "ab" * 2000, "\n" * 999]
    for _ in range(1500):
        texts.append("".join(rng.choice(rng.choice(ALPHABETS)) for _ in range(rng.randint(0, 50))))
        texts.append("".join(rng.choice(ALPHABETS[rng.randrange(13)]) for _ in range(rng.randint(0, 90))))
    for text in texts:
        assert encoder.encode(text).tolist() == library.encode_ordinary(text), text


def test_transducer_beyond_its_tables(ranks, library, monkeypatch):
    for name in ("STATES", "PAIRS", "PIECES"):
        monkeypatch.setattr(byte_bpe, name, 5)
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    assert encoder.encode(prose(2, 300)).tolist() == library.encode_ordinary(prose(2, 300))


def test_tokens_come_out_before_the_end(ranks):
    transducer = byte_bpe.Transducer(ranks)
    state, out, held = transducer.start, [], 0
    data = (b"internationalisation" * 40) + b"a" * 200
    for i, byte in enumerate(data):
        state, emitted = transducer.move(state, byte)
        out += emitted
        held = max(held, i + 1 - sum(len(transducer.token[t]) for t in out))
    assert held < 64
    assert [*out, *transducer.close(state)] == byte_bpe.merged(data, ranks)


def test_pairs_and_small_vocabularies():
    singles = {bytes([i]): i for i in range(256)}
    for extra in ([b"ab", b"bc", b"abc"], [b"aa", b"aaa", b"aaaa"], [b"bc", b"ab", b"abcd"], [b"abc", b"ab", b"aba"]):
        ranks = {**singles, **{t: 256 + i for i, t in enumerate(extra)}}
        transducer = byte_bpe.Transducer(ranks)
        for n in range(1, 8):
            for text in map(bytes, itertools.product(b"abc", repeat=n)):
                want = [ranks[text]] if text in transducer.alone else byte_bpe.merged(text, ranks)
                assert transducer.encode(text) == want, (extra, text)


def test_streaming_decode(ranks):
    token, rng = {r: t for t, r in ranks.items()}, random.Random(5)
    for _ in range(1500):
        ids = [rng.randrange(len(ranks)) if rng.random() < 0.5 else rng.randrange(128, 256) for _ in range(rng.randint(0, 12))]
        step, stream = rng.randint(1, 4), byte_bpe.Decoder(token)
        text = "".join(stream.feed(np.array(ids[i : i + step], np.int32)) for i in range(0, len(ids), step)) + stream.close()
        assert text == b"".join(token[i] for i in ids).decode("utf-8", "replace")


def test_characters_wait_until_they_are_whole(ranks):
    token = {r: t for t, r in ranks.items()}
    stream, ids = byte_bpe.Decoder(token), [ranks[bytes([b])] for b in "a😀é".encode()]
    assert [stream.feed(np.array([i], np.int32)) for i in ids] == ["a", "", "", "", "😀", "", "é"]


def test_encode_and_decode(docs, odd, corpus, library):
    for rows in (docs, odd, docs.limit(0)):
        coded = byte_bpe.encode(rows, RANKS, public_tokenizers.PATTERN)
        assert coded.columns == [*[c for c in rows.columns if c != "text"], "ids"]
        back = byte_bpe.decode(coded, RANKS)
        key = lambda df: sorted(repr((r["doc_id"], r["source"], r["text"] or "")) for r in df.collect())
        assert key(back) == key(rows)
    got = {r["doc_id"]: r["ids"] for r in byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert got == {r[0]: library.encode_ordinary(r[1] or "") for r in corpus}


def test_bytes_that_are_no_text(spark):
    rows = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    back = byte_bpe.decode(byte_bpe.encode(rows, RANKS, public_tokenizers.PATTERN), RANKS)
    assert back.first()["text"] == "a�b"
