"""Arrow kernels that run inside tasks: words of a batch of texts, as codes into the batch's distinct words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# A batch is worked on in parts of about this many bytes of text, so that long documents cannot fill a worker.
PART_BYTES = 2 << 20


def parts(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch holding about PART_BYTES of text each, one row at least."""
    size = pc.binary_length(batch[column]).fill_null(0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // PART_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def flat_words(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(row of each word, code of each word, distinct words) of a list array; empty strings are no words."""
    row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    coded = lists.flatten().dictionary_encode()
    codes, vocab = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
    if "" in vocab:
        keep = codes != vocab.index("")
        row, codes = row[keep], codes[keep]
    return row, codes, vocab


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    return flat_words(pc.ascii_split_whitespace(texts.fill_null("")))


def letter_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Runs of letters, lower-cased."""
    return flat_words(pc.split_pattern_regex(pc.utf8_lower(texts.fill_null("")), r"\PL+"))


def hashes(vocab: list[str], seed: int = 0) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in vocab), np.uint64, len(vocab))


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64-bit result."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def spans(row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each row's run in an array that is grouped by row."""
    ends = np.cumsum(np.bincount(row, minlength=n_rows))
    return np.concatenate([[0], ends[:-1]]).astype(np.int64), ends.astype(np.int64)


def cells(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def shingle_sets(texts: pa.Array, width: int, ranked=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of each text's distinct word shingles, sorted per text, with start and end of each text.

    A text of fewer words than ``width`` has its whole word sequence as one shingle; without words it has none.
    ``ranked`` may turn (shingle hashes, sums of a value per word) into other 64-bit values, which are then sorted, and
    carries as ``ranked.word`` the value of a word hash.
    """
    n_rows = len(texts)
    row, codes, vocab = split_words(pc.ascii_lower(texts.fill_null("")))
    own = hashes(vocab)
    word = own[codes] if len(codes) else np.zeros(0, np.uint64)
    starts, ends = spans(row, n_rows)
    base = np.uint64(0x9E3779B97F4A7C15)
    whole = np.arange(max(0, len(word) - width + 1))
    whole = whole[row[whole] == row[whole + width - 1]] if len(whole) else whole
    size = ends - starts
    short = np.flatnonzero((size > 0) & (size < width))
    value, extra = np.zeros(len(whole), np.uint64), np.zeros(len(short), np.uint64)
    for j in range(width):
        value = value * base + word[whole + j]
        has = size[short] > j
        extra[has] = extra[has] * base + word[starts[short][has] + j]
    extra = extra + size[short].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    rows = np.concatenate([row[whole], short])
    value = mixed(np.concatenate([value, extra]))
    if ranked is not None:
        known = ranked.word(own)[codes] if len(codes) else np.zeros(0, np.int64)
        total, total_short = np.zeros(len(whole), np.int64), np.zeros(len(short), np.int64)
        for j in range(width):
            total += known[whole + j]
            has = size[short] > j
            total_short[has] += known[starts[short][has] + j]
        value = ranked(value, np.concatenate([total, total_short]))
    order = np.argsort(rows, kind="stable")
    rows, value = rows[order], value[order]
    starts, ends = spans(rows, n_rows)
    for a, b in zip(starts.tolist(), ends.tolist()):
        value[a:b].sort()
    first = np.ones(len(value), bool)
    first[1:] = (value[1:] != value[:-1]) | (rows[1:] != rows[:-1])
    rows, value = rows[first], value[first]
    return value, *spans(rows, n_rows)
