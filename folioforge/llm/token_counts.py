"""Exact token counts with a whole-token shortcut.

Offline, once per tokenizer file, every vocabulary string is run through the library: those that come back as exactly one
token from one pre-token are proven whole. Texts are cut into pre-tokens with the tokenizer's own pattern; a proven
pre-token counts one, and only the others are merged, once per worker, by the library's model.

Texts that hold a special string, or characters outside the blocks on which the pattern is known to cut alike, go to the
library whole. Special strings inside texts count as the library's default treats them.

Defined cases: null and empty texts have 0 bytes and 0 tokens. Rows are counted one by one, so equal rows get equal
results; a null doc_id stays null. Other columns pass through, except those named like a result.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from folioforge.llm.common import in_arrow
from folioforge.llm.encoders import load
from folioforge.llm.words import parts

# The pattern of byte-level tokenizers; a fixed value that must equal theirs.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Latin, Greek, Cyrillic and general punctuation: letters, digits and spaces are settled there.
KNOWN = regex.compile("[\x00-ɏͰ-ͷͺ-Ϳ΄-ΊΌΎ-ΡΣ-ԯ‐-‧‰-⁞€]*")
CACHE = 500_000  # merged pre-tokens kept per worker; others are merged again when they turn up


def is_byte_level(path: str) -> bool:
    """Whether the file is byte-level BPE with PATTERN and nothing else that changes texts."""
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    pre = rules.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
    return bool(plain and not rules.get("normalizer") and rules["model"]["type"] == "BPE" and not rules["model"].get("dropout"))


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: visible Latin-1 as itself, the others from U+0100 on in order."""
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {**{b: chr(b) for b in visible}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


def whole_tokens(path: str) -> list[str]:
    """Vocabulary strings that, alone in a text, are one pre-token and one token; proven with the library."""
    tokenizer, cut = load(path), regex.compile(PATTERN)
    back = {letter: byte for byte, letter in byte_letters().items()}
    special = set(tokenizer.get_added_tokens_decoder())
    texts = []
    for token, number in tokenizer.get_vocab().items():
        if number in special or any(c not in back for c in token):
            continue
        try:
            texts.append(bytes(back[c] for c in token).decode("utf-8"))
        except UnicodeDecodeError:
            continue
    proven = []
    for i in range(0, len(texts), 4096):
        part = texts[i : i + 4096]
        for text, e in zip(part, tokenizer.encode_batch(part, add_special_tokens=False)):
            if len(e.ids) == 1 and cut.fullmatch(text) and KNOWN.fullmatch(text):
                proven.append(text)
    return sorted(proven)


class Counter(dict):
    """Pre-token → tokens. Proven ones are there from the start; the rest are merged when missed."""

    def __init__(self, path: str, proven: list[str]):
        super().__init__((text, 1) for text in proven)
        self.tokenizer = load(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.letters = byte_letters()
        self.most = len(self) + CACHE
        self.cut = regex.compile(PATTERN)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, piece: str) -> int:
        shown = "".join(map(self.letters.__getitem__, piece.encode("utf-8")))
        n = len(self.tokenizer.model.tokenize(shown))
        if len(self) < self.most:
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        if not KNOWN.fullmatch(text) or any(s in text for s in self.special):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(map(self.__getitem__, self.cut.findall(text)))


_counters: dict[str, Counter] = {}


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """Every row with ``n_bytes``, ``n_tokens`` and ``over_limit``; the text itself does not come back."""
    if not is_byte_level(tokenizer):
        raise ValueError("the shortcut is proven for byte-level BPE files only")
    proven = zlib.compress(json.dumps(whole_tokens(tokenizer)).encode())  # bounded by the vocabulary
    rest = [c for c in docs.columns if c.lower() not in ("text", "n_bytes", "n_tokens", "over_limit")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema.fields)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _counters:
            _counters[tokenizer] = Counter(tokenizer, json.loads(zlib.decompress(proven)))
        count = _counters[tokenizer].count
        for batch in batches:
            for part in parts(batch):
                n = np.fromiter((count(t) if t else 0 for t in part["text"].to_pylist()), np.int64, part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*[part[c] for c in rest], part["n_bytes"], pa.array(n)], names=[*rest, "n_bytes", "n_tokens"]
                )

    sized = docs.select(*rest, "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    out = in_arrow(sized, counted, f"{schema}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
