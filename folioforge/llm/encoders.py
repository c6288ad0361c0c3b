"""Token ids of whole texts inside tasks, as the tokenizers library gives them, with work shared between equal words."""

from __future__ import annotations

import json
import os
from array import array

import numpy as np
import pyarrow as pa
import regex
from tokenizers import pre_tokenizers

from folioforge.llm.words import split_words

# Characters whose NFC form is themselves and whose lower case is one character: printable Latin up to Extended-A.
SIMPLE = regex.compile("[\x21-\x7e¡-ÿĀ-įı-ňŊ-ž]+")
CACHE = 500_000  # words and pieces that a worker keeps; others are encoded each time they turn up in a batch


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Pool(dict):
    """Word → number of its ids in one flat array. A word that is missed is made, and kept while there is room.

    Words beyond the room are there for the batch at hand and leave with :meth:`trim`. As room never comes back, the ids of
    kept words lie before all others.
    """

    def __init__(self, make, kind: str, room: int):
        super().__init__()
        self.make, self.room, self.kept = make, room, 0
        self.ids, self.starts = array(kind), array("q", [0])

    def add(self, ids) -> int:
        self.ids.extend(ids)
        self.starts.append(len(self.ids))
        return len(self.starts) - 2

    def __missing__(self, word: str) -> int:
        number = self.make(word)
        if len(self) < self.room:
            self[word], self.kept = number, len(self.starts) - 1
        return number

    def of(self, number: int) -> array:
        return self.ids[self.starts[number] : self.starts[number + 1]]

    def trim(self) -> None:
        del self.starts[self.kept + 1 :]
        del self.ids[self.starts[-1] :]


class Encoder:
    """Ids of a batch of texts, without added special tokens, truncation or padding."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.words = Pool(self._make, self.dtype.char, CACHE)
        with open(path, encoding="utf-8") as f:
            self.pattern = self.word_pattern(json.load(f))  # the rules hold the whole vocabulary, so they are not kept
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # The character that stands for each byte beyond ASCII: its own, seen as the second byte of a character or the first.
        self.shown = {}
        for c in map(chr, range(0x80, 0x800)):
            self.shown.update(zip(c.encode(), level.pre_tokenize_str(c)[0][0]))

    def word_pattern(self, rules: dict):
        """The split pattern, if words can be encoded one by one: white space separates and is dropped, case is dropped."""
        norm = [n.get("type") for n in (rules.get("normalizer") or {}).get("normalizers", [])]
        pre = (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if norm != ["NFC", "Replace", "Lowercase"] or [p.get("type") for p in pre] != ["Split", "ByteLevel"]:
            return None
        split, level = pre
        plain = split["behavior"] == "Removed" and split["invert"] and not (level["add_prefix_space"] or level["use_regex"])
        return regex.compile(split["pattern"]["Regex"]) if plain else None

    def _piece(self, piece: str) -> int:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.shown)
        return self.words.add([t.id for t in self.tokenizer.model.tokenize(shown)])

    def _make(self, word: str) -> int:
        """Number of a word's new ids, or of those it shares.

        A piece of letters is a word too. The pattern may cut another piece otherwise where it stands alone, so such a piece
        goes by a name that no word has: a space before it.
        """
        if word[:1] == " ":
            return self._piece(word[1:])
        if word.isalpha() and (word.isascii() or SIMPLE.fullmatch(word)):
            lower = word.lower()
            return self._piece(word) if lower == word else self.words[lower]
        if SIMPLE.fullmatch(word) and "<|" not in word:
            ids = array(self.dtype.char)
            for piece in self.pattern.findall(word.lower()):
                ids += self._word(piece if piece.isalpha() else " " + piece)
            return self.words.add(ids)
        return self.words.add(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _word(self, word: str) -> array:
        return self.words.of(self.words[word])

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each); ``end`` is appended to every text."""
        n_rows, words = len(texts), self.words
        if self.pattern is None:
            each = self.tokenizer.encode_batch(texts.fill_null("").to_pylist(), add_special_tokens=False)
            number, row = np.array([words.add(e.ids) for e in each], np.int64), np.arange(n_rows)
        else:
            row, codes, vocab = split_words(texts)
            number = np.fromiter(map(words.__getitem__, vocab), np.int64, len(vocab))[codes]
        counts = np.bincount(row, minlength=n_rows)
        if end is not None:
            number = np.insert(number, np.cumsum(counts), words.add([end]))
            counts += 1
        del row
        flat, starts = np.frombuffer(words.ids, self.dtype), np.frombuffer(words.starts, np.int64)
        size = starts[number + 1] - starts[number]
        before = np.concatenate([[0], np.cumsum(size)])
        place = np.repeat(starts[number] - before[:-1], size)
        place += np.arange(len(place))
        out, sizes = flat[place], np.diff(before[np.concatenate([[0], np.cumsum(counts)])])
        del flat, starts
        words.trim()
        return out, sizes


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file; its caches outlive a task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
