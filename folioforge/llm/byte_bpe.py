"""Byte-level BPE encoding as a lazily determinised finite-state transducer, and streaming decoding.

Encoding. Every prefix of a pre-token has one encoding, and it is the one sequence of tokens whose neighbours all belong
together: a pair does if merging its bytes by rank gives the pair again. While bytes are read, the transducer holds a path for
every place at which a token may still be open: the bytes since that place (the start of some token), the last token before it
and the tokens not yet emitted. The next byte extends or ends paths; of the tokens that close, one belongs after its path.
Tokens common to all paths cannot change any more and are emitted, so what is held back is bounded by how far tokens reach.

Sets of paths are the states. A state and its 256 moves are made when first needed and kept (STATES of them per worker; beyond,
moves are worked out each time). Merging by rank runs only when a pair of tokens is seen for the first time.

Pre-tokens are the matches of the split pattern. The regex module and the tokenizer's own engine know other versions of
Unicode; characters outside the blocks where both agree are replaced, for splitting only, by a letter, digit, space or sign
of the class that the tokenizer's engine gives them. Ids of a pre-token are remembered (PIECES per worker).

Decoding. The ids come in chunks; a UTF-8 state machine that moves a token at a time tells where the last whole character
ends, and the bytes behind it wait for the next chunk.

Defined cases: null and empty texts have no ids and decode to nothing. Bytes that are no UTF-8 are read as U+FFFD. Rows are
coded one by one: equal rows get equal results, null ids stay null, other columns pass through, except those named like a
result. Special strings in a text are ordinary text.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Collection, Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from folioforge.llm.common import in_arrow
from folioforge.llm.words import PART_BYTES, parts

STATES = 400_000  # transducer states kept per worker
PAIRS = 500_000  # pairs of tokens kept per worker
PIECES = 500_000  # pre-tokens whose ids are kept per worker
HEAD, HEADS = 5, 100_000  # bytes that are walked in one step from the start, and how many such steps are kept per worker
CHUNK = 1 << 16  # ids decoded at a time
# Latin, Greek, Cyrillic and general punctuation: letters, digits and spaces are settled there.
KNOWN_RANGES = "\x00-ɏͰ-ͷͺ-Ϳ΄-ΊΌΎ-ΡΣ-ԯ‐-‧‰-⁞€"
KNOWN = re.compile(f"[{KNOWN_RANGES}]*")
# The split pattern of byte-level vocabularies; a fixed value that must equal theirs.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# What stands for a character of each class while a text is split.
CLASSES = ((r"\p{L}", "é"), (r"\p{N}", "0"), (r"\s", "\t"))
OTHER = "~"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merged(piece: bytes, ranks: dict[bytes, int], down_to: int = 1) -> list[int]:
    """Tokens of ``piece`` by the definition: the pair of lowest rank is merged first, the leftmost of equals.

    Merging stops at ``down_to`` tokens.
    """
    pieces = [piece[i : i + 1] for i in range(len(piece))]
    while len(pieces) > down_to:
        pairs = [ranks.get(a + b) for a, b in zip(pieces, pieces[1:])]
        found = [r for r in pairs if r is not None]
        if not found:
            break
        i = pairs.index(min(found))
        pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
    return [ranks[p] for p in pieces]


def unmade_tokens(ranks: dict[bytes, int]) -> list[int]:
    """Tokens that merging does not make of their own bytes: they stand for a whole pre-token only."""
    return [rank for token, rank in ranks.items() if merged(token, ranks) != [rank]]


class Transducer:
    """Bytes in, tokens out. ``start`` is the first state; ``move`` and ``close`` are its two operations."""

    def __init__(self, ranks: dict[bytes, int], unmade: Collection[int] | None = None):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        unmade = set(unmade_tokens(ranks) if unmade is None else unmade)
        self.alone = {self.token[r]: r for r in unmade}
        # The tokens as a tree: node and byte in one number → node, and the token that a node is, if any.
        self.child: dict[int, int] = {}
        self.closes: list[int] = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                node = self.child.setdefault(node << 8 | byte, len(self.closes))
                if node == len(self.closes):
                    self.closes.append(-1)
            self.closes[node] = -1 if rank in unmade else rank
        self.inner = {at >> 8 for at in self.child}  # nodes that some token goes on from
        self.edges: tuple[dict[int, list], dict[int, list]] = ({}, {})
        self.pairs: dict[tuple[int, int], bool] = {}
        self.names: dict[tuple, int] = {}
        self.path: dict[tuple, tuple] = {}  # one object per path, however many states hold it
        self.paths: list[tuple] = []
        # State and byte in one number → next state and number of what is emitted in one number.
        self.moves: dict[int, int] = {}
        self.emitted: list[tuple[int, ...]] = [()]
        self.emitted_number: dict[tuple[int, ...], int] = {(): 0}
        self.start = self.state(((0, -1, ()),))
        self.heads: dict[bytes, tuple] = {}  # first bytes of a pre-token → where they lead, and what they emit

    def state(self, paths: tuple) -> int | tuple:
        """Number of the state; beyond STATES its paths stand for themselves."""
        number = self.names.get(paths)
        if number is None:
            if len(self.paths) >= STATES:
                return paths
            paths = tuple(self.path.setdefault(p, p) for p in paths)
            number = self.names[paths] = len(self.paths)
            self.paths.append(paths)
        return number

    def edge(self, token: int, side: int) -> list[tuple[bytes, float]] | None:
        """What stands at the left (0) or right (1) end of a token while it is merged: (bytes, rank of the merge that takes it).

        None if a part has a higher rank than the whole, which no trained vocabulary has: ranks then do not run upwards.
        """
        known = self.edges[side].get(token)
        if known is None:
            known = [(self.token[token], float("inf"))]
            data = self.token[token]
            if len(data) > 1:
                halves = merged(data, self.ranks, down_to=2)
                inner = self.edge(halves[-side], side)
                if max(halves) > token or inner is None:
                    return None
                known += [(inner[0][0], token), *inner[1:]]
            self.edges[side][token] = known
        return known

    def together(self, a: int, b: int) -> bool:
        """Whether b can follow a: merging the bytes of both gives both again.

        Merges run upwards in rank, so something is merged across the border only if the tokens that stand there make one of
        a lower rank than the merges that take them away; of equal ranks the left place comes first.
        """
        known = self.pairs.get((a, b))
        if known is None:
            left, right = self.edge(a, 1), self.edge(b, 0)
            if left is None or right is None:
                known = merged(self.token[a] + self.token[b], self.ranks) == [a, b]
            else:
                known = True
                for x, taken in left:
                    for y, taken_right in right:
                        rank = self.ranks.get(x + y)
                        if rank is not None and rank < taken and rank <= taken_right:
                            known = False
            if len(self.pairs) < PAIRS:
                self.pairs[a, b] = known
        return known

    def worked_out(self, paths: tuple, byte: int) -> tuple[int | tuple, tuple[int, ...]]:
        after, closed, all_wait = [], None, True
        child, closes, inner, pairs = self.child.get, self.closes, self.inner, self.pairs.get
        for path in paths:
            node, last, waiting = path
            node = child(node << 8 | byte)
            if node is None:
                continue
            if node in inner:
                after.append((node, last, waiting))
                all_wait = all_wait and waiting
            if closed is None:
                token = closes[node]
                if token >= 0 and (last < 0 or (pairs((last, token)) or self.together(last, token))):
                    closed = (0, token, (*waiting, token))
        after.append(closed)
        if not all_wait:
            return self.state(tuple(after)), ()
        settled = commonprefix([waiting for _, _, waiting in after])
        n = len(settled)
        return self.state(tuple((node, last, waiting[n:]) for node, last, waiting in after) if n else tuple(after)), tuple(settled)

    def move(self, state: int | tuple, byte: int) -> tuple[int | tuple, tuple[int, ...]]:
        """(next state, tokens emitted); the move is kept if both of its states are."""
        after, emitted = self.worked_out(state if isinstance(state, tuple) else self.paths[state], byte)
        if isinstance(state, int) and isinstance(after, int):
            number = self.emitted_number.setdefault(emitted, len(self.emitted))
            if number == len(self.emitted):
                self.emitted.append(emitted)
            self.moves[state << 8 | byte] = after | number << 32
        return after, emitted

    def close(self, state: int | tuple) -> tuple[int, ...]:
        """Tokens still held back when the pre-token ends."""
        return (state if isinstance(state, tuple) else self.paths[state])[-1][2]

    def walk(self, state: int | tuple, piece: bytes, out: list[int]) -> int | tuple:
        """State behind ``piece``; what is emitted on the way is added to ``out``."""
        known, emitted = self.moves.get, self.emitted
        for byte in piece:
            found = known(state << 8 | byte) if type(state) is int else None
            if found is None:
                state, more = self.move(state, byte)
                out += more
            else:
                state = found & 0xFFFFFFFF
                if found > 0xFFFFFFFF:
                    out += emitted[found >> 32]
        return state

    def encode(self, piece: bytes) -> list[int]:
        if piece in self.alone:
            return [self.alone[piece]]
        head = self.heads.get(piece[:HEAD])
        if head is None:
            out: list[int] = []
            state = self.walk(self.start, piece[:HEAD], out)
            if len(self.heads) < HEADS:
                self.heads[piece[:HEAD]] = state, tuple(out)
        else:
            state, out = head[0], list(head[1])
        state = self.walk(state, piece[HEAD:], out)
        out += self.close(state)
        return out


class Pieces(dict):
    """Pre-token → its ids as bytes; one that is missed is encoded, and kept while there is room."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.encode = transducer.encode
        self.kind = "H" if max(transducer.token) < 1 << 16 else "I"  # unsigned, of 16 or 32 bits

    def __missing__(self, piece: str) -> bytes:
        ids = array(self.kind, self.encode(piece.encode())).tobytes()
        if len(self) < PIECES:
            self[piece] = ids
        return ids


def settled_pattern(pattern: str) -> re.Pattern | None:
    """PATTERN for texts of known characters, its classes written out for the faster standard module."""
    if pattern != PATTERN:
        return None
    known = regex.findall(f"[{KNOWN_RANGES}]", "".join(map(chr, range(0x3000))))
    letters, digits, spaces = ("".join(map(re.escape, filter(regex.compile(p).fullmatch, known))) for p, _ in CLASSES)
    signs = f"[^{spaces}{letters}{digits}]"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{digits}]+| ?{signs}+|[{spaces}]+(?![^{spaces}])|[{spaces}]+")


class StandIns(dict):
    """Code point → what stands for it while a text is split; the class is asked of the tokenizer's own engine."""

    def __init__(self):
        super().__init__()
        import tiktoken

        ranks = {bytes([i]): i for i in range(256)}
        self.engines = [(tiktoken.Encoding("class", pat_str=p, mergeable_ranks=ranks, special_tokens={}), c) for p, c in CLASSES]

    def __missing__(self, point: int) -> str:
        letter = chr(point)
        if KNOWN.fullmatch(letter):
            self[point] = letter
        else:
            self[point] = next((c for engine, c in self.engines if engine.encode_ordinary(letter)), OTHER)
        return self[point]


class Encoder:
    """Ids of whole texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, unmade: Collection[int] | None = None):
        self.pieces = Pieces(Transducer(ranks, unmade))
        self.cut = regex.compile(pattern)
        self.settled = settled_pattern(pattern) or self.cut
        self.stand_ins = StandIns()

    def split(self, text: str) -> list[str]:
        if KNOWN.fullmatch(text):
            return self.settled.findall(text)
        return [text[m.start() : m.end()] for m in self.cut.finditer(text.translate(self.stand_ins))]

    def encode(self, text: str) -> np.ndarray:
        ids = b"".join(map(self.pieces.__getitem__, self.split(text)))
        return np.frombuffer(ids, self.pieces.kind).astype(np.int32)


# Ranges of the next byte after each kind of lead byte (Unicode, table 3-7), with the bytes still to come after it. Fixed values.
LEADS = {
    **{b: ((0x80, 0xBF), 0) for b in range(0xC2, 0xE0)},
    **{b: ((0x80, 0xBF), 1) for b in range(0xE1, 0xF0)},
    0xE0: ((0xA0, 0xBF), 1),
    0xED: ((0x80, 0x9F), 1),
    **{b: ((0x80, 0xBF), 2) for b in range(0xF1, 0xF4)},
    0xF0: ((0x90, 0xBF), 2),
    0xF4: ((0x80, 0x8F), 2),
}
WHOLE = ((0, 0), -1)  # between two characters


def utf8_move(state: tuple, byte: int) -> tuple | None:
    """Next state of the UTF-8 machine; None if the byte cannot stand here."""
    (low, high), left = state
    if left < 0:
        return WHOLE if byte < 0x80 else LEADS.get(byte)
    if not low <= byte <= high:
        return None
    return ((0x80, 0xBF), left - 1) if left else WHOLE


def token_kinds(token: dict[int, bytes]) -> np.ndarray:
    """By id: 1 for tokens of whole characters, 2 for the others."""
    kinds = np.zeros(max(token) + 1, np.uint8)
    for number, data in token.items():
        try:
            data.decode()
            kinds[number] = 1
        except UnicodeDecodeError:
            kinds[number] = 2
    return kinds


class Decoder:
    """Text of ids that come in chunks. A chunk gives all characters that are whole by then."""

    def __init__(self, token: dict[int, bytes], steps: dict | None = None, kinds: np.ndarray | None = None):
        self.token = token
        self.steps = {} if steps is None else steps  # (state, id) → (state, bytes behind the last whole character)
        self.kinds = token_kinds(token) if kinds is None else kinds
        self.state, self.kept = WHOLE, b""

    def step(self, state: tuple, token: int) -> tuple[tuple | None, int | None]:
        """State after a token, and how many of its bytes are not part of a whole character (None: all of them)."""
        found = self.steps.get((state, token))
        if found is None:
            after, behind, data = state, None, self.token[token]
            for i, byte in enumerate(data, 1):
                after = utf8_move(after, byte)
                if after is None:
                    break
                if after is WHOLE:
                    behind = len(data) - i
            found = self.steps[state, token] = (after, behind)
        return found

    def feed(self, ids: np.ndarray) -> str:
        # Tokens of whole characters leave the machine where it is; only the others have to be walked through.
        kinds, data = self.kinds, self.kept + b"".join(map(self.token.__getitem__, ids.tolist()))
        state, open_bytes, at = self.state, len(self.kept), 0
        stops = iter([*np.flatnonzero(kinds[ids] == 2).tolist(), len(ids)])
        while True:
            if state is WHOLE:
                at, open_bytes = max(at, next((k for k in stops if k >= at), len(ids))), 0
            if at >= len(ids):
                break
            token = int(ids[at])
            state, behind = self.step(state, token)
            if state is None:
                return self._repair(data)
            open_bytes = open_bytes + len(self.token[token]) if behind is None else behind
            at += 1
        self.state, self.kept = state, data[len(data) - open_bytes :]
        return data[: len(data) - open_bytes].decode()

    def _repair(self, data: bytes) -> str:
        """The chunk byte by byte; each longest start of a character that goes no further is one U+FFFD."""
        out, begin, state = [], 0, WHOLE
        for i, byte in enumerate(data):
            after = utf8_move(state, byte)
            if after is None and state is not WHOLE:
                out.append("�")
                begin, after = i, utf8_move(WHOLE, byte)
            if after is None:
                out.append("�")
                begin, after = i + 1, WHOLE
            elif after is WHOLE:
                out.append(data[begin : i + 1].decode())
                begin = i + 1
            state = after
        self.state, self.kept = state, data[begin:]
        return "".join(out)

    def close(self) -> str:
        """What a text that ends inside a character leaves."""
        rest, self.state, self.kept = self.kept, WHOLE, b""
        return "�" if rest else ""


def slices(size: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows of about ``most`` units each, one row at least."""
    part = np.cumsum(size) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(size)]
    return ((a, b) for a, b in zip(cuts, cuts[1:]) if b > a)


_encoders: dict[tuple, Encoder] = {}
_tokens: dict[str, tuple[dict[int, bytes], dict, np.ndarray]] = {}


def kept_columns(rows: DataFrame, *gone: str) -> tuple[list[str], str]:
    rest = [c for c in rows.columns if c.lower() not in gone]
    return rest, "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.select(*rest).schema.fields)


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Every row with ``ids`` in place of ``text``. ``ranks`` is the path of a rank file, ``pattern`` splits texts."""
    rest, schema = kept_columns(docs, "text", "ids")
    unmade = unmade_tokens(read_ranks(ranks))  # proven once, here; few if any

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (ranks, pattern) not in _encoders:
            _encoders[ranks, pattern] = Encoder(read_ranks(ranks), pattern, unmade)
        coder = _encoders[ranks, pattern].encode
        for batch in batches:
            for part in parts(batch):
                texts = part["text"].cast(pa.binary()).fill_null(b"").to_pylist()
                ids = [coder(t.decode("utf-8", "replace")) for t in texts]
                offsets = pa.array(np.cumsum([0, *map(len, ids)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([*[part[c] for c in rest], lists], names=[*rest, "ids"])

    return in_arrow(docs.select(*rest, "text"), encoded, f"{schema}ids array<int>")


def decode(rows: DataFrame, ranks: str) -> DataFrame:
    """Every row with ``text`` in place of ``ids``."""
    rest, schema = kept_columns(rows, "text", "ids")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if ranks not in _tokens:
            token = {rank: token for token, rank in read_ranks(ranks).items()}
            _tokens[ranks] = (token, {}, token_kinds(token))
        token, steps, kinds = _tokens[ranks]
        for batch in batches:
            size = pc.list_value_length(batch["ids"]).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in slices(size, PART_BYTES // 4):
                part = batch.slice(a, b - a)
                ids = part["ids"].flatten().to_numpy(zero_copy_only=False)
                ends = np.cumsum(size[a:b]).tolist()
                odd = set((np.searchsorted(ends, np.flatnonzero(kinds[ids] == 2), "right")).tolist())
                pieces, texts, begin = list(map(token.__getitem__, ids.tolist())), [], 0
                for row, end in enumerate(ends):
                    if row in odd:
                        stream = Decoder(token, steps, kinds)
                        text = "".join([stream.feed(ids[i : min(end, i + CHUNK)]) for i in range(begin, end, CHUNK)])
                        texts.append((text + stream.close()).encode())
                    else:  # the machine would not leave its first state
                        texts.append(b"".join(pieces[begin:end]))
                    begin = end
                column = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*[part[c] for c in rest], column], names=[*rest, "text"])

    return in_arrow(rows.select(*rest, "ids"), decoded, f"{schema}text string")
