"""Product codes of vectors, with memoised grid cells in place of a comparison with every codebook entry.

A vector of integers is cut into PARTS equal parts, and each part is coded by the nearest of the entries of its position's
codebook (squared Euclidean distance, ties to the lower index). Codebooks start with the vectors of smallest id and are
moved ROUNDS times to the floored means of what they were given.

Inside a task the part's coarse cell (its components without their low bits) is looked up in a table. A cell seen for the
first time gets the entries that are not dominated across its box: those whose smallest distance to the box does not exceed
the least of all largest distances. Any other entry is farther from every point of the box than the entry of that least
largest distance, so leaving it out changes nothing, ties included. Only the entries of the cell are evaluated exactly. The
table of a worker holds CELLS cells; others are worked out again when they turn up.

A round is one pass: each task sends one sum and one count per entry and component, Spark adds them up, and the driver gets
PARTS * ENTRIES entries however many vectors there are. Totals per label are joined back salted, so a label that most rows
carry is spread over tasks.

Defined cases: rows whose vector is null, empty, holds null or non-finite components or has another length than the usable
vector of smallest id are left out, as are lengths that PARTS does not divide. Components beyond +-BOUND / SCALE count as that
bound, which keeps distances inside 64 bits. Rows without vec_id come last among the first entries; rows that share an id are
ordered by their vectors. With fewer than ENTRIES rows the codebooks are shorter. A sum per label beyond 64 bits is null. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from folioforge.llm.common import in_arrow, staged
from folioforge.session import broadcast_if_small

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE, BOUND = 256, 1 << 24
CELLS = 100_000  # cells that a worker remembers
CELLS_ACROSS = 4  # cells between the least and the largest component of a codebook, about
BLOCK = 1 << 20  # numbers worked on at once when cells are made
SALTS = 16


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id, label and the integer vector of every usable row, whatever its length."""

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["embedding"]
            size = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(size)), size)
            x = lists.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            bad = np.bincount(row[~np.isfinite(x)], minlength=len(size)) > 0
            keep = (size > 0) & (size % PARTS == 0) & ~bad
            whole = np.clip(np.floor(SCALE * x[keep[row]]), -BOUND, BOUND).astype(np.int32)
            offsets = np.concatenate([[0], np.cumsum(size[keep])]).astype(np.int32)
            out = batch.select(["vec_id", "label"]).filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(whole))], names=["vec_id", "label", "vector"]
            )

    rows = vectors.select("vec_id", "label", "embedding")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return in_arrow(rows, scaled, f"vec_id {kinds['vec_id']}, label {kinds['label']}, vector array<int>")


def matrices(batch: pa.RecordBatch) -> np.ndarray:
    """Vectors of a batch as (rows, PARTS, components of a part)."""
    flat = batch["vector"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(batch.num_rows, PARTS, -1)


class Cells:
    """Nearest entries of one state of the codebooks, with the cells met so far."""

    def __init__(self, books: np.ndarray):
        self.books = books  # (PARTS, entries, components)
        spread = (books.max(axis=1) - books.min(axis=1)).max(axis=1)
        self.shift = [max(0, int(s) // CELLS_ACROSS).bit_length() for s in spread]
        self.known: list[dict[bytes, np.ndarray]] = [{} for _ in range(len(books))]
        self.room = CELLS

    def candidates(self, part: int, cells: np.ndarray) -> list[np.ndarray]:
        """Entries that are not dominated across each cell's box, in ascending order."""
        book, shift = self.books[part], self.shift[part]
        out, step = [], max(1, BLOCK // book.size)
        for i in range(0, len(cells), step):
            low = (cells[i : i + step] << shift)[:, None, :]
            high = low + ((1 << shift) - 1)
            near = np.maximum(np.maximum(low - book, book - high), 0)
            far = np.maximum(np.abs(book - low), np.abs(book - high))
            least, most = (near * near).sum(axis=2), (far * far).sum(axis=2)
            out += [np.flatnonzero(k) for k in least <= most.min(axis=1)[:, None]]
        return out

    def nearest(self, part: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(entry, squared distance) of each row of ``x``, and the number of exact evaluations."""
        cells = np.ascontiguousarray(x >> self.shift[part])
        names = cells.view(np.dtype((np.void, cells.itemsize * cells.shape[1])))[:, 0]
        names, first, which = np.unique(names, return_index=True, return_inverse=True)
        known, names = self.known[part], [n.tobytes() for n in names]
        new = [i for i, n in enumerate(names) if n not in known]
        made = dict(zip([names[i] for i in new], self.candidates(part, cells[first[new]])))
        lists = [known[n] if n in known else made[n] for n in names]
        for n in list(made)[: self.room]:
            known[n] = made[n]
            self.room -= 1
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        start, flat = np.cumsum(size) - size, np.concatenate(lists)
        many = size[which]
        begin = np.cumsum(many) - many
        row = np.repeat(np.arange(len(x)), many)
        entry = flat[np.arange(len(row)) - begin[row] + start[which][row]]
        gap = x[row] - self.books[part][entry]
        distance = np.einsum("ij,ij->i", gap, gap)
        best = np.minimum.reduceat(distance, begin)
        hit = np.flatnonzero(distance == best[row])
        _, lowest = np.unique(row[hit], return_index=True)  # entries ascend within a row
        return entry[hit[lowest]], best, len(row)


_cells: dict[bytes, Cells] = {}


def cells_of(books: np.ndarray) -> Cells:
    """The cells of these codebooks in this worker; those of earlier codebooks are forgotten."""
    name = hashlib.sha256(books.tobytes()).digest()
    if name not in _cells:
        _cells.clear()
        _cells[name] = Cells(books)
    return _cells[name]


def first_books(rows: DataFrame) -> np.ndarray | None:
    """Parts of the vectors of smallest id; None without rows."""
    ordered = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector")
    usable = ordered.limit(1).select(F.size("vector").alias("n")).first()
    if usable is None:
        return None
    first = ordered.filter(F.size("vector") == usable["n"]).limit(ENTRIES).select("vector").collect()
    books = np.array([r["vector"] for r in first], np.int64).reshape(len(first), PARTS, -1)
    return np.ascontiguousarray(books.transpose(1, 0, 2))


def moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round: floored means of the parts each entry is nearest to; unused entries stay."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        cells = cells_of(books)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrices(batch)
            for part in range(PARTS):
                entry, _, _ = cells.nearest(part, x[:, part])
                count[part] += np.bincount(entry, minlength=books.shape[1])
                np.add.at(total[part], entry, x[:, part])
        used = np.flatnonzero(count)
        values = np.concatenate([count.reshape(-1, 1), total.reshape(-1, books.shape[2])], axis=1)[used]
        place = np.tile(np.arange(values.shape[1], dtype=np.int32), len(used))
        arrays = [np.repeat(used, values.shape[1]).astype(np.int32), place, values.ravel()]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, arrays)), names=["slot", "place", "value"])

    added = in_arrow(rows.select("vector"), sums, "slot int, place int, value long")
    added = added.groupBy("slot", "place").agg(F.sum("value").alias("value")).collect()  # bounded by the codebooks' size
    values = np.zeros((books.shape[0] * books.shape[1], books.shape[2] + 1), np.int64)
    for r in added:
        values[r["slot"], r["place"]] = r["value"]
    count, total = values[:, :1], values[:, 1:]
    means = np.where(count > 0, total // np.maximum(count, 1), books.reshape(total.shape))
    return means.reshape(books.shape)


def fit(rows: DataFrame, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (PARTS, entries, components) of the integer vectors ``rows``; None without rows."""
    books = first_books(rows)
    if books is None:
        return None
    rows = rows.filter(F.size("vector") == PARTS * books.shape[2])
    for _ in range(rounds):
        books = moved(rows, books)
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (two hex digits per part) and error of the rows that have the codebooks' length."""
    digits = np.array([b"%02x" % i for i in range(256)], "S2")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = cells_of(books)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrices(batch)
            entry, error = np.zeros(x.shape[:2], np.int64), np.zeros(len(x), np.int64)
            for part in range(PARTS):
                entry[:, part], distance, _ = cells.nearest(part, x[:, part])
                error += distance
            code = np.ascontiguousarray(digits[entry]).view(f"S{2 * PARTS}")[:, 0].astype(str)
            columns = [batch["vec_id"], batch["label"], pa.array(code, pa.string()), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    return in_arrow(rows.filter(F.size("vector") == PARTS * books.shape[2]), coded, schema)


def decode(code: str, books: np.ndarray) -> np.ndarray:
    """The vector that a code stands for, in the units of the input."""
    entry = [int(code[2 * i : 2 * i + 2], 16) for i in range(PARTS)]
    return np.concatenate([books[i, e] for i, e in enumerate(entry)]) / SCALE


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components as decimals, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` with the sum of ``error`` over the rows of the same label; missing labels are one label."""
    totals = rows.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("place")
    totals = broadcast_if_small(totals.select("of", "label_error", salts))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    same = F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("place"))
    return salted.join(totals, same).drop("salt", "of", "place")


def vector_codes(vectors: DataFrame) -> DataFrame:
    """Codes of ``vectors`` (vec_id, embedding, label): vec_id, code, error, label_error and the digest of the codebooks."""
    rows = staged(integers(vectors), "vectors")
    books = fit(rows)
    if books is None:
        empty = rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty.select("*", F.col("error").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = with_label_error(staged(encode(rows, books), "codes"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
