"""Text cleaning and text features."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ASCII white space removed by trimming.
WHITESPACE = " \t\n\r\f\x0b"


def trimmed(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def clean_text(col: Column, max_len: int | None = None) -> Column:
    """Trim, turn blank into null, cut to ``max_len`` code points."""
    text = F.nullif(trimmed(col.cast("string")), F.lit(""))
    return text if max_len is None else F.substring(text, 1, max_len)


def title_case(col: Column) -> Column:
    """Capital after every non-letter (``o'neil`` becomes ``O'Neil``), lower case elsewhere."""
    runs = F.regexp_extract_all(F.lower(col), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def first_item(col: Column, is_array: bool) -> Column:
    """First element of a list column as text; a scalar passes through; empty list gives null."""
    return (F.get(col, F.lit(0)) if is_array else col).cast("string")


def title_length(col: Column) -> Column:
    return F.coalesce(F.char_length(col), F.lit(0))


def word_count(col: Column) -> Column:
    words = F.filter(F.split(col, r"(?U)\s+"), lambda w: w != "")
    return F.when(col.isNull(), 0).otherwise(F.size(words))


def chars_per_word(length: Column, words: Column) -> Column:
    """Characters per word; 0 when there are no words."""
    return F.coalesce(F.try_divide(length, words), F.lit(0.0))


def has_subtitle(col: Column) -> Column:
    """1 when the title carries a subtitle mark (``:`` or ``-``)."""
    return F.coalesce(col.rlike("[:-]"), F.lit(False)).cast("int")


def equals_ignore_case(col: Column, value: str) -> Column:
    return F.coalesce(F.lower(col) == value.lower(), F.lit(False)).cast("int")


def ellipsis(col: Column, keep: int, limit: int) -> Column:
    """Display text: at most ``limit`` characters, longer text is cut to ``keep`` plus dots."""
    return F.when(F.char_length(col) > limit, F.concat(F.substring(col, 1, keep), F.lit("..."))).otherwise(col)


def display_label(col: Column) -> Column:
    """``Sci-Fi`` becomes ``Sci Fi`` and ``CamelCase`` becomes ``Camel Case``."""
    return F.regexp_replace(F.regexp_replace(col, "-", " "), "([a-z])([A-Z])", "$1 $2")


def digits_between(col: Column, low: int, high: int) -> Column:
    """True when the text is only digits and ``low`` to ``high`` of them; null is false."""
    count = f"{{{low}}}" if low == high else f"{{{low},{high}}}"
    return F.coalesce(col.rlike(f"^[0-9]{count}$"), F.lit(False))


def key_prefix(col: Column, length: int = 8) -> Column:
    return F.substring(col.cast("string"), 1, length)


def parent_category(col: Column, sep: str = "-") -> Column:
    return F.split_part(col, F.lit(sep), F.lit(1))


def swap_path_prefix(col: Column, old: str = "dataset/", new: str = "book-covers/") -> Column:
    """Every occurrence of the folder name is replaced; null stays null."""
    return F.replace(col, F.lit(old), F.lit(new))


def path_parts(col: Column) -> tuple[Column, Column]:
    """(folder, file), the last two parts of a path below a root; null when it has fewer than three parts."""
    parts = F.split(F.replace(col, F.lit("\\"), F.lit("/")), "/")
    deep = F.size(parts) >= 3
    return F.when(deep, F.element_at(parts, -2)), F.when(deep, F.element_at(parts, -1))


def cover_url(folder: Column, file: Column) -> Column:
    return F.concat(F.lit("/covers/"), folder, F.lit("/"), file)
