"""Values and helpers shared by the tests."""

from folioforge.schemas import RECORD_DOC

DOC_DEFAULTS = {name: None for name in RECORD_DOC.names}


def book(n: int, *gaps: str, **other) -> dict:
    """Document number ``n``; every value follows from the number. ``gaps`` are left out, ``other`` values are set."""
    doc = {
        "key": f"w{n:03d}",
        "title": f"Volume {n}",
        "author_name": [f"Writer {n}", f"Helper {n % 3}"],
        "first_publish_year": 1900 + 3 * n,
        "publisher": [f"Press {n % 4}"] * (1 + n % 2),
        "isbn": [str(9780000000000 + 7 * n), f"alt-{n}"],
        "number_of_pages_median": 37 * n,
        "ratings_average": 2.5 + n % 5 / 2,
        "ratings_count": 10 * n + 1,
        "subject": [f"Field {n % 2}"],
    }
    return {**DOC_DEFAULTS, **{k: v for k, v in doc.items() if k not in gaps}, **other}


def values(df, *columns):
    """Rows as tuples, sorted."""
    rows = [tuple(r[c] for c in (columns or df.columns)) for r in df.collect()]
    return sorted(rows, key=repr)
