"""Quality classifier: a sparse rule ensemble over text statistics, compiled into Spark column expressions.

Statistics are column expressions. On a bounded sample of labelled rows (SAMPLE_DOCS per class, smallest id hashes; a dozen
numbers each) numpy grows small boosted trees; every path from a root to a node is one conjunctive rule. A logistic model with
an L1 penalty weighs the rules, the penalty is the one that does best on a held-back fifth, and rules of weight zero go. The
score of a document is a column expression: the logistic function of the constant and the weights of the rules it meets.

Defined cases: null and empty texts have zero in every statistic and a score like any other. Rows without label or doc_id
are not learned from. With only one class to learn from the score is that class's share, with none 0.5. Rows are judged one by
one; equal rows get equal scores. Other columns pass through, except those named like a result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from folioforge.llm.common import SPACES, let, without, words
from folioforge.llm.language import sample_ids
from folioforge.session import broadcast_if_small

SAMPLE_DOCS, TREES, DEPTH, LEAF, SHRINK, BINS, SEED = 10_000, 24, 3, 20, 0.3, 32, 11
PENALTIES = (0.03, 0.01, 0.003, 0.001)

Condition = tuple[int, bool, float]  # statistic, whether it must be above, bound


def statistics(text: Column) -> dict[str, Column]:
    """Numbers that describe a text; zero where they have no meaning."""
    text = F.coalesce(text, F.lit(""))
    left = lambda pattern: F.char_length(F.regexp_replace(text, pattern, ""))  # noqa: E731  characters that stay
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    counts = let(
        words(text),
        lambda w: F.struct(
            F.size(w).alias("words"), F.size(F.array_distinct(w)).alias("unlike")
        ),
    )
    rows = let(lines, lambda x: F.struct(F.size(x).alias("lines"), F.size(F.array_distinct(x)).alias("unlike")))
    return {
        "counts": counts,
        "rows": rows,
        "chars": F.char_length(text),
        "seen": left("[\\x20\\x09-\\x0D]+"),
        "symbols": left("[^#*$%&|<>]+"),
        "upper": left("\\P{Lu}+"),
        "letters": left("\\P{L}+"),
        "digits": left("[^0-9]+"),
        "marks": left("[^.,;:!?]+"),
        "shouts": left("[^!]+"),
    }


# Features over the columns that ``statistics`` names: (numerator, denominator or nothing).
FEATURES = {
    "n_words": ("counts.words", None),
    "word_length": ("seen", "counts.words"),
    "unlike_words": ("counts.unlike", "counts.words"),
    "n_lines": ("rows.lines", None),
    "line_words": ("counts.words", "rows.lines"),
    "unlike_lines": ("rows.unlike", "rows.lines"),
    "symbols": ("symbols", "seen"),
    "upper": ("upper", "letters"),
    "letters": ("letters", "seen"),
    "digits": ("digits", "seen"),
    "marks": ("marks", "counts.words"),
    "shouts": ("shouts", "counts.words"),
}
NAMES = list(FEATURES)


def ratio(top: str, bottom: str | None) -> Column:
    if bottom is None:
        return F.col(top).cast("double")
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(0.0)


def with_features(docs: DataFrame) -> DataFrame:
    """Add one struct ``features`` of doubles."""
    stats = F.struct(*[v.alias(k) for k, v in statistics(F.col("text")).items()]).alias("__s")
    kept = without(docs, "features")
    inner = kept.select(F.struct(*kept.columns).alias("__row"), stats).select("__row", "__s.*")
    values = F.struct(*[ratio(*v).alias(k) for k, v in FEATURES.items()])
    return inner.select("__row.*", values.alias("features"))


@dataclass
class RuleModel:
    constant: float
    rules: list[tuple[list[Condition], float]] = field(default_factory=list)

    def column(self, features: str = "features") -> Column:
        """The score as one column expression."""
        total = F.lit(self.constant)
        for conditions, weight in self.rules:
            met = F.lit(True)
            for number, above, bound in conditions:
                value = F.col(f"{features}.{NAMES[number]}")
                met = met & (value > bound if above else value <= bound)
            total = total + F.when(met, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.constant + sum((meets(x, c) * w for c, w in self.rules), np.zeros(len(x))))))


def meets(x: np.ndarray, conditions: list[Condition]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for number, above, bound in conditions:
        out &= x[:, number] > bound if above else x[:, number] <= bound
    return out


def grow(x: np.ndarray, residual: np.ndarray, hessian: np.ndarray, rows: np.ndarray, cuts: list[np.ndarray], depth: int, path: list[Condition]) -> list[tuple[list[Condition], float]]:
    """(path, step) of every node below the root of one regression tree; leaves carry a step, inner nodes none."""
    g, h = residual[rows].sum(), hessian[rows].sum()
    best = (1e-6, None, None)
    for number, bounds in enumerate(cuts if depth else []):
        if not len(bounds):
            continue
        place = np.searchsorted(bounds, x[rows, number], side="left")  # values up to bounds[i] lie left of cut i
        n = np.cumsum(np.bincount(place, minlength=len(bounds) + 1))[:-1]
        gl = np.cumsum(np.bincount(place, residual[rows], len(bounds) + 1))[:-1]
        hl = np.cumsum(np.bincount(place, hessian[rows], len(bounds) + 1))[:-1]
        gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
        gain[(n < LEAF) | (len(rows) - n < LEAF)] = 0
        i = int(gain.argmax())
        if gain[i] > best[0]:
            best = (gain[i], number, float(bounds[i]))
    if best[1] is None:
        return [(path, float(g / (h + 1)))] if path else []
    _, number, bound = best
    left = x[rows, number] <= bound
    out: list = [(path, 0.0)] if path else []
    for above, part in ((False, rows[left]), (True, rows[~left])):
        out += grow(x, residual, hessian, part, cuts, depth - 1, [*path, (number, above, bound)])
    return out


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on standardised columns, by accelerated proximal steps."""
    mean, spread = z.mean(axis=0), np.maximum(z.std(axis=0), 0.05)
    s = (z - mean) / spread
    step = 4 / (np.linalg.norm(s, 2) ** 2 / len(y) + 1)
    w = v = np.zeros(z.shape[1])
    b = u = 0.0
    t = 1.0
    for _ in range(rounds):
        wrong = 1 / (1 + np.exp(-np.clip(s @ v + u, -40, 40))) - y
        moved = v - step * (s.T @ wrong) / len(y)
        new_w, new_b = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0), u - step * wrong.mean()
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, u = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return float(b - (w / spread) @ mean), w / spread


def train(x: np.ndarray, y: np.ndarray) -> RuleModel:
    """Fit on the rows of ``x`` (features in order) with labels 0 or 1."""
    if not len(y):
        return RuleModel(0.0)
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 0.5) / (len(y) + 1)
        return RuleModel(float(np.log(share / (1 - share))))
    rng = np.random.default_rng(SEED)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    paths: dict[tuple, list[Condition]] = {}
    raw = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        rows = rng.permutation(len(y))[: max(2 * LEAF, len(y) // 2)]
        for path, step in grow(x, y - p, p * (1 - p), rows, cuts, DEPTH, []):
            paths.setdefault(tuple(path), path)
            raw = raw + SHRINK * step * meets(x, path)
    rules = list(paths.values())
    if not rules:
        return RuleModel(float(raw[0]))
    z = np.stack([meets(x, r) for r in rules], axis=1).astype(float)
    test = np.arange(len(y)) % 5 == 4
    best = None
    for penalty in PENALTIES:
        b, w = lasso(z[~test], y[~test], penalty)
        raw = np.clip(z[test] @ w + b, -40, 40)
        loss = float(np.mean(np.log1p(np.exp(-raw)) + (1 - y[test]) * raw)) if test.any() else 0.0
        if best is None or loss < best[0] - 1e-4:
            best = (loss, penalty)
    b, w = lasso(z, y, best[1])
    return RuleModel(b, [(r, float(c)) for r, c in zip(rules, w) if abs(c) > 1e-6])


def fit(featured: DataFrame, labels: DataFrame, per_class: int = SAMPLE_DOCS) -> RuleModel:
    """``featured`` (doc_id, features), ``labels`` (doc_id, quality): rows to learn from."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("quality IN (0, 1) AND doc_id IS NOT NULL")
    ids = broadcast_if_small(sample_ids(known.distinct(), "quality", per_class))
    rows = featured.select("doc_id", "features.*").join(ids, "doc_id").orderBy("doc_id", *NAMES, "quality").toArrow()
    x = np.stack([rows[n].to_numpy() for n in NAMES], axis=1) if rows.num_rows else np.zeros((0, len(NAMES)))
    return train(x, rows["quality"].to_numpy().astype(float))
