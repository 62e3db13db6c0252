"""Quality classifier (operator 5): a sparse rule ensemble over text statistics.

Shallow trees are boosted on the statistics of a bounded labelled sample, weighed so that the
classes count as in all labelled rows; every path from a root
to a node is a conjunctive rule; a logistic regression with a lasso penalty gives most rules
weight 0; the others are compiled into one Spark column, so scoring runs without Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .linear import class_weights, labelled_texts, sampled_labels
from .quality_rules import STOP_WORDS

SAMPLE = 6000
TREES = 24
DEPTH = 3
CUTS = 32
LASSO = 2e-4
#: A rule must hold for at least this share of the weighed sample.
MIN_SUPPORT = 0.002

# Statistics of a text as SQL over its arrays of words and lines.
COUNTS = {
    "n": "size(words)",
    "chars": "char_length(array_join(words, ''))",
    "symbols": "regexp_count(text, '[#*$%&|<>{}~^]')",
    "upper": r"regexp_count(text, '\\p{Lu}')",
    "digits": "regexp_count(text, '[0-9]')",
    "marks": "regexp_count(text, '[!?]')",
    "distinct": "size(array_distinct(words))",
    "twice": "size(filter(words, (w, i) -> i > 0 AND w = words[i - 1]))",
    "bare": r"size(filter(words, w -> NOT w rlike '[\\p{L}\\p{N}]'))",
    "stop": "size(filter(words, w -> lower(rtrim('.,;:!?', w)) IN ({stop})))",
    "lines": "size(lines)",
    "distinct_lines": "size(array_distinct(lines))",
}
FEATURES = {
    "words": "cast(n AS double)",
    "mean_length": "chars / greatest(n, 1)",
    "symbol_ratio": "symbols / greatest(n, 1)",
    "upper_ratio": "upper / greatest(chars, 1)",
    "digit_ratio": "digits / greatest(chars, 1)",
    "mark_ratio": "marks / greatest(n, 1)",
    "distinct_ratio": "distinct / greatest(n, 1)",
    "twice_ratio": "twice / greatest(n, 1)",
    "bare_ratio": "bare / greatest(n, 1)",
    "stop_ratio": "stop / greatest(n, 1)",
    "line_length": "n / greatest(lines, 1)",
    "repeated_lines": "1 - distinct_lines / greatest(lines, 1)",
}
NAMES = list(FEATURES)
#: A condition is (feature, is it at most the cut, cut); a rule is a set of conditions.
Rule = frozenset


@dataclass
class Model:
    rules: list[Rule]
    weights: list[float]
    bias: float

    def column(self) -> Column:
        """The score, 0 to 1, over the columns of :func:`statistics`."""
        terms = [f"CASE WHEN {' AND '.join(f'{f} {"<=" if low else ">"} {cut!r}D' for f, low, cut in sorted(rule))} THEN {w!r}D ELSE 0D END"
                 for rule, w in zip(self.rules, self.weights)]
        return F.expr(f"1D / (1D + exp(-({' + '.join([f'({self.bias!r}D)', *terms])})))")


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """``doc_id`` and the features of each whole text (NULL counts as empty); ``more`` columns
    are carried along."""
    stop = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words}))
    split = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more).selectExpr(
        "doc_id", *more, "text", r"filter(split(text, '\\s+'), w -> w != '') AS words", r"filter(split(text, '\n'), l -> l rlike '\\S') AS lines")
    counted = split.selectExpr("doc_id", *more, *[f"{sql.replace('{stop}', stop)} AS {name}" for name, sql in COUNTS.items()])
    return counted.selectExpr("doc_id", *more, *[f"{sql} AS {name}" for name, sql in FEATURES.items()])


def _boosted_paths(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[Rule]:
    """Rules of all nodes of ``TREES`` boosted trees; ``y`` is 0 or 1, ``weight`` 1 on average."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, CUTS + 1)[:-1])) for j in range(x.shape[1])]
    place = [np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)]  # x <= cut k  <=>  place <= k
    margin, rules = np.zeros(len(y)), {}

    def grow(rows: np.ndarray, rule: Rule, g: np.ndarray, h: np.ndarray, depth: int) -> None:
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best, choice = 1e-3, None
        if depth < DEPTH:
            for j, c in enumerate(cuts):
                left_g = np.cumsum(np.bincount(place[j][rows], g[rows], len(c) + 1))[:-1]
                left_h = np.cumsum(np.bincount(place[j][rows], h[rows], len(c) + 1))[:-1]
                right_h = total_h - left_h
                gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (right_h + 1) - total_g**2 / (total_h + 1)
                gain[(left_h < 1) | (right_h < 1)] = 0
                k = int(np.argmax(gain)) if len(gain) else 0
                if len(gain) and gain[k] > best:
                    best, choice = gain[k], (j, k)
        if rule:
            rules.setdefault(rule, None)
        if choice is None:
            margin[rows] -= 0.3 * total_g / (total_h + 1)
            return
        j, k = choice
        low = place[j][rows] <= k
        for side, part in ((True, rows[low]), (False, rows[~low])):
            grow(part, rule | {(NAMES[j], side, float(cuts[j][k]))}, g, h, depth + 1)

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        grow(np.arange(len(y)), Rule(), weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6), 0)
    return sorted(rules, key=sorted)


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for name, low, cut in rule:
        column = x[:, NAMES.index(name)]
        out &= column <= cut if low else column > cut
    return out


def _lasso(z: np.ndarray, y: np.ndarray, importance: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty, by accelerated proximal gradient steps."""
    z = np.hstack([z, np.ones((len(z), 1))])
    rate = 4.0 / np.linalg.eigvalsh((z * importance[:, None]).T @ z)[-1]
    w = look = np.zeros(z.shape[1])
    t = 1.0
    for _ in range(800):
        p = 1 / (1 + np.exp(-np.clip(z @ look, -30, 30)))
        step = look - rate * (z.T @ ((p - y) * importance))
        new = np.sign(step) * np.maximum(0, np.abs(step) - rate * LASSO)
        new[-1] = step[-1]
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w, look, t = new, new + (t - 1) / after * (new - w), after
    return w[:-1], float(w[-1])


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Model:
    """Model of feature rows ``x`` and labels ``y``, each standing for ``weight`` rows (one, if
    None); of one class alone, or no rows, a constant."""
    if not len(y) or y.min() == y.max():
        return Model([], [], 0.0 if not len(y) else (20.0 if y[0] else -20.0))
    weight = np.ones(len(y)) if weight is None else weight / weight.mean()
    rules = [r for r in _boosted_paths(x, y, weight) if (_holds(r, x) * weight).mean() >= MIN_SUPPORT]
    held: dict[bytes, Rule] = {}
    for rule in rules:  # of rules that hold for the same rows, the shortest
        key = np.packbits(_holds(rule, x)).tobytes()
        if key not in held or len(rule) < len(held[key]):
            held[key] = rule
    rules = list(held.values())
    z = np.stack([_holds(r, x) for r in rules], axis=1).astype(np.float64) if rules else np.zeros((len(y), 0))
    w, bias = _lasso(z, y, weight / len(y))
    chosen = [k for k in range(len(rules)) if w[k]]
    return Model([rules[k] for k in chosen], [float(w[k]) for k in chosen], bias)


def train(docs: DataFrame, labels: DataFrame, keep: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on at most ``SAMPLE`` labelled rows a class whose ``doc_id`` passes ``keep``, weighed to
    the class mix of all of them. NULL texts count as empty; ids without a label or with labels that
    disagree are left out; of rows that repeat an id one is learnt from; other columns are not read."""
    chosen = sampled_labels(labels, "doc_id", label_col, keep, SAMPLE)
    labelled = labelled_texts(docs, chosen, id_col, text_col)
    rows = statistics(labelled, "doc_id", "text", "label").toPandas().sort_values([*NAMES, "label"])
    weights = class_weights(labels, "doc_id", label_col, keep, SAMPLE)
    return fit(rows[NAMES].to_numpy(np.float64), rows["label"].to_numpy(np.float64), weights[rows["label"].to_numpy()])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``(doc_id, score, predicted)`` of each row. NULL and empty texts have the statistics of
    no words and are scored by them; repeated rows each give a row; other columns are not read."""
    scored = statistics(docs, id_col, text_col).select("doc_id", model.column().alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
