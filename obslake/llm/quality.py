"""Quality scores from a sparse ensemble of rules over text statistics.

Small boosted trees are fitted on a bounded sample of labelled rows. Every path from a
root to a node is a rule, a conjunction of comparisons of statistics. A logistic model
with a lasso penalty weighs the rules; those that keep a weight are compiled into one
Spark column over the statistics.

A null text is empty; its statistics are zero, and it gets the score these have. Rows
with a null doc_id are scored and never learned from. Repeated rows are scored alike. An
empty table gives an empty result. Without labelled rows of both classes the score is
the share of class 1, or 0.5 without any. The columns of the documents, whatever their
names, reach the result unchanged in the struct ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import as_bytes, labelled_sample, map_batches, with_fields

#: Labelled rows of each class that the rules are fitted on, at most.
SAMPLE_PER_CLASS = 8000

STATISTICS = (
    "n_bytes", "n_words", "word_bytes", "distinct_words", "repeated_words", "short_words",
    "upper", "lower", "digit", "point", "symbol", "exclaim", "bar", "non_ascii", "line_bytes",
    "distinct_lines", "words_ending_odd", "sentence_ends", "longest_word",
)

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = b"0123456789"
_POINT = b".,;:'\"-()?"
_SYMBOL = b"#$%&*@^~|<>{}[]\\/=+_`"


def text_statistics(text: bytes) -> list[float]:
    """The values of STATISTICS for one text."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    size, n = len(text), len(words)
    distinct = set(words)
    lines = [line for line in text.split(b"\n") if line]
    among = lambda kept: size - len(text.translate(None, kept))
    lengths = list(map(len, words))
    symbol_ends = sum(text.count(bytes([c, 32])) for c in b"#$%&*!|")
    return [
        float(np.log1p(size)),
        float(np.log1p(n)),
        sum(lengths) / n,
        len(distinct) / n**0.75,
        sum(map(eq, words, words[1:])) / n,
        sum(length <= 3 for length in lengths) / n,
        among(_UPPER) / size,
        among(_LOWER) / size,
        among(_DIGIT) / size,
        among(_POINT) / size,
        among(_SYMBOL) / size,
        text.count(b"!") / size,
        text.count(b"|") / size,
        among(bytes(range(128, 256))) / size,
        float(np.log1p(size / len(lines))),
        len(set(lines)) / len(lines),
        symbol_ends / n,
        (text.count(b". ") + text.count(b".\n")) / n,
        float(np.log1p(max(lengths))),
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc, statistics): each row as a struct, and an array in the order of STATISTICS."""
    rows = docs.select(
        F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("doc"),
        F.col("text").cast("string").alias("text"),
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [text_statistics(text) for text in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.list_(pa.float64()))], ["doc", "statistics"]
            )

    schema = with_fields(rows.select("doc").schema, "statistics array<double>")
    return map_batches(rows, measure, schema)


Rule = tuple[tuple[int, bool, float], ...]


@dataclass(frozen=True)
class RuleModel:
    """A logistic sum of weighted rules. A rule holds (statistic, above, threshold) triples."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, statistics: Column) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for at, above, threshold in rule:
                value = statistics[at]
                holds = holds & ((value > threshold) if above else (value <= threshold))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def score_rows(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.intercept)
        for rule, weight in self.rules:
            total += weight * _holds(rule, values)
        return 1 / (1 + np.exp(-total))


def _holds(rule: Rule, values: np.ndarray) -> np.ndarray:
    found = np.ones(len(values), bool)
    for at, above, threshold in rule:
        found &= (values[:, at] > threshold) if above else (values[:, at] <= threshold)
    return found


def _grow(
    values: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray,
    depth: int, path: Rule, rules: list[Rule], update: np.ndarray, rows: np.ndarray,
) -> None:
    """Splits by the largest gain; every node below the root adds its path to ``rules``."""
    g, h = gradient[rows], hessian[rows]
    total_g, total_h = g.sum(), h.sum()
    best, found = 1e-6, None
    if depth and len(rows) >= 20:
        for at, thresholds in enumerate(cuts):
            if not len(thresholds):
                continue
            bins = np.searchsorted(thresholds, values[rows, at], side="left")
            below_g = np.bincount(bins, g, len(thresholds) + 1).cumsum()[:-1]
            below_h = np.bincount(bins, h, len(thresholds) + 1).cumsum()[:-1]
            over_g, over_h = total_g - below_g, total_h - below_h
            gain = (
                below_g**2 / (below_h + 1) + over_g**2 / (over_h + 1) - total_g**2 / (total_h + 1)
            )
            gain[(below_h < 1) | (over_h < 1)] = 0
            if gain.max() > best:
                best, found = gain.max(), (at, float(thresholds[gain.argmax()]))
    if found is None:
        update[rows] = total_g / (total_h + 1)
        return
    at, threshold = found
    above = values[rows, at] > threshold
    for side in (False, True):
        longer = (*path, (at, side, threshold))
        rules.append(longer)
        _grow(
            values, cuts, gradient, hessian, depth - 1, longer, rules, update, rows[above == side]
        )


def fit_rules(
    values: np.ndarray, labels: np.ndarray, weights: np.ndarray,
    trees: int = 30, depth: int = 3, penalty: float = 2e-4, steps: int = 400,
) -> RuleModel:
    """Rules from boosted trees, weighed by lasso logistic regression."""
    share = float((weights * labels).sum() / weights.sum()) if len(labels) else 0.5
    share = min(max(share, 1e-6), 1 - 1e-6)
    prior = float(np.log(share / (1 - share)))
    if not len(labels) or labels.min() == labels.max():
        return RuleModel(prior, ())
    cuts = [np.unique(np.quantile(column, np.linspace(0.02, 0.98, 49))) for column in values.T]
    margin, rules = np.full(len(labels), prior), []
    weights = weights / weights.mean()
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        update = np.zeros(len(labels))
        _grow(
            values, cuts, weights * (labels - p), weights * p * (1 - p), depth, (), rules, update,
            np.arange(len(labels)),
        )
        margin += 0.3 * np.clip(update, -4, 4)
    rules = list(dict.fromkeys(rules))
    fires = np.stack([_holds(rule, values) for rule in rules], axis=1).astype(np.float32)
    spread = np.maximum(fires.std(axis=0), 0.02)
    design = (fires - fires.mean(axis=0)) / spread
    # Accelerated proximal gradient; the largest eigenvalue bounds the curvature.
    n = len(labels)
    gram = design.T @ (design * weights[:, None].astype(np.float32)) / n
    step = 1 / (0.25 * (np.linalg.eigvalsh(gram)[-1] + 1) + 1e-6)
    w, b = np.zeros(len(rules)), prior
    look_w, look_b, t = w, b, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(design @ look_w + look_b)))
        error = weights * (p - labels) / n
        moved = look_w - step * (design.T @ error)
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        new_b = look_b - step * error.sum()
        next_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look_w = new_w + (t - 1) / next_t * (new_w - w)
        look_b = new_b + (t - 1) / next_t * (new_b - b)
        w, b, t = new_w, new_b, next_t
    kept = np.flatnonzero(np.abs(w) > 1e-3)
    scaled = w / spread
    intercept = float(b - (scaled * fires.mean(axis=0))[kept].sum())
    return RuleModel(intercept, tuple((rules[i], float(scaled[i])) for i in kept))


def train_quality(
    docs: DataFrame, labels: DataFrame, modulus: int = 5, per_class: int = SAMPLE_PER_CLASS
) -> RuleModel:
    """A model from labelled rows whose id has a non-zero remainder modulo ``modulus``."""
    sample, class_weights = labelled_sample(docs, labels, "quality", per_class, modulus)
    # At most 2 * per_class rows of a few numbers each, unless ids repeat.
    rows = with_statistics(sample).select("doc.doc_id", "doc.label", "statistics")
    rows = rows.dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id")
    label = rows.column("label").to_numpy().astype(float)
    values = np.array(rows.column("statistics").to_pylist(), float).reshape(-1, len(STATISTICS))
    weight = np.array([class_weights[int(value)] for value in label])
    return fit_rules(values, label, weight)


def score_quality(docs: DataFrame, model: RuleModel) -> DataFrame:
    """(doc, score) for each row; higher means that class 1 is likelier."""
    return with_statistics(docs).select("doc", model.score(F.col("statistics")).alias("score"))
