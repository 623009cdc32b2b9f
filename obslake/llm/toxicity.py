"""Toxicity from maximum-scoring segments of token log-odds.

Tokens get log-odds between toxic and clean training texts, smoothed by a Dirichlet
prior with the pooled token shares. Those that stand out are positive scores, all other
tokens cost a little. One linear scan finds every maximal-scoring segment of a text.
Extreme-value statistics turn a segment's score into the number of segments as good that
a clean text of that length would show; the evidence of the significant ones is summed
and calibrated to a probability on the training sample.

A null text is empty and has no segments. Rows with a null doc_id are scored and never
learned from. Repeated rows are scored alike. An empty table gives an empty result.
Without labelled rows of both classes nothing stands out, and every score is the share
of class 1 (0.5 without labels). Of equally good segments all are kept. The columns of
the documents, whatever their names, reach the result unchanged in the struct ``doc``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import as_bytes, labelled_sample, map_batches, with_fields

#: Labelled rows of each class that the model is fitted on, at most.
SAMPLE_PER_CLASS = 12_000
#: Tokens that stand out, at most: the size of the model.
LEXICON = 20_000
#: Standard deviations from which a token stands out, and the training texts it must be in.
STANDS_OUT, LEAST_TEXTS = 3.0, 3
#: What a token costs that does not stand out, and what one that does may count at most.
COST, MOST = 0.5, 8.0
#: Expected chance segments of a text below which a segment is significant.
SIGNIFICANT = 0.05
#: Bytes of the beginning of a token that stands for unknown tokens of its family.
STEM = 5

_SPACES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def tokens(text: bytes) -> list[bytes]:
    """Words in lower case without ASCII punctuation."""
    return text.translate(_SPACES).lower().split()


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: dict[bytes, float] = field(default_factory=dict)
    decay: float = 1.0  # of the extreme-value law
    scale: float = 1.0
    intercept: float = 0.0
    slope: float = 0.0

    def token_scores(self, words: list[bytes]) -> list[tuple[int, float]]:
        """Positions and scores of the tokens that stand out."""
        known = self.lexicon
        hits = {word: known[word] for word in known.keys() & set(words)} if known else {}
        for word in set(words):
            if word not in hits and len(word) > STEM and (stem := word[:STEM] + b"*") in known:
                hits[word] = known[stem]
        if not hits:
            return []
        return [(i, hits[word]) for i, word in enumerate(words) if word in hits]

    def passages(self, words: list[bytes]) -> list[tuple[int, int, float, float]]:
        """Significant segments: start, end (exclusive), score, log of the chance count."""
        found = []
        for start, end, score in segments(self.token_scores(words)):
            chance = np.log(self.scale * len(words)) - self.decay * score
            if chance < np.log(SIGNIFICANT):
                found.append((start, end, score, float(chance)))
        return found

    def evidence(self, passages: list[tuple[int, int, float, float]]) -> float:
        return float(np.log1p(sum(-chance for _, _, _, chance in passages)))

    def probability(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-(self.intercept + self.slope * evidence))))


def segments(scored: list[tuple[int, float]]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments of a text, given the positions with positive scores.

    Keeps disjoint candidates with the running totals before and after them. A new one
    merges with the nearest earlier candidate that starts lower, if it ends higher than
    that one; each candidate is merged away once, so the scan is linear.
    """
    kept: list[list[float]] = []  # start, end, total before, total after, nearest lower start
    total, at = 0.0, 0
    for position, score in scored:
        total -= COST * (position - at)
        start, end, before, after = position, position + 1, total, total + score
        total, at = after, position + 1
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= before:
                j = int(kept[j][4])
            if j < 0 or kept[j][3] >= after:
                kept.append([start, end, before, after, j])
                break
            start, before = int(kept[j][0]), kept[j][2]
            del kept[j:]
    return [(int(s), int(e), after - before) for s, e, before, after, _ in kept]


def _token_counts(sample: DataFrame) -> DataFrame:
    """Tokens and stems of the sampled texts: texts of each class that hold them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                held = set(tokens(text))
                counts[label].update(held)
                counts[label].update({w[:STEM] + b"*" for w in held if len(w) > STEM})
            if len(counts[0]) + len(counts[1]) > 500_000:
                yield flush(counts)
        yield flush(counts)

    def flush(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
        words = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array(words, pa.binary())] + [
            pa.array([part[word] for word in words], pa.int64()) for part in counts
        ]
        for part in counts:
            part.clear()
        return pa.RecordBatch.from_arrays(columns, ["token", "clean", "toxic"])

    return (
        map_batches(
            sample.select("label", "text"), count, "token binary, clean long, toxic long"
        )
        .groupBy("token")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )


def _stand_out(counts: DataFrame, texts: dict[int, int]) -> dict[bytes, float]:
    """Log-odds of the tokens whose difference between the classes is significant."""
    pooled = sum(texts.values())
    prior = (F.col("clean") + F.col("toxic")) / F.lit(float(pooled))  # one text's worth
    toxic, clean = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(toxic / (F.lit(texts[1] + 1.0) - toxic)) - F.log(
        clean / (F.lit(texts[0] + 1.0) - clean)
    )
    found = (
        counts.where(F.col("toxic") >= LEAST_TEXTS)
        .where(F.col("toxic") <= texts[1])
        .withColumn("odds", odds)
        .withColumn("z", F.col("odds") / F.sqrt(1 / toxic + 1 / clean))
        # A token that no clean text holds has a large variance by its prior alone; the
        # chance that all its texts are toxic settles it.
        .withColumn("alone", -F.col("toxic") * F.log(F.lit(texts[1] / pooled)))
        .where((F.col("z") >= STANDS_OUT) | ((F.col("clean") == 0) & (F.col("alone") >= 9.0)))
        .where("odds > 1")
        .orderBy(F.desc("alone"), "token")
        .limit(LEXICON)
        .collect()
    )
    return {bytes(row["token"]): min(row["odds"], MOST) for row in found}


def _decay(lexicon: dict[bytes, float], rate: float) -> float:
    """The positive root of the mean of exp(decay * score) over clean tokens = 1."""
    mean = sum(lexicon.values()) / max(len(lexicon), 1)
    low, high = 1e-3, 50.0
    for _ in range(100):
        middle = (low + high) / 2
        grown = rate * np.exp(min(middle * mean, 700)) + (1 - rate) * np.exp(-middle * COST)
        low, high = (low, middle) if grown > 1 else (middle, high)
    return float(low)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Ridge logistic regression on one feature by Newton steps."""
    design = np.stack([np.ones_like(x), x], axis=1)
    w = np.zeros(2)
    ridge = np.diag([1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - ridge @ w
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge
        w = w + np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return float(w[0]), float(max(w[1], 0.0))


def train_toxicity(
    docs: DataFrame, labels: DataFrame, modulus: int = 5, per_class: int = SAMPLE_PER_CLASS
) -> ToxicityModel:
    """A model from labelled rows whose id has a non-zero remainder modulo ``modulus``."""
    sample, class_weights = labelled_sample(docs, labels, "toxic", per_class, modulus)
    total = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    if set(total) != {0, 1}:
        prior = {0: -6.0, 1: 6.0}[next(iter(total))] if total else 0.0
        return ToxicityModel(intercept=prior)
    lexicon = _stand_out(_token_counts(sample), total)
    bare = ToxicityModel(lexicon)

    # Only the clean half gives the chance law; the sample bounds the rows gathered.
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, label, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2))
            ):
                words = tokens(text)
                scored = bare.token_scores(words)
                best = [score for _, _, score in segments(scored)]
                rows.append((doc_id, label, len(words), len(scored), best))
            names = ["doc_id", "label", "n", "hits", "best"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.float64())]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [
                pa.array([], k) for k in kinds
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    scanned = map_batches(
        sample.select(F.col("doc_id").cast("long"), "label", "text"),
        scan,
        "doc_id long, label int, n long, hits long, best array<double>",
    )
    scanned = scanned.dropDuplicates(["doc_id"]).toArrow().to_pylist()
    clean = [row for row in scanned if row["label"] == 0]
    length = sum(row["n"] for row in clean) + 1
    rate = (sum(row["hits"] for row in clean) + 1) / length
    decay = _decay(lexicon, min(rate, 0.2))
    # The law's second parameter from the segments that clean texts do show.
    least = min(lexicon.values(), default=1.0)
    seen = sum(score >= least for row in clean for score in row["best"]) + 1
    scale = seen / (length * np.exp(-decay * least))
    model = ToxicityModel(lexicon, decay, float(scale))
    x, y = [], []
    for row in scanned:
        chances = [np.log(scale * max(row["n"], 1)) - decay * s for s in row["best"]]
        good = [(0, 0, 0.0, chance) for chance in chances if chance < np.log(SIGNIFICANT)]
        x.append(model.evidence(good))
        y.append(row["label"])
    weight = np.array([class_weights[label] for label in y])
    intercept, slope = _logistic(np.array(x), np.array(y, float), weight)
    return ToxicityModel(lexicon, decay, float(scale), intercept, slope)


_PASSAGES = "array<struct<start:int,end:int,score:double,log_chance:double>>"


def toxic_passages(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc, n_tokens, passages, score): each row's significant passages, in tokens."""
    rows = docs.select(
        F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("doc"),
        F.col("text").cast("string").alias("text"),
    )
    # The model's size is bounded by LEXICON.
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(
        pa.struct(
            [("start", pa.int32()), ("end", pa.int32())]
            + [("score", pa.float64()), ("log_chance", pa.float64())]
        )
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            lengths, found, scores = [], [], []
            for text in as_bytes(batch.column(1)):
                words = tokens(text)
                passages = known.passages(words)
                lengths.append(len(words))
                found.append(
                    [dict(zip(("start", "end", "score", "log_chance"), p)) for p in passages]
                )
                scores.append(known.probability(known.evidence(passages)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(lengths, pa.int64()),
                    pa.array(found, kind),
                    pa.array(scores, pa.float64()),
                ],
                ["doc", "n_tokens", "passages", "score"],
            )

    found = f"n_tokens long, passages {_PASSAGES}, score double"
    return map_batches(rows, scan, with_fields(rows.select("doc").schema, found))
