"""A hidden Markov model of words, trained on the whole corpus.

The tokens of a text are its words, A-Z in lower case, parted by ASCII white space, and
one end. Every word of the training texts is a symbol of the hidden states, and all unknown
words are one more. What is gathered is a table of words and states: each pass of
Baum-Welch runs forward-backward over all training texts, cut into windows, in chunks of
texts. A chunk sends the shares of the states in its words to ranges of words, where they
are summed over the chunks, and gets the sums of its own words back, so no task holds the
table. Words that stand in no other chunk need no sums; their shares stay the chunk's.
Chunks are stored once, in buckets, and are not shuffled. Shares travel as 16 bits each.
First values are drawn by the words' hashes, so they do not depend on order or partitions,
and passes are made until the likelihood settles. The score of a text is the exact
logarithm of its probability by the scaled forward recursion; windows of long texts become
transition matrices first, which are then chained.

The base score is that of a unigram model with SMOOTH added to each count; the states'
probabilities of words are smoothed alike.

A null or empty text is one end token. Rows with a null doc_id are scored and not
learned from. Repeated rows are learned from repeatedly and scored alike. Extra columns
are ignored. An empty table gives an empty result. Without training texts every token is
unknown.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm.chunks import (
    Numbers,
    bucketed,
    packed,
    squeeze,
    squeezed,
    unpacked,
    unsqueeze,
    word_chunks,
    word_list,
)
from obslake.llm.common import map_batches, map_groups, removed
from obslake.session import work_dir

STATES = 8
#: Training has settled when a pass raises the log likelihood by less than this share of it.
SETTLED = 1e-3
#: Words of a chunk, and words of all chunks in a range, whose sums one task builds.
CHUNK, RANGE = 2_000_000, 500_000
#: What a share of one is when it travels.
WHOLE = 2**16 - 1
#: Rows of the state that are not for a chunk: totals of a range, and all other counts.
TOTALS, MOVES = -1, -2
#: Less the chunk, the range of the words that no other chunk has.
ALONE = -3
#: Tokens of a window, and windows that run side by side.
SPAN, ABREAST = 256, 2048
#: Tokens after which the forward recursion of the scores is scaled; a token's probability
#: is above 1e-16 in corpora of any size.
RESCALED = 8
SMOOTH = 0.1
#: The end of a text; no word is empty.
END = b""


def tokens_of(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


@dataclass
class Model:
    """Probabilities: of the first state of a text and of a window inside one, of the
    next state, and of a symbol (first axis) in a state."""

    start: np.ndarray
    inside: np.ndarray
    step: np.ndarray
    emit: np.ndarray


@dataclass
class Expected:
    start: np.ndarray
    inside: np.ndarray
    step: np.ndarray
    emit: np.ndarray
    #: Natural logarithm of the probability of what was counted.
    logs: float = 0.0

    @staticmethod
    def none(symbols: int) -> Expected:
        k = STATES
        # Column by column, as all counts of words and states are.
        return Expected(np.zeros(k), np.zeros(k), np.zeros((k, k)), np.zeros((k, symbols)).T)


def windows_of(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offset, length and whether it begins a text, for the windows of texts in a row."""
    pieces = -(-lengths // SPAN)
    first = np.concatenate([[0], np.cumsum(pieces)[:-1]]) if len(pieces) else pieces
    number = np.arange(pieces.sum()) - np.repeat(first, pieces)
    offsets = np.repeat(np.cumsum(lengths) - lengths, pieces) + number * SPAN
    sizes = np.minimum(np.repeat(lengths, pieces) - number * SPAN, SPAN)
    return offsets, sizes, number == 0


def _sums_of_states(parts: np.ndarray) -> np.ndarray:
    """Sums over the eight states on the first axis, by pairs as numpy adds eight in a row."""
    for _ in range(3):
        parts = parts[0::2] + parts[1::2]
    return parts[0]


def expect(model: Model, symbols: np.ndarray, lengths: np.ndarray, found: Expected) -> None:
    """Adds the expected counts of texts to ``found`` by forward-backward over windows.

    The states are on an axis before the windows, so each operation runs along many windows.
    """
    offsets, sizes, begins = windows_of(lengths)
    order = np.argsort(-sizes, kind="stable")
    emit, step = np.ascontiguousarray(model.emit, np.float32), model.step.astype(np.float32)
    onward = np.ascontiguousarray(step.T)
    shape = int(sizes.max(initial=0)), min(ABREAST, len(order))
    all_seen, all_scale = np.empty(shape, np.int64), np.empty(shape, np.float32)
    all_likely, all_alpha = np.empty((2, shape[0], STATES, shape[1]), np.float32)
    for at in range(0, len(order), ABREAST):
        rows = order[at : at + ABREAST]
        first, size, begin = offsets[rows], sizes[rows], begins[rows]
        span, width = int(size[0]), len(rows)
        active = [int(np.searchsorted(-size, -t)) for t in range(span)]  # size > t
        seen, scale = all_seen[:span, :width], all_scale[:span, :width]
        likely, alpha = all_likely[:span, :, :width], all_alpha[:span, :, :width]
        now = np.where(begin, model.start[:, None], model.inside[:, None]).astype(np.float32)
        for t in range(span):
            n = active[t]
            seen[t, n:], alpha[t, :, n:], scale[t, n:] = 0, 0, 1
            seen[t, :n] = symbols.take(first[:n] + t)
            likely[t, :, :n] = emit.take(seen[t, :n], axis=0).T
            now = now if t == 0 else onward @ now[:, :n]
            now *= likely[t, :, :n]
            scale[t, :n] = _sums_of_states(now)
            now = np.divide(now, scale[t, :n], out=alpha[t, :, :n])
        found.logs += float(np.log(scale).sum(dtype=np.float64))
        beta = np.ones((STATES, width), np.float32)
        moved = np.zeros((STATES, STATES))
        for t in range(span - 1, -1, -1):
            n = active[t]
            if t + 1 < span:
                m = active[t + 1]
                ahead = likely[t + 1, :, :m]
                ahead *= beta[:, :m]
                ahead /= scale[t + 1, :m]
                moved += alpha[t, :, :m] @ ahead.T
                beta[:, :m] = step @ ahead
            here = alpha[t, :, :n]
            here *= beta[:, :n]
            here /= np.maximum(_sums_of_states(here), 1e-30)
        found.step += moved * model.step
        found.start += alpha[0][:, begin].sum(axis=1)
        found.inside += alpha[0][:, ~begin].sum(axis=1)
        flat = seen.ravel()
        for k in range(STATES):
            found.emit[:, k] += np.bincount(flat, alpha[:, k].ravel(), len(found.emit))


def moves(found: Expected) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities of first and next states from expected counts."""
    start = (found.start + 1) / (found.start.sum() + STATES)
    inside = (found.inside + 1) / (found.inside.sum() + STATES)
    return start, inside, (found.step + 1) / (found.step + 1).sum(axis=1, keepdims=True)


def emissions(counts: np.ndarray, totals: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Probabilities of symbols, drawn a little towards the symbols' shares."""
    return (counts + 100 * share[:, None]) / (totals + 100)


def improve(found: Expected, share: np.ndarray) -> Model:
    """Probabilities from expected counts of all symbols."""
    return Model(*moves(found), emissions(found.emit, found.emit.sum(axis=0), share))


def log_likelihood(model: Model, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each text's symbols."""
    result = np.zeros(len(lengths))
    starts = np.cumsum(lengths) - lengths
    emit, onward = np.ascontiguousarray(model.emit), np.ascontiguousarray(model.step.T)
    short = np.flatnonzero((lengths > 0) & (lengths <= 4 * SPAN))
    short = short[np.argsort(-lengths[short], kind="stable")]
    for at in range(0, len(short), ABREAST):
        rows = short[at : at + ABREAST]
        first, size = starts[rows], lengths[rows]
        now = np.repeat(model.start[:, None], len(rows), axis=1)
        logs = np.zeros(len(rows))
        for t in range(int(size[0])):
            n = int(np.searchsorted(-size, -t))
            part = now if t == 0 else onward @ now[:, :n]
            np.multiply(part, emit.take(symbols.take(first[:n] + t), axis=0).T, out=now[:, :n])
            if t % RESCALED == RESCALED - 1:
                total = now[:, :n].sum(axis=0)
                now[:, :n] /= total
                logs[:n] += np.log(total)
        result[rows] = logs + np.log(now.sum(axis=0))
    long = np.flatnonzero(lengths > 4 * SPAN)
    if len(long):
        offsets, sizes, begins = windows_of(lengths[long])
        owner = np.cumsum(begins) - 1
        offsets += (starts[long] - (np.cumsum(lengths[long]) - lengths[long]))[owner]
        order = np.argsort(-sizes, kind="stable")
        turns = np.empty((len(sizes), STATES, STATES))
        grown = np.zeros(len(sizes))
        for at in range(0, len(order), ABREAST // STATES):
            rows = order[at : at + ABREAST // STATES]
            first, size, begin = offsets[rows], sizes[rows], begins[rows]
            now = np.broadcast_to(np.eye(STATES), (len(rows), STATES, STATES)).copy()
            logs = np.zeros(len(rows))
            for t in range(int(size[0])):
                n = int(np.searchsorted(-size, -t))
                part = (now[:n].reshape(-1, STATES) @ model.step).reshape(n, STATES, STATES)
                if t == 0:
                    # The first token of a text meets the start, not a step from a state before.
                    part[begin] = now[begin]
                ahead = emit.take(symbols.take(first[:n] + t), axis=0)
                np.multiply(part, ahead[:, None, :], out=now[:n])
                if t % RESCALED == RESCALED - 1:
                    total = now[:n].max(axis=(1, 2))
                    now[:n] /= total[:, None, None]
                    logs[:n] += np.log(total)
            turns[rows], grown[rows] = now, logs
        state = None
        for i in range(len(sizes)):
            state = (model.start if begins[i] else state) @ turns[i]
            total = state.sum()
            state = state / total
            result[long[owner[i]]] += np.log(total) + grown[i]
    return result


def _array_of(packed: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(packed, kind)


def _seeds(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order of words by their hashes, and the hashes in that order."""
    seeds = np.fromiter(map(xxhash.xxh32_intdigest, words), np.uint32, len(words))
    order = np.argsort(seeds, kind="stable")
    return order, seeds[order]


def _first_shares(seeds: np.ndarray) -> np.ndarray:
    """The states' shares in words before the first pass, half of them by the words' hashes."""
    mixed = seeds.astype(np.uint64)[:, None] + np.arange(1, STATES + 1, dtype=np.uint64) * np.uint64(
        0x9E3779B97F4A7C15
    )
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    noise = -np.log(((mixed >> np.uint64(40)) + np.uint64(1)) / 2.0**24 * (1 - 2.0**-25))
    return 0.5 / STATES + 0.5 * noise / noise.sum(axis=1, keepdims=True)


def _rounded(shares: np.ndarray) -> np.ndarray:
    return np.rint(shares * WHOLE).astype("<u2")


def _made_whole(rounded: np.ndarray) -> np.ndarray:
    shares = rounded.astype(np.float64)
    return shares / np.maximum(shares.sum(axis=1, keepdims=True), 1)


def _sent(shares: np.ndarray) -> bytes:
    return squeeze(_rounded(shares).T.tobytes())


def _received(raw: bytes) -> np.ndarray:
    return _made_whole(np.frombuffer(unsqueeze(raw), "<u2").reshape(STATES, -1).T)


def _summed_alone(shares: np.ndarray) -> np.ndarray:
    """The shares of words that no other chunk has, as ranges would have summed them."""
    return _made_whole(_rounded(_made_whole(_rounded(shares))))


@dataclass
class Corpus:
    """Training tokens, distinct ones, and the texts in chunks."""

    tokens: int
    types: int
    encoded: DataFrame

    def emit(self, counts: np.ndarray, shares: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """Probabilities of a chunk's words and, as the last, of an unknown one."""
        n, whole = self.tokens, self.tokens + SMOOTH * (self.types + 1)
        result = np.zeros((STATES, len(counts) + 1)).T
        if len(counts):
            result[:-1] = emissions(counts[:, None] * shares, totals, counts / n)
            result[:-1] *= n
        result += SMOOTH
        result /= whole
        return result


#: What a chunk's words are to the ranges: how many stand in no other chunk, and for each
#: range of the others its number, their places in it and their counts in training texts.
_WORDS = ["chunk", "alone", "ranges", "places", "own"]


def _sums(shares_of_chunk: Callable, rows: DataFrame, path: str) -> DataFrame:
    """The state after a pass: the shares of each chunk's words, by range, and all totals.

    ``shares_of_chunk`` gives a chunk's shares, its words' counts and its other counts from
    what follows ``_WORDS`` in a row of ``rows``.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(*values) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], kind) for v, kind in zip(values, kinds)],
                ["range", "chunk", "places", "own", "shares"],
            )

        for batch in batches:
            for row in range(batch.num_rows):
                chunk, alone, ranges, places, own, *rest = (
                    batch.column(i)[row].as_py() for i in range(batch.num_columns)
                )
                shares, counts, others = shares_of_chunk(*rest)
                kept = _summed_alone(shares[:alone])
                others = np.concatenate([counts[:alone] @ kept, others])
                yield sent(MOVES, chunk, None, None, others.astype("<f8").tobytes())
                if alone:
                    twice = _made_whole(_rounded(shares[:alone]))
                    yield sent(ALONE - chunk, chunk, None, None, _sent(twice))
                low = alone
                for at, here, counted in zip(ranges, places, own):
                    high = low + len(_array_of(unsqueeze(counted), "<i4"))
                    yield sent(at, chunk, here, counted, _sent(shares[low:high]))
                    low = high

    def add(table: pa.Table) -> pa.Table:
        at, chunks = table["range"][0].as_py(), table["chunk"].to_pylist()
        sent = table["shares"].to_pylist()
        if at == MOVES:
            rows = [(MOVES, at, sum(_array_of(raw, "<f8") for raw in sent).tobytes())]
        elif at <= ALONE:
            rows = [(chunk, at, raw) for chunk, raw in zip(chunks, sent)]
        else:
            each = [unpacked(raw).astype(np.int64) for raw in table["places"].to_pylist()]
            own = [_array_of(unsqueeze(raw), "<i4") for raw in table["own"].to_pylist()]
            total = np.zeros((max(int(place.max()) for place in each) + 1, STATES))
            for place, counts, raw in zip(each, own, sent):
                # No word is twice in a chunk.
                total[place] += counts[:, None] * _received(raw)
            counts = np.rint(total.sum(axis=1))
            total = np.rint(total / np.maximum(counts, 1)[:, None] * WHOLE) / WHOLE
            rows = [(chunk, at, _sent(total[place])) for chunk, place in zip(chunks, each)]
            total /= np.maximum(total.sum(axis=1, keepdims=True), 1 / WHOLE)
            rows.append((TOTALS, at, (counts @ total).astype("<f8").tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.binary())
        return pa.table(
            [pa.array(v, kind) for v, kind in zip(zip(*rows), kinds)], ["chunk", "range", "shares"]
        )

    shares = map_batches(
        rows, send, "range long, chunk long, places binary, own binary, shares binary"
    )
    sums = map_groups(shares, ["range"], add, "chunk long, range long, shares binary")
    sums.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(sums.schema).parquet(path)


def _collect_garbage(spark: SparkSession) -> None:
    """Else the shuffles of all passes stay until the driver happens to collect its garbage."""
    spark.sparkContext._jvm.System.gc()


def _with_shares(corpus: Corpus, state: DataFrame, columns: list[str]) -> DataFrame:
    """The chunks with the shares of their words."""
    in_order = F.sort_array(F.collect_list(F.struct("range", "shares")))
    shares = state.where("chunk >= 0").groupBy("chunk").agg(in_order["shares"].alias("shares"))
    return corpus.encoded.join(shares, "chunk", "left").select(*columns, "shares")


def _joined(shares: list[bytes] | None) -> np.ndarray:
    return np.concatenate([np.zeros((STATES, 0)), *[_received(raw).T for raw in shares or []]], axis=1).T


def _totals(state: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Expected counts of the states, and all other counts."""
    totals, others = np.zeros(STATES), None
    # A row for each range of words.
    for row in state.where("chunk < 0").orderBy("range").collect():
        if row["chunk"] == TOTALS:
            totals += _array_of(row["shares"], "<f8")
        else:
            others = _array_of(row["shares"], "<f8")
    return totals + others[:STATES], others[STATES:]


def _first_totals(encoded: DataFrame) -> np.ndarray:
    """Counts of the states before the first pass, for which a chunk needs no other."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(STATES)
        for batch in batches:
            for row in range(batch.num_rows):
                seeds, own = (batch.column(i)[row].as_py() for i in range(2))
                found += _array_of(unsqueeze(own), "<i4") @ _seeded(seeds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(STATES), pa.int32()), pa.array(found)], ["state", "total"]
        )

    sums = map_batches(encoded.select("seeds", "all_own"), add, "state int, total double")
    totals = np.zeros(STATES)
    for row in sums.groupBy("state").agg(F.sum("total").alias("total")).collect():
        totals[row["state"]] = row["total"]
    return totals


def _seeded(seeds: list[bytes]) -> np.ndarray:
    """The first shares of a chunk's words, as sums of them come back."""
    return _summed_alone(_first_shares(np.concatenate([unpacked(raw) for raw in seeds])))


def train(corpus: Corpus) -> tuple[Model, np.ndarray, DataFrame]:
    """The model without its emissions, the states' expected counts, and the words' shares."""
    spark, encoded = corpus.encoded.sparkSession, corpus.encoded
    even = np.full(STATES, 1 / STATES)
    stay = np.full((STATES, STATES), 0.1 / STATES) + np.eye(STATES) * 0.9
    none = np.zeros((0, STATES))
    model = Model(even, even, stay, none)
    totals, state, path = _first_totals(encoded), None, None
    needed = [*_WORDS, "held_out", "lengths", "symbols", "counts"]
    logs: list[float] = []
    while len(logs) < 2 or logs[-1] - logs[-2] > SETTLED * abs(logs[-1]):
        _collect_garbage(spark)
        shared = spark.sparkContext.broadcast((model, totals))
        size, first = Corpus(corpus.tokens, corpus.types, None), state is None

        def expected(
            held: list, lengths: bytes, symbols: bytes, counts: bytes, shares: list
        ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            known, of_states = shared.value
            counts = _array_of(unsqueeze(counts), "<i8")
            emit = size.emit(counts, _seeded(shares) if first else _joined(shares), of_states)
            found = Expected.none(len(emit))
            sizes = _array_of(lengths, "<i4").astype(np.int64)
            learned = ~np.array(held, bool)
            seen = _array_of(unsqueeze(symbols), "<u4")[np.repeat(learned, sizes)].astype(np.int64)
            if len(seen):
                expect(Model(known.start, known.inside, known.step, emit), seen, sizes[learned], found)
            shares = found.emit[:-1] / np.maximum(found.emit[:-1].sum(axis=1, keepdims=True), 1e-30)
            others = [found.start, found.inside, found.step.ravel(), [found.logs]]
            return shares, counts, np.concatenate(others)

        rows = encoded.select(*needed, "seeds") if first else _with_shares(corpus, state, needed)
        before, path = path, work_dir(spark, "shares")
        state = _sums(expected, rows, path)
        if before is not None:
            removed(spark, before)
        totals, others = _totals(state)
        k = STATES
        found = Expected(others[:k], others[k : 2 * k], others[2 * k : -1].reshape(k, k), none)
        model = Model(*moves(found), none)
        logs.append(others[-1])
    return model, totals, state


def _ranges(chunks: DataFrame) -> DataFrame:
    """What the ranges of words say of each chunk's, in the order of their hashes.

    For the words of a chunk in a range: their counts in all training texts, whether they
    stand in no other chunk, and of the known ones that do, their places in the range and
    counts in the chunk's training texts. ``tokens`` and ``types`` add up to those of all
    training texts.
    """
    spark = chunks.sparkSession
    types = chunks.agg(F.sum("types")).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-types // RANGE))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.array([i * 2**32 // ranges for i in range(1, ranges)], np.uint32)
        for batch in batches:
            for chunk, raw, counted in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words, counts = word_list(raw), _array_of(unsqueeze(counted), "<i8")
                order, seeds = _seeds(words)
                counts, cuts = counts[order], np.searchsorted(seeds, bounds).tolist()
                order = order.tolist()
                for i, (low, high) in enumerate(zip([0, *cuts], [*cuts, len(words)])):
                    if low < high:
                        text = squeeze(b" ".join([words[k] for k in order[low:high]]))
                        own = squeeze(counts[low:high].astype("<i4").tobytes())
                        values = [[i], [chunk], [text], [own]]
                        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(v, kind) for v, kind in zip(values, kinds)],
                            ["range", "chunk", "words", "own"],
                        )

    def gather(table: pa.Table) -> pa.Table:
        known, each = Numbers(), []
        for raw in table["words"].to_pylist():
            words = word_list(raw)
            each.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        own = [_array_of(unsqueeze(raw), "<i4") for raw in table["own"].to_pylist()]
        total, chunks = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
        for numbers, counts in zip(each, own):
            # No word is twice in a chunk.
            total[numbers] += counts
            chunks[numbers] += 1
        shared = (total > 0) & (chunks > 1)
        order, _ = _seeds(list(known))
        place = np.zeros(len(known), np.uint64)
        place[order] = np.cumsum(shared[order]) - shared[order]
        rows = []
        at = table["range"][0].as_py()
        for chunk, numbers, counts in zip(table["chunk"].to_pylist(), each, own):
            here = shared[numbers]
            rows.append(
                (
                    at,
                    chunk,
                    squeeze(total[numbers].astype("<i8").tobytes()),
                    squeeze((chunks[numbers] == 1).tobytes()),
                    packed(place[numbers[here]]),
                    squeeze(counts[here].tobytes()),
                    int(counts.sum()),
                    0 if rows else int((total > 0).sum()),
                )
            )
        kinds = [pa.int64()] * 2 + [pa.binary()] * 4 + [pa.int64()] * 2
        names = ["range", "chunk", "totals", "alone", "places", "own", "tokens", "types"]
        return pa.table([pa.array(v, kind) for v, kind in zip(zip(*rows), kinds)], names)

    sent = map_batches(
        chunks.select("chunk", "words", "counts"),
        deal,
        "range long, chunk long, words binary, own binary",
    )
    return map_groups(
        sent,
        ["range"],
        gather,
        "range long, chunk long, totals binary, alone binary, places binary, own binary,"
        " tokens long, types long",
    )


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    ``docs`` has doc_id, held_out and text; the rows that are not held out are learned from.
    """
    spark = docs.sparkSession
    paths = [work_dir(spark, "chunks"), work_dir(spark, "ranges")]
    chunks = word_chunks(
        docs, tokens_of, CHUNK, store=lambda frame, purpose: bucketed(frame, purpose, path=paths[0])
    )
    ranges = squeezed(_ranges(chunks), "ranges", paths[1])
    whole = ranges.agg(F.sum("tokens").alias("n"), F.sum("types").alias("v")).first()
    n, v = whole["n"] or 0, whole["v"] or 0
    told = F.sort_array(F.collect_list(F.struct("range", "totals", "alone", "places", "own")))
    answers = ranges.groupBy("chunk").agg(told.alias("told"))
    base_total = np.log10(n + SMOOTH * (v + 1))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk, ids, held, lengths, numbers, words, told = (
                    batch.column(i)[row] for i in range(7)
                )
                words, told = word_list(words.as_py()), told.as_py()
                order, seeds = _seeds(words)
                total = np.concatenate([_array_of(unsqueeze(x["totals"]), "<i8") for x in told])
                alone = np.concatenate([_array_of(unsqueeze(x["alone"]), "?") for x in told])
                picked = [np.flatnonzero((total > 0) & alone), np.flatnonzero((total > 0) & ~alone)]
                sizes = _array_of(lengths.as_py(), "<i4")
                chosen = np.concatenate(picked)
                symbol = np.full(len(words), len(chosen), np.uint32)
                symbol[order[chosen]] = np.arange(len(chosen))
                symbols = symbol[_array_of(unsqueeze(numbers.as_py()), "<i4")]
                learned = np.repeat(~np.array(held.as_py(), bool), sizes)
                own = np.bincount(symbols[learned], minlength=len(chosen) + 1)[:-1]
                total = total[chosen]
                base = np.log10(np.append(total, 0) + SMOOTH) - base_total
                first = np.cumsum(sizes) - sizes  # every text has its end, so none is empty
                known = np.add.reduceat((symbols < len(chosen)).astype(np.int64), first)
                spread = [x for x in told if len(unsqueeze(x["own"]))]
                hashes = [packed(seeds[at].astype(np.uint64)) for at in picked]
                binary = [
                    sizes.tobytes(),
                    squeeze(symbols.astype("<u4").tobytes()),
                    squeeze(total.astype("<i8").tobytes()),
                    squeeze(own.astype("<i4").tobytes()),
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk.as_py()], pa.int64()),
                        pa.array([ids.as_py()], pa.list_(pa.int64())),
                        pa.array([held.as_py()], pa.list_(pa.bool_())),
                        *[pa.array([value], pa.binary()) for value in binary],
                        pa.array([len(picked[0])], pa.int64()),
                        pa.array([[x["range"] for x in spread]], pa.list_(pa.int64())),
                        pa.array([[x["places"] for x in spread]], pa.list_(pa.binary())),
                        pa.array([[x["own"] for x in spread]], pa.list_(pa.binary())),
                        pa.array([hashes], pa.list_(pa.binary())),
                        pa.array([np.add.reduceat(base[symbols], first)], pa.list_(pa.float64())),
                        pa.array([known], pa.list_(pa.int64())),
                    ],
                    ["chunk", "doc_ids", "held_out", "lengths", "symbols", "counts", "all_own"]
                    + ["alone", "ranges", "places", "own", "seeds", "base", "known"],
                )

    columns = ["chunk", "doc_ids", "held_out", "lengths", "numbers", "words", "told"]
    encoded = bucketed(
        map_batches(
            chunks.join(answers, "chunk").select(*columns),
            encode,
            "chunk long, doc_ids array<long>, held_out array<boolean>, lengths binary,"
            " symbols binary, counts binary, all_own binary, alone long, ranges array<long>,"
            " places array<binary>, own array<binary>, seeds array<binary>,"
            " base array<double>, known array<long>",
        ),
        "encoded",
    )
    for path in paths:
        removed(spark, path)
    corpus = Corpus(n, v, encoded)
    even = np.full(STATES, 1 / STATES)
    step = np.full((STATES, STATES), 1 / STATES)
    trained = Model(even, even, step, step), np.zeros(STATES), None
    if n:
        trained = train(corpus)
    model, totals, state = trained
    columns = ["doc_ids", "held_out", "lengths", "symbols", "counts", "base", "known"]
    if state is None:
        rows = encoded.select(*columns, F.lit(None).cast("array<binary>").alias("shares"))
    else:
        rows = _with_shares(corpus, state, columns)
    shared = spark.sparkContext.broadcast((model, totals))
    size = Corpus(n, v, None)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, held, lengths, symbols, counts, base, known, shares = (
                    batch.column(i)[row] for i in range(8)
                )
                model, totals = shared.value
                counts = _array_of(unsqueeze(counts.as_py()), "<i8")
                emit = size.emit(counts, _joined(shares.as_py()), totals)
                sizes = _array_of(lengths.as_py(), "<i4").astype(np.int64)
                seen = _array_of(unsqueeze(symbols.as_py()), "<u4").astype(np.int64)
                whole = Model(model.start, model.inside, model.step, emit)
                logs = log_likelihood(whole, seen, sizes) / np.log(10)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values,
                        held.values,
                        pa.array(sizes),
                        known.values,
                        pa.array(np.full(len(sizes), n, np.int64)),
                        base.values,
                        pa.array(logs),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"]
                    + ["base_score", "score"],
                )

    return map_batches(
        rows,
        score,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
        " base_score double, score double",
    )
