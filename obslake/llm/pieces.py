"""SentencePiece encoding by a relational lattice, and decoding.

A text's spaces become the space mark, one more stands in front, and a word is a mark
with what follows up to the next one. A word is cut between two characters that stand
side by side in no piece, which no way through the lattice can bridge, and nowhere else.
The distinct parts of the corpus are a table. Their substrings, as long as the
longest piece that begins like them, are exploded and joined to the piece table on
equality; what matches is an edge. Edges are grouped by blocks of parts, and a fold over
the positions of all parts of a block keeps the best way from each to the end (Viterbi, the
largest sum of the pieces' scores). Parts of more than LONGEST characters are exploded in blocks, which overlap
by a piece, and their edges folded from the last position to the first, in time that grows
with their number. A character that is no piece is an edge of its bytes, at a cost that no
piece has. The codes come back to the texts through the dictionaries of the chunks that
hold these: a chunk's parts travel to ranges of hashes and their codes back, a row for
each range and chunk, while the chunks stay in the buckets that they were stored in.

This is the best segmentation under the model's scores. For a vocabulary built by merges
it may differ from replaying the merges. Scores are taken in fixed point: SCORE_BITS
bits over the whole range of a model's scores, exact for the ranks of merges. Decoding joins the pieces, undoes the marks and
drops the first: any text without the mark itself comes back as it was.

Of equally good ways the one with the larger codes is taken. A null or empty text has no
codes. Rows with a null doc_id are encoded, repeated rows alike. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm.chunks import (
    Numbers,
    bucketed,
    by_place,
    expanded,
    from_places,
    packed,
    squeeze,
    squeezed,
    unpacked,
    unsqueeze,
    word_chunks,
    word_list,
)
from obslake.llm.common import SLICE, map_batches, map_groups

MARK = "▁"
#: Characters of a part whose edges are one number each, and what a byte without a piece costs.
LONGEST, BYTE_COST = 32, 1e5
#: An edge is one number: end and start, then the score's size, then the piece.
PLACE_BITS, SCORE_BITS, ID_BITS = 6, 31, 20
NO_PIECE = 2**ID_BITS - 1
#: Characters that a piece's bound on its length is looked up by.
PREFIX = 3
#: Characters of a longer part that are exploded together.
BLOCK = 256
#: Words of a chunk: large ones have fewer dictionary entries in all, and take more memory.
CHUNK = 1_500_000
#: Dictionary entries of all chunks in a range of hashes, distinct parts whose lattices one task
#: builds, and parts whose edges are folded together.
RANGE_TYPES, TASK_PARTS, BLOCK_PARTS = 500_000, 50_000, 4096


class Splitter:
    """The words of a text and their parts. ``bridged`` has the pairs of characters within pieces."""

    def __init__(self, bridged: frozenset[str]):
        self.bridged = bridged

    def words(self, text: bytes) -> list[bytes]:
        return text.split(b" ") if text else []

    def parts(self, word: bytes) -> list[bytes]:
        marked = MARK + word.decode("utf-8", "replace")
        parts, start = [], 0
        for at in range(1, len(marked) + 1):
            if marked[at - 1 : at + 1] not in self.bridged:
                parts.append(marked[start:at].encode())
                start = at
        return parts if start == len(marked) else [*parts, marked[start:].encode()]


def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def piece_table(spark: SparkSession, model_path: str) -> DataFrame:
    """(piece, id, score) of a model's ordinary pieces."""
    model = _model(model_path)
    rows = [
        (model.id_to_piece(i), i, float(model.get_score(i)))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    return spark.createDataFrame(rows, "piece string, id int, score double")


def splitter(model_path: str) -> Splitter:
    model = _model(model_path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return Splitter(frozenset(p[i : i + 2] for p in pieces for i in range(len(p) - 1)))


def _fixed_point(pieces: DataFrame) -> tuple[float, int]:
    """The power of two that scores are multiplied with, and the largest product."""
    low, high = pieces.agg(F.min("score"), F.max("score")).first()
    span = max(high - low, 2.0**-20)
    scale = 2.0 ** math.floor(math.log2((2**SCORE_BITS - 1) / span))
    return scale, math.floor(high * scale)


def best_way(
    word: str, edges: list[tuple[int, int, int, int]], byte_zero: int, byte_points: int
) -> list[int]:
    """The codes of the best way through edges (start, size, points, piece).

    Ways from one start differ in their first code, so the largest one settles a tie.
    """
    best: list[tuple[int, int, int]] = [(0, 0, 0)] * (len(word) + 1)
    reached = [False] * len(word)
    for start, n, points, piece in sorted(edges, reverse=True):
        if piece == NO_PIECE:
            raw = word[start - 1].encode()
            points, piece = byte_points * len(raw), byte_zero + raw[0]
        way = (points + best[start - 1 + n][0], piece, n)
        if not reached[start - 1] or way[:2] > best[start - 1][:2]:
            best[start - 1], reached[start - 1] = way, True
    codes, at = [], 0
    while at < len(word):
        _, piece, n = best[at]
        raw = word[at].encode() if n == 1 and piece == byte_zero + word[at].encode()[0] else None
        codes += [piece] if raw is None else [byte_zero + b for b in raw]
        at += n
    return codes


class Edges:
    """Edges of short parts, an array each: part, start, end, points, piece and bytes without a piece."""

    def __init__(self, table: pa.Table, zero: int, byte_zero: int, byte_points: int):
        packed = table["edge"].to_numpy()
        raw = table["raw"].combine_chunks().cast(pa.binary())
        places, part = np.unique(table["place"].to_numpy(), return_inverse=True)
        start = (packed >> (ID_BITS + SCORE_BITS)) & (2**PLACE_BITS - 1)
        order = np.lexsort((part, start))
        self.places, self.part, self.start = places, part[order], start[order]
        self.end = (packed >> (ID_BITS + SCORE_BITS + PLACE_BITS))[order]
        self.points = ((packed >> ID_BITS) & (2**SCORE_BITS - 1))[order] - zero
        self.piece = (packed & NO_PIECE)[order]
        offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset :][: len(raw) + 1].astype(np.int64)
        self.bytes = np.frombuffer(raw.buffers()[2] or b"", np.uint8).astype(np.int64) + byte_zero
        self.first, self.n_bytes = offsets[:-1][order], np.diff(offsets)[order]
        bare = np.flatnonzero(self.n_bytes)
        self.points[bare] = byte_points * self.n_bytes[bare]
        self.piece[bare] = self.bytes[self.first[bare]]

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """The number of codes of each part's best way, and the codes.

        From the last position to the first, for all parts at once. Ways from one start
        differ in their first code, so the largest one settles a tie.
        """
        n, last = len(self.places), LONGEST + 2
        best = np.zeros((n, last + 1), np.int64)
        taken = np.full((n, last + 1), -1, np.int64)
        cuts = np.searchsorted(self.start, np.arange(last + 1))
        for start in range(last - 1, 0, -1):
            here = np.arange(cuts[start], cuts[start + 1])
            if not len(here):
                continue
            part = self.part[here]
            total = self.points[here] + best[part, self.end[here]]
            begins = np.flatnonzero(np.diff(part, prepend=-1))
            owner = np.cumsum(np.diff(part, prepend=-1) != 0) - 1
            most = np.maximum.reduceat(total, begins)
            piece = np.where(total == most[owner], self.piece[here], -1)
            chosen = piece == np.maximum.reduceat(piece, begins)[owner]
            best[part[begins], start] = most
            taken[part[chosen], start] = here[chosen]
        parts, edges = [], []
        part, at = np.arange(n), np.ones(n, np.int64)
        while len(part):
            edge = taken[part, at]
            part, edge = part[edge >= 0], edge[edge >= 0]
            parts.append(part)
            edges.append(edge)
            at = self.end[edge]
        part, edge = np.concatenate(parts), np.concatenate(edges)
        order = np.argsort(part, kind="stable")
        part, edge = part[order], edge[order]
        sizes = np.maximum(self.n_bytes[edge], 1)
        codes = np.repeat(self.piece[edge], sizes)
        bare = self.n_bytes[edge] > 0
        of_bytes = expanded((np.cumsum(sizes) - sizes)[bare], sizes[bare])
        codes[of_bytes] = self.bytes[expanded(self.first[edge[bare]], sizes[bare])]
        return np.bincount(part, sizes, n).astype(np.int64), codes


#: The codes of some parts of a range.
_CODED = "range int, places binary, counts binary, codes binary"


def encode_parts(parts: DataFrame, model_path: str) -> DataFrame:
    """(range, places, counts, codes) of the parts (range, place, word), for many short ones or a long one."""
    spark = parts.sparkSession
    short = parts.where(F.length("word") <= LONGEST)
    pieces = piece_table(spark, model_path)
    longest = pieces.agg(F.max(F.length("piece"))).first()[0]
    scale, high = _fixed_point(pieces)
    # What a score lies below the highest one, from the top of its bits.
    zero = 2**SCORE_BITS - 1 - high
    scored = pieces.select(
        "piece", "id", (F.floor(F.col("score") * scale).cast("long") + F.lit(zero)).alias("points")
    )
    bounds = pieces.groupBy(F.left("piece", F.lit(PREFIX)).alias("begins")).agg(
        F.max(F.length("piece")).alias("longest")
    )
    byte_zero = _model(model_path).piece_to_id("<0x00>")
    byte_points = round(-BYTE_COST * scale)

    def edges_of(starts: DataFrame, *key: str) -> DataFrame:
        """The pieces that begin at a start with ``rest``, and every single character."""
        # The vocabulary is fixed: some ten thousand pieces, and fewer ways to begin one.
        bounded = starts.withColumn("begins", F.left("rest", F.lit(PREFIX))).join(
            F.broadcast(bounds), "begins", "left"
        )
        bound = F.greatest(F.coalesce("longest", F.lit(1)), F.lit(PREFIX - 1))
        lengths = F.sequence(F.lit(1), F.least(bound, F.length("rest")))
        substrings = bounded.select(*key, "start", "rest", F.explode(lengths).alias("n")).select(
            *key, "start", "n", F.left("rest", "n").alias("piece")
        )
        found = substrings.join(F.broadcast(scored), "piece", "left")
        return found.where("id is not null or n = 1")

    block = F.col("range").cast("long") * 2**20 + F.floor(F.col("place") / BLOCK_PARTS)
    # A part has some dozens of edges, so a task gets fewer parts than their size suggests.
    tasks = max(1, -(-short.count() // TASK_PARTS))
    starts = (
        short.withColumn("block", block)
        .repartition(tasks, "block")
        .select("block", "place", "word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("start"))
        .withColumn("rest", F.substring("word", F.col("start"), F.lit(longest)))
    )
    packed = F.lit(0).cast("long")
    for value, bits in (
        (F.col("start") + F.col("n"), PLACE_BITS),
        (F.col("start"), PLACE_BITS),
        (F.coalesce("points", F.lit(0)), SCORE_BITS),
        (F.coalesce("id", F.lit(NO_PIECE)), ID_BITS),
    ):
        packed = F.shiftleft(packed, bits) + value
    raw = F.when(F.col("id").isNull(), F.col("piece").cast("binary"))
    edges = edges_of(starts, "block", "place").select(
        "block", "place", packed.alias("edge"), raw.alias("raw")
    )

    def fold_all(table: pa.Table) -> pa.Table:
        edges = Edges(table, zero, byte_zero, byte_points)
        counts, codes = edges.best()
        values = [table["block"][0].as_py() >> 20, *map(by_place, (edges.places, counts, codes))]
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table(
            [pa.array([v], kind) for v, kind in zip(values, kinds)], ["range", "places", "counts", "codes"]
        )

    coded = map_groups(edges, ["block"], fold_all, _CODED)

    numbered = parts.where(F.length("word") > LONGEST).withColumn(
        "part", F.monotonically_increasing_id()
    )
    long = squeezed(numbered, "long-words")
    last = F.floor((F.length("word") - 1) / BLOCK).cast("int")
    block = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.substring(F.col("word"), i * BLOCK + 1, F.lit(BLOCK + longest - 1)),
    )
    blocks = long.select("part", F.posexplode(block).alias("block", "text"))
    inside = F.sequence(F.lit(1), F.least(F.lit(BLOCK), F.length("text")))
    starts = blocks.select("part", "block", "text", F.explode(inside).alias("at")).select(
        "part",
        (F.col("block") * BLOCK + F.col("at")).alias("start"),
        F.substring("text", F.col("at"), F.lit(longest)).alias("rest"),
    )
    edge = F.struct(
        "start",
        "n",
        F.coalesce(F.col("points") - F.lit(zero), F.lit(0)).alias("points"),
        F.coalesce("id", F.lit(NO_PIECE)).alias("id"),
    )
    lattice = edges_of(starts, "part").groupBy("part").agg(F.collect_list(edge).alias("edges"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            about = (batch.column(i).to_pylist() for i in range(3))
            for number, place, word, edges in zip(*about, batch.column(3)):
                fields = (edges.values.field(i).to_pylist() for i in range(4))
                codes = best_way(word, list(zip(*fields)), byte_zero, byte_points)
                binary = [by_place(np.array(x)) for x in ([place], [len(codes)], codes)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), *[pa.array([x], pa.binary()) for x in binary]],
                    ["range", "places", "counts", "codes"],
                )

    folded = long.join(lattice, "part").select("range", "place", "word", "edges")
    return coded.unionAll(map_batches(folded, fold, _CODED))


def _in_order(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order in which words are dealt to ranges, and their hashes in that order."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    order = np.argsort(hashes, kind="stable")
    return order, hashes[order]


def distinct_parts(chunks: DataFrame) -> DataFrame:
    """The distinct parts (range, place, word), and (range, chunk, places) of each chunk's own, stored.

    A chunk's words of a range of hashes travel as one row, and once.
    """
    spark = chunks.sparkSession
    types = chunks.agg(F.sum("types")).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-types // RANGE_TYPES))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.array([i * 2**64 // ranges for i in range(1, ranges)], np.uint64)
        for batch in batches:
            for chunk, raw, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = word_list(raw)[:n]
                order, hashes = _in_order(words)
                order, cuts = order.tolist(), np.searchsorted(hashes, bounds).tolist()
                for i, (low, high) in enumerate(zip([0, *cuts], [*cuts, len(words)])):
                    if low < high:
                        text = squeeze(b" ".join([words[k] for k in order[low:high]]))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([i], pa.int32()),
                                pa.array([chunk], pa.int64()),
                                pa.array([text], pa.binary()),
                            ],
                            ["range", "chunk", "words"],
                        )

    def gather(table: pa.Table) -> pa.Table:
        known = Numbers()
        each = []
        for raw in table["words"].to_pylist():
            words = word_list(raw)
            each.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        words = list(known)
        order, _ = _in_order(words)
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        n, chunks = len(words), table["chunk"].to_pylist()
        at = table["range"][0].as_py()
        return pa.table(
            {
                "range": pa.array([at] * (n + len(chunks)), pa.int32()),
                "place": pa.array([*range(n), *[None] * len(chunks)], pa.int32()),
                "word": pa.array(
                    [words[i].decode() for i in order.tolist()] + [None] * len(chunks), pa.string()
                ),
                "chunk": pa.array([None] * n + chunks, pa.int64()),
                "places": pa.array(
                    [None] * n + [packed(place[x].astype(np.uint64)) for x in each], pa.binary()
                ),
            }
        )

    sent = map_batches(
        chunks.select("chunk", "words", "types"), deal, "range int, chunk long, words binary"
    )
    return squeezed(
        map_groups(
            sent, ["range"], gather, "range int, place int, word string, chunk long, places binary"
        ),
        "parts",
    )


def _answers(parts: DataFrame, coded: DataFrame) -> DataFrame:
    """(chunk, answers): the codes of a chunk's words, by range and in the order of their hashes."""

    def answer(own: pa.Table, found: pa.Table) -> pa.Table:
        columns = [[from_places(x) for x in found[name].to_pylist()] for name in ("places", "counts", "codes")]
        places, counts, codes = (np.concatenate(x).astype(np.int64) for x in columns)
        sizes, first = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        sizes[places], first[places] = counts, np.cumsum(counts) - counts
        rows = []
        for at, chunk, raw in zip(*(own[name].to_pylist() for name in ("range", "chunk", "places"))):
            here = unpacked(raw).astype(np.int64)
            picked = codes[expanded(first[here], sizes[here])]
            rows.append((at, chunk, by_place(sizes[here]), by_place(picked)))
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.table(
            [pa.array(v, kind) for v, kind in zip(zip(*rows), kinds)], ["range", "chunk", "counts", "codes"]
        )

    own = parts.where("chunk is not null").select("range", "chunk", "places")
    both = own.groupBy("range").cogroup(coded.groupBy("range"))
    found = both.applyInArrow(answer, "range int, chunk long, counts binary, codes binary")
    in_order = F.sort_array(F.collect_list(F.struct("range", "counts", "codes")))
    return found.groupBy("chunk").agg(in_order.alias("answers"))


def encode_texts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id and codes for each row of (doc_id, text)."""
    rows = docs.select("doc_id", F.lit(False).alias("held_out"), "text")
    split = splitter(model_path)
    chunks = word_chunks(rows, split.words, CHUNK, cut=split.parts, store=bucketed)
    parts = distinct_parts(chunks)
    words = parts.where("word is not null").select("range", "place", "word")
    coded = squeezed(encode_parts(words, model_path), "codes")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, lengths, numbers, words, types, answers = (batch.column(i)[row].as_py() for i in range(6))
                sizes = np.frombuffer(lengths, "<i4")
                places = np.frombuffer(unsqueeze(numbers), "<i4")
                order, _ = _in_order(word_list(words)[:types])
                count, first = np.zeros(types, np.int64), np.zeros(types, np.int64)
                each = [[from_places(x[name]) for x in answers or []] for name in ("counts", "codes")]
                counts, flat = (np.concatenate([np.zeros(0, np.int32), *x]) for x in each)
                count[order] = counts
                first[order] = np.cumsum(counts, dtype=np.int64) - counts
                words = np.concatenate([[0], np.cumsum(sizes)])
                # A few texts at a time: all codes of a chunk need not exist at once.
                for low in range(0, len(sizes), 200):
                    high = min(low + 200, len(sizes))
                    some = places[words[low] : words[high]]
                    here = count[some]
                    ends = np.concatenate([[0], np.cumsum(here)])
                    offsets = ends[words[low : high + 1] - words[low]].astype(np.int32)
                    picked = flat[expanded(first[some], here)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[low:high], pa.int64()),
                            pa.ListArray.from_arrays(pa.array(offsets), pa.array(picked)),
                        ],
                        ["doc_id", "codes"],
                    )

    columns = ["doc_ids", "lengths", "numbers", "words", "types", "answers"]
    joined = chunks.join(_answers(parts, coded), "chunk", "left").select(*columns)
    return map_batches(joined, assemble, "doc_id long, codes array<int>")


def decode_texts(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, codes and text for each row of (doc_id, codes)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        table = [
            bytes([int(model.id_to_piece(i)[3:5], 16)])
            if model.is_byte(i)
            else model.id_to_piece(i).replace(MARK, " ").encode()
            for i in range(model.get_piece_size())
        ]
        # A few rows at a time, since codes and texts of a whole batch are large.
        for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
            texts = []
            for codes in batch.column(1):
                found = codes.values.to_numpy().tolist() if codes.is_valid else []
                text = b"".join([table[i] for i in found])
                texts.append(text[1:].decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                ["doc_id", "codes", "text"],
            )

    return map_batches(
        encoded.select("doc_id", "codes"), decode, "doc_id long, codes array<int>, text string"
    )
