"""Packing of token pieces into sequences of fixed length.

First-fit decreasing: pieces by falling length, each into the first bin that has
room. A tournament tree over the bins' free space finds that bin in logarithmic
time. Groups of pieces, drawn by hash, are packed independently, so a group is
bounded whatever the size of the corpus.

A null text is empty. Each row is a document of its own, repeated rows included;
each ends with token id 0, so an empty text has one token. Rows of equal length
keep the order of (doc_id, start, ids_crc32). Extra columns are ignored. An empty
table gives an empty result. A null doc_id is kept.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import as_bytes, map_batches, map_groups, stored

SEQUENCE = 1024
#: Pieces that are packed together; waste falls with it, a task's work grows.
GROUP = 8192

#: Fixed value: how byte-level vocabularies of this kind split a text before merging.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for the 256 bytes: visible Latin-1
    characters stand for themselves, the others for the code points from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [byte for byte in range(256) if byte not in visible]
    return {chr(byte): byte for byte in visible} | {
        chr(256 + i): byte for i, byte in enumerate(hidden)
    }


_encodings: dict[str, object] = {}


def _encoding(vocabulary: str):
    """An encoder over the ranks of a byte-level tokenizer file.

    Its ids equal the tokenizer's (a test compares them) at a fifth of the cost. The name of
    a special token inside a text is that token.
    """
    if vocabulary not in _encodings:
        import tiktoken
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        added = tokenizer.get_added_tokens_decoder()
        letters = _byte_letters()
        ranks = {
            bytes(letters[letter] for letter in token): rank
            for token, rank in tokenizer.get_vocab(with_added_tokens=False).items()
            if rank not in added
        }
        _encodings[vocabulary] = tiktoken.Encoding(
            "ranks",
            pat_str=_SPLIT,
            mergeable_ranks=ranks,
            special_tokens={token.content: rank for rank, token in added.items()},
        )
    return _encodings[vocabulary]


def token_bytes(text: bytes, vocabulary: str) -> bytes:
    """The ids of a text, four bytes each, little-endian."""
    ids = _encoding(vocabulary).encode(text.decode("utf-8", "replace"), allowed_special="all")
    return array("I", ids).tobytes()


def token_pieces(docs: DataFrame, vocabulary: str, sequence: int = SEQUENCE) -> DataFrame:
    """The tokens of each document, cut into pieces of at most ``sequence`` ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                ids = token_bytes(text, vocabulary) + b"\0\0\0\0"
                total = len(ids) // 4
                for start in range(0, total, sequence):
                    part = ids[4 * start : 4 * (start + sequence)]
                    for values, value in zip(
                        rows, (doc_id, start, len(part) // 4, zlib.crc32(part), total)
                    ):
                        values.append(value)
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in rows], names)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(rows, cut, PIECES)


def first_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, taken in the given order."""
    n = len(lengths)
    width = 1
    while width < max(n, 1):
        width *= 2
    room = [capacity] * (2 * width)  # room[1] is the most that any bin has
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    for i, length in enumerate(lengths.tolist()):
        at = 1
        while at < width:
            at *= 2
            if room[at] < length:
                at += 1
        bins[i], offsets[i] = at - width, capacity - room[at]
        room[at] -= length
        at //= 2
        while at:
            left, right = room[2 * at], room[2 * at + 1]
            best = left if left > right else right
            if room[at] == best:
                break
            room[at] = best
            at //= 2
    return bins, offsets


def pack(pieces: DataFrame, sequence: int = SEQUENCE, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset to pieces of at most ``sequence`` ids."""
    pieces = stored(pieces, "pieces")
    groups = max(1, -(-pieces.count() // group))

    def fit(part: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")]
        part = part.sort_by([*order, ("ids_crc32", "ascending")])
        bins, offsets = first_fit(part.column("length").to_numpy(), sequence)
        ids = (part.column("draw").to_numpy().astype(np.int64) << 32) + bins
        return (
            part.drop_columns(["draw"])
            .append_column("sequence_id", pa.array(ids))
            .append_column("offset", pa.array(offsets))
        )

    draw = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.lit(17)), F.lit(groups))
    schema = f"{PIECES}, sequence_id long, offset long"
    return map_groups(pieces.withColumn("draw", draw), ["draw"], fit, schema)


def pack_documents(docs: DataFrame, vocabulary: str, sequence: int = SEQUENCE) -> DataFrame:
    return pack(token_pieces(docs, vocabulary, sequence), sequence)
