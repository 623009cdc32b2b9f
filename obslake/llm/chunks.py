"""Texts as numbers, in chunks of bounded size with a dictionary each.

A word list of a corpus has no bound, so no task can hold it. A chunk holds some texts
and the words that these use, so what is found out about words elsewhere comes back to a
chunk by a join on words, one row for each word of a chunk and not for each occurrence.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import as_bytes, map_batches, work_dir

#: Words of a chunk, at most, unless a single text has more.
CHUNK_WORDS = 1_000_000

SCHEMA = (
    "doc_ids array<long>, held_out array<boolean>, lengths binary, numbers binary,"
    " words binary, counts binary, types long"
)


def squeeze(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unsqueeze(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def packed(ascending: np.ndarray) -> bytes:
    """Ascending numbers, as the bytes of their differences by place."""
    steps = np.diff(ascending, prepend=np.uint64(0)).astype("<u8")
    return squeeze(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    steps = np.frombuffer(unsqueeze(raw), np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view("<u8").ravel(), dtype=np.uint64)


def by_place(numbers: np.ndarray) -> bytes:
    """32-bit numbers, as their bytes by place."""
    return squeeze(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes())


def from_places(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(raw), np.uint8).reshape(4, -1).T
    return np.ascontiguousarray(planes).view("<i4").ravel()


def expanded(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of slices that begin at ``first``, one slice after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def word_list(packed: bytes) -> list[bytes]:
    """The dictionary of a chunk; its words hold no space."""
    return unsqueeze(packed).split(b" ")


class Numbers(dict):
    """Words numbered in the order in which they are asked for."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def word_chunks(
    docs: DataFrame,
    split: Callable[[bytes], list[bytes]],
    limit: int = CHUNK_WORDS,
    cut: Callable[[bytes], list[bytes]] | None = None,
    store: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Chunks of the rows (doc_id, held_out, text), stored.

    ``lengths`` has the words of each text and ``numbers`` those words one after the
    other, as 32-bit places in ``words``; ``counts`` says how often each word occurs in
    rows that are not held out. All but ``lengths`` are compressed: they are shuffled.
    With ``cut`` it is the parts of the words that are numbered; a word is cut once in a chunk.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ids, held, texts, size = Numbers(), [], [], [], 0

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(t) for t in texts], np.int32)
            numbers, words = np.concatenate(texts), known
            if cut is not None:
                words, flat, ends = Numbers(), array("i"), array("q")
                for word in known:
                    flat.extend(map(words.__getitem__, cut(word)))
                    ends.append(len(flat))
                flat, sizes = np.array(flat), np.diff(np.array(ends), prepend=0)
                taken = sizes[numbers]
                marks = np.concatenate([[0], np.cumsum(taken)])
                lengths = np.diff(marks[np.concatenate([[0], np.cumsum(lengths)])]).astype(np.int32)
                numbers = flat[expanded((np.cumsum(sizes) - sizes)[numbers], taken)]
            learned = np.repeat(~np.array(held, bool), lengths)
            counts = np.bincount(numbers[learned], minlength=len(words))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([held], pa.list_(pa.bool_())),
                    pa.array([lengths.tobytes()], pa.binary()),
                    pa.array([squeeze(numbers.tobytes())], pa.binary()),
                    pa.array([squeeze(b" ".join(words))], pa.binary()),
                    pa.array([squeeze(counts.astype("<i8").tobytes())], pa.binary()),
                    pa.array([len(words)], pa.int64()),
                ],
                ["doc_ids", "held_out", "lengths", "numbers", "words", "counts", "types"],
            )

        for batch in batches:
            rows = zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2))
            )
            for doc_id, kept_out, text in rows:
                words = split(text)
                if texts and size + len(words) > limit:
                    yield flush()
                    known, ids, held, texts, size = Numbers(), [], [], [], 0
                texts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                ids.append(doc_id)
                held.append(kept_out)
                size += len(words)
        if texts:
            yield flush()

    rows = docs.select(
        F.col("doc_id").cast("long"), "held_out", F.col("text").cast("string").alias("text")
    )
    chunks = map_batches(rows, encode, SCHEMA)
    numbered = chunks.withColumn("chunk", F.monotonically_increasing_id())
    return (store or squeezed)(numbered, "chunks")


def squeezed(frame: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """The frame as a table in the shared folder, compressed well."""
    spark = frame.sparkSession
    path = path or work_dir(spark, purpose)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def bucketed(
    frame: DataFrame, purpose: str, key: str = "chunk", path: str | None = None
) -> DataFrame:
    """Like ``squeezed``, in buckets by a key, so that joins on it do not shuffle the frame."""
    spark = frame.sparkSession
    path = path or work_dir(spark, purpose)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = frame.write.bucketBy(buckets, key).option("compression", "zstd").option("path", path)
    writer.saveAsTable(name)
    found = spark.table(name)
    # What was read keeps to its files; the name would stay in the catalog.
    spark.sql(f"DROP TABLE {name}")
    return found
