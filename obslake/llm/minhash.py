"""Near-duplicates by a chosen-path set similarity join over word shingles.

A document is the set of its shingles of consecutive words; two are linked when the
intersection has at least a given share of the union. Texts of equal words are one text
from the start. Each text gets a signature of minwise hashes. In each of several trees a
node sends its texts on to children named by the minwise tokens at a few positions that
the node's name chooses, so similar texts tend to share children. Nodes of bounded size
are compared exhaustively; larger ones branch again. A node that branching does not
shrink (a group of near copies) is compared in blocks, and then all its texts that are
still in different classes are compared, so its size is not capped and its work grows
with what differs in it. Pairs whose signatures agree closely are confirmed on the full
sets. A pair that meets in several nodes is compared in the first of them only. Within a
comparison, only links that join two classes are reported: as many as texts, not as
pairs, and no class is lost.

A pair at the least similarity shares no node with a probability below 1e-6 (see
``CHOSEN`` and ``TREES``), and is missed by its signatures with one of about 1e-5.

Words are separated by ASCII white space, with A-Z in lower case. Texts with fewer words
than a shingle have their whole sequence as the only one. Null, empty and blank texts
have no shingles and link with nothing, not even with each other. Repeated rows are
copies and share a component. A row with a null doc_id links with nothing: its
component_id is null and kept is true. Extra columns are ignored. An empty table gives
an empty result. Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import as_bytes, components, map_batches, map_groups, stored

#: Minwise hashes of a signature.
POSITIONS = 64
#: Trees, and positions that a node chooses. A pair of similarity s shares a child of a
#: node with probability 1 - (1 - s) ** CHOSEN: 0.98 for 0.85, in each of TREES trees.
TREES, CHOSEN = 4, 2
#: Texts of a node that are compared in one task.
LEAF = 4096
#: A node branches again while its children have at most this share of it.
SHRINKS = 0.5
#: Levels after which every node left is compared.
DEPTH = 6

_seed = np.random.default_rng(20240229)
_MULTIPLY = _seed.integers(1, 2**63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _seed.integers(0, 2**63, POSITIONS, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    mixed = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        mixed = (mixed ^ hashes[i : len(hashes) - size + 1 + i]) * _MIX
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least of each position's hashes of the shingles, 32 bits each."""
    least = np.full(POSITIONS, 2**32 - 1, np.uint32)
    for start in range(0, len(shingles), 4096):
        part = shingles[start : start + 4096]
        for i in range(POSITIONS):
            value = ((part * _MULTIPLY[i] + _ADD[i]) >> np.uint64(32)).min()
            if value < least[i]:
                least[i] = value
    return least


def _describe(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_key (128 bits of the words), n_shingles and signature of each row."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts, signatures = [], [], []
            for text in as_bytes(batch.column(1)):
                words = words_of(text)
                shingles = shingle_set(words, size)
                counts.append(len(shingles))
                keys.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                signatures.append(signature(shingles).tobytes() if words else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(keys, pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.array(signatures, pa.binary()),
                ],
                ["doc_id", "text_key", "n_shingles", "signature"],
            )

    schema = "doc_id long, text_key binary, n_shingles long, signature binary"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(rows, describe, schema)


def _children(members: DataFrame) -> DataFrame:
    """(node, parent_size, id) of the children to which (node, size, id, signature) go on."""

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            packed = batch.column(3).to_pylist()
            ids, sizes = batch.column(2).to_numpy(), batch.column(1).to_numpy()
            values = np.frombuffer(b"".join(packed), np.uint32).reshape(-1, POSITIONS)
            names = nodes.view(np.uint64) if nodes.dtype == np.int64 else nodes.astype(np.uint64)
            rows = np.arange(len(values))
            # The node's name is a stream of random bits; its positions come from it.
            drawn = names * _MIX
            drawn ^= drawn >> np.uint64(31)
            first = (drawn >> np.uint64(7)) % np.uint64(POSITIONS)
            step = (drawn >> np.uint64(40)) % np.uint64(POSITIONS - 1) + np.uint64(1)
            for i in range(CHOSEN):
                at = ((first + np.uint64(i) * step) % np.uint64(POSITIONS)).astype(np.int64)
                child = (drawn ^ (at.astype(np.uint64) << np.uint64(32))) + values[rows, at]
                child = (child ^ (child >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                child = (child ^ (child >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((child ^ (child >> np.uint64(31))).view(np.int64)),
                        pa.array(sizes),
                        pa.array(ids),
                    ],
                    ["node", "parent_size", "id"],
                )

    rows = members.select("node", "size", "id", "signature")
    return map_batches(rows, branch, "node long, parent_size long, id long")


def _sized(children: DataFrame) -> DataFrame:
    """Children with at least two texts, and how many."""
    sizes = children.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return children.join(sizes, "node")


def _nodes(texts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(node, id) of the nodes to compare, and (node, id, size) of those too large for that."""
    trees = F.array(*[F.lit(7919 * (tree + 1)).cast("long") for tree in range(TREES)])
    everything = F.lit(2**62).cast("long").alias("size")
    root = texts.select(F.explode(trees).alias("node"), everything, "id", "signature")
    level = stored(_sized(_children(root)), "nodes")
    small, stuck = [], []
    for depth in range(1, DEPTH + 1):
        small.append(level.where(F.col("size") <= LEAF).select("node", "id"))
        large = level.where(F.col("size") > LEAF)
        if large.isEmpty():
            break
        ends = (F.col("size") > SHRINKS * F.col("parent_size")) | F.lit(depth == DEPTH)
        stuck.append(large.where(ends).select("node", "id", "size"))
        branching = large.where(~ends)
        if depth == DEPTH or branching.isEmpty():
            break
        members = branching.select("node", "size", "id").join(texts, "id")
        level = stored(_sized(_children(members)), "nodes")
    return _all_of(small), _all_of(stuck) if stuck else None


def _all_of(parts: list[DataFrame]) -> DataFrame:
    together = parts[0]
    for part in parts[1:]:
        together = together.unionAll(part)
    return together


def _blocks(stuck: DataFrame) -> DataFrame:
    """(node, id): each large node in blocks of about LEAF texts."""
    blocks = F.ceil(F.col("size") / LEAF)
    block = F.pmod(F.xxhash64("id", "node"), blocks)
    return stuck.select(F.xxhash64("node", block).alias("node"), "id")


def _between_classes(stuck: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, id): groups in which all texts of different classes of a large node meet.

    Texts of one class need not meet again. So those of a node's largest class meet only
    the others: nothing is left where all are one class, and otherwise the rows grow with
    the node as long as the others fit in a block.
    """
    half = LEAF // 2
    placed = (
        stuck.join(classes, "id", "left")
        .withColumn("class", F.coalesce("component_id", "id"))
        .select("node", "id", "class", "size")
    )
    largest = (
        placed.groupBy("node", "class", "size")
        .count()
        .groupBy("node", "size")
        .agg(F.max(F.struct("count", "class")).alias("top"))
        .select(
            "node",
            F.col("top.class").alias("main"),
            F.ceil(F.col("top.count") / half).alias("main_blocks"),
            F.ceil((F.col("size") - F.col("top.count")) / half).alias("other_blocks"),
        )
        .where("other_blocks > 0")
    )
    in_main = F.col("class") == F.col("main")
    draw = F.xxhash64("id", "node", F.lit(5))
    block = F.when(in_main, F.pmod(draw, "main_blocks")).otherwise(
        F.col("main_blocks") + F.pmod(draw, "other_blocks")
    )
    first = F.when(in_main, F.col("main_blocks")).otherwise(F.lit(0))
    met = F.sequence(first, F.col("main_blocks") + F.col("other_blocks") - 1)
    pairs = (
        placed.join(largest, "node")
        .withColumn("block", block)
        .withColumn("met", F.explode(met))
        .where("block != met")
    )
    low, high = F.least("block", "met"), F.greatest("block", "met")
    return pairs.select(F.xxhash64("node", low, high, F.lit(6)).alias("node"), "id")


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _agreeing(signatures: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j whose signatures agree in at least ``least`` positions, best first."""
    left, right, agree = [], [], []
    for i in range(len(signatures) - 1):
        same = (signatures[i + 1 :] == signatures[i]).sum(axis=1)
        found = np.flatnonzero(same >= least)
        if len(found):
            left.append(np.full(len(found), i))
            right.append(found + i + 1)
            agree.append(same[found])
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(-np.concatenate(agree), kind="stable")
    return np.concatenate(left)[order], np.concatenate(right)[order]


def _met_before(nodes: list, here: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether each pair shares a node that comes before this one."""
    before = [sorted({n for n in known if n < here}) for known in nodes]
    wide = max(map(len, before), default=0)
    found = np.zeros(len(i), bool)
    if not wide:
        return found
    # Unused places hold values that are no node's and differ between the two sides.
    table = np.full((len(before), wide), here, np.int64)
    for row, known in zip(table, before):
        row[: len(known)] = known
    for start in range(0, len(i), 8192):
        a, b = table[i[start : start + 8192]], table[j[start : start + 8192]]
        same = (a[:, :, None] == b[:, None, :]) & (a != here)[:, :, None]
        found[start : start + 8192] = same.any(axis=(1, 2))
    return found


def _pairs_here(group: pa.Table, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a node's texts that agree and meet here first, likeliest first."""
    packed = b"".join(group.column("signature").to_pylist())
    values = np.frombuffer(packed, np.uint32).reshape(-1, POSITIONS)
    i, j = _agreeing(values, least)
    here = group.column("node")[0].as_py()
    new = ~_met_before(group.column("nodes").to_pylist(), here, i, j)
    return i[new], j[new]


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share ``percent`` per cent of their union."""
    if len(x) > len(y):
        x, y = y, x
    if 100 * len(x) < percent * len(y):
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    common = int((y[at] == x).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _classes(count: int, i: np.ndarray, j: np.ndarray) -> dict[int, list[int]]:
    parent = list(range(count))
    for a, b in zip(i.tolist(), j.tolist()):
        a, b = _root(parent, a), _root(parent, b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    found: dict[int, list[int]] = {}
    for k in range(count):
        found.setdefault(_root(parent, k), []).append(k)
    return found


def _links(
    docs: DataFrame, signatures: DataFrame, groups: DataFrame, size: int, percent: int
) -> DataFrame:
    """(a, b): confirmed links that join the classes of each group, by exhaustive comparison.

    A group's texts are first split into classes whose signatures agree; most groups end
    there. The full sets are made again from the texts, for the texts that are left.
    """
    share = percent / 100
    least = int(np.floor(POSITIONS * (share - 4.3 * np.sqrt(share * (1 - share) / POSITIONS))))

    def refine(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        ids = group.column("id").to_numpy()
        i, j = _pairs_here(group, least)
        found = [(ids[root], k) for root, k in _classes(len(ids), i, j).items() if len(k) > 1]
        names = [root for root, k in found for _ in k]
        members = [ids[m] for _, k in found for m in k]
        return pa.table(
            {
                "node": pa.array([group.column("node")[0].as_py()] * len(members), pa.int64()),
                "root": pa.array(names, pa.int64()),
                "id": pa.array(members, pa.int64()),
            }
        )

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(words_of(t), size).tobytes() for t in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.binary())], ["id", "shingles"]
            )

    def confirm(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        ids = group.column("id").to_pylist()
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in group.column("shingles")]
        parent = list(range(len(ids)))
        left, right = [], []
        i, j = _pairs_here(group, least)
        for a, b in zip(i.tolist(), j.tolist()):
            root_a, root_b = _root(parent, a), _root(parent, b)
            if root_a != root_b and similar(sets[a], sets[b], percent):
                parent[max(root_a, root_b)] = min(root_a, root_b)
                left.append(ids[a])
                right.append(ids[b])
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    places = groups.groupBy("id").agg(F.collect_set("node").alias("nodes"))
    posted = stored(places.join(signatures, "id"), "posted")
    candidates = posted.withColumn("node", F.explode("nodes"))
    refined = map_groups(
        candidates.select("node", "id", "nodes", "signature"),
        ["node"],
        refine,
        "node long, root long, id long",
    )
    agreed = stored(refined, "agreed")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string"))
    needed = rows.join(agreed.select("id").distinct(), "id", "left_semi")
    sets = map_batches(needed, shingle, "id long, shingles binary").dropDuplicates(["id"])
    full = sets.join(posted, "id")
    members = agreed.join(full, "id").select("node", "root", "id", "nodes", "signature", "shingles")
    return stored(map_groups(members, ["node", "root"], confirm, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of (doc_id, text).

    ``component_id`` is the smallest doc_id reachable over links of at least ``percent``
    per cent; the row with that id is kept.
    """
    described = stored(_describe(docs, size), "signatures")
    texts = stored(
        described.where("text_key is not null and doc_id is not null")
        .groupBy("text_key")
        .agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature")),
        "texts",
    )
    signatures = texts.select("id", "signature")
    small, stuck = _nodes(signatures)
    groups = small if stuck is None else small.unionAll(_blocks(stuck))
    links = _links(docs, signatures, groups, size, percent)
    classes = components(links)
    if stuck is not None:
        rest = stored(_between_classes(stuck, classes), "rest")
        if not rest.isEmpty():
            classes = components(links.unionAll(_links(docs, signatures, rest, size, percent)))
    of_text = (
        texts.select("text_key", F.col("id").alias("text_id"))
        .join(classes.withColumnRenamed("id", "text_id"), "text_id", "left")
        .select("text_key", F.coalesce("component_id", "text_id").alias("component_id"))
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (
        described.drop("signature")
        .join(of_text, "text_key", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
