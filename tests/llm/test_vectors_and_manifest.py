"""Centroid clustering, exact search and the Merkle manifest against brute force."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from obslake.llm import centroids, integers, merkle, topk

VECTORS = "vec_id long, embedding array<float>, key string, run int, score double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "a", 1, 0.5) for i, v in rows], VECTORS)


def odd_vectors(dims=8, n=300):
    """Clusters, copies, repeated ids and rows, ties, vectors that take no part, large numbers."""
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(6, dims))
    plain = centres[draw.integers(0, 6, n)] + draw.normal(size=(n, dims)) * 0.05
    rows = [(i, plain[i].tolist()) for i in range(n)]
    rows += [(1000 + i, plain[0].tolist()) for i in range(60)]  # copies
    rows += [(20, plain[3].tolist()), (20, plain[20].tolist()), (20, plain[20].tolist())]
    rows += [(2000 + i, [0.0] * dims) for i in range(30)]  # every score is a tie
    rows += [(None, plain[5].tolist()), (3001, None), (3002, []), (3003, [None] * dims)]
    rows += [(3004, [float("nan")] * dims), (3005, [float("inf")] + [0.0] * (dims - 1))]
    rows += [(3006, [0.5] * (dims - 1)), (3020, [1.5] * (dims - 1)), (3007, [1e30] * dims)]
    rows += [(3040, [-(2.0**20)] + [0.25] * (dims - 1)), (-40, [float(2**19)] * dims)]
    return rows


def whole(values, scale, widest):
    if not values or any(x is None or not np.isfinite(x) for x in values):
        return None
    found = [int(np.floor(scale * float(np.float32(x)))) for x in values]
    return found if max(map(abs, found)) <= widest else None


def searched(rows, k, scale=64, modulus=20):
    able = [(i, whole(v, scale, integers.WIDEST)) for i, v in rows if i is not None]
    able = [(i, v) for i, v in able if v is not None and sum(x * x for x in v) <= topk.LONGEST]
    out = []
    for q, (i, left) in enumerate(able):
        if i % modulus:
            continue
        others = [
            (-sum(a * b for a, b in zip(left, right)), j)
            for c, (j, right) in enumerate(able)
            if c != q and len(left) == len(right)
        ]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(others)[:k])]
    return sorted(out)


@pytest.mark.parametrize("run,cells", [(2**18, 64), (64 * 8, 4), (8, 2)])
def test_search_equals_brute_force(spark, monkeypatch, run, cells):
    monkeypatch.setattr(topk, "RUN", run)
    monkeypatch.setattr(topk, "TILE", 64)
    rows = odd_vectors(n=200 if run > 8 else 40)
    found = topk.top_k(vectors(spark, rows), F.pmod("vec_id", F.lit(20)) == 0, k=5, cells=cells)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(row) for row in found.collect()) == searched(rows, 5)


def test_search_of_few_and_no_rows(spark):
    is_query = F.pmod("vec_id", F.lit(20)) == 0
    assert topk.top_k(vectors(spark, []), is_query).isEmpty()
    assert topk.top_k(vectors(spark, [(0, [1.0])]), is_query).isEmpty()
    rows = [(0, [1.0, 2.0]), (1, [1.0, 0.0]), (40, [0.5, -1.0])]
    found = topk.top_k(vectors(spark, rows), is_query, k=20)
    assert sorted(tuple(row) for row in found.collect()) == searched(rows, 20)


def test_bounds_hold_and_search_stops_early():
    draw = np.random.default_rng(3)
    for widest in (40, 2**27):
        values = draw.integers(-widest, widest, (500, 16))
        queries = draw.integers(-widest, widest, (7, 16)).astype(np.float64)
        inner = np.unique(np.quantile(values, np.arange(1, 16) / 16, method="lower"))
        edges = np.r_[values.min(), inner, values.max() + 1].astype(np.int64)
        edges = np.unique(edges)
        cells = integers.cells_of(values, edges).astype(np.uint8)
        assert (edges[:-1][cells] <= values).all() and (values < edges[1:][cells]).all()
        lower, upper = topk.bounds(queries, cells, edges)
        exact = integers.products(queries, values.astype(np.float64))
        whole_numbers = np.array([[int(a) for a in row] for row in queries], object) @ (
            values.astype(object).T
        )
        assert (exact == whole_numbers).all()
        assert (lower <= exact).all() and (exact <= upper).all()
        ids = np.arange(500)
        for q, row in enumerate(queries):
            kept = topk.best_lower(lower[q : q + 1], ids, 3)[0]
            plain = sorted(range(500), key=lambda i: (-lower[q, i], i))[:3]
            assert sorted(kept.tolist()) == sorted(plain)
            floor, floor_id = sorted((lower[q, i], -i) for i in kept)[0]
            at, scores, read = topk.search(
                row, upper[q], floor, -floor_id, ids, values.astype(np.float64), 3
            )
            best = sorted(range(500), key=lambda i: (-exact[q, i], i))[:3]
            assert at.tolist() == best and scores.tolist() == exact[q, best].tolist()
            assert read < 500


def clustered(rows, k, rounds, scale=256, size=8, seed=2):
    able = [(i, whole(v, scale, centroids.WIDEST)) for i, v in rows]
    able = [(i, v) for i, v in able if v is not None and len(v) == size]
    named = [(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in able if i is not None]
    named.sort(key=lambda x: (x[0], np.array(x[1], "<i4").tobytes()))
    means = [v for _, v in named[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(means))

    for _ in range(rounds):
        members = {}
        for _, v in able:
            members.setdefault(near(v)[1], []).append(v)
        for c, vs in members.items():
            means[c] = [sum(column) // len(vs) for column in zip(*vs)]
    found = [(i, *near(v)[::-1]) for i, v in able]
    return sorted(found, key=repr), means


@pytest.mark.parametrize("block,k", [(256, 7), (16, 7), (16, 1000)])
def test_clusters_equal_brute_force(spark, monkeypatch, block, k):
    monkeypatch.setattr(centroids, "BLOCK", block)
    rows = odd_vectors(n=200)
    assigned, means = centroids.cluster_vectors(vectors(spark, rows), k=k, rounds=3, size=8)
    expected, plain = clustered(rows, k, 3)
    assert means.tolist() == plain
    assert sorted((tuple(row) for row in assigned.collect()), key=repr) == expected
    facts = centroids.with_cluster_facts(assigned, means).collect()
    assert len(facts) == len(expected)
    for row in facts:
        own = [d for _, c, d in expected if c == row.cluster]
        digest = hashlib.sha256(",".join(map(str, plain[row.cluster])).encode()).hexdigest()
        assert row.cluster_inertia == sum(own) and row.centroid_sha256 == digest
        assert row.inertia == sum(d for _, _, d in expected)


def test_clusters_of_no_rows(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        assigned, means = centroids.cluster_vectors(vectors(spark, rows), k=3, size=8)
        assert centroids.with_cluster_facts(assigned, means).isEmpty()


def test_boxes_rule_out_only_centroids_that_are_never_nearest():
    draw = np.random.default_rng(8)
    ruled_out = 0
    for spread in (1, 30, 400):
        for _ in range(30):
            middle = draw.integers(-300, 300, 16)
            values = (middle + draw.integers(-spread, spread + 1, (64, 16))).astype(np.float64)
            means = draw.integers(-300, 300, (12, 16))
            means[3] = means[7]  # a tie, for the smaller
            low, high = values.min(axis=0).astype(np.int64), values.max(axis=0).astype(np.int64)
            cluster, distance, able = centroids.assign_block(values, low, high, means)
            plain = ((values[:, None, :] - means[None]) ** 2).sum(axis=2)
            assert (cluster == plain.argmin(axis=1)).all()
            assert (distance == plain.min(axis=1)).all()
            ruled_out += 12 - able
    assert ruled_out > 100


def test_blocks_along_the_curve_need_fewer_comparisons(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK", 32)
    rows = [(i, v) for i, v in odd_vectors(n=2000) if i is not None and i < 2000 and len(v) == 8]
    read = integers.read_whole(vectors(spark, rows), 256, 8)
    blocks = centroids.zone_maps(read)
    assert sum(len(row.ids) for row in blocks.collect()) == len(rows)
    _, compared = centroids.fit(blocks, centroids.first_centroids(read, 12, 2), 2)
    assert all(n < 0.7 * 12 * len(rows) for n in compared)


def test_the_curve_steps_to_a_neighbour():
    """Cells in the order of their keys differ by one step in one component."""
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        axes = np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")
        cells = np.stack([axis.ravel() for axis in axes], axis=1)
        keys = centroids.hilbert_keys(cells, bits)
        assert len(set(keys)) == len(cells)
        along = cells[sorted(range(len(cells)), key=keys.__getitem__)]
        assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, pos int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return sha("".join(fields))


def plain_tree(hashes):
    """The root, and for each leaf its siblings, level by level."""
    level = [(h, [i]) for i, h in enumerate(hashes)]
    proofs = [""] * len(hashes)
    while len(level) > 1:
        above = []
        for start in range(0, len(level), 3):
            run = level[start : start + 3]
            for h, members in run:
                others = "".join(x for x, m in run if m is not members)
                for i in members:
                    proofs[i] += others
            above.append((sha("".join(h for h, _ in run)), [i for _, m in run for i in m]))
        level = above
    return level[0][0], proofs


def odd_docs():
    rows = [(i, f"s{i % 4}" if i % 3 else "s0", "en", i, f"text {i}\n") for i in range(60)]
    rows += [(7, "s1", "en", 7, "other"), (None, "s1", None, None, None), (8, None, "de", 0, "")]
    rows += [(8, None, "de", 0, ""), (9, "", "de", 0, "é\n😀" * 9000), (10, "-", None, 1, "\n")]
    rows += [(-5, "alone", "xx", 1, "a"), (11, "é", "xx", 1, "b"), (None, None, None, None, None)]
    return rows


def plain_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops, found = [], []
    for name in names:
        ordered = sorted(
            groups[name], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r))
        )
        subroot, ways = plain_tree([plain_leaf(row) for row in ordered])
        tops.append((subroot, ordered, ways))
    root, upper = plain_tree([subroot for subroot, _, _ in tops])
    for (subroot, ordered, ways), rest in zip(tops, upper):
        for row, way in zip(ordered, ways):
            found.append((row[0], row[1], plain_leaf(row), subroot, root, sha(way + rest)))
    return sorted(found, key=repr)


def made_manifest(spark, rows, **options):
    docs = spark.createDataFrame([(*row, "x", 3) for row in rows], DOCS)
    return merkle.manifest(docs, **options)


def test_manifest_equals_a_plain_one(spark):
    rows = odd_docs()
    found = made_manifest(spark, rows).select(
        "doc_id", "source", "leaf", "subroot", "root",
        F.sha2(merkle.proof_text(F.col("path")), 256),
        (merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"),
    ).collect()
    assert all(row.ok for row in found)
    assert sorted((tuple(row[:6]) for row in found), key=repr) == plain_manifest(rows)


def test_manifest_of_no_and_of_one_row(spark):
    assert made_manifest(spark, []).isEmpty()
    (row,) = made_manifest(spark, [(1, "a", "en", 1, "x")]).collect()
    assert row.leaf == row.subroot == row.root and row.path == []


def test_a_changed_leaf_gives_another_root(spark):
    rows = odd_docs()
    without = F.replace("text", F.lit("\n"), F.lit(""))
    changed = merkle.leaf_hash(["doc_id", "source", "lang", "n_chars", without])
    made = made_manifest(spark, rows, keep={"changed": changed, "text": F.col("text")})
    for row in made.withColumn("up", merkle.fold(F.col("changed"), F.col("path"))).collect():
        assert (row.up == row.root) == ("\n" not in (row.text or ""))


def test_remainders_are_of_the_decimal_id(spark):
    from obslake.llm.common import id_remainder

    ids = spark.range(0, 400).select(F.col("id").alias("doc_id"))
    for row in ids.withColumn("odd", id_remainder(2)).collect():
        assert row.odd == zlib.crc32(str(row.doc_id).encode()) % 2
