"""Embedding near-duplicates by a subspace pigeonhole join (operator 9)."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import connected_components, flat_slices, name, saved, table
from .vectors import pack, unpack, usable

TILE, STRIPE, BATCH = 8192, 512, 50_000  # rows of a tile, of a stripe of its product, candidates verified at once
SLACK = 1e-9


def rotation(dimension: int, seed: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def block_edges(dimension: int, blocks: int) -> list[int]:
    return [dimension * b // min(blocks, dimension) for b in range(min(blocks, dimension) + 1)]


def unit_rows(x: np.ndarray) -> np.ndarray:
    largest = np.abs(x).max(axis=1, keepdims=True)
    x = x / largest
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """parent with the sets of each pair joined; roots are the least members."""
    while True:
        while (up := parent[parent]).tolist() != parent.tolist():
            parent = up
        a, b = parent[a], parent[b]
        apart = a != b
        if not apart.any():
            return parent
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def tile_links(key: tuple, rows: pd.DataFrame, cosine: float, blocks: int, seed: int) -> pd.DataFrame:
    """Links between the left and the right rows of a tile that are due to this block: those whose distance here is
    within its budget and in no earlier block, so that no pair counts twice. Verified by the cosine of whole vectors.
    Out: (a, null, n) n vectors link with a; (a, b, 0) an edge; of edges only a spanning forest."""
    dimension, block = int(key[0]), int(key[1])
    edges = block_edges(dimension, blocks)
    budgets = [2 * (1 - cosine) * (hi - lo) / dimension + SLACK for lo, hi in zip(edges, edges[1:], strict=False)]
    rows = rows.sort_values("rep").drop_duplicates(["rep", "side"])
    left, right = rows[rows.side != 1].reset_index(drop=True), rows[rows.side != 0].reset_index(drop=True)
    if not len(left) or not len(right):
        return pd.DataFrame({"a": [], "b": [], "n": []}).astype("Int64")
    x, y = unit_rows(unpack(left.vector.tolist(), dimension)), unit_rows(unpack(right.vector.tolist(), dimension))
    turn = rotation(dimension, seed)
    p, q = x @ turn, y @ turn
    lo, hi = edges[block], edges[block + 1]
    pb, qb = p[:, lo:hi], q[:, lo:hi]
    p2, q2 = (pb * pb).sum(1), (qb * qb).sum(1)
    ids = np.unique(np.concatenate([left.rep, right.rep]))
    li, ri = np.searchsorted(ids, left.rep), np.searchsorted(ids, right.rep)
    ordered = right.side.to_numpy() == 2  # these stand on both sides of a tile of its own rows
    links, parent = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
    ln, rn = left.n.to_numpy(), right.n.to_numpy()
    for at in range(0, len(left), STRIPE):
        near = p2[at : at + STRIPE, None] + q2[None, :] - 2 * pb[at : at + STRIPE] @ qb.T <= budgets[block] + 1e-6
        flat = np.flatnonzero(near)
        for k in range(0, len(flat), BATCH):
            i, j = flat[k : k + BATCH] // len(right) + at, flat[k : k + BATCH] % len(right)
            some = np.where(ordered[j], li[i] < ri[j], li[i] != ri[j])
            i, j = i[some], j[some]
            some = (x[i] * y[j]).sum(axis=1) >= cosine
            i, j = i[some], j[some]
            gap = (p[i] - q[j]) ** 2
            within = np.stack([gap[:, lo:hi].sum(axis=1) <= budget for (lo, hi), budget in zip(zip(edges, edges[1:], strict=False), budgets, strict=True)], axis=1)
            some = within.argmax(axis=1) == block
            i, j = i[some], j[some]
            np.add.at(links, li[i], rn[j])
            np.add.at(links, ri[j], ln[i])
            parent = unite(parent, li[i], ri[j])
    some, moved = np.flatnonzero(links), np.flatnonzero(parent != np.arange(len(ids)))
    return pd.DataFrame({"a": np.concatenate([ids[some], ids[moved]]), "b": pd.array([None] * len(some) + ids[parent[moved]].tolist(), dtype="Int64"), "n": np.concatenate([links[some], np.zeros(len(moved), dtype=np.int64)])})


def similar_vectors(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", cosine: float = 0.9, blocks: int = 4, seed: int = 9) -> DataFrame:
    """One row for each row of vectors: its id, n_links (other rows at this cosine or more), component_id (smallest id
    reachable by links) and kept (whether that is its own).

    Equal vectors become one class first. Rotated unit vectors are cut into blocks of coordinates; two at squared
    distance d are, in one block at least, within the share of d that is the block's share of the coordinates. Each block
    is range-joined on its first coordinate: cells as wide as that range, each row in its own and in the one below, cells
    dealt in tiles of bounded size. Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, nor do rows with a null id; vectors of different length never link. Repeated rows are vectors of their own.
    Other columns are not looked at.
    """
    source = vectors.select(vectors[name(id_column)].alias("id"), vectors[name(vector)].cast("array<double>").alias("v"))
    fit = usable("v") & F.exists("v", lambda v: v != 0) & F.col("id").isNotNull()
    good = source.where(fit)
    classes = saved(good.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n")))

    def start():
        def make(vectors_, reps, ns):
            out: list[list] = [[] for _ in range(5)]
            by: dict[int, list[int]] = {}
            for k, v in enumerate(vectors_):
                by.setdefault(len(v), []).append(k)
            for dimension, rows in by.items():
                x = np.array([vectors_[k] for k in rows], dtype=float)
                edges = block_edges(dimension, blocks)
                turned = unit_rows(x) @ rotation(dimension, seed)
                widths = np.sqrt(2 * (1 - cosine) * np.diff(edges) / dimension) + 1e-6
                cells = np.floor(turned[:, edges[:-1]] / widths).astype(int).tolist()
                for k, own, body in zip(rows, cells, pack(x), strict=True):
                    for values, v in zip(out, (dimension, own, reps[k], ns[k], body), strict=True):
                        values.append(v)
            return out

        return make

    turned = saved(flat_slices(classes.select("v", "rep", "n"), {"dimension": "int", "cells": "array<int>", "rep": "bigint", "n": "bigint", "vector": "binary"}, start))
    placed = turned.select("dimension", "rep", "n", "vector", F.posexplode("cells").alias("block", "cell"))
    # Cells of a block are at most 2 / width + 2, so that this table is bounded for each dimension.
    sizes = saved(placed.groupBy("dimension", "block", "cell").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")))
    below = sizes.select("dimension", "block", (F.col("cell") + 1).alias("cell"), F.col("tiles").alias("below"))
    rows = placed.join(sizes, ["dimension", "block", "cell"]).join(below, ["dimension", "block", "cell"], "left")
    own = F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")
    rows = rows.withColumn("own", own)
    key = ["dimension", "block", "cell", "i", "j", "kind"]
    body = ["rep", "n", "vector"]
    # Within a cell: tiles (i, j), i <= j; a row is on the left of (own, j) and on the right of (i, own), on both of (own, own).
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    within = rows.select("*", other.alias("t")).select("dimension", "block", "cell", F.least("own", "t").alias("i"), F.greatest("own", "t").alias("j"), F.lit(0).alias("kind"), F.when(F.col("own") == F.col("t"), 2).when(F.col("own") < F.col("t"), 0).otherwise(1).alias("side"), *body)
    # Between a cell and the next: left rows of it, right rows of the next.
    above = sizes.select("dimension", "block", (F.col("cell") - 1).alias("cell"), F.col("tiles").alias("above"))
    lefts = rows.join(above, ["dimension", "block", "cell"]).select("*", F.explode(F.sequence(F.lit(0), F.col("above") - 1)).alias("t")).select("dimension", "block", "cell", F.col("own").alias("i"), F.col("t").alias("j"), F.lit(1).alias("kind"), F.lit(0).alias("side"), *body)
    rights = rows.where("below is not null").select("*", F.explode(F.sequence(F.lit(0), F.col("below") - 1)).alias("t")).select("dimension", "block", (F.col("cell") - 1).alias("cell"), F.col("t").alias("i"), F.col("own").alias("j"), F.lit(1).alias("kind"), F.lit(1).alias("side"), *body)
    tiles = within.unionByName(lefts).unionByName(rights)

    def links(k, pdf):
        return tile_links(k, pdf, cosine, blocks, seed)

    found = saved(tiles.groupBy(*key).applyInPandas(links, "a bigint, b bigint, n bigint"))
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("links"))
    components = connected_components(found.where("b is not null").select("a", "b"))
    result = classes.join(counts, classes["rep"] == counts["a"], "left").join(components, classes["rep"] == components["node"], "left")
    result = result.select("v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    joined = good.join(result, "v").select("id", "n_links", "component_id")
    rest = source.where(~fit).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return joined.unionByName(rest).select(F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op9_subspace_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(table(spark, sf_dir, "embeddings"))
