"""Exact top-k inner products by norm-bucketed retrieval (operator 1)."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import flat_slices, name, saved, table
from .vectors import pack, unpack, usable

TILE, QUERIES = 4096, 2048  # rows of a tile of candidates, of a block of queries
SEED_ROWS = 8192  # so many of the longest candidates give the first thresholds
STEP = 1.05  # lengths within a bucket differ by this factor at most
COORDINATE = 0.45  # local cosine threshold from which a bucket is pruned by a coordinate rather than by length


def best_k(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def search_tile(key: tuple, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of a tile for each query of a block, without those that score below the query's threshold.

    With t = threshold / (query's length x longest length here): above 1 the bucket is skipped; from COORDINATE on, the
    query's largest coordinate f bounds that of a candidate at cosine t or more, and rows are taken from that range of
    the sorted coordinate; else the rows that are long enough are taken. Products are exact."""
    dimension = int(key[0])
    queries, tile = rows[rows.is_query], rows[~rows.is_query]
    empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
    if not len(queries) or not len(tile):
        return empty
    c, q = unpack(tile.vector.tolist(), dimension), unpack(queries.vector.tolist(), dimension)
    ids, own = tile.vec_id.to_numpy(), queries.vec_id.to_numpy()
    exact = dimension * np.abs(c).max(initial=0) * np.abs(q).max(initial=0) < 2.0**53
    if not exact:
        c, q = np.array([[int(v) for v in r] for r in c], dtype=object).reshape(c.shape), np.array([[int(v) for v in r] for r in q], dtype=object).reshape(q.shape)
    floats = c.astype(float)
    length = np.sqrt((floats * floats).sum(axis=1))
    order = np.argsort(-length, kind="stable")
    c, ids, length, floats = c[order], ids[order], length[order], floats[order]
    qf = q.astype(float)
    q_length = np.sqrt((qf * qf).sum(axis=1))
    threshold = queries.threshold.to_numpy(dtype=float)  # minus infinity where there is none
    reach = q_length * length[0] * (1 + 1e-9)
    local = np.where(threshold <= 0, -1.0, threshold / np.maximum(reach, 1e-300))
    unit = floats / np.maximum(length, 1e-300)[:, None]
    sorted_by: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def take(i: int, places: np.ndarray, scores: np.ndarray) -> None:
        some = (scores >= threshold[i]) & (ids[places] != own[i])
        places, scores = places[some], scores[some]
        top = best_k(scores.astype(float) if exact else scores, ids[places], k)
        out.append((np.full(len(top), own[i]), ids[places[top]], scores[top]))

    by_length = []
    for i in np.flatnonzero(local <= 1).tolist():
        if local[i] < COORDINATE:
            by_length.append(i)
            continue
        f = int(np.abs(qf[i]).argmax())
        if f not in sorted_by:
            places = np.argsort(unit[:, f], kind="stable")
            sorted_by[f] = places, unit[places, f]
        places, values = sorted_by[f]
        at, t = qf[i, f] / q_length[i], local[i]
        room = np.sqrt(max(0.0, 1 - t * t) * max(0.0, 1 - at * at)) + 1e-9
        low = -1.0 if at <= 0 and -at >= t else -2.0
        lo = max(low, at * t - room) if at * t - room > -1 and -at < t else -2.0
        hi = at * t + room if at < t else 2.0
        some = places[np.searchsorted(values, lo, "left") : np.searchsorted(values, hi, "right")]
        if 4 * len(some) > len(c):
            by_length.append(i)
        else:
            take(i, some, c[some] @ q[i])
    for at in range(0, len(by_length), 256):
        part = by_length[at : at + 256]
        least = np.where(threshold[part] > 0, threshold[part] / np.maximum(q_length[part], 1e-300) * (1 - 1e-9), 0.0)
        counts = np.searchsorted(-length, -least, "right")
        scores = c[: counts.max(initial=0)] @ q[part].T
        for k_, i in enumerate(part):
            take(i, np.arange(counts[k_]), scores[: counts[k_], k_])
    if not out:
        return empty
    columns = [np.concatenate([o[n] for o in out]) for n in range(3)]
    limit = 2**63 - 1
    score = columns[2].astype("int64") if exact else np.array([max(-limit - 1, min(limit, int(v))) for v in columns[2]], dtype="int64")
    return pd.DataFrame({"query_id": columns[0].astype("int64"), "vec_id": columns[1].astype("int64"), "score": score})


def top_products(vectors: DataFrame, is_query: F.Column, k: int, id_column: str = "vec_id", vector: str = "embedding", scale: float = 64.0) -> DataFrame:
    """query_id, rank, vec_id, score of the k highest inner products of floor(scale x component) for each query row,
    against all other rows; ties to smaller ids, all rows where there are fewer than k.

    Candidates are grouped by length into buckets and these into tiles; blocks of queries meet the tiles of the longest
    buckets first, whose k-th score is each query's threshold, and then the buckets that can still reach it. Null ids,
    and vectors null or with null or non-finite components, take no part; only vectors of equal length meet. Repeated
    rows are candidates each, but a query's own id never is one. Sums that no bigint holds are set to its limit. Other
    columns are not looked at.
    """
    source = vectors.select(vectors[name(id_column)].alias("vec_id"), vectors[name(vector)].cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    source = source.where(usable("v") & F.col("vec_id").isNotNull())

    def start():
        def make(ids, vectors_, flags):
            out: list[list] = [[] for _ in range(6)]
            by: dict[int, list[int]] = {}
            for n, v in enumerate(vectors_):
                by.setdefault(len(v), []).append(n)
            for dimension, rows in by.items():
                x = np.floor(scale * np.array([vectors_[n] for n in rows], dtype=float)).reshape(len(rows), dimension) + 0.0
                length = np.sqrt((x * x).sum(axis=1))
                bucket = np.floor(np.log(np.maximum(length, 0.5)) / np.log(STEP)).astype(int)
                for n, values in zip(rows, zip(bucket.tolist(), length.tolist(), pack(x), strict=True), strict=True):
                    for kept, value in zip(out, (ids[n], flags[n], dimension, *values), strict=True):
                        kept.append(value)
            return out

        return make

    packed = saved(flat_slices(source, {"vec_id": "bigint", "is_query": "boolean", "dimension": "int", "bucket": "int", "length": "double", "vector": "binary"}, start))
    # Buckets are bounded: 1,460 powers of STEP a decade of lengths at most, for each dimension.
    found = packed.groupBy("dimension", "bucket").agg(F.count("*").alias("rows"), F.max("length").alias("longest")).collect()
    query_rows = {r.dimension: r.n for r in packed.where("is_query").groupBy("dimension").agg(F.count("*").alias("n")).collect()}
    spark = vectors.sparkSession
    plan, tiles, seen = [], {}, {}
    for r in sorted(found, key=lambda r: (r.dimension, -r.bucket)):
        n = -(-r.rows // TILE)
        seed = seen.get(r.dimension, 0) < SEED_ROWS
        first = tiles.get(r.dimension, 0)
        # Of a bucket that holds more than the seed rows, that many tiles are seeds.
        seeds = min(n, -(-(SEED_ROWS - seen.get(r.dimension, 0)) // TILE)) if seed else 0
        plan.append((r.dimension, r.bucket, first, n, first + seeds, r.longest))
        tiles[r.dimension] = first + n
        seen[r.dimension] = seen.get(r.dimension, 0) + seeds * TILE
    schema = "query_id bigint, vec_id bigint, score bigint"
    if not plan or not query_rows:
        return spark.createDataFrame([], schema).select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    buckets = spark.createDataFrame(plan, "dimension int, bucket int, first int, tiles int, unseeded int, longest double")
    blocks = spark.createDataFrame([(d, -(-n // QUERIES), tiles[d]) for d, n in query_rows.items()], "dimension int, blocks int, all_tiles int")
    tile = F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("tiles")).cast("int")
    candidates = packed.join(F.broadcast(buckets), ["dimension", "bucket"]).join(F.broadcast(blocks), "dimension")
    candidates = candidates.select("vec_id", "dimension", "bucket", "vector", "longest", "blocks", tile.alias("tile"), (tile < F.col("unseeded")).alias("seed"))
    queries = packed.where("is_query").join(F.broadcast(blocks), "dimension").select("vec_id", "dimension", "vector", "length", "all_tiles", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("q"))
    no = F.lit(float("-inf"))

    def search(rows: DataFrame) -> DataFrame:
        return rows.groupBy("dimension", "q", "tile").applyInPandas(lambda key, pdf: search_tile(key, pdf, k), schema)

    def sent(part: DataFrame) -> DataFrame:
        return part.select("dimension", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("q"), "tile", F.lit(False).alias("is_query"), "vec_id", "vector", no.alias("threshold"), "longest")

    # Seeds meet every block of queries; they are a bounded number of rows.
    seed_tiles = candidates.where("seed").groupBy("dimension", "tile").agg(F.max("longest").alias("longest"))
    rest_tiles = candidates.where("not seed").groupBy("dimension", "tile").agg(F.max("longest").alias("longest"))
    body = ["dimension", "q", "tile", "is_query", "vec_id", "vector", "threshold"]
    asked = queries.join(seed_tiles, "dimension").select("dimension", "q", "tile", F.lit(True).alias("is_query"), "vec_id", "vector", no.alias("threshold"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = saved(search(sent(candidates.where("seed")).select(*body).unionByName(asked)).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
    thresholds = first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("threshold")).dropDuplicates(["vec_id"])
    # Scores beyond 2^53 are rounded as doubles: the threshold is set a little lower, so that none is lost.
    known = queries.drop("q").join(thresholds, "vec_id", "left").withColumn("threshold", F.coalesce(F.col("threshold") - F.abs("threshold") * 1e-15, no))
    least = F.when((F.col("threshold") > 0) & (F.col("length") > 0), F.col("threshold") / F.col("length") * (1 - 1e-9)).otherwise(0.0)
    # Queries that need candidates of like length form a block, so that the least of a block prunes for all of it.
    known = known.withColumn("least", least).repartitionByRange(sum(-(-n // QUERIES) for n in query_rows.values()), "dimension", "least", "vec_id")
    known = saved(known.withColumn("part", F.spark_partition_id()))
    # Neighbouring ranges make up a block until it has QUERIES, however many ranges there are.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = known.groupBy("part").agg(F.count("*").alias("n")).select("part", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / QUERIES).cast("int").alias("q"))
    known = known.join(saved(ranges), "part").drop("part")
    reach = known.groupBy("dimension", "q").agg(F.min("least").alias("least"))  # lengths below cannot reach any query of the block
    # Which block needs which bucket is settled on one row each; only then are candidates sent.
    needs = saved(reach.join(buckets.select("dimension", "bucket", "longest"), "dimension").where("longest >= least").select("dimension", "bucket", "q"))
    needed = candidates.where("not seed").join(needs, ["dimension", "bucket"]).select("dimension", "q", "tile", F.lit(False).alias("is_query"), "vec_id", "vector", no.alias("threshold"))
    asked = known.join(rest_tiles, "dimension").where(F.col("longest") >= F.col("least")).select("dimension", "q", "tile", F.lit(True).alias("is_query"), "vec_id", "vector", "threshold")
    second = search(needed.unionByName(asked))
    ranked = first.select("query_id", "vec_id", "score").unionByName(second).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op1_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)
