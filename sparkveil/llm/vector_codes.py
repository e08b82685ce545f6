"""Vectors as short codes by per-dimension value dictionaries (operator 12)."""

import hashlib
import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, name, saved, split_join, table
from .vectors import usable

BLOCK, BLOCK_VALUES = 8192, 1 << 22  # rows and components of a block at most
BLOCKS = "dimension int, ids array<bigint>, labels array<string>, sizes binary, words binary, codes binary"
Books = dict[int, list[np.ndarray]]  # for each length of vectors, an array (entries, width) a part


def part_edges(dimension: int, parts: int) -> list[int]:
    return [dimension * p // parts for p in range(parts + 1)]


def largest_component(dimension: int) -> int:
    """Up to this a sum of squared differences fits in 62 bits."""
    return math.isqrt((1 << 60) // max(dimension, 1))


def integers(vectors: list[list[float]], dimension: int, scale: int) -> np.ndarray:
    """floor(scale * x) of vectors whose components all fit, and which those are."""
    x = np.floor(np.array(vectors, dtype=float).reshape(len(vectors), dimension) * scale)
    fits = (np.abs(x) <= largest_component(dimension)).all(axis=1)
    return np.where(fits[:, None], x, 0).astype(np.int64), fits


def dictionary_block(ids: list, labels: list, x: np.ndarray) -> list:
    """Rows as one block: for each dimension its distinct integers in order, and for each row their places."""
    sizes, words, codes = [], [], []
    for column in x.T:
        distinct, places = np.unique(column, return_inverse=True)
        sizes.append(len(distinct))
        words.append(distinct.astype("<i8").tobytes())
        codes.append(places.astype("<u2").tobytes())
    return [x.shape[1], ids, labels, np.array(sizes, dtype="<i4").tobytes(), b"".join(words), b"".join(codes)]


def columns_of(dimension: int, rows: int, sizes: bytes, words: bytes, codes: bytes) -> list[tuple[np.ndarray, np.ndarray]]:
    """(distinct integers, places of the rows in them) of each dimension of a block."""
    ends = np.cumsum(np.frombuffer(sizes, dtype="<i4"))
    every = np.frombuffer(words, dtype="<i8")
    places = np.frombuffer(codes, dtype="<u2").reshape(dimension, rows)
    return [(every[(ends[d - 1] if d else 0) : ends[d]], places[d]) for d in range(dimension)]


def assigned(columns: list[tuple[np.ndarray, np.ndarray]], rows: int, book: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first dimension, index of the nearest entry, squared distance to it) of each part. For a dimension the squared
    differences of each distinct integer to all entries are tabulated once; the distances of parts are gathered from the
    tables by the dictionary codes and added."""
    at = 0
    for entries in book:
        distance = np.zeros((rows, len(entries)), dtype=np.int64)
        for d in range(entries.shape[1]):
            distinct, places = columns[at + d]
            gap = distinct[:, None] - entries[:, d][None, :]
            distance += (gap * gap)[places]
        best = distance.argmin(axis=1)  # ties: the lower index
        yield at, best, distance[np.arange(rows), best]
        at += entries.shape[1]


def blocks(vectors: DataFrame, id_column: str, vector: str, label: str | None, scale: int) -> DataFrame:
    """Usable vectors in dictionary blocks; vectors of each length have blocks of their own."""
    carried = vectors[name(label)].cast("string") if label else F.lit(None).cast("string")
    source = vectors.select(vectors[name(id_column)].cast("bigint").alias("id"), carried.alias("label"), vectors[name(vector)].cast("array<double>").alias("v")).where(usable("v"))
    types = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary()]

    def task(batches):
        for batch in batches:
            by: dict[int, list[int]] = {}
            lengths = batch.column(2).value_lengths().to_pylist()
            for i, n in enumerate(lengths):
                by.setdefault(n, []).append(i)
            for dimension, places in by.items():
                step = max(1, min(BLOCK, BLOCK_VALUES // max(dimension, 1)))
                for at in range(0, len(places), step):
                    part = batch.take(pa.array(places[at : at + step]))
                    x, fits = integers(part.column(2).to_pylist(), dimension, scale)
                    ids, labels = part.column(0).to_pylist(), part.column(1).to_pylist()
                    kept = np.flatnonzero(fits)
                    if len(kept):
                        row = dictionary_block([ids[k] for k in kept], [labels[k] for k in kept], x[kept])
                        yield pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(row, types, strict=True)], names=["dimension", "ids", "labels", "sizes", "words", "codes"])

    return source.mapInArrow(task, BLOCKS)


def over_blocks(found: DataFrame, schema: dict[str, pa.DataType], ddl: str, start: Callable) -> DataFrame:
    """start() gives (take, end): take(dimension, ids, labels, columns) returns lists of output rows' columns or None,
    end() the same for what the task has gathered."""

    def task(batches):
        take, end = start()
        made = lambda out: pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(out, schema.values(), strict=True)], names=list(schema))
        for batch in batches:
            for i in range(batch.num_rows):
                dimension, ids, labels, sizes, words, codes = (batch.column(k)[i].as_py() for k in range(6))
                if (out := take(dimension, ids, labels, columns_of(dimension, len(ids), sizes, words, codes))) is not None:
                    yield made(out)
        if (out := end()) is not None:
            yield made(out)

    return found.mapInArrow(task, ddl)


def first_books(found: DataFrame, parts: int, entries: int) -> Books:
    """The parts of the vectors with the smallest ids, for each length of vectors; null ids come last, equal ids by
    vector. A task keeps and sends no more than the first entries of each length."""

    def start():
        held: dict[int, list[tuple]] = {}

        def take(dimension, ids, labels, columns):
            x = np.stack([distinct[places] for distinct, places in columns], axis=1) if columns else np.zeros((len(ids), 0), dtype=np.int64)
            own = [(i is None, i or 0, v) for i, v in zip(ids, x.tolist(), strict=True)]
            held[dimension] = heapq.nsmallest(entries, held.get(dimension, []) + own)

        def end():
            rows = [(dimension, None if none else i, v) for dimension, some in held.items() for none, i, v in some]
            return [list(c) for c in zip(*rows, strict=True)] if rows else None

        return take, end

    few = over_blocks(found, {"dimension": pa.int32(), "id": pa.int64(), "x": pa.list_(pa.int64())}, "dimension int, id bigint, x array<bigint>", start)
    place = F.row_number().over(Window.partitionBy("dimension").orderBy(F.col("id").asc_nulls_last(), "x"))
    rows = few.withColumn("place", place).where(F.col("place") <= entries).collect()  # entries rows for each length
    out: Books = {}
    for dimension in {r.dimension for r in rows}:
        own = [r.x for r in sorted((r for r in rows if r.dimension == dimension), key=lambda r: r.place)]
        x, edges = np.array(own, dtype=np.int64).reshape(len(own), dimension), part_edges(dimension, parts)
        out[dimension] = [x[:, lo:hi] for lo, hi in zip(edges, edges[1:], strict=False)]
    return out


def improved(found: DataFrame, books: Books) -> Books:
    """One round: each entry becomes the floored mean of the parts that are nearest to it; an unused one stays. Tasks add
    up what they see; the sums of all tasks are added by Spark, and as many numbers as the codebooks hold come back."""

    def start():
        totals: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}

        def take(dimension, ids, labels, columns):
            book = books[dimension]
            if dimension not in totals:
                totals[dimension] = [np.zeros(len(e), dtype=np.int64) for e in book], [np.zeros(e.shape, dtype=np.int64) for e in book]
            counts, sums = totals[dimension]
            for p, (at, best, _) in enumerate(assigned(columns, len(ids), book)):
                k = len(book[p])
                counts[p] += np.bincount(best, minlength=k)
                for d in range(book[p].shape[1]):
                    distinct, places = columns[at + d]
                    sums[p][:, d] += np.bincount(best, weights=distinct[places].astype(float), minlength=k).astype(np.int64)  # exact below 2 ** 53

        def end():
            out: list[list] = [[], [], [], []]
            for dimension, (counts, sums) in totals.items():
                for p, (c, s) in enumerate(zip(counts, sums, strict=True)):
                    for entry in range(len(c)):
                        for values, v in zip(out, (dimension, p, entry, [int(c[entry]), *s[entry].tolist()]), strict=True):
                            values.append(v)
            return out

        return take, end

    each = over_blocks(found, {"dimension": pa.int32(), "part": pa.int32(), "entry": pa.int32(), "sums": pa.list_(pa.int64())}, "dimension int, part int, entry int, sums array<bigint>", start)
    placed = each.select("dimension", "part", "entry", F.posexplode("sums").alias("at", "value"))
    totals = placed.groupBy("dimension", "part", "entry", "at").agg(F.sum("value").alias("value"))
    new = {dimension: [e.copy() for e in book] for dimension, book in books.items()}
    rows = {(r.dimension, r.part, r.entry, r["at"]): r["value"] for r in totals.collect()}
    for (dimension, p, entry, at), value in rows.items():
        n = rows[dimension, p, entry, 0]
        if at and n:
            new[dimension][p][entry, at - 1] = value // n
    return new


def fitted(found: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> Books:
    books = first_books(found, parts, entries)
    for _ in range(rounds):
        books = improved(found, books)
    return books


def encoded(found: DataFrame, books: Books) -> DataFrame:
    """id, label, dimension, code (one byte a part) and error of every vector in the blocks."""

    def start():
        def take(dimension, ids, labels, columns):
            parts = list(assigned(columns, len(ids), books[dimension]))
            codes = np.stack([best for _, best, _ in parts], axis=1).astype(np.uint8)
            error = sum(distance for _, _, distance in parts)
            return [ids, labels, [dimension] * len(ids), [row.tobytes() for row in codes], error.tolist()]

        return take, lambda: None

    return over_blocks(found, {"id": pa.int64(), "label": pa.string(), "dimension": pa.int32(), "code": pa.binary(), "error": pa.int64()}, "id bigint, label string, dimension int, code binary, error bigint", start)


def decoded(code: bytes, book: list[np.ndarray], scale: int = 4096) -> np.ndarray:
    """The vector that a code stands for: its entries, from the middle of their integers."""
    return (np.concatenate([entries[k] for k, entries in zip(code, book, strict=True)]) + 0.5) / scale


def digest(book: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for entries in book for v in entries.ravel().tolist()).encode()).hexdigest()


def vector_codes(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable vector.

    Components become floor(scale * x); vectors are cut into parts, each replaced by its nearest codebook entry. Codebooks
    start from the vectors with the smallest ids and are improved in rounds over all vectors.

    Left out: vectors that are null or hold null or non-finite components, and those with an integer so large that squared
    distances would not fit a long (beyond 2 ** 27 for 64 components). Vectors of each length have codebooks of their own;
    a length that the number of parts does not divide has parts of floor and ceiling width, an empty vector has code 0 and
    no error. With fewer vectors than entries the codebooks are as short. Rows with equal or null ids are vectors of their
    own; null ids count last. label_error is null if it does not fit a long. Other columns are not looked at.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code holds one byte a part")
    found = saved(blocks(vectors, id_column, vector, label, scale))
    books = fitted(found, parts, entries, rounds)
    rows = saved(encoded(found, books).select("*", F.col("label").isNull().alias("none"), F.coalesce("label", F.lit("")).alias("key")))
    discard(found)
    sums = saved(rows.groupBy("none", "key").agg(F.count("*").alias("n"), F.try_sum("error").alias("label_error")))
    prints = {dimension: digest(book) for dimension, book in books.items()}
    shown = F.lit(None).cast("string")
    for dimension, value in prints.items():
        shown = F.when(F.col("dimension") == dimension, F.lit(value)).otherwise(shown)
    # Two digits a part, as hex writes a byte.
    out = split_join(rows, sums, ["none", "key"], rows.count())
    return out.select(F.col("id").alias(id_column), F.lower(F.hex("code")).alias("code"), "error", "label_error", shown.alias("codebooks_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def oracle_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """DuckDB SQL of the query: one common table expression a round."""
    nearest = """SELECT vec_id, part, entry, d FROM (SELECT x.vec_id, x.part, e.entry, sum((x.v - e.v) * (x.v - e.v)) AS d, row_number() OVER (PARTITION BY x.vec_id, x.part ORDER BY sum((x.v - e.v) * (x.v - e.v)), e.entry) AS i
        FROM x JOIN {0} e ON x.part = e.part AND x.pos = e.pos GROUP BY x.vec_id, x.part, e.entry) WHERE i = 1"""
    text = f"""WITH ok AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        x AS MATERIALIZED (SELECT vec_id, (i - 1) // (len(v) // {parts}) AS part, (i - 1) % (len(v) // {parts}) AS pos, floor(4096 * v[i])::BIGINT AS v FROM (SELECT vec_id, v, unnest(range(1, len(v) + 1)) AS i FROM ok)),
        first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM ok QUALIFY entry < {entries}),
        b0 AS MATERIALIZED (SELECT part, entry, pos, v FROM x JOIN first USING (vec_id))"""
    for k in range(rounds):
        text += f""", a{k} AS MATERIALIZED ({nearest.format(f"b{k}")}),
        m{k} AS (SELECT a.part, a.entry, x.pos, sum(x.v) AS s, count(*) AS n FROM a{k} a JOIN x ON x.vec_id = a.vec_id AND x.part = a.part GROUP BY 1, 2, 3),
        b{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, CASE WHEN m.n IS NULL THEN b.v ELSE ((m.s - ((m.s % m.n + m.n) % m.n)) // m.n)::BIGINT END AS v FROM b{k} b LEFT JOIN m{k} m ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos)"""
    return text + f""", a AS ({nearest.format(f"b{rounds}")}),
        c AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a GROUP BY vec_id),
        h AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{rounds})
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM ok JOIN c USING (vec_id), h"""
