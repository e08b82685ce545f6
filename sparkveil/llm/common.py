"""Shared folders, Arrow helpers and connected components."""

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import delete, new_folder

ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "string": pa.string(),
    "binary": pa.binary(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
    "array<string>": pa.list_(pa.string()),
}

HOT_SHARE = 0.001  # of all rows; keys with more are handled apart


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """df written as a table in the shared folder and read again: lineage ends there and lost executors lose nothing.
    sources.tables.release deletes what nobody has discarded."""
    path = new_folder(df.sparkSession, "llm")
    df.write.parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()  # the driver frees shuffle files only as it collects garbage
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.saved_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of saved() that nothing will read again."""
    for df in tables:
        delete(df.sparkSession, df.saved_path)


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


class Carried:
    """Columns that an operator hands through, under names of its own until the end, so that no column of the caller's
    can clash with those that it makes. Results replace columns of the same name, whatever their case."""

    def __init__(self, df: DataFrame, keep: list[str] | None, results: list[str]):
        taken = {c.lower() for c in results}
        self.names = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
        self.inner = [f"carried_{i}" for i in range(len(self.names))]
        self.columns = [df[name(c)].alias(k) for c, k in zip(self.names, self.inner, strict=True)]
        self.back = [F.col(k).alias(c) for c, k in zip(self.names, self.inner, strict=True)]
        self.source = df

    def with_input(self, column: str) -> tuple[DataFrame, str]:
        """The carried columns with this column of df, and its name there: sent once, also where it is carried."""
        if column in self.names:
            return self.source.select(*self.columns), self.inner[self.names.index(column)]
        return self.source.select(*self.columns, self.source[name(column)].alias("text")), "text"


def map_slices(df: DataFrame, outputs: dict[str, str], start: Callable[[], Callable], keep: list[str] | None = None, rows: int = 256, inputs: list[str] | None = None) -> DataFrame:
    """keep columns of df, then outputs (name to type), made in Arrow batches of a few rows.

    start() runs once in a task and returns make(list, ...): a list of each of the inputs, all columns of df unless given,
    to a list of each output. Columns that are kept alone stay in Arrow.
    """
    source, kept = df.columns, list(df.columns if keep is None else keep)
    asked = [source.index(c) for c in (source if inputs is None else inputs)]
    types = [ARROW[t] for t in outputs.values()]
    names = [*kept, *outputs]
    kinds = dict(df.dtypes)

    def task(batches):
        make = start()
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                part = batch.slice(i, rows)
                if not part.num_rows:
                    continue
                made = make(*(part.column(k).to_pylist() for k in asked))
                yield pa.RecordBatch.from_arrays([*(part.column(source.index(c)) for c in kept), *(pa.array(v, type=t) for v, t in zip(made, types, strict=True))], names=names)

    ddl = ", ".join([*(f"{name(c)} {kinds[c]}" for c in kept), *(f"{name(c)} {t}" for c, t in outputs.items())])
    return df.mapInArrow(task, ddl)


def flat_slices(df: DataFrame, outputs: dict[str, str], start: Callable[[], Callable], rows: int = 256) -> DataFrame:
    """As map_slices, but make's lists may have any length and no column is kept."""
    n, types, names = len(df.columns), [ARROW[t] for t in outputs.values()], list(outputs)

    def task(batches):
        make = start()
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                part = batch.slice(i, rows)
                made = make(*(part.column(k).to_pylist() for k in range(n)))
                yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(made, types, strict=True)], names=names)

    return df.mapInArrow(task, ", ".join(f"{name(c)} {t}" for c, t in outputs.items()))


def split_join(rows: DataFrame, lookup: DataFrame, keys: list[str], total: int, how: str = "inner") -> DataFrame:
    """rows joined with lookup (one row a key; n, how many rows have the key) on keys, which are not null; how is inner, left or
    left_semi. Keys that a HOT_SHARE of the total or more have, of which there can be 1 / HOT_SHARE at most, are broadcast,
    so that their rows stay where they are; the others are shuffled."""
    hot = F.col("n") >= max(2.0, HOT_SHARE * total)
    few, many = F.broadcast(lookup.where(hot).drop("n")), lookup.where(~hot).drop("n").hint("merge")
    return rows.join(few, keys, "inner" if how == "left" else how).unionByName(rows.join(F.broadcast(lookup.where(hot).select(*keys)), keys, "left_anti").join(many, keys, how))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b), both bigint; component is the smallest node reachable.

    Alternating large-star and small-star steps until the edges stay as they are. Each step writes its edges, so
    lineage stays short; a node's edges are never gathered, only minima are, which combine before the shuffle.
    """
    edges = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a")
        edges = saved(small.select("a", F.col("low").alias("b")).unionByName(small.select(F.col("b").alias("a"), F.col("low").alias("b"))).where("a <> b").distinct())
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
