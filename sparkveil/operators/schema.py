"""Column names and contracts: normalise, rename, drop, drift, required columns."""

import warnings
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """A table does not keep its contract."""


def normalized(names: list[str], style: str = "ingest") -> list[str]:
    """style: ingest (blank, slash and dash to underscore), stage (blank alone), plain (strip and lower). Names that become
    one are refused."""
    out = [c.strip().lower() for c in names]
    if style != "plain":
        out = [c.replace(" ", "_") for c in out]
    if style == "ingest":
        out = [c.replace("/", "_").replace("-", "_") for c in out]
    require_distinct(out)
    return out


def normalize_names(df: DataFrame, style: str = "ingest") -> DataFrame:
    return df.toDF(*normalized(df.columns, style))


def require_distinct(names: list[str]) -> None:
    if twice := sorted(c for c, n in Counter(names).items() if n > 1):
        raise ContractError(f"column names that occur more than once: {twice}")


def unused(df: DataFrame, base: str) -> str:
    """A name that starts with base and that df does not use."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def require_columns(df: DataFrame, needed: list[str]) -> None:
    if missing := [c for c in needed if c not in df.columns]:
        raise ContractError(f"missing columns: {missing}")


def require_rows(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise ContractError(f"{what} has no rows")


def require_absent(df: DataFrame, columns: list[str]) -> None:
    if left := [c for c in columns if c in df.columns]:
        raise ContractError(f"identifier columns left: {left}")


def require_unique(mapping: DataFrame, key: str, what: str) -> None:
    """Refuses a lookup that would repeat rows in a join."""
    if found := mapping.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").orderBy(key).limit(20).collect():
        raise ContractError(f"{what}: {key} occurs more than once: {[(r[0], r.n) for r in found]}")


def constant(df: DataFrame, column: str) -> str:
    """The one value of a column; several values, nulls or no rows are refused."""
    row = df.agg(F.min(column).alias("a"), F.max(column).alias("b"), F.count_if(F.col(column).isNull()).alias("nulls")).first()
    if row.a is None or row.a != row.b or row.nulls:
        raise ContractError(f"{column} is not one value: {row.a} to {row.b}, {row.nulls} nulls")
    return row.a


def drift(columns: list[str], contract: dict[str, str], drops: list[str] = ()) -> list[tuple[str, str]]:
    """(column, unknown or missing) for columns the contract does not know or expects in vain."""
    known = set(contract) | set(drops)
    return [(c, "unknown") for c in columns if c not in known] + [(c, "missing") for c in contract if c not in columns]


def drifted(df: DataFrame, contract: dict[str, str], drops: list[str] = ()) -> DataFrame:
    """name, kind, rows: drift of a table, with how many rows it touches. Columns that ingestion adds count as known."""
    found = drift([c for c in df.columns if c not in ("batch_id", "ingested_at")], {k: v for k, v in contract.items() if k not in ("batch_id", "ingested_at")}, drops)
    each = F.array(*(F.struct(F.lit(c).alias("name"), F.lit(k).alias("kind")) for c, k in found)) if found else F.expr("cast(array() as array<struct<name:string,kind:string>>)")
    return df.agg(F.count("*").alias("rows")).select("rows", F.explode(each).alias("x")).select("x.name", "x.kind", "rows")


def standardize(df: DataFrame, contract: dict[str, str], run_time: str, drops: list[str] = (), extra: list[str] = ()) -> DataFrame:
    """df under the contract's names, deliberate drops gone; unknown columns are refused, missing ones warned of."""
    df = normalize_names(df, "plain")
    found = drift([c for c in df.columns if c not in extra], contract, drops)
    if unknown := [c for c, kind in found if kind == "unknown"]:
        raise ContractError(f"columns outside the contract: {unknown}")
    if missing := [c for c, kind in found if kind == "missing"]:
        warnings.warn(f"columns of the contract that the extract lacks: {missing}", stacklevel=2)
    return df.drop(*drops).withColumnsRenamed({k: v for k, v in contract.items() if k in df.columns}).withColumn("standardized_at", F.lit(run_time))


def summary(df: DataFrame) -> DataFrame:
    """rows, columns, name, type, filled: a row a column, from one aggregate."""
    quoted = [c.replace("`", "``") for c in df.columns]
    counts = df.agg(F.count("*").alias("rows"), *(F.count(f"`{c}`").alias(f"filled_{i}") for i, c in enumerate(quoted)))
    each = [F.struct(F.lit(c).alias("name"), F.lit(t).alias("type"), F.col(f"filled_{i}").alias("filled")) for i, (c, t) in enumerate(df.dtypes)]
    return counts.select("rows", F.lit(len(each)).cast("bigint").alias("columns"), F.explode(F.array(*each)).alias("x")).select("rows", "columns", "x.*")
