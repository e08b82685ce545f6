"""Mapping rules and quality gates, each a few aggregates over the batch."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..plans.contracts import GATES, VALIDATED
from ..sources.tables import materialized
from .schema import ContractError, require_columns, require_rows, unused

PSEUDONYM = {"customer": ("customer_name", X.is_customer_pseudonym), "product": ("product_description", X.is_product_pseudonym), "sku": ("full_sku_code", X.is_sku_pseudonym)}


def one_to_one(mapping: DataFrame, key: str, pseudo: str) -> DataFrame:
    """Keys with several pseudonyms and pseudonyms with several keys, over distinct pairs."""
    pairs = mapping.select(F.col(key).alias("k"), F.col(pseudo).alias("p")).distinct()
    split = pairs.groupBy("k").agg(F.count("p").alias("n")).where("n > 1").select(F.lit(f"split {key}").alias("rule"), F.col("k").alias("value"), "n")
    collided = pairs.groupBy("p").agg(F.count("k").alias("n")).where("n > 1").select(F.lit(f"collision {pseudo}").alias("rule"), F.col("p").alias("value"), "n")
    return split.unionByName(collided)


def null_values(mapping: DataFrame, columns: list[str]) -> DataFrame:
    counts = mapping.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(f"null {c}").alias("rule"), F.lit(None).cast("string").alias("value"), F.col(c).alias("n")) for c in columns))).alias("x")).select("x.*").where("n > 0")


def mapping_violations(customers: DataFrame, products: DataFrame) -> DataFrame:
    parts = [one_to_one(customers, "customer_hash_key", "pseudo_customer_name"), null_values(customers, ["customer_hash_key", "pseudo_customer_name"])]
    for tier in ("full", "first_half", "unique"):
        key = f"{tier}_sku_code"
        parts += [one_to_one(products, key, f"pseudo_{key}"), null_values(products, [key, f"pseudo_{key}"])]
    parts.append(null_values(products, ["pseudo_category"]))
    for mapping, kind, column in ((customers, "customer", "pseudo_customer_name"), (products, "product", "pseudo_product_description")):
        count = mapping.agg(F.count_if(~PSEUDONYM[kind][1](F.col(column))).alias("n"))
        parts.append(count.select(F.lit(f"format {column}").alias("rule"), F.lit(None).cast("string").alias("value"), "n").where("n > 0"))
    for mapping, key in ((customers, "customer_hash_key"), (products, "full_sku_code")):
        parts.append(mapping.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(f"repeated {key}").alias("rule"), F.col(key).alias("value"), "n"))
    return reduce(DataFrame.unionByName, parts)


def validate_mappings(customers: DataFrame, products: DataFrame) -> None:
    require_columns(customers, ["customer_hash_key", "pseudo_customer_name"])
    require_columns(products, ["full_sku_code", "pseudo_full_sku_code", "first_half_sku_code", "pseudo_first_half_sku_code", "unique_sku_code", "pseudo_unique_sku_code", "pseudo_category", "pseudo_product_description"])
    require_rows(customers, "customer mapping")
    require_rows(products, "product mapping")
    if found := mapping_violations(customers, products).limit(20).collect():
        raise ContractError(f"mapping rules broken: {[tuple(r) for r in found]}")


def bad_pseudonyms(df: DataFrame, kinds: list[str]) -> DataFrame:
    return df.agg(*(F.count_if(~PSEUDONYM[k][1](F.col(PSEUDONYM[k][0]))).alias(f"bad_{k}_rows") for k in kinds))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))


def negative_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*(F.count_if(F.col(c).try_cast("double") < 0).alias(c) for c in columns))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each hash; null hashes are equal."""
    return df.groupBy("row_hash").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


HOT_SHARE = 0.001  # of the rows; keys with more are looked up where their rows are


def duplicate_rows(df: DataFrame, key: str = "row_hash") -> DataFrame:
    """Rows whose key occurs more than once, with occurrences; null keys are equal. Keys are counted first, which combines
    before the shuffle. Those of a share of the rows, a thousand at most, are broadcast; only rows of the others move."""
    own, n = unused(df, "repeated_key"), unused(df, "occurrences")
    counts = materialized(df.groupBy(F.col(key).alias(own)).agg(F.count("*").alias(n)).where(F.col(n) > 1))
    total = counts.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    hot = F.col(n) >= max(2.0, HOT_SHARE * total)
    few, many = F.broadcast(counts.where(hot)), counts.where(~hot).hint("merge")
    same = lambda lookup: df[key].eqNullSafe(lookup[own])
    rest = df.join(F.broadcast(counts.where(hot).select(own)), same(counts), "left_anti")
    out = df.join(few, same(few)).unionByName(rest.join(many, rest[key].eqNullSafe(many[own])))
    return out.drop(own).withColumnRenamed(n, "occurrences")


def export_duplicates(df: DataFrame, path: str, key: str = "row_hash") -> DataFrame:
    """Rows whose key occurs more than once, written in the order of the key, for inspection."""
    duplicate_rows(df, key).repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def validated_counts(dataset: str, df: DataFrame) -> DataFrame:
    """One row: rows, rows without each pseudonym of the dataset, rows without hash, hashes beyond their first."""
    kinds = GATES[dataset]["pseudonyms"]
    by_hash = df.groupBy("row_hash").agg(F.count("*").alias("rows"), *(F.count_if(~PSEUDONYM[k][1](F.col(PSEUDONYM[k][0]))).alias(f"bad_{k}_rows") for k in kinds))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    missing = total(F.when(F.col("row_hash").isNull(), F.col("rows")).otherwise(0)).alias("missing_hashes")
    return by_hash.agg(total(F.col("rows")).alias("rows"), *(total(F.col(f"bad_{k}_rows")).alias(f"bad_{k}_rows") for k in kinds), missing, total(F.col("rows") - 1).alias("duplicates"))


def validate_pseudonymized(dataset: str, df: DataFrame, export: str | None = None) -> dict[str, int]:
    """Counts of a pseudonymised table; values that are no pseudonyms, missing hashes, missing columns or no rows are
    refused. Repeated hashes are no fault: their rows are written to export, if given."""
    require_columns(df, VALIDATED[dataset])
    row = validated_counts(dataset, df).first().asDict()
    if not row["rows"]:
        raise ContractError(f"{dataset}: no rows to validate")
    if bad := {k: n for k, n in row.items() if n and k not in ("rows", "duplicates")}:
        raise ContractError(f"{dataset}: {bad}")
    if row["duplicates"] and export:
        export_duplicates(df, export)
    return row


def quality_checks(dataset: str, df: DataFrame, batch: str) -> DataFrame:
    """batch, check, status, n: one row a check, from one aggregate over the batch and one over its hashes."""
    gate = GATES[dataset]
    require = [c for c in gate["required"] if c not in df.columns]
    have = lambda cs: [c for c in cs if c in df.columns]
    total = lambda cs, test: reduce(lambda a, b: a + b, [F.count_if(test(F.col(c))) for c in cs], F.lit(0))
    sums = {
        "row_count": F.count("*"),
        "critical_nulls": total(have(gate["critical"]), lambda c: c.isNull()),
        **{f"{k}_pseudonymization": F.count_if(~PSEUDONYM[k][1](F.col(PSEUDONYM[k][0]))) if PSEUDONYM[k][0] in df.columns else F.count("*") for k in gate["pseudonyms"]},
        "row_hash_completeness": F.count_if(F.col("row_hash").isNull()) if "row_hash" in df.columns else F.count("*"),
        "negative_numeric_values": total(have(gate["numeric"]), lambda c: c.try_cast("double") < 0),
    }
    counted = df.agg(*(v.cast("bigint").alias(k) for k, v in sums.items()))
    twice = duplicate_count(df) if "row_hash" in df.columns else df.sparkSession.createDataFrame([(0,)], "duplicates bigint")
    rows = counted.select(F.explode(F.array(*(F.struct(F.lit(k).alias("check"), F.col(k).alias("n")) for k in sums))).alias("x")).select("x.check", "x.n")
    rows = rows.unionByName(twice.select(F.lit("duplicate_row_hash").alias("check"), F.col("duplicates").alias("n")))
    rows = rows.unionByName(df.sparkSession.createDataFrame([("required_columns", len(require))], "check string, n bigint"))
    bad = F.when(F.col("check") == "row_count", F.col("n") == 0).otherwise(F.col("n") > 0)
    warning = F.col("check").isin("duplicate_row_hash", "negative_numeric_values")
    return rows.select(F.lit(batch).alias("batch"), "check", F.when(~bad, "passed").when(warning, "warning").otherwise("failed").alias("status"), "n")


def roll_up(checks: DataFrame) -> DataFrame:
    """batch, overall_status, and the names of failed and warning checks."""
    failed, warned = F.col("status") == "failed", F.col("status") == "warning"
    names = lambda test: F.array_join(F.sort_array(F.collect_list(F.when(test, F.col("check")))), ",")
    status = F.when(F.bool_or(failed), "failed").when(F.bool_or(warned), "passed_with_warnings").otherwise("passed")
    return checks.groupBy("batch").agg(status.alias("overall_status"), names(failed).alias("failed_checks"), names(warned).alias("warning_checks"))


def write_report(checks: DataFrame, root: str, dataset: str) -> DataFrame:
    """checks and their roll-up under root, by dataset and batch; a second report of a batch replaces the first. Returns
    the roll-up as written."""
    for name, rows in (("quality_checks", checks), ("quality_reports", roll_up(checks))):
        rows.withColumn("dataset", F.lit(dataset)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset", "batch").parquet(f"{root}/{name}")
    kept = checks.sparkSession.read.schema("overall_status string, failed_checks string, warning_checks string, dataset string, batch string").parquet(f"{root}/quality_reports")
    return kept.where(F.col("dataset") == dataset).select("batch", "overall_status", "failed_checks", "warning_checks")


def unauthorized(facts: DataFrame, reports: DataFrame, key: str = "batch_id") -> DataFrame:
    """Batches of facts, a null one among them, that no report of their own authorises."""
    return facts.select(key).distinct().join(reports.where(F.col("overall_status").isin("passed", "passed_with_warnings")).select(F.col("batch").alias(key)), key, "left_anti")


def authorized(facts: DataFrame, reports: DataFrame, key: str = "batch_id") -> DataFrame:
    """Facts of batches whose own report passed. Names of batches, which are few, go to the facts: a shuffle by batch would
    send each whole to one task."""
    passed = reports.where(F.col("overall_status").isin("passed", "passed_with_warnings")).select(F.col("batch").alias(key)).distinct()
    return facts.join(F.broadcast(passed), key, "left_semi")


def contradictory(reports: DataFrame) -> DataFrame:
    """Batches of which one report passes and another does not."""
    passes = F.coalesce(F.col("overall_status").isin("passed", "passed_with_warnings"), F.lit(False))
    return reports.groupBy("batch").agg(F.min(passes).alias("worst"), F.max(passes).alias("best")).where("worst <> best").select("batch")
