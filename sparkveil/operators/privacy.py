"""Facts under pseudonyms: guarded joins, replaced values, row hashes, no identifiers left."""

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..plans.contracts import HISTORY_HASH, INVENTORY_HASH, OPEN_HASH
from ..sources.tables import STORED, delete, new_folder
from .identity import IDENTITY, with_customer_key
from .schema import ContractError, constant, require_absent, require_columns, require_rows, require_unique

LOOKUP = ["pseudo_category", "pseudo_product_description", "pseudo_full_sku_code", "pseudo_first_half_sku_code", "pseudo_unique_sku_code"]


def fanout_keys(mapping: DataFrame, key: str) -> DataFrame:
    """Keys that would repeat facts in a join."""
    return mapping.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def with_products(facts: DataFrame, products: DataFrame) -> DataFrame:
    return facts.join(products.select("full_sku_code", *LOOKUP), "full_sku_code", "left")


def with_customers(facts: DataFrame, customers: DataFrame) -> DataFrame:
    return with_customer_key(facts).join(customers.select("customer_hash_key", "pseudo_customer_name"), "customer_hash_key", "left")


def distinct_skus(facts: DataFrame) -> DataFrame:
    """A row a SKU, enough to ask which SKUs a mapping lacks; facts need not move for it."""
    return facts.select("full_sku_code").distinct()


def distinct_identities(facts: DataFrame) -> DataFrame:
    return facts.select(*IDENTITY).distinct()


def unmapped(joined: DataFrame, key: str, pseudo: str) -> DataFrame:
    return joined.where(F.col(pseudo).isNull()).select(key).distinct()


def first_unmapped(joined: DataFrame, key: str, pseudo: str, n: int = 20) -> DataFrame:
    """The first n keys without a pseudonym, for a message."""
    return unmapped(joined, key, pseudo).orderBy(key).limit(n)


def hashed(df: DataFrame, columns: list[str], run_time: str) -> DataFrame:
    """row_hash over those of the columns that df has; missing ones are warned of."""
    if missing := [c for c in columns if c not in df.columns]:
        warnings.warn(f"row hash without columns: {missing}", stacklevel=2)
    return df.withColumn("row_hash", X.row_hash([c for c in columns if c in df.columns])).withColumn("pseudonymized_at", F.lit(run_time))


def guarded(joined: DataFrame, pseudonyms: dict[str, str]) -> DataFrame:
    """Facts of which each has the pseudonyms (pseudonym to its key); one without ends the job, whatever is read of it."""
    for pseudo, key in pseudonyms.items():
        joined = joined.where(X.holds(F.col(pseudo).isNotNull(), f"no pseudonym for {key}", F.col(key)))
    return joined


def written_whole(facts: DataFrame, make: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """make(facts) written to path and read again; refused unless it has as many rows as facts, and some. Facts are counted
    while they pass. Stages that ran again after a loss may count a row twice, so that facts are counted anew before a
    difference is believed."""
    given, spark = Observation(), facts.sparkSession
    out = make(facts.observe(given, F.count(F.lit(1)).alias("rows")))
    out.write.option("compression", STORED).parquet(path)
    written = spark.read.schema(out.schema).parquet(path)
    require_rows(written, path)  # an empty plan observes nothing
    after = written.count()
    if given.get["rows"] != after and (before := facts.count()) != after:
        delete(spark, path)
        raise ContractError(f"{before} facts became {after} rows")
    return written


def own_folder(facts: DataFrame, path: str | None) -> str:
    return path or new_folder(facts.sparkSession, "pseudonymized")


def pseudonymize_orders(facts: DataFrame, products: DataFrame, customers: DataFrame, run_time: str, kind: str = "history", path: str | None = None) -> DataFrame:
    """Order lines with pseudonyms in place of names, SKUs and descriptions, written to path (a folder of the shared one,
    unless given) and read again. Open orders take their category from the mapping.

    Refused: missing columns, no rows, mappings with a repeated key, a result of more or fewer rows. A null identity value
    or a fact that a mapping lacks ends the job. There is no other way to the result than through the written table.
    """
    require_columns(facts, [*IDENTITY, "full_sku_code", "first_half_sku_code", "unique_sku_code", "product_description", "order_number"])
    require_columns(products, ["full_sku_code", *LOOKUP])
    require_columns(customers, ["customer_hash_key", "pseudo_customer_name"])
    require_unique(products, "full_sku_code", "product mapping")
    require_unique(customers, "customer_hash_key", "customer mapping")
    return written_whole(facts, lambda rows: _orders(rows, products, customers, run_time, kind), own_folder(facts, path))


def _orders(facts: DataFrame, products: DataFrame, customers: DataFrame, run_time: str, kind: str) -> DataFrame:
    # Customers first: lines of an order move together, and neither key nor name moves on with the wider rows.
    named = guarded(with_customers(facts, customers), {"pseudo_customer_name": "customer_hash_key"})
    joined = guarded(with_products(named, products), {"pseudo_full_sku_code": "full_sku_code", "pseudo_product_description": "full_sku_code"})
    new = {
        "customer_name": F.col("pseudo_customer_name"),
        "full_sku_code": F.col("pseudo_full_sku_code"),
        "first_half_sku_code": F.col("pseudo_first_half_sku_code"),
        "unique_sku_code": F.col("pseudo_unique_sku_code"),
        "product_description": F.col("pseudo_product_description"),
        "product_category": F.col("pseudo_category"),
        "original_customer_removed": F.lit(True),
        "original_sku_removed": F.lit(True),
        "original_product_removed": F.lit(True),
        **({"original_user_removed": F.lit(True)} if kind == "history" else {"product_category_derived": F.lit(True)}),
    }
    out = hashed(joined.withColumns(new), HISTORY_HASH if kind == "history" else OPEN_HASH, run_time)
    away = ["source_customer_code", "ship_to_customer_code", "created_by_user", "customer_hash_key", "pseudo_customer_name", *LOOKUP]
    out = out.drop(*away)
    require_absent(out, away)
    return out


def pseudonymize_inventory(inventory: DataFrame, products: DataFrame, run_time: str, path: str | None = None) -> DataFrame:
    """Stock lines with pseudonyms, SKUs rebuilt from their numbers, written and read again as orders are. Refused: missing
    columns, no rows or several snapshot dates, a mapping with a repeated key, a result of more or fewer rows. A null SKU or
    one that the mapping lacks ends the job."""
    require_columns(inventory, ["raw_sku", "product_description", "warehouse_code", "snapshot_date"])
    require_columns(products, ["full_sku_code", *LOOKUP])
    constant(inventory, "snapshot_date")
    require_unique(products, "full_sku_code", "product mapping")
    return written_whole(inventory, lambda rows: _stock(rows, products, run_time), own_folder(inventory, path))


def _stock(inventory: DataFrame, products: DataFrame, run_time: str) -> DataFrame:
    named = inventory.where(X.holds(F.col("raw_sku").isNotNull(), "null in raw_sku")).withColumn("full_sku_code", X.full_sku(F.col("raw_sku")))
    joined = guarded(with_products(named, products), {"pseudo_full_sku_code": "full_sku_code", "pseudo_product_description": "full_sku_code"})
    new = {"full_sku_code": F.col("pseudo_full_sku_code"), "product_description": F.col("pseudo_product_description"), "product_category": F.col("pseudo_category"), "product_category_derived": F.lit(True), "original_sku_removed": F.lit(True), "original_product_removed": F.lit(True)}
    out = hashed(joined.withColumns(new), INVENTORY_HASH, run_time).drop("raw_sku", *LOOKUP)
    require_absent(out, ["raw_sku", *LOOKUP])
    return out
