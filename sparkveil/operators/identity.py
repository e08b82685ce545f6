"""Stable pseudo identities: profiles, numbering, mapping tables and backfills."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..plans.contracts import CUSTOMER_MAPPING, PRODUCT_MAPPING, UNKNOWN
from ..sources.tables import materialized
from .schema import ContractError, require_columns, require_unique, unused

IDENTITY = ["source_customer_code", "ship_to_customer_code", "customer_name"]
PRODUCT = ["full_sku_code", "first_half_sku_code", "unique_sku_code", "product_description", "product_category"]
TIERS = ("full", "first_half", "unique")


def numbered(df: DataFrame, order: list[str], groups: list[str] = (), out: str = "seq") -> DataFrame:
    """df with its place, from 1, by order within groups; null groups are groups, and no row is left out.

    Rows are dealt by ranges of (groups, order), which are of like size however many rows share a group or a prefix of the
    key, and written, so that the ranges are fixed. Each is ranked by itself; a table of one row a range and group says
    how many rows of the group stand in earlier ranges.
    """
    part, before, n = (unused(df, x) for x in ("range_part", "range_before", "range_rows"))
    ranged = materialized(df.repartitionByRange(*groups, *order).withColumn(part, F.spark_partition_id()))
    counts = ranged.groupBy(part, *groups).agg(F.count("*").alias(n))
    earlier = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    keys = [part, *groups]
    offsets = counts.withColumn(before, F.coalesce(F.sum(n).over(earlier), F.lit(0))).select(*(F.col(k).alias(f"offset_{k}") for k in keys), before)
    ranked = ranged.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    same = [F.col(k).eqNullSafe(F.col(f"offset_{k}")) for k in keys]
    return ranked.join(offsets, same).withColumn(out, (F.col(out) + F.col(before)).cast("bigint")).select(*df.columns, out)


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))


def refuse_nulls(df: DataFrame, columns: list[str]) -> None:
    """An error with the counts of nulls; the functions below refuse them in the plan as well."""
    row = null_counts(df, columns).first()
    if bad := {c: row[c] for c in columns if row[c]}:
        raise ContractError(f"null values: {bad}")


def guarded(df: DataFrame, columns: list[str], message: str, key: str | None = None) -> DataFrame:
    """df, where a null in one of the columns ends the job, whatever is read of it."""
    for c in columns:
        df = df.where(X.holds(F.col(c).isNotNull(), f"{message} {c}", F.col(key) if key else None))
    return df


def with_customer_key(df: DataFrame) -> DataFrame:
    return df.withColumn("customer_hash_key", X.business_key(*IDENTITY))


def profile_customers(history: DataFrame) -> DataFrame:
    """One row a customer: the key and the cleaned values it is made of. A null identity value ends the job."""
    require_columns(history, IDENTITY)
    named = guarded(history, IDENTITY, "null in identity column").select(*(X.clean(c).alias(c) for c in IDENTITY))
    return with_customer_key(named.distinct()).select("customer_hash_key", *IDENTITY)


def profile_products(history: DataFrame) -> DataFrame:
    """One row a SKU; of several descriptions or categories the least pair. A null in a product column ends the job. Lines
    are made distinct first, by hashes: the least of texts is found by sorting, which is left to a row a product."""
    require_columns(history, PRODUCT)
    rows = guarded(history.select(*PRODUCT).distinct(), PRODUCT, "null in product column", "full_sku_code").select(*((X.clean(c) if c == "product_category" else X.strip(c)).alias(c) for c in PRODUCT))
    return rows.groupBy("full_sku_code").agg(F.min(F.struct("product_description", "product_category", "first_half_sku_code", "unique_sku_code")).alias("v")).select("full_sku_code", "v.first_half_sku_code", "v.unique_sku_code", "v.product_description", "v.product_category")


def category_profile(products: DataFrame) -> DataFrame:
    return products.groupBy("product_category").agg(F.count("*").alias("products")).orderBy(F.desc("products"), "product_category")


def sequence_state(existing: DataFrame, column: str, groups: list[str] = ()) -> DataFrame:
    """rows, malformed (codes without a number at their end) and last (the highest number) of a column of codes."""
    n = X.trailing_number(F.col(column))
    return existing.groupBy(*groups).agg(F.count("*").alias("rows"), F.count_if(F.col(column).isNotNull() & n.isNull()).alias("malformed"), F.max(n).alias("last"))


def last_number(existing: DataFrame, column: str, strict: bool = True) -> int:
    """The highest number of a column of codes, 0 without rows. strict refuses any malformed code; else the column is
    refused if none of its codes has a number, as numbering would begin anew."""
    state = sequence_state(existing, column).first()
    if state is None or not state.rows:
        return 0
    if strict and state.malformed or not strict and state.last is None:
        raise ContractError(f"{column}: {state.malformed} of {state.rows} codes have no number at their end")
    return state.last or 0


def last_numbers(existing: DataFrame, column: str, group: str) -> DataFrame:
    """group, last: as last_number for each group; a malformed code ends the job."""
    state = sequence_state(existing, column, [group])
    wrong = F.raise_error(F.concat(F.lit(f"{column}: codes without a number in "), F.coalesce(group, F.lit("null"))))
    return state.select(group, F.when(F.col("malformed") > 0, wrong).otherwise(F.coalesce("last", F.lit(0))).alias("last"))


def require_mapping(mapping: DataFrame, key: str, values: list[str]) -> None:
    """Refuses a mapping with a repeated key or a null in key or values; one aggregate."""
    row = mapping.agg(F.count("*").alias("rows"), F.count_distinct(key).alias("keys"), *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in [key, *values])).first()
    nulls = {c: row[f"null_{c}"] for c in [key, *values] if row[f"null_{c}"]}
    if nulls or row["rows"] != row["keys"]:
        raise ContractError(f"mapping by {key}: {row['rows']} rows, {row['keys']} keys, nulls: {nulls}")


def two_ways(mapping: DataFrame, key: str, code: str) -> DataFrame:
    """rule, value, least, most: keys with several codes and codes with several keys, by their least and greatest partner,
    which combine before the shuffle whatever the size of a group. Nulls are no partners and no groups."""
    out = None
    for a, b, rule in ((key, code, f"{key} with several {code}"), (code, key, f"{code} with several {key}")):
        found = mapping.where(F.col(a).isNotNull()).groupBy(F.col(a).alias("value")).agg(F.min(b).alias("least"), F.max(b).alias("most")).where("least <> most").select(F.lit(rule).alias("rule"), "value", "least", "most")
        out = found if out is None else out.unionByName(found)
    return out


def require_one_to_one(products: DataFrame) -> None:
    """Refuses SKU tiers in which a key has two codes or a code two keys."""
    found = reduce(DataFrame.unionByName, [two_ways(products, f"{t}_sku_code", f"pseudo_{t}_sku_code") for t in TIERS])
    if bad := found.limit(20).collect():
        raise ContractError(f"SKU codes are not one-to-one: {[tuple(r) for r in bad]}")


def map_customers(base: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """existing, unchanged, and base's new keys numbered after its highest number, by key."""
    new, start = base, 0
    if existing is not None:
        new = base.join(existing.select("customer_hash_key"), "customer_hash_key", "left_anti")
        start = last_number(existing, "pseudo_customer_name", strict=False)
    name = F.concat(F.lit("Customer CUST-"), X.zero_pad(F.col("seq") + F.lit(start), 6))
    added = numbered(new, ["customer_hash_key"]).withColumn("pseudo_customer_name", name).select(*CUSTOMER_MAPPING)
    out = materialized(added if existing is None else existing.select(*CUSTOMER_MAPPING).unionByName(added))
    require_mapping(out, "customer_hash_key", ["pseudo_customer_name"])
    return out


def unmapped_categories(products: DataFrame, categories: DataFrame) -> DataFrame:
    """product_category, products: categories that the lookup lacks, null among them."""
    return products.join(categories, "product_category", "left_anti").groupBy("product_category").agg(F.count("*").alias("products"))


def map_products(base: DataFrame, categories: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Pseudo category and description for each SKU: new ones numbered within their category after its last number. A
    category that the lookup lacks ends the job; a lookup with a repeated category is refused."""
    require_columns(base, PRODUCT)
    require_unique(categories, "product_category", "category lookup")
    new = base if existing is None else base.join(existing.select("full_sku_code"), "full_sku_code", "left_anti")
    known = categories.select("product_category", F.col("pseudo_category").alias("found"))
    named = new.join(known, "product_category", "left").where(X.holds(F.col("found").isNotNull(), "category without a pseudo category", F.col("product_category"))).withColumn("pseudo_category", F.col("found")).drop("found")
    ranked = numbered(named, ["product_description", "full_sku_code"], ["pseudo_category"])
    if existing is not None:
        ranked = ranked.join(last_numbers(existing, "pseudo_product_description", "pseudo_category"), "pseudo_category", "left")
    else:
        ranked = ranked.withColumn("last", F.lit(0))
    text = F.concat(F.col("pseudo_category"), F.lit(" Product "), X.initials(F.col("pseudo_category")), F.lit("-"), X.zero_pad(F.col("seq") + F.coalesce("last", F.lit(0)), 3))
    added = ranked.withColumn("pseudo_product_description", text).select(*PRODUCT_MAPPING[:7])
    if existing is None:
        return added
    return existing.select(*PRODUCT_MAPPING).unionByName(added, allowMissingColumns=True)


def sku_prefixes(products: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """pseudo_category, sku_prefix: initials, numbered from the second category with the same ones. Known pairs stay. Two
    categories with one prefix, as initials may end in a digit themselves, end the job."""
    found = products.where("pseudo_category IS NOT NULL").select("pseudo_category").distinct().withColumn("base", X.initials(F.col("pseudo_category")))
    taken = F.lit(0)
    if known is not None:
        used = known.withColumn("base", X.initials(F.col("pseudo_category"))).groupBy("base").agg(F.count("*").alias("taken"))
        found = found.join(known.select("pseudo_category"), "pseudo_category", "left_anti").join(used, "base", "left")
        taken = F.coalesce("taken", F.lit(0))
    place = F.row_number().over(Window.partitionBy("base").orderBy("pseudo_category")) + taken
    added = found.select("pseudo_category", F.when(place == 1, F.col("base")).otherwise(F.concat("base", place.cast("string"))).alias("sku_prefix"))
    out = added if known is None else known.unionByName(added)
    twice = F.count("*").over(Window.partitionBy("sku_prefix")) > 1
    return out.withColumn("sku_prefix", F.when(twice, F.raise_error(F.concat(F.lit("prefix of several categories: "), "sku_prefix"))).otherwise(F.col("sku_prefix")))


def known_prefixes(products: DataFrame) -> DataFrame:
    prefix = F.nullif(F.regexp_extract("pseudo_full_sku_code", r"^SKU-([A-Z0-9]+)-\d+$", 1), F.lit(""))
    return products.select("pseudo_category", prefix.alias("sku_prefix")).where("sku_prefix IS NOT NULL").distinct()


def stable_codes(df: DataFrame, key: str, pseudo: str, prefix: str, pad: int) -> DataFrame:
    """key, pseudo of every key of df: codes it has stay, keys without are numbered after the highest, by key."""
    have = df.where(F.col(pseudo).isNotNull()).groupBy(key).agg(F.min(pseudo).alias(pseudo))
    new = df.where(F.col(key).isNotNull()).select(key).distinct().join(have, key, "left_anti")
    start = last_number(df.where(F.col(pseudo).isNotNull()), pseudo)
    return have.unionByName(numbered(new, [key]).select(key, F.concat(F.lit(prefix), X.zero_pad(F.col("seq") + F.lit(start), pad)).alias(pseudo)))


def map_skus(products: DataFrame) -> DataFrame:
    """The three tiers of SKU pseudonyms; those that rows already have never change. Text that stands for null counts as
    null; a product without category or key ends the job; the result is checked for unique, one-to-one codes."""
    for c in PRODUCT_MAPPING[7:]:
        if c not in products.columns:
            products = products.withColumn(c, F.lit(None).cast("string"))
    needed = ["full_sku_code", "first_half_sku_code", "unique_sku_code", "pseudo_category"]
    products = materialized(guarded(products.withColumns({c: X.real_null(F.col(c)) for c in needed}), needed, "null in", "full_sku_code"))
    prefixes = sku_prefixes(products, known_prefixes(products)).withColumnRenamed("pseudo_category", "prefix_category")
    have, new = products.where("pseudo_full_sku_code IS NOT NULL"), products.where("pseudo_full_sku_code IS NULL")
    # Descriptions end in padded numbers, so that their numbers decide beyond the padding.
    placed = numbered(new.withColumn("description_number", X.trailing_number(F.col("pseudo_product_description"))), ["description_number", "full_sku_code"], ["pseudo_category"])
    placed = placed.join(last_numbers(have, "pseudo_full_sku_code", "pseudo_category"), "pseudo_category", "left").join(prefixes, F.col("pseudo_category") == F.col("prefix_category"), "left")
    prefix = X.required(F.col("sku_prefix"), "category without prefix", F.col("pseudo_category"))
    code = F.concat(F.lit("SKU-"), prefix, F.lit("-"), X.zero_pad(F.col("seq") + F.coalesce("last", F.lit(0)), 6))
    out = materialized(have.select(*PRODUCT_MAPPING).unionByName(placed.withColumn("pseudo_full_sku_code", code).select(*PRODUCT_MAPPING)))
    groups = stable_codes(out, "first_half_sku_code", "pseudo_first_half_sku_code", "SKU-GRP-", 5)
    bases = stable_codes(out, "unique_sku_code", "pseudo_unique_sku_code", "SKU-BASE-", 5)
    full = out.drop("pseudo_first_half_sku_code", "pseudo_unique_sku_code").join(groups, "first_half_sku_code", "left").join(bases, "unique_sku_code", "left").select(*PRODUCT_MAPPING)
    full = materialized(full)
    require_mapping(full, "full_sku_code", ["pseudo_full_sku_code", "pseudo_first_half_sku_code", "pseudo_unique_sku_code"])
    require_one_to_one(full)
    return full


def backfill_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return map_customers(profile_customers(orders), customers)


def unknown_state(products: DataFrame) -> DataFrame:
    """rows, prefixes and last of the unknown category: its products, the prefixes of their codes, the last number of
    their descriptions."""
    own = products.where(F.col("pseudo_category") == UNKNOWN)
    prefix = F.nullif(F.regexp_extract("pseudo_full_sku_code", r"^SKU-([A-Z0-9]+)-\d+$", 1), F.lit(""))
    return own.agg(F.count("*").alias("rows"), F.count_distinct(prefix).alias("prefixes"), F.coalesce(F.max(X.trailing_number(F.col("pseudo_product_description"), r"-(\d+)$")), F.lit(0)).alias("last"))


def backfill_products(found: DataFrame, products: DataFrame) -> DataFrame:
    """products and the SKUs of found that it lacks, under the unknown category: descriptions and codes go on after its
    last numbers, group and base codes are shared with known halves. A null SKU ends the job; where the unknown category
    has products, their codes must have one prefix."""
    require_columns(found, PRODUCT_MAPPING[:4])
    require_columns(products, PRODUCT_MAPPING)
    state = unknown_state(products).first()
    if state["rows"] and state.prefixes != 1:
        raise ContractError(f"{UNKNOWN}: codes of {state['rows']} products have {state.prefixes} prefixes")
    named = guarded(found.select(*PRODUCT_MAPPING[:4]).distinct(), ["full_sku_code"], "null in")
    new = named.groupBy("full_sku_code").agg(F.min(F.struct("product_description", "first_half_sku_code", "unique_sku_code")).alias("v"))
    new = new.select("full_sku_code", "v.*").join(products.select("full_sku_code"), "full_sku_code", "left_anti")
    text = F.concat(F.lit(f"{UNKNOWN} Product UC-"), X.zero_pad(F.col("seq") + F.lit(state.last), 3))
    added = numbered(new, ["full_sku_code"]).select("full_sku_code", "first_half_sku_code", "unique_sku_code", "product_description", F.lit("UNKNOWN").alias("product_category"), F.lit(UNKNOWN).alias("pseudo_category"), text.alias("pseudo_product_description"))
    return map_skus(products.unionByName(added, allowMissingColumns=True))


def inventory_products(inventory: DataFrame) -> DataFrame:
    sku = X.full_sku(F.col("raw_sku"))
    return inventory.select(sku.alias("full_sku_code"), X.sku_half(sku, 0).alias("first_half_sku_code"), X.sku_half(sku, 1).alias("unique_sku_code"), "product_description")
