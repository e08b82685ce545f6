"""Registered queries and their DuckDB SQL. Each reads the given tables whole; history and open orders share out all lines."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import identity as I
from ..operators import privacy as P
from ..operators import quality as Q
from ..operators import schema as S
from ..sources import files as Z
from ..sources import ingest as G
from ..sources import tables as T
from . import contracts as C
from . import fixtures as D
from .fixtures import BATCH, RUN_TIME


def history(spark, d) -> DataFrame:
    return S.standardize(D.raw_history(spark, d), C.HISTORY, RUN_TIME)


def open_orders(spark, d) -> DataFrame:
    return S.standardize(D.raw_open(spark, d), C.OPEN_ORDERS, RUN_TIME, C.OPEN_DROPS)


def inventory(spark, d) -> DataFrame:
    return S.standardize(D.raw_inventory(spark, d), C.INVENTORY, RUN_TIME, extra=["warehouse_code", "snapshot_date"])


_made: dict[tuple[str, str, str], tuple[DataFrame, str]] = {}


def once(name: str) -> Callable:
    """A table is made once in an application for given inputs, in a folder of its own; later queries read it as written,
    as the stages of a run do. One that was deleted meanwhile is made again."""

    def wrap(make: Callable[[SparkSession, str, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def read(spark: SparkSession, d: str) -> DataFrame:
            key = (spark.sparkContext.applicationId, d, name)
            if key not in _made or not T.exists(spark, _made[key][1]):
                folder = T.new_folder(spark, name)
                _made[key] = (make(spark, d, folder), folder)
            return _made[key][0]

        return read

    return wrap


def published(name: str) -> Callable:
    """once, for a mapping, as the first version in its folder."""

    def wrap(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def version(spark: SparkSession, d: str, root: str) -> DataFrame:
            G.publish(make(spark, d), root, 0)
            return G.current(spark, root)

        return once(f"mapping-{name}")(version)

    return wrap


@published("customers_first")
def customers_first(spark, d) -> DataFrame:
    return I.map_customers(I.profile_customers(history(spark, d)))


def _early(df: DataFrame) -> DataFrame:
    """Lines of an earlier batch, after which the incremental queries take in the rest."""
    return df.where("order_date < '19960101'")


def customers_incremental(spark, d) -> DataFrame:
    facts = history(spark, d)
    return I.map_customers(I.profile_customers(facts), I.map_customers(I.profile_customers(_early(facts))))


def products_first(spark, d) -> DataFrame:
    return I.map_products(I.profile_products(history(spark, d)), D.categories(spark))


@published("skus_first")
def skus_first(spark, d) -> DataFrame:
    return I.map_skus(products_first(spark, d))


def skus_incremental(spark, d) -> DataFrame:
    facts = history(spark, d)
    before = I.map_skus(I.map_products(I.profile_products(_early(facts)), D.categories(spark)))
    return I.map_skus(I.map_products(I.profile_products(facts), D.categories(spark), before))


@published("products_open")
def products_open(spark, d) -> DataFrame:
    return I.backfill_products(open_orders(spark, d), skus_first(spark, d))


@published("products_all")
def products_all(spark, d) -> DataFrame:
    return I.backfill_products(I.inventory_products(inventory(spark, d)), products_open(spark, d))


@published("customers_all")
def customers_all(spark, d) -> DataFrame:
    return I.backfill_customers(open_orders(spark, d), customers_first(spark, d))


@once("history-out")
def history_out(spark, d, path) -> DataFrame:
    return P.pseudonymize_orders(history(spark, d), skus_first(spark, d), customers_first(spark, d), RUN_TIME, path=path)


@once("open-out")
def open_out(spark, d, path) -> DataFrame:
    return P.pseudonymize_orders(open_orders(spark, d), products_open(spark, d), customers_all(spark, d), RUN_TIME, "open", path)


@once("inventory-out")
def inventory_out(spark, d, path) -> DataFrame:
    return P.pseudonymize_inventory(inventory(spark, d), products_all(spark, d), RUN_TIME, path)


flagship = history_out


def schema_drift(spark, d) -> DataFrame:
    return S.drifted(D.raw_open(spark, d), C.HISTORY)


def dataset_summary(spark, d) -> DataFrame:
    return S.summary(history(spark, d)).drop("type")


def dataset_types(spark, d) -> DataFrame:
    return S.summary(D.read(spark, d, "lineitem"))


def _batches(spark, d) -> DataFrame:
    return history(spark, d).withColumn("batch_id", F.concat(F.substring("order_date", 1, 4), F.lit("0101_000000")))


def latest_batch(spark, d) -> DataFrame:
    return G.latest_batch(_batches(spark, d)).groupBy("batch_id").agg(F.count("*").alias("rows"))


def batch_metadata(spark, d) -> DataFrame:
    """What the manifest has of each batch, with a digest of its stored rows."""
    folder = _years(spark, d)
    stored = G.committed(spark, "orders", folder).groupBy("batch_id").agg(F.md5(F.concat_ws("|", F.min("o_orderkey"), F.max("o_orderkey"))).alias("digest"))
    return G.read_manifest(spark, folder).where("dataset = 'orders'").groupBy("batch_id", "column_count").agg(F.sum("rows").alias("rows")).join(stored, "batch_id")


def scalars(spark, d) -> DataFrame:
    raw = D.raw_inventory(spark, d)
    sku = X.full_sku(F.col("sku"))
    return raw.select(F.col("`pallet_no.`").alias("pallet"), sku.alias("sku"), X.sku_half(sku, 0).alias("first_half"), X.sku_half(sku, 1).alias("second_half"), X.initials(F.col("description")).alias("initials"), X.clean(F.concat(F.lit("\t "), F.col("description"), F.lit(" \n"))).alias("cleaned"), X.trailing_number(F.col("description")).alias("brand_number"), X.trailing_number(F.lit("none")).alias("no_number"), X.zero_pad(F.col("qty"), 5).alias("padded"), X.business_key("sku", "description").alias("key"), X.valid_date(F.col("bb_date")).alias("date"), X.valid_date(F.lit("20250230")).alias("no_date"))


@once("years")
def _years_made(spark, d, root) -> DataFrame:
    """Orders of each year as an extract of files in a drop folder, of the name of its year and a time of change by rule,
    with a lock file beside them; those of even years are ingested, as a dataset and as snapshots."""
    orders = D.read(spark, d, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    jvm = spark.sparkContext._jvm
    for (year,) in sorted(orders.select("year").where("year IS NOT NULL").distinct().collect()):  # a few
        name = f"{root}/drop/stock_{year}{'0230' if year % 7 == 0 else '0101'}.csv"
        orders.where(F.col("year") == year).drop("year").write.option("header", True).csv(name)
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).setTimes(path, 1_700_000_000_000 + year % 5 * 1000, -1)
        if year % 2 == 0:
            G.ingest(spark, "orders", name, root, f"{year}0101_000000", RUN_TIME)
            if year % 7:
                G.ingest_inventory(spark, name, root, RUN_TIME)
    spark.range(1).selectExpr("'x'").write.text(f"{root}/drop/~$stock_2099.csv")
    return spark.createDataFrame([(root,)], "root string")


def _years(spark, d) -> str:
    return _years_made(spark, d).first().root


def snapshots(spark, d) -> DataFrame:
    """Snapshot dates of the extracts in a folder, by their names, and how many there are; a name without a real date has
    none."""
    found = G.extracts(spark, f"{_years(spark, d)}/drop", "stock").where("NOT startswith(file_name, '~')")
    return found.select(G.snapshot_date(F.col("file_name")).alias("snapshot")).groupBy("snapshot").agg(F.count("*").alias("files"))


def newest_file(spark, d) -> DataFrame:
    return G.newest_file(G.extracts(spark, f"{_years(spark, d)}/drop", "stock"))


def new_files(spark, d) -> DataFrame:
    """Extracts in the folder with content that the dataset has not taken in, by their hashes, and their bytes' sum is that
    of all their files."""
    root = _years(spark, d)
    left = G.new_files(Z.scanned(spark, f"{root}/drop").where("quoted = false AND path NOT LIKE '%~$%'"), G.read_manifest(spark, root), "orders")
    return left.select(F.regexp_extract("path", "(stock_[0-9]+[.]csv)", 1).alias("file_name")).distinct()


def snapshot_guard(spark, d) -> DataFrame:
    """Snapshots by whether an extract of their day is refused, because it is there already."""
    root = _years(spark, d)
    days = [r.day for r in G.extracts(spark, f"{root}/drop", "stock").select(G.snapshot_date(F.col("file_name")).alias("day")).where("day IS NOT NULL").distinct().collect()]  # one row an extract
    there = G.read_manifest(spark, root).where("dataset = 'inventory'").groupBy(F.col("batch_id").alias("snapshot")).agg(F.sum("rows").alias("rows"))
    refused = []
    for day in days:
        try:
            G.refuse_batch("inventory", day)(G.read_manifest(spark, root))
        except S.ContractError:
            refused.append((day, True))
        else:
            refused.append((day, False))
    return spark.createDataFrame(refused, "snapshot string, refused boolean").join(there, "snapshot", "left")


def unmapped_skus(spark, d) -> DataFrame:
    return P.unmapped(P.with_products(P.distinct_skus(open_orders(spark, d)), skus_first(spark, d)), "full_sku_code", "pseudo_full_sku_code")


def unmapped_customers(spark, d) -> DataFrame:
    return P.unmapped(P.with_customers(P.distinct_identities(open_orders(spark, d)), customers_first(spark, d)), "customer_hash_key", "pseudo_customer_name")


def _broken(spark, d) -> tuple[DataFrame, DataFrame]:
    """Mappings with split identities, collisions and nulls, made of the true ones by rule."""
    c, p = customers_first(spark, d), skus_first(spark, d)
    n = X.trailing_number(F.col("pseudo_customer_name"))
    c2 = c.withColumn("pseudo_customer_name", F.when(n % 10 == 0, F.lit(None)).when(n % 10 == 1, F.lit("Customer CUST-000002")).otherwise(F.col("pseudo_customer_name")))
    p2 = p.unionByName(p.where("full_sku_code < '000003'").withColumn("pseudo_first_half_sku_code", F.lit("SKU-GRP-99999")))
    return c2, p2


def fanout_keys(spark, d) -> DataFrame:
    return P.fanout_keys(_broken(spark, d)[1], "full_sku_code")


def mapping_violations(spark, d) -> DataFrame:
    return Q.mapping_violations(*_broken(spark, d))


def mapping_violations_clean(spark, d) -> DataFrame:
    return Q.mapping_violations(customers_all(spark, d), products_all(spark, d))


def _dirty(spark, d) -> DataFrame:
    """Pseudonymised history with faults put in by rule."""
    out = history_out(spark, d)
    n = F.col("order_number").cast("bigint")
    faulty = out.withColumns({"customer_name": F.when(n % 11 == 0, F.lit("Acme")).otherwise(F.col("customer_name")), "product_description": F.when(n % 13 == 0, F.lit(None)).otherwise(F.col("product_description")), "order_amount": F.when(n % 17 == 0, F.concat(F.lit("-"), "order_amount")).when(n % 19 == 0, F.lit("n/a")).otherwise(F.col("order_amount"))})
    return faulty.unionByName(faulty.where(n % 23 == 0))


def bad_pseudonyms(spark, d) -> DataFrame:
    return Q.bad_pseudonyms(_dirty(spark, d), ["customer", "product", "sku"])


def critical_nulls(spark, d) -> DataFrame:
    return Q.null_counts(_dirty(spark, d), C.GATES["history"]["critical"])


def negative_values(spark, d) -> DataFrame:
    return Q.negative_counts(_dirty(spark, d), C.GATES["history"]["numeric"])


def duplicate_row_hashes(spark, d) -> DataFrame:
    return Q.duplicate_count(_dirty(spark, d))


def duplicate_rows_export(spark, d) -> DataFrame:
    return Q.duplicate_rows(_dirty(spark, d)).select("row_hash", "order_number", "occurrences")


def report(dataset, df, checks=False) -> DataFrame:
    found = Q.quality_checks(dataset, df, BATCH)
    return found if checks else Q.roll_up(found)


def land_authorized(spark, d) -> DataFrame:
    out = _by_year(history_out(spark, d))
    digit = F.substring("batch", 4, 1).cast("int") % 3
    status = F.when(digit == 0, "failed").when(digit == 1, "passed").otherwise("passed_with_warnings")
    reports = out.select(F.col("batch_id").alias("batch")).distinct().select("batch", status.alias("overall_status"))
    return Q.authorized(out, reports).groupBy("batch_id").agg(F.count("*").alias("rows"), F.count_distinct("row_hash").alias("hashes"))


def _holes(spark, d) -> DataFrame:
    """History with nulls put in by rule."""
    n = F.col("order_number").cast("bigint")
    holes = {"customer_name": 29, "ship_to_customer_code": 31, "product_description": 37, "product_category": 41}
    return history(spark, d).withColumns({c: F.when(n % m == 0, F.lit(None)).otherwise(F.col(c)) for c, m in holes.items()})


def unmapped_categories(spark, d) -> DataFrame:
    """Categories of products that a lookup without PROMO lacks; nulls among them."""
    filled = _holes(spark, d).select("full_sku_code", "product_category").distinct()
    return I.unmapped_categories(filled, D.categories(spark).where("product_category <> 'PROMO'"))


def sequence_state(spark, d) -> DataFrame:
    """Customer codes of which every seventh has lost its number."""
    c = customers_first(spark, d)
    cut = F.regexp_replace("pseudo_customer_name", r"\d+$", "X")
    return I.sequence_state(c.withColumn("pseudo_customer_name", F.when(X.trailing_number(F.col("pseudo_customer_name")) % 7 == 0, cut).otherwise(F.col("pseudo_customer_name"))), "pseudo_customer_name")


def numbering_keeps_nulls(spark, d) -> DataFrame:
    """Lines of the history numbered within their category; lines without one are numbered among themselves."""
    lines = _holes(spark, d).groupBy("product_category", "order_number", "full_sku_code").agg(F.count("*").alias("lines"))
    return I.numbered(lines, ["order_number", "full_sku_code"], ["product_category"])


def text_nulls(spark, d) -> DataFrame:
    """Brand columns of an imported table with nulls written as text."""
    n = F.col("p_partkey")
    text = F.when(n % 3 == 0, F.lit(" NaN ")).when(n % 3 == 1, F.lit("  ")).otherwise(F.col("p_brand"))
    return D.read(spark, d, "part").select("p_partkey", X.real_null(text).alias("brand"))


def times(spark, d) -> DataFrame:
    """Batch ids and times of orders as text, and batch ids read back from file names."""
    stamp = X.batch_stamp(F.col("o_orderdate"))
    named = F.when(F.col("o_orderkey") % 3 == 0, F.lit("history.csv")).otherwise(F.concat(F.lit("history_"), stamp, F.lit(".csv")))
    return D.read(spark, d, "orders").select("o_orderkey", stamp.alias("stamp"), X.iso_text(F.col("o_orderdate")).alias("iso"), X.batch_of(named).alias("batch"))


def _dropped(spark, d, name: str, df: DataFrame) -> tuple[str, str]:
    """A drop folder with df as compressed CSV files in a folder of that name, and the root of a store. Both are new."""
    folder = T.new_folder(spark, "drop")
    df.write.option("header", True).option("compression", "gzip").csv(f"{folder}/{name}")
    return folder, T.new_folder(spark, "store")


def _raw(df: DataFrame) -> DataFrame:
    return df.drop("batch_id", "ingested_at")


def ingested_history(spark, d) -> DataFrame:
    """The history dropped as CSV files, found, ingested and read as the latest committed batch."""
    folder, root = _dropped(spark, d, "orH_1", _raw(D.raw_history(spark, d)))
    G.ingest(spark, "history", G.find_extract(spark, folder, "orH"), root, BATCH, RUN_TIME)
    return S.standardize(G.latest_batch(G.committed(spark, "history", root)), C.HISTORY, RUN_TIME)


def extract_headers(spark, d) -> DataFrame:
    """The history as files of one extract whose columns stand in two orders, with line feeds, commas and quotes in its
    descriptions, each file read by its own header."""
    raw = _raw(D.raw_history(spark, d))
    n = F.col("ornum").cast("bigint") % 4
    text = F.when(n == 0, F.concat("ordes1", F.lit('\n"two", lines'))).when(n == 1, F.concat(F.lit('"'), "ordes1", F.lit(',"'))).otherwise(F.col("ordes1"))
    raw = raw.withColumn("ordes1", text)
    folder, root = T.new_folder(spark, "drop"), T.new_folder(spark, "store")
    for part, columns in ((raw.where(n < 3), raw.columns), (raw.where(n == 3), raw.columns[::-1])):
        part.select(*columns).write.mode("append").option("header", True).option("escape", '"').csv(f"{folder}/orH_1")
    G.ingest(spark, "history", f"{folder}/orH_1", root, BATCH, RUN_TIME)
    return S.standardize(G.read_batch(spark, "history", root), C.HISTORY, RUN_TIME)


def _two_batches(spark, d) -> str:
    """A store of two batches of the history, of which the second has a column more and one less."""
    raw = _raw(D.raw_history(spark, d))
    folder, root = _dropped(spark, d, "orH_1", raw.where("orodt8 < '19960101'"))
    raw.where("orodt8 >= '19960101'").drop("ordrte").withColumn("surprise", F.col("ornum")).write.option("header", True).csv(f"{folder}/orH_2")
    for k in (1, 2):
        G.ingest(spark, "history", f"{folder}/orH_{k}", root, f"2024010{k}_000000", RUN_TIME)
    return root


def batch_schemas(spark, d) -> DataFrame:
    """What each batch holds of the columns that only one of them has."""
    return G.committed(spark, "history", _two_batches(spark, d)).groupBy("batch_id").agg(F.count("*").alias("rows"), F.count("surprise").alias("surprises"), F.count("ordrte").alias("routes"))


def late_drift(spark, d) -> DataFrame:
    """Drift of the last batch by its own columns, with its rows."""
    last = G.read_batch(spark, "history", _two_batches(spark, d))
    return S.drifted(last, C.HISTORY)


def reused_batch(spark, d) -> DataFrame:
    """Another extract under a batch id in use is refused, and the rows of the batch stay."""
    raw = _raw(D.raw_open(spark, d))
    folder, root = _dropped(spark, d, "open_1", raw.where("ornum % 2 = 0"))
    raw.where("ornum % 2 = 1").write.option("header", True).csv(f"{folder}/open_2")
    G.ingest(spark, "open", f"{folder}/open_1", root, BATCH, RUN_TIME)
    try:
        G.ingest(spark, "open", f"{folder}/open_2", root, BATCH, RUN_TIME)
        refused = False
    except S.ContractError:
        refused = True
    return G.committed(spark, "open", root).groupBy("batch_id").agg(F.count("*").alias("rows"), F.min(F.col("ornum").cast("bigint") % 2).alias("least"), F.max(F.col("ornum").cast("bigint") % 2).alias("most")).withColumn("refused", F.lit(refused))


def file_hashes(spark, d) -> DataFrame:
    """Hash, size and header of files of customers' names, one file a region."""
    rows = D.read(spark, d, "customer").join(D.read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    folder = T.new_folder(spark, "drop")
    for r in D.read(spark, d, "region").select("r_regionkey").collect():  # five
        rows.where(F.col("n_regionkey") == r.r_regionkey).orderBy("c_custkey").select("c_name").coalesce(1).write.mode("append").text(folder)
    return Z.scanned(spark, folder).select("source_file_hash", "bytes", F.element_at("header", 1).alias("first"))


def mapping_versions(spark, d) -> DataFrame:
    """Customers published after an earlier batch and again after all; a second publisher from the first version is
    refused. The current version."""
    facts, root = history(spark, d), T.new_folder(spark, "mapping")
    early = I.map_customers(I.profile_customers(_early(facts)))
    G.publish(early, root, 0)
    G.publish(I.map_customers(I.profile_customers(facts), G.current(spark, root)), root, 1)
    try:
        G.publish(early, root, 1)
    except S.ContractError:
        return G.current(spark, root)
    raise AssertionError("a stale publisher was not refused")


def one_to_one_tiers(spark, d) -> DataFrame:
    """Keys with several codes and codes with several keys in mappings that were broken by rule."""
    customers, products = _broken(spark, d)
    return I.two_ways(products, "first_half_sku_code", "pseudo_first_half_sku_code").unionByName(I.two_ways(customers, "customer_hash_key", "pseudo_customer_name"))



def ingested_inventory(spark, d) -> DataFrame:
    """Two stock extracts, of which the second is ingested twice, by force; rows by snapshot."""
    stock = D.raw_inventory(spark, d).drop("warehouse_code", "snapshot_date")
    folder, root = _dropped(spark, d, "inventory_20240101", stock)
    stock.where("qty <> '1'").write.option("header", True).csv(f"{folder}/inventory_20240108")
    for name, force in (("inventory_20240101", False), ("inventory_20240108", False), ("inventory_20240108", True)):
        out = G.ingest_inventory(spark, f"{folder}/{name}", root, RUN_TIME, force)
    return out.groupBy("warehouse_code", "snapshot_date").agg(F.count("*").alias("rows"), F.count_distinct("sku").alias("skus"))


def manifest_records(spark, d) -> DataFrame:
    """Rows and columns of each dataset as its manifest has them."""
    folder, root = _dropped(spark, d, "open_1", _raw(D.raw_open(spark, d)))
    _raw(D.raw_history(spark, d)).write.option("header", True).option("compression", "gzip").csv(f"{folder}/orH_1")
    for dataset, name in (("open", "open_1"), ("history", "orH_1")):
        G.ingest(spark, dataset, f"{folder}/{name}", root, BATCH, RUN_TIME)
    return G.read_manifest(spark, root).groupBy("dataset", "batch_id", "column_count").agg(F.sum("rows").alias("rows"))


def _by_year(out: DataFrame) -> DataFrame:
    return out.withColumn("batch_id", F.concat(F.substring("order_date", 1, 4), F.lit("0101_000000")))


def report_sink(spark, d) -> DataFrame:
    """The dirty history's report, written and read again."""
    return Q.write_report(report("history", _dirty(spark, d), checks=True), T.new_folder(spark, "reports"), "history")


def landed(spark, d) -> DataFrame:
    """Batches by year with reports, landed by one commit, of which one is landed anew; rows by batch as they arrived."""
    out = _by_year(history_out(spark, d))
    reports = out.select(F.col("batch_id").alias("batch")).distinct().select("batch", F.lit("passed").alias("overall_status"))
    target = T.new_folder(spark, "land")
    G.land(out, reports, target, "history")
    G.land(out.where("batch_id = '19950101_000000'"), reports, target, "history")
    arrived = G.landed(spark, target, "history", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema))
    return arrived.groupBy("batch_id").agg(F.count("*").alias("rows"), F.count_distinct("row_hash").alias("hashes"))


def whole_history(spark, d) -> DataFrame:
    """Pseudonymised history, written with its rows counted on the way; hashes that occur once and more often."""
    return history_out(spark, d).groupBy("row_hash").agg(F.count("*").alias("n")).groupBy("n").agg(F.count("*").alias("hashes"))


def profiles_written(spark, d) -> DataFrame:
    """The profiles as files; that of the categories read again."""
    products, root = I.profile_products(history(spark, d)), T.new_folder(spark, "profiles")
    G.write_profiles(I.profile_customers(history(spark, d)), products, I.category_profile(products), root)
    return spark.read.schema("product_category string, products bigint").parquet(f"{root}/category_profile")


def refusals(spark, d) -> DataFrame:
    """Tables that a stage must refuse, with their rows and whether it did: a header with a name twice, a column that is
    missing, no rows, stock of two days."""
    facts, stock = history(spark, d), inventory(spark, d)
    folder, root = _dropped(spark, d, "orH_1", _raw(D.raw_history(spark, d)).withColumn(" ORNUM", F.lit("x")))
    two_days = stock.withColumn("snapshot_date", F.when(F.col("pallet_number") == "1", F.lit("20240102")).otherwise(F.col("snapshot_date")))
    products, customers = skus_first(spark, d), customers_first(spark, d)
    tries = {
        "name twice": (facts, lambda: G.ingest(spark, "history", f"{folder}/orH_1", root, BATCH, RUN_TIME)),
        "column missing": (facts, lambda: P.pseudonymize_orders(facts.drop("unique_sku_code"), products, customers, RUN_TIME)),
        "no rows": (facts.where("order_number < ''"), lambda: P.pseudonymize_orders(facts.where("order_number < ''"), products, customers, RUN_TIME)),
        "two days": (two_days, lambda: P.pseudonymize_inventory(two_days, products, RUN_TIME)),
    }
    out = None
    for rule, (table, stage) in tries.items():
        try:
            stage()
            refused = False
        except S.ContractError:
            refused = True
        row = table.agg(F.count("*").alias("rows")).select(F.lit(rule).alias("rule"), "rows", F.lit(refused).alias("refused"))
        out = row if out is None else out.unionByName(row)
    return out


def constant_column(spark, d) -> DataFrame:
    stock = inventory(spark, d)
    return stock.agg(F.count("*").alias("rows")).withColumn("snapshot", F.lit(S.constant(stock, "snapshot_date")))


def hash_without_columns(spark, d) -> DataFrame:
    """Row hashes of a history that lacks columns of the hash, and how often each occurs."""
    return P.hashed(history(spark, d).drop("order_date", "quantity_short"), C.HISTORY_HASH, RUN_TIME).groupBy("row_hash").agg(F.count("*").alias("n"))


QUERIES = {
    "null_identities": lambda s, d: I.null_counts(_holes(s, d), I.IDENTITY),
    "critical_product_nulls": lambda s, d: I.null_counts(_holes(s, d), I.PRODUCT),
    "unmapped_categories": unmapped_categories,
    "sequence_state": sequence_state,
    "unknown_category_state": lambda s, d: I.unknown_state(products_open(s, d)),
    "numbering_keeps_nulls": numbering_keeps_nulls,
    "first_unmapped_skus": lambda s, d: P.first_unmapped(P.with_products(P.distinct_skus(open_orders(s, d)), skus_first(s, d)), "full_sku_code", "pseudo_full_sku_code"),
    "text_nulls": text_nulls,
    "time_and_batch_ids": times,
    "ingested_history": ingested_history,
    "ingested_inventory": ingested_inventory,
    "manifest_records": manifest_records,
    "validated_dirty": lambda s, d: Q.validated_counts("history", _dirty(s, d)),
    "validated_history": lambda s, d: Q.validated_counts("history", history_out(s, d)),
    "validated_open": lambda s, d: Q.validated_counts("open", open_out(s, d)),
    "validated_inventory": lambda s, d: Q.validated_counts("inventory", inventory_out(s, d)),
    "report_sink": report_sink,
    "landed": landed,
    "whole_history": whole_history,
    "extract_headers": extract_headers,
    "batch_schemas": batch_schemas,
    "late_drift": late_drift,
    "reused_batch": reused_batch,
    "file_hashes": file_hashes,
    "mapping_versions": mapping_versions,
    "one_to_one_tiers": one_to_one_tiers,
    "dataset_types": dataset_types,
    "profiles_written": profiles_written,
    "refusals": refusals,
    "constant_column": constant_column,
    "hash_without_columns": hash_without_columns,
    "standardize_history": history,
    "standardize_open": open_orders,
    "standardize_inventory": inventory,
    "schema_drift": schema_drift,
    "dataset_summary": dataset_summary,
    "latest_batch": latest_batch,
    "batch_metadata": batch_metadata,
    "scalar_functions": scalars,
    "snapshot_dates": snapshots,
    "newest_file": newest_file,
    "new_files": new_files,
    "snapshot_guard": snapshot_guard,
    "customer_base": lambda s, d: I.profile_customers(history(s, d)),
    "product_base": lambda s, d: I.profile_products(history(s, d)),
    "category_profile": lambda s, d: I.category_profile(I.profile_products(history(s, d))),
    "customer_mapping_first": customers_first,
    "customer_mapping_incremental": customers_incremental,
    "product_mapping_first": products_first,
    "product_mapping_incremental": lambda s, d: skus_incremental(s, d).select("full_sku_code", "pseudo_category", "pseudo_product_description"),
    "sku_prefixes": lambda s, d: I.sku_prefixes(products_first(s, d)),
    "sku_full_codes": lambda s, d: skus_first(s, d).select("full_sku_code", "pseudo_full_sku_code"),
    "sku_group_codes": lambda s, d: skus_first(s, d).select("first_half_sku_code", "pseudo_first_half_sku_code").distinct(),
    "sku_base_codes": lambda s, d: skus_first(s, d).select("unique_sku_code", "pseudo_unique_sku_code").distinct(),
    "backfill_customers": customers_all,
    "backfill_products_open": products_open,
    "backfill_products_inventory": products_all,
    "pseudonymize_history": history_out,
    "pseudonymize_open": open_out,
    "pseudonymize_inventory": inventory_out,
    "unmapped_skus": unmapped_skus,
    "unmapped_customers": unmapped_customers,
    "fanout_keys": fanout_keys,
    "mapping_violations": mapping_violations,
    "mapping_violations_clean": mapping_violations_clean,
    "bad_pseudonyms": bad_pseudonyms,
    "critical_nulls": critical_nulls,
    "negative_values": negative_values,
    "duplicate_row_hashes": duplicate_row_hashes,
    "duplicate_rows_export": duplicate_rows_export,
    "quality_report_history": lambda s, d: report("history", history_out(s, d)),
    "quality_report_open": lambda s, d: report("open", open_out(s, d)),
    "quality_report_inventory": lambda s, d: report("inventory", inventory_out(s, d)),
    "quality_checks_dirty": lambda s, d: report("history", _dirty(s, d), checks=True),
    "land_authorized": land_authorized,
}

# One chain of common table expressions; each query selects from it, and DuckDB runs only what that needs.
_COMMON = """'01' AS orcomp, o_custkey::VARCHAR AS orsocs, c_nationkey::VARCHAR AS orshcs, c_name AS orshnm, 'PO-' || o_orderkey AS orpo,
 o_orderkey::VARCHAR AS ornum, o_orderpriority[1:1] AS ortype, strftime(o_orderdate, '%Y%m%d') AS orodt8, strftime(l_shipdate, '%Y%m%d') AS orsdt8,
 'user' || l_suppkey AS oruser, o_orderstatus AS orstat, p_name || ' ' || p_brand AS ordes1, l_quantity::DECIMAL(18,2)::VARCHAR AS q,
 l_extendedprice::DECIMAL(18,2)::VARCHAR AS amt, sku, p_type"""
_JOIN = """FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
 JOIN (SELECT *, n[1:6] || '-' || n[7:] AS sku FROM (SELECT *, lpad(((p_partkey % 97 + 1) * 100000 + p_partkey // 97 + 1)::VARCHAR, 11, '0') AS n FROM part)) ON l_partkey = p_partkey"""
_NAN = lambda cs: "md5(concat_ws('|', " + ", ".join(f"coalesce({c}, 'nan')" for c in cs) + "))"
_LOOK = {"full_sku_code": "pseudo_full_sku_code", "first_half_sku_code": "pseudo_first_half_sku_code", "unique_sku_code": "pseudo_unique_sku_code", "product_description": "pseudo_product_description", "customer_name": "pseudo_customer_name", "product_category": "pseudo_category"}


def _out(kind: str, columns: list[str], hash_columns: list[str], drops: list[str]) -> str:
    """Columns of a pseudonymised table over a joined one."""
    inner = ", ".join(f"{_LOOK[c]} AS {c}" if c in _LOOK else c for c in columns)
    kept = ", ".join(c for c in columns if c not in drops)
    return f"SELECT {kept}, {kind}, {_NAN(hash_columns)} AS row_hash, '{RUN_TIME}' AS pseudonymized_at FROM (SELECT {inner} FROM %s)"


_HIST = [*C.HISTORY.values(), "standardized_at"]
_OPEN = [*C.OPEN_ORDERS.values(), "standardized_at"]
_KEY = "md5(concat_ws('|', {0}source_customer_code, {0}ship_to_customer_code, {0}customer_name))"
_INIT = "upper(array_to_string(list_transform(list_filter(string_split({0}, ' '), lambda w: w <> ''), lambda w: w[1:1]), ''))"


def _tiers(name: str, source: str) -> str:
    """Group and base codes for a table that has full codes: known ones stay, new keys follow by key."""
    return f""", {name}g AS (SELECT k, coalesce(old, 'SKU-GRP-' || lpad((m + row_number() OVER (PARTITION BY old IS NULL ORDER BY k))::VARCHAR, 5, '0')) AS code FROM
   (SELECT first_half_sku_code AS k, min(pseudo_first_half_sku_code) AS old FROM {source} GROUP BY 1), (SELECT coalesce(max(regexp_extract(pseudo_first_half_sku_code, '(\\d+)$', 1)::BIGINT), 0) AS m FROM {source})),
 {name}u AS (SELECT k, coalesce(old, 'SKU-BASE-' || lpad((m + row_number() OVER (PARTITION BY old IS NULL ORDER BY k))::VARCHAR, 5, '0')) AS code FROM
   (SELECT unique_sku_code AS k, min(pseudo_unique_sku_code) AS old FROM {source} GROUP BY 1), (SELECT coalesce(max(regexp_extract(pseudo_unique_sku_code, '(\\d+)$', 1)::BIGINT), 0) AS m FROM {source})),
 {name} AS MATERIALIZED (SELECT s.* REPLACE ({name}g.code AS pseudo_first_half_sku_code, {name}u.code AS pseudo_unique_sku_code) FROM {source} s JOIN {name}g ON {name}g.k = first_half_sku_code JOIN {name}u ON {name}u.k = unique_sku_code)"""


def _products(name: str, base: str, old: str | None) -> str:
    """Product mapping and full codes of base, after old where there is one."""
    anti = f"WHERE full_sku_code NOT IN (SELECT full_sku_code FROM {old})" if old else ""
    last = f"coalesce((SELECT max(regexp_extract(pseudo_product_description, '(\\d+)$', 1)::BIGINT) FROM {old} o WHERE o.pseudo_category = n.pseudo_category), 0)" if old else "0"
    last_sku = f"coalesce((SELECT max(regexp_extract(pseudo_full_sku_code, '(\\d+)$', 1)::BIGINT) FROM {old} o WHERE o.pseudo_category = d.pseudo_category), 0)" if old else "0"
    union = f"SELECT * FROM {old} UNION ALL" if old else ""
    return f""", {name}n AS (SELECT b.*, c.pseudo_category, row_number() OVER (PARTITION BY c.pseudo_category ORDER BY product_description, full_sku_code) AS i FROM {base} b LEFT JOIN categories c USING (product_category) {anti}),
 {name}d AS (SELECT full_sku_code, first_half_sku_code, unique_sku_code, product_description, product_category, pseudo_category, i + {last} AS seq,
   pseudo_category || ' Product ' || {_INIT.format("pseudo_category")} || '-' || lpad((i + {last})::VARCHAR, greatest(3, len((i + {last})::VARCHAR))::INTEGER, '0') AS pseudo_product_description FROM {name}n n),
 {name}f AS ({union} SELECT full_sku_code, first_half_sku_code, unique_sku_code, product_description, product_category, pseudo_category, pseudo_product_description,
   'SKU-' || sku_prefix || '-' || lpad((row_number() OVER (PARTITION BY d.pseudo_category ORDER BY seq) + {last_sku})::VARCHAR, 6, '0') AS pseudo_full_sku_code, NULL::VARCHAR AS pseudo_first_half_sku_code, NULL::VARCHAR AS pseudo_unique_sku_code
   FROM {name}d d JOIN prefixes USING (pseudo_category))""" + _tiers(name, f"{name}f")


def _backfill(name: str, found: str, old: str) -> str:
    return f""", {name}n AS (SELECT full_sku_code, m.*, row_number() OVER (ORDER BY full_sku_code) AS i FROM (SELECT full_sku_code, min(struct_pack(product_description := product_description, f := first_half_sku_code, u := unique_sku_code)) AS m FROM {found} GROUP BY 1)
   WHERE full_sku_code NOT IN (SELECT full_sku_code FROM {old})),
 {name}m AS (SELECT coalesce(max(regexp_extract(pseudo_product_description, '(\\d+)$', 1)::BIGINT), 0) AS d, coalesce(max(regexp_extract(pseudo_full_sku_code, '(\\d+)$', 1)::BIGINT), 0) AS s FROM {old} WHERE pseudo_category = 'Unknown Category'),
 {name}f AS (SELECT * FROM {old} UNION ALL SELECT full_sku_code, f, u, product_description, 'UNKNOWN', 'Unknown Category', 'Unknown Category Product UC-' || lpad((i + d)::VARCHAR, greatest(3, len((i + d)::VARCHAR))::INTEGER, '0'),
   'SKU-UC2-' || lpad((i + s)::VARCHAR, 6, '0'), NULL, NULL FROM {name}n, {name}m)""" + _tiers(name, f"{name}f")


_CTE = f"""WITH raw_h AS (SELECT {_COMMON} {_JOIN} WHERE {D.IN_HISTORY}),
 raw_o AS (SELECT {_COMMON} {_JOIN} WHERE NOT {D.IN_HISTORY}),
 h AS MATERIALIZED (SELECT orcomp AS company_code, orsocs AS source_customer_code, orshcs AS ship_to_customer_code, orshnm AS customer_name, orpo AS purchase_order_number, ornum AS order_number, ortype AS order_type,
   orodt8 AS order_date, orsdt8 AS scheduled_ship_date, orsdt8 AS shipped_date, oruser AS created_by_user, 'R1' AS delivery_route, orstat AS order_status, q AS ordered_quantity, sku AS full_sku_code, sku[1:6] AS first_half_sku_code,
   sku[8:] AS unique_sku_code, ordes1 AS product_description, '0.00' AS secondary_order_quantity, q AS final_order_quantity, q AS shipped_order_quantity, '0.00' AS quantity_short, '1.00' AS shipped_order_weight, amt AS order_amount,
   p_type AS product_category, '{BATCH}' AS batch_id, '{RUN_TIME}' AS ingested_at_datetime, '{RUN_TIME}' AS standardized_at FROM raw_h),
 o AS MATERIALIZED (SELECT orcomp AS company_code, orsocs AS source_customer_code, orshcs AS ship_to_customer_code, orshnm AS customer_name, orpo AS purchase_order_number, ornum AS order_number, orodt8 AS order_date, orsdt8 AS scheduled_ship_date,
   orstat AS order_status, sku[1:6] AS first_half_sku_code, sku[8:] AS unique_sku_code, ordes1 AS product_description, q AS final_order_quantity, q AS shipped_order_quantity, ortype AS order_type, '2.00' AS estimated_order_weight,
   'North' AS delivery_route_name, 'R2' AS delivery_route, orsdt8 AS customer_requested_date, orsdt8 AS revised_delivery_date, '1.00' AS shipped_order_weight, sku AS full_sku_code, amt AS order_amount, '{BATCH}' AS batch_id,
   '{RUN_TIME}' AS ingested_at_datetime, '{RUN_TIME}' AS standardized_at FROM raw_o),
 iv AS (SELECT num::VARCHAR || CASE WHEN key % 10 = 0 THEN '.0' ELSE '' END AS raw_sku, text AS product_description, pallet AS pallet_number, 'L1' AS lot_number, 'S1' AS slot_location, 'N' AS pallet_held_flag,
   '20231201' AS production_date, '20241201' AS best_before_date, '0' AS reserved_quantity, size AS quantity_on_hand, price::DECIMAL(18,2)::VARCHAR AS weight, '305' AS warehouse_code, '20240101' AS snapshot_date,
   '{RUN_TIME}' AS standardized_at, lpad(num::VARCHAR, 11, '0')[1:6] AS first_half_sku_code, lpad(num::VARCHAR, 11, '0')[7:] AS unique_sku_code, lpad(num::VARCHAR, 11, '0')[1:6] || '-' || lpad(num::VARCHAR, 11, '0')[7:] AS full_sku_code
   FROM (SELECT (p_partkey % 97 + 1) * 100000 + p_partkey // 97 + 1 AS num, p_partkey AS key, p_name || ' ' || p_brand AS text, p_partkey::VARCHAR AS pallet, p_size::VARCHAR AS size, p_retailprice AS price FROM part
   UNION ALL SELECT (s_suppkey % 97 + 201) * 100000 + s_suppkey // 97 + 1, s_suppkey, s_name || ' sample', 'S' || s_suppkey, '1', s_acctbal FROM supplier)),
 categories AS (SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in C.CATEGORIES)}) t(product_category, pseudo_category)),
 cb AS (SELECT DISTINCT {_KEY.format("")} AS customer_hash_key, * FROM (SELECT source_customer_code, ship_to_customer_code, upper(customer_name) AS customer_name FROM h)),
 cbe AS (SELECT DISTINCT {_KEY.format("")} AS customer_hash_key, * FROM (SELECT source_customer_code, ship_to_customer_code, upper(customer_name) AS customer_name FROM h WHERE order_date < '19960101')),
 cbo AS (SELECT DISTINCT {_KEY.format("")} AS customer_hash_key, * FROM (SELECT source_customer_code, ship_to_customer_code, upper(customer_name) AS customer_name FROM o)),
 cm AS (SELECT *, 'Customer CUST-' || lpad((row_number() OVER (ORDER BY customer_hash_key))::VARCHAR, 6, '0') AS pseudo_customer_name FROM cb),
 cme AS (SELECT *, 'Customer CUST-' || lpad((row_number() OVER (ORDER BY customer_hash_key))::VARCHAR, 6, '0') AS pseudo_customer_name FROM cbe),
 cmi AS (SELECT * FROM cme UNION ALL SELECT *, 'Customer CUST-' || lpad(((SELECT count(*) FROM cme) + row_number() OVER (ORDER BY customer_hash_key))::VARCHAR, 6, '0') FROM cb WHERE customer_hash_key NOT IN (SELECT customer_hash_key FROM cme)),
 cma AS (SELECT * FROM cm UNION ALL SELECT *, 'Customer CUST-' || lpad(((SELECT count(*) FROM cm) + row_number() OVER (ORDER BY customer_hash_key))::VARCHAR, 6, '0') FROM cbo WHERE customer_hash_key NOT IN (SELECT customer_hash_key FROM cm)),
 pb AS (SELECT DISTINCT full_sku_code, first_half_sku_code, unique_sku_code, product_description, product_category FROM h),
 pbe AS (SELECT DISTINCT full_sku_code, first_half_sku_code, unique_sku_code, product_description, product_category FROM h WHERE order_date < '19960101'),
 prefixes AS (SELECT pseudo_category, b || CASE WHEN i > 1 THEN i::VARCHAR ELSE '' END AS sku_prefix FROM (SELECT pseudo_category, b, row_number() OVER (PARTITION BY b ORDER BY pseudo_category) AS i
   FROM (SELECT DISTINCT pseudo_category, {_INIT.format("pseudo_category")} AS b FROM pb JOIN categories USING (product_category))))
 {_products("pm", "pb", None)} {_products("pe", "pbe", None)} {_products("pi", "pb", "pe")} {_backfill("po", "o", "pm")} {_backfill("pa", "iv", "po")},
 hj AS (SELECT h.*, m.pseudo_category, m.pseudo_product_description, m.pseudo_full_sku_code, m.pseudo_first_half_sku_code, m.pseudo_unique_sku_code, pseudo_customer_name FROM h LEFT JOIN pm m USING (full_sku_code)
   LEFT JOIN cm ON cm.customer_hash_key = md5(concat_ws('|', h.source_customer_code, h.ship_to_customer_code, upper(h.customer_name)))),
 oj AS (SELECT o.*, NULL AS product_category, m.pseudo_category, m.pseudo_product_description, m.pseudo_full_sku_code, m.pseudo_first_half_sku_code, m.pseudo_unique_sku_code, pseudo_customer_name FROM o LEFT JOIN po m USING (full_sku_code)
   LEFT JOIN cma ON cma.customer_hash_key = md5(concat_ws('|', o.source_customer_code, o.ship_to_customer_code, upper(o.customer_name)))),
 ho AS MATERIALIZED ({_out("true AS original_customer_removed, true AS original_sku_removed, true AS original_product_removed, true AS original_user_removed", _HIST, C.HISTORY_HASH, ["source_customer_code", "ship_to_customer_code", "created_by_user"]) % "hj"}),
 oo AS ({_out("true AS original_customer_removed, true AS original_sku_removed, true AS original_product_removed, true AS product_category_derived", [*_OPEN, "product_category"], C.OPEN_HASH, ["source_customer_code", "ship_to_customer_code"]) % "oj"}),
 io AS (SELECT * EXCLUDE (raw_sku, first_half_sku_code, unique_sku_code), true AS product_category_derived, true AS original_sku_removed, true AS original_product_removed, {_NAN(C.INVENTORY_HASH)} AS row_hash, '{RUN_TIME}' AS pseudonymized_at
   FROM (SELECT iv.* REPLACE (m.pseudo_full_sku_code AS full_sku_code, m.pseudo_product_description AS product_description), m.pseudo_category AS product_category FROM iv LEFT JOIN pa m ON m.full_sku_code = iv.full_sku_code)),
 dirty0 AS (SELECT * REPLACE (CASE WHEN order_number::BIGINT % 11 = 0 THEN 'Acme' ELSE customer_name END AS customer_name, CASE WHEN order_number::BIGINT % 13 = 0 THEN NULL ELSE product_description END AS product_description,
   CASE WHEN order_number::BIGINT % 17 = 0 THEN '-' || order_amount WHEN order_number::BIGINT % 19 = 0 THEN 'n/a' ELSE order_amount END AS order_amount) FROM ho),
 dirty AS (SELECT * FROM dirty0 UNION ALL SELECT * FROM dirty0 WHERE order_number::BIGINT % 23 = 0),
 c2 AS (SELECT * REPLACE (CASE WHEN n % 10 = 0 THEN NULL WHEN n % 10 = 1 THEN 'Customer CUST-000002' ELSE pseudo_customer_name END AS pseudo_customer_name) FROM (SELECT *, right(pseudo_customer_name, 6)::BIGINT AS n FROM cm)),
 holes AS (SELECT * REPLACE (CASE WHEN order_number::BIGINT % 29 = 0 THEN NULL ELSE customer_name END AS customer_name, CASE WHEN order_number::BIGINT % 31 = 0 THEN NULL ELSE ship_to_customer_code END AS ship_to_customer_code,
   CASE WHEN order_number::BIGINT % 37 = 0 THEN NULL ELSE product_description END AS product_description, CASE WHEN order_number::BIGINT % 41 = 0 THEN NULL ELSE product_category END AS product_category) FROM h),
 p2 AS (SELECT * FROM pm UNION ALL SELECT * REPLACE ('SKU-GRP-99999' AS pseudo_first_half_sku_code) FROM pm WHERE full_sku_code < '000003')
 """
_MAP = ", ".join(C.PRODUCT_MAPPING)
_CUST = ", ".join(C.CUSTOMER_MAPPING)


def _violations(customers: str, products: str) -> str:
    parts = []
    for t, k, p in [(customers, "customer_hash_key", "pseudo_customer_name"), *((products, f"{x}_sku_code", f"pseudo_{x}_sku_code") for x in ("full", "first_half", "unique"))]:
        parts += [f"SELECT 'split {k}' AS rule, {k} AS value, count(DISTINCT {p}) AS n FROM {t} GROUP BY {k} HAVING count(DISTINCT {p}) > 1", f"SELECT 'collision {p}', {p}, count(DISTINCT {k}) FROM {t} GROUP BY {p} HAVING count(DISTINCT {k}) > 1"]
        parts += [f"SELECT 'null {c}', NULL, count(*) FROM {t} WHERE {c} IS NULL HAVING count(*) > 0" for c in (k, p)]
    parts += [f"SELECT 'null pseudo_category', NULL, count(*) FROM {products} WHERE pseudo_category IS NULL HAVING count(*) > 0"]
    for t, c, test in ((customers, "pseudo_customer_name", "starts_with(pseudo_customer_name, 'Customer CUST-')"), (products, "pseudo_product_description", "contains(pseudo_product_description, ' Product ')")):
        parts.append(f"SELECT 'format {c}', NULL, count(*) FROM {t} WHERE NOT coalesce({test}, false) HAVING count(*) > 0")
    parts += [f"SELECT 'repeated {k}', {k}, count(*) FROM {t} GROUP BY {k} HAVING count(*) > 1" for t, k in ((customers, "customer_hash_key"), (products, "full_sku_code"))]
    return " UNION ALL ".join(parts)


def _checks(t: str, gate: dict) -> str:
    tests = {"customer": "NOT coalesce(starts_with(customer_name, 'Customer CUST-'), false)", "product": "NOT coalesce(contains(product_description, ' Product '), false)", "sku": "NOT coalesce(starts_with(full_sku_code, 'SKU-'), false)"}
    total = lambda xs: " + ".join(f"count(*) FILTER ({x})" for x in xs)
    rows = {"row_count": "count(*)", "critical_nulls": total(f"{c} IS NULL" for c in gate["critical"]), "row_hash_completeness": "count(*) FILTER (row_hash IS NULL)", "negative_numeric_values": total(f"TRY_CAST({c} AS DOUBLE) < 0" for c in gate["numeric"]), "duplicate_row_hash": "count(*) - count(DISTINCT row_hash)", "required_columns": "0 * count(*)"}
    rows |= {f"{k}_pseudonymization": f"count(*) FILTER ({tests[k]})" for k in gate["pseudonyms"]}
    found = " UNION ALL ".join(f"SELECT '{k}' AS \"check\", ({v})::BIGINT AS n FROM {t}" for k, v in rows.items())
    return f"""SELECT '{BATCH}' AS batch, "check", CASE WHEN "check" = 'row_count' THEN CASE WHEN n = 0 THEN 'failed' ELSE 'passed' END WHEN n = 0 THEN 'passed' WHEN "check" IN ('duplicate_row_hash', 'negative_numeric_values') THEN 'warning' ELSE 'failed' END AS status, n FROM ({found})"""


def _report(t: str, gate: dict) -> str:
    return f"""SELECT batch, CASE WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_or(status = 'warning') THEN 'passed_with_warnings' ELSE 'passed' END AS overall_status,
 coalesce(string_agg("check", ',' ORDER BY "check") FILTER (status = 'failed'), '') AS failed_checks, coalesce(string_agg("check", ',' ORDER BY "check") FILTER (status = 'warning'), '') AS warning_checks FROM ({_checks(t, gate)}) GROUP BY batch"""


def _validated(t: str, kinds: dict[str, str]) -> str:
    bad = "".join(f", count(*) FILTER (NOT coalesce({test}, false)) AS bad_{k}_rows" for k, test in kinds.items())
    return f"SELECT count(*) AS rows{bad}, count(*) FILTER (row_hash IS NULL) AS missing_hashes, count(*) - count(DISTINCT row_hash) AS duplicates FROM {t}"


_IS = {"customer": "starts_with(customer_name, 'Customer CUST-')", "product": "contains(product_description, ' Product ')", "sku": "starts_with(full_sku_code, 'SKU-')"}
_ORDER_KINDS, _STOCK_KINDS = {k: _IS[k] for k in ("customer", "product")}, {k: _IS[k] for k in ("product", "sku")}

_SELECT = {
    "null_identities": "SELECT " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in ("source_customer_code", "ship_to_customer_code", "customer_name")) + " FROM holes",
    "critical_product_nulls": "SELECT " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in ("full_sku_code", "first_half_sku_code", "unique_sku_code", "product_description", "product_category")) + " FROM holes",
    "unmapped_categories": "SELECT product_category, count(*) AS products FROM (SELECT DISTINCT full_sku_code, product_category FROM holes) WHERE product_category IS NULL OR product_category = 'PROMO' GROUP BY 1",
    "sequence_state": "SELECT count(*) AS rows, count(*) FILTER (n % 7 = 0) AS malformed, max(n) FILTER (n % 7 <> 0) AS last FROM (SELECT right(pseudo_customer_name, 6)::BIGINT AS n FROM cm)",
    "unknown_category_state": "SELECT count(*) AS rows, count(DISTINCT pseudo_full_sku_code[5:7]) AS prefixes, coalesce(max(regexp_extract(pseudo_product_description, '(\\d+)$', 1)::BIGINT), 0) AS last FROM po WHERE pseudo_category = 'Unknown Category'",
    "numbering_keeps_nulls": "SELECT *, row_number() OVER (PARTITION BY product_category ORDER BY order_number, full_sku_code) AS seq FROM (SELECT product_category, order_number, full_sku_code, count(*) AS lines FROM holes GROUP BY 1, 2, 3)",
    "first_unmapped_skus": "SELECT DISTINCT full_sku_code FROM o WHERE full_sku_code NOT IN (SELECT full_sku_code FROM pm) ORDER BY 1 LIMIT 20",
    "text_nulls": "SELECT p_partkey, CASE WHEN p_partkey % 3 = 2 THEN p_brand END AS brand FROM part",
    "time_and_batch_ids": "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d_%H%M%S_%f') AS stamp, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso, CASE WHEN o_orderkey % 3 <> 0 THEN strftime(o_orderdate, '%Y%m%d_%H%M%S') END AS batch FROM orders",
    "ingested_history": "SELECT * FROM h",
    "ingested_inventory": "SELECT '305' AS warehouse_code, day AS snapshot_date, count(*) AS rows, count(DISTINCT raw_sku) AS skus FROM iv, (VALUES ('20240101'), ('20240108')) t(day) WHERE day = '20240101' OR quantity_on_hand <> '1' GROUP BY 2",
    "manifest_records": f"SELECT 'history' AS dataset, '{BATCH}' AS batch_id, 27 AS column_count, count(*) AS rows FROM h UNION ALL SELECT 'open', '{BATCH}', 28, count(*) FROM o",
    "validated_dirty": _validated("dirty", _ORDER_KINDS),
    "validated_history": _validated("ho", _ORDER_KINDS),
    "validated_open": _validated("oo", _ORDER_KINDS),
    "validated_inventory": _validated("io", _STOCK_KINDS),
    "report_sink": _report("dirty", C.GATES["history"]),
    "landed": "SELECT order_date[1:4] || '0101_000000' AS batch_id, count(*) AS rows, count(DISTINCT row_hash) AS hashes FROM ho GROUP BY 1",
    "whole_history": "SELECT n, count(*) AS hashes FROM (SELECT count(*) AS n FROM ho GROUP BY row_hash) GROUP BY n",
    "extract_headers": """SELECT * REPLACE (CASE order_number::BIGINT % 4 WHEN 0 THEN product_description || chr(10) || '"two", lines' WHEN 1 THEN '"' || product_description || ',"' ELSE product_description END AS product_description) FROM h""",
    "batch_schemas": "SELECT CASE WHEN order_date < '19960101' THEN '20240101_000000' ELSE '20240102_000000' END AS batch_id, count(*) AS rows, count(*) FILTER (order_date >= '19960101') AS surprises, count(*) FILTER (order_date < '19960101') AS routes FROM h GROUP BY 1",
    "late_drift": "SELECT name, kind, (SELECT count(*) FROM h WHERE order_date >= '19960101') AS rows FROM (VALUES ('surprise', 'unknown'), ('ordrte', 'missing')) t(name, kind)",
    "reused_batch": f"SELECT '{BATCH}' AS batch_id, count(*) AS rows, min(order_number::BIGINT % 2) AS least, max(order_number::BIGINT % 2) AS most, true AS refused FROM o WHERE order_number::BIGINT % 2 = 0",
    "file_hashes": "SELECT md5(string_agg(c_name, chr(10) ORDER BY c_custkey) || chr(10)) AS source_file_hash, sum(len(c_name) + 1)::BIGINT AS bytes, min_by(c_name, c_custkey) AS first FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey",
    "mapping_versions": f"SELECT {_CUST} FROM cmi",
    "one_to_one_tiers": " UNION ALL ".join(
        f"SELECT '{a} with several {b}' AS rule, {a} AS value, min({b}) AS least, max({b}) AS most FROM {t} WHERE {a} IS NOT NULL GROUP BY {a} HAVING min({b}) <> max({b})"
        for t, k, p in (("p2", "first_half_sku_code", "pseudo_first_half_sku_code"), ("c2", "customer_hash_key", "pseudo_customer_name")) for a, b in ((k, p), (p, k))
    ),
    "dataset_types": "SELECT (SELECT count(*) FROM lineitem) AS rows, 11::BIGINT AS columns, name, type, filled FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS name, '{t}' AS type, count({c}) AS filled FROM lineitem" for c, t in (("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"))) + ")",
    "profiles_written": "SELECT product_category, count(*) AS products FROM pb GROUP BY 1",
    "refusals": "SELECT 'name twice' AS rule, count(*) AS rows, true AS refused FROM h UNION ALL SELECT 'column missing', count(*), true FROM h UNION ALL SELECT 'no rows', 0, true UNION ALL SELECT 'two days', count(*), true FROM iv",
    "constant_column": "SELECT count(*) AS rows, max(snapshot_date) AS snapshot FROM iv",
    "hash_without_columns": f"SELECT {_NAN([c for c in C.HISTORY_HASH if c not in ('order_date', 'quantity_short')])} AS row_hash, count(*) AS n FROM h GROUP BY 1",
    "standardize_history": "SELECT * FROM h",
    "standardize_open": "SELECT * FROM o",
    "standardize_inventory": "SELECT * EXCLUDE (first_half_sku_code, unique_sku_code, full_sku_code) FROM iv",
    "schema_drift": "SELECT name, kind, (SELECT count(*) FROM o) AS rows FROM (VALUES {}) t(name, kind)".format(", ".join(f"('{c}', '{k}')" for c, k in [*((c, "unknown") for c in ("orpewt", "rtname", "rtnumb", "orrqdt", "orrvdt", "00011", "orpval")), *((c, "missing") for c in ("ordrte", "orpoq", "00015", "orpoq2", "00022", "00025"))])),
    "dataset_summary": f"SELECT (SELECT count(*) FROM h) AS rows, {len(_HIST)}::BIGINT AS columns, name, filled FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS name, count({c}) AS filled FROM h" for c in _HIST) + ")",
    "latest_batch": "SELECT max(order_date[1:4]) || '0101_000000' AS batch_id, count(*) AS rows FROM h WHERE order_date[1:4] = (SELECT max(order_date[1:4]) FROM h)",
    "batch_metadata": "SELECT y::VARCHAR || '0101_000000' AS batch_id, 4 AS column_count, count(*) AS rows, md5(min(o_orderkey::VARCHAR) || '|' || max(o_orderkey::VARCHAR)) AS digest FROM (SELECT o_orderkey, year(o_orderdate) AS y FROM orders WHERE o_orderdate IS NOT NULL) WHERE y % 2 = 0 GROUP BY y",
    "scalar_functions": f"SELECT pallet_number AS pallet, full_sku_code AS sku, first_half_sku_code AS first_half, unique_sku_code AS second_half, {_INIT.format('product_description')} AS initials, upper(product_description) AS cleaned, TRY_CAST(regexp_extract(product_description, '(\\d+)$', 1) AS BIGINT) AS brand_number, NULL::BIGINT AS no_number, lpad(quantity_on_hand, 5, '0') AS padded, md5(raw_sku || '|' || upper(product_description)) AS key, best_before_date AS date, NULL::VARCHAR AS no_date FROM iv",
    "snapshot_dates": "SELECT CASE WHEN y % 7 <> 0 THEN y::VARCHAR || '0101' END AS snapshot, count(DISTINCT y) AS files FROM (SELECT o_orderkey, year(o_orderdate) AS y FROM orders WHERE o_orderdate IS NOT NULL) GROUP BY 1",
    "newest_file": "SELECT max_by(name, struct_pack(a := y % 5, b := name)) AS file_name FROM (SELECT DISTINCT y, 'stock_' || y || CASE WHEN y % 7 = 0 THEN '0230' ELSE '0101' END || '.csv' AS name FROM (SELECT o_orderkey, year(o_orderdate) AS y FROM orders WHERE o_orderdate IS NOT NULL))",
    "new_files": "SELECT DISTINCT 'stock_' || y || CASE WHEN y % 7 = 0 THEN '0230' ELSE '0101' END || '.csv' AS file_name FROM (SELECT o_orderkey, year(o_orderdate) AS y FROM orders WHERE o_orderdate IS NOT NULL) WHERE y % 2 = 1",
    "snapshot_guard": "SELECT y::VARCHAR || '0101' AS snapshot, y % 2 = 0 AS refused, CASE WHEN y % 2 = 0 THEN count(*) END AS rows FROM (SELECT o_orderkey, year(o_orderdate) AS y FROM orders WHERE o_orderdate IS NOT NULL) WHERE y % 7 <> 0 GROUP BY y",
    "customer_base": "SELECT customer_hash_key, source_customer_code, ship_to_customer_code, customer_name FROM cb",
    "product_base": "SELECT * FROM pb",
    "category_profile": "SELECT product_category, count(*) AS products FROM pb GROUP BY 1",
    "customer_mapping_first": f"SELECT {_CUST} FROM cm",
    "customer_mapping_incremental": f"SELECT {_CUST} FROM cmi",
    "product_mapping_first": f"SELECT {', '.join(C.PRODUCT_MAPPING[:7])} FROM pm",
    "product_mapping_incremental": "SELECT full_sku_code, pseudo_category, pseudo_product_description FROM pi",
    "sku_prefixes": "SELECT * FROM prefixes",
    "sku_full_codes": "SELECT full_sku_code, pseudo_full_sku_code FROM pm",
    "sku_group_codes": "SELECT DISTINCT first_half_sku_code, pseudo_first_half_sku_code FROM pm",
    "sku_base_codes": "SELECT DISTINCT unique_sku_code, pseudo_unique_sku_code FROM pm",
    "backfill_customers": f"SELECT {_CUST} FROM cma",
    "backfill_products_open": f"SELECT {_MAP} FROM po",
    "backfill_products_inventory": f"SELECT {_MAP} FROM pa",
    "pseudonymize_history": "SELECT * FROM ho",
    "pseudonymize_open": "SELECT * FROM oo",
    "pseudonymize_inventory": "SELECT * FROM io",
    "unmapped_skus": "SELECT DISTINCT full_sku_code FROM o WHERE full_sku_code NOT IN (SELECT full_sku_code FROM pm)",
    "unmapped_customers": "SELECT customer_hash_key FROM cbo WHERE customer_hash_key NOT IN (SELECT customer_hash_key FROM cm)",
    "fanout_keys": "SELECT full_sku_code, count(*) AS n FROM p2 GROUP BY 1 HAVING count(*) > 1",
    "mapping_violations": _violations("c2", "p2"),
    "mapping_violations_clean": _violations("cma", "pa"),
    "bad_pseudonyms": "SELECT count(*) FILTER (NOT starts_with(customer_name, 'Customer CUST-')) AS bad_customer_rows, count(*) FILTER (NOT coalesce(contains(product_description, ' Product '), false)) AS bad_product_rows, count(*) FILTER (NOT starts_with(full_sku_code, 'SKU-')) AS bad_sku_rows FROM dirty",
    "critical_nulls": "SELECT " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in C.GATES["history"]["critical"]) + " FROM dirty",
    "negative_values": "SELECT " + ", ".join(f"count(*) FILTER (TRY_CAST({c} AS DOUBLE) < 0) AS {c}" for c in C.GATES["history"]["numeric"]) + " FROM dirty",
    "duplicate_row_hashes": "SELECT count(*) - count(DISTINCT row_hash) AS duplicates FROM dirty",
    "duplicate_rows_export": "SELECT * FROM (SELECT row_hash, order_number, count(*) OVER (PARTITION BY row_hash) AS occurrences FROM dirty) WHERE occurrences > 1",
    "quality_report_history": _report("ho", C.GATES["history"]),
    "quality_report_open": _report("oo", C.GATES["open"]),
    "quality_report_inventory": _report("io", C.GATES["inventory"]),
    "quality_checks_dirty": _checks("dirty", C.GATES["history"]),
    "land_authorized": "SELECT order_date[1:4] || '0101_000000' AS batch_id, count(*) AS rows, count(DISTINCT row_hash) AS hashes FROM ho WHERE order_date[4:4]::INT % 3 <> 0 GROUP BY 1",
}
ORACLE_SQL = {k: _CTE + v for k, v in _SELECT.items()}
