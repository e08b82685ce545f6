"""The three extracts and the category lookup, derived from the star-schema tables. All columns are text."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as X
from .contracts import CATEGORIES

RUN_TIME, BATCH = "2024-01-01T00:00:00", "20240101_000000"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sku_number(k: str) -> F.Column:
    return (F.col(k) % 97 + 1) * 100000 + F.expr(f"{k} div 97") + 1


def _money(c: str) -> F.Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


# Lines of the history; all others are open orders, so that no line is left out. A brand and some customers are met in
# open orders alone, which gives the backfills work.
IN_HISTORY = "coalesce(o_orderstatus <> 'O' AND p_brand <> 'Brand#25' AND NOT (c_mktsegment = 'MACHINERY' AND c_acctbal < 1000), false)"


# The same as conjuncts, which Spark takes to the tables before it joins them.
HISTORY_PARTS = "o_orderstatus <> 'O' AND p_brand <> 'Brand#25' AND NOT (c_mktsegment = 'MACHINERY' AND c_acctbal < 1000)"
# And by what an order with its customer and what a part says of it. What is not the history no table can decide alone:
# lines carry one flag to their parts instead of the columns that it is made of.
ORDER_IN, PART_IN = "o_orderstatus <> 'O' AND NOT (c_mktsegment = 'MACHINERY' AND c_acctbal < 1000)", "p_brand <> 'Brand#25'"
IN_OPEN = "NOT coalesce(__order_in AND __part_in, false)"


def _lines(spark: SparkSession, sf_dir: str, where: str) -> DataFrame:
    """Order lines with their customer and part; the joins' strategy is left to Spark. Orders get their customers first, so
    that lines move once less, and what a part alone decides is made once a part."""
    orders = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).withColumn("__order_in", F.expr(ORDER_IN))
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", F.expr(PART_IN).alias("__part_in"), X.full_sku(_sku_number("p_partkey").cast("string")).alias("__sku"), F.concat_ws(" ", "p_name", "p_brand").alias("__text"))
    return read(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey")).where(where)


def _day(c: str) -> F.Column:
    return F.date_format(c, "yyyyMMdd")


def _common() -> dict[str, F.Column]:
    return {
        "orcomp": F.lit("01"), "orsocs": F.col("o_custkey").cast("string"), "orshcs": F.col("c_nationkey").cast("string"), "orshnm": F.col("c_name"),
        "orpo": F.concat(F.lit("PO-"), F.col("o_orderkey").cast("string")), "ornum": F.col("o_orderkey").cast("string"), "ortype": F.substring("o_orderpriority", 1, 1),
        "orodt8": _day("o_orderdate"), "orsdt8": _day("l_shipdate"), "orsdat": _day("l_shipdate"), "oruser": F.concat(F.lit("user"), F.col("l_suppkey").cast("string")),
        "orstat": F.col("o_orderstatus"), "orman": F.substring("__sku", 1, 6), "orprod": F.substring("__sku", 8, 5), "ordes1": F.col("__text"),
        "orroq": _money("l_quantity"), "orpsqt": _money("l_quantity"), "orpswt": F.lit("1.00"), "orpamt": _money("l_extendedprice"), "batch_id": F.lit(BATCH), "ingested_at": F.lit(RUN_TIME),
    }


def raw_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = {"ordrte": F.lit("R1"), "orpoq": _money("l_quantity"), "00015": F.col("__sku"), "orpoq2": F.lit("0.00"), "00022": F.lit("0.00"), "00025": F.col("p_type")}
    return _lines(spark, sf_dir, HISTORY_PARTS).select(*(v.alias(k) for k, v in {**_common(), **own}.items()))


def raw_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = {"orpewt": F.lit("2.00"), "rtname": F.lit("North"), "rtnumb": F.lit("R2"), "orrqdt": _day("l_shipdate"), "orrvdt": _day("l_shipdate"), "00011": F.col("__sku"), "orpval": _money("l_extendedprice")}
    return _lines(spark, sf_dir, IN_OPEN).select(*(v.alias(k) for k, v in {**_common(), **own}.items()))


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stock of parts, and a sample of each supplier, which no order holds."""
    parts = read(spark, sf_dir, "part").select(_sku_number("p_partkey").alias("number"), F.col("p_partkey").alias("key"), F.concat_ws(" ", "p_name", "p_brand").alias("text"), F.col("p_partkey").cast("string").alias("pallet"), F.col("p_size").cast("string").alias("size"), _money("p_retailprice").alias("price"))
    samples = read(spark, sf_dir, "supplier").select((_sku_number("s_suppkey") + 20000000).alias("number"), F.col("s_suppkey").alias("key"), F.concat_ws(" ", "s_name", F.lit("sample")).alias("text"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("pallet"), F.lit("1").alias("size"), _money("s_acctbal").alias("price"))
    sku = F.concat(F.col("number").cast("string"), F.when(F.col("key") % 10 == 0, F.lit(".0")).otherwise(F.lit("")))
    cols = {"sku": sku, "description": F.col("text"), "pallet_no.": F.col("pallet"), "lot_no.": F.lit("L1"), "slot": F.lit("S1"), "pallet_held": F.lit("N"), "prod'n_date": F.lit("20231201"), "bb_date": F.lit("20241201"), "res_qty": F.lit("0"), "qty": F.col("size"), "wgt": F.col("price"), "warehouse_code": F.lit("305"), "snapshot_date": F.lit("20240101")}
    return parts.unionByName(samples).select(*(v.alias(k) for k, v in cols.items()))


def categories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORIES, "product_category string, pseudo_category string")
