"""Mixing sources to target weights by temperature (operator 6).

Shares of tokens are raised to an exponent, which is bisected until the mix has the entropy asked for, or a source would be
repeated more than allowed. The weights are realised in whole epochs of each source and a part of a further one, which
takes blocks of rows in the order of a seeded permutation while the budget lasts.
"""

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Carried, discard, name, saved, table

BLOCK_ROWS = 1000  # rows of a block
MOST_BLOCKS = 65_536  # blocks of a source at most, so that one task can run through them; blocks of a larger source are larger
ENTROPY, REPEATS = 0.5, 1.5  # part of the way from the shares' entropy to that of equal shares; epochs of a source at most


def exponent(sources: DataFrame, entropy: float, repeats: float, budget: float | None = None, rounds: int = 5, cuts: int = 16) -> float:
    """The largest exponent in [0, 1] at which shares**exponent, normalised, have gone that part of the way from the shares'
    entropy to that of equal shares, or, where some source would then be repeated more than repeats times, the least at
    which none is. budget is in tokens of all sources; without one the largest source comes once.

    Entropy falls and repetition falls as the exponent grows. Each round is one aggregate over the sources, which tells
    in which of cuts parts of the interval the exponent lies; sources stay in Spark."""
    given = sources.agg(F.count("*").alias("n"), F.max("share").alias("most"), F.min("share").alias("least"), F.sum(-F.col("share") * F.log("share")).alias("entropy")).first()
    target = given.entropy + entropy * (math.log(given.n) - given.entropy)

    def enough_entropy(t, z, s):
        return math.log(z) - t * s / z >= target - 1e-12

    def few_repeats(t, z, s):
        epochs = (t - 1) * math.log(given.least) + (math.log(budget) - math.log(z) if budget else (1 - t) * math.log(given.most))
        return epochs <= math.log(repeats) + 1e-12

    def narrowed(good, low: float, high: float) -> tuple[list[float], list[bool]]:
        at = [low + (high - low) * i / cuts for i in range(cuts + 1)]
        row = sources.agg(*(x for i, t in enumerate(at) for x in (F.sum(F.pow("share", F.lit(t))).alias(f"z{i}"), F.sum(F.pow("share", F.lit(t)) * F.log("share")).alias(f"s{i}")))).first()
        return at, [good(t, row[f"z{i}"], row[f"s{i}"]) for i, t in enumerate(at)]

    if not few_repeats(1.0, 1.0, 0.0):
        raise ValueError(f"the budget is {budget:.2f} times the tokens there are, but sources may come {repeats} times at most")
    low, high = 0.0, 1.0
    for _ in range(rounds):
        at, ok = narrowed(enough_entropy, low, high)
        k = max((i for i, x in enumerate(ok) if x), default=0)
        low, high = at[k], at[min(k + 1, cuts)]
    by_entropy, (low, high) = low, (0.0, 1.0)
    for _ in range(rounds):
        at, ok = narrowed(few_repeats, low, high)
        k = next((i for i, x in enumerate(ok) if x), cuts)
        low, high = at[max(0, k - 1)], at[k]
    return max(by_entropy, high)


def mix(docs: DataFrame, source: str = "source", text: str = "text", id_column: str = "doc_id", entropy: float = ENTROPY, repeats: float = REPEATS, budget: int | None = None, seed: int = 6, block_rows: int = BLOCK_ROWS, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """docs with copies, how often each row comes in the mix; block, the place of its block in its source's permutation;
    weight, its source's share of the mix; and row_key, its place within the block, as a hash to sort by.

    Tokens are runs of non-space characters. Without a budget (in tokens) it is the least that leaves out nothing: the
    source with the largest share comes once, and every row once at least; a smaller one leaves out rows, with 0 copies. A
    source of e epochs comes floor(e) times whole; for the rest of its budget its blocks are taken in the order of a
    seeded hash while they fit, then rows of the next block while they fit. A null source is a source of its own; a null
    text has no tokens; sources without tokens come once with weight 0. Equal rows share a block and are taken in any
    order. Without rows there are none. Columns of docs with the names of results are replaced, others may have any name.
    """
    results = ["copies", "block", "weight", "row_key"]
    carried = Carried(docs, None, results)
    key = F.coalesce(F.concat(F.lit("="), docs[name(source)].cast("string")), F.lit(""))
    given = docs.select(*carried.columns, key.alias("source"), F.xxhash64(F.lit(seed), docs[name(id_column)], docs[name(text)]).alias("row_key"), docs[name(text)].alias("text"))
    slim = saved(given.select("source", "row_key", F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)).cast("bigint").alias("tokens")))
    sums = saved(slim.groupBy("source").agg(F.sum("tokens").alias("total"), F.count("*").alias("rows")))
    filled = sums.where("total > 0")
    everything = filled.agg(F.sum("total")).first()[0]
    if not everything:
        return given.select(*carried.back, F.lit(1).alias("copies"), F.lit(0).cast("bigint").alias("block"), F.lit(0.0).alias("weight"), "row_key")
    shares = saved(filled.select("*", (F.col("total") / F.lit(everything)).alias("share")))
    t = exponent(shares, entropy, repeats, budget / everything if budget else None)
    most, scale = shares.agg(F.max("share"), F.sum(F.pow("share", F.lit(t)))).first()
    epochs = F.pow("share", F.lit(t - 1)) * F.lit(budget / everything / scale if budget else most ** (1 - t))
    blocks = F.least(F.ceil(F.col("rows") / block_rows), F.lit(most_blocks)).cast("bigint")
    whole = F.floor(epochs + 1e-9)
    plan = shares.select("source", (F.pow("share", F.lit(t)) / F.lit(scale)).alias("weight"), whole.cast("int").alias("whole"), F.floor(F.greatest(F.lit(0.0), epochs - whole) * F.col("total")).cast("bigint").alias("rest"), blocks.alias("blocks"))
    plan = saved(plan.unionByName(sums.where("total = 0").select("source", F.lit(0.0).alias("weight"), F.lit(1).alias("whole"), F.lit(0).cast("bigint").alias("rest"), blocks.alias("blocks"))))
    # A hot source's rows meet its one row of the plan: Spark broadcasts the plan by its size on disk, or splits the join.
    dealt = slim.join(plan, "source").select("source", F.pmod(F.col("row_key"), F.col("blocks")).alias("b"), "row_key", "tokens", "rest")
    sized = dealt.groupBy("source", "b").agg(F.sum("tokens").alias("size"), F.first("rest").alias("rest"))
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "source", "b"), "b")
    running = sized.select("*", F.row_number().over(order).cast("bigint").alias("block"), F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))
    before = F.col("upto") - F.col("size")
    taken = saved(running.select("source", "b", "block", ((F.col("upto") <= F.col("rest")) & (F.col("rest") > 0)).alias("taken"), F.greatest(F.lit(0), F.col("rest") - before).alias("left"), ((F.col("upto") > F.col("rest")) & (before < F.col("rest"))).alias("cut")))
    cut = dealt.join(taken.where("cut").select("source", "b", "left"), ["source", "b"])
    within = Window.partitionBy("source", "b").orderBy("row_key").rowsBetween(Window.unboundedPreceding, 0)
    extra = saved(cut.withColumn("upto", F.sum("tokens").over(within)).where("upto <= left and tokens > 0").groupBy("source", "row_key").agg(F.lit(True).alias("more")))
    discard(slim, sums, shares)
    joined = given.join(plan.select("source", "weight", "whole", "blocks"), "source").withColumn("b", F.pmod(F.col("row_key"), F.col("blocks")))
    joined = joined.join(taken.select("source", "b", "block", "taken"), ["source", "b"]).join(extra, ["source", "row_key"], "left")
    copies = F.col("whole") + (F.col("taken") | F.coalesce("more", F.lit(False))).cast("int")
    return joined.select(*carried.back, copies.alias("copies"), "block", "weight", "row_key")


def realised(mixed: DataFrame, seed: int = 6) -> DataFrame:
    """A row for each copy, without the columns of mix, but with epoch (from 1), turn and position: in the order of these
    the rows are the mix, each epoch a permutation of its blocks, and of the rows within each block, of its own. turn and
    position are hashes; only the reader of the mix sorts, if it needs to."""
    carried = Carried(mixed, None, ["copies", "block", "weight", "row_key", "epoch", "turn", "position"])
    copies = mixed.select(*carried.columns, "block", "row_key", F.explode(F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies"))).otherwise(F.array().cast("array<int>"))).alias("epoch"))
    return copies.select(*carried.back, "epoch", F.xxhash64(F.lit(seed), "epoch", "block").alias("turn"), F.xxhash64(F.lit(seed), "epoch", "row_key").alias("position"))


def op6_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "source", F.col("copies").cast("bigint").alias("copies"), "block", "weight")
