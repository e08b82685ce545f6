"""SimHash near-duplicates by meet-in-the-middle ball hashing (operator 7)."""

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from xxhash import xxh3_128_digest, xxh64_intdigest

from .common import HOT_SHARE, Carried, connected_components, map_slices, name, saved, split_join, table

SMALL_BAND, TILE = 8, 128  # entries of a band that are joined; rows of a tile of larger ones
PAIRS = 256  # compared with one copy of a set
BANDS, ROWS = 16, 4  # two sets of similarity 0.8 agree in no band once in 5,000 pairs, equal ones never


def fingerprint(text: str, shingle: int, seed: int) -> int:
    """64 bits, each set where over half the shingles' hashes set it; zero without words. Signed."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter(map(partial(xxh64_intdigest, seed=seed), shingles), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[i : i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None, shingle: int = 3, seed: int = 42) -> DataFrame:
    """keep columns of docs (all unless given), then fingerprint bigint of the whole text; a null text counts as empty."""
    carried = Carried(docs, keep, ["fingerprint"])

    def start():
        return lambda texts: ([fingerprint(x or "", shingle, seed) for x in texts],)

    source, given = carried.with_input(text)
    return map_slices(source, {"fingerprint": "bigint"}, start, keep=carried.inner, inputs=[given]).select(*carried.back, "fingerprint")


def ball_components(prints: DataFrame, column: str = "fingerprint") -> DataFrame:
    """(fingerprint, component) of the distinct fingerprints that link with another at two or fewer differing bits.

    Each emits the 65 fingerprints within one bit. Two within two bits meet at one of these at least, and all that meet at
    one, 65 at most, are within two bits of each other: linking each with the least of them, verified, loses no link.
    """
    masks = [0] + [(1 << i) - (1 << 64 if i == 63 else 0) for i in range(64)]
    own = prints.select(F.col(column).alias("f")).distinct()
    variants = own.select("f", F.explode(F.array(*(F.col("f").bitwiseXOR(F.lit(m).cast("bigint")) for m in masks))).alias("at"))
    met = variants.select("f", F.min("f").over(Window.partitionBy("at")).alias("least")).where("f <> least")
    pairs = met.where(F.bit_count(F.col("f").bitwiseXOR(F.col("least"))) <= 2).select(F.col("f").alias("a"), F.col("least").alias("b")).distinct()
    return connected_components(pairs).select(F.col("node").alias(column), "component")


def near_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle: int = 3, seed: int = 42) -> DataFrame:
    """One row for each row of docs: its id, fingerprint (bigint) and component_id, the smallest id reachable by links
    of two or fewer bits.

    A null text counts as empty; texts without words have fingerprint zero and link like any other. Null ids take part
    but are no component_id unless a component has no other. Repeated rows have equal results. Columns beside the id and
    the text are not looked at.
    """
    source = docs.select(docs[name(id_column)].alias("__id"), docs[name(text)].alias("text"))
    prints = saved(fingerprints(source, keep=["__id"], shingle=shingle, seed=seed))
    classes = saved(prints.groupBy("fingerprint").agg(F.min("__id").alias("low")))
    linked = saved(classes.join(ball_components(classes), "fingerprint", "left").select("fingerprint", "low", F.coalesce("component", "fingerprint").alias("component")))
    least = linked.groupBy("component").agg(F.min("low").alias("component_id"))
    named = linked.join(least, "component").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(F.col("__id").alias(id_column), "fingerprint", "component_id")


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of so many words, of all words where there are fewer."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    runs = map(b" ".join, zip(*(w[i:] for i in range(words)))) if len(w) >= words else [b" ".join(w)]
    return np.unique(np.fromiter(map(xxh64_intdigest, runs), dtype="<u8"))


def bands(hashes: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> list[int]:
    """One key for each band of ROWS least hashes. Signed."""
    least = np.full(len(factors), (1 << 64) - 1, dtype="<u8")
    for i in range(0, len(hashes), 1024):
        least = np.minimum(least, (hashes[i : i + 1024, None] * factors + terms).min(axis=0))
    return [int(np.uint64(xxh64_intdigest(least[k * ROWS : (k + 1) * ROWS].tobytes(), seed=k)).view(np.int64)) for k in range(BANDS)]


def similar_in_tile(rows: pd.DataFrame, alone: bool, similarity: float) -> pd.DataFrame:
    """Similar pairs, the larger (low, node) first, of a tile with itself or of two tiles with each other. Sets are compared
    by products of their incidence, some columns at a time."""
    rows = rows.drop_duplicates("node")
    sets, size = [np.asarray(x, dtype=np.int64) for x in rows["set"]], rows["set"].map(len).to_numpy()
    row, (hashes, column) = np.repeat(np.arange(len(sets)), size), np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    row, column, shared = row[order], column[order], np.zeros((len(sets), len(sets)))
    for at in range(0, len(hashes), 8192):
        lo, hi = np.searchsorted(column, [at, at + 8192])
        some = np.zeros((len(sets), min(8192, len(hashes) - at)), dtype=np.float32)
        some[row[lo:hi], column[lo:hi] - at] = 1
        shared += some @ some.T
    tile, names = rows["tile"].to_numpy(), list(zip(rows["low"].tolist(), map(bytes, rows["node"]), strict=True))
    near = shared >= similarity * (size[:, None] + size[None, :] - shared)
    near &= np.array([[a > b for b in names] for a in names])
    if not alone:
        near &= tile[:, None] != tile[None, :]
    found = [(*names[i], *names[j]) for i, j in zip(*np.nonzero(near), strict=True)]
    return pd.DataFrame(found, columns=["low", "node", "other_low", "other_node"])


def in_balls(signed: DataFrame) -> DataFrame:
    """(own, band, key) of the nodes of signed (id, node, fingerprint) by the components of their fingerprints' balls, as one
    more band. Equal sets whose texts repeat runs in other numbers may have several fingerprints: each counts."""
    nodes = signed.groupBy("node").agg(F.min("id").alias("low")).join(signed.select("node", "fingerprint").distinct(), "node")
    met = nodes.join(ball_components(signed), "fingerprint", "left").withColumn("key", F.coalesce("component", "fingerprint"))
    return met.select(F.struct("low", "node").alias("own"), F.lit(BANDS).alias("band"), "key").distinct()


def removed_copies(docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, kept_id) of documents of which a smaller id is kept, the sets of whose runs of words have at least this Jaccard
    similarity to its own. No two kept ones that meet are as similar.

    Documents meet by SimHash, whose fingerprints of these runs link within two bits and make one band of each component of
    balls, and in bands of least hashes, as at similarity 0.8 fingerprints differ in up to 14 of 64 bits on sf0.1, too many
    for balls. Each link is verified on the whole sets. Equal sets are one node. A root is a node that meets no
    smaller one, and stays for certain. First each other node is compared with the least root that it meets, alone, which
    clears large groups; while that clears many, with the roots of what is left. Then the nodes of a band are compared with
    its least; those similar to a kept one go. Of what is left all in a band are compared; only similar pairs are put out.
    A null text counts as empty. Null ids are neither removed nor kept instead of others; repeated rows have equal results.
    """
    source = docs.where(docs[name(id_column)].isNotNull()).select(docs[name(id_column)].alias("id"), docs[name(text)].alias("text"))

    def sign():
        draw = np.random.default_rng(42)
        factors, terms = draw.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1), draw.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64)

        def make(ids, texts):
            sets = [shingles(t or "", shingle) for t in texts]
            return [xxh3_128_digest(x.tobytes()) for x in sets], [fingerprint(t or "", shingle, 42) for t in texts], [bands(x, factors, terms) for x in sets]

        return make

    def gather():
        def make(nodes, texts):
            sets = [shingles(t or "", shingle) for t in texts]
            return [xxh3_128_digest(x.tobytes()) for x in sets], [x.view("<i8").tolist() for x in sets]

        return make

    signed = saved(map_slices(source, {"node": "binary", "fingerprint": "bigint", "bands": "array<bigint>"}, sign, keep=["id"]))
    classes = signed.groupBy("node").agg(F.min("id").alias("low"), F.min_by("bands", "id").alias("bands"))
    dealt = classes.select(F.struct("low", "node").alias("own"), F.posexplode("bands").alias("band", "key"))
    dealt = dealt.unionByName(in_balls(signed))
    counted = dealt.withColumn("n", F.count("*").over(Window.partitionBy("band", "key"))).where("n > 1")
    entries = saved(counted.select("own", "band", "key"))
    firsts = entries.select(F.col("own.low").alias("id"), "own.node").distinct()
    texts = source.join(firsts.hint("merge"), "id").select("node", "text")
    # Rows of one id may differ in text: the one whose set it is counts.
    sets = saved(map_slices(texts, {"digest": "binary", "set": "array<bigint>"}, gather, keep=["node"]).where("digest = node").drop("digest").dropDuplicates(["node"]))

    def verified(pairs: DataFrame) -> DataFrame:
        """pairs (own, other) that are similar. Sets of nodes that many are compared with come in several copies, one for
        PAIRS of them, so that no task has all."""
        pairs = saved(pairs.select("own", "other", F.col("own.node").alias("a"), F.col("other.node").alias("b")))
        many = F.broadcast(saved(pairs.groupBy("b").agg(F.ceil(F.count("*") / PAIRS).cast("int").alias("parts")).where(F.col("parts") > max(1.0, HOT_SHARE * pairs.count() / PAIRS))))
        parts = F.coalesce("parts", F.lit(1))
        a, b = sets.select(F.col("node").alias("a"), F.col("set").alias("x")), sets.select(F.col("node").alias("b"), F.col("set").alias("y"))
        b = b.join(many, "b", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
        dealt = pairs.join(many, "b", "left").withColumn("part", F.pmod(F.xxhash64("a"), parts).cast("int")).drop("parts")
        both = dealt.join(a.hint("merge"), "a").join(b.hint("merge"), ["b", "part"])
        common = F.size(F.array_intersect("x", "y"))
        return saved(both.where(common >= F.lit(similarity) * (F.size("x") + F.size("y") - common)).select("own", "other"))

    def settled(links: DataFrame) -> DataFrame:
        """Links to nodes that no smaller one is linked with: those are kept."""
        return links.join(links.select(F.col("own").alias("other")).distinct(), "other", "left_anti")

    def close(entries: DataFrame) -> DataFrame:
        """Pairs of entries in one band that are similar. In bands of up to SMALL_BAND, which make few pairs an entry, they
        are joined; larger ones are dealt in tiles, whose tasks compare the sets and put out similar pairs alone."""
        sized = entries.withColumn("n", F.count("*").over(band))
        small = sized.where(F.col("n") <= SMALL_BAND).select("band", "key", "own")
        near = verified(small.join(small.withColumnRenamed("own", "other"), ["band", "key"]).where("own > other").select("own", "other").distinct())
        tiles = F.ceil(F.col("n") / TILE).cast("int")
        own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
        large = sized.where(F.col("n") > SMALL_BAND).select("band", "key", "own.low", "own.node", tiles.alias("tiles")).join(sets.hint("merge"), "node")
        dealt = large.withColumn("tile", own).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        dealt = dealt.select("band", "key", F.least("tile", "with").alias("i"), F.greatest("tile", "with").alias("j"), "tile", "low", "node", "set")
        found = dealt.groupBy("band", "key", "i", "j").applyInPandas(lambda key, rows: similar_in_tile(rows, key[2] == key[3], similarity), "low bigint, node binary, other_low bigint, other_node binary")
        links = found.distinct().select(F.struct("low", "node").alias("own"), F.struct(F.col("other_low").alias("low"), F.col("other_node").alias("node")).alias("other"))
        return saved(near.unionByName(links).distinct())

    gone = []
    band = Window.partitionBy("band", "key")
    while True:
        own_roots = entries.withColumn("least", F.min("own").over(band)).groupBy("own").agg(F.min(F.col("own") == F.col("least")).alias("root"))
        met = F.min(F.struct("own", "root")).over(band)
        asked = entries.join(own_roots, "own").withColumn("met", met).where("not root and met.root").groupBy("own").agg(F.min("met.own").alias("other"))
        away = verified(asked)
        nodes, cleared = entries.select("own").distinct().count(), away.count()
        if cleared:
            gone.append(away)
            entries = saved(entries.join(away.select("own"), "own", "left_anti"))
        if cleared * 20 <= nodes:
            break
    # Each band's least is compared with all others of the band, then leaves it: what it is not similar to meets the next.
    held = None
    while True:
        met = entries.withColumn("other", F.min("own").over(band))
        links = verified(met.where("own <> other").select("own", "other").distinct())
        links = links if held is None else links.unionByName(held)
        away = saved(settled(links).groupBy("own").agg(F.min("other").alias("other")))
        nodes, cleared = entries.select("own").distinct().count(), away.count()
        out = away.select("own")
        held = saved(links.join(out, "own", "left_anti").join(out.withColumnRenamed("own", "other"), "other", "left_anti").select("own", "other"))
        entries = saved(met.where("own <> other").drop("other").join(out, "own", "left_anti"))
        gone.append(away)
        if cleared * 20 <= nodes:
            break
    links = saved(close(entries).unionByName(held).distinct())
    while not links.isEmpty():
        away = saved(settled(links).groupBy("own").agg(F.min("other").alias("other")))
        gone.append(away)
        out = away.select("own")
        links = saved(links.join(out, "own", "left_anti").join(out.withColumnRenamed("own", "other"), "other", "left_anti"))
    lows = saved(signed.groupBy("node").agg(F.min("id").alias("low"), F.count("*").alias("n")))
    same = split_join(signed.select("id", "node"), lows, ["node"], signed.count())
    if not gone:
        return same.where("id <> low").select(F.col("id").alias(id_column), F.col("low").alias("kept_id")).distinct()
    away = gone[0]
    for more in gone[1:]:
        away = away.unionByName(more)
    found = same.join(away.select("own.node", F.col("other.low").alias("kept")), "node", "left").withColumn("kept_id", F.coalesce("kept", "low"))
    return found.where("id <> kept_id").select(F.col("id").alias(id_column), "kept_id").distinct()


def op7_simhash_balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
