"""Repeated passages of lines by content-defined chunks (operator 8).

A rolling hash over the hashes of two lines says, from these lines alone, whether a chunk ends behind them; so chunks come
in step again after inserted lines. Chunks of two lines or more that stand earlier are removed after byte comparison. Chunks
at the ends of a passage hold lines of its surroundings and match nowhere; what of the passage they hold is found as pairs
of neighbouring lines that stand earlier, compared likewise.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_intdigest

from .common import Carried, discard, flat_slices, map_slices, name, saved, split_join, table

MEAN_LINES = 3  # a chunk ends where the rolling hash of two lines is a multiple of this
MASK = (1 << 64) - 1


def chunk_edges(lines: list[str], mean_lines: int = MEAN_LINES) -> list[tuple[int, int]]:
    """(first line, number of lines) of consecutive chunks, which cover all lines."""
    hashes = [xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x in lines]
    ends = [k + 1 for k in range(1, len(lines)) if ((hashes[k - 1] * 0x9E3779B97F4A7C15 + hashes[k] & MASK) >> 20) % mean_lines == 0]
    starts = [0, *ends]
    return [(a, b - a) for a, b in zip(starts, [*ends, len(lines)], strict=True) if b > a]


def units(text: str, mean_lines: int, seams: bool) -> list[tuple[int, int, bytes]]:
    """(first line, number of lines, digest) of the chunks of several lines and, with seams, of each two neighbouring
    lines; their number is -2, which tells them from chunks of two."""
    lines = text.split("\n")
    found = [(k, n, b"c" + "\n".join(lines[k : k + n]).encode("utf-8", "surrogatepass")) for k, n in chunk_edges(lines, mean_lines) if n > 1]
    if seams:
        found += [(k, -2, "\n".join(x).encode("utf-8", "surrogatepass")) for k, x in enumerate(zip(lines, lines[1:]))]
    return [(k, n, xxh3_128_digest(b)) for k, n, b in found]


def remove_repeated_chunks(docs: DataFrame, text: str = "text", id_column: str = "doc_id", mean_lines: int = MEAN_LINES, seams: bool = True) -> DataFrame:
    """docs with text less all chunks of several lines that stand earlier, in a smaller id or earlier in the same document,
    and, with seams, all other lines of passages of two lines or more that stand earlier; then n_lines and n_removed, lines
    of the text before and removed.

    Digests are compared on narrow rows; the lines of those that repeat are then fetched and compared byte by byte with the
    first occurrence. Single lines stay. A null text stays null and has no lines; an empty one is one empty line. Null ids
    come after all others. Rows equal in id and text count as one document: both keep what is first there. A document of
    which nothing is left stays, with an empty text. Without rows there are none. Columns of docs named n_lines or n_removed
    are replaced, others may have any name.
    """
    results = ["n_lines", "n_removed"]
    carried = Carried(docs, None, [*results, text])
    given = docs.select(*carried.columns, docs[name(id_column)].alias("id"), F.xxhash64(docs[name(text)]).alias("row"), docs[name(text)].alias("text"))
    slim = given.select("id", "row", "text").where("text is not null")

    def digests():
        def make(ids, rows, texts):
            found = [(i, r, *u) for i, r, t in zip(ids, rows, texts, strict=True) for u in units(t, mean_lines, seams)]
            return [list(x) for x in zip(*found, strict=True)] if found else [[], [], [], [], []]

        return make

    def bodies():
        def make(ids, rows, texts, places):
            out: list[list] = [[] for _ in range(7)]
            for i, r, t, found in zip(ids, rows, texts, places, strict=True):
                lines, held = t.split("\n"), {}
                for p in found:
                    if p["n"] > 0 and not p["is_first"]:
                        held.update(dict.fromkeys(range(p["k"], p["k"] + p["n"]), p["k"]))
                for p in found:
                    k, n = p["k"], abs(p["n"])
                    # A pair within a chunk that goes as a whole is compared with it.
                    if p["n"] > 0 or k not in held or held[k] != held.get(k + 1):
                        body = "\n".join(lines[k : k + n]).encode("utf-8", "surrogatepass")
                        for values, v in zip(out, (i, r, k, n, p["digest"], p["is_first"], body), strict=True):
                            values.append(v)
            return out

        return make

    def with_places(rows: DataFrame, by_row: DataFrame, column: str) -> DataFrame:
        """rows with column of by_row (id, row, column), null where it has none."""
        other = by_row.select(F.col("id").alias("other_id"), F.col("row").alias("other_row"), column)
        return rows.join(other.hint("merge"), rows["id"].eqNullSafe(other["other_id"]) & (rows["row"] == other["other_row"]), "left")

    place = {"id": "bigint", "row": "bigint", "k": "int", "n": "int", "digest": "binary"}
    order = F.struct(F.col("id").isNull().alias("last"), "id", "row", "k")
    every = saved(flat_slices(slim, place, digests))
    total = every.count()
    repeated = saved(every.groupBy("digest").agg(F.count("*").alias("n_all"), F.min(order).alias("first")).where("n_all > 1"))
    again = split_join(every, repeated.withColumnRenamed("n_all", "n"), ["digest"], total).withColumn("is_first", order.eqNullSafe(F.col("first")))
    placed = again.groupBy("id", "row").agg(F.collect_set(F.struct("k", "n", "digest", "is_first")).alias("places"))
    found = saved(flat_slices(with_places(slim, placed, "places").where("places is not null").select("id", "row", "text", "places"), {**place, "is_first": "boolean", "body": "binary"}, bodies))
    discard(every)
    firsts = found.where("is_first").groupBy("digest").agg(F.first("body").alias("first_body"))
    later = found.where("not is_first").join(firsts.hint("merge"), "digest").where("body = first_body")
    gone = saved(later.groupBy("id", "row").agg(F.collect_set(F.struct("k", "n")).alias("gone")))
    discard(found)

    def rebuild():
        def make(source_texts, all_gone):
            texts, lines, removed = [], [], []
            for t, gone_ in zip(source_texts, all_gone, strict=True):
                parts = [] if t is None else t.split("\n")
                away = {k for g in gone_ or () for k in range(g["k"], g["k"] + g["n"])}
                texts.append("\n".join(x for k, x in enumerate(parts) if k not in away) if away else t)
                lines.append(len(parts))
                removed.append(len(away))
            return texts, lines, removed

        return make

    source = with_places(given, gone, "gone").select(*carried.inner, "text", "gone")
    out = map_slices(source, {"new_text": "string", "n_lines": "bigint", "n_removed": "bigint"}, rebuild, keep=carried.inner, inputs=["text", "gone"])
    new = {c: b for c, b in zip(carried.names, carried.back, strict=True)} | {text: F.col("new_text").alias(text)}
    return out.select(*(new[c] for c in docs.columns if c in new), *results)


def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_chunks(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))
