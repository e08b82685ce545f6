"""Spelling variants by dynamic programming over sorted word lists (operator 11)."""

import re
import zlib
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, name, saved, split_join, table

RUN = re.compile(rb"[a-z\xc0-\xff]+")
HELD = 200_000  # words a task counts before it hands them on
GROUP = 512  # words of a sorted list; larger groups are cut in two by a longer shared context
KEY = ["m", "lo", "hi", "head", "tail"]
LAST = "\U0010ffff"


def counted(doc_id: int | None, text: str | None, least_length: int, drop_every: int | None) -> Counter:
    """Words of one text, as Latin-1 bytes. A character outside Latin-1 becomes "?", which ends a run as the character
    itself does; bytes.lower touches A-Z alone."""
    out: Counter = Counter()
    if not text:
        return out
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(text.encode("latin-1", "replace").lower())).items():
        size = len(run)
        if size < least_length:
            continue
        if drop_every:
            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
            if h % drop_every == 0:
                at = h % size
                run = run[:at] + run[at + 1 :]
                if size == least_length:
                    continue
        out[run] += n
    return out


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_length: int = 6, least_count: int = 5, drop_every: int | None = 199) -> DataFrame:
    """word, n: counted in each task first, so that a frequent word is a row a task, not a row an occurrence."""
    source = docs.select(docs[name(id_column)].alias("id"), docs[name(text_column)].alias("text"))

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], type=pa.string()), pa.array(list(counts.values()), type=pa.int64())], names=["word", "n"])

    def task(batches):
        counts: Counter = Counter()
        for batch in batches:
            for i in range(batch.num_rows):
                counts.update(counted(batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), least_length, drop_every))
                if len(counts) > HELD:
                    yield batch_of(counts)
                    counts.clear()
        if counts:
            yield batch_of(counts)

    return source.mapInArrow(task, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def cut(lo: F.Column, hi: F.Column) -> F.Column:
    """The two halves of a segment."""
    mid = F.floor((lo + hi) / 2).cast("int")
    return F.explode(F.array(F.struct(lo.alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), hi.alias("hi"))))


def in_context(words: DataFrame) -> DataFrame:
    """word, n, m, lo, hi with what stands outside the segment (head, tail) and within it (middle)."""
    rest = F.length("word") - (F.col("m") - F.col("hi"))  # where the tail begins
    return words.select("word", "n", "m", "lo", "hi", F.substring("word", F.lit(1), F.col("lo")).alias("head"), F.substring("word", rest + 1, F.col("m") - F.col("hi")).alias("tail"), F.substring("word", F.col("lo") + 1, rest - F.col("lo")).alias("middle"))


def sorted_groups(words: DataFrame, shortest: int) -> DataFrame:
    """Words in groups of at most GROUP that may hold near words; every near pair is in exactly one group in which it is due.

    Let m be the length of a pair's shorter word and i the length of its common prefix. For any segment [lo, hi) of m with
    i in it, the words agree before lo and in the last m - hi characters. A word takes part with m as its own length and as
    that less one. Segments are halved until a group is small enough; of length one, they leave one or two free characters.
    """
    size = F.length("word")
    roles = words.select("word", "n", F.explode(F.when(size > shortest, F.array(size, size - 1)).otherwise(F.array(size))).alias("m"))
    pending = roles.select("word", "n", "m", cut(F.lit(0), F.col("m")).alias("s")).select("word", "n", "m", "s.lo", "s.hi")
    done = None
    while True:
        rows = saved(in_context(pending))
        sizes = saved(rows.groupBy(*KEY).agg(F.count("*").alias("n")).where("n > 1"))
        together = split_join(rows, sizes.withColumn("size", F.col("n")), KEY, rows.count())
        whole = (F.col("size") <= GROUP) | (F.col("hi") - F.col("lo") <= 1)
        part = saved(together.where(whole).drop("size"))
        large = saved(together.where(~whole).select("word", "n", "m", "lo", "hi"))
        discard(rows, sizes)
        done = part if done is None else done.unionByName(part)
        if large.isEmpty():
            return done
        pending = large.select("word", "n", "m", cut(F.col("lo"), F.col("hi")).alias("s")).select("word", "n", "m", "s.lo", "s.hi")


def common_prefix(a: str, b: str) -> int:
    for i, (x, y) in enumerate(zip(a, b, strict=False)):
        if x != y:
            return i
    return min(len(a), len(b))


def near_in_list(words: list[str]) -> list[tuple[int, int]]:
    """Pairs (i, j), i < j, of a sorted list of different words that are one edit apart.

    For each word the later ones are scanned. Row k of the edit matrix, cut to the three diagonals that a distance of one
    can touch, belongs to the first k characters and is used again by all words that share them; a prefix whose row holds
    nothing below two ends the scan of every word that begins with it.
    """
    shared = [0, *(common_prefix(a, b) for a, b in zip(words, words[1:], strict=False))]
    total, found = len(words), []
    for a in range(total - 1):
        query = words[a]
        size = len(query)
        padded = query + "\0\0\0"  # no word holds it
        rows = [(2, 0, 1)]
        at, kept = a + 1, 0
        while at < total:
            word = words[at]
            del rows[kept + 1 :]
            left, here, right = rows[-1]
            depth, end, dead = kept, min(len(word), size + 1), False
            while depth < end:
                c = word[depth]
                new_left = min(left + (depth == 0 or padded[depth - 1] != c), here + 1)
                new_here = min(here + (padded[depth] != c), new_left + 1, right + 1)
                right = min(right + (padded[depth + 1] != c), new_here + 1)
                left, here = new_left, new_here
                depth += 1
                if left > 1 and here > 1 and right > 1:
                    dead = True
                    break
                rows.append((left, here, right))
            if dead:
                following = bisect_left(words, word[:depth] + LAST, at + 1)
            else:
                gap = size - len(word)
                if -1 <= gap <= 1 and rows[-1][gap + 1] == 1:
                    found.append((a, at))
                following = at + 1
            if following >= total:
                break
            kept = min(shared[following] if following == at + 1 else common_prefix(word, words[following]), len(rows) - 1)
            at = following
    return found


def near_in_groups(groups: DataFrame) -> DataFrame:
    """word, n_near, and the least of (-n, word) of the near words, as first_n and first_word; a row a word and group."""
    partitions = max(int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")), groups.count() // 100_000)
    dealt = groups.select(*KEY, "middle", "word", "n").repartition(partitions, *KEY).sortWithinPartitions(*KEY, "middle")

    def judge(key: tuple, rows: list[tuple[str, str, int]], out: list[list]) -> None:
        m, lo, hi = key[:3]
        counts: dict[int, list] = {}
        for i, j in near_in_list([r[0] for r in rows]):
            (a, x, nx), (b, y, ny) = rows[i], rows[j]
            # Due here: the shorter word has m characters, and the words part within this segment.
            if min(len(x), len(y)) != m or hi < m and common_prefix(a, b) >= hi - lo:
                continue
            for k, other in ((i, (-ny, y)), (j, (-nx, x))):
                if k in counts:
                    counts[k][0] += 1
                    counts[k][1] = min(counts[k][1], other)
                else:
                    counts[k] = [1, other]
        for k, (n, first) in counts.items():
            for values, v in zip(out, (rows[k][1], n, first[0], first[1]), strict=True):
                values.append(v)

    def task(batches):
        key, rows = None, []
        types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        made = lambda out: pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(out, types, strict=True)], names=["word", "n_near", "first_n", "first_word"])
        for batch in batches:
            out: list[list] = [[], [], [], []]
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            for row in zip(*columns, strict=True):
                if row[:5] != key:
                    judge(key, rows, out) if rows else None
                    key, rows = row[:5], []
                rows.append(row[5:])
            yield made(out)
        out = [[], [], [], []]
        judge(key, rows, out) if rows else None
        yield made(out)

    return dealt.mapInArrow(task, "word string, n_near bigint, first_n bigint, first_word string")


def roots(links: DataFrame) -> DataFrame:
    """word, root of links (word, form): the last word that forms lead to. A form's count is a multiple of its word's, so
    that chains are short; each round doubles the steps taken."""
    now = saved(links.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = saved(now.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if step.where("moved").isEmpty():
            return now
        discard(now)
        now = step.drop("moved")
        now.saved_path = step.saved_path


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_length: int = 6, least_count: int = 5, dominance: int = 5, drop_every: int | None = 199) -> DataFrame:
    """One row a word: word, form, root, n, n_near, form_n.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased, of least_length characters and least_count
    occurrences or more. Where drop_every divides the crc32 of "id:run", one character of the run is left out first. Near
    words differ by one inserted, deleted or replaced character; a word's form is its near word of largest n (ties: the
    smallest), if that has dominance times its own n or more; its root is where forms end.

    A null text holds no words, a null id counts as empty text in the crc32. Repeated rows count as often as they stand.
    Without words the result is empty. Texts and words may be of any length. Other columns are not looked at.
    """
    words = saved(vocabulary(docs, id_column, text_column, least_length, least_count, drop_every))
    found = near_in_groups(sorted_groups(words, least_length))
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("first_n", "first_word")).alias("first"))
    most = -F.col("first.first_n")
    strong = most >= F.col("n") * dominance
    formed = saved(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(strong, F.col("first.first_word")).alias("form"), F.when(strong, most).alias("form_n")))
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
