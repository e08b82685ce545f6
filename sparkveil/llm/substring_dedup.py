"""Repeated passages of words by suffix automata (operator 3).

Every window of WINDOW words has an anchor: its least hash of ANCHOR consecutive words. Windows that share an anchor
occurrence form a run, and equal windows have equal anchors, so that only runs with equal anchors can repeat each other.
Runs are the reference shards: a shard is what an anchor has gathered, each different run once, and its suffix automaton
takes the later runs word by word for matching statistics. Routing by anchor stands in for broadcasting every shard to
every document.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import Carried, discard, flat_slices, map_slices, name, saved, split_join, table

WINDOW, ANCHOR = 20, 6
MOST_WINDOWS = 62  # of a run, which are marked in the bits of a bigint
SHARD_RUNS = 64  # an anchor with more different runs than this is dealt by window instead
CACHED_WORDS = 300_000
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)


class Hasher:
    """64-bit hashes of words, of the words of an interval, and the runs of a document."""

    def __init__(self, window: int, anchor: int):
        self.window, self.anchor, self.cache = window, anchor, {}
        self.powers = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)

    def words(self, words: list[bytes]) -> np.ndarray:
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        cache = self.cache
        for w in set(words).difference(cache):
            cache[w] = xxh64_intdigest(w)
        return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))

    def power(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.powers[0]) < n:
            size = max(n, 4096)
            self.powers = tuple(np.cumprod(np.concatenate([np.ones(1, dtype=np.uint64), np.full(size, m, dtype=np.uint64)])) for m in (MULTIPLIER, INVERSE))
        return self.powers

    def intervals(self, hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """A hash of the words from first to before last, whatever stands before them."""
        up, down = self.power(len(hashes) + 1)
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * up[: len(hashes)])])
        value = (total[last] - total[first]) * down[first]
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        return value ^ (value >> np.uint64(32))

    def runs(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """start, number of windows, anchor and content hash of each run."""
        n = len(hashes) - self.window + 1
        if n <= 0:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none, none
        spread = self.window - self.anchor + 1
        at = np.arange(len(hashes) - self.anchor + 1)
        grams = self.intervals(hashes, at, at + self.anchor)
        # The place of the least of each window by doubling; ties go to the leftmost.
        place, size = at, 1

        def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return np.where(grams[b] < grams[a], b, a)

        while 2 * size <= spread:
            place = least(place[:-size], place[size:])
            size *= 2
        place = least(place[:n], place[spread - size : spread - size + n])
        start = np.flatnonzero(np.diff(place, prepend=-1))
        count = np.diff(start, append=n)
        content = self.intervals(hashes * np.uint64(0xD6E8FEB86659FD93), start, start + count + self.window - 1)
        # The run's length and where its anchor stands belong to its content.
        content ^= (count * 64 + place[start] - start).astype(np.uint64)
        return start, count, grams[place[start]].view(np.int64), content.view(np.int64)


class Automaton:
    """Suffix automaton of several strings of word numbers."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, string: list[int]) -> None:
        nxt, link, length, last = self.next, self.link, self.length, 0
        for c in string:
            old = nxt[last].get(c)
            if old is not None and length[old] == length[last] + 1:
                last = old
                continue
            if old is None:
                cur = len(nxt)
                nxt.append({})
                length.append(length[last] + 1)
                link.append(0)
                p = last
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = cur
                    p = link[p]
            else:
                cur, p = -1, last
            if p >= 0:
                q = nxt[p][c]
                if length[q] == length[p] + 1:
                    target = q
                else:
                    target = len(nxt)
                    nxt.append(dict(nxt[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    link[q] = target
                    while p >= 0 and nxt[p].get(c) == q:
                        nxt[p][c] = target
                        p = link[p]
                if cur >= 0:
                    link[cur] = target
                last = cur if cur >= 0 else target
            else:
                last = cur

    def matches(self, string: list[int]) -> list[int]:
        """For each place the length of the longest match that ends there."""
        nxt, link, length, state, size, out = self.next, self.link, self.length, 0, 0, []
        for c in string:
            while state and c not in nxt[state]:
                state = link[state]
                size = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                size += 1
            else:
                size = 0
            out.append(size)
        return out


def sorted_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()  # bytes split at space and \\t to \\r alone


def remove_repeats(docs: DataFrame, text: str = "text", id_column: str = "doc_id", window: int = WINDOW, anchor: int = ANCHOR, keep: list[str] | None = None) -> DataFrame:
    """keep columns of docs (all unless given), with kept_text, n_words and n_removed: the text's words less those that a
    window of words covers which starts earlier, in a smaller id or earlier in the document; joined by single spaces.

    A null text has no words. Null ids come after all others. Rows equal in id and text count as one document; rows of
    one id with different texts are ordered by a hash of the text. Runs are held equal where two independent 64-bit
    hashes agree. A window may be up to MOST_WINDOWS words longer than an anchor. Without rows there are none. Columns of
    docs with the names of results are replaced, others may have any name.
    """
    if not 1 <= anchor <= window or window - anchor >= MOST_WINDOWS:
        raise ValueError(f"a run of {window - anchor + 1} windows does not fit: at most {MOST_WINDOWS}")
    results = ["kept_text", "n_words", "n_removed"]
    carried = Carried(docs, keep, results)
    order_id = F.coalesce(docs[name(id_column)], F.lit((1 << 63) - 1)).cast("bigint")
    given = docs.select(*carried.columns, order_id.alias("id"), F.xxhash64(docs[name(text)]).alias("row"), docs[name(text)].alias("text"))
    slim = given.where("text is not null").select("id", "row", "text")
    place = ["id", "row", "start"]

    def find_runs():
        hasher = Hasher(window, anchor)

        def make(ids, rows, texts):
            parts: list[list] = [[] for _ in range(6)]
            for i, r, t in zip(ids, rows, texts, strict=True):
                words = sorted_words(t)
                if len(words) >= window:
                    start, count, key, content = hasher.runs(hasher.words(words))
                    for held, v in zip(parts, (key, content, count, np.full(len(start), i), np.full(len(start), r), start), strict=True):
                        held.append(v)
            return [np.concatenate(p) if p else np.zeros(0, dtype=np.int64) for p in parts]

        return make

    runs = saved(flat_slices(slim, {"anchor": "bigint", "content": "bigint", "count": "int", "id": "bigint", "row": "bigint", "start": "int"}, find_runs))
    # Most anchors occur once: a count of anchors alone leaves the runs that may repeat.
    total = runs.count()
    several = saved(runs.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"))
    every, runs = runs, saved(split_join(runs, several, ["anchor"], total, "left_semi"))
    discard(every)
    distinct = saved(runs.groupBy("anchor", "content", "count").agg(F.min(F.struct(*place)).alias("first"), F.count("*").alias("n")))
    # Anchors with more than one different run; the counts combine before the shuffle.
    mixed = distinct.groupBy("anchor").agg(F.count("*").alias("runs")).where("runs > 1")
    firsts = saved(distinct.join(mixed, "anchor").select("anchor", "count", "first.*", (F.col("runs") > SHARD_RUNS).alias("hot")))
    # Runs seen before as they stand: all their windows repeat.
    repeated = distinct.where("n > 1").select("anchor", "content", "count", "first", "n")
    whole = split_join(runs, repeated, ["anchor", "content", "count"], total).where(F.struct(*place) != F.col("first")).select(*place, F.expr("shiftleft(1L, count) - 1").alias("mask"))
    # The others: the words of the first occurrences are fetched, document by document.
    asked = firsts.groupBy("id", "row").agg(F.collect_list(F.struct("start", "count", "anchor", "hot")).alias("asked"))
    fetched = slim.join(asked, ["id", "row"]).select("id", "row", "text", "asked")

    def pieces():
        hasher = Hasher(window, anchor)

        def make(ids, rows, texts, asked_):
            out: list[list] = [[] for _ in range(5)]
            for i, r, t, runs_ in zip(ids, rows, texts, asked_, strict=True):
                hashes = hasher.words(sorted_words(t))
                for a in runs_:
                    if not a["hot"]:
                        k = a["start"]
                        for held, v in zip(out, (a["anchor"], i, r, k, hashes[k : k + a["count"] + window - 1].tobytes()), strict=True):
                            held.append(v)
            return out

        return make

    def windows():
        hasher = Hasher(window, anchor)

        def make(ids, rows, texts, asked_):
            out: list[list] = [[] for _ in range(6)]
            for i, r, t, runs_ in zip(ids, rows, texts, asked_, strict=True):
                hot = [(a["anchor"], k) for a in runs_ if a["hot"] for k in range(a["start"], a["start"] + a["count"])]
                if hot:
                    hashes, at = hasher.words(sorted_words(t)), np.array([k for _, k in hot])
                    one, two = hasher.intervals(hashes, at, at + window), hasher.intervals(hashes * np.uint64(0xD6E8FEB86659FD93), at, at + window)
                    for held, v in zip(out, ([a for a, _ in hot], one.view(np.int64).tolist(), two.view(np.int64).tolist(), [i] * len(hot), [r] * len(hot), at.tolist()), strict=True):
                        held += v
            return out

        return make

    sent = flat_slices(fetched, {"anchor": "bigint", "id": "bigint", "row": "bigint", "start": "int", "words": "binary"}, pieces)
    # Windows of anchors that many different runs share need no automaton: each is held against its first occurrence, which
    # a combining aggregate finds, so that a passage on every page is no large task.
    same = ["anchor", "one", "two"]
    single = saved(flat_slices(fetched.where(F.exists("asked", lambda a: a["hot"])), {"anchor": "bigint", "one": "bigint", "two": "bigint", "id": "bigint", "row": "bigint", "start": "int"}, windows))
    again = saved(single.groupBy(*same).agg(F.min(F.struct(*place)).alias("first"), F.count("*").alias("n")).where("n > 1"))
    spread = split_join(single, again, same, single.count()).where(F.struct(*place) != F.col("first")).select(*place, F.lit(1).cast("bigint").alias("mask")).distinct()
    # A shard's runs come to one task in order, and are streamed through its automaton; no more than one shard is held.
    # Shards are bounded, as an anchor with more runs is dealt by window.
    dealt = sent.repartition("anchor").sortWithinPartitions("anchor", *place)

    def match(batches):
        shard, automaton, numbers = None, None, {}
        for batch in batches:
            out: list[list] = [[] for _ in range(4)]
            for a, i, r, s, raw in zip(*(batch.column(n).to_pylist() for n in range(5)), strict=True):
                if a != shard:
                    shard, automaton, numbers = a, Automaton(), {}
                    seen = []
                words = [numbers.setdefault(w, len(numbers)) for w in np.frombuffer(raw, dtype=np.uint64).tolist()]
                if (i, r, s) in seen:
                    continue  # the same document once more
                sizes = automaton.matches(words)
                mask = sum(1 << n for n, size in enumerate(sizes[window - 1 :]) if size >= window)
                seen = [(i, r, s)]
                if mask:
                    for held, v in zip(out, (i, r, s, mask), strict=True):
                        held.append(v)
                if mask != (1 << (len(words) - window + 1)) - 1:
                    automaton.add(words)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int64())], names=[*place, "mask"])

    partial = dealt.mapInArrow(match, "id bigint, row bigint, start int, mask bigint")
    marks = saved(whole.unionByName(partial).unionByName(spread).groupBy("id", "row").agg(F.collect_list(F.struct("start", "mask")).alias("marks")))
    joined = given.join(marks, ["id", "row"], "left").select(*carried.inner, "text", "marks")

    def rebuild():
        def make(source_texts, all_marks):
            texts, sizes, gone = [], [], []
            for t, marks_ in zip(source_texts, all_marks, strict=True):
                words = sorted_words(t or "")
                sizes.append(len(words))
                if marks_:
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    start = np.concatenate([m["start"] + np.flatnonzero(np.array([m["mask"] >> b & 1 for b in range(m["mask"].bit_length())])) for m in marks_])
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + window, -1)
                    left = np.cumsum(edge[:-1]) == 0
                    words = [w for w, k in zip(words, left.tolist(), strict=True) if k]
                gone.append(sizes[-1] - len(words))
                texts.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            return texts, sizes, gone

        return make

    return map_slices(joined, {"kept_text": "string", "n_words": "bigint", "n_removed": "bigint"}, rebuild, keep=carried.inner, inputs=["text", "marks"]).select(*carried.back, *results)


def op3_suffix_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
