"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue (operator 4)."""

import base64
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Carried, name, table

BATCH_CHARS, KEPT_PIECES, LONG_PIECE = 4_000_000, 200_000, 64
DECODED_IDS = 200_000  # decoded at once


class Pieces(dict):
    """Pre-token to its number, new ones numbered as they come."""

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        return n


def pair_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys (left id << 32 | right id) of the pairs of tokens that make a token, and the rank of that."""
    keys, made = [], []
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                keys.append(left << 32 | right)
                made.append(rank)
    order = np.argsort(np.array(keys, dtype=np.int64))
    return np.array(keys, dtype=np.int64)[order], np.array(made, dtype=np.int64)[order]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one run after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class RankQueue:
    """Positions by the rank of the pair that starts there. A word of the lower bitmap has a bit for each of 256 ranks
    that has a bucket, the top word a bit for each lower word in use: two find-first-set steps give the next rank."""

    def __init__(self, n_ranks: int):
        self.words, self.top = [0] * (n_ranks // 256 + 1), 0
        self.bits = [1 << i for i in range(max(256, len(self.words)))]
        self.buckets: dict[int, list] = {}

    def push(self, rank: int, positions) -> None:
        if rank in self.buckets:
            self.buckets[rank].append(positions)
        else:
            self.buckets[rank] = [positions]
            self.words[rank >> 8] |= self.bits[rank & 255]
            self.top |= self.bits[rank >> 8]

    def pop(self) -> tuple[int, list] | None:
        """The least rank and its whole bucket."""
        if not self.top:
            return None
        at = (self.top & -self.top).bit_length() - 1
        word = self.words[at]
        low = word & -word
        self.words[at] = word ^ low
        if word == low:
            self.top ^= self.bits[at]
        rank = at << 8 | (low.bit_length() - 1)
        return rank, self.buckets.pop(rank)


class BytePairCoder:
    """All new pre-tokens of a batch share one rank queue over one linked list of tokens. The least rank over all is the
    least of each pre-token that has it, so a whole bucket merges at once, the leftmost position of each pre-token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, pairs: tuple[np.ndarray, np.ndarray] | None = None):
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.keys, self.made = pair_table(ranks) if pairs is None else pairs
        self.byte = np.array([ranks.get(bytes([i]), -1) for i in range(256)], dtype=np.int64)
        size = max(ranks.values(), default=0) + 1
        self.n_ranks, self.length = size, np.zeros(size, dtype=np.int64)
        for token, rank in ranks.items():
            self.length[rank] = len(token)
        self.start = np.cumsum(self.length) - self.length
        spelled = [b""] * size
        for token, rank in ranks.items():
            spelled[rank] = token
        self.spelling = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.clear()

    def clear(self) -> None:
        self.pieces, self.known = Pieces(), 0
        self.ids, self.first, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, -1 where they make no token or one of them is -1."""
        if not len(self.keys):
            return np.full(len(left), -1, dtype=np.int64)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.made[at], -1)

    def short(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one after another, and how many each has."""
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        raw = np.frombuffer(b"\0".join(pieces) + b"\0", dtype=np.uint8)
        ends = np.cumsum(sizes + 1) - 1  # a slot after each piece, and before the next, holds no token
        token = self.byte[raw]
        token[ends] = -1
        n = len(token)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        owner = np.repeat(np.arange(len(pieces)), sizes + 1)
        pair = self.rank(token, np.append(token[1:], -1))
        queue = RankQueue(self.n_ranks)

        def push(ranks: np.ndarray, positions: np.ndarray) -> None:
            if len(ranks) < 400:
                for r, i in zip(ranks.tolist(), positions.tolist(), strict=True):
                    if r >= 0:
                        queue.push(r, i)
                return
            order = np.argsort(ranks, kind="stable")
            ranks, positions = ranks[order], positions[order]
            cuts = np.flatnonzero(np.diff(ranks, prepend=-2))
            for r, some in zip(ranks[cuts].tolist(), np.split(positions, cuts[1:]), strict=True):
                if r >= 0:
                    queue.push(r, some)

        push(pair, np.arange(n))
        while (least := queue.pop()) is not None:
            r, held = least
            at = np.array(held) if type(held[0]) is int and all(type(x) is int for x in held) else np.concatenate([np.atleast_1d(x) for x in held])
            at = at[pair[at] == r]  # others are stale: one of the two has merged since
            if not len(at):
                continue
            if len(at) > 1:
                at = np.unique(at)
                leftmost = np.diff(owner[at], prepend=-1) > 0
                if not leftmost.all():
                    queue.push(r, at[~leftmost])
                    at = at[leftmost]
            gone = after[at]
            end = after[gone]
            token[at], after[at], before[end], pair[gone], token[gone] = r, end, at, -1, -1
            left = before[at]
            right_rank, left_rank = self.rank(token[at], token[end]), self.rank(np.where(left >= 0, token[left], -1), token[at])
            pair[at] = right_rank
            some = left >= 0
            pair[left[some]] = left_rank[some]
            push(np.concatenate([right_rank, left_rank[some]]), np.concatenate([at, left[some]]))
        live = token >= 0
        return token[live].astype(np.int32), np.bincount(owner[live], minlength=len(pieces))

    def long(self, piece: bytes) -> list[int]:
        """One long pre-token by a queue of its own, a heap in each bucket."""
        rank_of, n, queue = self.ranks.get, len(piece), RankQueue(self.n_ranks)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        pair = [rank_of(piece[i : i + 2], -1) for i in range(n - 1)] + [-1]

        def push(rank: int, i: int) -> None:
            if rank in queue.buckets:
                heappush(queue.buckets[rank], i)
            elif rank >= 0:
                queue.push(rank, i)

        for i, rank in enumerate(pair):
            push(rank, i)
        while (least := queue.pop()) is not None:
            rank, bucket = least
            i = heappop(bucket)
            if bucket:
                queue.push(rank, bucket[0])
                queue.buckets[rank] = bucket
            if pair[i] != rank:
                continue
            gone = after[i]
            pair[gone] = -1
            after[i] = end = after[gone]
            pair[i] = rank_of(piece[i : after[end]], -1) if end < n else -1
            push(pair[i], i)
            if end < n:
                before[end] = i
            if (left := before[i]) >= 0:
                pair[left] = rank_of(piece[left:end], -1)
                push(pair[left], left)
        ids, i = [], 0
        while i < n:
            ids.append(rank_of(piece[i : after[i]]))
            i = after[i]
        return ids

    def learn(self) -> None:
        """Ids of the pieces numbered since the last call."""
        new = [p.encode() for p in islice(self.pieces, self.known, None)]
        whole = [self.ranks.get(p, -1) for p in new]
        short = [k for k, p in enumerate(new) if whole[k] < 0 and len(p) <= LONG_PIECE]
        parts: list[np.ndarray] = [np.array([r], dtype=np.int32) if r >= 0 else None for r in whole]
        if short:
            ids, counts = self.short([new[k] for k in short])
            for k, own in zip(short, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
                parts[k] = own
        for k, p in enumerate(new):
            if parts[k] is None:
                parts[k] = np.array(self.long(p), dtype=np.int32)
        if new:
            count = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
            self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.ids = np.concatenate([self.ids, *parts])
        self.known = len(self.pieces)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has."""
        number = self.pieces.__getitem__
        rows = [np.array(list(map(number, self.find(t))), dtype=np.int32) for t in texts]
        self.learn()
        sizes = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        counts = self.count[flat]
        ids = self.ids[ragged(self.first[flat], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(sizes)]
        if self.known > KEPT_PIECES:
            self.clear()
        return ids, np.diff(ends, prepend=0)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows of ids, one after another, and how many each row has."""
        sizes = self.length[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)]
        parts = [self.spelling[ragged(self.start[ids[i : i + DECODED_IDS]], sizes[i : i + DECODED_IDS])] for i in range(0, len(ids), DECODED_IDS)]
        return np.concatenate(parts) if parts else self.spelling[:0], np.diff(ends, prepend=0)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """keep columns of docs (all unless given), then token_ids array<int> and decoded binary, from whole texts.

    The driver reads the rank file, whose size is fixed, and broadcasts it. A null text encodes as the empty text: no
    ids. Repeated rows are encoded alike. Columns of docs named token_ids or decoded are replaced, others may have any name.
    """
    ranks = load_ranks(ranks_path)
    tables = docs.sparkSession.sparkContext.broadcast((ranks, pair_table(ranks)))
    carried = Carried(docs, keep, ["token_ids", "decoded"])
    kept = carried.inner
    source, given = carried.with_input(text)
    kinds, at = dict(source.dtypes), source.columns.index(given)

    def offsets(counts: np.ndarray) -> pa.Array:
        return pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))

    def task(batches):
        coder = BytePairCoder(tables.value[0], pattern, tables.value[1])
        for batch in batches:
            texts = batch.column(at)
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            i = 0
            while i < batch.num_rows:  # as many rows as hold BATCH_CHARS bytes, one at least
                past = sizes[i - 1] if i else 0
                j = max(i + 1, int(np.searchsorted(sizes, past + BATCH_CHARS, side="right")))
                part = batch.slice(i, j - i)
                ids, counts = coder.encode([x or "" for x in part.column(at).to_pylist()])
                raw, lengths = coder.decode(ids, counts)
                lists = pa.ListArray.from_arrays(offsets(counts), pa.array(ids))
                decoded = pa.Array.from_buffers(pa.binary(), len(lengths), [None, offsets(lengths).buffers()[1], pa.py_buffer(raw.tobytes())])
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(kept))), lists, decoded], names=[*kept, "token_ids", "decoded"])
                i = j

    coded = source.mapInArrow(task, ", ".join([*(f"{name(c)} {kinds[c]}" for c in kept), "token_ids array<int>", "decoded binary"]))
    return coded.select(*carried.back, "token_ids", "decoded")


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    coded = encode_decode(docs, ranks_path, pattern, keep=["doc_id"])
    return coded.select("doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
