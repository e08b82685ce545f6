"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks (operator 5).

The kernel of two strings counts the three-letter subsequences that they share, gaps allowed, each weighted by DECAY to
the length it spans; strings are normalised. The machine scores words; a document's score weighs its two worst words
and the share of all its words that are bad.
"""

import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
from xxhash import xxh64_intdigest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Carried, flat_slices, map_slices, name, saved, table

DECAY, SPAN, WIDTH, SIZE = 0.6, 6, 24, 32**3
OFFSETS = [(a, b) for a, b in combinations(range(1, SPAN), 2)]
SAMPLE_DOCUMENTS = 20_000  # bound of the labelled documents that the classifier is fitted on
HIT, STRONG = 0.3, 0.8  # decision values of words
LANDMARKS, NEGATIVE_WORDS, POSITIVE_WORDS = 128, 8_000, 600
EDGES = re.compile(r"^[^\w]+|[^\w]+$")
NOT_LETTER = re.compile(r"[\W\d_]+")
SPACED = re.compile(r"(?<!\S)\w(?:[ .*_-]{1,2}\w){3,}(?!\w)")
SENTENCE_END = re.compile(r"[.!?\n]+")
CACHED_WORDS = 150_000
# Letters a to z are 1 to 26; the rest share five codes.
CODE = np.array([ord(chr(i)) - 96 if "a" <= chr(i) <= "z" else 27 + i % 5 for i in range(0x250)], dtype=np.int64)


def words(text: str) -> Counter[str]:
    """Lower-case words of the whole text, and letters set apart one by one joined to words, with their counts."""
    lower = text.lower()
    found = Counter(lower.split())
    if sum(map((1).__eq__, map(len, found))) >= 3:
        found.update(NOT_LETTER.sub("", m[0]) for m in SPACED.finditer(lower))
    return found


def forms(word: str) -> list[str]:
    """What of a word is compared: it without outer marks, it without all marks, in overlapping pieces if it is long."""
    bare = word if word.isalpha() else EDGES.sub("", word)
    letters = bare if bare.isalpha() else NOT_LETTER.sub("", bare)
    out = [bare] if letters == bare else [bare, letters]
    return [p for w in out if len(w) >= 3 for p in ([w] if len(w) <= WIDTH else [w[i : i + WIDTH] for i in range(0, len(w) - WIDTH // 2, WIDTH // 2)])]


def extremes(text: str) -> tuple[int, int]:
    """The least and the largest hash of five consecutive words, or of all where there are fewer."""
    w = text.lower().split()
    hashes = [xxh64_intdigest(" ".join(x)) >> 1 for x in zip(w, w[1:], w[2:], w[3:], w[4:])] or [xxh64_intdigest(" ".join(w)) >> 1]
    return min(hashes), max(hashes)


def codes(strings: list[str]) -> np.ndarray:
    """Letters as numbers, a row for each string, as wide as the longest."""
    width = max(map(len, strings))
    raw = np.frombuffer("".join(s.ljust(width, "\0") for s in strings).encode("utf-32-le", "replace"), dtype=np.uint32).reshape(len(strings), width)
    out = np.where(raw < len(CODE), CODE[np.minimum(raw, len(CODE) - 1)], 27 + raw % 5)
    return np.where(raw == 0, 0, out).astype(np.int64)


def subsequences(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the subsequences of each string and their weights, zero where there is none."""
    keys, weights, width = [], [], c.shape[1]
    for a, b in OFFSETS:
        if b >= width:
            continue
        last = c[:, b:]
        keys.append(c[:, : width - b] * 1024 + c[:, a : width - b + a] * 32 + last)
        weights.append((last > 0) * DECAY ** (b + 1))
    return np.concatenate(keys, axis=1), np.concatenate(weights, axis=1)


def features(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse normalised feature vectors: row, subsequence, weight."""
    if not strings:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    keys, weights = subsequences(codes(strings))
    flat = (np.arange(len(strings))[:, None] * SIZE + keys)[weights > 0]
    unique, inverse = np.unique(flat, return_inverse=True)
    value = np.bincount(inverse, weights=weights[weights > 0], minlength=len(unique))
    row, key = unique // SIZE, unique % SIZE
    norm = np.sqrt(np.bincount(row, weights=value**2, minlength=len(strings)))
    return row, key, value / norm[row]


def dense_features(strings: list[str]) -> np.ndarray:
    row, key, value = features(strings)
    out = np.zeros((SIZE, len(strings)))
    out[key, row] = value
    return out


def kernel(strings: list[str], dense: np.ndarray) -> np.ndarray:
    """Normalised kernel of strings with those of dense_features."""
    out = np.zeros((len(strings), dense.shape[1]))
    for i in range(0, len(strings), 512):
        row, key, value = features(strings[i : i + 512])
        first = np.flatnonzero(np.diff(row, prepend=-1))
        if len(first):
            out[i + row[first]] = np.add.reduceat(dense[key] * value[:, None], first, axis=0)
    return out


class Scorer:
    """Decision values of words. The landmark expansion is one vector over subsequences, so that a word's value is a
    sum of its entries; the exact norm is taken for words with a positive sum only, others stay below the bias."""

    def __init__(self, beta: np.ndarray, bias: float):
        self.beta, self.bias = beta, bias
        self.cache: dict[str, float] = {}

    def strings(self, strings: list[str]) -> np.ndarray:
        out, by_length = np.full(len(strings), self.bias), defaultdict(list)
        for i, s in enumerate(strings):
            by_length[len(s)].append(i)
        for places in by_length.values():  # so that short words are not padded to the width of long ones
            keys, weights = subsequences(codes([strings[i] for i in places]))
            some = np.array(places)[(self.beta[keys] * weights).sum(1) > 0]
            if len(some):
                row, key, value = features([strings[i] for i in some])
                out[some] += np.bincount(row, weights=self.beta[key] * value, minlength=len(some))
        return out

    def learn(self, new: list[str]) -> None:
        for i in range(0, len(new), 4096):
            some = new[i : i + 4096]
            pieces = [(k, p) for k, w in enumerate(some) for p in forms(w)]
            best = np.full(len(some), self.bias)
            if pieces:
                np.maximum.at(best, np.array([k for k, _ in pieces]), self.strings([p for _, p in pieces]))
            self.cache.update(zip(some, best.tolist(), strict=True))

    def texts(self, texts: list[str]) -> np.ndarray:
        """For each text the two highest decision values of its words, the share of its words, repeats included, above
        STRONG, and that of those above HIT, each weighted by how far it is above; shares as logarithms."""
        found = [words(t) for t in texts]
        self.learn(list(set().union(*found).difference(self.cache)))
        out = np.zeros((len(texts), 4))
        for k, f in enumerate(found):
            value = np.fromiter(map(self.cache.__getitem__, f), dtype=float, count=len(f))  # none in an empty text
            n = np.fromiter(f.values(), dtype=float, count=len(f))
            floored = np.append(value, [self.bias, self.bias])
            top = np.partition(floored, len(value))[-2:]
            shares = np.array([(n * (value > STRONG)).sum(), (n * np.clip(value - HIT, 0, 1 - HIT)).sum()])
            out[k] = *top[::-1], *np.log((shares + 0.1) / (n.sum() + 10))
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        return out


def spread(strings: list[str], weight: np.ndarray, n: int) -> list[str]:
    """At most n of the strings as landmarks, each the one with the largest weighted part of its kernel that those before
    it leave unexplained (pivoted Cholesky), so that a large family of similar words does not crowd out the others."""
    gram = kernel(strings, dense_features(strings))
    rest, factors, chosen = np.diag(gram).copy(), np.zeros((len(strings), min(n, len(strings)))), []
    for k in range(factors.shape[1]):
        i = int((rest * weight).argmax())
        if rest[i] < 1e-6:
            break
        factors[:, k] = (gram[:, i] - factors @ factors[i]) / np.sqrt(rest[i])
        rest = np.maximum(0.0, rest - factors[:, k] ** 2)
        rest[i] = 0.0
        chosen.append(strings[i])
    return chosen


def support_vectors(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 5000.0, steps: int = 40) -> np.ndarray:
    """Weights of a linear machine with squared hinge loss, by Newton steps over the examples within the margin."""
    w, weight = np.zeros(x.shape[1]), cost * weight / weight.sum()
    for _ in range(steps):
        near = y * (x @ w) < 1
        own = x[near] * weight[near][:, None]
        target = np.linalg.solve(np.eye(len(w)) + 2 * own.T @ x[near], 2 * own.T @ y[near])
        if np.allclose(target, w, atol=1e-6):
            break
        w = w + 0.7 * (target - w)
    return w


def logistic(values: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes and offset of a probability by values, with smoothed labels and a small ridge."""
    n1, n0 = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    center, scale = values.mean(0), values.std(0) + 1e-6
    v = np.concatenate([(values - center) / scale, np.ones((len(values), 1))], axis=1)
    t = np.zeros(v.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(v @ t, -30, 30)))
        t = t - np.linalg.solve((v * (p * (1 - p))[:, None]).T @ v + 0.5 * np.eye(len(t)), v.T @ (p - target) + 0.5 * t)
    return t[:-1] / scale, float(t[-1] - (t[:-1] * center / scale).sum())


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS, positive_words: int = POSITIVE_WORDS, negative_words: int = NEGATIVE_WORDS, landmarks_: int = LANDMARKS) -> dict:
    """The classifier, from labelled documents whose crc32 of the id, modulo 5, is not 0: at most sample of them.

    positive_words and negative_words bound the examples of the machine, landmarks_ its landmarks; they bound what the
    driver gathers of the sample, and no document that is scored. Copies would repeat a label's mistakes, so one document counts for those that agree in the least or the largest hash
    of five words: the one with the least hash of its text, so that every run fits alike. A word stands for its sentences:
    words nearly only in toxic documents are the positive examples, words of the others the negative ones. The driver
    gathers bounded lists of words with counts, and one value a sampled document; no text.
    """
    chosen = labels.where("doc_id is not null and toxic is not null and crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    given = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("text is not null")
    given = map_slices(given.select(F.col("label").cast("bigint").alias("label"), "text"), {"least": "bigint", "most": "bigint"}, lambda: lambda _, text: zip(*map(extremes, text), strict=True))
    one = F.struct(F.xxhash64("text").alias("key"), "text", "least", "most").alias("one")
    for alike in ("least", "most"):
        given = given.groupBy("label", alike).agg(F.min(one).alias("one")).select("label", "one.text", "one.least", "one.most")
    given = saved(given.select("label", "text"))

    def start():
        def make(label, text):
            rows = [(w, y) for y, t in zip(label, text, strict=True) for w in set().union(*(words(s) for s in SENTENCE_END.split(t)))]
            rows = {(p, y, k) for k, (w, y) in enumerate(rows) for p in forms(w)[-1:]}
            return [p for p, _, _ in rows], [y for _, y, _ in rows]

        return make

    n1, n0 = given.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    prior = (n1 + 1) / (n1 + n0 + 2)
    counts = flat_slices(given, {"word": "string", "label": "bigint"}, start).groupBy("word").agg(F.sum("label").alias("n1"), F.sum(1 - F.col("label")).alias("n0"))
    counts = saved(counts.where("n1 >= 2 or n0 >= 1"))
    rate1, rate0 = (F.col("n1") + 0.1) / (n1 + 1), (F.col("n0") + 0.1) / (n0 + 1)
    least = max(3, n1 // 200)
    positive = counts.where((F.col("n1") >= least) & (rate1 / (rate1 + rate0) >= 0.97)).orderBy(F.desc("n1"), "word").limit(positive_words).collect()
    if not positive or not n0:
        return {"beta": None, "offset": float(np.log(prior / (1 - prior)))}
    common = counts.where("n0 >= 1 and n1 <= n0").orderBy(F.desc("n0"), "word").limit(negative_words // 4).collect()
    mixed = counts.where("n0 >= 1 and n1 <= n0").orderBy(F.xxhash64("word"), "word").limit(negative_words).collect()
    negative = {r.word: r.n0 for r in [*common, *mixed]}
    examples = [r.word for r in positive] + list(negative)
    y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
    weight = np.concatenate([x / x.sum() for x in (np.array([r.n1 for r in positive], float), np.log1p(np.array(list(negative.values()), float)))])
    landmarks = spread([r.word for r in positive], np.array([r.n1 for r in positive], float), landmarks_ // 2)
    landmarks += [r.word for r in common[: landmarks_ - len(landmarks)]]
    dense = dense_features(landmarks)
    gram = kernel(landmarks, dense)
    values, vectors = np.linalg.eigh(gram + 1e-6 * np.eye(len(landmarks)))
    root = vectors / np.sqrt(np.maximum(values, 1e-6))
    x = np.concatenate([kernel(examples, dense) @ root, np.ones((len(examples), 1))], axis=1)
    w = support_vectors(x, y, weight)
    row, key, value = features(landmarks)
    beta = np.bincount(key, weights=(root @ w[:-1])[row] * value, minlength=SIZE)
    model = {"beta": beta, "bias": float(w[-1])}
    scorer = lambda: (lambda one: lambda _, text: (one.texts(text).tolist(),))(Scorer(beta, float(w[-1])))
    scored = map_slices(given, {"value": "array<double>"}, scorer, keep=["label"]).collect()
    model["slope"], model["offset"] = logistic(np.array([r.value for r in scored]), np.array([r.label for r in scored], float))
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id", keep: list[str] | None = None, sample: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """keep columns of docs (all unless given), then score (0 to 1), predicted (1 from 0.5 on) of each whole text.

    A null text scores as an empty one. Labels that are null, of unknown documents, or held out are not learned from; of
    several labels of a document the highest holds. Without toxic examples every score is the share of toxic labels.
    Repeated rows score alike. Columns of docs named score or predicted
    are replaced, others may have any name. Without rows there are none.
    """
    carried = Carried(docs, keep, ["score", "predicted"])
    model = docs.sparkSession.sparkContext.broadcast(fit(docs.select(docs[name(id_column)].alias("doc_id"), docs[name(text)].alias("text")), labels, sample))

    def start():
        m = model.value
        scorer = None if m["beta"] is None else Scorer(m["beta"], m["bias"])

        def make(texts):
            values = scorer.texts([x or "" for x in texts]) @ m["slope"] if scorer else np.zeros(len(texts))
            scores = (1 / (1 + np.exp(-np.clip(values + m["offset"], -40, 40)))).tolist()
            return scores, [int(s >= 0.5) for s in scores]

        return make

    source, given = carried.with_input(text)
    scored = map_slices(source, {"score": "double", "predicted": "int"}, start, keep=carried.inner, inputs=[given])
    return scored.select(*carried.back, "score", "predicted")


def op5_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")
