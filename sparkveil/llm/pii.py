"""Personal data in texts: patterns, and a skip-chain conditional random field over their mentions (operator 2).

A mention is a number, an address or an opaque run of letters and digits. It is a node of a linear chain; its potential sees
its shape, its first digit, and the words before and behind it. Mentions that are equal or similar share a skip edge,
however far apart. Potentials are counts over all documents, labelled by the patterns.
"""

import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from .common import Carried, flat_slices, map_slices, name, table

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS, "secret")  # of the field
LOCAL_CHARS = re.compile(r"[A-Za-z0-9._%+-]*+")  # of an address before its @, read backwards
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match that could begin within a run of digits could begin at the run, so that only its begin is tried.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
LETTER = re.compile(r"[A-Za-z]")
QUAD = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
AROUND = re.compile(r"""[^\s<>()\[\]{},;:"']++""")  # what stands around an @
# Opaque runs, tried where they can begin; long numbers and numbers with dots, each by itself; other numbers with their
# separators.
MENTION = re.compile(rf"""(?<![A-Za-z_+/-])(?=[0-9+-]*+[A-Za-z_/])[A-Za-z0-9_+/-]++|[0-9]{{13,}}|(?<![0-9.]){QUAD}(?![0-9])|[+(]?[0-9](?:(?![ ().-]{{0,3}}(?:[0-9]{{13}}|{QUAD}(?![0-9])))[ ().-]{{0,3}}[0-9])*+""")
WORD = re.compile(r"[^\W\d_]+")
NAMED = re.compile(r"(?:token|secret|key|passw\w*|pwd|auth\w*|credential\w*)[\"']?\s{0,3}[:=]\s{0,3}[\"']?\Z", re.I)
LEAST_NUMBER, LEAST_OPAQUE, BUCKETS = 7, 20, 1024  # characters of a number, of an opaque run; hashed words
ROUNDS, BELIEF = 50, 0.9


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def card_ok(digits: str) -> bool:
    return 14 <= len(digits) <= 19 and luhn(digits)


def ip_ok(text: str) -> bool:
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in text.split(".")))


def addresses(text: str) -> list[tuple[int, int, int]]:
    """(start, 0, end) of the addresses. Each @ is widened once to both sides: what can stand before it lies behind the @
    and the address before."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            own = LOCAL_CHARS.match(text[done:at][::-1]).end()
            if own:
                found.append((at - own, 0, domain.end()))
                done = domain.end()
        done = max(done, at + 1)
        at = text.find("@", done)
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the patterns' matches that pass their tests, leftmost without overlap in each kind."""
    found = []
    found += addresses(text)
    if not DIGIT.search(text):
        return found
    if "." in text:
        found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if ip_ok(m[0])]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if m.end() - m.start() >= 14 and card_ok(m[0].replace(" ", "").replace("-", ""))]
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(found)


def mentions(text: str) -> list[tuple[int, int]]:
    """Spans that may be personal data, in order and apart from each other."""
    if not DIGIT.search(text) and "@" not in text:
        return []
    runs = [m.span() for m in AROUND.finditer(text) if "@" in m[0]] if "@" in text else []
    found, at = [], 0
    for a, b in [*runs, (len(text), len(text))]:
        for m in MENTION.finditer(text, at, a):
            size, own = m.end() - m.start(), m[0]
            if size >= LEAST_NUMBER if not LETTER.search(own) else size >= LEAST_OPAQUE and DIGIT.search(own):
                found.append(m.span())
        if a < b:
            found.append((a, b))
        at = b
    return found


def shape(text: str) -> str:
    """What a potential sees of a mention's form, one of a bounded number. A leading plus is held back: it is what the
    pattern for phones goes by, and a phone without it is for the field to find."""
    if "@" in text:
        return f"@{int(bool(re.search(r'@[A-Za-z0-9-]+[.][A-Za-z0-9-]', text)))}{int(text[0] == '@')}"
    digits = NOT_DIGIT.sub("", text)
    if LETTER.search(text):
        return f"x{min(len(text) // 8, 8)}{min(4 * len(digits) // len(text), 3)}{int(text == text.lower())}"
    dotted = re.fullmatch(QUAD, text) is not None
    return f"{min(len(digits), 20)}{'i' if dotted and ip_ok(text) else 'd' if dotted else ''}{'c' if card_ok(digits) else ''}{int('-' in text or ' ' in text)}"


def observed(text: str, a: int, b: int) -> list[str]:
    """The features of a mention: shape, first digit of a number, hashed words before and behind."""
    own, before, behind = text[a:b], WORD.findall(text[max(0, a - 24) : a]), WORD.search(text, b, b + 24)
    hashed = lambda w: xxh32_intdigest(w.lower()) % BUCKETS
    lead = NOT_DIGIT.sub("", own)[:1] if not LETTER.search(own) and len(own) >= 13 and own.isdigit() else "-"
    return [f"s{shape(own)}", f"d{lead}", f"b{hashed(before[-1]) if before else '-'}", f"f{hashed(behind[0]) if behind else '-'}"]


WEIGHTS = (1.0, 1.0, 0.5, 0.5)  # of the features; neighbouring words are many and rare, and count half


def core(text: str) -> str:
    """Mentions with equal cores are the same or similar and share a skip edge."""
    if "@" in text:
        return text.lower().strip(".")
    digits = NOT_DIGIT.sub("", text)
    return digits[-9:] if len(digits) >= 9 and not LETTER.search(text) else text


def neighbours(text: str, spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges between mentions at most 40 characters apart, skip edges between one occurrence of a core and the next."""
    chain = [(i, i + 1) for i in range(len(spans) - 1) if spans[i + 1][0] - spans[i][1] <= 40]
    last: dict[str, int] = {}
    skip = []
    for i, (a, b) in enumerate(spans):
        key = core(text[a:b])
        if key in last:
            skip.append((last[key], i))
        last[key] = i
    return chain, skip


def tagged(text: str, spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[int]:
    """Label of each mention: 1 + the kind of the first base span that it overlaps, or that of a secret where it is an
    opaque run that is named one, else 0. Spans that end before a mention are passed once; the rest are looked at in order
    of their start, so that a long span hides none."""
    labels, k, open_ = [], 0, []
    for a, b in spans:
        while k < len(base) and base[k][0] < b:
            open_.append(base[k])
            k += 1
        open_ = [x for x in open_ if x[2] > a]
        kind = next((1 + kind for s, kind, e in open_ if s < b and e > a), 0)
        if not kind and LETTER.search(text, a, b) and "@" not in text[a:b] and NAMED.search(text[max(0, a - 24) : a]):
            kind = len(LABELS) - 1
        labels.append(kind)
    return labels


def unobserved(text: str, spans: list[tuple[int, int]], labels: list[int]) -> list[bool]:
    """Mentions without a label that are like one with a label: whether they are personal data is open, so that they are
    no evidence of the label none."""
    known = {core(text[a:b]) for (a, b), y in zip(spans, labels, strict=True) if y}
    return [not y and core(text[a:b]) in known for (a, b), y in zip(spans, labels, strict=True)]


def learn(docs: DataFrame) -> dict:
    """Log-potentials from counts over all documents, as the patterns label them: of features by label, of neighbours on
    the chain, of mentions that a skip edge joins. Only counts of a bounded number of features are gathered."""
    rows = docs.select("text")
    size = len(LABELS)

    def start():
        def make(texts):
            counts: Counter = Counter()
            for text in texts:
                spans = mentions(text or "")
                if not spans:
                    continue
                labels = tagged(text, spans, base_spans(text))
                away = unobserved(text, spans, labels)
                for (a, b), y, out in zip(spans, labels, away, strict=True):
                    if not out:
                        counts[f"y {y}"] += 1
                        counts.update(f"n {x} {y}" for x in observed(text, a, b))
                for kind, edges in zip("cs", neighbours(text, spans), strict=True):
                    counts.update(f"{kind} {labels[i]} {labels[j]}" for i, j in edges if not away[i] and not away[j])
            return list(counts), list(counts.values())

        return make

    counted = flat_slices(rows, {"what": "string", "n": "bigint"}, start).groupBy("what").agg(F.sum("n").alias("n")).collect()
    nodes: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(size))
    # Before any count, neighbours are independent and similar mentions agree.
    edges, total = {"c": np.ones((size, size)), "s": np.ones((size, size)) + 20 * np.eye(size)}, np.ones(size)
    for what, n in counted:
        kind, *rest = what.split(" ")
        if kind == "y":
            total[int(rest[0])] += n
        elif kind == "n":
            nodes[rest[0]][int(rest[1])] += n
        else:
            a, b = map(int, rest)
            edges[kind][a, b] += n
            edges[kind][b, a] += n
    # A feature's potential is log P(feature | label), smoothed towards its share of all mentions.
    share = lambda v: (v.sum() + 0.5) / (total.sum() + 1)
    out = {"prior": np.log(total / total.sum()), "node": {k: np.log((v + 2 * share(v)) / (total + 2)) for k, v in nodes.items()}, "rare": np.log(1 / (total + 2))}
    for kind, m in edges.items():
        out[kind] = np.log(m / m.sum()) - np.log(m.sum(0) / m.sum())[:, None] - np.log(m.sum(1) / m.sum())[None, :]
    return out


def beliefs(node: np.ndarray, edges: list[tuple[int, int, np.ndarray]], rounds: int = ROUNDS) -> np.ndarray:
    """Sum-product message passing on a graph with loops, with damping, until messages stay: each node's label
    probabilities. On a tree they are exact."""
    if edges:
        source = np.array([e[0] for e in edges] + [e[1] for e in edges])
        target = np.array([e[1] for e in edges] + [e[0] for e in edges])
        weight = np.exp(np.array([e[2] for e in edges] + [e[2].T for e in edges]))
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        message = np.zeros((len(source), node.shape[1]))
        for _ in range(rounds):
            total = node.copy()
            np.add.at(total, target, message)
            out = total[source] - message[back]
            out = np.log(np.einsum("ea,eab->eb", np.exp(out - out.max(1, keepdims=True)), weight) + 1e-30)
            out -= out.max(1, keepdims=True)
            step = np.abs(out - message).max()
            message = 0.3 * message + 0.7 * out
            if step < 1e-6:
                break
        node = node.copy()
        np.add.at(node, target, message)
    p = np.exp(node - node.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def added_spans(text: str, base: list[tuple[int, int, int]], model: dict) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of mentions outside all base spans: secrets that are named so, and those that the field
    gives a label of personal data with BELIEF or more. The patterns' labels are fixed in the field."""
    spans = mentions(text)
    if not spans:
        return []
    labels = tagged(text, spans, base)
    if all(labels):
        p = np.zeros((len(spans), len(LABELS)))
    else:
        node = np.stack([model["prior"] + sum(w * model["node"].get(x, model["rare"]) for w, x in zip(WEIGHTS, observed(text, a, b), strict=True)) for a, b in spans])
        for i, y in enumerate(labels):
            if y:
                node[i] = -30.0
                node[i, y] = 0.0
        chain, skip = neighbours(text, spans)
        p = beliefs(node, [(i, j, model["c"]) for i, j in chain] + [(i, j, model["s"]) for i, j in skip])
    out = []
    for i, (a, b) in enumerate(spans):
        if labels[i] == len(LABELS) - 1:
            out.append((a, len(KINDS), b))
        elif not labels[i] and p[i, 1:].max() >= BELIEF:
            out.append((a, int(p[i, 1:].argmax()), b))
    return out


def find_pii(docs: DataFrame, text: str = "text", id_column: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """keep columns of docs (all unless given), then n_email, n_ip, n_card, n_phone (of the patterns' spans), base (the
    patterns' spans), spans (with those that the field adds, secrets among them), n_added, the number of those, and n_spans,
    the number of all. A span is kind:start:end in code points, comma-joined by start, then kind.

    A null or empty text has no spans. A null id is kept. Repeated rows get equal results; a text of any length is one
    graph. Without rows there are none. Columns of docs with the names of results are replaced, others may have any name.
    """
    outputs = {**{f"n_{k}": "bigint" for k in KINDS}, "base": "string", "spans": "string", "n_added": "bigint", "n_spans": "bigint"}
    carried = Carried(docs, keep, list(outputs))
    model = docs.sparkSession.sparkContext.broadcast(learn(docs.select(docs[name(text)].alias("text"))))

    def start():
        kinds = LABELS[1:]

        def put(spans):
            return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)

        def make(texts):
            out: list[list] = [[] for _ in outputs]
            for x in texts:
                base = base_spans(x or "")
                more = added_spans(x or "", base, model.value)
                n = Counter(k for _, k, _ in base)
                for values, v in zip(out, (*(n[k] for k in range(4)), put(base), put(sorted(base + more)), len(more), len(base) + len(more)), strict=True):
                    values.append(v)
            return out

        return make

    source, given = carried.with_input(text)
    found = map_slices(source, outputs, start, keep=carried.inner, inputs=[given])
    return found.select(*carried.back, *outputs)


def op2_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans", "n_added", "n_spans")
