"""Operators 11 to 13: spelling variants, vector codes, WARC archives."""

import gzip
import hashlib
import io
import random
import re
import zlib
from base64 import b32encode
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from sparkveil.llm import spelling, vector_codes, warc  # noqa: E402

DOCS = "doc_id bigint, text string, word string, n bigint"


def near(a, b):
    """One inserted, deleted or replaced character, by definition."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def variants(rows, length=6, count=5, dominance=5, every=199):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= length and n >= count}
    out = {}
    for w, n in words.items():
        others = [x for x in words if near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form = best if best and words[best] >= dominance * n else None
        out[w] = [form, n, len(others), words[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        row.insert(1, root)
    return {(w, *row) for w, row in out.items()}


def found_variants(df, **more):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(df, **more).collect()}


def test_sorted_list_scan_equals_definition():
    rng = random.Random(1)
    for _ in range(1500):
        words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 25))})
        want = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if near(words[i], words[j])]
        assert sorted(spelling.near_in_list(words)) == want


def test_spelling_equals_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    stems = ["straße", "ÉCOLEs", "writing", "aaaaaaa", "Wonderful", "ab×cd÷ef"]
    rows = []
    for i in range(400):
        words = []
        for _ in range(rng.randint(0, 30)):
            w = list(rng.choice(stems[: 1 + rng.randrange(6)]))
            if rng.random() < 0.4:
                at = rng.randrange(len(w))
                w[at : at + rng.randrange(2)] = rng.choice(["", "a", "é"])
            words.append("".join(w))
        rows.append((i, rng.choice([" ", "-", "漢", "😀", "_"]).join(words)))
    rows += [(None, "writing writing"), (500, None), (501, ""), (7, rows[7][1]), (7, rows[7][1]), (502, "x" * 300_000 + " writing" * 20_000), (503, "planetary " * 200 + "planetaryx " * 35 + "planetaryxx " * 6)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], DOCS)
    want = variants(rows)
    assert len(want) > 50 and any(r[1] for r in want) and any(r[2] != (r[1] or r[0]) for r in variants(rows, dominance=2))
    assert found_variants(df) == want
    monkeypatch.setattr(spelling, "GROUP", 3)  # nearly every group is cut down to one character
    assert found_variants(df, dominance=2) == variants(rows, dominance=2)
    monkeypatch.setattr(spelling, "HELD", 5)
    assert found_variants(df, least_length=3, least_count=1, drop_every=7) == variants(rows, 3, 1, 5, 7)
    assert found_variants(df.limit(0)) == set()


def test_words_that_share_long_contexts(spark):
    """A group with a common beginning or end is cut until it is small; no pair is lost or counted twice."""
    rng = random.Random(4)
    words = {"commonbeginning" + "".join(rng.choice("abc") for _ in range(rng.randint(3, 6))) for _ in range(700)} | {"".join(rng.choice("abc") for _ in range(rng.randint(3, 6))) + "commonending" for _ in range(700)}
    rows = [(1, " ".join(w for w in sorted(words) for _ in range(5 + len(w) % 7)))]
    assert found_variants(spark.createDataFrame(rows, "doc_id bigint, text string")) == variants(rows)


VECTORS = "vec_id bigint, embedding array<double>, label string, code string, error bigint"


def codes_by_hand(rows, parts=8, k=16, rounds=6):
    """Plain Python integers, one vector length."""
    kept = [(i, [int(np.floor(4096 * x)) for x in v], label) for i, v, label in rows]
    width = len(kept[0][1]) // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:k]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda p, piece: min(range(len(books[p])), key=lambda e: (gap(piece, books[p][e]), e))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(nearest(p, cut(v)[p]), []).append(cut(v)[p])
            for e, members in groups.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    out, totals = [], Counter()
    for i, v, label in kept:
        code = [nearest(p, cut(v)[p]) for p in range(parts)]
        error = sum(gap(cut(v)[p], books[p][e]) for p, e in enumerate(code))
        out.append((i, bytes(code).hex(), error, label))
        totals[label] += error
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, c, e, totals[label], sha) for i, c, e, label in out)


def found_codes(df):
    return Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.vector_codes(df).collect())


def test_vector_codes_equal_plain_integers(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 50)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(5, 16))
    rows = [(int(i), (centres[i % 5] + 0.1 * rng.normal(size=16)).round(2).tolist(), [None, "a", "b"][i % 3]) for i in range(300)]
    rows += [(3, rows[3][1], "a"), (3, rows[4][1], "a"), (None, rows[5][1], None), (-7, [0.0] * 16, ""), (400, [-0.5] * 16, "a"), (401, [-0.5] * 16, "a")]
    bad = [(500, None, "a"), (501, [float("nan")] * 16, "a"), (502, [float("inf")] + [0.0] * 15, "a"), (503, [None] + [0.0] * 15, "a"), (504, [1e300] * 16, "a")]
    make = lambda rs: spark.createDataFrame([(*r, "x", 1) for r in rs], VECTORS).repartition(7)
    assert found_codes(make(rows + bad)) == codes_by_hand(rows)
    few = rows[:9]
    assert found_codes(make(few)) == codes_by_hand(few)  # fewer vectors than entries
    assert not found_codes(make(rows).limit(0)) and not found_codes(make(bad))


def test_vectors_of_other_lengths_have_codebooks_of_their_own(spark):
    rng = np.random.default_rng(5)
    by = {n: [(1000 * n + i, rng.normal(size=n).round(3).tolist(), f"l{n}") for i in range(30)] for n in (8, 16, 24)}
    df = spark.createDataFrame([(*r, "x", 1) for rows in by.values() for r in rows] + [(1, [], None, "x", 1), (2, [0.5] * 3, "three", "x", 1)], VECTORS)
    got = found_codes(df)
    for rows in by.values():
        assert all(got[k] == n for k, n in codes_by_hand(rows).items())
    assert {(k[0], k[1], k[2]) for k in got if k[0] < 3} == {(1, "00" * 8, 0), (2, "00" * 8, 0)}


def test_decoded_vectors_are_close():
    x = np.random.default_rng(6).normal(size=(10, 16))
    whole, fits = vector_codes.integers(x.tolist(), 16, 4096)
    book = [whole[:, lo : lo + 2] for lo in range(0, 16, 2)]
    assert fits.all() and np.abs(vector_codes.decoded(bytes([4] * 8), book) - x[4]).max() <= 0.5 / 4096 + 1e-12


PAGES = "page_id bigint, url string, html string, n bigint, digest string"


def test_pages_go_through_archives(spark, tmp_path):
    body = "<p>" + "same words for all of them " * 10 + "é</p>"
    rows = [(i, f"http://h.example/{i}", body if i % 3 else f"<p>own {i}</p>" * 20) for i in range(40)]
    rows += [(50, None, None), (51, "", ""), (52, "http://x\r\nWARC-Type: evil/ é", "short"), (53, "y", "short"), (None, "z", body), (54, "v", "x" * 3_000_000), (0, rows[0][1], rows[0][2]), (1, "again", body), (1, "again", body)]
    pages = spark.createDataFrame([(*r, 1, "clash") for r in rows], PAGES).repartition(3)
    path = f"file://{tmp_path}/a"
    warc.write_warc(warc.page_records(pages), path, archive_bytes=6000)
    records = warc.read_warc(spark, path, blocks=True).collect()
    assert not any(r.problem for r in records) and len(records) == len(rows) and len({r.file for r in records}) > 3
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.resolved_pages(warc.read_warc(spark, path)).collect())
    want = Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        first = min(j for j, _, other in rows if (other or "") == (html or "") and j is not None)
        again = len(raw) >= 100 and i != first
        want[i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None] += 1
    assert got == want
    by = {r.fields["x-page-id"]: r for r in records}
    assert by["52"].target_uri == "http://x%0D%0AWARC-Type:%20evil/%20%C3%A9" and by["50"].target_uri == "urn:page:50"
    assert by["54"].block.endswith(b"\r\n\r\n" + b"x" * 3_000_000) and by["2"].record_type == "revisit" and by["2"].block.endswith(b"\r\n\r\n")
    # Any reader of gzip members finds the same records.
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "a").glob("*.warc.gz"))
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(rows)


def test_empty_tables_and_unlisted_archives(spark, tmp_path):
    path = f"file://{tmp_path}/a"
    warc.write_warc(warc.page_records(spark.createDataFrame([], PAGES)), path)
    assert warc.resolved_pages(warc.read_warc(spark, path)).count() == 0
    one = spark.createDataFrame([(1, "u", "x" * 200, 1, "")], PAGES)
    warc.write_warc(warc.page_records(one), path)
    (tmp_path / "a" / "left-by-a-lost-task.warc.gz").write_bytes(b"\x1f\x8b\x08 cut")
    assert warc.read_warc(spark, path).count() == 1
    next(x for x in (tmp_path / "a").glob("*.warc.gz") if "lost" not in x.name).unlink()
    with pytest.raises(Exception, match="archives lost"):
        warc.read_warc(spark, path).count()


def record(block=b"hello", length=None, digest=None, kind="resource", more=b""):
    lines = [b"WARC/1.0", b"warc-type: " + kind.encode(), b"WARC-Record-ID: <urn:x:1>", b"Content-Length: %d" % (len(block) if length is None else length), *([b"WARC-Block-Digest: " + digest] if digest else []), *([more] if more else [])]
    return gzip.compress(b"\r\n".join([*lines, b"", b""]) + block + b"\r\n\r\n")


def problems(data, chunk=None):
    return [(offset, p.problem, p.seen) for offset, _, p in warc.read_records(io.BytesIO(data), True)]


def test_the_reader_checks_each_record(monkeypatch):
    b32 = b"sha1:" + b32encode(hashlib.sha1(b"hello").digest())
    good = record(digest=b32)
    assert [p for _, p, _ in problems(good + record(digest=b"md5:" + hashlib.md5(b"hello").hexdigest().encode()) + record(digest=b"whirlpool:?"))] == [None] * 3
    assert "does not match" in problems(record(digest=b"sha256:" + b"0" * 64))[0][1]
    assert "5 of" in problems(gzip.compress(b"WARC/1.0\r\nContent-Length: 9\r\n\r\nhello"))[0][1]
    assert "longer" in problems(record(length=3))[0][1]
    assert "no content length" in problems(record(length=5).__class__(gzip.compress(b"WARC/1.0\r\nContent-Length: 5x\r\n\r\nhello\r\n\r\n")))[0][1]
    assert "version" in problems(gzip.compress(b"HTTP/1.0 200\r\n\r\n"))[0][1] and "without end" in problems(gzip.compress(b"WARC/1.0\r\n"))[0][1]
    assert problems(b"") == []
    # A damaged member is told of, and those around it are read; so is one that is cut off.
    rng = random.Random(7)
    big = record(block=bytes(rng.randrange(256) for _ in range(200_000)))
    broken = bytearray(big)
    broken[60_000:60_020] = bytes(20)
    found = problems(good + bytes(broken) + good + big + good[:-9])
    assert [(o, bool(p)) for o, p, _ in found] == [(0, False), (len(good), True), (len(good) + len(big), False), (2 * len(good) + len(big), False), (2 * len(good) + 2 * len(big), True)]
    # Chunks may end anywhere.
    data, whole = good + big + record(kind="revisit", more=b"WARC-Payload-Digest: sha1:OTHER"), [(0, None, 5)]
    for size in (1, 7, 100):
        monkeypatch.setattr(warc, "CHUNK", size)
        assert problems(good + good)[:1] == whole and [p for _, p, _ in problems(data if size > 1 else good)] == [None] * (3 if size > 1 else 1)


def test_damage_ends_the_job(spark, tmp_path):
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "x.warc.gz").write_bytes(record(digest=b"sha256:" + b"0" * 64))
    assert warc.read_warc(spark, f"file://{folder}").first().problem.endswith("does not match")
    with pytest.raises(Exception, match="does not match"):
        warc.resolved_pages(warc.read_warc(spark, f"file://{folder}")).collect()
    fields = F.create_map(F.lit("X-Page-Id"), F.lit("1"), F.lit("WARC-Refers-To"), F.lit("<urn:x:none>"), F.lit("WARC-Payload-Digest"), F.lit("sha256:00"))
    lonely = spark.range(1).select(F.lit("revisit").alias("record_type"), F.lit("urn:x:2").alias("record_id"), F.lit("d").alias("date"), F.lit("u").alias("target_uri"), F.lit("text/plain").alias("content_type"), fields.alias("fields"), F.lit(b"").alias("block"))
    warc.write_warc(lonely, f"file://{tmp_path}/lonely")
    with pytest.raises(Exception, match="revisit without its"):
        warc.resolved_pages(warc.read_warc(spark, f"file://{tmp_path}/lonely")).collect()
