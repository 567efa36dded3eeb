"""Vector codes and WARC bundles against plain restatements."""

import base64
import hashlib
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
import zstandard

from accesslens.llm import codes, skew, warc

# ---------------------------------------------------------------- vector codes


def brute_codes(rows, parts, entries, rounds, scale=1024):
    """Python's integers throughout."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [r for r in rows if len(r[1]) == len(rows[0][1])]
    whole = [[math.floor(Fraction(x) * scale) for x in r[1]] for r in rows]
    width = len(whole[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for v in whole] for p in range(parts)]
    books = [part[:entries] for part in cut]

    def nearest(v, book):
        far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            found = defaultdict(list)
            for v in cut[p]:
                found[nearest(v, books[p])[0]].append(v)
            books[p] = [[sum(x) // len(found[i]) for x in zip(*found[i])] if i in found else c for i, c in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out, of_label = [], defaultdict(int)
    for i, r in enumerate(rows):
        best = [nearest(cut[p][i], books[p]) for p in range(parts)]
        error = sum(e for _, e in best)
        of_label[r[2]] += error
        out.append((r[0], "".join(f"{b:02x}" for b, _ in best), error, r[2], digest))
    return [(i, code, error, of_label[label], d) for i, code, error, label, d in out]


def vectors(rng, n, size, reach):
    return [(i, [rng.uniform(-reach, reach) for _ in range(size)], rng.choice([None, 0, 1])) for i in range(n)]


@pytest.mark.parametrize("size, entries, reach, kind", [(8, 16, 1, "float"), (8, 5, 60_000, "double"), (4, 256, 2.0**60, "double"), (16, 3, 0.01, "float")])
def test_codes(spark, size, entries, reach, kind):
    rng = random.Random(size)
    rows = vectors(rng, 70, size, reach)
    rows = [(i, np.array(v, np.float32).tolist() if kind == "float" else v, label) for i, v, label in rows]
    rows += [(3, rows[5][1], 1), (None, rows[6][1], 0), (900, rows[0][1], 1), (900, rows[0][1], 1)]  # ties, repeated and null keys
    bad = [(901, None, 1), (902, [None] * size, 1), (903, [math.nan] * size, 1), (904, [math.inf] + [0.0] * (size - 1), 0), (905, [1.0], 1), (906, [], 0)]
    frame = spark.createDataFrame([(*r, 0.5, "x") for r in rows + bad], f"vec_id long, embedding array<{kind}>, label int, error double, id string").repartition(5)
    got = [tuple(r) for r in codes.compress(frame, entries=entries).collect()]
    long = lambda x: x if x < 2**63 else None
    want = [(i, c, long(e), long(le), d) for i, c, e, le, d in brute_codes(rows, 4, entries, 4)]
    assert Counter(got) == Counter(want)
    assert codes.compress(frame.limit(0)).collect() == []


def test_products_are_exact_in_limbs():
    rng = np.random.default_rng(0)
    for high in (1 << 10, 1 << 24, (1 << 29) - 1):
        a, b = rng.integers(-high, high, (40, 16)), rng.integers(-high, high, (30, 16))
        a[0], b[0] = high, -high
        assert (codes.exact_products(a, b) == a @ b.T).all()
        for size in (4, 9, 24):
            parts = codes.limbs(a, size)
            assert (sum(p.astype(np.int64) << (size * i) for i, p in enumerate(parts)) == a).all()
            assert all((p >= 0).all() and (p < 1 << size).all() for p in parts[:-1])


def test_hot_keys_are_attached(spark):
    rows = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id % 2000 as string)) AS k", "'x' AS salt")
    rows = rows.unionByName(spark.sql("SELECT 7L AS id, CAST(NULL AS string) AS k, 'x' AS salt"))
    facts = rows.where("k IS NOT NULL").groupBy("k").agg({"*": "count"}).withColumnRenamed("count(1)", "n").selectExpr("k", "n", "concat(k, '!') AS mark")
    got = skew.attached(rows, facts, ["k"], "id")
    assert got.columns == ["id", "k", "salt", "n", "mark"]
    want = Counter(r.k for r in rows.collect())
    for r in got.collect():
        assert (r.n, r.mark) == ((want[r.k], r.k + "!") if r.k else (None, None))
    assert got.count() == 5001


# ---------------------------------------------------------------- archives

PAGES = [
    (5, "http://a/", "<p>one</p>"), (2, "http://b/?q=é x\r\ny%41", "<p>one</p>"), (9, None, "<p>one</p>"), (1, "http://c/", None), (4, "http://d/", ""),
    (7, "http://e/", "zwei \r\n\r\nWARC/1.1\r\n\x00 😀"), (None, "http://f/", "<p>one</p>"), (None, "http://g/", "lone"), (None, "http://g/", "lone"),
    (11, "http://h/", "long " * 200_000), (12, "http://h/", "long " * 200_000), (2, "http://b2/", "<p>one</p>"), (13, "http://i/", "%%"), (-7, "http://j/", "minus"),
]


def expected(pages, least):
    first = {}
    for i, _, html in pages:
        first.setdefault(html or "", []).append(i)
    for i, url, html in pages:
        raw = (html or "").encode()
        known = [k for k in first[html or ""] if k is not None]
        low = min(known) if known and len(first[html or ""]) > 1 else None
        revisit = len(raw) >= least and low is not None and i != low
        yield (i, url, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response",
               low if revisit else None, None if revisit else raw)


@pytest.mark.parametrize("least, frame, bundle", [(0, 256 << 10, 8 << 20), (5, 700, 2000), (0, 1, 1)])
def test_archives_come_back(spark, tmp_path, least, frame, bundle):
    pages = PAGES + [(100 + i, f"http://n/{i}", f"page {i % 30}") for i in range(60)]
    frame_ = spark.createDataFrame([(*p, "x", 3) for p in pages], "page_id long, url string, html string, payload string, id int").repartition(3)
    path = str(tmp_path / "w")
    warc.write(frame_, path, least=least, frame_bytes=frame, bundle_bytes=bundle)
    got = [tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in warc.read(spark, path).collect()]
    assert Counter(got) == Counter(expected(pages, least))
    found = warc.lookup(spark, path, spark.createDataFrame([(11,), (5,), (999,), (5,)], "k long")).collect()
    assert sorted((r.page_id, r.record_type) for r in found) == sorted((k, kind) for k, _, _, _, kind, _, _ in expected(pages, least) if k in (5, 11))
    # Any Zstandard reader unpacks a bundle to plain records; places in the index are those of the records.
    files = [p for p in (tmp_path / "w").glob("part-*") if p.stat().st_size]
    assert len(files) > 3 if bundle < 10_000 else len(files) <= 8
    total = 0
    for file in files:
        plain = zstandard.ZstdDecompressor().stream_reader(file.read_bytes(), read_across_frames=True).read()
        reader = warc.Reader(file.read_bytes())
        rows = reader.index()
        assert b"".join(reader.read(f, o, n) for _, f, o, n in rows) == plain
        assert plain.count(b"WARC-Record-ID: ") == len(rows)
        total += len(rows)
    assert total == len(pages)


def test_damage_is_noticed(spark, tmp_path):
    raw = warc.record(1, "http://a", b"payload", None, False)
    assert warc.parsed(raw)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parsed(raw.replace(b"payload", b"payloaD"))
    bundle = warc.Bundle(10)
    bundle.add(1, raw)
    packed = bundle.packed() + warc.SEEK_MAGIC
    assert warc.Reader(packed).index() == [(1, 0, 0, len(raw))]
    with pytest.raises(ValueError):
        warc.Reader(packed[:-1])
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(empty, str(tmp_path / "e"))
    assert warc.read(spark, str(tmp_path / "e")).collect() == [] and warc.index(spark, str(tmp_path / "e")).collect() == []
