"""Operators with one right answer, against brute force."""

import glob
import hashlib
import os
import random
import tempfile
import time
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from accesslens.llm import bpe, components, decontaminate, exact, jaccard, license, lines, substring
from tests.llm.cases import ALNUM, NOT_SPACE, SCHEMA, awkward, lower, rows


def sha(value):
    return hashlib.sha256(value.encode() if isinstance(value, str) else value).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(awkward()), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def same(got, want):
    assert Counter(map(repr, got)) == Counter(map(repr, want))


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_bpe_is_tiktokens(docs, nothing, ranks):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for key, text in awkward():
        ids = b"".join(i.to_bytes(4, "little") for i in enc.encode_ordinary(text or ""))
        want.append((key, len(ids) // 4, ids, (text or "").encode()))
    got = [(r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in bpe.encode_decode(docs, ranks).collect()]
    same(got, want)
    digests = [tuple(r) for r in bpe.encode_digests(docs, ranks).collect()]
    same(digests, [(k, n, sha(i), sha(d)) for k, n, i, d in want])
    assert bpe.encode_decode(nothing, ranks).collect() == []


def test_replay_keeps_the_order_of_merges():
    rng = random.Random(1)
    for _ in range(60):
        found = [bytes([c]) for c in b"abc"]
        while len(found) < 22:
            new = rng.choice(found) + rng.choice(found)
            if new not in found and len(new) < 9:
                found.append(new)
        order = list(range(3, 22))
        rng.shuffle(order)
        table = {t: i for i, t in enumerate(found[:3])} | dict(zip(found[3:], order))
        words = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(40))) for _ in range(20)]
        for word, ids in zip(words, bpe.replay(words, bpe.Merges(table))):
            parts = [word[i : i + 1] for i in range(len(word))]
            while (best := min(((table.get(a + b, 99), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(99, 0)))[0] < 99:
                parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            want = b"".join(table[p].to_bytes(4, "little") for p in parts)
            assert ids == want
            assert b"".join(i.to_bytes(4, "little") for i in bpe.one_by_one(word, table)) == want
    with pytest.raises(KeyError):
        bpe.replay([b"z"], bpe.Merges({b"a": 0}))


def test_a_task_forgets_words_beyond_its_bound(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_BYTES", 10)
    merges = bpe.Merges(ranks)
    encoder, decoder = bpe.Encoder(merges, public_tokenizers.PATTERN), bpe.Decoder(ranks)
    for text in ("first words", "first other words", ""):
        assert decoder.decode(next(iter(encoder.encode([text])))) == text.encode()
    assert regex.findall(public_tokenizers.PATTERN, "") == []


def contaminated(texts, items, width):
    windows = defaultdict(set)
    for name, text in items:
        own = ALNUM.findall(lower(text or ""))
        for i in range(max(1, len(own) - width + 1) if own else 0):
            windows[tuple(own[i : i + width])].add(name)
    for key, text in texts:
        words = ALNUM.findall(lower(text or ""))
        hit, found = set(), set()
        for i in range(len(words)):
            for n in range(1, width + 1):
                names = windows.get(tuple(words[i : i + n])) if i + n <= len(words) else None
                if names:
                    hit |= set(range(i, i + n))
                    found |= names
        yield key, len(words), sorted(hit), sorted({str(f) for f in found if f is not None})


ITEMS = [(1, " ".join(f"word{i}" for i in range(20, 45))), (10, "the of"), (2, "x x x x x x x x x x x"), (3, None), (4, "..."),
         (None, "général"), (1, "n5 n6 n7 n8 n9 n10 n11 n12 n13 n14"), (5, "GNU General PUBLIC license")]


@pytest.mark.parametrize("block", [1_000_000, 5])
def test_decontamination(spark, docs, nothing, block):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.find(docs, bench, block_words=block).collect()
    got = [(r.doc_id, r.n_words, [i for s in r.spans for i in range(s.start, s.end)], r["items"]) for r in found]
    same(got, contaminated(awkward(), ITEMS, 10))
    for r in found:
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
    kept = decontaminate.decontaminated(docs, bench).collect()
    assert kept[0].__fields__ == docs.columns
    clean = {(k, t) for (k, t), c in zip(awkward(), contaminated(awkward(), ITEMS, 10)) if not c[2]}
    assert clean <= {(r.doc_id, r.text) for r in kept}
    assert not [k for k, _, hit, _ in contaminated([(r.doc_id, r.text) for r in kept], ITEMS, 10) if hit]
    assert decontaminate.find(nothing, bench).collect() == []
    assert decontaminate.find(docs, bench.limit(0)).where("size(spans) > 0").count() == 0


def test_columns_of_any_name_pass_through_decontamination(spark):
    docs = spark.createDataFrame([(1, "the of and more", 2.5, [1]), (2, None, None, None)], "doc_id long, text string, `my col` double, `a.b` array<int>")
    bench = spark.createDataFrame([(1, "the of")], "item_id long, text string")
    kept = decontaminate.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {(r.doc_id, r["my col"]) for r in kept.collect()} == {(1, 2.5), (2, None)}


def test_suffixes_and_ranks():
    import numpy as np

    rng = np.random.default_rng(0)
    for _ in range(20):
        runs = [rng.integers(1, 4, rng.integers(1, 40)).tolist() for _ in range(rng.integers(1, 5))]
        text = np.array([0, *(x for r in runs for x in [*r, 0])])
        zeros = np.flatnonzero(text == 0).tolist()
        key = [tuple((0, p) if text[p] == 0 else (1, text[p]) for p in range(i, next(z for z in zeros if z >= i) + 1)) for i in range(len(text))]
        assert decontaminate.suffix_array(text).tolist() == sorted(range(len(text)), key=key.__getitem__)
        index = decontaminate.Index(text, 4)
        for size in (1, 2, 5):
            pattern = np.zeros((1, 5), np.int64)
            pattern[0, 5 - size :] = rng.integers(1, 4, size)
            low, high = index.search(pattern, np.array([size]))
            got = sorted(index.locate(np.arange(low[0], high[0])).tolist())
            assert got == [i for i in range(len(text) - size + 1) if (text[i : i + size] == pattern[0, 5 - size :]).all()]


def test_exact_groups(docs, nothing):
    members = defaultdict(list)
    for key, text in awkward():
        members[NOT_SPACE.sub(lambda m: m[0], "".join(NOT_SPACE.findall(text or "")))].append((key, len(text or "")))
    want = []
    for norm, found in members.items():
        known = [(-n, k) for k, n in found if k is not None]
        keep = min(known)[1] if known else None
        want += [(k, keep, len(found), k == keep, sha(norm)) for k, _ in found]
    same([tuple(r) for r in exact.exact_groups(docs).collect()], want)
    assert exact.exact_groups(nothing).collect() == []


def test_licences(docs, nothing):
    templates = license.FURTHER | license.BASE
    got = {}
    for r in license.scan(docs).collect():
        got.setdefault((r.doc_id, r.n_words), []).append(r)
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.places)
    for key, text in awkward():
        words = ALNUM.findall(lower(text or ""))
        places = [(i, p, label) for p, label in templates.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        base = [(i, label) for i, p, label in places if p in license.BASE]
        r = got[(key, len(words))].pop()
        assert sorted((p.start, p.phrase, p.label) for p in r.places) == sorted(places)
        assert (r.n_base, r.first_word, r.last_word) == (
            len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in base}))
        assert r.labels == ",".join(sorted({label for *_, label in places}))
    assert license.scan(nothing).collect() == []


def repeated_words(texts, width):
    counts = Counter()
    split = [NOT_SPACE.findall(t or "") for _, t in texts]
    for words in split:
        counts.update(tuple(words[i : i + width]) for i in range(len(words) - width + 1))
    for (key, _), words in zip(texts, split):
        gone = {j for i in range(len(words) - width + 1) if counts[tuple(words[i : i + width])] > 1 for j in range(i, i + width)}
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        yield key, len(words), len(gone), sha(kept), kept


@pytest.mark.parametrize("width, first, part", [(35, 9, 1 << 12), (35, 9, 6 << 20), (6, 2, 1 << 12), (3, 3, 1 << 13), (2, 9, 1 << 13)])
def test_substrings(docs, nothing, width, first, part):
    got = substring.remove_repeated(docs, width, first, part_bytes=part)
    same([tuple(r) for r in got.collect()], repeated_words(awkward(), width))
    assert substring.remove_repeated(nothing, width, first).collect() == []


def linked(texts, percent, size):
    sets = {}
    for row, (key, text) in enumerate(texts):
        words = NOT_SPACE.findall(lower(text or ""))
        sets[row] = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
    top = {k: k for k, _ in texts if k is not None}

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    for a in sets:
        for b in sets:
            x, y = texts[a][0], texts[b][0]
            if a < b and x is not None and y is not None and sets[a] and sets[b]:
                if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    x, y = sorted((find(x), find(y)))
                    top[y] = x
    return [(k, len(sets[row]), find(k) if sets[row] and k is not None else k) for row, (k, _) in enumerate(texts)]


def near_copies():
    rng = random.Random(3)
    out = []
    for family in range(8):
        size = rng.choice([5, 8, 12, 40, 90, 200])
        base = [f"f{family}w{rng.randrange(5000)}" for _ in range(size)]
        for _ in range(25):
            if rng.random() < 0.6:
                base = list(base)  # drifts, so chains reach further than links
            own = list(base)
            for _ in range(rng.randrange(0, 3)):
                own[rng.randrange(len(own))] = f"e{rng.randrange(99)}"
            base = own if rng.random() < 0.3 else base
            out.append(" ".join(own))
    return [(i, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("percent, size, spread", [(85, 4, 1.3), (60, 2, 0.4)])
def test_jaccard_components(spark, nothing, percent, size, spread, monkeypatch):
    """At the smaller spread sets have too few parts at first, and the deal gets finer until all have enough."""
    monkeypatch.setattr(jaccard, "PACK", 300)
    texts = near_copies() + [(k + 1000 if k is not None else None, t) for k, t in awkward() if k != 41]
    frame = spark.createDataFrame(rows(texts), SCHEMA).repartition(4)
    same([tuple(r) for r in jaccard.link(frame, percent, size, spread=spread).collect()], linked(texts, percent, size))
    if percent == 85:
        assert jaccard.link(nothing, percent, size).collect() == []


def test_one_id_may_have_several_texts(spark):
    one, two = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    texts = [(1, " ".join(one)), (1, " ".join(two)), (2, " ".join([*one[:-1], "x"])), (3, " ".join([*two[:-1], "y"])), (9, "three other words here"),
             (9, "three other words here"), (None, " ".join(one)), (20, " ".join(two)), (30, "c " * 9), (30, None)]
    got = jaccard.link(spark.createDataFrame(rows(texts), SCHEMA).repartition(3), 85, 4)
    same([tuple(r) for r in got.collect()], linked(texts, 85, 4))


def test_small_sets_show_all_their_tokens():
    import numpy as np

    for percent in (50, 60, 70, 85):
        scheme = jaccard.Scheme(percent, 1.3)
        sizes = np.r_[np.arange(1, 80), 150, 400]
        rows_ = np.repeat(np.arange(len(sizes)), sizes)
        tokens = np.random.default_rng(0).integers(1, 1 << 63, len(rows_)).astype(np.uint64)
        own, prints, lacking = jaccard.Scheme(percent, 1.3, alone=True).fingerprints(rows_, tokens, len(sizes))
        assert lacking == 0 and len(own) == len(prints)
        assert scheme.parts.max() < 1 << 62 and (scheme.needed >= 1).all()
        if percent >= 80:
            assert not scheme.alone[3:-1].any()


def test_the_deal_is_known_before_anything_is_shuffled(spark, monkeypatch):
    """Fingerprints are made, and shuffled, in one deal only, however many are too coarse."""
    import numpy as np

    made, plain = [], jaccard._shown
    monkeypatch.setattr(jaccard, "_shown", lambda *args: made.append(args[2]) or plain(*args))
    texts = near_copies()
    same([tuple(r) for r in jaccard.link(spark.createDataFrame(rows(texts), SCHEMA), 80, 5, spread=0.4).collect()], linked(texts, 80, 5))
    assert len(made) == 1

    sizes = np.r_[0, np.arange(1, 300), 0, 4000]
    rows_ = np.repeat(np.arange(len(sizes)), sizes)
    tokens = np.random.default_rng(1).integers(1, 1 << 63, len(rows_)).astype(np.uint64)
    few = []
    for scheme in jaccard._schemes(80, 0.4):
        enough = scheme.enough(rows_, tokens, len(sizes))
        few.append(int((~enough).sum()))
        assert enough.all() == (scheme.fingerprints(rows_, tokens, len(sizes))[2] == 0)
    assert few[0] > 0 and few[-1] == 0


def test_a_stored_table_leaves_no_shuffle_files(spark):
    frame = spark.range(20000).select((F.col("id") % 5000).alias("k"), "id").groupBy("k").agg(F.max("id").alias("id"))
    base = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", tempfile.gettempdir())
    files = lambda: {f for d in base.split(",") for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
    frame.count()
    before = files()
    assert before
    kept = components.cut(frame)
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    same([tuple(r) for r in kept.collect()], [(k, 15000 + k) for k in range(5000)])
    assert spark.conf.get(components.CLEANUP, None) is None


def test_one_of_each_group_stays(spark):
    texts = [*near_copies(), (None, "one"), (None, "one"), (7000, None), (7001, "")]
    frame = spark.createDataFrame(rows(texts), SCHEMA)
    want = {k for k, _, c in linked(texts, 80, 5) if k == c}
    got = jaccard.one_each(frame, 80, 5)
    assert got.columns == frame.columns
    assert sorted(map(repr, (r.doc_id for r in got.collect()))) == sorted(map(repr, [*(want - {None}), None, None]))


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(900 + i, 901 + i) for i in range(40)] + [(2000, 2000), (None, 3)]
    top = {}
    for a, b in edges:
        if a is None:
            continue
        top.setdefault(a, a), top.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a is not None and top[a] != top[b]:
                top[a] = top[b] = min(top[a], top[b])
                changed = True
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted(top.items())
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def order_of(key, text):
    """Null keys first, then by key; rows with one key by the digest of key and text."""
    return (key is not None, key or 0, hashlib.md5(f"{'' if key is None else key}:{text or ''}".encode()).digest())


def cut_lines(texts, roll, divisor):
    """Chunks from the same rolling hash, compared as strings; lines grown and held by the docstring's rule."""
    import numpy as np

    from accesslens.llm import arrays

    split, chunks, keeper = {}, {}, {}
    for key, text in texts:
        row, own = order_of(key, text), (text or "").split("\n")
        data = np.frombuffer((text or "").encode(), np.uint8)
        starts, ends, _ = lines.lines_of(data, np.array([0, len(data)]))
        last = np.flatnonzero(lines.chunk_ends(arrays.word_hashes(data, starts, ends), np.zeros(len(own), int), roll, divisor))
        split[row], chunks[row] = own, [(b, e + 1) for b, e in zip([0, *(last[:-1] + 1)], last)]
        assert len(own) == 1 or all(e - b > 1 for b, e in chunks[row])
    places = defaultdict(list)
    for row in sorted(split):
        for b, e in chunks[row]:
            body = "\n".join(split[row][b:e])
            if e - b > 1 and NOT_SPACE.search(body):
                places[body].append((row, b))
    counts = Counter("\n".join(split[order_of(k, t)][b:e]) for k, t in texts for b, e in chunks[order_of(k, t)])
    marked = {p: (found[0] == p) for body, found in places.items() if counts[body] > 1 for p in found}

    def around(row, i, step, keeper):
        """Lines of the chunk next to chunk i, from it away."""
        if not 0 <= i + step < len(chunks[row]):
            return []
        b, e = chunks[row][i + step]
        if (row, b) in marked and not (keeper and marked[row, b]):
            return []
        return split[row][b:e][::step]

    goes, held = defaultdict(list), defaultdict(set)
    for body, found in places.items():
        if counts[body] > 1:
            kr, kb = found[0]
            ki = [b for b, _ in chunks[kr]].index(kb)
            ke = chunks[kr][ki][1]
            held[kr] |= set(range(kb, ke))
            for row, b in found[1:]:
                i = [x for x, _ in chunks[row]].index(b)
                grow = []
                for step in (-1, 1):
                    n = 0
                    for x, y in zip(around(row, i, step, False), around(kr, ki, step, True)):
                        if x != y:
                            break
                        n += 1
                    grow.append(n)
                goes[row].append((b, chunks[row][i][1], *grow))
                held[kr] |= set(range(kb - grow[0], ke + grow[1]))
    for key, text in texts:
        row = order_of(key, text)
        gone = set()
        for b, e, up, down in goes[row]:
            gone |= set(range(b, e))
            for start, step, n in ((b - 1, -1, up), (e, 1, down)):
                for j in range(start, start + step * n, step):
                    if j in held[row]:
                        break
                    gone.add(j)
        assert not gone & held[row]
        yield key, "\n".join(x for j, x in enumerate(split[row]) if j not in gone), len(split[row]), len(gone)


def nothing_is_lost(texts, got):
    """Every line that went still stands beside the same neighbour in some text. Knows nothing of chunks."""
    left = Counter(pair for r in got for pair in zip(r.kept.split("\n"), r.kept.split("\n")[1:]))
    kept = defaultdict(list)
    for r in got:
        kept[r.doc_id, r.n_lines].append(r.kept.split("\n"))
    for key, text in texts:
        own = (text or "").split("\n")
        rest = Counter(own)
        rest.subtract(max(kept[key, len(own)], key=lambda k: sum((Counter(k) & Counter(own)).values())))
        for line in +rest:
            assert any(left[p] for i, x in enumerate(own) if x == line for p in (tuple(own[i : i + 2]), tuple(own[max(i - 1, 0) : i + 1])) if len(p) == 2), (key, line)


@pytest.mark.parametrize("divisor", [4, 2])
def test_line_chunks(docs, nothing, divisor):
    got = lines.remove_repeated(docs, divisor=divisor).collect()
    want = list(cut_lines(awkward(), lines.ROLL, divisor))
    same([tuple(r) for r in got], want)
    nothing_is_lost(awkward(), got)
    assert sum(r.n_removed for r in got) > 10
    kept = lines.cleaned(docs, divisor=divisor)
    assert kept.columns == docs.columns
    untouched = {(k, t) for (k, t), w in zip(awkward(), want) if w[3] == 0}
    assert untouched <= {(r.doc_id, r.text) for r in kept.collect()}
    assert lines.remove_repeated(nothing).collect() == []


def test_a_pair_that_stands_elsewhere_is_kept_once(spark):
    texts = [(1, "Beta\nAlpha"), (2, "Alpha\nBeta\nAlpha"), (3, "Alpha\nBeta")]
    got = lines.remove_repeated(spark.createDataFrame(rows(texts), SCHEMA)).collect()
    nothing_is_lost(texts, got)
    assert any("Alpha\nBeta" in r.kept for r in got) and any("Beta\nAlpha" in r.kept for r in got)


def test_repeated_blocks_go_with_their_borders(spark, monkeypatch):
    monkeypatch.setattr(lines, "SALT_ROWS", 7)
    rng = random.Random(7)
    blocks = [[f"block {b} line {i} {rng.random()}" for i in range(rng.choice([2, 3, 6, 9, 20]))] for b in range(12)]
    texts = [(1, "x\n" * 50), (2, "y\nx\nx\nz"), (3, "y\ny\ny"), (4, None), (5, "a\n\n\n\n\nb"), (6, "\n\n\n"), (8, "y\nx"), (9, "c d\na b\na b")]
    for key in range(10, 90):
        own = [f"own {key} {i}" for i in range(rng.randrange(5))]
        for block in rng.sample(blocks, 2):
            cut = rng.randrange(len(block) - 1)
            own += [*block[cut:], f"own {key}"] if rng.random() < 0.4 else [*block, *block[:1] * rng.randrange(5)]
        texts.append((key, "\n".join(own)))
    texts += [(None, "\n".join(blocks[0])), (100, "head\na\n\n\n\n\nb\ntail"), (11, "\n".join(blocks[1])), (11, "\n".join(blocks[1]))]
    frame = spark.createDataFrame(rows(texts), SCHEMA).repartition(4)
    got = lines.remove_repeated(frame).collect()
    same([tuple(r) for r in got], cut_lines(texts, lines.ROLL, lines.DIVISOR))
    nothing_is_lost(texts, got)
    for block in blocks:  # no block is left whole twice where it was long enough for a chunk of its own
        assert sum("\n".join(block) in r.kept for r in got) >= 1
    assert sum(r.n_removed for r in got) > 400


def test_borders_move_with_the_lines():
    import numpy as np

    rng = np.random.default_rng(1)
    hashes = rng.integers(1, 1 << 64, 400, np.uint64)
    plain = lines.chunk_ends(hashes, np.zeros(400, int), 2, 4)
    moved = lines.chunk_ends(np.r_[rng.integers(1, 1 << 64, 3, np.uint64), hashes], np.zeros(403, int), 2, 4)
    assert (plain[2:] == moved[5:]).all()
    assert np.diff(np.flatnonzero(np.r_[True, plain])).min() > 1
