"""Cross-tokenizer alignment against whole texts, tokenized and compared token by token."""

import hashlib
import json
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pytest

from accesslens.llm import align
from tests.llm.cases import SCHEMA, awkward, rows

ODD = ["  ", "\n", "x \n  y\t\tz", "foo   bar　 baz", "é\x85 \x1c q", "▁ a", "a ▁b", " lead", "trail ", "trail  \n", " \n a",
       "<s> </s> <|endoftext|> <0x0A>", "\x00 b\x00", "ﬁ ①", "日本語 テスト　全角", "a;\r\nb \r c();\r", "'s 's don't  'll",
       "!" * 300, " " * 40 + "x", "\t x"]


@pytest.fixture(scope="module")
def files():
    return align.read_file("byte_bpe_50k.json"), align.read_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def ranks(files):
    return align.merge_ranks(files[0])


@pytest.fixture(scope="module")
def pair(files):
    return align.Pair(*files)


def test_ranks_stand_for_merges_only_if_they_are_the_same(files, ranks):
    assert len(ranks) == 50256
    made = json.loads(files[0])
    merges = made["model"]["merges"]
    made["model"]["merges"] = [merges[1], merges[0], *merges[2:]]
    assert align.merge_ranks(json.dumps(made).encode()) is None
    made["normalizer"] = {"type": "NFC"}
    assert align.merge_ranks(json.dumps(made).encode()) is None


def tokens(pair, text):
    """Ids and byte ranges of both, or nothing."""
    raw = (" " + (text or "")).encode()
    out = []
    for ids, names in ((pair.a.encode(" " + (text or ""), add_special_tokens=False).ids, pair.a_bytes), (pair.b.encode(text or ""), pair.b_bytes)):
        spans, at = [], 0
        for i in ids:
            spans.append((i, at, at + len(names[i])))
            at += len(names[i])
        if not text or b"".join(names[i] for i in ids) != raw:
            return [], []
        out.append(spans)
    return out


def brute(pair, texts):
    found = {}
    for row, (_, text) in enumerate(texts):
        a, b = tokens(pair, text)
        links, first = [], 0
        for x, begin, end in a:
            while first < len(b) and b[first][2] <= begin:
                first += 1
            links += [(x, y) for y, low, high in b[first : first + end - begin + 1] if low < end and begin < high]
        common = sorted({e for *_, e in a} & {e for *_, e in b})
        sides = [defaultdict(list), defaultdict(list)]
        for side, spans in zip(sides, (a, b)):
            for i, _, e in spans:
                side[bisect_left(common, e)].append(str(i))
        groups = ["|".join(",".join(side[g]) for side in sides) for g in range(len(common))]
        found[row] = (len(a), len(b), links, groups)
    counts = Counter(link for *_, links, _ in found.values() for link in links)
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    for row, (key, _) in enumerate(texts):
        n_a, n_b, links, groups = found[row]
        yield (key, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), ";".join(groups))


def test_chunks_are_cut_where_neither_tokenizer_joins(files, pair, ranks):
    fast = align.Pair(*files, ranks)
    rng = random.Random(1)
    texts = [t for t in [*ODD, *(t for _, t in awkward())] if t]
    texts += ["".join(rng.choice(["a", "the", " ", "  ", "\n", "\t", "\r", ";", " ", "'s", "9", "　", "é", "\x1c"]) for _ in range(60)) for _ in range(400)]
    for text in texts:
        found = pair.chunks(text)
        assert "".join(found) == " " + text
        for one in (pair, fast):
            assert [i for ids in one.encode_a(found) for i in ids] == pair.a.encode(" " + text, add_special_tokens=False).ids
        ids = [i for ids in pair.encode_b(found) for i in ids]
        raw = (" " + text).encode()
        whole = b"".join(pair.b_bytes[i] for i in pair.b.encode(text)) == raw
        assert (ids == pair.b.encode(text)) if whole else (-1 in ids or b"".join(pair.b_bytes[i] for i in ids) != raw)


@pytest.mark.parametrize("fan, kept, pack", [(64, 96 << 20, 32 << 20), (3, 30000, 20000)])
def test_alignment(spark, files, pair, monkeypatch, fan, kept, pack):
    """The second case merges in several levels, forgets chunks and sends several packs."""
    monkeypatch.setattr(align, "KEPT_BYTES", kept)
    texts = [*awkward(), *((200 + i, t) for i, t in enumerate(ODD)), (None, "a null key"), (7, "one id"), (7, "another text")]
    frame = spark.createDataFrame(rows(texts), SCHEMA).repartition(7)
    want = list(brute(pair, texts))
    got = [tuple(r) for r in align.align(frame, *files, fan=fan, pack_bytes=pack, spelled=True).collect()]
    assert Counter(got) == Counter(want)
    digests = align.align(frame, *files, fan=fan, pack_bytes=pack).select("doc_id", "groups_sha256").collect()
    assert Counter(map(tuple, digests)) == Counter((w[0], hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "") for w in want)
    assert align.align(frame.limit(0), *files).collect() == []


def test_perfect_hash():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000):
        keys = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
        own = align.PerfectHash.load(align.PerfectHash.of(keys).dump())
        assert sorted(own.numbers(keys).tolist()) == list(range(len(keys)))


def test_unknown_pairs_are_refused(spark):
    keys = np.array([5 << 32 | 3, 9 << 32 | 1])
    slots = align.slot_of(keys)
    table = spark.createDataFrame([
        (int(s), align.PerfectHash.of(keys[i : i + 1]).dump(), keys[i : i + 1].tobytes(), np.array([7 + i]).tobytes()) for i, s in enumerate(slots)],
        "slot int, hash binary, keys binary, counts binary")
    known = align.Counts(spark, table)
    assert known.of(keys[::-1].copy()).tolist() == [8, 7]
    with pytest.raises(KeyError):
        known.of(np.array([5 << 32 | 4]))
