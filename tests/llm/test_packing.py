import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docmill.llm.packing import ByteTokenizer, cut, pack_documents, plan

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(FILE)


def test_ids_equal_the_library():
    own = ByteTokenizer(FILE)
    rng = random.Random(1)
    texts = ["", " ", "  a  b\n\n c\t\td ", "日本語 テキスト🙂", "\x1c a \x85b", "<|endoftext|> x", "it's they'll I'M 12345 ½²Ⅷ a_b__c", " x　 y", "x" * 5000, "a \n b"]
    texts += ["".join(rng.choice("ab '1\n\t é🙂_") for _ in range(60)) for _ in range(300)]
    for text in texts:
        assert own.ids(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, text


def test_mixed_and_long_texts_equal_the_library():
    own = ByteTokenizer(FILE)
    rng = random.Random(4)
    parts = ["the", " a", "'t", "don't", " 12", "é", "日本", "🙂", "\n", "  ", ".", "(x)", " _", "\u3000", "\xa0", "x" * 80, " " + "y" * 100]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 40))) for _ in range(600)]
    texts += ["ab" * 50_000, " " * 30_000 + "a", "\n" * 20_000, " ".join(["word"] * 100_000)]
    assert all(own.ids(t).tolist() == LIBRARY.encode(t, add_special_tokens=False).ids for t in texts)


def test_cut():
    assert cut(5, 4) == [(0, 1), (1, 4)] and cut(4, 4) == [(0, 4)] and cut(3, 4) == [(0, 3)] and cut(8, 4) == [(0, 4), (4, 4)]


def test_plans_are_whole_and_tight():
    rng = np.random.default_rng(1)
    for _ in range(200):
        cap = int(rng.integers(5, 60))
        h = collections.Counter(rng.integers(1, cap + 1, rng.integers(1, 80)).tolist())
        bins, ranks = collections.defaultdict(list), collections.defaultdict(set)
        for length, rank, count, first, offset in plan(dict(h), cap):
            for k in range(count):
                bins[first + k].append((offset, length))
                ranks[length].add(rank + k)
        assert all(ranks[n] == set(range(c)) for n, c in h.items())
        for items in bins.values():
            at = 0
            for offset, length in sorted(items):
                assert offset == at
                at += length
            assert at <= cap and sum(3 * length > cap for _, length in items) <= 2
        assert len(bins) <= 1.5 * -(-sum(n * c for n, c in h.items()) // cap) + 1


@pytest.mark.parametrize("capacity", [2048, 64])
def test_every_token_is_placed_once(make_docs, odd_rows, capacity):
    rng = random.Random(3)
    rows = odd_rows + [(100 + i, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(1, 90)))) for i in range(150)]
    got = pack_documents(make_docs(rows), FILE, capacity).collect()
    want = collections.Counter()
    for i, t in rows:
        ids = np.array([*LIBRARY.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for n, (s, size) in enumerate(cut(len(ids), capacity)):
            want[i, n, s, size, zlib.crc32(ids[s : s + size].tobytes())] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) <= 1.1 * sum(r["length"] for r in got) / capacity + 1


def test_hot_length_over_many_parts(spark):
    """A third of the rows are alike, and some are cut, over 211 parts."""
    docs = spark.createDataFrame([(i, "same text" if i % 3 == 0 else "w " * (i % 7000 if i % 90 == 1 else i % 40)) for i in range(3000)], "doc_id long, text string").repartition(211)
    got = pack_documents(docs, FILE, 256).collect()
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in bins.values():
        ends = np.cumsum([n for _, n in sorted(items)])
        assert [o for o, _ in sorted(items)] == [0, *ends[:-1]] and ends[-1] <= 256
    assert {r["doc_id"] for r in got} == set(range(3000)) and len(bins) <= 1.05 * sum(r["length"] for r in got) / 256 + 1


def test_empty(make_docs):
    assert pack_documents(make_docs([]), FILE).collect() == []
