import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from docmill.llm.sentencepiece_codec import MARK, CharacterMap, OffsetCodec, codec, encode_documents, encoding_digests

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ODD = ["", " ", "  ", " a", "a ", "a  b   c\n\n\td", "日本語 テキスト🙂🙂", "▁x ▁▁ y", "\x00x", "<s> </s> <unk> <0x41>", "é" * 100, "   leading", "�", "a　b", "▁", "x" * 3000]


def agrees(text):
    c = codec(MODEL)
    ids, begins, ends = c.encode_spans(text)
    assert ids == LIBRARY.encode(text)
    assert c.decode([*ids, c.eos]) == LIBRARY.decode([*ids, c.eos])
    size = len(text.encode())
    assert [0, *ends] == [*begins, size] if ids else size == 0
    normal, source = c.normalize(text)
    whole = c.segment(MARK + normal.replace(" ", MARK)) if text else []
    edges = source[np.cumsum([0, *(n for _, n in whole)])].tolist() if text else [0]
    assert [i for i, _ in whole] == ids and edges == ([begins[0], *ends] if ids else [0])


def test_odd_texts_equal_the_library():
    for text in ODD:
        agrees(text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab eé▁ \n日🙂th"), max_size=60))
def test_any_text_equals_the_library(text):
    agrees(text)


def test_digests_and_spans(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    got = sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in encoding_digests(docs, MODEL).collect())
    want = []
    for i, t in odd_rows:
        ids = LIBRARY.encode(t or "", add_eos=True)
        want.append((i or -1, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()))
    assert got == sorted(want)
    for r in encode_documents(docs, MODEL).where("doc_id = 8").collect():
        raw = "日本語 テキスト 🙂".encode()
        assert b"".join(raw[b:e] for b, e in zip(r["begins"], r["ends"])) == raw
    assert encoding_digests(make_docs([]), MODEL).collect() == []


def _double_array(keys):
    """A small trie in the double-array form, placed greedily."""
    units, used, bases = [0] * 4096, {0}, set()

    def place(node, entries, depth):
        groups = {}
        for key, value in entries:
            groups.setdefault(key[depth] if depth < len(key) else 0, []).append((key, value))
        base = next(b for b in range(1, 3000) if b not in bases and all((b ^ c) not in used for c in groups))
        bases.add(base)
        used.update(base ^ c for c in groups)
        units[node] |= (node ^ base) << 10
        for c, part in groups.items():
            if c == 0:
                units[node] |= 1 << 8
                units[base ^ 0] = part[0][1] | (1 << 31)
            else:
                units[base ^ c] |= c
                place(base ^ c, part, depth + 1)

    place(0, keys, 0)
    return units


def test_longest_prefix_of_a_compiled_map():
    replaced = b"X\0YY\0 \0"
    units = _double_array([(b"ab", 0), (b"abc", 2), ("ｱ".encode(), 5)])
    blob = struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + replaced
    m = CharacterMap(blob)
    length, value = m.longest(b"zabcdab")
    assert length.tolist() == [0, 3, 0, 0, 0, 2, 0] and m.replacement(int(value[1])) == b"YY" and m.replacement(int(value[5])) == b"X"
    c = OffsetCodec(MODEL)
    c.map = m
    normal, source = c.normalize("qabcｱ!")
    assert normal == "qYY !" and source.tolist() == [0, 0, 0, 0, 1, 1, 4, 4, 4, 7, 8]
    ids, begins, ends = c.encode_spans("qabcｱ!")
    assert ids == LIBRARY.encode("qYY !") and begins[0] == 0 and ends[-1] == 8 and begins[1:] == ends[:-1]
    assert "".join(LIBRARY.id_to_piece(i) for i in ids) == "▁qYY▁!"


def test_merging_in_batches_equals_the_library():
    rng = random.Random(3)
    parts = ["the", "ing", "Er", "tion", "é", "日本", "🙂", "x", "zz", "q", "ß", "0", "▁", "ther", "  ", "\n"]
    words = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(3000)] + ["x" * 64, "y" * 65, "ab" * 500]
    words = [w.replace(" ", "").replace("▁", "") or "a" for w in words]
    got = codec(MODEL)._merges.ids_of(["▁" + w for w in words], rows=700)
    assert all(np.frombuffer(g, "<u4").tolist() == LIBRARY.encode(w) for g, w in zip(got, words))


def test_squeezed_text_keeps_its_source():
    c = OffsetCodec(MODEL)
    c.squeeze = True
    ids, begins, ends = c.encode_spans("  a   bc ")
    assert ids == LIBRARY.encode("a bc") and begins[0] == 2 and ends[-1] == 9
    assert c.encode_spans("   ") == ([], [], [])
