import zlib

import pytest

from docmill.llm.sharding import shard_documents


def check(rows, got, n):
    sizes = {k: len((t or "").encode()) + 8 for k, (_, t) in enumerate(rows)}
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == sorted(
        (i is not None, i or 0, sizes[k], zlib.crc32((t or "").encode())) for k, (i, t) in enumerate(rows)
    )
    total, most = sum(sizes.values()), max(sizes.values(), default=0)
    last = None
    for s in range(n):
        part = sorted((r for r in got if r["shard"] == s), key=lambda r: r["slot"])
        assert [r["slot"] for r in part] == list(range(len(part)))
        assert abs(sum(r["size"] for r in part) - total / n) <= most
        for r in part:  # contiguous in the order of ids, nulls first
            key = (r["doc_id"] is not None, r["doc_id"] or 0)
            assert last is None or last <= key
            last = key


@pytest.mark.parametrize("n", [1, 3, 24])
def test_equal_bytes_in_order(make_docs, odd_rows, n):
    got = shard_documents(make_docs(odd_rows), n).collect()
    check(odd_rows, got, n)
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


def test_many_rows(make_docs):
    rows = [(i * 7 % 500, "t" * (i % 40)) for i in range(1000)]
    check(rows, shard_documents(make_docs(rows), 24).collect(), 24)


def test_empty_table_and_bad_number(make_docs):
    assert shard_documents(make_docs([])).collect() == []
    with pytest.raises(ValueError):
        shard_documents(make_docs([]), 0)
