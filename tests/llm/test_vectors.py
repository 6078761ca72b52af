import numpy as np
import pytest

from docmill.llm import ann, embedding_dedup

KIND = "vec_id long, embedding array<float>, label int, id string, vec string, bucket string, links string, cell string"
NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], k, *["x"] * 5) for i, v, k in rows], KIND).repartition(4)


def clusters(dim=16, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(12):
        centre = rng.standard_normal(dim)
        for _ in range(12):
            rows.append((len(rows) * 3, np.float32(centre + 0.27 * rng.standard_normal(dim)), c % 3))
    rows += [(len(rows) * 3 + i, rng.standard_normal(dim).astype(np.float32), i % 3) for i in range(60)]
    rows += [(5000 + i, rows[4][1], rows[4][2]) for i in range(50)]  # copies
    odd = [None, [0.0] * dim, [NAN] + [1.0] * (dim - 1), [INF] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), []]
    rows += [(7000 + i, v, 1) for i, v in enumerate(odd)] + [(7100, rows[4][1], None), (7101, [1.0, 0.0], 1), (7102, [2.0, 0.1], 1)]
    return rows


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(c != 0 for c in v)


def brute_links(rows, threshold):
    n = len(rows)
    links = [set() for _ in range(n)]
    for a in range(n):
        for b in range(a):
            (_, x, k), (_, y, m) = rows[a], rows[b]
            if k is not None and k == m and usable(x) and usable(y) and len(x) == len(y):
                x, y = np.array(x, float), np.array(y, float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    best = [r[0] for r in rows]
    for _ in range(n):
        new = [min([best[a], *(best[b] for b in links[a])]) for a in range(n)]
        if new == best:
            break
        best = new
    return {rows[a][0]: (len(links[a]), best[a], best[a] == rows[a][0]) for a in range(n)}


@pytest.mark.parametrize("sizes", [(2000, 4096), (15, 20), (4, 30)])
def test_links_match_brute_force(spark, monkeypatch, sizes):
    """The second sizes make many lists, probes and slices."""
    monkeypatch.setattr(embedding_dedup, "LIST_ROWS", sizes[0])
    monkeypatch.setattr(embedding_dedup, "SLICE", sizes[1])
    if sizes[0] == 4:
        monkeypatch.setattr(embedding_dedup, "PROBE_RECALL", 1.0)
    rows = clusters()
    got = embedding_dedup.near_duplicates(table(spark, rows), 0.93).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == brute_links(rows, 0.93) and len(got) == len(rows)


def test_pairs_at_the_threshold_are_decided_exactly(spark, monkeypatch):
    """With a large rounding error every comparison near the threshold is open and made again from the original vectors."""
    rint = np.rint
    monkeypatch.setattr(embedding_dedup.np, "rint", lambda x: rint(x / 4096) * 4096)
    rows = [r for r in clusters(seed=3) if r[0] < 5000]
    got = embedding_dedup.near_duplicates(table(spark, rows), 0.93).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == brute_links(rows, 0.93)


def test_chain_and_hot_label(spark, monkeypatch):
    """A chain of 400 vectors of one label along an arc beside a label that holds most rows."""
    monkeypatch.setattr(embedding_dedup, "SLICE", 100)
    chain = [(3 * k, [np.cos(0.01 * k), np.sin(0.01 * k), 0.0], 1) for k in range(400)]
    hot = [(10_000 + k, v, 2) for k, v in enumerate(np.random.default_rng(1).standard_normal((900, 16)))]
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(table(spark, chain + hot), 0.93).collect()}
    want = brute_links(chain, 0.93)
    assert all((got[i]["n_links"], got[i]["component_id"]) == want[i][:2] for i, _, _ in chain) and {got[i]["component_id"] for i, _, _ in chain} == {0}
    assert all(got[i]["component_id"] == i for i, _, _ in hot if got[i]["n_links"] == 0)


def test_repeated_ids_with_unlike_vectors_stay_apart(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.01], 0), (3, [0.01, 1.0], 0)]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(table(spark, rows), 0.93).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]


def test_no_rows_and_null_ids(spark):
    assert embedding_dedup.near_duplicates(table(spark, [])).collect() == []
    got = embedding_dedup.near_duplicates(table(spark, [(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (2, [1.0, 0.001], 1)])).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got} == {(None, 0, None, True), (4, 1, 2, False), (2, 1, 2, True)}


def brute_nearest(rows, every, k):
    good = [(i, np.array(v, float)) for i, v, _ in rows if usable(v) and len(v) == 16]
    out = {}
    for q, x in good:
        if q % every == 0:
            score = sorted((-float((x * y).sum()), i) for i, y in good if i != q)[:k]
            out[q] = [(i, -s) for s, i in score]
    return out


def test_nearest_are_whole_and_exact(spark):
    rows = clusters()
    want = brute_nearest(rows, 20, 20)
    got = {}
    for r in sorted(ann.search(table(spark, rows)).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hit = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert hit >= 0.9
    vectors = {i: np.array(v, float) for i, v, _ in rows if usable(v)}
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (-x[1], x[0])) and all(s == pytest.approx(vectors[q] @ vectors[i]) for i, s in found)
    assert [i for i, _ in got[5000]] == sorted(i for i, v, k in rows if (i >= 5000 or i == 12) and i != 5000 and usable(v) and len(v) == 16 and np.array_equal(v, rows[4][1]))[:20]


@pytest.mark.parametrize("n", [0, 1, 2, 15])
def test_few_candidates_are_all_returned(spark, n):
    rng = np.random.default_rng(n)
    rows = [(20 * i, rng.standard_normal(16) * (i + 1), 0) for i in range(n)]
    got = ann.search(table(spark, rows)).collect()
    want = brute_nearest([(i, np.float32(v), k) for i, v, k in rows], 20, 20)
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == sorted((q, k + 1, i) for q, found in want.items() for k, (i, _) in enumerate(found))


def recall(got, want):
    return sum((r["query_id"], r["vec_id"]) in {(q, i) for q, f in want.items() for i, _ in f} for r in got) / sum(map(len, want.values()))


@pytest.mark.parametrize("sizes", [(10, 20_000), (20_000, 3), (15, 4)])
def test_slices_of_buckets_and_of_queries_lose_nothing(spark, monkeypatch, sizes):
    monkeypatch.setattr(ann, "SLICE", sizes[0])
    monkeypatch.setattr(ann, "QUERY_ROWS", sizes[1])
    monkeypatch.setattr(ann, "LEAST_PARTS", 5)
    monkeypatch.setattr(ann, "RECALL", 1.0)
    rows = [(i - i % 4, v, k) for i, v, k in clusters() if i < 5000]
    rows = list({i: (i, v, k) for i, v, k in rows}.values()) + [(None, rows[0][1], 1)]
    want = brute_nearest([r for r in rows if r[0] is not None], 20, 20)
    got = ann.search(table(spark, rows)).collect()
    assert len(got) == sum(map(len, want.values())) and recall(got, want) >= 0.97


def test_bucket_numbers_are_unique():
    cells = np.array(np.meshgrid(*[np.arange(-5, 6)] * 4)).reshape(4, -1).T
    numbers = ann.Hashes._numbers(np.repeat(cells[:, None], ann.TABLES, axis=1))
    assert len(np.unique(numbers)) == numbers.size
    assert ann.functions_for(10) == ann.LEAST_FUNCTIONS and ann.functions_for(10**12) == ann.MOST_FUNCTIONS
    assert len(np.unique(ann.Hashes._numbers(np.repeat(np.eye(8)[:, None], ann.TABLES, axis=1)))) == 8 * ann.TABLES


def test_each_length_is_searched_among_itself(spark):
    rows = [(20 * i, [float(i + 1), 1.0], 0) for i in range(3)] + [(20 * i + 10, [1.0, 2.0, float(i + 1)], 0) for i in range(1, 40)]
    got = {(r["query_id"], r["vec_id"]) for r in ann.search(table(spark, rows), every=10).collect()}
    assert {(q, i) for q, i in got if q % 20 == 0} == {(20 * a, 20 * b) for a in range(3) for b in range(3) if a != b}
    assert all(q % 20 == i % 20 for q, i in got) and len([1 for q, _ in got if q % 20]) == 39 * 20
