import random

import corpus_pipeline
from docmill.llm import queries as training


def test_stages_are_whole(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs.withColumn("node", docs.doc_id), sf_dir), name)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        now = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert len(now) == len(set(now)) and set(now) <= seen
        seen = set(now)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == seen


def _write(spark, tmp_path, rows, labels):
    kind = "doc_id long, text string, lang string, source string, n_chars long, node string"
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x") for i, t in rows], kind).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_run_on_an_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, _write(spark, tmp_path, [], [])).collect() == []


def test_run_equals_brute_force(spark, tmp_path, odd_rows):
    """Nulls, empty and very long texts, repeats, copies, near copies, toxic and poor texts; near duplicates by their definition."""
    rng = random.Random(3)
    vocabulary = [f"{a}{b}{c}" for a in ("ta", "re", "mo", "li") for b in ("ben", "dor", "kin", "pas") for c in ("a", "o", "un", "el")]
    rows, labels = [], []
    for k in range(300):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(30, 90))]
        toxic, good = k % 4 == 0, k % 5 != 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["zonkfool", "zonkhead", "grubface"])
        text = " ".join(words if good else [w.upper() + "!!" for w in words])
        rows.append((1000 + k, text))
        labels.append((1000 + k, int(good), int(toxic)))
    clean = [t for (_, t), (_, g, x) in zip(rows, labels) if g and not x][:20]
    rows += [(3000 + k, t) for k, t in enumerate(clean)] + [(4000 + k, t + " moreover") for k, t in enumerate(clean)]
    rows += odd_rows
    got = corpus_pipeline.run(spark, _write(spark, tmp_path, rows, labels)).collect()
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = corpus_pipeline.drop_poor(spark, corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)), str(tmp_path)).collect()
    sets = [frozenset(zip(*(w[i:] for i in range(5)))) or (frozenset([tuple(w)]) if w else frozenset()) for w in ((r["text"] or "").lower().split() for r in left)]
    root = list(range(len(left)))
    for i in range(len(left)):
        for j in range(i):
            near = sets[i] == sets[j] or (sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8)
            if near and left[i]["doc_id"] is not None and left[j]["doc_id"] is not None:
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    want = {}
    for i, r in enumerate(left):
        if r["doc_id"] is not None:
            want[root[i]] = min(want.get(root[i], r["doc_id"]), r["doc_id"])
    known = [r["doc_id"] for r in got if r["doc_id"] is not None and r["piece"] == 0]
    assert sorted(known) == sorted(want.values()) and len(known) > 100
    assert sum(r["doc_id"] is None and r["piece"] == 0 for r in got) == sum(r["doc_id"] is None for r in left)
    assert not {3000 + k for k in range(20)} & set(known) and not {4000 + k for k in range(20)} & set(known)


def test_one_of_each_group_of_copies_stays(spark, make_docs, odd_rows, sf_dir):
    kept = [r["doc_id"] for r in corpus_pipeline.keep_one_copy(spark, make_docs(odd_rows), sf_dir).collect()]
    # 1, 2 and 9 differ in case only; 3, 4 and 5 have no words; rows without an id stay.
    assert sorted(k for k in kept if k is not None) == [1, 3, 6, 7, 8] and kept.count(None) == 2


def test_registered(spark):
    names = training.queries()
    assert [n for n in names if n != "pipeline"] == sorted((n for n in names if n != "pipeline"), key=lambda n: int(n[2:].split("_")[0])) and len(names) == 11
    assert set(training.oracle_sql()) <= set(names)


def test_unlike_texts_under_one_id_both_stay(spark, make_docs, sf_dir):
    one, two = (" ".join(f"{p}{i}" for i in range(100)) for p in "ab")
    rows = [(1, one), (1, two), (5, two + " end"), (5, one + " end"), (1, one), (7, two)]
    kept = corpus_pipeline.keep_one_copy(spark, make_docs(rows), sf_dir)
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, one), (1, two)]
