"""Readers, writers and incremental runs on small folders."""

import json

import pytest
from pyspark.sql import functions as F

from docmill.operators import dataset, semantics
from docmill.schemas import CANDIDATE
from docmill.sources import readers, writers
from docmill.streaming import incremental


def test_json_lines_count_bad_rows(spark, tmp_path):
    (tmp_path / "archive").mkdir()
    (tmp_path / "a.jsonl").write_text('{"x":1}\n\nbroken\r\n[1]\n{"x":2}\n')
    (tmp_path / "archive" / "b.jsonl").write_text('{"x":3}\n')
    rows = readers.read_jsonl(spark, str(tmp_path))
    kept = readers.without_archives(rows)
    assert readers.line_counts(kept).select("n_lines", "n_bad").collect() == [(4, 2)]
    assert [r["line"] for r in readers.good_records(kept).orderBy("line").collect()] == [1, 5]


def test_documents_of_any_shape_and_file(spark, tmp_path):
    (tmp_path / "Archive").mkdir()
    (tmp_path / "a.jsonl").write_text('{"content":"a1"}\n[{"content":"a2"},{"text":"a3"},{"x":1}]\nbroken\n')
    (tmp_path / "b.json").write_text(json.dumps([{"content": "b1"}, {"content": "b2"}], indent=2))
    (tmp_path / "c.json").write_text(json.dumps({"chunks": [{"text": "c1"}]}, indent=1))
    (tmp_path / "d.json").write_text('{"content":"d1"}\n{"content":"d2"}\n')
    (tmp_path / "e.json").write_text('{"content":"e1"}\n{"broken\n')
    (tmp_path / "Archive" / "f.json").write_text('{"content":"f1"}')
    text = F.coalesce(F.try_variant_get("chunk", "$.content", "string"), F.try_variant_get("chunk", "$.text", "string"))
    got = sorted(r[0] for r in readers.read_documents(spark, str(tmp_path)).select(text).collect())
    assert got == ["a1", "a2", "a3", "b1", "b2", "c1", "d1", "d2", "e1"]
    assert readers.read_documents(spark, str(tmp_path), archives=True).count() == 10
    assert readers.read_semantic_file(spark, str(tmp_path / "b.json")).count() == 2 and readers.read_semantic_file(spark, str(tmp_path / "c.json")).count() == 0
    assert readers.read_semantic_file(spark, str(tmp_path / "a.jsonl")).count() == 1
    with pytest.raises(ValueError):
        readers.read_semantic_file(spark, "x.txt")


def test_first_files_and_file_shards(spark):
    rows = spark.createDataFrame([(f"f{i}", i) for i in range(7) for _ in range(3)], "file string, x int")
    assert {r["x"] for r in readers.first_files(rows, 2).collect()} == {0, 1} and readers.first_files(rows, 0).count() == 21
    parts = [{r["x"] for r in readers.file_shard(rows, 3, k).collect()} for k in range(3)]
    assert parts == [{0, 3, 6}, {1, 4}, {2, 5}] and readers.file_shard(rows, 1, 0).count() == 21
    with pytest.raises(ValueError):
        readers.file_shard(rows, 3, 3)


def test_taxonomies_and_index_defaults(spark, tmp_path):
    from docmill.schemas import TAXONOMY

    for field in TAXONOMY:
        if field != "chunk_role":
            (tmp_path / f"{field}.json").write_text(json.dumps([{"id": f"{field}1", "label": "x"}, {"id": f"{field}2"}]))
    found = readers.taxonomies(spark, str(tmp_path))
    assert found["domain"] == [("domain1", "x", None), ("domain2", None, None)] and found["chunk_role"] == []
    rows = spark.createDataFrame([("d", 1, "A text that is long enough.", "t", False, False, None)], "doc_id string, chunk_idx int, content string, title string, has_heading boolean, has_table boolean, trust_level string")

    def answer():
        return lambda prompt: json.dumps({"domain": ["domain2", "cfd"], "trust_level": "trust_level1", "summary_short": prompt[:200]})

    got = semantics.annotate(rows, answer, found).first()
    assert got["domain"] == ["domain2"] and got["trust_level"] == "trust_level1" and "- content_type1 (x)" in got["summary_short"]
    (tmp_path / "domain.json").unlink()
    with pytest.raises(FileNotFoundError):
        readers.taxonomies(spark, str(tmp_path))
    spark.createDataFrame([(0, [1.0])], "faiss_id long, embedding array<float>").write.parquet(str(tmp_path / "i" / "vectors"))
    assert readers.read_index(spark, str(tmp_path / "i"))[1] == {"metric": "IP", "index_type": "IndexFlatIP", "normalized": True}


def test_replacing_survives_a_stop(spark, tmp_path):
    out = str(tmp_path / "out")
    writers.replace_jsonl(spark.range(3), out)
    writers.replace_jsonl(spark.range(5), out)
    assert spark.read.json(out).count() == 5
    (tmp_path / "out").rename(tmp_path / "out._aside")  # stopped between the two renames
    writers.recover(spark, out)
    assert spark.read.json(out).count() == 5 and not (tmp_path / "out._aside").exists()


def test_later_rows_win_in_order(spark):
    left = spark.createDataFrame([("a", 1, "l1"), ("a", 2, "l2"), ("b", 9, "l3")], "k string, line int, v string")
    right = spark.createDataFrame([("b", 1, "r1"), ("b", 3, "r3"), ("b", 2, "r2")], "k string, line int, v string")
    assert sorted((r["k"], r["v"]) for r in readers.resolve_union(left, right, "k", ("line",)).collect()) == [("a", "l2"), ("b", "r3")]


def test_long_tables_are_written_whole(spark, tmp_path):
    found = writers.write_report(spark, {"t": spark.range(30), "u": spark.range(2)}, str(tmp_path / "r"), limit=10)
    assert len(found["t"]) == 10 and found["_cut"] == [{"table": "t", "rows": 30, "shown": 10}] and spark.read.json(str(tmp_path / "r_tables" / "t")).count() == 30


def test_scratch_tables_go_and_kept_ones_stay(spark):
    from docmill.storage import drop_stored, scratch, stored

    with scratch(spark) as keep:
        gone = stored(spark.range(3), "a")
        kept = keep(stored(gone.select((F.col("id") + 1).alias("id")), "b"))
        files = [f.removeprefix("file:") for f in gone.inputFiles()]
    assert kept.count() == 3 and not any(__import__("os").path.exists(f) for f in files)
    files = [f.removeprefix("file:") for f in kept.inputFiles()]
    drop_stored(spark, kept)
    assert not any(__import__("os").path.exists(f) for f in files)


def test_pages_isolate_failures(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"one\r\ntwo\fthree")
    (tmp_path / "b.pdf").write_bytes(b"bad")

    def parse(data):
        if data == b"bad":
            raise ValueError("unreadable")
        return readers.text_pages(data)

    got = {r["path"][-5:]: (r["pages"], r["error"]) for r in readers.pages_of(readers.read_files(spark, str(tmp_path), ".pdf"), parse).collect()}
    assert got == {"a.pdf": (["one\ntwo", "three"], None), "b.pdf": (None, "ValueError: unreadable")}


def test_versions_and_changelog(spark, tmp_path):
    out = str(tmp_path / "final")
    rows, none = spark.range(3).toDF("id"), spark.range(0).toDF("id")
    assert writers.write_dataset(rows, none, out, "qa_final", {"kept": 3}, "then", dry_run=True) == "v1"
    assert [writers.write_dataset(rows, none, out, "qa_final", {"kept": 3}, "then") for _ in range(2)] == ["v1", "v2"]
    log = (tmp_path / "final" / "CHANGELOG.md").read_text()
    assert log.index("## v2") < log.index("## v1") and spark.read.json(f"{out}/qa_final_v2.jsonl").count() == 3


def test_reports_and_csv(spark, tmp_path):
    df = spark.createDataFrame([("a", {"x": 1})], "k string, m map<string,int>")
    writers.counts_csv(df, str(tmp_path / "c"), ("m",))
    assert spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c")).select("k").collect() == [("a",)]
    writers.write_report(spark, {"t": df.select("k")}, str(tmp_path / "r"))
    assert json.loads((tmp_path / "r.json").read_text()) == {"t": [{"k": "a"}]}


def test_index_refuses_repeats_and_gaps(spark, tmp_path):
    rows = spark.createDataFrame([(0, "a", [1.0]), (1, "b", [2.0])], "faiss_id long, chunk_uid string, embedding array<float>")
    config = writers.write_index(rows, str(tmp_path / "i"))
    assert config["num_vectors"] == 2 and readers.read_index(spark, str(tmp_path / "i"))[0].count() == 2
    with pytest.raises(ValueError):
        writers.write_index(rows.withColumn("chunk_uid", F.lit("a")), str(tmp_path / "j"))
    writers.write_index(rows.where("faiss_id = 1"), str(tmp_path / "k"))
    with pytest.raises(ValueError):
        readers.read_index(spark, str(tmp_path / "k"))


def test_incremental_runs_add_only_what_is_new(spark, tmp_path):
    def put(name, *questions):
        lines = [{"id": q, "anchor_chunk_id": "a", "question": q, "answer": "An answer that is long enough here.", "source_chunks": ["c"]} for q in questions]
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("\n".join(map(json.dumps, lines)))

    def run():
        stream = incremental.candidate_stream(spark, str(tmp_path / "in"), CANDIDATE)
        incremental.append_new(incremental.sample_stream(stream), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out")).count()

    put("1.json", "What is the first question?", "What is the second question?", "What is the first question?")
    assert run() == 2
    put("2.json", "What is the second question?", "What is the third question?")
    assert run() == 3


def test_build_numbers_in_order(spark):
    kind = "file string, line int, " + CANDIDATE
    rows = [("f", i, f"c{i}", "a", "d", None, ["s"], f"Question number {i % 3} here?", "An answer that is long enough here.", "basic", "en", None, None, "high", "w", None) for i in range(6)]
    built = dataset.build(spark.createDataFrame(rows, kind)).orderBy("id").collect()
    assert [(r["id"], r["candidate_id"]) for r in built] == [("ws_00001_q1", "c0"), ("ws_00002_q1", "c1"), ("ws_00003_q1", "c2")]
