"""The stages one after another on a small workspace."""

import json

import pytest
from pyspark.sql import functions as F

from docmill import cli, config
from docmill.plans import jobs

PAGE = "HDR\n{n} Heading text\nSentence one about heat transfer in pipes number {n}. Sentence two says more about it. " + "More words follow here to make the page long enough. " * 6


def test_workspace_end_to_end(spark, tmp_path):
    def answers():
        def ask(prompt):
            if prompt.startswith("You plan"):
                return "[]"
            first = prompt.split("chunk_id=")[1].split(" ")[0]
            return json.dumps([{"question": f"What does chunk {first} say?", "answer": "It says something about heat transfer in pipes.", "difficulty": "basic", "evidence_chunks": [first, "elsewhere"]}])

        return ask

    w = config.workspace(str(tmp_path))
    raw = tmp_path / "raw" / "a"
    raw.mkdir(parents=True)
    for d in range(3):
        (raw / f"doc{d}.pdf").write_text("\f".join(PAGE.format(n=n) for n in range(1, 5)))
    failed = jobs.ingest(spark, w.path("raw"), w.path("normalized"), max_chars=400, min_chars=50)
    assert failed.count() == 0
    chunks = spark.read.json(w.path("normalized"))
    assert chunks.where("content like '%HDR%'").count() == 0 and chunks.select("chunk_id").distinct().count() == chunks.count() > 10
    for _ in range(2):  # the second run reuses everything
        jobs.annotate(spark, w.path("normalized"), w.path("semantic"))
    semantic = spark.read.json(w.path("semantic"))
    assert semantic.count() == chunks.count() and {"existing", "llm"} >= {r[0] for r in semantic.select("mode").distinct().collect()}
    info = jobs.embed(spark, w.path("semantic"), w.path("index"))
    assert info["num_vectors"] == chunks.count()
    some = chunks.first()["chunk_id"]
    assert jobs.retrieve(spark, w.path("index"), some, 3).count() == 3
    everything = lambda: F.lit(True)
    settings = jobs.Generation(document_caps=False, content_types=(), llm=(("model", "stub"),))
    first = jobs.generate_candidates(spark, w.path("semantic"), w.path("index"), w.path("candidates"), answers, settings=settings, anchors=everything)
    n = first.count()
    assert n >= chunks.count() and jobs.generate_candidates(spark, w.path("semantic"), w.path("index"), w.path("candidates"), answers, settings=settings, anchors=everything).count() == 0
    for r in first.collect():
        assert r["source_chunks"] == [r["anchor_chunk_id"]] == [s["chunk_id"] for s in r["source_refs"]] and [s["chunk_id"] for s in r["context_refs"]] == r["context_chunks"]
        assert r["context_refs"][0]["page_start"] is not None and r["anchor_doc_id"] in r["doc_ids"] and r["workspace_file"].endswith(".json")
        p = r["provenance"]
        assert p["faiss"]["metric"] == "IP" and len(p["faiss"]["neighbor_chunk_ids"]) == len(p["faiss"]["neighbor_scores"]) <= 15 and p["llm"] == {"model": "stub"} and len(p["config_hash"]) == 40
    rules = jobs.dataset.Rules(languages=(), trust_levels=(), content_types=())
    version, counts = jobs.build_dataset(spark, w.path("candidates"), w.path("final"), rules)
    final = spark.read.json(f"{w.path('final')}/qa_final_{version}.jsonl")
    assert version == "v1" and counts["n_read"] == n and final.count() == counts["n_kept"] == chunks.count()
    assert set(jobs.chunk_report(spark, w.path("semantic"), f"{tmp_path}/logs/chunks", 1)) >= {"languages", "fill", "rates"} and (tmp_path / "logs" / "chunks.json").exists()
    report = jobs.qa_report(spark, w.path("candidates"), f"{tmp_path}/logs/qa")
    assert report["lines"].first()["lines"] == n and report["gini"].first()[0] == pytest.approx(0.0, abs=0.6)


def test_settings(tmp_path, monkeypatch):
    (tmp_path / "paths.json").write_text(json.dumps({"workspace_root": "/w", "raw": "in"}))
    monkeypatch.delenv("DOCMILL_WORKSPACE", raising=False)
    assert config.workspace(None, str(tmp_path / "paths.json")).path("raw") == "/w/in" and config.workspace("/x").path("final") == "/x/qa_final"
    with pytest.raises(KeyError):
        config.workspace("/x").path("nowhere")
    (tmp_path / "p.json").write_text(json.dumps({"plan_system": "a", "plan_template": " ", "generate_system": "b", "generate_template": "c"}))
    with pytest.raises(ValueError):
        config.load_prompts(str(tmp_path / "p.json"))
    (tmp_path / "r.json").write_text(json.dumps({"filters": {"min_question_chars": 5, "languages_allowed": ["en"]}}))
    assert config.load_rules(str(tmp_path / "r.json")).least_question == 5
    assert cli.parser().parse_args(["dataset", "--dry-run"]).dry_run
    args = cli.parser().parse_args(["candidates", "--num-shards", "3", "--shard-id", "1", "--limit-num-files", "2", "--resume-mode", "overwrite"])
    assert (args.num_shards, args.shard_id, args.files, args.resume_mode) == (3, 1, 2, "overwrite")
    (tmp_path / "g.json").write_text(json.dumps({"filters": {"languages_allowed": ["en"], "min_content_chars": 9}, "sampling": {"global_qa_limit": 5, "max_qa_per_document": 0}, "llm": {"model": "m"}}))
    made = config.load_generation(str(tmp_path / "g.json"))
    assert (made.languages, made.least_chars, made.limit, made.document_caps, made.llm) == (("en",), 9, 5, False, (("model", "m"),))


def test_chat_backend_posts_and_reads(spark):
    import http.server
    import threading

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            reply = json.dumps({"message": {"content": f"{body['model']}:{body['messages'][-1]['content']}"}}).encode()
            self.send_response(500 if "bad" in body["messages"][-1]["content"] else 200)
            self.end_headers()
            self.wfile.write(reply)

        def log_message(self, *args):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    df = spark.createDataFrame([("hi",), ("bad",), (None,)], "prompt string")
    got = {r["prompt"]: r["answer"] for r in jobs.semantics.with_model(df, "prompt", "answer", jobs.semantics.chat_backend(f"http://127.0.0.1:{server.server_port}/api/chat", "m")).collect()}
    server.shutdown()
    assert got == {"hi": "m:hi", "bad": None, None: None}


def test_annotation_that_was_stopped_halfway_equals_one_run(spark, tmp_path):
    """Neighbours and headings look over chunks that are done, so what is left gets the same prompts."""
    rows = [{"doc_id": "d", "chunk_id": f"d_c{i:04d}", "title": "t", "content": "Head" if i % 5 == 0 else f"Words of chunk {i} that say something.", "meta": {"has_heading": i % 5 == 0}} for i in range(20)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(map(json.dumps, rows)))
    asked: list = []

    def failing(prompt):
        if "Words of chunk 7" in prompt.split("Chunk:")[1] or "Words of chunk 12" in prompt.split("Chunk:")[1]:
            raise RuntimeError("stopped")
        return jobs.semantics.stub_backend(prompt)

    jobs.annotate(spark, str(tmp_path / "in"), str(tmp_path / "whole"))
    jobs.annotate(spark, str(tmp_path / "in"), str(tmp_path / "parts"), lambda: failing)
    assert spark.read.json(str(tmp_path / "parts")).where("mode = 'failed'").count() == 2
    jobs.annotate(spark, str(tmp_path / "in"), str(tmp_path / "parts"))
    columns = ["chunk_id", "mode", "trust_level", "summary_short", "language"]
    assert not asked and sorted(spark.read.json(str(tmp_path / "parts")).select(columns).collect()) == sorted(spark.read.json(str(tmp_path / "whole")).select(columns).collect())


def test_budgets_count_questions(spark, tmp_path):
    chunks = [{"doc_id": d, "chunk_id": f"{d}_c{i:04d}", "content": f"text {d} {i}", "language": "en", "trust_level": "high", "summary_short": "s"} for d in "ab" for i in range(30)]
    (tmp_path / "sem").mkdir()
    (tmp_path / "sem" / "a.jsonl").write_text("\n".join(map(json.dumps, chunks)))
    jobs.embed(spark, str(tmp_path / "sem"), str(tmp_path / "index"))

    def answers():
        def ask(prompt):
            if prompt.startswith("You plan"):
                return "[]"
            first = prompt.split("chunk_id=")[1].split(" ")[0]
            if int(first[-1]) % 2:  # every other anchor gives nothing, so a further wave is needed
                return "[]"
            return json.dumps([{"question": f"What {k} of {first}?", "answer": "Something.", "difficulty": "basic"} for k in range(3)])

        return ask

    base = jobs.Generation(max_neighbors=3, content_types=(), trust_levels=(), languages=())
    made = jobs.generate_candidates(spark, str(tmp_path / "sem"), str(tmp_path / "index"), str(tmp_path / "out"), answers, settings=base, anchors=lambda: F.lit(True))
    per = {r["anchor_doc_id"]: r["n"] for r in made.groupBy("anchor_doc_id").agg(F.count("*").alias("n")).collect()}
    assert per == {"a": 20, "b": 20} and spark.read.json(str(tmp_path / "out")).count() == 40
    first = sorted({r["anchor_chunk_id"] for r in made.where("anchor_doc_id = 'a'").collect()})
    assert first == [f"a_c{i:04d}" for i in range(0, 14, 2)]
    few = jobs.generate_candidates(spark, str(tmp_path / "sem"), str(tmp_path / "index"), str(tmp_path / "few"), answers, settings=jobs.replace(base, limit=7), anchors=lambda: F.lit(True))
    assert [r["anchor_doc_id"] for r in few.collect()] == ["a"] * 7
    dry = jobs.generate_candidates(spark, str(tmp_path / "sem"), str(tmp_path / "index"), str(tmp_path / "no"), answers, settings=base, anchors=lambda: F.lit(True), dry_run=True)
    assert dry.count() >= 40 and not (tmp_path / "no").exists()
