"""Command line: one subcommand a stage, for ``spark-submit docmill/cli.py STAGE ...`` or ``python -m docmill.cli``."""

from __future__ import annotations

import argparse
from dataclasses import replace

from docmill import config
from docmill.operators import semantics
from docmill.plans import jobs
from docmill.session import get_spark
from docmill.storage import clean


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="docmill")
    p.add_argument("--workspace-root")
    p.add_argument("--paths-file")
    sub = p.add_subparsers(dest="stage", required=True)
    ingest = sub.add_parser("ingest", help="documents to chunks")
    ingest.add_argument("--suffix", default=".pdf")
    ingest.add_argument("--input-dir", help="in place of the workspace's folder")
    ingest.add_argument("--output-dir", help="in place of the workspace's folder")
    for name, default in (("max-chars", 6000), ("min-chars", 400), ("sentence-overlap", 2)):
        ingest.add_argument(f"--{name}", type=int, default=default)
    annotate = sub.add_parser("annotate", help="chunks to annotated chunks (with the stand-in model where no server is named)")
    annotate.add_argument("--taxonomy-dir", help="folder of the taxonomies (JSON lists of id, label, description)")
    _sharded(annotate, "--limit-files")
    _served(annotate, 120.0)
    embed = sub.add_parser("embed", help="annotated chunks to an index")
    embed.add_argument("--exclude-unknown", action="store_true")
    embed.add_argument("--normalize", action=argparse.BooleanOptionalAction, default=True)
    embed.add_argument("--max-chunks", type=int, default=0)
    embed.add_argument("--batch-size", type=int, default=64)
    embed.add_argument("--model", default="hash", help="name of the encoder, written into the index")
    retrieve = sub.add_parser("retrieve", help="nearest chunks of a chunk")
    retrieve.add_argument("--chunk-id")
    retrieve.add_argument("--top-k", type=int, default=5)
    made = sub.add_parser("candidates", help="annotated chunks and their index to question-answer candidates")
    made.add_argument("--config", help="settings of the generation (JSON)")
    made.add_argument("--prompts", help="prompts of the two passes (JSON)")
    made.add_argument("--resume-mode", choices=("append", "resume", "overwrite"), default="resume")
    made.add_argument("--dry-run", action="store_true")
    _sharded(made, "--limit-num-files")
    _served(made, 600.0)
    data = sub.add_parser("dataset", help="candidates to a versioned dataset")
    data.add_argument("--limit-files", type=int, default=0)
    data.add_argument("--limit-num-examples", type=int, default=0)
    data.add_argument("--config")
    data.add_argument("--version", default="auto")
    data.add_argument("--id-strategy", choices=("sequential", "candidate", "hash"), default="sequential")
    data.add_argument("--dry-run", action="store_true")
    chunks = sub.add_parser("chunk-stats", help="report on annotated chunks")
    chunks.add_argument("--min-doc-chunks", type=int, default=500)
    chunks.add_argument("--dump-examples", action=argparse.BooleanOptionalAction, default=True)
    chunks.add_argument("--max-examples", type=int, default=300)
    chunks.add_argument("--seed", type=int, default=0)
    qa = sub.add_parser("qa-stats", help="report on candidates")
    qa.add_argument("--top-n", type=int, default=50)
    qa.add_argument("--min-qa", type=int, default=1)
    qa.add_argument("--qa-dir", help="in place of the workspace's folder")
    qa.add_argument("--pattern", default="*.json*")
    return p


def _sharded(p: argparse.ArgumentParser, files: str) -> None:
    p.add_argument(files, dest="files", type=int, default=0, help="files read at most, in the order of their names (0: all)")
    p.add_argument("--num-shards", type=int, default=1)
    p.add_argument("--shard-id", type=int, default=0)


def _served(p: argparse.ArgumentParser, timeout: float) -> None:
    p.add_argument("--server", help="address of a chat server; without one the stand-in model answers")
    p.add_argument("--model", default="stub")
    p.add_argument("--timeout", type=float, default=timeout)
    p.add_argument("--temperature", type=float, default=0.2)


def _backend(args: argparse.Namespace):
    if not args.server:
        return lambda: semantics.stub_backend
    return semantics.chat_backend(args.server, args.model, timeout=args.timeout, temperature=args.temperature)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    w = config.workspace(args.workspace_root, args.paths_file)
    spark = get_spark(f"docmill-{args.stage}")
    if args.stage == "ingest":
        jobs.ingest(spark, args.input_dir or w.path("raw"), args.output_dir or w.path("normalized"), args.suffix, max_chars=args.max_chars, min_chars=args.min_chars, overlap=args.sentence_overlap).show(truncate=False)
    elif args.stage == "annotate":
        jobs.annotate(spark, w.path("normalized"), w.path("semantic"), _backend(args), args.files, args.num_shards, args.shard_id, args.taxonomy_dir)
    elif args.stage == "embed":
        print(jobs.embed(spark, w.path("semantic"), w.path("index"), exclude_unknown=args.exclude_unknown, normalize=args.normalize, limit=args.max_chunks, batch_size=args.batch_size, model=args.model))
    elif args.stage == "retrieve":
        jobs.retrieve(spark, w.path("index"), args.chunk_id, args.top_k).orderBy("query_id", "rank").show(200, truncate=False)
    elif args.stage == "candidates":
        settings = config.load_generation(args.config) if args.config else jobs.Generation()
        settings = replace(settings, llm=settings.llm or (("model", args.model), ("temperature", str(args.temperature))))
        prompts = config.load_prompts(args.prompts) if args.prompts else config.DEFAULT_PROMPTS
        made = jobs.generate_candidates(
            spark, w.path("semantic"), w.path("index"), w.path("candidates"), _backend(args), prompts, settings, resume=args.resume_mode != "overwrite", dry_run=args.dry_run, files=args.files, shards=args.num_shards,
            shard=args.shard_id,
        )
        print(f"{made.count()} {'context groups' if args.dry_run else 'candidates'}")
    elif args.stage == "dataset":
        rules = config.load_rules(args.config) if args.config else jobs.dataset.Rules()
        print(jobs.build_dataset(spark, w.path("candidates"), w.path("final"), rules, strategy=args.id_strategy, version=args.version, dry_run=args.dry_run, files=args.limit_files, limit=args.limit_num_examples))
    elif args.stage == "chunk-stats":
        jobs.chunk_report(spark, w.path("semantic"), f"{w.path('logs')}/chunk_report", args.min_doc_chunks, args.max_examples if args.dump_examples else 0, args.seed)
    else:
        jobs.qa_report(spark, args.qa_dir or w.path("candidates"), f"{w.path('logs')}/qa_report", args.top_n, args.min_qa, args.pattern)
    clean(spark)


if __name__ == "__main__":
    main()
