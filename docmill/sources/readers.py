"""Readers: JSON lines of any shape, document trees, taxonomies, index folders."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmill.functions.records import is_object, kind
from docmill.functions.text import is_blank
from docmill.schemas import TAXONOMY
from docmill.storage import stored


def parsed_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``rec`` (a variant) and ``bad``: blank lines are dropped; broken lines and lines that hold no object are bad."""
    rows = lines.where(~is_blank(F.col(value))).withColumn("rec", F.try_parse_json(value))
    return rows.withColumn("bad", ~is_object(F.col("rec")))


def read_jsonl(spark: SparkSession, path: str, pattern: str = "*.jsonl", recursive: bool = True) -> DataFrame:
    """Rows ``file, line, value, rec, bad`` of JSON lines files; ``line`` counts from 1 and includes blank lines.

    Files are split like any text: lines are counted in each block of a file, and a prefix sum over a file's blocks (one
    row a block) gives each block its offset.
    """
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)
    block = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__start")]
    lines = reader.text(path).select(*block, "value", F.monotonically_increasing_id().alias("__at"))
    before = Window.partitionBy("file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    sizes = lines.groupBy("file", "__start").agg(F.count("*").alias("__n"))
    offsets = sizes.select("file", "__start", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    nth = F.row_number().over(Window.partitionBy("file", "__start").orderBy("__at"))
    numbered = lines.withColumn("__nth", nth).join(offsets, ["file", "__start"])
    return parsed_lines(numbered.select("file", (F.col("__before") + F.col("__nth")).alias("line"), "value"))


def read_json_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``file, line, value, rec, bad`` of whole ``.json`` files, each one value of any shape (line 1)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(path)
    return parsed_lines(files.select(F.col("_metadata.file_path").alias("file"), F.lit(1).cast("long").alias("line"), F.decode("content", "UTF-8").alias("value"))).withColumn(
        "bad", F.col("rec").isNull()
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``file, line, rec`` of every JSON value in the ``.json`` and ``.jsonl`` files under a folder.

    Files hold a value a line, whatever their name; a ``.json`` file with lines that are none is read as one value, and if
    it is none either, its good lines count.
    """
    lines = read_jsonl(spark, path, "*.json*").select("file", "line", "rec")
    parted = stored(lines.where(F.col("rec").isNull() & F.col("file").endswith(".json")).select("file").distinct(), "parted_files")
    good = lines.where(F.col("rec").isNotNull())
    if parted.isEmpty():
        return good
    whole = read_json_files(spark, path).where(~F.col("bad")).join(parted, "file", "left_semi").select("file", "line", "rec")
    return good.join(whole.select("file"), "file", "left_anti").unionByName(whole)


def read_documents(spark: SparkSession, path: str, archives: bool = False) -> DataFrame:
    """Rows ``file, line, place, chunk`` of every chunk under a folder, in values of any of the three shapes, without folders
    named ``archive`` unless wanted."""
    rows = read_records(spark, path)
    return document_chunks(rows if archives else without_archives(rows))


def read_semantic_file(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``file, line, rec`` of one file: lines of a ``.jsonl`` file or the elements of the list in a ``.json`` file.

    A ``.json`` file without a list at its top gives no rows; another suffix raises.
    """
    if path.endswith(".jsonl"):
        return good_records(read_jsonl(spark, path)).select("file", "line", "rec")
    if not path.endswith(".json"):
        raise ValueError(f"{path}: a .jsonl or .json file is needed")
    items = F.try_variant_get("rec", "$", "array<variant>")
    listed = read_json_files(spark, path).where(F.startswith(F.schema_of_variant("rec"), F.lit("ARRAY")))
    return listed.select("file", F.posexplode(items).alias("line", "rec")).withColumn("line", F.col("line").cast("long") + 1)


def first_files(rows: DataFrame, n: int, file: str = "file") -> DataFrame:
    """Rows of the first ``n`` files by name, or all if ``n`` is 0."""
    return rows.join(F.broadcast(rows.select(file).distinct().orderBy(file).limit(n)), file, "left_semi") if n > 0 else rows


def file_shard(rows: DataFrame, shards: int, shard: int, file: str = "file") -> DataFrame:
    """Rows of the files whose place among all files by name is ``shard`` modulo ``shards``."""
    if shards < 1 or not 0 <= shard < shards:
        raise ValueError("shards must be at least 1 and shard below it")
    if shards == 1:
        return rows
    # One row a file.
    names = rows.select(file).distinct().withColumn("__at", F.row_number().over(Window.orderBy(file)) - 1)
    return rows.join(F.broadcast(names.where(F.col("__at") % shards == shard).select(file)), file, "left_semi")


def good_records(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("bad"))


def line_counts(rows: DataFrame) -> DataFrame:
    """Rows ``file, n_lines, n_bad``."""
    return rows.groupBy("file").agg(F.count("*").alias("n_lines"), F.count_if("bad").alias("n_bad"))


def without_archives(rows: DataFrame, file: str = "file") -> DataFrame:
    """Without files under a folder named ``archive`` in any case."""
    return rows.where(~F.rlike(F.lower(F.col(file)), F.lit("/archive/")))


def document_chunks(rows: DataFrame, rec: str = "rec") -> DataFrame:
    """One row for each chunk of records of three shapes: a chunk, a list of chunks, an object with a list ``chunks``.

    Adds ``chunk`` and its ``place``; only objects that have a content or a text count.
    """
    value = F.col(rec)
    chunks = kind(value, "$.chunks")
    shape = F.when(F.startswith(F.schema_of_variant(value), F.lit("ARRAY")), F.try_variant_get(value, "$", "array<variant>"))
    shape = shape.when(is_object(value) & F.startswith(chunks, F.lit("ARRAY")), F.try_variant_get(value, "$.chunks", "array<variant>"))
    shape = shape.when(is_object(value), F.array(value))
    out = rows.select(*[c for c in rows.columns if c != rec], F.posexplode(shape).alias("place", "chunk"))
    has_text = kind(F.col("chunk"), "$.content").isNotNull() | kind(F.col("chunk"), "$.text").isNotNull()
    return out.where(is_object(F.col("chunk")) & has_text)


def indexable(chunks: DataFrame, exclude_unknown: bool = False) -> DataFrame:
    """Chunks (doc_id, chunk_id, language, artifact_role, content) that go into an index."""
    ok = ~is_blank(F.col("doc_id")) & ~is_blank(F.col("chunk_id")) & ~is_blank(F.col("content"))
    ok = ok & ~F.coalesce(F.array_contains("artifact_role", "structural"), F.lit(False))
    return chunks.where(ok & (F.col("language") != "unknown")) if exclude_unknown else chunks.where(ok)


def read_files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Rows ``path, content`` of all files with a suffix, in any depth; a query that needs an order sorts by path."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(path).select("path", "content")


def text_pages(data: bytes) -> list[str]:
    """Pages of a plain-text document, parted by form feeds: the stand-in for a page parser."""
    return data.decode("utf-8", "replace").split("\f")


def pages_of(files: DataFrame, parse: Callable[[bytes], list[str]] = text_pages) -> DataFrame:
    """Rows ``path, pages, error`` of binary files; a document that fails keeps its error and harms no other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages, errors = [], []
            for data in batch.column(1).to_pylist():
                try:
                    found = [(p or "").replace("\r\n", "\n").replace("\r", "\n").strip() for p in parse(data)]
                    pages.append(found)
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  parsers are pluggable and fail in their own ways
                    pages.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pages, pa.list_(pa.string())), pa.array(errors, pa.string())], names=["path", "pages", "error"])

    return files.select("path", "content").mapInArrow(run, "path string, pages array<string>, error string")


def taxonomies(spark: SparkSession, folder: str, optional: tuple[str, ...] = ("chunk_role",)) -> dict[str, list[tuple[str, str | None, str | None]]]:
    """Entries (id, label, description) of each taxonomy of a folder in their order, from ``field.json``; optional ones may be
    absent and are empty then."""
    out = {}
    for field in TAXONOMY:
        if exists(spark, f"{folder}/{field}.json"):
            out[field] = [(r["id"], r["label"], r["description"]) for r in read_taxonomy(spark, f"{folder}/{field}.json").collect() if r["id"]]  # a dimension of tens of ids
        elif field in optional:
            out[field] = []
        else:
            raise FileNotFoundError(f"{folder}/{field}.json")
    return out


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or a folder with files under a path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(target)) and (not fs.getFileStatus(target).isDirectory() or any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(target)))


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``id, label, description`` of a taxonomy file (one JSON list)."""
    return spark.read.schema("id STRING, label STRING, description STRING").option("multiLine", True).json(path)


def file_documents(rows: DataFrame, doc: Column, file: str = "file", line: str = "line") -> DataFrame:
    """Rows ``file, doc_id``: the document named in a file's first record, else the file's stem."""
    first = rows.groupBy(file).agg(F.min_by(doc, F.col(line)).alias("found"))
    return first.select(file, F.coalesce("found", F.regexp_extract(file, r"([^/]+?)(\.[^./]*)?$", 1)).alias("doc_id"))


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """Vectors with their metadata, and the index's configuration (defaults where none is stored); raises if ordinals have gaps."""
    vectors = spark.read.parquet(f"{path}/vectors")
    sidecar = f"{path}/config/config.json"
    config = json.loads("".join(r[0] for r in spark.read.text(sidecar).collect())) if exists(spark, sidecar) else {}
    seen = vectors.agg(F.count("*").alias("n"), F.max("faiss_id").alias("top"), F.count_distinct("faiss_id").alias("ids")).first()
    if seen["n"] and not seen["n"] == seen["ids"] == seen["top"] + 1:
        raise ValueError(f"index is incomplete: {seen['n']} rows, {seen['ids']} ordinals up to {seen['top']}")
    return vectors, {"metric": "IP", "index_type": "IndexFlatIP", "normalized": True} | config


def limited(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in order, or all if ``n`` is 0."""
    return rows.orderBy(*order).limit(n) if n > 0 else rows


def resolve_union(left: DataFrame, right: DataFrame, key: str, order: tuple[str, ...] = ()) -> DataFrame:
    """Rows of both; of a key in both the right one counts (later files override earlier ones).

    Of rows of one side the last by ``order`` (file and line, say) counts.
    """
    late = [F.desc("__late"), *[F.desc(c) for c in order]]
    both = left.withColumn("__late", F.lit(0)).unionByName(right.withColumn("__late", F.lit(1)))
    return both.withColumn("__nth", F.row_number().over(Window.partitionBy(key).orderBy(*late))).where("__nth = 1").drop("__nth", "__late")
