"""Pages to chunks: running lines removed, lines typed, sentences packed."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions.text import block_type, sentences, strip

#: Fixed value: every line boundary, among them vertical tab, form feed and the separators of files, groups and records.
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def lines_of(text: Column) -> Column:
    """Lines of a text; a null text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), LINE_END)


def edge_lines(pages: DataFrame, doc: str, page: str, text: str, edge: int = 3) -> DataFrame:
    """Rows ``doc, page, side, line``: the first and the last ``edge`` non-blank lines of each page, stripped."""
    lines = F.filter(F.transform(lines_of(F.col(text)), strip), lambda s: s != "")
    base = pages.select(F.col(doc).alias("doc"), F.col(page).alias("page"), lines.alias("lines"))
    last = F.slice("lines", F.greatest(F.lit(1), F.size("lines") - edge + 1), F.lit(edge))
    sides = F.array(
        F.struct(F.lit("header").alias("side"), F.slice("lines", 1, edge).alias("part")), F.struct(F.lit("footer").alias("side"), last.alias("part"))
    )
    return base.select("doc", "page", F.inline(sides)).select("doc", "page", "side", F.explode("part").alias("line"))


def running_lines(pages: DataFrame, doc: str = "doc_id", page: str = "page_idx", text: str = "text", fraction: float = 0.6, least: int = 2, longest: int = 120) -> DataFrame:
    """Rows ``doc, side, line, n`` of lines that open or close enough of a document's pages (three pages at least)."""
    totals = pages.groupBy(F.col(doc).alias("doc")).agg(F.count("*").alias("pages")).where("pages >= 3")
    counted = edge_lines(pages, doc, page, text).groupBy("doc", "side", "line").agg(F.count("*").alias("n"))
    enough = F.greatest(F.lit(least), F.floor(F.lit(fraction) * F.col("pages")).cast("int"))
    return counted.join(totals, "doc").where((F.col("n") >= enough) & (F.length("line") <= longest)).select("doc", "side", "line", "n")


def remove_running_lines(pages: DataFrame, doc: str = "doc_id", page: str = "page_idx", text: str = "text", fraction: float = 0.6) -> DataFrame:
    """``pages`` with every line equal to a running line dropped and the page stripped.

    A document has at most 6 / ``fraction`` running lines (each page gives six), so they travel as an array a document.
    """
    found = running_lines(pages, doc, page, text, fraction).groupBy(F.col("doc").alias(doc)).agg(F.collect_set("line").alias("__drop"))
    kept = F.filter(lines_of(F.col(text)), lambda line: ~F.array_contains("__drop", strip(line)))
    return pages.join(found, doc, "left").withColumn(text, F.when(F.col("__drop").isNull(), F.col(text)).otherwise(strip(F.array_join(kept, "\n")))).drop("__drop")


def units(pages_column: str = "pages"):
    """Array of ``(page_idx, text, block_type)``: every sentence of every line of an array of pages."""

    def of_page(text, page):
        lines = F.transform(lines_of(text), strip)
        typed = F.transform(lines, lambda line: F.struct(line.alias("line"), block_type(line, True).alias("kind")))
        of_line = F.transform(typed, lambda t: F.transform(sentences(t["line"], True), lambda s: F.struct(page.cast("int").alias("page_idx"), s.alias("text"), t["kind"].alias("block_type"))))
        return F.flatten(of_line)

    return F.flatten(F.transform(F.col(pages_column), of_page))


def chunk_ranges(lengths: np.ndarray, headings: np.ndarray, max_chars: int, min_chars: int, overlap: int) -> list[tuple[int, int, int, int]]:
    """Which units make each chunk of a document: ``(a, b, c, d)`` for units a to b and, in a joined last chunk, c to d (ends exclusive).

    Works on running totals, a step a chunk. A heading opens a chunk; a unit of ``max_chars`` or more is a chunk alone,
    unless it is a heading that closes another; otherwise a chunk takes what fits with a blank between units. Where the next
    unit does not fit, the last ``overlap`` units are carried over to it, or stand as a chunk of their own if it does not fit
    beside them, or are left if they are too long themselves. A last chunk under ``min_chars`` is joined to the one before.
    """
    n = len(lengths)
    upto = np.concatenate([[0], np.cumsum(np.asarray(lengths, np.int64) + 1)])
    alone = np.asarray(lengths) >= max_chars
    stops = np.append(np.flatnonzero(alone | np.asarray(headings, bool)), n)
    found: list[tuple[int, int]] = []
    first = following = 0
    while following < n:
        if first == following:
            following += 1
            if alone[first]:
                found.append((first, following))
                first = following
                continue
        reach = int(np.searchsorted(upto, upto[first] + max_chars + 1, side="right")) - 1
        following = max(following, min(reach, int(stops[np.searchsorted(stops, following)])))
        found.append((first, following))
        if following == n:
            break
        if headings[following]:
            first, following = following, following + 1
            if following == n:
                found.append((first, n))
            continue
        if alone[following]:
            first = following
            continue
        carried = max(first, following - overlap)
        if upto[following] - upto[carried] > max_chars + 1:
            carried = following
        if carried < following and upto[following + 1] - upto[carried] > max_chars + 1:
            found.append((carried, following))
            carried = following
        first, following = carried, following + 1
        if following == n:
            found.append((first, n))
    out = [(a, b, 0, 0) for a, b in found]
    if len(found) > 1 and upto[found[-1][1]] - upto[found[-1][0]] - 1 < min_chars:
        out[-2:] = [(*found[-2], *found[-1])]
    return out


def chunk_documents(docs: DataFrame, doc: str = "doc_id", pages: str = "pages", max_chars: int = 6000, min_chars: int = 400, overlap: int = 2) -> DataFrame:
    """Rows ``doc_id, chunk_index, content, page_start, page_end, block_types`` for documents with an array of page texts.

    Units are cut and texts are joined by SQL functions; only the units' lengths and which of them are headings go to
    Python, and the ranges of :func:`chunk_ranges` come back. A document is handled where its row is: no shuffle.
    """

    def cut(lengths: pd.Series, headings: pd.Series) -> pd.Series:
        return pd.Series([np.array(chunk_ranges(n, h, max_chars, min_chars, overlap), np.int32).ravel() for n, h in zip(lengths, headings, strict=True)])

    ranges = F.pandas_udf(cut, "array<int>")
    base = docs.select(F.col(doc).cast("string").alias("doc_id"), units(pages).alias("units"))
    sized = base.select("*", F.transform("units", lambda u: F.length(u["text"])).alias("lengths"), F.transform("units", lambda u: u["block_type"] == "heading").alias("headings"))
    ranged = sized.where(F.size("units") > 0).select("doc_id", "units", ranges("lengths", "headings").alias("ranges"))

    def chunk(k: Column) -> Column:
        a, b, c, d = (F.get("ranges", k * 4 + i) for i in range(4))
        one, two = F.slice("units", a + 1, b - a), F.slice("units", c + 1, d - c)
        both = F.concat(one, two)
        return F.struct(
            k.alias("chunk_index"), F.array_join(F.transform(both, lambda u: u["text"]), " ").alias("content"), F.get(one, F.lit(0))["page_idx"].alias("page_start"),
            F.element_at(both, -1)["page_idx"].alias("page_end"), F.sort_array(F.array_distinct(F.transform(both, lambda u: u["block_type"]))).alias("block_types"),
        )

    return ranged.select("doc_id", F.inline(F.transform(F.sequence(F.lit(0), F.expr("size(ranges) div 4 - 1").cast("int")), chunk)))


def chunk_records(chunks: DataFrame, path: str = "source_path", total_pages: str = "num_pages", source_type: str = "pdf") -> DataFrame:
    """Normalised records of chunks that carry their document's path and number of pages."""
    kinds = F.col("block_types")
    return chunks.select(
        "doc_id",
        F.format_string("%s_c%04d", "doc_id", "chunk_index").alias("chunk_id"),
        F.lit(source_type).alias("source_type"),
        F.col(path).alias("source_path"),
        F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1).alias("title"),
        F.lit("unknown").alias("language"),
        "content",
        F.struct(
            "page_start", "page_end", F.col(total_pages).cast("int").alias("num_pages"), kinds.alias("block_types"), F.array_contains(kinds, "table").alias("has_table"),
            F.array_contains(kinds, "formula").alias("has_formula"), F.array_contains(kinds, "heading").alias("has_heading"),
        ).alias("meta"),
    )
