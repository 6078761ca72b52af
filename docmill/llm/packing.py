"""Best-fit packing of tokenised documents into fixed-length sequences.

Documents are tokenised once; only slim rows (no texts, no ids) are kept. The plan is made on the histogram of piece
lengths, which has at most ``capacity`` entries however many documents there are:

* Large items are longer than a third of the capacity, so at most two fit in a bin. The largest takes the largest other
  large item that fits beside it (greedy matching), or stays alone.
* Smaller items, longest first, go into the bin with the least gap that holds them, and into new bins when there is none.

Items of one length are interchangeable, so the plan moves runs of bins with equal gaps at once and is a short list of
runs: length, first rank, count, first bin, offset. Each piece finds its place by its rank among the pieces of its
length: it is counted where it is made, and prefix sums over the parts of the table add what came before, so no length,
however common, meets in one task and no row is sorted for it.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docmill.llm.common import local_file, plain_texts, slices, slim, stored

CAPACITY = 2048
#: The id that ends every document.
END_ID = 0
#: How a byte-level tokenizer parts text before merging.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteTokenizer:
    """Ids of a byte-level BPE file of the ``tokenizers`` library, without special tokens added.

    Texts are merged by a rank table made from the same file; those that hold an added token's string or separators that
    libraries class differently go to the library. Nothing is remembered between texts.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        letters = _byte_letters()
        added = {t.content for t in self.library.get_added_tokens_decoder().values()}
        ranks = {bytes(letters[c] for c in token): i for token, i in self.library.get_vocab(with_added_tokens=False).items() if token not in added}
        self._merge = tiktoken.Encoding("bytes", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._odd = re.compile("[\x1c-\x1f\x85]|" + "|".join(re.escape(a) for a in sorted(added)) if added else "[\x1c-\x1f\x85]")

    def ids(self, text: str) -> np.ndarray:
        if self._odd.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self._merge(text), "<u4")


_TOKENIZERS: dict[str, ByteTokenizer] = {}


def tokenizer(path: str) -> ByteTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ByteTokenizer(local_file(path))
    return _TOKENIZERS[path]


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece of a document of ``total`` tokens: all full but the first."""
    first = total % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, total, capacity)]


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``doc_id, piece, start, length, ids_crc32`` of every document's tokens and end id; null text counts as empty.

    ``part`` and ``nth`` say in which task a piece was made and how many of its length that task made before; they hold for
    what is written, and change if the rows are made again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(tokenizer_file)
        end = np.array([END_ID], "<u4")
        made = np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in slices(batches):
            row, piece, start, length, crc, nth = [], [], [], [], [], []
            for k, text in enumerate(plain_texts(batch.column(1))):
                ids = np.concatenate([tok.ids(text), end])
                for n, (s, size) in enumerate(cut(len(ids), capacity)):
                    row.append(k)
                    piece.append(n)
                    start.append(s)
                    length.append(size)
                    crc.append(zlib.crc32(ids[s : s + size].tobytes()))
                    nth.append(made[size])
                    made[size] += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc, nth)), pa.array(np.full(len(row), part, np.int32))],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "nth", "part"],
            )

    source = slim(docs, [id_col, text_col]).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return source.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, nth long, part int")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, first_rank, count, first_bin, offset)`` that place every item of the histogram.

    The k-th item of a run goes to bin ``first_bin + k`` at ``offset``.
    """
    left = {n: c for n, c in histogram.items() if c}
    taken = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of bins (first, count)
    bins = 0

    def put(length: int, count: int, first_bin: int, offset: int) -> None:
        runs.append((length, taken[length], count, first_bin, offset))
        taken[length] += count
        left[length] -= count

    def leave(gap: int, first: int, count: int) -> None:
        if gap:
            gaps.setdefault(gap, []).append((first, count))

    large = sorted(n for n in left if 3 * n > capacity)
    for length in reversed(large):
        while left[length]:
            at = bisect.bisect_right(large, min(capacity - length, length)) - 1
            while at >= 0 and not left[large[at]]:
                at -= 1
            mate = large[at] if at >= 0 else None
            if mate is None or (mate == length and left[length] == 1):
                lower = next((large[i] for i in range(at - 1, -1, -1) if left[large[i]]), None) if mate == length else None
                mate = lower
            if mate is None:
                count = left[length]
                put(length, count, bins, 0)
                leave(capacity - length, bins, count)
            else:
                count = left[length] // 2 if mate == length else min(left[length], left[mate])
                put(length, count, bins, 0)
                put(mate, count, bins, length)
                leave(capacity - length - mate, bins, count)
            bins += count
    open_gaps = sorted(gaps)
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(open_gaps, length)
            if at == len(open_gaps):
                count = -(-left[length] // (capacity // length))
                gaps.setdefault(capacity, []).append((bins, count))
                bisect.insort(open_gaps, capacity)
                bins += count
                continue
            gap = open_gaps[at]
            first, count = gaps[gap].pop()
            n = min(count, left[length])
            put(length, n, first, capacity - gap)
            if n < count:
                gaps[gap].append((first + n, count - n))
            if not gaps[gap]:
                del gaps[gap]
                open_gaps.pop(at)
            rest = gap - length
            if rest:
                if rest not in gaps:
                    bisect.insort(open_gaps, rest)
                gaps.setdefault(rest, []).append((first, n))
    return runs


def place(pieces_df: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of :func:`pieces` with ``sequence_id, offset``."""
    made = stored(pieces_df, "pieces")
    counts = stored(made.groupBy("length", "part").agg(F.count("*").alias("n")), "counts")  # at most capacity rows a part
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ranks_before"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    runs = np.array(plan(histogram, capacity), np.int64).reshape(-1, 5)
    order = np.lexsort((runs[:, 1], runs[:, 0]))
    runs = runs[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ranks stay below 2**40, lengths below 2**23: one sorted key finds the run.
        keys = (runs[:, 0] << 40) + runs[:, 1]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(keys, (length << 40) + rank, side="right") - 1
            out = [pa.array(runs[at, 3] + rank - runs[at, 1]), pa.array(runs[at, 4])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *out], names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    # The offsets grow with the parts of the table, so they are merged and never broadcast.
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ranked = made.join(offsets.hint("merge"), ["length", "part"]).select(*columns, (F.col("ranks_before") + F.col("nth")).alias("rank"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.select(*columns).schema) + ", sequence_id long, offset long"
    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` that fill as few sequences as best fit finds.

    Null text counts as empty (one token, the end id). Only documents longer than ``capacity`` are cut. Repeated rows are
    packed each; null ids are kept; an empty table gives no rows; other columns are ignored.
    """
    return place(pieces(docs, tokenizer_file, capacity, id_col, text_col), capacity)
