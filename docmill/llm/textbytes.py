"""Vectorised views of many texts at once: one byte buffer, word spans, polynomial hashes, and sampling of labelled rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docmill.llm.common import slim

#: Bytes of text that are handled in one go.
GROUP_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """Powers 0 to ``n`` of ``base`` modulo 2**64."""
    known = _POWERS.get(base)
    if known is None or len(known) <= n:
        with np.errstate(over="ignore"):
            known = np.r_[np.uint64(1), np.cumprod(np.full(max(n, GROUP_BYTES + 2), base, np.uint64))]
        if n < 4 * GROUP_BYTES:  # a table for one very long text is not kept
            _POWERS[base] = known
    return known


def groups(texts: list[str], size: int = GROUP_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of encoded texts of about ``size`` bytes, each with the position of its first; a longer text is a run of its own."""
    first, part, held = 0, [], 0
    for k, text in enumerate(texts):
        raw = text.encode("utf-8", "replace")
        if part and held + len(raw) > size:
            yield first, part
            first, part, held = k, [], 0
        part.append(raw)
        held += len(raw) + 1
    if part:
        yield first, part


class Words:
    """Words of a run of texts: ``buffer`` holds the texts with a separator before, between and after them.

    Bytes whose entry in ``separators`` is true part words and read as spaces.
    """

    def __init__(self, raws: list[bytes], table: bytes):
        joined = (b" " + b" ".join(raws) + b" ").translate(table)
        self.buffer = np.frombuffer(joined, np.uint8)
        apart = self.buffer == 32
        edge = np.flatnonzero(apart[1:] != apart[:-1]) + 1
        self.starts, self.ends = edge[0::2], edge[1::2]
        sizes = np.array([len(r) + 1 for r in raws], np.int64)
        self.text_ends = np.cumsum(sizes) + 1
        #: Which text each word is of; how many words each text has; where they begin.
        self.text_of = np.searchsorted(self.text_ends, self.starts, side="right")
        self.counts = np.bincount(self.text_of, minlength=len(raws))
        self.firsts = np.cumsum(self.counts) - self.counts

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
        """Hash of the bytes of each span, equal for equal bytes wherever and in whatever run they stand.

        Prefix sums of bytes times powers of the base; the difference over a span is divided by the power of its start.
        """
        with np.errstate(over="ignore"):
            if not hasattr(self, "_prefix"):
                n = len(self.buffer)
                self._prefix = np.r_[np.uint64(0), np.cumsum((self.buffer.astype(np.uint64) + np.uint64(1)) * powers(n)[:n])]
                self._back = powers(n, _INVERSE)
            return mixed((self._prefix[ends] - self._prefix[starts]) * self._back[starts] + np.uint64(salt))

    def separators_before(self) -> np.ndarray:
        """How many separators stand before each position, and in all at the end."""
        if not hasattr(self, "_before"):
            self._before = np.zeros(len(self.buffer) + 1, np.int32)
            np.cumsum(self.buffer == 32, out=self._before[1:])
        return self._before


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads a 64-bit hash over all its bits."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(32))
        h = h * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


#: Bytes of labelled texts of a class that reach the driver at most.
SAMPLE_BYTES = 8 << 20


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, excluded: int, wanted: bool, per_class: int, columns: list[str], text_col: str = "text", bytes_per_class: int = SAMPLE_BYTES
) -> list:
    """Up to ``per_class`` labelled documents of each class as rows of ``columns`` and ``label``.

    Learned from are rows whose crc32(doc_id as text) modulo ``modulus`` is not ``excluded`` (``wanted`` False) or is it
    (True). The choice is by a hash of the id, so it is spread over the table and the same in every run; of the chosen
    rows of a class those count that together hold at most ``bytes_per_class`` bytes of text, in the order of the hash.
    Rows with null id or label are left out; of repeated labels of an id the larger counts, of repeated documents one row.
    ``per_class`` and ``bytes_per_class`` bound what reaches the driver.
    """
    kept = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))
    rows = slim(labels, ["doc_id", label]).where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    rows = rows.where(kept == excluded if wanted else kept != excluded).groupBy("doc_id").agg(F.max(label).cast("int").alias(label))
    present = slim(docs, ["doc_id"]).where("doc_id is not null").distinct()
    rows = rows.join(present, "doc_id", "left_semi")
    chosen = None
    for value in (0, 1):
        part = rows.where(F.col(label) == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionAll(part)
    # At most 2 * per_class rows of two numbers are broadcast, and one document for each of them is looked at.
    found = slim(docs, ["doc_id", *columns]).join(F.broadcast(chosen), "doc_id")
    once = found.groupBy("doc_id", label).agg(F.min(F.struct(*columns)).alias("row")).select("doc_id", label, "row.*")
    upto = Window.partitionBy(label).orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    return once.withColumn("held", F.sum(size).over(upto)).where(F.col("held") <= bytes_per_class).drop("held").orderBy("doc_id").collect()
