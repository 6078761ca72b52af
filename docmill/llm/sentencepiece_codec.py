"""SentencePiece encoding that keeps the source: every piece is projected to a byte span of the original text.

The model file is parsed here. Every text is normalised first: at each place the longest prefix found in the compiled
character map (a double-array trie over UTF-8 bytes followed by zero-terminated replacements) is replaced, one character
is copied where none matches, and each normalised byte keeps the source byte that it came from. The trie is walked from
all bytes of a text at once. Pieces are then found by byte-pair merging by score (leftmost first among equals) with byte
fallback, and the alignment turns their normalised bytes into source spans.

Where no piece holds a space mark after another character, normalised text falls apart at its marks into chunks that merge
independently; ids of chunks are remembered (bounded by ``CACHE_CHUNKS``), and the chunks of a batch that are new are
merged together, one merge of each in a step. Long chunks are merged one at a time with a queue.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import local_file, plain_texts, slices, slim

#: Chunks remembered by a worker before it starts afresh.
CACHE_CHUNKS = 200_000
#: Longest chunk (characters) that is remembered.
CACHE_LONGEST = 64
MARK = "▁"
MARK_BYTES = MARK.encode()
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and raw values of one protocol-buffer message."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < end:
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 1:
            yield tag >> 3, data[at : at + 8]
            at += 8
        elif kind == 2:
            size = varint()
            yield tag >> 3, data[at : at + size]
            at += size
        elif kind == 5:
            yield tag >> 3, data[at : at + 4]
            at += 4
        else:
            raise ValueError(f"wire type {kind}")


class CharacterMap:
    """The compiled map: its size, the trie's 32-bit units, then the replacement strings."""

    def __init__(self, blob: bytes):
        self.units = np.zeros(0, np.int64)
        self.replacements = b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64)
            self.replacements = blob[4 + size :]

    @staticmethod
    def _offset(unit: np.ndarray) -> np.ndarray:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def longest(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For each byte of ``data`` the length of the longest key that starts there (0 if none), and the replacement's place."""
        n = len(data)
        length, value = np.zeros(n, np.int32), np.zeros(n, np.int64)
        if not len(self.units) or not n:
            return length, value
        units, raw = self.units, np.frombuffer(data, np.uint8).astype(np.int64)
        live = np.arange(n)
        node = np.full(n, self._offset(units[:1])[0], np.int64)
        for depth in range(n):
            inside = live + depth < n
            live, node = live[inside], node[inside]
            byte = raw[live + depth]
            node = node ^ byte
            known = (node < len(units)) & (byte != 0)
            live, node, byte = live[known], node[known], byte[known]
            unit = units[node]
            right = (unit & 0x800000FF) == byte
            live, node, unit = live[right], node[right], unit[right]
            if not len(live):
                break
            node = node ^ self._offset(unit)
            leaf = (unit >> 8) & 1 == 1
            length[live[leaf]] = depth + 1
            value[live[leaf]] = units[node[leaf]] & 0x7FFFFFFF
        return length, value

    def replacement(self, place: int) -> bytes:
        return self.replacements[place : self.replacements.index(b"\0", place)]


class OffsetCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        self.pieces: list[tuple[bytes, float, int]] = []
        trainer: dict[int, object] = {}
        rules: dict[int, object] = {}
        with open(path, "rb") as f:
            for field, value in _fields(f.read()):
                if field == 1:
                    one = dict(_fields(value))
                    score = struct.unpack("<f", one[2])[0] if 2 in one else 0.0
                    self.pieces.append((one.get(1, b""), score, one.get(3, NORMAL)))
                elif field == 2:
                    trainer = dict(_fields(value))
                elif field == 3:
                    rules = dict(_fields(value))
        if trainer.get(3, 1) != 2:
            raise ValueError("only byte-pair models are supported")
        if any(kind in (USER, UNUSED) for _, _, kind in self.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.map = CharacterMap(rules.get(2, b""))
        self.dummy_prefix = bool(rules.get(3, 1))
        self.squeeze = bool(rules.get(4, 1))
        self.escape = bool(rules.get(5, 1))
        if not self.escape:
            raise ValueError("models that do not escape spaces are not supported")
        self.rank = {p.decode(): (s, i) for i, (p, s, kind) in enumerate(self.pieces) if kind == NORMAL}
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(self.pieces) if kind == BYTE}
        self.unknown = next(i for i, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN)
        self.eos = next((i for i, (p, _, kind) in enumerate(self.pieces) if kind == CONTROL and p == b"</s>"), None)
        self.apart = self.dummy_prefix and not any(MARK in p.lstrip(MARK) for p in self.rank)
        self._surface = []
        self._decimal = [str(i) for i in range(len(self.pieces))]
        for i, (p, _, kind) in enumerate(self.pieces):
            out = bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else p.replace(MARK_BYTES, b" ")
            self._surface.append(out)
        #: Normalised bytes of each piece.
        self._sizes = np.array([1 if kind == BYTE else len(p) for p, _, kind in self.pieces], np.int64)
        self._merges = Merges(self)
        self._known: dict[str, bytes] = {}

    def _mapped(self, text: str) -> tuple[str, np.ndarray]:
        """Text after the character map, and the source byte of each of its bytes, in which a space counts as a mark."""
        data = text.encode("utf-8", "replace")
        raw = np.frombuffer(data, np.uint8)
        # A byte inside a character comes from where the character begins.
        source = np.maximum.accumulate(np.where((raw & 0xC0) == 0x80, 0, np.arange(len(raw))))
        length, value = self.map.longest(data)
        if length.any():
            parts, sources, at = [], [], 0
            for hit in np.flatnonzero(length).tolist():
                if hit < at or source[hit] != hit:
                    continue
                part = self.map.replacement(int(value[hit]))
                parts += [data[at:hit], part]
                sources += [source[at:hit], np.full(len(part), hit)]
                at = hit + int(length[hit])
            data = b"".join([*parts, data[at:]])
            raw, source, text = np.frombuffer(data, np.uint8), np.concatenate([*sources, source[at:]]), data.decode("utf-8", "replace")
        return text, np.repeat(source, np.where(raw == 32, len(MARK_BYTES), 1))

    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text with spaces for marks, without the dummy prefix; and the source byte of each byte of its marked
        form, the dummy prefix and the end included."""
        size = len(text.encode("utf-8", "replace"))
        text, source = self._mapped(text)
        text = text.replace(MARK, " ")
        if self.squeeze:
            kept, kept_from = self._squeezed(text.replace(" ", MARK).encode(), source.tolist())
            text, source = kept.decode().replace(MARK, " "), np.array(kept_from, np.int64)
        if not text:
            return "", np.array([size])
        before = [source[0]] * len(MARK_BYTES) if self.dummy_prefix else []
        return text, np.r_[before, source, size].astype(np.int64)

    @staticmethod
    def _squeezed(out: bytes, source: list[int]) -> tuple[bytes, list[int]]:
        """Without space marks at the ends, and one for each run between words."""
        keep, kept_from, pending = bytearray(), [], None
        for m in re.finditer(b"(?:%s)+|.[\x80-\xbf]*" % MARK_BYTES, out, re.DOTALL):
            if m[0].startswith(MARK_BYTES):
                pending = m.start()
                continue
            if pending is not None and keep:
                keep += MARK_BYTES
                kept_from += [source[pending]] * len(MARK_BYTES)
            pending = None
            keep += m[0]
            kept_from += source[m.start() : m.end()]
        return bytes(keep), kept_from

    def segment(self, normal: str) -> list[tuple[int, int]]:
        """Ids of the pieces of normalised text and how many of its bytes each takes."""
        rank = self.rank
        n = len(normal)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        part = list(normal)
        queue: list[tuple[float, int, int, str]] = []

        def push(left: int, right: int) -> None:
            if left < 0 or right >= n:
                return
            joined = part[left] + part[right]
            hit = rank.get(joined)
            if hit:
                heapq.heappush(queue, (-hit[0], left, right, joined))

        for i in range(n - 1):
            push(i, i + 1)
        while queue:
            _, left, right, joined = heapq.heappop(queue)
            if not part[left] or not part[right] or after[left] != right or part[left] + part[right] != joined:
                continue
            part[left], part[right] = joined, ""
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            push(before[left], left)
            push(left, after[left])
        out: list[tuple[int, int]] = []
        at = 0
        while at < n:
            hit = rank.get(part[at])
            raw = part[at].encode("utf-8", "replace")
            if hit:
                out.append((hit[1], len(raw)))
            elif self.byte_ids:
                out += [(self.byte_ids[b], 1) for b in raw]
            elif out and out[-1][0] == self.unknown:
                out[-1] = (self.unknown, out[-1][1] + len(raw))
            else:
                out.append((self.unknown, len(raw)))
            at = after[at]
        return out

    def encode_spans(self, text: str) -> tuple[list[int], list[int], list[int]]:
        """Ids without an end id, and the source bytes ``[begin, end)`` of each piece.

        A piece begins where its first normalised byte came from and ends where the next piece begins, so the spans of a
        text follow each other without gaps; a byte piece of a character that takes several has an empty span unless it
        is the last of them.
        """
        ids, ends = self.encode_batch([text])[0]
        ends = ends.tolist()
        begin = int(self.normalize(text)[1][0]) if len(ids) else 0
        return ids.tolist(), [begin, *ends[:-1]] if ends else [], ends

    def encode_batch(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text the ids of its pieces and the source byte where each ends."""
        normal = [self.normalize(t) for t in texts]
        if not self.apart:
            found = [self.segment(MARK * self.dummy_prefix + n.replace(" ", MARK)) if n else [] for n, _ in normal]
            out = []
            for pieces, (_, source) in zip(found, normal, strict=True):
                ends = np.cumsum([size for _, size in pieces], dtype=np.int64)
                out.append((np.array([i for i, _ in pieces], np.int64), source[ends]))
            return out
        parts = [_chunks(n) if n else [] for n, _ in normal]
        if len(self._known) > CACHE_CHUNKS:
            self._known.clear()
        known = self._known
        new = list(set().union(*parts).difference(known))
        known.update(zip(new, self._merges.ids_of([marked(c) for c in new]), strict=True))
        out = []
        for chunks, (_, source) in zip(parts, normal, strict=True):
            ids = np.frombuffer(b"".join(map(known.__getitem__, chunks)), "<u4")
            out.append((ids, source[np.cumsum(self._sizes[ids])]))
        for chunk in new:
            if len(chunk) > CACHE_LONGEST:
                del known[chunk]
        return out

    def joined(self, ids: np.ndarray) -> str:
        """Decimal ids joined by one space."""
        return " ".join(map(self._decimal.__getitem__, ids.tolist()))

    def decode(self, ids: list[int]) -> str:
        """Surfaces joined, byte pieces read as UTF-8, the space of the dummy prefix dropped, control pieces left out."""
        raw = b"".join(map(self._surface.__getitem__, ids))
        if (self.dummy_prefix or self.squeeze) and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


class Merges:
    """Byte-pair merging of many short chunks at once.

    A symbol is a piece's id, or ``AWAY`` and the code point of a character that is no piece. The pairs of symbols whose
    text together is a piece stand in one sorted table with the rank of the piece's score.
    """

    AWAY, BITS, NONE = 1 << 20, 22, np.int32(2**31 - 1)

    def __init__(self, codec: OffsetCodec):
        self.codec = codec
        rank = codec.rank
        self.symbol = np.arange(0x110000, dtype=np.int32) + self.AWAY
        for text, (_, i) in rank.items():
            if len(text) == 1:
                self.symbol[ord(text)] = i
        place = {score: k for k, score in enumerate(sorted({s for s, _ in rank.values()}, reverse=True))}

        def of(text: str) -> int | None:
            return int(self.symbol[ord(text)]) if len(text) == 1 else rank[text][1] if text in rank else None

        rows = []
        for text, (score, i) in rank.items():
            for cut in range(1, len(text)):
                left, right = of(text[:cut]), of(text[cut:])
                if left is not None and right is not None:
                    rows.append((left << self.BITS | right, place[score], i))
        rows.sort()
        self.keys, ranks, ids = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 3
        self.ranks, self.ids = ranks.astype(np.int32), ids.astype(np.int32)
        self.fallback: dict[int, list[int]] = {}
        self.filter = np.zeros(1 << 22, bool)
        self.filter[self._slot(self.keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)

    def _found(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of the piece that two symbols make; ``NONE`` where there is none (symbols below 0 are no symbols)."""
        rank, made = np.full(left.shape, self.NONE), np.full(left.shape, -1, np.int32)
        keys = (left.astype(np.int64) << self.BITS) | right
        at = np.flatnonzero(self.filter[self._slot(keys)] & (left >= 0) & (right >= 0))
        if len(at) and len(self.keys):
            k = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
            same = self.keys[k] == keys[at]
            rank[at[same]], made[at[same]] = self.ranks[k[same]], self.ids[k[same]]
        return rank, made

    def _merged(self, symbols: np.ndarray) -> np.ndarray:
        """A row of symbols for each chunk, ended by -1, merged until no pair of a row makes a piece."""
        n, width = symbols.shape
        out = np.full((n, width), -1, np.int32)
        row = np.arange(n)
        flat_rank, flat_made = self._found(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
        rank, made = flat_rank.reshape(n, width - 1), flat_made.reshape(n, width - 1)
        steps = np.arange(width)
        while len(row):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(row)), at]
            done = best == self.NONE
            if done.any():
                out[row[done]] = symbols[done]
                row, symbols, rank, made, at = row[~done], symbols[~done], rank[~done], made[~done], at[~done]
                if not len(row):
                    break
            here = np.arange(len(row))
            # The right symbol of the pair goes, and all after it move up by one.
            take = np.minimum(steps[None] + (steps[None] > at[:, None]), width - 1)
            last = symbols[:, -1].copy()
            merged = made[here, at]
            symbols = np.take_along_axis(symbols, take, axis=1)
            symbols[:, -1] = np.where(at == width - 1, last, -1)
            symbols[here, at] = merged
            take = np.minimum(steps[None, :-1] + (steps[None, :-1] > at[:, None]), width - 2)
            rank, made = np.take_along_axis(rank, take, axis=1), np.take_along_axis(made, take, axis=1)
            rank[:, -1], made[:, -1] = self.NONE, -1
            for place in (at - 1, at):
                ok = np.flatnonzero((place >= 0) & (place < width - 1))
                rank[ok, place[ok]], made[ok, place[ok]] = self._found(symbols[ok, place[ok]], symbols[ok, place[ok] + 1])
        return out

    def _bytes(self, symbol: int) -> list[int]:
        """Ids of the bytes of a character that is no piece."""
        if symbol not in self.fallback:
            self.fallback[symbol] = [self.codec.byte_ids[b] for b in chr(symbol - self.AWAY).encode("utf-8", "replace")]
        return self.fallback[symbol]

    def ids_of(self, chunks: list[str], rows: int = 8192) -> list[bytes]:
        """Ids (little-endian 32-bit) of each chunk of marked text."""
        sizes = np.array([len(c) for c in chunks], np.int64)
        found: list[bytes] = [b""] * len(chunks)
        order = np.argsort(sizes, kind="stable")
        short = order[sizes[order] <= CACHE_LONGEST]
        lone: list[int] = order[len(short) :].tolist()
        for lo in range(0, len(short), rows):
            part = short[lo : lo + rows]
            own = sizes[part]
            width = int(own.max(initial=1)) + 1
            symbols = np.full((len(part), width), -1, np.int32)
            points = np.frombuffer("".join(chunks[k] for k in part.tolist()).encode("utf-32-le", "replace"), "<u4")
            symbols[np.arange(width)[None] < own[:, None]] = self.symbol[points]
            merged = self._merged(symbols)
            strange = np.flatnonzero((merged >= self.AWAY).any(axis=1))
            counts = (merged >= 0).sum(axis=1)
            data, edge = merged[merged >= 0].astype("<u4").tobytes(), np.r_[0, np.cumsum(counts)] * 4
            for k, begin, end in zip(part.tolist(), edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                found[k] = data[begin:end]
            if self.codec.byte_ids:
                for k, row in zip(part[strange].tolist(), merged[strange].tolist(), strict=True):
                    found[k] = np.array([i for s in row if s >= 0 for i in (self._bytes(s) if s >= self.AWAY else (s,))], "<u4").tobytes()
            else:
                lone += part[strange].tolist()
        for k in lone:
            found[k] = np.array([i for i, _ in self.codec.segment(chunks[k])], "<u4").tobytes()
        return found


_CHUNK = re.compile(r" *[^ ]+| +")


def _chunks(text: str) -> list[str]:
    """Runs of spaces with what follows them, the dummy prefix included; a single leading space is left out.

    A chunk that begins with two spaces is written with both, so that each chunk is written in one way only.
    """
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [c[1:] if len(c) > 1 and c[1] != " " else c for c in _CHUNK.findall(" " + text)]


def marked(chunk: str) -> str:
    """The marked text of a chunk of :func:`_chunks`."""
    return chunk.replace(" ", MARK) if chunk.startswith(" ") else MARK + chunk


#: Characters of texts that are encoded in one go.
GROUP = 2_000_000


def grouped(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of about ``GROUP`` characters."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size > GROUP:
            yield part
            part, size = [], 0
    if part:
        yield part


_CODECS: dict[str, OffsetCodec] = {}


def codec(path: str) -> OffsetCodec:
    """The codec of a model file, made once in a worker."""
    if path not in _CODECS:
        _CODECS[path] = OffsetCodec(local_file(path))
    return _CODECS[path]


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", add_eos: bool = True) -> DataFrame:
    """Rows ``doc_id, ids, begins, ends``: piece ids with their byte spans in the original text (the end id's is empty).

    Null text counts as empty (the end id alone); null and repeated doc_ids are kept; no row depends on another.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in slices(batches):
            ids, begins, ends = [], [], []
            for text in plain_texts(batch.column(1)):
                i, b, e = c.encode_spans(text)
                size = len(text.encode("utf-8", "replace"))
                ids.append(i + [c.eos] * add_eos)
                begins.append(b + [size] * add_eos)
                ends.append(e + [size] * add_eos)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, kind) for x in (ids, begins, ends))], names=["doc_id", "ids", "begins", "ends"])

    source = slim(docs, [id_col, text_col]).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return source.mapInArrow(run, "doc_id long, ids array<int>, begins array<int>, ends array<int>")


def encoding_digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32`` of the same encoding, without the arrays.

    ``spans_crc32`` is over the pieces' end bytes in the source as little-endian 64-bit numbers. Nulls as in
    :func:`encode_documents`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in slices(batches):
            n, ids, decoded, spans = [], [], [], []
            end = np.array([c.eos], np.int64)
            for texts in grouped(plain_texts(batch.column(1))):
                for pieces, ends in c.encode_batch(texts):
                    all_ids = np.concatenate([pieces.astype(np.int64), end])
                    n.append(len(all_ids))
                    ids.append(hashlib.sha256(c.joined(all_ids).encode()).hexdigest())
                    decoded.append(hashlib.sha256(c.decode(all_ids.tolist()).encode()).hexdigest())
                    spans.append(zlib.crc32(ends.astype("<i8").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string()), pa.array(spans, pa.int64())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"],
            )

    source = slim(docs, [id_col, text_col]).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return source.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long")
