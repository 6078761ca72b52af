"""Secret scans: fixed patterns, and a battery of randomness tests for strings that no pattern names.

A candidate string is given the smallest encoding that holds its characters (hex, letters, base32, base36, alphanumeric,
base64; those of one case apart). Three tests ask whether it could be uniform random text of that encoding: chi-squared
over equal slices of the alphabet, the number of runs above and below the alphabet's middle, and the correlation of
neighbouring symbols. Bonferroni combines their p-values into one, the battery's; a string that the battery rejects is
left alone. The opposite hypothesis, ordinary writing, is a fixed letter model with persistent character classes; the
likelihood ratio of uniform text against it is an e-value. Times the battery's p-value, which is at most one, it is an
e-value still, so its inverse is a valid p-value against ordinary writing that the battery shares in: the less uniform a
string, the weaker its case. Long strings earn small p-values. Benjamini-Hochberg over the candidates of the document,
with weights that grow with length, controls the share of false discoveries.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import plain_texts, slices, slim

KINDS = ("assign", "access", "hex", "random")
#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 6
#: Greedy runs, so asking for the least length in the pattern finds the same spans.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Alphabets in order of size; a candidate takes the first that holds it.
ENCODINGS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "letters": "abcdefghijklmnopqrstuvwxyz",
    "LETTERS": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "lower32": "abcdefghijklmnopqrstuvwxyz234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "Letters": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "alnum": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-",
}
#: Per mille of the letters a to z in ordinary Latin-script writing.
LETTER_SHARES = [82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1]
#: Chances of the class of the next character in ordinary writing, names in mixed case among it: small letters, capitals,
#: digits and joining marks (a, A, 0, -) after each of them.
CLASS_CHANCES = {
    "a": {"a": 0.83, "A": 0.1, "0": 0.02, "-": 0.05}, "A": {"a": 0.5, "A": 0.44, "0": 0.02, "-": 0.04},
    "0": {"a": 0.04, "A": 0.04, "0": 0.87, "-": 0.05}, "-": {"a": 0.5, "A": 0.2, "0": 0.1, "-": 0.2},
}
ONE_CASE = ("letters", "LETTERS")
#: The battery's combined p-value below which a string is no random text.
BATTERY_LEVEL = 0.001
FDR = 0.001
_INDEX = {name: {c: i for i, c in enumerate(alphabet)} for name, alphabet in ENCODINGS.items()}


def infer_encoding(token: str) -> str | None:
    body = set(token.rstrip("="))
    return next((name for name, index in _INDEX.items() if body <= index.keys()), None)


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi_tail(x: float, k: int) -> float:
    """Upper tail of chi-squared with ``k`` degrees of freedom (cube-root normal approximation)."""
    z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(token: str, encoding: str) -> tuple[float, float, float]:
    """P-values of the uniformity, runs and serial-correlation tests of a string in its encoding."""
    index = _INDEX[encoding]
    values = np.array([index[c] for c in token.rstrip("=")])
    n, size = len(values), len(index)
    slices = max(2, min(size, n // 5, 8))
    counts = np.bincount(values * slices // size, minlength=slices)
    shares = np.bincount(np.arange(size) * slices // size, minlength=slices) / size
    chi = _chi_tail(float(((counts - n * shares) ** 2 / (n * shares)).sum()), slices - 1)
    high = values * 2 >= size
    ones = int(high.sum())
    if ones in (0, n):
        runs = 2.0**-n * 2
    else:
        mean = 2 * ones * (n - ones) / n + 1
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        runs = _normal_tail((1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(var))
    centred = values - values.mean()
    power = float((centred**2).sum())
    serial = _normal_tail((float((centred[1:] * centred[:-1]).sum()) / power + 1 / n) * math.sqrt(n)) if power else 0.0
    return chi, runs, serial


def writing_evidence(token: str, encoding: str) -> float:
    """Log likelihood ratio of uniform text in the encoding against ordinary writing.

    In an encoding of letters of one case both have no other class to go to, so the changes of class tell nothing.
    """
    total = sum(LETTER_SHARES)
    uniform = -math.log(len(ENCODINGS[encoding]))
    out, last = 0.0, None
    for c in token.rstrip("="):
        kind = "a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if c.isdigit() else "-"
        move = 0.0 if encoding in ONE_CASE else math.log(CLASS_CHANCES[last][kind] if last else 0.25)
        inside = math.log(LETTER_SHARES[ord(c.lower()) - 97] / total) if kind in "aA" else -math.log(10 if kind == "0" else 4)
        out += uniform - move - inside
        last = kind
    return out


def random_strings(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of candidate strings of ``text``, outside ``taken`` spans, that the battery and the discovery control keep."""
    found: list[tuple[int, int, float]] = []
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        if any(s < end and start < e for s, e in taken):
            continue
        token = m[0]
        encoding = infer_encoding(token)
        uniform = min(1.0, 3 * min(battery(token, encoding))) if encoding else 0.0
        found.append((start, end, writing_evidence(token, encoding) + math.log(uniform) if uniform >= BATTERY_LEVEL else -1.0))
    if not any(e > 0 for *_, e in found):
        return []
    weights = np.array([min(e - s, 256) for s, e, _ in found], float)
    weights /= weights.mean()
    p = np.minimum(1.0, np.exp(-np.maximum([e for *_, e in found], 0.0)) / weights)
    p[[e <= 0 for *_, e in found]] = 1.0
    order = np.argsort(p, kind="stable")
    passed = np.flatnonzero(p[order] <= FDR * np.arange(1, len(p) + 1) / len(p))
    keep = sorted(order[: passed[-1] + 1].tolist()) if len(passed) else []
    return [found[k][:2] for k in keep]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the fixed patterns, by start and then kind."""
    out: list[tuple[int, int, str]] = []
    lower = text.lower()
    if any(w in lower for w in ("passw", "secret", "token", "api")):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    out += [(*m.span(), "hex") for m in HEX.finditer(text)]
    out.sort(key=lambda x: (x[0], KINDS.index(x[2])))
    return out


def scan(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Spans of the fixed patterns, and all spans with those the battery adds, in code points with exclusive ends."""
    base = base_spans(text)
    added = [(s, e, "random") for s, e in random_strings(text, [x[:2] for x in base])]
    return base, sorted(base + added, key=lambda x: (x[0], KINDS.index(x[2])))


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, e, kind in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` of every whole text.

    Null text counts as empty; no row depends on another, so repeated rows and null ids are kept as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts: list[list[int]] = [[], [], [], []]
            base_sha, spans = [], []
            for text in plain_texts(batch.column(1)):
                base, every = scan(text)
                for k, kind in enumerate(KINDS):
                    counts[k].append(sum(x[2] == kind for x in every))
                base_sha.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(every))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(base_sha, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    source = slim(docs, [id_col, text_col]).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return source.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string")


def redact(text: str) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are replaced together."""
    out, at = [], 0
    for s, e, kind in scan(text)[1]:
        if s >= at:
            out += [text[at:s], f"[{kind}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact_documents(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with all its columns, secrets replaced in ``text_col`` and ``length_col`` (where there is one) made to fit.

    Null texts stay null; texts without secrets stay as they are.
    """

    at = docs.columns.index(text_col)
    stated = docs.columns.index(length_col) if length_col and length_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t if t is None else redact(t) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.column(at).type)
            if stated is not None:
                known = batch.column(stated)
                columns[stated] = pa.array([n if t is None else len(t) for t, n in zip(texts, known.to_pylist(), strict=True)], known.type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
