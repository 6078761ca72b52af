"""Quality classifier: a second-order factorisation machine over hashed words, structure statistics and metadata.

Features of a text are its hashed words (lower-cased, with the share of the words they make up), hashed word endings,
standardised structure statistics and the length stated in the table's metadata. The score is
``w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)**2 - sum_i v_if**2 x_i**2)``: pairwise interactions of low rank in linear
time. Training is in numpy (Adam on mini-batches) over a bounded labelled sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import plain_texts, slices, slim
from docmill.llm.textbytes import Words, groups, labelled_sample
from docmill.llm.toxicity import held_out

BUCKETS = 1 << 15
RANK = 4
THRESHOLD = 0.3
#: Labelled rows of each class that are learned from at most.
SAMPLE_PER_CLASS = 1500
STATISTICS = (
    "log_bytes", "log_words", "mean_word", "upper_share", "digit_share", "mark_share", "pipe_share", "letter_share", "high_share", "line_share",
    "words_a_line", "distinct_share", "top_share", "mark_words", "long_words", "one_letter_words", "capital_words", "stop_share", "zero_words", "stated_length",
)
#: White space parts words.
TABLE = bytes(32 if b in b"\t\n\x0b\x0c\r " else b for b in range(256))
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
_HIGH = np.array([b >= 128 for b in range(256)])
_MARK = np.array([33 <= b < 127 and not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122) for b in range(256)])
_STOP = np.array([b in b".!?" for b in range(256)])


def _by_text(flags: np.ndarray, firsts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(flags, dtype=np.int64)]
    return total[ends] - total[firsts]


class Features:
    """Sparse word features (text, bucket, value) and the table of statistics of a run of texts."""

    def __init__(self, raws: list[bytes], lengths: np.ndarray):
        w = Words(raws, TABLE)
        lowered = Words([r.lower() for r in raws], TABLE)
        n = len(raws)
        original = np.frombuffer(b" " + b" ".join(raws) + b" ", np.uint8)
        sizes = np.array([len(r) for r in raws], np.int64)
        begins = np.cumsum(sizes + 1) - sizes
        ends = begins + sizes
        words = np.maximum(w.counts, 1)
        spans = w.ends - w.starts
        whole = lowered.span_hashes(lowered.starts, lowered.ends, 1)
        tails = w.span_hashes(np.maximum(w.starts, w.ends - 3), w.ends, 2)
        bucket = np.concatenate([whole, tails]) >> np.uint64(64 - 15)
        text = np.concatenate([w.text_of, w.text_of])
        key, count = np.unique((text << 15) | bucket.astype(np.int64), return_counts=True)
        self.text, self.bucket = key >> 15, key & (BUCKETS - 1)
        self.value = np.sqrt(count / words[self.text]).astype(np.float32)
        self.n = n
        mark_at = np.r_[0, np.cumsum(_MARK[w.buffer])]
        letter_at = np.r_[0, np.cumsum((_LETTER | _HIGH)[w.buffer])]
        marks = mark_at[w.ends] - mark_at[w.starts]
        first_byte, last_byte = w.buffer[w.starts], w.buffer[w.ends - 1]
        lines = _by_text(original == 10, begins, ends) + 1
        # 20 bits of text, 44 bits of hash: a run holds far fewer texts than that.
        pairs, repeats = np.unique((w.text_of.astype(np.uint64) << np.uint64(44)) | (whole >> np.uint64(20)), return_counts=True)
        owner = (pairs >> np.uint64(44)).astype(np.int64)
        top = np.zeros(n)
        np.maximum.at(top, owner, repeats)
        share = lambda flags: np.bincount(w.text_of, weights=flags, minlength=n) / words
        bytes_ = np.maximum(sizes, 1)
        self.table = np.stack([
            np.log1p(sizes), np.log1p(w.counts), np.bincount(w.text_of, weights=spans, minlength=n) / words,
            *(_by_text(flag[original], begins, ends) / bytes_ for flag in (_UPPER, _DIGIT, _MARK)), _by_text(original == 124, begins, ends) / words,
            *(_by_text(flag[original], begins, ends) / bytes_ for flag in (_LETTER, _HIGH)), lines / words, np.log1p(w.counts / lines),
            np.bincount(owner, minlength=n) / words, top / words, share(marks > 1), share(spans > 20), share(spans == 1), share(_UPPER[first_byte]),
            share(_STOP[last_byte]), share(letter_at[w.ends] == letter_at[w.starts]), np.log1p(np.maximum(np.where(np.isnan(lengths), sizes, lengths), 0)),
        ], axis=1).astype(np.float32)


class Model:
    """A factorisation machine; ``constant`` where one class had no rows to learn from."""

    def __init__(self, constant: float | None = None):
        self.constant = constant
        self.mean = np.zeros(len(STATISTICS), np.float32)
        self.scale = np.ones(len(STATISTICS), np.float32)
        size = BUCKETS + len(STATISTICS)
        self.bias = np.zeros(1, np.float32)
        self.w = np.zeros(size, np.float32)
        self.v = (np.random.default_rng(3).standard_normal((size, RANK)) * 0.02).astype(np.float32)

    def _rows(self, f: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        dense = np.clip((f.table - self.mean) / self.scale, -5, 5)
        k = len(STATISTICS)
        text = np.r_[f.text, np.repeat(np.arange(f.n), k)]
        feature = np.r_[f.bucket, np.tile(BUCKETS + np.arange(k), f.n)]
        order = np.argsort(text, kind="stable")
        return text[order], feature[order], np.r_[f.value, dense.ravel()][order]

    def logits(self, text: np.ndarray, feature: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits of texts 0.. (rows sorted by text) and the factor sums of each."""
        begin = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
        vx = self.v[feature] * value[:, None]
        sums = np.add.reduceat(vx, begin, axis=0)
        squares = np.add.reduceat(vx * vx, begin, axis=0)
        linear = np.add.reduceat(self.w[feature] * value, begin)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def score(self, texts: list[str], lengths: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        out = np.zeros(len(texts))
        for first, raws in groups(texts):
            f = Features(raws, lengths[first : first + len(raws)])
            z, _ = self.logits(*self._rows(f))
            out[first : first + len(raws)] = 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))
        return out


def fit(texts: list[str], lengths: np.ndarray, good: list[int], epochs: int = 25, rate: float = 0.02, decay: float = 1e-4, seed: int = 5) -> Model:
    """Model from labelled texts (1 good); without rows of both classes it is the share of good ones (1 without any)."""
    y = np.array(good, np.float32)
    if not len(y) or y.min() == y.max():
        return Model(float(y.mean()) if len(y) else 1.0)
    model, parts = Model(), []
    for first, raws in groups(texts):
        parts.append((first, Features(raws, lengths[first : first + len(raws)])))
    stats = np.concatenate([f.table for _, f in parts])
    model.mean, model.scale = stats.mean(axis=0), stats.std(axis=0) + 1e-3
    rows = [model._rows(f) for _, f in parts]
    text = np.concatenate([t + first for (first, _), (t, _, _) in zip(parts, rows, strict=True)])
    feature, value = np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows])
    begin = np.r_[np.flatnonzero(np.r_[True, text[1:] != text[:-1]]), len(text)]
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    rng = np.random.default_rng(seed)
    moments = {k: (np.zeros_like(p), np.zeros_like(p)) for k, p in (("w", model.w), ("v", model.v), ("bias", model.bias))}
    n = 0
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(y)), max(1, len(y) // 128)):
            at = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in batch])
            local = np.repeat(np.arange(len(batch)), begin[batch + 1] - begin[batch])
            feat, val = feature[at], value[at]
            z, sums = model.logits(local, feat, val)
            d = ((1 / (1 + np.exp(-z)) - y[batch]) * weight[batch] / len(batch)).astype(np.float32)
            used, back = np.unique(feat, return_inverse=True)
            gw = np.bincount(back, weights=d[local] * val, minlength=len(used))
            gv = np.stack([
                np.bincount(back, weights=d[local] * val * (sums[local, k] - model.v[feat, k] * val), minlength=len(used)) for k in range(RANK)
            ], axis=1)
            n += 1
            for name, g, rows_ in (("w", gw, used), ("v", gv, used), ("bias", d.sum(keepdims=True), slice(None))):
                p = getattr(model, name)
                m, s = moments[name]
                g = g + (decay * p[rows_] if name != "bias" else 0)
                m[rows_] = 0.9 * m[rows_] + 0.1 * g
                s[rows_] = 0.99 * s[rows_] + 0.01 * g * g
                p[rows_] -= rate * (m[rows_] / (1 - 0.9**n)) / (np.sqrt(s[rows_] / (1 - 0.99**n)) + 1e-7)
    return model


def _with_length(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n_chars``; a table without a length column has null lengths."""
    if "n_chars" in docs.columns:
        return slim(docs, ["doc_id", "text", "n_chars"]).withColumn("n_chars", F.col("n_chars").cast("double"))
    return slim(docs, ["doc_id", "text"]).withColumn("n_chars", F.lit(None).cast("double"))


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Model from at most ``per_class`` labelled documents of each class, never those whose crc32 remainder by 5 is 0."""
    rows = labelled_sample(_with_length(docs), labels, "quality", 5, 0, False, per_class, ["text", "n_chars"])
    lengths = np.array([np.nan if r["n_chars"] is None else r["n_chars"] for r in rows], float)
    return fit([r["text"] or "" for r in rows], lengths, [r["quality"] for r in rows])


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """Rows ``doc_id, score`` of every whole text; null text counts as empty, a null stated length as the real one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lengths = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(plain_texts(batch.column(1)), lengths))], names=["doc_id", "score"])

    return _with_length(docs).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, "doc_id long, score double")


def score_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows ``doc_id, held_out, score, predicted`` of every document.

    Null text is scored as empty and a null stated length as the real one; empty and short texts have their statistics
    alone; repeated rows are scored each; a null id counts as not held out; an empty table gives no rows. Without labelled
    rows of both classes the score is the share of good ones (1 without any).
    """
    return scores(docs, train(docs, labels)).select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject_poor(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs``, all columns, without the documents whose text is predicted poor."""
    model = train(docs, labels)

    at = docs.columns.index("text")
    stated = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            known = batch.column(stated).to_pylist() if stated is not None else [None] * batch.num_rows
            lengths = np.array([np.nan if n is None else n for n in known], float)
            yield batch.filter(pa.array(model.score(plain_texts(batch.column(at)), lengths) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
