"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs.

Inputs of a word are its own vector and the vectors of its character n-grams (with its left edge), pooled by the largest,
the smallest and the summed coordinates, and its length. The vectors belong to words and n-grams that tell the classes of
the labelled sample apart significantly, found through exact 64-bit hashes; they are trained with the network. Their first
coordinate starts at the shrunken log-odds, for a training text those of the other folds, and the others at random. A text
is read in windows of ``WINDOW`` words, each sharing half with the next; the network scores every window of the whole
text, and the text's score is a logistic function of its largest window score, the mean of its three largest and its
number of windows. Training is in numpy: windows are chosen again in each round by the network itself (multiple instances).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import plain_texts, slices, slim
from docmill.llm.textbytes import Words, groups, labelled_sample

WINDOW, STRIDE, HIDDEN = 32, 16, 8
#: Coordinates of the vector of a word or n-gram, and inputs of a word made of them.
DIM = 3
INPUTS = 4 * DIM + 1
GRAMS = (4, 6, 9)
#: Labelled rows of each class that are learned from at most.
SAMPLE_PER_CLASS = 800
FOLDS, LEAST_DOCS, LEAST_Z, LEXICON = 4, 3, 2.25, 30_000
#: ASCII but for letters parts words; letters are lower-cased before.
TABLE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def _word_hashes(w: Words) -> np.ndarray:
    return w.span_hashes(w.starts, w.ends, 1)


def _gram_places(w: Words, size: int) -> np.ndarray:
    """Positions whose ``size`` bytes lie in one word, its left edge counted as a byte."""
    inner = w.separators_before()
    n = len(w.buffer)
    return np.flatnonzero(inner[size:] == inner[1 : n - size + 2]) if n >= size else np.zeros(0, np.int64)


def _gram_hashes(w: Words, size: int, places: np.ndarray) -> np.ndarray:
    return w.span_hashes(places, places + size, size)


class Vocabulary:
    """Words and n-grams that have a vector, by 64-bit hash in ascending order; a bitmap answers most look-ups without a search."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions that are known, and their numbers."""
        at = np.flatnonzero(self.filter[(hashes >> np.uint64(44)).astype(np.int64)])
        if not len(at):
            return at, at
        k = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[k] == hashes[at]
        return at[same], k[same]

    def __reduce__(self):
        return Vocabulary, (self.keys,)


class Hits:
    """Which words of a run have a vector, which n-grams of which words do (in the order of words), and the words' lengths."""

    def __init__(self, w: Words, vocabulary: Vocabulary):
        self.word_at, self.word_key = vocabulary.find(_word_hashes(w))
        at, keys = [], []
        for size in GRAMS:
            places = _gram_places(w, size)
            hit, key = vocabulary.find(_gram_hashes(w, size, places))
            at.append(np.searchsorted(w.starts - 1, places[hit], side="right") - 1)
            keys.append(key)
        order = np.argsort(np.concatenate(at), kind="stable")
        self.gram_at, self.gram_key = np.concatenate(at)[order], np.concatenate(keys)[order]
        self.lengths = (np.minimum(w.ends - w.starts, 20) / 10).astype(np.float32)

    def inputs(self, word_vectors: np.ndarray, gram_vectors: np.ndarray) -> np.ndarray:
        """A row of inputs for each word from the vectors of the hits."""
        x = np.zeros((len(self.lengths), INPUTS), np.float32)
        x[self.word_at, :DIM] = word_vectors
        x[:, -1] = self.lengths
        if len(self.gram_at):
            first = np.flatnonzero(np.r_[True, self.gram_at[1:] != self.gram_at[:-1]])
            at = self.gram_at[first]
            x[at, DIM : 2 * DIM] = np.maximum(np.maximum.reduceat(gram_vectors, first), 0)
            x[at, 2 * DIM : 3 * DIM] = np.minimum(np.minimum.reduceat(gram_vectors, first), 0)
            x[at, 3 * DIM : 4 * DIM] = np.clip(np.add.reduceat(gram_vectors, first) / 4, -4, 4)
        return x

    def gradients(self, x: np.ndarray, dx: np.ndarray, gram_vectors: np.ndarray, n: int) -> np.ndarray:
        """Gradients of ``n`` vectors from those of the inputs."""
        v, up, at = gram_vectors, dx[self.gram_at], x[self.gram_at]
        part = np.where((v == at[:, DIM : 2 * DIM]) & (v > 0), up[:, DIM : 2 * DIM], 0)
        part = part + np.where((v == at[:, 2 * DIM : 3 * DIM]) & (v < 0), up[:, 2 * DIM : 3 * DIM], 0)
        part += np.where(np.abs(at[:, 3 * DIM : 4 * DIM]) < 4, up[:, 3 * DIM : 4 * DIM] / 4, 0)
        keys = np.concatenate([self.word_key, self.gram_key])
        each = np.concatenate([dx[self.word_at, :DIM], part])
        return np.stack([np.bincount(keys, weights=each[:, d], minlength=n) for d in range(DIM)], axis=1).astype(np.float32)

    def of_words(self, words: np.ndarray, keep: np.ndarray, keep_gram: np.ndarray) -> tuple[Hits, np.ndarray, np.ndarray]:
        """The hits of the listed words, numbered anew, of those that are to be kept; and which hits they are."""
        out = object.__new__(Hits)
        out.lengths = self.lengths[words]
        parts = []
        for at, live in ((self.word_at, keep), (self.gram_at, keep_gram)):
            low, high = np.searchsorted(at, words), np.searchsorted(at, words, side="right")
            new = np.repeat(np.arange(len(words)), high - low)
            hit = np.arange(len(new)) - np.repeat(np.cumsum(high - low) - high, high - low)
            parts.append((new[live[hit]], hit[live[hit]]))
        (out.word_at, word_hit), (out.gram_at, gram_hit) = parts
        out.word_key, out.gram_key = self.word_key[word_hit], self.gram_key[gram_hit]
        return out, word_hit, gram_hit


def word_inputs(w: Words, vocabulary: Vocabulary, vectors: np.ndarray) -> np.ndarray:
    """A row of inputs for each word."""
    hits = Hits(w, vocabulary)
    return hits.inputs(vectors[hits.word_key], vectors[hits.gram_key])


def window_starts(n: int) -> np.ndarray:
    """Starts of the windows of a text of ``n`` words; the last ends with the text. A text without words has one."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    return np.unique(np.r_[np.arange(0, n - WINDOW, STRIDE), n - WINDOW])


def windows(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and text of every window."""
    full = w.counts > WINDOW
    per = np.where(full, -(-(w.counts - WINDOW) // STRIDE) + 1, 1)
    text = np.repeat(np.arange(len(w.counts)), per)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    start = np.minimum(nth * STRIDE, np.maximum(w.counts[text] - WINDOW, 0))
    return w.firsts[text] + start, np.minimum(w.counts[text], WINDOW), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Network:
    """Parameters: for each direction the input, recurrent and bias weights of the gates; attention; the output layer."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {}
        for d in ("f", "b"):
            self.p |= {f"W{d}": normal(INPUTS, 3 * HIDDEN, scale=0.3), f"U{d}": normal(HIDDEN, 3 * HIDDEN, scale=0.3), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"a": normal(2 * HIDDEN, scale=0.3), "o": normal(2 * HIDDEN, scale=0.3), "k": np.zeros(1, np.float32)}

    def forward(self, x: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, keep: bool = False):
        """Logit of each window of the words ``x``; with ``keep`` also what the backward pass needs."""
        n, h = len(firsts), HIDDEN
        steps = int(sizes.max(initial=1))
        inside = np.arange(steps)[None] < sizes[:, None]
        whole = bool(inside.all())
        at = np.minimum(firsts[:, None] + np.arange(steps)[None], max(len(x) - 1, 0))
        if not len(x):
            x = np.zeros((1, INPUTS), np.float32)
        low, high = int(at.min(initial=0)), int(at.max(initial=0)) + 1
        if high - low > at.size:  # windows from all over: only their words
            x, at = x[at.ravel()], np.arange(at.size).reshape(at.shape)
        else:
            x, at = x[low:high], at - low
        out = np.zeros((steps, n, 2 * h), np.float32)
        tape = []
        for k, d in enumerate(("f", "b")):
            gates_in, u = x @ self.p[f"W{d}"] + self.p[f"c{d}"], self.p[f"U{d}"]
            state = np.zeros((n, h), np.float32)
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                g, a = gates_in[at[:, t]], state @ u
                zr = _sigmoid(g[:, : 2 * h] + a[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                c = np.tanh(g[:, 2 * h :] + r * a[:, 2 * h :])
                new = c + z * (state - c)
                if not whole:
                    new = np.where(inside[:, t, None], new, state)
                if keep:
                    tape.append((d, t, state, z, r, c, a[:, 2 * h :]))
                state = new
                out[t, :, k * h : (k + 1) * h] = state
        e = out @ self.p["a"]
        e = np.where(inside.T, e, np.float32(-1e9))
        e = np.exp(e - e.max(axis=0))
        share = e / e.sum(axis=0)
        pooled = (share[:, :, None] * out).sum(axis=0)
        logit = pooled @ self.p["o"] + self.p["k"]
        return (logit, (x, at, inside, out, share, pooled, tape)) if keep else logit

    def gradients(self, dlogit: np.ndarray, kept) -> dict[str, np.ndarray]:
        """Gradients of the parameters, and under ``x`` of the inputs if the windows' words stand one after the other."""
        x, at, inside, out, share, pooled, tape = kept
        h = HIDDEN
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        # A word stands once at a step, so adding by index loses nothing; what is outside a window goes to a row of its own.
        dx = np.zeros((len(x) + 1, x.shape[1]), x.dtype)
        to = np.where(inside, at, len(x))
        g["o"], g["k"] = pooled.T @ dlogit, dlogit.sum(keepdims=True)
        dpool = dlogit[:, None] * self.p["o"]
        dout = share[:, :, None] * dpool
        dshare = (out * dpool).sum(axis=2)
        de = share * (dshare - (share * dshare).sum(axis=0))
        g["a"] = np.einsum("tn,tnh->h", de, out)
        dout += de[:, :, None] * self.p["a"]
        carry = {"f": np.zeros((len(dlogit), h), np.float32), "b": np.zeros((len(dlogit), h), np.float32)}
        for d, t, state, z, r, c, an in reversed(tape):
            k = 0 if d == "f" else 1
            dh = dout[t, :, k * h : (k + 1) * h] + carry[d]
            live = inside[:, t, None]
            rest, dh = np.where(live, 0, dh), np.where(live, dh, 0)
            dz, dc = dh * (state - c), dh * (1 - z)
            dn = dc * (1 - c * c)
            dr = dn * an
            da = np.concatenate([dz * z * (1 - z), dr * r * (1 - r), dn * r], axis=1)
            dg = np.concatenate([da[:, : 2 * h], dn], axis=1)
            g[f"U{d}"] += state.T @ da
            g[f"W{d}"] += x[at[:, t]].T @ dg
            dx[to[:, t]] += dg @ self.p[f"W{d}"].T
            g[f"c{d}"] += dg.sum(axis=0)
            carry[d] = dh * z + da @ self.p[f"U{d}"].T + rest
        g["x"] = dx[:-1]
        return g


class Adam:
    """Running moments of named parameters; ``rates`` are theirs where they differ from the common one."""

    def __init__(self, params: dict[str, np.ndarray], rate: float, rates: dict[str, float] | None = None):
        self.params, self.rate, self.rates, self.n = params, rate, rates or {}, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.n += 1
        for k, p in self.params.items():
            self.m[k] += 0.1 * (g[k] - self.m[k])
            self.v[k] += 0.01 * (g[k] ** 2 - self.v[k])
            p -= self.rates.get(k, self.rate) * (self.m[k] / (1 - 0.9**self.n)) / (np.sqrt(self.v[k] / (1 - 0.99**self.n)) + 1e-8)


def _text_features(text: str) -> np.ndarray:
    """Distinct hashes of the words and n-grams of a text."""
    w = Words([text.lower().encode("utf-8", "replace")], TABLE)
    parts = [_word_hashes(w), *(_gram_hashes(w, size, _gram_places(w, size)) for size in GRAMS)]
    return np.unique(np.concatenate(parts))


def _counted(features: list[np.ndarray], toxic: np.ndarray, fold: np.ndarray, parts: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Keys in at least ``LEAST_DOCS`` texts, and their numbers of texts by fold and label. Hashes are counted range by range."""
    edges = np.array([k * (2**64 // parts) for k in range(1, parts)], np.uint64)
    cuts = [np.r_[0, np.searchsorted(f, edges), len(f)] for f in features]
    often = []
    for k in range(parts):
        h = np.sort(np.concatenate([f[c[k] : c[k + 1]] for f, c in zip(features, cuts, strict=True)]))
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
        often.append(h[first[np.diff(np.r_[first, len(h)]) >= LEAST_DOCS]])
    keys = np.concatenate(often)
    counts = np.zeros((FOLDS, 2, len(keys)), np.int32)
    for f, y, k in zip(features, toxic, fold, strict=True):
        if len(keys):
            at = np.minimum(np.searchsorted(keys, f), len(keys) - 1)
            counts[k, y, at[keys[at] == f]] += 1
    return keys, counts


def _log_odds(counts: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shrunken log-odds of each key, zero where not significant, and their distance from zero in standard errors."""
    a, b = counts[1] + 0.5, counts[0] + 0.5
    odds = np.log(a / (totals[1] + 1)) - np.log(b / (totals[0] + 1))
    z = odds / np.sqrt(1 / a + 1 / b)
    good = (np.abs(z) >= LEAST_Z) & (counts.sum(axis=0) >= LEAST_DOCS)
    return np.where(good, np.clip(odds, -5, 5), 0).astype(np.float32), np.abs(z) * good


class Model:
    """What scores texts: vocabulary, vectors and network, or one constant where one class had no rows to learn from."""

    def __init__(self, vocabulary: Vocabulary | None, vectors: np.ndarray | None, net: Network | None, constant: float = 0.0, pooling: np.ndarray | None = None):
        self.vocabulary, self.vectors, self.net, self.constant, self.pooling = vocabulary, vectors, net, constant, pooling

    def score(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.constant)
        if self.net is None:
            return out
        for first, raws in groups([t.lower() for t in texts]):
            w = Words(raws, TABLE)
            logit = window_logits(self.net, word_inputs(w, self.vocabulary, self.vectors), w)
            out[first : first + len(raws)] = _sigmoid(text_inputs(logit, windows(w)[2], len(raws)) @ self.pooling)
        return out


def text_inputs(logit: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """For each text a one, its largest window score, the mean of its three largest, and the logarithm of its windows."""
    order = np.lexsort((-logit, text))
    place = np.arange(len(order)) - np.searchsorted(text[order], text[order])
    top = order[place < 3]
    count = np.bincount(text, minlength=n)
    mean = np.bincount(text[top], weights=logit[top], minlength=n) / np.minimum(count, 3)
    return np.stack([np.ones(n), logit[order[place == 0]], mean, np.log(count)], axis=1)


#: The share of toxic texts that the final score supposes; the sample itself has more of them than a corpus.
TOXIC_SHARE = 0.2


def logistic(x: np.ndarray, y: np.ndarray, share: float = TOXIC_SHARE, ridge: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Weights of a ridge logistic regression in which label 1 has ``share`` of the weight (Newton's method)."""
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w = np.zeros(x.shape[1])
    w[1] = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) / len(y) + ridge * (w - np.eye(len(w))[1])
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(w))
        w = w - np.linalg.solve(hess, grad)
    return w


def network_logits(net: Network, x: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, size: int = 4096) -> np.ndarray:
    return np.concatenate([net.forward(x, firsts[i : i + size], sizes[i : i + size]) for i in range(0, len(firsts), size)])


def window_logits(net: Network, x: np.ndarray, w: Words) -> np.ndarray:
    return network_logits(net, x, *windows(w)[:2])


#: Steps of training in each round, windows of a step, rates of the network and of the vectors, and the share of hits left out.
STEPS, BATCH, RATE, VECTOR_RATE, LEFT_OUT = 150, 128, 0.02, 0.005, 0.1


def fit(texts: list[str], toxic: list[int], rounds: int = 4, seed: int = 7) -> Model:
    """Model from labelled texts; with no toxic or no clean text it is the share of toxic ones (0 without any)."""
    y = np.array(toxic, np.int64)
    if not len(y) or y.min() == y.max():
        return Model(None, None, None, float(y.mean()) if len(y) else 0.0)
    rng = np.random.default_rng(seed)
    fold = np.zeros(len(y), np.int64)
    for value in (0, 1):
        rows = rng.permutation(np.flatnonzero(y == value))
        fold[rows] = np.arange(len(rows)) % FOLDS
    keys, counts = _counted([_text_features(t) for t in texts], y, fold)
    totals = np.array([[((fold == k) & (y == v)).sum() for v in (0, 1)] for k in range(FOLDS)])
    odds, strength = _log_odds(counts.sum(axis=0), totals.sum(axis=0))
    chosen = np.sort(np.argsort(-strength, kind="stable")[: min(LEXICON, int((strength > 0).sum()))])
    vocabulary = Vocabulary(keys[chosen])
    vectors = (rng.standard_normal((len(chosen), DIM)) * 0.1).astype(np.float32)
    vectors[:, 0] = odds[chosen]
    # What a text of a fold must add to the first coordinate, so that it starts at what the other folds say.
    shift = np.stack([_log_odds(counts[np.arange(FOLDS) != k].sum(axis=0)[:, chosen], totals[np.arange(FOLDS) != k].sum(axis=0))[0] for k in range(FOLDS)]) - odds[chosen]

    w = Words([t.lower().encode("utf-8", "replace") for t in texts], TABLE)
    hits = Hits(w, vocabulary)
    fold_of = fold[w.text_of]

    def seen(part: Hits, word_hit: np.ndarray, gram_hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        word, gram = vectors[part.word_key], vectors[part.gram_key]
        word[:, 0] += shift[fold_of[hits.word_at[word_hit]], part.word_key]
        gram[:, 0] += shift[fold_of[hits.gram_at[gram_hit]], part.gram_key]
        return word, gram

    def everything() -> np.ndarray:
        return hits.inputs(*seen(hits, np.arange(len(hits.word_at)), np.arange(len(hits.gram_at))))

    net = Network(seed)
    firsts, sizes, owner = windows(w)
    adam = Adam(net.p | {"vectors": vectors}, RATE, {"vectors": VECTOR_RATE})
    for n in range(rounds):
        x_all = everything()
        told = np.r_[0, np.cumsum(x_all[:, 0] + x_all[:, DIM])]
        logit = told[firsts + sizes] - told[firsts] if n == 0 else network_logits(net, x_all, firsts, sizes)
        order = np.lexsort((-logit, owner))
        place = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        windows_in = order[place < np.where(y[owner[order]] == 1, 1, 3)]
        clean = np.flatnonzero(y[owner] == 0)
        windows_in = np.unique(np.r_[windows_in, rng.choice(clean, min(2000, len(clean)), replace=False)])
        target_of = y[owner].astype(np.float32)
        share = target_of[windows_in].mean()
        for _ in range(STEPS):
            rows = rng.choice(windows_in, min(BATCH, len(windows_in)), replace=False)
            # The words of the windows one after the other, so that each window has its own.
            words = np.repeat(firsts[rows] - np.cumsum(sizes[rows]) + sizes[rows], sizes[rows]) + np.arange(int(sizes[rows].sum()))
            part, word_hit, gram_hit = hits.of_words(words, rng.random(len(hits.word_at)) >= LEFT_OUT, rng.random(len(hits.gram_at)) >= LEFT_OUT)
            word, gram = seen(part, word_hit, gram_hit)
            x = part.inputs(word, gram)
            out, kept = net.forward(x, np.cumsum(sizes[rows]) - sizes[rows], sizes[rows], True)
            target = target_of[rows]
            weight = np.where(target == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
            g = net.gradients(((_sigmoid(out) - target) * weight / len(rows)).astype(np.float32), kept)
            dx = g["x"]
            g["vectors"] = part.gradients(x, dx, gram, len(vectors)) if len(x) else np.zeros_like(vectors)
            adam.step(g)
    logit = network_logits(net, everything(), firsts, sizes)
    return Model(vocabulary, vectors, net, pooling=logistic(text_inputs(logit, owner, len(texts)), y))


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Model from at most ``per_class`` labelled documents of each class, never those whose crc32 remainder by 3 is 1."""
    rows = labelled_sample(docs, labels, "toxic", 3, 1, False, per_class, ["text"])
    return fit([r["text"] or "" for r in rows], [r["toxic"] for r in rows])


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``doc_id, score`` of every whole text; null counts as empty, repeated rows and null ids are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(plain_texts(batch.column(1))))], names=["doc_id", "score"])

    source = slim(docs, [id_col, text_col]).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return source.mapInArrow(run, "doc_id long, score double")


def held_out(modulus: int, remainder: int):
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


THRESHOLD = 0.7


def score_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows ``doc_id, held_out, score, predicted`` of every document.

    Null text is scored as empty, and an empty, blank or very short text like any other (one window, perhaps without
    words); repeated rows are scored each, and equal texts get equal scores; a null id counts as not held out; an empty
    table gives no rows. Without labelled rows of both classes the score is the share of toxic ones (0 without any).
    """
    return scores(docs, train(docs, labels)).select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs``, all columns, without the documents whose text is predicted toxic."""
    model = train(docs, labels)

    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(model.score(plain_texts(batch.column(at))) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
