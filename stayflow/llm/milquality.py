"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Each passage is encoded by a
small network from counts of its bytes, byte pairs and words. Gated attention gives every
passage a weight, learned from the labels of whole documents only, and the document's
score comes from the weighted mean of its passages' encodings.

The network is fitted on a bounded sample: about ``SAMPLE_DOCS`` labelled documents, of
each at most ``SAMPLE_PASSAGES`` passages, evenly spaced; of an id with several rows one
is learned from. Scoring reads all passages.
Labels, ids, languages and sources are never inputs of a score.

Defined cases: null and empty texts are one empty passage and get its score; a document
with several labels has their mean; rows with a null label or id are not learned from;
without two kinds of labels the score is the share of good ones, or 0.5; repeated rows
each get a row; an empty table gives no rows; columns named as the results are replaced.
"""
from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, functions as F

from stayflow.llm.text import append_columns, id_hash

PASSAGE_WORDS = 64
BLOCK_BYTES = 512 << 10
SAMPLE_DOCS, SAMPLE_PASSAGES = 4000, 128
FOLDS, HELD_FOLD = 5, 0
THRESHOLD = 0.3
HIDDEN, GATE = 24, 12
EPOCHS, BATCH_DOCS, RATE = 14, 64, 0.004
FIELDS = "score double, predicted int"

_PAIRS = 64
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def _byte_classes() -> np.ndarray:
    """Signs by themselves; digits, small letters, capitals, other controls and non-ASCII together."""
    kinds = np.zeros(256, np.int64)
    kinds[48:58], kinds[97:123], kinds[65:91], kinds[128:] = 1, 2, 3, 4
    signs = [b for b in (9, 10, 32, *range(33, 127)) if not chr(b).isalnum()]
    kinds[signs] = 5 + np.arange(len(signs))
    return kinds


_KINDS = _byte_classes()
_N_KINDS = int(_KINDS.max()) + 1
_N_STATS = 7
WIDTH = _N_KINDS + _PAIRS + _N_STATS


def _blocks(raw: bytes) -> list[bytes]:
    """A text in parts of at most ``BLOCK_BYTES``, cut after white space where there is any."""
    out = []
    while len(raw) > BLOCK_BYTES:
        cut = max(raw.rfind(w, 0, BLOCK_BYTES) for w in (b" ", b"\n")) + 1 or BLOCK_BYTES
        out.append(raw[:cut])
        raw = raw[cut:]
    return [*out, raw]


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and how many passages each text has; passages don't cross blocks."""
    blocks = [(i, b) for i, t in enumerate(texts) for b in _blocks((t or "").encode())]
    found, counts = [], np.zeros(len(texts), np.int64)
    part, size = [], 0
    for n, (i, block) in enumerate(blocks, 1):
        part.append((i, block))
        size += len(block)
        if size >= BLOCK_BYTES or n == len(blocks):
            x, count = _features([b for _, b in part])
            found.append(x)
            np.add.at(counts, [k for k, _ in part], count)
            part, size = [], 0
    return np.concatenate(found) if found else np.zeros((0, WIDTH), np.float32), counts


def _features(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of some blocks, and how many each block has."""
    data = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raws])
    white = _WHITE[data]
    starts = np.flatnonzero(~white & np.concatenate([[True], white[:-1]]))
    stops = np.flatnonzero(white & np.concatenate([[False], ~white[:-1]]))
    doc = np.searchsorted(ends, starts, side="right")
    n_words = np.bincount(doc, minlength=len(raws))
    first = np.cumsum(n_words) - n_words
    count = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    base = np.cumsum(count) - count
    of_word = base[doc] + (np.arange(len(starts)) - first[doc]) // PASSAGE_WORDS
    n = int(count.sum())
    # a byte belongs to the passage of the last word that began, or to its text's first passage
    of_byte = np.repeat(base, np.diff(np.concatenate([[0], ends])))
    last = np.cumsum(~white & np.concatenate([[True], white[:-1]])) - 1
    inside = last >= 0
    of_byte[inside] = np.maximum(of_byte[inside], of_word[last[inside]]) if len(of_word) else of_byte[inside]
    text_end = np.zeros(len(data), bool)
    text_end[ends - 1] = True
    of_byte = of_byte[~text_end]
    body = data[~text_end]
    size = np.bincount(of_byte, minlength=n)
    per = 1.0 / np.maximum(1, size)[:, None]
    kinds = np.bincount(of_byte * _N_KINDS + _KINDS[body], minlength=n * _N_KINDS).reshape(n, _N_KINDS) * per
    low = np.where((body >= 65) & (body <= 90), body + 32, body).astype(np.uint32)
    pair = ((low[:-1] * np.uint32(256) + low[1:]) * np.uint32(2654435761)) >> np.uint32(26)
    within = of_byte[1:] == of_byte[:-1]
    pairs = np.bincount(of_byte[1:][within] * _PAIRS + pair[within], minlength=n * _PAIRS).reshape(n, _PAIRS) * per
    stats = _word_stats(data, starts, stops, doc, of_word, n, size)
    return np.hstack([np.sqrt(kinds), np.sqrt(pairs), stats]).astype(np.float32), count


def _word_stats(data, starts, stops, doc, of_word, n: int, size: np.ndarray) -> np.ndarray:
    """Length, mean word length, different words, words equal to the one before, triples repeated in the block, capitalised and all-capital words."""
    out = np.zeros((n, _N_STATS))
    out[:, 0] = np.log1p(size) / 6
    if not len(starts):
        return out
    length = stops - starts
    place = np.arange(int(starts[0]), int(stops[-1])) - np.repeat(starts, np.diff(np.concatenate([starts, [stops[-1]]])))
    body = data[starts[0] : stops[-1]]
    powers = np.cumprod(np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
    low = np.where((body >= 65) & (body <= 90), body + 32, body).astype(np.uint64)
    code = np.add.reduceat(np.where(_WHITE[body], np.uint64(0), (low + np.uint64(1)) * powers[place]), starts - starts[0])
    words = np.bincount(of_word, minlength=n)
    per = 1.0 / np.maximum(1, words)
    out[:, 1] = np.bincount(of_word, length, n) * per / 8
    keys = code ^ (of_word.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    different = np.unique(keys, return_index=True)[1]
    out[:, 2] = np.bincount(of_word[different], minlength=n) * per
    if len(code) > 1:
        same = (code[1:] == code[:-1]) & (doc[1:] == doc[:-1])
        out[:, 3] = np.bincount(of_word[1:][same], minlength=n) * per
    if len(code) > 2:
        triple = (code[:-2] * np.uint64(3) + code[1:-1]) * np.uint64(0x165667B19E3779F9) + code[2:] + doc[2:].astype(np.uint64) * np.uint64(0x27D4EB2F165667C5)
        _, inverse, seen = np.unique(triple, return_inverse=True, return_counts=True)
        again = (seen[inverse] > 1) & (doc[2:] == doc[:-2])
        out[:, 4] = np.bincount(of_word[2:][again], minlength=n) * per
    capital = (data[starts] >= 65) & (data[starts] <= 90)
    out[:, 5] = np.bincount(of_word[capital], minlength=n) * per
    shout = capital & (length > 1) & (data[np.minimum(starts + 1, len(data) - 1)] >= 65) & (data[np.minimum(starts + 1, len(data) - 1)] <= 90)
    out[:, 6] = np.bincount(of_word[shout], minlength=n) * per
    return out


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, np.cumsum(counts) - counts, axis=0)


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(v, -30, 30)))


@dataclass
class Model:
    """Scaling, encoder, gated attention and output layer; ``constant`` replaces them where nothing could be learned."""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH, np.float32))
    scale: np.ndarray = field(default_factory=lambda: np.ones(WIDTH, np.float32))
    p: dict[str, np.ndarray] = field(default_factory=dict)
    constant: float | None = None

    def forward(self, z: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        """All layers' values for passages ``z``, ``counts`` of them for each document."""
        p = self.p
        h = np.tanh(z @ p["E"] + p["e"])
        u, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        a = (u * g) @ p["w"]
        top = np.maximum.reduceat(a, np.cumsum(counts) - counts)
        raised = np.exp(a - np.repeat(top, counts))
        weight = raised / np.repeat(_sums(raised, counts), counts)
        bag = _sums(weight[:, None] * h, counts)
        return {"h": h, "u": u, "g": g, "weight": weight, "bag": bag, "score": _sigmoid(bag @ p["o"] + p["b"])}

    def gradients(self, z: np.ndarray, counts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy."""
        p, f = self.p, self.forward(z, counts)
        d_out = (f["score"] - y) / len(y)
        d_bag = np.repeat(d_out[:, None] * p["o"], counts, axis=0)
        d_weight = (d_bag * f["h"]).sum(axis=1)
        mean = np.repeat(_sums(f["weight"] * d_weight, counts), counts)
        d_a = f["weight"] * (d_weight - mean)
        d_u = d_a[:, None] * p["w"] * f["g"] * (1 - f["u"] ** 2)
        d_g = d_a[:, None] * p["w"] * f["u"] * f["g"] * (1 - f["g"])
        d_h = (f["weight"][:, None] * d_bag + d_u @ p["V"].T + d_g @ p["U"].T) * (1 - f["h"] ** 2)
        return {
            "E": z.T @ d_h, "e": d_h.sum(axis=0), "V": f["h"].T @ d_u, "U": f["h"].T @ d_g,
            "w": (f["u"] * f["g"]).T @ d_a, "o": f["bag"].T @ d_out, "b": d_out.sum(keepdims=True),
        }

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        x, counts = passages(texts)
        return self.forward((x - self.mean) * self.scale, counts)["score"].astype(np.float64)


def fit(bags: list[np.ndarray], y: np.ndarray, seed: int = 11) -> Model:
    """Adam over small batches of documents; ``bags`` are their passages' features."""
    if not len(y) or (y > 0.5).all() or (y <= 0.5).all():
        return Model(constant=float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    everything = np.concatenate(bags)
    model = Model(everything.mean(axis=0), (1.0 / (everything.std(axis=0) + 0.02)).astype(np.float32))
    init = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
    p = model.p = {"E": init(WIDTH, HIDDEN), "e": np.zeros(HIDDEN, np.float32), "V": init(HIDDEN, GATE), "U": init(HIDDEN, GATE), "w": init(GATE), "o": init(HIDDEN), "b": np.zeros(1, np.float32)}
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    counts, step = np.array([len(b) for b in bags]), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in (order[i : i + BATCH_DOCS] for i in range(0, len(order), BATCH_DOCS)):
            step += 1
            z = (np.concatenate([bags[i] for i in at]) - model.mean) * model.scale
            for k, d in model.gradients(z, counts[at], y[at]).items():
                d = d + 1e-4 * p[k]
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.99 * v[k] + 0.01 * d * d
                p[k] = (p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fits on a bounded sample of the labelled documents of the learning folds."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (id_hash(id_col) % FOLDS != HELD_FOLD))
    known = known.groupBy(F.col(id_col).alias("__id")).agg(F.avg(label_col).alias("label"))
    place = F.pmod(F.xxhash64(F.lit("sample"), "__id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = known.filter(place < min(1.0, sample_docs / max(1, known.count())))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(chosen, "__id")
    rows = rows.groupBy("__id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least")).select("__id", "label", F.col("least.text").alias(text_col))

    def make():
        def compute(texts):
            x, counts = passages(texts)
            first = np.cumsum(counts) - counts
            spread = [a + np.unique(np.linspace(0, c - 1, min(c, SAMPLE_PASSAGES)).astype(int)) for a, c in zip(first, counts)]
            return {"x": [x[s].tobytes() for s in spread]}

        return compute

    found = append_columns(rows, text_col, make, "x binary", ["__id", "label"]).orderBy(F.xxhash64("__id"), F.xxhash64("x")).collect()
    return fit([np.frombuffer(bytes(r.x), np.float32).reshape(-1, WIDTH) for r in found], np.array([r.label for r in found], np.float32))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, score, predicted) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def compute(texts):
            found = shared.value.scores(texts)
            return {"score": found, "predicted": (found >= threshold).astype(np.int32)}

        return compute

    return append_columns(docs, text_col, make, FIELDS, [id_col])


def score_all(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """As :func:`score`, with a model learned from the labels and the fold each row is in."""
    found = score(docs, learn(docs, labels, id_col, text_col, label_col), id_col, text_col)
    held = F.coalesce(id_hash(id_col) % FOLDS == HELD_FOLD, F.lit(False))
    return found.select(id_col, held.alias("held_out"), "score", "predicted")
