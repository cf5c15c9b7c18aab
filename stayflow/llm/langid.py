"""Language identification with error-correcting output codes.

Every language has a codeword of bits. For each bit a binary classifier over hashed byte
n-grams learns to tell the languages whose bit is set from the others. A text is given the
language whose codeword is nearest, by the logistic losses of all bits, each weighted by
how well that bit is told for that language. Where no codeword is near, or two are about
equally near, the text is flagged as ambiguous.

The classifiers are fitted on a bounded sample of about ``SAMPLE_ROWS`` ids, the same
number for each language but at least about ``LEAST_ROWS``, drawn by a hash of the id; the
smallest hash of a language is always drawn, so that every language is learned that has a
row with a letter in the learning folds. Of an id with several rows one is learned from.
Ids, languages and sources are never inputs of a prediction.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is
everything if no language can be learned, but then :func:`keep_identified` keeps all texts
with a letter; with one language every text has it; repeated
rows each get a row; an empty table gives no rows; rows with a null language or id are not
learned from; columns named as the results are replaced.
"""
from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark.sql import DataFrame, functions as F

from stayflow.llm.text import append_columns, filter_rows, id_hash

BUCKETS = 4096
SAMPLE_ROWS = 2400
LEAST_ROWS = 5
FOLDS, HELD_FOLD = 4, 2
STEPS, RATE, RIDGE = 160, 0.3, 1e-4
UNKNOWN = "und"
NEAR_SCORE = 0.5
FIELDS = "lang_pred string, score double, ambiguous boolean"

_ORDERS = (1, 2, 3)
_MIX = np.uint32(2654435761)
# ASCII signs and digits are taken as white space.
_TABLE = bytes(b if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def features(texts: list[str]) -> np.ndarray:
    """Root relative frequencies of hashed byte n-grams of the letters of each text."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for row, text in zip(out, texts):
        data = np.frombuffer(b" " + b" ".join(text.lower().encode().translate(_TABLE).split()) + b" ", np.uint8).astype(np.uint32)
        counts = np.zeros(BUCKETS, np.int64)
        gram = np.zeros(len(data), np.uint32)
        for n in _ORDERS:
            gram = (gram[: len(data) - n + 1] << np.uint32(8)) + data[n - 1 :] if n > 1 else data + np.uint32(1)
            key = ((gram + np.uint32(n << 28)) * _MIX) >> np.uint32(20)
            counts += np.bincount(key, minlength=BUCKETS)
        row[:] = np.sqrt(counts / max(1, counts.sum()))
    return out


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """Bits of +1 and -1 for ``n`` classes: all distinct splits of up to 7 classes, else the best of random codes."""
    if n <= 7:
        splits = [(1, *rest) for rest in product((1, -1), repeat=n - 1)]
        return np.array([s for s in splits if min(s) < 0], np.int8).reshape(-1, n).T
    rng, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, apart = None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        far = (bits - code.astype(np.int32) @ code.T.astype(np.int32)) // 2
        least = far[~np.eye(n, dtype=bool)].min()
        mixed = (code.min(axis=0) < 0).all() and (code.max(axis=0) > 0).all()
        if mixed and least > apart:
            best, apart = code, least
    return best


@dataclass
class Model:
    """Languages, their codewords, the bits' classifiers and the weights of each bit by language."""

    langs: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of each row against each codeword."""
        f = x @ self.weights + self.bias
        near, far = np.logaddexp(0, -f), np.logaddexp(0, f)
        set_, unset = self.trust * (self.code > 0), self.trust * (self.code < 0)
        return near @ set_.T + far @ unset.T

    def predict(self, texts: list[str | None]) -> dict[str, list]:
        out = {"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts), "ambiguous": [True] * len(texts)}
        real = [i for i, t in enumerate(texts) if has_letter(t)] if self.langs else []
        for part in (real[i : i + 256] for i in range(0, len(real), 256)):
            loss = self.losses(features([texts[i] for i in part])) if len(self.langs) > 1 else np.zeros((len(part), 1))
            odds = np.exp(-max(1, self.code.shape[1]) * (loss - loss.min(axis=1, keepdims=True)))
            best = loss.argmin(axis=1)
            score = 1.0 / odds.sum(axis=1)
            for i, b, s, d in zip(part, best.tolist(), score.tolist(), loss.min(axis=1).tolist()):
                out["lang_pred"][i], out["score"][i] = self.langs[b], s
                out["ambiguous"][i] = s < NEAR_SCORE or d > float(np.log(2))
        return out


def fit(x: np.ndarray, langs: list[str]) -> Model:
    """Logistic classifiers of all bits at once, by gradient steps with momentum."""
    names = sorted(set(langs))
    code = codewords(len(names)) if len(names) > 1 else np.zeros((len(names), 0), np.int8)
    weights, bias = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    if not code.shape[1]:
        return Model(names, code, weights, bias, np.zeros(code.shape))
    at = np.searchsorted(names, langs)
    y = code[at].astype(np.float32)
    share = 1.0 / np.bincount(at)[at].astype(np.float32)
    share = (share / share.sum())[:, None]
    scale = 1.0 / np.sqrt((x**2).mean(axis=0) + 1e-4)
    z = x * scale
    rate = RATE / float((z**2).sum(axis=1).mean()) * 4
    speed, speed_b = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(STEPS):
        pull = share * y / (1 + np.exp(np.clip(y * (z @ weights + bias), -30, 30)))
        speed = 0.9 * speed + z.T @ pull - RIDGE * weights
        speed_b = 0.9 * speed_b + pull.sum(axis=0)
        weights += rate * speed
        bias += rate * speed_b
    right = (y * (z @ weights + bias) > 0).astype(np.float64)
    trust = np.stack([right[at == k].mean(axis=0) for k in range(len(names))]) + 1e-3
    return Model(names, code, (weights * scale[:, None]).astype(np.float32), bias, trust / trust.sum(axis=1, keepdims=True))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits on a bounded sample of the rows of the learning folds."""
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & F.col(id_col).isNotNull() & (id_hash(id_col) % FOLDS != HELD_FOLD))
    place = F.pmod(F.xxhash64(F.lit("sample"), id_col), F.lit(1 << 30)) / F.lit(float(1 << 30))
    counts = {r[0]: (r[1], r[2]) for r in rows.groupBy(lang_col).agg(F.approx_count_distinct(id_col), F.min(place)).collect()}
    if not counts:
        return fit(np.zeros((0, BUCKETS), np.float32), [])
    each = max(LEAST_ROWS, sample_rows // len(counts))
    share = F.create_map(*(F.lit(v) for k, (n, least) in counts.items() for v in (k, max(least, min(1.0, 1.1 * each / max(1, n))))))
    drawn = rows.filter(place <= share[F.col(lang_col)]).groupBy(F.col(lang_col).alias("lang_true"), F.col(id_col).alias("__id"))
    chosen = drawn.agg(F.min(F.struct(F.xxhash64(text_col), F.col(text_col).alias("text"))).alias("least")).select("lang_true", F.col("least.text").alias(text_col))

    def make():
        def compute(texts):
            kept = [t if has_letter(t) else None for t in texts]
            x = features([t or "" for t in kept]).astype(np.float16)
            return {"x": [row.tobytes() if t is not None else None for row, t in zip(x, kept)]}

        return compute

    found = append_columns(chosen, text_col, make, "x binary", ["lang_true"]).filter("x IS NOT NULL").orderBy(F.xxhash64("x")).collect()
    x = np.frombuffer(b"".join(bytes(r.x) for r in found), np.float16).reshape(-1, BUCKETS).astype(np.float32)
    return fit(x, [r.lang_true for r in found])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, ambiguous) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return append_columns(docs, text_col, lambda: shared.value.predict, FIELDS, [id_col])


def identify_all(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """As :func:`identify`, learned from the documents themselves, with the fold each row is in."""
    found = identify(docs, learn(docs, id_col, text_col, lang_col), id_col, text_col)
    held = F.coalesce(id_hash(id_col) % FOLDS == HELD_FOLD, F.lit(False))
    return found.select(id_col, held.alias("held_out"), "lang_pred", "score", "ambiguous")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents, with all their columns, whose language is told without ambiguity; those with a letter if no language can be learned."""
    model = learn(docs, id_col, text_col, lang_col)
    if not model.langs:
        return filter_rows(docs, text_col, lambda: lambda texts: [has_letter(t) for t in texts])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda texts: [not x for x in shared.value.predict(texts)["ambiguous"]]

    return filter_rows(docs, text_col, make)
