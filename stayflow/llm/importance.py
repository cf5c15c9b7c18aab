"""Importance resampling towards a target distribution, with an exact cut.

Features are runs of words, hashed to buckets. Counts of the buckets in the documents (the
source) and in the benchmark (the target) are added up in one array per task; the gains of
the buckets, whole numbers, are one array that every task is sent, and a document's weight
is the sum of the gains of its features. Gumbel noise from a hash of the id makes the
highest scores a draw without replacement.

The cut is found without sorting all scores. A quantile sketch gives a bracket of scores
around the wanted rank; exact counts of the rows above and inside tell whether the cut lies
in it, and a bracket that misses it is widened, at last to all scores. Only the rows of the
bracket are sorted to locate the cut; the drawn rows are then ranked, range by range.

Defined cases: null, empty and word-less texts have no features and weight 0; a null id is
hashed as empty text and comes last among equal scores; repeated rows are rows of their own
and take ranks of their own; equal scores go by id, then by the number of features; an
empty target counts as zero in every bucket; an empty table gives no rows; a very long text
is counted run by run; only the named columns are read, so others do not matter.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stayflow.llm.terms import TERMS, Buckets, gram_runs, word_runs
from stayflow.llm.text import TEXT, append_columns, slices
from stayflow.operators.ordered import global_rank
from stayflow.session import materialize

BUCKETS = 10_000
LONGEST = 1
SALT = "2024"
PERCENT = 10
LEAST_WORDS = 20
SKETCH = 4096
SPREAD = 0.002  # half the bracket's share of ranks, more than the sketch's error


def features(text: str | None, longest: int) -> Iterator[list[bytes]]:
    """All runs of 1 to ``longest`` words; a text with too few words has none of that length."""
    yield from word_runs(text, TERMS)
    count = sum(map(len, word_runs(text, TERMS))) if longest > 1 else 0
    for words in range(2, longest + 1):
        if count >= words:
            yield from gram_runs(text, TERMS, words)


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, n) of the features of all texts, at most one row per bucket and task before the sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, places = np.zeros(buckets, np.int64), Buckets(buckets)
        for batch in batches:
            for part in slices(batch, TEXT):
                for text in part.column(TEXT).to_pylist():
                    for found in features(text, longest):
                        total += np.bincount(places.of(found), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype("int32")), pa.array(total[seen])], names=["bucket", "n"])

    source = df.select(F.col(f"`{text_col}`").cast("string").alias(TEXT))
    return source.mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def _dense(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for r in counts.collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    buckets, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    ratio = lambda s, t: float(t + 1) * float(s_all + buckets) / (float(s + 1) * float(t_all + buckets))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST) -> DataFrame:
    """(id, n_features, weight, n_words) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)  # one long per bucket

    def make():
        gain, places = shared.value, Buckets(len(gains))

        def compute(texts: list) -> dict:
            out = {"n_features": [], "weight": [], "n_words": []}
            for text in texts:
                n, weight = 0, 0
                for found in features(text, longest):
                    n += len(found)
                    weight += int(gain[places.of(found)].sum())
                out["n_features"].append(n)
                out["weight"].append(weight)
                out["n_words"].append(n if longest == 1 else sum(map(len, word_runs(text, TERMS))))
            return out

        return compute

    return append_columns(docs, text_col, make, "n_features long, weight long, n_words long", [id_col])


def gumbel(id_col: str, salt: str = SALT) -> Column:
    """Thousandths of a Gumbel draw, rounded down, from the SHA-256 of salt and id."""
    named = F.concat(F.lit(salt + ":"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0))).cast("bigint")


@dataclass(frozen=True)
class Bracket:
    """Scores from ``low`` to ``high`` hold the cut; ``above`` rows have a higher score."""

    low: int
    high: int
    above: int


def bracket(scores: DataFrame, wanted: int, total: int, sketch: int = SKETCH, spread: float = SPREAD) -> tuple[Bracket, int]:
    """A validated bracket around the ``wanted``-th highest of ``total`` scores, and how often it was widened."""
    made = scores.agg(F.kll_sketch_agg_bigint("score", F.lit(sketch)).alias("sketch"), F.min("score").alias("least"), F.max("score").alias("most"))
    made = materialize(made, "score-sketch")
    least, most = made.select("least", "most").first()
    place, tries = 1 - wanted / total, 0
    while True:
        ends = [min(max(place + side * spread, 0.0), 1.0) for side in (-1, 1)]
        low, high = made.select(*(F.kll_sketch_get_quantile_bigint("sketch", F.lit(e)) for e in ends)).first()
        low, high = (least if ends[0] <= 0 else low), (most if ends[1] >= 1 else high)
        above, inside = scores.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))).first()
        if above <= wanted <= above + inside:
            return Bracket(low, high, above), tries
        spread, tries = spread * 8, tries + 1


def draw(scored: DataFrame, id_col: str = "doc_id", percent: int = PERCENT, least_words: int = LEAST_WORDS, sketch: int = SKETCH, spread: float = SPREAD) -> DataFrame:
    """Adds ``rank``: 1, 2, 3 ... of the drawn rows by falling score, null for the others."""
    may = F.col("n_words") >= least_words
    total = scored.filter(may).count()
    wanted = total * percent // 100
    if not wanted:
        return scored.withColumn("rank", F.lit(None).cast("bigint"))
    cut, _ = bracket(scored.filter(may).select("score"), wanted, total, sketch, spread)
    order = [F.desc("score"), F.asc_nulls_last(f"`{id_col}`"), F.asc("n_features")]
    above = global_rank(scored.filter(may & (F.col("score") > cut.high)), order, "rank")
    inside = global_rank(scored.filter(may & F.col("score").between(cut.low, cut.high)), order, "rank")
    place = F.col("rank") + cut.above
    inside = inside.withColumn("rank", F.when(place <= wanted, place))
    rest = scored.filter(~may | (F.col("score") < cut.low)).withColumn("rank", F.lit(None).cast("bigint"))
    names = [*scored.columns, "rank"]
    return above.select(names).unionByName(inside.select(names)).unionByName(rest.select(names))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", buckets: int = BUCKETS,
    longest: int = LONGEST, salt: str = SALT, percent: int = PERCENT, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document."""
    source = _dense(bucket_counts(docs, text_col, buckets, longest), buckets)
    wanted = _dense(bucket_counts(target, target_text, buckets, longest), buckets)
    weighed = weigh(docs, bucket_gains(source, wanted), id_col, text_col, longest)
    scored = materialize(weighed.withColumn("score", F.col("weight") + gumbel(id_col, salt)), "scored")
    ranked = draw(scored, id_col, percent, least_words)
    return ranked.select(id_col, "n_features", "weight", "score", F.col("rank").cast("bigint").alias("rank"))
