"""Quality rules: document statistics, a few fixed limits, and boosted trees trained on labelled documents."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import boosting
from tradewind.llm.util import arrow_batches, text_or_empty

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "word_length", "symbols", "repeats", "duplicate_lines", "upper", "shouts", "pipes", "digits",
            "variety", "runs", "top_word", "line_symbols", "line_upper", "line_shouts"]
#: Statistics of junk: the score may only fall when one of these rises.
FALLING = ["symbols", "repeats", "duplicate_lines", "shouts", "runs", "line_symbols", "line_shouts"]
SCHEMA = ", ".join([*(f"{c} long" for c in BASE), *(f"{c} double" for c in FEATURES)])
#: Labelled documents that the trees are fitted on at most, and the share of them that is held out to set the threshold.
SAMPLE, HELD_OUT = 20_000, 0.2

_UPPER, _DIGITS, _SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>"


def _share(data: bytes, chars: bytes, of: int) -> float:
    return (len(data) - len(data.translate(None, chars))) / max(of, 1)


def measure(text: str) -> tuple:
    """Base counts and features of one text; an empty one has zeros. Takes time in proportion to the text (and a sort)."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # at spaces and \x09-\x0D
    if not words:
        return (0,) * len(BASE) + (0.0,) * len(FEATURES)
    chars = len(text) - sum(text.count(c) for c in " \t\n\r\x0b\x0c")
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    repeated = 0
    if len(ids) >= 3:
        pair = np.unique(ids[:-2] * len(seen) + ids[1:-1], return_inverse=True)[1]
        _, which, count = np.unique(pair * len(seen) + ids[2:], return_inverse=True, return_counts=True)
        again = count[which] > 1
        hit = np.zeros(len(ids), bool)
        for k in range(3):
            hit[k:len(again) + k] |= again
        repeated = int(np.count_nonzero(hit))
    lines = [x for x in data.split(b"\n") if x.strip()]
    duplicates = len(lines) - len(set(lines))
    worst = [0.0, 0.0, 0.0]
    for line in set(lines):
        if line.count(b" ") >= 3:
            of = len(line) - line.count(b" ")
            worst = [max(w, _share(line, c, of)) for w, c in zip(worst, (_SYMBOLS, _UPPER, b"!"))]
    n = len(words)
    return (n, chars, symbols, duplicates, repeated,
            float(np.log1p(n)), chars / n, symbols / max(chars, 1), repeated / n, duplicates / len(lines),
            _share(data, _UPPER, chars), _share(data, b"!", n), _share(data, b"|", n), _share(data, _DIGITS, chars),
            len(seen) / n, float(np.mean(ids[1:] == ids[:-1])) if n > 1 else 0.0, float(np.bincount(ids).max() / n), *worst)


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` (of whose columns only ``text`` reaches Python) with the statistics in a column ``_stats``."""
    arrow_batches(docs.sparkSession)

    @F.pandas_udf(SCHEMA)
    def stats(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=[*BASE, *FEATURES])

    return docs.withColumn("_stats", stats(text_or_empty()))


@dataclass
class Model:
    forest: boosting.Forest
    threshold: float
    held_out: dict

    def keeps(self, features: np.ndarray) -> np.ndarray:
        return self.forest.score(features) >= self.threshold


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, good_kept: float = 0.999) -> Model:
    """Trees fitted on a bounded sample of the labelled documents.

    ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 bad, null ignored; several labels of a document: good only if all say
    so). The sample takes the ``sample`` ids of least hash, so its size doesn't grow; a repeated id counts once. A part is held out:
    the threshold is the highest score that keeps ``good_kept`` of its good documents, but never above even odds. Without labels
    of both kinds everything is kept.
    """
    order = F.xxhash64(F.lit(7), "doc_id")
    chosen = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("_good")).orderBy(order, "doc_id").limit(sample)
    rows = measured(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")).select(
        "doc_id", "_good", *[F.col("_stats")[f].alias(f) for f in FEATURES]).groupBy("doc_id").agg(
        F.max(F.struct("_good", *FEATURES)).alias("r")).select("doc_id", "r.*").toPandas()
    rows = rows.sort_values("doc_id")
    x, y = rows[FEATURES].to_numpy(float), (rows["_good"].to_numpy() > 0).astype(float)
    held = np.random.default_rng(7).random(len(rows)) < HELD_OUT
    falling = {FEATURES.index(f): -1 for f in FALLING}
    fitted = y[~held]
    if len(fitted) == 0 or fitted.min() == fitted.max():
        forest = boosting.Forest(np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)), 0.0)
        return Model(forest, -np.inf, {"rows": 0})
    forest = boosting.fit(x[~held], fitted, falling)
    scores = forest.score(x[held])
    good = scores[y[held] > 0]
    threshold = min(0.0, float(np.quantile(good, 1 - good_kept)) if len(good) else 0.0)
    kept = scores >= threshold
    return Model(forest, threshold, {"rows": int(held.sum()), "good_kept": float(kept[y[held] > 0].mean()) if len(good) else 1.0,
                                     "bad_rejected": float((~kept[y[held] == 0]).mean()) if (y[held] == 0).any() else 1.0})


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``score`` and ``kept``.

    ``docs`` has ``doc_id`` and ``text``; its other columns stay, except that one named like a column of the result is replaced.
    A null or empty text has zeros and fails the base rules. Repeated rows are judged alike; an empty table gives no rows.
    Base rules: a document of under 50 words fails, and one with over half of its words in repeated 3-word windows.
    """
    model = train(docs, labels, sample)
    forest, threshold = model.forest, model.threshold

    @F.pandas_udf("double")
    def score(stats: pd.DataFrame) -> pd.Series:
        return pd.Series(forest.score(stats[FEATURES].to_numpy(float)))

    rows = measured(docs)
    rows = rows.withColumn("_score", score(F.col("_stats")))
    out = rows.withColumns({c: F.col("_stats")[c] for c in BASE})
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("score", F.col("_score")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("_score") >= F.lit(threshold))).drop("_stats", "_score")


def kept(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with the columns of ``docs`` as they are."""
    named = docs.select("doc_id", "text", F.struct(*[F.col(c) for c in docs.columns]).alias("_row"))
    return judge(named, labels, sample).where("kept").select("_row.*")
