"""Severity of toxicity by cumulative-link ordinal regression on sparse word features.

P(grade <= k) = sigmoid(threshold_k - w.x), one weight vector for all ordered
thresholds, x the set of a text's words. The model is fitted on a bounded sample of
labelled rows (those of least hash, at most `max_rows` with at most `max_bytes` of distinct words) by
proximal gradient steps with an L1 penalty and weights of at least 0 (a word
never makes a text milder, however long it is), so few words keep a weight;
scoring reads every document once, without a shuffle.

The labels are 0/1. Grades of toxic rows come from scores that their own labels took no
part in: the sample is halved, a model of the two classes is fitted on each
half, and the toxic rows of the other half are graded by its scores: 2 for the highest fifth, else 1.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from drawloom.llm.common import batch, ddl, keyed, pieces, raw, table
from drawloom.llm.names import mix
from drawloom.llm.ngram_join import shingle_sets

_WORD = re.compile(r"[^\W\d_]+")
_FEATURES = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("grade", pa.int32()), ("words", pa.string()), ("least", pa.list_(pa.int64()))])
_SCORE = pa.schema([("id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("expected_severity", pa.float64()), ("grade", pa.int32()), ("p_toxic", pa.float64()), ("toxic", pa.bool_())])


def _sigmoid(z):
    return 0.5 * (1 + np.tanh(0.5 * z))


@dataclass
class Model:
    weights: dict[str, float]
    thresholds: list[float]  # ascending; one fewer than grades

    def severity(self, texts: list[str]) -> np.ndarray:
        """P(grade > k) of each text for each threshold."""
        get = self.weights.get
        eta = np.array([sum(get(w, 0.0) for w in sorted(set(_WORD.findall(t.lower())) & self.weights.keys())) for t in texts])
        return _sigmoid(eta[:, None] - np.array(self.thresholds)[None, :])


def fit_features(words: list[list[str]], grades: np.ndarray, min_rows: int = 4, l1: float = 5e-5, steps: int = 200, step: float = 1.0) -> Model:
    """Fit on word sets and grades 0..K-1 (K-1 thresholds; at least two grades must occur)."""
    k = int(grades.max()) if len(grades) else 0
    if k < 1:
        return Model({}, [50.0])
    rows_with = Counter(w for ws in words for w in ws)
    vocab = {w: i for i, (w, n) in enumerate(sorted(rows_with.items(), key=lambda x: (-x[1], x[0]))) if n >= min_rows}
    lists = [[vocab[w] for w in ws if w in vocab] for ws in words]
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    column = np.fromiter((i for x in lists for i in x), np.int64, len(row))
    n, v = len(lists), len(vocab)
    # thresholds: the first, and the logarithms of the gaps to the next, so they stay in order
    share = np.clip([(grades > j).mean() for j in range(k)], 1e-3, 1 - 1e-3)
    logit = -np.log(share / (1 - share))
    shift = np.concatenate((logit[:1], np.log(np.maximum(np.diff(logit), 0.05))))
    w, seen_w, seen_s = np.zeros(v), np.full(v, 1e-12), np.full(k, 1e-12)
    for _ in range(steps):
        _, grad_w, grad_theta = likelihood(w, _ordered(shift), row, column, grades)
        tail = np.cumsum(grad_theta[::-1])[::-1]
        grad_s = np.concatenate((tail[:1], tail[1:] * np.exp(shift[1:])))
        seen_w += grad_w**2
        seen_s += grad_s**2
        rate = step / np.sqrt(seen_w)
        w = w - rate * grad_w
        w = np.maximum(w - rate * l1, 0)
        shift = shift - step / np.sqrt(seen_s) * grad_s
    names = list(vocab)
    return Model({names[i]: float(w[i]) for i in np.flatnonzero(w)}, _ordered(shift).tolist())


def likelihood(w: np.ndarray, theta: np.ndarray, row: np.ndarray, column: np.ndarray, grades: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood of the cumulative-link model and its gradients by w and theta; (row, column): the words of each row."""
    n, k = len(grades), len(theta)
    eta = np.bincount(row, w[column], n)
    edge = np.concatenate(([-np.inf], theta, [np.inf]))
    up, down = _sigmoid(edge[grades + 1] - eta), _sigmoid(edge[grades] - eta)
    p = np.maximum(up - down, 1e-12)
    d_up, d_down = up * (1 - up) / p, down * (1 - down) / p
    grad_w = np.bincount(column, (d_up - d_down)[row], len(w)) / n
    grad_theta = np.array([d_down[grades == j + 1].sum() - d_up[grades == j].sum() for j in range(k)]) / n
    return float(-np.log(p).mean()), grad_w, grad_theta


def _ordered(shift: np.ndarray) -> np.ndarray:
    return shift[0] + np.concatenate(([0.0], np.cumsum(np.exp(shift[1:]))))


def graded(toxic: np.ndarray, words: list[list[str]], at: tuple[float, ...] = (0.8,)) -> np.ndarray:
    """Severity grades from 0/1 labels, 0 for rows that are not toxic: of each half (every other row), toxic rows by the quantiles `at` of their scores by a model fitted on the other half; rows of equal scores have equal grades."""
    grades = (toxic > 0).astype(np.int64)
    half = np.arange(len(toxic)) % 2
    for h in (0, 1):
        there = np.flatnonzero(half != h)
        here = np.flatnonzero((half == h) & (toxic > 0))
        model = fit_features([words[i] for i in there], (toxic[there] > 0).astype(np.int64), steps=60)
        score = np.array([sum(model.weights.get(w, 0.0) for w in words[i]) for i in here])
        if len(here):
            cuts = np.quantile(score, at)
            grades[here] = 1 + (score[:, None] > cuts[None, :]).sum(1)
    return grades


def _features(batches):
    seeds = mix(np.arange(4, dtype=np.uint64), np.full(4, 9, np.uint64))
    for b in pieces(batches):
        texts = raw(b.column("text"))
        least = [[int((s * (z | np.uint64(1))).min().view(np.int64)) for z in seeds] if len(s) else [] for s in shingle_sets(texts)]
        yield batch(_FEATURES, b.column("k1"), b.column("k2"), b.column("grade"), [" ".join(sorted(set(_WORD.findall(t.decode().lower())))) for t in texts], least)


def sample_features(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, grade_col: str, max_rows: int, max_bytes: int) -> tuple[list, np.ndarray]:
    """Word sets and labels of the sample; near copies (an equal least shingle hash, of four) count once.

    A row whose own distinct words are over an eighth of max_bytes is not sampled.
    """
    lab = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{grade_col}`").cast("int").alias("grade")).where("id is not null and grade is not null")
    lab = lab.orderBy(F.xxhash64("id"), "id", "grade").limit(max_rows)
    # at most max_rows rows of two numbers are sent to the executors
    found = keyed(df, id_col, text_col).join(F.broadcast(lab), "id").select("k1", "k2", "grade", "text").mapInArrow(_features, ddl(_FEATURES))
    order = [F.xxhash64("k1"), F.col("k1"), F.col("k2"), F.col("grade")]
    found = found.where(F.octet_length("words") <= max_bytes // 8).orderBy(*order).limit(max_rows)
    # the window is over at most max_rows rows
    found = found.withColumn("size", F.sum(F.octet_length("words")).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    found = found.where(F.col("size") <= max_bytes).select("grade", "words", "least").toArrow()
    rows = sorted(zip(found.column("least").to_pylist(), found.column("words").to_pylist(), found.column("grade").to_pylist()))
    del found
    seen, same, words, grades = set(), {}, [], []
    for least, text, grade in rows:
        if not seen.intersection(least):
            words.append([same.setdefault(w, w) for w in text.split()])  # each word is kept once
            grades.append(grade)
        seen.update(least)
    return words, np.array(grades, np.int64)


def _scores(model: Model):
    def run(batches):
        for b in pieces(batches):
            above = model.severity([t.decode() for t in raw(b.column("text"))])
            grade = (above >= 0.5).sum(1).astype(np.int32)
            first = above[:, 0].round(6)
            yield batch(_SCORE, b.column("id"), b.column("k1"), b.column("k2"), above.sum(1).round(6), grade, first, first >= 0.5)

    return run


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, expected_severity, grade (the median one), p_toxic = P(grade > 0), toxic (p_toxic >= 0.5), and the row key k1, k2.

    Null and empty texts have no words and get the base rates. Each row is
    scored for itself, repeated ones too. Extra columns are not carried.
    """
    return keyed(df, id_col, text_col).mapInArrow(_scores(model), ddl(_SCORE)).withColumnRenamed("id", id_col)


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic", max_rows: int = 8000, max_bytes: int = 32 << 20) -> Model:
    """A model from 0/1 labels (see graded) of a sample of at most max_rows labelled rows and max_bytes of their distinct words. Without labels of both kinds nothing is toxic."""
    words, toxic = sample_features(df, labels, id_col, text_col, toxic_col, max_rows, max_bytes)
    return fit_features(words, graded(toxic, words))


def drop_toxic(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 8000) -> DataFrame:
    """The rows that are not toxic, with all columns: the model's verdict as a filter beside the columns, so without a join."""
    model = fit(df, labels, id_col, text_col, max_rows=max_rows)

    @F.pandas_udf("boolean")
    def clean(text):
        import pandas as pd

        return pd.Series(model.severity(text.fillna("").tolist())[:, 0].round(6) < 0.5)

    return df.where(clean(F.col(f"`{text_col}`").cast("string")))


def query(spark, sf_dir: str) -> DataFrame:
    """op1: see score; the model is fitted on `labels`."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels"))).drop("k1", "k2")
