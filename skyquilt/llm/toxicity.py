"""A classifier chain over toxicity categories.

Categories are predicted one after another by linear models on the words of a text. The model of a later
category also gets the log-odds of the earlier ones. In training these come from models that haven't seen the
row (out-of-fold), so that the later model sees earlier predictions as good as they will be on new texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a model is fitted on at most: those whose hashed doc_id is smallest.
FIT_ROWS = 12_000
FOLDS = 5
#: Words that a category's model looks at, at most, and rows that a word must be in.
WORDS, LEAST = 4096, 4
THRESHOLD = 0.4
#: Words, and runs of other characters.
_WORD = re.compile(r"[^\W_]+|[^\w\s]+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass
class Link:
    """One category's model: a weight for each hashed word, one for each earlier category, and a bias."""

    name: str
    weights: dict[int, float]
    chain: np.ndarray
    bias: float


def _fit(rows: list[np.ndarray], extra: np.ndarray, y: np.ndarray) -> tuple[dict[int, float], np.ndarray, float]:
    """Logistic regression on the words that set the categories apart most clearly."""
    who = np.repeat(np.arange(len(rows)), list(map(len, rows)))
    words, at = np.unique(np.concatenate([*rows, np.empty(0, np.uint32)]), return_inverse=True)
    n1, n0 = max(y.sum(), 1), max(len(y) - y.sum(), 1)
    c1, c0 = np.bincount(at, y[who], len(words)), np.bincount(at, 1 - y[who], len(words))
    p1, p0 = (c1 + 0.5) / (n1 + 1), (c0 + 0.5) / (n0 + 1)
    z = np.abs(np.log(p1 / p0)) / np.sqrt(1 / (c1 + 0.5) + 1 / (c0 + 0.5))
    z[c1 + c0 < LEAST] = 0
    use = np.argsort(-z, kind="stable")[:WORDS]
    use = use[z[use] > 2]
    index = np.full(len(words), -1)
    index[use] = np.arange(len(use))
    keep = index[at] >= 0
    row, col, k = who[keep], index[at[keep]], len(use)
    n, m = k + extra.shape[1], len(y)
    w, b = np.zeros(n), np.log(n1 / n0)
    mean, square = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, 201):  # Adam on the whole sample, with a falling rate
        s = np.bincount(row, w[col], m) + extra @ w[k:] + b
        g = 1 / (1 + np.exp(-np.clip(s, -30, 30))) - y
        grad = np.append(np.concatenate([np.bincount(col, g[row], k), extra.T @ g]) + 0.02 * w, g.sum())
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        move = mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8) * 0.2 / (1 + step / 40)
        w, b = w - move[:-1], b - move[-1]
    w, v = w[:k], w[k:]
    return dict(zip(words[use].tolist(), w.tolist(), strict=True)), v, float(b)


def _score(rows: list[np.ndarray], extra: np.ndarray, model: tuple[dict[int, float], np.ndarray, float]) -> np.ndarray:
    weights, v, b = model
    return np.array([sum(weights.get(x, 0.0) for x in own.tolist()) for own in rows]) + extra @ v + b


def fit_chain(documents: DataFrame, labels: DataFrame, categories: list[str], fit_rows: int = FIT_ROWS) -> list[Link]:
    """Fits the chain, in the order of ``categories``, on the labelled documents.

    ``labels`` has doc_id and a column of 0 and 1 for each category; rows with a null, and labels without a
    document, are left out; of labels that contradict one another, and of rows that repeat a doc_id, the larger label and the
    smallest text count. The sample is bounded by ``fit_rows``; so is what is broadcast and collected: hashed distinct words. Without a labelled document every bias is -30, so that nothing is predicted.
    """
    usable = labels.selectExpr("cast(doc_id as long) as doc_id", *(f"cast({c} as int) as y{k}" for k, c in enumerate(categories))).na.drop()
    usable = usable.groupBy("doc_id").agg(*(F.max(f"y{k}").alias(f"y{k}") for k in range(len(categories))))
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.array([xxhash.xxh32_intdigest(w) for w in words_of(x.as_py())], "<u4").tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), *batch.columns[2:]], ["doc_id", "words", *batch.schema.names[2:]])

    kept = documents.selectExpr("cast(doc_id as long) as doc_id", "text").join(F.broadcast(sample), "doc_id")
    kept = kept.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), *(F.max(f"y{k}").alias(f"y{k}") for k in range(len(categories))))
    kind = "doc_id long, words binary, " + ", ".join(f"y{k} int" for k in range(len(categories)))
    got = sorted(map(tuple, kept.mapInArrow(hashed, kind).collect()))  # at most fit_rows rows
    rows = [np.frombuffer(x[1], "<u4") for x in got]
    fold = np.array([xxhash.xxh32_intdigest(str(x[0])) % FOLDS for x in got], int)
    extra, chain = np.zeros((len(rows), 0)), []
    for k, name in enumerate(categories):
        y = np.array([x[2 + k] for x in got], float)
        if not len(y) or y.min() == y.max():
            chain.append(Link(name, {}, np.zeros(k), 30.0 if len(y) and y[0] else -30.0))
            out = np.full(len(rows), chain[-1].bias)
        else:
            chain.append(Link(name, *_fit(rows, extra, y)))
            out = np.zeros(len(rows))
            for f in range(FOLDS if k + 1 < len(categories) else 0):
                own, rest = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
                if len(own) and len(rest):
                    out[own] = _score([rows[i] for i in own], extra[own], _fit([rows[i] for i in rest], extra[rest], y[rest]))
        extra = np.concatenate([extra, np.clip(out, -10, 10)[:, None]], 1)
    return chain


def scorer(chain: list[Link]):
    """A function from a column of texts to the probabilities of each, in the order of the chain."""
    seen: dict[str, tuple[float, ...] | None] = {}
    known = set().union(*(x.weights for x in chain))

    def score(texts: pa.Array) -> Iterator[list[float]]:
        for text in texts:
            own = []
            for w in words_of(text.as_py()):
                if w not in seen:
                    if len(seen) > 200_000:
                        seen.clear()
                    h = xxhash.xxh32_intdigest(w)
                    seen[w] = tuple(x.weights.get(h, 0.0) for x in chain) if h in known else None
                if seen[w]:
                    own.append(seen[w])
            odds: list[float] = []
            for k, x in enumerate(chain):
                earlier = sum(c * max(-10.0, min(10.0, o)) for c, o in zip(x.chain, odds, strict=True))
                odds.append(sum(v[k] for v in own) + float(earlier) + x.bias)
            yield [1 / (1 + math.exp(-max(-30.0, min(30.0, o)))) for o in odds]

    return score


def predict(documents: DataFrame, chain: list[Link]) -> DataFrame:
    """doc_id and a probability p_<name> for each category, of every row's whole text.

    A null or empty text has no words; a null doc_id stays null; repeated rows are predicted each. Other
    columns are ignored. What goes to the executors is the chain, of at most WORDS weights for each category.
    """
    score = scorer(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = list(score(batch.column(1)))
            columns = [pa.array([x[k] for x in out], pa.float64()) for k in range(len(chain))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *(f"p_{x.name}" for x in chain)])

    kind = "doc_id long, " + ", ".join(f"p_{x.name} double" for x in chain)
    return documents.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, kind)


#: The categories of the labels table: junk texts first, then toxic ones.
CATEGORIES = {"junk": "1 - quality", "toxic": "toxic"}


def toxic_documents(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, p_junk, p_toxic and rejected (p_toxic of at least ``threshold``) for every document."""
    known = labels.selectExpr("doc_id", *(f"{v} as {k}" for k, v in CATEGORIES.items()))
    scored = predict(documents, fit_chain(documents, known, list(CATEGORIES)))
    return scored.withColumn("rejected", F.col("p_toxic") >= threshold)


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` without those whose p_toxic is at least ``threshold``; rows and columns are left as they are."""
    known = labels.selectExpr("doc_id", *(f"{v} as {k}" for k, v in CATEGORIES.items()))
    chain = fit_chain(documents, known, list(CATEGORIES))
    names = [x for x in documents.columns if x != "text"]
    rows = documents.select("text", *names)
    score = scorer(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = [x[-1] >= threshold for x in score(batch.column(0))]
            yield batch.filter(pa.array([not x for x in toxic], pa.bool_()))

    return rows.mapInArrow(run, rows.schema).select(*documents.columns)
