"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are binned. Shallow trees are boosted in cycles, one feature
after the other, on the gradients of the logistic loss; each tree only adds to
the lookup table of its feature, so the model is a sum of tables. Pairs of
features with the largest gain on what is left get tables of their own. A score
is a sum of table values, added for a whole batch of texts at once.

Labels are used from a bounded sample: the ``fit_rows`` labelled documents with
the smallest hashes of their ids. Nothing but the text is an input of a score.

Defined results: a null text is empty and scored like any other; without labels
of both kinds every score is the share of label 1 among them (0.5 without any);
labels that are null are ignored; repeated rows come back repeated; input columns
named like result columns give way.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm.common import arrow_ready, map_texts, table, without

FIT_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 64, 12, 8
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1
LEAVES = 3
NAMES = ["log_words", "word_length", "distinct_words", "repeats_next", "short_words",
         "long_words", "upper", "digits", "points", "symbols", "bars", "not_ascii",
         "words_a_line", "equal_lines", "top_word", "marks_a_word"]

_SPACE, _LINE, _LOWER, _UPPER, _DIGIT, _POINT, _SYMBOL, _BAR, _HIGH = range(9)


def _classes() -> np.ndarray:
    kinds = np.full(256, _SYMBOL)
    kinds[128:] = _HIGH
    kinds[:33] = _SPACE
    kinds[10] = _LINE
    for chars, kind in ((b"abcdefghijklmnopqrstuvwxyz", _LOWER),
                        (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER),
                        (b"0123456789", _DIGIT), (b".,;:'\"?-()", _POINT), (b"|", _BAR)):
        kinds[list(chars)] = kind
    return kinds


def measure(texts: list[str]) -> np.ndarray:
    """The features of each text, one row each."""
    kinds = _classes()
    out = np.zeros((len(texts), len(NAMES)))
    for row, text in enumerate(texts):
        data = text.encode()
        words = data.split()
        n = max(len(words), 1)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        counts = np.bincount(kinds[np.frombuffer(data, np.uint8)], minlength=9)
        letters = max(counts[_LOWER] + counts[_UPPER] + counts[_HIGH], 1)
        size = max(len(data), 1)
        lines = [line for line in data.split(b"\n") if line.strip()]
        tally: dict[bytes, int] = {}
        for word in words:
            tally[word] = tally.get(word, 0) + 1
        marks = counts[_POINT] + counts[_SYMBOL] + counts[_BAR]
        out[row] = (
            np.log1p(len(words)), lengths.sum() / n, len(tally) / n,
            sum(map(bytes.__eq__, words, words[1:])) / n,
            (lengths <= 3).sum() / n, (lengths >= 14).sum() / n,
            counts[_UPPER] / letters, counts[_DIGIT] / size, counts[_POINT] / size,
            counts[_SYMBOL] / size, counts[_BAR] / size, counts[_HIGH] / size,
            len(words) / max(len(lines), 1), 1 - len(set(lines)) / max(len(lines), 1),
            max(tally.values(), default=0) / n, marks / n)
    return out


def _steps(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A tree of at most ``LEAVES`` leaves over ordered bins, as a value for each bin."""
    bounds = [0, len(gradient)]
    g, h = (np.concatenate([[0.0], np.cumsum(x)]) for x in (gradient, weight))

    def gain(a, b, c):
        return ((g[b] - g[a]) ** 2 / (h[b] - h[a] + 1) + (g[c] - g[b]) ** 2 / (h[c] - h[b] + 1)
                - (g[c] - g[a]) ** 2 / (h[c] - h[a] + 1))

    for _ in range(LEAVES - 1):
        best = (1e-9, None)
        for a, c in zip(bounds, bounds[1:]):
            if c - a > 1:
                inner = np.arange(a + 1, c)
                gains = gain(a, inner, c)
                if gains.max() > best[0]:
                    best = (gains.max(), int(inner[gains.argmax()]))
        if best[1] is None:
            break
        bounds = sorted([*bounds, best[1]])
    values = np.empty(len(gradient))
    for a, c in zip(bounds, bounds[1:]):
        values[a:c] = (g[c] - g[a]) / (h[c] - h[a] + 1)
    return values


def _quarters(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a grid into four parts: its gain, and a value for each cell."""
    g, h = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (gradient, weight))
    n, m = gradient.shape
    i, j = np.arange(1, n)[:, None], np.arange(1, m)[None, :]

    def part(t):
        left = t[i, j]
        return left, t[i, m] - left, t[n, j] - left, t[n, m] - t[i, m] - t[n, j] + left

    gains = sum(x ** 2 / (w + 1) for x, w in zip(part(g), part(h)))
    at = np.unravel_index(gains.argmax(), gains.shape)
    a, b = at[0] + 1, at[1] + 1
    values = np.empty((n, m))
    for rows in (slice(0, a), slice(a, n)):
        for columns in (slice(0, b), slice(b, m)):
            values[rows, columns] = (gradient[rows, columns].sum()
                                     / (weight[rows, columns].sum() + 1))
    return float(gains.max() - g[n, m] ** 2 / (h[n, m] + 1)), values


@dataclass
class Model:
    """Bin edges, a table for each feature, and tables for pairs of features."""

    base: float = 0.0
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pair_edges: list = field(default_factory=list)
    pairs: list = field(default_factory=list)  # (feature, feature, table)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for column, (edges, values) in enumerate(zip(self.edges, self.tables)):
            total += values[np.searchsorted(edges, x[:, column], "right")]
        for a, b, values in self.pairs:
            total += values[np.searchsorted(self.pair_edges[a], x[:, a], "right"),
                            np.searchsorted(self.pair_edges[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between values, at quantiles of the values and of the distinct values."""
    distinct = np.unique(values)
    both = np.concatenate([np.quantile(values, np.linspace(0, 1, bins // 2 + 1)[1:]),
                           np.quantile(distinct, np.linspace(0, 1, bins // 2 + 1)[1:])])
    return np.unique(both)


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Trains the model; ``y`` holds 0 and 1."""
    share = y.mean() if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        return Model(base=float(np.clip(np.log((share + 1e-6) / (1 - share + 1e-6)), -10, 10)))
    model = Model(base=float(np.log(share / (1 - share))))
    model.edges = [_edges(column, BINS) for column in x.T]
    model.pair_edges = [_edges(column, PAIR_BINS) for column in x.T]
    bins = [np.searchsorted(e, c, "right") for e, c in zip(model.edges, x.T)]
    coarse = [np.searchsorted(e, c, "right") for e, c in zip(model.pair_edges, x.T)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for values, at in zip(model.tables, bins):
            g, h = slopes()
            step = RATE * _steps(np.bincount(at, g, len(values)), np.bincount(at, h, len(values)))
            values += step
            total += step[at]

    def grid(a, b, of):
        n, m = len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1
        return np.bincount(coarse[a] * m + coarse[b], of, n * m).reshape(n, m)

    g, h = slopes()
    usable = [i for i, e in enumerate(model.pair_edges) if len(e) > 0]
    gains = sorted(((_quarters(grid(a, b, g), grid(a, b, h))[0], a, b)
                    for n, a in enumerate(usable) for b in usable[:n]), reverse=True)
    model.pairs = [(a, b, np.zeros((len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)))
                   for _, a, b in gains[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for a, b, values in model.pairs:
            g, h = slopes()
            step = RATE * _quarters(grid(a, b, g), grid(a, b, h))[1]
            values += step
            total += step[coarse[a], coarse[b]]
    return model


def held_out(id: Column) -> Column:
    return F.crc32(id.cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
          label: str = "quality", fit_rows: int = FIT_ROWS) -> Model:
    """Fits on at most ``fit_rows`` labelled documents that are not held out."""
    picked = (labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull()
                           & ~held_out(F.col(id)))
              .select(F.col(id).alias("__id"), F.col(label).cast("int").alias("__label"))
              .dropDuplicates(["__id"]).orderBy(F.xxhash64("__id"), "__id").limit(fit_rows))
    some = (docs.join(F.broadcast(picked), docs[id] == F.col("__id"))
            .select("__id", "__label", F.col(f"`{text}`").alias("__doc")))
    rows = map_texts(some, "__doc", "x array<double>",
                     lambda: lambda texts: {"x": measure(texts).tolist()}, ["__id", "__label"])
    # An id that several documents share trains with one of them.
    rows = rows.groupBy("__id", "__label").agg(F.min("x").alias("x")).collect()
    rows.sort(key=lambda r: r["__id"])
    return fit(np.array([r["x"] for r in rows]).reshape(len(rows), len(NAMES)),
               np.array([r["__label"] for r in rows], float))


def score(df: DataFrame, model: Model, text: str = "text",
          keep: Iterable[str] | None = None) -> DataFrame:
    """``keep`` (all columns but the text) and ``score``."""
    keep = without(df, [text, "score"]).columns if keep is None else list(keep)

    def rows():
        return lambda texts: {"score": model.score(measure(texts))}

    return map_texts(df, text, "score double", rows, keep)


def kept_documents(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
                   least: float = 0.5) -> DataFrame:
    """The documents whose score reaches ``least``, as they are."""
    model = train(docs, labels, id, text)
    copied = docs.withColumn("__text", F.col(f"`{text}`"))
    return (score(copied, model, "__text", docs.columns)
            .where(F.col("score") >= least).select(*[F.col(f"`{c}`") for c in docs.columns]))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(docs, train(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op7_quality_classifier": op7_quality_classifier}
ORACLES: dict[str, str] = {}
