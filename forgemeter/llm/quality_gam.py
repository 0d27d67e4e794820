"""Quality classifier: a generalised additive model with pairwise interactions.

The log odds of a text's quality are a sum of lookup tables, one per feature and one per chosen pair of
features. Tables grow by cyclic boosting: each round visits every feature in turn and adds a shallow tree (at most
``LEAVES`` leaves over the feature's bins) fitted to the gradients, at a small rate, so correlated features share what
they explain. Then pairs are ranked by the best cut in four of the residuals over coarse bins, and the first
``PAIRS`` get tables in the same way. The round with the least loss on a fifth of the sample is kept. A text is scored
by binning its features and adding table entries, for a batch of texts at once.

The model is fitted on at most ``SAMPLE`` labelled rows, the first by a hash of the id; only their features are
gathered, in one task. What the driver holds is the tables. All texts are scored where they are read, without a shuffle.

Features are of the text alone: shares of kinds of characters, word lengths, repetition of words, windows and
lines, line shapes, entropy.

Defined cases: a null or empty text has zeros for features and a score like any other; an id with several labels or
several documents gives a row each; null ids and null labels are not learned from, and a null id is not held out; without
labels of both kinds the score is the smoothed share of label 1 (0.5 without any); repeated rows count as
rows; texts of any length are read whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Labelled rows that the tables are fitted on.
SAMPLE = 20_000
BINS, COARSE_BINS = 48, 12
LEAVES, LEAST = 3, 10.0  # leaves of a tree, rows in a leaf
PAIRS = 6
ROUNDS, PAIR_ROUNDS, RATE, RIDGE = 150, 60, 0.15, 1.0
THRESHOLD = 0.7

_SETS = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "symbol": b"#*$%&|<>",
    "stop": b".,;:!?",
    "space": b" \t\n\r\x0b\x0c",
    "quote": b"\"'()[]{}-_/\\@=+~^`",
    "beyond": bytes(range(128, 256)),
}
_KINDS = np.array([[b in members for b in range(256)] for members in _SETS.values()], np.float64)
FEATURES = [
    *(f"share_{name}" for name in _SETS), "log_words", "mean_word", "spread_word", "longest_word", "distinct_words", "top_word",
    "distinct_windows", "repeated_lines", "log_words_a_line", "closed_lines", "marked_words", "doubled_marks", "upper_of_letters", "entropy",
]


def features(text: str | None) -> list[float]:
    """The features of a whole text, in the order of ``FEATURES``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    codes = np.frombuffer(raw, np.uint8)
    seen = np.bincount(codes, minlength=256).astype(np.float64)
    shares = (_KINDS @ seen) / len(raw)
    lower, upper = shares[0], shares[1]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = Counter(words)
    windows = max(1, len(words) - 2)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    p = seen[seen > 0] / len(raw)
    ends = np.fromiter((w[-1] for w in words), np.uint8, len(words))
    stop, symbol = _KINDS[4] > 0, _KINDS[3] > 0
    marked = symbol[ends]
    marks = stop[codes]
    return [
        *shares.tolist(),
        float(np.log1p(len(words))),
        float(lengths.mean()),
        float(lengths.std()),
        float(np.log1p(lengths.max())),
        len(counts) / len(words),
        max(counts.values()) / len(words),
        len(set(zip(words, words[1:], words[2:]))) / windows if len(words) > 2 else 1.0,
        1.0 - len(set(lines)) / len(lines),
        float(np.log1p(len(words) / len(lines))),
        sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines) / len(lines),
        float(marked.mean()),
        float((marks[1:] & marks[:-1]).mean()) if len(raw) > 1 else 0.0,
        float(upper / (upper + lower)) if upper + lower else 0.0,
        float(-(p * np.log2(p)).sum()),
    ]


@dataclass
class Model:
    """Log odds = base + sum of tables[f][bin of feature f] + sum of pair tables [bin of a, bin of b]."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, rows[:, f], side="right")]
        coarse = {f: np.searchsorted(self.coarse[f], rows[:, f], side="right") for pair in self.pairs for f in pair}
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[a], coarse[b]]
        return total

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_odds(rows), -40, 40)))


def cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    """Edges between bins of about equal numbers of rows; bin i holds values from edge i-1 up to below edge i."""
    edges = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))
    return edges[edges > values.min()]


def _value(grad: np.ndarray | float, hess: np.ndarray | float):
    return -grad / (hess + RIDGE)


def _gain(grad, hess):
    return grad * grad / (hess + RIDGE)


def shallow_tree(grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Values per bin of the tree that takes the best cut of a leaf again and again, from sums per bin."""
    parts = [(0, len(grad))]
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for part in parts:
            lo, hi = part
            if hi - lo < 2:
                continue
            g, h, n = (np.cumsum(x[lo:hi]) for x in (grad, hess, rows))
            gain = _gain(g[:-1], h[:-1]) + _gain(g[-1] - g[:-1], h[-1] - h[:-1]) - _gain(g[-1], h[-1])
            gain[(n[:-1] < LEAST) | (n[-1] - n[:-1] < LEAST)] = -1.0
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (float(gain[at]), part, lo + at + 1)
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    values = np.zeros(len(grad))
    for lo, hi in parts:
        values[lo:hi] = _value(grad[lo:hi].sum(), hess[lo:hi].sum())
    return values


def cut_in_four(grad: np.ndarray, hess: np.ndarray, rows: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a table of sums into four by one cut a side: its gain and the values per cell."""
    def quarters(x: np.ndarray) -> tuple[np.ndarray, ...]:
        c = x.cumsum(0).cumsum(1)
        low = c[:-1, :-1]
        return low, c[:-1, -1:] - low, c[-1:, :-1] - low, c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + low

    if min(grad.shape) < 2:
        return 0.0, np.zeros(grad.shape)
    g, h, n = quarters(grad), quarters(hess), quarters(rows)
    gain = sum(_gain(a, np.maximum(b, 0.0)) for a, b in zip(g, h)) - _gain(grad.sum(), hess.sum())
    gain = np.where(np.minimum.reduce([np.where(q < 0.5, LEAST, q) for q in n]) < LEAST, -1.0, gain)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    values = np.zeros(grad.shape)
    for (a, b), q in zip(((slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None)), (slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None))), range(4)):
        values[a, b] = _value(g[q][i, j], max(h[q][i, j], 0.0))
    return float(gain[i, j]), values


def fit_tables(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Boosts the tables on the rows; every fifth row only decides which round is kept."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    model = Model(float(np.log(share / (1 - share))))
    if len(labels) < 50 or labels.min() == labels.max():
        return model
    check = np.arange(len(labels)) % 5 == 4
    weight = np.where(check, 0.0, 1.0)
    model.edges = [cut_points(rows[:, f], BINS) for f in range(rows.shape[1])]
    model.coarse = [cut_points(rows[:, f], COARSE_BINS) for f in range(rows.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, rows[:, f], side="right") for f, e in enumerate(model.edges)]
    coarse = [np.searchsorted(e, rows[:, f], side="right") for f, e in enumerate(model.coarse)]
    odds = np.full(len(labels), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-np.clip(odds, -40, 40)))
        return (p - labels) * weight, p * (1 - p) * weight

    def loss() -> float:
        z = np.where(labels[check] > 0, -odds[check], odds[check])
        return float(np.logaddexp(0.0, z).mean())

    def boost(rounds: int, tables: list[np.ndarray], add) -> None:
        """Rounds over the tables until the loss on the checked rows has risen for long; the best round stays."""
        nonlocal odds
        best, kept, kept_odds, since = loss(), [t.copy() for t in tables], odds.copy(), 0
        for _ in range(rounds):
            for f in range(len(tables)):
                add(f)
            now = loss()
            if now < best - 1e-6:
                best, kept, kept_odds, since = now, [t.copy() for t in tables], odds.copy(), 0
            else:
                since += 1
                if since >= 20:
                    break
        tables[:] = kept
        odds = kept_odds

    def add_to_feature(f: int) -> None:
        grad, hess = slopes()
        size = len(model.tables[f])
        step = RATE * shallow_tree(*(np.bincount(bins[f], x, size) for x in (grad, hess, weight)))
        model.tables[f] = model.tables[f] + step
        odds[:] += step[bins[f]]

    def sums(pair: tuple[int, int]) -> list[np.ndarray]:
        a, b = pair
        shape = (len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)
        cells = coarse[a] * shape[1] + coarse[b]
        grad, hess = slopes()
        return [np.bincount(cells, x, shape[0] * shape[1]).reshape(shape) for x in (grad, hess, weight)]

    def add_to_pair(k: int) -> None:
        a, b = model.pairs[k]
        step = RATE * cut_in_four(*sums((a, b)))[1]
        model.pair_tables[k] = model.pair_tables[k] + step
        odds[:] += step[coarse[a], coarse[b]]

    boost(ROUNDS, model.tables, add_to_feature)
    every = [(a, b) for a in range(rows.shape[1]) for b in range(a + 1, rows.shape[1])]
    ranked = sorted(((cut_in_four(*sums(pair))[0], pair) for pair in every), key=lambda x: (-x[0], x[1]))
    model.pairs = [pair for gain, pair in ranked[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)) for a, b in model.pairs]
    boost(PAIR_ROUNDS, model.pair_tables, add_to_pair)
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("place"), batch.column("quality"), pa.array(rows, pa.list_(pa.float64()))], names=["place", "quality", "row"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of the labelled rows that are not held out."""
    wanted = labels.select(F.col("doc_id").cast("long").alias("labelled"), F.col("quality").cast("int").alias("quality"))
    wanted = wanted.filter("labelled IS NOT NULL AND quality IN (0, 1)").filter(~held_out(F.col("labelled")))
    wanted = wanted.orderBy(F.xxhash64("labelled"), "labelled", "quality").limit(sample)  # bounded, so it may be broadcast
    known = docs.select(F.col("doc_id").cast("long").alias("labelled"), F.col("text").cast("string").alias("text")).join(F.broadcast(wanted), "labelled")
    rows = known.select(F.xxhash64("labelled", "text").alias("place"), "quality", "text").mapInArrow(_measured, "place long, quality int, row array<double>")
    rows = rows.orderBy("place", "quality", "row").limit(sample)

    def one_fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["place", "quality"], kind="stable")
        model = fit_tables(np.stack(part["row"].to_numpy()), part["quality"].to_numpy(np.float64))
        out = [("base", 0, 0, [], [model.base])]
        out += [("feature", f, 0, e.tolist(), t.tolist()) for f, (e, t) in enumerate(zip(model.edges, model.tables))]
        out += [("coarse", f, 0, e.tolist(), []) for f, e in enumerate(model.coarse)]
        out += [("pair", a, b, [], t.ravel().tolist()) for (a, b), t in zip(model.pairs, model.pair_tables)]
        return pd.DataFrame(out, columns=["term", "a", "b", "edges", "values"])

    terms = rows.groupBy().applyInPandas(one_fit, "term string, a int, b int, edges array<double>, values array<double>").collect()
    model = Model(0.0)
    for t in sorted((t for t in terms if t.term != "pair"), key=lambda t: (t.term, t.a)):
        if t.term == "base":
            model.base = t["values"][0]
        elif t.term == "coarse":
            model.coarse.append(np.array(t.edges))
        else:
            model.edges.append(np.array(t.edges))
            model.tables.append(np.array(t["values"]))
    for t in terms:
        if t.term == "pair":
            model.pairs.append((t.a, t.b))
            model.pair_tables.append(np.array(t["values"]).reshape(len(model.coarse[t.a]) + 1, -1))
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = shared.value.scores(np.array([features(t.as_py()) for t in batch.column("text")]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(found)], names=["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    schema = rows.select("doc_id", "held_out", F.lit(0.0).alias("score")).schema
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int")
    return rows.mapInArrow(score, schema).withColumn("predicted", predicted)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, fit(docs, labels))
