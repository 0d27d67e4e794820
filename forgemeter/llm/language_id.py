"""Language identification by nearest centroids over TF-IDF vectors of character n-grams.

N-grams of 1 to 3 code points (lower case, everything but letters being one space) are hashed into
``DIMENSIONS`` slots. Document frequencies are counted over all documents that may be learned from, as
partial sums per task. Each language's sample of unit vectors (at most ``SAMPLE`` documents, the
first by a hash of the id) is clustered into ``CENTROIDS`` unit centroids by spherical k-means. A text takes the
language of its nearest centroid by cosine; it is rejected where that similarity is below 0.4 of
what nearly all learned texts of its length reach (a text without a letter is always rejected).

What goes through the driver is bounded by the parameters and the number of languages: the document
frequencies, the centroids and the limits. Texts are scored where they are read, without a shuffle.

Defined cases: a null text or one without a letter is ``und`` with score 0; a null id is never held out
and never learned from; no documents to learn from make every text ``und``; repeated rows count as rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

DIMENSIONS = 1 << 13
CENTROIDS = 4
#: Documents of one language that its centroids are fitted on.
SAMPLE = 2000
ROUNDS = 8
UNKNOWN = "und"
#: A similarity under this part of the low quantile of learned texts of the same length is a rejection.
REJECT_PART, QUANTILE = 0.4, 0.01
#: Learned texts that a class of length must have for a limit of its own.
CLASS_TEXTS = 20
_LENGTHS = 24  # classes of text length, by powers of two


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None) -> np.ndarray | None:
    """How often each slot's n-grams occur in the whole text; None if it has no letter."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return None
    points = np.where(letter, points, 32)
    blank = ~letter
    points = np.concatenate([[32], points[~(blank & np.append(False, blank[:-1]))], [32]]).astype(np.uint32)
    slots = []
    grams = np.zeros(len(points), np.uint32)
    for n in (1, 2, 3):
        grams = grams[: len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1 :] + np.uint32(n)
        slots.append((grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - 13))
    return np.bincount(np.concatenate(slots), minlength=DIMENSIONS)


def unit_vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vector = np.log1p(counts) * idf
    length = np.sqrt(vector @ vector)
    return (vector / length if length else vector).astype(np.float32)


def cluster(vectors: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of spherical k-means; starts with the first vector, then the farthest ones."""
    centres = vectors[:1]
    while len(centres) < min(k, len(vectors)):
        nearest = (vectors @ centres.T).max(axis=1)
        centres = np.vstack([centres, vectors[nearest.argmin()]])
    for _ in range(rounds):
        nearest = (vectors @ centres.T).argmax(axis=1)
        members = np.arange(len(centres))[:, None] == nearest
        sums = members.astype(np.float32) @ vectors
        sums = np.where(members.any(axis=1, keepdims=True), sums, centres)
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres.astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    owners: np.ndarray  # language of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    limits: np.ndarray  # least similarity by class of text length

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out: list[tuple[str, float, bool]] = [(UNKNOWN, 0.0, True)] * len(texts)
        if not self.languages:
            return out
        for n, text in enumerate(texts):  # one dense vector at a time
            counts = gram_counts(text)
            if counts is not None:
                near = self.centroids @ unit_vector(counts, self.idf)
                best = int(near.argmax())
                score = float(min(max(near[best], 0.0), 1.0))
                out[n] = (self.languages[self.owners[best]], score, bool(score < self.limits[length_class(counts)]))
        return out


def length_class(counts: np.ndarray) -> int:
    return min(int(counts.sum()).bit_length(), _LENGTHS - 1)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())


def _count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, docs = np.zeros(DIMENSIONS + 1, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            counts = gram_counts(text.as_py())
            if counts is not None:
                seen[:-1] += counts > 0
                docs += 1
    seen[-1] = docs
    if docs:
        slots = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(seen[slots], pa.int64())], ["slot", "docs"])


def fit(docs: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model:
    """Learns from text and lang of the documents that are not held out."""
    train = learnable(docs).select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    frequencies = train.select("text").mapInArrow(_count_slots, "slot int, docs long").groupBy("slot").agg(F.sum("docs").alias("docs"))
    found = dict(frequencies.collect())  # at most DIMENSIONS + 1 rows
    total = found.pop(DIMENSIONS, 0)
    seen = np.zeros(DIMENSIONS)
    seen[list(found)] = list(found.values())
    idf = np.log((1 + total) / (1 + seen)) + 1.0

    sizes = dict(train.groupBy("lang").count().collect())  # a row per language
    if not sizes:
        return Model([], np.zeros(0, np.int64), np.zeros((0, DIMENSIONS), np.float32), idf, np.zeros(_LENGTHS))
    # The sample is cut by hash before it is gathered, so no language comes whole to one task.
    parts = [x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, 4.0 * sample / n)))]
    place = F.xxhash64("doc_id", "text")
    near = train.select("lang", "text", place.alias("place")).filter(
        F.pmod("place", F.lit(1 << 20)) / float(1 << 20) < F.element_at(F.create_map(*parts), F.col("lang"))
    )
    near = near.dropDuplicates(["lang", "place"])

    def fit_language(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        texts = rows.sort_values("place")["text"].head(sample)
        vectors, classes = np.zeros((len(texts), DIMENSIONS), np.float32), []
        for text in texts:  # one vector of counts at a time
            counts = gram_counts(text)
            if counts is not None:
                vectors[len(classes)] = unit_vector(counts, idf)
                classes.append(length_class(counts))
        if not classes:
            return pd.DataFrame({"lang": [], "centre": [], "classes": [], "similar": []})
        vectors = vectors[: len(classes)]
        centres = cluster(vectors, centroids)
        similar = (vectors @ centres.T).max(axis=1)
        none: list = []
        rows_out = [(key[0], c.tolist(), none, none) for c in centres]
        rows_out.append((key[0], none, classes, similar.tolist()))
        return pd.DataFrame(rows_out, columns=["lang", "centre", "classes", "similar"])

    schema = "lang string, centre array<float>, classes array<int>, similar array<float>"
    fitted = near.groupBy("lang").applyInPandas(fit_language, schema).collect()
    languages = sorted({row.lang for row in fitted})
    centres = sorted((languages.index(row.lang), n) for n, row in enumerate(fitted) if row.centre)
    by_class: dict[int, list[float]] = {}
    for row in fitted:
        for c, s in zip(row.classes, row.similar):
            by_class.setdefault(c, []).append(s)
    limits = np.zeros(_LENGTHS)
    for c in range(_LENGTHS):  # a class of few texts takes in the shorter ones, which are less similar
        texts, low = [], c
        while low >= 0 and len(texts) < CLASS_TEXTS:
            texts += by_class.get(low, [])
            low -= 1
        if len(texts) >= CLASS_TEXTS:
            limits[c] = REJECT_PART * float(np.quantile(texts, QUANTILE))
    matrix = np.array([fitted[n].centre for _, n in centres], np.float32).reshape(len(centres), DIMENSIONS)
    return Model(languages, np.array([k for k, _ in centres], np.int64), matrix, idf, limits)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` with lang_pred, score and rejected; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.drop("lang_pred", "score", "rejected")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = part.column(part.schema.get_field_index("text")).to_pylist()
                lang, score, rejected = zip(*shared.value.predict(texts))
                added = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*part.schema.names, "lang_pred", "score", "rejected"])

    schema = rows.selectExpr("*", "'' AS lang_pred", "0D AS score", "false AS rejected").schema
    return rows.mapInArrow(predict, schema)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document."""
    model = fit(docs)
    named = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    return identify(named, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = part.column(part.schema.get_field_index("text")).to_pylist()
                yield part.filter(pa.array([not rejected for _, _, rejected in shared.value.predict(texts)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
