"""Quality classifier: nearest labelled neighbours in a latent semantic space.

The terms of a text are trigrams of character classes (runs of letters or digits count once) and a few buckets of how
words repeat, so the classifier reads form, in any language. A bounded sample of labelled rows gives the term weights
(logarithmic counts times inverse document frequency) and, by singular value decomposition, a latent space of 64
dimensions. The labelled vectors of the sample are broadcast; every document is projected and compared with all of them,
exactly, by one matrix product per block of documents. Its nearest neighbours vote with the power of their cosine, either
class weighted back to its share among all labelled rows.

The bound is ``per_class`` labelled rows of either class; the broadcast holds ``2 * per_class`` vectors whatever the size of
the tables. Null texts are empty, and empty texts are scored like others. Rows are scored apart, so repeated rows get
equal scores. Without any label every score is 0.5. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.shared import held_out, in_slices, training_sample

PER_CLASS = 2000
DIMENSIONS = 64
NEIGHBOURS = 15
POWER = 20.0

# The marks that are classes of their own; all other characters share one class.
MARKS = " \n.,!|%$&*#-"
TRIGRAMS = 16**3
FORMS = 60
FORM_WEIGHT = 0.5

_CLASSES = np.full(256, 15, np.uint8)
_CLASSES[ord("a") : ord("z") + 1] = 0
_CLASSES[128:] = 0
_CLASSES[ord("A") : ord("Z") + 1] = 1
_CLASSES[ord("0") : ord("9") + 1] = 2
for _i, _c in enumerate(MARKS):
    _CLASSES[ord(_c)] = 3 + _i


def terms(text: str) -> tuple[np.ndarray, list[int]]:
    """Counts of class trigrams, and the buckets of form that the text falls into."""
    seen = _CLASSES[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    if len(seen) > 1:
        keep = np.ones(len(seen), bool)
        keep[1:] = (seen[1:] != seen[:-1]) | (seen[1:] >= 3)
        seen = seen[keep]
    padded = np.concatenate([[15, 15], seen, [15, 15]]).astype(np.int32)
    counts = np.bincount(padded[:-2] * 256 + padded[1:-1] * 16 + padded[2:], minlength=TRIGRAMS)
    words = text.split()
    n = len(words)
    if not n:
        return counts, []
    lines = [line for line in text.split("\n") if line]
    shares = (
        sum(map(str.__eq__, words, words[1:])) / n,
        len(set(words)) / n,
        (n.bit_length() - 1) / 10,
        len(text) / n / 10,
        len(set(lines)) / max(1, len(lines)),
        sum(map(str.isupper, words)) / n,
    )
    return counts, [10 * i + min(9, int(10 * share)) for i, share in enumerate(shares)]


@dataclass(frozen=True)
class LatentSpace:
    """What is broadcast: term weights, the projection, and the labelled vectors with their voting weights."""

    columns: np.ndarray
    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    good: np.ndarray
    votes: np.ndarray

    def weigh(self, found: list[tuple[np.ndarray, list[int]]]) -> np.ndarray:
        return _weigh(found, self.columns, self.weights)

    def embed(self, texts: list[str]) -> np.ndarray:
        return _unit(self.weigh([terms(t) for t in texts]) @ self.projection)

    def score(self, texts: list[str], neighbours: int = NEIGHBOURS, power: float = POWER) -> np.ndarray:
        cosines = self.embed(texts) @ self.vectors.T
        k = min(neighbours, cosines.shape[1])
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        votes = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** power + 1e-12
        votes *= self.votes[near]
        return (votes * self.good[near]).sum(axis=1) / votes.sum(axis=1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _weigh(found: list[tuple[np.ndarray, list[int]]], columns: np.ndarray, weights: np.ndarray) -> np.ndarray:
    counts = _unit(np.log1p(np.array([c for c, _ in found], np.float32)))
    forms = np.zeros((len(found), FORMS), np.float32)
    for row, (_, buckets) in enumerate(found):
        forms[row, buckets] = FORM_WEIGHT
    return _unit(np.hstack([counts[:, columns] * weights, forms])).astype(np.float32)


def fit(found: list[tuple[np.ndarray, list[int]]], labels: np.ndarray, shares: dict[int, float]) -> LatentSpace:
    """The latent space of a labelled sample. ``shares``: of either class among all labelled rows."""
    present = np.array([c > 0 for c, _ in found]).sum(axis=0)
    columns = np.flatnonzero(present >= min(3, len(found)))
    weights = np.log(1 + len(found) / (1 + present[columns])).astype(np.float32)
    x = _weigh(found, columns, weights)
    _, basis = np.linalg.eigh(x.T @ x)  # the right singular vectors, least first
    projection = np.ascontiguousarray(basis[:, ::-1][:, :DIMENSIONS])
    sampled = {y: max(1, int((labels == y).sum())) / len(labels) for y in (0, 1)}
    votes = np.array([shares.get(int(y), 0.0) / sampled[int(y)] for y in labels])
    return LatentSpace(columns, weights, projection, _unit(x @ projection), labels.astype(np.float64), votes)


def fit_on(sample: DataFrame, counts: dict[int, int]) -> LatentSpace | None:
    """Fit on the rows of ``training_sample``: terms are counted by the executors, the bounded sample comes together as
    sparse counts. None without labelled rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 512):
            found = [terms(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("y"),
                    pa.array([np.flatnonzero(c) for c, _ in found], pa.list_(pa.int32())),
                    pa.array([c[c > 0] for c, _ in found], pa.list_(pa.int32())),
                    pa.array([b for _, b in found], pa.list_(pa.int32())),
                ],
                ["doc_id", "y", "at", "n", "forms"],
            )

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInArrow(count, f"doc_id {kind}, y int, at array<int>, n array<int>, forms array<int>").collect()
    if not rows:
        return None
    found = []
    for row in sorted(rows, key=lambda r: (r.doc_id, r.y, r.at, r.n)):
        dense = np.zeros(TRIGRAMS, np.int32)
        dense[row["at"]] = row["n"]
        found.append((dense, row["forms"]))
    labels = np.array([r.y for r in sorted(rows, key=lambda r: (r.doc_id, r.y, r.at, r.n))])
    total = sum(counts.values())
    return fit(found, labels, {y: n / total for y, n in counts.items()})


def score_quality(
    documents: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    folds: int = 3,
    fold: int = 1,
    per_class: int = PER_CLASS,
    threshold: float = 0.5,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per document ``doc_id``, ``held_out``, ``score`` and ``predicted``, and the columns of ``keep``. Learns only from
    labels outside the held-out fold; ids serve to find labels and the fold, never as inputs of a score."""
    sample, counts = training_sample(documents, labels, label, folds=folds, fold=fold, per_class=per_class)
    space = documents.sparkSession.sparkContext.broadcast(fit_on(sample, counts))
    carried = list(dict.fromkeys(["doc_id", *keep]))
    names = [*carried, "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 512):
            texts = [t or "" for t in batch.column("__text").to_pylist()]
            scores = np.full(len(texts), 0.5) if space.value is None else space.value.score(texts)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], pa.array(scores)], names)

    kinds = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in carried)
    scored = documents.select(*carried, F.col("text").alias("__text")).mapInArrow(run, f"{kinds}, score double")
    return scored.withColumns(
        {
            "held_out": held_out(F.col("doc_id"), folds, fold),
            "predicted": (F.col("score") >= threshold).cast("int"),
        }
    ).select(*carried, "held_out", "score", "predicted")
