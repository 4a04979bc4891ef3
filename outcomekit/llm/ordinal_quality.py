"""Quality classifier (operator 5): ordinal cumulative-link regression.

P(grade > k) = logistic(w . x - t_k): one weight vector over hashed text
features is shared by all grades, and ordered thresholds t_0 < t_1 < ... cut
the score into grades.  The expected grade is the sum of the tail
probabilities; a tail probability at the wanted grade selects documents.

The model is fitted on a bounded sample of graded rows (``TRAIN_ROWS``, by hash
order of the id); every whole text is scored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomekit.llm.common import table

TRAIN_ROWS = 8_000           # graded rows used at most
DIMENSIONS = 1 << 12         # hashed features
STEPS = 300
RIDGE = 2e-4
MEMO = 400_000

PIECE = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|\n")


class Hashed(dict):
    """piece -> its feature numbers: the piece itself (short ones), its shape,
    its ending; remembered for the pieces met before."""

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if piece[0].isalpha():
            case = "U" if piece.isupper() and len(piece) > 1 else "T" if piece[0].isupper() else "l"
            names = [f"shape {case}{min(len(piece), 16)}", f"end {piece[-3:].lower()}"]
            if len(piece) <= 5:
                names.append(f"word {piece.lower()}")
        elif piece[0].isdigit():
            names = [f"number {min(len(piece), 8)}"]
        else:
            names = [f"mark {piece[:4]}"]
        got = tuple(xxhash.xxh3_64_intdigest(n) % (DIMENSIONS - 8) for n in names)
        if len(self) > MEMO:
            self.clear()
        self[piece] = got
        return got


def features(text: str, hashed: Hashed) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values: damped, length-normalised counts, and six
    dense ones about length, repetition and variety."""
    pieces = PIECE.findall(text)
    counts = Counter(pieces)
    total: dict[int, float] = {}
    for piece, n in counts.items():
        for f in hashed[piece]:
            total[f] = total.get(f, 0.0) + n
    at = np.fromiter(total, np.int64, len(total))
    v = np.sqrt(np.fromiter(total.values(), float, len(total)) / max(1, len(pieces)))
    n = len(pieces)
    lines = text.split("\n")
    dense = [np.log1p(n) / 10, len(counts) / max(1, n), max(counts.values(), default=0) / max(1, n),
             sum(1 for a, b in zip(pieces, pieces[1:]) if a == b) / max(1, n),
             1 - len(set(lines)) / len(lines), sum(c.isalpha() for c in text[::7]) / max(1, len(text[::7]))]
    return np.concatenate((at, np.arange(DIMENSIONS - 8, DIMENSIONS - 2))), np.concatenate((v, dense))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grade: np.ndarray, grades: int) -> Model:
    """Maximise the ordinal likelihood with adaptive gradient steps.  The
    thresholds are the first one and positive gaps, so they stay in order."""
    size = np.array([len(i) for i, _ in rows])
    at, value = np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows])
    row = np.repeat(np.arange(len(rows)), size)
    w, base, gaps = np.zeros(DIMENSIONS), 0.0, np.full(grades - 2, 0.5)
    memory = [np.full(DIMENSIONS, 1e-6), 1e-6, np.full(grades - 2, 1e-6)]
    padded = lambda t: np.concatenate(([-np.inf], t, [np.inf]))                               # noqa: E731
    sigma = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))                                  # noqa: E731
    for _ in range(STEPS):
        t = base + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
        score = np.bincount(row, value * w[at], len(rows))
        edges = padded(t)
        up, low = sigma(edges[grade + 1] - score), sigma(edges[grade] - score)        # P(<= g), P(<= g - 1)
        p = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / p, low * (1 - low) / p
        slope = d_up - d_low                                                           # of minus log p by the score
        g_t = np.bincount(grade, -d_up, grades)[:-1] + np.bincount(grade, d_low, grades)[1:]
        g_w = np.bincount(at, value * slope[row], DIMENSIONS) / len(rows) + RIDGE * w
        tail = np.cumsum(g_t[::-1])[::-1] / len(rows)
        for k, (g, rate) in enumerate(((g_w, 0.3), (tail[0], 0.3), (tail[1:] * np.exp(gaps), 0.1))):
            memory[k] = 0.9 * memory[k] + 0.1 * g * g
            step = rate * g / np.sqrt(memory[k] + 1e-8)
            if k == 0:
                w = w - step * 0.3
            elif k == 1:
                base -= step * 0.3
            else:
                gaps = gaps - step
    return Model(w, base + np.concatenate(([0.0], np.cumsum(np.exp(gaps)))))


def graded(labels: DataFrame) -> DataFrame:
    """Grades from the labels: 0 low quality, 1 good but toxic, 2 good and clean."""
    return labels.where("quality in (0, 1)").select(
        F.col("doc_id").cast("long").alias("i"),
        (F.col("quality") * (F.lit(2) - F.coalesce(F.col("toxic"), F.lit(0)))).cast("int").alias("grade"))


def learn(docs: DataFrame, ratings: DataFrame, grades: int = 3, rows: int = TRAIN_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """``ratings(i, grade)``; None if fewer than two grades are there."""
    chosen = ratings.where("i is not null").orderBy(F.xxhash64("i"), "i", "grade").limit(rows)
    # at most ``rows`` rows of two numbers
    sample = (docs.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
              .join(F.broadcast(chosen), "i"))
    got = sample.mapInArrow(_training_rows, "grade int, at binary, v binary").collect()
    grade = np.array([r["grade"] for r in got], np.int64)
    if len(set(grade.tolist())) < 2:
        return None
    order = np.lexsort(([xxhash.xxh3_64_intdigest(bytes(r["at"])) for r in got], grade))   # sums in one order
    return fit([(np.frombuffer(got[k]["at"], np.int64), np.frombuffer(got[k]["v"])) for k in order], grade[order], grades)


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashed = Hashed()
    for b in batches:
        f = [features(t, hashed) for t in b.column("t").to_pylist()]
        yield pa.record_batch([b.column("grade"), pa.array([a.tobytes() for a, _ in f], pa.binary()),
                               pa.array([v.tobytes() for _, v in f], pa.binary())], names=["grade", "at", "v"])


def _score(model: Model | None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Hashed()
        for b in batches:
            texts = b.column("t").to_pylist()
            if model is None:
                tails = np.full((len(texts), 2), 0.5)
            else:
                s = [float(v @ model.weights[a]) for a, v in (features(t, hashed) for t in texts)]
                tails = model.tails(np.array(s, float))
            yield pa.record_batch([b.column("id"), pa.array(tails.sum(1)), pa.array(tails[:, 0].copy()), pa.array(tails[:, -1].copy())],
                                  names=["id", "expected_grade", "p_good", "p_best"])
    return score


def grade_documents(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, expected_grade, p_good`` (grade > 0), ``p_best`` (the top grade).
    Null and empty texts are scored as empty; without a model all tails are 0.5."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
    return src.mapInArrow(_score(model), "id long, expected_grade double, p_good double, p_best double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = grade_documents(docs, learn(docs, graded(table(spark, sf_dir, "labels"))))
    return out.select(F.col("id").alias("doc_id"), "expected_grade", "p_good", "p_best", (F.col("p_good") >= 0.5).alias("selected"))
