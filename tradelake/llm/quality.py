"""Text quality by a regularised quadratic discriminant.

Method. Whole texts become transformed statistics (shares as logits, counts as logarithms),
scaled by mean and deviation over all documents. Each class of the labelled rows has a mean and
a covariance, shrunk toward the pooled covariance and then toward a multiple of the identity.
The score is the logistic of the difference of the classes' log densities, from Mahalanobis
distances by the inverse Cholesky factors that the model keeps. Sums over all labelled rows come
from one partial sum per task; the tempering of the difference is fitted on a bounded sample.

Defined results
  null or empty text   statistics of a text without words; scored like any other
  null doc_id, null label   not learned from; scored
  repeated rows        each is scored; labelled rows that repeat count again
  ties                 equal texts get equal scores
  no labels of a class all scores are the share of label 1 (0.5 without labels)
  other columns        ignored by ``statistics``, which keeps the id alone
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

NAMES = [
    "words",
    "mean_length",
    "spread_length",
    "upper",
    "letters",
    "digits",
    "signs",
    "distinct",
    "top_word",
    "odd_ends",
    "lines",
    "repeated_lines",
    "entropy",
    "repeated_triples",
    "stutter",
]
_BYTES = np.arange(256)
_UPPER = ((_BYTES >= 65) & (_BYTES <= 90)).astype(float)
_LOWER = (((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)).astype(float)
_DIGIT = ((_BYTES >= 48) & (_BYTES <= 57)).astype(float)
_SPACE = np.isin(_BYTES, [9, 10, 11, 12, 13, 32]).astype(float)
_ORDINARY = set(".,;:?'\")-")


def _logit(share: float) -> float:
    return math.log((share + 0.002) / (1.002 - share))


def facts(text: str | None) -> list[float]:
    """The transformed statistics, in the order of NAMES."""
    text = text or ""
    words = text.split()
    n = len(words)
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    seen = max(1.0, float(counts @ (1 - _SPACE)))
    upper, lower, digit = (float(counts @ x) for x in (_UPPER, _LOWER, _DIGIT))
    share = counts[counts > 0] / max(1, counts.sum())
    lines = text.split("\n")
    tally = Counter(words)
    place = dict(zip(tally, range(len(tally))))
    at = np.fromiter(map(place.__getitem__, words), np.int64, n)
    lengths = np.fromiter(map(len, words), np.float64, n) if n else np.zeros(1)
    k = len(tally) + 1
    triples = (at[:-2] * k + at[1:-1]) * k + at[2:] if n > 2 else at[:0]
    odd = sum(c for w, c in tally.items() if not w[-1].isalnum() and w[-1] not in _ORDINARY)
    return [
        math.log1p(n),
        math.log1p(lengths.mean()),
        math.log1p(lengths.std()),
        _logit(upper / max(1.0, upper + lower)),
        _logit((upper + lower) / seen),
        _logit(digit / seen),
        _logit(max(0.0, seen - upper - lower - digit) / seen),
        _logit(len(tally) / max(1, n)),
        _logit(max(tally.values()) / n if n else 0.0),
        _logit(odd / max(1, n)),
        math.log1p(len(text) / len(lines)),
        _logit(1 - len(set(lines)) / len(lines)),
        float(-(share * np.log(share)).sum()) if len(share) else 0.0,
        _logit(1 - len(np.unique(triples)) / len(triples) if len(triples) else 0.0),
        _logit(float((at[1:] == at[:-1]).mean()) if n > 1 else 0.0),
    ]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): one row per document with its statistics."""
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                x = [facts(t.as_py()) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], schema=schema)

    work = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return work.mapInArrow(run, "doc_id long, x array<double>")


def _matrix(column) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64).reshape(-1, len(NAMES))


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]  # inverse Cholesky factors of the class covariances
    log_dets: list[float]
    prior: float  # log odds of label 1
    temper: float

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Difference of the classes' log densities."""
        z = np.clip((x - self.center) / self.scale, -8, 8)
        if not self.factors:
            return np.zeros(len(z))
        far = [(((z - m) @ f.T) ** 2).sum(axis=1) + d for m, f, d in zip(self.means, self.factors, self.log_dets)]
        return (far[0] - far[1]) / 2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.temper * self.odds(x) + self.prior, -30, 30)))


def _moments(rows: DataFrame, center: np.ndarray, scale: np.ndarray) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """(count, sum, sum of products) of either class, added up from one row per task."""
    d = len(NAMES)

    def run(batches):
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            z, label = np.clip((_matrix(batch.column("x")) - center) / scale, -8, 8), batch.column("label").to_numpy()
            for k in (0, 1):
                mine = z[label == k]
                total[k] += np.concatenate([[len(mine)], mine.sum(axis=0), (mine.T @ mine).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(list(total.ravel())), pa.array(range(total.size), pa.int32())], names=["v", "k"])

    sums = rows.mapInArrow(run, "v double, k int").groupBy("k").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(2 * (1 + d + d * d))
    for r in sums:
        flat[r.k] = r.v
    return [(t[0], t[1 : 1 + d], t[1 + d :].reshape(d, d)) for t in flat.reshape(2, -1)]


def train(
    stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", toward_pooled: float = 0.1, toward_identity: float = 0.02, max_tempered: int = 20_000
) -> Model:
    """``labels``: the rows to learn from; all of them count."""
    d = len(NAMES)
    row = stats.agg(*[F.avg(F.col("x")[i]) for i in range(d)], *[F.stddev_pop(F.col("x")[i]) for i in range(d)]).first()
    center = np.array([v or 0.0 for v in row[:d]])
    scale = np.array([v if v and v > 1e-6 else 1.0 for v in row[d:]])
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    rows = saved(stats.join(known, "doc_id"), "labelled-statistics")
    moments = _moments(rows.select("x", "label"), center, scale)
    counts = [m[0] for m in moments]
    prior = math.log((counts[1] + 0.5) / (counts[0] + 0.5))
    model = Model(center, scale, [], [], [], prior, 1.0)
    if min(counts) < 2:
        return model
    means = [s / n for n, s, _ in moments]
    spread = [p / n - np.outer(m, m) for (n, _, p), m in zip(moments, means)]
    pooled = (counts[0] * spread[0] + counts[1] * spread[1]) / sum(counts)
    for m, s in zip(means, spread):
        s = (1 - toward_pooled) * s + toward_pooled * pooled
        s = (1 - toward_identity) * s + toward_identity * max(np.trace(s) / d, 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(s)
        model.means.append(m)
        model.factors.append(np.linalg.inv(factor))
        model.log_dets.append(2 * float(np.log(np.diag(factor)).sum()))
    part = int(min(1.0, max_tempered / sum(counts)) * (1 << 20))  # about max_tempered rows, chosen by the hash of their id
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < part).select("x", "label").collect()
    if not sample:
        return model
    odds, label = model.odds(np.array([r.x for r in sample])), np.array([r.label for r in sample])
    grid = np.geomspace(0.02, 1.5, 60)
    odds, loss = np.clip(odds, -1e3, 1e3), []
    for t in grid:  # the tempering that makes the labels likeliest
        v = np.clip(t * odds + prior, -30, 30)
        loss.append(float(np.log1p(np.exp(np.where(label == 1, -v, v))).mean()))
    model.temper = float(grid[int(np.argmin(loss))])
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of ``statistics``."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(_matrix(batch.column("x"))))], names=["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")
