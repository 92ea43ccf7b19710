"""Quality classifier (4): ordinal cumulative-link regression on hashed text.

Grades are whole numbers 0..K. P(grade >= k) = sigmoid(score - threshold_k)
with ordered thresholds and one score for all of them: the sum of the weights
of a text's hashed tokens over the root of their number. Tokens are words
(A-Z lower-cased), runs of other signs, words in capitals, and words that
repeat the one before, each as one more token.

The model is fitted in one task on a sample of at most ``MAX_LABELLED``
labelled documents (smallest id hash), a bound that does not grow with the
input; its weights are a fixed array and go to the tasks with the scoring
function. Every text is scored whole, in one pass without a shuffle.

Defined cases: a null text, or one without a token, has expected grade 0 and
all tail probabilities 0 (rejected); labels with a null id or grade are not
used, of several labels of an id the smallest counts; with no labels, or
labels of one grade, all documents with a token get that grade (without any:
the highest); grades up to ``top`` have a tail also where no label has them;
an empty table gives an empty result; output columns replace
columns of the same name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from seqrisk.llm import bytes_text as bt
from seqrisk.llm.common import by_value

FEATURES = 1 << 16
MAX_LABELLED = 8_000
EPOCHS = 6
LEAST_STEPS = 400      # a small sample is gone through more often
BATCH = 64
TOP_KEPT = 0.98        # share of the top grade's held-out documents that the selection is to keep
LEAST_RANGE = 0.5, 0.8
_U = np.uint64
by_value(__name__)
_SIGN, _CAPITALS, _REPEAT = (_U(x) for x in (0x51ED270B, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray       # float32, one per hashed feature
    thresholds: np.ndarray    # ascending, one per grade above 0
    least: float = 0.5        # of the top grade's probability, for a document to be selected

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K, one row per text."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and text numbers of all tokens of a block."""
    start, end, word, first = bt.words(data, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    sign_at, sign_end = bt.runs((bt.FOLD[data] == 0) & (data > 32), offsets)
    sign = bt.span_hashes(data, sign_at, sign_end) ^ _SIGN
    sign_doc = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(sign_at, offsets)))
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    capitals = (upper[end] - upper[start] == end - start) & (end - start > 1)
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    return (np.concatenate([word, sign, np.full(int(capitals.sum()), _CAPITALS), np.full(int(same.sum()), _REPEAT)]),
            np.concatenate([doc, sign_doc, doc[capitals], doc[same]]))


def _bucket(hashes: np.ndarray, features: int) -> np.ndarray:
    return (bt.mix(hashes) % _U(features)).astype(np.int32)


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], grades: int, features: int, epochs: int = EPOCHS,
        rate: float = 0.5, decay: float = 1e-6, seed: int = 4) -> OrdinalModel:
    """Adaptive gradient descent on the cumulative-link likelihood. ``rows``:
    (grade, feature numbers, values). Thresholds are a first one and positive
    steps, so they stay ordered."""
    share = np.array([np.mean([g >= k for g, _, _ in rows]) for k in range(1, grades + 1)]).clip(0.01, 0.99)
    first = -np.log(share / (1 - share))
    step = np.log(np.expm1(np.maximum(np.diff(first), 0.05)))   # softplus(step) is the gap
    w, w2 = np.zeros(features), np.full(features, 1e-3)
    t, t2 = np.concatenate([first[:1], step]), np.full(grades, 1e-3)
    rng = np.random.default_rng(seed)
    for _ in range(max(epochs, -(-LEAST_STEPS * BATCH // len(rows)))):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            part = [rows[i] for i in order[at:at + BATCH]]
            g = np.array([r[0] for r in part])
            idx = np.concatenate([r[1] for r in part])
            val = np.concatenate([r[2] for r in part])
            doc = np.repeat(np.arange(len(part)), [len(r[1]) for r in part])
            score = np.bincount(doc, val * w[idx], len(part))
            theta = np.cumsum(np.concatenate([t[:1], np.logaddexp(0, t[1:])]))
            edge = np.concatenate([[-60.0], theta, [60.0]])
            low = 1 / (1 + np.exp(np.clip(edge[g] - score, -60, 60)))        # P(grade >= g)
            high = 1 / (1 + np.exp(np.clip(edge[g + 1] - score, -60, 60)))   # P(grade >= g + 1)
            p = np.maximum(low - high, 1e-9)
            dl, dh = low * (1 - low) / p, high * (1 - high) / p
            slope = -(dl - dh) / len(part)                                   # of the loss in the score
            grad = np.bincount(idx, val * slope[doc], features) + decay * w
            d_theta = np.zeros(grades + 2)
            np.add.at(d_theta, g, dl / len(part))
            np.add.at(d_theta, g + 1, -dh / len(part))
            d_theta = d_theta[1:-1]
            behind = np.cumsum(d_theta[::-1])[::-1]                          # a step moves all later thresholds
            d_t = behind * np.concatenate([[1.0], 1 / (1 + np.exp(-t[1:]))])
            w2 += grad ** 2
            w -= rate * grad / np.sqrt(w2)
            t2 += d_t ** 2
            t -= 0.1 * d_t / np.sqrt(t2)
    theta = np.cumsum(np.concatenate([t[:1], np.logaddexp(0, t[1:])]))
    return OrdinalModel(w.astype(np.float32), theta)


def selection(rows: list[tuple[str, int, np.ndarray, np.ndarray]], grades: int, features: int) -> float:
    """The probability of the top grade from which on a document is selected:
    the highest (within ``LEAST_RANGE``) that keeps ``TOP_KEPT`` of the top
    grade's documents in a quarter of ``rows`` (id first) held out of a fit."""
    held = [zlib.crc32(f"select {r[0]}".encode()) % 4 == 2 for r in rows]
    seen = [r[1:] for r, out in zip(rows, held) if not out]
    best = [r for r, out in zip(rows, held) if out and r[1] == grades]
    if not best or len({g for g, _, _ in seen}) < 2:
        return LEAST_RANGE[0]
    model = fit(seen, grades, features)
    p = model.tails(np.array([(model.weights[idx] * val).sum() for _, _, idx, val in best]))[:, -1]
    return float(np.clip(np.quantile(p, 1 - TOP_KEPT, method="lower"), *LEAST_RANGE))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade",
          features: int = FEATURES, max_rows: int = MAX_LABELLED, top: int = 1) -> OrdinalModel:
    """Fit on the documents that ``labels`` (id, grade) rates; ``top`` is the
    highest grade there can be, should no label have it."""
    rated = (labels.where(F.col(f"`{grade_col}`") >= 0).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{grade_col}`").cast("int").alias("grade"))
             .where("id is not null").groupBy("id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("id"), "id").limit(max_rows))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # one text per id (that of the smallest hash), so at most max_rows rows
    sample = (texts.join(F.broadcast(rated), "id").groupBy("id", "grade").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
              .select("id", "text", "grade"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n, data, offsets in bt.blocks(batch.column(1)):
                h, d = tokens(data, offsets)
                f, d, c = bt.weighted(_bucket(h, features).astype(_U), d)
                total = np.bincount(d, c, n)
                cut = np.searchsorted(d, np.arange(n + 1)).astype(np.int32)
                value = (c / np.sqrt(total[d])).astype(np.float32)
                yield pa.record_batch([batch.column(0).slice(at, n).cast(pa.string()), batch.column(2).slice(at, n),
                                       pa.ListArray.from_arrays(cut, pa.array(f.astype(np.int32))),
                                       pa.ListArray.from_arrays(cut, pa.array(value))], names=["id", "grade", "idx", "val"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            ids, grade = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            idx, val = batch.column(2), batch.column(3)
            rows += [(i, g, idx[k].values.to_numpy(), val[k].values.to_numpy()) for k, (i, g) in enumerate(zip(ids, grade)) if len(idx[k])]
        rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
        seen = [r[1:] for r in rows]
        best = max((g for g, _, _ in seen), default=top)
        if len({g for g, _, _ in seen}) > 1:
            model = replace(fit(seen, max(best, top), features), least=selection(rows, max(best, top), features))
        else:                                    # nothing to tell apart: everything is that grade
            model = OrdinalModel(np.zeros(features, np.float32), np.where(np.arange(max(best, top)) < best, -60.0, 60.0))
        yield pa.record_batch([pa.array([model.weights.tolist()], pa.list_(pa.float32())),
                               pa.array([model.thresholds.tolist()], pa.list_(pa.float64())), pa.array([model.least])],
                              names=["weights", "thresholds", "least"])

    one = sample.mapInArrow(vectors, "id string, grade int, idx array<int>, val array<float>").repartition(1)
    row = one.mapInArrow(learn, "weights array<float>, thresholds array<double>, least double").first()
    if row is None:                              # an input known to be empty runs no task
        return OrdinalModel(np.zeros(features, np.float32), np.full(top, -60.0))
    return OrdinalModel(np.array(row.weights, np.float32), np.array(row.thresholds, np.float64), row.least)


def rate(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """``docs`` with expected_grade and tails (P(grade >= k) for k = 1..K)."""
    made = ("expected_grade", "tails")
    kept = [c for c in docs.columns if c not in made]
    rows = docs.select(*[f"`{c}`" for c in kept], F.col(f"`{text_col}`").cast("string").alias("__text"))
    features = len(model.weights)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n, data, offsets in bt.blocks(batch.column(batch.num_columns - 1)):
                h, d = tokens(data, offsets)
                total = np.bincount(d, minlength=n)
                score = np.bincount(d, model.weights[_bucket(h, features)], n) / np.sqrt(np.maximum(total, 1))
                tails = model.tails(score) * (total > 0)[:, None]
                k = tails.shape[1]
                lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * k, tails.ravel())
                part = batch.slice(at, n)
                yield pa.record_batch([*part.columns[:-1], pa.array(tails.sum(axis=1)), lists], names=[*part.schema.names[:-1], *made])

    schema = StructType([*docs.select(*[f"`{c}`" for c in kept]).schema.fields,
                         StructField(made[0], DoubleType()), StructField(made[1], ArrayType(DoubleType()))])
    return rows.mapInArrow(work, schema)


def keep_good(docs: DataFrame, model: OrdinalModel, text_col: str = "text", grade: int = -1, least: float | None = None) -> DataFrame:
    """``docs`` whose probability of at least ``grade`` (-1: the top one) is ``least`` (the model's own) or more."""
    least = model.least if least is None else least
    rated = rate(docs.withColumnsRenamed({c: f"__own_{c}" for c in ("expected_grade", "tails") if c in docs.columns}), model,
                 text_col if text_col not in ("expected_grade", "tails") else f"__own_{text_col}")
    good = rated.where(F.element_at("tails", grade) >= least).drop("expected_grade", "tails")
    return good.withColumnsRenamed({f"__own_{c}": c for c in ("expected_grade", "tails")})
