"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text.

One weight per hashed feature is shared by all grades; ordered thresholds cut the score into grades, so
P(grade >= k) = logistic(score - threshold_k). Ratings are graded as toxic (0), poor (1) and good (2).
Training runs on a bounded sample of rated documents, whose feature lists are spread over the executors: each step
sums gradients there, and the driver, which holds only the model, turns them into a quasi-Newton step.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scarmap.cluster import bounded_batches
from scarmap.llm import textkit as K
from scarmap.llm.registry import query
from scarmap.llm.shared import fresh, stored, table

BITS = 17
GRADES = 3
#: rated documents used for fitting, at most about so many
SAMPLE = 20_000
#: tasks that sum gradients over the sample; each returns one gradient to the driver
FIT_TASKS = 6
STEPS, RIDGE = 30, 1e-4
#: documents whose probability of the highest grade is at least this are selected
SELECT = 0.3
PREFIXES, STYLE_SCALE = (4, 5, 6), 8
LETTERS, CAPITALS, MARKS = K.byte_class((65, 90), (97, 122), (128, 255)), K.byte_class((65, 90)), K.byte_class((33, 47), (58, 64), (91, 96), (123, 126))


def _style(data: np.ndarray, offsets: np.ndarray, h: np.ndarray, rows: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Feature numbers of how a text looks: shares of capitals, marks, distinct and doubled words, word length, size.

    Each is given ``STYLE_SCALE`` times, so that it holds its own against the many words of a long text.
    """
    per_row = lambda mask, cuts: np.diff(np.concatenate([[0], np.cumsum(mask)])[cuts])
    share = lambda a, b: np.divide(a, np.maximum(b, 1))
    words = np.diff(rows)
    doubled = np.zeros(len(h), dtype=bool)
    doubled[1:] = h[1:] == h[:-1]
    letters = per_row(LETTERS[data], offsets)
    values = np.stack([
        share(per_row(CAPITALS[data], offsets), letters), share(per_row(MARKS[data], offsets), np.diff(offsets)),
        share(distinct, words), share(per_row(doubled, rows), words), share(letters, words) / 25,
    ], 1)
    levels = np.concatenate([np.sqrt(np.minimum(values, 1)) * 24, np.log2(words + 1)[:, None]], 1).astype(np.uint64)
    return np.repeat(K.mix(levels + np.arange(1, levels.shape[1] + 1, dtype=np.uint64) * K.BASE), STYLE_SCALE, axis=1)


def features(column: pa.Array, bits: int = BITS) -> Iterator[np.ndarray]:
    """Per text the numbers of its features: distinct words, their first bytes, and style."""
    shift = np.uint64(64 - bits)
    for lo, hi, data, offsets in K.text_blocks(column):
        folded = K.LOWER[data]
        starts, ends, rows = K.find_words(folded, offsets, K.ALNUM)
        h = K.hash_words(folded, starts, ends)
        pick = [rows[i] + np.unique(h[rows[i] : rows[i + 1]], return_index=True)[1] for i in range(hi - lo)]
        distinct = np.array([len(p) for p in pick])
        at = np.concatenate([*pick, np.zeros(0, dtype=np.int64)])
        row = np.repeat(np.arange(hi - lo), distinct)
        s, length = starts[at], ends[at] - starts[at]
        found, owner, running, done = [h[at]], [row], np.full(len(at), K.BASE), 0
        for n in PREFIXES:
            long_enough = length >= n
            at, row, s, length, running = at[long_enough], row[long_enough], s[long_enough], length[long_enough], running[long_enough]
            for j in range(done, n):
                running = K.mix(running + K.CODE[folded[s + j]])
            done = n
            found.append(running)
            owner.append(row)
        style = _style(data, offsets, h, rows, distinct)
        found.append(style.reshape(-1))
        owner.append(np.repeat(np.arange(hi - lo), style.shape[1]))
        numbers = (np.concatenate(found) >> shift).astype(np.int32)
        owner = np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(hi - lo + 1))
        numbers = numbers[order]
        for i in range(hi - lo):
            yield numbers[cuts[i] : cuts[i + 1]]


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than grades

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. (rows x thresholds)."""
        return _logistic(scores[:, None] - self.thresholds[None, :])


def loss_and_slopes(scores: np.ndarray, grades: np.ndarray, thresholds: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log-likelihood, its slope in each score and in each threshold."""
    edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
    upper, lower = edges[grades + 1] - scores, edges[grades] - scores
    a, b = _logistic(upper), _logistic(lower)
    p = np.maximum(a - b, 1e-12)
    da, db = a * (1 - a) / p, b * (1 - b) / p
    slope = np.bincount(grades, -da, len(thresholds) + 1)[:-1] + np.bincount(grades, db, len(thresholds) + 1)[1:]
    return float(-np.log(p).sum()), da - db, slope


def _thresholds(free: np.ndarray) -> np.ndarray:
    """Ordered thresholds from free numbers: the first, then the logarithms of the steps."""
    return np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches cut small, as one number per feature and row is held beside them."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def _scales(rated: DataFrame, n: int, bits: int) -> np.ndarray:
    """Fourth root of every feature's root mean square, with a floor for the ridge.

    Descent runs in weights times these: rare features learn sooner than in plain weights, without outrunning style.
    """

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.float32)
        for batch in _slices(batches):
            lists = batch.column(2)
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            times = np.unique(row.astype(np.int64) << bits | lists.flatten().to_numpy(), return_counts=True)
            np.add.at(total, times[0] & ((1 << bits) - 1), times[1] ** 2)
        yield pa.record_batch([pa.array([total.tobytes()])], ["total"])

    total = sum(np.frombuffer(r.total, "f4").astype("f8") for r in rated.mapInArrow(squares, "total binary").collect())
    return (0.25 * total / n + RIDGE) ** 0.125


def _gradient(rated: DataFrame, n: int, x: np.ndarray, bits: int) -> tuple[float, np.ndarray]:
    """Mean loss and gradient in ``x`` (weights, free threshold numbers); each task returns one sum."""
    sent = rated.sparkSession.sparkContext.broadcast((x[: 1 << bits], _thresholds(x[1 << bits :])))

    def slopes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, thresholds = sent.value
        loss, by_weight, by_cut, first = 0.0, np.zeros(len(weights)), np.zeros(len(thresholds)), None
        for batch in _slices(batches):
            ids, grades = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lists = batch.column(2)
            cut, flat = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().to_numpy()
            row = np.repeat(np.arange(len(grades)), np.diff(cut))
            scores = np.bincount(row, weights[flat], len(grades))
            more, by_score, slope = loss_and_slopes(scores, grades, thresholds)
            loss, by_cut = loss + more, by_cut + slope
            by_weight += np.bincount(flat, by_score[row], len(weights))
            first = ids.min() if first is None else min(first, ids.min())
        if first is not None:
            yield pa.record_batch([pa.array([first]), pa.array([loss]), pa.array([by_weight.astype("f4").tobytes()]), pa.array([by_cut.tobytes()])], ["first", "loss", "weights", "cuts"])

    rows = sorted(rated.mapInArrow(slopes, "first long, loss double, weights binary, cuts binary").collect(), key=lambda r: r.first)
    sent.destroy()
    loss = sum(r.loss for r in rows) / n
    by_weight = sum(np.frombuffer(r.weights, "f4").astype("f8") for r in rows) / n
    by_cut = sum(np.frombuffer(r.cuts) for r in rows) / n
    steps = np.concatenate([[1.0], np.exp(x[(1 << bits) + 1 :])])
    free = np.cumsum(by_cut[::-1])[::-1] * steps
    w = x[: 1 << bits]
    return loss + 0.5 * RIDGE * float(w @ w), np.concatenate([by_weight + RIDGE * w, free])


def _descend(f, x: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with step halving."""
    value, slope = f(x)
    past: deque = deque(maxlen=memory)
    for i in range(steps):
        direction, undo = -slope, []
        for s, y, r in reversed(past):
            a = r * (s @ direction)
            undo.append(a)
            direction = direction - a * y
        if past:
            s, y, _ = past[-1]
            direction *= (s @ y) / (y @ y)
        else:
            direction /= max(np.linalg.norm(slope), 1e-9)
        for (s, y, r), a in zip(past, reversed(undo), strict=True):
            direction += (a - r * (y @ direction)) * s
        size, fall = 1.0, float(slope @ direction)
        for _ in range(8):
            new_value, new_slope = f(x + size * direction)
            if new_value <= value + 1e-4 * size * fall:
                break
            size /= 3
        else:
            break
        s, y = size * direction, new_slope - slope
        if s @ y > 1e-12:
            past.append((s, y, 1 / (s @ y)))
        done = value - new_value < 2e-3 * abs(value)
        x, value, slope = x + s, new_value, new_slope
        if done:
            break
    return x


def grade(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 poor, 2 good; null if a rating is missing."""
    return F.when(quality.isNull() | toxic.isNull(), None).when(toxic > 0, 0).when(quality > 0, 2).otherwise(1)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS, steps: int = STEPS) -> Model:
    """Fits the model on about ``sample`` documents that ``labels`` (doc_id, quality, toxic) rate, chosen by a hash of doc_id.

    Ratings or documents with a null doc_id, rating or text are not used; a document rated twice counts twice. Without
    any, all scores are 0 and every tail probability is above one half, so nothing is rejected.
    """
    bounded_batches(docs.sparkSession)
    rated = labels.select(F.col("doc_id").cast("long"), grade(F.col("quality"), F.col("toxic")).alias("grade")).where("doc_id is not null and grade is not null")
    total = rated.count()
    share = min(1.0, sample / max(total, 1))
    chosen = rated.where(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000)) < int(share * 1_000_000))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [x for x in features(batch.column(2), bits)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int32()))], ["doc_id", "grade", "features"])

    with_text = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id").select("doc_id", F.col("grade").cast("int"), "text")
    table = stored(with_text.mapInArrow(listed, "doc_id long, grade int, features array<int>"))
    n = table.count()
    start = np.concatenate([np.zeros(1 << bits), [-2.0], np.zeros(GRADES - 2)])
    if n:
        few = table.coalesce(FIT_TASKS)
        scales = np.concatenate([_scales(few, n, bits), np.full(GRADES - 1, 0.5)])

        def scaled(z: np.ndarray) -> tuple[float, np.ndarray]:
            loss, slope = _gradient(few, n, z / scales, bits)
            return loss, slope / scales

        start = _descend(scaled, start * scales, steps) / scales
    return Model(start[: 1 << bits], _thresholds(start[1 << bits :]) if n else np.array([-2.0, -1.0][: GRADES - 1]))


GIVEN = T.StructType().add("score", T.DoubleType()).add("expected_grade", T.DoubleType()).add("tail", T.DoubleType())


def score(docs: DataFrame, model: Model, keep: list[str], name: str) -> DataFrame:
    """``keep`` columns and, as ``name``, each text's score, expected grade and probability of the highest grade.

    A null text is judged as an empty one, by its style features alone. Rows are judged one by one.
    """
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(Model(model.weights.astype(np.float32), model.thresholds))  # as large as the number of features
    bits = int(np.log2(len(model.weights)))
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField(name, GIVEN)])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            scores = np.array([float(sent.value.weights[f].sum(dtype=np.float64)) for f in features(batch.column(at("text")), bits)])
            tails = sent.value.tails(scores)
            given = pa.StructArray.from_arrays([pa.array(scores), pa.array(tails.sum(axis=1)), pa.array(tails[:, -1])], ["score", "expected_grade", "tail"])
            yield pa.record_batch([*[batch.column(at(c)) for c in keep], given], schema.names)

    return docs.mapInArrow(judge, schema)


def select_documents(docs: DataFrame, labels: DataFrame, select: float = SELECT) -> DataFrame:
    """The rows of ``docs`` whose probability of the highest grade is at least ``select``, all columns as they are."""
    name = fresh(docs, "given")
    return score(docs, fit(docs, labels), docs.columns, name).where(F.col(name)["tail"] >= select).select(*docs.columns)


@query("op2_quality")
def op2(spark, sf_dir):
    """doc_id, expected_grade, tail and kept for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, ["doc_id"], "given").select("doc_id", "given.expected_grade", "given.tail", (F.col("given.tail") >= SELECT).alias("kept"))
