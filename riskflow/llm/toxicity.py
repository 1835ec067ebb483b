"""A linear classifier on character n-grams whose features are scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import saved, text_of

CHUNK = 1 << 12  # features whose counts go in one row
BROADCAST_LABELS = 1_000_000  # labelled rows (some 24 bytes each) up to which they are broadcast to the texts
BLOCK = 1 << 18  # bytes of a text that are turned into n-grams at once
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """``sizes``: lengths of the n-grams, in UTF-8 bytes of the lower-cased text (at most 8). ``bits``: n-grams are hashed
    to 2**bits features, which bounds the model. ``sample_rows``: the linear fit sees at most about so many labelled rows,
    half of each label, chosen by a hash of the id; the counts behind the ratios cover all labelled rows."""

    sizes: tuple[int, ...] = (3, 4, 5)
    bits: int = 18
    sample_rows: int = 6000
    smoothing: float = 1.0
    penalty: float = 1e-3
    iterations: int = 40


@dataclass(frozen=True)
class Model:
    settings: Settings
    weights: np.ndarray
    intercept: float


class Features:
    """The distinct features of a text."""

    def __init__(self, settings: Settings):
        self.sizes, self.shift = settings.sizes, np.uint64(64 - settings.bits)
        self.place = np.zeros(1 << settings.bits, np.int32)
        self.order = np.arange(BLOCK * len(settings.sizes), dtype=np.int32)

    def _block(self, raw: np.ndarray) -> np.ndarray:
        codes, found = raw.astype(np.uint64), []
        for n in range(1, max(self.sizes) + 1):
            if n > 1:
                codes = codes[:-1] | (raw[n - 1 :].astype(np.uint64) << np.uint64(8 * (n - 1)))
            if n in self.sizes:
                found.append((codes * GOLDEN) >> self.shift)
            if len(codes) < 2:
                break
        if not found:
            return np.zeros(0, np.int32)
        at = np.concatenate(found).astype(np.int32)
        order = self.order[: len(at)]
        self.place[at] = order  # of equal features the last one stays
        return at[self.place[at] == order]

    def __call__(self, text: str | None) -> np.ndarray:
        raw = np.frombuffer(f" {(text or '').lower()} ".encode(), np.uint8)
        if len(raw) <= BLOCK:
            return self._block(raw)
        step = BLOCK - max(self.sizes) + 1
        return np.unique(np.concatenate([self._block(raw[i : i + BLOCK]) for i in range(0, len(raw), step)]))


def training_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """One label per id, of rows outside the held-out fold; 1 wins where labels of an id differ. Null ids and labels
    other than 0 and 1 are left out."""
    known = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label"))
    return known.where(F.col("__label").isin(0, 1) & ~held_out("__id")).groupBy("__id").agg(F.max("__label").alias("__label"))


def held_out(id_col: str):
    """Whether crc32 of the id as text leaves no rest mod 5; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Fit on the labelled rows outside the held-out fold. Only texts enter a feature.

    One pass over the labelled texts counts the features of each label (summed by Spark; two counts for each of the
    2**bits features reach the driver) and writes the sample. The fit runs in one task on that bounded sample, weighted back to the
    label counts. Without labels every score is near 0; with one label all scores follow it.
    """
    size = 1 << settings.bits
    chosen = saved(training_labels(labels, id_col, label_col), "labels")
    n = {r["__label"]: r["n"] for r in chosen.groupBy("__label").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = {k: min(1.0, settings.sample_rows / 2 / n.get(k, 1)) for k in (0, 1)}
    draw = F.pmod(F.xxhash64("__id", F.lit("sample")), F.lit(1_000_000)) / 1_000_000
    keyed = chosen.withColumn("__fit", draw < F.when(F.col("__label") == 1, rate[1]).otherwise(rate[0]))
    keyed = F.broadcast(keyed) if sum(n.values()) <= BROADCAST_LABELS else keyed
    texts = docs.select(F.col(id_col).alias("__id"), text_of(text_col).alias("__text")).where(~held_out("__id"))
    joined = texts.join(keyed, "__id").select("__id", "__text", "__label", "__fit")
    names = ["kind", "label", "key", "text", "task", "chunk", "counts"]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.binary()]
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, totals, rows = Features(settings), np.zeros((2, size), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                sample = []
                for key, text, label, fit in zip(*(batch.slice(i, 500).column(c) for c in range(4))):
                    rows[label.as_py()] += 1
                    totals[label.as_py(), features(text.as_py())] += 1
                    if fit.as_py():
                        sample.append(("row", label.as_py(), hash_key(key.as_py()), text.as_py(), None, None, None))
                if sample:
                    yield pack(sample)
        if rows.any():
            tables = [(-1, rows)] + [(c, totals[:, c * CHUNK : (c + 1) * CHUNK]) for c in range(-(-size // CHUNK))]
            yield pack([("count", None, None, None, TaskContext.get().partitionId(), c, x.tobytes()) for c, x in tables])

    parts = saved(joined.mapInArrow(counted, "kind string, label int, key long, text string, task long, chunk int, counts binary"), "toxicity", ["kind"])
    summed = parts.where("kind = 'count'").select("task", "chunk", "counts")
    for _ in range(3):  # sums of 256 tables at a time: enough for 16 million tasks
        summed = summed.withColumn("task", F.expr("task div 256")).groupBy("task", "chunk").applyInArrow(added, "task long, chunk int, counts binary")
    totals, found = np.zeros((2, size), np.int64), np.zeros(2, np.int64)
    for r in summed.collect():
        part = np.frombuffer(r["counts"], np.int64).reshape(2, -1)
        if r["chunk"] < 0:
            found += part[:, 0]
        else:
            totals[:, r["chunk"] * CHUNK : r["chunk"] * CHUNK + part.shape[1]] += part
    negative, positive = map(int, found)
    if not positive or not negative:
        return Model(settings, np.zeros(size, np.float32), float(np.log((positive + 1e-6) / (negative + 1))))
    ratios = log_count_ratios(totals, settings, positive, negative)
    weight = {k: 1 / (positive + negative) / rate[k] for k in (0, 1)}

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(settings)
        rows = sorted(((k, y, features(t)) for b in batches for y, k, t in zip(*(b.column(c).to_pylist() for c in range(3)))), key=lambda r: (r[0], r[1], len(r[2])))
        y = np.array([r[1] for r in rows], np.float64)
        beta, intercept = fit_logistic([r[2] for r in rows], y, np.array([weight[r[1]] for r in rows]), ratios, settings)
        yield pa.RecordBatch.from_pydict({"weights": [(ratios * beta).astype(np.float32).tobytes()], "intercept": [float(intercept)]})

    sample = parts.where("kind = 'row'").select("label", "key", "text").repartition(1)
    row = saved(sample.mapInArrow(fitted, "weights binary, intercept double"), "toxicity_model").first()
    return Model(settings, np.frombuffer(row["weights"], np.float32), row["intercept"])


def added(table: pa.Table) -> pa.Table:
    parts = [np.frombuffer(x.as_py(), np.int64) for x in table["counts"]]
    total = np.zeros_like(parts[0])
    for part in parts:
        total += part
    return pa.table({"task": table["task"][:1].cast(pa.int64()), "chunk": table["chunk"][:1], "counts": pa.array([total.tobytes()], pa.binary())})


def hash_key(value) -> int:
    """A number to order sample rows by, whatever the type of the id."""
    import zlib

    return zlib.crc32(str(value).encode())


def log_count_ratios(counts: np.ndarray, settings: Settings, positive: int, negative: int) -> np.ndarray:
    """log of the share of label-1 rows with a feature over the share of label-0 rows; smoothed towards 0 (no evidence)."""
    total = positive + negative
    add = settings.smoothing * np.array([negative, positive]) * 2 / total
    share = (counts + add[:, None]) / np.array([[negative], [positive]])
    return np.log(share[1] / share[0])


def fit_logistic(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, ratios: np.ndarray, settings: Settings):
    """L2-penalised logistic regression on features ``ratios[f]`` by L-BFGS, in blocks of rows."""
    size, weight = len(ratios), weight / weight.sum()
    blocks = [(np.concatenate(rows[i : i + 256]), np.array([len(r) for r in rows[i : i + 256]]), slice(i, i + 256)) for i in range(0, len(rows), 256)]
    sign = 2 * y - 1

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        scaled, value, grad = ratios * x[:size], 0.0, np.zeros(size + 1)
        for at, lengths, part in blocks:
            cum = np.concatenate([[0.0], np.cumsum(scaled[at])])
            ends = np.cumsum(lengths)
            margin = sign[part] * (cum[ends] - cum[ends - lengths] + x[size])
            value += float(weight[part] @ np.logaddexp(0, -margin))
            g = -weight[part] * sign[part] / (1 + np.exp(np.clip(margin, -500, 500)))
            grad[:size] += np.bincount(at, weights=np.repeat(g, lengths), minlength=size)
            grad[size] += g.sum()
        grad[:size] = grad[:size] * ratios + settings.penalty * x[:size]
        return value + settings.penalty / 2 * float(x[:size] @ x[:size]), grad

    x = np.zeros(size + 1)
    value, grad = loss(x)
    memory: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(settings.iterations):
        step = -_inverse_hessian(grad, memory)
        slope, length = float(step @ grad), 1.0 if memory else min(1.0, 1 / max(np.abs(grad).sum(), 1e-12))
        for _ in range(20):
            new = x + length * step
            new_value, new_grad = loss(new)
            if new_value <= value + 1e-4 * length * slope:
                break
            length /= 2
        else:
            break
        if (new - x) @ (new_grad - grad) > 1e-12:
            memory = [*memory[-7:], (new - x, new_grad - grad)]
        done = value - new_value < 1e-7 * max(abs(value), 1e-9)
        x, value, grad = new, new_value, new_grad
        if done:
            break
    return x[:size], x[size]


def _inverse_hessian(grad: np.ndarray, memory: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    q, kept = grad.copy(), []
    for s, y in reversed(memory):
        a = (s @ q) / (s @ y)
        q -= a * y
        kept.append(a)
    if memory:
        s, y = memory[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), a in zip(memory, reversed(kept)):
        q += s * (a - (y @ q) / (s @ y))
    return q


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``score`` from 0 to 1. Whole texts are read, in blocks; null and empty texts get the score of a text
    of white space only. Rows that repeat an id each get their score. Extra columns are ignored."""
    settings, weights, intercept = model.settings, model.weights, model.intercept

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(settings)
        for batch in batches:
            z = np.array([float(weights[features(t.as_py())].sum(dtype=np.float64)) for t in batch.column(1)]) + intercept
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))))], names=[id_col, "score"])

    texts = docs.select(F.col(id_col).alias(id_col), text_of(text_col).alias("__text"))
    return texts.mapInArrow(scored, f"`{id_col}` {texts.schema[0].dataType.simpleString()}, score double")
