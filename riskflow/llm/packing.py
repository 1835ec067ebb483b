"""Mixture-controlled packing: deficit round-robin over source queues, without a pass over all windows in one place."""

from __future__ import annotations

import base64
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import saved, text_of

END = 0  # the id after each document
SPECIAL = {"<|endoftext|>": 50256}


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def _encoding(path: str):
    """The byte-level BPE of a rank file. It holds the same vocabulary as the tokenizer file of that name, and gives the
    same ids several times faster."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, path: str) -> np.ndarray:
    """The ids of a text; the strings of special tokens are their ids, as the tokenizer file has them by default."""
    encoding = _encoding(path)
    plain = lambda t: encoding.encode_to_numpy(t, disallowed_special=())
    for mark, number in SPECIAL.items():
        if mark in text:
            parts = text.split(mark)
            pieces = [plain(parts[0])] + [x for p in parts[1:] for x in (np.array([number], np.uint32), plain(p))]
            return np.concatenate(pieces)
    return plain(text)


def tokenised(docs: DataFrame, path: str, *, id_col: str, text_col: str, source_col: str, max_queues: int) -> DataFrame:
    """Rows of (block, queue, start, id, n, ids): the ids of each document with the end id, and how many ids of its queue
    stand before it in its block (the input partition). Written once, since the cuts need counts of all blocks."""
    counts = docs.groupBy(F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("queue")).agg(F.count(F.lit(1)).alias("n"))
    own = [r["queue"] for r in counts.orderBy(F.desc("n"), "queue").limit(max_queues).collect()]
    queue = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    if len(own) == max_queues:
        queue = F.when(queue.isin(own[:-1]), F.concat(F.lit("="), queue)).otherwise(F.lit("other"))
    rows = docs.select(F.col(id_col).alias("__id"), queue.alias("queue"), text_of(text_col).alias("__text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, used = TaskContext.get().partitionId(), {}
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                queues, starts, counts, data = part.column(1).to_pylist(), [], [], []
                for q, text in zip(queues, part.column(2)):
                    ids = np.append(encode(text.as_py(), path), END).astype("<u4")
                    starts.append(used.get(q, 0))
                    used[q] = starts[-1] + len(ids)
                    counts.append(len(ids))
                    data.append(ids.astype("<u2").tobytes() if ids.max() < 65536 else b"4" + ids.tobytes())
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array([block] * len(starts), pa.int64()), "queue": part.column(1), "start": pa.array(starts, pa.int64()), "__id": part.column(0), "n": pa.array(counts, pa.int64()), "ids": pa.array(data, pa.binary())}
                )

    kind = rows.schema["__id"].dataType.simpleString()
    return rows.mapInArrow(encoded, f"block long, queue string, start long, __id {kind}, n long, ids binary")


@dataclass(frozen=True)
class Schedule:
    """How many ids of each queue are among the first t ids of the output.

    ``phases`` hold the ids that each queue gives between two moments at which a queue runs dry. Within a phase, of the
    ids that earlier queues leave over, a queue gets its share rounded down, ``left * own // all``: the part lost by
    rounding is its deficit, which counts again in the next window, so no window is off by more than one id a queue. The
    counts need no earlier window, therefore any task can cut any document by itself.
    """

    queues: tuple[str, ...]
    phases: tuple[tuple[int, ...], ...]

    def served(self, t: int) -> list[int]:
        done = [0] * len(self.queues)
        for phase in self.phases:
            total = sum(phase)
            left, rest = min(t, total), total
            t -= left
            for k, own in enumerate(phase):
                part = left * own // rest if rest else 0
                done[k] += part
                left -= part
                rest -= own
            if t <= 0:
                break
        return done


def schedule(totals: Mapping[str, int], targets: Mapping[str, float] | None = None) -> Schedule:
    """Windows hold the queues in proportion to ``targets`` (default: to all their ids) for as long as all of them last;
    when one runs dry the others go on in proportion. Queues without a target come last."""
    queues = tuple(sorted(totals))
    left = {q: totals[q] for q in queues}
    share = {q: Fraction(str(targets.get(q, 0))) for q in queues} if targets else {q: Fraction(totals[q]) for q in queues}
    phases = []
    while any(left.values()):
        active = {q: share[q] for q in queues if left[q] and share[q] > 0} or {q: Fraction(left[q]) for q in queues if left[q]}
        rounds = min(left[q] / w for q, w in active.items())
        give = {q: min(left[q], int(rounds * w)) for q, w in active.items()}
        phases.append(tuple(give.get(q, 0) for q in queues))
        left = {q: left[q] - give.get(q, 0) for q in queues}
    return Schedule(queues, tuple(phases))


def pack(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    length: int = 1024,
    window: int = 64,
    targets: Mapping[str, float] | None = None,
    path: str | None = None,
    max_queues: int = 1024,
) -> DataFrame:
    """One row per piece: id, ``source`` queue, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id``, ``offset``. A sequence has ``length`` ids; only the last one of all can be shorter.

    Each window of ``window`` sequences holds the sources in the target proportions. Null and empty texts are the end id
    alone; a null source is the empty one; a row that repeats an id is a document of its own. With more than
    ``max_queues`` sources the smaller ones share the queue "other", which bounds what the driver holds. An empty table
    gives no rows. Extra columns are ignored.
    """
    spark, path = docs.sparkSession, path or vocabulary_path()
    rows = saved(tokenised(docs, path, id_col=id_col, text_col=text_col, source_col=source_col, max_queues=max_queues), "tokens")
    blocks = rows.groupBy("queue", "block").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("queue").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = saved(blocks.select("queue", "block", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    totals = {r["queue"]: r["n"] for r in bases.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    plan = schedule(totals, targets)
    span, total = length * window, sum(totals.values())
    number = {q: k for k, q in enumerate(plan.queues)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        served = lru_cache(maxsize=4096)(lambda w: plan.served(min(w * span, total)))
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                out: list[list] = [[] for _ in range(8)]
                for key, q, at, n, raw in zip(part.column(0), *(part.column(k).to_pylist() for k in range(1, 5))):
                    ids = np.frombuffer(raw, "<u2").astype("<u4") if len(raw) == 2 * n else np.frombuffer(raw[1:], "<u4")
                    k, pos = number[q], at
                    low, high = 0, -(-total // span)
                    while high - low > 1:  # the window that holds the document's first id
                        mid = (low + high) // 2
                        low, high = (mid, high) if served(mid)[k] <= at else (low, mid)
                    while pos < at + n:
                        here, then = served(low), served(low + 1)
                        if then[k] <= pos:
                            low += 1
                            continue
                        place = low * span + sum(then[:k]) - sum(here[:k]) + pos - here[k]
                        take = min(at + n, then[k], pos + length - place % length) - pos
                        values = (key, q, pos - at, take, ids[pos - at : pos - at + take].tobytes(), n, place // length, place % length)
                        for column, value in zip(out, values):
                            column.append(value)
                        pos += take
                kinds = [batch.schema.field(0).type, pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                names = [id_col, "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
                yield pa.RecordBatch.from_arrays([pa.array([v.as_py() for v in c] if j == 0 else c, t) for j, (c, t) in enumerate(zip(out, kinds))], names=names)

    placed = rows.join(bases.select("queue", "block", "base"), ["queue", "block"])
    whole = placed.select("__id", "queue", (F.col("base") + F.col("start")).alias("at"), "n", "ids")
    kind = rows.schema["__id"].dataType.simpleString()
    return whole.mapInArrow(cut, f"`{id_col}` {kind}, source string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")

