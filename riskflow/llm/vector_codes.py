"""Product codes of vectors: codebooks by exact rounds of nearest entries, in which bounds save most of the distances."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import saved

SCALE = 1024
ENTRIES = 256
GROUP = 16  # entries that share a bound
LARGEST = 1 << 28  # of a component as an integer: sums of squares stay exact
BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class Codebooks:
    """``history[t]``: the entries (part, entry, position) after t rounds. ``scans[t]``: groups of entries that assignment t
    compared, ``possible[t]``: groups there were."""

    history: list[np.ndarray]
    scans: list[int] = field(default_factory=list)
    possible: list[int] = field(default_factory=list)

    @property
    def entries(self) -> np.ndarray:
        return self.history[-1]

    def text(self) -> str:
        """All components in decimal, by part, entry and position."""
        return ",".join(map(str, self.entries.ravel().tolist()))


class Assignment:
    """Nearest entries under bounds that know their round.

    A bound is a distance that every entry of a group (but the one a part is assigned to) had at least in round s. In
    round t none of them can be nearer than the bound less the largest net displacement |c_t - c_s| in the group: the norm
    of the sum of its steps, which is at most the sum of their norms. Only where this does not exceed the exact distance
    to the assigned entry is the group compared again. Bounds are kept as floors, displacements as ceilings, and a group is
    skipped only if all of it is strictly farther, so ties go to the lower index as if all were compared.
    """

    def __init__(self, history: list[np.ndarray]):
        self.now, self.round = history[-1].astype(np.float64), len(history) - 1
        parts, entries, _ = self.now.shape
        self.starts = np.arange(0, entries, GROUP)
        moved = np.stack([np.sqrt(((self.now - old) ** 2).sum(axis=2)) for old in history])
        self.moved = np.ceil(np.maximum.reduceat(moved, self.starts, axis=2)).astype(np.int64)  # (stamp, part, group)
        self.state = np.dtype([("at", "u1", (parts,)), ("bound", "u2", (parts, len(self.starts))), ("stamp", "u1", (parts, len(self.starts)))])

    def __call__(self, vectors: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, int]:
        """``vectors`` (row, part, position) as float64 integers. Changes ``state``; gives squared distances (row, part) and
        the number of groups compared."""
        out, scans = np.empty(vectors.shape[:2]), 0
        for p in range(vectors.shape[1]):
            out[:, p], n = self._part(p, vectors[:, p], state["at"][:, p], state["bound"][:, p], state["stamp"][:, p])
            scans += n
        return out, scans

    def _part(self, p: int, x: np.ndarray, at: np.ndarray, bound: np.ndarray, stamp: np.ndarray) -> tuple[np.ndarray, int]:
        entries, was = self.now[p], at.copy()
        own = ((x - entries[was]) ** 2).sum(axis=1)
        best, least = own.copy(), bound - self.moved[stamp, p, np.arange(len(self.starts))]
        near = (least <= 0) | (least.astype(np.float64) ** 2 <= own[:, None])
        squares, length = (entries**2).sum(axis=1), (x**2).sum(axis=1)
        second = {}
        for g, start in enumerate(self.starts):
            rows = np.flatnonzero(near[:, g])
            if not len(rows):
                continue
            part = slice(start, start + GROUP)
            d = length[rows, None] - 2 * (x[rows] @ entries[part].T) + squares[part]
            first = d.argmin(axis=1)
            d1 = d[np.arange(len(rows)), first]
            better = (d1 < best[rows]) | (d1 == best[rows]) & (first + start < at[rows])
            best[rows[better]], at[rows[better]] = d1[better], first[better] + start
            second[g] = rows, d
        for g, (rows, d) in second.items():  # bounds leave out the entry that is assigned now
            place = at[rows].astype(np.int64) - self.starts[g]
            inside = (place >= 0) & (place < d.shape[1])
            d[np.flatnonzero(inside), place[inside]] = np.inf
            bound[rows, g] = np.minimum(np.floor(np.sqrt(np.minimum(d.min(axis=1), 1e12))), 65535)
            stamp[rows, g] = self.round
        left, group = at != was, was // GROUP
        rows = np.flatnonzero(left & ~near[np.arange(len(x)), group])  # the entry that was left counts in its group again
        g = group[rows]
        bound[rows, g] = np.minimum(np.maximum(least[rows, g], 0), np.minimum(np.floor(np.sqrt(own[rows])), 65535))
        stamp[rows, g] = self.round
        return best, int(near.sum())


def usable(df: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, vector) of the rows whose vector is there, is not empty and holds only finite numbers."""
    rows = df.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__label"), F.col(vector_col).cast("array<double>").alias("__vector"))
    finite = F.forall("__vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return rows.where(F.col("__vector").isNotNull() & (F.size("__vector") > 0)).where(finite)


def _integers(column: pa.ListArray, scale: int) -> np.ndarray:
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False) * scale)
    if len(flat) and np.abs(flat).max() >= LARGEST:
        raise ValueError(f"a component is at least {LARGEST} / {scale}")
    return flat.reshape(len(column), -1)


def _first_entries(rows: DataFrame, parts: int) -> np.ndarray:
    """The parts of the vectors of the smallest ids; at most ``ENTRIES`` rows reach the driver."""
    smallest = rows.select("__id").where("__id IS NOT NULL").distinct().orderBy("__id").limit(ENTRIES).agg(F.max("__id")).first()[0]
    found = rows.where(F.col("__id") <= smallest).groupBy("__id").agg(F.min("__vector").alias("v")).orderBy("__id").collect() if smallest is not None else []
    vectors = np.floor(np.array([r["v"] for r in found], np.float64) * SCALE)
    return vectors.reshape(len(found), parts, -1).swapaxes(0, 1).astype(np.int64)


def _assigned(history: list[np.ndarray], last: bool):
    """The step over a task's rows: vectors with new state and the sums of each entry, or (last) codes and errors."""
    parts, entries, width = history[-1].shape

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Assignment(history)
        sums, counts, scans, possible = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64), 0, 0
        for rows in batches:
            if not rows.num_rows:
                continue
            if rows.schema.names[-1] == "state":
                x = np.frombuffer(b"".join(rows.column("vector").to_pylist()), np.int32).reshape(-1, parts, width).astype(np.float64)
                state = np.frombuffer(bytearray(b"".join(rows.column("state").to_pylist())), nearest.state)
            else:
                x = _integers(rows.column(2), SCALE).reshape(-1, parts, width)
                state = np.zeros(len(x), nearest.state)
            error, n = nearest(x, state)
            scans, possible = scans + n, possible + state["bound"].size
            if last:
                codes = [r.tobytes().hex() for r in state["at"]]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(codes), pa.array(error.sum(axis=1).astype(np.int64))], names=["__id", "__label", "code", "error"])
                continue
            for p in range(parts):
                counts[p] += np.bincount(state["at"][:, p], minlength=entries)
                for d in range(width):
                    sums[p, :, d] += np.bincount(state["at"][:, p], weights=x[:, p, d], minlength=entries).astype(np.int64)
            raw, size = x.astype(np.int32).tobytes(), 4 * parts * width
            kept, width_ = state.tobytes(), nearest.state.itemsize
            n = len(x)
            yield _rows("row", rows.column(0), rows.column(1), [raw[i * size : (i + 1) * size] for i in range(n)], [kept[i * width_ : (i + 1) * width_] for i in range(n)])
        if not last and possible:
            found = np.argwhere(counts)
            yield _sums(template, [(int(p), int(e), int(counts[p, e]), sums[p, e].tolist()) for p, e in found] + [(-1, 0, scans, []), (-1, 1, possible, [])])

    template: list[pa.DataType] = []

    def _rows(kind, ids, labels, vectors, states):
        template[:] = [ids.type, labels.type]
        n = len(vectors)
        null = lambda t: pa.nulls(n, t)
        return pa.RecordBatch.from_arrays([ids, labels, pa.array(vectors, pa.binary()), pa.array(states, pa.binary()), null(pa.int32()), null(pa.int32()), null(pa.int64()), null(pa.list_(pa.int64())), pa.array([kind] * n)], names=NAMES)

    def _sums(types, rows):
        part, entry, count, total = zip(*rows)
        n = len(rows)
        return pa.RecordBatch.from_arrays([pa.nulls(n, types[0]), pa.nulls(n, types[1]), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count, pa.int64()), pa.array(total, pa.list_(pa.int64())), pa.array(["sum"] * n)], names=NAMES)

    return of


NAMES = ["__id", "__label", "vector", "state", "part", "entry", "n", "total", "kind"]


def encode(df: DataFrame, *, rounds: int = 4, parts: int = 4, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> tuple[DataFrame, Codebooks]:
    """((id, label, ``code``, ``error``) per usable row, codebooks).

    Components become floor(1024 x); vectors are cut into ``parts`` equal parts. Each part's codebook starts as that part of
    the vectors of the 256 smallest ids. A round assigns each part to its nearest entry by squared Euclidean distance, ties
    to the lower index, then puts the floor of the mean of its parts in place of each entry that has any. After the last
    round parts are assigned once more: ``code`` has two hexadecimal digits a part, ``error`` the sum of the distances.

    A round is one pass that shuffles no vector: tasks carry bounds along with the vectors (see ``Assignment``) and hand
    on sums of entries. What reaches the driver in a round is one codebook; what tasks are sent is all earlier ones.

    Left out: rows with a null or empty vector or with components that are null or not finite, and rows whose vector is not as
    long as that of the smallest id (that length must divide by ``parts``). Of rows that repeat an id the smallest vector
    may become an entry, all are coded. Rows without id are coded but become no entry. With fewer than 256 ids there are
    so many entries; with none there are no rows. A component of 2**28 or more after scaling is an error.
    """
    rows = usable(df, id_col, label_col, vector_col)
    smallest = rows.where("__id IS NOT NULL").agg(F.min(F.struct("__id", F.size("__vector").alias("n")))).first()[0]
    kinds = [f.dataType.simpleString() for f in rows.schema.fields[:2]]
    if smallest is None:
        none = rows.limit(0).select(F.col("__id").alias(id_col), F.col("__label").alias(label_col), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return none, Codebooks([np.zeros((parts, 0, 0), np.int64)])
    if smallest["n"] % parts:
        raise ValueError(f"vectors of {smallest['n']} components cannot be cut into {parts} equal parts")
    now = rows.where(F.size("__vector") == smallest["n"])
    books = Codebooks([_first_entries(now, parts)])
    schema = f"__id {kinds[0]}, __label {kinds[1]}, vector binary, state binary, part int, entry int, n long, total array<long>, kind string"
    for _ in range(rounds):
        step = saved(now.mapInArrow(_assigned(books.history, False), schema), "vector_codes", ["kind"])
        sums = step.where("kind = 'sum'").select("part", "entry", "n", F.posexplode_outer("total").alias("position", "value"))
        totals = sums.groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("value").alias("value")).collect()
        entries = books.entries.copy()
        for r in totals:
            if r["part"] >= 0:
                entries[r["part"], r["entry"], r["position"]] = r["value"] // r["n"]
        books.scans.append(sum(r["n"] for r in totals if (r["part"], r["entry"]) == (-1, 0)))
        books.possible.append(sum(r["n"] for r in totals if (r["part"], r["entry"]) == (-1, 1)))
        books.history.append(entries)
        now = step.where("kind = 'row'").select("__id", "__label", "vector", "state")
    coded = now.mapInArrow(_assigned(books.history, True), f"__id {kinds[0]}, __label {kinds[1]}, code string, error long")
    return saved(coded, "vector_codes").withColumnsRenamed({"__id": id_col, "__label": label_col}), books


def with_label_error(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """Add ``label_error``: the sum of ``error`` over the rows of equal label, null labels together.

    Totals of up to 32 MB, by their counted size, are broadcast, others joined by a shuffle that splits a hot label.
    """
    totals = saved(coded.groupBy(F.col(label_col).alias("__label")).agg(F.sum("error").alias("label_error")), "label_error")
    size = totals.agg(F.sum(F.lit(32) + F.coalesce(F.octet_length(F.col("__label").cast("string")), F.lit(0)))).first()[0] or 0
    totals = F.broadcast(totals) if size <= BROADCAST_BYTES else totals
    return coded.join(totals, coded[label_col].eqNullSafe(totals["__label"]), "left").drop("__label")
