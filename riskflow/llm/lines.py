"""Line deduplication: documents ask a sharded minimal perfect hash over all distinct lines which of their lines an earlier document holds."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import mix64, parallelism, saved, text_of

WHITE = b" \t\n\v\f\r"
LAST = (1 << 63) - 1  # stands for a null id: after every other
SHARD_BYTES = 64 << 20  # bytes of text whose lines one shard takes, and of postings that one task probes
FLUSH_KEYS = 1_000_000  # (document, key) entries that a task merges before it writes them
SPREAD = 2.0  # places per key in a level of the hash


class PerfectHash:
    """A minimal perfect hash of distinct 128-bit keys, in levels of bits.

    A key that is alone at its place in a level sets the bit there, the others go on to the next level; a key's number is
    the rank of its bit, from 0 to the number of keys less 1. Some 3.7 bits a key. A key that is not in the set gets any
    number or -1, so whoever may ask for such keys has to compare a fingerprint.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        ones = [np.bitwise_count(words).astype(np.int64) for words in levels]
        start = np.concatenate([[0], np.cumsum([x.sum() for x in ones], dtype=np.int64)])
        self.before = [s + np.cumsum(x) - x for s, x in zip(start, ones)]

    @staticmethod
    def _place(keys: np.ndarray, level: int, words: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64(keys[:, 0] + mix64(keys[:, 1] + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15))) % np.uint64(64 * words)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: distinct rows of two 64-bit halves."""
        levels = []
        while len(keys):
            words = int(len(keys) * SPREAD) // 64 + 1
            at = cls._place(keys, len(levels), words)
            alone = np.bincount(at.astype(np.int64), minlength=64 * words) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            keys = keys[~alone[at]]
        return cls(levels)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        found, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, words in enumerate(self.levels):
            at = self._place(keys[todo], level, len(words))
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            found[todo[hit]] = (self.before[level][word] + np.bitwise_count(below))[hit]
            todo = todo[~hit]
        return found

    def dump(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], np.uint64)
        return b"".join([sizes.tobytes(), *(x.tobytes() for x in self.levels)])

    @classmethod
    def load(cls, raw: bytes) -> PerfectHash:
        words = np.frombuffer(raw, np.uint64)
        ends = np.cumsum(words[: int(words[0]) + 1].astype(np.int64))
        ends += len(words) - ends[-1]  # the levels stand at the end
        return cls([words[a:b] for a, b in zip(ends, ends[1:])])


class Shard:
    """What is known of the lines of one shard, by their numbers: fingerprint, documents that hold it, and the smallest
    of these where there are several. Counts take as few bytes as the largest needs."""

    def __init__(self, levels: bytes, prints: bytes, counts: bytes, owners: bytes):
        self.hash, self.prints = PerfectHash.load(levels), np.frombuffer(prints, np.uint32)
        self.counts = np.frombuffer(counts, np.dtype(f"u{len(counts) // max(1, len(self.prints)) or 1}"))
        self.owners, self.several = np.frombuffer(owners, np.int64), np.cumsum(self.counts > 1)

    @staticmethod
    def row(keys: np.ndarray, counts: np.ndarray, owners: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
        """The four arrays of distinct keys."""
        table = PerfectHash.of(keys)
        order = np.argsort(table(keys))
        prints, counts, owners = _print(keys[order]), counts[order], owners[order]
        width = next(w for w in (1, 2, 4, 8) if counts.max(initial=0) < 1 << (8 * w))
        return table.dump(), prints.tobytes(), counts.astype(f"u{width}").tobytes(), owners[counts > 1].tobytes()

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each key: the number of documents that hold it (0: unknown), and the smallest of them where there are several."""
        at = self.hash(keys)
        known = at >= 0
        known[known] = self.prints[at[known]] == _print(keys[known])
        counts, owners = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.int64)
        counts[known] = self.counts[at[known]]
        several = counts > 1
        owners[several] = self.owners[self.several[at[several]] - 1]
        return counts, owners


def _print(keys: np.ndarray) -> np.ndarray:
    return (keys[:, 1] >> np.uint64(32)).astype(np.uint32)


def _key(line: bytes, least: int) -> bytes | None:
    """The 128-bit hash of a line's key: stripped, A-Z lower-cased; None if it has fewer than ``least`` code points."""
    line = line.strip(WHITE).lower()
    if len(line) < least or not line.isascii() and sum(b & 0xC0 != 0x80 for b in line) < least:
        return None
    return blake2b(line, digest_size=16).digest()


def _merged(keys: np.ndarray, counts: np.ndarray, owners: np.ndarray, shards: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in the order of (shard, key), with summed counts and smallest owners; the order and the starts used."""
    order = np.lexsort((keys[:, 1], keys[:, 0], *([shards] if shards is not None else [])))
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first), np.minimum.reduceat(owners[order], first), order, first


def _postings(least: int, shards: int):
    """(shard, batch, keys, counts, owners, docs) of the texts of a task: each key once, however many documents hold it."""
    names = ["shard", "batch", "keys", "counts", "owners", "docs"]
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]

    def flushed(raw: bytearray, docs: list[np.ndarray], batch: int) -> Iterator[pa.RecordBatch]:
        keys, ids = np.frombuffer(bytes(raw), np.uint64).reshape(-1, 2), np.concatenate(docs)
        shard = (keys[:, 0] % np.uint64(shards)).astype(np.int32)
        distinct, counts, owners, order, first = _merged(keys, np.ones(len(keys), np.int64), ids, shard)
        own, ids, ends = shard[order][first], ids[order], np.append(first, len(ids))
        cuts = np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(own))
        for i in range(0, len(cuts) - 1, 1000):
            spans = list(zip(cuts[i : i + 1000], cuts[i + 1 : i + 1001]))
            rows = [(int(own[a]), batch, distinct[a:b].tobytes(), counts[a:b].tobytes(), owners[a:b].tobytes(), ids[ends[a] : ends[b]].tobytes()) for a, b in spans]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, docs, batch = bytearray(), [], TaskContext.get().partitionId() << 32
        for rows in batches:
            for i, text in zip(rows.column(0), rows.column(1)):
                keys = {k for line in text.as_py().split(b"\n") if (k := _key(line, least))}
                if keys:
                    raw += b"".join(keys)
                    docs.append(np.full(len(keys), i.as_py(), np.int64))
                if len(raw) >= 16 * FLUSH_KEYS:
                    yield from flushed(raw, docs, batch)
                    raw, docs, batch = bytearray(), [], batch + 1
        if docs:
            yield from flushed(raw, docs, batch)

    return of


def _column(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), kind)


def _shard(table: pa.Table) -> pa.Table:
    keys, counts, owners, _, _ = _merged(_column(table, "keys", np.uint64).reshape(-1, 2), _column(table, "counts", np.int64), _column(table, "owners", np.int64))
    row = Shard.row(keys, counts, owners)
    return pa.table({"shard": table["shard"][:1], **{n: pa.array([x], pa.binary()) for n, x in zip(("levels", "prints", "counts", "owners"), row)}})


def index_lines(postings: DataFrame) -> DataFrame:
    """(shard, levels, prints, counts, owners): the hash and the arrays of all distinct keys, one row a shard."""
    kind = "shard int, levels binary, prints binary, counts binary, owners binary"
    return saved(postings.select("shard", "keys", "counts", "owners").groupBy("shard").applyInArrow(_shard, kind), "line_index")


def _probed(probes: pa.Table, index: pa.Table) -> pa.Table:
    """(doc, keys): the keys that a document loses, of one shard."""
    if not probes.num_rows or not index.num_rows:
        return pa.table({"doc": pa.array([], pa.int64()), "keys": pa.array([], pa.binary())})
    shard = Shard(*(index[n][0].as_py() for n in ("levels", "prints", "counts", "owners")))
    keys, counts, docs = _column(probes, "keys", np.uint64).reshape(-1, 2), _column(probes, "counts", np.int64), _column(probes, "docs", np.int64)
    held, owners = shard(keys)
    each = np.repeat(np.arange(len(keys)), counts)
    lost = np.flatnonzero((held[each] > 1) & (owners[each] != docs))
    lost = lost[np.argsort(docs[lost], kind="stable")]
    ids, starts = np.unique(docs[lost], return_index=True)
    raw, ends = keys[each[lost]].tobytes(), np.append(starts, len(lost)) * 16
    return pa.table({"doc": pa.array(ids, pa.int64()), "keys": pa.array([raw[a:b] for a, b in zip(ends, ends[1:])], pa.binary())})


def lost_keys(postings: DataFrame, index: DataFrame) -> DataFrame:
    """(doc, keys): for each document that loses lines, the hashes of their keys, joined.

    A shard that many postings ask is copied to several tasks, some ``SHARD_BYTES`` of postings each.
    """
    load = F.sum(F.octet_length("docs") + F.octet_length("keys"))
    # One row of 16 bytes for every SHARD_BYTES of postings, at most.
    hot = F.broadcast(postings.groupBy("shard").agg(F.ceil(load / SHARD_BYTES).cast("int").alias("copies")).where("copies > 1"))
    copies = F.coalesce("copies", F.lit(1))
    asked = postings.select("shard", "batch", "keys", "counts", "docs").join(hot, "shard", "left").withColumn("copy", F.pmod(F.xxhash64("batch"), copies).cast("int"))
    known = index.join(hot, "shard", "left").withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    lost = asked.drop("copies", "batch").groupBy("shard", "copy").cogroup(known.drop("copies").groupBy("shard", "copy")).applyInArrow(_probed, "doc long, keys binary")
    # The keys of one document are at most 16 bytes for each of its lines.
    return saved(lost, "lost_lines").groupBy("doc").agg(F.collect_list("keys").alias("__lost"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for rows in batches:
        for i in range(0, rows.num_rows, 500):
            part = rows.slice(i, 500)
            yield part.set_column(1, "__text", pa.array([pack(x.as_py()) for x in part.column(1)], pa.binary()))


def _cut(least: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for rows in batches:
            for i in range(0, rows.num_rows, 500):
                part, out = rows.slice(i, 500), []
                for packed, lost in zip(part.column(1), part.column(2)):
                    lines = unpack(packed.as_py()).split(b"\n")
                    lost = {raw[k : k + 16] for raw in lost.as_py() or () for k in range(0, len(raw), 16)}
                    kept = [x for x in lines if _key(x, least) not in lost] if lost else lines
                    out.append((len(lines), len(lines) - len(kept), b"\n".join(kept)))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary())))], names=["__id", "n_lines", "n_dropped", "kept"])

    return of


def drop_repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 10, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per row: id, ``n_lines``, ``n_dropped``, ``text`` without the lines that a document with a smaller id holds.

    Lines end at a newline. A line's key is the line without white space at both ends, A-Z lower-cased; keys of fewer
    than ``least`` code points are no reason to drop a line. A key that several documents hold stays in that with the
    smallest id only, there with all its lines. The ids are integers.

    One pass over the texts hashes each key to 128 bits; a task writes a key once for all of its documents. All distinct
    keys are then dealt to shards, each a minimal perfect hash with a fingerprint, a count and, where several documents
    hold a key, the smallest id. The written keys ask their shard, so a line that every document holds is asked once a
    task. What a document loses meets its text, which travels compressed. No text is collected, none is cut.

    Null and empty texts have one empty line. Rows that repeat an id are one document with regard to its smallest id: what
    one of them keeps for it, all keep. A null id comes after all others. An empty table gives no rows, extra columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("__id"), text_of(text_col).cast("binary").alias("__text"))
    size = texts.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    shards = max(parallelism(spark), -(-size // shard_bytes))
    numbered = texts.select(F.coalesce(F.col("__id").cast("long"), F.lit(LAST)).alias("__doc"), "__text")
    schema = "shard int, batch long, keys binary, counts binary, owners binary, docs binary"
    postings = saved(numbered.mapInArrow(_postings(least, shards), schema), "line_postings")
    lost = lost_keys(postings, index_lines(postings))
    packed = texts.mapInArrow(_packed, f"__id {kind}, __text binary").withColumn("__doc", F.coalesce(F.col("__id").cast("long"), F.lit(LAST)))
    both = packed.join(lost, packed["__doc"] == lost["doc"], "left").select("__id", "__text", "__lost")
    cut = both.mapInArrow(_cut(least), f"__id {kind}, n_lines long, n_dropped long, kept binary")
    return cut.select(F.col("__id").alias(id_col), "n_lines", "n_dropped", F.col("kept").cast("string").alias("text"))
