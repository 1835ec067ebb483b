"""Near-duplicate documents: an exact Jaccard self-join on word n-grams by universe partition and pigeonhole.

Two sets with Jaccard similarity of 3/4 or more differ in at most a seventh of their summed sizes. Tokens are hashed into
segments, whose number depends on the size band; a token that only one of two sets has spoils one segment, so two similar
sets have at least one segment in common that is not empty. The subset of tokens in a segment is what is indexed. The
smallest sets, where at most one token differs, have one segment and are indexed with their one-deletion neighbourhoods;
beyond, a neighbourhood costs more entries than the segments it saves. After the lists are counted, each set pays only
for the cheapest ones that still guarantee a meeting. What meets is verified on the whole texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import mix64, parallelism, saved, text_of
from riskflow.llm.graph import components

BROADCAST_IDS = 1_000_000  # documents (16 bytes each) up to which a list of ids is broadcast
TINY = 5  # sets of up to so many tokens, where similar sets differ in one token at most
FEW_PIVOTS = 8  # sets of an unfinished list that are compared with the others before all pairs across components are
EARLIER = 8  # lists before a list that each set is known to be in
LIST_BLOCK = 1024  # sets of a list that a task compares with as many others
FLUSH = 1_000_000  # list entries that a task holds before it sends them on
U64 = np.uint64


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the runs of ``width`` words; with fewer words, of the whole sequence."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, U64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))
    k = min(width, len(words))
    with np.errstate(over="ignore"):
        total = np.zeros(len(words) - k + 1, U64)
        for i in range(k):
            total = total * U64(0x9E3779B97F4A7C15) + hashes[i : len(words) - k + 1 + i]
        return np.unique(mix64(total + U64(k)))


class Scheme:
    """Bounds for a similarity of ``num / den`` or more."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def differing(self, n: int, other: int) -> int:
        """How many tokens two similar sets of these sizes can have that the other one lacks."""
        return (n + other) * (self.den - self.num) // (self.den + self.num)

    def largest(self, n: int) -> int:
        return n * self.den // self.num

    def band(self, n: int) -> int:
        """The end of the size band; bands end at powers of two."""
        return TINY + 1 if n <= TINY else 1 << n.bit_length()

    def start(self, end: int) -> int:
        return max(TINY + 1, end >> 1) if end > TINY + 1 else 1

    def segments(self, end: int) -> int:
        """Enough that a set has more segments with tokens than can be spoiled, with some to spare."""
        if end == TINY + 1:
            return 1
        share = (self.den - self.num) / self.num
        return end if end <= 64 else math.ceil(end * (share * 1.2)) + 8

    def places(self, n: int) -> list[tuple[int, int, int]]:
        """(band end, differing tokens, 1 for a lower band) for each band under which a set of n tokens is listed: its own,
        and the one below if similar sets can be there. A pair meets in the band of the smaller set."""
        end = self.band(n)
        out = [(end, self.differing(n, self.largest(n)), 0)]
        below = self.start(end) - 1
        if below >= 1 and below * self.den >= n * self.num:
            out.append((self.band(below), self.differing(n, below), 1))
        return [x for x in out if x[1] > 0]  # where nothing may differ only copies are similar

    def similar(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return len(a) > 0 and self.den * both >= self.num * (len(a) + len(b) - both)


def signatures(tokens: np.ndarray, end: int, bound: int, scheme: Scheme) -> tuple[np.ndarray, int]:
    """What a set is listed under in a band, and how many of these lists it can leave out for each one that it shares with
    nobody. The lowest bit marks empty segments, listed only by sets that have too few others."""
    m = scheme.segments(end)
    if m == 1:
        mixed = mix64(tokens)
        with np.errstate(over="ignore"):
            total = mixed.sum(dtype=U64)
            found = np.append(total - mixed, total)  # each set without one token, and the set
        return mix64(found ^ U64(end)) & ~U64(1), 0
    place = ((tokens >> U64(32)) * U64(m)) >> U64(32)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    with np.errstate(over="ignore"):
        inside = np.add.reduceat(mix64(tokens), first)
        name = mix64(place[first] * U64(0x9E3779B97F4A7C15) + U64(end))
        found = mix64(inside + name) & ~U64(1)
        if len(found) <= bound:
            empty = np.setdiff1d(np.arange(m, dtype=U64), place[first])
            found = np.append(found, mix64(empty * U64(0x9E3779B97F4A7C15) + U64(end)) | U64(1))
    return found, len(found) - bound - 1


def _node(digest: bytes, renamed: frozenset[bytes]) -> int:
    """A set's number: 62 bits of its digest, times two."""
    raw = xxhash.xxh3_64_intdigest(digest) if digest in renamed else int.from_bytes(digest[:8], "little")
    return (raw >> 2) << 1


def _digests(width: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), width) for t in batch.column(1)]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            nodes = [None if d is None else _node(d, frozenset()) for d in digests]
            columns = [batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(nodes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "version", "n", "digest", "node"])

    return run, f"id {kind}, version long, n long, digest binary, node long"


def _lists(width: int, scheme: Scheme, buckets: int, renamed: frozenset[bytes]):
    """Sends each distinct set of a task once, packed by bucket: ``entries`` (set numbers, + 1 in a lower band), and for each
    listed signature the entry's place and 48 bits. Buckets below 0 hold what entries can leave out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        entries, spare, lists, held = [], [], [], 0
        for batch in batches:
            for text in batch.column(0):
                tokens = shingles(text.as_py(), width)
                digest = xxhash.xxh3_128_digest(tokens.tobytes())
                if not len(tokens) or digest in seen:
                    continue
                seen.add(digest)
                for end, bound, low in scheme.places(len(tokens)):
                    found, free = signatures(tokens, end, bound, scheme)
                    entries.append(_node(digest, renamed) + low)
                    spare.append(free)
                    lists.append(found)
                    held += len(found)
                if held >= FLUSH or len(entries) >= 60_000:
                    yield packed(entries, spare, lists, buckets)
                    entries, spare, lists, held = [], [], [], 0
        if entries:
            yield packed(entries, spare, lists, buckets)

    return run, "bucket int, entries binary, place binary, low binary, high binary"


def packed(entries: list[int], spare: list[int], lists: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    names, sig = np.array(entries, np.int64), np.concatenate(lists)
    owner = np.repeat(np.arange(len(entries), dtype=np.uint16), [len(x) for x in lists])
    bucket = ((sig >> U64(40)) % U64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    sig, owner, bucket = sig[order], owner[order], bucket[order]
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    rows = [(-1 - int(names[0] // 2 % buckets), names.tobytes(), b"", np.array(spare, np.int32).tobytes(), b"")]
    for i, j in zip(first, np.append(first[1:], len(sig))):
        used, place = np.unique(owner[i:j], return_inverse=True)
        low, high = (sig[i:j] & U64(0xFFFFFFFF)).astype("<u4"), ((sig[i:j] >> U64(32)) & U64(0xFFFF)).astype("<u2")
        rows.append((int(bucket[i]), names[used].tobytes(), place.astype("<u2").tobytes(), low.tobytes(), high.tobytes()))
    kinds = [pa.int32()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "entries", "place", "low", "high"])


def _shared(table: pa.Table) -> pa.Table:
    """Of one bucket: (entry, sig, size) of the lists that hold two sets or more; or what entries can leave out."""
    rows = [[x.as_py() for x in table.column(k)] for k in range(1, 5)]
    names = [np.frombuffer(x, np.int64) for x in rows[0]]
    bucket = table.column(0)[0].as_py()
    if bucket < 0:
        entry, free = np.concatenate(names), np.concatenate([np.frombuffer(x, np.int32) for x in rows[2]])
        return pa.table({"entry": entry, "sig": pa.nulls(len(entry), pa.int64()), "size": free.astype(np.int32)})
    entry = np.concatenate([n[np.frombuffer(p, "<u2")] for n, p in zip(names, rows[1])])
    sig = np.concatenate([np.frombuffer(x, "<u4") for x in rows[2]]).astype(U64)
    sig |= np.concatenate([np.frombuffer(x, "<u2") for x in rows[3]]).astype(U64) << U64(32)
    order = np.lexsort((entry, sig))
    entry, sig = entry[order], sig[order]
    fresh = np.append(True, (sig[1:] != sig[:-1]) | (entry[1:] != entry[:-1]))  # a copy from another task
    entry, sig = entry[fresh], sig[fresh]
    first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
    size = np.diff(np.append(first, len(sig)))
    size = np.repeat(size, size)
    many = size > 1
    with np.errstate(over="ignore"):
        name = (mix64(sig[many] + (U64(bucket + 1) << U64(48))) & ~U64(1)) | (sig[many] & U64(1))
    return pa.table({"entry": entry[many], "sig": name.view(np.int64), "size": size[many].astype(np.int32)})


def meeting_lists(texts: DataFrame, width: int, scheme: Scheme, renamed: frozenset[bytes]) -> DataFrame:
    """(sig, node): of each set the rarest lists, just so many that similar sets meet in one. Sets whose lists are nearly
    all their own have no similar set and drop out."""
    buckets = 4 * parallelism(texts.sparkSession)
    run, kinds = _lists(width, scheme, buckets, renamed)
    shared = texts.mapInArrow(run, kinds).groupBy("bucket").applyInArrow(_shared, "entry long, sig long, size int")
    order = Window.partitionBy("entry").orderBy(F.col("sig").isNull(), F.col("sig").bitwiseAND(1), "size", "sig")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = shared.select(
        "entry",
        "sig",
        F.row_number().over(order).alias("rank"),
        F.count("sig").over(whole).alias("shared"),
        F.min(F.when(F.col("sig").isNull(), F.col("size"))).over(whole).alias("spare"),
    )
    kept = ranked.where(F.col("sig").isNotNull() & (F.col("rank") <= F.col("shared") - F.col("spare")))
    return kept.select("sig", F.col("entry").bitwiseAND(~1).alias("node"))


def numbered(sets: DataFrame) -> tuple[DataFrame, frozenset[bytes]]:
    """(digest, node, rep, version, copies, n): the distinct digests of rows (id, version, n, digest, node), with the smallest id that
    has each. ``node`` is a number; digests that agree in its 62 bits, of which there are hardly any, get another one."""
    least = F.min(F.struct(F.col("id").isNull(), "id", "version")).alias("least")
    nodes = sets.where("n > 0").groupBy("digest", "node").agg(least, F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"))
    nodes = saved(nodes.select("digest", "node", F.col("least.id").alias("rep"), F.col("least.version").alias("version"), "copies", "n"), "nodes")
    doubled = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("node")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("digest"))
    again = nodes.join(doubled, "node", "left_semi").withColumn("rank", rank).where("rank > 1")
    renamed = frozenset(bytes(r["digest"]) for r in again.select("digest").collect())
    if renamed:
        other = F.udf(lambda d: _node(bytes(d), renamed), "long")
        nodes = nodes.withColumn("node", F.when(F.col("digest").isin([bytearray(d) for d in renamed]), other("digest")).otherwise(F.col("node")))
    return nodes, renamed


def bodies_of(texts: DataFrame, alive: DataFrame) -> DataFrame:
    """(node, text) of the rows (id, text, version) that stand for nodes (node, rep, version); their ids are broadcast if a
    count shows that they are few."""
    wanted = alive.select("rep", F.col("version").alias("of"), "node")
    wanted = F.broadcast(wanted) if alive.count() <= BROADCAST_IDS else wanted
    theirs = F.col("id").eqNullSafe(F.col("rep")) & (F.col("version") == F.col("of"))
    return saved(texts.join(wanted, theirs).select("node", "text").dropDuplicates(["node"]), "bodies")


def sketched(bodies: DataFrame, width: int) -> DataFrame:
    """(node, n, sketch): for each place of a table twice to four times as long as the set, whether an odd number of tokens
    falls on it. Each token that only one of two sets has changes one place, so sets differ in no fewer tokens than their
    sketches do in places. A sketch is folded to a shorter one by adding its halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), width) for t in batch.column(1)]
            flat = []
            for tokens in sets:
                places = max(64, 2 << len(tokens).bit_length())
                odd = np.bincount((tokens & U64(places - 1)).astype(np.int64), minlength=places) & 1
                flat.append(np.packbits(odd.astype(np.uint8)).tobytes())
            columns = [batch.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array(flat, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "sketch"])

    return saved(bodies.mapInArrow(run, "node long, n long, sketch binary"), "sketches")


def folded(sketch: bytes, size: int) -> np.ndarray:
    x = np.frombuffer(sketch, U64)
    while len(x) > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def may_be_similar(pairs: DataFrame, sketches: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs (a, b) that sizes and sketches allow to be similar."""
    side = lambda c: sketches.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    fits = F.least("n_a", "n_b") * scheme.den >= F.greatest("n_a", "n_b") * scheme.num
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(fits).select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in range(2, 6))):
                size = min(len(x), len(y)) // 8
                keep.append(int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum()) <= scheme.differing(n, m))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def crossing(ranked: DataFrame, sketches: DataFrame, scheme: Scheme, pivots: int | None) -> DataFrame:
    """The pairs (a, b) within a list that are not in one component and that sizes and sketches allow to be similar; with
    ``pivots``, only those with one of the first so many sets of a list. A task holds many short lists, or two blocks of
    a long one, never a long list; only pairs that pass leave it. Sets that met in one of the last ``EARLIER`` lists, in an
    order that is the same for all, are left out: they are compared in the first list that they share."""
    buckets = 4 * parallelism(ranked.sparkSession)
    order = Window.partitionBy("node").orderBy("sig")
    ranked = ranked.withColumn("earlier", F.collect_list("sig").over(order.rowsBetween(-EARLIER, -1)))
    block = F.floor((F.col("rank") - 1) / LIST_BLOCK)
    last = F.floor((F.max("rank").over(Window.partitionBy("sig")) - 1) / LIST_BLOCK)
    placed = ranked.withColumn("block", block).withColumn("last", last)
    others = F.sequence(F.lit(0).cast("long"), F.col("last")) if pivots is None else F.when(F.col("block") > 0, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("last")))
    spread = placed.withColumn("other", F.explode(others))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    task = F.when(F.col("last") == 0, F.pmod(F.xxhash64("sig"), F.lit(buckets))).otherwise(F.xxhash64("sig", low, high))
    rows = spread.select(task.alias("task"), F.xxhash64("sig", low, high).alias("part"), "node", "label", "rank", "block", (low < high).alias("cross"), "earlier")
    rows = rows.join(sketches, "node").select("task", "part", "node", "label", "rank", "block", "cross", "n", "sketch", "earlier")

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("part", "ascending"), ("rank", "ascending")])
        part, node, label, rank, block, n = (table[c].to_numpy() for c in ("part", "node", "label", "rank", "block", "n"))
        sketch, cross = table["sketch"].to_pylist(), table["cross"].to_numpy(zero_copy_only=False)
        earlier = np.tile(-1 - np.arange(len(part), dtype=np.int64)[:, None], EARLIER) * 2 - 1  # odd: like no other
        for k, sigs in enumerate(table["earlier"].to_pylist()):
            earlier[k, : len(sigs)] = sigs
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        found_a, found_b = [], []
        for i, j in zip(first, np.append(first[1:], len(part))):
            if j - i < 2 or (label[i:j] == label[i]).all():
                continue
            size = min(len(x) for x in sketch[i:j]) // 8
            places = np.stack([folded(x, size) for x in sketch[i:j]])
            step = max(1, 2_000_000 // ((j - i) * size))
            ends = j - i if pivots is None else int(np.searchsorted(rank[i:j], pivots, side="right"))
            for x in range(0, ends, step):
                y = min(x + step, ends)
                a, b = slice(i + x, i + y), slice(i, j)
                ok = (rank[a, None] < rank[None, b]) & (label[a, None] != label[None, b])
                if cross[i]:
                    ok &= block[a, None] != block[None, b]
                least, most = np.minimum(n[a, None], n[None, b]), np.maximum(n[a, None], n[None, b])
                ok &= least * scheme.den >= most * scheme.num
                differing = np.bitwise_count(places[x:y, None, :] ^ places[None, :, :]).sum(-1, dtype=np.int64)
                ok &= differing * (scheme.den + scheme.num) <= (least + most) * (scheme.den - scheme.num)
                a, b = (p + q for p, q in zip(np.nonzero(ok), (i + x, i)))
                for k in range(0, len(a), 100_000):
                    u, v = a[k : k + 100_000], b[k : k + 100_000]
                    fresh = ~(earlier[u][:, :, None] == earlier[v][:, None, :]).any((1, 2))
                    found_a.append(node[u[fresh]])
                    found_b.append(node[v[fresh]])
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return pa.table({"a": pa.array(join(found_a), pa.int64()), "b": pa.array(join(found_b), pa.int64())})

    return rows.groupBy("task").applyInArrow(run, "a long, b long").distinct()


def verified(pairs: DataFrame, texts: DataFrame, width: int, scheme: Scheme) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar. ``a`` repeats often; its set is made once for a run of rows."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, np.zeros(0, U64)
        for batch in batches:
            a, keep = batch.column(0).to_numpy(), []
            for key, one, two in zip(a, batch.column(2), batch.column(3)):
                if key != last:
                    last, own = key, shingles(one.as_py(), width)
                keep.append(scheme.similar(own, shingles(two.as_py(), width)))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    similarity: tuple[int, int] = (75, 100),
) -> DataFrame:
    """Per row: id, ``n_shingles``, ``copies`` (rows with the same set), ``component_id`` (smallest id reachable by links).

    Every row and whole text takes part. Sets that are equal are one node; links join different sets. In each list all
    sets are first compared with one, the pivot. Where that leaves a list in several components, a few more pivots from
    the smallest ones follow, then all pairs across components that are left. Sizes and sketches rule out most pairs
    without their texts. So every pair that meets is compared or ruled out, or its sets are connected already.

    Null and empty texts and texts of white space have no shingles, and are their own component. Rows that repeat an id
    share the smallest id's component as any other copies do; a null id is only its component's name if it has no other.
    An empty table gives no rows. Extra columns are ignored.
    """
    scheme = Scheme(*[x // math.gcd(*similarity) for x in similarity])
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("version", F.xxhash64("text"))
    run, kinds = _digests(width, texts.schema["id"].dataType.simpleString())
    sets = saved(texts.mapInArrow(run, kinds), "sets")
    nodes, renamed = numbered(sets)
    lists = saved(meeting_lists(texts.select("text"), width, scheme, renamed), "lists")
    alive = saved(nodes.join(lists.select("node").distinct(), "node", "left_semi").select("node", "rep", "version", "n"), "alive")
    bodies = bodies_of(texts, alive)
    sketches = sketched(bodies, width)

    heads = lists.groupBy("sig").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot < last").select("sig", "pivot")
    lists = saved(lists.join(heads, "sig").where("node <> pivot"), "headed")
    met = saved(lists.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), "met")
    links = saved(verified(saved(may_be_similar(met, sketches, scheme), "pairs"), bodies, width, scheme), "links")
    labels = components(links, "a", "b")
    label = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
    apart = met.join(label("a"), "a", "left").join(label("b"), "b", "left").where("coalesce(label_a, a) <> coalesce(label_b, b)")
    apart = saved(apart.select(F.col("a").alias("pivot"), F.col("b").alias("node")), "apart")
    apart = F.broadcast(apart) if apart.count() <= BROADCAST_IDS else apart
    unfinished = lists.join(apart, ["pivot", "node"], "left_semi").select("sig").distinct()
    lists = saved(lists.join(unfinished, "sig", "left_semi").select("sig", "node"), "rest")
    for pivots in (FEW_PIVOTS, None):
        named = lists.join(labels, "node", "left").select("sig", "node", F.coalesce("label", "node").alias("label"))
        mixed = named.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("sig")
        counted = named.join(mixed, "sig", "left_semi").withColumn("k", F.count(F.lit(1)).over(Window.partitionBy("sig", "label")))
        rank = F.row_number().over(Window.partitionBy("sig").orderBy("k", "node"))
        ranked = saved(counted.select("sig", "node", "label", rank.alias("rank")), "ranked")
        if ranked.isEmpty():
            break
        pairs = saved(crossing(ranked, sketches, scheme, pivots), "pairs")
        if not pairs.isEmpty():
            links = links.union(saved(verified(pairs, bodies, width, scheme), "links"))
            labels = components(links, "a", "b")
        lists = ranked.select("sig", "node")

    members = nodes.select("digest", "node", "rep", "copies").join(labels, "node", "left")
    best = members.where("label IS NOT NULL").groupBy("label").agg(F.min("rep").alias("best"))
    named = members.join(best, "label", "left").where("copies > 1 OR label IS NOT NULL")
    named = saved(named.select("digest", "copies", F.when(F.col("label").isNull(), F.col("rep")).otherwise(F.col("best")).alias("component")), "named")
    whole = sets.select("id", "n", "digest").join(named, "digest", "left")
    alone = F.col("copies").isNull()
    return whole.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
        F.when(alone, F.col("id")).otherwise(F.col("component")).alias("component_id"),
    )
