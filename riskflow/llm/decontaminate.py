"""Benchmark decontamination with a distributed positional inverted index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import ascii_lower, saved, text_of

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 200_000  # rows of the benchmark's terms or anchors (some 32 bytes each) up to which they are broadcast


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased. Where all characters are ASCII the plain function does the same, faster."""
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(ascii_lower(text))
    return F.array_remove(F.split(low, SEPARATORS), "")


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if a count shows that it is small; else Spark joins it by a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One written row per benchmark row that has words: ``item`` (a key of its own), ``item_id`` as text, ``words``."""
    parts = benchmark.select(F.col(id_col).cast("string").alias("item_id"), words(text_of(text_col)).alias("words"))
    whole = parts.where(F.size("words") > 0).where("item_id IS NOT NULL").distinct()
    return saved(whole.select(F.monotonically_increasing_id().alias("item"), "item_id", "words"), "items")


def item_terms(items: DataFrame) -> DataFrame:
    """(item, size, ipos, term): the terms of an item by position; a term is the 64-bit hash of its word."""
    parts = items.select("item", F.size("words").alias("size"), F.posexplode("words").alias("ipos", "word"))
    return parts.select("item", "size", "ipos", F.xxhash64("word").alias("term"))


def postings(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index: (doc, pos, term) of every occurrence, in whole texts, of a term that the test set has. Written once."""
    tokens = docs.select(F.col(id_col).alias("doc"), F.posexplode(words(text_of(text_col))).alias("pos", "word"))
    hashed = tokens.select("doc", "pos", F.xxhash64("word").alias("term"))
    return saved(hashed.join(small(terms.select("term").distinct()), "term", "left_semi").select("doc", "pos", "term"), "postings")


def anchors(terms: DataFrame, index: DataFrame, window: int, count: int) -> DataFrame:
    """(item, need, ipos, term): for each window of an item the positions of its ``count`` rarest terms in the index."""
    frequency = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    rated = terms.join(frequency, "term", "left").select("item", "size", "ipos", "term", F.coalesce("n", F.lit(0)).alias("n"))
    last = F.greatest(F.col("size") - window, F.lit(0))
    starts = F.sequence(F.greatest(F.col("ipos") - (window - 1), F.lit(0)), F.least(F.col("ipos"), last))
    placed = rated.withColumn("start", F.explode(starts))
    rank = F.row_number().over(Window.partitionBy("item", "start").orderBy("n", "ipos"))
    chosen = placed.withColumn("rank", rank).where(F.col("rank") <= count)
    return chosen.select("item", F.least("size", F.lit(window), F.lit(count)).alias("need"), "ipos", "term").distinct()


def candidates(index: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc, item, diagonal): the lists of an item's anchors, each shifted by its place in the item, meet at a diagonal
    (word of the document minus word of the item). A window that occurs has all its anchors on one diagonal."""
    met = index.join(chosen, "term").select("doc", "item", "need", (F.col("pos") - F.col("ipos")).alias("diagonal"))
    counted = met.groupBy("doc", "item", "diagonal", "need").agg(F.count(F.lit(1)).alias("n"))
    return counted.where("n >= need").select("doc", "item", "diagonal")


def phrase_hits(docs: DataFrame, found: DataFrame, items: DataFrame, window: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, version, n_words, item_id, from, to): every input row, with the runs of words it has in common with an item
    along a candidate diagonal, if they hold a whole window. ``version`` is a hash of the text."""
    listed = (
        found.join(items.select("item", F.size("words").alias("size")), "item")
        .groupBy("doc")
        .agg(F.collect_list(F.struct("item", "diagonal", "size")).alias("cands"))
        .withColumnRenamed("doc", "__cand")
    )
    texts = docs.select(F.col(id_col).alias("doc"), text_of(text_col).alias("__text"))
    split = texts.select("doc", F.xxhash64("__text").alias("version"), words(F.col("__text")).alias("words"))
    cut = F.transform(
        "cands",
        lambda c: F.struct(
            c["item"].alias("item"),
            c["diagonal"].alias("diagonal"),
            F.slice("words", F.greatest(c["diagonal"], F.lit(0)) + 1, c["size"] + F.least(c["diagonal"], F.lit(0))).alias("part"),
        ),
    )
    joined = split.join(listed, F.col("doc").eqNullSafe(F.col("__cand")), "left")
    parts = joined.select("doc", "version", F.size("words").alias("n_words"), F.explode_outer(cut).alias("c")).select("doc", "version", "n_words", "c.*")
    own = items.select("item", "item_id", F.col("words").alias("theirs"))
    pairs = parts.join(own, "item", "left")
    same = F.zip_with("part", F.slice("theirs", F.greatest(-F.col("diagonal"), F.lit(0)) + 1, F.size("part")), lambda a, b: a == b)
    bits = F.array_join(F.transform(same, lambda x: F.when(x, "1").otherwise("0")), "")
    need = F.least(F.size("theirs"), F.lit(window))
    marked = pairs.withColumn("bits", bits).withColumn("need", need)
    at = F.sequence(F.lit(1), F.length("bits") - F.col("need") + 1)
    starts = F.when(F.length("bits") >= F.col("need"), F.filter(at, lambda i: F.substr(F.col("bits"), i, F.col("need")) == F.repeat(F.lit("1"), F.col("need"))))
    runs = F.arrays_zip(
        F.filter("starts", lambda i: ~F.array_contains("starts", i - 1)).alias("a"),
        F.filter("starts", lambda i: ~F.array_contains("starts", i + 1)).alias("b"),
    )
    spans = marked.withColumn("starts", starts).select("doc", "version", "n_words", "item_id", "diagonal", "need", F.explode_outer(runs).alias("run"))
    first = F.greatest(F.col("diagonal"), F.lit(0)) + F.col("run.a") - 1
    return spans.select(
        "doc", "version", "n_words", F.when(F.col("run").isNotNull(), F.col("item_id")).alias("item_id"),
        first.alias("from"), (first + F.col("run.b") - F.col("run.a") + F.col("need")).alias("to"),
    )


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
    rarest: int = 3,
) -> DataFrame:
    """Per row: id, ``n_words``, ``n_hit`` (words inside an occurring window), ``item_ids`` (sorted texts), ``spans``
    (item, first word, end word), ``version`` (a hash of the text, which tells rows that repeat an id apart).

    Postings of the test set's terms are stored in one pass over the texts. For each window the lists of its rarest terms
    are intersected, shifted by their offsets; what remains is compared word by word. A term that stands everywhere is
    read only for windows that have nothing rarer.

    Null and empty texts have no words. Items without words or id are ignored; items that repeat an id count as one. Rows
    that repeat an id each have their result; a null id is an id like others. An empty benchmark hits nothing. Extra columns
    are ignored.
    """
    items = benchmark_items(benchmark, item_col, item_text_col)
    terms = item_terms(items)
    index = postings(docs, terms, id_col, text_col)
    chosen = small(saved(anchors(terms, index, window, rarest), "anchors"))
    spans = phrase_hits(docs, candidates(index, chosen), items, window, id_col, text_col).distinct()
    order = Window.partitionBy("doc", "version").orderBy("from", "to")
    reach = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("to") - F.greatest("from", F.coalesce(reach, F.col("from"))))
    each = (
        spans.withColumn("fresh", fresh)
        .groupBy("doc", "version")
        .agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.coalesce(F.sum("fresh"), F.lit(0)).cast("long").alias("n_hit"),
            F.array_sort(F.collect_set("item_id")).alias("item_ids"),
            F.collect_list(F.when(F.col("item_id").isNotNull(), F.struct("item_id", "from", "to"))).alias("spans"),
        )
    )
    rows = docs.select(F.col(id_col).alias("__doc"), F.xxhash64(text_of(text_col)).alias("__version"))
    again = saved(rows.groupBy("__doc", "__version").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "repeated")
    same = F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("version") == F.col("__version"))
    whole = each.join(small(again), same, "left").withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("times", F.lit(1).cast("long")))))
    return whole.select(F.col("doc").alias(id_col), "n_words", "n_hit", "item_ids", "spans", "version")


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> Column:
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def near_matches(index: DataFrame, terms: DataFrame, *, slop: int = 8, share: float = 0.8) -> DataFrame:
    """Proximity matches: (doc, item, first, matched), where ``share`` of an item's positions have their term in the document
    on diagonals that differ by less than ``slop``. Diagonals fall into two sets of bands, shifted by half a band, so that
    words inserted or left out within an item do not hide it."""
    met = index.join(terms, "term").select("doc", "item", "size", "ipos", "pos", (F.col("pos") - F.col("ipos")).alias("d"))
    bands = F.array(F.floor(F.col("d") / (2 * slop)), F.floor((F.col("d") + slop) / (2 * slop)))
    banded = met.select("doc", "item", "size", "ipos", "pos", F.posexplode(bands).alias("shift", "band"))
    once = banded.groupBy("doc", "item", "size", "shift", "band", "ipos").agg(F.min("pos").alias("pos"))
    counted = once.groupBy("doc", "item", "size", "shift", "band").agg(F.count(F.lit(1)).alias("matched"), F.min("pos").alias("first"))
    return counted.where(F.col("matched") >= F.ceil(F.col("size") * share)).groupBy("doc", "item").agg(F.min("first").alias("first"), F.max("matched").alias("matched"))
