"""Personal data by bootstrapped contextual extraction: seeds, patterns around them, a scored graph of both, new finds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import saved, text_of

# Fixed patterns of the seeds, in the order of kinds. Possessive loops and look-behinds change no match; they keep the
# time linear and the stack flat on very long runs of digits or word characters.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "slot": r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+",  # a word with a digit or an at sign: what a pattern may find
}
EDGE = r"[!\"'(),.:;<>?\[\]{}`\u00AB\u00BB\u2018-\u201F\u2026]"  # punctuation around a word, which is not part of a slot
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(OCTETS)
    if kind == "card":
        return F.length(_digits(hit)).between(14, 19) & luhn(_digits(hit))
    if kind == "phone":
        return F.length(_digits(hit)).between(10, 15)
    return F.lit(True)


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, kind, start, end, value, left2, left1, right1), written once: each valid seed of the whole texts and each slot
    that overlaps none, with the words around it; a row without any has one record without kind. Positions are code points, the end exclusive.

    A pattern splits a text into matches and what lies between them; starts are running sums of these lengths, so
    nothing but lengths, hashes and up to three words a match leaves the task that reads the text. Punctuation at the edges of
    a slot is text around it, as it is with seeds.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    with_digit, with_at = F.col("text").rlike("[0-9]"), F.contains("text", F.lit("@"))
    needed = {"email": with_at, "slot": with_digit | with_at}
    found = rows.select(
        "*", *[F.when(needed.get(k, with_digit), F.regexp_extract_all("text", F.lit(p), F.lit(0))).alias(f"hits_{k}") for k, p in PATTERNS.items()]
    )

    def parts(kind: str) -> Column:
        hits = F.col(f"hits_{kind}")
        word = lambda text, pattern: F.lower(F.regexp_extract(text, pattern, 1))

        def part(piece: Column, hit: Column) -> Column:
            slot = kind == "slot"
            head = F.coalesce(F.regexp_extract(hit, f"^{EDGE}+", 0), F.lit("")) if slot else F.lit("")
            tail = F.coalesce(F.regexp_extract(hit, f"(?<!{EDGE}){EDGE}+$", 0), F.lit("")) if slot else F.lit("")
            core = F.substr(hit, F.length(head) + 1, F.length(hit) - F.length(head) - F.length(tail)) if slot else hit
            before, after = F.right(F.concat(piece, head) if slot else piece, F.lit(90)), F.left(piece, F.lit(45))
            return F.struct(
                F.lit(kind).alias("kind"),
                (F.length(piece) + F.length(head)).cast("long").alias("gap"),
                F.length(core).cast("long").alias("size"),
                F.length(tail).cast("long").alias("rest"),
                F.xxhash64(core).alias("value"),
                (hit.isNotNull() & valid(kind, hit)).alias("valid"),
                word(before, r"(?<!\S)(\S{1,40}\s+\S{1,40})\s*$").alias("left2"),
                word(before, r"(?<!\S)(\S{1,40})\s*$").alias("left1"),
                word(after, r"^\s*(\S{1,40})(?!\S)").alias("right1"),
                F.when(F.length(tail) > 40, "").otherwise(tail).alias("tail"),
            )

        return F.when(F.exists(hits, lambda h: valid(kind, h)), F.zip_with(F.split("text", PATTERNS[kind], -1), hits, part))

    listed = found.select("row", "id", F.array_compact(F.array(*[parts(k) for k in PATTERNS])).alias("kinds"))
    by_kind = listed.select("row", "id", F.explode_outer("kinds").alias("list"))
    pieces = by_kind.select("row", "id", F.posexplode_outer("list").alias("k", "part")).select("row", "id", "k", "part.*").repartition("row")
    order = Window.partitionBy("row", "kind").orderBy("k")
    passed = F.sum(F.col("gap") + F.coalesce("size", F.lit(0)) + F.col("rest")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = pieces.withColumn("start", F.coalesce(passed, F.lit(0)) + F.col("gap")).withColumn("right1", F.when(F.col("rest") > 0, F.col("tail")).otherwise(F.lead("right1").over(order)))
    kept = placed.where("kind IS NULL OR valid").withColumn("end", F.col("start") + F.col("size"))
    seed, upto = F.col("kind") != "slot", (Window.unboundedPreceding, 0)
    ended = F.max(F.when(seed, F.col("end"))).over(Window.partitionBy("row").orderBy("start").rangeBetween(*upto))
    begun = F.min(F.when(seed, F.col("start"))).over(Window.partitionBy("row").orderBy(F.desc("start")).rangeBetween(*upto))
    overlaps = ~seed & ((F.coalesce("ended", F.lit(0)) > F.col("start")) | (F.coalesce("begun", F.col("end")) < F.col("end")))
    apart = kept.withColumn("ended", ended).withColumn("begun", begun).where(F.col("kind").isNull() | ~overlaps)
    return saved(apart.select("row", "id", "kind", "start", "end", "value", "left2", "left1", "right1"), "personal")


def patterns_of(found: DataFrame) -> DataFrame:
    """(pattern, kind, value, row, start, end): the words before, and the words on both sides, of each seed and slot."""
    shape = lambda c: F.regexp_replace(F.col(c), "[0-9]", "0")
    before = F.when(F.col("left2") != "", F.concat(shape("left2"), F.lit(" _")))
    around = F.when((F.col("left1") != "") & (F.col("right1") != ""), F.concat(shape("left1"), F.lit(" _ "), shape("right1")))
    named = found.where("kind IS NOT NULL").withColumn("pattern", F.explode(F.array_compact(F.array(before, around))))
    return named.select("pattern", "kind", "value", "row", "start", "end")


def bootstrap(edges: DataFrame, *, rounds: int, min_seeds: int, min_score: float) -> DataFrame:
    """(pattern, kind, score): patterns that the seeds, and what they lead to, make trustworthy.

    The graph joins patterns to the distinct values they surround. In each round a pattern's score for a kind is the mean
    belief in its values, shrunk for few values; a value's belief is that at least one of its trusted patterns is right.
    Seeds are believed from the start. Both sums start inside each partition, so a frequent pattern is no burden.
    """
    graph = saved(edges.groupBy("pattern", "value").agg(F.min(F.when(F.col("kind") != "slot", F.col("kind"))).alias("seed")), "graph")
    seeds = graph.where("seed IS NOT NULL").groupBy("value", F.col("seed").alias("kind")).agg(F.lit(1.0).alias("belief"))
    beliefs, sizes = saved(seeds, "beliefs"), graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("values"))
    links = graph.select("pattern", "value")
    for left in range(rounds, 0, -1):
        weighed = links.join(beliefs, "value").groupBy("pattern", "kind").agg(F.sum("belief").alias("mass"), F.count(F.lit(1)).alias("known"))
        score = F.col("mass") / (F.col("values") + 1)
        trusted = weighed.join(sizes, "pattern").where(F.col("known") >= min_seeds).select("pattern", "kind", score.alias("score")).where(F.col("score") >= min_score)
        trusted = saved(trusted, "trusted")
        if left > 1:
            doubt = F.sum(F.log1p(-F.least(F.col("score"), F.lit(0.999))))
            led = links.join(trusted, "pattern").groupBy("value", "kind").agg((1 - F.exp(doubt)).alias("belief"))
            beliefs = saved(seeds.union(led).groupBy("value", "kind").agg(F.max("belief").alias("belief")), "beliefs")
    return trusted


def personal_data(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 3,
    min_seeds: int = 5,
    min_score: float = 0.75,
) -> DataFrame:
    """One row per input row: id, ``base`` and ``spans``: arrays of (start, rank, end, kind), sorted.

    ``base`` holds the seeds: what the fixed patterns match, leftmost and without overlap per kind, and passes the checks.
    ``spans`` adds words with a digit or an at sign, without punctuation at their edges and outside of all seeds, that stand in a trusted pattern; they get its
    kind, of several the one with the best score. Null and empty texts have none. Rows that repeat an id each have their
    own result; a null id is kept. An empty table gives no rows. Extra columns are ignored.
    """
    found = occurrences(docs, id_col, text_col)
    edges = patterns_of(found)
    trusted = bootstrap(edges, rounds=rounds, min_seeds=min_seeds, min_score=min_score)
    best = F.max(F.struct("score", "kind")).alias("best")
    new = edges.where("kind = 'slot'").drop("kind").join(trusted, "pattern").groupBy("row", "start", "end").agg(best)
    added = new.select("row", F.lit(None).cast(found.schema["id"].dataType).alias("id"), F.col("best.kind").alias("kind"), "start", "end", F.lit(True).alias("new"))
    own = found.where("kind IS NULL OR kind <> 'slot'").select("row", "id", "kind", "start", "end", F.lit(False).alias("new"))
    rest = found.where("kind = 'slot'").select("row", "id", F.lit(None).cast("string").alias("kind"), "start", "end", F.lit(False).alias("new"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct("start", rank.alias("rank"), "end", "kind")
    listed = (
        own.union(rest)
        .union(added)
        .groupBy("row")
        .agg(
            F.max("id").alias("id"),
            F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull() & ~F.col("new"), span))).alias("base"),
            F.collect_list(F.when(F.col("new"), span)).alias("new"),
        )
    )
    apart = F.filter("new", lambda x: ~F.exists("base", lambda y: (x["start"] < y["end"]) & (y["start"] < x["end"])))
    return listed.select(F.col("id").alias(id_col), "base", F.array_sort(F.concat("base", apart)).alias("spans"))


def joined(spans: str) -> Column:
    """kind:start:end of each span, with commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def counted(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
