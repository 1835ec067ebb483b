"""Main text of web pages: templates from equivalence classes of tokens across the pages of a host."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import saved

# Elements whose text is never read, elements and names of boilerplate, words that say nothing in a name, elements that begin
# a new block.
UNREAD = frozenset("head iframe noscript script select style svg template textarea title".split())
BOILERPLATE = frozenset("aside button dialog footer form header menu nav".split())
NAMES = frozenset(
    "ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer gdpr header menu nav navbar navigation newsletter notice notices popup promo promoted replies reply "
    "responses share sharing sidebar social sponsor sponsored subscribe toolbar widget widgets".split()
)
HOLDERS = frozenset(
    "area bar block bottom box buttons col column container content form group icons inner item items left link links list main overlay "
    "panel primary right row secondary section signup slot thread top unit wrap wrapper".split()
)
ABOUT = frozenset("has no with without".split())  # a name like has-sidebar tells of what an element holds, not what it is
WHOLE = frozenset("article body main".split())
CONTAINERS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul button".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSED_BY = {
    "p": CONTAINERS - {"td", "th"},
    "li": frozenset({"li"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}),
    "td": frozenset({"td", "th", "tr"}),
    "th": frozenset({"td", "th", "tr"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
} | {f"h{k}": frozenset(f"h{i}" for i in range(1, 7)) for k in range(1, 7)}

BROADCAST_TOKENS = 1_000_000  # template tokens (8 bytes each) in all pages of a table up to which they are broadcast
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style|itemprop)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?(?=[\s/>]|$)""", re.I)


def _boilerplate(name: str, inside: bool) -> bool:
    """Whether the word that a name ends in, words for holders aside, is one of ``NAMES``: social-links and cookie-notice are,
    social-history and notice-of-poll are not. The header of an article (``inside``) holds its headline."""
    words = [w for w in re.split(r"[^a-z]+", name) if w]
    if not words or words[0] in ABOUT:
        return False
    while len(words) > 1 and words[-1] in HOLDERS:
        words.pop()
    return words[-1] in NAMES and not (inside and words[-1] == "header")


def _marks(name: str, attributes: str, inside: bool) -> tuple[str, bool, bool]:
    """How an element stands in a path, and whether it is boilerplate or an article. ``inside``: within an article."""
    label, dropped, article = name, name in BOILERPLATE and not (inside and name == "header"), name in ("article", "main")
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), next((v for v in values if v), "").lower()
        if key in ("class", "id"):
            label += f".{value}"
            dropped |= name not in WHOLE and any(_boilerplate(c, inside) for c in value.split())
        elif key == "role":
            dropped |= value in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog")
            article |= value in ("main", "article")
        elif key == "itemprop":
            article |= value == "articlebody"
        else:
            dropped |= key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value) is not None)
    return label, dropped and not (article and name in ("article", "main")), article


@dataclass(frozen=True)
class Block:
    """The text between two block-level tags. ``path``: hash of the labels of its elements; ``place``: the same with the number of
    each among its like, and of the text in the element. ``link``: only links, in a list or next to other such blocks."""

    path: int
    place: int
    dropped: bool
    article: bool
    link: bool
    text: str

    @property
    def token(self) -> int:
        return xxhash.xxh3_64_intdigest(f"{self.path}\n{self.text}") >> 1


class _Element:
    """An open element: hashes of its path and place, and how often each kind of child has come."""

    __slots__ = ("name", "path", "place", "dropped", "article", "listed", "children")

    def __init__(self, name: str, label: str, above: _Element | None, dropped: bool, article: bool):
        self.name, self.children = name, {}
        if above is None:
            self.path = self.place = 0
            self.dropped = self.article = self.listed = False
            return
        number = above.children[label] = above.children.get(label, 0) + 1
        self.path = xxhash.xxh3_64_intdigest(f"{above.path}/{label}")
        self.place = xxhash.xxh3_64_intdigest(f"{above.place}/{label}/{number}")
        self.dropped, self.article, self.listed = above.dropped or dropped, above.article or article, above.listed or name in ("li", "dd", "dt")


def blocks(page: str) -> list[Block]:
    """Each block with text, in page order. Tags need not be closed or nested."""
    out: list[Block] = []
    links: list[bool] = []
    stack = [_Element("", "", None, False, False)]
    parts: list[str] = []
    plain, link, at, end = False, 0, 0, len(page)

    def flush() -> None:
        nonlocal parts, plain
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            here = stack[-1]
            number = here.children[""] = here.children.get("", 0) + 1
            out.append(Block(here.path >> 1, xxhash.xxh3_64_intdigest(f"{here.place}/{number}") >> 1, here.dropped, here.article, not plain and here.listed, text))
            links.append(not plain)
        parts, plain = [], False

    while at < end:
        found = TOKEN.search(page, at)
        text = page[at : found.start() if found else end]
        if text:
            parts.append(text)
            plain |= not link and not text.isspace()
        if not found:
            break
        at = max(found.end(), found.start() + 1)
        name = (found[2] or "").lower()
        if not name:
            continue
        closing = found[1] == "/"
        if name in UNREAD and not closing:
            if not found[0].endswith("/>"):
                stop = re.compile(rf"</{re.escape(name)}(?=[\s/>]|$)[^>]*>?" + (r"|<body(?=[\s>])" if name == "head" else ""), re.I).search(page, at)
                at = (stop.start() if stop and stop[0][1] != "/" else stop.end()) if stop else (at if name == "head" else end)
        elif name == "a":
            link = 0 if closing else 1
        elif name == "br":
            parts.append(" ")
        elif name in CONTAINERS or (name in ("td", "th")):
            if name in ("td", "th"):
                parts.append(" ")
                continue
            flush()
            link = 0
            if closing:
                if any(e.name == name for e in stack):
                    while stack.pop().name != name:
                        pass
            elif name not in VOID:
                while len(stack) > 1 and name in CLOSED_BY.get(stack[-1].name, ()):
                    stack.pop()
                label, dropped, article = _marks(name, found[3], stack[-1].article)
                stack.append(_Element(name, label, stack[-1], dropped, article))
    flush()
    beside = lambda i: 0 < i and links[i - 1] or i + 1 < len(links) and links[i + 1]
    return [replace(b, link=b.link or links[i] and beside(i)) for i, b in enumerate(out)]


SHAPE = "array<struct<token:long,place:long,article:boolean,link:boolean,text:string>>"


def parsed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """One written row per page: ``id``, ``url``, ``host``, ``digest`` and ``blocks`` (those outside boilerplate elements)."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), host.alias("host"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    kind = pa.list_(pa.struct([("token", pa.int64()), ("place", pa.int64()), ("article", pa.bool_()), ("link", pa.bool_()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 500):
                batch, lists, digests = whole.slice(i, 500), [], []
                for page in batch.column(3):
                    found = [b for b in blocks(page.as_py()) if not b.dropped]
                    tokens = [b.token for b in found]
                    lists.append([{"token": t, "place": b.place, "article": b.article, "link": b.link, "text": b.text} for t, b in zip(tokens, found)])
                    digests.append(xxhash.xxh3_64_intdigest("\n".join(map(str, tokens))) >> 1)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(digests, pa.int64()), pa.array(lists, kind)], names=["id", "url", "host", "digest", "blocks"])

    key = rows.schema["id"].dataType.simpleString()
    return saved(rows.mapInArrow(run, f"id {key}, url string, host string, digest long, blocks {SHAPE}"), "pages")


def classes(pages: DataFrame, min_pages: int) -> tuple[DataFrame, DataFrame]:
    """((host, token, class, parent, pages, of), (host, digest, token, class, place, article)): the valid equivalence classes of a host's tokens, and
    where their tokens stand.

    A token is a block's text in its path; each distinct page of a host counts once. Its occurrence vector over these pages
    is summarised by the number of pages and a sum of hashes of (page, count), which can be added up in any order, so a
    host with a third of all pages is counted like any other. Tokens with one vector are a class. A class is valid if it is
    on ``min_pages`` pages and its tokens come in one order on all of them. It nests in the class whose tokens enclose its own most
    closely, if that is the same one on all of its pages; ``of`` is the number of that one's pages, else of all of the host's.
    """
    slim = F.transform("blocks", lambda b: F.struct(b["token"].alias("token"), b["place"].alias("place"), b["article"].alias("article")))
    whole = pages.select("host", "digest", slim.alias("blocks")).dropDuplicates(["host", "digest"])
    spots = whole.select("host", "digest", F.posexplode("blocks").alias("at", "b"))
    counts = spots.groupBy("host", "digest", F.col("b.token").alias("token")).agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("first"), F.max("at").alias("last"), F.collect_list(F.struct(F.col("b.place").alias("place"), F.col("b.article").alias("article"))).alias("places")
    )
    # Counted before they are written: a token of few pages, nearly every one, goes no further.
    vector = F.sum((F.xxhash64("digest", "n") / 2**24).cast("long"))
    seen = counts.groupBy("host", "token").agg(F.count(F.lit(1)).alias("pages"), vector.alias("vector")).where(F.col("pages") >= min_pages)
    often = saved(seen.select("host", "token", F.xxhash64("pages", "vector").alias("class"), "pages"), "tokens")
    held = often.count()
    members = saved(counts.drop("n").join(F.broadcast(often) if held <= BROADCAST_TOKENS else often, ["host", "token"]), "members")

    spans = members.groupBy("host", "digest", "class").agg(
        F.xxhash64(F.transform(F.array_sort(F.collect_list(F.struct("first", "token"))), lambda x: x["token"])).alias("order"), F.min("first").alias("lo"), F.max("last").alias("hi")
    )
    valid = spans.groupBy("host", "class").agg((F.min("order") == F.max("order")).alias("valid")).where("valid").drop("valid")
    on_page = spans.join(valid, ["host", "class"]).groupBy("host", "digest").agg(F.collect_list(F.struct((F.col("hi") - F.col("lo")).alias("span"), "class", "lo", "hi")).alias("held"))
    inner = lambda c: F.array_min(F.filter("held", lambda p: (p["lo"] < c["lo"]) & (p["hi"] > c["hi"])))["class"]
    above = on_page.select("host", "digest", F.explode(F.transform("held", lambda c: F.struct(c["class"].alias("class"), inner(c).alias("parent")))).alias("x"))
    one = F.when((F.min("x.parent") == F.max("x.parent")) & (F.count("x.parent") == F.count(F.lit(1))), F.min("x.parent"))
    nested = above.groupBy("host", F.col("x.class").alias("class")).agg(one.alias("parent"))
    sizes = pages.groupBy("host").agg(F.count_distinct("digest").alias("all"))
    count_of = often.groupBy("host", F.col("class").alias("parent")).agg(F.max("pages").alias("parent_pages"))
    tree = nested.join(count_of, ["host", "parent"], "left").join(sizes, "host")
    tree = tree.select("host", "class", "parent", F.coalesce("parent_pages", "all").alias("of"))
    found = often.join(tree, ["host", "class"]).select("host", "token", "class", "parent", "pages", "of")
    return found, members.join(valid, ["host", "class"]).select("host", "digest", "token", "class", F.explode("places").alias("x")).select("host", "digest", "token", "class", "x.*")


def templates(pages: DataFrame, min_pages: int, share: float) -> DataFrame:
    """(host, place, token): the text that a host's template has, ``place`` null where it has it at any place.

    A valid class is template if it is on ``share`` of the pages of the class it nests in. Page types that differ in a menu
    give classes on a part of the pages only; they are template at the places where such classes make up ``share`` of all that
    stands there. In articles text that repeats is template only where most of what the host's articles hold does not
    repeat: one article under many addresses is no template.
    """
    found, spots = classes(pages, min_pages)
    found, spots = saved(found, "classes"), saved(spots, "class_places")
    general = found.where(F.col("pages") >= share * F.col("of")).select("host", "token", F.lit(None).cast("long").alias("place"))
    # Only places that hold a token of a class are counted; what is template anyway is no variant there.
    variants = spots.join(general.select("host", "token"), ["host", "token"], "left_anti")
    asked = variants.select("host", "place").distinct()
    size = asked.count()
    whole = pages.select("host", "digest", F.explode("blocks").alias("b")).select("host", "digest", F.col("b.place").alias("place"), F.col("b.article").alias("article"))
    there = whole.join(F.broadcast(asked) if size <= BROADCAST_TOKENS else asked, ["host", "place"], "left_semi").groupBy("host", "place").agg(F.count_distinct("digest").alias("all"))
    covered = variants.groupBy("host", "place").agg(F.count_distinct("digest").alias("n")).join(there, ["host", "place"]).where(F.col("n") >= share * F.col("all"))
    varied = variants.select("host", "place", "token").distinct().join(covered.select("host", "place"), ["host", "place"]).select("host", "token", "place")
    both = saved(general.union(varied).distinct(), "template")
    inside = spots.where("article").select("host", "digest", "token", "place")
    wide, narrow = both.where("place IS NULL").drop("place"), both.where("place IS NOT NULL")
    repeated = inside.join(wide, ["host", "token"], "left_semi").union(inside.join(narrow, ["host", "token", "place"], "left_semi")).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    articles = pages.where(F.exists("blocks", lambda b: b["article"])).select("host", "digest", F.size(F.filter("blocks", lambda b: b["article"])).alias("k")).dropDuplicates(["host", "digest"])
    kept = repeated.join(articles.groupBy("host").agg(F.sum("k").alias("k")), "host").where("2 * n > k").select("host", F.lit(True).alias("same_articles"))
    return both.join(kept, "host", "left").withColumn("same_articles", F.coalesce("same_articles", F.lit(False)))


def main_text(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_pages: int = 5,
    share: float = 0.9,
) -> DataFrame:
    """Per page: id, url, ``text`` (blocks of the main text, one a line), ``template_blocks`` (blocks left out as template).

    A block is the text between two block-level tags. Slots are what the host's template (see ``templates``) leaves over; text
    within boilerplate elements, or elements named like it, is never a slot. If a page has an article, its slots are taken,
    else all slots but lists of links. A page whose every taken block is template keeps them.

    Null and empty pages have an empty text, a page without tags is its own text. Pages without host are one host. Rows
    that repeat an id each have their result. Extra columns are ignored.
    """
    rows = parsed(pages, id_col, url_col, html_col)
    found = saved(templates(rows, min_pages, share), "templates")
    each = rows.select("host", "digest", F.explode("blocks").alias("b")).select("host", "digest", F.col("b.token").alias("token"), F.col("b.place").alias("place"), F.col("b.article").alias("article")).distinct()
    size = found.count()
    known = F.broadcast(found) if size <= BROADCAST_TOKENS else found
    known = known.withColumnRenamed("place", "only")
    here = each.join(known, ["host", "token"]).where("(only IS NULL OR only = place) AND NOT (article AND same_articles)")
    hits = saved(here.groupBy("host", "digest").agg(F.collect_set(F.struct("token", "place")).alias("template")), "template_hits")
    held = hits.agg(F.sum(2 * F.size("template") + 4)).first()[0] or 0
    hits = F.broadcast(hits) if held <= BROADCAST_TOKENS else hits
    inside = F.filter("blocks", lambda b: b["article"])
    taken = F.when(F.size("inside") > 0, F.col("inside")).otherwise(F.filter("blocks", lambda b: ~b["link"]))
    left = F.filter("taken", lambda b: ~F.array_contains("template", F.struct(b["token"].alias("token"), b["place"].alias("place"))))
    chosen = (
        rows.join(hits, ["host", "digest"], "left")
        .withColumn("inside", inside)
        .withColumn("taken", taken)
        .withColumn("left", F.when(F.col("template").isNull(), F.col("taken")).otherwise(left))
        .withColumn("kept", F.when(F.size("left") > 0, F.col("left")).otherwise(F.col("taken")))
    )
    return chosen.select(
        F.col("id").alias(id_col),
        F.col("url").alias(url_col),
        F.array_join("kept.text", "\n").alias("text"),
        (F.size("taken") - F.size("kept")).alias("template_blocks"),
    )
