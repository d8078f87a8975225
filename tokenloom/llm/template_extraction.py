"""Main text of web pages by equivalence classes of their tokens.

Pages of a host come from one template.  A token is a container tag or a block
of text, each with the containers it stands in.  Its occurrence vector says how
often it occurs in each page of the host; tokens with the same vector form an
equivalence class, wherever in the page they stand.  A class is valid if it
holds a tag and occurs in at least ``SUPPORT`` pages: text that occurs exactly as
some tag does, page by page, belongs to the template and not to the page.  The
body, which a page need not spell out, is a tag that each page with any content
has once.  The text that no valid class holds fills the slots.

Classes must be nested and ordered.  A token stands in a class: that of the
nearest tag around it which pages have at most once.  Its gap is what lies
between two tags of that class.  A class is nested if each of its tokens keeps to
one gap on all pages; tokens of other gaps are split off, and of what is left
text is template only beside a tag of its own class in the same gap, or as a
member of the class it stands in.  It is ordered if a text follows the same tag of
its class, in the gap, as the same of the texts there; a text that does not, or
one that moves between gaps, belongs to the page.  Classes are not refined by
the gaps once more: roles of equal tokens are told apart by their paths only.

A slot's role follows from the template tags around it: menus, headers,
footers, sidebars, notices, adverts, forms, scripts and reader comments are
left out.  So are lists of links: slots whose words are links to
``LINKS`` of a hundred in the pages of a host.  If a page has an ``article`` or
``main`` element its slots are those inside, and no text in them is taken for
template or for a list of links, however many pages of the host share it; else
they are the body's.  A ``header`` inside an article is part of it.

Classes and ids tell a role only where they can: not on ``html``, ``body``,
``main``, ``article`` or a header in these two, and not by a word that says what
a layout has or lacks (``has-sidebar``).  If names would leave nothing of a
page, those around its article go first, then all; tags and roles still count.

Vectors are never built: a token's is summed up in its number of pages and the
sum of a hash of each page times the token's count in it, which fold in the task
that reads the pages.  What is kept for a host is a hash of each text that valid
classes hold, outside articles, each of which ``SUPPORT`` pages have.

Character references are decoded, white space inside a block becomes one
space, blocks are joined by one newline in page order.  A null or empty page
has no text, a null URL is a host of its own.  If all text of a page is template
(copies of one page make up the host), the page keeps it.  Rows that repeat a
page are extracted alike.  An empty table gives an empty one.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.wordlists import fits_broadcast
from tokenloom.session import settled

SUPPORT = 5
LINKS = 70
SALTS = 64

# Elements of HTML, by what they mean for text.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "xmp", "noembed", "noframes"}
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = set(
    "html head body div section article main nav header footer aside form ul ol dl table menu figure dialog details fieldset select button "
    "blockquote".split()
)
ASIDE = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "select", "button", "fieldset"}
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|banner|promo|sponsor|sponsored|nav|navbar|navigation|menu|breadcrumb|breadcrumbs|"
    r"sidebar|side|widget|footer|header|masthead|cookie|cookies|consent|notice|notices|alert|popup|modal|overlay|newsletter|subscribe|signup|login|"
    r"share|sharing|social|related|recommended|comment|comments|disqus|replies|reply|discussion|pagination|pager|search|toolbar|copyright|legal)"
    r"(?:$|[\s_-])|(?:^|[\s_-])(?:ad|ads)-?\d+(?:$|\s)",
    re.IGNORECASE,
)
# Words that say what a layout has or lacks.
LAYOUT = re.compile(r"(?<![^\s_-])(?:has|have|no|not|with|without)[_-]\S*", re.IGNORECASE)
UNNAMED = {"html", "body", "main", "article"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(?:!|\?)[^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)


@dataclass
class Block:
    """A block of text and the slot it stands in."""

    slot: str
    text: str
    aside: bool  # by tags and roles
    around: bool  # by names of containers around the article, or where there is none
    within: bool  # by names inside the article
    main: bool
    words: int
    linked: int


def _names(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """A container's name in paths, and whether its tag or role, or else its names, tell that it is no main text."""
    label, aside, named = tag, tag in ASIDE, False
    if attributes:
        for key, *values in ATTRIBUTE.findall(attributes):
            value = next((v for v in values if v), "")
            if key.lower() == "role":
                aside |= value.strip().lower() in ROLES
            else:
                named |= bool(NAMES.search(LAYOUT.sub("", value)))
                if key.lower() == "class":
                    label += "." + ".".join(value.split())
    return label, aside, named and tag not in UNNAMED


def parse(page: str, trail: list | None = None) -> tuple[list[Block], Counter]:
    """The blocks of text of a page, in order, and how often each container path occurs; ``trail`` gets both as they come."""
    blocks: list[Block] = []
    paths: Counter = Counter()
    stack: list[tuple[str, str, bool, bool, bool, bool]] = []  # tag, path, aside, around, within, main
    bare = ("", "", False, False, False, False)
    parts: list[str] = []
    links: list[str] = []
    in_link = 0
    at = 0

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                _, path, aside, around, within, main = stack[-1] if stack else bare
                linked = len(html.unescape("".join(links)).split()) if links else 0
                blocks.append(Block(path, text, aside, around, within, main, text.count(" ") + 1, linked))
                if trail is not None:
                    trail.append(blocks[-1])
            parts.clear()
            links.clear()

    def add(piece: str) -> None:
        if piece:
            parts.append(piece)
            if in_link:
                links.append(piece + " ")

    search = TOKEN.search
    while True:
        found = search(page, at)
        if found is None:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        tag = found.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        closing = found.group(1)
        if tag in RAW:
            if not closing:
                flush()
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                in_link = 0 if closing else 1
            continue
        flush()
        in_link = 0
        if tag not in CONTAINERS:
            continue
        if closing:
            if any(tag == open_tag for open_tag, *_ in stack):
                while stack.pop()[0] != tag:
                    pass
        elif tag not in VOID:
            _, path, aside, around, within, main = stack[-1] if stack else bare
            label, apart, named = _names(tag, found.group(3))
            main |= tag in ("article", "main")
            if tag == "header":
                apart |= not main
                named &= not main
            path = f"{path}/{label}"
            stack.append((tag, path, aside or apart, around or named and not main, within or named and main, main))
            paths[path] += 1
            if trail is not None:
                trail.append(path)
    flush()
    return blocks, paths


def slots(blocks: list[Block]) -> list[Block]:
    """The blocks of main text by their roles."""
    body = [b for b in blocks if not b.aside]
    main = [b for b in body if b.main]
    inside = [b for b in main if not b.within]
    named = [b for b in body if not b.around and not b.within]
    return [b for b in inside if not b.around] or inside or main or named or body


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(parts)) - (1 << 63)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and token: pages, sum over pages, and a container's words and linked words; text of articles is left out."""
    mask = (1 << 64) - 1
    found: dict[tuple, list[int]] = {}

    def rows() -> pa.RecordBatch:
        keys, values = list(found), list(found.values())
        arrays = [pa.array([k[i] for k in keys], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.bool_()))]
        arrays += [pa.array([((v[i] + (1 << 63)) & mask) - (1 << 63) for v in values], pa.int64()) for i in range(5)]
        return pa.RecordBatch.from_arrays(arrays, names=["host", "token", "is_text", "pages", "sum", "words", "linked", "times"])

    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            blocks, paths = parse(page or "")
            if not blocks and not paths:
                continue
            of_page = xxhash.xxh3_64_intdigest(page)
            paths[""] = 1
            counts: dict[tuple, list[int]] = {(host, _hash(path), False): [n, 0, 0] for path, n in paths.items()}
            for b in blocks:
                if not b.main:
                    own = counts[host, _hash(b.slot), False]
                    own[1] += b.words
                    own[2] += b.linked
                    counts.setdefault((host, _hash(b.slot, b.text), True), [0, 0, 0])[0] += 1
            for key, (n, words, linked) in counts.items():
                held = found.setdefault(key, [0, 0, 0, 0, 0])
                held[0] += 1
                held[1] = (held[1] + n * of_page) & mask
                held[2] += words
                held[3] += linked
                held[4] += n
            if len(found) > 50_000:
                yield rows()
                found.clear()
    yield rows()


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


class _Host:
    """The tokens of a host's classes, and the classes that paths stand in."""

    def __init__(self, known: list[dict]):
        self.tags = {k["token"]: (k["class"], k["once"]) for k in known if not k["is_text"]}
        self.texts = {k["token"]: (k["class"], k["once"]) for k in known if k["is_text"]}
        self.around: dict[str, int] = {}

    def enclosing(self, path: str) -> int:
        """The class of the nearest tag of a path, itself included, that pages have at most once."""
        if path not in self.around:
            if len(self.around) > 10_000:
                self.around.clear()
            kind, once = self.tags.get(_hash(path), (0, False))
            self.around[path] = kind if once or not path else self.enclosing(path.rpartition("/")[0])
        return self.around[path]


def _gaps(page: str, host: _Host) -> Iterator[tuple[int, bool, int, int | None, bool]]:
    """Token, whether it is text, gap, place in the gap and whether it is of the class it stands in, of a page's tokens of classes."""
    trail: list = [""]
    parse(page, trail)
    last: dict[int, int] = {}
    places: dict[int, list[int]] = {}  # by class: gap, its last tag in it, texts since then
    for one in trail:
        is_text = isinstance(one, Block)
        if is_text and one.main:
            continue
        token = _hash(one.slot, one.text) if is_text else _hash(one)
        kind, once = (host.texts if is_text else host.tags).get(token, (None, False))
        if kind is None:
            continue
        around = host.enclosing(one.slot if is_text else one.rpartition("/")[0])
        gap = _hash(str(around), str(last.get(around, 0)))
        if not is_text:
            places[kind] = [gap, token, 0]
            last[kind] = token
            yield token, False, gap, 0, kind == around
            continue
        place = places.get(kind)
        if place is None or place[0] != gap:
            place = places[kind] = [gap, 0, 0]
        # Before the first tag of a round the round before may be in sight or not.
        yield token, True, gap, _hash(str(place[1]), str(place[2])) if once or place[1] else None, kind == around
        place[2] += 1


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and token the least and largest gap and place, and whether it is of the class it stands in."""
    names = ["host", "token", "is_text", "gap", "gap_to", "place", "place_to", "own"]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    found: dict[tuple, list] = {}
    hosts: dict[str, _Host] = {}

    def rows() -> pa.RecordBatch:
        flat = [(*key, *value) for key, value in found.items()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in flat], kind) for i, kind in enumerate(kinds)], names=names)

    for batch in batches:
        for k, (host, page) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            if host not in hosts:
                if len(hosts) > 100:
                    hosts.clear()
                hosts[host] = _Host(batch.column(2)[k].as_py())
            for token, is_text, gap, place, own in _gaps(page or "", hosts[host]):
                held = found.setdefault((host, token, is_text), [gap, gap, place, place, own])
                held[0], held[1], held[4] = min(held[0], gap), max(held[1], gap), held[4] and own
                if place is not None:
                    held[2] = place if held[2] is None else min(held[2], place)
                    held[3] = place if held[3] is None else max(held[3], place)
            if len(found) > 50_000:
                yield rows()
                found.clear()
    yield rows()


def _by_host(rows: DataFrame, side: DataFrame, how: str) -> DataFrame:
    """``rows`` with ``page_id``, ``url`` and ``__host`` joined with ``side``, one row per host.

    The side is broadcast if measured to be small; else rows are dealt out over
    copies of it, so no host meets in one task.
    """
    side = settled(side).withColumnRenamed("host", "__host")
    if fits_broadcast(side.select("__host", *[F.to_json(c).alias(c) for c in side.columns if c != "__host"])):
        return rows.join(F.broadcast(side), "__host", how)
    dealt = side.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("__salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(dealt, ["__host", "__salt"], how)


def nested_and_ordered(pages: DataFrame, tags: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the ``host, token`` of ``texts``, tokens of classes, that classes still hold when they are nested and ordered."""
    kind = F.xxhash64("pages", "sum").alias("class")
    known = tags.select("host", "token", kind, (F.col("times") == F.col("pages")).alias("once"), F.lit(False).alias("is_text")).unionByName(
        texts.select("host", "token", kind, (F.col("times") == F.col("pages")).alias("once"), F.lit(True).alias("is_text"))
    )
    side = known.groupBy("host").agg(F.collect_list(F.struct("token", "class", "once", "is_text")).alias("known"), F.max("is_text").alias("any")).where("any").drop("any")
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("__host"))
    places = (
        _by_host(rows, side, "inner").select("__host", "html", "known")
        .mapInArrow(_places, "host string, token long, is_text boolean, gap long, gap_to long, place long, place_to long, own boolean")
        .groupBy("host", "token", "is_text")
        .agg(F.min("gap").alias("gap"), F.max("gap_to").alias("gap_to"), F.min("place").alias("place"), F.max("place_to").alias("place_to"), F.min("own").alias("own"))
        .where("gap = gap_to AND (place IS NULL OR place = place_to)")
    )
    steady = settled(places.join(known.select("host", "token", "is_text", "class"), ["host", "token", "is_text"]))
    beside = steady.where("NOT is_text").select("host", "class", "gap").distinct().withColumn("beside", F.lit(True))
    held = steady.where("is_text").join(beside, ["host", "class", "gap"], "left")
    return held.where("own OR beside").select("host", "token")


def templates(pages: DataFrame) -> DataFrame:
    """``host, text, menus``: hashes of the template's text and of its slots of links, of hosts that have any."""
    tokens = (
        pages.select(host_of(F.col("url")).alias("host"), "html")
        .mapInArrow(_tokens, "host string, token long, is_text boolean, pages long, sum long, words long, linked long, times long")
        .groupBy("host", "token", "is_text")
        .agg(F.sum("pages").alias("pages"), F.expr("pmod(sum(cast(sum as decimal(20, 0))), 18446744073709551616BD)").alias("sum"), F.sum("words").alias("words"), F.sum("linked").alias("linked"), F.sum("times").alias("times"))
        .where(F.col("pages") >= SUPPORT)
    )
    tokens = settled(tokens)
    tags = tokens.where("NOT is_text")
    valid = tags.groupBy("host", "pages", "sum").agg(F.count(F.lit(1)).alias("tags"))
    texts = nested_and_ordered(pages, tags, tokens.where("is_text").join(valid, ["host", "pages", "sum"]))
    texts = texts.groupBy("host").agg(F.collect_set("token").alias("text"))
    menus = tags.where(F.col("linked") * 100 >= F.col("words") * LINKS).where("words > 0").groupBy("host").agg(F.collect_set("token").alias("menus"))
    return texts.join(menus, "host", "full").select("host", "text", "menus")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for page, text, menus in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
            kept = slots(parse(page or "")[0])
            if text or menus:
                text, menus = set(text or ()), set(menus or ())
                own = [b for b in kept if b.main or _hash(b.slot) not in menus and _hash(b.slot, b.text) not in text]
                kept = own or kept
            out.append("\n".join(b.text for b in kept))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of(F.col("url")).alias("__host"))
    joined = _by_host(rows, templates(pages), "left")
    return joined.select("page_id", "url", "html", "text", "menus").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long"
    )
