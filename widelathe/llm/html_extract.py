"""Main text of web pages, less the templates of their sites.

Every page is cut into blocks of text, each with the innermost container
that it stands in; containers have the hash of their subtree, their parent and, outside articles, the hash of their shape: tags and names, equal
neighbours once, no text. Spark counts for each host on how many pages a subtree
occurs, and on how many a shape does; what recurs on many pages of the host is its template and
is deleted. Shapes find what a site fills anew on each page: menus, adverts, footers. What doesn't recur is told by its tag, class, id or role.
"""

from __future__ import annotations

import html
import re
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_enough
from .url_filter import host_of

# a quote opens a value only where the value begins
_VALUE = r"""\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*+)"""
_TOKEN = re.compile(rf"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:{_VALUE})?+)*+)(?:>|\Z)|[^<]+|<""", re.S)
_NAMED = re.compile(rf"""([^\s/>][^\s/>=]*+)({_VALUE})""")
_PARTS = re.compile(r"[^a-z0-9]+")

# fixed values: tags, and parts of class, id and role, by their part in a page
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: The content is no markup; it ends with the tag of the same name.
UNPARSED = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED_TAGS = frozenset("nav footer aside form script style noscript template iframe svg button select textarea menu dialog head title object canvas".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: A new block ends an open paragraph.
PARAGRAPH_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr option".split())
CONTAINERS = frozenset("div section header footer nav aside form ul ol dl table fieldset details menu".split())
#: What holds no text of the page at all.
NO_TEXT_TAGS = frozenset("script style noscript template iframe svg head title object canvas select textarea".split())
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr login menu modal nav navbar navigation newsletter notice notices popup promo promoted related replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets".split()
)
#: Parts of a name that say nothing of what a subtree is.
NEUTRAL_NAMES = frozenset("area block body box container group holder inner item items list outer panel section slot top bottom unit wrap wrapper".split())
#: Containers whose shape says nothing: they have no name.
PLAIN = frozenset(f"{tag} " for tag in "div section ul ol dl table".split())
#: The article stands for the page if it has at least this share of the text that isn't dropped.
ARTICLE_SHARE = 0.25
#: Inside the article these are content however often they recur.
CONTENT_TAGS = frozenset("ul ol dl table".split())
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())


def _names(attributes: str) -> tuple[set[str], set[str], list[str]]:
    """(parts of class and id, roles, whole words of class and id), lower-cased."""
    names: set[str] = set()
    roles: set[str] = set()
    words: list[str] = []
    if attributes and "=" in attributes:
        for kind, value in _NAMED.findall(attributes):
            kind, value = kind.lower(), value.lower().split("=", 1)[1].strip()
            parts = _PARTS.split(value) if kind in ("class", "id", "role") else []
            if kind == "role":
                roles.update(p for p in parts if p)
            elif parts:
                names.update(p for p in parts if p)
                words += value.strip("\"'").split()
    return names, roles, words


def _in_full(words: list[str], dropped: frozenset[str]) -> bool:
    """Whether some whole word of class or id says no more than a dropped name: ``ad``, ``ad-box`` and ``comment-list``, but not ``share-price``."""
    return any(parts & dropped and parts <= dropped | NEUTRAL_NAMES for parts in ({p for p in _PARTS.split(w) if p} for w in words))


class _Named:
    """A subtree that is dropped by its name, unless it is found to hold the page's article; ``over`` is the place of the next one around it."""

    __slots__ = ("whole", "leads", "main", "article", "size", "over")

    def __init__(self, words: list[str], dropped: frozenset[str], over: int):
        parts = [[p for p in _PARTS.split(w) if p] for w in words]
        self.whole = any(len(p) == 1 and p[0] in dropped for p in parts)
        self.leads = any(p and p[0] in dropped for p in parts)
        self.main = self.article = False
        self.size, self.over = 0, over

    def drops(self, total: int) -> bool:
        if self.main or self.whole:
            return not self.main
        return not self.article and (self.leads or 2 * self.size <= total)


class _Open:
    __slots__ = ("tag", "drop", "article", "first", "named", "at", "parts", "label", "kids", "leads")

    def __init__(self, tag: str, drop: bool, article: int, first: int, named: int, at: int, parts: list[str] | None, label: str):
        self.tag, self.drop, self.article, self.first, self.named, self.at, self.parts = tag, drop, article, first, named, at, parts
        self.label, self.kids, self.leads = label, [], article > 0


def blocks_of(page: str | None) -> list[tuple[str, bool, list[int]]]:
    """(text, part of the article by its tags, hashes of the containers around it) for each block of text.

    If the page has an article or main element that isn't dropped and holds ``ARTICLE_SHARE`` of the rest, only what is inside one is part of it.
    """
    blocks, containers, _ = parse(page)
    only = article_alone(blocks)
    out = []
    for t, own, inside, at in blocks:
        chain = []
        while at >= 0:
            chain += [containers[at][0]] if containers[at][0] is not None else []
            at = containers[at][1]
        out.append((t, own and (inside or not only), chain))
    return out


def article_alone(blocks: list[tuple[str, bool, bool, int]]) -> bool:
    inside = sum(len(t) for t, own, inside, _ in blocks if own and inside)
    return 0 < inside >= ARTICLE_SHARE * sum(len(t) for t, own, _, _ in blocks if own)


def parse(page: str | None, by_name: bool = True) -> tuple[list[tuple[str, bool, bool, int]], list[tuple[int | None, int]], list[int | None]]:
    """(text, not dropped, inside an article or main element, innermost container) for each block of text, (hash, parent) for each container, and each container's shape.

    A subtree goes by its name, but not if a main element is in it; with a name that has the dropped word as a part only, not
    if an article is in it, or, where the word isn't the first part, most of the text of the page's paragraphs; inside an article and on
    a paragraph only a name that says nothing else counts. Containers
    come after their parents; the hash is of the names, the text and the containers inside, and null where the
    container is no template: without text, or with most of an article in it. The shape is null for what is in an article, holds one, has no text or most of the page's, and for a plain container without a name.
    Without ``by_name`` no tag, name or role drops anything but what is no text at all. The time is in proportion to the page, however deep it is nested.
    """
    out: list[tuple[str, bool, int, int, int, bool]] = []  # text, kept, article, container, named subtree, in a paragraph
    stack: list[_Open] = []
    text: list[str] = []
    articles = paragraphs = 0
    opened: dict[str, int] = {}
    named: list[_Named] = []
    containers: list[list] = []
    holds: list[tuple[int, int, int, int]] = []
    shaped: list[tuple[int, int, int, int]] = []  # container, shape, its first block, the one after its last
    dropped_tags = DROPPED_TAGS if by_name else NO_TEXT_TAGS

    def flush() -> None:
        words = "".join(text).split()
        text.clear()
        if words:
            top = stack[-1] if stack else None
            at = top.at if top else -1
            if at >= 0:
                containers[at][2].append(" ".join(words))
            out.append((" ".join(words), not (top and top.drop), top.article if top else 0, at, top.named if top else -1, paragraphs > 0))

    def close(k: int) -> None:
        nonlocal paragraphs
        while len(stack) > k:
            node = stack.pop()
            opened[node.tag] -= 1
            paragraphs -= node.tag == "p"
            above = stack[-1] if stack else None
            if node.leads:
                if above:
                    above.leads = True
            elif above or node.parts is not None:
                shape = xxhash.xxh64_intdigest("\x00".join([node.label, *node.kids]))
                if above and (not above.kids or above.kids[-1] != str(shape)):
                    above.kids.append(str(shape))
                if node.parts is not None and len(out) > node.first and node.label not in PLAIN:
                    shaped.append((node.at, shape, node.first, len(out)))
            if node.parts is None:
                continue
            own = containers[node.at]
            if own[2]:
                digest = xxhash.xxh64_intdigest("\x00".join([node.tag, *node.parts, *own[2]]).encode("utf-8", "surrogatepass"))
                own[0] = digest - ((digest >> 63) << 64)
                if own[1] >= 0:
                    containers[own[1]][2].append(f"\x01{digest}")
                if node.article:
                    holds.append((node.at, node.article, node.first, len(out)))
            own[2] = None

    at, page = 0, page or ""
    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            if page[m.start()] != "<" or at == m.start() + 1:
                text.append(html.unescape(m[0]) if "&" in m[0] else m[0])  # a reference ends where a tag begins
            continue
        tag = tag.lower()
        block = tag in BLOCK_TAGS
        if block:
            flush()
        elif tag == "br":
            text.append(" ")
        if m[1]:
            for k in range(len(stack) - 1, -1, -1) if opened.get(tag) else ():
                if stack[k].tag == tag:
                    close(k)
                    break
                if block and tag in PARAGRAPH_TAGS and stack[k].tag in CONTAINERS:
                    break
            continue
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK_TAGS:
            continue
        if block and (paragraphs or tag in PARAGRAPH_TAGS):
            # a block ends an open paragraph; an item ends the item before it
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == "p" or stack[k].tag == tag and tag in PARAGRAPH_TAGS:
                    close(k)
                    break
                if stack[k].tag in CONTAINERS or stack[k].tag in ("article", "main", "blockquote", "td", "th", "li"):
                    break
        if tag in UNPARSED and tag in dropped_tags:
            end = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = end.start() if end else len(page)
        top = stack[-1] if stack else None
        names, roles, words = _names(m[3])
        article = top.article if top else 0
        main = tag == "main" or "main" in roles
        if not article and (main or tag == "article" or "article" in roles):
            articles += 1
            article = articles
        drop = bool(top and top.drop) or tag in dropped_tags or by_name and (bool(roles & DROPPED_ROLES) or not article and tag == "header")
        over = top.named if top else -1
        if over >= 0 and not drop and (main or tag == "article" and not names & DROPPED_NAMES):
            named[over].main |= main
            named[over].article = True
        dropped = DROPPED_NAMES | {"header"} if not article and tag in CONTAINERS else DROPPED_NAMES
        # inside an article and on a paragraph a part of a name isn't enough
        if by_name and tag not in ("html", "body", "article", "main") and names & dropped and (not (article or tag in PARAGRAPH_TAGS) or _in_full(words, dropped)):
            named.append(_Named(words, dropped, over))
            named[-1].main, named[-1].article = main, "article" in roles
            over = len(named) - 1
        holder, parts = top.at if top else -1, None
        if tag in CONTAINERS and not (article and tag in CONTENT_TAGS):
            containers.append([None, holder, []])
            holder, parts = len(containers) - 1, [" ".join(sorted(names))]
        opened[tag] = opened.get(tag, 0) + 1
        paragraphs += tag == "p"
        stack.append(_Open(tag, drop, article, len(out), over, holder, parts, "" if article else f"{tag} {' '.join(sorted(names))}"))
    flush()
    close(0)
    lengths = [0, *accumulate(len(t) for t, *_ in out)]
    # where no paragraph is marked, all text counts
    marked = any(kept and p for _, kept, _, _, _, p in out)
    total = 0
    for t, kept, _, _, over, p in out:
        if kept and (p or not marked):
            total += len(t)
            if over >= 0:
                named[over].size += len(t)
    for one in reversed(named):  # what is inside comes after what is around it
        if one.over >= 0:
            around = named[one.over]
            around.size += one.size
            around.main |= one.main
            around.article |= one.article
    gone: list[bool] = []
    for one in named:
        gone.append(one.drops(total) or one.over >= 0 and gone[one.over])
    blocks = [(t, kept and not (over >= 0 and gone[over]), article > 0, holder) for t, kept, article, holder, over, _ in out]
    # what holds most of an article is no template
    sizes: dict[int, int] = {}
    upto = [0]
    for (_, _, article, *_), (t, own, _, _) in zip(out, blocks, strict=True):
        sizes[article] = sizes.get(article, 0) + own * len(t)
        upto.append(upto[-1] + own * len(t))
    for holder, article, a, b in holds:
        if 2 * (upto[b] - upto[a]) > sizes.get(article, 0) > 0:
            containers[holder][0] = None
    shapes: list[int | None] = [None] * len(containers)
    for holder, shape, a, b in shaped:
        if 2 * (lengths[b] - lengths[a]) <= lengths[-1]:
            shapes[holder] = shape - ((shape >> 63) << 64)
    return blocks, [(h, parent) for h, parent, _ in containers], shapes


_BLOCK = pa.struct([("text", pa.string()), ("own", pa.bool_()), ("inside", pa.bool_()), ("at", pa.int32())])
_PARSED = pa.struct([("blocks", pa.list_(_BLOCK)), ("hashes", pa.list_(pa.int64())), ("shapes", pa.list_(pa.int64())), ("parents", pa.list_(pa.int32())), ("page", pa.int64())])


def parsed_blocks(page: Column, by_name: bool = True) -> Column:
    """The blocks of a page, the hashes, shapes and parents of its containers, and a hash of its own text."""

    @F.arrow_udf("struct<blocks:array<struct<text:string,own:boolean,inside:boolean,at:int>>,hashes:array<long>,shapes:array<long>,parents:array<int>,page:long>")
    def parsed(pages: pa.Array) -> pa.Array:
        made = []
        for raw in pages.to_pylist():
            blocks, containers, shapes = parse(raw, by_name)
            only = by_name and article_alone(blocks)
            page = xxhash.xxh64_intdigest("\n".join(t for t, own, inside, _ in blocks if own and (inside or not only)).encode("utf-8", "surrogatepass"))
            rows = [{"text": t, "own": own, "inside": inside, "at": at} for t, own, inside, at in blocks]
            made.append({"blocks": rows, "hashes": [h for h, _ in containers], "shapes": shapes, "parents": [p for _, p in containers], "page": page - ((page >> 63) << 64)})
        return pa.array(made, _PARSED)

    return parsed(page)


def _inside(hit: list[bool], parents: list[int]) -> list[bool]:
    """Whether each container is a hit or stands inside one; parents come first."""
    out: list[bool] = []
    for own, parent in zip(hit, parents, strict=True):
        out.append(bool(own) or parent >= 0 and out[parent])
    return out


_GONE = pa.struct([("text", pa.list_(pa.bool_())), ("any", pa.list_(pa.bool_()))])


def _both(hits: np.ndarray, shaped: np.ndarray, parents: list[int]) -> dict[str, list[bool]]:
    """Which containers go by their subtree, and which by it or their shape."""
    text = _inside(hits.tolist(), parents) if hits.any() else [False] * len(parents)
    return {"text": text, "any": _inside((hits | shaped).tolist(), parents) if shaped.any() else text}


def _gone(often: DataFrame, host: Column, parsed: str) -> Column:
    """Whether each of a page's containers is template on its host, or inside one that is."""
    found = often.select(F.xxhash64("host", "shape", "subtree").alias("key")).toArrow()["key"].to_numpy()
    keys = often.sparkSession.sparkContext.broadcast(np.sort(found))

    @F.arrow_udf("struct<text:array<boolean>,any:array<boolean>>")
    def gone(asked: pa.Array, shapes: pa.Array, above: pa.Array) -> pa.Array:
        every, out = keys.value, []

        def hit(own: pa.ListScalar) -> np.ndarray:
            own = own.values.to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(every, own), max(len(every) - 1, 0))
            return every[at] == own if len(every) else np.zeros(len(own), dtype=bool)

        for own, shaped, parents in zip(asked, shapes, above.to_pylist(), strict=True):
            out.append(_both(hit(own), hit(shaped), parents))
        return pa.array(out, _GONE)

    # a container without a hash asks for a key that no template has: its own hash of null
    key = lambda field, shape: F.transform(f"{parsed}.{field}", lambda h: F.when(h.isNotNull(), F.xxhash64(host, F.lit(shape), h)).otherwise(F.xxhash64(F.lit("no template"), F.lit(0))))
    return gone(key("hashes", False), key("shapes", True), F.col(f"{parsed}.parents"))


def _gone_of(parsed: str, templates: Column) -> Column:
    """As ``_gone``, by the list of the page's own templates."""

    @F.arrow_udf("struct<text:array<boolean>,any:array<boolean>>")
    def gone(asked: pa.Array, shapes: pa.Array, above: pa.Array, known: pa.Array) -> pa.Array:
        out = []
        for own, shaped, parents, t in zip(asked.to_pylist(), shapes.to_pylist(), above.to_pylist(), known.to_pylist(), strict=True):
            every = {(x["shape"], x["subtree"]) for x in t}
            out.append(_both(np.array([(False, h) in every for h in own], dtype=bool), np.array([(True, h) in every for h in shaped], dtype=bool), parents))
        return pa.array(out, _GONE)

    return gone(F.col(f"{parsed}.hashes"), F.col(f"{parsed}.shapes"), F.col(f"{parsed}.parents"), templates)


#: Template subtrees that are broadcast at most; beyond that the subtrees of the pages are joined by host, subtree and salt.
BROADCAST_SUBTREES = 1_000_000
SALTS = 64


def extract(pages: DataFrame, *, min_pages: int = 5, min_share: float = 0.01, shape_pages: int = 10, url_col: str = "url", html_col: str = "html", columns: list[str] | None = None, by_name: bool = True, by_count: bool = True) -> DataFrame:
    """Adds ``text`` (main text), ``n_chars`` and ``n_template`` (blocks deleted as template) to every row.

    A container subtree is template if it occurs on at least ``min_pages`` pages of its host
    and, as long as that is less than twice ``min_pages``, on the share ``min_share`` of them; from there on the number grows
    with the logarithm of the host's pages. Pages of a host whose own text is the same count once. A shape is template
    by the same rule with ``shape_pages``; on a page of which shapes would take more than half of the text that is left, they take nothing.
    Lists and tables of an article and what holds most of it are no template. Blocks of the article
    are kept as they stand, with white space made single; they are joined by an
    empty line. Null or empty html has the text ''; very long pages are read whole. Null urls are
    one host. Repeated rows count once and get the same text. An empty table gives an
    empty one. Input columns called like an output column are replaced.
    ``columns``: the input columns to return, all by default. ``by_name`` and ``by_count`` switch off the fixed tags, names and roles (and that an article stands for its page), and the counts, to tell what each does.
    """
    columns = [c for c in (columns or pages.columns) if c.lower() not in ("text", "n_chars", "n_template")]
    picked = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    host = host_of(F.col(url_col)).alias("host")
    rows = materialize(pages.select(picked, F.monotonically_increasing_id().alias("uid"), host, parsed_blocks(F.col(html_col), by_name).alias("parsed")), "html-blocks")
    total = rows.groupBy("host").agg(F.count_distinct("parsed.page").alias("pages"))
    of_kind = lambda field, shape: F.transform(F.filter(f"parsed.{field}", lambda h: h.isNotNull()), lambda h: F.struct(F.lit(shape).alias("shape"), h.alias("subtree")))
    subtrees = F.array_distinct(F.concat(of_kind("hashes", False), of_kind("shapes", True)))
    seen = rows.select("uid", "host", F.col("parsed.page").alias("page"), F.explode(subtrees).alias("s")).select("uid", "host", "page", "s.*")
    counts = seen.groupBy("host", "shape", "subtree").agg(F.count_distinct("page").alias("n"))
    # subtrees below the fixed number go before the join by host
    fixed = F.when(F.col("shape"), F.lit(shape_pages)).otherwise(F.lit(min_pages))
    share = F.col("pages") * min_share
    least = F.least(share, fixed * (1 + F.log2(F.greatest(F.lit(1.0), share / fixed))))
    often = counts.where((F.col("n") >= fixed) & F.lit(by_count)).join(total, "host").where(F.col("n") >= least)
    often = materialize(often.select("host", "shape", "subtree"), "html-templates")
    if small_enough(often, BROADCAST_SUBTREES):
        joined = rows.withColumn("gone", _gone(often, F.col("host"), "parsed"))
    else:
        dealt = often.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        found = seen.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int")).join(dealt, ["host", "shape", "subtree", "salt"])
        joined = rows.join(found.groupBy("uid").agg(F.collect_list(F.struct("shape", "subtree")).alias("templates")), "uid", "left")
        templates = F.coalesce(F.col("templates"), F.array().cast("array<struct<shape:boolean,subtree:bigint>>"))
        joined = joined.withColumn("gone", _gone_of("parsed", templates))
    size = lambda c: F.aggregate(c, F.lit(0), lambda n, b: n + F.char_length(b["text"]))
    left = lambda gone: F.filter("parsed.blocks", lambda b: (b["at"] < 0) | ~F.get(gone, b["at"]))
    own = lambda blocks: F.filter(blocks, lambda b: b["own"])
    shaped = F.col("gone.any") != F.col("gone.text")
    most = shaped & (2 * size(own(left("gone.any"))) < size(own(left("gone.text"))))
    joined = joined.withColumn("gone", F.when(most, F.col("gone.text")).otherwise(F.col("gone.any")))
    joined = joined.withColumn("kept", left("gone"))
    joined = joined.withColumn("own", F.filter("kept", lambda b: b["own"])).withColumn("article", F.filter("own", lambda b: b["inside"]))
    alone = F.lit(by_name) & (size("article") > 0) & (size("article") >= size("own") * F.lit(ARTICLE_SHARE))
    text = F.concat_ws("\n\n", F.transform(F.when(alone, F.col("article")).otherwise(F.col("own")), lambda b: b["text"]))
    deleted = F.size("parsed.blocks") - F.size("kept")
    out = joined.select("row.*", text.alias("text"), deleted.alias("n_template"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
