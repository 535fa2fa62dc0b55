"""Main text of web pages by template deduction over the pages of a host.

A token is the way down to an element, tags with their class or id, or the text at such a way. Tokens
that occur equally often on every page of a host share an occurrence vector and make an equivalence
class; classes that are large and frequent belong to the host's template, and the way down nests one
in another. Text in the class of its way is the template's, what varies is in a slot. Marks, that is
tags, classes and ids that name a menu, an advert, a comment and the like, make the rest template
too, and where a page declares its article, that is the main element.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingmill.llm.common import map_texts, stored
from filingmill.llm.urls import host_and_path

MANY = 3  # different articles at least, from which text that is the same on all pages is the template's
VARIED = 0.5  # of the pages with a way, that have different articles
LEADS = 3  # longest blocks by which articles are told apart, so that near copies are not
FREQUENT = 0.05  # of a host's pages on which a class of the template stands
MOST_LINKS = 0.5  # of a block's or element's characters in links, beyond which it is a menu
HOT_SHARE = 0.01  # of all pages, from which on a host's pages are not shuffled
DEPTH = 48  # levels below which only elements with a mark are told apart
BODY = "body"

# Fixed values of HTML: elements without an end, elements whose content is not markup, elements that
# run on in a line, and which open elements a new one ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style title textarea noscript iframe noembed noframes xmp template svg math select"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em embed font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
ENDS = {
    "li": ("li", "ul ol menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "tbody": ("thead tbody tr td th", "table"),
    "option": ("option", "select"),
}
# What marks an element as no part of an article: tags, and words in its class or id.
APART_TAGS = frozenset("head nav footer aside form menu dialog button fieldset object canvas".split())
APART_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended comment comments discussion "
    "respond replies reply disqus form search pagination pager toc skip legal copyright".split()
)
# Of these words, those that parts of an article are called as well: they mark a box of links only.
WEAK_WORDS = frozenset(
    "promo notice notices alert share sharing social related recommended discussion respond replies reply search toc legal".split()
)
# What stands after one of these in a class says how the page is, not what the element is.
STATES = frozenset("no not has with without hide category tag type format status".split())
HEAD_WORDS = frozenset(["header", "masthead", "topbar"])  # of a page, but an article has a header too
ARTICLE = frozenset(["article", "main"])

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW.split())})(?=[\s/>])[^>]*+(?:/>|>(?:.*?)(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<rest>(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>=]|=)*+)(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
_DIGITS = re.compile("[0-9]+")


@lru_cache(maxsize=20_000)
def _step(tag: str, rest: str) -> str:
    """How an element is written in a way: its tag, then role, id and classes, numbers as 0."""
    names = {k.lower(): v.strip("\"'").lower() for k, v in _NAMED.findall(rest)}
    marks = [names.get("role", ""), names.get("id", ""), *names.get("class", "").split()]
    return ".".join([tag, *(_DIGITS.sub("0", m.replace(">", "").replace(".", "-")) for m in marks if m)])


@lru_cache(maxsize=20_000)
def _kind(step: str) -> tuple[bool, bool, bool, bool]:
    """Whether a step is apart from any article, apart if it is mostly links, apart unless within an
    article, and an article."""
    tag, *marks = step.split(".")
    words: set[str] = set()
    for m in marks:
        parts = re.split(r"[^a-z]+", m)
        words.update(parts[: next((i for i, w in enumerate(parts) if w in STATES), len(parts))])
    return (
        tag in APART_TAGS or bool(words & (APART_WORDS - WEAK_WORDS)),
        bool(words & WEAK_WORDS),
        tag == "header" or bool(words & HEAD_WORDS),
        tag in ARTICLE or bool(words & ARTICLE),
    )


@lru_cache(maxsize=20_000)
def above(way: str) -> tuple[str, ...]:
    """The ways to the elements on the way down, its own last."""
    steps = way.split(">")
    return tuple(">".join(steps[: i + 1]) for i in range(len(steps)))


def apart(way: str, cleared: frozenset[str] = frozenset(), boxes: frozenset[str] = frozenset()) -> bool:
    """Whether a mark on the way down says so. Marks on cleared elements say nothing; the weak ones
    count on boxes of links."""
    inside = False
    for at, step in zip(above(way), way.split(">")):
        never, weak, outside, article = _kind(step)
        if (never or (outside and not inside) or (weak and at in boxes)) and at not in cleared:
            return True
        inside |= article
    return False


class Marks:
    """What the marks of a page's elements say, next to how its text is spread over them.

    `known` has the marked elements that are frequent on the host, and whether they hold most running
    text of the pages they stand on; the others are judged by the page itself."""

    def __init__(self, blocks: list[tuple[str, str, int]], known: dict[str, bool]):
        chars: Counter[str] = Counter()
        links: Counter[str] = Counter()
        self.held: Counter[str] = Counter()
        for way, text, linked in blocks:
            for at in above(way):
                chars[at] += len(text)
                links[at] += linked
                if running(text, linked):
                    self.held[at] += len(text)
        self.boxes = frozenset(at for at, n in chars.items() if links[at] > MOST_LINKS * n)
        self.cleared: frozenset[str] = frozenset()
        self._apart: dict[str, bool] = {}
        self.declared = self._declares(blocks)
        self.plain = self.declared  # also without marks cleared
        if not self.declared:
            marked = [at for at in self.held if is_marked(at)]
            whole = {at for at in marked if known.get(at, 2 * self.held[at] > self.held[BODY])}
            # An element around the article is no box beside it, whatever it is called.
            around = {at for way in chars for at in _around_article(way)}
            self.cleared = frozenset(whole | around)
            self._apart = {}
            self.declared = self._declares(blocks)

    def apart(self, way: str) -> bool:
        if way not in self._apart:
            self._apart[way] = apart(way, self.cleared, self.boxes)
        return self._apart[way]

    def _declares(self, blocks: list[tuple[str, str, int]]) -> bool:
        """Elements that say they are the article hold most of the running text that is not apart."""
        inside = total = 0
        for way, text, linked in blocks:
            if running(text, linked) and not self.apart(way):
                total += len(text)
                inside += len(text) * in_article(way)
        return 2 * inside > total


def running(text: str, linked: int) -> bool:
    return linked <= MOST_LINKS * len(text)


@lru_cache(maxsize=20_000)
def is_marked(way: str) -> bool:
    return any(_kind(way.rpartition(">")[2])[:3])


@lru_cache(maxsize=20_000)
def _around_article(way: str) -> tuple[str, ...]:
    """The ways down to the outermost article element that has no mark itself, unless it stands in a
    menu, an aside or a footer."""
    for i, at in enumerate(above(way)):
        step = at.rpartition(">")[2]
        if step.split(".")[0] in ("nav", "aside", "footer"):
            return ()
        if _kind(step)[3] and not any(_kind(step)[:2]):
            return above(way)[:i]
    return ()


@lru_cache(maxsize=50_000)
def in_article(way: str) -> bool:
    return any(_kind(step)[3] for step in way.split(">"))


def blocks_of(page: str) -> tuple[list[tuple[str, str, int]], Counter[str]]:
    """Blocks of text in page order (the way down to them, text, characters in links), and how often
    each way occurs. References are decoded, white space is one space, and empty blocks are none."""
    blocks: list[tuple[str, str, int]] = []
    ways: Counter[str] = Counter([BODY])
    stack: list[tuple[str, str]] = []
    pieces: list[str] = []
    at = links = depth_of_link = 0

    def close() -> None:
        nonlocal links
        text = " ".join("".join(pieces).split())
        if text:
            blocks.append((stack[-1][1] if stack else BODY, text, min(links, len(text))))
        pieces.clear()
        links = 0

    def leave(tags: str, within: str = "") -> None:
        """Ends the innermost of these elements, with all in it, if it is open inside `within`."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags.split():
                del stack[i:]
                return
            if stack[i][0] in within.split():
                return

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text = html.unescape(page[at : m.start()])
            pieces.append(text)
            links += len(text) if depth_of_link else 0
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag in INLINE:
            if tag == "br":
                pieces.append(" ")
            elif tag == "a":
                depth_of_link = 0 if m["end"] else 1
            continue
        close()
        if m["end"]:
            leave(tag)
            continue
        if tag in ("html", BODY):
            leave("head")
            continue
        leave("p", "td th li div article section main body button")
        for ended, within in [ENDS[tag]] if tag in ENDS else []:
            for _ in ended.split():
                leave(ended, within)
        if tag in VOID or m["rest"].endswith("/") and tag not in ("p", "div", "article", "main", "section"):
            continue
        above = stack[-1][1] if stack else BODY
        step = _step(tag, m["rest"])
        way = above
        if len(stack) < DEPTH or (any(_kind(step)) and above.rpartition(">")[2] != step):
            way = f"{above}>{step}"
        ways[way] += 1
        stack.append((tag, way))
    if at < len(page):
        pieces.append(html.unescape(page[at:]))
    close()
    return blocks, ways


def _digest(texts: list[str]) -> int:
    """64 bits; lone surrogates, which references can give, are digested too."""
    joined = "\n".join(texts).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(joined, digest_size=8).digest(), "big", signed=True)


def is_headline(way: str) -> bool:
    return way.rpartition(">")[2].split(".")[0] == "h1"


TOKEN = (
    "way string, n long, held long, total long, marked boolean, own long, inner long, outer long, words long, seen long, lead long"
)


def _tokens(keys: list[int], texts: list[str]) -> dict[str, list]:
    out: dict[str, list] = {k: [] for k in ("key", *(c.split()[0] for c in TOKEN.split(", ")))}
    for key, page in zip(keys, texts):
        blocks, ways = blocks_of(page)
        marks = Marks(blocks, {})
        seen = _digest([page])
        lead = _digest(sorted({text for _, text, linked in blocks if running(text, linked)}, key=lambda t: (-len(t), t))[:LEADS])
        words: dict[str, list[str]] = {}
        own: Counter[str] = Counter()
        inner: Counter[str] = Counter()
        for way, text, linked in blocks:
            words.setdefault(way, []).append(text)
            # Running text that a main element must not leave out; a headline stays wherever it is.
            if running(text, linked) and not marks.apart(way) and not is_headline(way) and (in_article(way) or not marks.declared):
                own[way] += len(text)
                for at in above(way):
                    inner[at] += len(text)
        for way, n in ways.items():
            out["key"].append(key)
            out["way"].append(way)
            out["n"].append(n)
            # Where the page says plainly which part is its article, what holds more is not the article.
            out["held"].append(0 if marks.plain else marks.held[way])
            out["total"].append(marks.held[BODY])
            out["marked"].append(is_marked(way))
            out["own"].append(own[way])
            out["inner"].append(inner[way])
            out["outer"].append(inner[BODY])
            out["words"].append(_digest(words[way]) if way in words else None)
            out["seen"].append(seen)
            out["lead"].append(lead)
    return out


def tokens(pages: DataFrame) -> DataFrame:
    """host, page and the columns of TOKEN of every token of pages with host, page and html."""
    rows = pages.select(F.struct("page", "host").alias("key"), F.coalesce("html", F.lit("")).alias("text"))
    found = map_texts(rows, f"key struct<page: long, host: string>, {TOKEN}", lambda: _tokens)
    return found.select("key.host", "key.page", *(c.split()[0] for c in TOKEN.split(", ")))


def classes(found: DataFrame) -> DataFrame:
    """host, way, pages, vector, once, fixed and what templates() and marked() need, of all tokens.

    The vector of a token, its number on every page of the host, is kept as sums of hashes of page and
    number: equal vectors are equal, whatever the number of pages. A page is its key and content, so
    rows that repeat a key do not cancel. A class is valid if it is large, that is, not one token alone,
    and frequent; the only page of a host is a template by itself.

    The text at a way is a token too. Its vector is that of the way if all pages with the way have the
    same text there: then no slot is left, and the text is fixed, if the class is frequent and its pages
    have many different articles. Copies of an article are no template, nor is its headline."""
    halves = F.struct(
        F.sum(F.shiftrightunsigned("token", 32)).alias("high"), F.sum(F.col("token").bitwiseAND(0xFFFFFFFF)).alias("low")
    )
    summed = found.withColumn("token", F.xxhash64("page", "seen", "n")).groupBy("host", "way").agg(
        F.count("*").alias("pages"),
        halves.alias("vector"),
        F.max("n").alias("most"),
        ((F.min("words") == F.max("words")) & (F.count("words") == F.count("*"))).alias("same"),
        F.approx_count_distinct("lead").alias("articles"),
        F.when(F.min("own") == F.max("own"), F.max("own")).otherwise(0).alias("own"),
        *(F.sum(c).alias(c) for c in ("held", "total", "inner", "outer")),
        F.max("marked").alias("marked"),
    )
    # Read more than once below; pages are not parsed again for it.
    summed = stored(summed, "ways")
    sizes = summed.groupBy("host", "pages", "vector").agg(F.count("*").alias("size"))
    hosts = summed.filter(F.col("way") == BODY).select("host", F.col("pages").alias("all_pages"))
    joined = summed.join(sizes, ["host", "pages", "vector"]).join(hosts, "host")
    frequent = F.col("pages") >= FREQUENT * F.col("all_pages")
    valid = (F.col("pages") == F.col("all_pages")) | ((F.col("size") > 1) & frequent)
    several = F.col("articles") >= F.greatest(F.lit(MANY), VARIED * F.col("pages"))
    headline = F.col("way").rlike(r"(^|>)h1(\.[^>]*)?$")
    return joined.select(
        "host", "way", "pages", "all_pages", "vector", (valid & (F.col("most") == 1)).alias("once"),
        (F.coalesce("same", F.lit(False)) & several & ~headline & frequent).alias("fixed"), "own", "held", "total", "inner", "outer", "marked",
    )


def templates(found: DataFrame) -> DataFrame:
    """host, main: the ways to elements that hold the host's articles, one for each layout at least.

    Such an element stands once on its pages, and all running text these have outside it is fixed text
    of its own class or of the class of all pages. Where a deeper one stands on as many pages, it is that."""
    every = F.col("pages") == F.col("all_pages")
    text = found.filter("fixed").select("host", "way", "vector", "own", every.alias("every"))
    on_all = text.filter("every").groupBy("host").agg(F.sum("own").alias("on_all"))
    in_class = text.filter("not every").groupBy("host", "vector").agg(F.sum("own").alias("in_class"))
    steps = F.split("way", ">")

    def upward(last):
        return F.explode(F.transform(F.sequence(F.lit(1), last), lambda n: F.array_join(F.slice(steps, F.lit(1), n), ">")))

    once = found.filter("once").select("host", "way", "vector", "pages", "inner", "outer")
    below = text.select("host", F.col("vector").alias("of"), "own", "every", upward(F.size(steps)).alias("way"))
    within = once.select("host", "way", "vector").join(below, ["host", "way"]).filter(F.col("every") | (F.col("of") == F.col("vector")))
    within = within.groupBy("host", "way").agg(F.sum("own").alias("within"))
    joined = once.join(on_all, "host", "left").join(in_class, ["host", "vector"], "left").join(within, ["host", "way"], "left")
    joined = joined.na.fill(0, ["on_all", "in_class", "within"])
    outside = F.col("pages") * (F.col("on_all") + F.col("in_class") - F.col("within"))
    full = (F.col("outer") - F.col("inner") == outside) & (F.col("inner") > F.col("pages") * F.col("within"))
    whole = joined.filter(full).select("host", "way", "pages")
    over = whole.filter(F.size(steps) > 1).select("host", upward(F.size(steps) - 1).alias("way"), "pages")
    return whole.join(over, ["host", "way", "pages"], "left_anti").select("host", F.col("way").alias("main"))


def listed(found: DataFrame, flag: str) -> DataFrame:
    """host and its ways with this flag. Both flags are for frequent ways only, so these are not more
    than twenty pages have."""
    return found.filter(flag).groupBy("host").agg(F.collect_list("way").alias(flag))


def marked(found: DataFrame) -> DataFrame:
    """host, known: the marked elements frequent on the host, and whether they hold most of its running
    text, which no menu, comment or advert does. Not longer than twenty pages have elements."""
    frequent = found.filter("marked").filter(F.col("pages") >= FREQUENT * F.col("all_pages"))
    return frequent.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("way", 2 * F.col("held") > F.col("total")))).alias("known"))


@dataclass(frozen=True)
class Template:
    """What is known of a host's pages: main elements, once-only ones, marked ones, fixed text."""

    mains: frozenset[str] = frozenset()
    once: frozenset[str] = frozenset()
    known: dict[str, bool] = field(default_factory=dict)
    fixed: frozenset[str] = frozenset()

    @classmethod
    def of(cls, row: dict) -> Template:
        return cls(frozenset(row["mains"] or []), frozenset(row["once"] or []), dict(row["known"] or []), frozenset(row["fixed"] or []))

    def main(self, kept: list[tuple[str, str, int]]) -> str:
        """The deepest main element on the page; where other pages with it have text outside it, so that
        it is none of the host's, the deepest once-only element that holds all running text of the page."""
        found = {at for way, _, _ in kept for at in above(way)} & self.mains - {BODY}
        if not found:
            held = [set(above(way)) for way, text, linked in kept if running(text, linked) and not is_headline(way)]
            found = set.intersection(*held) & self.once if held else set()
        return max(found, key=lambda at: (at.count(">"), at), default=BODY)


def text_of(page: str, template: Template) -> str:
    """The text of the slots between the template's text.

    Where marks declare the article, it is that and main headlines outside. Elsewhere nothing goes that
    is not the template's: outside the main element menus, anywhere what is apart or fixed. If that is
    all there is, it stays."""
    blocks = blocks_of(page)[0]
    marks = Marks(blocks, template.known)
    kept = [block for block in blocks if not marks.apart(block[0])]
    kept = [block for block in kept if block[0] not in template.fixed] or kept or blocks
    if marks.declared:
        slots = [block for block in kept if in_article(block[0]) or is_headline(block[0])]
    else:
        main = template.main(kept)
        slots = [block for block in kept if main in above(block[0]) or running(*block[1:]) or is_headline(block[0])]
    return "\n".join(text for _, text, _ in slots or kept)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text of every row; a null or empty page has the empty text.

    Rows that share a key are pages of their own, and pages without a URL those of one host without a
    name. An empty table gives no rows; other columns are ignored."""
    rows = pages.select(
        F.col(key).cast("long").alias("page"), F.col(url).cast("string").alias("url"), host_and_path(url)[0].alias("host"),
        F.col(page).cast("string").alias("html"),
    )
    found = stored(classes(tokens(rows)), "classes")
    sizes = found.filter(F.col("way") == BODY).select("host", "pages")
    total = sizes.agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0]
    mains = templates(found).groupBy("host").agg(F.collect_list("main").alias("mains"))
    known = marked(found).join(listed(found, "fixed"), "host", "full").join(listed(found, "once"), "host", "full")
    main = stored(sizes.join(mains, "host", "left").join(known, "host", "left"), "templates")
    # Hosts with a hundredth of all pages are a hundred at most: their templates go to the pages, which
    # stay where they are. The pages of the others are shuffled to theirs.
    template = main.select("host", F.struct("mains", "once", "known", "fixed").alias("template"), (F.col("pages") >= HOT_SHARE * total).alias("hot"))
    hot = template.filter("hot").select("host", F.col("template").alias("hot_template"))
    known = rows.join(F.broadcast(hot), "host", "left")
    other = known.filter("hot_template is null").join(template.drop("hot"), "host", "left")
    united = other.drop("hot_template").unionByName(known.filter("hot_template is not null").withColumnRenamed("hot_template", "template"))
    joined = united.select(F.struct("page", "url", "template").alias("key"), F.coalesce("html", F.lit("")).alias("text"))

    def work(keys, texts):
        return {
            "page_id": [k["page"] for k in keys],
            "url": [k["url"] for k in keys],
            "text": [text_of(t, Template.of(k["template"])) for k, t in zip(keys, texts)],
        }

    return map_texts(joined, "page_id long, url string, text string", lambda: work)
