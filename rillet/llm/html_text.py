"""The main text of web pages, without what a site's template puts on many of its pages.

Element subtrees are hashed, Spark counts on how many different pages of a host each occurs at the same
place, and those that recur are deleted.  In addition elements go that by tag, role, class or id are no
article text.
"""

import re
from collections.abc import Iterator, Set
from dataclasses import dataclass, field
from hashlib import blake2b
from html import unescape
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import checkpointed, group_totals, salts

#: HTML's elements without content, and those that end a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An open element that the start of another one of the group ends.
ENDED_BY = {
    **{tag: frozenset(BLOCKS) for tag in ("p",)},
    **{tag: frozenset({"li"}) for tag in ("li",)},
    **{tag: frozenset({"dd", "dt"}) for tag in ("dd", "dt")},
    **{tag: frozenset({"td", "th", "tr"}) for tag in ("td", "th")},
    "tr": frozenset({"tr"}),
    "option": frozenset({"option"}),
}
#: Elements that hold text other than HTML.
RAW = frozenset({"script", "style", "textarea", "title"})
DROPPED_TAGS = frozenset(
    "aside button canvas dialog footer form head header iframe menu nav noscript object script select style svg template textarea title".split()
)
DROPPED_ROLES = frozenset("alert banner complementary contentinfo dialog menu navigation search".split())
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies footer header login "
    "menu modal nav navbar navigation newsletter notice popup promo related replies reply share sharing sidebar social sponsor "
    "sponsored subscribe toolbar widget".split()
)
#: Words that say where or in what form such an element stands; with them a compound name means the same.
FORM_NAMES = frozenset(
    "area article bar block body bottom box button buttons col column container desktop entry form global group icons inner item items "
    "left links list main mobile outer overlay page panel post posts primary right secondary section site slot sticky story top unit "
    "wrap wrapper".split()
)
#: Elements that hold the text of the page, whatever they are named.
NEVER_BY_NAME = frozenset({"#root", "html", "body", "main"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements whose subtrees are counted.
CONTAINERS = frozenset("aside details div dl fieldset figure footer form header nav ol p section table ul".split())

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+)>|<[!?/a-zA-Z][^<>]*+>?""", re.DOTALL
)
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+)))?""")
PART = re.compile(r"[^\W_]+")
NUMBER = re.compile(r"[0-9]+(?:x[0-9]+)?\Z")


@dataclass(slots=True)
class Element:
    tag: str
    attributes: str = ""
    children: list = field(default_factory=list)
    hash: int = 0
    key: int | None = None

    def values(self) -> dict[str, str]:
        return {
            m[1].lower(): unescape(m[2] or m[3] or m[4] or "").lower() for m in ATTRIBUTE.finditer(self.attributes)
        }

    def close(self) -> None:
        """Hash the subtree: tag, attributes, texts without their white space, and children."""
        parts = [f"{self.tag} {' '.join(self.attributes.split())}"]
        parts += (f"<{x.hash}" if isinstance(x, Element) else " ".join(x.split()) for x in self.children)
        self.hash = int.from_bytes(blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def parse(html: str) -> Element:
    """The element tree of a page; end tags that are missing are put where HTML implies them."""
    root = Element("#root")
    stack, place = [root], 0

    def pop(down_to: int) -> None:
        while len(stack) > down_to:
            stack.pop().close()

    while token := TOKEN.search(html, place):
        if token.start() > place:
            stack[-1].children.append(html[place : token.start()])
        place = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        if token[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    pop(depth)
                    break
            continue
        while len(stack) > 1 and tag in ENDED_BY.get(_innermost(stack), ()):
            pop(_place_of(stack))
        element = Element(tag, token[3])
        stack[-1].children.append(element)
        if tag in VOID or token[3].endswith("/") and tag not in BLOCKS:
            element.close()
        elif tag in RAW:
            end = re.compile(rf"</{tag}\b", re.IGNORECASE).search(html, place)
            stop = end.start() if end else len(html)
            element.children.append(html[place:stop])
            element.close()
            place = min(len(html), html.find(">", stop) + 1 or len(html)) if end else len(html)
        else:
            stack.append(element)
    if place < len(html):
        stack[-1].children.append(html[place:])
    pop(0)
    return root


#: Open elements between an element and the one that an implied end tag closes.
_INLINE = frozenset("a abbr b big cite code del em font i ins label mark q s small span strike strong sub sup tt u".split())


def _place_of(stack: list[Element]) -> int:
    """The innermost open element that is not inline."""
    depth = len(stack) - 1
    while depth and stack[depth].tag in _INLINE:
        depth -= 1
    return depth


def _innermost(stack: list[Element]) -> str:
    return stack[_place_of(stack)].tag


def names_dropped(names: str) -> frozenset[str]:
    """Of a class or id the words for which an element goes.

    A name counts as a whole: ``site-footer`` is a footer, as all its other words say only where or in
    what form it stands, but ``social-science`` is none of the words.
    """
    found = set()
    for name in names.split():
        words = {NUMBER.sub("", word) for word in PART.findall(name)} - {""}
        if words <= DROPPED_NAMES | FORM_NAMES:
            found |= words & DROPPED_NAMES
    return frozenset(found)


def is_dropped(element: Element) -> bool:
    return bool(_reasons(element))


def _reasons(element: Element) -> frozenset[str]:
    """The tag, role or words for which an element is no article text."""
    if element.tag in DROPPED_TAGS:
        return frozenset({element.tag})
    if "=" not in element.attributes or element.tag in NEVER_BY_NAME:
        return frozenset()
    values = element.values()
    role = values.get("role")
    return names_dropped(f"{values.get('class', '')} {values.get('id', '')}") | ({role} & DROPPED_ROLES)


def _headings(header: Element) -> list[Element]:
    """The headings of an article's own header, in page order."""
    found, waiting = [], [header]
    while waiting:
        element = waiting.pop()
        if element.tag in HEADINGS:
            found.append(element)
        elif element is header or not is_dropped(element):
            waiting.extend(x for x in reversed(element.children) if isinstance(x, Element))
    return found


def is_main(element: Element) -> bool:
    return element.tag == "main" or ("=" in element.attributes and element.values().get("role") == "main")


def main_parts(root: Element, templates: Set[int] = frozenset()) -> list[Element]:
    """The outermost article elements; without any the main elements; else the whole page.

    What is dropped or belongs to a template is no such element and holds none.
    """
    for wanted in (lambda x: x.tag == "article", is_main):
        found, waiting = [], [root]
        while waiting:
            element = waiting.pop()
            if element is not root and (is_dropped(element) or element.key in templates):
                continue
            if element is not root and wanted(element):
                found.append(element)
            else:
                waiting.extend(x for x in reversed(element.children) if isinstance(x, Element))
        if found:
            return found
    return [root]


def counted(root: Element, host: str = "") -> set[int]:
    """Keys, of host, hash and the tags around it, of all subtrees that can be a template's.

    These are all containers of the page, but no paragraphs inside article or main: one that several
    pages share is text.
    """
    of_host = int.from_bytes(blake2b(host.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)
    found, waiting = set(), [(root, 0, False)]
    while waiting:
        element, path, inside = waiting.pop()
        for child in element.children:
            if isinstance(child, Element):
                if child.tag in CONTAINERS and not (inside and child.tag == "p"):
                    child.key = child.hash ^ path << 31 ^ of_host
                    found.add(child.key)
                waiting.append((child, crc32(f">{child.tag}".encode("utf-8", "surrogatepass"), path), inside or child.tag == "article" or is_main(child)))
    return found


def main_text(root: Element, templates: Set[int] = frozenset()) -> str:
    """Blocks of text, joined by an empty line; ``templates`` are keys that ``counted`` gave the elements."""
    parts = main_parts(root, templates)
    blocks, line = [], []

    def end_block() -> None:
        if text := " ".join("".join(line).split()):
            blocks.append(text)
        line.clear()

    for part in parts:
        waiting: list = [part]
        while waiting:
            item = waiting.pop()
            if item is None:
                end_block()
            elif isinstance(item, str):
                line.append(unescape(item))
            elif item.tag == "br":
                line.append(" ")
            elif item is not part and (item.key in templates or _reasons(item)):
                if item.tag in BLOCKS:
                    end_block()
                if part is not root and item.key not in templates and _reasons(item) <= {"header"}:
                    waiting.extend(reversed(_headings(item)))
            else:
                if item.tag in BLOCKS or item is part:
                    end_block()
                    waiting.append(None)
                waiting.extend(reversed(item.children))
        end_block()
    return "\n\n".join(blocks)


def among(keys: set[int], known: np.ndarray) -> set[int]:
    """The keys that the sorted array ``known`` holds."""
    if not len(known):
        return set()
    own = np.fromiter(keys, np.int64, len(keys))
    return set(own[known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own].tolist())


def host_of(url: Column) -> Column:
    """The host in lower case; empty without one."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def templates(pages: DataFrame, min_pages: int = 4) -> tuple[DataFrame, DataFrame]:
    """(key, page) of all subtrees, and the keys (with salt) of those on so many different pages of a host.

    ``pages`` has host, page (a hash of host and html) and html.  Pages with equal html count once.  The
    number of a host's pages does not matter, as its sections can have templates of their own.
    """

    def subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, keys = [], []
            for place, (host, html) in enumerate(zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True)):
                found = counted(parse(html or ""), host)
                places += [place] * len(found)
                keys += found
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column("page").take(pa.array(places, pa.int64()))], ["key", "page"])

    rows = pages.filter("host <> ''").select("host", "page", "html").mapInArrow(subtrees, "key long, page long").distinct()
    salt = F.pmod(F.col("page"), F.lit(salts(pages.sparkSession))).cast("int")
    rows = checkpointed(rows.withColumn("salt", salt))
    often = group_totals(rows, "key", "salt", {"pages": ("count", "page")}).filter(F.col("pages") >= min_pages)
    return rows, checkpointed(often.select("key", "salt"))


def extract(pages: DataFrame, min_pages: int = 4, most_keys: int = 1 << 21) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Text is that of the article (else main, else the page) without menus, headers, footers,
    sidebars, notices, adverts, forms, scripts, comments and templates.  Of an article's own header the
    headings stay.  White space is Unicode's, the non-breaking space included.  A null or empty html, or
    one without text, gives an empty text; a page without host has no templates; repeated rows give
    equal rows.  Other columns are not read; an empty table gives an empty result.

    Up to ``most_keys`` keys of templates go to all tasks, 8 bytes each, and no html is shuffled; beyond
    that each page is joined with its own keys.  The rows are the same.
    """
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    rows = rows.withColumn("page", F.xxhash64("host", F.coalesce("html", F.lit(""))))
    subtrees, often = templates(rows, min_pages)
    known = often.select("key").distinct()
    if known.count() <= most_keys:
        shared = pages.sparkSession.sparkContext.broadcast(np.sort(known.toArrow().column("key").to_numpy()))
        rows = rows.withColumn("templates", F.lit(None).cast("array<bigint>"))
    else:
        shared = None
        hits = subtrees.join(often, ["key", "salt"], "left_semi").groupBy("page").agg(F.collect_list("key").alias("templates"))
        rows = rows.join(hits, "page", "left")

    def text_of(html: str | None, host: str, own: list[int] | None) -> str:
        root = parse(html or "")
        found = counted(root, host) if host else set()
        if shared is None:
            found &= set(own or ())
        elif found:
            found = among(found, shared.value)
        return main_text(root, found)

    def text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("html", "host", "templates")]
            texts = [text_of(*row) for row in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    rows = rows.select("page_id", "url", "html", "host", "templates")
    return rows.mapInArrow(text, f"page_id {kind}, url string, text string, n_chars long")
