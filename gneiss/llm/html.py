"""Main text of web pages by consensus host paths.

Each page is read into blocks: runs of text between block-level tags, each with the chain of
containers around it. A container's score is the text its own blocks hold, less the text of links in
them, and half of its children's; it is credited to the outermost article or the main element around, or, without these, to the
parent of a section, cell or div that is only a part of the parent's text. Every page votes for the paths of its containers with their scores, where a path is the chain of tags and
classes with digits removed. Spark sums the votes by host (partial sums first, so a hot host is no
load on one task), the path with the highest total wins the host, and each page is read again with the
winning path: the blocks inside containers of that path are its text. A page without such a
container uses its own best one, and a page without containers all that is not furniture.

Never part of the text: scripts, styles, forms, navigation, page headers and footers, asides, hidden
elements, and elements whose class, id or role has a word of FURNITURE (menus, adverts,
notices, comments and the like).

The winners are broadcast only if they are counted to be at most 50,000 (a host name and a 64-bit path
each); beyond that they are joined by a shuffle, with each host's pages dealt over SALTS parts.

Defined results: null html is the empty text; an empty or textless page has text '' and n_chars 0; pages with a null
or odd url have no host, so no consensus, and use their own best container; of paths with equal votes the larger name wins; very long pages are read
whole; an element of furniture that is never closed ends with an element around it or before the next article or heading;
repeated rows are kept; an empty table gives no rows; further columns are kept whatever their names, but text and n_chars are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.llm.columns import private
from gneiss.session import checkpoint, table

BROADCAST_ROWS = 50_000
SALTS = 16

#: Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes svg math".split())
DROPPED = frozenset("nav footer aside form button select option menu dialog head object audio video canvas map datalist".split())
BLOCKS = frozenset("html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot caption tr td th figure figcaption address details summary hgroup center fieldset hr header footer nav aside form search".split())
CONTAINERS = frozenset("body main article section div td".split())
CLOSES_P = BLOCKS
#: Words of class, id and role attributes that mark furniture.
FURNITURE = frozenset(
    "nav navbar navigation navi menu menubar topbar toolbar breadcrumb breadcrumbs sidebar sidebars side aside widget widgets footer foot header masthead banner "
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "comment comments commentlist disqus respond replies reply discussion share sharing social follow related recommended newsletter subscribe subscription signup login paywall "
    "search searchform pagination pager copyright skip hidden contentinfo complementary".split()
)

#: Words of these attributes that mark content.
CONTENT = frozenset("article content main post story entry".split())

#: Elements whose end tag may be omitted, the start tags that end them, and elements within which those do not.
ENDED_BY = {
    "p": BLOCKS,
    "li": frozenset(["li"]),
    **dict.fromkeys(("dt", "dd"), frozenset("dt dd".split())),
    **dict.fromkeys(("td", "th"), frozenset("td th tr tbody thead tfoot".split())),
    "tr": frozenset("tr tbody thead tfoot".split()),
    **dict.fromkeys(("thead", "tbody", "tfoot"), frozenset("tbody tfoot".split())),
    "option": frozenset("option optgroup".split()),
}
SCOPES = frozenset("ul ol menu dl table select datalist".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
DIGITS = re.compile(r"\d+")
HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    found = HOST.match(url or "")
    return found.group(1).lower() if found else ""


class Block:
    __slots__ = ("parts", "linked", "chain")

    def __init__(self, chain: tuple):
        self.parts, self.linked, self.chain = [], 0, chain


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(raw)} if raw.strip() not in ("", "/") else {}


def _content(attributes: dict[str, str]) -> bool:
    """Whether class, id or role name an element as content."""
    return any(w in CONTENT for k in ("class", "id", "role") for name in attributes.get(k, "").split() for w in WORD.findall(CAMEL.sub("-", name).lower()))


def _furniture(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    if tag in DROPPED or tag == "header" and not inside:
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    if tag in ("html", "body"):
        return False
    said = " ".join(attributes.get(k, "") for k in ("class", "id", "role"))
    if not said.strip():
        return False
    words = {w for name in said.split() for w in WORD.findall(CAMEL.sub("-", name).lower())}
    if tag in ("article", "main") or words & CONTENT:
        return bool(words & {"comment", "comments", "ad", "ads", "advert", "sidebar", "related", "footer", "nav"})
    return bool(words & FURNITURE)


def blocks(html: str) -> list[tuple[str, int, tuple]]:
    """(text, length of its links' text, containers around it) of a page's blocks, furniture left out.

    A container is (number within the page, path)."""
    out: list[Block] = []
    stack: list[tuple[str, tuple, bool]] = []  # tag, chain, in article or main
    chain: tuple = ()
    block: Block | None = None
    number, links, at, end = 0, 0, 0, len(html)
    inside = False

    def add(raw: str) -> None:
        nonlocal block
        if not raw:
            return
        text = unescape(raw) if "&" in raw else raw
        if block is None:
            if text.isspace():
                return
            block = Block(chain)
            out.append(block)
        block.parts.append(text)
        if links:
            block.linked += len(text)

    def pop(k: int) -> None:
        nonlocal chain, inside, links, block
        for tag, held, was in reversed(stack[k:]):
            chain, inside = held, was
            if tag == "a":
                links = max(0, links - 1)
            if tag in BLOCKS:
                block = None
        del stack[k:]

    while at < end:
        found = TOKEN.search(html, at)
        if found is None:
            add(html[at:])
            break
        if found.start() > at:
            add(html[at : found.start()])
        at = found.end()
        name = found.group(2)
        if name is None:
            continue
        tag = name.lower()
        if found.group(1):  # end tag
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    pop(k)
                    break
            else:
                if tag in BLOCKS:
                    block = None
            continue
        raw = found.group(3)
        if tag == "br":
            add(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                block = None
            continue
        if tag in RAW:
            at = _after(html, at, tag, False) if not raw.endswith("/") or tag not in ("svg", "math") else at
            continue
        attributes = _attributes(raw)
        if _furniture(tag, attributes, inside):
            if tag in BLOCKS:
                block = None
            around = {t for t, _, _ in stack}
            behind = _after_implied(html, at, tag, around) if tag in ENDED_BY else _after(html, at, tag, True)
            at = behind if behind >= 0 else _broken_off(html, at, around)
            continue
        if tag in CLOSES_P:
            block = None
            if stack and tag not in ("html", "body"):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p" or tag in ("li", "tr", "td", "th", "dt", "dd", "option") and stack[k][0] == tag:
                        pop(k)
                        break
                    if stack[k][0] in CONTAINERS or stack[k][0] in ("ul", "ol", "dl", "table"):
                        break
        stack.append((tag, chain, inside))
        if tag == "a":
            links += 1
        if tag in CONTAINERS:
            number += 1
            label = " ".join(sorted(DIGITS.sub("#", attributes.get("class", "")).split()))
            above = chain[-1][1] if chain else ""
            chain = (*chain, (number, f"{above}/{tag}.{label}" if label else f"{above}/{tag}"))
            inside = inside or tag in ("article", "main") or _content(attributes)
    found_blocks = []
    for b in out:
        text = SPACE.sub(" ", "".join(b.parts)).strip()
        if text:
            found_blocks.append((text, min(b.linked, len(text)), b.chain))
    return found_blocks


def _after(html: str, at: int, tag: str, nested: bool) -> int:
    """Behind the end tag of an element whose content is left out."""
    depth = 1
    for found in re.compile(rf"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.S | re.I).finditer(html, at) if nested else re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).finditer(html, at):
        if not nested:
            return found.end()
        if found.group(2) is None:
            continue
        depth += -1 if found.group(2) else 1
        if depth == 0:
            return found.end()
    return -1 if nested else len(html)


def _broken_off(html: str, at: int, around: set[str]) -> int:
    """Where a left-out element that is never closed is taken to end."""
    for found in re.compile(r"<(/?)([a-z][a-z0-9]*)(?=[\s/>])", re.I).finditer(html, at):
        tag = found.group(2).lower()
        if found.group(1) and tag in around or not found.group(1) and tag in ("main", "article", "h1"):
            return found.start()
    return len(html)


def _after_implied(html: str, at: int, tag: str, around: set[str]) -> int:
    """The end of a left-out element whose end tag may be omitted: its end tag, the start of what ends it, or the end of an element around it."""
    inner: list[str] = []
    while (found := TOKEN.search(html, at)) is not None:
        at = found.end()
        name = (found.group(2) or "").lower()
        if not name:
            continue
        if found.group(1):
            if name in inner:
                while inner.pop() != name:
                    pass
            elif name == tag:
                return at
            elif name in around and (name in BLOCKS or name in SCOPES):
                return found.start()
        elif name in ENDED_BY[tag] and not SCOPES.intersection(inner):
            return found.start()
        elif name in RAW:
            at = _after(html, at, name, False) if not found.group(3).endswith("/") or name not in ("svg", "math") else at
        elif name in BLOCKS or name in SCOPES:
            inner.append(name)
    return len(html)


def path_id(path: str) -> int:
    return xxhash.xxh64_intdigest(path.encode("utf-8", "surrogatepass")) - (1 << 63)


def scores(found: list[tuple[str, int, tuple]]) -> dict[str, float]:
    """Path to the votes of a page: text without links, and half of it for the container around, credited to where the path belongs (_whole)."""
    own: dict[str, float] = {}
    below: dict[str, dict[str, float]] = {}  # path to its sections' and cells' text, all levels of them
    chains: dict[str, tuple[tuple[str, str], ...]] = {}  # path to (tag, path) of the containers around it and its own
    for text, linked, chain in found:
        worth = max(0, len(text) - 2 * linked)
        if chain and chain[-1][1] not in chains:
            line: tuple = ()
            for _, path in chain:
                line = (*line, (path[len(line[-1][1]) if line else 0 :][1:].split(".")[0], path))
                chains[path] = line
        if chain:
            own[chain[-1][1]] = own.get(chain[-1][1], 0.0) + worth
            for (_, above), (_, path) in zip(chain, chain[1:]):
                held = below.setdefault(above, {})
                held[path] = held.get(path, 0.0) + worth
    total: dict[str, float] = {}
    for path, worth in own.items():
        line = chains[path]
        for depth, share in ((1, 1.0), (2, 0.5)):
            if len(line) >= depth:
                target = _whole(line[: len(line) - depth + 1], own, below)
                total[target] = total.get(target, 0.0) + share * worth
    return total


def _whole(line: tuple[tuple[str, str], ...], own: dict[str, float], below: dict[str, dict[str, float]]) -> str:
    """The path that holds all of the text a container is a part of: the outermost article around it, else the main element; without
    either, its parent as long as that has text of its own or further sections or cells with text, the body excepted."""
    for kind in ("article", "main"):
        for tag, path in line:
            if tag == kind:
                return path
    k = len(line) - 1
    while k > 0 and line[k - 1][0] != "body":
        (tag, path), (_, above) = line[k], line[k - 1]
        further = any(worth > 0 for other, worth in below[above].items() if other != path and other[len(above) + 1 :].split(".")[0] == tag)
        if not own.get(above, 0.0) > 0 and not (tag in ("section", "td") and further):
            break
        k -= 1
    return line[k][1]


def main_text(html: str | None, winner: int | None) -> str:
    """A page's text by its host's winning path, or by its own best path."""
    found = blocks(html or "")
    chosen = [text for text, _, chain in found if winner is not None and any(path_id(p) == winner for _, p in chain)]
    if not chosen and found:
        own = scores(found)
        best = max(own.items(), key=lambda x: (x[1], x[0]))[0] if own else None
        chosen = [text for text, _, chain in found if best is None or any(p == best for _, p in chain)]
    return "\n\n".join(chosen)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, path, score) summed over a task's batch."""
    for batch in batches:
        total: dict[tuple[str, int], float] = {}
        for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            host = host_of(url)
            for path, score in scores(blocks(html or "")).items() if host else ():  # pages without a host have no consensus
                key = (host, path_id(path))
                total[key] = total.get(key, 0.0) + score
        yield pa.RecordBatch.from_pydict({"host": [k[0] for k in total], "path": pa.array([k[1] for k in total], pa.int64()), "score": pa.array(list(total.values()), pa.float64())})


def winners(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path): the path with the most votes of each host."""
    votes = pages.select(url, html).mapInArrow(_votes, "host string, path long, score double")
    total = votes.groupBy("host", "path").agg(F.sum("score").alias("score"))
    return checkpoint(total.groupBy("host").agg(F.max_by("path", F.struct("score", "path")).alias("path")))


def extract(pages: DataFrame, url: str = "url", html: str = "html", limit: int = BROADCAST_ROWS) -> DataFrame:
    """pages with text and n_chars. limit: hosts whose winning paths are broadcast; more are joined, with salted hot hosts."""
    h, won_host, path, salt, own_salt = private(pages, "h", "host", "path", "salt", "own_salt")
    won = winners(pages, url, html).select(F.col("host").alias(won_host), F.col("path").alias(path))

    @F.pandas_udf("string")
    def host(urls):
        return urls.map(host_of)

    @F.pandas_udf("string")
    def text(htmls, paths):
        return htmls.combine(paths, lambda h, p: main_text(h, None if p is None or p != p else int(p)))

    # the path travels as text: pandas would turn a long with nulls into a float
    won = won.withColumn(path, F.col(path).cast("string"))
    rows = pages.withColumn(h, host(F.col(url)))
    if won.count() <= limit:
        joined = rows.join(F.broadcast(won), F.col(h) == F.col(won_host), "left")
    else:
        salted = won.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn(own_salt, F.pmod(F.xxhash64(html), F.lit(SALTS)).cast("int"))
        joined = rows.join(salted, (F.col(h) == F.col(won_host)) & (F.col(own_salt) == F.col(salt)), "left").drop(salt, own_salt)
    found = joined.withColumn("text", text(F.col(html), F.col(path))).drop(h, won_host, path)
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
