"""Main text of web pages by tree scoring.

A page is cut into tags and text and built into a tree of elements.  Menus,
headers, footers, sidebars, notices, adverts, forms, scripts and comments are
taken out by element, role, class or id.  Every paragraph that is left earns
points for its length and its commas, discounted by the share of its text that
is link text; it passes them to the element that holds it, half of them to the
next ancestor, and so on.  The element with the most points is the container,
widened to the article around it, and siblings that look like it are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements without content, and elements whose content is not markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
#: Elements that stand inside a line of text; every other element starts and ends a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr br td th".split())
#: Elements that a start tag of the named ones closes, and the elements that stop the search for them.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
          "option": ({"option"}, {"select"}),
          "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "tfoot": ({"tr", "td", "th", "thead", "tbody"}, {"table"})}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are never part of the text.
DROPPED = frozenset("nav footer aside form button select input dialog menu script style textarea title noscript iframe xmp noembed "
                    "noframes template head svg math object canvas audio video map".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words of a class or id that name parts beside the article.
BESIDE = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent "
                   "cookie cookies disclaimer disqus footer gdpr header hidden login masthead menu modal nav navbar navigation newsletter "
                   "notice notices pager paginate pagination popup promo promotion recommended related replies reply respond search share "
                   "sharing sidebar signin signup skip social sponsor sponsored subscribe toolbar widget widgets".split())
NOT = frozenset("has no with without".split())
COMMENT = frozenset("comment comments commentlist disqus reply replies respond".split())
CONTAINERS = frozenset("article main section div body html td blockquote center figure details".split())
KEPT_SIBLINGS = frozenset("p pre blockquote ul ol dl table figure h1 h2 h3 h4 h5 h6".split())
#: A sibling of the container is kept from this share of its points on.
SIBLING_SHARE = 0.2
#: A list or box inside the container goes if more of its text than this is link text.
LINK_LIMIT = 0.5

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
                    r"|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(?:^|[\s/\"'])(class|id|role|hidden|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/>]|$)", re.I)
_WORDS = re.compile(r"[a-z0-9]+")


def tree(html: str) -> tuple[list[int], list[str], list[str], list[list]]:
    """parent, tag, attributes and content of each element, root first.

    The content lists texts and numbers of child elements in order.  Tags that
    are not closed end with their parent, end tags without a start tag only
    part the text around them.
    """
    parent, tags, attrs, content = [-1], ["html"], [""], [[]]
    stack, open_tags, at, n = [0], {"html": 1}, 0, len(html)

    def close(until: int) -> None:
        while len(stack) > until:
            open_tags[tags[stack.pop()]] -= 1

    def find(names: set[str], stops: set[str]) -> int:
        """Place of the outermost open element of names above the last stop, or 0."""
        found = 0
        for k in range(len(stack) - 1, 0, -1):
            if tags[stack[k]] in stops:
                break
            if tags[stack[k]] in names:
                found = k
        return found

    while at < n:
        mark = html.find("<", at)
        if mark < 0:
            mark = n
        if mark > at:
            content[stack[-1]].append(html[at:mark])
        if mark == n:
            break
        m = _TOKEN.match(html, mark)
        if not m:
            content[stack[-1]].append("<")
            at = mark + 1
            continue
        at = m.end()
        if m["end"]:
            tag = m["end"].lower()
            if open_tags.get(tag) and tag != "html":
                k = len(stack) - 1
                while tags[stack[k]] != tag:
                    k -= 1
                close(k)
            elif tag not in INLINE:
                content[stack[-1]].append(None)
            continue
        if not m["start"]:
            continue
        tag = m["start"].lower()
        if tag == "html":
            attrs[0] += m["attrs"]
            continue
        if tag not in INLINE and open_tags.get("p") and (k := find({"p"}, CONTAINERS)):
            close(k)
        if tag in CLOSES and any(open_tags.get(t) for t in CLOSES[tag][0]) and (k := find(*CLOSES[tag])):
            close(k)
        node = len(parent)
        parent.append(stack[-1])
        tags.append(tag)
        attrs.append(m["attrs"])
        content.append([])
        content[stack[-1]].append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = end.start() if end else n
            if end:
                close_mark = html.find(">", at)
                at = n if close_mark < 0 else close_mark + 1
        elif tag not in VOID and not m["attrs"].endswith("/"):
            stack.append(node)
            open_tags[tag] = open_tags.get(tag, 0) + 1
    return parent, tags, attrs, content


def beside(tag: str, attrs: str) -> bool:
    """Whether an element's class, id, role or hidden attribute puts it beside the article."""
    if not attrs or tag in ("html", "body", "main"):
        return False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "role" and value in ROLES):
            return True
        if name in ("class", "id"):
            for one in value.split():
                words = _WORDS.findall(one)
                names = COMMENT if tag == "article" else BESIDE
                if any(w in names and not (i and words[i - 1] in NOT) for i, w in enumerate(words)):
                    return True
    return False


def main_text(html: str | None) -> str:
    """The main text of one page; empty if it has none.

    Character references are decoded, white space (Unicode's) inside a block
    becomes one space, blocks are joined by a line end in page order.  A line
    break and the border of two table cells count as white space.  If nothing
    is left without the parts named by class or id, they are let in again.
    """
    if not html:
        return ""
    parent, tags, attrs, content = tree(html)
    for named in (True, False):
        text = "\n".join(_extract(parent, tags, attrs, content, named))
        if text:
            return text
    return ""


def _extract(parent: list[int], tags: list[str], attrs: list[str], content: list[list], named: bool) -> list[str]:
    n = len(parent)
    out, link, article = [False] * n, [False] * n, [-1] * n
    for v in range(n):  # parents come before children
        p, tag = parent[v], tags[v]
        if p >= 0:
            link[v], article[v] = link[p] or tag == "a", article[p]
        out[v] = (p >= 0 and out[p]) or tag in DROPPED or (tag == "header" and article[v] < 0) or (named and beside(tag, attrs[v]))
        if tag in ("article", "main") and (article[v] < 0 or tag == "article"):
            article[v] = v

    # Characters, commas and link characters of each block's own text, then of whole subtrees.
    block = [0] * n
    own, commas, linked = [0] * n, [0] * n, [0] * n
    for v in range(n):
        block[v] = v if tags[v] not in INLINE or parent[v] < 0 or tags[v] in ("td", "th") else block[parent[v]]
        if out[v]:
            continue
        b = block[v]
        for c in content[v]:
            if isinstance(c, str):
                size = len(" ".join(c.split()))
                own[b] += size
                commas[b] += sum(map(c.count, ",،、，"))
                linked[b] += size if link[v] else 0
    total, links, score, passed = own[:], linked[:], [0.0] * n, [0.0] * n
    for v in range(n - 1, -1, -1):
        if own[v] and not out[v]:
            points = (1 + commas[v] + own[v] / 100) * (1 - linked[v] / own[v])
            if tags[v] in CONTAINERS:
                score[v] += points
            else:
                passed[v] += points
        p = parent[v]
        if p >= 0:
            total[p] += total[v]
            links[p] += links[v]
            mine = passed[v] + score[v] / 2 if tags[v] in CONTAINERS else passed[v] + score[v]
            if tags[p] in CONTAINERS:
                score[p] += mine
            else:
                passed[p] += mine

    best, top = 0, 0.0
    for v in range(n):
        if tags[v] in CONTAINERS and not out[v] and total[v]:
            points = score[v] * (1 - links[v] / total[v])
            if points > top:
                best, top = v, points
    if not top:
        return []
    kept = [best]
    if article[best] >= 0:
        kept = [article[best]]
    elif parent[best] >= 0:
        same = (tags[best], attrs[best].strip())
        kept = []
        for c in content[parent[best]]:
            if c == best or (isinstance(c, int) and not out[c] and total[c] and links[c] / total[c] < LINK_LIMIT and (
                    tags[c] in KEPT_SIBLINGS or score[c] * (1 - links[c] / total[c]) >= SIBLING_SHARE * top
                    or (same[1] and (tags[c], attrs[c].strip()) == same))):
                kept.append(c)

    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join(unescape("".join(line)).split())
        if text:
            blocks.append(text)
        line.clear()

    for start in kept:
        walk = [(start, iter(content[start]))]
        while walk:
            v, rest = walk[-1]
            c = next(rest, False)
            if c is False:
                walk.pop()
                if tags[v] in ("td", "th"):
                    line.append(" ")
                elif tags[v] not in INLINE:
                    flush()
            elif c is None:
                flush()
            elif isinstance(c, str):
                line.append(c)
            elif tags[c] in ("br", "img", "wbr"):
                line.append(" " if tags[c] == "br" else "")
            elif not out[c] and not (tags[c] in ("ul", "ol", "dl", "div", "section", "table") and total[c]
                                     and links[c] / total[c] > LINK_LIMIT):
                if tags[c] not in INLINE:
                    flush()
                walk.append((c, iter(content[c])))
        flush()
    return blocks


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages.

    Null html counts as empty and gives an empty text; null ids and repeated
    rows stay as they are, an empty table gives none.  Only the three columns
    named are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "text", "n_chars"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64()]
        for b in batches:
            for at in range(0, b.num_rows, 256):  # bounds what is decoded at once
                part = b.slice(at, 256)
                texts = [main_text(x) for x in part.column(2).to_pylist()]
                columns = [part.column(0), part.column(1), pa.array(texts, kinds[2]), pa.array(map(len, texts), kinds[3])]
                yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, kinds)], names)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
