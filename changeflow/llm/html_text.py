"""Main text of web pages by tree scoring.

A page becomes a tree of its elements. Every block of text passes points, for its length and its commas,
to its ancestors, fewer with distance. A container's points are discounted by
the share of its text that is in links. The best container is kept, with those of its siblings
that hold article text too; menus, notices and the like inside them are left out by element, role and name.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^'">]++|"[^"]*+"|'[^']*+')*+|[^>]*+)>|<[/!?a-zA-Z][^>]*\Z""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript xmp noembed noframes".split())
#: Searched in the page itself: lower-casing may change the length of a text.
RAW_END = {name: re.compile("</" + name, re.I | re.A) for name in RAW}
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s
 samp small span strike strong sub sup time tt u var wbr""".split())
#: Elements that are never article text.
DROPPED = frozenset("""nav footer aside form button select option input textarea dialog menu script style noscript
 template iframe svg canvas object embed audio video head title""".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog menu menubar toolbar form".split())
NAMES = re.compile(r"""(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|sidebar\w*|menu\w*|nav\w*|breadcrumbs?|footer\w*|header|masthead
|cookies?|notice|notification|consent|gdpr|popup|modal|overlay|newsletter|subscri\w*|signup|login|comments?|commentlist|disqus|respond|repl(?:y|ies)|social\w*
|shar(?:e|ing)\w*|related\w*|recommend\w*|widget|pagination|pager|toolbar|paywall|skip)(?:$|[\s_-])""", re.I | re.X)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: A start tag that ends an open paragraph, and the element that its kind ends.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("table td th ul ol dl div article section main aside blockquote body html nav form header footer".split())
WHOLE = frozenset(("article", "main"))
KEPT_NAMES = frozenset(("html", "body", "article", "main"))


def _dropped(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in DROPPED or tag == "header" and not in_article:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    found = {}
    for name, value in ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), value.strip("\"'"))
    if "hidden" in found or found.get("aria-hidden") == "true" or HIDDEN.search(found.get("style", "")):
        return True
    if found.get("role", "").lower() in ROLES:
        return True
    if tag == "article" and not in_article or tag == "main":
        return bool(re.search(r"\bcomments?\b", found.get("class", "") + " " + found.get("id", ""), re.I))
    return any(NAMES.search(found[k]) for k in ("class", "id") if k in found)


def main_text(page: str | None) -> str:
    """The article of a page: blocks in page order, one line each. Without any text, empty."""
    if not page:
        return ""
    tags, parents, junk = ["html"], [-1], [False]
    opened = [0]
    blocks: list[list] = []  # element, pieces, characters in links
    block = None
    links = articles = 0
    at, end = 0, len(page)

    def close(depth: int) -> None:
        nonlocal links, articles, block
        while len(opened) > depth:
            tag = tags[opened.pop()]
            links -= tag == "a"
            articles -= tag in WHOLE
            if tag not in INLINE:
                block = None

    while at < end:
        match = TOKEN.search(page, at)
        stop = match.start() if match else end
        if stop > at and not junk[opened[-1]]:
            piece = page[at:stop]
            if block is None and not piece.isspace():
                holder = opened[-1]
                while tags[holder] in INLINE:
                    holder = parents[holder]
                block = [holder, [], 0]
                blocks.append(block)
            if block is not None:
                block[1].append(piece)
                if links:
                    block[2] += len(piece.strip())
        if not match:
            break
        at = match.end()
        name = match[2]
        if name is None:
            continue
        name = name.lower()
        if match[1]:
            if name == "p" and not any(tags[i] == "p" for i in opened):
                block = None
            for depth in range(len(opened) - 1, 0, -1):
                tag = tags[opened[depth]]
                if tag == name:
                    close(depth)
                    break
                if tag in SCOPE and (name in INLINE or name in ("p", "li", "td", "th", "tr")):
                    break
            if name not in INLINE:
                block = None
            continue
        if name not in INLINE:
            block = None
            for depth in range(len(opened) - 1, 0, -1):
                tag = tags[opened[depth]]
                if tag == "p":
                    close(depth)
                    break
                if tag in SCOPE:
                    break
            for depth in range(len(opened) - 1, 0, -1):
                tag = tags[opened[depth]]
                if tag in CLOSES.get(name, ()):
                    close(depth)
                    break
                if tag in SCOPE - {"td", "th"} or tag in ("td", "th") and name in ("li", "dt", "dd"):
                    break
        elif name == "br" and block is not None:
            block[1].append(" ")
        if name in VOID:
            continue
        if name in RAW:
            raw_end = RAW_END[name].search(page, at)
            if raw_end is None:
                break
            close_at = page.find(">", raw_end.end())
            at = close_at + 1 if close_at >= 0 else end
            continue
        if match[3].endswith("/") and name not in INLINE | SCOPE | {"p"}:
            continue
        tags.append(name)
        parents.append(opened[-1])
        junk.append(junk[opened[-1]] or _dropped(name, match[3], articles > 0))
        opened.append(len(tags) - 1)
        links += name == "a"
        articles += name in WHOLE

    lines = []
    for element, pieces, linked in blocks:
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            lines.append((element, text, linked))
    if not lines:
        return ""
    kept = _kept(tags, parents, lines)
    return "\n".join(text for element, text, _ in lines if element in kept)


def _kept(tags: list[str], parents: list[int], lines: list[tuple[int, str, int]]) -> set[int]:
    """The elements under the best container and the siblings that go with it."""
    points, chars, linked = ([0.0] * len(tags) for _ in range(3))
    for element, text, in_links in lines:
        score = 1 + text.count(",") + min(len(text) / 100, 3)
        container = element if tags[element] in SCOPE else parents[element]
        step, node = 1, max(container, 0)
        while node >= 0:
            points[node] += score / step if step < 3 else score / (3 * step)
            step, node = step + 1, parents[node]
        node = element
        while node >= 0:
            chars[node] += len(text)
            linked[node] += min(in_links, len(text))
            node = parents[node]
    worth = [p * (1 - l / c) if c else 0.0 for p, c, l in zip(points, chars, linked)]
    best = max(range(len(tags)), key=lambda i: (worth[i], -i))
    node = best
    while node > 0:  # a part of an article stands for the whole
        node = parents[node]
        if tags[node] in WHOLE:
            best = node
    roots = {best}
    if best > 0:
        for i in range(1, len(tags)):
            if i != best and parents[i] == parents[best] and chars[i]:
                density = linked[i] / chars[i]
                if worth[i] >= max(10.0, 0.2 * worth[best]) or tags[i] == "p" and chars[i] > 80 and density < 0.25 \
                        or tags[i] in ("h1", "h2", "p") and i < best and density == 0:
                    roots.add(i)
    kept: set[int] = set()
    for i in range(len(tags)):
        if i in roots or parents[i] in kept:
            kept.add(i)
    return kept


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch["html"].to_pylist()]
        yield pa.RecordBatch.from_pydict({
            "page_id": batch["page_id"], "url": batch["url"], "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64())})


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    Null and empty html, and pages without text, give an empty text; null ids and urls and
    repeated rows stay; broken markup is read as far as it goes; other columns are ignored;
    an empty table gives no rows.
    """
    fields = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = f"page_id {fields['page_id']}, url {fields['url']}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(_extract, schema)
