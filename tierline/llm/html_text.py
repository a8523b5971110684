"""Main text of web pages by tree scoring.

A page becomes a tree, however badly it is closed. Scripts, menus, page headers, footers, sidebars,
notices, adverts, forms and comments are cut off by their element, role, or names in class and id.
Every paragraph passes points for its length and commas to the ancestors above it (all to the
parent, half to the next, then a third of half and so on), and a container's points are discounted by
its link density. The best container, or the article or main element around it, is kept with those siblings
that score a fifth of it, repeat its class or are paragraphs and headings of its own level.
Lists and boxes in it that hold little but links go.

Text is decoded, white space inside a block (``<br>`` too) becomes one space, and blocks are joined
in page order by an empty line. Null, empty and text-free pages give an empty text. If names alone
cut off everything, they are ignored. Every row is worked on by itself, so repeated rows give
repeated results; ``page_id``, ``url`` and ``html`` are read, other columns may have any name.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.names import col
from tierline.llm.common import query, read
from tierline.llm.hashing import slices

LEVELS = 5
LONG_PARAGRAPH, MOST_LENGTH_POINTS, NAMED = 25, 3.0, 25.0
SIBLING, LEAST_SIBLING = 0.2, 10.0
LINKS_ONLY, LINKED_SIBLING = 0.67, 0.25

# Elements of HTML by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = set("base link meta noscript script style template title".split())
PARAGRAPHS = set("p pre blockquote li dd td figcaption".split())
CLOSED_BY = {"li": ("li", {"ul", "ol", "menu", "dir"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}),
             "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "option": ("option", {"select"})}
NEVER = set(
    "applet aside audio button canvas datalist dialog embed footer form frame frameset head iframe input map math menu nav noframes noscript object "
    "script select style svg template textarea title video xmp".split()
)
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
# Names in class and id of what is no article, and of what is one.
COMMENT_NAMES = set(
    "comment comments commentlist kommentar kommentare commentaire commentaires comentario comentarios discussion disqus guestbook replies reply respond "
    "shoutbox".split()
)
OTHER_NAMES = COMMENT_NAMES | set(
    "ad ads adv advert advertisement advertisements adverts adsense advertorial banner breadcrumb breadcrumbs consent cookie cookies cookiebar copyright "
    "disclaimer feedback footer foot gdpr login masthead menu menubar modal nav navbar navi navigation newsletter notice notices notification outbrain "
    "overlay pager pagination paywall popup privacy promo promoted promotion recommended related rss search share sharebar sharing sidebar signup skip "
    "social sponsor sponsored sponsors subscribe subscription taboola toolbar topbar tracking warning widget widgets".split()
)
PAGE_HEADERS = set("header head".split())
ARTICLE_NAMES = set("article articlebody body content entry hentry main page post story text".split())
#: Headers with these names belong to the article.
ARTICLE_HEADERS = set("article entry hentry post story".split())
_NOT = set("has have no non not with without".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|style|hidden|aria-hidden|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?(?![\w-])""", re.I)
_PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_COMMAS = re.compile("[,،、，]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@lru_cache(maxsize=4096)
def _names(value: str) -> frozenset:
    """Parts of the names in a class or id, and the names without what parts them; ``with-sidebar`` and the like say nothing."""
    out = set()
    for name in value.split():
        parts = [p.lower() for p in _PART.findall(name)]
        if not _NOT & set(parts):
            out |= {*parts, "".join(parts)}
    return frozenset(out)


@dataclass(frozen=True)
class Look:
    """What an element's tag and attributes say: never text, names of other parts, a page header, an article."""

    never: bool
    other: bool
    comments: bool
    header: bool
    article: bool
    classes: str


@lru_cache(maxsize=4096)
def _look(tag: str, rest: str) -> Look:
    found = {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(rest)} if rest else {}
    role = found.get("role", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or bool(_HIDDEN.search(found.get("style", "")))
    names = _names(html.unescape(found.get("class", "") + " " + found.get("id", "")))
    whole = tag in ("html", "body", "main", "article") or role == "main"
    header = tag == "header" or (bool(names & PAGE_HEADERS) and not whole and not names & ARTICLE_HEADERS)
    article = whole or "articlebody" in found.get("itemprop", "").lower() or bool(names & ARTICLE_NAMES)
    page = tag in ("html", "body")
    return Look(
        tag in NEVER or ((role in ROLES or hidden) and not page), bool(names & OTHER_NAMES) and not page, bool(names & COMMENT_NAMES), header, article,
        found.get("class", ""),
    )


@dataclass
class Tree:
    """Elements in page order (0 is the page itself) and the tokens: openings, closings and text."""

    tag: list[str] = field(default_factory=lambda: ["html"])
    parent: list[int] = field(default_factory=lambda: [-1])
    rest: list[str] = field(default_factory=lambda: [""])
    # (element, text): text of the element; None opens it, False closes it, True is a line break.
    tokens: list[tuple] = field(default_factory=list)


def parse(page: str) -> Tree:
    """The tree of a page. What is not closed ends with what it lies in; a closing tag without an opening one is ignored."""
    tree = Tree()
    stack, open_tags = [0], Counter({"html": 1})
    tokens, tags = tree.tokens, tree.tag
    at, size = 0, len(page)
    low = None
    quotes_end = True

    def close(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            open_tags[tags[node]] -= 1
            tokens.append((node, False))

    def find(names, stops) -> int:
        """Depth of the innermost open element of ``names``, not looking beyond ``stops``."""
        if any(open_tags[n] for n in names):
            for depth in range(len(stack) - 1, 0, -1):
                tag = tags[stack[depth]]
                if tag in names:
                    return depth
                if tag in stops:
                    break
        return 0

    while at < size:
        lt = page.find("<", at)
        if lt != at:
            end = lt if lt >= 0 else size
            tokens.append((stack[-1], page[at:end]))
            if lt < 0:
                break
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = end + 3 if end >= 0 else size
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = end + 1 if end >= 0 else size
            continue
        match = _TAG.match(page, lt) if quotes_end else None
        if match is None:
            match = _LOOSE.match(page, lt)
            # A quote that never ends would be looked for again from every tag.
            quotes_end = quotes_end and match is None
        if match is None:
            # A tag cut off by the end of the page, or no tag at all.
            cut_off = page[lt + 1 : lt + 2].isalpha() or page.startswith("</", lt)
            if cut_off and page.find(">", lt) < 0:
                break
            tokens.append((stack[-1], "<"))
            at = lt + 1
            continue
        at = match.end()
        closing, tag, rest = match.group(1), match.group(2).lower(), match.group(3)
        if closing:
            depth = find((tag,), () if tag in BLOCKS and tag != "p" else BLOCKS - {tag})
            if depth:
                close(depth)
            elif tag == "br":
                tokens.append((stack[-1], True))
            continue
        if tag in ("html", "body"):
            if tag == "body":
                close(1)
            if tag == "html" or open_tags["body"]:
                continue
        if open_tags["head"] and tag not in IN_HEAD:
            close(find(("head",), ()) or len(stack))
        if tag in BLOCKS:
            depth = find(("p",), {"table", "td", "th", "button", "li", "blockquote", "div"})
            if depth:
                close(depth)
        if tag in CLOSED_BY:
            names, stops = CLOSED_BY[tag]
            names = names.split()
            while depth := find(names, stops):
                close(depth)
        if tag == "br":
            tokens.append((stack[-1], True))
            continue
        node = len(tags)
        tags.append(tag)
        tree.parent.append(stack[-1])
        tree.rest.append(rest)
        tokens.append((node, None))
        if tag in VOID or rest.endswith("/") and tag in ("svg", "math", "path", "iframe"):
            tokens.append((node, False))
        elif tag in RAW:
            low = low if low is not None else page.lower()
            end = low.find("</" + tag, at) if len(low) == size else _find_end(page, tag, at)
            tokens.append((node, False))
            if end < 0:
                break
            end = page.find(">", end)
            at = end + 1 if end >= 0 else size
        else:
            stack.append(node)
            open_tags[tag] += 1
    close(0)
    return tree


def _find_end(page: str, tag: str, at: int) -> int:
    """As a search in the lowered page, where lowering changes its length."""
    found = re.compile("</" + tag, re.I | re.A).search(page, at)
    return found.start() if found else -1


class Scored:
    """Lengths, link densities and points of the elements that are not cut off."""

    def __init__(self, tree: Tree, by_name: bool, forms: bool) -> None:
        self.tree = tree
        n = len(tree.tag)
        looks = [_look(tag, rest) for tag, rest in zip(tree.tag, tree.rest)]
        self.kept = [True] * n
        self.article = [look.article for look in looks]
        self.classes = [look.classes for look in looks]
        # A name on the element around all articles says nothing about them.
        holds = [tag in ("article", "main") and not look.other for tag, look in zip(tree.tag, looks)]
        articles = [int(x) for x in holds]
        for i in range(n - 1, 0, -1):
            articles[tree.parent[i]] += articles[i]
        around = [articles[0] > 0 and articles[i] == articles[0] and not looks[i].comments for i in range(n)]
        inside, linked, block = [False] * n, [False] * n, [0] * n
        for i, (tag, up) in enumerate(zip(tree.tag, tree.parent)):
            look = looks[i]
            never = look.never and not (tag == "form" and (forms or around[i]))
            inside[i] = up >= 0 and (inside[up] or tag in ("article", "main"))
            header = look.header and not inside[i] and (tag == "header" or by_name)
            cut = never or ((header or (look.other and by_name)) and not around[i])
            self.kept[i] = (up < 0 or self.kept[up]) and not cut
            linked[i] = (up >= 0 and linked[up]) or tag == "a"
            block[i] = i if tag in BLOCKS or up < 0 else block[up]
        self.length, self.links, self.points = [0] * n, [0] * n, [0.0] * n
        own, commas = [0] * n, [0] * n
        for node, text in tree.tokens:
            if isinstance(text, str) and self.kept[node]:
                size = len(text) if len(text) < 2 else len(" ".join(text.split()))
                own[block[node]] += size
                commas[block[node]] += len(_COMMAS.findall(text))
                self.length[node] += size
                self.links[node] += size if linked[node] else 0
        for i in range(n - 1, 0, -1):
            self.length[tree.parent[i]] += self.length[i]
            self.links[tree.parent[i]] += self.links[i]
        for i, (tag, up) in enumerate(zip(tree.tag, tree.parent)):
            if not own[i] or tag in HEADINGS:
                continue
            points = min(own[i] / 100, MOST_LENGTH_POINTS)
            if own[i] >= LONG_PARAGRAPH:
                points += 1 + commas[i]
            # Text that lies in a box itself makes the box a paragraph and a container.
            node, share = (up if tag in PARAGRAPHS else i), 1.0
            for level in range(LEVELS):
                if node < 0:
                    break
                self.points[node] += points * share
                node, share = tree.parent[node], 1 / 2 if level == 0 else 1 / (3 * (level + 1))

    def density(self, i: int) -> float:
        return self.links[i] / self.length[i] if self.length[i] else 0.0

    def score(self, i: int) -> float:
        if not self.points[i]:
            return 0.0
        named = NAMED if self.article[i] and self.tree.tag[i] not in ("html", "body") else 0.0
        return (self.points[i] + named) * (1 - self.density(i))

    def best(self) -> int | None:
        scores = [(self.score(i), -i) for i in range(len(self.kept)) if self.kept[i] and self.points[i]]
        top = max(scores, default=(0.0, 0))
        return -top[1] if top[0] > 0 else None

    def around(self, best: int) -> int:
        """The innermost article element around ``best``, else the main element, else itself."""
        for wanted in ("article", "main"):
            node = best
            while node > 0:
                if self.tree.tag[node] == wanted:
                    return node
                node = self.tree.parent[node]
        return best

    def roots(self) -> list[int]:
        """The container and the siblings that belong to it."""
        best = self.best()
        if best is None:
            return []
        node = self.around(best)
        tree, up = self.tree, self.tree.parent[node]
        if up < 0 or tree.tag[node] == "body":
            return [node]
        whole = tree.tag[node] in ("article", "main")
        first = max(LEAST_SIBLING, SIBLING * self.score(best))
        headed = any(tree.tag[i] == "h1" for i in self._below(node))
        out = []
        for i in range(up + 1, len(tree.tag)):
            if tree.parent[i] != up or not self.kept[i]:
                continue
            tag, density, size = tree.tag[i], self.density(i), self.length[i]
            bonus = SIBLING * self.score(best) if self.classes[i] and self.classes[i] == self.classes[node] else 0.0
            before = i < node and tag == "h1" and not headed
            if i == node or (not whole and self.score(i) + bonus >= first):
                out.append(i)
            elif tag in HEADINGS and density < LINKED_SIBLING and tree.tag[up] not in ("body", "html") and (before or not whole) or before and not density:
                out.append(i)
            elif not whole and tag in PARAGRAPHS and size and (density < LINKED_SIBLING if size >= 80 else not density):
                out.append(i)
        return out

    def _below(self, node: int) -> Iterator[int]:
        """Elements below ``node``: they follow it without a gap."""
        inside = {node}
        for i in range(node + 1, len(self.tree.tag)):
            if self.tree.parent[i] not in inside:
                break
            inside.add(i)
            yield i

    def blocks(self, roots: list[int]) -> list[str]:
        tree, wanted = self.tree, set(roots)
        n = len(tree.tag)
        take = [False] * n
        for i, (tag, up) in enumerate(zip(tree.tag, tree.parent)):
            mostly_links = tag in ("ul", "ol", "div", "section", "table", "dl") and self.density(i) > LINKS_ONLY and i not in wanted
            take[i] = self.kept[i] and not mostly_links and (i in wanted or (up >= 0 and take[up]))
        out, line = [], []
        for node, text in tree.tokens:
            if text is None or text is False:
                if tree.tag[node] in BLOCKS and line:
                    out.append("".join(line))
                    line = []
            elif take[node]:
                line.append(" " if text is True else html.unescape(text))
        out.append("".join(line))
        spaced = (" ".join(b.split()) for b in out)
        return [b for b in spaced if b]


def main_text(page: str | None) -> tuple[str, str, float]:
    """Main text of a page, the element that holds it and its score."""
    if not page:
        return "", "", 0.0
    tree = parse(page)
    # Names and forms may hold a whole page: then they say nothing about it.
    for by_name, forms in ((True, False), (False, False), (False, True)):
        scored = Scored(tree, by_name, forms)
        roots = scored.roots()
        blocks = scored.blocks(roots) if roots else []
        if blocks:
            best = scored.around(scored.best())
            return "\n\n".join(blocks), tree.tag[best], scored.score(best)
    return "", "", 0.0


def extract(pages: DataFrame) -> DataFrame:
    """Per page its url, main text (``text``), the element that holds it (``container``) and its score."""

    def read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts, containers, scores = zip(*(main_text(page.as_py()) for page in part.column(2)))
            found = [pa.array(texts, pa.string()), pa.array(containers, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *found], names=["page_id", "url", "text", "container", "score"])

    rows = pages.select(col("page_id").cast("long").alias("page_id"), col("url").cast("string").alias("url"), col("html").cast("string").alias("html"))
    return rows.mapInArrow(read_pages, "page_id long, url string, text string, container string, score double")


#: Holds for the pages of the test tables: one article of headings and paragraphs, and three kinds of references.
_SQL = r"""
WITH articles AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS a FROM pages),
blocks AS (
  SELECT page_id, url, list_transform(regexp_split_to_array(a, '</?(p|h1)>'), lambda b:
    trim(regexp_replace(replace(replace(regexp_replace(replace(regexp_replace(replace(b, '<br>', ' '), '<[^>]*>', '', 'g'),
      '&quot;', '"'), '&amp;?', chr(1), 'g'), '&lt;', '<'), chr(1), '&'), '\s+', ' ', 'g'))) AS b FROM articles)
SELECT page_id, url, array_to_string(list_filter(b, lambda x: x <> ''), chr(10) || chr(10)) AS text,
       length(array_to_string(list_filter(b, lambda x: x <> ''), chr(10) || chr(10)))::BIGINT AS n_chars
FROM blocks
"""


@query("op13_main_text", _SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
