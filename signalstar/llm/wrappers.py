"""Main text of web pages by wrappers inferred from pages of the same host."""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalstar.llm.common import body, stored
from signalstar.llm.url_trees import host

# --- pages as nested token streams ---------------------------------------------------

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)"
    # A quote begins a value only after an equals sign; else it is a character like others.
    r"((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?|[\"'])*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?i)\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_NAME = re.compile(r"[a-z]+(?:-+[a-z]+)*")
DEPTH = 150  # elements nested deeper stand beside each other at this depth

RAW = {"script", "style", "textarea", "xmp", "iframe", "noscript", "template", "title", "svg", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
    "h6", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre",
    "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
# What ends an element that was left open.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"},
}
SCOPE = {"ul", "ol", "dl", "table", "select", "menu"}

# Parts that are never main text, by element and by the names in class, id and role.
SIDE_TAGS = {
    "head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "canvas",
    "audio", "video", "map", "input", "fieldset", "datalist",
} | RAW
SIDE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "banner",
    "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo",
    "cookie", "cookies", "disqus", "footer", "gdpr", "login", "menu", "modal", "nav", "navbar",
    "navigation", "newsletter", "notice", "notices", "overlay", "pager", "pagination", "popup",
    "promo", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar",
    "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar",
    "widget",
}
COMMENT_WORDS = {"comment", "comments", "replies", "reply", "disqus", "respond"}
HEADER_WORDS = {"header", "masthead", "topbar"}
# Words that a name of a side part may have besides, as in ad-slot or post-comments.
PLAIN_WORDS = {
    "area", "article", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons",
    "container", "content", "form", "global", "group", "header", "icons", "inner", "item", "items",
    "left", "links", "list", "main", "outer", "page", "panel", "post", "posts", "primary", "reader",
    "right", "row", "secondary", "section", "site", "slot", "stories", "thread", "top", "unit",
    "user", "users", "wrap", "wrapper",
}
# First words of a name that says what a page has beside it, as in has-sidebar.
LAYOUT_WORDS = {"has", "with", "without", "no"}
# Words of an id that may name a place of a template; other ids belong to one page.
PLACE_WORDS = SIDE_WORDS | HEADER_WORDS | PLAIN_WORDS


def _names(text: str) -> set[str]:
    """The whole names in an attribute, in lower case and without digits."""
    return {n for part in text.lower().replace("_", "-").split() for n in _NAME.findall(part)}


class Element:
    """A tag with its children and names; ``label`` is the tag and the names that a template
    may have given it."""

    __slots__ = ("tag", "label", "names", "kids")

    def __init__(self, tag: str, attributes: str = ""):
        names: set[str] = set()
        lasting: set[str] = set()
        if attributes:
            for m in _ATTRIBUTE.finditer(attributes):
                found = _names(entities.unescape(m[2] or m[3] or m[4] or ""))
                names |= found
                if m[1].lower() == "id":
                    found = {n for n in found if PLACE_WORDS.issuperset(n.split("-"))}
                lasting |= found
        self.tag, self.names = tag, names
        self.label = ".".join([tag, *sorted(lasting)])
        self.kids: list[Element | str] = []


def parse(page: str) -> Element:
    """The page as nested elements; left-open elements end where browsers end them.

    Takes time in proportion to the page, whatever is in it. Elements nested deeper than
    ``DEPTH`` become neighbours, but what is in a side part stays in it.
    """
    root = Element("")
    stack, at = [root], 0
    passed: dict[str, int] = {}  # deep elements by tag whose end is still to come

    def text(until: int) -> None:
        if until > at:
            stack[-1].kids.append(page[at:until])

    position, last = 0, page.rfind(">") + 1
    while True:
        m = _TOKEN.search(page, position, last)
        if m is None:
            break
        text(m.start())
        position = at = m.end()
        if m[2] is None:
            opening = m[0][:4]
            if opening == "<!--" and not (m[0].endswith("-->") and len(m[0]) > 6) or (
                opening == "<![C" and not m[0].endswith("]]>")
            ):
                position = at = len(page)  # one that is not closed goes on to the end
            continue
        tag = m[2].lower()
        if m[1]:
            if passed.get(tag):
                passed[tag] -= 1
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        if tag in BLOCK:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    del stack[depth:]
                    break
                if stack[depth].tag in BLOCK:
                    break
        for depth in range(len(stack) - 1, 0, -1):
            if tag in CLOSED_BY.get(stack[depth].tag, ()):
                del stack[depth:]
                break
            if stack[depth].tag in SCOPE:
                break
        element = Element(tag, m[3])
        opened = tag not in RAW and tag not in VOID and not m[3].endswith("/")
        if len(stack) > DEPTH and opened:
            passed[stack[-1].tag] = passed.get(stack[-1].tag, 0) + 1
            if is_side(stack[-1].tag, stack[-1].names, True):
                passed[stack[-1].tag] -= 1
                passed[tag] = passed.get(tag, 0) + 1
                continue
            stack.pop()
        stack[-1].kids.append(element)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, position)
            position = at = end.end() if end else len(page)
        elif opened:
            stack.append(element)
    text(len(page))
    return root


def _is_side_name(name: str) -> bool:
    """Whether a whole name is that of a side part: no word in it says anything else."""
    words = name.split("-")
    return not SIDE_WORDS.isdisjoint(words) and (SIDE_WORDS | PLAIN_WORDS).issuperset(words)


def is_side(tag: str, names: set[str], in_article: bool) -> bool:
    """Whether an element is a part that is never main text.

    Inside an article only its tag or a whole name says so. Outside, where nothing else tells
    parts of a page apart, a word in a name is enough.
    """
    if tag in SIDE_TAGS:
        return True
    if tag in ("html", "body", "main"):
        return False
    if tag == "article":
        return any(COMMENT_WORDS.intersection(n.split("-")) and _is_side_name(n) for n in names)
    if any(_is_side_name(n) for n in names):
        return True
    if in_article:
        return False
    words = {w for n in names for w in n.split("-") if n.split("-")[0] not in LAYOUT_WORDS}
    return tag == "header" or not words.isdisjoint(SIDE_WORDS | HEADER_WORDS)


# --- wrappers ------------------------------------------------------------------------
#
# A wrapper node stands for all elements seen at one place: n elements, the text mass of its
# slots, and its children as a union-free expression. The expression is a list of groups; a
# group lists the labels that take turns there, each of them in one group only. One label
# that comes once is plain, one that repeats is (a)+, several that take turns are
# (a? b? c?)+. A child that some element lacks is optional. Text is a constant until two
# pages differ there; then it is a slot.

TEXT = "#"


SHOWN = 64  # characters of a constant that an expression shows


def _constant(text: str) -> str:
    """A text as it is compared: a longer one by its beginning, length and hash."""
    if len(text) <= SHOWN:
        return text
    digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
    return f"{text[:SHOWN]}… {len(text)} {digest}"


def _leaf(text: str) -> dict:
    return {"n": 1, "in": 1, "many": False, "const": _constant(text), "mass": len(text), "groups": [], "kids": {}}


def fold(element: Element) -> dict:
    """The wrapper of a single element, with repeats among its children folded."""
    node = {"n": 1, "in": 1, "many": False, "const": None, "mass": 0, "groups": [], "kids": {}}
    spans: dict[str, list[int]] = {}
    for i, kid in enumerate(element.kids):
        if isinstance(kid, str):
            words = " ".join(kid.split())
            if not words:
                continue
            label, made = TEXT, _leaf(words)
        else:
            label, made = kid.label, fold(kid)
        if label in spans:
            spans[label][1] = i
            node["kids"][label] = align(node["kids"][label], made)
            node["kids"][label].update({"in": 1, "many": True})
        else:
            spans[label] = [i, i]
            node["kids"][label] = made
    ends = -1
    for label, (first, last) in sorted(spans.items(), key=lambda s: s[1][0]):
        if first <= ends:
            node["groups"][-1].append(label)
        else:
            node["groups"].append([label])
        ends = max(ends, last)
    return node


def align(a: dict, b: dict) -> dict:
    """The wrapper that fits all that either fits.

    Mismatched text becomes a slot. Children are aligned by label; groups that share labels,
    or whose order disagrees, become one repeated group, and a child missing on one side
    becomes optional, which its count ``in`` below the parent's ``n`` tells.
    """
    kids = dict(a["kids"])
    for label, kid in b["kids"].items():
        if label in kids:
            both = align(kids[label], kid)
            both["in"] = kids[label]["in"] + kid["in"]
            both["many"] = kids[label]["many"] or kid["many"]
            kids[label] = both
        else:
            kids[label] = kid
    return {
        "n": a["n"] + b["n"], "in": a["in"], "many": a["many"] or b["many"],
        "const": a["const"] if a["const"] == b["const"] else None,
        "mass": a["mass"] + b["mass"], "groups": _align_groups(a["groups"], b["groups"]), "kids": kids,
    }


def _align_groups(a: list[list[str]], b: list[list[str]]) -> list[list[str]]:
    if a == b:
        return a
    groups = [list(g) for g in a]
    at = 0  # where the next group of b may go
    for new in b:
        shared = [i for i, g in enumerate(groups) if not set(g).isdisjoint(new)]
        if not shared:
            groups.insert(at, list(new))
            at += 1
            continue
        low, high = min(shared[0], at - 1 if shared[0] < at else shared[0]), max(shared[-1], at - 1)
        if shared[0] >= at:
            high = shared[-1]
        merged = list(dict.fromkeys([x for g in groups[low : high + 1] for x in g] + new))
        groups[low : high + 1] = [merged]
        at = low + 1
    return groups


def expression(node: dict) -> str:
    """The wrapper as a union-free regular expression over tags, text and slots."""
    parts = []
    for group in node["groups"]:
        items = []
        for label in group:
            kid = node["kids"][label]
            if label == TEXT:
                item = "#PCDATA" if kid["const"] is None else json.dumps(kid["const"], ensure_ascii=False)
            else:
                inner = expression(kid)
                item = f"<{label}>{' ' + inner + ' ' if inner else ''}</>"
            optional = kid["in"] < node["n"] or len(group) > 1
            if len(group) == 1 and kid["many"]:
                item = f"({item})" + ("*" if optional else "+")
            elif optional:
                item = f"({item})?"
            items.append(item)
        parts.append(items[0] if len(items) == 1 else f"({' '.join(items)})+")
    return " ".join(parts)


def _side_label(label: str, in_article: bool) -> bool:
    tag, *names = label.split(".")
    return is_side(tag, set(names), in_article)


def _slot_mass(node: dict, in_article: bool = False) -> int:
    """Characters in slots below a node, side parts aside; a single page's text is all slots."""
    total = 0
    for label, kid in node["kids"].items():
        if label == TEXT:
            total += kid["mass"] if kid["const"] is None or kid["n"] == 1 else 0
        elif not _side_label(label, in_article):
            total += _slot_mass(kid, in_article or label.split(".")[0] == "article")
    return total


def main_paths(node: dict) -> list[list[str]]:
    """Where the main text is: articles, else main elements, else where most slots are."""
    for wanted in ("article", "main"):
        found: list[list[str]] = []

        def walk(at: dict, path: list[str]) -> None:
            for label, kid in sorted(at["kids"].items()):
                if label == TEXT or _side_label(label, False):
                    continue
                tag, *names = label.split(".")
                if tag == wanted or wanted == "main" and any("main" in n.split("-") for n in names):
                    found.append([*path, label])
                else:
                    walk(kid, [*path, label])

        walk(node, [])
        if found:
            return found
    path: list[str] = []
    while True:
        masses = {
            label: _slot_mass(kid) for label, kid in node["kids"].items()
            if label != TEXT and not _side_label(label, False) and label.split(".")[0] in BLOCK
            and (label.split(".")[0] not in ("p", "li", "td", "pre") )
        }
        total = _slot_mass(node)
        best = max(sorted(masses), key=masses.get, default=None)
        if best is None or not total or masses[best] < 0.6 * total or node["kids"][best]["many"]:
            return [path]
        path.append(best)
        node = node["kids"][best]


# --- extraction ----------------------------------------------------------------------


def _selected(element: Element, path: list[str]) -> list[Element]:
    at = [element]
    for label in path:
        at = [kid for e in at for kid in e.kids if isinstance(kid, Element) and kid.label == label]
    return at


def text_of(page: str, paths: list[list[str]] | None) -> str:
    """Blocks of the page's main parts, in page order."""
    root = parse(page)
    chosen = {id(e) for path in paths or [] for e in _selected(root, path)}
    if not chosen:
        chosen = {id(e) for path in main_paths(fold(root)) for e in _selected(root, path)}
    blocks: list[str] = []
    now: list[str] = []

    def flush() -> None:
        words = " ".join("".join(now).split())
        now.clear()
        if words:
            blocks.append(words)

    def walk(element: Element, inside: bool, in_article: bool) -> None:
        inside = inside or id(element) in chosen
        # The body as a whole is no article: a header in it is that of the site.
        chosen_part = inside and element.tag not in ("", "html", "body")
        in_article = in_article or chosen_part or element.tag == "article"
        for kid in element.kids:
            if isinstance(kid, str):
                if inside:
                    now.append(entities.unescape(kid))
            elif kid.tag == "br":
                now.append(" ")
            elif is_side(kid.tag, kid.names, in_article):
                now.append(" ")
            elif kid.tag in BLOCK:
                flush()
                walk(kid, inside, in_article)
                flush()
            else:
                walk(kid, inside, in_article)

    walk(root, False, False)
    flush()
    return "\n\n".join(blocks)


# --- Spark ---------------------------------------------------------------------------

SALTS = 64


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per host and task: pages are aligned as they come."""
    made: dict[str, dict] = {}
    for batch in batches:
        for name, page in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = fold(parse(page.as_py()))
            made[name] = align(made[name], own) if name in made else own
    names = sorted(made)
    texts = [json.dumps(made[n], ensure_ascii=False, separators=(",", ":")) for n in names]
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["host", "wrapper"]
    )


def _joined(frame: pd.DataFrame) -> pd.DataFrame:
    total = None
    for text in sorted(frame["wrapper"]):
        node = json.loads(text)
        total = node if total is None else align(total, node)
    text = json.dumps(total, ensure_ascii=False, separators=(",", ":"))
    return pd.DataFrame({"host": [frame["host"].iloc[0]], "wrapper": [text]})


def host_wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, wrapper): for each host, the expression that all its pages fit, as JSON.

    Every task aligns its own pages; the tasks' wrappers are aligned by host in two levels,
    so that a host with very many pages never meets in one task. A wrapper grows with the
    variety of a host's markup, not with its pages.
    """
    rows = pages.select(host(url).alias("host"), body(html).alias("html"))
    partial = rows.mapInArrow(_partial, "host string, wrapper string")
    salt = F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))
    some = partial.groupBy("host", salt.alias("salt")).applyInPandas(
        lambda frame: _joined(frame), "host string, wrapper string"
    )
    return some.groupBy("host").applyInPandas(
        lambda frame: _joined(frame), "host string, wrapper string"
    )


def wrapper_expression(wrapper: str) -> Column:
    """The stored wrapper as a readable union-free expression."""
    return F.udf(lambda text: expression(json.loads(text)), "string")(wrapper)


def main_text(
    pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    The host's wrapper says where the main text is: in its articles, else its main element,
    else in the part with most of the text that differs between pages. A page that lacks
    those places is judged by its own wrapper. Menus, headers, footers, side bars, notices,
    adverts, forms, scripts, styles and comments are left out wherever they stand: by element,
    and in the main part only by a whole name of class, id or role that has no other meaning.
    A header is left out unless it is inside the main part, the body not being one. Pages
    may be nested, cut or quoted in any way; elements more than 150 deep count as neighbours. Character
    references are decoded, white space in a block becomes one space, blocks are joined by an
    empty line. Null and empty pages give an empty text; a null url is of the empty host;
    equal rows give equal rows; other columns are not read.
    """

    @F.pandas_udf("string")
    def places(wrappers: pd.Series) -> pd.Series:
        return wrappers.map(lambda w: json.dumps(main_paths(json.loads(w))))

    where = stored(
        host_wrappers(pages, url, html).select(
            F.col("host").alias("__host"), places("wrapper").alias("places")
        ),
        "wrapper-places",
    )

    @F.pandas_udf("string")
    def extract(page: pd.Series, places: pd.Series) -> pd.Series:
        read: dict[str | None, list | None] = {None: None}
        out = []
        for text, place in zip(page, places):
            if place not in read:
                read[place] = json.loads(place)
            out.append(text_of(text, read[place]))
        return pd.Series(out, dtype=object)

    rows = pages.select(
        F.col(id).alias("page_id"), F.col(url).alias("url"), body(html).alias("html"),
        host(url).alias("host"),
    )
    # Hosts are few against pages: the join is a broadcast while they are small, and else
    # splits the pages of a hot host.
    joined = rows.join(where, F.col("host") == F.col("__host"), "left")
    texts = joined.select("page_id", "url", extract("html", "places").alias("text"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
