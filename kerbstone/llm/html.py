"""Main text of web pages by template deduction over equivalence classes.

A page is a sequence of tokens: the paths of its elements and its text nodes.
Over the pages of a host a token has an occurrence vector, how often each page
has it. Tokens with one vector are an equivalence class; classes that hold on
most pages are the host's template, and nest by the pages they hold on. A token
that has no fixed place in its class's order, or whose class has none between the
tokens of the class that holds on most pages, is no template. What lies between
template tokens are slots. Slots under the template's menus,
adverts and the like are dropped, the others are the page's text. In an article
a text that repeats is content, but a template element with nothing but links
that repeat is a menu there too.

A vector is never gathered: its sums of hashes over the pages stand for it, so
the tokens of a host with a third of all pages are reduced where they are read.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstone.llm.batches import with_text_columns
from kerbstone.plans.cut import cut
from kerbstone.plans.skew import lookup_join

#: A template token is on at least this share of its host's pages ...
SHARE = 0.5
#: ... among them so many different ones.
MIN_PAGES = 4
#: A text node of more characters is content, never a template token.
TOKEN_CHARS = 200
#: A slot outside any article is a menu if this share of its text is links.
LINK_SHARE = 0.5
#: A template element in an article is a menu if it has so many links of the template and no other text.
MENU_LINKS = 2

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)",
    re.S,
)
NAMED = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"

# Fixed values of HTML and of common page furniture.
RAW = frozenset("script style textarea title template iframe svg select annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
CLOSES = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"},
          "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}}
FURNITURE = frozenset("nav footer aside button menu dialog".split())
MAIN = frozenset("article main".split())
#: Elements that no name makes furniture.
NEVER = frozenset("html body main".split())
#: Names that make a block furniture where they are a whole class, id or role ...
NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies "
    "complementary contentinfo disqus footer legal masthead menu modal nav navbar navigation newsletter "
    "notice popup promo related reply replies search share sharing sidebar social sponsor sponsored "
    "subscribe toolbar topbar widget".split()
)
#: ... and those that also do as the first or last word of one, unless its first word is one of NOT.
WORDS = NAMES - frozenset("complementary contentinfo legal modal related reply replies search share sharing".split())
NOT = frozenset("no not has with without".split())


def names_of(attributes: str) -> list[str]:
    return [(a or b or c).lower() for _, a, b, c in NAMED.findall(attributes)]


def is_furniture_name(name: str) -> bool:
    if name in NAMES:
        return True
    words = [w for w in re.split(r"[^a-z]+", name) if w]
    return len(words) > 1 and words[0] not in NOT and (words[0] in WORDS or words[-1] in WORDS)


class Node:
    """A text node: its text, the element and block it is in, and what that is in.

    ``main`` is 2 in an article element, 1 in another main one, else 0;
    ``link`` the link element it is in (0: none); ``after`` the last element before it.
    """

    __slots__ = ("text", "element", "block", "main", "furniture", "link", "around", "after")

    def __init__(self, text, element, block, main, furniture, link, around, after):
        self.text, self.element, self.block, self.after = text, element, block, after
        self.main, self.furniture, self.link, self.around = main, furniture, link, around


def drop_named(nodes: list[Node], elements: list[tuple[int, bool, bool]]) -> None:
    """Make furniture of what is in a form or a furniture name, unless that holds the page's article.

    The page's article is the article element with the most text. On a page
    without one a form or name counts unless it holds most of the text.
    ``elements`` has, of each article, form and named one, which of them it is
    in (-1: none), whether it is a form or named, and whether it is an article.
    """
    sizes, whole = [0] * len(elements), 0
    for n in nodes:
        if not n.furniture:
            size = len(n.text.strip())
            whole += size
            if n.around >= 0:
                sizes[n.around] += size
    for i in range(len(elements) - 1, -1, -1):  # what is inside comes later
        if elements[i][0] >= 0:
            sizes[elements[i][0]] += sizes[i]
    dropped = [named and 2 * size <= whole for (_, named, _), size in zip(elements, sizes)]
    articles = [i for i, (_, _, article) in enumerate(elements) if article and sizes[i]]
    if articles:
        dropped = [named for _, named, _ in elements]
        at = max(articles, key=sizes.__getitem__)
        while at >= 0:
            dropped[at] = False
            at = elements[at][0]
    for i, (around, _, _) in enumerate(elements):
        dropped[i] = dropped[i] or (around >= 0 and dropped[around])
    for n in nodes:
        n.furniture = n.furniture or (n.around >= 0 and dropped[n.around])


class Page(NamedTuple):
    """A page's text nodes, and of each element its path's hash and the element it is in (0: the page)."""

    nodes: list[Node]
    paths: list[int]
    parents: list[int]

    def slots(self, template: set[int]) -> list[int]:
        """Of each element, the innermost template element around it or itself."""
        found = []
        for i, (path, parent) in enumerate(zip(self.paths, self.parents)):
            found.append(i if not i or path in template else found[parent])
        return found

    def core(self) -> int:
        """What the page's text is in: 2 article elements, 1 other main ones, 0 neither."""
        return max((n.main for n in self.nodes if not n.furniture and not n.text.isspace()), default=0)

    def article_links(self) -> tuple[int, set[int]]:
        """The number of the articles' text outside links, and the tokens of their links."""
        core = self.core()
        within = [n for n in self.nodes if core and n.main == core and not n.furniture]
        own = " ".join("".join(n.text for n in within if not n.link).split())
        return number(own), {self.token(n) for n in within if n.link}

    def menus(self, nodes: list[Node], template: set[int]) -> list[bool]:
        """Of each element, whether it is in a template element with nothing but links of the template, or is one."""
        links, other = [0] * len(self.paths), [False] * len(self.paths)
        for n in nodes:
            if not any(map(str.isalnum, n.text)):  # what stands between links
                continue
            if n.link and self.paths[n.link] in template and self.token(n) in template:
                links[n.link] = 1
            else:
                other[n.element] = True
        for i in range(len(links) - 1, 0, -1):  # what is inside comes later
            links[self.parents[i]] += links[i]
            other[self.parents[i]] |= other[i]
        found = [False]
        for i in range(1, len(links)):
            menu = links[i] >= MENU_LINKS and not other[i] and self.paths[i] in template
            found.append(menu or found[self.parents[i]])
        return found

    def token(self, node: Node) -> int:
        """The token of a text node: its element's path and its text."""
        return number(" ".join(node.text.split()), self.paths[node.element])


def parse(page: str) -> Page:
    """A page's text nodes and elements, in order. Work and memory are in proportion to the page, however deep."""
    nodes: list[Node] = []
    paths, parents = [0], [0]
    elements: list[tuple[int, bool, bool]] = []
    # tag, element, inside an article, inside furniture, the link around, the last of the named elements around
    stack = [("", 0, 0, False, 0, -1)]
    open_tags: dict[str, int] = {}
    # places in the stack where an end may be implied: blocks and options
    ends: list[int] = []
    at = block = 0

    def text(raw: str) -> None:
        shown = html.unescape(raw) if "&" in raw else raw
        if shown:
            nodes.append(Node(shown, stack[-1][1], block, *stack[-1][2:], len(paths) - 1))

    def close(to: int) -> None:
        for tag, *_ in stack[to:]:
            open_tags[tag] -= 1
        del stack[to:]
        while ends and ends[-1] >= to:
            ends.pop()

    while at < len(page):
        found = TAG.search(page, at)
        if not found:
            text(page[at:])
            break
        if found.start() > at:
            text(page[at:found.start()])
        at = found.end()
        closing, tag, rest = found[1], found[2], found[3] or ""
        if tag is None:
            closing, tag = found[4], found[5]
            if tag is None:  # a comment or a declaration
                continue
        tag = tag.lower()
        if tag in BLOCK:
            block += 1
        if tag == "br":
            text(" ")
        if closing:
            if open_tags.get(tag):
                to = len(stack) - 1
                while stack[to][0] != tag:
                    to -= 1
                close(to)
            continue
        for i in reversed(ends):
            open_tag = stack[i][0]
            if tag in CLOSES.get(open_tag, ()):
                close(i)
                break
            if open_tag in BLOCK:
                break
        _, element, main, furniture, link, around = stack[-1]
        names = names_of(rest) if "=" in rest else []
        paths.append(number(".".join([tag, *names]), paths[element]))
        parents.append(element)
        element = len(paths) - 1
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID or rest.endswith("/"):
            continue
        furniture = furniture or tag in FURNITURE or (tag == "header" and not main)
        single = {w for name in names for w in name.split()}
        # a name inside a line of text makes no furniture
        named = tag == "form" or (tag in BLOCK and tag not in NEVER and any(map(is_furniture_name, single)))
        article = tag in MAIN or any(
            "main" in (words := re.split(r"[^a-z]+", name)) and NAMES.isdisjoint(words) for name in single)
        if named or article:
            elements.append((around, named, article))
            around = len(elements) - 1
        if tag in BLOCK or tag in CLOSES:
            ends.append(len(stack))
        open_tags[tag] = open_tags.get(tag, 0) + 1
        main = 2 if tag == "article" else main or int(article)
        stack.append((tag, element, main, furniture, element if tag == "a" else link, around))
    drop_named(nodes, elements)
    return Page(nodes, paths, parents)


def number(token: str, inside: int = 0) -> int:
    """A token's 64-bit number; with ``inside`` the path of what it is in."""
    return xxhash.xxh64_intdigest(token, inside + (1 << 63)) - (1 << 63)


def page_tokens(page: str, found: Page | None = None) -> dict[int, int]:
    """How often a page has each token, in order of their first places: element paths, and short texts outside
    articles or in links."""
    found = found or parse(page)
    core = found.core()
    counts: dict[int, int] = {}
    opened = 1

    def open_to(last: int) -> None:
        nonlocal opened
        for key in found.paths[opened:last + 1]:
            counts[key] = counts.get(key, 0) + 1
        opened = max(opened, last + 1)

    for n in found.nodes:
        if (not n.main or n.main < core or (n.link and not n.furniture)) and len(n.text) <= TOKEN_CHARS and not n.text.isspace():
            open_to(n.after)
            key = found.token(n)
            counts[key] = counts.get(key, 0) + 1
    open_to(len(found.paths) - 1)
    return counts


def places(tokens: list[int], classes: list[list[int]]) -> dict[int, int]:
    """Of each token of a class, its place on a page that has ``tokens`` in this order.

    The place is the token's rank in its class, and that of the token of the first class before the class begins.
    """
    class_of = {t: i for i, of in enumerate(classes) for t in of}
    seen, begins, out = [0] * len(classes), [0] * len(classes), {}
    for t in tokens:
        i = class_of.get(t)
        if i is not None:
            if not seen[i]:
                begins[i] = seen[0]
            out[t] = (begins[i] << 32) + seen[i]
            seen[i] += 1
    return out


def main_slots(page: str, template: set[int]) -> tuple[str, int]:
    """The text of the page's slots that are not furniture, a line for each block, and how many slots it has."""
    found = parse(page)
    core = found.core()
    slot_of = found.slots(template)
    kept = [n for n in found.nodes if not n.furniture and (n.main or not core)]
    # Around the articles, and without any, the template's texts go ...
    kept = [n for n in kept if (core and n.main == core) or found.token(n) not in template]
    if not core:
        # ... and without any, so do slots that are mostly links.
        slots: dict[int, list[int]] = {}
        for n in kept:
            size = slots.setdefault(found.paths[slot_of[n.element]], [0, 0])
            size[bool(n.link)] += len(n.text.strip())
        menus = {s for s, (plain, links) in slots.items() if links > LINK_SHARE * (plain + links)}
        kept = [n for n in kept if found.paths[slot_of[n.element]] not in menus]
    elif template:
        # In an article repeated text is content; only the template's menus go, unless it is nothing else.
        in_menu = found.menus(kept, template)
        own = [n for n in kept if not in_menu[n.element]]
        if any(n.main == core and not n.text.isspace() for n in own):
            kept = own
    lines: dict[int, list[str]] = {}
    for n in kept:
        lines.setdefault(n.block, []).append(n.text)
    shown = (" ".join("".join(parts).split()) for parts in lines.values())
    text = "\n".join(line for line in shown if line)
    return text, len({slot_of[n.element] for n in kept if not n.text.isspace()})


def main_text(page: str, template: set[int]) -> str:
    """The text of the page's slots that are not furniture, a line for each block."""
    return main_slots(page, template)[0]


def templates(pages: DataFrame, text_col: str) -> DataFrame:
    """``host, template``: each host's template tokens, class by class.

    ``pages`` has ``host``. A class of a host is the tokens with one
    occurrence vector; it holds if it is on ``SHARE`` of the pages, among
    them ``MIN_PAGES`` different ones, of links in articles with different
    articles. Classes nest: the first is the one on the most pages, of equals
    that of most tokens. A token of a class is valid if it has one place in the
    order of its class, and the class one place among the tokens of the first, on ``SHARE`` of
    its pages. A valid token is on at least half of the
    pages, so a host's template has at most twice as many tokens as a page.
    """

    def counted(texts: list[str]) -> dict[str, list]:
        rows: dict[str, list] = {"_key": [], "_own": [], "_tokens": [], "_counts": [], "_links": []}
        for page in texts:
            found = parse(page)
            own, links = found.article_links()
            counts = {t: n for t, n in page_tokens(page, found).items() if t}
            for name, value in zip(rows, (number(page), own, [*counts], [*counts.values()], [t in links for t in counts])):
                rows[name].append(value)
        return rows

    kinds = {"_key": T.LongType(), "_own": T.LongType(), "_tokens": T.ArrayType(T.LongType()),
             "_counts": T.ArrayType(T.LongType()), "_links": T.ArrayType(T.BooleanType())}
    read = cut(with_text_columns(pages, text_col, counted, kinds, ["host"]))
    # token 0 is the page itself; copies of an article bring its links along, in whatever frame
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("_tokens"), F.lit(1).cast("bigint").alias("_counts"), F.lit(False).alias("_links")))
    vectors = (
        read.select("host", F.col("_key").alias("key"), "_own",
                    F.explode(F.concat(whole, F.arrays_zip("_tokens", "_counts", "_links"))).alias("t"))
        .select(
            "host", F.col("t._tokens").alias("token"), F.xxhash64("key", "t._counts").alias("h"),
            F.when(F.col("t._links"), F.col("_own")).otherwise(F.col("key")).alias("differs"))
        .groupBy("host", "token")
        .agg(
            F.count("*").alias("pages"),
            F.sum(F.col("h").bitwiseAND(0xFFFFFFFF)).alias("low"),
            F.sum(F.shiftrightunsigned("h", 32)).alias("high"),
            F.bit_count(F.bit_or(F.expr("shiftleft(1L, int(pmod(differs, 63)))"))).alias("different"),
        )
    )
    vectors = cut(vectors.where(F.col("different") >= MIN_PAGES))
    hosts = vectors.where("token = 0").select("host", F.col("pages").alias("_pages"))
    held = vectors.where("token <> 0").join(hosts, "host").where(F.col("pages") >= SHARE * F.col("_pages"))
    nested = cut(_nested(held))

    def placed(tokens: list, classes: list) -> dict[str, list]:
        found = [places(of or [], c) if c else {} for of, c in zip(tokens, classes)]
        return {"_places": [[{"token": t, "place": p} for t, p in of.items()] for of in found]}

    place = T.StructType([T.StructField(n, T.LongType()) for n in ("token", "place")])
    found = with_text_columns(
        lookup_join(read.select("host", "_tokens"), nested, "host"), "_tokens", placed,
        {"_places": T.ArrayType(place)}, ["host"], also=("classes",))
    valid = (
        found.select("host", F.explode("_places").alias("p")).groupBy("host", "p.token", "p.place").agg(F.count("*").alias("n"))
        .groupBy("host", "token").agg(F.max("n").alias("most"), F.sum("n").alias("n"))
        .where(F.col("most") >= SHARE * F.col("n")).select("host", "token")
    )
    return _nested(held.join(valid, ["host", "token"])).select("host", F.flatten("classes").alias("template"))


def _nested(tokens: DataFrame) -> DataFrame:
    """``host, classes``: the tokens with one occurrence vector, the classes on most pages and of most tokens first."""
    classes = tokens.groupBy("host", "pages", "low", "high").agg(F.collect_set("token").alias("tokens"))
    order = [(-F.col("pages")).alias("at"), (-F.size("tokens")).alias("size"), "low", "high", "tokens"]
    return classes.groupBy("host").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(*order))), lambda c: c["tokens"]).alias("classes"))


def extract(
    pages: DataFrame,
    url_col: str = "url",
    html_col: str = "html",
    keep: list[str] | None = None,
) -> DataFrame:
    """Every row of ``pages``: ``keep, main_text, main_slots``.

    Text of an article element is kept whole but for furniture inside it: menus,
    footers, forms, and blocks named as adverts, comments, notices and the like
    by a class, id or role, or by its first or last word; names inside a line of
    text count for nothing. A form or name around the page's article, or around
    most of the text where there is none, is not furniture. In an article the
    host's template finds menus without a name: elements with nothing but links
    that repeat on different articles. Around article elements, in a main one,
    its texts go, and on a page without article it decides alone; of articles with equally much text the
    first is the page's. Character references are decoded, white space inside a
    block is one space, blocks are lines. A page takes time and memory in
    proportion to its length, however long or deep; repeated pages are pages of
    their own, but one page's copies make no template; an empty table gives no rows. A null or empty page has an empty text; a page without a
    readable URL belongs to the host that has no name. ``keep`` are the columns
    passed on (all by default, but for those named like the results).
    ``main_slots`` is how many slots of the template have text in ``main_text``.
    """
    kept = [c for c in (pages.columns if keep is None else keep) if c not in ("main_text", "main_slots")]
    host = F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url_col}`"), F.lit("")), HOST, 1))
    source = pages.select(
        *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(kept)],
        F.col(f"`{html_col}`").alias("_html"),
        host.alias("host"),
    )
    with_template = lookup_join(source, cut(templates(source.select("host", "_html"), "_html")), "host")

    def run(texts: list[str], found: list[list[int] | None]) -> dict[str, list]:
        pairs = [main_slots(t, set(f or ())) if t else ("", 0) for t, f in zip(texts, found)]
        return {"main_text": [text for text, _ in pairs], "main_slots": [n for _, n in pairs]}

    names = [f"_k{i}" for i in range(len(kept))]
    out = with_text_columns(with_template, "_html", run, {"main_text": T.StringType(), "main_slots": T.LongType()}, names, also=("template",))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, kept)], "main_text", "main_slots")
