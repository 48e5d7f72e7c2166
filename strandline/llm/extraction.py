"""HTML main text by template deduction: tokens of a host's pages that share an occurrence vector form classes, ordered and nested classes are the template, and the slots between its tokens hold a page's own text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.shared import lookup, table, written

#: A class is frequent if its tokens occur on at least so many different pages (a parameter of ``extract``), and on at least half of its host's different pages of that layout.
SHARED = 8
#: A class that isn't on every page of its layout needs so many tokens.
LARGE = 3
#: Tokens whose order a task adds up before it hands them on.
KEPT = 100_000
#: Layouts whose template a worker keeps.
LAYOUTS = 1_000

_NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*+)")
_ATTRIBUTES = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
#: Elements whose content isn't markup, and what closes them.
_RAW = {name: re.compile(rf"</{name}\s*+>", re.I) for name in "script style template noscript textarea iframe svg".split()}
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body br caption dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol option p pre section table tbody td tfoot th thead tr ul".split())
_INLINE = frozenset("a abbr b bdi bdo cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split())
_OUTSIDE = frozenset("head nav footer aside form button select dialog menu".split())
_CONTENT = ("article", "main")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 dt th caption".split())
#: Fixed words of class, id and role values that name what isn't article text.
_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies disqus footer gdpr header menu modal nav navbar navigation "
    "newsletter notice notices popup promo related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Words that may stand beside them in one value, such as in share-buttons; beside any other word a listed name says nothing, such as in notice-period.
_BESIDE = frozenset("area bar block body bottom box button buttons container content form group icons inner item items left link links list main outer page panel right row section site slot text top unit wrap wrapper".split())


def named(attributes: list[tuple[str, ...]]) -> tuple[set[str], bool]:
    """The words of class, id and role values, and whether a value names what isn't article text."""
    values = [set(re.split(r"[^a-z0-9]+", v)) - {""} for a in attributes for v in " ".join(a[1:]).lower().split()]
    return set().union(*values), any(v & _NAMES and all(w in _NAMES or w in _BESIDE or w.isdigit() for w in v) for v in values)


def scan(html: str) -> Iterator[tuple[str, str, str]]:
    """(text, "", "") for runs of text and ("", name, attributes) for tags, "/name" for end tags; comments, declarations and raw elements are left out.

    Takes linear time: behind the last ``>`` all is text, and once a tag's quotes don't close, tags end at the next ``>`` whatever the quotes.
    """
    at, n, last, quotes = 0, len(html), html.rfind(">"), True
    while at < n:
        if html[at] != "<" or at > last:
            to = html.find("<", at) if at <= last else n
            to = n if to < 0 else to
            yield html[at:to], "", ""
            at = to
        elif html.startswith("<!--", at):
            to = html.find("-->", at + 4)
            at = n if to < 0 else to + 3
        elif html.startswith(("<!", "<?"), at):
            at = html.find(">", at) + 1
        elif not (m := _NAME.match(html, at + 1)):
            yield "<", "", ""
            at += 1
        else:
            end = _ATTRIBUTES.match(html, m.end()) if quotes else None
            quotes = end is not None
            to = end.end() if end else html.find(">", m.end()) + 1
            name = m[2].lower()
            if not m[1] and name in _RAW:
                closed = _RAW[name].search(html, to)
                at = closed.end() if closed else n
            else:
                yield "", m[1] + name, html[m.end() : to - 1]
                at = to


class Page:
    """A page's block elements and text runs in order. A place stands for a path of open elements with their class words."""

    def __init__(self, html: str):
        #: (position, place) of every block element
        self.elements: list[tuple[int, int]] = []
        #: (position, block number, outside the article, inside an article or main element, inside a heading, place, text) of every run of text
        self.runs: list[tuple[int, int, bool, bool, bool, int, str]] = []
        stack: list[tuple[str, bool, bool, bool, int]] = []  # element, outside the article text, inside an article or main element, inside a heading, place
        opened: dict[str, int] = {}
        block = at = 0

        def close(n: int) -> None:
            for e in stack[n:]:
                opened[e[0]] -= 1
            del stack[n:]

        for text, name, attributes in scan(html):
            at += 1
            if not name:
                _, outside, inside, head, place = stack[-1] if stack else ("", False, False, False, 0)
                self.runs.append((at, block, outside, inside, head, place, unescape(text)))
                continue
            ends, name = name[0] == "/", name.removeprefix("/")
            block += name in _BLOCK
            if ends:
                if opened.get(name):
                    k = len(stack) - 1
                    while stack[k][0] != name and (name not in _INLINE or stack[k][0] in _INLINE):  # an inline element doesn't close blocks within
                        k -= 1
                    if stack[k][0] == name:
                        close(k)
                continue
            if name in _BLOCK and name != "br":  # a block ends open inline elements of an unclosed paragraph, and the paragraph
                while stack and stack[-1][0] in _INLINE:
                    close(len(stack) - 1)
                if stack and stack[-1][0] == "p" or name in ("li", "dd", "dt", "option", "tr", "td", "th") and stack and stack[-1][0] == name:
                    close(len(stack) - 1)
            _, outside, inside, head, place = stack[-1] if stack else ("", False, False, False, 0)
            head = head or name in _HEADINGS
            words, other = named(_ATTRIBUTE.findall(attributes)) if "=" in attributes else (set(), False)
            if name in _CONTENT:
                inside = True
            elif name not in ("html", "body"):
                outside = outside or name in _OUTSIDE or (name == "header" and not inside) or other
            if name not in _INLINE and name not in _VOID:
                place = hashed(place, name, *sorted(w for w in words if not any(map(str.isdigit, w))))
                self.elements.append((at, place))
            if name not in _VOID and not attributes.rstrip().endswith("/"):
                opened[name] = opened.get(name, 0) + 1
                stack.append((name, outside, inside, head, place))


def hashed(*parts: object) -> int:
    return int.from_bytes(blake2b("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


class Line(NamedTuple):
    """A line of running text: where it begins, whether it is article text by names and elements, whether it is a heading."""

    at: int
    place: int
    text: str
    article: bool
    heading: bool


def lines_of(page: Page) -> tuple[bool, list[Line]]:
    """Whether the page has text in article or main elements, and all its lines, those outside the article too.

    Article lines are those inside such elements where the page has any, else all, without what elements or class words mark as other than the article. A block of both kinds makes a line of each.
    """
    inner = any(inside and not outside and not text.isspace() for _, _, outside, inside, _, _, text in page.runs)
    found: dict[tuple[int, bool], tuple[int, int, bool, list[str]]] = {}
    for at, block, outside, inside, head, place, text in page.runs:
        key = block, not outside and (inside or not inner)
        if key not in found or not any(map(str.strip, found[key][3])):  # the first text of a line says where it is
            found[key] = (at, place, head, [*found.get(key, (0, 0, False, []))[3]])
        found[key][3].append(text)
    lines = (Line(at, place, " ".join("".join(parts).split()), article, head) for (_, article), (at, place, head, parts) in sorted(found.items(), key=lambda x: (x[0][0], not x[0][1])))
    return inner, [x for x in lines if x.text]


def line_token(place: int, text: str) -> int:
    """A line's token is odd, an element's even."""
    return hashed(place, text) | 1


def tokens(page: Page, lines: list[Line]) -> dict[int, int]:
    """The page's tokens, in the order of their first places, with their occurrences: elements by place, lines by place and text."""
    out: dict[int, int] = {}
    for _, token in sorted([*((at, place & ~1) for at, place in page.elements), *((x.at, line_token(x.place, x.text)) for x in lines)]):
        out[token] = out.get(token, 0) + 1
    return out


def different_pages(rows: DataFrame) -> DataFrame:
    """host, inner, page, token, times: each host's pages with article lines once, however often they are copied, with the tokens of all their lines and elements in order."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for host, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                page = Page(html or "")
                inner, lines = lines_of(page)
                if own := [x.text for x in lines if x.article]:
                    found = tokens(page, lines)
                    out.append((host, inner, hashed(*own), list(found), list(found.values())))
            columns = zip(*out, strict=True) if out else [[]] * 5
            kinds = (pa.string(), pa.bool_(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(columns, kinds, strict=True)], names=["host", "inner", "page", "token", "times"])

    found = rows.select("host", "html").mapInArrow(read, "host string, inner boolean, page long, token array<long>, times array<int>")
    return found.groupBy("host", "inner", "page").agg(F.min(F.struct("token", "times")).alias("x")).select("host", "inner", "page", "x.token", "x.times")


def frequent_classes(different: DataFrame, support: int) -> DataFrame:
    """host, inner, token, kind (the class), every: tokens that occur once a page, in classes by their occurrence vector over the layout's pages, where the class is frequent and large enough.

    A vector is compared by 128 bits, summed (exclusive or) from a hash of each page and count: no task holds a vector, and hot hosts are added up before the shuffle.
    ``every`` marks the root class, whose tokens are on all pages.
    """
    pages = different.groupBy("host", "inner").agg(F.count("*").alias("pages"))
    each = different.select("host", "inner", "page", F.explode(F.arrays_zip("token", "times")).alias("y")).select("host", "inner", "page", "y.token", "y.times")
    vectors = each.groupBy("host", "inner", "token").agg(
        F.bit_xor(F.xxhash64("page", "times")).alias("v1"), F.bit_xor(F.xxhash64("times", "page")).alias("v2"), F.count("*").alias("n"), F.max("times").alias("most")
    )
    frequent = vectors.where((F.col("most") == 1) & (F.col("n") >= support)).join(pages, ["host", "inner"]).where(F.col("n") * 2 >= F.col("pages"))
    frequent = written(frequent.select("host", "inner", "token", F.xxhash64("v1", "v2").alias("kind"), (F.col("n") == F.col("pages")).alias("every")), "frequent")
    return large(frequent)


def large(members: DataFrame) -> DataFrame:
    """Members of classes with LARGE tokens, and those on every page."""
    size = members.groupBy("host", "inner", "kind").agg(F.count("*").alias("size")).where(F.col("size") >= LARGE)
    return members.where("every").unionByName(members.where("not every").join(size, ["host", "inner", "kind"], "left_semi"))


def ordered(different: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` with spread (largest less smallest place among its class on a page), low and high (smallest and largest slot: root tokens before it)."""
    named = written(members, "members")
    by_layout = named.groupBy("host", "inner").agg(F.collect_list(F.struct("token", "kind", "every")).alias("known"))  # tokens on half of the pages: about two pages' worth at most
    counted = different.groupBy("host", "inner").agg(F.count("*").alias("n"))
    known = written(by_layout.join(counted, ["host", "inner"]), "layouts")
    rows = lookup(different.select("host", "inner", "token"), known, ["host", "inner"], "n", different.count()).where("known is not null")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, list[int]] = {}

        def handed_on() -> pa.RecordBatch:
            kinds = (pa.string(), pa.bool_(), pa.int64(), *[pa.int32()] * 4)
            columns = list(zip(*((*k, *v) for k, v in seen.items()), strict=True)) if seen else [[]] * 7
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["host", "inner", "token", "first", "last", "low", "high"])
            seen.clear()
            return out

        kinds_of: dict[tuple, dict[int, tuple[int, bool]]] = {}
        for b in batches:
            for at, (host, inner, found) in enumerate(zip(*(b.column(k).to_pylist() for k in range(3)), strict=True)):
                if (host, inner) not in kinds_of:
                    if len(kinds_of) >= LAYOUTS:
                        kinds_of.clear()
                    kinds_of[host, inner] = {x["token"]: (x["kind"], x["every"]) for x in b.column(3)[at].as_py()}
                kind = kinds_of[host, inner]
                before: dict[int, int] = {}
                slot = 0
                for t in found:
                    if t in kind:
                        k, every = kind[t]
                        n = before[k] = before.get(k, -1) + 1
                        f = seen.setdefault((host, inner, t), [n, n, slot, slot])
                        f[:] = min(f[0], n), max(f[1], n), min(f[2], slot), max(f[3], slot)
                        slot += every
                if len(seen) > KEPT:
                    yield handed_on()
        yield handed_on()

    placed = rows.select("host", "inner", "token", "known").mapInArrow(place, "host string, inner boolean, token long, first int, last int, low int, high int")
    most = placed.groupBy("host", "inner", "token").agg((F.max("last") - F.min("first")).alias("spread"), F.min("low").alias("low"), F.max("high").alias("high"))
    return named.join(most, ["host", "inner", "token"])


def templates(rows: DataFrame, support: int = SHARED) -> DataFrame:
    """host, fixed: the lines (as tokens) of each host that are template text: those in valid classes of occurrence vectors over its different pages.

    Tokens that move among their class leave it; the others keep the same order on every page. A class beside the root class is valid if it also nests, that is, lies in one and the same slot of the root class on all its pages.
    """
    different = written(different_pages(rows), "different")
    steady = ordered(different, frequent_classes(different, support)).where("spread <= 1").select("host", "inner", "token", "kind", "every")
    found = written(ordered(different, large(written(steady, "steady"))).where("spread = 0"), "ordered")
    nested = found.where("not every").groupBy("host", "inner", "kind").agg(F.count("*").alias("size"), F.min("low").alias("low"), F.max("high").alias("high")).where((F.col("size") >= LARGE) & (F.col("low") == F.col("high")))
    valid = found.where("every").select("host", "token").unionByName(found.join(nested, ["host", "inner", "kind"], "left_semi").select("host", "token"))
    return valid.where(F.col("token").bitwiseAND(F.lit(1)) == 1).groupBy("host").agg(F.sort_array(F.collect_set("token")).alias("fixed"))


def in_slots(html: str | None, fixed: set[int]) -> str:
    """The page's article lines that aren't template tokens, and template headings that such a line follows (Ingredients, Method)."""
    lines = [x for x in lines_of(Page(html or ""))[1] if x.article]
    own = [line_token(x.place, x.text) not in fixed for x in lines]
    return "\n".join(x.text for x, mine, after in zip(lines, own, own[1:] + [False]) if mine or x.heading and after)


def extract(pages: DataFrame, support: int = SHARED) -> DataFrame:
    """page_id, url, text, n_chars (code points of text) for every row of ``pages`` (page_id, url, html); whole pages, nothing dropped or capped.

    A first reading deduces each host's template from all lines and elements of all its pages, a second reads what lies in the slots between the template's tokens; pages themselves meet in no task.
    Only then do names count: of what the slots hold, article and main elements bound the text page by page where they hold any, and element names and class words mark what is other than the article.
    A heading that pages share belongs to the page's own text that follows it. A layout with under ``support`` different pages shows no template.
    A null or empty html, or one without article text, gives an empty text. Null urls form a host of their own. Repeated rows give a row each; other columns are ignored.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").withColumn("host", host)
    hosts = written(rows.groupBy("host").agg(F.count("*").alias("n")).join(templates(rows, support), "host", "left"), "hosts")
    total = hosts.agg(F.sum("n")).first()[0] or 0

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed: dict[str, set[int]] = {}
        for b in batches:
            texts = []
            for at, (html, host) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                if host not in fixed:
                    if len(fixed) >= LAYOUTS:
                        fixed.clear()
                    fixed[host] = set(b.column(4)[at].as_py() or ())
                texts.append(in_slots(html, fixed[host]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return lookup(rows, hosts, ["host"], "n", total).select("page_id", "url", "html", "host", "fixed").mapInArrow(read, "page_id long, url string, text string, n_chars long")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
