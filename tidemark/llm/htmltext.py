"""Main text of web pages by equivalence-class template deduction.

Per host, over all its pages:

1. A page becomes tokens: tags with their class or id, and whole text pieces.
2. A token's occurrence vector is its count on every page. Vectors are compared by a sum of hashes
   of (page, count), so they are aggregated before the shuffle and no vector is ever held; tokens of a host
   that share one form an equivalence class.
3. A class is valid if its tokens stand on at least ``MIN_SUPPORT`` of the host's pages and their mean first places
   put them in a strict order. Valid classes are nested: of two, one must lie inside a gap of the
   other or beside it; a class that crosses one of more support is dropped.
4. The nested classes are the host's template. Its once-a-page tags are the fixed sequence, the gaps between them
   are slots, each with the role of the elements the template has open there.

Extraction walks a page along its host's fixed sequence. Text pieces of the template outside the article are
boilerplate. A piece is left out if its slot, or the page's own markup inside the slot, belongs to menus,
headers, footers, sidebars, notices, adverts, forms, comments or code; the rest is the result, of it only
what is inside ``article`` or ``main`` where the page has text there (a form around an article doesn't drop it). A class, id or role
names such a part as a whole only: outside the article if it holds nothing but words for these parts and for places on a page, inside it if
nothing but words for these parts. A page that doesn't follow its host's
sequence, or whose host has too few pages, is read by its own markup.

A host's template is small (markup, and text repeated on most pages); pages join it by host, broadcast behind a check of
the number of hosts, else shuffled. A host with a third of all pages is pre-aggregated like any other.

Edge cases: a null html is empty and gives an empty text; a null url or one without a host belongs to the
nameless host; truncated or unbalanced markup is read as far as it goes; repeated rows each get their row; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import html as htmllib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_few, cut, fresh, read_table, text_or_empty

MIN_SUPPORT = 0.5     # share of a host's pages that a template token stands on
MIN_PAGES = 5         # a host with fewer pages has no text in its template
MAX_BROADCAST_HOSTS = 20_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
# One attribute after the other, each with its value, so that neither values nor other names are searched.
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>"'][^\s>]*)))?""")
_SPACE = re.compile(r"\s+")
# Fixed values of the HTML standard.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "svg", "math", "iframe", "object", "canvas", "xmp",
       "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt",
         "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
         "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary",
         "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
# An open <p> ends where one of these begins; the others end where one of their own kind begins.
ENDS_P = BLOCK - {"body", "html", "head", "option", "td", "th", "tr", "tbody", "thead", "tfoot"}
ENDS_OWN = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "tr": {"table"},
            "td": {"tr", "table"}, "th": {"tr", "table"}}
SIBLINGS = {"dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}}
# Elements and class, id or role words whose content is no main text.
DROP = {"nav", "footer", "aside", "form", "button", "select", "option", "head", "menu", "dialog", "label", "input",
        "fieldset"} | RAW
DROP_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "sponsors",
              "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification",
              "alert", "sidebar", "aside", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs",
              "footer", "header", "masthead", "comment", "comments", "disqus", "reply", "replies", "respond",
              "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe", "subscription",
              "popup", "modal", "overlay", "toolbar", "pagination", "pager", "widget", "widgets", "complementary",
              "contentinfo", "search", "login", "signup", "skip"}
# Words that only place an element on the page: beside them a drop word still names what the element is.
PLACE_WORDS = {"site", "page", "main", "global", "primary", "secondary", "top", "bottom", "left", "right", "upper", "lower", "box", "bar",
               "area", "container", "wrapper", "wrap", "inner", "outer", "block", "section", "slot", "unit", "panel", "list", "links",
               "link", "item", "items", "region", "zone", "col", "column", "row", "text", "content", "mobile", "desktop"}
INLINE_DROP = {"label", "button"}  # inside a paragraph of the article they are words of a sentence
MAIN = {"article", "main"}
FORM = {"form", "fieldset"}
# How an element's content is dropped: not; as a form, which an article or main inside ends; for good.
SHOWN, IN_FORM, GONE = range(3)
READER_WORDS = {"comment", "comments", "disqus", "ad", "ads", "reply", "replies", "sidebar"}  # even beside an article's words
KEEP_WORDS = {"article", "content", "main", "post", "entry", "body", "story"}
WHOLE_PAGE = {"html", "body"}
STATE_WORDS = {"no", "with", "without", "has"}  # such a class tells how an element's page looks, not what the element is


def host_of(url: str | None) -> str:
    """Host of a url, A-Z lowered; '' if there is none."""
    url = url or ""
    at = url.find("://")
    if at < 0:
        return ""
    host = re.split(r"[/?#]", url[at + 3:], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m.group().lower(), host)


def squeeze(text: str) -> str:
    return _SPACE.sub(" ", htmllib.unescape(text)).strip()


def tokens(html: str | None) -> Iterator[tuple[str, str, str]]:
    """('open' | 'close' | 'text', element name or raw text, attributes) in page order.

    Comments, declarations and the content of raw elements yield nothing.
    """
    html = html or ""
    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        if m is None:
            yield "text", html[at:], ""
            return
        if m.start() > at:
            yield "text", html[at:m.start()], ""
        at = m.end()
        if m.group("name") is None:
            continue
        name = m.group("name").lower()
        if m.group("close"):
            yield "close", name, ""
            continue
        attrs = m.group("attrs")
        yield "open", name, attrs
        if name in RAW and not attrs.rstrip().endswith("/"):
            stop = re.compile(rf"</{re.escape(name)}\s*(?:>|\Z)", re.I).search(html, at)
            at = stop.end() if stop else end
            yield "close", name, ""


def _labels(attrs: str) -> tuple[str, set[str]]:
    """Class and id of a tag, and the words of its class, id and role.

    ``\0drop`` is one of them if a whole class, id or role is made of nothing but DROP_WORDS, ``\0place`` if of these and
    PLACE_WORDS (``ad-slot``, ``site-header``, but not ``search-algorithms``), ``\0keep`` if it is neither and holds a word of KEEP_WORDS;
    ``\0reader`` if of READER_WORDS, or of these and
    KEEP_WORDS (``comments``, ``ad-12``, ``comment-body``, but not ``comments-open``).
    """
    shown, words = [], set()
    for m in _ATTR.finditer(attrs):
        name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if name in ("class", "id"):
            shown.append('{}="{}"'.format(name, value.replace('"', "")))
        if name in ("class", "id", "role"):
            for token in value.lower().split():
                parts = [x for x in re.split("[_-]+", token) if x]
                if parts and parts[0] in STATE_WORDS:
                    continue
                plain = [x.rstrip("0123456789") for x in parts]
                words.update(parts, plain)
                plain = {x for x in plain if x}
                if plain & DROP_WORDS and plain <= DROP_WORDS | PLACE_WORDS:
                    words.add("\0drop" if plain <= DROP_WORDS else "\0place")
                elif plain & KEEP_WORDS:
                    words.add("\0keep")
                if name != "role" and plain & READER_WORDS and plain <= READER_WORDS | KEEP_WORDS:
                    words.add("\0reader")
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            words.add("\0hidden")
        if name == "aria-hidden" and value.lower() == "true":
            words.add("\0hidden")
    return " ".join(shown), words


def _spelled(token: tuple[str, str, str]) -> str:
    """A token as one string: a tag with class and id, or a text piece ('T' alone if it is blank)."""
    kind, body, attrs = token
    if kind == "text":
        return "T" + squeeze(body)
    if kind == "close":
        return f"</{body}"
    return f"<{body} {_labels(attrs)[0]}".rstrip() if attrs else f"<{body}"


def template_tokens(html: str | None) -> Iterator[str]:
    """The tokens whose occurrence vectors are compared."""
    return (t for t in map(_spelled, tokens(html)) if t != "T")


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 7) - (1 << 63)


def deduce_templates(pages: DataFrame, min_support: float = MIN_SUPPORT, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per host: ``fixed`` (tags in order: token, dropped, main of the slot behind) and ``boilerplate`` (text hashes)."""
    schema = pa.schema([("host", pa.string()), ("token", pa.int64()), ("tag", pa.string()), ("pages", pa.int64()),
                        ("total", pa.int64()), ("vector", pa.int64()), ("places", pa.int64()), ("host_pages", pa.int64())])

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Partial sums of a batch, one row per host and token, and one per host (token 0) with its pages."""
        for b in batches:
            found: dict[tuple[str, str], list[int]] = {}
            pages_of = Counter()
            for page, url, html in zip(*(b.column(i).to_pylist() for i in range(3))):
                host = host_of(url)
                pages_of[host] += 1
                counts = Counter(template_tokens(html))  # keeps the order of first appearance
                for place, (token, n) in enumerate(counts.items()):
                    row = found.setdefault((host, token), [0, 0, 0, 0])
                    row[0] += 1
                    row[1] += n
                    row[2] = (row[2] + _hash(f"{page}\0{n}")) % (1 << 62)
                    row[3] += place
            rows = [(h, _hash(t), t[1:] if t[0] != "T" else None, *v, 0) for (h, t), v in found.items()]
            rows += [(h, 0, None, 0, 0, 0, 0, n) for h, n in pages_of.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    src = pages.select(F.monotonically_increasing_id().alias("page"), F.col("url").cast("string"),
                       text_or_empty("html").alias("html"))
    seen = src.mapInArrow(occurrences, "host string, token long, tag string, pages long, total long, vector long, "
                                       "places long, host_pages long")
    both = cut(seen.groupBy("host", "token", "tag").agg(
        *[F.sum(c).alias(c) for c in ("pages", "total", "places", "host_pages")],
        F.sum(F.col("vector").cast("decimal(38,0)")).alias("vector")).where("pages >= 2 or host_pages > 0"))
    sizes = both.where("host_pages > 0").select("host", F.col("host_pages").alias("n"))
    common = (both.where("host_pages = 0").join(broadcast_if_few(sizes), "host")
              .where((F.col("n") >= min_pages) & (F.col("pages") >= min_support * F.col("n"))))
    # a host's rows here: tokens that most of its pages hold, so no more than about a page has
    classes = common.select("host", "token", "tag", "pages", "total", "vector", (F.col("places") / F.col("pages")).alias("place"))

    def nest(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        fixed, boilerplate = template_of(list(rows.itertuples(index=False, name=None)))
        return pd.DataFrame({"host": [key[0]], "fixed": [fixed], "boilerplate": [boilerplate]})

    return classes.withColumn("vector", F.col("vector").cast("string")).groupBy("host").applyInPandas(
        nest, "host string, fixed array<struct<token:long,dropped:boolean,main:boolean>>, boilerplate array<long>")


def template_of(rows: list[tuple]) -> tuple[list[tuple[int, bool, bool]], list[int]]:
    """Nest the classes of one host. Rows: (host, token, tag or None for text, pages, total, vector, place)."""
    classes: dict[tuple, list[tuple]] = {}
    for _, token, tag, n, total, vector, place in rows:
        classes.setdefault((n, total, vector), []).append((place, token, None if tag is None or tag != tag else tag))
    accepted: list[tuple[tuple, list[tuple]]] = []
    for key, members in sorted(classes.items(), key=lambda x: (-x[0][0], x[0][1], min(m[0] for m in x[1]))):
        members.sort(key=lambda m: (m[0], m[1]))
        places = [m[0] for m in members]
        strict = all(a < b for a, b in zip(places, places[1:]))
        if strict and all(_nested(places, [m[0] for m in other]) for _, other in accepted):
            accepted.append((key, members))
    # the fixed sequence: tags that stand once on every page that has them
    once = sorted(m for (n, total, _), members in accepted if n == total for m in members if m[2] is not None)
    fixed, open_elements = [], []
    for _, token, tag in once:
        name, _, attrs = tag.lstrip("/").partition(" ")
        if tag.startswith("/"):
            for i in range(len(open_elements) - 1, -1, -1):
                if open_elements[i][0] == name:
                    del open_elements[i:]
                    break
        elif name not in VOID:
            parent, dropped, main = open_elements[-1] if open_elements else ("", SHOWN, False)
            open_elements.append((name, *role(name, _labels(attrs)[1], dropped, main, parent)))
        _, dropped, main = open_elements[-1] if open_elements else ("", SHOWN, False)
        fixed.append((token, dropped != SHOWN, main))
    return fixed, [m[1] for _, members in accepted for m in members if m[2] is None]


def _nested(a: list[float], b: list[float]) -> bool:
    """One sequence of places lies in a gap of the other, or beside it."""
    inside = lambda x, y: bisect.bisect(y, x[0]) == bisect.bisect(y, x[-1])
    return inside(a, b) or inside(b, a)


def role(name: str, words: set[str], dropped: int, main: bool, parent: str = "") -> tuple[int, bool]:
    """(dropped, main) inside an element, from its name, its words, what encloses it and the element around it."""
    if name in MAIN and dropped == IN_FORM:
        dropped = SHOWN
    if dropped != GONE:
        kept = name in MAIN or "\0keep" in words
        named = "\0drop" in words or "\0place" in words and not main
        if ("\0hidden" in words or name == "header" and not main or "\0reader" in words and name not in WHOLE_PAGE | MAIN
                or name in DROP - FORM and not (main and parent == "p" and name in INLINE_DROP)
                or named and name not in WHOLE_PAGE | {"h1"} | FORM and not kept):
            dropped = GONE
        elif name in FORM:
            dropped = IN_FORM
    return dropped, not dropped and (main or name in MAIN)


def slots(found: list[tuple[str, str, str]], fixed: list[tuple[int, bool, bool]]) -> list[tuple[bool, bool]] | None:
    """Role of the slot that each token of a page stands in; None if the page doesn't follow the sequence."""
    at, state, roles = 0, (False, False), []
    for token in found:
        if at < len(fixed) and token[0] != "text" and _hash(_spelled(token)) == fixed[at][0]:
            state, at = fixed[at][1:], at + 1
        roles.append(state)
    return roles if at == len(fixed) else None


def extract(html: str | None, fixed: list[tuple[int, bool, bool]] = (), boilerplate: set[int] = frozenset()) -> str:
    """Main text of one page, read along its host's template (``fixed`` and ``boilerplate``, see deduce_templates)."""
    blocks: list[tuple[str, bool]] = []       # text, inside article or main
    stack: list[tuple[str, int, bool]] = []   # element, dropped, main
    piece: list[str] = []
    state = (SHOWN, False)                    # of the innermost open element

    def flush() -> None:
        text = squeeze("".join(piece)) if piece else ""
        piece.clear()
        if text and (state[1] or _hash("T" + text) not in boilerplate):
            blocks.append((text, state[1]))

    def pop_to(n: int) -> None:
        nonlocal state
        del stack[n:]
        state = stack[-1][1:] if stack else (SHOWN, False)

    def close(names: set[str], until: set[str] | frozenset[str] = frozenset()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                return pop_to(i)
            if stack[i][0] in until:
                return None
        return None

    found = list(tokens(html))
    roles = slots(found, fixed) if fixed else None
    for i, (kind, body, attrs) in enumerate(found):
        if kind == "text":
            # the page's own article stands, whatever slot the sequence sees there
            if not state[0] and (state[1] or roles is None or not roles[i][0]):
                piece.append(body)
            continue
        if body in BLOCK:
            flush()
        elif body == "br":
            piece.append(" ")
        if kind == "close":
            close({body})
            continue
        if body in ENDS_P:
            close({"p"}, BLOCK - {"p"})
        if body in ENDS_OWN:
            close(SIBLINGS.get(body, {body}), ENDS_OWN[body])
        if body not in VOID and not (attrs.rstrip().endswith("/") and body not in BLOCK):
            stack.append((body, *role(body, _labels(attrs)[1] if attrs else set(), *state, stack[-1][0] if stack else "")))
            state = stack[-1][1:]
    flush()
    inside = [t for t, main in blocks if main]
    return "\n".join(inside or [t for t, _ in blocks])


def main_text(pages: DataFrame, min_support: float = MIN_SUPPORT, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    host = fresh("host")
    templates = cut(deduce_templates(pages, min_support, min_pages)).withColumnRenamed("host", "of_host")
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    name = F.when(F.instr(url, "://") > 0, F.translate(
        F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
                  ).otherwise("")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        text_or_empty("html").alias("html"), name.alias(host))
    rows = rows.join(broadcast_if_few(templates, MAX_BROADCAST_HOSTS), F.col(host) == F.col("of_host"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts: dict[str, tuple] = {}
            out = []
            for k, h, html in zip(range(len(b)), b.column(3).to_pylist(), b.column(2).to_pylist()):
                if h not in hosts:
                    fixed, boilerplate = b.column(4)[k].as_py(), b.column(5)[k].as_py()
                    hosts[h] = ([(x["token"], x["dropped"], x["main"]) for x in fixed or ()], set(boilerplate or ()))
                out.append(extract(html, *hosts[h]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string()),
                                              pa.array([len(t) for t in out], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return (rows.select("page_id", "url", "html", host, "fixed", "boilerplate")
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read_table(spark, sf_dir, "pages"))
