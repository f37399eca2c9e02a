"""Main text of web pages: markup first, then repeats across the pages of a host.

A page is read once into blocks. Markup puts each block in a zone: the article (``<article>`` or a container named so),
the body (``<main>`` or a container named as content, outside an article), chrome (menus, headers, footers, sidebars,
notices, adverts, forms, comments), or undecided. Within an article a name marks furniture only on a container and only as a whole:
``share-bar`` does, ``notice-period`` or ``search-results`` do not. Article blocks stay and chrome goes. A name says less than an element: an ``<article>``
or ``<main>`` below a container that only its name makes furniture, as ``content-sidebar-wrap``, is the article after all where it holds more words than what is one otherwise;
containers of comments are not asked.

Body and undecided blocks are judged by the host's suffix array. The words of a page's blocks outside the article are its
token stream. In the suffix array of all streams of a host, suffixes that share their first ``least_words`` words
stand next to each other; such a run of the array is a substring repeated across pages, and every longer repeat is
covered by its runs. So the array is cut at depth ``least_words``: suffixes are shuffled by (host, hash of that
prefix), and each run is counted where it lies, with partial counts first, so a host may hold any share of the pages.
Streams that are equal throughout count once, so copies of one page don't mark each other. A block of which at least
half the words lie in runs of ``least_pages`` or more distinct streams is boilerplate; the others, the unique runs, are
kept in the body. Undecided ones are kept if they are the headline or together hold more words than the article and what
is kept of the body, which then are a teaser or a box. A body of repeats only, in a page of nothing else, stays.

Null html gives an empty text. A truncated page is read as far as it goes. Repeated rows each give a row. A null url
counts as a host of its own. Columns of other names are ignored. Empty tables give empty results.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import checkpointed, slices

# fixed values: element names of HTML by role, and the names by which authors mark page furniture
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "xmp", "noembed", "noframes", "template", "svg", "object", "audio", "video", "canvas", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "label", "math", "mfrac", "mi", "mn", "mo", "mroot", "mrow", "ms", "msqrt", "mstyle", "msub", "msubsup", "msup", "mtext", "munder", "mover", "semantics"}
CHROME_TAGS = {"nav", "footer", "aside", "form", "button", "fieldset", "menu", "dialog", "head"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
CHROME_NAMES = {
    "ad", "ads", "adbox", "adslot", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "byline", "comment", "comments", "consent", "cookie", "cookiebar",
    "cookies", "copyright", "disqus", "discussion", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification",
    "overlay", "pager", "pagination", "popup", "promo", "promotion", "related", "recommended", "replies", "reply", "respond", "responses", "search", "share", "sharebar", "sharing", "sidebar", "signup", "skip", "social",
    "sponsor", "sponsored", "subscribe", "subscription", "tagcloud", "toolbar", "topbar", "widget", "widgets",
}
# within an article: words that a name of furniture may hold besides, tags that only hold text, and names that an article's own section may have
NEUTRAL_NAMES = {"area", "bar", "block", "box", "button", "buttons", "container", "content", "form", "group", "inline", "inner", "item", "items", "link", "links", "list", "outer", "panel", "section", "wrap", "wrapper"}
TEXT_TAGS = {"p", "blockquote", "pre", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "figure", "figcaption", "table", "tr", "tbody"} | INLINE
ARTICLE_SECTIONS = {"discussion", "promotion", "recommended", "copyright", "login"}
HEAD_NAMES = {"header", "masthead", "topbar"}
COMMENT_NAMES = {"comment", "comments", "replies", "reply", "responses", "discussion", "disqus"}
ARTICLE_NAMES = {"articlebody", "article-body", "article-content", "article__body", "content", "content-body", "entry", "entry-content", "main", "main-content", "maincontent", "page-content", "post", "post-body", "post-content", "story", "story-body", "article"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: NAMED is chrome by its container's name, RESCUED an article within it.
MAIN, UNDECIDED, CHROME, HEADLINE, BODY, NAMED, RESCUED = range(7)
ARTICLE = {MAIN, RESCUED}
JUDGED = {UNDECIDED, HEADLINE, BODY}


def names_furniture(tag: str, names: list[str], within: bool) -> bool:
    """Whether an element's names mark page furniture; within an article one word of a name is not enough, and text stays text."""
    for name in names:
        if re.match(r"(?i)(?:has|no|with|without|is)[-_]", name):
            continue
        parts = set(filter(None, re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower())))
        if not within and parts & CHROME_NAMES:
            return True
        if within and tag not in TEXT_TAGS and parts & CHROME_NAMES and parts <= CHROME_NAMES | NEUTRAL_NAMES and not parts <= ARTICLE_SECTIONS | NEUTRAL_NAMES:
            return True
    return False


def _zone(tag: str, attributes: str, above: int, in_article: bool) -> tuple[int, bool]:
    """Zone of an element from its own markup and the zone above it; whether it starts an article."""
    if tag in CHROME_TAGS or (tag == "header" and not in_article):
        return CHROME, in_article
    if above == NAMED and tag not in ("article", "main"):
        return NAMED, in_article
    own = {k.lower(): (a or b or c) for k, a, b, c in ATTRIBUTE.findall(attributes)} if "=" in attributes or "hidden" in attributes else {}
    if own:
        role = own.get("role", "").lower()
        if role in CHROME_ROLES or "hidden" in own or own.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", own.get("style", "")):
            return CHROME, in_article
        names = (own.get("class", "") + " " + own.get("id", "")).split()
        parts = {p for name in names if not re.match(r"(?i)(?:has|no|with|without|is)[-_]", name) for p in re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower())}
        if tag == "article" or tag == "main":
            if parts & COMMENT_NAMES and tag == "article":
                return CHROME, in_article
        elif tag not in ("html", "body") and (names_furniture(tag, names, above in ARTICLE) or (parts & HEAD_NAMES and not in_article)):
            return CHROME if in_article or parts & COMMENT_NAMES else NAMED, in_article
        found = ARTICLE_NAMES & {n.lower() for n in names}
        if tag in ("div", "section", "td") and (role in ("main", "article") or found):
            real = above in ARTICLE or role == "article" or any(n.startswith("article") for n in found)
            return (above if above in ARTICLE else MAIN) if real else BODY, True
    if tag == "article":
        return RESCUED if above in (NAMED, RESCUED) else MAIN, True
    if tag == "main":
        return RESCUED if above in (NAMED, RESCUED) else MAIN if above == MAIN else BODY, True
    return above, in_article


def blocks(page: str) -> list[tuple[int, str]]:
    """(zone, text) of each block in page order; the text's white space is settled."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int, bool, bool]] = [("", UNDECIDED, False, False)]  # tag, zone, within an article, within a headline
    opened: Counter[str] = Counter()
    held: list[str] = []
    at, end = 0, len(page)

    def settle() -> None:
        if held:
            if text := " ".join("".join(held).split()):
                _, zone, _, headline = stack[-1]
                out.append((HEADLINE if zone == UNDECIDED and headline else zone, text))
            held.clear()

    def shut(k: int) -> None:
        for s in stack[k:]:
            opened[s[0]] -= 1
        del stack[k:]

    while at < end:
        found = TOKEN.search(page, at)
        if not found:
            held.append(entities.unescape(page[at:]))
            break
        if found.start() > at:
            held.append(entities.unescape(page[at : found.start()]))
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag == "br":
            held.append(" ")
        if found[1]:
            if tag not in INLINE:
                settle()
            for k in range(len(stack) - 1, 0, -1) if opened[tag] > 0 else ():
                if stack[k][0] == tag:
                    if any(s[0] not in INLINE for s in stack[k:]):
                        settle()
                    shut(k)
                    break
                if stack[k][0] in ("article", "main", "body", "table") and tag in INLINE | {"p"}:
                    break
            continue
        if tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at) if not found[3].endswith("/") else None
            if not found[3].endswith("/"):
                at = closing.end() if closing else end
            continue
        if tag not in INLINE:
            settle()
            closed = CLOSES.get(tag, {"p"})
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in closed:
                    shut(k)
                    break
                if stack[k][0] not in INLINE and stack[k][0] != "p":
                    break
        if tag in VOID:
            continue
        _, above, in_article, headline = stack[-1]
        zone, inside = (CHROME, in_article) if above == CHROME else _zone(tag, found[3], above, in_article)
        if zone != above and tag in INLINE:
            settle()
        opened[tag] += 1
        stack.append((tag, zone, inside, headline or tag == "h1"))
    settle()
    told = {z: sum(len(t.split(" ")) for zone, t in out if zone in z) for z in ((RESCUED,), (MAIN, BODY))}
    rescued = MAIN if told[RESCUED,] > told[MAIN, BODY] else CHROME
    return [(rescued if z == RESCUED else CHROME if z == NAMED else z, t) for z, t in out]


def host_of(url: str | None) -> str:
    found = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", url or "")
    return found[1].lower() if found else ""


def stream(found: list[tuple[int, str]]) -> list[str]:
    """Words of the blocks outside the article, in page order."""
    return [w for zone, text in found if zone != MAIN for w in text.split(" ")]


def prefixes(words: list[str], depth: int) -> list[int]:
    """Hash of the first ``depth`` words of each suffix that has so many."""
    return [xxhash.xxh3_64_intdigest(" ".join(words[k : k + depth])) - 2**63 for k in range(len(words) - depth + 1)]


def suffix_runs(pages: DataFrame, least_words: int, least_pages: int, url_col: str, html_col: str) -> DataFrame:
    """(host, print, prefix): the suffix prefixes of each distinct stream that lie in runs of enough streams.

    Only streams with undecided blocks are given out, as no other needs the answer; all streams are counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            rows = {}
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = blocks(page or "")
                words = stream(found)
                if len(words) >= least_words:
                    rows[host_of(url), xxhash.xxh3_128_hexdigest(" ".join(words))] = (any(z in JUDGED for z, _ in found), sorted(set(prefixes(words, least_words))))
            columns = [[k[0] for k in rows], [k[1] for k in rows], [v[0] for v in rows.values()], [v[1] for v in rows.values()]]
            kinds = [pa.string(), pa.string(), pa.bool_(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["host", "print", "asked", "prefixes"])

    streams = pages.select(F.col(url_col).alias("u"), F.col(html_col).alias("h")).mapInArrow(run, "host string, print string, asked boolean, prefixes array<long>")
    suffixes = checkpointed(streams.select("host", "print", "asked", F.explode("prefixes").alias("prefix")).distinct())
    runs = checkpointed(suffixes.groupBy("host", "prefix").agg(F.count("*").alias("pages"), F.max("asked").alias("asked")).where((F.col("pages") >= least_pages) & F.col("asked")).select("host", "prefix"))
    return suffixes.where("asked").join(runs, ["host", "prefix"]).groupBy("host", "print").agg(F.collect_list("prefix").alias("repeated"))


def main_text(pages: DataFrame, least_words: int = 6, least_pages: int = 3, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", broadcast_rows: int = 2000) -> DataFrame:
    """Per row: id, url, ``text`` and ``n_chars``. Repeats of at most ``broadcast_rows`` short streams are broadcast, more are joined by shuffle."""
    repeats = checkpointed(suffix_runs(pages, least_words, least_pages, url_col, html_col))
    kind = pages.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            hosts, prints, texts, open_ = [], [], [], []
            for url, page in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found = blocks(page or "")
                asked = any(z in JUDGED for z, _ in found)
                hosts.append(host_of(url) if asked else None)
                prints.append(xxhash.xxh3_128_hexdigest(" ".join(stream(found))) if asked else None)
                texts.append("\n".join(t for z, t in found if z == MAIN))
                open_.append([{"zone": z, "text": t} for z, t in found] if asked else None)
            block = pa.list_(pa.struct([("zone", pa.int32()), ("text", pa.string())]))
            columns = [batch.column(0), batch.column(1), pa.array(hosts, pa.string()), pa.array(prints, pa.string()), pa.array(texts, pa.string()), pa.array(open_, block)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "url", "host", "print", "text", "open"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            rows = batch.to_pylist()
            texts = [chosen(r["open"], set(r["repeated"] or ()), least_words) if r["open"] is not None else r["text"] for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])

    parsed = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(read, f"id {kind}, url string, host string, print string, text string, open array<struct<zone:int,text:string>>")
    few = repeats.limit(broadcast_rows + 1).count() <= broadcast_rows and repeats.where(F.size("repeated") > 5000).isEmpty()  # so at most 80 MB
    joined = parsed.join(F.broadcast(repeats) if few else repeats, ["host", "print"], "left")
    out = joined.select("id", "url", "text", "open", "repeated").mapInArrow(judge, f"id {kind}, url string, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))


def chosen(found: list[dict], repeated: set[int], depth: int) -> str:
    """Text of a page with blocks to judge: its article and the unique runs."""
    words = stream([(b["zone"], b["text"]) for b in found])
    covered = bytearray(len(words))
    for k, prefix in enumerate(prefixes(words, depth)):
        if prefix in repeated:
            covered[k : k + depth] = b"\1" * depth
    at, size, unique = 0, [], []
    for b in found:
        n = len(b["text"].split(" "))
        size.append(n)
        unique.append(b["zone"] == MAIN or 2 * sum(covered[at : at + n]) < n)
        at += n if b["zone"] != MAIN else 0
    told = lambda *zones: sum(n for b, n, own in zip(found, size, unique, strict=True) if own and b["zone"] in zones)
    kept = {MAIN, BODY, HEADLINE}
    if told(UNDECIDED) > told(MAIN, BODY):
        kept.add(UNDECIDED)
    whole = not told(MAIN, BODY, UNDECIDED)  # nothing but repeats: the body is what markup calls the text
    return "\n".join(b["text"] for b, own in zip(found, unique, strict=True) if b["zone"] in kept and own or whole and b["zone"] == BODY)
