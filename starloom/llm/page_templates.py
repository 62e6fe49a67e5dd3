"""Main text of web pages by equivalence-class template deduction.

Tokens of a page are its elements (by the path of containers that they stand
in) and its text blocks (by path and content).  A token's occurrence vector is
how often it occurs on each page of the host; tokens with one vector form an
equivalence class.  Vectors are kept as commutative hashes, so they grow out
of a grouped aggregate and no host's pages ever meet in one task: each task adds
up what it has read before the shuffle, and a host with a third of all pages
costs a row per token and task.

Equal pages of a host are counted once here, so copies don't vote.  Classes of more than one token, nested in one another by path, that
cover ``SHARE`` of a host's different pages (``MIN_PAGES`` at least) are valid: their
elements are the template, and their text blocks are its constant text.  What
remains are slots.  A page's main slot is its
``article`` (or ``main``) element; on pages without one it is the innermost
container of the template that holds most of the host's running text.
Nothing inside an ``article`` (or ``main``) element is constant text.  Template text, menus, page headers, footers, sidebars, notices, adverts, forms,
comments, scripts and styles are not part of a slot; a class or form around the
page's main text itself is layout and marks nothing.

Inside a block white space becomes one blank; blocks are joined by a blank in
page order; character references are decoded; nothing else is dropped or cut.
NULL and empty pages have an empty text; a NULL or odd url belongs to the host
''; repeated rows each have their text.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import key_filter, staged

SHARE, MIN_PAGES = 0.6, 10
#: Share of the running text that the main slot of a template holds.
MAIN_SHARE = 0.7

# Element names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
             "strike strong sub sup time tt u var wbr img".split())
RAW = set("script style noscript template textarea iframe svg math object canvas xmp".split())
DROPPED = set("head title nav aside form footer menu dialog button select fieldset script style noscript template textarea "
              "iframe svg math object canvas xmp".split())
MAIN = {"article", "main"}
#: Start tags that end an open element of the second kind.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}} | {t: {"p"} for t in (
              "article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())}
HOLDERS = set("article aside body div footer header main nav section table ul ol dl blockquote form".split())
#: Class, id and role names that mark what isn't the article, alone or together with words of KINDS only.
MARKS = set("ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies "
            "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar side "
            "menu nav navbar navigation breadcrumb breadcrumbs topbar masthead footer colophon copyright share sharing social "
            "related recommended recommendations comment comments commentlist respond reply replies disqus widget widgets "
            "toolbar pagination pager skip tracking".split())
#: Words that only say where or what kind of a thing it is ("site-footer", "share-buttons").
KINDS = set("a an the my our site page post entry article global main primary secondary top bottom left right upper lower inner outer "
            "first second third sticky fixed mobile desktop box block bar area list item items link links button buttons icon icons "
            "section wrap wrapper container holder group panel row inline text title header head form field policy banner message "
            "articles posts stories news more count thread template plugin us this by on slot unit".split())
#: Marks of what readers write, which may be longer than the article: never lifted.
REPLIES = set("comment comments commentlist respond reply replies disqus".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
    |<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)""", re.S | re.X)
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+")
_NONE = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!\s*important\s*)?(?:;|$)", re.I)


class Block:
    """A text block: where it stands, its text, what of it is in links, and
    whether something around it keeps it from the article."""

    __slots__ = ("path", "text", "link", "out", "main", "mark", "unit", "top")

    def __init__(self, path, text, link, out, main, mark=-1, unit=-1, top=False):
        self.path, self.text, self.link, self.out, self.main = path, text, link, out, main
        self.mark, self.unit, self.top = mark, unit, top


def _attributes(attrs: str) -> tuple[list[str], list[str], bool]:
    """Words of class, id and role, the marks among these names, and whether
    the element is hidden."""
    words: list[str] = []
    marks: list[str] = []
    hidden = False
    for a in _ATTR.finditer(attrs):
        name, value = a[1].lower(), a[2] or a[3] or a[4] or ""
        if name in ("class", "id", "role"):
            for one in value.lower().split():
                found = _WORD.findall(one)
                words += found
                named = [w for w in found if w in MARKS]
                if named and all(w in MARKS or w in KINDS for w in found):
                    marks += named
        elif name == "hidden":
            hidden = hidden or value.lower() != "false"
        elif name == "aria-hidden":
            hidden = hidden or value.lower() == "true"
        elif name == "style":
            hidden = hidden or bool(_NONE.search(value))
    return words, marks, hidden


def _lift(blocks: list[Block], marks: list[tuple[int, bool, bool]], units: list[int]) -> None:
    """Settle which blocks marks keep from the article.  A mark around the
    page's main text tells of the layout, so it is lifted: one around an article
    (or main) element longer than all unmarked text, or one that holds most of
    the running text and the page's heading (a form on a page without an article:
    most of the text)."""
    shown = [b for b in blocks if not b.out]
    groups: dict[tuple[int, int], list[int]] = {}
    clean = {True: 0, False: 0}
    for b in shown:
        n = len(b.text) - b.link
        if b.mark < 0:
            clean[b.main] += n
        else:
            g = groups.setdefault((b.mark, b.unit if b.unit >= 0 and units[b.unit] == b.mark else -1), [0, 0])
            g[0] += n
            g[1] += b.top
    whole = sum(clean.values()) + sum(n for n, _ in groups.values())
    lifted: set[int] = set()
    for (mark, unit), (n, top) in sorted(groups.items(), key=lambda x: -x[1][0]):
        chain, at, replies = [], mark, False
        while at >= 0:
            chain.append(at)
            replies = replies or marks[at][1]
            at = marks[at][0]
        if not replies and n and (n > (clean[True] or clean[False]) if unit >= 0 else n >= MAIN_SHARE * whole and (top or (marks[mark][2] and not clean[True]))):
            lifted.update(chain)
            break
    for b in shown:
        b.out = b.mark >= 0 and b.mark not in lifted


def parse(page: str | None) -> tuple[list[Block], list[str]]:
    """Text blocks in page order, and the paths of the elements that start
    blocks, in order."""
    blocks: list[Block] = []
    paths: list[str] = []
    if not page:
        return blocks, paths
    stack: list[tuple[str, str, bool, bool, int, int]] = []  # name, path, out, main, mark, unit
    marks: list[tuple[int, bool, bool]] = []  # the mark around it, of readers' words, a form
    units: list[int] = []  # article and main elements: the mark around each
    top = True
    buf: list[str] = []
    link = 0

    def flush() -> None:
        nonlocal link, top
        if buf:
            text = " ".join("".join(buf).split())
            if text:
                name, path, out, main, _, unit = next((x for x in reversed(stack) if x[0] not in INLINE), ("", "", False, False, -1, -1))
                out = out or any(x[2] for x in stack)
                first = name == "h1" and top and not out
                top = top and not first
                blocks.append(Block(path, text, min(link, len(text)), out, main, stack[-1][4] if stack else -1, unit, first))
            buf.clear()
            link = 0

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        end = m.start() if m else n
        if end > at:
            piece = htmllib.unescape(page[at:end])
            buf.append(piece)
            if any(x[0] == "a" for x in stack):
                link += len(piece.strip())
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:  # an end tag
            if any(x[0] == name for x in stack):
                if name not in INLINE:
                    flush()
                while stack.pop()[0] != name:
                    pass
            elif name == "p":
                flush()
            continue
        if name not in INLINE:
            flush()
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in CLOSES.get(name, ()):
                del stack[i:]
                break
            if stack[i][0] in HOLDERS:
                break
        if name in VOID:
            continue
        if name in RAW:  # no markup inside, up to its own end tag
            stop = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else n
            continue
        attrs = m[3] or m[6] or ""
        up = stack[-1] if stack else ("", "", False, False, -1, -1)
        label, marked, hidden, mark, unit = name, [], False, up[4], up[5]
        if attrs and name not in ("html", "body"):  # what is said of the whole page tells nothing of its parts
            words, marked, hidden = _attributes(attrs)
            if words:
                label = f"{name}.{'.'.join(words[:3])}"
        main = up[3] or (name in MAIN and not marked and not hidden)
        out = up[2] or (name in DROPPED and name != "form") or (hidden and name not in MAIN) or (name == "header" and not main)
        if name in MAIN:
            if not marked and not hidden and (unit < 0 or units[unit] != mark):
                units.append(mark)
                unit = len(units) - 1
            elif marked and mark >= 0 and not REPLIES.isdisjoint(marked):
                marks.append((mark, True, False))
                mark = len(marks) - 1
        elif marked or name == "form":
            marks.append((mark, not REPLIES.isdisjoint(marked), name == "form"))
            mark = len(marks) - 1
        path = up[1] if name in INLINE else f"{up[1]}/{label}"
        stack.append((name, path, out, main, mark, unit))
        if name not in INLINE:
            paths.append(path)
    flush()
    if marks:
        _lift(blocks, marks, units)
    return blocks, paths


def _token(block: Block) -> str:
    """A text block as a template token; counters in it don't matter."""
    return f"#{block.path}\n{re.sub('[0-9]+', '0', block.text)}"


def _vectors(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per host and token, over the pages of a task: pages, occurrence vector,
    running text (not in links) of an element and all below it."""
    total: dict[tuple[str, str], list[int]] = {}

    def frame() -> pd.DataFrame:
        return pd.DataFrame([(h, t, *v) for (h, t), v in total.items()], columns=["host", "token", "pages", "vector", "running"])

    for pdf in rows:
        for key, host, page in zip(pdf["key"], pdf["host"], pdf["html"]):
            blocks, paths = parse(page)
            seen: dict[str, list[int]] = {"": [1, 0]}
            for p in paths:
                seen.setdefault(p, [0, 0])[0] += 1
            for b in blocks:
                if b.out:
                    continue
                if not b.main:
                    seen.setdefault(_token(b), [0, 0])[0] += 1
                p = b.path
                while p:
                    seen.setdefault(p, [0, 0])[1] += len(b.text) - b.link
                    p = p.rpartition("/")[0]
                seen[""][1] += len(b.text) - b.link
            for t, (n, running) in seen.items():
                if t[:1] == "#" and len(t) > 400:  # as a hash: long ones are told apart just as well
                    t = f"#{xxhash.xxh3_128_hexdigest(t)}"
                v = total.setdefault((host, t), [0, 0, 0])
                v[0] += 1
                v[1] ^= xxhash.xxh3_64_intdigest(f"{key}:{n}") - (1 << 63)
                v[2] += running
            if len(total) > 200_000:
                yield frame()
                total.clear()
    if total:
        yield frame()


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit("")))


def _distinct(pages: DataFrame) -> DataFrame:
    """(key, host, html) of every different page of a host."""
    rows = pages.select(F.xxhash64("host", "html").alias("key"), "host", "html")
    # only pages that may have copies are shuffled
    copied = key_filter(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "key")
    rows = rows.withColumn("hit", copied(F.col("key")))
    return rows.filter("not hit").unionByName(rows.filter("hit").dropDuplicates(["key"])).drop("hit")


def templates(pages: DataFrame) -> DataFrame:
    """(host, classes): the valid classes of every host as a list of token
    lists with the running text below each element."""
    vectors = staged(_distinct(pages).mapInPandas(_vectors, "host string, token string, pages long, vector long, running long")
                     .groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"),
                                                   F.sum("running").alias("running")), "vectors")
    hosts = vectors.filter("token = ''").select("host", F.col("pages").alias("all_pages"))
    valid = vectors.join(hosts, "host").filter((F.col("pages") >= MIN_PAGES) & (F.col("pages") >= SHARE * F.col("all_pages")))
    # a class: tokens of a host with one occurrence vector.  Tokens on SHARE of the pages are few: a page has so many at most
    classes = valid.groupBy("host", "vector", "pages").agg(F.array_sort(F.collect_list(F.struct("token", "running"))).alias("tokens"))
    return classes.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("pages", "tokens"))).alias("classes"))


class Template:
    """What a host's valid classes say about its pages."""

    def __init__(self, classes):
        tokens = [t for c in (classes if classes is not None else ()) if len(c["tokens"]) > 1 for t in c["tokens"]]
        self.text = {t["token"] for t in tokens if t["token"][:1] == "#"}
        running = {t["token"]: t["running"] for t in tokens if t["token"][:1] != "#"}
        whole = running.pop("", 0)
        # the innermost element of the nested template that holds most of the running text
        self.main = max((p for p, n in running.items() if n >= MAIN_SHARE * whole and n), key=lambda p: (p.count("/"), p), default="")

    def constant(self, block: Block) -> bool:
        t = _token(block)
        return (t if len(t) <= 400 else f"#{xxhash.xxh3_128_hexdigest(t)}") in self.text


def main_text(page: str | None, template: Template) -> str:
    blocks, _ = parse(page)
    kept = [b for b in blocks if not b.out]
    inside = [b for b in kept if b.main]
    if not inside and template.main:
        inside = [b for b in kept if b.path == template.main or b.path.startswith(f"{template.main}/")]
    return " ".join(b.text for b in (inside or kept) if b.main or not (template.text and template.constant(b)))


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, Template] = {}
    for pdf in batches:
        texts = []
        for host, page, classes in zip(pdf["host"], pdf["html"], pdf["classes"]):
            if host not in known:
                if len(known) > 1000:
                    known.clear()
                known[host] = Template(classes)
            texts.append(main_text(page, known[host]))
        yield pdf[["page_id", "url"]].assign(text=texts)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url and the main text."""
    rows = pages.select("page_id", "url", host_of(F.col("url").cast("string")).alias("host"), F.col("html").cast("string").alias("html"))
    found = staged(templates(rows), "templates")
    kinds = dict(pages.dtypes)
    return rows.join(found, "host", "left").select("page_id", "url", "host", "html", "classes") \
        .mapInPandas(_extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


def digest(pages: DataFrame) -> DataFrame:
    """The query's columns."""
    return extract_main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
