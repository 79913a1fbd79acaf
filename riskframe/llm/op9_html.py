"""Main-text extraction by union-free regular-expression inference per host.

A page is a stream of blocks; each block has a signature (the path of block elements
around it) and a text. Runs and repeated groups of signatures fold into ``(...)+``, so a
page becomes a short expression without unions. The distinct expressions of a host are
aligned one after the other: items that agree are merged, a repeat of an item makes it a
repeated group, and what only one side has becomes optional. The result is the host's
wrapper. A block's text is a slot if it differs between pages; a text that stands in the
same place of every page (``CONSTANT_PAGES`` different pages at least) is part of the
template. The main text is what stands in the wrapper's content slots: the ones below the
page's main element (``article``, else ``main``, else all of the body that is not mostly
links on the host), without menus, headers, footers, sidebars, notices, adverts, forms
and comments. Each page has its own main element: a host may mix templates.

Work on Spark: one scan reduces pages to expressions and block counts, which are
aggregated by host before any task sees a host: a host with a third of all pages has no
more distinct expressions for it. Expressions of a host are first aligned in ``SALTS``
groups, then the groups' wrappers. Wrappers are joined to the pages by host (broadcast
only below ``BROADCAST_ROWS`` wrappers).

Text: character references are decoded, white space (``<br>`` too) inside a block is one
space, blocks are trimmed, empty ones dropped, and joined by one newline.

Defined results: null or empty html gives an empty text; a url without host groups under
the empty host; a page without any known element is one block of text; equal rows give
equal texts; extra columns are ignored. Unclosed elements end where HTML ends them.
"""

from __future__ import annotations

import html as html_lib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import docs_of, map_rows, materialize, table
from .op10_url import host_path

#: Parameters.
CONSTANT_PAGES, SALTS, BROADCAST_ROWS, MOST_LINKS = 20, 32, 20_000, 0.5

#: Elements that break text into blocks; others (b, a, span, ...) are part of a block.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
RAW = frozenset("script style noscript template iframe svg math object textarea select button title head".split())
#: A start tag of the key closes an open element of these names.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)} | {b: ("p",) for b in BLOCKS - {"p", "li", "dt", "dd", "tr", "td", "th", "body", "html", "head"}}
#: Where the search for an element to close stops.
SCOPES = frozenset("table ul ol dl div article section main body html nav aside form blockquote".split())
#: Elements, words of classes and ids, and roles that mark what is no article.
ASIDE_TAGS = frozenset("nav footer aside form menu dialog".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice pagination pager popup promo "
    "related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
ASIDE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu navigation search".split())

START = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*+))")
INSIDE = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+""")
HEAD_END = re.compile(r"(?=<(?!/?(?:base|head|link|meta|noscript|script|style|template|title)\b)[a-zA-Z])", re.I)
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+")


def marks(attributes: str) -> tuple[str, bool]:
    """(what an element's class and id add to its signature, whether they mark an aside)."""
    sig, aside = [], False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value = html_lib.unescape(a or b or c).lower()
        found = WORDS.findall(value)
        if name.lower() == "role":
            aside |= any(w in ASIDE_ROLES for w in found)
            if "main" in found:
                sig.append("@main")
        else:
            aside |= any(w in ASIDE_WORDS for w in found)
            sig += [("." if name.lower() == "class" else "#") + w for w in sorted(set(found))]
    return "".join(sig), aside


def tags(page: str, at: int, loose: bool) -> tuple[int, int, str, str, bool, bool] | None:
    """The next tag or comment from ``at``: (start, end, name or nothing, what stands inside,
    closing, loose). A page in which a tag's quotes are never closed is read loosely from
    there on: tags end at the next ``>``. Without one the rest is text. Each character is looked
    at a few times at most, whatever the page."""
    m = START.search(page, at)
    if not m:
        return None
    if not m[2]:
        end = page.find("-->" if m[0] == "<!--" else ">", m.end())
        return m.start(), len(page) if end < 0 else end + (3 if m[0] == "<!--" else 1), "", "", False, loose
    end = len(page) if loose else INSIDE.match(page, m.end()).end()
    if page[end:end + 1] != ">":
        loose, end = True, page.find(">", m.end())
        if end < 0:
            return None
    return m.start(), end + 1, m[2].lower(), page[m.end():end], bool(m[1]), loose


def blocks(page: str | None) -> list[tuple[str, str, float, bool]]:
    """(signature, text, share of characters in links, aside) of each block with text."""
    page = page or ""
    out: list[tuple[str, str, float, bool]] = []
    stack: list[tuple[str, str, bool]] = []  # block elements: name, signature, aside
    parts: list[str] = []
    link = chars = linked = 0
    at, raw, loose = 0, "", False

    def flush():
        nonlocal parts, chars, linked
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                aside = stack[-1][2] if stack else False
                out.append((">".join(s[1] for s in stack if s[0] not in ("html", "body")), text, linked / max(1, chars), aside))
        parts, chars, linked = [], 0, 0

    def close(names, scoped):
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if scoped and stack[i][0] in SCOPES:
                return

    while True:
        if raw:
            m = re.compile(rf"</{re.escape(raw)}\s*>", re.I).search(page, at)
            if not m and raw == "head":  # an unclosed head ends where the body or its text starts
                m = re.compile(r"(?=<body)", re.I).search(page, at) or HEAD_END.search(page, at)
            raw = ""
            if not m:
                break
            at = m.end()
        m = tags(page, at, loose)
        start, end, name, inner, closing, loose = m or (len(page), len(page), "", "", False, loose)
        piece = page[at:start]
        if piece:
            parts.append(piece)
            chars += len(piece)
            linked += len(piece) if link else 0
        if not m:
            break
        at = end
        if not name:
            continue
        if closing:
            if name in BLOCKS:
                flush()
                close((name,), False)
            elif name == "a":
                link = max(0, link - 1)
        elif name in RAW:
            if not inner.endswith("/"):
                raw = name
        elif name in BLOCKS and name not in VOID:
            flush()
            if name in CLOSES:
                close(CLOSES[name], True)
            sig, aside = marks(inner) if inner else ("", False)
            above = stack[-1][2] if stack else False
            inside = any(s[0] in ("article", "main") for s in stack)
            aside |= above or name in ASIDE_TAGS or name == "header" and not inside
            stack.append((name, name + sig, aside and name not in ("html", "body")))
        elif name in VOID:
            if name == "hr":
                flush()
            parts.append(" ")
        elif name == "a":
            link += 1
    flush()
    return out


# ---------------------------------------------------------------- expressions
# An item is (key, repeated, optional): key is a signature or a tuple of items.
def fold(signatures: list[str]) -> tuple:
    """Runs, then repeated groups of up to eight items, become repeated items."""
    items: list[tuple] = []
    for s in signatures:
        if items and items[-1][0] == s:
            items[-1] = (s, True, False)
        else:
            items.append((s, False, False))
    for size in range(2, 9):
        out: list[tuple] = []
        i = 0
        while i < len(items):
            group, n = items[i:i + size], 1
            while len(group) == size and [x[0] for x in items[i + n * size:i + (n + 1) * size]] == [x[0] for x in group]:
                n += 1
            if n > 1:
                merged = tuple((g[0], any(items[i + k * size + j][1] for k in range(n)), False) for j, g in enumerate(group))
                out.append((merged, True, False))
                i += n * size
            else:
                out.append(items[i])
                i += 1
        items = out
    return tuple(items)


def shape(key) -> object:
    """What must agree for two items to be merged: signatures, without repetitions."""
    return key if isinstance(key, str) else tuple(shape(x[0]) for x in key)


def merge(a: tuple, b: tuple) -> tuple:
    """The least expression without unions that covers both: a longest common
    subsequence of items is kept, everything else is optional."""
    ka, kb = [shape(x[0]) for x in a], [shape(x[0]) for x in b]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if ka[i] == kb[j] else max(best[i + 1][j], best[i][j + 1])
    out: list[tuple] = []

    def put(item):
        # a mismatch that repeats the item before it is a repetition, not an option
        if out and item[2] and shape(out[-1][0]) == shape(item[0]):
            out[-1] = (out[-1][0], True, out[-1][2])
        else:
            out.append(item)

    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and ka[i] == kb[j]:
            key = a[i][0] if isinstance(a[i][0], str) else tuple(
                (x[0], x[1] or y[1], x[2] or y[2]) for x, y in zip(a[i][0], b[j][0], strict=True))
            put((key, a[i][1] or b[j][1], a[i][2] or b[j][2]))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            put((a[i][0], a[i][1], True))
            i += 1
        else:
            put((b[j][0], b[j][1], True))
            j += 1
    return tuple(out)


def written(items: tuple) -> str:
    """The expression as text; ``#`` marks the text slot of a block."""
    out = []
    for key, repeated, optional in items:
        one = f"<{key}>#" if isinstance(key, str) else f"({written(key)})"
        sign = "*" if repeated and optional else "+" if repeated else "?" if optional else ""
        out.append(f"({one}){sign}" if sign and isinstance(key, str) else one + sign)
    return " ".join(out)


def leaves(items: tuple) -> list[str]:
    return [s for key, _, _ in items for s in ([key] if isinstance(key, str) else leaves(key))]


def dumps(items: tuple) -> str:
    import json

    return json.dumps(items)


def loads(text: str) -> tuple:
    import json

    def tuples(x):
        return tuple((y[0] if isinstance(y[0], str) else tuples(y[0]), y[1], y[2]) for y in x)

    return tuples(json.loads(text))


# ---------------------------------------------------------------- wrappers
SCANNED = "host string, expression string, content long, blocks array<struct<signature:string,text:long,chars:long,linked:double,aside:boolean>>"


def scan_pages(pages: DataFrame) -> DataFrame:
    """Per page its host, folded expression, a hash of its text, and its blocks."""
    def make():
        import xxhash

        def number(x: str) -> int:
            return xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63)

        def scan(cols):
            out = [[] for _ in range(4)]
            for url, page in zip(*cols, strict=True):
                found = blocks(page)
                out[0].append(host_path(url)[0])
                out[1].append(dumps(fold([b[0] for b in found])))
                out[2].append(number("\n".join(b[1] for b in found)))
                out[3].append([{"signature": s, "text": number(t), "chars": len(t), "linked": li * len(t), "aside": a} for s, t, li, a in found])
            return out

        return scan

    rows = docs_of(pages, "url", "html").select(F.col("url").cast("string"), F.col("html").cast("string"))
    return map_rows(rows, SCANNED, make)


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """Per host: the wrapper, the signatures of its content slots, and the template
    texts among them (hashes)."""
    scanned = materialize(scan_pages(pages), "html-scan")
    kinds = scanned.groupBy("host", "expression").agg(F.count(F.lit(1)).alias("n"))

    def align(t: pa.Table) -> pa.Table:
        rows = sorted(zip(t.column("n").to_pylist(), t.column("expression").to_pylist(), strict=True), key=lambda x: (-x[0], x[1]))
        wrapper: tuple | None = None
        for _, text in rows:
            items = loads(text)
            wrapper = items if wrapper is None else merge(wrapper, items)
        return pa.table({"host": pa.array([t.column("host")[0].as_py()], pa.string()), "expression": pa.array([dumps(wrapper)], pa.string()),
                         "n": pa.array([sum(r[0] for r in rows)], pa.int64())})

    shape_ = "host string, expression string, n long"
    salted = kinds.withColumn("salt", F.pmod(F.xxhash64("expression"), F.lit(SALTS)))
    wrappers = salted.groupBy("host", "salt").applyInArrow(align, shape_).groupBy("host").applyInArrow(align, shape_)

    each = scanned.select("host", "content", F.explode("blocks").alias("b")).select("host", "content", "b.*")
    # per (host, signature): characters, linked characters
    plain = ~F.col("aside")
    slots = each.where(plain).groupBy("host", "signature").agg(F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))

    def under(name):
        return F.concat(F.lit(">"), "signature", F.lit(">")).rlike(f">{name}[>.#@]") | (F.lit(name == "main") & F.col("signature").contains("@main"))

    level = F.when(under("article"), 3).when(under("main"), 2).when(F.col("linked") <= MOST_LINKS * F.col("chars"), 1).otherwise(0)
    # which level counts is up to each page: a host's pages may differ in their main element
    content = slots.withColumn("level", level).where("level > 0").groupBy("host").agg(
        F.sort_array(F.collect_set(F.struct("signature", "level"))).alias("slots"))
    # template texts: in the same slot of every page of the host
    hosts = scanned.groupBy("host").agg(F.countDistinct("content").alias("pages"))
    constant = each.where(plain).groupBy("host", "signature", "text").agg(F.countDistinct("content").alias("on"))
    constant = constant.where(F.col("on") >= CONSTANT_PAGES).join(hosts, "host").where(F.col("on") == F.col("pages"))
    constant = constant.groupBy("host").agg(F.sort_array(F.collect_set(F.concat_ws("\x1f", "signature", F.col("text").cast("string")))).alias("template"))
    return wrappers.join(content, "host", "left").join(constant, "host", "left").select(
        "host", "expression", "n", F.coalesce("slots", F.array().cast("array<struct<signature:string,level:int>>")).alias("slots"),
        F.coalesce("template", F.array().cast("array<string>")).alias("template"))


def main_text(page: str | None, slots: dict[str, int], template: frozenset) -> str:
    """The texts of the page's blocks in content slots (signature -> level) of the
    highest level that the page itself has."""
    import xxhash

    out = []
    found = [(sig, text) for sig, text, _, aside in blocks(page) if not aside and sig in slots]
    top = max((slots[sig] for sig, _ in found), default=0)
    for sig, text in found:
        if slots[sig] == top:
            if template:
                h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)
                if f"{sig}\x1f{h}" in template:
                    continue
            out.append(text)
    return "\n".join(out)


def extract(pages: DataFrame, wrappers: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): main text and its length."""
    wrappers = materialize(infer_wrappers(pages) if wrappers is None else wrappers, "html-wrappers")
    host = F.translate(F.coalesce(F.regexp_extract(F.col("url").cast("string"), r"(?s)^.*?://([^/?#]*)", 1), F.lit("")),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = docs_of(pages, "page_id", "url", "html").withColumn("host", host)
    known = wrappers.select("host", "slots", "template")
    joined = rows.join(F.broadcast(known) if wrappers.count() <= BROADCAST_ROWS else known, "host", "left")

    def make():
        memo: dict[str, tuple[dict, frozenset]] = {}

        def run(cols):
            texts = []
            for h, page, slots, template in zip(cols[2], cols[3], cols[4], cols[5], strict=True):
                if h not in memo:
                    if len(memo) > 10_000:
                        memo.clear()
                    memo[h] = {x["signature"]: x["level"] for x in slots or ()}, frozenset(template or ())
                texts.append(main_text(page, *memo[h]))
            return [cols[0], cols[1], texts, [len(t) for t in texts]]

        return run

    cols = joined.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "host", F.col("html").cast("string"), "slots", "template")
    return map_rows(cols, "page_id long, url string, text string, n_chars long", make)


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole html of every row of ``pages``."""
    return extract(table(spark, sf_dir, "pages"))
