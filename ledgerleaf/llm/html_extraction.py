"""Main text of web pages by template deduction over equivalence classes.

Pages of one host are filled in from one template, so the template's tokens occur in the same way in all of them. A token
is an element with its path (tags and class and id names from the root on) or a block's whole text at its path. Its
occurrence vector says how often it occurs in each page of the host. Tokens of one vector form an equivalence class. The
vector is never built: a sum of hashes of (page, times) over the pages stands for it, so tokens of any host are
combined before they are shuffled, and a host of a third of all pages is as many rows as its template has tokens.

A class is valid if it occurs in nearly all pages of its host (``SHARE``), and its tokens stand in one order in all of
them: a hash of its tokens in the order of the page is the same everywhere. Elements nest, so valid classes
do: the template of a host is the tree of its valid classes, from the class of what every page has once down. Slots are
what stands between its tokens. A text that is itself a token of the template is no data and goes, unless such texts make
up half of the host's articles (copies of one article). The slot of the article is the ``article`` or ``main`` element of
the root class with the most data, if there is one, and everything that is no other slot otherwise. Slots for menus,
headers, footers, sidebars, notices, adverts, forms and comments are known by their element or their class, id or role
names (fixed lists below), and, outside an article, slots that are mostly links over all pages of the host are menus.
Pages of hosts of fewer than ``LEAST_PAGES`` pages, for which nothing can be deduced, and pages that don't follow their
host's template are judged by the same rules on their own. Pages are read three times: for tokens, their order, and the text.

A host's template has at most as many tokens as 1 / ``SHARE`` times those of an average page: that is what meets a page.
Templates are broadcast if all of them are small (``BROADCAST_BYTES``), else joined by host, where the hosts of very many
pages are broadcast and the others shuffled. In the first case pages are never shuffled.

Defined cases: null and empty html has an empty text; a null url is a host of its own for each page; repeated rows are
pages each; a page cut off anywhere is read as far as it goes; broken nesting is closed as browsers do; an empty table
gives no rows; columns of other names stay away.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save

SHARE = 0.95  # of a host's pages that have a token of its template
LEAST_PAGES = 8  # of a host, to deduce anything
LINKS = 0.6  # of a slot's characters that are links, in a menu
COPIES = 0.5  # of a host's data that its template may take out of the article
BROADCAST_BYTES = 16 << 20
HOT_PAGES = 1000  # hosts that a broadcast may hold: each has more than this part of the pages

#: HTML elements by what they do.
RAW = "script style xmp iframe noembed noframes noscript template svg math textarea title select object canvas video audio"
VOID = "area base br col embed hr img input link meta param source track wbr"
INLINE = "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var"
FORMAT = "abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small strike strong sub sup time tt u var"
NO_TEXT = "nav aside footer form button dialog menu head"
#: Open elements that a start tag closes, up to the elements that hold them.
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "tbody": ("tr td th thead tbody tfoot", "table"), "tfoot": ("tr td th thead tbody", "table"), "option": ("option", "select")}
HOLDS_P = "table td th caption button html marquee object applet"
#: Words of class, id and role names.
NAMES_OUT = (
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social sidebar side aside widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs topbar masthead "
    "footer foot copyright comment comments commentlist respond reply replies disqus discussion related recommended recommendations recirculation outbrain taboola pagination pager "
    "search searchbox toolbar skip complementary contentinfo banner"
)
NAMES_HEADER = "header site-header page-header siteheader pageheader"
NAMES_IN = "article articlebody main content maincontent story entry post"

HEADER = 16  # a page's, unless it stands in an article
_OUT, _IN, _HEAD = set(NAMES_OUT.split()), set(NAMES_IN.split()), set(NAMES_HEADER.split())
_RAW, _VOID, _INLINE, _FORMAT, _NO_TEXT, _HOLDS_P = (set(x.split()) for x in (RAW, VOID, INLINE, FORMAT, NO_TEXT, HOLDS_P))
_CLOSES = {tag: (set(a.split()), set(z.split())) for tag, (a, z) in CLOSES.items()}
_MARKUP = re.compile(r"<(?:!--(?:>|->|.*?(?:--!?>|\Z))|([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"']*+)|[\"'])*+)(?:>|\Z)|/([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)|[!?/][^>]*+(?:>|\Z))", re.S)
_NAMED = re.compile(r"(?:^|[\s/\"'])(class|id|role|itemprop|hidden|aria-hidden)\b(?:\s*+=\s*+(?:\"([^\"]*+)|'([^']*+)|([^\s>\"']++)))?", re.I)
_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?|\Z", re.I | re.S) for tag in _RAW}
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

OUT, ROOT, COMMENT, HIDDEN, ARTICLE_TAG = 1, 2, 4, 8, 32


def _meaning(tag: str, attributes: str) -> tuple[str, int]:
    """(what stands in a path for the element, what it is)."""
    found = {n.lower(): a or b or c or "" for n, a, b, c in _NAMED.findall(attributes)} if attributes else {}
    names = " ".join(unescape(found[k]) for k in ("class", "id", "role", "itemprop") if k in found)
    label = tag + " " + " ".join(sorted(set(re.sub(r"[0-9]+", "", names).split()))) if names else tag
    words = {w.lower() for w in _PARTS.findall(names)}
    flags = 0
    if tag in _NO_TEXT or words & _OUT:
        flags |= OUT
    if words & {"comment", "comments", "commentlist", "respond", "replies", "disqus"}:
        flags |= COMMENT
    if tag in ("article", "main") or words & {"article", "articlebody", "main"} or _IN & {n.lower().replace("-", "").replace("_", "") for n in names.split()}:
        flags |= ROOT
    if tag == "article":
        flags |= ARTICLE_TAG
    if tag == "header" or {n.lower() for n in names.split()} & _HEAD:
        flags |= HEADER
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        flags |= HIDDEN
    return label, flags


class Page:
    """Elements (parent, path hash, flags) and blocks (element, text, characters in links) of a page, in page order."""

    def __init__(self, html: str, known: dict):
        self.up, self.path, self.flags = [-1], [0], [0]
        self.blocks: list[tuple[int, str, int]] = []
        stack, tags, text, links, depth_of_links, at, end = [0], ["#"], [], 0, 0, 0, len(html)
        owner = 0

        def flush() -> None:
            nonlocal links
            if text:
                joined = "".join(text)
                text.clear()
                if "&" in joined:
                    joined = unescape(joined)
                words = joined.split()
                if words:
                    self.blocks.append((owner, " ".join(words), links))
            links = 0

        def close(n: int) -> None:
            """Closes all but the first ``n`` open elements."""
            nonlocal depth_of_links, owner
            if any(t not in _INLINE for t in tags[n:]):
                flush()
            depth_of_links -= tags[n:].count("a")
            del stack[n:], tags[n:]
            if not text:
                owner = stack[-1]

        while at < end:
            m = _MARKUP.search(html, at)
            stop = m.start() if m else end
            if stop > at:
                piece = html[at:stop]
                if not text or owner != stack[-1] and not "".join(text).strip():
                    owner = stack[-1]
                elif self.flags[stack[-1]] & (OUT | HIDDEN) and stack[-1] != owner or self.flags[owner] & (OUT | HIDDEN) and stack[-1] != owner:
                    flush()  # what an inline element keeps out is a block of its own
                    owner = stack[-1]
                elif tags[-1] not in _INLINE:
                    owner = stack[-1]
                text.append(piece)
                if depth_of_links:
                    links += len("".join(piece.split()))
            if not m:
                break
            at = m.end()
            opened, closed = m.group(1), m.group(3)
            if closed:
                tag = closed.lower()
                if tag in _FORMAT or tag in _VOID:
                    if tag == "br":
                        text.append(" ")
                    continue
                for n in range(len(tags) - 1, 0, -1):
                    if tags[n] == tag:
                        close(n)
                        break
                    if tag in _INLINE and tags[n] not in _INLINE:
                        break
                continue
            if not opened:
                continue
            tag = opened.lower()
            if not html.endswith(">", 0, at):  # cut off inside a tag
                break
            if tag in _RAW:
                if not m.group(2).rstrip().endswith("/") or tag not in ("svg", "math"):
                    at = _ENDS[tag].search(html, at).end()
                text.append(" ")
                continue
            if tag in _VOID:
                if tag == "hr":
                    if "p" in tags:
                        self._close_p(tags, close)
                    flush()
                else:
                    text.append(" " if tag == "br" else "")
                continue
            if tag in _FORMAT and not m.group(2):
                continue
            if tag not in _INLINE:
                if "p" in tags:
                    self._close_p(tags, close)
                flush()
                if tag in _CLOSES:
                    ends, holds = _CLOSES[tag]
                    low = len(tags)
                    for n in range(len(tags) - 1, 0, -1):
                        if tags[n] in holds:
                            break
                        if tags[n] in ends:
                            low = n
                    if low < len(tags):
                        close(low)
                elif len(tag) == 2 and tag[0] == "h" and tags[-1][0] == "h" and tags[-1][1:].isdigit():
                    close(len(tags) - 1)
            elif tag == "a" and "a" in tags:
                close(len(tags) - 1 - tags[::-1].index("a"))
            if tag == "a":
                depth_of_links += 1
            if tag in _FORMAT and not _NAMED.search(m.group(2)):
                continue
            if tag in ("html", "body") and tag in tags:
                continue
            key = (self.path[stack[-1]], tag, m.group(2) if tag != "a" else "")
            if key not in known:
                if len(known) > 1 << 16:
                    known.clear()
                label, flags = _meaning(tag, key[2])
                known[key] = (xxhash.xxh64_intdigest(f"{key[0]}>{label}".encode("utf-8", "replace")) >> 1, flags)
            path, flags = known[key]
            if tag in ("html", "body"):
                flags = 0
            if tag in _FORMAT and not flags & (OUT | HIDDEN):
                continue
            self.up.append(stack[-1])
            self.path.append(path)
            self.flags.append(flags)
            stack.append(len(self.up) - 1)
            tags.append(tag)
            if tag not in _INLINE:
                owner = stack[-1]
        flush()

    @staticmethod
    def _close_p(tags: list[str], close) -> None:
        for n in range(len(tags) - 1, 0, -1):
            if tags[n] == "p":
                close(n)
                return
            if tags[n] in _HOLDS_P:
                return

    def text_token(self, element: int, text: str) -> int:
        return xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), self.path[element]) >> 1

    def dropped(self, template: dict[int, int] | None) -> list[bool]:
        """Elements whose content is no article, by their own names or their host's template."""
        size, data = len(self.up), [0] * len(self.up)
        for e, text, _ in self.blocks:
            data[e] += len(text)
        inside, whole = [bool(f & ROOT and not f & (OUT | COMMENT)) for f in self.flags], sum(data)
        for e in range(size - 1, 0, -1):  # children stand behind their parents
            data[self.up[e]] += data[e]
            inside[self.up[e]] |= inside[e]
        out, in_root = [False] * size, [False] * size
        for e in range(1, size):
            f, p = self.flags[e], self.up[e]
            in_root[e] = in_root[p] or bool(f & ROOT)
            own = bool(f & (OUT | HIDDEN))
            if f & HEADER and not in_root[e]:
                own = True  # the page's header, not the article's
            if own and not f & COMMENT and (inside[e] or 2 * data[e] > whole and f & ROOT):
                own = False  # a wrapper named after one of its parts
            if not own and template is not None and not in_root[e] and not inside[e]:
                own = template.get(self.path[e]) == MENU
            out[e] = own or out[p]
        return out

    def article(self, template: dict[int, int] | None) -> str:
        """Blocks of the article, joined by line feeds."""
        out = self.dropped(template)
        live = [(e, text, links) for e, text, links in self.blocks if not out[e]]
        roots = [e for e in range(1, len(self.up)) if not out[e] and template is not None and template.get(self.path[e]) == ARTICLE]
        if not roots:
            roots = self._roots(out, live)
        if roots:
            under = [False] * len(self.up)
            for e in range(1, len(self.up)):
                under[e] = under[self.up[e]] or e in roots
            live = [b for b in live if under[b[0]]]
        elif template is None:
            live = self._without_menus(live)
        if template is not None:
            data = [b for b in live if template.get(self.text_token(b[0], b[1])) != TEXT]
            live = data or live
        return "\n".join(text for _, text, _ in live)

    def _roots(self, out: list[bool], live: list[tuple[int, str, int]]) -> set[int]:
        """The element named as an article, or as holding one, with the most text; an ``article`` that has half of that goes before. None if they hold nothing."""
        data = [0] * len(self.up)
        for e, text, _ in live:
            data[e] += len(text)
        for e in range(len(self.up) - 1, 0, -1):
            data[self.up[e]] += data[e]
        named = [e for e in range(1, len(self.up)) if self.flags[e] & ROOT and not out[e] and data[e]]
        if not named:
            return set()
        best = max(named, key=lambda e: data[e])
        tagged = [e for e in named if self.flags[e] & ARTICLE_TAG and 2 * data[e] >= data[best]]
        return {max(tagged, key=lambda e: data[e], default=best)}

    def _without_menus(self, live: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
        sizes: dict[int, list[int]] = {}
        for e, text, links in live:
            own = sizes.setdefault(self.path[e], [0, 0])
            own[0] += len(text) - text.count(" ")
            own[1] += links
        kept = [b for b in live if sizes[self.path[b[0]]][1] <= LINKS * sizes[self.path[b[0]]][0]]
        return kept or live


TEXT, MENU, ARTICLE, OTHER = 1, 2, 3, 0  # what the template says of a token

def host_of(url: Column) -> Column:
    """The host of a url in lower case; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url.cast("string"), r"^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))



def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page and token: how often, its place of first sight, characters of data and of links below it, and whether it may be an article's element."""
    known: dict = {}
    for b in batches:
        rows: list[tuple] = []
        for page, host, html in zip(*(c.to_pylist() for c in b.columns)):
            if not html:
                continue
            p = Page(html, known)
            out = p.dropped(None)
            size, link = [0] * len(p.up), [0] * len(p.up)
            texts: dict[int, list[int]] = {}
            in_root = [False] * len(p.up)
            for e in range(1, len(p.up)):
                in_root[e] = in_root[p.up[e]] or bool(p.flags[e] & ROOT)
            for e, text, links in p.blocks:
                if not out[e]:
                    size[e] += len(text) - text.count(" ")
                    link[e] += links
                    texts.setdefault(p.text_token(e, text), [0, e, len(text), int(in_root[e])])[0] += 1
            for e in range(len(p.up) - 1, 0, -1):
                size[p.up[e]] += size[e]
                link[p.up[e]] += link[e]
            seen: dict[int, list[int]] = {}
            for e in range(1, len(p.up)):
                own = seen.setdefault(p.path[e], [0, e, 0, 0, 0 if out[e] else 2 if p.flags[e] & ARTICLE_TAG else int(bool(p.flags[e] & ROOT))])
                own[0] += 1
                own[2] += size[e]
                own[3] += link[e]
            rows += [(host, page, t, False, n, at, s, k, r, 0) for t, (n, at, s, k, r) in seen.items()]
            rows += [(host, page, t, True, n, at, s, 0, 0, r) for t, (n, at, s, r) in texts.items()]
        if rows:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 6]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["host", "page", "token", "is_text", "times", "at", "data", "links", "root", "inside"])


_TOKEN_ROWS = "host string, page long, token long, is_text boolean, times long, at long, data long, links long, root long, inside long"


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page and class of its host: in which order its tokens stand."""
    known: dict = {}
    for b in batches:
        rows = []
        for host, html, tokens, classes in zip(*(b.column(c).to_pylist() for c in ("host", "html", "tokens", "roles"))):
            if not html or tokens is None:
                continue
            p, of = Page(html, known), dict(zip(tokens, classes))
            places: dict[int, int] = {}
            for e, text, _ in reversed(p.blocks):
                places[p.text_token(e, text)] = e
            for e in range(len(p.up) - 1, 0, -1):
                places[p.path[e]] = e
            order: dict[int, list[tuple[int, int]]] = {}
            for token, e in places.items():
                if token in of:
                    order.setdefault(of[token], []).append((e, token))
            rows += [(host, c, xxhash.xxh64_intdigest(repr([token for _, token in sorted(own)])) >> 1) for c, own in order.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))], names=["host", "class", "order"])


def _with_template(pages: DataFrame, known: DataFrame) -> DataFrame:
    """``pages`` (host, ...) with tokens and roles of their host, null where there are none."""
    size = known.agg(F.sum(F.size("tokens") * 16 + F.length("host"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return pages.join(F.broadcast(known), "host", "left")
    counts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    share = max(1, (counts.agg(F.sum("n")).first()[0] or 0) // HOT_PAGES)
    hot = F.broadcast(known.join(counts.where(F.col("n") > share).select("host"), "host"))  # at most HOT_PAGES
    rest = pages.join(hot.select("host"), "host", "left_anti").join(known, "host", "left")
    return pages.join(hot, "host").unionByName(rest)


def templates(pages: DataFrame) -> DataFrame:
    """pages (page, host, html) -> (host, tokens, roles): what each token of a host's template is: a constant text, a menu, the article, or something else."""
    rows = pages.where("host <> ''").mapInArrow(_tokens, _TOKEN_ROWS)
    per = rows.groupBy("host", "token", "is_text").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum(F.xxhash64("page", "times").cast("decimal(38,0)")).alias("vector"),
        F.max("times").alias("most"),
        F.avg("at").alias("at"),
        F.sum("data").alias("data"),
        F.sum("links").alias("links"),
        F.max("root").alias("root"),
        F.max("inside").alias("inside"),
    )
    sizes = pages.where("host <> '' AND html <> ''").groupBy("host").agg(F.count(F.lit(1)).alias("of")).where(F.col("of") >= LEAST_PAGES)
    often = save(per.join(sizes, "host").where(F.col("pages") >= SHARE * F.col("of")).withColumn("class", F.xxhash64("pages", "vector")), "template-tokens")
    classes = often.groupBy("host").agg(F.collect_list(F.struct("token", "class")).alias("t")).select("host", F.col("t.token").alias("tokens"), F.col("t.class").alias("roles"))
    orders = _with_template(pages.where("html <> ''"), save(classes, "template-classes")).select("host", "html", "tokens", "roles").mapInArrow(_orders, "host string, class long, order long")
    valid = orders.groupBy("host", "class").agg(F.min("order").alias("a"), F.max("order").alias("z")).where("a = z").select("host", "class")
    return often.join(valid, ["host", "class"]).groupBy("host").applyInArrow(_template, "host string, tokens array<long>, roles array<long>")


def _template(table: pa.Table) -> pa.Table:
    """A host's tokens, as many as 1 / SHARE average pages have, nested by their classes."""
    t = {c: table.column(c).to_pylist() for c in table.column_names}
    rows = range(table.num_rows)
    once = [i for i in rows if t["most"][i] == 1]
    roles = {t["token"][i]: OTHER for i in rows}
    named = [i for i in once if t["root"][i] and not t["is_text"][i] and t["data"][i]]
    if named:
        most = max(t["data"][i] for i in named)
        tagged = [i for i in named if t["root"][i] == 2 and 2 * t["data"][i] >= most]
        roles[t["token"][max(tagged or named, key=lambda i: (t["data"][i], -t["at"][i]))]] = ARTICLE
    for i in rows:
        if not t["is_text"][i] and not t["root"][i] and t["data"][i] and t["links"][i] > LINKS * t["data"][i]:
            roles[t["token"][i]] = MENU
    article = max((t["data"][i] for i in named), default=max((t["data"][i] for i in rows if not t["is_text"][i]), default=0))
    constant = [i for i in once if t["is_text"][i]]
    taken = sum(t["data"][i] for i in constant if t["inside"][i] or not named)
    if taken <= COPIES * article:
        roles |= {t["token"][i]: TEXT for i in constant}
    return pa.table({"host": pa.array([t["host"][0]], pa.string()), "tokens": pa.array([list(roles)], pa.list_(pa.int64())), "roles": pa.array([list(roles.values())], pa.list_(pa.int64()))})


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict = {}
    last, template = None, None
    for b in batches:
        texts = []
        html, tokens, roles = b.column("html"), b.column("tokens"), b.column("roles")
        for i in range(b.num_rows):
            page = html[i].as_py()
            if not tokens[i].is_valid:
                template = last = None
            else:
                key = tokens[i].values.to_numpy().tobytes()
                if key != last:
                    last, template = key, dict(zip(tokens[i].as_py(), roles[i].as_py()))
            texts.append(Page(page, known).article(template) if page else "")
        out = pa.array(texts, pa.string())
        chars = pa.array(np.fromiter(map(len, texts), np.int64, len(texts)))
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), out, chars], names=["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) -> page_id, url, text, n_chars: the article of each page."""
    given = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    known = save(templates(given.select(F.col("page_id").cast("long").alias("page"), "host", "html")), "templates")
    joined = _with_template(given, known)
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url {pages.schema['url'].dataType.simpleString()}, text string, n_chars long"
    return joined.select("page_id", "url", "html", "tokens", "roles").mapInArrow(_extract, schema)
