"""Main text of web pages by consensus paths of hosts.

Each page's containers are scored by the running text in and under them, less link text; the best one votes
for its path of tags and classes, digits generalised. Spark counts the votes by host, and each page is read
again with its host's winning path, or that of its own best container where the host's leads nowhere: all
containers on the path that hold running text, in page order.
"""

from __future__ import annotations

import collections
import functools
import hashlib
import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batch as rows_of, checkpoint, texts

# attributes are looked through for quotes that hide a ">" as far as this; behind it the next ">" ends a tag
QUOTED = r"(?:[^>\"']{1,4096}+|\"[^\"]{0,4096}+\"|'[^']{0,4096}+'){0,64}+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style|noscript|template|iframe|textarea|title|svg|math|object|select)\b{QUOTED}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attr>{QUOTED})>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attr2>[^>]*+)>"
    r"|<[!?][^>]*+>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
OUT = frozenset("nav header footer aside form button dialog menu head fieldset".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar side footer header masthead cookie cookies consent notice notices alert gdpr popup modal overlay comment comments disqus replies respond share sharing social related recommended recommendations newsletter subscribe subscription signup login widget pagination pager toolbar copyright disclaimer paywall".split()
)
# in a name of several words these tell that it only mentions such a part, and these that the first word names the part
MENTION = frozenset("has have no not with without is by and or open closed enabled disabled show hide hidden visible".split())
BOX = frozenset("list box section area block wrap wrapper container inner item items links group panel row col bar body thread".split())
TRUST, STAYS = (1.0, 0.7, 0.25, 0.25), (0.0, 0.4, 0.8, 0.8)  # by doubt: what text below is worth, and from what share of the article on it stays
CLOSES_P = frozenset("address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table div article section main body td th blockquote".split())
WORDS = re.compile(r"[A-Za-z][a-z]+|[A-Z]+(?![a-z])")
PROSE = frozenset("p pre blockquote li dd td h1 h2 h3 h4 h5 h6".split())


@functools.lru_cache(65_536)
def doubt(said: str) -> int:
    """How surely class and id name a part that is no article: 0 not at all, 1 mentioned, 2 the head of a name, 3 the name."""
    level = 0
    for name in said.split():
        words = [w.lower() for w in WORDS.findall(name)]
        if OUT_WORDS.isdisjoint(words):
            continue
        if OUT_WORDS.issuperset(words):
            return 3
        head = MENTION.isdisjoint(words) and (words[-1] in OUT_WORDS or words[0] in OUT_WORDS and words[-1] in BOX)
        level = max(level, 1 + head)
    return level


class Page:
    """Blocks of text in page order with their elements, and the elements' parents, paths and scores.

    Tags and roles, and names that say nothing else, put an element out. Names that only mention such a part make
    its text worth less; whether it is left out depends on its share of the article. If names leave nothing of a
    page, they put nothing out (``strict`` off)."""

    def __init__(self, html: str, strict: bool = True):
        self.tag, self.parent, self.path, self.out, self.box, self.doubt = ["#"], [-1], [""], [False], [0], [0]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self.trust = [1.0]
        stack, open_, pieces, link, at = [0], collections.Counter(), [], 0, 0
        linked, named = 0, False

        def flush():
            nonlocal pieces, linked
            if pieces:
                text = " ".join("".join(pieces).split())
                if text and not self.out[stack[-1]]:
                    self.blocks.append((self.box[stack[-1]], text, min(linked, len(text))))
            pieces, linked = [], 0

        def say(text):
            nonlocal linked
            if text:
                text = entities.unescape(text) if "&" in text else text
                pieces.append(text)
                linked += len(text) * bool(link)

        def close(k):
            nonlocal link
            for e in stack[k:]:
                open_[self.tag[e]] -= 1
                link -= self.tag[e] == "a"
            del stack[k:]

        def nearest(names, stop=frozenset()):
            """Where the nearest open element of these names is in the stack, 0 if none is or one of ``stop`` lies before it."""
            if any(open_[n] for n in names):
                for i in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[i]] in names:
                        return i
                    if self.tag[stack[i]] in stop:
                        return 0
            return 0

        end = html.rfind(">") + 1  # no tag ends behind it
        for m in TOKEN.finditer(html, 0, end):
            if m.start() > at:
                say(html[at : m.start()])
            at = m.end()
            name = m["tag"] or m["tag2"]
            if not name:
                if m["raw"]:
                    pieces.append(" ")
                continue
            name = name.lower()
            if m["end"] or m["end2"]:
                k = nearest((name,))
                if not k or name in INLINE and any(self.tag[e] not in INLINE for e in stack[k:]):
                    continue
                if name not in INLINE:
                    flush()
                close(k)
                continue
            if name == "br":
                pieces.append("\n")
                continue
            if name not in INLINE:
                flush()
                if name in CLOSES_P and (k := nearest(("p",), SCOPE)):
                    close(k)
                if name in SAME and (k := nearest(SAME[name], SCOPE - {"td", "th"})):
                    close(k)
            if name in VOID:
                continue
            attr = m["attr"] if m["tag"] else m["attr2"]
            label, out, level = name, self.out[stack[-1]] or name in OUT, 0
            if attr and attr.strip(" /"):
                found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attr)}
                out = out or "hidden" in found and found["hidden"] != "until-found" or found.get("aria-hidden") == "true" or found.get("role", "") in OUT_ROLES
                if name not in ("body", "html", "main", "article"):
                    level = doubt(f"{found.get('class', '')} {found.get('id', '')}")
                    if level == 3 and strict and not out:
                        out = named = True
                if found.get("class"):
                    label += "." + ".".join(sorted({re.sub(r"\d+", "#", c) for c in found["class"].split()}))
            if attr and attr.endswith("/") and name not in INLINE and name not in SCOPE and name not in PROSE:
                continue
            up, block = stack[-1], name not in INLINE
            path = self.path[up] + "/" + label if block else self.path[up]
            if len(path) > 1024:  # of a deep element: a digest, so that paths don't add up to the square of the depth
                path = "#" + hashlib.blake2b(path.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
            self.box.append(len(self.tag) if block else self.box[up])
            self.tag.append(name), self.parent.append(up), self.out.append(out), self.path.append(path)
            self.doubt.append(level), self.trust.append(min(self.trust[up], TRUST[level]))
            stack.append(len(self.tag) - 1)
            open_[name] += 1
            link += name == "a"
        say(html[at:])
        flush()
        if named and not self.blocks:
            self.__init__(html, strict=False)

    def scores(self) -> list[float]:
        """Each block's unlinked length, as far as trusted, for the containers above it, halved with each step up."""
        out = [0.0] * len(self.tag)
        for e, text, linked in self.blocks:
            prose = self.tag[e] in PROSE
            worth = max(0.0, len(text) - 2.0 * linked) * (1.0 if prose or len(text) > 80 else 0.4) * self.trust[e]
            up = self.box[self.parent[e]] if prose and e else e
            while worth > 0.5:
                out[up] += worth * (1.5 if self.tag[up] in ("article", "main") else 1.0)
                worth /= 2
                if not up:
                    break
                up = self.box[self.parent[up]]
        return out

    def best(self, path: str | None = None) -> int:
        """The best container, or the best on a path; -1 if there is none."""
        s = self.scores()
        of = [e for e in range(len(s)) if s[e] > 0 and (path is None or self.path[e] == path)]
        return max(of, key=lambda e: (s[e], -e)) if of else -1

    def text(self, top: int) -> str:
        """The blocks under an element and under the others on its path that hold running text, in page order, without
        the parts in them whose names put them in doubt and that hold too little of their text."""
        if top < 0:
            return ""
        s, n = self.scores(), len(self.tag)
        size = [0] * n
        for e, text, linked in self.blocks:
            size[e] += len(text) - linked
        for e in range(n - 1, 0, -1):
            size[self.parent[e]] += size[e]
        winner = [e == top or s[e] > 0 and self.box[e] == e and self.path[e] == self.path[top] for e in range(n)]
        holds = list(winner)  # a winner or one below
        for e in range(n - 1, 0, -1):
            holds[self.parent[e]] |= holds[e]
        of = [-1] * n  # the winner that an element belongs to
        for e in range(n):
            of[e] = e if winner[e] else of[self.parent[e]] if e else -1
            if of[e] >= 0 and self.doubt[e] and not holds[e] and size[e] < STAYS[self.doubt[e]] * size[of[e]]:
                of[e] = -1
        return "\n\n".join(t for e, t, _ in self.blocks if of[e] >= 0)


def host(url):
    """A URL's host without port and user, in lower case; null for none."""
    return F.lower(F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def _votes(pages: DataFrame) -> DataFrame:
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("n", pa.int64()), ("worth", pa.int64())])

    def run(batches):
        for b in batches:
            count: dict[tuple[str, str], list[int]] = {}
            for h, t in zip(b.column("host").to_pylist(), texts(b.column("html")).to_pylist()):
                page = Page(t)
                if (e := page.best()) >= 0:
                    c = count.setdefault((h, page.path[e]), [0, 0])
                    c[0] += 1
                    c[1] += round(page.scores()[e])
            yield rows_of(schema, [k[0] for k in count], [k[1] for k in count], [c[0] for c in count.values()], [c[1] for c in count.values()])

    return pages.where("host is not null").select("host", "html").mapInArrow(run, "host string, path string, n long, worth long")


def extract(pages: DataFrame, *, id: str = "page_id", url: str = "url", html: str = "html", small: int = 100_000) -> DataFrame:
    """(id, url, text, n_chars) of every page, from its whole html.

    A null or empty html, or one without text outside menus and the like, gives an empty text. Pages without a
    host in their url go by their own best container. Null ids, ties and repeated rows come back as they are;
    other columns are not read. Votes tie-break by total worth, then by path. Empty table: no rows.
    The winners, a row a host, go to every executor only if counted to be ``small`` at most; else pages meet them
    by host and a salt, so that a frequent host is dealt out.
    """
    p = pages.select(F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{html}`").cast("string").alias("html")).withColumn("host", host(F.col("url")))
    total = _votes(p).groupBy("host", "path").agg(F.sum("n").alias("n"), F.sum("worth").alias("worth"))
    won = total.groupBy("host").agg(F.max_by("path", F.struct("n", "worth", "path")).alias("path"))
    won = checkpoint(won)
    if won.count() <= small:
        read = p.join(F.broadcast(won), "host", "left")
    else:
        salts = 64
        dealt = won.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        read = p.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(salts)).cast("int")).join(dealt, ["host", "salt"], "left")
    schema = pa.schema([("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for b in batches:
            out = []
            for h, path in zip(texts(b.column("html")).to_pylist(), b.column("path").to_pylist()):
                page = Page(h)
                e = page.best(path) if path is not None else -1
                out.append(page.text(e if e >= 0 else page.best()))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), *rows_of(schema, out, [len(t) for t in out]).columns], names=["id", "url", "text", "n_chars"])

    kind = pages.schema[id].dataType.simpleString()
    return read.select("id", "url", "html", "path").mapInArrow(run, f"id {kind}, url string, text string, n_chars long").withColumnRenamed("id", id).withColumnRenamed("url", url)
