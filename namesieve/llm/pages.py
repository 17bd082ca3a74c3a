"""Main text of web pages: site templates go, the article stays.

Every element subtree gets a hash of its content. Spark counts, for each host, on how many different pages a subtree occurs;
what recurs on many of them is the site's template and is deleted, together with elements whose tag, role or class
says that they are no article. Exact copies of a page count once, so a much-copied page is not taken for a template. Prose
blocks of an article (paragraphs, lists, tables) are template only if most of the otherwise different articles of a section
have them at the same place: many articles may share a passage, also a frequent one.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namesieve.llm.texts import mixed
from namesieve.plans.storage import written

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^'\">]|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>?", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br"}
#: Elements that are never part of an article.
APART = {"head", "nav", "header", "footer", "aside", "form", "button", "select", "input", "menu", "dialog", "svg", "object", "canvas", "audio", "video", *RAW}
APART_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
APART_WORDS = set(
    "ad ads advert adverts advertisement advertisements advertising banner sponsor sponsored promo sidebar menu nav navbar navigation breadcrumb breadcrumbs header masthead footer "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup login share sharing social related recommended comment comments disqus replies widget".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Inside an article these are prose: recurring ones may be shared passages.
PROSE = {"p", "ul", "ol", "li", "dl", "dt", "dd", "blockquote", "pre", "figure", "figcaption", "table", "thead", "tbody", "tr", "td", "th", "article", "main", *HEADINGS, *INLINE}
#: A start tag closes open elements of these kinds, up to a container.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_HOLDS = {"ul", "ol", "dl", "table", "select", "div", "section", "article", "main", "body", "td", "blockquote"}


class Page:
    """A tolerant tree of ``html``: per element its tag, class words, parent, last descendant and place in or out of an article."""

    def __init__(self, html: str):
        self.tags: list[str] = ["#page"]
        self.words: list[str] = [""]
        self.apart: list[bool] = [False]
        self.parent: list[int] = [-1]
        self.last: list[int] = [0]
        self.inside: list[bool] = [False]
        self.texts: list[tuple[int, str, int]] = []  # element, text, number of the block
        self.block = 0
        self._read(html)

    def _open(self, stack: list[int], tag: str, attributes: str) -> int:
        node, top = len(self.tags), stack[-1]
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if "=" in attributes else {}
        names = f"{found.get('class', '')} {found.get('id', '')}".strip()
        words = {w.lower() for w in _WORD.findall(names)} if names else set()
        whole = tag in ("html", "body", "main", *HEADINGS)
        hinted = bool(words & APART_WORDS) and not whole and (tag != "article" or bool(words & {"comment", "ad", "advert", "sponsored"}))
        self.tags.append(tag)
        self.words.append(names)
        self.apart.append(tag in APART or hinted or (found.get("role", "").lower() in APART_ROLES and not whole))
        self.parent.append(top)
        self.last.append(node)
        main = tag in ("article", "main") or found.get("role", "").lower() in ("main", "article")
        self.inside.append(self.inside[top] or main and not self.apart[-1])
        return node

    def _read(self, html: str) -> None:
        stack, at, size = [0], 0, len(html)

        depths: dict[str, list[int]] = {}  # of the open elements of a tag, so that no tag walks the open ones

        def deepest(tags) -> int:
            return max((depths[t][-1] for t in tags if depths.get(t)), default=0)

        def close(depth: int) -> None:
            for node in reversed(stack[depth:]):
                self.last[node] = len(self.tags) - 1
                depths[self.tags[node]].pop()
            del stack[depth:]

        while at < size:
            m = _TOKEN.search(html, at)
            text = html[at : m.start()] if m else html[at:]
            if text:
                self.texts.append((stack[-1], text, self.block))
            if not m:
                break
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if tag == "br":
                self.texts.append((stack[-1], " ", self.block))
                continue
            if tag not in INLINE:
                self.block += 1
            if m[1] or m[4]:
                if depth := deepest((tag,)):
                    close(depth)
                continue
            shut = _CLOSES.get(tag, frozenset()) | (frozenset() if tag in INLINE else {"p"})
            if shut and (depth := deepest(shut)) and depth >= deepest(_HOLDS):
                close(depth)
            node = self._open(stack, tag, m[3] or m[6] or "")
            if tag in VOID:
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
                at = end.end() if end else size
                continue
            depths.setdefault(tag, []).append(len(stack))
            stack.append(node)
        close(1)

    def hashes(self) -> list[int]:
        """64-bit hash of each subtree: tags, class words and text, white space folded."""
        own: list[list[bytes]] = [[f"{t}\x00{w}\x00".encode()] for t, w in zip(self.tags, self.words)]
        for node, text, _ in self.texts:
            if folded := " ".join(text.split()):
                own[node].append(folded.encode("utf-8", "surrogatepass"))
        out = [0] * len(self.tags)
        for node in range(len(self.tags) - 1, 0, -1):
            digest = hashlib.blake2b(b"\x01".join(own[node]), digest_size=8).digest()
            out[node] = int.from_bytes(digest, "little", signed=True)
            own[self.parent[node]].append(digest)
        return out

    def keys(self, found: list[int]) -> dict[int, list[tuple[int, int]]]:
        """What is counted for each element that can be template: pairs of a hash and the hash of the article it is in, 0 for none.

        Containers count by their subtree, on pages. Prose of an article counts by its subtree and place, which is the path
        to it and its number among its siblings, from the first and from the last, in articles. ``found``: ``hashes()``.
        """
        n = len(self.tags)
        number, size = [0] * n, [0] * n
        for i in range(1, n):
            number[i] = size[self.parent[i]]
            size[self.parent[i]] += 1
        path, article = [b""] * n, [0] * n
        out = {}
        for i in range(1, n):
            up = self.parent[i]
            path[i] = hashlib.blake2b(path[up] + f"{self.tags[i]}\x00{self.words[i]}".encode("utf-8", "surrogatepass"), digest_size=8).digest()
            article[i] = article[up] or (found[i] if self.inside[i] else 0)
            if self.apart[i] or self.tags[i] in ("html", "body", "article", "main", "h1", *INLINE):
                continue
            if not (self.inside[i] and self.tags[i] in PROSE):
                out[i] = [(found[i], 0)]
            elif found[i] != article[i]:
                places = (number[i], number[i] - size[up])
                digests = (hashlib.blake2b(path[i] + struct.pack("<qq", found[i], at), digest_size=8).digest() for at in places)
                out[i] = [(int.from_bytes(d, "little", signed=True), article[i]) for d in digests]
        return out

    def text(self, template: frozenset[int] = frozenset(), own: dict[int, list[tuple[int, int]]] | None = None) -> str:
        """Blocks of the articles without what is apart or template, one per line.

        If the articles hold less than half of such text, blocks of the whole body: they are teasers then.
        """
        n = len(self.tags)
        gone = list(self.apart)
        if template:
            for i, keys in (own or self.keys(self.hashes())).items():
                gone[i] = gone[i] or any(key in template for key, _ in keys)
        for i in range(1, n):
            gone[i] = gone[i] or gone[self.parent[i]]
        size = [0, 0]
        for node, text, _ in self.texts:
            if not gone[node]:
                size[self.inside[node]] += len("".join(text.split()))
        articles = any(self.inside) and size[True] >= size[False]
        blocks: dict[int, list[str]] = {}
        for node, text, block in self.texts:
            if not gone[node] and (self.inside[node] or not articles):
                blocks.setdefault(block, []).append(text)
        lines = (" ".join(entities.unescape("".join(parts)).split()) for parts in blocks.values())
        return "\n".join(x for x in lines if x)


def host_of(url: F.Column) -> F.Column:
    """Host of a URL in lower case, without a port; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def section_of(url: F.Column) -> F.Column:
    """Folder of a URL's path; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*/)", 1), F.lit(""))


def _copies(pages: DataFrame) -> DataFrame:
    """``pages`` with ``__host``, ``__section`` and ``__copy``, a hash that equal html shares."""
    return pages.withColumns({"__host": host_of(F.col("url")), "__section": section_of(F.col("url")), "__copy": F.xxhash64(F.coalesce("html", F.lit("")))})


#: As many templates go to all tasks; more are joined with the pages by host and copy, which shuffles html.
HELD_TEMPLATES = 1_000_000


def _salted(keys: np.ndarray, host: str) -> np.ndarray:
    """Hashes of ``keys`` on ``host``."""
    salt = int.from_bytes(hashlib.blake2b(host.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    return mixed(keys.view(np.uint64) ^ np.uint64(salt)).view(np.int64)


def templates(pages: DataFrame, least_pages: int = 5, least_articles: int = 20) -> tuple[DataFrame, DataFrame]:
    """``__host`` and ``key`` of what is template, and the elements seen: ``__host``, ``__copy``, ``key``.

    ``pages`` has the columns of ``_copies``. Template is what is on at least ``least_pages`` different pages of a host; the
    number grows by one for each doubling of the host's pages beyond ten times as many. Prose is template if more than half of
    the different articles of a section, and at least ``least_articles``, have it at one place. Pages with equal html are one
    page, equal articles one article.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, articles = [], [], []
            for row, text in enumerate(batch.column("html")):
                page = Page(text.as_py() or "")
                own = {pair for pairs in page.keys(page.hashes()).values() for pair in pairs} | {(0, 0)}  # 0: the page itself
                rows.extend([row] * len(own))
                keys.extend(key for key, _ in own)
                articles.extend(article for _, article in own)
            at = pa.array(rows, pa.int64())
            names = ["__host", "__section", "__copy"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in names), pa.array(keys, pa.int64()), pa.array(articles, pa.int64())], names=[*names, "key", "article"])

    schema = "__host string, __section string, __copy bigint, key bigint, article bigint"
    seen = written(pages.select("__host", "__section", "__copy", "html").mapInArrow(run, schema), "subtrees")
    # The key 0 counts the pages of a host.
    counts = seen.where("article = 0").select("__host", "key", "__copy").distinct().groupBy("__host", "key").count()
    counts = written(counts.where(F.col("count") >= F.when(F.col("key") == 0, 1).otherwise(least_pages)), "subtree-counts")
    whole = counts.where("key = 0").select("__host", F.col("count").alias("pages"))
    grown = least_pages + F.greatest(F.lit(0.0), F.log2(F.col("pages") / (10 * least_pages)))
    often = counts.where("key <> 0").join(whole, "__host").where(F.col("count") >= grown).select("__host", "key")

    prose = seen.where("article <> 0").select("__host", "__section", "key", "article").distinct()
    places = prose.groupBy("__host", "__section", "key").count().where(F.col("count") >= least_articles)
    articles = prose.select("__host", "__section", "article").distinct().groupBy("__host", "__section").agg(F.count("*").alias("articles"))
    most = places.join(articles, ["__host", "__section"]).where(2 * F.col("count") > F.col("articles")).select("__host", "key")
    return written(often.unionByName(most).distinct(), "templates"), seen.select("__host", "__copy", "key")


def extract(pages: DataFrame, least_pages: int = 5, least_articles: int = 20, held: int = HELD_TEMPLATES) -> DataFrame:
    """Main text of every page: ``page_id``, ``url``, ``text``, ``n_chars``, one row per row of ``pages`` (``page_id``, ``url``, ``html``).

    Null html is empty and has an empty text; a null or odd url belongs to the empty host. Broken markup is read as browsers
    would: unclosed elements end with their container, and deep or unclosed markup takes linear time. Repeated rows give repeated results, an empty table none; other
    columns are ignored.
    """
    pages = pages.select("page_id", "url", "html")
    known = _copies(pages)
    often, seen = templates(known, least_pages, least_articles)
    schema = T.StructType([*pages.schema.fields[:2], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    if often.count() <= held:
        at_hand = np.unique(np.array([_salted(np.array([r["key"]], dtype=np.int64), r["__host"])[0] for r in often.toLocalIterator()], dtype=np.int64))
        rows = known.select("page_id", "url", "html", "__host")
    else:
        at_hand = None
        hits = seen.join(often, ["__host", "key"]).groupBy("__host", "__copy").agg(F.collect_set("key").alias("template"))
        rows = known.join(hits, ["__host", "__copy"], "left").select("page_id", "url", "html", "template")

    def text_of(html: str, more) -> str:
        page = Page(html or "")
        if at_hand is None:
            return page.text(frozenset(more or ()))
        if not len(at_hand):
            return page.text()
        own = page.keys(page.hashes())
        keys = np.array(sorted({key for pairs in own.values() for key, _ in pairs}), dtype=np.int64)
        return page.text(frozenset(keys[at_hand[np.minimum(np.searchsorted(at_hand, salted := _salted(keys, more)), len(at_hand) - 1)] == salted].tolist()), own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [text_of(html.as_py(), more.as_py()) for html, more in zip(batch.column("html"), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, schema)


def op2_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page of the table."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
