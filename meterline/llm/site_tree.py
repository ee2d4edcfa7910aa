"""Main text of web pages with a site style tree.

The pages of a host are merged into one style tree: a node is a path of elements with their classes. A node's
presentation importance is the entropy of its child sequences over the pages, its content importance the
entropy of its texts; both are 0 where every page shows the same and 1 where every page differs. Branches whose
two importances are low are the site's frame and are removed from each page that has them. Elements that
declare what they are (navigation, forms, adverts, comments, ...) are removed as such. A page that declares
its article is reduced to it; inside it an element declares itself by whole names only ("share-buttons", but not
"share-price"), a paragraph not at all. What the article holds is in the tree too, as nodes of its own, by path and, as
siblings, by their place on the path from its first and from its last block: the declaration weighs
against removal by a lower importance, a text goes only where that very text is on several pages of the host, and
an article that would lose all its text, or half of it by its siblings, keeps it.

Only counts by host, node and feature are shuffled, aggregated map-side, so one host may have any share of the
pages. Copies of a page, rows of one host with the same html, take part in the tree as one.

Null and empty html gives an empty text. A null or unreadable url belongs to the host without name. Broken
markup is read as browsers do: unclosed elements end with their parent, a lone "<" is text. Repeated rows give a
row each. An empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.storage import stored

FRAME_BELOW = 0.3  # importance under which a node belongs to the site's frame
ARTICLE_BELOW = 0.1  # the same for nodes inside a declared article
FRAME_PAGES = 5  # a node on fewer pages of its host tells nothing

# Fixed values of HTML and of common page markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math canvas object select".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
NOISE_TAGS = frozenset("nav header footer aside form menu dialog search button fieldset head".split()) | RAW
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
NOISE_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promotion promoted menu nav navbar navigation breadcrumb breadcrumbs sidebar footer masthead comment comments disqus respond reply replies notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login social share sharing related recommended widget toolbar pagination pager skip".split())
OPEN_WORDS = frozenset("article post entry story".split())  # beside one of these, "header" is the article's own
PART_WORDS = frozenset("area bar block body bottom box button buttons card cards container content form group icons inline inner item items left link links list modal outer panel post posts right row section slot thread title top unit wrap wrapper".split())  # say only how a part looks

_TOKEN = re.compile(r"""<(?:!--.*?(?:-->|\Z)|(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<more>(?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|[!?/][^>]*(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|\d+")


def _named_noise(name: str) -> bool:
    """A whole class or id that names frame: a listed word, and beside it only such and words for parts of a page."""
    words = {w.lower() for w in _WORD.findall(name)} - {w for w in _WORD.findall(name) if w.isdigit()}
    return bool(words & NOISE_WORDS) and words <= NOISE_WORDS | PART_WORDS


def _is_noise(tag: str, attributes: dict[str, str], article: bool = False) -> bool:
    """Whether an element declares itself no content; inside an article by its whole names, and not where it is a paragraph."""
    if tag in NOISE_TAGS:
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", ""):
        return True
    if attributes.get("role", "").lower() in NOISE_ROLES:
        return True
    if tag in ("html", "body", "main"):
        return False
    if article and tag != "article":
        return tag != "p" and any(_named_noise(name) for kind in ("class", "id") for name in attributes.get(kind, "").split())
    words = {w.lower() for name in ("class", "id") for w in _WORD.findall(attributes.get(name, ""))}
    if tag == "article":
        return bool(words & {"comment", "comments", "reply"})
    return bool(words & NOISE_WORDS) or ("header" in words and not words & OPEN_WORDS)


class Page:
    """A page's text blocks (path, declared noise, inside an article, text) and its nodes (path -> child tags)."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, bool, bool, str]] = []
        self.children: dict[str, list[str]] = {}
        # an open element: tag, path, noise, article
        self.stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]
        self.text: list[str] = []
        at, raw = 0, None
        for token in _TOKEN.finditer(source):
            if token.start() < at:
                continue  # inside a raw element
            self.text.append(source[at:token.start()])
            at = token.end()
            tag = token["tag"]
            if not tag:
                continue
            tag = tag.lower()
            if token["end"]:
                self._end(tag)
            elif tag in RAW:
                raw = re.compile(rf"</{tag}[\s/>]", re.I).search(source, at)
                at = source.find(">", raw.start()) + 1 if raw else len(source)
                at = at or len(source)
            else:
                self._start(tag, token["more"])
        self.text.append(source[at:])
        self._flush()

    def _flush(self) -> None:
        if self.text:
            words = html.unescape("".join(self.text)).split()
            self.text = []
            if words:
                _, path, noise, article = self.stack[-1]
                self.blocks.append((path, noise, article, " ".join(words)))

    def _start(self, tag: str, more: str) -> None:
        if tag in BLOCKS:
            self._flush()
            if any(e[0] == "p" for e in self.stack):
                self._pop("p")
            for other in CLOSES.get(tag, ()):
                self._close_within(other)
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        attributes = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(more)} if more else {}
        _, path, noise, article = self.stack[-1]
        if tag in BLOCKS:
            self.children.setdefault(path, []).append(tag)
            path = f"{path}/{tag}" + ("." + ".".join(sorted(attributes["class"].split())) if attributes.get("class") else "")
        noise = noise or _is_noise(tag, attributes, article)
        declared = tag in ("article", "main") or attributes.get("role") == "main" or attributes.get("itemprop") == "articleBody"
        self.stack.append((tag, path, noise, article or (declared and not noise)))

    def _end(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
            self._pop(tag)
        else:
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k][0] == tag:
                    self._split(k)
                    return
                if self.stack[k][0] in BLOCKS:
                    return

    def _split(self, k: int) -> None:
        """End an inline element; a change of noise within a block ends the text so far."""
        if self.stack[k][2] != self.stack[k - 1][2]:
            self._flush()
        del self.stack[k]

    def _pop(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] == tag:
                del self.stack[k:]
                return

    def _close_within(self, tag: str) -> None:
        """End an open item of the same list or table."""
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] == tag:
                del self.stack[k:]
                return
            if self.stack[k][0] in ("ul", "ol", "dl", "table", "menu"):
                return


INSIDE = "\n"  # begins the path of a node inside a declared article


def _article_nodes(blocks: list[tuple[str, str]]) -> list[tuple[str, str, str]]:
    """The nodes of each block of an article: its path, and as a sibling its place on that path from the first and from the last."""
    total, seen, out = Counter(path for path, _ in blocks), Counter(), []
    for path, _ in blocks:
        out.append((INSIDE + path, f"{INSIDE}{path}\t{seen[path]}", f"{INSIDE}{path}\t-{total[path] - seen[path]}"))
        seen[path] += 1
    return out


def main_text(source: str, frame: set[str] = frozenset()) -> str:
    """The page's article; ``frame`` are nodes of the site's frame."""
    blocks = Page(source).blocks
    whole = [(path, text) for path, noise, article, text in blocks if article and not noise]
    kept = [text for _, text in whole]
    if frame and whole:
        nodes = _article_nodes(whole)
        by_path = [i for i, (path, _, _) in enumerate(nodes) if path not in frame] or list(range(len(whole)))
        siblings = [i for i in by_path if frame.isdisjoint(nodes[i][1:])]
        if 2 * sum(len(kept[i]) for i in siblings) <= sum(len(kept[i]) for i in by_path):
            siblings = by_path  # most of it is shared: a version of other pages, no article with a frame in it
        kept = [kept[i] for i in siblings]
    if not kept:
        def framed(path: str) -> bool:
            parts = path.split("/")
            return any("/".join(parts[:k]) in frame for k in range(2, len(parts) + 1))
        kept = [text for path, noise, _, text in blocks if not noise and not (frame and framed(path))]
    return "\n".join(kept)


NODES = "key long, host string, path string, style long, content long"


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The style tree's input: each page's nodes with digests of their child sequence and of their text."""
    def digest(parts: list[str]) -> int:
        return xxhash.xxh3_64_intdigest("\0".join(parts)) - (1 << 63)
    for batch in batches:
        out: dict[str, list] = {"key": [], "host": [], "path": [], "style": [], "content": []}
        for key, host, source in zip(*(c.to_pylist() for c in batch.columns)):
            page = Page(source or "")
            inside = [(path, text) for path, noise, article, text in page.blocks if article and not noise]
            texts: dict[str, list[str]] = {}
            for path, noise, article, text in page.blocks:
                if not noise and not article:
                    texts.setdefault(path, []).append(text)
            for nodes, (_, text) in zip(_article_nodes(inside), inside):
                for node in nodes:
                    texts.setdefault(node, []).append(text)
            for node, own in texts.items():
                path = node.removeprefix(INSIDE).partition("\t")[0]
                for name, value in (("key", key), ("host", host), ("path", node),
                                    ("style", digest(page.children.get(path, []))), ("content", digest(own))):
                    out[name].append(value)
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.string() if k in ("host", "path") else pa.int64()) for k, v in out.items()],
                                         names=list(out))


def importance(nodes: DataFrame) -> DataFrame:
    """host, path, pages, presentation, content: entropies of the node's features over the host's pages."""
    features = nodes.select("host", "path", F.explode(F.array(
        F.struct(F.lit("style").alias("kind"), F.col("style").alias("value")),
        F.struct(F.lit("content").alias("kind"), F.col("content").alias("value")))).alias("f"))
    counts = features.groupBy("host", "path", "f").agg(F.count("*").alias("k"))
    part = F.col("k") * F.log(F.col("k"))

    def entropy(kind: str):
        mine = F.col("f.kind") == kind
        m, s = F.sum(F.when(mine, F.col("k"))), F.sum(F.when(mine, part))
        return F.when(m > 1, (F.log(m) - s / m) / F.log(m)).otherwise(F.lit(1.0))
    return counts.groupBy("host", "path").agg(F.sum(F.when(F.col("f.kind") == "style", F.col("k"))).alias("pages"),
                                              entropy("style").alias("presentation"), entropy("content").alias("content"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html)."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    keyed = pages.select("page_id", "url", "html", F.xxhash64(host, "html").alias("key"), host.alias("host"))
    nodes = stored(keyed.select("key", "host", "html").mapInArrow(_nodes, NODES).distinct(), "site-nodes")
    inside = F.col("path").startswith(INSIDE)
    below = F.when(inside, ARTICLE_BELOW).otherwise(FRAME_BELOW)
    low = (importance(nodes).where((F.col("pages") >= FRAME_PAGES) & (F.col("content") < below)
                                   & (F.col("presentation") < below)).select("host", "path"))
    framed = nodes.join(low, ["host", "path"])
    shared = (framed.where(inside).groupBy("host", "path", "content").agg(F.count("*").alias("k"))
              .where(F.col("k") >= FRAME_PAGES).select("host", "path", "content"))
    removed = (framed.where(~inside).select("key", "path")
               .unionByName(framed.where(inside).join(shared, ["host", "path", "content"], "left_semi").select("key", "path")))
    frames = stored(removed.groupBy("key").agg(F.collect_set("path").alias("frame")), "site-frames")  # copies share a key: a join that can split it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h or "", set(f or ())) for h, f in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])
    kinds = dict(pages.dtypes)
    return (keyed.join(frames, "key", "left").select("page_id", "url", "html", "frame")
            .mapInArrow(run, f"page_id {kinds['page_id']}, url string, text string, n_chars long"))
