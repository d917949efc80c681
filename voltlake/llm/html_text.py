"""Main text of web pages: what a site repeats on its pages goes, and what is no article by its markup."""

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..workspace import Workspace
from .skew import left_lookup
from .wordhash import release_memory, slices

# A subtree is a site's template if it is on at least so many pages with different main
# blocks, and on at least this share of all such pages of the host. Paragraphs, in which
# authors quote and repeat themselves, need a larger share.
MIN_PAGES = 4
MIN_SHARE = 0.01
MIN_PARAGRAPH_SHARE = 0.2

_BYTES_AT_ONCE = 4 << 20

# Names of HTML elements, and words of classes, ids and roles, by their part in a page.
_VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_UNSEEN = frozenset(
    "head script style noscript template iframe object svg math canvas audio video map textarea title "
    "noembed noframes xmp select datalist button dialog".split()
)
_FRAME = frozenset("nav footer aside form menu".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br td th".split()
)
_PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th tr figcaption".split())
_MAIN = frozenset(("article", "main"))
_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar toolbar alert dialog".split())
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc sitemap skip "
    "header masthead topbar footer foot bottombar copyright sidebar side rail widget widgets related recommended "
    "cookie cookies consent gdpr notice notices notification disclaimer alert popup modal overlay paywall newsletter "
    "subscribe subscription signup login search share sharing social follow "
    "comment comments commentlist reply replies respond discussion disqus".split()
)
_COMMENT_NAMES = frozenset("comment comments commentlist reply replies respond discussion disqus".split())
# Of those, what may stand in an article and in the class of its headings.
_ARTICLE_NAMES = frozenset("header masthead banner side rail".split())
# A class that begins so says what a page is like, not what the element is.
_ADJECTIVES = frozenset("no not non has with without is hide show".split())
# A start tag ends these open elements, up to one of the second set.
_ENDS = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr",)), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
}
_SCOPE = frozenset("body article main section div table td th button aside nav header footer form li dd".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?P<end>>|\Z)"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attributes2>[^>]*)(?P<end2>>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(?<![^\s/\"'])(class|id|role|hidden|aria-hidden)(?=[\s=/>]|\Z)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME_WORD = re.compile(r"[a-z0-9]+")

# How an element stands to the article: a form may hold the whole page, other frames do not.
_PLAIN, _FORM, _APART = 0, 1, 2


def _stands(name: str, attributes: str, in_main: bool) -> tuple[int, str]:
    """Whether an element is no part of the article by its name, class, id or role; and the main part that it opens."""
    opens = name if name in _MAIN else ""
    if name in _UNSEEN or name in _FRAME or (name == "header" and not in_main):
        return (_FORM if name == "form" else _APART), opens
    if name in ("html", "body", "main") or not attributes:
        return _PLAIN, opens
    usual = _NAMES - _ARTICLE_NAMES if in_main or name in _PARAGRAPHS else _NAMES
    for match in _ATTRIBUTE.finditer(attributes):
        what = match[1].lower()
        value = html.unescape(match[2] or match[3] or match[4] or "").lower()
        if what == "hidden" or (what == "aria-hidden" and value == "true"):
            return _APART, opens
        if what == "role":
            if value.strip() in _ROLES:
                return _APART, opens
            if value.strip() in _MAIN:
                opens = value.strip()
        if what in ("class", "id"):
            for token in value.split():
                words = _NAME_WORD.findall(token)
                if not words or words[0] in _ADJECTIVES:
                    continue
                if opens and words[0] in _COMMENT_NAMES or not opens and not usual.isdisjoint(words):
                    return _APART, opens
    return _PLAIN, opens


class _Element:
    __slots__ = ("name", "digest", "first_block", "text_seen", "frame", "main", "mute")

    def __init__(self, name: str, first_block: int, frame: int, main: str, mute: bool):
        self.name, self.first_block, self.frame, self.main, self.mute = name, first_block, frame, main, mute
        self.digest = hashlib.blake2b(name.encode("utf-8", "surrogatepass"), digest_size=8)
        self.text_seen = False


class Page:
    """The blocks of one page, and the hashes of its elements' subtrees.

    Reads any text: unclosed elements end with the one around them, closing tags without an
    opening one are passed over, a page may break off anywhere.
    """

    def __init__(self, text: str):
        self.blocks: list[str] = []
        self.is_frame: list[bool] = []
        # Whether a block lies in an article, in the main element only, or in neither.
        self.inside: list[str] = []
        # Hash, first block and the block after the last, of subtrees that may be a template.
        self.subtrees: list[tuple[int, int, int]] = []
        self._stack = [_Element("", 0, _PLAIN, "", False)]
        self._open_names: Counter = Counter()
        self._words: list[str] = []
        self._read(text)

    def _end_block(self) -> None:
        words = " ".join("".join(self._words).split())
        self._words.clear()
        if words:
            top = self._stack[-1]
            self.blocks.append(words)
            self.is_frame.append(top.frame != _PLAIN)
            self.inside.append(top.main)
            top.digest.update(b"\0" + words.encode("utf-8", "surrogatepass"))
            top.text_seen = True

    def _open(self, name: str, attributes: str) -> None:
        flows = name in _INLINE or name in _UNSEEN
        if not flows:
            self._end_block()
            self._close("p", _SCOPE)
        if name == "body":
            self._close("head")
        if name in _ENDS:
            names, scope = _ENDS[name]
            for other in names:
                self._close(other, scope)
        if name in ("br", "td", "th"):
            self._words.append(" ")
        if name in _VOID:
            return
        above = self._stack[-1]
        frame, opens = _stands(name, attributes, bool(above.main))
        if not (opens == "main" or (opens == "article" and above.frame == _FORM)):
            frame = max(frame, above.frame)
        # An article in the main element is the closer one.
        main = above.main if above.main == "article" else opens or above.main
        mute = flows and (above.mute or name in _UNSEEN or (frame != _PLAIN and above.frame == _PLAIN))
        self._stack.append(_Element(name, len(self.blocks), frame, main, mute))
        self._open_names[name] += 1

    def _close(self, name: str, scope: frozenset | None = None) -> None:
        """End the innermost element of that name, and those in it; none beyond an element in ``scope``."""
        if not self._open_names[name]:
            return
        if scope is not None:
            for e in reversed(self._stack):
                if e.name == name:
                    break
                if e.name in scope:
                    return
        while self._pop() != name:
            pass

    def _close_inline(self, name: str) -> None:
        """End an element in running text, unless paragraphs have begun in it."""
        if not self._open_names[name]:
            return
        for e in reversed(self._stack):
            if e.name == name:
                self._close(name)
                return
            if e.name not in _INLINE:
                return

    def _pop(self) -> str:
        top = self._stack[-1]
        flows = top.name in _INLINE or top.name in _UNSEEN
        if not flows:
            self._end_block()
        self._stack.pop()
        self._open_names[top.name] -= 1
        above = self._stack[-1]
        if not top.text_seen:
            return top.name
        above.text_seen = True
        above.digest.update(b"\1" + top.digest.digest())
        paragraph = top.name in _PARAGRAPHS
        if not (flows or top.name in ("html", "body", *_MAIN) or (above.main and paragraph)):
            value = int.from_bytes(top.digest.digest(), "little", signed=True)
            # The last bit tells paragraphs apart, which must be on more pages.
            self.subtrees.append((value | 1 if paragraph else value & ~1, top.first_block, len(self.blocks)))
        return top.name

    def _read(self, text: str) -> None:
        at = 0
        while at < len(text):
            match = _TAG.search(text, at)
            said = text[at : match.start()] if match else text[at:]
            if said and not self._stack[-1].mute:
                self._words.append(html.unescape(said))
            if not match:
                break
            at = match.end()
            name = (match["name"] or match["name2"] or "").lower()
            if not name or not (match["end"] or match["end2"]):
                continue
            if match["close"] or match["close2"]:
                if name in ("td", "th"):
                    self._close(name, _ENDS[name][1])
                elif name in _INLINE:
                    self._close_inline(name)
                else:
                    if name not in _UNSEEN:
                        self._end_block()
                    self._close(name)
            elif name in _RAW:
                end = re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.I).search(text, at)
                at = end.end() if end else len(text)
            else:
                self._open(name, match["attributes"] or match["attributes2"] or "")
        while len(self._stack) > 1:
            self._pop()
        self._end_block()

    def main_block(self) -> int:
        """A hash of the longest block, by which copies of one article are known as one."""
        longest = max(self.blocks, key=len, default="")
        return int.from_bytes(hashlib.blake2b(longest.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)

    def text(self, template: set[int]) -> tuple[str, int]:
        """The main text without the subtrees of ``template``, and the number of those."""
        changes, n_gone = [0] * (len(self.blocks) + 1), 0
        for value, begin, end in self.subtrees:
            if value in template:
                n_gone += 1
                changes[begin] += 1
                changes[end] -= 1
        covered = accumulate(changes)
        left = [k for k, (cover, frame) in enumerate(zip(covered, self.is_frame)) if not (cover or frame)]
        for wanted in ("article", "main"):
            if any(self.inside[k] == wanted for k in left):
                left = [k for k in left if self.inside[k] == wanted]
                break
        return "\n".join(self.blocks[k] for k in left), n_gone


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host, main block and subtree hash, once per page; a null hash stands for the page."""
    for batch in batches:
        for part in slices(batch, "_html", _BYTES_AT_ONCE):
            hosts, mains, values = [], [], []
            for host, body in zip(part["_host"].to_pylist(), part["_html"].to_pylist()):
                page = Page(body or "")
                found = {value for value, _, _ in page.subtrees}
                hosts += [host] * (len(found) + 1)
                mains += [page.main_block()] * (len(found) + 1)
                values += [None, *found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(mains, pa.int64()), pa.array(values, pa.int64())],
                ["_host", "_main", "_subtree"],
            )
        release_memory()


def _texts(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "_html", _BYTES_AT_ONCE):
            texts, n_gone = [], []
            for body, template in zip(part["_html"].to_pylist(), part["_template"]):
                template = set(template.values.to_numpy(zero_copy_only=False).tolist()) if template.is_valid else set()
                text, n = Page(body or "").text(template)
                texts.append(text)
                n_gone.append(n)
            found = [
                pa.array(texts, pa.string()),
                pa.array(map(len, texts), pa.int64()),
                pa.array(np.array(n_gone, np.int64)),
            ]
            kept = [part[name] for name in names]
            yield pa.RecordBatch.from_arrays(kept + found, [*names, "_text", "_n_chars", "_n_template"])
        release_memory()


def host_of(url: Column) -> Column:
    """The part after the first ``://`` up to a slash, question mark, hash or the end; null without one."""
    host = F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    return F.when(host != "", host)


def site_templates(
    pages: DataFrame,
    workspace: Workspace,
    min_pages: int = MIN_PAGES,
    min_share: float = MIN_SHARE,
    min_paragraph_share: float = MIN_PARAGRAPH_SHARE,
) -> DataFrame:
    """``_host``, its templates' hashes as ``_template`` and its number of pages, for hosts that have any.

    Counted are pages with different longest blocks, so a group of copies of any size counts as one page, and
    the longest block of a page is no template. Of each host there are at most as many templates as a page has
    subtrees, over ``min_share``: the list is bounded.
    """
    found = pages.filter("_host is not null").select("_host", "_html")
    found = found.mapInArrow(_subtrees, "_host string, _main long, _subtree long")
    # The number of rows rides along, for hosts that hold a large share of all pages.
    counted = found.groupBy("_host", "_subtree", "_main").agg(F.count(F.lit(1)).alias("_rows"))
    counted = counted.groupBy("_host", "_subtree").agg(F.count(F.lit(1)).alias("_pages"), F.sum("_rows").alias("_rows"))
    counted = workspace.save(counted.filter(F.col("_subtree").isNull() | (F.col("_pages") >= min_pages)), "subtrees")
    totals = counted.filter("_subtree is null").select("_host", F.col("_pages").alias("_of"), F.col("_rows").alias("_weight"))
    often = counted.filter("_subtree is not null").join(totals, "_host")
    share = F.when(F.col("_subtree").bitwiseAND(F.lit(1)) == 1, min_paragraph_share).otherwise(min_share)
    often = often.filter(F.col("_pages") >= share * F.col("_of"))
    return workspace.save(
        often.groupBy("_host").agg(F.collect_list("_subtree").alias("_template"), F.first("_weight").alias("_weight")), "templates"
    )


def extract_text(
    pages: DataFrame,
    html_col: str = "html",
    url_col: str = "url",
    keep: list[str] | None = None,
    min_pages: int = MIN_PAGES,
    min_share: float = MIN_SHARE,
    min_paragraph_share: float = MIN_PARAGRAPH_SHARE,
    workspace: Workspace | None = None,
) -> DataFrame:
    """The ``keep`` columns (by default all but the html) with ``text``, ``n_chars`` and ``n_template``.

    Each page is read as a tree. The subtrees are hashed and counted per host; those on many pages of a host
    are its template and go. So does what is no article by its element's name, class, id or role: menus,
    headers, footers, side columns, notices, adverts, forms, scripts, styles, comments. Of a page with
    ``article`` elements what lies in them stays, else of one with ``main`` that, else all that is left.
    Paragraphs, headings and list items in an article are never taken for a template.

    Character references are decoded, white space in a block becomes one space, blocks are joined by a line
    feed. ``n_template`` counts deleted subtrees. A null page is empty; a url that is null or has no host
    belongs to no site. Kept columns named like a result are replaced; other names do no harm. Rows that repeat are each
    extracted. An empty table gives an empty result.
    """
    workspace = workspace or Workspace(pages.sparkSession)
    results = ["text", "n_chars", "n_template"]
    kept = [c for c in (keep or [c for c in pages.columns if c != html_col]) if c not in results]
    shielded = [f"_column_{i}" for i in range(len(kept))]
    rows = pages.select(
        *(pages[c].alias(s) for c, s in zip(kept, shielded)),
        host_of(pages[url_col]).alias("_host"),
        pages[html_col].cast("string").alias("_html"),
    )
    templates = site_templates(rows, workspace, min_pages, min_share, min_paragraph_share)
    n_pages = templates.agg(F.coalesce(F.sum("_weight"), F.lit(0)).alias("n")).first()["n"]
    looked_up = left_lookup(rows, templates, ["_host"], "_weight", n_pages).select(*shielded, "_html", "_template")
    types = [f"`{s}` {rows.schema[s].dataType.simpleString()}" for s in shielded]
    schema = ", ".join([*types, "_text string", "_n_chars long", "_n_template long"])
    extracted = looked_up.mapInArrow(lambda batches: _texts(batches, shielded), schema)
    return extracted.toDF(*kept, *results)
