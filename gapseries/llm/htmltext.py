"""Main-text extraction by tag-path ratios.

Each page is cut into blocks (text between block-level boundaries), each with
its root-to-leaf path of tags. Per path and page the text length, punctuation,
link text and number of blocks are aggregated into a text-to-path and a
punctuation-to-path ratio. The ratios are smoothed over the blocks in page
order, fused (length times punctuation, less the share of link text) and
averaged back per path; paths at or above a share of the page's length-weighted
mean are content. Last, the deepest element that holds most of the content
also yields its short blocks (headings, list items), so that an article is
returned whole, and lists of links that stand in the article. Navigation and
the like, known by tag, take no part; what class, id or role hint at has its
ratio cut to ``PENALTY``, so that a chance hit on the article's own container
loses to nothing but better text. A form takes no part unless the page is built
inside it (it holds the article, the menu or most of the sentences). Reader
comments take no part, however long, unless the page has no other sentence or
their container holds the page's heading.

Pages are independent: one pass over the table, no shuffle. The parser is
linear in the page's length.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapseries.llm.common import arrow_rows, pieces

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var object "
                   # MathML: a formula is part of its sentence
                   "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mprescripts "
                   "mtable mtr mtd mstyle mpadded mphantom menclose merror semantics".split())
# tags that never hold the article, and tokens of class, id and role that seldom do
ASIDE = frozenset("nav footer aside button select option label fieldset menu dialog".split())
HINTS = frozenset("ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments complementary consent "
                  "contentinfo cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter "
                  "alert infobar notice notices pager pagination popup promo promoted recommended related replies reply respond search share "
                  "sharing sidebar sidebars signup skip social sponsor sponsored subscribe toolbar widget widgets".split())
HINT_STARTS = ("comment", "advert", "adsby", "adsense", "cookie", "sidebar", "footer", "newsletter", "breadcrumb", "sponsor", "navbar")
HINT_ENDS = ("nav", "sidebar", "footer", "menu", "comments", "banner", "advert", "header")
# words that say nothing in a token beside a hint: "related-posts", "share_buttons"
LAYOUT = frozenset("area article articles bar block body bottom box button buttons col column container content cta entry form global group "
                   "icons inner item items left links list main media middle module outer page panel post posts primary right row secondary "
                   "section site stories story text title top unit wrap wrapper zone".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "thead", "tbody"}}
SCOPES = frozenset("ul ol dl table article section div main body html blockquote td th".split())
HOMES = frozenset(["", "html", "body", "article", "main", "section", "div"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
# starts of a token that names reader comments, and what starts alike but does not
COMMENTS = ("comment", "kommentar", "disqus", "replies", "respond")
NO_COMMENTS = ("commentary", "commentat", "respondent")
ASIDE_TAG, HIDDEN = 1, 2        # why an element is left out
SENTENCE = 60           # characters of a block with a full stop, from which on it is a sentence of prose
SMOOTH = (1.0, 2.0, 1.0)
SHARE = 0.35            # of the mean fused ratio, from which on a path is content
PENALTY = 0.02          # on the ratio of paths that class, id or role hint at
LEAST = 0.1             # of the page's text; a hinted reading that keeps less, and no sentence, is read without hints
MOST = 0.75             # of the content's length, which the article's element holds

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_LACKING = re.compile(r"\b(?:with|has|no|without)[-_]?[a-z]+")       # "has-sidebar" is no sidebar
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
_STOP = re.compile(r"[.!?。！？]")
_RIGHTS = re.compile(r"\W*(?:©|\(c\)|copyright)", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPLIT = re.compile(r"[-_:]+")
_SIZE = re.compile(r"\d+(?:x\d+)?")
_PUNCTUATION = re.compile(r"[.,;:!?、。，！？；]")


class _Page:
    """Blocks of one page: (text, path, element, link characters), and the element tree."""

    def __init__(self, hints: bool = True) -> None:
        self.hints = hints
        self.blocks: list[tuple[str, int, int, int]] = []
        self.parent, self.tags = [-1], [""]                 # by element; 0 is the document
        self.hinted = [0]                                   # by element: hints on it and above
        self.forms, self.threads = [0], [0]                 # by element: the form and the innermost comments around it
        self.outer = {0: (0, 0)}                            # by comments: those around them, and how many lie around a block in them
        self.holds: set[int] = set()                        # forms and comments that the page is built inside of
        self.paths: dict[tuple[int, str, bool], int] = {}
        self.stack: list[tuple[str, int, int, int]] = [("", 0, 0, 0)]      # tag, element, path, left out
        self.held: list[str] = []
        self.links: list[str] = []
        self.open: dict[str, int] = {}                      # open elements by tag
        self.sizes: dict[int, int] = {}                     # characters by element, with those of hidden elements

    def flush(self) -> None:
        if self.held:
            tag, element, path, out = self.block()
            text = " ".join(unescape("".join(self.held)).split())
            if text and out != ASIDE_TAG and tag != "head":
                self.sizes[element] = self.sizes.get(element, 0) + len(text)
            if text and not out and tag != "head":
                link = len(" ".join(unescape("".join(self.links)).split())) if self.links else 0
                self.blocks.append((text, path, element, link))
            self.held, self.links = [], []

    def block(self) -> tuple[str, int, int, int]:
        """The innermost block-level element."""
        for entry in reversed(self.stack):
            if entry[0] not in INLINE:
                return entry
        return self.stack[0]

    def text(self, raw: str) -> None:
        if raw:
            self.held.append(raw)
            if self.open.get("a"):
                self.links.append(raw)

    def pop(self, size: int) -> None:
        for tag, *_ in self.stack[size:]:
            self.open[tag] -= 1
        del self.stack[size:]

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.text("\n")
            return
        block = tag not in INLINE
        if block:
            self.flush()
        if tag in VOID:
            return
        closes = CLOSES.get(tag, set())
        if block:
            closes = closes | {"p"}
        for k in range(len(self.stack) - 1, 0, -1):
            if not any(map(self.open.get, closes)):
                break                                       # none is open: deep nesting costs nothing
            open_tag = self.stack[k][0]
            if open_tag in closes:
                self.pop(k)
            elif open_tag in SCOPES and not (open_tag in ("td", "th") and tag in CLOSES):
                break
        _, element, path, out = self.stack[-1]
        if block:
            hint = thread = False
            form = self.forms[element]
            if tag in ("article", "main", "nav"):
                self.holds.add(form)
            talk = self.threads[element]
            while tag in ("h1", "main") and talk and talk not in self.holds:
                self.holds.add(talk)
                talk = self.outer[talk][0]
            if not out:
                inside = bool(self.open.get("article") or self.open.get("main"))
                out = ASIDE_TAG if tag in ASIDE or tag == "header" and not inside else 0
                if attributes and not out and tag not in ("html", "body", "article", "main"):
                    named = _named(attributes)
                    out = HIDDEN if self.hints and _hidden(named) else 0
                    found = "" if out else _aside(named, inside)
                    hint, thread = bool(found) and self.hints, found == "comments"
            self.parent.append(element)
            self.tags.append(tag)
            self.hinted.append(self.hinted[element] + hint)
            self.forms.append(form or (len(self.forms) if tag == "form" else 0))
            talk = self.threads[element]
            if thread:
                self.outer[len(self.threads)] = talk, self.outer[talk][1] + 1
            self.threads.append(len(self.threads) if thread else talk)
            element = len(self.tags) - 1
            path = self.paths.setdefault((path, tag, hint), len(self.paths) + 1)
        self.stack.append((tag, element, path, out))
        self.open[tag] = self.open.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        block = tag not in INLINE
        for k in range(len(self.stack) - 1, 0, -1) if self.open.get(tag) else ():
            if self.stack[k][0] == tag:
                if block:
                    self.flush()
                self.pop(k)
                return
            if not block and self.stack[k][0] not in INLINE:
                return                                      # an inline end tag closes nothing across blocks


def _named(attributes: str) -> dict[str, str]:
    """Attributes by lower-case name; of equal names the first counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), (m[2] or "").strip("\"'"))
    return found


def _hidden(named: dict[str, str]) -> bool:
    return "hidden" in named or named.get("aria-hidden", "").strip().lower() == "true" or bool(_UNSEEN.search(named.get("style", "")))


def _aside(named: dict[str, str], inside: bool) -> str:
    """What a whole token of class, id or role hints at: "comments", "other" text than the article's, or ""; ``inside``: of an article."""
    found = ""
    for name in ("class", "id", "role"):
        for token in _LACKING.sub(" ", named.get(name, "")).split():
            low = token.lower()
            if low.startswith(COMMENTS) and not low.startswith(NO_COMMENTS):
                return "comments"
            if _hint(token) and not (inside and low.endswith("header")):
                found = "comments" if any(w.startswith(COMMENTS) and not w.startswith(NO_COMMENTS) for w in _SPLIT.split(low)) else "other"
                if found == "comments":
                    return found
    return found


def _hint(token: str) -> bool:
    """All its words are hints or say nothing, or it starts or ends like one: "social-share", not "social-science" or "3f9ad12"."""
    low = token.lower()
    if low.startswith(NO_COMMENTS):
        return False
    if low.startswith(HINT_STARTS) or low.endswith(HINT_ENDS):
        return True
    own = [w for w in _SPLIT.split(_CAMEL.sub("-", token).lower()) if w and w not in LAYOUT and not _SIZE.fullmatch(w)]
    return bool(own) and all(w in HINTS for w in own)


def parse(html: str, hints: bool = True) -> _Page:
    """Tolerant parse: unclosed, misnested and cut-off markup never raises. Without ``hints`` class names play no part."""
    page, at, size, broken = _Page(hints), 0, len(html), False
    while at < size:
        tag_at = html.find("<", at)
        if tag_at < 0:
            page.text(html[at:])
            break
        page.text(html[at:tag_at])
        if html.startswith("<!--", tag_at):
            end = html.find("-->", tag_at + 4)
            at = size if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), tag_at):
            end = html.find(">", tag_at)
            at = size if end < 0 else end + 1
            continue
        name = _NAME.match(html, tag_at)
        if not name:
            if html.startswith("</", tag_at):               # a bogus end tag, or a cut-off one
                end = html.find(">", tag_at)
                at = size if end < 0 else end + 1
            else:
                page.text("<")
                at = tag_at + 1
            continue
        rest = None if broken else _REST.match(html, name.end())
        if rest:
            end = rest.end()
        else:                                               # an open quote: from here on tags end at the next ">"
            broken = True
            end = html.find(">", name.end()) + 1
            if not end:
                break
        tag, closing = name[1].lower(), html.startswith("</", tag_at)
        at = end
        if closing:
            page.end(tag)
        else:
            page.start(tag, html[name.end():end])
            if tag in RAW:
                if html[end - 2:end] != "/>" or tag in ("script", "style", "textarea", "title"):
                    close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>?", re.I).search(html, end)
                    at = close.end() if close else size
                page.end(tag)
    page.flush()
    return page


def _smooth(values: list[float]) -> list[float]:
    """Weighted mean with the neighbours in page order."""
    reach, n = len(SMOOTH) // 2, len(values)
    out = []
    for i in range(n):
        a, b = max(0, i - reach), min(n, i + reach + 1)
        weights = SMOOTH[a - i + reach:b - i + reach]
        out.append(sum(w * v for w, v in zip(weights, values[a:b])) / sum(weights))
    return out


def sentence(text: str) -> bool:
    """Whether a block reads as prose: long enough, with a full stop, and no note of rights."""
    return len(text) >= SENTENCE and bool(_STOP.search(text)) and not _RIGHTS.match(text)


def settled(page: _Page) -> tuple[list[tuple[str, int, int, int]], int]:
    """Blocks without those of forms and comments that take no part, and the characters of what takes part, hidden or not."""
    forms, threads = page.forms, page.threads
    prose: dict[int, int] = {}
    for text, _, e, _ in page.blocks:
        if sentence(text):
            prose[forms[e]] = prose.get(forms[e], 0) + len(text)
    total = sum(prose.values())
    kept = {f for f in set(forms) if not f or f in page.holds or 2 * prose.get(f, 0) > total}
    own = [False] * len(page.tags)                          # inside an article or main element, and not in comments
    for e in range(1, len(own)):
        own[e] = not threads[e] and (own[page.parent[e]] or page.tags[e] in ("article", "main"))
    talks = set(threads) - page.holds - {0}
    if talks and not any(forms[e] in kept and threads[e] not in talks and page.hinted[e] <= page.outer[threads[e]][1] and (
            own[e] or sentence(text) or page.tags[e] == "p" and _STOP.search(text) and not _RIGHTS.match(text)) for text, _, e, _ in page.blocks):
        talks = set()                                       # nothing else is there to read

    def part(e: int) -> bool:
        return forms[e] in kept and threads[e] not in talks
    return [b for b in page.blocks if part(b[2])], sum(n for e, n in page.sizes.items() if part(e))


def content(page: _Page, blocks: list[tuple[str, int, int, int]]) -> list[str]:
    """Texts of the content blocks, in page order."""
    if not blocks:
        return []
    chars, stops, links, count = {}, {}, {}, {}
    for text, path, _, link in blocks:
        chars[path] = chars.get(path, 0) + len(text)
        stops[path] = stops.get(path, 0) + len(_PUNCTUATION.findall(text))
        links[path] = links.get(path, 0) + link
        count[path] = count.get(path, 0) + 1

    def fuse(paths: list[int]) -> dict[int, float]:
        length = _smooth([chars[p] / count[p] for p in paths])
        marks = _smooth([stops[p] / count[p] for p in paths])
        out: dict[int, float] = {}
        for p, a, b in zip(paths, length, marks):
            out[p] = out.get(p, 0.0) + a * (1 + b) * max(0.0, 1 - links[p] / chars[p]) / count[p]
        return out

    def mean(ratios: dict[int, float]) -> float:
        total = sum(chars[p] for p in ratios)
        return sum(ratios[p] * chars[p] for p in ratios) / total if total else 0.0
    # text without hints is weighed among itself; hinted text counts if it beats that in spite of the penalty
    fused = fuse([p for _, p, e, _ in blocks if not page.hinted[e]])
    least = mean(fused)
    if len(fused) < len(chars):
        fused = {p: PENALTY * r for p, r in fuse([p for _, p, _, _ in blocks]).items()} | fused
        least = max(least, mean(fused))
    chosen = {p for p in fused if fused[p] >= SHARE * least and fused[p] > 0}
    weight = [0] * len(page.tags)
    for text, path, element, _ in blocks:
        if path in chosen:
            weight[element] += len(text)
    whole = sum(weight)
    for e in range(len(weight) - 1, 0, -1):                 # children come after their parents
        weight[page.parent[e]] += weight[e]
    home = max((e for e in range(len(weight)) if weight[e] >= MOST * whole), default=0)
    while page.tags[home] not in HOMES:                     # a lone paragraph: its container is the article
        home = page.parent[home]
    inside = [False] * len(weight)
    for e in range(len(weight)):
        inside[e] = e == home or e > 0 and inside[page.parent[e]]
    broad = page.tags[home] in ("", "html", "body")
    here = {p for _, p, e, _ in blocks if inside[e]} & chosen
    lists = _link_lists(page, blocks, here, home) if not broad else set()
    out = []
    for text, path, element, _ in blocks:
        if path in here or inside[element] and page.hinted[element] == page.hinted[home] and (
                links[path] < 0.5 * chars[path] or element in lists) and (not broad or page.tags[element] in HEADINGS):
            out.append(text)
    return out


def _link_lists(page: _Page, blocks: list[tuple[str, int, int, int]], here: set[int], home: int) -> set[int]:
    """Elements of the lists in the article: in its ``article`` element, or between blocks of content side by side with them."""
    around = [0] * len(page.tags)           # by element: the outermost list around it
    own = [False] * len(page.tags)          # by element: inside an article element
    for e in range(1, len(page.tags)):
        around[e] = around[page.parent[e]] or (e if page.tags[e] in ("ul", "ol", "dl") else 0)
        own[e] = own[page.parent[e]] or page.tags[e] == "article"
    first: dict[int, int] = {}              # by element: places of its own first and last block of content
    last: dict[int, int] = {}
    for k, (_, path, e, _) in enumerate(blocks):
        if path in here:
            first.setdefault(page.parent[e], k)
            last[page.parent[e]] = k
    out = set()
    for k, (_, _, e, _) in enumerate(blocks):
        beside = page.parent[around[e]] if around[e] else 0
        if around[e] and (own[e] or first.get(beside, k) < k < last.get(beside, k)):
            out.add(e)
    return out


def main_text(html: str | None) -> str:
    """Main text of one page; empty if there is none."""
    page = parse(html or "")
    blocks, size = settled(page)
    found = content(page, blocks)
    # a page of which its hints (or hidden elements) leave next to nothing, and no sentence, is read without them
    if sum(map(len, found)) <= LEAST * size and not any(map(sentence, found)):
        page = parse(html or "", hints=False)
        found = content(page, settled(page)[0]) or found
    return " ".join(found)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: ``(id, url, text, n_chars)``.

    White space inside a block becomes one space, blocks are joined by one
    space. Null and empty pages, and pages without content, give an empty text.
    Repeated rows are all returned. Other columns are ignored; an empty table
    gives an empty result.
    """
    kinds = {f.name: f.dataType for f in pages.schema.fields}
    schema = T.StructType([T.StructField(id_col, kinds[id_col]), T.StructField(url_col, kinds[url_col]),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for batch in pieces(batches):
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield [batch.column(0), batch.column(1), texts, [len(t) for t in texts]]
    return pages.select(F.col(id_col), F.col(url_col), F.col(html_col)).mapInArrow(arrow_rows(run, schema), schema)
