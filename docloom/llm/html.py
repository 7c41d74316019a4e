"""Main text of web pages by two passes of block rules."""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is no text of the page.
DROPPED = {
    "script", "style", "noscript", "template", "head", "title", "svg", "math", "iframe", "object", "embed", "canvas",
    "audio", "video", "map", "select", "option", "datalist", "button", "textarea", "dialog", "applet", "frameset",
}
#: Elements that hold what stands around an article.
AROUND = {"nav", "footer", "aside", "form", "menu", "fieldset"}
#: Elements that start and end a block.
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4", "h5", "h6", "header",
    "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
#: Elements without content.
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
#: Elements whose content is raw up to their end tag.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
#: Words in class, id and role that name what stands around an article.
AROUND_NAMES = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist cookie "
    "cookies consent dialog disclaimer disqus footer gdpr header masthead menu modal nav navbar navigation newsletter "
    "notice notices pager pagination paywall popup promo promoted promotion related recommended replies respond search "
    "share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar tooltip topbar widget "
    "alert complementary contentinfo".split()
)
#: Words that say nothing beside one of these names (site-footer, comment-list); others do (social-history).
NEUTRAL_NAMES = set(
    "site page main global top bottom left right primary secondary box block list item items section area container "
    "wrapper wrap outer inner bar row column col panel links link icons buttons button posts articles stories content "
    "module unit slot form thread body text bar group message".split()
)
#: Frequent words of English, German, French, Spanish.
STOP_WORDS = set(
    "a all also an and are as at be been but by can for from had has have he her his if in into is it its more not of "
    "on one or our she so than that the their them then there these they this to was we were what when which who will "
    "with would you aber als am auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer er "
    "es für hat ich ihr im in ist man mit nach nicht noch nur oder sich sie sind über um und uns unter vom von vor war "
    "was wie wir wird zu zum zur au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais "
    "ne nous on ou outre par pas plus pour qu que qui sa se ses son sur un une vous à été al como con cuando de del "
    "desde donde el ella en entre era es ese esos esta este fue ha hasta la las lo los más me muy no nos o para pero "
    "por que se ser si sin sobre su sus también un una y ya".split()
)

#: Limits of the first pass: link density; characters of a short and a long block; stop-word density.
LINKS, SHORT, LONG, FEW_STOPS, MANY_STOPS = 0.4, 60, 180, 0.12, 0.22

TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: One attribute, from where none is read yet: name, then perhaps a value that is quoted or goes up to white space or >.
ATTRIBUTE = re.compile(r"""[\s/]*(?:([^\s/>=][^\s/>=]*|=[^\s/>=]*)(?:\s*=\s*(?:"([^"]*)("|$)|'([^']*)('|$)|([^\s>]*)))?)?""")
NAMING = {"class", "id", "role", "hidden", "aria-hidden", "style"}
SPLIT_NAME = re.compile(r"[^a-z0-9]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that end where the next one of their kind starts, unless one of SCOPES was opened between.
SIBLINGS = {"p", "li", "tr", "td", "th", "dt", "dd"}
SCOPES = {"ul", "ol", "table", "div", "article", "section", "body"}
FOREIGN = {"svg", "math"}


class Block:
    """A run of text without a block element inside. place: 1 in an article, -1 around it, 0 unknown.

    linked counts letters in links, links the links themselves; marks are those of the elements that it stands in; why
    names the rule that decided.
    """

    __slots__ = ("text", "letters", "linked", "links", "heading", "place", "marks", "kind", "why")

    def __init__(self, text: str, linked: int, links: int, heading: bool, place: int, marks: tuple[int, ...] = ()):
        self.text, self.linked, self.links, self.heading, self.place, self.marks = text, linked, links, heading, place, marks
        self.letters = len("".join(text.split()))
        self.kind = self.why = ""


def attributes_of(page: str, at: int) -> tuple[dict[str, str], bool, int]:
    """(naming attributes, whether a slash ends the tag, place after its >; -1 if the page ends first).

    As HTML reads them: a quote only counts right after =, a slash within an unquoted value belongs to it. Each
    character is read once.
    """
    found: dict[str, str] = {}
    n = len(page)
    while True:
        m = ATTRIBUTE.match(page, at)
        if m[1] is None:
            if m.end() >= n:
                return found, False, -1
            return found, page[m.end() - 1] == "/" and m.end() > at, m.end() + 1
        if m[2] is not None and not m[3] or m[4] is not None and not m[5]:
            return found, False, -1
        name = m[1].lower()
        if name in NAMING:
            found.setdefault(name, m[2] if m[2] is not None else m[4] if m[4] is not None else m[6] or "")
        at = m.end()


def named_around(attributes: dict[str, str], names: set[str], firm: set[str] = frozenset()) -> str:
    """"name" if class, id or role name something around an article, "firm" if it is one of those or hidden, else ""."""
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return "firm"
    if HIDDEN.search(html.unescape(attributes.get("style", ""))):
        return "firm"
    found = ""
    for key in ("class", "id", "role"):
        for one in html.unescape(attributes.get(key, "")).lower().split():
            parts = [x for x in SPLIT_NAME.split(one) if x]
            if not names.isdisjoint(parts) and all(x in AROUND_NAMES or x in NEUTRAL_NAMES or x.isdigit() for x in parts):
                if not firm.isdisjoint(parts):
                    return "firm"
                found = "name"
    return found


#: Elements whose mark stands whatever they hold, and names likewise: readers' words and adverts may be articles.
FIRM, FIRM_NAMES = {"nav", "footer", "aside", "menu"}, {
    "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "related", "recommended", "ad", "ads", "advert", "adverts",
    "advertisement", "advertising", "sponsor", "sponsored", "promo", "promoted", "promotion", "sidebar", "nav", "navbar", "navigation", "footer",
}
#: Within an article its own header stays; an article may be a reader's comment or an advert itself.
INSIDE_NAMES = AROUND_NAMES - {"header", "masthead"}
#: Names that a paragraph or a heading of an article may have for its subject.
SUBJECTS = {"search", "tags", "social", "share", "sharing", "alert", "message", "dialog", "navigation", "banner", "notice", "disclaimer"}
ARTICLE_NAMES = {"comment", "comments", "reply", "replies", "ad", "ads", "advert", "sponsored", "promo", "related"}


def end_of(page: str, tag: str, at: int, ends: dict[str, re.Pattern]) -> int:
    """Where the raw element's end tag starts; the page's end if there is none."""
    if tag not in ends:
        ends[tag] = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I)
    m = ends[tag].search(page, at)
    return m.start() if m else len(page)


def blocks_of(page: str) -> list[Block]:
    """All blocks of a page in order, with references decoded and white space folded. Linear in the page."""
    out: list[Block] = []
    parts: list[str] = []
    linked = n_links = 0
    stack: list[tuple[str, bool, tuple[int, ...], bool]] = []  # (element, whether in an article, marks, dropped)
    kinds: list[str] = []  # of each mark: firm, form, or name
    where: dict[str, list[int]] = {}  # places in the stack of each open element
    scopes: list[int] = []
    ends: dict[str, re.Pattern] = {}
    article, marks, dropped, links, heading = False, (), False, 0, False

    def flush() -> None:
        nonlocal parts, linked, n_links
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, linked, n_links, heading, int(article), marks))
        parts, linked, n_links = [], 0, 0

    def say(raw: str, decode: bool = True) -> None:
        nonlocal linked
        if raw and not dropped:
            text = html.unescape(raw) if decode and "&" in raw else raw
            parts.append(text)
            if links:
                linked += len("".join(text.split()))

    def close(k: int) -> None:
        """Take all elements from the k-th on off the stack."""
        nonlocal article, marks, dropped, links
        while len(stack) > k:
            tag = stack.pop()[0]
            where[tag].pop()
            if tag in SCOPES:
                scopes.pop()
            if tag == "a":
                links -= 1
        article, marks, dropped = stack[-1][1:] if stack else (False, (), False)

    at, n = 0, len(page)
    last = page.rfind(">")
    while at < n:
        begun = page.find("<", at)
        if begun < 0:
            say(page[at:])
            break
        say(page[at:begun])
        after = page[begun + 1 : begun + 2]
        if after == "!":
            if page.startswith("<!--", begun):
                end = page.find("-->", begun + 4)
                at = n if end < 0 else end + 3
            elif page.startswith("<![CDATA[", begun):
                end = page.find("]]>", begun)
                say(page[begun + 9 : n if end < 0 else end], False)
                at = n if end < 0 else end + 3
            else:
                end = page.find(">", begun)
                at = n if end < 0 else end + 1
            continue
        closing = after == "/"
        m = TAG_NAME.match(page, begun + 1 + closing)
        if m is None:
            if after == "?" or closing:
                end = page.find(">", begun)
                at = n if end < 0 else end + 1
            else:
                say("<")
                at = begun + 1
            continue
        tag = m[0].lower()
        attributes, slashed, at = attributes_of(page, m.end()) if m.end() <= last else ({}, False, -1)
        if at < 0:
            break  # the page ends within a tag, which is no text
        if tag in BLOCKS:
            flush()
        elif tag == "br":
            parts.append(" ")
        if closing:
            if where.get(tag):
                close(where[tag][-1])
            if tag in HEADINGS:
                heading = False
            continue
        if tag in RAW:
            at = end_of(page, tag, at, ends)
            end = page.find(">", at)
            at = n if end < 0 else end + 1
            continue
        if tag in VOID or slashed and (tag in FOREIGN or any(where.get(x) for x in FOREIGN)):
            continue
        if tag in SIBLINGS and where.get(tag) and where[tag][-1] > (scopes[-1] if scopes else -1):
            close(where[tag][-1])
        if tag == "a":
            if where.get("a"):
                close(where["a"][-1])
            links += 1
            n_links += 1
        if tag in HEADINGS:
            heading = True
        names = ARTICLE_NAMES if tag in ("article", "main") else INSIDE_NAMES if article else AROUND_NAMES
        if article and (tag == "p" or tag in HEADINGS):
            names = names - SUBJECTS
        kind = ""
        if tag not in ("html", "body") and attributes:
            kind = named_around(attributes, names, FIRM_NAMES)
        if tag in FIRM or (tag == "header" and not article):
            kind = "firm"
        elif tag in AROUND and kind != "firm":
            kind = "form"
        if kind:
            marks = (*marks, len(kinds))
            kinds.append(kind)
        if tag in ("article", "main") and not kind:
            article = True
        dropped = dropped or tag in DROPPED
        where.setdefault(tag, []).append(len(stack))
        if tag in SCOPES:
            scopes.append(len(stack))
        stack.append((tag, article, marks, dropped))
    flush()
    placed(out, kinds)
    return out


def placed(blocks: list[Block], kinds: list[str]) -> None:
    """Blocks in a mark that holds are around the article.

    A form that holds more than half of the page's letters outside links is the page's own wrapper and marks nothing; an
    element with a name such as social marks nothing if the page's only article or main is in it.
    """
    plain = [b.letters - b.linked for b in blocks]
    held = [0] * len(kinds)
    has = [False] * len(kinds)
    for b, n in zip(blocks, plain):
        for m in b.marks:
            held[m] += n
            has[m] = has[m] or b.place > 0
    outside = any(b.place > 0 and not b.marks for b in blocks)
    total = sum(plain)
    loose = {m for m, kind in enumerate(kinds) if kind == "form" and 2 * held[m] > total or kind == "name" and has[m] and not outside}
    for b in blocks:
        if any(m not in loose for m in b.marks):
            b.place = -1


#: What ends a sentence, perhaps before quotes and brackets, and what parts one, in any script.
ENDED = re.compile(r"[.!?…。！？۔।:;؟]['\"”’»›)\]」』）]*$")
PARTED = re.compile(r"[.!?…,;:](?=\s|$)|[。！？、，；：۔।،؛؟]")
#: Characters of scripts that write no spaces count as this many.
WIDE = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\u0e00-\u0e7f\U00020000-\U0002ffff]")
WIDTH = 3


def stop_words_of(block: Block) -> tuple[int, int]:
    """(stop words, words) of a block; characters of scripts without spaces are words, about."""
    words = block.text.lower().split()
    return sum(w.strip(".,;:!?()\"'«»„“”’") in STOP_WORDS for w in words), len(words) + len(WIDE.findall(block.text))


def written_as_prose(block: Block, size: int) -> bool:
    """Whether a block reads as sentences in a language of which no word is known: it ends one, and is parted as often as prose is."""
    return bool(ENDED.search(block.text)) and len(PARTED.findall(block.text)) * 150 >= size


def classify(blocks: list[Block]) -> None:
    """First pass: link density, length and stop words make a block good, bad, near good or short.

    Where fewer words of a page's text outside links are known stop words than prose has, its language may be none of those
    listed: then being punctuated as prose counts like stop words, and characters of scripts without spaces count threefold.

    Marks come after these: what stands in an element or under a name that is known to stand around articles is bad,
    whatever its words. In an article or main few stop words don't make a block bad by themselves, nor do links in a
    sentence or in a heading, nor a copyright sign: its neighbours decide.
    """
    counts = [stop_words_of(b) for b in blocks]
    told = [c for b, c in zip(blocks, counts) if 2 * b.linked <= b.letters]
    strange = sum(n for n, _ in told) < MANY_STOPS * sum(m for _, m in told)
    for b, (n, m) in zip(blocks, counts):
        size = len(b.text)
        letters = b.letters or 1
        stops = n / m
        if strange:
            size += (WIDTH - 1) * len(WIDE.findall(b.text))
            stops = max(stops, MANY_STOPS if written_as_prose(b, size) else 0.0)
        prose = b.place > 0 and (b.heading or size >= SHORT and (b.links == 1 or b.linked < letters and bool(ENDED.search(b.text))))
        if b.linked / letters > LINKS and not prose:
            b.kind, b.why = "bad", "link density"
        elif b.text[0] == "©" and b.place <= 0:
            b.kind, b.why = "bad", "copyright line"
        elif size < SHORT:
            b.kind, b.why = ("bad", "short with a link") if b.linked and b.place <= 0 else ("short", "neighbours of a short block")
        elif stops >= MANY_STOPS:
            b.kind, b.why = ("good", "length and stop words") if size >= LONG else ("near", "neighbours of a near-good block")
        elif stops >= FEW_STOPS or size >= LONG or b.place > 0:
            b.kind, b.why = "near", "neighbours of a near-good block"
        else:
            b.kind, b.why = "bad", "few stop words"
        if b.place < 0 and b.kind != "bad":
            b.kind, b.why = "bad", "marks"


def settle(blocks: list[Block]) -> list[bool]:
    """Second pass: short and near-good blocks take the label of their nearest decided neighbours.

    Between two good neighbours both are good, between two bad ones neither is; between unlike ones a
    near-good block is good and a short one takes the label of the nearer, the bad one's in a tie. A
    heading goes with what follows it. At an end of the page the missing neighbour is bad. Such a block in
    an article or main is good unless both neighbours are bad blocks of an article themselves.
    """
    n = len(blocks)
    before, after = [(-1, False)] * n, [(n, False)] * n
    last = (-1, False)
    for k, b in enumerate(blocks):
        before[k] = last
        if b.kind in ("good", "bad"):
            last = (k, b.kind == "good")
    last = (n, False)
    for k in range(n - 1, -1, -1):
        after[k] = last
        if blocks[k].kind in ("good", "bad"):
            last = (k, blocks[k].kind == "good")
    out = []
    for k, b in enumerate(blocks):
        (i, left), (j, right) = before[k], after[k]
        if b.kind in ("good", "bad"):
            out.append(b.kind == "good")
        elif b.place > 0:
            out.append(left or right or not (i >= 0 and j < n and blocks[i].place > 0 and blocks[j].place > 0))
        elif left == right:
            out.append(left)
        elif b.kind == "near":
            out.append(True)
        elif b.heading:
            out.append(right)
        else:
            out.append(left if k - i < j - k else right if j - k < k - i else False)
    return out


def main_text(page: str) -> str:
    """The article's blocks joined by newlines; empty if the page has none."""
    blocks = blocks_of(page)
    classify(blocks)
    return "\n".join(b.text for b, keep in zip(blocks, settle(blocks)) if keep)


def extract_main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page; see classify() and settle() for the rules.

    Null html counts as empty; a page without an article has text "". Rows are independent: null and
    repeated ids and urls are passed on, an empty table gives no rows, other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias(id_col), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    kind = rows.schema[id_col].dataType.simpleString()

    def task(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                texts = [main_text(x.as_py()) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[id_col, "url", "text", "n_chars"],
                )

    return rows.mapInArrow(task, f"{id_col} {kind}, url string, text string, n_chars long")
