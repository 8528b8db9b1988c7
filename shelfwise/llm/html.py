"""Main text of web pages by two-pass block rules."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

from pyspark.sql import DataFrame

from shelfwise.llm.common import map_rows

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she"
    " that the their they this to was we were which with you"
    " au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou"
    " par pas pour qu que qui sa se ses son sont sur un une vous"
    " als am auch auf aus bei das dass dem den der die ein eine einem einen einer er es für hat ich"
    " im ist mit nach nicht noch oder sich sie sind so um und von war wie wir zu zum zur"
    " al como con del el ella en entre era es esta fue ha la las lo los más no para pero por que se"
    " si sin su sus un una y".split()
)
# Elements by what they do to the text around them.
BREAKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol"
    " option p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "aside button datalist dialog fieldset footer head menu nav option search select".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation note"
    " search status".split()
)
#: Open elements that a start tag ends, if they are inside the nearest open element named second.
ENDS = {
    **dict.fromkeys(("td", "th"), (("td", "th"), "table")),
    "tr": (("tr",), "table"),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (("thead", "tbody", "tfoot", "tr"), "table")),
    **dict.fromkeys(("dt", "dd"), (("dt", "dd"), "dl")),
}
#: Words, among those of a class or id, of elements beside the text or about it.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner"
    " breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer masthead menu nav"
    " navbar navigation newsletter pagination popup modal related share sharing sidebar signup social"
    " subscribe toolbar".split()
)
#: Words of elements that may as well hold the text; the blocks inside decide.
DOUBTFUL = frozenset("notice notices widget widgets".split())
#: A word after one of these says what a page has or lacks, not what the element is.
ABOUT = frozenset("has have no not with without hide hidden show is enable".split())
NAME = re.compile(r"[^\s_-]+")
#: Characters, but for spaces, of a paragraph of some length.
PARAGRAPH = 50

_ATTRIBUTES = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*')*+"
_RAW = "script|style|noscript|template|iframe|svg|object|video|audio|canvas|textarea|title"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    # Drawings and formulas may be closed where they are opened.
    r"|<(svg|math)(?=[\s/>])(?:[^>\"'/]++|/(?!>)|\"[^\"]*+\"|'[^']*')*+/>"
    rf"|<({_RAW})(?=[\s/>])(?:{_ATTRIBUTES}>|[^>]*+>).*?(?:</\2\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[!?/][^>]*+>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

GOOD, BAD, SHORT = "good", "bad", "short"


@dataclass(frozen=True)
class Rules:
    """Limits of the first pass: lengths in characters, densities as shares."""

    short: int = 70
    long: int = 200
    stop_low: float = 0.08
    stop_high: float = 0.14
    links: float = 0.33


@dataclass
class Block:
    article: bool
    place: int = 0
    mark: int = 0
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join(unescape("".join(self.parts)).split())


@dataclass
class _Open:
    tag: str
    dropped: bool
    article: bool
    linked: bool
    place: int  # 0, or the number of the doubtful element it is in
    mark: int  # 0, or the number of the innermost marked element it is in


@dataclass
class _Mark:
    """A marked element or form, and what it holds."""

    up: int
    article: bool  # it stands in an article
    form: bool
    main: bool = False  # it holds the page's first article
    heading: int = -1  # the number of the block that its first main heading begins
    size: int = 0
    paragraphs: int = 0


def names_of(value: str) -> tuple[bool, bool]:
    """Whether the words of a class or id mark an element, and whether they make it doubtful."""
    marked = doubtful = False
    before = ""
    for word in NAME.findall(value):
        if before not in ABOUT:
            marked |= word in MARKS
            doubtful |= word in DOUBTFUL
        before = word
    return marked, doubtful


def page_blocks(html: str) -> list[Block]:
    """Text blocks in page order, without those inside menus, footers, forms and the like.

    What stands in a marked element or a form is out, unless that holds the page's first article or,
    on a page without any, most of the text. A form counts as such only with several paragraphs, or
    from its main heading on.
    """
    stack = [_Open("", False, False, False, 0, 0)]
    blocks: list[Block] = []
    block = Block(False)
    marks = [_Mark(0, False, False)]
    places: dict[str, list[int]] = {}  # the stack positions of the open elements of a name
    at, breaks, doubtful, seen = 0, 0, 0, False

    def cut(depth: int) -> None:
        while len(stack) > depth:
            places[stack.pop().tag].pop()

    def last(name: str) -> int:
        return places[name][-1] if places.get(name) else 0

    def close() -> None:
        nonlocal block
        if any(not p.isspace() for p in block.parts):
            blocks.append(block)
        block = Block(stack[-1].article, stack[-1].place, stack[-1].mark)

    def add(raw: str) -> None:
        nonlocal breaks
        here = stack[-1]
        if raw and not here.dropped:
            if not raw.isspace():
                breaks = 0
            block.parts.append(raw)
            if here.linked:
                block.linked += len("".join(raw.split()))

    for m in TOKEN.finditer(html):
        add(html[at : m.start()])
        at = m.end()
        tag = m[4] or m[7]
        if tag is None:
            if m[1] or m[2]:
                add(" ")
            continue
        tag, closing, attributes = tag.lower(), bool(m[3] or m[6]), m[5] or m[8] or ""
        if tag == "br":
            breaks += 1
            if breaks == 2:
                close()
            else:
                add(" ")
            continue
        if tag in BREAKS:
            close()
        if closing:
            if depth := last(tag):
                cut(depth)
        elif tag not in VOID:
            if tag in ("p", "li", "a", "option") and stack[-1].tag == tag:
                cut(len(stack) - 1)
            elif tag in ENDS:
                names, scope = ENDS[tag]
                open_ = [d for name in names if (d := last(name)) > last(scope)]
                if open_:
                    cut(min(open_))
            up = stack[-1]
            marked, unsure, role = False, False, ""
            for name, *value in ATTRIBUTE.findall(attributes) if not up.dropped else ():
                value = "".join(value).lower()
                if name.lower() == "role":
                    role = value
                elif tag not in ("body", "html"):
                    own = names_of(value)
                    marked, unsure = marked or own[0], unsure or own[1]
            main = tag in ("article", "main") or role in ("main", "article")
            inside = up.article or main
            dropped = up.dropped or tag in DROPPED or role in ROLES and role != "form" or (
                tag == "header" and not inside)
            first = main and not seen and not dropped and not marked
            if main and not dropped and not marked or tag == "main":
                marked, unsure = False, False
            mark = up.mark
            form = tag == "form" or role == "form"
            if (marked or form) and not dropped:
                marks.append(_Mark(up.mark, up.article, form and not marked))
                mark = len(marks) - 1
            if first or tag == "h1" and not dropped:
                held, seen = mark, seen or first
                while held:
                    marks[held].main |= first
                    if marks[held].heading < 0 and not first:
                        marks[held].heading = len(blocks)
                    held = marks[held].up
            doubtful += unsure
            place = 0 if main else doubtful if unsure else up.place
            places.setdefault(tag, []).append(len(stack))
            stack.append(_Open(tag, dropped, inside, up.linked or tag == "a", place, mark))
        if tag in BREAKS:
            here = stack[-1]
            block.article, block.place, block.mark = here.article, here.place, here.mark
    add(html[at:])
    close()
    return _unmarked(blocks, marks, seen)


def _unmarked(blocks: list[Block], marks: list[_Mark], seen: bool) -> list[Block]:
    """The blocks that no marked element takes out."""
    if len(marks) == 1:
        return blocks
    for b in blocks:
        size = len("".join("".join(b.parts).split()))
        marks[b.mark].size += size
        marks[b.mark].paragraphs += size >= PARAGRAPH
    for m in reversed(marks[1:]):  # an element has a larger number than what it is in
        marks[m.up].size += m.size
        marks[m.up].paragraphs += m.paragraphs
    start = [0]  # the first block that is not out
    for m in marks[1:]:
        most = not seen and not m.article and 2 * m.size > marks[0].size
        if m.main or most and (m.paragraphs > 1 or not m.form):
            own = 0
        else:
            own = m.heading if m.form and not m.article and m.heading >= 0 else len(blocks)
        if m.form and not m.main and m.heading >= 0:
            own = max(own, m.heading)
        start.append(max(start[m.up], own))
    return [b for i, b in enumerate(blocks) if i >= start[b.mark]]


def first_pass(block: Block, text: str, rules: Rules) -> str:
    """Good, bad, or short (undecided) from the block alone. Few stop words, as in a language without
    any here, leave a block undecided."""
    size = len(text)
    if block.linked > rules.links * max(1, size - text.count(" ")):
        return BAD
    if size < rules.short:
        return SHORT
    words = [w.strip(".,;:!?\"'()").lower() for w in text.split(" ")]
    share = sum(w in STOP_WORDS for w in words) / len(words)
    if share >= rules.stop_high and size >= rules.long:
        return GOOD
    if share >= rules.stop_low:
        return GOOD if block.article or size >= rules.long else SHORT
    return SHORT


def second_pass(labels: list[str], articles: list[bool], containers: list[tuple[bool, int]]) -> list[bool]:
    """Undecided blocks take the label of their nearest decided neighbours in the same container
    (article or not, doubtful element). Neighbours that differ, or the lack of any, leave it to
    whether they are in an article."""
    n = len(labels)
    left: list[str | None] = [None] * n
    right: list[str | None] = [None] * n
    for found, order in ((left, range(n)), (right, range(n - 1, -1, -1))):
        last: dict[tuple[bool, int], str] = {}
        for i in order:
            found[i] = last.get(containers[i])
            if labels[i] != SHORT:
                last[containers[i]] = labels[i]
    kept = []
    for label, a, b, article in zip(labels, left, right, articles):
        if label == SHORT:
            near = {x for x in (a, b) if x}
            label = near.pop() if len(near) == 1 else GOOD if article else BAD
        kept.append(label == GOOD)
    return kept


def main_text(html: str | None, rules: Rules = Rules()) -> str:
    if not html:
        return ""
    blocks = [(b, t) for b in page_blocks(html) if (t := b.text)]
    labels = [first_pass(b, t, rules) for b, t in blocks]
    if GOOD not in labels:
        # No stop words on the whole page: an unknown language, where every block that is not short
        # is text.
        labels = [
            GOOD if label == SHORT and len(t) >= rules.short else label
            for label, (_, t) in zip(labels, blocks)
        ]
    articles = [b.article and not b.place for b, _ in blocks]
    kept = second_pass(labels, articles, [(b.article, b.place) for b, _ in blocks])
    return "\n".join(t for (_, t), keep in zip(blocks, kept) if keep)


def extract_pages(
    pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html: str = "html",
    rules: Rules = Rules(),
) -> DataFrame:
    """Columns ``keep`` with the main text (empty if none) and its number of code points.

    Every page is worked on where it is read; nothing is shuffled.
    """

    def run(columns: list[list]) -> list[list]:
        texts = [main_text(h, rules) for h in columns[0]]
        return [texts, [len(t) for t in texts]]

    return map_rows(pages, run, list(keep), [html], "text string, n_chars long")
