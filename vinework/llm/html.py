"""Text blocks of an HTML page, with what their elements say about them."""

from __future__ import annotations

import html
import re

# A block's place: inside an article, inside something that never is one, or neither.
ARTICLE, OPEN, ASIDE = 2, 1, 0
_UNSEEN = -2  # not shown
_LOOSE = -1  # aside, but an article in it is one: after an unclosed element, or in a wrapper that is named after a part

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)[^>]*>",
    re.S,
)
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[^\W_]+")
_HIDDEN_INPUT = re.compile(r"""type\s*=\s*["']?hidden""", re.I)

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Text up to their end tag, whatever it looks like.
RAW = frozenset("script style iframe noembed noframes textarea title xmp".split())
UNSEEN = frozenset("template noscript object svg head select canvas audio video annotation annotation-xml".split())
# What may stand in a head whose end tag is left out.
HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
FOREIGN = frozenset("svg math".split())
# Elements of svg and math that hold HTML, and HTML elements that end an svg or math elsewhere.
HOLDERS = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
BREAKOUT = frozenset(
    "article aside b big blockquote body br center code dd div dl dt em embed footer form h1 h2 h3 h4 h5 h6 head header hr i img li listing main menu meta nav nobr ol p "
    "pre ruby s section small span strike strong sub sup table tt u ul var".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split()
)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
ASIDES = frozenset("nav footer aside form dialog menu button".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
# A class or id name marks what is no article text if it consists of these words, or of these and words of place and
# kind: "cookie-notice", "left_sidebar", "relatedPosts". A name with any other word says nothing: "no-sidebar",
# "ad-free", "social-impact", "share-price-table", "comments-open".
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr menu modal nav navbar "
    "navigation newsletter notice notices notification pagination pager popup promo promoted recommended related respond share sharing sidebar signup skip social "
    "sponsor sponsored subscribe toolbar widget widgets".split()
)
KIND_WORDS = frozenset(
    "area article articles bar block body bottom box btn button buttons center col column container content drawer first float footer form global group header holder "
    "icon icons inline inner item items last layer left link links list main media middle mobile module outer overlay page panel post posts primary region right "
    "row secondary section site slot small sticky stories story sub third to toggle top unit up view wrap wrapper zone".split()
)
COMMENT_WORDS = frozenset("comment comments disqus respond".split())
# Lists of other articles, if the page has its own elsewhere.
LIST_WORDS = frozenset("recommended related".split())
LISTS = frozenset("aside footer dialog".split())
HEADER_WORDS = frozenset("header masthead topbar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Content by nature: their ids come from their texts, and only a class may mark them.
CONTENT = frozenset("p blockquote pre figure figcaption table tbody tr td th dl dt dd".split())
CONTROLS = frozenset("input select textarea button".split())
WORDS_PER_CONTROL = 20  # a form with more words than that is a wrapper around text
ARTICLE_WORDS = frozenset("articlebody".split())
NAME_WORDS = ASIDE_WORDS | KIND_WORDS | HEADER_WORDS
WHOLE = frozenset("html body main article".split())  # their class and id names say nothing about their place

# What an element's marks say.
_MAIN, _IN_ARTICLE, _TAG_ASIDE, _WORD_ASIDE, _TAG_LIST, _WORD_LIST, _COMMENT, _TAG_HEADER, _WORD_HEADER, _HEAD, _FORM = (1 << i for i in range(11))
_WORDS = _WORD_ASIDE | _WORD_LIST | _COMMENT | _WORD_HEADER


def _named(names: str) -> int:
    """What class or id names mark."""
    found = 0
    for token in names.split():
        words = {w.lower() for w in _NAME_PART.findall(token)}
        if words <= NAME_WORDS:
            found |= _WORD_ASIDE * bool(words & ASIDE_WORDS) | _WORD_LIST * bool(words & LIST_WORDS)
            found |= _COMMENT * bool(words & COMMENT_WORDS) | _WORD_HEADER * bool(words & HEADER_WORDS)
    return found


def _marks(name: str, attrs: str) -> tuple[int, int, str]:
    """Marks of an element, those that come from its id alone, and the id."""
    found = (_MAIN | _IN_ARTICLE) * (name == "main") | _IN_ARTICLE * (name == "article")
    found |= _TAG_ASIDE * (name in ASIDES) | _TAG_LIST * (name in LISTS) | _TAG_HEADER * (name == "header") | _HEAD * (name == "h1") | _FORM * (name == "form")
    of_class = of_id = 0
    ident = ""
    if attrs.strip(" /\n\t"):
        for key, value in _ATTR.findall(attrs):
            key, value = key.lower(), value.strip("\"'")
            if key == "class":
                of_class |= _named(value)
            elif key == "id":
                of_id, ident = _named(value), value
            elif key == "role":
                found |= _TAG_ASIDE * (value.lower() in ASIDE_ROLES)
                found |= (_MAIN | _IN_ARTICLE) * (value.lower() == "main") | _IN_ARTICLE * (value.lower() == "article")
            elif key == "itemprop":
                found |= _IN_ARTICLE * (value.lower() in ARTICLE_WORDS)
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                found |= _TAG_ASIDE
    if name in WHOLE or found & _IN_ARTICLE or name in INLINE or name in HEADINGS:
        return found, 0, ""
    if name in CONTENT:
        return found | of_class, 0, ""
    return found | of_class | of_id, of_id & ~of_class, ident


def _places(parents: list[int], marks: list[int], hidden: list[bool]) -> list[int]:
    """Place of every element; parents come before their children, the first is the page.

    Class and id names do not count on what holds an article or a main element,
    unless the article is in a comment section, or in a list of other articles
    while the page has its own elsewhere. A main element always counts. What
    holds a first heading is named after a part of the page only if it is its
    header.
    """
    marks, holds = list(marks), [0] * len(marks)
    for i, m in enumerate(marks):
        if m & _HEAD and not hidden[i]:
            at = parents[i]
            while at >= 0 and not holds[at] & _HEAD:
                holds[at] |= _HEAD
                marks[at] &= ~(_WORD_ASIDE | _WORD_LIST)
                at = parents[at]
    articles = [i for i, m in enumerate(marks) if m & _IN_ARTICLE and not hidden[i]]
    for i in articles:
        if marks[i] & _MAIN:
            at = parents[i]
            while at >= 0 and not holds[at] & _MAIN:
                holds[at] |= _MAIN
                marks[at] &= ~(_WORDS | _TAG_LIST)
                at = parents[at]
    if articles:
        above = [0] * len(marks)  # comment sections and lists around
        for i in range(1, len(marks)):
            above[i] = above[parents[i]] | marks[parents[i]] & (_COMMENT | _WORD_LIST | _TAG_LIST)
        own = any(not above[i] for i in articles)
        for i in articles:
            if not above[i] & _COMMENT:
                at = parents[i]
                while at >= 0 and not holds[at] & _IN_ARTICLE:
                    holds[at] |= _IN_ARTICLE
                    at = parents[at]
    else:
        own = False
    places = [OPEN] * len(marks)
    for i in range(1, len(marks)):
        mark, place = marks[i], places[parents[i]]
        if hidden[i]:
            places[i] = _UNSEEN
            continue
        if not own:
            mark &= ~_TAG_LIST
        if holds[i] & (_MAIN | _IN_ARTICLE) and not (own and mark & _WORD_LIST):
            mark &= ~_WORDS
        if mark & (_TAG_ASIDE | _WORD_ASIDE) or (mark & (_TAG_HEADER | _WORD_HEADER) and place != ARTICLE):
            firm = place == ASIDE or mark & (_COMMENT | _WORD_LIST | _TAG_LIST)
            places[i] = ASIDE if firm else _LOOSE
        elif mark & _IN_ARTICLE and place != ASIDE:
            places[i] = ARTICLE
        else:
            places[i] = place
    return places


def blocks(page: str) -> list[tuple[str, int]]:
    """(text, place) of every block in page order; character references decoded, white space single, empty blocks left out."""
    parents, marks, hidden = [-1], [0], [False]
    ids: list[tuple[int, int, str]] = []  # elements that their ids alone mark
    headings: list[int] = []
    forms: list[int] = []  # per element, the form it is in
    controls: dict[int, int] = {}
    forms.append(0)
    stack: list[tuple[str, int]] = [("", 0)]
    parts: list[tuple[int, str]] = []  # element and text; an element of -1 ends a block
    at = foreign = 0  # foreign: place in the stack of the outermost svg or math that is open, 0 if none is
    while at < len(page):
        tag = _TAG.search(page, at)
        if tag is None:
            if stack[-1][0] == "head":
                del stack[-1]
            parts.append((stack[-1][1], page[at:]))
            break
        if tag.start() > at:
            if stack[-1][0] == "head" and not page[at : tag.start()].isspace():
                del stack[-1]
            parts.append((stack[-1][1], page[at : tag.start()]))
        at = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        if not name:
            continue
        if foreign >= len(stack):
            foreign = 0
        if tag["end"] or tag["end2"]:
            if name in INLINE or foreign and name not in BREAKOUT and _inside(stack, name, foreign):
                if stack[-1][0] == name or name not in INLINE:
                    _close(stack, name)
            else:
                at_end = _close(stack, name)
                if not hidden[at_end] and name not in UNSEEN and name not in FOREIGN:
                    parts.append((-1, ""))
            continue
        slash = (tag["attrs"] or "").endswith("/")
        if foreign and name in BREAKOUT and stack[-1][0] not in HOLDERS:
            if not any(n in HOLDERS for n, _ in stack[foreign:]):
                del stack[foreign:]
                foreign = 0
        if stack[-1][0] == "head" and name not in HEAD:
            del stack[-1]
        if name == "body":
            # All that is open before a body is a head left open.
            if any(n == "body" for n, _ in stack):
                continue
            del stack[1 + (len(stack) > 1 and stack[1][0] == "html") :]
        if name in RAW and not (foreign and (slash or name == "title")):
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else at if slash and name not in ("script", "style") else len(page)
            continue
        if name == "br":
            parts.append((stack[-1][1], " "))
        if name in CONTROLS and forms[stack[-1][1]] and not _HIDDEN_INPUT.search(tag["attrs"] or ""):
            controls[forms[stack[-1][1]]] = controls.get(forms[stack[-1][1]], 0) + 1
        seen = name not in UNSEEN
        if seen and name not in INLINE and name not in FOREIGN and not foreign and not hidden[stack[-1][1]]:
            parts.append((-1, ""))
        if name in VOID or slash:
            continue
        if name == "p" and stack[-1][0] == "p":
            del stack[-1]
        mark, of_id, ident = _marks(name, tag["attrs"] or "")
        if mark or name not in INLINE:
            foreign = foreign or len(stack) * (name in FOREIGN)
            stack.append((name, len(parents)))
            parts.append((len(parents), ""))
            parents.append(stack[-2][1])
            forms.append(len(marks) if name == "form" else forms[parents[-1]])
            if of_id:
                ids.append((len(marks), of_id, ident))
            if name in HEADINGS:
                headings.append(len(marks))
            marks.append(mark)
            hidden.append(hidden[parents[-1]] or not seen)
    _clear_ids(parts, parents, marks, ids, headings)
    _clear_forms(parts, marks, hidden, forms, controls)
    found = _blocks(parts, _places(parents, marks, hidden))
    # A page without text and without an article element is inside a wrapper whose name misleads.
    while not any(place for _, place in found) and not any(m & _IN_ARTICLE for m in marks):
        wrapper = _largest(parts, parents, marks)
        if wrapper is None:
            break
        marks[wrapper] &= ~(_WORDS | _TAG_ASIDE * bool(marks[wrapper] & _FORM))
        found = _blocks(parts, _places(parents, marks, hidden))
    return found


def _clear_ids(parts, parents: list[int], marks: list[int], ids: list[tuple[int, int, str]], headings: list[int]) -> None:
    """An id made from the first heading of its section marks nothing."""
    for element, bits, ident in ids:
        for heading in headings:
            at = heading
            while at > element:
                at = parents[at]
            if at == element:
                text = "".join(t for e, t in parts if e == heading)
                if _WORD.findall(html.unescape(text).lower()) == _WORD.findall(ident.lower()):
                    marks[element] &= ~bits
                break


def _clear_forms(parts, marks: list[int], hidden: list[bool], forms: list[int], controls: dict[int, int]) -> None:
    """A form around text, such as one around the whole page, marks nothing."""
    if not any(forms):
        return
    words = dict.fromkeys(forms, 0)
    for element, text in parts:
        if element >= 0 and not hidden[element] and not marks[element] & _TAG_ASIDE or element in forms and forms[element] == element:
            words[forms[element]] += len(text.split())
    holding = {forms[i] for i, m in enumerate(marks) if m & (_IN_ARTICLE | _HEAD)}
    for form, n in words.items():
        if form and (form in holding or n > WORDS_PER_CONTROL * max(1, controls.get(form, 0))):
            marks[form] &= ~_TAG_ASIDE


def _largest(parts, parents: list[int], marks: list[int]) -> int | None:
    """Of the outermost elements that only names, or a form, mark: that with the most text."""
    top: list[int] = [0]  # outermost marked element around, -1 inside what its element name marks
    for i in range(1, len(marks)):
        above = top[parents[i]]
        named = marks[i] & _WORDS or marks[i] & _FORM and marks[i] & _TAG_ASIDE
        firm = marks[i] & (_TAG_ASIDE | _TAG_HEADER) and not marks[i] & _FORM
        top.append(above or (-1 if firm else i if named else 0))
    sizes: dict[int, int] = {}
    for element, text in parts:
        if element >= 0 and top[element] > 0 and not text.isspace():
            sizes[top[element]] = sizes.get(top[element], 0) + len(text)
    return max(sizes, key=lambda e: (sizes[e], -e)) if any(sizes.values()) else None


def _inside(stack: list[tuple[str, int]], name: str, at: int) -> bool:
    return any(n == name for n, _ in stack[at:])


def _blocks(parts: list[tuple[int, str]], places: list[int]) -> list[tuple[str, int]]:
    """Runs of texts of one place, cut where blocks end; what is not shown cuts nothing."""
    out: list[tuple[str, int]] = []
    texts: list[str] = []
    place = OPEN
    for element, text in [*parts, (-1, "")]:
        if element >= 0 and places[element] == _UNSEEN:
            continue
        if texts and (element < 0 or places[element] != place):
            joined = _SPACE.sub(" ", html.unescape("".join(texts))).strip()
            if joined:
                out.append((joined, max(place, ASIDE)))
            texts.clear()
        if element >= 0:
            place = places[element]
            if text:
                texts.append(text)
    return out


def _close(stack: list[tuple[str, int]], name: str) -> int:
    """End an element and those in it, and return it; ends without a beginning are ignored and give the open element."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i][0] == name:
            element = stack[i][1]
            del stack[i:]
            return element
    return stack[-1][1]
