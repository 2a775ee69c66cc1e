"""A tolerant reader of HTML: block elements, their text blocks and features.

Elements that make a block are nodes, as are controls and embedded objects inside
a line; other inline markup, formulas included, belongs to the block it stands in.
Missing end tags are implied as browsers do; stray ones are ignored.  Only the
content of RAW elements is skipped; all other text is in some block.  A run of
text that stands directly in the page, html or body is a node of its own (BARE).
"""

import html
import math
import re
import sys

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())
#: Nodes that stand in a line: they do not end the run of text around them.
IN_LINE = frozenset("audio button canvas noscript object optgroup option select svg template video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small "
    "span strike strong sub sup time tt u var wbr "
    # Formulas are read as text of the block they stand in.
    "math annotation annotation-xml maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom "
    "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
#: Elements of drawings; their text belongs to the drawing.
DRAWING = frozenset(
    "animate circle clippath defs desc ellipse filter g image line lineargradient marker mask metadata path pattern polygon "
    "polyline radialgradient rect stop switch symbol text textpath tspan use view".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
#: Start tags that end an open element of these names, up to the nearest of the others.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
#: Elements that hold the whole page, and the name of a node for text that stands directly in one of them.
WHOLE = frozenset(["#page", "html", "body"])
BARE = "#text"
# Names that tell what a part of a page is for.
ASIDE_TAGS = frozenset("nav footer aside form header button select option".split())
MAIN_TAGS = frozenset("article main".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer form "
    "header login menu modal nav navbar navigation newsletter notice popup promo related reply share sharing sidebar social "
    "sponsor sponsored subscribe toolbar widget".split()
)
MAIN_WORDS = frozenset("article content entry main post story".split())

# Nothing matched is given back, so broken markup costs no backtracking.
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+(?=>)|[^>]*+)>", re.S
)
_ATTR = re.compile(r"""([^\s=/"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_WORD = re.compile(r"[a-z]+")
_MARKS = re.compile(r"[.,;:!?]")
_START = {name: re.compile(rf"<{name}(?=[\s/>])", re.I) for name in IN_LINE}
_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in IN_LINE | RAW}
#: First character of a block's text that goes on in the line of the block before, without and with a space.
GLUED, SPACED = "\x1f", " "


class Node:
    __slots__ = (
        "tag", "parent", "depth", "tokens", "start", "own", "chars", "links", "tags", "paragraphs", "items", "marks",
        "children", "place",
    )

    def __init__(self, tag, parent, depth, tokens, start, place):
        self.tag, self.parent, self.depth, self.tokens = tag, parent, depth, tokens
        self.start, self.place = start, place
        self.own = self.chars = self.links = self.tags = self.paragraphs = self.items = self.marks = 0
        self.children = []


def attribute_words(attributes):
    """Words of the class, id and role attributes."""
    if "=" not in attributes:
        return ()
    out = []
    for name, a, b, c in _ATTR.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            out.extend(_WORD.findall((a or b or c).lower()))
    return tuple(out)


def _next(pattern, page, at, past=False):
    """Place of the next match, or of its end; past every page if there is none."""
    found = pattern.search(page, at)
    return (found.end() if past else found.start()) if found else sys.maxsize


def parse(page):
    """(nodes, blocks) of a page: nodes in page order, blocks as (node, text).

    A run of text with nodes inside the line gives several blocks; all but the
    first begin with GLUED or SPACED.
    """
    nodes = [Node("#page", -1, 0, (), 0, 0)]
    stack, blocks, pieces = [0], [], []
    total, link = 0, 0
    #: Nodes inside a line whose end tag is missing: the next block ends them.
    loose, ahead = set(), {}

    def flush():
        nonlocal total
        at, begun, space = 0, False, False
        while at < len(pieces):
            own, upto = pieces[at][0], at
            while upto < len(pieces) and pieces[upto][0] == own:
                upto += 1
            raw = "".join(text for _, text, _ in pieces[at:upto])
            text = " ".join(raw.split())
            space = space or raw[:1].isspace()
            if text:
                node = nodes[own]
                node.own += len(text)
                node.links += min(sum(len(t) for _, t, linked in pieces[at:upto] if linked), len(text))
                node.marks += len(_MARKS.findall(text))
                blocks.append((own, ((SPACED if space else GLUED) if begun else "") + text))
                total += len(text)
                begun, space = True, raw[-1:].isspace()
            at = upto
        pieces.clear()

    def close(depth):
        if any(nodes[at].tag not in IN_LINE for at in stack[depth:]):
            flush()
        del stack[depth:]

    def open_node(name, attributes):
        parent = nodes[stack[-1]]
        parent.children.append(len(nodes))
        nodes.append(Node(name, stack[-1], len(stack), attribute_words(attributes), total, len(parent.children) - 1))
        stack.append(len(nodes) - 1)

    def line():
        """The block that text read here belongs to."""
        if nodes[stack[-1]].tag in WHOLE:
            open_node(BARE, "")
        return stack[-1]

    def end_line():
        flush()
        while stack[-1] in loose or nodes[stack[-1]].tag == BARE:
            del stack[-1]

    def unclosed(name, at):
        """True if no end tag follows before the next start tag of this name."""
        found = ahead.get(name, (-1, -1))
        if min(found) < at:
            nexts = [place if place >= at else _next(pattern, page, at) for place, pattern in zip(found, (_START[name], _END[name]))]
            found = ahead[name] = tuple(nexts)
        return found[0] <= found[1]

    at, end, last = 0, len(page), page.rfind(">")
    if page.rfind("<!--") > last:
        last = end
    while at < end:
        # What follows the last ">" holds no tag.
        found = _TAG.search(page, at) if at < last else None
        upto = found.start() if found else end
        if upto > at:
            text = html.unescape(page[at:upto])
            pieces.append((stack[-1] if text.isspace() else line(), text, link))
        if not found:
            break
        at = found.end()
        name = found.group(2)
        if name is None:
            continue
        name = name.lower()
        if found.group(1):
            if name in INLINE:
                if name == "a":
                    link = 0
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == name:
                    close(depth)
                    break
            continue
        if name in RAW and not (name == "title" and any(nodes[k].tag == "svg" for k in stack)):
            if not found.group(3).endswith("/") or name in ("script", "style"):
                # As in browsers, an element of raw text without an end tag is the rest of the page.
                at = min(_next(_END[name], page, at, past=True), end)
            continue
        if name in INLINE:
            nodes[stack[-1]].tags += 1
            if name == "a":
                link = 1
            elif name in ("br", "img", "wbr"):
                pieces.append((stack[-1], " ", 0))
            continue
        if name in DRAWING or name == "title":
            pieces.append((stack[-1], " ", 0))
            continue
        if name in IN_LINE:
            line()
            for ended in {"option": ("option",), "optgroup": ("option", "optgroup"), "button": ("button",)}.get(name, ()):
                if nodes[stack[-1]].tag == ended:
                    del stack[-1]
            if name in ("option", "optgroup", "select"):
                pieces.append((stack[-1], " ", 0))
            if not (name == "svg" and found.group(3).endswith("/")):
                open_node(name, found.group(3))
                if unclosed(name, at):
                    loose.add(stack[-1])
            continue
        if name in VOID:
            end_line()
            continue
        end_line()
        if name in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                tag = nodes[stack[depth]].tag
                if tag == "p":
                    close(depth)
                    break
                if tag in CLOSES_P:
                    break
        elif name in ENDS:
            own, limit = ENDS[name]
            for depth in range(len(stack) - 1, 0, -1):
                tag = nodes[stack[depth]].tag
                if tag in limit:
                    break
                if tag in own:
                    close(depth)
                    if name != "tr":
                        break
        link = 0
        open_node(name, found.group(3))
    flush()
    if [node.tag for node in nodes] == ["#page", BARE]:
        # A page of one run is that block itself.
        whole, nodes = nodes[1], nodes[1:]
        whole.parent, whole.depth = -1, 0
        blocks = [(0, text) for _, text in blocks]
    for node in reversed(nodes):
        node.chars += node.own
        node.tags += 1
        node.paragraphs += node.tag in ("p", BARE)
        node.items += node.tag == "li"
        if node.parent >= 0:
            above = nodes[node.parent]
            above.chars += node.chars
            above.links += node.links
            above.tags += node.tags
            above.marks += node.marks
            above.paragraphs += node.paragraphs
            above.items += node.items
    return nodes, blocks


#: Features that name a part's purpose, first in every row; training hides them half of the time.
NAMED = 12
TOKEN_BUCKETS = 4
FEATURES = NAMED + 21


def feature_rows(nodes):
    """One list of FEATURES numbers for every node."""
    log = math.log1p
    whole = nodes[0].chars or 1
    above_aside, above_main, out = [0] * len(nodes), [0] * len(nodes), []
    for i, node in enumerate(nodes):
        parent = nodes[node.parent] if node.parent >= 0 else node
        siblings = parent.children if node.parent >= 0 else [0]
        aside_words = sum(t in ASIDE_WORDS for t in node.tokens)
        main_words = sum(t in MAIN_WORDS for t in node.tokens)
        aside, main = node.tag in ASIDE_TAGS, node.tag in MAIN_TAGS
        up = max(node.parent, 0)
        above_aside[i] = above_aside[up] + (aside or aside_words > 0) if i else 0
        above_main[i] = above_main[up] + (main or main_words > 0) if i else 0
        buckets = [0] * TOKEN_BUCKETS
        for t in node.tokens:
            buckets[(len(t) * 7 + ord(t[0]) * 31 + ord(t[-1])) % TOKEN_BUCKETS] += 1
        before = nodes[siblings[node.place - 1]] if node.place else None
        after = nodes[siblings[node.place + 1]] if node.place + 1 < len(siblings) else None
        chars = node.chars
        out.append(
            [
                aside, main, aside_words, main_words, above_aside[i], above_main[i],
                node.tag == "form", node.tag in ("header", "footer"), *buckets,
                node.depth, log(chars), log(node.own), node.links / (chars or 1), log(node.tags), chars / node.tags,
                log(node.paragraphs), log(node.items), node.marks / (chars or 1), chars / whole, node.start / whole,
                node.place / len(siblings), log(len(siblings)), log(before.chars) if before else -1,
                log(after.chars) if after else -1, parent.chars / whole, parent.links / (parent.chars or 1),
                log(parent.paragraphs), node.tag in ("p", BARE), node.tag in ("li", "a", "ul", "ol", "dl", "td", "th"),
                node.tag in ("h1", "h2", "h3", "h4", "h5", "h6"),
            ]
        )
    return out


def seed_labels(nodes):
    """1 main text, 0 aside, -1 unknown, by what names say: the nearest telling ancestor counts."""
    out = []
    for i, node in enumerate(nodes):
        given = out[node.parent] if i else -1
        if node.tag in MAIN_TAGS or (given != 0 and any(t in MAIN_WORDS for t in node.tokens)):
            given = 1 if given != 0 else 0
        if node.tag in ASIDE_TAGS and not (node.tag == "header" and given == 1):
            given = 0
        if any(t in ASIDE_WORDS for t in node.tokens) and not (node.tag in MAIN_TAGS):
            given = 0
        if node.tag in ("head",):
            given = 0
        out.append(given)
    return out
