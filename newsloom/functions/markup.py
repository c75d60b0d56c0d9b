"""Helper of the page-reading job: markup -> small tree -> matches -> markup.

Works on one page inside a Spark task. Rules follow the HTML standard where
pages in the wild need it (implied end tags, re-opened formatting elements,
raw-text elements); misnested tables are not re-parented, and an end tag of a
formatting element that holds an open block only stops the re-opening.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from functools import lru_cache
from html.entities import html5

from newsloom.functions.text import MARKUP_ESCAPES

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript".split())
ESCAPABLE_RAW = frozenset(("title", "textarea"))
HEAD_ONLY = frozenset("base link meta noscript script style template title".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li dd dt main menu nav ol p pre "
    "section summary table ul xmp".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
SCOPE_END = frozenset("applet button caption html marquee object table td th template".split())
BLOCK_OR_SCOPE = CLOSES_P | SCOPE_END
LIST_SCOPE = SCOPE_END | {"ul", "ol"}
TABLE_SCOPE = frozenset(("table",))
NO_SCOPE = frozenset()
# Start tag -> open elements it ends, and where looking for them stops.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("tbody", "thead", "tfoot", "table")),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "thead": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
}
# Parent -> children that need a row group or row in between.
TABLE_FILL = {"table": {"tr": ("tbody",), "td": ("tbody", "tr"), "th": ("tbody", "tr")}}
TABLE_PARTS = frozenset("caption td th tr tbody thead tfoot".split())
TABLE_FILL.update({g: {"td": ("tr",), "th": ("tr",)} for g in ("tbody", "thead", "tfoot")})

# Elements of a page. Formatting that is never closed is re-opened in every paragraph, so a page
# may have as many as the square of its length; one with more than these is an error. The copies
# of one paragraph are kept as one run of elements until something looks inside.
MAX_ELEMENTS = 1_000_000

# One alternative per token kind; each consumes to the end of input at worst, so
# reading a page takes linear time however broken it is.
TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:--!?>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<(?P<start>[a-zA-Z][^\s/>]*+)"
    r"(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(
    r"([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]*)))?", re.S
)
ATTRIBUTE_REFERENCE = re.compile(r"&(?:#\d+;?|#[xX][0-9a-fA-F]+;?|(\w+;|\w+(?![\w=])))")


class Node:
    """An element; ``children`` holds elements, strings and comments.

    With ``run`` (formatting elements, from, to) it stands for copies of these, each the
    only child of the one before; ``children`` are those of the last copy, tag and
    attributes those of the first.
    """

    __slots__ = ("tag", "attrs", "children", "parent", "at", "number", "run")

    def __init__(self, tag: str, attrs: dict[str, str], parent: "Node | None"):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent
        self.at = -1  # place among the open elements, -1 when closed
        self.number = -1  # of a formatting element and its copies, in order of the page
        self.run: tuple[list["Node"], int, int] | None = None

    def add(self, tag: str, attrs: dict[str, str] | None = None) -> "Node":
        child = Node(tag, attrs or {}, self)
        self.children.append(child)
        return child

    def expand(self) -> None:
        """Turn a run into the elements that it stands for."""
        if self.run is None:
            return
        formats, first, end = self.run
        self.run, inner, below = None, self, self.children
        for i in range(first + 1, end):
            child = Node(formats[i].tag, formats[i].attrs, inner)
            inner.children = [child]
            inner = child
        inner.adopt(below)

    def adopt(self, children: list) -> None:
        self.children = children
        for child in children:
            if type(child) is Node:
                child.parent = self

    def expand_all(self) -> None:
        """Expand the runs below this element."""
        for node in self.walk():
            node.expand()

    def detach(self) -> None:
        self.parent.children = [c for c in self.parent.children if c is not self]
        self.parent = None

    def walk(self) -> list["Node"]:
        """Descendant elements in document order."""
        found, pending = [], [self]
        while pending:
            node = pending.pop()
            found.append(node)
            if node.children:
                pending.extend([c for c in reversed(node.children) if type(c) is Node])
        return found[1:]


class Comment(str):
    __slots__ = ()


def read_attributes(text: str) -> dict[str, str]:
    attrs: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        value = m[2] or m[3] or m[4] or ""
        if "&" in value:
            value = ATTRIBUTE_REFERENCE.sub(
                lambda r: r[0] if r[1] and r[1] not in html5 else html.unescape(r[0]), value
            )
        attrs.setdefault(m[1].lower(), value)
    return attrs


@lru_cache(maxsize=64)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I)


def _number(node: Node) -> int:
    return node.number


class _Builder:
    """Open elements and formatting elements to re-open.

    ``places`` has the places of the open elements of each tag, ``scopes`` and ``blocks``
    those that end a scope and those that are blocks or do, so that looking
    for one takes the same time however deep the page is. Those of formatting
    elements are looked for in ``open_formats``, whose numbers rise: formatting elements
    are opened, and re-opened, in the order of ``formatting``, so the open ones are its
    first. That list is only ever appended to or replaced, and runs share it.

    Elements are made in document order, each as the last of an open one, and listed so in
    ``elements``; only a run that is ``split`` by an end tag inside it has one more.
    """

    def __init__(self):
        self.root = Node("html", {}, None)
        self.head = self.root.add("head")
        self.elements = [self.root, self.head]
        self.split = False
        self.body: Node | None = None
        self.open: list[Node] = []
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        self.blocks: list[int] = []
        self.formatting: list[Node] = []
        self.of_tag: dict[str, list[Node]] = {}
        self.of_kind: dict[tuple, list[Node]] = {}
        self.open_formats: list[Node] = []
        self.numbered = 0
        self.left_open: set[str] = set()  # tags of which an open element is no longer listed
        self.copied_tags: set[str] = set()
        self.copied_ids: set[str] = set()
        self.reopened = 0
        self.push(self.root)
        self.push(self.head)

    def add(self, tag: str, attrs: dict[str, str]) -> Node:
        """A new element, the last of the innermost open one."""
        parent = self.open[-1]
        node = Node(tag, attrs, parent)
        parent.children.append(node)
        self.elements.append(node)
        return node

    def push(self, node: Node) -> None:
        at, tag = len(self.open), node.tag
        node.at = at
        self.open.append(node)
        places = self.places.get(tag)
        if places is None:
            self.places[tag] = [at]
        else:
            places.append(at)
        if tag in BLOCK_OR_SCOPE:
            self.blocks.append(at)
            if tag in SCOPE_END:
                self.scopes.append(at)
        if node.number >= 0:
            self.open_formats.append(node)

    def pop(self) -> None:
        self.pop_through(self.open[-1])

    def to_body(self, attrs: dict[str, str] | None = None) -> None:
        if self.body is None:
            self.body = self.root.add("body")
            self.elements.append(self.body)
            while self.open[-1] is not self.root:
                self.pop()
            self.push(self.body)
        for name, value in (attrs or {}).items():
            self.body.attrs.setdefault(name, value)

    def pop_through(self, node: Node) -> None:
        closed = self.open[node.at :]
        del self.open[node.at :]
        for one in closed:
            tag = one.tag
            self.places[tag].pop()
            if tag in BLOCK_OR_SCOPE:
                self.blocks.pop()
                if tag in SCOPE_END:
                    self.scopes.pop()
            one.at = -1
            if one.number >= 0:
                self.open_formats.pop()

    def pop_from(self, node: Node, number: int) -> None:
        """Close the copy of a formatting element that an open element is or stands for, and what is in it."""
        if node.number == number:
            self.pop_through(node)
            return
        self.split = True
        formats, first, end = node.run
        cut = bisect_right(formats, number, first, end, key=_number) - 1
        if node is not self.open[-1]:
            self.pop_through(self.open[node.at + 1])
        closed = Node(formats[cut].tag, formats[cut].attrs, node)
        closed.adopt(node.children)
        closed.run = (formats, cut, end) if end - cut > 1 else None
        node.children = [closed]
        node.run = (formats, first, cut) if cut - first > 1 else None

    def last_open_number(self) -> int:
        if not self.open_formats:
            return -1
        last = self.open_formats[-1]
        return last.run[0][last.run[2] - 1].number if last.run else last.number

    def open_format(self, number: int) -> Node:
        return self.open_formats[bisect_right(self.open_formats, number, key=_number) - 1]

    def find_left_open(self, tag: str) -> tuple[Node, int] | None:
        """The last open formatting element of a tag, and its number."""
        for node in reversed(self.open_formats):
            if node.run:
                formats, first, end = node.run
                number = next((formats[i].number for i in range(end - 1, first - 1, -1) if formats[i].tag == tag), -1)
            else:
                number = node.number if node.tag == tag else -1
            if number >= 0:
                return node, number
        return None

    def list_format(self, node: Node) -> None:
        """A formatting element that was opened; of equal ones the last three are listed."""
        kind = (node.tag, tuple(sorted(node.attrs.items())))
        same = self.of_kind.setdefault(kind, [])
        if len(same) >= 3:
            self.unlist(same[0])
        self.formatting.append(node)
        self.of_tag.setdefault(node.tag, []).append(node)
        self.of_kind[kind].append(node)
        if "id" in node.attrs:
            self.copied_ids.add(node.attrs["id"])

    def unlist(self, node: Node) -> None:
        self.formatting = [n for n in self.formatting if n is not node]
        self.of_tag[node.tag].remove(node)
        self.of_kind[(node.tag, tuple(sorted(node.attrs.items())))].remove(node)
        if node.number <= self.last_open_number():
            self.left_open.add(node.tag)

    def last_place(self, tags) -> int:
        if tags is SCOPE_END or tags is BLOCK_OR_SCOPE:
            places = self.scopes if tags is SCOPE_END else self.blocks
            return places[-1] if places else -1
        last = -1
        for tag in tags:
            places = self.places.get(tag)
            if places and places[-1] > last:
                last = places[-1]
        return last

    def find_open(self, tags, stop) -> Node | None:
        place = self.last_place(tags)
        return self.open[place] if place >= 0 and place >= self.last_place(stop) else None

    def reopen_formatting(self) -> None:
        listed = self.formatting
        if not listed:
            return
        open_to = self.last_open_number()
        if listed[-1].number <= open_to:
            return
        first = bisect_right(listed, open_to, key=_number)
        self.reopened += len(listed) - first
        if self.reopened > MAX_ELEMENTS:
            raise ValueError(f"more than {MAX_ELEMENTS} elements")
        self.copied_tags.update(tag for tag, nodes in self.of_tag.items() if nodes)
        # Attributes are shared between the copies: whoever changes them takes a new dictionary.
        node = self.add(listed[first].tag, listed[first].attrs)
        node.number = listed[first].number
        if len(listed) - first > 1:
            node.run = (listed, first, len(listed))
        self.push(node)

    def text(self, data: str) -> None:
        if self.body is None:
            if not data.strip() or self.open[-1].tag in HEAD_ONLY:
                if self.open[-1] is not self.head:
                    self.open[-1].children.append(data)
                return
            self.to_body()
            data = data.lstrip(" \t\n\f")
        if data.strip(" \t\n\f"):
            self.reopen_formatting()
        siblings = self.open[-1].children
        if data[:1] == "\n" and not siblings and self.open[-1].tag in ("pre", "listing"):
            data = data[1:]
        if siblings and type(siblings[-1]) is str:
            siblings[-1] += data
        else:
            siblings.append(data)

    def start(self, tag: str, attrs: dict[str, str]) -> Node | None:
        if tag in ("html", "head"):
            if tag == "html":
                for name, value in attrs.items():
                    self.root.attrs.setdefault(name, value)
            return None
        if tag == "body":
            self.to_body(attrs)
            return None
        if self.body is None and tag not in HEAD_ONLY:
            self.to_body()
        closes_p = tag in CLOSES_P
        if closes_p and self.places.get("p"):
            paragraph = self.find_open(("p",), SCOPE_END)
            if paragraph:
                self.pop_through(paragraph)
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.pop()
        if tag in ENDS:
            ended = self.find_open(*ENDS[tag])
            if ended:
                self.pop_through(ended)
        fill = TABLE_FILL.get(self.open[-1].tag)
        if fill is not None:
            for filler in fill.get(tag, ()):
                self.push(self.add(filler, {}))
        if tag == "a":
            if self.of_tag.get("a"):
                self.end("a")
        if self.formatting and not closes_p and self.body is not None and tag not in ENDS and tag not in RAW:
            self.reopen_formatting()
        node = self.add(tag, attrs)
        if tag in FORMATTING:
            node.number = self.numbered
            self.numbered += 1
        if tag not in VOID:
            self.push(node)
            if tag in FORMATTING:
                self.list_format(node)
        return node

    def end(self, tag: str) -> None:
        if tag in ("html", "head", "body"):
            if tag == "head" and self.body is None:
                while self.open[-1] is not self.head:
                    self.pop()
            return
        if tag == "br":
            self.start("br", {})
            return
        if tag in FORMATTING:
            if self.of_tag.get(tag):
                listed = self.of_tag[tag][-1]
                self.unlist(listed)
                if listed.number <= self.last_open_number():
                    holder = self.open_format(listed.number)
                    if self.last_place(BLOCK_OR_SCOPE) < holder.at:
                        self.pop_from(holder, listed.number)
                return
            found = self.find_left_open(tag) if tag in self.left_open else None
            if found is not None and found[0].at >= self.last_place(BLOCK_OR_SCOPE):
                self.pop_from(*found)
            return
        if tag in TABLE_PARTS:
            stop = TABLE_SCOPE
        elif tag in SCOPE_END:
            stop = NO_SCOPE
        elif tag == "li":
            stop = LIST_SCOPE
        else:
            stop = SCOPE_END if tag in CLOSES_P else BLOCK_OR_SCOPE
        node = self.find_open(HEADINGS if tag in HEADINGS else (tag,), stop)
        if node is not None and node is not self.root and node is not self.body:
            self.pop_through(node)
            if tag in SCOPE_END:
                open_to = self.last_open_number()
                for closed in self.formatting[bisect_right(self.formatting, open_to, key=_number) :]:
                    self.unlist(closed)
        elif tag == "p":
            self.to_body()
            self.add("p", {})


def read_page(source: str) -> Node:
    """Tree of one page: an ``html`` element with ``head`` and ``body``."""
    root = _build(source).root
    root.expand_all()
    return root


def _build(source: str) -> _Builder:
    source = source.replace("\r\n", "\n").replace("\r", "\n")
    builder, at, end_of_input = _Builder(), 0, len(source)
    search = TOKEN.search
    while at < end_of_input:
        token = search(source, at)
        stop = token.start() if token else end_of_input
        if stop > at:
            data = source[at:stop]
            builder.text(html.unescape(data) if "&" in data else data)
        if not token:
            break
        at = token.end()
        comment, end, start, attributes = token.groups()
        if start:
            if source[at - 1] != ">":
                break  # a tag cut off by the end of input is dropped
            tag = start.lower()
            attrs = read_attributes(attributes) if attributes else {}
            node = builder.start(tag, attrs)
            if node is not None and (tag in RAW or tag in ESCAPABLE_RAW):
                closing = _raw_end(tag).search(source, at)
                stop = closing.start() if closing else end_of_input
                data = source[at:stop]
                if data:
                    node.children.append(html.unescape(data) if tag in ESCAPABLE_RAW else data)
                builder.pop_through(node)
                at = (source.find(">", stop) + 1 or end_of_input) if closing else end_of_input
        elif end:
            builder.end(end.lower())
        elif comment is not None:
            builder.open[-1].children.append(Comment(comment))
    builder.to_body()
    return builder


# --- selectors -------------------------------------------------------------

_IDENT = r"(?:[\w-]|[^\x00-\x7f])+"
_SIMPLE = re.compile(
    rf"(?P<tag>\*|{_IDENT})|\#(?P<id>{_IDENT})|\.(?P<cls>{_IDENT})"
    rf"|\[\s*(?P<attr>{_IDENT})\s*(?:(?P<op>[~^$*]?=)\s*"
    rf"(?:\"(?P<dq>[^\"]*)\"|'(?P<sq>[^']*)'|(?P<bare>{_IDENT}))\s*)?\]"
    r"|:(?P<first>first-child)|:nth-child\(\s*(?P<nth>\d+)\s*\)"
)
_COMBINATOR = re.compile(r"\s*([>+~])\s*|\s+")
_COMPARE = {
    "=": lambda have, want: have == want,
    "~=": lambda have, want: want in have.split(),
    "^=": lambda have, want: bool(want) and have.startswith(want),
    "$=": lambda have, want: bool(want) and have.endswith(want),
    "*=": lambda have, want: bool(want) and want in have,
}


def _attribute_test(name: str, compare, want: str):
    return lambda n, place: name in n.attrs and (compare is None or compare(n.attrs[name], want))


def _simple_test(m: re.Match):
    """A test of an element and its place among its sibling elements."""
    if m["tag"]:
        tag = m["tag"].lower()
        return (lambda n, place: True) if tag == "*" else (lambda n, place: n.tag == tag)
    if m["id"]:
        return _attribute_test("id", _COMPARE["="], m["id"])
    if m["cls"]:
        return _attribute_test("class", _COMPARE["~="], m["cls"])
    if m["attr"]:
        want = next((v for v in (m["dq"], m["sq"], m["bare"]) if v is not None), "")
        return _attribute_test(m["attr"].lower(), _COMPARE.get(m["op"]), want)
    wanted = 1 if m["first"] else int(m["nth"])
    return lambda n, place: place == wanted


def _parse_compound_list(selector: str) -> list:
    """One chain ``[(combinator, tests), ...]`` per comma-separated part, with the tag and id of its last one."""
    chains, chain, tests, at, combinator = [], [], [], 0, ""
    told = {"tag": None, "id": None}
    selector = selector.strip()
    while at <= len(selector):
        simple = _SIMPLE.match(selector, at)
        if simple and not (simple["tag"] and tests):
            tests.append(_simple_test(simple))
            told = {name: simple[name] or value for name, value in told.items()}
            at = simple.end()
            continue
        if not tests:
            raise ValueError(f"unsupported selector {selector!r}")
        chain.append((combinator, tests))
        tests = []
        if at == len(selector):
            chains.append((chain, told))
            return chains
        comma = re.compile(r"\s*,\s*").match(selector, at)
        joint = comma or _COMBINATOR.match(selector, at)
        if not joint:
            raise ValueError(f"unsupported selector {selector!r}")
        if comma:
            chains.append((chain, told))
            chain, combinator = [], ""
        else:
            combinator = joint[1] or " "
        told = {"tag": None, "id": None}
        at = joint.end()
    raise ValueError(f"unsupported selector {selector!r}")


def _above(ends: list[Node]) -> set[int]:
    """Identities of these elements and all that they are in."""
    marked: set[int] = set()
    for node in ends:
        while node is not None and id(node) not in marked:
            marked.add(id(node))
            node = node.parent
    return marked


def _expand_above(ends: list[Node]) -> None:
    """Expand the runs that these elements are in."""
    looked_at: set[int] = set()
    for node in ends:
        while node is not None and id(node) not in looked_at:
            looked_at.add(id(node))
            node.expand()
            node = node.parent


def _reached(root: Node, chain: list, ends: list[Node] | None = None) -> set[int]:
    """Identities of the elements that a chain matches, in one pass from the top.

    Where only ``ends`` can match, only they and what they are in are looked at.

    Bit i of a state says that the chain's first i + 1 parts match and end there.
    An element's state follows from those of its parent, its ancestors together,
    its last sibling and its earlier siblings together.
    """
    found: set[int] = set()
    last = 1 << (len(chain) - 1)

    def state(node: Node, place: int, related: dict[str, int]) -> int:
        bits = 0
        for i, (combinator, tests) in enumerate(chain):
            if i and not related[combinator] >> (i - 1) & 1:
                continue
            for test in tests:
                if not test(node, place):
                    break
            else:
                bits |= 1 << i
        if bits & last:
            found.add(id(node))
        return bits

    relevant = _above(ends) if ends is not None else None
    own = state(root, 1, {" ": 0, ">": 0, "+": 0, "~": 0})
    pending = [(root, own, own)]
    while pending:
        parent, own, above = pending.pop()
        related = {" ": above, ">": own, "+": 0, "~": 0}
        place = 0
        for child in parent.children:
            if type(child) is Node:
                place += 1
                if relevant is not None and id(child) not in relevant:
                    continue
                bits = state(child, place, related)
                related["+"] = bits
                related["~"] |= bits
                if child.children:
                    pending.append((child, bits, above | bits))
    return found


@lru_cache(maxsize=4096)
def compile_selector(selector: str) -> list:
    """Selector text -> (chain, what the elements that it matches are looked up by, if by anything).

    Raises ``ValueError`` when unsupported.
    """
    return [(chain, _looked_up_by(chain, part)) for chain, part in _parse_compound_list(selector)]


def _looked_up_by(chain: list, last: dict) -> tuple[str, str] | None:
    """The id or tag of the last part; none where siblings matter, which are not above an element."""
    if any(combinator in ("+", "~") for combinator, _ in chain):
        return None
    tag = (last["tag"] or "*").lower()
    return ("id", last["id"]) if last["id"] else ("tag", tag) if tag != "*" else None


class Page:
    """A page's elements in document order, looked up by tag for selectors.

    Runs of re-opened formatting elements are expanded where a selector looks for such
    elements or has to look at them on its way to others.
    """

    def __init__(self, source: str):
        built = _build(source)
        self.root, self.copied = built.root, {"tag": built.copied_tags, "id": built.copied_ids}
        self._list([self.root, *self.root.walk()] if built.split else built.elements)

    def _list(self, elements: list[Node]) -> None:
        self.elements = elements
        self.has_runs = False
        self.by_tag: dict[str, list[Node]] = {}
        self.by_id: dict[str, list[Node]] = {}
        for node in elements:
            if node.run is not None:
                self.has_runs = True
            same = self.by_tag.get(node.tag)
            if same is None:
                self.by_tag[node.tag] = [node]
            else:
                same.append(node)
            if node.attrs and "id" in node.attrs:
                self.by_id.setdefault(node.attrs["id"], []).append(node)

    def _looked_up(self, key: tuple[str, str] | None) -> list[Node] | None:
        """The elements of a tag or id, None for all."""
        if self.has_runs and (key is None or key[1] in self.copied[key[0]]):
            self.root.expand_all()
            self._list([self.root, *self.root.walk()])
        return None if key is None else (self.by_id if key[0] == "id" else self.by_tag).get(key[1], [])

    def tagged(self, tag: str) -> list[Node]:
        return self._looked_up(("tag", tag))

    def select(self, selector: str) -> list[Node]:
        found: set[int] = set()
        chains = compile_selector(selector)
        for chain, key in chains:
            ends = self._looked_up(key)
            if ends and self.has_runs:
                _expand_above(ends)
            if ends is None or ends:
                found |= _reached(self.root, chain, ends)
        # What a chain matches is among what its last part was looked up by, which is in document order.
        among = ends if len(chains) == 1 and ends is not None else self.elements
        return [node for node in among if id(node) in found] if found else []


# --- back to markup --------------------------------------------------------

def _escape(text: str) -> str:
    for plain, escaped in MARKUP_ESCAPES:
        if plain in text:
            text = text.replace(plain, escaped)
    return text


def inner_markup(node: Node) -> str:
    out: list[str] = []
    pending: list = [(node, iter(node.children))]
    while pending:
        parent, children = pending[-1]
        for child in children:
            if isinstance(child, Comment):
                out.append(f"<!--{child}-->")
            elif isinstance(child, str):
                out.append(child if parent.tag in RAW else _escape(child))
            else:
                out.append("<" + child.tag)
                for name, value in child.attrs.items():
                    out.append(f' {name}="{_escape(value)}"')
                out.append("/>" if child.tag in VOID else ">")
                if child.tag not in VOID:
                    pending.append((child, iter(child.children)))
                    break
        else:
            pending.pop()
            if pending:
                out.append(f"</{parent.tag}>")
    return "".join(out)
