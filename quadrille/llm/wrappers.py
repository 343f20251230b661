"""Wrappers of web pages: union-free regular expressions over block elements, inferred by aligning pages of one host.

A page is read as a tree of block elements and texts. Two trees are aligned sibling list by sibling list: equal lists one by
one; in others, runs of equal siblings, or of equal groups of siblings, first become one repeated element or group, and what then
only one of them has becomes optional. Aligned elements are aligned further down, and texts that differ become slots. Paragraphs,
items of lists and the like, and long runs, are taken as repeated at once. There are no alternatives, so aligning is all that inference
does, and pages and partial wrappers are the same kind of thing.

A node is a list ``[label, optional, repeated, children, text, pages]``: text nodes have the label ``#`` and a hash of their text, or
None for a slot; groups have the label ``(``. ``pages`` is on how many pages the node was seen, at least.

Pages may nest as deeply as they like: functions that follow the tree are generators that yield the calls they need, and :func:`done` runs
them on a list instead of the stack of the interpreter.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Generator
from functools import lru_cache
from math import isqrt
from operator import add

import xxhash

LABEL, OPTIONAL, REPEATED, KIDS, TEXT, PAGES = range(6)
#: The longest group of siblings that is looked for as a repeated one.
PERIOD = 6
#: A longer run of equal siblings is repeated whatever other pages have.
RUN = 8
#: On so many different pages of a host, and on most of them, a text must be unchanged to count as fixed.
FIXED = 2
#: The same for a text within a marked main part, which an author has said to be one. It must also stand apart from paragraphs there.
FIXED_WITHIN = 3

# The elements of HTML by how their text is laid out, and names that mark what is not part of an article.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
CLOSES_ITSELF = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"),
}
BARRIERS = frozenset("ul ol dl table article section div body html main aside nav header footer form td th select blockquote".split())
LISTED = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6 blockquote figure pre".split())
LEFT_OUT = frozenset(
    "head nav header footer aside form script style noscript template iframe button select textarea svg canvas object dialog menu audio video".split()
)
ROLES_LEFT_OUT = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
NAMES_LEFT_OUT = frozenset(
    """ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus
    footer header login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promoted recommended
    related respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget""".split()
)
#: Inside an article these names also mark its own title or last lines.
NAMES_WITHIN = NAMES_LEFT_OUT - {"header", "copyright"}
CONTENT_NAMES = frozenset("article content entry post story".split())
#: Words that say where or in what form something stands. A compound of these and of names is like the name; any other compound has a sense of its own.
PLACES = frozenset(
    """area bar block bottom box button buttons col column container global group holder icons inner item items left link links list main outer page panel
    primary right row secondary section site slot sticky the top text unit wrap wrapper zone has is js c""".split()
)

_PART = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|xmp|noembed)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?<![^\s"'])(hidden)(?![^\s/>])""")
_DIGITS = re.compile(r"\d+")
_NAME = re.compile(r"[a-z]+")


def done(call: Generator):
    """The result of a generator that yields the generators whose results it needs, run without recursion."""
    calls, result = [call], None
    while calls:
        try:
            calls.append(calls[-1].send(result))
            result = None
        except StopIteration as end:
            calls.pop()
            result = end.value
    return result


@lru_cache(maxsize=10_000)
def _label(tag: str, attributes: str) -> str:
    """The element with what its attributes say about its part in the page: classes, id, role, itemprop, hidden; digits are alike."""
    found = {}
    for name, a, b, c, hidden in _ATTRIBUTE.findall(attributes):
        name = (name or hidden).lower()
        if name in ("class", "id", "role", "itemprop", "hidden"):
            found.setdefault(name, _DIGITS.sub("0", html.unescape(a or b or c)).lower())
    marks = "".join(f".{c}" for c in sorted(set(found.get("class", "").split())))
    marks += "".join(f"{sign}{found[name]}" for sign, name in (("#", "id"), ("@", "role"), ("!", "itemprop")) if found.get(name))
    return tag + marks + ("~hidden" if "hidden" in found else "")


def read(page: str) -> list:
    """The tree of a page: nodes ``[label, children]`` with texts in between; broken nesting is mended as browsers do, roughly."""
    root: list = ["", []]
    stack: list[tuple[str, list]] = [("", root[1])]
    open_tags: Counter = Counter()
    text: list[str] = []

    def flush() -> None:
        if text:
            said = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if said:
                stack[-1][1].append(said)

    def pop_to(tags: tuple[str, ...], barriers: frozenset | tuple = ()) -> bool:
        if not any(open_tags[t] for t in tags):
            return False
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in tags:
                flush()
                open_tags.subtract(name for name, _ in stack[depth:])
                del stack[depth:]
                return True
            if stack[depth][0] in barriers:
                return False
        return False

    at = 0
    for part in _PART.finditer(page):
        if part.start() > at:
            text.append(page[at:part.start()])
        at = part.end()
        end, tag, attributes = (part.group(2), part.group(3), part.group(4)) if part.group(3) else (part.group(5), part.group(6), part.group(7))
        if not tag:
            continue
        tag = tag.lower()
        if tag in INLINE:
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                text.append(" ")
                if tag == "hr":
                    flush()
            continue
        if end:
            pop_to((tag,))
            continue
        flush()
        if tag in CLOSES_P:
            pop_to(("p",), BARRIERS)
        if tag in CLOSES_ITSELF:
            while pop_to(CLOSES_ITSELF[tag], BARRIERS - {*CLOSES_ITSELF[tag]}):
                pass
        kids: list = []
        stack[-1][1].append([_label(tag, attributes or ""), kids])
        if not attributes or not attributes.rstrip().endswith("/") or tag not in ("path", "use", "rect", "circle"):
            stack.append((tag, kids))
            open_tags[tag] += 1
    if at < len(page):
        text.append(page[at:])
    flush()
    return root


def _squared(items: list, unite, every: bool) -> Generator:
    """Adjacent equal items made one repeated item, then equal groups of neighbours made one repeated group.

    ``unite(copies)`` makes one item of several equal ones, ``copies`` being lists of equal length. Unless ``every`` run is meant, only
    those that are repeated by their nature are united.
    """
    runs: list = []
    for item in items:
        if runs and runs[-1][-1][LABEL] == item[LABEL]:
            runs[-1].append(item)
        else:
            runs.append([item])
    items = []
    for run in runs:
        alike = len(run) > 1 and (every or len(run) > RUN or _tag(run[0][LABEL]) in LISTED)
        if alike:
            items.append((yield unite([[i] for i in run])))
        else:
            items += run
    for period in range(2, PERIOD + 1):
        out, i = [], 0
        while i < len(items):
            names = [x[LABEL] for x in items[i:i + period]]
            copies = 1
            if len(set(names)) > 1 and (every or all(_tag(n) in LISTED for n in names)):
                while [x[LABEL] for x in items[i + copies * period:i + (copies + 1) * period]] == names:
                    copies += 1
            if copies > 1:
                out.append((yield unite([items[i + c * period:i + (c + 1) * period] for c in range(copies)])))
                i += copies * period
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def _unite(copies: list[list]) -> Generator:
    merged = copies[0]
    for more in copies[1:]:
        both = []
        for a, b in zip(merged, more):
            both.append((yield _merged(a, b, max)))
        merged = both
    if len(merged) == 1:
        return [merged[0][LABEL], merged[0][OPTIONAL], True, *merged[0][KIDS:]]
    return ["(", False, True, merged, None, max(m[PAGES] for m in merged)]


def wrapper(node) -> list:
    """The wrapper of one page, or of a part of it."""
    return done(_wrapper(node))


def _wrapper(node) -> Generator:
    if isinstance(node, str):
        return ["#", False, False, [], xxhash.xxh3_64_hexdigest(node), 1]
    kids = []
    for kid in node[1]:
        kids.append((yield _wrapper(kid)))
    return [node[0], False, False, (yield _squared(kids, _unite, False)), None, 1]


def _name(item) -> str:
    return item[LABEL] if item[LABEL] != "(" else "(" + " ".join(k[LABEL] for k in item[KIDS]) + ")"


def _folded(items: list, groups: list, unite) -> Generator:
    """Neighbours that look like one of ``groups`` as groups, so that they can be aligned with it."""
    for group in groups:
        names, out, i = [k[LABEL] for k in group[KIDS]], [], 0
        while i < len(items):
            copies = 0
            while [x[LABEL] for x in items[i + copies * len(names):i + (copies + 1) * len(names)]] == names:
                copies += 1
            if copies:
                out.append((yield unite([items[i + c * len(names):i + (c + 1) * len(names)] for c in range(copies)])))
                i += copies * len(names)
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def aligned(left: list, right: list) -> list[tuple[int | None, int | None]]:
    """Places of a longest common subsequence of names, with what lies between on either side.

    Common ends are taken as they are. In between, the lengths of common subsequences of the rest of one side with every rest of the other are
    one whole number, a bit per place, so a step costs a few operations on it. Only every n-th of these numbers is kept, and those between are
    made again when they are needed.
    """
    a, b = [_name(x) for x in left], [_name(x) for x in right]
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    out: list[tuple[int | None, int | None]] = [(i, i) for i in range(start)]
    out += [(None if i is None else i + start, None if j is None else j + start) for i, j in _between(a[start:len(a) - end], b[start:len(b) - end])]
    return out + [(len(a) - k, len(b) - k) for k in range(end, 0, -1)]


def _between(a: list[str], b: list[str]) -> list[tuple[int | None, int | None]]:
    if not a or not b:
        return [(i, None) for i in range(len(a))] + [(None, j) for j in range(len(b))]
    size, every = len(b), (1 << len(b)) - 1
    at: dict[str, int] = {}
    for j, name in enumerate(reversed(b)):
        at[name] = at.get(name, 0) | 1 << j

    def before(i: int, row: int) -> int:
        """The row of ``a[i:]`` from that of ``a[i + 1:]``: a bit is unset where the rest of ``b`` from there on gets one more name in common."""
        same = at.get(a[i], 0)
        return (row + (row & same) | row & ~same) & every

    step = isqrt(len(a)) + 1
    kept, row = {len(a): every}, every
    for i in range(len(a) - 1, -1, -1):
        row = before(i, row)
        if i % step == 0:
            kept[i] = row
    rows: dict[int, int] = {}

    def common(i: int, j: int) -> int:
        if i not in rows:
            last = min((i // step + 1) * step, len(a))
            rows.clear()
            rows[last] = kept[last]
            for k in range(last - 1, i - i % step - 1, -1):
                rows[k] = before(k, rows[k + 1])
        return size - j - (rows[i] & (1 << size - j) - 1).bit_count()

    out: list[tuple[int | None, int | None]] = []
    i = j = 0
    while i < len(a) and j < size:
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif common(i + 1, j) >= common(i, j):  # as many in common without this one
            out.append((i, None))
            i += 1
        else:
            out.append((None, j))
            j += 1
    return out + [(k, None) for k in range(i, len(a))] + [(None, k) for k in range(j, size)]


def _groups(items: list) -> list:
    return [x for x in items if x[LABEL] == "("]


def merge(left: list, right: list) -> list:
    """The wrapper of everything that either wrapper stands for. A page that is like the only one before, and one with nothing on it, add nothing."""
    if not right[KIDS] or left[PAGES] == 1 and _flat(left) == _flat(right):
        return left
    return done(_merged(left, right, add)) if left[KIDS] else right


def _merged(left: list, right: list, pages) -> Generator:
    """``pages`` adds up the pages of nodes from different pages, or takes the larger number for those of the same pages."""
    a, b = left[KIDS], right[KIDS]
    same = left[TEXT] if left[TEXT] == right[TEXT] else None
    kids = []
    if [_name(x) for x in a] == [_name(x) for x in b]:
        for x, y in zip(a, b):
            kids.append((yield _merged(x, y, pages)))
    else:
        a, b = (yield _squared(a, _unite, True)), (yield _squared(b, _unite, True))
        a, b = (yield _folded(a, _groups(b), _unite)), (yield _folded(b, _groups(a), _unite))
        for i, j in aligned(a, b):
            if i is not None and j is not None:
                kids.append((yield _merged(a[i], b[j], pages)))
            else:
                only = a[i] if i is not None else b[j]
                kids.append([only[LABEL], True, *only[REPEATED:]])
        kids = yield _squared(kids, _unite, True)
    return [left[LABEL], left[OPTIONAL] or right[OPTIONAL], left[REPEATED] or right[REPEATED], kids, same, pages(left[PAGES], right[PAGES])]


@lru_cache(maxsize=10_000)
def _tag(label: str) -> str:
    return re.split(r"[.#@!~]", label, maxsplit=1)[0]


def _named(marks: str, names: frozenset) -> bool:
    """Whether a class or id is one of the names, or a compound of names and of words for places."""
    for token in re.findall(r"[.#]([^.#@!~]+)", marks):
        words = set(_NAME.findall(token))
        if words & names and words <= names | PLACES:
            return True
    return False


@lru_cache(maxsize=10_000)
def part_of(label: str, within: bool) -> str:
    """What an element is by its label: ``out``, ``article``, ``main``, ``content`` or nothing; ``within`` an article or not."""
    tag = _tag(label)
    if tag in ("", "html", "body"):
        return ""
    marks = label[len(tag):]
    role = (re.findall(r"@([a-z]+)", marks) or [""])[0]
    if tag in LEFT_OUT or role in ROLES_LEFT_OUT or _named(marks, NAMES_WITHIN if within else NAMES_LEFT_OUT) or marks.endswith("~hidden"):
        return "out"
    if tag == "article" or role == "article" or "!articlebody" in marks:
        return "article"
    if tag == "main" or role == "main":
        return "main"
    return "content" if _named(marks, CONTENT_NAMES) else ""


class _Held:
    """A sibling of a page, or a run of equal ones, beside the wrapper node it stands for."""

    __slots__ = ("node", "members")

    def __init__(self, node: list, members: list):
        self.node, self.members = node, members

    def __getitem__(self, place: int):
        return self.node[place]


def _unite_held(copies: list[list[_Held]]) -> Generator:
    if len(copies[0]) == 1:
        return _Held(copies[0][0].node, [m for c in copies for m in c[0].members])
    first = copies[0]
    return _Held(["(", False, True, [h.node for h in first], None, 0], [m for c in copies for m in c])
    yield  # needs no call, but is run like one


class _Said:
    """A text of the main part: how many pages have it unchanged for sure, whether it is below something repeated, or of a paragraph or the like."""

    __slots__ = ("text", "pages", "listed", "prose", "inside")

    def __init__(self, text: str, pages: int, listed: bool, prose: bool, inside: frozenset):
        self.text, self.pages, self.listed, self.prose, self.inside = text, pages, listed, prose, inside


def extract(tree: list, learnt: list) -> str:
    """The main text of a page, by the wrapper of its host.

    The page is aligned with the wrapper; texts belong to the slots they fall on. The main part is that of articles, or else
    of the main element, or else of elements that are named as content, or else all of the page. The main element comes before articles
    when more text is outside of them than within. Of the main part all texts count but fixed ones: those that two or more different pages, and
    most of the host, have unchanged, and that are not optional. In a marked part more must speak against a text: three pages have
    it, it is not below anything repeated, and it is no paragraph, heading, item or the like but stands apart from such texts, of which some differ.
    """
    said: list[_Said] = []
    most = learnt[PAGES] // 2 + 1

    def walk(kids: list, nodes: list, inside: frozenset, sure: bool, listed: bool, prose: bool) -> Generator:
        if len(kids) == 1 and isinstance(kids[0], str) and len(nodes) == 1 and nodes[0][LABEL] == "#":
            say(kids[0], nodes[0], inside, sure, listed, prose)
            return
        items = [_Held(["#" if isinstance(k, str) else k[0], False, False, [], None, 0], [k]) for k in kids]
        held = yield _squared(items, _unite_held, False)
        if [_name(x) for x in held] != [_name(x) for x in nodes]:
            held = yield _folded((yield _squared(items, _unite_held, True)), _groups(nodes), _unite_held)
        yield place(held, nodes, inside, sure, listed, prose)

    def place(items: list, nodes: list, inside: frozenset, sure: bool, listed: bool, prose: bool) -> Generator:
        for i, j in aligned(items, nodes):
            if i is None:
                continue
            node = nodes[j] if j is not None else items[i].node
            always, many = sure and not node[OPTIONAL], listed or node[REPEATED]
            for member in items[i].members:
                if isinstance(member, _Held):
                    yield spread(items[i], node, inside, always, many, prose)
                    break
                if isinstance(member, str):
                    say(member, node, inside, sure, listed, prose)
                    continue
                kind = part_of(member[0], "article" in inside)
                if kind != "out":
                    below = inside | {kind} if kind and kind not in inside else inside
                    yield walk(member[1], node[KIDS], below, always, many, prose or _tag(member[0]) in LISTED)

    def spread(group: _Held, node: list, inside: frozenset, sure: bool, listed: bool, prose: bool) -> Generator:
        for k, member in enumerate(group.members):
            yield place([member], [node[KIDS][k % len(node[KIDS])]] if node[KIDS] else [], inside, sure, listed, prose)

    def say(text: str, node: list, inside: frozenset, sure: bool, listed: bool, prose: bool) -> None:
        pages = node[PAGES] if sure and not node[OPTIONAL] and node[TEXT] is not None and node[PAGES] >= most else 0
        if pages and node[TEXT] != xxhash.xxh3_64_hexdigest(text):
            pages = 0
        said.append(_Said(text, pages, listed or node[REPEATED], prose, inside))

    done(walk(tree[1], learnt[KIDS], frozenset(), _has_slot(learnt), False, False))
    size = {kind: sum(len(x.text) for x in said if kind in x.inside) for kind in ("article", "main", "content")}
    apart = sum(len(x.text) for x in said if "main" in x.inside and "article" not in x.inside)
    kind = next((k for k in ("article", "main", "content") if size[k] and not (k == "article" and apart > size[k])), None)
    if kind is None:
        return " ".join(x.text for x in said if x.pages < FIXED)
    part = [x for x in said if kind in x.inside]
    differ = any(x.prose and x.pages < FIXED_WITHIN for x in part)
    return " ".join(x.text for x in part if x.pages < FIXED_WITHIN or x.listed or x.prose or not differ)


def _has_slot(node: list) -> bool:
    left = [node]
    while left:
        for kid in left.pop()[KIDS]:
            if kid[LABEL] == "#" and kid[TEXT] is None:
                return True
            left.append(kid)
    return False


def _flat(node: list) -> list[list]:
    """Nodes from the root on, each before its children, with the number of these in their place."""
    out, left = [], [node]
    while left:
        now = left.pop()
        out.append([*now[:KIDS], len(now[KIDS]), *now[TEXT:]])
        left += reversed(now[KIDS])
    return out


def dumps(node: list) -> str:
    return json.dumps(_flat(node), separators=(",", ":"))


@lru_cache(maxsize=2_000)
def loads(text: str) -> list:
    top: list = []
    waiting = [(top, 1)]  # where nodes go, and how many are missing there
    for row in json.loads(text):
        while not waiting[-1][1]:
            waiting.pop()
        kids, missing = waiting[-1]
        waiting[-1] = kids, missing - 1
        node = [*row[:KIDS], [], *row[TEXT:]]
        kids.append(node)
        waiting.append((node[KIDS], row[KIDS]))
    return top[0]
