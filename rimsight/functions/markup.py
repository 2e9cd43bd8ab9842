"""Stored HTML read in one tokenising pass: elements nest, quotes are of both kinds, entities are decoded.

Tasks turn a page into a few plain values (texts, addresses, lists of them) through small
functions over ``Page``; everything after that is column expressions.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from rimsight.session import ship_package

SLICE_ROWS, SLICE_CHARS = 512, 4 << 20

# fixed values: elements without content, elements that end others of their kind, and what bounds the search for those
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CELLS, _ROWS = {"td", "th"}, {"td", "th", "tr"}
_PARTS = {"td", "th", "tr", "thead", "tbody", "tfoot"}
ENDS: dict[str, tuple[set[str], set[str]]] = {
    "li": ({"li"}, {"ul", "ol", "table"}), "td": (_CELLS, {"tr", "table"}), "th": (_CELLS, {"tr", "table"}), "tr": (_ROWS, {"table"}),
    "thead": (_PARTS, {"table"}), "tbody": (_PARTS, {"table"}), "tfoot": (_PARTS, {"table"}), "option": ({"option"}, {"select"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    **dict.fromkeys(["p", "div", "ul", "ol", "table", "h1", "h2", "h3", "h4", "section"], ({"p"}, {"div", "li", "td", "th", "table", "section"})),
}
SCOPES = {"td": {"tr"}, "th": {"tr"}, "tr": {"table"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
_REST = r"[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*"
# a tag, a comment or a declaration; a sign that opens none of these is text
_MARKS = re.compile(rf"(</?[a-z][^\s/>]*{_REST}>|<!--.*?(?:-->|\Z)|<[!?][^>]*>)", re.S | re.I)
_MARK = re.compile(rf"<(/?)([a-z][^\s/>]*)({_REST})>", re.S | re.I)
# the inside of a tag whose quotes all close and whose name has none: it is the same tag whatever follows it
_PLAIN = re.compile(r"(/?)([a-z][^\s/<>\"']*)((?:[\s/][^<>\"']*(?:\"[^<>\"]*\"[^<>\"']*|'[^<>']*'[^<>\"']*)*)?)", re.S | re.I)
# what stands in a script or style is no markup
_RAW_PART = re.compile(rf"<(script|style)\b({_REST})>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


# what stands around the values of attributes that are all in double quotes: the tag, names, an end
_OUTLINE_NAME = re.compile(r"\s+([^\s=/<>\"']+)\s*=\s*")
_OUTLINE_END = re.compile(r"\s*(/?)")


def _decoded(text: str) -> str:
    return (entities.unescape(text) if "&" in text else text).replace("\xa0", " ")


def _attributes(rest: str) -> dict[str, str]:
    attrs: dict[str, str] = {}
    if "=" in rest:
        for name, one, two, three in _ATTRIBUTE.findall(rest):
            value = one or two or three
            attrs.setdefault(name.lower(), entities.unescape(value) if "&" in value else value)
    return attrs


# a mark without what may differ in pages of one template: closing, tag, classes, ended in itself, own attributes
Kind = tuple[bool, str, str, bool, bool]
_ASIDE: Kind = (False, "", "", False, False)


def _kind(found: re.Match) -> tuple[Kind, dict[str, str]]:
    closing, tag, rest = found.groups()
    if closing:
        return (True, tag.lower(), "", False, False), {}
    attrs = _attributes(rest)
    return (False, tag.lower(), attrs.get("class", ""), rest.endswith("/"), bool(attrs.keys() - {"class"})), attrs


def _outline(around: tuple[str, ...]) -> tuple[str, list[str], bool] | None:
    """Tag and attributes by what stands around their values, and whether the tag is ended in itself; null if they have to be looked for."""
    tag = around[0].split(None, 1)[0] if around[0].strip() else ""
    if len(around) < 2 or not _PLAIN.fullmatch(tag) or "/" in tag:
        return None
    found = [_OUTLINE_NAME.fullmatch(piece) for piece in (around[0][len(tag) :], *around[1:-1])]
    end = _OUTLINE_END.fullmatch(around[-1])
    names = [f[1].lower() for f in found if f]
    if not around[0].startswith(tag) or end is None or len(set(names)) < len(around) - 1 or names == ["class"]:
        return None
    return tag.lower(), names, bool(end[1])


class Shape:
    """The tree of a page without its texts and addresses, and what was looked up in it."""

    def __init__(self, kinds: Sequence[Kind], filled: Sequence[bool], codes: tuple[int, ...], muted: str) -> None:
        self.codes = codes  # the marks and whether a text follows each
        self.tag: list[str] = []
        self.last: list[int] = []
        self.scope: list[int] = []  # the enclosing table (tr, thead, tbody), row (td, th) or other parent, -1 at the top
        self.attrs: list[dict] = []  # of elements that have nothing but classes
        self.own: list[int] = []  # elements with other attributes
        self.words: list[int] = []  # text nodes
        self.hidden: list[bool] = []  # text for screen readers only
        self.starts: list[int] = []  # the mark an element begins with
        self.stops: list[int] = []  # the mark it ends before
        self.tags: dict[str, list[int]] = {}
        self.classes: dict[str, list[int]] = {}
        self.known: dict = {}
        self._build(kinds, filled, muted)

    def _build(self, kinds: Sequence[Kind], filled: Sequence[bool], muted: str) -> None:
        tags, lasts, scopes, attributes, hiddens = self.tag, self.last, self.scope, self.attrs, self.hidden
        by_tag, by_class, plain = self.tags, self.classes, {}
        starts, stops = self.starts, self.stops
        open_: list[tuple[str, int, bool]] = [("", -1, False)]  # tag, place, inside text for screen readers; the page itself first
        lasts.append(0)  # the page's own, taken off below
        stops.append(0)

        def close(count: int) -> None:
            for _ in range(count):
                place = open_.pop()[1] + 1
                lasts[place], stops[place] = len(tags) - 1, mark

        for mark, (text, (closing, tag, classes, ended, own)) in enumerate(zip(filled, [*kinds, _ASIDE])):
            if text:
                _, place, hidden = open_[-1]
                self.words.append(len(tags))
                lasts.append(len(tags))
                starts.append(mark)
                stops.append(mark + 1)
                tags.append("")
                attributes.append(plain)
                scopes.append(place)
                hiddens.append(hidden)
            if not tag:
                continue
            if closing:
                if open_[-1][0] == tag:
                    place = open_.pop()[1] + 1
                    lasts[place], stops[place] = len(tags) - 1, mark
                    continue
                for k in range(len(open_) - 1, 0, -1):
                    if open_[k][0] == tag:
                        close(len(open_) - k)
                        break
                    if open_[k][0] == "table":  # what stands outside a table does not end inside it
                        break
                continue
            if tag in ENDS:
                ends, bounds = ENDS[tag]
                outer = None
                for k in range(len(open_) - 1, 0, -1):
                    if open_[k][0] in ends:
                        outer = k
                    elif open_[k][0] in bounds:
                        break
                if outer is not None:
                    close(len(open_) - outer)
            n = len(tags)
            _, scope, hidden = open_[-1]
            if classes:
                names = classes.split()
                hidden = hidden or muted in names
                for name in names:
                    by_class.setdefault(name, []).append(n)
            if own:
                self.own.append(n)
            if tag in SCOPES:
                up = SCOPES[tag]
                scope = next((place for name, place, _ in reversed(open_) if name in up), -1)
            by_tag.setdefault(tag, []).append(n)
            lasts.append(n)
            starts.append(mark)
            stops.append(mark + 1)
            tags.append(tag)
            attributes.append({"class": classes} if classes else plain)
            scopes.append(scope)
            hiddens.append(hidden)
            if tag not in VOID and not ended:
                open_.append((tag, n, hidden))
        close(len(open_))
        del lasts[0], stops[0]


class Shapes:
    """Trees of the pages read last: pages of one template differ in texts and addresses only, and share theirs.

    A page's marks and which of its texts are filled decide its tree, so a shared one is the page's own.
    What is kept is bounded; a page of a tree not kept is read in full.
    """

    NODES, MARKS = 60_000, 4_096

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.nodes = 0
        self.numbers: dict[str, int] = {}  # marks without attributes of their own, as places in kinds
        self.bare: dict[str, int] = {}  # codes of those, cut at the sign that opens them, where no text follows
        self.outlines: dict[tuple[str, ...], tuple | None] = {}  # marks with attributes of their own, without the values
        self.places: dict[Kind, int] = {}
        self.kinds: list[Kind] = []
        self.shapes: dict[tuple, Shape] = {}
        self.parts: dict[tuple, object] = {}  # what was found in an element, by its codes

    def _number(self, mark: str, found: re.Match | None) -> tuple[int, dict | None]:
        kind, attrs = (_ASIDE, {}) if found is None else _kind(found)
        place = self._place(kind)
        if kind[-1]:
            return place, attrs
        self.numbers[mark] = place
        return place, None

    def _place(self, kind: Kind) -> int:
        place = self.places.setdefault(kind, len(self.kinds))
        if place == len(self.kinds):
            self.kinds.append(kind)
        return place

    def _outlined(self, mark: str) -> tuple[int, dict] | None:
        """A plain tag with attributes of its own, if all values are in double quotes."""
        parts = mark.split('"')
        around = tuple(parts[::2])
        if around not in self.outlines:
            made = _outline(around)
            if made is not None and "class" not in made[1]:
                made = (*made, self._place((False, made[0], "", made[2], True)))
            self.outlines[around] = made
        made = self.outlines[around]
        if made is None or not len(parts) & 1:
            return None
        values = parts[1::2]
        if "&" in mark:
            values = [entities.unescape(v) if "&" in v else v for v in values]
        attrs = dict(zip(made[1], values))
        return made[3] if len(made) > 3 else self._place((False, made[0], attrs["class"], made[2], True)), attrs

    def _plain(self, pieces: Sequence[str], own: list[dict], words: list[str]) -> list[int] | None:
        """Codes of what stands between opening signs, if all of it is a plain tag and the text after it."""
        codes = list(map(self.bare.get, pieces))
        if None in codes:
            for k, code in enumerate(codes):
                if code is None:
                    mark, sign, text = pieces[k].partition(">")
                    if not sign:
                        return None
                    number = self.numbers.get(mark)
                    if number is None:
                        number = self._new(mark, own)
                        if number is None:
                            return None
                    if text:
                        words.append(text)
                        codes[k] = 2 * number + 1
                    else:
                        codes[k] = 2 * number
        return codes

    def _new(self, mark: str, own: list[dict]) -> int | None:
        """The number of a plain tag not among those kept, null if it is none."""
        made = self._outlined(mark) if '"' in mark else None
        if made is None:
            found = _PLAIN.fullmatch(mark)
            if found is None:
                return None
            made = self._number(mark, found)
        number, attrs = made
        if attrs is None:
            self.bare[mark + ">"] = 2 * number
        else:
            own.append(attrs)
        return number

    def _any(self, source: str, own: list[dict], words: list[str]) -> list[int]:
        """Codes of a page of any marks, which keep their signs to be told from plain ones; the first is of the text before all."""
        head, *rest = _MARKS.split(source)
        words += [head] if head else []
        codes = [int(bool(head))]
        for mark, text in zip(rest[::2], rest[1::2]):
            number = self.numbers.get(mark)
            if number is None:
                number, attrs = self._number(mark, _MARK.fullmatch(mark))
                if attrs is not None:
                    own.append(attrs)
            if text:
                words.append(text)
            codes.append(2 * number + bool(text))
        return codes

    def read(self, source: str, muted: str) -> tuple[Shape, list[dict], list[str]]:
        """A page's tree, the attributes of its elements that have others than classes, and its texts."""
        if max(len(self.numbers), len(self.kinds), len(self.outlines)) > self.MARKS or self.nodes > self.NODES:
            self.clear()
        head, *pieces = source.split("<")
        own: list[dict] = []
        words = [head] if head else []
        codes = self._plain(pieces, own, words)
        if codes is None:
            own, words = [], []
            head, *codes = self._any(source, own, words)
        key = (muted, bool(head), tuple(codes))
        shape = self.shapes.get(key)
        if shape is None:
            filled = [bool(head), *[bool(c & 1) for c in codes]]
            shape = self.shapes[key] = Shape([self.kinds[c >> 1] for c in codes], filled, key[2], muted)
            self.nodes += len(shape.tag)
        return shape, own, words


_SHAPES = Shapes()


class Page:
    """Nodes of a page in document order. A node's subtree is the run up to its last node, so the inside of any
    element is a range, however deep elements of one kind nest. Text nodes have the tag ''."""

    def __init__(self, source: str, muted: str = "sr-only") -> None:
        if "<script" in source or "<style" in source or "<SCRIPT" in source or "<STYLE" in source:
            source = _RAW_PART.sub(r"<\1\2></\1>", source)
        shape, own, self.words = _SHAPES.read(source, muted)
        self.shape, self.tag, self.last, self.scope, self.hidden = shape, shape.tag, shape.last, shape.scope, shape.hidden
        self.attrs = shape.attrs
        if own:
            self.attrs = shape.attrs.copy()
            for node, attrs in zip(shape.own, own):
                self.attrs[node] = attrs
        if "&" in source or "\xa0" in source:
            self.words = [_decoded(t) if "&" in t or "\xa0" in t else t for t in self.words]

    @property
    def text(self) -> list[str]:
        out = [""] * len(self.tag)
        for node, word in zip(self.shape.words, self.words):
            out[node] = word
        return out

    def once(self, key: tuple, find: Callable[[], object]) -> object:
        """What ``find`` gives, looked up once for all pages of the tree: it may depend on nothing but tags and classes."""
        known = self.shape.known
        if key not in known:
            known[key] = find()
        return known[key]

    def part(self, node: int, find: Callable[[Page, int], object]) -> tuple[object, int]:
        """What ``find`` gives of an element, looked up once for all elements of the same marks, and the element's first word.

        It may depend on nothing but the tags and classes in the element, and counts elements from the element
        and words from its first. Pages rarely have as many rows as others, so their trees differ where rows do not.
        """
        shape = self.shape
        key = (find, node)
        known = shape.known.get(key)
        if known is None:
            start, stop = shape.starts[node], shape.stops[node]
            alike = (find, shape.hidden[node], shape.codes[start:stop])
            parts = _SHAPES.parts
            if alike not in parts:
                parts[alike] = find(self, node)
                _SHAPES.nodes += stop - start
            known = shape.known[key] = (parts[alike], bisect_left(shape.words, node))
        return known

    def places(self, node: int | None, outer: int) -> list[int] | None:
        """Places of a node's text among the words of an element around it; null without a node."""
        return None if node is None else [k - bisect_left(self.shape.words, outer) for k in self._words_of(node, False)]

    def said(self, places: list[int] | None, first: int) -> str | None:
        """The text at places counted from an element's first word."""
        if places is None:
            return None
        return self.words[first + places[0]] if len(places) == 1 else "".join([self.words[first + k] for k in places])

    def _within(self, places: list[int] | None, node: int | None) -> list[int]:
        if not places or node is None:
            return places or []
        return places[bisect_right(places, node) : bisect_right(places, self.last[node])]

    def tagged(self, tag: str, node: int | None = None) -> list[int]:
        """Elements of a tag below a node, or in the page."""
        return self.once(("tag", tag, node), lambda: self._within(self.shape.tags.get(tag), node))

    def classed(self, name: str, node: int | None = None) -> list[int]:
        return self.once(("class", name, node), lambda: self._within(self.shape.classes.get(name), node))

    def first(self, places: Sequence[int]) -> int | None:
        return places[0] if places else None

    def by_id(self, *ids: str) -> int | None:
        return next((k for k in self.shape.own if self.attrs[k].get("id") in ids), None)

    def inside(self, node: int, outer: int) -> bool:
        return outer < node <= self.last[outer]

    def after(self, tag: str, node: int) -> int | None:
        """The first element of a tag that starts after a node does."""
        places = self.shape.tags.get(tag, [])
        k = bisect_left(places, node + 1)
        return places[k] if k < len(places) else None

    def text_of(self, node: int | None, separator: str = "", everything: bool = False) -> str | None:
        """Text below a node, without (or with) what only screen readers get; null without a node."""
        if node is None:
            return None
        key = ("text", node, everything)
        known = self.shape.known
        if key not in known:
            known[key] = self._words_of(node, everything)
        words = known[key]
        return self.words[words[0]] if len(words) == 1 else separator.join([self.words[k] for k in words])

    def _words_of(self, node: int, everything: bool) -> list[int]:
        nodes = self.shape.words
        places = range(bisect_right(nodes, node), bisect_right(nodes, self.last[node]))
        return [k for k in places if everything or not self.hidden[nodes[k]]]

    def href(self, node: int) -> str:
        """Address of the first link below a node, '' if there is none."""
        found = self.tagged("a", node)
        return self.attrs[found[0]].get("href", "") if found else ""

    def texts_of(self, nodes: Sequence[int | None]) -> list[str | None]:
        return [None if k is None else self.text_of(k) for k in nodes]

    def rows(self, table: int) -> list[int]:
        """Rows of a table, not those of tables inside it."""
        return self.once(("rows", table), lambda: [r for r in self.tagged("tr", table) if self.scope[r] == table])

    def cells(self, row: int) -> list[int]:
        """Cells of a row, not those of tables inside them."""
        below = range(row + 1, self.last[row] + 1)
        return self.once(("cells", row), lambda: [k for k in below if self.tag[k] in _CELLS and self.scope[k] == row])


def _array(values: list, kind: pa.DataType) -> pa.Array:
    """Plain values as an Arrow array, nested ones by their fields."""
    if pa.types.is_list(kind):
        ends = list(accumulate([0 if v is None else len(v) for v in values], initial=0))
        missing = None in values
        starts = pa.array([None if v is None else k for v, k in zip(values, ends)] + ends[-1:] if missing else ends, pa.int32())
        return pa.ListArray.from_arrays(starts, _array([x for v in values if v for x in v], kind.value_type)).cast(kind)
    if pa.types.is_struct(kind) and None not in values:
        return pa.StructArray.from_arrays([_array([v[f.name] for v in values], f.type) for f in kind], fields=list(kind))
    return pa.array(values, kind)


def parsed(pages: DataFrame, keep: Sequence[str], kind: str, read: Callable[[Page], object], html: str = "html") -> DataFrame:
    """Columns to keep and ``found``, of the type ``kind``: what ``read`` makes of each page, null for a null page.

    Pages are read a few megabytes at a time.
    """
    ship_package(pages.sparkSession)
    schema = T.StructType([*[pages.schema[c] for c in keep], T.StructField("found", T.DataType.fromDDL(kind))])
    made = to_arrow_type(schema["found"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep))
            at = 0
            while at < len(batch):
                found, chars = [], 0
                while at + len(found) < len(batch) and chars < SLICE_CHARS and len(found) < SLICE_ROWS:
                    text = texts[at + len(found)].as_py()
                    chars += len(text or "")
                    found.append(None if text is None else read(Page(text)))
                own = [batch.column(c).slice(at, len(found)) for c in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*own, _array(found, made)], [*keep, "found"])
                at += len(found)

    return pages.select(*keep, html).mapInArrow(run, schema)
