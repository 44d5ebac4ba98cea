"""The objects nested in a saved document, as numbered intervals, from one pass over its text."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

from docloom.functions.spans import _SCALAR, _STRING, _WS, _PLAIN_STRING, applied

_STATES, _LIST = -2, -1

# Lists and objects of scalars alone are read like scalars.
_FLAT_LIST = rf"\[{_WS}(?:{_SCALAR}{_WS}(?:,{_WS}{_SCALAR}{_WS})*+)?+\]"
_PAIR = f"{_STRING}{_WS}:{_WS}{_SCALAR}{_WS}"
_VALUE = rf"(?:{_SCALAR}|{_FLAT_LIST}|\{{{_WS}(?:{_PAIR}(?:,{_WS}{_PAIR})*+)?+\}})"

_SPACE = re.compile(_WS)
_SCALAR_TEXT = re.compile(f"{_WS}{_SCALAR}{_WS}")
#: Members of an object or elements of a list with their commas, then a key without its value (group 1), a last value (2), or none.
_IN_OBJECT = re.compile(f"(?:{_WS}{_STRING}{_WS}:{_WS}{_VALUE}{_WS},)*+{_WS}(?:({_STRING}){_WS}:{_WS}({_VALUE}{_WS})?+)?+")
_IN_LIST = re.compile(f"(?:{_WS}{_VALUE}{_WS},)*+{_WS}()({_VALUE}{_WS})?+")
#: The same in a list that holds objects, which aren't passed over.
_AMONG_OBJECTS = re.compile(f"(?:{_WS}(?:{_SCALAR}|{_FLAT_LIST}){_WS},)*+{_WS}()((?:{_SCALAR}|{_FLAT_LIST}){_WS})?+")


@cache
def _members(*watched: str) -> re.Pattern:
    """The same in an object: a key that is watched, or written with escapes, is group 3, its value, if a scalar, group 4."""
    names = "|".join(re.escape(json.dumps(k, ensure_ascii=False)[1:]) for k in watched)
    key = f'"(?!{names}){_PLAIN_STRING[1:]}'
    return re.compile(f"(?:{_WS}{key}{_WS}:{_WS}{_VALUE}{_WS},)*+{_WS}(?:({key}){_WS}:{_WS}({_VALUE}{_WS})?+|({_STRING}){_WS}:{_WS}({_SCALAR}{_WS})?+)?+")


def _after(text: str, i: int) -> int:
    """Where the list or object that begins at i ends, with the space after it; -1 if it isn't JSON."""
    closing: list[str] = []
    while True:
        closing.append("}" if text[i] == "{" else "]")
        i, first = i + 1, True
        while True:
            m = (_IN_OBJECT if closing[-1] == "}" else _IN_LIST).match(text, i)
            begin, i = i, m.end()
            c = text[i : i + 1]
            if m[2] is None and c in ("{", "[") and m[1] is not None:
                break
            if c != closing[-1] or m[2] is None and not (first and not m[1] and not text[begin:i].strip()):
                return -1
            while c == closing[-1]:
                closing.pop()
                i = _SPACE.match(text, i + 1).end()
                if not closing:
                    return i
                c = text[i : i + 1]
            if c != ",":
                return -1
            i, first = i + 1, False


class _Nesting:
    """The objects of a text in the order in which they begin, as columns. Lists that hold objects are those under `children` of
    an object, under `root` of the document itself, and the document if it is a list; all else is passed over in runs."""

    def __init__(self, root: str, children: str):
        self.root, self.children = root, children
        self.parent: list[int] = []  # the number of the object around, or _STATES, _LIST
        self.place: list[int] = []  # among the objects beside it
        self.start: list[int] = []
        self.end: list[int] = []
        self.last: list[int] = []  # the largest number in it
        self.inner: list[list[tuple[int, int]] | None] = []  # the lists of its own objects
        self.states = False  # whether the document has a list under `root`

    def _open(self, parent: int, place: int, at: int) -> int:
        self.parent.append(parent)
        self.place.append(place)
        self.start.append(at)
        self.end.append(-1)
        self.last.append(-1)
        self.inner.append(None)
        return len(self.parent) - 1

    def read(self, text: str) -> bool:
        """Whether the text is JSON, all its objects told."""
        i = _SPACE.match(text).end()
        if (c := text[i : i + 1]) not in ("{", "["):
            return (m := _SCALAR_TEXT.fullmatch(text)) is not None and m.end() > 0
        top, below = _members(self.children, self.root), _members(self.children)
        around: list[tuple[int, int, int]] = []  # of what is open around: an object's number, -1; or what holds a list's objects, how many, its place
        at, count, begin = (self._open(_LIST, 0, i), -1, i) if c == "{" else (_LIST, 0, i)  # of what is open itself
        i, first = i + 1, True
        while True:
            if count < 0:
                m = (below if at else top).match(text, i)
                here, i = i, m.end()
                c = text[i : i + 1]
                if c in ("{", "[") and (m[1] is not None and m[2] is None or m[3] is not None and m[4] is None):
                    key = None if m[3] is None else m[3][1:-1] if "\\" not in m[3] else json.loads(m[3])
                    if c == "[" and (key == self.children or at == 0 and key == self.root and self.parent[0] == _LIST and not around):
                        self.states = self.states or key != self.children
                        around.append((at, -1, begin))
                        at, count, begin = at if key == self.children else _STATES, 0, i
                        i, first = i + 1, True
                        continue
                    i = _after(text, i)
                    if i < 0:
                        return False
                    c = text[i : i + 1]
                elif m[2] is None and m[4] is None and not (c == "}" and first and m[1] is None and m[3] is None and not text[here:i].strip()):
                    return False
            else:
                m = _AMONG_OBJECTS.match(text, i)
                here, i = i, m.end()
                c = text[i : i + 1]
                if m[2] is None and c == "{":
                    around.append((at, count + 1, begin))
                    at, count, begin = self._open(at, count, i), -1, i
                    i, first = i + 1, True
                    continue
                if m[2] is None and c == "[":
                    i = _after(text, i)
                    if i < 0:
                        return False
                    c = text[i : i + 1]
                elif m[2] is None and not (c == "]" and first and not text[here:i].strip()):
                    return False
            while c == ("}" if count < 0 else "]"):  # what is open is over
                i += 1
                if count < 0:
                    self.end[at], self.last[at] = i, len(self.parent) - 1
                if not around:
                    return _SPACE.match(text, i).end() == len(text)
                up, n, since = around.pop()
                if count >= 0:
                    if self.inner[up] is None:
                        self.inner[up] = []
                    self.inner[up].append((begin, i))
                at, count, begin = up, n, since
                c = text[i : i + 1]
                if c in " \t\n\r":
                    i = _SPACE.match(text, i).end()
                    c = text[i : i + 1]
            if c != ",":
                return False
            i, first = i + 1, False


def nested_objects(text: str | None, root: str, children: str) -> Iterator[tuple[int, int, int, int, int, str]]:
    """(enter, leave, depth, parent, place, own text) of each object in a document, in the order in which they begin: `enter`
    counts from 1, `leave` is the largest number within, `parent` the number of the object around it (0 for none), `place`
    the position among the objects beside it. The own text has its lists of objects empty. Nothing for a text that isn't JSON.

    Roots are the objects in the list under `root`, else in a top-level list or under `children`, else the document itself.
    """
    found = _Nesting(root, children)
    if text is None or not found.read(text) or not found.parent:
        return
    whole = text.lstrip(" \t\n\r").startswith("{")
    top = _STATES if found.states else 0 if whole and found.inner[0] else _LIST
    number, depth, upto = [], [], []
    count = 0  # numbers given up to and including each object
    for parent in found.parent:
        d = 0 if parent == top else depth[parent] + 1 if parent >= 0 and depth[parent] >= 0 else -1
        count += d >= 0
        depth.append(d)
        number.append(count if d >= 0 else 0)
        upto.append(count)
    for i, (parent, place, start, end, last, inner, d) in enumerate(zip(found.parent, found.place, found.start, found.end, found.last, found.inner, depth, strict=True)):
        if d < 0:
            continue
        if inner is None:
            own = text[start:end]
        elif len(inner) == 1:
            own = f"{text[start : inner[0][0]]}[]{text[inner[0][1] : end]}"
        else:
            own = applied(text, ((a, b, "[]") for a, b in inner), start, end)
        yield number[i], upto[last], d, 0 if parent == top else number[parent], place, own
