r"""A scanner of JSON texts that yields places, not values, so that rules can cut and replace stretches of a text and leave
all others as they are, byte for byte: escapes of lone surrogates, 1e400, decimals of any length, white space.

A text is read once, from left to right, with the open objects and lists alone on a stack: no tree is built, nesting may be
as deep as it likes. What a rule doesn't watch is passed over in runs, many members at a time. Texts that aren't one JSON
value, as Python's json module has it (NaN and infinities too), are told apart.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol

_WS = r"[ \t\n\r]*+"
_PLAIN_STRING = r'"[^"\\\x00-\x1f]*+"'
_STRING = r'"[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+"'
_INTEGER = r"-?(?:0|[1-9][0-9]*+)(?![0-9.eE])"
_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?"
_NAME = r"(?:true|false|null|NaN|-?Infinity)"
_SCALAR = f"(?:{_STRING}|{_NUMBER}|{_NAME})"

_MEMBER = re.compile(f"{_WS}({_STRING}){_WS}:{_WS}({_SCALAR})?")
_ELEMENT = re.compile(f"{_WS}()({_SCALAR})?")
_SPACE = re.compile(_WS)
_OPENING = re.compile(rf"(?:{_WS}\[)++")
_CLOSING = re.compile(rf"\](?:{_WS}\])*+")

#: How far a rule looks into an object or list: not at all, at its members but no deeper by itself, or all the way.
SKIP, LOOK, FULL = range(3)

#: A stretch of the text, and what takes its place.
Edit = tuple[int, int, str]


@dataclass(slots=True)
class Member:
    """A member of an object, an element of a list, or several that nobody watches (key None, value None)."""

    start: int
    end: int
    key: str | None = None
    at: int = -1  # where the value begins
    frame: Frame | None = None
    gone: bool = False
    new: str | None = None  # what takes its value's place


@dataclass(slots=True)
class Frame:
    """An object or list while it is open, and after that as long as a rule keeps it."""

    is_object: bool
    key: str | None  # of the member that it is; a list hands its key to its elements
    up: Frame | None
    mode: int = FULL
    numbers: bool = False  # whether whole numbers are watched too
    members: list[Member] = field(default_factory=list)
    depth: int = 1  # how many lists it stands for that begin right after one another, each the first element of the last
    more: str | None = None  # a member to put after the last one
    state: Any = None  # what else a rule keeps

    def add(self, m: Member, watched: bool) -> None:
        last = self.members[-1] if self.members else None
        if not watched and last is not None and last.at < 0:
            last.end = m.end
        else:
            self.members.append(m if watched else Member(m.start, m.end))


class Rule(Protocol):
    """What to watch, and what to make of a frame that has been read; edits within a stretch that is cut don't count."""

    keys: frozenset[str]  # of members that are told one by one
    fractions: bool  # whether numbers that aren't written as whole ones are
    lists_alike: bool  # whether a list in a list is treated as the outer one is, and edited in its own elements alone

    def enter(self, frame: Frame) -> None:
        """Sets how far to look into a frame that opens."""

    def keeps(self, frame: Frame) -> bool:
        """Whether a frame that closes stays on hand until the one around it closes."""

    def leave(self, text: str, frame: Frame) -> Iterable[Edit]:
        """What to edit when a frame closes."""


def changes(frame: Frame) -> Iterator[Edit]:
    """Cuts for the members that are gone, each with one comma, and what else its members say."""
    kept, begin, end = False, None, -1
    for m in frame.members:
        if m.gone and kept:
            yield end, m.end, ""
        elif m.gone:
            begin = m.start if begin is None else begin
        else:
            if begin is not None:
                yield begin, m.start, ""
            if m.new is not None:
                yield m.at, m.end, m.new
            kept, begin = True, None
        end = m.end
    if begin is not None:
        yield begin, end, ""
    if frame.more:
        yield end, end, f",{frame.more}" if kept else frame.more


def applied(text: str, edits: Iterable[Edit], start: int = 0, end: int | None = None) -> str:
    """The text, or a stretch of it, after the edits."""
    out, at = [], start
    for a, b, new in sorted(edits, key=lambda e: (e[0], -e[1])):
        if a >= at:
            out += (text[at:a], new)
            at = b
    out.append(text[at : len(text) if end is None else end])
    return "".join(out)


def value(text: str, m: Member) -> Any:
    """A member's value, for those that a rule compares; one that Python can't hold equals nothing."""
    try:
        return json.loads(m.new if m.new is not None else text[m.at : m.end])
    except (ValueError, RecursionError):
        return object()


class Scanner:
    """Reads texts for one rule."""

    def __init__(self, rule: Rule):
        self.rule = rule
        watched = "|".join(sorted(re.escape(json.dumps(k, ensure_ascii=False)[1:]) for k in rule.keys)) or "(?!)"
        key = f'"(?!{watched}){_PLAIN_STRING[1:]}'

        def runs(scalar: str) -> tuple[re.Pattern, re.Pattern]:
            return re.compile(f"(?:{_WS}{scalar}{_WS},)*+"), re.compile(f"(?:{_WS}{key}{_WS}:{_WS}{scalar}{_WS},)*+")

        self.skip = re.compile(f"(?:{_WS}{_SCALAR}{_WS},)*+"), re.compile(f"(?:{_WS}{_STRING}{_WS}:{_WS}{_SCALAR}{_WS},)*+")
        self.run = runs(f"(?:{_STRING}|{_INTEGER}|{_NAME})" if rule.fractions else _SCALAR)
        self.run_numbers = runs(f"(?:{_STRING}|{_NAME})")

    def edits(self, text: str) -> list[Edit] | None:
        """What the rule makes of a text, unsorted; None for a text that isn't JSON."""
        rule, found = self.rule, []
        frame, i, first = Frame(False, None, None, LOOK), 0, True  # the text is the one element of a list
        while True:
            if frame.up is not None:
                run = (self.skip if frame.mode == SKIP else self.run_numbers if frame.numbers else self.run)[frame.is_object].match(text, i).end()
                if run > i:
                    if frame.mode != SKIP:
                        frame.add(Member(_SPACE.match(text, i).end(), run - 1), False)
                    i, first = run, False
            m = (_MEMBER if frame.is_object else _ELEMENT).match(text, i)
            closing = "}" if frame.is_object else "]"
            if m is not None:
                key = frame.key if not frame.is_object else m[1][1:-1] if "\\" not in m[1] else json.loads(m[1])
                start, i = (m.start(1) if frame.is_object else m.start(2) if m[2] else m.end()), m.end()
                if m[2] is not None:
                    self._scalar(text, frame, Member(start, i, key, m.start(2)))
                elif (c := text[i : i + 1]) in ("{", "["):
                    if not frame.is_object:
                        start = i
                    frame.add(own := Member(start, -1, key, i), True)
                    own.frame = Frame(c == "{", key, frame, SKIP if frame.mode == SKIP else FULL)
                    frame, i, first = own.frame, i + 1, True
                    if frame.mode != SKIP:
                        rule.enter(frame)
                    if c == "[" and (frame.mode == SKIP or frame.mode == FULL and rule.lists_alike) and (opening := _OPENING.match(text, i)):
                        frame.depth += text.count("[", i, opening.end())
                        i = opening.end()
                    continue
                elif frame.is_object or not (first and c == closing and frame.up is not None):
                    return None
                else:
                    m = None
            elif not first:
                return None
            i = _SPACE.match(text, i).end()
            while True:  # a value is over, or an empty frame
                if frame.up is None:
                    return [*found, *rule.leave(text, frame)] if i == len(text) else None
                c = text[i : i + 1]
                if c == "," and m is not None:
                    i, first = i + 1, False
                    break
                if c != closing:
                    return None
                if frame.depth > 1:  # the innermost lists are over, the others go on
                    if frame.mode != SKIP:
                        found += rule.leave(text, frame)
                    frame.members = []
                    i, n = self._closed(text, i, frame.depth - 1)
                    frame.depth, m = frame.depth - n, True
                    i = _SPACE.match(text, i).end()
                    continue
                i += 1
                up, own = frame.up, frame.up.members[-1]
                own.end = i
                if frame.mode != SKIP:
                    found += rule.leave(text, frame)
                if up.mode == SKIP:
                    up.members.pop()
                elif not rule.keeps(frame):
                    own.frame = None
                    if not (up.is_object and own.key in rule.keys):
                        up.members.pop()
                        up.add(own, False)
                frame, closing, m = up, "}" if up.is_object else "]", True
                i = _SPACE.match(text, i).end()

    def _closed(self, text: str, i: int, most: int) -> tuple[int, int]:
        """Where the lists end that close one after another from i on, and how many of them, at most so many."""
        end = _CLOSING.match(text, i).end()
        n = text.count("]", i, end)
        if n <= most:
            return end, n
        if end - i == n:
            return i + most, most
        for _ in range(most):
            i = text.index("]", i) + 1
        return i, most

    def _scalar(self, text: str, frame: Frame, m: Member) -> None:
        if frame.mode == SKIP:
            return
        c = text[m.at]
        number = (c in "-0123456789" and text[m.end - 1] not in "yN") and (frame.numbers or self.rule.fractions and not text[m.at : m.end].lstrip("-").isdigit())
        frame.add(m, number or frame.is_object and m.key in self.rule.keys)


def rewritten(text: str | None, scanner: Scanner) -> tuple[str | None, bool | None]:
    """The text after the rule, and whether anything was edited; nulls for a null or a text that isn't JSON."""
    if text is None or (edits := scanner.edits(text)) is None:
        return None, None
    return (applied(text, edits), True) if edits else (text, False)
