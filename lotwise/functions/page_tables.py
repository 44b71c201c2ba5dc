"""Decoding of a page's reference table: plain Python, for one page at a time.

A table is a list in which whole numbers inside objects and lists are positions of entries. A number that
points at an entry stands for that entry, decoded in turn; if the entry is a number itself, it
is the value. Numbers out of range are values. A list that starts with a text is a tag and its content.
An entry is decoded once, where a depth-first walk meets it first; a reference to an entry that is
still being decoded gives ``<cycle>``, and beyond ``MOST_DEPTH`` levels there is null. Which occurrence is
the first one decides what cycles look like, and that order is sequential within a page.
"""

from __future__ import annotations

import json
from typing import Any

# The mark of a cycle, the deepest level, and the members that identify the listing.
CYCLE = "<cycle>"
MOST_DEPTH = 60
LISTING_MEMBERS = ("specs", "title", "price")
MOST_NODES = 1_000_000


def _is_number(value: Any) -> bool:
    return isinstance(value, int) and not isinstance(value, bool)


class PageTable:
    """A parsed table; shared entries are one object wherever they occur."""

    def __init__(self, entries: list[Any]):
        self.entries = entries
        self._known: dict[int, Any] = {}
        self.positions: dict[int, int] = {}  # id of a decoded object -> its position

    def decode(self) -> Any:
        return self._value(self.entries, 0, own=True)

    def _value(self, value: Any, depth: int, own: bool = False) -> Any:
        if depth > MOST_DEPTH:
            return None
        if _is_number(value) and 0 <= value < len(self.entries):
            entry = self.entries[value]
            if _is_number(entry):
                return entry
            if value not in self._known:
                self._known[value] = CYCLE
                self._known[value] = self._value(entry, depth + 1)
                if isinstance(self._known[value], dict):
                    self.positions[id(self._known[value])] = value
            return self._known[value]
        if isinstance(value, list):
            tagged = bool(value) and isinstance(value[0], str)
            out = [value[0]] if tagged else []
            for place, inner in enumerate(value[1:] if tagged else value):
                out.append(self._value(inner, depth + 1))
                if own and isinstance(out[-1], dict):
                    # an entry met directly is decoded for itself, at its own position
                    self.positions.setdefault(id(out[-1]), place + tagged)
            return out
        if isinstance(value, dict):
            return {name: self._value(inner, depth + 1) for name, inner in value.items()}
        return value


def first_listing(decoded: Any) -> dict[str, Any] | None:
    """The object with all listing members that a depth-first walk meets first; shared objects are walked once."""
    waiting, seen = [decoded], set()
    while waiting:
        value = waiting.pop()
        if not isinstance(value, (dict, list)) or id(value) in seen:
            continue
        seen.add(id(value))
        if isinstance(value, dict) and all(name in value for name in LISTING_MEMBERS):
            return value
        waiting.extend(reversed(value.values() if isinstance(value, dict) else value))
    return None


def nodes(value: Any, known: dict[int, int] | None = None) -> int:
    """Number of values that ``value`` has when shared objects are written out each time."""
    known = {} if known is None else known
    if not isinstance(value, (dict, list)):
        return 1
    if id(value) not in known:
        known[id(value)] = 1 + sum(nodes(inner, known) for inner in (value.values() if isinstance(value, dict) else value))
    return known[id(value)]


def _no_constant(name: str) -> Any:
    raise ValueError(f"{name} is no JSON")


def decode_text(text: str | None, whole: bool) -> tuple[str | None, str | None, int | None]:
    """(decoded table, listing, position of the listing's entry) of a table given as JSON text.

    Nulls where the text is no JSON list, where there is no listing, and, for the written-out values, beyond
    ``MOST_NODES`` values. The table itself is only written out if ``whole``.
    """
    try:
        entries = json.loads(text, parse_constant=_no_constant) if text else None
    except (ValueError, RecursionError):
        return None, None, None
    if not isinstance(entries, list):
        return None, None, None
    table = PageTable(entries)
    decoded = table.decode()
    listing = first_listing(decoded)

    def written(value: Any) -> str | None:
        return None if value is None or nodes(value) > MOST_NODES else json.dumps(value, ensure_ascii=False)

    position = None if listing is None else table.positions.get(id(listing))
    return written(decoded) if whole else None, written(listing), position
