"""Members of a listing one after the other, without a tree of the whole: only the text and one member are held.

A reader gives the members of a text as an iterator. It settles that the whole text is good before it gives the first
one: ``ValueError`` means malformed, ``KeyError`` a missing key.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

from sheaf.functions.json import canonical, storable

Reader = Callable[[str], Iterator[str]]

#: Characters of XML that are handed over at a time.
FEED = 1 << 16

_BLANKS = re.compile(r"[ \t\n\r]*")
_decode_at = json.JSONDecoder().raw_decode


def _next(text: str, at: int) -> int:
    return _BLANKS.match(text, at).end()


def _value(text: str, at: int) -> tuple[object, int]:
    try:
        return _decode_at(text, at)
    except RecursionError as error:
        raise ValueError("nested too deeply") from error


def _expect(text: str, sign: str, at: int) -> int:
    if not text.startswith(sign, at):
        raise ValueError(f"no {sign} at {at}")
    return _next(text, at + 1)


def _separated(text: str, at: int, closing: str) -> int | None:
    """Where the next member starts, or None where ``closing`` stands."""
    if text.startswith(closing, at):
        return None
    return _expect(text, ",", at)


def list_members(text: str, at: int, closed: list[int]) -> Iterator[tuple[object, str]]:
    """Value and text of each member of the list that starts at ``at``; puts the end of the list into ``closed``."""
    end = _expect(text, "[", at)
    start = None if text.startswith("]", end) else end
    while start is not None:
        value, stop = _value(text, start)
        yield value, text[start:stop]
        end = _next(text, stop)
        start = _separated(text, end, "]")
    closed.append(end + 1)


def locate(text: str, at: int, keys: tuple[str, ...]) -> tuple[int | None, int]:
    """Where the value under ``keys`` starts, None if it is missing, and where the value at ``at`` ends.

    Reads that value to its end. Of equal keys the last counts.
    """
    if text.startswith("[", at):
        closed: list[int] = []
        deque(list_members(text, at, closed), maxlen=0)
        return (None if keys else at), closed[0]
    if not keys or not text.startswith("{", at):
        return (None if keys else at), _value(text, at)[1]
    found = None
    end = _expect(text, "{", at)
    start = None if text.startswith("}", end) else end
    while start is not None:
        if not text.startswith('"', start):
            raise ValueError(f"no key at {start}")
        key, stop = _value(text, start)
        here = _expect(text, ":", _next(text, stop))
        mine = key == keys[0]
        inner, stop = locate(text, here, keys[1:] if mine else ())
        found = inner if mine else found
        end = _next(text, stop)
        start = _separated(text, end, "}")
    return found, end + 1


def _start_of(text: str, keys: tuple[str, ...]) -> int:
    start, end = locate(text, _next(text, 0), keys)
    if _next(text, end) != len(text):
        raise ValueError("text behind the value")
    if start is None:
        raise KeyError(keys)
    return start


def json_records(*keys: str) -> Reader:
    """Texts of the records under ``keys``; a value that isn't a list is the only record."""

    def read(text: str) -> Iterator[str]:
        start = _start_of(text, keys)
        if text.startswith("[", start):
            for _, member in list_members(text, start, []):
                yield member
        else:
            yield text[start : _value(text, start)[1]]

    return read


def json_ids(base_url: str, *keys: str) -> Reader:
    """Ids of the records under ``keys``, each behind ``base_url``; a record without id spoils the listing.

    An empty object or text in place of the list lists nothing.
    """

    def read(text: str) -> Iterator[str]:
        try:
            start = _start_of(text, keys)
        except KeyError as error:
            raise ValueError("no list of records") from error
        if not text.startswith("[", start):
            if _value(text, start)[0] not in ({}, ""):
                raise ValueError("not a list of records")
            return
        if not all(isinstance(doc, dict) and "id" in doc for doc, _ in list_members(text, start, [])):
            raise ValueError("a record without id")
        for doc, _ in list_members(text, start, []):
            name = doc["id"]
            yield storable(base_url + (canonical(name) if isinstance(name, dict | list) else str(name)))

    return read


class _Unheard:
    """Target of a parser that only checks the text."""

    def close(self) -> None:
        return None


def _pieces(text: str) -> Iterator[str]:
    return (text[i : i + FEED] for i in range(0, len(text), FEED))


def _check_xml(text: str) -> None:
    parser = ElementTree.XMLParser(target=_Unheard())
    for piece in _pieces(text):
        parser.feed(piece)
    parser.close()


def xml_texts(tag: str) -> Reader:
    """Text of each element ``tag`` below the root, verbatim and in document order; empty elements have none."""

    def read(text: str) -> Iterator[str]:
        try:
            _check_xml(text)
        except ElementTree.ParseError as error:
            raise ValueError(str(error)) from error
        parser = ElementTree.XMLPullParser(("start", "end"))
        path: list[ElementTree.Element] = []
        # Elements in document order; an outer one is whole only after those inside it.
        waiting: deque[ElementTree.Element] = deque()
        whole: set[int] = set()
        for piece in _pieces(text):
            parser.feed(piece)
            for event, element in parser.read_events():
                if event == "start":
                    if path and element.tag == tag:
                        waiting.append(element)
                    path.append(element)
                    continue
                path.pop()
                if path:
                    path[-1].remove(element)
                if path and element.tag == tag:
                    whole.add(id(element))
                    while waiting and id(waiting[0]) in whole:
                        ready = waiting.popleft()
                        whole.discard(id(ready))
                        if ready.text is not None:
                            yield ready.text

    return read
