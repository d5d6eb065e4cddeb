"""What a Python worker remembers of the texts it has split and encoded, within a bound."""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Hashable
from typing import Any

import regex

# The characters that the split pattern's \s stands for (Unicode White_Space), fixed values.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
class Kept:
    """What a Python worker keeps between its tasks, for one kind of work at a time: Spark gives a worker tasks of
    every step, and the memories of all of them would add up."""

    def __init__(self) -> None:
        self.kind: str | None = None
        self.made: dict[str, tuple[Hashable, Any]] = {}
        self.asked = False

    def get(self, kind: str, name: str, given: Hashable, make: Callable[[], Any]) -> Any:
        """What ``make`` made last time under the name, if it was of what is ``given`` now."""
        self.asked = True
        if kind != self.kind:
            self.forget()
            self.kind = kind
        if name not in self.made or self.made[name][0] != given:
            self.made.pop(name, None)
            self.made[name] = given, make()
        return self.made[name][1]

    def begin(self, make: Callable[[], Callable]) -> Callable:
        """What a task works with; one that asks for nothing kept needs no memory of other work."""
        self.asked = False
        work = make()
        if not self.asked:
            self.forget()
        return work

    def forget(self) -> None:
        self.kind = None
        if self.made:
            self.made.clear()
            gc.collect()  # memories that refer to themselves


KEPT = Kept()

# The alternative of a split pattern that takes words.
WORDS = r" ?\p{L}+"
# The longest string that is remembered.
LONGEST_REMEMBERED = 64


def one_match(pattern: str) -> Callable[[str], Any]:
    """Tells of a plain word, after a blank or not, that it is one match of the pattern. It is where the pattern's alternatives
    take such words whole, and those before begin with an apostrophe."""
    alternatives = pattern.split("|")
    if WORDS in alternatives and all(a.startswith("'") for a in alternatives[: alternatives.index(WORDS)]):
        return re.compile(" ?[A-Za-z]+").fullmatch
    return lambda stretch: None


class Joined(dict):
    """The packed ids of stretches of several matches; the others are ``worked_out``."""

    def __init__(self, worked_out: Callable[[str], bytes]) -> None:
        super().__init__()
        self.worked_out = worked_out

    def __missing__(self, stretch: str) -> bytes:
        return self.worked_out(stretch)


class Stretches(dict):
    """Maps a stretch of text (white space, then other characters) to its packed ids; stretches
    never share a match of the split pattern. Kept here are those that are one match, so that a
    match is kept once, whether it is a stretch of its own or not; ``joined`` has the others."""

    # Matches of the pattern, and stretches of text with several of them, that a Python worker
    # remembers, some 160 to 190 bytes each, as measured.
    REMEMBERED, REMEMBERED_JOINED = 450_000, 150_000

    # A stretch that is missing here is looked up in ``joined``; by a slot, no Python runs for that.
    __slots__ = ("__missing__", "__dict__")

    def __init__(self, pattern: str | None) -> None:
        super().__init__()
        self.joined = Joined(self.stretch)
        self.__missing__ = self.joined.__getitem__
        self.split = regex.compile(pattern).findall if pattern else None
        self.one_match = one_match(pattern or "")
        self.stretches = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+").findall

    def work_out(self, piece: str) -> bytes:
        """The packed ids of one match."""
        raise NotImplementedError

    def split_up(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.stretches(text)))

    def stretch(self, stretch: str) -> bytes:
        """The packed ids of a stretch that is not remembered."""
        pieces = None if self.one_match(stretch) else self.split(stretch)
        if not pieces or len(pieces) == 1 and pieces[0] == stretch:
            value = self.work_out(stretch)
            if len(self) < self.REMEMBERED and len(stretch) <= LONGEST_REMEMBERED:
                self[stretch] = value
            return value
        value = b"".join(map(self.piece, pieces))
        if len(self.joined) < self.REMEMBERED_JOINED and len(stretch) <= LONGEST_REMEMBERED:
            self.joined[stretch] = value
        return value

    def piece(self, piece: str) -> bytes:
        value = self.get(piece)
        if value is None:
            value = self.work_out(piece)
            # By itself a match may be several, such as one that is cut short by what follows it.
            if len(self) < self.REMEMBERED and len(piece) <= LONGEST_REMEMBERED and self.split(piece) == [piece]:
                self[piece] = value
        return value
