"""Texts as chunks between blanks, so that work on a repeated chunk is done once per worker.

The pre-tokenizing pattern lets a piece begin with one blank and never go on past the next
one, except in a run of white space, which is one piece. So a text whose blanks have no white
space beside them falls apart at its blanks into chunks that can be split on their own:
``a`` + `` b`` + `` c``. A text with such a run is split as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: A blank beside white space of any kind (all that patterns know as such, and some more).
_RUN = re.compile(r" (?:(?<=\s )|(?=\s))")

#: Chunks a worker remembers before it starts anew; some 200 bytes each.
REMEMBERED = 400_000


class Remembered(dict):
    """Results by chunk, computed when missing; emptied when full, so memory is bounded."""

    def __init__(self, make: Callable, most: int = REMEMBERED):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


def chunks(text: str) -> tuple[str, list[str]]:
    """The head of a text, and its further chunks without their leading blank."""
    if "  " in text or (not text.isprintable() and _RUN.search(text)):
        return text, []
    head, *rest = text.split(" ")
    return head, rest
