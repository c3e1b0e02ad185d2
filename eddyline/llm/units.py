"""Cutting a text into units that byte-level BPE encodes independently of each other.

The pre-tokenizer pattern never lets a match run from a character that is not white space into
white space, and it gives the last blank of a run to the word behind it.  So a text can be cut before
any run of white space that follows other characters, and the tokens of the text are those of its
units, one after another.  Words repeat, so the tokens of a unit are kept and looked up.
"""

from __future__ import annotations

import re

# The characters with the White_Space property.
WHITE_SPACE = "\t-\r \x85\xa0  -     　"

_INSIDE_RUN = re.compile(f"[{WHITE_SPACE}] [{WHITE_SPACE}]")
_RUN_AND_WORD = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")

#: Longer units are encoded each time; keeping them would cost more memory than it saves.
LONGEST_KEPT = 64


def cut(text: str) -> list[str]:
    """Units whose concatenation is ``text``.

    Where no blank has white space on both sides, cutting at every blank is already safe; this is
    the usual case and much the faster one.
    """
    if not text:
        return []
    if _INSIDE_RUN.search(text):
        return _RUN_AND_WORD.findall(text)
    first, *rest = text.split(" ")
    units = [" " + word for word in rest]
    return [first, *units] if first else units


class Kept(dict):
    """Values by unit in bounded memory.

    When ``limit`` units are kept they become the old generation, the one before is forgotten, and
    units that are asked for again move to the new one.  So at most twice the limit is held, and what
    is used often stays.
    """

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def keep(self, unit, value) -> None:
        if len(unit) <= LONGEST_KEPT:
            if len(self) >= self.limit:
                self.old = self.copy()
                self.clear()
            self[unit] = value

    def __missing__(self, unit):
        value = self.old.get(unit)
        if value is None:
            value = self.compute(unit)
        self.keep(unit, value)
        return value
