"""The projection mini-language of the corpus builder: `name/_@$*n[label]`, comma-separated."""

from __future__ import annotations

import re
from dataclasses import dataclass

_SPEC = re.compile(r"(?P<name>[^,\[\]*]*?)(?P<segment>/)?(?P<phrase>_)?(?P<letters>@)?(?P<symbols>\$)?(?:\*(?P<repeat>[2-9]))?(?:\[(?P<label>.+)\])?\Z", re.S)


@dataclass(frozen=True)
class ColumnSpec:
    """One column of a projection list and what is done to its elements."""

    name: str
    segment: bool = False
    phrase: bool = False
    strip_letters: bool = False
    strip_symbols: bool = False
    repeat: int = 1
    label: str = ""


def parse_column(text: str) -> ColumnSpec:
    """A column with its suffixes, in the canonical order."""
    m = _SPEC.match(text.strip())
    if not m or not m["name"]:
        raise ValueError(f"not a column: {text!r}")
    return ColumnSpec(m["name"], bool(m["segment"]), bool(m["phrase"]), bool(m["letters"]), bool(m["symbols"]), int(m["repeat"] or 1), m["label"] or "")


def parse_columns(text: str) -> list[ColumnSpec]:
    """A comma-separated list; commas inside brackets belong to labels."""
    found, depth, at = [], 0, 0
    for i, c in enumerate(text + ","):
        depth += (c == "[") - (c == "]")
        if c == "," and depth <= 0:
            if text[at:i].strip():
                found.append(parse_column(text[at:i]))
            at = i + 1
    if not found:
        raise ValueError("no columns")
    return found
