"""Term expressions: `A + B - C`."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Term:
    word: str
    sign: int = 1


def parse_terms(text: str, compat: bool = False) -> list[Term]:
    """Words and the signs between them.

    ` + ` and ` - ` are operators between words only; elsewhere a sign is part of a word or
    a word of its own. An operator binds to the word after it; compat binds the n-th
    operator to the n-th word after the first, whether or not words stand without one.
    """
    words, signs, pending = [], [], 1
    operators = []
    parts = [p for p in text.split(" ") if p]
    for i, p in enumerate(parts):
        if p in "+-" and 0 < i < len(parts) - 1:
            pending = 1 if p == "+" else -1
            operators.append(pending)
            continue
        words.append(p)
        signs.append(pending)
        pending = 1
    if compat:
        signs = [1, *operators, *[1] * len(words)][: len(words)]
    return [Term(w, s) for w, s in zip(words, signs)]
