"""Column names."""

from __future__ import annotations

import re

_WORD_START = re.compile(r"([A-Z]+)([A-Z][a-z])")
_CASE_CHANGE = re.compile(r"([a-z0-9])([A-Z])")


def snake_case(name: str) -> str:
    """``EstimatedCompletionDate`` to ``estimated_completion_date``."""
    return _CASE_CHANGE.sub(r"\1_\2", _WORD_START.sub(r"\1_\2", name)).lower()


def labels(names: list[str], snake: bool = False, known: dict[str, str] | None = None) -> dict[str, str]:
    """Column label per name, unique without regard to case.

    A name met before keeps the label it got then (``known``), and no other name ever gets that label. Of new names one already in
    lower case keeps it (the key column ``id`` stays ``id`` beside an ``ID``); others that clash get a number.
    """
    known = known or {}
    taken = {label.lower() for label in known.values()}
    result = {name: known[name] for name in names if name in known}
    for name in sorted((n for n in names if n not in known), key=lambda n: n != n.lower()):
        wanted = snake_case(name) if snake else name
        label, count = wanted, 1
        while label.lower() in taken:
            count += 1
            label = f"{wanted}_{count}"
        taken.add(label.lower())
        result[name] = label
    return {name: result[name] for name in names}
