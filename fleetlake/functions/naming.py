"""Column naming rule, applied to schema metadata on the driver."""

from __future__ import annotations

import re
from collections.abc import Iterable

# A word: capitals first, then lower-case letters and digits. A capital after a
# lower-case letter or digit starts the next word; anything else separates words.
_WORDS = re.compile(r"[A-Z]+[a-z0-9]*|[a-z0-9]+")


def snake_case(name: str) -> str:
    """``VendorID`` -> ``vendor_id``; ``PULocationID`` -> ``pulocation_id``."""
    return "_".join(_WORDS.findall(name)).lower()


def snake_names(names: Iterable[str]) -> list[str]:
    """Normalise every name, refusing two that become the same.

    Without the check the frame would carry two columns of one name and fail
    much later, far from the cause.
    """
    sources: dict[str, list[str]] = {}
    for name in names:
        sources.setdefault(snake_case(name), []).append(name)
    collisions = {new: old for new, old in sources.items() if len(old) > 1}
    if collisions:
        raise ValueError(f"column names collide after normalisation: {collisions}")
    return list(sources)
