"""Duration strings such as ``28d`` as whole seconds."""

from __future__ import annotations

import re

# The accepted units and their length in seconds.
UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}

_DURATION = re.compile(r"(\d+)([a-z])")


def parse_duration(text: str) -> int:
    """``"5d"`` -> 432000. Anything but a positive whole number and one known unit is refused."""
    match = _DURATION.fullmatch(text)
    if match is None or match.group(2) not in UNIT_SECONDS:
        raise ValueError(f"not a duration: {text!r} (expected <int><unit>, unit one of {', '.join(UNIT_SECONDS)})")
    seconds = int(match.group(1)) * UNIT_SECONDS[match.group(2)]
    if seconds < 1:
        raise ValueError(f"a look-back must last at least one second: {text!r}")
    return seconds
