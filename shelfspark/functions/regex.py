"""RE2 patterns in Java's dialect, so that one pattern text means the same on both sides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

import re

#: ASCII \\b, as RE2 has it.
EDGE = r"(?:(?<=[0-9A-Za-z_])(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])(?=[0-9A-Za-z_]))"
_REFUSED = re.compile(r"\\[CGKXRQZ]|\(\?[=!<](?!P)|\(\?>|\*\+|\+\+|\?\+")


def re2_to_java(pattern: str) -> str:
    """Translate an RE2 pattern: ASCII ``\\b``, Unicode case folding, ``$`` at the very end, ``.`` that stops at \\n only.

    Raises ValueError for constructs that RE2 itself doesn't have.
    """
    if _REFUSED.search(pattern):
        raise ValueError(f"not an RE2 pattern: {pattern}")
    flags = re.match(r"\(\?([imsU]+)\)", pattern)
    body = pattern[flags.end() :] if flags else pattern
    on = set(flags.group(1)) if flags else set()
    if "U" in on:
        raise ValueError("ungreedy patterns are not translated")
    out, k, in_class = [], 0, False
    while k < len(body):
        two = body[k : k + 2]
        if two[:1] == "\\" and len(two) == 2:
            named = {"\\b": EDGE, "\\z": "\\z"}.get(two) if not in_class else None
            out.append(named or two)
            k += 2
            continue
        ch = body[k]
        if ch == "[" and not in_class:
            in_class = True
        elif ch == "]" and in_class:
            in_class = False
        out.append("\\z" if ch == "$" and not in_class and "m" not in on else ch)
        k += 1
    java = "d" + "".join(sorted(on)) + ("u" if "i" in on else "")
    return f"(?{java})" + "".join(out)


def quote(text: str) -> str:
    """``text`` as a Java pattern that matches just it."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def literal(x: Column) -> Column:
    """The text of a column as a Java pattern that matches just it."""
    return F.concat(F.lit("\\Q"), F.replace(x, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
