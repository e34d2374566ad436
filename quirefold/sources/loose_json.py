"""Tolerant JSON: strict parse first, then repair of slips (stray commas, unescaped quotes, raw
control characters). A text that ends before its structure closes is cut off and stays unread."""

from __future__ import annotations

import json
import re

_COMMA = re.compile(r",(\s*[\]}])")
_AFTER = re.compile(r"\s*(?:[\]}:]|,\s*(?:[\"\[{\]}\-0-9tfn])|$)")


def _requote(text: str) -> tuple[str, bool]:
    """Escape quotes that don't end their string and drop stray commas, outside strings only.

    A quote ends its string where a colon, a closing bracket or a comma with a new value follows.
    The second result is false if brackets or a string are still open at the end."""
    out: list[str] = []
    depth, i, n = 0, 0, len(text)
    while i < n:
        c = text[i]
        if c == '"':
            j = i + 1
            start = j
            while True:
                j = text.find('"', j)
                if j < 0:
                    return "", False
                k = j - 1
                while k >= start and text[k] == "\\":
                    k -= 1
                if (j - 1 - k) % 2 == 0:
                    if _AFTER.match(text, j + 1):
                        break
                    out.append(text[i:j] + "\\")
                    i = j
                j += 1
            out.append(text[i : j + 1])
            i = j + 1
            continue
        if c in "[{":
            depth += 1
        elif c in "]}":
            depth -= 1
        elif c == "," and _COMMA.match(text, i):
            i += 1
            continue
        out.append(c)
        i += 1
    return "".join(out), depth == 0


def loads(text: str | None):
    """The value of a JSON text, or None if it is null, blank, cut off or beyond repair."""
    if text is None or not text.strip():
        return None
    try:
        return json.loads(text)
    except ValueError:
        pass
    try:
        fixed, closed = _requote(text)
        return json.loads(fixed, strict=False) if closed else None
    except (ValueError, RecursionError):
        return None
