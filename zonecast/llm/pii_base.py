"""The base patterns for personal data, with linear-time scans over whole texts.

Every scan gives the leftmost non-overlapping matches of its pattern, as the plain
expression would, but starts only where a match can: at an at-sign, a plus or the
head of a run of digits.
"""

from __future__ import annotations

import re

# The kinds in their listed order and what their patterns are made of.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "A-Za-z0-9._%+-"

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    """Whether the digits' check sum (every second one from the right doubled) ends in 0."""
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_SET:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
            at = text.find("@", free)
        else:
            free = at + 1  # nothing before a failed at-sign can reach over it
            at = text.find("@", at + 1)
    return out


def _part(digits: str) -> int:
    significant = digits.lstrip("0")
    return int(significant or "0") if len(significant) <= 3 else 1000


def ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _IP.finditer(text) if all(_part(p) <= 255 for p in m[0].split("."))]


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 40:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15] if "+" in text else []


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by start and then kind as listed."""
    found = []
    for order, (kind, scan) in enumerate(zip(KINDS, (emails, ips, cards, phones))):
        found += [(a, order, kind, z) for a, z in scan(text)]
    return [(kind, a, z) for a, _, kind, z in sorted(found)]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{z}" for kind, a, z in spans)
