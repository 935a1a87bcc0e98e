"""Base patterns of personal data: email, ip, card, phone.

Each finder returns what a regular expression finds leftmost and non-overlapping, in time linear in the text: no expression
is started inside a run it has already failed on. All classes are ASCII; places are code points, end exclusive.
"""

from __future__ import annotations

import re

#: Kinds in the order they are listed and sorted by.
KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: A local part read backwards from its at sign.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A run of digits fails or matches as a whole, so the search begins at its first digit.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int, str]


def emails(text: str) -> list[Span]:
    """``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``: each at sign with the characters before it."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            end = found.end()
            out.append((begin, end, "email"))
        # Characters before a failed at sign cannot belong to the next one.
        at = text.find("@", max(end, at + 1))
    return out


def ips(text: str) -> list[Span]:
    """``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)`` with parts of at most 255."""
    return [(m.start(), m.end(), "ip") for m in _IP.finditer(text)
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split("."))]


def luhn(digits: str) -> bool:
    """Every second digit from the right doubled, nine taken off above nine, sum divisible by ten."""
    odd = sum(int(d) for d in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def cards(text: str) -> list[Span]:
    """``[0-9]([\\x20-]?[0-9])+`` with 14 to 19 digits that pass Luhn."""
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
    return out


def phones(text: str) -> list[Span]:
    """``\\+[0-9][\\x20().0-9-]+[0-9]`` with 10 to 15 digits."""
    return [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= sum(map(str.isdigit, m[0])) <= 15]


def base_spans(text: str) -> list[Span]:
    """All base spans by start, then kind as listed."""
    found = emails(text) if "@" in text else []
    found += ips(text)
    found += cards(text)
    found += phones(text) if "+" in text else []
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    """By start, then kind as listed."""
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for begin, end, kind in spans)
