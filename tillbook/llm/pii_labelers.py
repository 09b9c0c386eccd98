"""Candidate spans of personal data in one text, and what six labelers think of each.

A labeler votes 1 (personal data of this kind), -1 (not) or 0 (no opinion).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from typing import NamedTuple

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "validity", "gazetteer", "context", "shape", "border")

# The base patterns, written so that they need time in proportion to the text.
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Looser ones, whose spans are added if the classifier agrees.
_MORE = {
    "email": (
        re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}+\s?[(\[{]\s?at\s?[)\]}]\s?[A-Za-z0-9-]{1,63}+(?:\s?(?:\.|[(\[{]\s?dot\s?[)\]}])\s?[A-Za-z0-9-]{1,63}+){1,8}+", re.I | re.A),
    ),
    "ip": (re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){7}(?![0-9A-Za-z:])"),),
    "card": (
        re.compile(r"(?<![0-9])[0-9]{13,19}+(?![0-9])"),
        re.compile(r"(?<![0-9])[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"),
        re.compile(r"(?<![0-9])3[47][0-9]{2}([ -])[0-9]{6}\1[0-9]{5}(?![0-9])"),
    ),
    "phone": (
        re.compile(r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"),
        re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    ),
}
_DIGIT = re.compile(r"[0-9]")
#: Part of every looser e-mail address; texts without it are not searched for them.
_AT = re.compile(r"[(\[{]\s?at\s?[)\]}]", re.I | re.A)
_WORDS = re.compile(r"[^\W\d_]+")

# Gazetteers. Fixed values.
_ENDINGS = frozenset("com org net edu gov info biz io co eu de fr es it uk us nl be at ch pt pl se no dk fi ie ca au jp br mx".split())
_COUNTRY_CODES = tuple("1 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 58 60 61 62 63 64 65 66 7 81 82 84 86 90 91 351 352 353 358 420".split())
_ISSUERS = re.compile(r"4[0-9]{12}(?:[0-9]{3}){0,2}$|5[1-5][0-9]{14}$|2[2-7][0-9]{14}$|3[47][0-9]{13}$|3(?:0[0-5]|[68][0-9])[0-9]{11}$|6(?:011|5[0-9]{2})[0-9]{12,15}$|35[0-9]{14}$")
_NEAR = {
    "email": (frozenset("mail email contact write reply kontakt correo courriel".split()), frozenset("version file commit".split())),
    "ip": (frozenset("ip address host server login from adresse servidor".split()), frozenset("version release section chapter build v".split())),
    "card": (frozenset("card credit visa mastercard amex payment karte tarjeta carte".split()), frozenset("isbn order invoice serial id token commit".split())),
    "phone": (frozenset("phone tel call mobile fax cell telefon teléfono téléphone".split()), frozenset("isbn order invoice serial id version".split())),
}
_NEARBY = 40


class Candidate(NamedTuple):
    """A span; ``base`` ones always stay. ``votes`` in the order of ``LABELERS``; ``traits`` are small numbers."""

    kind: int
    start: int
    end: int
    base: bool
    votes: tuple[int, ...]
    traits: tuple[int, int, int]


def luhn(digits: str) -> bool:
    """The check digit of payment cards."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        left = at
        while left > floor and text[left - 1] in _LOCAL:
            left -= 1
        domain = _DOMAIN.match(text, at + 1) if left < at else None
        if domain:
            floor = domain.end()
            out.append((left, floor))
        at = text.find("@", max(at + 1, floor))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all base spans, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def _side(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isdigit() else 2 if c.isalpha() else 3


def _votes(kind: int, text: str, start: int, end: int, base: bool) -> Candidate:
    name, span = KINDS[kind], text[start:end]
    digits = "".join(_DIGIT.findall(span))
    before, after = text[start - 1 : start], text[end : end + 1]
    words = {w.lower() for w in _WORDS.findall(text[max(0, start - _NEARBY) : start] + " " + text[end : end + _NEARBY])}
    good, bad = (len(words & near) for near in _NEAR[name])
    context = (good > bad) - (good < bad)
    validity = gazetteer = shape = 0
    if name == "email":
        host = re.split(r"[.\s()\[\]{}]+", span.lower().rstrip(")]}"))
        gazetteer = 1 if host[-1] in _ENDINGS else -1
        validity = 1 if len(span) <= 254 and ".." not in span else -1
        shape = -1 if host[-1].isdigit() else 1
    elif name == "ip":
        parts = span.split(".") if ":" not in span else span.split(":")
        validity = 1 if ":" in span or all(p == "0" or not p.startswith("0") for p in parts) else -1
        gazetteer = -1 if parts[0] in ("0", "127", "255") else 1
        shape = -1 if all(len(p) == 1 for p in parts) else 1
    elif name == "card":
        validity = 1 if luhn(digits) else -1
        gazetteer = 1 if _ISSUERS.match(digits) else -1
        shape = -1 if len(set(digits)) < 4 else 1
    else:
        validity = 1 if 10 <= len(digits) <= 13 else -1
        if span.startswith("+"):
            gazetteer = 1 if digits.startswith(_COUNTRY_CODES) else -1
        shape = 1 if span.startswith("+") or "(" in span else 0
    border = -1 if before.isalnum() or after.isalnum() or before == "=" else 1
    votes = (int(base), validity, gazetteer, context, shape, border)
    return Candidate(kind, start, end, base, votes, (_side(before), _side(after), min(len(span) // 8, 4)))


def add_apart(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Puts a span among sorted ones that don't overlap, unless it overlaps one of them."""
    at = bisect_left(spans, (start, end))
    if (at and spans[at - 1][1] > start) or (at < len(spans) and spans[at][0] < end):
        return False
    spans.insert(at, (start, end))
    return True


def candidates(text: str | None) -> list[Candidate]:
    """Base spans, and looser ones that overlap none of them, by kind and start."""
    if not text:
        return []
    base = base_spans(text)
    found = list(base)
    taken: list[tuple[int, int]] = []  # base spans joined where they overlap
    for a, b in sorted((a, b) for _, a, b in base):
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
        else:
            taken.append((a, b))
    digits = bool(_DIGIT.search(text))
    for kind, name in enumerate(KINDS):
        if not digits and name != "email":
            continue
        if name == "email" and not _AT.search(text):
            continue
        own: list[tuple[int, int]] = []
        for pattern in _MORE[name]:
            for m in pattern.finditer(text):
                add_apart(own, *m.span())
        i = 0
        for a, b in own:
            while i < len(taken) and taken[i][1] <= a:
                i += 1
            if i == len(taken) or taken[i][0] >= b:
                found.append((kind, a, b))
    known = set(base)
    return [_votes(k, text, a, b, (k, a, b) in known) for k, a, b in sorted(found)]
