"""Personal data by anchors.

An Aho-Corasick automaton finds what every kind of personal data must hold: an
at-sign, a scheme, a plus sign, a digit or a cue such as ``iban``. From there a
small parser without search walks to both ends of the address or number and tests
it. Parsers go on behind what they have read, so a text is read once.

Kinds ``email``, ``ip``, ``card`` and ``phone`` are exactly the leftmost
non-overlapping matches of their base patterns. The method adds ``login`` (user and
password in a URL), ``iban`` (two letters and two check digits, tested modulo 97 at
the length of the country, else at every end of a group, the longest first) and ``ssn``
(three groups of digits). Both stand behind a cue in any case, with at most a few short
words between.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame

from tablestream.llm.common import annotate, only

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "iban", "ssn")

DIGITS = frozenset("0123456789")
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
LABEL = LETTERS | DIGITS | {"-"}
LOCAL = LABEL | frozenset("._%+")
CALL = DIGITS | frozenset(" ().-")
GAP = frozenset(" -")
#: User information of a URL.
USER = LETTERS | DIGITS | frozenset("-._~!$&'()*+,;=%")
#: In any case: they are looked for in the text in lower case.
CUES = ("iban", "ssn", "social security")

Span = tuple[str, int, int]


@lru_cache(maxsize=1)
def anchors():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for anchor in ("@", "://", "+", *sorted(DIGITS), *CUES):
        kind = "digit" if anchor in DIGITS else anchor
        automaton.add_word(anchor, (kind, len(anchor)))
    automaton.make_automaton()
    return automaton


def run(text: str, at: int, chars: frozenset[str]) -> int:
    """The first place from ``at`` on whose character is not in ``chars``."""
    end = len(text)
    while at < end and text[at] in chars:
        at += 1
    return at


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign; ``floor`` is where the last one ended."""
    a = at
    while a > floor and text[a - 1] in LOCAL:
        a -= 1
    b = run(text, at + 1, LABEL)
    if a == at or b == at + 1:
        return None
    dots = 0
    while b < len(text) and text[b] == ".":
        end = run(text, b + 1, LABEL)
        if end == b + 1:
            break
        b, dots = end, dots + 1
    return (a, b) if dots else None


def ip_at(text: str, a: int) -> tuple[int, bool]:
    """Where reading four dotted numbers from ``a`` ends, and whether it is an address.

    Without four numbers the base pattern has no match here; it goes on behind the
    first number, in which no match can start and reach further.
    """
    first = b = run(text, a, DIGITS)
    for _ in range(3):
        if b >= len(text) or text[b] != ".":
            return first, False
        end = run(text, b + 1, DIGITS)
        if end == b + 1:
            return first, False
        b = end
    return b, all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in text[a:b].split("."))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def card_at(text: str, a: int) -> tuple[int, bool]:
    """The end of digits with single blanks or hyphens between, and whether a card."""
    b = run(text, a, DIGITS)
    while b + 1 < len(text) and text[b] in GAP and text[b + 1] in DIGITS:
        b = run(text, b + 1, DIGITS)
    digits = text[a:b].replace(" ", "").replace("-", "")
    return b, 14 <= len(digits) <= 19 and luhn(digits)


def phone_at(text: str, a: int) -> tuple[int, bool]:
    if a + 1 >= len(text) or text[a + 1] not in DIGITS:
        return a + 1, False
    b = run(text, a + 2, CALL)
    while b > a + 2 and text[b - 1] not in DIGITS:
        b -= 1
    # Between the first digit and the last one there is at least one character.
    if b < a + 4:
        return a + 1, False
    return b, 10 <= sum(c in DIGITS for c in text[a:b]) <= 15


def login_at(text: str, a: int) -> tuple[int, int] | None:
    """``user:password`` behind a scheme and before an at-sign."""
    colon = run(text, a, USER)
    if colon == a or text[colon : colon + 1] != ":":
        return None
    end = run(text, colon + 1, USER)
    return (a, end) if end > colon + 1 and text[end : end + 1] == "@" else None


#: Characters of an account number, by country.
LENGTHS = {
    country: int(n)
    for n, countries in (
        part.split(":")
        for part in (
            "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV "
            "22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL "
            "24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM "
            "28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC "
            "32:LC 33:RU"
        ).split()
    )
    for country in countries.split(",")
}
#: Between a cue and its number.
NEAR = 24
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(rf"[^0-9\n]{{0,{NEAR}}}([0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}})(?![0-9-])")


def iban_end(text: str, a: int, b: int) -> int | None:
    """Where the account number that begins at ``a`` ends, at ``b`` at the latest."""
    ends, size = {}, 0
    for at in range(a, b):
        if text[at] == " ":
            continue
        size += 1
        after = text[at + 1 : at + 2]
        if size >= 15 and not (after in LETTERS or after in DIGITS):
            ends[size] = at + 1
    own = LENGTHS.get(text[a : a + 2])
    for n in sorted(ends, key=lambda n: (n != own, -n)):
        code = text[a : ends[n]].replace(" ", "")
        if int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
            return ends[n]
    return None


def cued(text: str, cue: str, end: int) -> Span | None:
    if cue != "iban":
        m = _SSN.match(text, end)
        return ("ssn", m.start(1), m.end(1)) if m else None
    at = end
    while (m := _IBAN.search(text, at, end + NEAR + 64)) and m.start() <= end + NEAR:
        if b := iban_end(text, *m.span()):
            return "iban", m.start(), b
        at = m.start() + 1
    return None


def lowered(text: str) -> str:
    """In lower case, every character at its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower()[:1] for c in text)


def personal(text: str) -> list[Span]:
    """All spans as (kind, start, end), by start and then kind as listed."""
    out: list[Span] = []
    email_end = ip_end = card_end = phone_end = 0
    # Two cues may stand before one number.
    cued_spans: set[Span] = set()
    for last, (kind, size) in anchors().iter(lowered(text)):
        a = last + 1 - size
        if kind == "digit":
            if a >= ip_end:
                ip_end, good = ip_at(text, a)
                if good:
                    out.append(("ip", a, ip_end))
            if a >= card_end:
                card_end, good = card_at(text, a)
                if good:
                    out.append(("card", a, card_end))
        elif kind == "@":
            if a >= email_end and (found := email_at(text, a, email_end)):
                email_end = found[1]
                out.append(("email", *found))
        elif kind == "+":
            if a >= phone_end:
                phone_end, good = phone_at(text, a)
                if good:
                    out.append(("phone", a, phone_end))
        elif kind == "://":
            if found := login_at(text, last + 1):
                out.append(("login", *found))
        elif (found := cued(text, kind, last + 1)) and found not in cued_spans:
            cued_spans.add(found)
            out.append(found)
    order = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(out, key=lambda s: (s[1], order[s[0]], s[2]))


def redacted(text: str, spans: list[Span]) -> str:
    """Each stretch of overlapping spans replaced by the kind of its first span."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), ``spans``, ``clean`` (the text without them).

    A null text has no spans and stays null; repeated rows are scanned each.
    """

    def found(texts: list[str | None]) -> list[list]:
        only()
        spans = [personal(t or "") for t in texts]
        clean = [t and redacted(t, s) for t, s in zip(texts, spans, strict=True)]
        rows = [[dict(zip(("kind", "start", "end"), x, strict=True)) for x in s] for s in spans]
        return [rows, clean]

    return annotate(
        docs,
        text_col,
        found,
        "spans array<struct<kind: string, start: bigint, end: bigint>>, clean string",
    )
