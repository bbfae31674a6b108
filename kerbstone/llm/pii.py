"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds what personal data must contain: an
at-sign, a scheme, a plus before a digit, digits beside digits or points, how
keys and account numbers begin, and words that announce an account or a secret. From an anchor a small parser
walks to the left and to the right as far as the entity reaches, and checks it.
Text without an anchor costs no more than the pass.
"""

from __future__ import annotations

import functools
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kerbstone.llm.batches import with_text_columns

#: The kinds in their order; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = KINDS[:4]

DIGITS = "0123456789"
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS_RIGHT = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD_RIGHT = re.compile(r"(?:[\x20-]?[0-9])*")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CREDENTIALS = re.compile(r"[^\s/?#@\"'<>]+@[^\s/?#@\"'<>]+")
VALUE = re.compile(r"[\x20\t]{0,4}(?:[=:]|=>)?[\x20\t]{0,4}[\"']?([A-Za-z0-9][A-Za-z0-9_./+=-]{7,}[A-Za-z0-9=])")
IBAN = re.compile(r"[\x20:#-]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")

# Words that announce a secret or an account number.
CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "api key", "access_key", "private_key")
IBAN_CUES = ("iban",)
# How keys begin, and all that a whole one is.
KEYS = {
    "AKIA": r"AKIA[0-9A-Z]{16}", "ASIA": r"ASIA[0-9A-Z]{16}", "AIza": r"AIza[0-9A-Za-z_-]{35}",
    "ghp_": r"ghp_[0-9A-Za-z]{36,}", "gho_": r"gho_[0-9A-Za-z]{36,}", "ghs_": r"ghs_[0-9A-Za-z]{36,}",
    "github_pat_": r"github_pat_[0-9A-Za-z_]{22,}", "glpat-": r"glpat-[0-9A-Za-z_-]{20,}",
    "xoxb-": r"xoxb-[0-9A-Za-z-]{20,}", "xoxp-": r"xoxp-[0-9A-Za-z-]{20,}", "sk_live_": r"sk_live_[0-9A-Za-z]{16,}",
    "sk-": r"sk-[0-9A-Za-z_-]{20,}", "eyJ": r"eyJ[0-9A-Za-z_-]{8,}\.eyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]+",
}
KEY_RIGHT = {k: re.compile(p + r"(?![0-9A-Za-z])") for k, p in KEYS.items()}
PEM, PEM_HEAD = "-----BEGIN ", re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?)-----")
# The countries whose account numbers begin with two letters and a check.
COUNTRIES = (
    "AD AE AL AT AZ BA BE BG BH BR BY CH CR CY CZ DE DK DO EE EG ES FI FO FR GB GE GI GL GR GT HR HU IE IL IQ IS IT "
    "JO KW KZ LB LC LI LT LU LV MC MD ME MK MR MT MU NL NO PK PL PS PT QA RO RS SA SC SE SI SK SM ST SV TL TN TR UA VA VG XK"
).split()


@functools.cache
def automaton():
    """The anchors, each with the kind it announces and how far it reaches left of its end."""
    import ahocorasick

    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    found.add_word("://", ("url", 3))
    for a in DIGITS:
        found.add_word(f"+{a}", ("phone", 2))
        for b in DIGITS:
            found.add_word(f"{a}.{b}", ("ip", 3))
            for gap in ("", " ", "-"):
                found.add_word(f"{a}{gap}{b}", ("card", len(gap) + 2))
    for kind, words in (("account", CUES), ("iban", IBAN_CUES)):
        for word in words:
            for shown in {word, word.upper(), word.title(), word.capitalize()}:
                found.add_word(shown, (kind, len(shown)))
    for word in KEYS:
        found.add_word(word, ("key", len(word)))
    found.add_word(PEM, ("pem", len(PEM)))
    for code in COUNTRIES:
        for digit in DIGITS:
            found.add_word(f"{code}{digit}", ("bare", 3))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def iban_holds(number: str) -> bool:
    """ISO 13616's check: 97 leaves a remainder of one."""
    moved = number[4:] + number[:4]
    return len(number) >= 15 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def email_at(text: str, at: int, least: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at``, not reaching left of ``least``."""
    start = at
    while start > least and text[start - 1] in LOCAL:
        start -= 1
    right = DOMAIN.match(text, at + 1) if start < at else None
    return (start, right.end()) if right else None


def addresses(text: str, start: int, end: int):
    """IP addresses of a chain of numbers joined by points: four at a time from its left."""
    at = start
    numbers = []
    for part in text[start:end].split("."):
        numbers.append((at, at + len(part), part))
        at += len(part) + 1
    for i in range(0, len(numbers) - 3, 4):
        four = numbers[i:i + 4]
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for _, _, part in four):
            yield four[0][0], four[3][1]


def chain_start(text: str, at: int, joints: str, least: int) -> int:
    """Where the chain of digits with single ``joints`` between them, seen from ``at``, begins."""
    while at > least:
        if text[at - 1] in DIGITS:
            at -= 1
        elif at - 1 > least and text[at - 1] in joints and text[at - 2] in DIGITS:
            at -= 2
        else:
            break
    return at


def varied(value: str) -> bool:
    """Whether a key's characters are as mixed as drawn ones: two bits each, digits and letters among them."""
    n = len(value)
    bits = -sum(c / n * math.log2(c / n) for c in map(value.count, set(value)))
    return bits >= 2 and any(c in DIGITS for c in value) and any(c.isalpha() for c in value)


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text as ``kind, start, end``, by start and then kind."""
    spans = []
    done = dict.fromkeys(("email", "ip", "card", "phone", "url", "account", "iban"), 0)
    for last, (kind, length) in automaton().iter(text):
        at = last - length + 1
        if kind in ("key", "pem", "bare"):
            of = "iban" if kind == "bare" else "account"
            if at < done[of] or (at > 0 and (text[at - 1].isalnum() or text[at - 1] == "_")):
                continue
            if kind == "key":
                prefix = text[at:last + 1]
                got = KEY_RIGHT[prefix].match(text, at)
                end = got.end() if got and varied(text[last + 1:got.end()]) else 0
            elif kind == "pem":
                got = PEM_HEAD.match(text, at)
                tail = f"-----END {got[1]}-----" if got else ""
                # without its end, the line that begins it
                to = text.find(tail, got.end()) if got else -1
                end = to + len(tail) if to >= 0 else got.end() if got else 0
            else:
                got = IBAN.match(text, at)
                end = got.end(1) if got and iban_holds(got[1].replace(" ", "")) else 0
            if end:
                spans.append(("account", at, end))
                done[of] = end
            continue
        if at < done[kind]:
            continue
        if kind == "email":
            got = email_at(text, at, done[kind])
            if got:
                spans.append((kind, *got))
                done[kind] = got[1]
        elif kind == "ip":
            start = chain_start(text, at, ".", done[kind])
            end = ADDRESS_RIGHT.match(text, start).end()
            spans += [(kind, *got) for got in addresses(text, start, end)]
            done[kind] = end
        elif kind == "card":
            start = chain_start(text, at, " -", done[kind])
            end = CARD_RIGHT.match(text, start).end()
            digits = text[start:end].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((kind, start, end))
            done[kind] = end
        elif kind == "phone":
            got = PHONE.match(text, at)
            if got:
                if 9 <= sum(c in DIGITS for c in got[0]) <= 15:
                    spans.append((kind, at, got.end()))
                done[kind] = got.end()
        elif kind == "url":
            start = at
            while start > done[kind] and text[start - 1].isascii() and text[start - 1].isalpha():
                start -= 1
            got = CREDENTIALS.match(text, last + 1) if start < at else None
            if got:
                spans.append((kind, start, got.end()))
                done[kind] = got.end()
        elif kind == "iban":
            got = IBAN.match(text, last + 1)
            if got and iban_holds(got[1].replace(" ", "")):
                spans.append(("account", got.start(1), got.end(1)))
                done[kind] = got.end()
        else:
            got = VALUE.match(text, last + 1)
            value = got[1] if got else ""
            if any(c in DIGITS for c in value) and any(c.isalpha() for c in value):
                spans.append((kind, got.start(1), got.end(1)))
                done[kind] = got.end()
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return spans


def find_personal_data(
    docs: DataFrame, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Every row of ``docs``: ``keep, pii``, the spans as ``kind, start, end`` in order.

    Places count code points, the end is exclusive. Kinds are ``email``,
    ``ip``, ``card`` and ``phone`` as their patterns say, leftmost and without
    overlap inside a kind; ``url`` is the part of an address up to its host when
    it carries credentials, ``account`` an account number that passes its check,
    a key that begins as keys of some services do and is mixed enough, a signed
    token, a private key from its first to its last line, or the value after a
    word such as *password*. Spans of different kinds may overlap; of equal
    starts the earlier kind comes first. A null or empty text has none; a very
    long text is read whole; repeated rows are read each; an empty table gives
    no rows. ``keep`` are the columns passed on
    (all by default, but for one named ``pii``).
    """

    def run(texts: list[str]) -> dict[str, list]:
        return {
            "pii": [
                [{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t)] if t else []
                for t in texts
            ]
        }

    span = T.StructType([
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ])
    return with_text_columns(docs, text_col, run, {"pii": T.ArrayType(span)}, keep)
