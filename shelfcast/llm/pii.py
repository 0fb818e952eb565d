"""Personal data by anchor expansion.

One Aho-Corasick automaton per worker finds anchors: at-signs, plus signs, digits, address schemes
and identifier cues. A parser for the anchor's kind reads on from there, or back for the local part
of an email, and validates the boundary; no pattern is searched for over the text.

Base kinds (email, ip, card, phone) come out exactly as leftmost non-overlapping matches of their
patterns. The method adds, from schemes and cues:

* ``login``: an address whose scheme is followed by ``user@host`` or ``user:password@host``;
* ``account``: the identifier after a cue such as ``iban`` (check digits must hold), ``ssn`` (valid
  areas only) or ``account number`` (8 to 17 digits);
* ``secret``: the value of 8 characters or more after ``password`` and the like with ``=`` or ``:``,
  and access key ids after ``AKIA``.

Schemes and cues count in any case. A null or empty text has no spans. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import ship_code

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("login", "account", "secret")
KIND_ORDER = {k: i for i, k in enumerate(BASE_KINDS + ADDED_KINDS)}

LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
USERINFO = re.compile(r"[^\s/@:?#]+(?::[^\s/@?#]*)?@[A-Za-z0-9.-]*[A-Za-z0-9](?::[0-9]+)?")
GAP = re.compile(r"[ \t]*(?:(?:number|no\.?|nr\.?|#)[ \t]*)?[:=#]?[ \t]*", re.ASCII | re.IGNORECASE)
SECRET_GAP = re.compile(r"[\"']?[ \t]*[:=][ \t]*[\"']?")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"([0-9]{3})[- ]([0-9]{2})[- ]([0-9]{4})(?![0-9])")
ACCOUNT = re.compile(r"[0-9](?:[ -]?[0-9]){7,16}(?![0-9])")
SECRET = re.compile(r"[^\s\"',;]{8,}")
KEY_ID = re.compile(r"AKIA[A-Z0-9]{16}(?![A-Za-z0-9])")

SCHEMES = ("http://", "https://", "ftp://", "ssh://")
CUES = {
    "iban": ("iban",),
    "ssn": ("ssn", "social security"),
    "number": ("account", "acct", "routing", "passport"),
    "secret": ("password", "passwd", "secret", "token", "api_key", "api-key", "api key", "apikey"),
}

Span = tuple[int, int, str]


@functools.cache
def anchors() -> ahocorasick.Automaton:
    """Of anchors in lower case."""
    automaton = ahocorasick.Automaton()
    for digit in "0123456789":
        automaton.add_word(digit, ("digit", 1))
    automaton.add_word("@", ("at", 1))
    automaton.add_word("+", ("plus", 1))
    automaton.add_word("akia", ("key", 4))
    for scheme in SCHEMES:
        automaton.add_word(scheme, ("scheme", len(scheme)))
    for kind, cues in CUES.items():
        for cue in cues:
            automaton.add_word(cue, (kind, len(cue)))
    automaton.make_automaton()
    return automaton


ASCII_LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def folded(text: str) -> str:
    """The text in lower case with every character in its place."""
    lower = text.lower()
    return lower if len(lower) == len(text) else text.translate(ASCII_LOWER)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban_holds(text: str) -> bool:
    compact = text.replace(" ", "")
    moved = compact[4:] + compact[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def ssn_holds(m: re.Match) -> bool:
    area, group, serial = m.groups()
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def spans_of(text: str | None) -> list[Span]:
    """All spans (start, end, kind) of a text, by start, then kind."""
    if not text:
        return []
    found: list[Span] = []
    end = dict.fromkeys(KIND_ORDER, 0)
    tried = 0  # digits before it can start no further ip: their run was tried

    def keep(kind: str, start: int, stop: int) -> None:
        end[kind] = stop
        found.append((start, stop, kind))

    for last, (kind, size) in anchors().iter(folded(text)):
        at = last - size + 1
        if kind == "digit":
            if at >= end["ip"] and at >= tried:
                if m := IP.match(text, at):
                    end["ip"] = m.end()
                    parts = [p.lstrip("0") for p in m[0].split(".")]
                    if all(len(p) < 4 and int(p or "0") <= 255 for p in parts):
                        keep("ip", at, m.end())
                tried = DIGITS.match(text, at).end()
            if at >= end["card"] and (m := CARD.match(text, at)):
                end["card"] = m.end()
                digits = only_digits(m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    keep("card", at, m.end())
        elif kind == "at":
            start, floor = at, end["email"]
            while start > floor and text[start - 1] in LOCAL_CHARS:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                keep("email", start, m.end())
        elif kind == "plus":
            if at >= end["phone"] and (m := PHONE.match(text, at)):
                end["phone"] = m.end()
                if 10 <= len(only_digits(m[0])) <= 15:
                    keep("phone", at, m.end())
        elif kind == "scheme":
            if at >= end["login"] and (m := USERINFO.match(text, last + 1)):
                keep("login", at, m.end())
        elif kind == "key":
            if (at == 0 or not text[at - 1].isalnum()) and (m := KEY_ID.match(text, at)):
                if at >= end["secret"]:
                    keep("secret", at, m.end())
        elif at == 0 or not text[at - 1].isalnum():
            if kind == "secret":
                gap = SECRET_GAP.match(text, last + 1)
                if gap and gap.end() >= end["secret"] and (m := SECRET.match(text, gap.end())):
                    keep("secret", m.start(), m.end())
                continue
            start = GAP.match(text, last + 1).end()
            pattern = {"iban": IBAN, "ssn": SSN, "number": ACCOUNT}[kind]
            if start > last + 1 and start >= end["account"] and (m := pattern.match(text, start)):
                if kind == "number" or (iban_holds(m[0]) if kind == "iban" else ssn_holds(m)):
                    keep("account", m.start(), m.end())
    return sorted(found, key=lambda s: (s[0], KIND_ORDER[s[2]], s[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{stop}" for start, stop, kind in spans)


FOUND = (
    "n_email long, n_ip long, n_card long, n_phone long, n_added long, base_sha256 string, spans string"
)


def _found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        rows = []
        for text in texts:
            spans = spans_of(text)
            base = [s for s in spans if s[2] in BASE_KINDS]
            counts = [sum(s[2] == k for s in base) for k in BASE_KINDS]
            digest = hashlib.sha256(joined(base).encode()).hexdigest()
            rows.append((*counts, len(spans) - len(base), digest, joined(spans)))
        yield pd.DataFrame(
            rows,
            columns=["n_email", "n_ip", "n_card", "n_phone", "n_added", "base_sha256", "spans"],
        )


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text): counts per base kind, digest and list of the spans.

    Repeated rows stay repeated, other columns are ignored, an empty table gives no rows.
    """
    ship_code(docs.sparkSession)
    found = F.pandas_udf(_found, FOUND)
    return docs.select("doc_id", found(F.col("text")).alias("found")).select("doc_id", "found.*")
