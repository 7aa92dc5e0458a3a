"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text (at-signs,
plus signs, digits, URL schemes, identifier cues). Small deterministic parsers
expand each anchor to its span and validate it. The base kinds equal their
patterns matched leftmost and without overlap inside a kind; matches that fail
validation are dropped without a retry:

* email  ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ip     four digit runs joined by single dots, each at most 255
* card   digits with at most one space or hyphen between, 13 to 19, Luhn
* phone  ``\\+[0-9][\\x20().0-9-]+[0-9]`` of 9 to 15 digits

The method's own kinds: url (from its scheme), iban (after a cue, remainder
97), ssn (after a cue). Offsets are code points, ends exclusive.

Edge cases: null text counts as empty (no spans; the digest of the empty
string). Repeated rows and rows without id are scanned each for itself. An
empty table gives an empty result. Extra columns are ignored. Work is linear in the text.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "ssn")
Span = tuple[int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"[^\s<>\"'`|\\^{}]+")
# a cue, then at most three words, before an account number's country and check digits
_IBAN = re.compile(r"[\s:#.]{0,4}(?:[A-Za-z]{1,12}[\s:#.]{1,4}){0,3}?([A-Z]{2})[0-9]{2}")
# The length of an international account number by its country.
IBAN_LENGTHS = dict(
    AD=24, AE=23, AL=28, AT=20, AZ=28, BA=20, BE=16, BG=22, BH=22, BR=29, BY=28, CH=21, CR=22, CY=28, CZ=24, DE=22, DK=18, DO=28,
    EE=20, EG=29, ES=24, FI=18, FO=18, FR=27, GB=22, GE=22, GI=23, GL=18, GR=27, GT=28, HR=21, HU=28, IE=22, IL=23, IQ=23, IS=26,
    IT=27, JO=30, KW=30, KZ=20, LB=28, LC=32, LI=21, LT=20, LU=20, LV=21, MC=27, MD=24, ME=22, MK=19, MR=27, MT=31, MU=30, NL=18,
    NO=15, PK=24, PL=28, PS=29, PT=25, QA=29, RO=24, RS=22, SA=24, SC=31, SE=24, SI=19, SK=24, SM=27, ST=25, SV=28, TL=23, TN=24,
    TR=26, UA=29, VA=22, VG=24, XK=20,
)
_UPPER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_SSN = re.compile(r"[\s:#.]{0,4}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
_CUES = {"iban": ("IBAN", "iban", "Iban", "account", "Account"), "ssn": ("SSN", "ssn", "social security number", "Social Security Number")}
_SCHEMES = ("http://", "https://", "ftp://")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for sign in "@+0123456789":
        found.add_word(sign, sign if sign in "@+" else "digit")
    for scheme in _SCHEMES:
        found.add_word(scheme, f"url{len(scheme)}")
    for kind, cues in _CUES.items():
        for cue in cues:
            found.add_word(cue, kind)
    found.make_automaton()
    return found


_ANCHORS = _automaton()


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _email(text: str, at: int, after: int) -> Span | None:
    domain = _DOMAIN.match(text, at + 1)
    if not domain:
        return None
    start = at
    while start > after and text[start - 1] in _LOCAL:
        start -= 1
    return (start, domain.end()) if start < at else None


def _runs(digits: list[int]) -> list[Span]:
    runs: list[list[int]] = []
    for p in digits:
        if runs and runs[-1][1] == p:
            runs[-1][1] = p + 1
        else:
            runs.append([p, p + 1])
    return [(a, b) for a, b in runs]


def _chains(text: str, runs: list[Span], joints: str):
    """Digit runs joined by single characters of ``joints``."""
    chain: list[Span] = []
    for run in runs:
        if chain and run[0] == chain[-1][1] + 1 and text[chain[-1][1]] in joints:
            chain.append(run)
        else:
            if chain:
                yield chain
            chain = [run]
    if chain:
        yield chain


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def _iban(text: str, at: int) -> Span | None:
    """The account number after a cue that ends before ``at``: as many characters as its
    country fixes, single spaces between them, with the right remainder."""
    m = _IBAN.match(text, at)
    left = m and IBAN_LENGTHS.get(m.group(1))
    if not left:
        return None
    start = end = m.start(1)
    plain = ""
    while left and end < len(text):
        if text[end] in _UPPER:
            plain, left = plain + text[end], left - 1
        elif text[end] != " " or text[end - 1] == " ":
            return None
        end += 1
    if left or (end < len(text) and text[end].isalnum()):
        return None
    return (start, end) if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1 else None


def find(text: str) -> dict[str, list[Span]]:
    """The spans of each kind, in order."""
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    digits: list[int] = []
    mail_end = phone_end = url_end = 0
    for at, anchor in _ANCHORS.iter(text):
        if anchor == "digit":
            digits.append(at)
        elif anchor == "@":
            if span := _email(text, at, mail_end):
                out["email"].append(span)
                mail_end = span[1]
        elif anchor == "+":
            if at >= phone_end and (m := _PHONE.match(text, at)):
                phone_end = m.end()
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out["phone"].append(m.span())
        elif anchor.startswith("url"):
            start = at + 1 - int(anchor[3:])
            if start >= url_end and (m := _URL.match(text, at + 1)):
                url_end = at + 1 + len(m.group().rstrip(".,;:!?)]"))
                if url_end > at + 1:
                    out["url"].append((start, url_end))
        elif span := _iban(text, at + 1) if anchor == "iban" else (m := _SSN.match(text, at + 1)) and m.span(1):
            if not out[anchor] or out[anchor][-1][1] <= span[0]:
                out[anchor].append(span)
    if digits:
        runs = _runs(digits)
        for chain in _chains(text, runs, "."):
            for k in range(0, len(chain) - 3, 4):
                if all(_octet(text[a:b]) for a, b in chain[k : k + 4]):
                    out["ip"].append((chain[k][0], chain[k + 3][1]))
        for chain in _chains(text, runs, " -"):
            if 13 <= sum(b - a for a, b in chain) <= 19 and _luhn("".join(text[a:b] for a, b in chain)):
                out["card"].append((chain[0][0], chain[-1][1]))
    return out


def _written(found: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans) for every row; base
    and spans as ``kind:start:end`` joined by commas, by kind, then start."""

    def scan(batches):
        for batch in batches:
            found = [find(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([len(f[k]) for f in found], pa.int64()) for k in BASE), pa.array([_written(f, BASE) for f in found], pa.string()), pa.array([_written(f, KINDS) for f in found], pa.string())],
                ["doc_id", *(f"n_{k}" for k in BASE), "base", "spans"],
            )

    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(scan, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")


def pii_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    spans = pii_spans(docs, id_col, text_col)
    return spans.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with every span replaced by its kind in brackets; where
    spans overlap the earlier (then the longer) one counts."""

    def scan(batches):
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                parts, done = [], 0
                if text is not None:
                    for a, b, kind in sorted(((a, -b, k) for k, s in find(text).items() for a, b in s)):
                        if a >= done:
                            parts += [text[done:a], f"[{kind}]"]
                            done = -b
                    out.append("".join(parts) + text[done:])
                else:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(scan, docs.schema)


__all__ = ["find", "pii_spans", "pii_digests", "redact"]
