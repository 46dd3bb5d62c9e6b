"""Personal data by anchor expansion.

One Aho-Corasick pass over the whole text finds anchors: at-signs, digits, dots and plus signs before a
digit, schemes and identifier cues. Each anchor is expanded by a small deterministic parser that fixes
the boundaries and validates what it found. Per kind, matches are leftmost and do not overlap.

Null and empty texts have no spans; their digest is that of the empty string. Repeated rows get equal
results, other columns pass through. Parsers only look at the run of characters around their anchor, so
very long texts cost time in proportion to their length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in the order that breaks ties between spans with one start. The first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "url", "secret", "account")
BASE = 4
# Fixed values.
SCHEMES = ("http", "https", "ftp", "ftps", "ssh")
SECRET_CUES = ("token", "password", "passwd", "secret", "api_key", "apikey")
ACCOUNT_CUES = ("iban", "account", "acct")

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DIGITS = "0123456789"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL_REST = re.compile(r"[^\s\"'<>]+")
_SECRET_VALUE = re.compile(r"[\x20\t]{0,4}[=:][\x20\t]{0,4}[\"']?([A-Za-z0-9_+/=.-]{8,})")
_ACCOUNT_VALUE = re.compile(r"(?:[\x20\t]?(?:number|no\.?|nr\.?|#))?[\x20\t]{0,4}[=:]?[\x20\t]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}|[0-9]{8,17})")

Span = tuple[int, int, int]


def run_start(text: str, end: int, low: int, allowed: str) -> int:
    """Where the run of allowed characters that ends before `end` begins, not before `low`."""
    while end > low:
        piece = text[max(low, end - 64) : end]
        rest = piece.rstrip(allowed)
        end -= len(piece) - len(rest)
        if rest:
            break
    return end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def iban(value: str) -> bool:
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _email(text: str, at: int, low: int) -> tuple[int, int, bool] | None:
    start = run_start(text, at, low, _LOCAL)
    domain = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end(), True) if domain else None


def _ip(text: str, at: int, low: int) -> tuple[int, int, bool] | None:
    start = run_start(text, at, low, _DIGITS)
    found = _IP.match(text, start) if start < at else None
    if not found:
        return None
    parts = [p.lstrip("0") for p in found.group().split(".")]
    return start, found.end(), all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _card(text: str, at: int, low: int) -> tuple[int, int, bool] | None:
    found = _CARD.match(text, at)
    if not found:
        return None
    digits = found.group().replace(" ", "").replace("-", "")
    return at, found.end(), 14 <= len(digits) <= 19 and luhn(digits)


def _phone(text: str, at: int, low: int) -> tuple[int, int, bool] | None:
    found = _PHONE.match(text, at)
    if not found:
        return None
    return at, found.end(), 10 <= sum(c in _DIGITS for c in found.group()) <= 15


def _url(text: str, at: int, low: int) -> tuple[int, int, bool] | None:
    start = run_start(text, at, max(low, at - 8), _LOCAL)
    rest = _URL_REST.match(text, at + 3)
    if not rest or text[start:at].lower() not in SCHEMES:
        return None
    address = rest.group().rstrip(".,;:!?)]}")
    return start, at + 3 + len(address), "." in address.split("/")[0]


def _secret(text: str, at: int, low: int) -> tuple[int, int, bool] | None:
    found = _SECRET_VALUE.match(text, at)
    return (found.start(1), found.end(1), True) if found else None


def _account(text: str, at: int, low: int) -> tuple[int, int, bool] | None:
    found = _ACCOUNT_VALUE.match(text, at)
    if not found:
        return None
    value = found.group(1).replace(" ", "")
    return found.start(1), found.end(1), value.isdigit() or (15 <= len(value) <= 34 and iban(value))


_PARSERS: tuple[Callable[[str, int, int], tuple[int, int, bool] | None], ...] = (
    _email, _ip, _card, _phone, _url, _secret, _account,
)


def anchors() -> ahocorasick.Automaton:
    """Each pattern with its kind and the offset from its last character to where its parser begins."""
    found: dict[str, tuple[int, int]] = {"@": (0, 0), "://": (4, -2)}
    for d in _DIGITS:
        found |= {d: (2, 0), f".{d}": (1, -1), f"+{d}": (3, -1)}
    for kind, cues in ((5, SECRET_CUES), (6, ACCOUNT_CUES)):
        found |= {form: (kind, 1) for cue in cues for form in (cue, cue.upper(), cue.capitalize())}
    automaton = ahocorasick.Automaton()
    for pattern, value in found.items():
        automaton.add_word(pattern, value)
    automaton.make_automaton()
    return automaton


def find_spans(text: str, automaton: ahocorasick.Automaton) -> list[Span]:
    """`(start, kind, end)` of every valid span, by start and kind, in code points."""
    low = [0] * len(KINDS)
    spans: list[Span] = []
    for last, (kind, offset) in automaton.iter(text):
        at = last + offset
        if at < low[kind]:
            continue
        found = _PARSERS[kind](text, at, low[kind])
        if found:
            start, end, valid = found
            low[kind] = max(end, low[kind])
            if valid:
                spans.append((start, kind, end))
    return sorted(set(spans))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans: list[Span]) -> str:
    """Spans replaced by their kind in brackets; of overlapping ones the whole stretch by the first's kind."""
    out, done = [], 0
    i = 0
    while i < len(spans):
        start, kind, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = end
    return "".join(out) + text[done:]


_REPORT = ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"


def _report(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    automaton = anchors()
    names = [f"n_{k}" for k in KINDS] + ["base_sha256", "spans"]
    for texts in batches:
        rows = []
        for text in texts:
            spans = find_spans(text, automaton)
            base = joined([s for s in spans if s[1] < BASE])
            counts = [sum(s[1] == k for s in spans) for k in range(len(KINDS))]
            rows.append((*counts, hashlib.sha256(base.encode()).hexdigest(), joined(spans)))
        yield pd.DataFrame(rows, columns=names)


def _redacted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    automaton = anchors()
    for texts in batches:
        yield pd.Series([redact(t, find_spans(t, automaton)) for t in texts], dtype=object)


def find(text: Column) -> Column:
    """A struct of the counts by kind, the digest of the base spans, and all spans."""
    return F.pandas_udf(_report, _REPORT)(F.coalesce(text, F.lit("")))


def personal_data(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", find(F.col("text")).alias("found")).select("doc_id", "found.*")


def redact_documents(documents: DataFrame) -> DataFrame:
    """The documents with every span replaced; null texts stay null and `n_chars`, if there, is renewed."""
    redacted = F.pandas_udf(_redacted, "string")
    text = F.when(F.col("text").isNotNull(), redacted(F.coalesce("text", F.lit(""))))
    done = documents.withColumn("text", text)
    if "n_chars" in documents.columns:
        done = done.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return done
