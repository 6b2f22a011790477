"""Operator 7, personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, schemes, identifier cues and pairs of
digits as they stand in addresses, cards and phone numbers. A local parser expands each anchor
to the span around it and validates that. No pattern is ever run over a whole text.

Base kinds are email, ip, card and phone, leftmost and not overlapping within a kind. The method
adds ``iban`` (account numbers that pass the mod-97 test) and ``login`` (addresses of any scheme
that carry a user part).
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame

from tallyline.llm.common import per_slice, sha256, texts

KINDS = ("email", "ip", "card", "phone")
ADDED = ("iban", "login")

# Fixed patterns of the contract, applied to expanded spans only.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]){11,30}")
_LOGIN = re.compile(r"://[^\s/@<>\"']+@[^\s<>\"']+")

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DIGITS = "0123456789"
_IP_RUN, _CARD_RUN = frozenset(_DIGITS + "."), frozenset(_DIGITS + " -")
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
CUES = ("IBAN", "iban", "Iban")
#: Characters after a cue in which its number must begin.
CUE_REACH = 16

Span = tuple[str, int, int]


@cache
def _anchors():
    import ahocorasick

    made = ahocorasick.Automaton()
    made.add_word("@", "email")
    made.add_word("://", "login")
    for cue in CUES:
        made.add_word(cue, "iban")
    for a in _DIGITS:
        made.add_word(f"+{a}", "phone")
        for b in _DIGITS:
            made.add_word(f"{a}.{b}", "ip")
            for gap in ("", " ", "-"):
                made.add_word(f"{a}{gap}{b}", "card")
    made.make_automaton()
    return made


def luhn(digits: str) -> bool:
    double = "0246813579"
    return sum(int(c) if k % 2 == 0 else int(double[int(c)]) for k, c in enumerate(reversed(digits))) % 10 == 0


def mod97(number: str) -> bool:
    compact = number.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def _run(text: str, at: int, allowed: frozenset, low: int) -> tuple[int, int]:
    """The longest stretch of allowed characters around ``at``, not before ``low``."""
    start, end, n = at, at, len(text)
    while start > low and text[start - 1] in allowed:
        start -= 1
    while end < n and text[end] in allowed:
        end += 1
    return start, end


def find(text: str) -> list[Span]:
    """(kind, start, end) of every span, in code points, by start and then kind."""
    found: list[Span] = []
    done = dict.fromkeys((*KINDS, *ADDED), 0)
    for last, kind in _anchors().iter(text):
        if kind == "email":
            start, _ = _run(text, last, _LOCAL, done[kind])
            if start < last and (m := _DOMAIN.match(text, last)):
                found.append((kind, start, m.end()))
                done[kind] = m.end()
        elif kind == "phone":
            if m := _PHONE.match(text, last - 1):
                if 10 <= sum(c in _DIGITS for c in m[0]) <= 15:
                    found.append((kind, m.start(), m.end()))
        elif kind == "ip" and last >= done[kind]:
            start, done[kind] = _run(text, last, _IP_RUN, 0)
            for m in _IP.finditer(text, start, done[kind]):
                if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split(".")):
                    found.append((kind, m.start(), m.end()))
        elif kind == "card" and last >= done[kind]:
            start, done[kind] = _run(text, last, _CARD_RUN, 0)
            for m in _CARD.finditer(text, start, done[kind]):
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((kind, m.start(), m.end()))
        elif kind == "iban" and last >= done[kind]:
            if (m := _IBAN.search(text, last + 1, last + 1 + CUE_REACH + 42)) and m.start() <= last + CUE_REACH:
                # The longest end that validates: a number may be followed by other capitals.
                ends = [e for e in range(m.end(), m.start() + 14, -1) if text[e - 1] != " "]
                if end := next((e for e in ends if mod97(text[m.start():e])), 0):
                    found.append((kind, m.start(), end))
                    done[kind] = end
        elif kind == "login" and last >= done[kind]:
            start, _ = _run(text, last - 2, _SCHEME, done[kind])
            if start < last - 2 and (m := _LOGIN.match(text, last - 2)):
                found.append((kind, start, m.end()))
                done[kind] = m.end()
    order = {k: n for n, k in enumerate((*KINDS, *ADDED))}
    return sorted(found, key=lambda s: (s[1], order[s[0]]))


def redacted(text: str) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    out, end, opened = [], 0, 0
    for kind, a, b in find(text):
        if a >= opened:
            out += [text[end:a], f"[{kind}]"]
        end = opened = max(opened, b)
    return "".join(out) + text[end:]


def find_spans(docs: DataFrame) -> DataFrame:
    """Personal data of every whole text; one row a row, repeated rows included.

    Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of kind:start:end of the base
    kinds, comma-joined), spans (all kinds, joined likewise). Null and empty texts have no spans.
    """
    def run(rows: dict) -> dict:
        out: dict[str, list] = {"doc_id": rows["doc_id"], **{f"n_{k}": [] for k in KINDS}, "base_sha256": [], "spans": []}
        for text in rows["text"]:
            spans = find(text)
            kinds = [k for k, _, _ in spans]
            for k in KINDS:
                out[f"n_{k}"].append(kinds.count(k))
            out["base_sha256"].append(sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans if k in KINDS).encode()))
            out["spans"].append(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
        return out

    key = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return per_slice(texts(docs), f"doc_id {key}, {counts}, base_sha256 string, spans string", run)


def redact(docs: DataFrame) -> DataFrame:
    """The columns of documents with personal data replaced in ``text`` and ``n_chars`` measured anew.

    A null text stays null. Columns keep their order and types.
    """
    def run(rows: dict) -> dict:
        new = [t if t is None else redacted(t) for t in rows["text"]]
        return {**rows, "text": new} | ({"n_chars": [n if t is None else len(t) for n, t in zip(rows["n_chars"], new, strict=True)]}
                                        if "n_chars" in rows else {})

    return per_slice(docs, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), run)
