"""Operator 11: personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors of a text in one pass: at-signs
(also written ``(at)``), schemes, plus signs before a digit, digits and the
cue words of accounts. Every anchor is expanded by a deterministic local
parser, to the left over the characters that its kind allows and to the right
by one anchored match without backtracking, and what it finds is validated
(parts of an address, Luhn, modulo 97, digit counts). A parser never reads
the same stretch twice, so the work is linear in the text.

Base kinds, leftmost and without overlap per kind, equal to a scan with the
patterns of ``BASE``: email, ip, card, phone. A match that fails its check is
dropped and not tried again in another way. The method adds, after them:

- ``masked_email``: an email whose at-sign is written ``(at)``, ``[at]``;
- ``url``: an address with a scheme that carries credentials or leads to a
  numeric host (other addresses are not personal), and ``mailto:``/``tel:``;
- ``iban``: two capitals, two check digits and the account, modulo 97 = 1;
- ``account``: an identifier of at least 5 digits after a cue word (account,
  konto, compte, cuenta, passport, ssn, ...), and a card number that stands
  among other digit groups: whole groups, 13 to 19 digits, Luhn.

Positions are code points, ends exclusive.

Cases: null and empty texts have no spans; very long texts are read whole, in
memory of a few bytes per character; ids may be null or repeated, each row
gets its own result; extra columns are ignored; an empty table gives an empty
result. Lone anchors, unfinished matches and digits of other scripts are no
spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the base kinds; [\x20-] is a blank or a hyphen.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ADDED = ("masked_email", "url", "iban", "account")
KINDS = (*BASE, *ADDED)

CUES = ("account", "acct", "konto", "kontonummer", "compte", "cuenta", "passport", "passeport", "pasaporte",
        "reisepass", "ssn", "social security")
MASKS = ("(at)", "[at]", "{at}")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
# right-hand sides, possessive: what one part takes, the next never gets back
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
MASKED = re.compile(r"\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[{]dot[)\]}]\x20?)[A-Za-z0-9-]++)++")
QUAD = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
DIGITS = re.compile(r"[0-9]++")
CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])*+")
PHONE = re.compile(BASE["phone"])
REST = re.compile(r"[^\s<>\"'`{}|\\^]++")
AUTHORITY = re.compile(r"[^\s<>\"'`{}|\\^/?#]++")  # ends before the next address begins
TARGET = re.compile(r"[^\s<>\"'`{}|\\^:]++")
HOST = re.compile(r"(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|\[[0-9A-Fa-f:.]+\])(?![A-Za-z0-9.-])")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])")
AFTER_CUE = re.compile(r"(?:\x20?(?:no|nr|num|number|id|nummer)\b)?[\x20.:#=]{0,4}"
                       r"([A-Z]{0,3}[0-9](?:[\x20-]?[0-9]){4,33}+)(?![A-Za-z0-9])", re.ASCII)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def is_card(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and luhn(digits)


def is_ip(text: str) -> bool:
    # at most 255 whatever the zeros before it; a longer number is no part
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in text.split("."))


def is_phone(text: str) -> bool:
    return 9 <= sum("0" <= c <= "9" for c in text) <= 15


def is_iban(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def automaton():
    """Anchor -> parser name; built once per task."""
    import ahocorasick

    auto = ahocorasick.Automaton()
    for c in "0123456789":
        auto.add_word(c, ("digit", 1))
        auto.add_word("+" + c, ("phone", 2))
    auto.add_word("@", ("email", 1))
    for word, name in (*((m, "masked") for m in MASKS), ("://", "url"), ("mailto:", "scheme"), ("tel:", "scheme"),
                       *((c, "cue") for c in CUES)):
        for form in {word, word.upper(), word.capitalize(), word.title()}:
            auto.add_word(form, (name, len(form)))
    auto.make_automaton()
    return auto


def _left(text: str, at: int, low: int, allowed: frozenset) -> int:
    while at > low and text[at - 1] in allowed:
        at -= 1
    return at


def _grouped_cards(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Runs of whole digit groups of a chain that are card numbers, leftmost and
    longest first."""
    groups = [m.span() for m in DIGITS.finditer(text, start, end)]
    k = 0
    while k < len(groups):
        size, best, j = 0, None, k
        while j < len(groups) and size <= 19:
            size += groups[j][1] - groups[j][0]
            if 13 <= size <= 19 and luhn("".join(text[a:b] for a, b in groups[k:j + 1])):
                best = j
            j += 1
        if best is not None:
            yield groups[k][0], groups[best][1]
            k = best
        k += 1


def _url(text: str, start: int, after: int) -> int | None:
    """End of the address whose scheme ends before ``after``; None if it is
    not personal."""
    m = AUTHORITY.match(text, after)
    if not m:
        return None
    user, _, host = m.group().rstrip(".,;:!?)*").rpartition("@")
    if not (user and host) and not HOST.match(host):
        return None
    return after + len(REST.match(text, after).group().rstrip(".,;:!?)*"))


def find_spans(text: str, auto) -> list[Span]:
    """(kind, start, end) of every span, ordered by kind as listed, then start."""
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    done = dict.fromkeys((*KINDS, "chain", "quad"), 0)  # where each parser goes on

    def add(kind: str, start: int, end: int) -> None:
        out[kind].append((kind, start, end))
        done[kind] = end

    for last, (name, size) in auto.iter(text):
        at = last + 1 - size
        if name == "digit":
            if at >= done["quad"]:
                m = QUAD.match(text, at)
                done["quad"] = m.end() if m else DIGITS.match(text, at).end()
                if m and is_ip(m.group()):
                    add("ip", at, m.end())
            if at >= done["chain"]:
                end = done["chain"] = CHAIN.match(text, at).end()
                if end - at >= 13:
                    digits = text[at:end].replace(" ", "").replace("-", "")
                    if is_card(digits):
                        add("card", at, end)
                    elif len(digits) < end - at:
                        out["account"] += [("account", a, b) for a, b in _grouped_cards(text, at, end)]
            head = at - 2
            if head >= done["iban"] and text[head:at].isascii() and text[head:at].isalpha() and \
                    text[head:at].isupper() and not (head and text[head - 1].isalnum()):
                m = IBAN.match(text, head)
                if m and is_iban(m.group()):
                    add("iban", head, m.end())
        elif name == "phone":
            m = PHONE.match(text, at)
            if m and is_phone(m.group()):
                add("phone", at, m.end())
        elif name == "email":
            start = _left(text, at, done["email"], LOCAL)
            m = DOMAIN.match(text, at + 1) if start < at else None
            if m:
                add("email", start, m.end())
        elif name == "masked":
            gap = at - 1 if at and text[at - 1] == " " else at
            start = _left(text, gap, done["masked_email"], LOCAL)
            m = MASKED.match(text, last + 1) if start < gap else None
            if m:
                add("masked_email", start, m.end())
        elif name == "url" and at >= done["url"]:
            start = _left(text, at, done["url"], SCHEME)
            end = _url(text, start, last + 1) if start < at and text[start].isalpha() else None
            if end is not None:
                add("url", start, end)
        elif name == "scheme":
            m = TARGET.match(text, last + 1)
            if m and at >= done["url"] and not (at and text[at - 1].isalnum()):
                rest = m.group().rstrip(".,;!?)]*")
                if ("@" in rest) if text[at] in "mM" else sum("0" <= c <= "9" for c in rest) >= 5:
                    add("url", at, last + 1 + len(rest))
        elif name == "cue" and not (at and text[at - 1].isalnum()):
            m = AFTER_CUE.match(text, last + 1)
            if m:
                out["account"].append(("account", *m.span(1)))
    # a card after a cue is found twice; the one that begins first stays
    accounts: list[Span] = []
    for s in sorted(set(out["account"]), key=lambda s: (s[1], -s[2])):
        if not accounts or s[1] >= accounts[-1][2]:
            accounts.append(s)
    out["account"] = accounts
    return [s for kind in KINDS for s in out[kind]]


SPANS = "array<struct<kind:string,start:int,end:int>>"


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) per row; ``spans`` lists kind, start and end."""
    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton()
        for b in batches:
            found = []
            for t in b.column("text"):
                text = t.as_py()
                found.append([dict(zip(("kind", "start", "end"), s)) for s in find_spans(text, auto)] if text else [])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(found, pa.list_(kind))], ["id", "spans"])

    return source.mapInArrow(run, f"id long, spans {SPANS}").withColumnRenamed("id", id_col)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*BASE))


def how_many(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with every span replaced by its kind in angle brackets; of
    overlapping spans the first, then the longest, gives the kind."""
    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton()
        for b in batches:
            out = []
            for t in b.column("text"):
                text = t.as_py()
                if text:
                    parts, at = [], 0
                    for kind, start, end in sorted(find_spans(text, auto), key=lambda s: (s[1], -s[2])):
                        if start >= at:
                            parts += [text[at:start], f"<{kind}>"]
                        at = max(at, end)
                    text = "".join(parts) + text[at:]
                out.append(text)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(out, pa.string())], ["id", "text"])

    return source.mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)
