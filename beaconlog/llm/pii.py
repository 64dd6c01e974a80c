"""Personal data replaced by format-preserving Feistel pseudonyms.

A match that passes its check (Luhn, mod 97, calendar, octets, ...) is turned into a
number below the size of its format's domain. A keyed Feistel network permutes
that domain, and the permuted number is written back in the very format that was
found: digits stay digits, separators stay where they are, check digits are
right again. A permutation is one-to-one, so equal values have equal pseudonyms
in all documents and however they are punctuated, different values different
ones, and the holder of the key can undo them. (A date is day before month unless
only the other reading is a date, so undoing month-first dates needs to know that.)

Where a value ends is not always where its run of groups ends: a year, a security
code or another value may follow. Ends are tried at the borders between groups, the
length that the country prescribes first, then the longest; none may cut through an
address, date or number that passes its own check. If no end passes, the search goes
on right behind the start. (A foreign number behind a card that passes the check
together with it, one in ten, counts as part of it, before or after the change:
``restore`` undoes by the spans and does not depend on that.)

Letters of a mail address move within their alphabet or script; marks stay. Not looked for: secrets,
IPv6 addresses, phone numbers without country code in groups other than 3-3-4, and letters of other scripts than those listed.

Each row is changed on its own: there is no shuffle and no shared table, whatever
the frequency of a value. What fails its check is left alone.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
LAST_DAY = datetime.date(2099, 12, 31).toordinal()

LOWER = "abcdefghijklmnopqrstuvwxyz"
ACCENTED = "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
ALPHABETS = ["0123456789", LOWER, LOWER.upper(), ACCENTED]

# letters of other scripts, first and last: they move among those of their own range
SCRIPTS = [
    (0x391, 0x3A1), (0x3A3, 0x3A9), (0x3B1, 0x3C9), (0x410, 0x42F), (0x430, 0x44F), (0x5D0, 0x5EA), (0x621, 0x63A), (0x641, 0x64A),
    (0x904, 0x939), (0xE01, 0xE2E), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3),
]

# the part before the @ may hold most marks that mail systems allow, but does not begin with one that quotes or joins
EMAIL = re.compile(r"(?<![\w.+-])([\w+-][\w.!#$%&'*^~+-]{0,63})@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}(?![\w-])")
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
NUMBERS = re.compile(
    r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){1,4}(?!\d)|(?<![\w)])\(\d{3}\) ?\d{3}[-. ]\d{4}(?!\d)|(?<![\w.-])\d{3}-\d{3}-\d{4}(?![\w-]))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<date>(?<![\w./-])(?:\d{4}(?P<a>[-/.])\d{1,2}(?P=a)\d{1,2}|\d{1,2}(?P<b>[-/.])\d{1,2}(?P=b)\d{4})(?!(?!T\d)[\w/-]|\.\d))"
    rf"|(?P<ip>(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?!\w|\.\d))"
    r"|(?P<card>(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]))",
    re.ASCII,
)
TELLTALE = re.compile("[0-9]", re.ASCII)

# digits behind the country code where the numbering plan is closed; codes of three digits are not kept by phone()
NATIONAL = {
    "1": [10], "7": [10], "27": [9], "30": [10], "31": [9], "32": [9, 8], "33": [9], "34": [9], "36": [9, 8], "40": [9],
    "41": [9], "44": [10], "45": [8], "47": [8], "48": [9], "52": [10], "54": [10], "55": [11, 10], "57": [10],
    "61": [9], "65": [8], "81": [10, 9], "86": [11, 10], "90": [10], "91": [10],
}
IBAN_CHARS = {
    code: int(n)
    for n, codes in (
        line.split(":")
        for line in (
            "15:NO", "16:BE", "18:DK FO FI GL NL SD", "19:MK SI", "20:AT BA EE KZ LT LU MN XK", "21:CH HR LI LV",
            "22:BG BH CR DE GB GE IE ME RS VA", "23:AE GI IL IQ OM SO TL", "24:AD CZ ES MD PK RO SA SE SK TN VG",
            "25:LY PT ST", "26:IS TR", "27:BI DJ FR GR IT MC MR SM", "28:AL AZ BY CY DO GT HU LB NI PL SV",
            "29:BR EG PS QA UA", "30:JO KW MU", "31:MT SC", "32:LC", "33:RU",
        )
    )
    for code in codes.split()
}
# a card that is only part of its run of digits has groups of so many at least: lists of short numbers are no cards
PART_DIGITS = 3


# ── the permutation ─────────────────────────────────────────────────────────

def permute(value: int, size: int, key: bytes, kind: str, back: bool = False) -> int:
    """The keyed permutation of 0 .. size - 1 for ``kind``, or its inverse.

    A balanced Feistel network over the smallest even number of bits that holds
    the domain; results outside are permuted again until they fall inside.
    """
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask, tweak = (1 << half) - 1, f"{kind}:{size}:".encode()
    rounds = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)

    def mix(k: int, x: int) -> int:
        data = tweak + bytes([k]) + x.to_bytes((half + 7) // 8, "little")
        return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=32).digest(), "little") & mask

    while True:
        left, right = value >> half, value & mask
        for k in rounds:
            left, right = (right ^ mix(k, left), left) if back else (right, left ^ mix(k, right))
        value = left << half | right
        if value < size:
            return value


def permute_text(text: str, key: bytes, kind: str, back: bool = False) -> str:
    """Every character moves within its alphabet; characters of none stay."""
    places = [(k, *p) for k, c in enumerate(text) if (p := _alphabet(c)) is not None]
    if not places:
        return text
    value, total = 0, 1
    for _, _, at, size in places:
        value, total = value * size + at, total * size
    # what stays belongs to the format, so the permutation is of texts of this shape
    shape = list(text)
    for k, name, _, _ in places:
        shape[k] = str(name)
    value = permute(value, total, key, kind + ":" + "".join(shape), back)
    out = list(text)
    for k, name, _, size in reversed(places):
        value, at = divmod(value, size)
        out[k] = ALPHABETS[name][at] if name < len(ALPHABETS) else chr(SCRIPTS[name - len(ALPHABETS)][0] + at)
    return "".join(out)


def _alphabet(c: str) -> tuple[int, int, int] | None:
    """Number of the character's alphabet, its place there and the alphabet's size."""
    for n, letters in enumerate(ALPHABETS):
        if c in letters:
            return n, letters.index(c), len(letters)
    for n, (first, last) in enumerate(SCRIPTS, len(ALPHABETS)):
        if first <= ord(c) <= last:
            return n, ord(c) - first, last - first + 1
    return None


def _digits(found: str) -> str:
    return re.sub(r"\D", "", found, flags=re.ASCII)


def _write(found: str, symbols: str) -> str:
    """``symbols`` in the places of the letters and digits of ``found``."""
    rest = iter(symbols)
    return "".join(next(rest) if c.isalnum() else c for c in found)


# ── the formats: each gives the pseudonym, or None if the check fails ────────

def luhn_digit(body: str) -> int:
    total = 0
    for k, c in enumerate(reversed(body)):
        d = int(c) * (2 - k % 2)
        total += d - 9 * (d > 9)
    return -total % 10


def card(found: str, key: bytes, back: bool = False) -> str | None:
    digits = _digits(found)
    if luhn_digit(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
        return None
    n = len(digits) - 1
    body = str(permute(int(digits[:-1]), 10**n, key, "card", back)).zfill(n)
    return _write(found, body + str(luhn_digit(body)))


def iban_number(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text))


def iban(found: str, key: bytes, back: bool = False) -> str | None:
    plain = found.replace(" ", "")
    if not 15 <= len(plain) <= 34 or iban_number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = permute_text(plain[4:], key, "iban" + plain[:2], back)
    check = 98 - iban_number(body + plain[:2] + "00") % 97
    return _write(found, f"{plain[:2]}{check:02d}{body}")


def phone(found: str, key: bytes, back: bool = False) -> str | None:
    digits = _digits(found)
    if not 8 <= len(digits) <= 15:
        return None
    country = 0 if found[0] != "+" else 1 if digits[0] in "17" else 2
    own, n = digits[country:], len(digits) - country
    return _write(found, digits[:country] + str(permute(int(own), 10**n, key, "phone", back)).zfill(n))


def _ssn_ok(digits: str) -> bool:
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


def ssn(found: str, key: bytes, back: bool = False) -> str | None:
    digits = _digits(found)
    if not _ssn_ok(digits):
        return None
    while True:
        digits = str(permute(int(digits), 10**9, key, "ssn", back)).zfill(9)
        if _ssn_ok(digits):
            return _write(found, digits)


def date(found: str, key: bytes, back: bool = False) -> str | None:
    a, b, c = re.split(r"[-/.]", found)
    orders = [(0, 1, 2)] if len(a) == 4 else [(2, 1, 0), (2, 0, 1)]
    for y, m, d in orders:
        parts = [a, b, c]
        try:
            day = datetime.date(int(parts[y]), int(parts[m]), int(parts[d])).toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        moved = datetime.date.fromordinal(FIRST_DAY + permute(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, key, "date", back))
        padded = len(parts[m]) == 2 and len(parts[d]) == 2
        parts[y] = f"{moved.year:04d}"
        parts[m], parts[d] = (f"{moved.month:02d}", f"{moved.day:02d}") if padded else (str(moved.month), str(moved.day))
        sep = found[len(a)]
        return sep.join(parts)
    return None


def ip(found: str, key: bytes, back: bool = False) -> str | None:
    value = int.from_bytes(bytes(map(int, found.split("."))), "big")
    return ".".join(map(str, permute(value, 1 << 32, key, "ip", back).to_bytes(4, "big")))


FORMATS: dict[str, Callable[..., str | None]] = {
    "iban": iban, "phone": phone, "ssn": ssn, "date": date, "ip": ip, "card": card,
}


# ── where a value ends ──────────────────────────────────────────────────────

def _ends(text: str, start: int, end: int, kind: str, part: bool) -> tuple[list[int], list[int]]:
    """The places where its country lets the value end, and the others, longest first.

    ``part``: the value begins inside a run that failed.
    """
    if kind not in ("iban", "phone", "card") or (kind == "phone" and text[start] != "+"):
        return [], [end]
    borders = [k for k in range(end - 1, start, -1) if text[k] in " .-" and text[k - 1].isalnum() and text[k + 1].isalnum()]
    if kind == "card":
        groups = [len(g) for g in re.split("[ -]", text[start:end])]
        ends = [] if part and min(groups) < PART_DIGITS else [end]
        return [], ends + [k for k in borders if min(map(len, re.split("[ -]", text[start:k]))) >= PART_DIGITS]
    ends = [end, *borders]
    if kind == "iban":
        due = [IBAN_CHARS.get(text[start:start + 2])]
        size = lambda k: k - start - text.count(" ", start, k)
    else:
        code = next((c for c in (text[start + 1], text[start + 1:start + 3]) if c in NATIONAL), "")
        due = [len(code) + n + text.count("(0)", start, end) for n in NATIONAL.get(code, [])]
        size = lambda k: len(_digits(text[start:k]))
    return [k for n in due for k in ends if size(k) == n], [k for k in ends if size(k) not in due]


def _plain(text: str, at: int, key: bytes, cards: bool) -> int | None:
    """The end of the value with a check of its own that begins here, not a phone or an IBAN."""
    m = NUMBERS.match(text, at)
    if m is None or m.lastgroup not in ("ssn", "date", "ip", "card")[:3 + cards]:
        return None
    return next((e for e in _ends(text, at, m.end(), m.lastgroup, True)[1] if _made(text, at, e, m.lastgroup, key)), None)


def _made(text: str, start: int, end: int, kind: str, key: bytes, back: bool = False) -> str | None:
    found = text[start:end]
    if kind == "card" and not 13 <= len(_digits(found)) <= 19:
        return None
    return FORMATS[kind](found, key, back)


def _value(text: str, m: re.Match, limit: int, key: bytes, back: bool, part: bool) -> tuple[int, str] | None:
    """The end, at most ``limit``, and the pseudonym of the value that begins where ``m`` does."""
    start, kind = m.start(), m.lastgroup
    due, free = _ends(text, start, m.end(), kind, part)
    made = {e: _made(text, start, e, kind, key, back) for e in due + free if e <= limit}
    due, free = ([e for e in ends if made.get(e) is not None] for ends in (due, free))
    if (due or free) and kind in ("iban", "phone", "card"):
        # other values that begin inside the run and may not be cut
        starts = [k for k in range(start + 1, m.end()) if text[k - 1] == " " and text[k].isdigit()]
        others = {k: stop for k in starts if (stop := _plain(text, k, key, False)) is not None}
        if kind == "iban" and not due:
            # no length but its country's goes over the start of an IBAN
            inner = (n for n in NUMBERS.finditer(text[:m.end()], start + 1) if n.lastgroup == "iban")
            before = [n.start() for n in inner if any(_made(text, n.start(), e, "iban", key) for e in _ends(text, n.start(), n.end(), "iban", True)[0])]
            free = [e for e in free if not before or e < before[0]]
        if kind == "phone":
            # one in ten digit strings passes for a card: only the one that reaches furthest, where the phone can have ended
            cards = {k: stop for k in starts if k - 1 in (due or free) and (stop := _plain(text, k, key, True)) is not None}
            if cards:
                best = max(cards, key=lambda k: (cards[k], k))
                others[best] = cards[best]
        due, free = ([e for e in ends if not any(k < e < stop for k, stop in others.items())] for ends in (due, free))
        free.sort(key=lambda e: e + 1 not in others)  # stable: longest first among those before another value
    return next(((e, made[e]) for e in due + free), None)


def pseudonymize(text: str, key: bytes, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and ``(kind, start, end)`` of each in the new text."""
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        for m in EMAIL.finditer(text):
            local = permute_text(m[1], key, "email", back)
            if local != m[1]:
                found.append((m.start(1), m.end(1), "email", local))
    if TELLTALE.search(text):
        taken = [(m.start(), m.end()) for m in EMAIL.finditer(text)] if found else []
        at = failed = mail = 0
        while m := NUMBERS.search(text, at):
            while mail < len(taken) and taken[mail][1] <= m.start():
                mail += 1
            limit, behind = taken[mail] if mail < len(taken) else (len(text), 0)
            if limit <= m.start():
                at = behind
                continue
            value = _value(text, m, limit, key, back, m.start() < failed)
            if value is None:
                at, failed = m.start() + 1, max(failed, m.end())
            else:
                found.append((m.start(), value[0], m.lastgroup, value[1]))
                at = value[0]
        found.sort()
    return _replace(text, found)


def restore(text: str, spans: list[tuple[str, int, int]], key: bytes) -> str:
    """The text as it was before ``pseudonymize``, which gave ``text`` and ``spans``."""
    made = [
        (a, b, kind, permute_text(text[a:b], key, kind, True) if kind == "email" else FORMATS[kind](text[a:b], key, True))
        for kind, a, b in spans
    ]
    return _replace(text, made)[0]


def _replace(text: str, found: list[tuple[int, int, str, str]]) -> tuple[str, list[tuple[str, int, int]]]:
    out, spans, at, size = [], [], 0, 0
    for start, end, kind, made in found:
        out += [text[at:start], made]
        size += start - at
        spans.append((kind, size, size + len(made)))
        size += len(made)
        at = end
    return "".join(out) + text[at:], spans


# ── on Spark ────────────────────────────────────────────────────────────────

SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _run(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for text in batch["text"].to_pylist():
                new, where = (None, []) if text is None else pseudonymize(text, key)
                texts.append(new)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in where])
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(texts, pa.string()), pa.array(spans, _SPANS)], ["id", "text", "spans"]
            )

    return run


def pseudonymize_documents(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, text, spans`` (places in the new text, in order), ``n_replaced``.

    A null text stays null and an empty one empty, without spans. Ids may be null or
    repeat; other columns are ignored. An empty table gives no rows. Long texts are
    read whole. ``key`` must be 1 to 64 bytes and kept secret.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(_run(key), f"id long, text string, spans {SPANS}")
    return out.select(F.col("id").alias(id_col), "text", "spans", F.size("spans").alias("n_replaced"))
