"""Personal data replaced by keyed pseudonyms of the same format."""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator
from datetime import date, timedelta
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.llm.common import documents, map_columns, slices

ROUNDS = 8
# For tests and the registered query; a user passes a key of their own.
SAMPLE_KEY = b"codeloom sample key"
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)
HEX = frozenset("0123456789abcdefABCDEF")

KINDS = re.compile(
    r"""
      (?P<email>(?<![A-Za-z0-9_.+%-])[A-Za-z0-9_.+%-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})
    | (?:(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s*[=:]\s*["']?)(?P<secret>[A-Za-z0-9+/_-]{8,})
    | (?<![A-Za-z0-9])(?P<key>(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36})(?![A-Za-z0-9])
    | (?<![A-Za-z0-9])(?P<iban>[A-Z]{2}\d{2}(?:\ ?[A-Z0-9]{4}){2,7}(?:\ ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])
    | (?<![\d.])(?P<ip>(?:\d{1,3}\.){3}\d{1,3})(?!\d|\.\d)
    | (?<![\d/.-])(?P<date>\d{4}-\d\d-\d\d|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-])
    | (?<![\d-])(?P<ssn>\d{3}-\d\d-\d{4})(?![\d-])
    | (?<![\d+(])(?P<phone>(?:\+?1[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|(?:\+?1[ .-])?\d{3}[.-]\d{3}[.-]\d{4}|\+\d{2,3}[ .-]\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4})(?!\d)
    | (?<![\d+])(?P<card>\d(?:[ -]?\d){12,18})(?!\d)
    """,
    re.VERBOSE,
)
# Every value holds one of these or follows a label, so texts without need no closer look.
WORTH_A_LOOK = re.compile(
    r"[0-9@]|AKIA|ASIA|gh[pousr]_|(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s*[=:]"
)
CARD_DIGITS = 13
# Characters of an account number with country and check digits.
IBAN_LENGTHS = {
    c: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 33: "LC RU",
    }.items()
    for c in countries.split()
}

Span = tuple[int, int, str]


class Cipher:
    """A keyed permutation of any range of integers: a Feistel network over two nearly equal halves.

    What falls outside the range is permuted again until it falls inside, which keeps the
    mapping one to one.
    """

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        self.key, self.rounds = key, rounds

    def _draw(self, tweak: bytes, size: int, turn: int, half: int, modulus: int) -> int:
        width = modulus.bit_length() // 8 + 9
        seed = b"\0".join((self.key, tweak, str(size).encode(), str(turn).encode(), str(half).encode()))
        return int.from_bytes(hashlib.shake_256(seed).digest(width), "big") % modulus

    def permute(self, value: int, size: int, tweak: bytes, back: bool = False) -> int:
        wide = isqrt(max(0, size - 1)) + 1
        narrow = -(-size // wide)
        while True:
            left, right = divmod(value, narrow)
            turns = range(self.rounds)
            for turn in reversed(turns) if back else turns:
                if turn % 2 == 0:
                    step = self._draw(tweak, size, turn, right, wide)
                    left = (left - step if back else left + step) % wide
                else:
                    step = self._draw(tweak, size, turn, left, narrow)
                    right = (right - step if back else right + step) % narrow
            value = left * narrow + right
            if value < size:
                return value


def _permuted(cipher: Cipher, chars: list[str], alphabets: list[str], tweak: str, back: bool) -> list[str]:
    """``chars`` permuted within the strings that the alphabets allow at each place."""
    value, size = 0, 1
    for c, letters in zip(chars, alphabets):
        value, size = value * len(letters) + letters.index(c), size * len(letters)
    value = cipher.permute(value, size, tweak.encode(), back)
    out = []
    for letters in reversed(alphabets):
        value, place = divmod(value, len(letters))
        out.append(letters[place])
    return out[::-1]


def _class(c: str) -> str:
    """The characters that may stand for ``c``; one that is not an ASCII letter or digit stays."""
    for letters in (string.digits, string.ascii_lowercase, string.ascii_uppercase):
        if c in letters:
            return letters
    return c


def _same_classes(cipher: Cipher, value: str, tweak: str, back: bool) -> str:
    """Digits stay digits, letters keep their case; hexadecimal texts stay hexadecimal and others don't become so."""
    hexadecimal = HEX.issuperset(value)
    letters = [_class(c) for c in value]
    if hexadecimal:
        letters = [x[:6] if c.isalpha() else x for c, x in zip(value, letters)]
    tweak = f"{tweak}:{'hex' if hexadecimal else 'text'}:{''.join(x[0] for x in letters)}"
    out = list(value)
    while True:
        out = _permuted(cipher, out, letters, tweak, back)
        if hexadecimal or not HEX.issuperset(out):
            return "".join(out)


def _digits(value: str) -> str:
    return "".join(c for c in value if c.isdigit())


def _filled(template: str, chars: str) -> str:
    """``template`` with its letters and digits replaced in turn."""
    rest = iter(chars)
    return "".join(next(rest) if c.isalnum() else c for c in template)


def luhn_digit(body: str) -> str:
    """The digit that completes ``body`` to a valid card number."""
    total = 0
    for i, c in enumerate(reversed(body)):
        n = int(c) * (2 - i % 2)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def iban_digits(country: str, account: str) -> str:
    """The two check digits of an account number."""
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _card(cipher, value, back):
    digits = _digits(value)
    if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    first = "0" if digits[0] == "0" else "123456789"
    body = list(digits[:-1])
    while True:
        body = _permuted(cipher, body, [first] + [string.digits] * (len(body) - 1), "card", back)
        text = "".join(body)
        text += luhn_digit(text)
        if len(set(text)) > 1:
            return _filled(value, text)


def _iban(cipher, value, back):
    plain = value.replace(" ", "")
    country, check, account = plain[:2], plain[2:4], plain[4:]
    if not 15 <= len(plain) <= 34 or iban_digits(country, account) != check:
        return None
    letters = [_class(c) for c in account]
    account = "".join(_permuted(cipher, list(account), letters, f"iban:{country}:{''.join(x[0] for x in letters)}", back))
    return _filled(value, country + iban_digits(country, account) + account)


def _ip(cipher, value, back):
    parts = value.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    ranges = [range(10) if len(p) == 1 else range(10, 100) if len(p) == 2 else range(100, 256) for p in parts]
    number, size = 0, 1
    for p, r in zip(parts, ranges):
        number, size = number * len(r) + int(p) - r.start, size * len(r)
    number = cipher.permute(number, size, ("ip:" + ".".join(str(len(p)) for p in parts)).encode(), back)
    out = []
    for r in reversed(ranges):
        number, place = divmod(number, len(r))
        out.append(str(r[place]))
    return ".".join(reversed(out))


def _date(cipher, value, back):
    mark = next(c for c in value if not c.isdigit())
    parts = value.split(mark)
    widths = [len(p) for p in parts]

    month_first = mark == "/" and int(parts[1]) > 12
    year, month, day = parts if widths[0] == 4 else parts[::-1]
    if month_first:
        month, day = day, month
    try:
        at = date(int(year), int(month), int(day))
    except ValueError:
        return None
    if not FIRST_DAY <= at <= LAST_DAY:
        return None
    while True:
        offset = cipher.permute((at - FIRST_DAY).days, (LAST_DAY - FIRST_DAY).days + 1, b"date", back)
        at = FIRST_DAY + timedelta(days=offset)
        numbers = (at.year, at.month, at.day)
        if month_first:
            numbers = (at.year, at.day, at.month)
        out = [str(n).zfill(w) for n, w in zip(numbers if widths[0] == 4 else numbers[::-1], widths)]
        # The result must be read in the same order and fit into the same places.
        if [len(x) for x in out] == widths and (not month_first or at.day > 12):
            return mark.join(out)


def _ssn(cipher, value, back):
    def valid(digits):
        return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"

    digits = _digits(value)
    if not valid(digits):
        return None
    while True:
        digits = "".join(_permuted(cipher, list(digits), [string.digits] * 9, "ssn", back))
        if valid(digits):
            return _filled(value, digits)


def _phone(cipher, value, back):
    digits = _digits(value)
    if value.startswith("+") and not value.startswith("+1"):
        code = re.match(r"\+\d+", value)[0][1:]
    else:
        code = digits[:-10]
    body = digits[len(code) :]
    if not 7 <= len(body) <= 15:
        return None
    letters = [string.digits] * len(body)
    if code in ("", "1") and len(body) == 10:
        for place in (0, 3):
            letters[place] = "23456789" if body[place] in "23456789" else "01"
    tweak = f"phone:{'' if code == '1' else code}:{''.join(x[0] for x in letters)}"
    return _filled(value, code + "".join(_permuted(cipher, list(body), letters, tweak, back)))


def _email(cipher, value, back):
    name, _, top = value.rpartition(".")
    return f"{_same_classes(cipher, name, 'email', back)}.{top}"


def _secret(cipher, value, back):
    return _same_classes(cipher, value, "secret", back) if any(c.isalnum() for c in value) else None


def _key(cipher, value, back):
    head = value[:4]
    return head + _same_classes(cipher, value[4:], f"key:{head}", back)


CONVERT = {
    "email": _email, "secret": _secret, "key": _key, "iban": _iban, "ip": _ip,
    "date": _date, "ssn": _ssn, "phone": _phone, "card": _card,
}


@lru_cache(maxsize=65_536)
def pseudonym(kind: str, value: str, key: bytes, back: bool = False) -> str | None:
    """The pseudonym of a value, or the value of a pseudonym; None if the value is not valid."""
    return CONVERT[kind](Cipher(key), value, back)


def _ends(kind: str, text: str, low: int, high: int) -> Iterator[int]:
    """Where a value that starts at ``low`` may end, the likeliest end first.

    A card or account number may be followed by numbers or capitals that the longest match takes for its own.
    """
    breaks = []
    if kind in ("card", "iban"):
        breaks = [e for e in range(high - 1, low, -1) if text[e - 1].isalnum() and not text[e].isalnum()]
    if kind == "iban" and (length := IBAN_LENGTHS.get(text[low : low + 2])):
        breaks = [e for e in breaks if len(text[low:e].replace(" ", "")) == length]
        yield from breaks
        yield high
        return
    yield high
    for e in breaks:
        if kind == "iban" or len(_digits(text[low:e])) >= CARD_DIGITS:
            yield e


def pseudonymise(text: str | None, key: bytes) -> tuple[str | None, list[Span]]:
    """The text with every valid value replaced, and where. Lengths don't change."""
    if not text or not WORTH_A_LOOK.search(text):
        return text, []
    pieces, spans, at, start = [], [], 0, 0
    while found := KINDS.search(text, start):
        kind = found.lastgroup
        low, longest = found.span(kind)
        for high in _ends(kind, text, low, longest):
            if (other := pseudonym(kind, text[low:high], key)) is not None:
                break
        if other is None:
            # Not valid: a value of another kind may begin within.
            start = low + 1
            continue
        pieces += [text[at:low], other]
        spans.append((low, high, kind))
        at = start = high
    return "".join([*pieces, text[at:]]), spans


def restore(text: str, spans: list[Span], key: bytes) -> str:
    """The original of a pseudonymised text."""
    for low, high, kind in spans:
        text = text[:low] + pseudonym(kind, text[low:high], key, True) + text[high:]
    return text


SPANS = "array<struct<start:int,end:int,kind:string>>"


def pseudonyms(docs: DataFrame, key: bytes = SAMPLE_KEY) -> DataFrame:
    """``(doc_id, text, n_found, spans)``, one row per row, with valid personal values replaced in ``text``.

    Emails, secrets, access keys, account and card numbers (check digits hold), IPv4 addresses,
    calendar dates of 1900 to 2099, social security and phone numbers are permuted under ``key``
    within their format: the same value gives the same pseudonym everywhere. What is not valid, such as a card number
    with a wrong check digit, stays. Null texts stay null, empty ones empty, null ids null; repeated
    rows are each converted; an empty table gives an empty one. Nothing is shuffled.
    """

    def batch(b: pa.RecordBatch) -> dict[str, object]:
        done = [pseudonymise(t, key) for t in b.column(1).to_pylist()]
        return {
            "doc_id": b.column(0),
            "text": [t for t, _ in done],
            "n_found": [len(s) for _, s in done],
            "spans": [[{"start": a, "end": z, "kind": k} for a, z, k in s] for _, s in done],
        }

    wanted = docs.select(F.col("doc_id").cast("long"), "text")
    return map_columns(wanted, batch, f"doc_id long, text string, n_found int, spans {SPANS}")


def replace_text(docs: DataFrame, key: bytes = SAMPLE_KEY) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, all other columns and all rows as they are."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            place = b.schema.get_field_index("text")
            texts = [pseudonymise(t, key)[0] for t in b.column(place).to_pylist()]
            yield b.set_column(place, b.schema.field(place), pa.array(texts, b.schema.field(place).type))

    return docs.mapInArrow(convert, docs.schema)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms(documents(spark, sf_dir))
