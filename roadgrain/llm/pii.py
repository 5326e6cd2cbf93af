"""Format-preserving pseudonyms: a keyed Feistel permutation inside the format of each value.

Validated numbers (payment cards, IBANs, social security and telephone numbers, IPv4
addresses), dates and e-mail names are mapped to values of the same format, one to
one, so equal values stay equal in all documents and nothing else in a text changes.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from roadgrain.llm.common import in_arrow

KINDS = ("email", "iban", "card", "ssn", "phone", "ip", "date")
ROUNDS = 8
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)
REMEMBERED = 200_000

_DIGIT_PATTERN = re.compile(
    r"""(?<![0-9A-Za-z])(?P<iban>[A-Z]{2}[0-9]{2}(?:[0-9A-Z]{11,30}|(?:\x20[0-9A-Z]{4}){2,7}(?:\x20[0-9A-Z]{1,3})?))(?![0-9A-Za-z])
      |(?<![0-9.,])(?P<ip>(?:[0-9]{1,3}\.){3}[0-9]{1,3})(?![0-9]|\.[0-9])
      |(?<![0-9-])(?P<date>[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9-])
      |(?<![0-9-])(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])
      |(?<![0-9A-Za-z])(?P<card>[0-9]{13,19}|[0-9]{4}([\x20-])[0-9]{4}(?:\6[0-9]{4}){2}|[0-9]{4}([\x20-])[0-9]{6}\7[0-9]{5})(?![0-9A-Za-z])
      |(?<![0-9A-Za-z+])(?P<phone>\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[\x20.-]?[0-9]{2,4}){2,4}|\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4})(?![0-9A-Za-z])
    """,
    re.X,
)
_MAIL_PATTERN = re.compile(r"(?<![A-Za-z0-9._%+-])(?P<email>[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24})")
_SETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def luhn(digits: str) -> bool:
    total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def iban_remainder(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


class Pseudonyms:
    """Keyed permutations of values; one object per task."""

    def __init__(self, key: bytes):
        self.key = key
        self.known: dict[tuple[str, str], str | None] = {}

    def _round(self, tweak: str, number: int, half: int, modulus: int) -> int:
        data = f"{tweak}|{number}|{half}".encode()
        return int.from_bytes(hmac.new(self.key, data, hashlib.sha256).digest()[:24], "big") % modulus

    def permuted(self, value: int, size: int, tweak: str) -> int:
        """A permutation of 0 .. size - 1: Feistel rounds over two mixed-radix halves, walked until inside."""
        low = max(2, int(size**0.5))
        high = -(-size // low)
        while True:
            a, b = divmod(value, low)
            for i in range(ROUNDS):
                if i % 2:
                    b = (b + self._round(tweak, i, a, low)) % low
                else:
                    a = (a + self._round(tweak, i, b, high)) % high
            value = a * low + b
            if value < size:
                return value

    def letters(self, text: str, tweak: str) -> str:
        """Digits and ASCII letters permuted within their kind and place; all else stays."""
        sets = [next((s for s in _SETS if c in s), None) for c in text]
        value = size = 0
        for c, s in zip(text, sets):
            if s:
                value, size = value * len(s) + s.index(c), (size or 1) * len(s)
        if size < 2:
            return text
        value = self.permuted(value, size, tweak)
        out = []
        for c, s in zip(reversed(text), reversed(sets)):
            if s:
                value, at = divmod(value, len(s))
                c = s[at]
            out.append(c)
        return "".join(reversed(out))

    def digits(self, digits: str, tweak: str) -> str:
        return str(self.permuted(int(digits), 10 ** len(digits), f"{tweak}{len(digits)}")).zfill(len(digits))

    def of(self, kind: str, text: str) -> str | None:
        """The pseudonym, or None if the value isn't valid."""
        if (kind, text) not in self.known:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            self.known[kind, text] = getattr(self, f"_{kind}")(text)
        return self.known[kind, text]

    def _email(self, text: str) -> str:
        name, _, host = text.rpartition("@")
        labels = host.split(".")
        shape = re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", name)))
        return self.letters(name, f"email{shape}{host.lower()}") + "@" + ".".join(labels)

    def _card(self, text: str) -> str | None:
        digits = re.sub("[^0-9]", "", text)
        if not 13 <= len(digits) <= 19 or not luhn(digits) or len(set(digits)) == 1:
            return None
        body = self.digits(digits[:-1], "card")
        check = next(c for c in "0123456789" if luhn(body + c))
        return _poured(text, body + check)

    def _iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or iban_remainder(plain) != 1:
            return None
        body = self.letters(plain[4:], f"iban{plain[:2]}{len(plain)}")
        check = 98 - iban_remainder(plain[:2] + "00" + body)
        return _poured(text, plain[:2] + f"{check:02d}" + body)

    def _ssn(self, text: str) -> str | None:
        area, group, serial = map(int, text.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        areas = 898  # 001-899 without 666
        value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        value = self.permuted(value, areas * 99 * 9999, "ssn")
        value, serial = divmod(value, 9999)
        area, group = divmod(value, 99)
        return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def _phone(self, text: str) -> str | None:
        digits = re.sub("[^0-9]", "", text)
        if not 7 <= len(digits) <= 15:
            return None
        code = re.match(r"\+([0-9]{1,3})(?=[^0-9])", text)
        kept = code[1] if code else ""
        return _poured(text, kept + self.digits(digits[len(kept) :], f"phone{kept}"))

    def _ip(self, text: str) -> str | None:
        parts = text.split(".")
        if any(int(p) > 255 or (p != "0" and p[0] == "0") for p in parts):
            return None
        value = int.from_bytes(bytes(map(int, parts)), "big")
        return ".".join(map(str, self.permuted(value, 1 << 32, "ip").to_bytes(4, "big")))

    def _date(self, text: str) -> str | None:
        mark = re.search("[^0-9]", text)[0]
        parts = list(map(int, text.split(mark)))
        year_first = text[4] == mark
        y, m, d = parts if year_first else (parts[2], *((parts[1], parts[0]) if mark == "." or parts[1] <= 12 else parts[:2]))
        try:
            day = date(y, m, d)
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        size = (LAST_DAY - FIRST_DAY).days + 1
        new = FIRST_DAY + timedelta(self.permuted((day - FIRST_DAY).days, size, "date"))
        if year_first:
            return f"{new.year:04d}{mark}{new.month:02d}{mark}{new.day:02d}"
        month_first = mark == "/" and parts[1] > 12
        first, second = (new.month, new.day) if month_first else (new.day, new.month)
        return f"{first:02d}{mark}{second:02d}{mark}{new.year:04d}"

    def text(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with all valid values replaced, and how many of each kind."""
        counts = dict.fromkeys(KINDS, 0)

        def kind_of(found: re.Match) -> str:
            return next(k for k in KINDS if k in found.re.groupindex and found[k] is not None)

        def before_next(found: re.Match) -> re.Match | None:
            """A telephone number that ran into a value of another kind, up to that value."""
            inner = found
            while (inner := inner.re.search(text, inner.start() + 1)) and inner.start() < found.end():
                if kind_of(inner) != "phone" and self.of(kind_of(inner), inner[0]) is not None:
                    shorter = found.re.match(text, found.start(), inner.start())
                    if shorter and self.of("phone", shorter[0]) is not None:
                        return shorter
            return None

        def swapped(pattern: re.Pattern) -> str:
            parts, done, found = [], 0, pattern.search(text)
            while found:
                kind = kind_of(found)
                value = found[kind]
                new = self.of(kind, value)
                if new is None and kind == "phone" and (shorter := before_next(found)):
                    value = shorter[0]
                    new = self.of(kind, value)
                while new is None and kind == "iban" and " " in value:  # capitals that follow are not part of it
                    value = value.rpartition(" ")[0]
                    new = self.of(kind, value)
                at = found.start() + 1  # what is inside a rejected match, or behind a trimmed one, is read again
                if new is not None:
                    counts[kind] += 1
                    at = found.start(kind) + len(value)
                    parts += text[done : found.start(kind)], new
                    done = at
                found = pattern.search(text, at)
            return "".join([*parts, text[done:]])

        if _HAS_DIGIT.search(text):
            text = swapped(_DIGIT_PATTERN)
        if "@" in text:
            text = swapped(_MAIL_PATTERN)
        return text, counts


_HAS_DIGIT = re.compile("[0-9]")


def _poured(shape: str, characters: str) -> str:
    """The characters in the places of the shape's digits and letters."""
    rest = iter(characters)
    return "".join(next(rest) if c.isalnum() else c for c in shape)


def pseudonymised(documents: DataFrame, key: str) -> DataFrame:
    """All columns with the new text, and ``n_<kind>`` for each kind.

    A null text stays null with counts 0; an empty one stays empty. Equal values under one key
    have equal pseudonyms in all rows. A column that is already called ``n_<kind>`` is replaced.
    """
    names = [f"n_{k}" for k in KINDS]
    rows = documents.drop(*names)
    columns_out, at, secret = [*rows.columns, *names], rows.columns.index("text"), key.encode()

    def swap(batches):
        pseudonyms = Pseudonyms(secret)
        for batch in batches:
            texts, counts = [], []
            for text in batch.column(at):
                new, own = pseudonyms.text(text.as_py()) if text.is_valid else (None, dict.fromkeys(KINDS, 0))
                texts.append(new)
                counts.append(own)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            columns += [pa.array([c[k] for c in counts], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(columns, names=columns_out)

    schema = StructType([*rows.schema.fields, *(StructField(n, LongType()) for n in names)])
    return in_arrow(rows, swap, schema)
