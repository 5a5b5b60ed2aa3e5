"""Pseudonyms for personal data that keep their format.

Values are found by form and validated (check digits, number ranges, the calendar); each is then
permuted within the set of valid values of its format by a keyed Feistel network. Equal values
get equal pseudonyms in all documents, so links stay, and the key's owner can undo them.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import text_slices

ROUNDS = 8
_FIRST_DAY, _LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
_MAYBE = re.compile("[0-9@]")
#: The months' names; their first three letters are their short forms.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
_MONTH = "|".join([*MONTHS, *(m[:3] for m in MONTHS)])
#: Forms that tell where a value ends, in the order that they are tried in; a number may follow.
_STRICT = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?!\w)",
    "isodate": r"(?<!\d)(?:19|20)\d\d-\d\d-\d\d(?!\d)",
    "dotdate": r"(?<!\d)(?<!\d\.)\d{1,2}\.\d{1,2}\.(?:19|20)\d\d(?!\d)",
    "ymddate": r"(?<![\d/])(?:19|20)\d\d/\d{1,2}/\d{1,2}(?![\d/])",
    "namedate": rf"(?<!\w)(?:(?:{_MONTH})\.? \d{{1,2}},? (?:19|20)\d\d|\d{{1,2}} (?:{_MONTH})\.?,? (?:19|20)\d\d)(?!\d)",
    "slashdate": r"(?<![\d/])\d{1,2}/\d{1,2}/(?:19|20)\d\d(?![\d/])",
    "ip": r"(?<![\dvV])(?<!\d\.)(?<!ersion )\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)",
    "ssn": r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{4,5})(?!\d)",
    "card 19": r"(?<!\d)(?:\d{4}[ -]){4}\d{1,3}(?!\d)",
    "phone": r"(?<![\w+])(?:(?:\+1[ .-]?)?\([2-9]\d\d\)[ .-]?[2-9]\d\d[ .-]?\d{4}|\+1[ .-]?[2-9]\d\d[ .-]?[2-9]\d\d[ .-]?\d{4}|\+\d{8,15}|\d{3}(?P<s>[ .-])\d{3}(?P=s)\d{4})(?!\w)",
}
#: Forms of blocks that the next number may look like a part of: each end of a block is tried, the last first.
_LOOSE = {
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?",
    "card": r"(?<!\d)\d(?:[ -]?\d){12,18}",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?)?\d{1,12}|\(\d{2,5}\)[ .-]?\d{2,12})(?:[ .-]\d{2,12}){0,7}",
}
_STRICT_FORMS = [(name.split()[0], re.compile(form, re.ASCII)) for name, form in _STRICT.items()]
_LOOSE_FORMS = [(kind, re.compile(form, re.ASCII)) for kind, form in _LOOSE.items()]
_FOUND = re.compile("|".join([*_STRICT.values(), *_LOOSE.values()]), re.ASCII)
_RUN = re.compile("[A-Za-z0-9]+")
_STEP = re.compile(r"[+(]*\d+|.", re.ASCII | re.DOTALL)
#: Characters of the shortest IBAN in use.
_LEAST_IBAN = 15


class Pseudonyms:
    """The permutations of one key."""

    def __init__(self, key: bytes):
        self.key = blake2b(key, digest_size=32).digest()

    def permuted(self, value: int, size: int, kind: str, back: bool = False) -> int:
        """A keyed permutation of range(size): a Feistel network on the next even number of bits, walked
        along its cycle until the value is in range again."""
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        mask = (1 << half) - 1
        width = (half + 7) // 8
        tweak = f"{kind}:{size}".encode()
        while True:
            left, right = value >> half, value & mask
            for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
                word = (left if back else right).to_bytes(width, "little")
                f = int.from_bytes(blake2b(word + bytes([r]) + tweak, digest_size=min(64, width + 8), key=self.key).digest(), "little") & mask
                left, right = (right ^ f, left) if back else (right, left ^ f)
            value = left << half | right
            if value < size:
                return value

    def characters(self, text: str, kind: str, back: bool = False) -> str:
        """Letters and digits permuted as one number with a place for each; case and all else stay."""
        places = [(i, 10 if c.isdigit() else 26) for i, c in enumerate(text) if c.isascii() and c.isalnum()]
        value, size = 0, 1
        for i, base in places:
            value = value * base + (int(text[i]) if base == 10 else ord(text[i].lower()) - 97)
            size *= base
        value = self.permuted(value, size, kind, back)
        out = [*text]
        for i, base in reversed(places):
            value, digit = divmod(value, base)
            out[i] = str(digit) if base == 10 else chr(digit + (65 if text[i].isupper() else 97))
        return "".join(out)

    def pseudonym(self, kind: str, text: str, back: bool = False) -> str | None:
        """The value's pseudonym, or None if it isn't valid; back undoes it."""
        return getattr(self, f"_{kind}")(text, back)

    def _email(self, text: str, back: bool) -> str | None:
        local, _, domain = text.partition("@")
        return f"{self.characters(local, 'email ' + domain.lower(), back)}@{domain}" if any(c.isalnum() for c in local) else None

    def _card(self, text: str, back: bool) -> str | None:
        digits = re.sub("[ -]", "", text)
        if not luhn(digits):
            return None
        body = self._digits(digits[:-1], "card", back)
        check = next(str(c) for c in range(10) if luhn(body + str(c)))
        return _placed(text, body + check)

    def _digits(self, digits: str, kind: str, back: bool) -> str:
        return str(self.permuted(int(digits), 10 ** len(digits), kind, back)).zfill(len(digits))

    def _phone(self, text: str, back: bool) -> str | None:
        digits = re.sub(r"\D", "", text)
        plus = re.match(r"\+(\d{1,3})(?=[ .(-])", text)
        if not 8 <= len(digits) <= 15 or not (text.startswith("+") or "(" in text or re.fullmatch(r"\d{3}([ .-])\d{3}\1\d{4}", text)):
            return None
        lead = len(plus[1]) if plus else 2 if text.startswith("+") else 0
        return _placed(text, digits[:lead] + self._digits(digits[lead:], f"phone {digits[:lead]}", back))

    def _ssn(self, text: str, back: bool) -> str | None:
        area, group, serial = map(int, text.split("-"))
        areas = 899 - 1
        if not 0 < area < 900 or area == 666 or not group or not serial:
            return None
        value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        value, serial = divmod(self.permuted(value, areas * 99 * 9999, "ssn", back), 9999)
        area, group = divmod(value, 99)
        area += 1 + (area >= 665)
        return f"{area:03}-{group + 1:02}-{serial + 1:04}"

    def _ip(self, text: str, back: bool) -> str | None:
        parts = [*map(int, text.split("."))]
        if max(parts) > 255:
            return None
        value = self.permuted(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip", back)
        return ".".join(map(str, value.to_bytes(4, "big")))

    def _iban(self, text: str, back: bool) -> str | None:
        plain = text.replace(" ", "")
        if _mod97(plain[4:] + plain[:4]) != 1:
            return None
        body = self.characters(plain[4:], f"iban {plain[:2]}", back)
        check = 98 - _mod97(body + plain[:2] + "00")
        return _placed(text, f"{plain[:2]}{check:02}{body}")

    def _day(self, year: int, month: int, day: int, back: bool, fits=lambda d: True) -> datetime.date | None:
        """The day's pseudonym among the days that fit a form: where others come, the walk goes on."""
        try:
            n = datetime.date(year, month, day).toordinal() - _FIRST_DAY
        except ValueError:
            return None
        while True:
            n = self.permuted(n, _LAST_DAY - _FIRST_DAY + 1, "date", back)
            if fits(d := datetime.date.fromordinal(_FIRST_DAY + n)):
                return d

    def _isodate(self, text: str, back: bool) -> str | None:
        d = self._day(*map(int, text.split("-")), back)
        return d and d.isoformat()

    def _fields(self, text: str, order: str, back: bool, fits=lambda d: True) -> str | None:
        """A date of number fields, in their order of y, m and d; a field of one digit stays one."""
        fields = re.findall(r"\d+", text)
        width = dict(zip(order, map(len, fields), strict=True))
        value = dict(zip(order, map(int, fields), strict=True))
        d = self._day(value["y"], value["m"], value["d"], back, lambda d: (width["d"] > 1 or d.day < 10) and (width["m"] > 1 or d.month < 10) and fits(d))
        if d is None:
            return None
        new = {"y": f"{d.year}", "m": f"{d.month:0{width['m']}}", "d": f"{d.day:0{width['d']}}"}
        return _placed(text, "".join(new[f] for f in order))

    def _dotdate(self, text: str, back: bool) -> str | None:
        return self._fields(text, "dmy", back)

    def _ymddate(self, text: str, back: bool) -> str | None:
        return self._fields(text, "ymd", back)

    def _slashdate(self, text: str, back: bool) -> str | None:
        """Month first, or day first where the first number can't be a month."""
        if int(text.split("/")[0]) > 12:
            return self._fields(text, "dmy", back, lambda d: d.day > 12)
        return self._fields(text, "mdy", back)

    def _namedate(self, text: str, back: bool) -> str | None:
        """With the month's name, short or whole; May counts as short."""
        name = re.search("[A-Za-z]+", text)[0]
        short = len(name) == 3
        month = next(i for i, m in enumerate(MONTHS, 1) if m[: len(name)] == name)
        day, year = re.findall(r"\d+", text)
        d = self._day(int(year), month, int(day), back, lambda d: (len(day) > 1 or d.day < 10) and (short or d.month != 5))
        if d is None:
            return None
        new = MONTHS[d.month - 1]
        numbers = iter((f"{d.day:0{len(day)}}", f"{d.year}"))
        return re.sub(r"\d+", lambda m: next(numbers), text.replace(name, new[:3] if short else new))

    def replaced(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and (kind, start, end) of each in the original."""
        if not _MAYBE.search(text):
            return text, []
        out, spans, at, done = [], [], 0, 0
        while m := _FOUND.search(text, at):
            found = self._strict(text, m.start()) or self._loose(text, m.start())
            if found is None:  # no valid value begins here: one that begins later in it may be
                at = _STEP.match(text, m.start()).end()
                continue
            kind, end, new = found
            out += [text[done : m.start()], new]
            spans.append((kind, m.start(), end))
            at = done = end
        return "".join([*out, text[done:]]), spans

    def _strict(self, text: str, at: int) -> tuple[str, int, str] | None:
        """(kind, end, pseudonym) of the valid value that begins here in a form that tells its end."""
        for kind, form in _STRICT_FORMS:
            if (m := form.match(text, at)) and (new := self.pseudonym(kind, m[0])) is not None:
                return kind, m.end(), new
        return None

    def _loose(self, text: str, at: int) -> tuple[str, int, str] | None:
        """The same of a value in blocks, up to the last block that keeps it valid. It doesn't end within
        another value, and a card in odd blocks doesn't hold one in usual blocks."""
        for kind, form in _LOOSE_FORMS:
            if not (m := form.match(text, at)):
                continue
            runs = [(at + r.start(), at + r.end()) for r in _RUN.finditer(m[0])]
            inner = None
            for _, end in reversed(runs):
                after = text[end : end + 1]
                if after.isascii() and (after.isdigit() if kind == "card" else after.isalnum() or (kind == "phone" and after == "_")):
                    continue
                value = text[at:end]
                size = sum(map(str.isalnum, value))
                if size < 13 if kind == "card" else kind == "iban" and end < m.end() and size < _LEAST_IBAN:
                    break
                if (new := self.pseudonym(kind, value)) is None:
                    continue
                if inner is None and kind != "iban":
                    inner = [(start, *found[:2]) for start, _ in runs[1:] if (found := self._strict(text, start))]
                if kind == "iban" or not any(start < end and (to > end or kind == what == "card") for start, what, to in inner):
                    return kind, end, new
        return None


def luhn(digits: str) -> bool:
    doubled = [int(c) * 2 for c in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _placed(pattern: str, characters: str) -> str:
    """The characters at the letters and digits of the pattern."""
    rest = iter(characters)
    return "".join(next(rest) if c.isascii() and c.isalnum() else c for c in pattern)


def pseudonymised(docs: DataFrame, key: bytes, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, text, spans array<struct<kind, start, end>>) of every row: its whole text with pseudonyms, and
    where in the original values stood. A null text stays null, with no spans; an empty table gives no rows,
    repeated rows come out repeated, other columns don't matter. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Pseudonyms(key)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for part, texts in text_slices(batches, "text"):
            new, spans = [], []
            for text, valid in zip(texts, part.column("text").is_valid().to_pylist(), strict=True):
                out, found = maker.replaced(text)
                new.append(out if valid else None)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(new, pa.string()), pa.array(spans, kind)], names=[id_col, text_col, "spans"])

    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    fields = f"`{id_col}` {chosen.schema['id'].dataType.simpleString()}, `{text_col}` string, spans array<struct<kind:string,start:int,end:int>>"
    return chosen.mapInArrow(run, fields)
