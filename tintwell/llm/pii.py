"""Personal data replaced by format-preserving pseudonyms.

Found values are validated, then permuted within their own format by a keyed Feistel network, so that the same value has
the same pseudonym in every document, two values never share one, no value is its own, and the key gives the way back.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tintwell.operators.scratch import bounded_batches

ROUNDS = 8


class Permuter:
    """Keyed permutations without fixed points of the numbers below n, for any n of at least 2."""

    def __init__(self, key: bytes):
        self.key = hashlib.sha256(key).digest()

    def _f(self, label: str, k: int, value: int, modulus: int) -> int:
        h = hashlib.blake2b(f"{label}|{k}|{value}".encode(), key=self.key, digest_size=max(16, (modulus.bit_length() + 7) // 8 + 8))
        return int.from_bytes(h.digest(), "big") % modulus

    def _feistel(self, label: str, x: int, a: int, b: int, back: bool) -> int:
        left, right = divmod(x, b)
        for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if k % 2:
                right = (right + sign * self._f(label, k, left, b)) % b
            else:
                left = (left + sign * self._f(label, k, right, a)) % a
        return left * b + right

    def _walk(self, label: str, x: int, n: int, back: bool) -> int:
        """Feistel on a grid of at least n cells, repeated until it is below n again."""
        a = isqrt(n - 1) + 1
        b = -(-n // a)
        x = self._feistel(label, x, a, b, back)
        while x >= n:
            x = self._feistel(label, x, a, b, back)
        return x

    def permute(self, label: str, x: int, n: int, valid: Callable[[int], bool] = lambda _: True, back: bool = False) -> int:
        """The network, one step along a cycle of all n numbers, and the network backwards, until the result is valid."""
        if n < 2:
            return x
        label = f"{label}|{n}"
        for _ in range(n):
            y = self._walk(label, x, n, False)
            x = self._walk(label, (y + (-1 if back else 1)) % n, n, True)
            if valid(x):
                return x
        return x


def luhn_digit(body: str) -> str:
    total = 0
    for k, c in enumerate(reversed(body)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_check(country: str, account: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in account + country + '00')) % 97:02d}"


def _refill(like: str, digits: str) -> str:
    """The digits in the places of the digits of like."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in like)


def _mixed(text: str) -> tuple[int, int]:
    """A text's place among all texts with digits, small and large letters where it has them, and their number."""
    value, size = 0, 1
    for c in text:
        base, zero = _class(c)
        if base > 1:
            value, size = value * base + ord(c) - zero, size * base
    return value, size


def _class(c: str) -> tuple[int, int]:
    return (10, 48) if "0" <= c <= "9" else (26, 97) if "a" <= c <= "z" else (26, 65) if "A" <= c <= "Z" else (1, 0)


def _unmixed(like: str, value: int) -> str:
    out = []
    for c in reversed(like):
        base, zero = _class(c)
        if base > 1:
            value, d = divmod(value, base)
            c = chr(zero + d)
        out.append(c)
    return "".join(reversed(out))


_SMALL = {c: c + 32 for c in range(65, 91)}
FIRST_DAY, DAYS = datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal() - datetime.date(1900, 1, 1).toordinal()

# The forms that are looked for, most specific first.
FORMS = (
    ("email", r"(?<![\w.+%-])[A-Za-z0-9](?:[\w.+%-]*[A-Za-z0-9_])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![\w-])"),
    ("iban", r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    ("ip", r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\w]|\.\d)"),
    ("date", r"(?<![\w/.-])(?:\d{4}-\d{2}-\d{2}(?=T\d{2}:?\d{2})|(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\w/-]|\.\d))"),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    ("card", r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w]|[.-]\d)"),
    ("phone", r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?![\w]|[.-]\d)|(?<!\w)\+\d{8,15}(?!\w)"),
)
_ANY = re.compile("|".join(f"(?P<{name}>{form})" for name, form in FORMS))
_MAYBE = re.compile(r"[0-9@]")
_FORM = {name: re.compile(form) for name, form in FORMS}
_LATER_CARD = re.compile(_FORM["card"].pattern.partition(")")[2])
_FOURS = re.compile(r"\d{4}(?:[ -]\d{4})+(?:[ -]\d{1,3})?")
#: Lengths of IBANs by country, from the registry.
IBAN_SIZES = {c: int(n) for n, cs in {
    "15": "NO", "16": "BE", "18": "DK FI FO GL NL SD FK", "19": "MK SI", "20": "AT BA EE KZ LT LU XK MN", "21": "CH HR LI LV",
    "22": "BG BH CR DE GB GE IE ME RS VA", "23": "AE GI IL IQ OM TL SO", "24": "AD CZ ES MD PK RO SA SE SK TN VG", "25": "LY PT ST",
    "26": "IS TR", "27": "BI DJ FR GR IT MC MR SM", "28": "AL AZ BY CY DO GT HU LB NI PL SV", "29": "BR EG PS QA UA", "30": "JO KW MU YE", "31": "MT SC", "32": "LC", "33": "RU",
}.items() for c in cs.split()}


def _ends(kind: str, m: re.Match[str]) -> Iterator[int]:
    """Where a value that starts with the match may end: at its end, or for cards and IBANs at an earlier group's end."""
    yield m.end()
    if kind not in ("card", "iban"):
        return
    size = IBAN_SIZES.get(m[0][:2]) if kind == "iban" else None
    for cut in reversed([k for k, c in enumerate(m[0]) if c in " -"]):
        n = sum(c.isalnum() for c in m[0][:cut])
        if 13 <= n <= 19 if kind == "card" else n == size or (size is None and n >= 15):
            yield m.start() + cut


class Pseudonymiser:
    """Replaces validated values in texts; what has no valid reading is left as it stands."""

    def __init__(self, key: bytes, memo: int = 100_000):
        self.by, self.memo, self.known = Permuter(key), memo, {}

    def value(self, kind: str, text: str, back: bool = False) -> str | None:
        """The pseudonym of a value, or with back the value of a pseudonym; None if it is not a valid one of its kind."""
        digits = re.sub(r"\D", "", text)
        if kind == "email":  # one value in small and large letters; the pseudonym has the case of what it stands for
            local, _, domain = text.partition("@")
            small = local.translate(_SMALL)
            x, n = _mixed(small)
            new = _unmixed(small, self.by.permute(kind, x, n, back=back))
            return f"{''.join(c.upper() if 'A' <= o <= 'Z' else c for c, o in zip(new, local, strict=True))}@{domain}"
        if kind == "iban":
            packed = text.replace(" ", "")
            country, account = packed[:2], packed[4:]
            if not 11 <= len(account) <= 30 or packed[2:4] != iban_check(country, account):
                return None
            x, n = _mixed(account)
            account = _unmixed(account, self.by.permute(kind, x, n, back=back))
            new = iter(country + iban_check(country, account) + account)
            return "".join(c if c == " " else next(new) for c in text)
        if kind == "ip":
            octets = [int(p) for p in text.split(".")]
            if max(octets) > 255:
                return None
            x = self.by.permute(kind, int.from_bytes(bytes(octets), "big"), 1 << 32, back=back)
            return ".".join(map(str, x.to_bytes(4, "big")))
        if kind == "date":  # one value in all forms; with its day kept beyond 12, or up to it, it can be read in any of them
            for form in ("%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%d.%m.%Y"):
                try:
                    day = datetime.datetime.strptime(text, form).date()
                except ValueError:
                    continue
                x = day.toordinal() - FIRST_DAY
                if 0 <= x < DAYS:
                    like = lambda d: (datetime.date.fromordinal(FIRST_DAY + d).day > 12) == (day.day > 12)  # noqa: B023, E731
                    return datetime.date.fromordinal(FIRST_DAY + self.by.permute(kind, x, DAYS, like, back)).strftime(form)
            return None
        if kind == "ssn":
            good = lambda x: (s := f"{x:09d}")[:3] not in ("000", "666") and s[0] != "9" and s[3:5] != "00" and s[5:] != "0000"
            return _refill(text, f"{self.by.permute(kind, int(digits), 10**9, good, back):09d}") if good(int(digits)) else None
        if kind == "card":
            if luhn_digit(digits[:-1]) != digits[-1]:
                return None
            body = f"{self.by.permute(kind, int(digits[:-1]), 10 ** (len(digits) - 1), back=back):0{len(digits) - 1}d}"
            return _refill(text, body + luhn_digit(body))
        if kind == "phone":
            if not 7 <= len(digits) <= 15:
                return None
            high = 10 ** (len(digits) - 1)
            like = lambda x: (x >= high) == (digits[0] != "0")
            return _refill(text, f"{self.by.permute(kind + '+' * (text[0] == '+'), int(digits), 10 * high, like, back):0{len(digits)}d}")
        raise ValueError(kind)

    def _known(self, kind: str, text: str) -> str | None:
        key = (kind, text)
        if key not in self.known:
            if len(self.known) >= self.memo:
                self.known.clear()
            self.known[key] = self.value(*key)
        return self.known[key]

    def _first(self, kind: str, m: re.Match[str]) -> tuple[int, str] | None:
        """End and pseudonym of the longest valid reading that starts with the match."""
        return next(((e, new) for e in _ends(kind, m) if (new := self._known(kind, m.string[m.start() : e])) is not None), None)

    def _found(self, text: str, at: int, limit: int) -> Iterator[tuple[str, int, int, str]]:
        """(kind, start, end, pseudonym) of each value. Where a match is not valid, its other readings are tried in turn:

        shorter ones of its kind from the same place, for cards those from a later group of it, other kinds from the same
        place, and last any that starts later in it. Numbers in groups of four hold no telephone numbers.
        """
        tried = fours = at  # up to here no card starts, and no telephone number
        while m := _ANY.search(text, at, limit):
            start, kinds = m.start(), list(_FORM)
            at = start + 1
            for kind in kinds[kinds.index(m.lastgroup) :]:
                whole = m if kind == m.lastgroup else _FORM[kind].match(text, start, limit)
                if whole is None or (kind == "phone" and start < fours) or (kind == "card" and start < tried):
                    continue
                begin, found = start, self._first(kind, whole)
                if kind == "card" and found is None:
                    for border in re.finditer("[ -]", whole[0]):
                        begin = start + border.end()
                        later = _LATER_CARD.match(text, begin, limit)
                        if begin >= tried and later and (found := self._first(kind, later)):
                            yield from self._found(text, start, begin - 1)
                            break
                    else:
                        tried = whole.end()
                        if _FOURS.fullmatch(whole[0]):
                            fours = whole.end()
                if found:
                    at = found[0]
                    yield kind, begin, *found
                    break

    def text(self, text: str | None) -> tuple[str | None, list[tuple[str, int, int]]]:
        """The text with every value replaced, and (kind, start, end) of each value in it; lengths can change for addresses."""
        if not text or not _MAYBE.search(text):
            return text, []
        out, spans, at, shift = [], [], 0, 0
        for kind, start, end, new in self._found(text, 0, len(text)):
            out += [text[at:start], new]
            spans.append((kind, start + shift, start + shift + len(new)))
            at, shift = end, shift + len(new) - (end - start)
        return ("".join(out) + text[at:], spans) if spans else (text, [])


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """All columns of docs with the text replaced and pii, an array of (kind, start, end) in the new text, added.

    Looks for e-mail and IPv4 addresses, IBANs (mod 97), card numbers (Luhn), US social security numbers, telephone
    numbers and dates from 1900 to 2099, in whole texts. Documents without any come back unchanged; a null text stays
    null. Equal values have one pseudonym however they are spelt: dates in all forms, addresses in small and large letters,
    numbers with whatever stands between their digits. Dates with slashes are read month first where that is possible. A column of docs named pii is replaced. Rows
    stay where they are; nothing is shuffled.
    """
    docs = docs.drop(*(c for c in docs.columns if c.lower() == "pii"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Pseudonymiser(key)
        spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            done = [by.text(t.as_py()) for t in batch.column(at)]
            columns = list(batch.columns)
            columns[at] = pa.array([t for t, _ in done], pa.string())
            columns.append(pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for _, s in done], spans))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "pii"])

    span = StructType().add("kind", StringType()).add("start", IntegerType()).add("end", IntegerType())
    return bounded_batches(docs).mapInArrow(run, StructType([*docs.schema.fields, StructField("pii", ArrayType(span))]))
