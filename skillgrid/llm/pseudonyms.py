"""Format-preserving pseudonyms for personal data by a keyed Feistel permutation.

A value that passes its kind's validation (check digits, calendar, number plan, octets) is numbered within
the domain of all valid values of its format, permuted there, and written back in the same format. The
permutation depends on the key, the kind and the domain's size alone, so equal values get equal
pseudonyms in every document, on every executor, without any table of values.
"""

from __future__ import annotations

import re
from datetime import date
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_column, utf8

ROUNDS = 8
# First digits of area and exchange code of which one at least is not of the number plan.
OUTSIDE = [(a, e) for a in "0123456789" for e in "0123456789" if a < "2" or e < "2"]
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


class Permutation:
    """Keyed permutations of 0..size-1: a Feistel network on bits, walked until it is back in the domain."""

    def __init__(self, key: bytes):
        self.key = key

    def _walk(self, value: int, size: int, tweak: bytes, order: range) -> int:
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        mask, width = (1 << half) - 1, (half + 7) // 8
        forward = order.step > 0
        while True:
            left, right = value >> half, value & mask
            for i in order:
                source = right if forward else left
                digest = blake2b(source.to_bytes(width, "big"), key=self.key, person=tweak[:15] + bytes([i]), digest_size=min(64, width + 8)).digest()
                mixed = int.from_bytes(digest, "big") & mask
                left, right = (right, left ^ mixed) if forward else (right ^ mixed, left)
            value = left << half | right
            if value < size:
                return value

    def permuted(self, value: int, size: int, kind: str) -> int:
        """The pseudonym's number: the next one in a keyed cycle of all values, so never the value itself."""
        if size < 2:
            return value
        tweak = blake2b(f"{kind}:{size}".encode(), digest_size=15).digest()
        place = self._walk(value, size, tweak, range(ROUNDS))
        return self._walk((place + 1) % size, size, tweak, range(ROUNDS - 1, -1, -1))


def number(digits: list[tuple[int, int]]) -> tuple[int, int]:
    """Number and domain size of digits with their radixes."""
    value, size = 0, 1
    for d, radix in digits:
        value, size = value * radix + d, size * radix
    return value, size


def digits_of(value: int, radixes: list[int]) -> list[int]:
    out = []
    for radix in reversed(radixes):
        value, d = divmod(value, radix)
        out.append(d)
    return out[::-1]


def luhn_sum(digits: str) -> int:
    """Sum whose last digit is 0 for a valid number."""
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))


def refill(shape: str, characters: str, where=str.isdigit) -> str:
    """``shape`` with its digits (or whatever ``where`` accepts) replaced in order."""
    new = iter(characters)
    return "".join(next(new) if where(c) else c for c in shape)


class Pseudonyms:
    def __init__(self, key: bytes):
        self.permutation = Permutation(key)
        self.replacement = lru_cache(maxsize=1 << 14)(self._replacement)

    def _permute(self, kind: str, digits: list[tuple[int, int]]) -> list[int]:
        value, size = number(digits)
        return digits_of(self.permutation.permuted(value, size, kind), [r for _, r in digits])

    def letters(self, kind: str, text: str) -> str:
        """ASCII letters and digits permuted within their classes, hexadecimal text as such; all else stays."""
        if re.fullmatch(r"(?=.*[a-f])[0-9a-f]{8,}", text):
            return "".join(f"{d:x}" for d in self._permute(kind, [(int(c, 16), 16) for c in text]))
        classes = [next(((a, r) for a, r in (("0", 10), ("a", 26), ("A", 26)) if ord(a) <= ord(c) < ord(a) + r), None) for c in text]
        new = iter(self._permute(kind, [(ord(c) - ord(k[0]), k[1]) for c, k in zip(text, classes) if k]))
        return "".join(chr(ord(k[0]) + next(new)) if k else c for c, k in zip(text, classes))

    def card(self, text: str) -> str | None:
        digits = "".join(c for c in text if c.isdigit())
        if not 13 <= len(digits) <= 19 or digits[0] == "0" or luhn_sum(digits) % 10:
            return None
        body = digits[0] + "".join(map(str, self._permute("card", [(int(d), 10) for d in digits[1:-1]])))
        return refill(text, body + str(-luhn_sum(body + "0") % 10))

    def iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        value = lambda s: int("".join(str(int(c, 36)) for c in s))
        if not 15 <= len(plain) <= 34 or value(plain[4:] + plain[:4]) % 97 != 1:
            return None
        account = self.letters("iban", plain[4:])
        check = 98 - value(account + plain[:2] + "00") % 97
        return refill(text, f"{plain[:2]}{check:02d}{account}", str.isalnum)

    def social(self, text: str) -> str | None:
        area, group, serial = (int(x) for x in text.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        areas = [a for a in range(1, 900) if a != 666]
        a, g, s = self._permute("social", [(areas.index(area), len(areas)), (group - 1, 99), (serial - 1, 9999)])
        return f"{areas[a]:03d}-{g + 1:02d}-{s + 1:04d}"

    def phone(self, text: str) -> str | None:
        digits = "".join(c for c in text if c.isdigit())
        country = re.match(r"\+(1(?=\D)|\d{1,3}(?=\D)|1(?=\d{10}$)|\d{2}(?=\d{7,12}$))", text)
        kept = country[1] if country else ""
        rest = digits[len(kept) :]
        if not 7 <= len(rest) <= 12 or (not country and len(rest) != 10):
            return None
        north = kept in ("", "1") and len(rest) == 10
        if north and (rest[0] < "2" or rest[3] < "2"):
            if text[0] not in "+(":
                return None
            # Written as a phone number though outside the number plan: permuted among all such numbers.
            first, *others = self._permute("phone outside", [(OUTSIDE.index((rest[0], rest[3])), len(OUTSIDE)), *[(int(d), 10) for d in rest[1:3] + rest[4:]]])
            area, exchange = OUTSIDE[first]
            new = [area, *others[:2], exchange, *others[2:]]
            return refill(text, kept + "".join(map(str, new)))
        low = [2 if north and i in (0, 3) else 0 for i in range(len(rest))]
        new = self._permute(f"phone{kept if kept != '1' else ''}", [(int(d) - a, 10 - a) for d, a in zip(rest, low)])
        return refill(text, kept + "".join(str(d + a) for d, a in zip(new, low)))

    def address(self, text: str) -> str | None:
        octets = [int(x) for x in text.split(".")]
        if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
            return None
        return ".".join(map(str, self._permute("address", [(o, 256) for o in octets])))

    def day(self, text: str) -> str | None:
        first, second, third = (int(x) for x in re.findall(r"\d+", text))
        order = [(first, second, third)] if len(re.match(r"\d+", text)[0]) == 4 else [(third, second, first), (third, first, second)]
        for k, (y, m, d) in enumerate(order):
            try:
                number_ = date(y, m, d).toordinal()
            except ValueError:
                continue
            if not FIRST_DAY <= number_ <= LAST_DAY:
                return None
            new = date.fromordinal(FIRST_DAY + self.permutation.permuted(number_ - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "day"))
            if y == first:
                parts = f"{new.year:04d}{new.month:02d}{new.day:02d}"
            elif k == 0:
                parts = f"{new.day:02d}{new.month:02d}{new.year:04d}"
            else:
                parts = f"{new.month:02d}{new.day:02d}{new.year:04d}"
            return refill(text, parts)
        return None

    def email(self, text: str) -> str:
        local, _, domain = text.partition("@")
        return f"{self.letters('email', local)}@{domain}"

    def key(self, text: str) -> str:
        return text[:4] + self.letters("key", text[4:])

    def secret(self, text: str) -> str:
        at = re.search(r"[=:]\s*[\"']?", text).end()
        return text[:at] + self.letters("secret", text[at:])

    def _replacement(self, kind: str, text: str) -> str | None:
        return getattr(self, kind)(text)

    def applied(self, text: str) -> tuple[str, list[str]]:
        """The text with every valid value replaced, and the kinds found, in order."""
        kinds: list[str] = []
        parts, done, at = [], 0, 0
        while m := PATTERN.search(text, at):
            kind, new, at = self._valid(m)
            if new is not None:
                kinds.append(kind)
                parts += [text[done : m.start()], new]
                done = at
        return "".join([*parts, text[done:]]), kinds

    def _valid(self, m: re.Match) -> tuple[str, str | None, int]:
        """Kind, pseudonym (null without a valid value) and where the search goes on.

        A form of any number of groups also takes a number that follows, so the match is tried without its last
        groups too. After a match with no valid value the search goes on behind its first number.
        """
        for kind in ALTERNATIVES[m.lastgroup]:
            cuts = [c.start() for c in re.finditer(r"[ .\-]", m[0])] if kind in GROUPS else []
            for cut in [len(m[0]), *reversed(cuts)]:
                new = self.replacement(kind, m[0][:cut])
                if new is not None:
                    return kind, new, m.start() + cut
        return m.lastgroup, None, re.compile(r"\d+|$").search(m.string, m.start()).end()


# Longer and stricter forms first: a match is tried against the kinds of its form in order.
FORMS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+\-]{0,63}@(?:[A-Za-z0-9\-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "secret": r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?[A-Za-z0-9_+/\-]{8,})",
    "key": r"\bAKIA[0-9A-Z]{16}\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "date": r"(?<![\d./\-])(?:\d{4}(?P<s1>[\-/.])\d{2}(?P=s1)\d{2}|\d{2}(?P<s2>[\-/.])\d{2}(?P=s2)\d{4})(?![\d/\-]|\.\d)",
    "social": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "address": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)",
    "phone": r"(?<![\d+])\+\d{1,3}[ .\-]?\(?\d{2,4}\)?(?:[ .\-]?\d{2,4}){1,3}(?![\d])|(?<!\d)\(\d{3}\) ?\d{3}[ .\-]\d{4}(?!\d)|(?<![\d\-])\d{3}-\d{3}-\d{4}(?![\d\-])",
    "card": r"(?<!\d)\d(?:[ \-]?\d){12,18}(?![\d]|-\d)",
}
GROUPS = ("iban", "phone", "card")  # forms of any number of groups
ALTERNATIVES = {kind: [kind] for kind in FORMS} | {"date": ["day"]}
PATTERN = re.compile("|".join(f"(?P<{kind}>{form})" for kind, form in FORMS.items()))
# Every form has one of these bytes.
NOT_MARKS = bytes(c for c in range(256) if chr(c) not in "0123456789@=:")


RESULT = "struct<text:string,n_found:bigint,kinds:string>"
_RESULT = pa.struct([("text", pa.string()), ("n_found", pa.int64()), ("kinds", pa.string())])


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", result: str = "_pii") -> DataFrame:
    """``docs`` with one more column, a struct of text, n_found and kinds (distinct, sorted, comma-joined).

    The struct's text is null where nothing was found (``text_col`` then stands unchanged), so that clean
    texts do not return from Python. Null and empty texts have nothing; repeated rows are kept. A column that has
    the result's name gives way to it.
    """
    secret = key.encode()
    if not 1 <= len(secret) <= 64:
        raise ValueError("the key must have 1 to 64 bytes")

    def swap(texts: list, pseudonyms: Pseudonyms) -> list[dict]:
        out = []
        for raw in texts:
            new, kinds = None, []
            if raw and raw.translate(None, NOT_MARKS):
                new, kinds = pseudonyms.applied(raw.decode())
            out.append({"text": new if kinds else None, "n_found": len(kinds), "kinds": ",".join(sorted(set(kinds)))})
        return out

    column = arrow_column(swap, RESULT, _RESULT, lambda: Pseudonyms(secret))
    return docs.withColumn(result, column(utf8(text_col)))


def report(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with pseudonyms, n_found, kinds of every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = pseudonymise(rows, key)
    return found.select("doc_id", F.coalesce("_pii.text", "text").alias("text"), "_pii.n_found", "_pii.kinds")
