"""Personal data and secrets, replaced by pseudonyms of the same format.

A value is found by its pattern, validated (check digits, ranges, the calendar), brought to one canonical form, and sent
through a keyed Feistel network over exactly the values of that form: a permutation, so equal values get equal pseudonyms in
every document, whatever their separators, and different values different ones. The pseudonym is validated like the value (a
result that isn't valid is permuted again) and written with the value's own separators. Nothing but the key is shared between
rows, so every row is by itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches, small_batches

ROUNDS = 10
KEY = b"public demonstration key"
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
HEX = DIGITS + "abcdef"
#: Dates from and to which the permutation runs; other dates stay.
FIRST, LAST = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


def feistel(value: int, left: int, right: int, key: bytes, kind: str) -> int:
    """A keyed permutation of the numbers below left * right: the halves take turns at being shifted by a hash of the other."""
    a, b = divmod(value, right)
    size = max(left, right).bit_length() // 8 + 9
    for i in range(ROUNDS):
        other = b if i % 2 == 0 else a
        mixed = int.from_bytes(hashlib.shake_256(b"%b|%b|%d|%d|%d|%d" % (key, kind.encode(), left, right, i, other)).digest(size), "big")
        if i % 2 == 0:
            a = (a + mixed) % left
        else:
            b = (b + mixed) % right
    return a * right + b


def permuted(value: int, left: int, right: int, key: bytes, kind: str, valid: Callable[[int], bool] = lambda x: True) -> int:
    """The next valid number on the permutation's cycle: a permutation of the valid numbers."""
    value = feistel(value, left, right, key, kind)
    while not valid(value):
        value = feistel(value, left, right, key, kind)
    return value


def digits(text: str, n: int, key: bytes, kind: str, valid: Callable[[str], bool] = lambda x: True) -> str:
    half = n // 2
    return str(permuted(int(text), 10 ** (n - half), 10**half, key, kind, lambda x: valid(str(x).zfill(n)))).zfill(n)


def written(form: str, new: str) -> str:
    """The digits of ``form`` replaced by those of ``new``."""
    it = iter(new)
    return "".join(next(it) if c.isdigit() else c for c in form)


def alphabets(text: str) -> list[str]:
    """For each character the characters it may become: hexadecimal ones if all are, else those of its class."""
    for own in (DIGITS, HEX, HEX.upper()):
        if all(c in own for c in text):
            return [own] * len(text)
    return [DIGITS if c in DIGITS else LOWER if c in LOWER else LOWER.upper() if c in LOWER.upper() else c for c in text]


def characters(text: str, key: bytes, kind: str, own: list[str] | None = None) -> str:
    """Letters and digits permuted within their classes; marks stay."""
    own = own or alphabets(text)
    half, sides = len(text) // 2, [1, 1]
    value = 0
    for i, (c, alphabet) in enumerate(zip(text, own)):
        sides[i >= half] *= len(alphabet)
        value = value * len(alphabet) + alphabet.index(c)
    value = feistel(value, sides[0], sides[1], key, f"{kind} {len(text)}") if value or sides != [1, 1] else 0
    result = []
    for alphabet in reversed(own):
        value, i = divmod(value, len(alphabet))
        result.append(alphabet[i])
    return "".join(reversed(result))


def luhn(number: str) -> int:
    """The check digit that makes a number's Luhn sum a multiple of ten."""
    total = sum(int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(number)))
    return -total % 10


def card(text: str, key: bytes) -> str | None:
    number = "".join(c for c in text if c.isdigit())
    if luhn(number[:-1]) != int(number[-1]) or len(set(number)) == 1:
        return None
    body = digits(number[:-1], len(number) - 1, key, f"card {len(number)}")
    return written(text, body + str(luhn(body)))


def phone(text: str, key: bytes) -> str | None:
    number = "".join(c for c in text if c.isdigit())
    own = min(10, len(number))  # a country's code stays
    national = number[-own:]

    def real(n: str) -> bool:
        return own < 10 or (n[0] not in "01" and n[3] not in "01")

    # Numbers that no exchange could have look like a phone number all the same: they are permuted among themselves.
    return written(text, number[:-own] + digits(national, own, key, f"phone {own}", lambda n: real(n) == real(national)))


def social(text: str, key: bytes) -> str | None:
    number = text.replace("-", "").replace(" ", "")

    def valid(n: str) -> bool:
        return n[:3] not in ("000", "666") and n[0] != "9" and n[3:5] != "00" and n[5:] != "0000"

    return written(text, digits(number, 9, key, "social", valid)) if valid(number) else None


def address(text: str, key: bytes) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255 or not 0 < parts[0] < 224:
        return None
    value = permuted(int.from_bytes(bytes(parts), "big"), 1 << 16, 1 << 16, key, "address", lambda x: 0 < x >> 24 < 224)
    return ".".join(map(str, value.to_bytes(4, "big")))


def day(text: str, key: bytes) -> str | None:
    a, mark, b, c = re.fullmatch(r"(\d+)([-/.])(\d+)[-/.](\d+)", text).groups()
    order = (0, 1, 2) if len(a) == 4 else (2, 1, 0)  # year, month, day by place
    parts = [int(a), int(b), int(c)]
    year, month, of = (parts[i] for i in order)
    if month > 12 >= of and len(a) < 4:  # month first
        order = (2, 0, 1)
        year, month, of = (parts[i] for i in order)
    try:
        value = date(year, month, of).toordinal() - FIRST
    except ValueError:
        return None
    span = LAST - FIRST + 1
    if not 0 <= value < span:
        return None
    side = int(span**0.5) + 1
    # A day up to 12 could be read as a month: such dates are permuted among themselves, so that the reading stays the same.
    loose = of <= 12

    def valid(x: int) -> bool:
        return x < span and (date.fromordinal(FIRST + x).day <= 12) == loose

    new = date.fromordinal(FIRST + permuted(value, side, side, key, "day", valid))
    shown = dict(zip(order, (new.year, new.month, new.day)))
    return mark.join(str(shown[i]).zfill(len(x)) for i, x in enumerate((a, b, c)))


def mail(text: str, key: bytes) -> str:
    name, _, host = text.partition("@")
    return f"{characters(name.lower(), key, 'mail ' + host.lower())}@{host}"


def cloud_key(text: str, key: bytes) -> str:
    return text[:4] + characters(text[4:], key, "cloud key", [LOWER.upper() + DIGITS] * (len(text) - 4))


def secret(text: str, key: bytes) -> str:
    head, value = re.fullmatch(r"(.*[=:]\s*[\"']?)([^\s\"'=:]+)", text, re.S).groups()
    return head + characters(value, key, "secret")


#: Kinds with their patterns, tried in this order at each place, and what makes a pseudonym of a find (None: not valid).
KINDS: dict[str, tuple[str, Callable[[str, bytes], str | None]]] = {
    "mail": (r"(?<![\w.+-])[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", mail),
    "cloud_key": (r"(?<![A-Za-z0-9])A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])", cloud_key),
    "secret": (r"(?i:password|passwd|pwd|token|secret|api[_-]?key)[\"']?\s*[=:]\s*[\"']?[A-Za-z0-9_+/.~-]{8,}", secret),
    "date": (r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}-\d{1,2}-\d{4})(?![\w/-]|\.\d)", day),
    "address": (r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)", address),
    "social": (r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", social),
    "phone": (r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])|(?<![\w+])\+\d{8,15}(?!\w)|(?<![\w+])\+\d{1,3}(?:[ .-]\d{2,5}){2,5}(?![\w-])", phone),
    "card": (r"(?<![\w-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,4})?|\d{4}[ -]\d{6}[ -]\d{4,5})(?![\w-])", card),
}
SIGNS = (*DIGITS, "@", "=", "assw", "ASSW", "ecret", "ECRET", "oken", "OKEN", "pwd", "PWD")


class Masker:
    def __init__(self, key: bytes):
        self.key = key
        self.find = re.compile("|".join(f"(?P<{k}>{p})" for k, (p, _) in KINDS.items()))

    def mask(self, text: str | None) -> tuple[str | None, list[dict]]:
        if not text or not any(s in text for s in SIGNS):
            return text, []
        found, parts, at, shift = [], [], 0, 0
        for m in self.find.finditer(text):
            new = KINDS[m.lastgroup][1](m.group(), self.key)
            if new is None:
                continue
            parts += [text[at : m.start()], new]
            found.append({"kind": m.lastgroup, "start": m.start() + shift, "length": len(new)})
            shift += len(new) - (m.end() - m.start())
            at = m.end()
        return "".join(parts) + text[at:] if found else text, found


def pseudonyms(df: DataFrame, key: bytes = KEY, text: str = "text") -> DataFrame:
    """The frame with ``text`` masked, and pii_found (kind, start and length of each pseudonym in the new text) instead of such a column.

    Whole texts are read; null and empty texts stay as they are; values that aren't valid for their kind stay. The other
    columns and repeated rows stay. Whoever has the key can undo it; pass your own.
    """
    small_batches(df.sparkSession)
    names = [c for c in df.columns if c != "pii_found"]
    source = df.select(*[F.col(f"`{c}`").cast("string").alias(c) if c == text else F.col(f"`{c}`") for c in names])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))
    at = names.index(text)

    def run(parts):
        masker = Masker(key)
        for b in batches(parts):
            done = [masker.mask(x) for x in b.column(at).to_pylist()]
            columns = list(b.columns)
            columns[at] = pa.array([x for x, _ in done], pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array([f for _, f in done], kind)], names=[*names, "pii_found"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(run, f"{fields}, pii_found array<struct<kind: string, start: int, length: int>>")
