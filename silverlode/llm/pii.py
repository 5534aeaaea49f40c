"""Format-preserving pseudonyms for personal data: equal values get equal pseudonyms of the same form.

Numbers that pass their check (card numbers, IBANs, phone numbers, IPv4 addresses) and dates that exist are permuted by a
keyed Feistel network over exactly the values of their form; e-mail names, and keys assigned to words such as ``token``,
are permuted character class by character class.  A permutation never maps two values to one, so links across documents
survive, nothing is stored, and the holder of the key can turn pseudonyms back (``reveal``).

card    13-19 digits, spaces or hyphens allowed, Luhn sum 0: all digits but the last are permuted, the last is recomputed.
        Runs of 13-19 digits that fail the check are permuted whole (kind ``number``), as they may be mistyped numbers.
iban    country and 11-30 characters, remainder 1 modulo 97: digits permuted, check digits recomputed.
phone   + country code and 7-14 further digits, or (ddd) ddd-dddd: all digits after the country code.
ip      four octets: the 32-bit number.
date    a day of 1800-2199 as y-m-d, d.m.y or d/m/y: the day's number among these; the form is kept.
email   letters and digits of the name before @, however long; the domain stays.
secret  a value of 16 or more letters and digits, however long, assigned to token, key, secret or password.

Values of over SEGMENT characters are permuted segment by segment, each under a key of what stands before it, so that work
grows with their length; they are equal up to where the values first differ, to a whole segment.

Results: a very long text is read whole, a very long value permuted whole; null stays null, empty stays empty; a value that its permutation happens to leave as it is stays;
overlaps go to the earliest, then to the first kind listed; repeated rows are treated alike; an empty table stays empty.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from silverlode.llm.common import per_slice, record_batch, texts_of

KINDS = ("email", "secret", "iban", "ip", "date", "phone", "card", "number")
ROUNDS = 10
#: Characters of a value that are permuted as one number.
SEGMENT = 128
DAY0, DAYS = datetime.date(1800, 1, 1).toordinal(), datetime.date(2200, 1, 1).toordinal() - datetime.date(1800, 1, 1).toordinal()

_PATTERN = re.compile(
    r"(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}\b)"
    r"|(?P<secret>(?i:\b(?:token|secret|password|passwd|api[_-]?key|key)\b[\"']?\s{0,3}[=:]\s{0,3}[\"']?)(?P<value>[A-Za-z0-9_+/-]{16,}))"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ip>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d))"
    r"|(?P<date>(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{2}([./])\d{2}\9\d{4})(?![\d/-]|\.\d))"
    r"|(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)|\(\d{3}\) ?\d{3}-\d{4}(?!\d))"
    r"|(?P<card>(?<![\d.])\d(?:[ -]?\d){12,18}(?![\d]))".replace(r"\9", r"(?P=sep)").replace("([./])", "(?P<sep>[./])")
)
_GATE = re.compile(r"[@\d]|(?i:token|secret|passw|key)")


class Permutation:
    """Keyed permutations of 0 .. n-1: a Feistel network over two nearly equal halves, repeated until it lands below n."""

    def __init__(self, key: bytes):
        if not key:
            raise ValueError("a pseudonym key is needed")
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, kind: str, n: int, i: int, half: int, base: int) -> int:
        message = f"{kind}|{n}|{i}|{half}".encode()
        digest = hashlib.blake2b(message, key=self.key, digest_size=max(16, (base.bit_length() + 7) // 8 + 8)).digest()
        return int.from_bytes(digest, "big") % base

    def _network(self, kind: str, n: int, x: int, back: bool) -> int:
        b = 1 << (((n - 1).bit_length() + 1) // 2)  # the smallest power of two whose square is at least n
        left, right = divmod(x, b)
        steps = range(ROUNDS)
        for i in reversed(steps) if back else steps:
            if back:
                left, right = (right - self._round(kind, n, i, left, b)) % b, left
            else:
                left, right = right, (left + self._round(kind, n, i, right, b)) % b
        return left * b + right

    def apply(self, kind: str, n: int, x: int, back: bool = False) -> int:
        """The place of ``x``; ``back`` undoes it."""
        if n < 2:
            return x
        while True:
            x = self._network(kind, n, x, back)
            if x < n:
                return x


def luhn_digit(digits: str) -> str:
    """The digit that makes ``digits`` and it a valid number."""
    total = sum(sum(divmod(2 * int(d), 10)) if k % 2 == 0 else int(d) for k, d in enumerate(reversed(digits)))
    return str(-total % 10)


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _refill(form: str, chars: str, wanted: Callable[[str], bool]) -> str:
    it = iter(chars)
    return "".join(next(it) if wanted(c) else c for c in form)


def _digits(p: Permutation, kind: str, digits: str, back: bool) -> str:
    return str(p.apply(kind, 10 ** len(digits), int(digits), back)).zfill(len(digits)) if digits else ""


def _classes(p: Permutation, kind: str, text: str, back: bool) -> str:
    """Digits, small and capital letters are each permuted among their kind; segments depend on all that precede them."""
    out, before = [], kind
    for a in range(0, len(text), SEGMENT):
        part = text[a : a + SEGMENT]
        new = _segment(p, before, part, back)
        out.append(new)
        before = f"{kind}|{hashlib.blake2b((before + (new if back else part)).encode(), digest_size=16).hexdigest()}"
    return "".join(out)


def _segment(p: Permutation, kind: str, text: str, back: bool) -> str:
    """The characters of ``text`` together as one mixed-radix number, permuted."""
    sizes = [10 if c.isdigit() else 26 if c.isalpha() else 1 for c in text]
    starts = ["0" if c.isdigit() else "a" if c.islower() else "A" if c.isalpha() else c for c in text]
    n, x = 1, 0
    for c, size, start in zip(text, sizes, starts):
        n, x = n * size, x * size + ord(c) - ord(start)
    x = p.apply(f"{kind}|{''.join(starts)}", n, x, back)
    out = []
    for size, start in zip(reversed(sizes), reversed(starts)):
        x, place = divmod(x, size)
        out.append(chr(ord(start) + place))
    return "".join(reversed(out))


def _date_parts(text: str) -> tuple[str, datetime.date] | None:
    iso = text[4] == "-"
    form = "%Y-%m-%d" if iso else f"%d{text[2]}%m{text[2]}%Y"
    try:
        return form, datetime.datetime.strptime(text, form).date()
    except ValueError:
        return None


def _once(p: Permutation, kind: str, value: str, back: bool) -> str | None:
    """``value`` permuted within its form, or None if it is none of that kind."""
    digits = "".join(c for c in value if c.isdigit())
    if kind == "email":
        name, _, domain = value.partition("@")
        return _classes(p, kind, name, back) + "@" + domain
    if kind == "secret":
        return _classes(p, kind, value, back)
    if kind == "iban":
        plain = value.replace(" ", "")
        if not 15 <= len(plain) <= 34 or _mod97(plain) != 1:
            return None
        account = _classes(p, "iban" + plain[:2], plain[4:], back)
        check = f"{98 - _mod97(plain[:2] + '00' + account):02d}"
        return _refill(value, plain[:2] + check + account, lambda c: c != " ")
    if kind == "ip":
        octets = [int(o) for o in value.split(".")]
        if max(octets) > 255 or any(len(o) > 1 and o[0] == "0" for o in value.split(".")):
            return None
        x = p.apply(kind, 1 << 32, int.from_bytes(bytes(octets), "big"), back)
        return ".".join(map(str, x.to_bytes(4, "big")))
    if kind == "date":
        found = _date_parts(value)
        if not found or not 0 <= (day := found[1].toordinal() - DAY0) < DAYS:
            return None
        return datetime.date.fromordinal(DAY0 + p.apply(kind, DAYS, day, back)).strftime(found[0])
    if kind == "phone":
        head = re.match(r"\+\d{1,3}(?=[ .(-])|\+\d|", value).group()
        rest = value[len(head) :]
        inner = "".join(c for c in rest if c.isdigit())
        if not 7 <= len(inner) <= 14:
            return None
        return head + _refill(rest, _digits(p, kind, inner, back), str.isdigit)
    if kind == "card" and luhn_digit(digits[:-1]) == digits[-1]:
        body = _digits(p, kind, digits[:-1], back)
        return _refill(value, body + luhn_digit(body), str.isdigit)
    if kind == "number" and luhn_digit(digits[:-1]) != digits[-1]:
        # the last digit is permuted among the nine that fail the check, so that a failed number stays one
        off = (int(digits[-1]) - int(luhn_digit(digits[:-1]))) % 10 - 1
        x = p.apply(kind, 9 * 10 ** (len(digits) - 1), int(digits[:-1]) * 9 + off, back)
        body, off = divmod(x, 9)
        body = str(body).zfill(len(digits) - 1)
        return _refill(value, body + str((int(luhn_digit(body)) + off + 1) % 10), str.isdigit)
    return None


def pseudonym(p: Permutation, kind: str, value: str, back: bool = False) -> str | None:
    """The pseudonym of ``value``; a fixed point of the permutation stays (its chance is one in the number of values)."""
    return _once(p, kind, value, back)


def _replaced(p: Permutation, text: str, back: bool, counts: dict[str, int], known: dict) -> str:
    def swap(m: re.Match) -> str:
        kind = m.lastgroup if m.lastgroup in KINDS else next(k for k in KINDS if k != "number" and m.group(k) is not None)
        whole, value = m.group(), m.group("value") if kind == "secret" else m.group()
        for k in (kind, "number") if kind == "card" else (kind,):
            new = known.get((k, value))
            if new is None:
                new = pseudonym(p, k, value, back)
            if new is not None:
                if len(known) < 50_000:
                    known[(k, value)] = new
                counts[k] += 1
                return whole[: len(whole) - len(value)] + new
        return whole

    return _PATTERN.sub(swap, text)


def pseudonymise(text: str | None, key: bytes, back: bool = False) -> tuple[str | None, dict[str, int]]:
    """``text`` with its personal data replaced, and how many of each kind; ``back`` turns pseudonyms into values."""
    counts = dict.fromkeys(KINDS, 0)
    if text and _GATE.search(text):
        text = _replaced(Permutation(key), text, back, counts, {})
    return text, counts


def private(docs: DataFrame, key: bytes, text: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and the number of each kind in ``n_<kind>``; ``back`` reveals the values."""
    counted = [f"n_{k}" for k in KINDS]
    keep = [f for f in docs.schema if f.name not in counted]
    schema = T.StructType([*[T.StructField(f.name, T.StringType()) if f.name == text else f for f in keep], *[T.StructField(n, T.LongType()) for n in counted]])

    def run(batches):
        p, known = Permutation(key), {}

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            new, found = [], []
            for t in texts_of(batch, text):
                counts = dict.fromkeys(KINDS, 0)
                new.append(_replaced(p, t, back, counts, known) if t and _GATE.search(t) else t)
                found.append(counts)
            columns = [new if f.name == text else batch.column(batch.schema.get_field_index(f.name)) for f in keep]
            return record_batch(schema, [*columns, *[[c[k] for c in found] for k in KINDS]])

        yield from per_slice(text, work)(batches)

    return docs.mapInArrow(run, schema)


def reveal(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    return private(docs, key, text, back=True)
