"""Personal data replaced by format-preserving pseudonyms from keyed Feistel permutations.

Candidates are found by patterns and validated (Luhn sums of card numbers, real
calendar days, octets of addresses, assignable social security numbers, check
digits of bank accounts). Each valid value is a number in its kind's domain, and a
keyed Feistel network with cycle walking permutes that domain. So a pseudonym has
the format of its value, is valid itself, differs between keys, and is equal for
equal values, wherever they stand: records stay linked across documents. A day is
the same number in any of its formats.

The values of a document are found by patterns; where candidates overlap, the
leftmost valid one counts, and of those that begin together the first kind of KINDS,
at its longest valid end. Equal text before and after is kept byte by byte.

Defined results: null text stays null and empty text empty, without values;
invalid candidates stay as they are, and the search goes on at shorter ends, with
the other kinds, and then one character further;
repeated rows get equal results; a null id is treated like any other; columns
beside doc_id and text are passed on untouched; texts are searched whole.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vigil.llm.common import table

#: The key of tests and of the registered query; a real run passes its own.
DEMO_KEY = "pseudonyms-1"
ROUNDS = 8
KINDS = ("email", "card", "iban", "ssn", "phone", "ip", "date")
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

PATTERN = re.compile(
    r"""(?P<card>(?<![\w+.-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-]))
    |(?P<iban>\b[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?\b)
    |(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))
    |(?P<phone>(?<![\w.-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-]?[0-9]{4}(?![\w-])|(?<![\w.-])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![\w-]))
    |(?P<ip>(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\w]|\.[0-9]))
    |(?P<date>(?<![\w/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![\w/-]))""",
    re.VERBOSE | re.ASCII,
)
SIGN = re.compile(r"[0-9@]")
#: An address from its sign on, and the characters before it. Searched from the sign back to the sign before, so that no run
#: is read anew from each of its characters. A long local part is permuted in pieces of PIECE characters.
DOMAIN, LOCAL_START = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}\b", re.ASCII), re.compile(r"\b[A-Za-z0-9]", re.ASCII)
LOCAL, PIECE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"), 64
#: The pattern of each kind alone, for what else may begin where a candidate failed.
ALONE = {k: re.compile(part, re.VERBOSE | re.ASCII) for k, part in zip(KINDS[1:], re.split(r"\n    \|(?=\(\?P<)", PATTERN.pattern), strict=True)}
#: Kinds whose runs may take in what follows the value, each with what may follow a shorter end.
RUNS = {"card": re.compile(r"(?![\w-])", re.ASCII), "iban": re.compile(r"(?!\w)", re.ASCII), "phone": re.compile(r"(?![\w-])", re.ASCII)}


class Feistel:
    """Keyed permutations of the numbers below any size."""

    def __init__(self, key: str) -> None:
        self.key = hashlib.sha256(key.encode()).digest()

    def round(self, kind: str, size: int, number: int, half: int) -> int:
        said = f"{kind}:{size}:{number}:{half}".encode()
        return int.from_bytes(hashlib.blake2b(said, key=self.key, digest_size=32).digest(), "big")

    def permuted(self, kind: str, size: int, value: int) -> int:
        """value, below size, by halves of two radices whose product is size or a little more; results beyond walk on."""
        if size < 2:
            return value
        a = isqrt(size - 1) + 1
        b = -(-size // a)
        while True:
            left, right = divmod(value, b)
            for k in range(0, ROUNDS, 2):
                left = (left + self.round(kind, size, k, right)) % a
                right = (right + self.round(kind, size, k + 1, left)) % b
            value = left * b + right
            if value < size:
                return value


def luhn_digit(payload: str) -> str:
    """The check digit that makes a number's Luhn sum 0."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (1 + (i % 2 == 0))
        total += d - 9 * (d > 9)
    return str(-total % 10)


def refilled(shape: str, characters: str, where: Callable[[str], bool]) -> str:
    """shape with the characters in the places for which where holds."""
    fresh = iter(characters)
    return "".join(next(fresh) if where(c) else c for c in shape)


def card(value: str, f: Feistel) -> str | None:
    digits = re.sub(r"[^0-9]", "", value)
    if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    payload = str(f.permuted("card", 10 ** (len(digits) - 1), int(digits[:-1]))).zfill(len(digits) - 1)
    return refilled(value, payload + luhn_digit(payload), str.isdigit)


def iban_check(country: str, account: str) -> str:
    return str(98 - int("".join(str(int(c, 36)) for c in account + country + "00")) % 97).zfill(2)


def iban(value: str, f: Feistel) -> str | None:
    plain = value.replace(" ", "")
    country, check, account = plain[:2], plain[2:4], plain[4:]
    if iban_check(country, account) != check:
        return None
    fresh = letters_and_digits("iban", account, f)
    return refilled(value, country + iban_check(country, fresh) + fresh, lambda c: c != " ")


def ssn(value: str, f: Feistel) -> str | None:
    area, group, serial = map(int, value.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    number = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    rest, serial = divmod(f.permuted("ssn", 898 * 99 * 9999, number), 9999)
    area, group = divmod(rest, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def phone(value: str, f: Feistel) -> str | None:
    """The country's code stays; equal digits are one number, however they are set apart."""
    code = re.match(r"\+[0-9]{1,3}(?![0-9])", value)
    kept = code[0] if code else ""
    rest = value[len(kept) :]
    digits = re.sub(r"[^0-9]", "", rest)
    if not 7 <= len(digits) <= 14:
        return None
    fresh = str(f.permuted("phone", 10 ** len(digits), int(digits))).zfill(len(digits))
    return kept + refilled(rest, fresh, str.isdigit)


def ip(value: str, f: Feistel) -> str | None:
    octets = value.split(".")
    if any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in octets):
        return None
    number = f.permuted("ip", 2**32, int.from_bytes(bytes(map(int, octets)), "big"))
    return ".".join(map(str, number.to_bytes(4, "big")))


def date(value: str, f: Feistel) -> str | None:
    """Year first with hyphens; day first with points; with slashes month first, or day first if that is no day."""
    for form in {"-": ("%Y-%m-%d",), ".": ("%d.%m.%Y",), "/": ("%m/%d/%Y", "%d/%m/%Y")}[re.search(r"[-./]", value)[0]]:
        try:
            day = datetime.datetime.strptime(value, form).date().toordinal()
        except ValueError:
            continue
        if FIRST_DAY <= day <= LAST_DAY:
            fresh = datetime.date.fromordinal(FIRST_DAY + f.permuted("date", LAST_DAY - FIRST_DAY + 1, day - FIRST_DAY))
            if form == "%d/%m/%Y":  # keep it readable only as day first
                return f"{fresh.day:02d}/{fresh.month:02d}/{fresh.year:04d}"
            return fresh.strftime(form)
    return None


def letters_and_digits(kind: str, value: str, f: Feistel) -> str:
    """Letters to letters of their case and digits to digits, all places permuted as one number."""
    radix = [10 if c.isdigit() else 26 for c in value if c.isalnum()]
    places = [ord(c) - (48 if c.isdigit() else 65 if c.isupper() else 97) for c in value if c.isalnum()]
    size = number = 0
    for r, p in zip(radix, places, strict=True):
        size, number = (size or 1) * r, number * r + p
    shape = "".join("0" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in value)
    number, fresh = f.permuted(f"{kind}:{shape}", size, number), []
    for r in reversed(radix):
        number, p = divmod(number, r)
        fresh.append(p)
    it = iter(reversed(fresh))
    return "".join(chr(next(it) + (48 if c.isdigit() else 65 if c.isupper() else 97)) if c.isalnum() else c for c in value)


def email(value: str, f: Feistel) -> str | None:
    """The local part; the domain stays. Each piece after the first is permuted in a way that hangs on all before it."""
    local, _, domain = value.rpartition("@")
    fresh, before = [letters_and_digits("email", local[:PIECE], f)], hashlib.sha256()
    for at in range(PIECE, len(local), PIECE):
        before.update(local[at - PIECE : at].encode())
        fresh.append(letters_and_digits(f"email:{before.hexdigest()}", local[at : at + PIECE], f))
    return f"{''.join(fresh)}@{domain}"


PSEUDONYM: dict[str, Callable[[str, Feistel], str | None]] = {"email": email, "card": card, "iban": iban, "ssn": ssn, "phone": phone, "ip": ip, "date": date}


def shorter(kind: str, text: str, start: int, end: int) -> re.Match | None:
    """The longest candidate of a kind of RUNS that begins at start and ends before end."""
    if kind in RUNS:
        for stop in range(end - 1, start, -1):
            match = RUNS[kind].match(text, stop) and ALONE[kind].fullmatch(text, start, stop)
            if match:
                return match
    return None


def value_at(text: str, start: int, first: re.Match, f: Feistel) -> tuple[str, int, str] | None:
    """(kind, end, pseudonym) of the value that begins at start, where first is a candidate."""
    for kind in KINDS[KINDS.index(first.lastgroup) :]:
        match = first if kind == first.lastgroup else ALONE[kind].match(text, start)
        while match:
            fresh = PSEUDONYM[kind](match[0], f)
            if fresh is not None:
                return kind, match.end(), fresh
            match = shorter(kind, text, start, match.end())
    return None


def next_email(text: str, at: int) -> tuple[int, int] | None:
    """(start, end) of the first address that begins at a place or after it."""
    for domain in DOMAIN.finditer(text, at):
        sign = low = domain.start()
        while low > at and text[low - 1] in LOCAL:
            low -= 1
        start = LOCAL_START.search(text, low, sign)
        if start:
            return start.start(), domain.end()
    return None


def replaced(text: str, f: Feistel) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, end) of what they stand for, by places of the old text."""
    if not SIGN.search(text):
        return text, []
    out, found, at = [], [], 0
    mail, match = next_email(text, 0), PATTERN.search(text)
    while mail or match:
        if mail and not (match and match.start() < mail[0]):
            start, end = mail
            kind, fresh = "email", email(text[start:end], f)
        else:
            start = match.start()
            value = value_at(text, start, match, f)
            if value is None:
                match = PATTERN.search(text, start + 1)
                continue
            kind, end, fresh = value
        out += [text[at:start], fresh]
        found.append((kind, start, end))
        at = end
        match = PATTERN.search(text, at) if match and match.start() < at else match
        mail = next_email(text, at) if mail and mail[0] < at else mail
    return "".join([*out, text[at:]]) if found else text, found


def pseudonymised(docs: DataFrame, key: str = DEMO_KEY) -> DataFrame:
    """docs with pseudonyms in text, and __values: (kind, start, end) of each. A column of that name is replaced."""
    docs = docs.drop("__values")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Feistel(key)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            texts, values = [], []
            for text in batch["text"]:
                text = text.as_py()
                fresh, found = (None, []) if text is None else replaced(text, f)
                texts.append(fresh)
                values.append([{"kind": k, "start": a, "stop": b} for k, a, b in found])
            columns = [pa.array(texts, batch.schema.field("text").type) if n == "text" else batch[n] for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, kind)], names=[*batch.schema.names, "__values"])

    schema = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in docs.schema)
    return docs.mapInArrow(run, f"{schema}, __values array<struct<kind:string,start:long,stop:long>>")


def op3_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [f"cast(size(filter(__values, x -> x.kind = '{k}')) as long) as n_{k}" for k in KINDS]
    spans = "array_join(transform(__values, x -> concat_ws(':', x.kind, x.start, x.stop)), ',') as spans"
    return found.selectExpr("doc_id", *counts, spans, "text")
