"""Format-preserving pseudonyms for personal numbers, dates and addresses.

What looks like a personal value is validated (check digits, ranges, the calendar). A valid
value has a place in the list of all valid values of its format; a keyed Feistel network
permutes the places, and the value at the new place replaces it. So a pseudonym is valid
in the same format, and equal values get equal pseudonyms in every document, however they
are written, without any shared table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.common import filled, slices

ROUNDS = 10
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
FOUND = "array<struct<kind:string,start:int,stop:int,pseudonym:string>>"


def permute(place: int, size: int, key: bytes, kind: str) -> int:
    """A keyed permutation of 0 .. size - 1.

    A Feistel network on pairs of digits a * b >= size; places beyond the size are sent
    through again until they fall within it, which keeps it one to one.
    """
    if size < 2:
        return place
    a = isqrt(size - 1) + 1
    b = -(-size // a)
    tweak = f"{kind}:{size}:".encode()
    while True:
        left, right = divmod(place, b)
        for i in range(ROUNDS):
            if i % 2:
                right = (right + _noise(key, tweak, i, left)) % b
            else:
                left = (left + _noise(key, tweak, i, right)) % a
        place = left * b + right
        if place < size:
            return place


def _noise(key: bytes, tweak: bytes, i: int, half: int) -> int:
    said = tweak + b"%d:%d" % (i, half)
    return int.from_bytes(hashlib.blake2b(said, key=key, digest_size=16).digest(), "big")


def luhn_digit(payload: str) -> str:
    """The last digit that makes a number pass the Luhn check."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


# Each kind: from the text of a match to its pseudonym, or None if it is not valid.


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _laid(text: str, digits: str) -> str:
    """Digits in the places of the digits of a text."""
    new = iter(digits)
    return re.sub(r"\d", lambda _: next(new), text)


def _card(text: str, key: bytes) -> str | None:
    number = _digits(text)
    if not 13 <= len(number) <= 19 or luhn_digit(number[:-1]) != number[-1]:
        return None
    if len(set(number)) == 1:
        return None
    body = number[1:-1]
    size = 10 ** len(body)
    # The first digit names the network and stays.
    new = number[0] + str(permute(int(body), size, key, f"card{number[0]}")).zfill(len(body))
    return _laid(text, new + luhn_digit(new))


def _phone(text: str, key: bytes) -> str | None:
    number = _digits(text)
    prefix = ""
    if text.startswith("+"):
        prefix = "1" if number.startswith("1") else re.match(r"\+(\d+)", text)[1]
    rest = number[len(prefix) :]
    if not 7 <= len(rest) <= 12 or rest[0] == "0":
        return None
    # Subscriber numbers do not begin with 0; area codes of ten-digit numbers from 2.
    low = (2 if len(rest) == 10 else 1) * 10 ** (len(rest) - 1)
    if int(rest) < low:
        return None
    new = permute(int(rest) - low, 10 ** len(rest) - low, key, "phone")
    return _laid(text, prefix + str(new + low))


def _social(text: str, key: bytes) -> str | None:
    number = _digits(text)

    def valid(n: str) -> bool:
        area = n[:3]
        return area not in ("000", "666") and area < "900" and n[3:5] != "00" and n[5:] != "0000"

    if not valid(number):
        return None
    while True:
        number = str(permute(int(number), 900_000_000, key, "social")).zfill(9)
        if valid(number):
            return _laid(text, number)


def _address(text: str, key: bytes) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts) or parts[0] == "0":
        return None
    # Each part keeps its number of digits.
    spans = [{1: (0, 10), 2: (10, 100), 3: (100, 256)}[len(p)] for p in parts]
    spans[0] = (max(spans[0][0], 1), spans[0][1])
    place, size = 0, 1
    for part, (low, high) in zip(parts, spans):
        place, size = place * (high - low) + int(part) - low, size * (high - low)
    place = permute(place, size, key, "address" + "".join(str(len(p)) for p in parts))
    new = []
    for low, high in reversed(spans):
        place, at = divmod(place, high - low)
        new.append(str(low + at))
    return ".".join(reversed(new))


def _date(text: str, key: bytes) -> str | None:
    numbers = [int(n) for n in re.findall(r"\d+", text)]
    year_first = len(re.match(r"\d+", text)[0]) == 4
    orders = ((0, 1, 2),) if year_first else ((2, 1, 0), (2, 0, 1))
    for y, m, d in orders:
        try:
            day = date(numbers[y], numbers[m], numbers[d]).toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        size = LAST_DAY - FIRST_DAY + 1
        new = date.fromordinal(FIRST_DAY + permute(day - FIRST_DAY, size, key, "date"))
        values = {y: f"{new.year:04d}", m: f"{new.month:02d}", d: f"{new.day:02d}"}
        fields = iter(values[i] for i in range(3))
        return re.sub(r"\d+", lambda _: next(fields), text)
    return None


def _iban(text: str, key: bytes) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _mod97(plain[4:] + plain[:4]) != 1:
        return None
    body = _permuted_text(plain[4:], key, "iban" + plain[:2])
    check = 98 - _mod97(body + plain[:2] + "00")
    new = iter(plain[:2] + f"{check:02d}" + body)
    return re.sub(r"\S", lambda _: next(new), text)


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _email(text: str, key: bytes) -> str | None:
    name, at, domain = text.partition("@")
    return _permuted_text(name, key, "email") + at + domain


def _permuted_text(text: str, key: bytes, kind: str) -> str:
    """Letters for letters of the same case and digits for digits; other characters stay."""
    place, size, classes = 0, 1, ""
    for c in text:
        low, n = _class(c)
        classes += chr(low)
        if n > 1:
            place, size = place * n + ord(c) - low, size * n
    place = permute(place, size, key, kind + classes)
    new = []
    for c in reversed(text):
        low, n = _class(c)
        place, at = divmod(place, n) if n > 1 else (place, 0)
        new.append(chr(low + at))
    return "".join(reversed(new))


def _class(c: str) -> tuple[int, int]:
    if "0" <= c <= "9":
        return 48, 10
    if "a" <= c <= "z":
        return 97, 26
    if "A" <= c <= "Z":
        return 65, 26
    return ord(c), 1


KINDS: dict[str, Callable[[str, bytes], str | None]] = {
    "email": _email,
    "iban": _iban,
    "phone": _phone,
    "social": _social,
    "date": _date,
    "address": _address,
    "card": _card,
}

_START = re.compile(r"[@+(0-9]")
# From a digit, plus or bracket on; the kinds are tried in this order.
_NUMBER = re.compile(
    r"""
      (?P<date>\d{4}-\d{1,2}-\d{1,2} | \d{1,2}(?P<s1>[/.])\d{1,2}(?P=s1)\d{4})
    | (?P<address>\d{1,3}(?:\.\d{1,3}){3}(?!\.\d))
    | (?P<social>\d{3}-\d{2}-\d{4})
    | (?P<phone>\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}
        | \(\d{3}\)[ ]?\d{3}-\d{4}
        | \d{3}(?P<s2>[-.])\d{3}(?P=s2)\d{4})
    | (?P<card>\d{4}(?:[ -]\d{4}){2}[ -]\d{1,7} | \d{4}[ -]\d{6}[ -]\d{4,5} | \d{13,19})
    """,
    re.X,
)
_IBAN = re.compile(r"[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?")
# Characters of an IBAN by country, as registered.
_IBAN_SIZES = {
    country: size
    for size, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_GROUPS = re.compile(r"(.*\d)[ .-]\d+")
_NAME = re.compile(r"[A-Za-z0-9._%+-]{1,64}$")
_DOMAIN = re.compile(r"@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}")


def _matches(text: str) -> Iterator[tuple[str, int, int]]:
    """Candidates from left to right, none overlapping the last valid one it was told of."""
    at, done = 0, 0
    while m := _START.search(text, at):
        i = m.start()
        at = i + 1
        found = None
        if m[0] == "@":
            name, domain = _NAME.search(text, max(done, i - 64), i), _DOMAIN.match(text, i)
            if name and domain:
                found = "email", name.start(), domain.end()
        else:
            before = text[i - 1] if i > done else " "
            if m[0].isdigit() and i - 2 >= done and "A" <= before <= "Z":
                own = i < 3 or not text[i - 3].isalnum()
                if own and (n := _IBAN.match(text, i - 2)):
                    found = "iban", i - 2, n.end()
            elif not (before.isalnum() or before in "_+(") and (n := _NUMBER.match(text, i)):
                found = next(k for k in KINDS if n.groupdict().get(k)), i, n.end()
        if not found:
            continue
        kind, start, stop = found
        for end in _ends(text, kind, start, stop):
            if (end == len(text) or not _joined(text, end)) and (yield kind, start, end):
                at = done = end
                break


def _ends(text: str, kind: str, start: int, stop: int) -> Iterator[int]:
    """Where a candidate may end, in the order to be tried."""
    if kind == "iban":
        # An upper-case word or a number behind it looks like more of its groups.
        size = _IBAN_SIZES.get(text[start : start + 2])
        places = [i for i in range(start, stop) if text[i] != " "]
        if size and len(places) > size:
            yield places[size - 1] + 1
        yield stop
        if not size:
            yield from (i for i in range(stop - 1, start, -1) if text[i] == " ")
        return
    yield stop
    # The groups of a phone number may run on into the number after it.
    while kind == "phone" and (shorter := _GROUPS.fullmatch(text, start, stop)):
        stop = shorter.end(1)
        yield stop


def _joined(text: str, end: int) -> bool:
    return text[end].isalnum() or text[end] == "_"


class Pseudonymiser:
    def __init__(self, key: bytes, kinds: tuple[str, ...] = tuple(KINDS)):
        if not key:
            raise ValueError("a key is needed")
        self.kinds = kinds
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.known = lru_cache(100_000)(self._pseudonym)

    def _pseudonym(self, kind: str, text: str) -> str | None:
        return KINDS[kind](text, self.key) if kind in self.kinds else None

    def replaced(self, text: str) -> tuple[str, list[dict]]:
        """The text with pseudonyms, and where the originals stood in code points."""
        found, parts, at = [], [], 0
        candidates = _matches(text)
        item = next(candidates, None)
        while item:
            kind, start, stop = item
            new = self.known(kind, text[start:stop])
            if new is not None:
                parts += [text[at:start], new]
                found.append({"kind": kind, "start": start, "stop": stop, "pseudonym": new})
                at = stop
            try:
                item = candidates.send(new is not None)
            except StopIteration:
                break
        return "".join([*parts, text[at:]]) if found else text, found


def pseudonymise(
    df: DataFrame,
    key: bytes,
    kinds: tuple[str, ...] = tuple(KINDS),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Texts with every valid personal value replaced by its pseudonym.

    Returns doc_id, text and found (kind, start and stop in code points of the original
    text, and the pseudonym; never the original). One row for each row given, repeated
    ones too; a null text is empty, a null id stays null, an empty table gives no rows.
    Kinds: email, iban, phone, social (security number), date, address (IPv4) and card.
    A date such as 03/04/2001 is read day first, unless only month first is a date.
    Values that fail their check stay as they are.
    """
    unknown = set(kinds) - set(KINDS)
    if unknown:
        raise ValueError(f"unknown kinds: {sorted(unknown)}")
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), filled(text_col).alias("text"))
    return rows.mapInArrow(_replace(key, kinds), f"doc_id long, text string, found {FOUND}")


def _replace(key: bytes, kinds: tuple[str, ...]) -> Callable:
    one = [("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]
    found_type = pa.list_(pa.struct([*one, ("pseudonym", pa.string())]))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = Pseudonymiser(key, kinds)
        for batch in slices(batches):
            made = [worker.replaced(text.as_py()) for text in batch["text"]]
            columns = [
                batch["doc_id"],
                pa.array([m[0] for m in made], pa.string()),
                pa.array([m[1] for m in made], found_type),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "found"])

    return replace
