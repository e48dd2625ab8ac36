"""Format-preserving pseudonyms for personal numbers and dates.

Each kind of value has a pattern, a check, and a mapping between its valid values
and the whole numbers below some N. A keyed Feistel network permutes those
numbers, walking its cycle until it is back below N, and the result is written in
the value's own format. So a valid value becomes another valid one of its format,
equal values get equal pseudonyms in all documents and however they are spaced,
and who has the key can go back.

Kinds: payment card numbers (13 to 19 digits that pass the Luhn check), phone
numbers, national numbers of the form 123-45-6789, IPv4 addresses, dates of the
calendar from 1900 to 2099 and the local part of e-mail addresses. Numbers that
fail their check stay as they are.

Phone numbers are international (+ or 00, then a country code and 7 to 14 digits in
any grouping), of the form (212) 555-0182, or national with a leading 0 and 8 to 11
more digits. The country code is read from the digits alone by the fixed table of
its first digits; it and any zeros after it stay, and the other digits are permuted.
So +44 20 7946 0958, +44 (0)20 7946 0958, 0044 2079460958 and 020 7946 0958 get the
same digits. Where text goes on in digits, the country's usual length decides. Ten
digits without any mark, and 00 before a country of unknown length, are no phone.

Dates are 2024-02-29, 29.02.2024, 29/02/2024 or, where the day cannot be a month,
02/29/2024. Days above 12 stay above 12, so the last two forms stay apart.

Defined results: a null text stays null, an empty one empty, both without
findings; repeated rows each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10


class Feistel:
    """Permutations of range(n), one per (key, tweak)."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, tweak: bytes, k: int, half: int, width: int) -> int:
        # as wide as the half, which an address of many characters makes longer than 16 bytes
        h = hashlib.blake2b(half.to_bytes(width, "big"), digest_size=width, key=self.key, salt=bytes([k]), person=tweak[:16])
        return int.from_bytes(h.digest(), "big")

    def _once(self, x: int, bits: int, tweak: bytes, back: bool) -> int:
        mask, width = (1 << bits) - 1, max(16, (bits + 7) // 8)
        left, right = x >> bits, x & mask
        for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = right ^ (self._round(tweak, k, left, width) & mask), left
            else:
                left, right = right, left ^ (self._round(tweak, k, right, width) & mask)
        return left << bits | right

    def permute(self, x: int, n: int, tweak: bytes, back: bool = False) -> int:
        """The image of ``x`` below ``n``, or with ``back`` the value it is the
        image of."""
        bits = max(1, ((n - 1).bit_length() + 1) // 2)
        x = self._once(x, bits, tweak, back)
        while x >= n:
            x = self._once(x, bits, tweak, back)
        return x


def luhn(digits: str) -> int:
    """The check digit that ``digits`` needs after them."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 - k % 2)
        total += d - 9 * (d > 9)
    return -total % 10


def _respell(text: str, digits: str) -> str:
    """``text`` with its digits replaced, in order, by ``digits``."""
    it = iter(digits)
    return re.sub("[0-9]", lambda _: next(it), text)


def _card(text: str, turn: Callable[[int, int, bytes], int]) -> str | None:
    digits = re.sub("[^0-9]", "", text)
    if not 13 <= len(digits) <= 19 or luhn(digits[:-1]) != int(digits[-1]) or ABROAD.fullmatch(digits):
        return None
    width = len(digits) - 1
    while True:  # until the pseudonym does not read as a phone number either
        body = f"{turn(int(digits[:-1]), 10**width, b'card%d' % width):0{width}d}"
        digits = body + str(luhn(body))
        if not ABROAD.fullmatch(digits):
            return _respell(text, digits)


#: Country codes of one and two digits; all others have three.
ONE = frozenset("17")
TWO = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
#: Least and greatest usual length after the country code.
USUAL = {
    c: (int(low), int(high))
    for low, high, codes in (
        row.split(maxsplit=2)
        for row in (
            "7 7 354", "7 8 372 961", "7 9 46 353 359", "7 10 95", "7 11 49 358", "7 13 43", "8 8 45 47 53 65 216 370 371 386 852 853 965 973 974",
            "8 9 32 36 51 66 213 381 385 855 886 962 966 971 972", "8 10 20 57 60 63 64 82 234 880 977", "8 11 39", "8 12 62",
            "9 9 27 31 33 34 40 41 48 56 61 93 94 212 254 351 375 380 420 421 994 995 996 998", "9 10 44 81 84", "10 10 1 7 30 52 58 90 91 92 98", "10 11 54 55 86",
        )
    )
    for c in codes.split()
}
#: 00, a country code and digits of a usual length, without any grouping.
ABROAD = re.compile("00(?:" + "|".join(f"{c}[0-9]{{{low},{high}}}" for c, (low, high) in USUAL.items()) + ")")


def country(digits: str) -> str:
    """The country code that ``digits`` begin with; none begins with zero."""
    return "" if digits[:1] == "0" else digits[: 1 if digits[:1] in ONE else 2 if digits[:2] in TWO else 3]


def _ends(text: str) -> list[tuple[int, str]]:
    """(end, digits up to there) of each group of digits that no bracket closes."""
    return [(m.end(), re.sub("[^0-9]", "", text[: m.end()])) for m in re.finditer(r"[0-9]+(?![0-9)])", text)]


def _fit_abroad(text: str) -> int:
    """Where the phone number that ``text`` begins with ends, zero for nowhere.
    Depends on the grouping, the country code and zeros after it only."""
    body = text.removeprefix("+") if text[0] == "+" else text[2:]
    skip, ends = len(text) - len(body), _ends(body)
    code = country(ends[-1][1])
    usual = USUAL.get(code)
    counts = []
    for end, digits in ends:
        n = len(digits) - len(code)
        alone = end > 1 and not body[end - 2].isdigit()
        if alone and n > (usual[0] if usual else 7):
            break  # a digit alone is not the end of a number that is long enough
        counts.append((end, n, n - len(digits[len(code) :]) + len(digits[len(code) :].lstrip("0"))))
    fits = [e for e, n, _ in counts if usual and usual[0] <= n <= usual[1]] or [e for e, _, n in counts if usual and usual[0] <= n <= usual[1]]
    if not fits and text[0] == "+":
        fits = [e for e, n, _ in counts if 7 <= n <= 14]
    return skip + fits[-1] if fits else 0


def _fit_home(text: str) -> int:
    """The same for a national number with a leading zero."""
    ends = [(end, len(digits) - 1) for end, digits in _ends(text)]
    fits = [e for e, n in ends if 9 <= n <= 10] or [e for e, n in ends if 8 <= n <= 11]
    return fits[-1] if fits else 0


def _phone(text: str, turn: Callable[[int, int, bytes], int]) -> str | None:
    digits = re.sub("[^0-9]", "", text)
    if text[0] == "+":
        kept = len(country(digits))
    elif digits.startswith("00") and text.startswith("00"):
        kept = 2 + len(country(digits[2:]))
    else:
        kept = len(digits) == 11 and digits[0] == "1"
    number = digits[kept:].lstrip("0")
    if not number:
        return None
    least = 10 ** (len(number) - 1)
    image = least + turn(int(number) - least, 9 * least, b"phone%d" % len(number))
    return _respell(text, digits[: len(digits) - len(number)] + str(image))


def _national(text: str, turn: Callable[[int, int, bytes], int]) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    x = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    x, serial = divmod(turn(x, 898 * 99 * 9999, b"national"), 9999)
    area, group = divmod(x, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _address(text: str, turn: Callable[[int, int, bytes], int]) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    return ".".join(map(str, turn(int.from_bytes(map(int, parts), "big"), 1 << 32, b"ipv4").to_bytes(4, "big")))


FIRST = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2099, 12, 31).toordinal() - FIRST + 1


def _date(text: str, turn: Callable[[int, int, bytes], int]) -> str | None:
    for order in ("%Y-%m-%d",) if text[4] == "-" else ("%d/%m/%Y", "%m/%d/%Y") if text[2] == "/" else ("%d.%m.%Y",):
        try:
            old = datetime.datetime.strptime(text, order).date()
            break
        except ValueError:
            pass
    else:
        return None
    x = old.toordinal() - FIRST
    if not 0 <= x < DAYS:
        return None
    while True:
        x = turn(x, DAYS, b"date")
        day = datetime.date.fromordinal(FIRST + x)
        if (day.day > 12) == (old.day > 12):
            return order.replace("%Y", f"{day.year:04d}").replace("%m", f"{day.month:02d}").replace("%d", f"{day.day:02d}")


def _mail(text: str, turn: Callable[[int, int, bytes], int]) -> str | None:
    """Letters become letters and digits digits, in their places; a letter's case
    stays, so spellings in either case are linked and can go back."""
    local, _, domain = text.rpartition("@")
    places = [(k, 10 if c.isdigit() else 26) for k, c in enumerate(local) if c.isalnum()]
    if not places:
        return None
    x, n, digits = 0, 1, sum(base == 10 for _, base in places)
    for k, base in places:
        c = local[k].lower()
        x, n = base * x + (int(c) if base == 10 else ord(c) - ord("a")), base * n
    x, out = turn(x, n, b"mail%d.%d" % (len(places) - digits, digits)), list(local)
    for k, base in reversed(places):
        x, c = divmod(x, base)
        new = str(c) if base == 10 else chr(ord("a") + c)
        out[k] = new.upper() if local[k].isupper() else new
    return "".join(out) + "@" + domain


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str  # groups are named M and a digit
    change: Callable[[str, Callable[[int, int, bytes], int]], str | None]
    fit: Callable[[str], int] | None = None  # how much of a match is the value


MARK = "[ \u00a0./\u2010\u2011-]"
#: Before more digits of a phone number: these are no e-mail or IPv4 address.
APART = r"(?![A-Za-z0-9._%+-]{1,64}@|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9]))"
ANY_GROUPS = rf"(?:[0-9]|{MARK}{APART}[0-9]|{MARK}?\([0-9]{{1,5}}\)(?={MARK}?{APART}[0-9])){{6,20}}(?![0-9])"
ALONE = r"(?<![0-9A-Za-z+])(?<![0-9][.,/-])"

# Longer kinds come first where two could begin at one place.
KINDS = (
    Kind("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", _mail),
    Kind("phone", rf"(?<![0-9A-Za-z+])\+[0-9](?:[0-9]{{0,2}}\))?{ANY_GROUPS}", _phone, _fit_abroad),
    Kind("phone", rf"{ALONE}{ABROAD.pattern}(?![0-9])", _phone),
    Kind("date", r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}(?P<M1>[/.])[0-9]{2}(?P=M1)[0-9]{4})(?![0-9])", _date),
    Kind("national", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", _national),
    Kind("address", r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])", _address),
    Kind("card", r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?P<M1>[ -])[0-9]{4}(?P=M1)[0-9]{4}(?P=M1)[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])", _card),
    Kind("phone", rf"{ALONE}(?<![0-9] )00[1-9]{ANY_GROUPS}", _phone, _fit_abroad),
    Kind("phone", rf"{ALONE}(?:1[ .-]?)?(?:\([0-9]{{3}}\)[ .-]?[0-9]{{3}}[ .-]?|(?<![0-9] )[0-9]{{3}}(?P<M1>[ .-])[0-9]{{3}}(?P=M1))[0-9]{{4}}(?![0-9]|[.-][0-9])", _phone),
    Kind("phone", rf"{ALONE}(?<![0-9] )(?![0-9]{{2}}(?P<M1>[ .-])[0-9]{{2}}(?P=M1)[0-9]{{4}}(?![0-9]))(?:\(0[1-9][0-9]{{0,4}}\){MARK}?[0-9]{{2,}}|0[1-9][0-9]{{0,4}}{MARK}{APART}[0-9]{{2,}}|0[1-9][0-9]{{7,10}})(?:{MARK}{APART}[0-9]{{2,}}){{0,5}}(?![0-9])", _phone, _fit_home),
)


class Pseudonyms:
    def __init__(self, key: bytes):
        self.network = Feistel(key)
        # in the joint pattern, each kind and its groups need names of their own
        self.kinds = {f"k{n}": k for n, k in enumerate(KINDS)}
        parts = (f"(?P<{g}>{k.pattern.replace('(?P<M', f'(?P<{g}_M').replace('(?P=M', f'(?P={g}_M')})" for g, k in self.kinds.items())
        self.pattern = re.compile("|".join(parts), re.ASCII)

    def apply(self, text: str, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
        """The changed text, and (kind, start, end) of each value in ``text``."""
        found: list[tuple[str, int, int]] = []
        if not re.search("[0-9@]", text):
            return text, found

        def turn(x: int, n: int, tweak: bytes) -> int:
            return self.network.permute(x, n, tweak, back)

        out, done, at = [], 0, 0
        while m := self.pattern.search(text, at):
            kind = next(k for g, k in self.kinds.items() if m[g] is not None)
            size = kind.fit(m[0]) if kind.fit else len(m[0])
            new = kind.change(m[0][:size], turn) if size else None
            at = m.start() + 1  # a valid value may begin inside a match that fails its check
            if new is not None:
                out += [text[done : m.start()], new]
                done = at = m.start() + size
                found.append((kind.name, m.start(), done))
        return "".join([*out, text[done:]]), found


def pseudonymize(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """doc_id, text with pseudonyms, and ``found`` (kind, start and end in the
    text before)."""
    shared = docs.sparkSession.sparkContext.broadcast(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pseudonyms(shared.value)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            texts, found = [], []
            for t in b.column("text"):
                text, spans = (None, []) if not t.is_valid else p.apply(t.as_py(), back)
                texts.append(text)
                found.append([{"kind": k, "start": a, "end": z} for k, a, z in spans])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string()), pa.array(found, kind)], ["doc_id", "text", "found"])

    schema = "doc_id long, text string, found array<struct<kind:string,start:long,end:long>>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
