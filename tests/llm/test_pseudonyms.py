"""Pseudonyms: permutations, round trips, formats and links between documents."""

from __future__ import annotations

import datetime
import hashlib
import random
import re

import pytest

from tidewater.llm import pseudonyms as ps
from tidewater.llm import queries

SF = "/root/testdata/sf0.001"
VALUES = [
    "4845168114407329", "4845 1681 1440 7329", "4845-1681-1440-7329", "378282246310005", "3782 822463 10005", "97.51.17.173", "0.0.0.0",
    "+1 (017) 555-7713", "+44 20 7946 0958", "2024-02-29", "31/12/1999", "01.02.2003", "un-d.34@mail7.example.com", "123-45-6789",
]
INVALID = ["4845168114407328", "300.1.1.1", "01.1.1.1", "2023-02-29", "31/02/1999", "1899-12-31", "666-12-1234", "900-12-1234", "123-00-1234", "12 34", "1.2.3.4.5"]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 4097])
def test_feistel_is_a_permutation(n):
    f = ps.Feistel(b"key")
    image = [f.permute(x, n, b"t") for x in range(n)]
    assert sorted(image) == list(range(n)) and [f.permute(y, n, b"t", back=True) for y in image] == list(range(n))
    if n > 100:
        assert image != [ps.Feistel(b"other").permute(x, n, b"t") for x in range(n)] != [f.permute(x, n, b"u") for x in range(n)]


@pytest.mark.parametrize("value", VALUES)
def test_valid_values_change_within_their_format(value):
    p = ps.Pseudonyms(b"key")
    text = f"é 12 {value}, {value} 7"
    out, found = p.apply(text)
    assert [text[a:z] for _, a, z in found] == [value] * 2 and value not in out
    shape = lambda s: re.sub("[a-z]", "0", re.sub("[0-9]", "0", s))
    if found[0][0] != "address":
        assert shape(out) == shape(text)
    again, found_again = p.apply(out)
    assert [k for k, _, _ in found_again] == [k for k, _, _ in found]  # still valid values of their kind
    assert p.apply(out, back=True)[0] == text


@pytest.mark.parametrize("value", INVALID)
def test_invalid_values_stay(value):
    assert ps.Pseudonyms(b"key").apply(f"a {value} b") == (f"a {value} b", [])


def test_a_valid_value_after_a_failed_match_is_found():
    text = "1234 4845 1681 1440 7329 7 and 12 4845168114407329 and +1 (017) 555-7713 123-45-6789"
    _, found = ps.Pseudonyms(b"key").apply(text)
    assert [text[a:z] for _, a, z in found] == ["4845 1681 1440 7329", "4845168114407329", "+1 (017) 555-7713", "123-45-6789"]


def test_spacing_does_not_break_links():
    out, _ = ps.Pseudonyms(b"key").apply(" | ".join(VALUES[:3]))
    assert len({re.sub("[ -]", "", x) for x in out.split(" | ")}) == 1


def test_national_numbers_cover_their_domain():
    turn = lambda x, n, _: (x + 1) % n
    seen, value = set(), "665-99-9999"
    for _ in range(3):
        value = ps._national(value, turn)
        seen.add(value)
    assert seen == {"667-01-0001", "667-01-0002", "667-01-0003"} and ps._national("899-99-9999", turn) == "001-01-0001"


def test_rows(spark):
    rng = random.Random(1)
    texts = [None, "", "no numbers", "@", "9" * 50_000, *VALUES, *INVALID]
    texts += [" | ".join(rng.choice(VALUES + INVALID + ["word", "12", "!!"]) for _ in range(30)) for _ in range(50)]
    rows = [*enumerate(texts), (5, texts[5]), (None, VALUES[0])]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, found int, kind string").repartition(3)
    p = ps.Pseudonyms(b"key")
    got = ps.pseudonymize(docs, b"key")
    want = [(d, *((None, []) if t is None else p.apply(t))) for d, t in rows]
    assert sorted(((r["doc_id"], r["text"], [tuple(x) for x in r["found"]]) for r in got.collect()), key=str) == sorted(want, key=str)
    back = ps.pseudonymize(got.drop("found"), b"key", back=True)
    assert sorted(map(str, back.select("doc_id", "text").collect())) == sorted(map(str, docs.select("doc_id", "text").collect()))
    assert ps.pseudonymize(docs.limit(0), b"key").count() == 0


def test_query_leaves_no_valid_value_and_keeps_links(spark):
    before = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    values, images = {}, {}
    for r in queries.op7_pseudonyms(spark, SF).collect():
        old, new = before[r["doc_id"]], r["text"]
        assert len(old) == len(new) or "address" in r["kinds"]
        for m in re.finditer(r"\b[0-9]{16}\b|\S+@\S+", old):
            if "@" in m[0] or ps.luhn(m[0][:-1]) == int(m[0][-1]):
                assert m[0] not in new
            else:
                assert m[0] in new
        if len(old) == len(new):
            for m in re.finditer(r"\b[0-9]{16}\b", old):
                image = new[m.start() : m.end()]
                assert values.setdefault(m[0], image) == image and images.setdefault(image, m[0]) == m[0]
    assert values


SPELLINGS = [
    ["+442079460958", "+44 20 7946 0958", "+44 (0)20 7946 0958", "+44 (20) 79460958", "+44-2079-460-958", "+44.20.79.46.09.58", "+4420 79460958", "(+44) 20 7946 0958", "+44 020 7946 0958", "00442079460958", "0044 20 7946 0958", "020 7946 0958", "(020) 7946-0958", "02079460958"],
    ["+12125550182", "+1 212 555 0182", "+1 (212) 555-0182", "+1-212-555-0182", "+1.212.555.0182", "(212) 555-0182", "(212)555-0182", "212-555-0182", "212.555.0182", "1-212-555-0182", "0012125550182", "001 212 555 0182"],
    ["+33 1 23 45 67 89", "+33123456789", "+33 (0)1 23 45 67 89", "01 23 45 67 89", "01.23.45.67.89", "0123456789", "0033 123456789"],
    ["+49 30 1234567", "+49301234567", "+49 30 123 45 67", "+49 (0) 30/1234567", "030 1234567", "030/1234567", "0049 30 1234567"],
    ["+353 1 234 5678", "+35312345678", "+353 (0)1 2345678"], ["+999 12 34 56 7", "+9991234567"], ["+39 06 1234 5678", "+390612345678", "06 1234 5678"],
]


@pytest.mark.parametrize("spellings", SPELLINGS)
def test_all_spellings_of_a_phone_number_link(spellings):
    p = ps.Pseudonyms(b"key")
    images, codes = set(), set()
    width = len(re.sub("[^0-9]", "", spellings[0])) - len(ps.country(re.sub("[^0-9]", "", spellings[0])))
    width -= spellings[0].startswith("+39")  # a zero that stays
    for value in spellings:
        for text in (value, f"call {value}, or ({value}).", f"{value}\n{value}"):
            out, found = p.apply(text)
            assert {k for k, _, _ in found} == {"phone"} and len(found) == text.count(value), text
            assert re.sub("[0-9]", "0", out) == re.sub("[0-9]", "0", text) and p.apply(out, back=True)[0] == text
        digits = re.sub("[^0-9]", "", p.apply(value)[0])
        images.add(digits[-width:])
        codes.add(digits[:-width] == re.sub("[^0-9]", "", value)[:-width])
    assert len(images) == 1 and codes == {True}


def test_numbers_after_a_phone_number_stay():
    p = ps.Pseudonyms(b"key")
    for text in ("+44 20 7946 0958 2024 was", "+1 212 555 0182 7 men", "+33 1 23 45 67 89 10 km", "+49 30 1234567 2024", "030 1234567 2024 km", "+49 30 1234567 10.0.0.1", "+49 30 1234567 12@x.org"):
        out, found = p.apply(text)
        assert text[: found[0][2]] in sum(SPELLINGS, []) and p.apply(out, back=True)[0] == text
    for text in ("2125550182", "order 12 34 56 78", "01-02-2003 12:30", "1234 0123 4567 8901", "4845 0168 1144 0732", "0.123 456 789", "000123456789", "3.0123456789", "00999123456789"):
        assert p.apply(text) == (text, []), text


def test_dates_with_the_month_first():
    p = ps.Pseudonyms(b"key")
    spellings = ["12/31/1999", "31/12/1999", "1999-12-31", "31.12.1999"]
    outs = [p.apply(x)[0] for x in spellings]
    days = {datetime.datetime.strptime(o, f).date() for o, f in zip(outs, ["%m/%d/%Y", "%d/%m/%Y", "%Y-%m-%d", "%d.%m.%Y"], strict=True)}
    assert len(days) == 1 and [p.apply(o, back=True)[0] for o in outs] == spellings
    for k in range(400):
        day = datetime.date(1999, 1, 1) + datetime.timedelta(k)
        for order in ("%d/%m/%Y", "%Y-%m-%d", *["%m/%d/%Y"] * (day.day > 12)):
            out, found = p.apply(day.strftime(order))
            assert len(found) == 1 and p.apply(out, back=True)[0] == day.strftime(order)


def test_random_numbers_go_back():
    rng, p = random.Random(7), ps.Pseudonyms(b"key")
    for _ in range(4000):
        digits = "".join(rng.choice("0012345678") for _ in range(rng.randint(7, 19)))
        text = "".join(rng.choice(["", "", "", " ", "-", ".", "/"]) + c for c in digits)
        text = rng.choice(["", "+", "00", "0", "+44 ", "+1 ", "(0", "0049", "x "]) + text + rng.choice(["", " 12", ", 020 7946 0958", " a1@x.org"])
        out, _ = p.apply(text)
        assert p.apply(out, back=True)[0] == text, text
    for k in range(300):  # cards whose pseudonym could read as a phone number
        body = f"{rng.randrange(10**13):013d}" if k % 2 else "0045" + f"{rng.randrange(10**8):08d}"
        text = body + str(ps.luhn(body))
        assert p.apply(p.apply(text)[0], back=True)[0] == text


def plain_feistel(key, x, n, tweak):
    """The network from its definition: ten rounds over two halves, until below n."""
    bits = max(1, ((n - 1).bit_length() + 1) // 2)
    size = max(16, -(-bits // 8))
    while True:
        left, right = divmod(x, 2**bits)
        for k in range(10):
            digest = hashlib.blake2b(right.to_bytes(size, "big"), digest_size=size, key=key, salt=bytes([k]), person=tweak).digest()
            left, right = right, left ^ int.from_bytes(digest, "big") % 2**bits
        x = left * 2**bits + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 7, 1000, 36**49, 26**64, 26**30 * 10**34])
def test_feistel_matches_its_definition_at_every_width(n):
    rng, f = random.Random(n), ps.Feistel(b"key")
    for x in [0, n - 1, *(rng.randrange(n) for _ in range(5))]:
        y = f.permute(x, n, b"t")
        assert y == plain_feistel(b"key", x, n, b"t") and f.permute(y, n, b"t", back=True) == x


@pytest.mark.parametrize("length", range(1, 65))
def test_local_parts_of_every_length_go_there_and_back(length):
    rng, p = random.Random(length), ps.Pseudonyms(b"key")
    for letters in ("abcXYZ", "0123456789", "aB3._%+-"):
        local = "".join(rng.choice(letters) for _ in range(length))
        text = f"<{local}@example.com>"
        out, found = p.apply(text)
        assert p.apply(out, back=True) == (text, found)
        if any(c.isalnum() for c in local):
            assert [x[1:] for x in found] == [(1, len(text) - 1)]
            for a, b in zip(text, out, strict=True):  # the format: kind of character and case, place by place
                assert (a.isdigit(), a.isalpha(), a.isupper()) == (b.isdigit(), b.isalpha(), b.isupper()) and (a.isalnum() or a == b)


def test_addresses_are_linked_whatever_their_case():
    p = ps.Pseudonyms(b"key")
    out = [p.apply(f"{local}@example.com")[0] for local in ("John.Doe7", "john.doe7", "JOHN.DOE7", "john.doe8")]
    assert len({x.lower() for x in out[:3]}) == 1 and out[0] != out[1] and out[3].lower() != out[0].lower()
    assert [p.apply(x, back=True)[0] for x in out[:3]] == ["John.Doe7@example.com", "john.doe7@example.com", "JOHN.DOE7@example.com"]


def test_long_address_through_spark(spark):
    rows = [(n, "x" * n + "@mail.example.com") for n in (49, 50, 52, 60, 64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ps.pseudonymize(docs, b"key")
    assert sorted((r["doc_id"], r["text"]) for r in ps.pseudonymize(got.drop("found"), b"key", back=True).collect()) == rows
    assert all(len(r["found"]) == 1 for r in got.collect())
