import random
import re
import time

import pytest

from retourlens.llm import pii
from tests.llm.helpers import documents

# The fixed definitions, as plain patterns.
PLAIN = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def brute(text):
    def sound(kind, match):
        digits = "".join(c for c in match if c in "0123456789")
        return {
            0: lambda: True,
            1: lambda: all(int(p) <= 255 for p in match.split(".")),
            2: lambda: 14 <= len(digits) <= 19 and luhn(digits),
            3: lambda: 10 <= len(digits) <= 15,
        }[kind]()

    found = [(m.start(), k, m.end()) for k, p in enumerate(PLAIN) for m in p.finditer(text) if sound(k, m[0])]
    return sorted(found)


def base(text):
    return [(s.start, pii.KINDS.index(s.kind), s.end) for s in pii.find_spans(text) if s.kind in pii.BASE_KINDS]


@pytest.mark.parametrize("alphabet", ["01.25 -+()@a", "0123456789 -", "ab@.-c+", "1.2 30@x+5-", "é1.2.3 4@b"])
def test_base_spans_against_plain_patterns(alphabet):
    r = random.Random(alphabet)
    for _ in range(5000):
        text = "".join(r.choice(alphabet) for _ in range(r.randrange(60)))
        assert base(text) == brute(text)


@pytest.mark.parametrize("text, kinds", [
    ("write to Ann.B+x@mail.example.com.", ["email"]),
    ("server 10.0.0.255 and 10.0.0.256", ["ip"]),
    ("card 4539 1488 0343 6467", ["card"]), ("card 4539 1488 0343 6468", []),
    ("call +49 (30) 1234-5678", ["phone"]),
    ("my IBAN: DE89 3704 0044 0532 0130 00.", ["iban"]), ("IBAN DE89 3704 0044 0532 0130 01", []),
    ("SSN 078-05-1120", ["ssn"]), ("078-05-1120", []), ("part 078-05-1120 order", []),
    ("tel (555) 123-4567", ["phone_local"]), ("(555) 123-4567", []),
])
def test_kinds(text, kinds):
    assert [s.kind for s in pii.find_spans(text)] == kinds


def account(country, own):
    """An account number with the check digits that make it valid."""
    turned = int("".join(str(int(c, 36)) for c in f"{own}{country}00"))
    return f"{country}{98 - turned % 97:02d}{own}"


@pytest.mark.parametrize("text, found", [
    ("DE89370400440532013000 GB82WEST12345698765432", ["DE89370400440532013000", "GB82WEST12345698765432"]),
    ("DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32", ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"]),
    ("AB12 DE89370400440532013000", ["DE89370400440532013000"]),
    ("DE12 DE89370400440532013000", ["DE89370400440532013000"]),
    ("REF AB12 CODE NO15 GB82WEST12345698765432 PAID", ["GB82WEST12345698765432"]),
    ("GB82WEST12345698765432 GB82WEST12345698765433", ["GB82WEST12345698765432"]),
])
def test_accounts_one_after_another(text, found):
    assert [text[s.start : s.end] for s in pii.find_spans(text) if s.kind == "iban"] == found


@pytest.mark.parametrize("country, length", [
    ("SK", 24), ("RO", 24), ("BG", 22), ("HR", 21), ("SI", 19), ("EE", 20), ("LV", 21), ("LT", 20), ("MT", 31), ("CY", 28),
    ("TR", 26), ("AE", 23), ("SA", 24), ("LC", 32), ("RU", 33), ("NO", 15),
])
def test_accounts_of_all_countries(country, length):
    number = account(country, ("A1" + "7" * length)[: length - 4])
    assert [s.kind for s in pii.find_spans(f"konto {number}.")].count("iban") == 1


def test_every_confirmed_account_is_found():
    """Also those whose digits are a card by chance, which stays beside them."""
    r, beside = random.Random(97), 0
    for country, length in pii.IBAN_LENGTHS.items():
        for _ in range(200):
            number = account(country, "".join(r.choice("0123456789") for _ in range(length - 4)))
            text = f"iban konto {number}"
            spans = pii.find_spans(text)
            assert [text[s.start : s.end] for s in spans if s.kind == "iban"] == [number]
            assert base(text) == brute(text)
            beside += len(spans) > 1
    assert beside > 100


def test_overlapping_spans_are_hidden_together(spark):
    number = next(n for n in (account("AT", f"{i:016d}") for i in range(4222 * 10**12, 4223 * 10**12)) if brute(n))
    docs = documents(spark, [f"iban {number}-7 end", f"iban {number}"])
    hidden = [r["text"] for r in pii.redact(pii.detect(docs)).orderBy("doc_id").collect()]
    assert not any(c.isdigit() for c in hidden[1]) and hidden[1] == "iban [iban]"
    assert hidden[0].startswith("iban [iban]") and hidden[0].endswith(" end")


def test_context_raises_and_lowers_scores():
    score = lambda text: next(s.score for s in pii.find_spans(text) if s.kind == "ip")
    assert score("version 1.2.3.4") < score("see 1.2.3.4") < score("host 1.2.3.4")


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000, "1 " * 150_000, "AB12" * 70_000])
def test_long_unsplit_texts_take_linear_time(text):
    began = time.process_time()
    pii.find_spans(text)
    assert time.process_time() - began < 6


def test_rows_through_spark(spark):
    texts = [None, "", "x@y.zz", "x@y.zz", "é😀 x@y.zz und +49 30 12345678"]
    docs = documents(spark, texts).withColumnRenamed("lang", "spans").withColumnRenamed("source", "value")
    found = pii.detect(docs)
    assert found.columns == ["doc_id", "text", "value", "n_chars", "spans"]
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in found.collect()}
    assert got == {0: [], 1: [], 2: [("email", 0, 6)], 3: [("email", 0, 6)], 4: [("email", 3, 9), ("phone", 14, 29)]}
    hidden = {r["doc_id"]: r["text"] for r in pii.redact(found).collect()}
    assert hidden == {0: None, 1: "", 2: "[email]", 3: "[email]", 4: "é😀 [email] und [phone]"}
    assert pii.detect(documents(spark, [])).count() == 0
