import datetime
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import pii
from quarry.llm.queries import PSEUDONYM_KEY, QUERIES


def rounds(digits, radices, tweak, forward):
    s, half = list(digits), len(digits) // 2
    for r in range(pii.ROUNDS) if forward else reversed(range(pii.ROUNDS)):
        first = r % 2 == 0
        other = s[half:] if first else s[:half]
        d = hashlib.sha512(f"{tweak}|{r}|{','.join(map(str, other))}".encode()).hexdigest()
        for i in range(len(s)):
            if (i < half) == first:
                key = int(d[i % 32 * 4:i % 32 * 4 + 4], 16) + i // 32
                s[i] = (s[i] + (key if forward else -key)) % radices[i]
    return s


def permuted(digits, radices, tweak):
    s = rounds(digits, radices, tweak, True)
    s[-1] = (s[-1] + 1) % radices[-1]
    return rounds(s, radices, tweak, False)


def in_alphabets(value, alphabets, tweak):
    at = [i for i, a in enumerate(alphabets) if len(a) > 1]
    if not at:
        return value
    out = list(value)
    for i, d in zip(at, permuted([alphabets[i].index(value[i]) for i in at], [len(alphabets[i]) for i in at], tweak)):
        out[i] = alphabets[i][d]
    return "".join(out)


def by_class(c):
    return next((a for a in (pii.DIGITS, pii.LOWER, pii.UPPER) if c in a), "")


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))


def networked(d):
    """Whether digits lead and are as many as a card network's."""
    n, lead = len(d), int(d[:4])
    return (lead // 1000 == 4 and n in (13, 16, 19) or n == 16 and (51 <= lead // 100 <= 55 or 2221 <= lead <= 2720)
            or n == 15 and lead // 100 in (34, 37) or n == 14 and (300 <= lead // 10 <= 305 or lead // 100 in (36, 38))
            or 16 <= n <= 19 and (lead == 6011 or 644 <= lead // 10 <= 659 or 3528 <= lead <= 3589 or lead // 100 == 62))


def blocked(sizes):
    """Whether a card's number is written in such blocks."""
    return len(sizes) == 1 or (sizes[:3] == [4, 4, 4] and (len(sizes) == 4 and sizes[3] <= 4 or len(sizes) == 5 and sizes[3] == 4 and sizes[4] <= 3)) \
        or sizes in ([4, 6, 4], [4, 6, 5])


def brute(value, key):
    """(kind, pseudonym) of one matched value."""
    d = re.sub("[^0-9]", "", value)
    if "@" in value:
        local, domain = value.split("@", 1)
        if re.search("[0-9A-Za-z]", local):
            return "email", in_alphabets(local, [by_class(c) for c in local], key + "|email") + "@" + domain
        return "email", "u" + hashlib.sha256(f"{key}|email|{local}".encode()).hexdigest()[:16] + "@" + domain
    if value.endswith('"'):
        head, body = value[:-1].split('"', 1)
        alphabets = [pii.HEX] * len(body) if re.fullmatch("[0-9a-f]+", body) else [by_class(c) for c in body]
        return "secret", head + '"' + in_alphabets(body, alphabets, key + "|hex") + '"'
    if re.fullmatch(r"[0-9]+(\.[0-9]+){3}", value):
        return "ip", ".".join(map(str, permuted(list(map(int, value.split("."))), [256] * 4, key + "|ip")))
    if m := re.fullmatch(r"(\d{4})-(\d\d)-(\d\d)", value) or re.fullmatch(r"(\d\d)\.(\d\d)\.(\d{4})", value):
        iso = "-" in value
        y, mo, da = map(int, m.groups() if iso else reversed(m.groups()))
        try:
            at = (datetime.date(y, mo, da) - datetime.date(1900, 1, 1)).days
        except ValueError:
            return None, value
        if at < pii.DAYS:
            a, b = permuted([at // pii.SIDE, at % pii.SIDE], [pii.SIDE] * 2, key + "|date")
            at = a * pii.SIDE + b
        else:
            at = pii.DAYS + permuted([at - pii.DAYS], [pii.REST], key + "|date")[0]
        day = datetime.date(1900, 1, 1) + datetime.timedelta(at)
        return "date", day.strftime("%Y-%m-%d" if iso else "%d.%m.%Y")
    if re.fullmatch(r"\d{3}-\d\d-\d{4}", value):
        if re.search(r"^(000|666|9)|^....00-|0000$", value):
            return None, value
        a, g, s = map(int, value.split("-"))
        a, g, s = permuted([a - (2 if a > 666 else 1), g - 1, s - 1], [898, 99, 9999], key + "|ssn")
        return "ssn", f"{a + (2 if a >= 665 else 1):03d}-{g + 1:02d}-{s + 1:04d}"
    if re.fullmatch("[0-9a-f]{32,}", value):
        return "hex", in_alphabets(value, [pii.HEX] * len(value), key + "|hex")
    if re.fullmatch(r"(\+\d{1,3}[ .\-]?)?(\(\d{3}\)[ .\-]?|\d{3}[.\-])\d{3}[ .\-]\d{4}", value):
        local = re.search(r"\(?\d{3}[)]?[ .\-]?\d{3}[ .\-]\d{4}$", value).group()
        t, alphabets, n = re.sub(r"\D", "", local), [], 0
        for c in local:
            n += c.isdigit()
            lead = "23456789" if t[0] >= "2" and t[3] >= "2" else ""
            alphabets.append("" if not c.isdigit() else lead if n in (1, 4) else pii.DIGITS)
        return "phone", value[:-len(local)] + in_alphabets(local, alphabets, key + "|phone")
    if networked(d) and blocked([len(b) for b in re.split("[^0-9]", value)]) and luhn(d) % 10 == 0:
        m = in_alphabets(value[:-1], ["" if i < 4 else by_class(c) for i, c in enumerate(value[:-1])], key + "|card")
        return "card", m + str(-luhn(re.sub(r"\D", "", m) + "0") % 10)
    return None, value


def masked(text, key):
    import regex
    if not text:
        return text, []
    kinds = []

    def one(m):
        kind, out = brute(m.group(), key)
        kinds.append(kind)
        return out
    return regex.sub(pii.ANY, one, text), kinds


VALUES = ["the.24@mail4.example.com", "öü@x.de", "A_b+C@sub.host-1.org", "4845168114407329", "4845 1681 1440 7329",
          "9807915762804490", "+1 (542) 555-3599", "(142) 055-3599", "415-555-2671", "106.158.249.239", "256.1.1.1",
          "1.2.3.4", "2024-02-29", "2023-02-29", "31.12.1999", "2099-12-30", "123-45-6789", "666-45-6789", "899-01-0001",
          'token = "4d44c79e8bf7c55759c4958dd60ed83d2ef8cd4e"', "4d44c79e8bf7c55759c4958dd60ed83d2ef8cd4e",
          'password="Hunter2!xyz"', "1" * 400, "a" * 100_000, "@" * 500, "1 " * 3000, "a@" + "b." * 3000]


def test_values_equal_brute_force(spark):
    texts = [f"start {v}, mid {v} end.\n{v}" for v in VALUES] + VALUES + ["", None, "nothing here", " ".join(VALUES[:21])]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[0], "x")],
                               "doc_id long, text string, n_card string")
    rows = pii.pseudonymise(df, "k").collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        want, kinds = masked(texts[r.doc_id], "k")
        assert r.text == want, (texts[r.doc_id][:80], r.text[:80])
        assert {k: r[f"n_{k}"] for k in pii.KINDS} == {k: kinds.count(k) for k in pii.KINDS}
    assert pii.pseudonymise(df.limit(0), "k").count() == 0
    assert "n_card" in pii.pseudonymise(df, "k", counts=False).columns


def test_one_to_one(spark):
    for radices in ([2, 3], [7], [4, 5, 6], [270, 2]):
        size = 1
        for r in radices:
            size *= r
        all_ = [[n // __import__("math").prod(radices[i + 1:]) % radices[i] for i in range(len(radices))] for n in range(size)]
        df = spark.createDataFrame([(d,) for d in all_], "d array<int>")
        out = [tuple(r.e) for r in df.select(pii.permuted(F.col("d"), F.array(*map(F.lit, radices)), F.lit("t")).alias("e")).collect()]
        assert sorted(out) == sorted(map(tuple, all_)) and all(list(a) != b for a, b in zip(out, all_))


def test_query(spark, sf):
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op7_feistel_pii"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want, kinds = masked(texts[r.doc_id], PSEUDONYM_KEY)
        assert r.text == want
        for m in re.findall(r"\S+@mail\S+", texts[r.doc_id]):
            assert m not in r.text
    assert sum(r.n_email for r in rows) > 0


def test_long_secrets(spark):
    rng = random.Random(5)
    body = lambda n: "".join(rng.choice("abcXYZ019-_.") for _ in range(n))
    secrets = [body(n) for n in (8, 256, 257, 300, 5_000, 40_000)] + ["0123456789abcdef" * 100, "ü" * 600]
    df = spark.createDataFrame([(i, f'x token="{s}" y') for i, s in enumerate(secrets)], "i long, text string")
    for r in pii.pseudonymise(df, "k").collect():
        s = secrets[r.i]
        if re.search("[0-9a-z]", s):
            alphabets = [pii.HEX] * len(s) if re.fullmatch("[0-9a-f]+", s) else [by_class(c) for c in s]
            assert r.text == f'x token="{in_alphabets(s, alphabets, "k|hex")}" y'
        assert s not in r.text and r.n_secret == 1


def cards_in(text):
    """(start, end) of the card numbers in ``text``, found without patterns: first, then longest."""
    out, at = [], 0
    blocks = []
    while at < len(text):
        end = at
        while end < len(text) and text[end] in pii.DIGITS:
            end += 1
        if end > at:
            blocks.append((at, end))
        at = max(end, at + 1)
    i = 0
    while i < len(blocks):
        longest, j = None, i
        while j < len(blocks) and (j == i or text[blocks[j - 1][1]:blocks[j][0]] in (" ", "-")):
            d = "".join(text[a:b] for a, b in blocks[i:j + 1])
            if 13 <= len(d) <= 19 and networked(d) and blocked([b - a for a, b in blocks[i:j + 1]]) and luhn(d) % 10 == 0:
                longest = j
            j += 1
        if longest is None:
            i += 1
        else:
            out.append((blocks[i][0], blocks[longest][1]))
            i = longest + 1
    return out


def test_cards_beside_numbers(spark):
    card = "4845 1681 1440 7329"
    texts = [f"{card} 12/25", f"{card} 123", f"order 12 {card}", f"{card}-7 {card}", f"1234567 {card} 12/25 99",
             f"4845168114407329 1 {card}", "4845-1681-1440-7329 11", f"1 {card} 2 {card} 3", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
             "3782 822463 10005 07/29", "3782-822463-10005 4321", "1234 5678 9012 3456 789", f"ünd {card}\n{card} 12",
             "48451681144073291 2345678901234567890 1"]
    rng = random.Random(9)
    for _ in range(300):
        parts = [rng.choice([card, "4845168114407329", "378282246310005", *(str(rng.randrange(10 ** n)) for n in (1, 2, 4, 7, 9))])
                 for _ in range(rng.randint(1, 6))]
        texts.append("".join(p + rng.choice([" ", " ", "-", ", ", " / "]) for p in parts))
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    seen = 0
    for r in pii.pseudonymise(df, "k").collect():
        t, want, at = texts[r.i], "", 0
        if re.search(pii.PATTERNS["phone"] + "|" + pii.PATTERNS["ssn"] + "|" + pii.PATTERNS["date"], t):
            continue
        for a, b in cards_in(t):
            want += t[at:a] + brute(t[a:b], "k")[1]
            at = b
        assert r.text == want + t[at:], t
        assert r.n_card == len(cards_in(t))
        seen += 1
    assert seen > 200
    # a value of another kind inside a run that is no card
    got = pii.pseudonymise(spark.createDataFrame([("12 415-555-2671 34567",)], "text string"), "k").first()
    assert got.n_phone == 1 and "415-555-2671" not in got.text and got.text.startswith("12 ") and got.text.endswith(" 34567")


def test_numbers_that_are_no_cards_stay(spark):
    """Timestamps and most of other numbers keep their digits; cards in them don't. In a table of random integers of four
    digits one window of four in some fifty is a card by every rule."""
    rng = random.Random(11)
    table = "\n".join(" ".join(str(rng.randrange(1000, 10000)) for _ in range(12)) for _ in range(2500))
    stamps = "\n".join(f"time {1700000000000 + 37 * i}" for i in range(2000))
    identifiers = " ".join(f"id={rng.randrange(10 ** 15, 10 ** 16)};" for _ in range(1000))
    cards = [c + str(-luhn(c + "0") % 10) for c in ("4" + "".join(rng.choice("0123456789") for _ in range(14)) for _ in range(50))]
    rows = [(0, table), (1, stamps), (2, identifiers), (3, "\n".join(f"{rng.randrange(100)} {c} 12/27" for c in cards))]
    got = {r.i: r for r in pii.pseudonymise(spark.createDataFrame(rows, "i long, text string"), "k").collect()}
    assert got[1].text == stamps
    for i, bound in ((0, 0.05), (2, 0.03)):
        changed = sum(a != b for a, b in zip(rows[i][1], got[i].text)) / len(rows[i][1])
        assert len(rows[i][1]) == len(got[i].text) and changed < bound, changed
    assert got[3].n_card >= 50 and not any(c in got[3].text for c in cards)
