"""Personal data to format-preserving pseudonyms, by Feistel permutations in SQL expressions.

Every kind of value has a validity rule (the Luhn sum of card numbers, octets of
addresses, the calendar for dates and so on).  A valid value is permuted, under a
secret key, within its own format: each position keeps its alphabet, separators
stay, and a card's check digit is made anew.  The permutation is one-to-one, so
equal values stay linked across documents and different ones stay apart.

Method: a Feistel network over mixed radices.  The digits form two halves; in each
round one half takes, digit by digit and modulo each digit's radix, a keyed SHA-2
of the other.  A permutation may keep a value as it is by chance, so what is
applied is E^-1(E(x) + 1), which is one-to-one too and keeps none.

All of it is DataFrame functions: patterns find the values, ``split`` cuts the text
between them, higher-order functions permute them.  One narrow pass, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
DIGITS, LOWER, UPPER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Kind and pattern of the values, first match first.  Repeats that precede a needed
#: character are possessive behind a look-behind, so a long run is read once.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@(?:[A-Za-z0-9\-]+\.){1,16}[A-Za-z]{2,}",
    "secret": r"(?:token|secret|password|api_key)[ ]?[=:][ ]?\"[^\"\s]{8,}+\"",
    "hex": r"(?<![0-9A-Za-z])(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32})(?![0-9A-Za-z])",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9./\-])(?:(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])"
            r"|(?:0[1-9]|[12][0-9]|3[01])\.(?:0[1-9]|1[0-2])\.(?:19|20)[0-9]{2})(?![0-9]|[./\-][0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?<![0-9.\-])(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{3}\)[ .\-]?|[0-9]{3}[.\-])[0-9]{3}[ .\-][0-9]{4}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9])",
}
KINDS = list(PATTERNS)
#: Leading digits and lengths of the card networks' numbers, and the blocks that they are written in.
CARD_NUMBER = (r"^(?:4(?:[0-9]{12}|[0-9]{15}|[0-9]{18})"
               r"|5[1-5][0-9]{14}|2(?:22[1-9]|2[3-9][0-9]|[3-6][0-9]{2}|7[01][0-9]|720)[0-9]{12}"
               r"|3[47][0-9]{13}"
               r"|3(?:0[0-5]|[68][0-9])[0-9]{11}"
               r"|6(?:011|5[0-9]{2}|4[4-9][0-9])[0-9]{12,15}"
               r"|35(?:2[89]|[3-8][0-9])[0-9]{12,15}"
               r"|62[0-9]{14,17})$")
CARD_BLOCKS = (r"^(?:[0-9]+|[0-9]{4}(?:[ \-][0-9]{4}){2}[ \-][0-9]{1,4}|[0-9]{4}(?:[ \-][0-9]{4}){3}[ \-][0-9]{1,3}"
               r"|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{4,5})$")
#: Leading digits of a card that stay: they name the network.
ISSUER_DIGITS = 4
#: The kinds that begin with a digit, a sign or a bracket share one look ahead, so letters cost one test.
_NUMERIC = ("ip", "date", "ssn", "phone", "card")


def _any(numeric: list[str]) -> str:
    return "|".join([PATTERNS["email"], PATTERNS["secret"], "(?=[0-9a-f])" + PATTERNS["hex"],
                     "(?=[0-9(+])(?:" + "|".join(numeric) + ")"])


ANY = _any([PATTERNS[k] for k in _NUMERIC])
#: The same without cards, and around the card numbers of one text, longest first.
NO_CARDS = _any([PATTERNS[k] for k in _NUMERIC if k != "card"])
THESE_CARDS = _any([*[PATTERNS[k] for k in _NUMERIC if k != "card"], r"(?<![0-9])(?:<cards>)(?![0-9])"]).split("<cards>")
#: Runs of so many digits from each place where digits begin, to a place where digits end: the match is
#: only the first digit, so runs that overlap are all found.
CARD_RUNS = [rf"(?<![0-9])(?=([0-9](?:[ \-]?[0-9]){{{n - 1}}})(?![0-9]))[0-9]" for n in range(19, 12, -1)]
#: What each kind contains at the least: texts without any of it are done after one cheap scan.
NEEDED = ("[0-9@]", "[a-f]{32}|(?:token|secret|password|api_key)[ ]?[=:]")

#: Days from the first of 1900: this many are permuted among themselves, the rest of 2099 likewise.
FIRST_DAY, DAYS, SIDE, REST = "1900-01-01", 72_900, 270, 149


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _rounds(digits: Column, radices: Column, tweak: Column, forward: bool) -> Column:
    """The Feistel network over ``digits`` (array<int>) with ``radices``, or its inverse."""
    def step(state: Column, r: Column) -> Column:
        half = F.floor(F.size(state) / 2).cast("int")
        first = (r % 2) == 0  # even rounds move the first half by the second
        other = F.when(first, F.slice(state, half + 1, F.size(state))).otherwise(F.slice(state, F.lit(1), half))
        digest = F.sha2(F.concat_ws("|", tweak, r.cast("string"), F.array_join(other.cast("array<string>"), ",")), 512)

        def moved(d: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                key = F.conv(F.substring(d, (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int") + F.floor(i / 32).cast("int")
                there = F.pmod(x + key if forward else x - key, F.element_at(radices, i + 1))
                return F.when((i < half) == first, there).otherwise(x)
            return F.transform(state, one)
        return _let(digest, moved)

    order = F.array(*[F.lit(r) for r in (range(ROUNDS) if forward else range(ROUNDS - 1, -1, -1))])
    return F.aggregate(order, digits, step)


def permuted(digits: Column, radices: Column, tweak: Column) -> Column:
    """A one-to-one image of ``digits`` that never equals them; every radix must be 2 or more."""
    def with_radices(radix: Column) -> Column:
        n = F.size(radix)
        there = _rounds(digits, radix, tweak, True)
        next_ = _let(there, lambda s: F.concat(F.slice(s, F.lit(1), n - 1),
                                               F.array(F.pmod(F.element_at(s, n) + 1, F.element_at(radix, n)))))
        return _rounds(next_, radix, tweak, False)
    return _let(radices, with_radices)


def _in_alphabets(value: Column, alphabets: Column, tweak: Column) -> Column:
    """``value`` with the characters permuted whose alphabet (array<string>, one for each) isn't empty."""
    chars = F.filter(F.split(value, ""), lambda c: c != "")

    # what a lambda uses is bound before it: it would be made anew for each character
    def made(c: Column, a: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(a))
        fixed = F.filter(at, lambda i: F.length(F.element_at(a, i)) <= 1)

        def with_places(p: Column) -> Column:
            digits = F.transform(p, lambda i: _locate(F.element_at(a, i), F.element_at(c, i)))
            radices = F.transform(p, lambda i: F.length(F.element_at(a, i)))
            moved = F.zip_with(p, permuted(digits, radices, tweak), lambda i, d: _at(i, _nth(F.element_at(a, i), d)))
            kept = F.transform(fixed, lambda i: _at(i, F.element_at(c, i)))
            whole = F.array_join(F.transform(F.array_sort(F.concat(moved, kept)), lambda x: x["char"]), "")
            return F.when(F.size(p) == 0, value).otherwise(whole)
        return _let(F.filter(at, lambda i: F.length(F.element_at(a, i)) > 1), with_places)
    return _let(chars, lambda c: _let(alphabets, lambda a: made(c, a)))


def _at(place: Column, char: Column) -> Column:
    return F.struct(place.alias("place"), char.alias("char"))


def _nth(alphabet: Column, digit: Column) -> Column:
    return F.substring(alphabet, digit + 1, F.lit(1))


def _locate(alphabet: Column, char: Column) -> Column:
    return F.instr(alphabet, char) - 1


def _alphabets(value: Column, of) -> Column:
    """The alphabet of each character of ``value``, by ``of(character, index from 0)``."""
    return F.transform(F.filter(F.split(value, ""), lambda c: c != ""), of)


def _by_class(c: Column, _: Column | None = None) -> Column:
    return (F.when(c.between("0", "9"), F.lit(DIGITS)).when(c.between("a", "z"), F.lit(LOWER))
            .when(c.between("A", "Z"), F.lit(UPPER)).otherwise(F.lit("")))


def luhn_valid(digits: Column) -> Column:
    return F.pmod(_luhn(digits, 0), F.lit(10)) == 0


def _luhn(digits: Column, shift: int) -> Column:
    """Luhn sum, counting places from the right; with ``shift`` 1 as if a check digit followed."""
    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    worth = F.transform(chars, lambda c, i: F.when((i + shift) % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def is_card(value: Column) -> Column:
    """Whether digits in blocks are a card's: a network's leading digits, length and blocks, and the Luhn sum."""
    tidy = _digits(value)
    return value.rlike(CARD_BLOCKS) & tidy.rlike(CARD_NUMBER) & luhn_valid(tidy)


def _card(value: Column, tweak: Column) -> Column:
    """All but the network's digits, which every way of writing puts first, and a new check digit."""
    last = F.length(value)
    body = F.substring(value, F.lit(1), last - 1)
    moved = _in_alphabets(body, _alphabets(body, lambda c, i: F.when(i < ISSUER_DIGITS, F.lit("")).otherwise(_by_class(c))), tweak)
    return _let(moved, lambda m: F.concat(m, F.pmod(-_luhn(_digits(m), 1), F.lit(10)).cast("string")))


def _phone(value: Column, tweak: Column) -> Column:
    """The last ten digits; area and exchange keep first digits of 2 to 9, or their first digits where they break that rule."""
    start = F.length(value) - F.length(F.regexp_extract(value, r"\(?[0-9]{3}[)]?[ .\-]?[0-9]{3}[ .\-][0-9]{4}$", 0))
    local = F.substring(value, start + 1, F.length(value))
    tidy = _digits(local)
    proper = (F.substring(tidy, 1, 1) >= "2") & (F.substring(tidy, 4, 1) >= "2")

    def of(c: Column, i: Column) -> Column:
        nth = F.length(_digits(F.substring(local, F.lit(1), i + 1)))
        leads = nth.isin(1, 4)
        return F.when(~c.between("0", "9"), F.lit("")).when(
            leads, F.when(proper, F.lit("23456789")).otherwise(F.lit(""))).otherwise(F.lit(DIGITS))
    return F.concat(F.substring(value, F.lit(1), start), _in_alphabets(local, _alphabets(local, of), tweak))


def _ip(value: Column, tweak: Column) -> Column:
    octets = F.split(value, r"\.").cast("array<int>")
    radices = F.array(*[F.lit(256)] * 4)
    return F.array_join(permuted(octets, radices, tweak).cast("array<string>"), ".")


def _day(value: Column) -> Column:
    """Null where the calendar has no such day."""
    iso = F.when(F.substring(value, 5, 1) == "-", value).otherwise(
        F.concat_ws("-", F.substring(value, 7, 4), F.substring(value, 4, 2), F.substring(value, 1, 2)))
    return iso.try_cast("date")


def _date(value: Column, tweak: Column) -> Column:
    at = F.datediff(_day(value), F.lit(FIRST_DAY).cast("date"))
    early = permuted(F.array(F.floor(at / SIDE).cast("int"), at % SIDE), F.array(F.lit(SIDE), F.lit(SIDE)), tweak)
    late = permuted(F.array(at - DAYS), F.array(F.lit(REST)), tweak)
    there = F.when(at < DAYS, _let(early, lambda e: F.element_at(e, 1) * SIDE + F.element_at(e, 2))).otherwise(
        F.element_at(late, 1) + DAYS)
    made = F.date_add(F.lit(FIRST_DAY).cast("date"), there)
    return F.when(F.substring(value, 5, 1) == "-", F.date_format(made, "yyyy-MM-dd")).otherwise(
        F.date_format(made, "dd.MM.yyyy"))


def _email(value: Column, tweak: Column) -> Column:
    """The part before the @; the domain stays.  A part without ASCII letters or digits becomes a keyed name."""
    local, domain = F.regexp_extract(value, "^([^@]*)@", 1), F.regexp_extract(value, "(@.*)$", 1)
    moved = _in_alphabets(local, _alphabets(local, _by_class), tweak)
    named = F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", tweak, local), 256), 1, 16))
    return F.concat(F.when(local.rlike("[0-9A-Za-z]"), moved).otherwise(named), domain)


def _hex(value: Column, tweak: Column) -> Column:
    return _in_alphabets(value, _alphabets(value, lambda c, i: F.lit(HEX)), tweak)


def _secret(value: Column, tweak: Column) -> Column:
    """What stands between the quotation marks; hexadecimal stays hexadecimal."""
    head, body = F.regexp_extract(value, '^([^"]*")', 1), F.regexp_extract(value, '"(.*)"$', 1)
    moved = F.when(body.rlike("^[0-9a-f]+$"), _hex(body, tweak)).otherwise(
        F.when(body.rlike("[0-9A-Za-z]"), _in_alphabets(body, _alphabets(body, _by_class), tweak)).otherwise(
            F.substring(F.sha2(F.concat_ws("|", tweak, body), 256), F.lit(1), F.lit(16))))
    return F.concat(head, moved, F.lit('"'))


def _kind(value: Column) -> Column:
    """The kind of a matched value, null where its validity rule fails."""
    out = F.when(value.contains("@"), F.lit("email")).when(value.endswith('"'), F.lit("secret"))
    out = out.when(value.rlike(rf"^({_OCTET}\.){{3}}{_OCTET}$"), F.lit("ip"))
    out = out.when(value.rlike(r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})$"),
                   F.when(_day(value).isNotNull(), F.lit("date")))
    out = out.when(value.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), F.when(
        ~value.rlike(r"^(000|666|9)|^....00-|0000$"), F.lit("ssn")))
    # a run of 32 or more digits is hexadecimal too; card numbers have 19 at most
    out = out.when(value.rlike("^[0-9a-f]{32,}$"), F.lit("hex"))
    out = out.when(value.rlike(r"^(\+[0-9]{1,3}[ .\-]?)?(\([0-9]{3}\)[ .\-]?|[0-9]{3}[.\-])[0-9]{3}[ .\-][0-9]{4}$"), F.lit("phone"))
    return out.otherwise(F.when(is_card(value), F.lit("card")))


def _ssn(value: Column, tweak: Column) -> Column:
    """Area 1 to 665 and 667 to 899, group 1 to 99, serial 1 to 9999."""
    area, group, serial = (F.split(value, "-")[i].cast("int") for i in range(3))
    moved = permuted(F.array(area - F.when(area > 666, 2).otherwise(1), group - 1, serial - 1),
                     F.array(F.lit(898), F.lit(99), F.lit(9999)), tweak)
    return _let(moved, lambda m: F.format_string(
        "%03d-%02d-%04d", F.element_at(m, 1) + F.when(F.element_at(m, 1) >= 665, 2).otherwise(1),
        F.element_at(m, 2) + 1, F.element_at(m, 3) + 1))


_MADE = {"email": _email, "secret": _secret, "hex": _hex, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone,
         "card": _card}


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a value of a kind; the value itself where the kind is null."""
    out = value
    for k in reversed(KINDS):
        # a bare hexadecimal string and the same string in an assignment keep one pseudonym
        tweak = F.lit(f"{key}|{'hex' if k == 'secret' else k}")
        out = F.when(kind == k, _MADE[k](value, tweak)).otherwise(out)
    return out


def _is(kind: str):
    return lambda k: k == kind


def _scan(text: Column) -> Column:
    """The pattern that finds the values of ``text`` where a card pattern's longest run isn't a card's number.

    A shorter run in it may be a card: its numbers beside an expiry date, an order
    number and so on.  All runs of 13 to 19 digits that begin and end with a block
    of digits are tried, and those that pass stand in the pattern, longest first.
    """
    runs = F.array_distinct(F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in CARD_RUNS]))
    return _let(F.filter(runs, is_card), lambda cards: F.when(
        F.size(cards) > 0, F.concat(F.lit(THESE_CARDS[0]), F.array_join(cards, "|"), F.lit(THESE_CARDS[1]))).otherwise(
            F.lit(NO_CARDS)))


def _failed_card(value: Column, kind: Column) -> Column:
    return kind.isNull() & F.length(_digits(value)).between(13, 19)


def pseudonymise(docs: DataFrame, key: str, text: str = "text", counts: bool = True) -> DataFrame:
    """``docs`` with every valid personal value in ``text`` replaced by its pseudonym.

    With ``counts`` also ``n_<kind>`` for each kind (``KINDS``); columns of those
    names are replaced, and nothing else changes.  A text without such values,
    an empty and a null text stay as they are (all counts 0).  Numbers that fail
    their validity rule (a card's network, blocks and Luhn sum, a day that the calendar
    lacks) stay.
    Of the runs of digit blocks that pass as cards the first counts, then the longest.
    Repeated rows and repeated values change alike, in all documents.
    """
    made = [f"n_{k}" for k in KINDS] if counts else []
    docs = docs.drop(*[c for c in made if c != text])
    hit = (F.col(text).rlike(NEEDED[0]) | F.col(text).rlike(NEEDED[1])) & F.col(text).rlike(ANY)

    def found(pattern: Column, where: Column) -> Column:
        """The values and their kinds."""
        values = F.regexp_extract_all(F.col(text), pattern, F.lit(0))
        return F.when(where, _let(values, lambda vs: F.struct(vs.alias("values"), F.transform(vs, _kind).alias("kinds"))))

    first = docs.withColumn("_found", found(F.lit(ANY), hit))
    again = F.exists(F.arrays_zip("_found.values", "_found.kinds"), lambda x: _failed_card(x["values"], x["kinds"]))
    first = first.withColumn("_scan", F.when(again, _scan(F.col(text))))
    second = first.withColumn("_found", F.coalesce(found(F.col("_scan"), F.col("_scan").isNotNull()), "_found"))
    new = F.transform(F.arrays_zip("_found.values", "_found.kinds"), lambda x: pseudonym(x["values"], x["kinds"], key))
    between = F.when(F.col("_scan").isNull(), F.split(F.col(text), ANY, -1)).otherwise(
        F.split(F.col(text), F.col("_scan"), -1))
    joined = F.array_join(F.zip_with(between, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    out = second.withColumn(text, F.when(F.col("_found").isNull(), F.col(text)).otherwise(joined))
    for k in KINDS if counts else []:
        out = out.withColumn(f"n_{k}", F.coalesce(F.size(F.filter("_found.kinds", _is(k))), F.lit(0)))
    return out.drop("_found", "_scan")
