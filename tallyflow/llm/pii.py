"""Format-preserving pseudonyms for personal numbers, dates, addresses and secrets, by Feistel permutations.

A value becomes a list of digits, each with its own radix, and a keyed Feistel
network permutes all lists of the same radices.  The image is written in the
value's own format.  Equal values get equal pseudonyms in all documents,
different values get different ones, and nobody can turn them back without the
key.  All of it is Spark SQL functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

#: Fixed patterns, by kind, in the order in which they are tried.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
ISO_DATE = r"(?<![0-9])(?:18|19|20|21)[0-9]{2}[-/](?:0[1-9]|1[0-2])[-/](?:0[1-9]|[12][0-9]|3[01])(?![0-9])"
DAY_FIRST = r"(?<![0-9])(?:0[1-9]|[12][0-9]|3[01])\.(?:0[1-9]|1[0-2])\.(?:18|19|20|21)[0-9]{2}(?![0-9])"
MONTH_FIRST = r"(?<![0-9])(?:0[1-9]|1[0-2])/(?:0[1-9]|[12][0-9]|3[01])/(?:18|19|20|21)[0-9]{2}(?![0-9])"
PHONE = (
    r"\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
    r"|(?:\([0-9]{3}\) ?|(?<![0-9-])(?:1-)?[0-9]{3}-)[0-9]{3}-[0-9]{4}(?![0-9]|-[0-9])"
)
#: Numbers that are given out: no area 000, 666 or from 900 on, no group 00, no serial 0000.
SOCIAL = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9]|-[0-9])"
#: Groups of four, or 4-6-5, or a plain run.
CARD = (
    r"(?<![0-9A-Za-z])[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z])[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])"
)
SECRET = r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])"
_BEFORE_CARDS = "|".join(f"(?:{p})" for p in (EMAIL, IPV4, ISO_DATE, DAY_FIRST, MONTH_FIRST, SOCIAL, PHONE))

_FIRST_DAY, _DAYS = "1800-01-01", (27, 5411)  # 400 years of the calendar are 27 * 5411 days


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _stream(half: Column, radix: Column, number: Column, key: str, kind: str) -> Column:
    """Keyed digits below the radices, made from the other half of the value."""
    seed = F.concat_ws("|", F.lit(key), F.lit(kind), number.cast("string"), F.array_join(half.cast("array<string>"), ","))

    def digit(r: Column, i: Column) -> Column:
        block = F.sha2(F.concat_ws("#", seed, F.floor(i / 7).cast("string")), 256)
        return F.pmod(F.conv(F.substring(block, (i % 7) * 9 + 1, F.lit(9)), 16, 10).cast("long"), r)

    return F.transform(radix, digit)


def permute(digits: Column, radix: Column, key: str, kind: str) -> Column:
    """A keyed permutation of the lists of digits below the given radices (both arrays of longs, of one length).

    An alternating Feistel network: the halves take turns in having keyed digits
    made from the other half added to them, digit by digit modulo the radix.
    """
    half = F.floor(F.size(digits) / 2).cast("int")

    def part(array: Column, right: bool) -> Column:
        return F.slice(array, half + 1, F.size(array) - half) if right else F.slice(array, F.lit(1), half)

    def step(state: Column, number: Column) -> Column:
        def add(mine: str, other: str, right: bool) -> Column:
            r = part(radix, right)
            total = F.zip_with(state[mine], _stream(state[other], r, number, key, kind), lambda a, b: a + b)
            return F.zip_with(total, r, lambda a, b: F.pmod(a, b))

        left = F.when(number % 2 == 0, add("l", "r", False)).otherwise(state["l"])
        right = F.when(number % 2 == 1, add("r", "l", True)).otherwise(state["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    start = F.struct(part(digits, False).alias("l"), part(digits, True).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s["l"], s["r"]))


_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _characters(value: Column, classes: tuple[str, ...], key: str, kind: str) -> Column:
    """The value with its characters of the given classes permuted, each within its class; others stay in place."""

    def spot(c: Column) -> Column:
        found = F.struct(F.lit("").alias("of"), F.lit(0).cast("long").alias("digit"))
        for of in classes:
            at = F.instr(F.lit(of), c).cast("long")
            found = F.when(at > 0, F.struct(F.lit(of).alias("of"), (at - 1).alias("digit"))).otherwise(found)
        return F.struct(c.alias("c"), found["of"].alias("of"), found["digit"].alias("digit"))

    def rewrite(spots: Column) -> Column:
        moved = F.filter(spots, lambda s: s["of"] != "")
        image = permute(F.transform(moved, lambda s: s["digit"]), F.transform(moved, lambda s: F.length(s["of"]).cast("long")), key, kind)

        def place(digits: Column) -> Column:
            def one(s: Column, i: Column) -> Column:
                earlier = F.size(F.filter(F.slice(spots, F.lit(1), i + 1), lambda e: e["of"] != ""))
                return F.when(s["of"] == "", s["c"]).otherwise(F.substring(s["of"], (F.get(digits, earlier - 1) + 1).cast("int"), F.lit(1)))

            return F.array_join(F.transform(spots, one), "")

        return _let(image, place)

    return _let(F.transform(F.split(value, ""), spot), rewrite)


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of an array of digits that a check digit is to follow."""
    n = F.size(digits)

    def weigh(d: Column, i: Column) -> Column:
        twice = F.when((n - i) % 2 == 1, d * 2).otherwise(d)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(digits, weigh), F.lit(0).cast("long"), lambda a, b: a + b)


def valid_card(value: Column) -> Column:
    """Whether the Luhn sum of the digits holds."""
    digits = F.split(F.regexp_replace(value, "[^0-9]", ""), "").cast("array<long>")
    return _let(digits, lambda d: (luhn_sum(F.slice(d, F.lit(1), F.size(d) - 1)) + F.element_at(d, -1)) % 10 == 0)


def value_pattern(text: Column) -> Column:
    """The pattern of all personal values of a text.

    Whether a number is a card number no pattern can tell.  So everything that
    looks like one is taken by look-ahead at every place where it may start, what
    fails the Luhn sum is left out, and the others stand in the pattern as they
    are.  A number that fails so cannot hide a valid one that starts inside it.
    """
    like = F.regexp_extract_all(text, F.lit(f"(?=({CARD}))"), F.lit(1))
    cards = F.when(text.rlike(CARD), F.filter(F.array_distinct(like), valid_card)).otherwise(F.array().cast("array<string>"))

    def build(found: Column) -> Column:
        some = F.concat(
            F.lit(f"{_BEFORE_CARDS}|(?:(?<![0-9A-Za-z])(?:"), F.array_join(found, "|"), F.lit(f")(?![0-9A-Za-z]))|(?:{SECRET})")
        )
        return F.when(F.size(found) == 0, F.lit(f"{_BEFORE_CARDS}|(?:{SECRET})")).otherwise(some)

    return _let(cards, build)


def _card(value: Column, key: str) -> Column:
    """Digits but the last permuted; the last keeps its distance from the right check digit, so valid numbers stay valid."""

    def rewrite(digits: Column) -> Column:
        n = F.size(digits)
        body, last = F.slice(digits, F.lit(1), n - 1), F.element_at(digits, n)

        def finish(image: Column) -> Column:
            check = F.pmod(last + luhn_sum(body) - luhn_sum(image), F.lit(10))
            text = F.array_join(F.concat(image, F.array(check)).cast("array<string>"), "")

            def one(c: Column, i: Column) -> Column:
                before = F.length(F.regexp_replace(F.substring(value, F.lit(1), i + 1), "[^0-9]", ""))
                return F.when(c.rlike("[0-9]"), F.substring(text, before, F.lit(1))).otherwise(c)

            return F.array_join(F.transform(F.split(value, ""), one), "")

        return _let(permute(body, F.transform(body, lambda _: F.lit(10).cast("long")), key, "card"), finish)

    return _let(F.split(F.regexp_replace(value, "[^0-9]", ""), "").cast("array<long>"), rewrite)


def _date(value: Column, pattern: str, key: str) -> Column:
    """Another day of the four centuries from 1800 in the same format; what is no day of the calendar stays."""

    def rewrite(day: Column) -> Column:
        number = F.datediff(day, F.lit(_FIRST_DAY).cast("date")).cast("long")
        big = F.lit(_DAYS[1]).cast("long")
        image = permute(
            F.array(F.floor(number / big), number % big), F.array(F.lit(_DAYS[0]).cast("long"), big), key, "date"
        )
        moved = _let(image, lambda d: F.date_add(F.lit(_FIRST_DAY).cast("date"), (d[0] * big + d[1]).cast("int")))
        return F.when(day.isNull(), value).otherwise(F.date_format(moved, pattern))

    return _let(F.try_to_timestamp(value, F.lit(pattern)).cast("date"), rewrite)


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one value that `value_pattern` finds."""
    whole = lambda p: value.rlike(f"^(?:{p})$")
    email = F.concat(
        _characters(F.substring_index(value, "@", 1), _CLASSES, key, "email"), F.lit("@"), F.substring_index(value, "@", -1)
    )
    octets = F.split(value, r"\.").cast("array<long>")
    ipv4 = F.array_join(permute(octets, F.transform(octets, lambda _: F.lit(256).cast("long")), key, "ipv4").cast("array<string>"), ".")
    country = F.regexp_extract(value, r"^(?:\+[0-9]{1,3}(?=[ .(-])|1(?=-[0-9]{3}-[0-9]{3}-))", 0)
    # A number without a gap after its country code has all digits but the first permuted.
    plain = F.when((country == "") & value.startswith("+"), F.substring(value, F.lit(1), F.lit(2))).otherwise(country)
    rest = F.substring(value, F.length(plain) + 1, F.length(value))
    phone = F.concat(plain, _characters(rest, _CLASSES[:1], key, "phone"))
    return (
        F.when(value.contains("@"), email)
        .when(whole(IPV4), ipv4)
        .when(whole(ISO_DATE) & value.contains("-"), _date(value, "yyyy-MM-dd", key))
        .when(whole(ISO_DATE), _date(value, "yyyy/MM/dd", key))
        .when(whole(DAY_FIRST), _date(value, "dd.MM.yyyy", key))
        .when(whole(MONTH_FIRST), _date(value, "MM/dd/yyyy", key))
        .when(whole(SOCIAL), _characters(value, _CLASSES[:1], key, "social"))
        .when(whole(PHONE), phone)
        .when(whole(CARD), _card(value, key))
        .when(value.rlike("[A-F]"), _characters(value, ("0123456789ABCDEF",), key, "secret"))
        .otherwise(_characters(value, ("0123456789abcdef",), key, "secret"))
    )


def with_pseudonyms(docs: DataFrame, text_col: str = "text", key: str = "change-me", count_col: str | None = None) -> DataFrame:
    """`docs` with every personal value in the text replaced by its pseudonym; other characters stay.

    `count_col` adds the number of values found.  Emails keep their domain,
    phones their country code, numbers their Luhn validity, dates stay dates; a
    date that the calendar lacks stays.  Runs like card or social security
    numbers that cannot be such stay, are not counted, and hide no valid number
    that starts inside them; of valid numbers that overlap, the first one counts.  Null texts stay null, with count 0, and
    empty ones empty.  Rows, also repeated ones, and all other columns stay.
    """
    text = F.col(text_col)
    # Most texts hold neither a digit nor an address, and are not looked at again.
    touched = text.rlike("[0-9@]|[0-9a-fA-F]{32}")
    none = F.array().cast("array<string>")

    def look(pattern: Column) -> Column:
        values = F.regexp_extract_all(text, pattern, F.lit(0))
        return F.struct(values.alias("values"), F.when(F.size(values) > 0, F.split(text, pattern, -1)).alias("gaps"))

    found = F.when(touched, _let(value_pattern(text), look)).otherwise(F.struct(none.alias("values"), none.alias("gaps")))

    def rebuild(values: Column, gaps: Column) -> Column:
        images = F.concat(F.transform(values, lambda v: pseudonym(v, key)), F.array(F.lit("")))
        return F.array_join(F.zip_with(gaps, images, lambda a, b: F.concat(a, b)), "")

    image = F.when(touched, _let(found, lambda f: F.when(F.size(f["values"]) == 0, text).otherwise(rebuild(f["values"], f["gaps"])))).otherwise(text)
    out = docs if count_col is None else docs.withColumn(count_col, F.when(touched, F.size(found["values"])).otherwise(F.lit(0)))
    return out.withColumn(text_col, image)
