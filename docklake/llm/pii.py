"""Format-preserving pseudonyms of personal data: keyed Feistel permutations of validated numbers, dates and names of mail.

Everything is a column expression. A value is cut in two halves; each round moves one half by a keyed hash of the other,
character by character within its class (digit, small letter, capital) or as a number below a bound. This is a
permutation of the values of one format, so equal values get equal pseudonyms in all documents and different ones
differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docklake.llm.common import free_name

ROUNDS = 8
# First code point and size of the classes that a character stays in.
CLASSES = ((48, 10), (97, 26), (65, 26), (0xE0, 23), (0xC0, 23), (0xF8, 7), (0xD8, 7))
# A 400-year cycle of the calendar has 146,097 days, which is 189 * 773.
DATES_FROM, DATES_TO, DATE_BOUNDS = "1800-01-01", "2199-12-31", (189, 773)

SECRET = r"(?=[A-Za-z0-9_\-]{16})(?<=(?i:token|secret|password|passwd|api_key|apikey)[ \t]{0,3}[=:][ \t]{0,3}[\"']?)[A-Za-z0-9_\-]+"
# The part before the @ is tried once, from where its run of characters starts; names of hosts are bounded as they are
# on the net (63 characters, 126 labels). So no text takes more than linear time or a deep stack.
MAIL = r"(?<![\p{L}\p{N}._+\-])[\p{L}\p{N}._+\-]++@(?:[\p{L}\p{N}\-]{1,63}+\.){1,126}\p{L}{2,63}"
DATE = r"(?<![\d.\-/])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d\-/]|\.\d)"
ADDRESS = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
PHONE = r"(?<!\d)(?:\+?\d{1,3}[ .\-]?)?(?:\(\d{3}\)[ .\-]?|\d{3}[ .\-])\d{3}[ .\-]\d{4}(?![\d\-])"
SOCIAL = r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"
# Card numbers as printed: in fours, 4-6-5, 4-6-4 or in one; a last short group may also be a check code that follows.
PRINTED = (
    r"(?:[2-6]\d{3}[ \-]\d{4}[ \-]\d{4}[ \-]\d{4}(?:[ \-]\d{3}(?![ .\-/]?\d))?|3\d{3}[ \-]\d{6}[ \-]\d{4,5}"
    r"|[2-6]\d{12,18})(?!\d)"
)
CARD = r"(?<!\d)(?:" + PRINTED + r"|\d(?:(?![ \-]" + PRINTED + r")[ \-]?\d){12,18}(?!\d))"
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
OF_COUNTRY = "|".join(rf"(?:{names.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]){{{size - 4}}}" for size, names in IBAN_LENGTHS.items())
IBAN = r"(?<![A-Za-z0-9])(?:" + OF_COUNTRY + r"|[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])"
ANY = "|".join((SECRET, MAIL, DATE, ADDRESS, SOCIAL, PHONE, CARD, IBAN))


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _moved_text(part: Column, other: Column, round_: Column, key: str, kind: str) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), round_.cast("string"), F.lower(other)), 512)

    def moved(hash_: Column) -> Column:
        def one(char: Column, at: Column) -> Column:
            step = F.conv(F.substr(hash_, at % 64 * 2 + 1, F.lit(2)), 16, 10).cast("int")
            code = F.ascii(char)
            result = char
            for first, size in CLASSES:
                result = F.when(code.between(first, first + size - 1), F.char(first + (code - first + step) % size)).otherwise(result)
            return result

        return F.array_join(F.transform(F.split(part, ""), one), "")

    return _bound(digest, moved)


def permuted_text(value: Column, key: str, kind: str) -> Column:
    """``value`` with each character moved within its class."""
    half = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), half).alias("a"), F.substr(value, half + 1, F.length(value)).alias("b"))

    def step(state: Column, round_: Column) -> Column:
        odd = round_ % 2 == 1
        return F.struct(
            F.when(odd, _moved_text(state["a"], state["b"], round_, key, kind)).otherwise(state["a"]).alias("a"),
            F.when(odd, state["b"]).otherwise(_moved_text(state["b"], state["a"], round_, key, kind)).alias("b"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["a"], s["b"]))


def permuted_number(a: Column, b: Column, bounds: tuple[int, int], key: str, kind: str) -> Column:
    """The struct ``(a, b)``, ``a`` and ``b`` below their bounds, permuted."""

    def moved(part: Column, other: Column, round_: Column, bound: int) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), round_.cast("string"), other.cast("string")), 256)
        return (part + F.conv(F.substr(digest, F.lit(1), F.lit(12)), 16, 10).cast("long")) % bound

    def step(state: Column, round_: Column) -> Column:
        odd = round_ % 2 == 1
        return F.struct(
            F.when(odd, moved(state["a"], state["b"], round_, bounds[0])).otherwise(state["a"]).alias("a"),
            F.when(odd, state["b"]).otherwise(moved(state["b"], state["a"], round_, bounds[1])).alias("b"),
        )

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _refilled(value: Column, characters: Column, kept: str) -> Column:
    """``value`` whose characters of the class ``kept`` are replaced by ``characters``, in order."""
    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("at"))

    def step(state: Column, char: Column) -> Column:
        fits = char.rlike(kept)
        return F.struct(
            F.concat(state["text"], F.when(fits, F.substr(characters, state["at"], F.lit(1))).otherwise(char)).alias("text"),
            F.when(fits, state["at"] + 1).otherwise(state["at"]).alias("at"),
        )

    return F.aggregate(F.split(value, ""), start, step, lambda s: s["text"])


def _luhn_sum(digits: Column) -> Column:
    """The Luhn sum, from the last digit backwards; every second one counts double."""

    def weight(char: Column, at: Column) -> Column:
        digit = char.cast("int")
        return F.when(at % 2 == 0, digit).otherwise(digit * 2 - F.when(digit > 4, 9).otherwise(0))

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), weight), F.lit(0), lambda s, x: s + x)


def _first_valid(value: Column, ends: list[Column], made) -> Column:
    """``made`` of the first beginning of ``value`` for which it is not null, what follows stays; else ``value``."""
    heads = F.array(*(F.when(end > 0, F.substr(value, F.lit(1), end)) for end in ends))
    tried = F.filter(F.transform(heads, lambda head: F.concat(made(head), F.substr(value, F.length(head) + 1, F.length(value)))), lambda x: x.isNotNull())
    return F.coalesce(F.get(tried, F.lit(0)), value)


def _card(value: Column, key: str) -> Column:
    """A number of four fours, if it passes the check, else the whole; digits after the four fours are a code of their own."""
    fours = F.length(F.regexp_extract(value, r"^\d{4}([ \-]\d{4}){3}(?=[ \-])", 0))
    return _first_valid(value, [fours, F.length(value)], lambda head: _checked_card(head, key))


def _checked_card(value: Column, key: str) -> Column:
    """All digits but the first move, the last is the new check digit; null for a number that fails the check."""
    digits = _digits(value)
    body = F.concat(F.substr(digits, F.lit(1), F.lit(1)), permuted_text(F.substr(digits, F.lit(2), F.length(digits) - 2), key, "card"))

    def checked(own: Column) -> Column:
        check = (10 - _luhn_sum(F.concat(own, F.lit("0"))) % 10) % 10
        return _refilled(value, F.concat(own, check.cast("string")), r"\d")

    return F.when(_luhn_sum(digits) % 10 == 0, _bound(body, checked))


def _remainder(account: Column) -> Column:
    """The remainder modulo 97 of an account number read with letters as 10 to 35."""

    def step(state: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 65, (state * 10 + code - 48) % 97).otherwise((state * 100 + code - 55) % 97)

    return F.aggregate(F.split(account, ""), F.lit(0), step)


def _iban(value: Column, key: str) -> Column:
    """The longest number that passes the check: the whole, or what ends before a space; words after it stay."""
    ends = [F.length(value), *(F.length(F.regexp_extract(value, rf"^(.*?)(?: [A-Z0-9]+){{{n}}}$", 1)) for n in range(1, 9))]
    return _first_valid(value, [F.when(end >= 15, end) for end in ends], lambda head: _checked_iban(head, key))


def _checked_iban(value: Column, key: str) -> Column:
    """Country and format stay, the rest moves and the check digits follow; null for a number that fails the check."""
    plain = F.regexp_replace(value, " ", "")
    country, rest = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5), F.length(plain))
    valid = _remainder(F.concat(rest, F.substr(plain, F.lit(1), F.lit(4)))) == 1

    def checked(own: Column) -> Column:
        check = F.lpad((98 - _remainder(F.concat(own, country, F.lit("00")))).cast("string"), 2, "0")
        return _refilled(value, F.concat(country, check, own), r"[A-Z0-9]")

    return F.when(valid, _bound(permuted_text(rest, key, "iban"), checked))


def _address(value: Column, key: str) -> Column:
    """Numbers of four octets; one above 255 leaves the value as it is."""
    parts = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    high, low = parts[0] * 256 + parts[1], parts[2] * 256 + parts[3]
    made = _bound(
        permuted_number(high, low, (65536, 65536), key, "address"),
        lambda x: F.concat_ws(".", *((F.floor(x[half] / 256) if first else x[half] % 256).cast("string") for half in "ab" for first in (True, False))),
    )
    return F.when(F.array_max(parts) <= 255, made).otherwise(value)


def _social(value: Column, key: str) -> Column:
    """Numbers with a valid area, group and serial number; others stay."""
    area, group, serial = (part.cast("int") for part in (F.substr(value, F.lit(1), F.lit(3)), F.substr(value, F.lit(5), F.lit(2)), F.substr(value, F.lit(8), F.lit(4))))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    rank = area - F.when(area > 666, 2).otherwise(1)

    def made(x: Column) -> Column:
        number = F.floor(x["a"] / 99)
        parts = (number + F.when(number >= 665, 2).otherwise(1), x["a"] % 99 + 1, x["b"] + 1)
        return F.concat_ws("-", *(F.lpad(part.cast("string"), n, "0") for part, n in zip(parts, (3, 2, 4), strict=True)))

    return F.when(valid, _bound(permuted_number(rank * 99 + group - 1, serial - 1, (898 * 99, 9999), key, "social"), made)).otherwise(value)


def _date(value: Column, key: str) -> Column:
    """Days of the years 1800 to 2199 in three formats; other dates and days that don't exist stay."""
    first, last = F.lit(DATES_FROM).cast("date"), F.lit(DATES_TO).cast("date")

    def of_form(form: str) -> Column:
        def made(day: Column) -> Column:
            number = F.datediff(day, first)
            moved = _bound(
                permuted_number(F.floor(number / DATE_BOUNDS[1]), number % DATE_BOUNDS[1], DATE_BOUNDS, key, "date"),
                lambda x: F.date_format(F.date_add(first, (x["a"] * DATE_BOUNDS[1] + x["b"]).cast("int")), form),
            )
            return F.when(day.between(first, last), moved).otherwise(value)

        return _bound(F.to_date(F.try_to_timestamp(value, F.lit(form))), made)

    return (
        F.when(value.rlike("-"), of_form("yyyy-MM-dd")).when(value.rlike("/"), of_form("MM/dd/yyyy"))
        .otherwise(of_form("dd.MM.yyyy"))
    )


def _phone(value: Column, key: str) -> Column:
    """The last ten digits move, so that a number is known again in another layout; the country code stays."""
    digits = _digits(value)
    return _refilled(value, F.concat(F.substr(digits, F.lit(1), F.length(digits) - 10), permuted_text(F.right(digits, F.lit(10)), key, "phone")), r"\d")


def _mail(value: Column, key: str) -> Column:
    """Everything before the last dot moves."""
    name = F.regexp_extract(value, r"^(.*)\.[^.]*$", 1)
    return F.concat(permuted_text(name, key, "mail"), F.substr(value, F.length(name) + 1, F.length(value)))


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one found value; what fails the check of its kind stays as it is."""
    whole = lambda pattern: value.rlike("^(?:" + pattern + ")$")
    return (
        F.when(value.contains("@"), _mail(value, key))
        .when(whole(DATE), _date(value, key))
        .when(whole(ADDRESS), _address(value, key))
        .when(whole(SOCIAL), _social(value, key))
        .when(whole(PHONE), _phone(value, key))
        .when(whole(CARD), _card(value, key))
        .when(whole(IBAN), _iban(value, key))
        .otherwise(permuted_text(value, key, "secret"))
    )


def pseudonymised(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` whose ``text`` has pseudonyms for personal data, in all columns it had; ``count`` adds how many differ.

    Found are mail addresses, telephone and card numbers (check digit), IBANs (check digits), IPv4 addresses, US social
    security numbers, dates (1800 to 2199; ISO, with dots day first, with slashes month first) and values after
    ``token =`` and the like. Whole texts are read; a null text stays null, an empty one empty, and texts without digits,
    ``@`` or a secret are left alone before any other pattern is tried. Rows are independent, so nothing is shuffled.
    """
    found, made = free_name(docs, "found_values"), free_name(docs, "made_values")
    has_any = F.col(text).rlike("[0-9@]|" + SECRET)
    marked = docs.withColumn(found, F.when(has_any, F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0))))
    some = F.size(found) > 0
    marked = marked.withColumn(made, F.when(some, F.transform(found, lambda value: pseudonym(value, key))))
    between = F.split(F.col(text), ANY, -1)
    joined = F.array_join(F.zip_with(between, F.concat(F.col(made), F.array(F.lit(""))), lambda x, y: F.concat(x, y)), "")
    result = marked.withColumn(text, F.when(some, joined).otherwise(F.col(text)))
    if count:
        changed = F.size(F.filter(F.arrays_zip(found, made), lambda x: x[found] != x[made]))
        result = result.withColumn(count, F.when(some, changed).otherwise(0))
    return result.drop(found, made)
