"""Personal data replaced by format-preserving pseudonyms, with column functions only.

Each validated number or date is written as a pair of digits to two bases and permuted by a keyed Feistel
network over exactly those bases. The pseudonym is then again a valid value of the same format, different
values stay different, and equal values get equal pseudonyms in every document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# The patterns. Each starts where it cannot start again further right, so scans stay linear.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4})(?![0-9])"
PHONE = r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IP = rf"(?<![0-9])(?<![0-9]\.)(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
YEAR, MONTH, DAY = r"(?:1[89]|2[01])[0-9]{2}", r"(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12][0-9]|3[01])"
DATE = rf"(?<![0-9])(?:{YEAR}([-/.]){MONTH}\1{DAY}|{DAY}([-/.]){MONTH}\2{YEAR})(?![0-9])"

KINDS = ("email", "date", "ssn", "phone", "card", "ip")
PATTERNS = {"email": EMAIL, "date": DATE, "ssn": SSN, "phone": PHONE, "card": CARD, "ip": IP}
ANY = "|".join(f"(?:{PATTERNS[k]})" for k in KINDS)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once however often it is named."""
    return F.transform(F.array(value), use)[0]


def _mix(key: str, tweak: str, turn: Column, half: Column) -> Column:
    """A keyed 60-bit number of a round and one half."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), turn.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(x: Column, y: Column, a: Column, b: Column, key: str, tweak: str) -> Column:
    """Struct (x, y): the keyed permutation of the pairs with 0 <= x < a, 0 <= y < b."""

    def turn(s: Column, i: Column) -> Column:
        return F.when(
            i % 2 == 0, F.struct(F.pmod(s["x"] + _mix(key, tweak, i, s["y"]), a).alias("x"), s["y"].alias("y"))
        ).otherwise(F.struct(s["x"].alias("x"), F.pmod(s["y"] + _mix(key, tweak, i, s["x"]), b).alias("y")))

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _into(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced, in order, by those of ``digits``; marks stay where they are."""
    marks = F.split(value, "[0-9]")
    return F.concat(
        F.array_join(F.zip_with(marks, F.split(digits, ""), lambda m, d: F.concat(m, F.coalesce(d, F.lit("")))), "")
    )


def _pad(number: Column, width: Column | int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum, doubling every second digit from the right; ``doubled`` 0 doubles the last one too."""

    def step(total: Column, c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == doubled, twice).otherwise(d)

    placed = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    return F.aggregate(placed, F.lit(0), lambda t, p: step(t, p["c"], p["i"]))


def luhn_valid(digits: Column) -> Column:
    return _luhn_sum(digits, 1) % 10 == 0


def card(value: Column, key: str) -> Column:
    """All digits but the last are permuted; the last is the check digit of the new ones."""

    def make(digits: Column) -> Column:
        width = F.length(digits) - 1
        left = F.floor(width / 2).cast("int")
        base = lambda n: F.pow(F.lit(10), n).cast("long")
        pair = feistel(
            F.substr(digits, F.lit(1), left), F.substr(digits, left + 1, width - left), base(left), base(width - left), key, "card"
        )
        body = bind(pair, lambda p: F.concat(_pad(p["x"], left), _pad(p["y"], width - left)))
        whole = bind(body, lambda d: F.concat(d, F.pmod(-_luhn_sum(d, 0), F.lit(10)).cast("string")))
        return F.when(luhn_valid(digits), _into(value, whole)).otherwise(value)

    return bind(_digits(value), make)


def phone(value: Column, key: str) -> Column:
    """The last ten digits are permuted; a country code stays."""

    def make(digits: Column) -> Column:
        last = F.substring(digits, -10, 10)
        pair = feistel(F.substring(last, 1, 5), F.substring(last, 6, 5), F.lit(100_000), F.lit(100_000), key, "phone")
        code = F.substr(digits, F.lit(1), F.length(digits) - 10)
        return _into(value, bind(pair, lambda p: F.concat(code, _pad(p["x"], 5), _pad(p["y"], 5))))

    return bind(_digits(value), make)


def ssn(value: Column, key: str) -> Column:
    """Permuted among the numbers that can be issued: no area 000, 666 or 9xx, no group 00, no serial 0000."""
    area = F.substring(value, 1, 3).cast("long")
    area = area - F.when(area > 666, 2).otherwise(1)
    pair = feistel(
        area * 99 + F.substring(value, 5, 2).cast("long") - 1, F.substring(value, 8, 4).cast("long") - 1,
        F.lit(898 * 99), F.lit(9999), key, "ssn",
    )

    def write(p: Column) -> Column:
        place = F.floor(p["x"] / 99) + 1
        place = place + F.when(place >= 666, 1).otherwise(0)
        return F.concat_ws("-", _pad(place, 3), _pad(p["x"] % 99 + 1, 2), _pad(p["y"] + 1, 4))

    return bind(pair, write)


def ip(value: Column, key: str) -> Column:
    """Permuted among all addresses."""

    def make(parts: Column) -> Column:
        part = lambda i: F.get(parts, F.lit(i)).cast("long")
        pair = feistel(part(0) * 256 + part(1), part(2) * 256 + part(3), F.lit(65_536), F.lit(65_536), key, "ip")
        write = lambda p: F.concat_ws(
            ".", *[x.cast("string") for h in ("x", "y") for x in (F.floor(p[h] / 256), p[h] % 256)]
        )
        return bind(pair, write)

    return bind(F.split(value, r"\."), make)


def date(value: Column, key: str) -> Column:
    """Permuted among the days of 1800 to 2199 (146,097 = 189 * 773), written as it was; no such day stays."""
    mark = F.regexp_extract(value, "[-/.]", 0)
    first = F.regexp_like(value, F.lit("^[0-9]{4}"))
    parts = F.split(value, "[-/.]")
    ymd = F.when(first, F.array_join(parts, "-")).otherwise(F.array_join(F.reverse(parts), "-"))
    origin = F.to_date(F.lit("1800-01-01"))
    day = F.datediff(F.try_to_date(ymd, "yyyy-MM-dd"), origin)

    def make(n: Column) -> Column:
        pair = feistel(F.floor(n / 773), n % 773, F.lit(189), F.lit(773), key, "date")
        new = bind(pair, lambda p: F.date_add(origin, (p["x"] * 773 + p["y"]).cast("int")))
        made = bind(F.split(new.cast("string"), "-"), lambda p: F.array_join(F.when(first, p).otherwise(F.reverse(p)), "\0"))
        return F.when(n.isNull(), value).otherwise(F.replace(made, F.lit("\0"), mark))

    return bind(day, make)


def email(value: Column, key: str) -> Column:
    """A keyed name at a domain that cannot exist; case does not count."""
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat(F.lit(key + "|email|"), F.lower(value)), 256), 1, 20), F.lit("@mail.invalid"))


MAKERS = {"email": email, "date": date, "ssn": ssn, "phone": phone, "card": card, "ip": ip}


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one match, by the first kind whose pattern it is as a whole."""
    out = value
    for kind in reversed(KINDS):
        out = F.when(F.regexp_like(value, F.lit(f"^(?:{PATTERNS[kind]})$")), MAKERS[kind](value, key)).otherwise(out)
    return out


def mask(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, personal data in the text replaced; null and empty texts stay as they are.

    Dates that no calendar has and card numbers whose check digit is wrong stay. Rows are independent: order,
    repeated rows and other columns do not matter, and nothing is shuffled.
    """
    text = F.col(text_col)
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    new = F.transform(found, lambda m: pseudonym(m, key))
    # The text between matches, and behind each piece of it the match's pseudonym.
    joined = F.array_join(
        F.zip_with(F.split(text, ANY), new, lambda t, n: F.concat(t, F.coalesce(n, F.lit("")))), ""
    )
    # Every pattern needs a digit or an at sign, and most texts have neither.
    some = F.regexp_like(text, F.lit("[0-9@]")) & F.regexp_like(text, F.lit(ANY))
    masked = F.when(some, joined).otherwise(text)
    return docs.withColumn(text_col, masked)


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """Per document: its text with pseudonyms, and whether any stand in it."""
    before = docs.select("doc_id", F.col("text").alias("before"), "text")
    changed = ~F.col("before").eqNullSafe(F.col("text"))
    return mask(before, key).select("doc_id", "text", changed.alias("changed"))
