"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Values found in a text are validated (check sums, ranges, calendar), taken
apart into symbols with a radix each (digits 10, letters 26, octets 256), and
permuted by a keyed Feistel network over the symbols: in each round one half
is shifted, modulo its radixes, by a hash of the key, the kind, the round and
the other half. That is a permutation of the values of one format, so equal
values stay equal in every document and different ones stay different; signs
between the symbols stay, check digits are computed anew, and dates stay
dates in their own format (order, signs, digits of day and month). All of it is column expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Key used when none is given; production jobs pass their own secret.
DEMO_KEY = "pseudonym-demo-key"
ROUNDS = 10

#: Kinds in the order in which they are tried; patterns of whole values.
KINDS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}|\+[1-9](?:[ ()-]{0,2}\d){7,14}|\+[1-9]\d{0,2}(?:\.\d{1,4}){3,5}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4}",
    "date": r"\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}",
    "ssn": r"\d{3}-\d{2}-\d{4}",
    "ip": r"\d{1,3}(?:\.\d{1,3}){3}",
    "card": r"\d(?:[ -]?\d){12,18}",
}
#: No value begins or ends inside a longer run of letters, digits or joined numbers, but a time may follow a date.
FIND = r"(?<![\p{L}\p{N}@+])(?:(?:" + "|".join(KINDS.values()) + r")(?![\p{L}\p{N}@]|[.-]\d)|\d{4}-\d{1,2}-\d{1,2}(?=[Tt]\d))"
#: Eras whose dates are permuted among themselves: days since 0001-01-01 of the first, number of days, two radixes whose product is at least that.
ERAS = ((693595, 73049, 271, 270), (0, 693595, 833, 833), (766644, 2885415, 1699, 1699))
ORIGIN = "0001-01-01"
#: Country codes of the E.164 plan with one and with two digits; all others have three.
COUNTRY = r"^(?:([17])|(2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|\d{3})"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def feistel(symbols: Column, radix: Column, key: str, kind: str) -> Column:
    """``symbols`` (array of int) permuted within ``radix`` (array of int).
    One symbol alone is shifted by a hash of the key."""
    def turn(state: Column, k: Column) -> Column:
        half = F.floor(F.size(state) / 2).cast("int")
        front = (k % 2) == 0
        other = F.when(front, F.slice(state, half + 1, F.size(state))).otherwise(F.slice(state, 1, half))
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), k.cast("string"), F.array_join(radix, ","), F.array_join(other, ",")), 512)
        moved = lambda h: F.transform(state, lambda v, j: F.when((j < half) == front, ((v + F.conv(F.substr(h, (j % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")) % F.get(radix, j))).otherwise(v))
        return _let(digest, moved)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), symbols, turn)


def _chars(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _codes(chars: Column) -> tuple[Column, Column]:
    """Symbols and radixes of ASCII letters and digits."""
    kind = lambda c: F.when(c.rlike("[0-9]"), 48).when(c.rlike("[A-Z]"), 65).otherwise(97)
    return F.transform(chars, lambda c: F.ascii(c) - kind(c)), F.transform(chars, lambda c: F.when(c.rlike("[0-9]"), 10).otherwise(26))


def _refill(value: Column, keep: Column, new: Column) -> Column:
    """``value`` with its characters of ASCII letters and digits after the
    first ``keep`` of them replaced by the symbols ``new`` in turn."""
    def put(acc: Column, c: Column) -> Column:
        sign = ~c.rlike("[0-9A-Za-z]")
        skip = acc["at"] < keep
        base = F.when(c.rlike("[0-9]"), 48).when(c.rlike("[A-Z]"), 65).otherwise(97)
        drawn = F.char(F.get(new, acc["at"] - keep) + base)
        return F.struct(F.concat(acc["out"], F.when(sign | skip, c).otherwise(drawn)).alias("out"), (acc["at"] + F.when(sign, 0).otherwise(1)).alias("at"))

    return F.aggregate(_chars(value), F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), put, lambda acc: acc["out"])


def _bare(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9A-Za-z]", "")


def _permuted(value: Column, bare: Column, keep: int | Column, key: str, kind: str) -> Column:
    """``value`` with all but its first ``keep`` letters and digits permuted."""
    keep = F.lit(keep) if isinstance(keep, int) else keep
    return _let(_chars(F.substr(bare, keep + 1, F.length(bare))), lambda chars: _refill(value, keep, feistel(*_codes(chars), key, kind)))


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string whose last digit counts once."""
    n = F.size(digits)
    return F.aggregate(F.transform(digits, lambda d, j: _let((F.ascii(d) - 48) * F.when((n - j) % 2 == 0, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x))), F.lit(0), lambda a, b: a + b)


def is_card(value: Column) -> Column:
    return (luhn_sum(_chars(_bare(value))) % 10 == 0) & ~_bare(value).rlike("^0+$")


def _card(value: Column, key: str) -> Column:
    """All digits but the last are permuted; the last is the new check digit."""
    bare = _bare(value)
    body = _let(_chars(F.substr(bare, F.lit(1), F.length(bare) - 1)), lambda chars: feistel(*_codes(chars), key, "card"))
    check = lambda b: (10 - luhn_sum(F.concat(F.transform(b, lambda x: x.cast("string")), F.array(F.lit("0")))) % 10) % 10
    return _let(body, lambda b: _refill(value, F.lit(0), F.concat(b, F.array(check(b)))))


def iban_rest(bare: Column) -> Column:
    """Remainder by 97 of an IBAN (country and check digits moved to the end)."""
    turned = F.concat(F.substr(bare, F.lit(5), F.length(bare)), F.substr(bare, F.lit(1), F.lit(4)))
    step = lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(_chars(turned), F.lit(0), step)


def _iban(value: Column, key: str) -> Column:
    """The account part is permuted for its country, with new check digits."""
    bare = _bare(value)
    body = _let(_chars(F.substr(bare, F.lit(5), F.length(bare))), lambda chars: feistel(*_codes(chars), key, "iban"))

    def checked(new: Column) -> Column:
        draft = _refill(bare, F.lit(4), new)
        check = lambda d: F.lpad((98 - iban_rest(F.concat(F.substr(d, F.lit(1), F.lit(2)), F.lit("00"), F.substr(d, F.lit(5), F.length(d))))).cast("string"), 2, "0")
        return _let(_let(draft, check), lambda c: _refill(value, F.lit(2), F.concat(F.array((F.ascii(F.substr(c, F.lit(1), F.lit(1))) - 48), (F.ascii(F.substr(c, F.lit(2), F.lit(1))) - 48)), new)))

    return _let(body, checked)


def _octets(value: Column) -> Column:
    return F.transform(F.split(value, r"\."), lambda o: o.cast("int"))


def is_ip(value: Column) -> Column:
    return F.forall(_octets(value), lambda o: o <= 255)


def _ip(value: Column, key: str) -> Column:
    radix = F.array(*[F.lit(256)] * 4)
    return F.array_join(feistel(_octets(value), radix, key, "ip"), ".")


def _day(value: Column, y: int, m: int, d: int) -> Column:
    """The date whose year, month and day are the parts ``y``, ``m``, ``d`` of a value, null if there is none."""
    part = F.split(value, "[-/.]")
    two = lambda k: F.lpad(F.get(part, F.lit(k)), 2, "0")
    year = F.get(part, F.lit(y))
    return F.when(year != "0000", F.try_to_date(F.concat_ws("-", year, two(m), two(d)), "yyyy-MM-dd"))


def _year_first(value: Column) -> Column:
    return value.rlike(r"^\d{4}")


def date_of(value: Column) -> Column:
    """The date of a value in one of the formats, null if there is none. The
    month may stand before the day only where day-first is no date."""
    return F.when(_year_first(value), _day(value, 0, 1, 2)).otherwise(F.coalesce(_day(value, 2, 1, 0), _day(value, 2, 0, 1)))


def _date(value: Column, key: str) -> Column:
    """Days of the era as two symbols; dates beyond the era, or that the
    value's format does not write, are permuted again (cycle walking) until
    they fit: one digit of a day or month stays one digit, and a month-first
    date stays one that cannot be read day-first."""
    part = F.split(value, "[-/.]")
    digits = lambda k: F.length(F.get(part, F.lit(k)))
    origin = F.expr(f"date'{ORIGIN}'")
    number = F.datediff(date_of(value), origin)
    era = F.when(number < ERAS[0][0], 1).when(number < ERAS[2][0], 0).otherwise(2)
    of = lambda k: F.get(F.array(*[F.lit(e[k]) for e in ERAS]), era)
    turned = ~_year_first(value) & _day(value, 2, 1, 0).isNull()
    shape = F.struct(number.alias("number"), of(0).alias("first"), of(1).alias("days"), of(2).alias("a"), of(3).alias("b"), turned.alias("turned"),
                     F.when(turned, digits(0)).otherwise(digits(1)).alias("m"), F.when(_year_first(value), digits(2)).when(turned, digits(1)).otherwise(digits(0)).alias("d"))

    def made(f: Column) -> Column:
        radix = F.array(f["a"], f["b"])
        place = lambda s: F.get(s, F.lit(0)) * f["b"] + F.get(s, F.lit(1))
        day = lambda s: F.date_add(origin, f["first"] + place(s))
        written = lambda d: ((f["m"] == 2) | (F.month(d) < 10)) & ((f["d"] == 2) | (F.day(d) < 10)) & (~f["turned"] | (F.day(d) > 12))
        fits = lambda s: F.when(place(s) < f["days"], _let(day(s), written)).otherwise(F.lit(False))
        start = _let(f["number"] - f["first"], lambda n: feistel(F.array(F.floor(n / f["b"]).cast("int"), (n % f["b"]).cast("int")), radix, key, "date"))
        turns = F.when((f["m"] == 2) & (f["d"] == 2) & ~f["turned"], 12).otherwise(200)
        walked = F.aggregate(F.sequence(F.lit(1), turns), start, lambda s, _: F.when(fits(s), s).otherwise(feistel(s, radix, key, "date")))
        return _let(walked, lambda s: _let(day(s), lambda d: _written(value, d, f)))

    return _let(shape, made)


def _written(value: Column, day: Column, shape: Column) -> Column:
    """``day`` in the format of ``value``."""
    padded = lambda x, n: F.when(n == 1, x.cast("string")).otherwise(F.lpad(x.cast("string"), 2, "0"))
    y, m, d = F.lpad(F.year(day).cast("string"), 4, "0"), padded(F.month(day), shape["m"]), padded(F.day(day), shape["d"])
    sign = F.regexp_extract(value, "[-/.]", 0)
    return F.when(_year_first(value), F.concat(y, sign, m, sign, d)).when(shape["turned"], F.concat(m, sign, d, sign, y)).otherwise(F.concat(d, sign, m, sign, y))


def is_ssn(value: Column) -> Column:
    return ~value.rlike(r"^(000|666|9\d\d)|-00-|-0000$")


def _ssn(value: Column, key: str) -> Column:
    """Permuted until the number is valid again (cycle walking)."""
    start = _permuted(value, _bare(value), 0, key, "ssn")
    return F.aggregate(F.sequence(F.lit(1), F.lit(24)), start, lambda v, _: F.when(is_ssn(v), v).otherwise(_permuted(v, _bare(v), 0, key, "ssn")))


def is_phone(value: Column) -> Column:
    return F.length(_bare(value)).between(8, 15)


def _phone(value: Column, key: str) -> Column:
    """All digits are permuted but a country code, which stays."""
    code = lambda bare: F.when(value.startswith("+"), F.length(F.regexp_extract(bare, COUNTRY, 0))).otherwise(0)
    return _let(_bare(value), lambda bare: _permuted(value, bare, code(bare), key, "phone"))


def _email(value: Column, key: str) -> Column:
    """The local part is permuted; the domain stays."""
    own, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    return F.concat(_permuted(own, _bare(own), 0, key, "email"), F.lit("@"), domain)


def kind_of(value: Column) -> Column:
    """Name of the first kind that a found value is a valid instance of, else null."""
    whole = lambda kind: value.rlike(f"^(?:{KINDS[kind]})$")
    return (F.when(whole("email"), "email").when(whole("iban") & (iban_rest(_bare(value)) == 1), "iban").when(whole("phone"), F.when(is_phone(value), "phone"))
            .when(whole("date"), F.when(date_of(value).isNotNull(), "date")).when(whole("ssn"), F.when(is_ssn(value), "ssn"))
            .when(whole("ip"), F.when(is_ip(value), "ip")).when(whole("card"), F.when(is_card(value), "card")))


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a valid value; other values stay."""
    out = value
    for name, make in (("email", _email), ("iban", _iban), ("phone", _phone), ("date", _date), ("ssn", _ssn), ("ip", _ip), ("card", _card)):
        out = F.when(kind == name, make(value, key)).otherwise(out)
    return out


def pseudonymised(docs: DataFrame, key: str = DEMO_KEY) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and the further columns
    ``pii_kinds`` (kinds of the values replaced, in text order) and
    ``n_replaced``.

    A null text stays null, with no kinds; n_chars, if there, stays right as
    formats keep their length but for IP addresses, and is computed anew.
    Repeated rows get the same result, and an empty table gives no rows. A
    text is taken whole by one task, however long it is: time grows with its
    values, memory with its length. Columns named like the further ones are
    replaced, and those named ``_hit`` or ``_new`` are lost."""
    text = F.col("text")
    parts = docs.withColumn("_hit", F.coalesce(text.rlike(r"[0-9@]") & text.rlike(FIND), F.lit(False)))
    values = F.regexp_extract_all(text, F.lit(FIND), 0)
    new = F.transform(values, lambda v: _let(kind_of(v), lambda k: F.struct(k.alias("kind"), F.when(k.isNull(), v).otherwise(pseudonym(v, k, key)).alias("value"))))
    empty = F.expr("cast(array() as array<struct<kind: string, value: string>>)")
    parts = parts.withColumn("_new", F.when(F.col("_hit"), new).otherwise(empty))
    woven = F.zip_with(F.split(text, FIND, -1), F.col("_new"), lambda p, v: F.concat(p, F.coalesce(v["value"], F.lit(""))))
    kinds = F.filter(F.transform("_new", lambda v: v["kind"]), lambda k: k.isNotNull())
    out = parts.withColumn("text", F.when(F.col("_hit"), F.array_join(woven, "")).otherwise(text)).withColumn("pii_kinds", kinds).withColumn("n_replaced", F.size("pii_kinds").cast("long"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_replaced") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.drop("_hit", "_new")
