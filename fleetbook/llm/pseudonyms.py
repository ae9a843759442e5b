"""Format-preserving pseudonyms for personal data, with DataFrame functions
only.

Validated numbers, dates and addresses in a text are replaced by values of
the same format. A value is a row of digits in mixed radix (decimal digits,
letters, bytes of an address, parts of a day number), and a keyed Feistel
network permutes all values of that format: in turn the left half is shifted
by a keyed hash of the right half, and the right by one of the left. Equal
values become equal pseudonyms in every document, different values stay
different, and the key gives them back.

| kind | found | valid if | permuted | kept |
| email | name@host.tld | host has a dot | ASCII letters and digits of the name | the rest |
| phone | + and digits with single signs between; national 3-3-4 and (area) forms | 8 to 15 digits | digits after the country code | signs |
| card | 13 to 19 digits, plain or in card groups | Luhn | all but the last digit | Luhn sum |
| ip | dotted quad | each at most 255 | the four bytes | dots |
| date | y-m-d, y/m/d, d/m/y, d.m.y | calendar day | day within its 400 years | order, signs |
| iban | country, two digits, 11 to 30 letters and digits, plain or in groups of four | remainder 1 modulo 97 | letters and digits after the check digits | country, remainder |
| national | 3-2-4 digits | area 1 to 899 but 666, no part 0 | the three parts | hyphens |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
KINDS = ("email", "phone", "card", "ip", "date", "iban", "national")

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# Between digits of a phone number: a blank, dot or hyphen, a bracket, or a bracket with one of them outside
_SIGN = r"(?:[ .-]?\(|\)[ .-]?|[ .-])"
# A blank after a whole number does not lead on into a date, address or card (by format alone, so that pseudonyms are found alike)
_OTHER = (r"\d{4}[-/]\d{1,2}[-/]\d{1,2}(?!\d)|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"
          r"|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}(?!\d)|\d{4}[ -]\d{6}[ -]\d{5}(?!\d)|\(?\d{3}[ .)-]{1,2}\d{3}[ .-]\d{4}(?!\d)")
FOUND = "|".join((
    r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    r"\+(?:1[ .-]?|\d{1,3}[ .-]?(?=\())\(?\d{3}\)?[ .-]?\d{3}[ .-]\d{4}(?![.-]?\d)",
    rf"\+\(?\d(?:{_SIGN}?\d){{7}}(?:(?! (?:{_OTHER})){_SIGN}?\d){{0,7}}(?!\d)",
    r"(?<![\d+])(?<!\d[.-])(?:1[ .-])?\(\d{2,5}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?![.-]?\d)",
    r"(?<![\d+])(?<!\d[.-])(?:1[ .-])?\d{3}(?:-\d{3}-|\.\d{3}\.| \d{3} )\d{4}(?![.-]?\d)",
    r"(?<![\d+])\d{13,19}(?!\d)",
    r"(?<![\d+])\d{4}(?:[ -]\d{4}){3}(?!\d)",
    r"(?<![\d+])\d{4}[ -]\d{6}[ -]\d{5}(?!\d)",
    rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4})(?: (?=[A-Z]*\d)[A-Z0-9]{4}){1,6}(?: (?=[A-Z]*\d)[A-Z0-9]{1,3})?)(?![\p{L}\p{N}])",
    r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    r"(?<![\d-])\d{4}-\d{1,2}-\d{1,2}(?![\d-])",
    r"(?<![\d/])\d{4}/\d{1,2}/\d{1,2}(?![\d/])",
    r"(?<![\d/])\d{1,2}/\d{1,2}/\d{4}(?![\d/])",
    r"(?<![\d.])\d{1,2}\.\d{1,2}\.\d{4}(?!\.?\d)",
))
# A day number within the 400 years of the Gregorian cycle is a pair: 189 * 773 = 146,097 days
CYCLE_DAYS, DAY_RADICES = 146_097, (189, 773)
FIRST_DAY = "1800-01-01"
# Parts of a 3-2-4 number: areas 1 to 899 but 666, groups 1 to 99, serials 1 to 9999
NO_AREA, PART_RADICES = 666, (898, 99, 9999)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a digit string, modulo 10."""
    def step(x, i):
        n = x.cast("int")
        return F.when(i % 2 == 1, n * 2 - F.when(n > 4, 9).otherwise(0)).otherwise(n)

    parts = F.transform(F.split(F.reverse(digits), ""), step)
    return F.pmod(F.aggregate(parts, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0))), F.lit(10))


def _parsed(value: Column) -> Column:
    """The calendar day of a date string, null if there is none."""
    iso = F.try_to_date(value, "yyyy-M-d")
    return F.when(value.rlike("^\\d{4}-"), iso).when(
        value.rlike("^\\d{4}/"), F.try_to_date(value, "yyyy/M/d")).when(
        F.contains(value, F.lit("/")), F.try_to_date(value, "d/M/yyyy")).otherwise(F.try_to_date(value, "d.M.yyyy"))


def mod_97(text: Column) -> Column:
    """A string of capitals and digits as a number, modulo 97; A is 10."""
    def step(rest, c):
        return F.when(c == "", rest).when(c.rlike("[0-9]"), rest * 10 + c.cast("int")).otherwise(
            rest * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _is_iban(value: Column) -> Column:
    """15 to 34 characters, the check digits those that are reckoned from the others."""
    plain = F.regexp_replace(value, " ", "")
    return F.length(plain).between(15, 34) & (F.substring(plain, 3, 2) == _check_digits(plain))


def _check_digits(plain: Column) -> Column:
    moved = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 2), F.lit("00"))
    return F.lpad((98 - mod_97(moved)).cast("string"), 2, "0")


def _is_national(value: Column) -> Column:
    area, group, serial = (F.split(value, "-")[i].try_cast("int") for i in range(3))
    return (area > 0) & (area < 900) & (area != NO_AREA) & (group > 0) & (serial > 0)


def kind_of(value: Column) -> Column:
    """The kind of a found string, null when it fails validation."""
    n = F.length(digits_of(value))
    return (F.when(F.contains(value, F.lit("@")), "email")
            .when(F.startswith(value, F.lit("+")), F.when((n >= 8) & (n <= 15), "phone"))
            .when(value.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip")
            .when(value.rlike("^[A-Z]{2}"), F.when(_is_iban(value), "iban"))
            .when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.when(_is_national(value), "national"))
            .when(value.rlike(r"^(\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}[/.]\d{1,2}[/.]\d{4})$"),
                  F.when(_parsed(value).isNotNull(), "date"))
            .when(value.rlike(r"^(1[ .-])?(\(|\d{3}[ .-])"), F.when((n >= 8) & (n <= 15), "phone"))
            .when(luhn_sum(digits_of(value)) == 0, "card"))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once: an expression that a lambda
    refers to would else be evaluated anew for each element."""
    return F.transform(F.array(value), use)[0]


def feistel(values: Column, tweak: Column, key: str, forward: bool = True) -> Column:
    """Permute an array of (x, m), each 0 <= x < m, keyed by ``key`` and
    ``tweak``: ``ROUNDS`` rounds, the left half first; backwards undoes it."""
    order = F.sequence(F.lit(0), F.lit(ROUNDS - 1)) if forward else F.sequence(F.lit(ROUNDS - 1), F.lit(0))

    def one(state, r, tweak):
        left, half = r % 2 == 0, F.floor(F.size(state) / 2)  # whether the left half moves
        other = F.filter(state, lambda _, j: (j < half) != left)
        seen = F.array_join(F.transform(other, lambda o: o["x"].cast("string")), ".")

        def move(seen):
            def shifted(e, i):
                mark = F.sha2(F.concat_ws("|", F.lit(key), tweak, r.cast("string"), i.cast("string"), seen), 256)
                shift = F.conv(F.substring(mark, 1, 12), 16, 10).cast("long")
                moved = F.pmod(e["x"] + shift if forward else e["x"] - shift, e["m"])
                return F.when((i < half) == left, F.struct(moved.alias("x"), e["m"].alias("m"))).otherwise(e)

            return F.transform(state, shifted)

        return _let(seen, move)

    return _let(F.struct(values.alias("values"), tweak.alias("tweak")),
                lambda b: F.aggregate(order, b["values"], lambda state, r: one(state, r, b["tweak"])))


def _pair(x: Column, m) -> Column:
    return F.struct(x.cast("long").alias("x"), F.lit(m).cast("long").alias("m"))


def _refilled(value: Column, pattern: str, new: Column) -> Column:
    """``value`` with its characters that match ``pattern`` replaced, in order,
    by the strings of ``new``."""
    def fill(b):
        def put(c, i):
            before = F.length(F.regexp_replace(F.substring(b["value"], F.lit(1), i), f"[^{pattern}]", ""))
            return F.when(c.rlike(f"^[{pattern}]$"), b["new"][before]).otherwise(c)

        return F.array_join(F.transform(F.split(b["value"], ""), put), "")

    return _let(F.struct(value.alias("value"), new.alias("new")), fill)


def _characters(value: Column, tweak: str, key: str, forward: bool, pattern: str = "A-Za-z0-9",
                group: Column | None = None) -> Column:
    """The characters of ``value`` in ``pattern`` permuted, each within its
    own class (digits, small or capital letters); differently for each
    ``group``."""
    chars = F.split(F.regexp_replace(value, f"[^{pattern}]", ""), "")
    chars = F.filter(chars, lambda c: c != "")

    def first(c):
        return F.when(c.rlike("[0-9]"), 48).when(c.rlike("[A-Z]"), 65).otherwise(97)

    def permuted(chars):
        pairs = F.transform(chars, lambda c: F.struct(
            (F.ascii(c) - first(c)).cast("long").alias("x"),
            F.when(first(c) == 48, 10).otherwise(26).cast("long").alias("m")))
        classes = F.array_join(F.transform(chars, lambda c: F.char(first(c))), "")  # part of the format
        named = F.lit(f"{tweak}:") if group is None else F.concat(F.lit(f"{tweak}:"), group, F.lit(":"))
        moved = feistel(pairs, F.concat(named, classes), key, forward)
        return F.zip_with(moved, chars, lambda p, c: F.char(p["x"] + first(c)))

    return _refilled(value, pattern, _let(chars, permuted))


def _email(value: Column, key: str, forward: bool) -> Column:
    name = F.substring_index(value, "@", 1)
    return F.concat(_characters(name, "email", key, forward), F.lit("@"), F.substring_index(value, "@", -1))


# Country calling codes of one and of two digits; the others have three.
ONE_DIGIT_CODES = "17"
TWO_DIGIT_CODES = ("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 "
                   "60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98").split()


def _phone(value: Column, key: str, forward: bool) -> Column:
    """A number keeps its country code, told by its digits alone, so that one
    number has one pseudonym however it is grouped."""
    def permuted(digits):
        code = F.when(F.substring(digits, 1, 1).isin(*ONE_DIGIT_CODES), 1).when(
            F.substring(digits, 1, 2).isin(TWO_DIGIT_CODES), 2).otherwise(3)
        code = F.when(F.startswith(value, F.lit("+")), code).when(value.rlike(r"^1[ .-]"), 1).otherwise(0)
        moved = _characters(F.substr(digits, code + 1), "phone", key, forward, "0-9")
        return F.split(F.concat(F.substr(digits, F.lit(1), code), moved), "")

    return _refilled(value, "0-9", _let(digits_of(value), permuted))


def _card(value: Column, key: str, forward: bool) -> Column:
    payload = F.regexp_replace(value, r"\d$", "")

    def checked(moved):
        check = F.pmod(10 - luhn_sum(F.concat(digits_of(moved), F.lit("0"))), F.lit(10))
        return F.concat(moved, check.cast("string"))

    return _let(_characters(payload, "card", key, forward, "0-9"), checked)


def _iban(value: Column, key: str, forward: bool) -> Column:
    def checked(plain):
        def put(rest):
            new = F.concat(F.substring(plain, 1, 2), F.lit("00"), rest)
            return F.concat(F.substring(plain, 1, 2), _check_digits(new), rest)

        country = F.substring(plain, 1, 2)
        return _let(_characters(F.substr(plain, F.lit(5)), "iban", key, forward, "0-9A-Z", country), put)

    new = _let(F.regexp_replace(value, " ", ""), checked)
    return _refilled(value, "0-9A-Z", F.split(new, ""))


def _national(value: Column, key: str, forward: bool) -> Column:
    area, group, serial = (F.split(value, "-")[i].cast("long") for i in range(3))
    parts = F.array(*(_pair(x, m) for x, m in zip(
        (area - F.when(area < NO_AREA, 1).otherwise(2), group - 1, serial - 1), PART_RADICES)))

    def written(m):
        area = m[0]["x"] + 1
        area = F.when(area < NO_AREA, area).otherwise(area + 1)
        return F.concat_ws("-", *(F.lpad(x.cast("string"), n, "0") for x, n in (
            (area, 3), (m[1]["x"] + 1, 2), (m[2]["x"] + 1, 4))))

    return _let(feistel(parts, F.lit("national"), key, forward), written)


def _ip(value: Column, key: str, forward: bool) -> Column:
    moved = feistel(F.transform(F.split(value, r"\."), lambda x: _pair(x, 256)), F.lit("ip"), key, forward)
    return F.array_join(F.transform(moved, lambda p: p["x"].cast("string")), ".")


def _date(value: Column, key: str, forward: bool) -> Column:
    start = F.lit(FIRST_DAY).cast("date")
    number = F.datediff(_parsed(value), start)
    cycle, day = F.floor(number / CYCLE_DAYS), F.pmod(number, F.lit(CYCLE_DAYS))
    a, b = DAY_RADICES
    moved = feistel(F.array(_pair(F.floor(day / b), a), _pair(day % b, b)), F.concat(F.lit("date:"), cycle.cast("string")),
                    key, forward)
    number = _let(moved, lambda m: m[0]["x"] * b + m[1]["x"])
    return _let(F.date_add(start, (cycle * CYCLE_DAYS + number).cast("int")), lambda new: _written(value, new))


def _written(value: Column, new: Column) -> Column:
    """The day ``new`` in the format of ``value``."""
    year = F.lpad(F.year(new).cast("string"), 4, "0")

    def padded(part, sign, at):  # as wide as it was, or wider
        old = F.length(F.split(value, sign)[at])
        text = part.cast("string")
        return F.when(F.length(text) < old, F.lpad(text, 2, "0")).otherwise(text)

    def day_first(sign, regex):
        return F.concat(padded(F.dayofmonth(new), regex, 0), F.lit(sign), padded(F.month(new), regex, 1), F.lit(sign), year)

    def year_first(sign):
        return F.concat(year, F.lit(sign), padded(F.month(new), sign, 1), F.lit(sign), padded(F.dayofmonth(new), sign, 2))

    return (F.when(value.rlike("^\\d{4}-"), year_first("-")).when(value.rlike("^\\d{4}/"), year_first("/"))
            .when(F.contains(value, F.lit("/")), day_first("/", "/")).otherwise(day_first(".", r"\.")))


def pseudonym(value: Column, key: str, forward: bool = True) -> Column:
    """The pseudonym of a found string; itself when it fails validation."""
    kind = kind_of(value)
    return (F.when(kind == "email", _email(value, key, forward)).when(kind == "phone", _phone(value, key, forward))
            .when(kind == "card", _card(value, key, forward)).when(kind == "ip", _ip(value, key, forward))
            .when(kind == "date", _date(value, key, forward)).when(kind == "iban", _iban(value, key, forward))
            .when(kind == "national", _national(value, key, forward)).otherwise(value))


def _count(found: str, kind: str) -> Column:
    return F.size(F.filter(found, lambda n: n["kind"] == kind)).cast("long")


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text",
                 forward: bool = True) -> DataFrame:
    """Per row: the id, ``text`` with its validated personal data replaced,
    ``n_values`` replaced, one count per kind, and ``pseudonyms`` in order.
    ``forward=False`` with the same key gives the originals back.

    A map over the rows, no shuffle: the text is cut at the found strings, and
    the parts are joined again around their pseudonyms. Texts without a digit
    or @ are passed through. A null text stays null, with no values; empty
    texts, repeated rows and null ids are each returned; an empty table gives
    no rows. Other columns are not read.
    """
    text = F.col(text_col)
    some = text.rlike("[0-9@]")
    cut = docs.select(
        F.col(id_col).alias("id"), text.alias("old"),
        F.when(some, F.regexp_extract_all(text, F.lit(f"({FOUND})"), F.lit(0))).alias("found"),
        F.when(some, F.split(text, FOUND, -1)).alias("around"))
    named = cut.select(
        "id", "old", "around",
        F.transform("found", lambda v: F.struct(v.alias("v"), kind_of(v).alias("kind"),
                                                pseudonym(v, key, forward).alias("new"))).alias("named"))
    put = F.array_join(F.flatten(F.zip_with("around", "named", lambda a, n: F.array(
        a, F.coalesce(n["new"], F.lit(""))))), "")
    valid = F.filter(F.coalesce(F.col("named"), F.array()), lambda n: n["kind"].isNotNull())
    return (named.select("id", F.when(F.size("named") > 0, put).otherwise(F.col("old")).alias("new_text"),
                         valid.alias("valid"))
            .select(F.col("id").alias(id_col), F.col("new_text").alias("text"),
                    F.size("valid").cast("long").alias("n_values"),
                    *(_count("valid", kind).alias(f"n_{kind}") for kind in KINDS),
                    F.transform("valid", lambda n: n["new"]).alias("pseudonyms")))
