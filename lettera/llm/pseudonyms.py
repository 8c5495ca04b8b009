"""Format-preserving pseudonyms for personal data.

E-mail addresses, card numbers, phone numbers, IP addresses, social security numbers, account numbers
and dates are found, validated, and replaced by another valid value of the same format. The
replacement is a keyed Feistel permutation of the values of that format, so equal values stay equal
in all documents, different ones stay different, and whoever holds the key can go back. Only SQL
functions on one row are used.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import aside, let, restored

#: An even number of rounds, so both halves are mixed equally often.
ROUNDS = 10

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_FREE, _SHUT = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
#: Characters of an account number by country: tells where one that is printed in groups of four ends.
IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_GROUPED = "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf" [A-Z0-9]{{{n % 4}}}" if n % 4 else "")
                    for n, c in IBAN_SIZES.items())
_NATIONAL = "|".join(rf"[0-9]{{3}}{x}[0-9]{{3}}{x}[0-9]{{4}}|0[0-9]{x}[0-9]{{2}}{x}[0-9]{{2}}{x}[0-9]{{2}}{x}[0-9]{{2}}"
                     rf"|0[0-9]{{2,4}}{x}[0-9]{{3,4}}{x}[0-9]{{3,4}}" for x in (" ", r"\.", "-")) + r"|0[0-9]{2,4} [0-9]{6,8}"
#: Formats in the order in which they are tried at a place of the text. Java follows a repeated group by recursion, so each has a
#: bound; that of a domain is its largest number of labels, of 63 characters each.
FORMATS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,}",
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])",
    "iban": rf"{_FREE}[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}{_SHUT}|{_FREE}(?:{_GROUPED}){_SHUT}",
    "date": rf"{_FREE}(?:[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}|[0-9]{{2}}\.[0-9]{{2}}\.[0-9]{{4}})(?!(?!T[0-9])[0-9A-Za-z])",
    "ssn": rf"{_FREE}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_SHUT}",
    "card": rf"{_FREE}(?:[0-9]{{13,19}}|[0-9]{{4}}(?:[ -][0-9]{{4}}){{3}}(?:[ -][0-9]{{1,3}})?|[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{5}}){_SHUT}",
    "phone": rf"(?:(?<![0-9+])\+[0-9]{{1,3}}[ .-]?(?:\([0-9]{{1,4}}\)[ .-]?)?[0-9]{{2,4}}(?:[ .-]?[0-9]{{2,4}}){{1,4}}"
             rf"|(?<![0-9)])\([0-9]{{3}}\) ?[0-9]{{3}}[ .-][0-9]{{4}}|{_FREE}(?<![0-9]\.)(?:{_NATIONAL})(?!\.[0-9]))(?![0-9])",
}
ANY_FORMAT = "|".join(f"(?:{p})" for p in FORMATS.values())


def _keyed(key: str, *parts: Column) -> Column:
    """64 hexadecimal digits that only the key can foretell."""
    return F.sha2(F.concat(F.lit(f"{key}|"), F.sha2(F.concat_ws("|", F.lit(key), *parts), 256)), 256)


def _number(hexadecimal: Column) -> Column:
    return F.conv(F.substring(hexadecimal, 1, 15), 16, 10).cast("long")


def feistel(value: Column, a: Column, b: Column, tweak: Column, key: str) -> Column:
    """A permutation of 0 .. a*b-1: halves below `a` and `b` take turns in shifting each other."""
    def step(state, n):
        left, right = state["l"], state["r"]
        shift = lambda x, m: F.pmod(_number(_keyed(key, tweak, n, x)), m)
        return F.when(n % 2 == 0, F.struct(F.pmod(left + shift(right, a), a).alias("l"), right.alias("r"))) \
                .otherwise(F.struct(left.alias("l"), F.pmod(right + shift(left, b), b).alias("r")))

    start = F.struct(_div(value, b).alias("l"), F.pmod(value, b).cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["l"] * b + s["r"])


def _div(a: Column, b) -> Column:
    """Whole division; `b` is a column or a number."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def _power(n: Column) -> Column:
    """10 to the n as a whole number."""
    return F.rpad(F.lit("1"), (n + 1).cast("int"), "0").cast("long")


def feistel_digits(digits: Column, tweak: Column, key: str) -> Column:
    """A permutation of the digit strings of one length, up to 18 digits."""
    n = F.char_length(digits)
    half = _div(n, 2).cast("int")
    moved = feistel(digits.cast("long"), _power(n - half), _power(half), F.concat_ws(":", tweak, n), key)
    return F.lpad(moved.cast("string"), n, "0")


def feistel_text(value: Column, tweak: Column, key: str) -> Column:
    """A permutation of the strings of one pattern: each letter or digit moves within its own class."""
    def shifted(text, seed):
        return let(seed, lambda known: moved(text, known))

    def moved(text, known):
        def move(c, i):
            k, code = F.xxhash64(known, i), F.ascii(c)
            turn = lambda low, size: F.char(low + F.pmod(code - low + F.pmod(k, F.lit(size)), F.lit(size)))
            return (F.when(c.between("a", "z"), turn(97, 26)).when(c.between("A", "Z"), turn(65, 26))
                    .when(c.between("0", "9"), turn(48, 10)).otherwise(c))
        return F.array_join(F.transform(F.split(text, ""), move), "")

    def step(state, n):
        left, right = state["l"], state["r"]
        return F.when(n % 2 == 0, F.struct(shifted(left, _keyed(key, tweak, n, right)).alias("l"), right.alias("r"))) \
                .otherwise(F.struct(left.alias("l"), shifted(right, _keyed(key, tweak, n, left)).alias("r")))

    half = _div(F.char_length(value), 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), half).alias("l"), F.substring(value, half + 1, F.char_length(value)).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s["l"], s["r"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refilled(value: Column, digits: Column) -> Column:
    """`value` with its digits replaced one by one by `digits`."""
    def put(state, c):
        is_digit = c.between("0", "9")
        return F.struct(F.concat(state["out"], F.when(is_digit, F.substring(digits, state["k"], F.lit(1))).otherwise(c)).alias("out"),
                        (state["k"] + F.when(is_digit, 1).otherwise(0)).alias("k"))
    return F.aggregate(F.split(value, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")), put, lambda s: s["out"])


def luhn_digit(body: Column) -> Column:
    """The check digit for the digits before it."""
    total = F.aggregate(F.transform(F.split(F.reverse(body), ""), lambda c, i: F.when(
        i % 2 == 0, _div(c.cast("int") * 2, 10).cast("int") + (c.cast("int") * 2) % 10).otherwise(c.cast("int"))),
        F.lit(0), lambda a, x: a + x)
    return F.pmod(-total, F.lit(10)).cast("string")


def iban_digits(country: Column, account: Column) -> Column:
    """The two check digits of an account number."""
    rest = F.aggregate(F.split(F.concat(account, country, F.lit("00")), ""), F.lit(0), lambda a, c: F.when(
        c.between("0", "9"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))
    return F.lpad((98 - rest).cast("string"), 2, "0")


def _email(m: Column, key: str) -> Column:
    return let(F.substring_index(m, ".", -1), lambda top: F.concat(
        feistel_text(F.substring(m, F.lit(1), F.char_length(m) - F.char_length(top) - 1), F.lit("email"), key), F.lit("."), top))


def _ip(m: Column, key: str) -> Column:
    def moved(p):
        value = ((p[0].cast("long") * 256 + p[1].cast("long")) * 256 + p[2].cast("long")) * 256 + p[3].cast("long")
        return let(feistel(value, F.expr("65536L"), F.expr("65536L"), F.lit("ip"), key), lambda v: F.concat_ws(
            ".", *[F.pmod(F.shiftright(v, s), F.lit(256)) for s in (24, 16, 8, 0)]))
    return let(F.split(m, r"\."), moved)


def _iban(m: Column, key: str) -> Column:
    """Checked without spaces, so that both spellings of a number get the same new one."""
    def moved(c):
        country, account = F.substring(c, 1, 2), F.substring(c, F.lit(5), F.char_length(c))
        new = let(feistel_text(account, F.concat(F.lit("iban"), country), key), lambda a: F.concat(country, iban_digits(country, a), a))
        grouped = lambda x: F.trim(F.regexp_replace(x, "(.{4})", "$1 "))
        return F.when(iban_digits(country, account) == F.substring(c, 3, 2), F.when(m.contains(" "), grouped(new)).otherwise(new))
    return let(F.replace(m, F.lit(" "), F.lit("")), moved)


#: From 1900-01 to 2099-12: 28,800 days up to the 12th, 160 times 180; 44,249 after it, one less than 150 times 295.
_FIRST, _MONTHS, _EARLY, _LATE, _LATE_SIZES = "1900-01-01", 2400, (160, 180), 44249, (150, 295)


def _date(m: Column, key: str) -> Column:
    """Days up to the 12th are permuted among themselves, and so are the others. So a date is moved alike in all
    spellings, and a month-first one, which is known by its day after the 12th, remains one."""
    iso, mark = m.contains("-"), F.substring(m, 3, 1)
    first = F.lit(_FIRST).cast("date")
    numbers = (F.substring(m, 1, 2), F.substring(m, 4, 2))
    swapped = ~iso & (mark == "/") & (numbers[1] > "12") & (numbers[0] <= "12")
    month, day = F.when(swapped, numbers[0]).otherwise(numbers[1]), F.when(swapped, numbers[1]).otherwise(numbers[0])
    date = F.when(iso, m).otherwise(F.concat_ws("-", F.substring(m, 7, 4), month, day)).try_cast("date")
    longs = lambda x: [F.lit(v).cast("long") for v in x]
    start = lambda k: F.add_months(first, k.cast("int"))
    late_before = lambda k: F.datediff(start(k), first).cast("long") - k * 12

    def early(n):
        return let(feistel(n, *longs(_EARLY), F.lit("date"), key), lambda v: F.date_add(start(_div(v, 12)), F.pmod(v, F.lit(12)).cast("int")))

    def late(n):
        step = lambda v: feistel(v, *longs(_LATE_SIZES), F.lit("late date"), key)
        # the one number that is no day moves on once more
        new = let(step(n), lambda v: F.when(v == _LATE, step(F.lit(_LATE).cast("long"))).otherwise(v))
        near = lambda v: let(_div(v * _MONTHS, _LATE), lambda k: F.struct(
            v.alias("v"), (k + F.when(late_before(k + 1) <= v, 1).when(late_before(k) > v, -1).otherwise(0)).alias("k")))
        return let(let(new, near), lambda x: F.date_add(start(x["k"]), (x["v"] - late_before(x["k"]) + 12).cast("int")))

    def moved(d):
        months = ((F.year(d) - 1900) * 12 + F.month(d) - 1).cast("long")
        number = F.dayofmonth(d)
        return F.when(number <= 12, early(months * 12 + number - 1)).otherwise(late(late_before(months) + number - 13))

    def shown(new):
        two = (F.date_format(new, "dd"), F.date_format(new, "MM"))
        return F.when(iso, F.date_format(new, "yyyy-MM-dd")).otherwise(F.concat(
            F.when(swapped, two[1]).otherwise(two[0]), mark, F.when(swapped, two[0]).otherwise(two[1]), mark, F.date_format(new, "yyyy")))

    return let(date, lambda d: F.when(F.year(d).between(1900, 2099), let(moved(d), shown)))


def _ssn(m: Column, key: str) -> Column:
    """Areas 001-899 without 666, groups 01-99, serials 0001-9999."""
    area, group, serial = (F.substring(m, *x).cast("long") for x in ((1, 3), (5, 2), (8, 4)))
    small = 99 * 9999
    value = (F.when(area > 666, area - 2).otherwise(area - 1)) * small + (group - 1) * 9999 + serial - 1

    def shown(v):
        a, rest = _div(v, small), F.pmod(v, F.lit(small).cast("long"))
        a = F.when(a + 1 >= 666, a + 2).otherwise(a + 1)
        return F.concat_ws("-", F.lpad(a.cast("string"), 3, "0"), F.lpad((_div(rest, 9999) + 1).cast("string"), 2, "0"),
                           F.lpad((F.pmod(rest, F.lit(9999)) + 1).cast("string"), 4, "0"))

    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    return F.when(valid, let(feistel(value, F.expr("898L"), F.lit(small).cast("long"), F.lit("ssn"), key), shown))


def _card(m: Column, key: str) -> Column:
    def moved(d):
        body = F.substring(d, F.lit(1), F.char_length(d) - 1)
        return F.when(luhn_digit(body) == F.substring(d, -1, 1), let(
            feistel_digits(body, F.lit("card"), key), lambda b: _refilled(m, F.concat(b, luhn_digit(b)))))
    return let(_digits(m), moved)


def _phone(m: Column, key: str) -> Column:
    """The first digit after a + stays: it is the zone of the country."""
    def moved(d):
        kept = F.when(m.startswith("+"), 1).otherwise(0)
        lead, rest = F.substring(d, F.lit(1), kept), F.substring(d, kept + 1, F.char_length(d))
        return F.when(F.char_length(d).between(7, 15), _refilled(m, F.concat(lead, feistel_digits(
            rest, F.concat(F.lit("phone"), lead), key))))
    return let(_digits(m), moved)


_MOVED = {"email": _email, "ip": _ip, "iban": _iban, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}


def pseudonym(match: Column, key: str) -> Column:
    """(kind, value): the format of a match, and its pseudonym or null if the match isn't valid."""
    chosen = F.lit(None).cast("struct<kind:string,value:string>")
    for kind in reversed(FORMATS):
        chosen = F.when(match.rlike(rf"\A(?:{FORMATS[kind]})\z"), F.struct(
            F.lit(kind).alias("kind"), _MOVED[kind](match, key).alias("value"))).otherwise(chosen)
    return chosen


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """`docs` with personal data replaced in `text`, and `replaced`: map from format to number of values.

    Matches that fail their check (a wrong check digit, an impossible date) stay. Dates count from
    1900 to 2099, as yyyy-mm-dd (a time may follow), dd.mm.yyyy and dd/mm/yyyy, or mm/dd/yyyy where that is the only
    reading. Account numbers may stand in groups of four. National phone numbers count with separators only:
    three, three and four digits, or a leading 0. A null text stays null with an empty map.
    Rows are worked on one by one, so repeated rows come out equal; a column of `docs` named
    `replaced` is dropped. An empty table gives an empty one.
    """
    docs, moved = aside(docs, ["_text", "_found", "_new"])
    text = moved.get(text, text)
    t = F.col(text)
    places = [f for f in docs.columns if f != "replaced"]
    found = F.when(t.rlike("[0-9@]"), F.regexp_extract_all(t, F.lit(ANY_FORMAT), F.lit(0))).otherwise(F.array().cast("array<string>"))
    d = docs.withColumn("_found", F.coalesce(found, F.array().cast("array<string>")))
    d = d.withColumn("_new", F.transform("_found", lambda m: pseudonym(m, key)))

    def rebuilt(gaps):
        shown = F.zip_with(F.col("_found"), F.col("_new"), lambda m, n: F.coalesce(n["value"], m))
        return F.array_join(F.zip_with(gaps, shown, lambda g, s: F.concat(g, F.coalesce(s, F.lit("")))), "")

    d = d.withColumn("_text", F.when(F.size("_found") > 0, let(F.split(t, ANY_FORMAT, -1), rebuilt)).otherwise(t))
    done = F.filter("_new", lambda n: n["value"].isNotNull())
    counts = let(done, lambda n: F.map_from_entries(F.transform(F.array_distinct(F.transform(n, lambda x: x["kind"])), lambda k: F.struct(
        k, F.size(F.filter(n, lambda x: x["kind"] == k))))))
    return restored(d.select(*[F.col("_text").alias(text) if c == text else F.col(c) for c in places], counts.alias("replaced")), moved)
