"""Format-preserving pseudonyms for personal numbers and dates, in DataFrame
expressions only.

Values found in a text are validated (Luhn, octets, number plans, calendar) and
replaced by a keyed permutation of the set of valid values of their format, so
the result is again valid, equal values become equal pseudonyms in every
document, different values of a format stay different, and only the key leads
back. The permutation is an alternating Feistel network over Z_a x Z_b with
a * b equal to the number of valid values, so no value falls outside and none has
to be walked back in:

* card: 13 to 19 digits (bare, or in groups of 4-4-4-4 or 4-6-5) with a Luhn check digit; the first digit stays, the inner
  ones are permuted, the check digit is computed anew;
* phone: area and exchange 200 to 999, four more digits: 80000 x 80000; numbers of that form with another area or
  exchange (000 to 199) are permuted among themselves: 60000 x 60000;
* ip: four octets: 65536 x 65536;
* ssn: area 001 to 899 but 666, group 01 to 99, serial 0001 to 9999: 88902 x 9999;
* date: days of the 400 Gregorian years from 1800: 146097 = 189 x 773. A '/' date is
  read day first, or month first where only that is a date. The latter have a day
  beyond the 12th and are permuted among such days: 88497 = 9 x 9833.

An e-mail address isn't a number: its local part becomes a keyed hash, its domain
stays. Signs between digits stay where they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.scratch import free_name

ROUNDS = 10

_LEFT, _RIGHT = r"(?<![A-Za-z0-9_.+-])", r"(?![A-Za-z0-9_])"
_CARD = r"[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{4}-[0-9]{6}-[0-9]{5}"
#: kind -> pattern, in order of preference at one position
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "date": rf"{_LEFT}(?:[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}|[0-9]{{2}}\.[0-9]{{2}}\.[0-9]{{4}}){_RIGHT}(?![-/][0-9])",
    "ip": rf"{_LEFT}[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}{_RIGHT}(?!\.[0-9])",
    "phone": rf"(?<![A-Za-z0-9_.-])(?:\+1[ .-]?)?(?:\([0-9]{{3}}\) ?|[0-9]{{3}}[ .-])[0-9]{{3}}[ .-][0-9]{{4}}{_RIGHT}",
    "ssn": rf"{_LEFT}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_RIGHT}(?!-[0-9])",
    "card": rf"{_LEFT}(?:{_CARD}){_RIGHT}",
}
#: numbers and dates begin with one of few characters; asked first, that spares most positions
NUMBERS = "(?=[0-9(+])(?:" + "|".join(p for k, p in PATTERNS.items() if k != "email") + ")"
ANY = f"{PATTERNS['email']}|{NUMBERS}"


def _long(text: Column) -> Column:
    return text.cast("long")


def _div(x: Column, by: Column) -> Column:
    return F.call_function("div", x, by)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once. Inside array functions Spark
    shares no common expressions, so a name used twice would be computed twice."""
    return F.element_at(F.transform(F.array(value), body), 1)


def feistel(x: Column, a: Column, b: Column, key: str, tweak: Column) -> Column:
    """A keyed permutation of 0 ... a * b - 1 (all longs)."""
    def f(i: Column, half: Column) -> Column:
        h = F.sha2(F.concat_ws(":", F.lit(key), tweak, i.cast("string"), half.cast("string")), 256)
        return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")

    def network(v: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            even = i % 2 == 0
            return F.struct(
                F.when(even, F.pmod(s["l"] + F.pmod(f(i, s["r"]), v["a"]), v["a"])).otherwise(s["l"]).alias("l"),
                F.when(even, s["r"]).otherwise(F.pmod(s["r"] + F.pmod(f(i, s["l"]), v["b"]), v["b"])).alias("r"),
            )

        start = F.struct(_div(v["x"], v["b"]).alias("l"), F.pmod(v["x"], v["b"]).alias("r"))
        return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, step, lambda s: s["l"] * v["b"] + s["r"])

    return _let(F.struct(x.alias("x"), a.alias("a"), b.alias("b")), network)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _refill(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced in order."""
    return _let(digits, lambda own: F.aggregate(
        F.split(m, "(?!^)"),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("i")),
        lambda s, c: F.when(
            c.rlike("^[0-9]$"), F.struct(F.concat(s["out"], F.substring(own, s["i"], F.lit(1))).alias("out"), (s["i"] + 1).alias("i"))
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["i"].alias("i"))),
        lambda s: s["out"],
    ))


def _luhn_sum(digits: Column, doubled_from_right: int) -> Column:
    """Sum of digits, every second one doubled, beginning with the given parity."""
    def total(own: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            d = F.substring(own, F.length(own) + 1 - i, F.lit(1)).cast("int") * F.when(i % 2 == doubled_from_right % 2, 2).otherwise(1)
            return acc + d - F.when(d > 9, 9).otherwise(0)

        return F.aggregate(F.sequence(F.lit(1), F.length(own)), F.lit(0), add)

    return _let(digits, total)


def _ten(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def _card(m: Column, key: str) -> Column:
    def moved(digits: Column) -> Column:
        n = F.length(digits) - 2
        left = _div(n, F.lit(2)).cast("int")
        inner = feistel(_long(F.substring(digits, F.lit(2), n)), _ten(n - left), _ten(left), key,
                        F.concat(F.lit("card"), F.substring(digits, 1, 1), n.cast("string")))
        return F.concat(F.substring(digits, 1, 1), F.lpad(inner.cast("string"), n, "0"))

    def checked(body: Column) -> Column:
        return F.concat(body, F.pmod(10 - F.pmod(_luhn_sum(body, 1), F.lit(10)), F.lit(10)).cast("string"))

    return _refill(m, _let(_let(_digits(m), moved), checked))


def _phone(m: Column, key: str) -> Column:
    def moved(d: Column) -> Column:
        part = lambda a, n: _long(F.substring(d, a, n))
        area, exchange, line = part(1, 3), part(4, 3), part(7, 4)
        planned = (area >= 200) & (exchange >= 200)
        # outside the number plan: 200 areas with any exchange, then 800 with an exchange below 200
        pair = (
            F.when(planned, (area - 200) * 800 + exchange - 200)
            .when(area < 200, area * 1000 + exchange).otherwise(200_000 + (area - 200) * 200 + exchange)
        )
        half = F.when(planned, 80000).otherwise(60000).cast("long")
        return F.struct(planned.alias("planned"), half.alias("half"), (pair * 10000 + line).alias("x"))

    def permuted(v: Column) -> Column:
        tweak = F.when(v["planned"], "phone").otherwise("phone outside the plan")
        return F.struct(v["planned"].alias("planned"), feistel(v["x"], v["half"], v["half"], key, tweak).alias("y"))

    def shown(v: Column) -> Column:
        pair = _div(v["y"], F.lit(10000))
        rest = pair - 200_000
        front = (
            F.when(v["planned"], (_div(pair, F.lit(800)) + 200) * 1000 + F.pmod(pair, F.lit(800)) + 200)
            .when(rest < 0, pair).otherwise((_div(rest, F.lit(200)) + 200) * 1000 + F.pmod(rest, F.lit(200)))
        )
        return F.lpad((front * 10000 + F.pmod(v["y"], F.lit(10000))).cast("long").cast("string"), 10, "0")

    country = F.regexp_extract(m, r"^(\+1[ .-]?)?", 0)
    rest = F.regexp_replace(m, r"^\+1[ .-]?", "")
    return F.concat(country, _refill(rest, _let(_let(_let(_digits(rest), moved), permuted), shown)))


def _octets(m: Column) -> Column:
    return F.transform(F.split(m, r"\."), _long)


def _ip(m: Column, key: str) -> Column:
    x = F.aggregate(_octets(m), F.lit(0).cast("long"), lambda acc, o: acc * 256 + o)
    y = feistel(x, F.lit(65536).cast("long"), F.lit(65536).cast("long"), key, F.lit("ip"))
    return _let(y, lambda v: F.concat_ws(".", *[F.shiftright(v, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]))


def _ssn(m: Column, key: str) -> Column:
    area = _long(F.substring(m, 1, 3))
    area = area - F.when(area > 666, 2).otherwise(1)
    x = (area * 99 + _long(F.substring(m, 5, 2)) - 1) * 9999 + _long(F.substring(m, 8, 4)) - 1

    def shown(y: Column) -> Column:
        high = _div(y, F.lit(9999))
        out = _div(high, F.lit(99))
        out = out + F.when(out >= 665, 2).otherwise(1)
        return F.concat_ws("-", F.lpad(out.cast("string"), 3, "0"), F.lpad((F.pmod(high, F.lit(99)) + 1).cast("string"), 2, "0"),
                           F.lpad((F.pmod(y, F.lit(9999)) + 1).cast("string"), 4, "0"))

    return _let(feistel(x, F.lit(898 * 99).cast("long"), F.lit(9999).cast("long"), key, F.lit("ssn")), shown)


def _day(m: Column) -> Column:
    """The date that ``m`` shows, or null."""
    def of(y, mo, d):
        return F.try_to_date(F.concat_ws("-", F.substring(m, *y), F.substring(m, *mo), F.substring(m, *d)), "yyyy-MM-dd")

    iso, first, second = of((1, 4), (6, 2), (9, 2)), of((7, 4), (4, 2), (1, 2)), of((7, 4), (1, 2), (4, 2))
    return F.when(F.substring(m, 5, 1) == "-", iso).when(F.substring(m, 3, 1) == ".", first).otherwise(F.coalesce(first, second))


_BASE = "1800-01-01"


def _month_first(m: Column, key: str) -> Column:
    """A date of the form MM/dd/yyyy with dd > 12. Its number counts such days alone: a
    month has 12 days less, and month i begins with number days(i) - 12 * i."""
    base = F.lit(_BASE).cast("date")

    def begins(i: Column) -> Column:
        return F.datediff(F.add_months(base, i), base) - 12 * i

    def number(d: Column) -> Column:
        i = (F.year(d) - 1800) * 12 + F.month(d) - 1
        return (begins(i) + F.dayofmonth(d) - 13).cast("long")

    def shown(y: Column) -> Column:
        # 88497 days in 4800 months; the guess is wrong by one at most
        guess = F.floor(y * F.lit(4800.0) / F.lit(88497.0)).cast("int")
        month = F.array_max(F.filter(F.transform(F.array(*[F.lit(k) for k in (-2, -1, 0, 1, 2)]), lambda k: guess + k), lambda i: (i >= 0) & (begins(i) <= y)))
        return _let(month, lambda i: F.date_format(F.date_add(F.add_months(base, i), (y - begins(i) + 12).cast("int")), "MM/dd/yyyy"))

    x = _let(_day(m), number)
    return _let(feistel(x, F.lit(9).cast("long"), F.lit(9833).cast("long"), key, F.lit("date, month first")), shown)


def _date(m: Column, key: str) -> Column:
    base = F.lit(_BASE).cast("date")

    def moved(shape: str) -> Column:
        x = F.datediff(_day(m), base).cast("long")
        y = feistel(x, F.lit(189).cast("long"), F.lit(773).cast("long"), key, F.lit("date"))
        return F.date_format(F.date_add(base, y.cast("int")), shape)

    day_first = F.try_to_date(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)), "yyyy-MM-dd").isNotNull()
    return (
        F.when(F.substring(m, 5, 1) == "-", moved("yyyy-MM-dd"))
        .when(F.substring(m, 3, 1) == ".", moved("dd.MM.yyyy"))
        .when(day_first, moved("dd/MM/yyyy")).otherwise(_month_first(m, key))
    )


def _email(m: Column, key: str) -> Column:
    h = F.sha2(F.concat_ws(":", F.lit(key), F.lit("email"), F.lower(m)), 256)
    return F.concat(F.lit("u"), F.substring(h, 1, 16), F.lit("@"), F.element_at(F.split(m, "@"), -1))


def kind_of(m: Column) -> Column:
    """The kind whose form and validation the value passes, or null."""
    digits = _digits(m)
    shape = {k: m.rlike(f"^(?:{p})$") for k, p in {
        "date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}",
        "ip": r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}",
        "phone": r"(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}",
        "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        "card": _CARD,
    }.items()}
    return (
        F.when(F.contains(m, F.lit("@")), F.lit("email"))
        .when(shape["date"], F.when(F.year(_day(m)).between(1800, 2199), F.lit("date")))
        .when(shape["ip"], F.when(F.array_max(_octets(m)) <= 255, F.lit("ip")))
        .when(shape["phone"], F.lit("phone"))
        .when(shape["ssn"], F.when(m.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)"), F.lit("ssn")))
        .when(shape["card"], F.when((_luhn_sum(digits, 0) % 10 == 0) & ~digits.rlike("^(.)\\1+$"), F.lit("card")))
    )


def pseudonym(m: Column, key: str, kind: Column | None = None) -> Column:
    def of(k: Column) -> Column:
        return (
            F.when(k == "email", _email(m, key)).when(k == "date", _date(m, key)).when(k == "ip", _ip(m, key))
            .when(k == "phone", _phone(m, key)).when(k == "ssn", _ssn(m, key)).when(k == "card", _card(m, key)).otherwise(m)
        )

    return _let(kind_of(m), of) if kind is None else of(kind)


def _found(text: Column, pattern: str) -> Column:
    """(value, kind) of every match, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.struct(m.alias("v"), kind_of(m).alias("k")))


def _replaced(text: Column, pattern: str, found: Column, key: str) -> Column:
    """``text`` with its matches replaced, of which ``found`` has the values and kinds."""
    gaps = F.split(text, pattern, -1)
    rebuilt = F.concat(
        F.element_at(gaps, 1),
        F.array_join(F.zip_with(found, F.slice(gaps, 2, F.size(found)), lambda f, g: F.concat(pseudonym(f["v"], key, f["k"]), g)), ""),
    )
    return F.when(F.size(found) > 0, rebuilt).otherwise(text)


def _is(kind: str):
    return lambda f: F.coalesce(f["k"] == kind, F.lit(False))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", counts: bool = False) -> DataFrame:
    """``docs`` with ``text`` replaced, other columns as they were; with ``counts``,
    also ``n_<kind>`` of the values replaced (where ``docs`` has a column of such a name,
    the new one gets underscores in front).

    A null text stays null, an empty one empty; values that fail validation stay;
    repeated rows give equal rows; an empty table gives an empty one.
    """
    column = F.col(f"`{text}`")
    mails, half, numbers = free_name(docs, "found_mails", "text_without_mails", "found_numbers")
    none = F.array().cast("array<struct<v:string,k:string>>")
    # e-mail addresses first: what replaces them holds no number or date. Each step is a
    # column of its own, so a text is searched once for what is found in it and, only if
    # that is something, once more for what lies between
    out = docs.withColumn(mails, F.when(F.contains(column, F.lit("@")), _found(column, PATTERNS["email"])).otherwise(none))
    out = out.withColumn(half, _replaced(column, PATTERNS["email"], F.col(mails), key))
    out = out.withColumn(numbers, F.coalesce(_found(F.col(half), NUMBERS), none))
    more = {}
    if counts:
        kinds = F.concat(mails, numbers)
        names = free_name(docs, *[f"n_{k}" for k in PATTERNS])
        more = {n: F.size(F.filter(kinds, _is(k))).cast("long") for k, n in zip(PATTERNS, names)}
    return out.withColumns({**more, text: _replaced(F.col(half), NUMBERS, F.col(numbers), key)}).drop(mails, half, numbers)
