"""Format-preserving pseudonyms: validated numbers, dates and addresses are permuted within their format by a keyed Feistel network."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROUNDS = 8
#: The key of tests and of the query; a real run passes its own.
KEY = "not-a-secret"

#: Shapes by kind, tried in this order at each place of a text. Repeats without a bound are possessive: they neither go back nor nest.
SHAPES = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]++@[\p{L}\p{M}\p{N}-]++(?:\.[\p{L}\p{M}\p{N}-]++)++",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
    "secret": r"[0-9A-Fa-f]{32,}+",
    "ip": r"(?<![0-9]\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.[0-9])",
    "date": r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[/.][0-9]{1,2}[/.][0-9]{4})",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})",
    "card": r"[0-9](?:[ -]?[0-9]){12,18}",
}
PATTERN = r"(?<![\p{L}\p{N}])(?:" + "|".join(SHAPES.values()) + r")(?![\p{L}\p{N}])"
#: Years whose dates are replaced. Days up to the 12th of a month, and later ones, are permuted among themselves: places of
#: a month, its first of them, and the two radices whose product is the number of places of all years.
YEARS = (1900, 2099)
EARLY, LATE = (12, 1, 160, 180), (19, 13, 200, 228)
#: A late place beyond the end of its month is permuted on, which one in thirty is; so many times at most.
WALK = 24
#: Draws that a digest yields.
DRAWS = 25
def _runs() -> list[tuple[int, int]]:
    """Code points that are permuted among themselves: runs of letters, or of digits, in a row, as Unicode 3.2 has them, which every later version
    keeps. Capitals and small letters keep apart, but where they alternate."""
    kind = {"Lu": "Lu", "Ll": "Ll", "Lo": "Lo", "Nd": "Nd"}
    runs: list[list] = []  # kind, first, last
    for c in range(0x10000):
        own = kind.get(unicodedata.ucd_3_2_0.category(chr(c)))
        if own and unicodedata.category(chr(c))[0] == own[0]:  # a few have become marks since
            if runs and runs[-1][0] == own and runs[-1][2] == c - 1 and (own != "Nd" or c - runs[-1][1] < 10):
                runs[-1][2] = c
            else:
                runs.append([own, c, c])
    out: list[list] = []
    for own, first, last in runs:
        short = own != "Nd" and last - first < 7
        if short and out and out[-1][3] and out[-1][2] == first - 1:
            out[-1][2] = last
        else:
            out.append([own, first, last, short])
    return [(first, last) for _, first, last, _ in out if last > first]


RUNS = _runs()


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _added(own: Column, radix: Column, other: Column, tweak: Column, turn: Column) -> Column:
    """own + keystream(other) in each place, modulo the place's radix; the first DRAWS places draw from one digest, the next from a digest of it."""
    stream = F.sha2(F.concat_ws(":", tweak, turn.cast("string"), F.array_join(other.cast("array<string>"), ",")).cast("binary"), 512)
    # a lambda sees the digest as an array element of its own, or it would be taken anew for every place
    draws = lambda h: F.transform(F.sequence(F.lit(0), F.lit(DRAWS - 1)), lambda i: F.conv(F.substr(h, 1 + i * 5, F.lit(5)), 16, 10).cast("long"))
    digest = lambda h, k: F.when(k == 0, h).otherwise(F.sha2(F.concat_ws(":", h, k.cast("string")).cast("binary"), 512))
    blocks = F.sequence(F.lit(0), F.floor((F.greatest(F.size(own), F.lit(1)) - 1) / DRAWS).cast("int"))
    drawn = _let(stream, lambda h: F.flatten(F.transform(blocks, lambda k: _let(digest(h, k), draws))))
    return F.zip_with(F.zip_with(own, radix, lambda v, r: F.struct(v.alias("v"), r.alias("r"))), F.slice(drawn, F.lit(1), F.size(own)), lambda x, s: (x["v"] + s) % x["r"])


def permuted(values: Column, radix: Column, tweak: Column, key: str) -> Column:
    """Feistel permutation of an array<bigint> whose i-th value is below the i-th radix; a radix of 1 fixes its place.

    The halves take turns: the odd rounds add a keyed digest of the second half to the first, the even ones the reverse,
    each modulo its radix, so the result has the same length and radices and the map can be undone. Equal values
    under one tweak and key have equal results. Any number of places.
    """
    half = F.floor(F.size(values) / 2).cast("int")
    rest = F.size(values) - half
    tweak = F.concat_ws(":", F.lit(key), tweak, F.size(values).cast("string"))
    start = F.struct(*[F.slice(c, a, n).alias(k) for k, c, a, n in (("a", values, F.lit(1), half), ("b", values, half + 1, rest), ("ra", radix, F.lit(1), half), ("rb", radix, half + 1, rest))])

    def turn(s: Column, r: Column) -> Column:
        odd = r % 2 == 1
        a = F.when(odd, _added(s["a"], s["ra"], s["b"], tweak, r)).otherwise(s["a"])
        b = F.when(odd, s["b"]).otherwise(_added(s["b"], s["rb"], s["a"], tweak, r))
        return F.struct(a.alias("a"), b.alias("b"), s["ra"].alias("ra"), s["rb"].alias("rb"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: F.concat(s["a"], s["b"]))


def _chars(text: Column) -> Column:
    return F.split(text, "")


def _numbers(digits: Column) -> Column:
    return F.transform(_chars(digits), lambda c: c.cast("long"))


def _written(shown: Column, places: str, new: Column) -> Column:
    """`shown` with the characters of class `places` replaced, in order, by those of the string `new`."""
    return F.array_join(F.zip_with(F.split(shown, places, -1), _chars(new), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


_HEX = "0123456789abcdef"


def _by_class(text: Column, tweak: Column, key: str) -> Column:
    """Letters and digits permuted within their alphabet, whatever the script; marks stay, and letters that came after Unicode 3.2. Any length."""
    ascii_, others = (F.from_json(F.lit(json.dumps([{"a": a, "b": b} for a, b in RUNS if (a < 128) == low])), "array<struct<a:int,b:int>>") for low in (True, False))

    def place(c: Column) -> Column:
        of = lambda own: F.get(F.filter(own, lambda r: c.between(r["a"], r["b"])), 0)
        run = F.when(c < 128, of(ascii_)).otherwise(of(others))
        base, many = F.coalesce(run["a"], c), F.coalesce(run["b"] - run["a"] + 1, F.lit(1))
        return F.struct((c - base).cast("long").alias("v"), many.cast("long").alias("r"), base.alias("base"))

    def moved(places: Column) -> Column:
        new = permuted(F.transform(places, lambda p: p["v"]), F.transform(places, lambda p: p["r"]), tweak, key)
        # a code point becomes a character by way of its four bytes
        char = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return F.array_join(F.zip_with(places, new, lambda p, v: char(p["base"] + v)), "")

    return _let(F.transform(_chars(text), lambda c: place(F.ascii(c))), moved)


def _hex(shown: Column, key: str) -> Column:
    new = permuted(F.transform(_chars(shown), lambda c: F.instr(F.lit(_HEX), F.lower(c)).cast("long") - 1), F.transform(_chars(shown), lambda c: F.lit(16).cast("long")), F.lit("secret"), key)
    low = F.array_join(F.transform(new, lambda v: F.substr(F.lit(_HEX), v.cast("int") + 1, F.lit(1))), "")
    # where both cases occur, digits, small letters and capitals are permuted among themselves, each a place of its own radix
    place = F.transform(_chars(shown), lambda c: F.struct((F.instr(F.lit("0123456789abcdefABCDEF"), c) - 1).alias("at")))
    place = F.transform(place, lambda p: F.when(p["at"] < 10, F.struct(p["at"].alias("v"), F.lit(10).alias("r"), F.lit(0).alias("from"))).when(p["at"] < 16, F.struct((p["at"] - 10).alias("v"), F.lit(6).alias("r"), F.lit(10).alias("from"))).otherwise(F.struct((p["at"] - 16).alias("v"), F.lit(6).alias("r"), F.lit(16).alias("from"))))
    each = lambda c: F.transform(place, lambda p: p[c].cast("long"))
    mixed = F.array_join(F.zip_with(permuted(each("v"), each("r"), F.lit("mixed secret"), key), each("from"), lambda v, a: F.substr(F.lit("0123456789abcdefABCDEF"), (v + a + 1).cast("int"), F.lit(1))), "")
    return F.when(shown.rlike("[A-F]") & shown.rlike("[a-f]"), mixed).when(shown.rlike("[A-F]"), F.upper(low)).otherwise(low)


def _luhn_digit(payload: Column) -> Column:
    """The check digit behind an array of digits."""
    each = F.transform(F.reverse(payload), lambda d, i: F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return (10 - F.aggregate(each, F.lit(0).cast("long"), lambda a, d: a + d) % 10) % 10


def _card(shown: Column, key: str) -> Column:
    """Valid by its check digit: the first digit stays, the others are permuted, the check digit is made anew."""
    digits = F.regexp_replace(shown, "[^0-9]", "")
    d = _numbers(digits)
    payload = F.slice(d, F.lit(1), F.size(d) - 1)
    body = F.slice(d, F.lit(2), F.size(d) - 2)
    new = F.concat(F.slice(d, F.lit(1), F.lit(1)), permuted(body, F.transform(body, lambda v: F.lit(10).cast("long")), F.lit("card"), key))
    new = F.concat(F.array_join(new.cast("array<string>"), ""), _luhn_digit(new).cast("string"))
    return F.when(_luhn_digit(payload) == F.element_at(d, -1), _written(shown, "[0-9]", new)).otherwise(shown)


def _phone(shown: Column, key: str) -> Column:
    """The country code stays, and in a North American number the first digit of area and exchange; the rest is permuted."""
    digits = F.regexp_replace(shown, "[^0-9]", "")
    plus = shown.startswith("+")
    code = F.when(plus, F.regexp_extract(digits, "^(1|7|[0-9]{2})", 1)).otherwise("")
    national = F.substr(digits, F.length(code) + 1)
    american = ~plus | (code == "1")
    d = _numbers(national)
    radix = F.transform(d, lambda v, i: F.when(american & i.isin(0, 3), 1).otherwise(10).cast("long"))
    new = permuted(F.zip_with(d, radix, lambda v, r: F.when(r == 1, 0).otherwise(v).cast("long")), radix, F.concat(F.lit("phone"), F.when(american, "1").otherwise(code)), key)
    new = F.zip_with(F.zip_with(d, radix, lambda v, r: F.struct(v.alias("v"), r.alias("r"))), new, lambda x, v: F.when(x["r"] == 1, x["v"]).otherwise(v))
    valid = F.when(plus, F.length(digits).between(8, 15)).otherwise(national.rlike("^[2-9]..[2-9]"))
    return F.when(valid, _written(shown, "[0-9]", F.concat(code, F.array_join(new.cast("array<string>"), "")))).otherwise(shown)


def _ip(shown: Column, key: str) -> Column:
    """Four numbers up to 255 without leading zeros."""
    parts = F.split(shown, r"\.").cast("array<long>")
    valid = ~F.exists(parts, lambda v: v > 255) & ~shown.rlike(r"(^|\.)0[0-9]")
    new = permuted(parts, F.transform(parts, lambda v: F.lit(256).cast("long")), F.lit("ip"), key)
    return F.when(valid, F.array_join(new.cast("array<string>"), ".")).otherwise(shown)


def _ssn(shown: Column, key: str) -> Column:
    """Area 001 to 899 without 666, group and serial not zero."""
    area, group, serial = (F.substr(shown, F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    one = F.lit(1).cast("long")
    new = permuted(F.array(F.when(area > 666, area - 2).otherwise(area - 1), group - 1, serial - 1), F.array(one * 898, one * 99, one * 9999), F.lit("ssn"), key)
    written = F.transform(F.array(new), lambda x: F.concat_ws("-", _padded(F.when(x[0] >= 665, x[0] + 2).otherwise(x[0] + 1), 3), _padded(x[1] + 1, 2), _padded(x[2] + 1, 4)))
    return F.when(valid, F.get(written, 0)).otherwise(shown)


def _date(shown: Column, key: str) -> Column:
    """A day of 1900 to 2099: year-month-day, day/month/year, or month/day/year where the month cannot be one.

    A day has one pseudonym however it is written, and it is written the same way. Days up to the 12th and later ones are
    permuted apart, so that a month/day/year stays one that cannot be read otherwise. A date with a part of one digit is written
    without leading zeros.
    """
    long = lambda k: F.regexp_extract(shown, r"^([0-9]+)[^0-9]([0-9]+)[^0-9]([0-9]+)$", k).cast("long")

    def valid(y: Column, m: Column, d: Column) -> Column:
        leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
        last = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
        return y.between(*YEARS) & m.between(1, 12) & d.between(1, last)

    def day(x: Column, kind: tuple[int, int, int, int]) -> tuple[Column, Column, Column]:
        month = F.floor(x / kind[0])
        return YEARS[0] + F.floor(month / 12), month % 12 + 1, x % kind[0] + kind[1]

    def moved(p: Column, kind: tuple[int, int, int, int], name: str) -> Column:
        per, first, high, low = kind
        one = lambda v: F.lit(v).cast("long")
        turn = lambda x: _let(permuted(F.array(F.floor(x / low), x % low), F.array(one(high), one(low)), F.lit(name), key), lambda n: n[0] * low + n[1])
        index = ((p["y"] - YEARS[0]) * 12 + p["m"] - 1) * per + p["d"] - first
        walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), turn(index), lambda x, _: F.when(valid(*day(x, kind)), x).otherwise(turn(x)))
        return _let(walked, lambda x: F.struct(*[v.cast("long").alias(k) for k, v in zip("ymd", day(x, kind), strict=True)]))

    iso, bare = shown.rlike("^[0-9]{4}-"), shown.rlike(r"(?:^|[/.])[0-9][/.]")
    y, a, b = F.when(iso, long(1)).otherwise(long(3)), F.when(iso, long(3)).otherwise(long(1)), long(2)
    day_first = iso | valid(y, b, a)
    m, d = F.when(day_first, b).otherwise(a), F.when(day_first, a).otherwise(b)

    def written(p: Column) -> Column:
        new = F.when(p["d"] <= EARLY[0], moved(p, EARLY, "date")).otherwise(moved(p, LATE, "late date"))
        two = lambda v: F.when(bare, v.cast("string")).otherwise(_padded(v, 2))
        mark = F.regexp_extract(shown, "[/.]", 0)
        apart = lambda n: F.when(iso, F.concat_ws("-", n["y"].cast("string"), _padded(n["m"], 2), _padded(n["d"], 2))).otherwise(F.concat(F.when(day_first, two(n["d"])).otherwise(two(n["m"])), mark, F.when(day_first, two(n["m"])).otherwise(two(n["d"])), mark, n["y"].cast("string")))
        return F.when(valid(p["y"], p["m"], p["d"]), _let(new, apart)).otherwise(shown)

    return _let(F.struct(y.alias("y"), m.alias("m"), d.alias("d")), written)


def _mod97(text: Column) -> Column:
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55).cast("long")
    return F.aggregate(F.transform(_chars(text), value), F.lit(0).cast("long"), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)


def _iban(shown: Column, key: str) -> Column:
    """Valid by its check number: the country stays, the account is permuted by class, the check number is made anew."""
    text = F.regexp_replace(shown, " ", "")
    country, account = F.substr(text, F.lit(1), F.lit(2)), F.substr(text, F.lit(5))
    written = F.transform(F.array(_by_class(account, F.concat(F.lit("iban"), country), key)), lambda new: _written(shown, "[A-Z0-9]", F.concat(country, _padded(98 - _mod97(F.concat(new, country, F.lit("00"))), 2), new)))
    valid = _mod97(F.concat(account, F.substr(text, F.lit(1), F.lit(4)))) == 1
    return F.when(valid, F.get(written, 0)).otherwise(shown)


def _email(shown: Column, key: str) -> Column:
    """The name is permuted; the domain stays readable, as it rarely tells who someone is. Names of one to three characters have a permutation for each domain."""
    name = F.substring_index(shown, "@", 1)
    domain = F.substr(shown, F.length(name) + 1)
    tweak = F.when(F.length(name) > 3, "email").otherwise(F.concat(F.lit("email"), F.lower(domain)))
    return F.concat(_by_class(name, tweak, key), domain)


_MAKERS = {"email": _email, "iban": _iban, "secret": _hex, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def pseudonym(shown: Column, key: str = KEY) -> Column:
    """The pseudonym of one match of PATTERN, or the match itself where validation fails."""
    out = None
    for kind, shape in SHAPES.items():
        is_kind, made = shown.rlike(f"^(?:{shape})$"), _MAKERS[kind](shown, key)
        out = F.when(is_kind, made) if out is None else out.when(is_kind, made)
    return out.otherwise(shown)


def pseudonymised(docs: DataFrame, key: str = KEY, count: str | None = None) -> DataFrame:
    """`docs` with every validated value in `text` replaced by its pseudonym; other columns as they are.

    Kinds: names of e-mail addresses in any script (their domains stay readable), IBANs, hexadecimal secrets of 32 digits or
    more, IPv4 addresses, dates, US social security numbers, phone and card numbers; values of any length. A text without such a
    value is passed on as it is; a null text stays null. Whole texts are
    searched; there is no shuffle. A column of the name `count` is replaced, one named part__ is not allowed. `count` names a bigint column for the number of values replaced (0 for null).
    """
    text = F.col("text")
    shown = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    parts = F.transform(F.array(shown), lambda m: F.struct(F.split(text, PATTERN, -1).alias("between"), m.alias("shown"), F.transform(m, lambda x: pseudonym(x, key)).alias("new")))
    # an explode of one row: the parts are made once, though used several times below
    rows = docs.withColumn("part__", F.explode(F.array(F.when(text.rlike("[0-9@]|[A-Fa-f]{32}"), F.get(parts, 0)))))
    new = F.array_join(F.zip_with("part__.between", "part__.new", lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    if count:
        changed = F.filter(F.zip_with("part__.shown", "part__.new", lambda a, b: a != b), lambda c: c)
        rows = rows.withColumn(count, F.when(F.col("part__").isNull(), 0).otherwise(F.size(changed)).cast("long"))
    return rows.withColumn("text", F.when(F.size("part__.shown") > 0, new).otherwise(text)).drop("part__")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_replaced and the pseudonymised text of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymised(docs, count="n_replaced").select("doc_id", "n_replaced", "text")
