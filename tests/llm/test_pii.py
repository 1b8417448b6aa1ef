import datetime
import hashlib
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from quire.llm.pii import KEY, RUNS, op2_pii, permuted, pseudonymised

SF = "/root/testdata/sf0.001"


def stream(own, radix, other, tweak, turn, sign):
    digest = hashlib.sha512(f"{tweak}:{turn}:{','.join(map(str, other))}".encode()).hexdigest()
    blocks = [digest, *(hashlib.sha512(f"{digest}:{k}".encode()).hexdigest() for k in range(1, len(own) // 25 + 1))]
    return [(v + sign * int(blocks[i // 25][5 * (i % 25) : 5 * (i % 25) + 5], 16)) % r for i, (v, r) in enumerate(zip(own, radix, strict=True))]


def plain(values, radix, tweak, back=False, key=KEY):
    half, tweak = len(values) // 2, f"{key}:{tweak}:{len(values)}"
    a, b, ra, rb = values[:half], values[half:], radix[:half], radix[half:]
    for turn in reversed(range(1, 9)) if back else range(1, 9):
        if turn % 2:
            a = stream(a, ra, b, tweak, turn, -1 if back else 1)
        else:
            b = stream(b, rb, a, tweak, turn, -1 if back else 1)
    return a + b


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10 == 0


def masked(spark, texts, key=KEY):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.text, r.n) for r in pseudonymised(rows, key, count="n").orderBy("doc_id").collect()]


def test_permutation_against_plain_and_back(spark):
    rnd = random.Random(2)
    rows = [[rnd.randrange(r) for r in radix] for radix in ([10] * 14, [256] * 4, [17, 4297], [26, 1, 10, 10, 26], [7], [16] * 64, [26] * 400) for _ in range(5)]
    radices = [radix for radix in ([10] * 14, [256] * 4, [17, 4297], [26, 1, 10, 10, 26], [7], [16] * 64, [26] * 400) for _ in range(5)]
    df = spark.createDataFrame(list(zip(rows, radices, strict=True)), "v array<long>, r array<long>")
    for got in df.select("v", "r", permuted(F.col("v"), F.col("r"), F.lit("t"), KEY).alias("p")).collect():
        assert got.p == plain(got.v, got.r, "t") and plain(got.p, got.r, "t", back=True) == got.v
    small = {tuple(plain([a, b], [5, 7], "t")) for a in range(5) for b in range(7)}
    assert len(small) == 35


def test_every_kind_keeps_its_format_and_links(spark):
    texts = [
        "4929963689861572", "4929-9636 8986-1572", "4929963689861573", "+1 (811) 555-3281", "(811) 555-3281", "196.3.67.149", "1.2.3.400", "01.2.3.4",
        "1999-02-28", "28/02/1999", "1999-02-30", "2100-01-01", "123-45-6789", "666-45-6789", "GB82 WEST 1234 5698 7654 32", "GB83 WEST 1234 5698 7654 32",
        "x@y.org", "a.B-9@mail.example.com", "08813ad77930c5f691325605b62c9dfd1b407297", "08813AD77930C5F691325605B62C9DFD1B407297", "x4929963689861572", "1234567", "+49 30 1234 5678",
    ]
    got = masked(spark, texts)
    new = dict(zip(texts, (t for t, _ in got), strict=True))
    same = {"4929963689861573", "1.2.3.400", "01.2.3.4", "1999-02-30", "2100-01-01", "666-45-6789", "GB83 WEST 1234 5698 7654 32", "x4929963689861572", "1234567"}
    assert {t for t in texts if new[t] == t} == same and all(n == (t not in same) for t, (_, n) in zip(texts, got, strict=True))
    shape = lambda t: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", t)))
    for t in texts:
        assert shape(new[t]) == shape(t) or "." in t or re.fullmatch("(?i)[0-9a-f]{40}", new[t])
    digits = lambda t: re.sub(r"\D", "", t)
    assert luhn([*map(int, new["4929963689861572"])]) and digits(new["4929-9636 8986-1572"]) == new["4929963689861572"]
    assert digits(new["+1 (811) 555-3281"]) == "1" + digits(new["(811) 555-3281"])
    y, m, d = new["1999-02-28"].split("-")
    assert new["28/02/1999"] == f"{d}/{m}/{y}" and datetime.date(int(y), int(m), int(d))
    iban = new["GB82 WEST 1234 5698 7654 32"].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert all(0 <= int(p) <= 255 for p in new["196.3.67.149"].split("."))
    assert new["a.B-9@mail.example.com"].endswith("@mail.example.com")
    assert new["08813AD77930C5F691325605B62C9DFD1B407297"].lower() == new["08813ad77930c5f691325605b62c9dfd1b407297"]
    assert masked(spark, ["4929963689861572"], "other")[0][0] != new["4929963689861572"]


def plain_name(name, back=False, domain="@example.org"):
    at = [next((r for r in RUNS if r[0] <= ord(c) <= r[1]), (ord(c), ord(c))) for c in name]
    new = plain([ord(c) - low for c, (low, _) in zip(name, at, strict=True)], [high - low + 1 for low, high in at], "email" if len(name) > 3 else f"email{domain}", back)
    return "".join(chr(low + v) for v, (low, _) in zip(new, at, strict=True))


def test_runs_are_letters_or_digits_of_one_script(spark):
    assert len({c for a, b in RUNS for c in range(a, b + 1)}) == sum(b - a + 1 for a, b in RUNS)
    for a, b in RUNS:
        kinds = {unicodedata.category(chr(c))[0] for c in range(a, b + 1)}
        assert len(kinds) == 1 and kinds <= {"L", "N"}
    assert (0x5D0, 0x5EA) in RUNS and (0xFF10, 0xFF19) in RUNS and (0x660, 0x669) in RUNS and any(a <= 0x3B1 and b >= 0x3C9 for a, b in RUNS)


def test_names_and_secrets_of_any_length_and_script(spark):
    names = ["иван.петров", "李雷", "김철수", "jürgen.müller", "γιώργος", "वि.के", "a" * 10_000, "x9" * 80, "𝒜a", "יוסף", "５１２３", "ａｂｃ", "محمد٣", "ひらカタ", "x", "y", "Łukasz"]
    secrets = ["0123456789abcdef" * 8, "a" * 65, "F" * 500]
    got = masked(spark, [f"{n}@example.org" for n in names] + secrets)
    again = masked(spark, [t for t, _ in got])
    for n, (new, count), (_, found) in zip(names, got, again, strict=False):
        assert count == found == 1 and new == f"{plain_name(n)}@example.org" and plain_name(new[: -len("@example.org")], back=True) == n
        assert [unicodedata.category(c)[0] for c in new] == [unicodedata.category(c)[0] for c in f"{n}@example.org"]
    for s, (new, count) in zip(secrets, got[len(names) :], strict=True):
        half = plain([int(c, 16) for c in s], [16] * len(s), "secret")
        assert count == 1 and new.lower() == "".join(f"{v:x}" for v in half) and new.isupper() == s.isupper()
    mixed = "0aF9" * 10
    (new, count), (dotted, none) = masked(spark, [mixed, "1.2.3.4.5 and 1.2.3.4."])
    letters = "0123456789abcdefABCDEF"
    of = lambda c: (0, 10) if c.isdigit() else (10, 6) if c.islower() else (16, 6)
    back = plain([letters.index(c) - of(c)[0] for c in new], [of(c)[1] for c in new], "mixed secret", back=True)
    assert count == 1 and new != mixed and "".join(letters[of(c)[0] + v] for c, v in zip(new, back, strict=True)) == mixed
    assert none == 1 and dotted.startswith("1.2.3.4.5 and ")
    assert len({new[0] for new, _ in masked(spark, [f"x@{d}.org" for d in "abcde"])}) > 1
    long = got[6][0][:10_000]
    assert all(long[k : k + 60] not in long[k + 1 :] for k in range(0, 9_000, 500))  # no period


def test_regex_does_not_recurse(spark):
    (new, count), (same, none) = masked(spark, ["a@b" + ".b" * 1_000_000, "a@" + "z" * 2_000_000])
    assert count == 1 and new.endswith("@b" + ".b" * 1_000_000) and none == 0 and same.startswith("a@zzz")


def plain_date(y, m, d):
    per, first, high, low = (12, 1, 160, 180) if d <= 12 else (19, 13, 200, 228)
    x = ((y - 1900) * 12 + m - 1) * per + d - first
    while True:
        a, b = plain([x // low, x % low], [high, low], "date" if d <= 12 else "late date")
        x = a * low + b
        try:
            return datetime.date(1900 + x // per // 12, x // per % 12 + 1, x % per + first)
        except ValueError:
            continue


def test_dates_of_every_order(spark):
    rnd = random.Random(4)
    days = [datetime.date(1900, 1, 1) + datetime.timedelta(rnd.randrange(73_049)) for _ in range(60)] + [datetime.date(2000, 2, 29), datetime.date(1999, 12, 31)]
    texts = [t for x in days for t in (f"{x}", f"{x:%d/%m/%Y}", f"{x:%m/%d/%Y}", f"{x.day}.{x.month}.{x.year}")]
    got = [t for t, _ in masked(spark, texts)]
    for k, x in enumerate(days):
        new = plain_date(x.year, x.month, x.day)
        assert got[4 * k] == f"{new}" and got[4 * k + 1] == f"{new:%d/%m/%Y}" and (new.day > 12) == (x.day > 12)
        if x.day > 12:  # else it reads as day and month
            assert got[4 * k + 2] == f"{new:%m/%d/%Y}"
        if min(x.day, x.month) < 10:
            assert got[4 * k + 3] == f"{new.day}.{new.month}.{new.year}"
    assert masked(spark, ["12/25/1990"])[0][1] == 1 and masked(spark, ["13/25/1990", "0/1/1990", "1/1/2100"])[0][1] == 0


def test_odd_texts(spark):
    long = "word " * 300_000 + "4929963689861572" + " word" * 300_000
    run = "-" * 200_000 + "@"
    got = masked(spark, [None, "", "no digits", long, run, "4929963689861572!!\n4929963689861572"])
    assert got[:3] == [(None, 0), ("", 0), ("no digits", 0)]
    card = got[5][0][:16]
    assert got[5] == (f"{card}!!\n{card}", 2) and got[3] == (long.replace("4929963689861572", card), 1) and got[4] == (run, 0)


def test_other_columns_stay(spark):
    docs = spark.createDataFrame([(None, "mail a@b.co", "x", 1)], "doc_id long, text string, part string, n long")
    out = pseudonymised(docs)
    assert out.columns == docs.columns and out.first().part == "x"
    assert pseudonymised(docs.limit(0)).count() == 0


def test_query_changes_only_values(spark):
    old = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op2_pii(spark, SF).collect()
    assert len(rows) == len(old) and sum(r.n_replaced for r in rows) > 10
    for r in rows:
        assert (r.text == old[r.doc_id]) == (r.n_replaced == 0)
        was, now = re.split(r"\s+", old[r.doc_id]), re.split(r"\s+", r.text)
        assert len(was) == len(now) and all(re.search(r"[0-9@]", a) for a, b in zip(was, now, strict=True) if a != b)
