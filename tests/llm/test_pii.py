"""Pseudonyms: bijective, in format, the same everywhere, in SQL only."""

import datetime
import hashlib
import re

import regex
from llm_help import documents
from pyspark.sql import functions as F

from visitmill.llm import pii


def luhn(digits):
    return sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
               for k, d in enumerate(int(c) for c in reversed(digits))) % 10


def replaced(spark, texts, key="k"):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text"] for r in pii.pseudonymised(frame, key).orderBy("doc_id").collect()]


def test_formats(spark):
    card = "4111 1111 1111 1111"
    texts = [f"pay {card}.", "call +1 (212) 555-0100 now", "host 10.1.2.3, ok", "born 1987-02-28 or 28.02.1987",
             "mail ann.Lee@mail.example.com!", 'token = "' + "0123456789abcdef" * 2 + '00ff00ff"', card]
    got = replaced(spark, texts)
    number = got[0][4:-1]
    assert number != card and re.fullmatch(r"\d{4} \d{4} \d{4} \d{4}", number) and luhn(number.replace(" ", "")) == 0
    assert got[6] == number
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} now", got[1]) and got[1] != texts[1]
    address = re.fullmatch(r"host ([\d.]+), ok", got[2])[1]
    assert address != "10.1.2.3" and all(0 <= int(x) < 256 for x in address.split("."))
    first, second = re.fullmatch(r"born (\S+) or (\S+)", got[3]).groups()
    day = datetime.date.fromisoformat(first)
    assert second == day.strftime("%d.%m.%Y") and 1900 <= day.year < 2100 and first != "1987-02-28"
    assert "ann" not in got[4] and "@" in got[4] and "0123456789abcdef" not in got[5]
    assert len(got[5]) == len(texts[5]) and replaced(spark, texts) == got != replaced(spark, texts, "other")


def test_what_does_not_hold_stays(spark):
    texts = ["4111 1111 1111 1112", "300.1.2.3", "2023-02-30", "1.2.3.4.5", "order 23904", "v1.2 in 2024",
             "1899-12-31", "", None, "a@b", "deadbeef", "12345678901234567890123", "3/4 and 1,000,000"]
    assert replaced(spark, texts) == texts


def test_digits_are_permuted(spark):
    for n in (2, 3):
        numbers = spark.range(10**n).select(F.lpad(F.col("id").cast("string"), n, "0").alias("d"))
        got = {r[0] for r in numbers.selectExpr(pii.permuted_digits("d", "'k'")).collect()}
        assert got == {str(i).zfill(n) for i in range(10**n)}


def test_dates_are_permuted(spark):
    days = spark.range(73_049).selectExpr("date_format(date_add(date'1900-01-01', int(id)), 'yyyy-MM-dd') as m")
    moved = days.selectExpr(f"{pii._date('m', repr('k'))} as p")
    row = moved.agg(F.countDistinct("p"), F.min("p"), F.max("p")).first()
    assert tuple(row) == (73_049, "1900-01-01", "2099-12-31")


def test_odd_rows(spark, odd):
    out = pii.pseudonymised(odd.docs, "k'\\")
    assert out.columns == [*odd.docs.columns, "_n_found", "n_replaced"]
    got = out.collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted(odd.rows, key=repr)
    assert pii.pseudonymised(odd.none, "k").count() == 0
    twice = documents(spark, [(1, "1.2.3.4 1.2.3.4")])
    text = pii.pseudonymised(twice, "k").first()["text"].split(" ")
    assert text[0] == text[1] != "1.2.3.4"


def test_no_python(spark, odd, capsys):
    pii.pseudonymised(odd.docs, "k").explain()
    assert not re.search("Python|Pandas|Arrow|Exchange", capsys.readouterr().out)


def keyed(key, tweak, r, half):
    return int(hashlib.sha256(f"{key}{tweak}:{r}:{half}".encode()).hexdigest()[:12], 16)


def plain_network(a, b, radix_a, radix_b, key, tweak):
    for r in range(pii.ROUNDS):
        if r % 2 == 0:
            a = (a + keyed(key, tweak, r, b)) % radix_a
        else:
            b = (b + keyed(key, tweak, r, a)) % radix_b
    return a, b


def plain_digits(digits, key, tweak):
    half = len(digits) // 2
    a, b = plain_network(int(digits[:half] or 0), int(digits[half:]), 10**half, 10**(len(digits) - half),
                         key, f"{tweak}{len(digits)}")
    return str(a).zfill(half) + str(b).zfill(len(digits) - half)


def into(shape, digits):
    left = iter(digits)
    return "".join(next(left) if c in "0123456789" else c for c in shape)


def plain_pseudonym(m, key):
    """The pseudonym of a match in Python."""
    digits = re.sub("[^0-9]", "", m)
    if "@" in m:
        known = re.search(r"[.][A-Za-z]{2}[^@]*$", m)
        return f"u{hashlib.sha256(f'{key}mail{m.lower()}'.encode()).hexdigest()[:20]}@example.com" if known else m
    if re.fullmatch(r"(?:[0-9]{1,3}[.]){3}[0-9]{1,3}", m):
        p = [int(x) for x in m.split(".")]
        if max(p) > 255:
            return m
        a, b = plain_network(p[0] * 256 + p[1], p[2] * 256 + p[3], 65536, 65536, key, "ip")
        return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    if re.fullmatch(r"[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}|[0-9]{2}[/.][0-9]{2}[/.][0-9]{4}", m):
        for layout in ("%Y-%m-%d", "%Y/%m/%d", "%d.%m.%Y", "%d/%m/%Y", "%m/%d/%Y"):
            try:
                day = datetime.datetime.strptime(m, layout).date()
            except ValueError:
                continue
            n = (day - datetime.date(1900, 1, 1)).days
            if not 0 <= n < 17 * 4297:
                return m
            a, b = plain_network(n // 4297, n % 4297, 17, 4297, key, "date")
            moved = datetime.date(1900, 1, 1) + datetime.timedelta(a * 4297 + b)
            return moved.strftime(layout)
        return m
    if re.search("[a-f]", m):
        return hashlib.sha256(f"{key}secret{m}".encode()).hexdigest()[:len(m)]
    if re.fullmatch(r"[0-9](?:[ -]?[0-9]){12,18}", m):
        if luhn(digits):
            return m
        payload = plain_digits(digits[:-1], key, "card")
        return into(m, payload + str((10 - luhn(payload + "0")) % 10))
    code = re.match(r"[+][0-9]{1,3}(?=[ .(-])|", m)[0]
    rest = m[len(code):]
    return code + into(rest, plain_digits(re.sub("[^0-9]", "", rest), key, f"phone{code}"))


def plain(text, key):
    return text and regex.sub(pii.PATTERN, lambda m: plain_pseudonym(m[0], pii.derived_key(key)), text)


EVERY_KIND = [
    "a.b+c@d-e.example.co.uk, x@y.de.", "x@1.2.3.4 and x@y.z.1", "a@b..com a@-.com @x.com", "10.0.0.255 256.1.1.1 1.2.3.4.",
    "1999-12-31 2000/02/29 31.01.2001 02/03/2004 13/14/2005 12/31/2006 2099-12-31 2100-01-01 1900-01-01",
    "4111-1111-1111-1111 4111111111111111 378282246310005 4111 1111 1111 1112 6011000990139424",
    "+49 30 1234567 (030) 1234-5678 212-555-0100 123-45-6789 +1 212 555 0100 +33.1.23.45.67.89",
    "deadbeef" * 4 + "1 " + "a1" * 16 + " " + "0" * 40, "0x" + "ab12" * 10]


def test_equals_a_plain_version(spark):
    """Every kind of match, and all documents that hold one."""
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(
        "text rlike '[0-9@]'").select("text").collect()]
    texts += EVERY_KIND
    want = [plain(t, "k") for t in texts]
    assert replaced(spark, texts) == want
    assert sum(a != b for a, b in zip(texts, want, strict=True)) > 40


def test_the_inverse_gives_numbers_and_dates_back(spark):
    texts = ["10.1.2.3 4111 1111 1111 1111", "1987-02-28, 2024/01/31; 28.02.1987", "+1 (212) 555-0100 and 212-555-0100",
             "378282246310005 +49 30 1234567"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    moved = pii.pseudonymised(frame, "k").select("doc_id", "text")
    assert all(r["text"] != texts[r["doc_id"]] for r in moved.collect())
    back = pii.pseudonymised(moved, "k", inverse=True).orderBy("doc_id").collect()
    assert [r["text"] for r in back] == texts
    days = spark.range(73_049).selectExpr("date_format(date_add(date'1900-01-01', int(id)), 'yyyy-MM-dd') as m")
    again = days.selectExpr("m", f"{pii._date('m', repr('k'))} as p").selectExpr(
        "m", f"{pii._date('p', repr('k'), True)} as q")
    assert again.where("m <> q").count() == 0


MB = 1 << 20
LONG = {
    "labels": "x@" + "a." * (MB // 2) + "com", "no end": "x@" + "a-" * (MB // 2), "local": "x." * (MB // 2),
    "signs": "@" * MB, "pairs": "a@a" * (MB // 3), "mails": "a@b.c" * (MB // 5), "dots": "x@a" + "." * MB,
    "addresses": "1." * (MB // 2), "dates": "2000-01-" * (MB // 8), "digits": "1" * MB, "cards": "1 " * (MB // 2),
    "dashes": "1-" * (MB // 2), "phones": "+1 23 " * (MB // 6), "brackets": "(12) " * (MB // 5),
    "secrets": "a" * MB, "hex": "a1" * (MB // 2), "both": "1" * (MB // 2) + "a" * (MB // 2)}


def test_long_texts_of_one_kind(spark):
    """A megabyte that each alternative has to follow, in reasonable time and stack."""
    got = replaced(spark, list(LONG.values()))
    assert len(got) == len(LONG) and all(got)
    unchanged = {"no end", "local", "signs", "dots", "addresses", "digits", "secrets", "hex", "both"}
    for (name, text), new in zip(LONG.items(), got, strict=True):
        if name in unchanged:
            assert new == text, name
    assert re.fullmatch("u[0-9a-f]{20}@example.com", got[0])


def test_the_callers_key_is_in_no_plan(spark, odd, capsys):
    pii.pseudonymised(odd.docs, "very private").explain("extended")
    shown = capsys.readouterr().out
    assert "very private" not in shown and pii.derived_key("very private") in shown
