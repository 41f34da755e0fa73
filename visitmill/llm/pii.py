"""Format-preserving pseudonyms of personal data, in SQL expressions only.

Numbers and dates that hold as such are permuted by a keyed Feistel network within their
format, so the same value has the same pseudonym in every document, and different values
different ones. Addresses of mail and secrets, which have no such domain, get keyed
stand-ins of the same shape.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.llm.rows import fresh

# Rounds of the Feistel network.
ROUNDS = 8

#: What is looked for, in order; each is validated again before it is replaced. Groups repeat
#: a fixed number of times or without giving back, as the JVM matches others by recursion.
MAIL = (r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?=[A-Za-z0-9.-]*\.[A-Za-z]{2})"
        r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+")
ADDRESS = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)"
DATE = (r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})"
        r"(?![\d]|[/.-]\d)")
CARD = r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d]|-\d)"
PHONE = (r"(?<![\d\p{L}+(])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}"
         r"|\d{3}[ .-]\d{3}[ .-]\d{4}|\d{3}-\d{2}-\d{4})(?![\d]|-\d)"
         r"|(?<![\d\p{L}+(])\+\d{1,3}[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![\d])")
SECRET = r"(?<![\p{L}\p{N}])(?=[a-f]*+\d)(?=\d*+[a-f])[0-9a-f]{32,64}(?![\p{L}\p{N}])"
PATTERN = "|".join(f"(?:{p})" for p in (MAIL, ADDRESS, DATE, CARD, PHONE, SECRET))

#: Days of the years 1900 to 2099, as 17 times 4297, the radices of the network for dates.
FIRST_DAY, DATE_RADICES = "date'1900-01-01'", (17, 4297)


def _sql(text: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def feistel(
    left: str, right: str, left_radix: str, right_radix: str, tweak: str, inverse: bool = False
) -> str:
    """SQL of a keyed permutation of (left, right), below their radices: a struct (a, b).

    Each round adds a keyed hash of one half to the other, modulo its radix, which the
    inverse undoes by subtracting, last round first; so different values never meet.
    """
    def moved(half: str, other: str, radix: str) -> str:
        hashed = (f"cast(conv(substr(sha2(concat_ws(':', {tweak}, r, s.{other}), 256), 1, 12), 16, 10) as bigint)")
        return f"pmod(s.{half} {'-' if inverse else '+'} {hashed}, {radix})"

    rounds = f"sequence({ROUNDS - 1}, 0)" if inverse else f"sequence(0, {ROUNDS - 1})"
    return (
        f"aggregate({rounds}, named_struct('a', {left}, 'b', {right}), (s, r) -> "
        f"if(r % 2 = 0, named_struct('a', {moved('a', 'b', left_radix)}, 'b', s.b), "
        f"named_struct('a', s.a, 'b', {moved('b', 'a', right_radix)})))")


def _let(value: str, name: str, body: str) -> str:
    """SQL of `body` with `name` standing for a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def permuted_digits(digits: str, tweak: str, inverse: bool = False) -> str:
    """SQL of the permutation of a string of 2 to 36 digits among those of its length, or of its inverse."""
    left, right = f"length({digits}) div 2", f"(length({digits}) - length({digits}) div 2)"
    network = feistel(
        f"cast(left({digits}, {left}) as bigint)", f"cast(substr({digits}, {left} + 1) as bigint)",
        f"cast(rpad('1', {left} + 1, '0') as bigint)", f"cast(rpad('1', {right} + 1, '0') as bigint)",
        f"concat({tweak}, length({digits}))", inverse)
    return _let(network, "f", f"concat(lpad(string(f.a), {left}, '0'), lpad(string(f.b), {right}, '0'))")


def digits_of(text: str) -> str:
    return f"regexp_replace({text}, '[^0-9]', '')"


def with_digits(shape: str, digits: str) -> str:
    """SQL of `shape` with its digits replaced, one after another, by `digits`."""
    return (
        f"array_join(transform(sequence(1, length({shape})), i -> if(substr({shape}, i, 1) between '0' and '9', "
        f"substr({digits}, length({digits_of(f'left({shape}, i)')}), 1), substr({shape}, i, 1))), '')")


def luhn_sum(digits: str) -> str:
    """SQL of the Luhn sum of a digit string whose last digit is the check digit."""
    place = f"int(substr({digits}, length({digits}) + 1 - k, 1))"
    return (f"aggregate(sequence(1, length({digits})), 0, (t, k) -> t + if(k % 2 = 1, {place}, "
            f"if({place} > 4, 2 * {place} - 9, 2 * {place})))")


def _card(m: str, key: str, inverse: bool = False) -> str:
    """Cards keep their grouping and get a right check digit."""
    payload = permuted_digits("left(d, length(d) - 1)", f"concat({key}, 'card')", inverse)
    checked = _let(payload, "p", f"concat(p, string((10 - {luhn_sum("concat(p, '0')")} % 10) % 10))")
    return _let(digits_of(m), "d", _let(checked, "n", with_digits(m, "n")))


def _date_layouts() -> list[tuple[str, str]]:
    return [(r"^\d{4}-", "yyyy-MM-dd"), (r"^\d{4}/", "yyyy/MM/dd"), (r"^\d{2}\.", "dd.MM.yyyy"),
            (r"^\d{2}/", "dd/MM/yyyy"), (r"^\d{2}/", "MM/dd/yyyy")]


def _date(m: str, key: str, inverse: bool = False) -> str:
    """A date becomes a date of 1900 to 2099 in its layout; the first layout that fits."""
    a, b = DATE_RADICES
    branches = []
    for begins, layout in _date_layouts():
        day = f"datediff(to_date(try_to_timestamp({m}, '{layout}')), {FIRST_DAY})"
        network = feistel(f"cast(n div {b} as bigint)", f"cast(n % {b} as bigint)", str(a), str(b),
                          f"concat({key}, 'date')", inverse)
        moved = _let(network, "f", f"date_format(date_add({FIRST_DAY}, int(f.a * {b} + f.b)), '{layout}')")
        branches.append(
            f"when {m} rlike {_sql(begins)} and {day} between 0 and {a * b - 1} then {_let(day, 'n', moved)}")
    return f"case {' '.join(branches)} else {m} end"


def _address(m: str, key: str, inverse: bool = False) -> str:
    """An IPv4 address becomes another one."""
    parts = f"transform(split({m}, '[.]'), x -> cast(x as bigint))"
    network = feistel("p[0] * 256 + p[1]", "p[2] * 256 + p[3]", "65536", "65536", f"concat({key}, 'ip')", inverse)
    moved = _let(network, "f", "concat_ws('.', f.a div 256, f.a % 256, f.b div 256, f.b % 256)")
    return _let(parts, "p", f"if(exists(p, x -> x > 255), {m}, {moved})")


def _phone(m: str, key: str, inverse: bool = False) -> str:
    """All digits but a country code's are permuted; signs stay where they are."""
    code = f"regexp_extract({m}, '^[+][0-9]{{1,3}}(?=[ .(-])', 0)"
    rest = f"substr({m}, length({code}) + 1)"
    number = _let(digits_of("w"), "d", _let(
        permuted_digits("d", f"concat({key}, 'phone', {code})", inverse), "n", with_digits("w", "n")))
    return f"concat({code}, {_let(rest, 'w', number)})"


def _mail(m: str, key: str) -> str:
    """A stand-in of one form; what is no address, as its domain ends in no name, stays."""
    return (f"if({m} rlike '[.][A-Za-z]{{2}}[^@]*$', "
            f"concat('u', left(sha2(concat({key}, 'mail', lower({m})), 256), 20), '@example.com'), {m})")


def pseudonym(m: str, key: str, inverse: bool = False) -> str:
    """SQL of the pseudonym of a match; the match itself if it holds as nothing.

    The inverse gives back the number, date or address of a pseudonym. Stand-ins of mail
    addresses and secrets are hashes, which have none; they stay as they are.
    """
    mail = m if inverse else _mail(m, key)
    secret = m if inverse else f"left(sha2(concat({key}, 'secret', {m}), 256), length({m}))"
    return (
        f"case when {m} like '%@%' then {mail} "
        f"when {m} rlike {_sql('^(?:[0-9]{1,3}[.]){3}[0-9]{1,3}$')} then {_address(m, key, inverse)} "
        f"when {m} rlike {_sql('^(?:[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}|[0-9]{2}[/.][0-9]{2}[/.][0-9]{4})$')} "
        f"then {_date(m, key, inverse)} "
        f"when {m} rlike '[a-f]' then {secret} "
        f"when {m} rlike {_sql('^[0-9](?:[ -]?[0-9]){12,18}$')} then "
        f"if({luhn_sum(digits_of(m))} % 10 = 0, {_card(m, key, inverse)}, {m}) "
        f"else {_phone(m, key, inverse)} end")


def derived_key(key: str) -> str:
    """The key of the expressions: a hash, so that the caller's key stays out of plans and logs.

    What it hides is the caller's key alone. Whoever reads a plan or an event log of the job
    can invert its numbers and dates, so these are kept as the data are.
    """
    return hashlib.sha256(f"pseudonyms:{key}".encode()).hexdigest()


def pseudonymised(docs: DataFrame, key: str, inverse: bool = False) -> DataFrame:
    """`docs` with personal data in `text` replaced; adds n_found and n_replaced.

    Mail addresses; IPv4 addresses with numbers up to 255; dates of 1900 to 2099; card
    numbers of 13 to 19 digits with a right check digit; phone and social security numbers
    by their grouping; hexadecimal secrets of 32 to 64 digits. A match that doesn't hold
    (a wrong check digit, February 30) stays. A null or empty text stays as it is, with no
    matches; other columns and repeated rows are kept. Where `docs` has a column of the name
    n_found or n_replaced, the new one gets an underscore before it.

    Each row is changed where it lies: no join, shuffle or Python. The key is the caller's.
    With `inverse` the pseudonyms of numbers, dates and addresses become their originals again
    (text that reads as a pseudonym by chance is changed too, and a date that two layouts
    fit goes by the first).
    """
    literal = _sql(derived_key(key))
    hits, parts, moved = (fresh(docs, c) for c in ("_hits", "_parts", "_moved"))
    found, replaced = fresh(docs, "n_found"), fresh(docs, "n_replaced")
    pattern = _sql(PATTERN)
    # Every kind of match has a digit or an @.
    return (
        docs.withColumn(hits, F.expr(
            f"coalesce(if(text rlike '[0-9@]', regexp_extract_all(text, {pattern}, 0), null), array())"))
        .withColumn(moved, F.expr(f"transform(`{hits}`, m -> {pseudonym('m', literal, inverse)})"))
        .withColumn(parts, F.expr(f"if(size(`{hits}`) = 0, array(), split(text, {pattern}, -1))"))
        .withColumn("text", F.expr(
            f"if(size(`{hits}`) = 0, text, array_join(zip_with(`{parts}`, "
            f"concat(`{moved}`, array('')), (p, m) -> concat(p, m)), ''))"))
        .withColumn(found, F.size(hits))
        .withColumn(replaced, F.expr(f"size(filter(zip_with(`{hits}`, `{moved}`, (h, m) -> h <> m), x -> x))"))
        .select(*docs.columns, found, replaced))
