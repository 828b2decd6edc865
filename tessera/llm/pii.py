"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Validated numbers, dates and mail names are permuted by keyed Feistel networks over the set of values that their format
allows, so a pseudonym is as valid as what it replaces and equal values, however written, get equal pseudonyms in every
document. The key is a parameter; who holds it can invert the permutation. session_key() reads it from the session's
setting spark.tessera.pseudonym.key.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROUNDS = 8
_EDGE, _END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
PHONE = r"(?<![\p{L}\p{N}+])\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}" + _END
NATIONAL = _EDGE + r"(?:1[ .-])?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[.-])[2-9][0-9]{2}[.-][0-9]{4}" + _END
CARD = _EDGE + r"[2-6](?:[ -]?[0-9]){12,18}" + _END
SSN = _EDGE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _END
IP = r"(?<![\p{L}\p{N}.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\p{L}\p{N}]|\.[0-9])"
ISO_DATE = _EDGE + r"[0-9]{4}-[0-9]{2}-[0-9]{2}" + _END
DAY_DATE = _EDGE + r"[0-9]{2}([/.-])[0-9]{2}\1[0-9]{4}" + _END
KINDS = ("email", "phone", "card", "ssn", "ip", "date")
_SHAPES = {"email": EMAIL, "phone": f"(?:{PHONE})|(?:{NATIONAL})", "ssn": SSN, "date": f"(?:{ISO_DATE})|(?:{DAY_DATE})", "ip": IP, "card": CARD}
ANY = "|".join(f"(?:{s})" for s in (EMAIL, PHONE, NATIONAL, SSN, ISO_DATE, DAY_DATE, IP, CARD))


def _hash(key: str, kind: str, round_: Column, value: Column) -> Column:
    """A keyed number of 56 bits."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), round_.cast("string"), value.cast("string")), 256), 1, 14), 16, 10).cast("long")


def permute(value: Column, a: int, b: int, key: str, kind: str) -> Column:
    """A keyed permutation of 0 .. a * b - 1: halves of sizes a and b take turns in moving by a hash of the other."""

    def turn(s: Column, i: Column) -> Column:
        left = F.pmod(s["l"] + _hash(key, kind, i, s["r"]), F.lit(a).cast("long"))
        right = F.pmod(s["r"] + _hash(key, kind, i, s["l"]), F.lit(b).cast("long"))
        return F.when(i % 2 == 0, F.struct(left.alias("l"), s["r"].alias("r"))).otherwise(F.struct(s["l"].alias("l"), right.alias("r")))

    start = F.struct(F.floor(value / b).cast("long").alias("l"), F.pmod(value, F.lit(b).cast("long")).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: s["l"] * b + s["r"])


def permute_text(value: Column, key: str, kind: str) -> Column:
    """A keyed permutation of strings that keeps each character's class: small letters, capitals, digits; others stay."""

    def moved(half: Column, other: Column, i: Column) -> Column:
        stream = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), other), 256)

        def one(c: Column, at: Column) -> Column:
            n, code = F.conv(F.substr(stream, F.pmod(at, F.lit(16)) * 4 + 1, F.lit(4)), 16, 10).cast("int"), F.ascii(c)
            shift = lambda low, m: F.char(low + F.pmod(code - low + n, F.lit(m)))
            return F.when(c.rlike("^[a-z]$"), shift(97, 26)).when(c.rlike("^[A-Z]$"), shift(65, 26)).when(c.rlike("^[0-9]$"), shift(48, 10)).otherwise(c)

        return F.when(F.length(half) == 0, half).otherwise(F.array_join(F.transform(F.split(half, ""), one), ""))

    def turn(s: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, F.struct(moved(s["l"], s["r"], i).alias("l"), s["r"].alias("r"))).otherwise(F.struct(s["l"].alias("l"), moved(s["r"], s["l"], i).alias("r")))

    cut = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), cut).alias("l"), F.substr(value, cut + 1).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: F.concat(s["l"], s["r"]))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _refill(template: Column, digits: Column) -> Column:
    """template with its digits replaced by digits in order."""
    one = lambda c, i: F.when(c.rlike("^[0-9]$"), F.substr(digits, F.length(_digits(F.substr(template, F.lit(1), i + 1))), F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.split(template, ""), one), "")


def _part(s: Column, at: int, n: int) -> Column:
    return F.try_to_number(F.substring(s, at, n), F.lit("9" * n)).cast("long")


def _pad(n: Column, width: int) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def _luhn(digits: Column) -> Column:
    """Sum of the digits, every second one from the right doubled, modulo 10."""
    one = lambda c, i: F.when(i % 2 == 1, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int"))
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), one), F.lit(0), lambda s, x: s + x) % 10


def _email(s: Column, key: str) -> Column:
    name = F.substring_index(s, "@", 1)
    return F.concat(permute_text(F.lower(name), key, "email"), F.lit("@"), F.substring_index(s, "@", -1))


#: Country codes: 1, 7, those of two digits, and three digits otherwise.
_CODE = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def _phone(s: Column, key: str) -> Column:
    d = _digits(s)
    national = ~s.startswith("+")
    ten = F.when(national | ((F.length(d) == 11) & d.startswith("1")), F.right(d, F.lit(10)))
    area, exchange, line = (_part(ten, *x) for x in ((1, 3), (4, 3), (7, 4)))
    american = F.coalesce((area >= 200) & (exchange >= 200), F.lit(False))
    x = permute(((area - 200) * 800 + (exchange - 200)) * 10000 + line, 640_000, 10_000, key, "phone")
    whole = F.floor(x / 10000).cast("long")
    na = F.concat(_pad(F.floor(whole / 800).cast("long") + 200, 3), _pad(F.pmod(whole, F.lit(800).cast("long")) + 200, 3), _pad(F.pmod(x, F.lit(10000).cast("long")), 4))
    na = F.when(F.length(d) == 11, F.concat(F.lit("1"), na)).otherwise(na)
    # The code is read from the digits, so it does not depend on how a number is written.
    code = F.regexp_extract(d, _CODE, 1)
    other = F.concat(code, permute_text(F.substr(d, F.length(code) + 1), key, "phone"))
    return F.when(american, _refill(s, na)).when(~national & F.length(d).between(8, 15), _refill(s, other)).otherwise(s)


def _card(s: Column, key: str) -> Column:
    d = _digits(s)
    two = d.startswith("2")
    # Of the numbers that begin with 2 those of 16 digits from 2221 to 2720 are cards; these four digits stay.
    known = ~two | ((F.length(d) == 16) & F.substring(d, 1, 4).between("2221", "2720"))
    keep = F.when(two, 4).otherwise(1)
    body = F.concat(F.substr(d, F.lit(1), keep), permute_text(F.substr(d, keep + 1, F.length(d) - keep - 1), key, "card"))
    check = F.pmod(10 - _luhn(F.concat(body, F.lit("0"))), F.lit(10))
    return F.when(known & F.length(d).between(13, 19) & (_luhn(d) == 0), _refill(s, F.concat(body, check.cast("string")))).otherwise(s)


def _ssn(s: Column, key: str) -> Column:
    d = _digits(s)
    area, group, serial = (_part(d, *x) for x in ((1, 3), (4, 2), (6, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    order = area - 1 - F.when(area > 666, 1).otherwise(0)
    x = permute(order * (99 * 9999) + (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "ssn")
    place, rest = F.floor(x / (99 * 9999)).cast("long"), F.pmod(x, F.lit(99 * 9999).cast("long"))
    new = F.concat(_pad(place + 1 + F.when(place >= 665, 1).otherwise(0), 3), _pad(F.floor(rest / 9999).cast("long") + 1, 2), _pad(F.pmod(rest, F.lit(9999).cast("long")) + 1, 4))
    return F.when(valid, _refill(s, new)).otherwise(s)


def _ip(s: Column, key: str) -> Column:
    octets = F.transform(F.split(s, r"\."), lambda o: o.cast("long"))
    valid = F.forall(octets, lambda o: o <= 255)
    x = permute(F.aggregate(octets, F.lit(0).cast("long"), lambda n, o: n * 256 + o), 65536, 65536, key, "ip")
    new = F.concat_ws(".", *[F.shiftright(x, n).bitwiseAND(255).cast("string") for n in (24, 16, 8, 0)])
    return F.when(valid, new).otherwise(s)


def _date(s: Column, key: str) -> Column:
    iso = s.rlike(r"^[0-9]{4}")
    d = _digits(s)
    y, p, q = F.when(iso, F.substring(d, 1, 4)).otherwise(F.substring(d, 5, 4)), F.when(iso, F.substring(d, 5, 2)).otherwise(F.substring(d, 1, 2)), F.when(iso, F.substring(d, 7, 2)).otherwise(F.substring(d, 3, 2))
    made = lambda m, n: F.try_to_date(F.concat_ws("-", y, m, n), "yyyy-MM-dd")
    day_first = F.when(~iso, made(q, p))
    day = F.coalesce(F.when(iso, made(p, q)), day_first, made(p, q))
    first = F.lit("1900-01-01").cast("date")
    n = F.datediff(day, first).cast("long")
    # 1900 to 2099 has 73049 = 17 * 4297 days.
    new = F.date_add(first, permute(n, 17, 4297, key, "date").cast("int"))
    shape = F.when(iso, F.date_format(new, "yyyyMMdd")).when(day_first.isNotNull(), F.date_format(new, "ddMMyyyy")).otherwise(F.date_format(new, "MMddyyyy"))
    return F.when(n.between(0, 73048), _refill(s, shape)).otherwise(s)


_MAKE = {"email": _email, "phone": _phone, "card": _card, "ssn": _ssn, "ip": _ip, "date": _date}


def _replace(found: Column, key: str) -> Column:
    """struct(kind, new) of a match; kind is null where it has the shape but isn't valid."""
    kind, new = F.lit(None).cast("string"), found
    for k in reversed(("email", "phone", "ssn", "date", "ip", "card")):
        is_ = found.rlike(f"^(?:{_SHAPES[k]})$")
        made = _MAKE[k](found, key)
        kind, new = F.when(is_, F.lit(k)).otherwise(kind), F.when(is_, made).otherwise(new)
    return F.struct(F.when(new != found, kind).alias("kind"), new.alias("new"))


def session_key(spark: SparkSession) -> str:
    """The key that the session names in spark.tessera.pseudonym.key; a random one for this session where it names none."""
    name = "spark.tessera.pseudonym.key"
    if not spark.conf.get(name, None):
        spark.conf.set(name, secrets.token_hex(32))
    return spark.conf.get(name)


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text, n_email, n_phone, n_card, n_ssn, n_ip, n_date: one row per row of docs, whatever its other columns.

    Phones are North American numbers with or without +1 (area and exchange stay valid) or + and 8 to 15 digits (the
    country code stays), cards pass Luhn's test and keep their first digit (of 2221 to 2720 the first four), social
    security numbers, IPv4 addresses and dates of 1900 to 2099 are valid ones; mail addresses keep their domain. What has
    a shape but isn't valid stays as it is. Null texts stay null and count nothing; empty and very long texts are treated
    as any other; null and repeated doc_ids pass through, repeated rows are treated alike; no rows give no rows. A value
    that the permutation maps to itself isn't counted.
    """
    base = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    may = F.col("text").rlike("[0-9@]")
    found = base.select("doc_id", "text", F.when(may, F.regexp_extract_all("text", F.lit(ANY), 0)).alias("found"))
    done = found.select("doc_id", "text", F.transform("found", lambda m: _replace(m, key)).alias("done"))
    between = F.split("text", ANY, -1)
    new = F.array_join(F.zip_with(between, F.transform("done", lambda x: x["new"]), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    count = lambda k: F.coalesce(F.size(F.filter("done", lambda x: x["kind"] == k)), F.lit(0)).cast("long")
    some = F.size("done") > 0
    return done.select("doc_id", F.when(some, new).otherwise(F.col("text")).alias("text"), *[F.when(some, count(k)).otherwise(F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS])
