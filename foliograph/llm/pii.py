"""Operator 3: format-preserving pseudonyms for personal data, by Feistel permutations in Spark expressions.

Numbers and dates that look like personal data are validated (Luhn sum, mod-97 sum, octets, calendar, number ranges) and
replaced by a keyed permutation of the values of the same format: card numbers stay valid card numbers, dates stay dates,
every layout stays as it was. Equal values get equal pseudonyms in all documents, different values of a kind get different
ones. The local part of an e-mail address becomes a keyed token and its domain a reserved one.

A text is cut at the matches of one pattern; its pieces and its replaced matches are joined again. Only expressions of Spark
are used, and texts without a digit or an "@" pass unread.

Defined results: a null text stays null, an empty one empty; texts of any length are read whole; overlapping candidates go
to the one that starts first; candidates that fail validation stay as they are; repeated rows are rewritten each; an empty
table gives an empty result; columns other than the text keep their values, and columns of any name may be there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# No digit, letter or joining mark before or after a number.
START, END = r"(?<![0-9A-Za-z_+])", r"(?![0-9A-Za-z_])"
# The length of an account number by country, so that a grouped one ends before the next word.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def grouped(length: int, countries: str) -> str:
    """Account numbers of some countries in groups of four."""
    rest = f" [A-Z0-9]{{{length % 4}}}" if length % 4 else ""
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: [A-Z0-9]{{4}}){{{length // 4 - 1}}}{rest}"


KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+",
    "iban": START + r"(?=[A-Z]{2}[0-9]{2})(?:[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|" + "|".join(grouped(n, c) for n, c in IBAN_LENGTHS.items())
            + r"|[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)" + END,
    "phone": r"(?<![0-9A-Za-z_+])(?:\+1[ .-]?)?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}" + END
             + "|" + START + r"(?:\+1[ .-])?[0-9]{3}([.-])[0-9]{3}\1[0-9]{4}" + END,
    "international": r"(?<![0-9A-Za-z_+])\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{2,4}){2,5}" + END,
    "address": r"(?<![0-9A-Za-z_.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z_]|\.[0-9])",
    "date": START + r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})" + END,
    "social": START + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + END,
    "card": START + r"(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})" + END,
}
ROUNDS = 8


def pattern() -> str:
    """All kinds as one pattern; the back reference of the phone kind keeps its number as the first group."""
    first = ["phone", *[k for k in KINDS if k != "phone"]]
    return "|".join(KINDS[k] for k in first)


def keyed(key: str, *parts: Column) -> Column:
    """60 bits of a keyed hash."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), *parts, F.lit(key)).cast("binary"), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def permuted(key: str, tweak: str, a: Column, m: Column | int, b: Column, n: Column | int) -> Column:
    """The pair (a, b) of numbers below m and n, permuted by a keyed Feistel network."""
    m, n = (F.lit(x).cast("long") if isinstance(x, int) else x.cast("long") for x in (m, n))
    pair = lambda x, y: F.struct(x.cast("long").alias("a"), y.cast("long").alias("b"))

    def turn(s: Column, i: Column) -> Column:
        size = F.when(i % 2 == 1, m).otherwise(n)
        return pair(s["b"], F.pmod(s["a"] + keyed(key, F.lit(tweak), i.cast("string"), s["b"].cast("string")), size))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), pair(a, b), turn)


def until(ok: Callable[[Column], Column], step: Callable[[Column], Column], value: Column) -> Column:
    """Walks along the permutation's cycle to the next value that is ok, so that ok values are permuted among themselves."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(64)), step(value), lambda x, _: F.when(ok(x), x).otherwise(step(x)))


def digits_of(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def permuted_digits(key: str, tweak: str, digits: Column) -> Column:
    """A string of at most 36 digits, permuted among those of its length."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    left, right = F.substring(digits, F.lit(1), u), F.substring(digits, u + 1, n - u)
    size = lambda k: F.rpad(F.lit("1"), k + 1, "0").cast("long")
    number = lambda x: F.coalesce(x.try_cast("long"), F.lit(0).cast("long"))
    p = permuted(key, f"{tweak}", number(left), size(u), number(right), size(n - u))
    whole = F.transform(F.array(p), lambda s: F.concat(F.lpad(s["a"].cast("string"), u, "0"), F.lpad(s["b"].cast("string"), n - u, "0")))[0]
    return F.when(n > 1, whole).otherwise(digits)


def laid_out(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced by ``digits`` one by one."""
    state = lambda out, at: F.struct(out.alias("out"), at.cast("int").alias("at"))
    put = lambda s, c: F.when(
        c.rlike("^[0-9]$"), state(F.concat(s["out"], F.substring(digits, s["at"], F.lit(1))), s["at"] + 1)
    ).otherwise(state(F.concat(s["out"], c), s["at"]))
    return F.aggregate(F.split(value, ""), state(F.lit(""), F.lit(1)), put)["out"]


def luhn_sum(digits: Column, doubled_last: bool) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((i % 2 == 1) == F.lit(doubled_last), twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10


def card(key: str, value: Column) -> Column:
    """The first digit stays, the payload is permuted, the check digit follows."""
    def changed(d: Column) -> Column:
        payload = F.concat(F.substring(d, 1, 1), permuted_digits(key, "card", F.substring(d, F.lit(2), F.length(d) - 2)))
        return F.transform(F.array(payload), lambda p: F.concat(p, F.pmod(10 - luhn_sum(p, True), F.lit(10)).cast("string")))[0]

    digits = digits_of(value)
    new = F.transform(F.array(digits), lambda d: F.when((luhn_sum(d, False) == 0) & d.rlike("[1-9]"), changed(d)))[0]
    return F.transform(F.array(new), lambda d: F.when(d.isNull(), value).otherwise(laid_out(value, d)))[0]


def mod97(x: Column) -> Column:
    """Remainder of a string of digits and capital letters, letters counting as 10 to 35."""
    def add(r: Column, c: Column) -> Column:
        v = F.when(c.rlike("^[0-9]$"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return F.when(v > 9, r * 100 + v).otherwise(r * 10 + v) % 97

    return F.aggregate(F.split(x, ""), F.lit(0), add)


def iban(key: str, value: Column) -> Column:
    """Country and letters stay, the account's digits are permuted, the check digits follow."""
    plain = F.regexp_replace(value, " ", "")

    def changed(x: Column) -> Column:
        account = F.substring(x, F.lit(5), F.length(x) - 4)
        new = laid_out(account, permuted_digits(key, "iban", digits_of(account)))
        return F.transform(F.array(new), lambda a: F.concat(
            F.lpad((98 - mod97(F.concat(a, F.substring(x, 1, 2), F.lit("00")))).cast("string"), 2, "0"), digits_of(a)))[0]

    moved = lambda x: F.concat(F.substring(x, F.lit(5), F.length(x) - 4), F.substring(x, 1, 4))
    new = F.transform(F.array(plain), lambda x: F.when(mod97(moved(x)) == 1, changed(x)))[0]
    return F.transform(F.array(new), lambda d: F.when(d.isNull(), value).otherwise(laid_out(value, d)))[0]


def phone(key: str, value: Column) -> Column:
    """The last ten digits: area codes from 200 among themselves, the others too."""
    def changed(d: Column) -> Column:
        last = F.substring(d, F.length(d) - 9, F.lit(10))
        area, rest = F.substring(last, 1, 3).cast("long"), F.substring(last, 4, 7).cast("long")
        low = F.when(area < 200, 0).otherwise(200)
        p = permuted(key, "phone", area - low, F.when(area < 200, 200).otherwise(800), rest, 10_000_000)
        return F.transform(F.array(p), lambda s: F.concat(
            F.substring(d, F.lit(1), F.length(d) - 10), F.lpad((s["a"] + low).cast("string"), 3, "0"), F.lpad(s["b"].cast("string"), 7, "0")))[0]

    return F.transform(F.array(digits_of(value)), lambda d: laid_out(value, changed(d)))[0]


def international(key: str, value: Column) -> Column:
    """The digits after the first two."""
    d = digits_of(value)
    new = F.concat(F.substring(d, 1, 2), permuted_digits(key, "international", F.substring(d, F.lit(3), F.length(d) - 2)))
    return F.transform(F.array(new), lambda x: laid_out(value, x))[0]


def address(key: str, value: Column) -> Column:
    part = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))

    def changed(o: Column) -> Column:
        p = permuted(key, "address", o[0] * 256 + o[1], 65536, o[2] * 256 + o[3], 65536)
        octets = lambda x: F.concat_ws(".", F.floor(x / 256).cast("string"), (x % 256).cast("string"))
        return F.transform(F.array(p), lambda s: F.concat_ws(".", octets(s["a"]), octets(s["b"])))[0]

    return F.transform(F.array(part), lambda o: F.when(F.forall(o, lambda x: x < 256), changed(o)).otherwise(value))[0]


def date(key: str, value: Column) -> Column:
    """Days from 1900-01-01 to 2079-06-05 among themselves, in each of the layouts; month first only if day first fails."""
    origin = F.lit("1900-01-01").cast("date")

    def day(v: Column, layout: str) -> Column:
        return F.datediff(F.try_to_timestamp(v, F.lit(layout)).cast("date"), origin).cast("long")

    def step(x: Column) -> Column:
        p = permuted(key, "date", F.floor(x / 256), 256, x % 256, 256)
        return F.transform(F.array(p), lambda s: s["a"] * 256 + s["b"])[0]

    def written(x: Column, layout: str) -> Column:
        return F.date_format(F.date_add(origin, x.cast("int")), layout)

    late = lambda x: F.dayofmonth(F.date_add(origin, x.cast("int"))) > 12
    usual, month_first = None, F.lit(None).cast("string")
    for shape, layout in ((r"^[0-9]{4}-", "yyyy-MM-dd"), (r"\.", "dd.MM.yyyy"), ("/", "dd/MM/yyyy")):
        new = F.transform(F.array(day(value, layout)), lambda x: F.when((x >= 0) & (x < 65536), written(step(x), layout)))[0]  # noqa: B023
        usual = F.when(value.rlike(shape), new) if usual is None else usual.when(value.rlike(shape), new)
    us = F.transform(F.array(day(value, "MM/dd/yyyy")), lambda x: F.when((x >= 0) & (x < 65536) & late(x), written(until(late, step, x), "MM/dd/yyyy")))[0]
    month_first = F.when(value.rlike("/"), us)
    return F.coalesce(usual, month_first, value)


def social(key: str, value: Column) -> Column:
    valid = lambda d: ~d.rlike("^(000|666|9)") & (F.substring(d, 4, 2) != "00") & (F.substring(d, 6, 4) != "0000")
    new = F.transform(F.array(digits_of(value)), lambda d: F.when(valid(d), until(valid, lambda x: permuted_digits(key, "social", x), d)))[0]
    return F.transform(F.array(new), lambda d: F.when(d.isNull(), value).otherwise(laid_out(value, d)))[0]


def email(key: str, value: Column) -> Column:
    token = F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(value), F.lit(key)).cast("binary"), 256), 1, 16)
    return F.concat(F.lit("user-"), token, F.lit("@example.invalid"))


CHANGES = {"email": email, "iban": iban, "phone": phone, "international": international, "address": address, "date": date,
           "social": social, "card": card}


def replaced(key: str, value: Column) -> Column:
    """The pseudonym of one match, by the first kind whose pattern is the whole of it."""
    out = None
    for kind in ("email", "iban", "phone", "international", "address", "date", "social", "card"):
        # looking around needs the neighbours, which a match alone lacks; at its ends nothing stands
        hit, new = value.rlike(f"^(?:{KINDS[kind]})$"), CHANGES[kind](key, value)
        out = F.when(hit, new) if out is None else out.when(hit, new)
    return out.otherwise(value)


def rewrite(text: Column, key: str) -> Column:
    """(text, found): the text with its matches replaced, and the matches that changed."""
    p = F.lit(pattern())
    matches = F.regexp_extract_all(text, p, F.lit(0))
    gaps = F.split(text, p, -1)
    pairs = F.transform(matches, lambda m: F.struct(m.alias("old"), replaced(key, m).alias("new")))

    def joined(x: Column) -> Column:
        rest = F.zip_with(x["pairs"], F.slice(x["gaps"], F.lit(2), F.size(x["pairs"])),
                          lambda a, g: F.concat(a["new"], g))
        return F.concat(x["gaps"][0], F.array_join(rest, ""))

    held = F.struct(pairs.alias("pairs"), gaps.alias("gaps"))
    return F.transform(F.array(held), lambda x: F.struct(
        joined(x).alias("text"), F.filter(x["pairs"], lambda a: a["old"] != a["new"]).alias("found")))[0]


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", found_col: str | None = None) -> DataFrame:
    """``docs`` with the text rewritten; ``found_col`` adds the number of replaced values."""
    text = F.col(text_col)
    changed = F.when(text.rlike("[0-9@]"), rewrite(text, key))
    result = "rewritten"
    while result in docs.columns:
        result += "_"
    out = docs.withColumn(result, changed).withColumn(text_col, F.coalesce(F.col(result)["text"], text))
    if found_col:
        out = out.withColumn(found_col, F.coalesce(F.size(F.col(result)["found"]), F.lit(0)).cast("long"))
    return out.drop(result)
