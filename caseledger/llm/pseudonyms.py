"""Personal data: format-preserving Feistel pseudonyms (built-in functions only).

Validated numbers and dates are permuted within their own format by a keyed Feistel network,
so equal values get equal pseudonyms in all documents and different values stay different:

* cards: 13 to 19 digits that pass the Luhn check keep their first digit and pass it again;
* telephone numbers: the ten digits after +1 are permuted;
* IPv4 addresses: the 32 bits are permuted;
* social security numbers (ddd-dd-dddd): the nine digits are permuted;
* dates (yyyy-mm-dd, and dd/mm/yyyy or dd.mm.yyyy) of the years 1800 to 2199 become other such days;
* e-mail addresses: the local part becomes a keyed word of letters, the domain stays.

Separators stay. Null and empty texts stay as they are, as do texts without a match. Repeated
rows are treated alike. Rows are not moved, so there is no group to be skewed. The key is a
parameter; without it pseudonyms cannot be turned back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseledger.llm.words import table

# The patterns of each kind, tried in this order at each place.
EMAIL = r"[A-Za-z0-9._%+\-]+@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,}"
PHONE = r"\+1[ .\-]?\(?[0-9]{3}\)?[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}(?![0-9])"
DATE = r"(?<![0-9])(?:[12][0-9]{3}-[01][0-9]-[0-3][0-9]|[0-3][0-9]([/.])[01][0-9]\1[12][0-9]{3})(?![0-9])"
SSN = r"(?<![0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])"
IP = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?!\.?[0-9])"
CARD = (r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){2} [0-9]{1,7}|[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7}"
        r"|[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{4}-[0-9]{6}-[0-9]{5})(?![0-9])")
ANY = "|".join((EMAIL, PHONE, DATE, SSN, IP, CARD))
DEMO_KEY = "replace-me"
DAY_ZERO, DAYS = "1800-01-01", (627, 233)  # 400 years have 627 * 233 days
ROUNDS = 10


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def feistel(value: Column, a: int, b: int, key: str, kind: str) -> Column:
    """A keyed permutation of the integers below a * b, with alternating halves modulo a and b.

    Round functions are 52 bits of SHA-256 over key, kind, round and the other half, which is
    uniform to within b / 2**52.
    """
    def mask(i: Column, half: Column) -> Column:
        text = F.concat(F.lit(f"{key}:{kind}:"), i.cast("string"), F.lit(":"), half.cast("string"))
        return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long")

    start = F.struct(F.floor(value / b).cast("long").alias("l"), F.pmod(value, F.lit(b)).cast("long").alias("r"))
    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda s, i: F.when(
        i % 2 == 1, F.struct(F.pmod(s["l"] + mask(i, s["r"]), F.lit(a)).cast("long").alias("l"), s["r"].alias("r"))).otherwise(
        F.struct(s["l"].alias("l"), F.pmod(s["r"] + mask(i, s["l"]), F.lit(b)).cast("long").alias("r"))))
    return _let(done, lambda s: s["l"] * b + s["r"])


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """Sum of the Luhn check over all digits; a valid number gives a multiple of ten."""
    chars = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))
    return F.aggregate(F.transform(chars, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        (c.cast("int") * 2) - F.when(c.cast("int") > 4, 9).otherwise(0))), F.lit(0), lambda a, x: a + x)


def with_digits(text: Column, digits: Column) -> Column:
    """The text with its digits replaced one by one, separators kept."""
    plain = F.split(text, "")
    places = F.transform(plain, lambda c: F.when(c.rlike("^[0-9]$"), 1).otherwise(0))
    return F.array_join(F.transform(plain, lambda c, i: F.when(
        c.rlike("^[0-9]$"), F.substr(digits, F.aggregate(F.slice(places, 1, i + 1), F.lit(0), lambda a, x: a + x), F.lit(1)))
        .otherwise(c)), "")


def _permuted(digits: Column, n: int, key: str, kind: str) -> Column:
    """Decimal strings of length n."""
    a, b = 10 ** ((n + 1) // 2), 10 ** (n // 2)
    if n > 15:  # the two ends are permuted apart, each with the other's result as tweak
        head, tail = F.substring(digits, 1, n - 8), F.substring(digits, n - 7, 8)
        new = _permuted(head, n - 8, key, f"{kind}/head")
        return _let(new, lambda h: F.concat(h, F.lpad(F.pmod(tail.cast("long") + F.conv(F.substring(F.sha2(
            F.concat(F.lit(f"{key}:{kind}/tail:"), h), 256), 1, 13), 16, 10).cast("long"), F.lit(10 ** 8)).cast("string"), 8, "0")))
    return F.lpad(feistel(digits.cast("long"), a, b, key, kind).cast("string"), n, "0")


def _card(match: Column, key: str) -> Column:
    def of(digits: Column) -> Column:
        out = match
        for n in range(13, 20):
            body = F.concat(F.substring(digits, 1, 1), _permuted(F.substring(digits, 2, n - 2), n - 2, key, f"card{n}"))
            new = _let(body, lambda x: F.concat(x, F.pmod(10 - F.pmod(luhn_sum(F.concat(x, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")))
            out = F.when((F.length(digits) == n) & (luhn_sum(digits) % 10 == 0), with_digits(match, new)).otherwise(out)
        return out
    return _let(digits_of(match), of)


def _date(match: Column, key: str) -> Column:
    def of(form: str) -> Column:
        day = F.try_to_date(match, form)
        number = F.datediff(day, F.lit(DAY_ZERO).cast("date")).cast("long")
        new = F.date_add(F.lit(DAY_ZERO).cast("date"), feistel(number, *DAYS, key, "date").cast("int"))
        return F.when(number.between(0, DAYS[0] * DAYS[1] - 1), F.date_format(new, form)).otherwise(match)
    return (F.when(match.contains("-"), of("yyyy-MM-dd")).when(match.contains("/"), of("dd/MM/yyyy"))
            .otherwise(of("dd.MM.yyyy")))


def _ip(match: Column, key: str) -> Column:
    octets = F.split(match, r"\.")
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda a, x: a * 256 + x.cast("long"))
    return _let(feistel(number, 65536, 65536, key, "ip"), lambda v: F.concat_ws(
        ".", *[F.pmod(F.shiftright(v, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]))


def _email(match: Column, key: str) -> Column:
    token = F.translate(F.substring(F.sha2(F.concat(F.lit(f"{key}:mail:"), F.lower(match)), 256), 1, 16), "0123456789", "ghijklmnop")
    return F.concat(token, F.lit("@"), F.substring_index(match, "@", -1))


def pseudonym(match: Column, key: str) -> Column:
    """The pseudonym of one matched value; a value that does not validate stays."""
    whole = lambda p: match.rlike(f"^(?:{p})$")
    return (F.when(match.contains("@"), _email(match, key))
            .when(whole(PHONE), _let(digits_of(match), lambda d: with_digits(match, F.concat(
                F.lit("1"), _permuted(F.substring(d, 2, 10), 10, key, "phone")))))
            .when(whole(DATE), _date(match, key))
            .when(whole(SSN), with_digits(match, _permuted(digits_of(match), 9, key, "ssn")))
            .when(whole(IP), _ip(match, key)).otherwise(_card(match, key)))


def pseudonymize(docs: DataFrame, key: str, text_col: str = "text", n_chars_col: str | None = None,
                 count_col: str | None = None) -> DataFrame:
    """All columns of ``docs`` with the text's personal data replaced.

    ``n_chars_col`` names a column to be set to the new length; ``count_col`` a new column
    with the number of values that changed.
    """
    text = F.col(text_col).cast("string")
    hit = F.when(text.rlike("[0-9@]"), text.rlike(ANY)).otherwise(F.lit(False))
    rest, found = F.split(text, ANY, -1), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))

    def rebuilt(values: Column) -> Column:
        return F.concat(F.array_join(F.zip_with(F.slice(rest, 1, F.size(values)), values, lambda a, b: F.concat(a, b)), ""),
                        F.element_at(rest, -1))

    changed = F.when(hit, _let(found, lambda f: _let(F.transform(f, lambda m: pseudonym(m, key)), lambda v: F.struct(
        rebuilt(v).alias("text"), F.size(F.filter(F.arrays_zip(f.alias("o"), v.alias("n")), lambda z: z["o"] != z["n"])).alias("n")))))
    name = "__pseudonyms"
    out = docs.withColumn(name, changed)
    out = out.withColumn(text_col, F.coalesce(F.col(f"{name}.text"), F.col(text_col).cast("string")))
    if n_chars_col:
        out = out.withColumn(n_chars_col, F.when(F.col(f"{name}.text").isNotNull(), F.length(text_col).cast("long")).otherwise(F.col(n_chars_col)))
    if count_col:
        out = out.withColumn(count_col, F.coalesce(F.col(f"{name}.n"), F.lit(0)).cast("long"))
    return out.drop(name)


def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return pseudonymize(docs, DEMO_KEY, n_chars_col="n_chars", count_col="n_replaced")
