"""Format-preserving pseudonyms of personal data by keyed Feistel permutations.

Numbers and dates that stand the check of their kind are permuted among the
values of the same format: payment cards (Luhn), IBANs (modulo 97), social
security numbers (assigned ranges), IPv4 addresses, dates of 1700 to 2099,
phone numbers with a country code (7 to 15 digits).  Check digits are made
anew, so pseudonyms stand the same checks.  Local parts of mail addresses and
hexadecimal secrets behind a word that names them move letter by letter and
digit by digit.  One key gives one permutation per kind: equal values get
equal pseudonyms in all documents, different ones different.

Cards and IBANs are tried from every place of a text: a card is the longest run
of digits from there, cut between groups alone, that stands its check; an IBAN
has its country's length, else the longest that stands its check.  So an expiry
date, a currency or a number beside them hides none.  Of two that overlap, the
left one is taken, but a card in the usual groups, a date or a social security
number before a card in odd groups.

Texts without a find pass unchanged, as do finds that fail their check.  A null
text stays null.  The text's column is replaced where it stands; all other
columns, whatever their names, and repeated rows stay.  Only column expressions
are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.common import document_columns, query, table
from turnstile.llm.feistel import on_pairs, on_signs

ROUNDS = 8
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: 400 years have 146,097 days, which is 189 * 773.
FIRST_DAY, DAYS = "1700-01-01", (189, 773)
#: Social security numbers: 898 areas, times 99 groups and 9,999 serial numbers.
SSN = (898, 99 * 9999)

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_MAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@(?:[\p{L}\p{N}-]{1,63}+\.){1,8}[A-Za-z]{2,24}(?![\p{L}\p{N}])"
_DIGIT = "[ .()-]{0,2}[0-9]"  # written out below, as a look back takes no repeated group of several lengths
#: A phone number's head, and one of its further groups; its end looks back that it has 7 to 15 digits.
_PHONE = r"(?<![\p{L}\p{N}+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?", r"[0-9]{2,4}){2,4}(?<=\+" + _DIGIT * 7 + f"(?:{_DIGIT}" * 8 + ")?" * 8 + ")(?![0-9])"
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/-])"
_IP = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
_SECRET = r"(?<![\p{L}])(?i:token|secret|password|key)[ ]{0,2}[=:][ ]{0,2}[\"']?(?:[0-9a-f]{16,128}|[0-9A-F]{16,128})(?![0-9A-Za-z])"
#: What can be a card or an IBAN from a place on, the sign behind it with it: looked at from every place.
_CARD_HERE = r"(?<![0-9])(?=([0-9](?:[ -]?[0-9]){12,18}[0-9]?))"
_IBAN_HERE = r"(?<![\p{L}\p{N}])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?[\p{L}\p{N}]?))"
#: Cards as they are printed; such a one, a social security number or a date is not cut by a card of other grouping.
_PRINTED = r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})$"
#: Length of the IBANs of a country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_OTHERS = "|".join((_SSN, _DATE, _IP))
#: Finds beside cards and IBANs, which have to stand their check first.
FIND = "|".join((_MAIL, "".join(_PHONE), _OTHERS, _SECRET))
#: Every kind has one of these signs: texts without any are not searched further.
SIGNS = "[0-9@=:]"


def _mix(key: str, kind: str):
    """Sixty bits of SHA-256 over key, kind, round and what else decides the shift."""

    def number(*parts: Column) -> Column:
        text = F.concat_ws("|", F.lit(key), F.lit(kind), *[p.cast("string") for p in parts])
        return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")

    return number


def _signs(value: Column, alphabets: tuple[str, ...], key: str, kind: str) -> Column:
    number = _mix(key, kind)
    return on_signs(value, alphabets, ROUNDS, lambda other, i, r: number(r, i, other))


def _pairs(x: Column, a: int, b: int, key: str, kind: str) -> Column:
    number = _mix(key, kind)
    return on_pairs(x, a, b, ROUNDS, lambda other, r: number(r, other))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_digit(payload: Column) -> Column:
    """The check digit that belongs behind the digits."""
    n = F.char_length(payload)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(payload, i, F.lit(1)).cast("int") * (F.pmod(n - i, F.lit(2)) * -1 + 2)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.pmod(10 - F.pmod(F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add), F.lit(10)), F.lit(10))


def iban_rest(text: Column) -> Column:
    """Remainder modulo 97 of a text of digits and capitals, letters read as 10 to 35."""

    def add(rest: Column, i: Column) -> Column:
        v = F.instr(F.lit(DIGITS + UPPER), F.substring(text, i, F.lit(1))) - 1
        return F.pmod(rest * F.when(v > 9, 100).otherwise(10) + v, F.lit(97))

    return F.aggregate(F.sequence(F.lit(1), F.char_length(text)), F.lit(0), add)


def _filled(mask: Column, signs: Column, kept: str) -> Column:
    """The mask with its signs of class ``kept`` replaced by the given ones in order."""

    def sign(i: Column) -> Column:
        c = F.substring(mask, i, F.lit(1))
        before = F.char_length(F.regexp_replace(F.substring(mask, F.lit(1), i), f"[^{kept}]", ""))
        return F.when(c.rlike(f"[{kept}]"), F.substring(signs, before, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.char_length(mask)), sign), "")


def _held(value: Column, build) -> Column:
    """``build`` applied to one evaluation of a value, however often it is used."""
    return F.element_at(F.transform(F.array(value), build), 1)


def is_card(d: Column) -> Column:
    n = F.char_length(d)
    return luhn_digit(F.substring(d, F.lit(1), n - 1)) == F.substring(d, n, F.lit(1)).cast("int")


def is_iban(d: Column) -> Column:
    return (iban_rest(F.concat(F.substring(d, F.lit(5), F.char_length(d)), F.substring(d, 1, 4))) == 1) & (F.char_length(d) >= 15)


def _cards(text: Column) -> Column:
    """The cards of a text: from every place the longest that ends with a run of digits and stands its check."""

    def longest(here: Column) -> Column:
        runs = F.array(*[F.regexp_extract(here, rf"^[0-9](?:[ -]?[0-9]){{{n - 1}}}(?![0-9])", 0) for n in range(19, 12, -1)])
        return F.get(F.filter(runs, lambda m: F.when(m != "", is_card(digits_of(m))).otherwise(False)), F.lit(0))

    return _distinct(F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(_CARD_HERE), F.lit(1))), longest))


def _ibans(text: Column) -> Column:
    """The IBANs of a text: from every place the one of the country's length, else the longest; of unknown countries any length."""

    def prefix(here: Column, n: int) -> Column:
        rest = f"(?: ?[A-Z0-9]{{{n % 4}}})" if n % 4 else ""
        return F.regexp_extract(here, rf"^[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}{rest}(?![\p{{L}}\p{{N}}])", 0)

    def best(here: Column) -> Column:
        country, own = F.substring(here, 1, 2), F.lit(None).cast("string")
        for n, countries in IBAN_LENGTHS.items():
            own = F.when(country.isin(*countries.split()), prefix(here, n)).otherwise(own)
        every = F.filter(F.array(*[prefix(here, n) for n in range(34, 14, -1)]), lambda m: m != "")
        tried = _held(own, lambda o: F.when(o.isNull(), every).otherwise(F.concat(F.array(o), F.slice(every, 1, 1))))
        return F.get(F.filter(tried, lambda m: F.when(m != "", is_iban(F.regexp_replace(m, " ", ""))).otherwise(False)), F.lit(0))

    return _distinct(F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(_IBAN_HERE), F.lit(1))), best))


def _distinct(found: Column) -> Column:
    """The texts that are not null, each once, longer ones first."""
    by_length = F.array_sort(F.transform(F.filter(found, lambda m: m.isNotNull()), lambda m: F.struct(-F.char_length(m), m.alias("m"))))
    return F.array_distinct(F.transform(by_length, lambda x: x["m"]))


def _pattern(cards: Column, ibans: Column) -> Column:
    """The pattern of a text's finds: cards and IBANs stand in it as they are, so that nothing else takes a part of them."""
    printed = F.filter(cards, lambda m: m.rlike(_PRINTED))
    guard = F.when(F.size(printed) > 0, F.concat(F.lit("(?!(?:"), F.array_join(printed, "|"), F.lit(")(?![0-9]))"))).otherwise("")
    odd = F.concat(F.lit(f"(?!{_SSN}|{_DATE})".replace(r"\.", "[.]")), guard)
    whole = _held(odd, lambda g: F.array_join(F.transform(cards, lambda m: F.when(m.rlike(_PRINTED), m).otherwise(F.regexp_replace(m, F.lit("([ -])"), F.concat(F.lit("$1"), g)))), "|"))
    return F.concat(
        F.lit(f"{_MAIL}|{_PHONE[0]}"), guard, F.lit(_PHONE[1]),
        F.when(F.size(ibans) > 0, F.concat(F.lit(r"|(?<![\p{L}\p{N}])(?:"), F.array_join(ibans, "|"), F.lit(r")(?![\p{L}\p{N}])"))).otherwise(""),
        F.lit(f"|{_OTHERS}"),
        F.when(F.size(cards) > 0, F.concat(F.lit("|(?<![0-9])(?:"), whole, F.lit(")(?![0-9])"))).otherwise(""),
        F.lit(f"|{_SECRET}"),
    )


def card(m: Column, key: str) -> Column:
    def of(d: Column) -> Column:
        n = F.char_length(d)
        payload = F.concat(F.substring(d, 1, 1), _signs(F.substring(d, F.lit(2), n - 2), (DIGITS,), key, "card"))
        new = _held(payload, lambda p: _filled(m, F.concat(p, luhn_digit(p).cast("string")), "0-9"))
        return F.when(is_card(d), new).otherwise(m)

    return _held(digits_of(m), of)


def iban(m: Column, key: str) -> Column:
    def of(d: Column) -> Column:
        country, account = F.substring(d, 1, 2), F.substring(d, F.lit(5), F.char_length(d))

        def new(p: Column) -> Column:
            check = F.lpad((98 - iban_rest(F.concat(p, country, F.lit("00")))).cast("string"), 2, "0")
            return _filled(m, F.concat(country, check, p), "A-Z0-9")

        return F.when(is_iban(d), _held(_signs(account, (DIGITS, UPPER), key, "iban"), new)).otherwise(m)

    return _held(F.regexp_replace(m, "[^A-Z0-9]", ""), of)


def social(m: Column, key: str) -> Column:
    area, group, serial = F.substring(m, 1, 3).cast("int"), F.substring(m, 5, 2).cast("int"), F.substring(m, 8, 4).cast("int")
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    number = (F.when(area > 666, area - 2).otherwise(area - 1).cast("long") * 99 + group - 1) * 9999 + serial - 1

    def new(x: Column) -> Column:
        place = F.floor(x / (99 * 9999)).cast("int")
        parts = F.when(place >= 665, place + 2).otherwise(place + 1), F.pmod(F.floor(x / 9999), F.lit(99)) + 1, F.pmod(x, F.lit(9999)) + 1
        return F.concat_ws("-", *[F.lpad(p.cast("string"), n, "0") for p, n in zip(parts, (3, 2, 4), strict=True)])

    return F.when(valid, _held(_pairs(number, *SSN, key, "ssn"), new)).otherwise(m)


def date(m: Column, key: str) -> Column:
    def of(pattern: str) -> Column:
        day = F.try_to_timestamp(m, F.lit(pattern)).cast("date")
        number = F.date_diff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
        new = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), _pairs(number, *DAYS, key, "date").cast("int")), pattern)
        return F.when((number >= 0) & (number < DAYS[0] * DAYS[1]), new).otherwise(m)

    return F.when(m.contains("-"), of("yyyy-MM-dd")).when(m.contains("/"), of("dd/MM/yyyy")).otherwise(of("dd.MM.yyyy"))


def address(m: Column, key: str) -> Column:
    number = F.aggregate(F.split(m, r"\."), F.lit(0).cast("long"), lambda n, octet: n * 256 + octet.cast("long"))
    octets = lambda x: F.concat_ws(".", *[F.pmod(F.shiftright(x, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)])
    return _held(_pairs(number, 1 << 16, 1 << 16, key, "ipv4"), octets)


def phone(m: Column, key: str) -> Column:
    code = F.regexp_extract(m, r"^\+[0-9]{1,3}?(?=[ .(-])|^\+[0-9]", 0)
    n = F.char_length(digits_of(m))
    return F.when(n.between(7, 15), F.concat(code, _signs(F.substring(m, F.char_length(code) + 1, F.char_length(m)), (DIGITS,), key, "phone"))).otherwise(m)


def mail(m: Column, key: str) -> Column:
    local = F.substring_index(m, "@", 1)
    return F.concat(_signs(local, (DIGITS, LOWER, UPPER), key, "mail"), F.lit("@"), F.substring_index(m, "@", -1))


def secret(m: Column, key: str) -> Column:
    name = F.regexp_extract(m, r"^[^=:]*[=:][ ]{0,2}[\"']?", 0)

    def of(value: Column) -> Column:
        return F.when(value.rlike("[A-F]"), _signs(value, ("0123456789ABCDEF",), key, "secret")).otherwise(_signs(value, ("0123456789abcdef",), key, "secret"))

    return F.concat(name, _held(F.substring(m, F.char_length(name) + 1, F.char_length(m)), of))


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of a find, or the find where it fails its kind's check."""
    return (
        F.when(m.contains("@"), mail(m, key))
        .when(m.startswith("+"), phone(m, key))
        .when(m.rlike(r"^[A-Z]{2}[0-9]{2}[ A-Z0-9]*$"), iban(m, key))
        .when(m.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), social(m, key))
        .when(m.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$|^[0-9]{2}[./][0-9]{2}[./][0-9]{4}$"), date(m, key))
        .when(m.rlike(r"^[0-9]+(?:\.[0-9]+){3}$"), address(m, key))
        .when(m.rlike(r"^[0-9](?:[ -]?[0-9]){12,18}$") & ~m.rlike("^[0-9]{20,}$"), card(m, key))
        .otherwise(secret(m, key))
    )


def pseudonymized(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """The documents with personal data replaced in ``text``; ``count`` names a column for the number of replaced finds."""
    own = F.col(f"`{text}`")
    none = F.array().cast("array<string>")
    found = docs.withColumn("__pii_cards", F.when(own.rlike("[0-9](?:[ -]?[0-9]){12}"), _cards(own)).otherwise(none))
    found = found.withColumn("__pii_ibans", F.when(own.rlike("[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2}"), _ibans(own)).otherwise(none))
    cards, ibans = F.col("__pii_cards"), F.col("__pii_ibans")
    finds = found.withColumn("__pii_pattern", F.when((F.size(cards) > 0) | (F.size(ibans) > 0), _pattern(cards, ibans)).when(own.rlike(SIGNS) & own.rlike(FIND), FIND))
    finds = finds.withColumn("__pii_finds", F.regexp_extract_all(own, F.col("__pii_pattern"), F.lit(0)))
    finds = finds.withColumn("__pii_new", F.transform("__pii_finds", lambda m: pseudonym(m, key)))
    between = F.split(own, F.col("__pii_pattern"), -1)
    joined = F.array_join(F.zip_with(between, F.concat(F.col("__pii_new"), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    out = finds.withColumn(text, F.when(F.col("__pii_finds").isNull(), own).otherwise(joined))
    if count:
        changed = F.filter(F.zip_with("__pii_finds", "__pii_new", lambda a, b: a != b), lambda x: x)
        out = out.withColumn(count, F.when(F.col("__pii_finds").isNull(), 0).otherwise(F.size(changed)))
    return out.drop("__pii_finds", "__pii_new", "__pii_cards", "__pii_ibans", "__pii_pattern")


@query("op1_feistel_pseudonyms")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = document_columns(table(spark, folder, "documents"), "doc_id", "text")
    return pseudonymized(docs, key="key of the deployment", count="n_replaced")
