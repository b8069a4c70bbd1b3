"""Format-preserving pseudonyms for personal data by keyed Feistel networks.

DataFrame functions only. Values that pass their kind's validation are
permuted within their format: the pseudonym of a valid card number, bank
account, social security number, IP address or date is again a valid one, and
a value has the same pseudonym in every document and spelling. As each network
is a permutation, different values stay different.

====================  =========================================================
kind                  validated by; what is permuted
====================  =========================================================
email                 its pattern; the local part, each letter or digit in its class
card                  13 to 19 digits, Luhn; all but the last, which is made anew
iban                  remainder 1 modulo 97; the account part, check digits made anew
ssn                   no void area, group or serial; the number among the valid ones
ip                    four octets up to 255; the 32 bits
phone                 7 to 15 digits; those after the country code
date                  a real day from 1900 to 2099; the day among all of these
====================  =========================================================

A card or an account may stand beside other digits or upper-case words. So at
every place where one may begin, each run of whole groups is validated. Emails,
accounts (at their country's length, if that is valid) and cards in a usual
layout (unbroken, 4-4-4-4, 4-6-5, 4-6-4) are claimed first; the other kinds,
and cards in any other layout (the longest valid one), in the text between
them. ``01/02/2024`` is MM/dd; dd/MM is read where that is no real day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}"
         r"\.[A-Za-z]{2,24}(?![A-Za-z0-9])")
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
DATE = (r"(?<![A-Za-z0-9./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})"
        r"(?![A-Za-z0-9]|[./-]\d)")
SSN = r"(?<![A-Za-z0-9-])\d{3}-\d{2}-\d{4}(?![A-Za-z0-9]|-\d)"
IP = r"(?<![A-Za-z0-9.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![A-Za-z0-9]|\.\d)"
CARD = r"(?<![A-Za-z0-9])\d(?:[ -]?\d){12,18}(?![A-Za-z0-9])"
#: behind a plus 7 to 15 digits, written out as look-behind has no repeated groups
_UP_TO_15 = r"(?<=\+\d" + r"[ .-]?\d" * 6 + r"(?:[ .-]?\d)?" * 8 + ")"
PHONE = (r"(?<![A-Za-z0-9])(?:(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}"
         r"|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}" + _UP_TO_15 + r"|\d{3}[.-]\d{3}[.-]\d{4})(?![A-Za-z0-9])")
#: in this order at each place of the text
KINDS = {"email": EMAIL, "iban": IBAN, "date": DATE, "ssn": SSN, "ip": IP, "card": CARD, "phone": PHONE}
FOUND = "|".join(KINDS.values())
#: claimed in the text between emails, accounts and cards of a usual layout
WEAK = "|".join(KINDS[k] for k in ("date", "ssn", "ip", "phone"))
#: what ``WEAK`` or a card can be found in
WEAK_OR_CARD = f"{WEAK}|{CARD}"
#: the longest run from each place where a card or an account may begin; a plus
#: before digits is kept, as up to 15 digits after it are a phone number
CARD_RUNS = r"(?<![A-Za-z0-9+])(?=(\+?\d(?:[ -]?\d){12,18}(?![A-Za-z0-9])))"
IBAN_RUNS = f"(?=({IBAN}))"
USUAL_CARD = r"^(?:\d+|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{4,5})$"
#: characters of an account number by its country (ISO 13616 registry)
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
ROUNDS = 4
FIRST_DAY = "1900-01-01"
#: the days from 1900-01-01 to 2099-12-31 are 17 * 4297
DAY_PARTS = (17, 4297)
#: valid numbers: 898 areas (001-899 but 666), 99 groups times 9999 serials
SSN_PARTS = (898, 99 * 9999)


def _round(key: str, kind: str, i: Column, half: Column) -> Column:
    """The keyed function of a Feistel round: 60 bits."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _network(key: str, kind: str, a: Column, b: Column, m: Column, n: Column) -> Column:
    """Permutes the pairs (a below m, b below n): a struct of both."""
    def step(acc: Column, i: Column) -> Column:
        left = F.pmod(acc["a"] + F.pmod(_round(key, kind, i * 2, acc["b"]), m), m)
        right = F.pmod(acc["b"] + F.pmod(_round(key, kind, i * 2 + 1, left), n), n)
        return F.struct(left.alias("a"), right.alias("b"))
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _permuted_digits(key: str, kind: str, digits: Column) -> Column:
    """A string of 2 to 18 digits permuted among those of its length."""
    size = F.length(digits)
    u = F.floor(size / 2).cast("int")
    v = size - u
    pair = _network(key, kind, F.substr(digits, F.lit(1), u), F.substr(digits, u + 1, v),
                    F.pow(F.lit(10.0), u).cast("long"), F.pow(F.lit(10.0), v).cast("long"))
    return F.concat(F.lpad(pair["a"].cast("string"), u, "0"), F.lpad(pair["b"].cast("string"), v, "0"))


def _shifted(text: Column, pad: Column) -> Column:
    """Each letter or digit of ``text`` moved within its class by a byte of ``pad``."""
    def move(c: Column, i: Column) -> Column:
        code = F.ascii(c)
        by = F.conv(F.substr(pad, i * 2 + 1, F.lit(2)), 16, 10).cast("int")
        base = F.when(code < 58, 48).when(code < 91, 65).otherwise(97)
        return F.chr(base + F.pmod(code - base + by, F.when(code < 58, 10).otherwise(26)))
    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), move), "")


def _permuted_text(key: str, kind: str, text: Column) -> Column:
    """A string of up to 64 ASCII letters and digits permuted among those with
    the same class at each place."""
    half = F.floor(F.length(text) / 2).cast("int")

    def step(acc: Column, i: Column) -> Column:
        pad = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), acc["b"]), 512)
        return F.struct(acc["b"].alias("a"), _shifted(acc["a"], pad).alias("b"))
    start = F.struct(F.substr(text, F.lit(1), half).alias("a"), F.substr(text, half + 1, F.length(text)).alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(2 * ROUNDS)), start, step, lambda acc: F.concat(acc["a"], acc["b"]))


def _laid_out(form: Column, values: Column, kept: str) -> Column:
    """``values`` put one by one in the places of ``form`` that match ``kept``."""
    chars = F.filter(F.split(form, ""), lambda c: c != "")
    return F.aggregate(
        chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("next")),
        lambda acc, c: F.when(c.rlike(kept), F.struct(
            F.concat(acc["out"], F.substr(values, acc["next"], F.lit(1))).alias("out"), (acc["next"] + 1).alias("next")))
        .otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["next"].alias("next"))),
        lambda acc: acc["out"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn_sum(digits: Column, doubled_first: Column) -> Column:
    """Luhn sum; ``doubled_first``: whether the last digit counts double."""
    parts = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(
        F.transform(parts, lambda c, i: F.when(
            F.pmod(i + doubled_first.cast("int"), F.lit(2)) == 1,
            F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int"))),
        F.lit(0), lambda s, x: s + x)


def _forms(run: Column) -> Column:
    """The run's first group, its first two, and so on up to the whole."""
    return F.transform(F.array(F.split(run, "(?=[ -])")), lambda cut: F.transform(
        F.sequence(F.lit(1), F.size(cut)), lambda k: F.array_join(F.slice(cut, 1, k), "")))[0]


def _best(runs: Column, valid, rank) -> Column:
    """Of each run's valid forms the one of the highest rank, then the longest:
    structs of ``rank``, ``size`` and ``form``, the longest forms first."""
    best = F.transform(runs, lambda run: F.array_max(F.transform(F.filter(_forms(run), valid), lambda f: F.struct(
        rank(f).cast("int").alias("rank"), F.length(f).alias("size"), F.ltrim(f, F.lit("+")).alias("form")))))
    return F.reverse(F.array_sort(F.array_distinct(F.filter(best, lambda b: b.isNotNull()))))


def _card_forms(text: Column) -> Column:
    """Per place where a valid card begins its best form; rank 1: of a usual layout."""
    def valid(f: Column) -> Column:
        digits = _digits(f)
        return (F.length(digits).between(13, 19) & (~f.startswith("+") | (F.length(digits) > 15))
                & (F.pmod(_luhn_sum(digits, F.lit(False)), F.lit(10)) == 0))
    return _best(F.regexp_extract_all(text, F.lit(CARD_RUNS), 1), valid, lambda f: F.ltrim(f, F.lit("+")).rlike(USUAL_CARD))


def _iban_forms(text: Column) -> Column:
    """Per place where a valid account number begins its best form; rank 1: of its country's length."""
    def valid(f: Column) -> Column:
        plain = F.regexp_replace(f, " ", "")
        return F.length(plain).between(15, 34) & _iban_valid(plain)

    def exact(f: Column) -> Column:
        known = " ".join(f"{c}{n}" for n, of in IBAN_LENGTHS.items() for c in of.split())
        return F.lit(known).contains(F.concat(F.substring(f, 1, 2), F.length(F.regexp_replace(f, " ", "")).cast("string")))
    return _best(F.regexp_extract_all(text, F.lit(IBAN_RUNS), 1), valid, exact)


def _either(pattern: str, forms: Column) -> Column:
    """A pattern that finds ``pattern`` or, as whole groups, one of ``forms``."""
    return F.when(F.size(forms) == 0, F.lit(pattern)).otherwise(F.concat(
        F.lit(f"{pattern}|(?<![A-Za-z0-9])(?:"), F.array_join(F.transform(forms, lambda f: f["form"]), "|"),
        F.lit(")(?![A-Za-z0-9])")))


def _strong(text: Column) -> Column:
    """The pattern of the emails, accounts and usual cards of ``text``."""
    return _either(EMAIL, F.concat(_iban_forms(text), F.filter(_card_forms(text), lambda f: f["rank"] == 1)))


def _weak(text: Column) -> Column:
    """The pattern of the other kinds, and of all valid cards, of ``text``."""
    return _either(WEAK, _card_forms(text))


def _card(key: str, match: Column) -> Column:
    digits = _digits(match)
    payload = _permuted_digits(key, "card", F.substr(digits, F.lit(1), F.length(digits) - 1))
    # the network's result is used twice, so the check digit is added inside one lambda
    whole = F.transform(F.array(payload), lambda p: F.concat(
        p, F.pmod(10 - F.pmod(_luhn_sum(p, F.lit(True)), F.lit(10)), F.lit(10)).cast("string")))[0]
    return F.when(F.pmod(_luhn_sum(digits, F.lit(False)), F.lit(10)) == 0, _laid_out(match, whole, "[0-9]")).otherwise(match)


def _mod97(text: Column) -> Column:
    """The remainder modulo 97 of a string of digits and letters (A is 10)."""
    return F.aggregate(
        F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0),
        lambda r, c: F.when(F.ascii(c) < 58, F.pmod(r * 10 + F.ascii(c) - 48, F.lit(97)))
        .otherwise(F.pmod(r * 100 + F.ascii(c) - 55, F.lit(97))))


def _iban_valid(plain: Column) -> Column:
    return _mod97(F.concat(F.substr(plain, F.lit(5), F.length(plain)), F.substr(plain, F.lit(1), F.lit(4)))) == 1


def _iban(key: str, match: Column) -> Column:
    plain = F.regexp_replace(match, " ", "")
    country, account = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5), F.length(plain))
    valid = _iban_valid(plain)
    whole = F.transform(F.array(_permuted_text(key, "iban", account)), lambda p: F.concat(
        country, F.lpad((98 - _mod97(F.concat(p, country, F.lit("00")))).cast("string"), 2, "0"), p))[0]
    return F.when(valid, _laid_out(match, whole, "[A-Z0-9]")).otherwise(match)


def _email(key: str, match: Column) -> Column:
    local, domain = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)
    pseudonym = _permuted_text(key, "email", F.regexp_replace(local, "[^A-Za-z0-9]", ""))
    return F.concat(_laid_out(local, pseudonym, "[A-Za-z0-9]"), F.lit("@"), domain)


def _ssn(key: str, match: Column) -> Column:
    area, group, serial = (F.substr(match, F.lit(a), F.lit(n)).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    pair = _network(key, "ssn", F.when(area < 666, area - 1).otherwise(area - 2), (group - 1) * 9999 + serial - 1,
                    F.lit(SSN_PARTS[0]), F.lit(SSN_PARTS[1]))
    written = F.transform(F.array(pair), lambda p: F.concat_ws(
        "-", F.lpad(F.when(p["a"] < 665, p["a"] + 1).otherwise(p["a"] + 2).cast("string"), 3, "0"),
        F.lpad((F.floor(p["b"] / 9999) + 1).cast("string"), 2, "0"),
        F.lpad((F.pmod(p["b"], F.lit(9999)) + 1).cast("string"), 4, "0")))[0]
    return F.when(valid, written).otherwise(match)


def _ip(key: str, match: Column) -> Column:
    octets = F.transform(F.split(match, "\\."), lambda o: o.cast("int"))
    pair = _network(key, "ip", octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], F.lit(65536), F.lit(65536))
    written = F.transform(F.array(pair), lambda p: F.concat_ws(
        ".", *(x for half in ("a", "b") for x in (F.floor(p[half] / 256).cast("string"), F.pmod(p[half], F.lit(256)).cast("string")))))[0]
    return F.when(F.forall(octets, lambda o: o < 256), written).otherwise(match)


def _phone(key: str, match: Column) -> Column:
    code = F.regexp_extract(match, r"^\+\d{1,3}(?=[ .(-])", 0)
    rest = F.substr(match, F.length(code) + 1, F.length(match))
    return F.when(F.length(_digits(match)).between(7, 15) & (F.length(_digits(rest)) >= 2), F.concat(
        code, _laid_out(rest, _permuted_digits(key, "phone", _digits(rest)), "[0-9]"))).otherwise(match)


def _date(key: str, match: Column) -> Column:
    form = (F.when(match.rlike(r"^\d{4}-"), "yyyy-MM-dd").when(match.rlike(r"^\d{4}/"), "yyyy/MM/dd")
            .when(match.contains("."), "dd.MM.yyyy")
            .when(F.concat_ws("-", F.substr(match, F.lit(7), F.lit(4)), F.substr(match, F.lit(1), F.lit(2)),
                              F.substr(match, F.lit(4), F.lit(2))).try_cast("date").isNotNull(), "MM/dd/yyyy")
            .otherwise("dd/MM/yyyy"))
    parts = F.split(match, "[./-]")
    year, month, day = (F.when(form.startswith("yyyy"), parts[i]).when(form.startswith("dd"), parts[j]).otherwise(parts[k])
                        for i, j, k in ((0, 2, 2), (1, 1, 0), (2, 0, 1)))
    number = F.datediff(F.concat_ws("-", year, month, day).try_cast("date"), F.lit(FIRST_DAY).cast("date"))
    size = DAY_PARTS[0] * DAY_PARTS[1]
    pair = _network(key, "date", F.floor(number / DAY_PARTS[1]), F.pmod(number, F.lit(DAY_PARTS[1])),
                    F.lit(DAY_PARTS[0]), F.lit(DAY_PARTS[1]))
    written = F.transform(F.array(pair), lambda p: F.date_add(
        F.lit(FIRST_DAY).cast("date"), (p["a"] * DAY_PARTS[1] + p["b"]).cast("int")))[0]
    y, m, d = (F.lpad(f(written).cast("string"), n, "0") for f, n in ((F.year, 4), (F.month, 2), (F.day, 2)))
    shown = (F.when(form == "yyyy-MM-dd", F.concat_ws("-", y, m, d)).when(form == "yyyy/MM/dd", F.concat_ws("/", y, m, d))
             .when(form == "dd.MM.yyyy", F.concat_ws(".", d, m, y))
             .when(form == "dd/MM/yyyy", F.concat_ws("/", d, m, y)).otherwise(F.concat_ws("/", m, d, y)))
    return F.when(number.between(0, size - 1), shown).otherwise(match)


_BY_KIND = {"email": _email, "iban": _iban, "date": _date, "ssn": _ssn, "ip": _ip, "card": _card, "phone": _phone}


def pseudonym(match: Column, key: str) -> Column:
    """The pseudonym of one match of ``FOUND``; the match itself if not valid."""
    out = F.when(F.lit(False), match)
    for kind, make in _BY_KIND.items():
        out = out.when(match.rlike(f"^(?:{KINDS[kind]})$"), make(key, match))
    return out.otherwise(match)


def _as_it_is(text: Column) -> Column:
    return F.struct(text.alias("text"), F.lit(0).alias("n"))


def _written(text: Column, pattern: Column, new, between) -> Column:
    """``text`` with ``new`` of each match of ``pattern`` and ``between`` (a
    struct of text and n) of each gap, and the number of replaced values."""
    # one struct holds the lists, so that each is made once
    split = F.transform(F.array(pattern), lambda p: F.struct(
        F.split(text, p, -1).alias("gaps"), F.regexp_extract_all(text, p, F.lit(0)).alias("old")))
    lists = F.transform(split, lambda s: F.struct(
        F.transform(s["gaps"], between).alias("gaps"), s["old"].alias("old"), F.transform(s["old"], new).alias("new")))
    return F.transform(lists, lambda s: F.struct(
        F.concat(F.array_join(F.zip_with(F.slice(s["gaps"], 1, F.size(s["new"])), s["new"], lambda g, n: F.concat(g["text"], n)), ""),
                 F.element_at(s["gaps"], -1)["text"]).alias("text"),
        (F.size(F.filter(F.zip_with(s["old"], s["new"], lambda o, n: o != n), lambda x: x))
         + F.aggregate(s["gaps"], F.lit(0), lambda n, g: n + g["n"])).alias("n")))[0]


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = "n_replaced") -> DataFrame:
    """``docs`` with the personal data of ``text_col`` replaced by pseudonyms,
    all other columns as they are, and the number of replaced values in
    ``count_col`` (None: no such column).

    A null text stays null (0 replaced), a text without personal data stays as
    it is; values that fail their validation are left alone; whole texts are
    read. Every row is kept, whatever its other columns hold or are called; if
    ``docs`` has a column ``count_col`` already, that column is replaced.
    """
    text = docs[text_col]
    done = F.when(text.rlike("[0-9@]") & text.rlike(FOUND), _written(
        text, _strong(text), lambda m: pseudonym(m, key), lambda gap: F.when(
            gap.rlike(WEAK_OR_CARD), _written(gap, _weak(gap), lambda m: pseudonym(m, key), _as_it_is))
        .otherwise(_as_it_is(gap)))).otherwise(_as_it_is(text))
    held = "__pseudonymised"
    out = docs.withColumn(held, done)
    out = out.withColumn(text_col, F.col(f"{held}.text"))
    if count_col is not None:
        out = out.withColumn(count_col, F.col(f"{held}.n"))
    return out.drop(held)
