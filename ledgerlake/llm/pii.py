"""Format-preserving pseudonyms of personal data, in DataFrame functions only.

Values are found by pattern and validated. A keyed Feistel network permutes each within its own format: a card
number becomes another with a right check digit, a date another date, an address another address. The
permutation depends on nothing but the key, the kind and the value's symbols, so equal values stay linked
across documents and separators do not matter for phone and card numbers. Different values never meet.

A network works on a list of symbols with their radices. The halves take turns: to each symbol of one, a
number drawn from the keyed digest of the other is added modulo its radix.

| Kind | Valid if | What is permuted |
| --- | --- | --- |
| email | pattern | letters and digits up to the last dot, within their class |
| secret | access-key pattern, or a value of any length, dots inside included, after password, token, secret or api key | letters and digits of the value, within their class |
| ip | four numbers up to 255 | the four numbers, each among those of as many digits |
| iban | mod-97 check | the account part; check digits are worked out anew |
| date | a day of 1900 to 2099, as Y-M-D, D.M.Y or M/D/Y | the day number |
| ssn | no reserved area, group or serial | area, group and serial |
| phone | 8 to 15 digits | digits after the country code |
| card | 13 to 19 digits with a right check digit | all digits but the first and the check digit, which is worked out anew |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ("email", "secret", "ip", "iban", "date", "ssn", "phone", "card")

_EMAIL = r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
_ACCESS_KEY = r"(?<![A-Za-z0-9])A[KS]IA[0-9A-Z]{16}(?![A-Za-z0-9])"
_SURE_LABEL = r"(?i:passw(?:or)?d|passwort|kennwort|pwd|mot de passe|contraseña|contrasena)"
_LABEL = r"(?i:passw(?:or)?d|passwort|kennwort|pwd|mot de passe|contraseña|contrasena|clave|secret|token|api[_-]?key)\s{0,3}[:=]\s{0,3}"
_END = r"[.,;:!?)\]}>\"']*+(?=\s|$)"  # what may stand between a secret and the blank behind it
#: In quotes, all up to the closing one; a quote with another label behind it is none that was closed.
_QUOTED_SECRET = _LABEL + rf"(?:\"(?:(?!{_LABEL})[^\"\n]){{4,}}+\"|'(?:(?!{_LABEL})[^'\n]){{4,}}+')"
#: Else the whole run up to white space, six symbols or more, without the punctuation at its end; an address is left to its own kind. Behind a colon and a blank, which
#: prose has as well, other labels than a password's need a symbol that is no letter, or a capital inside.
_OPEN_SECRET = (
    _LABEL + f"(?!{_EMAIL})" + rf"(?:(?<={_SURE_LABEL}\s{{0,3}}[:=]\s{{0,3}})|(?<=[=]\s{{0,3}})|(?<=:)|(?=[A-Za-z]*+[^A-Za-z\s.,;:!?)\]}}>\"'])|(?=[A-Za-z]*?[a-z][A-Z]))"
    + rf"(?!{_END})[\"']?(?=\S{{6}})(?:(?!{_END})\S)++"
)
_SECRET = f"{_QUOTED_SECRET}|{_OPEN_SECRET}"
_IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
#: Countries by the length of their account numbers.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_of(length: int, countries: str, symbol: str) -> str:
    groups, rest = divmod(length - 4, 4)
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[{symbol}]{{4}}){{{groups}}}" + (f" ?[{symbol}]{{{rest}}}" if rest else "")


def _iban_pattern(lower: bool) -> str:
    """A country's own length, so that no word behind is taken in; any length otherwise. All letters are of one case."""
    symbol, letter = ("a-z0-9", "a-z") if lower else ("A-Z0-9", "A-Z")
    known = "|".join(_iban_of(n, c.lower() if lower else c, symbol) for n, c in _IBAN_LENGTHS.items())
    any_length = f"[{letter}]{{2}}[0-9]{{2}}(?: ?[{symbol}]{{4}}){{2,7}}(?: ?[{symbol}]{{1,3}})?"
    return rf"(?<![A-Za-z0-9])(?=[{letter}]{{2}}[0-9]{{2}})(?:{known}|{any_length})(?![A-Za-z0-9])"


_IBAN = f"{_iban_pattern(False)}|{_iban_pattern(True)}"
_DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/-])"
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_PHONE = (
    r"(?<![A-Za-z0-9+])(?:(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
    r"|\+(?:[0-9][ .()-]{0,2}){7,14}[0-9])(?![0-9])"
)
_CARD = r"(?<![0-9.])(?:[0-9]{13,19}|(?:[0-9]{4}[ -]){3}[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
_BY_KIND = {"email": _EMAIL, "secret": f"{_ACCESS_KEY}|{_SECRET}", "ip": _IP, "iban": _IBAN, "date": _DATE, "ssn": _SSN, "phone": _PHONE, "card": _CARD}
#: In an order in which a longer reading comes first.
_ANY = "|".join((_EMAIL, _ACCESS_KEY, _SECRET, _IP, _IBAN, _DATE, _SSN, _CARD, _PHONE))
_HINT = r"[0-9@]|(?i:passw|pwd|secret|token|api|kennwort|mot de passe|contrase|clave)"
_DAYS = (319, 229)  # 319 * 229 days from 1900-01-01 to 2099-12-31


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def permute(values: Column, radices: Column, key: str, kind: str) -> Column:
    """Keyed permutation of a list of numbers, each below its radix; the radices stay in place."""
    half = F.floor(F.size(values) / 2).cast("int")
    rest = F.size(values) - half

    def turn(state: Column, k: Column) -> Column:
        even = k % 2 == 0
        moved, still = F.when(even, state["a"]).otherwise(state["b"]), F.when(even, state["b"]).otherwise(state["a"])
        base = F.when(even, state["ra"]).otherwise(state["rb"])
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), k.cast("string"), F.array_join(still.cast("array<string>"), ",")).cast("binary"), 512)

        def added(d: Column) -> Column:
            draw = lambda i: F.conv(F.substr(d, (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("long")
            return F.transform(F.arrays_zip(moved.alias("v"), base.alias("r")), lambda x, i: ((x["v"] + draw(i)) % x["r"]).cast("int"))

        new = _let(digest, added)
        return F.struct(
            F.when(even, new).otherwise(state["a"]).alias("a"), F.when(even, state["b"]).otherwise(new).alias("b"),
            state["ra"].alias("ra"), state["rb"].alias("rb"),
        )

    start = F.struct(
        F.slice(values, F.lit(1), half).alias("a"), F.slice(values, half + 1, rest).alias("b"),
        F.slice(radices, F.lit(1), half).alias("ra"), F.slice(radices, half + 1, rest).alias("rb"),
    )
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: F.concat(s["a"], s["b"]))


def _ints(*xs: Column) -> Column:
    return F.array(*[x.cast("int") for x in xs])


def _chars(s: Column) -> Column:
    return F.regexp_extract_all(s, F.lit("(?s)."), F.lit(0))


def _by_class(s: Column, key: str, kind: str) -> Column:
    """Letters and digits change within their class; other characters stay."""
    symbols = F.transform(_chars(s), lambda c: F.struct(
        F.when(c.rlike("[0-9]"), 48).when(c.rlike("[a-z]"), 97).when(c.rlike("[A-Z]"), 65).otherwise(F.ascii(c)).alias("base"),
        F.when(c.rlike("[0-9]"), 10).when(c.rlike("[A-Za-z]"), 26).otherwise(1).alias("radix"),
        F.ascii(c).alias("code"), c.alias("symbol"),
    ))

    def build(x: Column) -> Column:
        values = F.transform(x, lambda y: y["code"] - y["base"])
        new = permute(values, F.transform(x, lambda y: y["radix"]), key, kind)
        return F.array_join(F.zip_with(new, x, lambda v, y: F.when(y["radix"] == 1, y["symbol"]).otherwise(F.char(v + y["base"]))), "")

    return _let(symbols, build)


def _after(label: str, m: Column, body) -> Column:
    """``m`` with what follows ``label`` replaced."""
    return _let(F.regexp_extract(m, f"^(?:{label})", 0), lambda head: F.concat(head, body(F.substr(m, F.length(head) + 1, F.length(m)))))


def _digits(m: Column) -> Column:
    return F.transform(_chars(F.regexp_replace(m, "[^0-9]", "")), lambda c: c.cast("int"))


def _refill(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced in turn."""
    def put(new: Column) -> Column:
        return F.array_join(F.transform(_chars(m), lambda c, i: F.when(
            c.rlike("[0-9]"), F.element_at(new, F.length(F.regexp_replace(F.substr(m, F.lit(1), i + 1), "[^0-9]", ""))).cast("string")
        ).otherwise(c)), "")

    return _let(digits, put)


def _tens(values: Column) -> Column:
    return F.transform(values, lambda _: F.lit(10))


def _luhn(digits: Column) -> Column:
    """Sum of a number without its check digit: every second digit from the right, the last included, doubled."""
    n = F.size(digits)
    parts = F.transform(digits, lambda d, i: F.when((n - i) % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d))
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x)


def _head(xs: Column) -> Column:
    return F.slice(xs, F.lit(1), F.size(xs) - 1)


def _card_valid(m: Column) -> Column:
    return _let(_digits(m), lambda d: (_luhn(_head(d)) + F.element_at(d, -1)) % 10 == 0)


def _card(m: Column, key: str) -> Column:
    def build(d: Column) -> Column:
        middle = F.slice(d, F.lit(2), F.size(d) - 2)
        new = F.concat(F.slice(d, 1, 1), permute(middle, _tens(middle), key, "card"))
        return _let(new, lambda x: F.concat(x, _ints((10 - _luhn(x) % 10) % 10)))

    return _refill(m, _let(_digits(m), build))


def _country(m: Column) -> Column:
    """Digits of the country code, if there is one."""
    return F.length(F.regexp_extract(m, r"^\+(1(?=[0-9]{10}$)|[0-9]{1,3}(?=[^0-9])|[0-9]{2})", 1))


def _phone(m: Column, key: str) -> Column:
    def build(d: Column) -> Column:
        return _let(_country(m), lambda n: F.concat(
            F.slice(d, F.lit(1), n), _let(F.slice(d, n + 1, F.size(d) - n), lambda own: permute(own, _tens(own), key, "phone"))
        ))

    return _refill(m, _let(_digits(m), build))


def _parts(m: Column) -> Column:
    return F.transform(F.split(m, "[./-]"), lambda x: x.cast("int"))


def _ip(m: Column, key: str) -> Column:
    """Each number stays among those of as many digits."""
    def build(p: Column) -> Column:
        bases = F.transform(p, lambda x: F.when(x < 10, 0).when(x < 100, 10).otherwise(100))
        radices = F.transform(p, lambda x: F.when(x < 10, 10).when(x < 100, 90).otherwise(156))
        new = permute(F.zip_with(p, bases, lambda x, b: x - b), radices, key, "ip")
        texts = F.zip_with(F.zip_with(new, bases, lambda x, b: x + b), F.split(m, r"\."), lambda x, old: F.lpad(x.cast("string"), F.length(old), F.lit("0")))
        return F.array_join(texts, ".")

    return _let(_parts(m), build)


def _ssn(m: Column, key: str) -> Column:
    def build(p: Column) -> Column:
        area = F.when(p[0] < 666, p[0] - 1).otherwise(p[0] - 2)  # 898 areas
        new = permute(_ints(area, p[1] - 1, p[2] - 1), _ints(F.lit(898), F.lit(99), F.lit(9999)), key, "ssn")
        return _let(new, lambda x: F.format_string("%03d-%02d-%04d", F.when(x[0] < 665, x[0] + 1).otherwise(x[0] + 2), x[1] + 1, x[2] + 1))

    return _let(_parts(m), build)


def _day(m: Column) -> Column:
    """Days since 1900-01-01, or null for no date of the range."""
    raw = F.when(m.contains("-"), m).when(
        m.contains("."), F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2))
    ).otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 1, 2), F.substring(m, 4, 2)))
    day = F.datediff(F.try_to_date(raw, "yyyy-MM-dd"), F.lit("1900-01-01").cast("date"))
    return F.when((day >= 0) & (day < _DAYS[0] * _DAYS[1]), day)


def _date(m: Column, key: str) -> Column:
    def build(day: Column) -> Column:
        new = permute(_ints(F.floor(day / _DAYS[1]), day % _DAYS[1]), _ints(*map(F.lit, _DAYS)), key, "date")
        made = _let(new, lambda x: F.date_add(F.lit("1900-01-01").cast("date"), x[0] * _DAYS[1] + x[1]))
        return _let(made, lambda d: F.when(m.contains("-"), F.date_format(d, "yyyy-MM-dd")).when(m.contains("."), F.date_format(d, "dd.MM.yyyy")).otherwise(F.date_format(d, "MM/dd/yyyy")))

    return _let(_day(m), build)


def _mod97(s: Column) -> Column:
    """An account number's text, modulo 97; letters of either case count as 10 to 35."""
    return F.aggregate(_chars(F.upper(s)), F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _iban_valid(m: Column) -> Column:
    return _let(F.replace(m, F.lit(" "), F.lit("")), lambda s: (F.length(s) >= 15) & (_mod97(F.concat(F.substr(s, F.lit(5), F.length(s)), F.substr(s, F.lit(1), F.lit(4)))) == 1))


def _iban(m: Column, key: str) -> Column:
    def build(s: Column) -> Column:
        country = F.upper(F.substr(s, F.lit(1), F.lit(2)))
        account = _by_class(F.upper(F.substr(s, F.lit(5), F.length(s))), key, "iban")
        return _let(account, lambda a: F.concat(country, F.lpad((98 - _mod97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0"), a))

    def put(new: Column) -> Column:  # blanks go where they were
        return F.array_join(F.transform(_chars(m), lambda c, i: F.when(c == " ", c).otherwise(
            F.substr(new, F.length(F.replace(F.substr(m, F.lit(1), i + 1), F.lit(" "), F.lit(""))), F.lit(1))
        )), "")

    return _let(_let(_let(F.replace(m, F.lit(" "), F.lit("")), build), lambda new: F.when(m.rlike("[a-z]"), F.lower(new)).otherwise(new)), put)


def kind_of(m: Column) -> Column:
    """Kind of a found value; null if it is not valid."""
    full = {k: m.rlike(f"^(?:{p})$") for k, p in _BY_KIND.items()}
    n = F.length(F.regexp_replace(m, "[^0-9]", ""))
    p = _parts(m)
    return (
        F.when(full["email"], "email")
        .when(full["secret"], "secret")
        .when(full["ip"], F.when(F.array_max(p) < 256, "ip"))
        .when(full["iban"] & _iban_valid(m), "iban")
        .when(full["date"], F.when(_day(m).isNotNull(), "date"))
        .when(full["ssn"] & (p[0] > 0) & (p[0] < 900) & (p[0] != 666) & (p[1] > 0) & (p[2] > 0), "ssn")
        .when(full["card"] & _card_valid(m), "card")
        .when(full["phone"] & (n >= 8) & (n <= 15), "phone")
    )


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    """Pseudonym of a value of a known kind."""
    email = _let(F.regexp_extract(m, r"\.[A-Za-z]+$", 0), lambda top: F.concat(
        _by_class(F.substr(m, F.lit(1), F.length(m) - F.length(top)), key, "email"), top
    ))
    return (
        F.when(kind == "email", email)
        .when(kind == "secret", _after(f"A[KS]IA(?=[0-9A-Z]{{16}}$)|{_LABEL}[\"']?", m, lambda s: _by_class(s, key, "secret")))
        .when(kind == "ip", _ip(m, key))
        .when(kind == "iban", _iban(m, key))
        .when(kind == "date", _date(m, key))
        .when(kind == "ssn", _ssn(m, key))
        .when(kind == "phone", _phone(m, key))
        .when(kind == "card", _card(m, key))
        .otherwise(m)
    )


def _rewritten(text: Column, key: str) -> Column:
    """Struct of the new text and the kinds found in it."""
    found = F.transform(F.regexp_extract_all(text, F.lit(_ANY), F.lit(0)), lambda m: F.struct(m.alias("m"), kind_of(m).alias("kind")))

    def build(hits: Column) -> Column:
        new = F.concat(F.transform(hits, lambda h: pseudonym(h["m"], h["kind"], key)), F.array(F.lit("")))
        joined = F.array_join(F.zip_with(F.split(text, _ANY, -1), new, lambda gap, x: F.concat(gap, x)), "")
        return F.struct(joined.alias("text"), F.filter(F.transform(hits, lambda h: h["kind"]), lambda k: k.isNotNull()).alias("kinds"))

    return _let(found, build)


def pseudonymise(docs: DataFrame, key: str, column: str = "text", kinds: str | None = "pii_kinds") -> DataFrame:
    """``docs`` with the personal data of ``column`` replaced, and in the column ``kinds``, if named, the kinds found in their order.

    Every value keeps its length. Null texts stay null and empty ones empty, with no kinds. Whole texts are
    read; a text without a digit, ``@`` or secret's label is passed on as it is. Repeated rows give repeated rows, an empty table none. All other
    columns stay as they are, whatever their names; a column that is called like ``kinds`` gives way to it. Nothing is shuffled.
    """
    text = F.col(column)
    none = F.array().cast("array<string>")
    new = F.when(text.rlike(_HINT), _rewritten(text, key)).otherwise(F.struct(text.alias("text"), none.alias("kinds")))
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), new.alias("new"))
    kept = [F.col("new.text").alias(c) if c == column else F.col("row").getField(c).alias(c) for c in docs.columns if c != kinds]
    return carried.select(*kept, *([F.col("new.kinds").alias(kinds)] if kinds else []))
