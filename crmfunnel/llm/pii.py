"""Format-preserving pseudonyms for personal numbers, dates and addresses, by built-in functions only.

Method.  A candidate that passes its kind's validation is read as a list of symbols with a
modulus each (digits, letters, octets, a day number) and permuted by an alternating Feistel
network: in each round one half is shifted, symbol by symbol, by a keyed hash of the other
half.  The result is again valid in the same format, and equal values get equal pseudonyms in
every document.  Without the key the permutation can't be undone; with it, the same rounds run
backwards (``revert``).

=========  =============================================  ==============================
kind       validation                                     symbols
=========  =============================================  ==============================
email      local part, domain with a dot                  letters and digits of the local part
ipv4       four octets up to 255                          four octets
date       real day of 1700 to 2099                       day number as 189 x 773
phone      ten digits, area and exchange from 2 to 9      those ten digits
ssn        area, group and serial in range                area, group, serial
card       13 to 19 digits, Luhn sum                      digits between the first and the check digit
=========  =============================================  ==============================

Candidates that fail stay as they are.  Defined results: a null text stays null with counts 0,
an empty one empty; a null id stays a row; repeated rows give repeated rows; only the id and the
text are read, so other columns can have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Candidates by kind.  No quantifier can give back what it took, so time is linear in the text.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "ipv4": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])(?!\.[0-9])",
    "date": r"(?<![0-9/-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[/.][0-9]{2}[/.][0-9]{4})(?![0-9/-])",
    "phone": r"(?<![0-9])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])",
}
ANY = "|".join(KINDS.values())
#: 400 years of the calendar, 146,097 days, are 189 x 773.
_FIRST_DAY, _DAY_MODULI = "1700-01-01", (189, 773)


def _ints(*values) -> Column:
    return F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]).cast("array<int>")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _symbols(text: Column) -> Column:
    """The signs of a text, without the empty rest that splitting leaves."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def _feistel(values: Column, moduli: Column, kind: Column, key: str, back: bool = False) -> Column:
    """Permute ``values`` (each below its modulus): halves take turns, shifted by a hash of the other."""
    def halves(list_):
        half = F.floor(F.size(list_) / 2).cast("int")
        return F.slice(list_, 1, half), F.slice(list_, half + 1, F.size(list_))

    turns = F.array(*[F.lit(i) for i in (reversed(range(ROUNDS)) if back else range(ROUNDS))])

    def shifted(part: Column, mods: Column, other: Column, turn: Column) -> Column:
        def shift(v, j):
            h = F.sha2(F.concat_ws("|", F.lit(key), kind, turn, j, F.concat_ws(",", other.cast("array<string>"))), 256)
            step = F.conv(F.substring(h, 1, 12), 16, 10).cast("long") % F.get(mods, j)
            return F.pmod(v - step if back else v + step, F.get(mods, j)).cast("int")

        return F.transform(part, shift)

    def run(split):
        def turn(acc, i):
            return F.when(i % 2 == 0, F.struct(shifted(acc["l"], split["lm"], acc["r"], i).alias("l"), acc["r"].alias("r"))
                          ).otherwise(F.struct(acc["l"].alias("l"), shifted(acc["r"], split["rm"], acc["l"], i).alias("r")))

        start = F.struct(split["l"].alias("l"), split["r"].alias("r"))
        return F.aggregate(turns, start, turn, lambda acc: F.concat(acc["l"], acc["r"]))

    def of(pair):
        (left, right), (left_mod, right_mod) = halves(pair["v"]), halves(pair["m"])
        return _let(F.struct(left.alias("l"), right.alias("r"), left_mod.alias("lm"), right_mod.alias("rm")), run)

    return _let(F.struct(values.alias("v"), moduli.alias("m")), of)


def _letters(text: Column, kind: Column, key: str, back: bool) -> Column:
    """Letters and digits are permuted within their class, other signs keep their place."""
    def base(c):
        return F.when(c.rlike("[0-9]"), 48).when(c.rlike("[A-Z]"), 65).otherwise(97)

    symbols = _symbols(F.regexp_replace(text, "[^A-Za-z0-9]", ""))
    values = F.transform(symbols, lambda c: (F.ascii(c) - base(c)).cast("int"))
    moduli = F.transform(symbols, lambda c: F.when(c.rlike("[0-9]"), 10).otherwise(26))
    fresh = F.zip_with(symbols, _feistel(values, moduli, kind, key, back), lambda c, v: F.char(v + base(c)))
    return _refill(text, "[A-Za-z0-9]", fresh)


def _refill(template: Column, sign: str, symbols: Column) -> Column:
    """The template with its signs of a class replaced, in order, by the given ones."""
    start = F.struct(F.lit(0).alias("n"), F.lit("").alias("out"))

    def fill(given):
        def step(acc, c):
            hit = c.rlike(sign)
            return F.struct((acc["n"] + F.when(hit, 1).otherwise(0)).alias("n"),
                            F.concat(acc["out"], F.when(hit, F.get(given, acc["n"])).otherwise(c)).alias("out"))

        return F.aggregate(_symbols(template), start, step, lambda acc: acc["out"])

    return _let(symbols, fill)


def _luhn(digits: Column) -> Column:
    """Sum of the digits with every second one from the right, the last not, doubled."""
    def part(c, i):
        d = c.cast("int")
        return F.when(i % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.aggregate(F.transform(F.reverse(_symbols(digits)), part), F.lit(0), lambda a, b: a + b)


def _email(m, key, back):
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    return F.concat(_letters(local, F.lit("email"), key, back), F.lit("@"), domain)


def _ipv4(m, key, back):
    octets = F.split(m, r"\.").cast("array<int>")
    fresh = F.array_join(_feistel(octets, _ints(256, 256, 256, 256), F.lit("ipv4"), key, back).cast("array<string>"), ".")
    return F.when(F.array_max(octets) < 256, fresh)


def _date(m, key, back):
    iso = m.rlike("^[0-9]{4}-")
    text = F.when(iso, m).otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)))
    days = F.datediff(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date"), F.lit(_FIRST_DAY).cast("date"))
    a, b = _DAY_MODULI
    p = _feistel(_ints((days / b).cast("int"), (days % b).cast("int")), _ints(a, b), F.lit("date"), key, back)
    fresh = _let(p, lambda q: F.date_add(F.lit(_FIRST_DAY).cast("date"), F.get(q, 0) * b + F.get(q, 1)))
    sign = F.substring(m, 3, 1)
    other = F.concat(F.date_format(fresh, "dd"), sign, F.date_format(fresh, "MM"), sign, F.date_format(fresh, "yyyy"))
    return F.when(days.between(0, a * b - 1), F.when(iso, F.date_format(fresh, "yyyy-MM-dd")).otherwise(other))


def _phone(m, key, back):
    digits = _digits(m)
    ten = F.substring(digits, -10, 10)
    bases = _ints(2, 0, 0, 2, 0, 0, 0, 0, 0, 0)
    moduli = F.transform(bases, lambda b: F.lit(10) - b)
    values = F.zip_with(_symbols(ten).cast("array<int>"), bases, lambda v, b: v - b)
    fresh = F.zip_with(_feistel(values, moduli, F.lit("phone"), key, back), bases, lambda v, b: (v + b).cast("string"))
    country = F.transform(_symbols(F.substring(digits, 1, 1)), lambda c: c)
    symbols = F.when(F.length(digits) > 10, F.concat(country, fresh)).otherwise(fresh)
    return F.when(ten.rlike("^[2-9]..[2-9]"), _refill(m, "[0-9]", symbols))


def _ssn(m, key, back):
    area, group, serial = (p.cast("int") for p in (F.substring(m, 1, 3), F.substring(m, 5, 2), F.substring(m, 8, 4)))
    values = _ints(F.when(area > 666, area - 2).otherwise(area - 1), group - 1, serial - 1)
    p = _feistel(values, _ints(898, 99, 9999), F.lit("ssn"), key, back)

    def written(q):
        index = F.get(q, 0)
        return F.concat_ws("-", F.lpad(F.when(index >= 665, index + 2).otherwise(index + 1), 3, "0"),
                           F.lpad(F.get(q, 1) + 1, 2, "0"), F.lpad(F.get(q, 2) + 1, 4, "0"))

    fresh = _let(p, written)
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, fresh)


def _card(m, key, back):
    digits = _digits(m)
    inner = _symbols(F.substring(digits, 2, 17))
    inner = F.slice(inner, 1, F.length(digits) - 2).cast("array<int>")
    fresh = _feistel(inner, F.transform(inner, lambda _: F.lit(10)), F.lit("card"), key, back)
    head = F.concat(F.substring(digits, 1, 1), F.array_join(fresh.cast("array<string>"), ""))

    def checked(h):
        check = F.pmod(F.lit(10) - _luhn(F.concat(h, F.lit("0"))) % 10, F.lit(10))
        return _symbols(F.concat(h, check.cast("string")))

    return F.when(_luhn(digits) % 10 == 0, _refill(m, "[0-9]", _let(head, checked)))


_BY_KIND = {"email": _email, "ipv4": _ipv4, "date": _date, "phone": _phone, "ssn": _ssn, "card": _card}


def _kind(m: Column) -> Column:
    """Kind of a candidate; the expressions look at what stands before and after, so whole matches are compared."""
    out = F.when(m.contains("@"), "email")
    for kind in ("ipv4", "date", "phone", "ssn", "card"):
        out = out.when(m.rlike(f"^(?:{KINDS[kind]})$"), kind)
    return out


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """``doc_id, text, n_email, n_ipv4, n_date, n_phone, n_ssn, n_card`` of every row; the text with pseudonyms."""
    text = F.col("text")
    found = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(1)))

    def replaced(m):
        def by_kind(kind):
            fresh = F.when(kind == "email", _email(m, key, back))
            for name, by in list(_BY_KIND.items())[1:]:
                fresh = fresh.when(kind == name, by(m, key, back))
            return _let(fresh, lambda new: F.struct(
                F.when(new.isNotNull(), kind).alias("kind"), F.coalesce(new, m).alias("new")))

        return _let(_kind(m), by_kind)

    rows = (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
            .withColumn("found", found)
            .withColumn("found", F.when(F.size("found") > 0, F.transform("found", replaced))))
    # between n candidates stand n + 1 pieces of text
    pieces = F.split(text, ANY, -1)
    merged = F.concat(F.array_join(F.zip_with(
        F.slice(pieces, 1, F.size("found")), F.col("found.new"), lambda a, b: F.concat(a, b)), ""), F.element_at(pieces, -1))
    return rows.select("doc_id", F.when(F.size("found") > 0, merged).otherwise(text).alias("text"),
                       *[_count(kind).alias(f"n_{kind}") for kind in _BY_KIND])


def _count(kind: str) -> Column:
    own = F.filter("found", lambda x: x["kind"] == kind)
    return F.when(F.col("found").isNull(), 0).otherwise(F.size(own)).cast("long")


def revert(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Undo :func:`pseudonymise` made with the same key."""
    return pseudonymise(docs, key, id_col, text_col, back=True)
