"""Personal data replaced by format-preserving pseudonyms.

Validated numbers and dates are permuted within their format by a keyed Feistel network over a x b values, where a times b is exactly the
number of values of the format: no value is lost, equal values get equal pseudonyms in every document, and the key takes them back. Cards keep
their length and layout and get a fitting check digit (Luhn); dates stay valid dates of the same 400 years, the same day in any layout giving the same day;
phone numbers keep country code and layout; addresses of four bytes and social security numbers stay valid. Mail addresses, which have no
finite format, get a keyed digest as name and keep their domain. What fails its validation stays as it is.

Defined results: a null text stays null and has no findings; an empty text stays empty; matches are leftmost and do not overlap; positions are code points of
the original, ends exclusive; repeated rows are treated one by one; texts are read whole; other columns stay. DataFrame functions only, one pass, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabspark.llm.common import scanned

#: What each kind looks like. A host name has at most 127 labels, which bounds the pattern's stack, too.
BYTE = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
SHAPES = {
    "mail": r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,126}\.[A-Za-z]{2,}",
    "address": rf"(?:{BYTE}\.){{3}}{BYTE}(?![0-9]|\.[0-9])",
    "date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9])|[0-9]{4}/[0-9]{2}/[0-9]{2}(?![0-9])|[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9])|[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9])",
    "ssn": r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "card": r"[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])|[0-9]{13,19}(?![0-9])",
}
KINDS = list(SHAPES)
#: A value does not begin inside of a word or number.
BEFORE = r"(?<![A-Za-z0-9._%+@-])"
#: The groups of the Gregorian calendar repeat after 400 years of 146097 days, 189 x 773; these begin 1700-01-01.
FIRST_DAY, DAYS = "1700-01-01", (189, 773)
STEPS = 10


def _pattern() -> str:
    # the one back-reference of the cards is the only group
    return BEFORE + "(?:" + "|".join(f"(?:{s})" for s in SHAPES.values()) + ")"


def _round(key: str, kind: str, step: Column, half: Column) -> Column:
    """A keyed number below 2^60 for one half."""
    digest = F.sha2(F.concat_ws(":", F.lit(key), F.lit(kind), step.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def permuted(value: Column, a: Column, b: Column, key: str, kind: str) -> Column:
    """A keyed permutation of 0 .. a * b - 1: steps add a keyed number of one half to the other."""
    def step(s: Column, i: Column) -> Column:
        left = F.struct(F.pmod(s["l"] + F.pmod(_round(key, kind, i, s["r"]), a), a).alias("l"), s["r"].alias("r"))
        right = F.struct(s["l"].alias("l"), F.pmod(s["r"] + F.pmod(_round(key, kind, i, s["l"]), b), b).alias("r"))
        return F.when(i % 2 == 1, left).otherwise(right)

    whole = value.cast("bigint")
    start = F.struct(_quotient(whole, b).alias("l"), F.pmod(whole, b).alias("r"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step)
    return end["l"] * b + end["r"]


def restored(value: Column, a: Column, b: Column, key: str, kind: str) -> Column:
    """The value that `permuted` takes to this one."""
    def step(s: Column, i: Column) -> Column:
        left = F.struct(F.pmod(s["l"] - F.pmod(_round(key, kind, i, s["r"]), a), a).alias("l"), s["r"].alias("r"))
        right = F.struct(s["l"].alias("l"), F.pmod(s["r"] - F.pmod(_round(key, kind, i, s["l"]), b), b).alias("r"))
        return F.when(i % 2 == 1, left).otherwise(right)

    whole = value.cast("bigint")
    end = F.aggregate(F.sequence(F.lit(STEPS), F.lit(1)), F.struct(_quotient(whole, b).alias("l"), F.pmod(whole, b).alias("r")), step)
    return end["l"] * b + end["r"]


def _quotient(value: Column, by: Column) -> Column:
    return F.call_function("div", value, by)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _laid_out(shape: Column, new: Column) -> Column:
    """The digits `new` at the places of the digits of `shape`."""
    def at(i: Column) -> Column:
        c = F.substring(shape, i, F.lit(1))
        before = F.length(digits(F.substring(shape, F.lit(1), i - 1)))
        return F.when(c.between("0", "9"), F.substring(new, before + 1, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), at), "")


def _luhn(number: Column) -> Column:
    """Sum of the digits, every second from the right but one doubled; a valid number's is a multiple of 10."""
    n = F.length(number)

    def add(sum_: Column, i: Column) -> Column:
        d = F.substring(number, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return sum_ + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _power(n: Column) -> Column:
    return F.get(F.array(*[F.lit(10 ** k).cast("bigint") for k in range(11)]), n)


def _card(m: Column, key: str) -> Column:
    number = digits(m)
    size = F.length(number) - 1
    low = F.ceil(size / 2).cast("int")
    new = F.lpad(permuted(F.substring(number, F.lit(1), size).cast("bigint"), _power(size - low), _power(low), key, "card").cast("string"), size, F.lit("0"))
    check = F.pmod(-_luhn(F.concat(new, F.lit("0"))), F.lit(10)).cast("string")
    return F.when(_luhn(number) % 10 == 0, _laid_out(m, F.concat(new, check))).otherwise(m)


def _phone(m: Column, key: str) -> Column:
    number = digits(m)
    half = F.lit(100_000).cast("bigint")
    new = F.lpad(permuted(F.substring(number, -10, 10).cast("bigint"), half, half, key, "phone").cast("string"), 10, "0")
    return _laid_out(m, F.concat(F.substring(number, F.lit(1), F.length(number) - 10), new))


def _address(m: Column, key: str) -> Column:
    parts = F.split(m, r"\.")
    number = F.aggregate(parts, F.lit(0).cast("bigint"), lambda n, p: n * 256 + p.cast("bigint"))
    half = F.lit(65536).cast("bigint")
    new = permuted(number, half, half, key, "address")
    return F.concat_ws(".", *[F.pmod(F.shiftright(new, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)])


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, p, n).cast("bigint") for p, n in ((1, 3), (5, 2), (8, 4)))
    place = area - F.when(area > 666, 2).otherwise(1)
    new = permuted((place * 99 + group - 1) * 9999 + serial - 1, F.lit(898 * 99).cast("bigint"), F.lit(9999).cast("bigint"), key, "ssn")
    upper = _quotient(new, F.lit(9999))
    first = _quotient(upper, F.lit(99)) + 1
    first = first + F.when(first >= 666, 1).otherwise(0)
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.concat_ws("-", pad(first, 3), pad(F.pmod(upper, F.lit(99)) + 1, 2), pad(F.pmod(new, F.lit(9999)) + 1, 4))


def _date(m: Column, key: str) -> Column:
    dots, last, slashes = F.substring(m, 3, 1) == ".", F.substring(m, 3, 1) == "/", F.substring(m, 5, 1) == "/"
    day = F.coalesce(F.try_to_date(m, "yyyy-MM-dd"), F.try_to_date(m, "yyyy/MM/dd"), F.try_to_date(m, "dd.MM.yyyy"), F.try_to_date(m, "MM/dd/yyyy"))
    place = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    a, b = (F.lit(x).cast("bigint") for x in DAYS)
    new = F.date_add(F.lit(FIRST_DAY).cast("date"), permuted(place, a, b, key, "date").cast("int"))
    form = lambda f: F.date_format(new, f)
    out = F.when(dots, form("dd.MM.yyyy")).when(last, form("MM/dd/yyyy")).when(slashes, form("yyyy/MM/dd")).otherwise(form("yyyy-MM-dd"))
    return F.when(place.between(0, DAYS[0] * DAYS[1] - 1), out).otherwise(m)


def _mail(m: Column, key: str) -> Column:
    digest = F.sha2(F.concat_ws(":", F.lit(key), F.lit("mail"), F.lower(m)), 256)
    return F.concat(F.lit("m"), F.substring(digest, 1, 12), F.lit("@"), F.substring_index(m, "@", -1))


WAYS = {"mail": _mail, "address": _address, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def pseudonymised(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The rows with `text` rewritten and `pii`, an array of (kind, start, end, pseudonym) for every value that was replaced."""
    source = F.coalesce(F.col("source"), F.lit(""))
    pattern = _pattern()

    def treat(m: Column) -> Column:
        kind, new = F.lit(None).cast("string"), m
        for name in reversed(KINDS):
            here = m.rlike(f"^(?:{SHAPES[name]})$")
            kind, new = F.when(here, F.lit(name)).otherwise(kind), F.when(here, WAYS[name](m, key)).otherwise(new)
        return F.struct(kind.alias("kind"), m.alias("old"), new.alias("new"))

    some = source.rlike(r"[0-9@]")
    found = F.when(some, F.transform(F.regexp_extract_all(source, F.lit(pattern), F.lit(0)), treat)).otherwise(F.array().cast("array<struct<kind:string,old:string,new:string>>"))
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("source")).withColumn("found", found).withColumn("between", F.when(F.size("found") > 0, F.split(source, pattern, -1)))

    def step(at: Column, pair: Column) -> tuple[Column, Column]:
        start = at + F.length(pair["gap"])
        end = start + F.length(pair["f"]["old"])
        span = F.struct(pair["f"]["kind"].alias("kind"), start.alias("start"), end.alias("end"), pair["f"]["new"].alias("pseudonym"), (pair["f"]["old"] != pair["f"]["new"]).alias("changed"))
        return end, span

    pairs = F.transform("found", lambda f, i: F.struct(F.get("between", i).alias("gap"), f.alias("f")))
    spans = scanned(pairs, F.lit(0), step, "struct<kind:string,start:int,end:int,pseudonym:string,changed:boolean>")
    kept = F.transform(F.filter(spans, lambda s: s["changed"]), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["pseudonym"].alias("pseudonym")))
    joined = F.array_join(F.flatten(F.transform("between", lambda gap, i: F.array(gap, F.coalesce(F.get("found", i)["new"], F.lit(""))))), "")
    none = F.array().cast("array<struct<kind:string,start:int,end:int,pseudonym:string>>")
    any_ = F.size("found") > 0
    new = F.when(any_, joined).otherwise(F.col("source"))
    kept_columns = [c for c in docs.columns if c != "pii"]
    return rows.select(*[(new if c == text else F.col("row")[c]).alias(c) for c in kept_columns], F.when(any_, kept).otherwise(none).alias("pii"))


def op2_pii(spark: SparkSession, docs: DataFrame, key: str = "a key for tests only") -> DataFrame:
    done = pseudonymised(docs.select("doc_id", "text"), key)
    count = [F.size(F.filter("pii", _is(k))).cast("bigint").alias(f"n_{k}") for k in KINDS]
    spans = F.array_join(F.transform("pii", lambda p: F.concat_ws(":", p["kind"], p["start"].cast("string"), p["end"].cast("string"))), ",").alias("spans")
    return done.select("doc_id", "text", *count, spans)


def _is(kind: str):
    return lambda p: p["kind"] == kind
