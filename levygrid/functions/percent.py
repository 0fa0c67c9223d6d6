"""Percents as exact numbers of any length.

A percent is a struct: ``short``, a decimal, for the texts that fit one exactly; ``long``, sign, digits
and exponent, for all others. Arithmetic on ``long`` works on the digits as a string. It stands in
lambdas over arrays of at most one element, so ordinary texts never evaluate it and the
code generated for a row stays small.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from levygrid.functions.text import ws

#: Significant digits that a division by one hundred keeps (halves to even).
PRECISION = 28
#: A text that would need more digits before the point than this is no percent.
MAX_DIGITS = 10_000
_SHORT = r"\A\+?(?:[0-9]{1,10}(?:\.[0-9]{0,18})?|\.[0-9]{1,18})\z"
_NUMBER = r"\A[+-]?(?:[0-9]++\.?[0-9]*+|\.[0-9]++)(?:[eE][+-]?[0-9]{1,9})?\z"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _zeros(count: Column) -> Column:
    return F.repeat(F.lit("0"), count.cast("int"))


def _part(text: Column, start: Column, length: Column) -> Column:
    return F.substring(text, start.cast("int"), length.cast("int"))


def _raised(digits: Column) -> Column:
    """A whole number in digits, plus one."""

    def body(kept: Column) -> Column:
        n = F.length(kept)
        last = (_part(kept, n, F.lit(1)).cast("int") + 1).cast("string")
        front = F.when(n == 0, F.lit("1")).otherwise(F.concat(_part(kept, F.lit(1), n - 1), last))
        return F.concat(front, _zeros(F.length(digits) - n))

    return _let(F.rtrim(digits, F.lit("9")), body)


def _rounded(digits: Column, drop: Column) -> Column:
    """Digits without the last ``drop`` (one at least), halves rounded to even."""

    def body(s: Column) -> Column:
        n = F.length(s["text"])
        kept = n - s["drop"]
        head, following = _part(s["text"], F.lit(1), kept), _part(s["text"], kept + 1, F.lit(1))
        rest = F.rtrim(_part(s["text"], kept + 2, n), F.lit("0")) != ""
        odd = _part(s["text"], kept, F.lit(1)).cast("int") % 2 == 1
        up = (following > "5") | ((following == "5") & (rest | odd))
        return F.when(up, _raised(head)).otherwise(head)

    # More zeros in front than this change nothing.
    drop = F.least(drop, F.length(digits) + 1)
    text = F.lpad(digits, F.greatest(F.length(digits), drop + 1).cast("int"), F.lit("0"))
    return _let(F.struct(text.alias("text"), drop.alias("drop")), body)


def _number(negative: Column, digits: Column, exponent: Column) -> Column:
    """Without zeros at either end; zero has no digits and exponent 0."""

    def body(s: Column) -> Column:
        short = F.rtrim(s["digits"], F.lit("0"))
        moved = s["exponent"] + F.length(s["digits"]) - F.length(short)
        return F.struct(
            s["negative"].alias("negative"), short.alias("digits"),
            F.when(short == "", F.lit(0)).otherwise(moved).cast("int").alias("exponent"),
        )

    return _let(F.struct(
        negative.alias("negative"), F.ltrim(digits, F.lit("0")).alias("digits"), exponent.alias("exponent")
    ), body)


def _hundredth(number: Column) -> Column:
    n = F.length(number["digits"])
    over = n - PRECISION
    digits = F.when(over > 0, _rounded(number["digits"], over)).otherwise(number["digits"])
    exponent = number["exponent"] - 2 + F.greatest(over, F.lit(0))
    return _number(number["negative"], digits, F.when(n == 0, F.lit(0)).otherwise(exponent))


def _long(plain: Column) -> Column:
    """Sign, digits and exponent of a text; null if it is no number."""
    whole = F.regexp_extract(plain, r"\A[+-]?([0-9]*)", 1)
    decimals = F.regexp_extract(plain, r"\.([0-9]*)", 1)
    power = F.regexp_extract(plain, r"[eE]([+-]?[0-9]+)\z", 1)
    exponent = F.coalesce(F.nullif(power, F.lit("")).try_cast("int"), F.lit(0)) - F.length(decimals)
    found = _number(F.startswith(plain, F.lit("-")), F.concat(whole, decimals), exponent)
    return _let(
        F.when(F.rlike(plain, F.lit(_NUMBER)), found),
        lambda n: F.when(F.length(n["digits"]) + n["exponent"] <= MAX_DIGITS, n),
    )


def parse(text: Column) -> Column:
    """The percent a stripped text states: '8.75%' and '0.0875' are equal; null if it states none.

    Underscores are passed over, an exponent may follow. A hundredth has ``PRECISION``
    significant digits, as decimal arithmetic gives it; all else is exact.
    """
    plain = F.replace(text, F.lit("_"), F.lit(""))
    percent = F.contains(text, F.lit("%"))
    plain = F.when(percent, ws(F.replace(plain, F.lit("%"), F.lit("")))).otherwise(plain)
    fits = F.rlike(plain, F.lit(_SHORT))
    # (28,18) times (2,2) keeps every digit.
    hundredth = F.lit("0.01").cast("decimal(2,2)")
    amount = F.when(fits, plain).try_cast("decimal(28,18)")
    short = F.when(percent, (amount * hundredth).cast("decimal(37,20)")).otherwise(amount.cast("decimal(37,20)"))
    others = F.filter(F.array(plain), lambda p: ~F.rlike(p, F.lit(_SHORT)))
    long = F.get(F.transform(others, lambda p: _let(
        _long(p), lambda n: F.when(n.isNotNull() & F.contains(text, F.lit("%")), _hundredth(n)).otherwise(n)
    )), F.lit(0))
    both = F.struct(short.alias("short"), long.alias("long"))
    return F.when(short.isNotNull() | long.isNotNull(), both)


def _as_long(percent: Column) -> Column:
    return F.coalesce(percent["long"], _long(percent["short"].cast("string")))


def equal(a: Column, b: Column) -> Column:
    """Whether two percents are the same number; null if either is missing."""

    def body(p: Column) -> Column:
        x, y = _as_long(p["a"]), _as_long(p["b"])
        same = (x["digits"] == y["digits"]) & (x["exponent"] == y["exponent"])
        return same & ((x["digits"] == "") | (x["negative"] == y["negative"]))

    short = a["short"].isNotNull() & b["short"].isNotNull()
    pair = F.struct(a.alias("a"), b.alias("b"))
    odd = F.filter(F.array(pair), lambda p: p["a"]["long"].isNotNull() | p["b"]["long"].isNotNull())
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("boolean")).otherwise(
        F.when(short, a["short"] == b["short"]).otherwise(F.get(F.transform(odd, body), F.lit(0)))
    )


def formatted(percent: Column, places: int) -> Column:
    """Text with ``places`` decimals, halves rounded to even; the sign stays, also of zero."""

    def pointed(s: Column) -> Column:
        text = F.lpad(s["whole"], F.greatest(F.length(s["whole"]), F.lit(places + 1)), F.lit("0"))
        n = F.length(text)
        sign = F.when(s["negative"], F.lit("-")).otherwise(F.lit(""))
        return F.concat(sign, _part(text, F.lit(1), n - places), F.lit("."), _part(text, n - places + 1, F.lit(places)))

    def body(n: Column) -> Column:
        shift = n["exponent"] + places
        whole = F.when(n["digits"] == "", F.lit("0")).when(
            shift >= 0, F.concat(n["digits"], _zeros(shift))
        ).otherwise(_rounded(n["digits"], -shift))
        return _let(F.struct(whole.alias("whole"), n["negative"].alias("negative")), pointed)

    short = F.bround(percent["short"], places).cast(f"decimal(38,{places})").cast("string")
    rare = F.filter(F.array(percent["long"]), lambda n: n.isNotNull())
    return F.when(percent["short"].isNotNull(), short).otherwise(F.get(F.transform(rare, body), F.lit(0)))
