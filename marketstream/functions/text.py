"""Text helpers: folding, matching, number and price formatting, templates."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim_space(text: Column) -> Column:
    """Strip all Unicode white space at both ends, not only blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def normalise_category(text: Column) -> Column:
    return F.lower(trim_space(text))


def contains_ci(text: Column, needle: str) -> Column:
    """Case-insensitive substring test; a missing text does not match, unless the needle is empty."""
    if needle == "":
        return F.lit(True)
    return F.coalesce(F.contains(F.lower(text), F.lower(F.lit(needle))), F.lit(False))


def any_contains_ci(texts: Column, needle: str) -> Column:
    """The same test over an array; stops at the first hit."""
    return F.coalesce(F.exists(texts, lambda t: contains_ci(t, needle)), F.lit(False))


def whole_number(text: Column, what: str) -> Column:
    """A text of digits with an optional sign as a whole number of 64 bits; any other text is an error that names ``what``.

    Null stays null. Blanks are no digits, and an empty text is an error.
    """
    number = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))
    wrong = F.raise_error(F.concat(F.lit(f"{what} is not a whole number: "), text))
    return F.when(text.isNull(), F.lit(None)).otherwise(F.coalesce(number, wrong)).cast("bigint")


def price_text(price: Column, currency: Column) -> Column:
    return F.format_string("%.2f %s", price, currency)


def plain_number(value: Column) -> Column:
    """Shortest decimal text of a double: ``1500``, ``0.25``, ``1.5e+06`` from a million up."""
    text = value.cast("string")
    plain = F.regexp_replace(text, r"\.0$", "")
    # Between 1e6 and 1e7 Spark still writes plain digits: move the point behind the first one.
    digits = F.regexp_replace(plain, r"[-.]", "")
    mantissa = F.regexp_replace(
        F.concat(F.substring(digits, 1, 1), F.lit("."), F.substring(digits, 2, 40)), r"\.?0*$", "")
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    scientific = F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), r"E(\d)", "E+$1")
    scientific = F.lower(F.regexp_replace(scientific, r"E([+-])(\d)$", "E$10$2"))
    size = F.abs(value)
    return (
        F.when(F.isnan(value), F.lit("NaN"))
        .when(size == float("inf"), F.concat(F.when(value > 0, F.lit("+")).otherwise(F.lit("-")), F.lit("Inf")))
        .when(size < 1e-4, F.when(size == 0, F.lit("0")).otherwise(scientific))
        .when(size < 1e6, F.when(size < 1e-3, F.regexp_replace(value.cast("decimal(38,20)").cast("string"), r"0+$", ""))
              .otherwise(plain))
        .when(size < 1e7, F.concat(sign, mantissa, F.lit("e+06")))
        .otherwise(scientific)
    )


# SI suffixes by power of a thousand.
SI_ABOVE_ONE = ["", "k", "M", "G", "T", "P", "E", "Z", "Y"]
SI_BELOW_ONE = ["m", "u", "n", "p", "f", "a", "z", "y"]


def humanise(value: Column) -> Column:
    """Four significant digits with an SI suffix: ``10.74G``, ``1.5k``, ``250m``."""
    size = F.abs(value)

    def rounded(scaled: Column, decimals: int) -> Column:
        return F.signum(scaled) * F.floor(F.abs(scaled) * 10.0**decimals + 0.5) / 10.0**decimals

    def four_digits(scaled: Column) -> Column:
        width = F.abs(scaled)
        digits = F.when(width >= 100, rounded(scaled, 1)).when(width >= 10, rounded(scaled, 2)).otherwise(rounded(scaled, 3))
        return F.regexp_replace(digits.cast("string"), r"\.0$", "")

    result = F.when(F.isnan(value) | (size == float("inf")) | (value == 0), plain_number(value))
    scaled = value
    for power, suffix in enumerate(SI_ABOVE_ONE):
        reach = size >= 1
        if power < len(SI_ABOVE_ONE) - 1:
            reach = reach & (F.abs(scaled) < 1000)
        result = result.when(reach, F.concat(four_digits(scaled), F.lit(suffix)))
        scaled = scaled / 1000.0
    scaled = value
    for power, suffix in enumerate(SI_BELOW_ONE, start=1):
        scaled = scaled * 1000.0
        reach = F.lit(True) if power == len(SI_BELOW_ONE) else F.abs(scaled) >= 1
        result = result.when(reach, F.concat(four_digits(scaled), F.lit(suffix)))
    return result


_PLACEHOLDER = re.compile(r"\{\{\s*(.*?)\s*\}\}")


def render_template(template: str, label: Callable[[str], Column], plain: Column, human: Column) -> Column:
    """Fill ``{{ $labels.x }}``, ``{{ $value }}`` and ``{{ $value | humanize }}``; a missing label is empty.

    ``plain`` and ``human`` are the value's texts by ``plain_number`` and ``humanise``.
    """
    parts: list[Column] = []
    end = 0
    for match in _PLACEHOLDER.finditer(template):
        if match.start() > end:
            parts.append(F.lit(template[end:match.start()]))
        expression = re.sub(r"\s+", "", match[1])
        if expression.startswith("$labels."):
            parts.append(label(expression.removeprefix("$labels.")))
        elif expression == "$value":
            parts.append(plain)
        elif expression == "$value|humanize":
            parts.append(human)
        else:
            raise ValueError(f"unknown placeholder {match[0]!r}")
        end = match.end()
    parts.append(F.lit(template[end:]))
    return F.concat(*parts)
