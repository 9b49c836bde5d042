"""Number text and rounding that follow IEEE values exactly, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _scaled_round(value: Column, digits: int) -> Column:
    """round-half-even of the exact binary value times 10**digits, as bigint.

    Where the product looks like a tie, it is split into a high and a low part, which tells the
    true side. That rare step sits in a lambda: Spark does not inline it into the generated code,
    which would otherwise outgrow the size up to which the JVM compiles a method.
    """
    scale = F.lit(float(10**digits))
    prod = value * scale
    whole = F.floor(prod)
    rest = prod - whole

    def tie_goes_up(v: Column) -> Column:
        big = v * F.lit(134217729.0)
        high = big - (big - v)
        err = (high * scale - v * scale) + (v - high) * scale
        return (err > 0) | ((err == 0) & (F.floor(v * scale) % 2 != 0))

    tie = F.get(F.transform(F.array(value), tie_goes_up), F.lit(0))
    return (whole + F.when(rest > 0.5, 1).when((rest == 0.5) & tie, 1).otherwise(0)).cast("bigint")


#: From here on the whole part and the fraction are written apart, as their joint digits outgrow a bigint.
LARGE = 1e11


def fixed_text(value: Column, digits: int) -> Column:
    """Fixed-point text with `digits` decimals; `nan`, `inf` and `-inf` for values that are not finite.

    Exact for all doubles below 2^63; larger ones show their shortest digits.
    """
    return _digits_text(value, _small_round(value, digits), digits)


def _small_round(value: Column, digits: int) -> Column:
    size = F.abs(value)
    return F.when(size < LARGE, _scaled_round(F.when(size < LARGE, size), digits))


def _digits_text(value: Column, scaled: Column, digits: int) -> Column:
    unit = F.lit(10**digits).cast("bigint")
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    small = F.concat(
        ((scaled - scaled % unit) / unit).cast("bigint").cast("string"),
        F.lit("."),
        F.lpad((scaled % unit).cast("string"), digits, "0"),
    )
    return (
        F.when(F.isnan(value), "nan")
        .when(F.abs(value) == float("inf"), F.concat(sign, F.lit("inf")))
        .when(F.abs(value) < LARGE, F.concat(sign, small))
        .otherwise(F.concat(sign, _large_text(F.abs(value), digits)))
    )


def _large_text(size: Column, digits: int) -> Column:
    whole = F.when(size < 9.2e18, F.floor(F.when(size < 9.2e18, size)))
    part = _scaled_round(F.when(size < 9.2e18, size - whole), digits)
    unit = F.lit(10**digits).cast("bigint")
    exact = F.concat(
        (whole + F.when(part >= unit, 1).otherwise(0)).cast("string"), F.lit("."),
        F.lpad((part % unit).cast("string"), digits, "0"),
    )
    beyond = F.coalesce(size.try_cast("decimal(38,0)").cast("string"), size.cast("string"))
    return F.when(size < 9.2e18, exact).otherwise(F.concat(beyond, F.lit("." + "0" * digits)))


def percent_text(value: Column, digits: int = 2) -> Column:
    """Percent text, the value times 100 with `digits` decimals."""
    return F.concat(fixed_text(value * F.lit(100.0), digits), F.lit("%"))


def with_fixed_text(df: DataFrame, columns: dict[str, tuple[Column, int]]) -> DataFrame:
    """Add several fixed-point texts, given as name -> (value, decimals), in two projections."""
    rounded = {f"_k_{n}": _small_round(v, digits) for n, (v, digits) in columns.items()}
    texts = {n: _digits_text(v, F.col(f"_k_{n}"), digits) for n, (v, digits) in columns.items()}
    return df.withColumns(rounded).withColumns(texts).select(*df.columns, *columns)


def round_even(value: Column) -> Column:
    """Nearest integer, ties to even, as bigint."""
    return F.bround(value, 0).cast("bigint")


def finite(value: Column) -> Column:
    """True for a value that is neither null, NaN nor infinite."""
    v = value.cast("double")
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))


def number_of(text: Column) -> Column:
    """The number that a text spells, null for any other text; type suffixes and hexadecimal forms are no numbers."""
    spelled = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
    return F.when(text.rlike(spelled), F.trim(text).try_cast("double"))


def field_equal(a: Column, b: Column) -> Column:
    """Loose equality: both missing, else equal as numbers if both are numbers, else as text."""
    gone_a = a.isNull() | (a.cast("string") == "NaN")
    gone_b = b.isNull() | (b.cast("string") == "NaN")
    num_a, num_b = number_of(a.cast("string")), number_of(b.cast("string"))
    return (
        F.when(gone_a & gone_b, True)
        .when(gone_a | gone_b, False)
        .when(num_a.isNotNull() & num_b.isNotNull(), num_a == num_b)
        .otherwise(a.cast("string") == b.cast("string"))
    )


def comparable_text(value: Column) -> Column:
    """A text that is the same for two values exactly if `field_equal` holds for them; never null."""
    text = value.cast("string")
    number = number_of(text)
    return (
        F.when(text.isNull() | (text == "NaN"), "missing")
        .when(number.isNotNull(), F.concat(F.lit("number "), (number + F.lit(0.0)).cast("string")))
        .otherwise(F.concat(F.lit("text "), text))
    )
