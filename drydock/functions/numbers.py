"""Numeric parsing guarded by patterns, so that lenient casts cannot differ."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from drydock.config import FALSE_TOKENS, TRUE_TOKENS

# What counts as a whole number and as any number. The ends are
# absolute: "$" would also match before a final line separator.
INTEGER = r"\A[ \t\n\x0B\f\r]*[+-]?[0-9]+[ \t\n\x0B\f\r]*\z"
NUMBER = (r"(?i)\A[ \t\n\x0B\f\r]*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?"
          r"|inf|infinity)[ \t\n\x0B\f\r]*\z")

_BLANKS = " \t\n\x0b\x0c\r"
_TWO_63 = 9223372036854775808.0

# One bit per kind of value. The bits of a column, or-ed together, tell its type.
BOOL, INT64, UINT64, DOUBLE, TEXT, NEGATIVE = 1, 2, 4, 8, 16, 32


def _bare(c: Column) -> Column:
    return F.btrim(c, F.lit(_BLANKS))


# First characters (as code points) a number can have.
_NUMBER_STARTS = [*range(9, 14), ord(" "), ord("+"), ord("-"), ord("."), *range(ord("0"), ord("9") + 1),
                  ord("i"), ord("I")]


def is_integer(c: Column) -> Column:
    return c.rlike(INTEGER)


def is_number(c: Column) -> Column:
    return c.rlike(NUMBER)


def to_double(c: Column) -> Column:
    """Text to DOUBLE; what is not a number, or overflows, becomes null."""
    value = _bare(c).try_cast("double")
    overflow = F.abs(value) == F.lit(float("inf"))
    spelled = F.lower(c).contains("inf")
    return F.when(is_number(c) & (~overflow | spelled), value)


def to_bigint(c: Column, as_double: Column | None = None) -> Column:
    """Text to BIGINT; fractions, overflows and non-numbers become null.

    ``as_double`` may hold ``to_double(c)`` computed before.
    """
    value = to_double(c) if as_double is None else as_double
    whole = F.when(F.abs(value) < _TWO_63, value.cast("bigint"))
    return F.when(is_integer(c), _bare(c).try_cast("bigint")).when(whole.cast("double") == value, whole)


def to_boolean(c: Column) -> Column:
    return F.when(c.isin(list(TRUE_TOKENS)), True).when(c.isin(list(FALSE_TOKENS)), False)


def to_unsigned(c: Column) -> Column:
    return F.when(is_integer(c), _bare(c).try_cast("decimal(20,0)"))


def _whole(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(38,0)")


def pattern_class(c: Column) -> Column:
    """What a text looks like: a bit that is settled, or -1 for a whole and -2
    for another number, which ``kind`` looks at closer. Null gives 0."""
    return (
        F.when(c.isNull(), F.lit(0))
        .when(~F.ascii(c).isin(_NUMBER_STARTS),
              F.when(c.isin(list(TRUE_TOKENS + FALSE_TOKENS)), F.lit(BOOL)).otherwise(F.lit(TEXT)))
        .when(is_integer(c), F.lit(-1))
        .when(is_number(c), F.lit(-2))
        .otherwise(F.lit(TEXT)))


def kind(c: Column, looks: Column | None = None) -> Column:
    """The bit of one text value (0 for null).

    A failing cast costs far more than a pattern, so a value is cast only where
    its form leaves something open: up to 18 characters always fit 64 bits, and
    a number can only overflow by an exponent or by great length. ``looks`` may
    hold ``pattern_class(c)``, best as a column of an earlier projection, so that
    neither step's generated code grows too large to be compiled.
    """
    looks = pattern_class(c) if looks is None else looks
    negative = c.contains("-") & (_bare(c).try_cast("decimal(38,0)") < 0)
    short = F.when(negative, F.lit(INT64 | NEGATIVE)).otherwise(F.lit(INT64))
    wide = _bare(c).try_cast("decimal(38,0)")
    long = (
        F.when(wide.between(_whole(-2**63), _whole(-1)), F.lit(INT64 | NEGATIVE))
        .when(wide.between(_whole(0), _whole(2**63 - 1)), F.lit(INT64))
        .when(wide.between(_whole(2**63), _whole(2**64 - 1)), F.lit(UINT64))
        .otherwise(F.lit(TEXT)))
    integer = F.when(F.octet_length(c) <= 18, short).otherwise(long)
    may_overflow = F.lower(c).contains("e") | (F.octet_length(c) > 300)
    overflow = may_overflow & (F.abs(_bare(c).try_cast("double")) == F.lit(float("inf"))) & ~F.lower(c).contains("inf")
    return (F.when(looks == -1, integer)
            .when(looks == -2, F.when(overflow, F.lit(TEXT)).otherwise(F.lit(DOUBLE)))
            .otherwise(looks))


def type_of(kinds: Column, rows: Column) -> Column:
    """The narrowest type which holds all kinds seen in a column."""
    def only(*bits: int) -> Column:
        return kinds.bitwiseAND(F.lit(~sum(bits) & 63)) == 0

    return (
        F.when(rows == 0, "string")
        .when(kinds == 0, "double")
        .when(only(BOOL), "boolean")
        .when(only(INT64, NEGATIVE), "bigint")
        .when(only(INT64, UINT64), "decimal(20,0)")
        .when(only(INT64, UINT64, NEGATIVE), "string")
        .when(only(INT64, UINT64, NEGATIVE, DOUBLE), "double")
        .otherwise("string"))


def as_type(c: Column, name: str, proven: bool = False) -> Column:
    """Text to one of the inferred types.

    Where every value is ``proven`` to be of the type, a plain cast will do; a
    text that it cannot turn breaks the proof, and the job fails.
    """
    if proven and name in ("bigint", "double", "decimal(20,0)"):
        unproven = F.raise_error(F.concat(F.lit(f"not {name} after all: "), c)).cast(name)
        return F.when(c.isNotNull(), F.coalesce(_bare(c).try_cast(name), unproven))
    makers = {"bigint": to_bigint, "double": to_double, "boolean": to_boolean,
              "decimal(20,0)": to_unsigned, "string": lambda x: x}
    return makers[name](c)
