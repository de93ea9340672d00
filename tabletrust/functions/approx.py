"""Approximate equality as native Column expressions.

The scalar rule, in order: a NULL on either side compares strictly;
NaN expected is equal only to NaN actual and only when ``nan_ok``; NaN
actual is unequal; exact equality holds; an infinite expected value is
equal only to itself; otherwise ``|expected - actual| <= tolerance``.
The NaN tests come before the equality test because Spark treats
``NaN = NaN`` as true.

Tolerance: with ``abs`` given and ``rel`` not, the absolute tolerance
alone; otherwise ``max(rel * |expected|, abs)`` with the defaults below.
Negative or NaN tolerances are an error, raised while planning for
Python numbers and at run time for per-row tolerance columns.
"""

from __future__ import annotations

import math
from decimal import Decimal

import pandas as pd

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The default tolerances.
DEFAULT_ABS = 1e-12
DEFAULT_REL = 1e-6

INF = float("inf")
INTEGERS = ("tinyint", "smallint", "int", "bigint")
#: Types that compare as numbers; NULL compares with anything.
NUMBER = "^(tinyint|smallint|int|bigint|float|double|boolean|void|decimal.*)$"


def _validate(name: str, v) -> None:
    if v is None or isinstance(v, Column):
        return
    if isinstance(v, bool) or not isinstance(v, (int, float, Decimal)):
        raise TypeError(f"{name} tolerance must be a number, got {type(v).__name__}")
    if math.isnan(float(v)):
        raise ValueError(f"the {name} tolerance is NaN")
    if v < 0:
        raise ValueError(f"the {name} tolerance is below zero: {v}")


def _checked(col: Column, name: str) -> Column:
    """Per-row tolerance column: raise on negative or NaN at run time."""
    return F.when(
        col.isNotNull() & ((col < 0) | F.isnan(col)),
        F.raise_error(F.concat(F.lit(f"the {name} tolerance is below zero or NaN: "), col.cast("string"))),
    ).otherwise(col)


def tolerance(expected: Column, rel=None, abs=None) -> Column:  # noqa: A002 - mirrors the API
    """The tolerance applied to one expected value (double)."""
    _validate("relative", rel)
    _validate("absolute", abs)
    e = expected.cast("double")
    if isinstance(rel, Column) or isinstance(abs, Column):
        r = _checked(rel.cast("double"), "relative") if isinstance(rel, Column) else F.lit(rel).cast("double")
        a = _checked(abs.cast("double"), "absolute") if isinstance(abs, Column) else F.lit(abs).cast("double")
        return F.when(r.isNull() & a.isNotNull(), a).otherwise(
            F.greatest(F.coalesce(r, F.lit(DEFAULT_REL)) * F.abs(e), F.coalesce(a, F.lit(DEFAULT_ABS)))
        )
    if rel is None and abs is not None:
        return F.lit(float(abs))
    r = DEFAULT_REL if rel is None else float(rel)
    a = DEFAULT_ABS if abs is None else float(abs)
    return F.greatest(F.lit(r) * F.abs(e), F.lit(a))


def near(actual: Column, expected: Column, rel=None, abs=None, nan_ok=False) -> Column:  # noqa: A002
    """A1/A2: scalar approximate equality; never NULL.

    Columns that are not numbers compare strictly, and never equal a number.
    Of numbers, equality is tested in the columns' own types, and integers
    are subtracted exactly; only other differences are taken in doubles.
    (Types that no cast to double exists for, such as dates, go through
    :func:`near_for_type`.)"""
    numbers = F.typeof(actual).rlike(NUMBER) & F.typeof(expected).rlike(NUMBER)
    strict = F.when(F.typeof(actual) == F.typeof(expected), actual.eqNullSafe(expected)).otherwise(actual.isNull() & expected.isNull())
    a, e = actual.try_cast("double"), expected.try_cast("double")
    integers = F.typeof(actual).isin(*INTEGERS) & F.typeof(expected).isin(*INTEGERS)
    exact = F.abs(expected.try_cast("decimal(20,0)") - actual.try_cast("decimal(20,0)")).cast("double")
    nan_ok_col = nan_ok if isinstance(nan_ok, Column) else F.lit(bool(nan_ok))
    return (
        F.when(~numbers, strict)
        .when(a.isNull() | e.isNull(), a.eqNullSafe(e))
        .when(F.isnan(e), nan_ok_col & F.isnan(a))
        .when(F.isnan(a), F.lit(False))
        .when(actual == expected, F.lit(True))
        .when(F.abs(e) == F.lit(INF), F.lit(False))
        .otherwise(F.when(integers, exact).otherwise(F.abs(e - a)) <= tolerance(e, rel, abs))
    )


#: What :func:`near_decimal` assumes of columns whose type it is not told.
DECIMAL = T.DecimalType(38, 12)


RADIX = 10**9


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body
    names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _limbs(whole: Column, units: Column, scale: int) -> Column:
    """The number whole * 10**scale + units, neither negative, as digits to
    the base 10**9, first ones first: an array that compares as the numbers
    do and whose products stay exact where one decimal would be rounded."""
    count = -(-(39 + scale) // 9)
    digits = F.lpad(whole.cast("string"), count * 9 - scale, "0")
    if scale:
        digits = F.concat(digits, F.lpad(units.cast("string"), scale, "0"))
    return _let(digits, lambda d: F.array(*[F.substring(d, 9 * i + 1, 9).cast("bigint") for i in range(count)]))


def _times(limbs: Column, factor: int) -> Column:
    """The product with a factor of at most 10**9, one digit longer."""
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("out"))

    def step(acc: Column, limb: Column) -> Column:
        radix = F.lit(RADIX).cast("bigint")
        return _let(limb * F.lit(factor).cast("bigint") + acc["carry"], lambda p: F.struct(
            F.call_function("div", p, radix).alias("carry"), F.concat(F.array(p % radix), acc["out"]).alias("out")))

    return F.aggregate(F.reverse(limbs), start, step, lambda acc: F.concat(F.array(acc["carry"]), acc["out"]))


def _split(v: Column, dtype: T.DecimalType) -> Column:
    """struct(whole, units): the part before the point, towards zero, and
    the rest in units of the last digit."""
    rest = v % F.lit(Decimal(1)).cast("decimal(1,0)")
    units = (rest * F.lit(Decimal(10**dtype.scale)).cast(f"decimal({dtype.scale + 1},0)")).cast("decimal(38,0)")
    return F.struct(F.when(v < 0, F.ceil(v)).otherwise(F.floor(v)).cast("decimal(38,0)").alias("whole"), units.alias("units"))


def _size(number: Column, scale: int) -> Column:
    """Limbs of the absolute value of a struct(whole, units) whose units
    may have another sign or one unit too many."""
    unit = F.lit(Decimal(10**scale)).cast("decimal(38,0)")

    def positive(n: Column) -> Column:
        below = (n["whole"] < 0) | ((n["whole"] == 0) & (n["units"] < 0))
        return F.when(below, F.struct((-n["whole"]).alias("whole"), (-n["units"]).alias("units"))).otherwise(n)

    def carried(n: Column) -> Column:
        over = F.when(n["units"] < 0, -1).when(n["units"] >= unit, 1).otherwise(0).cast("decimal(1,0)")
        return _let(over, lambda o: _limbs((n["whole"] + o).cast("decimal(38,0)"), (n["units"] - o * unit).cast("decimal(38,0)"), scale))

    return _let(_let(number, positive), carried)


def near_decimal(actual: Column, expected: Column, rel=None, abs=None, dtype: T.DecimalType | None = None) -> Column:  # noqa: A002
    """A3: the same rule in exact decimal arithmetic, for operands of type
    ``dtype``.  Without it both are taken as decimal(38,12), and a value
    that this cannot hold raises.  Nothing is rounded away; a relative
    tolerance that is no fraction of numbers up to 10**9 is refused while
    planning.  A difference of 10**38 or more is never near."""
    _validate("relative", rel)
    _validate("absolute", abs)
    if dtype is None:
        dtype = DECIMAL
        actual, expected = _exactly(actual, dtype), _exactly(expected, dtype)
    scale = dtype.scale
    if dtype.precision > 26 and scale > 17:
        raise ValueError(f"{dtype.simpleString()} leaves no room for exact comparison: give at most 17 digits after the point")
    only_abs = rel is None and abs is not None
    least = Decimal(str(DEFAULT_ABS if abs is None else abs))
    a, e = actual.cast(dtype), expected.cast(dtype)
    # A difference has no more than ``scale`` digits: cutting the bound
    # after them changes no comparison.
    cut = int(least.scaleb(scale))
    top, bottom = (0, 1) if only_abs else Decimal(str(DEFAULT_REL if rel is None else rel)).as_integer_ratio()
    if max(top, bottom) > 10**9:
        raise ValueError(f"the relative tolerance {rel} has too many digits for exact decimals")
    if dtype.precision <= 26:  # then products have room in one decimal
        apart = F.abs(e - a)
        by = [F.lit(Decimal(n)).cast("decimal(10,0)") for n in (top, bottom)]
        bound = Decimal(cut).scaleb(-scale)
        near_enough = (apart <= F.lit(bound)) | (apart * by[1] <= F.abs(e) * by[0])
    else:
        whole, units = divmod(cut, 10**scale)
        least_limbs = _limbs(F.lit(str(whole)), F.lit(str(units)), scale)

        def near_parts(n: Column) -> Column:
            x, y = n["a"], n["e"]
            apart = F.struct(F.try_subtract(y["whole"], x["whole"]).cast("decimal(38,0)").alias("whole"),
                             (y["units"] - x["units"]).cast("decimal(38,0)").alias("units"))
            if only_abs:
                return _size(apart, scale) <= least_limbs
            return _let(_size(apart, scale), lambda d: (d <= least_limbs) | (_times(d, bottom) <= _times(_size(y, scale), top)))

        near_enough = _let(F.struct(_split(a, dtype).alias("a"), _split(e, dtype).alias("e")), near_parts)
    return F.when(a.isNull() | e.isNull(), a.eqNullSafe(e)).when(a == e, F.lit(True)).otherwise(F.coalesce(near_enough, F.lit(False)))


def _exactly(v: Column, dtype: T.DecimalType) -> Column:
    """``v`` as ``dtype``; raises if that loses digits."""
    def plain(c: Column) -> Column:
        text = c.cast("string")
        return F.when(text.contains("."), F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text)

    cast = v.cast(dtype)
    return F.when(plain(cast) != plain(v), F.raise_error(F.concat(
        F.lit(f"not a {dtype.simpleString()}: "), v.cast("string"))).cast(dtype)).otherwise(cast)


def _rule(element: T.DataType | None, rel, abs, nan_ok):  # noqa: A002
    """The comparison of two elements of a type."""
    if element is None:
        return lambda x, y: near(x, y, rel, abs, nan_ok)
    return lambda x, y: near_for_type(x, y, element, rel, abs, nan_ok)


def near_array(actual: Column, expected: Column, rel=None, abs=None, nan_ok=False, element: T.DataType | None = None) -> Column:  # noqa: A002
    """A4: ordered arrays, equal length, every pair near, by the rule of the
    type ``element`` if it is given (exact decimals, dates)."""
    pairs = F.zip_with(actual, expected, _rule(element, rel, abs, nan_ok))
    return F.when(actual.isNull() | expected.isNull(), actual.isNull() & expected.isNull()).otherwise(
        (F.size(actual) == F.size(expected)) & F.forall(pairs, lambda b: b)
    )


def near_array_scalar(actual: Column, expected_scalar: Column, rel=None, abs=None, nan_ok=False) -> Column:  # noqa: A002
    """A5: every element of an actual array near one expected scalar."""
    return F.when(actual.isNull(), F.lit(False)).otherwise(
        F.forall(actual, lambda x: near(x, expected_scalar, rel, abs, nan_ok))
    )


def near_scalar_array(actual_scalar: Column, expected: Column, rel=None, abs=None, nan_ok=False) -> Column:  # noqa: A002
    """A5: one actual scalar against every element of an expected array."""
    return F.when(expected.isNull(), F.lit(False)).otherwise(
        F.forall(expected, lambda y: near(actual_scalar, y, rel, abs, nan_ok))
    )


def near_ndarray(actual: Column, actual_shape: Column, expected: Column, expected_shape: Column,
                 rel=None, abs=None, nan_ok=False) -> Column:  # noqa: A002
    """N-d arrays stored flat with a shape column; shapes must agree."""
    return actual_shape.eqNullSafe(expected_shape) & near_array(actual, expected, rel, abs, nan_ok)


def near_map(actual: Column, expected: Column, rel=None, abs=None, nan_ok=False, element: T.DataType | None = None) -> Column:  # noqa: A002
    """Equal key sets, values compared by key, by the rule of their type
    ``element`` if it is given."""
    rule = _rule(element, rel, abs, nan_ok)
    same_keys = F.array_sort(F.map_keys(actual)) == F.array_sort(F.map_keys(expected))
    values = F.forall(
        F.map_keys(expected),
        lambda k: rule(F.try_element_at(actual, k), F.try_element_at(expected, k)),
    )
    # ``<=>`` is not defined on maps: test the NULL branch by hand.
    return F.when(actual.isNull() | expected.isNull(), actual.isNull() & expected.isNull()).otherwise(
        F.coalesce(same_keys & values, F.lit(False))
    )


def check_not_nested(dtype: T.DataType, what: str) -> None:
    """Nested containers are refused, as for the scalar comparison API."""
    inner = None
    if isinstance(dtype, T.ArrayType):
        inner = dtype.elementType
    elif isinstance(dtype, T.MapType):
        inner = dtype.valueType
    if isinstance(inner, (T.ArrayType, T.MapType, T.StructType)):
        raise TypeError(f"{what}: nested structures are not supported: {dtype.simpleString()}")


def near_for_type(actual: Column, expected: Column, dtype: T.DataType, rel=None, abs=None, nan_ok=False) -> Column:  # noqa: A002
    """Pick the rule by column type: numbers by tolerance, decimals exactly,
    arrays and maps element-wise, everything else strictly."""
    if isinstance(dtype, T.DecimalType):
        return near_decimal(actual, expected, rel, abs, dtype)
    if isinstance(dtype, T.NumericType) and not isinstance(dtype, T.BooleanType):
        return near(actual, expected, rel, abs, nan_ok)
    if isinstance(dtype, T.ArrayType):
        check_not_nested(dtype, "array")
        return near_array(actual, expected, rel, abs, nan_ok, dtype.elementType)
    if isinstance(dtype, T.MapType):
        check_not_nested(dtype, "map")
        return near_map(actual, expected, rel, abs, nan_ok, dtype.valueType)
    return actual.eqNullSafe(expected)


@F.pandas_udf(T.StringType())
def _plus_minus_text(expected: pd.Series, tol: pd.Series) -> pd.Series:
    # Python's float formatting: shortest round-trip repr for the value and
    # correctly rounded ``.1e`` for the tolerance.  Java's ``%.1e`` rounds
    # the decimal string half-up instead (9.05e-4 prints 9.1e-04).
    out = [
        None if e is None or pd.isna(e) else (repr(float(e)) if t is None or pd.isna(t) else f"{float(e)!r} ± {float(t):.1e}")
        for e, t in zip(expected.tolist(), tol.tolist())
    ]
    return pd.Series(out, dtype=object)


def tolerance_text(expected: Column, rel=None, abs=None) -> Column:  # noqa: A002
    """``expected ± tolerance``; infinities and NaN print bare.

    Text formatting only, for mismatch reports: a small Arrow-batched
    helper, never on a comparison path.
    """
    e = expected.cast("double")
    bare = e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(INF))
    tol = F.when(bare, F.lit(None).cast("double")).otherwise(tolerance(e, rel, abs))
    return F.when(e.isNull(), F.lit(None).cast("string")).otherwise(_plus_minus_text(e, tol))
