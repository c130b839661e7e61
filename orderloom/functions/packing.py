"""Columns of a row as one number and one text while the row is shuffled, and as they were after it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Between texts that are packed into one; a text that holds it is not packed.
SEPARATOR = "\x1f"

# A number of 63 bits holds the packed ones without a sign.
MOST_BITS = 63

# Digits of a decimal that is kept as a long.
LONG_DIGITS = 18

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def short_decimal(kind: T.DataType) -> bool:
    return isinstance(kind, T.DecimalType) and kind.precision <= LONG_DIGITS


def can_be_number(kind: T.DataType) -> bool:
    return isinstance(kind, (*_WHOLE, T.BooleanType, T.DateType, T.DoubleType)) or short_decimal(kind)


def _as_number(value: Column, kind: T.DataType) -> Column:
    """A value as a whole number that gives it back; null if there is none."""
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, T.DoubleType):
        number = value.try_cast("long")
        # Zero may have a sign, which a whole number has not.
        return F.when((number.cast("double") == value) & (number != 0), number)
    if isinstance(kind, T.DecimalType):
        return (value * F.lit(Decimal(10**kind.scale))).cast("long")
    return value.cast("long")


def _from_number(number: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(number.cast("int"))
    if isinstance(kind, T.DecimalType):
        return (number.cast(T.DecimalType(LONG_DIGITS, 0)) * F.lit(Decimal(1).scaleb(-kind.scale))).cast(kind)
    if isinstance(kind, T.BooleanType):
        return number == 1
    return number.cast(kind)


class Packing:
    """A row's columns in the form in which a shuffle moves fewest bytes.

    Every column of a row costs a shuffle eight bytes and more, however little it holds. numbers
    are columns with the bits their values mostly need, all together in one long; texts go into one
    text; amounts are decimals of many digits that mostly need 18. A row of which any value does
    not fit (a null, a number beyond its bits or below zero, a text with the separator) carries
    these columns as they are, so that every row comes back as it was. A row that an outer join
    fills with nulls comes back as nulls. label tells packings of one row apart.
    """

    def __init__(
        self,
        rows: DataFrame,
        numbers: Mapping[str, int],
        texts: Sequence[str] = (),
        amounts: Sequence[str] = (),
        label: str = "packed",
    ):
        if sum(numbers.values()) > MOST_BITS:
            raise ValueError(f"{sum(numbers.values())} bits are too many: {dict(numbers)}")
        self.kinds = {f.name: f.dataType for f in rows.schema}
        self.numbers, self.texts, self.amounts = dict(numbers), list(texts), list(amounts)
        self.columns = [*self.numbers, *self.texts, *self.amounts]
        self._number, self._text, self._rest = (f"_{label}_{c}" for c in ("numbers", "texts", "rest"))

    def _places(self) -> dict[str, int]:
        places, at = {}, 0
        for name, bits in self.numbers.items():
            places[name], at = at, at + bits
        return places

    def _short(self, name: str) -> Column:
        return F.col(name).try_cast(T.DecimalType(LONG_DIGITS, self.kinds[name].scale))

    def packed(self, rows: DataFrame) -> DataFrame:
        if not self.columns:
            return rows
        number = {c: _as_number(F.col(c), self.kinds[c]) for c in self.numbers}
        tests = [number[c].between(0, (1 << bits) - 1) for c, bits in self.numbers.items()]
        tests += [~F.col(c).contains(SEPARATOR) for c in self.texts]
        tests += [self._short(c).isNotNull() for c in self.amounts]
        rows = rows.withColumn("_fits", F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False)))
        fits, made = F.col("_fits"), [self._short(c).alias(c) for c in self.amounts]
        if self.numbers:
            parts = [F.shiftleft(number[c], place) for c, place in self._places().items()]
            made.append(F.when(fits, reduce(Column.bitwiseOR, parts)).alias(self._number))
        if self.texts:
            made.append(F.when(fits, F.concat_ws(SEPARATOR, *self.texts)).alias(self._text))
        others = [c for c in rows.columns if c not in self.columns and c != "_fits"]
        return rows.select(*others, *made, F.when(~fits, F.struct(*self.columns)).alias(self._rest))

    def unpacked(self, rows: DataFrame) -> DataFrame:
        """The columns as they were, behind those that were not packed."""
        if not self.columns:
            return rows
        found = {}
        for name, place in self._places().items():
            number = F.shiftright(self._number, place).bitwiseAND(F.lit((1 << self.numbers[name]) - 1).cast("long"))
            found[name] = _from_number(number, self.kinds[name])
        for place, name in enumerate(self.texts, 1):
            found[name] = F.split_part(self._text, F.lit(SEPARATOR), F.lit(place))
        for name in self.amounts:
            found[name] = F.col(name).cast(self.kinds[name])
        # What was packed is never null; without a condition around it, a text is taken apart once per row.
        made = [F.coalesce(found[c], F.col(self._rest)[c]).alias(c) for c in self.columns]
        others = [c for c in rows.columns if c not in (*self.columns, self._number, self._text, self._rest)]
        return rows.select(*others, *made)
