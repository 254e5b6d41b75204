"""Flag rows by a condition a user states: Yes, No, or INVALID where it cannot be evaluated.

A condition is built from clauses instead of being parsed from text::

    all_of(clause("G", ">", 1000), clause("E", "==", "Meal"), negate(empty("F")))
    clause(Cell("A") + Cell("B") * 2, ">=", Cell("C"))

Names are sheet letters or columns. Cells are numbers, texts, dates or empty; true and false are the
numbers 1 and 0. Only cells of one kind can be ordered, equality between kinds is false, and
arithmetic needs numbers (or two texts to join); everything else that cannot be evaluated is INVALID. A
text that spells a number is a text, unless ``loose`` cells are asked for, as for sheets read as text.
Conditions are decided from left to right and stop as soon as the answer is known.
"""

from __future__ import annotations

import datetime as dt
import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from tallyloom.functions.cells import cell, number

YES, NO, INVALID = "Yes", "No", "INVALID"
MARK = "Peach"

_ORDERING = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}
_EQUALITY = ("==", "!=")
_NUMBER, _TEXT, _DATE = "double", "string", "timestamp_ntz"

Condition = Callable[[DataFrame, bool], Column]


@dataclass(frozen=True)
class _Value:
    """A value as number, text and date (NULL unless it is one), and whether working it out failed."""

    number: Column
    text: Column
    date: Column
    failed: Column

    def kinds(self) -> tuple[Column, Column, Column]:
        return self.number, self.text, self.date

    def empty(self) -> Column:
        return self.number.isNull() & self.text.isNull() & self.date.isNull()


def _value(number: Column | None = None, text: Column | None = None, date: Column | None = None, failed: Column | None = None) -> _Value:
    given = [F.lit(None).cast(kind) if c is None else c for c, kind in ((number, _NUMBER), (text, _TEXT), (date, _DATE))]
    return _Value(*given, F.lit(False) if failed is None else failed)


class Term:
    """A value in a condition: a cell, a constant, or arithmetic on them."""

    def value(self, df: DataFrame, loose: bool) -> _Value:
        raise NotImplementedError

    def __add__(self, other):
        return Sum("+", self, term(other))

    def __sub__(self, other):
        return Sum("-", self, term(other))

    def __mul__(self, other):
        return Sum("*", self, term(other))

    def __truediv__(self, other):
        return Sum("/", self, term(other))


@dataclass(frozen=True)
class Cell(Term):
    """A cell by column name or sheet letters."""

    name: str

    def value(self, df: DataFrame, loose: bool) -> _Value:
        if self.name in df.columns:
            column = F.col(f"`{self.name}`")
        elif self.name.isalpha() and self.name.isupper():
            column = cell(df, self.name)
        else:
            raise ValueError(f"no column {self.name!r}")
        kind = df.select(column).schema[0].dataType
        if isinstance(kind, (NumericType, BooleanType)):
            return _value(number=(column.cast("int") if isinstance(kind, BooleanType) else column).cast(_NUMBER))
        if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
            return _value(date=column.cast(_DATE))
        if not isinstance(kind, StringType):
            raise ValueError(f"column {self.name!r} is no number, text, date or truth value")
        if not loose:
            return _value(text=column)
        spelled = number(column)
        return _value(number=spelled, text=F.when(spelled.isNull(), column))


@dataclass(frozen=True)
class Constant(Term):
    content: float | str | bool | dt.date

    def value(self, df: DataFrame, loose: bool) -> _Value:
        if isinstance(self.content, str):
            return _value(text=F.lit(self.content))
        if isinstance(self.content, dt.date):
            return _value(date=F.lit(self.content).cast(_DATE))
        return _value(number=F.lit(float(self.content)))


@dataclass(frozen=True)
class Sum(Term):
    """Arithmetic on two terms; a division by zero or an operand that does not fit fails."""

    op: str
    left: Term
    right: Term

    def value(self, df: DataFrame, loose: bool) -> _Value:
        a, b = self.left.value(df, loose), self.right.value(df, loose)
        apply = {"+": operator.add, "-": operator.sub, "*": operator.mul, "/": F.try_divide}[self.op]
        result = apply(a.number, b.number)
        joined = F.concat(a.text, b.text) if self.op == "+" else None
        done = result.isNotNull() if joined is None else result.isNotNull() | joined.isNotNull()
        return _value(number=result, text=joined, failed=a.failed | b.failed | ~done)


def term(value: float | str | bool | dt.date | Term) -> Term:
    if isinstance(value, Term):
        return value
    if isinstance(value, (bool, int, float, str, dt.date)):
        return Constant(value)
    raise ValueError(f"cannot compare with {value!r}")


def _named(name: str | Term) -> Term:
    return name if isinstance(name, Term) else Cell(name)


def _equal(a: _Value, b: _Value) -> Column:
    same = [x == y for x, y in zip(a.kinds(), b.kinds())]
    return F.coalesce(*same, a.empty() & b.empty())


def _answer(failed: Column, true: Column) -> Column:
    return F.when(failed, INVALID).when(true, YES).otherwise(NO)


def clause(name: str | Term, op: str, value: float | str | bool | dt.date | Term) -> Condition:
    """Compare a cell or term with a constant, another cell or a term."""
    if op not in _ORDERING and op not in _EQUALITY:
        raise ValueError(f"unknown comparison {op!r}")
    left, right = _named(name), term(value)

    def build(df: DataFrame, loose: bool = False) -> Column:
        a, b = left.value(df, loose), right.value(df, loose)
        failed = a.failed | b.failed
        if op in _EQUALITY:
            return _answer(failed, _equal(a, b) if op == "==" else ~_equal(a, b))
        ordered = F.coalesce(*[_ORDERING[op](x, y) for x, y in zip(a.kinds(), b.kinds())])
        return _answer(failed | ordered.isNull(), ordered)

    return build


def member(name: str | Term, values: Sequence[float | str | bool | dt.date | Term]) -> Condition:
    """Is the cell equal to one of the values?"""
    left, among = _named(name), [term(v) for v in values]

    def build(df: DataFrame, loose: bool = False) -> Column:
        a, others = left.value(df, loose), [t.value(df, loose) for t in among]
        failed = reduce(operator.or_, [o.failed for o in others], a.failed)
        return _answer(failed, reduce(operator.or_, [_equal(a, o) for o in others], F.lit(False)))

    return build


def empty(name: str | Term) -> Condition:
    """Is the cell empty?"""

    def build(df: DataFrame, loose: bool = False) -> Column:
        value = _named(name).value(df, loose)
        return _answer(value.failed, value.empty())

    return build


def negate(part: Condition) -> Condition:
    """The opposite answer; INVALID stays."""

    def build(df: DataFrame, loose: bool = False) -> Column:
        answer = part(df, loose)
        return F.when(answer == YES, NO).when(answer == NO, YES).otherwise(INVALID)

    return build


def all_of(*parts: Condition) -> Condition:
    """True when every part is; the first part that is not decides."""

    def build(df: DataFrame, loose: bool = False) -> Column:
        answers = [part(df, loose) for part in parts]
        result = answers[-1]
        for answer in reversed(answers[:-1]):
            result = F.when(answer != YES, answer).otherwise(result)
        return result

    if not parts:
        raise ValueError("no parts")
    return build


def any_of(*parts: Condition) -> Condition:
    """True when one part is; the first part that is not false decides."""

    def build(df: DataFrame, loose: bool = False) -> Column:
        answers = [part(df, loose) for part in parts]
        result = answers[-1]
        for answer in reversed(answers[:-1]):
            result = F.when(answer != NO, answer).otherwise(result)
        return result

    if not parts:
        raise ValueError("no parts")
    return build


def flag_rows(
    df: DataFrame, condition: Condition, into: str = "Results", highlight: str = "highlight", loose: bool = False
) -> DataFrame:
    """Add the answer and the colour that marks the Yes rows. A bad condition fails before any job.

    With ``loose`` a text that spells a number is read as that number.
    """
    answer = condition(df, loose)
    return df.withColumn(into, answer).withColumn(highlight, F.when(F.col(into) == YES, MARK))


def flag_above(df: DataFrame, column: str, limit: float = 1000.0, into: str = "Results") -> DataFrame:
    """Yes where a cell is a number above ``limit``, No otherwise, also for text and empty cells."""
    return df.withColumn(into, F.when(number(F.col(column).cast("string")) > limit, YES).otherwise(NO))
