"""CASE in its forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _value(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


class _Chain:
    """Conditions and their values so far; as a column it gives null where none holds."""

    def __init__(self, conditions, subject: Column | None = None):
        self._done, self._subject = list(conditions), subject

    def when(self, condition) -> _When:
        return _When(self, condition)

    @property
    def column(self) -> Column:
        if not self._done:
            raise ValueError("a CASE needs a WHEN")
        out = F.when(*self._done[0])
        for pair in self._done[1:]:
            out = out.when(*pair)
        return out

    def else_(self, value) -> Column:
        return self.column.otherwise(_value(value))

    end = column


class _When:
    def __init__(self, chain: _Chain, condition):
        self._chain = chain
        self._condition = condition if chain._subject is None else chain._subject == _value(condition)

    def then(self, value) -> _Chain:
        return _Chain([*self._chain._done, (self._condition, _value(value))], self._chain._subject)


def case_when(condition) -> _When:
    """``case_when(c).then(v).when(c2).then(v2).else_(d)``, or ``.end`` for null."""
    return _Chain([]).when(condition)


def case(subject) -> _Chain:
    """``case(e).when(value).then(result).else_(d)``."""
    return _Chain([], F.col(subject) if isinstance(subject, str) else subject)


def if_(condition, then, otherwise) -> Column:
    return F.when(condition, _value(then)).otherwise(_value(otherwise))


def multi_if() -> _Chain:
    """``multi_if().when(c).then(v).else_(d)``: the first condition that holds decides."""
    return _Chain([])
