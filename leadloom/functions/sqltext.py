"""Column expressions as SQL text that reaches the JVM whole.

A column built call by call costs a round trip to the JVM for each call, and the rules of a lead have some ten thousand: a plan took
longer to build than a small batch to clean. Here the functions used by the rules give text instead, and a rule is one
expression that the session parses when a DataFrame first needs it. A Text is a Column in every other way, so both kinds mix: with a
Column that isn't text, an operation or function falls back to the usual one.

The names are those of pyspark.sql.functions, which also answers for every name not defined here. text_of() gives the text, of
which sql_functions.py makes functions for SQL queries.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import functions as _F
from pyspark.sql.classic.column import Column as _Column

#: How tightly the operation at the top of a text binds.
OR, AND, NOT, COMPARE, SUM, PRODUCT, ATOM = range(7)
_depth = 0


def quoted(value: str) -> str:
    """value as a string literal of SQL, whatever it holds."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(name: str) -> str:
    return name if "`" in name else ".".join(part if part == "*" else f"`{part}`" for part in name.split("."))


def literal(value: object) -> str:
    match value:
        case None:
            return "NULL"
        case bool():
            return str(value).lower()
        case int():
            text = str(value) if -(2**31) < value < 2**31 else f"{value}L"
            return f"({text})" if value < 0 else text
        case float():
            return f"{value!r}D" if value >= 0 else f"({value!r}D)"
        case str():
            return quoted(value)
    raise TypeError(f"no literal: {value!r}")


class Text(_Column):
    """A column that is SQL text until a DataFrame needs it. clean: a value as text.cell() leaves it."""

    def __new__(cls, *_: object, **__: object) -> Text:
        return object.__new__(cls)

    def __init__(self, text: str, binds: int = ATOM, name: str | None = None, clean: bool = False, simple: bool = False) -> None:
        self.text, self.binds, self.name_, self.clean, self.simple = text, binds, name, clean, simple
        self._made = None

    @property
    def _jc(self) -> object:
        if self._made is None:
            made = _F.expr(self.text)
            self._made = (made if self.name_ is None else made.alias(self.name_))._jc
        return self._made

    def inner(self, binds: int) -> str:
        """The text as an operand of something that binds so tightly."""
        return f"({self.text})" if self.binds < binds else self.text

    def __repr__(self) -> str:
        return f"Text<{self.text[:200]}>"

    __hash__ = object.__hash__

    def alias(self, *names: str, **kw: object) -> _Column:
        return Text(self.text, self.binds, names[0]) if len(names) == 1 and not kw else super().alias(*names, **kw)

    def cast(self, kind: object) -> Text:
        return Text(f"CAST({self.text} AS {kind if isinstance(kind, str) else kind.simpleString()})")

    def try_cast(self, kind: object) -> Text:
        return Text(f"TRY_CAST({self.text} AS {kind if isinstance(kind, str) else kind.simpleString()})")

    def isNull(self) -> Text:
        return Text(f"{self.inner(SUM)} IS NULL", COMPARE)

    def isNotNull(self) -> Text:
        return Text(f"{self.inner(SUM)} IS NOT NULL", COMPARE)

    def rlike(self, other: object) -> _Column:
        return _call("rlike", self, literal_text(other))

    def isin(self, *values: object) -> _Column:
        values = tuple(values[0]) if len(values) == 1 and isinstance(values[0], (list, tuple, set, frozenset, dict)) else values
        if not values or any(isinstance(v, _Column) and not isinstance(v, Text) for v in values):
            return super().isin(*values)
        return Text(f"{self.inner(SUM)} IN ({', '.join(literal_text(v).text for v in values)})", COMPARE)

    def between(self, low: object, high: object) -> _Column:
        if any(isinstance(v, _Column) and not isinstance(v, Text) for v in (low, high)):
            return super().between(low, high)
        return Text(f"{self.inner(SUM)} BETWEEN {literal_text(low).inner(SUM)} AND {literal_text(high).inner(SUM)}", COMPARE)

    def __getitem__(self, key: object) -> _Column:
        return Text(f"{self.inner(ATOM)}[{literal(key)}]", simple=self.simple) if isinstance(key, (str, int)) else super().__getitem__(key)

    def __invert__(self) -> Text:
        return Text(f"NOT {self.inner(NOT)}", NOT)

    def __neg__(self) -> Text:
        return Text(f"(- {self.inner(ATOM)})")


def literal_text(value: object) -> _Column:
    return value if isinstance(value, _Column) else Text(literal(value))


def _operation(name: str, sign: str, binds: int, swapped: bool = False) -> None:
    usual = getattr(_Column, name.replace("__r", "__") if swapped else name)

    def work(self: Text, other: object) -> _Column:
        if isinstance(other, _Column) and not isinstance(other, Text):
            return usual(other, self) if swapped else usual(self, other)
        left, right = (literal_text(other), self) if swapped else (self, literal_text(other))
        # comparisons don't chain; all else groups from the left
        return Text(f"{left.inner(binds + (binds == COMPARE))} {sign} {right.inner(binds + 1)}", binds)

    setattr(Text, name, work)


for _sign, _binds, *_names in (("OR", OR, "__or__"), ("OR", OR, "__ror__"), ("AND", AND, "__and__"), ("AND", AND, "__rand__"), ("=", COMPARE, "__eq__"), ("<>", COMPARE, "__ne__"), ("<", COMPARE, "__lt__"), ("<=", COMPARE, "__le__"), (">", COMPARE, "__gt__"), (">=", COMPARE, "__ge__"), ("+", SUM, "__add__"), ("+", SUM, "__radd__"), ("-", SUM, "__sub__"), ("-", SUM, "__rsub__"), ("*", PRODUCT, "__mul__"), ("*", PRODUCT, "__rmul__"), ("/", PRODUCT, "__truediv__"), ("/", PRODUCT, "__rtruediv__"), ("%", PRODUCT, "__mod__"), ("%", PRODUCT, "__rmod__")):
    _operation(_names[0], _sign, _binds, _names[0] in ("__ror__", "__rand__", "__radd__", "__rsub__", "__rmul__", "__rtruediv__", "__rmod__"))


class Case(Text):
    """CASE WHEN ... as it grows."""

    def __init__(self, arms: tuple[tuple[Text, Text], ...]) -> None:
        super().__init__("CASE " + " ".join(f"WHEN {c.text} THEN {v.text}" for c, v in arms) + " END")
        self.arms = arms

    def when(self, condition: _Column, value: object) -> _Column:
        value = literal_text(value)
        return Case((*self.arms, (condition, value))) if isinstance(condition, Text) and isinstance(value, Text) else _Column.when(self, condition, value)

    def otherwise(self, value: object) -> _Column:
        value = literal_text(value)
        return Text(f"{self.text.removesuffix(' END')} ELSE {value.text} END") if isinstance(value, Text) else _Column.otherwise(self, value)


def when(condition: _Column, value: object) -> _Column:
    value = literal_text(value)
    return Case(((condition, value),)) if isinstance(condition, Text) and isinstance(value, Text) else _F.when(condition, value)


def col(name: str) -> Text:
    return Text(_name(name), simple=True)


def lit(value: object) -> _Column:
    if isinstance(value, _Column):
        return value
    return Text(literal(value), simple=True) if isinstance(value, (str, int, float)) or value is None else _F.lit(value)


def expr(text: str) -> Text:
    return Text(text, OR)


def text_of(c: _Column) -> str:
    """The SQL text of a column that is one."""
    if not isinstance(c, Text):
        raise TypeError("the column isn't text: some part of it was built call by call")
    return c.text


#: Functions whose arguments are columns, but for the given places, where strings are literals.
_PLAIN: dict[str, tuple[int, ...]] = {
    name: places
    for places, names in {
        (): "abs array array_compact array_distinct array_except array_intersect array_sort array_union arrays_overlap coalesce concat contains endswith flatten floor get greatest instr least length lower nullif pmod replace sequence size startswith substr trim try_element_at upper xxhash64",
        (0,): "concat_ws format_string",
        (1,): "array_contains array_join array_position array_remove element_at regexp_extract split substring",
        (1, 2): "array_repeat levenshtein regexp_replace substring_index translate",
    }.items()
    for name in names.split()
}


def _as_text(value: object, is_literal: bool) -> _Column:
    if isinstance(value, _Column):
        return value
    return col(value) if isinstance(value, str) and not is_literal else Text(literal(value))


def _call(name: str, *args: _Column) -> _Column:
    if all(isinstance(a, Text) for a in args):
        return Text(f"{name}({', '.join(a.text for a in args)})")
    return _F.call_function(name, *args)


def _plain(name: str, places: tuple[int, ...]) -> Callable[..., _Column]:
    def function(*args: object) -> _Column:
        args = tuple(args[0]) if len(args) == 1 and isinstance(args[0], (list, tuple)) else args
        return _call(name, *(_as_text(a, i in places) for i, a in enumerate(args)))

    function.__name__ = name
    return function


globals().update({name: _plain(name, places) for name, places in _PLAIN.items()})


def regexp_extract_all(c: object, pattern: object, group: object = 1) -> _Column:
    return _call("regexp_extract_all", _as_text(c, False), _as_text(pattern, True), _as_text(group, True))


def struct(*columns: object) -> _Column:
    parts = [_as_text(c, False) for c in columns]
    if not all(isinstance(p, Text) for p in parts):
        return _F.struct(*parts)
    return Text(f"struct({', '.join(p.text if p.name_ is None else f'{p.text} AS `{p.name_}`' for p in parts)})")


def _lambda(f: Callable[..., _Column], clean: bool = False) -> tuple[str, _Column]:
    """The parameters and the body of a lambda. Parameters are named by how deep it stands, so that inner ones don't hide outer ones."""
    global _depth
    _depth += 1
    try:
        n = len(inspect.signature(f).parameters)
        names = [f"v{_depth}{'xyz'[k]}" for k in range(n)]
        body = f(*[Text(x, simple=True, clean=clean) for x in names])
    finally:
        _depth -= 1
    return names[0] if n == 1 else f"({', '.join(names)})", literal_text(body)


def _higher(name: str, columns: list[object], *functions: Callable[..., _Column], clean: bool = False) -> _Column:
    given = [_as_text(c, False) for c in columns]
    made = [_lambda(f, clean) for f in functions] if all(isinstance(c, Text) for c in given) else None
    if made is None or not all(isinstance(body, Text) for _, body in made):
        return getattr(_F, name)(*given, *functions)
    return Text(f"{name}({', '.join([c.text for c in given] + [f'{names} -> {body.text}' for names, body in made])})")


def transform(c: object, f: Callable[..., _Column]) -> _Column:
    return _higher("transform", [c], f)


def filter(c: object, f: Callable[..., _Column]) -> _Column:  # noqa: A001
    return _higher("filter", [c], f)


def exists(c: object, f: Callable[..., _Column]) -> _Column:
    return _higher("exists", [c], f)


def aggregate(c: object, start: object, merge: Callable[..., _Column], finish: Callable[..., _Column] | None = None) -> _Column:
    return _higher("aggregate", [c, start], *(f for f in (merge, finish) if f))


def let(value: _Column, then: Callable[[_Column], _Column]) -> _Column:
    """then(value), with value computed once however often then uses it. What is only named isn't bound again."""
    if isinstance(value, Text) and value.simple:
        return then(value)
    if isinstance(value, Text):
        return _call("get", _higher("transform", [_call("array", value)], lambda v: then(v), clean=value.clean), lit(0))
    return _F.get(_F.transform(_F.array(value), lambda v: then(v)), _F.lit(0))


def __getattr__(name: str) -> object:
    return getattr(_F, name)
