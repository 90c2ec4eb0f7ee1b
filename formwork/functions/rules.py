"""Form rules as column expressions: constraints (F4) and calculated fields.

Rules are parsed once on the driver and turned into native expressions; no Python
runs per row and no formula is ever evaluated with ``eval``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from formwork.functions.coerce import text_to_number

# The rule syntax of the form definitions.
REGEX_RULE = re.compile(r"regex\(.,\s*'(.+)'\)")
LE_PREFIX = ".<="
GE_PREFIX = ".>="


def _col(c: Column | str) -> Column:
    return F.col("`" + c + "`") if isinstance(c, str) else c


# Character classes of the rule language, in the JVM's spelling: letters and numbers of all
# scripts, decimal digits, white space.
_CLASSES = {"w": r"\p{L}\p{N}_", "d": r"\p{Nd}", "s": r"\t-\r\x1c-\x20\x85\p{Z}"}


def _escape(letter: str, in_class: bool) -> str:
    """A backslash and a letter of the rule language."""
    if letter in _CLASSES:
        return _CLASSES[letter] if in_class else f"[{_CLASSES[letter]}]"
    if letter.lower() in _CLASSES:
        return f"[^{_CLASSES[letter.lower()]}]"
    return r"\z" if letter == "Z" and not in_class else "\\" + letter


def _respelt(pattern: str) -> str:
    """The pattern with classes, ends, braces and brackets as the JVM's engine reads
    them; groups are left alone."""
    out, i, in_class = [], 0, -1
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            out.append(_escape(pattern[i + 1], in_class >= 0))
            i += 2
            continue
        if in_class >= 0:
            if c == "]" and i > in_class:
                in_class = -1
            elif c in "[]&":  # plain characters of a class here, operators there
                c = "\\" + c
        elif c == "[":
            in_class = i + (2 if pattern[i + 1 : i + 2] == "^" else 1)
            out.append(pattern[i:in_class])
            i = in_class
            continue
        elif c == "{":
            quantity = re.match(r"\{(\d+,?\d*|,\d*)\}", pattern[i:])
            c = "\\{" if not quantity else "{0" if pattern[i + 1] == "," else c
        out.append(c)
        i += 1
    return "".join(out)


def java_pattern(pattern: str) -> str | None:
    """The pattern for the JVM's engine; None where the rule language or the JVM rejects
    it, which makes every value invalid. Classes take all scripts, only ``\\n`` ends a
    line, and named groups are spelt the JVM's way."""
    try:
        re.compile(pattern)
    except re.error:
        return None
    out = _respelt(pattern)
    out = re.sub(r"\(\?P<(\w+)>", lambda m: "(?<" + m.group(1).replace("_", "") + ">", out)
    out = "(?du)" + re.sub(r"\(\?P=(\w+)\)", lambda m: "\\k<" + m.group(1).replace("_", "") + ">", out)
    sc = SparkContext._active_spark_context
    if sc is not None:
        try:
            sc._jvm.java.util.regex.Pattern.compile(out)
        except Py4JJavaError:
            return None
    return out


@dataclass(frozen=True)
class Check:
    """A constraint rule taken apart: ``kind`` is ``regex`` (with the JVM's pattern),
    ``at_most``, ``at_least`` (with a bound), ``present`` or ``never``."""

    kind: str
    pattern: str | None = None
    bound: float | None = None


def parse_constraint(rule: str) -> Check:
    """F4 on the driver: the check that a rule text stands for."""
    m = REGEX_RULE.search(rule) if rule.startswith("regex") else None
    if m:
        pattern = java_pattern(m.group(1))
        return Check("never") if pattern is None else Check("regex", pattern=rf"\A(?:{pattern})")
    if rule.startswith((LE_PREFIX, GE_PREFIX)):
        try:
            return Check("at_most" if rule.startswith(LE_PREFIX) else "at_least", bound=float(rule[3:]))
        except ValueError:
            return Check("never")
    return Check("present")


def as_number(c: Column, data_type=None) -> Column:
    """The value that numeric rules compare; NaN and text that is no number give null."""
    value = c.cast("double") if isinstance(data_type, NumericType) else text_to_number(c if isinstance(data_type, StringType) else c.cast("string"), "double", StringType())
    return F.nanvl(value, F.lit(None).cast("double"))


def check_constraint(c: Column | str, rule: str, data_type=None) -> Column:
    """validity of a value under a rule, never null (null value -> false, D-6).

    - ``regex(., 'p')``: the pattern must match at the start of the text (``re.match``).
    - ``.<=n`` / ``.>=n``: numeric comparison; a value that is no number (NaN included)
      or an unparsable threshold gives false.
    - anything else: true.
    """
    col = _col(c)
    check = parse_constraint(rule)
    if check.kind == "regex":
        result = (col if isinstance(data_type, StringType) else col.cast("string")).rlike(check.pattern)
    elif check.kind == "never":
        return F.lit(False)
    elif check.kind == "present":
        result = col.isNotNull()
    else:
        value = as_number(col, data_type)
        result = value <= F.lit(check.bound) if check.kind == "at_most" else value >= F.lit(check.bound)
    return F.coalesce(result, F.lit(False))


# ---------------------------------------------------------------------------
# calculated fields
# ---------------------------------------------------------------------------

_TOKEN = re.compile(
    r"\s*(?:(?P<field>\$\{[^}]+\})|(?P<num>\d+(?:\.\d+)?)|(?P<name>[A-Za-z_][A-Za-z_0-9]*)|(?P<op>[-+*(),]))"
)

# The formula constructs that are translated.
FUNCTIONS = ("round", "abs", "coalesce")


def round_half_up(c: Column) -> Column:
    """Round a double to an integer value, ties away from zero: the same result as
    ``round(c, 0)`` (which goes through a decimal per value) for every double, computed
    with ``rint`` and a test for an exact .5 fraction."""
    whole = F.when(c >= 0, F.floor(c)).otherwise(F.ceil(c)).cast("double")
    return F.when(F.abs(c - whole) == 0.5, whole + F.signum(c)).otherwise(F.rint(c))


class FormulaError(ValueError):
    """The formula uses a construct outside the supported grammar."""


def _tokens(formula: str) -> list[tuple[str, str]]:
    pos, out = 0, []
    text = formula.rstrip()
    while pos < len(text):
        m = _TOKEN.match(text, pos)
        if not m or m.end() == pos:
            raise FormulaError(f"unexpected text at {pos}: {text[pos:pos + 12]!r}")
        kind = m.lastgroup
        out.append((kind, m.group(kind)))
        pos = m.end()
    return out


class _Parser:
    """expr := term (('+'|'-') term)* ; term := unary (('*'|'div') unary)* ;
    unary := '-' unary | atom ; atom := number | ${field} | func '(' args ')' | '(' expr ')'"""

    def __init__(self, tokens: list[tuple[str, str]], columns: set[str] | dict):
        self.t, self.i, self.columns = tokens, 0, set(columns)
        self.types = columns if isinstance(columns, dict) else {}

    def peek(self) -> tuple[str, str] | None:
        return self.t[self.i] if self.i < len(self.t) else None

    def take(self, value: str | None = None) -> tuple[str, str]:
        tok = self.peek()
        if tok is None or (value is not None and tok[1] != value):
            raise FormulaError(f"expected {value or 'a token'}, got {tok}")
        self.i += 1
        return tok

    def expr(self) -> Column:
        left = self.term()
        while self.peek() and self.peek()[1] in "+-" and self.peek()[0] == "op":
            op = self.take()[1]
            right = self.term()
            left = left + right if op == "+" else left - right
        return left

    def term(self) -> Column:
        left = self.unary()
        while self.peek() and (self.peek()[1] == "*" or self.peek() == ("name", "div")):
            op = self.take()[1]
            right = self.unary()
            left = left * right if op == "*" else F.try_divide(left, right)
        return left

    def unary(self) -> Column:
        if self.peek() == ("op", "-"):
            self.take()
            return -self.unary()
        return self.atom()

    def atom(self) -> Column:
        kind, value = self.take()
        if kind == "num":
            return F.lit(float(value))
        if kind == "field":
            name = value[2:-1].strip()
            if name not in self.columns:
                raise FormulaError(f"field {name!r} is not a column")
            return text_to_number(F.col("`" + name + "`"), "double", self.types.get(name))
        if value == "(":
            inner = self.expr()
            self.take(")")
            return inner
        if kind == "name" and value in FUNCTIONS:
            self.take("(")
            if value == "round":
                arg = self.expr()
                digits = 0
                if self.peek() == ("op", ","):
                    self.take()
                    kind, num = self.take()
                    if kind != "num" or "." in num:
                        raise FormulaError("round() digits must be an integer literal")
                    digits = int(num)
                self.take(")")
                return round_half_up(arg) if digits == 0 else F.round(arg, digits)
            args = [self.expr()]
            while self.peek() == ("op", ","):
                self.take()
                args.append(self.expr())
            self.take(")")
            if value == "abs":
                return F.abs(args[0]) if len(args) == 1 else self._bad(value)
            return F.coalesce(*args)
        raise FormulaError(f"unsupported token {value!r}")

    def _bad(self, fn: str) -> Column:
        raise FormulaError(f"wrong number of arguments for {fn}")


def formula_column(formula: str, columns: set[str] | dict) -> Column:
    """Translate a formula to a double-valued column; raises ``FormulaError``.
    ``columns`` is a name -> Spark type dict (numeric fields are used as they are), or
    a set of names (every field is then treated as text and parsed)."""
    text = formula.strip()
    if text in ("0", "0.0"):
        return F.lit(0.0)
    parser = _Parser(_tokens(text), columns)
    out = parser.expr()
    if parser.peek() is not None:
        raise FormulaError(f"trailing tokens from {parser.peek()}")
    return out


def calculate(formula: str, columns: set[str] | dict) -> tuple[Column, str | None]:
    """(column, problem). The value is rounded half up and cast to bigint; a
    formula outside the grammar gives the constant 0 and a problem text (D-18).
    Division by zero and values that no integer holds (nan, inf) give null for that row."""
    try:
        return round_half_up(formula_column(formula, columns)).try_cast("bigint"), None
    except FormulaError as exc:
        return F.lit(0).cast("bigint"), str(exc)
