"""Fixed-point number text that renders identically on any SQL engine."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_FIELD = re.compile(r"\{(\w+)\}")


def _pieces(template: str):
    """(is_field, text) pieces of a ``{name}`` template, in order."""
    pos = 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            yield False, template[pos:m.start()]
        yield True, m.group(1)
        pos = m.end()
    if pos < len(template):
        yield False, template[pos:]


def render(template: str, values: Mapping[str, Column]) -> Column:
    """A text column from a template; every field must be given (and non-null)."""
    return F.concat(*[values[t] if is_field else F.lit(t) for is_field, t in _pieces(template)])


def render_sql(template: str, values: Mapping[str, str]) -> str:
    """The same template as a SQL string expression (newlines as chr(10))."""
    parts = []
    for is_field, t in _pieces(template):
        if is_field:
            parts.append(f"({values[t]})")
            continue
        lines = t.split("\n")
        for i, line in enumerate(lines):
            if i:
                parts.append("chr(10)")
            if line:
                parts.append("'" + line.replace("'", "''") + "'")
    return "(" + " || ".join(parts) + ")"


def fixed(x: Column, digits: int) -> Column:
    """``x`` with exactly ``digits`` decimals (half away from zero), via a whole number's digits."""
    t = F.round(x * F.lit(float(10**digits))).cast("bigint")
    if digits == 0:
        return t.cast("string")
    text = F.abs(t).cast("string")
    text = F.when(F.length(text) > digits, text).otherwise(F.lpad(text, digits + 1, "0"))
    whole = F.substring(text, F.lit(1), F.length(text) - digits)
    return F.concat(F.when(t < 0, "-").otherwise(""), whole, F.lit("."), F.right(text, F.lit(digits)))
