"""Text cleaning with the rules of sheet cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.schemas import TRUE_WORDS

# Every character Python's str.strip() removes; SQL TRIM alone removes the space only.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(WHITESPACE))


def text_or_null(c: Column | str) -> Column:
    """Stripped text, with blank text as NULL."""
    return F.nullif(strip(c), F.lit(""))


def text_or_empty(c: Column | str) -> Column:
    """Stripped text, with NULL as the empty string."""
    return F.coalesce(strip(c), F.lit(""))


def norm_key(c: Column | str) -> Column:
    """Key form that ignores case and every space."""
    return F.lower(F.replace(col(c), F.lit(" "), F.lit("")))


def is_blank(c: Column | str) -> Column:
    return text_or_empty(c) == ""


def to_bool(c: Column | str) -> Column:
    """True only for the words true, 1, yes and y in any case; NULL is false."""
    return F.coalesce(F.lower(strip(c)).isin(*TRUE_WORDS), F.lit(False))


def enum(c: Column | str) -> Column:
    return F.upper(text_or_empty(c))


def before_dot(c: Column | str) -> Column:
    """Text before the first dot, NULL when there is none."""
    c = col(c)
    return F.when(F.contains(c, F.lit(".")), F.substring_index(c, ".", 1))


def after_dot(c: Column | str) -> Column:
    """Text after the first dot, NULL when there is none."""
    c = col(c)
    at = F.instr(c, ".")
    return F.when(at > 0, F.substr(c, at + F.lit(1)))


def bracketed(items: Column, left: str = "[", right: str = "]") -> Column:
    """Array of names as readable text: ['a', 'b']."""
    inner = F.concat(F.lit("'"), F.array_join(items, "', '"), F.lit("'"))
    return F.concat(F.lit(left), F.when(F.size(items) > 0, inner).otherwise(""), F.lit(right))


def message(template: str, **parts: Column) -> Column:
    """Fill ``{name}`` slots of a fixed text with columns; a NULL part shows as None."""
    out: list[Column] = []
    rest = template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        out += [F.lit(head), F.coalesce(parts[name].cast("string"), F.lit("None"))]
    out.append(F.lit(rest))
    return F.concat(*out)
