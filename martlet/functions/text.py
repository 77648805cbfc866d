"""Text cleaning as native Column expressions (no UDF).

The cleaning rules follow Python's ``str.strip`` / ``str.lower`` /
``str.title``, which differ from Spark's ``trim`` and ``initcap``:

* ``trim`` removes only U+0020, while Python strips every character for
  which ``str.isspace()`` is true.
* ``initcap`` capitalises only after whitespace, while Python capitalises
  every cased letter that follows a character that is not cased
  (``t-shirt`` -> ``T-Shirt``, ``3d`` -> ``3D``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts
# (tab, LF, VT, FF, CR, U+001C-U+001F, space, U+0085, U+00A0, U+1680,
# U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000), as a Java class.
PY_SPACE_CLASS = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x85\xA0\u1680\u2000-\u200A"
    r"\u2028\u2029\u202F\u205F\u3000]"
)
_STRIP_PATTERN = rf"^{PY_SPACE_CLASS}+|{PY_SPACE_CLASS}+\z"

# A letter is "cased" for Python if it is upper-, lower- or title-case.
_CASED = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"
# Zero-width split point: a cased letter that follows an uncased character.
_WORD_START = rf"(?<=[^{_CASED}])(?=[{_CASED}])"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col: Column | str) -> Column:
    """``str.strip()``: remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(_c(col), _STRIP_PATTERN, "")


def py_lower(col: Column | str) -> Column:
    return F.lower(_c(col))


def py_title(col: Column | str) -> Column:
    """``str.title()``: upper-case the first cased letter of every run of
    cased letters, lower-case the rest."""
    pieces = F.split(F.lower(_c(col)), _WORD_START)
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)),
                                               F.substring(p, 2, 1 << 30))),
        "",
    )


def blank_to_null(col: Column | str) -> Column:
    """Empty string -> NULL (applied after stripping)."""
    return F.nullif(_c(col), F.lit(""))


def strip_lower(col: Column | str) -> Column:
    return py_lower(py_strip(col))


def strip_title(col: Column | str) -> Column:
    return py_title(py_strip(col))
