"""Text clean-up expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column, functions as F

# Everything str.strip() removes: Unicode white space plus the four ASCII
# separator controls that Java's class leaves out.  (?U) is needed because
# Java's plain \s does not contain U+202F.
_SPACE = r"[\s\x1c-\x1f]"


def strip(col: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.regexp_replace(col, rf"(?U)^{_SPACE}+|{_SPACE}+$", "")


def squeeze(col: Column) -> Column:
    """Collapse runs of any white space to one blank and strip the ends."""
    return F.trim(F.regexp_replace(col, rf"(?U){_SPACE}+", " "))


def clean(col: Column) -> Column:
    """Stripped text, NULL when nothing is left."""
    return F.nullif(strip(col), F.lit(""))


def split_list(col: Column) -> Column:
    """Comma list to trimmed, non-blank elements; NULL gives an empty array."""
    parts = F.transform(F.split(F.coalesce(col, F.lit("")), ","), strip)
    return F.filter(parts, lambda p: F.length(p) > 0)


def fold_ascii(col: Column) -> Column:
    """Case folding of A-Z only: archive lookups do not equate 'É' with 'é'."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)
