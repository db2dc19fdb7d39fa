"""Text functions used by cleaning and display."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every character that counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def strip_text(value: Column) -> Column:
    """Trim every kind of white space, not only spaces; null stays null."""
    text = value.cast("string")
    # Trimming a custom character set scans the whole value, so only touch padded ones.
    padded = F.substring(text, 1, 1).isin(*WHITE_SPACE) | F.substring(text, -1, 1).isin(*WHITE_SPACE)
    return F.when(padded, F.btrim(text, F.lit(WHITE_SPACE))).otherwise(text)


def snake_case(name: str) -> str:
    """The runs of ASCII letters and digits in lower case, with one underscore between two runs."""
    return "_".join(re.findall("[0-9a-z]+", name.lower()))


def title_case(value: Column) -> Column:
    """Capitalise after every character that is not a letter: ``o'neil`` -> ``O'Neil``."""
    runs = F.regexp_extract_all(value, F.lit(f"[{_CASED}]+|[^{_CASED}]+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def ellipsis(value: Column, limit: int) -> Column:
    head = F.rtrim(F.substring(value, 1, limit - 3), F.lit(WHITE_SPACE))
    return F.when(F.length(value) > limit, F.concat(head, F.lit("..."))).otherwise(value)
