"""Text rules of the cleaning stage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space; the separators 0x1C-0x1F count as blank too.
BLANK = r"\s\x1c-\x1f"
LETTER = r"\p{Lu}\p{Ll}\p{Lt}"
EMAIL = rf"(?dU)^[^@{BLANK}]+@[^@{BLANK}]+\.[^@{BLANK}]+$"


def title_case(text: Column) -> Column:
    """Trim, collapse blanks, and capitalise each run of letters (``3d`` -> ``3D``)."""
    collapsed = F.trim(F.regexp_replace(text, rf"(?U)[{BLANK}]+", " "))
    runs = F.split(F.lower(collapsed), rf"(?<=[^{LETTER}])(?=[{LETTER}])")
    return F.array_join(F.transform(runs, F.initcap), "")


def is_valid_email(email: Column) -> Column:
    """True for ``name@host.tld`` without blanks; NULL is not a valid address."""
    return F.coalesce(email.rlike(EMAIL), F.lit(False))
