"""Text normalisation with built-in functions only."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def _unaccent_table() -> tuple[str, str]:
    """Letters of the Latin, Greek and Cyrillic blocks that decompose to one base letter, and those letters."""
    accented, plain = [], []
    for code in [*range(0x00A0, 0x0530), *range(0x1E00, 0x2000), *range(0xFF01, 0xFF5F)]:
        base = [c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)]
        if len(base) == 1 and base[0] != chr(code):
            accented.append(chr(code))
            plain.append(base[0])
    return "".join(accented), "".join(plain)


def normalize_text(col) -> Column:
    """Comparable text: null to empty, no accents, single spaces, trimmed, upper case.

    Letters that decompose into several (ligatures) keep their form.
    """
    accented, plain = _unaccent_table()
    text = F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
    text = F.regexp_replace(F.translate(text, accented, plain), r"\p{M}", "")
    return F.upper(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


def normalize_id(col) -> Column:
    """Normalised id without the ``.0`` that a float export leaves behind."""
    return F.regexp_replace(normalize_text(col), r"\.0$", "")


def payment_label(col, style="upper") -> Column:
    """Trimmed payment label: ``upper`` for clean tables, ``capital`` for raw ones."""
    text = F.trim(F.col(col) if isinstance(col, str) else col)
    if style == "upper":
        return F.upper(text)
    if style == "capital":
        return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substr(text, F.lit(2))))
    raise ValueError("style must be 'upper' or 'capital'")
