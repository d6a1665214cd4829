"""Numeric expressions: lenient parsing, guarded ratios, spend roles, tax, log scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_number(col, default=None, kind="double") -> Column:
    """Number from text with thousands commas; unreadable text gives ``default``."""
    number = F.regexp_replace(F.trim(_col(col).cast("string")), ",", "").try_cast("double")
    number = F.when(F.isnan(number), None).otherwise(number)
    if kind != "double":
        number = number.try_cast(kind)
    return number if default is None else F.coalesce(number, F.lit(default).cast(kind))


def safe_ratio(num, den, digits=4) -> Column:
    """Ratio rounded to ``digits`` (None: not rounded); 0 when the denominator is not positive."""
    ratio = F.try_divide(_col(num), _col(den))
    return F.when(_col(den) > 0, ratio if digits is None else F.round(ratio, digits)).otherwise(F.lit(0.0))


def ratio_or_null(num, den) -> Column:
    """Unguarded ratio; a zero denominator gives null instead of infinity."""
    return F.try_divide(_col(num), _col(den))


def spend_by_role(df: DataFrame, dept="dept", amount="subtotal", roles=("UTILES", "FOTOCOPIADORA")) -> DataFrame:
    """Line spend split over two named departments and the rest: ``spend_1``, ``spend_2``, ``spend_other``."""
    first, second = (F.upper(F.trim(F.col(dept))) == r for r in roles)
    amount = F.col(amount)
    return df.withColumns(
        {
            "spend_1": F.when(first, amount).otherwise(0.0),
            "spend_2": F.when(second, amount).otherwise(0.0),
            "spend_other": F.when(F.coalesce(first | second, F.lit(False)), 0.0).otherwise(amount),
        }
    )


def dominant_role(a, b, names=("UTILES", "FOTOCOPIADORA")) -> Column:
    """Name of the larger of two spends; a tie goes to the first."""
    return F.when(_col(a) >= _col(b), F.lit(names[0])).otherwise(F.lit(names[1]))


def encode_target(col, mapping=None) -> Column:
    """Class code of a label, null for an unknown label."""
    mapping = mapping or {"YAPE": 1, "EFECTIVO": 0}
    code = F.lit(None).cast("int")
    for label, value in mapping.items():
        code = F.when(_col(col) == label, F.lit(value)).otherwise(code)
    return code


def split_tax(df: DataFrame, total="total", rate=0.18) -> DataFrame:
    """Net amount and tax contained in a tax-included total."""
    net = F.col(total) / F.lit(1.0 + rate)
    return df.withColumns({"net": net, "tax": F.col(total) - net})


def log_scale(col) -> Column:
    return F.log1p(_col(col))


def unlog_scale(col, floor=0.0) -> Column:
    """Inverse of :func:`log_scale`, never below ``floor``."""
    return F.greatest(F.expm1(_col(col)), F.lit(floor))


def rule_payment(df: DataFrame, total="total", hour="hour", dept="dept", copy_dept="FOTOCOPIADORA") -> DataFrame:
    """Payment method by three business rules, with the fixed confidence of each."""
    cash = (F.col(dept) == copy_dept) | (F.col(total) < 8.0)
    large = (F.col(total) > 30.0) | (F.col(hour) >= 18)
    return df.withColumns(
        {
            "pay_rule": F.when(cash, "EFECTIVO").otherwise("YAPE"),
            "confidence": F.when(cash, 0.73).when(large, 0.84).otherwise(0.68),
        }
    )
