"""Taxpayer-id rules (Brazilian CPF), masking and pseudonyms as column expressions.

The CPF check is the public mod-11 rule: the first check digit weighs
digits 1..9 with 10..2, the second weighs digits 1..10 with 11..2; each
check digit is ``(10 * sum) mod 11 mod 10``; ids made of one repeated
digit are invalid. All of it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def _digit(text: Column, pos: int) -> Column:
    return F.substring(text, pos, 1).try_cast("int")


def _check_digit(text: Column, n: int) -> Column:
    total = None
    for i in range(1, n + 1):
        term = _digit(text, i) * F.lit(n + 2 - i)
        total = term if total is None else total + term
    return (total * 10) % 11 % 10


def cpf_is_valid(c) -> Column:
    """True for an 11-digit id whose two check digits match; false otherwise."""
    text = _as_col(c).cast("string")
    well_formed = text.rlike(r"^[0-9]{11}$")
    repeated = text == F.repeat(F.substring(text, 1, 1), 11)
    ok = (
        (_check_digit(text, 9) == _digit(text, 10))
        & (_check_digit(text, 10) == _digit(text, 11))
        & ~repeated
    )
    return F.when(well_formed, ok).otherwise(F.lit(False))


# Stored masked personal ids look like "***066828**": "***", digits 4..9, "**".
MASK_HEAD = "***"
MASK_TAIL = "**"


def mask_tax_id(c) -> Column:
    """Personal ids, of 11 digits however punctuated, become ``***`` + digits 4..9 + ``**``; other ids are kept."""
    text = _as_col(c).cast("string")
    digits = F.regexp_replace(text, "[^0-9]", "")
    masked = F.concat(F.lit(MASK_HEAD), F.substring(digits, 4, 6), F.lit(MASK_TAIL))
    return F.when(F.length(digits) == 11, masked).otherwise(text)


def pseudonym(c, salt: str) -> Column:
    """Salted SHA-256 of the value: stable per subject, not reversible without the salt."""
    return F.sha2(F.concat(F.lit(salt), _as_col(c).cast("string")), 256)
