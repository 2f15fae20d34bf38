"""Casts that turn malformed text into null instead of failing the job (ANSI is on)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def tolerant_double(c) -> Column:
    """``try_cast(c as double)``: bad text -> null; surrounding blanks are accepted."""
    return _as_col(c).try_cast("double")


def parse_date_text(c, pattern: str = "dd/MM/yyyy") -> Column:
    """Date text such as ``01/03/2024`` -> DATE 2024-03-01; anything else -> null."""
    return F.to_date(F.try_to_timestamp(_as_col(c), F.lit(pattern)))


# a quoted string, or a bare word of the literal
_TOKEN = r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|\b{word}\b"""


def parse_nested_text(c, ddl: str) -> Column:
    """Nested literal text (``[{'k': 1}]``, single quotes, ``None``, ``True``, ``False``) -> typed value; else null."""
    text = _as_col(c)
    for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):  # outside quoted strings only
        text = F.regexp_replace(text, _TOKEN.format(word=word), "$1" + json_word + "\u0000")
        # a quoted string was matched whole: take the word back that was put behind it
        text = F.regexp_replace(text, r"(['\"])" + json_word + "\u0000", "$1")
        text = F.regexp_replace(text, "\u0000", "")
    return F.from_json(text, ddl, {"allowSingleQuotes": "true"})


def nested_text_failed(c, ddl: str) -> Column:
    """True where a text is there but does not parse."""
    return _as_col(c).isNotNull() & parse_nested_text(c, ddl).isNull()


def literal(value, data_type: T.DataType) -> Column:
    """A collected value as a literal of its column's type.

    A TIMESTAMP_NTZ comes to Python as a naive datetime, of which ``lit`` makes an instant of the
    session's time zone; it goes by its text instead.
    """
    if isinstance(data_type, T.TimestampNTZType) and value is not None:
        return F.lit(value.isoformat(" ")).cast(data_type)
    return F.lit(value).cast(data_type)
