"""Column expressions: hash keys, tolerant casts, identity-number rules, labels."""

from lakevault.functions.keys import hash_key, hashdiff, link_key, tuple_text
from lakevault.functions.casts import nested_text_failed, parse_date_text, parse_nested_text, tolerant_double
from lakevault.functions.identity import (
    cpf_is_valid,
    mask_tax_id,
    pseudonym,
)
from lakevault.functions.formatting import currency_label

__all__ = [
    "hash_key",
    "hashdiff",
    "link_key",
    "tuple_text",
    "tolerant_double",
    "parse_date_text",
    "parse_nested_text",
    "nested_text_failed",
    "cpf_is_valid",
    "mask_tax_id",
    "pseudonym",
    "currency_label",
]
