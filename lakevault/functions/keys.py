"""Hash keys for hubs and links, and the hashdiff that detects attribute change."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def hash_key(business_key, algo: str = "md5") -> Column:
    """Lowercase hex digest of the key's decimal/text form; null key -> null.

    ``md5`` is what the stored tables use; ``sha256`` is the documented option.
    """
    text = _as_col(business_key).cast("string")
    if algo == "md5":
        return F.md5(text)
    if algo == "sha256":
        return F.sha2(text, 256)
    raise ValueError(f"unknown hash algorithm {algo!r}")


def tuple_text(*values) -> Column:
    """One text for a tuple of values, different for different tuples.

    Every value is written as ``<length>:<text>``, a null as ``-``, joined by ``|``:
    separators inside values, and nulls in other places, cannot be confused.
    """
    texts = [_as_col(v).cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.concat_ws("|", *parts)


def link_key(*business_keys, algo: str = "md5") -> Column:
    """Hash of several business keys (``tuple_text``); null if any key is null."""
    joined = F.when(_all_known(business_keys), tuple_text(*business_keys))
    return F.md5(joined) if algo == "md5" else F.sha2(joined, 256)


def _all_known(keys) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & _as_col(k).isNotNull()
    return known


def hashdiff(*attrs) -> Column:
    """Digest of the attribute tuple; ("a", null) and (null, "a") stay different.

    ``to_json`` with ``ignoreNullFields=false`` writes every field by name,
    so a null in one position never collides with a value in another.
    """
    payload = F.to_json(F.struct(*[_as_col(a) for a in attrs]), {"ignoreNullFields": "false"})
    return F.sha2(payload, 256)
