"""Privacy and access: row-level entitlements, erasure, consent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.operators.history import latest_per_key
from lakevault.sources.versioned import VersionedTable


def build_grants(explicit: DataFrame, scopes: DataFrame, scope: str, see_all: list[str],
                 user: str = "usuario") -> DataFrame:
    """Entitlements as explicit (user, scope) rows.

    ``explicit`` holds (user, scope) grants; every name in ``see_all`` (for
    example an auditor) is granted each scope listed in ``scopes``. The result
    is policy-sized (users x scopes), so the filter below is a plain equi-join.
    """
    grants = explicit.select(user, scope)
    for name in see_all:
        grants = grants.unionByName(scopes.select(F.lit(name).alias(user), F.col(scope)))
    return grants.distinct()


def row_level_filter(df: DataFrame, grants: DataFrame, scope: str, user: str, name: str) -> DataFrame:
    """The rows that user ``name`` may see: those whose ``scope`` is granted (a semi join)."""
    return df.join(grants.where(F.col(user) == name).select(scope), scope, "left_semi")


def forget_subjects(table: VersionedTable, requests: DataFrame, key: str) -> None:
    """Remove every row of the requested subjects from every stored load; call again after a failure."""
    table.erase(requests, key)


# ------------------------------------------------------------------ erasure by key
def issue_keys(keys: VersionedTable, subjects: DataFrame, subject: str, secret: str, load_id: str | None = None) -> None:
    """Give every subject that has none a data key of its own, in the key table.

    A key is the SHA-256 of two AES-GCM encryptions of the subject under ``secret`` (kept
    outside the lake): their random initialisation vectors, 96 bits each from the system's secure
    source, make it new every time, and the secret keeps it from anyone who guesses them.
    """
    new = subjects.where(F.col(subject).isNotNull()).select(subject).distinct()
    if keys.exists():
        new = new.join(keys.read().select(subject), subject, "left_anti")
    text, master = F.col(subject).cast("string"), F.unhex(F.sha2(F.lit(secret), 256))
    first, second = (F.aes_encrypt(F.concat(F.lit(salt), text), master, F.lit("GCM")) for salt in ("1:", "2:"))
    keys.write(new.withColumn("data_key", F.unhex(F.sha2(F.concat(first, second), 256))), load_id=load_id, keep_empty=False)


def seal(df: DataFrame, keys: VersionedTable, subject: str, attributes: list[str]) -> DataFrame:
    """``df`` with the attributes as one encrypted column, ``sealed``; a row without a subject key fails the job.

    The subject itself is authenticated with the data, so a sealed value cannot be moved to another
    subject's row.
    """
    joined = df.join(keys.read().select(subject, "data_key"), subject, "left")
    told = F.raise_error(F.concat(F.lit("no data key for subject "), F.coalesce(F.col(subject).cast("string"), F.lit("null"))))
    key = F.coalesce("data_key", told.cast("binary"))
    body = F.to_json(F.struct(*attributes), {"ignoreNullFields": "false"})
    sealed = F.call_function("aes_encrypt", body, key, F.lit("GCM"), F.lit("DEFAULT"), F.lit(b""), F.col(subject).cast("string"))
    return joined.withColumn("sealed", sealed).drop("data_key", *attributes)


def unseal(df: DataFrame, keys: VersionedTable, subject: str, schema: str) -> DataFrame:
    """``df`` with the attributes (``schema``) in place of ``sealed``; null for subjects whose key is gone."""
    joined = df.join(keys.read().select(subject, "data_key"), subject, "left")
    opened = F.call_function("try_aes_decrypt", F.col("sealed"), F.col("data_key"), F.lit("GCM"), F.lit("DEFAULT"), F.col(subject).cast("string"))
    body = F.from_json(opened.cast("string"), schema)
    return joined.withColumn("_body", body).drop("sealed", "data_key").select(*[c for c in df.columns if c != "sealed"], "_body.*")


def forget_keys(keys: VersionedTable, requests: DataFrame, subject: str) -> None:
    """Erase the subjects' keys, from every load of the key table: what they sealed, wherever it was copied, is unreadable.

    The work is in the size of the key table, however much was sealed. Keys are not given out again for a
    subject that is erased unless ``issue_keys`` meets it anew, and then another one.
    """
    keys.erase(requests, subject)


def consenting(events: DataFrame, key: str, kind: str, order, grant: str, revoke: str) -> DataFrame:
    """Subjects whose last grant/revoke event is a grant."""
    last = latest_per_key(events.where(F.col(kind).isin(grant, revoke)).select(key, kind, *order), [key], order)
    return last.where(F.col(kind) == grant).select(key)


def consent_filter(df: DataFrame, consent: DataFrame, key: str) -> DataFrame:
    """Rows of subjects with consent (semi join)."""
    return df.join(consent, key, "left_semi")
