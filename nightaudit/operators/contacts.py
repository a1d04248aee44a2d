"""Profile contact and identity lookups (package bodies are absent
from the reference; these are the assumed stores and rules).

``name_phone(name_id, phone_role, phone_type, primary_yn, seq, phone_number)``:
``get_phone_no(id, type[, role])`` returns the preferred number of that type
(and role): primary first, then the lowest ``seq``, then the smallest number.

``name_document(name_id, kind, doc_number)``: ``tc_id_number`` is the 'TCKN'
document, ``id_number`` the 'PASSPORT' one; at most one of each per profile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightaudit.operators.lookups import checked, rows_per_key


def _preferred(cond: Column) -> Column:
    rank = F.when(F.col("primary_yn") == "Y", F.lit(0)).otherwise(F.lit(1))
    return F.min(F.when(cond, F.struct(rank.alias("r"), F.col("seq").alias("s"),
                                       F.col("phone_number").alias("n"))))["n"]


def preferred_contact(name_phone: DataFrame, name_document: DataFrame) -> DataFrame:
    """(name_id, id_number, email, mobilephone, _docs_n), one row per profile with any contact; ``with_contacts`` raises
    on the profiles it is asked for that have two documents of a kind.

    email       = get_phone_no(id, 'EMAIL')
    mobilephone = COALESCE(get_phone_no(id, 'MOBILE', 'PHONE'), get_phone_no(id, 'PHONE'))
    id_number   = COALESCE(tc_id_number(id), id_number(id))
    """
    ptype, prole = F.col("phone_type"), F.col("phone_role")
    phones = name_phone.groupBy("name_id").agg(
        _preferred(ptype == "EMAIL").alias("email"),
        F.coalesce(_preferred((ptype == "MOBILE") & (prole == "PHONE")),
                   _preferred(ptype == "PHONE")).alias("mobilephone"))
    docs = rows_per_key(name_document, ["name_id", "kind"], ["doc_number"])
    ids = docs.groupBy("name_id").agg(F.max("_n").alias("_docs_n"),
        F.coalesce(F.max(F.when(F.col("kind") == "TCKN", F.col("doc_number"))),
                   F.max(F.when(F.col("kind") == "PASSPORT", F.col("doc_number")))).alias("id_number"))
    return ids.join(phones, "name_id", "full").select("name_id", "id_number", "email", "mobilephone", "_docs_n")


def with_contacts(fact: DataFrame, name_phone: DataFrame, name_document: DataFrame) -> DataFrame:
    """``fact`` with id_number, email and mobilephone of its name_id."""
    joined = fact.join(preferred_contact(name_phone, name_document), "name_id", "left")
    return checked(joined, "_docs_n", ["id_number"], "name_document", ["name_id"])
