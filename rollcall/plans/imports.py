"""The import of one batch of documents: checked, de-duplicated, resolved, merged, derived - one lazy plan per result."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions import text as T
from rollcall.functions.ids import canonical_hash, read_pseudo_id
from rollcall.operators import resolve, rollup, upsert
from rollcall.sources.schemas import document_problems

#: Transformers by kind and field; callers may put in their own.
TRANSFORMERS = {"bill": {"identifier": T.fix_bill_id, "title": [T.collapse_whitespace, T.truncate], "related_bills": {"identifier": T.fix_bill_id}}, "event": {"name": [T.collapse_whitespace, T.truncate]}}


@dataclass
class Imported:
    """``table`` after the import, ``outcome`` of each document (insert, update, noop, duplicate, invalid, unresolved), and derived columns."""
    table: DataFrame
    outcome: DataFrame
    derived: DataFrame


def transformed(docs: DataFrame, kind: str) -> DataFrame:
    tree = TRANSFORMERS.get(kind, {})
    return docs.withColumns({f.name: T.apply_tree(F.col(f.name), f.dataType, tree[f.name]) for f in docs.schema.fields if f.name in tree})


def duplicates(docs: DataFrame, arrival: str, without: tuple[str, ...] = ("_id",)) -> DataFrame:
    """(_id, kept_id): documents equal in everything but their id, kept by arrival."""
    content = canonical_hash(*[F.col(c) for c in docs.columns if c not in (*without, arrival)])
    keyed = docs.select("_id", F.col(arrival).alias("__at"), content.alias("__h"))
    first = keyed.groupBy("__h").agg(F.min_by("_id", F.struct("__at", "_id")).alias("kept_id"))
    return keyed.join(first, "__h").select("_id", "kept_id")


def import_bills(docs: DataFrame, stored: DataFrame, sessions: DataFrame, organizations: DataFrame, jurisdiction: str, arrival: str = "arrival") -> Imported:
    """Bills of one jurisdiction merged into ``stored`` (session_id, identifier, content, ...).

    ``sessions`` (session_id, legislative_session, jurisdiction_id) and ``organizations`` (organization_id,
    classification, jurisdiction_id) resolve the references. Documents with problems or references that can't be resolved
    are left out and said so; a document sent twice is a duplicate; a batch sent again is all ``noop``.
    """
    checked = docs.withColumn("__problems", document_problems("bill"))
    good = transformed(checked.filter(F.size("__problems") == 0).drop("__problems"), "bill")
    copies = duplicates(good, arrival)
    unique = good.join(copies.filter("_id = kept_id").select("_id"), "_id", "left_semi")
    own_sessions = sessions.filter(F.col("jurisdiction_id") == jurisdiction).select("legislative_session", "session_id")
    with_session = resolve.resolve_unique(unique, own_sessions, ["legislative_session"], "session_id", "__session").withColumnRenamed("status", "__s1")
    spec = read_pseudo_id(F.col("from_organization"))
    own_orgs = organizations.filter(F.col("jurisdiction_id") == jurisdiction).select(F.col("classification").alias("__class"), "organization_id")
    with_org = resolve.resolve_unique(with_session.withColumn("__class", F.coalesce(spec["classification"], F.lit("legislature"))), own_orgs, ["__class"], "organization_id", "__org").withColumnRenamed("status", "__s2")
    usable = (F.col("__s1") == "resolved") & (F.col("__s2") == "resolved")
    fields = ["title", "classification", "subject", "actions", "sponsorships", "versions", "documents", "sources", "related_bills", "extras"]
    arrived = with_org.filter(usable).select("_id", F.col("__session").alias("session_id"), "identifier", F.col("__org").alias("organization_id"), *fields)
    key, columns = ["session_id", "identifier"], ["organization_id", *fields]
    what = upsert.outcomes(stored, arrived, key, columns, ["_id"])
    done = arrived.select("_id", *key).join(what, key).select("_id", "what")
    outcome = (done.unionByName(with_org.filter(~usable).select("_id", F.lit("unresolved").alias("what")))
               .unionByName(copies.filter("_id <> kept_id").select("_id", F.lit("duplicate").alias("what")))
               .unionByName(checked.filter(F.size("__problems") > 0).select("_id", F.lit("invalid").alias("what"))))
    table = upsert.merged(stored, arrived, key, ["_id"])
    actions = table.select(*key, F.posexplode_outer("actions").alias("order", "a")).select(F.struct(*key).alias("bill"), F.coalesce("order", F.lit(0)).alias("order"), "a.description", "a.date", "a.classification")
    derived = rollup.action_rollup(actions, "bill", "order", "date", "description", "classification").select("bill.*", "first_action_date", "latest_action_date", "latest_action_description", "latest_passage_date")
    return Imported(table, outcome, derived)


def import_votes_keys(session: Column, bill: Column, identifier: Column, motion: Column, date: Column, organization: Column, dedupe_key: Column) -> Column:
    """What a vote is matched by: its de-duplication key, else session, bill and identifier, else what the motion says."""
    return upsert.match_key([("dedupe", [dedupe_key]), ("identifier", [session, bill, identifier]), ("motion", [session, bill, motion, date, organization])])


def import_events_keys(jurisdiction: Column, name: Column, description: Column, start: Column, end: Column, dedupe_key: Column) -> Column:
    return upsert.match_key([("dedupe", [jurisdiction, dedupe_key]), ("listing", [jurisdiction, name, description, start, end])])
