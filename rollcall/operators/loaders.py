"""Whole records into tables: votes, events, organisations and jurisdictions by their keys, people and committees with all that hangs on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.operators import people, upsert

COMMITTEES = ("committee", "subcommittee")


@dataclass
class Loaded:
    """``table`` after the load, (id, what) of each arrived record, and what the load asks to remove."""
    table: DataFrame
    outcome: DataFrame
    missing: DataFrame


def load_keyed(stored: DataFrame, arrived: DataFrame, key: Column, columns: list[str], order: list[str], record: str = "_id") -> Loaded:
    """Records matched by a made key (null: ``invalid``): several of a key are ``duplicate`` but for the last in order.

    Stored rows keep their other columns; rows nobody sent stay as they are. ``missing`` are stored rows that weren't sent.
    """
    a = arrived.withColumn("__key", key)
    valid = a.filter("__key is not null")
    last = valid.groupBy("__key").agg(F.max_by(F.struct(record, *columns), F.struct(*order)).alias("r")).select("__key", "r.*")
    s = stored.withColumn("__key", key)
    what = upsert.outcomes(s, last, ["__key"], columns)
    done = last.select("__key", record).join(what, "__key").select(record, "what")
    copies = valid.select(record).join(last.select(record), record, "left_anti").select(record, F.lit("duplicate").alias("what"))
    outcome = done.unionByName(copies).unionByName(a.filter("__key is null").select(record, F.lit("invalid").alias("what")))
    fresh = last.drop("__key")
    kept = s.join(last.select("__key"), "__key", "left_anti")
    return Loaded(kept.drop("__key").unionByName(fresh, allowMissingColumns=True), outcome, kept.drop("__key"))


def vote_key(c: dict[str, Column]) -> Column:
    """De-duplication key, else session, bill and identifier, else what the motion says; without identifier and bill null."""
    some = F.lit("")
    key = upsert.match_key([("dedupe", [c["dedupe_key"]]), ("identifier", [c["session"], F.coalesce(c["bill"].cast("string"), some), c["identifier"]]), ("motion", [c["session"], c["bill"], c["motion"], c["date"], c["organization"]])])
    return F.when(c["identifier"].isNotNull() | c["bill"].isNotNull(), key)


def load_votes(stored: DataFrame, arrived: DataFrame, columns: list[str], order: list[str]) -> Loaded:
    """Votes by ``vote_key``; ``missing`` are stored votes of bills the batch has votes of that it doesn't have: they go."""
    names = ("dedupe_key", "session", "bill", "identifier", "motion", "date", "organization")
    loaded = load_keyed(stored, arrived, vote_key({n: F.col(n) for n in names}), [*names, *columns], order)
    touched = arrived.filter("bill is not null").select("bill").distinct()
    stale = loaded.missing.join(touched, "bill", "left_semi")
    return Loaded(loaded.table.join(stale.select("_id"), "_id", "left_anti"), loaded.outcome, stale)


def load_events(stored: DataFrame, arrived: DataFrame, columns: list[str], order: list[str]) -> Loaded:
    """Events by jurisdiction and de-duplication key or listing; those not sent are flagged deleted, those sent again revived.

    A batch without events changes nothing.
    """
    names = ("jurisdiction", "name", "description", "start", "end", "dedupe_key")
    c = {n: F.col(n) for n in names}
    key = upsert.match_key([("dedupe", [c["jurisdiction"], c["dedupe_key"]]), ("listing", [c["jurisdiction"], c["name"], F.coalesce("description", F.lit("")), c["start"], F.coalesce("end", F.lit(""))])])
    loaded = load_keyed(stored.drop("deleted"), arrived, key, [*names, *columns], order)
    return Loaded(upsert.soft_delete(loaded.table.withColumn("deleted", F.lit(False)), arrived, "_id"), loaded.outcome, loaded.missing)


def jurisdiction_key(division: Column, classification: Column) -> Column:
    return upsert.match_key([("jurisdiction", [division, classification])])


def session_input(sessions: Column) -> Column:
    """Sessions of a jurisdiction as they are merged: without how they were scraped and without extras."""
    return F.transform(sessions, lambda s: s.dropFields("_scraped_name", "extras"))


def organizations_of(jurisdictions: DataFrame, key: str, name: str, unicameral: Column, upper: Column, lower: Column) -> DataFrame:
    """(``key``, name, classification, parent_name): the legislature and, unless it has one chamber, its two chambers below it."""
    made = lambda n, kind, parent: F.struct(n.alias("name"), F.lit(kind).alias("classification"), parent.alias("parent_name"))
    top = made(F.col(name), "legislature", F.lit(None).cast("string"))
    chambers = F.array(made(upper, "upper", F.col(name)), made(lower, "lower", F.col(name)))
    return jurisdictions.select(key, F.inline(F.concat(F.array(top), F.when(unicameral, F.slice(chambers, 1, 0)).otherwise(chambers))))


def stamped(df: DataFrame, jurisdiction: Column, now: Column) -> DataFrame:
    """Scraped records with where they belong and when they were scraped, in UTC."""
    return df.withColumn("jurisdiction", jurisdiction).withColumn("scraped_at", now)


def with_other_name(names: Column, name: Column, note: Column) -> Column:
    """Alternative names (array of struct(name, note)) with one more, unless it is there."""
    given = F.struct(name.alias("name"), note.alias("note"))
    return F.when(F.exists(names, lambda x: x["name"] == name), names).otherwise(F.concat(F.coalesce(names, F.array().cast("array<struct<name:string,note:string>>")), F.array(given)))


def missing_after_sync(stored: DataFrame, loaded: DataFrame, key: str, purge: bool) -> DataFrame:
    """Stored rows the load doesn't have. Without ``purge`` there may be none: the load fails before anything is written."""
    missing = stored.join(loaded.select(key), key, "left_anti")
    if not purge and (n := missing.count()):
        raise ValueError(f"{n} went missing; nothing is loaded without purge")
    return missing


def person_row(docs: DataFrame, today: str) -> DataFrame:
    """People's documents as rows: fields, identifiers in one list, memberships of party and roles, and what is computed from them.

    ``ids`` is a map of scheme to value, ``other_identifiers`` an array of struct(scheme, identifier).
    """
    empty = "array<struct<scheme:string,identifier:string>>"
    ids = F.transform(F.map_entries(F.map_filter("ids", lambda k, v: F.coalesce(v, F.lit("")) != "")), lambda e: F.struct(e["key"].alias("scheme"), e["value"].alias("identifier")))
    member = lambda kind, name, r: F.struct(F.lit(kind).alias("kind"), name.alias("organization"), r["start_date"].alias("start_date"), r["end_date"].alias("end_date"))
    memberships = F.concat(F.transform("party", lambda p: member("party", p["name"], p)), F.transform("roles", lambda r: member("role", r["type"], r)))
    party = people.primary_party(F.col("party"), today)
    return docs.select(*[c for c in docs.columns if c not in ("ids", "other_identifiers", "party", "roles")],
                       F.concat(F.coalesce(ids, F.array().cast(empty)), F.coalesce("other_identifiers", F.array().cast(empty))).alias("identifiers"), memberships.alias("memberships"),
                       party["party"].alias("primary_party"), party["error"].alias("party_error"), people.current_role(F.col("roles"), today).alias("current_role"))


def load_people(stored: DataFrame, docs: DataFrame, columns: list[str], purge: bool = False) -> Loaded:
    """People by id: ``insert``, ``update`` (any field or any list differs) or ``noop``; those not sent are missing and need ``purge``."""
    outcome = upsert.outcomes(stored, docs, ["id"], columns)
    missing = missing_after_sync(stored, docs, "id", purge)
    return Loaded(docs, outcome, missing)


def load_committees(stored: DataFrame, docs: DataFrame, purge: bool = False) -> Loaded:
    """Committees (id, name, parent_name, classification, members) with their parents' ids: ``what`` and ``name_changed`` of each.

    Names are unique under a parent. Parents come first: ``level`` 0 has none, 1 hangs on one of this load or a stored one;
    a parent that isn't there is an error of the row (``orphan``). Members are replaced as a whole if they differ.
    """
    parents = (docs.filter("parent_name is null").select(F.col("name").alias("parent_name"), F.col("id").alias("parent_id"), F.lit(0).alias("at"))
               .unionByName(stored.filter("parent_id is null").select(F.col("name").alias("parent_name"), F.col("id").alias("parent_id"), F.lit(1).alias("at")))
               .groupBy("parent_name").agg(F.min_by("parent_id", F.struct("at", "parent_id")).alias("parent_id")))
    placed = (docs.join(parents, "parent_name", "left").withColumn("level", F.when(F.col("parent_name").isNull(), 0).otherwise(1)).withColumn("orphan", F.col("parent_name").isNotNull() & F.col("parent_id").isNull())
              .withColumn("members", F.array_sort("members")))
    good = placed.filter(~F.col("orphan"))
    what = upsert.outcomes(stored.withColumn("members", F.array_sort("members")), good, ["id"], ["name", "parent_id", "classification", "members"])
    names = stored.select("id", F.col("name").alias("__was"))
    outcome = (placed.join(what, "id", "left").join(names, "id", "left")
               .select("id", "level", F.when(F.col("orphan"), "orphan").otherwise(F.col("what")).alias("what"), F.coalesce(F.col("name") != F.col("__was"), F.lit(False)).alias("name_changed")))
    return Loaded(good.drop("orphan"), outcome, missing_after_sync(stored, docs, "id", purge))


def committee_warnings(committees: DataFrame, members: DataFrame, known: DataFrame) -> DataFrame:
    """(id, warning): committees without a home page link, and members whose names fit nobody known (``name``)."""
    no_page = committees.filter(~F.exists(F.coalesce("links", F.array().cast("array<struct<note:string,url:string>>")), lambda x: F.lower(x["note"]) == "homepage")).select("id", F.lit("no homepage link").alias("warning"))
    unknown = members.join(known.select(F.lower("name").alias("__n")).distinct(), F.lower("member") == F.col("__n"), "left_anti")
    return no_page.unionByName(unknown.select("id", F.concat(F.lit("unknown member "), "member").alias("warning")))


def seats(df: DataFrame, key: str, count: str, named: str, several: str) -> DataFrame:
    """(``key``, district, num_seats) of chambers whose seats are given as a number, a list of names, or a map of name to number."""
    numbered = F.transform(F.sequence(F.lit(1), F.greatest(F.col(count), F.lit(1))), lambda i: F.struct(i.cast("string").alias("district"), F.lit(1).alias("num_seats")))
    listed = F.transform(named, lambda n: F.struct(n.alias("district"), F.lit(1).alias("num_seats")))
    mapped = F.transform(F.map_entries(several), lambda e: F.struct(e["key"].alias("district"), e["value"].cast("int").alias("num_seats")))
    return df.select(key, F.inline(F.when(F.col(several).isNotNull(), mapped).when(F.col(named).isNotNull(), listed).when(F.col(count) > 0, numbered)))
