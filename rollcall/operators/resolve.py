"""Resolution of references to stable ids, each with a status: resolved, unresolved or ambiguous."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.operators.intervals import holds, overlaps


def status_of(n: Column) -> Column:
    return F.when(n == 1, "resolved").when(n > 1, "ambiguous").otherwise("unresolved")


def resolve_unique(refs: DataFrame, targets: DataFrame, on: list[str], target_id: str, out: str = "resolved_id") -> DataFrame:
    """References whose key fits exactly one target; targets are reduced to one row a key before the join."""
    found = targets.groupBy(*on).agg(F.count_distinct(target_id).alias("__n"), F.min(target_id).alias(out))
    joined = refs.join(found, on, "left")
    n = F.coalesce("__n", F.lit(0))
    return joined.withColumn("status", status_of(n)).withColumn(out, F.when(n == 1, F.col(out))).drop("__n")


def names_of(people: DataFrame, person_id: str, single: list[str], arrays: list[str], scope: list[str] | None = None) -> DataFrame:
    """(scope, key, id): every name a person can be found by, in lower case."""
    scope = scope or []
    parts = [people.select(*scope, F.lower(F.trim(F.col(c))).alias("key"), person_id) for c in single]
    parts += [people.select(*scope, F.explode(F.transform(a, lambda x: F.lower(F.trim(x["name"])))).alias("key"), person_id) for a in arrays]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter("key <> ''").distinct()


def resolve_by_names(refs: DataFrame, name: str, people: DataFrame, person_id: str, keys: DataFrame, scope: list[str] | None = None, current: str | None = None,
                     window: tuple[Column, Column, Column, Column] | None = None, identifier: str | None = None, identifiers: DataFrame | None = None) -> DataFrame:
    """References by name (any name of ``keys``), an identifier first if there is one, with interval overlap and tie-break.

    ``window`` = (member start, member end, session start, session end; columns of ``people`` or literals) keeps only people who can have served;
    of several people left the only one with ``current`` (a boolean column of ``people``) is taken. An identifier that fits
    nobody or several falls through to names. Branches are unioned equi joins, never an OR of conditions.
    """
    scope = scope or []
    key = F.coalesce(F.lower(F.trim(F.regexp_replace(F.col(name), r"(?U)\s+", " "))), F.lit(""))
    ident = F.coalesce(F.col(identifier).cast("string"), F.lit("")) if identifier else F.lit("")
    tagged = refs.withColumn("__key", key).withColumn("__ident", ident)
    ref = [*scope, "__key", "__ident"]
    wanted = tagged.select(*ref).distinct()  # a name that a third of the rows hold is resolved once
    attributes = people.drop(*scope)

    def pick(matches: DataFrame) -> DataFrame:
        m = matches.select(*ref, person_id).distinct().join(attributes, person_id)
        if window:
            m = m.filter(overlaps(*window))
        live = F.when(F.col(current), F.col(person_id)) if current else F.lit(None)
        g = m.groupBy(*ref).agg(F.count_distinct(person_id).alias("__n"), F.min(person_id).alias("__one"), F.count_distinct(live).alias("__n_live"), F.min(live).alias("__live"))
        return g.select(*ref, "__n", F.when(F.col("__n") == 1, F.col("__one")).when(F.col("__n_live") == 1, F.col("__live")).alias("__found"))

    found = wanted.join(pick(wanted.join(keys.withColumnRenamed("key", "__key"), [*scope, "__key"])), ref, "left")
    if identifier and identifiers is not None:
        by_id = pick(wanted.join(identifiers.withColumnRenamed("identifier", "__ident"), [*scope, "__ident"])).select(*ref, F.col("__found").alias("__by_id"))
        found = found.join(by_id, ref, "left").withColumn("__found", F.coalesce("__by_id", "__found")).drop("__by_id")
    out = tagged.join(found, ref, "left")
    n = F.coalesce("__n", F.lit(0))
    status = F.when(F.col("__found").isNotNull(), "resolved").when(n > 1, "ambiguous").otherwise("unresolved")
    return out.withColumn("status", status).withColumnRenamed("__found", "resolved_id").drop("__key", "__ident", "__n")


def resolve_person(refs: DataFrame, people: DataFrame, memberships: DataFrame, person_id: str, names: tuple[list[str], list[str]], scope: list[str], chambers: tuple[str, ...] = ("upper", "lower", "legislature")) -> DataFrame:
    """``refs`` (scope, name, identifier, chamber, start, end; the last three come back with nulls as the empty text) with ``resolved_id`` and ``status``.

    ``people`` has the id, ``current_role`` (null: none), the columns of ``names`` (plain ones, arrays of struct(name)) and
    ``identifiers`` (array of text); ``memberships`` has the scope, the id, ``classification``, ``start_date`` and ``end_date``. A person
    counts if one and the same membership is of the chamber asked for (any of ``chambers`` if none is) and hadn't ended before
    the session's start nor begun after its end, open and unknown ends counting as such. An identifier that fits one such person decides;
    otherwise names do, whatever their case. Of several people the only one with a current role is taken.
    """
    key = F.coalesce(F.lower(F.trim(F.regexp_replace(F.col("name"), r"(?U)\s+", " "))), F.lit(""))
    asked = refs.withColumn("__key", key).withColumn("__ident", F.coalesce("identifier", F.lit("")))
    ref = [*scope, "__key", "__ident", "chamber", "start", "end"]
    wanted = asked.select(*ref).distinct()  # a name that a third of the rows hold is resolved once
    seats = memberships.select(*scope, person_id, F.col("classification").alias("__c"), F.coalesce("start_date", F.lit("")).alias("__s"), F.coalesce("end_date", F.lit("")).alias("__e"))
    serving = (F.when(F.coalesce("chamber", F.lit("")) != "", F.col("__c") == F.col("chamber")).otherwise(F.col("__c").isin(*chambers))
               & ((F.coalesce("start", F.lit("")) == "") | (F.col("__e") == "") | (F.col("__e") > F.col("start"))) & ((F.coalesce("end", F.lit("")) == "") | (F.col("__s") == "") | (F.col("__s") < F.col("end"))))
    current = people.select(person_id, F.col("current_role").isNotNull().alias("__live"))

    def pick(keys: DataFrame, on: str, out: str) -> DataFrame:
        m = wanted.filter(F.col(on) != "").join(keys, on).join(seats, [*scope, person_id]).filter(serving).select(*ref, person_id).distinct().join(current, person_id)
        live = F.when(F.col("__live"), F.col(person_id))
        g = m.groupBy(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in ("chamber", "start", "end") else F.col(c) for c in ref]).agg(
            F.count("*").alias("n"), F.min(person_id).alias("one"), F.count(live).alias("n_live"), F.min(live).alias("live"))
        return g.select(*ref, F.col("n").alias(f"{out}_n"), F.when(F.col("n") == 1, F.col("one")).when(F.col("n_live") == 1, F.col("live")).alias(out))

    by_name = pick(names_of(people, person_id, *names).withColumnRenamed("key", "__key"), "__key", "__by_name")
    by_id = pick(people.select(person_id, F.explode("identifiers").alias("__ident")).distinct(), "__ident", "__by_id").drop("__by_id_n")
    filled = asked.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("chamber", "start", "end")})
    out = filled.join(by_id, ref, "left").join(by_name, ref, "left")
    found = F.coalesce("__by_id", "__by_name")
    status = F.when(found.isNotNull(), "resolved").when(F.coalesce("__by_name_n", F.lit(0)) > 1, "ambiguous").otherwise("unresolved")
    return out.withColumn("resolved_id", found).withColumn("status", status).drop("__key", "__ident", "__by_id", "__by_name", "__by_name_n")


def resolve_organization(refs: DataFrame, orgs: DataFrame, org_id: str, scope: list[str], normal) -> DataFrame:
    """``refs`` (scope, name, classification, chamber) with ``resolved_id`` and ``status``: by normalised name or alternative name.

    ``normal`` is a function of a name's column. ``orgs`` has the scope, the id, ``name``, ``other_names``, ``classification`` and ``parent_id``. A chamber asks for the class of the
    organisation's parent, a classification for its own; parties are found in any scope, others in that of the reference.
    """
    parents = orgs.select(F.col(org_id).alias("parent_id"), F.col("classification").alias("__chamber")).dropDuplicates(["parent_id"])
    placed = orgs.join(parents, "parent_id", "left")
    keys = placed.select(*scope, org_id, "classification", "__chamber", F.explode(F.array_distinct(F.concat(F.array(F.lower("name")), F.transform(F.coalesce("other_names", F.array().cast("array<struct<name:string>>")), lambda x: F.lower(x["name"]))))).alias("__key"))
    asked = refs.withColumn("__ref", F.xxhash64(*scope, "name", "classification", "chamber")).withColumn("__key", F.lower(normal(F.col("name"))))
    wanted = asked.select("__ref", *scope, "__key", F.col("classification").alias("__kind"), "chamber").distinct()
    fits = (F.col("__kind").isNull() | (F.col("__kind") == F.col("classification"))) & (F.col("chamber").isNull() | (F.col("chamber") == F.col("__chamber")))
    party = F.coalesce(F.col("__kind") == "party", F.lit(False))
    local = wanted.filter(~party).join(keys, [*scope, "__key"])
    anywhere = wanted.filter(party).drop(*scope).join(keys.drop(*scope), "__key")
    found = local.select(*anywhere.columns).unionByName(anywhere).filter(fits).groupBy("__ref").agg(F.count_distinct(org_id).alias("__n"), F.min(org_id).alias("__one"))
    out = asked.join(found, "__ref", "left")
    return out.withColumn("resolved_id", F.when(F.col("__n") == 1, F.col("__one"))).withColumn("status", status_of(F.coalesce("__n", F.lit(0)))).drop("__ref", "__key", "__n", "__one")


def session_of_date(facts: DataFrame, date: str, sessions: DataFrame, start: str, end: str, session_id: str, scope: list[str] | None = None, most: int = 100_000) -> DataFrame:
    """The session whose [start, end] holds the date; with none or several, the newest session of the scope.

    Only the distinct dates of a scope meet its sessions, and facts get the result by an equi join: the range
    condition is tried days x sessions times, not facts x sessions. Sessions are broadcast only if counted within
    ``most``. A null date takes the newest session.
    """
    scope = scope or []
    facts = facts.withColumn("__date", F.coalesce(F.col(date).cast("string"), F.lit("")))
    newest = sessions.groupBy(*scope).agg(F.max_by(session_id, F.struct(start, session_id)).alias("__newest"))
    s = sessions.select(*[F.col(c).alias(f"__s_{c}") for c in scope], F.col(session_id).alias("__session"), F.col(start).alias("__start"), F.col(end).alias("__end"))
    cond = (F.col("__date") != "") & holds(F.col("__date"), F.col("__start"), F.col("__end"))
    for c in scope:
        cond = cond & (F.col(c) == F.col(f"__s_{c}"))
    small = sessions.limit(most + 1).count() <= most
    dates = facts.select(*scope, "__date").distinct().join(F.broadcast(s) if small else s, cond, "left")
    found = dates.groupBy(*scope, "__date").agg(F.count("__session").alias("__n"), F.min("__session").alias("__one"))
    found = found.join(newest, scope, "left") if scope else found.crossJoin(F.broadcast(newest))  # one row
    found = found.select(*scope, "__date", F.when(F.col("__n") == 1, F.col("__one")).otherwise(F.col("__newest")).alias("session_id"), (F.col("__n") == 1).alias("exact"))
    return facts.join(found, [*scope, "__date"], "left").drop("__date")


def link_last(sources: DataFrame, targets: DataFrame, on: list[str], target_id: str, order: list[str], out: str) -> DataFrame:
    """Fill empty links: of several targets of a key the last in order is linked; links that exist stay."""
    last = targets.groupBy(*on).agg(F.max_by(target_id, F.struct(*order)).alias("__to"))
    joined = sources.join(last, on, "left")
    return joined.withColumn(out, F.coalesce(out, "__to")).drop("__to")


def match_one_to_one(left: DataFrame, right: DataFrame, on: list[str], left_id: str, right_id: str, arrival: str) -> DataFrame:
    """Every left row with its only right row; ``none``, ``several`` or ``taken`` (by an earlier left row) give no match."""
    keyed = right.groupBy(*on).agg(F.count_distinct(right_id).alias("__n"), F.min(right_id).alias("__to"))
    joined = left.join(keyed, on, "left")
    single = joined.filter("__n = 1")
    first = single.groupBy("__to").agg(F.min_by(left_id, F.struct(arrival, left_id)).alias("__first"))
    # only rows with one right row meet the second join: the others would all share its null key
    out = single.join(first, "__to").unionByName(joined.filter("__n is null or __n > 1"), allowMissingColumns=True)
    status = F.when(F.col("__n").isNull(), "none").when(F.col("__n") > 1, "several").when(F.col("__first") != F.col(left_id), "taken").otherwise("matched")
    return out.withColumn("status", status).withColumn("matched_id", F.when(status == "matched", F.col("__to"))).drop("__n", "__to", "__first")


def unique_names(people: DataFrame, person_id: str, chamber: str, pieces: Column, everywhere: str = "legislature") -> DataFrame:
    """(chamber, piece, id): lower-case pieces that name one person of a chamber; each chamber also counts in ``everywhere``."""
    rows = people.select(person_id, F.explode(F.array(F.col(chamber), F.lit(everywhere))).alias("chamber"), F.explode(F.transform(pieces, F.lower)).alias("piece")).distinct()
    g = rows.groupBy("chamber", "piece").agg(F.count_distinct(person_id).alias("n"), F.min(person_id).alias(person_id))
    return g.filter("n = 1").drop("n")


def match_people(new: DataFrame, old: DataFrame, new_id: str, old_id: str, name: str, role: list[str], seats: str) -> DataFrame:
    """New against existing people: same name, or same role where the seat is the only one; a decision for each new person.

    ``auto`` (name and role), ``review`` (one of them), ``new`` (neither). Two equi joins, unioned.
    """
    o = old.select(F.col(old_id), F.col(name).alias("__name"), *[F.col(c).alias(f"__{c}") for c in role])
    same_role = F.lit(True)
    for c in role:
        same_role = same_role & F.col(c).eqNullSafe(F.col(f"__{c}"))
    by_name = new.join(o, F.col(name) == F.col("__name"))
    cond = F.col(seats) == 1
    for c in role:
        cond = cond & (F.col(c) == F.col(f"__{c}"))
    by_role = new.join(o, cond)
    both = by_name.unionByName(by_role).withColumn("__same_name", F.col(name) == F.col("__name")).withColumn("__same_role", same_role)
    best = both.groupBy(new_id).agg(F.min_by(F.struct(F.col(old_id).alias("id"), "__same_name", "__same_role"), F.struct(~(F.col("__same_name") & F.col("__same_role")), ~F.col("__same_name"), F.col(old_id))).alias("m"))
    out = new.select(new_id).join(best, new_id, "left")
    decision = F.when(F.col("m").isNull(), "new").when(F.col("m.__same_name") & F.col("m.__same_role"), "auto").otherwise("review")
    return out.select(new_id, F.col("m.id").alias(old_id), decision.alias("decision"))


def redirect(refs: DataFrame, column: str, moves: DataFrame, old: str, new: str) -> DataFrame:
    """References to merged ids re-pointed to what they became."""
    m = moves.select(F.col(old).alias(column), F.col(new).alias("__new"))
    return refs.join(m, column, "left").withColumn(column, F.coalesce("__new", column)).drop("__new").select(refs.columns)


def map_ids(refs: DataFrame, column: str, duplicates: DataFrame, ids: DataFrame) -> DataFrame:
    """Arrival ids to stored ids: first to the kept one of duplicates (``copy``, ``kept``), then by the id map (``arrival``, ``stored``)."""
    d = duplicates.select(F.col("copy").alias(column), "kept")
    out = refs.join(d, column, "left").withColumn("__k", F.coalesce("kept", column)).drop("kept")
    return out.join(ids.select(F.col("arrival").alias("__k"), "stored"), "__k", "left").drop("__k")
