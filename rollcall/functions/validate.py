"""Validators as columns: each gives a message or null; ``problems`` gathers them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rollcall.functions.ids import UUID

#: fixed values: party names by abbreviation
PARTIES = {"d": "Democratic", "dem": "Democratic", "democrat": "Democratic", "democratic": "Democratic", "r": "Republican", "rep": "Republican", "republican": "Republican",
           "i": "Independent", "ind": "Independent", "independent": "Independent", "l": "Libertarian", "g": "Green", "np": "Nonpartisan"}


def party_name(c: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in PARTIES.items() for x in kv])
    bare = F.trim(F.regexp_replace(F.lower(c), r"\s+party$|\.", ""))
    return F.coalesce(F.try_element_at(known, bare), c)


def is_fuzzy_date(c: Column) -> Column:
    """``YYYY``, ``YYYY-MM`` or ``YYYY-MM-DD``; the empty text is an unknown date and valid."""
    return F.coalesce((c == "") | c.rlike(r"^\d{4}(-(0[1-9]|1[0-2])(-(0[1-9]|[12]\d|3[01]))?)?\z"), F.lit(False))


def is_fuzzy_datetime(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\d{4}(-\d{2}(-\d{2}( \d{2}:\d{2}(:\d{2})?([+-]\d{2}:\d{2})?)?)?)?\z"), F.lit(False))


def rule(ok: Column, message: str) -> Column:
    """The message where ``ok`` is false; null (nothing to check) passes."""
    return F.when(~F.coalesce(ok, F.lit(True)), F.lit(message))


def problems(*found: Column) -> Column:
    return F.array_compact(F.array(*found))


def person_problems(name: Column, given: Column, family: Column, person_id: Column, birth: Column, death: Column, email: Column) -> Column:
    """What is wrong with a person's record, by itself."""
    plain = F.size(F.split(F.coalesce(name, F.lit("")), " ")) == 2
    first, last = F.split(name, " ")[0], F.get(F.split(name, " "), F.lit(1))
    return problems(
        rule(name.isNotNull() & (name != ""), "name is required"),
        rule(~name.contains("\n"), "newline in name"),
        rule(~name.rlike(r",|(?i)\b(jr|sr)$"), "comma or bare suffix in name"),
        rule(person_id.rlike(rf"^ocd-person/{UUID}\z"), "invalid person id"),
        rule(is_fuzzy_date(birth), "invalid birth_date"), rule(is_fuzzy_date(death), "invalid death_date"),
        rule((email == "") | email.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"), "invalid email"),
        F.when(plain & (F.coalesce(given, F.lit("")) == ""), F.concat(F.lit("missing given_name, could be "), first)),
        F.when(plain & (F.coalesce(family, F.lit("")) == ""), F.concat(F.lit("missing family_name, could be "), last)))


def is_url(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^(https?|ftp)://"), F.lit(False))


def is_phone(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^(1-)?\d{3}-\d{3}-\d{4}( ext\. \d{1,4})?$"), F.lit(False))


def is_handle(c: Column) -> Column:
    """A social account's bare name: no address, no leading ``@``."""
    return F.coalesce(c.rlike(r"^[^@/\s][^/\s]*$") & ~c.startswith("http"), F.lit(False))


def role_problems(kind: Column, district: Column, end: Column) -> Column:
    """Legislative roles need a district, executive ones an end."""
    return problems(
        rule(~kind.isin("upper", "lower", "legislature") | (F.coalesce(district.cast("string"), F.lit("")) != ""), "role needs a district"),
        rule(~kind.isin("governor", "mayor", "lt_governor", "secretary of state", "attorney general") | (F.coalesce(end, F.lit("")) != ""), "role needs an end_date"))


def office_problems(offices: Column) -> Column:
    """Offices (array of structs with voice, fax, address, email) without any contact, and addresses used twice."""
    empty = F.exists(offices, lambda o: (F.coalesce(o["voice"], F.lit("")) == "") & (F.coalesce(o["fax"], F.lit("")) == "") & (F.coalesce(o["address"], F.lit("")) == ""))
    used = F.filter(F.transform(offices, lambda o: o["address"]), lambda a: F.coalesce(a, F.lit("")) != "")
    return problems(rule(~empty, "office without contact"), rule(F.size(F.array_distinct(used)) == F.size(used), "address used multiple times"))
