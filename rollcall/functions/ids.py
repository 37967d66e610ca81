"""Column functions for identifiers, hashes and hierarchical ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPEC = "map<string,string>"


def pseudo_id(**parts: Column) -> Column:
    """A reference by properties: ``~`` and a JSON object with sorted keys; null parts are left out."""
    spec = F.map_from_entries(F.array_compact(F.array(*[F.when(v.isNotNull(), F.struct(F.lit(k), v.cast("string"))) for k, v in sorted(parts.items())])))
    return F.concat(F.lit("~"), F.to_json(spec))


def read_pseudo_id(c: Column) -> Column:
    """Properties of a pseudo id, or null where it isn't one."""
    return F.when(c.startswith("~"), F.from_json(F.substr(c, F.lit(2)), SPEC))


def pseudo_organization(classification: Column, org_id: Column, default: str | None = None) -> Column:
    """struct(id, status): by id, by class, or by the default; both an id and a class are an error."""
    spec = F.coalesce(classification, F.lit(default))
    return F.struct(
        F.when(org_id.isNotNull() & classification.isNull(), org_id).when(org_id.isNull() & spec.isNotNull(), pseudo_id(classification=spec)).alias("id"),
        F.when(org_id.isNotNull() & classification.isNotNull(), "error").when(org_id.isNull() & spec.isNull(), "none").otherwise("ok").alias("status"))


def canonical_hash(*cols: Column) -> Column:
    """256-bit content digest that keeps array order and null positions. Maps are given as ``sorted_map`` so that their order doesn't count."""
    parts = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cols)])
    return F.sha2(F.to_json(parts, {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}), 256)


def sorted_map(c: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(c)))


def bill_key(jurisdiction: Column, session: Column, identifier: Column) -> Column:
    """A readable id for a bill: state, session and identifier in lower case without other signs."""
    state = F.regexp_extract(jurisdiction, r"(?:state|territory|district):([a-z]{2})", 1)
    clean = lambda x: F.regexp_replace(F.lower(x), r"[^a-z0-9]", "")
    return F.concat_ws("-", F.lit("ocd-bill"), F.when(state == "", "us").otherwise(state), clean(session), clean(identifier))


#: fixed value: how a uuid is written
UUID = r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"


def is_typed_id(c: Column, kind: str) -> Column:
    return F.coalesce(c.rlike(rf"^ocd-{kind}/{UUID}\z"), F.lit(False))


def is_jurisdiction_id(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^ocd-jurisdiction/country:us(/(state|district|territory|county|parish|place):[^/]+)*/[a-z_]+\z"), F.lit(False))


def name_uuid(namespace: str, name: Column) -> Column:
    """Version 5 uuid of a name in a namespace uuid: the same name always gives the same id."""
    space = F.unhex(F.lit(namespace.replace("-", "")))
    h = F.sha1(F.concat(space, F.encode(name, "UTF-8")))
    variant = F.conv(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8).cast("string"), 10, 16)
    return F.lower(F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12)))


def division_parts(c: Column, country: Column) -> Column:
    """Levels below the country as an array of struct(subtype, subid); null if the id is of another country or too deep."""
    parts = F.split(c, "/")
    below = F.slice(parts, F.lit(3), F.greatest(F.size(parts), F.lit(1)))
    ok = c.startswith("ocd-division/") & (F.get(parts, F.lit(1)) == F.concat(F.lit("country:"), country)) & (F.size(below) <= 7)
    return F.when(ok, F.transform(below, lambda x: F.struct(F.split(x, ":", 2)[0].alias("subtype"), F.get(F.split(x, ":", 2), F.lit(1)).alias("subid"))))


def division_depth(c: Column) -> Column:
    return F.size(F.split(c, "/")) - 2


def jurisdiction_of_division(c: Column, body: str = "government") -> Column:
    return F.concat(F.regexp_replace(c, "^ocd-division", "ocd-jurisdiction"), F.lit(f"/{body}"))


def abbreviation(jurisdiction: Column) -> Column:
    return F.regexp_extract(jurisdiction, r"/(?:state|territory|district):([a-z]{2})", 1)


#: fixed values: file endings by media type
ENDINGS = {"application/pdf": "pdf", "text/html": "html", "text/xml": "xml", "application/xml": "xml", "application/msword": "doc", "application/rtf": "rtf", "text/plain": "txt",
           "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx"}


def file_ending(media: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in ENDINGS.items() for x in kv])
    return F.coalesce(F.try_element_at(known, F.trim(F.lower(F.split(F.coalesce(media, F.lit("")), ";")[0]))), F.lit("bin"))


def archive_path(abbr: Column, session: Column, chamber: Column, identifier: Column, bill: Column, date: Column, note: Column, url: Column, media: Column) -> Column:
    """Where a version's bytes are kept: names made safe, the address by its hash."""
    safe = lambda x: F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(x, F.lit(""))), r"\s+", "-"), r"[^A-Za-z0-9._-]", "")
    stem = F.concat_ws("-", F.when(F.coalesce(date, F.lit("")) != "", date), safe(note), F.substring(F.sha2(url, 256), 1, 16))
    return F.concat_ws("/", F.lit("bills/raw"), abbr, safe(session), safe(chamber), F.concat_ws("--", safe(identifier), bill), F.concat(stem, F.lit("."), file_ending(media)))


def content_matches(content: Column, etag: Column) -> Column:
    """Whether a store's tag is the content's MD5; tags of multi-part uploads can't be compared and give null."""
    tag = F.replace(etag, F.lit('"'), F.lit(""))
    return F.when(~tag.contains("-"), F.md5(content) == tag)
