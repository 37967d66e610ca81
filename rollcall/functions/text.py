"""Column functions on names, identifiers, phones, addresses and free text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType


def fix_bill_id(c: Column) -> Column:
    """``hb0012`` to ``HB 12``: the first letters-and-number is spaced and loses leading zeros; only the first is touched."""
    up = F.upper(c)
    lettered = up.rlike(r"^(SJR|HJR)(?U)\s*[A-Z]+\s*$")
    spaced = F.regexp_replace(up, r"^(SJR|HJR)(?U)\s*([A-Z]+)\s*$", "$1 $2")
    numbered = F.regexp_replace(up, r"(?Us)^(.*?)([A-Z]*)\s*0*([-\d]+)", "$1$2 $3")
    return F.trim(F.when(lettered, spaced).otherwise(numbered))


def collapse_whitespace(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", " ")


def truncate(c: Column, n: int = 300) -> Column:
    return F.substring(c, 1, n)


def truncate_words(c: Column, n: int) -> Column:
    """The first ``n`` words, with an ellipsis if there are more."""
    words = F.split(F.trim(collapse_whitespace(c)), " ")
    return F.concat(F.array_join(F.slice(words, 1, n), " "), F.when(F.size(words) > n, " …").otherwise(""))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def deep_map(c: Column, kind: DataType, fn) -> Column:
    """Apply a text function to every text inside arrays and structs."""
    if isinstance(kind, StringType):
        return fn(c)
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: deep_map(x, kind.elementType, fn))
    if isinstance(kind, StructType):
        made = F.struct(*[deep_map(c[f.name], f.dataType, fn).alias(f.name) for f in kind.fields])
        return F.when(c.isNull(), F.lit(None)).otherwise(made)
    return c


def apply_tree(c: Column, kind: DataType, tree) -> Column:
    """Transformers by field: a function, a list of functions, or a tree of them for nested fields and arrays of structs."""
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: apply_tree(x, kind.elementType, tree))
    if callable(tree):
        return tree(c)
    if isinstance(tree, list):
        for fn in tree:
            c = fn(c)
        return c
    parts = [apply_tree(c[f.name], f.dataType, tree[f.name]).alias(f.name) if f.name in tree else c[f.name].alias(f.name) for f in kind.fields]
    return F.when(c.isNull(), F.lit(None)).otherwise(F.struct(*parts))


def cleanup_list(c: Column, default: Column | None = None) -> Column:
    """A sorted array; null gives the default (an empty array)."""
    return F.array_sort(F.coalesce(c, default if default is not None else F.array().cast("array<string>")))


def reformat_phone(c: Column) -> Column:
    """Ten digits as ``aaa-bbb-cccc``, a leading 1 and an extension kept; anything else stays as it is."""
    p = r"(?s)^\D*(1?)\D*(\d{3})\D*(\d{3})\D*(\d{4}).*?(?:(?:ext|Ext|EXT)\.?\s*(\d{1,4}))?$"
    part = lambda i: F.regexp_extract(c, p, i)
    made = F.concat(F.when(part(1) != "", F.concat(part(1), F.lit("-"))).otherwise(""), part(2), F.lit("-"), part(3), F.lit("-"), part(4),
                    F.when(part(5) != "", F.concat(F.lit(" ext. "), part(5))).otherwise(""))
    return F.when(c.rlike(p), made).otherwise(c)


def reformat_address(c: Column) -> Column:
    """One line: line breaks become semicolons, runs of white space one blank."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s*\n\s*", ";"), r"(?U)\s+", " ")


def sanitize_phone(c: Column) -> Column:
    """Digits in groups joined with dashes; blank and placeholder numbers give the empty text."""
    digits = F.regexp_replace(c, r"[^0-9]", "")
    return F.when(F.length(digits) == 10, F.concat_ws("-", F.substring(digits, 1, 3), F.substring(digits, 4, 3), F.substring(digits, 7, 4))).otherwise(F.coalesce(F.trim(c), F.lit("")))


def file_slug(c: Column) -> Column:
    """A file name: blanks as dashes, other than letters and dashes left out."""
    return F.regexp_replace(F.regexp_replace(c, r"\s+", "-"), r"[^a-zA-Z-]", "")


def org_name(c: Column) -> Column:
    """A committee's name for comparison: each run of letters capitalised, small joining words (anywhere, even inside words) lower, ``&`` spelt out."""
    titled = F.array_join(F.transform(
        F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), 1),
        lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))), "")
    for word in ("and", "at", "by", "for", "in", "on", "of", "the"):
        titled = F.regexp_replace(titled, f"(?i){word}", word)
    return F.replace(titled, F.lit(" & "), F.lit(" and "))


def chamber_of_event(name: Column, lower: Column, upper: Column) -> Column:
    """``lower``/``upper`` if the first word of the event's name holds the name of just one chamber."""
    first = F.split(F.lower(name), " ")[0]
    low, up = F.coalesce(first.contains(F.lower(lower)), F.lit(False)), F.coalesce(first.contains(F.lower(upper)), F.lit(False))
    return F.when(low & ~up, "lower").when(up & ~low, "upper")


def drop_nul(c: Column) -> Column:
    return F.replace(c, F.lit("\0"), F.lit(""))


def clean_text(c: Column) -> Column:
    """No-break spaces and tabs as blanks (one each), line ends as newlines."""
    return F.regexp_replace(F.regexp_replace(c, "\r\n|\r", "\n"), "[ \t]", " ")


#: fixed value: where lines end for text read from documents
LINE_END = "\r\n|[\n\r\u000b\f\u001c-\u001e\u0085  ]"


def lines(c: Column) -> Column:
    """Lines of a text; a line end at its end makes no further line."""
    return F.split(F.regexp_replace(c, f"(?:{LINE_END})$", ""), LINE_END)


def keep_matching_lines(c: Column, pattern: str, group: int = 1) -> Column:
    """Of lines that match, what the group holds, joined by newlines: text beside line numbers."""
    kept = F.transform(F.filter(lines(c), lambda x: x.rlike(pattern)), lambda x: F.regexp_extract(x, pattern, group))
    return F.array_join(kept, "\n")


def numbered_share(c: Column, pattern: str = r"(?m)^\s*\d+\s+\S") -> Column:
    """Share of lines that begin with a number."""
    return F.size(F.regexp_extract_all(c, F.lit(pattern), 0)) / F.size(F.split(c, "\n"))


def is_block_page(content: Column, media: Column) -> Column:
    """Whether bytes aren't of the media type they came as, or begin with an access-denied page."""
    head = F.lower(F.decode(F.substring(content, 1, 2048), "ISO-8859-1"))
    magic = F.when(media == "application/pdf", ~head.startswith("%pdf")).when(media == "application/msword", ~F.hex(F.substring(content, 1, 4)).isin("D0CF11E0", "504B0304")).otherwise(False)
    marks = ("access denied", "request rejected", "captcha", "are you a robot", "incident id")
    blocked = F.lit(False)
    for m in marks:
        blocked = blocked | head.contains(m)
    return magic | (blocked & head.contains("<html"))


def office_name(name: Column, classification: Column) -> Column:
    return F.when(F.coalesce(name, F.lit("")) != "", name).otherwise(F.concat(F.initcap(classification), F.lit(" Office")))


def contains_word(c: Column, query: str) -> Column:
    """Case-insensitive substring, taken literally."""
    return F.lower(c).contains(query.lower())


def lacks(c: Column, part: str) -> Column:
    """Whether a text doesn't hold ``part``, taken literally and as it is written."""
    return ~c.contains(part)
