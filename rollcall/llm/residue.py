"""Template residue, filler, error pages and scripts-required notices instead of content."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.session import cut

#: Boilerplate (a hash a line) of up to so many bytes in all is broadcast, more is joined by shuffle.
BROADCAST_BYTES = 32_000_000

# fixed values: how templates write a place to be filled
_NAME = r"[a-z][\w.]*(?: [\w.]+){0,3}"
PLACEHOLDERS = [
    r"\{\{[^{}\n]{0,60}\}\}", r"\$\{[^{}\n]{1,60}\}", r"#\{[^{}\n]{1,60}\}", r"\{%[^%{}\n]{1,60}%\}", r"<%[^%\n]{1,60}%>", r"<<[^<>\n]{1,60}>>",
    r"@@[^@\s]{1,60}@@", r"%\([a-z_][\w.]*\)[sdif]", r"(?<![\w~])__[a-z](?:[\w.]*[a-z0-9])?__(?!\w)", r"%7b%7b.{1,40}?%7d%7d",
    rf"\{{{_NAME}\}}", r"\[object object\]",
    r"\[(?:insert|enter|your|placeholder|todo|tbd|bill|title|text|name|date|number|session|chamber|version|file|doc|year|type)\b[^\[\]\n]{0,60}\]",
    r"<(?:insert|enter|your|placeholder|todo|tbd|bill|title|text|name|date|number|session|chamber|version|file|doc|year|type|media|mime)(?:[ _.][^<>\n]{0,60}|number|name|title|id)?>",
    r"\b(?:your_[a-z]+_here|insert_[a-z_]+_here)\b",
]
# markup that is spelt like a placeholder in angle brackets
_MARKUP = r"<title>[^<>]*</title>"
FILLER = [
    r"\blorem ipsum\b", r"\bdolor sit amet\b", r"(?:\binsert (?:your )?(?:bill )?(?:text|title|content) here\b[.!]?\s*)", r"\b(?:bill |your )?(?:text|title|content) goes here\b",
    r"\b(?:sample|placeholder|dummy) text\b", r"\bx{4,12}\b",
]
ERRORS = [
    r"\b(?:40[0-9]|50[0-9])\b\s*[-–:]?\s*(?:bad request|unauthori[sz]ed|forbidden|not found|file or directory not found|page not found|internal server error|bad gateway|service unavailable|gateway time-?out)",
    r"\bfile or directory not found\b", r"\bthe resource you are looking for\b", r"\b(?:page|document) (?:you (?:requested|are looking for) )(?:could|can) ?not be found\b",
    r"^\W*sorry, this (?:document|page) is not available\b", r"\bserver error in '[^']*' application\b", r"^\W*access denied\b", r"\breference #\d+\.[0-9a-f]+", r"\b(?:your )?session (?:has )?(?:timed out|expired)\b",
    r"^\W*service unavailable\b", r"\bserver is temporarily unable to service your request\b", r"^\W*too many requests\b", r"\ban unexpected error (?:has )?occurred\b", r"\b502 bad gateway\b",
    r"\bruntime error\b", r"^\W*internal server error\b", r"\btry again later\b",
]
SCRIPTS = [
    r"\b(?:please |must |need to |you should )+(?:enable|activate|turn on) (?:java ?script|cookies|scripts)\b", r"\bbrowser does not support (?:java ?script|scripting|scripts)\b",
    r"\b(?:site|page|app|application) (?:requires|needs) (?:java ?script|scripts|cookies)\b", r"\b(?:java ?script|scripting|cookies) (?:is|are|must be) (?:disabled|required|enabled)\b",
    r"\bchecking (?:that you are not a robot|your browser|if you are human)\b", r"\bverify(?:ing)? (?:that )?you are (?:human|not a robot)\b",
]
URLS = [
    r"^javascript:", r"^(?:about|data):", r"/(?:undefined|null|nan|none)(?:[/?#.]|$)", r"[?&=](?:nan|null|undefined|none)(?:[?&#]|$)", r"//(?:www\.)?example\.(?:com|org|net)(?:[:/]|$)", r"\blorem[-_]?ipsum\b",
    r"/errors?/(?:\d{3}|not-?found|[\w-]+\.aspx)\b", r"aspxerrorpath=", r"/(?:session-expired|sessiontimeout|not-?found|access-?denied|page-not-found)(?:\.\w+)?(?:[/?#]|$)",
    r"/(?:enable-javascript|enable-cookies|noscript|javascript-required)(?:[/?#]|$)", r"/(?:yyyy|mm|dd)/", r"/todo(?:[/?#]|$)|/tbd(?:[/?#]|$)", r"/%[sd](?:[/.?]|$)", r"\[insert\b|insert[-_ ]link[-_ ]here",
]
# names of fields in the place of their values
FIELD_NAMES = r"/(?:bill|doc|file|session)[_-]?(?:no|num|number|id|name)(?:\.\w+)?(?:[/?#]|$)"
# every pattern of URLS needs one of these
URL_HINTS = ["javascript", "about:", "data:", "undefined", "null", "nan", "none", "example.", "ipsum", "error", "expired", "timeout", "not-found", "notfound", "denied", "access", "page-", "enable-", "noscript",
             "/yyyy/", "/mm/", "/dd/", "/todo", "/tbd", "/%s", "/%d", "insert"]
# registered top-level types; what stands before the stroke otherwise is no type
TOP_TYPES = "application audio chemical font haptics image message model multipart text video".split()
MEDIA = [
    r"^(?:null|none|undefined|nan|n/a|#n/a|tbd|todo|unknown type)$", r"^%[sd]$", r"\blorem\b|\bipsum\b", r"\berror\b", r"^\d{3}\b|\bnot found\b", r"\btbd\b|\btodo\b", r"enable javascript|javascript (?:is )?required",
    r"\byour_", rf"^(?!(?:{'|'.join(TOP_TYPES)}|x-[\w.+-]+)/)[a-z]+/",
]
# every pattern above needs one of these, which are looked for first (text is in lower case)
MARKS = ["{", "%", "<", "@@", "__", "[", "your_", "insert_"]
HINTS = ["lorem", "dolor sit", " here", "sample text", "dummy text", "xxxx", "placeholder", "bad request", "unauthori", "forbidden", "not found",
         "server error", "bad gateway", "unavailable", "timeout", "time-out", "resource you are", "be found", "not available", "access denied", "reference #",
         "timed out", "expired", "temporarily unable", "too many requests", "unexpected error", "runtime error", "try again", "javascript", "java script",
         "cookies", "scripts", "scripting", "robot", "your browser", "human"]
# every pattern of FILLER, ERRORS and SCRIPTS needs one of these words
HINT_WORDS = ("lorem dolor here sample placeholder dummy request requests unauthorized unauthorised forbidden found server gateway unavailable looking sorry denied reference timed expired unexpected "
              "runtime later javascript script scripts scripting cookies browser robot human").split() + ["x" * n for n in range(4, 13)]
# fixed values end


def _holds(text: Column, parts: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(p) for p in parts])


def _any(text: Column, patterns: list[str]) -> Column:
    return text.rlike("(?im)" + "|".join(f"(?:{p})" for p in patterns))


def _placeholder(text: Column) -> Column:
    return _holds(text, MARKS) & _any(text, PLACEHOLDERS)


def _suspicious(text: Column, patterns: list[str]) -> Column:
    return _holds(text, HINTS) & _any(text, patterns)


def _held(text: Column, hinted: Column) -> Column:
    """Whether a whole text holds evidence; ``hinted``: one of HINT_WORDS is in it."""
    return _placeholder(text) | (hinted & _any(text, [*FILLER, *ERRORS, *SCRIPTS]))


def evidence_in_url(url: Column) -> Column:
    """Kind of evidence in an address, or null. Braced identifiers of 30 and more characters are real names."""
    low = F.lower(url)
    bare = F.when(_holds(low, ["{", "%7b"]), F.regexp_replace(low, r"(?:\{|%7b)[0-9a-f]{8}-[0-9a-f-]{20,36}(?:\}|%7d)", "")).otherwise(low)
    return (F.when(bare.isNull() | (F.trim(bare) == ""), F.lit(None).cast("string"))
            .when(_placeholder(bare) | _any(bare, [r"/\[[a-z_.]+\](?:[/?.]|$)", r"/<[a-z_.]+>(?:[/?.]|$)"]), "placeholder").when((_holds(bare, URL_HINTS) & _any(bare, URLS)) | bare.rlike(FIELD_NAMES), "error"))


def evidence_in_media_type(media: Column) -> Column:
    """Kind of evidence in a media type, or null; odd but real types (any ``type/subtype`` with parameters) have none."""
    bare = F.trim(F.regexp_replace(F.trim(F.lower(media)), r"\s*;\s*$", ""))
    return (F.when(bare.isNull() | (bare == ""), F.lit(None).cast("string"))
            .when(_placeholder(bare) | _any(bare, [r"[\[<{][^\[\]<>{}]*[\]>}]"]), "placeholder")
            .when(_any(bare, MEDIA), "error"))


def visible(text: Column) -> Column:
    """Text without markup tags; what only looks like a tag but is a placeholder stays."""
    bare = F.regexp_replace(F.regexp_replace(text, r"(?is)<(script|style)\b[^>]*>.*?</\1>", " "),
                            r"(?i)</?(?:html|head|body|div|span|p|br|b|i|u|em|strong|table|tr|td|th|ul|ol|li|h[1-6]|a|img|meta|link|noscript|strike|ins|del|sup|sub|section|article|center|font|hr|pre|title(?=>[^<>]*</title>)|/title|title(?=>$))\b[^<>]*>", "\n")
    return F.when(text.contains("<"), bare).otherwise(text)


def normalised(text: Column) -> Column:
    """Visible text in lower case, white space collapsed, lines trimmed, no blank lines."""
    blanks = F.regexp_replace(F.lower(visible(text)), r"(?U)[\s&&[^\r\n]]+", " ")
    return F.trim(F.regexp_replace(blanks, r" ?[\r\n][ \r\n]*", "\n"), F.lit(" \n"))


def _masked(line: Column) -> Column:
    """Lines that differ in numbers only count as one."""
    return F.regexp_replace(line, r"\d+", "0")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[^\p{L}]+"), lambda w: F.length(w) > 1)


def evidence_in_line(line: Column) -> Column:
    """Kind of evidence in one line, or null."""
    return (F.when(_placeholder(line), "placeholder").when(_suspicious(line, FILLER), "filler").when(_suspicious(line, ERRORS), "error").when(_suspicious(line, SCRIPTS), "scripts"))


def find_residue(df: DataFrame, key: str, url: str, media: str, text: str, share: float = 0.002, z: float = 1.96, content_words: int = 25, hosts: int = 3, unlike: float = 0.1) -> DataFrame:
    """(``key``, ``field``, ``kind``) of every field that holds residue instead of content.

    ``kind``: ``placeholder``, ``filler``, ``error``, ``scripts`` or ``notice``. Null and blank fields hold nothing. A text
    is residue if, without boilerplate, it holds an unfilled placeholder, or a line or sentence of it is
    filler, an error message or a scripts-required notice and fewer than ``content_words`` words are left beside
    such sentences: longer texts merely mention them. Rows with a null key are reported under it, repeated rows
    once, empty tables give nothing.

    Method. Normalised lines of all texts are counted by the address's host (partial counts, so a host with a third
    of the rows is one counter a line). What counts isn't how often a line occurs but in how many surroundings: copies
    and versions of one document share their longest lines and count once. A line without evidence is boilerplate
    (a heading, a menu) and subtracted if it recurs beside different evidence lines of its host, however few, or beside
    different longest other lines, as many that their share of the host's different texts is at least ``share`` by the
    lower bound of its Wilson interval (``z`` deviations). Lines are counted as hashes, texts are not shuffled unless
    the boilerplate of all hosts together is more than ``BROADCAST_BYTES``.

    Evidence is of two kinds: patterns of how templates, servers and browsers write, and notices learnt from the texts
    themselves (``recurrent_notices``): short texts that say the same on at least ``hosts`` hosts in words that content
    doesn't use.
    """
    host = F.regexp_extract(F.coalesce(F.lower(F.col(url)), F.lit("")), r"^\s*[a-z]+://([^/?#\s]+)", 1)
    # read four times, normalised once
    read = df.select(F.col(key).alias("k"), host.alias("h"), F.col(url).alias("u"), F.col(media).alias("m"), normalised(F.col(text)).alias("t")).withColumn("w", _words(F.col("t")))
    rows = cut(read.select("k", "h", "u", "m", "t", F.size("w").alias("n"), F.arrays_overlap("w", F.array(*[F.lit(w) for w in HINT_WORDS])).alias("hinted")))
    boiler = cut(_boilerplate(rows.filter("t <> ''").select("h", "t", "hinted"), share, z))
    size = boiler.agg(F.sum(F.size("boiler") * F.lit(8).cast("long"))).first()[0] or 0
    joined = rows.join(F.broadcast(boiler) if size <= BROADCAST_BYTES else boiler, "h", "left")
    framing = lambda x: F.array_contains("boiler", F.xxhash64(_masked(x))) & evidence_in_line(x).isNull()
    # only texts that hold evidence as they are can be residue: the others aren't looked into
    held = _held(F.col("t"), F.col("hinted"))
    residual = F.when(F.col("boiler").isNotNull() & F.col("t").contains("\n"), F.array_join(F.filter(F.split("t", "\n"), lambda x: ~framing(x)), "\n")).otherwise(F.col("t"))
    judged = joined.withColumn("residual", F.when(held, residual)).select("k", F.explode(F.array(
        F.struct(F.lit(url).alias("field"), evidence_in_url(F.col("u")).alias("kind")),
        F.struct(F.lit(media).alias("field"), evidence_in_media_type(F.col("m")).alias("kind")),
        F.struct(F.lit(text).alias("field"), F.when(F.col("residual").isNotNull(), evidence_in_residual(F.col("residual"), content_words)).alias("kind")))).alias("f")).select("k", "f.*").filter("kind is not null")
    learnt = recurrent_notices(rows.select("k", "h", "t", "n"), content_words, hosts, unlike).select("k", F.lit(text).alias("field"), F.lit("notice").alias("kind"))
    both = judged.unionByName(learnt).groupBy("k", "field").agg(F.min_by("kind", F.when(F.col("kind") == "notice", 1).otherwise(0)).alias("kind"))
    return both.select(F.col("k").alias(key), "field", "kind")


def notice_scores(texts: DataFrame, content_words: int, hosts: int) -> DataFrame:
    """(line, hosts, score) of lines of short texts that recur on several hosts: how unlike content their words are.

    A line's score is the mean, over its words, of the log ratio of the share of such lines that hold the word and the share
    of longer texts that do. Lines count once a host, words once a line or text: what is copied often weighs no more.
    """
    words = F.array_distinct(_words(_masked(F.col("t"))))
    short = texts.filter("n < %d and n > 0" % content_words).select("h", F.explode(F.array_distinct(F.split(_masked(F.col("t")), "\n"))).alias("line")).distinct()
    notices = cut(short.groupBy("line").agg(F.count("*").alias("hosts")).filter(F.col("hosts") >= hosts))
    said = notices.select("line", F.explode(F.array_distinct(_words(F.col("line")))).alias("w"))
    long = texts.filter("n >= %d" % content_words)
    content = long.select(F.explode(words).alias("w")).groupBy("w").agg(F.count("*").alias("n_content"))
    totals = notices.agg(F.count("*").alias("all_notices")).crossJoin(long.agg(F.count("*").alias("all_content")))  # one row each
    stats = (said.groupBy("w").agg(F.count("*").alias("n_notices")).join(content, "w", "left").crossJoin(F.broadcast(totals))
             .select("w", (F.log((F.col("n_notices") + 0.5) / (F.col("all_notices") + 1)) - F.log((F.coalesce("n_content", F.lit(0)) + 0.5) / (F.col("all_content") + 1))).alias("ratio")))
    return said.join(stats, "w").groupBy("line").agg(F.avg("ratio").alias("score")).join(notices, "line")


def recurrent_notices(texts: DataFrame, content_words: int, hosts: int, unlike: float) -> DataFrame:
    """(k) of short texts (``k``, ``h``, ``t``, ``n`` words) at least half of whose words stand in lines learnt to be notices."""
    counted = texts.filter("n > 0")
    learnt = notice_scores(counted, content_words, hosts).filter(F.col("score") >= unlike).select("line")
    short = counted.filter("n < %d and n > 0" % content_words).select("k", "n", F.explode(F.split(_masked(F.col("t")), "\n")).alias("line"))
    return short.join(learnt, "line").groupBy("k", "n").agg(F.sum(F.size(_words(F.col("line")))).alias("said")).filter("said * 2 >= n").select("k").distinct()


def _boilerplate(texts: DataFrame, share: float, z: float) -> DataFrame:
    """(``h``, ``boiler``): hashes of the lines that recur in different surroundings of texts (``h``, ``t``, ``hinted``)."""
    # evidence is looked for line by line only where the text as a whole holds some
    lines = F.split("t", "\n")
    first = F.when(F.col("t").contains("\n") & _held(F.col("t"), F.col("hinted")),
                   F.try_element_at(F.filter(lines, lambda x: evidence_in_line(x).isNotNull()), F.lit(1)))
    masked = F.array_distinct(F.split(_masked(F.col("t")), "\n"))
    longest = F.slice(F.array_sort(F.transform("lines_", lambda x: F.struct((-F.length(x)).alias("o"), F.xxhash64(x).alias("x")))), 1, 2)
    marked = texts.select("h", masked.alias("lines_"), _masked(first).alias("first")).select("h", "lines_", F.xxhash64("first").alias("e"), F.col("first").isNotNull().alias("has"), longest.alias("top"))
    nothing = F.lit(0).cast("long")
    hashes = F.transform("lines_", lambda x: F.xxhash64(x))
    beside = lambda x: F.coalesce(F.when(x != F.col("top")[0]["x"], F.col("top")[0]["x"]).otherwise(F.try_element_at("top", F.lit(2))["x"]), nothing)
    entry = lambda line, what, value: F.struct(line.alias("line"), F.lit(what).alias("what"), value.alias("value"))
    entries = F.concat(
        F.array(entry(F.lit(None).cast("long"), "text", F.xxhash64("lines_"))),
        F.transform(hashes, lambda x: entry(x, "line", beside(x))),
        F.when(F.col("has"), F.transform(F.filter(hashes, lambda x: x != F.col("e")), lambda x: entry(x, "evidence", F.col("e")))).otherwise(F.array().cast("array<struct<line:bigint,what:string,value:bigint>>")))
    different = lambda what: F.count_if(F.col("what") == what)
    counted = (marked.select("h", F.explode(entries).alias("x")).select("h", "x.*").distinct()
               .groupBy("h", "line").agg(different("line").alias("n"), different("evidence").alias("evidences"), different("text").alias("texts")))
    total = F.max("texts").over(Window.partitionBy("h"))
    lower = ((F.col("n") + z * z / 2 - z * F.sqrt(F.col("n") * (1 - F.col("n") / F.col("records")) + z * z / 4)) / (F.col("records") + z * z))
    return (counted.filter("n > 1 or evidences > 1 or line is null").withColumn("records", total)
            .filter(F.col("line").isNotNull() & ((F.col("evidences") > 1) | ((F.col("n") > 1) & (lower >= share))))
            .groupBy("h").agg(F.collect_set("line").alias("boiler")))


def evidence_in_residual(residual: Column, content_words: int) -> Column:
    """Kind of evidence of a whole residual, or null if what isn't evidence is content of its own."""
    sentences = F.split(residual, r"(?<=[.!?])\s+|\n")
    plain = F.filter(sentences, lambda s: evidence_in_line(s).isNull())
    words = F.aggregate(plain, F.lit(0), lambda n, s: n + F.size(F.filter(F.split(s, r"[^\p{L}]+"), lambda w: F.length(w) > 1)))
    suspicious = _suspicious(residual, [*FILLER, *ERRORS, *SCRIPTS])
    return (F.when(_placeholder(residual), "placeholder")
            .when(suspicious, F.when(words < content_words, F.coalesce(
                *[F.try_element_at(F.filter(F.transform(sentences, evidence_in_line), lambda x: x.isNotNull()), F.lit(1))], F.lit("error")))))


def without_residue(df: DataFrame, residue: DataFrame, key: str) -> DataFrame:
    """The records that hold content: rows whose key isn't in ``residue`` (null keys stay)."""
    return df.join(residue.select(key).distinct(), key, "left_anti")
