"""Mixed timestamp formats and time zones to one form, formats chosen by expectation-maximisation per source."""

from __future__ import annotations

import math
import re
import string
import zoneinfo
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rollcall.session import cut

# fixed values: month names in English, Spanish and French, by their first letters; zone abbreviations of the United States
MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
    "ene": 1, "abr": 4, "ago": 8, "set": 9, "dic": 12,
    "fév": 2, "fev": 2, "avr": 4, "mai": 5, "juin": 6, "juil": 7, "aoû": 8, "aou": 8, "déc": 12,
}
OFFSETS = {
    "Z": "UTC", "UTC": "UTC", "GMT": "UTC", "EST": "-05:00", "EDT": "-04:00", "CST": "-06:00", "CDT": "-05:00", "MST": "-07:00", "MDT": "-06:00",
    "PST": "-08:00", "PDT": "-07:00", "AKST": "-09:00", "AKDT": "-08:00", "HST": "-10:00", "HDT": "-09:00", "AST": "-04:00", "ADT": "-03:00",
    "SST": "-11:00", "CHST": "+10:00",
}
# fixed values end

_TIME = r"(?:(\d{1,2})(?::(\d{2}))?(?::(\d{2})(?:[.,](\d{1,9}))?)?\s*([AaPp]\.?[Mm](?![A-Za-z])\.?)?)"
_ZONE = r"(?:\s*(Z|z|[+-]\d{2}:?\d{2}|[A-Za-z]+/[A-Za-z_/+-]+|[A-Z][A-Za-z]{1,4}))"
_WEEKDAY = r"(?:\p{L}{2,10}\.?,?\s+)?"
_TAIL = rf"(?:(?:\s*[,T]\s*|\s+-\s+|\s+(?:at|a las|à)\s+|\s+){_TIME}{_ZONE}?)?"


@dataclass(frozen=True)
class Layout:
    """A way to write a time: its pattern and the groups of year, month, day (0: not stated); time follows at ``at``.

    ``opens``: how the first five characters may begin, digits being 9 and letters a; only values that do meet the pattern.
    """
    name: str
    pattern: str
    opens: tuple[str, ...]
    y: int
    m: int = 0
    d: int = 0
    at: int = 0
    prior: float = 1.0
    cells: float = 36525.0  # how many values the layout could write: its likelihood is one over it
    epoch: float = 0.0


_NUMBERS = ("9/", "99/", "9.", "99.", "9-", "99-")
LAYOUTS = [
    Layout("iso", rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}}){_TAIL}$", ("9999-",), 1, 2, 3, 4),
    Layout("compact", rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:T?(\d{{2}})(\d{{2}})(\d{{2}})?(?:\.(\d{{1,9}}))?()?{_ZONE}?)?$", ("99999",), 1, 2, 3, 4),
    Layout("ymd", rf"^(\d{{4}})[/.](\d{{1,2}})[/.](\d{{1,2}}){_TAIL}$", ("9999/", "9999."), 1, 2, 3, 4),
    Layout("mdy", rf"^(\d{{1,2}})[/.-](\d{{1,2}})[/.-](\d{{4}}|\d{{2}}){_TAIL}$", _NUMBERS, 3, 1, 2, 4),
    Layout("dmy", rf"^(\d{{1,2}})[/.-](\d{{1,2}})[/.-](\d{{4}}|\d{{2}}){_TAIL}$", _NUMBERS, 3, 2, 1, 4, prior=1e-9),
    Layout("month_day", rf"(?U)^{_WEEKDAY}(\p{{L}}{{3,10}})\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}}){_TAIL}$", ("a",), 3, 1, 2, 4),
    Layout("day_month", rf"(?U)^{_WEEKDAY}(\d{{1,2}})(?:st|nd|rd|th|er)?[\s-]+(?:de\s+|of\s+)?(\p{{L}}{{3,10}})\.?,?[\s-]+(?:de\s+)?(\d{{4}}|\d{{2}}){_TAIL}$", ("a", "9a", "99a", "9 ", "99 ", "9-", "99-"), 3, 2, 1, 4),
    Layout("month_year", r"(?U)^(\p{L}{3,10})\.?,?\s+(?:de\s+)?(\d{4})$", ("a",), 2, 1, cells=1200.0),
    Layout("year_month", r"^(\d{4})[-/.](\d{1,2})$", ("9999-", "9999/", "9999."), 1, 2, cells=1200.0),
    Layout("year", r"^(\d{4})$", ("9999",), 1, cells=100.0),
    Layout("seconds", r"^(-?\d{9,10})(?:\.\d+)?$", ("99999", "-9999"), 0, epoch=1.0, cells=3e9),
    Layout("millis", r"^(-?\d{12,13})$", ("99999", "-9999"), 0, epoch=1e-3, cells=3e12),
    Layout("micros", r"^(-?\d{15,16})$", ("99999", "-9999"), 0, epoch=1e-6, cells=3e15),
]


@dataclass(frozen=True)
class Rules:
    """``century`` is put before two-digit years; ``layouts`` are the allowed ways to write; ``prior`` overrides theirs."""
    century: int
    layouts: tuple[str, ...] = tuple(x.name for x in LAYOUTS)
    prior: dict[str, float] = field(default_factory=dict)
    rounds: int = 25
    sure: float = 0.9


#: one pattern instead of hundreds of literals, which would be planned again and again
_ZONE_NAMES = "^(?:" + "|".join(sorted(re.escape(z) for z in zoneinfo.available_timezones() if "/" in z)) + r")\z"
_SEP = "\u0001"
#: Sources times ambiguous signatures up to which what was chosen for them is broadcast.
MAX_CHOICES = 100_000


def _forms(v: Column, head: Column, layouts: list[Layout]) -> Column:
    """The forms ``v`` has, each as an array: layout, year, month, day, hour, minute, second, fraction, half, zone as written.

    Only layouts that open as the value does meet it, and each meets it in one replacement: what isn't so written
    comes back without the mark in front.
    """
    written = []
    for x in layouts:
        groups = [x.y or 1, x.m, x.d, *(x.at + i if x.at else 0 for i in range(6))]
        form = _SEP + x.name + _SEP + _SEP.join(f"${g}" if g else "" for g in groups)
        written.append(F.when(reduce(or_, [head.startswith(o) for o in x.opens]), F.regexp_replace(v, x.pattern, form)))
    return F.transform(F.filter(F.array(*written), lambda w: w.startswith(_SEP)), lambda w: F.split(w, _SEP))


def _month(text: Column) -> Column:
    low = F.lower(text)
    names = F.create_map(*[F.lit(z) for kv in MONTHS.items() for z in kv])
    return F.coalesce(text.try_cast("int"), F.try_element_at(names, F.substring(low, 1, 4)), F.try_element_at(names, F.substring(low, 1, 3)))


def _two(c: Column) -> Column:
    text = c.cast("string")
    return F.when(F.length(text) < 2, F.concat(F.lit("0"), text)).otherwise(text)


def _read(c: Column, layouts: list[Layout], century: int) -> Column:
    """struct(layout, local, zone, precision) of a form; ``local`` is null if it is no time."""
    g = lambda i: c[i + 2]
    none = F.lit(None).cast("string")
    unit = F.lit("0")
    for x in layouts:
        if x.epoch:
            unit = F.when(c[1] == x.name, F.lit(f"{x.epoch:.6f}")).otherwise(unit)
    seconds = (g(0).try_cast("decimal(20,6)") * unit.cast("decimal(7,6)")).cast("decimal(18,6)")
    instant = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    year = F.when(F.length(g(0)) == 2, F.concat(F.lit(str(century)), g(0))).otherwise(g(0))
    month = F.when(g(1) == "", F.lit(1)).otherwise(_month(g(1)))
    day = F.when(g(2) == "", F.lit(1)).otherwise(g(2).try_cast("int"))
    half = F.lower(F.substring(g(7), 1, 1))
    h = g(3).try_cast("int")
    h = F.when(half == "", h).when((h < 1) | (h > 12), F.lit(None).cast("int")).when(half == "p", h % 12 + 12).otherwise(h % 12)
    stated = g(3) != ""
    # a lone number is an hour only with a.m. or p.m.
    clear = ~stated | (h.isNotNull() & ((g(4) != "") | (half != "")))
    clock = F.when(stated, F.concat(_two(h), F.lit(":"), F.when(g(4) == "", "00").otherwise(g(4)), F.lit(":"), F.when(g(5) == "", "00").otherwise(g(5)),
                                    F.lit("."), F.rpad(F.substring(g(6), 1, 6), 6, "0"))).otherwise(F.lit("00:00:00"))
    offset = F.regexp_replace(g(8), r"^([+-]\d{2}):?(\d{2})$", "$1:$2")
    short = F.create_map(*[F.lit(z) for kv in OFFSETS.items() for z in kv])
    zone = (F.when(g(8) == "", none)
            .when(offset.rlike(r"^[+-](0\d|1[0-7]):[0-5]\d$"), offset)
            .when(g(8).contains("/") & g(8).rlike(_ZONE_NAMES), g(8))
            .otherwise(F.coalesce(F.try_element_at(short, F.upper(g(8))), F.lit("?"))))
    local = F.concat(year, F.lit("-"), _two(month), F.lit("-"), _two(day), F.lit(" "), clock).try_cast("timestamp_ntz")
    readable = month.isNotNull() & day.isNotNull() & clear & F.coalesce(zone != "?", F.lit(True))
    is_epoch = unit != "0"
    return F.struct(
        c[1].alias("layout"),
        F.when(is_epoch, instant).when(readable, local).alias("local"),
        F.when(is_epoch, F.lit("UTC")).otherwise(zone).alias("zone"),
        F.when(is_epoch, F.lit("instant")).when(stated, F.lit("time")).when(g(2) != "", F.lit("day")).when(g(1) != "", F.lit("month")).otherwise(F.lit("year")).alias("precision"))


def normalise_times(df: DataFrame, value: str, source: list[str], zone: Column | None, rules: Rules) -> DataFrame:
    """``df`` with ``time_status``, ``time_layout``, ``time_precision``, ``time_posterior``, ``time_utc`` and ``fuzzy_date``.

    ``time_status`` is ``resolved``, ``ambiguous`` (no layout reaches ``rules.sure``; the likeliest is given),
    ``no_zone`` (neither the value nor ``zone`` gives one), ``unreadable`` or ``missing`` (null or blank).
    ``time_utc`` is text like ``2020-01-31T09:05:00.000000Z``; a value without zone is local time of ``zone``, a
    value without time of day is local midnight, local times that occur twice are the earlier instant and skipped
    ones move on by the length of the gap. ``fuzzy_date`` is ``YYYY[-MM[-DD]]`` as stated, zone and time dropped.
    Rows keep their other columns (columns of these six names are replaced); a null source is a source of its own.

    Method. Every value is held to every layout it can begin; the layouts it may be written in are its signature, those
    of several under which it is no time being left out. Signatures are counted per source, and per source
    expectation-maximisation weighs the layouts: a value adds to each layout of its signature its posterior (mixture
    weight x prior x likelihood), until the weights stand still. Posteriors choose the layout. Only signature counts, a
    handful a source, leave the rows: the first pass takes forms and reads just those of several layouts, the second
    reads all. The choices are broadcast if counted within ``MAX_CHOICES``, otherwise joined by a shuffle that adaptive
    execution splits where a source is hot.
    """
    df = df.drop("time_status", "time_layout", "time_precision", "time_posterior", "time_utc", "fuzzy_date")
    layouts = [x for x in LAYOUTS if x.name in rules.layouts]
    v = F.trim(F.regexp_replace(F.col(value), r"(?U)\s+", " "))
    src = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in source]) if source else F.lit("")
    readable = lambda forms: F.filter(F.transform(forms, lambda c: _read(c, layouts, rules.century)), lambda c: c["local"].isNotNull())
    forms = (df.withColumn("__src", src).withColumn("__zone", zone if zone is not None else F.lit("UTC"))
             .withColumn("__v", v).withColumn("__head", F.translate(F.lower(F.substring("__v", 1, 5)), string.digits + string.ascii_lowercase, "9" * 10 + "a" * 26))
             .withColumn("__forms", _forms(F.col("__v"), F.col("__head"), layouts)).drop("__head"))
    several = F.size("__forms") > 1
    # not filtered: a condition on what is made here would be pushed below it, so that all is made twice
    signature = F.when(several, F.array_join(F.transform(readable(F.col("__forms")), lambda c: c["layout"]), ",")).otherwise(F.get(F.get("__forms", F.lit(0)), F.lit(1)))
    counted = forms.select("__src", signature.alias("__sig")).groupBy("__src", "__sig").agg(F.count("*").alias("n"))
    prior = {x.name: rules.prior.get(x.name, x.prior) / x.cells for x in layouts}
    rounds = rules.rounds

    def em(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[pdf["__sig"].fillna("") != ""]
        sigs = [s.split(",") for s in pdf["__sig"]]
        n = [float(c) for c in pdf["n"]]
        weight = dict.fromkeys({f for s in sigs for f in s}, 1.0)
        post: list[dict[str, float]] = []
        for _ in range(rounds):
            post = []
            for s in sigs:
                like = {f: weight[f] * prior[f] for f in s}
                total = sum(like.values()) or math.inf
                post.append({f: x / total for f, x in like.items()})
            total = sum(n)
            weight = {f: max(sum(c * p.get(f, 0.0) for c, p in zip(n, post, strict=True)) / total, 1e-12) for f in weight}
        best = [max(p.items(), key=lambda x: (x[1], x[0])) for p in post]
        return pd.DataFrame({"__src": list(pdf["__src"]), "__sig": list(pdf["__sig"]), "time_layout": [b[0] for b in best], "time_posterior": [b[1] for b in best]}).astype({"__src": object, "__sig": object, "time_layout": object, "time_posterior": "float64"})

    chosen = cut(counted.groupBy("__src").applyInPandas(em, "__src string, __sig string, time_layout string, time_posterior double")).filter("contains(__sig, ',')")
    few = chosen.limit(MAX_CHOICES + 1).count() <= MAX_CHOICES
    parsed = (forms.withColumn("__all", readable(F.col("__forms"))).drop("__forms")
              .withColumn("__sig", F.array_join(F.transform("__all", lambda c: c["layout"]), ",")))
    out = parsed.join(F.broadcast(chosen) if few else chosen, ["__src", "__sig"], "left")
    alone = F.size("__all") == 1
    out = (out.withColumn("time_layout", F.when(alone, F.col("__all")[0]["layout"]).otherwise(F.col("time_layout")))
           .withColumn("time_posterior", F.when(alone, F.lit(1.0)).otherwise(F.col("time_posterior"))))
    pick = F.try_element_at(F.filter("__all", lambda c: c["layout"] == F.col("time_layout")), F.lit(1))
    out = out.withColumn("__pick", pick)
    at_zone = F.coalesce("__pick.zone", "__zone")
    utc = F.convert_timezone(at_zone, F.lit("UTC"), F.col("__pick.local"))
    text = utc.cast("string")
    utc_text = F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0"), F.lit("Z"))
    date = F.substring(F.col("__pick.local").cast("string"), 1, 10)
    fuzzy = F.when(F.col("__pick.precision") == "year", F.substring(date, 1, 4)).when(F.col("__pick.precision") == "month", F.substring(date, 1, 7)).otherwise(date)
    status = (F.when(F.col("__v").isNull() | (F.col("__v") == ""), "missing").when(F.col("__pick").isNull(), "unreadable")
              .when(at_zone.isNull(), "no_zone").when(F.col("time_posterior") < rules.sure, "ambiguous").otherwise("resolved"))
    return (out.withColumn("time_status", status).withColumn("time_precision", F.col("__pick.precision"))
            .withColumn("time_utc", F.when(F.col("__pick").isNotNull() & at_zone.isNotNull(), utc_text))
            .withColumn("fuzzy_date", F.when(F.col("__pick").isNotNull(), fuzzy))
            .drop("__src", "__zone", "__v", "__all", "__sig", "__pick"))
