"""Documents: text out of markup, differences between versions, search postings."""

from __future__ import annotations

import difflib
import html
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions.ids import file_ending
from rollcall.functions.text import clean_text, drop_nul, keep_matching_lines

_VOID = {"br", "hr", "img", "input", "meta", "link", "col", "area", "base", "wbr", "source", "embed"}
_SKIP = {"script", "style", "head", "title"}
_BLOCKS = {"p", "div", "br", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "table", "ul", "ol", "pre", "blockquote"}


class _Picker(HTMLParser):
    """Text of the elements that fit (tag, class, id); of all the document if nothing is asked for."""

    def __init__(self, tag: str, cls: str, ident: str):
        super().__init__(convert_charrefs=True)
        self.want = (tag, cls, ident)
        self.stack: list[tuple[str, bool]] = []
        self.skipped = 0
        self.found: list[list[str]] = [] if any(self.want) else [[]]
        self.open = 0 if any(self.want) else 1

    def _fits(self, tag: str, attrs: dict) -> bool:
        t, c, i = self.want
        return any(self.want) and (not t or tag == t) and (not c or c in (attrs.get("class") or "").split()) and (not i or attrs.get("id") == i)

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCKS and self.open:
            self.found[-1].append("\n")
        if tag in _VOID:
            return
        fits = not self.open and self._fits(tag, dict(attrs))
        if fits:
            self.found.append([])
            self.open = 1
        self.skipped += tag in _SKIP
        self.stack.append((tag, fits))

    def handle_endtag(self, tag):
        if not any(t == tag for t, _ in self.stack):
            return
        while self.stack:
            t, fits = self.stack.pop()
            self.skipped -= t in _SKIP
            if fits:
                self.open = 0
            if t == tag:
                break
        if tag in _BLOCKS and self.open:
            self.found[-1].append("\n")

    def handle_data(self, data):
        if self.open and not self.skipped:
            self.found[-1].append(data)


def pick_html(source: str, tag: str = "", cls: str = "", ident: str = "") -> list[str]:
    parser = _Picker(tag, cls, ident)
    parser.feed(source)
    parser.close()
    return [re.sub(r"[ \t\r\f\v\xa0]*\n[\s]*", "\n", "".join(x)).strip() for x in parser.found]


def html_text(c: Column, tag: str = "", cls: str = "", ident: str = "", single: bool = False, places: tuple[int, ...] = ()) -> Column:
    """Text of the fitting elements, one after the other; with ``single`` null unless exactly one fits, with ``places`` only those."""
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        def one(x):
            if x is None:
                return None
            found = pick_html(x, tag, cls, ident)
            if places:
                found = [found[i] for i in places if i < len(found)]
            return (found[0] if len(found) == 1 else None) if single else "\n".join(found)
        return pages.map(one)
    return run(c)


def xml_text(c: Column, without: tuple[str, ...] = ("metadata",)) -> Column:
    """All text of an XML document but that of ``without`` elements; what doesn't parse is read with its tags taken out."""
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        def texts(e, out):
            if e.tag.rpartition("}")[2] in without:
                return
            out.append(e.text or "")
            for child in e:
                texts(child, out)
                out.append(child.tail or "")

        def one(x):
            if x is None:
                return None
            out: list[str] = []
            try:
                texts(ElementTree.fromstring(x.encode("utf-8")), out)
            except ElementTree.ParseError:
                bare = x
                for w in without:
                    bare = re.sub(rf"(?s)<(?:\w+:)?{w}\b.*?</(?:\w+:)?{w}\s*>", "", bare)
                out = [html.unescape(re.sub(r"<[^>]*>", "", bare))]
            return re.sub(r"\s+", " ", "".join(out)).strip()
        return pages.map(one)
    return run(c)


@dataclass
class Conversions:
    """How the texts of a state's media are read: by (state, media type), else by the medium alone; some aren't read on purpose.

    A converter is a function of the content's column and the title's. New states and media are added by ``add``.
    """
    special: dict[tuple[str, str], Callable[[Column, Column], Column]] = field(default_factory=dict)
    skipped: set[tuple[str, str]] = field(default_factory=set)

    def add(self, state: str, media: str, convert: Callable[[Column, Column], Column]) -> Conversions:
        self.special[state, media] = convert
        return self

    def skip(self, state: str, media: str) -> Conversions:
        self.skipped.add((state, media))
        return self


def standard_conversions() -> Conversions:
    """States whose documents need more than their medium tells.

    Virginia's pages are bare paragraphs. Delaware's concurrent resolutions (HCR) exist as numbered print only, all else of
    it is read from pages, where the text stands in the second and third block.
    """
    resolution = lambda title: F.coalesce(title, F.lit("")).contains("HCR")
    return (Conversions()
            .add("va", "text/html", lambda c, _: html_text(c, tag="p"))
            .add("de", "text/html", lambda c, title: F.when(~resolution(title), html_text(c, tag="div", places=(1, 2))))
            .add("de", "application/pdf", lambda c, title: F.when(resolution(title), keep_matching_lines(c, r"^\s*\d+\s+(\S.*)$")).otherwise("")))


def extract_text(df: DataFrame, content: str, media: str, out: str = "text", state: str | None = None, title: str | None = None, conversions: Conversions | None = None) -> DataFrame:
    """Bytes or text of mixed media to clean text, with ``is_error`` and ``skipped`` (why there is none, or null).

    ``conversions`` by ``state`` and medium come before the medium's own reader; media without a reader give null, a blank text is an error.
    """
    raw, kind = F.col(content).cast("string"), F.lower(F.trim(F.split(F.coalesce(media, F.lit("")), ";")[0]))
    ending = file_ending(F.col(media))
    text = F.when(ending == "html", html_text(raw)).when(ending == "xml", xml_text(raw)).when(ending == "txt", raw)
    skipped = F.when(~ending.isin("html", "xml", "txt"), "no extractor")
    if conversions is not None and state is not None:
        head = F.col(title) if title else F.lit(None).cast("string")
        for (at, of), convert in conversions.special.items():
            fits = (F.col(state) == at) & (kind == of)
            text = F.when(fits, convert(raw, head)).otherwise(text)
            skipped = F.when(~fits, skipped)
        for at, of in sorted(conversions.skipped):
            text = F.when((F.col(state) == at) & (kind == of), F.lit(None)).otherwise(text)
            skipped = F.when((F.col(state) == at) & (kind == of), "do not download").otherwise(skipped)
    made = df.withColumn(out, drop_nul(clean_text(text))).withColumn("skipped", skipped)
    return made.withColumn("is_error", F.coalesce(F.trim(out), F.lit("")) == "")


def read_again(df: DataFrame, content: str, media: str, stored: str, **how) -> DataFrame:
    """Documents that had errors (``was_error``), read again: ``stored`` takes the text where there is one now; see ``reports.retried`` for the counts."""
    again = extract_text(df.filter("was_error"), content, media, "__again", **how)
    return again.withColumn(stored, F.when(F.col("is_error"), F.col(stored)).otherwise(F.col("__again"))).drop("__again")


def unified_diff(prior: Column, text: Column, context: int = 3) -> Column:
    """Lines that differ between two texts, in unified form; null without a prior text, empty if they are the same."""
    @F.pandas_udf("string")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else "\n".join(difflib.unified_diff(x.splitlines(), y.splitlines(), lineterm="", n=context)) for x, y in zip(a, b, strict=True)], dtype=object)
    return run(prior, text)


def diff_counts(diff: Column) -> tuple[Column, Column]:
    """(lines added, lines removed) of a unified difference."""
    rows = F.split(diff, "\n")
    return (F.size(F.filter(rows, lambda x: x.startswith("+") & ~x.startswith("+++"))), F.size(F.filter(rows, lambda x: x.startswith("-") & ~x.startswith("---"))))


def recompute(stored: Column, fresh: Column) -> Column:
    """What became of a stored difference: ``unchanged``, ``corrected`` or ``nulled``."""
    return F.when(stored.eqNullSafe(fresh), "unchanged").when(fresh.isNull(), "nulled").otherwise("corrected")


# fixed values: words that say nothing in a search
STOP_WORDS = ("a about after all also an and any are as at be because been before being but by can could did do does for from had has have he her him his how i if in into is it its may me more most my no nor not of off on "
              "only or other our out over own same she should so some such than that the their them then there these they this those through to too under until up very was we were what when where which while who whom why will with would you your").split()


def tokens(c: Column) -> Column:
    """Lower-case words of letters and digits, without stop words."""
    words = F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+"), 0)
    return F.filter(words, lambda w: ~w.isin(STOP_WORDS))


def postings(df: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    """(token, ``key``, weight, tf): how often a token stands in a field; ``fields`` maps columns to weights A, B, …"""
    parts = [df.select(F.col(key), F.lit(w).alias("weight"), F.explode(tokens(F.col(c))).alias("token")) for c, w in fields.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("token", key, "weight").agg(F.count("*").alias("tf"))


def latest_text(df: DataFrame, bill: str, date: str, note: str, text: str, tiebreak: str) -> DataFrame:
    """The text a search index takes: of a bill's latest version (date, then note, descending) the first document that has any."""
    d = F.coalesce(F.col(date), F.lit(""))
    n = F.coalesce(F.col(note), F.lit(""))
    newest = df.groupBy(bill).agg(F.max(F.struct(d.alias("d"), n.alias("n"))).alias("v"))
    of_newest = df.join(newest, bill).filter((d == F.col("v.d")) & (n == F.col("v.n")))
    usable = F.when(F.length(F.trim(text)) > 0, F.struct(F.col(tiebreak)))
    return of_newest.groupBy(bill).agg(F.min_by(F.col(text), usable).alias(text)).withColumn("is_error", F.col(text).isNull()).withColumn(text, F.coalesce(text, F.lit("")))
