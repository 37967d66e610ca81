"""Bill texts as they are compared: what a print carries beside the text is left out, and sentences are laid out anew.

Nothing here is a list of one state's phrases: each line is told by what it consists of (``kind_of_line``), and a
profile says which kinds a state's prints carry and how their lines are laid out.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, functions as F

# fixed values: words of legislative prints
BODIES = frozenset("senate house assembly legislature".split())
PAPERS = frozenset("bill resolution substitute amendment act acts chapter session introduced enrolled engrossed reprint".split())
SPONSORS = frozenset("patron patrons sponsor sponsors cosponsors introducer introducers".split())
STEPS = frozenset("offered prefiled referred read passed proposed reported".split())
MONTHS = frozenset("january february march april may june july august september october november december".split())
# fixed values end
ALL_KINDS = frozenset({"page", "rule", "stamp", "sponsor", "step", "heading", "tag"})


@dataclass(frozen=True)
class Profile:
    """Kinds of lines that are left out, and the layout; ``begins`` is where the text begins, all before it is left out."""
    kinds: frozenset[str] = frozenset()
    begins: str = ""              # words in lower case; with ``after`` the text begins behind them
    after: bool = False
    margin: bool = False          # numbers of lines in the margin, and the bill's number at the end of lines
    pages: bool = False           # form feeds, with what stands around them
    codes: bool = False           # drafting codes inside lines
    least: int = 0                # pairs with a shorter text stay as they are
    width: int = 0                # lines of at most so many characters; 0: a sentence a line
    reflow: str = "always"        # always, or media: only if the two came as different media
    blocks: bool = False          # sentences don't go across blank lines
    bills_only: bool = False


PROFILES = {
    "az": Profile(blocks=True),
    "va": Profile(kinds=ALL_KINDS, margin=True, least=300, width=90, reflow="media"),
    "wa": Profile(kinds=frozenset({"page", "rule", "stamp"}), begins="an act", codes=True, width=55),
    "mi": Profile(begins="the people of the state of michigan enact", after=True, margin=True, pages=True, width=65, reflow="media", bills_only=True),
}


def _bare(word: str) -> str:
    return word.strip(".,:;()[]{}*_-–—\"'").lower()


def _numeric(word: str) -> bool:
    """A number, a date or a time of day as one word, or half of a clock."""
    parts = word.replace("/", ":").replace("-", ":").rstrip(",").split(":")
    return word.lower().strip(".") in ("am", "pm") or all(p.isdigit() for p in parts)


def kind_of_line(line: str) -> str | None:
    """What a line of a print is beside the text: page, rule, stamp, sponsor, step, heading or tag; null for text."""
    words = line.split()
    if not words:
        return None
    if not any(c.isalnum() for c in line):
        return "rule"
    bare = [_bare(w) for w in words]
    number = bare[0][:-1] if bare[0][-1:].isalpha() else bare[0]
    if len(words) == 1 and number.isdigit() and len(number) <= 9:
        return "page"
    if len(words) > 1 and all(_numeric(w) for w in words):
        return "stamp"
    if len(words) <= 3 and line.strip().startswith("[") and line.strip().endswith("]"):
        return "tag"
    if bare[0].replace("—", "-").partition("-")[0] in SPONSORS:
        return "sponsor"
    if bare[0] in STEPS and (set(bare) & (MONTHS | {"committee", "by"})):
        return "step"
    letters = [c for c in line if c.isalpha()]
    if letters and len(words) <= 12 and all(c.isupper() for c in letters) and not line.rstrip().endswith((".", ";")) and set(bare) & (BODIES | PAPERS):
        return "heading"
    return None


def _without_margin(rows: list[str]) -> list[str]:
    """Rows without the numbers a margin counts them by, and without a bill's number set far to the right."""
    heads = [r.split(None, 1) for r in rows]
    counted = sum(1 for h in heads if len(h) == 2 and h[0].isdigit() and len(h[0]) <= 3)
    numbered = counted * 2 > sum(1 for h in heads if h)
    out = []
    for row, head in zip(rows, heads, strict=True):
        if len(head) == 2 and head[0].isdigit() and len(head[0]) <= 3:
            gap = len(row.lstrip()) - len(head[0]) - len(head[1])
            if numbered or gap > 1 or "\t" in row:
                row = head[1]
        left, gap, last = row.rstrip().rpartition("   ")
        if gap and left and any(c.isdigit() for c in last) and last.strip().isalnum() and last.strip()[0].isalpha() and len(last.strip()) <= 8:
            row = left.rstrip()
        out.append(row)
    return out


def _without_page_ends(text: str) -> str:
    """Pages put together: around a form feed, lines that hold a number but end no sentence go (folios, drafters' codes)."""
    pages = [p.split("\n") for p in text.split("\f")]
    furniture = lambda row: not row.strip() or (any(c.isdigit() for c in row) and not row.rstrip().endswith((".", ";", ":")) and len(row.split()) <= 6)
    for i, rows in enumerate(pages):
        while i + 1 < len(pages) and rows and furniture(rows[-1]):
            rows.pop()
        if i and rows and rows[0].strip().strip("()-").isdigit():
            del rows[0]
    return "\n".join("\n".join(rows) for rows in pages)


def _is_code(words: list[str], i: int) -> int:
    """How many words from ``i`` on are a drafting code: ``H-1234.2``, or ``p. 3 HB 1234``."""
    w = words[i]
    if len(w) > 5 and w[0].isupper() and w[1] == "-" and w[2:].replace(".", "", 1).isdigit() and "." in w:
        return 1
    if w.lower() == "p." and i + 3 < len(words) and words[i + 1].isdigit() and words[i + 2].isupper() and words[i + 3].isdigit():
        return 4
    return 0


def stripped(text: str, p: Profile) -> str:
    """The text without what its prints carry beside it."""
    if p.begins:
        folded = text.lower()
        words, at = p.begins.split(), 0
        # the words with any white space between them
        while (at := folded.find(words[0], at)) >= 0:
            end = at
            for k, w in enumerate(words):
                if not folded.startswith(w, end):
                    break
                end += len(w)
                if k < len(words) - 1:
                    rest = folded[end:]
                    end += len(rest) - len(rest.lstrip()) if rest[:1].isspace() else 0
            else:
                text = text[end:].lstrip().removeprefix(":") if p.after else text[at:]
                break
            at += 1
    rows = text.split("\n")
    if p.margin:
        rows = _without_margin(rows)
    if p.pages:
        rows = _without_page_ends("\n".join(rows)).split("\n")
    if p.kinds:
        rows = [r for r in rows if kind_of_line(r) not in p.kinds]
    if p.codes:
        kept = []
        for row in rows:
            words, i, out = row.split(" "), 0, []
            while i < len(words):
                if n := _is_code(words, i):
                    i += n
                else:
                    out.append(words[i])
                    i += 1
            kept.append(" ".join(out))
        rows = kept
    return "\n".join(rows)


def sentences(words: list[str]) -> list[list[str]]:
    """Words by sentence or clause: after a point, colon or semicolon, if the next word opens one.

    What a list item is marked by (one or two signs and a point: ``A.``, ``12.``) closes none, nor does a short word
    before a number (``Sec. 1``).
    """
    out: list[list[str]] = [[]]
    if not words:
        return []
    for word, following in zip(words, [*words[1:], ""], strict=True):
        out[-1].append(word)
        end = word.rstrip("\"'”’)")
        opens = following[:1].isupper() or following[:1].isdigit() or following[:1] in "([“\""
        label = end.endswith(".") and len(end) <= 3 and end[:-1].isalnum() and (end[:-1].isdigit() or end[:-1].isupper())
        label = label or (end.endswith(".") and len(end) <= 5 and end[:-1].isalpha() and following[:1].isdigit())
        if following and end.endswith((".", ";", ":")) and opens and not label:
            out.append([])
    return [s for s in out if s]


def laid_out(text: str, width: int, blocks: bool) -> str:
    """One sentence a line, wrapped at ``width``; with ``blocks`` a blank line stays one."""
    parts, part = [], []
    for row in text.split("\n") if blocks else [text]:
        if blocks and not row.strip() and part:
            parts.append(part)
            part = []
        part.extend(row.split())
    parts.append(part)
    done = []
    for words in parts:
        rows: list[str] = []
        for sentence in sentences(words):
            line = ""
            for word in sentence:
                if line and width and len(line) + 1 + len(word) > width:
                    rows.append(line)
                    line = word
                else:
                    line = f"{line} {word}" if line else word
            rows.append(line)
        if rows:
            done.append("\n".join(rows))
    return "\n\n".join(done)


def _cleaned(p: Profile):
    @F.pandas_udf("string")
    def run(texts: pd.Series, anew: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else laid_out(stripped(x, p), p.width, p.blocks) if again else stripped(x, p) for x, again in zip(texts, anew, strict=True)], dtype=object)

    return run


def clean_pair(state: str, prior: Column, text: Column, prior_media: Column, media: Column, is_bill: Column) -> tuple[Column, Column]:
    """Both texts as they are compared; the stored text never changes. States without a profile compare as they are."""
    p = PROFILES.get(state)
    if p is None:
        return prior, text
    anew = F.lit(True) if p.reflow == "always" else ~prior_media.eqNullSafe(media)
    if p.bills_only:
        anew = anew & is_bill
    run = _cleaned(p)
    out = [run(x, anew) for x in (prior, text)]
    if p.least:
        short = (F.length(F.trim(prior)) < p.least) | (F.length(F.trim(text)) < p.least)
        out = [F.when(short, raw).otherwise(x) for raw, x in zip((prior, text), out, strict=True)]
    return out[0], out[1]
