"""Acts as lines: one pass with a little memory, for text-only pages and for markdown. What a line opens, continues or
ends is decided by the part of the act the pass is in; only the rules of the preamble differ between the two."""

from __future__ import annotations

import re

from . import recitals as R
from .splitter import quoted_regions, split_article

#: Put before a line that opens an article whatever stands around it.
FORCED = "\x01"


def looks_like_title(line: str) -> bool:
    """A short capitalised line without the signs of a sentence, behind a bare article head."""
    if not line or len(line) > 60 or "." in line or line[-1] in ":;,-" or not line[0].isupper():
        return False
    words = line.lower().split()
    return "shall" not in re.findall(r"\w+", line.lower()) and not (words[0] == "this" and words[1:2] and re.match(r"regulation|decision|directive", words[1]))


class Preamble:
    """Recitals before the first article. feed() takes a line, close() ends the recital at hand."""

    least = 3

    def __init__(self):
        self.out: list[dict] = []
        self.zone = False
        self.number: int | None = None  # of the last numbered recital
        self.open: list[str] | None = None  # parts of the recital at hand
        self.label: str | None = None
        self.count = 0

    def begin(self, label: str, *parts: str) -> None:
        self.close()
        self.label, self.open = label, [p for p in parts if p]

    def text(self) -> str:
        return " ".join(self.open)

    def close(self) -> None:
        if self.open is not None and (R.letters(" ".join(self.open)) >= self.least) and (u := R.recital(self.label, self.text(), self.least)):
            self.out.append(u)
        self.open = None

    def counted(self, line: str) -> None:
        self.count += 1
        self.begin(str(self.count), line)


class TextPreamble(Preamble):
    """Of a text-only page: numbers only rise, and a recital that counts itself by 'Whereas' is one line."""

    def text(self) -> str:
        return f"({self.label}) " + " ".join(self.open)

    def single(self, label: str, line: str) -> None:
        self.close()
        if u := R.recital(label, line):
            self.out.append(u)

    def start(self, n: int, body: str) -> None:
        self.zone, self.number = True, n
        self.begin(str(n), body)

    def feed(self, line: str, column: bool) -> None:
        """column: the line is one of several bare markers in a row, as a table has them."""
        if line.rstrip(":").upper() == "WHEREAS":
            self.close()
            self.zone, self.number = True, None
            return
        got = R.numbered(line)
        noise = bool(got) and (R.refers(got[1]) or R.cites(got[1]))
        if self.zone:
            if got and not column and (self.number is None or got[0] > self.number):
                if not noise:
                    self.start(*got)
            elif plain := self.plain(line):
                self.start(*plain)
            elif self.open is not None:
                self.open.append(line)
            return
        up = line.upper()
        dotted = re.match(r"(?is)(\d+)\.\s+(whereas\b.*)$", line)
        if got and "WHEREAS" in up:
            self.start(*got)
        elif dotted:
            self.single(dotted.group(1), dotted.group(2))
        elif "WHEREAS" in up[:50]:
            self.count += 1
            self.single(str(self.count), line)
        elif got and not noise and (got[0] == 1 or self.out):
            self.start(*got)

    def plain(self, line: str) -> tuple[int, str] | None:
        """'2 Text' that follows on number 1, unless it is a date or a value."""
        m = re.match(r"(?s)(\d{1,3})\s+(.+)$", line)
        if not m or int(m.group(1)) != (self.number or 0) + 1:
            return None
        body = m.group(2).lstrip("'\"‘’“”([")
        if not body or (re.match(r"[a-z]+", body.lower()) or [""])[0] in R.MONTHS:
            return None
        return (int(m.group(1)), m.group(2)) if body[0].isupper() or re.match(r"\d+(?:\.\d+)*\.\s+\S", body) else None


class MarkdownPreamble(Preamble):
    """Of markdown: lines stay as they are, numbers may restart, and lines go on with the recital at hand."""

    #: Lines that open the recitals (fixed values; the last two are how translators put the first).
    ZONES = ("whereas", "considering", "considering the following", "having regard to the following")

    def feed(self, line: str, column: bool) -> None:
        body = re.sub(r"^#{1,3}\s+", "", line)
        if " ".join(body.rstrip(": ").lower().split()) in self.ZONES:
            self.close()
            self.zone = True
            return
        got = R.numbered(line, dash=True)
        small = bool(got) and got[1][:1].islower() and got[1][:1].isascii()
        if self.zone:
            if got and R.cites(got[1]):
                return
            if got:
                at = int(self.label) if self.open is not None else None
                if at is not None and got[0] <= at and small:
                    self.open.append(line)
                elif at is not None or not small or got[0] == 1:
                    self.begin(str(got[0]), line)
            elif self.open is not None:
                self.open.append(line)
            return
        low = line.lower()
        says = re.search(r"\b(?:whereas|considering)\b", low)
        if got and (re.match(r"(?:whereas|considering)\b", got[1].lower()) or (self.open is None and says and not R.begins(got[1] + " ", R.FRAGMENT))):
            self.zone = True
            self.begin(str(got[0]), line)
        elif re.match(r"(?:whereas|considering(?: that)?)[\s,;]", low):
            self.counted(line)
        elif self.open is not None:
            self.open.append(line)


def _column_marks(lines: list[str]) -> set[int]:
    """Bare '(n)' lines that follow on each other."""
    mark = [bool(re.fullmatch(r"\(\d+\)\s*", x)) for x in lines] + [False]
    return {i for i, m in enumerate(mark) if m and (mark[i + 1] or (i and mark[i - 1]))}


def run_lines(lines: list[str], markdown: bool = False, granularity: str = "article") -> list[dict]:
    """Units of an act in the order in which they end."""
    lines = [x.strip() for x in lines if x and x.strip()]
    at, starts = 0, []
    for x in lines:
        starts.append(at)
        at += len(x) + 1
    regions = quoted_regions("\n".join(lines))
    columns = set() if markdown else _column_marks(lines)
    pre = MarkdownPreamble() if markdown else TextPreamble()
    annex_of = R.md_annex_head if markdown else R.annex_head
    out: list[dict] = []
    article: dict | None = None
    annex: dict | None = None
    signed = formula = after_division = False

    def finish() -> None:
        nonlocal article, annex
        pre.close()
        out.extend(pre.out)
        pre.out = []
        if article is not None:
            parts, title = article["parts"], article["title"]
            if title and not parts:  # one line that only looked like a title
                parts, title = [title], None
            out.extend(split_article(parts, article["num"], title, granularity, not markdown))
        if annex is not None:
            u = R.annex(annex["num"], annex["title"], annex["parts"])
            if u or not markdown:
                out.append(u or R.unit("annex", None, ""))
        article = annex = None

    def opens_article(i: int, line: str, forced: bool) -> tuple[str, str] | None:
        head = R.article_head(re.sub(r"^#{1,3}\s+", "", line) if markdown else line)
        if not head or (not forced and any(a <= starts[i] < b for a, b in regions)):
            return None
        num, rest = head
        if R.bare(rest):
            nxt = lines[i + 1] if i + 1 < len(lines) else ""
            if nxt and (nxt[0].islower() or re.match(r"\(\d+\)\s*(?:of\b|thereof)", nxt)):
                return None
            return num, rest if markdown else ""
        return None if R.reference(rest) and not (formula and rest[0].isupper()) else (num, rest)

    for i, line in enumerate(lines):
        forced = line.startswith(FORCED)
        line = line.removeprefix(FORCED)
        head = annex_of(line)
        if signed:
            if head:
                finish()
                annex = {"num": head[0], "title": head[1], "parts": []}
            elif annex is not None and not R.JOURNAL_NOTE.match(line.removeprefix("-").lstrip() if markdown else line) and (markdown or not (R.division(line) or R.MARK.match(line))):
                annex["parts"].append(line)
            continue
        if R.DONE_AT.match(line):
            if not markdown:
                pre.close()
            signed = True
            if article or annex:
                (article or annex)["parts"].append(line)
            continue
        if not markdown:
            if R.division(line):
                after_division = True
                continue
            if R.MARK.match(line):
                continue
            caption = after_division and len(line) < 80 and re.fullmatch(r"[A-Z][A-Z\s,\-/()]+", line)
            after_division = False
            if caption:
                continue
        if R.FORMULA.match(re.sub(r"^#{1,3}\s+", "", line) if markdown else line):
            if not markdown or pre.zone or pre.open is not None:
                pre.close()
                pre.zone = False
            formula = True
            if markdown:
                continue
        if got := opens_article(i, line, forced):
            finish()
            pre.zone = False
            article = {"num": got[0], "title": None, "parts": [got[1]] if got[1] else []}
        elif head:
            finish()
            pre.zone = False
            annex = {"num": head[0], "title": head[1], "parts": []}
        elif annex is not None:
            annex["parts"].append(line)
        elif article is not None:
            if not markdown and not article["parts"] and article["title"] is None and looks_like_title(line):
                article["title"] = line
            else:
                article["parts"].append(line)
        else:
            pre.feed(line, i in columns)
    finish()
    return out
