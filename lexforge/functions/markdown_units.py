"""Acts in markdown, as a PDF reader gives it: repairs of the lines, the line machine, and the merge with the text
layer. The repairs are plain functions over lists of lines, each of which leaves lines alone that it is not sure of."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType

from . import recitals as R
from .machine import FORCED, run_lines
from .splitter import UNIT, quoted_regions, unit

ACTS = ("regulation", "directive", "decision")
_FORMULA = re.compile(r"(?i)\bha(?:s|ve)\s+(?:adopted|decided|agreed)(?:\s+this\s+\w+|\s+as\s+follows)?\s*:?")
_HEAD_AT_END = re.compile(r"(?i)(?<!\w)(?:sole\s+)?article\s+(\d+)[a-z]*\s*$")
_BARE_HEAD = re.compile(r"(?i)(?:#{1,3}\s+)?(?:sole\s+)?article(?!s)(?:\s+\d+[a-z]*)?\s*$")
_SIGNATORY = re.compile(r"(?i)(?:for\s+(?:the\s+)?(?:commission|council)|the\s+president)\b")
_ANNEX_LINE = re.compile(r"(?i)#{1,3}\s+annex\b")
_ONLY_ANNEX = re.compile(r"(?i)#{1,3}\s+annex(?:\s+[ivxlcdm0-9]+)?$")
#: Words that name an instrument of its own (fixed values).
INSTRUMENTS = ("AGREEMENT", "PROTOCOL", "CONVENTION", "RESOLUTION", "ARRANGEMENT", "EXCHANGE OF LETTERS", "MEMORANDUM")
#: Small words of a title (fixed values).
SMALL = {"and", "between", "by", "concerning", "for", "in", "of", "on", "the", "to", "with"}


def _this_act(line: str, goes_on: str) -> bool:
    """Whether a line begins 'This Regulation shall ...'."""
    w = line.lower().split()
    return len(w) > 2 and w[0] == "this" and w[1] in ACTS and " ".join(w[2:]).startswith(goes_on)


def _next_text(lines: list[str], i: int) -> str:
    return next((x for x in lines[i + 1 :] if x), "")


def join_split_headings(lines: list[str]) -> list[str]:
    """'... Article' above '1 ...', 'ANNEX' above 'I'."""
    out: list[str] = []
    for x in lines:
        last = (re.findall(r"\w+$", out[-1]) or [""])[0].lower() if out else ""
        if (last == "article" and re.match(r"\d+\b", x)) or (last == "annex" and re.match(r"(?i)(?:[ivxlcdm]+|\d+)\b", x)):
            out[-1] += " " + x
        else:
            out.append(x)
    return out


def markers_out_of_tables(lines: list[str]) -> list[str]:
    """'... Article 2 This Decision shall ... Article 3' at the end of a row of a long table: both articles go before the
    line of publication, whatever quotation the table is in."""
    for i, x in enumerate(lines):
        end = _HEAD_AT_END.search(x)
        heads = [m for m in R.heads_with_text(x) if m.start() and end and m.end() < end.start()]
        head = next((m for m in heads if _this_act(x[m.end() : end.start()].strip(), "shall")), None)
        if head is None:
            continue
        kind = x[head.end() :].split()[1].lower()
        at = next((j for j in range(i + 1, len(lines)) if lines[j].lower().startswith(f"this {kind} shall be published")), None)
        if at is not None:
            moved = [FORCED + head.group(), x[head.end() : end.start()].strip(), FORCED + end.group().strip()]
            return [*lines[:i], x[: head.start()].strip(), *lines[i + 1 : at], *moved, *lines[at:]]
    return lines


def split_flattened(lines: list[str]) -> list[str]:
    """From the formula on, articles that were run into a line get lines of their own, outside quotations.

    An article head with text counts behind a sign, one at the end of a line only if the next line begins the last
    article. 'Article 1' at the end of the formula's own line is a head that columns have put behind the end of its
    text: it goes first, and that end goes behind the text, before the next head or the end of the operative part.
    """
    regions = quoted_regions("\n".join(lines))
    out: list[str] = []
    started, late, at = False, "", 0

    def quoted(i: int) -> bool:
        return any(a <= i < b for a, b in regions)

    def put(piece: str, ends_text: bool) -> None:
        nonlocal late
        if ends_text and late:
            out.append(late)
            late = ""
        if piece:
            out.append(piece)

    for i, line in enumerate(lines):
        begin, at = at, at + len(line) + 1
        if line.startswith(FORCED):
            out.append(line)
            continue
        formula = next((m for m in _FORMULA.finditer(line) if not quoted(begin + m.start())), None)
        last = _this_act(_next_text(lines, i), "shall")
        rest = 0
        if formula:
            put(line[: formula.start()].strip(), True)
            out.append(formula.group().strip())
            started, rest = True, formula.end()
            end = _HEAD_AT_END.search(line, rest)
            if end and end.group(1) == "1" and not quoted(begin + end.start()):
                out.append(end.group().strip())
                late = line[rest : end.start()].strip()
                continue
        elif started and late and (R.DONE_AT.match(line) or _SIGNATORY.match(line) or re.match(r"(?i)(?:#{1,3}\s*)?annex\b", line)):
            put("", True)
        if not started:
            out.append(line)
            continue
        places = [rest + m.start() for m in R.heads_with_text(line, rest)]
        cuts = [c for c in places if not quoted(begin + c) and (line[rest:c].rstrip() or ":")[-1] in ":.;|!?"]
        end = _HEAD_AT_END.search(line, rest) if last else None
        if end and not quoted(begin + end.start()) and end.start() not in cuts:
            cuts.append(end.start())
        put(line[rest : min(cuts, default=len(line))].strip(), False)
        for a, b in zip(cuts, [*cuts[1:], len(line)]):
            put(line[a:b].strip(), True)
    put("", True)
    return out


def annex_before_table(lines: list[str]) -> list[str]:
    """Annex headings behind the last table, with nothing after them, go before it."""
    head = len(lines)
    while head and _ONLY_ANNEX.match(lines[head - 1]):
        head -= 1
    if head == len(lines):
        return lines
    rows = [i for i in range(head) if lines[i].startswith("|")]
    if not rows:
        return lines
    first = rows[-1]
    while first and lines[first - 1].startswith("|"):
        first -= 1
    return lines[:first] + lines[head:] + lines[first:head]


def without_leading_signature(lines: list[str]) -> list[str]:
    """A signature that was read before the title goes, if a title and a formula follow."""
    if lines and R.DONE_AT.match(lines[0]):
        at = next((i for i, x in enumerate(lines) if re.match(r"(?i)#{1,3}\s+(?:commission|council|european\s+parliament)\s+(?:regulation|directive|decision)\b", x)), None)
        if at is not None and any(R.FORMULA.match(x) for x in lines[at:]):
            return lines[at:]
    return lines


def _attachment(x: str) -> bool:
    """Whether a line begins an instrument of its own: a heading, an instrument's name, capitals, or a title."""
    if re.match(r"#{1,3}\s+\S", x) or any(re.search(rf"\b{w}\b", x.upper()) for w in INSTRUMENTS):
        return True
    if len(x) > 240:
        return False
    words = re.findall(r"[^\W\d_]+", x)
    if R.letters(x) >= 4 and sum(c.isupper() for c in x) / R.letters(x) >= 0.8:
        return True
    return 2 <= len(words) <= 20 and x[-1] not in ".,;:" and all(w.lower() in SMALL or w[0].isupper() for w in words)


def operative_before_signature(lines: list[str]) -> list[str]:
    """An operative block that was read behind the signature is put back before it, unless an attachment begins there."""
    formula = lambda x: R.FORMULA.match(x.lstrip("# "))
    sig = next((i for i, x in enumerate(lines) if R.DONE_AT.match(x) and any(formula(y) or _BARE_HEAD.match(y) for y in lines[i + 1 :])), None)
    if sig is None:
        return lines
    begin = next((i for i in range(sig + 1, len(lines)) if formula(lines[i])), None)
    end = next((i for i in range(sig + 1 if begin is None else begin, len(lines)) if _ANNEX_LINE.match(lines[i]) or _SIGNATORY.match(lines[i])), len(lines))
    if begin is not None:
        if any(map(_attachment, lines[sig + 1 : begin])):
            return lines
        return lines[:sig] + lines[begin:end] + lines[sig:begin] + lines[end:]
    first = next((i for i in range(sig + 1, end) if _BARE_HEAD.match(lines[i])), None)
    if first is None or first - sig > 6 or any(map(_attachment, lines[sig + 1 : first])):
        return lines
    at = next((i for i in range(sig) if _this_act(lines[i], "shall be binding")), sig)
    return lines[:at] + lines[sig + 1 : end] + lines[at : sig + 1] + lines[end:]


def repair(text: str) -> list[str]:
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    for step in (join_split_headings, markers_out_of_tables, split_flattened, annex_before_table, without_leading_signature, operative_before_signature):
        lines = step(lines)
    return lines


def markdown_units(text: str, granularity: str = "article", recitals: bool = True, articles: bool = True, annexes: bool = True) -> list[dict]:
    keep = {k for k, v in (("recital", recitals), ("article", articles), ("annex", annexes)) if v}
    if not keep:
        return []
    out = [u for u in run_lines(repair(text), True, granularity) if u["type"] in keep]
    if not out and articles and text.strip():
        return [unit("body", None, text.strip())]
    return out


def _page_mark(w: str) -> bool:
    """Whether a word is of the kind that stands beside the name of the journal in a page heading."""
    return w in ("EN", "No", "L", "C") or (any(c.isdigit() for c in w) and not any(c.islower() for c in w))


def sanitise_recovered(text: str) -> str:
    """An article of the text layer up to a preamble that was read into it, without page headings, notes to the journal and
    broken dates; '' where nothing else is left."""
    words = text.split()
    for i, w in enumerate(words):
        if w in ("Whereas", "Whereas:") or words[i : i + 3] == ["Having", "regard", "to"]:
            words = words[:i]
            if words and words[-1].endswith(",") and "THE" in words:  # the institution before it
                last = len(words) - 1 - words[::-1].index("THE")
                words = words[:last] if all(x.strip(",").isupper() for x in words[last:]) else words
            break
    journal = "Official Journal of the European Communities".split()
    at = next((i for i in range(len(words)) if words[i : i + len(journal)] == journal), None)
    if at is not None:
        before, after = words[:at], words[at + len(journal) :]
        while before and _page_mark(before[-1]):
            before.pop()
        while after and not before and _page_mark(after[0]):
            after.pop(0)
        words = before or after
    for i, w in enumerate(words):
        where = [x for x in words[i + 1 : i + 3] if x != "No"][:1]
        if w == "OJ" and where and where[0][0] in "LC":
            mark = i - 1 if i and len(words[i - 1].strip("()[]")) <= 4 else i
            words = words[:mark]
            break
    while len(words) > 2 and words[-3].endswith(".") and words[-2] == "No" and words[-1][0] in "LC":
        words = words[:-2]
    dates = all(w.strip(".,=").isdigit() or w in ("p.", "p") or not w.strip(".,=") for w in words)
    return "" if dates and len(words) <= 5 else " ".join(words)


def merge_text_layer(units: list[dict], layer: list[dict]) -> list[dict]:
    """Articles of the text layer fill gaps if its sequence is whole, longer and holds all of the other's numbers; the
    text of a number that both have is the first reader's. Order: recitals, articles, others, annexes."""
    nums = lambda us: [u["number"] for u in us if u["type"] == "article" and u["number"]]
    a, b = list(dict.fromkeys(nums(units))), list(dict.fromkeys(nums(layer)))
    if not (b and R.sequence_ok(b) and len(b) > len(a) and set(a) <= set(b)):
        return units
    own: dict[str, list[dict]] = {}
    for u in units:
        if u["type"] == "article":
            own.setdefault(u["number"], []).append(u)
    arts = []
    for n in b:
        for u in own.get(n) or [x for x in layer if x["type"] == "article" and x["number"] == n]:
            text = u["text"] if n in own else sanitise_recovered(u["text"] or "")
            if text or u["title"] or n in own:
                arts.append(u | {"text": text})
    of = lambda *k: [u for u in units if u["type"] in k]
    return of("recital") + arts + of("paragraph", "footnote", "body") + of("annex")


@F.pandas_udf(ArrayType(UNIT))
def _markdown(s: pd.Series, g: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else markdown_units(x, gi) for x, gi in zip(s, g)])


def md_units(text: Column, granularity: str = "article") -> Column:
    return _markdown(text, F.lit(granularity))
