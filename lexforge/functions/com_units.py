"""Communications, proposals and working documents: prose under headings, from HTML of two generations or text."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType

from . import html_units as H, tree as T
from .splitter import UNIT, unit

#: Front matter and furniture that is no prose (fixed values).
SKIP_CLASSES = {
    "Logo", "Emission", "Rfrenceinstitutionnelle", "Rfrenceinstitutionelle", "cpMarking", "Typedudocument_cp", "Titreobjet_cp",
    "Prliminairetype", "Prliminairetitre", "Nomdelinstitution", "Confidentialit", "Langue", "TOCHeading", "TOC1", "TOC2", "TOC3",
    "li TOC1", "li TOC2", "li TOC3", "FootnoteText", "FootnoteReference",
}
#: Classes of headings (fixed values).
HEADING_CLASSES = {
    "li Heading1", "li Heading2", "li Heading3", "Heading1", "Heading2", "Heading3",
    "li ManualHeading1", "li ManualHeading2", "li ManualHeading3", "Heading", "li Heading", "li Heading110",
}
#: Classes of prose (fixed values).
BODY_CLASSES = {
    "Normal", "CommentText", "Default", "Text1", "Text2", "Text3", "ListParagraph", "li ListParagraph", "li Normal", "NormalWeb", "li NormalWeb",
    "li ListBullet", "li ListBullet1", "li ListBullet2", "li ManualNumPar1", "Body", "li Body", "BodyText", "li BodyText", "Bodytext10", "li Bodytext10",
    "Corps", "li Corps", "MBT", "li MBT", "EEATextbody", "li EEATextbody", "Text", "li Text", "paragraph", "li paragraph", "Textstand-alone", "DGTextstand-alone",
}
#: What begins the block of signatures (fixed values).
SIGNS = ("for the commission", "for the president", "the president")
NUMBERED = re.compile(r"\d+(?:\.\d+)*\.?\s+[A-Z]")
#: Characters that alone are noise of a scan, beside capitals and digits (fixed values).
NOISE = set(";:,.·•■-–—!?|*\\/<>'\"[](){}ijtlr")
#: Words behind a bracketed number that begin a note (fixed values).
NOTE_WORDS = ("OJ", "Council", "Commission", "See")
NOTE_BEGINNINGS = ("Second", "Third", "Initial")
#: Wording of archive covers: anywhere, at the beginning, and what must follow it (fixed values).
COVER_ANYWHERE = ("archives historiques", "collection reliee")
COVER_BEGINS = (("conformément au règlement", ""), ("in accordance with council regulation", "historical archives"), ("in übereinstimmung mit der verordnung", "historischen archive"))


def _sized(cls: str) -> str | None:
    """Kind of a class of the report templates, a name with a size: 'body', 'heading' or 'figures'."""
    m = re.match(r"([A-Za-z]+)(\d*)(p?)", cls.removeprefix("li").strip())
    if not m:
        return None
    name, size, points = m.groups()
    if name.startswith("HEADER"):
        return "heading"
    if size and name in ("BodyText", "Corps"):
        return "body"
    return {"Text": "body", "Heading": "heading", "Figures": "figures"}.get(name) if size and points else None


def is_noise(b: str) -> bool:
    return len(b) <= 4 and all(c.isspace() or c in NOISE or c.isdigit() or "A" <= c <= "Z" for c in b)


def is_capitals(b: str) -> bool:
    return len(b) >= 6 and "A" <= b[0] <= "Z" and all("A" <= c <= "Z" or c.isspace() or c in ",:()-/" for c in b)


def is_cover(b: str) -> bool:
    low = b.lower()
    return low == "disclaimer" or bool(re.match(r"vol\.\s*\d{4}", low)) or any(x in low for x in COVER_ANYWHERE) or any(low.startswith(x) and y in low for x, y in COVER_BEGINS)


def is_signature(t: str) -> bool:
    """A short line that begins like a block of signatures and does not go on in small letters."""
    low = t.lower()
    m = re.match(r"done at \w+[,\s]+\d\b", low)
    end = m.end() if m else next((len(s) for s in SIGNS if low.startswith(s) and not low[len(s) : len(s) + 1].isalnum()), 0)
    return len(t) < 40 and bool(end) and not t[end:].lstrip(" ,.")[:1].islower()


class _Prose:
    def __init__(self):
        self.heading: str | None = None
        self.n, self.out = 0, []

    def add(self, t: str, subtype: str | None = None) -> None:
        self.n += 1
        self.out.append(unit("paragraph", str(self.n), t, title=self.heading, subtype=subtype))


def _content(root: T.Node) -> list[T.Node]:
    """The boxes that hold the page: div.content, else div.contentWrapper, else the body."""
    for cls in ("content", "contentWrapper"):
        if got := [n for n in root.find("div") if n.cls == cls]:
            return got
    return root.find("body")[:1] or [root]


def modern(root: T.Node) -> list[dict]:
    p, signed = _Prose(), False
    for n in (n for box in _content(root) for n in box.children):
        if n.tag == "table":
            if p.heading is not None and (t := T.table_text(n)):
                p.add(t, "table")
        elif n.tag == "div" and "border" in n.cls:
            for x in n.find("p"):
                if x.cls not in SKIP_CLASSES and (t := x.text()):
                    p.add(t)
        elif n.tag == "p" and n.cls not in SKIP_CLASSES and _sized(n.cls) != "figures":
            t = n.text()
            signed = signed or is_signature(t)
            if not t or signed:
                continue
            body = n.cls in BODY_CLASSES or _sized(n.cls) == "body"
            if n.cls in HEADING_CLASSES or _sized(n.cls) == "heading" or (body and len(t) < 80 and re.match(r"\d+\.\d+[\.\d]*\s+[A-Z]", t)):
                p.heading = t
            elif body or not n.cls:
                p.add(t)
    return p.out


def legacy(root: T.Node) -> list[dict]:
    """Old pages: prose from the first numbered heading or long line on, up to the notes at the end."""
    only = next((n for n in root.find("div") if n.id == "TexteOnly"), None)
    if only is None:
        return []
    lines = [t for q in only.find("p") if (t := q.text())]
    first = next((i for i, x in enumerate(lines) if NUMBERED.match(x) or (len(x) > 100 and not x.startswith("[pic]"))), 0)
    end = len(lines)
    while end - 1 > first and re.match(r"\[\d+\]\s", lines[end - 1]):
        end -= 1
    p = _Prose()
    for x in lines[first:end]:
        if (NUMBERED.match(x) and len(x) < 120) or is_capitals(x):
            p.heading = x
        else:
            p.add(x)
    return p.out


def footnotes(root: T.Node) -> list[dict]:
    out = []
    for n in root.find("dd"):
        if n.id.startswith("footnote"):
            mark = next((a.text().strip().strip("()") for a in n.find("a") if a.cls == "footnote"), None)
            t = " ".join(t for q in n.find("p") if (t := q.text())) or n.text()
            if mark:
                t = t.removeprefix(f"({mark})").strip()
            if t:
                out.append(unit("footnote", mark, t))
    return out


def com_units(page: str) -> list[dict]:
    root = T.parse(page)
    notes = footnotes(root)
    T.drop_footnote_marks(root)
    out = modern(root) if H.has(root, "com_modern") else []
    if not out and H.has(root, "com_legacy"):
        out = legacy(root)
    if out or notes:
        return out + notes
    body = T.full_text(root)
    return [unit("body", None, body)] if body else []


def _is_note(b: str) -> bool:
    m = re.match(r"(?:\[\d+\]\s)|\(\s*\d+\s*\)\s*(\w+)", b)
    return bool(m) and (m.group(1) is None or m.group(1) in NOTE_WORDS or m.group(1).startswith(NOTE_BEGINNINGS))


def text_units(text: str) -> list[dict]:
    """From plain text or markdown: blocks between blank lines, from the first heading or long block on and up to the
    notes at the end; noise, comments, tables and archive covers left out."""
    blocks = [b.strip() for b in re.split(r"\n\s*\n", text)]
    blocks = [b for b in blocks if b and not is_noise(b) and not re.match(r"<!--.*-->$|\.{3,}$", b) and not (b.startswith("|") and "|" in b[1:])]
    first = 0
    for i, b in enumerate(blocks):
        md = re.match(r"#{1,3}\s+(.*)", b)
        if is_cover(b) or (md and len(md.group(1).strip()) < 20 and not NUMBERED.match(md.group(1).strip())):
            first = i + 1
        elif md or NUMBERED.match(b) or len(b) > 100:
            first = i
            break
    end = len(blocks)
    while end - 1 > first and _is_note(blocks[end - 1]):
        end -= 1
    p = _Prose()
    for b in blocks[first:end]:
        md = re.match(r"#{1,3}\s+(.*)", b)
        t = md.group(1).strip() if md else b
        if (len(t) < 120 if md else (NUMBERED.match(b) and len(b) < 120) or is_capitals(b)):
            p.heading = t
        else:
            p.add(t)
    return p.out or ([unit("body", None, text.strip())] if text.strip() else [])


@F.pandas_udf(ArrayType(UNIT))
def _com(page: pd.Series, is_html: pd.Series) -> pd.Series:
    return pd.Series([None if p is None else com_units(p) if h else text_units(p) for p, h in zip(page, is_html)])


def com_html_units(page: Column) -> Column:
    return _com(page, F.lit(True))


def com_text_units(text: Column) -> Column:
    return _com(text, F.lit(False))
