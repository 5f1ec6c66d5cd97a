"""Rules on the lines of acts that the HTML and the markdown readers share: heads of articles and annexes, numbered
lines, references that only look like recitals, and sequences of numbers."""

from __future__ import annotations

import re

from .splitter import unit

#: Words that go on with a sentence behind 'Article 5' (fixed values).
GOES_ON = ("of", "to", "the", "is", "shall", "and", "in", "for", "or", "which", "has", "was", "provides", "referred")
#: Words that go on with a sentence behind 'Annex I' (fixed values).
ANNEX_GOES_ON = ("to", "of", "the", "is", "shall", "and", "in", "for")
#: Words that make '(3) ...' part of a reference and not a recital (fixed values).
REFERS = ("of", "thereof", "referred to", "cited", "above")
#: Words that make '(3) ...' the rest of a reference in text from a PDF (fixed values).
FRAGMENT = ("of", "to", "thereof")
DIVISIONS = ("chapter", "title", "part", "section")
MONTHS = "january february march april may june july august september october november december".split()
#: Annex headings in other languages (fixed values).
ANNEX_WORDS = ("ANNEXE", "ANHANG", "ALLEGATO", "BIJLAGE", "BILAG", "ΠΑΡΑΡΤΗΜΑ")

DONE_AT = re.compile(r"(?i)done at \w+[\s,]+\d")
JOURNAL_NOTE = re.compile(r"\(\s*\d+\s*\)\s*OJ\b")
MARK = re.compile(r"[▼▲►◄]\s*[A-Z]\d*$")
FORMULA = re.compile(r"(?i)ha(?:s|ve)\s+(?:adopted|decided|agreed)\b")
_NUMBERED = re.compile(r"\((\d+)\)\s*(.*)$", re.S)
_ROMAN = re.compile(r"(?i)[ivxlcdm]+$|\d+$")


def letters(s: str) -> int:
    return sum(c.isalpha() for c in s)


def begins(s: str, words) -> bool:
    """Whether s begins with one of the words, as a whole word that another one follows."""
    return any(s.startswith(w + " ") for w in words)


def numbered(line: str, dash: bool = False) -> tuple[int, str] | None:
    """Number and body of '(n) body'; with dash also of '- (n) body'."""
    m = _NUMBERED.match(line.removeprefix("-").lstrip() if dash else line)
    return (int(m.group(1)), m.group(2)) if m else None


def refers(body: str) -> bool:
    """Whether the body of a numbered line only goes on with a reference."""
    return any(body.startswith(w) and not body[len(w) : len(w) + 1].isalnum() for w in REFERS[1:]) or begins(body, REFERS[:1])


def cites(body: str) -> bool:
    """Whether the body of a numbered line is a footnote."""
    w = [x for x in body.split()[:3] if x != "No"]
    if body.startswith(("Ibidem", "Ibid.", "Cf. ")):
        return True
    if len(w) < 2:
        return False
    return (w[0] == "OJ" and (w[1][0] in "LC" or w[1][0].isdigit())) or (w[1].startswith("ECR") and bool(re.fullmatch(r"\[\d{4}\]", w[0])))


def article_head(line: str) -> tuple[str, str] | None:
    """('5a', rest) of 'Article 5a rest', ('sole', rest) of 'Sole Article rest'. The letters touch the number."""
    m = re.match(r"(?is)(sole\s+)?article(?!s)(?:\s+(\d+[a-z]*))?", line)
    if not m or not (m.group(1) or m.group(2)):
        return None
    return m.group(2) or "sole", line[m.end() :].strip()


def bare(rest: str) -> bool:
    return not rest.strip(".,;:-–—|")


def reference(rest: str) -> bool:
    """Whether what stands behind 'Article 5' goes on with a sentence."""
    low = rest.lower()
    return begins(low, GOES_ON) or low.startswith(",") or bool(re.match(r"\([a-z0-9]+\)", low))


def heads_with_text(line: str, at: int = 0) -> list[re.Match]:
    """Places in a line where 'Article 5' stands with a text behind it that begins like one: a capital or an opening mark,
    dashes between allowed."""
    found = re.finditer(r"(?i)(?<!\w)(?:sole\s+)?article\s+\d+[a-z]*(?=\s)", line[at:])
    begins_text = lambda s: s[:1].isupper() or s[:1] in ("'", "‘", '"', "“")
    return [m for m in found if begins_text(line[at + m.end() :].lstrip().lstrip("-–—一").lstrip())]


def division(line: str) -> bool:
    w = line.split()
    return len(w) == 2 and w[0].lower() in DIVISIONS and bool(_ROMAN.match(w[1]))


def annex_head(line: str) -> tuple[str | None, str | None] | None:
    """(number, title) of an annex heading; None for annexes, Annexe and 'Annex I to ...'."""
    low = line.lower()
    if not low.startswith("annex") or low.startswith("annexe"):
        return None
    number, title = _number_and_title(line[5:])
    rest = re.sub(r"^(?:[a-z]\s+|\([a-z0-9]+\)\s*)", "", (title or "").lower())
    if any(begins(x + " ", ANNEX_GOES_ON) or x.startswith(",") for x in ((title or "").lower(), rest) if x):
        return None
    return number, title


def _number_and_title(rest: str) -> tuple[str | None, str | None]:
    m = re.match(r"\s*([IVXLCDMivxlcdm]+|\d+)(?![^\W_])", rest)
    return (m.group(1) if m else None), rest[m.end() if m else 0 :].strip() or None


def md_annex_head(line: str) -> tuple[str | None, str | None] | None:
    """As annex_head, of a line of markdown: a heading with '#', 'ANNEX n' alone, or 'ANNEX n TITLE' in capitals."""
    body = line.lstrip("#").strip()
    hashed, up = line.startswith("#"), body.upper()
    if hashed and up.startswith(ANNEX_WORDS) and "ANNEX" in re.findall(r"\w+", up):
        return None, None
    if not up.startswith("ANNEX") or up.startswith("ANNEXE"):
        return None
    number, title = _number_and_title(body[5:])
    if hashed or title is None or (body.startswith("ANNEX") and body[5:6].isspace()):
        return number, title
    return None


def cut_journal_tail(s: str) -> str:
    m = re.search(r"\s*\(\s*\d+\s*\)\s*OJ\s+(?:No\s+)?[LC]?\s*\d", s)
    return (s[: m.start()] if m else s).rstrip()


def recital(number: str | None, text: str, least: int = 0) -> dict | None:
    """A recital unit, or None without a text or with fewer than `least` letters."""
    t = cut_journal_tail(text)
    if not t or letters(t) < least:
        return None
    return unit("recital", number, t, subtype="subheading" if len(t.strip()) <= 30 else None)


def annex(number: str | None, title: str | None, parts: list[str]) -> dict | None:
    text = " ".join(p for p in parts if p)
    return unit("annex", number, text, title=title or None) if text or title or number else None


def sequence_ok(numbers: list[str]) -> bool:
    """Article numbers at their first places run 1..last; ['sole'] is whole."""
    seen = list(dict.fromkeys(numbers))
    if seen == ["sole"]:
        return True
    bases = list(dict.fromkeys(int(m.group()) for n in seen if (m := re.match(r"\d+", n or ""))))
    return bool(bases) and bases == list(range(1, len(bases) + 1)) and all(re.match(r"\d+", n or "") for n in seen)


def turn_back(numbers: list[int]) -> list[int]:
    """A 1..n sequence turned once, turned back."""
    if 1 in numbers and numbers[0] != 1:
        i = numbers.index(1)
        turned = numbers[i:] + numbers[:i]
        if turned == list(range(1, len(turned) + 1)):
            return turned
    return numbers


def drop_restarts(rows: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """Leaves out a run 1..k inside a sequence if the sequence later goes on where it was."""
    out, i = [], 0
    while i < len(rows):
        n = rows[i][0]
        if out and n == 1 and out[-1][0] >= 1:
            want, j, k = out[-1][0] + 1, i, 1
            while j < len(rows) and rows[j][0] == k and rows[j][0] != want:
                j, k = j + 1, k + 1
            if j < len(rows) and rows[j][0] == want:
                i = j
                continue
        out.append(rows[i])
        i += 1
    return out


def credible_from(rows: list[tuple[int, str]]) -> int | None:
    """First number of a sequence of two and more rows that rises by one, each with three letters; else None."""
    ns = [n for n, _ in rows]
    if len(rows) >= 2 and ns[0] >= 1 and ns == list(range(ns[0], ns[0] + len(ns))) and all(letters(t) >= 3 for _, t in rows):
        return ns[0]
    return None
