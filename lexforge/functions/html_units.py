"""Structure of acts and communications in HTML: each reader takes a tree and gives units in document order."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType

from . import recitals as R, tree as T
from .machine import run_lines
from .splitter import UNIT, split_article, unit

# Class names of the page formats (fixed values).
SKIP_BODY = {"eli-title", "oj-ti-art", "modref", "title-article-norm"}
OPEN_DIV = {"", "norm", "norm inline-element"}
STOP_CLASS = {"ti-art", "oj-ti-art", "ti-grseq-1", "oj-ti-grseq-1", "signatory", "oj-signatory", "final", "doc-end", "doc-sep"}
STOP_CLASS_ANNEX = {"ti-grseq-1", "signatory", "final", "doc-end"}
STOP_MANUAL = {"Titrearticle", "Annexetitre", "Fait", "Fichefinanciretitre"}
SKIP_CONSOLIDATED = {
    "arrow", "modref", "reference", "disclaimer", "title-doc-first", "title-doc-last", "title-doc-oj-reference",
    "hd-modifiers", "hd-toc-1", "hd-toc-2", "hd-toc-3", "toc-1", "toc-2", "toc-3", "title-fam-member", "title-fam-member-star", "footnote",
}


def has(root: T.Node, kind: str) -> bool:
    ps = lambda *names: any(n.tag == "p" and n.cls in names for n in root.walk())
    if kind == "standard":
        return any(n.tag == "div" and re.match(r"(?:rct_|art_|art$)", n.id) for n in root.walk())
    if kind == "manual":
        return ps("li ManualConsidrant", "Titrearticle", "Annexetitre")
    if kind == "class":
        return ps("ti-art", "oj-ti-art")
    if kind == "consolidated":
        return ps("title-article-norm")
    if kind == "text":
        return any(n.id == "TexteOnly" for n in root.walk())
    if kind == "com_modern":
        return any(n.tag == "p" and re.search(r"Heading1|Heading2|ManualHeading1|Typedudocument_cp|Prliminairetype", n.cls) for n in root.walk())
    if kind == "com_legacy":
        return any(n.id == "TexteOnly" and any("TXT_TE" in (k.id + " " + k.cls + " " + k.tag.upper()) for k in n.walk()) for n in root.walk())
    raise ValueError(kind)


def body_parts(node: T.Node) -> list[str]:
    """Texts of the elements of an article: plain divs are entered, headings and marks skipped."""
    out: list[str] = []
    for c in node.children:
        if c.cls in SKIP_BODY:
            continue
        if c.tag == "div" and c.cls in OPEN_DIV and c.children:
            out += body_parts(c)
        elif t := c.text():
            out.append(t)
    return out


def _until(start: T.Node, stop) -> list[T.Node]:
    """Later siblings up to one of which stop(class) is true."""
    out = []
    for n in start.following():
        if stop(n.cls):
            break
        out.append(n)
    return out


def _texts(nodes: list[T.Node]) -> list[str]:
    return [t for n in nodes if (t := n.text())]


def _articles(items, granularity: str) -> list[dict]:
    return [u for parts, num, title in items for u in split_article(parts, num, title, granularity, True)]


def _number(heading: str) -> str | None:
    """Number of the article that a heading names anywhere, 'sole' of a sole article."""
    m = re.search(r"(?i)article\s+(\d+[a-z]*)", heading)
    return m.group(1) if m else "sole" if re.search(r"(?i)sole\s+article", heading) else None


def _annex_name(heading: str) -> tuple[str | None, str | None] | None:
    """Number and title of a heading that begins with ANNEX."""
    return R._number_and_title(heading[5:]) if heading[:5].upper() == "ANNEX" else None


# --- standard: ids ---------------------------------------------------------------------------------------
def standard_recitals(root: T.Node) -> list[dict]:
    found = [u for n in root.find("div") if n.id.startswith("rct_") and (u := R.recital(n.id[4:], n.text()))]
    return found or table_recitals(root)


def standard_articles(root: T.Node) -> list[tuple]:
    out = []
    for n in root.find("div"):
        if m := re.fullmatch(r"art(?:_(\d+[a-z]*))?", n.id):
            title = next((k.text() for k in n.children if k.tag == "div" and k.cls == "eli-title"), None)
            parts = body_parts(n)
            if parts or title:
                out.append((parts, m.group(1) or "sole", title))
    return out


def standard_annexes(root: T.Node) -> list[dict]:
    out = []
    for n in root.find("div"):
        if m := re.fullmatch(r"(?i)anx_([ivxlcdm\d]+)", n.id):
            heads = [k.text() for k in n.children if k.cls == "oj-doc-ti"]
            title = next((h for h in heads if h and not re.fullmatch(r"ANNEX\s*[IVXLCDM]*", h)), None)
            parts = _texts([k for k in n.children if k.cls != "oj-doc-ti"])
            if (parts or title) and (u := R.annex(m.group(1), title, parts)):
                out.append(u)
    return out


def _operative_from(root: T.Node) -> float:
    """Place of the first article, else of the first enacting formula."""
    heads = [n.pos for n in root.find("div") if n.id.startswith("art")]
    formulas = []
    for p in T.leaf_paragraphs(root):
        t = p.text()
        if R.FORMULA.match(t):
            formulas.append(p.pos)
        head = R.article_head(t.rstrip(".,;:-–—"))
        if head and not head[1]:
            heads.append(p.pos)
    return min(heads or formulas, default=float("inf"))


def table_rows(root: T.Node) -> list[tuple[int, str]]:
    """(n, text) of table rows with a cell '(n)' before the last, in tables above the operative part."""
    stop, out = _operative_from(root), []

    def mark(tr: T.Node) -> int | None:
        cells = [c for c in tr.children if c.tag == "td"]
        return next((i for i, c in enumerate(cells[:-1]) if re.fullmatch(r"\(\d+\)", c.text())), None)

    for tr in root.find("tr"):
        table = tr.parent
        while table is not None and table.tag != "table":
            table = table.parent
        if table is None or table.pos > stop or table.inside(lambda x: x.tag == "tr" and mark(x) is not None):
            continue
        if (i := mark(tr)) is not None:
            cells = [c for c in tr.children if c.tag == "td"]
            if body := " ".join(_texts(cells[i + 1 :])):
                out.append((int(cells[i].text()[1:-1]), body))
    return R.drop_restarts(out)


def _from_rows(rows: list[tuple[int, str]]) -> list[dict]:
    return [u for n, t in rows if (u := R.recital(str(n), f"({n}) {t}"))]


def table_recitals(root: T.Node) -> list[dict]:
    return _from_rows(table_rows(root))


# --- manual ----------------------------------------------------------------------------------------------
def _manual_head(p: T.Node) -> tuple[str | None, str | None]:
    """Number and title of a manual article heading: the title stands behind a line break."""
    at = next((i for i, x in enumerate(p.items) if isinstance(x, T.Node) and x.tag == "br"), None)
    if at is not None:
        direct = lambda x: T.clean(x) if isinstance(x, str) else ""
        before, after = direct(p.items[0]), direct(p.items[at + 1]) if at + 1 < len(p.items) else ""
    else:
        spans = [c for c in p.children if c.tag == "span"]
        before, after = (spans[0] if spans else p).text(), ""
    m = re.search(r"Article\s+(\d+[a-z]*)", before)
    return m.group(1) if m else None, after or None


def manual_units(root: T.Node, g: str) -> list[dict]:
    rec, art, anx, used = [], [], [], set()
    stop = lambda cls: cls in STOP_MANUAL
    for p in root.find("p"):
        if p.cls == "li ManualConsidrant":
            num = next((m.group(1) for s in p.children if s.tag == "span" and s.cls == "num" and (m := re.search(r"\((\d+)\)", s.text()))), None)
            if u := R.recital(num, p.text()):
                rec.append(u)
        elif p.cls == "Titrearticle" and p.pos not in used:
            num, title = _manual_head(p)
            begin, nxt = p, p.following()
            if title is None and nxt and nxt[0].cls == "Titrearticle" and not re.match(r"(?i)article\s+\d", nxt[0].text()):
                begin, title = nxt[0], nxt[0].text()
                used.add(begin.pos)
            parts = _texts(_until(begin, stop))
            if parts or title or num:
                art.append((parts, num, title))
        elif p.cls == "Annexetitre":
            m = re.search(r"ANNEX\s+([IVXLCDMivxlcdm]+)\b", p.text())
            num, title = (m.group(1), p.text()[m.end() :].strip() or None) if m else (None, None)
            begin, nxt = p, p.following()
            if not title and nxt and nxt[0].cls == "NormalCentered":
                begin, title = nxt[0], nxt[0].text()
            if u := R.annex(num, title, _texts(_until(begin, stop))):
                anx.append(u)
    return rec + _articles(art, g) + anx


# --- classes of the printed journal ----------------------------------------------------------------------
def class_recitals(root: T.Node, body=("normal", "oj-normal"), stop=("ti-art", "oj-ti-art"), whereas: bool = True) -> list[dict]:
    """Recitals are paragraphs above the first article: '(n)' above its text, '(n) text', or 'Whereas' counted."""
    out, waiting, count = [], None, 0
    ps = root.find("p")
    if not any(p.cls in stop for p in ps):
        return []

    def add(number: str, text: str) -> None:
        if u := R.recital(number, text):
            out.append(u)

    for p in ps:
        if p.cls in stop:
            break
        t = p.text() if p.cls in body else ""
        if not t or (whereas and t.rstrip(":").upper() == "WHEREAS"):
            continue
        got = R.numbered(t)
        if whereas and t.upper().startswith("WHEREAS"):
            count, waiting = count + 1, None
            add(str(count), t)
        elif got and len(t) < 10:
            waiting = str(got[0])
        elif waiting is not None:
            add(waiting, f"({waiting}) {t}")
            waiting = None
        elif got and not (R.refers(got[1]) or R.cites(got[1])):
            add(str(got[0]), t)
    return out


def class_articles(root: T.Node, outside_standard: bool = False) -> list[tuple]:
    out = []
    for p in root.find("p"):
        if p.cls not in ("ti-art", "oj-ti-art") or (outside_standard and p.inside(lambda n: n.tag == "div" and re.fullmatch(r"art(_\d+[a-z]*)?", n.id))):
            continue
        num, title, begin, nxt = _number(p.text()), None, p, p.following()
        if nxt and nxt[0].cls in ("sti-art", "oj-sti-art"):
            begin, title = nxt[0], nxt[0].text() or None
        parts = _texts(_until(begin, lambda cls: cls in STOP_CLASS))
        if title and not parts:  # the title is all there is
            parts, title = [title], None
        if parts or num:
            out.append((parts, num, title))
    return out


def class_annexes(root: T.Node) -> list[dict]:
    out = []
    for p in root.find("p"):
        if p.cls == "ti-grseq-1" and (m := _annex_name(p.text())):
            if u := R.annex(m[0], m[1], _texts(_until(p, lambda cls: cls in STOP_CLASS_ANNEX))):
                out.append(u)
    return out


# --- consolidated ----------------------------------------------------------------------------------------
def consolidated_articles(root: T.Node) -> list[tuple]:
    out = []
    stop = lambda cls: cls in ("title-article-norm", "title-division-1") or cls.startswith("title-annex")
    for p in root.find("p"):
        if p.cls != "title-article-norm":
            continue
        num, title, begin, nxt = _number(p.text()), None, p, p.following()
        if nxt and nxt[0].cls == "stitle-article-norm":
            begin, title = nxt[0], nxt[0].text()
        parts: list[str] = []
        for n in _until(begin, stop):
            if n.cls == "norm":
                parts += _texts([n])
            elif n.tag == "div" and not n.cls:
                parts += _texts([k for k in n.children if k.cls == "norm"])
        if parts or num:
            out.append((parts, num, title))
    return out


def consolidated_annexes(root: T.Node) -> list[dict]:
    out = []
    for h in root.walk():
        if not h.cls.startswith("title-annex") or not (m := _annex_name(h.text())):
            continue
        title, begin, nxt = m[1], h, h.following()
        if nxt and nxt[0].cls.startswith("stitle-annex"):
            begin, title = nxt[0], nxt[0].text() or title
        run = _until(begin, lambda cls: cls.startswith(("title-annex", "title-article")))
        if u := R.annex(m[0], title, _texts([n for n in run if n.cls not in SKIP_CONSOLIDATED])):
            out.append(u)
    return out


def consolidated_units(root: T.Node, g: str) -> list[dict]:
    return class_recitals(root, ("norm",), ("title-article-norm",), False) + _articles(consolidated_articles(root), g) + consolidated_annexes(root)


# --- text only -------------------------------------------------------------------------------------------
_FORMULA_WORD = r"(?:Whereas\b|(?i:ha(?:s|ve)\s+(?:adopted|decided|agreed)\b))"


def split_flat(line: str) -> list[str]:
    """Headings that were run into a line: an article with its text behind a closing quote, 'Whereas' or the formula
    behind a sign, and an article head at the end behind the end of a sentence."""
    for m in reversed(R.heads_with_text(line)):
        before = line[: m.start()].rstrip()
        if before.endswith(("'", "’", "”", "»")) and before != line[: m.start()]:
            line = before + "\n" + line[m.start() :]
    out = []
    for x in re.sub(rf"(?<=[,;:.])\s+(?={_FORMULA_WORD})", "\n", line).split("\n"):
        m = re.search(r"(?i)(?<=[:.;)])\s+(?=((?:sole\s+)?article(?!s)(?:\s+\d+[a-z]*)?)\s*$)", x)
        out += [x[: m.start()].strip(), m.group(1)] if m and len(x) > len(m.group(1)) + 6 else [x]
    return out


def _flat_lines(root: T.Node) -> list[str]:
    return [x for p in T.leaf_paragraphs(root) for x in split_flat(p.text()) if x]


def text_units(root: T.Node, g: str) -> list[dict]:
    only = next((n for n in root.find("div") if n.id == "TexteOnly"), root)
    return run_lines(_flat_lines(only), False, g)


# --- dispatch --------------------------------------------------------------------------------------------
def standard_units(root: T.Node, g: str) -> list[dict]:
    extra = [a for a in class_articles(root, True)] if has(root, "class") else []
    return standard_recitals(root) + _articles(standard_articles(root) + extra, g) + standard_annexes(root)


def class_units(root: T.Node, g: str) -> list[dict]:
    return class_recitals(root) + _articles(class_articles(root), g) + class_annexes(root)


def classless_units(root: T.Node, g: str, recitals: bool = True) -> list[dict]:
    """Lines through the machine; recitals from a table if it is credible, or completed at its front by lines."""
    lines = run_lines(_flat_lines(next(iter(root.find("body")), root)), False, g)
    own, rest = ([u for u in lines if (u["type"] == "recital") is is_recital] for is_recital in (True, False))
    rows = table_rows(root) if recitals else []
    first = R.credible_from(rows)
    if first == 1:
        return _from_rows(rows) + rest
    if first is not None:
        best: dict[str, dict] = {}
        for u in own:
            if R.letters(u["text"]) >= 3 and len(u["text"]) > len(best.get(u["number"], {"text": ""})["text"]):
                best[u["number"]] = u
        front = [best.get(str(i)) for i in range(1, first)]
        if all(front):
            return front + _from_rows(rows) + rest
    if len(rows) == 1 and not own and R.letters(rows[0][1]) >= 3:
        return _from_rows(rows) + rest
    return lines


READERS = [("standard", standard_units), ("manual", manual_units), ("class", class_units), ("consolidated", consolidated_units), ("text", text_units)]


def act_units(page: str, granularity: str = "article", recitals: bool = True, articles: bool = True, annexes: bool = True) -> list[dict]:
    """Units of an act; the body as one unit where no structure shows and articles are asked for."""
    if not (recitals or articles or annexes):
        return []
    root = T.parse(page)
    T.flatten_content(root)
    keep = {k for k, v in (("recital", recitals), ("article", articles), ("annex", annexes)) if v}
    drop = {"recital", "article", "annex"} - keep
    for kind, read in READERS:
        if has(root, kind) and (out := [u for u in read(root, granularity) if u["type"] not in drop]):
            return out
    if out := [u for u in classless_units(root, granularity, recitals) if u["type"] not in drop]:
        return out
    body = T.full_text(root)
    return [unit("body", None, body)] if articles and body else []


@F.pandas_udf(ArrayType(UNIT))
def _act_units(page: pd.Series, g: pd.Series, r: pd.Series, a: pd.Series, x: pd.Series) -> pd.Series:
    return pd.Series([None if p is None else act_units(p, gi, ri, ai, xi) for p, gi, ri, ai, xi in zip(page, g, r, a, x)])


def html_units(page: Column, granularity: str = "article", recitals: bool = True, articles: bool = True, annexes: bool = True) -> Column:
    """array<unit>; select it into a column before exploding, so that pages are parsed once."""
    return _act_units(page, F.lit(granularity), F.lit(recitals), F.lit(articles), F.lit(annexes))
