"""Scalar text functions as column expressions; only Unicode normalisation is an Arrow UDF."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

_U = "(?U)"  # \s, \w and \d of any script


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Compatibility composition (Spark has no built-in)."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _U + "^\\s+|\\s+$", "")


def collapse(c: Column) -> Column:
    """White space runs as one space, none at the ends, soft hyphens dropped."""
    return strip(F.regexp_replace(F.regexp_replace(c, "\\u00ad", ""), _U + "\\s+", " "))


def normalise(c: Column) -> Column:
    return collapse(nfkc(c))


#: What begins the end of an act, as fixed wording (fixed values).
BINDING = [f"This {act} shall be binding in its entirety and directly applicable in {whose}Member States" for act in ("Regulation", "Decision", "Directive") for whose in ("", "all ", "the ", "all the ")]
SIGNED = ["For the Commission", "For the Council", "For the European Parliament"]
#: A place with what follows it, and a bracketed number before the journal.
SIGNED_AT = r"Done at \w+\W?\s"
JOURNAL_REFERENCE = r"[(\[]\s*\d+\s*[)\]]\s*OJ\s(?:\s*No\s)?\s*[LC]\s+\d"


_END = "|".join([*(rf"\Q{x}\E" for x in BINDING), *(rf"\Q{x}\E\b" for x in SIGNED), SIGNED_AT, JOURNAL_REFERENCE])


def strip_boilerplate(c: Column) -> Column:
    """Up to the first of the closing formula, a signature and a trailing reference to the journal; then without a last
    line of dashes."""
    head = F.regexp_replace(F.split(c, _END, 2)[0], _U + "\\s+$", "")
    return F.regexp_replace(F.regexp_replace(head, "-{3,}$", ""), _U + "\\s+$", "")


def recital_tail(c: Column) -> Column:
    """Cut from a trailing journal reference to the end."""
    return F.regexp_replace(F.regexp_replace(c, r"(?s)\s*\(\s*\d+\s*\)\s*OJ\s.*$", ""), _U + "\\s+$", "")


def recital_subtype(c: Column) -> Column:
    return F.when(F.length(strip(c)) <= 30, "subheading")


def letters(c: Column) -> Column:
    return F.length(F.regexp_replace(c, "[^\\p{L}]", ""))


def alphanumerics(c: Column) -> Column:
    return F.length(F.regexp_replace(c, "[^\\p{L}\\p{N}]", ""))


def low_information(c: Column) -> Column:
    """Empty, fewer than 3 letters, or 20 characters and more of which under 8 % are letters."""
    t = strip(c)
    return (F.coalesce(F.length(t), F.lit(0)) == 0) | (letters(t) < 3) | ((F.length(t) >= 20) & (letters(t) / F.length(t) < 0.08))


def uri_tail(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def split_label(c: Column) -> tuple[Column, Column]:
    """'uri|label' at the first bar; the label is '' where there is none."""
    at = F.locate("|", c)
    return (F.when(at > 0, F.substr(c, F.lit(1), at - 1)).otherwise(c), F.when(at > 0, F.substr(c, at + 1)).otherwise(F.when(c.isNotNull(), "")))


def sentences(c: Column) -> Column:
    return F.split(c, r"(?<=[.;])\s+(?=[\p{Lu}(])")


def sha256(c: Column) -> Column:
    return F.sha2(c, 256)


def word_tokens(c: Column) -> Column:
    """Letter or digit runs, with inner apostrophes and hyphens, in small letters."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+(?:['’\-][\p{L}\p{N}]+)*"), 0)


def encoding_alias(c: Column) -> Column:
    """A legacy name of UTF-8 in a charset declaration, by its usual name."""
    return F.regexp_replace(c, r"(?i)(charset\s*=\s*[\"']?)UNICODE-1-1-UTF-8", "$1UTF-8")


def looks_like_html(content: Column) -> Column:
    head = F.lower(F.substring(content.cast("string"), 1, 500))
    return head.contains("<html") | head.contains("<div") | head.contains("<!doctype")


def looks_like_pdf(content: Column) -> Column:
    return F.hex(F.substring(content, 1, 5)) == "255044462D"


def typed_literal(value: Column, datatype: Column) -> dict[str, Column]:
    """A typed literal as one column a type, null where it does not apply or parse."""
    kind = F.substring_index(F.regexp_replace(datatype, "#", "/"), "/", -1)
    return {
        "as_boolean": F.when(kind == "boolean", F.lower(value).isin("true", "1")),
        "as_integer": F.when(kind.isin("integer", "gYear"), value.try_cast("long")),
        "as_double": F.when(kind.isin("decimal", "double", "float"), value.try_cast("double")),
        "as_date": F.when(kind == "date", value.try_cast("date")),
        "as_timestamp": F.when(kind == "dateTime", F.try_to_timestamp(value)),
    }


def truncate_html(c: Column, limit: int) -> Column:
    """A page over the limit, in bytes, is cut before the first known annex marker (in fixed order) and closed again."""
    marks = ['<p class="oj-doc-ti">ANNEX', '<p class="doc-ti">ANNEX', ">ANNEX I<", ">ANNEX<"]
    cut = F.coalesce(*[F.when(F.instr(c, m) > 1, F.instr(c, m)) for m in marks])
    return F.when((F.octet_length(c) > limit) & cut.isNotNull(), F.concat(F.substr(c, F.lit(1), cut - 1), F.lit("</body></html>"))).otherwise(c)


def pdf_artefacts(c: Column) -> Column:
    """Leftovers of page layout in text taken from PDF."""
    for p, r in [
        (r"(?s)<!--.*?-->", ""),
        (r"\[?PICT?\]?(?=\n|$)", ""),
        (r"(?s)\s*Done at \w+\W?\s+.*$", ""),
        (r"(?s)\s*For the (?:Commission|Council)\b.{0,200}$", ""),
        (r"(?m)^\s*\(?\d*\)?\s*OJ\s+(?:No\s+)?[LC]\s+\d+[^\n]*$", ""),
        (r"(?m)^\s*EN\s*$", ""),
        (r"(?m)^\s*[LC]\s+\d+/\d+\s*$", ""),
        (r"\n{3,}", "\n\n"),
    ]:
        c = F.regexp_replace(c, p, r)
    return strip(c)


#: Line predicates of the structure parsers (fixed patterns).
HEADINGS = {
    "chapter": r"^(?:CHAPTER|TITLE|PART|SECTION|Chapter|Title|Part|Section)\s+(?:[IVXLC]+|\d+|[A-Z])\b",
    "journal_note": r"^\(?\d*\)?\s*OJ\s+(?:No\s+)?[LC]\s+\d+",
    "modification": r"^[▼►]",
    "numbered": r"^\d+(?:\.\d+)*\.?\s+\p{Lu}",
    "capitals": r"^[^\p{Ll}]{6,}$",
    "markdown": r"^#{1,6}\s+\S",
    "ocr_noise": r"^[\W\d_]{1,4}$",
}


def heading_kind(line: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, p in reversed(HEADINGS.items()):
        out = F.when(line.rlike(p), name).otherwise(out)
    return out
