"""Identifiers of acts: validity, normal form, document types and routing, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Type code in an id -> name (fixed values).
DOC_TYPES = {"L": "directive", "R": "regulation", "D": "decision", "PC": "proposal", "DC": "communication", "SC": "staff working document", "IP": "institutional proposal"}
#: Sector digit of each named type: 3 adopted law, 5 preparatory documents (fixed values).
SECTORS = {"directive": "3", "regulation": "3", "decision": "3", "proposal": "5", "communication": "5", "staff working document": "5", "institutional proposal": "5"}
STRUCTURAL = ("regulation", "directive", "decision")
COM_STYLE = ("communication", "proposal", "staff working document")
#: Languages in the order in which content is asked for (fixed values).
LANGUAGES = ("eng", "fra", "deu", "ita", "nld", "spa")
VALID_ID = "(?i)^[0-9][0-9]{4}[A-Z]{1,3}[0-9A-Z/()_.\\-]{2,}$"


def normal_id(c: Column) -> Column:
    return F.upper(F.trim(c))


def is_valid_id(c: Column) -> Column:
    return c.rlike(VALID_ID)


def is_consolidated(c: Column) -> Column:
    return c.startswith("0")


def original_id(c: Column) -> Column:
    """Of a consolidated id that of the act itself; any other id unchanged."""
    return F.when(is_consolidated(c), F.concat(F.lit("3"), F.substring(F.split_part(c, F.lit("-"), F.lit(1)), 2, 10_000))).otherwise(c)


def is_corrigendum(c: Column) -> Column:
    return c.rlike(r"R\([0-9]+\)$")


def type_code(c: Column) -> Column:
    return F.regexp_replace(F.substring(c, 6, 2), "[0-9]+$", "")


def document_type(c: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in DOC_TYPES.items() for x in kv])
    return F.coalesce(F.try_element_at(m, type_code(c)), F.lit("unknown"))


def route(doc_type: Column) -> Column:
    """Which structure parser a document goes to: 'structural', 'com' or 'text'."""
    return F.when(doc_type.isin(*STRUCTURAL), "structural").when(doc_type.isin(*COM_STYLE), "com").otherwise("text")


def year_of(c: Column) -> Column:
    return F.substring(c, 2, 4).try_cast("int")


def type_filter(c: Column, names: list[str]) -> Column:
    """Type and sector conditions of the named types; unknown names are skipped, an error if none is left."""
    known = [n.lower() for n in names if n.lower() in SECTORS]
    if not known:
        raise ValueError(f"no known document type in {names}")
    code = {v: k for k, v in DOC_TYPES.items()}
    cond = F.lit(False)
    for n in known:
        cond = cond | ((type_code(c) == code[n]) & c.startswith(SECTORS[n]))
    return cond


def discover(works, types: list[str], start, end, concepts: list[str] | None = None, corrigenda: bool = False, consolidated: bool = False, descriptors=None, limit: int | None = None):
    """Distinct ids, sorted, of the works of these types adopted between both dates (inclusive).

    A concept list narrows by a semi-join with the descriptors; an empty or missing list does not narrow.
    """
    i = F.col("celex_id")
    cond = type_filter(i, types) & F.col("date_adopted").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    if not corrigenda:
        cond = cond & ~is_corrigendum(i)
    if not consolidated:
        cond = cond & ~is_consolidated(i)
    found = works.where(cond)
    if concepts:
        found = found.join(descriptors.where(F.col("eurovoc_uri").isin(*concepts)).select("celex_id"), "celex_id", "left_semi")
    out = found.select("celex_id").distinct().orderBy("celex_id")
    return out.limit(limit) if limit is not None else out
