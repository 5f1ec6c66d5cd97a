"""Remote catalogues as Spark data sources: a SPARQL endpoint and a REST store with content negotiation.

`spark.read.format("lex_sparql")` and `("lex_rest")` read one partition a slice of the ids, so requests run on the
executors, each partition with its own session and its share of the allowed request rate. With the option `recorded`
(a folder of JSON answers) nothing leaves the machine: that is how tests and offline runs read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, IntegerType, MapType, StringType, StructField, StructType

from ..functions import ids as I
from .protocols import CatalogueSource

#: Seconds between requests of all partitions together, and limits of a request (fixed values).
REST_INTERVAL, ENRICH_INTERVAL, TIMEOUT, DISCOVERY_TIMEOUT = 0.1, 0.15, 20, 120
RETRY_STATUS = {429, 500, 502, 503, 504}
SENTINEL = "zz_complete_"
#: data_type of the row that stands for an answer that did not come, its value the reason (option on_failure=row).
FAILURE = "zz_failure"
#: Fields of each enrichment category (fixed values).
FIELDS = {
    "metadata": ["date_entry_into_force", "date_end_of_validity", "is_in_force", "eli", "author", "subject_matter", "procedure_type", "procedure_reference", "procedure_legal_basis"],
    "relations": ["repeals", "implicitly_repeals"],
    "eurovoc": ["eurovoc"],
}
MULTI, TAIL = ("author", "subject_matter"), ("author", "subject_matter", "procedure_type")
_ROWS = StructType([StructField(n, StringType()) for n in ("celex_id", "data_type", "value", "value_type", "datatype", "lang")])
_CONTENT = StructType([StructField("celex_id", StringType()), StructField("lang", StringType()), StructField("fmt", StringType()), StructField("status", IntegerType()), StructField("body", BinaryType())])


class TransientError(RuntimeError):
    """A failure that may pass; Spark's task retry comes on top."""


def classify(status: int | None, body: bytes | None) -> str:
    """ok, choices, missing, transient or unavailable."""
    if status is None or status == 429 or status >= 500:
        return "transient"
    if status == 300:
        return "choices"
    if status == 200:
        return "ok" if body else "missing"
    return "missing" if status in (403, 404) else "unavailable"


def escape(s: str) -> str:
    """For use inside a quoted SPARQL string."""
    return s.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n").replace("\r", "")


def id_filter(celex: str) -> str:
    return f'?work cdm:resource_legal_id_celex ?c . FILTER(STR(?c) = "{escape(celex)}")'


def metadata_query(celex: str, predicates: dict[str, str]) -> str:
    """One branch a data type, rows (data_type, value) without repeats."""
    branches = " UNION ".join(f'{{ ?work {p} ?value . BIND("{n}" AS ?data_type) }}' for n, p in predicates.items())
    return f"SELECT DISTINCT ?data_type ?value WHERE {{ {id_filter(celex)} {branches} }}"


def enrichment_query(celex: str, categories: list[str], predicates: dict[str, str]) -> str:
    """Branches of the categories and a sentinel row each, by which a cut answer is told from an empty one."""
    parts = [f'{{ ?work {predicates[f]} ?value . BIND("{f}" AS ?data_type) }}' for c in categories for f in FIELDS[c] if f in predicates]
    parts += [f'{{ BIND("{SENTINEL}{c}" AS ?data_type) BIND("1" AS ?value) }}' for c in categories]
    return f"SELECT DISTINCT ?data_type ?value WHERE {{ {id_filter(celex)} {' UNION '.join(parts)} }} ORDER BY ?data_type ?value"


def discovery_query(codes: list[tuple[str, str]], start: str, end: str, concepts: list[str], corrigenda: bool, consolidated: bool) -> str:
    kinds = " || ".join(f'(REGEX(STR(?c), "^{s}[0-9]{{4}}{t}[0-9]"))' for t, s in codes)
    more = "" if corrigenda else ' FILTER(!REGEX(STR(?c), "R\\\\([0-9]+\\\\)$"))'
    more += "" if consolidated else ' FILTER(!STRSTARTS(STR(?c), "0"))'
    voc = f" VALUES ?concept {{ {' '.join(f'<{c}>' for c in concepts)} }} ?work cdm:work_is_about_concept_eurovoc ?concept ." if concepts else ""
    return f'SELECT DISTINCT ?c WHERE {{ ?work cdm:resource_legal_id_celex ?c ; cdm:work_date_document ?d .{voc} FILTER({kinds}) FILTER(?d >= "{start}"^^xsd:date && ?d <= "{end}"^^xsd:date){more} }} ORDER BY ?c'


def concept_query(keywords: list[str], scheme: str) -> str:
    """English preferred and alternative labels of a scheme that hold one of the keywords, letter case aside."""
    holds = " || ".join(f'CONTAINS(LCASE(STR(?label)), "{escape(k.lower())}")' for k in keywords)
    return f'SELECT DISTINCT ?concept ?label WHERE {{ ?concept skos:inScheme <{scheme}> . {{ ?concept skos:prefLabel ?label }} UNION {{ ?concept skos:altLabel ?label }} FILTER(LANGMATCHES(LANG(?label), "en")) FILTER({holds}) }} ORDER BY ?concept ?label'


#: What is asked about a concept: kind -> path from the concept to the text (fixed values).
CONCEPT_PATHS = {"definition": "skos:definition", "broader": "skos:broader/skos:prefLabel", "narrower": "skos:narrower/skos:prefLabel", "related": "skos:related/skos:prefLabel"}


def concept_info_query(concept: str) -> str:
    """Definition of a concept and English labels of those around it: rows (data_type, value)."""
    parts = [f'{{ <{concept}> {path} ?value . BIND("{kind}" AS ?data_type) }}' for kind, path in CONCEPT_PATHS.items()]
    return f'SELECT DISTINCT ?data_type ?value WHERE {{ {" UNION ".join(parts)} FILTER(LANGMATCHES(LANG(?value), "en")) }} ORDER BY ?data_type ?value'


def procedure_query(numbers: list[str]) -> str:
    """Adopted act and proposal of procedures, either of which may be missing."""
    values = " ".join(f'"{escape(n)}"' for n in numbers)
    return f"SELECT DISTINCT ?procedure ?work ?proposal WHERE {{ VALUES ?procedure {{ {values} }} ?dossier cdm:procedure_code_interinstitutional_reference_procedure ?procedure . OPTIONAL {{ ?dossier cdm:dossier_contains_work/cdm:resource_legal_id_celex ?work }} OPTIONAL {{ ?dossier cdm:dossier_initiated_by_work/cdm:resource_legal_id_celex ?proposal }} }}"


def manifest_query(celex: str) -> str:
    """Language and address of the PDF manifestations of an act: rows (data_type: language, value: address)."""
    return f'SELECT DISTINCT ?data_type ?value WHERE {{ {id_filter(celex)} ?e cdm:expression_belongs_to_work ?work ; cdm:expression_uses_language/skos:notation ?data_type . ?value cdm:manifestation_manifests_expression ?e ; cdm:manifestation_type ?t . FILTER(CONTAINS(LCASE(STR(?t)), "pdf")) }} ORDER BY ?data_type ?value'


def manifest(rows: list[dict]) -> dict[str, str]:
    """Language -> address of its first PDF; languages as three small letters."""
    out: dict[str, str] = {}
    for r in rows:
        if r["data_type"] and r["value"]:
            out.setdefault(r["data_type"].rsplit("/", 1)[-1].lower(), r["value"])
    return out


def bindings(answer) -> list[dict]:
    if not isinstance(answer, dict):
        raise TransientError("the endpoint did not answer with an object")
    return [
        {"data_type": b.get("data_type", {}).get("value"), "value": b.get("value", {}).get("value"), "value_type": b.get("value", {}).get("type"), "datatype": b.get("value", {}).get("datatype"), "lang": b.get("value", {}).get("xml:lang")}
        for b in answer.get("results", {}).get("bindings", [])
    ]


def complete(rows: list[dict], categories: list[str]) -> bool:
    """Whether every category's sentinel came; without it the answer is refused."""
    got = {r["data_type"] for r in rows}
    return all(SENTINEL + c in got for c in categories)


class _Choices(HTMLParser):
    """Items of a multiple-choice page: link, stream name and stream order."""

    def __init__(self):
        super().__init__()
        self.items, self.field = [], None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "li" and a.get("title") == "item":
            self.items.append({"url": None, "stream_name": "", "stream_order": 999})
        elif tag == "li" and a.get("title") in ("stream_name", "stream_order"):
            self.field = a["title"]
        elif tag == "a" and self.items and self.items[-1]["url"] is None:
            self.items[-1]["url"] = a.get("href")

    def handle_endtag(self, tag):
        if tag == "li":
            self.field = None

    def handle_data(self, data):
        v = data.strip().split(":")[-1].strip()
        if self.field and v and self.items:
            if self.field == "stream_order":
                self.items[-1]["stream_order"] = int(v) if v.isdigit() else 999
            else:
                self.items[-1]["stream_name"] = v


def parse_choices(page: bytes | str) -> list[dict]:
    p = _Choices()
    p.feed(page.decode("utf-8", "replace") if isinstance(page, bytes) else page)
    return [x for x in p.items if x["url"]]


def pick_choice(items: list[dict]) -> str | None:
    """The main text: no annex, cover or correction unless there is nothing else; ACT first, then the least order."""
    main = [x for x in items if not re.search(r"annexe|annex|cover|erratum|corrigendum", x["stream_name"], re.I)]
    if not main:
        return items[0]["url"] if items else None
    return min(main, key=lambda x: x["stream_order"] - 1000 * ("ACT" in x["stream_name"].upper()))["url"]


class Http:
    """One partition's session: spacing between requests, retries with growing pauses, or recorded answers."""

    def __init__(self, interval: float = REST_INTERVAL, recorded: str | None = None, retries: int = 5, backoff: float = 1.0):
        self.interval, self.recorded, self.retries, self.backoff, self.last = interval, recorded, retries, backoff, 0.0

    def get(self, url: str, headers: dict | None = None, timeout: int = TIMEOUT) -> tuple[int | None, bytes]:
        if self.recorded:
            name = hashlib.sha256((url + json.dumps(headers or {}, sort_keys=True)).encode()).hexdigest()[:24]
            for p in (f"{self.recorded}/{name}.json", f"{self.recorded}/{urllib.parse.quote(url, safe='')[:200]}.json"):
                if os.path.exists(p):
                    with open(p, encoding="utf-8") as f:
                        a = json.load(f)
                    return a["status"], a["body"].encode()
            return 404, b""
        status, body = None, b""
        for k in range(self.retries):
            pause = self.last + self.interval - time.monotonic()
            if pause > 0:
                time.sleep(pause)
            self.last = time.monotonic()
            try:
                with urllib.request.urlopen(urllib.request.Request(url, headers=headers or {}), timeout=timeout) as r:
                    return r.status, r.read()
            except urllib.error.HTTPError as e:
                status, body = e.code, e.read()
                if status not in RETRY_STATUS:
                    return status, body
            except OSError:
                status = None
            time.sleep(self.backoff * 2**k)
        return status, body

    def follow(self, url: str, headers: dict) -> tuple[int | None, bytes]:
        """A choice is followed once; a choice behind a choice is nothing."""
        status, body = self.get(url, headers)
        if status != 300:
            return status, body
        to = pick_choice(parse_choices(body))
        if to is None:
            return 404, b""
        status, body = self.get(to, headers)
        return (404, b"") if status == 300 else (status, body)


class _Slice(InputPartition):
    def __init__(self, ids: list[str]):
        self.ids = ids


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.o = options
        self.ids = json.loads(options.get("ids", "[]"))
        self.parts = max(1, int(options.get("partitions", "4")))

    def partitions(self):
        n = min(self.parts, max(1, len(self.ids)))
        return [_Slice(self.ids[i::n]) for i in range(n)]

    def session(self, interval: float) -> Http:
        at_once = min(self.parts, len(self.ids)) if self.ids else self.parts
        return Http(float(self.o.get("interval", interval)) * at_once, self.o.get("recorded"))


class _SparqlReader(_Reader):
    def read(self, partition):
        http = self.session(ENRICH_INTERVAL if self.o.get("categories") else REST_INTERVAL)
        preds = json.loads(self.o.get("predicates", "{}"))
        cats = [c for c in self.o.get("categories", "").split(",") if c]
        for i in partition.ids:
            q = enrichment_query(i, cats, preds) if cats else metadata_query(i, preds)
            status, body = http.get(self.o["endpoint"] + "?" + urllib.parse.urlencode({"query": q, "format": "application/sparql-results+json"}))
            if status != 200:
                if self.o.get("on_failure") == "row":
                    yield (i, FAILURE, f"status {status}", None, None, None)
                    continue
                raise TransientError(f"{i}: status {status}")
            rows = bindings(json.loads(body))
            if cats and not complete(rows, cats):
                if self.o.get("on_failure") == "row":
                    yield (i, FAILURE, "the answer is not whole", None, None, None)
                    continue
                raise TransientError(f"{i}: the answer is not whole")
            for r in rows:
                yield (i, r["data_type"], r["value"], r["value_type"], r["datatype"], r["lang"])


class _QueryReader(_Reader):
    """One query's answer as it is: a map of the variables of each row."""

    def partitions(self):
        return [_Slice([])]

    def read(self, partition):
        http = Http(float(self.o.get("interval", REST_INTERVAL)), self.o.get("recorded"))
        url = self.o["endpoint"] + "?" + urllib.parse.urlencode({"query": self.o["query"], "format": "application/sparql-results+json"})
        status, body = http.get(url, timeout=DISCOVERY_TIMEOUT)
        if status != 200:
            raise TransientError(f"status {status}")
        answer = json.loads(body)
        if not isinstance(answer, dict):
            raise TransientError("the endpoint did not answer with an object")
        for b in answer.get("results", {}).get("bindings", []):
            yield ({k: v.get("value") for k, v in b.items()},)


class _RestReader(_Reader):
    def read(self, partition):
        http = self.session(REST_INTERVAL)
        langs = self.o.get("languages", "eng,fra,deu,ita,nld,spa").split(",")
        for i in partition.ids:
            pdf_failed = done = False
            for lang in langs:
                for fmt, accept in (("html", "application/xhtml+xml, text/html"), ("pdf", "application/pdf")):
                    if fmt == "pdf" and pdf_failed:
                        continue
                    status, body = http.follow(f"{self.o['endpoint']}/{urllib.parse.quote(i, safe='')}", {"Accept": accept, "Accept-Language": lang})
                    kind = classify(status, body)
                    if fmt == "pdf" and kind == "ok" and not body.startswith(b"%PDF-"):
                        kind = "missing"
                    pdf_failed = pdf_failed or (fmt == "pdf" and kind == "transient")
                    yield (i, lang, fmt, status, body if kind == "ok" else None)
                    if kind == "ok":
                        done = True
                        break
                if done:
                    break


class SparqlSource(DataSource):
    @classmethod
    def name(cls):
        return "lex_sparql"

    def schema(self):
        return _ROWS

    def reader(self, schema):
        return _SparqlReader(dict(self.options))


class QuerySource(DataSource):
    @classmethod
    def name(cls):
        return "lex_query"

    def schema(self):
        return StructType([StructField("row", MapType(StringType(), StringType()))])

    def reader(self, schema):
        return _QueryReader(dict(self.options))


class RestSource(DataSource):
    @classmethod
    def name(cls):
        return "lex_rest"

    def schema(self):
        return _CONTENT

    def reader(self, schema):
        return _RestReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SparqlSource)
    spark.dataSource.register(RestSource)
    spark.dataSource.register(QuerySource)


def probe_pdf(http: Http, base: str, most: int = 4) -> bytes | None:
    """DOC_1, DOC_2, ... below a manifestation: the first that is a PDF; stops where access is denied."""
    for k in range(1, most + 1):
        status, body = http.get(f"{base}/DOC_{k}")
        kind = classify(status, body)
        if kind == "transient":
            raise TransientError(f"{base}: status {status}")
        if kind == "ok" and body.startswith(b"%PDF-"):
            return body
        if status not in (200, 404):
            return None
    return None


def fetch_pdf(http: Http, addresses: dict[str, str], languages: tuple[str, ...]) -> tuple[bytes, str] | None:
    """The first PDF there is in the order of the languages, and its language; addresses as manifest() gives them."""
    for lang in languages:
        if lang in addresses and (body := probe_pdf(http, addresses[lang])) is not None:
            return body, lang
    return None


class RemoteCatalogue(CatalogueSource):
    """A SPARQL endpoint and a REST store. options: as of the data sources (endpoint, rest, predicates, recorded, ...)."""

    def __init__(self, spark: SparkSession, scheme: str = "http://eurovoc.europa.eu/100141", load_pdf=None, **options: str):
        register(spark)
        self.spark, self.scheme, self.load_pdf, self.options = spark, scheme, load_pdf, options

    def _ask(self, query: str):
        return self.spark.read.format("lex_query").options(query=query, **self.options).load()

    def concepts(self, keywords: list[str]) -> list[str]:
        return sorted({r[0] for r in self._ask(concept_query(keywords, self.scheme)).select("row.concept").collect()})

    def discover(self, types: list[str], start, end, concepts: list[str], corrigenda: bool, consolidated: bool) -> DataFrame:
        codes = [(t, s) for t, name in I.DOC_TYPES.items() if name in types for s in I.SECTORS[name]]
        return self._ask(discovery_query(codes, str(start), str(end), concepts, corrigenda, consolidated)).select(F.col("row.c").alias("celex_id")).distinct()

    def procedures(self, numbers: list[str]) -> DataFrame:
        return self._ask(procedure_query(numbers)).select("row.procedure", "row.work", "row.proposal")

    def _of(self, reader: type[_Reader], schema: StructType, ids: DataFrame, **more: str) -> DataFrame:
        """The rows of a reader for ids that stay distributed: each partition asks for its own, at its share of the rate."""
        options = self.options | more
        parts = max(1, int(options.get("partitions", "4")))

        def run(frames):
            session = reader(options)
            for f in frames:
                if rows := list(session.read(_Slice(f["celex_id"].tolist()))):
                    yield pd.DataFrame(rows, columns=schema.names, dtype=object)

        return ids.select("celex_id").distinct().repartition(parts).mapInPandas(run, schema)

    def metadata(self, ids: DataFrame) -> DataFrame:
        return self._of(_SparqlReader, _ROWS, ids).select("celex_id", "data_type", "value")

    def enrichment(self, ids: DataFrame, categories: tuple[str, ...]) -> DataFrame:
        return self._of(_SparqlReader, _ROWS, ids, categories=",".join(categories), on_failure="row").select("celex_id", "data_type", "value")

    def content(self, ids: DataFrame) -> DataFrame:
        from ..plans.pipeline import negotiated

        return negotiated(self._of(_RestReader, _CONTENT, ids, endpoint=self.options.get("rest", self.options.get("endpoint", ""))), self.load_pdf)
