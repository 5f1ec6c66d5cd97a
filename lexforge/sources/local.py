"""A catalogue over tables, for runs without a network and for tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import ids as I
from ..operators import relational as R
from .protocols import CatalogueSource


class LocalCatalogue(CatalogueSource):
    """tables: acts (celex_id, date_adopted), labels (celex_id, eurovoc_uri, eurovoc_label), procedures (procedure, work,
    proposal), facts (celex_id, data_type, value), content (celex_id, content_type, language, body[, outcome, error])."""

    def __init__(self, acts: DataFrame, labels: DataFrame, procedures: DataFrame, facts: DataFrame, content: DataFrame):
        self.acts, self.labels, self.of_procedures, self.facts, self.pages = acts, labels, procedures, facts, content

    def concepts(self, keywords: list[str]) -> list[str]:
        asked = self.acts.sparkSession.createDataFrame([(k,) for k in keywords], "keyword string")
        known = self.labels.select("eurovoc_uri", F.col("eurovoc_label").alias("label")).where("label is not null").distinct()
        return sorted(r[0] for r in R.substring_join(asked, known).select("eurovoc_uri").distinct().collect())

    def discover(self, types, start, end, concepts, corrigenda, consolidated) -> DataFrame:
        return I.discover(self.acts, types, str(start), str(end), concepts or None, corrigenda=corrigenda, consolidated=consolidated, descriptors=self.labels)

    def procedures(self, numbers: list[str]) -> DataFrame:
        return self.of_procedures.where(F.col("procedure").isin(numbers))

    def metadata(self, ids: DataFrame) -> DataFrame:
        return self.facts.join(ids.select("celex_id").distinct(), "celex_id", "left_semi").where(~F.col("data_type").startswith("zz_"))

    def enrichment(self, ids: DataFrame, categories: tuple[str, ...]) -> DataFrame:
        return self.facts.join(ids.select("celex_id").distinct(), "celex_id", "left_semi")

    def content(self, ids: DataFrame) -> DataFrame:
        return ids.select("celex_id").distinct().join(self.pages, "celex_id", "left")
