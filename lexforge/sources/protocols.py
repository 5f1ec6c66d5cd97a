"""What a caller may replace: each part takes and gives DataFrames, so one cluster plan holds them all."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import DataFrame


class CatalogueSource(ABC):
    """Where acts are found and read. RemoteCatalogue (catalogue.py) asks endpoints, LocalCatalogue (local.py) tables."""

    @abstractmethod
    def concepts(self, keywords: list[str]) -> list[str]:
        """Concepts with a label that holds one of the keywords."""

    @abstractmethod
    def discover(self, types: list[str], start, end, concepts: list[str], corrigenda: bool, consolidated: bool) -> DataFrame:
        """(celex_id) of the acts asked for."""

    @abstractmethod
    def procedures(self, numbers: list[str]) -> DataFrame:
        """(procedure, work, proposal) rows."""

    @abstractmethod
    def metadata(self, ids: DataFrame) -> DataFrame:
        """(celex_id, data_type, value) rows of the ids."""

    @abstractmethod
    def enrichment(self, ids: DataFrame, categories: tuple[str, ...]) -> DataFrame:
        """(celex_id, data_type, value) rows with a sentinel a category that was answered whole."""

    @abstractmethod
    def content(self, ids: DataFrame) -> DataFrame:
        """(celex_id, content_type, language, body, outcome, error); body null where there is none."""
