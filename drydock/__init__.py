"""drydock: bulk data drops taken in, cleaned, described and profiled with Spark."""

from drydock.config import (
    ColumnRoles, Dataset, DateRules, DEFAULT_REGISTRY, DictionaryGrammar, GridRoles, Provenance, Registry)
from drydock.plans.ingest import ingest
from drydock.plans.summarize import summarize
from drydock.streaming.incremental import incremental_ingest

__all__ = [
    "ColumnRoles", "Dataset", "DateRules", "DEFAULT_REGISTRY", "DictionaryGrammar", "GridRoles",
    "Provenance", "Registry", "ingest", "summarize", "incremental_ingest"]
