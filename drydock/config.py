"""Parameters of the toolkit: dataset registry, column roles, grammars, tokens.

Everything an operator needs to know about one family of data drops lives
here, so that the operators themselves stay free of any one agency's names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Fixed values. They must be exactly these for results to match.
# --------------------------------------------------------------------------

# Tokens a CSV reader treats as null (exact match, not stripped).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Tokens a CSV reader treats as booleans.
TRUE_TOKENS = ("True", "TRUE", "true")
FALSE_TOKENS = ("False", "FALSE", "false")

# Identifier columns, in output order.
ID_COLUMNS = (
    "ID_RSSD", "ID_RSSD_HD_OFF", "ID_RSSD_PREDECESSOR",
    "ID_RSSD_SUCCESSOR", "ID_RSSD_PARENT", "ID_RSSD_OFFSPRING",
)

# Date columns, in output order and in order of preference for date coverage.
DATE_COLUMNS = (
    "D_DT_START", "D_DT_END", "D_DT_OPEN", "D_DT_TRANS", "DT_EXIST",
    "DT_END", "DT_START", "DT_OPEN", "DT_TRANS",
)

UNKNOWN_TABLE = "UNKNOWN"
UNKNOWN_DATASET = "Unknown dataset"

# What Python calls white space; both ends of a value are stripped of these.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


# --------------------------------------------------------------------------
# Registry
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Dataset:
    """One registered dataset: how its archive is recognised and described."""

    name: str
    archive_pattern: str
    dict_table: str
    description: str
    archive_file: str = ""
    landing_note: str = ""

    @property
    def file_name(self) -> str:
        return self.archive_file or f"{self.archive_pattern}.ZIP"


@dataclass(frozen=True)
class Registry:
    """Ordered datasets; the first pattern found in a file name wins."""

    datasets: tuple[Dataset, ...]

    def __iter__(self):
        return iter(self.datasets)

    def names(self) -> list[str]:
        return [d.name for d in self.datasets]

    def get(self, name: str) -> Dataset:
        for d in self.datasets:
            if d.name == name:
                return d
        raise KeyError(f"no dataset named {name!r} is registered")


# Names, archive patterns, dictionary tables and descriptions.
DEFAULT_REGISTRY = Registry((
    Dataset("attributes_active", "CSV_ATTRIBUTES_ACTIVE", "ATTRIBUTES",
            "Active financial institutions",
            landing_note="Active financial institutions"),
    Dataset("attributes_closed", "CSV_ATTRIBUTES_CLOSED", "ATTRIBUTES",
            "Closed institutions",
            landing_note="Closed institutions (last instance)"),
    Dataset("attributes_branches", "CSV_ATTRIBUTES_BRANCHES", "ATTRIBUTES",
            "Branch offices",
            landing_note="Branch office information"),
    Dataset("relationships", "CSV_RELATIONSHIPS", "RELATIONSHIPS",
            "Ownership relationships",
            landing_note="Ownership relationships between companies"),
    Dataset("transformations", "CSV_TRANSFORMATIONS", "TRANSFORMATIONS",
            "Mergers and acquisitions",
            landing_note="Mergers, acquisitions, and changes"),
))


# --------------------------------------------------------------------------
# Roles, grammars, file classes
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class ColumnRoles:
    """Column names recognised as identifiers and dates, in priority order."""

    id_columns: tuple[str, ...] = ID_COLUMNS
    date_columns: tuple[str, ...] = DATE_COLUMNS


@dataclass(frozen=True)
class SectionMarker:
    """A dictionary table and the phrases which announce it.

    Markers are tried in order, so a longer numeral must precede the shorter
    one it contains.
    """

    table: str
    phrases: tuple[str, ...]


@dataclass(frozen=True)
class DictionaryGrammar:
    """Labels, section markers and stop phrases of a text dictionary."""

    # The document's own wording.
    column_label: str = "COLUMN:"
    type_label: str = "DATA TYPE:"
    description_label: str = "DESCRIPTION:"
    markers: tuple[SectionMarker, ...] = (
        SectionMarker("TRANSFORMATIONS", ("SECTION VI", "TRANSFORMATIONS TABLE DETAILS")),
        SectionMarker("RELATIONSHIPS", ("SECTION V ", "RELATIONSHIPS TABLE DETAILS")),
        SectionMarker("ATTRIBUTES", ("SECTION IV", "ATTRIBUTES TABLE DETAILS")),
    )
    stop_phrases: tuple[str, ...] = (
        "SECTION IV", "SECTION V", "SECTION VI",
        "ATTRIBUTES TABLE", "RELATIONSHIPS TABLE", "TRANSFORMATIONS TABLE",
    )
    unknown_table: str = UNKNOWN_TABLE
    min_name_length: int = 2
    max_page_number_digits: int = 3


@dataclass(frozen=True)
class GridRoles:
    """Words which tell the name column and the text column of a grid."""

    # Fixed values.
    name_words: tuple[str, ...] = ("field", "variable", "column", "name", "element")
    text_words: tuple[str, ...] = ("description", "definition", "desc")
    name_pattern: str = r"\A[A-Z][A-Z0-9_]*\z"


# File classes of a landing zone and their name patterns.
FILE_CLASSES: dict[str, tuple[str, ...]] = {
    "raw": ("*.zip", "*.ZIP", "*.pdf", "*.PDF"),
    "processed": ("*.parquet",),
    "dictionary": ("variable_dictionary.csv", "variable_dictionary.txt"),
}


@dataclass(frozen=True)
class DateRules:
    """How text becomes a date: ordered (pattern, ISO rewrite) pairs and a
    valid range. Values outside the range count as no date, so that an
    open-ended sentinel such as year 9999 never becomes a maximum."""

    rewrites: tuple[tuple[str, str], ...] = (
        (r"^\s*(\d{4})(\d{2})(\d{2})\s*$", "$1-$2-$3"),
        (r"^\s*(\d{4}-\d{1,2}-\d{1,2})\s*$", "$1"),
        (r"^\s*(\d{4}-\d{1,2}-\d{1,2})[ T](\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,9})?)?)\s*$", "$1 $2"),
        (r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s*$", "$3-$1-$2"),
        (r"^\s*(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,9})?)?)\s*$", "$3-$1-$2 $4"),
        (r"^\s*(\d{4})/(\d{1,2})/(\d{1,2})\s*$", "$1-$2-$3"),
        (r"^\s*(\d{4})/(\d{1,2})/(\d{1,2}) (\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,9})?)?)\s*$", "$1-$2-$3 $4"),
        # an offset is left out: the date is the one written
        (r"^\s*(\d{4}-\d{1,2}-\d{1,2})[ T](\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,9})?)?) ?(?:Z|[+-]\d{2}:?\d{2})\s*$",
         "$1 $2"),
    )
    twelve_hours: tuple[str, ...] = (
        r"^\s*(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2})(:\d{2}(?::\d{2})?) ?([AaPp])[Mm]\s*$",)
    month_names: tuple[str, ...] = (r"^\s*(\d{1,2})[- ]([A-Za-z]{3})[A-Za-z]*[- ,]+(\d{4})\s*$",)
    earliest: str = "1677-09-22 00:00:00"
    latest: str = "2262-04-11 23:47:16"


@dataclass(frozen=True)
class Provenance:
    """Table-level properties published with every dataset."""

    source: str = ""
    source_url: str = ""
    extra: dict[str, str] = field(default_factory=dict)

    def properties(self, description: str) -> dict[str, str]:
        return {
            **self.extra,
            "dataset_description": description,
            "source": self.source,
            "source_url": self.source_url,
        }
