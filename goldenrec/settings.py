"""Fixed values and default parameters.

Every setting here is a default for a function parameter; no module reads a
global at run time, so a job can override any of them per call.
"""

from __future__ import annotations

# --- Fixed values (must equal the surveyed behaviour) -----------------------

# Source-system tags derived from a file path. Case-sensitive substring test,
# first match wins, in this order; anything else is "Unknown".
SOURCE_SYSTEMS: tuple[tuple[str, str], ...] = (
    ("SAP", "SAP"),
    ("salesforce", "Salesforce"),
    ("healthcare", "Healthcare"),
    ("oddo", "Odoo"),
    ("zoho", "Zoho"),
)
UNKNOWN_SOURCE = "Unknown"

# Confidence from repetition: > HIGH_ABOVE is High, == MODERATE_AT is Moderate,
# everything else Low.
HIGH_ABOVE = 2
MODERATE_AT = 2

# Confidence label -> rank used to order golden-record candidates.
CONFIDENCE_RANKS: tuple[tuple[str, int], ...] = (
    ("High", 3),
    ("Moderate", 2),
    ("Low", 1),
)

# Bronze rules for the person feed.
BRONZE_QUALITY_RULES: dict[str, str] = {
    "valid_person_id": "person_id IS NOT NULL",
    "valid_age": "age > 0",
}

# Generic pre-bronze rule (declared upstream; always true for md5 hashes).
PRE_BRONZE_QUALITY_RULES: dict[str, str] = {
    "non_empty_record": "_record_hash IS NOT NULL",
}

# Default reader options per format; user options win on conflict.
DEFAULT_READ_OPTIONS: dict[str, dict[str, str]] = {
    "csv": {
        "header": "true",
        "inferSchema": "true",
        "multiLine": "true",
        "escape": '"',
        "quote": '"',
    },
    "json": {"multiLine": "true"},
    "parquet": {},
}
SUPPORTED_FORMATS: tuple[str, ...] = ("csv", "json", "parquet")

# Characters kept by phone normalization (everything else is removed).
PHONE_STRIP_PATTERN = r"[^0-9+]"

# Three-state boolean vocabulary (lower-cased input).
TRUE_WORDS: tuple[str, ...] = ("true", "yes", "1", "t", "y")
FALSE_WORDS: tuple[str, ...] = ("false", "no", "0", "f", "n")
# Two-state vocabulary: these are true, everything else (NULL too) is false.
TWO_STATE_TRUE_WORDS: tuple[str, ...] = ("true", "yes", "1")

# Record-hash separator and identifier fallback separator.
HASH_SEPARATOR = "||"
FALLBACK_SEPARATOR = "_"

# Value patterns for type inference, tried in this order, first match wins.
TYPE_PATTERNS: tuple[tuple[str, str], ...] = (
    ("timestamp", r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}"),
    ("date", r"^\d{4}-\d{2}-\d{2}$"),
    ("boolean", r"(?i)^(true|false|yes|no|1|0)$"),
    ("integer", r"^-?\d+$"),
    ("double", r"^-?\d+\.\d+$"),
)
# Semantic patterns reported next to the type profile.
SEMANTIC_PATTERNS: tuple[tuple[str, str], ...] = (
    ("email", r"^[\w\.-]+@[\w\.-]+\.\w+$"),
    ("phone", r"^[\+]?[\d\s\-\(\)]+$"),
    ("currency", r"^[\$€£¥]?\d+\.?\d*$"),
)
TYPE_THRESHOLD = 0.8
INT_MAX = 2147483647
SCHEMA_SAMPLE_SIZE = 100

# Column-name keywords per category, tested as substrings of the lower-cased
# name, categories in this precedence order.
COLUMN_CATEGORIES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("identifier", ("id", "key", "code", "sku", "number")),
    ("temporal", ("date", "time", "created", "updated", "modified")),
    ("descriptive", ("name", "title", "description", "label")),
    ("contact", ("email", "phone", "address", "city", "country", "zip")),
    ("metric", ("amount", "price", "cost", "quantity", "count", "total", "sum")),
)
GENERAL_CATEGORY = "general"
MAX_DEDUP_SUGGESTIONS = 5

# Layer table names.
TABLE_NAMES: dict[str, str] = {
    "bronze": "dd_bronze",
    "silver_clean": "dd_silver_clean",
    "silver_identified": "dd_silver_identified",
    "gold_duplicate_count": "dd_gold_duplicate_count",
    "gold_confidence_scored": "dd_gold_confidence_scored",
    "gold_final": "dd_gold_final",
}

# Columns the silver layer keeps, and the scored-table column list.
SILVER_COLUMNS: tuple[str, ...] = ("person_id", "name", "email", "phone", "age", "source_system")
SCORED_COLUMNS: tuple[str, ...] = SILVER_COLUMNS + ("unique_identifier", "confidence")

# Name columns that get initcap(trim()).
NAME_COLUMNS: tuple[str, ...] = ("first_name", "last_name", "name", "product_name")

# --- Tunables (not part of the surveyed behaviour) --------------------------

# Skew-aware scoring join: with N records, identifiers with at least N / K
# rows are "hot": a thousandth of the table, more than an even share of a task. At most K identifiers can qualify, so their (key, count)
# rows have a proven size bound (K rows) and are broadcast; every
# other identifier holds fewer than N / K rows.
HOT_KEY_MAX_KEYS = 1_000
# Columns per aggregation pass in wide-table profiling (keeps generated
# methods below the JVM limit).
PROFILE_COLUMNS_PER_PASS = 100
