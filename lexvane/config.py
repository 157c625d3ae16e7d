"""Settings of a detection run, as one immutable value."""

from __future__ import annotations

from dataclasses import dataclass

# The informational keywords looked for in cleaned text.
INFO_KEYWORDS: tuple[str, ...] = (
    "report", "analysis", "threat intelligence", "vulnerability", "advisory",
    "bulletin", "detected", "detection", "signature", "research", "blog post",
    "news", "article", "mitigation", "indicator", "ioc", "campaign analysis",
    "security brief", "overview", "summary", "presentation", "webinar",
    "biopass", "rat", "malware", "backdoor", "exe", "figure", "loader", "used",
    "win64", "version", "file", "code", "ransomware", "attacks", "malicious",
    "attack", "samples", "family", "using", "command", "group", "variant",
    "use", "plugx", "protux", "anel", "new", "server", "cyclops", "infection",
)

# Entity types that count as informational.
INFO_ENTITY_TYPES: tuple[str, ...] = ("ORG", "PRODUCT", "GPE", "PERSON")

# Names of the two classes in reports.
CLASS_NAMES: tuple[str, str] = ("Not Malware (0)", "Malware (1)")

# Names of feature columns and of the target.
MALWARE_FLAG = "malware_flag"
KEYWORD_FLAG = "has_info_keywords"
ENTITY_FLAG = "has_info_entities"
MAX_DEGREE = "graph_max_malware_degree"
TOTAL_EDGES = "graph_total_edges"
TARGET = "true_label"


@dataclass(frozen=True)
class DetectionConfig:
    """What a detection run does.

    ``dictionary_from``: ``"all"`` builds the dictionary from every row (the
    evaluation then sees names taken from its own test rows); ``"train"`` builds
    it from the training rows only.
    ``split_order``: an SQL expression of a non-negative whole number below
    ``2 ** split_order_bits``, spread evenly; it orders the rows of a class for
    the split instead of the seeded hash of the id.
    ``normalize_terms_as_text``: clean dictionary terms the way texts are
    cleaned, so that terms holding punctuation can match.
    """

    id_col: str = "row_id"
    text_col: str = "text"
    relations_col: str = "relations"
    test_size: float = 0.2
    seed: int = 42
    min_term_length: int = 4
    keywords: tuple[str, ...] = INFO_KEYWORDS
    entity_types: tuple[str, ...] = INFO_ENTITY_TYPES
    dictionary_from: str = "all"
    normalize_terms_as_text: bool = False
    whole_word: bool = False
    match_plan: str = "auto"
    c: float = 1.0
    max_iter: int = 1000
    split_order: str | None = None
    split_order_bits: int = 63
