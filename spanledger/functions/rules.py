"""Pattern tables. They are data: operators turn them into CASE chains and extractions."""

# Page furniture of regulation prints, by rule name, in order of precedence.
REGULATION_FURNITURE = (
    ("PAGE_HEADER_PART_DATE", r"^21 CFR Part \d+ \(up to date as of \d{1,2}/\d{1,2}/\d{4}\)\s*$"),
    ("PAGE_HEADER_PART_PUBDATE", r"^21 CFR Part \d+ \([A-Z][a-z]+\.? \d{1,2},? \d{4}\)\s*$"),
    ("PAGE_FOOTER_COMBINED", r"^21 CFR \d+\.\d+[\w\.\(\)]* \(enhanced display\)\s+page \d+ of \d+\s*$"),
    ("PAGE_FOOTER_CITATION", r"^21 CFR \d+\.\d+[\w\.\(\)]* \(enhanced display\)\s*$"),
    ("PAGE_FOOTER_PAGE", r"^page \d+ of \d+\s*$"),
    ("PAGE_FOOTER_CITATION_BARE", r"^21 CFR \d+\.\d+(?:\([a-z0-9]+\))*\s*$"),
    ("ECFR_DISCLAIMER", r"^This content is from the eCFR and is authoritative but unofficial\.\s*$"),
)

# Furniture that only guidelines of the "ich" citation format carry.
GUIDELINE_FURNITURE = (
    ("PAGE_FOOTER_EMEA", r"^[\W_]{0,3}EMEA\s+\d{4}\b.*$"),
    ("PAGE_HEADER_ICH_GUIDELINE", r"^\d*\s*ICH\s+E\d[\w()]*\s+Guideline\s*$"),
    ("PAGE_HEADER_ICH_HARMONISED", r"(?i)^ICH\s+Harmonised\s+Guideline\s*$"),
)

#: Our own pack for general corpora.
CORPUS_FURNITURE = (
    ("LICENSE_LINE", r"licensed under|Released under the|All rights reserved"),
    ("LICENSED_LINE", r"^Licensed under"),
    ("EMAIL_LINE", r"[a-z0-9.]@[a-z0-9.]"),
    ("TOKEN_LINE", r"(token|password) ?="),
)

MARKER = r"(?m)^\s*(?:\([a-z0-9ivxlcdm]+\)\s+)?"

# Obligation signals as (name, class, pattern).
SIGNALS = (
    ("shall", "modal_obligation", r"(?i)\bshall\b"),
    ("must", "modal_obligation", r"(?i)\bmust\b"),
    ("may", "modal_permissive", r"(?<![\.\!\?]\s)\bmay\b(?!\s+\d{1,2}(?:,?\s+\d{4})?)"),
    ("should", "modal_permissive", r"(?i)\bshould\b"),
    ("use_of", "nominal_imperative", MARKER + r"Use of\s"),
    ("determination", "nominal_imperative", MARKER + r"Determination\s"),
    ("establishment", "nominal_imperative", MARKER + r"(?:The\s+)?[Ee]stablishment\s"),
    ("implementation", "nominal_imperative", MARKER + r"Implementation\s"),
    ("maintenance", "nominal_imperative", MARKER + r"Maintenance\s"),
    ("validation", "nominal_imperative", MARKER + r"Validation\s"),
    ("protection", "nominal_imperative", MARKER + r"Protection\s"),
    ("limiting", "nominal_imperative", MARKER + r"Limiting\s"),
    ("ensuring", "nominal_imperative", MARKER + r"Ensuring\s"),
    ("maintaining", "nominal_imperative", MARKER + r"Maintaining\s"),
    ("following_procs", "nominal_imperative", MARKER + r"Following\s"),
    ("may_also_apply", "inclusion_clause", r"(?i)\bmay\s+also\s+be\s+applied\s+to\b"),
    ("shall_include", "inclusion_clause", r"(?i)\bshall\s+include\b"),
    ("includes", "inclusion_clause", r"(?i)\bincludes?\b"),
    ("is_intended_to", "inclusion_clause", r"(?i)\bis\s+intended\s+to\b"),
    ("for_purposes_of", "inclusion_clause", r"(?i)\bfor\s+(?:the\s+)?purposes?\s+of\b"),
    ("does_not_apply", "exclusion_clause", r"(?i)\bdoes\s+not\s+apply\b"),
    ("not_subject_to", "exclusion_clause", r"(?i)\bis\s+not\s+subject\s+to\b"),
    ("not_applicable", "exclusion_clause", r"(?i)\bnot\s+applicable\b"),
    ("remain_subject_to", "re_inclusion", r"(?i)\bremain\s+subject\s+to\b"),
)
OBLIGATION_CLASSES = ("modal_obligation", "modal_permissive", "nominal_imperative", "inclusion_clause")

# A date phrase, inside which a permissive modal is no signal.
DATE = r"\b(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\.?\s+\d{1,2},?\s+\d{4}\b"

# Lines of regulation text.
TITLE, CHAPTER, SUBCHAPTER = r"^Title\s+\d+\s*[—-].+$", r"^Chapter\s+[IVX]+\s*[—-].+$", r"^Subchapter\s+[A-Z]\s*[—-].+$"
PART_TOC, PART_HEADER = r"^Part\s+(\d+)\s+(.+)$", r"^PART\s+(\d+)[—-](.+)$"
SUBPART_TOC, SUBPART = r"^Subpart\s+([A-Z])\s+(.+?)\s*$", r"^Subpart\s+([A-Z])[—-](.+?)\s*$"
SECTION = r"^§\s*(\d+\.\d+)\s+(.+?)\s*$"
AUTHORITY, SOURCE_NOTE = r"^Authority:\s*.+$", r"^Source:\s*.+$"
AMENDED, AMENDED_OPEN = r"^\[\s*\d+\s+FR\s+.+\]\s*$", r"^\[\s*\d+\s+FR\s+.+$"
PARA_LETTER, PARA_NUMBER, PARA_ROMAN, PARA_UPPER = r"^\(([a-z])\)\s*(.*)$", r"^\((\d+)\)\s*(.*)$", r"^\(([ivxlcdm]+)\)\s*(.*)$", r"^\(([A-Z])\)\s*(.*)$"

# Lines of guidelines and of general documents.
ROMAN_HEADER = r"^(XX|XIX|XVIII|XVII|XVI|XV|XIV|XIII|XII|XI|X|IX|VIII|VII|VI|V|IV|III|II|I)\.?\s+([A-Z][A-Z0-9].*?)\s*$"
NAMED_HEADER = r"^(GLOSSARY|APPENDICES|APPENDIX\b.*|REFERENCES|ANNEX(?:\s+\d+)?|ABBREVIATIONS|LIST OF ABBREVIATIONS)\s*$"
DECIMAL, TOC_LINE = r"^(\d+(?:\.\d+)+)\s+(\S.*)$", r"\.{3,}\s*\d+\s*$"
GUIDELINE_LINE = r"(?i)^(?:[\W_]{0,3}EMEA\s+\d{4}\b.*|\d*\s*ICH\s+E\d[\w()]*\s+Guideline.*|ICH\s+Harmonised\s+Guideline.*)$"
HEADING = r"^(?:[IVXLC]+\.|[A-Z]\.|\d+(?:\.\d+)*\.?)\s+\S"

# Citations inside text.
CITE_SECTION = r"§§?\s*(\d+)\.(\d+)((?:\([a-z0-9ivxlcdm]+\))*)"
CITE_RANGE = r"§§\s*(\d+)\.(\d+)\s+through\s+\d+\.(\d+)"
CITE_PART = r"\b(?:[Pp]art|PART)\s+(\d+)\b"
CITE_FULL = r"\b21\s+CFR\s+(\d+)\.(\d+)"
