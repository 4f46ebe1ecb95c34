"""Fixed values that results depend on."""

# Entity types, and the tags made of them.
ENTITY_TYPES = ["CONDITION", "DRUG", "DOSAGE", "STUDY_PHASE", "ENDPOINT", "PATIENT_CRITERIA", "BIOMARKER", "ENDPOINT_TYPE"]
BIO_TAGS = ["O", *(f"{p}-{t}" for t in ENTITY_TYPES for p in "BI")]

# Classification thresholds, and the quality gate of the published table.
MIN_CONFIDENCE = 0.72
MIN_MARGIN = 0.02
SECONDARY_SCORE = 0.68
SECONDARY_GAP = 0.04
TOP_K = 5
MIN_TEXT_LENGTH = 10

# Layout labels and the section types they stand for; any other label is a paragraph.
LABEL_TYPES = {
    "title": "title",
    "document_index": "toc",
    "section_header": "heading",
    "paragraph": "paragraph",
    "text": "paragraph",
    "list_item": "list_item",
    "caption": "caption",
    "figure_caption": "figure_caption",
    "table_caption": "table_caption",
    "code": "code",
    "formula": "equation",
    "footnote": "footnote",
    "page_header": "header",
    "page_footer": "footer",
    "reference": "reference",
    "checkbox_selected": "checkbox",
    "checkbox_unselected": "checkbox",
    "picture": "figure",
    "table": "table",
}

# Classes and domains that set the priority of a section, and what is expected in a class.
HIGH_CLASSES = ["INCLUSION_CRITERIA", "EXCLUSION_CRITERIA", "PRIMARY_ENDPOINT", "SECONDARY_ENDPOINT"]
MEDIUM_DOMAINS = ["DEMOGRAPHICS", "CLINICAL_LABS", "REPRODUCTIVE"]
EXPECTED_TYPES = {
    "LAB": ["BIOMARKER", "PATIENT_CRITERIA"],
    "DEMOGRAPHIC": ["PATIENT_CRITERIA"],
    "DRUG": ["DRUG", "DOSAGE"],
    "DISEASE": ["CONDITION"],
    "ENDPOINT": ["ENDPOINT", "ENDPOINT_TYPE"],
    "PHASE": ["STUDY_PHASE"],
}
DEFAULT_EXPECTED = ["CONDITION", "DRUG", "BIOMARKER"]

# Words of merging and chunking.
MERGE_WORDS = 200
CHUNK_OVER_WORDS = 200
CHUNK_WORDS = 150
HEADING_WORDS = 15

# Characters of a page made of sections, of a formula's context and of an error; the height that a header takes.
PAGE_CHARS = 5000
CONTEXT_CHARS = 200
ERROR_CHARS = 1000
HEADER_TOP = 100

# Section rules in order (type, pattern, whether it looks at lower case), and the marks of a table of contents.
SECTION_RULES = [
    ("toc_entry", r"^[\d.]+\s+.+[.\s]+\d+\s*$", False),
    ("heading", r"^(chapter|section|article|part)\s+[\divxlc]+", True),
    ("heading", r"^[\d.]+\s+[A-Z]", False),
    ("appendix", r"^appendix\s+[a-z\d]", True),
    ("list_item", r"^[-•*]\s", False),
    ("figure_caption", r"^(figure|fig\.?)\s+\d+", True),
    ("table_caption", r"^(table|tbl\.?)\s+\d+", True),
    ("equation", r"[∫∑∏√∂∇≠≤≥±×÷]", False),
]
CONTENTS_WORDS = ("table of contents", "contents", "index")
LEADERS = r"\.{3,}\s*\d+"
LINE_NUMBER = r"[.\s]+\d{1,4}\s*$"
