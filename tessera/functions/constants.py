"""Fixed values.

Everything in this module must equal the values the original sheet transform
and classification specification use, so results agree. They are stated here
plainly and in their natural order; operators take them as overridable
defaults, so a user's own rule tables can replace any of them.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: sheet layout
# ---------------------------------------------------------------------------
YEAR_MIN = 16
YEAR_MAX = 32
YEAR_COLS = [f"CY{y}" for y in range(YEAR_MIN, YEAR_MAX + 1)]
DIM_COLS = ["gig", "amazon_code", "segment_code", "size_code",
            "ec_code", "resi_code", "Zone_cd", "Product"]
LABEL_COL = "ADV_millions"
# Header cells are matched as a prefix: "CY" followed by two digits.
HEADER_YEAR_PATTERN = r"^CY(\d{2})"

# Cell text that means "no value" (after stripping white space).
NULL_CELL_TOKENS = ["", "−", "-", "#DIV/0!", "nan", "None"]
# Characters removed before a cell is parsed as a number (a percent is not divided).
NUMBER_STRIP_CHARACTERS = "%,"
# Dimension text that means "no code".
NULL_DIM_TOKENS = ["null", "None", ""]

# ---------------------------------------------------------------------------
# FIXED VALUES: default row rules of the original sheet
# ---------------------------------------------------------------------------
EXCLUDE_LABELS = [
    "Total Market - Excluding B2C DSP", "EC % of Total", "AMZN Control of Total EC",
    "B2C Total Mix %", "B2B Total Mix %", "Ratio of Total AMZN EC Returns (Shipped)",
    "Ratio of Total Non-AMZN E-C Returns (Shipped)", "AMZN Local % Total AMZN Controlled",
    "AMZN Platform EC share of US EC market", "FBA Local + National",
    "Non-Amazon Controlled - National as % of EC",
    "Gig + Non-Amazon Controlled EC (Local + National)",
    "Gig +Non-Amazon Controlled US Dom Volume (EC + Non-EC)",
    "Gig + Total E-C  (Local + National)", "Non-AMZN B2C Mix", "Non-AMZN B2C",
    "ADV (millions)", "SAM Ratio", "Large Ratio",
    "B2B Express SAM YOY Growth", "B2B Express Large YOY Growth",
    "B2C (EC + Non-EC) Express SAM YOY Growth", "B2C (EC + Non-EC) Express Large YOY Growth",
    "B2B Ground SAM YOY Growth", "B2B Ground Large YOY Growth",
    "B2C (EC + Non-EC) Ground SAM YOY Growth", "B2C (EC + Non-EC) Ground Large YOY Growth",
    "Addressable Mix",
]
# The first row with this label switches to the second half's rule set.
HALF_MARKER = "ADV (millions)"
# (labels skipped, previous kept label that triggers the skip)
SKIP_RULES = [
    (["B2C Express"], "Deferred Ground"),
    (["SAM", "Large"], "Addressable Mix"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: dimension derivation for generic child rows
# ---------------------------------------------------------------------------
GENERIC_GIG = "non-gig"
PRODUCT_MAP = {
    "Express": "Total-Express", "Express Overnight": "Express-Overnight",
    "Express Deferred": "Express-Deferred", "Ground": "Total-Ground",
    "Core Ground": "Ground-Core", "Deferred Ground": "Ground-Deferred",
    "SFP Express": "Total-Express", "SFP Ground": "Total-Ground",
    "Non-SFP Express": "Total-Express", "Non-SFP Ground": "Total-Ground",
    "Traditional B2B Express": "Total-Express", "Traditional B2B Ground": "Total-Ground",
    "B2B Express": "Total-Express", "B2B Ground": "Total-Ground",
    "B2C Express": "Total-Express", "B2C Ground": "Total-Ground",
    "B2B Express SAM": "Total-Express", "B2B Ground SAM": "Total-Ground",
    "B2B Express Large": "Total-Express", "B2B Ground Large": "Total-Ground",
}
# Upper-cased substring -> product, first hit wins, in this order.
PRODUCT_SUBSTRINGS = [
    ("EXPRESS OVERNIGHT", "Express-Overnight"),
    ("EXPRESS DEFERRED", "Express-Deferred"),
    ("CORE GROUND", "Ground-Core"),
    ("DEFERRED GROUND", "Ground-Deferred"),
    ("EXPRESS", "Total-Express"),
    ("GROUND", "Total-Ground"),
]
# Applied only when the inherited code is empty; first hit wins.
SIZE_SUBSTRINGS = [("SAM", "SAM"), ("LARGE", "Large")]
SEGMENT_SUBSTRINGS = [("B2B", "B2B"), ("B2C", "B2C")]
# Residential code from the (exact) segment code.
RESI_BY_SEGMENT = {"B2B": "Non-Resi", "B2C": "Resi"}

# ---------------------------------------------------------------------------
# FIXED VALUES: classification specification
# ---------------------------------------------------------------------------
INDUSTRIES = [
    "Industrial", "Healthcare", "Aerospace", "Services",
    "Consumer Goods - Non Perishables", "Consumer Goods - Perishables",
    "Technology", "Automotive", "Energy Chemical Utilities & Mining",
    "Transportation & Logistics", "Other Services",
]
TRAIN_FRACTION = 0.80
ML_ACCEPT_CONFIDENCE = 0.70
ML_ACCEPT_GAP = 0.15
FALLBACK_ACCEPT_CONFIDENCE = 0.75
RETRAIN_MIN_NEW_LABELS = 500
RETRAIN_DAY_OF_MONTH = 1
PROMOTION_MIN_F1_GAIN = 0.01
SOURCE_ML = "ml_accepted"
SOURCE_FALLBACK = "llm"
SOURCE_HUMAN = "human"


# ---------------------------------------------------------------------------
# Build choices (not from the original): stop words per language of the test
# documents and abbreviations expanded by the description cleaner.
# ---------------------------------------------------------------------------
STOP_WORDS = [
    # en
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in",
    "is", "it", "its", "of", "on", "or", "that", "the", "this", "to", "was", "were",
    "will", "with",
    # fr
    "au", "aux", "avec", "ce", "dans", "de", "des", "du", "elle", "en", "est", "et",
    "il", "la", "le", "les", "leur", "par", "pour", "qui", "que", "sur", "un", "une",
    # de
    "der", "die", "das", "und", "ist", "mit", "von", "zu", "den", "dem", "ein", "eine",
    "nicht", "auf", "für", "im",
    # es
    "el", "los", "las", "y", "del", "con", "por", "para", "una", "es", "se", "lo",
]
ABBREVIATIONS = {
    "qty": "quantity", "pcs": "pieces", "pc": "piece", "assy": "assembly",
    "equip": "equipment", "mfg": "manufacturing", "elec": "electrical",
    "pkg": "package", "med": "medical", "auto": "automotive",
}
