"""Fixed values. Results only match if these stay exactly as they are."""

# --- fixed values: regions that count as valid -------------------------------
REGIONS = (
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado",
    "Connecticut", "Delaware", "District of Columbia", "Florida", "Georgia",
    "Hawaii", "Idaho", "Illinois", "Indiana", "Iowa", "Kansas", "Kentucky",
    "Louisiana", "Maine", "Maryland", "Massachusetts", "Michigan", "Minnesota",
    "Mississippi", "Missouri", "Montana", "Nebraska", "Nevada",
    "New Hampshire", "New Jersey", "New Mexico", "New York", "North Carolina",
    "North Dakota", "Ohio", "Oklahoma", "Oregon", "Pennsylvania",
    "Rhode Island", "South Carolina", "South Dakota", "Tennessee", "Texas",
    "Utah", "Vermont", "Virginia", "Washington", "West Virginia", "Wisconsin",
    "Wyoming",
)

# --- fixed values: regions left out of the map -------------------------------
UNMAPPED_REGIONS = ("District of Columbia", "Puerto Rico")

# --- fixed values: text marks ------------------------------------------------
SARCASM_MARK = "/s"
QUOTE_MARK = "&gt"
THREAD_PREFIX = "t3_"
PUNCTUATION_TOKENS = ("'", "-", "!", ".", "?", ":", ";", ",")

# --- fixed values: model and report parameters -------------------------------
MIN_DOCUMENT_FREQUENCY = 10
VOCABULARY_SIZE = 1 << 18
MAX_ITERATIONS = 10
REG_PARAMS = (1.0,)
FOLDS = 5
TRAIN_WEIGHTS = (0.5, 0.5)
SAMPLE_FRACTION = 0.2
POSITIVE_THRESHOLD = 0.2
NEGATIVE_THRESHOLD = 0.25
TOP_THREADS = 10
BAD_DAY = "2018-12-31"
DAY_FORMAT = "yyyy-MM-dd"
