"""Values the results depend on.  Everything in this module is a fixed value.

They are facts of the data model (which characters make up a word, which places
are valid, which thresholds turn a probability into a flag), so they are kept in
one place, in plain text and in their natural order.
"""

# --- fixed values: text -----------------------------------------------------
# Members of the "word character" class; everything else is punctuation.
WORD_CHARS = "a-zA-Z0-9_#$%'"
# Punctuation that ends a phrase; each such character is a token of its own.
PHRASE_END_CHARS = ".!?,;:"
# White space as Unicode defines it (the JVM's \s covers ASCII only).
SPACE_CHARS = (
    r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)
# What a link to a page starts with (case-sensitive).
URL_STARTS = r"https://|http://|www\."

# --- fixed values: comment filter -------------------------------------------
QUOTE_PREFIX = "&gt"
SARCASM_MARK = "/s"

# --- fixed values: features, models, flags ----------------------------------
LINK_PREFIX_LENGTH = 3
MIN_DOCUMENT_FREQUENCY = 5
VOCABULARY_SIZE = 1 << 18
MAX_ITERATIONS = 10
REGULARISATION_GRID = (1.0,)
FOLDS = 5
TRAIN_FRACTION = 0.5
SAMPLE_FRACTION = 0.2
POSITIVE_THRESHOLD = 0.2
NEGATIVE_THRESHOLD = 0.25

# --- fixed values: reports --------------------------------------------------
BAD_DATE = "2018-12-31"
SCALE_DIGITS = 3
OFF_MAP = ("District of Columbia", "Puerto Rico")
STATES = (
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
