"""They must be equal for results to be equal."""

# --- fixed values: US states by postal code, alphabetical, then the district ---
STATE_NAMES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California",
    "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware", "FL": "Florida", "GA": "Georgia",
    "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa",
    "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi",
    "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire",
    "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York", "NC": "North Carolina",
    "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania",
    "RI": "Rhode Island", "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee",
    "TX": "Texas", "UT": "Utah", "VT": "Vermont", "VA": "Virginia", "WA": "Washington",
    "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
    "DC": "District of Columbia",
}

# Interest is collected for the states only; the district is known to the load step alone.
REGION_CODES = [code for code in STATE_NAMES if code != "DC"]
NATIONAL_GEO = "US"

# --- fixed values: catalogue markets of the genre search ---
MARKETS = ["US", "GB", "DE", "FR", "KR", "JP", "MX", "CO", "CA"]

# --- fixed values: thresholds ---
SCORE_MIN, SCORE_MAX = 0.0, 100.0
NATIONAL_GATE_MIN_PEAK = 50.0
HISTOGRAM_BINS = 20

# --- fixed values: text conventions ---
UNKNOWN_GENRE = "Unknown"
NULL_LIKE_TEXT = ["<na>", "na", "null", ""]
LIST_JOINER = "; "
ALT_DELIMITERS, DELIMITER = "|,", ";"
LINE_SPACE = " \t\n\x0b\f\r"
# Characters that may wrap a genre token: white space, quotes, brackets.
TOKEN_WRAPPERS = LINE_SPACE + "\"'[]()"
# White space as Python's str.strip and str.split see it, and the same inside of a regex class.
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE = (
    r"\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# Letters, digits and underscore as Python's \w sees them (inside of a regex class).
WORD = r"\p{L}\p{N}_"
TREND_KEY_PREFIX = "daily_trends_"
TREND_KEY_PATTERN = r"^daily_trends_([A-Za-z]+)[._](\d{4}-\d{2}-\d{2})(?:[ T]\d{2}:\d{2}:\d{2})?$"

# --- fixed values: file and folder names of a batch ---
RAW_STEM = "spotify_rising_with_trends"
RISING_STEM = "spotify_rising_artists"
CLEANED_STEM = "spotify_rising_cleaned"
BATCH_DATE_PATTERN = r"\d{4}_\d{2}_\d{2}"
