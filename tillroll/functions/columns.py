"""Scalar column functions (inventory X1-X33), all built-in Spark expressions.

Each function takes and returns ``Column`` objects, so everything stays inside
whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for identical results.
# ---------------------------------------------------------------------------

# Text that the reference's CSV reader turns into a missing value (the pandas
# ``read_csv`` default null tokens).
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Country names (lower case, stripped) per reporting region.
UK_COUNTRIES = ["united kingdom", "uk", "great britain"]
EUROPE_COUNTRIES = [
    "austria", "belgium", "cyprus", "denmark", "eire", "finland", "france",
    "germany", "greece", "iceland", "italy", "malta", "netherlands", "norway",
    "poland", "portugal", "spain", "sweden", "switzerland",
]
REGION_UK = "United Kingdom"
REGION_EUROPE = "Europe"
REGION_OTHER = "Other"
REGIONS = [REGION_UK, REGION_EUROPE, REGION_OTHER]

# Product categories from description keywords; the first matching row wins.
CATEGORY_RULES = [
    ("Lighting & Decor", ["%light%", "%lamp%", "%candle%"]),
    ("Storage & Bags", ["%bag%", "%box%", "%basket%", "%storage%"]),
    ("Kitchen & Dining", ["%kitchen%", "%cup%", "%plate%", "%mug%", "%cake%"]),
    ("Stationery & Gifts", ["%card%", "%paper%", "%notebook%", "%pen%", "%stationery%"]),
    ("Seasonal & Giftware", ["%heart%", "%flower%", "%bird%", "%christmas%", "%easter%"]),
]
CATEGORY_OTHER = "Other"

# Key prefixes and fill values of the star schema.
PRODUCT_PREFIX = "prod"
CUSTOMER_PREFIX = "cust"
REGION_PREFIX = "region"
TRANSACTION_PREFIX = "txn"
KEY_PREFIXES = {"transaction_id": TRANSACTION_PREFIX, "product_key": PRODUCT_PREFIX, "customer_key": CUSTOMER_PREFIX}
UNKNOWN_CUSTOMER = "UNKNOWN"
UNKNOWN_PRODUCT = "Unknown product"
UNKNOWN_COUNTRY = "Unknown"
CURRENCY = "GBP"

# Severity bands: normal < threshold <= medium < HIGH_SEVERITY <= high.
HIGH_SEVERITY = 4.0

# ---------------------------------------------------------------------------
# Our own parsing rules (fixes of the reference's quirks, see README).
# ---------------------------------------------------------------------------

# A plain decimal number with optional exponent and surrounding blanks. Java
# forms such as ``1d`` or ``0x10`` that Spark's cast would accept are refused.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Timestamp forms tried in order: day first, then ISO. Bracketed parts are
# optional, so these cover d/M/yyyy with or without H:mm or H:mm:ss, and the
# same for ISO dates with a blank or a T before the time.
TIMESTAMP_FORMATS = [
    "d/M/yyyy[ H:mm[:ss]]",
    "yyyy-M-d[ H:mm[:ss]]",
    "yyyy-M-d'T'H:mm[:ss]",
]

# Forms tried on normalized text only.
RARE_TIMESTAMP_FORMATS = [
    "d/M/yyyy H:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]",
    "yyyy-M-d H:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]",
    "yyyy-M-d'T'H:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]",
    "d/M/yyyy h:mm[:ss] a",
    "yyyy-M-d h:mm[:ss] a",
    "d MMM yyyy[ H:mm[:ss]]",
]

# Bounds of the fact table's types: INT quantities, DECIMAL(14, 2) money.
MAX_QUANTITY = 2**31 - 1
MAX_MONEY = 1e12 - 0.01

# White space as Python's ``str.strip`` sees it (every character for which
# ``str.isspace`` holds), not only the ASCII blank Spark's ``trim`` removes.
# Derived from that rule rather than listed.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

_INF = float("inf")


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Strip white space at both ends (a character-set trim, no regex).
    Text between two printable ASCII characters is left as it is without a
    look at the set."""
    c = col_(c)
    ends = [F.ascii(F.substring(c, 1, 1)).between(33, 126), F.ascii(F.substring(c, -1, 1)).between(33, 126)]
    return F.when(ends[0] & ends[1], c).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def null_tokens(c: Column | str) -> Column:
    """The CSV reader's null tokens become null."""
    c = col_(c)
    return F.when(~c.isin(NA_TOKENS), c)


def lenient_double(c: Column | str) -> Column:
    """Number parse that yields null on anything but a plain number."""
    c = col_(c).cast("string")
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))


def finite(d: Column | str) -> Column:
    """Q5: a double that is finite, else null."""
    d = col_(d)
    return F.when(F.abs(d) < F.lit(_INF), d)


def exact_long(c: Column | str) -> Column:
    """Text of digits alone as BIGINT, exact beyond 2^53; else null."""
    c = col_(c).cast("string")
    return F.when(c.rlike(r"^\s*[+-]?\d{1,19}\s*$"), F.btrim(c, F.lit(WHITESPACE)).try_cast("bigint"))


def whole_number(d: Column | str) -> Column:
    """X7 + Q4: a finite whole double within BIGINT, else null."""
    d = col_(d)
    return F.when((F.abs(d) < F.lit(_INF)) & (d == F.floor(d)), d.try_cast("bigint"))


def _one_date_form(s: Column) -> Column:
    """Other ways to write a timestamp, brought to the forms of
    ``TIMESTAMP_FORMATS`` and ``RARE_TIMESTAMP_FORMATS``: the zone behind a
    time goes (the wall clock stays), day-first dates get slashes and full
    years, year-first ones dashes, and AM/PM stands alone in capitals."""
    s = F.regexp_replace(s, r"(?i)^(.*\d:\d\d(?::\d\d(?:\.\d+)?)?(?:\s*[ap]m)?)\s*(?:z|utc|gmt|[+-]\d\d:?\d\d)$", "$1")
    s = F.regexp_replace(s, r"^(\d{1,2})[-./](\d{1,2})[-./](\d{4}|\d{2})(?!\d)", "$1/$2/$3")
    s = F.regexp_replace(s, r"^(\d{4})[./](\d{1,2})[./](\d{1,2})(?!\d)", "$1-$2-$3")
    # Fixed rule of two-digit years: 69 to 99 are of the last century.
    s = F.regexp_replace(s, r"^(\d{1,2}/\d{1,2}/)([0-5]\d|6[0-8])(?!\d)", "$120$2")
    s = F.regexp_replace(s, r"^(\d{1,2}/\d{1,2}/)(69|[7-9]\d)(?!\d)", "$119$2")
    s = F.regexp_replace(s, r"(\d\.\d{6})\d+$", "$1")
    s = F.regexp_replace(s, r"(?i)\s*\ba\.?m\.?$|(?<=\d)a\.?m\.?$", " AM")
    s = F.regexp_replace(s, r"(?i)\s*\bp\.?m\.?$|(?<=\d)p\.?m\.?$", " PM")
    named = F.regexp_replace(s, r"^(\d{1,2})[-\s]([A-Za-z]{3})[A-Za-z]*[-,\s]+(\d{4})", "$1 $2 $3")
    month = F.regexp_extract(named, r"^\d{1,2} ([A-Za-z]{3}) ", 1)
    return F.when(month == "", s).otherwise(F.replace(named, month, F.initcap(month)))


def parse_timestamp(s: Column | str) -> Column:
    """X8/X9 on stripped text: day-first forms, then ISO, first that parses;
    then the same with other separators, short years, fractions of seconds,
    zones (dropped), AM/PM and English month names."""
    s = col_(s)

    def first_of(text: Column, formats: list[str]) -> Column:
        return F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats])

    # The array binds the normalized text, so it is worked out once, and only
    # for text that the plain forms do not parse.
    other = F.transform(F.array(_one_date_form(s)), lambda t: first_of(t, TIMESTAMP_FORMATS + RARE_TIMESTAMP_FORMATS))
    return F.coalesce(first_of(s, TIMESTAMP_FORMATS), F.get(other, F.lit(0))).cast("timestamp_ntz")


def finite_double(c: Column | str) -> Column:
    """X5 + Q5 in one expression (for single use; stage it when reused)."""
    return finite(lenient_double(c))


def lenient_long(c: Column | str) -> Column:
    """X5 + X7 in one expression (for single use; stage it when reused)."""
    return F.coalesce(exact_long(c), whole_number(lenient_double(c)))


def lenient_timestamp(c: Column | str) -> Column:
    """X8/X9 in one expression (for single use; stage it when reused)."""
    return parse_timestamp(strip_ws(col_(c).cast("string")))


def numeric_or_zero(c: Column | str) -> Column:
    """A number, with text that is not a number, NaN and null as 0.0."""
    d = col_(c).try_cast("double")
    return F.coalesce(F.when(~F.isnan(d), d), F.lit(0.0))


def stable_key(prefix: str, c: Column | str) -> Column:
    """``prefix_`` + first 16 hex digits of SHA-1 of the text."""
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha1(col_(c).cast("string")), 1, 16))


def packed_key(c: Column | str, prefix: str) -> tuple[Column, Column]:
    """A key as ``(code, text)``: the eight bytes behind a ``stable_key`` and
    empty text, or no bytes and the text itself (null for null). Keys are equal
    if both parts are; a shuffle moves 8 bytes instead of some 20 characters."""
    c = col_(c)
    code = F.unhex(F.substring(c, len(prefix) + 2, 16))
    same = c == F.concat(F.lit(f"{prefix}_"), F.lower(F.hex(code)))
    exact = F.coalesce(same & (F.octet_length(code) == 8), F.lit(False))
    return F.when(exact, code).otherwise(F.lit(b"")), F.when(exact, F.lit("")).otherwise(c)


def unpacked_key(code: Column | str, text: Column | str, prefix: str) -> Column:
    """The key of ``packed_key``'s parts."""
    code, text = col_(code), col_(text)
    return F.when(F.octet_length(code) == 0, text).otherwise(F.concat(F.lit(f"{prefix}_"), F.lower(F.hex(code))))


def date_key(c: Column | str) -> Column:
    """X11: yyyymmdd as INT."""
    c = col_(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def country_to_region(c: Column | str) -> Column:
    """Country -> United Kingdom / Europe / Other."""
    normalized = F.lower(strip_ws(col_(c)))
    return (
        F.when(normalized.isin(UK_COUNTRIES), F.lit(REGION_UK))
        .when(normalized.isin(EUROPE_COUNTRIES), F.lit(REGION_EUROPE))
        .otherwise(F.lit(REGION_OTHER))
    )


def round2_half_even_binary(c: Column | str) -> Column:
    """``rint(x * 100) / 100``, the array rounding of the reference."""
    return F.rint(col_(c) * F.lit(100)) / F.lit(100)


def product_category(c: Column | str) -> Column:
    """Keyword category of a description, first matching rule wins."""
    lowered = F.lower(col_(c))
    expr = None
    for name, patterns in CATEGORY_RULES:
        cond = reduce(lambda a, b: a | b, [lowered.like(p) for p in patterns])
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(CATEGORY_OTHER))


def severity_band(score: Column | str, z_threshold: float) -> Column:
    """Left-closed bins normal < t <= medium < 4.0 <= high."""
    s = col_(score)
    return (
        F.when(s < F.lit(z_threshold), F.lit("normal"))
        .when(s < F.lit(HIGH_SEVERITY), F.lit("medium"))
        .otherwise(F.lit("high"))
    )


def half_up_ratio(total: Column, count: Column, scale: int = 2) -> Column:
    """Exact ``round(total / count, scale)`` for a DECIMAL total (HALF_UP).

    Decimal division keeps 6+ digits, so the final rounding sees no binary
    error (``avg`` on doubles would round 6.175 down on some engines).
    """
    return F.round(total / count.cast("decimal(20,0)"), scale)
