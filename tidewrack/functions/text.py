"""Scalar text functions as Spark column expressions.

Everything here returns a ``Column`` built from JVM-side functions, so it stays inside
whole-stage codegen. Regular expressions are written so that Java's engine (Spark) and
RE2 (the DuckDB oracle) read them the same way as Python's ``re`` does on str input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------
# The whitespace set of Python's str.isspace() / re's \s on str input, spelled as one
# character class. Java's \s is ASCII-only and RE2 lacks \v, so neither may be used.
WS = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Media placeholders a feed item may consist of.
MEDIA_PLACEHOLDERS = ("[Image]", "[Video]", "[QuickTime Video]")
# Punctuation folding: ellipsis character, single quotes, double quotes, long dashes.
ELLIPSIS_CHAR = "…"
SINGLE_QUOTES = "‘’"
DOUBLE_QUOTES = "“”"
LONG_DASHES = "‒—–―"  # figure dash, em dash, en dash, horizontal bar
EN_DASH = "–"
# Token pattern for lower-cased word tokens (letters/digits runs, or one other symbol).
TOKEN_PATTERN = rf"[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}{WS}]"
# Own URL pattern (the original validator is an external package; see README).
URL_PATTERN = rf"^https?://([A-Za-z0-9-]+\.)+[A-Za-z0-9-]{{2,}}(:[0-9]+)?([/?#][^\"<>\\^`{{|}}{WS}]*)?$"
# ------------------------------------------------------------------------------------

WS_RUN = f"[{WS}]+"
STRIP = f"^[{WS}]+|[{WS}]+\\z"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col) -> Column:
    """Python ``str.strip()``: remove the Unicode whitespace set at both ends."""
    return F.regexp_replace(_c(col), STRIP, "")


def is_blank(col) -> Column:
    """True for null, empty or whitespace-only text."""
    c = _c(col)
    return c.isNull() | (F.length(strip(c)) == 0)


def collapse_whitespace(col) -> Column:
    """Every whitespace run becomes one space, then strip."""
    return strip(F.regexp_replace(_c(col), WS_RUN, " "))


def normalise_punctuation(col) -> Column:
    """Fold ellipsis, quotes and dashes; literal backslash-n to space; collapse
    whitespace; drop leading whitespace and dashes. The end is not re-stripped."""
    c = F.replace(_c(col), F.lit(ELLIPSIS_CHAR), F.lit("..."))
    c = F.translate(c, SINGLE_QUOTES + DOUBLE_QUOTES + LONG_DASHES, "''\"\"" + EN_DASH * len(LONG_DASHES))
    c = F.replace(c, F.lit("\\n"), F.lit(" "))
    c = F.regexp_replace(c, WS_RUN, " ")
    return F.regexp_replace(c, f"^[{WS}\\-{EN_DASH}]+", "")


def clean_feed_text(col) -> Column:
    """P1 then P2, the order the feed cleaner applies them."""
    return normalise_punctuation(collapse_whitespace(col))


def drop_final_dot(col) -> Column:
    c = _c(col)
    return F.when(c.endswith("."), c.substr(F.lit(1), F.length(c) - 1)).otherwise(c)


def is_media(col) -> Column:
    """A picture link or a media placeholder, after dropping one final dot."""
    t = drop_final_dot(col)
    return t.rlike(r"^pic\.twitter\.com/[a-zA-Z0-9]+\z") | t.isin(*MEDIA_PLACEHOLDERS)


def is_only_handle_repost(col) -> Column:
    """P5: a bare repost, ``RT @handle`` with an optional final dot."""
    return _c(col).rlike(f"^RT[{WS}]+@([a-zA-Z0-9_]+)\\.?\\z")


def is_url(col) -> Column:
    """Starts with http(s)://; after dropping one final dot and deleting every
    whitespace character, the rest is a valid URL."""
    c = _c(col)
    squeezed = F.regexp_replace(drop_final_dot(c), WS_RUN, "")
    return (c.startswith("http://") | c.startswith("https://")) & squeezed.rlike(URL_PATTERN)


def keep_feed_text(col) -> Column:
    """Rows the feed keeps: not media, not a bare repost, not a bare URL."""
    return ~is_media(col) & ~is_only_handle_repost(col) & ~is_url(col)


def to_utc_iso(col) -> Column:
    """Offset timestamp string -> ``YYYY-MM-DDTHH:MM:SS[.ffffff]Z`` in UTC.

    The instant is counted from the epoch in zoneless time, so neither the session's zone
    nor its daylight saving plays a part; a string without an offset is read in the zone of
    the session. Fractions are kept (six digits) where there are any."""
    micros = F.unix_micros(F.to_timestamp(_c(col)))
    part = F.pmod(micros, F.lit(1_000_000))
    seconds = ((micros - part) / 1_000_000).cast("decimal(18,6)")
    zero = F.lit(0)
    clock = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(zero, zero, zero, seconds)
    fraction = F.when(part == 0, "").otherwise(F.format_string(".%06d", part))
    return F.concat(F.replace(clock.cast("string"), F.lit(" "), F.lit("T")), fraction, F.lit("Z"))


def content_id(date_col, text_col) -> Column:
    """sha256 hex of date followed by text (UTF-8)."""
    return F.sha2(F.concat(_c(date_col), _c(text_col)), 256)


def clean_post_text(col) -> Column:
    """Remove URLs (keeping a ``...`` that follows one), fix spacing around
    punctuation, rejoin split numbers and ``a. m``-style times, strip."""
    c = _c(col)
    # URL steps only for texts holding "://" (exact pre-test, no regex).
    has_url = c.contains("://")
    c = F.when(has_url, F.regexp_replace(c, f"([{WS}]*:[{WS}]*)?https?://[^{WS}]+(\\.\\.\\.)", "$1$2")).otherwise(c)
    c = F.when(has_url, F.regexp_replace(c, f"([{WS}]*:[{WS}]*)?https?://[^{WS}]+", "")).otherwise(c)
    c = F.replace(c, F.lit("\n"), F.lit(" "))
    c = F.regexp_replace(c, f"[{WS}]*(\\.\\.\\.|,|;|\\.|!|\\?)[{WS},;.!?]*", "$1 ")
    c = F.regexp_replace(c, WS_RUN, " ")
    c = F.regexp_replace(c, f"(\\p{{Nd}}+[,.])[{WS}](\\p{{Nd}}+)", "$1$2")
    c = F.when(c.contains(". m") | c.contains(". M"), F.regexp_replace(c, "([aApP])\\. ([mM])", "$1.$2")).otherwise(c)
    return strip(c)


def trim_backticks(col) -> Column:
    """P10: drop one leading and then one trailing backtick."""
    c = _c(col)
    c = F.when(c.startswith("`"), c.substr(F.lit(2), F.length(c))).otherwise(c)
    return F.when(c.endswith("`"), c.substr(F.lit(1), F.length(c) - 1)).otherwise(c)


def word_tokens(col) -> Column:
    """Lower-cased word tokens (letter/digit runs and single symbols)."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(TOKEN_PATTERN), 0)
