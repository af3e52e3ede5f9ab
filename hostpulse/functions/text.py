"""Cleaning and testing log text. Plain column expressions, so they stay in the JVM."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The key text, what cleaning removes, and the keywords of the log format.
EVENT_MESSAGE_PREFIX = '"eventMessage" : '
EVENT_MESSAGE_KEY = r'"eventMessage"\s*:\s*'
NOISE_CHARACTERS = '",'
LOG_KEYWORDS = ('"timestamp"', '"eventMessage"', '"category"')

# The characters that count as white space at either end of a line.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_prefix(text: Column) -> Column:
    """Removes the exact key text and leaves quotes and commas."""
    return F.replace(text, F.lit(EVENT_MESSAGE_PREFIX), F.lit(""))


def strip_noise(text: Column) -> Column:
    """Removes the key in any spacing, and every double quote and comma.

    The single characters are removed as plain text, which is faster than as further matches of the
    pattern, and after the key, so that no key can appear by their removal.
    """
    cleaned = F.regexp_replace(text, EVENT_MESSAGE_KEY, "")
    for character in NOISE_CHARACTERS:
        cleaned = F.replace(cleaned, F.lit(character), F.lit(""))
    return cleaned


CLEANERS = {"prefix": strip_prefix, "full": strip_noise}


def strip_blanks(text: Column) -> Column:
    """Trims by character set, which is linear; a trimming regex backtracks on long blank runs."""
    return F.btrim(text, F.lit(BLANKS))


def has_keyword(text: Column, keywords: tuple[str, ...] = LOG_KEYWORDS) -> Column:
    return reduce(or_, (text.contains(word) for word in keywords))
