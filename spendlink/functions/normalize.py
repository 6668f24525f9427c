"""Token-sorted text forms that the two scorers compare.

Built from ``translate``, ``split``, ``array_remove`` and ``sort_array`` rather than lambdas, so that whole-stage code
generation covers them. Strings sort by code point.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII punctuation, blanked by the fast form.
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Fixed values of the token-sort scorer: code points dropped first, and what counts as a word character.
DROPPED = "[\\u0080-\\u00ff]"
NON_WORD = "[^\\p{L}\\p{N}_]"


def _sorted_words(blank_separated: Column) -> Column:
    words = F.array_remove(F.split(blank_separated, " "), "")
    return F.array_join(F.sort_array(words), " ")


def fast_form(text: Column) -> Column:
    """Lower, punctuation to blanks, words sorted. Only the plain blank separates words."""
    blanks = " " * len(ASCII_PUNCTUATION)
    return _sorted_words(F.translate(F.lower(text), ASCII_PUNCTUATION, blanks))


def fuzzy_form(text: Column) -> Column:
    """Token-sort form: drop U+0080-U+00FF, non-word characters to blanks, lower, words sorted.

    ``_`` counts as a word character here, unlike in :func:`fast_form`. Letters and digits beyond U+00FF stay.
    """
    kept = F.regexp_replace(text, DROPPED, "")
    return _sorted_words(F.lower(F.regexp_replace(kept, NON_WORD, " ")))
