"""Column expressions over text."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# All but ASCII letters and the blank. Listed letter by letter the class compiles to one bit table;
# as ranges it is a chain of interface calls, on which executor threads contend for a cache line:
# tokenizing takes 2.5 times as long on eight threads.
NOT_LETTER_OR_BLANK = f"[^{string.ascii_letters} ]"

LINE_END = r"\r\n|\r|\n"

# Any character above the blank: a line without one is empty after trimming blanks, tabs and
# control characters.
VISIBLE = r"[^\x00-\x20]"


def lines_of(text: Column | str) -> Column:
    """A text as an array of lines, cut where the text reader would cut it.

    Splitting at one plain character is four times as fast as at a pattern, so the pattern is left
    to texts that need it.
    """
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.contains("\r"), F.split(text, LINE_END)).otherwise(F.split(text, "\n"))


def words_of(value: Column | str) -> Column:
    """Lower-case words of a line as an array; runs of blanks leave empty strings in it.

    Characters other than letters are removed, not split at: "Don't stop--now" has the words
    dont and stopnow.
    """
    return F.split(F.lower(F.regexp_replace(value, NOT_LETTER_OR_BLANK, "")), " ")


def has_text(value: Column | str) -> Column:
    """True where something is left after trimming."""
    value = F.col(value) if isinstance(value, str) else value
    return value.rlike(VISIBLE)
