"""String operators (X4-X10) as built-in regex / string expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CLICKED_GENERIC, CLICKED_INVITATION, SEARCH_STOP_WORDS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squish(x) -> Column:
    """Trim both ends and collapse inner whitespace runs to one space."""
    return F.regexp_replace(F.regexp_replace(_c(x), r"\s+", " "), r"^ | $", "")


def normalize_search(x, stop_words: Sequence[str] = SEARCH_STOP_WORDS) -> Column:
    """Employer-search normaliser (X8): lower case, squish, keep only
    ``[a-z0-9 ]``, drop whole stop words, squish again.  Punctuation inside a
    word joins it ("Wal-Mart" -> "walmart"); a query of stop words only gives ''."""
    s = squish(F.lower(_c(x)))
    s = F.regexp_replace(s, r"[^a-z0-9 ]", "")
    s = F.regexp_replace(s, r"\b(" + "|".join(stop_words) + r")\b", "")
    return squish(s)


def camel_to_words(x) -> Column:
    """Space before every capital except the first (look-behind), X6."""
    return F.regexp_replace(_c(x), r"(?<!^)([A-Z])", " $1")


def initiation_label(event) -> Column:
    """How a flow was entered (X5-X7): "Invitation" for the tokenised link,
    "Clicked Generic Link" for the generic one, NULL for any other event."""
    e = _c(event)
    picked = F.regexp_substr(e, F.lit("CBVInvitation|ClickedGenericLink"))
    label = F.regexp_replace(camel_to_words(picked), r"^C B V ", "")
    return F.when(e.isin(CLICKED_INVITATION, CLICKED_GENERIC), label)


def count_label(text, n) -> Column:
    """``"{TEXT} ({n})"`` with the text upper-cased."""
    return F.concat(F.upper(_c(text)), F.lit(" ("), _c(n).cast("string"), F.lit(")"))
