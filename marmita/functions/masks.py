"""Masking expressions for governed views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STARS = "***"


def initial_only(text: Column) -> Column:
    """First character, then stars: ``Ana`` -> ``A***``."""
    return F.concat(F.substring(text, 1, 1), F.lit(STARS))


def last_four(text: Column, lead: str = STARS) -> Column:
    """Stars, then the last four characters.  Shorter text shows whole."""
    return F.concat(F.lit(lead), F.substring(text, -4, 4))


def last_four_strict(text: Column, lead: str = STARS) -> Column:
    """As :func:`last_four`, but text of four characters or fewer is hidden whole."""
    return F.when(F.char_length(text) > 4, last_four(text, lead)).when(text.isNotNull(), F.lit(STARS))


def hidden(text: Column) -> Column:
    """Stars for any value, null for null."""
    return F.when(text.isNotNull(), F.lit(STARS))


def pseudonym(text: Column, secret: str) -> Column:
    """A stable stand-in, so that masked keys still join.

    Ids are a letter and a short number, which anybody could enumerate; only who has ``secret`` can.
    """
    keyed = F.sha2(F.concat(F.lit(secret), text.cast("string")), 256)
    return F.sha2(F.concat(F.lit(secret), keyed), 256)
