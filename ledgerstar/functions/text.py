"""Text cleaning."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_token(
    text: str | Column, token: str = "fraud_", replacement: str = " ", anchored: bool = False
) -> Column:
    """Replace every ``token`` in ``text``; with ``anchored``, only strip it off the front.

    Token and replacement are plain text.
    """
    if anchored:
        return F.regexp_replace(text, "^" + re.escape(token), "")
    return F.replace(text, F.lit(token), F.lit(replacement))
