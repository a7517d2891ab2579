"""Word splitting for column names (driver side) and for slugs (column side)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word pattern, with Latin-1 upper and lower case letters.
_UPPER = "A-ZÀ-ÖØ-Þ"
_LOWER = "a-zß-öø-ÿ"
WORD_PATTERN = f"[{_UPPER}]+(?=[{_UPPER}][{_LOWER}])|[{_UPPER}]?[{_LOWER}]+|[{_UPPER}]+|[0-9]+"
# Letters and digits of other scripts follow their own case, or are one word where they
# have none.  Column names are ASCII, so only slugs need them.
_SLUG_PATTERN = (
    r"\p{Lu}+(?=\p{Lu}\p{Ll})|\p{Lu}?\p{Ll}[\p{Ll}\p{M}]*|\p{Lu}[\p{Lu}\p{M}]*"
    r"|[\p{Lo}\p{Lt}\p{Lm}\p{M}]+|\p{N}+"
)


def snake(name: str) -> str:
    """``volume1wkAmm`` -> ``volume_1_wk_amm``; runs on column names only."""
    return "_".join(w.lower() for w in re.findall(WORD_PATTERN, name))


def kebab(c: Column) -> Column:
    """``Over 2.5 Goals`` -> ``over-2-5-goals``; text without words gives ``''``.

    Ordinals and apostrophes split: ``1st Half`` is ``1-st-half``, ``Don't`` is ``don-t``.
    """
    words = F.regexp_extract_all(c, F.lit(_SLUG_PATTERN), F.lit(0))
    return F.lower(F.array_join(words, "-"))
