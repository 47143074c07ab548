"""Output line builders (SK3, SK4, X3) as built-in expressions.

``concat_ws`` skips nulls, which would shift fields; every field is coalesced first so a line
always has its full number of fields.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.schemas import OUT_SEP, PAIR_KEY_SEP


def _text(c: Column | str, null_text: str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit(null_text))


def tab_line(*cols: Column | str, null_text: str = "") -> Column:
    """SK4: fields joined by a tab, numbers in their text form, null as ``null_text``."""
    return F.concat_ws(OUT_SEP, *[_text(c, null_text) for c in cols])


def pair_line(id1: Column | str, id2: Column | str, n: Column | str, null_text: str = "") -> Column:
    """SK3: ``"id1, id2<TAB>n"``, null as ``null_text``."""
    return F.concat(_text(id1, null_text), F.lit(PAIR_KEY_SEP), _text(id2, null_text), F.lit(OUT_SEP),
                    _text(n, null_text))
