"""Text functions: blank tests and name cleaning."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

# The characters Unicode calls white space (Spark's trim removes the plain space only).
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: characters that a cleaned name does not keep (all but letters, numbers, ``_``, ``-``, white space).
NOT_IN_NAMES = rf"[^\p{{L}}\p{{N}}_\-{WHITESPACE}\x1c-\x1f]"


def strip(col: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.trim(col, F.lit(WHITESPACE))


def is_blank(col: Column) -> Column:
    """True for a text of white space only, null for null. Looks no further than the first other character.

    A text that starts with a visible ASCII character is told by two comparisons, without a search in the white space.
    """
    text = col.cast("string")
    return ~((text >= "!") & (text < "\x7f")) & (F.ltrim(text, F.lit(WHITESPACE)) == "")


def is_missing(col: Column) -> Column:
    """True for null and for blank text; never null."""
    return col.isNull() | is_blank(col)


def _plain(texts: pa.Array) -> pa.Array:
    """Texts without accents and punctuation, trimmed, with ``_`` for spaces; four Arrow kernels.

    The decomposed form turns accents into combining marks, which go along with the punctuation.
    """
    letters = pc.replace_substring_regex(pc.utf8_normalize(texts, "NFD"), NOT_IN_NAMES, "")
    return pc.replace_substring(pc.utf8_trim(letters, WHITESPACE + "\x1c\x1d\x1e\x1f"), " ", "_")


def clean_text(col: Column) -> Column:
    """Plain lower-case names: no accents, no punctuation but ``-`` and ``_``, spaces as ``_``.

    Spark has no Unicode decomposition, hence one Arrow UDF, which takes the steps after it along.
    """

    @F.arrow_udf("string")
    def plain(texts: pa.Array) -> pa.Array:
        return _plain(texts)

    return F.lower(plain(col))


def clean_names(names: Sequence[str]) -> list[str]:
    """``clean_text`` of some names, such as those of columns, in their order; they are schema, so no job is run."""
    return [text.lower() for text in _plain(pa.array(names, pa.string())).to_pylist()]
