"""Comparison keys: identifiers and categories compare trimmed and in lower case; empty is no value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that Unicode calls white space.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def key(c: Column | str) -> Column:
    """Trimmed, lower case, null where nothing is left."""
    return F.nullif(F.lower(F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(BLANKS))), F.lit(""))
