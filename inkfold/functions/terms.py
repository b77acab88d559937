"""Normal form of tags and concepts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters dropped at a term's ends besides white space; fixed values.
EDGE_MARKS = "#\"'“”‘’「」"
#: Java's view of Python's ``str.isspace``.
SPACE = r"\s\x1c-\x1f\x85\p{Z}"
_EDGES = rf"^[{SPACE}{EDGE_MARKS}]+|[{SPACE}{EDGE_MARKS}]+$"
#: Text in which NFKC changes nothing: printable ASCII and the unified ideographs.
_PLAIN = r"^[ -~一-鿿]*$"


def nfkc(text: Column) -> Column:
    """Unicode NFKC through the ICU library in Spark's own class path; plain text skips the call.

    The expression counts as non-deterministic for Spark, so it may stand in projections only.
    """
    icu = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(True))
    return F.when(text.isNull() | text.rlike(_PLAIN), text).otherwise(icu)


def normal_term(text: Column) -> Column:
    """NFKC, ends without white space and EDGE_MARKS, lower case; null stays null, an empty result is ''."""
    return F.lower(F.regexp_replace(nfkc(text), _EDGES, ""))


def normal_terms(items: Column) -> Column:
    """The normal terms of an array in its order, repeats kept, null and empty ones left out; a null array gives null."""
    return F.filter(F.transform(items, lambda x: normal_term(x)), lambda x: x.isNotNull() & (x != ""))
