"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Latin-1 letters with diacritics and their unaccented base
# letters, position by position (NFKD folding of the Latin-1 range).
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
UNACCENTED = "aaaaaaceeeeiiiinooooouuuuyy"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold_accents(x) -> Column:
    return F.translate(col(x), ACCENTED, UNACCENTED)


def normalise_name(x) -> Column:
    """Lower-case, fold accents, non-alphanumerics -> one space, trim."""
    c = fold_accents(F.lower(F.trim(col(x))))
    c = F.regexp_replace(c, r"[^a-z0-9]+", " ")
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def concat_key(*cols, sep: str = "_") -> Column:
    return F.concat_ws(sep, *[col(c).cast("string") for c in cols])


def capitalise(x) -> Column:
    return F.initcap(col(x))
