"""Text helpers: blank handling, JSON paths, note classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Override-note categories, tested in this order on the
# upper-cased note (first match wins); a null note falls to OTHER_CATEGORY.
# A rule whose category is None takes the ticket reference matched by
# TICKET_PATTERN from the original note instead ('' if absent).
NOTE_RULES = (
    (("LOSTSTOLENCARD", "LOST/STOLEN"), "Lost_Stolen_Card"),
    (("CHARGEBACKS",), "Chargebacks"),
    (("ORDERDISPUTES",), "Order_Disputes"),
    (("HARDSHIP",), "Hardship"),
    (("COMPLAINT",), "Complaint"),
    (("TECHISSUE",), "Tech Issue"),
    (("CAPITALONE",), "Capital One"),
    (("DISASTER",), "Disaster"),
    (("GOODWILL", "GOOD WILL"), "Goodwill"),
    (("INCIDENT REMEDIATION",), None),
)
TICKET_PATTERN = "#[^/ ]*"
OTHER_CATEGORY = "Others"
GOODWILL = "Goodwill"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_blank(c) -> Column:
    """``COALESCE(c, '') = ''``."""
    return F.coalesce(_c(c), F.lit("")) == F.lit("")


def not_blank(c) -> Column:
    return F.coalesce(_c(c), F.lit("")) != F.lit("")


def blank_to_null(c, dtype: str | None = None) -> Column:
    """``NULLIF(c, '')`` then an optional lenient cast (bad text -> NULL)."""
    out = F.nullif(_c(c), F.lit(""))
    return out.try_cast(dtype) if dtype else out


def json_text(c, *path: str) -> Column:
    """Text at a JSON object path; NULL for a missing key or malformed JSON."""
    return F.get_json_object(_c(c), "$." + ".".join(path))


def classify_note(note, rules=NOTE_RULES, otherwise: str = OTHER_CATEGORY) -> Column:
    """Ordered keyword rules -> category (``CASE WHEN UPPER(note) LIKE ...``)."""
    note = _c(note)
    up = F.upper(note)
    expr = None
    for words, category in rules:
        cond = None
        for w in words:
            t = up.contains(w)
            cond = t if cond is None else (cond | t)
        value = F.regexp_extract(note, f"({TICKET_PATTERN})", 1) if category is None else F.lit(category)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(F.lit(otherwise))
