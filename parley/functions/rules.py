"""Rule expressions over call metadata: durations, flags, coercions, bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .text import col, strip_ws


def norm_key(c) -> Column:
    """``str(x).lower().strip()`` for category keys."""
    return F.lower(strip_ws(col(c).cast("string")))


def duration_ordinal_train(seconds, bounds=K.DURATION_ORDINAL_TRAIN) -> Column:
    """<=240 -> -1, <=420 -> 0, else 1; null -> 0 (training rule)."""
    s = col(seconds).try_cast("double")
    lo, hi = bounds
    return (F.when(s.isNull() | F.isnan(s), 0).when(s <= lo, -1).when(s <= hi, 0)
            .otherwise(1).cast("double"))


def duration_ordinal_crm(seconds, bounds=K.DURATION_ORDINAL_CRM) -> Column:
    """int(seconds); <180 -> -1, >600 -> 1, else 0; unparsable -> 0 s."""
    raw = col(seconds)
    as_int = F.coalesce(raw.try_cast("double").try_cast("bigint"), F.lit(0))
    lo, hi = bounds
    return F.when(as_int < lo, -1).when(as_int > hi, 1).otherwise(0).cast("double")


def duration_label(seconds, bins=K.DURATION_BINS) -> Column:
    """(0,240] short, (240,390] medium, (390,inf) long, otherwise 'nan'."""
    s = col(seconds).try_cast("double")
    z, a, b = bins
    return (F.when(s.isNull() | F.isnan(s) | (s <= z), "nan").when(s <= a, "short")
            .when(s <= b, "medium").otherwise("long"))


def duration_label_total(seconds, bins=K.DURATION_BINS) -> Column:
    """Sidebar variant: <=240 short, >390 long, else medium (total)."""
    s = col(seconds).try_cast("double")
    _, a, b = bins
    return F.when(s <= a, "short").when(s > b, "long").otherwise("medium")


def label_ordinal(label) -> Column:
    """short -1, medium 0, long 1, anything else 0."""
    k = norm_key(label)
    expr = F.lit(0)
    for name, v in K.DURATION_LABEL_ORDINAL.items():
        expr = F.when(k == name, v).otherwise(expr)
    return expr.cast("double")


def ordinal_from_mixed(c) -> Column:
    """Ordinal from a mixed string/numeric column (short/-1/-1.0 -> -1 ...)."""
    k = norm_key(c)
    return (F.when(k.isin("short", "-1", "-1.0"), -1)
            .when(k.isin("medium", "0", "0.0"), 0)
            .when(k.isin("long", "1", "1.0"), 1).otherwise(0).cast("double"))


def repeat_flag(c, accepted=K.REPEAT_TRUE) -> Column:
    """Normalise a repeat-contact value to 0/1 through its string form."""
    return F.coalesce(norm_key(c).isin(*accepted), F.lit(False)).cast("double")


def resolution_from_status(c) -> Column:
    """1 when ``lower(strip(status)) == 'resolved'`` else 0."""
    return F.coalesce(norm_key(c) == "resolved", F.lit(False)).cast("double")


def alias_map(aliases=K.ISSUE_ALIASES) -> Column:
    """The alias table as a literal map column."""
    return F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])


def intent_of(issue, aliases=K.ISSUE_ALIASES) -> Column:
    """Map an issue type through the alias table to an intent (else null)."""
    return F.try_element_at(alias_map(aliases), norm_key(issue))


def numeric_or_zero(c) -> Column:
    """``to_numeric(errors='coerce').fillna(0)`` — also NaN -> 0."""
    d = col(c).try_cast("double")
    return F.coalesce(F.nanvl(d, F.lit(None).cast("double")), F.lit(0.0))


def nan_to_zero(c) -> Column:
    d = col(c).cast("double")
    return F.coalesce(F.nanvl(d, F.lit(0.0)), F.lit(0.0))


def clip(c, lo=K.CSAT_MIN, hi=K.CSAT_MAX) -> Column:
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), col(c)))


def score_band(c) -> Column:
    s = col(c)
    return (F.when(s < K.BAND_AT_RISK, "AT RISK").when(s < K.BAND_SATISFACTORY, "SATISFACTORY")
            .otherwise("EXCELLENT"))


def satisfied(c) -> Column:
    return col(c) >= K.SATISFIED_THRESHOLD
