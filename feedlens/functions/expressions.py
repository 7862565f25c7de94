"""Column expressions shared by the operators. All JVM-side built-ins."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlens import schemas as S

# Display labels of the known recommendation reasons, our own words. An unknown reason is
# made readable instead, a missing one gets the default label.
REASON_LABELS = {
    S.REASON_ALS: "Based on your activity in the feed",
    S.REASON_SUBSCRIBED: "From categories you are subscribed to",
    S.REASON_POPULAR: "Popular with readers",
    S.REASON_ACTIVITY: "Based on your recent likes and saves",
}
REASON_DEFAULT_LABEL = "Picked for you"

UUID_PATTERN = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def weight(weights: Mapping[str, float], default: float | None, type_col: str = "event_type") -> Column:
    """Weight of an event type; ``default`` for types not listed and for NULL."""
    pairs = [F.lit(part) for item in weights.items() for part in item]
    found = F.element_at(F.create_map(*pairs), F.col(type_col))
    return found if default is None else F.coalesce(found, F.lit(default))


# Rows of a rollup stand for this many events.
EVENTS = "n"


def events_sum(condition: Column | None = None) -> Column:
    """Aggregate: number of events over rollup rows, of those that meet the condition."""
    own = F.col(EVENTS) if condition is None else F.when(condition, F.col(EVENTS))
    return F.coalesce(F.sum(own), F.lit(0)).cast("long")


def net_count(plus: str, minus: str | None = None, type_col: str = "event_type") -> Column:
    """Aggregate over rollup rows: events of type ``plus`` less events of type ``minus``."""
    total = events_sum(F.col(type_col) == plus)
    return total if minus is None else total - events_sum(F.col(type_col) == minus)


def score_sum(weights: Mapping[str, float] = S.RATING_WEIGHTS, type_col: str = "event_type") -> Column:
    """Aggregate over rollup rows: weighted score, 0 for types without a weight and empty input."""
    return F.coalesce(F.sum(weight(weights, 0.0, type_col) * F.col(EVENTS)), F.lit(0.0))


def ratio_or_zero(clicked: Column, opened: Column) -> Column:
    """Click-through rate to 4 digits (half up); 0 without openings; may exceed 1."""
    return F.when(opened > 0, F.round(clicked / opened, 4)).otherwise(F.lit(0.0))


def nonzero_or(first: Column, second: Column) -> Column:
    """``first`` unless it is 0 or NULL."""
    return F.coalesce(F.nullif(first, F.lit(0)), second)


def utc_literal(moment: datetime) -> Column:
    """A timestamp literal that does not depend on the driver's time zone."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.lit(moment.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f+00:00")).cast("timestamp")


def days_before(now: Column | datetime, days: int) -> Column:
    moment = utc_literal(now) if isinstance(now, datetime) else now
    return moment - F.make_dt_interval(F.lit(days))


def lenient_map(json_text: Column, null_when_bad: bool) -> Column:
    """JSON object text to map. Blank or broken text gives NULL or an empty map."""
    parsed = F.from_json(json_text, "MAP<STRING, STRING>")
    if null_when_bad:
        return parsed
    return F.coalesce(parsed, F.from_json(F.lit("{}"), "MAP<STRING, STRING>"))


def slug(text: Column) -> Column:
    """Lower case; every run of other characters than a-z and 0-9 is one dash."""
    dashed = F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9]+", "-")
    return F.regexp_replace(dashed, "^-+|-+$", "")


def title_words(text: Column) -> Column:
    """Upper-case each letter that follows a non-letter, lower-case the others."""
    words = F.split(text, "(?<![A-Za-z])(?=[A-Za-z])")
    return F.array_join(F.transform(words, F.initcap), "")


def clean_email(text: Column) -> Column:
    return F.lower(F.trim(text))


def email_ok(text: Column) -> Column:
    """One ``@`` at least, neither first nor last; 3 to 255 characters as sent."""
    email = clean_email(text)
    return F.coalesce(
        email.contains("@")
        & ~email.startswith("@")
        & ~email.endswith("@")
        & F.length(text).between(3, 255),
        F.lit(False),
    )


def ctr_progress(ctr: Column) -> Column:
    """Progress-bar percentage: 0 for missing, negative, NaN or infinite rates."""
    usable = F.coalesce((ctr > 0) & (ctr < F.lit(float("inf"))), F.lit(False))
    percent = F.floor(F.least(ctr, F.lit(1.0)) * 100 + 0.5).cast("int")
    return F.when(usable, percent).otherwise(F.lit(0))


def reason_label(reason: Column) -> Column:
    trimmed = F.trim(reason)
    known = F.element_at(
        F.create_map(*[F.lit(part) for item in REASON_LABELS.items() for part in item]), trimmed
    )
    words = F.translate(trimmed, "_-", "  ")
    readable = F.concat(F.upper(F.left(words, F.lit(1))), F.substr(words, F.lit(2)))
    blank = F.coalesce(trimmed == "", F.lit(True))
    return F.when(blank, F.lit(REASON_DEFAULT_LABEL)).otherwise(F.coalesce(known, readable))


def draw(seed: int, salt: str, *keys: Column) -> Column:
    """Reproducible uniform non-negative long for a row: 60 bits of a digest of keys and salt."""
    text = F.concat_ws("|", *[key.cast("string") for key in keys], F.lit(f"{seed}:{salt}"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def pick(values: tuple[str, ...], number: Column) -> Column:
    """One of ``values`` by a non-negative number."""
    choices = F.array(*[F.lit(value) for value in values])
    return F.element_at(choices, (number % len(values) + 1).cast("int"))


def hash_uuid(*keys: Column) -> Column:
    """UUID-shaped text that is a function of the keys, so a retried task repeats it."""
    digest = F.md5(F.concat_ws("|", *keys))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])
