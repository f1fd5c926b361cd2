"""Text for people: names, defaults, locations, HTML-safe values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Colour per risk level in fraud notices, and the colour for an
# unknown or missing level.
RISK_COLORS = {
    "CRITICAL": "#dc3545",
    "HIGH": "#fd7e14",
    "MEDIUM": "#ffc107",
    "LOW": "#28a745",
    "UNKNOWN": "#6c757d",
}
DEFAULT_RISK_COLOR = "#6c757d"
MISSING = "N/A"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def full_name(first: Column | str, last: Column | str) -> Column:
    """``first last``; NULL parts are skipped, both NULL gives ``''``."""
    return F.concat_ws(" ", _c(first), _c(last))


def or_default(x: Column | str, default: str = MISSING) -> Column:
    """Text of ``x``, or ``default`` when it is NULL."""
    return F.coalesce(_c(x).cast("string"), F.lit(default))


def location(city: Column | str, country: Column | str) -> Column:
    return F.concat(or_default(city), F.lit(", "), or_default(country))


def html_escape(x: Column | str) -> Column:
    """Escape ``& < > "`` so that values cannot break the markup."""
    out = _c(x).cast("string")
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def mask_card(card: Column | str) -> Column:
    """Only the last four digits of a card number are shown."""
    c = _c(card)
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("**** "), F.substring(c, -4, 4)))


def risk_color(level: Column | str) -> Column:
    """Colour for a risk level; unknown and NULL levels get the default."""
    lookup = F.create_map(*[F.lit(v) for kv in RISK_COLORS.items() for v in kv])
    return F.coalesce(F.try_element_at(lookup, _c(level)), F.lit(DEFAULT_RISK_COLOR))


def money_text(amount: Column | str) -> Column:
    """Amount with two decimals, e.g. ``1234.50``.

    Rounded to whole cents as ``floor(amount * 100 + 0.5)``: one rule with
    the same result in every engine (formatting functions differ on exact
    halves such as 90.125).
    """
    cents = F.floor(_c(amount) * F.lit(100) + F.lit(0.5))
    whole = F.abs(cents)
    text = F.concat(F.when(cents < 0, F.lit("-")).otherwise(F.lit("")),
                    F.floor(whole / F.lit(100)).cast("string"), F.lit("."),
                    F.lpad((whole % F.lit(100)).cast("string"), 2, "0"))
    return F.when(cents.isNull(), F.lit(None).cast("string")).otherwise(text)


def time_text(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")
