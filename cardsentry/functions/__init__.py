"""Column expressions (built-in Spark functions only, no Python UDFs)."""

from cardsentry.functions.parsing import parse_json, rescued_data, parse_timestamp, parse_date
from cardsentry.functions.text import (
    full_name, html_escape, mask_card, or_default, location, risk_color, money_text, time_text,
)
from cardsentry.functions.ids import alert_id, id_number

__all__ = [
    "parse_json", "rescued_data", "parse_timestamp", "parse_date",
    "full_name", "html_escape", "mask_card", "or_default", "location", "risk_color",
    "money_text", "time_text", "alert_id", "id_number",
]
