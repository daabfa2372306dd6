"""Domain constants and argument checks.

Everything under "FIXED VALUES" must stay exactly as written: the report
semantics (category spellings, orders, horizons, separators) depend on it.
"""

from __future__ import annotations

import datetime as _dt
import json
import math
import os
import re
from collections.abc import Iterable, Sequence

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference's for identical results)
# ---------------------------------------------------------------------------

# Raw phase spellings -> standard label. Case-sensitive exact match; null and
# anything else map to UNKNOWN_PHASE.
PHASE_SPELLINGS: dict[str, tuple[str, ...]] = {
    "Early Phase 1": ("EARLY_PHASE1", "EARLY_PHASE_1"),
    "Phase 1": ("PHASE1", "PHASE_1"),
    "Phase 1/2": ("PHASE1/PHASE2", "PHASE1_PHASE2", "PHASE1_2", "PHASE_1_2"),
    "Phase 2": ("PHASE2", "PHASE_2"),
    "Phase 2/3": ("PHASE2/PHASE3", "PHASE2_PHASE3", "PHASE2_3", "PHASE_2_3"),
    "Phase 3": ("PHASE3", "PHASE_3"),
    "Phase 4": ("PHASE4", "PHASE_4"),
    "Not Applicable": ("NA", "NOT_APPLICABLE"),
}
UNKNOWN_PHASE = "Unknown"

PHASE_ORDER: tuple[str, ...] = (
    "Early Phase 1", "Phase 1", "Phase 1/2", "Phase 2", "Phase 2/3",
    "Phase 3", "Phase 4", "Not Applicable", "Unknown",
)

# Active statuses, in the order the bar charts stack them.
ACTIVE_STATUSES: tuple[str, ...] = (
    "NOT_YET_RECRUITING", "RECRUITING", "ENROLLING_BY_INVITATION", "ACTIVE_NOT_RECRUITING",
)
UNKNOWN_STATUS = "UNKNOWN"

# Preferred column order of the phase x status matrix.
MATRIX_STATUS_ORDER: tuple[str, ...] = (
    "NOT_YET_RECRUITING", "RECRUITING", "ENROLLING_BY_INVITATION", "ACTIVE_NOT_RECRUITING",
    "SUSPENDED", "COMPLETED", "TERMINATED", "WITHDRAWN", "UNKNOWN",
)

# Preferred category order of the per-status chart (differs from the matrix).
CHART_STATUS_ORDER: tuple[str, ...] = (
    "RECRUITING", "ACTIVE_NOT_RECRUITING", "ENROLLING_BY_INVITATION", "NOT_YET_RECRUITING",
    "SUSPENDED", "TERMINATED", "COMPLETED", "WITHDRAWN", "UNKNOWN",
)

INTERVENTIONAL = "INTERVENTIONAL"
LEAD_ROLE = "lead"
ESTIMATED = "ESTIMATED"

# Event kinds in their display order, with the (date, date-type) columns each
# one reads from `studies`.
EVENT_ORDER: tuple[str, ...] = ("START", "PRIMARY_COMPLETION", "COMPLETION")
EVENT_SOURCES: dict[str, tuple[str, str]] = {
    "START": ("start_date", "start_date_type"),
    "PRIMARY_COMPLETION": ("primary_completion_date", "primary_completion_date_type"),
    "COMPLETION": ("completion_date", "completion_date_type"),
}
# Timeline column per event kind.
TIMELINE_COLUMNS: dict[str, str] = {
    "START": "starts",
    "PRIMARY_COMPLETION": "primary_completions",
    "COMPLETION": "completions",
}

TIMELINE_HORIZON_MONTHS = 12
BARS_HORIZON_MONTHS = 12
TABLE_HORIZON_MONTHS = 3
# Environment variables that override the three horizons.
TIMELINE_HORIZON_ENV = "TIMELINE_HORIZON_MONTHS"
BARS_HORIZON_ENV = "UPCOMING_HORIZON_MONTHS"
TABLE_HORIZON_ENV = "UPCOMING_TABLE_HORIZON_MONTHS"

TITLE_CHARS = 180
NAME_CHARS = 60
LIST_SEPARATOR = ", "
INTERVENTION_NAME_SEPARATOR = " · "  # space, middle dot, space

TOP_SPONSORS_DEFAULT, TOP_SPONSORS_MAX = 12, 50
TOP_INTERVENTION_TYPES_DEFAULT, TOP_INTERVENTION_TYPES_MAX = 20, 100

QUANTILE = 0.95

# Characters that JavaScript's String.prototype.trim removes: white space
# (tab, vertical tab, form feed, space, no-break space, BOM and the Unicode
# space separators) and line terminators (LF, CR, U+2028, U+2029).
JS_WHITESPACE = (
    "\t\n\u000b\u000c\r\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# Tokens that pandas.read_csv reads as missing by default.
PANDAS_NA_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Date columns of `studies` a bar chart may be built on.
DATE_COLUMNS: tuple[str, ...] = tuple(c for c, _ in EVENT_SOURCES.values())

# ---------------------------------------------------------------------------
# Argument checks
# ---------------------------------------------------------------------------


def horizon_from_env(name: str, default: int, environ=None) -> int:
    """A horizon from the environment; a value that is not an integer fails."""
    raw = (environ if environ is not None else os.environ).get(name)
    return check_months(default if raw is None else int(raw))


def check_months(months) -> int:
    """Horizon in whole months; accepts any int and integer text. With 0 the
    window is empty and the timeline is the one month of the as-of day."""
    return int(months)


def check_date_column(name: str) -> str:
    if name not in DATE_COLUMNS:
        raise ValueError(f"unknown date column {name!r}; expected one of {DATE_COLUMNS}")
    return name


def check_asof(asof) -> _dt.date | None:
    """None means "today on the cluster" (current_date); else a date."""
    if asof is None or isinstance(asof, _dt.date) and not isinstance(asof, _dt.datetime):
        return asof
    if isinstance(asof, _dt.datetime):
        return asof.date()
    return _dt.date.fromisoformat(str(asof))


# Numeral forms of JavaScript's Number(): decimal with optional exponent,
# Infinity, and unsigned hexadecimal, octal and binary.
_DECIMAL = re.compile(r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?")
_RADIX = re.compile(r"0(?:[xX][0-9a-fA-F]+|[oO][0-7]+|[bB][01]+)")


def js_number(value) -> float:
    """Number(value) for text, numbers, booleans and None (NaN if none)."""
    if value is None or isinstance(value, (bool, int, float)):
        return float(value or 0)
    text = js_trim(value)
    if not text:
        return 0.0
    if _RADIX.fullmatch(text):
        return float(int(text, 0))
    if text in ("Infinity", "+Infinity", "-Infinity"):
        return math.copysign(math.inf, -1 if text[0] == "-" else 1)
    return float(text) if _DECIMAL.fullmatch(text) else math.nan


def clamp_top_n(value, default: int, cap: int) -> int:
    """max(1, min(cap, Number(value) || default)); fractions truncate."""
    x = js_number(value)
    if math.isnan(x) or x == 0:
        x = float(default)
    return int(max(1.0, min(float(cap), x)))


def js_string(value) -> str:
    """String(value) of a JSON value: true, 1, 1.5, text; null gives ''."""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float) and value.is_integer() and abs(value) < 1e21:
        return str(int(value))
    return "" if value is None else str(value)


def js_trim(text) -> str:
    """Null-safe trim with JavaScript's notion of white space."""
    return js_string(text).strip(JS_WHITESPACE)


def split_names(raw: str | None) -> list[str]:
    """Comma text -> trimmed, non-empty names."""
    if not raw:
        return []
    return [p for p in (js_trim(x) for x in str(raw).split(",")) if p]


def parse_sponsor_request(url_value: str | None = None,
                          stored_list: str | None = None,
                          stored_json: str | None = None) -> list[str]:
    """Resolve a sponsor request from its three possible sources.

    The first non-empty source wins: the URL-style comma list, then a stored
    comma list, then a stored JSON object with a ``sponsors`` array or a single
    ``sponsor``. A malformed JSON object counts as no request.
    """
    names = split_names(url_value)
    if names:
        return names
    names = split_names(stored_list)
    if names:
        return names
    if not stored_json:
        return []
    try:
        blob = json.loads(stored_json)
    except (TypeError, ValueError):
        return []
    if not isinstance(blob, dict):
        return []
    if isinstance(blob.get("sponsors"), list):
        return [s for s in (js_trim(x) for x in blob["sponsors"]) if s]
    if blob.get("sponsor"):
        single = js_trim(blob["sponsor"])
        return [single] if single else []
    return []


def as_name_list(sponsors: str | Iterable[str] | None) -> list[str]:
    """Sponsor selection as a list: None/empty -> [], comma text -> names."""
    if sponsors is None:
        return []
    if isinstance(sponsors, str):
        return split_names(sponsors)
    return [s for s in (js_trim(x) for x in sponsors) if s]


def ordered_unique(values: Sequence[str]) -> list[str]:
    seen: set[str] = set()
    return [v for v in values if not (v in seen or seen.add(v))]
