"""Alert and vehicle classification rules as ``when`` chains.

All rules are first-match, evaluated on lower-cased text, and total: every
input (null included) gets exactly one label.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metroflow.functions import named_expr

# ---------------------------------------------------------------------------
# Fixed values (labels and keywords of the dashboard's rules).
# ---------------------------------------------------------------------------
SEVERITIES = ["SEVERE", "MODERATE", "LOW"]
DEFAULT_SEVERITY = "MODERATE"
VEHICLE_STATUS_LABELS = [(0, "Incoming at"), (1, "Stopped at"), (2, "In transit to")]
UNKNOWN_STATUS = "Unknown"
MISSING_TEXT = ["", "N/A"]
DEFAULT_HEADER = "Service Alert"
DEFAULT_SEVERITY_CHIP = "Medium"
DEFAULT_DESCRIPTION = "No description available."
DESCRIPTION_CUT = 120
# ---------------------------------------------------------------------------


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _low(x: Column | str | None) -> Column:
    return F.lower(F.coalesce(_c(x), F.lit(""))) if x is not None else F.lit("")


def _has(text: Column, *words: str) -> Column:
    cond = F.lit(False)
    for w in words:
        cond = cond | text.contains(w)
    return cond


@named_expr
def severity(sev: Column | str, header: Column | str, description: Column | str) -> Column:
    """Dashboard severity rule.

    Keep SEVERE/MODERATE/LOW; a missing severity counts as MODERATE; any
    other value is classified from the text: suspend/emergency in header or
    description, or closed in the header -> SEVERE; delay/slow in either ->
    MODERATE; else LOW. Result is upper case.
    """
    s = F.coalesce(F.when(_c(sev) != "", _c(sev)), F.lit(DEFAULT_SEVERITY))
    h, d = _low(header), _low(description)
    return (
        F.when(s.isin(*SEVERITIES), s)
        .when(_has(h, "suspend", "emergency") | _has(d, "suspend", "emergency") | h.contains("closed"), F.lit("SEVERE"))
        .when(_has(h, "delay", "slow") | _has(d, "delay", "slow"), F.lit("MODERATE"))
        .otherwise(F.lit("LOW"))
    )


@named_expr
def severity_page(sev: Column | str, header: Column | str) -> Column:
    """Alert page variant: only when severity is missing or UNKNOWN, header only,
    delay first (MODERATE), then suspend/emergency (SEVERE), else LOW."""
    s = _c(sev)
    h = _low(header)
    return (
        F.when(s.isNotNull() & (s != "") & (s != "UNKNOWN"), s)
        .when(h.contains("delay"), F.lit("MODERATE"))
        .when(_has(h, "suspend", "emergency"), F.lit("SEVERE"))
        .otherwise(F.lit("LOW"))
    )


def _missing(x: Column) -> Column:
    return x.isNull() | x.isin(*MISSING_TEXT)


@named_expr
def alert_type(kind: Column | str, header: Column | str) -> Column:
    """Alert type from the header when the given one is null, empty or N/A."""
    k, h = _c(kind), _low(header)
    return (
        F.when(~_missing(k), k)
        .when(h.contains("delay"), F.lit("Delay"))
        .when(h.contains("detour"), F.lit("Detour"))
        .when(h.contains("suspend"), F.lit("Suspension"))
        .when(_has(h, "work", "maintenance"), F.lit("Planned Work"))
        .otherwise(F.lit("Service Change"))
    )


@named_expr
def alert_effect(effect: Column | str, header: Column | str) -> Column:
    """Alert effect from the header when the given one is null, empty or N/A."""
    e, h = _c(effect), _low(header)
    return (
        F.when(~_missing(e), e)
        .when(h.contains("delay"), F.lit("Delays"))
        .when(h.contains("skip"), F.lit("Skip-Stop"))
        .when(h.contains("local") & h.contains("express"), F.lit("Local to Express"))
        .when(h.contains("suspend"), F.lit("Suspended"))
        .when(h.contains("reduce"), F.lit("Reduced Service"))
        .otherwise(F.lit("Modified Service"))
    )


@named_expr
def route_status(severe_count: Column | str, alerts_count: Column | str) -> Column:
    """delay if any severe alert, caution if any alert, else good."""
    return (
        F.when(_c(severe_count) > 0, F.lit("delay"))
        .when(_c(alerts_count) > 0, F.lit("caution"))
        .otherwise(F.lit("good"))
    )


@named_expr
def vehicle_status_text(status: Column | str, stop_id: Column | str) -> Column:
    """'Stopped at R12' etc.; unknown codes read 'Unknown'."""
    s = _c(status)
    label = F.lit(UNKNOWN_STATUS)
    for code, text in reversed(VEHICLE_STATUS_LABELS):
        label = F.when(s == code, F.lit(text)).otherwise(label)
    return F.concat_ws(" ", label, _c(stop_id))


@named_expr
def chart_label(route: Column | str, line: Column | str) -> Column:
    """Bar label of the top-routes chart."""
    r, ln = _c(route), _c(line)
    unknown = r.isNull() | (r == "") | (r == "Unknown")
    return (
        F.when(unknown & ln.isNotNull() & (ln != "") & (ln != "Unknown"), F.concat(ln, F.lit(" Line")))
        .when(unknown, F.lit("Non-revenue"))
        .when(r == "SIR", F.lit("Staten Island Railway"))
        .when(r.startswith("SIM"), F.concat(F.lit("SIM "), F.substr(r, F.lit(4))))
        .otherwise(r)
    )


@named_expr
def cut_description(desc: Column | str) -> Column:
    """Description shown in the recent-alerts card: 120 characters and '...', or a default."""
    d = _c(desc)
    return (
        F.when(F.length(d) > DESCRIPTION_CUT, F.concat(F.substring(d, 1, DESCRIPTION_CUT), F.lit("...")))
        .when(d.isNull() | (d == ""), F.lit(DEFAULT_DESCRIPTION))
        .otherwise(d)
    )
