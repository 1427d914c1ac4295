"""DuckDB text of the record tables, prepended as CTEs to every oracle query.

Each statement mirrors a builder of ``metroflow.sources.records``; the oracle
never parses JSON, it selects from these records directly.
"""

from __future__ import annotations

from metroflow.sources import records as R

_ROUTES = ",".join(R.VEHICLE_ROUTES)
_KINDS = "|".join(R.ALERT_KINDS)
_R1 = ",".join(R.ALERT_ROUTES_1)
_R2 = ",".join(R.ALERT_ROUTES_2)
_BOROUGHS = ",".join(R.BOROUGHS)

RECORD_SQL: dict[str, str] = {
    "vehicles": f"""
SELECT r.event_id,
       concat('E', CAST(r.event_id AS VARCHAR)) AS id,
       CASE WHEN r.route_id IN ('1','2','3','4','5','6','7') THEN '1234567'
            WHEN r.route_id IN ('A','C','E') THEN 'ACE'
            WHEN r.route_id IN ('B','D','F','M') THEN 'BDFM'
            WHEN r.route_id IN ('N','Q','R','W') THEN 'NQRW'
            WHEN r.route_id IN ('J','Z') THEN 'JZ'
            WHEN r.route_id IN ('G','L','SIR') THEN r.route_id
            ELSE 'OTHER' END AS line_id,
       r.route_id,
       concat('T', CAST(r.user_id AS VARCHAR), '_', r.route_id) AS trip_id,
       '{R.START_TIME}' AS start_time,
       '{R.START_DATE}' AS start_date,
       CASE WHEN r.event_id % 50 = 0 THEN NULL
            ELSE concat('V', CAST(r.user_id AS VARCHAR)) END AS vehicle_id,
       CAST(r.event_id % 4 AS INT) AS current_status,
       CAST(r.event_id % 40 AS INT) AS current_stop_sequence,
       concat('R', CAST(r.event_id % 60 AS VARCHAR)) AS stop_id,
       CASE WHEN r.event_type = 'error' THEN NULL
            ELSE CAST(40.5 AS DOUBLE) + CAST(r.event_id % 500 AS DOUBLE) / CAST(1000 AS DOUBLE) END AS latitude,
       CASE WHEN r.event_type = 'error' THEN NULL
            ELSE CAST(-74.25 AS DOUBLE) + CAST(r.event_id % 700 AS DOUBLE) / CAST(1000 AS DOUBLE) END AS longitude,
       CASE WHEN r.event_type = 'error' THEN NULL
            ELSE CAST(r.event_id % 360 AS DOUBLE) END AS bearing,
       r.ts,
       epoch_us(r.ts) // 1000000 AS "timestamp",
       r.user_id,
       r.event_type
FROM (SELECT e.*,
             split_part('{_ROUTES}', ',',
                        CAST((e.user_id * 7 + e.event_id % 3) % 30 AS INT) + 1) AS route_id
      FROM events e) r""",
    "alerts": f"""
SELECT a.doc_id, a.id, a.alert_type, a.effect,
       CASE WHEN a.doc_id % 9 IN (2, 3) THEN ''
            ELSE concat(a.kind, ': ', a.route_1, ' and ', a.route_2, ' trains') END AS header,
       CASE WHEN a.doc_id % 9 = 4 THEN '' ELSE a.text END AS description,
       CASE WHEN a.doc_id % 11 = 0 THEN NULL
            ELSE TIMESTAMP '1970-01-01' + to_seconds(a.start_epoch) END AS "start",
       CASE WHEN a.doc_id % 11 = 0 OR a.end_epoch IS NULL THEN NULL
            ELSE TIMESTAMP '1970-01-01' + to_seconds(a.end_epoch) END AS "end",
       TIMESTAMP '1970-01-01' + to_seconds({R.ALERT_POLL_1}) AS updated,
       a.severity,
       a.route_1, a.route_2,
       CASE WHEN a.route_1 = a.route_2 THEN a.route_1 ELSE a.route_1 || ',' || a.route_2 END AS routes_str
FROM (SELECT d.doc_id, d.text,
             concat('alert-', CAST(d.doc_id AS VARCHAR)) AS id,
             split_part('{_KINDS}', '|', CAST(d.doc_id % 12 AS INT) + 1) AS kind,
             CASE d.doc_id % 5 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'SEVERE' WHEN 2 THEN 'MODERATE'
                               WHEN 3 THEN 'LOW' ELSE NULL END AS severity,
             CASE WHEN d.doc_id % 7 = 0 THEN NULL ELSE 'N/A' END AS alert_type,
             CASE WHEN d.doc_id % 4 = 0 THEN 'SIGNIFICANT_DELAYS' ELSE 'N/A' END AS effect,
             split_part('{_R1}', ',', CAST(d.doc_id % 22 AS INT) + 1) AS route_1,
             split_part('{_R2}', ',', CAST(d.doc_id % 4 AS INT) + 1) AS route_2,
             CAST({R.ALERT_PERIOD_BASE} AS BIGINT) + (d.doc_id % 20) * 86400 AS start_epoch,
             CASE WHEN d.doc_id % 3 = 0 THEN NULL
                  ELSE CAST({R.ALERT_PERIOD_BASE} AS BIGINT) + (d.doc_id % 20 + 5) * 86400 END AS end_epoch
      FROM documents d) a""",
    "equipment": f"""
SELECT concat('EQ', CAST(p.p_partkey AS VARCHAR)) AS equipment_id,
       p.p_name AS station,
       split_part('{_BOROUGHS}', ',', CAST(p.p_partkey % 5 AS INT) + 1) AS borough,
       CASE WHEN p.p_size % 2 = 0 THEN 'ELEVATOR' ELSE 'ESCALATOR' END AS equipment_type,
       p.p_type AS serving,
       p.p_size % 3 = 0 AS ada
FROM part p""",
    "outages": f"""
SELECT concat('OUT', CAST(l.l_orderkey AS VARCHAR), '-', CAST(l.l_linenumber AS VARCHAR), '-', CAST(l.l_partkey AS VARCHAR), '-',
              CAST(l.l_suppkey AS VARCHAR)) AS outage_id,
       concat('EQ', CAST(l.l_partkey AS VARCHAR)) AS equipment_id,
       p.p_name AS station,
       split_part('{_BOROUGHS}', ',', CAST(p.p_partkey % 5 AS INT) + 1) AS borough,
       CASE WHEN p.p_size % 2 = 0 THEN 'ELEVATOR' ELSE 'ESCALATOR' END AS equipment_type,
       p.p_type AS serving,
       CAST(CAST(l.l_shipdate AS DATE) AS TIMESTAMP) AS outage_start,
       CASE WHEN l.l_quantity < 10 THEN NULL
            ELSE CAST(CAST(l.l_shipdate AS DATE) + CAST(l.l_quantity AS INT) AS TIMESTAMP) END AS outage_end,
       CASE l.l_returnflag WHEN 'R' THEN 'Repair' WHEN 'A' THEN 'Scheduled Maintenance'
                           ELSE 'Capital Replacement' END AS reason,
       CASE WHEN l.l_linestatus = 'O' THEN 'OUT_OF_SERVICE' ELSE 'PLANNED' END AS latest_status,
       l.l_linestatus = 'O' AS is_current
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey""",
}

# Both alert polls: the second repeats the even documents 60 s later as SEVERE.
RECORD_SQL["alert_polls"] = f"""
SELECT doc_id, id, alert_type, effect, header, description, "start", "end", updated, severity,
       route_1, route_2, routes_str
FROM alerts
UNION ALL
SELECT doc_id, id, alert_type, effect, header, description, "start", "end",
       TIMESTAMP '1970-01-01' + to_seconds({R.ALERT_POLL_2}) AS updated, 'SEVERE' AS severity,
       route_1, route_2, routes_str
FROM alerts WHERE doc_id % 2 = 0"""

# Latest state per alert id over both polls.
RECORD_SQL["alerts_latest"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated DESC) AS rn FROM alert_polls) t
WHERE rn = 1"""

# Latest row per vehicle_id by (ts, event_id); rows without a vehicle id are kept as they are.
RECORD_SQL["vehicles_latest"] = """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM vehicles WHERE vehicle_id IS NOT NULL) t
WHERE rn = 1
UNION ALL
SELECT *, 1 AS rn FROM vehicles WHERE vehicle_id IS NULL"""

_DEPENDS = {
    "alert_polls": ["alerts"],
    "alerts_latest": ["alerts", "alert_polls"],
    "vehicles_latest": ["vehicles"],
}


def with_records(body: str, *names: str) -> str:
    """Prefix ``body`` with the record CTEs it names (and what they depend on)."""
    order: list[str] = []
    for n in names:
        for dep in _DEPENDS.get(n, []) + [n]:
            if dep not in order:
                order.append(dep)
    ctes = ",\n".join(f"{n} AS ({RECORD_SQL[n]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"


# ---------------------------------------------------------------------------
# SQL spellings of the column rules, for oracle text. They are written from
# the same fixed values as ``metroflow.functions`` but as plain CASE chains.
# ---------------------------------------------------------------------------
from metroflow.functions import routes as RD  # noqa: E402


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(xs) -> str:
    return ", ".join(q(x) for x in xs)


def sql_bus_prefix(r: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({r}, '^{p}[0-9]') THEN {q(p)}" for p in ["SIM", "Bx", "M", "B", "Q", "X"])
    return f"(CASE {whens} ELSE NULL END)"


def sql_route_kind(r: str) -> str:
    bp = sql_bus_prefix(r)
    return (f"(CASE WHEN {r} IN ({in_list(RD.SUBWAY_CODES)}) THEN 'subway' "
            f"WHEN {r} IN ('SIR', 'SI') THEN 'railway' "
            f"WHEN {bp} = 'SIM' THEN 'simexpress' WHEN {bp} = 'X' THEN 'express' "
            f"WHEN {bp} IS NOT NULL THEN 'bus' ELSE 'other' END)")


def sql_route_family(r: str) -> str:
    bp = sql_bus_prefix(r)
    fams = " ".join(f"WHEN {r} IN ({in_list(codes)}) THEN {q(f)}" for f, codes in RD.FAMILIES)
    return (f"(CASE WHEN {r} = 'SI' THEN 'SIR' WHEN {bp} = 'SIM' THEN 'SIMEXPRESS' "
            f"WHEN {bp} = 'X' THEN 'EXPRESS' WHEN {bp} IS NOT NULL THEN 'BUS' {fams} ELSE NULL END)")


def _case_map(expr: str, pairs) -> str:
    return "CASE " + " ".join(f"WHEN {expr} = {q(k)} THEN {q(v)}" for k, v in pairs) + " ELSE NULL END"


def sql_dim_color(r: str) -> str:
    exact = _case_map(r, RD.API_COLORS + [("SIR", "#0039A6")])
    bus = _case_map(sql_bus_prefix(r), RD.BUS_PREFIX_COLORS)
    return f"(CASE WHEN {r} IS NULL THEN '#000000' ELSE coalesce({exact}, {bus}, '#000000') END)"


def sql_api_color(r: str) -> str:
    return f"coalesce({_case_map(r, RD.API_COLORS)}, '#000000')"


def sql_ui_color(r: str, variant: str = "ui") -> str:
    ui = RD.UI_COLORS
    keys = in_list(ui.keys())
    first = f"substr({r}, 1, 1)"
    parts = []
    if variant != "chart":
        parts.append(f"WHEN {r} IS NULL OR {r} = '' THEN '#000000'")
    parts.append(f"WHEN {r} IN ({keys}) THEN {_case_map(r, ui.items())}")
    parts.append(f"WHEN {r} LIKE 'M%' AND length({r}) > 1 THEN {q(ui['M'])}")
    parts.append(f"WHEN {r} LIKE 'B%' AND length({r}) > 1 THEN {q(ui['B'])}")
    parts.append(f"WHEN {r} LIKE 'Bx%' THEN {q(ui['Bx'])}")
    parts.append(f"WHEN {r} LIKE 'Q%' AND length({r}) > 1 THEN {q(ui['Q'])}")
    parts.append(f"WHEN {r} LIKE 'X%' THEN {q(ui['X'])}")
    parts.append(f"WHEN {r} LIKE 'SIM%' THEN {q(ui['SIM'])}")
    if variant != "alerts_page":
        parts.append(f"WHEN {first} IN ({keys}) THEN {_case_map(first, ui.items())}")
    default = RD.CHART_DEFAULT_COLOR if variant == "chart" else RD.NO_COLOR
    return "(CASE " + " ".join(parts) + f" ELSE {q(default)} END)"


def sql_page_route_type(r: str) -> str:
    return (f"(CASE WHEN {r} IS NULL OR {r} = '' THEN 'subway' WHEN {r} = 'SIR' THEN 'railway' "
            f"WHEN {r} LIKE 'M%' AND length({r}) > 1 THEN 'bus-manhattan' "
            f"WHEN {r} LIKE 'B%' AND length({r}) > 1 THEN 'bus-brooklyn' "
            f"WHEN {r} LIKE 'Bx%' THEN 'bus-bronx' "
            f"WHEN {r} LIKE 'Q%' AND length({r}) > 1 THEN 'bus-queens' "
            f"WHEN {r} LIKE 'X%' THEN 'bus-express' "
            f"WHEN {r} LIKE 'SIM%' THEN 'bus-staten-island-express' ELSE 'subway' END)")


def sql_page_route_label(r: str) -> str:
    t = sql_page_route_type(r)
    return (f"(CASE WHEN {t} = 'railway' THEN 'Staten Island Railway' "
            f"WHEN {t} IN ('bus-manhattan', 'bus-brooklyn', 'bus-bronx', 'bus-queens') THEN 'Bus ' || {r} "
            f"WHEN {t} = 'bus-express' THEN 'Express Bus ' || {r} "
            f"WHEN {t} = 'bus-staten-island-express' THEN 'Staten Island Express ' || {r} "
            f"ELSE 'Line ' || coalesce({r}, '') END)")


def sql_is_bus(r: str) -> str:
    return (f"coalesce(({r} LIKE 'M%' AND length({r}) > 1) OR ({r} LIKE 'B%' AND length({r}) > 1) "
            f"OR {r} LIKE 'Bx%' OR ({r} LIKE 'Q%' AND length({r}) > 1) OR {r} LIKE 'X%' OR {r} LIKE 'SIM%', false)")


def _low(x: str) -> str:
    return f"lower(coalesce({x}, ''))"


def sql_severity(sev: str, header: str, desc: str) -> str:
    s = f"coalesce(nullif({sev}, ''), 'MODERATE')"
    h, d = _low(header), _low(desc)
    return (f"(CASE WHEN {s} IN ('SEVERE', 'MODERATE', 'LOW') THEN {s} "
            f"WHEN contains({h}, 'suspend') OR contains({h}, 'emergency') OR contains({d}, 'suspend') "
            f"OR contains({d}, 'emergency') OR contains({h}, 'closed') THEN 'SEVERE' "
            f"WHEN contains({h}, 'delay') OR contains({h}, 'slow') OR contains({d}, 'delay') "
            f"OR contains({d}, 'slow') THEN 'MODERATE' ELSE 'LOW' END)")


def sql_severity_page(sev: str, header: str) -> str:
    h = _low(header)
    return (f"(CASE WHEN {sev} IS NOT NULL AND {sev} <> '' AND {sev} <> 'UNKNOWN' THEN {sev} "
            f"WHEN contains({h}, 'delay') THEN 'MODERATE' "
            f"WHEN contains({h}, 'suspend') OR contains({h}, 'emergency') THEN 'SEVERE' ELSE 'LOW' END)")


def sql_alert_type(kind: str, header: str) -> str:
    h = _low(header)
    return (f"(CASE WHEN {kind} IS NOT NULL AND {kind} NOT IN ('', 'N/A') THEN {kind} "
            f"WHEN contains({h}, 'delay') THEN 'Delay' WHEN contains({h}, 'detour') THEN 'Detour' "
            f"WHEN contains({h}, 'suspend') THEN 'Suspension' "
            f"WHEN contains({h}, 'work') OR contains({h}, 'maintenance') THEN 'Planned Work' "
            f"ELSE 'Service Change' END)")


def sql_alert_effect(effect: str, header: str) -> str:
    h = _low(header)
    return (f"(CASE WHEN {effect} IS NOT NULL AND {effect} NOT IN ('', 'N/A') THEN {effect} "
            f"WHEN contains({h}, 'delay') THEN 'Delays' WHEN contains({h}, 'skip') THEN 'Skip-Stop' "
            f"WHEN contains({h}, 'local') AND contains({h}, 'express') THEN 'Local to Express' "
            f"WHEN contains({h}, 'suspend') THEN 'Suspended' WHEN contains({h}, 'reduce') THEN 'Reduced Service' "
            f"ELSE 'Modified Service' END)")


def sql_route_box(r: str) -> tuple[str, str, str, str]:
    outs = []
    for i in range(4):
        whens = " ".join(f"WHEN {r} IN ({in_list(codes)}) THEN CAST({b[i]} AS DOUBLE)" for codes, *b in RD.ROUTE_BOXES)
        outs.append(f"(CASE {whens} ELSE CAST({RD.DEFAULT_BOX[i]} AS DOUBLE) END)")
    return tuple(outs)


def sql_unit(id_expr: str, part: int) -> str:
    """Uniform [0,1) draw from 8 hex digits of md5(id), part 0, 1, 2."""
    return f"(CAST(('0x' || substr(md5({id_expr}), {1 + 8 * part}, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE))"
