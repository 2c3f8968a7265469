"""The registered queries as plain SQL, for a check by an independent engine.

Written from the definitions of the results, with common table expressions for shared parts.
"""

from __future__ import annotations

import re

CHANNEL = """CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'DME'
 WHEN c_mktsegment IN ('AUTOMOBILE', 'FURNITURE') THEN 'Pharmacy' ELSE 'DTC' END"""
DEVICE = "CASE WHEN c_acctbal > 4300 THEN 'Mobi' ELSE 't:slim X2' END"
PAT = "printf('PAT-%06d', {})"
HCP = "printf('HCP-%06d', {})"
BATCH = "TIMESTAMP '2001-09-01 00:00:00'"
NOW = "TIMESTAMP '2024-01-04 00:00:00'"
LATER = "TIMESTAMP '2024-01-05 00:00:00'"


def _meta(personal: bool, source: str = "foundation") -> str:
    p = "true" if personal else "false"
    return f"{BATCH} AS _loaded_at, '{source}' AS _source, {p} AS _has_phi, {p} AS _has_pii"


def months(to: str, since: str) -> str:
    """Whole months between two dates, by their numbers of months since year 0."""
    to_no, since_no = (f"12 * year({c}) + month({c})" for c in (to, since))
    return f"({to_no}) - ({since_no})"


CTES: dict[str, str] = {
    "places": """SELECT n_nationkey, n_name, r_name AS region
 FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "cust": f"""SELECT c_custkey, {PAT.format('c_custkey')} AS patient_id, {CHANNEL} AS channel,
 {DEVICE} AS device_type FROM customer""",
    "first_line": """SELECT l_orderkey, l_suppkey FROM (SELECT l_orderkey, l_suppkey,
 row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) AS rn
 FROM lineitem) WHERE rn = 1""",
    "enrolled": """SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS enrolled_date
 FROM orders GROUP BY o_custkey""",
    "referral": """SELECT o_custkey, l_suppkey FROM (SELECT o_custkey, l_suppkey,
 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
 FROM orders JOIN first_line ON o_orderkey = l_orderkey) WHERE rn = 1""",
    "patients": f"""SELECT {PAT.format('c.c_custkey')} AS patient_id, {DEVICE} AS device_type, region,
 printf('%03d-%02d-%04d', 100 + c.c_custkey % 900, 10 + c.c_custkey % 90,
  1000 + c.c_custkey % 9000) AS ssn,
 DATE '2024-01-01' - CAST(365 * (18 + c.c_custkey % 58) AS INTEGER) AS dob,
 c_name AS patient_name, enrolled_date, {HCP.format('l_suppkey')} AS referring_hcp_id
 FROM customer c JOIN places ON c_nationkey = n_nationkey
 LEFT JOIN enrolled e ON e.o_custkey = c.c_custkey
 LEFT JOIN referral r ON r.o_custkey = c.c_custkey""",
    "hcps": f"""SELECT {HCP.format('s_suppkey')} AS hcp_id, s_name AS hcp_name, n_name AS facility,
 CASE s_suppkey % 5 WHEN 0 THEN 'Endocrinologist' WHEN 1 THEN 'Diabetes Specialist'
  WHEN 2 THEN 'PCP' WHEN 3 THEN 'Nurse Educator' ELSE 'PA-NP' END AS specialty,
 CASE WHEN s_suppkey % 10 < 7 THEN 'prescriber' ELSE 'influencer' END AS role_type, region,
 CASE WHEN s_acctbal > 6000 THEN 'High' WHEN s_acctbal > 2000 THEN 'Medium' ELSE 'Low' END
  AS segment_priority,
 CASE WHEN s_suppkey % 5 < 2 THEN 't:slim X2' WHEN s_suppkey % 5 < 4 THEN 'Mobi'
  ELSE 'Competitor' END AS primary_device_referred,
 coalesce(nbrx, 0) AS nbrx_12m, coalesce(trx, 0) AS trx_12m
 FROM supplier JOIN places ON s_nationkey = n_nationkey
 LEFT JOIN (SELECT l_suppkey, count(*) AS trx, count(*) FILTER (l_returnflag = 'N') AS nbrx
  FROM lineitem GROUP BY l_suppkey) ON s_suppkey = l_suppkey""",
    "claims": """SELECT printf('CLM-%07d', l_orderkey * 10 + l_linenumber) AS claim_id, patient_id,
 CAST(l_shipdate AS DATE) AS claim_date,
 CASE l_returnflag WHEN 'A' THEN 'psa_intake' WHEN 'N' THEN 'pump_on_body'
  ELSE 'consumable_shipment' END AS claim_type,
 channel, CASE WHEN l_returnflag = 'R' THEN 'Consumables' ELSE 'Durables' END AS product_line,
 CASE l_returnflag WHEN 'A' THEN 'psa' WHEN 'N' THEN device_type ELSE 'infusion_set' END
  AS product_sku,
 CAST(l_extendedprice AS DECIMAL(18,2)) AS claim_amount_usd, CAST(l_quantity AS INTEGER) AS units
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN cust ON o_custkey = c_custkey""",
    "monthly": """SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
 sum(CASE WHEN l_linestatus = 'F' THEN price ELSE 0 END) AS upfront,
 sum(CASE WHEN l_linestatus = 'O' THEN price ELSE 0 END) AS recurring,
 sum(price) AS total, sum(price * rate) AS margin
 FROM (SELECT l_orderkey, l_linestatus, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
  CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)) - CAST(l_tax AS DECIMAL(4,2)) AS rate
  FROM lineitem) JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "revenue": """SELECT patient_id, month, CAST(upfront AS DECIMAL(18,2)) AS upfront_recognized_usd,
 CAST(recurring AS DECIMAL(18,2)) AS recurring_recognized_usd,
 CASE WHEN total <> 0 THEN CAST(margin AS DOUBLE) / CAST(total AS DOUBLE) * 100 END
  AS gross_margin_pct,
 CAST(total - margin AS DECIMAL(20,4)) AS fulfillment_cost_usd,
 CAST(total AS DECIMAL(18,2)) AS total_recognized_usd,
 CAST(margin AS DECIMAL(20,4)) AS margin_usd, channel, device_type
 FROM monthly JOIN cust ON o_custkey = c_custkey""",
    "s_patients": """SELECT patient_id, device_type,
 CASE WHEN device_type = 'Mobi' THEN 'mobi' ELSE 'slim' END AS device_category, region, ssn, dob,
 patient_name, enrolled_date, referring_hcp_id,
 CAST(trunc(date_diff('day', dob, enrolled_date) / 365.25) AS INTEGER) AS patient_age_at_enrollment
 FROM patients""",
    "s_hcps": """SELECT *, CASE WHEN trx_12m <> 0
 THEN CAST(trx_12m - nbrx_12m AS DOUBLE) / trx_12m END AS retention_rate FROM hcps""",
    "steps": """SELECT patient_id,
 min(claim_date) FILTER (claim_type = 'psa_intake') AS first_intake,
 min(claim_date) FILTER (claim_type = 'pump_on_body') AS first_placement,
 max(claim_date) FILTER (claim_type = 'pump_on_body') AS last_placement
 FROM claims GROUP BY patient_id""",
    "s_claims": """SELECT c.*, p.device_type, p.region,
 CAST(quarter(claim_date) AS INTEGER) AS quarter_num, CAST(year(claim_date) AS INTEGER) AS year_num,
 CAST(date_diff('day', first_intake, first_placement) AS INTEGER) AS days_to_pump_on_body,
 claim_amount_usd > 50000 AS is_high_value
 FROM claims c JOIN patients p USING (patient_id) JOIN steps USING (patient_id)""",
    "g_claims": f"""WITH kept AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY claim_id ORDER BY patient_id, claim_date, claim_type, channel, product_line,
   product_sku, claim_amount_usd, units, device_type, region, quarter_num, year_num,
   days_to_pump_on_body NULLS LAST, is_high_value) AS rn
  FROM s_claims WHERE claim_type IN ('pump_on_body', 'consumable_shipment')) WHERE rn = 1),
 anchors AS (SELECT patient_id, max(claim_date) AS anchor FROM kept
  WHERE claim_type = 'pump_on_body' GROUP BY patient_id)
 SELECT kept.*, CAST(CASE WHEN claim_type = 'pump_on_body' THEN 0
  ELSE {months('claim_date', 'anchor')} END AS INTEGER)
  AS month_offset_from_placement FROM kept LEFT JOIN anchors USING (patient_id)""",
    "s_revenue": """SELECT r.*, region,
 CAST(total_recognized_usd AS DOUBLE) * gross_margin_pct / 100 AS margin_calculated_usd,
 coalesce(margin_usd > 0, false) AS is_break_even,
 CAST(quarter(month) AS INTEGER) AS quarter_num, CAST(year(month) AS INTEGER) AS year_num,
 sum(total_recognized_usd) OVER w AS cumulative_usd,
 sum(margin_usd) OVER w AS cumulative_margin_usd,
 lag(total_recognized_usd) OVER w AS previous_total
 FROM revenue r JOIN patients USING (patient_id)
 WINDOW w AS (PARTITION BY patient_id ORDER BY month)""",
    "g_revenue": """SELECT patient_id, month, upfront_recognized_usd, recurring_recognized_usd,
 gross_margin_pct, fulfillment_cost_usd, total_recognized_usd, margin_usd, channel, device_type,
 region, margin_calculated_usd, is_break_even, quarter_num, year_num, cumulative_usd,
 cumulative_margin_usd, {growth} AS "moM_growth_pct" FROM s_revenue""",
    "g_patients": """SELECT p.*, CASE WHEN placed >= DATE '2000-08-01' THEN 'active' ELSE 'lapsed' END
  AS patient_lifecycle_status, placed AS pump_on_body_date, channel_primary,
 coalesce(total_upfront, 0) AS total_upfront_12m,
 coalesce(total_recurring, 0) AS total_consumable_spend_12m
 FROM s_patients p
 LEFT JOIN (SELECT patient_id, max(claim_date) AS placed, max(channel) AS channel_primary
  FROM claims WHERE claim_type = 'pump_on_body' GROUP BY patient_id) USING (patient_id)
 LEFT JOIN (SELECT patient_id,
   sum(CASE WHEN upfront_recognized_usd > 0 THEN upfront_recognized_usd ELSE 0 END) AS total_upfront,
   sum(CASE WHEN recurring_recognized_usd > 0 THEN recurring_recognized_usd ELSE 0 END)
    AS total_recurring
  FROM revenue GROUP BY patient_id) USING (patient_id)""",
    "g_hcp": """SELECT h.*, coalesce(referred, 0) AS patients_referred,
 coalesce(placed, 0) AS active_placements,
 CASE WHEN referred > 0 THEN round(CAST(placed AS DOUBLE) / referred, 3) END
  AS placement_success_rate
 FROM s_hcps h LEFT JOIN (SELECT referring_hcp_id, count(*) AS referred, sum(active) AS placed
  FROM (SELECT referring_hcp_id, patient_id,
   max(CAST(patient_lifecycle_status = 'active' AS INTEGER)) AS active
   FROM g_patients GROUP BY ALL) GROUP BY referring_hcp_id) ON hcp_id = referring_hcp_id""",
    "segment": """SELECT patient_id, CASE channel_primary WHEN 'DME' THEN 'Medicare'
 WHEN 'Pharmacy' THEN 'Commercial' WHEN 'DTC' THEN 'Cash-pay' END AS payer_segment
 FROM g_patients""",
    "grants": """SELECT printf('nation-%02d@example.com', c_nationkey) AS principal_id,
 CASE WHEN c_custkey % 4 = 0 THEN 'group' ELSE 'user' END AS principal_type,
 CASE c_custkey % 3 WHEN 0 THEN 'SCHEMA' WHEN 1 THEN 'TABLE' ELSE 'VIEW' END AS securable_type,
 'main.analytics.t' || c_custkey AS securable_name,
 CASE WHEN c_custkey % 3 = 0 THEN 'USE_SCHEMA' ELSE 'SELECT' END AS privilege,
 CASE WHEN c_acctbal >= 0 THEN TIMESTAMP '2024-01-01 00:00:00'
  + to_minutes(CAST(floor(c_acctbal) AS BIGINT)) END AS expires_at,
 c_custkey % 7 <> 0 AS _active FROM customer""",
    "actions": f"""SELECT action, principal_id, principal_type, securable_type, securable_name,
 privilege, CASE action WHEN 'grant' THEN 'GRANT ' ELSE 'REVOKE ' END || privilege || ' ON '
  || securable_type || ' ' || securable_name || CASE action WHEN 'grant' THEN ' TO ' ELSE ' FROM '
  END || principal_type || ' ''' || principal_id || '''' AS statement,
 CASE action WHEN 'grant' THEN 'Idempotent apply cycle' ELSE 'Access expired' END AS reason
 FROM (SELECT *, CASE WHEN expires_at IS NULL OR expires_at > {NOW} THEN 'grant' ELSE 'revoke' END
  AS action FROM grants WHERE _active)""",
    "visits": """SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events""",
}

GROWTH = """CASE WHEN {p} > 0 THEN CAST(round(CAST(
 CAST({t} - {p} AS DOUBLE) / CAST({p} AS DOUBLE) * 100 AS DECIMAL(38,8)), 2) AS DOUBLE)
 ELSE 0.0::DOUBLE END"""
CTES["g_revenue"] = CTES["g_revenue"].format(
    growth=GROWTH.format(t="total_recognized_usd", p="previous_total")
)


def _draw(key: str, purpose: str) -> str:
    text = f"CAST({key} AS VARCHAR) || ':{purpose}'"
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def _between(key: str, purpose: str, low: int, high: int) -> str:
    return f"CAST({low} + {_draw(key, purpose)} % {high - low + 1} AS INTEGER)"


def _pick(key: str, purpose: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{_draw(key, purpose)} % {len(values)} + 1]"


def _weighted(key: str, purpose: str, weights: dict[str, int]) -> str:
    point, reached, out = f"{_draw(key, purpose)} % {sum(weights.values())}", 0, "CASE"
    names = list(weights)
    for name in names[:-1]:
        reached += weights[name]
        out += f" WHEN {point} < {reached} THEN '{name}'"
    return f"{out} ELSE '{names[-1]}' END"


REGIONS = ["US West", "US South", "US East"]
FIRST = ["Ada", "Ben", "Cleo", "Dan", "Eva", "Finn", "Gwen", "Hugo", "Iris", "Jon"]
LAST = ["Ash", "Birch", "Cedar", "Elm", "Hazel", "Larch", "Maple", "Oak", "Pine", "Rowan"]
ID = "id"
CTES |= {
    "g_ids": "SELECT c_custkey AS id FROM customer",
    "n_hcps": "SELECT count(*) AS n FROM supplier",
    "made_hcps": f"""SELECT {HCP.format('id')} AS hcp_id,
 {_pick(ID, 'hcp-first', FIRST)} || ' ' || {_pick(ID, 'hcp-last', LAST)} AS hcp_name,
 {_pick(ID, 'hcp-facility', ['Lakeside Practice', 'Northgate Hospital',
  'Hillcrest Clinic', 'Riverbend Care', 'Old Mill Surgery',
  'Harbour Medical House'])} AS facility,
 {_pick(ID, 'hcp-specialty', ['Endocrinologist', 'Diabetes Specialist', 'PCP', 'Nurse Educator',
  'PA-NP'])} AS specialty,
 {_weighted(ID, 'hcp-role', {'prescriber': 70, 'influencer': 30})} AS role_type,
 (['US West', 'US South', 'US East'])[(id + {_draw('id // 3', 'region-turn')} % 3) % 3 + 1]
  AS region,
 {_weighted(ID, 'hcp-priority', {'High': 35, 'Medium': 35, 'Low': 30})} AS segment_priority,
 {_weighted(ID, 'hcp-device', {'t:slim X2': 40, 'Mobi': 40, 'Competitor': 20})}
  AS primary_device_referred,
 {_between(ID, 'hcp-nbrx', 5, 50)} AS nbrx_12m,
 {_between(ID, 'hcp-nbrx', 5, 50)} + {_between(ID, 'hcp-repeat', 20, 100)} AS trx_12m
 FROM (SELECT s_suppkey AS id FROM supplier)""",
    "drawn": f"""SELECT id, {PAT.format('id')} AS patient_id,
 {_weighted(ID, 'pat-device', {'Mobi': 60, 't:slim X2': 40})} AS device_type,
 {_pick(ID, 'pat-region', REGIONS)} AS region,
 {_weighted(ID, 'pat-channel', {'DME': 40, 'Pharmacy': 30, 'DTC': 30})} AS channel,
 DATE '2024-01-01' + {_between(ID, 'pat-enrolled', 0, 730)} AS enrolled_date,
 {_draw(ID, 'provider-run')} % greatest(n // 3, 1) AS run,
 {_draw(ID, 'provider-any')} % n AS anyone, n FROM g_ids, n_hcps""",
    "dated": f"""SELECT *, CASE WHEN {_draw(ID, 'intake-forced')} % 100 < 70
  THEN DATE '2026-01-01' + {_between(ID, 'intake-cohort', 0, 89)}
  ELSE enrolled_date + {_between(ID, 'intake-delay', 0, 30)} END AS intake,
 CASE channel WHEN 'DME' THEN {_between(ID, 'cycle-days', 45, 75)}
  WHEN 'Pharmacy' THEN {_between(ID, 'cycle-days', 30, 60)}
  ELSE {_between(ID, 'cycle-days', 15, 45)} END AS days FROM drawn""",
    "placed": """SELECT *, CAST(date_trunc('month', intake + days) AS DATE) AS placed_month,
 CASE device_type WHEN 'Mobi' THEN 4500.0::DOUBLE ELSE 5400.0::DOUBLE END AS price FROM dated""",
    "made_patients": f"""SELECT patient_id, device_type, region,
 {_between(ID, 'pat-ssn-a', 100, 999)} || '-' || {_between(ID, 'pat-ssn-b', 10, 99)} || '-'
  || {_between(ID, 'pat-ssn-c', 1000, 9999)} AS ssn,
 DATE '2024-01-01' - 365 * {_between(ID, 'pat-age', 18, 75)} AS dob,
 {_pick(ID, 'pat-first', FIRST)} || ' ' || {_pick(ID, 'pat-last', LAST)} AS patient_name,
 enrolled_date,
 printf('HCP-%06d', CASE WHEN {_draw(ID, 'provider-affinity')} % 100 < 75 AND n >= 3
  THEN run * 3 + (list_position(['US West', 'US South', 'US East'], region) - 1 + 3
   - {_draw('run', 'region-turn')} % 3) % 3 ELSE anyone END) AS referring_hcp_id FROM drawn""",
    "made_claims": f"""SELECT printf('CLM-%07d', id * 14 + k) AS claim_id, patient_id,
 CAST(CASE k WHEN 0 THEN intake WHEN 1 THEN intake + days
  ELSE placed_month + to_months(CAST(k - 1 AS INTEGER)) END AS DATE) AS claim_date,
 CASE k WHEN 0 THEN 'psa_intake' WHEN 1 THEN 'pump_on_body' ELSE 'consumable_shipment' END
  AS claim_type, channel,
 CASE WHEN k < 2 THEN 'Durables' ELSE 'Consumables' END AS product_line,
 CASE k WHEN 0 THEN 'psa' WHEN 1 THEN device_type ELSE 'infusion_set' END AS product_sku,
 CASE k WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN price
  ELSE CAST(10000 + {_draw('(id * 14 + k)', 'claim-amount')} % 5001 AS DOUBLE) / 100 END
  AS claim_amount_usd, 1 AS units
 FROM placed, generate_series(0, 13) AS s(k)""",
    "made_revenue": f"""SELECT patient_id, month, upfront AS upfront_recognized_usd,
 recurring AS recurring_recognized_usd, pct AS gross_margin_pct, pct AS fulfillment_cost_usd,
 upfront + recurring AS total_recognized_usd, (upfront + recurring) * (pct / 100) AS margin_usd,
 channel, device_type FROM (SELECT *,
  CAST(placed_month + to_months(CAST(k AS INTEGER)) AS DATE) AS month,
  CASE k WHEN 0 THEN price ELSE 0.0::DOUBLE END AS upfront,
  CAST(10000 + {_draw('(id * 12 + k)', 'revenue-amount')} % 5001 AS DOUBLE) / 100 AS recurring,
  CASE channel WHEN 'DME' THEN 40.0::DOUBLE WHEN 'Pharmacy' THEN 45.0::DOUBLE
   ELSE 50.0::DOUBLE END AS pct FROM placed, generate_series(0, 11) AS s(k))""",
}


def with_ctes(body: str) -> str:
    """Prefix the statement with the table expressions it names, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit_named(name)

    def visit_named(name: str) -> None:
        text = CTES[name]
        for other in CTES:
            if other != name and other not in needed and re.search(
                rf"\b(FROM|JOIN|,)\s+{other}\b", text
            ):
                visit_named(other)
        if name not in needed:
            needed.append(name)

    for name in CTES:
        if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", body):
            visit_named(name)
    if not needed:
        return body
    # Several expressions read the same large parts more than once.
    listed = ",\n".join(f"{n} AS MATERIALIZED (\n{CTES[n]})" for n in needed)
    return f"WITH {listed}\n{body}"


def _d(name: str, alias: str | None = None) -> str:
    return f"CAST({name} AS DOUBLE) AS {alias or name}"


REVENUE_MONEY = ", ".join(
    _d(c)
    for c in (
        "upfront_recognized_usd",
        "recurring_recognized_usd",
        "fulfillment_cost_usd",
        "total_recognized_usd",
        "margin_usd",
    )
)
G_REVENUE = f"""SELECT patient_id, month, {REVENUE_MONEY},
 round(gross_margin_pct, 6) AS gross_margin_pct, channel, device_type, region,
 round(margin_calculated_usd, 4) AS margin_calculated_usd, is_break_even, quarter_num, year_num,
 {_d('cumulative_usd')}, {_d('cumulative_margin_usd')}, "moM_growth_pct" """
G_CLAIMS = """SELECT claim_id, patient_id, claim_date, claim_type, channel, product_line, product_sku,
 CAST(claim_amount_usd AS DOUBLE) AS claim_amount_usd, units, device_type, region, quarter_num,
 year_num, days_to_pump_on_body, is_high_value"""
G_PATIENTS = f"""SELECT patient_id, device_type, region, ssn, dob, patient_name, enrolled_date,
 referring_hcp_id, device_category, patient_lifecycle_status, pump_on_body_date, channel_primary,
 {_d('total_upfront_12m')}, {_d('total_consumable_spend_12m')}"""
SILVER_META = f"{BATCH} AS _loaded_at, 'foundation' AS _source"
PLACED = "claim_type = 'pump_on_body'"
PERIOD = "quarter_num = 1 AND year_num = 1998"
CH, DEV = 'channel AS "Channel"', 'device_type AS "Device Type"'
PERIOD_DIMS = 'quarter_num AS "Quarter", year_num AS "Year"'


def _sum(c: str, name: str) -> str:
    return f'CAST(sum({c}) AS DOUBLE) AS "{name}"'


def _avg(c: str, name: str, digits: int = 6) -> str:
    return f'round(avg({c}), {digits}) AS "{name}"'


def _patients(name: str = "Patient Count") -> str:
    return f'count(DISTINCT patient_id) AS "{name}"'


def _ranked(levels: str, value: str, order: list[str]) -> str:
    listed = ", ".join(f"'{o}'" for o in order)
    return f"""SELECT *, rank = list_position([{listed}], channel) AS as_expected FROM (
 SELECT *, CAST(row_number() OVER (ORDER BY {value}, channel) AS INTEGER) AS rank FROM ({levels}))"""


def _cycle_levels(claims: str, who: str) -> str:
    return f"""SELECT channel, round(avg(date_diff('day', a, b)), 2) AS avg_days,
 count(*) AS entities FROM (SELECT patient_id, min(claim_date) FILTER (claim_type = 'psa_intake')
  AS a, min(claim_date) FILTER ({PLACED}) AS b FROM {claims} GROUP BY patient_id)
 JOIN {who} USING (patient_id) WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY channel"""


def _margin_levels(revenue: str) -> str:
    return f"""SELECT channel, round(avg(gross_margin_pct), 2) AS avg_margin, count(*) AS row_count
 FROM {revenue} GROUP BY channel"""


def _grain(name: str, table: str, key: str) -> str:
    return f"""SELECT '{name}' AS table_name, count(*) AS row_count,
 count(DISTINCT {key}) AS unique_keys, count(*) = count(DISTINCT {key}) AS grain_ok FROM {table}"""


MADE_REVENUE = """SELECT patient_id, month, upfront_recognized_usd, recurring_recognized_usd,
 gross_margin_pct, fulfillment_cost_usd, total_recognized_usd,
 round(margin_usd, 6) AS margin_usd, channel, device_type FROM made_revenue"""

BODIES: dict[str, str] = {
    "bronze_patients": f"SELECT *, {_meta(True)} FROM patients",
    "bronze_hcps": f"SELECT *, {_meta(False)} FROM hcps",
    "bronze_claims": f"""SELECT * REPLACE (CAST(claim_amount_usd AS DOUBLE) AS claim_amount_usd),
 {_meta(False)} FROM claims""",
    "bronze_revenue_summary": f"""SELECT patient_id, month, {REVENUE_MONEY},
 round(gross_margin_pct, 6) AS gross_margin_pct, channel, device_type, {_meta(False)}
 FROM revenue""",
    "silver_patients": f"SELECT *, {SILVER_META}, 1.0::DOUBLE AS _quality_score FROM s_patients",
    "silver_hcps": f"""SELECT * REPLACE (round(retention_rate, 6) AS retention_rate), {SILVER_META},
 1.0::DOUBLE AS _quality_score FROM s_hcps""",
    "silver_claims": f"{G_CLAIMS}, {SILVER_META} FROM s_claims",
    "silver_revenue_summary": f"""{G_REVENUE}, {SILVER_META} FROM g_revenue""",
    "gold_patients": f"{G_PATIENTS} FROM g_patients",
    "gold_claims": f"{G_CLAIMS}, month_offset_from_placement FROM g_claims",
    "gold_revenue_summary": f"{G_REVENUE} FROM g_revenue",
    "gold_hcp": "SELECT * REPLACE (round(retention_rate, 6) AS retention_rate) FROM g_hcp",
    "ingest_orders": f"SELECT *, {_meta(False, 'orders')} FROM orders",
    "patient_payer_segment": "SELECT * FROM segment",
    "dedup_lineitem": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
 PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity,
 l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem)
 WHERE rn = 1""",
    "deduped_quantity": """SELECT l_returnflag, count(*) AS n_lines,
 CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity FROM (
  SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
   ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_quantity, l_extendedprice,
   l_discount, l_tax, l_returnflag, l_linestatus) = 1) GROUP BY l_returnflag""",
    "dedup_documents": """SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (
 PARTITION BY text ORDER BY doc_id, lang, source) AS rn FROM documents) WHERE rn = 1""",
    "milestone_cycle_time": """SELECT channel, round(avg(date_diff('day', a, b)), 2) AS avg_days,
 count(*) AS entities FROM (SELECT user_id, min(day) FILTER (event_type = 'signup') AS a,
  min(day) FILTER (event_type = 'purchase') AS b FROM visits GROUP BY user_id)
 LEFT JOIN cust ON user_id = c_custkey WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY channel""",
    "self_pivot_cycle_time": """SELECT visits.*,
 CAST(date_diff('day', a, b) AS INTEGER) AS days_to_purchase FROM visits
 LEFT JOIN (SELECT user_id, min(day) AS a FROM visits WHERE event_type = 'signup' GROUP BY 1) s
  USING (user_id)
 LEFT JOIN (SELECT user_id, min(day) AS b FROM visits WHERE event_type = 'purchase' GROUP BY 1) p
  USING (user_id)""",
    "event_month_offset": f"""SELECT visits.*, CAST(CASE WHEN event_type = 'purchase' THEN 0
 WHEN event_type IN ('click', 'view') THEN {months('day', 'm')} END
 AS INTEGER) AS month_offset FROM visits LEFT JOIN (SELECT user_id, max(day) AS m FROM visits
  WHERE event_type = 'purchase' GROUP BY 1) USING (user_id)""",
    "month_offset_from_placement": f"""SELECT claim_id, patient_id, claim_type, claim_date,
 CAST(CASE WHEN {PLACED} THEN 0 WHEN claim_type = 'consumable_shipment' THEN
 {months('claim_date', 'm')} END AS INTEGER) AS month_offset
 FROM claims LEFT JOIN (SELECT patient_id, last_placement AS m FROM steps) USING (patient_id)""",
    "monthly_revenue": f"""SELECT o_custkey, month, {_d('upfront')}, {_d('recurring')}, {_d('total')},
 {_d('margin')}, CAST(quarter(month) AS INTEGER) AS quarter_num,
 CAST(year(month) AS INTEGER) AS year_num FROM monthly""",
    "running_revenue": f"""SELECT o_custkey, month, {_d('total')}, CAST(sum(total) OVER (
 PARTITION BY o_custkey ORDER BY month) AS DOUBLE) AS running_total FROM monthly""",
    "running_order_value": """SELECT o_orderkey, o_custkey, month, CAST(value AS DOUBLE) AS value,
 CAST(sum(value) OVER (PARTITION BY o_custkey ORDER BY month) AS DOUBLE) AS running_value
 FROM (SELECT o_orderkey, o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
  CAST(o_totalprice AS DECIMAL(18,2)) AS value FROM orders)""",
    "month_growth": f"""SELECT o_custkey, month, {_d('total')},
 {GROWTH.format(t='total', p='previous')} AS growth_pct, {_d('previous', 'previous_total')}
 FROM (SELECT *, lag(total) OVER (PARTITION BY o_custkey ORDER BY month) AS previous
  FROM monthly)""",
    "fanout_check": """SELECT rows_before, rows_after,
 round(CAST(rows_after AS DOUBLE) / rows_before, 4) AS fanout FROM (
 SELECT (SELECT count(*) FROM customer) AS rows_before, (SELECT count(*) FROM customer
  LEFT JOIN orders ON o_custkey = c_custkey
  LEFT JOIN (SELECT DISTINCT o_custkey AS k, date_trunc('month', o_orderdate) AS m FROM orders)
   ON k = c_custkey) AS rows_after)""",
    "provider_retention": """SELECT hcp_id, nbrx_12m, trx_12m,
 round(retention_rate, 6) AS retention_rate FROM s_hcps""",
    "provider_referral_rollup": """WITH served AS (
  SELECT l_suppkey, count(*) AS referred, sum(good) AS placed FROM (
   SELECT l_suppkey, c_custkey, max(CAST(c_acctbal > 0 AS INTEGER)) AS good
   FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
   GROUP BY ALL) GROUP BY l_suppkey)
 SELECT s_suppkey, s_name, coalesce(referred, 0) AS patients_referred,
 coalesce(placed, 0) AS active_placements,
 CASE WHEN referred > 0 THEN round(CAST(placed AS DOUBLE) / referred, 3) END
  AS placement_success_rate
 FROM supplier LEFT JOIN served ON s_suppkey = l_suppkey""",
    "mv_revenue_by_channel": f"""SELECT {CH}, {DEV}, {PERIOD_DIMS}, {_patients()},
 {_sum('upfront_recognized_usd', 'Total Upfront USD')},
 {_sum('recurring_recognized_usd', 'Total Recurring USD')},
 {_sum('total_recognized_usd', 'Total Revenue USD')}, {_sum('margin_usd', 'Total Margin USD')},
 {_avg('gross_margin_pct', 'Avg Margin Pct')} FROM g_revenue WHERE is_break_even
 GROUP BY channel, device_type, quarter_num, year_num""",
    "mv_fulfillment_rate": f"""SELECT {CH}, {DEV}, claim_type AS "Claim Type", region AS "Region",
 {PERIOD_DIMS}, {_avg('days_to_pump_on_body', 'Avg Cycle Time Days')}, {_patients()},
 count(*) AS "Claim Count" FROM g_claims
 GROUP BY channel, device_type, claim_type, region, quarter_num, year_num""",
    "mv_recognized_revenue": f"""SELECT month AS "Month", {CH}, {DEV}, region AS "Region",
 {PERIOD_DIMS}, is_break_even AS "Is Break Even",
 {_sum('upfront_recognized_usd', 'Upfront USD')},
 {_sum('recurring_recognized_usd', 'Recurring USD')},
 {_sum('total_recognized_usd', 'Total Revenue USD')}, {_sum('margin_usd', 'Margin USD')},
 {_avg('gross_margin_pct', 'Avg Margin Pct')} FROM g_revenue
 GROUP BY month, channel, device_type, region, quarter_num, year_num, is_break_even""",
    "mv_recurring_revenue": f"""SELECT r.{CH}, r.{DEV},
 patient_lifecycle_status AS "Lifecycle Status",
 count(DISTINCT r.patient_id) AS "Patient Cohort Size",
 {_sum('recurring_recognized_usd', 'Total Consumable Revenue 12m')},
 {_avg('recurring_recognized_usd', 'Avg Monthly Consumable USD')},
 {_avg('gross_margin_pct', 'Avg Margin Pct')} FROM g_revenue r
 LEFT JOIN g_patients p ON r.patient_id = p.patient_id WHERE recurring_recognized_usd > 0
 GROUP BY r.channel, r.device_type, patient_lifecycle_status""",
    "mv_gross_margin": f"""SELECT {CH}, {DEV}, region AS "Region", {PERIOD_DIMS}, {_patients()},
 {_sum('total_recognized_usd', 'Revenue USD')}, {_sum('margin_usd', 'Margin USD')},
 {_sum('fulfillment_cost_usd', 'Fulfillment Cost USD')},
 {_avg('gross_margin_pct', 'Gross Margin Pct')},
 round(CAST(sum(margin_usd) AS DOUBLE) / CAST(sum(total_recognized_usd) AS DOUBLE) * 100, 6)
  AS "Blended Margin Pct" FROM g_revenue WHERE is_break_even
 GROUP BY channel, device_type, region, quarter_num, year_num""",
    "mv_hcp_referral_performance": f"""SELECT specialty AS "Specialty", role_type AS "Role Type",
 region AS "Region", segment_priority AS "Segment Priority",
 primary_device_referred AS "Primary Device Referred", count(DISTINCT hcp_id) AS "HCP Count",
 CAST(sum(patients_referred) AS BIGINT) AS "Patients Referred",
 CAST(sum(active_placements) AS BIGINT) AS "Active Placements",
 {_avg('placement_success_rate', 'Avg Placement Success Rate')},
 {_avg('retention_rate', 'Avg Retention Rate')},
 CAST(sum(nbrx_12m) AS BIGINT) AS "Total NBRx 12m", CAST(sum(trx_12m) AS BIGINT) AS "Total TRx 12m"
 FROM g_hcp GROUP BY specialty, role_type, region, segment_priority, primary_device_referred""",
    "mv_payer_segment_revenue": f"""SELECT payer_segment AS "Payer Segment", {_patients()},
 {_sum('total_recognized_usd', 'Total Revenue USD')}, {_avg('gross_margin_pct', 'Avg Margin Pct')}
 FROM g_revenue LEFT JOIN segment USING (patient_id) GROUP BY payer_segment""",
    "rollup_by_channel_year": f"""SELECT {CH}, year_num AS "Year", {_patients()},
 {_sum('total_recognized_usd', 'Total Revenue USD')}, {_sum('margin_usd', 'Total Margin USD')},
 round(avg(gross_margin_pct), 6) AS "Avg Margin Pct", true AS estimate_within_bound
 FROM g_revenue WHERE is_break_even GROUP BY ALL""",
    "rollup_by_device_in_quarter": f"""SELECT {DEV}, {_patients()},
 {_sum('recurring_recognized_usd', 'Total Recurring USD')}, true AS estimate_within_bound
 FROM g_revenue WHERE is_break_even AND quarter_num IN (1, 2) AND channel = 'DTC' GROUP BY ALL""",
    "event_users_by_type": """SELECT event_type, count(DISTINCT user_id) AS users,
 true AS estimate_within_bound FROM events GROUP BY event_type""",
    "recognized_revenue_by_patient": f"""SELECT patient_id AS "Patient Id", year_num AS "Year",
 {_sum('total_recognized_usd', 'Total Revenue USD')}, {_sum('margin_usd', 'Margin USD')}
 FROM g_revenue WHERE year_num >= 1997 AND is_break_even GROUP BY patient_id, year_num""",
    "revenue_total": f"""SELECT {_patients()}, {_sum('total_recognized_usd', 'Total Revenue USD')}
 FROM g_revenue WHERE is_break_even""",
    "payer_segment_on_surface": f"""SELECT payer_segment AS "Payer Segment", {_patients()},
 {_sum('total_recognized_usd', 'Total Revenue USD')}, true AS _uncertified
 FROM g_revenue LEFT JOIN segment USING (patient_id) GROUP BY payer_segment""",
    "join_key_check": """SELECT 'patient' AS "join", count(*) AS keys,
 count(*) FILTER (n > 1) AS duplicate_keys
 FROM (SELECT patient_id, count(*) AS n FROM g_patients GROUP BY patient_id)""",
    "cycle_time_verify": f"""SELECT {CH}, {DEV}, round(avg(days_to_pump_on_body)) AS avg_cycle_days,
 count(DISTINCT patient_id) AS patient_count FROM g_claims WHERE {PLACED} AND {PERIOD}
 GROUP BY channel, device_type""",
    "margin_by_channel": f"""SELECT {CH}, round(avg(gross_margin_pct), 1) AS gross_margin_pct
 FROM g_revenue WHERE is_break_even GROUP BY channel""",
    "payer_segment_margin": """SELECT payer_segment AS "Payer Segment",
 count(DISTINCT patient_id) AS patients,
 CAST(round(sum(total_recognized_usd)) AS DOUBLE) AS revenue_usd,
 round(avg(gross_margin_pct), 1) AS avg_gross_margin_pct
 FROM g_revenue LEFT JOIN segment USING (patient_id) GROUP BY payer_segment""",
    "cycle_time_unfiltered": f"""SELECT {CH}, {DEV},
 {_avg('days_to_pump_on_body', 'Avg Cycle Time Days')} FROM g_claims WHERE {PERIOD}
 GROUP BY channel, device_type""",
    "fastest_channel_device": f"""SELECT {CH}, {DEV},
 {_avg('days_to_pump_on_body', 'Avg Cycle Time Days')} FROM g_claims WHERE {PERIOD}
 GROUP BY channel, device_type ORDER BY avg(days_to_pump_on_body), channel, device_type LIMIT 1""",
    "margin_all_quarters": f"""SELECT {CH}, {_avg('gross_margin_pct', 'Gross Margin Pct')}
 FROM g_revenue WHERE is_break_even GROUP BY channel""",
    "margin_latest_quarter": f"""SELECT {CH}, year_num AS "Year", quarter_num AS "Quarter",
 {_avg('gross_margin_pct', 'Gross Margin Pct')} FROM g_revenue WHERE is_break_even
 AND year_num * 10 + quarter_num = (SELECT max(year_num * 10 + quarter_num) FROM g_revenue
  WHERE is_break_even) GROUP BY channel, year_num, quarter_num""",
    "revenue_by_channel_device": f"""SELECT {CH}, {DEV},
 {_sum('total_recognized_usd', 'Total Revenue USD')} FROM g_revenue
 WHERE is_break_even AND {PERIOD} GROUP BY channel, device_type""",
    "recurring_by_channel": f"""SELECT {CH},
 {_sum('recurring_recognized_usd', 'Total Consumable Revenue 12m')} FROM g_revenue
 WHERE recurring_recognized_usd > 0 GROUP BY channel""",
    "upfront_vs_recurring": f"""SELECT {CH}, {_sum('upfront_recognized_usd', 'Total Upfront USD')},
 {_sum('recurring_recognized_usd', 'Total Recurring USD')} FROM g_revenue
 WHERE is_break_even AND {PERIOD} GROUP BY channel""",
    "avg_recurring_by_device": f"""SELECT {DEV},
 {_avg('recurring_recognized_usd', 'Avg Monthly Consumable USD')} FROM g_revenue
 WHERE recurring_recognized_usd > 0 GROUP BY device_type""",
    "margin_by_region_device": f"""SELECT region AS "Region", {DEV}, {_sum('margin_usd', 'Margin USD')},
 {_avg('gross_margin_pct', 'Gross Margin Pct')} FROM g_revenue WHERE is_break_even
 GROUP BY region, device_type""",
    "patients_by_channel": f"""SELECT {CH}, {_patients()} FROM g_claims WHERE {PERIOD}
 GROUP BY channel""",
    "patients_placed_by_channel": f"""SELECT {CH}, {_patients()} FROM g_claims
 WHERE {PLACED} AND {PERIOD} GROUP BY channel""",
    "cost_by_channel_quarter": f"""SELECT {CH}, quarter_num AS "Quarter",
 {_sum('fulfillment_cost_usd', 'Fulfillment Cost USD')} FROM g_revenue
 WHERE is_break_even AND year_num = 1998 GROUP BY channel, quarter_num""",
    "ratio_vs_avg_margin": f"""SELECT region AS "Region", {DEV},
 {_avg('gross_margin_pct', 'Gross Margin Pct')},
 round(CAST(sum(margin_usd) AS DOUBLE) / CAST(sum(total_recognized_usd) AS DOUBLE) * 100, 6)
  AS "Blended Margin Pct" FROM g_revenue WHERE is_break_even GROUP BY region, device_type""",
    "segment_speed_and_margin": f"""SELECT "Payer Segment", round(days, 6) AS avg_cycle_days,
 round(pct, 6) AS avg_margin_pct, row_number() OVER (ORDER BY days, "Payer Segment") = 1
  AS is_fastest, row_number() OVER (ORDER BY pct DESC, "Payer Segment") = 1 AS is_best_margin
 FROM (SELECT payer_segment AS "Payer Segment", avg(days_to_pump_on_body) AS days FROM g_claims
  JOIN segment USING (patient_id) WHERE {PLACED} GROUP BY 1)
 JOIN (SELECT payer_segment AS "Payer Segment", avg(gross_margin_pct) AS pct FROM g_revenue
  LEFT JOIN segment USING (patient_id) GROUP BY 1) USING ("Payer Segment")""",
    "whatif_shift": """SELECT round(0.15::DOUBLE * out_rev, 2) AS moved_revenue,
 round(mar / rev * 100, 4) AS margin_pct_before, round(after / rev * 100, 4) AS margin_pct_after,
 round(after - mar, 2) AS margin_change FROM (
 SELECT *, sum_after + 0.15::DOUBLE * out_rev * dtc_rate AS after FROM (SELECT
  CAST(sum(total_recognized_usd) AS DOUBLE) AS rev, CAST(sum(margin_usd) AS DOUBLE) AS mar,
  CAST(sum(total_recognized_usd) FILTER (moving) AS DOUBLE) AS out_rev,
  CAST(sum(margin_usd) AS DOUBLE) - 0.15::DOUBLE * CAST(sum(margin_usd) FILTER (moving) AS DOUBLE)
   AS sum_after,
  CAST(sum(margin_usd) FILTER (channel = 'DTC') AS DOUBLE)
   / CAST(sum(total_recognized_usd) FILTER (channel = 'DTC') AS DOUBLE) AS dtc_rate
  FROM (SELECT *, channel = 'DME' AND device_type = 'Mobi' AND quarter_num IN (2, 3) AS moving
   FROM g_revenue)))""",
    "cycle_time_by_start_quarter": """SELECT channel, device_type,
 round(avg(date_diff('day', first_intake, first_placement)), 2) AS avg_days, count(*) AS entities
 FROM steps JOIN cust USING (patient_id) WHERE first_placement IS NOT NULL
 AND quarter(first_intake) = 1 AND year(first_intake) = 1998 GROUP BY channel, device_type""",
    "mask_last4": """SELECT c_custkey, '***-**-' || right(c_name, 4) AS masked,
 '***-**-' || right(CAST(c_custkey AS VARCHAR), 4) AS masked_short,
 CASE WHEN c_custkey > 9999 THEN '***-**-' || right(CAST(c_custkey AS VARCHAR), 4)
  ELSE '***-**-****' END AS masked_strict FROM customer""",
    "mask_year": """SELECT o_orderkey, CAST(date_trunc('year', o_orderdate) AS DATE) AS masked
 FROM orders""",
    "mask_redact": "SELECT c_custkey, '[Redacted]' AS masked FROM customer",
    "tokenize_key": """SELECT sha256(CAST(c_custkey AS VARCHAR)) AS token,
 sha256('pepper' || c_name) AS salted_token FROM customer""",
    "surface_without_excluded": f"""SELECT month AS "Month", {CH}, {DEV}, region AS "Region",
 {PERIOD_DIMS}, is_break_even AS "Is Break Even",
 {_sum('total_recognized_usd', 'Total Revenue USD')} FROM g_revenue
 GROUP BY month, channel, device_type, region, quarter_num, year_num, is_break_even""",
    "sandbox_segments_masked": "SELECT * REPLACE (sha256(patient_id) AS patient_id) FROM segment",
    "row_totals": """SELECT *, row_count = expected AS as_expected FROM (
 SELECT 'gold_patients' AS table_name, (SELECT count(*) FROM g_patients) AS row_count,
  (SELECT count(*) FROM customer) AS expected
 UNION ALL SELECT 'gold_hcp', (SELECT count(*) FROM supplier), (SELECT count(*) FROM supplier))""",
    "ordered_by_ordinal": f"""SELECT {CH}, {DEV}, {_sum('total_recognized_usd', 'Total Revenue USD')},
 {_patients()} FROM g_revenue WHERE is_break_even GROUP BY channel, device_type
 ORDER BY 3 DESC, 1, 2 LIMIT 4""",
    "masks_of_missing": """SELECT c_custkey, '***-**-' || right(n, 4) AS last4,
 CASE WHEN length(n) > 4 THEN '***-**-' || right(n, 4) WHEN n IS NOT NULL THEN '***-**-****' END AS strict,
 CASE WHEN n IS NOT NULL THEN '[Redacted]' END AS redacted
 FROM (SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN left(c_name, c_custkey % 7) END AS n
 FROM customer)""",
    "sql_function_masks": """SELECT c_custkey, '***-**-' || right(c_name, 4) AS last4,
 CASE WHEN c_name IS NOT NULL THEN '[Redacted]' END AS redacted, sha256(c_name) AS token,
 c_custkey % 3 = 0 AS in_region,
 CAST(date_trunc('year', DATE '1990-06-15' + CAST(c_custkey % 1000 AS INTEGER)) AS DATE)
  AS year_start FROM (SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS c_name
 FROM customer)""",
    "region_rows": "SELECT patient_id, region FROM patients WHERE region IN ('AMERICA', 'ASIA')",
    "secure_patients_analyst": f"""SELECT * REPLACE (sha256(patient_id) AS patient_id,
 '***-**-' || right(ssn, 4) AS ssn, CAST(date_trunc('year', dob) AS DATE) AS dob,
 '[Redacted]' AS patient_name) FROM ({G_PATIENTS} FROM g_patients) WHERE region = 'AMERICA'""",
    "secure_patients_steward": f"{G_PATIENTS} FROM g_patients",
    "secure_revenue_analyst": f"""SELECT sha256(patient_id) AS patient_id, month,
 {_d('total_recognized_usd')}, region FROM g_revenue""",
    "blocked_rows": """SELECT count(*) AS total_rows,
 count(*) FILTER (region = 'AMERICA') AS visible_rows,
 count(*) FILTER (region <> 'AMERICA') AS blocked_rows FROM g_patients""",
    "token_join": f"""SELECT device_category, count(*) AS row_count,
 count(DISTINCT patient_id) AS patients, {_sum('total_recognized_usd', 'revenue_usd')}
 FROM s_patients JOIN revenue USING (patient_id) WHERE region = 'AMERICA'
 GROUP BY device_category""",
    "entitled_patients": """SELECT patient_id, region, device_type FROM patients
 WHERE region IN (SELECT region FROM hcps WHERE hcp_id = 'HCP-000001')""",
    "active_grants": f"""SELECT principal_id, count(*) AS grant_count FROM grants
 WHERE _active AND (expires_at IS NULL OR expires_at > {NOW}) GROUP BY principal_id""",
    "grant_counts": f"""SELECT count(*) FILTER (_active) AS active_rows,
 count(*) FILTER (NOT _active) AS inactive_rows,
 count(*) FILTER (_active AND (expires_at IS NULL OR expires_at > {NOW})) AS valid_rows,
 count(*) FILTER (_active AND expires_at <= {NOW}) AS to_revoke_rows FROM grants""",
    "grant_actions": "SELECT * FROM actions",
    "expired_sweep": f"""SELECT * REPLACE (_active AND (expires_at IS NULL OR expires_at > {NOW})
 AS _active) FROM grants""",
    "audit_append": f"""SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (
 ORDER BY md5(concat_ws('|', CAST(action_time AS VARCHAR), action, principal_id, principal_type,
 securable_type, securable_name, privilege, reason, executed_by))) AS audit_id, * FROM (
 SELECT {NOW} AS action_time, action, principal_id, principal_type, securable_type,
 securable_name, privilege, reason, 'apply_access_control_job' AS executed_by FROM actions)""",
    "reconcile_cycles": f"""SELECT row_number() OVER (ORDER BY _run, md5(concat_ws('|',
 CAST(action_time AS VARCHAR), action, principal_id, principal_type, securable_type,
 securable_name, privilege, reason, executed_by))) AS audit_id, * FROM (
 SELECT {NOW} AS action_time, action, principal_id, principal_type, securable_type,
  securable_name, privilege, reason, 'apply_access_control_job' AS executed_by, 'first' AS _run
 FROM actions UNION ALL
 SELECT {LATER} AS action_time, 'revoke', principal_id, principal_type, securable_type,
  securable_name, privilege, 'Access expired', 'apply_access_control_job', 'second'
 FROM grants WHERE _active AND expires_at > {NOW} AND expires_at <= {LATER})""",
    "audit_hourly": """SELECT date_trunc('hour', ts) AS action_hour, event_type AS action,
 count(*) AS actions FROM events
 WHERE ts >= TIMESTAMP '2024-01-20 12:30:00' - INTERVAL 1 DAY GROUP BY 1, 2""",
    "grain_check": " UNION ALL ".join(
        [
            _grain("patients", "patients", "patient_id"),
            _grain("hcps", "hcps", "hcp_id"),
            _grain("claims", "claims", "claim_id"),
        ]
    ),
    "composite_grain": _grain("revenue_summary", "revenue", "(patient_id, month)"),
    "fk_completeness": """SELECT 'referring_hcp_id' AS column_name, count(*) AS row_count,
 count(referring_hcp_id) AS present, count(*) = count(referring_hcp_id) AS complete FROM patients
 UNION ALL SELECT 'enrolled_date', count(*), count(enrolled_date),
 count(*) = count(enrolled_date) FROM patients""",
    "hcp_distribution": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS row_count FROM hcps GROUP BY 2"
        for c in ("segment_priority", "specialty", "role_type")
    ),
    "priority_distribution": """SELECT o_orderpriority, count(*) AS row_count FROM orders
 GROUP BY o_orderpriority""",
    "cycle_time_check": _ranked(
        _cycle_levels("claims", "cust"), "avg_days", ["DTC", "Pharmacy", "DME"]
    ),
    "margin_check": _ranked(
        _margin_levels("revenue"), "avg_margin", ["DME", "Pharmacy", "DTC"]
    ),
    "seed_hcps": "SELECT * FROM made_hcps",
    "seed_patients": "SELECT * FROM made_patients",
    "seed_claims": "SELECT * FROM made_claims",
    "seed_revenue": MADE_REVENUE,
    "seed_revenue_from_claims": MADE_REVENUE,
    "seed_cycle_time": _ranked(
        _cycle_levels(
            "made_claims",
            "(SELECT patient_id, channel FROM made_claims WHERE claim_type = 'psa_intake')",
        ),
        "avg_days",
        ["DTC", "Pharmacy", "DME"],
    ),
    "seed_margin": _ranked(
        _margin_levels("made_revenue"), "avg_margin", ["DME", "Pharmacy", "DTC"]
    ),
}


def oracles() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in BODIES.items()}
