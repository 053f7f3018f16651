"""DuckDB SQL with the same result as each registered query.

Written apart from the Spark code, over the driver's tables: windows instead
of joins for copies, one global ``row_number`` for keys, ``NOT EXISTS`` style
anti joins for references.
"""

from __future__ import annotations

AS_OF = "DATE '2026-07-01'"

# --- the three extracts ----------------------------------------------------

MEMBERS = """
raw_members AS (
  SELECT CASE WHEN k % 401 = 7 THEN 'MBX' ELSE 'MBR' END
           || CASE WHEN k < 1000000 THEN lpad(k::VARCHAR, 6, '0') ELSE k::VARCHAR END AS member_id,
         c_name AS first_name,
         seg AS last_name,
         CASE WHEN k % 61 <> 9 THEN (DATE '1945-01-01' + (k * 37 % 22279)::INT)::DATE::VARCHAR END AS date_of_birth,
         CASE WHEN k % 67 = 0 THEN NULL ELSE 'County ' || c_nationkey END AS county,
         CASE WHEN k % 20 = 3 THEN lower(seg) ELSE upper(seg[1]) || lower(seg[2:]) END AS plan_type,
         (DATE '2018-01-01' + (k * 11 % 2738)::INT)::DATE::VARCHAR AS enrolment_date,
         CASE WHEN k % 53 = 2 THEN 0.0::DOUBLE WHEN k % 71 <> 4 THEN ((4500 + k * 7919 % 27500) * 150)::DOUBLE / 100
           END AS monthly_premium_eur,
         k * 2 + copy_no AS _ord
  FROM (SELECT c_custkey AS k, c_mktsegment AS seg, c_name, c_nationkey, 0 AS copy_no FROM customer
        UNION ALL
        SELECT c_custkey, c_mktsegment, c_name, c_nationkey, 1 FROM customer WHERE c_custkey % 50 = 0
        UNION ALL
        SELECT c_custkey, c_mktsegment, c_name, c_nationkey, 0 FROM customer
        WHERE c_custkey % 59 = 1 AND c_custkey % 50 <> 0)
)"""

PROVIDERS = """
raw_providers AS (
  SELECT 'PRV' || CASE WHEN k < 10000 THEN lpad(k::VARCHAR, 4, '0') ELSE k::VARCHAR END AS provider_id,
         s_name AS provider_name,
         CASE WHEN k % 33 = 0 THEN NULL ELSE 'SPEC_' || (k % 10) END AS specialty,
         'County ' || s_nationkey AS county,
         CASE WHEN k % 7 IN (1, 4) AND k % 10 <> 9 THEN 'OUT_OF_NETWORK' ELSE 'IN_NETWORK' END AS network_status,
         k * 2 + copy_no AS _ord
  FROM (SELECT s_suppkey AS k, s_name, s_nationkey, 0 AS copy_no FROM supplier
        UNION ALL
        SELECT s_suppkey, s_name, s_nationkey, 1 FROM supplier WHERE s_suppkey % 40 = 1
        UNION ALL
        SELECT s_suppkey, s_name, s_nationkey, 0 FROM supplier WHERE s_suppkey % 37 = 2 AND s_suppkey % 40 <> 1)
)"""

CLAIMS = """
mixed AS (
  SELECT l_orderkey AS o, l_linenumber AS n, l_partkey AS p, l_suppkey AS s,
         l_extendedprice AS price, l_quantity::BIGINT AS qty,
         round(l_extendedprice * 100)::BIGINT AS cents,
         l_orderkey * 31 + l_linenumber * 1009 + l_partkey * 17 + l_suppkey * 7 AS mix,
         mix % 912 + CASE WHEN mix % 109 = 17 THEN 1000 ELSE 0 END AS day_nr,
         (l_orderkey * 31 + l_linenumber * 7) % (SELECT max(c_custkey) + 1 FROM customer) AS cust
  FROM lineitem
),
raw_claims AS (
  SELECT CASE WHEN mix % 1201 <> 8 THEN 'CLM' || o || '-' || n || '-' || p || '-' || s END AS claim_id,
         CASE WHEN mix % 167 = 5 THEN 'MBR-NONE' WHEN mix % 223 = 6 THEN NULL
              WHEN cust < 1000000 THEN 'MBR' || lpad(cust::VARCHAR, 6, '0')
              ELSE 'MBR' || cust END AS member_id,
         'PRV' || CASE WHEN s < 10000 THEN lpad(s::VARCHAR, 4, '0') ELSE s::VARCHAR END AS provider_id,
         CASE WHEN mix % 1999 = 3 THEN 'PRC9999'
              ELSE 'PRC' || lpad((p % 120 + 1)::VARCHAR, 4, '0') END AS procedure_code,
         CASE WHEN mix % 227 <> 7 THEN (DATE '2024-01-01' + day_nr::INT)::DATE::VARCHAR END AS service_date,
         CASE WHEN mix % 229 <> 8
              THEN (DATE '2024-01-01' + (day_nr + CASE WHEN mix % 333 = 9 THEN -10 ELSE qty % 46 END)::INT)
                ::DATE::VARCHAR END AS submitted_date,
         CASE WHEN mix % 250 = 11 THEN -price WHEN mix % 233 <> 9 THEN price END AS billed_amount_eur,
         CASE WHEN mix % 239 = 10 THEN NULL
              WHEN mix % 50 < 34 AND cust % 17 <> 5
              THEN (cents * (100 - mix % 51) // 100 * 100)::DOUBLE / 10000 ELSE 0.0::DOUBLE
              END AS approved_amount_eur,
         CASE WHEN mix % 500 = 13 THEN 'APRVD' WHEN mix % 211 = 5 THEN NULL
              WHEN cust % 17 = 5 AND mix % 50 < 34 THEN 'REJECTED'
              ELSE CASE WHEN mix % 50 < 34 THEN 'APPROVED' WHEN mix % 50 < 41 THEN 'REJECTED'
                        WHEN mix % 50 < 46 THEN 'PENDING' ELSE 'UNDER_REVIEW' END
              END AS claim_status,
         (cents * 64 + qty) * 2 + copy_no AS _ord
  FROM (SELECT *, 0 AS copy_no FROM mixed UNION ALL SELECT *, 1 FROM mixed WHERE mix % 100 = 7
        UNION ALL SELECT *, 0 FROM mixed WHERE mix % 103 = 9 AND mix % 100 <> 7)
)"""

# --- rules: one boolean per rule, in config order --------------------------

MEMBER_FLAGS = """
member_flags AS (
  SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY _ord) > 1 AS f0,
         county IS NULL AS f1,
         NOT coalesce(regexp_matches(member_id, '^MBR[0-9]{6,}$'), false) AS f2
  FROM raw_members
),
ok_members AS (SELECT * FROM member_flags WHERE NOT (f0 OR f1 OR f2))"""

PROVIDER_FLAGS = """
provider_flags AS (
  SELECT *, row_number() OVER (PARTITION BY provider_id ORDER BY _ord) > 1 AS f0,
         specialty IS NULL AS f1
  FROM raw_providers
),
ok_providers AS (SELECT * FROM provider_flags WHERE NOT (f0 OR f1))"""

CLAIM_FLAGS = """
claim_flags AS (
  SELECT c.*, row_number() OVER (PARTITION BY claim_id ORDER BY _ord) > 1 AS f0,
         coalesce(billed_amount_eur < 0, false) AS f1,
         coalesce(claim_status NOT IN ('APPROVED', 'REJECTED', 'PENDING', 'UNDER_REVIEW'), true) AS f2,
         coalesce(try_cast(service_date AS TIMESTAMP) > try_cast(submitted_date AS TIMESTAMP), false) AS f3,
         NOT EXISTS (SELECT 1 FROM ok_members m WHERE m.member_id = c.member_id) AS f4,
         NOT EXISTS (SELECT 1 FROM ok_providers p WHERE p.provider_id = c.provider_id) AS f5
  FROM raw_claims c
),
ok_claims AS (SELECT * FROM claim_flags WHERE NOT (f0 OR f1 OR f2 OR f3 OR f4 OR f5))"""

# --- silver and gold --------------------------------------------------------

SILVER = """
silver_members AS (
  SELECT member_id, first_name, last_name, date_of_birth::TIMESTAMP AS date_of_birth, county,
         upper(plan_type[1]) || lower(plan_type[2:]) AS plan_type,
         enrolment_date::TIMESTAMP AS enrolment_date, monthly_premium_eur
  FROM ok_members
),
silver_claims AS (
  SELECT claim_id, member_id, provider_id, procedure_code, service_date::TIMESTAMP AS service_date,
         submitted_date::TIMESTAMP AS submitted_date, billed_amount_eur, approved_amount_eur, claim_status
  FROM ok_claims
)"""

GOLD = f"""
members_by_id AS (
  SELECT *, year({AS_OF}) - year(date_of_birth) AS years, row_number() OVER (ORDER BY member_id) AS rn
  FROM silver_members
),
g_member AS (
  SELECT rn::BIGINT AS member_key, member_id, first_name, last_name, date_of_birth,
         years::BIGINT AS age,
         -- fixed values: the age bands
         CASE WHEN years < 30 THEN '18-29' WHEN years < 45 THEN '30-44' WHEN years < 60 THEN '45-59'
              ELSE '60+' END AS age_band,
         county, plan_type, enrolment_date, monthly_premium_eur
  FROM members_by_id
),
g_provider AS (
  SELECT row_number() OVER (ORDER BY provider_id) AS provider_key, provider_id, provider_name,
         specialty, county, network_status
  FROM ok_providers
),
g_fact AS (
  SELECT c.claim_id, m.member_key, p.provider_key,
         (year(service_date) * 10000 + month(service_date) * 100 + day(service_date))::INT AS service_date_key,
         (year(submitted_date) * 10000 + month(submitted_date) * 100 + day(submitted_date))::INT
           AS submitted_date_key,
         c.procedure_code, c.claim_status, c.billed_amount_eur, c.approved_amount_eur,
         c.billed_amount_eur - c.approved_amount_eur AS disallowed_amount_eur,
         (submitted_date::DATE - service_date::DATE)::BIGINT AS submission_lag_days
  FROM silver_claims c, g_member m, g_provider p
  WHERE m.member_id = c.member_id AND p.provider_id = c.provider_id
)"""

MONTHLY = """
by_month AS (
  SELECT (service_date_key // 10000) || '-' || lpad((service_date_key // 100 % 100)::VARCHAR, 2, '0') AS month,
         count(*) AS n,
         sum(billed_amount_eur::DECIMAL(18,4))::DOUBLE AS billed,
         sum(approved_amount_eur::DECIMAL(18,4))::DOUBLE AS approved,
         sum(CASE WHEN claim_status = 'APPROVED' THEN 1 ELSE 0 END)::DOUBLE AS yes,
         sum(submission_lag_days)::DOUBLE AS lag_days, count(submission_lag_days) AS lags,
         sum(CASE WHEN submission_lag_days > 30 THEN 1 ELSE 0 END)::DOUBLE AS late
  FROM g_fact WHERE service_date_key BETWEEN 20240101 AND 20261231 GROUP BY 1
),
g_monthly AS (
  SELECT month, n AS total_claims, round(billed, 2) AS total_billed_eur,
         round(approved, 2) AS total_approved_eur, round(100 * yes / n, 2) AS approval_rate_pct,
         round(lag_days / lags, 1) AS avg_submission_lag_days,
         round(CASE WHEN billed <> 0 THEN 100 * approved / billed END, 2) AS payout_ratio_pct
  FROM by_month
)"""

COSTS = """
g_costs AS (
  SELECT specialty, network_status, count(*) AS claim_count,
         round(sum(approved_amount_eur::DECIMAL(18,4))::DOUBLE, 2) AS total_approved_eur,
         round(sum(approved_amount_eur::DECIMAL(18,4))::DOUBLE / count(approved_amount_eur), 2)
           AS avg_claim_cost_eur
  FROM g_fact JOIN g_provider USING (provider_key)
  WHERE claim_status = 'APPROVED' GROUP BY ALL
)"""

USE = """
g_use AS (
  SELECT m.member_key, m.plan_type, m.age_band, m.county,
         coalesce(a.n, 0)::BIGINT AS claims_count,
         round(coalesce(a.spend, 0.0::DOUBLE), 2) AS total_claimed_eur,
         round(m.monthly_premium_eur * 12, 2) AS annualised_premium_eur,
         round(CASE WHEN m.monthly_premium_eur <> 0
               THEN coalesce(a.spend, 0.0::DOUBLE) / (m.monthly_premium_eur * 12) END, 2) AS utilisation_ratio
  FROM g_member m LEFT JOIN (
    SELECT member_key, count(claim_id) AS n, sum(approved_amount_eur::DECIMAL(18,4))::DOUBLE AS spend
    FROM g_fact WHERE claim_status = 'APPROVED' GROUP BY member_key) a ON a.member_key = m.member_key
)"""

RULES = [MEMBERS, PROVIDERS, CLAIMS, MEMBER_FLAGS, PROVIDER_FLAGS, CLAIM_FLAGS]
STAR = [*RULES, SILVER, GOLD]

MEMBER_COLUMNS = (
    "member_id, first_name, last_name, date_of_birth, county, plan_type, enrolment_date, monthly_premium_eur"
)
PROVIDER_COLUMNS = "provider_id, provider_name, specialty, county, network_status"
CLAIM_COLUMNS = (
    "claim_id, member_id, provider_id, procedure_code, service_date, submitted_date, "
    "billed_amount_eur, approved_amount_eur, claim_status"
)

#: Per dataset: flag table, key, and (type, label, description) of each rule.
CHECKED = {
    "members": (
        "member_flags",
        "member_id",
        [
            ("unique", "member_id", "One row per member"),
            ("not_null", "county", "Regional figures need a county"),
            ("regex_match", "member_id", "Member ids look like MBR000001"),
        ],
    ),
    "providers": (
        "provider_flags",
        "provider_id",
        [
            ("unique", "provider_id", "One row per provider"),
            ("not_null", "specialty", "Costs are shown by specialty"),
        ],
    ),
    "claims": (
        "claim_flags",
        "claim_id",
        [
            ("unique", "claim_id", "A claim counts once"),
            ("min_value", "billed_amount_eur", "Bills are not negative"),
            ("allowed_values", "claim_status", "The status is a known one"),
            ("date_order", "service_date->submitted_date", "A claim follows its service"),
            ("referential", "member_id", "The member is a clean one"),
            ("referential", "provider_id", "The provider is a clean one"),
        ],
    ),
}


def _with(parts: list[str], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def _failing(rule_type: str) -> str:
    selects = [
        f"SELECT '{name}' AS dataset, '{label}' AS rule_column, {key} AS row_key, _ord AS row_order "
        f"FROM {table} WHERE f{i}"
        for name, (table, key, rules) in CHECKED.items()
        for i, (kind, label, _) in enumerate(rules)
        if kind == rule_type
    ]
    return _with(RULES, "\nUNION ALL ".join(selects))


def _texts(rules: list) -> str:
    return " || ".join(
        f"CASE WHEN f{i} THEN '{kind}:{label};' ELSE '' END" for i, (kind, label, _) in enumerate(rules)
    )


def _reasons(dataset: str) -> str:
    return _texts(CHECKED[dataset][2])


def _quarantine(dataset: str, columns: str) -> str:
    table = CHECKED[dataset][0]
    return (
        f"SELECT * FROM (SELECT {columns}, {_reasons(dataset)} AS _dq_failures FROM {table}) "
        "WHERE _dq_failures <> ''"
    )


def _report_of(name: str, table: str, rules: list) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS dataset, '{kind}' AS rule_type, '{label}' AS \"column\", "
        f"'{text}' AS description, count(*) AS rows_checked, count(*) FILTER (f{i}) AS rows_failed, "
        f"round_even(CASE WHEN count(*) = 0 THEN 100 ELSE (1 - count(*) FILTER (f{i}) / count(*)) * 100 END, 2) "
        f"AS pass_rate_pct FROM {table}"
        for i, (kind, label, text) in enumerate(rules)
    )


REPORT = "\nUNION ALL ".join(_report_of(name, table, rules) for name, (table, _, rules) in CHECKED.items())

#: The claims as lines of text, some of which cannot be read as they should be.
LINE_FLAGS = """
line_cells AS (
  SELECT *, _ord // 2 % 97 AS turn,
         CASE WHEN turn = 3 THEN 'soon' ELSE service_date END AS day_text,
         CASE WHEN turn = 5 THEN NULL ELSE claim_status END AS status_text
  FROM raw_claims
),
line_flags AS (
  SELECT claim_id, row_number() OVER (PARTITION BY claim_id ORDER BY _ord) > 1 AS f0,
         turn <> 1 AND coalesce(billed_amount_eur < 0, false) AS f1,
         coalesce(status_text NOT IN ('APPROVED', 'REJECTED', 'PENDING', 'UNDER_REVIEW'), true) AS f2,
         coalesce(try_cast(day_text AS TIMESTAMP) > try_cast(submitted_date AS TIMESTAMP), false) AS f3,
         NOT EXISTS (SELECT 1 FROM ok_members m WHERE m.member_id = c.member_id) AS f4,
         NOT EXISTS (SELECT 1 FROM ok_providers p WHERE p.provider_id = c.provider_id) AS f5,
         turn IN (4, 5) AS f6, turn = 3 AS f7, false AS f8, turn = 1 AS f9, turn = 2 AS f10
  FROM line_cells c
)"""
LINES = [MEMBERS, PROVIDERS, CLAIMS, MEMBER_FLAGS, PROVIDER_FLAGS, LINE_FLAGS]
LINE_RULES = [
    *CHECKED["claims"][2],
    ("whole_line", "_corrupt_line", "A line has as many cells as the header"),
    *(
        ("readable", c, f"{c} can be read")
        for c in ("service_date", "submitted_date", "billed_amount_eur", "approved_amount_eur")
    ),
]

LINE_REASONS = (
    f"SELECT claim_id, _dq_failures, count(*) AS lines FROM (SELECT claim_id, {_texts(LINE_RULES)} "
    "AS _dq_failures FROM line_flags) WHERE _dq_failures <> '' GROUP BY ALL"
)

DAYS = """
SELECT (year(d) * 10000 + month(d) * 100 + day(d))::INT AS date_key, d AS full_date,
       year(d)::BIGINT AS year, ((month(d) - 1) // 3 + 1)::BIGINT AS quarter,
       month(d)::BIGINT AS month_num, left(d::VARCHAR, 7) AS year_month,
       isodow(d) % 7 AS day_of_week, isodow(d) >= 6 AS is_weekend
FROM ({source})
"""

CLAIM_DAYS = """
SELECT date_trunc('year', min(service_date))::DATE + i.i::INT AS d
      FROM (SELECT min(service_date) AS service_date, max(service_date) AS last FROM silver_claims),
           LATERAL (SELECT unnest(range(0, (make_date(year(last) + 1, 1, 1)
                    - date_trunc('year', service_date)::DATE)::BIGINT)) AS i) i
      GROUP BY i.i
"""

SQL = {
    **{
        f"rule_{kind}": _failing(kind)
        for kind in (
            "not_null",
            "unique",
            "allowed_values",
            "min_value",
            "regex_match",
            "date_order",
            "referential",
        )
    },
    "members_clean": _with(RULES, f"SELECT {MEMBER_COLUMNS} FROM ok_members"),
    "providers_clean": _with(RULES, f"SELECT {PROVIDER_COLUMNS} FROM ok_providers"),
    "claims_clean": _with(RULES, f"SELECT {CLAIM_COLUMNS} FROM ok_claims"),
    "members_quarantine": _with(RULES, _quarantine("members", MEMBER_COLUMNS)),
    "providers_quarantine": _with(RULES, _quarantine("providers", PROVIDER_COLUMNS)),
    "claims_quarantine": _with(RULES, _quarantine("claims", CLAIM_COLUMNS)),
    "quarantine_reasons": _with(
        RULES,
        'SELECT dataset, reason, count(*) AS "rows" FROM ('
        + " UNION ALL ".join(
            f"SELECT '{name}' AS dataset, '{kind}:{label}' AS reason FROM {table} WHERE f{i}"
            for name, (table, _, rules) in CHECKED.items()
            for i, (kind, label, _) in enumerate(rules)
        )
        + ") GROUP BY dataset, reason",
    ),
    "csv_report": _with(LINES, _report_of("claims", "line_flags", LINE_RULES)),
    "csv_quarantine": _with(LINES, LINE_REASONS),
    "incremental_quarantine": _with(LINES, LINE_REASONS),
    "csv_multi_line": _with(
        [CLAIMS],
        """SELECT claim_id, member_id, provider_id, CASE _ord // 2 % 13
             WHEN 1 THEN procedure_code || chr(10) || 'second, "quoted" line' WHEN 2 THEN chr(10) || ' ' || chr(10) || procedure_code
             WHEN 3 THEN '"' || procedure_code || '"' ELSE procedure_code END AS procedure_code,
           service_date, submitted_date, billed_amount_eur::VARCHAR AS billed_amount_eur,
           approved_amount_eur::VARCHAR AS approved_amount_eur, claim_status FROM raw_claims""",
    ),
    "dates_by_format": _with(
        [CLAIMS],
        """SELECT claim_id, CASE WHEN turn NOT IN (1, 2) THEN service_date::DATE END AS service_date,
                  CASE WHEN turn <> 3 THEN submitted_date::DATE END AS submitted_date
           FROM (SELECT *, _ord // 2 % 41 AS turn FROM raw_claims)""",
    ),
    "date_format_misses": _with(
        [CLAIMS],
        """SELECT 'service_date' AS "column", 'dd/MM/yyyy' AS format, count(*) FILTER (turn = 2 OR service_date IS NOT NULL) AS cells,
                  count(*) FILTER (turn NOT IN (1, 2) AND service_date IS NOT NULL) AS read, cells - read AS missed
           FROM (SELECT *, _ord // 2 % 41 AS turn FROM raw_claims)
           UNION ALL
           SELECT 'submitted_date', 'MM/dd/yyyy', count(submitted_date), count(submitted_date) FILTER (turn <> 3),
                  count(submitted_date) FILTER (turn = 3)
           FROM (SELECT *, _ord // 2 % 41 AS turn FROM raw_claims)""",
    ),
    "pattern_matches": _with(
        [CLAIMS],
        r"""SELECT count(*) FILTER (regexp_matches(member_id, '^(MBR|CLM)[0-9]+$')) AS named,
                  count(*) FILTER (regexp_matches(provider_id, '^PRV[0-9]{4}$')) AS line_end,
                  count(*) FILTER (regexp_matches(procedure_code, '^PRC0*$')) AS word_edge,
                  count(*) FILTER (regexp_matches(claim_status, '^(APPROVED|P[A-Z]*G)')) AS any_case,
                  count(*) FILTER (regexp_matches(claim_id, '^CLM[0-9]*[0-4]-')) AS no_digit FROM raw_claims""",
    ),
    "csv_lines": _with(
        LINES,
        "SELECT count(*) AS lines, count(*) FILTER (why = '') AS clean, count(*) FILTER (why <> '') AS quarantined, "
        "'once' AS loaded_at, 1::BIGINT AS loads, 0::BIGINT AS without_source "
        f"FROM (SELECT {_texts(LINE_RULES)} AS why FROM line_flags)",
    ),
    "dq_report": _with(RULES, REPORT),
    "table_round_trip": _with(STAR, f"SELECT {MEMBER_COLUMNS} FROM silver_members"),
    "quarantine_round_trip": _with(RULES, _quarantine("members", MEMBER_COLUMNS)),
    "report_round_trip": _with(RULES, REPORT),
    "dq_total_failures": _with(
        RULES, f"SELECT sum(rows_failed)::BIGINT AS total_failures FROM ({REPORT})"
    ),
    "conform_members": _with(STAR, f"SELECT {MEMBER_COLUMNS} FROM silver_members"),
    "conform_claims": _with(STAR, f"SELECT {CLAIM_COLUMNS} FROM silver_claims"),
    "dim_member": _with(STAR, "SELECT * FROM g_member"),
    "dim_provider": _with(STAR, "SELECT * FROM g_provider"),
    "dim_date": _with(
        STAR,
        "SELECT days.*, coalesce(facts, 0) AS facts FROM ("
        + DAYS.format(source="SELECT unnest(range(DATE '2024-01-01', DATE '2027-01-01', INTERVAL 1 DAY))::DATE AS d")
        + ") days LEFT JOIN (SELECT service_date_key AS date_key, count(*) AS facts FROM g_fact GROUP BY 1) USING (date_key)",
    ),
    "catalog_listing": _with(
        [*STAR],
        " UNION ALL ".join(
            f"SELECT '{layer}' AS layer, '{name}' AS table_name, (SELECT count(*) FROM {prefix}_{name}) AS rows, "
            "1::BIGINT AS versions, true AS has_files"
            for layer, prefix in (("bronze", "raw"), ("silver", "silver"))
            for name in ("members", "claims")
        )
        + " UNION ALL SELECT 'bronze', 'providers', (SELECT count(*) FROM raw_providers), 1, true"
        + " UNION ALL SELECT 'silver', 'providers', (SELECT count(*) FROM ok_providers), 1, true"
        + f" UNION ALL SELECT 'audit', 'dq_report', {sum(len(rules) for _, _, rules in CHECKED.values())}, 1, true",
    ),
    "build_ledger": _with(
        [*STAR, MONTHLY, COSTS, USE],
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, ({rows}) AS rows, {versions}::BIGINT AS versions, "
            f"'{source}' AS source_table, (SELECT count(*) FROM {source}) AS source_rows"
            for name, rows, versions, source in (
                ("dim_member", "SELECT count(*) FROM g_member", 2, "customer"),
                ("dim_provider", "SELECT count(*) FROM g_provider", 1, "supplier"),
                ("dim_date", "SELECT 1096::BIGINT", 1, "lineitem"),
                ("fact_claims", "SELECT count(*) FROM g_fact", 2, "lineitem"),
                ("mart_monthly_kpis", "SELECT count(*) FROM g_monthly", 2, "lineitem"),
                ("mart_specialty_costs", "SELECT count(*) FROM g_costs", 2, "lineitem"),
                ("mart_member_utilisation", "SELECT count(*) FROM g_use", 2, "lineitem"),
            )
        ),
    ),
    "dim_date_of_claims": _with(STAR, DAYS.format(source=CLAIM_DAYS)),
    "facts_outside_calendar": _with(
        STAR,
        "SELECT (service_date_key // 10000)::INT AS service_year, count(*) AS facts FROM g_fact "
        "WHERE service_date_key IS NULL OR service_date_key NOT BETWEEN 20240101 AND 20261231 GROUP BY 1",
    ),
    "fact_claims": _with(STAR, "SELECT * FROM g_fact"),
    "mart_monthly_kpis": _with([*STAR, MONTHLY], "SELECT * FROM g_monthly"),
    "mart_specialty_costs": _with([*STAR, COSTS], "SELECT * FROM g_costs"),
    "mart_member_utilisation": _with([*STAR, USE], "SELECT * FROM g_use"),
    "q_mom_growth": _with(
        [*STAR, MONTHLY],
        """SELECT month, total_claims, total_approved_eur,
           round(CASE WHEN before <> 0 THEN 100 * (total_approved_eur - before) / before END, 1) AS mom_growth_pct
           FROM (SELECT *, lag(total_approved_eur) OVER w AS before FROM g_monthly WINDOW w AS (ORDER BY month))
           ORDER BY month""",
    ),
    "q_top_procedures": _with(
        STAR,
        """SELECT procedure_code, n AS claim_count, round(spend / priced, 2) AS avg_cost_eur,
           round(spend, 2) AS total_cost_eur
           FROM (SELECT procedure_code, count(*) AS n, count(approved_amount_eur) AS priced,
                        sum(approved_amount_eur::DECIMAL(18,4))::DOUBLE AS spend
                 FROM g_fact WHERE claim_status = 'APPROVED' GROUP BY procedure_code)
           WHERE n >= 50 ORDER BY avg_cost_eur DESC, procedure_code LIMIT 10""",
    ),
    "q_over_3x_premium": _with(
        [*STAR, USE],
        "SELECT plan_type, age_band, count(*) AS members_over_3x FROM g_use "
        "WHERE utilisation_ratio > 3 GROUP BY ALL",
    ),
    "q_oon_premium": _with(
        [*STAR, COSTS],
        """SELECT specialty, round(max(CASE WHEN network_status = 'OUT_OF_NETWORK' THEN avg_claim_cost_eur END)
           - max(CASE WHEN network_status = 'IN_NETWORK' THEN avg_claim_cost_eur END), 2) AS oon_cost_premium_eur
           FROM g_costs GROUP BY specialty""",
    ),
    "q_sla_breach": _with(
        [*STAR, MONTHLY], "SELECT month, round(100 * late / n, 2) AS sla_breach_pct FROM by_month"
    ),
    "q_latest_kpis": _with([*STAR, MONTHLY], "SELECT * FROM g_monthly ORDER BY month DESC LIMIT 6"),
    "check_duplicate_keys": _with(
        STAR,
        "SELECT count(*) AS duplicate_keys FROM "
        "(SELECT claim_id FROM silver_claims GROUP BY claim_id HAVING count(*) > 1)",
    ),
    "check_negative_amounts": _with(
        STAR,
        "SELECT coalesce(sum((billed_amount_eur < 0)::INT), 0)::BIGINT AS negative_amounts FROM silver_claims",
    ),
    "check_orphan_facts": _with(
        STAR,
        "SELECT count(*) AS orphan_facts FROM g_fact "
        "WHERE member_key NOT IN (SELECT member_key FROM g_member)",
    ),
    "check_failures_recorded": _with(
        RULES,
        f"SELECT sum(rows_failed)::BIGINT AS rows_failed, sum(rows_failed) > 0 AS any_recorded FROM ({REPORT})",
    ),
    "check_rate_bounds": _with(
        [*STAR, MONTHLY],
        "SELECT min(approval_rate_pct) AS lowest_rate, max(approval_rate_pct) AS highest_rate FROM g_monthly",
    ),
}
