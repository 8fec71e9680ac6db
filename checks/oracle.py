"""The same results in SQL for DuckDB: named views, resolved into WITH lists."""

from __future__ import annotations

import re

from checks.config import CONFIG_TABLES, RESET_QUARTER, SINCE, config_sql
from checks.proxies import CLAIM_CODES, LONG_AGO, QUARTERS, STRATIFIED_EARLY

D = "DATE '1999-01-15'"
QS, QE = "DATE '1999-01-01'", "DATE '1999-03-31'"
LS, LE = "DATE '1998-09-01'", "DATE '1998-11-30'"
NOW = "TIMESTAMP '1999-01-15 06:30:00'"
SINCE_SQL = f"DATE '{SINCE}'"
RESET_SQL = f"DATE '{RESET_QUARTER}'"
MILLI = "0.001"


def _quarter_rows() -> str:
    parts = []
    for n, (start, end, b_start, b_end) in enumerate(QUARTERS):
        early = f" AND price > {STRATIFIED_EARLY}" if n == 2 else ""
        parts.append(
            f"""SELECT auth_no, age_group, special_population, language_differential, {n} AS n,
            DATE '{start}' AS q_start, DATE '{end}' AS q_end,
            DATE '{b_start}' AS b_start, DATE '{b_end}' AS b_end
            FROM auth JOIN case_rate USING (kcid, auth_no)
            WHERE start_date <= DATE '{end}'
              AND coalesce(expire_date, DATE '2099-12-31') >= DATE '{start}'{early}"""
        )
    return " UNION ALL ".join(parts)


def _touch(start: str, end: str, lo: str, hi: str) -> str:
    """Range contact, with an open end only if the start lies inside."""
    return (
        f"coalesce({start} BETWEEN {lo} AND {hi} OR {end} BETWEEN {lo} AND {hi} "
        f"OR ({start} <= {hi} AND {end} >= {lo}), false)"
    )


def _focus(program: str, unfunded: bool) -> str:
    mop, sop = (", 'MOP'", ", 'SOP'") if unfunded else ("", "")
    return (
        f"CASE WHEN {program} IN ('2X1','3A1','3B1','400','401'{mop}) THEN 'MH' "
        f"WHEN {program} IN ('S01','S02','500','501'{sop}) THEN 'SUD' ELSE '' END"
    )


def _milli(units: str) -> str:
    """Whole thousandths as a decimal."""
    return f"CAST(CAST({units} AS DECIMAL(18,0)) * {MILLI} AS DECIMAL(18,3))"


def _units(hours: str) -> str:
    """A decimal of three digits as whole thousandths."""
    return f"CAST({hours} * 1000 AS BIGINT)"


# Hours per day cut at seven digits, times days, rounded half up to thousandths.
EXPECTED = (
    "coalesce((enroll_days * (CAST(svc_hrs_req * 1000 AS BIGINT) * 1000 // 3) + 5000) // 10000, 0)"
)

VIEWS: dict[str, str] = {name: config_sql(name) for name in CONFIG_TABLES}

VIEWS |= {
    # --- proxies ----------------------------------------------------------------------
    "auth": """SELECT o_custkey // 3 AS kcid, o_orderkey AS auth_no,
        CAST(o_orderkey % 3 AS INTEGER) AS agency_id, CAST(o_orderdate AS DATE) AS start_date,
        CASE WHEN o_orderkey % 11 <> 0
             THEN CAST(o_orderdate AS DATE) + CAST(30 + o_orderkey % 370 AS INTEGER) END AS expire_date,
        CASE o_orderpriority WHEN '1-URGENT' THEN '400' WHEN '2-HIGH' THEN '401'
             WHEN '3-MEDIUM' THEN '2X1' WHEN '4-NOT SPECIFIED' THEN '3A1' ELSE 'S01' END AS program,
        CASE o_orderstatus WHEN 'O' THEN 'AA' WHEN 'F' THEN 'TM' ELSE 'PN' END AS status_code,
        CAST(o_orderdate AS DATE) AS posted,
        CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 'ID' ELSE 'OK' END AS data_status,
        o_totalprice AS price FROM orders""",
    "persons": "SELECT c_custkey // 3 AS kcid, min(c_custkey) AS first_key FROM customer GROUP BY 1",
    "person": """SELECT kcid, DATE '1950-01-01' + CAST(first_key * 7919 % 17900 AS INTEGER) AS dob
        FROM persons""",
    "p1_client": "SELECT kcid, CASE WHEN kcid % 7 <> 0 THEN 'P' || kcid END AS p1_id FROM persons",
    "plan": """SELECT auth_no, CASE auth_no % 4 WHEN 0 THEN 'F19' WHEN 1 THEN 'MID'
        WHEN 2 THEN 'OTH' END AS plan FROM auth""",
    "case_rate": """SELECT kcid, auth_no,
        CASE WHEN kcid % 50 = 7 THEN NULL WHEN kcid % 3 = 0 THEN 'A' WHEN kcid % 3 = 1 THEN 'C'
             ELSE 'G' END AS age_group,
        CASE WHEN price > 300000 THEN 'SP' END AS special_population,
        CASE WHEN agency_id = 1 THEN 'Y' ELSE 'N' END AS language_differential FROM auth""",
    "quarter_rows": _quarter_rows(),
    "au_stratum": """SELECT auth_no * 4 + n AS au_stratum_id, auth_no, q_start AS calc_date,
        q_start AS start_date, q_end AS end_date,
        CAST(auth_no % 40 AS DECIMAL(18,3)) AS total_score,
        CASE (auth_no + CASE WHEN auth_no % 5 = 0 THEN n ELSE 0 END) % 3
             WHEN 0 THEN 'L' WHEN 1 THEN 'M' ELSE 'H' END AS strat_level,
        age_group, special_population, language_differential,
        CAST(CASE WHEN n = 0 THEN 0.925 ELSE 1 END AS DECIMAL(6,3)) AS sda_pay_multiplier,
        'N' AS missing_data, 'NNN' AS override_status, CAST(q_start AS TIMESTAMP) AS post_stamp,
        CASE WHEN n = 0 THEN 'NOR' ELSE 'SHA' END AS sda_rule,
        CAST(NULL AS TIMESTAMP) AS modify_stamp,
        CAST(CASE WHEN n = 0 AND auth_no % 7 <> 0 THEN auth_no * 4
             WHEN n = 1 AND auth_no % 4 <> 0 THEN auth_no * 4 + 1 END AS BIGINT) AS stratum_sda_id
        FROM quarter_rows""",
    "au_stratum_sda": f"""SELECT auth_no * 4 + n AS stratum_sda_id, auth_no,
        b_start AS start_date, b_end AS end_date,
        CASE WHEN (auth_no * 37 + n) % 93 >= 28
             THEN {_milli('(auth_no * 13 + n * 101) % 1500')} END AS sda,
        CAST((auth_no * 37 + n) % 93 AS INTEGER) AS enroll_days FROM quarter_rows""",
    "ev": """SELECT event_id, (user_id * 10 + event_id % 10) // 3 AS kcid, event_type, value,
        day(ts) AS dom, CAST(CAST(ts AS DATE) - INTERVAL 25 YEAR AS DATE) AS day FROM events""",
    "assessment": """SELECT event_type, kcid, CAST(event_id % 3 AS INTEGER) AS agency_id,
        day + CAST(event_id * 7 % 240 - 90 AS INTEGER) AS event_date, event_id AS record_id,
        CASE WHEN event_id % 29 <> 0 THEN CAST(floor(value) AS INTEGER) END AS composite_score FROM ev""",
    "residence": """SELECT kcid, CASE event_id % 5 WHEN 0 THEN '26' WHEN 1 THEN '46' WHEN 2 THEN '82'
        WHEN 3 THEN '82' ELSE '10' END AS code,
        DATE '1998-12-25' + CAST(dom % 8 * 8 AS INTEGER) AS start_date FROM ev WHERE event_type = 'signup'""",
    "coverage": """SELECT c_custkey // 3 AS kcid, c_mktsegment = 'BUILDING' AS is_foster,
        DATE '1998-06-01' + CAST(c_custkey % 400 AS INTEGER) AS start_date FROM customer""",
    "claim_ccw": f"""SELECT 'P' || kcid AS id, ([{CLAIM_CODES}])[event_id % 11 + 1] AS ccw,
        day + CAST(event_id % 60 - 30 AS INTEGER) AS from_date FROM ev WHERE event_type = 'purchase'""",
    "eligibility": """SELECT 'P' || (c_custkey // 3) AS id,
        CASE c_mktsegment WHEN 'AUTOMOBILE' THEN DATE '1994-01-01' WHEN 'MACHINERY' THEN DATE '1998-01-01'
             WHEN 'FURNITURE' THEN DATE '1997-06-01' WHEN 'BUILDING' THEN DATE '1980-01-01'
             ELSE DATE '1990-01-01' END AS from_date,
        CASE c_mktsegment WHEN 'AUTOMOBILE' THEN DATE '1996-06-30' WHEN 'MACHINERY' THEN DATE '1999-12-31'
             WHEN 'FURNITURE' THEN DATE '1997-12-31' WHEN 'BUILDING' THEN DATE '1985-12-31'
             ELSE DATE '2005-12-31' END AS to_date FROM customer""",
    "claim_header": f"""SELECT 'P' || (o_custkey // 3) AS id, CAST(o_orderdate AS DATE)
        - CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE {LONG_AGO} END AS first_date FROM orders""",
    "assessed": """SELECT auth_no, CASE WHEN price <= 150000 THEN '999' ELSE
        CASE auth_no % 10 WHEN 0 THEN '152' WHEN 1 THEN '153'
        WHEN 2 THEN '154' WHEN 3 THEN '155' ELSE '999' END END AS code FROM auth""",
    "ip": """SELECT l_orderkey AS auth_no, CASE WHEN l_linenumber % 4 = 3 THEN NULL
        WHEN l_linenumber % 4 = 0 THEN '' WHEN l_returnflag = 'A' THEN 'I' ELSE 'V' END AS ip_type
        FROM lineitem""",
    "jail": f"""SELECT kcid, start_date - ago AS book_date, expire_date - ago AS release_date
        FROM (SELECT *, CASE WHEN program = 'S01' THEN 0 ELSE {LONG_AGO} END AS ago FROM auth)""",
    "hospital": """SELECT kcid, event_id % 3 AS class,
        day + CAST(event_id * 7 % 700 - 500 AS INTEGER) AS admit_date FROM ev WHERE event_type = 'view'""",
    "municipal": """SELECT CASE WHEN event_id % 13 <> 0 THEN kcid END AS kcid, s AS book_date,
        CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 37 = 0 THEN s - 3
             ELSE s + CAST(floor(value / 2) AS INTEGER) END AS release_date
        FROM (SELECT *, day - CAST(event_id * 11 % 2500 AS INTEGER) AS s FROM ev WHERE event_type = 'error')""",
    "asam": """SELECT kcid, CAST(event_id % 3 AS INTEGER) AS agency_id,
        day + CAST(event_id * 11 % 900 - 800 AS INTEGER) AS event_date, event_id AS record_id,
        CASE event_id % 4 WHEN 0 THEN 2.1 WHEN 1 THEN 5 WHEN 2 THEN 1 ELSE 3.5 END AS level
        FROM ev WHERE event_type = 'click' AND event_id % 7 > 0""",
    "injection": """SELECT kcid, day + CAST(event_id * 13 % 500 - 450 AS INTEGER) AS event_date
        FROM ev WHERE event_type = 'error' AND event_id % 3 = 1""",
    "service": """SELECT l_orderkey AS auth_no,
        CAST(o_orderdate AS DATE) + CAST(l_partkey % 200 AS INTEGER) AS event_date,
        CAST(l_quantity AS INTEGER) - 2 AS minutes, l_linenumber AS source_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "all_members": "SELECT kcid, auth_no, program, age_group FROM auth JOIN case_rate USING (kcid, auth_no)",
    # --- population -------------------------------------------------------------------
    "pop": f"""SELECT a.kcid, a.auth_no, {QS} AS phs_start_date, {QE} AS phs_end_date, {D} AS calc_date,
        a.agency_id, a.start_date, a.expire_date,
        CASE WHEN a.program IN ('400','401') THEN a.program WHEN plan = 'F19' THEN '400'
             WHEN plan = 'MID' THEN '401' ELSE 'MOP' END AS program,
        a.program AS current_program, 'MH' AS tx_focus, age_group, special_population,
        language_differential,
        CAST(trunc((19990101 - CAST(strftime(dob, '%Y%m%d') AS INTEGER)) / 10000) AS INTEGER) AS age, p1_id
        FROM auth a JOIN case_rate c USING (kcid, auth_no) LEFT JOIN person USING (kcid)
        LEFT JOIN plan USING (auth_no) LEFT JOIN p1_client USING (kcid)
        WHERE a.program IN ('2X1','3A1','400','401') AND data_status <> 'ID'
          AND posted <= {D} - 3 AND {_touch('a.start_date', 'expire_date', QS, QE)}
          AND NOT EXISTS (SELECT 1 FROM au_stratum s WHERE s.auth_no = a.auth_no AND s.start_date = {QS})""",
    # --- risk inputs ------------------------------------------------------------------
    "own_scores": """SELECT * FROM assessment WHERE event_date <= DATE '1999-04-15'
        QUALIFY row_number() OVER (PARTITION BY event_type, kcid, agency_id
                                   ORDER BY event_date DESC, record_id DESC) = 1""",
    "any_scores": """SELECT * FROM own_scores WHERE event_type = 'click'
        QUALIFY row_number() OVER (PARTITION BY kcid ORDER BY event_date DESC, agency_id) = 1""",
    "assessments": """SELECT p.*, coalesce(l.composite_score, x.composite_score) AS raw_locus,
        coalesce(c.composite_score, x.composite_score) AS raw_caloc
        FROM pop p LEFT JOIN own_scores l ON l.event_type = 'click' AND l.kcid = p.kcid AND l.agency_id = p.agency_id
        LEFT JOIN own_scores c ON c.event_type = 'view' AND c.kcid = p.kcid AND c.agency_id = p.agency_id
        LEFT JOIN any_scores x ON x.kcid = p.kcid""",
    "foster": """SELECT kcid FROM residence WHERE code IN ('26','46','47')
        UNION SELECT kcid FROM coverage WHERE is_foster AND start_date <= DATE '1999-02-15'""",
    "homeless": """SELECT kcid, CAST(max(CASE WHEN code = '82' THEN 1 ELSE 0 END) AS INTEGER) AS HMLES
        FROM (SELECT *, rank() OVER (PARTITION BY kcid ORDER BY start_date DESC) AS r
              FROM residence WHERE start_date <= DATE '1999-02-15') WHERE r = 1 GROUP BY kcid""",
    "claim_flags": """SELECT id,
        max(CASE WHEN ccw = 'ccw_diabetes' THEN 1 ELSE 0 END) AS diabetes,
        max(CASE WHEN ccw = 'ccw_asthma' THEN 1 ELSE 0 END) AS asthma,
        max(CASE WHEN ccw = 'ccw_copd' THEN 1 ELSE 0 END) AS copd,
        max(CASE WHEN ccw NOT IN ('ccw_diabetes','ccw_asthma','ccw_copd','ccw_other') THEN 1 ELSE 0 END) AS cvd
        FROM claim_ccw WHERE from_date <= DATE '1999-01-15' GROUP BY id""",
    "covered": """SELECT DISTINCT id, CASE WHEN EXISTS (
            SELECT 1 FROM claim_header h WHERE h.id = e.id
            AND first_date BETWEEN DATE '1997-01-15' AND DATE '1999-01-15') THEN 'N' ELSE 'Y' END AS flag
        FROM eligibility e WHERE from_date <= DATE '1999-01-15' AND to_date >= DATE '1997-01-15'""",
    "condition_pivot": """SELECT id AS p1_id, CAST(coalesce(diabetes, 0) AS INTEGER) AS ccw_diabetes,
        CAST(coalesce(cvd, 0) AS INTEGER) AS ccw_cvd, CAST(coalesce(asthma, 0) AS INTEGER) AS ccw_asthma,
        CAST(coalesce(copd, 0) AS INTEGER) AS ccw_copd, flag AS CHRON_missing_data
        FROM covered LEFT JOIN claim_flags USING (id)""",
    "assessed_pop": """SELECT p.*, CAST(coalesce(code = '152', false) AS INTEGER) AS caa_asthma,
        CAST(coalesce(code = '153', false) AS INTEGER) AS caa_diabetes,
        CAST(coalesce(code = '154', false) AS INTEGER) AS caa_copd,
        CAST(coalesce(code = '155', false) AS INTEGER) AS caa_cvd
        FROM pop p LEFT JOIN assessed USING (auth_no)""",
    "chronic": """SELECT a.* EXCLUDE (caa_asthma, caa_diabetes, caa_copd, caa_cvd),
        greatest(caa_asthma, coalesce(ccw_asthma, 0)) AS asthma,
        greatest(caa_diabetes, coalesce(ccw_diabetes, 0)) AS diabetes,
        greatest(caa_copd, coalesce(ccw_copd, 0)) AS copd, greatest(caa_cvd, coalesce(ccw_cvd, 0)) AS cvd,
        coalesce(CHRON_missing_data, 'Y') AS CHRON_missing_data
        FROM assessed_pop a LEFT JOIN condition_pivot c ON a.p1_id = c.p1_id""",
    "crisis": """SELECT kcid,
        CAST(sum(CASE WHEN program = '400' THEN 1 ELSE 0 END) AS BIGINT) AS nSRS,
        CAST(sum(CASE WHEN program = '401' THEN 1 ELSE 0 END) AS BIGINT) AS nDTX,
        CAST(sum(CASE WHEN program = '2X1' THEN 1 ELSE 0 END) AS BIGINT) AS nITA
        FROM auth LEFT JOIN (SELECT DISTINCT auth_no, ip_type FROM ip) USING (auth_no)
        WHERE (program IN ('400','401') OR (program = '2X1' AND ip_type = 'I')) AND status_code IN ('AA','TM')
          AND (start_date BETWEEN DATE '1998-01-15' AND DATE '1999-01-15'
               OR expire_date BETWEEN DATE '1998-01-15' AND DATE '1999-01-15')
        GROUP BY kcid""",
    "hospital_counts": """SELECT kcid, CAST(count(*) FILTER (class = 0) AS BIGINT) AS nED,
        CAST(count(*) FILTER (class = 1) AS BIGINT) AS nIP
        FROM hospital WHERE admit_date BETWEEN DATE '1998-01-15' AND DATE '1999-01-15' GROUP BY kcid""",
    "util": """SELECT *, nSRS + nDTX + nITA + nED + nIP AS HUTIL FROM (
        SELECT kcid, coalesce(nSRS, 0) AS nSRS, coalesce(nDTX, 0) AS nDTX, coalesce(nITA, 0) AS nITA,
        coalesce(nED, 0) AS nED, coalesce(nIP, 0) AS nIP FROM crisis FULL JOIN hospital_counts USING (kcid))""",
    "cutoff": "SELECT least(max(book_date), DATE '1999-01-15') AS cutoff_date FROM municipal",
    "stays": f"""SELECT DISTINCT kcid, book_date, release_date FROM (
        SELECT kcid, book_date, coalesce(release_date, book_date) AS release_date FROM jail
        UNION ALL SELECT kcid, book_date, coalesce(release_date, book_date) FROM municipal
        WHERE kcid IS NOT NULL), cutoff
        WHERE {_touch('book_date', 'release_date', "CAST(cutoff_date - INTERVAL 60 MONTH AS DATE)", 'cutoff_date')}""",
    "merged": """SELECT kcid, CAST(grp AS INTEGER) AS grp, min(book_date) AS book_date,
        max(release_date) AS release_date
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY kcid ORDER BY book_date, release_date
                                         ROWS UNBOUNDED PRECEDING) AS grp
              FROM (SELECT *, CASE WHEN book_date <= lag(release_date) OVER (
                        PARTITION BY kcid ORDER BY book_date, release_date) THEN 0 ELSE 1 END AS fresh
                    FROM stays)) GROUP BY kcid, grp""",
    "merged_runmax": """SELECT kcid, CAST(grp AS INTEGER) AS grp, min(book_date) AS book_date,
        max(release_date) AS release_date
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY kcid ORDER BY book_date, release_date
                                         ROWS UNBOUNDED PRECEDING) AS grp
              FROM (SELECT *, CASE WHEN book_date <= max(release_date) OVER (
                        PARTITION BY kcid ORDER BY book_date, release_date
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh
                    FROM (SELECT kcid, book_date, max(release_date) AS release_date FROM stays
                          GROUP BY kcid, book_date))) GROUP BY kcid, grp""",
    "stay_features": """SELECT kcid,
        CAST(count(*) FILTER (release_date >= CAST(cutoff_date - INTERVAL 6 MONTH AS DATE)) AS BIGINT) AS NUMCJ,
        CAST(max(CASE WHEN year(release_date) - year(book_date) >= 2 THEN 1 ELSE 0 END) AS INTEGER) AS LNGCJ
        FROM merged, cutoff GROUP BY kcid""",
    "asam_latest": """SELECT kcid, agency_id, CAST(level AS DECIMAL(4,1)) AS level FROM asam
        WHERE event_date BETWEEN DATE '1997-01-15' AND DATE '1999-04-15'
        QUALIFY row_number() OVER (PARTITION BY kcid, agency_id ORDER BY event_date DESC, record_id DESC) = 1""",
    "inputs": """SELECT c.*, asthma + diabetes + copd + cvd AS CHRON,
        coalesce(raw_locus, 0) AS LOCUS,
        CASE WHEN age_group NOT IN ('A','G') OR raw_locus IS NOT NULL THEN 'N' ELSE 'Y' END AS LOCUS_missing_data,
        coalesce(raw_caloc, 0) AS CALOC,
        CASE WHEN age_group <> 'C' OR raw_caloc IS NOT NULL THEN 'N' ELSE 'Y' END AS CALOC_missing_data,
        CASE WHEN f.kcid IS NULL THEN 0 ELSE 1 END AS FOSTR, coalesce(HMLES, 0) AS HMLES,
        coalesce(nSRS, 0) AS nSRS, coalesce(nDTX, 0) AS nDTX, coalesce(nITA, 0) AS nITA,
        coalesce(nED, 0) AS nED, coalesce(nIP, 0) AS nIP, coalesce(HUTIL, 0) AS HUTIL,
        coalesce(NUMCJ, 0) AS NUMCJ, coalesce(LNGCJ, 0) AS LNGCJ
        FROM chronic c JOIN (SELECT auth_no, raw_locus, raw_caloc FROM assessments) s USING (auth_no)
        LEFT JOIN foster f ON f.kcid = c.kcid LEFT JOIN homeless h ON h.kcid = c.kcid
        LEFT JOIN util u ON u.kcid = c.kcid LEFT JOIN stay_features j ON j.kcid = c.kcid""",
    # --- scoring ----------------------------------------------------------------------
    "metrics": f"""SELECT DISTINCT trim(metric) AS metric FROM cd_stratum_metric
        WHERE {D} BETWEEN start_date AND end_date AND trim(metric) <> 'OTHER'""",
    "long": " UNION ALL ".join(
        f"""SELECT kcid, auth_no, program, age_group, calc_date, '{m}' AS metric,
        CAST({m} AS DECIMAL(18,3)) AS value, {flag} AS missing_data FROM inputs"""
        for m, flag in {
            "LOCUS": "LOCUS_missing_data", "CALOC": "CALOC_missing_data", "FOSTR": "'N'", "HMLES": "'N'",
            "CHRON": "CHRON_missing_data", "HUTIL": "'N'", "NUMCJ": "'N'", "LNGCJ": "'N'",
        }.items()
    ),
    "restricted": """SELECT DISTINCT l.* FROM long l WHERE EXISTS (
        SELECT 1 FROM cd_stratum_pop_model m WHERE m.program = l.program AND m.age_group = l.age_group
        AND m.metric = l.metric AND l.calc_date BETWEEN m.start_date AND m.end_date)""",
    "lines": """SELECT r.auth_no, r.program, r.age_group, r.calc_date, r.metric, value,
        CAST(coalesce(score, 0) AS DECIMAL(18,3)) AS score, missing_data
        FROM restricted r LEFT JOIN cd_stratum_pop_model m ON m.program = r.program
        AND m.age_group = r.age_group AND m.metric = r.metric AND value BETWEEN range_low AND range_high
        AND calc_date BETWEEN start_date AND end_date""",
    "totals": """SELECT auth_no, program, age_group, calc_date, CAST(sum(score) AS DECIMAL(18,3)) AS total_score,
        max(missing_data) AS missing_data FROM lines WHERE age_group IS NOT NULL GROUP BY ALL""",
    "tiered": """SELECT t.*, strat_level, svc_hrs_req FROM totals t LEFT JOIN cd_stratum_tier c
        ON c.program = t.program AND c.age_group = t.age_group AND total_score BETWEEN range_low AND range_high
        AND calc_date BETWEEN start_date AND end_date""",
    "leveled": """SELECT i.*, total_score, missing_data,
        CASE WHEN age < 6 THEN 'H' ELSE strat_level END AS strat_level, svc_hrs_req
        FROM inputs i LEFT JOIN tiered t USING (auth_no, program, age_group, calc_date)""",
}


def _dose_views(tag: str, members: str) -> dict[str, str]:
    """The dose calculation for one set of members; `tag` keeps the view names apart."""
    t = tag
    window = _touch("b.start_date", "b.end_date", LS, LE)

    def strata(source: str, key: str, columns: str) -> str:
        return f"""SELECT {columns},
            CASE WHEN b.start_date IS NOT NULL THEN least(greatest(b.start_date, {LS}), {LE}) END AS sda_start,
            CASE WHEN b.end_date IS NULL THEN {LE} ELSE least(greatest(b.end_date, {LS}), {LE}) END AS sda_end,
            b.strat_level, c.svc_hrs_req
            FROM {source} a LEFT JOIN au_stratum b ON b.auth_no = a.{key} AND {window}
            LEFT JOIN cd_stratum_tier c
            ON c.program = CASE WHEN a.program IN ('2X1','3A1') THEN '400' ELSE a.program END
            AND c.age_group = b.age_group AND c.strat_level = b.strat_level"""

    def clipped(source: str, prefix: str) -> str:
        begin, finish = f"{prefix}auth_start", f"{prefix}auth_expire"
        outside = f"coalesce({begin} > {LE} OR {finish} < {LS}, false)"
        return f"""SELECT * REPLACE (
            CASE WHEN NOT {outside} AND sda_start IS NOT NULL THEN greatest(sda_start, {begin}) END AS sda_start,
            CASE WHEN NOT {outside} THEN least(sda_end, {finish}) END AS sda_end) FROM {source}"""

    def costed(source: str) -> str:
        return f"""SELECT *, {EXPECTED} AS expected_units FROM (
            SELECT *, CASE WHEN sda_end - sda_start + 1 >= 0
                      THEN CAST(sda_end - sda_start + 1 AS INTEGER) END AS enroll_days FROM {source})"""

    def spans(source: str, key: str) -> str:
        return f"""SELECT k AS auth_no, sda_start, sda_end, n_strata,
            CAST((micro * n_strata + 500) // 1000 AS BIGINT) AS hour_units
            FROM (SELECT k, sda_start, sda_end, n_strata, coalesce(sum(micro_hrs), 0) AS micro
                  FROM (SELECT {key} AS k, sda_start, sda_end, CAST(count(*) AS BIGINT) AS n_strata
                        FROM {source} GROUP BY k, sda_start, sda_end) s
                  LEFT JOIN daily d ON d.auth_no = k AND event_date BETWEEN sda_start AND sda_end
                  GROUP BY k, sda_start, sda_end, n_strata)"""

    def sums(source: str, spans_view: str, key: str, group: str) -> str:
        return f"""SELECT {group}, CAST(sum(coalesce(enroll_days, 0)) AS INTEGER) AS enroll_days,
            CAST(sum(expected_units) AS BIGINT) AS expected_units,
            CAST(sum(coalesce(hour_units, 0)) AS BIGINT) AS hour_units
            FROM {source} x LEFT JOIN (SELECT auth_no AS k, sda_start, sda_end, hour_units FROM {spans_view}) y
            ON x.{key} = y.k AND x.sda_start = y.sda_start AND x.sda_end = y.sda_end GROUP BY ALL"""

    group = "kcid, auth_no, auth_start, auth_expire, agency_id, program, age_group, tx_focus"
    return {
        f"{t}members": f"""SELECT m.*, d.start_date AS auth_start, coalesce(d.expire_date, {LE}) AS auth_expire,
            d.agency_id, {_focus('m.program', True)} AS tx_focus
            FROM (SELECT DISTINCT kcid, auth_no, program, age_group FROM {members}) m
            LEFT JOIN auth d ON d.auth_no = m.auth_no""",
        f"{t}active": strata(f"{t}members", "auth_no", "a.*"),
        f"{t}dated": strata(f"{t}members", "auth_no", "a.*") + f" AND {D} BETWEEN c.start_date AND c.end_date",
        f"{t}clipped": clipped(f"{t}active", ""),
        f"{t}costed": costed(f"{t}clipped"),
        f"{t}spans": spans(f"{t}costed", "auth_no"),
        f"{t}sums": sums(f"{t}costed", f"{t}spans", "auth_no", group),
        f"{t}linked": f"""SELECT s.*, p.auth_no AS prev_auth_no, p.start_date AS prev_auth_start,
            p.expire_date AS prev_auth_expire
            FROM {t}sums s LEFT JOIN auth p ON p.kcid = s.kcid AND p.agency_id = s.agency_id
            AND {_focus('p.program', True)} = s.tx_focus AND p.auth_no <> s.auth_no
            AND p.status_code IN ('AA','TM') AND s.auth_start - p.expire_date BETWEEN 0 AND 90
            AND p.expire_date >= {LS}
            QUALIFY row_number() OVER (PARTITION BY s.kcid, s.auth_no, s.program, s.age_group
                                       ORDER BY p.expire_date DESC NULLS LAST, p.auth_no DESC) = 1""",
        f"{t}p_members": f"""SELECT kcid, auth_no, program, prev_auth_no, prev_auth_start, prev_auth_expire
            FROM {t}linked WHERE prev_auth_no IS NOT NULL""",
        f"{t}p_active": strata(f"{t}p_members", "prev_auth_no", "a.*"),
        f"{t}p_clipped": clipped(f"{t}p_active", "prev_"),
        f"{t}p_costed": costed(f"{t}p_clipped"),
        f"{t}p_spans": spans(f"{t}p_costed", "prev_auth_no"),
        f"{t}p_sums": sums(f"{t}p_costed", f"{t}p_spans", "prev_auth_no", "kcid, x.auth_no, prev_auth_no"),
        f"{t}dose": f"""SELECT l.*, p.enroll_days AS prev_days, p.expected_units AS prev_expected,
            p.hour_units AS prev_hours, coalesce(prev_auth_start, auth_start) AS longest_start,
            auth_expire AS longest_expire FROM {t}linked l
            LEFT JOIN {t}p_sums p ON p.kcid = l.kcid AND p.auth_no = l.auth_no""",
        f"{t}months": f"""SELECT *, CAST(EXISTS (
            SELECT 1 FROM (VALUES (DATE '1998-09-01'), (DATE '1998-10-01'), (DATE '1998-11-01')) v(m)
            WHERE longest_start <= m AND longest_expire >= last_day(m)) AS INTEGER) AS calendar_month FROM {t}dose""",
        f"{t}prorated": f"""SELECT kcid, auth_no, program, age_group, prev_auth_no, calendar_month, days,
            hours, CASE WHEN days > 0 THEN (60 * hours + days) // (2 * days) END AS prorated_units,
            CASE WHEN days > 0 THEN (30 * (expected * 1000 // days) + 500) // 1000 END AS expected_units
            FROM (SELECT *, coalesce(enroll_days, 0) + coalesce(prev_days, 0) AS days,
                  coalesce(expected_units, 0) + coalesce(prev_expected, 0) AS expected,
                  coalesce(hour_units, 0) + coalesce(prev_hours, 0) AS hours FROM {t}months)""",
        f"{t}ratio": f"""SELECT *, CASE WHEN days >= 28 AND calendar_month <> 0 AND expected_units > 0
            THEN (2000 * prorated_units + expected_units) // (2 * expected_units) END AS sda_units
            FROM {t}prorated""",
    }


VIEWS["daily"] = f"""SELECT auth_no, event_date, CAST(sum(minutes * 1000000 // 60) AS BIGINT) AS micro_hrs
    FROM service WHERE event_date BETWEEN {LS} AND {LE} AND minutes > 0 AND source_id NOT IN (3, 6, 7, 8)
    GROUP BY ALL"""
VIEWS |= _dose_views("a_", "all_members") | _dose_views("q_", "pop")


def _link_views(tag: str, strata: str, ratios: str) -> dict[str, str]:
    """Linkage over one stratum table and one ratio table."""
    t = tag
    return {
        f"{t}cand": f"""SELECT a.kcid, a.auth_no, a.agency_id, a.start_date, a.expire_date,
            {_focus('a.program', False)} AS tx_focus, s.au_stratum_id, s.start_date AS phs_start_date,
            s.end_date AS phs_end_date, s.age_group, s.strat_level, s.sda_rule
            FROM auth a JOIN {strata} s ON a.auth_no = s.auth_no
            WHERE s.stratum_sda_id IS NULL AND s.start_date >= {SINCE_SQL}
              AND a.program IN ('2X1','3A1','S01','400','401')""",
        f"{t}current": f"""SELECT c.*, r.stratum_sda_id, r.enroll_days FROM {t}cand c LEFT JOIN {ratios} r
            ON r.auth_no = c.auth_no AND CAST(r.end_date + 1 + INTERVAL 1 MONTH AS DATE) = c.phs_start_date
            QUALIFY row_number() OVER (PARTITION BY au_stratum_id ORDER BY r.stratum_sda_id DESC NULLS LAST) = 1""",
        f"{t}first": f"""SELECT auth_no, strat_level AS first_strat,
            CASE WHEN start_date = DATE '2019-09-01' THEN DATE '2020-01-01'
                 ELSE CAST(start_date + INTERVAL 3 MONTH AS DATE) END AS strat_check_end FROM {strata}
            QUALIFY row_number() OVER (PARTITION BY auth_no ORDER BY start_date, au_stratum_id) = 1""",
        f"{t}last": f"""SELECT auth_no, strat_level AS last_strat, stratum_sda_id AS last_stratum_sda_id
            FROM {strata} WHERE au_stratum_id NOT IN (SELECT au_stratum_id FROM {t}cand)
            QUALIFY row_number() OVER (PARTITION BY auth_no ORDER BY start_date DESC, au_stratum_id DESC) = 1""",
        f"{t}latest": f"""SELECT auth_no, strat_level AS pqd_strat, stratum_sda_id AS pqd_sda_id FROM {strata}
            QUALIFY row_number() OVER (PARTITION BY auth_no ORDER BY start_date DESC, au_stratum_id DESC) = 1""",
        f"{t}prior": f"""SELECT c.*, p.auth_no AS prev_auth_no, p.expire_date AS prev_auth_end
            FROM {t}cand c LEFT JOIN auth p ON p.kcid = c.kcid AND p.agency_id = c.agency_id
            AND p.program IN ('2X1','3A1','S01','400','401') AND {_focus('p.program', False)} = c.tx_focus
            AND p.auth_no <> c.auth_no AND p.status_code IN ('AA','TM')
            AND c.start_date - p.expire_date BETWEEN 0 AND 90
            QUALIFY row_number() OVER (PARTITION BY au_stratum_id
                                       ORDER BY p.expire_date DESC NULLS LAST, p.auth_no DESC) = 1""",
        f"{t}facts": f"""SELECT c.*, first_strat, strat_check_end, last_strat, last_stratum_sda_id,
            prev_auth_no, prev_auth_end, pqd_strat, pqd_sda_id
            FROM {t}current c LEFT JOIN {t}first f ON f.auth_no = c.auth_no
            LEFT JOIN {t}last l ON l.auth_no = c.auth_no
            LEFT JOIN (SELECT au_stratum_id, prev_auth_no, prev_auth_end FROM {t}prior) p USING (au_stratum_id)
            LEFT JOIN {t}latest q ON q.auth_no = prev_auth_no""",
        f"{t}ruled": f"""SELECT *, CASE WHEN new_sda_rule = 'PQD' THEN pqd_sda_id ELSE stratum_sda_id END
            AS new_stratum_sda_id FROM (SELECT *, CASE
            WHEN coalesce(first_strat <> pqd_strat AND phs_start_date <= strat_check_end, false)
              OR coalesce(last_strat <> strat_level, false) THEN 'FPC'
            WHEN enroll_days >= 31 THEN 'NOR' WHEN pqd_sda_id IS NOT NULL THEN 'PQD' ELSE 'FPN' END
            AS new_sda_rule FROM {t}facts)""",
        f"{t}paid": f"""SELECT r.*, x.sda AS new_sda, CAST(CASE WHEN new_sda_rule IN ('NOR','PQD')
            THEN coalesce((SELECT max(sda_pay_multiplier) FROM cd_stratum_pay_corridor c
                 WHERE {_focus('c.program', True)} = r.tx_focus AND c.age_group = r.age_group
                 AND x.sda BETWEEN sda_low AND sda_high), 1) ELSE 1 END AS DECIMAL(6,3)) AS new_sda_pay_multiplier
            FROM {t}ruled r LEFT JOIN {ratios} x ON x.stratum_sda_id = r.new_stratum_sda_id""",
        f"{t}applied": f"""SELECT s.* REPLACE (
            CASE WHEN p.au_stratum_id IS NULL THEN s.sda_rule ELSE new_sda_rule END AS sda_rule,
            CASE WHEN p.au_stratum_id IS NULL THEN s.sda_pay_multiplier ELSE new_sda_pay_multiplier END
                AS sda_pay_multiplier,
            CASE WHEN p.au_stratum_id IS NULL THEN s.modify_stamp ELSE {NOW} END AS modify_stamp,
            CASE WHEN p.au_stratum_id IS NULL THEN s.stratum_sda_id ELSE new_stratum_sda_id END AS stratum_sda_id)
            FROM {strata} s LEFT JOIN (SELECT au_stratum_id, new_sda_rule, new_sda_pay_multiplier,
            new_stratum_sda_id FROM {t}paid) p ON p.au_stratum_id = s.au_stratum_id""",
    }


VIEWS |= _link_views("h_", "au_stratum", "au_stratum_sda")
VIEWS |= {
    # --- publishing -------------------------------------------------------------------
    "complete": f"""SELECT l.* EXCLUDE (start_date, expire_date), prev_auth_no,
        coalesce(calendar_month, 0) AS calendar_month, CAST(coalesce(days, 0) AS INTEGER) AS enroll_days,
        {_milli('coalesce(r.expected_units, 0)')} AS hrs_expected, {_milli('coalesce(hours, 0)')} AS svc_hrs,
        {_milli('coalesce(prorated_units, 0)')} AS svc_hrs_prorated, {_milli('sda_units')} AS sda
        FROM leveled l LEFT JOIN q_ratio r ON r.kcid = l.kcid AND r.auth_no = l.auth_no
        AND r.program = l.program AND r.age_group IS NOT DISTINCT FROM l.age_group""",
    "stratum_rows": """SELECT auth_no, calc_date, phs_start_date AS start_date, phs_end_date AS end_date,
        total_score, strat_level, age_group, special_population, language_differential, missing_data,
        'NNN' AS override_status FROM complete""",
    "new_strata": f"""SELECT (SELECT max(au_stratum_id) FROM au_stratum)
        + row_number() OVER (ORDER BY start_date, auth_no) AS au_stratum_id,
        auth_no, calc_date, start_date, end_date, total_score, strat_level, age_group, special_population,
        language_differential, CAST(1 AS DECIMAL(6,3)) AS sda_pay_multiplier, missing_data, override_status,
        {NOW} AS post_stamp, 'SHA' AS sda_rule, CAST(NULL AS TIMESTAMP) AS modify_stamp,
        CAST(NULL AS BIGINT) AS stratum_sda_id FROM stratum_rows""",
    "sda_rows": f"""SELECT auth_no, {LS} AS start_date, {LE} AS end_date, sda, enroll_days, hrs_expected,
        svc_hrs, svc_hrs_prorated, prev_auth_no FROM complete""",
    "new_sda": f"""SELECT (SELECT max(stratum_sda_id) FROM au_stratum_sda)
        + row_number() OVER (ORDER BY start_date, auth_no) AS stratum_sda_id,
        * EXCLUDE (prev_auth_no), {NOW} AS post_stamp, CAST(NULL AS TIMESTAMP) AS modify_stamp, prev_auth_no
        FROM sda_rows""",
    "published_scores": f"""SELECT au_stratum_id, 'LOCUS' AS metric, total_score AS value, total_score AS score,
        missing_data, 'N' AS override_ind, post_stamp, modify_stamp FROM au_stratum
        UNION ALL BY NAME SELECT *, {NOW} AS post_stamp, CAST(NULL AS TIMESTAMP) AS modify_stamp FROM score_rows""",
    "published_ratios": f"""SELECT stratum_sda_id, auth_no, start_date, end_date, sda, enroll_days,
        CAST(0 AS DECIMAL(18,3)) AS hrs_expected, CAST(0 AS DECIMAL(18,3)) AS svc_hrs,
        CAST(0 AS DECIMAL(18,3)) AS svc_hrs_prorated, CAST(end_date AS TIMESTAMP) AS post_stamp,
        CAST(NULL AS TIMESTAMP) AS modify_stamp, CAST(NULL AS BIGINT) AS prev_auth_no FROM au_stratum_sda
        UNION ALL BY NAME SELECT * FROM new_sda""",
    "published_shadow": f"""SELECT * FROM au_stratum WHERE start_date < {QS}
        UNION ALL BY NAME SELECT * FROM n_applied WHERE au_stratum_id NOT IN (
            SELECT au_stratum_id FROM au_stratum WHERE start_date < {QS})""",
    "all_strata": "SELECT * FROM au_stratum UNION ALL BY NAME SELECT * FROM new_strata",
    "all_ratios": """SELECT stratum_sda_id, auth_no, end_date, sda, enroll_days FROM au_stratum_sda
        UNION ALL BY NAME SELECT stratum_sda_id, auth_no, end_date, sda, enroll_days FROM new_sda""",
    "score_rows": f"""SELECT au_stratum_id, metric, value, score, missing_data, 'N' AS override_ind
        FROM lines LEFT JOIN (SELECT au_stratum_id, auth_no FROM all_strata
                              WHERE {QS} BETWEEN start_date AND end_date) USING (auth_no)
        WHERE metric <> 'CHRON'""",
}
VIEWS |= _link_views("n_", "all_strata", "all_ratios")


def resolve(select: str) -> str:
    """Prefix a SELECT with every view it needs, directly or through other views."""
    names = list(VIEWS)
    uses = {n: set(re.findall(r"[A-Za-z_]\w*", VIEWS[n])) & set(names) - {n} for n in names}
    needed: list[str] = []

    def visit(name: str) -> None:
        for used in sorted(uses[name]):
            visit(used)
        if name not in needed:
            needed.append(name)

    for name in names:
        if re.search(rf"\b{name}\b", select):
            visit(name)
    views = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    return f"WITH {views}\n{select}" if needed else select
