"""The domain's tables as views over the driver's tables, every row of them.

Persons are groups of three customers, authorizations are orders, services are line
items, and assessments, stays, claims and residences are events, moved back 25 years so
that they fall into the quarter of the checks.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.config import CONFIG_TABLES, config_sql
from doseline.session import Stages
from doseline.sources.schemas import TABLES
from doseline.sources.tables import conform, trim_codes

QUARTERS = [  # stratified quarter and the look-back of its ratio
    ("1998-07-01", "1998-09-30", "1998-03-01", "1998-05-31"),
    ("1998-10-01", "1998-12-31", "1998-06-01", "1998-08-31"),
    ("1999-01-01", "1999-03-31", "1998-09-01", "1998-11-30"),
]
LONG_AGO = 5000  # days that put a date before every look-back
STRATIFIED_EARLY = 450000  # orders above this price already have the current quarter
CLAIM_CODES = (
    "'ccw_diabetes', 'ccw_ischemic_heart_dis', 'ccw_mi', 'ccw_hypertension', 'ccw_stroke', "
    "'ccw_hyperlipid', 'ccw_heart_failure', 'ccw_atrial_fib', 'ccw_asthma', 'ccw_copd', 'ccw_other'"
)


class Proxies:
    """Domain tables by name, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._built: dict[str, DataFrame] = {}
        self._stages: Stages | None = None

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in CONFIG_TABLES:
                df = trim_codes(self.spark.sql(config_sql(name)))
            else:
                df = getattr(self, f"_{name}")()
            self._built[name] = conform(df, name) if name in TABLES else df
        return self._built[name]

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return self.stages().keep(df, name)

    def stages(self) -> Stages:
        """The shared folder of the cluster; a temporary one in local mode only."""
        if self._stages is None:
            named = self.spark.conf.get("spark.checkpoint.dir", None)
            if not named and self.spark.sparkContext.master.startswith("local["):
                named = tempfile.mkdtemp(prefix="doseline-checks-")
            self._stages = Stages(self.spark, named)
        return self._stages

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A step that several others read, written to scratch the first time."""
        if name not in self._built:
            self._built[name] = self.keep(build(), name)
        return self._built[name]

    def all(self) -> dict[str, DataFrame]:
        """Every declared table, for the end-to-end job."""
        return {name: self[name] for name in TABLES}

    def raw(self, name: str) -> DataFrame:
        key = f"raw:{name}"
        if key not in self._built:
            self._built[key] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._built[key]

    def _events(self, kind: str) -> DataFrame:
        return (
            self.raw("events")
            .where(F.col("event_type") == kind)
            .selectExpr(
                "event_id",
                "(user_id * 10 + event_id % 10) div 3 AS kcid",
                "value",
                "dayofmonth(ts) AS dom",
                "add_months(CAST(ts AS DATE), -300) AS day",
            )
        )

    # Population and history -----------------------------------------------------------

    def _auth(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_custkey div 3 AS kcid",
            "o_orderkey AS auth_no",
            "CAST(o_orderkey % 3 AS INT) AS agency_id",
            "CAST(o_orderdate AS DATE) AS start_date",
            """CASE WHEN o_orderkey % 11 <> 0
               THEN date_add(CAST(o_orderdate AS DATE), CAST(30 + o_orderkey % 370 AS INT)) END
               AS expire_date""",
            """CASE o_orderpriority WHEN '1-URGENT' THEN '400' WHEN '2-HIGH' THEN '401'
               WHEN '3-MEDIUM' THEN '2X1' WHEN '4-NOT SPECIFIED' THEN '3A1' ELSE 'S01' END
               AS program""",
            """CASE o_orderstatus WHEN 'O' THEN 'AA' WHEN 'F' THEN 'TM' ELSE 'PN' END
               AS status_code""",
            "o_orderdate AS post_stamp",
            """CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 'ID'
               ELSE 'OK' END AS data_status""",
            "o_totalprice AS price",
        )

    def _au_master(self) -> DataFrame:
        return self["auth"]

    def _crisis_au_master(self) -> DataFrame:
        remapped = """CASE program WHEN '400' THEN 'SRS' WHEN '401' THEN 'DTX'
                      WHEN '2X1' THEN 'IP' ELSE program END"""
        return self["auth"].withColumn("program", F.expr(remapped))

    def _persons(self) -> DataFrame:
        return self.raw("customer").groupBy(F.expr("c_custkey div 3 AS kcid")).agg(
            F.min("c_custkey").alias("first_key")
        )

    def _g_person(self) -> DataFrame:
        return self["persons"].selectExpr(
            "kcid", "date_add(DATE '1950-01-01', CAST(first_key * 7919 % 17900 AS INT)) AS dob"
        )

    def _g_p1_client(self) -> DataFrame:
        return self["persons"].selectExpr(
            "kcid", "CASE WHEN kcid % 7 <> 0 THEN concat('P', kcid) END AS p1_id"
        )

    def _au_initial_plan(self) -> DataFrame:
        return self["auth"].selectExpr(
            "auth_no",
            """CASE auth_no % 4 WHEN 0 THEN 'F19' WHEN 1 THEN 'MID' WHEN 2 THEN 'OTH' END AS plan""",
        )

    def _rated(self) -> DataFrame:
        """Authorizations with their case-rate attributes, all of one order's row."""
        return self["auth"].selectExpr(
            "*",
            """CASE WHEN kcid % 50 = 7 THEN NULL WHEN kcid % 3 = 0 THEN 'A'
               WHEN kcid % 3 = 1 THEN 'C' ELSE 'G' END AS age_group""",
            "CASE WHEN price > 300000 THEN 'SP' END AS special_population",
            "CASE WHEN agency_id = 1 THEN 'Y' ELSE 'N' END AS language_differential",
        )

    def _case_rate(self) -> DataFrame:
        return self["rated"]

    def _quarter_rows(self) -> DataFrame:
        """Authorizations by the quarters they were stratified in."""
        structs = ", ".join(
            f"struct({n} AS n, DATE '{start}' AS q_start, DATE '{end}' AS q_end, "
            f"DATE '{b_start}' AS b_start, DATE '{b_end}' AS b_end)"
            for n, (start, end, b_start, b_end) in enumerate(QUARTERS)
        )
        return (
            self["rated"]
            .selectExpr("*", f"inline(array({structs}))")
            .where("start_date <= q_end AND coalesce(expire_date, DATE '2099-12-31') >= q_start")
            .where((F.col("n") < 2) | (F.col("price") > STRATIFIED_EARLY))
        )

    def _au_stratum(self) -> DataFrame:
        return self["quarter_rows"].selectExpr(
            "auth_no * 4 + n AS au_stratum_id",
            "auth_no",
            "q_start AS calc_date",
            "q_start AS start_date",
            "q_end AS end_date",
            "auth_no % 40 AS total_score",
            """CASE (auth_no + CASE WHEN auth_no % 5 = 0 THEN n ELSE 0 END) % 3
               WHEN 0 THEN 'L' WHEN 1 THEN 'M' ELSE 'H' END AS strat_level""",
            "age_group",
            "special_population",
            "language_differential",
            "CASE WHEN n = 0 THEN 0.925 ELSE 1 END AS sda_pay_multiplier",
            "'N' AS missing_data",
            "'NNN' AS override_status",
            "CAST(q_start AS TIMESTAMP) AS post_stamp",
            "CASE WHEN n = 0 THEN 'NOR' ELSE 'SHA' END AS sda_rule",
            "CAST(NULL AS TIMESTAMP) AS modify_stamp",
            """CASE WHEN n = 0 AND auth_no % 7 <> 0 THEN auth_no * 4
               WHEN n = 1 AND auth_no % 4 <> 0 THEN auth_no * 4 + 1 END AS stratum_sda_id""",
        )

    def _au_stratum_shadow(self) -> DataFrame:
        return self["au_stratum"].where(F.col("start_date") < F.lit("1999-01-01").cast("date"))

    def _au_stratum_sda(self) -> DataFrame:
        return self["quarter_rows"].selectExpr(
            "auth_no * 4 + n AS stratum_sda_id",
            "auth_no",
            "b_start AS start_date",
            "b_end AS end_date",
            """CASE WHEN (auth_no * 37 + n) % 93 >= 28
               THEN CAST((auth_no * 13 + n * 101) % 1500 AS DECIMAL(18,3)) * 0.001 END AS sda""",
            "CAST((auth_no * 37 + n) % 93 AS INT) AS enroll_days",
            "CAST(0 AS DECIMAL(18,3)) AS hrs_expected",
            "CAST(0 AS DECIMAL(18,3)) AS svc_hrs",
            "CAST(0 AS DECIMAL(18,3)) AS svc_hrs_prorated",
            "CAST(b_end AS TIMESTAMP) AS post_stamp",
            "CAST(NULL AS TIMESTAMP) AS modify_stamp",
            "CAST(NULL AS BIGINT) AS prev_auth_no",
        )

    def _au_stratum_score(self) -> DataFrame:
        return self["au_stratum"].selectExpr(
            "au_stratum_id", "'LOCUS' AS metric", "total_score AS value", "total_score AS score",
            "missing_data", "'N' AS override_ind", "post_stamp", "modify_stamp",
        )

    # Risk inputs ----------------------------------------------------------------------

    def _assessments(self, kind: str) -> DataFrame:
        return self._events(kind).selectExpr(
            "kcid",
            "CAST(event_id % 3 AS INT) AS agency_id",
            "date_add(day, CAST(event_id * 7 % 240 - 90 AS INT)) AS event_date",
            "event_id AS record_id",
            "CASE WHEN event_id % 29 <> 0 THEN CAST(floor(value) AS INT) END AS composite_score",
        )

    def _ep_locus(self) -> DataFrame:
        return self._assessments("click")

    def _ep_calocus(self) -> DataFrame:
        return self._assessments("view")

    def _ep_residence(self) -> DataFrame:
        return self._events("signup").selectExpr(
            "kcid",
            """CASE event_id % 5 WHEN 0 THEN '26' WHEN 1 THEN '46' WHEN 2 THEN '82'
               WHEN 3 THEN '82' ELSE '10' END AS resid_arrng_code""",
            "date_add(DATE '1998-12-25', dom % 8 * 8) AS start_date",
        )

    def _ep_coverage_mco(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey div 3 AS kcid",
            "CASE WHEN c_mktsegment = 'BUILDING' THEN 'FOSTR' ELSE 'OTHER' END AS plan_type",
            "date_add(DATE '1998-06-01', CAST(c_custkey % 400 AS INT)) AS start_date",
        )

    def _mcaid_claim_ccw(self) -> DataFrame:
        return self._events("purchase").selectExpr(
            "concat('P', kcid) AS id_mcaid",
            f"element_at(array({CLAIM_CODES}), CAST(event_id % 11 + 1 AS INT)) AS ccw_desc",
            "date_add(day, CAST(event_id % 60 - 30 AS INT)) AS from_date",
        )

    def _mcaid_elig_timevar(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "concat('P', c_custkey div 3) AS id_mcaid",
            """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN DATE '1994-01-01'
               WHEN 'MACHINERY' THEN DATE '1998-01-01' WHEN 'FURNITURE' THEN DATE '1997-06-01'
               WHEN 'BUILDING' THEN DATE '1980-01-01' ELSE DATE '1990-01-01' END AS from_date""",
            """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN DATE '1996-06-30'
               WHEN 'MACHINERY' THEN DATE '1999-12-31' WHEN 'FURNITURE' THEN DATE '1997-12-31'
               WHEN 'BUILDING' THEN DATE '1985-12-31' ELSE DATE '2005-12-31' END AS to_date""",
        )

    def _mcaid_claim_header(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "concat('P', o_custkey div 3) AS id_mcaid",
            f"""date_sub(CAST(o_orderdate AS DATE),
                CASE o_orderpriority WHEN '1-URGENT' THEN 0 ELSE {LONG_AGO} END) AS first_service_date""",
        )

    def _ma_cond_ass(self) -> DataFrame:
        return self["auth"].selectExpr(
            "auth_no",
            """CASE CASE WHEN price > 150000 THEN auth_no % 10 ELSE 9 END WHEN 0 THEN '152' WHEN 1 THEN '153' WHEN 2 THEN '154'
               WHEN 3 THEN '155' ELSE '999' END AS condition_code""",
        )

    def _ip_master(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "l_orderkey AS auth_no",
            """CASE WHEN l_linenumber % 4 = 3 THEN NULL WHEN l_linenumber % 4 = 0 THEN ''
               WHEN l_returnflag = 'A' THEN 'I' ELSE 'V' END AS ip_type""",
        )

    def _cmt_hospital_report(self) -> DataFrame:
        return self._events("view").selectExpr(
            "kcid",
            """CASE event_id % 3 WHEN 0 THEN 'Emergency' WHEN 1 THEN 'Inpatient'
               ELSE 'Observation' END AS major_class""",
            "date_add(day, CAST(event_id * 7 % 700 - 500 AS INT)) AS admit_date",
        )

    def _ep_jail(self) -> DataFrame:
        ago = f"CASE program WHEN 'S01' THEN 0 ELSE {LONG_AGO} END"
        return self["auth"].selectExpr(
            "kcid", f"date_sub(start_date, {ago}) AS book_date", f"date_sub(expire_date, {ago}) AS release_date"
        )

    def _muni_jail(self) -> DataFrame:
        started = self._events("error").withColumn(
            "booking_start", F.expr("date_add(day, -CAST(event_id * 11 % 2500 AS INT))")
        )
        return started.selectExpr(
            "CASE WHEN event_id % 13 <> 0 THEN kcid END AS kcid_match",
            "booking_start",
            """CASE WHEN event_id % 5 = 0 THEN NULL
               WHEN event_id % 37 = 0 THEN date_add(booking_start, -3)
               ELSE date_add(booking_start, CAST(floor(value / 2) AS INT)) END AS booking_end""",
        )

    def _ep_asam_placement(self) -> DataFrame:
        return self._events("click").selectExpr(
            "kcid",
            "CAST(event_id % 3 AS INT) AS agency_id",
            "date_add(day, CAST(event_id * 11 % 900 - 800 AS INT)) AS event_date",
            "CASE WHEN event_id % 7 > 0 THEN 'OP' ELSE 'IP' END AS event_type",
            "event_id AS record_id",
            """CASE event_id % 4 WHEN 0 THEN '2.1-WM' WHEN 1 THEN 'OTP' WHEN 2 THEN '1'
               ELSE ' 3.5 ' END AS level_indicated""",
        )

    def _ep_substance_use(self) -> DataFrame:
        return self._events("error").selectExpr(
            "kcid",
            "CAST(1 + event_id % 3 AS INT) AS method",
            "date_add(day, CAST(event_id * 13 % 500 - 450 AS INT)) AS event_date",
        )

    def _ea_cpt_service(self) -> DataFrame:
        orders = self.raw("orders").select("o_orderkey", "o_orderdate")
        items = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
        return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
            "l_orderkey AS auth_no",
            "date_add(CAST(o_orderdate AS DATE), CAST(l_partkey % 200 AS INT)) AS event_date",
            "CAST(l_quantity AS INT) - 2 AS service_minutes",
            "l_linenumber AS source_id",
        )

    def _members(self) -> DataFrame:
        """Every authorization as a member of the dose calculation."""
        return self["rated"].select("kcid", "auth_no", "program", "age_group")
