"""Tables dealt by a key when they are ingested are joined on it without a shuffle."""

from __future__ import annotations

from datetime import date

import pytest
from checks.config import CALC, Q_END, Q_START
from checks.proxies import Proxies
from conftest import rows
from pyspark.sql import functions as F

from doseline.operators import population
from doseline.sources.tables import add_changes, append_rows, fold_changes, ingest_table, read_table

SMALL = "/root/testdata/sf0.001"
DEALT = ("au_master", "au_initial_plan", "case_rate", "g_person", "g_p1_client")
BUCKETS = 4


@pytest.fixture(scope="module")
def roots(spark, tmp_path_factory):
    """The same tables ingested plainly and in buckets."""
    t = Proxies(spark, SMALL)
    plain, dealt = (str(tmp_path_factory.mktemp(n)) for n in ("plain", "it's dealt"))
    for name in DEALT:
        ingest_table(t[name], plain, name)
        ingest_table(t[name], dealt, name, BUCKETS)
    for root in (plain, dealt):
        append_rows(t["au_stratum"], root, "au_stratum")
    return plain, dealt


@pytest.fixture
def shuffled(spark):
    """Every join as it is planned for tables too large to be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def selected(spark, root):
    t = {name: read_table(spark, root, name) for name in (*DEALT, "au_stratum")}
    return population.select_population(
        t["au_master"], t["g_person"], t["au_initial_plan"], t["case_rate"], t["au_stratum"],
        t["g_p1_client"], Q_START, Q_END, CALC,
    )


def exchanges(df) -> list[str]:
    tree = df._jdf.queryExecution().executedPlan().treeString()
    return [line.strip(" +-:") for line in tree.splitlines() if "Exchange" in line]


def test_the_population_is_dealt_once_and_dealt_tables_never(spark, roots, shuffled):
    plain, dealt = (selected(spark, root) for root in roots)  # not run yet: the plans as first made
    # One quarter's strata come to the authorizations, and what was selected goes to the persons.
    assert len(exchanges(plain)) == 7 and len(exchanges(dealt)) == 2, exchanges(dealt)
    tree = dealt._jdf.queryExecution().executedPlan().treeString()
    assert tree.count("Bucketed: true") == len(DEALT)
    assert rows(dealt) == rows(plain) != []


def test_filters_and_columns_reach_the_scan(spark, roots):
    auth = read_table(spark, roots[1], "au_master").where("program = '400'").select("auth_no")
    scan = auth._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(program,400)" in scan and "agency_id" not in scan.split("ReadSchema")[1]


def test_a_table_ingested_again_is_read_anew(spark, make, tmp_path):
    root = str(tmp_path)
    ingest_table(make("g_person", (1, "1990-01-01"), (None, None)), root, "g_person", 3)
    first = read_table(spark, root, "g_person")
    assert rows(first, "kcid") == [(1,), (None,)]
    ingest_table(make("g_person", (2, "1990-01-01")), root, "g_person", 5)
    assert rows(read_table(spark, root, "g_person"), "kcid") == [(2,)]
    ingest_table(make("g_person", (3, "1990-01-01")), root, "g_person")  # without buckets
    assert rows(read_table(spark, root, "g_person"), "kcid") == [(3,)]
    ingest_table(make("g_person"), root, "g_person", 2)
    assert rows(read_table(spark, root, "g_person")) == []
    with pytest.raises(ValueError, match="no key"):
        ingest_table(make("ep_jail"), root, "ep_jail", 2)


def test_changes_of_a_dealt_table_and_their_fold(spark, roots, tmp_path, shuffled):
    """After a fold the table is in buckets again; between folds the changed rows are added to it."""
    root, day = str(tmp_path), date(1999, 1, 5)
    t = Proxies(spark, SMALL)
    for name in DEALT:
        ingest_table(t[name], root, name, BUCKETS)
    append_rows(t["au_stratum"], root, "au_stratum")
    closed = t["au_master"].where("auth_no % 5 = 0").withColumn("data_status", F.lit("ID"))
    add_changes(spark, closed, root, "au_master", day)
    want = rows(selected(spark, roots[0]).where("auth_no % 5 <> 0"))
    assert rows(selected(spark, root)) == want != []
    fold_changes(spark, root, "au_master", day)
    assert rows(selected(spark, root)) == want and len(exchanges(selected(spark, root))) == 2
    assert rows(read_table(spark, root, "au_master", as_of=date(1999, 1, 4))) == rows(
        read_table(spark, roots[0], "au_master")
    )
