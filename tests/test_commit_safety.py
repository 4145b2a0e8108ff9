import os

import pytest

from tablesync.plans.sinks import CommitConflict, TableFamily
from tablesync.session import create_file, path_exists


def rows(spark, *keys, v=1):
    return spark.createDataFrame([(k, v) for k in keys], "jira string, v int")


def state(family):
    return sorted((r.jira, r.v) for r in family.read("t").collect())


@pytest.fixture()
def family(spark, tmp_root):
    out = TableFamily(spark, os.path.join(tmp_root, "f"))
    out.commit([out.stage("t", rows(spark, "1", "2"))])
    return out


def test_a_number_is_committed_once(spark, family):
    other = TableFamily(spark, family.root)
    staged = family.stage("t", rows(spark, "3"))
    create_file(spark, f"{family.claims}/{other.last_commit() + 1}")  # another driver's claim
    with pytest.raises(CommitConflict):
        family.commit([staged])
    assert state(other) == [("1", 1), ("2", 1)]


def test_a_stale_writer_fails_instead_of_losing_an_update(spark, family):
    other = TableFamily(spark, family.root)
    keys = rows(spark, "1").select("jira")
    mine = family.stage_upsert("t", keys, rows(spark, "1", v=2))
    theirs = other.stage_upsert("t", keys, rows(spark, "1", v=3))
    other.commit([theirs])
    with pytest.raises(CommitConflict):
        family.commit([mine])
    assert state(family) == [("1", 3), ("2", 1)]
    again = family.stage_upsert("t", keys, rows(spark, "1", v=2))
    family.commit([again])
    assert state(family) == [("1", 2), ("2", 1)]


def test_vacuum_leaves_staged_work(spark, family):
    keys = rows(spark, "1").select("jira")
    staged = family.stage_upsert("t", keys, rows(spark, "1", v=2))
    TableFamily(spark, family.root).vacuum(retain_commits=0)
    family.commit([staged])
    assert state(family) == [("1", 2), ("2", 1)]


def test_untouched_tables_keep_their_folders(spark, family):
    family.commit([family.stage("u", rows(spark, "9"))])
    before = family.current()["u"]
    keys = rows(spark, "1").select("jira")
    staged = [family.stage_upsert(t, keys, rows(spark, "1", v=2) if t == "t" else None) for t in ("t", "u")]
    family.commit([s for s in staged if s is not None])
    assert family.current()["u"] == before
    assert all(path_exists(spark, p) for p in before)


def test_a_dead_claim_does_not_block_the_family(spark, family):
    create_file(spark, f"{family.claims}/{family.last_commit() + 1}")  # its writer died before the commit
    restarted = TableFamily(spark, family.root, claim_minutes=0)
    n = restarted.commit([restarted.stage("t", rows(spark, "3"))])
    assert state(restarted) == [("3", 1)] and n == family.last_commit() == 2


def test_two_users_of_the_case_setting(spark):
    from tablesync.session import case_sensitive

    key = "spark.sql.caseSensitive"
    first, second = case_sensitive(spark), case_sensitive(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(key) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(key) == "false"
