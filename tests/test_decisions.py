"""The resolver and the gates against plain Python over every combination of inputs."""

import datetime as dt
import itertools

from tidemark.operators import decisions, gates

WM = dt.datetime(2020, 5, 5)


def expected(state, last, delete_after, owned, wiped, mark, new, failed, live):
    if state == "MISSING" and last == "ARCHIVED_AND_DELETED":
        return "ERROR", "missing_folder_after_delete"
    if state == "ORPHAN" or (state == "VALID" and last is None):
        return "ERROR", "archive_folder_orphan"
    if state == "VALID" and last == "ARCHIVED_AND_DELETED":
        return "SKIP", None
    if state == "MISSING" or wiped:
        return "CREATE", None
    if last == "ARCHIVED" and delete_after and owned:
        return "RESUME_DELETE", None
    if mark is None:
        return "ERROR", "cannot_determine_incremental_position"
    if new == 0:
        return "SKIP", None
    if live and failed:
        return "ERROR", "verify_failed_requires_reconcile"
    return "APPEND", None


def test_every_combination(spark):
    flag = (True, False)
    cases = list(
        itertools.product(
            ("VALID", "MISSING", "ORPHAN"),
            (None, "ARCHIVED", "ARCHIVED_AND_DELETED", "RECOVERY_ARCHIVE_ROLLED_BACK"),
            flag, flag, flag, (WM, None), (0, 3), flag,
        )
    )
    rows = [(i, *c, 7) for i, c in enumerate(cases)]
    state = spark.createDataFrame(
        rows,
        "id INT, slice_state STRING, last_status STRING, delete_after BOOLEAN, owned BOOLEAN, "
        "wiped_since BOOLEAN, high_water TIMESTAMP_NTZ, new_rows BIGINT, verify_failed BOOLEAN, kept_rows BIGINT",
    )
    for live in flag:
        got = decisions.resolve(state, live).orderBy("id").collect()
        for case, r in zip(cases, got):
            want = expected(*case, live)
            assert (r.action, r.reason) == want, (case, live)
            assert r.would_archive == {"CREATE": 7, "APPEND": case[6]}.get(r.action, 0)


def test_rollback_gate_order(spark):
    """Each request passes all gates before the one it fails."""
    t0 = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame(
        [
            ("ok", "t", 2020, "ARCHIVED", t0, 1),
            ("status", "t", 2020, "FAILED", None, None),
            ("time", "t", None, "ARCHIVED", None, None),
            ("year", "t", None, "ARCHIVED", t0, None),
            ("deleted", "t", 2021, "ARCHIVED", t0, None),
            ("gone", "t", 2021, "ARCHIVED_AND_DELETED", t0 + dt.timedelta(hours=1), None),
            ("version", "t", 2022, "ARCHIVED", t0, None),
            ("state", "t", 2022, "ARCHIVED", t0, 5),
            ("vacuumed", "t", 2020, "RECOVERY_ARCHIVE_ROLLED_BACK", t0, 9),
        ],
        "audit_id STRING, table_name STRING, year INT, status STRING, created_at TIMESTAMP, archive_delta_version BIGINT",
    )
    states = spark.createDataFrame(
        [("t", 2020, "VALID"), ("t", 2021, "VALID"), ("t", 2022, "MISSING")], "table_id STRING, year INT, slice_state STRING"
    )
    reachable = spark.createDataFrame([("t", 2020, 1)], "table_id STRING, year INT, version BIGINT")
    wanted = {
        ("ok", "t", 2020): None,
        ("none", "t", 2020): "target_not_found",
        ("ok", "u", 2020): "target_wrong_table",
        ("status", "t", 2020): "target_status_not_rollbackable",
        ("time", "t", 2020): "target_missing_created_at",
        ("year", "t", 2020): "target_missing_year",
        ("ok", "t", 2021): "target_wrong_year",
        ("deleted", "t", 2021): "rollback_after_source_delete_refused",
        ("version", "t", 2022): "target_missing_version",
        ("state", "t", 2022): "target_version_unavailable",
        ("vacuumed", "t", 2020): "target_version_vacuumed",
    }
    requests = spark.createDataFrame(list(wanted), "target_audit_id STRING, table_id STRING, year INT")
    got = {
        (r.target_audit_id, r.table_id, r.year): r.refused_by
        for r in gates.rollback_gates(requests, log, states, reachable).collect()
    }
    assert got == wanted


def test_wipe_gate_order(spark):
    log = spark.createDataFrame([("t", 2020, "ARCHIVED_AND_DELETED")], "table_name STRING, year INT, status STRING")
    states = spark.createDataFrame(
        [("t", 2020, "VALID", 5, 0), ("t", 2021, "VALID", 6, 0), ("t", 2022, "ORPHAN", 0, None)],
        "table_id STRING, year INT, slice_state STRING, row_count BIGINT, version BIGINT",
    )
    requests = spark.createDataFrame(
        [("t", 2020, " "), ("t", 2020, "r"), ("t", 2021, "r"), ("t", 2021, None), ("t", 2022, "r"), ("t", 2023, "r")],
        "table_id STRING, year INT, wipe_reason STRING",
    )

    def refused(live):
        rows = gates.wipe_gates(requests, log, states, live).collect()
        return {(r.year, r.wipe_reason): r.refused_by for r in rows}

    blocked = "delete_archived_after_source_delete_refused"
    gone = "delete_archived_target_missing"
    assert refused(True) == {
        (2020, " "): "reason_required", (2020, "r"): blocked, (2021, "r"): None,
        (2021, None): "reason_required", (2022, "r"): gone, (2023, "r"): gone,
    }
    assert refused(False) == {
        (2020, " "): blocked, (2020, "r"): blocked, (2021, "r"): None, (2021, None): None,
        (2022, "r"): gone, (2023, "r"): gone,
    }
