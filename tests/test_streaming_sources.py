"""Streaming re-aims agree with their batch twins; tape readers and sources behave as the
reference's ingestion tests pin them."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tallyrisk.session import scratch_path
from tallyrisk.sources import files as FS
from tallyrisk.sources import tape as TP
from tallyrisk.streaming import stream as ST

from .conftest import SF_SMALL


def test_stream_windows_equal_batch(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    end = scratch_path(spark, "t-end")
    ST.write_end_marker(ev, end)
    s = ST.stream_delinquency_rate(ST.event_stream(spark, SF_SMALL, ev.schema, "events.parquet", end))
    out = ST.run_available_now(s, scratch_path(spark, "t-x1"), scratch_path(spark, "t-x1c"))
    got = {str(r["window_start"])[:10]: (r["n_events"], r["n_bad"]) for r in out.collect()}
    batch = (ev.groupBy(F.to_date("ts").alias("d"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("event_type") == "error").cast("long")).alias("b")))
    want = {str(r["d"]): (r["n"], r["b"]) for r in batch.collect()}
    assert got == want


def _write(path, lines):
    with open(path, "w", encoding="latin-1") as fh:
        fh.write("\n".join(lines) + "\n")


VALID = "|".join(["720", "012023", "N", "012053", "35620", "", "1", "P", "80", "36", "350000", "80", "6.5",
                  "R", "N", "FRM", "CA", "SF", "90210", "F23Q10000001", "P", "360", "2", "S", "V", "N",
                  "", "", "N", "A", "N", ""])


def test_tape_ingest_quarter_blanks_and_rules(spark):
    d = tempfile.mkdtemp(prefix="tape-")
    _write(os.path.join(d, "historical_data_2023Q1.txt"), [VALID, VALID.replace("720|", "100|", 1)])
    _write(os.path.join(d, "historical_data_2023q2.txt"), [VALID])
    out = TP.ingest_tape(spark, d, "origination", scratch_path(spark, "t-orig"))
    rows = out.orderBy("quarter", "credit_score").collect()
    assert sorted({r["quarter"] for r in rows}) == ["2023Q1", "2023Q2"]
    assert rows[0]["mi_pct"] is None  # blank → NULL
    bad = [r for r in rows if r["credit_score"] == 100.0][0]
    assert "credit_score:range" in bad["violations"]
    assert all(not r["violations"] for r in rows if r["credit_score"] == 720.0)
    only = TP.ingest_tape(spark, d, "origination", scratch_path(spark, "t-orig2"), ["2023q2"])
    assert only.count() == 1


def test_combined_tape_split(spark):
    d = tempfile.mkdtemp(prefix="comb-")
    def row(period, upb):
        f = [""] * 110
        f[1], f[2], f[11], f[3], f[23] = "L00001", period, upb, "R", "700"
        return "|".join(f)
    _write(os.path.join(d, "combined_2025Q1.csv"), [row("012025", "300000"), row("022025", "299500")])
    orig, perf = TP.split_combined_tape(spark, d)
    assert orig.count() == 1 and perf.count() == 2
    assert orig.first()["credit_score"] == "700"


def test_load_source_errors(spark):
    with pytest.raises(ValueError):
        FS.load_source(spark, "excel:/tmp/x")
    with pytest.raises(FileNotFoundError):
        FS.load_source(spark, "parquet:/nonexistent/path/x.parquet")


def test_file_lineage_hashes_match(spark):
    import hashlib

    d = tempfile.mkdtemp(prefix="lin-")
    body = b"a|b|c\n1|2|3\n"
    with open(os.path.join(d, "t.txt"), "wb") as fh:
        fh.write(body)
    r = FS.file_lineage(spark, d).first()
    assert r["size_bytes"] == len(body) and r["sha256"] == hashlib.sha256(body).hexdigest()


@pytest.mark.parametrize("block", [7, 1000, 4096, 1 << 20])
def test_lineage_of_blocks_equals_hashlib(spark, block):
    import hashlib

    d = tempfile.mkdtemp(prefix="lin-")
    bodies = {"one.bin": b"x", "a b%20c.bin": bytes(range(256)) * 16, "odd.bin": b"\r\n\0" * 1111}
    for name, body in bodies.items():
        with open(os.path.join(d, name), "wb") as fh:
            fh.write(body)
    open(os.path.join(d, "empty.bin"), "wb").close()
    tree = {os.path.basename(r.path): r for r in FS.file_lineage_tree(spark, d, block_bytes=block).collect()}
    flat = {os.path.basename(r.path): r for r in FS.file_lineage(spark, d).collect()}
    assert set(tree) == set(flat) == set(bodies)
    for name, body in bodies.items():
        leaves = [hashlib.sha256(body[i:i + block]).digest() for i in range(0, len(body), block)]
        assert (tree[name].size_bytes, tree[name].n_blocks) == (len(body), len(leaves))
        assert tree[name].root_sha256 == hashlib.sha256(b"".join(leaves)).hexdigest()
        assert flat[name].sha256 == hashlib.sha256(body).hexdigest()


def test_summary_markdown_lists_alerts(spark):
    rep = spark.createDataFrame([("feature_drift", "x", "psi", 0.3, "alert"),
                                 ("feature_drift", "y", "psi", 0.01, "ok")],
                                "check string, name string, metric string, value double, severity string")
    text = FS.summary_markdown(rep).first()["markdown"]
    assert "Status: **ALERT**" in text and "feature_drift:x" in text and "| feature_drift | y | psi |" in text


def _combined(loan, month, rate):
    row = [""] * TP.COMBINED_WIDTH
    row[TP.COMBINED_PERF_POSITIONS["loan_sequence_number"]] = loan
    row[TP.COMBINED_PERF_POSITIONS["monthly_reporting_period"]] = month
    row[TP.COMBINED_ORIG_POSITIONS["orig_interest_rate"]] = rate
    return "|".join(row)


def test_combined_tape_keeps_a_loan_per_quarter_and_honours_overwrite(spark):
    d = tempfile.mkdtemp(prefix="combined-")
    _write(os.path.join(d, "2031Q1.csv"), [_combined("Z1", "012031", "5.5"), _combined("Z1", "022031", "5.6")])
    _write(os.path.join(d, "2031Q2.csv"), [_combined("Z1", "042031", "6.5"), _combined("Z2", "042031", "7.5")])
    orig, perf = TP.split_combined_tape(spark, d)
    assert sorted((r.quarter, r.loan_sequence_number, r.orig_interest_rate) for r in orig.collect()) == [
        ("2031Q1", "Z1", "5.5"), ("2031Q2", "Z1", "6.5"), ("2031Q2", "Z2", "7.5")]
    assert perf.count() == 4
    # A classic layout whose quarters do not match produces nothing: the combined tape is read.
    classic = tempfile.mkdtemp(prefix="classic-")
    _write(os.path.join(classic, "2030Q1.txt"), [VALID])
    out = tempfile.mkdtemp(prefix="ingested-")
    got = TP.ingest_all(spark, [classic], [], [d], out, quarters=["2031Q1", "2031Q2"])
    assert got["origination"].count() == 3 and got["performance"].count() == 4
    _write(os.path.join(d, "2031Q2.csv"), [_combined("Z3", "052031", "1.5")])
    spark.catalog.clearCache()
    kept = TP.ingest_all(spark, [], [], [d], out)["origination"]
    assert sorted(r.loan_sequence_number for r in kept.collect()) == ["Z1", "Z1", "Z2"]
    again = TP.ingest_all(spark, [], [], [d], out, overwrite=True)["origination"]
    assert sorted(r.loan_sequence_number for r in again.collect()) == ["Z1", "Z3"]


def test_series_files_are_read_by_their_own_headers(spark):
    from tallyrisk.sources import series as SR
    d = tempfile.mkdtemp(prefix="series-")
    _write(os.path.join(d, "AAA.csv"), ["DATE,AAA", "2031-01-01,1.5", "2031-02-01,."])
    _write(os.path.join(d, "BBB.csv"), ["bbb, date", "7,2031-01-01", "8,2031-02-01"])
    got = {(r.series_id, str(r.date)): r.value for r in SR.read_series_csv(spark, d).collect()}
    assert got == {("AAA", "2031-01-01"): 1.5, ("AAA", "2031-02-01"): None,
                   ("BBB", "2031-01-01"): 7.0, ("BBB", "2031-02-01"): 8.0}
    obs = SR.read_series_csv(spark, d)
    wide = SR.write_macro_monthly(spark, obs, {"AAA": "mean", "BBB": "nonsense"}, os.path.join(d, "wide"))
    assert "AAA" in wide.columns and "BBB" not in wide.columns
    with pytest.raises(ValueError):
        SR.write_macro_monthly(spark, obs, {"BBB": "nonsense"}, os.path.join(d, "none"))


def test_sorted_frames_come_in_order(spark):
    from tallyrisk.plans import q_features, q_policy
    rows = [(r.loan_id, r.reporting_month) for r in q_features.q_panel_sort(spark, SF_SMALL).collect()]
    assert rows == sorted(rows)
    ranked = [(-r.pd, r.id) for r in q_policy.q_portfolio_sort(spark, SF_SMALL).collect()]
    assert ranked == sorted(ranked)


def test_first_row_in_file_order(spark):
    """The first line of a loan wins, though it is not its earliest month and the file is read in many splits."""
    d = tempfile.mkdtemp(prefix="order-")
    lines, first = [], {}
    for k in range(3000):
        loan, rate = f"L{(k * 7919) % 400:03d}", f"{k / 1000:.3f}"
        lines.append(_combined(loan, f"{12 - k % 12:02d}2031", rate))
        first.setdefault(loan, rate)
    _write(os.path.join(d, "2031Q1.csv"), lines)
    _write(os.path.join(d, "2031Q2.csv"), lines[::-1])
    last = {loan: None for loan in first}
    for k in reversed(range(3000)):
        loan = f"L{(k * 7919) % 400:03d}"
        last[loan] = last[loan] or f"{k / 1000:.3f}"
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(20_000))
        orig, perf = TP.split_combined_tape(spark, d)
        assert perf.rdd.getNumPartitions() > 10
        got = {(r.quarter, r.loan_sequence_number): r.orig_interest_rate for r in orig.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == {("2031Q1", k): v for k, v in first.items()} | {("2031Q2", k): v for k, v in last.items()}


def test_quarter_of_is_found_once_per_row_without_needless_regexes(spark):
    from pyspark.sql import functions as F

    from tallyrisk.sources import tape as TP

    rows = [("historical_data_2019q3.txt", "/a/2001Q1/historical_data_2019q3.txt", "2019Q3"),
            ("part-0.c000.csv", "/a/quarter=1996Q2/part-0.c000.csv", "1996Q2"),
            ("quick.tar.gz", "/aq/Q5/quick.tar.gz", "QUICK.TAR"), ("plain", "/b/plain", "PLAIN"),
            ("1999Q12000Q2.txt", "/b/1999Q12000Q2.txt", "1999Q1"), (".hidden", "/b/.hidden", ""), (None, "/1998Q4", "1998Q4")]
    df = spark.createDataFrame(rows, "_file_name string, _file string, want string")
    got = df.select(TP.quarter_of().alias("quarter"), "want").collect()
    assert [r.quarter for r in got] == [r.want for r in got]
    plan = df.select(TP.quarter_of())._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains" in plan and "regexp_replace" not in plan
