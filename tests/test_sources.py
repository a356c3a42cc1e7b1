"""Raw-log readers (S1-S7) on small files written by the test."""

import os
import tempfile

from pyspark.sql import functions as F

from tidemark.sources import files
from tidemark.streaming import sinks


def _write(text: str) -> str:
    d = tempfile.mkdtemp(prefix="tidemark-src-", dir="/tmp")
    with open(os.path.join(d, "part.txt"), "w") as fh:
        fh.write(text)
    return d


def test_order_csv_empty_tx_is_null(spark):
    d = _write("34729,create,,1558430842\n34729,pay,sd76f87d6,1558430844")
    rows = files.read_order_events(spark, d).orderBy("ts_sec").collect()
    assert [(r.order_id, r.event_type, r.tx_id, r.ts_sec) for r in rows] == [
        (34729, "create", None, 1558430842), (34729, "pay", "sd76f87d6", 1558430844)]
    assert str(rows[0].ts) == "2019-05-21 09:27:22"


def test_user_behavior_and_ad_click_csv(spark):
    ub = files.read_user_behavior(spark, _write("543462,1715,1464116,pv,1511658000\n"))
    r = ub.first()
    assert (r.user_id, r.item_id, r.category_id, r.behavior) == (543462, 1715, 1464116, "pv")
    ad = files.read_ad_clicks(spark, _write("937166,1715,beijing,beijing,1511661700\n")).first()
    assert (ad.province, ad.ts_sec) == ("beijing", 1511661700)


def test_access_log_line(spark):
    d = _write("83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/\nbad line\n")
    rows = files.read_access_log(spark, d).collect()
    good = [r for r in rows if r.event_time is not None]
    assert len(rows) == 2 and len(good) == 1
    g = good[0]
    assert (g.ip, g.user_id, g.method, g.url) == ("83.149.9.216", "-", "GET", "/presentations/")
    assert str(g.event_time) == "2015-05-17 10:05:03"


def test_order_line_stream_parser(spark):
    df = spark.createDataFrame([("34729,pay,sd76f87d6,1558430844",), ("34730,create,,1558430845",)], "value string")
    rows = df.select(*files.parse_order_line(F.col("value"))).orderBy("order_id").collect()
    assert [(r.order_id, r.event_type, r.tx_id) for r in rows] == [(34729, "pay", "sd76f87d6"),
                                                                    (34730, "create", None)]


LOG = ("1.2.3.4 u - 17/05/2015:10:05:03 +0000 GET /a\n1.2.3.4 u - 17/05/2015 +0000 GET /b\nbad line\n\n"
       "1.2.3.4 u - 17/05/2015:10:05:04 +0000 GET /c more fields\n")
LINES = "1,create,,1558430842\nx,pay,t,1558430843\n2,pay,t,soon\n3,pay\n4,pay,t,1558430844,extra\n"
LOG_FAULTS = {"1.2.3.4 u - 17/05/2015 +0000 GET /b": "no time of the form dd/MM/yyyy:HH:mm:ss", "bad line": "fewer than 7 fields",
              "": "empty line"}
LINE_FAULTS = {"x,pay,t,1558430843": "the order id is no number", "2,pay,t,soon": "the time is no number", "3,pay": "fewer than 4 fields"}


def test_malformed_lines_appear_once_with_their_reason(spark):
    for read, text, faults, good in ((files.read_checked_access_log, LOG, LOG_FAULTS, 2),
                                     (files.read_checked_order_lines, LINES, LINE_FAULTS, 2)):
        checked = read(spark, _write(text), stream=False)
        dead = files.dead_letters(checked).collect()
        assert {r.line: r.reason for r in dead} == faults and len(dead) == len(faults)
        rows = files.good_rows(checked)
        assert rows.count() == good and files.REASON not in rows.columns and files.CORRUPT not in rows.columns


def test_malformed_lines_of_a_stream(spark):
    for name, read, text, faults in (("log", files.read_checked_access_log, LOG, LOG_FAULTS),
                                     ("orders", files.read_checked_order_lines, LINES, LINE_FAULTS)):
        src, out = _write(text), tempfile.mkdtemp(prefix="tidemark-dead-", dir="/tmp")
        with open(os.path.join(src, "second.txt"), "w") as fh:
            fh.write("second file\n")
        writer = sinks.dead_letter_writer(f"{out}/good", f"{out}/dead")
        sinks.run_to_end([sinks.foreach_batch(read(spark, src, stream=True), writer, f"dead-{name}-{os.path.basename(out)}")])
        dead = [r.line for r in spark.read.parquet(f"{out}/dead").collect()]
        assert sorted(dead) == sorted([*faults, "second file"])
        assert spark.read.parquet(f"{out}/good").count() == 2


def test_csv_dead_letters(spark):
    read = files.read_receipts(spark, _write("t1,wechat,1558430842\nt2,alipay,when\n"))
    assert [(r.line, r.reason) for r in files.dead_letters(read).collect()] == [("t2,alipay,when", "does not fit the schema")]
    assert [r.tx_id for r in files.good_rows(read).collect()] == ["t1"]
