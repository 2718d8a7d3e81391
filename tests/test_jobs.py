"""The end-to-end jobs on small invented logs."""

from flowstat.plans import jobs

from .conftest import rows
from .test_fixtures import ADS, LOGIN, ORDERS, RECEIPTS


def test_login_job(spark):
    out = jobs.login_fail(spark, LOGIN)
    assert out["consecutive"].count() == 3 and out["sequence"].count() == 2 and out["burst"].count() == 2


def test_order_job(spark):
    out = jobs.order_timeout(spark, ORDERS)
    assert out["payed"].count() == 3 and out["order timeout"].count() == 2
    assert out["status"].where("status = 'pay_without_create'").count() == 2


def test_tx_job(spark):
    out = jobs.tx_match(spark, ORDERS, RECEIPTS)
    assert [out[k].count() for k in ("matched", "unmatched pays", "unmatched receipts")] == [2, 4, 4]


def test_tx_job_repeated_and_null_ids(spark, tmp_path):
    """Rows that share a transaction id, or have none, are all kept and judged one by one."""
    pays = ["1,pay,a,100", "2,pay,a,500", "3,pay,b,100", "4,pay,b,900", "5,pay,,100", "6,pay,,100"]
    (tmp_path / "o.csv").write_text("\n".join(pays))
    (tmp_path / "r.csv").write_text("a,wechat,102\n")
    out = jobs.tx_match(spark, str(tmp_path / "o.csv"), str(tmp_path / "r.csv"))
    assert rows(out["matched"], "order_id") == [(1,)]
    assert rows(out["unmatched pays"], "order_id") == [(2,), (3,), (4,), (5,), (6,)]
    assert out["unmatched receipts"].count() == 0


def test_ads_job(spark):
    out = jobs.ad_clicks(spark, ADS)
    assert out["passed"].count() == 102 and out["black list"].count() == 1
    # clicks per province are counted before the cap
    assert out["province"].agg({"cnt": "sum"}).first()[0] == 107 * 720


def test_cli_writes_every_row(spark, tmp_path, capsys):
    (tmp_path / "login.csv").write_text("".join(f"{u},10.0.0.1,fail,{t}\n" for u in range(1500) for t in (5, 6)))
    jobs.main(["login_fail", str(tmp_path / "login.csv"), "--out", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out" / "consecutive")).count() == 1500
    jobs.main(["login_fail", str(tmp_path / "login.csv")])
    assert sum(line.count("|") >= 3 for line in capsys.readouterr().out.splitlines()) >= 1500
    jobs.main(["login_fail", str(tmp_path / "login.csv"), "--preview", "3"])
    assert "a preview: 3 of 1500 rows" in capsys.readouterr().out


def test_stream_writes_every_row(spark, tmp_path, capsys):
    d = tmp_path / "in"
    d.mkdir()
    (d / "login.csv").write_text("".join(f"{u},10.0.0.1,fail,{t}\n" for u in range(1500) for t in (5, 6)))
    for sink in (str(tmp_path / "out"), "console"):
        for q in jobs.login_fail(spark, str(d), bound="3 seconds" if sink == "console" else "2 seconds", stream=True, sink=sink).values():
            q.processAllAvailable()
            q.stop()
    assert spark.read.parquet(str(tmp_path / "out" / "consecutive")).count() == 1500
    printed = capsys.readouterr().out
    assert sum(line.split(" | ")[0].isdigit() for line in printed.splitlines()) >= 1500


def test_ads_job_stream_splits_whole_clicks(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "ads.csv").write_text("".join(f"7,42,hebei,tangshan,{1700000000 + i}\n" for i in range(105)))
    for q in jobs.ad_clicks(spark, str(d), stream=True, sink=str(tmp_path / "out")).values():
        q.processAllAvailable()
        q.stop()
    passed = spark.read.parquet(str(tmp_path / "out" / "passed"))
    assert passed.count() == 100 and passed.where("province = 'hebei' and city = 'tangshan' and ts is not null").count() == 100
    assert spark.read.parquet(str(tmp_path / "out" / "black_list")).count() == 1


def test_late_pay_after_a_timeout_says_nothing_new(spark, tmp_path):
    """Create, time passes, pay: one timeout, though the pay comes in a later micro-batch."""
    d = tmp_path / "in"
    d.mkdir()
    got = []
    batches = ["1,create,,1000000\n2,pay,t2,1000000\n", "9,create,,1001000\n", "9,pay,x,1001001\n", "1,pay,t1,1001301\n2,create,,1001302\n",
               "9,pay,x,1005000\n", "9,pay,x,1006000\n"]
    sink = {"status": lambda df, e: got.extend((r.order_id, r.status) for r in df.collect()),
            "payed": lambda df, e: df.collect(), "order timeout": lambda df, e: df.collect()}
    (d / "0.csv").write_text(batches[0])
    qs = jobs.order_timeout(spark, str(d), stream=True, sink=sink)
    for i, lines in enumerate(batches):
        (d / f"{i}.csv").write_text(lines)
        for q in qs.values():
            q.processAllAvailable()
    for q in qs.values():
        q.stop()
    assert sorted(x for x in got if x[0] != 9) == [(1, "timeout"), (2, "pay_without_create"), (2, "timeout")]


def test_rows_of_other_kinds_move_the_watermark(spark, tmp_path):
    """One page view, then only purchases a day later: the hour closes."""
    d = tmp_path / "in"
    d.mkdir()
    (d / "0.csv").write_text("1,5,1,pv,1704067200\n")
    runs = {"hot_items": {"hot items"}, "page_views": {"pv", "pv salted"}, "unique_visitors": {"uv"}}
    out, started = {}, []
    for job, labels in runs.items():
        def collect(label):
            return lambda df, e: out.setdefault(label, []).extend(df.collect())
        started += getattr(jobs, job)(spark, str(d), stream=True, sink={x: collect(x) for x in labels | {"uv running"}}).values()
    for i in (1, 2):
        (d / f"{i}.csv").write_text(f"1,5,1,buy,{1704067200 + 86400 * i}\n")
        for q in started:
            q.processAllAvailable()
    for q in started:
        q.stop()
    for label in ("hot items", "pv", "uv"):
        assert out.get(label), label
    assert [(r.item_id, r.cnt) for r in out["hot items"]][0] == (5, 1) and out["pv"][0].pv == 1


def test_rare_kinds_close_too(spark, tmp_path):
    """Uninstalls, pays and orders: rows that are not counted move time."""
    (tmp_path / "mk").mkdir()
    (tmp_path / "od").mkdir()
    (tmp_path / "rc").mkdir()
    out = {}

    def sink(*labels):
        return {x: (lambda df, e, x=x: out.setdefault(x, []).extend(df.collect())) for x in labels}

    day = 86400
    files = [("mk", "1,UNINSTALL,wechat,1704067200000\n", "1,CLICK,wechat,{}000\n"), ("od", "1,pay,t1,1704067200\n", "2,create,,{}\n"),
             ("rc", "t9,wechat,1704067200\n", "t8,wechat,{}\n")]
    for name, first, _ in files:
        (tmp_path / name / "0.csv").write_text(first)
    started = [*jobs.marketing(spark, str(tmp_path / "mk"), stream=True, sink=sink("channel", "total")).values(),
               *jobs.tx_match(spark, str(tmp_path / "od"), str(tmp_path / "rc"), stream=True,
                              sink=sink("matched", "unmatched pays", "unmatched receipts")).values()]
    for i in (1, 2):
        for name, _, later in files:
            (tmp_path / name / f"{i}.csv").write_text(later.format(1704067200 + day * i))
        for q in started:
            q.processAllAvailable()
    for q in started:
        q.stop()
    assert len(out["total"]) == 720
    assert [r.tx_id for r in out["unmatched pays"]] == ["t1"] and "t9" in [r.tx_id for r in out["unmatched receipts"]]


def test_login_job_stream(spark, tmp_path):
    import shutil
    d = tmp_path / "in"
    d.mkdir()
    shutil.copy(LOGIN, d / "LoginLog.csv")
    qs = jobs.login_fail(spark, str(d), stream=True, sink="memory")
    for q in qs.values():
        q.processAllAvailable()
        q.stop()
    # consecutive failures need no timer: the warnings are out without end-of-input flushing
    assert spark.table("consecutive").count() == 3


def test_hot_pages_job_late_side_output(spark, tmp_path):
    lines = ["1.1.1.1 - - 01/01/2024:00:10:00 +0000 GET /a",      # watermark -> 00:09:59
             "1.1.1.1 - - 01/01/2024:00:00:01 +0000 GET /b",      # all windows closed, even with lateness: late
             "1.1.1.1 - - 01/01/2024:00:09:30 +0000 GET /c.css",  # asset, dropped before counting
             "1.1.1.1 - - 01/01/2024:00:09:50 +0000 GET /a"]
    p = tmp_path / "apache.log"
    p.write_text("\n".join(lines))
    out = jobs.hot_pages(spark, str(p), size="10 seconds", slide="5 seconds", lateness="1 minute")
    assert [r["url"] for r in out["late"].collect()] == ["/b"]
    assert out["hot pages"].where("url = '/b'").count() == 0 and out["hot pages"].where("url = '/a'").count() > 0


def test_hot_pages_job_stream_ranked(spark, tmp_path):
    d = tmp_path / "logs"
    d.mkdir()
    lines = [f"1.1.1.1 - - 01/01/2024:00:00:{s:02d} +0000 GET /{'a' if s % 3 else 'b'}" for s in range(30)]
    lines.append("1.1.1.1 - - 01/01/2024:05:00:00 +0000 GET /z")      # moves the watermark past everything
    (d / "access.log").write_text("\n".join(lines))
    got = []
    qs = jobs.hot_pages(spark, str(d), n=1, size="10 seconds", slide="5 seconds", stream=True,
                        sink={"hot pages": lambda df, e: got.extend((r["window_end"], r["url"], r["cnt"]) for r in df.collect()),
                              "late": lambda df, e: df.collect()})
    for q in qs.values():
        q.processAllAvailable()
        q.stop()
    assert got and all(url in ("/a", "/b", "/z") for _, url, _ in got)
    assert max(c for _, _, c in got) == 7                # /a is 2 of every 3 seconds: 7 in a 10 s window


def test_hot_items_sql_job_stream(spark, tmp_path):
    d = tmp_path / "ub"
    d.mkdir()
    rows_ = [f"{u},{u % 4},1,pv,{1704067200 + u * 60}" for u in range(50)] + ["1,1,1,pv,1704153600"]
    (d / "UserBehavior.csv").write_text("\n".join(rows_))
    got = []
    qs = jobs.hot_items_sql(spark, str(d), n=2, stream=True,
                            sink=lambda df, e: got.extend((r["op"], r["rn"], r["item_id"]) for r in df.collect()))
    for q in qs.values():
        q.processAllAvailable()
        q.stop()
    assert {(op, rn, item) for op, rn, item in got} >= {("+", 1, 0), ("+", 2, 1)}


def _dir(tmp_path, name, lines):
    d = tmp_path / name
    d.mkdir()
    (d / "part.csv").write_text("\n".join(lines))
    return str(d)


def test_every_job_streams(spark, tmp_path):
    """Each job's streaming path starts, drains its input and stops cleanly."""
    t0 = 1704067200
    ub = _dir(tmp_path, "ub", [f"{u},{u % 3},1,pv,{t0 + 37 * u}" for u in range(60)])
    mk = _dir(tmp_path, "mk", [f"{u},{['CLICK', 'INSTALL', 'UNINSTALL'][u % 3]},wechat,{(t0 + 11 * u) * 1000}"
                               for u in range(60)])
    ads = _dir(tmp_path, "ads", [f"{u % 4},{u % 2},beijing,beijing,{t0 + 7 * u}" for u in range(60)])
    od = _dir(tmp_path, "od", [f"{u},create,,{t0 + u}" for u in range(20)] +
              [f"{u},pay,tx{u},{t0 + u + 30}" for u in range(20)])
    rc = _dir(tmp_path, "rc", [f"tx{u},wechat,{t0 + u + 31}" for u in range(20)])
    runs = [jobs.hot_items(spark, ub, stream=True, sink="memory"),
            jobs.page_views(spark, ub, stream=True, sink="memory"),
            jobs.unique_visitors(spark, ub, stream=True, sink="memory"),
            jobs.marketing(spark, mk, size="1 minute", stream=True, sink="memory"),
            jobs.ad_clicks(spark, ads, size="1 minute", stream=True, sink="memory"),
            jobs.order_timeout(spark, od, stream=True, sink="memory"),
            jobs.tx_match(spark, od, rc, stream=True, sink="memory")]
    for qs in runs:
        for q in qs.values():
            q.processAllAvailable()
            q.stop()
            assert q.exception() is None
    assert spark.table("ad_clicks").where("channel = 'passed'").count() == 60


def test_streams_follow_the_order_of_arrival(spark, tmp_path):
    """Lines out of the order of their times, over two files of one micro-batch and a third
    one: failures in a row and the click cap come out as in the batch."""
    import os
    logs = {"lg": [["1,10.0.0.1,fail,1704067210", "1,10.0.0.1,fail,1704067205", "2,10.0.0.1,fail,1704067209"],
                   ["2,10.0.0.1,success,1704067200", "2,10.0.0.1,fail,1704067210", "1,10.0.0.1,fail,1704067206"],
                   ["2,10.0.0.1,fail,1704067201", "1,10.0.0.1,success,1704067203", "1,10.0.0.1,fail,1704067204"]],
            "ads": [["7,42,hebei,a,1704067209", "7,42,hebei,b,1704067201"], ["7,42,hebei,c,1704067205", "7,42,hebei,d,1704067200"],
                    ["7,42,hebei,e,1704067100", "7,42,hebei,f,1704067300"]]}
    out = {}

    def sink(*labels):
        return {x: (lambda df, e, x=x: out.setdefault(x, []).extend(df.collect())) for x in labels}

    def put(folder, i, lines):
        f = tmp_path / f"{folder}-{i}.tmp"
        f.write_text("\n".join(lines) + "\n")
        os.utime(f, (1704070000 + i, 1704070000 + i))      # files of known modification times
        f.rename(tmp_path / folder / f"{i}.csv")

    for folder, files in logs.items():
        (tmp_path / folder).mkdir()
        for i in (0, 1):
            put(folder, i, files[i])
    started = [*jobs.login_fail(spark, str(tmp_path / "lg"), stream=True, sink=sink("consecutive", "sequence", "burst")).values(),
               *jobs.ad_clicks(spark, str(tmp_path / "ads"), limit=3, size="1 minute", slide="1 minute", stream=True,
                               sink=sink("passed", "black list", "province")).values()]
    for q in started:
        q.processAllAvailable()
    for folder, files in logs.items():
        put(folder, 2, files[2])
    for q in started:
        q.processAllAvailable()
        q.stop()
    lg, ads = jobs.login_fail(spark, str(tmp_path / "lg")), jobs.ad_clicks(spark, str(tmp_path / "ads"), limit=3, size="1 minute", slide="1 minute")

    def seconds(found):
        return sorted((r.user_id, int(r.first_fail.timestamp()), int(r.last_fail.timestamp())) for r in found)

    want = lg["consecutive"].select("user_id", "first_fail", "last_fail").collect()
    assert seconds(out["consecutive"]) == seconds(want) and len(want) >= 2
    assert sorted(r.city for r in out["passed"]) == sorted(r.city for r in ads["passed"].collect()) == ["a", "b", "c"]
    assert [r.city for r in out["black list"]] == ["d"] and ads["black list"].count() == 1
