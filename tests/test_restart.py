"""A stream goes on where it stopped, in another session."""

import os
import subprocess
import sys

PROGRAM = """
import sys
from flowstat.plans import jobs
from flowstat.session import get_session
folder, out, base = sys.argv[1:]
spark = get_session("local[2]", 2, extra={"spark.checkpoint.dir": base, "spark.sql.autoBroadcastJoinThreshold": "1000"})
assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "1000"
started = {**jobs.login_fail(spark, folder, stream=True, sink=out), **jobs.hot_items_sql(spark, folder + "-ub", n=1, stream=True, sink=out)}
for q in started.values():
    q.processAllAvailable()
    q.stop()
for label in ("consecutive", "hot_items_sql"):
    rows = spark.read.parquet(f"{out}/{label}").drop("epoch").collect()
    print("ROWS", label, sorted(str(tuple(r)) for r in rows))
spark.stop()
"""


def _run(*args):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", PROGRAM, *args], capture_output=True, text=True, timeout=300,
                          env=os.environ | {"PYTHONPATH": root})
    assert done.returncode == 0, done.stderr[-2000:]
    return [x for x in done.stdout.splitlines() if x.startswith("ROWS")]


def test_two_sessions_one_stream(tmp_path):
    d, ub = tmp_path / "in", tmp_path / "in-ub"
    d.mkdir()
    ub.mkdir()
    (d / "0.csv").write_text("1,10.0.0.1,fail,5\\n1,10.0.0.1,fail,6\\n".replace("\\n", "\n"))
    (ub / "0.csv").write_text("1,7,1,pv,1704067200\n")
    args = str(d), str(tmp_path / "out"), str(tmp_path / "ckpt")
    first = _run(*args)
    # the second session sees the user's next failure, and an item that takes the first place of the same hour
    (d / "1.csv").write_text("1,10.0.0.1,fail,7\n2,10.0.0.1,fail,9\n2,10.0.0.1,fail,9\n")
    (ub / "1.csv").write_text("1,8,1,pv,1704067201\n2,8,1,pv,1704067202\n")
    second = _run(*args)
    assert first[0].count("(1,") == 1 and second[0].count("(1,") == 2 and second[0].count("(2,") == 1
    assert "'+'" in first[1] and "'-'" not in first[1]
    assert second[1].count("'+'") == 2 and second[1].count("'-'") == 1
