"""Stress check (not part of the pytest run): 5 million reports derived by
Spark from sf0.1 events (x50 over 10 expressways), one vehicle holding a
third of them. Runs T1 and prints, per stage, total and largest-task record
counts from the event log written to a scratch folder (argument 1, else a
new temp folder): no task should hold the hot vehicle's third.

    python tests/stress_skew.py [scratch_dir] [vid|segment] [nobroadcast]

``segment`` makes one segment-minute hold a third of the reports instead;
``nobroadcast`` disables broadcast joins and lowers AQE's skew thresholds,
to see the sort-merge plans a large cluster would run.
"""
import sys, time, json, glob, io, tempfile
sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__))))
from pyspark.sql import functions as F
from tollstream.session import build_session, scratch_path
from tollstream.sources.events import load_reports
from tollstream.plans.keyed import toll_notifications_keyed
OUT = tempfile.mkdtemp(prefix="stress-") if len(sys.argv) < 2 else sys.argv[1]
HOT = sys.argv[2] if len(sys.argv) > 2 else "vid"
# One advisory partition of 1 MB: the 5M-row input counts as large here,
# as 100 TB would against the default 64 MB.
extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": OUT,
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB"}
if "nobroadcast" in sys.argv[3:]:
    extra.update({"spark.sql.autoBroadcastJoinThreshold": "-1",
                  "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                  "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
                  "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"})
spark = build_session(extra=extra)
base = load_reports(spark, "/root/testdata/sf0.1")
k = F.explode(F.sequence(F.lit(0), F.lit(49))).alias("k")
hot = (F.col("offset") * 50 + F.col("k")) % 3 == 0
vid = F.col("vid") + 2000 * F.col("k")
xway = F.col("k") % 10
if HOT == "vid":
    vid = F.when(hot, F.lit(0)).otherwise(vid)
else:  # one segment-minute: expressway 0, direction 0, segment 0, minute 16
    xway = F.when(hot, F.lit(0)).otherwise(xway)
time_ = F.when(hot, F.lit(930)).otherwise(F.col("time")) if HOT != "vid" else F.col("time")
big = (base.select("*", k)
       .select((F.col("offset") * 50 + F.col("k")).alias("offset"), "type", time_.cast("smallint").alias("time"),
               vid.cast("int").alias("vid"), "speed", xway.cast("int").alias("xway"), "lane",
               (F.when(hot, F.lit(0)).otherwise(F.col("dir")) if HOT != "vid" else F.col("dir")).alias("dir"),
               (F.when(hot, F.lit(0)).otherwise(F.col("seg")) if HOT != "vid" else F.col("seg")).alias("seg"),
               "pos"))
path = scratch_path(spark, "stress")
big.write.parquet(path)
src = spark.read.parquet(path)
print("ROWS", src.count(), HOT, sys.argv[3:])
spark.sparkContext.setJobGroup("measured", "measured")
t = time.time()
out = toll_notifications_keyed(src, materialize=False)
n = out.count()
print("T1", n, round(time.time() - t, 2))
spark.stop()
import zstandard
d = sorted(glob.glob(OUT + "/eventlog_v2_local-*"))[-1]
jobs = set(); tasks = {}
for f in sorted(glob.glob(d + "/events_*")):
    raw = open(f, "rb").read()
    text = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode()
    for line in text.splitlines():
        e = json.loads(line); ev = e["Event"]
        if ev == "SparkListenerJobStart" and e.get("Properties", {}).get("spark.jobGroup.id") == "measured":
            jobs.update(e["Stage IDs"])
        if ev == "SparkListenerTaskEnd" and e["Stage ID"] in jobs:
            m = e.get("Task Metrics") or {}
            recs = (m.get("Shuffle Read Metrics", {}) or {}).get("Total Records Read", 0) + (m.get("Input Metrics", {}) or {}).get("Records Read", 0)
            tasks.setdefault(e["Stage ID"], []).append((e["Task Info"]["Finish Time"] - e["Task Info"]["Launch Time"], recs))
for sid, ts in sorted(tasks.items()):
    recs = sorted(r for _, r in ts); durs = sorted(d for d, _ in ts)
    if sum(recs) > 100000:
        print("STAGE", sid, "tasks", len(ts), "records total", sum(recs), "max task records", recs[-1], "median", recs[len(recs)//2], "max ms", durs[-1], "median ms", durs[len(durs)//2])
