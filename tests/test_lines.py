"""Line numbers from the counts of splits, without a sort of lines."""

import gzip

from pyspark.sql import functions as F

from fragloom.sources import minutes


def test_numbers_hold_over_splits_and_files(spark, tmp_path):
    """Long files in many splits, several files in a task, blank lines, no newline at the end, gzip, an empty file."""
    want = {}
    for k, n in enumerate([1, 4000, 2500, 3, 0, 700]):
        lines = [f"{k}-{i}" + "x" * (i % 90) if i % 7 else "" for i in range(n)]
        text = "\n".join(lines) + ("\n" if k % 2 and n else "")
        name = f"2025031600{k:02d}00.json" + (".gz" if k == 2 else "")
        (tmp_path / name).write_bytes(gzip.compress(text.encode()) if k == 2 else text.encode())
        if k % 2 == 0 and n and not lines[-1]:
            lines = lines[:-1]
        want |= {(k, i + 1): x for i, x in enumerate(lines)}
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for size, cost in [("9k", "0"), ("50k", "1k"), ("128m", "4m")]:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        try:
            rows = minutes.read_minutes(spark, str(tmp_path)).withColumn("m", minutes.source_minute(F.col("file")))
            got = {(int(r["m"][10:12]), r["line_no"]): r["value"] for r in rows.collect()}
            plan = rows._jdf.queryExecution().executedPlan().toString()
        finally:
            for c, v in old.items():
                spark.conf.set(c, v)
        assert got == want
        assert "value" not in "".join(line for line in plan.split("\n") if "Window [" in line)
