"""Compare chosen queries with their SQL from the command line: check.py [folder] [name …]."""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import assert_same, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tokenloom.session import build_session  # noqa: E402

folder = sys.argv[1]
names = sys.argv[2:] or list(entry.queries())
spark = build_session("check", "local[8]", **{
    "spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    "spark.ui.showConsoleProgress": "false"})
spark.sparkContext.setLogLevel("ERROR")
con = duck(folder)
sql = entry.oracle_sql()
for name in names:
    begin = time.time()
    try:
        df = entry.queries()[name](spark, folder)
        if name in sql:
            assert_same(df, con, sql[name])
            print(f"same  {name} {time.time() - begin:.1f}s", flush=True)
        else:
            print(f"rows  {name} {df.count()} {time.time() - begin:.1f}s", flush=True)
    except Exception as error:
        print(f"FAIL  {name} {str(error)[:1500]}", flush=True)
        if not isinstance(error, AssertionError):
            print("".join(traceback.format_tb(error.__traceback__)[-3:]), flush=True)
