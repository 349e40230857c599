"""python -m tests.run_queries FOLDER [name ...]: check queries against their SQL and time them."""

import sys
import tempfile
import time
import traceback

from tests.oracle import compare, connect
from tokenloom.plans import ORACLES, QUERIES
from tokenloom.session import build_session

if __name__ == "__main__":
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "check", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "16g",
            "spark.driver.host": "127.0.0.1", "spark.driver.bindAddress": "127.0.0.1",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tokenloom-check-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), []
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                ok, note = compare(spark, con, QUERIES[name], ORACLES[name], folder)
            else:
                got = QUERIES[name](spark, folder).collect()
                ok, note = len(got) > 0, f"{len(got)} rows (rows only) {got[:1]}"[:300]
        except Exception as e:
            ok, note = False, "".join(traceback.format_exception(e))[-700:]
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.1f}s {note}", flush=True)
        bad += [] if ok else [name]
    print("failed:", bad)
