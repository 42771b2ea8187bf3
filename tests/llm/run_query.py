"""Runs one query of the subpackage and prints its time and some rows: ``python -m tests.llm.run_query NAME SF_DIR``."""

import sys
import time

from bench import session
from seqloom.llm.queries import QUERIES

if __name__ == "__main__":
    spark = session("run")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    for _ in range(1):
        start = time.time()
        rows = QUERIES[sys.argv[1]](spark, sys.argv[2]).persist()
        print(rows.count(), "rows", round(time.time() - start, 1), "s")
    rows.show(8, truncate=120)
    rows.printSchema()
