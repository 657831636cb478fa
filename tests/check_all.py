"""Compare every registered query with its oracle: python -m tests.check_all [folder] [names...]"""

import sys
import time

import __spark_entry__ as entry
from tarmac.session import build_session
from tests.compare import differences, oracle_connection


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = oracle_connection(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracles:
                problem = differences(df, con, oracles[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
