"""Compare registered queries on one folder: ``python tests/check_all.py FOLDER [NAME ...]``."""

import pathlib
import sys
import time

sys.path[:0] = [str(pathlib.Path(__file__).parents[1]), str(pathlib.Path(__file__).parent)]

from compare import connect, differences  # noqa: E402
from conftest import make_session  # noqa: E402

import __spark_entry__ as registered  # noqa: E402


def main() -> int:
    folder, *names = sys.argv[1:]
    spark, con = make_session(), connect(folder)
    queries, oracles, bad = registered.queries(), registered.oracle_sql(), 0
    for name in names or queries:
        began = time.time()
        try:
            df = queries[name](spark, folder)
            problem = differences(df, con, oracles[name]) if name in oracles else None
            kind = "same" if name in oracles else f"{df.count()} rows, no SQL"
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{time.time() - began:6.2f}s {name}: {problem or kind}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
