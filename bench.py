"""Times every query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query's time goes to standard error as soon as it is known.  A query that is not through after ``$BENCH_LIMIT`` seconds, planning
included, counts with that limit, is named under ``over_limit``, and the others go on.
"""

from __future__ import annotations

import json
import os
import sys
import threading
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from bindings.queries import bound  # noqa: E402
from daymart.session import build_session  # noqa: E402


def timed(spark, query, folder: str, limit: float) -> tuple[float, str]:
    """Seconds, and what went wrong if anything did.  Planning cannot be interrupted, so the work has a thread of its own."""
    failure = []

    def work() -> None:
        try:
            query(spark, folder).write.format("noop").mode("overwrite").save()
        except Exception as error:  # one broken query must not cost the figures of the others
            failure.append(f"{type(error).__name__}: {str(error)[:200]}")

    thread = threading.Thread(target=work, daemon=True)
    start = time.perf_counter()
    thread.start()
    thread.join(limit)
    if thread.is_alive():
        spark.sparkContext.cancelAllJobs()
        return limit, "over limit"
    return time.perf_counter() - start, failure[0] if failure else ""


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads

    limit = float(os.environ.get("BENCH_LIMIT", "60"))
    seconds, failed, late = {}, {}, []
    for name, query in bound().items():
        if wanted and name not in wanted:
            continue
        took, wrong = timed(spark, query, folder, limit)
        seconds[name] = round(took, 3)
        print(f"{name} {took:.3f} {wrong}".rstrip(), file=sys.stderr, flush=True)
        if wrong == "over limit":
            late.append(name)
        elif wrong:
            failed[name] = wrong
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
            | ({"over_limit": late} if late else {})
            | ({"failed": failed} if failed else {})
        ),
        flush=True,
    )
    if late:
        os._exit(0)  # a thread that still plans would keep the interpreter
    spark.stop()


if __name__ == "__main__":
    main()
