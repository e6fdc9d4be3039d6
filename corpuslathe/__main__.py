"""Runs the core's registered queries: python -m corpuslathe [--list] QUERY --data DIR [--out PATH] [--format parquet|json|csv] [--master URL].

Exit codes: 0 done; 1 the result reports checks of which some failed; 2 wrong arguments or an unknown query.
"""

from __future__ import annotations

import argparse
import sys

from corpuslathe.plans import registries
from corpuslathe.runtime import cleaning
from corpuslathe.session import get_session


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="corpuslathe")
    p.add_argument("query", nargs="?")
    p.add_argument("--list", action="store_true")
    p.add_argument("--data")
    p.add_argument("--out")
    p.add_argument("--format", default="parquet", choices=["parquet", "json", "csv"])
    p.add_argument("--master")
    a = p.parse_args(argv)
    known = {n: f for r in registries() for n, f in r.queries.items()}
    if a.list:
        print("\n".join(known))
        return 0
    if a.query not in known or not a.data:
        print("unknown query" if a.query not in known else "--data is missing", file=sys.stderr)
        return 2
    spark = get_session("corpuslathe", master=a.master)
    with cleaning(spark):
        df = known[a.query](spark, a.data)
        if a.out:
            df.write.mode("overwrite").format(a.format).save(a.out)
            df = spark.read.format(a.format).schema(df.schema).load(a.out)
        else:
            df.show(50, truncate=80)
        failed = "passed" in df.columns and dict(df.dtypes)["passed"] == "boolean" and df.where("not passed").limit(1).count() > 0
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
