"""python -m verso publish|check DOCUMENTS [OUT] [--pages 1,3-5]: a package of pages from a Parquet table of texts, or its checks."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans import stages
from .sources.wire import page_list


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="verso", description=__doc__)
    parser.add_argument("what", choices=("publish", "check"))
    parser.add_argument("documents")
    parser.add_argument("out", nargs="?")
    parser.add_argument("--pages")
    own = parser.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    documents, pages = spark.read.parquet(own.documents), page_list(own.pages, 0) if own.pages else None
    if own.what == "publish":
        if not own.out:
            parser.error("publish needs a folder to write to")
        stages.publish(documents, own.out, pages)
        return 0
    rows = stages.check(documents, pages).collect()
    for r in rows:
        print("ok  " if r["ok"] else "FAIL", r["name"], r["failures"])
    failed = sum(not r["ok"] for r in rows)
    print(f"{len(rows) - failed}/{len(rows)} checks")
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main())
