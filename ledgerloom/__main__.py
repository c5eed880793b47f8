"""python -m ledgerloom QUERY FOLDER [OUT]: run a query over the tables of a folder (OP-S12)."""

import argparse
from importlib import import_module
from importlib.util import find_spec

from ledgerloom.plans import catalogue, problems, proofs
from ledgerloom.session import local_session


def main() -> None:
    p = argparse.ArgumentParser(prog="ledgerloom", description="Run a query over the tables of a folder.")
    known = problems.QUERIES | catalogue.QUERIES | proofs.QUERIES
    if find_spec("ledgerloom.llm"):
        known |= import_module("ledgerloom.llm.queries").QUERIES
    p.add_argument("query", choices=sorted(known))
    p.add_argument("folder")
    p.add_argument("out", nargs="?", help="folder for parquet; without it the first rows are shown")
    a = p.parse_args()
    df = known[a.query](local_session(), a.folder)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.show(20, truncate=80)


if __name__ == "__main__":
    main()
