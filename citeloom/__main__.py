"""``python -m citeloom ingest FOLDER STORE [--clear]`` runs the pipeline over a folder of PDF files;
``python -m citeloom bibliography FOLDER OUT`` writes their bibliographies."""

import sys

from pyspark.sql import SparkSession

from citeloom.operators.bib import sidecar
from citeloom.operators.store import Store
from citeloom.plans.pipeline import ingest, read_folder
from citeloom.sources.documents import write_sidecars


def main(args: list[str]) -> int:
    spark = SparkSession.builder.getOrCreate()
    match [a for a in args if a != "--clear"]:
        case ["ingest", folder, where]:
            stores = Store(spark, where)
            if "--clear" in args:
                stores.clear()
            try:
                run = ingest(spark, stores, read_folder(spark, folder))
            except FileNotFoundError as e:
                print(f"no such folder: {e}")
                return 1
            for r in run.log.orderBy("filename").toLocalIterator():
                print(r["action"], r["filename"], r["detail"] or "")
            print(run.metrics.first().asDict(), "written:", *run.written)
        case ["bibliography", folder, out]:
            rows = sidecar(read_folder(spark, folder))
            write_sidecars(rows, out)
            for r in rows.select("status").toLocalIterator():
                print(r["status"])
        case [where] if "--clear" in args:
            Store(spark, where).clear()
        case _:
            print(__doc__)
            return 2
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
