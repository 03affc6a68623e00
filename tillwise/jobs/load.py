"""Load the star schema and the marts: ``spark-submit load.py --source csv --input FOLDER --warehouse FOLDER --as-of DAY``.

With ``--source warehouse`` the marts alone are rebuilt from the stored star schema.
"""

from __future__ import annotations

import argparse

from tillwise.plans import batch
from tillwise.session import build_session
from tillwise.sources.files import read_sales_files
from tillwise.sources.warehouse import Warehouse


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--source", choices=("csv", "warehouse"), default="csv")
    parser.add_argument("--input", help="folder with the three CSV files")
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--as-of", required=True, help="reference day, YYYY-MM-DD")
    parser.add_argument("--keep-merged", action="store_true", help="the files hold none of the merged sales")
    given = parser.parse_args(args)
    if given.source == "csv" and not given.input:
        parser.error("--input is needed for --source csv")
    spark = build_session("load")
    warehouse = Warehouse(spark, given.warehouse)
    if given.source == "csv":
        files = read_sales_files(spark, given.input)
        batch.load(warehouse, files["transactions"], files["customers"], files["articles"], given.as_of, given.keep_merged)
    else:
        batch.recompute(warehouse, given.as_of)


if __name__ == "__main__":
    main()
