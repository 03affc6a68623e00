"""Merge ingested batches and rebuild the marts: ``spark-submit merge.py --warehouse FOLDER --as-of DAY``.

``--compact`` then writes the star schema anew with all merged batches inside.
"""

from __future__ import annotations

import argparse

from tillwise.plans import batch
from tillwise.session import build_session
from tillwise.sources.warehouse import Warehouse
from tillwise.streaming.merge import merge


def main(args: list[str] | None = None) -> int | None:
    """The last merged batch; None, without a rebuild, if there was nothing new."""
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--as-of", required=True, help="reference day, YYYY-MM-DD")
    parser.add_argument("--compact", action="store_true")
    given = parser.parse_args(args)
    warehouse = Warehouse(build_session("merge"), given.warehouse)
    merged = merge(warehouse)
    if merged is not None:
        batch.recompute(warehouse, given.as_of)
    if given.compact:
        batch.compact(warehouse)
    return merged


if __name__ == "__main__":
    main()
