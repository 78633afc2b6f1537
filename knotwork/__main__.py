"""Run a catalogue query: python -m knotwork QUERY FOLDER [OUT]. Without OUT its first rows are shown."""

from __future__ import annotations

import sys

from knotwork.plans import catalog_concepts, catalog_graph, catalog_links, catalog_text, problems
from knotwork.runtime import get_spark, ship_package


def main(args: list[str]) -> int:
    """Run the query that is asked for; list all names when there is none."""
    queries = {n: f for m in (problems, catalog_links, catalog_graph, catalog_concepts, catalog_text) for n, f in m.QUERIES.items()}
    if len(args) < 2 or args[0] not in queries:
        print(__doc__, *(f"{n}: {(f.__doc__ or '').splitlines()[0]}" for n, f in sorted(queries.items())), sep="\n")
        return 2
    spark = get_spark()
    ship_package(spark)
    df = queries[args[0]](spark, args[1])
    if len(args) > 2:
        df.write.mode("overwrite").parquet(args[2])
    else:
        df.show(20, truncate=80)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
