"""The report runner, from driver tables or from a raw sales file.

    python -m tillflow.plans.runner <sf_dir> <out_dir> [names...]
    python -m tillflow.plans.runner --raw <file or folder> <out_dir> [names...]

The raw form is the whole job: land the file, clean it, write the clean file,
the dimensions and the fact, and every report on them.
"""

from __future__ import annotations

import argparse
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.money import report_columns
from tillflow.plans import catalog
from tillflow.plans.warehouse import build_star
from tillflow.session import scratch_path
from tillflow.sources.release import Release
from tillflow.sources.sinks import write_csv, write_report, write_table
from tillflow.sources.tables import MALFORMED, read_raw_sales_csv


def _chosen(jobs: dict, names) -> list[str]:
    unknown = [n for n in names or () if n not in jobs]
    if unknown:
        raise KeyError(f"unknown queries: {unknown}")
    return list(names) if names else list(jobs)


def run_reports(spark: SparkSession, sf_dir: str, out_dir: str, names=None) -> dict[str, str]:
    """Run each named query (all when names is empty) and write it as CSV; name -> path."""
    jobs = catalog.queries()
    return {n: write_report(jobs[n](spark, sf_dir), out_dir, n) for n in _chosen(jobs, names)}


def audit(spark: SparkSession, counted: dict[str, int]) -> DataFrame:
    """C16 for a raw file: its lines, those that do not fit the schema, and the rows of each table, as counted
    by the writes of the run."""
    names = ("linhas_brutas", "linhas_malformadas", "linhas_limpas", "clientes", "produtos", "vendas", "precos_invalidos")
    return spark.range(1).select(*[F.lit(counted[n]).cast("bigint").alias(n) for n in names])


def run_raw(spark: SparkSession, raw_path: str, out_dir: str, names=None, multi_line: bool = False) -> dict[str, str]:
    """Raw sales file or folder -> clean file, dimensions, fact and reports under out_dir; name -> path.

    Written: clean_sales (CSV), the tables customers, products and sales
    (Parquet, the fact by month and day) as one release under tables (see
    sources.release: readers change over to all three at once), etl_audit and
    one CSV per report.
    """
    chosen = _chosen(catalog.STAR_JOBS, names)
    out = out_dir.rstrip("/")
    work = scratch_path(spark, f"run-{uuid.uuid4().hex[:12]}")
    counted: dict[str, int] = {}
    raw = write_table(read_raw_sales_csv(spark, raw_path, multi_line, mark_malformed=True), f"{work}/raw", audit=counted,
                      metrics={"linhas_brutas": F.count(F.lit(1)), "linhas_malformadas": F.count_if(MALFORMED)})
    star = build_star(spark, raw.drop(MALFORMED), f"{work}/star")
    counted |= star.audit
    release = Release(spark, f"{out}/tables")
    paths = {"clean_sales": f"{out}/clean_sales", **{t: release.path(t) for t in ("customers", "products", "sales")}}
    write_csv(star.clean.select(*report_columns(star.clean)), paths["clean_sales"])
    write_table(star.customers, paths["customers"])
    release.add("customers", counted["clientes"])
    write_table(star.products, paths["products"])
    release.add("products", counted["produtos"])
    write_table(star.fact, paths["sales"], date_col="Data_Venda", key_col="ID_Transacao", partition_by_month=True)
    release.add("sales", counted["vendas"])
    release.publish()
    paths["etl_audit"] = write_report(audit(spark, counted), out, "etl_audit")
    return paths | {n: write_report(catalog.STAR_JOBS[n](star), out, n) for n in chosen}


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(description="Run named report queries and export CSVs.")
    ap.add_argument("source", help="folder of driver tables, or a raw sales file or folder with --raw")
    ap.add_argument("out_dir")
    ap.add_argument("names", nargs="*")
    ap.add_argument("--raw", action="store_true", help="the source is raw sales CSV")
    ap.add_argument("--multi-line", action="store_true", help="quoted fields may hold line breaks")
    args = ap.parse_args(argv)
    from tillflow.session import build_session
    spark = build_session()
    if args.raw:
        paths = run_raw(spark, args.source, args.out_dir, args.names, args.multi_line)
    else:
        paths = run_reports(spark, args.source, args.out_dir, args.names)
    for name, path in paths.items():
        print(f"{name}\t{path}")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
