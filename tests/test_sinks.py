import time
import uuid

from pyspark.sql import functions as F

from tillflow.plans import warehouse as W
from tillflow.plans.runner import run_raw, run_reports
from tillflow.session import scratch_path
from tillflow.sources.sinks import write_csv, write_table
from tillflow.sources.tables import RAW_COLUMNS, read_raw_sales_csv

SF = "/root/testdata/sf0.001"


def test_fact_layout_round_trip_and_partition_pruning(spark, star_small):
    path = scratch_path(spark, f"layout-{uuid.uuid4().hex[:8]}")
    back = write_table(star_small.fact, path, date_col="Data_Venda", partition_by_month=True)
    assert back.drop("ano_mes").exceptAll(star_small.fact).count() == 0
    assert back.count() == star_small.fact.count()
    q = back.where(F.col("ano_mes") == "1997-03")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano_mes" in plan and "1997-03" in plan
    assert q.count() == star_small.fact.where(F.date_format("Data_Venda", "yyyy-MM") == "1997-03").count()


def test_clean_csv_round_trip(spark, star_small):
    from tillflow.sources.dirty import dirty_sales
    raw = dirty_sales(spark, SF).drop("_ord")
    path = scratch_path(spark, f"raw-{uuid.uuid4().hex[:8]}")
    write_csv(raw, path)
    back = read_raw_sales_csv(spark, path).drop("_ord")
    assert back.count() == raw.count()
    assert back.exceptAll(raw).count() == 0


def test_runner_exports_one_csv_per_query(spark):
    out = scratch_path(spark, f"reports-{uuid.uuid4().hex[:8]}")
    paths = run_reports(spark, SF, out, ["status_distribution", "monthly_revenue"])
    got = spark.read.option("header", True).csv(paths["status_distribution"])
    assert set(got.columns) == {"Status_Pedido", "qtd", "pct"} and got.count() > 0


def test_star_pointer_round_trip(spark, star_small):
    from tillflow.plans import warehouse as W
    path = scratch_path(spark, f"ptr-{uuid.uuid4().hex[:8]}")
    counts = W.table_counts(star_small)
    W._write_pointer(spark, path, star_small.location, counts, star_small.memo["median"])
    found = W._read_pointer(spark, path)
    assert (found["location"], found["counts"]) == (star_small.location, counts)
    again = W.open_star(spark, found["location"], found["median"])
    assert again.clean.exceptAll(star_small.clean).count() == 0
    opened = lambda: W.open_star(spark, found["location"], found["median"])
    assert W._reopen(opened, W.table_counts, found["counts"]) is not None
    # a dimension that lost rows, or a table that is gone, means a rebuild
    assert W._reopen(opened, W.table_counts, {**counts, "customers": counts["customers"] + 1}) is None
    assert W._reopen(lambda: W.open_star(spark, path + "-gone", 1.0), W.table_counts, counts) is None
    assert W._read_pointer(spark, path + "-missing") is None


def test_write_table_registers_catalog_table(spark, star_small):
    name = f"fact_{uuid.uuid4().hex[:8]}"
    path = scratch_path(spark, name)
    back = write_table(star_small.products, path, table=name)
    assert spark.catalog.tableExists(name)
    assert back.count() == star_small.products.count() == spark.table(name).count()
    spark.sql(f"DROP TABLE {name}")  # external table: the files stay in the shared folder


HARD_NAMES = ['Smart TV 50"', 'Cabo 2", preto', "Kit, grande", 'Aspas "duplas" e, virgula', "simples"]


def _python_csv(path, rows):
    import csv
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(RAW_COLUMNS)
        w.writerows(rows)


def test_csv_quoting_is_rfc_4180_both_ways(spark, tmp_path):
    import csv
    rows = [(f"T{i}", "2025-01-02", "CLI1", name, "Casa", "10.00", "1.0", "Recife/PE/Brasil", "Pix", "Concluido")
            for i, name in enumerate(HARD_NAMES)]
    _python_csv(tmp_path / "raw.csv", rows)
    back = read_raw_sales_csv(spark, str(tmp_path / "raw.csv"))
    got = {r["ID_Transacao"]: (r["Nome_Produto"], r["Categoria_Produto"], r["Valor_Unitario"]) for r in back.collect()}
    assert got == {r[0]: (r[3], "Casa", "10.00") for r in rows}
    write_csv(back.drop("_ord"), str(tmp_path / "out"))
    seen = []
    for f in (tmp_path / "out").glob("*.csv"):
        with open(f, newline="") as h:
            seen += [r["Nome_Produto"] for r in csv.DictReader(h)]
    assert sorted(seen) == sorted(HARD_NAMES)


def test_line_breaks_in_fields_and_malformed_lines(spark, tmp_path):
    row = ("T1", "2025-01-02", "CLI1", "duas\nlinhas", "Casa", "10.00", "1.0", "Recife/PE/Brasil", "Pix", "Concluido")
    _python_csv(tmp_path / "multi.csv", [row])
    back = read_raw_sales_csv(spark, str(tmp_path / "multi.csv"), multi_line=True)
    assert [r["Nome_Produto"] for r in back.collect()] == ["duas\nlinhas"]
    _python_csv(tmp_path / "bad.csv", [row[:3] + ("Bola",) + row[4:], ("T2", "2025-01-02"), row[:3] + ("x",) + row[4:6] + ("abc",) + row[7:]])
    marked = read_raw_sales_csv(spark, str(tmp_path / "bad.csv"), mark_malformed=True)
    assert sorted(r["_malformed"] for r in marked.collect()) == [False, True, True]


def test_raw_file_to_reports_end_to_end(spark, tmp_path):
    import csv
    rows = []
    for i in range(60):
        rows.append((f"T{i}", f"2025-{i % 12 + 1:02d}-10", f"CLI{i % 7}", HARD_NAMES[i % 5], "casa", f"{10 + i}.00",
                     "" if i == 3 else "2.0", "Recife/PE/Brasil", "Pix", "concluido"))
    rows.append(rows[0])                       # an exact repeat
    rows.append(("T1", *rows[1][1:5], "999.00", *rows[1][6:]))  # a later copy of T1: the first stays
    rows.append(("T99",))                      # a malformed line
    _python_csv(tmp_path / "raw.csv", rows)
    paths = run_raw(spark, str(tmp_path / "raw.csv"), str(tmp_path / "out"), ["revenue_by_category", "monthly_revenue"])

    def read(name):
        found = []
        for f in (tmp_path / "out" / name).glob("*.csv"):
            with open(f, newline="") as h:
                found += list(csv.DictReader(h))
        return found
    clean = {r["ID_Transacao"]: r for r in read("clean_sales")}
    assert len(clean) == 60 and {r["Nome_Produto"] for r in clean.values()} == set(HARD_NAMES)
    assert float(clean["T1"]["Valor_Unitario"]) == 11.0 and clean["T3"]["Quantidade"] == "2"
    audit = read("etl_audit")[0]
    assert (audit["linhas_brutas"], audit["linhas_malformadas"], audit["linhas_limpas"], audit["vendas"]) == \
        ("63", "1", "60", "60")
    total = sum(float(r["Faturamento"]) for r in clean.values())
    assert float(read("revenue_by_category")[0]["faturamento_total"]) == round(total, 2)
    assert len(read("monthly_revenue")) == 12
    fact = spark.read.parquet(paths["sales"])
    assert fact.count() == 60 and "ano_mes" in fact.columns
    assert spark.read.parquet(paths["products"]).count() == 5


def test_orphaned_tables_are_removed(spark, tmp_path, monkeypatch):
    from tillflow.plans import warehouse as W
    monkeypatch.setattr(W, "_shared_root", lambda s: str(tmp_path))
    for name in ("star-aa-1", "star-aa-2", "raw-bb-1", "other"):
        write_table(spark.range(3), str(tmp_path / name))
    W._write_pointer(spark, str(tmp_path / "star-aa.pointer"), str(tmp_path / "star-aa-2"), {"fact": 3}, 1.0)
    assert W.remove_orphans(spark) == []       # young tables stay: their build may still run
    gone = {p.rstrip("/").rsplit("/", 1)[-1] for p in W.remove_orphans(spark, older_than_hours=-1)}
    assert gone == {"star-aa-1", "raw-bb-1"}
    assert (tmp_path / "star-aa-2").exists() and (tmp_path / "other").exists()


def test_prices_become_text_once_per_part(spark):
    """The price texts are made of the parts before they are joined to the sales."""
    from tillflow.sources.dirty import dirty_sales
    plan = dirty_sales(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("format_number") and plan.index("Join") < plan.index("format_string(%.2f")


def shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size())
            if (name := found.apply(i).getName()).startswith("shuffle_") and name.endswith(".data")}


def test_writes_leave_no_shuffle_files(spark, tmp_path, star_small):
    """The shuffle files of a write go with it, not with the driver's next garbage collection."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(key), shuffle_files(spark)
    rows = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count()
    write_table(rows, str(tmp_path / "plain"))
    write_table(rows, str(tmp_path / "ranged"), date_col="k")
    star = W.Star(str(tmp_path), *[star_small.fact] * 4)
    assert W.written_once(star, "once", lambda: rows).count() == 7
    for _ in range(50):  # the files are removed in the background
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    # count() above is not a write: its single shuffle may stay
    assert len(shuffle_files(spark) - before) <= 1 and spark.conf.get(key) == setting


def test_what_follows_from_a_row_is_written_behind_the_exchange(spark, tmp_path):
    """`finish` sees rows already laid out, so its columns are not shuffled."""
    rows = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 10).alias("d"))
    back = write_table(rows, str(tmp_path / "t"), date_col="d", key_col="k",
                       finish=lambda x: x.withColumn("twice", F.col("k") * 2).withColumn("task", F.spark_partition_id()))
    assert back.where("twice <> 2 * k").isEmpty() and back.count() == 500
    ends = back.groupBy("task").agg(F.min("d").alias("a"), F.max("d").alias("b")).orderBy("a", "b").collect()
    assert all(x["b"] <= y["a"] for x, y in zip(ends, ends[1:]))


def test_names_of_the_geography_are_not_shuffled(spark):
    """Nation and region names are joined to the sales behind the last shuffle."""
    from tillflow.sources.dirty import dirty_sales
    plan = dirty_sales(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("n_nationkey") < plan.index("Exchange hashpartitioning")
    assert plan.count("BroadcastExchange") == 1  # the geography alone
