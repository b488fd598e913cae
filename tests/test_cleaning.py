import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from helpers import raw_df, sale
from tillflow.operators import cleaning as C
from tillflow.sources.tables import read_raw_sales_csv


def test_keep_first_is_input_order_and_null_key_after_dedupe(spark):
    rows = [
        sale("TRX1", cust=None),           # first copy lacks the customer ...
        sale("TRX1", cust="CLI00002"),     # ... so the whole transaction is lost
        sale("TRX2", price="50.00"),
        sale("TRX2", price="60.00"),
        sale("TRX3"), sale("TRX3"),         # exact repeat
    ]
    df = raw_df(spark, rows)
    kept = df.transform(C.dedupe_keep_first).transform(C.drop_null_keys)
    got = {r["ID_Transacao"]: r["Valor_Unitario"] for r in kept.collect()}
    assert got == {"TRX2": "50.00", "TRX3": "100.00"}
    assert df.transform(C.dedupe_rows).count() == 5


def test_median_imputation_interpolates_then_truncates(spark):
    rows = [sale(f"T{i}", qty=q) for i, q in enumerate([1.0, 2.0, None, 4.0, 10.0])]
    out = raw_df(spark, rows).drop("_ord").transform(C.impute_median).transform(C.to_int)
    assert sorted(r["Quantidade"] for r in out.collect()) == [1, 2, 3, 4, 10]
    half = [sale(f"T{i}", qty=q) for i, q in enumerate([1.0, 2.0, None])]
    out = raw_df(spark, half).drop("_ord").transform(C.impute_median).transform(C.to_int)
    assert sorted(r["Quantidade"] for r in out.collect()) == [1, 1, 2]  # median 1.5 -> 1


def test_clean_sales_end_to_end(spark):
    rows = [
        sale("T1", date="1/2/2025", price="R$ 1.234,56", qty=2.0, cat="  MODA ", method=None,
             loc="SÃO PAULO - sp", status="concluido", prod="  Kit Cama "),
        sale("T2", date="2025-02-30"),                     # bad date: dropped after the median
        sale("T3", date="03-15-2025", price="1.234,56"),   # unprefixed local format: NULL price
    ]
    out = {r["ID_Transacao"]: r for r in C.clean_sales(raw_df(spark, rows)).collect()}
    assert set(out) == {"T1", "T3"}
    t1 = out["T1"]
    assert str(t1["Data_Venda"]) == "2025-02-01"
    assert t1["Valor_Unitario"] == Decimal("1234.560000") and t1["Faturamento"] == Decimal("2469.12")
    assert (t1["Categoria_Produto"], t1["Metodo_Pagamento"], t1["Status_Pedido"]) == \
        ("Moda", "Nao Informado", "Concluido")
    assert (t1["Cidade"], t1["Estado"], t1["Pais"], t1["Nome_Produto"]) == \
        ("São Paulo", "SP", "Brasil", "Kit Cama")
    assert out["T3"]["Valor_Unitario"] is None and out["T3"]["Faturamento"] is None


def test_csv_source_reads_float_quantity_and_na_tokens(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text(
        "ID_Transacao,Data_Venda,ID_Cliente,Nome_Produto,Categoria_Produto,Valor_Unitario,"
        "Quantidade,Localidade_Venda,Metodo_Pagamento,Status_Pedido\n"
        "TRX000001,2025-01-02,CLI00001,Kit Cama,Casa,R$ 1.234,3.0,Recife/PE/Brasil,Pix,Concluido\n"
        "TRX000001,2025-01-03,CLI00001,Kit Cama,Casa,10.00,,Recife/PE/Brasil,NA,Concluido\n"
        "TRX000002,2025-01-02,NA,Kit Cama,Casa,10.00,1.0,Recife/PE/Brasil,null,Concluido\n"
        "TRX000003,2025-01-02,CLI3,Kit Cama,Casa,10.00,NaN,Recife/PE/Brasil,Pix,Concluido\n")
    df = read_raw_sales_csv(spark, str(p))
    rows = df.orderBy(F.col("_ord")).collect()
    assert [r["Quantidade"] for r in rows] == [3.0, None, 1.0, None]
    assert rows[1]["Metodo_Pagamento"] is None and rows[2]["ID_Cliente"] is None
    first = df.transform(C.dedupe_keep_first).where("ID_Transacao = 'TRX000001'").first()
    assert first["Data_Venda"] == "2025-01-02"


def test_keep_first_across_several_files(spark, tmp_path):
    header = ("ID_Transacao,Data_Venda,ID_Cliente,Nome_Produto,Categoria_Produto,Valor_Unitario,"
              "Quantidade,Localidade_Venda,Metodo_Pagamento,Status_Pedido\n")
    d = tmp_path / "raw"
    d.mkdir()
    (d / "part-a.csv").write_text(header + "TRX1,2025-01-02,CLI1,Bola,Esporte,1.00,1.0,Natal/RN,Pix,Concluido\n"
                                           "TRX1,2025-01-02,CLI1,Bola,Esporte,2.00,1.0,Natal/RN,Pix,Concluido\n")
    (d / "part-b.csv").write_text(header + "TRX1,2025-01-02,CLI1,Bola,Esporte,3.00,1.0,Natal/RN,Pix,Concluido\n"
                                           "TRX2,2025-01-02,CLI1,Bola,Esporte,4.00,1.0,Natal/RN,Pix,Concluido\n")
    kept = C.dedupe_keep_first(read_raw_sales_csv(spark, str(d)))
    assert {r["ID_Transacao"]: r["Valor_Unitario"] for r in kept.collect()} == {"TRX1": "1.00", "TRX2": "4.00"}


def test_location_function_and_staged_operator_agree(spark):
    from tillflow.functions.location import parse_location
    from tillflow.plans import warehouse
    raw = warehouse.raw(spark, "/root/testdata/sf0.001").select("ID_Transacao", "Localidade_Venda")
    extra = spark.createDataFrame([("X1", "SÃO PAULO - sp"), ("X2", "Recife"), ("X3", None),
                                   ("X4", " a/b/c/d "), ("X5", "CORTA-VENTO - SP")], raw.schema)
    df = raw.unionByName(extra)
    loc = parse_location(F.col("Localidade_Venda"))
    a = df.select("ID_Transacao", loc["Cidade"].alias("Cidade"), loc["Estado"].alias("Estado"),
                  loc["Pais"].alias("Pais"))
    b = df.transform(C.split_location).select("ID_Transacao", "Cidade", "Estado", "Pais")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_lazy_cleaning_equals_staged_warehouse_build(spark, star_small):
    from tillflow.plans import warehouse
    raw = warehouse.raw(spark, "/root/testdata/sf0.001")
    lazy = C.clean_sales(raw)
    assert lazy.exceptAll(star_small.clean).count() == 0
    assert star_small.clean.exceptAll(lazy).count() == 0
    visible = [c for c in raw.columns if c != "_ord"]
    with_ord = raw.transform(C.dedupe_rows).select(*visible)
    without = raw.select(*visible).transform(C.dedupe_rows)
    assert with_ord.exceptAll(without).count() == 0 and without.exceptAll(with_ord).count() == 0


def test_dates_and_prices_are_parsed_before_the_shuffle(spark):
    """As values they are narrower than as text; the copy that is kept does not depend on them."""
    rows = [sale("A", date="sem data", price="R$ 1.234,50"), sale("A", price="7.00"), sale("B", date="31/01/2025", price="x")]
    parsed = C.parse_stage(raw_df(spark, rows))
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("R$")
    assert [(r["ID_Transacao"], r["Data_Venda"], r["Valor_Unitario"]) for r in parsed.orderBy("ID_Transacao").collect()] == [
        ("A", None, Decimal("1234.500000")), ("B", dt.date(2025, 1, 31), None)]
