import uuid

import pytest

from tillflow.operators import cleaning as C
from tillflow.session import scratch_path
from tillflow.streaming.ingest import ingest_raw_sales, read_bronze

HEADER = ("ID_Transacao,Data_Venda,ID_Cliente,Nome_Produto,Categoria_Produto,Valor_Unitario,"
          "Quantidade,Localidade_Venda,Metodo_Pagamento,Status_Pedido\n")


def test_incremental_landing_keeps_first_copy_across_arrivals(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex[:8]}")
    bronze, ckpt = f"{base}/bronze", f"{base}/ckpt"
    (landing / "a.csv").write_text(
        HEADER + "TRX1,2025-01-02,CLI1,Kit Cama,Casa,10.00,1.0,Recife/PE/Brasil,Pix,Concluido\n"
                 "TRX2,2025-01-02,CLI2,Bola,Esporte,20.00,,Natal/RN/Brasil,NA,Concluido\n")
    ingest_raw_sales(spark, str(landing), bronze, ckpt).awaitTermination()
    (landing / "b.csv").write_text(
        HEADER + "TRX1,2025-01-05,CLI1,Kit Cama,Casa,99.00,1.0,Recife/PE/Brasil,Pix,Concluido\n"
                 "TRX3,2025-01-06,CLI3,Livro,Livros,5.00,2.0,Recife/PE/Brasil,Boleto,Cancelado\n")
    ingest_raw_sales(spark, str(landing), bronze, ckpt).awaitTermination()
    other = spark.newSession()  # a later session goes on where the first one stopped
    ingest_raw_sales(other, str(landing), bronze, ckpt).awaitTermination()  # nothing new: no repeats
    raw = read_bronze(spark, bronze)
    assert raw.count() == 4
    clean = {r["ID_Transacao"]: r for r in C.clean_sales(raw).collect()}
    assert set(clean) == {"TRX1", "TRX2", "TRX3"}
    assert str(clean["TRX1"]["Valor_Unitario"]) == "10.000000"   # the first arrival wins
    assert clean["TRX2"]["Metodo_Pagamento"] == "Nao Informado"
    assert clean["TRX2"]["Quantidade"] == 1                        # median of 1, 1, 2


def test_checkpoint_location_must_be_given(spark, tmp_path):
    with pytest.raises(TypeError):
        ingest_raw_sales(spark, str(tmp_path), str(tmp_path / "bronze"))
