"""Literal raw sales rows for unit tests."""

from pyspark.sql import functions as F

from tillflow.sources.tables import ORDINAL, RAW_SALES_SCHEMA

RAW_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_SALES_SCHEMA.fields)


def raw_df(spark, rows):
    """rows: tuples of the 10 raw columns; input order = list order."""
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], RAW_DDL + ", _pos long")
    return df.withColumn(ORDINAL, F.struct(F.col("_pos").alias("pos"))).drop("_pos")


def sale(tid, date="2025-01-10", cust="CLI00001", prod="Kit Cama", cat="Casa", price="100.00",
         qty=1.0, loc="Recife/PE/Brasil", method="Pix", status="Concluido"):
    return (tid, date, cust, prod, cat, price, qty, loc, method, status)
