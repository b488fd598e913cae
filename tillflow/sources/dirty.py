"""Raw (dirty) sales records derived from the driver's TPC-H-like tables.

The raw sales file of the reference is not shipped, so the same kinds of dirt
are laid over the driver tables with deterministic rules keyed on the order
key k. Each line item is one sale; the natural repeats of
(l_orderkey, l_linenumber) are the duplicated transactions; some records are
also repeated exactly, and some prices lie far outside or have six decimals.

Joins run in the order that keeps big shuffles to a minimum at scale:
orders + customer on the customer key, then line items on the order key, then
parts on the part key, then the 25-row geography, broadcast. Its two names are
not shuffled with every order and sale, only the nation's key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.sources.tables import ORDINAL, RAW_COLUMNS, read_table

# The dirt rules (k = o_orderkey).
DATE_MISSING_MOD, DATE_MISSING_REM, DATE_MISSING_TEXT = 97, 5, "sem data"
PRICE_LOCAL_MOD, PRICE_LOCAL_BELOW = 5, 2
CUSTOMER_NULL_MOD, CUSTOMER_NULL_REM = 50, 0
QUANTITY_NULL_MOD, QUANTITY_NULL_REM = 67, 0
METHOD_NULL_MOD, METHOD_NULL_REM = 50, 1
METHOD_UPPER_MOD, METHOD_UPPER_REM = 2, 1
METHOD_PAD_MOD, METHOD_PAD_REM = 7, 0
CATEGORY_UPPER_MOD, CATEGORY_UPPER_REM = 10, 0
LOCATION_DASH_MOD, LOCATION_DASH_BELOW = 10, 3
COUNTRY_TEXT = "Brasil"
REPEAT_MOD, REPEAT_REM = 53, 3                    # exact repeats of a whole record
PRICE_FINE_MOD, PRICE_FINE_REM = 11, 3            # plain prices with six decimals
PRICE_OUTLIER_MOD, PRICE_OUTLIER_REM = 211, 7     # a price far outside the others
PRICE_OUTLIER_PREFIX = "9"                        # ... by a digit in front
# Columns of the joined parts with the price as text.
PRICE_LOCAL, PRICE_PLAIN = "_price_local", "_price_plain"

# Keep-first order among copies of one transaction: a total order over the
# line-item columns, so that every engine picks the same copy.
ORDINAL_COLUMNS = ("l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity",
                   "l_discount", "l_tax")


def dirty_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten raw string-ish columns plus the hidden `_ord` keep-first ordinal."""
    geo = (read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
           .join(read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"]),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    customers = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    orders = (read_table(spark, sf_dir, "orders",
                         ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
              .withColumn("o_orderdate", F.to_date("o_orderdate"))
              .join(customers, F.col("o_custkey") == F.col("c_custkey")))
    items = read_table(spark, sf_dir, "lineitem",
                       ["l_orderkey", "l_linenumber", *ORDINAL_COLUMNS])
    # a price is written as text once per part, not once per sale
    parts = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_retailprice"]) \
        .select("p_partkey", "p_name", "p_type", *price_texts())
    base = (items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .drop("l_orderkey")
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            # The geography has 25 rows in this schema at every scale; a shuffle on its 25 keys
            # would put all sales into 25 tasks at most.
            .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")))
    copies = F.explode(F.when(_k_is(REPEAT_MOD, REPEAT_REM), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return base.select("*", copies.alias("_copy")).select(*raw_columns(), F.struct(*ORDINAL_COLUMNS).alias(ORDINAL))


def _k_is(mod: int, rem: int):
    return (F.col("o_orderkey") % mod) == rem


def price_texts():
    """The price of a part in both spellings: `R$ 1.234,56` and `1234.56`."""
    price = F.col("p_retailprice")
    local = F.concat(F.lit("R$ "), F.translate(F.format_number(price, 2), ",.", ".,"))
    return [local.alias(PRICE_LOCAL), F.format_string("%.2f", price).alias(PRICE_PLAIN)]


def raw_columns():
    k = F.col("o_orderkey")
    day = F.col("o_orderdate")
    date_text = (F.when(_k_is(DATE_MISSING_MOD, DATE_MISSING_REM), F.lit(DATE_MISSING_TEXT))
                 .when(k % 3 == 0, F.date_format(day, "yyyy-MM-dd"))
                 .when(k % 3 == 1, F.date_format(day, "dd/MM/yyyy"))
                 .otherwise(F.date_format(day, "MM-dd-yyyy")))
    price_local, price_plain = F.col(PRICE_LOCAL), F.col(PRICE_PLAIN)
    fine = F.lpad(((F.col("l_partkey") * 37 + 5) % 10000).cast("string"), 4, "0")
    price_plain = F.when(_k_is(PRICE_FINE_MOD, PRICE_FINE_REM), F.concat(price_plain, fine)).otherwise(price_plain)
    price_plain = F.when(_k_is(PRICE_OUTLIER_MOD, PRICE_OUTLIER_REM), F.concat(F.lit(PRICE_OUTLIER_PREFIX), price_plain)) \
        .otherwise(price_plain)
    price_text = F.when((k % PRICE_LOCAL_MOD) < PRICE_LOCAL_BELOW, price_local).otherwise(price_plain)
    customer = F.when(_k_is(CUSTOMER_NULL_MOD, CUSTOMER_NULL_REM), F.lit(None).cast("string")) \
        .otherwise(F.format_string("CLI%05d", F.col("o_custkey")))
    quantity = F.when(_k_is(QUANTITY_NULL_MOD, QUANTITY_NULL_REM), F.lit(None).cast("double")) \
        .otherwise(F.col("l_quantity"))
    method = F.when(_k_is(METHOD_UPPER_MOD, METHOD_UPPER_REM), F.upper("o_orderpriority")) \
        .otherwise(F.col("o_orderpriority"))
    method = F.when(_k_is(METHOD_PAD_MOD, METHOD_PAD_REM), F.concat(F.lit("  "), method, F.lit(" "))) \
        .otherwise(method)
    method = F.when(_k_is(METHOD_NULL_MOD, METHOD_NULL_REM), F.lit(None).cast("string")).otherwise(method)
    category = F.when(_k_is(CATEGORY_UPPER_MOD, CATEGORY_UPPER_REM), F.upper("p_type")) \
        .otherwise(F.col("p_type"))
    location = F.when((k % LOCATION_DASH_MOD) < LOCATION_DASH_BELOW,
                      F.concat(F.upper("r_name"), F.lit(" - "), F.col("n_name"))) \
        .otherwise(F.concat(F.col("r_name"), F.lit("/"), F.col("n_name"), F.lit("/" + COUNTRY_TEXT)))
    cols = {
        "ID_Transacao": F.concat(F.lit("TRX"), F.col("o_orderkey").cast("string"), F.lit("-"),
                                 F.col("l_linenumber").cast("string")),
        "Data_Venda": date_text,
        "ID_Cliente": customer,
        "Nome_Produto": F.col("p_name"),
        "Categoria_Produto": category,
        "Valor_Unitario": price_text,
        "Quantidade": quantity,
        "Localidade_Venda": location,
        "Metodo_Pagamento": method,
        "Status_Pedido": F.col("o_orderstatus"),
    }
    return [cols[name].alias(name) for name in RAW_COLUMNS]
