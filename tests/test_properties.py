"""Property checks of the exact-arithmetic and text helpers against plain Python."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillflow.functions.money import div_round, parse_currency
from tillflow.functions.text import title_case

pairs = st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(-10**9, 10**9).filter(bool)),
                 min_size=1, max_size=200)


@settings(max_examples=15, deadline=None)
@given(pairs, st.integers(0, 4))
def test_div_round_is_half_away_from_zero(spark, rows, scale):
    df = spark.createDataFrame(rows, "n long, d long")
    got = [r[0] for r in df.select(div_round(F.col("n"), F.col("d"), scale)).collect()]
    want = [(Decimal(n) / Decimal(d) * Decimal(10) ** scale).quantize(Decimal(1), ROUND_HALF_UP)
            for n, d in rows]
    assert got == want


cents = st.integers(0, 10**11)


@settings(max_examples=15, deadline=None)
@given(st.lists(cents, min_size=1, max_size=100))
def test_currency_both_formats(spark, values):
    def local(c):
        whole, frac = divmod(c, 100)
        return "R$ " + f"{whole:,}".replace(",", ".") + f",{frac:02d}"
    texts = [local(c) if i % 2 else f"{c / 100:.2f}" for i, c in enumerate(values)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_currency("t")).collect()]
    assert got == [Decimal(c).scaleb(-2).quantize(Decimal("0.000001")) for c in values]


alphabet = st.sampled_from(list("abcXYZáÉçÃõß-/' \t5.9,_中ªǅ"))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet, max_size=20), min_size=1, max_size=300))
def test_title_case_equals_python_title(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(title_case("t")).collect()]
    assert got == [t.title() for t in texts]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet, max_size=20), min_size=1, max_size=50))
def test_oracle_title_case_equals_python_title(texts):
    import duckdb

    from tillflow import oracle
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(texts)))
    got = [r[0] for r in con.sql(f"SELECT {oracle.title('x')} FROM t ORDER BY i").fetchall()]
    assert got == [t.title() for t in texts]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=400),
       st.lists(st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]), min_size=1, max_size=4,
                unique=True))
def test_exact_quantiles_match_numpy(spark, values, probs):
    import numpy as np

    from tillflow.operators.quantiles import exact_quantiles
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    present = np.array([v for v in values if v is not None], dtype=float)
    for parts in (3, None):  # a given number of range partitions, and the sized one
        got = {r["prob"]: r["valor"] for r in exact_quantiles(df, ["x"], probs, num_partitions=parts).collect()}
        for p in probs:
            if len(present) == 0:
                assert got[p] is None
            else:
                assert abs(got[p] - np.percentile(present, p * 100)) < 1e-9
