"""The ETL job: raw sales -> clean rows -> star schema, written as tables.

Like the reference (clean once, load a database, query it from the report,
statistics and dashboard jobs) the raw records and the star schema are
materialised once and the queries read the written tables. Tables go to the
shared folder named by `spark.checkpoint.dir`, which survives executor loss.

Reuse: within a session the built star is kept in memory. Across sessions it
is found again through a small pointer file in the shared folder, keyed by
the listing of the source files (path, size, modification time, as Spark's
file system reports them) and by TABLES_VERSION, so a changed input or a
changed job never reuses old tables. A pointer names the row count of every
table; a table that has lost rows or files since is built again.
`remove_orphans` deletes tables that no pointer names.

Layout: the fact is range-partitioned by sale date, so every file covers a
narrow range of dates and date filters skip files through Parquet min/max
statistics.

Access paths: `access_path` lays a second copy of the fact out along a curve
through customer, product and date (operators.clustering), once per star, for
reads by any of these keys.
"""

from __future__ import annotations

import hashlib
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.operators.clustering import ZONES, Lookup, read_clustered, write_clustered
from tillflow.operators.cleaning import derive_revenue, finish_clean, median_of, parse_stage
from tillflow.operators.dictionary import dictionaries
from tillflow.operators.modelling import FACT_COLUMNS, dim_customers, dim_products, enriched_sales, fact_sales
from tillflow.session import ensure_checkpoint_dir, scratch_path, settings, shuffles_dropped
from tillflow.sources.dirty import dirty_sales
from tillflow.sources.sinks import TABLE_CODEC, write_table
from tillflow.sources.tables import table_path

# Raise with every change of what the written tables hold.
TABLES_VERSION = 3

# Largest product dimension that is broadcast (bytes in memory).
PRODUCT_BROADCAST_BYTES = 64 << 20

# Largest split of the raw records that a task sorts before the keep-first shuffle (about 15 times that in memory).
SORTED_SPLIT_BYTES = 32 << 20

# Texts of a sale that take few values together.
PLACE_COLUMNS = ("Cidade", "Estado", "Pais", "Metodo_Pagamento", "Status_Pedido")

SOURCE_TABLES = ("lineitem", "orders", "part", "customer", "nation", "region")


@dataclass
class Star:
    location: str
    clean: DataFrame
    customers: DataFrame
    products: DataFrame
    fact: DataFrame
    # small driver-side results derived from the tables (e.g. IQR fences), per star
    memo: dict = field(default_factory=dict, repr=False)
    product_bytes: int | None = None
    # C16, counted by the ETL's own writes: rows of the raw input and of every table, unparsable prices
    audit: dict = field(default_factory=dict)

    def measured_products(self) -> DataFrame:
        """The product dimension, to be broadcast if its measured size allows it.

        Row reports join every sale to its product. A dimension within the
        limit is broadcast, so no sale is shuffled; beyond it Spark's merge
        join takes over. The size is measured once per star.
        """
        if self.product_bytes is None:
            self.product_bytes = bytes_in_memory(self.products)
        return by_size(self.products, self.product_bytes)

    def named(self, rows: DataFrame) -> DataFrame:
        """Rows with an ID_Produto, joined to the product's name and category."""
        return rows.join(self.measured_products(), "ID_Produto")

    def enriched(self) -> DataFrame:
        return enriched_sales(self.fact, self.measured_products())


def bytes_in_memory(texts: DataFrame) -> int:
    """Size of a dimension's rows in memory: text bytes and about 64 bytes of row and hash table."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts.columns), F.lit(64))
    return texts.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def by_size(dimension: DataFrame, measured: int) -> DataFrame:
    """The dimension, to be broadcast if its measured size allows it."""
    return F.broadcast(dimension) if measured <= PRODUCT_BROADCAST_BYTES else dimension


def build_star(spark: SparkSession, raw: DataFrame, location: str, stored: bool = False) -> Star:
    """Run the cleaning and modelling jobs on `raw`, writing the tables under `location`.

    Written: the de-duplicated, parsed rows (read by the median job and by
    everything after it), the product and customer dimensions and the fact.
    The clean rows themselves are a row-local step over the parsed table
    (median fill, date filter, revenue), so they are not written twice. The fact
    is shuffled for its layout alone, and its revenue is derived behind that; its
    texts travel as numbers. With `stored` raw is a written table, not a job to be run.
    """
    one, audit = F.count(F.lit(1)), {}
    with settings(spark, _split_bytes(spark)):
        parsed = write_table(parse_stage(raw, stored), f"{location}/parsed", audit=audit, metrics={
            "parsed": one, "linhas_limpas": F.count_if(F.col("Data_Venda").isNotNull())})
    median = median_of(parsed, "Quantidade")
    clean = finish_clean(parsed, median)
    products = write_table(dim_products(clean), f"{location}/products", audit=audit, metrics={"produtos": one})
    product_bytes = bytes_in_memory(products)
    sales = fact_sales(clean, by_size(products, product_bytes), [c for c in FACT_COLUMNS if c != "Faturamento"])
    words, = dictionaries(parsed, PLACE_COLUMNS)

    def finish(laid_out: DataFrame) -> DataFrame:
        whole = words.decoded(laid_out) if words else laid_out
        return whole.transform(derive_revenue).select(*FACT_COLUMNS)

    fact = write_table(words.encoded(sales) if words else sales, f"{location}/fact", date_col="Data_Venda",
                       key_col="ID_Transacao", audit=audit, finish=finish,
                       metrics={"vendas": one, "precos_invalidos": F.count_if(F.col("Valor_Unitario").isNull())})
    # from the written fact: one narrow scan instead of another pass over the parsed rows
    customers = write_table(dim_customers(fact).sortWithinPartitions("ID_Cliente"),
                            f"{location}/customers", audit=audit, metrics={"clientes": one})
    star = Star(location, clean, customers, products, fact, product_bytes=product_bytes, audit=audit)
    star.memo.update(parsed=parsed, median=median)
    return star


def _split_bytes(spark: SparkSession) -> dict[str, str]:
    """The keep-first sorts a split before its shuffle: splits small enough that no task spills."""
    key = "spark.sql.files.maxPartitionBytes"
    now = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return {key: str(min(now, SORTED_SPLIT_BYTES))}


def open_star(spark: SparkSession, location: str, median: float | None, audit: dict | None = None) -> Star:
    """A star written by build_star, read back."""
    read = spark.read.parquet
    parsed = read(f"{location}/parsed")
    star = Star(location, finish_clean(parsed, median), read(f"{location}/customers"),
                read(f"{location}/products"), read(f"{location}/fact"), audit=dict(audit or {}))
    star.memo.update(parsed=parsed, median=median)
    return star


#: Columns that sales are looked up by, each alone or together.
ACCESS_COLUMNS = ("ID_Cliente", "ID_Produto", "Data_Venda")


def access_path(s: Star) -> str:
    """The fact clustered on customer, product and date, with its zone map; written once per star."""
    path = f"{s.location}/fact_by_key"
    if s.memo.get("access_path") != path:
        spark = s.fact.sparkSession
        fs, zones = _files(spark, f"{path}/{ZONES}/_SUCCESS")
        if not fs.exists(zones):  # the zone map is written last: without it the copy is not whole
            write_clustered(s.fact, path, list(ACCESS_COLUMNS), ["ID_Transacao"])
        s.memo["access_path"] = path
    return path


def written_once(s: Star, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table derived from the star alone, written under its location the first time it is asked for."""
    path, spark = f"{s.location}/{name}", s.fact.sparkSession
    if s.memo.get(name) is None:
        fs, done = _files(spark, f"{path}/_SUCCESS")
        if not fs.exists(done):
            table = build()
            with shuffles_dropped(spark):
                table.write.mode("overwrite").option("compression", TABLE_CODEC).parquet(path)
        s.memo[name] = spark.read.parquet(path)
    return s.memo[name]


def look_up(s: Star, *lookups: Lookup) -> DataFrame:
    """Sales that meet all lookups, read from the files of the access path that can hold them."""
    return read_clustered(s.fact.sparkSession, access_path(s), list(lookups))


#: Written table -> name of its row count in the audit.
AUDITED_TABLES = {"parsed": "parsed", "products": "produtos", "customers": "clientes", "fact": "vendas"}


def table_counts(s: Star) -> dict[str, int]:
    """Rows of each written table (read from the file footers)."""
    return {"parsed": s.memo["parsed"].count(), "products": s.products.count(),
            "customers": s.customers.count(), "fact": s.fact.count()}


# ------------------------------------------------------------------ reuse

_LOCK = threading.Lock()
_BUILT: dict[tuple, Star] = {}
_RAW: dict[tuple, tuple[DataFrame, int]] = {}

_POINTER_SCHEMA = T.StructType([T.StructField("location", T.StringType()),
                                T.StructField("median", T.DoubleType()),
                                T.StructField("counts", T.MapType(T.StringType(), T.LongType())),
                                T.StructField("audit", T.MapType(T.StringType(), T.LongType()))])


def _files(spark: SparkSession, path: str):
    """(file system, Hadoop path) of a path in any storage Spark can read."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _signature(spark: SparkSession, sf_dir: str) -> tuple:
    """Every source file with its size and modification time in milliseconds."""
    sig = []
    for t in SOURCE_TABLES:
        fs, where = _files(spark, table_path(sf_dir, t))
        found = fs.listFiles(where, True)
        while found.hasNext():
            f = found.next()
            sig.append((t, f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(sig))


def _key(spark: SparkSession, sf_dir: str) -> tuple:
    return (_signature(spark, sf_dir), TABLES_VERSION)


def _tag(key: tuple) -> str:
    return hashlib.sha1(repr(key).encode()).hexdigest()[:16]


def _shared_root(spark: SparkSession) -> str | None:
    """The cluster's shared folder: the spark.checkpoint.dir setting itself."""
    conf = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return f"{conf.rstrip('/')}/tillflow-warehouse" if conf else None


def _location(spark: SparkSession, key: tuple, kind: str) -> str:
    root = _shared_root(spark)
    name = f"{kind}-{_tag(key)}-{uuid.uuid4().hex[:8]}"
    return f"{root}/{name}" if root else scratch_path(spark, name)


def _pointer(spark: SparkSession, kind: str, key: tuple) -> str | None:
    root = _shared_root(spark)
    return f"{root}/{kind}-{_tag(key)}.pointer" if root else None


def _read_pointer(spark: SparkSession, path: str | None):
    if path is None:
        return None
    fs, where = _files(spark, path)
    if not fs.exists(where):
        return None
    rows = spark.read.schema(_POINTER_SCHEMA).json(path).collect()  # one small row
    return rows[0] if rows else None


def _write_pointer(spark: SparkSession, path: str | None, location: str, counts: dict[str, int],
                   median: float | None = None, audit: dict[str, int] | None = None) -> None:
    """Written last, after every table of the build: a pointer always names complete
    tables. The counts are checked when the tables are reopened, so files lost since
    then mean a rebuild, never silently smaller tables."""
    if path is not None:
        spark.createDataFrame([(location, median, counts, audit or {})], _POINTER_SCHEMA) \
            .coalesce(1).write.mode("overwrite").json(path)


def _reopen(opened, counts, expected):
    """opened() if its tables hold the expected rows, else None."""
    try:
        found = opened()
        return found if counts(found) == dict(expected) else None
    except (AnalysisException, Py4JJavaError):  # tables or files gone: build again
        return None


def remove_orphans(spark: SparkSession, older_than_hours: float = 24.0) -> list[str]:
    """Delete warehouse tables that no pointer names, and pointers of other versions' builds.

    Tables younger than older_than_hours stay, as their build may still run.
    Returns the deleted paths. Only folders made by this module are touched.
    """
    root = _shared_root(spark)
    if root is None:
        return []
    fs, where = _files(spark, root)
    if not fs.exists(where):
        return []
    entries = list(fs.listStatus(where))
    named = set()
    for e in entries:
        if e.getPath().getName().endswith(".pointer"):
            found = _read_pointer(spark, e.getPath().toString())
            if found is not None:
                named.add(found["location"].rstrip("/").rsplit("/", 1)[-1])
    limit = (time.time() - older_than_hours * 3600) * 1000
    gone = []
    for e in entries:
        name = e.getPath().getName()
        ours = name.startswith(("raw-", "star-")) and not name.endswith(".pointer")
        if ours and name not in named and e.getModificationTime() < limit:
            fs.delete(e.getPath(), True)
            gone.append(e.getPath().toString())
    return gone


def landed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """The raw sales records of sf_dir (with `_ord`), landed once, and their number as counted by that write.

    In the reference the raw data is a file that every run reads; here the
    raw view over the driver tables is written once to the shared folder and
    read by the cleaning job and by the per-operator queries.
    """
    ensure_checkpoint_dir(spark)
    key = _key(spark, sf_dir)
    session_key = (spark.sparkContext.applicationId, key)
    with _LOCK:
        if session_key not in _RAW:
            pointer = _pointer(spark, "raw", key)
            found = _read_pointer(spark, pointer)
            df = found and _reopen(lambda: spark.read.parquet(found["location"]),
                                   lambda d: {"raw": d.count()}, found["counts"])
            counts = dict(found["counts"]) if df is not None else {}
            if df is None:
                location = _location(spark, key, "raw")
                df = write_table(dirty_sales(spark, sf_dir), location, metrics={"raw": F.count(F.lit(1))}, audit=counts)
                _write_pointer(spark, pointer, location, counts)
            _RAW[session_key] = (df, counts["raw"])
        return _RAW[session_key]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed raw sales records."""
    return landed(spark, sf_dir)[0]


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The star schema of the driver tables under sf_dir, built once (see the module doc)."""
    ensure_checkpoint_dir(spark)
    key = _key(spark, sf_dir)
    session_key = (spark.sparkContext.applicationId, key)
    if session_key in _BUILT:
        return _BUILT[session_key]
    source, raw_rows = landed(spark, sf_dir)
    with _LOCK:
        if session_key not in _BUILT:
            pointer = _pointer(spark, "star", key)
            found = _read_pointer(spark, pointer)
            built = found and _reopen(lambda: open_star(spark, found["location"], found["median"], found["audit"]),
                                      table_counts, found["counts"])
            if built is None:
                built = build_star(spark, source, _location(spark, key, "star"), stored=True)
                built.audit["linhas_brutas"] = raw_rows
                counts = {t: built.audit[n] for t, n in AUDITED_TABLES.items()}
                _write_pointer(spark, pointer, built.location, counts, built.memo["median"], built.audit)
            _BUILT[session_key] = built
        return _BUILT[session_key]


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact joined to the product dimension."""
    return star(spark, sf_dir).enriched()
