"""The star-schema tables seen as nested documents.

Orders take the part of the parents and line items that of their entries. Supplier, nation
and region are the three dimensions that every entry repeats: each determines the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from flatloom.functions import timestamp_to_epoch
from flatloom.operators.numbering import positions_by_slice, spread_by
from flatloom.schemas import Dimension, DocumentModel, Reference, struct_of
from flatloom.scratch import new_path

SLICE_WIDTH = 1000
# A parent goes on in another document after this many entries, which bounds a document
# to SLICE_WIDTH times as many, however many line items one order has.
PART_ENTRIES = 200

# All columns of a line item but its order: the places inside an order follow them.
LINE_ORDER = [
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]

ENTRY = struct_of(
    "pos int, track_key long, track_name string, album_key int, album_name string, "
    "artist_key int, artist_name string"
)
PARENT = struct_of(
    "pid long, name string, description string, collaborative string, modified_at long, part int",
    StructField("tracks", ArrayType(ENTRY)),
)

ORDERS = DocumentModel(
    schema=StructType([StructField("playlists", ArrayType(PARENT))]),
    parents="playlists",
    entries="tracks",
    parent_table="playlists",
    parent_key="pid",
    fact_table="playlist_tracks",
    fact_columns=("pid", "pos", "track_key"),
    fact_key=("pid", "pos"),
    dimensions=(
        Dimension("artists", "artist_key", {"name": "artist_name"}),
        Dimension("albums", "album_key", {"name": "album_name", "artist_key": "artist_key"}),
        Dimension("tracks", "track_key", {"name": "track_name", "album_key": "album_key"}),
    ),
    flags=("collaborative",),
    epochs=("modified_at",),
    part="part",
    nullable=("description",),
    references=(
        Reference("albums", "artist_key", "artists", "artist_key"),
        Reference("tracks", "album_key", "albums", "album_key"),
        Reference("playlist_tracks", "pid", "playlists", "pid"),
        Reference("playlist_tracks", "track_key", "tracks", "track_key"),
    ),
)

_staged: dict[tuple, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slice_of(key: str):
    """The slice a parent belongs to."""
    return F.floor(F.col(key) / SLICE_WIDTH).cast("long")


def nested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(slice_id, part, playlists): one document per slice, more where an order is long.

    Line items are shuffled by their order, to number them. Orders and line items are then shuffled once,
    together, on (slice, part): both levels of nesting are built where the rows lie. Each group is bounded
    by construction.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER)
    numbered = positions_by_slice(lines, "l_orderkey", slice_of("l_orderkey"), LINE_ORDER).select("l_orderkey", "pos", "l_suppkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # One base table at a time, so that Catalyst knows the size of each and broadcasts the small ones.
    wide = (
        numbered.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    sources = ["pos", "l_suppkey", "s_name", "n_nationkey", "n_name", "r_regionkey", "r_name"]
    entry = F.struct(*[F.col(s).cast(f.dataType).alias(f.name) for s, f in zip(sources, ENTRY, strict=True)])
    head = StructType([f for f in PARENT if f.name not in {"pid", "part", "tracks"}])
    entries = wide.select(
        F.col("l_orderkey").alias("pid"),
        F.floor(F.col("pos") / PART_ENTRIES).cast("int").alias("part"),
        F.lit(None).cast(head).alias("head"),
        entry.alias("entry"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pid"),
        F.lit(0).alias("part"),
        F.struct(
            F.col("o_orderpriority").alias("name"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("description"),
            F.when(F.col("o_orderstatus") == "F", "true").otherwise("false").alias("collaborative"),
            timestamp_to_epoch("o_orderdate").alias("modified_at"),
        ).alias("head"),
        F.lit(None).cast(ENTRY).alias("entry"),
    )
    rows = orders.unionByName(entries).withColumn("slice_id", slice_of("pid"))
    # Both tables are counted from the footers of their files.
    rows = spread_by(rows, lines.count() + orders.count(), "slice_id", "part")
    parents = rows.groupBy("slice_id", "part", "pid").agg(
        F.first("head", ignorenulls=True).alias("head"),
        F.sort_array(F.collect_list("entry")).alias("tracks"),
    )
    parent = F.struct("pid", "head.*", "part", "tracks")
    return parents.groupBy("slice_id", "part").agg(F.sort_array(F.collect_list(parent)).alias("playlists"))


def input_identity(spark: SparkSession, sf_dir: str) -> tuple:
    """Sizes and times of the files behind the documents: another value once a table is replaced."""
    found = []
    for name in ("orders", "lineitem", "supplier", "nation", "region"):
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        # A file lists itself, a folder its files.
        for status in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place):
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return (spark.sparkContext.applicationId, *found)


def staged_documents(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the documents as JSON, one per line, compressed; written once per session and input.

    Every entry repeats names and keys: compressed, the text takes about a tenth of its size. A compressed file is
    read by one task, so there are as many files as partitions of ``nested_documents``.
    """
    key = input_identity(spark, sf_dir)
    if key not in _staged:
        path = new_path(spark, "documents")
        nested_documents(spark, sf_dir).select("playlists").write.json(path, compression="gzip")
        _staged[key] = path
    return _staged[key]
