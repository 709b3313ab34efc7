"""The trie of conversation prefixes, found by cutting turns off from the deepest conversations on.

A prefix is known by a sum of hashes, one for each turn and its place. So the prefix without its
last turn is a subtraction away, and a conversation's sums can be built from blocks of turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flatloom.llm.text import NULL_ID
from flatloom.operators.numbering import positions_within
from flatloom.scratch import empty, new_path, written

# A conversation opens with turns of the first one of its group of this many ids, this many less one at most.
GROUP, OPENING = 20, 4
WORD = r"[^\x20\x09-\x0D]+"
# Three sums of hashes of this many bits, added up modulo a power of two, tell prefixes apart.
_LANES = ("k1", "k2", "k3")
_BITS = 42
_MODULUS = 1 << _BITS
# Turns whose hashes are summed in one group; the sums of such blocks are added up one row per block.
_BLOCK = 4096
# Bytes of joined ids that are passed on in one row.
_PIECE_BYTES = 1 << 20

_NODE = ("depth", *_LANES)
_RESULT = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _or_empty(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, turn hashes, words) with places from 0; the texts are needed no further."""
    role, text = _or_empty("role"), _or_empty("text")
    digest = F.sha2(F.concat_ws(":", F.octet_length(role), role, text), 256)
    half = [F.conv(F.substring(digest, at, 16), 16, -10).cast("long") for at in (1, 17)]
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NULL_ID)).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        half[0].alias("t1"),
        half[1].alias("t2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    numbered = positions_within(rows, "conv", ["turn", "t1", "t2"])
    return written(numbered.select("conv", F.col("pos").cast("long").alias("pos"), "t1", "t2", "words"), "turns")


def _decimal(conv: Column) -> Column:
    """An id as decimal text; that of no id is empty."""
    return F.when(conv == NULL_ID, F.lit("")).otherwise(conv.cast("string"))


def rebuilt(turns: DataFrame, group: int = GROUP, opening: int = OPENING) -> tuple[DataFrame, DataFrame]:
    """(rebuilt turns, rebuilt conversations with their length)."""
    conv = F.col("conv")
    head = (F.crc32(_decimal(conv).cast("binary")) % opening).alias("head")
    base = F.when(conv == NULL_ID, conv).otherwise(conv - conv % group).alias("base")
    own = turns.groupBy("conv").agg((F.max("pos") + 1).alias("turns")).select("conv", "turns", head, base)
    own = written(own, "conversations")
    bases = own.select(F.col("conv").alias("base"), F.col("turns").alias("_base_turns"))
    joined = own.join(bases, "base", "left").withColumn(
        "lead", F.least("head", F.coalesce("_base_turns", F.lit(0).cast("long")))
    )
    length = F.col("lead") + F.greatest(F.col("turns") - F.col("head"), F.lit(0))
    # Written, so that both sides of the joins come straight from a shuffle and the turns of one
    # very long conversation can be split.
    convs = written(joined.select("conv", "base", "head", "lead", length.alias("length")), "lengths")
    columns = ("conv", "pos", "t1", "t2", "words", "length")
    first = turns.filter(F.col("pos") < opening - 1).withColumnRenamed("conv", "base")
    borrowed = convs.join(first, "base").filter(F.col("pos") < F.col("head")).select(*columns)
    left = turns.join(convs, "conv").filter(F.col("pos") >= F.col("head"))
    left = left.withColumn("pos", F.col("pos") - F.col("head") + F.col("lead")).select(*columns)
    return borrowed.unionByName(left), convs.select("conv", "length")


def _with_prefixes(rows: DataFrame) -> DataFrame:
    """Every rebuilt turn with the node that it ends: depth, three sums, and its own share of them."""
    shares = [
        F.xxhash64(F.lit(i), "pos", "t1", "t2").bitwiseAND(F.lit(_MODULUS - 1)).alias(f"h{i}") for i in (1, 2, 3)
    ]
    block = F.floor(F.col("pos") / _BLOCK).alias("block")
    hashed = written(rows.select("conv", "pos", "words", "length", block, *shares), "hashed-turns")
    sums = hashed.groupBy("conv", "block").agg(*(F.pmod(F.sum(f"h{i}"), F.lit(_MODULUS)).alias(f"b{i}") for i in (1, 2, 3)))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("conv", "block", *(F.coalesce(F.sum(f"b{i}").over(before), F.lit(0)).alias(f"s{i}") for i in (1, 2, 3)))
    within = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = hashed.select("*", *(F.sum(f"h{i}").over(within).alias(f"w{i}") for i in (1, 2, 3)))
    keys = [F.pmod(F.col(f"w{i}") + F.col(f"s{i}"), F.lit(_MODULUS)).alias(f"k{i}") for i in (1, 2, 3)]
    return local.join(starts, ["conv", "block"]).select(
        "conv", (F.col("pos") + 1).alias("depth"), *keys, "h1", "h2", "h3", "words", "length"
    )


def _parent(prefix: str = "") -> list[Column]:
    """The node without its last turn."""
    lanes = [F.pmod(F.col(f"k{i}") - F.col(f"h{i}"), F.lit(_MODULUS)).alias(f"{prefix}k{i}") for i in (1, 2, 3)]
    return [(F.col("depth") - 1).alias(f"{prefix}depth"), *lanes]


def _skip_chains(nodes: DataFrame) -> DataFrame:
    """For nodes with one way down and no end: the first node below that is not such a one, and
    the words of the nodes from here down to it. The length of the steps doubles, so the number of
    rounds grows with the logarithm of the longest chain."""
    only = nodes.filter("shared and n_ends = 0 and n_children = 1")
    ends = [F.struct(*(F.col(f"{end}_{c}").alias(c) for c in _NODE)).alias(name) for end, name in (("up", "up"), ("only", "to"))]
    hops = written(only.select(*_NODE, *ends, F.col("words").alias("way")), "hops")
    while True:
        next_hop = hops.select(F.struct(*_NODE).alias("to"), F.col("to").alias("_then"), F.col("way").alias("_more"))
        longer = hops.join(next_hop, "to", "left")
        if hops.join(next_hop, "to", "left_semi").isEmpty():
            return hops
        hops = written(
            longer.select(
                *_NODE,
                "up",
                F.coalesce("_then", "to").alias("to"),
                (F.col("way") + F.coalesce("_more", F.lit(0).cast("long"))).alias("way"),
            ),
            "hops",
        )


def _peeled(nodes: DataFrame, hops: DataFrame) -> DataFrame:
    """(node, n_leaves, saved) of the shared nodes at which conversations part or end.

    From the deepest such depth up: what has been cut back to this depth is merged with the
    conversations that end or go their own way here, and regrouped by node; then turns are cut
    off up to the next node above at which others join, and the sums wait for that depth.
    """
    spark = nodes.sparkSession
    # The top of a chain hangs on a node that is no hop itself.
    tops = hops.join(hops.select(F.struct(*_NODE).alias("up")), "up", "left_anti").select("to", F.col("up").alias("_up"), "way")
    meets = nodes.filter("shared and not (n_ends = 0 and n_children = 1)").withColumn("to", F.struct(*_NODE))
    meets = meets.join(tops, "to", "left").select(
        *_NODE,
        F.when(F.col("depth") > 0, F.coalesce(F.col("_up"), F.struct(*(F.col(f"up_{c}").alias(c) for c in _NODE)))).alias("up"),
        F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_lone")).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("own"),
        ((F.col("n_convs") - 1) * F.coalesce("way", F.lit(0).cast("long"))).alias("on_the_way"),
    )
    arrivals, waiting, done = new_path(spark, "meetings"), new_path(spark, "waiting"), new_path(spark, "peeled")
    meets.write.partitionBy("depth").parquet(arrivals)
    depths = spark.read.schema(meets.schema).parquet(arrivals).select("depth").distinct()
    # One number per depth at which shared conversations part or end.
    levels = sorted((r["depth"] for r in depths.collect()), reverse=True)
    sums = "k1 long, k2 long, k3 long, leaves long, saved long"
    if not levels:
        return empty(spark, StructType.fromDDL(f"depth long, {sums}")).withColumnRenamed("leaves", "n_leaves")
    waits: set[int] = set()
    for depth in levels:
        here = spark.read.schema(meets.drop("depth").schema).parquet(f"{arrivals}/depth={depth}")
        cut_back = here.select(*_LANES, "leaves", F.col("own").alias("saved"))
        if depth in waits:
            cut_back = cut_back.unionByName(spark.read.schema(sums).parquet(f"{waiting}/depth={depth}"))
        merged = cut_back.groupBy(*_LANES).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        now = f"{done}/depth={depth}"
        merged.join(here.select(*_LANES, "up", "on_the_way"), list(_LANES)).write.parquet(now)
        if depth > 0:
            kept = spark.read.parquet(now)
            up = kept.groupBy("up").agg(F.sum("leaves").alias("leaves"), F.sum(F.col("saved") + F.col("on_the_way")).alias("saved"))
            up = written(up.select("up.*", "leaves", "saved"), "cut-back")
            up.write.mode("append").partitionBy("depth").parquet(waiting)
            waits |= {r["depth"] for r in up.select("depth").distinct().collect()}
    fields = "k1 long, k2 long, k3 long, leaves long, saved long, depth long"
    found = spark.read.schema(fields).option("basePath", done).parquet(done)
    return found.select(*_NODE, F.col("leaves").alias("n_leaves"), "saved")


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, id) rows to joined ids, in rows of bounded size."""
    node, first, parts, size = None, 0, [], 0
    names = [*_NODE, "first", "ids"]

    def row() -> pa.RecordBatch:
        columns = [pa.array([x], pa.int64()) for x in (*node, first)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([",".join(parts)], pa.string())], names)

    for batch in batches:
        lists = [batch.column(i).to_pylist() for i in range(5)]
        for *at, conv, text in zip(*lists, batch.column(5).to_pylist(), strict=True):
            if at != node or size > _PIECE_BYTES:
                if node is not None:
                    yield row()
                node, first, parts, size = at, conv, [], 0
            parts.append(text)
            size += len(text) + 1
    if node is not None:
        yield row()


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one digest for each node, holding one piece at a time."""
    node, digest = None, None
    names = [*_NODE, "ends_sha256"]

    def row() -> pa.RecordBatch:
        columns = [pa.array([x], pa.int64()) for x in node]
        return pa.RecordBatch.from_arrays([*columns, pa.array([digest.hexdigest()], pa.string())], names)

    for batch in batches:
        for i in range(batch.num_rows):
            at = [batch.column(j)[i].as_py() for j in range(4)]
            text = batch.column(5)[i].as_py().encode()
            if at == node:
                digest.update(b"," + text)
                continue
            if node is not None:
                yield row()
            node, digest = at, hashlib.sha256(text)
    if node is not None:
        yield row()


def _ends(ended: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, ends_sha256) where several conversations end: their ids sorted over ranges, joined in
    pieces, and the pieces hashed in order."""
    several = written(nodes.filter("n_ends > 1").select(*_NODE), "common-ends")
    key = ", ".join(f"{c} long" for c in _NODE)
    ids = ended.join(several, list(_NODE), "left_semi").select(*_NODE, "conv", _decimal(F.col("conv")).alias("text"))
    ordered = ids.repartitionByRange(*_NODE, "conv").sortWithinPartitions(*_NODE, "conv")
    pieces = written(ordered.mapInArrow(_pieces, f"{key}, first long, ids string"), "pieces")
    dealt = pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "first")
    return dealt.mapInArrow(_hashed, f"{key}, ends_sha256 string")


def prefix_nodes(conversations: DataFrame, group: int = GROUP, opening: int = OPENING) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    ``conversations`` has conv_id, turn, role, text; other columns are left out. A conversation's turns
    are ordered by ``turn``, null first; turns of one number are ordered by the digest of role and text,
    and repeated rows are turns of their own. A null role or text counts as empty. A null conv_id
    is a conversation of its own, below all others, whose decimal form is empty and whose base is
    itself. Every conversation opens with up to ``crc32(id) % opening`` first turns of the first
    conversation of its ``group`` of ids, none if that one does not exist, and goes on with its own
    turns after as many; ``%`` has the sign of the id. No conversations give no rows.

    Prefixes are told apart by their depth and 126 bits of hashes. Turns are numbered, summed and
    grouped by keys that a very long conversation, or a very common prefix, cannot fill: places are
    found over sorted ranges, hashes are summed by blocks, counts have a partial step. What is not
    shared needs no merging: a prefix that one conversation has alone is a row as it is. Shared prefixes are
    cut back from the deepest on (``_peeled``), one step for each depth at which shared conversations
    part or end; the turns between are skipped.
    """
    turns = _turns(conversations)
    rows, convs = rebuilt(turns, group, opening)
    whole = convs.agg(
        F.count("*").alias("n"), F.min("conv").alias("least"), F.count_if(F.col("length") == 0).alias("ends"),
        F.min(F.when(F.col("length") == 0, F.col("conv"))).alias("end"),
    ).first()
    spark = conversations.sparkSession
    if not whole["n"]:
        return empty(spark, StructType.fromDDL(_RESULT))
    prefixes = written(_with_prefixes(rows), "prefixes")
    ended = F.col("depth") == F.col("length")
    found = prefixes.groupBy(*_NODE).agg(
        F.count("*").alias("n_convs"),
        F.min("conv").alias("least"),
        *(F.max(c).alias(c) for c in ("h1", "h2", "h3", "words")),
        F.count_if(ended).alias("n_ends"),
        F.min(F.when(ended, F.col("conv"))).alias("end"),
    )
    found = found.select(*_NODE, *_parent("up_"), "n_convs", "least", "words", "n_ends", "end")
    zero = F.lit(0).cast("long")
    root = spark.range(1).select(
        *(zero.alias(c) for c in _NODE),
        F.lit(-1).cast("long").alias("up_depth"),
        *(zero.alias(f"up_{c}") for c in _LANES),
        *(F.lit(x).cast("long").alias(c) for c, x in (("n_convs", whole["n"]), ("least", whole["least"]), ("words", 0), ("n_ends", whole["ends"]), ("end", whole["end"]))),
    )
    found = written(found.unionByName(root), "prefix-nodes")
    lone = F.col("n_convs") == 1
    children = found.filter("depth > 0").groupBy(*(F.col(f"up_{c}").alias(c) for c in _NODE)).agg(
        F.count("*").alias("n_children"), F.count_if(lone).alias("n_lone"), *(F.max(c).alias(f"only_{c}") for c in _NODE)
    )
    nodes = found.join(children, list(_NODE), "left")
    nodes = nodes.fillna(0, ["n_children", "n_lone"]).withColumn("shared", (F.col("n_convs") > 1) | (F.col("depth") == 0))
    nodes = written(nodes, "nodes-and-children")
    hops = _skip_chains(nodes)
    met = _peeled(nodes, hops)
    # Along a chain the leaves stay the same, and every turn saves as much as its copies.
    skipped = hops.join(met.select(F.struct(*_NODE).alias("to"), "n_leaves", "saved"), "to").select(*_NODE, "n_leaves", "saved", "way")
    sums = written(met.withColumn("way", zero).unionByName(skipped), "sums")
    ends = prefixes.filter(ended).select(*_NODE, "conv").unionByName(
        convs.filter("length = 0").select(*(zero.alias(c) for c in _NODE), "conv")
    )
    digests = written(_ends(ends, nodes), "digests")
    parents = nodes.select(*(F.col(c).alias(f"up_{c}") for c in _NODE), F.col("least").alias("parent"))
    ups = [f"up_{c}" for c in _NODE]
    # The children of the root need no join: its smallest member is known.
    out = nodes.filter("depth > 1").join(parents, ups).unionByName(
        nodes.filter("depth <= 1").withColumn("parent", F.when(F.col("depth") == 1, F.lit(whole["least"])).cast("long"))
    )
    out = out.join(sums, list(_NODE), "left").join(digests, list(_NODE), "left")
    one_end = F.when(F.col("n_ends") == 1, F.sha2(_decimal(F.col("end")).cast("binary"), 256))
    return out.select(
        _public("least").alias("conv_id"),
        "depth",
        _public("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce(F.col("saved") + (F.col("n_convs") - 1) * F.col("way"), zero).alias("saved_tokens"),
        F.coalesce("ends_sha256", one_end, F.lit(_EMPTY_SHA)).alias("ends_sha256"),
    )


def _public(column: str) -> Column:
    return F.when(F.col(column) != NULL_ID, F.col(column))
