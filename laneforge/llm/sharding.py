"""K-d tree sharding in DataFrame operations.

Rows are points in dimensions of metadata: the length of the text, its source, its language and its
id. A node is split along its widest dimension at the weighted median, or at the weighted fraction
that its number of leaves asks for, until each leaf is one shard of the target bytes. The median
comes from histograms of bytes over a dimension's bins; rows of the median bin are told apart by a
hash, again by histogram, so ties of any number split near the right byte. All nodes of a level are
split in one job over narrow rows. A join with a row for each node is a broadcast while there are few nodes.

The law is ``bytes``: shards get near equal sizes. A split misses its goal by half a document, or by half of
what shares a bin and a hash of ``TIES``, so small nodes of long documents are the least equal. No groups
are held together; equal texts may lie in different shards.

The width of a number's dimension is the range of its bins; that of a name's is the share of all names that
a node holds, on the same scale.

Defined cases: a null text has 16 bytes and the CRC of an empty one. A null source, language or id
lies in bin 0 of its dimension. Repeated rows are separate rows, and those that agree in id, size and CRC are
numbered, so that they split like others. Rows are told apart by their address in the table. An empty table
gives an empty result. Other columns pass through ``assign``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laneforge.llm.common import addressed, numbered_within, saved, small_side, text_crc32, unused, utf8_size

OVERHEAD = 16
SHARDS = 40
BINS = 256
#: Values of the hash that orders the rows of one bin: a split falls between two of them.
TIES = 4096
DIMENSIONS = ("length", "source", "lang", "id")
NAMES = (1, 2)  # the dimensions of names


def scaled(value: Column, ends: tuple[float | None, float | None]) -> Column:
    """The bin of a number between the least and the greatest of all; 0 for null or where all are alike."""
    low, high = ends
    if low is None or low == high:
        return F.lit(0)
    share = (value - F.lit(low)) / F.lit(high - low)
    return F.coalesce(F.least(F.lit(BINS - 1), F.floor(share * BINS).cast("int")), F.lit(0))


def hashed(value: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(value.cast("string").cast("binary")), F.lit(BINS)).cast("int"), F.lit(0))


def points(told: DataFrame, keys: list[str], id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, list[int]]:
    """A narrow row for each document: its address, size and CRC, bins and tie hash; and how many bins each dimension of names has."""
    body = F.col(text)
    base = told.select(
        F.col(id_col).alias("id"), (utf8_size(body) + OVERHEAD).alias("size"), text_crc32(body).alias("crc"),
        *((hashed(F.col(c)) if c in told.columns else F.lit(0)).alias(f"d_{c}") for c in ("source", "lang")),
        *(F.col(k).alias(a) for k, a in zip(keys, ("file", "at"))),
    )
    base = saved(base.withColumn("same", F.xxhash64("id", "size", "crc")))
    number = F.col("id").cast("double") if dict(base.dtypes)["id"] in ("bigint", "int", "smallint", "tinyint") else F.pmod(F.xxhash64("id"), F.lit(1 << 20)).cast("double")
    length = F.log2(F.col("size").cast("double"))
    ends = base.agg(F.min(number), F.max(number), F.min(length), F.max(length), F.count_distinct("d_source"), F.count_distinct("d_lang")).first()  # one row
    rows = numbered_within(base, "same", "copy", ["file", "at"]).select(
        "id", "size", "crc", "file", "at",
        F.array(scaled(length, ends[2:4]), "d_source", "d_lang", scaled(number, ends[:2])).alias("bins"),
        F.pmod(F.xxhash64("same", "copy"), F.lit(TIES)).cast("int").alias("tie"),
    )
    return rows, list(ends[4:])


def split_level(rows: DataFrame, nodes: int, names: list[int]) -> DataFrame:
    """Every node with several leaves split in two; ``node`` is the first leaf below, ``leaves`` their number.

    First the widest dimension and the bin that holds the goal, from a histogram of all bins; then, from
    one of that bin's rows by tie hash, the last hash that goes left, -1 for none, nearest to the goal.
    A node has ``BINS`` or ``TIES`` rows of a histogram at most, and one row of the joined tables; there are
    ``nodes`` nodes at most. ``names`` has how many bins each dimension of names has.
    """
    open_rows = rows.where("leaves > 1")
    dims = open_rows.select("node", "leaves", "size", F.posexplode("bins").alias("dim", "bin"))
    histogram = dims.groupBy("node", "leaves", "dim", "bin").agg(F.sum("size").alias("w"))
    spread = (F.max("bin") - F.min("bin")).cast("double")
    for dim, many in zip(NAMES, names):
        spread = F.when(F.col("dim") == dim, (F.count("bin") - 1) * (float(BINS - 1) / max(1, many - 1))).otherwise(spread)
    width = histogram.groupBy("node", "leaves", "dim").agg(spread.alias("width"), F.sum("w").alias("total"))
    goal = F.max("total") * F.floor(F.col("leaves") / 2) / F.col("leaves")
    goals = width.groupBy("node", "leaves").agg(F.max_by("dim", F.struct("width", -F.col("dim"))).alias("dim"), goal.alias("goal")).drop("leaves")
    run = Window.partitionBy("node").orderBy("bin")
    reached = histogram.join(small_side(goals, nodes), ["node", "dim"]).withColumn("upto", F.sum("w").over(run)).where("upto >= goal")
    median = reached.groupBy("node").agg(F.min_by(F.struct("dim", "goal", F.col("bin").alias("cut"), (F.col("upto") - F.col("w")).alias("before")), "bin").alias("s")).select("node", "s.*")
    inside = open_rows.join(small_side(median, nodes), "node").where(F.get("bins", F.col("dim")) == F.col("cut"))
    ties = inside.groupBy("node", "dim", "cut", "goal", "before", "tie").agg(F.sum("size").alias("w"))
    left = F.col("before") + F.sum("w").over(Window.partitionBy("node").orderBy("tie"))
    off = F.struct(F.abs(left - F.col("goal")).alias("off"), F.col("tie").alias("tie"))
    best = ties.withColumn("off", off).groupBy("node", "dim", "cut", "goal", "before").agg(F.min("off").alias("best"))
    none = F.abs(F.col("before") - F.col("goal")) <= F.col("best.off")
    splits = best.select("node", "dim", "cut", F.when(none, -1).otherwise(F.col("best.tie")).alias("last_tie"))
    joined = rows.join(small_side(splits, nodes), "node", "left")
    bin_ = F.get("bins", F.col("dim"))
    goes_left = (bin_ < F.col("cut")) | (bin_ == F.col("cut")) & (F.col("tie") <= F.col("last_tie"))
    half, whole = F.floor(F.col("leaves") / 2).cast("int"), F.col("dim").isNull()
    node = F.when(whole | goes_left, F.col("node")).otherwise(F.col("node") + half)
    leaves = F.when(whole, F.col("leaves")).when(goes_left, half).otherwise(F.col("leaves") - half)
    return joined.select("id", "size", "crc", "file", "at", "bins", "tie", node.cast("int").alias("node"), leaves.cast("int").alias("leaves"))


def shards(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id", text: str = "text", is_table: bool = False) -> DataFrame:
    """``id``, ``size``, ``crc``, ``shard`` and ``slot`` of each row and its address ``file``, ``at``, for so many shards or for shards of ``target_bytes``."""
    told, keys = addressed(docs, is_table)
    return shards_of(told, keys, n_shards, target_bytes, id_col, text)


def shards_of(told: DataFrame, keys: list[str], n_shards: int | None, target_bytes: int | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``shards`` for rows that have the address ``keys``."""
    rows, names = points(told, keys, id_col, text)
    if n_shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        n_shards = max(1, round(total / target_bytes))
    rows = saved(rows.withColumn("node", F.lit(0)).withColumn("leaves", F.lit(n_shards)))
    for level in range(max(0, n_shards - 1).bit_length()):
        rows = saved(split_level(rows, min(1 << level, n_shards), names))
    return numbered_within(rows, "node", "slot", ["file", "at"]).select("file", "at", "id", "size", "crc", F.col("node").alias("shard"), "slot")


def assign(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id", text: str = "text", is_table: bool = False) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, in place of columns of these names. Leaves are near equal in bytes: a test holds their spread under 6 %."""
    told, keys = addressed(docs, is_table)
    names, shard, slot = [c for c in docs.columns if c not in ("shard", "slot")], *(unused(told, c) for c in ("shard", "slot"))
    placed = shards_of(told, keys, n_shards, target_bytes, id_col, text)
    placed = placed.select(F.col("file").alias(keys[0]), F.col("at").alias(keys[1]), F.col("shard").alias(shard), F.col("slot").alias(slot))
    return told.join(placed, keys).select(*(F.col(f"`{c}`") for c in names), F.col(shard).alias("shard"), F.col(slot).alias("slot"))


def placements(docs: DataFrame) -> DataFrame:
    """Where each document of a stored table goes, over 40 shards."""
    return shards(docs, SHARDS, is_table=True).select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
