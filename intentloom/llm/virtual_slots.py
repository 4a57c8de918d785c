"""Shards by fixed virtual slots and a versioned map of slots to shards.

A record belongs for ever to one of ``SLOTS`` virtual slots, by a hash of its id. Bytes and rows are
summed for each slot, and only this table, of a bounded number of rows, decides where slots go. The
first version of the map deals the slots out in turn. ``rebalanced`` edits it: shards above their fair
share give up their lightest slots as far as needed, and these go, heaviest first, to the shard that
has least. ``grown`` edits it for one more shard: each of the others gives slots to it alone. A
version is a table (slot, piece, pieces, shard) and is stored; older versions stay readable.

Balance must not end at one hot id: a slot heavier than ``PIECE`` of a shard's fair share is cut into
pieces that are slots of their own; its rows go to pieces by a hash of their number. Numbers within
a shard are given in ranges of slots and pieces, with counts added up over the ranges, so no shard is
sorted as a whole.

Size is the UTF-8 length of the text plus 8; a null text has no bytes and the check sum of an empty
one. A null id is a key like any other. Repeated rows are rows of their own. An empty table gives no
rows. The law that holds is ``bytes``: shards are equal but for about the lightest slot, unless a
single record is heavier than a fair share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from intentloom.llm.runtime import stored

SLOTS = 4096
PIECE = 1 / 64
#: Rows numbered in one range.
RANGE = 1 << 20


def slot_of(*key: str, slots: int = SLOTS) -> Column:
    """The virtual slot of a record: never changes with data, shards or versions."""
    return F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")


def slot_sizes(records: DataFrame, shards: int) -> DataFrame:
    """(slot, piece, pieces, bytes, n) of records (virtual_slot, size, number): the table that maps are made from."""
    by_slot = stored(records.groupBy(F.col("virtual_slot").alias("slot")).agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "slots")
    whole = by_slot.agg(F.sum("bytes"), F.sum("n")).first()
    most_bytes, most_rows = (max(int((x or 0) / shards * PIECE), 1) for x in whole)
    pieces = F.ceil(F.greatest(F.col("bytes") / most_bytes, F.col("n") / most_rows)).cast("int")
    known = pieced(records, by_slot.select("slot", pieces.alias("pieces")).where("pieces > 1"))
    return stored(known.groupBy("slot", "piece", "pieces").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "sizes")


def pieced(records: DataFrame, pieces: DataFrame) -> DataFrame:
    """Records with slot, pieces and piece. A row for each slot at most, so ``pieces`` may be broadcast."""
    out = records.withColumnRenamed("virtual_slot", "slot").join(F.broadcast(pieces.select("slot", "pieces").distinct()), "slot", "left")
    out = out.withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    return out.withColumn("piece", F.pmod(F.xxhash64("number"), F.col("pieces")).cast("int"))


def first_map(sizes: DataFrame, shards: int) -> DataFrame:
    """Version 0: slots in turn, pieces of a slot on shards one after the other."""
    return stored(sizes.select("slot", "piece", "pieces", F.pmod(F.col("slot") + F.col("piece"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("version")), "map")


def _weighed(sizes: DataFrame, known: DataFrame, shards: int) -> DataFrame:
    """The map with bytes, and whether a slot stays where it is if no shard may have more than its share of ``shards``."""
    fair = (sizes.agg(F.sum("bytes")).first()[0] or 0) / shards
    heaviest = Window.partitionBy("shard").orderBy(F.desc("bytes"), "slot", "piece").rowsBetween(Window.unboundedPreceding, 0)
    return sizes.select("slot", "piece", "bytes").join(known, ["slot", "piece"]).withColumn("stays", F.sum("bytes").over(heaviest) <= fair)


def rebalanced(sizes: DataFrame, known: DataFrame, shards: int) -> DataFrame:
    """The next version: shards above their fair share give up what is above it; these slots go where least is."""
    at = stored(_weighed(sizes, known, shards), "weighed")
    # a fold over one list of slots, the number of which is bounded: the first load is always the least
    moved = at.groupBy().agg(F.collect_list(F.struct("stays", "bytes", "slot", "piece", "shard")).alias("all")).selectExpr(
        "array_sort(transform(filter(all, x -> not x.stays), x -> struct(-x.bytes as less, x.slot as slot, x.piece as piece))) as free",
        f"""array_sort(transform(sequence(0, {shards - 1}), s -> named_struct('load',
            aggregate(filter(all, x -> x.stays and x.shard = s), 0L, (a, x) -> a + x.bytes), 'shard', s))) as loads""",
    ).selectExpr(
        """explode(aggregate(free, named_struct('loads', loads, 'out', cast(array() as array<struct<slot: int, piece: int, to: int>>)),
            (s, x) -> named_struct(
                'loads', array_sort(array_append(slice(s.loads, 2, size(s.loads) - 1),
                    named_struct('load', s.loads[0].load - x.less, 'shard', s.loads[0].shard))),
                'out', array_append(s.out, named_struct('slot', x.slot, 'piece', x.piece, 'to', s.loads[0].shard))),
            s -> s.out)) as m"""
    ).select("m.*")
    out = known.join(moved, ["slot", "piece"], "left")
    return stored(out.select("slot", "piece", "pieces", F.coalesce("to", "shard").alias("shard"), (F.col("version") + 1).alias("version")), "map")


def grown(sizes: DataFrame, known: DataFrame, shards: int) -> DataFrame:
    """The next version, with one shard more than ``shards``: what is above the smaller share goes to it, and nothing else moves."""
    at = _weighed(sizes, known, shards + 1)
    to = F.when(F.col("stays"), F.col("shard")).otherwise(F.lit(shards)).cast("int")
    return stored(at.select("slot", "piece", "pieces", to.alias("shard"), (F.col("version") + 1).alias("version")), "map")


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, number) of every row, stored, so that numbers stay as they are."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return stored(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        slot_of(id_col, slots=slots).alias("virtual_slot"), F.monotonically_increasing_id().alias("number"),
    ), "records")


def placed(records: DataFrame, sizes: DataFrame, known: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Records with their shard and a gapless number from 0 within it, ``slot``."""
    rows = sizes.agg(F.sum("n")).first()[0] or 0
    at = pieced(records, known.where("pieces > 1")).join(F.broadcast(known.select("slot", "piece", "shard")), ["slot", "piece"])
    at = at.withColumn("range", F.pmod(F.xxhash64(F.lit(7), "number"), F.lit(1 + rows // (slots * RANGE))).cast("int"))
    group = ["shard", "slot", "piece", "range"]
    before = Window.partitionBy("shard").orderBy("slot", "piece", "range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = at.groupBy(*group).agg(F.count("*").alias("n")).select(*group, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    inside = F.row_number().over(Window.partitionBy(*group).orderBy("doc_id", "number")) - 1
    at = at.withColumn("inside", inside).join(ahead, group)
    return at.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("inside") + F.col("ahead")).cast("long").alias("place"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("slot").alias("virtual_slot"),
    ).withColumnRenamed("place", "slot")


def deal(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """Every row with its shard by the balanced map."""
    rows = records(docs, id_col, text_col, slots)
    sizes = slot_sizes(rows, shards)
    return placed(rows, sizes, rebalanced(sizes, first_map(sizes, shards), shards), slots)
