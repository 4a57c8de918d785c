"""Trie of conversation prefixes, built as a z-fast trie in tables.

A conversation is its sequence of (role, text) turns. Each prefix of it has a 128-bit hash, the xor of
the hashes of its turns with their positions, so all of a conversation's prefixes come from one running
aggregate. The trie is kept compacted: one row for each node where conversations branch or end, with
its extent (depth and hash), the depth of the node above and a conversation that runs through it. A
node's handle is the prefix at the two-fattest depth of its edge, the one with most low zero bits.

Conversations are inserted in batches. All pending ones look for their exit node at once by fat binary
search: each step looks up one handle for each, so a search takes as many joins as the longest
conversation's length has bits, whatever the depth of the trie. Of those that leave the trie at one
point by the same turn, one drawn by hash joins the batch; the others go on from that point in the
next round, with the depth of the rest shrinking as by random pivots. Edges are split where
conversations leave them. In the end, counts rise through the compacted trie by pointer doubling, and
edges are expanded into one row for each prefix.

Rows are (conversation, depth) and hashes throughout: no conversation or group is gathered, a hot
handle is only a hot key of a join that adaptive execution splits, and a conversation that holds a
large share of all turns is numbered in ranges. The SHA-256 of a node's members is taken over a stream
of sorted pieces of up to 1,024 ids.

A null role or text counts as empty. Turns are ordered by turn (null first), then role and text, so
repeated turns have a defined order. Rows without a conversation id belong to none and are left out;
an empty table has no nodes, not even a root. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from intentloom.llm.runtime import partitions, stored

IDS = 1024
EXPAND = 1024
ROOT = "named_struct('x', 0L, 'y', 0L)"


def _hash(*of: str) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(17), *of), F.xxhash64(*of, F.lit(29))


def turns(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """(c, pos, part, t1, t2, words): the turns of each conversation by number from 1, as hashes.

    Sorted ranges number their rows; what a conversation has in earlier ranges is added, so a long one is counted in parts.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text")))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("c"), F.col(turn_col).alias("turn"), role, text)
    t1, t2 = _hash("role", "text")
    words = F.size(F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).cast("long")
    order = ["c", "turn", "role", "text"]
    ranged = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    ranged = stored(ranged.select("c", F.monotonically_increasing_id().alias("at"), t1.alias("t1"), t2.alias("t2"), words.alias("words")), "ranged")
    ranged = ranged.withColumn("part", F.shiftright("at", 33).cast("int"))
    ahead = ranged.groupBy("c", "part").agg(F.count("*").alias("n")).select(
        "c", "part", F.coalesce(F.sum("n").over(Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead")
    )
    inside = F.row_number().over(Window.partitionBy("c", "part").orderBy("at"))
    numbered = ranged.withColumn("inside", inside).join(ahead, ["c", "part"])
    return numbered.select("c", (F.col("inside") + F.col("ahead")).cast("long").alias("pos"), "part", "t1", "t2", "words")


def rebuilt(turns: DataFrame, heads: Column, base: Column) -> tuple[DataFrame, DataFrame]:
    """(c, d, part, t1, t2, words) of conversations that begin with ``heads`` turns of the conversation ``base``, and all (c)."""
    own = turns.groupBy("c").agg(F.max("pos").alias("n")).select("c", "n", heads.alias("h"), base.alias("b"))
    there = own.select(F.col("c").alias("b"), F.col("n").alias("nb"))
    own = own.join(there, "b", "left").select("c", "b", "h", F.least("h", F.coalesce("nb", F.lit(0))).cast("long").alias("head"))
    most = own.agg(F.max("head")).first()[0] or 0
    first = turns.where(F.col("pos") <= most).select(F.col("c").alias("b"), "pos", "t1", "t2", "words")
    front = own.where("head > 0").select("c", "b", F.explode(F.sequence(F.lit(1).cast("long"), "head")).alias("pos")).join(first, ["b", "pos"])
    back = turns.join(own, "c").where("pos > h")
    rows = front.select("c", F.col("pos").alias("d"), F.lit(-1).alias("part"), "t1", "t2", "words").union(
        back.select("c", (F.col("pos") - F.col("h") + F.col("head")).alias("d"), "part", "t1", "t2", "words")
    )
    return rows, own.select("c")


def prefixes(rows: DataFrame) -> DataFrame:
    """(c, d, p, words): hash and words of the first d turns, aggregated inside ranges and carried over between them."""
    x, y = _hash("d", "t1", "t2")
    rows = stored(rows.select("c", "d", "part", x.alias("x"), y.alias("y"), "words"), "turns")
    inside = Window.partitionBy("c", "part").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("c", "part").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("words").alias("w"))
    carry = sums.select(
        "c", "part", *(F.coalesce(F.bit_xor(k).over(before), F.lit(0)).alias(f"c{k}") for k in "xy"),
        F.coalesce(F.sum("w").over(before), F.lit(0)).alias("cw"),
    )
    run = rows.select("c", "part", "d", *(F.bit_xor(k).over(inside).alias(k) for k in "xy"), F.sum("words").over(inside).alias("w"))
    joined = run.join(carry, ["c", "part"])
    return joined.select("c", "d", F.struct(*(F.col(k).bitwiseXOR(F.col(f"c{k}")).alias(k) for k in "xy")).alias("p"), (F.col("w") + F.col("cw")).alias("words"))


def fattest(low: str, high: str) -> Column:
    """The number in (low, high] with most low zero bits."""
    return F.expr(f"{high} & shiftleft(-1L, length(bin({low} ^ {high})) - 1)")


def _handles(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """(handle, x, xe, xr, first): each node below the root by the prefix at its two-fattest depth, and by the first of its edge."""
    at = nodes.where("e > 0").select(
        F.col("p").alias("x"), F.col("e").alias("xe"), F.col("r").alias("c"),
        F.explode(F.array(F.struct(fattest("up", "e").alias("d"), F.lit(False).alias("first")), F.struct((F.col("up") + 1).alias("d"), F.lit(True).alias("first")))).alias("h"),
    ).select("x", "xe", "c", "h.*")
    return at.join(paths, ["c", "d"]).select(F.col("p").alias("handle"), "x", "xe", F.col("c").alias("xr"), "first")


def _exits(pending: DataFrame, handles: DataFrame, paths: DataFrame, steps: int) -> DataFrame:
    """(c, n, low, r, e): the exit node, on the edge of which down to ``e`` along ``r`` the conversation leaves the trie.

    ``low`` is a depth down to which it surely matches. It leaves at a node if ``r`` is null. Within the search,
    whole nodes match down to ``low`` and none may below ``high``. A conversation that has found its exit keeps
    asking for depth -1, which nobody has.
    """
    known = handles.where("not first").drop("first")
    at = paths.select("c", "d", "p")
    now = pending.select("c", "n", "low", F.col("n").alias("high"), F.lit(None).cast("long").alias("r"), F.lit(None).cast("long").alias("e"))
    for _ in range(steps):
        now = now.withColumn("d", F.when(F.col("low") < F.col("high"), fattest("low", "high")).otherwise(F.lit(-1).cast("long")))
        now = now.join(at, ["c", "d"], "left").withColumn("handle", F.coalesce("p", F.struct(F.col("c").alias("x"), F.lit(-1).cast("long").alias("y")))).drop("p")
        now = now.join(known, "handle", "left").drop("handle")
        asked = F.when(F.col("xe") <= F.col("n"), F.col("xe")).otherwise(F.lit(-1).cast("long"))
        now = now.withColumn("f", F.col("d")).withColumn("d", asked).join(at, ["c", "d"], "left")
        found, whole = F.col("xe").isNotNull(), F.coalesce(F.col("p") == F.col("x"), F.lit(False))
        on = F.col("f") >= 0
        now = now.select(
            "c", "n",
            F.when(found & whole, F.col("xe")).when(found, F.col("f")).otherwise(F.col("low")).alias("low"),
            # on an edge that it leaves before its end, the search is over
            F.when(found & ~whole, F.col("f")).when(on & ~found, F.col("f") - 1).otherwise(F.col("high")).alias("high"),
            F.when(found & ~whole, F.col("xr")).otherwise(F.col("r")).alias("r"),
            F.when(found & ~whole, F.col("xe")).otherwise(F.col("e")).alias("e"),
        )
    # the last node that matches is known; where there is an edge below by the next turn, its node is the exit
    now = now.withColumn("d", F.when(F.col("r").isNull() & (F.col("low") < F.col("n")), F.col("low") + 1).otherwise(F.lit(-1).cast("long")))
    now = now.join(at, ["c", "d"], "left").withColumn("handle", F.coalesce("p", F.struct(F.col("c").alias("x"), F.lit(-1).cast("long").alias("y")))).drop("p")
    now = now.join(handles.where("first").drop("first", "x"), "handle", "left")
    return now.select(
        "c", "n", F.when(F.col("xr").isNotNull(), F.col("d")).otherwise(F.col("low")).alias("low"),
        F.coalesce("r", "xr").alias("r"), F.coalesce("e", "xe").alias("e"),
    )


def _leaving(exits: DataFrame, paths: DataFrame) -> DataFrame:
    """(c, n, cut, r, e): how far those that leave an edge in its middle go along with the conversation on it."""
    exits = stored(exits, "exits")
    on = exits.where("r is not null")
    # (low, min(e - 1, n)] is where they may still agree; both have a row for each depth
    span = on.select("c", "r", "low", F.least(F.col("e") - 1, F.col("n")).alias("to")).where("low < to")
    steps = F.explode(F.expr(f"sequence(0L, (to - low - 1) div {EXPAND})"))
    depth = F.explode(F.expr(f"sequence(low + 1 + s * {EXPAND}, least(to, low + (s + 1) * {EXPAND}))"))
    span = span.withColumn("s", steps).select("c", "r", depth.alias("d"))
    mine = paths.select("c", "d", "p")
    other = paths.select(F.col("c").alias("r"), "d", F.col("p").alias("q"))
    same = span.join(mine, ["c", "d"]).join(other, ["r", "d"]).where("p = q").groupBy("c").agg(F.max("d").alias("agree"))
    return exits.join(same, "c", "left").select("c", "n", "e", "r", F.greatest("low", F.coalesce("agree", F.lit(0))).alias("cut"))


def compacted(paths: DataFrame, ends: DataFrame) -> DataFrame:
    """(p, e, up, r): the nodes of the compacted trie; r is a conversation through the node, up the depth of the node above.

    ``paths`` has the rows (c, d, p), ``ends`` one conversation (c, n, p) for each distinct one, n its length.
    """
    spark = paths.sparkSession
    longest = ends.agg(F.max("n")).first()[0]
    root = spark.range(1).select(F.expr(ROOT).alias("p"), F.lit(0).cast("long").alias("e"), F.lit(0).cast("long").alias("up"), F.lit(None).cast("long").alias("r"))
    nodes = stored(root, "nodes")
    pending = ends.where("n > 0").select("c", "n", F.lit(0).cast("long").alias("low"))
    batch = 0
    while not pending.isEmpty():
        if batch:
            handles = stored(_handles(nodes, paths), "handles")
            out = stored(_leaving(_exits(pending, handles, paths, longest.bit_length() + 1), paths), "leaving")
        else:
            none = F.lit(None).cast("long")
            out = pending.select("c", "n", none.alias("e"), none.alias("r"), F.col("low").alias("cut"))
        # where each leaves and by which turn; those that end on an edge leave by none and make a node there
        at = paths.select("c", F.col("d").alias("cut"), F.col("p").alias("point"))
        by = paths.select("c", (F.col("d") - 1).alias("cut"), F.col("p").alias("by"))
        out = out.join(at, ["c", "cut"], "left").withColumn("point", F.coalesce("point", F.expr(ROOT)))
        out = stored(out.join(by, ["c", "cut"], "left"), "points")
        drawn = F.min(F.struct(F.xxhash64("c", F.lit(batch)).alias("draw"), "c", "n", "cut"))
        new = out.where("by is not null").groupBy("by").agg(drawn.alias("w")).select("w.c", "w.n", "w.cut")
        leaves = new.join(paths.select("c", F.col("d").alias("n"), "p"), ["c", "n"]).select("p", F.col("n").alias("e"), F.col("cut").alias("up"), F.col("c").alias("r"))
        # the nodes on an edge that is left in its middle: each has the one before it above
        split = out.where("r is not null and cut < e").groupBy("point").agg(F.min(F.struct("cut", "e", "r")).alias("s")).select("point", "s.*")
        edges = nodes.select("p", "e", "up", "r")
        cuts = split.join(edges.select(F.col("r"), F.col("e"), F.col("p").alias("edge"), "up"), ["r", "e"])
        parts = cuts.select("edge", F.col("point").alias("p"), F.col("cut").alias("e"), "up", "r").union(
            edges.select(F.col("p").alias("edge"), "p", "e", "up", "r")
        )
        above = F.lag("e").over(Window.partitionBy("edge").orderBy("e"))
        parts = parts.withColumn("up", F.coalesce(above, F.col("up"))).select("p", "e", "up", "r")
        nodes = stored(parts.union(leaves), "nodes")
        rest = out.where("by is not null").join(new.select("c"), "c", "left_anti")
        pending = stored(rest.select("c", "n", F.col("cut").alias("low")), "pending")
        batch += 1
    return nodes


def _sums(tree: DataFrame, sums: dict[str, str], name: str) -> DataFrame:
    """Each node's aggregates over its subtree, by pointer doubling: after k rounds over what lies less than 2**k below."""
    now = stored(tree.select("p", F.col("above").alias("to"), *sums), name)
    while True:
        lower = now.where("to is not null")
        if lower.isEmpty():
            return now.drop("to")
        rise = lower.groupBy("to").agg(*(F.expr(f"{how}({c})").alias(f"_{c}") for c, how in sums.items())).withColumnRenamed("to", "p")
        hop = lower.select(F.col("p").alias("to"), F.col("to").alias("next"))
        # nodes whose way has reached the root stay out of the join, which would gather their nulls
        moved = lower.join(hop, "to", "left").withColumn("to", F.col("next")).select(now.columns).union(now.where("to is null"))
        both = {c: F.coalesce(F.col(c) + F.col(f"_{c}"), F.col(c)) if how == "sum" else F.least(c, f"_{c}") for c, how in sums.items()}
        now = stored(moved.join(rise, "p", "left").select("p", "to", *(v.alias(c) for c, v in both.items())), name)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each node, which come sorted; only the hash so far is held."""
    key, state = None, None
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("ends_sha256", pa.string())])
    for batch in batches:
        out = []
        for x, y, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
            if key == (x, y):
                state.update(b"," + ids.encode())
            else:
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = (x, y), hashlib.sha256(ids.encode())
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema)
    if key:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*key, state.hexdigest()), strict=True))], schema)


def member_hashes(members: DataFrame) -> DataFrame:
    """(p, ends_sha256) of (c, p): the SHA-256 of the ascending ids of each p, joined by commas."""
    pieces = members.groupBy("p", F.shiftright("c", 10).alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_set("c")), lambda c: c.cast("string")), ",").alias("ids")
    )
    rows = pieces.select("p.x", "p.y", "piece", "ids").repartition("x", "y").sortWithinPartitions("x", "y", "piece")
    done = rows.mapInArrow(_streamed, "x long, y long, ends_sha256 string")
    return done.select(F.struct("x", "y").alias("p"), "ends_sha256")


def prefix_trie(rows: DataFrame, members: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the conversations; see the query's contract for the columns.

    ``rows`` are (c, d, part, t1, t2, words), turn d of conversation c; ``members`` are all conversations (c), those without turns too.
    """
    paths = stored(prefixes(rows), "paths")
    last = paths.groupBy("c").agg(F.max_by(F.struct("d", "p"), "d").alias("l")).select("c", "l.*")
    ended = members.join(last, "c", "left").select(
        "c", F.coalesce("d", F.lit(0)).alias("n"), F.coalesce("p", F.expr(ROOT)).alias("p")
    )
    ended = stored(ended, "members")
    if ended.isEmpty():
        return rows.sparkSession.createDataFrame([], SCHEMA)
    ends = stored(ended.groupBy("p", "n").agg(F.min("c").alias("c"), F.count("*").alias("members")), "ends")
    nodes = compacted(paths, ends)
    words = paths.select(F.col("c").alias("r"), F.col("d").alias("up"), F.col("p").alias("above"), F.col("words").alias("above_words"))
    tree = nodes.join(words, ["r", "up"], "left").withColumn("above", F.when(F.col("e") > 0, F.coalesce("above", F.expr(ROOT))))
    tree = tree.withColumn("above_words", F.coalesce("above_words", F.lit(0)))
    tree = tree.join(paths.select(F.col("c").alias("r"), F.col("d").alias("e"), F.col("words").alias("e_words")), ["r", "e"], "left")
    below = tree.where("above is not null").groupBy("above").agg(F.count("*").alias("n_children")).withColumnRenamed("above", "p")
    mine = ends.select("p", F.col("c").alias("least"), F.col("members").alias("n_convs"))
    tree = tree.join(below, "p", "left").join(mine, "p", "left").select(
        "p", "e", "up", "r", "above", "above_words", F.coalesce("e_words", F.lit(0)).alias("e_words"), F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "least", F.coalesce("n_convs", F.lit(0)).alias("n_convs"), F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
    )
    tree = stored(tree, "tree")
    counted = _sums(tree, {"n_convs": "sum", "least": "min", "n_leaves": "sum"}, "counted")
    tree = tree.drop("n_convs", "least", "n_leaves").join(counted, "p")
    tree = stored(tree.withColumn("saved", (F.col("n_convs") - 1) * (F.col("e_words") - F.col("above_words"))), "saving")
    saved = _sums(tree, {"saved": "sum"}, "saved")
    top = tree.select(F.col("p").alias("above"), F.col("least").alias("parent"))
    tree = tree.drop("saved").join(saved, "p").join(top, "above", "left").join(member_hashes(ended.select("c", "p")), "p", "left")
    tree = stored(tree.drop("above"), "whole")
    # one row for each depth on the edge of a node, with the words of its path down to the turn before
    steps = F.explode(F.expr(f"case when e = 0 then array(0L) else sequence(0L, (e - up - 1) div {EXPAND}) end"))
    depth = F.explode(F.expr(f"case when e = 0 then array(0L) else sequence(up + 1 + s * {EXPAND}, least(e, up + (s + 1) * {EXPAND})) end"))
    rows = tree.withColumn("s", steps).withColumn("depth", depth).drop("s")
    above = paths.select(F.col("c").alias("r"), (F.col("d") + 1).alias("depth"), F.col("words").alias("so_far"))
    rows = rows.join(above, ["r", "depth"], "left")
    at = F.col("depth") == F.col("e")
    return rows.select(
        F.col("least").alias("conv_id"), "depth",
        F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") == F.col("up") + 1, F.col("parent")).otherwise(F.col("least")).alias("parent_conv_id"),
        "n_convs", F.when(at, F.col("n_children")).otherwise(1).cast("long").alias("n_children"), "n_leaves",
        (F.col("saved") - (F.col("n_convs") - 1) * (F.coalesce("so_far", F.lit(0)) - F.col("above_words"))).alias("saved_tokens"),
        F.when(at, F.coalesce("ends_sha256", F.lit(EMPTY))).otherwise(F.lit(EMPTY)).alias("ends_sha256"),
    )


EMPTY = hashlib.sha256(b"").hexdigest()
SCHEMA = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def oracle() -> str:
    """DuckDB SQL for the query: prefixes as lists of turns, grouped outright."""
    bits = "list_reduce(range(0, 8), lambda r, i: xor(r >> 1, (r & 1) * 3988292384), xor(s, ord(substr(t, p, 1))))"
    crc = f"xor(list_reduce(range(1, length(t) + 1), lambda s, p: {bits}, 4294967295), 4294967295)"
    return rf"""
with said as (select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
 row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
 from conversations where conv_id is not null),
own as (select c, {crc} % 4 as h, c - c % 20 as b from (select distinct c, cast(c as varchar) as t from said)),
part as (select o.c, s.pos as i, s.role, s.text from own o join said s on s.c = o.b and s.pos <= o.h
 union all select o.c, 1000 + s.pos, s.role, s.text from own o join said s on s.c = o.c and s.pos > o.h),
told as (select c, row_number() over (partition by c order by i) as d, role, text from part),
whole as (select o.c, coalesce(w, []) as w from own o left join (select c, list(struct_pack(r := role, t := text) order by d) as w from told group by c) using (c)),
runs as (select c, len(w) as n, d, w[1 : d] as p from whole, lateral (select unnest(range(0, len(w) + 1)) as d)),
node as (select p, any_value(d) as d, min(c) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (n = d), '')) as ends_sha256 from runs group by p),
child as (select p[1 : d - 1] as p, count(*) as n_children from node where d > 0 group by 1),
tree as (select node.*, coalesce(n_children, 0) as n_children,
 case when d > 0 then (n_convs - 1) * len(list_filter(regexp_split_to_array(p[d].t, '[\x20\x09-\x0D]+'), lambda x: x <> '')) else 0 end as cost
 from node left join child using (p)),
up as (select p, n_children, cost, unnest(range(0, d + 1)) as k from tree),
sums as (select p[1 : k] as p, sum((n_children = 0)::int) as n_leaves, sum(cost) as saved_tokens from up group by 1)
select t.conv_id, t.d as depth, a.conv_id as parent_conv_id, t.n_convs, t.n_children, cast(n_leaves as bigint) as n_leaves,
 cast(saved_tokens as bigint) as saved_tokens, t.ends_sha256
from tree t join sums s on s.p = t.p left join tree a on t.d > 0 and a.p = t.p[1 : t.d - 1]"""
