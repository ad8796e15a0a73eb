"""Operator 13: conversation prefix trie, built as a burst trie.

1. Turns get their places from ranges sorted by conversation and turn, so that a long
   conversation is never one task. A turn is known by the digest of its role and text;
   texts are not shuffled.
2. A rebuilt conversation is cut into segments of SEGMENT turns. The segments that follow
   the same turns are the suffixes of one container, whose key is the digest of those
   turns; equal suffixes are one row with counts.
3. A container with more than CONTAINER suffixes bursts: each suffix loses its first turn
   and moves to the container of that turn, and the old one remains as a node. Rounds go on
   while any container is too large.
4. Every other container is sorted and swept once: a suffix closes the open nodes that it
   doesn't share with the one before it. Burst nodes get the sums of the containers below them.
5. Segments are swept from the last to the first, as a node that ends a full segment
   takes over the sums of the container that follows it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, small

SHARED, GROUP = 9, 5  # a conversation begins with up to SHARED - 1 turns of the first of its GROUP
SEGMENT, CONTAINER = 1_000, 2_000
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
COLUMNS = [c.split()[0] for c in NODE.split(", ")]


def _digest(*cols: Column) -> Column:
    return F.unhex(F.md5(F.concat(*cols)))


def turns_in_place(talks: DataFrame) -> DataFrame:
    """(conv_id, place, turn_id, bytes) with places from 0 in the order of turn (null first),
    equal turns in the order of their digests. The digest is that of role and text, with
    the role's length before them."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = talks.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        _digest(F.length(role).cast("string"), F.lit(":"), role, text).alias("turn_id"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    n = int(talks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "turn_id"]
    dealt = keep(rows.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "turns")
    inside = dealt.withColumn("i", F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order[1:])) - 1)
    # A conversation in several ranges: how many of its turns lie in earlier ones.
    counts = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    earlier = counts.withColumn("earlier", earlier).where("earlier is not null").select("conv_id", "part", "earlier")
    placed = inside.join(small(earlier), ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.col("i") + F.coalesce("earlier", F.lit(0))).alias("place"), "turn_id", "bytes")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, place, turn_id, bytes) of the rebuilt conversations, and a row with a null
    place for every conversation, which stands for the root. With h = crc32 of
    the decimal conv_id, modulo 9: the first h turns of conversation conv_id - conv_id % 5, then its
    own turns after its first h."""
    convs = turns.select("conv_id").distinct()
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    heads = turns.where((F.col("conv_id") % GROUP == 0) & (F.col("place") < SHARED - 1)).select(F.col("conv_id").alias("base"), "place", "turn_id", "bytes")
    lengths = heads.groupBy("base").agg(F.count("*").alias("has"))
    convs = keep(convs.join(lengths, "base", "left").withColumn("taken", F.least("h", F.coalesce("has", F.lit(0)))), "conversations")
    first = convs.where("taken > 0").join(heads, "base").where("place < taken").select("conv_id", "place", "turn_id", "bytes")
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("place >= h")
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "turn_id", "bytes")
    nothing = convs.select("conv_id", F.lit(None).cast("long"), F.lit(None).cast("binary"), F.lit(None).cast("long"))
    return first.union(own).union(nothing)


def _ends(last: DataFrame) -> DataFrame:
    """(end, ends_sha256): the SHA-256 of the ascending decimal ids of the conversations that
    end at each node. Ids become texts of many in ranges of ids first, so an end that many share
    is a few rows, and a task streams through them."""
    n = int(last.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = last.repartitionByRange(n, "conv_id").withColumn("part", F.spark_partition_id()).sortWithinPartitions("end", "conv_id")

    def join_ids(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end, ids, first, part = None, [], 0, 0
        out: list[tuple] = []

        def made() -> pd.DataFrame:
            got = pd.DataFrame(out, columns=["end", "part", "first", "ids"])
            out.clear()
            return got.astype({"part": "int64", "first": "int64"})

        for pdf in frames:
            for e, c, p in zip(pdf["end"], pdf["conv_id"].tolist(), pdf["part"].tolist()):
                if e != end or len(ids) >= 50_000:
                    if ids:
                        out.append((end, part, first, ",".join(ids)))
                    end, ids, first, part = e, [], c, p
                ids.append(str(c))
            if out:
                yield made()
        if ids:
            out.append((end, part, first, ",".join(ids)))
        yield made()

    runs = ranged.mapInPandas(join_ids, "end binary, part int, first long, ids string")
    runs = runs.repartition(n, "end").sortWithinPartitions("end", "first")

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end, held = None, None
        for pdf in frames:
            out = []
            for e, ids in zip(pdf["end"], pdf["ids"]):
                if e != end:
                    if held:
                        out.append((end, held.hexdigest()))
                    end, held = e, hashlib.sha256()
                else:
                    held.update(b",")
                held.update(ids.encode())
            yield pd.DataFrame(out, columns=["end", "ends_sha256"])
        yield pd.DataFrame([(end, held.hexdigest())] if held else [], columns=["end", "ends_sha256"])

    return runs.mapInPandas(digest, "end binary, ends_sha256 string")


def _sweep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The nodes below the tops of sorted containers, and a row for each top, with `top` (the
    container), sums of what is below it and no parent.

    A row is a suffix: container, depth (of its top), top_conv (a member of the top that has no
    suffix here, or null), ids, sizes (bytes of each turn), conv_id (the smallest
    member), n (members), ends_sha256, and of what follows a full segment next_children,
    next_leaves and next_saved. Closed nodes wait for their parent's smallest member, so as
    many are held as the open nodes have children: no more than suffixes."""
    path: list[dict] = []  # the open nodes, the container's top first
    out: list[tuple] = []
    container, depth = None, 0

    def enter(turn: bytes | None, size: int, conv: int) -> None:
        path.append({"turn": turn, "size": size, "conv": conv, "n": 0, "ends": NO_ENDS, "children": 0, "leaves": 0, "saved": 0, "closed": []})

    def leave() -> None:
        node, parent = path.pop(), path[-1]
        node["saved"] += (node["n"] - 1) * node["size"]
        node["leaves"] = node["leaves"] if node["children"] else 1
        out.extend((*x[:2], node["conv"], *x[2:], None) for x in node["closed"])
        parent["conv"] = min(parent["conv"], node["conv"])
        for what, more in (("n", node["n"]), ("children", 1), ("leaves", node["leaves"]), ("saved", node["saved"])):
            parent[what] += more
        parent["closed"].append((node["conv"], depth + len(path), node["n"], node["children"], node["leaves"], node["saved"], node["ends"]))

    def finish() -> None:
        while len(path) > 1:
            leave()
        if path:
            top = path.pop()
            out.extend((*x[:2], top["conv"], *x[2:], None) for x in top["closed"])
            out.append((top["conv"], depth, None, top["n"], top["children"], top["leaves"], top["saved"], top["ends"], container))

    def made() -> pd.DataFrame:
        found = pd.DataFrame(out, columns=[*COLUMNS, "top"])
        out.clear()
        return found.astype({c: "Int64" for c in COLUMNS[:-1]})

    for pdf in frames:
        for row in pdf.itertuples(index=False):
            if row.container != container:
                finish()
                container, depth = row.container, int(row.depth)
                enter(None, 0, int(row.conv_id) if pd.isna(row.top_conv) else min(int(row.top_conv), int(row.conv_id)))
            same = 0
            while same < len(row.ids) and same + 1 < len(path) and path[same + 1]["turn"] == row.ids[same]:
                same += 1
            while len(path) > same + 1:
                leave()
            for i in range(same, len(row.ids)):
                enter(row.ids[i], int(row.sizes[i]), int(row.conv_id))
            node = path[-1]
            node["conv"], node["ends"] = min(node["conv"], int(row.conv_id)), row.ends_sha256
            for what, more in (("n", row.n), ("children", row.next_children), ("leaves", row.next_leaves), ("saved", row.next_saved)):
                node[what] += int(more)
            if len(out) >= 20_000:
                yield made()
    finish()
    yield made()


def _burst(rows: DataFrame) -> tuple[DataFrame, list[tuple[DataFrame, DataFrame]]]:
    """Containers of at most CONTAINER suffixes and, for each round, (ended, born):
    the suffixes that ended at a burst container's top, and the containers made of it, by
    their first turns: container, parent, depth, bytes (of that turn)."""
    rounds = []
    while True:
        large = keep(rows.groupBy("container").agg(F.count("*").alias("rows")).where(F.col("rows") > CONTAINER).select("container"), "large")
        if not large.limit(1).count():
            return rows, rounds
        hot = rows.join(small(large), "container", "left_semi")
        moved = hot.where(F.size("ids") > 0).select(
            F.col("container").alias("parent"),
            _digest("container", F.hex(F.col("ids")[0])).alias("container"),
            (F.col("depth") + 1).alias("depth"),
            F.lit(None).cast("long").alias("top_conv"),
            F.expr("slice(ids, 2, size(ids))").alias("ids"),
            F.expr("slice(sizes, 2, size(sizes))").alias("sizes"),
            F.col("sizes")[0].alias("bytes"),
            *("conv_id", "n", "ends_sha256", "next_children", "next_leaves", "next_saved"),
        )
        moved = keep(moved, "moved")
        born = moved.groupBy("container", "parent", "depth", "bytes").agg(F.count("*").alias("suffixes"))
        ended = hot.where(F.size("ids") == 0)
        # The smallest member of a top that isn't in the container passes for one that ended.
        outside = hot.where("top_conv is not null").groupBy("container", "depth").agg(F.min("top_conv").alias("conv_id"))
        rounds.append((keep(ended.unionByName(outside, allowMissingColumns=True), "ended"), keep(born, "born")))
        rows = keep(rows.join(small(large), "container", "left_anti").unionByName(moved.drop("parent", "bytes")), "suffixes")


def _nodes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes below the tops of the containers of `rows`, the tops)."""
    first = rows.select("container").distinct()
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    calm, rounds = _burst(rows)
    swept = calm.repartition(n, "container").sortWithinPartitions("container", "ids").mapInPandas(_sweep, NODE + ", top binary")
    swept = keep(swept, "swept")
    nodes, tops = [swept.where("top is null").drop("top")], swept.where("top is not null")
    for ended, born in reversed(rounds):
        below = keep(
            born.join(tops.withColumnRenamed("top", "container").drop("depth", "parent_conv_id"), "container").select(
                "parent", "conv_id", "depth", "n_convs", "n_children",
                F.when(F.col("n_children") > 0, F.col("n_leaves")).otherwise(1).alias("n_leaves"),
                (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"), "ends_sha256",
            ),
            "burst",
        )
        none, zero = F.lit(None).cast("string"), lambda c: F.coalesce(c, F.lit(0))
        parts = below.select(F.col("parent").alias("top"), (F.col("depth") - 1).alias("depth"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens", none.alias("ends_sha256"))
        parts = parts.union(ended.select("container", "depth", "conv_id", zero("n"), zero("next_children"), zero("next_leaves"), zero("next_saved"), "ends_sha256"))
        sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
        above = parts.groupBy("top", "depth").agg(F.min("conv_id").alias("conv_id"), *sums, F.coalesce(F.max("ends_sha256"), F.lit(NO_ENDS)).alias("ends_sha256"))
        above = keep(above.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*COLUMNS, "top"), "tops")
        nodes.append(below.join(small(above.select(F.col("top").alias("parent"), F.col("conv_id").alias("parent_conv_id"))), "parent").select(*COLUMNS))
        tops = tops.union(above)
    found = nodes[0]
    for more in nodes[1:]:
        found = found.union(more)
    return found, tops.join(first.withColumnRenamed("container", "top"), "top", "left_semi")


def prefix_nodes(talks: DataFrame) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations of `talks` (conv_id, turn,
    role, text): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256, all over the conversations that `rebuilt` gives.

    Turns are ordered by number, null first; turns with equal numbers by the digests of their
    role and text, repeated rows being turns of their own. Null role or text is empty. Rows
    with a null conv_id are left out, as they belong to no conversation. A conversation
    that keeps no turns ends at the root. saved_tokens counts UTF-8 bytes. Other columns are not
    read. An empty table gives no node, not even a root.

    A conversation of more than SEGMENT turns takes a round of jobs for each segment.
    """
    spark = talks.sparkSession
    rows = rebuilt(turns_in_place(talks))
    turn = F.struct("place", "turn_id", "bytes")
    segments = rows.groupBy("conv_id", F.coalesce(F.floor(F.col("place") / SEGMENT), F.lit(0)).alias("segment")).agg(
        F.array_sort(F.collect_list(F.when(F.col("place").isNotNull(), turn))).alias("turns")
    )
    segments = segments.select("conv_id", "segment", F.col("turns.turn_id").alias("ids"), F.col("turns.bytes").alias("sizes"))
    last = F.col("segment") == F.max("segment").over(Window.partitionBy("conv_id"))
    segments = keep(segments.withColumn("last", last), "segments")
    levels = segments.agg(F.max("segment")).first()[0]
    if levels is None:
        return spark.createDataFrame([], NODE)

    # Suffixes and containers, level by level; only conversations of more segments go on.
    here = segments.where("segment = 0").withColumn("container", F.lit(b""))
    suffixes = []
    for level in range(levels + 1):
        here = keep(here.withColumn("after", _digest("container", F.array_join(F.transform("ids", F.hex), ""), F.lit("."))), "level")
        ends = _ends(here.where("last").select(F.col("after").alias("end"), "conv_id"))
        distinct = here.groupBy("container", "after", "ids", "sizes").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
        distinct = distinct.join(ends.withColumnRenamed("end", "after"), "after", "left").fillna(NO_ENDS, ["ends_sha256"])
        suffixes.append(keep(distinct.withColumn("depth", F.lit(level * SEGMENT).cast("long")), "suffixes"))
        if level < levels:
            onward = here.where("not last").select("conv_id", F.col("after").alias("container"))
            here = segments.where(F.col("segment") == level + 1).join(small(onward), "conv_id")

    nodes: list[DataFrame] = []
    tops = spark.createDataFrame([], NODE + ", top binary")
    for level in reversed(range(levels + 1)):
        following = tops.select(F.col("top").alias("after"), F.col("n_children").alias("next_children"), F.col("n_leaves").alias("next_leaves"), F.col("saved_tokens").alias("next_saved"))
        rows = suffixes[level].join(small(following), "after", "left").fillna(0, ["next_children", "next_leaves", "next_saved"])
        if level:
            rows = rows.join(small(suffixes[level - 1].select(F.col("after").alias("container"), F.col("conv_id").alias("top_conv"))), "container")
        else:
            rows = rows.withColumn("top_conv", F.lit(None).cast("long"))
        below, tops = _nodes(keep(rows.drop("after"), "rows"))
        nodes.append(below)
        if level:
            tops = keep(tops, "level-tops")
    root = tops.withColumn("n_leaves", F.when(F.col("n_children") > 0, F.col("n_leaves")).otherwise(1)).select(*COLUMNS)
    for below in nodes:
        root = root.union(below)
    return root
