"""The trie of conversation prefixes by truncation peeling.

Rounds go from the greatest depth to the root. In a round, the conversations that end at its depth are merged with the
nodes that survive from the round below, equal prefixes are one node with all its totals, and every node, its last turn
stripped, goes on to the next round. Equal conversations are merged before the first round; a conversation that shares
nothing beyond some depth is cut back to that depth at once, its nodes there being its own. A prefix is known by a digest
of its turns: the sums of eight 32-bit hashes of (place, SHA-256 of the turn), so that a conversation can be scanned in
parts however long it is.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfields.operators.scans import HOT_ROWS, OrderedRows, scan_by_key
from docfields.session import materialise

#: Depths whose keys a node carries along; conversations are cut back to multiples of it.
BAND = 8
#: Turns of one conversation that meet one copy of what is joined to it.
SPAN = 100_000
#: Conversations that one row of the lists of ends holds.
LIST = 50_000
LANES = 8
WORDS = r"[^\x20\x09-\x0D]+"
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def numbered_turns(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text",
                   hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``conv, at, turn, words``: every turn's place in its conversation from 1, SHA-256 and number of words.

    Turns are ordered by ``order``, null first; of equal ones the smaller digest comes first. Null role or text counts as
    empty. Rows without a key belong to no conversation. Other columns are not read.
    """
    who, what = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = turns.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv"), F.col(order).alias("order"),
        F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, what).cast("binary"), 256)).alias("turn"),
        F.regexp_count(what, F.lit(WORDS)).cast("long").alias("words"))
    return scan_by_key(rows, ["conv"], ["order", "turn"], lambda r: r.number("at").df, hot_rows).select("conv", "at", "turn", "words")


def _spanned(convs: DataFrame) -> DataFrame:
    """A row for each ``SPAN`` turns of ``convs`` (``length``), so that no turn's join gathers a whole conversation."""
    return convs.withColumn("span", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("length") / SPAN))))


def _span(at: str) -> Column:
    return F.floor(F.col(at) / SPAN)


def plain(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are: ``conv, length`` of each, and the rows of ``turns`` with ``depth`` and ``length``."""
    convs = turns.groupBy("conv").agg(F.max("at").alias("length"))
    joined = turns.withColumn("span", _span("at")).join(_spanned(convs), ["conv", "span"])
    return convs, joined.select("conv", F.col("at").alias("depth"), "length", "turn", "words")


def rebuilt(turns: DataFrame, base: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """The same of conversations that begin with the first ``head`` (bounded) turns of another, all of them if it has
    fewer, and go on with what is theirs after the first ``head``.

    ``base`` and ``head`` are made of ``conv``. A conversation without a turn is left with length 0.
    """
    own = turns.groupBy("conv").agg(F.max("at").alias("n"))
    own = own.select("conv", "n", head.cast("long").alias("head"), base.alias("base"))
    others = own.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = own.join(others, "base", "left").withColumn("taken", F.least("head", F.coalesce("base_n", F.lit(0)))).withColumn(
        "length", F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0)))
    convs = materialise(convs.select("conv", "n", "head", "base", "taken", "length"), "conversations")
    spans = convs.select("conv", "head", "taken", "n", F.col("length").alias("whole"), F.col("n").alias("length"))
    kept = turns.withColumn("span", _span("at")).join(_spanned(spans), ["conv", "span"]).where("at > head").select(
        "conv", (F.col("taken") + F.col("at") - F.col("head")).alias("depth"), F.col("whole").alias("length"), "turn", "words")
    most = convs.agg(F.max("taken")).first()[0] or 0
    heads = turns.where(F.col("at") <= most).select(F.col("conv").alias("base"), "at", "turn", "words")
    lent = convs.where("taken > 0").select("conv", "base", "length", F.explode(F.sequence(F.lit(1).cast("long"), F.col("taken"))).alias("at"))
    lent = lent.join(heads, ["base", "at"]).select("conv", F.col("at").alias("depth"), "length", "turn", "words")
    return convs.select("conv", "length"), kept.unionByName(lent)


def prefixes(rows: DataFrame, hot_rows: int | None = HOT_ROWS, band: int = BAND) -> DataFrame:
    """``rows`` (conv, depth, length, turn, words) with ``key`` of the prefix, ``told`` (its words) and ``anchor``, the
    key of the prefix at the last multiple of ``band`` before ``depth`` (null: the root)."""
    hashes = [F.xxhash64(F.lit(i), "depth", "turn") for i in range(LANES // 2)]
    lanes = {}
    for i, h in enumerate(hashes):
        lanes[f"_l{2 * i}"], lanes[f"_l{2 * i + 1}"] = F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF))

    def body(scan: OrderedRows) -> DataFrame:
        for name, value in lanes.items():
            scan = scan.running(name, value, "sum")
        scan = scan.running("told", F.col("words"), "sum")
        scan = scan.derive("key", F.unhex(F.sha2(F.concat_ws(",", F.col("depth").cast("string"), *[F.col(x).cast("string") for x in lanes]).cast("binary"), 256)))
        at = F.when(F.col("depth") % band == 0, F.struct("depth", "key"))
        scan = scan.lag("_before", at).running("_anchor", F.col("_before"), "max")
        return scan.df.select("conv", "depth", "length", "words", "told", "key", F.col("_anchor.depth").alias("anchor_depth"), F.col("_anchor.key").alias("anchor"))

    return materialise(scan_by_key(rows.select("conv", "depth", "length", "turn", "words"), ["conv"], ["depth"], body, hot_rows), "prefixes")


def _ends(finals: DataFrame) -> DataFrame:
    """``key, conv, n, ends``: of equal conversations (same ``key``; null: no turn) the smallest, their number, and the
    SHA-256 of all their numbers in order. Lists are made in parts of bounded length by ranges, then digested as a stream."""

    def listed(batches):
        key, convs, out = None, [], []
        for batch in batches:
            for k, c in zip(batch.column("key").to_pylist(), batch.column("conv").to_pylist(), strict=True):
                if convs and (k != key or len(convs) == LIST):
                    out.append((key, convs[0], len(convs), ",".join(map(str, convs))))
                    convs = []
                    if len(out) == 1_000:
                        yield _table(out, ("key", "conv", "n", "list"))
                        out = []
                key = k
                convs.append(c)
        if convs:
            out.append((key, convs[0], len(convs), ",".join(map(str, convs))))
        if out:
            yield _table(out, ("key", "conv", "n", "list"))

    def digested(batches):
        held, out = None, []
        for batch in batches:
            for k, c, n, text in zip(*[batch.column(x).to_pylist() for x in ("key", "conv", "n", "list")], strict=True):
                if held is not None and held[0] == k:
                    held[2] += n
                    held[3].update(b"," + text.encode())
                    continue
                if held is not None:
                    out.append((*held[:3], held[3].hexdigest()))
                    if len(out) == 10_000:
                        yield _table(out, ("key", "conv", "n", "ends"))
                        out = []
                held = [k, c, n, hashlib.sha256(text.encode())]
        if held is not None:
            out.append((*held[:3], held[3].hexdigest()))
        if out:
            yield _table(out, ("key", "conv", "n", "ends"))

    parts = int(finals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = finals.repartitionByRange(parts, "key", "conv").sortWithinPartitions("key", "conv").mapInArrow(
        listed, "key binary, conv long, n long, list string")
    return lists.repartition(parts, "key").sortWithinPartitions("key", "conv").mapInArrow(
        digested, "key binary, conv long, n long, ends string")


def _table(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    kinds = {"key": pa.binary(), "conv": pa.int64(), "n": pa.int64(), "list": pa.string(), "ends": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[x]) for x, c in zip(names, zip(*rows, strict=True), strict=True)], names=list(names))


def peel(convs: DataFrame, prefix: DataFrame, band: int = BAND) -> DataFrame:
    """One row for each node of the trie: the columns ``NODE``.

    ``convs`` and ``prefix`` are those of ``plain`` or ``rebuilt``, and ``prefixes`` with the same ``band``. A node is
    named by its smallest conversation and its depth. Without a conversation there are no nodes.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    finals = prefix.where("depth = length").select("key", "conv").unionByName(
        convs.where("length = 0").select(F.lit(None).cast("binary").alias("key"), "conv"))
    merged = convs.join(_ends(finals).select("conv", "n", "ends"), "conv")
    merged = materialise(merged, "merged")
    # One path stands for equal conversations.
    own = prefix.drop("length").withColumn("span", _span("depth")).join(_spanned(merged), ["conv", "span"]).drop("span")
    own = materialise(own, "paths")
    # Beyond the first anchor that no other path has, a path's nodes are its own.
    anchors = own.where("anchor IS NOT NULL").groupBy("anchor").agg(
        F.min("conv").alias("conv"), F.max("conv").alias("other"), F.min("anchor_depth").alias("anchor_depth")).where("conv = other")
    cuts = anchors.groupBy("conv").agg(F.min("anchor_depth").alias("cut"))
    last = own.where("depth = length").select("conv", F.col("told").alias("all"))
    ends = merged.join(cuts, "conv", "left").join(last, "conv", "left").withColumn("cut", F.least("cut", "length"))
    ends = materialise(ends, "cut-paths")
    placed = own.select("conv", "depth", "words", "told", "key", "anchor", _span("depth").alias("span")).join(_spanned(ends), ["conv", "span"])
    tails = placed.where("depth > cut").select(
        "conv", "depth", F.when(F.col("depth") == F.col("cut") + 1, F.col("anchor")).alias("parent"), F.col("n").alias("n_convs"),
        (F.col("depth") < F.col("length")).cast("long").alias("n_children"), one.alias("n_leaves"),
        ((F.col("n") - 1) * (F.col("all") - F.col("told") + F.col("words"))).alias("saved_tokens"),
        F.when(F.col("depth") == F.col("length"), F.col("ends")).alias("ends"))
    # What is peeled: a row has the keys and words of a band of depths, and the key before them.
    path = F.transform(F.array_sort(F.collect_list(F.struct("depth", "key", "words"))), lambda s: F.struct(s["key"].alias("key"), s["words"].alias("words")))
    number = F.floor((F.col("depth") - 1) / band)
    bands = placed.where("depth <= cut").groupBy("conv", number.alias("band")).agg(path.alias("path"), F.max("anchor").alias("anchor"))
    bands = materialise(bands, "bands")
    cut_off = F.col("cut") < F.col("length")
    ends = ends.select(
        "conv", F.col("cut").alias("depth"), "n", cut_off.cast("long").alias("children"), cut_off.cast("long").alias("leaves"), zero.alias("saved"),
        F.when(~cut_off, F.col("ends")).alias("ends"))
    carried = tails.where("parent IS NOT NULL").select("conv", F.col("saved_tokens").alias("saved_below"))
    ends = materialise(ends.join(carried, "conv", "left").withColumn("saved", F.coalesce("saved_below", "saved")).drop("saved_below"), "ends")

    totals = [F.min("conv").alias("conv"), F.sum("n").alias("n"), F.sum("children").alias("children"),
              F.greatest(F.sum("leaves"), one).alias("leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends")]
    nodes, alive = tails, None
    for depth in range(ends.agg(F.max("depth")).first()[0] or 0, 0, -1):
        here = bands.where(F.col("band") == (depth - 1) // band).select("conv", "path", "anchor")
        level = ends.where(F.col("depth") == depth).drop("depth").join(here, "conv")
        if alive is not None:
            level = level.unionByName(alive if depth % band else alive.drop("path", "anchor").join(here, "conv"))
        top = F.element_at("path", -1)
        level = level.groupBy(top["key"].alias("key")).agg(*totals, F.first("path").alias("path"), F.first("anchor").alias("anchor"))
        above = F.when(F.size("path") > 1, F.try_element_at("path", F.lit(-2))["key"]).otherwise(F.col("anchor"))
        level = level.withColumn("saved", F.col("saved") + (F.col("n") - 1) * top["words"]).withColumn("parent", above)
        level = materialise(level, "level")
        nodes = nodes.unionByName(level.select(
            "conv", F.lit(depth).cast("long").alias("depth"), "parent", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends", "key"), allowMissingColumns=True)
        alive = level.select("conv", "n", one.alias("children"), "leaves", "saved", F.lit(None).cast("string").alias("ends"),
                             F.slice("path", 1, F.size("path") - 1).alias("path"), "anchor")
    root = ends.where("depth = 0").drop("depth")
    root = root if alive is None else root.unionByName(alive.drop("path", "anchor"))
    root = root.agg(*totals).where("conv IS NOT NULL")
    if alive is None:
        nodes = nodes.withColumn("key", F.lit(None).cast("binary"))
    smallest = convs.agg(F.min("conv")).first()[0]
    named = nodes.where("key IS NOT NULL").select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv_id"))
    first = F.lit(smallest).cast("long")
    out = nodes.where("depth > 1 AND parent IS NOT NULL").join(named, "parent").unionByName(
        nodes.where("depth = 1").withColumn("parent_conv_id", first)).unionByName(
        nodes.where("depth > 1 AND parent IS NULL").withColumn("parent_conv_id", F.col("conv"))).unionByName(
        root.select("conv", zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                    F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends"),
        allowMissingColumns=True)
    return out.withColumn("conv_id", F.col("conv")).withColumn("ends_sha256", F.coalesce("ends", F.lit(EMPTY))).select(*NODE)
