"""Documents dealt to shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into cells. A cell belongs to the shard of the next virtual node clockwise; a cell that its shard has
no room for goes on clockwise to the next shard that has. Copies of one text share a shard: a heavy cell is split by a
second hash of the text, and a heavy text stands alone. Only a text whose copies together exceed the room of a shard is
spread by row. Only cells, heavy texts and their loads (a bounded number) are walked on the driver; documents are dealt,
counted and numbered by joins on the cell.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docfields.llm.tree_merge import PLACE, placed
from docfields.session import materialise

#: Cells of the ring; a cell with over ``HEAVY`` of a shard's mean load is split into sub-cells of about that, and a text
#: with as much has sub-cells of its own.
CELLS, HEAVY = 16_384, 1 / 256
VIRTUAL_NODES = 128
#: A shard's load may exceed the mean by this share.
SLACK = 0.0001


def nodes(shards: int, virtual: int = VIRTUAL_NODES) -> tuple[np.ndarray, np.ndarray]:
    """Places of all virtual nodes on the ring (64 bits, ascending) and their shards. A new shard adds places only."""
    made = sorted((int.from_bytes(hashlib.sha256(f"{s}:{v}".encode()).digest()[:8], "big"), s)
                  for s in range(shards) for v in range(virtual))
    return np.array([p for p, _ in made], dtype=np.uint64), np.array([s for _, s in made])


def walk(loads: list[tuple[int, int, int]], cells: int, shards: int, slack: float = SLACK,
         virtual: int = VIRTUAL_NODES) -> dict[tuple[int, int], int]:
    """A shard for each ``(cell, sub)`` of ``loads`` (cell, sub, load), none over the bound by more than one sub-cell.

    The bound is ``(1 + slack)`` of the mean. Cells are placed in the order of a hash, not of their load, so that one
    more document moves little; only heavy ones go first, by powers of two, so that small ones fill what they leave.
    """
    places, owners = nodes(shards, virtual)
    mean = sum(x[2] for x in loads) / shards
    bound = (1 + slack) * mean
    load, out = np.zeros(shards), {}
    width = (1 << 64) // cells

    def turn(cell: int, sub: int) -> int:
        return int.from_bytes(hashlib.sha256(f"{cell}/{sub}".encode()).digest()[:8], "big")

    for cell, sub, size in sorted(loads, key=lambda x: (-int(x[2] / (HEAVY * mean)).bit_length(), turn(x[0], x[1]))):
        at = int(np.searchsorted(places, np.uint64(cell * width + width // 2)))
        for step in range(len(owners)):
            shard = owners[(at + step) % len(owners)]
            if load[shard] + size <= bound:
                break
        else:
            shard = int(np.argmin(load))
        load[shard] += size
        out[cell, sub] = int(shard)
    return out


def size_of(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + F.lit(1)


def deal(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", slack: float = SLACK) -> DataFrame:
    """One row for each of ``docs``: ``key, size, text_crc32, shard, slot, cell, sub``.

    ``size`` is the text's UTF-8 bytes and one (null: none and one). Shards end near equal in size, as far as whole groups
    of equal texts allow; rows of equal texts have one shard unless together they exceed its room. ``slot`` numbers the
    rows of a shard from 0 without gaps, by cell and then by key; rows that are equal in all of that are numbered in the
    order of their files. Null keys come first. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col("_text"), F.lit(""))
    hashed = F.xxhash64(whole)
    rows = placed(docs, {"_key": F.col(key), "_text": F.col(text)}).select(
        "_key", size_of(F.col("_text")).alias("size"), F.crc32(whole.cast("binary")).alias("text_crc32"), hashed.alias("_hash"),
        F.pmod(hashed, F.lit(CELLS)).cast("int").alias("cell"), F.xxhash64("_key", hashed, *PLACE).alias("_row"), *PLACE)
    rows = materialise(rows, "ring-rows")
    loads = rows.groupBy("cell").agg(F.sum("size").alias("load")).collect()  # at most CELLS rows
    mean = sum(r["load"] for r in loads) / shards
    most = HEAVY * mean
    split = [(r["cell"], -int(-r["load"] // most)) for r in loads if r["load"] > most]  # at most shards / HEAVY rows
    heavy = F.broadcast(spark.createDataFrame(split, "cell int, subs int"))
    # Texts that are heavy alone, again at most shards / HEAVY.
    texts = (rows.join(heavy, "cell").groupBy("cell", "subs", "_hash").agg(F.sum("size").alias("load"))
             .where(F.col("load") > most).orderBy("cell", "_hash").collect()) if split else []
    after, own, unit = {}, [], {}
    for r in texts:
        # Its rows are counted and numbered in parts, which have one shard unless no shard has room for all of them.
        first, n = after.get(r["cell"], r["subs"]), -int(-r["load"] // most)
        after[r["cell"]] = first + n
        own.append((r["cell"], r["_hash"], first, n))
        if r["load"] <= (1 + slack) * mean:
            unit |= {(r["cell"], first + k): (r["cell"], first) for k in range(n)}
    own = F.broadcast(spark.createDataFrame(own, "cell int, _hash long, first int, n int"))
    alone = F.col("first") + F.pmod("_row", F.col("n"))
    sub = F.coalesce(alone, F.pmod(F.xxhash64("_hash"), F.col("subs")), F.lit(0)).cast("int")
    dealt = rows.join(heavy, "cell", "left").join(own, ["cell", "_hash"], "left").withColumn("sub", sub)
    # At most CELLS + 4 * shards / HEAVY rows, whatever the documents.
    found = dealt.groupBy("cell", "sub").agg(F.sum("size").alias("load"), F.count(F.lit(1)).alias("n")).collect()
    units = Counter()
    for r in found:
        at = r["cell"], r["sub"]
        units[unit.get(at, at)] += r["load"]
    home = walk([(*at, load) for at, load in units.items()], CELLS, shards, slack)
    used, table = [0] * shards, []
    for r in sorted(found, key=lambda r: (r["cell"], r["sub"])):
        at = r["cell"], r["sub"]
        shard = home[unit.get(at, at)]
        table.append((*at, shard, used[shard]))
        used[shard] += r["n"]
    homes = spark.createDataFrame(table, "cell int, sub int, shard int, base long")
    within = Window.partitionBy("cell", "sub").orderBy(F.col("_key").asc_nulls_first(), *PLACE)
    numbered = dealt.withColumn("_n", F.row_number().over(within))
    return numbered.join(F.broadcast(homes), ["cell", "sub"]).select(
        F.col("_key").alias(key), "size", "text_crc32", "shard", (F.col("base") + F.col("_n") - 1).alias("slot"), "cell", "sub")
