"""Comparing the sets of a group with each other, in blocks of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labormart.llm.common import materialize

#: Sets that are compared with each other in one task: two blocks of at most so many sets and about so many shingles.
BLOCK, BLOCK_SHINGLES = 256, 400_000
#: What names a pair of blocks.
PAIR = ("hub", "b0", "i", "b1", "j")


def dealt(named: DataFrame, lowest: int, wide: int = 1) -> DataFrame:
    """Members of groups dealt to pairs of blocks: ``named`` (hub, cls, n, root), a written table of group, class, set
    size and component, becomes (``PAIR``, side, cls, root).

    A group is cut by set size, so that only neighbouring sizes can reach ``lowest`` hundredths of similarity and
    others never meet, and each size into blocks by the classes' hashes; a block bounds rows and shingles. A class
    is copied to the blocks it meets: a group of b blocks costs b copies of each member, never its pairs. Blocks
    ``wide`` times as large need as many times fewer copies.
    """
    named = named.withColumn("bucket", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / lowest))).cast("int"))
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / (wide * BLOCK), F.sum("n") / (wide * BLOCK_SHINGLES))).cast("int")
    stats = materialize(named.groupBy("hub", "bucket").agg(blocks.alias("blocks")), "blocks-buckets")
    # A bucket spans the sizes that one size may link with, so a block meets those of its own and of the next one above.
    meets = stats.alias("s").join(stats.alias("u"), F.expr("s.hub = u.hub and u.bucket between s.bucket and s.bucket + 1"))
    meets = meets.select(F.col("s.hub").alias("hub"), F.col("s.bucket").alias("b0"), F.col("u.bucket").alias("b1"),
                         F.explode(F.expr("sequence(0, s.blocks - 1)")).alias("i"), F.col("u.blocks").alias("m")).withColumn("j", F.explode(F.expr("sequence(0, m - 1)"))).drop("m")
    meets = materialize(meets.where("b0 < b1 or i <= j"), "blocks-meets")
    own = named.join(stats.withColumnRenamed("hub", "k").withColumnRenamed("bucket", "bk").hint("merge"), F.expr("hub = k and bucket = bk"))
    own = own.select("hub", "bucket", F.expr("pmod(xxhash64(cls), blocks)").cast("int").alias("block"), "cls", "root")
    out = None
    for side, b, block in ((0, "b0", "i"), (1, "b1", "j")):
        at = meets.where("not (b0 = b1 and i = j)") if side else meets
        here = at.select(*PAIR, F.col(b).alias("bucket"), F.col(block).alias("block"))
        here = own.join(here, ["hub", "bucket", "block"]).select(*PAIR, F.lit(side).alias("side"), "cls", "root")
        out = here if out is None else out.unionByName(here)
    return out
