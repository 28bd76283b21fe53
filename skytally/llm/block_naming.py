"""Exact duplicates by deterministic naming of blocks.

Texts are cut into blocks of a fixed number of bytes. Distinct blocks are sorted, and the place of a block is its name, an
integer. Then adjacent names are paired, distinct pairs are sorted and named likewise, and so on, until every document has
one name. Two documents have the same name of the same level exactly when their texts are equal: a name stands for one
block or one pair, and a last name without a partner is paired with nothing, which is unlike any pair.

Blocks travel once. They are grouped by a 64-bit hash, which keeps the least and the greatest block of every hash; tasks
keep one of each before the shuffle, so a block that a third of all documents share costs a row per task. Where least and
greatest are equal, the hash stands for that block alone, and documents fetch its name by the hash. Where they differ, two
blocks share a hash, and these few are grouped and joined by their bytes. So no result rests on a hash being unique.

Every level is checkpointed, because it is read twice. Rows for a hot block or pair are spread by the skew handling of
adaptive execution: both sides of each naming join are plain shuffles.

A null text is empty; an empty text is one empty block. A null id is a document like others. Rows that repeat id and text
are counted as often as they occur. Of equal texts the row with the largest id stays (null is smaller than any id); of
repeated rows with that id, all are marked as staying unless ``one_row`` is set. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.shared import checkpointed

BLOCK_BYTES = 2048


def block_hash(block: Column) -> Column:
    return F.xxhash64(block)


def name_documents(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    hash_of=block_hash,
) -> DataFrame:
    """One row per distinct id and text: ``id``, ``text_sha256``, ``copies`` (rows that repeat both), and the identity
    of its text, ``level`` and ``name``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = F.encode(text, "UTF-8")
    docs = df.select(F.col(id_col).alias("id"), F.sha2(raw, 256).alias("text_sha256"), raw.alias("raw"))
    last = F.greatest(F.lit(0), F.ceil(F.length("raw") / block_bytes).cast("int") - 1)
    starts = F.sequence(F.lit(0), last)
    blocks = docs.select(
        "id",
        "text_sha256",
        F.posexplode(F.transform(starts, lambda i: F.substring("raw", i * block_bytes + 1, F.lit(block_bytes)))).alias(
            "place", "block"
        ),
    ).withColumn("hash", hash_of(F.col("block")))

    # Distinct blocks by hash: the name is the place in the sorted partition, with the partition in its upper bits.
    kinds = blocks.groupBy("hash").agg(F.min("block").alias("least"), F.max("block").alias("greatest"))
    kinds = checkpointed(
        kinds.sortWithinPartitions("least").select(
            "hash", F.monotonically_increasing_id().alias("name"), (F.col("least") != F.col("greatest")).alias("shared")
        )
    )
    placed = blocks.select("id", "text_sha256", "place", "hash").join(
        kinds.filter(~F.col("shared")).select("hash", "name"), "hash"
    )
    if not kinds.filter("shared").isEmpty():
        shared = blocks.join(kinds.filter("shared").select("hash"), "hash", "left_semi")
        apart = checkpointed(
            shared.select("block")
            .distinct()
            .sortWithinPartitions("block")
            .select("block", (-1 - F.monotonically_increasing_id()).alias("name"))
        )
        placed = placed.select("id", "text_sha256", "place", "name").unionByName(
            shared.join(apart, "block").select("id", "text_sha256", "place", "name")
        )
    # Rows that repeat id and text repeat their places too; a place that occurs c times means c such rows.
    copies = F.count(F.when(F.col("place") == 0, 1)).alias("copies")
    level = checkpointed(placed.groupBy("id", "text_sha256").agg(_names_in_order("place", "name"), copies))

    done, depth = [], 0
    while True:
        done.append(level.filter(F.size("names") == 1).select("id", "text_sha256", "copies", F.lit(depth).alias("level"),
                                                              F.col("names")[0].alias("name")))
        longer = level.filter(F.size("names") > 1)
        if longer.isEmpty():
            break
        level, depth = _pair_up(longer), depth + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _names_in_order(place: str, name: str) -> Column:
    ordered = F.array_sort(F.collect_set(F.struct(place, name)))
    return F.transform(ordered, lambda x: x[name]).alias("names")


def _pair_up(level: DataFrame) -> DataFrame:
    """The next level: half as many names per document."""
    halves = F.sequence(F.lit(0), F.floor((F.size("names") - 1) / 2).cast("int"))
    pairs = level.select(
        "id",
        "text_sha256",
        "copies",
        F.posexplode(
            F.transform(
                halves,
                lambda i: F.struct(
                    F.get("names", 2 * i).alias("left"),
                    # A missing partner is a value of its own, so that it joins and sorts like a name.
                    F.struct(
                        F.get("names", 2 * i + 1).isNull().alias("missing"),
                        F.coalesce(F.get("names", 2 * i + 1), F.lit(0).cast("long")).alias("name"),
                    ).alias("right"),
                ),
            )
        ).alias("place", "pair"),
    )
    named = checkpointed(
        pairs.select("pair").distinct().sortWithinPartitions("pair").select("pair", F.monotonically_increasing_id().alias("name"))
    )
    joined = pairs.join(named, "pair")
    return checkpointed(
        joined.groupBy("id", "text_sha256").agg(_names_in_order("place", "name"), F.max("copies").alias("copies"))
    )


def find_exact_duplicates(df: DataFrame, *, one_row: bool = False, **options) -> DataFrame:
    """One row per row of ``df``: ``id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``. With ``one_row`` only
    one of the rows that repeat the staying id and text is kept."""
    named = checkpointed(name_documents(df, **options))
    groups = checkpointed(
        named.groupBy("level", "name").agg(F.max("id").alias("keep_id"), F.sum("copies").alias("group_size"))
    )
    out = named.join(groups, ["level", "name"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    kept = F.col("id").eqNullSafe(F.col("keep_id"))
    if one_row:
        kept = kept & (F.col("copy") == 1)
    return out.select("id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")
