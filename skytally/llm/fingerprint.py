"""Document fingerprints: one-permutation MinHash of word shingles, in Spark's own functions only.

Every shingle of five words is hashed once. The upper bits of the hash choose one of 256 bins, and a bin keeps the least
hash that fell into it. An empty bin borrows from a filled one by optimal densification: bin *j* tries the bins
``(a[j] + t * o[j]) mod 256`` for t = 0, 1, 2, ... and takes the value of the first filled one; ``o[j]`` is odd, so every
bin is tried once and the search ends. Of every bin the four lowest bits are stored, as one hexadecimal digit, so a
fingerprint is 256 digits. They are those of the value hashed with the bin's number: a value that several bins borrowed
then agrees with another one by chance in each of them apart, once in 16 times, which ``likeness`` corrects for.

All hashes of a document are sorted in one array together with one upper bound per bin; the first entry of every bin is
then its minimum, or its bound if the bin is empty. No shingle leaves its row, and nothing is shuffled.

Words are what stands between white space. A text with fewer than five words is one shingle, an empty or null text the
shingle of no words. Equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.shared import checkpointed

BITS = 8
BINS = 1 << BITS
SHINGLE = 5
KEPT = 4  # bits of a value that are stored

# Probes that are tried one by one before the first filled bin is looked up among all filled ones.
PROBES = 6


def _odd(j: int, salt: int) -> int:
    return ((j * 2654435761 + salt) * 2246822519 >> 7) | 1


# Start and step of the probe sequence of every bin, and the inverse of the step.
STARTS = [(_odd(j, 11) >> 3) % BINS for j in range(BINS)]
STEPS = [_odd(j, 29) % BINS for j in range(BINS)]
INVERSES = [pow(step, -1, BINS) for step in STEPS]


def _ints(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def with_fingerprint(df: DataFrame, text_col: str, name: str, *, shingle: int = SHINGLE) -> DataFrame:
    """``df`` with the column ``name``: the stored bits of every bin, as an array of 256 small integers."""
    shift = 64 - BITS
    low = (1 << shift) - 1
    bounds = F.expr(f"transform(sequence(-{BINS // 2}, {BINS // 2 - 1}), j -> shiftleft(cast(j as bigint), {shift}) | {low}L)")
    # Each step is a column of its own: an expression used inside a lambda would be computed again for every element.
    words, hashes, ordered, values, filled = (f"__{name}_{step}" for step in ("words", "hashes", "ordered", "values", "filled"))
    starts, steps, inverses = (f"__{name}_{c}" for c in ("starts", "steps", "inverses"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = df.withColumn(words, F.array_remove(F.split(text, r"\s+"), ""))
    out = out.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    windows = F.transform(
        F.slice(hashes, 1, F.size(hashes) - (shingle - 1)),
        lambda x, i: F.xxhash64(x, *[F.get(hashes, i + j) for j in range(1, shingle)]),
    )
    few = F.array(F.xxhash64(F.array_join(words, " ")))
    shingles = F.when(F.size(hashes) >= shingle, windows).otherwise(few)
    out = out.withColumn(ordered, F.sort_array(F.concat(shingles, bounds)))
    minima = F.filter(
        ordered, lambda x, i: (i == 0) | (F.shiftright(x, shift) != F.shiftright(F.get(ordered, i - 1), shift))
    )
    out = out.withColumn(values, F.transform(minima, lambda x: F.when(x.bitwiseAND(F.lit(low)) != low, x)))
    out = out.withColumn(filled, F.filter(F.transform(values, lambda x, j: F.when(x.isNotNull(), j)), lambda j: j.isNotNull()))
    out = out.withColumns({starts: _ints(STARTS), steps: _ints(STEPS), inverses: _ints(INVERSES)})

    def place(j: Column, t: Column) -> Column:
        return (F.get(starts, j) + t * F.get(steps, j)).bitwiseAND(F.lit(BINS - 1))

    def fill(x: Column, j: Column) -> Column:
        tries = [F.get(values, place(j, F.lit(t))) for t in range(PROBES)]
        # The number of the probe that reaches bin f; its minimum over the filled bins is the first that hits.
        first = F.array_min(
            F.transform(filled, lambda f: ((f - F.get(starts, j)) * F.get(inverses, j)).bitwiseAND(F.lit(BINS - 1)))
        )
        value = F.coalesce(x, *tries, F.get(values, place(j, first)))
        return F.xxhash64(value, j).bitwiseAND(F.lit((1 << KEPT) - 1)).cast("tinyint")

    out = out.withColumn(name, F.transform(values, fill))
    return out.drop(words, hashes, ordered, values, filled, starts, steps, inverses)


def packed(bits: Column) -> Column:
    """The stored bits as text, one hexadecimal digit per bin."""
    return F.lower(F.array_join(F.transform(bits, lambda x: F.hex(x)), ""))


def likeness(left: Column, right: Column) -> Column:
    """Estimated resemblance of the shingle sets, 0 to 1, freed from chance agreement of the stored bits."""
    same = F.size(F.filter(F.zip_with(left, right, lambda x, y: x == y), lambda s: s))
    chance = 1.0 / (1 << KEPT)
    return F.greatest(F.lit(0.0), (same / BINS - chance) / (1 - chance))


def link_next(keys: DataFrame, order: list[Column], key: str) -> DataFrame:
    """Each key with the key that follows it in ``order``, and the first after the last: columns ``key``, ``next_key``.

    Keys are range-partitioned and sorted; a place is the partition and the number in it. The place that follows is the
    next number, or the start of the next partition that has rows, of which there is one per partition at most. Keys
    must be unique and ``order`` total.
    """
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = checkpointed(
        keys.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .select(key, F.monotonically_increasing_id().alias("place"))
    )
    parts = placed.groupBy(F.shiftright("place", 33).alias("part")).agg(F.min("place").alias("first"), F.max("place").alias("end"))
    # One row per partition of the sort, however large the table is.
    over = Window.orderBy("part")
    turns = parts.select(
        F.col("end"),
        F.coalesce(F.lead("first").over(over), F.min("first").over(Window.partitionBy())).alias("after_end"),
    )
    following = placed.join(F.broadcast(turns), F.col("place") == F.col("end"), "left").select(
        key, F.coalesce("after_end", F.col("place") + 1).alias("next_place")
    )
    ahead = placed.select(F.col(key).alias("next_key"), F.col("place").alias("next_place"))
    return following.join(ahead, "next_place").select(key, "next_key")


def fingerprint_edited(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", cut: int = 3) -> DataFrame:
    """Fingerprints of every document and of its text with the last ``1/cut`` replaced by the start of the next document,
    by descending id (null last, then by a hash of the text; after the last comes the first). Rows that repeat id and
    text count as one document for that order and are returned as often as they occur.

    Texts are shuffled once by a digest of id and text, with their fingerprints, and the start of the next text once.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    mark = F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), text)
    docs = df.select(F.col(id_col).alias("id"), text.alias("body"), F.unhex(F.sha2(mark, 256)).alias("key"))
    keys = docs.select("id", "key").distinct()
    links = link_next(keys, [F.col("id").desc_nulls_last(), F.col("key").asc()], "key")
    tail = F.floor(F.length("body") / cut).cast("int")
    sizes = docs.select("key", tail.alias("tail")).distinct()
    links = checkpointed(links.join(sizes, "key").withColumnsRenamed({"key": "own_key", "next_key": "key"}))

    # Both joins read these rows with the same columns by the same key, so Spark shuffles them once.
    printed = with_fingerprint(docs, "body", "bits")
    starts = (
        printed.join(links, "key")
        .select(
            F.col("own_key").alias("key"),
            F.struct(F.col("body").substr(F.lit(1), F.col("tail")).alias("start"), "id", "bits").alias("next"),
        )
        .groupBy("key")
        .agg(F.min("next").alias("next"))
    )
    joined = printed.join(starts, "key").select(
        "id",
        "next",
        "bits",
        F.length("body").alias("n_chars"),
        F.concat(F.col("body").substr(F.lit(1), F.length("body") - tail), F.col("next.start")).alias("edited"),
    )
    joined = with_fingerprint(joined, "edited", "edited_bits")
    return joined.select(
        "id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        packed(F.col("bits")).alias("fingerprint"),
        packed(F.col("edited_bits")).alias("edited_fingerprint"),
        likeness(F.col("bits"), F.col("edited_bits")).alias("near_edited"),
        likeness(F.col("bits"), F.col("next.bits")).alias("near_next"),
        F.col("next.id").alias("next_id"),
    )
