"""Benchmark passages inside training documents, found by winnowing, in Spark's own functions only.

Words are runs of digits, ASCII letters (lower-cased) and characters beyond ASCII. A window is ``window`` consecutive words of
an item; an item of fewer words, but not none, is one window. Every window is marked by the least hash of the grams of
``gram`` words in it. A document's windows are marked by the same rule, so a window that stands in both has the same mark
in both: every shared span of ``window`` words is found, whatever is around it. Neighbouring windows mostly have one mark
in common, and a mark is looked up once where it changes and once per ``window - gram + 1`` places.

Where the mark of an item is met, the hit is extended: all windows around it are compared word by word with the windows of
the items. Items shorter than a window have marks of their own, the hash of all their words, which documents look up at
every place.

Where the marks are few, they are broadcast and the documents are read once. Beyond ``broadcast_rows`` marks, the places are
shuffled to the marks and documents with hits are read again, joined by Spark as sizes suggest. Both ways give the
same rows. Copies of a text share its hits; documents with equal sets of windows share the list of their items.

A null text has no words. A null item id is listed as an empty string. Rows that repeat an item id are one item with several texts.
Documents may repeat ids or have none: every row is answered for itself. Empty tables give no hits, or no rows. Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.shared import stored

WINDOW = 10
GRAM = 5

# A mark takes 8 bytes, a window of ten words some 80: this is the bound of what is broadcast.
BROADCAST_ROWS = 200_000

# What separates words, and the letters that are lower-cased.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _raw_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN_WORDS), "")


def words_of(text: Column) -> Column:
    """The words of a text, as an array."""
    # Letters beyond ASCII keep their case, so only words without them may be lower-cased as a whole.
    plain = lambda w: F.octet_length(w) == F.length(w)
    return F.transform(_raw_words(text), lambda w: F.when(plain(w), F.lower(w)).otherwise(F.translate(w, UPPER, LOWER)))


def _starts(array: Column, size: int) -> Column:
    """The elements at which ``size`` consecutive ones start."""
    return F.slice(array, 1, F.greatest(F.size(array) - (size - 1), F.lit(0)))


def _short_marks(hashes: Column, size: int) -> Column:
    """One hash per ``size`` words, kept apart from those of other sizes."""
    return F.transform(
        _starts(hashes, size), lambda x, i: F.xxhash64(F.lit(size), x, *[F.get(hashes, i + j) for j in range(1, size)])
    )


def _window_marks(hashes: Column, window: int, gram: int) -> Column:
    """The least hash of a gram in every window."""
    grams = F.transform(_starts(hashes, gram), lambda x, i: F.xxhash64(x, *[F.get(hashes, i + j) for j in range(1, gram)]))
    span = window - gram + 1
    return _let(
        grams,
        lambda g: F.transform(_starts(g, span), lambda x, i: F.least(x, F.lit(None), *[F.get(g, i + j) for j in range(1, span)])),
    )


def marks_of(words: Column, window: int, gram: int, sizes: list[int]) -> Column:
    """What a document looks up: the marks of its windows, null where the one before has the same and is near enough, and
    then those of its spans of each of the ``sizes``."""
    span = window - gram + 1

    def rare(marks: Column) -> Column:
        new = lambda x, i: (x != F.get(marks, F.greatest(i - 1, F.lit(0)))) | (i % span == 0)
        return F.transform(marks, lambda x, i: F.when(new(x, i), x))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return _let(
        hashes, lambda h: F.concat(_let(_window_marks(h, window, gram), rare), *[_short_marks(h, size) for size in sizes])
    )


def _place(number: Column, n_words: Column, window: int, sizes: list[int]) -> Column:
    """Size and start of the span that stands at a place of ``marks_of``."""
    start, found = number, None
    for size in [window, *sizes]:
        count = F.greatest(n_words - (size - 1), F.lit(0))
        here = F.struct(F.lit(size).alias("size"), start.cast("int").alias("start"))
        found = F.when(start < count, here) if found is None else F.when(found.isNull() & (start < count), here).otherwise(found)
        start = start - count
    return found


def _around(spans: Column, n_words: Column, window: int, gram: int) -> Column:
    """The spans to compare: of a window, all that its mark stands for until the next one is looked up."""
    last = F.least(spans["start"] + (window - gram), n_words - window)
    near = F.transform(F.sequence(spans["start"], last), lambda s: F.struct(F.lit(window).alias("size"), s.alias("start")))
    return F.when(spans["size"] == window, near).otherwise(F.array(spans))


def find_contamination(
    documents: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per document: its id, ``n_words``, ``n_hit`` (words inside a window of an item), ``n_items`` (items of which a
    window occurs), ``items_sha256`` (of their ids as text, sorted, joined by commas), ``contaminated``, ``items`` (the ids)
    and ``hit_share``."""
    if not 1 <= gram <= window:
        raise ValueError("a gram has at least one word and at most those of a window")
    named = items.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), words_of(F.col(item_text_col)).alias("words")
    )
    n = F.size("words")
    sized = named.filter(n > 0).select("item", "words", F.least(n, F.lit(window)).alias("size"))
    spans = F.transform(
        F.sequence(F.lit(0), F.size("words") - F.col("size")), lambda s: F.array_join(F.slice("words", s + 1, F.col("size")), " ")
    )
    owned = stored(sized.select("item", "size", F.explode(spans).alias("span")).distinct(), "owned-spans")
    # The number of a span is fixed once it is written.
    windows = stored(owned.select("span", "size").distinct().withColumn("window_id", F.monotonically_increasing_id()), "windows")
    sizes = sorted(r["size"] for r in windows.filter(F.col("size") < window).select("size").distinct().collect())

    def mark(size: int) -> Column:
        hashes = F.transform(F.split("span", " "), lambda w: F.xxhash64(w))
        return _let(hashes, lambda h: F.get(_window_marks(h, window, gram) if size == window else _short_marks(h, size), F.lit(0)))

    by_size = F.when(F.col("size") == window, mark(window))
    for size in sizes:
        by_size = by_size.when(F.col("size") == size, mark(size))
    marks = stored(windows.select(by_size.alias("mark")).distinct(), "marks")
    few = windows.limit(broadcast_rows + 1).count() <= broadcast_rows

    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = documents.select(F.col(id_col).alias("id"), text.alias("text"))
    worded = docs.select("text", words_of(F.col("text")).alias("words"))
    looked = worded.select("text", "words", F.size("words").alias("n"), marks_of(F.col("words"), window, gram, sizes).alias("marks"))
    place = _place(F.col("number"), F.col("n"), window, sizes).alias("place")
    digest = F.unhex(F.sha2("text", 256)).alias("key")
    if few:
        places = looked.select("text", "words", "n", F.posexplode("marks").alias("number", "mark")).filter("mark is not null")
        met = places.join(F.broadcast(marks), "mark").select(digest, "words", "n", place)
        near = met.select("key", "words", F.explode(_around(F.col("place"), F.col("n"), window, gram)).alias("at"))
    else:
        narrow = looked.select(F.xxhash64("text").alias("hash"), "n", F.posexplode("marks").alias("number", "mark"))
        met = narrow.filter("mark is not null").join(marks, "mark").select("hash", place)
        met = stored(met.groupBy("hash").agg(F.collect_set("place").alias("places")), "places")
        again = worded.join(met, F.xxhash64(worded["text"]) == met["hash"]).select("text", "words", "places")
        # Two texts of one hash look at each other's places; those that only the longer one has are none of the shorter.
        fitting = F.filter("places", lambda p: p["start"] + p["size"] <= F.size("words"))
        spans = F.array_distinct(F.flatten(F.transform(fitting, lambda p: _around(p, F.size("words"), window, gram))))
        near = again.select(digest, "words", F.explode(spans).alias("at"))
    span = F.array_join(F.slice("words", F.col("at.start") + 1, F.col("at.size")), " ")
    compared = near.select("key", "at", span.alias("span")).join(
        F.broadcast(windows.select("span", "window_id")) if few else windows.select("span", "window_id"), "span"
    )
    texts = compared.groupBy("key").agg(F.collect_set("at").alias("hits"), F.sort_array(F.collect_set("window_id")).alias("windows"))
    hit = F.flatten(F.transform("hits", lambda a: F.sequence(a["start"], a["start"] + a["size"] - 1)))
    texts = texts.select(
        "key", F.size(F.array_distinct(hit)).cast("long").alias("n_hit"), "windows", F.xxhash64("windows").alias("windows_hash")
    )
    texts = stored(texts, "text-hits")

    kinds = texts.select("windows_hash", "windows").distinct()
    owners = windows.select("span", "window_id").join(owned.select("span", "item"), "span").select("window_id", "item")
    listed = (
        kinds.select("windows_hash", "windows", F.explode("windows").alias("window_id"))
        .join(owners, "window_id")
        .groupBy("windows_hash", "windows")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    found = texts.join(listed, ["windows_hash", "windows"]).select("key", "n_hit", "items")
    counted = docs.select("id", F.size(_raw_words(F.col("text"))).cast("long").alias("n_words"), digest)
    none = F.array().cast("array<string>")
    out = counted.join(found, "key", "left").select(
        "id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items")
    )
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "items",
        F.when(F.col("n_words") > 0, F.col("n_hit") / F.col("n_words")).otherwise(0.0).alias("hit_share"),
    )
