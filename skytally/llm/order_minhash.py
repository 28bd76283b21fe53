"""Near duplicates by order MinHash, verified by banded alignment.

Words are lower-cased and freed from marks at their edges. A text's shingles of two words carry the number of their
occurrence, so all of them differ. Each of 64 sketches takes the three shingles with the least hashes and keeps the order
in which they stand in the text, so texts share a sketch the more likely the fewer words were inserted, dropped,
replaced or moved. Texts that share a sketch meet in a bucket. Where a fifth of the words is replaced at random, a pair has
about 0.1 to share a given sketch, and 0.08 where it is every fifth word.

Pairs of at most ``SHORT`` words are found without chance. If ``k`` edits are allowed for the longer text and it is cut into
``k + 1`` parts, one part stands unchanged in the other text, at most so far from its place as the edits allow. Each text
enters the buckets of its own words at all these places, for every length that a longer partner may have.

Pairs are verified by the alignment of their word sequences: near means that single-word edits make up at most a fifth of
the longer text (edit similarity of 0.8 or more). Classes are the connected components of near pairs.

No bucket is expanded into all its pairs. Members are first compared with the lead that they meet most often, then with the
least and the greatest node of their buckets, across classes only. Buckets whose members all have one class are done. In the
others, the members outside the largest class are looked at against all members of other classes, block by block: their lengths
and word counts bound their distance, and pairs that may still be near are aligned, each once. So every link between texts that share a bucket counts. There is no cap
on buckets, partners or candidates.

Equal texts are one node and never compared. A null text is empty. Texts without words are near to their copies only. Rows
that repeat an id are rows of their own; a null id is larger than no other, so it names a class only where all ids are
null. Extra columns are ignored. What is reused is written to the shared folder, and deleted there once nothing needs it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.components import merge_labels
from skytally.llm.shared import bucketed, drop_bucketed, drop_stored, in_slices, sorted_runs, stored, task_count

SHINGLE = 2
SKETCHES = 64
TAKEN = 3

# Pairs whose longer text has at most so many words are found by equal parts instead of sketches.
SHORT = 20

# Classes of the word counts that bound distances, coarse and fine, and members of a block of a large bucket.
COUNTED = 128
FINE = 4096
BLOCK = 1000
BLOCK_CHARS = 1 << 24

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_WORDS: dict[str, int] = {}
_REMEMBERED = 500_000
_EMPTY = np.zeros(0, np.uint64)


def word_hashes(text: str) -> np.ndarray:
    """One 64-bit hash per word: lower case, without marks at its edges. What is only marks is no word."""
    raw = text.split()
    if len(_WORDS) > _REMEMBERED:
        _WORDS.clear()
    for w in set(raw).difference(_WORDS):
        bare = w.lower() if w.isalnum() else _EDGES.sub("", w.lower())
        _WORDS[w] = xxhash.xxh64_intdigest(bare) | 1 if bare else 0
    hashes = np.fromiter(map(_WORDS.__getitem__, raw), np.uint64, len(raw))
    return hashes[hashes != 0]


def word_counts(words: np.ndarray) -> bytes:
    """How many words fall into each of ``COUNTED`` classes, 255 at most; bounds the distance of texts from below."""
    return np.minimum(np.bincount((words >> np.uint64(1)).astype(np.int64) % COUNTED, minlength=COUNTED), 255).astype(np.uint8).tobytes()


def word_bits(words: np.ndarray) -> bytes:
    """How many words fall into each of ``FINE`` classes, modulo 4: two bits each. Counts differ by their distance on the circle of
    four at least, which is a finer bound for texts of any length."""
    counts = np.bincount((words >> np.uint64(1)).astype(np.int64) % FINE, minlength=FINE) % 4
    return (counts.reshape(-1, 4) << np.array([0, 2, 4, 6])).sum(axis=1).astype(np.uint8).tobytes()


def _circle_distances() -> np.ndarray:
    """For any two bytes of ``word_bits``, the sum of the distances of their four counts."""
    counts = np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3
    apart = (counts[:, None, :] - counts[None, :, :]) % 4
    return np.minimum(apart, 4 - apart).sum(axis=2).astype(np.uint8)


_APART = _circle_distances()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def labelled_shingles(words: np.ndarray, shingle: int = 5) -> np.ndarray:
    """Hashes of the word shingles in text order, each with the number of its occurrence so far, so all differ. Fewer
    words than a shingle are one shingle."""
    if not len(words):
        return _EMPTY
    n = max(1, len(words) - shingle + 1)
    h = np.zeros(n, np.uint64)
    for j in range(min(shingle, len(words))):
        h = _mix(h + words[j : j + n])
    order = np.argsort(h, kind="stable")
    s = h[order]
    start = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    seen = np.arange(n) - np.repeat(start, np.diff(np.append(start, n)))
    occurrence = np.empty(n, np.uint64)
    occurrence[order] = seen
    return _mix(h + occurrence * np.uint64(0xD6E8FEB86659FD93))


SEEDS = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def sketch(shingles: np.ndarray, sketches: int = SKETCHES, taken: int = TAKEN) -> np.ndarray:
    """One hash per sketch: of its ``taken`` shingles with the least hashes, in text order."""
    n = len(shingles)
    if not n:
        return np.zeros(sketches, np.int64)
    taken = min(taken, n)
    places = np.empty((sketches, taken), np.int64)
    step = max(1, 200_000 // n)
    for at in range(0, sketches, step):
        seeds = SEEDS[at : min(at + step, sketches), None]
        h = (shingles[None, :] ^ seeds) * seeds
        h ^= h >> np.uint64(32)
        rows = np.arange(len(h))
        for i in range(taken):
            places[at + rows, i] = h.argmin(axis=1)
            h[rows, places[at + rows, i]] = np.uint64(2**64 - 1)
    places.sort(axis=1)
    v = SEEDS[:sketches].copy()
    for i in range(taken):
        v = _mix(v + shingles[places[:, i]])
    return v.view(np.int64)


def equal_parts(words: np.ndarray, similarity: float = 0.8, longest: int = SHORT) -> np.ndarray:
    """Hashes of which any two texts of at most ``longest`` words share one if their edit similarity is ``similarity`` or more.

    A partner of ``n`` words, at least as long, is cut into one part more than it has edits. For each of its parts, the
    hashes are of the own words where that part may stand: words before and behind it that one text has more than the other
    are edits too.
    """
    found = set()
    m = len(words)
    for n in range(m, longest + 1) if m else ():
        edits = int((1 - similarity) * n + 1e-9)
        if n - m > edits:
            break
        cuts = [n * i // (edits + 1) for i in range(edits + 2)]
        for part, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
            for moved in range(-edits, edits + 1):
                if abs(moved) + abs(n - m + moved) <= edits and 0 <= start + moved and end + moved <= m:
                    found.add((n, part, words[start + moved : end + moved].tobytes()))
    hashes = [xxhash.xxh64_intdigest(w, seed=1000 * n + part) for n, part, w in sorted(found)]
    return np.array(hashes, np.uint64).view(np.int64)


def bucket_keys(
    words: np.ndarray,
    similarity: float = 0.8,
    *,
    sketches: int = SKETCHES,
    taken: int = TAKEN,
    shingle: int = SHINGLE,
) -> np.ndarray:
    """The buckets of a text: equal parts for partners of at most ``SHORT`` words, sketches for longer ones."""
    parts = equal_parts(words, similarity)
    if len(words) < (SHORT + 1) * similarity - 1e-6:
        return parts
    return np.concatenate([parts, sketch(labelled_shingles(words, shingle), sketches, taken)])


def edit_similarity(left: np.ndarray, right: np.ndarray, least: float) -> float:
    """``1 - distance / longer length`` of two word sequences, or 0.0 where it is under ``least``.

    The distance is that of single-word insertions, deletions and replacements. Bounds that need no alignment come first:
    the lengths, and the words that only one side has. Then the sequences are aligned in the band of diagonals that the
    allowed distance can reach.
    """
    longer = max(len(left), len(right))
    if not longer:
        return 1.0
    allowed = int((1 - least) * longer + 1e-9)
    if abs(len(left) - len(right)) > allowed:
        return 0.0
    kinds, index = np.unique(np.concatenate([left, right]), return_inverse=True)
    counts = np.bincount(index[: len(left)], minlength=len(kinds)) - np.bincount(index[len(left) :], minlength=len(kinds))
    if max(counts[counts > 0].sum(), -counts[counts < 0].sum()) > allowed:
        return 0.0
    a, b = index[: len(left)], index[len(left) :]
    same = min(len(a), len(b))
    differs = np.flatnonzero(a[:same] != b[:same])
    head = int(differs[0]) if len(differs) else same
    a, b = a[head:], b[head:]
    same = min(len(a), len(b))
    differs = np.flatnonzero(a[::-1][:same] != b[::-1][:same])
    tail = int(differs[0]) if len(differs) else same
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    distance = banded_distance(a, b, allowed)
    return 1 - distance / longer if distance <= allowed else 0.0


def banded_distance(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """The edit distance where it is at most ``band``; otherwise ``band + 1``.

    The band goes down the matrix one column after the other. Of a column, the cells differ from those above them by 1, 0 or -1,
    so the whole column is two bit vectors (where it goes up, where it goes down), whole numbers in Python; bit ``t`` of column
    ``j`` is row ``j - band + t``. A column follows from the one before by a dozen operations on these numbers. Only the lowest
    diagonal of the band is counted, and then, once it has reached the last row, that row.
    """
    if len(a) < len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if n - m > band:
        return band + 1
    if not m:
        return n
    band = min(band, n)
    found: dict[int, int] = {}
    for place, word in enumerate(a.tolist()):
        found[word] = found.get(word, 0) | 1 << place
    width = 2 * band + 1
    every, top = (1 << width) - 1, 1 << (width - 1)
    up, down, distance = every ^ ((1 << band) - 1), 0, band
    # The last row is reached in column n - band; no column behind it can take more than a step per column off.
    bound = band + m - (n - band)
    steps = b.tolist()
    for j in range(n - band):
        places = found.get(steps[j], 0)
        equal = (places >> (j - band) if j >= band else places << (band - j)) & every
        same = ((((equal & up) + up) ^ up) | equal | down) & every
        right_up = down | (every ^ (same | up))
        right_down = same & up
        if not same & top:
            distance += 1
            if distance > bound:
                return band + 1
        same >>= 1
        up, down = right_down | (every ^ (same | right_up)), same & right_up
    last = top >> 1
    for j in range(n - band, m):
        places = found.get(steps[j], 0)
        equal = (places >> (j - band) if j >= band else places << (band - j)) & every
        same = ((((equal & up) + up) ^ up) | equal | down) & every
        right_up = down | (every ^ (same | up))
        right_down = same & up
        distance += bool(right_up & last) - bool(right_down & last)
        last >>= 1
        same >>= 1
        up, down = right_down | (every ^ (same | right_up)), same & right_up
    return min(distance, band + 1)


def _verify(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (``a``, ``b``) whose texts are similar enough.

    Nodes are dealt into blocks of about ``BLOCK`` nodes and of bounded length, and pairs meet in a group per two blocks. A text
    is sent once to every group that has a pair of it, not once per pair, and aligned there as word hashes.
    """
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    total = ends.join(texts, "node").agg(F.count("*").alias("nodes"), F.sum("chars").alias("chars")).first()
    blocks = max(1, -(-total.nodes // BLOCK), -(-(total.chars or 0) // BLOCK_CHARS))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
    keys = ["low", "high"]
    placed = pairs.select(
        F.least(place("a"), place("b")).alias("low"), F.greatest(place("a"), place("b")).alias("high"), "a", "b"
    )
    wanted = placed.select(*keys, F.col("a").alias("node")).unionByName(placed.select(*keys, F.col("b").alias("node")))
    sent = wanted.distinct().join(texts.select("node", "text"), "node")
    both = sent.select(*keys, "node", "text", F.lit(None).cast("long").alias("b")).unionByName(
        placed.select(*keys, F.col("a").alias("node"), F.lit(None).cast("string").alias("text"), "b")
    )
    # Texts come before the pairs of their group.
    dealt = both.repartition(task_count(pairs.sparkSession), *keys).sortWithinPartitions(*keys, F.asc_nulls_first("b"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, words = None, {}
        for batch in in_slices(batches, 256):
            near = []
            for low, high, node, text, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (low, high) != group:
                    group, words = (low, high), {}
                if other is None:
                    words[node] = word_hashes(text)
                elif edit_similarity(words[node], words[other], similarity) >= similarity:
                    near.append((node, other))
            found = np.array(near, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    return stored(dealt.mapInArrow(align, "a long, b long"), "near-pairs")


def _bounded(pairs: DataFrame, similarity: float) -> DataFrame:
    """Without the pairs whose lengths (``n`` and ``m`` words) already keep them apart."""
    return pairs.filter(F.least("n", "m") >= F.greatest("n", "m") * similarity - 1e-6)


def _signed(texts: DataFrame) -> DataFrame:
    """Nodes with what bounds their distances."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 256):
            words = [word_hashes(t) for t in batch.column("text").to_pylist()]
            signs = [pa.array([make(w) for w in words], pa.binary()) for make in (word_counts, word_bits)]
            columns = [batch.column("node"), batch.column("buckets"), *signs]
            yield pa.RecordBatch.from_arrays(columns, ["node", "buckets", "word_counts", "word_bits"])

    schema = "node long, buckets array<long>, word_counts binary, word_bits binary"
    return texts.select("node", "buckets", "text").mapInArrow(sign, schema)


def _possible_pairs(entries: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs of different classes in one bucket that lengths and word counts leave possible.

    The members of a bucket outside its largest class are its stragglers. Only they are looked at against all members: a bucket
    is cut into blocks of about ``BLOCK`` members and its stragglers into blocks of the same size, and every two blocks meet in a
    group of their own. So members of a large class stay in one place where few stragglers visit them, and no group grows with
    its bucket. Inside a group the bounds of all pairs are taken as arrays; a pair leaves it only if it may still be near.
    ``entries``: ``v``, ``node``, ``label``, ``n_words``.
    """
    sizes = entries.groupBy("v", "label").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("v").agg(
        F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("n"),
        F.count("*").alias("classes"),
    )
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    mixed = mixed.filter("classes > 1").select(
        "v", "main", blocks(F.col("n")).alias("blocks"), blocks(F.col("n") - F.col("most")).alias("visits")
    )
    members = stored(entries.join(mixed, "v"), "bucket-members")
    strays = (F.col("label") != F.col("main")).alias("strays")
    place = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    visit = F.pmod(F.xxhash64("node", F.lit(1)), F.col("visits")).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    at_home = members.select("v", place.alias("block"), upto("visits").alias("visit"), F.lit(False).alias("visits"), strays, "node", "label", "n_words")
    visitors = members.filter("label != main").select(
        "v", upto("blocks").alias("block"), visit.alias("visit"), F.lit(True).alias("visits"), F.lit(True).alias("strays"), "node", "label", "n_words",
    )
    # The buckets of a node that are looked into: two nodes that share several are compared in the least of them only.
    mine = members.groupBy("node").agg(F.collect_set("v").alias("buckets"))
    signed = _signed(texts.join(mine, "node"))
    dealt = at_home.unionByName(visitors).join(stored(signed, "signed-nodes"), "node")
    keys = ["v", "block", "visit"]
    grouped = dealt.repartition(task_count(entries.sparkSession), *keys).sortWithinPartitions(*keys)

    def compare(table: pa.Table) -> list[tuple[int, int]]:
        node, label, n, visits, strays = (table.column(c).to_numpy() for c in ("node", "label", "n_words", "visits", "strays"))
        coarse, fine = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), np.uint8).reshape(len(node), -1) for c in ("word_counts", "word_bits")
        )
        coarse, here = coarse.astype(np.int16), table.column("v")[0].as_py()
        buckets = [frozenset(b) for b in table.column("buckets").to_pylist()]
        home, out = np.flatnonzero(~visits), []
        for i in np.flatnonzero(visits):
            # Two stragglers meet in the blocks of both; one of the times counts.
            other = home[(label[home] != label[i]) & (~strays[home] | (node[home] > node[i]))]
            longer = np.maximum(n[i], n[other])
            other = other[np.minimum(n[i], n[other]) >= longer * similarity - 1e-6]
            for bound in (lambda o, i=i: np.abs(coarse[o] - coarse[i]), lambda o, i=i: _APART[fine[i][None, :], fine[o]]):
                if len(other):
                    # An edit changes two counts by one at most; so does the difference of lengths.
                    least = (bound(other).sum(axis=1, dtype=np.int64) + np.abs(n[other] - n[i])) / 2
                    other = other[least <= (1 - similarity) * np.maximum(n[i], n[other]) + 1e-6]
            out += [(min(node[i], node[j]), max(node[i], node[j])) for j in other.tolist() if min(buckets[i] & buckets[j]) == here]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_runs(batches, keys):
            pairs = np.array(compare(group), np.int64).reshape(-1, 2)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return grouped.mapInArrow(run, "a long, b long")


def _apart(pairs: DataFrame, labels: DataFrame, tested: DataFrame) -> DataFrame:
    """The pairs of different classes that were not tested yet."""
    out = pairs.join(labels.select(F.col("node").alias("a"), F.col("label").alias("x")), "a").join(
        labels.select(F.col("node").alias("b"), F.col("label").alias("y")), "b"
    )
    return out.filter("x != y").select("a", "b").join(tested, ["a", "b"], "left_anti")


def find_near_duplicates(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = 0.8,
    sketches: int = SKETCHES,
    taken: int = TAKEN,
    shingle: int = SHINGLE,
) -> DataFrame:
    """One row per row of ``df``: ``id``, ``text_key`` (SHA-256 of the text), ``class_id`` (the least id of the class),
    ``class_size`` (rows), ``class_texts`` (different texts), ``leads`` (whether the row's text is the class's first one,
    that of the least id)."""

    def sketch_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 256):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            words = [word_hashes(t) for t in texts]
            found = [bucket_keys(w, similarity, sketches=sketches, taken=taken, shingle=shingle) for w in words]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary()),
                    pa.array([len(w) for w in words], pa.int32()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                ["id", "text_key", "n_words", "sketches"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketched = stored(
        rows.mapInArrow(sketch_all, f"id {kind}, text_key binary, n_words int, sketches array<bigint>"), "sketched"
    )
    # One node per different text: copies meet by their digest, one row per task and text before the shuffle.
    nodes = stored(
        sketched.groupBy("text_key")
        .agg(F.min("id").alias("first_id"), F.count("*").alias("copies"), F.max("n_words").alias("n_words"),
             F.max("sketches").alias("sketches"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes"
    )

    # Buckets with more than one node, with the least and the greatest.
    entries = nodes.filter("n_words > 0").select("node", "n_words", F.explode("sketches").alias("v"))
    shared = entries.groupBy("v").agg(F.count("*").alias("members"), F.min("node").alias("lo"), F.max("node").alias("hi"))
    shared = stored(shared.filter("members > 1").drop("members"), "buckets")
    entries = stored(entries.join(shared.select("v"), "v"), "bucket-entries")
    members = stored(entries.select("node", "n_words").distinct(), "members")
    wanted = nodes.join(members.select("node"), "node", "left_semi").select("node", "text_key", "first_id")
    keyed = rows.select("id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.unhex(F.sha2("text", 256)))
    # Of several rows with the text, only those with its least id are fetched, and one of these is kept.
    # What is wanted grows with the documents, so it is not broadcast, however small it is.
    # Texts are joined by node several times from here on: they are dealt by it once.
    texts = (
        keyed.join(wanted.hint("merge"), "text_key")
        .filter(F.col("id").eqNullSafe(F.col("first_id")))
        .groupBy("node")
        .agg(F.min("text").alias("text"))
        .withColumn("chars", F.length("text"))
    )
    texts, texts_name = bucketed(texts, "texts", "node")
    labels = stored(members.select("node", F.col("node").alias("label")), "labels")

    # Every member of a bucket with its least and greatest node, and in how many buckets they meet.
    leads = F.explode(F.array("lo", "hi")).alias("lead")
    stars = entries.join(shared, "v").select("node", "n_words", leads).filter("node != lead").groupBy("node", "lead", F.col("n_words").alias("n"))
    stars = stars.agg(F.count("*").alias("times")).join(
        members.select(F.col("node").alias("lead"), F.col("n_words").alias("m")), "lead"
    )
    stars = _bounded(stars, similarity).select("node", "times", F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b"))
    stars = stored(stars, "stars")
    # First the lead that a node meets in most buckets: one pair per node ties most classes together.
    often = stars.groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("times", F.negative("a"))).alias("pair"))
    tested = stored(often.select("pair.a", "pair.b").distinct(), "first-pairs")
    labels = merge_labels(labels, _verify(tested, texts, similarity))
    pairs = stored(_apart(stars.select("a", "b").distinct(), labels, tested), "further-pairs")
    drop_stored(stars)
    labels = merge_labels(labels, _verify(pairs, texts, similarity))
    tested = tested.unionByName(pairs)

    # What is left: pairs of different classes in one bucket.
    labelled = entries.join(labels, "node")
    rest = _possible_pairs(labelled, texts, similarity).distinct().join(tested, ["a", "b"], "left_anti")
    labels = merge_labels(labels, _verify(stored(rest, "last-pairs"), texts, similarity))
    drop_stored(entries)
    drop_bucketed(texts, texts_name)

    classed = stored(
        nodes.join(labels, "node", "left").select(
            "text_key", "node", "first_id", "copies", F.coalesce("label", "node").alias("label")
        ),
        "classed",
    )
    classes = classed.groupBy("label").agg(
        F.min("first_id").alias("class_id"),
        F.sum("copies").alias("class_size"),
        F.count("*").alias("class_texts"),
        F.min_by("node", F.struct("first_id", "text_key")).alias("lead"),
    )
    placed = stored(classed.join(classes, "label"), "placed")
    drop_stored(classed, nodes)
    out = sketched.select("id", "text_key").join(placed, "text_key")
    return out.select(
        "id", F.lower(F.hex("text_key")).alias("text_key"), "class_id", "class_size", "class_texts",
        (F.col("node") == F.col("lead")).alias("leads"),
    )
