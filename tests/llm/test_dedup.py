"""Exact and near duplicates, and fingerprints, against brute force."""

import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from skytally.llm import block_naming, fingerprint, order_minhash
from skytally.llm.components import merge_labels
from skytally.llm.shared import bucketed, drop_bucketed

SF001 = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


@pytest.fixture(scope="module")
def table():
    rows = ds.dataset(f"{SF001}/documents.parquet").to_table(columns=["doc_id", "text"]).to_pylist()
    return [(r["doc_id"], r["text"]) for r in rows]


def exact_groups(pairs):
    groups = defaultdict(list)
    for doc_id, text in pairs:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text in pairs:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, sha(text)))
    return sorted(map(str, out))


def few_hashes(block):
    return F.pmod(F.xxhash64(block), F.lit(3)).cast("long")


@pytest.mark.parametrize("options", [{}, {"block_bytes": 7}, {"block_bytes": 64, "hash_of": few_hashes}])
def test_block_names(docs, odd, table, options):
    for pairs in (odd, [*table, (5000, "ab" * 700), (5001, "ab" * 701), (5002, "ab" * 700)]):
        rows = block_naming.find_exact_duplicates(docs(pairs, decoys=True), **options).collect()
        assert sorted(str(tuple(r)) for r in rows) == exact_groups(pairs)


def test_block_names_of_prefixes_and_shared_blocks(docs):
    texts = ["aa", "aab", "aabb", "aabbaa", "bbaa", "aabb", "aa" * 4, "aa" * 3]
    pairs = list(enumerate(texts))
    rows = block_naming.find_exact_duplicates(docs(pairs), block_bytes=2).collect()
    assert sorted(str(tuple(r)) for r in rows) == exact_groups(pairs)


def test_one_row_of_repeated_ones(docs, odd):
    assert block_naming.find_exact_duplicates(docs([])).collect() == []
    rows = block_naming.find_exact_duplicates(docs(odd), one_row=True).collect()
    kept = Counter(r.text_sha256 for r in rows if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({t or "" for _, t in odd})


def words_of(text):
    return order_minhash.word_hashes(text)


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words) + 1)
        rng.choice([lambda: words.insert(at, rng.randrange(12)), lambda: words[at : at + 1].clear() or words.__delitem__(slice(at, at + 1)),
                    lambda: words.__setitem__(slice(at, at + 1), [rng.randrange(12)])])()
    return words


def test_banded_distance_equals_the_full_one():
    rng = random.Random(0)
    for _ in range(1500):
        a = [rng.randrange(12) for _ in range(rng.randint(0, 40))]
        b = edited(a, rng.randint(0, 10), rng)
        longer = max(len(a), len(b))
        full = 1 - slow_distance(a, b) / longer if longer else 1.0
        for least in (0.8, 0.5):
            got = order_minhash.edit_similarity(np.array(a, np.uint64), np.array(b, np.uint64), least)
            assert got == pytest.approx(full if full >= least - 1e-9 else 0.0)


def test_labelled_shingles_differ():
    words = words_of("to be or not to be or not to be or not")
    shingles = order_minhash.labelled_shingles(words)
    assert len(set(shingles.tolist())) == len(words) - 4
    assert len(order_minhash.labelled_shingles(words[:2])) == 1 and len(order_minhash.labelled_shingles(words[:0])) == 0


def test_sketches_follow_order():
    a = order_minhash.labelled_shingles(words_of(" ".join(f"w{i}" for i in range(200))))
    same = (order_minhash.sketch(a) == order_minhash.sketch(a[::-1])).mean()
    assert same == 0 and (order_minhash.sketch(a) == order_minhash.sketch(a.copy())).all()


def brute_classes(pairs, least=0.8):
    texts = sorted({t or "" for _, t in pairs})
    words = [words_of(t) for t in texts]
    lead = list(range(len(texts)))

    def find(i):
        while lead[i] != i:
            i = lead[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if len(words[i]) and len(words[j]) and find(i) != find(j):
                if order_minhash.edit_similarity(words[i], words[j], least) >= least:
                    lead[find(i)] = find(j)
    place = {t: find(i) for i, t in enumerate(texts)}
    ids = defaultdict(list)
    for doc_id, text in pairs:
        ids[place[text or ""]].append(doc_id)
    least_id = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    return sorted(str((doc_id, least_id[place[t or ""]], len(ids[place[t or ""]]))) for doc_id, t in pairs)


def near_classes(df, **options):
    rows = order_minhash.find_near_duplicates(df, **options).collect()
    assert sum(r.leads for r in rows) >= len({r.class_id for r in rows})
    return sorted(str((r.id, r.class_id, r.class_size)) for r in rows)


def test_near_classes_equal_brute_force(docs, table):
    rng = random.Random(1)
    pairs = list(table)
    for k, (_, text) in enumerate(table[:25]):
        words = text.split()
        for c in range(3):
            copy = list(words)
            for _ in range(max(1, len(words) // 40)):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(1000)}"
            pairs.append((1000 + 3 * k + c, " ".join(copy)))
    assert near_classes(docs(pairs, decoys=True)) == brute_classes(pairs)


def test_near_classes_of_odd_rows(docs, odd):
    assert near_classes(docs(odd)) == brute_classes(odd)
    assert order_minhash.find_near_duplicates(docs([])).collect() == []


def share_a_bucket(a, b):
    return bool(set(order_minhash.bucket_keys(a).tolist()) & set(order_minhash.bucket_keys(b).tolist()))


def test_short_near_texts_are_all_found():
    rng = random.Random(5)
    near = Counter()
    for _ in range(6000):
        a = [rng.randrange(12) for _ in range(rng.randint(1, order_minhash.SHORT))]
        b = edited(a, rng.randint(1, 4), rng)
        if 0 < len(b) <= order_minhash.SHORT and slow_distance(a, b) <= max(len(a), len(b)) / 5 + 1e-9:
            near[max(len(a), len(b))] += 1
            assert share_a_bucket(np.array(a, np.uint64), np.array(b, np.uint64)), (a, b)
    assert min(near[n] for n in range(5, order_minhash.SHORT + 1)) > 20


@pytest.mark.parametrize("kind", ["every fifth", "a fifth", "mixed"])
def test_recall_near_the_threshold(kind):
    """Pairs with an edit similarity of 0.8 to 0.9, by length; the figures are in the README."""
    rng = random.Random(7)
    for low, high in ((order_minhash.SHORT + 1, 40), (41, 150), (151, 600)):
        met = total = 0
        while total < 250:
            n = rng.randint(low, high)
            a = [rng.getrandbits(60) for _ in range(n)]
            b = list(a)
            if kind == "every fifth":
                b[4::5] = [rng.getrandbits(60) for _ in b[4::5]]
            elif kind == "a fifth":
                for i in rng.sample(range(n), n // 5):
                    b[i] = rng.getrandbits(60)
            else:
                b = edited(a, rng.randint(n // 10, n // 5), rng)
            a, b = np.array(a, np.uint64), np.array(b, np.uint64)
            if 0.8 <= order_minhash.edit_similarity(a, b, 0.8) <= 0.9:
                total += 1
                met += share_a_bucket(a, b)
        print(f"recall, {kind}, {low} to {high} words: {met} of {total}")
        assert met >= 0.97 * total


def test_short_and_thinly_edited_texts_are_classes(docs):
    """Ten words with the fifth replaced, nine likewise, five against the same and one more; every fifth word replaced."""
    pairs = []
    for k, n in enumerate((10, 9, 5, 100)):
        a = [f"t{k}w{i}" for i in range(n)]
        b = [*a[:4], "other", *a[5:]] if n in (9, 10) else [*a, "other"] if n == 5 else [f"new{i}" if i % 5 == 4 else w for i, w in enumerate(a)]
        pairs += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
    want = sorted(str((i, i - i % 2, 2)) for i in range(8))
    assert brute_classes(pairs) == want == near_classes(docs(pairs))


def test_a_chain_in_one_bucket_is_one_class(docs):
    """Neighbours are near, ends are not: links between members that no lead is near to must count."""
    base = [f"w{i}" for i in range(100)]
    pairs = []
    for step in range(12):
        words = list(base)
        for i in range(6 * step):
            words[99 - i] = f"x{i}"
        pairs.append((step, " ".join(words)))
    assert near_classes(docs(pairs)) == brute_classes(pairs) == sorted(str((i, 0, 12)) for i in range(12))


def test_bucketed_tables_are_joined_without_a_shuffle(spark):
    table, name = bucketed(spark.range(100).withColumnRenamed("id", "node"), "numbers", "node")
    other = spark.range(50).select((F.col("id") * 2).alias("node")).hint("merge")
    joined = table.join(other, "node")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and joined.count() == 50
    files = table.inputFiles()
    drop_bucketed(table, name)
    assert files and not spark.catalog.tableExists(name)
    assert not any(Path(urlparse(f).path).exists() for f in files)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)]
    labels = spark.range(500).selectExpr("id as node", "id as label")
    half = spark.createDataFrame(edges[::2], "a long, b long")
    rest = spark.createDataFrame(edges[1::2], "a long, b long")
    got = {r.node: r.label for r in merge_labels(merge_labels(labels, half), rest).collect()}
    want = list(range(500))
    for _ in range(500):
        before = list(want)
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
        if want == before:
            break
    assert got == dict(enumerate(want))


def shingle_set(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_fingerprints(docs, table):
    pairs = [(i, t) for i, t in table if i % 2 == 0] + [(9001, None), (9002, ""), (9003, "one two"), (9004, "ok")]
    rows = {r.id: r for r in fingerprint.fingerprint_edited(docs(pairs, decoys=True)).collect()}
    order = sorted(pairs, reverse=True)
    errors = []
    for (doc_id, text), (next_id, after) in zip(order, [*order[1:], order[0]], strict=True):
        r, text, after = rows[doc_id], text or "", after or ""
        m = len(text) // 3
        new = text[: len(text) - m] + after[:m]
        assert (r.n_chars, r.edited_sha256, r.next_id) == (len(text), sha(new), next_id)
        assert len(r.fingerprint) == fingerprint.BINS
        for near, other in ((r.near_edited, new), (r.near_next, after)):
            a, b = shingle_set(text), shingle_set(other)
            errors.append(abs(near - len(a & b) / len(a | b)))
            assert 0 <= near <= 1 and (text != other or near == 1.0)
    assert np.mean(errors) < 0.03 and max(errors) < 0.2
    by_text = defaultdict(set)
    for doc_id, text in pairs:
        by_text[text or ""].add(rows[doc_id].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert len({rows[i].fingerprint for i, _ in pairs}) == len(by_text)


def test_densification_equals_its_definition(spark):
    """The bits of a text with few shingles, by the probe sequence in plain Python."""
    df = spark.createDataFrame([("a b c d e f g h",), ("a b",)], "text string")
    for row in fingerprint.with_fingerprint(df, "text", "bits").collect():
        words = row.text.split()
        quoted = [f"xxhash64({', '.join(f'xxhash64(\"{w}\")' for w in words[i : i + 5])})" for i in range(len(words) - 4)]
        hashes = [spark.sql(f"select {q}").first()[0] for q in quoted or [f"xxhash64('{' '.join(words)}')"]]
        low = {}
        for h in sorted(hashes):
            low.setdefault((h >> 56) + 128, h)
        want = []
        for j in range(256):
            probes = [j, *((fingerprint.STARTS[j] + t * fingerprint.STEPS[j]) % 256 for t in range(256))]
            want.append(next(low[p] for p in probes if p in low))
        stored = spark.sql("select " + ", ".join(f"xxhash64({v}L, {j}) & 15" for j, v in enumerate(want))).first()
        assert list(row.bits) == list(stored)


def test_fingerprints_of_odd_rows(docs, odd):
    assert fingerprint.fingerprint_edited(docs([])).collect() == []
    rows = fingerprint.fingerprint_edited(docs(odd)).collect()
    assert sorted(str(r.id) for r in rows) == sorted(str(i) for i, _ in odd)
    alone = fingerprint.fingerprint_edited(docs([(1, "a b c d e f")])).collect()[0]
    assert alone.next_id == 1 and alone.near_next == 1.0
