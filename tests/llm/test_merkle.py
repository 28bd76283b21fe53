"""Merkle manifests against a tree of the whole table."""

import hashlib
import zlib
from itertools import groupby

import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from skytally.llm import merkle, queries

SF001 = "/root/testdata/sf0.001"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    written = [None if v is None else str(v) for v in row]
    return digest(*["-" if w is None else f"{len(w.encode())}:{w}" for w in written])


def climb(nodes, fan_out):
    """The top of the nodes, and the runs that every node and its ancestors stand in, as (left, right)."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, at in zip(paths, places, strict=True):
            first = at - at % fan_out
            path.append((nodes[first:at], nodes[at + 1 : first + fan_out]))
        nodes = [digest(*nodes[i : i + fan_out]) for i in range(0, len(nodes), fan_out)]
        places = [at // fan_out for at in places]
    return nodes[0], paths


def fold(node, path):
    for left, right in path:
        node = digest(*left, node, *right)
    return node


def whole_tree(rows, fan_out=2):
    def order(r):
        return (r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, leaf_of(r))

    groups = [list(g) for _, g in groupby(sorted(rows, key=order), key=lambda r: r[2])]
    tops = [climb([leaf_of(r) for r in g], fan_out) for g in groups]
    if not tops:
        return []
    root, above = climb([top for top, _ in tops], fan_out)
    out = []
    for group, (top, paths), upper in zip(groups, tops, above, strict=True):
        for row, own in zip(group, paths, strict=True):
            path = own + upper
            proof = digest(*[d for left, right in path for d in (*left, *right)])
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None
            new = (*row[:3], row[3] + 1, row[4]) if changed else row
            folded = fold(leaf_of(new), path)
            out.append((row[0], leaf_of(row), top, root, proof, folded, folded == root))
    return sorted(map(str, out))


def answered(df, **options):
    seventh = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = merkle.build_manifest(df, replaced={"n_chars": F.col("n_chars") + 1}, where=seventh, **options)
    return sorted(str(tuple(r)) for r in found.collect())


@pytest.fixture(scope="module")
def table(spark):
    def make(rows):
        kinds = "doc_id long, source string, lang string, n_chars long, text string"
        return spark.createDataFrame(rows, kinds).selectExpr("*", "1 as pos", "2 as tree", "3 as digest", "4 as rank")

    return make


def drawn(n, langs):
    return [(i * 37 % n, f"s{i % 3}", langs[i * i % len(langs)], i, f"text {i} é") for i in range(n)]


ODD = [
    (None, None, None, None, None), (1, "", "", 0, ""), (1, "", "", 0, ""), (1, "", "", 0, "other"), (2, None, "é", 3, "x"), (None, "a", "é", None, ""),
    (7, "a", "b", None, "y" * 100_000), (8, "a", "null", 5, "-"), (9, "a", "-", 5, None), (26, "a", "zz", 5, "26"),
]


@pytest.mark.parametrize("rows", [[], ODD[:1], ODD + drawn(100, ["en", "de", None])])
def test_odd_rows(table, rows):
    assert answered(table(rows)) == whole_tree(rows)


@pytest.mark.parametrize(("fan_out", "levels"), [(2, 1), (3, 2), (5, 1)])
def test_rounds_of_small_blocks(table, fan_out, levels):
    rows = drawn(60, ["en", "en", "de", None, "fr", "es", "it"])
    assert answered(table(rows), fan_out=fan_out, levels=levels) == whole_tree(rows, fan_out)


def test_many_groups(table):
    rows = [(i, "s", f"l{i // 2}", i, "t") for i in range(300)]
    assert answered(table(rows)) == whole_tree(rows)


def test_resumed_states():
    nodes = [digest(str(i)).encode() for i in range(11)]
    for fan_out in (2, 3, 4):
        tree = merkle.Tree(nodes, fan_out, 0)
        top, paths = climb([n.decode() for n in nodes], fan_out)
        assert tree.levels[-1] == [top.encode()]
        for at, path in enumerate(paths):
            assert tree.fold(at, b"other") == fold("other", path).encode()
            assert tree.siblings(at) == [("".join(x).encode(), "".join(y).encode()) for x, y in path]


def test_registered_query(spark):
    rows = [tuple(r[f] for f in FIELDS) for r in ds.dataset(f"{SF001}/documents.parquet").to_table().to_pylist()]
    assert sorted(str(tuple(r)) for r in queries.op12_merkle(spark, SF001).collect()) == whole_tree(rows)
