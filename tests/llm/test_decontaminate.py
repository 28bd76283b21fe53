"""Benchmark passages in documents against a search of all windows."""

import hashlib
import re

import duckdb
import pyarrow.dataset as ds
import pytest

from skytally.llm import decontaminate, queries

SF001 = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def search_all(docs, items, window=10):
    owners = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for s in range(len(words) - size + 1) if words else ():
            owners.setdefault(tuple(words[s : s + size]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for size in {len(k) for k in owners}:
            for s in range(len(words) - size + 1):
                span = tuple(words[s : s + size])
                if span in owners:
                    hit.update(range(s, s + size))
                    found |= owners[span]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(map(str, out))


def answered(found):
    return sorted(str(tuple(r)[:6]) for r in found.collect())


@pytest.fixture(scope="module")
def tables():
    def read(name, key):
        return [(r[key], r["text"]) for r in ds.dataset(f"{SF001}/{name}.parquet").to_table().to_pylist()]

    return read("documents", "doc_id"), read("benchmark", "item_id")


ODD_ITEMS = [
    (None, "of the"), (7, "The THE the the"), (900, None), (901, ""), (902, "a " * 14), (903, "één x"), (903, "one"),
]


@pytest.mark.parametrize("few", [decontaminate.BROADCAST_ROWS, 0])
@pytest.mark.parametrize("short", [False, True])
def test_every_window_is_found(spark, docs, odd, tables, few, short):
    documents, items = tables
    items = items + (ODD_ITEMS + [(items[3][0], items[5][1]), (950, items[5][1])] if short else [])
    inside = f"start {items[5][1].upper()}, end"
    documents = documents + odd + [(77, "a " * 40), (77, "a " * 40), (78, inside), (None, "of the THE THE the the één X one")]
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as mark", "2 as words", "3 as size")
    found = decontaminate.find_contamination(docs(documents, decoys=True), table, broadcast_rows=few)
    assert answered(found) == search_all(documents, items)


@pytest.mark.parametrize(("window", "gram"), [(1, 1), (3, 3), (6, 1), (4, 2)])
def test_other_windows(spark, docs, window, gram):
    documents = [(i, " ".join("abc"[(i * j * j + j) % 3] for j in range(i))) for i in range(1, 40)]
    items = [(1, "a b c a b c a"), (2, "b b b b b"), (3, "c")]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_contamination(docs(documents), table, window=window, gram=gram)
    assert answered(found) == search_all(documents, items, window)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.find_contamination(docs([]), some).collect() == []
    assert answered(decontaminate.find_contamination(docs([(1, "a b")]), none)) == search_all([(1, "a b")], [])


def test_no_python_in_the_plan(docs, spark):
    table = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    plan = decontaminate.find_contamination(docs([(1, "a b c")]), table)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_registered_query_against_sql(spark):
    with duckdb.connect() as db:
        for name in ("documents", "benchmark"):
            db.execute(f"create view {name} as select * from '{SF001}/{name}.parquet'")
        wanted = db.execute(queries.ORACLE["op13_decontamination"]).fetchall()
    assert answered(queries.op13_decontamination(spark, SF001)) == sorted(map(str, wanted))
