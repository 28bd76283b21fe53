"""Byte-level BPE, packing and section counts against the libraries themselves."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from skytally.llm import byte_bpe, hf_tokens, packing, queries, token_counts
from skytally.llm.pretokens import ChunkEncoder
from skytally.llm.queries import RANKS, TOKENIZER

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def hf():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    return tokenizer


def random_texts(n, seed):
    rng = random.Random(seed)
    letters = "abcdeth ing\n\t  .,'sß😀1 "
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_matrix_encoder_equals_library(tik, odd):
    encode, bpe = byte_bpe.text_encoder(RANKS, PATTERN)
    texts = [t for _, t in odd] + random_texts(2000, 1) + ["ab" * 2000 + "é" * 700]
    for text, ids in zip(texts, encode(texts), strict=True):
        assert ids.tolist() == tik.encode_ordinary(text or "")
        assert bpe.decode(ids) == (text or "").encode()


def test_long_pieces_merge_like_short_ones():
    bpe = byte_bpe.load_bpe(RANKS)
    rng = random.Random(2)
    for _ in range(200):
        piece = bytes(rng.choice(b"abcdething") for _ in range(rng.randint(2, 60)))
        if piece not in bpe.ranks:
            short = bpe._merge_matrix([piece], len(piece))[0]
            assert bpe._merge_long(piece).tolist() == short.tolist()


def test_pair_table_finds_all_pairs():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257, b"bc": 258}
    table = byte_bpe.PairTable(ranks)
    left, right = np.array([97, 256, 98, 97, 1]), np.array([98, 99, 99, 258, 2])
    assert table.lookup(left, right).tolist() == [256, 257, 258, 257, byte_bpe.NONE]


def test_a_small_memory_changes_nothing():
    encode, bpe = byte_bpe.text_encoder(RANKS, PATTERN)
    small = ChunkEncoder(PATTERN, lambda ps: [i.tobytes() for i in bpe.encode_pieces([p.encode() for p in ps])], remembered=5)
    texts = random_texts(50, 3)
    for text, want in zip(texts, encode(texts), strict=True):
        assert np.frombuffer(small.encode([text])[0], np.int32).tolist() == want.tolist()


def test_digests(docs, odd, tik):
    rows = byte_bpe.digest_documents(docs(odd, decoys=True), RANKS, PATTERN).collect()
    want = []
    for doc_id, text in odd:
        ids = tik.encode_ordinary(text or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (text or "").encode())]
        want.append((doc_id, len(ids), *sha))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert byte_bpe.digest_documents(docs([]), RANKS, PATTERN).collect() == []


def test_documents_come_back(docs, odd):
    rows = byte_bpe.encode_documents(docs(odd), RANKS, PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in rows) == sorted((t or "").encode() for _, t in odd)


def test_library_encoder_and_spans(hf, odd):
    encode, lengths = hf_tokens.text_encoder(TOKENIZER)
    texts = [t or "" for _, t in odd] + random_texts(1000, 4)
    for text, ids in zip(texts, encode(texts), strict=True):
        whole = hf.encode(text, add_special_tokens=False)
        assert ids.tolist() == whole.ids
        assert list(zip(*(x.tolist() for x in token_counts.token_spans(text, ids, lengths)), strict=True)) == whole.offsets


def test_special_tokens_as_the_unchanged_library(docs, odd):
    unchanged = Tokenizer.from_file(TOKENIZER)
    end = "<|endoftext|>"
    rng = random.Random(6)
    texts = [t or "" for _, t in odd] + [end, end * 3, f"a {end} b", f"é  {end}\n\n ß{end}", "<|endof<|endoftext|>text|>", "<|endoftext"]
    texts += ["".join(rng.choice(["a ", " b", "\n", "  ", "<|", "|>", "ß", end]) for _ in range(20)) for _ in range(300)]
    encode, lengths = hf_tokens.text_encoder(TOKENIZER, True)
    for text, ids in zip(texts, encode(texts), strict=True):
        whole = unchanged.encode(text, add_special_tokens=False)
        assert ids.tolist() == whole.ids
        assert list(zip(*(x.tolist() for x in token_counts.token_spans(text, ids, lengths)), strict=True)) == whole.offsets
    assert encode([None, end])[1].tolist() == [50256]
    pairs = list(enumerate(texts))
    check_packing(packing.pack_documents(docs(pairs), TOKENIZER, special_tokens=True).collect(), pairs, unchanged)
    rows = token_counts.count_section_tokens(docs(pairs), TOKENIZER, special_tokens=True).collect()
    assert {r.doc_id: r.doc_tokens for r in rows} == {i: len(unchanged.encode(t, add_special_tokens=False).ids) for i, t in pairs}


def test_queries_give_ids_of_the_unchanged_library(spark, tmp_path):
    unchanged = Tokenizer.from_file(TOKENIZER)
    pairs = [(1, "one <|endoftext|> two"), (2, "<|endoftext|>\nthree"), (3, None)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in pairs]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    check_packing(queries.op3_packing(spark, str(tmp_path)).collect(), pairs, unchanged)
    check_packing(corpus_pipeline.pack(spark, df, str(tmp_path)).collect(), pairs, unchanged)
    counts = {r.doc_id: r.doc_tokens for r in queries.op5_token_counts(spark, str(tmp_path)).collect()}
    assert counts == {i: len(unchanged.encode(t or "", add_special_tokens=False).ids) for i, t in pairs}


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_section_counts_equal_brute_force(docs, odd, hf, rule):
    pairs = [*enumerate(random_texts(60, 5), 100), *odd[:4]]
    rows = token_counts.count_section_tokens(docs(pairs, decoys=True), TOKENIZER, rule=rule, separator=r"[e\n]+").collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.section):
        got[r.doc_id].append((r.section_start, r.section_end, round(r.n_tokens, 9), r.n_crossing, r.doc_tokens))
    import re

    for doc_id, text in pairs:
        text = text or ""
        cuts = [0, *(m.end() for m in re.finditer(r"[e\n]+", text) if m.end() < len(text)), len(text)]
        spans = list(zip(cuts, cuts[1:], strict=False))
        counts, crossing = [0.0] * len(spans), [0] * len(spans)
        offsets = hf.encode(text, add_special_tokens=False).offsets
        for a, b in offsets:
            shared = {i: min(b, e) - max(a, s) for i, (s, e) in enumerate(spans) if min(b, e) > max(a, s)}
            for i in shared:
                crossing[i] += len(shared) > 1
                counts[i] += shared[i] / (b - a) if rule == "split" else 0
            if rule == "start":
                counts[min(shared)] += 1
            elif rule == "end":
                counts[max(shared)] += 1
            elif rule == "longest":
                counts[max(shared, key=lambda i: (shared[i], -i))] += 1
        want = [(*s, round(c, 9), x, len(offsets)) for s, c, x in zip(spans, counts, crossing, strict=True)]
        assert got[doc_id] == want


def test_section_counts_edges(docs, odd):
    assert token_counts.count_section_tokens(docs([]), TOKENIZER).collect() == []
    rows = token_counts.count_section_tokens(docs(odd), TOKENIZER).collect()
    assert [(r.section, r.n_tokens) for r in rows if r.doc_id in (1, 2)] == [(0, 0.0)] * 2
    assert sum(r.doc_id == 6 for r in rows) == 2
    with pytest.raises(ValueError, match="rule"):
        token_counts.count_section_tokens(docs(odd), TOKENIZER, rule="none")


def check_packing(rows, pairs, hf, longest=2048):
    """Each id in exactly one piece, pieces gapless in their sequences, lengths and checksums right."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id].append(r)
    total = padded = 0
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= longest and len({r.tier for r in members}) == len({r.step_group for r in members}) == 1
        total += at
        padded += 0 if at & (at - 1) == 0 else longest - at
    wanted = defaultdict(list)
    for doc_id, text in pairs:
        wanted[doc_id].append([*hf.encode(text or "", add_special_tokens=False).ids, 1])
    assert set(pieces) == set(wanted)
    for doc_id, found in pieces.items():
        if len(wanted[doc_id]) > 1:
            assert sum(r.length for r in found) == sum(map(len, wanted[doc_id]))
            continue
        ids, at = wanted[doc_id][0], 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    return total, padded


def test_packing(docs, odd, hf):
    texts = [" ".join(random_texts(n % 60, n)) for n in range(300)]
    pairs = [*odd, *enumerate(texts, 100)]
    for pool in (1 << 20, 4000):
        rows = packing.pack_documents(docs(pairs, decoys=True), TOKENIZER, pool_tokens=pool).collect()
        total, padded = check_packing(rows, pairs, hf)
        assert padded == 0 and total > 100_000
    groups = defaultdict(dict)
    for r in rows:
        groups[r.step_group][r.sequence_id] = r.tier
    full = [sum(g.values()) for g in groups.values()]
    assert max(full) <= 1 << 15 and sum(f == 1 << 15 for f in full) >= 2
    assert packing.pack_documents(docs([]), TOKENIZER).collect() == []


def test_packing_with_ids(docs, hf):
    rows = packing.pack_documents(docs([(1, "a b c"), (2, None)]), TOKENIZER, with_ids=True, end_id=7).collect()
    ids = {i: sum((r.ids for r in sorted(rows, key=lambda r: r.start) if r.doc_id == i), []) for i in (1, 2)}
    assert ids == {1: [*hf.encode("a b c").ids, 7], 2: [7]}


def test_whole_documents_stay_whole_where_they_fit():
    packer = packing.Packer((4, 8), pool_tokens=100)
    closed = [s for d, n in enumerate([5, 3, 8, 7, 1]) for s in packer.add(d, n)] + packer.finish()
    assert sorted(sum(length for *_, length in s) for s in closed) == [8, 8, 8]
    assert all(len([p for s in closed for p in s if p[0] == d]) == 1 for d in range(5))
    with pytest.raises(ValueError, match="powers"):
        packing.Packer((3,))


def test_ids_equal_the_unchanged_library():
    library = Tokenizer.from_file(queries.TOKENIZER)
    encode, _ = hf_tokens.text_encoder(queries.TOKENIZER, True)
    rng = random.Random(3)
    kinds = [lambda: rng.randrange(32, 0x250), lambda: rng.randrange(0x250, 0xD7FF), lambda: rng.randrange(0xE000, 0x1FFFF)]
    blanks = [32, 10, 9, 0x85, 0xA0, 0x2028, 0x200B, 0x1C, 39, 115, 116]
    texts = ["".join(chr(rng.choice([rng.choice(kinds)(), rng.choice(blanks)])) for _ in range(rng.randrange(60))) for _ in range(5000)]
    texts += ["\n" * 100_000, " " * 1500 + "a", " " * 999 + "a", "x" * 50_000, "é" * 20_000, "a<|endoftext|>b<|endoftext|>", "", "I'LL we'll 's"]
    for text, ids in zip(texts, encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_ranks_need_ids_in_the_order_of_merges():
    letters = hf_tokens.byte_letters()
    model = {"type": "BPE", "vocab": dict(letters) | {"ab": 256, "abc": 257}, "merges": ["a b", "ab c"]}
    assert hf_tokens.merge_ranks(model, set())[b"abc"] == 257
    for change in ({"merges": ["ab c", "a b"]}, {"merges": ["a b"]}, {"dropout": 0.1}, {"type": "Unigram"}, {"ignore_merges": True}):
        assert hf_tokens.merge_ranks(model | change, set()) is None
