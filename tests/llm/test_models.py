"""Quality, toxicity and personal data: against brute force and held-out labels."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skytally.llm import pii, quality_knn, queries, toxicity
from skytally.llm.shared import training_sample

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def labels_of(spark, pairs, label):
    return spark.createDataFrame(pairs, f"doc_id long, {label} int")


# --- quality


def test_blocked_neighbours_equal_brute_force():
    rng = random.Random(0)
    texts = ["".join(rng.choice("abc DEF!|\n12") for _ in range(rng.randint(1, 200))) for _ in range(80)]
    found, y = [quality_knn.terms(t) for t in texts[:60]], np.array([i % 2 for i in range(60)])
    space = quality_knn.fit(found, y, {0: 0.2, 1: 0.8})
    scores = space.score(texts)
    vectors = space.embed(texts)
    for v, score in zip(vectors, scores, strict=True):
        near = sorted(range(60), key=lambda i: -float(v @ space.vectors[i]))[: quality_knn.NEIGHBOURS]
        votes = [max(0.0, float(v @ space.vectors[i])) ** quality_knn.POWER * (1.6 if y[i] else 0.4) for i in near]
        assert score == pytest.approx(sum(w for w, i in zip(votes, near, strict=True) if y[i]) / sum(votes), abs=1e-3)


def test_held_out_quality(spark):
    rows = queries.op8_quality(spark, SF01)
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    held = rows.join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held) and len(held) > 100
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert rows.count() == 1000


def test_quality_of_odd_rows(spark, docs, odd):
    labels = labels_of(spark, [(1, 0), (6, 1), (6, None), (7, 1), (7, 0), (None, 1), (99, 1)], "quality")
    rows = quality_knn.score_quality(docs(odd, decoys=True), labels).collect()
    assert len(rows) == len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id == 6}) == 1
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    none = quality_knn.score_quality(docs(odd), labels_of(spark, [], "quality")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_knn.score_quality(docs([]), labels).collect() == []


def test_labels_of_the_held_out_fold_teach_nothing(spark, docs):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 == 1]
    held = labels_of(spark, [(i, 0) for i in ids], "quality")
    sample, counts = training_sample(docs((i, "text") for i in range(200)), held, "quality", folds=3, fold=1, per_class=5)
    assert sample.collect() == [] and counts == {}


def test_training_sample_is_bounded_and_settles_ties(spark, docs):
    given = [(i, i % 2) for i in range(100) for _ in range(2)] + [(3, 0), (3, 0), (5, 0), (5, 0)]
    sample, counts = training_sample(
        docs((i, str(i)) for i in range(100)), labels_of(spark, given, "quality"), "quality", folds=1000, fold=999, per_class=7
    )
    rows = sample.collect()
    assert counts == {0: 50, 1: 50} and sorted(r.y for r in rows) == [0] * 7 + [1] * 7
    assert all(r.y == r.doc_id % 2 for r in rows)


# --- toxicity


def test_transducers():
    step = toxicity.grammar(negated=0.5, reported=0.7, targeted=1.3)

    def factor(*symbols):
        state, out = step.start, 1.0
        for s in symbols:
            state, _, out = step.step(state, s)
        return pytest.approx(out)

    i, n, r, t, o = toxicity.INSULT, toxicity.NEGATION, toxicity.REPORT, toxicity.TARGET, toxicity.OTHER
    assert factor(i) == 1.0 and factor(n, i) == 0.5 and factor(n, o, o, i) == 0.5 and factor(n, o, o, o, i) == 1.0
    assert factor(r, *[o] * 9, i) == 0.7 and factor(t, i) == 1.3 and factor(t, o, o, o, o, i) == 1.0
    assert factor(t, r, n, i) == 0.5 * 0.7 * 1.3


def test_composition_equals_the_cascade():
    rng = random.Random(1)
    parts = [toxicity.within(toxicity.NEGATION, (toxicity.INSULT,), 2, 0.5), toxicity.within(toxicity.REPORT, (toxicity.INSULT,), 0, 0.7)]
    both = toxicity.compose(*parts, toxicity.SYMBOLS)
    for _ in range(200):
        states, state = [p.start for p in parts], both.start
        for _ in range(12):
            symbol = rng.choice(toxicity.SYMBOLS)
            state, out, x = both.step(state, symbol)
            y, middle = 1.0, symbol
            for k, p in enumerate(parts):
                states[k], middle, z = p.step(states[k], middle)
                y *= z
            assert (out, x) == (middle, pytest.approx(y))


def test_clauses_are_scored_apart():
    found = toxicity.Grammar({"idiot$": 4.0, "zor": 2.0})
    assert found.clauses("You idiot. Not an idiot! All fine; they said zorbish things") == pytest.approx([5.2, 2.0, 2 * 0.7 * 1.3])
    assert found.clauses("idiotic work, nothing else") == [] and found.clauses("") == []


def test_threats_and_targets_on_either_side():
    found = toxicity.Grammar({"idiot$": 4.0})
    (threat,), (process,) = found.clauses("I will kill you"), found.clauses("kill the process")
    assert threat == pytest.approx(0.5 * 1.2 * 1.3) and process == pytest.approx(0.5 * 0.3)
    assert found.clauses("idiot, you there") == found.clauses("you idiot") == found.clauses("you idiot you") == pytest.approx([5.2])
    assert found.clauses("such an idiot") == pytest.approx([4.8])
    for text in ("he killed her", "ich werde dich töten", "je vais te tuer toi", "kills them"):
        assert found.threatens(text) and found.clauses(text)
    assert not found.threatens("kill the process. You") and not found.threatens("you skill")


def test_the_weight_of_threats_is_learned(spark, docs):
    """Toxic documents whose only evidence is a threat, among clean ones with the same verbs and the same targets."""
    pairs, labels = toxic_corpus(600)
    rng = random.Random(4)
    for i in range(600, 1200):
        plain = pairs[i - 600][1].replace("grobian", "gabobo").replace("kretsch", "gabobo")
        toxic = i % 6 == 0
        end = f" I will {rng.choice(['kill', 'hurt', 'destroy'])} you." if toxic else " we kill the process. Thank you."
        pairs.append((i, plain + end))
        labels.append((i, int(toxic)))
    rows = toxicity.score_toxicity(docs(pairs), labels_of(spark, labels, "toxic")).collect()
    truth = dict(labels)
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows if r.held_out and r.doc_id >= 600]) > 0.9


def test_words_behind_clause_marks_count_without_blanks():
    found = toxicity.Grammar({"idiot$": 4.0})
    for text in ("Shut up!idiot", "a|b|idiot", "fine:idiot", "one.idiot;two"):
        assert found.clauses(text) == [4.0] and "idiot$" in toxicity.word_starts(text)
    assert found.features("a|b|idiot").tolist() == found.features("a | b | idiot").tolist()


def test_lexicon_prefers_the_longer_start():
    found = {"wor": (50, 1), "worthless$": (49, 0), "veq": (60, 0), "vequ": (30, 0), "vej": (2, 0)}
    assert set(toxicity.weigh_starts(found, 100, 900)) == {"worthless$", "veq", "vequ", "vej"}


def toxic_corpus(n, seed=0):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("bdfglm") + rng.choice("aeiou") for _ in range(3)) for _ in range(200)]
    pairs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(["grobian", "kretsch" + rng.choice(plain)])
        pairs.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic)))
    return pairs, labels


def test_held_out_toxicity(spark, docs):
    pairs, labels = toxic_corpus(600)
    rows = toxicity.score_toxicity(docs(pairs), labels_of(spark, labels, "toxic")).collect()
    truth = dict(labels)
    held = [r for r in rows if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held) and len(held) > 80
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97


def test_toxicity_of_odd_rows(spark, docs, odd):
    pairs, labels = toxic_corpus(300)
    mixed = [*((i + 1000, t) for i, t in pairs), *odd]
    given = labels_of(spark, [*((i + 1000, y) for i, y in labels), (None, 1), (6, None)], "toxic")
    rows = [r for r in toxicity.score_toxicity(docs(mixed, decoys=True), given).collect() if r.doc_id is None or r.doc_id < 1000]
    assert len(rows) == len(odd) and all(0 <= r.score < 0.3 and r.predicted == 0 for r in rows)
    assert {r.score for r in toxicity.score_toxicity(docs(odd), labels_of(spark, [(1, 0)], "toxic")).collect()} == {0.0}
    assert toxicity.score_toxicity(docs([]), given).collect() == []


# --- personal data


def brute_spans(text):
    """The patterns by one search after the other, checks spelled out."""
    out = []
    for kind, pattern in pii.PATTERNS.items():
        at = 0
        while m := re.compile(pattern).search(text, at):
            at, found = m.end(), m.group()
            digits = [int(c) for c in found if c.isdigit()]
            doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in found.split(".")),
                "card": 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            out += [(kind, m.start(), m.end())] if good else []
    return out


PRIVATE = [
    "mail a.b+c@d-e.co.uk now, or 1.2.3.4 and 256.1.1.1 and 1.2.3.4.5",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 and 4111111111111111",
    "call +1 (017) 555-7713 or +49 30 1234 567890 1234 or +123",
    "é😀 x@y.z @a.b c@ 00001.2.3.4 +1.2.3.4.5.6.7.8",
]


def test_patterns_equal_brute_force(odd):
    for text in [*PRIVATE, *(t or "" for _, t in odd)]:
        assert pii.pattern_spans(text) == brute_spans(text)


def test_patterns_equal_brute_force_on_random_texts():
    rng = random.Random(8)
    for _ in range(4000):
        text = "".join(rng.choice("a1@@..-_+ (9") for _ in range(rng.randrange(40)))
        assert pii.pattern_spans(text) == brute_spans(text)


def test_base_digest(docs, odd):
    pairs = [*odd, *enumerate(PRIVATE, 100)]
    rows = pii.digest_spans(docs(pairs, decoys=True)).collect()
    want = []
    for doc_id, text in pairs:
        spans = brute_spans(text or "")
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        want.append((doc_id, *[sum(k == kind for k, *_ in spans) for kind in pii.KINDS], hashlib.sha256(listed.encode()).hexdigest()))
    assert sorted(str(tuple(r)[:6]) for r in rows) == sorted(map(str, want))
    assert pii.digest_spans(docs([])).collect() == []
    for r in rows:
        if r.doc_id == 100:
            assert set(brute_list(PRIVATE[0])) <= set(r.spans.split(","))


def brute_list(text):
    return [f"{k}:{s}:{e}" for k, s, e in brute_spans(text)]


def test_repeated_mentions_are_added(docs):
    rng = random.Random(2)

    def phone():
        return f"({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"

    pairs = [(i, f"ring +1 {phone()} today, version {i}.2 of 12 parts") for i in range(60)]
    number = phone()
    again = f"ring +1 {number} today. Or try {number} at night, not 17 and not 555-0000."
    rows = {r.doc_id: r for r in pii.find_spans(docs([*pairs, (900, again)])).collect()}
    kinds = [(s.kind, again[s.start : s.end]) for s in rows[900].spans]
    assert ("phone", f"+1 {number}") in kinds
    assert any(k == "phone" and number[-8:] in found and "+" not in found for k, found in kinds)
    assert not any("0000" in found or found == "17" for _, found in kinds)
    assert all(rows[i].spans == rows[i].base for i in range(60))


def test_message_passing_is_exact_on_a_tree():
    """On a tree, message passing is exact."""
    rng = np.random.default_rng(5)
    chain, skip = rng.normal(size=(5, 5)), rng.normal(size=(3, 5, 5))
    model = pii.SkipChain({}, np.zeros(5), {}, chain, skip)
    unary = rng.normal(size=(4, 5))
    unary[2] = [-50.0, -50.0, 0.0, -50.0, -50.0]  # an observed node
    edges = {(0, 1): chain, (1, 2): chain, (0, 3): skip[1]}
    want = np.zeros((4, 5))
    for y in np.ndindex(5, 5, 5, 5):
        weight = np.exp(sum(unary[i, k] for i, k in enumerate(y)) + sum(t[y[i], y[j]] for (i, j), t in edges.items()))
        for i, k in enumerate(y):
            want[i, k] += weight
    found = model.marginals(unary, [(0, 1), (1, 2)], {(0, 3): 1}, rounds=200)
    assert found == pytest.approx(want / want.sum(axis=1, keepdims=True), abs=1e-3)


def test_redaction(docs):
    assert pii.redact("ab cd ef", [(3, 5, "ip"), (3, 8, "card")]) == "ab [CARD]"
    assert pii.redact("ab cd", [(0, 2, "ip"), (1, 4, "phone")]) == "[IP]d"
    rows = pii.redact_documents(docs([(1, "x@y.org is 1.2.3.4"), (2, None), (3, "")], decoys=True)).collect()
    assert {(r.doc_id, r.text) for r in rows} == {(1, "[EMAIL] is [IP]"), (2, None), (3, "")}


def planted_mentions():
    """Documents with mentions that the patterns find, and one of each kind of mention that they miss."""
    rng = random.Random(3)

    def digits(n):
        return "".join(str(rng.randrange(10)) for _ in range(n))

    def card():
        while not pii.passes_luhn(found := f"4{digits(15)}"):
            pass
        return found

    pairs, want = [], {}
    for i in range(240):
        phone, mail, number = f"({digits(3)}) {digits(3)}-{digits(4)}", f"ann.{digits(3)}@mail{i % 7}.org", card()
        ip = ".".join(str(rng.randrange(30, 255)) for _ in range(4))
        text = f"call +1 {phone} or {mail} from {ip} on {rng.randrange(1900, 2030)}, paid by {number}; part {digits(5)} of 12"
        if i % 5 == 0 and i < 200:
            # Second addresses of one person are what the table has to learn agreement from.
            text += f". Also {mail.replace('@', '@home.')}"
        missed = [
            ("phone", phone),
            ("email", mail.replace("@", " (at) ").replace(".org", " [dot] org")),
            ("card", number[:6] + str((int(number[6]) + 1) % 10) + number[7:]),
            ("email", mail.split("@")[0]),
        ][i % 4]
        if i >= 200:
            text += f". Later we met in 1999, order {digits(9)}, and saw {missed[1]} again"
            want[i] = missed
        pairs.append((i, text))
    return pairs, want


def test_the_field_finds_what_patterns_miss(docs):
    pairs, want = planted_mentions()
    texts = dict(pairs)
    found = pii.find_spans(docs(pairs)).collect()
    added = {}
    for r in found:
        base = [tuple(s) for s in r.base]
        assert base == pii.pattern_spans(texts[r.doc_id])
        more = [(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.spans if tuple(s) not in base]
        if more:
            added[r.doc_id] = more
    right = sum(more == [want.get(i)] for i, more in added.items())
    assert right == len(added)
    assert right >= 0.9 * len(want)


def test_mentions_win_by_their_form_alone(docs):
    """A prefix-less number shares nothing with another one of its document."""
    pairs = [(i, f"ring +1 ({200 + i}) 555-{1000 + 7 * i} today, version {i}.2 of 12 parts") for i in range(60)]
    alone = "ring (999) 321-4567 at night, or 1.2 of 17"
    rows = {r.doc_id: r for r in pii.find_spans(docs([*pairs, (900, alone)])).collect()}
    assert [(s.kind, alone[s.start : s.end]) for s in rows[900].spans] == [("phone", "(999) 321-4567")]
    assert rows[900].base == []


def test_spans_under_a_given_model_do_not_depend_on_other_rows(docs):
    pairs, _ = planted_mentions()
    model = pii.train(docs(pairs))
    whole = {r.doc_id: r.spans for r in pii.find_spans(docs(pairs), trained=model).collect()}
    part = {r.doc_id: r.spans for r in pii.find_spans(docs(pairs[200:220]), trained=model).collect()}
    assert part == {i: whole[i] for i in part}
    assert len(part) == 20


def test_potentials_count_every_document(docs):
    """The counts of the executors are those of a loop over all texts, however many rows repeat."""
    pairs = planted_mentions()[0] + [(1, PRIVATE[0])] * 700 + [(2, None), (3, "")]
    model = pii.train(docs(pairs))
    forms = {}
    for _, text in pairs:
        for part, key, x, _ in pii._counts(text or ""):
            if part == pii.FORM_COUNT:
                forms.setdefault(key, [1.0, 0.1, 0.1, 0.1, 0.1])[x] += 1
    assert set(forms) == set(model.forms) - {pii._HANDLE}
    for key, n in forms.items():
        assert np.exp(model.forms[key]) == pytest.approx(np.array(n) / sum(n))


def test_numbers_one_edit_apart_share_an_edge():
    def linked(a, b):
        text = f"{a}, then some other words, {b}"
        return len(pii.edges_of(text, pii.nodes_of(text, []))[1]) > 0

    assert linked("4111111111111111", "4111111111111112") and linked("4111111111111111", "411111111111111")
    assert linked("12345678", "12345687") and linked("987-12-34567", "1234567")
    assert not linked("12345678", "12348765") and not linked("17", "17")


def test_long_and_odd_texts_of_the_field():
    for text in ["1" * 200_000 + "x", "1 " * 50_000 + "x", "a@" * 50_000, "(at)" * 50_000, "a" * 200_000 + " 1", "([" * 50_000 + "1"]:
        nodes = pii.nodes_of(text, pii.pattern_spans(text))
        assert all(a.end <= b.start for a, b in zip(nodes, nodes[1:], strict=False))
    text = "\u0130 x.y@z.org " * 3 + "x.y and X.Y"
    found = [text[n.start : n.end] for n in pii.nodes_of(text, pii.pattern_spans(text))]
    assert found == ["x.y@z.org"] * 3
    text = "\u0130 ann.b@z.org " * 3 + "ann.b and ANN.B"
    found = [text[n.start : n.end] for n in pii.nodes_of(text, pii.pattern_spans(text))]
    assert found == ["ann.b@z.org"] * 3 + ["ann.b", "ANN.B"]
