"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns find e-mail addresses, IP addresses, card numbers and phone numbers; what they find stays. The field adds
mentions that the patterns miss because a part is missing or wrong: a phone number without its prefix, a card number with a
wrong digit, an address written with ``(at)``.

Its nodes are the pattern's spans, which are observed, and whatever else could be a mention: groups of digits, words around
``@`` or ``(at)``, and words that equal the first part of an address in the same document. The potentials:

- the form of a node (digits, groups and last separator; for addresses, whether the first part has a digit or mark). The form leaves
  out what a pattern demands, such as the prefix of a phone number or the check digit, so that it says how
  often things that look like this are mentions;
- the word before it, hashed to ``CUES`` places;
- the labels of neighbours in the text (the chain), limited to ``CHAIN``, so that neighbours alone decide nothing;
- agreement of nodes with equal content, with a part in common (last seven digits, first part of an address) or one edit apart,
  however far apart in the document (skip edges: each node to the one before it and to the first one).

All are counted on all documents, with the patterns' labels. Forms, places of words and labels bound the number of counts,
whatever the size of the table. Loopy message passing makes labels agree across a document. A node is added where its marginal
for a kind is at least ``certainty``. A document without a span of the patterns and without a node that is likelier a mention
than not by itself gets none.

A null text is empty. Rows are read apart, so repeated rows get equal results, and an empty table gives an empty one. Extra
columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.shared import in_slices

# The kinds in the order of results, and their patterns.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# No address starts inside a run of digits that fails from its start; to say so keeps long runs linear.
_COMPILED = {kind: re.compile(r"(?<![0-9])" * (kind == "ip") + pattern) for kind, pattern in PATTERNS.items()}
_LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]")
LABELS = len(KINDS) + 1  # 0 is outside

CUES = 1024
CHAIN = 1.0
EDGES = ("equal", "part", "near")  # kinds of skip edges

_NUMBER = re.compile(r"(?<![\w@])[+(]?[0-9](?:[\x20().-]{0,2}[0-9])*(?![\w@])")
_AT = re.compile(r"@|[\[(]\s?at\s?[\])]", re.IGNORECASE)
_HOST = re.compile(r"[\w-]+(?:(?:\.|\s?[\[(]\s?dot\s?[\])]\s?)[\w-]+)*", re.IGNORECASE)
_DOT = re.compile(r"\s?[\[(]\s?dot\s?[\])]\s?", re.IGNORECASE)
_GROUP = re.compile(r"[0-9]+")
_WORD = re.compile(r"[\w%+-]+(?:\.[\w%+-]+)*")
_MARKED = re.compile(r"\w[._+-]\w|[0-9]")
_LOCAL = frozenset("._%+-")
_SEPARATORS = " ().-"
_MAIL, _HANDLE = 10_000, 10_002


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _valid(kind: str, found: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in found.split("."))
    digits = "".join(_DIGITS.findall(found))
    if kind == "card":
        return 16 <= len(digits) <= 19 and passes_luhn(digits)
    return 8 <= len(digits) <= 15


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """What the e-mail pattern finds from left to right: the run before an ``@`` that a domain follows. Linear in long words."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_PART:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end (characters) of what the patterns find, by kind and start."""
    out = []
    for kind in KINDS:
        if kind == "email":
            out += [(kind, start, end) for start, end in _addresses(text)]
        elif kind != "phone" or "+" in text:
            out += [(kind, *m.span()) for m in _COMPILED[kind].finditer(text) if _valid(kind, m.group())]
    return out


@dataclass(frozen=True)
class Node:
    start: int
    end: int
    label: int  # of the pattern that found it, or -1
    form: int
    cue: int  # place of the word before it, or -1
    keys: tuple[tuple[str, str], ...]  # nodes with a key in common are joined by a skip edge


def _number(text: str, start: int, end: int) -> tuple[int, tuple[tuple[str, str], ...]]:
    """Form and keys of a number. The form has the digits (21 for more than any kind has), the groups (5 for more) and the
    separator before the last group, without the first group where that is a prefix with ``+``."""
    found = text[start:end]
    groups = _GROUP.findall(found)
    digits = "".join(groups)
    keys = [("equal", digits)] if len(digits) >= 5 else []
    if len(digits) >= 7:
        keys.append(("part", digits[-7:]))
    if 7 <= len(digits) <= 20:
        # Two numbers one edit apart have one of these in common.
        keys += [("near", d) for d in {digits, *(digits[:i] + digits[i + 1 :] for i in range(len(digits)))}]
    own = groups[1:] if found[0] == "+" and len(groups) > 1 else groups
    before = found[: len(found) - len(groups[-1])][-1:] if len(own) > 1 else ""
    separator = 1 + _SEPARATORS.index(before) if before in _SEPARATORS and before else 0
    size = sum(map(len, own))
    return min(size, 21) * 100 + min(len(own), 5) * 10 + separator, tuple(keys)


def _mail(text: str, start: int, end: int) -> tuple[int, tuple[tuple[str, str], ...]]:
    """Form and keys of an address, however its marks are written."""
    plain = "".join(_DOT.sub(".", _AT.sub("@", text[start:end].lower())).split())
    local = plain.split("@")[0]
    marked = _MARKED.search(local) is not None
    keys = [("equal", plain)]
    if marked and len(local) >= 5:
        keys.append(("part", local))
    return _MAIL + marked, tuple(keys)


def _mails(text: str) -> list[tuple[int, int]]:
    """Where words stand on both sides of ``@`` or ``(at)``, which may have a blank beside it."""
    found: list[tuple[int, int]] = []
    if "@" not in text and "(" not in text and "[" not in text:
        return found
    for m in _AT.finditer(text):
        first, host = m.span()
        if m.group() != "@":
            first -= text[first - 1 : first] == " "
            host += text[host : host + 1] == " "
        end = first
        while first > 0 and (text[first - 1].isalnum() or text[first - 1] in _LOCAL):
            first -= 1
        after = _HOST.match(text, host)
        if after and first < end and (not found or found[-1][1] <= first):
            found.append((first, after.end()))
    return found


def _cue(text: str, start: int) -> int:
    at = start
    while at > 0 and not text[at - 1].isalnum() and text[at - 1] != "\n":
        at -= 1
    first = at
    while first > 0 and text[first - 1].isalpha():
        first -= 1
    return zlib.crc32(text[first:at].lower().encode("utf-8", "surrogatepass")) % CUES if first < at else -1


def nodes_of(text: str, spans: list[tuple[str, int, int]]) -> list[Node]:
    """The nodes of a document in the order of the text."""
    found = [(start, end, KINDS.index(kind) + 1, kind == "email") for kind, start, end in spans]
    gaps, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1:]):
        if start > at:
            gaps.append((at, start))
        at = max(at, end)
    gaps.append((at, len(text)))
    mails = []
    for start, end in _mails(text):
        low, high = gaps[max(0, bisect(gaps, (start, len(text))) - 1)]
        if low <= start and end <= high:
            mails.append((start, end))
    found += [(start, end, -1, True) for start, end in mails]
    nodes = []
    for start, end, label, is_mail in found:
        form, keys = (_mail if is_mail else _number)(text, start, end)
        nodes.append(Node(start, end, label, form, _cue(text, start), keys))
    nodes.sort(key=lambda n: (n.start, n.end))
    parts = {key for n in nodes if n.form >= _MAIL for kind, key in n.keys if kind == "part"}
    if parts:
        bounds, at = [(n.start, n.end) for n in nodes], 0
        for m in _WORD.finditer(text):
            if m.group().lower() not in parts:
                continue
            while at < len(bounds) and bounds[at][1] <= m.start():
                at += 1
            if at == len(bounds) or bounds[at][0] >= m.end():
                nodes.append(Node(*m.span(), -1, _HANDLE, _cue(text, m.start()), (("part", m.group().lower()),)))
    words = iter([*sorted((n.start, n.end) for n in nodes if n.label < 0), (len(text) + 1, len(text) + 1)])
    word = next(words)
    for low, high in gaps:
        for m in _NUMBER.finditer(text, low, high):
            start, end = m.span()
            if text[start] == "(" and ")" not in text[start:end]:
                start += 1
            while word[1] <= start:
                word = next(words)
            if end <= word[0]:
                form, keys = _number(text, start, end)
                nodes.append(Node(start, end, -1, form, _cue(text, start), keys))
    nodes.sort(key=lambda n: (n.start, n.end))
    return nodes


def edges_of(text: str, nodes: list[Node]) -> tuple[list[tuple[int, int]], dict[tuple[int, int], int]]:
    """Chain edges (at most three blanks between two nodes), and skip edges with the number of their kind, closest kind first."""
    chain = [
        (i, i + 1)
        for i, (a, b) in enumerate(zip(nodes, nodes[1:], strict=False))
        if len(text[a.end : b.start].split(None, 4)) <= 3
    ]
    skip: dict[tuple[int, int], int] = {}
    first: dict[tuple[str, str], int] = {}
    before: dict[tuple[str, str], int] = {}
    for i, node in enumerate(nodes):
        for key in node.keys:
            kind = EDGES.index(key[0])
            if key in before:
                for j in {before[key], first[key]}:
                    skip[j, i] = min(skip.get((j, i), kind), kind)
            first.setdefault(key, i)
            before[key] = i
    return chain, skip


@dataclass(frozen=True)
class SkipChain:
    """Trained potentials, as logarithms."""

    forms: dict[int, np.ndarray]
    other: np.ndarray
    cues: dict[int, np.ndarray]
    chain: np.ndarray
    skip: np.ndarray  # a table per kind of edge

    def unary(self, nodes: list[Node]) -> np.ndarray:
        none = np.zeros(LABELS)
        out = np.array([self.forms.get(n.form, self.other) + self.cues.get(n.cue, none) for n in nodes])
        for i, n in enumerate(nodes):
            if n.label >= 0:
                out[i] = -50.0
                out[i, n.label] = 0.0
        return out

    def marginals(self, unary: np.ndarray, chain, skip, *, rounds: int = 20, damping: float = 0.3) -> np.ndarray:
        """Label probabilities of every node by loopy message passing; observed nodes keep their label."""
        pairs = np.array([*chain, *skip], int).reshape(-1, 2)
        tables = np.concatenate([np.repeat(self.chain[None], len(chain), 0), self.skip[np.array(list(skip.values()), int)]])
        source, target = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
        tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
        messages = np.zeros((len(source), LABELS))
        for _ in range(rounds):
            belief = unary.copy()
            np.add.at(belief, target, messages)
            out = (belief[source] - messages[back])[:, :, None] + tables
            top = out.max(axis=1, keepdims=True)
            new = (top + np.log(np.exp(out - top).sum(axis=1, keepdims=True)))[:, 0, :]
            new -= new.max(axis=1, keepdims=True)
            if not len(new) or np.abs(new - messages).max() < 1e-4:
                break
            messages = damping * messages + (1 - damping) * new
        belief = unary.copy()
        np.add.at(belief, target, messages)
        belief = np.exp(belief - belief.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True)

    def add_spans(self, text: str, spans: list[tuple[str, int, int]], certainty: float) -> list[tuple[str, int, int]]:
        """The pattern's spans with those of further mentions, by kind and start."""
        nodes = nodes_of(text, spans)
        open_ = [i for i, n in enumerate(nodes) if n.label < 0]
        if not open_:
            return spans
        unary = self.unary(nodes)
        if not spans and not (unary[:, 1:].max(axis=1) > unary[:, 0]).any():
            return spans
        probability = self.marginals(unary, *edges_of(text, nodes))
        added = []
        for i in open_:
            label = int(probability[i].argmax())
            if label and probability[i, label] >= certainty:
                added.append((KINDS[label - 1], nodes[i].start, nodes[i].end))
        return sorted([*spans, *added], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


FORM_COUNT, CUE_COUNT, CHAIN_COUNT, SKIP_COUNT = range(4)


def _counts(text: str) -> Iterator[tuple[int, int, int, int]]:
    """What one document adds to the counts: which one, its key and two labels."""
    nodes = nodes_of(text, pattern_spans(text))
    chain, skip = edges_of(text, nodes)
    # What shares content with an observed node has no label to learn from: that is what the field decides.
    linked = {j for (a, b), kind in skip.items() if kind < 2 for i, j in ((a, b), (b, a)) if nodes[i].label > 0 > nodes[j].label}
    labels = [max(0, n.label) for n in nodes]
    for i, n in enumerate(nodes):
        if i not in linked and n.form != _HANDLE:
            yield FORM_COUNT, n.form, labels[i], 0
            if n.cue >= 0:
                yield CUE_COUNT, n.cue, labels[i], 0
    for i, j in chain:
        if i not in linked and j not in linked:
            yield CHAIN_COUNT, 0, labels[i], labels[j]
    for (i, j), kind in skip.items():
        if i not in linked and j not in linked:
            yield SKIP_COUNT, kind, labels[i], labels[j]


def potentials(counted) -> SkipChain:
    """The model of counts: rows of ``part``, ``key``, ``x``, ``y`` and ``n``. Forms get the log share of each label; words what they
    change in it, chains how much more often two labels meet than by chance, skip edges the log odds of agreement. What
    nothing is known of is taken to be outside at 10 to 1, and what shares content to agree at 6 to 1."""
    prior = np.array([1.0, *[0.1] * len(KINDS)])
    forms: dict[int, np.ndarray] = {}
    cues: dict[int, np.ndarray] = {}
    chain = np.full((LABELS, LABELS), 0.5)
    agree, differ = np.full(len(EDGES), 3.0), np.full(len(EDGES), 0.5)
    total = prior.copy()
    for row in counted:
        if row.part == FORM_COUNT:
            forms.setdefault(row["key"], prior.copy())[row.x] += row.n
        elif row.part == CUE_COUNT:
            cues.setdefault(row["key"], np.zeros(LABELS))[row.x] += row.n
            total[row.x] += row.n
        elif row.part == CHAIN_COUNT:
            chain[row.x, row.y] += row.n
            chain[row.y, row.x] += row.n
        elif row.x == row.y:
            agree[row["key"]] += row.n
        else:
            differ[row["key"]] += row.n
    share = total / total.sum()
    # Twenty sightings at the usual shares stand against what a word's place has seen.
    changed = {k: np.log((n + 20 * share) / (n.sum() + 20)) - np.log(share) for k, n in cues.items()}
    chain /= chain.sum()
    meet = np.log(chain) - np.log(chain.sum(axis=1))[:, None] - np.log(chain.sum(axis=0))[None, :]
    skip = np.array([np.eye(LABELS) * math.log(a / d) for a, d in zip(agree, differ, strict=True)])
    logs = {form: np.log(n / n.sum()) for form, n in forms.items()}
    # A word that equals the first part of an address has no label to learn from: it is outside or that address, evenly.
    handle = np.full(LABELS, 0.01)
    handle[[0, 1 + KINDS.index("email")]] = 0.5
    logs[_HANDLE] = np.log(handle / handle.sum())
    return SkipChain(logs, np.log(prior / prior.sum()), changed, np.clip(meet, -CHAIN, CHAIN), skip)


def train(documents: DataFrame) -> SkipChain:
    """Potentials from the labels that the patterns give on all rows of ``text``, counted by the executors. What comes to the driver
    is at most a count per form, place of a word or kind of edge, and pair of labels: below 15,000 rows for any table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in in_slices(batches, 512):
            for text in batch.column(0).to_pylist():
                found.update(_counts(text))
        if found:
            columns = [pa.array(c, pa.int32()) for c in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(found.values()), pa.int64())], ["part", "key", "x", "y", "n"])

    texts = documents.select("text").filter("text is not null")
    counted = texts.mapInArrow(count, "part int, key int, x int, y int, n long").groupBy("part", "key", "x", "y")
    return potentials(counted.agg(F.sum("n").alias("n")).collect())


def find_spans(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    certainty: float = 0.8,
    carry: tuple[str, ...] = (),
    trained: SkipChain | None = None,
) -> DataFrame:
    """Per document the id column, ``base`` and ``spans``: arrays of ``kind``, ``start``, ``end``, of the patterns alone and
    with the field's. ``carry`` names columns that are kept. Where a ``trained`` model is given, a document's spans do not depend on
    the other rows."""
    model = df.sparkSession.sparkContext.broadcast(trained or train(df.select(F.col(text_col).alias("text"))))
    kept = list(dict.fromkeys([id_col, *carry]))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 512):
            base = [pattern_spans(t or "") for t in batch.column("__text").to_pylist()]
            texts = batch.column("__text").to_pylist()
            every = [model.value.add_spans(t or "", b, certainty) for t, b in zip(texts, base, strict=True)]
            shown = [[[{"kind": k, "start": s, "end": e} for k, s, e in row] for row in rows] for rows in (base, every)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], *[pa.array(rows, span) for rows in shown]], [*kept, "base", "spans"]
            )

    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)
    spans = "array<struct<kind: string, start: bigint, end: bigint>>"
    source = df.select(*kept, F.col(text_col).alias("__text"))
    return source.mapInArrow(run, f"{kinds}, base {spans}, spans {spans}")


def listed(spans: str):
    """Spans as text: ``kind:start:end``, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest_spans(df: DataFrame, **options) -> DataFrame:
    """Per document the number of spans of either pattern, the SHA-256 of the listed pattern spans, and all spans listed."""
    found = find_spans(df, **options)

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        options.get("id_col", "doc_id"),
        *[number(kind) for kind in KINDS],
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind in brackets. Spans that overlap are one, named by the first."""
    out, at = [], 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    out.append(text[at:])
    return "".join(out)


def redact_documents(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    certainty: float = 0.8,
    carry: tuple[str, ...] = (),
    trained: SkipChain | None = None,
) -> DataFrame:
    """``carry`` columns and the text with all spans, of the patterns and of the field, replaced by their kinds. A null
    text stays null. ``trained`` as in ``find_spans``."""
    model = df.sparkSession.sparkContext.broadcast(trained or train(df.select(F.col(text_col).alias("text"))))
    kept = [c for c in dict.fromkeys([id_col, *carry]) if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 512):
            out = []
            for text in batch.column("__text").to_pylist():
                spans = model.value.add_spans(text, pattern_spans(text), certainty) if text else []
                out.append(redact(text, [(start, end, kind) for kind, start, end in spans]) if spans else text)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(out, pa.string())], [*kept, text_col])

    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)
    source = df.select(*kept, F.col(text_col).alias("__text"))
    return source.mapInArrow(run, f"{kinds}, `{text_col}` string")
