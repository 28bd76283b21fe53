"""Token counts of the sections of documents.

A whole document is encoded once. Its tokens have character spans, its sections have character spans, and the two are
interval-joined: every token belongs to the sections whose span meets its own. A token that crosses a boundary is
allocated by a stated rule:

- ``start``: to the section of its first character,
- ``end``: to the section of its last character,
- ``longest``: to the section that holds most of its characters, the earlier one of equals,
- ``split``: to every section it meets, by the share of its characters there.

With every rule the counts of a document's sections add up to its tokens. A character that is cut into several tokens
counts as the span of each of them. Sections are the lines of the text (the line break ends its line) or the parts given
by any other pattern of separators. A null or empty text has one empty section without tokens. Repeated rows give repeated
results, an empty table an empty one. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skytally.llm import hf_tokens
from skytally.llm.shared import in_slices

RULES = ("start", "end", "longest", "split")


def token_spans(text: str, ids: np.ndarray, byte_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last character of every token."""
    ends = np.cumsum(byte_lengths[ids])
    starts = ends - byte_lengths[ids]
    raw = text.encode()
    if len(raw) == len(text):
        return starts, ends
    # The number of the character that every byte belongs to: bytes that continue a character start none.
    char = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) - 1
    return char[starts], char[ends - 1] + 1


def section_spans(text: str, separator: re.Pattern) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last character of every section; a separator belongs to the section that it ends."""
    cuts = [m.end() for m in separator.finditer(text) if m.end() < len(text)]
    return np.array([0, *cuts]), np.array([*cuts, len(text)])


def attribute(
    token_start: np.ndarray, token_end: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section by the rule, and how many of the tokens that meet the section cross one of its bounds.

    Sections tile the text, so the join is two binary searches: the sections of a token run from that of its first
    character to that of its last one.
    """
    n = len(starts)
    first = np.searchsorted(starts, token_start, "right") - 1
    last = np.searchsorted(starts, token_end - 1, "right") - 1
    crossing = np.flatnonzero(last > first)
    crossed = np.zeros(n, np.int64)
    counts = np.bincount(first[last == first], minlength=n).astype(np.float64)
    if len(crossing):
        # One row per crossing token and section that it meets.
        width = last[crossing] - first[crossing] + 1
        token = np.repeat(crossing, width)
        section = np.repeat(first[crossing] - (np.cumsum(width) - width), width) + np.arange(width.sum())
        np.add.at(crossed, section, 1)
        shared = np.minimum(ends[section], token_end[token]) - np.maximum(starts[section], token_start[token])
        if rule == "split":
            np.add.at(counts, section, shared / (token_end - token_start)[token])
        else:
            if rule == "longest":
                order = np.lexsort((section, -shared, token))
                chosen = section[order][np.searchsorted(token[order], crossing)]
            else:
                chosen = (first if rule == "start" else last)[crossing]
            np.add.at(counts, chosen, 1)
    return counts, crossed


def count_section_tokens(
    df: DataFrame,
    tokenizer_path: str,
    *,
    rule: str = "start",
    separator: str = r"\n",
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = 256,
    special_tokens: bool = False,
) -> DataFrame:
    """One row per document and section: ``section`` (from 0), ``section_start``, ``section_end`` (characters),
    ``n_tokens`` (double), ``n_crossing``, and ``doc_tokens`` of the whole document. ``special_tokens`` is that of
    ``hf_tokens.text_encoder``. No shuffle."""
    if rule not in RULES:
        raise ValueError(f"the rule is one of {', '.join(RULES)}")
    names = [id_col, "section", "section_start", "section_end", "n_tokens", "n_crossing", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, byte_lengths = hf_tokens.text_encoder(tokenizer_path, special_tokens)
        cut = re.compile(separator)
        for batch in in_slices(batches, rows):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            parts, sizes = [], []
            for text, ids in zip(texts, encode(texts), strict=True):
                starts, ends = section_spans(text, cut)
                counts, crossed = attribute(*token_spans(text, ids, byte_lengths), starts, ends, rule)
                sizes.append(len(starts))
                parts.append((np.arange(len(starts)), starts, ends, counts, crossed, np.full(len(starts), len(ids))))
            owner = batch.column(0).take(pa.array(np.repeat(np.arange(len(texts)), sizes)))
            columns = [pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)] if parts else []
            if parts:
                yield pa.RecordBatch.from_arrays([owner, *columns], names)

    kind = df.schema[id_col].dataType.simpleString()
    schema = (
        f"`{id_col}` {kind}, section long, section_start long, section_end long, n_tokens double, n_crossing long, "
        "doc_tokens long"
    )
    return df.select(id_col, text_col).mapInArrow(run, schema)
