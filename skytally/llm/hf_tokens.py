"""Ids of whole texts by a tokenizer file of the ``tokenizers`` library."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable

import numpy as np
import tiktoken

# Fixed value: the pattern that the byte-level pre-tokenizer of the library applies.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# A run of white space this long is left to the library: the pattern looks ahead behind each of its characters.
_LONG_RUN = re.compile(r"\s{1000}")

_LOADED: dict[tuple[str, bool], tuple] = {}


def byte_letters() -> dict[str, int]:
    """The characters that a byte-level vocabulary writes its bytes as: printable ones as themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def merge_ranks(model: dict, added: set[int]) -> dict[bytes, int] | None:
    """The ids of a BPE model by the bytes of its tokens, if they say in which order pairs are merged; else None."""
    plain = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    if model.get("type") != "BPE" or any(model.get(option) for option in plain):
        return None
    letters, vocabulary = byte_letters(), model["vocab"]
    merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    single = {i for token, i in vocabulary.items() if token in letters}
    if merged != sorted(set(merged)) or len(single) != 256 or {*merged, *single} != {*vocabulary.values()} - added:
        return None
    return {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if i not in added}


def text_encoder(path: str, special_tokens: bool = False) -> tuple[Callable[[list], list[np.ndarray]], np.ndarray]:
    """A function from texts to arrays of ids, and the number of bytes of every id. Loaded once per worker.

    With ``special_tokens``, special tokens whose literal stands in a text get their own ids, as an unchanged tokenizer of
    the file gives them with ``add_special_tokens=False``; without, their literals are text like any other (the library's
    ``encode_special_tokens``). Texts are cut at added tokens first. Where the ids of the file's vocabulary are in the order of its
    merges, as in byte-level files that were trained in one go, the parts between are encoded by ``tiktoken`` with ranks made from
    the same file: the same ids in a third of the time. Other files, and texts with very long runs of white space, go through
    ``tokenizers``.
    """
    if (path, special_tokens) not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        # Parts between added tokens hold none, so pieces are encoded by the same file without them.
        tokenizer = Tokenizer.from_str(json.dumps(content | {"added_tokens": [], "post_processor": None}))
        if not isinstance(tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel):
            raise ValueError(f"{path} has no byte-level pre-tokenizer")
        added = {t["id"]: t for t in content["added_tokens"]}
        cut = {t["content"]: i for i, t in added.items() if special_tokens or not t["special"]}
        if odd := [c for c, i in cut.items() if added[i]["single_word"] or added[i]["lstrip"] or added[i]["rstrip"]]:
            raise ValueError(f"{path} has added tokens that take the text around them into account: {odd}")
        # The longest of the tokens that start at a place counts, as in the library.
        at_added = re.compile("|".join(map(re.escape, sorted(cut, key=len, reverse=True)))) if cut else None

        # A byte-level vocabulary writes every byte as one character; added tokens are written as they are.
        vocabulary = {**content["model"]["vocab"], **{t["content"]: i for i, t in added.items()}}
        lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            lengths[i] = len(token.encode()) if i in added else len(token)

        simple = not content.get("normalizer") and not content["pre_tokenizer"].get("add_prefix_space")
        ranks = merge_ranks(content["model"], set(added)) if simple else None
        fast = tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}) if ranks else None

        def encode_part(text: str) -> np.ndarray:
            if fast is None or _LONG_RUN.search(text):
                return np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
            return np.array(fast.encode_ordinary(text), np.int32)

        def encode_parts(texts: list[str | None]) -> list[np.ndarray]:
            return [encode_part(t or "") for t in texts]

        def encode_cut(texts: list[str | None]) -> list[np.ndarray]:
            """The texts with added tokens go in as several parts; their ids are put together again."""
            if not at_added or not any(t and at_added.search(t) for t in texts):
                return encode_parts(texts)
            parts = [at_added.split(t or "") for t in texts]
            found = iter(encode_parts([p for text in parts for p in text]))
            out = []
            for text, between in zip(texts, parts, strict=True):
                ids = [next(found)]
                for token in at_added.findall(text or ""):
                    ids += [np.array([cut[token]], np.int32), next(found)]
                assert len(ids) == 2 * len(between) - 1
                out.append(np.concatenate(ids))
            return out

        _LOADED[path, special_tokens] = (encode_cut, lengths)
    return _LOADED[path, special_tokens]
