"""Ids of whole texts by a tokenizer file of the byte-level kind."""

from __future__ import annotations

import json
import re

import numpy as np

# The pattern of the byte-level pre-tokenizer, and the characters its bytes are written as.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = {chr(b): b for b in _PLAIN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}


def _ranks(path: str) -> dict[bytes, int] | None:
    """Token bytes by id, if merging by lowest id is what the file says: plain byte-level BPE whose merges make tokens of rising ids."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    before, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = (
        spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
        and not before.get("add_prefix_space") and model.get("type", "BPE") == "BPE" and not model.get("ignore_merges")
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
    )
    if not plain:
        return None
    vocab = model["vocab"]
    made = [vocab.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model["merges"]]
    added = {t["content"] for t in spec.get("added_tokens", ())}
    tokens = [t for t in vocab if t not in added]
    if made != sorted(set(made)) or len(tokens) != 256 + len(made) or any(vocab.get(c, 1 << 40) >= min(made, default=1 << 40) for c in BYTES):
        return None
    return {bytes(map(BYTES.__getitem__, t)): vocab[t] for t in tokens}


class FileTokens:
    """``specials``: strings of the file's added tokens count as those tokens, as the tokenizer takes them: the text is
    cut at them first, and each part is a text of its own. Otherwise they are plain text.

    A file of the common plain kind is run by its ranks, which takes a fifth of the time of the general library and gives the same
    ids; any other file by the general library.
    """

    def __init__(self, path: str, specials: bool = True) -> None:
        from tokenizers import Tokenizer

        tool = Tokenizer.from_file(path)
        tool.encode_special_tokens = not specials
        self.tool, ranks = tool, _ranks(path)
        added = tool.get_added_tokens_decoder() if specials else {}
        simple = not any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values())
        self.added = {t.content: i for i, t in added.items()}
        # of two that begin at one place the longer one is taken
        names = sorted(self.added, key=len, reverse=True)
        self.splitter = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.fast = None
        if ranks is not None and simple:
            import tiktoken

            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(self, text: str) -> list[int]:
        if self.fast is None:
            return self.tool.encode(text, add_special_tokens=False).ids
        if self.splitter is None or not any(t in text for t in self.added):
            return self.fast(text)
        out: list[int] = []
        for i, part in enumerate(self.splitter.split(text)):
            out += [self.added[part]] if i % 2 else self.fast(part)
        return out

    def encode(self, text: str) -> bytes:
        return np.array(self.ids(text), "<u4").tobytes()
