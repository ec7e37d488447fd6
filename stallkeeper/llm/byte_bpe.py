"""Ids of a byte-level BPE file of the tokenizers library, for whole texts.

The library needs about five times the CPU time of tiktoken's BPE.  Its file holds all that tiktoken needs: the tokens as bytes,
ranked by their merges, and the split rule of byte-level files.  So plain texts go through tiktoken over the merges of the same
file; the ids are the library's (``tests/llm`` compares them on all characters and on the tables).  Texts that hold the string of an
added token, and files of any other make, go through the library itself.
"""

from __future__ import annotations

import json
import os

import numpy as np

# Fixed value: the split rule of byte-level BPE files.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in such a file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def ranks(file: dict) -> dict[bytes, int] | None:
    """Token bytes to id; None if the file splits or changes texts in another way or its ids don't rise with its merges."""
    model, split = file["model"], file.get("pre_tokenizer") or {}
    usual = (model.get("type") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
             and not split.get("add_prefix_space") and not file.get("normalizer")
             and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")))
    if not usual:
        return None
    vocab = model["vocab"]
    made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    if any(a >= b for a, b in zip(made, made[1:])):
        return None
    byte = byte_letters()
    added = {t["content"] for t in file.get("added_tokens", [])}
    out = {bytes(byte[c] for c in token): i for token, i in vocab.items() if token not in added}
    return out if all(bytes([b]) in out for b in range(256)) and len(out) == 256 + len(made) else None


class ByteBPE:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark spreads the work
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.added = [t["content"] for t in file.get("added_tokens", [])]
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        found = ranks(file)
        self.fast = None
        if found:
            import tiktoken

            self.fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=found, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        """The ids of one whole text, without begin or end, as little-endian unsigned 32-bit integers."""
        if self.fast is None or any(a in text for a in self.added):
            return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)


_LOADED: dict[str, ByteBPE] = {}


def byte_bpe(path: str) -> ByteBPE:
    """The encoder of a file, once for each worker."""
    if path not in _LOADED:
        _LOADED[path] = ByteBPE(path)
    return _LOADED[path]
