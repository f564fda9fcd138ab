"""Token ids of texts inside a task, the same as the library of the vocabulary file gives them."""

from __future__ import annotations

import base64
import functools
import json
import os
import re

import numpy as np

# A text may be cut where white space follows one of these: no token of a byte-level vocabulary
# spans the cut, and the pattern that splits words before the merges starts anew there.
SAFE = re.compile(r"(?<=[!-~])(?=[ \n])")
# Longer runs without or of white space go the slow way, which is linear in the length of a run.
LONG_RUN = re.compile(r"\S{2000}|\s{2000}")


def byte_of_symbol() -> dict[str, int]:
    """The symbols of byte-level vocabularies: printable bytes stand for themselves, the others for
    the symbols from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """``ids(text)`` and ``count(text)``, for .json (tokenizers) and .model (sentencepiece) files.

    A byte-level .json file with a .tiktoken file of the same vocabulary beside it is encoded by the
    faster library. Texts with special strings and texts with very long runs are always encoded by
    the library of the .json file.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path, self.fast, self.byte_level = path, None, False
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = lambda text: self.pieces.encode(text, num_threads=1)
            return
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.whole = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        with open(path, encoding="utf-8") as file:
            self.model = json.load(file)
        split = self.model.get("pre_tokenizer") or {}
        self.byte_level = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not self.model.get("normalizer")
        self.special = re.compile("|".join(re.escape(x["content"]) for x in self.model.get("added_tokens", [])) or r"(?!)")
        ranks = path.removesuffix(".json") + ".tiktoken"
        if self.byte_level and os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as file:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            if merges == {b: i for i, b in enumerate(self.token_bytes()) if i in self.own}:
                self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def token_bytes(self) -> list[bytes]:
        """Bytes of each id of a byte-level vocabulary."""
        to_byte = byte_of_symbol()
        out: dict[int, bytes] = {i: bytes(to_byte[c] for c in token) for token, i in self.model["model"]["vocab"].items() if all(c in to_byte for c in token)}
        added = {x["id"]: x["content"].encode() for x in self.model.get("added_tokens", [])}
        self.own = set(out) - set(added)
        out |= added
        return [out.get(i, b"") for i in range(max(out) + 1)]

    def _plain(self, text: str) -> bool:
        return self.fast is not None and not self.special.search(text) and not LONG_RUN.search(text)

    def ids(self, text: str) -> np.ndarray:
        if self._plain(text):
            return np.frombuffer(self.fast._core_bpe.encode_to_tiktoken_buffer(text, set()), dtype=np.uint32)
        return np.array(self.whole(text), dtype=np.uint32)

    def count(self, text: str) -> int:
        return len(self.ids(text))


@functools.cache
def encoder(path: str) -> Encoder:
    """One per worker process."""
    return Encoder(path)


def pieces(text: str, most: int, safe: re.Pattern = SAFE):
    """Parts of about ``most`` characters, cut at safe places only; a part is longer where there is none."""
    start = 0
    while len(text) - start > most:
        cut = safe.search(text, start + most)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]
