"""Token ids of texts, with a memo of the pieces between spaces."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

import numpy as np
import tiktoken

#: A space inside a run of white space, or at its end when the text ends there: such a run is one piece.
INSIDE_RUN = re.compile(r" (?<=\s )(?=\s|\Z)")
#: Memo entries of a worker; the memo starts anew beyond.
MEMO_ENTRIES = 400_000
_ENCODERS: dict[str, Callable[[str], np.ndarray]] = {}


class _Memo(dict):
    def __init__(self, encode: Callable[[str], list[int]]):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.encode(piece), "<u2").tobytes()
        if len(piece) <= 64:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[piece] = ids
        return ids


def ranks_path(json_path: str) -> str:
    """The rank file of the same vocabulary, beside the tokenizer's JSON file."""
    return json_path.removesuffix(".json") + ".tiktoken"


def encoder(json_path: str, pattern: str) -> Callable[[str], np.ndarray]:
    """A function from text to its ids as unsigned 16-bit integers; one per worker.

    The vocabulary's rank file gives the ids of the tokenizer's JSON file, several times faster. A piece of the pattern holds a space
    only as its first character, or inside a run of white space; so a text without the latter may be cut before each space and the
    parts encoded alone, each different part once. Other texts are encoded whole.
    """
    if json_path not in _ENCODERS:
        with open(ranks_path(json_path), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        whole = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        memo = _Memo(whole)

        def encode(text: str) -> np.ndarray:
            if INSIDE_RUN.search(text):
                return np.array(whole(text), "<u2")
            head, *rest = text.split(" ")
            parts = [head, *[" " + part for part in rest]] if head else [" " + part for part in rest]
            return np.frombuffer(b"".join(map(memo.__getitem__, parts)), "<u2")

        _ENCODERS[json_path] = encode
    return _ENCODERS[json_path]
