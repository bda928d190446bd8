"""SentencePiece encoding and decoding: exact merge-type encoding by backtracking.

A merge-type (BPE) encoding of a text is the one sequence of tokens of which every two neighbours, merged anew on their own, come out
as these two again: a merge across a border depends on nothing but the two tokens beside it. So no merges are run over the text. An
Aho-Corasick automaton over the reversed pieces gives the longest token that starts at each place. From left to right the longest
one that may stand beside its predecessor is taken, else its longest prefix that is a token, and so on; where none may, the place is
marked in a bitfield of failed positions and the last token is taken back. The tokens up to a place are its only encoding, so a
failed place is never entered again. Whether two tokens may be neighbours is found by merging their characters anew, and remembered.

Characters that are no piece become their UTF-8 bytes; they merge with nothing and part the text. No piece has a space mark inside,
a line break anywhere, or a letter beside certain ASCII signs (found when a model is loaded), so the stretches between are encoded
once each and remembered.

Models that the method cannot serve (not of merge type, with rules of normalisation, pieces set by a user, unused ones, no byte
pieces) are refused. Null texts are empty and have no ids. Texts of any length, repeated rows and repeated or null doc_ids are encoded
like others; an empty table gives an empty result. Columns other than doc_id and text are ignored; ``decoded`` keeps all columns but
one that is named like its result.
"""

from __future__ import annotations

import codecs
import re
import sys
from array import array
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyfold.llm.common import only

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE, MERGE_TYPE = 1, 2, 3, 6, 2
NEVER = float("inf")
#: What the library prints for an unknown id.
UNKNOWN_TEXT = " ⁇ "
#: Remembered stretches and pairs of a worker; each memo starts anew beyond.
MEMO_ENTRIES = 400_000
#: Longer stretches, in characters, are not remembered.
MEMO_CHARS = 64


def one_mark_a_byte(e: UnicodeDecodeError) -> tuple[str, int]:
    """Error handler: every byte that is not part of a character becomes a replacement mark of its own."""
    return "�", e.start + 1


class Model:
    """The pieces of a model file and the two directions over one text."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        rules, kinds = proto.normalizer_spec, [p.type for p in proto.pieces]
        if proto.trainer_spec.model_type != MERGE_TYPE or kinds.count(BYTE) != 256 or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("a merge-type model with byte pieces, without unused pieces and pieces set by a user, is needed")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or proto.denormalizer_spec.precompiled_charsmap or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("a model that leaves texts as they are, with marks for spaces, is needed")
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.rank = {p.piece: -p.score for p in proto.pieces if p.type == NORMAL}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.controls = {i for i, k in enumerate(kinds) if k == CONTROL}
        self.surface = [self._surface(p) for p in proto.pieces]
        self.marked = {i for p, i in self.ids.items() if p[0] == SPACE}
        alphabet = {c for p in self.ids for c in p}
        if alphabet - self.ids.keys() or any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("each character of a piece must be a piece, and space marks must come first")
        breaks = "".join(c for c in "\n\r\t" if c not in alphabet)
        coarse = f"{SPACE}*[^{SPACE}{breaks}]+|{SPACE}+" + f"|[{breaks}]+" * bool(breaks)
        # ASCII signs that stand beside no letter in a piece part words too, unless a text has a character that stands beside them
        pairs = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1) if SPACE not in p[i : i + 2]}
        near_letters = {c for pair in pairs if any(x.isalpha() for x in pair) for c in pair}
        signs = {c for c in alphabet if c.isascii() and not c.isalpha()} - near_letters
        self.joining = frozenset(c for pair in pairs if signs & {*pair} for c in pair) - signs
        shut = "".join(map(re.escape, sorted(signs)))
        self.coarse = re.compile(coarse)
        self.fine = re.compile(f"{SPACE}*[^{SPACE}{breaks}{shut}]+|{SPACE}*[{shut}]+|{coarse}") if signs else self.coarse
        # a token that its own characters don't merge to is never in an encoding
        self.tokens = {p: i for p, i in self.ids.items() if self.remerged(p) == [p]}
        self.longest = ahocorasick.Automaton()
        for token in self.tokens:
            if len(token) > 1:  # a character is a token of its own anyway
                self.longest.add_word(token[::-1], token)
        self.longest.make_automaton()
        self.shorter = {t: next((t[:k] for k in range(len(t) - 1, 0, -1) if t[:k] in self.tokens), None) for t in self.tokens}
        self.beside: dict[tuple[str, str], bool] = {}
        self.memo = _Memo(self.stretch_ids)

    @staticmethod
    def _surface(p) -> bytes:
        if p.type == BYTE:
            return bytes([int(p.piece[3:5], 16)])
        return {CONTROL: "", UNKNOWN: UNKNOWN_TEXT}.get(p.type, p.piece.replace(SPACE, " ")).encode()

    def remerged(self, text: str) -> list[str]:
        """The tokens that merging gives for a short text: again and again the best-ranked neighbours, the leftmost of equal ones."""
        parts, rank = list(text), self.rank.get
        ranks = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (best := min(ranks)) < NEVER:
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], NEVER)
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], NEVER)
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Whether two tokens may be neighbours."""
        pair = (left, right)
        found = self.beside.get(pair)
        if found is None:
            if len(self.beside) >= MEMO_ENTRIES:
                self.beside.clear()
            found = self.beside[pair] = self.remerged(left + right) == [left, right]
        return found

    def backtracked(self, text: str) -> list[str]:
        """The tokens of a text without unknown characters."""
        n = len(text)
        # the automaton reports the longest of the tokens that end at a place first, and the last entry of a place stays
        longest = dict(reversed([*self.longest.iter(text[::-1])]))
        failed, taken, pos, token, last = bytearray(n // 8 + 1), [], 0, longest.get(n - 1, text[0]), None
        beside, shorter = self.beside.get, self.shorter
        while pos < n:
            while token is not None:
                end = pos + len(token)
                if not failed[end >> 3] >> (end & 7) & 1:
                    fits = last is None or beside((last, token))
                    if fits or fits is None and self.compatible(last, token):
                        break
                token = shorter[token]
            if token is not None:
                taken.append(token)
                pos, last = end, token
                token = longest.get(n - 1 - pos, text[pos]) if pos < n else None
            else:
                if last is None:
                    raise AssertionError("no sequence of tokens has only neighbours that may stand together")
                failed[pos >> 3] |= 1 << (pos & 7)
                token = taken.pop()
                pos -= len(token)
                last = taken[-1] if taken else None
        return taken

    def stretch_ids(self, text: str) -> bytes:
        """Ids, as 32-bit numbers, of a stretch with a space mark for each space."""
        known = self.ids
        if known.keys() >= set(text):
            out = [known[t] for t in self.backtracked(text)]
        else:
            out, at = [], 0
            for i, c in enumerate(text):
                if c not in known:
                    out += [known[t] for t in self.backtracked(text[at:i])] if at < i else []
                    out += [self.byte_ids[b] for b in c.encode()]
                    at = i + 1
            out += [known[t] for t in self.backtracked(text[at:])] if at < len(text) else []
        return array("i", out).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as 32-bit numbers."""
        if not text:
            return b""
        stretch = self.fine if self.joining.isdisjoint(text) else self.coarse
        return b"".join(map(self.memo.__getitem__, stretch.findall(self.prefix + text.replace(" ", SPACE))))

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids; the space mark that comes before all text is not part of it."""
        if len(ids) and not (min(ids) >= 0 and max(ids) < len(self.surface)):
            raise ValueError("an id is not in the model")
        data = b"".join(map(self.surface.__getitem__, ids))
        if self.prefix and next((i for i in ids if i not in self.controls), None) in self.marked:
            data = data[1:]
        try:
            if self.controls.isdisjoint(ids):
                return data.decode()
            raise ValueError
        except ValueError:  # bytes on the two sides of another piece, even one that prints nothing, make no character
            runs, byte_ids = [], set(self.byte_ids.values())
            for kind, run in groupby(ids, byte_ids.__contains__):
                runs.append(b"".join(map(self.surface.__getitem__, run)).decode(errors="one_mark_a_byte" if kind else "strict"))
            text = "".join(runs)
            return text[1:] if self.prefix and next((i for i in ids if i not in self.controls), None) in self.marked else text


class _Memo(dict):
    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, part: str) -> bytes:
        ids = self.encode(part)
        if len(part) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[part] = ids
        return ids


def model(path: str) -> Model:
    """The model of a path, loaded once in the life of a Python worker."""
    codecs.register_error("one_mark_a_byte", one_mark_a_byte)
    kept = sys.__dict__.setdefault("_tallyfold_models", {})
    if path not in kept:
        kept[path] = Model(path)
    return kept[path]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array<int>): a row per row of docs, without ids for begin and end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = model(path).encode
        for batch in batches:
            found = [encode(t or "") for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *[len(x) // 4 for x in found]], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")))
            yield pa.record_batch([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return only(docs, "doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, ids array<int>")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, decoded: ``encoded`` and ``decoded`` in one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            found = [np.frombuffer(own.encode(t or ""), "<i4") for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*found, np.zeros(0, "<i4")])))
            yield pa.record_batch([batch.column("doc_id"), ids, pa.array([own.decode(x.tolist()) for x in found], pa.string())], ["doc_id", "ids", "decoded"])

    return only(docs, "doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, ids array<int>, decoded string")


def decoded(rows: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """The rows with a column for the text of their ids (an array; null: none)."""
    rows = rows.drop(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = model(path).decode
        for batch in batches:
            texts = [decode(x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else "" for x in batch.column(ids)]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, into])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, `{into}` string")
