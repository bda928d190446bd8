"""Language identification by partial matching: byte context trees with escape probabilities.

Each language has a tree of contexts of up to three bytes. Counts of all training documents are taken in the tasks and added up by
Spark; trees keep all nodes, and a sparse table of them (12 bytes a gram and context) goes to the workers. A byte costs -log2 of its share after the longest context that knows it, plus the cost
of each escape on the way (method C: a context of n bytes seen with d different successors escapes with d / (n + d)). A text's code
length under each frozen tree decides; the score is the weight 2**-length of the best language among all.

The alphabet is every byte that training texts hold. Other bytes share one symbol; a context with one is that of a text's start.

Null texts and texts without a letter get ``und`` with score 0. Repeated rows and repeated or null doc_ids are judged one by one (a
null doc_id is not held out). Rows without a language don't train; with no training rows everything is ``und``. Ties go to the first
language by name. An empty table gives an empty result. Columns other than doc_id, text and lang are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import byte_texts, only

ORDER = 3
#: Bytes that are handled at once.
CHUNK = 1 << 20


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the texts the code of itself and the three bytes before it (zeros before a text), and each text's length."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    padded = np.frombuffer(b"\0\0\0" + b"\0\0\0".join(texts), np.uint8).astype(np.uint32)
    code = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
    inside = np.ones(len(code), bool)
    ends = np.cumsum(sizes + 3) - 3
    for k in range(3):
        at = ends[:-1] + k
        inside[at[at < len(code)]] = False
    return code[inside], sizes


def chunks(texts: list[bytes]) -> Iterator[list[int]]:
    """Runs of indices of about CHUNK bytes."""
    run, size = [], 0
    for i, text in enumerate(texts):
        run.append(i)
        size += len(text)
        if size >= CHUNK:
            yield run
            run, size = [], 0
    if run:
        yield run


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n over all rows of docs: doc_id, text, lang."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def add(lang: str, code: np.ndarray, n: np.ndarray) -> None:
            if lang in sums:
                code, n = np.concatenate([sums[lang][0], code]), np.concatenate([sums[lang][1], n])
            names, at = np.unique(code, return_inverse=True)
            sums[lang] = names, np.bincount(at, weights=n, minlength=len(names)).astype(np.int64)

        for batch in batches:
            texts, langs = byte_texts(batch.column("text")), batch.column("lang").to_pylist()
            for lang in set(langs):
                own = [t for t, x in zip(texts, langs, strict=True) if x == lang and t]
                for part in chunks(own):
                    code, _ = grams([own[i] for i in part])
                    add(lang, *np.unique(code, return_counts=True))
        for lang, (code, n) in sums.items():
            yield pa.record_batch([pa.array([lang] * len(code), pa.string()), pa.array(code, pa.int64()), pa.array(n, pa.int64())], ["lang", "gram", "n"])

    return docs.select("text", "lang").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Trees:
    """For each language and order 0 to 3: the grams by number with their costs, and the contexts with those of leaving them."""

    langs: list[str]
    seen: np.ndarray  # by byte: whether any language has it
    orders: list[list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]


def grown(counts: list[tuple[str, int, int]]) -> Trees | None:
    """The trees of the given (lang, gram, n)."""
    if not counts:
        return None
    lang, code, n = zip(*counts, strict=True)
    langs = sorted(set(lang))
    return grown_from(langs, np.array([langs.index(x) for x in lang]), np.array(code, np.uint32), np.array(n, np.int64))


def grown_from(langs: list[str], lang: np.ndarray, code: np.ndarray, n: np.ndarray) -> Trees:
    """The trees of all grams: lang as place in langs, code, n."""
    seen = np.zeros(256, bool)
    seen[np.unique(code & np.uint32(255))] = True
    return Trees(langs, seen, [orders(code[lang == i], n[lang == i]) for i in range(len(langs))])


def orders(code: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Grams, costs, contexts and escapes by order; each gram of four bytes holds one of every lower order, so no count is lost."""
    out = []
    for order in range(ORDER + 1):
        keys, at = np.unique(code & np.uint32((1 << 8 * (order + 1)) - 1), return_inverse=True)
        times = np.bincount(at, weights=n, minlength=len(keys))
        contexts, of = np.unique(keys >> np.uint32(8), return_inverse=True)
        total, kinds = np.bincount(of, weights=times), np.bincount(of)
        out.append((keys, -np.log2(times / (total + kinds)[of]), contexts, -np.log2(kinds / (total + kinds))))
    return out


def place(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where keys are in a sorted table that is not empty, and whether they are there."""
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def gram_costs(trees: Trees, code: np.ndarray) -> np.ndarray:
    """Bits of the last byte of each gram after the others, under each language."""
    last = trees.seen[code & np.uint32(255)]
    known = np.zeros(len(code), np.uint32)
    for shift in (24, 16, 8, 0):
        byte = (code >> np.uint32(shift)) & np.uint32(255)
        known |= np.where(trees.seen[byte], byte, np.uint32(0)) << np.uint32(shift)
    out = np.zeros((len(code), len(trees.langs)))
    for i, levels in enumerate(trees.orders):
        open_ = np.arange(len(code))
        for order in range(ORDER, -1, -1):
            keys, costs, contexts, escapes = levels[order]
            gram = known[open_] & np.uint32((1 << 8 * (order + 1)) - 1)
            at, found = place(keys, gram)
            found &= last[open_]
            out[open_[found], i] += costs[at[found]]
            open_, gram = open_[~found], gram[~found]
            at, met = place(contexts, gram >> np.uint32(8))
            out[open_[met], i] += escapes[at[met]]
        out[open_, i] += np.log2(trees.seen.sum() + 1)
    return out


def code_lengths(trees: Trees, texts: list[bytes]) -> np.ndarray:
    """Bits of each text under each language."""
    code, sizes = grams(texts)
    out = np.zeros((len(texts), len(trees.langs)))
    if not len(code):
        return out
    names, at = np.unique(code, return_inverse=True)
    cost = gram_costs(trees, names)
    full = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[full]
    for i in range(len(trees.langs)):
        out[full, i] = np.add.reduceat(cost[at, i], starts)
    return out


def trained(docs: DataFrame) -> Trees | None:
    """Trees of all rows with a language that are not held out. Every gram counts; the different ones reach the driver as columns."""
    found = gram_counts(docs.where(F.col("lang").isNotNull() & ~held_out())).toArrow()
    if not found.num_rows:
        return None
    names = found.column("lang").combine_chunks().dictionary_encode()
    langs = sorted(names.dictionary.to_pylist())
    number = np.array([langs.index(x) for x in names.dictionary.to_pylist()], np.int32)
    return grown_from(langs, number[names.indices.to_numpy()], found.column("gram").to_numpy().astype(np.uint32), found.column("n").to_numpy())


def predicted(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score; a row per row of docs."""
    model = docs.sparkSession.sparkContext.broadcast(vars(trees) if trees else None)  # grows with the different grams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Trees(**model.value) if model.value else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            judged = [i for i, t in enumerate(texts) if t and trees and any(map(str.isalpha, t))]  # categories L, not the numbers that look like letters
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
            data = [texts[i].encode("utf-8", "surrogatepass") for i in judged]
            for part in chunks(data):
                bits = code_lengths(trees, [data[i] for i in part])
                best = bits.argmin(axis=1)
                weight = np.exp2(-np.clip(bits - bits.min(axis=1, keepdims=True), 0, 1000)).sum(axis=1)
                for i, b, w in zip(part, best.tolist(), weight.tolist(), strict=True):
                    names[judged[i]], scores[judged[i]] = trees.langs[b], 1 / w
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "held_out", "lang_pred", "score"])

    source = only(docs, "doc_id", "text").withColumn("held_out", held_out())
    return source.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double")


def identified(docs: DataFrame) -> DataFrame:
    return predicted(docs, trained(only(docs, "doc_id", "text", "lang")))
