"""Divergence of sources by their terms: Gustavson's row accumulation over a term-major index.

Each language keeps the terms of at least ``MIN_DOCS`` of its documents. A kept term has in a group (language, source) the smoothed
share p = 1 + floor(SCALE * (count + 1) / (N + V)), with N the group's count over the V kept terms, so a term that a group lacks has a
share too. The excess of a share p over a share q is floor((p - q)**2 / q); the divergence of a group from a peer is the sum of the
excesses over all kept terms. All of it is exact in integers.

The index has a row per kept term with its postings (source, count). It is dealt out in blocks of terms. In a block each group goes
through its own terms, whose postings are added into one dense accumulator with a place per peer, so pairs of postings are never
rows. What a term adds that one or both sides lack comes from their counts of counts (a share depends on the count alone), and is
taken off again where both have it. A block leaves one number per group and peer; blocks are added up.

Texts are counted in the tasks before the shuffle: a row per group, term and task. Null text, language and source are ''. Repeated
rows and repeated or null doc_ids count as documents of their own. Groups without terms are compared too, with 0 where V is 0. An
empty table gives an empty result. Columns other than the named ones are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import byte_texts, saved

#: Runs of ASCII letters and of characters beyond ASCII, in UTF-8.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
MIN_DOCS = 3
SCALE = 1_000_000_000
TERM_RANKS = 200
#: Counted terms that a task holds before it passes them on.
HELD = 300_000
#: Postings of a block of terms: at least, at most, and that many for each pair of sources.
LEAST, MOST, A_PAIR = 20_000, 2_000_000, 4
#: Pairs of postings that are added at once.
CHUNK = 1 << 20

ORACLE = """
WITH docs AS (SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
words AS (SELECT row, lang, source, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS total FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n FROM kept GROUP BY lang),
counted AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT d.lang, d.source, coalesce(sum(c), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM docs) d LEFT JOIN counted USING (lang, source) GROUP BY d.lang, d.source),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + (1000000000 * (coalesce(c.c, 0) + 1)) // (g.n + l.v) AS p, 1 + (1000000000 * (k.total + 1)) // (l.n + l.v) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::HUGEINT AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM shares WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM found
QUALIFY part = 'pair' OR rank <= 200
"""


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), n_docs: every term of every text, added up."""

    def rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, n_docs) in held.items():
            terms = list(n)
            size = len(terms)
            yield pa.record_batch(
                [pa.repeat(lang, size), pa.repeat(source, size), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([n_docs[t] for t in terms], pa.int64())],
                ["lang", "source", "term", "n", "n_docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for text, lang, source in zip(byte_texts(batch.column("text")), batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True):
                n, n_docs = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                own = Counter(TERM.findall(text.lower()))  # lower() of bytes changes A to Z only
                n.update(own)
                n_docs.update(own.keys())
                size += len(n) - before
                if size >= HELD:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    source = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    counted = source.mapInArrow(run, "lang string, source string, term string, n long, n_docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def term_index(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term, total, postings (array of source, n): a row per kept term. A term has a posting per source at most."""
    posting = F.struct("source", "n")
    grouped = counts.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("total"), F.collect_list(posting).alias("postings"))
    return grouped.where(F.col("n_docs") >= min_docs).select("lang", "term", "total", "postings")


def sizes(docs: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, source, n, v) of every group that occurs, and (lang, total, v) of every language with kept terms."""
    langs = index.groupBy("lang").agg(F.sum("total").alias("total"), F.count("*").alias("v"))
    own = index.select("lang", F.explode("postings").alias("p")).groupBy("lang", "p.source").agg(F.sum("p.n").alias("n"))
    occurring = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = occurring.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    return groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n", "v")]), langs


def share(count: str, total: str, scale: int = SCALE) -> Column:
    """1 + floor(scale * (count + 1) / total) of two long columns, exact in decimals; a long."""
    return F.expr(f"1 + (cast({count} + 1 as decimal(20,0)) * cast({scale} as decimal(12,0))) div cast({total} as decimal(20,0))")


def shares(count: np.ndarray, total: np.ndarray, scale: int) -> np.ndarray:
    """The same in longs: long division by three digits at a time."""
    whole, rest = (count + 1) // total, (count + 1) % total
    while scale > 1:
        step = min(scale, 1000)
        whole, rest = whole * step + rest * step // total, rest * step % total
        scale //= step
    return 1 + whole


def excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def block_divergence(term: np.ndarray, group: np.ndarray, count: np.ndarray, n_terms: int, n: np.ndarray, v: int, scale: int = SCALE) -> np.ndarray:
    """The sum of excesses over one block's terms: a row per group, a column per peer.

    Postings (term, group, count) come in any order; n has each group's total, v the number of all kept terms."""
    size = len(n)
    out = np.zeros((size, size), np.int64)
    if not n_terms:
        return out
    total = n + v
    lacking = shares(np.zeros(size, np.int64), total, scale)
    order = np.lexsort((group, term))
    term, group, count = term[order], group[order], count[order]
    p = shares(count, total[group], scale)
    starts = np.searchsorted(term, np.arange(n_terms + 1))
    rows = np.argsort(group, kind="stable")
    ends = np.searchsorted(group[rows], np.arange(size + 1))
    has = np.diff(ends)
    # counts of counts: shares that occur in a group, and how often
    kinds, often = np.unique(np.stack([group, p]), axis=1, return_counts=True)
    of = np.searchsorted(kinds[0], np.arange(size + 1))
    for g in range(size):
        acc, own = out[g], rows[ends[g] : ends[g + 1]]
        mine, times = kinds[1, of[g] : of[g + 1]], often[of[g] : of[g + 1]]
        for a in range(0, size, max(1, CHUNK // max(1, len(mine)))):  # what the group has and the peer lacks
            b = min(size, a + max(1, CHUNK // max(1, len(mine))))
            acc[a:b] += (excess(mine[:, None], lacking[None, a:b]) * times[:, None]).sum(axis=0)
        np.add.at(acc, kinds[0], excess(lacking[g], kinds[1]) * often)  # what the peer has and the group lacks
        shared = np.zeros(size, np.int64)
        reach = starts[term[own] + 1] - starts[term[own]]
        cuts = np.searchsorted(np.cumsum(reach), np.arange(CHUNK, reach.sum() + CHUNK, CHUNK), side="right")
        for a, b in zip([0, *cuts], [*cuts, len(own)], strict=True):  # what both have: the postings of the group's own terms
            if a == b:
                continue
            length = reach[a:b]
            at = np.repeat(starts[term[own[a:b]]] - np.cumsum(length) + length, length) + np.arange(length.sum())
            peer, q, mine = group[at], p[at], np.repeat(p[own[a:b]], length)
            np.add.at(acc, peer, excess(mine, q) - excess(mine, lacking[peer]) - excess(lacking[g], q))
            shared += np.bincount(peer, minlength=size)
        acc += (n_terms - has[g] - has + shared) * excess(lacking[g], lacking)
    return out


def pair_divergence(index: DataFrame, groups: DataFrame, scale: int = SCALE) -> DataFrame:
    """lang, source, item (a peer), value: every ordered pair of a language's groups. index and groups are saved tables."""
    postings = index.agg(F.sum(F.size("postings"))).first()[0] or 0
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    blocks = -(-postings // min(MOST, max(LEAST, A_PAIR * most * most))) or 1
    terms = index.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")).select("lang", "block", "postings")
    everywhere = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("source")
        names = right.column("source").combine_chunks()
        lists = left.column("postings").combine_chunks()
        flat = lists.flatten()
        at = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        group = pc.index_in(flat.field("source"), value_set=names)
        n, v = right.column("n").to_numpy(), right.column("v").to_numpy()
        found = block_divergence(at, group.to_numpy(zero_copy_only=False).astype(np.int64), flat.field("n").to_numpy(zero_copy_only=False), len(lists), n, int(v[0]) if len(v) else 0, scale)
        a, b = np.nonzero(~np.eye(len(n), dtype=bool))
        langs = right.column("lang").combine_chunks()
        return pa.table({"lang": langs.take(pa.array(a)), "source": names.take(pa.array(a)), "item": names.take(pa.array(b)), "value": pa.array(found[a, b])})

    parts = terms.groupBy("lang", "block").cogroup(everywhere.groupBy("lang", "block")).applyInArrow(run, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_excess(index: DataFrame, groups: DataFrame, langs: DataFrame, scale: int = SCALE) -> DataFrame:
    """lang, source, item (a term), value: the terms that a group uses more than its language does."""
    postings = index.select("lang", "term", "total", F.explode("postings").alias("p")).select("lang", "p.source", "term", "p.n", "total")
    own = groups.select("lang", "source", (F.col("n") + F.col("v")).alias("group_size")).join(langs.select("lang", (F.col("total") + F.col("v")).alias("lang_size")), "lang")
    found = postings.join(own, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), share("n", "group_size", scale).alias("p"), share("total", "lang_size", scale).alias("q"))
    return found.where("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))


def ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return found.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, scale: int = SCALE, term_ranks: int = TERM_RANKS) -> DataFrame:
    """lang, source, part, item, value, rank: part 'pair' has all peers of a group, part 'term' its first distinctive terms."""
    index = saved(term_index(term_counts(docs), min_docs), "terms")
    groups, langs = (saved(x, name) for x, name in zip(sizes(docs, index), ("groups", "langs"), strict=True))
    pairs = ranked(pair_divergence(index, groups, scale)).withColumn("part", F.lit("pair"))
    terms = ranked(term_excess(index, groups, langs, scale)).where(F.col("rank") <= term_ranks).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
